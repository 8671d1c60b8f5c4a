"""Sinks of the stages: day tables, errors, profile caches, JSON files a day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_day(rows: DataFrame, path: str, day: str = "dia", form: str = "parquet") -> None:
    """Replaces the days that ``rows`` has in a table by day, and no other; a write that fails leaves them as they were."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).format(form).save(path)


def write_collected(items: DataFrame, path: str, errors_path: str, category: str = "category", page: str = "page") -> None:
    """A listing's rows by day: items to one table, failed pages to another.

    ``items``: dia, category, page, ord, item, error, as the listing source gives them with a day.
    """
    write_day(items.where("error IS NULL").drop("error"), path)
    write_day(items.where("error IS NOT NULL").select("dia", category, page, "error"), errors_path)


def triage_rows(marked: DataFrame, key: str = "ord") -> DataFrame:
    """What the triage hands on: key, score, product and the flag under their outer names, best first by ``position``."""
    return marked.select(F.col(key).alias("numero"), F.col("score").alias("score_triagem"), F.col("product").alias("produto"), F.col("selected").alias("selecionado"), "position")


def adherence_rows(marked: DataFrame, key: str = "item") -> DataFrame:
    """The same of the adherence."""
    return marked.select(F.col(key).alias("numero"), F.col("score").alias("score_aderencia"), F.col("product").alias("produto"), F.col("selected").alias("selecionado_revisao"), "position")


def write_profile_cache(units: DataFrame, path: str) -> None:
    """Replaces the entries of the profiles that ``units`` (name, hash, modelo, unit, text, vector) has."""
    write_day(units, path, "name")
