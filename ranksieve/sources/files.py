"""Readers of day files, profiles, caches, verdicts and local documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ranksieve.functions.names import free_names, quoted
from ranksieve.functions.text import bullets, profile_units
from ranksieve.operators.ranking import last_wins

_DAY = r"(\d{4}-\d{2}-\d{2})"
_STEM = r"\.[^.]*$"


def _whole(spark: SparkSession, path: str, **options) -> DataFrame:
    """dia, name (file stem) and value, the text, of each file of a folder or glob; the name may not fit a day."""
    raw = spark.read.options(**options).text(path, wholetext=True)
    file = F.col("_metadata.file_name")
    return raw.select(F.regexp_extract(file, _DAY, 1).alias("dia"), F.regexp_replace(file, _STEM, "").alias("name"), "value")


def day_files(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Items of JSON array files; ``dia`` from the name, ``ord`` the place in the file."""
    items = F.from_json("value", f"array<{schema.simpleString()}>")
    return _whole(spark, path).select("dia", F.posexplode(items).alias("ord", "item")).select("dia", "ord", "item.*")


def embedded_days(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Items of files {metadados, editais: [...]}: dia, ord and the items' columns, of all days."""
    body = F.from_json("value", f"editais array<{schema.simpleString()}>")
    return _whole(spark, path).select("dia", F.posexplode(body["editais"]).alias("ord", "item")).select("dia", "ord", "item.*")


def selected(rows: DataFrame, score: str, n: int | None = None, flag: str | None = "selecionado", ord: str = "ord", skip: int = 0) -> DataFrame:
    """The best rows first, ties by ``ord``: those of a true flag (missing is false), or all where no flag is named."""
    rows = rows if flag is None else rows.where(F.coalesce(F.col(flag), F.lit(False)))
    out = rows.orderBy(F.desc(score), F.asc(ord)).offset(skip)
    return out if n is None else out.limit(n)


def profiles(spark: SparkSession, folder: str, units: Callable[[Column], Column] = profile_units) -> DataFrame:
    """name (file stem), hash, unit, text of every unit of the Markdown profiles of a folder; ``units`` cuts a file into them."""
    raw = _whole(spark, folder, pathGlobFilter="*.md")
    return raw.select("name", F.sha2("value", 256).alias("hash"), F.posexplode(units(F.col("value"))).alias("unit", "text"))


def in_file_order(units: DataFrame, name: str = "name", unit: str = "unit") -> DataFrame:
    """The same rows with ``unit`` counted on over all files, in lexicographic order of their names, so ties between files have a winner.

    Only a row a file is put in order by one task.
    """
    file, before = free_names(units, "file", "before")
    sizes = units.groupBy(F.col(quoted(name)).alias(file)).agg((F.max(unit) + 1).alias("n"))
    first = sizes.select(file, (F.sum("n").over(Window.orderBy(F.asc_nulls_last(file))) - F.col("n")).alias(before))
    joined = units.join(first, F.col(quoted(name)).eqNullSafe(F.col(file)))
    return joined.withColumn(unit, (F.col(quoted(unit)) + F.col(before)).cast(units.schema[unit].dataType)).select(*map(quoted, units.columns))


def priority_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """The same of priority groups, whose units are all bullets of a file."""
    return profiles(spark, folder, bullets)


def profile_cache(spark: SparkSession, folder: str) -> DataFrame:
    """name, hash, modelo ('' where missing), unit, text, vector of cached profiles: a JSON file each."""
    body = F.from_json("value", "hash string, modelo string, unidades array<struct<texto:string,vetor:array<double>>>")
    raw = _whole(spark, folder, pathGlobFilter="*.json").select("name", body.alias("j"))
    out = raw.select("name", "j.hash", F.coalesce("j.modelo", F.lit("")).alias("modelo"), F.posexplode("j.unidades").alias("unit", "u"))
    return out.select("name", "hash", "modelo", "unit", F.col("u.texto").alias("text"), F.col("u.vetor").alias("vector"))


def vector_cache(spark: SparkSession, path: str, model: str) -> DataFrame:
    """hash, vector of a model from JSON lines; blank lines are skipped, the last line of a hash counts."""
    row = F.from_json("value", "modelo string, hash string, vetor array<double>")
    lines = spark.read.text(path).select(row.alias("j"), F.monotonically_increasing_id().alias("ord")).where(F.col("j.modelo") == model)
    return last_wins(lines.select("j.hash", F.col("j.vetor").alias("vector"), "ord"), "hash", "ord").drop("ord")


def chunk_files(spark: SparkSession, path: str) -> DataFrame:
    """name (file stem), date, chunks of one JSON file a notice. A file that cannot be read is no entry, not one without chunks."""
    bad = "_corrupt"
    body = F.from_json("value", f"dataAtualizacaoGlobal string, chunks array<string>, {bad} string", {"columnNameOfCorruptRecord": bad})
    raw = _whole(spark, path, pathGlobFilter="*.json").select("name", body.alias("j")).where(F.col("j").isNotNull() & F.col(f"j.{bad}").isNull())
    none = F.array().cast("array<string>")
    return raw.select("name", F.coalesce("j.dataAtualizacaoGlobal", F.lit("")).alias("date"), F.coalesce("j.chunks", none).alias("chunks"))


def verdicts(spark: SparkSession, path: str) -> DataFrame:
    """key, verdict (JSON) of files that map a notice to an object or, in old files, a string; none where no file is."""
    try:
        raw = _whole(spark, path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        raw = spark.createDataFrame([], "dia string, name string, value string")
    keys = raw.select(F.explode(F.json_object_keys("value")).alias("key"), F.parse_json("value").alias("v"))
    # a key may hold any character, so it is looked up as a map's
    return keys.select("key", F.to_json(F.element_at(F.col("v").cast("map<string,variant>"), F.col("key"))).alias("verdict"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """folder, sequential, name, content of files called ``{sequential}_{name}``; the last name of a sequential counts."""
    raw = spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(folder)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    own = raw.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"), F.regexp_extract(name, r"^(\d+)_", 1).alias("sequential"), name.alias("name"), "content").where("sequential <> ''")
    best = own.groupBy("folder", "sequential").agg(F.max_by(F.struct("name", "content"), "name").alias("f"))
    return best.select("folder", F.col("sequential").cast("int").alias("sequential"), "f.name", "f.content")


def settings(text: str, known: dict[str, str]) -> dict[str, str]:
    """``known`` and what a settings file adds to it: NAME=value lines; blank ones, comments and others are skipped."""
    out = dict(known)
    for line in map(str.strip, text.splitlines()):
        if line and not line.startswith("#") and "=" in line:
            name, _, value = line.partition("=")
            out.setdefault(name.strip(), value.strip())
    return out
