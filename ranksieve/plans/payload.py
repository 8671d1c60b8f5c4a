"""Publication: payload rows, verdicts and the capped, dry-run-first sink."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranksieve.functions.text import iso_utc, percent

#: Most items that are sent at a time.
MOST = 200


def verdict(value: Column, default: str = "") -> tuple[Column, Column]:
    """(boolean or null, text) of a verdict that is an object or, in old files, a plain string."""
    v = F.try_parse_json(value)
    plain = F.schema_of_variant(v) == "STRING"
    yes = F.when(~plain, F.try_variant_get(v, "$.ia_aderente", "boolean"))
    text = F.when(plain, F.try_variant_get(v, "$", "string")).otherwise(F.try_variant_get(v, "$.justificativa_ia", "string"))
    return yes, F.coalesce(text, F.lit(default))


def payload(items: DataFrame, flag: str = "ia_aderente") -> DataFrame:
    """One JSON string a row: nulls are kept, but a null flag is left out."""
    rest = F.to_json(F.struct(*[x for x in items.columns if x != flag]), {"ignoreNullFields": "false"})
    tail = F.when(F.col(flag).isNotNull(), F.concat(F.lit(f',"{flag}":'), F.col(flag).cast("string"), F.lit("}"))).otherwise(F.lit("}"))
    return items.select(F.concat(F.regexp_replace(rest, r"\}$", ""), tail).alias("payload"))


def descriptors(main: DataFrame, key: str = "item") -> DataFrame:
    """key, documentos: id, nome, tipo, url of each main document, in their order (key, file_ord, seq, kind, url)."""
    one = F.struct("file_ord", F.struct(F.col("seq").cast("string").alias("id"), F.col("kind").alias("nome"), F.lit("PDF").alias("tipo"), "url").alias("d"))
    return main.groupBy(key).agg(F.array_sort(F.collect_list(one))["d"].alias("documentos"))


def panel(ranked: DataFrame, notices: DataFrame, said: DataFrame, files: DataFrame, base_url: str, default: str = "") -> DataFrame:
    """The sixteen fields of each ranked notice that has a record, in order of ``position``, and the verdict where there is one.

    ``ranked``: numero, score_aderencia, position; ``notices``: raw records by numeroControlePNCP; ``said``: key, verdict
    (JSON); ``files``: numero, documentos, no row for a listing that failed.
    """
    raw = notices.withColumnRenamed("numeroControlePNCP", "numero")
    yes, why = verdict(F.col("verdict"), default)
    rows = ranked.join(raw, "numero").join(said.withColumnRenamed("key", "numero"), "numero", "left").join(files, "numero", "left")
    none = F.array().cast(files.schema["documentos"].dataType)
    year, number = F.col("anoCompra").cast("string"), F.col("sequencialCompra").cast("string")
    return rows.orderBy("position").select(
        F.col("numero").alias("numero_controle_pncp"), F.concat_ws("/", number, year).alias("numero_compra"), F.col("orgaoEntidade.razaoSocial").alias("orgao"),
        F.col("unidadeOrgao.nomeUnidade").alias("unidade"), F.col("unidadeOrgao.ufSigla").alias("uf"), F.col("unidadeOrgao.municipioNome").alias("municipio"),
        F.col("modalidadeNome").alias("modalidade"), F.col("objetoCompra").alias("objeto"), F.col("valorTotalEstimado").alias("valor_estimado"), iso_utc(F.col("dataPublicacaoPncp")).alias("data_publicacao"),
        F.col("dataAberturaProposta").alias("data_abertura_propostas"), F.col("dataEncerramentoProposta").alias("data_encerramento_propostas"),
        F.concat_ws("/", F.lit(base_url), F.col("orgaoEntidade.cnpj"), year, number).alias("link_pncp"), percent(F.col("score_aderencia")).alias("score"),
        why.alias("justificativa_ia"), F.coalesce("documentos", none).alias("documentos"), yes.alias("ia_aderente"))


def collection(total: int, day: str) -> dict:
    """What a payload says of the day's collection; ``day`` is YYYY-MM-DD."""
    return {"periodo": "/".join(reversed(day.split("-"))), "total_coletado": total}


def prompt(template: str, subject: Column, text: Column, missing: str) -> Column:
    """The template with {objeto} and {texto} filled in; a null or empty text is told by ``missing``."""
    said = F.coalesce(F.nullif(text, F.lit("")), F.lit(missing))
    parts = re.split(r"(\{objeto\}|\{texto\})", template)
    return F.concat(*(F.coalesce(subject, F.lit("")) if x == "{objeto}" else said if x == "{texto}" else F.lit(x) for x in parts))


def verdict_map(judged: DataFrame, key: str) -> str:
    """One JSON object {key: verdict} of the rows (key, veredito, erro) without an error; at most MOST of them."""
    rows = judged.where("erro IS NULL").select(F.col(key).cast("string"), "veredito").limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError(f"at most {MOST} verdicts make a map")
    return json.dumps({k: json.loads(v) for k, v in sorted(rows)}, ensure_ascii=False, indent=2)


def send(rows: DataFrame, top: int, post: Callable[[list[dict]], None], dry_run: bool = True) -> list[dict]:
    """Posts at most MOST rows, and only when told to."""
    if top > MOST:
        raise ValueError(f"at most {MOST} rows go at a time")
    out = [json.loads(r[0]) for r in rows.limit(top).collect()]
    if not dry_run:
        post(out)
    return out
