"""Queries over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ranksieve.functions import text as t
from ranksieve.functions import vectors as v
from ranksieve.operators import batching, cache, chunking, documents, ranking, scoring, table_functions

from . import diagnosis, payload


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _profile(s, d):
    return _table(s, d, "embeddings").where("vec_id < 49").select(F.concat(F.lit("p"), "label").alias("name"), F.col("vec_id").alias("unit"), F.col("embedding").alias("vector"))


def _priority(s, d):
    return _table(s, d, "embeddings").where("vec_id between 49 and 56").select(F.when(F.col("vec_id") < 54, "baixa").otherwise("incluir").alias("name"), F.col("vec_id").alias("unit"), F.col("embedding").alias("vector"))


def _items(s, d):
    return _table(s, d, "embeddings").where("vec_id >= 57").select(F.col("vec_id").alias("ord"), F.col("embedding").alias("vector"))


def _chunks(s, d):
    return _items(s, d).select((F.col("ord") % 40).alias("item"), F.col("ord").alias("chunk"), "vector")


def q01_split_lines(s, d):
    return _table(s, d, "documents").select("doc_id", F.posexplode(t.lines(F.col("text"))).alias("line_ord", "line"))


def q02_header_lines(s, d):
    return q01_split_lines(s, d).where(t.is_header(F.col("line"))).select("doc_id", "line_ord", "line")


def q03_sections(s, d):
    return _table(s, d, "documents").select("doc_id", F.posexplode(chunking.sections(F.col("text"))).alias("section_ord", "section"))


def q04_degenerate_flag(s, d):
    parts = chunking.sections(F.col("text"))
    return _table(s, d, "documents").select("doc_id", F.size(parts).cast("long").alias("n_sections"), chunking.is_degenerate(parts, 2, 2000).alias("degenerate"))


def q05_windows(s, d):
    return _table(s, d, "documents").select("doc_id", F.posexplode(chunking.windows(F.col("text"))).alias("window_ord", "window_text"))


def q06_chunks(s, d):
    return chunking.chunks(_table(s, d, "documents"))


def q07_chunk_stats(s, d):
    n = q06_chunks(s, d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.sum("n").alias("chunks"), F.percentile("n", F.lit(0.5)).alias("median_n"), F.percentile("n", F.lit(0.95)).alias("p95_n"))


def q08_distinct_chunks(s, d):
    return q06_chunks(s, d).groupBy(F.sha2("chunk", 256).alias("hash")).agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("n"))


def _six(column="score"):
    """Sums of doubles differ in their last digits from engine to engine, so queries compare six decimals."""
    return F.round(column, 6).alias(column)


def _triage(s, d):
    return scoring.dense(_items(s, d), _profile(s, d)).withColumn("score", _six())


def _adherence(s, d, chunks):
    return scoring.adherence(_keys(s, d), chunks, _profile(s, d)).withColumn("score", _six())


def q09_cosine_pairs(s, d):
    return scoring.explain(_items(s, d), _profile(s, d)).select("ord", "unit", _six())


def q10_triage_rank(s, d):
    return ranking.mark(_triage(s, d), 300).select("ord", "score", "product", F.col("position").cast("int").alias("position"), "selected")


def q11_product_counts(s, d):
    rows = _triage(s, d).rollup("product").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 4).alias("mean_score"), F.max("score").alias("max_score"))
    return rows.select(F.coalesce("product", F.lit("total")).alias("product"), "n", "mean_score", "max_score")


def q12_classify_chunks(s, d):
    return scoring.classify(_chunks(s, d), _priority(s, d)).select("item", "chunk", _six("low"), _six("keep"), "class")


def _keys(s, d):
    return _chunks(s, d).select("item").distinct()


def q13_adherence_no_priority(s, d):
    return _adherence(s, d, _chunks(s, d))


def _kept(s, d):
    kind = scoring.classify(_chunks(s, d), _priority(s, d)).where("class <> 'baixa'").select("item", "chunk")
    return _chunks(s, d).join(kind, ["item", "chunk"], "left_semi")


def q14_priority_filter(s, d):
    return _kept(s, d).groupBy("item").agg(F.count(F.lit(1)).alias("n_kept"))


def q15_adherence_cap(s, d):
    first = Window.partitionBy("item").orderBy("chunk")
    capped = _chunks(s, d).withColumn("k", F.row_number().over(first)).where("k <= 5").drop("k")
    return _adherence(s, d, capped)


def q16_adherence_full(s, d):
    return ranking.mark(_adherence(s, d, _kept(s, d)), 20, ord="item").select("item", "score", "product", F.col("position").cast("int").alias("position"), "selected")


def q17_explain_scores(s, d):
    top = Window.partitionBy("ord").orderBy(F.desc("score"), "unit")
    return q09_cosine_pairs(s, d).withColumn("k", F.row_number().over(top)).where("k <= 3").select("ord", "unit", "score", "k")


_KINDS = ("Edital", "Termo de Referência", "Projeto Básico", "Estudo Técnico Preliminar", "DFD", "Minuta do Contrato", "Outros Documentos", "Mapa de Riscos", "Parecer")


def q18_main_documents(s, d):
    kind = F.element_at(F.array(*map(F.lit, _KINDS)), (F.pmod("p_partkey", F.lit(len(_KINDS))) + 1).cast("int"))
    files = _table(s, d, "part").select("p_partkey", (F.col("p_partkey") % 7 + F.floor(F.col("p_partkey") / 50) * 7).alias("notice"), kind.alias("kind"))
    return documents.main_documents(files, "notice", "kind").select("notice", "p_partkey", "kind")


def q19_cache_misses(s, d):
    docs = _table(s, d, "documents")
    have = docs.where("doc_id % 2 = 0").select(cache.text_hash(F.col("text")).alias("hash"))
    return cache.misses(docs, have).select("hash")


def q20_cache_lookup(s, d):
    docs = _table(s, d, "documents").select(F.col("doc_id").alias("ord"), "text")
    entries = docs.select(cache.text_hash(F.col("text")).alias("hash"), F.col("ord").alias("entry"), F.col("ord").alias("vector"))
    return cache.lookup(docs, entries, ord="entry").select("ord", F.col("vector").alias("last_entry"))


def q21_reprocess(s, d):
    now = _table(s, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
    before = now.where("o_orderkey % 3 <> 0").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, None).otherwise(F.col("date")).alias("date"))
    return cache.stale(now, before, "o_orderkey", "date")


def q22_index_join(s, d):
    o, c, n = _table(s, d, "orders"), _table(s, d, "customer"), _table(s, d, "nation")
    known = c.join(n, c["c_nationkey"] == n["n_nationkey"]).where("c_acctbal > 0").select("c_custkey", "c_name", "n_name")
    return o.join(known, o["o_custkey"] == known["c_custkey"], "left").select("o_orderkey", F.coalesce("c_name", F.lit("")).alias("c_name"), F.coalesce("n_name", F.lit("")).alias("n_name"))


def q23_missing_in_index(s, d):
    dear = _table(s, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return _table(s, d, "customer").join(dear, "c_custkey", "left_anti").select("c_custkey")


def q24_semi_main_files(s, d):
    parts = _table(s, d, "part").where("p_size <= 10").select(F.col("p_partkey").alias("l_partkey"))
    return _table(s, d, "lineitem").join(parts, "l_partkey", "left_semi").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


def q25_union_days(s, d):
    e = _table(s, d, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    slices = [e.where("day < '2024-01-11'"), e.where("day >= '2024-01-11' AND day < '2024-01-21'"), e.where("day >= '2024-01-21'"), e.where("day IS NULL")]
    return reduce(DataFrame.unionByName, slices).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


def q26_ordered_concat(s, d):
    listed = F.array_sort(F.collect_list(F.struct("turn", "text")))
    return _table(s, d, "conversations").groupBy("conv_id").agg(F.array_join(listed["text"], "\n").alias("text"))


def q27_rank_slice(s, d):
    return ranking.page(_triage(s, d), 20, 10).select("ord", "score")


def q28_first_files(s, d):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    return _table(s, d, "lineitem").withColumn("k", F.row_number().over(w)).where("k <= 2").select("l_orderkey", "l_linenumber", "k")


def q29_ratio_to_base(s, d):
    by = _table(s, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    first = F.first_value("n").over(Window.orderBy("event_type").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return by.select("event_type", "n", F.round(F.col("n") / first, 6).alias("ratio"))


def q30_payload_fields(s, d):
    o, c = _table(s, d, "orders"), _table(s, d, "customer")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    zone = F.element_at(F.array(*map(F.lit, ("", "Z", "+03:00"))), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        "o_orderkey", F.concat_ws("/", F.col("o_orderkey").cast("string"), F.year("o_orderdate").cast("string")).alias("label"), t.iso_utc(F.concat(stamp, zone)).alias("published"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("shown"), F.concat(F.lit("https://example.org/"), F.col("c_custkey").cast("string"), F.lit("/"), F.col("o_orderkey").cast("string")).alias("link"))


def q31_half_even(s, d):
    return _table(s, d, "embeddings").select("vec_id", t.percent(F.col("vec_id") / 200).alias("pct"))


def q32_file_names(s, d):
    path = F.regexp_replace("url", r"[?#].*$", "")
    return _table(s, d, "pages").select("page_id", t.base_name(path).alias("name"), t.slug(F.col("url")).alias("slug"), t.extension(path).alias("ext"))


def q33_est_tokens(s, d):
    return _table(s, d, "documents").groupBy("lang").agg(F.sum(t.tokens_estimate(F.col("text"))).alias("tokens"), F.max(t.tokens_estimate(F.col("text"))).alias("most"))


def q34_counters_by_type(s, d):
    return _table(s, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.round(F.sum("value"), 3).alias("total"))


def q35_false_positive_rate(s, d):
    top = _table(s, d, "documents").join(_table(s, d, "labels"), "doc_id").orderBy(F.desc("n_chars"), "doc_id").limit(100)
    return top.agg(F.count(F.lit(1)).alias("k"), F.round(F.avg((F.col("quality") == 0).cast("double")), 6).alias("fp_rate"))


def q36_text_truncation(s, d):
    return _table(s, d, "documents").select("doc_id", F.substring("text", 1, 1800).alias("shown"))


def q37_json_semantics(s, d):
    item = F.when(F.col("event_id") % 3 == 0, F.lit('{"statusAtivo": null}')).when(F.col("event_id") % 3 == 1, F.lit('{"statusAtivo": false}')).otherwise(F.col("props"))
    return _table(s, d, "events").select("event_id", documents.active(item).alias("active"))


def q38_greedy_batches(s, d):
    rows = _table(s, d, "documents").select("lang", "doc_id", t.tokens_estimate(F.col("text")).alias("tokens"))
    out = batching.greedy(rows, "lang", "doc_id", "tokens", 10, 5000)
    return out.groupBy("lang", "batch").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc"))


def q39_chunk_hash(s, d):
    return q06_chunks(s, d).select("doc_id", "chunk_ord", cache.text_hash(F.col("chunk")).alias("hash"))


def _other_profile(s, d):
    return _table(s, d, "embeddings").where("vec_id >= 57 and vec_id < 157").select(F.concat(F.lit("o"), "label").alias("name"), F.col("vec_id").alias("unit"), F.col("embedding").alias("vector"))


def q40_pairwise_triage(s, d):
    items = _table(s, d, "embeddings").select(F.col("vec_id").alias("ord"), F.col("embedding").alias("vector"))
    return scoring.triage(items, _profile(s, d)).withColumn("score", _six())


def q41_profile_comparison(s, d):
    items = _table(s, d, "embeddings").where("vec_id >= 49 and vec_id not between 57 and 156").select(F.col("vec_id").alias("ord"), F.col("embedding").alias("vector"))
    old, new = (scoring.dense(items, p(s, d)).withColumn("score", _six()) for p in (_profile, _other_profile))
    return diagnosis.compared(old, new, 50)


def q42_throughput(s, d):
    level = F.pow(F.lit(2), F.length("event_type") % 4).cast("int")
    status = F.element_at(F.array(*map(F.lit, (200, 200, 200, 404, 429, 503))), (F.col("event_id") % 6 + 1).cast("int"))
    answers = _table(s, d, "events").select(level.alias("level"), status.alias("status"), F.when(F.col("event_id") % 12 != 0, F.col("event_id") * 10).alias("bytes"), (F.lit(20.0) - level).alias("seconds"))
    out = diagnosis.throughput(answers)
    return out.select("level", "seconds", *(F.round(x, 6).alias(x) for x in ("mb_per_s", "files_per_s", "gain", "efficiency")), "transient", "other_failures")


def _listed(s, d):
    kind = F.element_at(F.array(*map(F.lit, _KINDS)), (F.col("p_partkey") % len(_KINDS) + 1).cast("int"))
    return _table(s, d, "part").select(F.floor(F.col("p_partkey") / 7).alias("item"), F.col("p_partkey").alias("seq"), kind.alias("kind"), F.col("p_partkey").alias("file_ord"), "p_name")


def _present(s, d):
    name = F.concat(F.col("p_name"), F.element_at(F.array(*map(F.lit, (".PDF", ".docx", "", ".zip"))), (F.col("p_partkey") % 4 + 1).cast("int")))
    local = _table(s, d, "part").where("p_size > 10").select(F.floor(F.col("p_partkey") / 7).alias("item"), F.col("p_partkey").alias("seq"), name.alias("name"), F.when(F.col("p_size") % 3 > 0, F.col("p_size") * 10).alias("chars"))
    return diagnosis.presence(_listed(s, d).drop("p_name"), local)


def q43_presence(s, d):
    return _present(s, d).select("item", "seq", "kind", "on_disk", "extension", "chars")


def q44_common_extensions(s, d):
    return diagnosis.most_common(_present(s, d), "extension", "seq", F.col("chars") == 0)


def _chunk_counts(s, d, every):
    return _table(s, d, "part").where(F.col("p_partkey") % every == 0).groupBy(F.floor(F.col("p_partkey") / 7).alias("item")).agg(F.sum("p_size").alias("n"))


def q45_rechunk_report(s, d):
    main = documents.main_documents(_listed(s, d), "item", "kind")
    return diagnosis.rechunked(_present(s, d), main, _chunk_counts(s, d, 3), _chunk_counts(s, d, 5))


def q46_rechunk_totals(s, d):
    return diagnosis.rechunk_totals(q45_rechunk_report(s, d))


def q47_diagnosis(s, d):
    out = diagnosis.diagnosis(_present(s, d), _chunk_counts(s, d, 11)).where("chunks_now = 0")
    told = F.transform("files", lambda x: F.concat_ws(":", x["seq"].cast("string"), x["kind"], x["on_disk"].cast("string"), F.coalesce(x["extension"], F.lit("None")), x["chars"].cast("string")))
    return out.select("item", "n_missing", F.array_join(told, ",").alias("files"))


def q48_descriptors(s, d):
    main = documents.main_documents(_listed(s, d).withColumn("url", F.col("p_name")), "item", "kind")
    told = F.transform("documentos", lambda x: F.concat_ws("|", x["id"], x["nome"], x["tipo"], x["url"]))
    return payload.descriptors(main).select("item", F.array_join(told, ",").alias("documents"))


def q49_panel(s, d):
    o, c = _table(s, d, "orders"), _table(s, d, "customer")
    key = F.col("o_orderkey").cast("string")
    notices = o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        key.alias("numeroControlePNCP"), F.struct(F.col("c_custkey").cast("string").alias("cnpj"), F.col("c_name").alias("razaoSocial")).alias("orgaoEntidade"),
        F.struct(F.col("c_mktsegment").alias("nomeUnidade"), F.lit("SP").alias("ufSigla"), F.lit(None).cast("string").alias("municipioNome")).alias("unidadeOrgao"), F.year("o_orderdate").alias("anoCompra"), F.col("o_orderkey").alias("sequencialCompra"),
        F.col("o_orderpriority").alias("modalidadeNome"), F.col("o_orderstatus").alias("objetoCompra"), F.col("o_totalprice").alias("valorTotalEstimado"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("dataPublicacaoPncp"), F.lit(None).cast("string").alias("dataAberturaProposta"), F.lit("x").alias("dataEncerramentoProposta"))
    ranked = o.where("o_orderkey % 10 < 3").select(key.alias("numero"), (F.col("o_orderkey") % 1000 / 1000).alias("score_aderencia"), F.col("o_orderkey").alias("position"))
    verdict = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit('{"ia_aderente": '), (F.col("o_orderkey") % 2 == 0).cast("string"), F.lit(', "justificativa_ia": "read"}'))).otherwise(F.lit('"old"'))
    said = o.where("o_orderkey % 4 > 0").select(key.alias("key"), verdict.alias("verdict"))
    files = o.where("o_orderkey % 2 = 0").select(key.alias("numero"), F.array(F.struct(key.alias("id"), F.lit("Edital").alias("nome"))).alias("documentos"))
    out = payload.panel(ranked, notices, said, files, "https://example.org", "none")
    return out.select("numero_controle_pncp", "numero_compra", "orgao", "unidade", "uf", "municipio", "modalidade", "objeto", "valor_estimado", "data_publicacao", "data_abertura_propostas", "data_encerramento_propostas", "link_pncp", "score", "justificativa_ia", "ia_aderente", F.size("documentos").alias("n_documents"))


def q50_constant_lookup(s, d):
    known = s.createDataFrame([("1-URGENT", 0.9, "first"), ("3-MEDIUM", 0.5, "later"), ("none", 0.1, "never")], "o_orderpriority string, score double, reason string")
    return _table(s, d, "orders").join(F.broadcast(known), "o_orderpriority", "left").select("o_orderkey", F.bround("score", 4).alias("score"), "reason")


def q51_scalars(s, d):
    stamp = F.when(F.col("event_id") % 5 > 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    body = F.when(F.col("event_id") % 3 == 0, F.lit('{"error_code": "TOO_MANY_TOKENS_IN_BATCH"}')).when(F.col("event_id") % 3 == 1, F.lit("no json")).otherwise(F.col("props"))
    asked = payload.prompt("About {objeto}: {texto}.", F.col("event_type"), F.when(F.col("event_id") % 7 > 0, F.col("props")), "[nothing]")
    return _table(s, d, "events").select(
        "event_id", t.day_prefix(stamp).alias("day"), t.compact_day(t.day_prefix(stamp)).alias("compact"), t.has_error_code(body, "TOO_MANY_TOKENS_IN_BATCH").alias("too_many"), asked.alias("prompt"), F.bround(F.col("event_id") / 16, 2).alias("rounded"))


def q52_failed_left_out(s, d):
    failed = _keys(s, d).select("item", F.when(F.col("item") % 4 == 1, F.lit("no answer")).alias("erro"))
    return scoring.without_failed(_keys(s, d), failed).select("item")


def q53_pruned_triage(s, d):
    found = scoring.pruned(_items(s, d), _profile(s, d)).withColumn("score", _six())
    return ranking.mark(found, 300).select("ord", "score", "product", F.col("position").cast("int").alias("position"), "selected")


def q54_quota_files(s, d):
    files = _table(s, d, "lineitem")
    cuts = files.select(F.percentile_approx("l_orderkey", [k / 16 for k in range(1, 16)])).first()[0] or []
    return ranking.quota(files, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"], 2, 1000, cuts).select("l_orderkey", "l_linenumber", "l_partkey")


def q55_ranking_totals(s, d):
    return ranking.totals(q10_triage_rank(s, d))


def q56_chunk_table_function(s, d):
    table_functions.register(s)
    return s.sql("SELECT doc_id, chunk_ord, chunk FROM text_chunks(TABLE(SELECT doc_id, text FROM {docs}), 'text')", docs=_table(s, d, "documents"))


def q57_lateral_chunks(s, d):
    table_functions.register(s)
    return s.sql("SELECT item_id, chunk_ord, chunk FROM {items} AS i, LATERAL chunks_of(i.text)", items=_table(s, d, "benchmark"))


QUERIES = {k: f for k, f in sorted(globals().items()) if k[0] == "q" and k[1:3].isdigit()}

_BREAK = r"(?:\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}])"
_SP = r"[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_STRIP = f"regexp_replace(%s, '^{_SP}+|{_SP}+$', '', 'g')"
_LINES = f"""ll AS (SELECT doc_id, regexp_split_to_array(text, '{_BREAK}') AS a FROM documents),
lines AS (SELECT doc_id, unnest(range(len(b))) AS line_ord, unnest(b) AS line FROM (SELECT doc_id, CASE WHEN a[len(a)] = '' THEN a[1:len(a) - 1] ELSE a END AS b FROM ll))"""
_HEAD = rf"""(length({_STRIP % 'line'}) BETWEEN 3 AND 80 AND length(regexp_replace({_STRIP % 'line'}, '\P{{L}}', '', 'g')) >= 3
 AND length(regexp_replace({_STRIP % 'line'}, '\P{{Lu}}', '', 'g')) >= 0.8 * length(regexp_replace({_STRIP % 'line'}, '\P{{L}}', '', 'g')))"""
_SECTIONS = f"""{_LINES},
marked AS (SELECT *, sum(CASE WHEN {_HEAD} AND line_ord > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_ord) AS sec FROM lines),
sections AS (SELECT doc_id, CAST(sec AS INTEGER) AS section_ord, {_STRIP % "string_agg(line, chr(10) ORDER BY line_ord)"} AS section FROM marked GROUP BY doc_id, sec)"""
_CHUNKS = f"""{_SECTIONS},
degenerate AS (SELECT doc_id FROM sections GROUP BY doc_id HAVING count(*) >= 200 AND avg(length(section)) < 250),
raw AS (SELECT doc_id, section_ord, section AS s FROM sections WHERE doc_id NOT IN (SELECT doc_id FROM degenerate) UNION ALL SELECT doc_id, 0, text FROM documents JOIN degenerate USING (doc_id)),
win AS (SELECT doc_id, section_ord, i, substr(s, CAST(i * 1700 + 1 AS BIGINT), 2000) AS chunk FROM (SELECT *, unnest(range(CAST(greatest(0, ceil((length(s) - 2000) / 1700.0)) AS BIGINT) + 1)) AS i FROM raw)),
chunks AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY section_ord, i) - 1 AS INTEGER) AS chunk_ord, chunk FROM win WHERE length({_STRIP % 'chunk'}) >= 50)"""
_VEC = """e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings),
prof AS (SELECT vec_id AS unit, 'p' || label AS name, v FROM e WHERE vec_id < 49),
prio AS (SELECT CASE WHEN vec_id < 54 THEN 'baixa' ELSE 'incluir' END AS name, v FROM e WHERE vec_id BETWEEN 49 AND 56),
items AS (SELECT vec_id AS ord, vec_id % 40 AS item, v FROM e WHERE vec_id >= 57),
pairs AS (SELECT ord, item, unit, name, round(list_cosine_similarity(items.v, prof.v), 6) AS score FROM items, prof)"""
_TRIAGE = f"""{_VEC}, tri AS (SELECT ord, score, name AS product FROM (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY score DESC, unit) AS k FROM pairs) WHERE k = 1)"""
_CLASS = f"""{_VEC}, cls AS (SELECT item, ord AS chunk, low, keep, CASE WHEN low > keep THEN 'baixa' ELSE 'incluir' END AS class FROM
 (SELECT item, ord, coalesce(max(score) FILTER (WHERE name = 'baixa'), -1) AS low, coalesce(max(score) FILTER (WHERE name = 'incluir'), -1) AS keep
  FROM (SELECT item, ord, prio.name AS name, round(list_cosine_similarity(items.v, prio.v), 6) AS score FROM items, prio) GROUP BY item, ord))"""
_ADHERE = """adh AS (SELECT k.item, coalesce(b.score, 0) AS score, coalesce(b.name, '') AS product FROM (SELECT DISTINCT item FROM items) k LEFT JOIN
 (SELECT * FROM (SELECT item, score, name, row_number() OVER (PARTITION BY item ORDER BY score DESC, ord, unit) AS r FROM pairs WHERE score > 0 AND %s) WHERE r = 1) b ON b.item = k.item)"""
_KIND_SQL = "[" + ", ".join(f"'{x}'" for x in _KINDS) + "]"

_DENSE = "SELECT a.vec_id AS ord, b.vec_id AS unit, '%s' || b.label AS name, round(list_cosine_similarity(a.v, b.v), 6) AS score FROM e a, e b WHERE a.%s AND b.%s"
_PRESENT = f"""listed AS (SELECT p_partkey // 7 AS item, p_partkey AS seq, ({_KIND_SQL})[CAST(p_partkey % {len(_KINDS)} + 1 AS BIGINT)] AS kind, p_name FROM part),
local AS (SELECT p_partkey AS seq, (['.pdf', '.docx', '', '.zip'])[CAST(p_partkey % 4 + 1 AS BIGINT)] AS extension, CASE WHEN p_size % 3 > 0 THEN p_size * 10 ELSE 0 END AS chars FROM part WHERE p_size > 10),
present AS (SELECT item, listed.seq, kind, local.seq IS NOT NULL AS on_disk, extension, CAST(coalesce(chars, 0) AS BIGINT) AS chars FROM listed LEFT JOIN local USING (seq))"""
_MAIN_SQL = f"""listed AS (SELECT p_partkey // 7 AS item, p_partkey AS seq, ({_KIND_SQL})[CAST(p_partkey % {len(_KINDS)} + 1 AS BIGINT)] AS kind, p_name FROM part),
r AS (SELECT *, kind = 'Edital' AS n, list_position(['Termo de Referência', 'Projeto Básico', 'Estudo Técnico Preliminar'], kind) AS m, list_position(['DFD', 'Minuta do Contrato', 'Minuta de Ata de Registro de Preços', 'Outros Documentos', 'Mapa de Riscos'], kind) AS l FROM listed),
b AS (SELECT *, bool_or(n) OVER w AS hn, min(nullif(m, 0)) OVER w AS bm, min(nullif(l, 0)) OVER w AS bl FROM r WINDOW w AS (PARTITION BY item)),
main AS (SELECT item, seq, kind, p_name FROM b WHERE CASE WHEN hn OR bm IS NOT NULL THEN n OR coalesce(nullif(m, 0) = bm, false) WHEN bl IS NOT NULL THEN coalesce(nullif(l, 0) = bl, false) ELSE true END)"""
_RECHUNK = f"""{_PRESENT}, {_MAIN_SQL[_MAIN_SQL.index("r AS"):]},
before AS (SELECT p_partkey // 7 AS item, sum(p_size) AS n FROM part WHERE p_partkey % 3 = 0 GROUP BY 1), after AS (SELECT p_partkey // 7 AS item, sum(p_size) AS n FROM part WHERE p_partkey % 5 = 0 GROUP BY 1),
report AS (SELECT p.item, count(*) AS docs_total, count(*) FILTER (m.seq IS NOT NULL) AS docs_main, count(*) FILTER (m.seq IS NOT NULL AND on_disk) AS docs_used, count(*) FILTER (m.seq IS NOT NULL AND NOT on_disk) AS docs_missing,
 CAST(coalesce(any_value(before.n), 0) AS BIGINT) AS chunks_before, CAST(coalesce(any_value(after.n), 0) AS BIGINT) AS chunks_after
 FROM present p LEFT JOIN main m ON m.seq = p.seq LEFT JOIN before ON before.item = p.item LEFT JOIN after ON after.item = p.item GROUP BY p.item)"""

ORACLES = {
    "q01_split_lines": f"WITH {_LINES} SELECT doc_id, CAST(line_ord AS INTEGER) AS line_ord, line FROM lines",
    "q02_header_lines": f"WITH {_LINES} SELECT doc_id, CAST(line_ord AS INTEGER) AS line_ord, line FROM lines WHERE {_HEAD}",
    "q03_sections": f"WITH {_SECTIONS} SELECT * FROM sections",
    "q04_degenerate_flag": (
        f"WITH {_SECTIONS} SELECT doc_id, count(*) AS n_sections, count(*) >= 2 AND avg(length(section)) < 2000 AS degenerate "
        "FROM sections GROUP BY doc_id"
    ),
    "q05_windows": (
        "SELECT doc_id, CAST(i AS INTEGER) AS window_ord, substr(text, CAST(i * 1700 + 1 AS BIGINT), 2000) AS window_text "
        "FROM (SELECT doc_id, text, unnest(range(CAST(greatest(0, ceil((length(text) - 2000) / 1700.0)) AS BIGINT) + 1)) AS i "
        "FROM documents)"
    ),
    "q06_chunks": f"WITH {_CHUNKS} SELECT * FROM chunks",
    "q07_chunk_stats": (
        f"WITH {_CHUNKS}, n AS (SELECT count(*) AS n FROM chunks GROUP BY doc_id) "
        "SELECT CAST(sum(n) AS BIGINT) AS chunks, quantile_cont(n, 0.5) AS median_n, quantile_cont(n, 0.95) AS p95_n "
        "FROM n"
    ),
    "q08_distinct_chunks": f"WITH {_CHUNKS} SELECT sha256(chunk) AS hash, min(doc_id) AS first_doc, count(*) AS n FROM chunks GROUP BY 1",
    "q09_cosine_pairs": f"WITH {_VEC} SELECT ord, unit, score FROM pairs",
    "q10_triage_rank": (
        f"WITH {_TRIAGE} SELECT ord, score, product, CAST(row_number() OVER w AS INTEGER) AS position, row_number() OVER w <= 300 AS "
        "selected FROM tri WINDOW w AS (ORDER BY score DESC, ord)"
    ),
    "q11_product_counts": (
        f"WITH {_TRIAGE} SELECT coalesce(product, 'total') AS product, count(*) AS n, round(avg(score), 4) AS mean_score, max(score) "
        "AS max_score FROM tri GROUP BY ROLLUP (product)"
    ),
    "q12_classify_chunks": f"WITH {_CLASS} SELECT * FROM cls",
    "q13_adherence_no_priority": f"WITH {_VEC}, {_ADHERE % 'true'} SELECT * FROM adh",
    "q14_priority_filter": f"WITH {_CLASS} SELECT item, count(*) AS n_kept FROM cls WHERE class <> 'baixa' GROUP BY item",
    "q15_adherence_cap": (
        f"WITH {_VEC}, f AS (SELECT ord FROM (SELECT ord, row_number() OVER (PARTITION BY item ORDER BY ord) AS k "
        f"FROM items) WHERE k <= 5), {_ADHERE % 'ord IN (SELECT ord FROM f)'} SELECT * "
        "FROM adh"
    ),
    "q16_adherence_full": f"WITH {_CLASS}, {_ADHERE % "ord IN (SELECT chunk FROM cls WHERE class <> 'baixa')"} SELECT item, score, product, CAST(row_number() OVER w AS INTEGER) AS position, row_number() OVER w <= 20 AS selected FROM adh WINDOW w AS (ORDER BY score DESC, item)",
    "q17_explain_scores": (
        f"WITH {_VEC} SELECT ord, unit, score, CAST(k AS INTEGER) AS k FROM (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY "
        "score DESC, unit) AS k FROM pairs) WHERE k <= 3"
    ),
    "q18_main_documents": f"""WITH f AS (SELECT p_partkey, p_partkey % 7 + p_partkey // 50 * 7 AS notice, ({_KIND_SQL})[CAST(p_partkey % {len(_KINDS)} + 1 AS BIGINT)] AS kind FROM part),
 r AS (SELECT *, kind = 'Edital' AS n, list_position(['Termo de Referência', 'Projeto Básico', 'Estudo Técnico Preliminar'], kind) AS m, list_position(['DFD', 'Minuta do Contrato', 'Minuta de Ata de Registro de Preços', 'Outros Documentos', 'Mapa de Riscos'], kind) AS l FROM f),
 b AS (SELECT *, bool_or(n) OVER w AS hn, min(nullif(m, 0)) OVER w AS bm, min(nullif(l, 0)) OVER w AS bl FROM r WINDOW w AS (PARTITION BY notice))
 SELECT notice, p_partkey, kind FROM b WHERE CASE WHEN hn OR bm IS NOT NULL THEN n OR coalesce(nullif(m, 0) = bm, false) WHEN bl IS NOT NULL THEN coalesce(nullif(l, 0) = bl, false) ELSE true END""",
    "q19_cache_misses": (
        "SELECT DISTINCT sha256(text) AS hash FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) "
        "FROM documents WHERE doc_id % 2 = 0)"
    ),
    "q20_cache_lookup": "SELECT doc_id AS ord, max(doc_id) OVER (PARTITION BY text) AS last_entry FROM documents",
    "q21_reprocess": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 = 0",
    "q22_index_join": (
        "SELECT o_orderkey, coalesce(c_name, '') AS c_name, coalesce(n_name, '') AS n_name "
        "FROM orders LEFT JOIN (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey "
        "WHERE c_acctbal > 0) ON o_custkey = c_custkey"
    ),
    "q23_missing_in_index": (
        "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey "
        "FROM orders WHERE o_custkey IS NOT NULL AND o_totalprice > 400000)"
    ),
    "q24_semi_main_files": (
        "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_partkey IN (SELECT p_partkey "
        "FROM part WHERE p_size <= 10) GROUP BY 1"
    ),
    "q25_union_days": "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1",
    "q26_ordered_concat": "SELECT conv_id, string_agg(text, chr(10) ORDER BY turn, text) AS text FROM conversations GROUP BY 1",
    "q27_rank_slice": f"WITH {_TRIAGE} SELECT ord, score FROM tri ORDER BY score DESC, ord LIMIT 10 OFFSET 20",
    "q28_first_files": (
        "SELECT l_orderkey, l_linenumber, CAST(k AS INTEGER) AS k FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION "
        "BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS k FROM lineitem) "
        "WHERE k <= 2"
    ),
    "q29_ratio_to_base": (
        "SELECT event_type, n, round(n / first_value(n) OVER (ORDER BY event_type), 6) AS ratio "
        "FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1)"
    ),
    "q30_payload_fields": (
        "SELECT o_orderkey, o_orderkey || '/' || year(o_orderdate) AS label, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || CASE WHEN "
        "o_orderkey % 3 = 2 THEN '+03:00' ELSE 'Z' END AS published, strftime(o_orderdate, '%d/%m/%Y') AS shown, "
        "'https://example.org/' || c_custkey || '/' || o_orderkey AS link FROM orders "
        "JOIN customer ON o_custkey = c_custkey"
    ),
    "q31_half_even": "SELECT vec_id, CAST(round_even(CAST(vec_id / 200 * 100 AS DOUBLE), 0) AS INTEGER) AS pct FROM embeddings",
    "q32_file_names": (
        r"SELECT page_id, regexp_extract(p, '([^/]*)/*$', 1) AS name, translate(url, '/\', '__') AS slug, lower(regexp_extract(p, "
        r"'[^/](\.[^./]+)$', 1)) AS ext FROM (SELECT page_id, url, regexp_replace(url, '[?#].*$', '') AS p "
        r"FROM pages)"
    ),
    "q33_est_tokens": (
        "SELECT lang, CAST(sum(greatest(1, length(text) // 4)) AS BIGINT) AS tokens, max(greatest(1, length(text) // 4)) AS most "
        "FROM documents GROUP BY 1"
    ),
    "q34_counters_by_type": "SELECT event_type, count(*) AS n, min(event_id) AS first_id, round(sum(value), 3) AS total FROM events GROUP BY 1",
    "q35_false_positive_rate": (
        "SELECT count(*) AS k, round(avg(CASE WHEN quality = 0 THEN 1.0 ELSE 0.0 END), 6) AS fp_rate "
        "FROM (SELECT quality FROM documents JOIN labels USING (doc_id) ORDER BY n_chars DESC, doc_id LIMIT 100)"
    ),
    "q36_text_truncation": "SELECT doc_id, substr(text, 1, 1800) AS shown FROM documents",
    "q37_json_semantics": "SELECT event_id, event_id % 3 = 2 AS active FROM events",
    "q38_greedy_batches": """WITH RECURSIVE d AS (SELECT lang, doc_id, greatest(1, length(text) // 4) AS t, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents),
 b AS (SELECT lang, doc_id, r, 0 AS batch, 1 AS n, t AS s FROM d WHERE r = 1 UNION ALL
 SELECT d.lang, d.doc_id, d.r, CASE WHEN b.n >= 10 OR b.s + d.t > 5000 THEN b.batch + 1 ELSE b.batch END, CASE WHEN b.n >= 10 OR b.s + d.t > 5000 THEN 1 ELSE b.n + 1 END, CASE WHEN b.n >= 10 OR b.s + d.t > 5000 THEN d.t ELSE b.s + d.t END
 FROM b JOIN d ON d.lang = b.lang AND d.r = b.r + 1)
 SELECT lang, batch, count(*) AS n, min(doc_id) AS first_doc FROM b GROUP BY 1, 2""",
    "q39_chunk_hash": f"WITH {_CHUNKS} SELECT doc_id, chunk_ord, sha256(chunk) AS hash FROM chunks",
    "q40_pairwise_triage": (
        f"WITH {_VEC} SELECT ord, score, name AS product FROM (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY score DESC, "
        f"unit) AS k FROM ({_DENSE % ('p', 'vec_id >= 0', 'vec_id < 49')})) WHERE k = 1"
    ),
    "q41_profile_comparison": f"""WITH {_VEC}, o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY score DESC, unit) AS k FROM ({_DENSE % ('p', 'vec_id NOT BETWEEN 57 AND 156 AND a.vec_id >= 49', 'vec_id < 49')})) WHERE k = 1),
 n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY score DESC, unit) AS k FROM ({_DENSE % ('o', 'vec_id NOT BETWEEN 57 AND 156 AND a.vec_id >= 49', 'vec_id BETWEEN 57 AND 156')})) WHERE k = 1),
 t AS (SELECT *, CAST(row_number() OVER (ORDER BY score DESC, ord) AS INTEGER) AS position FROM n ORDER BY score DESC, ord LIMIT 50)
 SELECT t.ord, position, round_even(t.score, 4) AS score, t.name AS product, round_even(o.score, 4) AS old_score, o.name AS old_product, t.name <> o.name AS moved FROM t LEFT JOIN o USING (ord)""",
    "q42_throughput": """WITH a AS (SELECT CAST(pow(2, length(event_type) % 4) AS INTEGER) AS level, ([200, 200, 200, 404, 429, 503])[CAST(event_id % 6 + 1 AS BIGINT)] AS status, CASE WHEN event_id % 12 <> 0 THEN event_id * 10 END AS bytes FROM events),
 b AS (SELECT level, 20.0::DOUBLE - level AS seconds, coalesce(sum(bytes) FILTER (status = 200), 0)::DOUBLE AS bytes, count(*) AS files, count(*) FILTER (status = 429 OR status >= 500) AS transient,
  count(*) FILTER (NOT (status = 200 AND bytes IS NOT NULL) AND NOT (status = 429 OR status >= 500)) AS other_failures FROM a GROUP BY level),
 r AS (SELECT *, bytes / 1048576 / seconds AS mb, files / seconds AS fs FROM b), g AS (SELECT *, mb / first_value(mb) OVER (ORDER BY level) AS gain FROM r)
 SELECT level, seconds, round(mb, 6) AS mb_per_s, round(fs, 6) AS files_per_s, round(gain, 6) AS gain, round(gain * 100 / level, 6) AS efficiency, transient, other_failures FROM g""",
    "q43_presence": f"WITH {_PRESENT} SELECT item, seq, kind, on_disk, extension, chars FROM present",
    "q44_common_extensions": (
        f"WITH {_PRESENT}, e AS (SELECT extension, count(*) AS n, count(*) FILTER (chars = 0) AS n_empty, min(seq) AS first "
        "FROM present WHERE extension IS NOT NULL GROUP BY 1) SELECT extension, n, n_empty, CAST(row_number() OVER (ORDER BY n DESC, "
        "first) AS INTEGER) AS position FROM e"
    ),
    "q45_rechunk_report": f"WITH {_RECHUNK} SELECT * FROM report",
    "q46_rechunk_totals": (
        f"WITH {_RECHUNK} SELECT count(*) AS items, CAST(sum(chunks_before) AS BIGINT) AS total_before, CAST(sum(chunks_after) AS "
        "BIGINT) AS total_after, count(*) FILTER (docs_main = 0) AS without_main, count(*) FILTER (chunks_after = 0) AS "
        "without_chunks FROM report"
    ),
    "q47_diagnosis": f"""WITH {_PRESENT}, k AS (SELECT DISTINCT p_partkey // 7 AS item FROM part WHERE p_partkey % 11 = 0)
 SELECT item, count(*) FILTER (NOT on_disk) AS n_missing, string_agg(seq || ':' || kind || ':' || on_disk || ':' || coalesce(extension, 'None') || ':' || chars, ',' ORDER BY seq) AS files FROM present WHERE item NOT IN (SELECT item FROM k) GROUP BY item""",
    "q48_descriptors": (
        f"WITH {_MAIN_SQL} SELECT item, string_agg(seq || '|' || kind || '|PDF|' || p_name, ',' ORDER BY seq) AS documents "
        "FROM main GROUP BY item"
    ),
    "q49_panel": """SELECT CAST(o_orderkey AS VARCHAR) AS numero_controle_pncp, o_orderkey || '/' || year(o_orderdate) AS numero_compra, c_name AS orgao, c_mktsegment AS unidade, 'SP' AS uf, CAST(NULL AS VARCHAR) AS municipio,
 o_orderpriority AS modalidade, o_orderstatus AS objeto, o_totalprice AS valor_estimado, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS data_publicacao, CAST(NULL AS VARCHAR) AS data_abertura_propostas, 'x' AS data_encerramento_propostas,
 'https://example.org/' || c_custkey || '/' || year(o_orderdate) || '/' || o_orderkey AS link_pncp, CAST(round_even(o_orderkey % 1000 / 1000 * 100, 0) AS INTEGER) AS score,
 CASE WHEN o_orderkey % 4 = 0 THEN 'none' WHEN o_orderkey % 3 = 0 THEN 'read' ELSE 'old' END AS justificativa_ia, CASE WHEN o_orderkey % 4 > 0 AND o_orderkey % 3 = 0 THEN o_orderkey % 2 = 0 END AS ia_aderente,
 CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS n_documents FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 10 < 3""",
    "q50_constant_lookup": (
        "SELECT o_orderkey, score, reason FROM orders LEFT JOIN (VALUES ('1-URGENT', 0.9::DOUBLE, 'first'), ('3-MEDIUM', 0.5::DOUBLE, "
        "'later'), ('none', 0.1::DOUBLE, 'never')) AS v(p, score, reason) ON o_orderpriority = p"
    ),
    "q51_scalars": """SELECT event_id, CASE WHEN event_id % 5 > 0 THEN strftime(ts, '%Y-%m-%d') ELSE '' END AS day, CASE WHEN event_id % 5 > 0 THEN strftime(ts, '%Y%m%d') ELSE '' END AS compact, event_id % 3 = 0 AS too_many,
 'About ' || event_type || ': ' || CASE WHEN event_id % 7 > 0 THEN props ELSE '[nothing]' END || '.' AS prompt, round_even(event_id / 16, 2) AS rounded FROM events""",
    "q52_failed_left_out": f"WITH {_VEC} SELECT DISTINCT item FROM items WHERE item % 4 <> 1",
    "q54_quota_files": "SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS k FROM lineitem) WHERE k <= 2 ORDER BY l_orderkey, k LIMIT 1000",
}
ORACLES["q53_pruned_triage"] = ORACLES["q10_triage_rank"]
ORACLES["q55_ranking_totals"] = f"SELECT count(*) AS total, count(*) FILTER (WHERE selected) AS selected, count(DISTINCT product) FILTER (WHERE selected AND product <> '') AS products FROM ({ORACLES['q10_triage_rank']})"
ORACLES["q56_chunk_table_function"] = ORACLES["q06_chunks"]
ORACLES["q57_lateral_chunks"] = (
    "WITH documents AS (SELECT item_id AS doc_id, text FROM benchmark), " + ORACLES["q06_chunks"].removeprefix("WITH ").replace("SELECT * FROM chunks", "SELECT doc_id AS item_id, chunk_ord, chunk FROM chunks")
)
