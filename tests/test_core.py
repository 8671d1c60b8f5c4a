"""Behaviours of ranking, scoring, chunking, documents, caches, batches, sources and streams."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ranksieve.functions import text as t
from ranksieve.functions import vectors as v
from ranksieve.operators import batching, cache, chunking, documents, ranking, scoring
from ranksieve.plans import payload
from ranksieve.sources.listing import fetch_with_retry, listing, pages

VEC = "name string, unit int, vector array<double>"


def test_cosine(spark):
    rows = [([3.0, 4.0], [1.0, 0.0], 0.6), ([0.0, 0.0], [1.0, 0.0], 0.0), ([1.0, 0.0], [1.0, 0.0, 1.0], 2**-0.5)]
    got = spark.createDataFrame(rows, "a array<double>, b array<double>, x double").select(v.cosine(F.col("a"), F.col("b")), "x").collect()
    assert all(abs(g - x) < 1e-12 for g, x in got)


def test_triage_ties_negative_and_empty(spark):
    items = spark.createDataFrame([(0, [3.0, 4.0]), (1, [-1.0, 0.0]), (2, [1.0, 1.0])], "ord long, vector array<double>")
    both = spark.createDataFrame([("A", 0, [1.0, 0.0]), ("B", 1, [0.0, 1.0])], VEC)
    got = {r["ord"]: (r["score"], r["product"]) for r in scoring.triage(items, both).collect()}
    assert got[0] == (0.8, "B") and got[2][1] == "A"
    one = both.where("name = 'A'")
    assert {r["ord"]: r["score"] for r in scoring.triage(items, one).collect()}[1] == -1.0
    with pytest.raises(ValueError):
        scoring.triage(items, both.where("false"))


def test_adherence_floor_and_first_wins(spark):
    chunks = spark.createDataFrame([("x", 0, [1.0, 0.0]), ("x", 1, [0.0, 1.0]), ("z", 0, [-1.0, -1.0])], "item string, chunk int, vector array<double>")
    profile = spark.createDataFrame([("A", 0, [3.0, 4.0]), ("B", 1, [4.0, 3.0])], VEC)
    keys = spark.createDataFrame([("x",), ("y",), ("z",)], "item string")
    got = {r["item"]: (r["score"], r["product"]) for r in scoring.adherence(keys, chunks, profile).collect()}
    assert got == {"x": (0.8, "B"), "y": (0.0, ""), "z": (0.0, "")}


def test_classify(spark):
    chunks = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.6, 0.8])], "chunk int, vector array<double>")
    pr = spark.createDataFrame([("baixa", 0, [1.0, 0.0]), ("incluir", 1, [0.6, 0.8])], VEC)
    assert [r["class"] for r in scoring.classify(chunks, pr).orderBy("chunk").collect()] == ["baixa", "incluir"]
    same = spark.createDataFrame([("baixa", 0, [1.0, 0.0]), ("incluir", 1, [1.0, 0.0])], VEC)
    assert {r["class"] for r in scoring.classify(chunks, same).collect()} == {"incluir"}


def test_mark_is_stable(spark):
    rows = spark.createDataFrame([("A", 0, 0.5), ("B", 1, 0.9), ("C", 2, 0.5), ("D", 3, 0.9)], "name string, ord int, score double")
    got = ranking.mark(rows, 3).orderBy("position").collect()
    assert [(r["name"], r["selected"]) for r in got] == [("B", True), ("D", True), ("A", True), ("C", False)]
    assert [r["name"] for r in ranking.page(rows, 1, 2).collect()] == ["D", "A"]


def plain_chunks(text, many=200, mean=250):
    def head(line):
        s = line.strip()
        letters = [x for x in s if x.isalpha()]
        return 3 <= len(s) <= 80 and len(letters) >= 3 and sum(x.isupper() for x in letters) / len(letters) >= 0.8

    parts, held = [], []
    for line in text.splitlines():
        if held and head(line):
            parts.append("\n".join(held).strip())
            held = []
        held.append(line)
    parts.append("\n".join(held).strip())
    if len(parts) >= many and sum(map(len, parts)) / len(parts) < mean:
        parts = [text]
    out = []
    for s in parts:
        i = 0
        while True:
            out.append(s[i : i + 2000])
            if i + 2000 >= len(s):
                break
            i += 1700
    return [x for x in out if len(x.strip()) >= 50]


def test_chunks(spark):
    texts = [
        "DO OBJETO\n" + "abc " * 40 + "\nDA ENTREGA\n" + "def " * 40, "x" * 16000, "DO OBJETO\nab", "", "  \n ", "\n".join(f"ITEM VALOR {i}" for i in range(600)),
        *("y" * n for n in (2000, 2001, 3700, 3701)), "a\x85B C D\u2028\x0bEFG HIJ\n" + "z " * 60, "\xa0 CABEÇALHO \xa0\n" + "w " * 60, "A\r\n" * 3 + "word " * 30 + "\n",
    ]
    docs = spark.createDataFrame([*enumerate(texts), (99, None)], "doc_id int, text string")
    got = {}
    for r in chunking.chunks(docs).orderBy("doc_id", "chunk_ord").collect():
        got.setdefault(r["doc_id"], []).append(r["chunk"])
    assert got == {i: c for i, x in enumerate(texts) if (c := plain_chunks(x))}


@pytest.mark.parametrize(("kinds", "kept"), [
    (["Edital", "Termo de Referência", "Outros Documentos"], ["Edital", "Termo de Referência"]), (["Edital", "Projeto Básico"], ["Edital", "Projeto Básico"]),
    (["Estudo Técnico Preliminar", "Outros Documentos"], ["Estudo Técnico Preliminar"]), (["Outros Documentos"] * 2, ["Outros Documentos"] * 2), (["DFD", "Outros Documentos"], ["DFD"]),
    (["Mapa de Riscos", "Minuta do Contrato"], ["Minuta do Contrato"]), (["?"], ["?"]), (["Edital", "Edital", "Termo de Referência"], ["Edital", "Edital", "Termo de Referência"]), ([None], [None]),
])
def test_main_documents(spark, kinds, kept):
    df = spark.createDataFrame([(1, i, k) for i, k in enumerate(kinds)], "notice int, i int, kind string")
    assert [r["kind"] for r in documents.main_documents(df, "notice", "kind").orderBy("i").collect()] == kept


def test_active_and_extract(spark):
    items = spark.createDataFrame([('{"a":1}',), ('{"statusAtivo":null}',), ('{"statusAtivo":true}',), ('{"statusAtivo":false}',)], "j string")
    assert [r[0] for r in items.select(documents.active(F.col("j"))).collect()] == [True, False, True, False]
    inner, outer = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("deep.txt", "deep")
    with zipfile.ZipFile(outer, "w") as z:
        z.writestr("d/", "")
        z.writestr("a.txt", "first")
        z.writestr("b.zip", inner.getvalue())
    files = spark.createDataFrame([(1, "x.zip", outer.getvalue()), (2, "y.pdf", b"bad"), (3, "z.png", b"p"), (4, "w.txt", b"  "), (5, None, None)], "k int, name string, content binary")
    assert [(r["k"], r["text"]) for r in documents.extract(files).orderBy("k", "text_ord").collect()] == [(1, "first"), (1, "deep")]


def test_names_and_dates(spark):
    names = [("a/b%20c.pdf", "b c.pdf"), (r"C:\temp\x", "x"), ("relatório: final*.pdf", "relatório_ final_.pdf"), ("a" * 200 + ".pdf", "a" * 76 + ".pdf"), ("%2F", "arquivo"), ("a+b.txt", "a+b.txt")]
    df = spark.createDataFrame(names, "n string, x string")
    assert all(a == b for a, b in df.select(t.safe_name(F.col("n")), "x").collect())
    md = "# A\nintro\n## Aplicações típicas\n- um\n- dois\n## Tecnologias e termos relacionados\nfoo, bar\n"
    assert spark.createDataFrame([(md,)], "m string").select(t.profile_units(F.col("m"))).first()[0] == ["um", "dois", "foo, bar"]
    dates = [("2026-01-01T10:00:00", "2026-01-01T10:00:00Z"), ("2026-01-01", "2026-01-01"), ("2026-01-01T10:00:00+03:00", "2026-01-01T10:00:00+03:00")]
    assert all(a == b for a, b in spark.createDataFrame(dates, "d string, x string").select(t.iso_utc(F.col("d")), "x").collect())


def test_cache_and_stale(spark):
    texts = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a"), (3, None)], "ord int, text string")
    entries = spark.createDataFrame([("a", 0, [1.0]), ("a", 1, [2.0])], "t string, entry int, vector array<double>").select(cache.text_hash(F.col("t")).alias("hash"), "entry", "vector")
    assert [r["text"] for r in cache.misses(texts, entries).collect()] == ["b"]
    assert {(r["ord"], r["vector"][0]) for r in cache.lookup(texts, entries, ord="entry").collect()} == {(0, 2.0), (2, 2.0)}
    now = spark.createDataFrame([("x", "2"), ("y", "1"), ("z", None), ("w", "1")], "k string, d string")
    before = spark.createDataFrame([("x", "1"), ("y", "1"), ("z", "")], "k string, d string")
    assert {r["k"] for r in cache.stale(now, before, "k", "d").collect()} == {"x", "w"}


def test_greedy(spark):
    def run(sizes, most, budget):
        df = spark.createDataFrame([(0, i, s) for i, s in enumerate(sizes)], "g int, o int, t int")
        return [r["batch"] for r in batching.greedy(df, "g", "o", "t", most, budget).orderBy("o").collect()]

    assert run([3, 3, 3], 100, 5) == [0, 1, 2]
    assert run([1, 1, 1, 1], 100, 100) == [0] * 4
    assert run([1] * 5, 2, 100) == [0, 0, 1, 1, 2]
    assert run([9, 1, 1], 100, 5) == [0, 1, 1]


def test_listing(spark):
    waits = []
    answers = iter([(429, {}), (200, {"data": [{"n": 1}], "totalPaginas": 2}), (404, {})])
    got = list(pages(4, {}, lambda p: next(answers), 5, 2.0, 1.0, waits.append))
    assert [g[1:3] for g in got] == [(1, 0), (2, None)] and got[1][4] and waits == [2.0, 1.0]
    assert fetch_with_retry(lambda p: (503, {}), {}, 3, 1.0, waits.append) is None and waits[2:] == [1.0, 2.0, 4.0]

    def fake(params):
        n = params["codigoModalidadeContratacao"]
        return 200, {"data": [{"id": f"{n}-{params['pagina']}"}], "totalPaginas": 2}

    spark.dataSource.register(listing(fake))
    rows = spark.read.format("paged_listing").options(categories="4,6", pause="0").load().collect()
    assert sorted(json.loads(r["item"])["id"] for r in rows) == ["4-1", "4-2", "6-1", "6-2"]


def test_payload_and_verdict(spark):
    df = spark.createDataFrame([("a", None, True), ("b", 1, None)], "id string, n int, ia_aderente boolean")
    assert [json.loads(r[0]) for r in payload.payload(df).collect()] == [{"id": "a", "n": None, "ia_aderente": True}, {"id": "b", "n": 1}]
    yes, said = payload.verdict(F.col("v"), "none")
    rows = spark.createDataFrame([('{"ia_aderente": true, "justificativa_ia": "ok"}',), ('"old"',), ("{}",), (None,)], "v string").select(yes, said).collect()
    assert [tuple(r) for r in rows] == [(True, "ok"), (None, "old"), (None, "none"), (None, "none")]
    sent = []
    assert payload.send(payload.payload(df), 2, sent.extend) and not sent
    with pytest.raises(ValueError):
        payload.send(df, 201, sent.extend)


def test_stream_reprocess(spark, tmp_path):
    from ranksieve.streaming.reprocess import run_once

    schema = StructType([StructField("k", StringType()), StructField("d", StringType()), StructField("o", StringType())])
    src, seen = tmp_path / "in", []
    src.mkdir()

    def go():
        run_once(spark, str(src), schema, str(tmp_path / "state"), str(tmp_path / "cp"), "k", "d", "o", lambda rows, n: seen.append({r["k"] for r in rows.collect()})).awaitTermination()

    (src / "1.json").write_text('{"k":"a","d":"1","o":"0"}\n{"k":"b","d":"1","o":"1"}\n')
    go()
    (src / "2.json").write_text('{"k":"a","d":"1","o":"0"}\n{"k":"b","d":"0","o":"1"}\n')
    go()
    assert seen == [{"a", "b"}, {"b"}]
