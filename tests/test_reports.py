"""Embedding clients, cache filling and migration, verdicts, and report sinks."""

import io
import json
import zipfile
from xml.etree import ElementTree

import pytest

from ranksieve.operators import embedding as em
from ranksieve.sources import reports


def test_batches_close_before_they_overflow():
    assert list(em.batches(["a", "bb", "cccc", "d"], 2, 3, len)) == [["a", "bb"], ["cccc"], ["d"]]
    assert list(em.batches([], 2, 3, len)) == []


def test_client_halves_waits_and_keeps_order():
    calls, slept = [], []

    def post(texts):
        calls.append(len(texts))
        if len(calls) == 1:
            raise em.Transient("HTTP 503")
        if len(texts) > 2:
            raise em.Overfull("tokens")
        return [[float(x)] for x in texts]

    client = em.Client(post, spacing=0, sleep=slept.append, clock=lambda: 0.0, jitter=lambda: 0.0)
    assert client(list("12345")) == [[1.0], [2.0], [3.0], [4.0], [5.0]]
    assert calls == [5, 5, 2, 3, 1, 2] and slept == [1.0]


def test_client_spaces_batches_and_gives_up():
    slept = []
    client = em.Client(lambda t: [[0.0]] * len(t), most=1, sleep=slept.append, clock=lambda: 7.0)
    client(["a", "b"])
    assert slept == [5.0]

    def down(texts):
        raise em.Transient("HTTP 500")

    with pytest.raises(RuntimeError):
        em.Client(down, attempts=2, sleep=lambda s: None)(["a"])

    def full(texts):
        raise em.Overfull("tokens")

    with pytest.raises(RuntimeError):
        em.Client(full)(["a"])


def test_fill_keeps_what_succeeded(spark, tmp_path):
    texts = spark.createDataFrame([("a",), ("b",), ("a",), ("bad",), (None,)], "text string")
    none = spark.createDataFrame([], "hash string, vector array<double>")

    def client():
        def embed(batch):
            if "bad" in batch:
                raise RuntimeError("refused")
            return [[float(len(x))] for x in batch]

        return embed

    path = str(tmp_path / "cache")
    left = em.fill(texts, none, path, "m", client, str(tmp_path / "s1"), group=1)
    assert [r["erro"] for r in left.collect()] == ["refused"]
    cache = spark.read.parquet(path)
    assert cache.count() == 2 and {r["modelo"] for r in cache.collect()} == {"m"}
    assert em.fill(texts.where("text <> 'bad'"), cache, path, "m", client, str(tmp_path / "s2")).count() == 0
    assert spark.read.parquet(path).count() == 2


def test_migrate_once(spark, tmp_path):
    old = spark.createDataFrame([(json.dumps({"modelo": "m", "vetores": {"h1": [1.0], "h2": [2.0]}}),), (None,)], "value string")
    path = str(tmp_path / "cache")
    em.migrate(old, path)
    em.migrate(old, path)
    assert sorted((r["hash"], r["vector"], r["modelo"]) for r in spark.read.parquet(path).collect()) == [("h1", [1.0], "m"), ("h2", [2.0], "m")]


def test_judge_isolates_failures(spark):
    rows = spark.createDataFrame([(1, "ok"), (2, "x" * 50), (3, "not json"), (4, None)], "id long, prompt string")
    got = {r["id"]: r for r in em.judge(rows, "id", "prompt", lambda: lambda p: p if p == "not json" else '{"ok": true}', len, most=20).collect()}
    assert json.loads(got[1]["veredito"]) == {"ok": True} and got[1]["erro"] is None
    assert "50 tokens" in got[2]["erro"] and got[3]["veredito"] is None and got[4]["erro"] is not None


def test_reading_report(spark):
    items = spark.createDataFrame([(1, "A"), (2, "B")], "position int, item string")
    docs = spark.createDataFrame([("A", 2, "TR", "2_t.pdf", None), ("A", 1, "Edital", "1_e.pdf", "one\ntwo" + "x" * 3000)], "item string, seq int, type string, name string, text string")
    got = {r["item"]: r["report"] for r in reports.reading(items, docs).collect()}
    lines = got["A"].split("\n")
    assert lines[:4] == ["=" * 90, "A", "=" * 90, "  documentos principais: [(1, 'Edital'), (2, 'TR')]"]
    assert lines[5] == "  --- 1_e.pdf (3007 chars extraídos) ---" and lines[6] == "  one"
    assert len("\n".join(lines[6:8]).replace("\n  ", "\n")) - 2 == 1800
    assert lines[8] == "  [seq 2 ausente em disco]" and "sem documentos" in got["B"]


def test_base_documents(spark):
    items = spark.createDataFrame([("2026-01-01", 0, "a", [1.0, 2.0]), ("2026-01-01", 1, None, None)], "dia string, ord int, objeto string, embedding array<double>")
    got = [json.loads(r["value"]) for r in reports.base_documents(items, "m", "document", "t").orderBy("ord").collect()]
    assert got[0]["metadados"]["quantidade"] == 2 and got[0]["metadados"]["dimensao"] == 2
    assert got[1:] == [{"objeto": "a", "embedding": [1.0, 2.0]}, {"objeto": None, "embedding": None}]


def test_workbook(spark):
    rows = spark.createDataFrame([(1, 0.9, "P<1>", 10.5, "http://x/?a=1&b=2"), (2, 0.8, "P2", None, None)], "pos int, score double, product string, value double, link string")
    columns = [("pos", "Posição", 8, "plain"), ("score", "Score", 11, "score"), ("product", "Produto", 30, "plain"), ("value", "Valor", 18, "money"), ("link", "Link", 40, "link")]
    out = io.BytesIO()
    assert reports.workbook(rows, out, columns, "product", "score") == 2
    with zipfile.ZipFile(out) as z:
        parts = {n: ElementTree.fromstring(z.read(n)) for n in z.namelist()}
    ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    assert len(parts["xl/worksheets/sheet1.xml"].findall(f".//{ns}row")) == 3
    formulas = [f.text for f in parts["xl/worksheets/sheet2.xml"].iter(f"{ns}f")]
    assert formulas[0] == "COUNTIF('Ranking'!C:C,A2)" and formulas[-1] == "SUM(B2:B3)"
    link = parts["xl/worksheets/_rels/sheet1.xml.rels"][0]
    assert link.get("Target") == "http://x/?a=1&b=2"


def test_workbook_text_that_looks_like_a_formula_stays_text(spark):
    out = io.BytesIO()
    reports.workbook(spark.createDataFrame([("=1+1", 0.5)], "product string, score double"), out, [("product", "P", 9, "plain"), ("score", "S", 9, "score")], "product", "score")
    with zipfile.ZipFile(out) as z:
        assert b"<f>" not in z.read("xl/worksheets/sheet1.xml")
