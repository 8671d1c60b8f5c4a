"""Remote files, readers, caches and sinks, against small files and stand-in services."""

import io
import json
import sys
import threading
import zipfile
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ranksieve.functions import text as t
from ranksieve.operators import batching, chunking, documents, embedding, notices, ranking, scoring
from ranksieve.plans import diagnosis, payload
from ranksieve.sources import files, listing, remote, tables

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not import tests


def item(seq, kind="Edital", **more):
    return {"sequencialDocumento": seq, "titulo": f"t{seq}", "tipoDocumentoNome": kind, "url": f"u{seq}", "dataPublicacaoPncp": "2026-01-01"} | more


def test_patient_waits_double_with_jitter_and_give_up():
    waits, answers = [], iter([(429,), (503,), (200, "x")])
    assert remote.patient(lambda: next(answers), 5, 2.0, waits.append, lambda: 0.5) == (200, "x") and waits == [3.0, 5.0]
    assert remote.patient(lambda: (404,), 5, 2.0, waits.append, lambda: 0.5) == (404,) and len(waits) == 2
    assert remote.patient(lambda: (500,), 3, 1.0, waits.append, lambda: 0.0) is None and waits[2:] == [1.0, 2.0, 4.0]


NOTICES = "numero string, cnpj string, year int, seq int, date string"


def answer(cnpj, year, seq):
    return {
        1: (200, [item(1), item(2, "Termo de Referência", statusAtivo=True), item(3, statusAtivo=False), item(4, statusAtivo=None), item(5, "Outros Documentos")]),
        2: (204, None), 3: (404, None), 4: (500, None), 5: (200, []), 6: (200, [item(9, "DFD")]),
    }[seq]


def notices_of(spark, *seqs):
    return spark.createDataFrame([(f"N{i}", "c", 2026, i, "d") for i in seqs], NOTICES)


HOW = {"attempts": 2, "wait": 0.0, "sleep": lambda s: None, "jitter": lambda: 0.0}
AT = ("cnpj", "year", "seq")


def test_listings(spark):
    got = remote.listings(notices_of(spark, 1, 2, 3, 4, 5), "numero", AT, lambda: answer, **HOW).orderBy("numero", "file_ord").collect()
    assert [(r["numero"], r["seq"], r["kind"], bool(r["erro"])) for r in got] == [("N1", 1, "Edital", False), ("N1", 2, "Termo de Referência", False), ("N1", 5, "Outros Documentos", False), ("N3", None, None, True), ("N4", None, None, True)]
    cache = remote.listings(notices_of(spark, 1), "numero", AT, lambda: answer, **HOW)
    asked = []

    def never_one(cnpj, year, seq):
        assert seq != 1
        return answer(cnpj, year, seq)

    every, new = remote.cached_listings(notices_of(spark, 1, 6, 3), cache, "numero", AT, lambda: never_one, **HOW)
    assert Counter(r["numero"] for r in every.collect()) == {"N1": 3, "N6": 1, "N3": 1} and not asked
    assert [r["numero"] for r in new.collect()] == ["N6"]


def test_downloads_fail_alone(spark, tmp_path):
    def fetch(url):
        return {"u1": (200, b"one", "real%20name.txt"), "u2": (404, None, None), "u3": (503, None, None), "u4": (200, b"", None)}[url]

    rows = spark.createDataFrame([("N", i, f"u{i}" if i < 5 else None, "ti/tle.txt") for i in range(1, 6)], "numero string, seq int, url string, title string")
    out = remote.downloads(rows, lambda: fetch, **HOW)
    got = {r["seq"]: r for r in out.collect()}
    assert [bytes(got[i]["content"]) if got[i]["content"] is not None else None for i in range(1, 6)] == [b"one", None, None, b"", None]
    assert [got[i]["erro"] is None for i in range(1, 6)] == [True, False, False, True, False] and got[1]["file_name"] == "real%20name.txt"
    remote.archive(out, str(tmp_path / "raw"), "numero")
    assert {r["name"] for r in spark.read.parquet(str(tmp_path / "raw")).collect()} == {"1_real name.txt", "4_title.txt".replace("title", "tle")}


def test_pool_keeps_connections():
    seen = []

    class Handler(BaseHTTPRequestHandler):
        protocol_version = "HTTP/1.1"

        def do_GET(self):
            seen.append((self.path, self.client_address[1]))
            moved = self.path == "/old"
            body = b"" if moved else json.dumps([item(1)]).encode()
            self.send_response(302 if moved else 200)
            self.send_header("Location" if moved else "Content-Disposition", "/new" if moved else 'attachment; filename="a b.pdf"')
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    try:
        assert remote.http_list(base)()("c", 2026, 7)[1][0]["url"] == "u1"
        assert remote.http_fetch()()(f"{base}/old")[::2] == (200, "a b.pdf")
        assert listing.http_fetch({"url": f"{base}/page", "pagina": 2})[0] == 200
    finally:
        server.shutdown()
        server.server_close()
    assert [x[0] for x in seen] == ["/c/compras/2026/7/arquivos", "/old", "/new", "/page?pagina=2"] and len({x[1] for x in seen[:3]}) == 1
    assert remote.http_fetch(1)()("http://127.0.0.1:1/gone")[0] == 503 and listing.http_fetch({"url": base, "a": 1})[0] == 503


def test_notices_to_chunks(spark, tmp_path):
    fetched = []

    def fetch(url):
        fetched.append(url)
        return (200, ("DO OBJETO\n" + f"text of {url} " * 9).encode(), f"{url}.txt") if url != "u2" else (404, None, None)

    def run(rows, cached):
        hold, old = notices.split(rows, cached, "numero", "date")
        return hold, old, *notices.fetched(old, "numero", "date", AT, lambda: answer, lambda: fetch, archive=str(tmp_path / "raw"), staging=str(tmp_path / "stage"), **HOW)

    empty = spark.createDataFrame([], "numero string, date string, chunks array<string>, ord long")
    hold, old, new, failed = run(notices_of(spark, 1, 2, 3), empty)
    got = {r["numero"]: r["chunks"] for r in new.collect()}
    assert set(got) == {"N1", "N2"} and got["N2"] == [] and len(got["N1"]) == 1 and got["N1"][0].count("u1") == 9 and "u5" not in got["N1"][0]
    assert Counter(r["numero"] for r in failed.collect()) == {"N3": 1, "N1": 1} and notices.skipped(failed) == 2
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 2  # u5 is archived, though it is no main document
    watched, seen = notices.watched(new)
    notices.save(watched, str(tmp_path / "chunks"))
    assert seen.get == {"done": 2, "chunks": 1}
    cached = spark.read.parquet(str(tmp_path / "chunks"))
    hold, old = notices.split(notices_of(spark, 1, 2, 3, 6).withColumn("date", F.when(F.col("numero") == "N2", "later").otherwise(F.col("date"))), cached, "numero", "date")
    assert [r["numero"] for r in hold.collect()] == ["N1"] and {r["numero"] for r in old.collect()} == {"N2", "N3", "N6"}


def test_readers(spark, tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path)

    for day in ("2026-01-02", "2026-01-01"):
        write(f"days/editais_{day}.json", json.dumps([{"n": f"{day}a"}, {"n": "é"}], indent=1))
        write(f"base/e_{day}.json", json.dumps({"metadados": {"titulo": "t"}, "editais": [{"n": day}]}))
    schema = StructType.fromDDL("n string")
    assert [tuple(r) for r in files.day_files(spark, str(tmp_path / "days"), schema).orderBy("dia", "ord").collect()] == [("2026-01-01", 0, "2026-01-01a"), ("2026-01-01", 1, "é"), ("2026-01-02", 0, "2026-01-02a"), ("2026-01-02", 1, "é")]
    assert [tuple(r) for r in files.embedded_days(spark, f"{tmp_path}/base/e_*.json", schema).orderBy("dia").collect()] == [("2026-01-01", 0, "2026-01-01"), ("2026-01-02", 0, "2026-01-02")]

    write("profile/B.md", "# B\n## Aplicações típicas\n- um\n\n- dois\n## Tecnologias e termos relacionados\nfoo")
    write("profile/A.md", "- x\n  -  y \ntext\n- z")
    write("profile/notes.txt", "- no")
    assert [tuple(r) for r in files.profiles(spark, str(tmp_path / "profile")).where("name = 'B'").select("unit", "text").orderBy("unit").collect()] == [(0, "um"), (1, "dois"), (2, "foo")]
    assert [r["text"] for r in files.priority_profiles(spark, str(tmp_path / "profile")).where("name = 'A'").orderBy("unit").collect()] == ["x", "y", "z"]

    write("cache/a.json", json.dumps({"hash": "h", "modelo": "m", "unidades": [{"texto": "x", "vetor": [1.0]}]}))
    write("cache/b.json", json.dumps({"hash": "k", "unidades": [{"texto": "y", "vetor": [2]}]}))
    assert {tuple(r)[:5] for r in files.profile_cache(spark, str(tmp_path / "cache")).collect()} == {("a", "h", "m", 0, "x"), ("b", "k", "", 0, "y")}
    lines = [{"modelo": "m", "hash": "h", "vetor": [1.0]}, {"modelo": "o", "hash": "h", "vetor": [9.0]}, {"modelo": "m", "hash": "h", "vetor": [2.0]}]
    path = write("v.jsonl", "\n\n".join(map(json.dumps, lines)) + "\n")
    assert [tuple(r) for r in files.vector_cache(spark, path, "m").collect()] == [("h", [2.0])]

    write("chunks/a_1.json", json.dumps({"dataAtualizacaoGlobal": "d", "chunks": ["x", "y"]}))
    write("chunks/b.json", '{"dataAtualizacaoGlobal": "d", "chunks": ["x')
    write("chunks/c.json", "{}")
    assert {r["name"]: (r["date"], r["chunks"]) for r in files.chunk_files(spark, str(tmp_path / "chunks")).collect()} == {"a_1": ("d", ["x", "y"]), "c": ("", [])}

    path = write("said/j.json", json.dumps({"a.b/1": {"ia_aderente": True, "justificativa_ia": "ok"}, "old": "plain", "none": {}}))
    yes, why = payload.verdict(F.col("verdict"), "-")
    assert {r[0]: (r[1], r[2]) for r in files.verdicts(spark, path).select("key", yes, why).collect()} == {"a.b/1": (True, "ok"), "old": (None, "plain"), "none": (None, "-")}
    assert files.verdicts(spark, str(tmp_path / "nowhere")).count() == 0

    for name in ("N_1/7_b.txt", "N_1/7_a.txt", "N_1/12_c.pdf", "N_1/readme", "N_2/7_z.txt"):
        write(f"docs/{name}", name)
    assert sorted((r["folder"], r["sequential"], r["name"]) for r in files.documents(spark, str(tmp_path / "docs")).collect()) == [("N_1", 7, "7_b.txt"), ("N_1", 12, "12_c.pdf"), ("N_2", 7, "7_z.txt")]
    assert files.settings("# c\n\nA=1\nB = x=y\nno\n", {"A": "0"}) == {"A": "0", "B": "x=y"}

    rows = spark.createDataFrame([("a", 0, 0.5, True), ("b", 1, 0.9, None), ("c", 2, 0.5, True), ("d", 3, 0.7, True)], "n string, ord int, s double, selecionado boolean")
    assert [r["n"] for r in files.selected(rows, "s", 2).collect()] == ["d", "a"]
    assert [r["n"] for r in files.selected(rows, "s", 2, flag=None, skip=1).collect()] == ["d", "a"]


def test_day_tables_replace_their_days_only(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_day(spark.createDataFrame([("1", "a"), ("2", "b")], "dia string, x string"), path)
    tables.write_day(spark.createDataFrame([("2", "c")], "dia string, x string"), path)
    assert {(str(r["dia"]), r["x"]) for r in spark.read.parquet(path).collect()} == {("1", "a"), ("2", "c")}
    rows = spark.createDataFrame([("3", 4, 1, 0, "{}", None), ("3", 4, 2, None, None, "no answer")], "dia string, category int, page int, ord int, item string, error string")
    tables.write_collected(rows, str(tmp_path / "items"), str(tmp_path / "errors"))
    assert spark.read.parquet(str(tmp_path / "items")).count() == 1 and spark.read.parquet(str(tmp_path / "errors")).first()["page"] == 2
    marked = ranking.mark(spark.createDataFrame([(0, 0.5, "p"), (1, 0.9, "q")], "ord int, score double, product string"), 1)
    assert [tuple(r) for r in tables.triage_rows(marked).orderBy("position").collect()] == [(1, 0.9, "q", True, 1), (0, 0.5, "p", False, 2)]


def test_profile_vectors_embed_changed_files_only(spark, tmp_path):
    units = spark.createDataFrame([("a", "h1", 0, "x"), ("a", "h1", 1, "yy"), ("b", "h2", 0, "zzz")], "name string, hash string, unit int, text string")
    cached = spark.createDataFrame([("a", "h1", "m", 0, "x", [7.0]), ("a", "h1", "m", 1, "yy", [8.0]), ("b", "old", "m", 0, "q", [9.0])], "name string, hash string, modelo string, unit int, text string, vector array<double>")

    def client():
        return lambda texts: [[float(len(x))] for x in texts]

    every, new = embedding.profile_vectors(units, cached, "m", client)
    assert {(r["name"], r["unit"], r["vector"][0]) for r in every.collect()} == {("a", 0, 7.0), ("a", 1, 8.0), ("b", 0, 3.0)} and new.count() == 1
    assert embedding.profile_vectors(units, cached, "other", client)[1].count() == 3
    tables.write_profile_cache(every, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3
    assert embedding.too_many_tokens(400, '{"error_code": "TOO_MANY_TOKENS_IN_BATCH"}') and not embedding.too_many_tokens(400, "[]") and not embedding.too_many_tokens(400, "oops")
    assert embedding.slow_client(lambda x: x).most == 250


def test_office_files_and_failures(spark):
    def zipped(parts):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, body in parts.items():
                z.writestr(name, body)
        return out.getvalue()

    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    docx = zipped({"word/document.xml": f"<w:document {w}><w:body><w:p><w:r><w:t>Um </w:t><w:t>dois</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>cell</w:t></w:r></w:p></w:tc></w:tr></w:tbl><w:p><w:r><w:t>três</w:t></w:r></w:p></w:body></w:document>"})
    s = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    xlsx = zipped({"xl/sharedStrings.xml": f"<sst {s}><si><t>shared</t></si></sst>", "xl/worksheets/sheet1.xml": f'<worksheet {s}><sheetData><row><c t="s"><v>0</v></c><c><v>4.5</v></c><c/><c t="inlineStr"><is><t>own</t></is></c></row></sheetData></worksheet>'})
    deep = b"x"
    for k in range(8):
        deep = zipped({("a.txt" if k == 0 else "d.zip"): deep})
    rows = [(1, "A.DOCX", docx), (2, "b.xlsx", xlsx), (3, "bad.docx", b"PK"), (4, "z.zip", zipped({"in.txt": "in", "bad.pdf": b"no", "o.docx": docx})), (5, "deep.zip", deep)]
    df = spark.createDataFrame(rows, "k int, name string, content binary").withColumn("__found", F.lit(1)).withColumn("__one", F.lit(2))
    got = {}
    for r in documents.extract(df).orderBy("k", "text_ord").collect():
        got.setdefault(r["k"], []).append(r["text"])
    assert got == {1: ["Um dois\ntrês\ncell"], 2: ["shared\n4.5\nown"], 4: ["in", "Um dois\ntrês\ncell"]}
    assert Counter(r["k"] for r in documents.failures(df).collect()) == {3: 1, 4: 1, 5: 1}


def test_ranking_in_ranges(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SAMPLE", 64)
    monkeypatch.setattr(ranking, "RANGE_ROWS", 50)
    rows = [(i, [0.5, 0.5, 0.25 + i % 7 / 100, None, -1.0][i % 5]) for i in range(1000)]
    df = spark.createDataFrame(rows, "ord int, score double").withColumn("__bucket", F.lit("x")).repartition(7)
    got = ranking.mark(df, 10).orderBy("position").collect()
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [(r["ord"], r["position"], r["selected"], r["__bucket"]) for r in got] == [(o, i, i <= 10, "x") for i, (o, _) in enumerate(want, 1)]


def test_scores_are_not_rounded(spark):
    profile = spark.createDataFrame([("A", 0, [1.0, 0.0]), ("B", 1, [1.0, 4e-5])], "name string, unit int, vector array<double>")
    items = spark.createDataFrame([(0, [1.0, 3e-5]), (1, [0.0, 0.0]), (2, None), (3, [-1.0, 0.0])], "ord int, vector array<double>")
    best = {r["ord"]: (r["product"], r["score"]) for r in scoring.triage(items.where("ord <> 2"), profile).collect()}
    assert best[0][0] == "B" and 0 < 1 - best[0][1] < 1e-9 and best[1] == ("A", 0.0)
    dense = {r["ord"]: (r["product"], r["score"]) for r in scoring.dense(items, profile).collect()}
    assert dense[2] == ("A", 0.0) and all(dense[k][0] == best[k][0] and abs(dense[k][1] - best[k][1]) < 1e-12 for k in best)
    with pytest.raises(ValueError):
        scoring.dense(items, profile.where("false"))
    with pytest.raises(ValueError):
        scoring.small(spark.range(scoring.PROFILE_ROWS + 1))


def test_dense_goes_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(scoring, "BLOCK", 3)
    profile = spark.createDataFrame([(f"p{i}", i, [float(i % 4), 1.0]) for i in range(10)], "name string, unit int, vector array<double>")
    items = spark.createDataFrame([(i, [1.0, i / 3]) for i in range(9)], "ord int, vector array<double>")
    want = {r["ord"]: r["product"] for r in scoring.triage(items, profile).collect()}
    assert {r["ord"]: r["product"] for r in scoring.dense(items, profile).collect()} == want


def test_long_texts_are_cut_in_linear_time(spark):
    text = "\n".join(f"{'CABEÇALHO' if i % 50 == 0 else 'linha de texto comum'} {i}" for i in range(40_000))
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    assert df.select(F.size(chunking.sections(F.col("text")))).first()[0] == 800


def test_greedy_null_keys_and_tokens(spark):
    rows = spark.createDataFrame([(None, 0, 3), (None, 1, None), ("g", 0, 3), (None, 2, 3), ("g", 1, 3)], "g string, o int, t int")
    assert sorted((r["g"] or "", r["o"], r["batch"]) for r in batching.greedy(rows, "g", "o", "t", 10, 5).collect()) == [("", 0, 0), ("", 1, 0), ("", 2, 1), ("g", 0, 0), ("g", 1, 1)]


def test_small_functions(spark):
    head = spark.createDataFrame([('attachment; filename="a b.pdf"', "a b.pdf"), ("inline; filename=x.txt", "x.txt"), ("inline", None), (None, None)], "h string, x string")
    assert all(a == b for a, b in head.select(t.header_file_name(F.col("h")), "x").collect())
    wait = spark.range(4).select(batching.backoff(F.col("id"), 2.0, 10.0), batching.backoff(F.col("id"), 2.0, jitter=F.lit(0.5))).collect()
    assert [tuple(r) for r in wait] == [(2.0, 3.0), (4.0, 5.0), (8.0, 9.0), (10.0, 17.0)]
    keys = spark.createDataFrame([(f"k{i}",) for i in range(50)], "k string")
    assert [r[0] for r in ranking.stable_sample(keys, "k", 5).collect()] == [r[0] for r in ranking.stable_sample(keys.repartition(5), "k", 5).collect()]
    assert embedding.indexed({"data": [{"index": 1, "embedding": [2]}, {"index": 0, "embedding": [1]}]}) == [[1], [2]] and embedding.in_order({"embeddings": [{"values": [1]}]}) == [[1]]
    asked = payload.prompt("{objeto}|{texto}|{x}", F.col("a"), F.col("b"), "none")
    assert [r[0] for r in spark.createDataFrame([("o", "{objeto}"), (None, "")], "a string, b string").select(asked).collect()] == ["o|{objeto}|{x}", "|none|{x}"]
    assert payload.collection(3, "2026-01-31") == {"periodo": "31/01/2026", "total_coletado": 3}
    judged = spark.createDataFrame([("b", '{"ia_aderente": true}', None), ("a", '{"x": "é"}', None), ("c", None, "failed")], "k string, veredito string, erro string")
    assert list(json.loads(payload.verdict_map(judged, "k"))) == ["a", "b"]
    none = diagnosis.throughput(spark.createDataFrame([(1, 503, None, 0.0), (2, 200, 10, 2.0)], "level int, status int, bytes long, seconds double")).orderBy("level").collect()
    assert [(r["mb_per_s"], r["gain"], r["efficiency"], r["transient"]) for r in none] == [(0.0, 0.0, 0.0, 1), (10 / 1_048_576 / 2, 0.0, 0.0, 0)]


def test_ranking_stream(spark, tmp_path):
    from ranksieve.streaming.reprocess import keep_ranking

    schema = StructType.fromDDL("item string, score double, ord int")
    src = tmp_path / "in"
    src.mkdir()

    def go():
        keep_ranking(spark.readStream.schema(schema).json(str(src)), str(tmp_path / "scores"), str(tmp_path / "best"), str(tmp_path / "cp"), n=2).awaitTermination()
        return [r["item"] for r in spark.read.parquet(str(tmp_path / "best")).orderBy("position").collect()]

    (src / "1.json").write_text('{"item":"a","score":0.5,"ord":0}\n{"item":"b","score":0.4,"ord":1}\n{"item":"c","score":0.4,"ord":2}\n')
    assert go() == ["a", "b"]
    (src / "2.json").write_text('{"item":"a","score":0.1,"ord":0}\n{"item":"d","score":0.9,"ord":3}\n')
    assert go() == ["d", "b"]


def test_vector_stream_appends_once(spark, tmp_path):
    from ranksieve.streaming.reprocess import append_vectors

    schema = StructType.fromDDL("modelo string, hash string, vector array<double>")
    src = tmp_path / "in"
    src.mkdir()

    def go():
        append_vectors(spark.readStream.schema(schema).json(str(src)), str(tmp_path / "cache"), str(tmp_path / "cp")).awaitTermination()
        return sorted((r["modelo"], r["hash"]) for r in spark.read.parquet(str(tmp_path / "cache")).collect())

    (src / "1.json").write_text('{"modelo":"m","hash":"a","vector":[1]}\n{"modelo":"m","hash":"a","vector":[2]}\n{"modelo":"o","hash":"a","vector":[3]}\n')
    assert go() == [("m", "a"), ("o", "a")]
    (src / "2.json").write_text('{"modelo":"m","hash":"a","vector":[4]}\n{"modelo":"m","hash":"b","vector":[5]}\n')
    assert go() == [("m", "a"), ("m", "b"), ("o", "a")]


def test_embed_keeps_rows_together(spark):
    rows = spark.createDataFrame([(1, "a", 9), (2, None, 8), (3, "ccc", 7)], "id int, text string, n int")
    got = embedding.embed(rows, lambda: lambda texts: [[float(len(x))] for x in texts]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "a", 9, [1.0]), (2, None, 8, None), (3, "ccc", 7, [3.0])]
    with pytest.raises(Exception, match="0 vectors for"):
        embedding.embed(rows, lambda: lambda texts: []).collect()


def test_characters_of_files(spark):
    local = spark.createDataFrame([("i", 1, "a.PDF"), ("i", 2, "b.txt")], "item string, seq int, name string")
    texts = spark.createDataFrame([("i", 2, "abc"), ("i", 2, "de")], "item string, seq int, text string")
    listed = spark.createDataFrame([("i", 1, "k"), ("i", 2, "k"), ("i", 3, "k")], "item string, seq int, kind string")
    out = diagnosis.presence(listed, diagnosis.characters(local, texts)).orderBy("seq").collect()
    assert [(r["on_disk"], r["extension"], r["chars"]) for r in out] == [(True, ".pdf", 0), (True, ".txt", 5), (False, None, 0)]
