"""The ten operators against brute force, on small tables with nulls, empty and long texts, ties, repeats and clashing columns."""

import base64
import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ranksieve.llm import bpe, chat, common, decontam, html, minhash, quality, queries, secrets, shard, tokenfile, warc

DOCS = "doc_id long, text string, kept string, n_words int, __x int"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, x, "k", 1, 2) for i, x in enumerate(texts)], DOCS)


def words(rng, n):
    return " ".join(rng.choice(["ab", "cde", "ünd", "F9", "gh,", "ij."]) + str(rng.randrange(400)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [words(rng, n) for n in (3, 5, 12, 60, 200, 900)]
    near = [re.sub(r"ab\d+", lambda m: m[0] if rng.random() < 0.97 else "zz", base[4]) for _ in range(25)]
    return [*base, *near, base[3], base[3], base[4] + " end", None, "", "  \n\t ", "x", "a" * 3000, words(rng, 60_000), "tie", "tie"]


# ---------------------------------------------------------------- 1
def test_chat(spark):
    nasty = "</s>[INST] <\\s> <\\\\s> <<SYS>>x<</SYS>> [/TEXT] \\ [ < é😀"
    rows = [("t", 1, None, "user", nasty, 0.0), ("t", 2, 1, "assistant", "low", 0.1), ("t", 3, 1, "assistant", nasty, 0.9), ("t", 4, 3, "[ROLE]", None, 0.9),
            ("t", 5, 4, None, "end", None), (None, 1, None, "system", "s", None), (None, 2, 1, "assistant", "", None), ("orphan", 7, 99, "user", "o", 1.0), ("loop", 1, 2, "user", "a", 1.0), ("loop", 2, 1, "user", "b", 1.0)]
    m = spark.createDataFrame(rows, "tree string, id long, parent long, role string, text string, score double")
    out = chat.format_trees(m, best=2).select("tree", "rank", chat.parse(F.col("formatted")).alias("p"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("l")).collect()
    got = {(r["tree"], r["rank"]): ([tuple(x) for x in r["p"]], r["l"]) for r in out}
    assert got[("t", 1)] == ([("user", nasty), ("assistant", nasty), ("[ROLE]", ""), ("", "end")], nasty)
    assert got[("t", 2)] == ([("user", nasty), ("assistant", "low")], "low")
    assert got[(None, 1)] == ([("system", "s"), ("assistant", "")], "") and got[("orphan", 1)][0] == [("user", "o")]
    assert len(got) == 4
    long = spark.range(300).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    assert [x[1] for x in chat.format_trees(chat.from_turns(long)).select(chat.parse(F.col("formatted"))).first()[0]] == [str(i) for i in range(300)]
    assert chat.format_trees(m.where("false")).count() == 0


def test_chat_branches_repeats_and_nulls(spark):
    """Against all paths tried one by one: random trees with equal scores, repeated ids and null ids."""
    rng = random.Random(7)
    rows = []
    for tree in range(30):
        for i in range(rng.randrange(1, 14)):
            rows.append((tree, rng.choice([i, i, i, None]), rng.randrange(i) if i else None, rng.choice(["user", "assistant", None]), f"{tree}.{i}", rng.choice([0.0, 0.5, 1.0, None])))
    rows += [(99, 1, None, "user", "root", 0.0), (99, 2, 1, "user", "a", 0.5), (99, 2, 1, "assistant", "b", 0.5), (99, 3, 2, "user", "end", 0.5), (99, None, 3, "user", "after", 9.0)]
    df = spark.createDataFrame(rows, "tree int, id int, parent int, role string, text string, score double").withColumn("n", F.lit(1)).withColumn("said", F.lit("x"))
    out = chat.format_trees(df.repartition(3), best=100).select("tree", "rank", chat.parse(F.col("formatted")).alias("p"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("l")).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r["tree"], r["rank"])):
        got.setdefault(r["tree"], []).append([t["text"] for t in r["p"]])
        assert r["l"] == "".join(t["text"] for t in r["p"] if t["role"] == "assistant")
    stands = {(r["tree"], r["id"]): r["text"] for r in chat.numbered(df).where("id is not null").groupBy("tree", "id").agg(F.min(F.struct("said", "n", "text"))["text"].alias("text")).collect()}
    of = {r[4] if r[0] != 99 else (99, r[4]): r for r in rows}
    for tree in got:
        own = [r for r in rows if r[0] == tree]
        up = {r[4]: stands.get((tree, r[2])) if r[2] is not None else None for r in own}
        score = {r[4]: r[5] or 0.0 for r in own}
        want = []
        for r in own:
            if r[4] not in up.values():
                path = [r[4]]
                while up[path[0]] is not None:
                    path.insert(0, up[path[0]])
                want.append(path)
        assert sorted(got[tree]) == sorted(want), tree
        means = [sum(score[t] for t in p) / len(p) for p in got[tree]]
        assert all(a > b - 1e-12 for a, b in zip(means, means[1:], strict=False))
    assert len(of) == len(rows) and got[99][0][-1] == "after" and len(got[99]) == 2


# ---------------------------------------------------------------- 2
def test_decontaminate(spark, texts):
    items = [(1, " ".join(texts[5].split()[20:45])), (2, "x"), (3, None), (4, "..."), (5, " ".join(texts[3].split()[:10]).upper()), (6, " ".join(texts[4].split()[7:14])), (1, "tie"), (None, " ".join(texts[5].split()[300:330])), (9, " ".join(texts[5].split()[100:290]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (1 << 20, 200, 20):
        got = decontam.report(docs_of(spark, texts), bench, block_bytes=size).orderBy("doc_id").collect()
        for r, x in zip(got, texts, strict=True):
            want = decontam.brute(x, items)
            have = {"n_words": r["n_words"], "n_hit": r["n_hit"], "n_items": r["n_items"], "items_sha256": hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), "contaminated": r["contaminated"]}
            assert have == want
    assert decontam.clean(docs_of(spark, texts), bench.where("false")).columns == docs_of(spark, texts).columns
    assert decontam.report(docs_of(spark, texts).where("false"), bench).count() == 0


def test_decontaminate_by_joins(spark):
    """A passage that most items and documents hold, items of all lengths, clashing columns: both ways are as brute force."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(400)}"
    shared = [word() for _ in range(14)]
    items = [(i, " ".join([word() for _ in range(rng.randrange(8))] + (shared if i % 3 else []) + [word() for _ in range(rng.randrange(1, 6))])) for i in range(150)]
    items += [(150, None), (None, " ".join(shared)), (151, "...")] + [(i, items[i][1]) for i in range(20)]
    rows = []
    for i in range(120):
        own = [word() for _ in range(rng.randrange(40))]
        own[5:5] = shared if i % 4 else (items[i][1].upper().split() if i % 8 else [])
        rows.append((i, " ".join(own) if i % 11 else None, 7, "z"))
    rows += rows[:5] + [(500, " ".join(shared * 300), 1, "long"), (501, "", 1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __hits int, `__TRIES` string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((i, *decontam.brute(x, items).values()) for i, x, *_ in rows)
    assert len({w[2] for w in want}) > 3 and max(w[3] for w in want) > 90
    for size in (1 << 20, 600):
        got = decontam.report(df, bench, block_bytes=size).collect()
        told = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r["contaminated"]) for r in got)
        assert told == want, size
        left = decontam.clean(df, bench, block_bytes=size)
        assert left.columns == df.columns
        assert sorted(tuple(r) for r in left.fillna("").collect()) == sorted(tuple(x if x is not None else "" for x in r) for r in rows if not decontam.brute(r[1], items)["contaminated"])


def test_decontaminate_windows_of_one_hash(spark, monkeypatch):
    """Windows whose hashes collide are told apart by their bytes."""
    zero = lambda hashes, k: np.zeros(max(0, len(hashes) - k + 1), np.uint64)
    monkeypatch.setattr(common, "windows", zero)
    monkeypatch.setattr(decontam, "_at", lambda hashes, places, k: np.zeros(len(places), np.uint64))
    items = [("a", "one two"), ("b", "three four"), ("c", "one two"), (None, "three four")]
    index = decontam.Index(items)
    found = decontam.scan(pa.array(["x one two", "four three four", None, "two one"]), index)
    assert [(n, spans.tolist(), names) for n, spans, names in found] == [(3, [[1, 3]], {"a", "c"}), (3, [[1, 3]], {"b"}), (0, [], set()), (2, [], set())]


def test_decontaminate_a_full_block(spark):
    import pickle

    rng = random.Random(2)
    items = [(str(i), " ".join(f"w{rng.randrange(10**6)}" for _ in range(1000))) for i in range(1000)]
    size = sum(len(x) for _, x in items)
    index = decontam.Index(items)
    assert size > 7_000_000 and len(pickle.dumps(index)) < 6 * size
    bench = spark.createDataFrame(items, "item_id string, text string")
    own = [items[3][1], "x " + " ".join(items[700][1].split()[500:512]) + " y", "nothing here"]
    rows = [(i, x, 7, "z") for i, x in enumerate(own)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __hits int, __HITS_ string")
    assert [(r["n_hit"], r["items"]) for r in decontam.report(df, bench).orderBy("doc_id").collect()] == [(1000, ["3"]), (12, ["700"]), (0, [])]
    assert [tuple(r) for r in decontam.clean(df, bench).collect()] == [rows[2]]


# ---------------------------------------------------------------- 3
def brute_groups(texts, percent):
    sets = []
    for x in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in x or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j in range(i):
                b = sets[j]
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
        if root == [root[x] for x in root]:
            break
    return [(len(s), r) for s, r in zip(sets, root, strict=True)]


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates(spark, texts, percent):
    some = [x for x in texts if not x or len(x) < 20_000]
    got = minhash.groups(docs_of(spark, some), percent=percent).orderBy("doc_id").collect()
    want = brute_groups(some, percent)
    assert [(r["n_shingles"], r["component_id"]) for r in got] == want
    assert [r["kept"] for r in got] == [i == w[1] for i, w in enumerate(want)]


def test_near_duplicates_edges(spark, texts):
    rows = [(None, texts[3]), (7, texts[3]), (7, texts[3]), (7, texts[2]), (None, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.groups(df).collect())
    assert got == Counter({(7, 7, True): 3, (None, 7, False): 1, (None, None, False): 1, (3, 3, True): 1})
    assert minhash.groups(df.where("false")).count() == 0


def test_one_row_of_each_group_stays(spark, texts):
    a, b = texts[3], texts[4]
    rows = [(None, a, 1), (7, a, 2), (7, a, 3), (9, a, 4), (None, b, 5), (None, b, 6), (3, "", 7), (None, None, 8), (None, None, 9), (5, texts[2], 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __row int").withColumn("__dropped", F.lit("x"))
    got = minhash.keep(df.repartition(3))
    assert got.columns == df.columns
    kept = [tuple(r) for r in got.collect()]
    assert sorted(str(r[:2]) for r in kept) == sorted(str(r) for r in [(7, a), (None, b), (3, ""), (None, None), (None, None), (5, texts[2])])
    assert {r[2] for r in kept} > {7, 8, 9, 10} and all(r[3] == "x" for r in kept)


def test_texts_of_one_template(spark):
    """Each pair has 200 of 260 shingles in common; pairs within a posting list are not tried."""
    rng = random.Random(2)
    shared = [f"w{rng.randrange(10**6)}" for _ in range(204)]
    own = [" ".join([*shared[:102], *(f"u{i}x{j}" for j in range(26)), *shared[102:]]) for i in range(400)]
    own += [own[5] + " end", own[9]]
    got = {r["doc_id"]: r["component_id"] for r in minhash.groups(docs_of(spark, own)).collect()}
    assert [got[400], got[401]] == [5, 9] and all(got[i] == i for i in range(400))


# ---------------------------------------------------------------- 4
@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder.load(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def test_bpe(spark, texts, encoder):
    import tiktoken

    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=encoder.v.ranks, special_tokens={})
    own = [*texts, "  two  \n\n three\x1c \x85 é́😀don't 12345 <|endoftext|>", "　x​ "]
    got = bpe.encode(docs_of(spark, own), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, with_ids=True).orderBy("doc_id").collect()
    for r, x in zip(got, own, strict=True):
        ids = lib.encode_ordinary(x or "")
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(bpe.pack(ids)).hexdigest() and r["decoded_sha256"] == hashlib.sha256((x or "").encode()).hexdigest()


def test_bpe_tables_and_edits(encoder):
    rng, lib = random.Random(3), encoder.v
    for _ in range(400):
        s = bytes(rng.choice(b"abcdehlnorst iuTHE12\xc3\xa9") for _ in range(rng.randint(1, 20)))
        table = bpe.Table(lib, s[:5])
        table.append(s[5:])
        assert all(table.ids(n) == bpe.plain(lib, s[:n]) for n in range(len(s) + 1))
    doc = bpe.Document(encoder, "The quick brown fox")
    for _ in range(300):
        a = rng.randint(0, len(doc.text))
        b = min(len(doc.text), a + rng.randint(0, 3))
        doc.replace(a, b, rng.choice(["", " ", "  ", "\n", "ing", " the", "'s", "7", "é", "x y"]))
        assert bpe.pack(doc.ids()) == encoder.encode(doc.text)
    long = bpe.Document(encoder, "some words " * 2000)
    assert long.append("more") < 60 and long.replace(9000, 9001, "Z") < 60
    assert bpe.pack(long.ids()) == encoder.encode(long.text)


# ---------------------------------------------------------------- 5
def test_warc(spark):
    rows = [(1, "u1", "<p>é</p>"), (2, "u2", "<p>é</p>"), (3, None, None), (4, "u4", ""), (5, "u\r\n5", "\r\n\r\nWARC/1.1\r\n" * 3), (None, "n", "z"), (6, "u6", "w" * 300_000)]
    pages = spark.createDataFrame([(*r, 9) for r in rows], "page_id long, url string, html string, digest int")
    for least in (0, 5):
        folder = common.scratch(spark, "t")
        index = common.Stage(warc.write(pages, folder, min_bytes=least), "t").df
        got = {r["page_id"]: r for r in warc.read(index, folder).collect()}
        for page_id, url, text in rows:
            body, r = (text or "").encode(), got[page_id]
            same = [i for i, _, x in rows if i is not None and (x or "") == (text or "")]
            first = max(same, default=None) if len(body) >= least else page_id
            assert (r["payload_bytes"], r["payload_digest"]) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
            assert (r["record_type"], r["refers_to"]) == (("response", None) if page_id in (first, None) else ("revisit", first))
            assert r["record_type"] == "revisit" or r["html"] == (text or "")
        assert [r["page_id"] for r in warc.read(index.where("url = 'u4'"), folder).collect()] == [4]
    assert warc.write(pages.where("false"), common.scratch(spark, "t")).count() == 0


def test_warc_keeps_odd_ids_and_urls(spark):
    rows = [("", "a\nb ", "1"), ("x\r\ny: z", " u", "2"), ("<é 1>%41", "", "3"), (None, None, "3"), ("b", "%0A", "3")]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    folder = common.scratch(spark, "t")
    got = warc.read(common.Stage(warc.write(pages, folder), "t").df, folder, "string").collect()
    assert Counter((r["page_id"], r["url"]) for r in got) == Counter((i, u or "") for i, u, _ in rows)
    assert {r["page_id"]: r["refers_to"] for r in got if r["record_type"] == "revisit"} == {"<é 1>%41": "b", None: "b"}


def test_warc_copies_beyond_a_broadcast(spark, monkeypatch):
    """Digests that are dealt, the hottest ones broadcast, and payloads that stand for themselves."""
    rows = [(i, "u", "hot page") for i in range(40)] + [(100 + i, "u", f"p{i % 7}" * 3) for i in range(20)] + [(200, "u", "alone, but long"), (201, "u", ""), (202, "u", None), (None, "u", "hot page")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    want = [Counter(map(tuple, warc.roles(pages, min_bytes=least).collect())) for least in (0, 1)]
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(warc, "HOT", 0.3)
    assert [Counter(map(tuple, warc.roles(pages, min_bytes=least).collect())) for least in (0, 1)] == want


# ---------------------------------------------------------------- 6
def test_token_starts_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(tokenfile, "SHARD_BYTES", 50)
    df, folder = docs_of(spark, ["some words", None, "more of them"] * 40), common.scratch(spark, "t")
    index = common.Stage(tokenfile.write(df, folder, P.path("word_bpe_49k.json"), 1), "t").df
    want = sorted(map(tuple, tokenfile.read(index, folder).collect()))
    starts = [0]
    for r in want:
        assert r[1] == starts[-1]
        starts.append(r[1] + r[2])
    for block in (1, 3):
        monkeypatch.setattr(tokenfile, "BLOCK", block)
        monkeypatch.setattr(tokenfile, "BROADCAST_ROWS", 0)
        assert sorted(map(tuple, tokenfile.read(index, folder).collect())) == want
    assert index.select("shard").distinct().count() > 2


def test_token_files(spark, texts):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    own = [*texts, "İΣΑΣ <|endoftext|> é́ é don't 123　x\xa0y\x85z ﬁ DŽ", "日本 áb", "a <|endoftext|> b<|startoftext|>c <|EndOfText|>", "ȺɄ Ⱦx\x1fy \x00\x9a"]
    folder = common.scratch(spark, "t")
    df = docs_of(spark, own)
    index = common.Stage(tokenfile.write(df.orderBy(F.desc("doc_id")), folder, path, 1), "t").df
    start = 0
    for r, x in zip(tokenfile.read(index, folder).orderBy("doc_id").collect(), own, strict=True):
        ids = [*lib.encode(x or "", add_special_tokens=False).ids, 1]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    one = index.orderBy("shard").first()
    fs, at = tokenfile.filesystem(folder)
    reader = tokenfile.Reader(fs.open_input_file(f"{at}/{one['file']}"))
    ids, mask = reader.sequence(0)
    assert len(ids) == len(mask) == tokenfile.LENGTH
    assert tokenfile.write(df.where("false"), common.scratch(spark, "t"), path, 1).count() == 0


def test_word_encoder_equals_the_library():
    from tokenizers import Tokenizer

    path, rng = P.path("word_bpe_49k.json"), random.Random(1)
    encoder, lib = tokenfile.WordEncoder(path), Tokenizer.from_file(path)
    pool = [*map(chr, range(0x250)), *("abc 's't're <|endoftext|> '" * 12), *["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "'LL", "İ", "ẞ", "K", "\u0301", "日", "😀", "\u2028", "\x85", "ΑΣ"] * 12]
    own = ["".join(rng.choice(pool) for _ in range(rng.randrange(14))) for _ in range(3000)]
    assert all(encoder.encode(x).tolist() == lib.encode(x, add_special_tokens=False).ids for x in own)
    parts = {}
    for number, ids, _ in encoder.encode_all(own):
        parts.setdefault(number, []).extend(ids.tolist())
    assert [parts[k] for k in range(len(own))] == [lib.encode(x, add_special_tokens=False).ids for x in own]


# ---------------------------------------------------------------- 7
def test_shards(spark, texts):
    rng = random.Random(9)
    many = [*(t for t in texts if not t or len(t) < 20_000), *[words(rng, rng.randrange(60)) for _ in range(3000)], *["hot text"] * 1500, *["hot and long " * 30] * 300]
    got = shard.shards(docs_of(spark, many), 4).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(many)))
    by, sizes = {}, Counter()
    for r in got:
        raw = (many[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        by.setdefault(r["shard"], []).append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert set(by) == {0, 1, 2, 3} and all(sorted(x) == list(range(len(x))) for x in by.values())
    assert max(sizes.values()) < 1.1 * min(sizes.values())
    assert shard.shards(docs_of(spark, many).where("false")).count() == 0


def hold_shards(rows, docs, n, most):
    """The law: every document once, slots gapless, sizes within ``most`` of the mean."""
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((i, len((x or "").encode()) + 1, zlib.crc32((x or "").encode())) for i, x in docs)
    slots, sizes = {}, [0] * n
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    mean = sum(sizes) / n
    assert 2 - most <= min(sizes) / mean and max(sizes) / mean <= most, (min(sizes) / mean, max(sizes) / mean)


def test_shards_of_repeated_rows_and_few_texts(spark):
    rng = random.Random(9)
    rows = [(7, "the very same row")] * 4000 + [(i, "x" * rng.randrange(100)) for i in range(1499)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    hold_shards(shard.shards(df).collect(), rows, 16, 1.01)
    copies = [(i, "one text for all") for i in range(3000)] + [(None, None)] * 50
    hold_shards(shard.shards(spark.createDataFrame(copies, "doc_id long, text string")).collect(), copies, 16, 1.02)
    sized = [(i, "y" * int(10 ** (rng.random() * 4))) for i in range(1000)]
    hold_shards(shard.shards(spark.createDataFrame(sized, "doc_id long, text string").repartition(3)).collect(), sized, 16, 1.02)


def test_shards_of_documents_larger_than_a_shard(spark):
    assert shard._cuts([0, 0, 0, 0], 400) == [100, 200, 300] and shard._cuts([500, 0, 100, 0], 50) == [0, 25, 25]
    rows = [(1, "a" * 50_000), (2, "b" * 9000)] + [(i, "c" * 9) for i in range(3, 400)]
    got = shard.shards(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    a, b, third, most = sorted(sizes.values())
    assert len(got) == len(rows) and (third, most) == (9001, 50_001) and a + b == 3970 and b - a <= 20
    small = shard.shards(spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")).collect()
    assert len({r["shard"] for r in small}) == 2 and {r["slot"] for r in small} == {0}


def test_shards_query(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op7_shards(spark, "/root/testdata/sf0.01").collect()
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)}
    hold_shards(got, docs, 16, 1.02)


# ---------------------------------------------------------------- 8
def brute_secrets(x):
    a = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, m.end(), "assign") for m in a.finditer(x) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", x) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", x) if len(m[0]) >= 24]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))


def test_secrets(spark, texts):
    rng = random.Random(4)
    key = "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz123456789") for _ in range(40))
    own = [*texts, '😀é PassWord = "abcdef" token=token=abcdefgh secret=token" = abcdefgh api_key:12345', "AKIA" + "A1" * 8 + " AKIA123 xAKIAAKIA" + "B2" * 9, "0" * 23 + " " + "0f" * 12, f"see {key}!", f"x {'Ab1' * 10} y"]
    got = secrets.report(docs_of(spark, own)).orderBy("doc_id").collect()
    for r, x in zip(got, own, strict=True):
        want = brute_secrets(x or "")
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(r["spans"].split(","))
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [want.count(k) for k in ("assign:", "access:", "hex:")]
    assert got[-2]["spans"] == "entropy_base64:4:44" and got[-1]["spans"] == ""
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs_of(spark, own)).collect()}
    assert clean[len(own) - 2] == "see [SECRET]!" and clean[0] == own[0] and clean[texts.index(None)] is None


def test_secrets_are_found_whole(spark):
    rng = random.Random(8)
    draw = {k: "".join(rng.choice(a) for _ in range(40)) for k, a in (("mixed", "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz123456789"), ("small", "ghijkmnopqrstuvwxyz23456789"), ("capital", "GHJKLMNPQRSTUVWXYZ23456789"), ("letters", "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"))}
    path = "host/deploy/services/internal/deploy/services/internal/deploy/services/internal/"
    access, hexes = "AKIA" + "Q7" * 8, "0f1e2d3c" * 4
    own = [f"see {path * n}{draw['mixed']} end" for n in (1, 20)]
    own += [f"see {p}{draw[k]}, end" for k in ("small", "capital", "letters") for p in ("", "a/b-c/")]
    own += [f"{access}/{draw['mixed']} end", f"{draw['mixed']}-{access} end", f"{draw['mixed']}-{hexes}-{draw['mixed'][::-1]} end"]
    clean = secrets.redact(docs_of(spark, own), length=None).orderBy("doc_id").collect()
    for r, x in zip(clean, own, strict=True):
        assert not any(key[i : i + 8] in r["text"] for k in draw.values() for key in (k, k[::-1]) for i in range(33)), x
        assert r["text"].endswith(" end") and "[SECRET]" in r["text"]
    spans = {r["doc_id"]: r["spans"] for r in secrets.report(docs_of(spark, own)).collect()}
    assert spans[8] == "access:0:20,entropy_base64:20:61" and spans[9] == "entropy_base64:0:41,access:41:61"
    assert spans[10] == "entropy_base64:0:41,hex:41:73,entropy_base64:73:114"
    plain = ["Donaudampfschifffahrtsgesellschaft AbstractSingletonProxyFactoryBean", path, f"commit-{hexes}"]
    assert [r["spans"] for r in secrets.report(docs_of(spark, plain)).orderBy("doc_id").collect()] == ["", "", "hex:7:39"]


def brute_added(x):
    """All spans by trying every window of every candidate, without runs, counts or places summed up."""
    covered = [tuple(map(int, b.split(":")[1:])) for b in brute_secrets(x).split(",") if b]
    found = [(int(b.split(":")[1]), 0, int(b.split(":")[2]), b.split(":")[0]) for b in brute_secrets(x).split(",") if b]
    for k, (kind, (_, pattern, least)) in enumerate(secrets.CLASSES.items()):
        for m in re.finditer(pattern, x):
            v = m[0]
            if re.search(secrets.ALLOW_FORMS, v):
                continue
            parts = re.split(rf"(?i).{{0,{secrets.NEAR}}}(?:{secrets.ALLOW_WORDS}).{{0,{secrets.NEAR}}}", v)
            windows = [p[i : i + 20] for p in parts for i in range(len(p) - 19)]
            if any(-sum(n / 20 * np.log2(n / 20) for n in Counter(w).values()) >= least for w in windows):
                at = m.start()
                for a, b in sorted(covered):
                    if b > m.start() and a < m.end():
                        found += [(at, 4 + k, a, kind)] if at < a else []
                        at = max(at, b)
                found += [(at, 4 + k, m.end(), kind)] if at < m.end() else []
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))


def test_added_spans(spark, texts):
    rng, alphabets = random.Random(6), ["0123456789abcdef", "0123456789ABCDEF", "abcdefghijklmnopqrstuvwxyz234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-", "ab", "abcdefgh1", "AbC"]
    glue = [" ", "/", "-", "_", "=", ".", "é", "😀", "\n", "example", " token=", "AKIA", "", "xXxX"]

    def part():
        a = rng.choice(alphabets)
        return "".join(rng.choice(rng.choice(alphabets) if rng.random() < 0.05 else a) for _ in range(rng.randrange(60))) + rng.choice(glue)

    own = ["".join(part() for _ in range(rng.randrange(1, 9))) for _ in range(400)]
    own += ["a" * 64 + "7Zq9Xw3Lk8" + "mN1pQ2rS5tUv", "q" * 40 + "7Zq9Xw3Lk8Pq", "wkdjfhgbvncmxlsoqpeirutyaz" * 3 + "7Zq9Xw3Lk8", "".join(rng.choice(alphabets[4]) for _ in range(3000)), "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"]
    got = secrets.report(docs_of(spark, own)).orderBy("doc_id").collect()
    assert [r["spans"] for r in got] == [brute_added(x) for x in own]
    assert sum(":" in r["spans"] for r in got) > 100 and got[-3]["spans"] == "entropy_base64:0:88" and not got[-1]["spans"]


def test_secrets_beside_clashing_names(spark):
    rows = [(1, "see Ab3dE5gH7jK9mN1pQ2rSx", 7, "x", "y", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __base int, __spans string, `a``b` string, n_chars long")
    assert tuple(secrets.redact(df).first()) == (1, "see [SECRET]", 7, "x", "y", 12)


def test_entropy(spark):
    s = "aabbccddeeffgghhiijj0123456789abcdefghij"
    got = spark.range(1).select(secrets.entropy(F.lit(s), secrets.CLASSES["entropy_base64"][0])).first()[0]
    best = max(-sum(n / 20 * np.log2(n / 20) for n in Counter(s[i : i + 20]).values()) for i in range(len(s) - 19))
    assert abs(got - best) < 1e-9


@pytest.mark.parametrize("unit", ["a" * 21 + ". ", "token=abcdefgh ", "q7Zx9Ab3dE5gH7jK9mN1pQ2rS-" + "0f1e2d3c" * 3 + "-"])
def test_secrets_take_time_in_proportion(spark, unit):
    """Of the text's length, however many runs, base spans or spans beside each other it has; and all are found."""
    took, sizes = [], (1 << 18, 1 << 20)
    df = spark.createDataFrame([(size, unit * (size // len(unit))) for size in sizes], "doc_id long, text string").repartition(2)
    found, cleaned = secrets.report(df), secrets.redact(df, length=None)
    for size in sizes:
        x = unit * (size // len(unit))
        began = time.time()
        row = found.where(F.col("doc_id") == size).first()
        clean = cleaned.where(F.col("doc_id") == size).first()["text"]
        took.append(time.time() - began)
        spans = [s.split(":") for s in row["spans"].split(",") if s]
        kinds = Counter(k for k, _, _ in spans)
        n = size // len(unit)
        if unit.startswith("a"):
            assert not spans and clean == x
        elif unit.startswith("t"):
            assert kinds == {"assign": n} and clean == "[SECRET] " * n
        else:
            assert kinds == {"hex": n, "entropy_base64": n + 1} and clean == "[SECRET]" * (2 * n + 1)
    assert took[1] < 8 * max(took[0], 1.0), took


def test_running_totals(spark):
    rng = random.Random(3)
    rows = [[rng.randrange(100) for _ in range(n)] for n in (0, 1, 2, 63, 64, 65, 128, 4095, 4097, 70_000)]
    df = spark.createDataFrame([(x,) for x in rows], "v array<long>")
    for name, add in (("sum", lambda a, b: a + b), ("max", lambda a, b: F.greatest(a, b))):
        got = [r[0] for r in df.select(secrets.running(F.col("v"), add)).collect()]
        assert got == [(np.cumsum(x) if name == "sum" else np.maximum.accumulate(np.array(x, int))).tolist() for x in rows]


# ---------------------------------------------------------------- 9
def brute_quality(x):
    w = re.findall(r"[^\x20\x09-\x0D]+", x or "")
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    seen, hit, dup, lines = Counter(grams), set(), 0, []
    for i, g in enumerate(grams):
        if seen[g] > 1:
            hit.update(range(i, i + 5))
    for line in (x or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.append(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x or "")), dup, len(hit)


def test_quality(spark, texts):
    own = [*texts, "a b\na b\n\n \na b \na b", "one two three four five " * 3, "# $ % & | < > *" * 3, "l1 é\n" * 4 + "last"]
    for order in (quality.RULES, quality.RULES[::-1], quality.plan(docs_of(spark, own))):
        got = quality.measure(docs_of(spark, own), order).orderBy("doc_id").collect()
        for r, x in zip(got, own, strict=True):
            n, chars, sym, dup, rep = brute_quality(x)
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, sym, dup, rep)
            assert r["base_failed"] == (n < 10 or 100 * rep > 20 * n) and not (r["base_failed"] and r["kept"])
    kept = quality.keep(docs_of(spark, own), quality.RULES)
    assert kept.columns == docs_of(spark, own).columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if r["kept"]}
    assert quality.measure(docs_of(spark, own).where("false"), quality.plan(docs_of(spark, own).where("false"))).count() == 0


# ---------------------------------------------------------------- 10
def test_html(spark):
    body = "Some long paragraph, with commas, and enough words to score well in any page."
    page = f"""<html><head><title>T</title><style>p{{}}</style><script>var a="</p><p>no";</script></head><body><nav><a href=/>menu</a></nav>
    <div class="cookie-notice"><p>{body}</p></div><article><h1>Head &amp; title</h1><p><b>{body}<br>next<p>A&nbsp;&lt;b&gt; &#233; x</p><form>f</form><div class=ad>buy</div>
    <ul><li>one<li>two</ul></article><div id="comments"><p>{body} {body}</p></div><aside>{body}</aside><footer>&copy;</footer></body>"""
    want = f"Head & title {body} next A <b> é x one two"
    bare = f"<body><div><p>{body}</p><p>{body}</p></div><div><a href=x>{body}</a></div>"
    rows = [(1, page), (2, None), (3, ""), (4, "<p>x"), (5, "<script>never closed"), (6, bare), (7, "<<a <b & &amp &#xZ; >")]
    got = {r["page_id"]: r["text"] for r in html.main_text(spark.createDataFrame(rows, "page_id int, html string").withColumn("url", F.lit("u"))).collect()}
    assert got[1] == want and got[2] == got[3] == got[5] == "" and got[4] == "x" and got[6] == f"{body} {body}"


def test_html_keeps_long_nested_articles():
    long = "Some long paragraph, with commas, and, as it goes on, enough words to score three points. " * 4
    for tag in ("article", "main"):
        entry = f"<h1>Title</h1><div class=entry>{f'<p>{long}</p>' * 40}</div><ul><li>one<li>two</ul><p>Short end.</p><div class=ad>buy</div>"
        parts = f"<h1>Title</h1><section><p>Few words.</p></section><section>{f'<div><p>{long}</p></div>' * 40}</section><section><h2>Notes</h2><p>Short end.</p></section>"
        for body in (entry, parts):
            page = f"<body><nav>menu</nav><div><{tag}>{body}</{tag}></div><div><p>Outside.</p></div><footer>f</footer></body>"
            want = " ".join(re.sub(r"<div class=ad>buy</div>|<[^>]*>", " ", body).split())
            assert html.extract(page) == want
    two = f"<body><main><article><h1>A</h1><div>{f'<p>{long}</p>' * 40}</div></article><article><h1>B</h1><div>{f'<p>{long}</p>' * 30}</div></article></main></body>"
    assert html.extract(two) == " ".join(re.sub(r"<[^>]*>", " ", two).split())


def test_html_names_inside_articles():
    long = "Some long paragraph, with commas, and, as it goes on, enough words to score well. "
    kept = f'<h2 id="Related_work">Work</h2><section id="discussion"><p>{long}</p></section><div class="search-algorithms">Trees</div><h2 id="Advertising_revenue">Revenue</h2><p>so <math><mi>x</mi></math> holds</p>'
    gone = '<div class="ad-box">buy</div><div class="related"><a href=x>More of it</a></div><div class="search-box">Find<form>f</form></div>'
    want = " ".join(re.sub(r"</?(?:math|mi)>", "", kept).replace("<", " <").split())
    assert html.extract(f"<body><article><p>{long}</p>{kept}{gone}<p>End.</p></article></body>") == " ".join(f"{long}{re.sub(r'<[^>]*>', ' ', want)} End.".split())
    assert html.extract(f"<article><p>{long}<math>never closed</p><p>{long}</p></article>").count("Some long") == 2


def test_html_names_around_articles():
    body = "Some long paragraph, with commas, and enough words to score well in any page."
    part = f"<div><h1>Head</h1>{f'<p>{body}</p>' * 3}</div>"
    want = " ".join(["Head", *[body] * 3])
    for name in ("no-sidebar", "content has-sidebar", "layout-with-header", "post-with-comments", "page-ads-free", "social-science", "widget", "wrap comments-closed"):
        assert html.extract(f'<body><nav>menu</nav><div class="{name}">{part}</div><footer>f</footer>') == want, name
        assert html.extract(f'<body><form id="aspnetForm"><div id="{name}">{part}</div></form>') == want, name
    for name in ("sidebar", "left-sidebar", "page-footer", "cookie-notice box", "comments", "related", "site-header"):
        assert html.extract(f'<body>{part}<div class="{name}"><p>{body} {body}</p></div>') == want, name
    readers = f'<div class="comments">{f"<div><p>{body}</p></div>" * 9}</div>'
    assert html.extract(f"<body>{part}{readers}") == want == html.extract(f"<body><article>{part}</article>{readers}")


LONG = "Some long paragraph, with commas, and, as it goes on, enough words to score well. "


@pytest.mark.parametrize("tag", ["article", "main"])
@pytest.mark.parametrize(
    "part",
    ['<ol class="comment-list"><li class="comment"><p>BAD %s</p></li></ol>', '<div class="replies"><p>BAD %s</p></div>', '<div class="cookie-notice"><p>BAD %s</p></div>', '<div id="cookie-notice">BAD</div>',
     '<div class="related">BAD text</div>', '<div class="related-posts"><h3>BAD</h3><p>BAD</p></div>', '<div class="share">BAD</div>', '<div class="login-box">BAD</div>', '<div class="footer">BAD</div>',
     '<div class="sponsored-content">BAD %s</div>', "<ul><li><a href=x>BAD one</a><li><a href=y>BAD two</a></ul>", "<p>Go on.<button>BAD</button></p>", "<label>BAD</label>", "<button><div>BAD</div></button>",
     '<section id="comments"><p>BAD %s</p></section>', '<div class="comments"><article class="comment"><p>BAD %s%s%s</p></article></div>', '<div class="header">BAD</div>', "<form><p>BAD</p></form>", "<div role=alert>BAD</div>"],
)
def test_html_unwanted_parts_inside(tag, part):
    page = f"<body><div><{tag}><h1>Title</h1><p>{LONG}</p><p>{LONG}</p>{part.replace('%s', LONG)}<p>End.</p></{tag}></div></body>"
    text = html.extract(page)
    assert "BAD" not in text and text.startswith(f"Title {LONG.strip()} {LONG.strip()}") and text.endswith("End.")


def test_html_controls_and_comment_articles():
    assert html.extract(f'<body><article><h1>T</h1><p>{LONG}</p></article><article class="comment"><p>No {LONG * 3}</p></article></body>') == f"T {LONG.strip()}"
    assert html.extract(f'<article class="comment"><p>{LONG}</p></article>') == LONG.strip()
    assert html.extract("<p>ab<button>no</button> cd <b>e</b><label>no<p>f") == "ab cd e f"
    assert html.extract(f'<article><div class="header"><h1>Title</h1></div><p>{LONG}</p><ul><li>one<li><a href=x>two</a></ul></article>') == f"Title {LONG.strip()} one two"
    assert html.extract(f'<main><section id="related"><h2>Related</h2><p>{LONG}</p></section><p>{LONG}</p><div class="discussion"><p>Yes.</p></div></main>').count("Some long") == 2


def test_html_is_linear():
    body = "Some long paragraph, with commas, and enough words to score well in any page. "
    n = 40_000
    pages = ["<a " * 8 * n, "<div>" * 5 * n, "<div>text, x " * 2 * n, "<div>" * n + "<li></li>" * n, "<a '<b \"" * 2 * n, "<script " * 3 * n, "<!--" * 3 * n, "<td><tr>" + "<div>" * n + "<td></td>" * n, "<form>" * 3 * n + body, "<div>" * n + "</p>x" * n, "&" * 8 * n, "<" * 8 * n, "<button>x</label>" * n, "<ul><li>" * n]
    for page in pages:
        began = time.process_time()
        html.extract(page)
        assert time.process_time() - began < 5, page[:30]


# ---------------------------------------------------------------- pipeline
def test_pipeline(spark, tmp_path, texts):
    rng = random.Random(11)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(10_000)) for _ in range(80)) for _ in range(6)]
    leak = " ".join(good[5].split()[10:30])
    own = [*good, good[0], good[1] + " end", good[2] + ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" done', None, "", "few words"]
    spark.createDataFrame([(i, x, "en", "s", len(x or "")) for i, x in enumerate(own)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == {0, 1, 2, 3, 4} and all(r["decoded_sha256"] == hashlib.sha256(own[i].encode()).hexdigest() for i, r in got.items())
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns


def brute_pipeline(rows, items):
    """doc_id to text as the stages leave it: rules, groups, windows and spans tried one by one."""
    import tiktoken

    def passes(x):
        n, chars, symbols, dup, repeated = brute_quality(x)
        w = re.findall(r"[^\x20\x09-\x0D]+", x or "")
        lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", line)) for line in (x or "").split("\n"))
        doubled = sum(a == b for a, b in zip(w, w[1:], strict=False))
        return not (n < 10 or 100 * repeated > 20 * n or 10 * symbols > n or 2 * (x or "").count("!") > n or chars < 2 * n or chars > 20 * n or 10 * dup > 3 * lines or 10 * doubled > 3 * n)

    left = [(i, x) for i, x in rows if passes(x)]
    left = [left[k] for k, (_, root) in enumerate(brute_groups([x for _, x in left], 80)) if root == k]
    left = [(i, x) for i, x in left if not decontam.brute(x, items)["contaminated"]]
    out = {}
    for i, x in left:
        at, parts = 0, []
        for span in filter(None, brute_added(x).split(",")):
            _, a, b = span.split(":")
            if int(a) >= at:
                parts += [x[at : int(a)], "[SECRET]"]
            at = max(at, int(b))
        out[i] = "".join([*parts, x[at:]])
    ranks = bpe.Encoder.load(P.path("byte_bpe_50k.tiktoken"), P.PATTERN).v.ranks
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return {i: (lib.encode_ordinary(x), hashlib.sha256(x.encode()).hexdigest()) for i, x in out.items()}


def test_pipeline_against_brute_force(spark, tmp_path):
    rng = random.Random(12)
    base = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "Épsilon,"]) + str(rng.randrange(10_000)) for _ in range(rng.randrange(30, 150))) for _ in range(25)]
    draw = lambda a: "".join(rng.choice(a) for _ in range(40))
    letters = "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
    leak = " ".join(base[3].split()[5:25])
    own = list(base)
    own += [base[k] for k in (0, 0, 1)] + [base[k] + " end" for k in (2, 4)]
    for k in (5, 6, 7, 8):  # near copies on both sides of the similarity
        w = base[k].split()
        for at in range(0, len(w), rng.choice([12, 25, 60])):
            w[at] = "other"
        own.append(" ".join(w))
    own += [f"{base[9]} password = '{draw(letters)}' and {draw(letters + '0123456789')}, AKIA{'Q7' * 8} {base[10][:40]}", f"{draw('0123456789abcdef')} {base[11][: len(base[11]) // 2]}\n{draw('0123456789abcdef')}x", f"{base[12]} {leak}", leak.upper() + " and more of it"]
    own += [None, "", "few words", "# " * 60, base[13] + " !" * 90, "same words again and again " * 9, "\n".join([base[14][:50]] * 8), "a b c d e f g h i j k l", "x" * 300 + " y" * 12]
    rows = list(enumerate(own))
    rng.shuffle(rows)
    spark.createDataFrame([(i, x, "en", "s", len(x or "")) for i, x in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    items = [(1, leak), (2, None), (3, "...")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    want = brute_pipeline(sorted(rows, key=lambda r: r[0]), items)
    got = {r["doc_id"]: (r["ids"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == want
    assert 20 < len(want) < len(own) - 15 and sum(hashlib.sha256((own[i] or "").encode()).hexdigest() != d for i, (_, d) in want.items()) == 2
