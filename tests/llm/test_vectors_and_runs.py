"""Whitening, SimHash groups and periodic runs against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from array import array
from fractions import Fraction

import numpy as np
import pytest
import xxhash

from ranksieve.llm import periodic, queries, simhash, whiten

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


# ---------------------------------------------------------------- 11
def brute_whitening(vectors):
    """n, exact deviations and the covariance of x, by fractions."""
    xs = [[math.floor(Fraction(v) * 1024) + 100_000 for v in row] for row in vectors]
    n, d = len(xs), len(xs[0])
    s = [sum(x[j] for x in xs) for j in range(d)]
    dev = [sum((n * x[j] - s[j]) ** 2 for j in range(d)) for x in xs]
    y = [[Fraction(n * x[j] - s[j], n) for j in range(d)] for x in xs]
    cov = np.array([[float(sum(r[a] * r[b] for r in y) / n) for b in range(d)] for a in range(d)])
    return n, dev, y, cov


def hold_whitening(rows, vectors, k):
    n, dev, y, cov = brute_whitening(vectors)
    values, comps = np.linalg.eigh(cov)
    values, comps = values[::-1], comps[:, ::-1]
    centred = np.array([[float(v) for v in r] for r in y])
    got = {}
    for r in rows:
        assert r["n"] == n and r["deviation"] == (dev[r["vec_id"]] if dev[r["vec_id"]] < 1 << 63 else None) and abs(r["identity_error"]) < 1e-9
        assert abs(r["explained"] / (values[r["component"] - 1] / np.trace(cov)) - 1) < 1e-9
        got.setdefault(r["component"], {})[r["vec_id"]] = r["whitened"]
    assert sorted(got) == list(range(1, k + 1)) and all(len(x) == n for x in got.values())
    for c, own in got.items():
        want = centred @ comps[:, c - 1] / np.sqrt(values[c - 1])
        have = np.array([own[i] for i in range(n)])
        assert min(abs(have - want).max(), abs(have + want).max()) < 1e-6 * abs(want).max()


@pytest.mark.parametrize("size", [1.0, 3e4, 1e9])
def test_whitening(spark, size):
    rng = random.Random(3)
    vectors = [[rng.gauss(0, size * (1 + j)) + size for j in range(10)] for _ in range(60)]
    vectors += [vectors[0], vectors[0]]
    odd = [(100, None), (101, []), (102, [1.0] * 9), (103, [1.0] * 9 + [None]), (104, [NAN] * 10), (105, [0.0] * 9 + [-INF])]
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in [*enumerate(vectors), *odd]], "vec_id long, embedding array<double>, n int, vector string").repartition(5)
    hold_whitening(whiten.whiten(df).collect(), vectors, 8)
    hold_whitening(whiten.whiten(df.coalesce(1), components=3).collect(), vectors, 3)


def test_whitening_odd_tables(spark):
    kind = "vec_id long, embedding array<float>"
    assert whiten.whiten(spark.createDataFrame([], kind)).count() == 0
    assert whiten.whiten(spark.createDataFrame([(1, None), (2, [])], kind)).count() == 0
    one = whiten.whiten(spark.createDataFrame([(None, [1.0, 2.0])], kind)).collect()
    assert [tuple(r) for r in one] == [(None, k, 1, 0, None, None, None) for k in (1, 2)]
    flat = whiten.whiten(spark.createDataFrame([(1, [1.0, 2.0, 0.5]), (2, [1.0, 3.0, 0.5]), (2, [1.0, 3.0, 0.5])], kind)).collect()
    assert [r["whitened"] is None for r in sorted(flat, key=lambda r: r["component"])] == [False] * 3 + [True] * 6
    assert {round(r["explained"], 9) for r in flat} == {0.0, 1.0} and all(r["identity_error"] < 1e-9 for r in flat)
    huge = whiten.whiten(spark.createDataFrame([(1, [1e300]), (2, [-1e300])], "vec_id long, embedding array<double>")).collect()
    assert [r["deviation"] for r in huge] == [None, None] and {round(r["whitened"], 9) for r in huge} == {1.0, -1.0}


def test_residues_tell_numbers_apart():
    for bound in (1, 10**9, 10**40):
        moduli = whiten.enough(bound)
        assert math.prod(moduli) > 2 * bound and math.prod(moduli[:-1]) <= 2 * bound + 1 and all(p < 1 << 20 for p in moduli)
    assert all(math.gcd(a, b) == 1 for a, b in itertools.combinations(whiten.primes(12), 2))


def test_whitening_query(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    place = {r["vec_id"]: i for i, r in enumerate(table)}
    rows = [r.asDict() | {"vec_id": place[r["vec_id"]]} for r in queries.op11_whitening(spark, SF).collect()]
    hold_whitening(rows, [r["embedding"] for r in table], 8)


# ---------------------------------------------------------------- 12
def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(fps, ids):
    """Smallest id reachable over all pairs of at most two differing bits."""
    a = np.array(fps, np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= 2
    label = np.array(ids)
    while True:
        new = np.where(near, label[None, :], np.iinfo(np.int64).max).min(1)
        if (new == label).all():
            return label.tolist()
        label = new


def test_simhash_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    fps = [brute_fingerprint(r["text"]) for r in docs]
    want = {(r["doc_id"], f"{f:016x}", m) for r, f, m in zip(docs, fps, brute_components(fps, [r["doc_id"] for r in docs]), strict=True)}
    got = [tuple(r) for r in queries.op12_simhash(spark, SF).collect()]
    assert set(got) == want and len(got) == len(docs)


def test_simhash_cases(spark):
    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(150_000))
    texts = [None, "", " \n\t", "One", "one", "a b", "a b c", "A B\x0bC", "é É x", "a\x85b c d", long, long.upper(), long + " end", "x " * 3]
    df = spark.createDataFrame([(i, t, "p", 1) for i, t in enumerate(texts)] + [(None, "one", "p", 1), (None, "none but this", "p", 1), (3, "One", "p", 1)], "doc_id long, text string, fp string, rep int")
    fps = [brute_fingerprint(t) for t in texts]
    got = simhash.groups(df.repartition(3)).collect()
    want = brute_components(fps, range(len(texts)))
    assert {(r["fingerprint"], r["component_id"]) for r in got if r["doc_id"] is not None} == {(f"{f:016x}", m) for f, m in zip(fps, want, strict=True)}
    assert [r["component_id"] for r in sorted((r for r in got if r["doc_id"] is None), key=lambda r: r["component_id"] is None)] == [3, None] and len(got) == 17
    assert simhash.groups(df.where("false")).count() == 0


def test_anchor_codes():
    """Every value has one anchor within the radius, and shares one with whatever is near it."""
    golay, hamming = simhash._codes()
    assert (golay.upto[:, 0] == 1).all() and (hamming.upto[:, 0] == 1).all() and golay.upto.sum() > 0
    assert int(golay.upto[:, 2].sum()) == sum(math.comb(23, k) for k in range(6))
    rng = random.Random(2)
    for code, bits in ((golay, 23), (hamming, 18)):
        for _ in range(300):
            x = rng.getrandbits(bits)
            for flips in (1, 2):
                y = x
                for k in rng.sample(range(bits), flips):
                    y ^= 1 << k
                _, home, excess = code.anchors(np.array([x]), np.array([0]))
                _, posted, _ = code.anchors(np.array([y]), np.array([flips]))
                assert list(excess) == [0] and home[0] in posted


@pytest.mark.parametrize("crowd", [4096, 40, 3])
def test_simhash_links(spark, crowd, monkeypatch):
    """Whatever is split: random values, neighbours at every distance up to 5, and a dense ball."""
    rng = random.Random(5)
    fps = {0, (1 << 64) - 1}
    for _ in range(60):
        x = rng.getrandbits(64)
        fps.add(x)
        for flips in (1, 2, 2, 3, 4, 5):
            y = x
            for k in rng.sample(range(64), flips):
                y ^= 1 << k
            fps.add(y)
            x = y if rng.random() < 0.3 else x
    center = rng.getrandbits(64)
    for a, b in itertools.combinations(range(0, 64, 2), 2):
        fps.add(center ^ 1 << a ^ 1 << b)
    fps = sorted(fps)
    monkeypatch.setattr(simhash, "CROWD", crowd)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(4)
    found = [(r["a"], r["b"]) for r in simhash.links(df).collect()]
    root = {x: x for x in signed}
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 4 for a, b in found)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in found:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    want = brute_components(fps, range(len(fps)))
    mine = [top(x) for x in signed]
    assert len(set(zip(want, mine, strict=True))) == len(set(want)) == len(set(mine))


# ---------------------------------------------------------------- 13
def brute_runs(w, least):
    out = []
    for q in range(1, len(w) // 2 + 1):
        k = 0
        while k + q < len(w):
            b = k
            while k + q < len(w) and w[k] == w[k + q]:
                k += 1
            size = k - b + q
            if size >= max(least, 2 * q) and not any(w[b : b + size - r] == w[b + r : b + size] for r in range(1, q)):
                out.append((b, size, q))
            k += k == b
    return sorted(out)


def test_runs_are_all_runs():
    for n in range(11):
        for w in itertools.product((0, 1), repeat=n):
            assert periodic.runs(w, 2) == brute_runs(list(w), 2)
    rng = random.Random(1)
    for _ in range(1500):
        n, k = rng.randrange(1, 70), rng.randrange(1, 5)
        w = [rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.5:
            a, p = rng.randrange(n), 1 + rng.randrange(n)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        assert periodic.runs(w, 5) == brute_runs(w, 5)
        ids, found = np.array(w, np.int64), []
        for a, b in periodic.stretches(ids, np.zeros(n, int)):
            found += [(s + a, size, p) for s, size, p in periodic.runs(ids[a:b])]
        assert sorted(found) == brute_runs(w, 12)


def recursive(step, n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, step(a, b)
    return b[:n]


@pytest.mark.parametrize("n", [1000, 30_000])
def test_comparisons_stay_few(n):
    rng = random.Random(4)
    made = {
        "one": [0] * n, "two": [0, 1] * (n // 2) + [2], "fibonacci": recursive(lambda a, b: b + a, n), "thue": [bin(i).count("1") & 1 for i in range(n)],
        "squares": recursive(lambda a, b: b + b + [len(b)], n), "nested": recursive(lambda a, b: b + [len(b)] + b, n), "binary": [rng.randrange(2) for _ in range(n)],
        "many": [rng.randrange(1000) for _ in range(n)], "powers": [rng.randrange(90) for _ in range(n // 9)] * 9,
    }
    for name, w in made.items():
        for v in (array("i", w), array("i", [-x for x in w])):
            few = 3 + math.log2(n) / 2 if name in ("fibonacci", "thue", "squares", "nested") else 3
            assert periodic.edges(v)[2] <= few * n, name


def row_of(w, i):
    found = brute_runs(w, 12)
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    gone = {k for s, size, q in found for k in range(s + q, s + size)}
    said = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    kept = " ".join(x for k, x in enumerate(w) if k not in gone)
    return (i, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_periodic_query(spark):
    """Against every period tried, with the rewriting stated anew."""
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want, some = set(), set()
    for r in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        h = zlib.crc32(str(r["doc_id"]).encode())
        g, n = h // 10, len(w)
        if n > 3000:
            continue  # too slow for brute force
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        some.add(r["doc_id"])
        want.add(row_of(w, r["doc_id"]))
    got = [tuple(r) for r in queries.op13_periodic_runs(spark, SF).collect()]
    assert {r for r in got if r[0] in some} == want and len(got) == len(docs)
    assert sum(r[1] > 0 for r in want) > 5


def test_periodic_cases(spark):
    rng = random.Random(8)
    plain = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    texts = [None, "", " \n", "x", "a " * 11, "a " * 12, "a b c d e f " * 2, "a b c d e f " * 2 + "a", " ".join(plain), " ".join(plain[:50] + plain[20:50] * 3 + plain),
             "é ü " * 9 + "x " + "é ü " * 9, "A a " * 6, ("a b a b c " * 4 + "d ") * 3, "a\x85b c\x0bd " * 7]
    df = spark.createDataFrame([(i, t, "h", 1) for i, t in enumerate(texts)] + [(None, "a " * 12, "h", 1), (5, "a " * 12, "h", 1)], "doc_id long, text string, start string, h int")
    want = [row_of(re.findall(r"[^\x20\x09-\x0D]+", t or ""), i) for i, t in enumerate(texts)]
    got = [tuple(r) for r in periodic.report(df).collect()]
    assert got[: len(texts)] == want and got[-2] == (None, *want[5][1:]) and got[-1] == want[5]
    more = periodic.report(df, with_runs=True).where("doc_id = 10").first()
    assert [tuple(x) for x in more["runs"]] == brute_runs(texts[10].split(), 12) and more["collapsed"] == "é ü x é ü"
    low = periodic.report(df.where("doc_id in (3, 6)"), least=2).collect()
    assert [r["n_runs"] for r in low] == [0, 1]
    assert periodic.report(df.where("false")).count() == 0
    same = periodic.with_periods(df.where("doc_id is null or text is null"))
    assert same.columns == df.columns and sorted((r["text"] or "") for r in same.collect()) == ["", "a " * 12]
    step = ["a"] + [f"b{i}" for i in range(40_000)]
    giant = spark.createDataFrame([(1, " ".join(step * 3 + ["z"]))], "doc_id long, text string")
    assert [(r["n_runs"], r["start"], r["length"], r["period"]) for r in periodic.report(giant).collect()] == [(1, 0, 120_003, 40_001)]
