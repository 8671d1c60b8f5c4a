"""Near-duplicate groups by a signature-coordinate inverted join.

A document's set holds its distinct WIDTH-word shingles (A-Z as a-z), as 64-bit hashes. The
signature is a one-permutation MinHash: a shingle's upper bits name its coordinate, each
coordinate keeps its least hash, and that hash, which contains the coordinate, is the token a
document is posted under. Of U coordinates that either of two documents fills, those with equal
tokens are a draw without replacement from the union of the sets; so a pair of similarity t shares
fewer than ``least_shared`` tokens with a probability of at most MISS, by the hypergeometric law.

1. Documents with equal sets form a class; classes, not copies, are compared.
2. Tokens are counted. A class's tokens are ordered rarest first; sharing m of e tokens means
   sharing one of the first e-m+1 (prefix), so only those are posted, and only if two classes have them;
   the m-1 longest lists of a class are skipped.
3. In each posting list the most central class is pivot; every other is paired with it once. Collisions
   of a pair are counted, the skipped lists being probed for it alone; pairs with enough of them are
   confirmed on full sets; confirmed ones are links.
4. Lists that components leave whole are done with. Classes of the other lists are joined once more, on
   prefixes of their full sets: rarest shingles first, of two sets of n <= m shingles the smaller one is
   posted under its first n - ceil(2tn/(1+t)) + 1 and looked up by the larger one's first m - ceil(tm) + 1, which
   every link has in common. Pairs of different components whose places allow a link are
   confirmed. So no pair of different components goes untried, pairs inside one are never made, and texts
   of one template that stay below the similarity, however many, have only shingles of their own there.
5. Components come from label propagation with pointer jumping.

Nothing is collected to the driver but counts. Tables between steps go to the shared folder.

Cases: null, empty and blank texts have the empty set and are linked with nothing (component_id =
doc_id, kept); texts of fewer than WIDTH words are one shingle; repeated rows fall into one class;
a null doc_id takes part in groups and gets their component_id, and is never ``kept``; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as c

WIDTH = 5
#: Coordinates of a signature; a power of two.
COORDINATES = 128
#: Highest probability that a pair at the threshold shares fewer tokens than are asked for.
MISS = 1e-6
#: Most rows that are broadcast (ids or digests of at most 24 bytes).
BROADCAST_ROWS = 200_000
#: Rows of a posting list that one task compares with.
LIST_BLOCK = 1024
#: Largest set that is compared whole within the join of step 4, as 31-bit hashes, of which so many may coincide.
FINE, SLACK = 512, 2
#: Part of all rows that a class's copies may be before its rows are joined apart, so there are at most 1/HOT such classes.
HOT = 0.001

_WORDS = c.Words(c.SPACED, fold=True)
_log_factorials = np.zeros(1)


def _log_choose(n: int, k: np.ndarray | int) -> np.ndarray:
    """Logarithms of binomial coefficients; -inf where there is none."""
    global _log_factorials
    if n >= len(_log_factorials):
        _log_factorials = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 2 * n + 2)))])
    f, k = _log_factorials, np.asarray(k)
    ok = (k >= 0) & (k <= n)
    k = np.where(ok, k, 0)
    return np.where(ok, f[n] - f[k] - f[n - k], -np.inf)


@lru_cache(maxsize=1 << 17)
def least_shared(filled: int, size: int, percent: int) -> int:
    """Tokens that a class with ``filled`` of them and ``size`` shingles shares with any linked one, but for MISS."""
    union = 100 * size // percent
    k = np.arange(filled + 1)
    chance = np.exp(_log_choose(size, k) + _log_choose(union - size, filled - k) - _log_choose(union, filled))
    return max(1, int(np.searchsorted(np.cumsum(chance), MISS, side="right")))


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of one document's words."""
    if not len(hashes):
        return np.zeros(0, c.U64)
    return np.unique(c.windows(hashes, min(WIDTH, len(hashes))))


def _sets(column: pa.Array):
    data, offs = c.text_bytes(column)
    for i, j in c.groups(offs):
        _, _, hashes, bounds = _WORDS.table_of(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
        for d in range(j - i):
            yield shingles(hashes[bounds[d] : bounds[d + 1]])


def _digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _lists(parts: list[np.ndarray], kind) -> pa.Array:
    offs = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(flat.view(np.int64), kind))


def sketches(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 85, coordinates: int = COORDINATES) -> DataFrame:
    """doc_id, n (set size), cls (digest of the set, null if empty), least (``least_shared``), tokens."""
    shift = c.U64(64 - int(math.log2(coordinates)))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, cls, least, tokens = [], [], [], []
        for s in _sets(batch.column(1)):
            n.append(len(s))
            cls.append(_digest(s))
            own = s >> shift
            first = np.concatenate([[True], own[1:] != own[:-1]]) if len(s) else np.zeros(0, bool)
            tokens.append(s[first])
            least.append(least_shared(len(tokens[-1]), len(s), percent) if len(s) else 0)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(least, pa.int32()), _lists(tokens, pa.int64())], ["doc_id", "n", "cls", "least", "tokens"])

    ids = docs.schema[id_col].dataType.simpleString()
    return c.map_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), run, f"doc_id {ids}, n long, cls binary, least int, tokens array<long>")


def _small(df: DataFrame) -> DataFrame:
    """The table, to be broadcast if it is seen to have at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if c.sizes_within(df, BROADCAST_ROWS) else df


def _full_sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text: str) -> c.Stage:
    """node and items (its full set) of the classes in ``wanted``, read anew from one document of each."""
    need = c.Stage(wanted.select("node").distinct().join(nodes.select("node", "cls", "rep"), "node"), "minhash-need")
    ids = _small(need.df.select(F.col("rep").alias("__rep")).distinct())
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).join(ids, F.col("doc_id").eqNullSafe(F.col("__rep")), "left_semi")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = list(_sets(batch.column(1)))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([_digest(s) for s in sets], pa.binary()), _lists(sets, pa.int64())], ["doc_id", "cls", "items"])

    ids_type = docs.schema[id_col].dataType.simpleString()
    found = c.map_batches(texts, run, f"doc_id {ids_type}, cls binary, items array<long>")
    full = need.df.join(found, (F.col("rep").eqNullSafe(F.col("doc_id"))) & (need.df["cls"] == found["cls"])).select("node", "items").dropDuplicates(["node"])
    out = c.Stage(full, "minhash-sets")
    need.drop()
    return out


def _confirm(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) of classes, those whose full sets reach the similarity."""
    left = pairs.join(full.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
    both = left.join(full.select(F.col("node").alias("b"), F.col("items").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y")).cast("long")
    return c.Stage(both.where(100 * shared >= percent * (F.size("x") + F.size("y") - shared)).select("a", "b"), "minhash-links").df


def _by_rarity(sets: DataFrame, keys: list[str], own: str) -> DataFrame:
    """keys and s: what two or more of the rows have of the array ``own``, as (often, token), rarest first."""
    tokens = sets.select(*keys, F.explode(own).alias("token"))
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    return tokens.join(often, "token").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("often", "token"))).alias("s"))


def _open_pairs(sets: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that the prefixes of their full sets and the places in them leave open."""
    sized = sets.select("node", F.size("items").alias("n"), "items")
    shared = _by_rarity(sized, ["node", "n"], "items").join(label, "node", "left")
    alone = F.col("n") - F.size("s")  # shingles that no other set has come first
    index = F.col("n") - F.ceil(2 * percent * F.col("n") / (100 + percent)) + 1
    probe = F.col("n") - F.ceil(percent * F.col("n") / 100) + 1
    posts = shared.select("node", "n", F.coalesce("label", "node").alias("label"), (index - alone).alias("index"), alone.alias("alone"), F.posexplode(F.slice("s.token", 1, F.greatest(F.lit(0), probe - alone).cast("int"))))
    posts = posts.select("node", "n", "label", (F.col("pos") < F.col("index")).alias("posted"), (F.col("pos") + F.col("alone") + 1).alias("at"), F.col("col").alias("token"))
    posts = c.Stage(posts, "minhash-prefixes")
    sizes = posts.df.groupBy("token", "label").agg(F.count(F.lit(1)).alias("k"))
    mixed = sizes.groupBy("token").agg(F.max(F.struct("k", "label")).alias("m"), F.sum("k").alias("k"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
    mixed = mixed.select("token", F.col("m.label").alias("major"), F.ceil(F.col("k") / LIST_BLOCK).cast("int").alias("blocks"))
    listed = c.Stage(posts.df.join(mixed, "token").withColumn("minor", F.col("label") != F.col("major")), "minhash-lists")
    whole = F.when(F.col("n") <= FINE, F.transform("items", lambda v: v.bitwiseAND(0x7FFFFFFF).cast("int")))
    detail = sized.select("node", whole.alias("fine"))
    x = listed.df.where("posted").join(detail, "node").select("token", F.col("node").alias("a"), F.col("label").alias("ca"), F.col("n").alias("na"), F.col("at").alias("ia"), F.col("fine").alias("fa"), "minor", "blocks")
    y = listed.df.join(detail, "node").select("token", F.col("node").alias("b"), F.col("label").alias("cb"), F.col("n").alias("nb"), F.col("at").alias("ib"), F.col("fine").alias("fb"), F.col("minor").alias("other"), "blocks")

    def block(of: str) -> Column:
        return F.pmod(F.xxhash64(of), F.col("blocks")).cast("int").alias("block")

    def every() -> Column:
        return F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")

    smaller = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    most = F.least("ia", "ib") + F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib"))
    needed = percent * (F.col("na") + F.col("nb"))  # a hundred and percent times what a link has in common
    shared = F.size(F.array_intersect("fa", "fb")).cast("long") + SLACK
    close = F.when(F.col("fa").isNotNull() & F.col("fb").isNotNull(), (100 + percent) * shared >= needed).otherwise(F.lit(True))
    fits = smaller & (F.col("ca") != F.col("cb")) & ((100 + percent) * most >= needed) & close
    # of two classes one at least is outside the list's largest component
    one = x.where("minor").select("*", every()).join(y.select("*", block("b")), ["token", "block"]).where(fits)
    two = x.where("not minor").select("*", block("a")).join(y.where("other").select("*", every()), ["token", "block"]).where(fits)
    out = c.Stage(one.select("a", "b").union(two.select("a", "b")).distinct(), "minhash-rest")
    posts.drop()
    listed.drop()
    return out.df


def components(links: DataFrame) -> DataFrame:
    """node and label (the smallest node it reaches), for nodes that stand in links (a, b)."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now = c.Stage(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).select(F.col("a").alias("node"), "label"), "components")
    while True:
        near = both.join(now.df.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = now.df.join(near, "node").select("node", F.least("label", "near").alias("to"), F.col("label").alias("was"))
        ahead = now.df.select(F.col("node").alias("to"), F.col("label").alias("ahead"))
        new = c.Stage(step.join(ahead, "to").select("node", F.least("to", "ahead").alias("label"), "was"), "components")
        now.drop()
        moved = new.df.where("label <> was").limit(1).count()
        now, now_df = new, new.df.select("node", "label")
        if not moved:
            return now_df
        now.df = now_df


def groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 85, coordinates: int = COORDINATES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row for each document."""
    sk = c.Stage(sketches(docs, id_col, text, percent, coordinates), "minhash-sketches")
    nodes = sk.df.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    nodes = c.Stage(nodes.withColumn("node", F.monotonically_increasing_id()), "minhash-nodes").df

    # tokens that two classes have, and from them what each class posts
    one = sk.df.join(nodes, (sk.df["cls"] == nodes["cls"]) & sk.df["doc_id"].eqNullSafe(nodes["rep"])).select("node", "n", "least", F.size("tokens").alias("filled"), "tokens")
    posts = _by_rarity(one, ["node"], "tokens").join(one.select("node", "n", "least", "filled"), "node").dropDuplicates(["node"])
    prefix = F.greatest(F.lit(0), F.col("filled") - F.col("least") + 1 - (F.col("filled") - F.size("s")))
    posts = posts.where(F.size("s") >= F.col("least")).select(
        "node", "n", "least", F.col("s.token").alias("own"), prefix.alias("prefix"), F.aggregate("s.often", F.lit(0).cast("long"), lambda a, x: a + x).alias("central")
    ).where("prefix > 0")
    posts = c.Stage(posts, "minhash-posts")
    listed = posts.df.select("node", "central", F.explode(F.slice("own", 1, F.col("prefix"))).alias("token"))

    # pivots; skipped lists are probed for their pairs
    pivot = listed.groupBy("token").agg(F.max(F.struct("central", "node")).alias("p"), F.count(F.lit(1)).alias("k")).where("k > 1")
    pairs = listed.join(pivot, "token").where("node <> p.node").select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct()
    x = posts.df.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("least").alias("la"), F.col("own").alias("oa"))
    y = posts.df.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("least").alias("lb"), F.col("own").alias("ob"))
    fits = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (F.size(F.array_intersect("oa", "ob")) >= F.greatest("la", "lb"))
    pairs = c.Stage(pairs.join(x, "a").join(y, "b").where(fits).select("a", "b"), "minhash-pairs")
    full = _full_sets(pairs.df.select(F.explode(F.array("a", "b")).alias("node")), nodes, docs, id_col, text)
    links = _confirm(pairs.df, full.df, percent)
    label = components(links)
    full.drop()

    # what pivots have left open
    labelled = listed.join(label, "node", "left").select("token", "node", F.coalesce("label", "node").alias("label"))
    mixed = labelled.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    some = c.Stage(listed.select("token", "node").join(mixed, "token").select("node").distinct(), "minhash-open")
    full = _full_sets(some.df, nodes, docs, id_col, text)
    rest = _open_pairs(full.df, label, percent)
    if rest.limit(1).count():
        more = _confirm(rest, full.df, percent)
        if more.limit(1).count():
            label = components(links.union(more))
    for stage in (posts, pairs, some, full):
        stage.drop()

    # a label for every class, then for every document; classes of very many copies are looked up apart
    named = nodes.join(label, "node", "left").select("cls", "rep", "copies", F.coalesce("label", "node").alias("label"))
    least = named.groupBy("label").agg(F.min("rep").alias("component"))
    of = c.Stage(named.join(least, "label").select(F.col("cls").alias("of"), "component", "copies"), "minhash-groups").df
    many = F.lit(HOT) * (of.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]) < F.col("copies")
    hot, rows = F.broadcast(of.where(many)), sk.df.select("doc_id", "n", "cls")  # fewer than 1/HOT
    out = rows.join(hot, F.col("cls") == F.col("of"), "left_anti").join(of.where(~many), F.col("cls") == F.col("of"), "left").unionByName(rows.join(hot, F.col("cls") == F.col("of")))
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def keep(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """One document of each group, with all its columns: of the least id, null last, and of such rows any one.

    Documents with the empty set are in no group and all stay.
    """
    dropped, row = c.free_names(docs, "dropped", "row")
    found = c.Stage(groups(docs, id_col, text, percent), "minhash-found")
    if found.df.where("n_shingles > 0").groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1 or doc_id is null").limit(1).count():
        # ids do not tell rows apart, so rows get numbers
        docs = c.Stage(docs.withColumn(row, F.monotonically_increasing_id()), "minhash-rows").df
        by_row = groups(docs, row, text, percent).where("n_shingles > 0").select(F.col("doc_id").alias("r"), "component_id")
        ids = docs.select(F.col(row).alias("r"), F.col(c.quoted(id_col)).alias("id"))
        first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "r"))
        named = c.Stage(by_row.join(ids, "r"), "minhash-named").df
        one = named.groupBy("component_id").agg(first.alias("f")).select(F.col("f.r").alias("r"))
        gone = named.join(one, "r", "left_anti").select(F.col("r").alias(dropped))
        id_col = row
    else:
        gone = found.df.where("not kept and n_shingles > 0").select(F.col("doc_id").alias(dropped))
    gone = c.Stage(gone, "minhash-dropped")
    found.drop()
    return docs.join(_small(gone.df), F.col(c.quoted(id_col)) == F.col(dropped), "left_anti").drop(row)
