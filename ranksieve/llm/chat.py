"""Chat formatting of reply trees, with DataFrame functions only.

Messages (tree, id, parent, role, text, score) form trees. Pointer doubling, that is self-joins of
a node's ancestor 1, 2, 4, ... steps up, gives every node its depth and the sum of scores to its
root in as many joins as the depth has binary digits. Leaves rank by that sum's mean; the chosen
leaves' paths are read off the same pointers, each node once. A path becomes one conversation:

    system <<SYS>>text<</SYS>>, user [INST]text[/INST], assistant <s>text</s>,
    any other role [ROLE]role[/ROLE][TEXT]text[/TEXT]

In texts and roles the first character of a control string is followed by a backslash (and by
one more for each that stands there already), so ``parse`` gives back every text exactly.

Cases: null texts, roles and scores count as '', '' and 0; a parent that is null or not there makes its child
a root; of rows that repeat a (tree, id) one, the same in every run, stands for the id, and replies go on from it,
while the others are turns without replies; so are rows with a null id; nodes on a cycle have no root and are
left out; a null tree is a tree; other columns are not read; empty tables give empty results; the longest
path sets the size of a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as c

#: What is escaped inside texts.
_TAILS = r"/?s>|</?SYS>>|/?(?:INST|ROLE|TEXT)\]"
_TURN = r"(?s)<<SYS>>.*?<</SYS>>|\[INST\].*?\[/INST\]|<s>.*?</s>|\[ROLE\].*?\[/ROLE\]\[TEXT\].*?\[/TEXT\]"
_MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}


def escape(x: Column) -> Column:
    return F.regexp_replace(x, rf"([<\[])(\\*)({_TAILS})", r"$1\\$2$3")


def unescape(x: Column) -> Column:
    return F.regexp_replace(x, rf"([<\[])\\(\\*)({_TAILS})", "$1$2$3")


def _marks(role: Column) -> tuple[Column, Column]:
    open_, close = F.concat(F.lit("[ROLE]"), escape(role), F.lit("[/ROLE][TEXT]")), F.lit("[/TEXT]")
    for r, (a, b) in _MARKS.items():
        open_, close = F.when(role == r, F.lit(a)).otherwise(open_), F.when(role == r, F.lit(b)).otherwise(close)
    return open_, close


def from_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Messages of linear conversations: each row replies to the one before it."""
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    own = rows.select(F.col(conv).alias("tree"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    own = own.withColumn("id", F.row_number().over(order).cast("long"))
    return own.select("tree", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def numbered(messages: DataFrame) -> DataFrame:
    """The messages as nodes: n, a number of each row, and a hash of what it says, beside its columns; a written table."""
    own = messages.select("tree", "id", "parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    said = F.xxhash64("parent", "role", "text", "score")
    return c.Stage(own.withColumns({"said": said, "n": F.monotonically_increasing_id()}), "chat-messages").df


def paths(nodes: DataFrame, best: int = 1) -> DataFrame:
    """tree, rank, depth, n: the nodes of the ``best`` best root-to-leaf paths of each tree of ``numbered`` messages."""
    base = nodes.select("n", "tree", "id", "parent", "said", "score")
    heads = base.where("id is not null").groupBy(F.col("tree").alias("t"), F.col("id").alias("i")).agg(F.min(F.struct("said", "n"))["n"].alias("up"))
    linked = base.where("parent is not null").join(heads, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("i")), "left").select("n", "up", "score")
    roots = base.where("parent is null").select("n", F.lit(None).cast("long").alias("up"), "score")
    first = linked.unionByName(roots).select("n", "up", F.lit(1).cast("long").alias("steps"), F.col("score").alias("total"))
    first = c.Stage(first, "chat-nodes").df

    # up: the ancestor 2**k steps above; steps and total: what lies from the node to just below it.
    # Only nodes with such an ancestor go into the next join; the others are at their root.
    levels, active, ended, size = [], first.where("up is not null"), first.where("up is null"), first.count()
    while (1 << len(levels)) <= size and active.limit(1).count():
        levels.append(active)
        above = active.union(ended).select(F.col("n").alias("of"), F.col("up").alias("further"), F.col("steps").alias("s"), F.col("total").alias("sum"))
        joined = active.join(above, F.col("up") == F.col("of"))
        now = c.Stage(joined.select("n", F.col("further").alias("up"), (F.col("steps") + F.col("s")).alias("steps"), (F.col("total") + F.col("sum")).alias("total")), "chat-level").df
        active, ended = now.where("up is not null"), ended.union(now.where("up is null"))

    parents = first.where("up is not null").select(F.col("up").alias("n")).distinct()
    leaves = ended.join(parents, "n", "left_anti").join(base.select("n", "tree", "id", "said"), "n")
    order = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("steps")), "id", "said", "n")
    found = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).select("tree", "rank", "n", F.col("steps").alias("depth"))
    for k in reversed(range(len(levels))):
        more = found.join(levels[k].select("n", "up"), "n").select("tree", "rank", F.col("up").alias("n"), (F.col("depth") - F.lit(1 << k)).alias("depth"))
        found = c.Stage(found.unionByName(more), "chat-paths").df
    return found


def render(nodes: DataFrame, chosen: DataFrame) -> DataFrame:
    """tree, rank, formatted, loss: one conversation a path; loss spans (code points) cover assistants' texts."""
    rows = chosen.join(nodes.select("n", "role", "text"), "n")
    open_, close = _marks(F.col("role"))
    rows = rows.select("tree", "rank", "depth", "role", open_.alias("open"), F.concat(open_, escape(F.col("text")), close).alias("piece"), close.alias("close"))
    before = F.sum(F.length("piece").cast("long")).over(Window.partitionBy("tree", "rank").orderBy("depth")) - F.length("piece")
    rows = rows.withColumn("at", before)
    span = F.when(F.col("role") == "assistant", F.struct((F.col("at") + F.length("open")).alias("start"), (F.col("at") + F.length("piece") - F.length("close")).alias("end")))
    turns = rows.select("tree", "rank", F.struct("depth", "piece", span.alias("span")).alias("turn"))
    one = turns.groupBy("tree", "rank").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    loss = F.transform(F.filter("turns", lambda t: t["span"].isNotNull()), lambda t: t["span"])
    return one.select("tree", "rank", F.array_join(F.col("turns.piece"), "").alias("formatted"), loss.alias("loss"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""

    def turn(x: Column) -> Column:
        other = F.struct(unescape(F.regexp_extract(x, r"(?s)^\[ROLE\](.*?)\[/ROLE\]", 1)).alias("role"), unescape(F.regexp_extract(x, r"(?s)\[/ROLE\]\[TEXT\](.*)\[/TEXT\]$", 1)).alias("text"))
        out = other
        for r, (a, b) in _MARKS.items():
            inside = F.substr(x, F.lit(len(a) + 1), F.length(x) - len(a) - len(b))
            out = F.when(F.startswith(x, F.lit(a)), F.struct(F.lit(r).alias("role"), unescape(inside).alias("text"))).otherwise(out)
        return out

    return F.transform(F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0)), turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def format_trees(messages: DataFrame, best: int = 1) -> DataFrame:
    """tree, rank, formatted, loss of the best paths of each tree."""
    nodes = numbered(messages)
    return render(nodes, paths(nodes, best))
