"""Reports on documents, chunks and downloads, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranksieve.functions.names import free_names
from ranksieve.functions.text import extension


def characters(files: DataFrame, texts: DataFrame, key: str = "item", seq: str = "seq") -> DataFrame:
    """``files`` (key, seq, name) with chars: how many characters their texts (key, seq, text) have in all, null without a text."""
    sums = texts.groupBy(key, seq).agg(F.sum(F.length("text")).alias("chars"))
    return files.select(key, seq, "name").join(sums, [key, seq], "left")


def presence(listed: DataFrame, local: DataFrame, key: str = "item", seq: str = "seq") -> DataFrame:
    """Listed files with on_disk and, if so, the extension and the characters of their texts (0 where none could be read).

    ``local``: key, seq, name, chars (null where no text).
    """
    there, ext, chars = free_names(listed, "there", "ext", "chars")
    own = local.select(key, seq, F.lit(True).alias(there), extension(F.col("name")).alias(ext), F.coalesce("chars", F.lit(0)).cast("long").alias(chars))
    out = listed.join(own, [key, seq], "left")
    return out.withColumns({"on_disk": F.col(there).isNotNull(), "extension": F.col(ext), "chars": F.coalesce(chars, F.lit(0))}).drop(there, ext, chars)


def most_common(rows: DataFrame, value: str, ord: str, empty: Column | None = None) -> DataFrame:
    """value, n, n_empty (rows for which ``empty`` holds), position: the commonest first, of equals the one seen first."""
    by = rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.lit(False) if empty is None else empty).alias("n_empty"), F.min(ord).alias("first"))
    return by.withColumn("position", F.row_number().over(Window.orderBy(F.desc("n"), "first"))).drop("first")  # a row a value


def diagnosis(present: DataFrame, chunks: DataFrame, key: str = "item", seq: str = "seq") -> DataFrame:
    """key, chunks_now, files, n_missing: each notice with its files in order, as an array; ``chunks``: key, n."""
    one = F.struct(F.col(seq), "kind", "on_disk", "extension", "chars")
    per = present.groupBy(key).agg(F.array_sort(F.collect_list(one)).alias("files"), F.count_if(~F.col("on_disk")).alias("n_missing"))
    return per.join(chunks.select(key, "n"), key, "left").select(key, F.coalesce("n", F.lit(0)).alias("chunks_now"), "files", "n_missing")


def rechunked(present: DataFrame, main: DataFrame, before: DataFrame, after: DataFrame, key: str = "item", seq: str = "seq") -> DataFrame:
    """A row a notice: files listed, main ones, of these used and missing, and chunks before and after.

    ``present``: as ``presence`` gives it; ``main``: key, seq of main documents; ``before``, ``after``: key, n.
    """
    (flag,) = free_names(present, "main")
    marked = present.join(main.select(key, seq, F.lit(True).alias(flag)), [key, seq], "left")
    is_main = F.coalesce(F.col(flag), F.lit(False))
    per = marked.groupBy(key).agg(
        F.count(F.lit(1)).alias("docs_total"), F.count_if(is_main).alias("docs_main"), F.count_if(is_main & F.col("on_disk")).alias("docs_used"), F.count_if(is_main & ~F.col("on_disk")).alias("docs_missing"))
    out = per.join(before.select(key, F.col("n").alias("chunks_before")), key, "left").join(after.select(key, F.col("n").alias("chunks_after")), key, "left")
    return out.withColumns({x: F.coalesce(x, F.lit(0)) for x in ("chunks_before", "chunks_after")})


def rechunk_totals(report: DataFrame) -> DataFrame:
    """One row: notices, chunks before and after, notices without a main document, and those without chunks now."""
    return report.agg(
        F.count(F.lit(1)).alias("items"), F.coalesce(F.sum("chunks_before"), F.lit(0)).alias("total_before"), F.coalesce(F.sum("chunks_after"), F.lit(0)).alias("total_after"),
        F.count_if(F.col("docs_main") == 0).alias("without_main"), F.count_if(F.col("chunks_after") == 0).alias("without_chunks"))


def throughput(answers: DataFrame, level: str = "level", status: str = "status", size: str = "bytes", seconds: str = "seconds") -> DataFrame:
    """level, seconds, mb_per_s, files_per_s, transient, other_failures, gain, efficiency of each level of concurrency.

    ``answers``: a row a request, with its level, status, bytes and the seconds that its level took in all. Gain is against
    the lowest level, efficiency the percentage of a gain as large as the level; both 0 where that cannot be told.
    """
    ok = (F.col(status) == 200) & F.col(size).isNotNull()
    passing = (F.col(status) == 429) | (F.col(status) >= 500)
    by = answers.groupBy(F.col(level).alias("level")).agg(
        F.max(seconds).alias("seconds"), F.coalesce(F.sum(F.when(ok, F.col(size))), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("files"),
        F.count_if(passing).alias("transient"), F.count_if(~ok & ~passing).alias("other_failures"))

    def rate(x: Column, y: Column) -> Column:
        return F.when(y == 0, F.lit(0.0)).otherwise(F.coalesce(x / y, F.lit(0.0)))

    by = by.withColumns({"mb_per_s": rate(F.col("bytes") / 1_048_576, F.col("seconds")), "files_per_s": rate(F.col("files"), F.col("seconds"))}).drop("bytes", "files")
    base = F.first_value("mb_per_s").over(Window.orderBy("level").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))  # a row a level
    gained = by.withColumn("gain", rate(F.col("mb_per_s"), base))
    return gained.withColumn("efficiency", rate(F.col("gain") * 100, F.col("level")))


def compared(old: DataFrame, new: DataFrame, n: int, ord: str = "ord", digits: int = 4) -> DataFrame:
    """The top n under a new profile beside what the old one said of them: ord, position, score, product, old_score, old_product, moved."""
    top = new.orderBy(F.desc("score"), F.asc(ord)).limit(n)
    top = top.withColumn("position", F.row_number().over(Window.orderBy(F.desc("score"), F.asc(ord))))  # n rows
    was = old.select(ord, F.bround("score", digits).alias("old_score"), F.col("product").alias("old_product"))
    out = top.join(was, ord, "left")
    return out.select(ord, "position", F.bround("score", digits).alias("score"), "product", "old_score", "old_product", (~F.col("product").eqNullSafe(F.col("old_product"))).alias("moved"))
