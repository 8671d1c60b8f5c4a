"""Secret scans with DataFrame functions only.

Base kinds are patterns (fixed by the contract below). Beyond them, candidate strings of
one character class (hex, base64, letters of one case with digits, letters) are scanned with a window of
WINDOW characters: the counts of the window's characters are carried from place to place, eight to a
64-bit number, and with them the sum of n*log2(n), so each step changes two counts and two terms of the
Shannon entropy; a candidate whose largest window entropy reaches its class's threshold is a secret, unless an
allow-list form names it. Windows near an allow-listed word do not count. What base spans leave of a
candidate is reported, in several parts if they lie within.

One pass finds the runs of base64 characters, WINDOW or longer; candidates, access keys and hex strings lie
within runs, so all other patterns but that of assignments see runs only. Places are code points, ends
exclusive: running sums of the lengths of the parts that a text is split into. Running sums and maxima are made in blocks,
what base spans leave is looked up by binary search, and texts are redacted in chunks, so time is linear in a text's
length, but for the logarithm of its spans' number, however many spans and runs it has.

Cases: a null text is empty and has no spans; empty tables give empty results; matches that touch or
repeat are all kept; texts and candidates are scanned whole; documents
repeat as often as they stand; columns of any name pass untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as c

#: The base kinds. Runs shorter than a kind's least are dropped; for access and hex that
#: equals asking for the least in the pattern, as a run is matched from its start or not at all.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

WINDOW = 20
#: Characters of a text that are redacted in one go.
CHUNK = 256
_RUN = "[A-Za-z0-9+/_=-]"
RUN = rf"(?<!{_RUN}){_RUN}{{{WINDOW}}}"
#: Where runs begin and end.
RUN_EDGES = rf"(?<!{_RUN})(?={_RUN}{{{WINDOW}}})|(?!{_RUN})(?<={_RUN}{{{WINDOW}}})"
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_CHANGES = "(?:[A-Za-z]*?[A-Z][a-z][A-Z]){2}"
#: Characters, candidates and least entropy (bits a character, at most log2 of 20 = 4.32) of each class. Hex and base64
#: candidates are whole runs of base64 characters, however long; the others are runs of letters and digits.
#: Long words and joined ones reach 3.8 bits, so letters alone have a high threshold unless their case changes as no words' does.
CLASSES = {
    "entropy_hex": ("0123456789abcdefABCDEF", r"(?<![A-Za-z0-9+/_=-])(?=[A-Fa-f]*[0-9])(?=[0-9]*[A-Fa-f])[0-9A-Fa-f]{20,}(?![A-Za-z0-9+/_=-])", 3.0),
    "entropy_base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-", r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[a-z0-9+/_=-]*+[A-Z])(?=[A-Z0-9+/_=-]*+[a-z])[A-Za-z0-9+/_=-]{20,}+", 3.6),
    "entropy_one_case": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])(?=[0-9]*+[A-Za-z])(?:[a-z0-9]{20,}+|[A-Z0-9]{20,}+)(?![A-Za-z0-9])", 3.4),
    "entropy_mixed_case": (_LETTERS, rf"(?<![A-Za-z0-9])(?={_CHANGES})[A-Za-z]{{20,}}+(?![A-Za-z0-9])", 3.6),
    "entropy_letters": (_LETTERS, rf"(?<![A-Za-z0-9])(?!{_CHANGES})[A-Za-z]{{20,}}+(?![A-Za-z0-9])", 4.0),
}
#: Candidates of these forms are no secrets: one character or a short unit repeated, paths.
ALLOW_FORMS = r"(?i)^(.{1,6})\1++.{0,6}$|^[a-z]++(?:[-_/][a-z]++){2,}+[0-9]{0,4}$"
#: Words of examples: windows within NEAR characters of one do not count.
ALLOW_WORDS, NEAR = "example|sample|placeholder|dummy|redacted|xxxx|0123456789|abcdefgh", 64

_SPAN = "struct<start:long,ord:int,end:long,kind:string>"
_TERMS = [0.0, *(n * math.log2(n) for n in range(1, WINDOW + 2))]


def _none() -> Column:
    return F.array().cast(f"array<{_SPAN}>")


def _span(start: Column, end: Column, ord: Column, kind: Column) -> Column:
    return F.struct(start.cast("long").alias("start"), ord.cast("int").alias("ord"), end.cast("long").alias("end"), kind.alias("kind"))


def _let(value: Column, of) -> Column:
    """``of`` a value that is computed once."""
    return F.element_at(F.transform(F.array(value), of), 1)


#: Elements that one fold gathers; folds are nested once: a part of n costs (FOLD + n / FOLD^2) / 2 copies of a number, 200 for
#: a text of ten million parts, which has 200 MB or more.
FOLD = 256


def _fold(values: Column, start: Column, add) -> Column:
    """Running totals from ``start`` on. An array that grows is copied, so this is for FOLD values."""
    begin = F.struct(start.alias("t"), F.array().cast("array<long>").alias("out"))

    def step(acc, x):
        total = add(acc["t"], x)
        return F.struct(total.alias("t"), F.concat(acc["out"], F.array(total)).alias("out"))

    return F.aggregate(values, begin, step, lambda acc: acc["out"]).cast("array<long>")


def running(values: Column, add) -> Column:
    """Running totals of an array of longs that are 0 or more, in blocks, each from the total before it."""
    zero = F.lit(0).cast("long")

    def blocks(v: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / FOLD).cast("int")), lambda b: F.slice(v, b * FOLD + 1, F.lit(FOLD)))

        def level(own: Column) -> Column:
            totals = _fold(F.transform(own, lambda x: F.aggregate(x, zero, add)), zero, add)
            return _let(totals, lambda t: F.flatten(F.transform(own, lambda x, i: _fold(x, F.coalesce(F.get(t, i - 1), zero), add))))

        return _let(cut, level)

    # casts name the type, which otherwise is found anew, through all that is below, at every level above
    return _let(values, lambda v: F.when(F.size(v) <= FOLD, _fold(v, zero, add)).otherwise(blocks(v).cast("array<long>"))).cast("array<long>")


def _sum(a: Column, b: Column) -> Column:
    return a + b


def _length(s: Column) -> Column:
    return F.coalesce(F.length(s), F.lit(0)).cast("long")


def _places(text: Column, offset: Column, pattern: str, keep, kind: str, ord: int) -> Column:
    """Spans of the matches for which ``keep`` holds; ``offset`` is where the text begins."""
    # what follows the last match stands beside none
    zipped = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"), F.split(text, pattern, -1).alias("before"))

    def spans(parts: Column) -> Column:
        ends = running(F.transform(parts, lambda x: _length(x["before"]) + _length(x["match"])), _sum)
        found = F.filter(F.arrays_zip(parts.alias("p"), ends.alias("end")), lambda x: x["p"]["match"].isNotNull() & keep(x["p"]["match"]))
        return F.transform(found, lambda x: _span(offset + x["end"] - _length(x["p"]["match"]), offset + x["end"], F.lit(ord), F.lit(kind)))

    return _let(zipped, spans).cast(f"array<{_SPAN}>")


def entropy(s: Column, alphabet: str) -> Column:
    """The largest Shannon entropy of any WINDOW characters of a string of the alphabet, in bits a character; 0 for shorter ones."""
    terms = F.array(*map(F.lit, _TERMS))

    def term(n: Column) -> Column:
        return F.element_at(terms, n + 1)

    def count(counts: Column, code: Column) -> Column:
        held = F.call_function("shiftright", F.element_at(counts, F.shiftright(code, 3) + 1), code.bitwiseAND(7) * 8)
        return held.bitwiseAND(255).cast("int")

    def one(code: Column, i: Column) -> Column:
        unit = F.call_function("shiftleft", F.lit(1).cast("long"), code.bitwiseAND(7) * 8)
        return F.when(F.shiftright(code, 3) == i, unit).otherwise(F.lit(0).cast("long"))

    def step(acc, x):
        new, old = x["new"], x["old"]
        n = count(acc["counts"], new)
        total = acc["sum"] + term(n + 1) - term(n)
        m = count(acc["counts"], old) + F.when(old == new, 1).otherwise(0)
        total = F.when(old < 0, total).otherwise(total + term(m - 1) - term(m))
        counts = F.transform(acc["counts"], lambda held, i: held + one(new, i) - one(old, i))
        bits = F.when(acc["seen"] + 1 >= WINDOW, F.lit(math.log2(WINDOW)) - total / WINDOW).otherwise(F.lit(0.0))
        return F.struct(counts.alias("counts"), total.alias("sum"), F.greatest(acc["best"], bits).alias("best"), (acc["seen"] + 1).alias("seen"))

    def scan(code):
        old = F.slice(F.concat(F.array_repeat(F.lit(-1), WINDOW), code), 1, F.size(code))
        counts = F.array_repeat(F.lit(0).cast("long"), len(alphabet) // 8 + 1)
        start = F.struct(counts.alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"), F.lit(0).alias("seen"))
        return F.aggregate(F.arrays_zip(code.alias("new"), old.alias("old")), start, step, lambda acc: acc["best"])

    return _let(F.transform(F.split(s, ""), lambda ch: F.instr(F.lit(alphabet), ch) - 1), scan).cast("double")


def _is_secret(candidate: Column, alphabet: str, least: float) -> Column:
    """A window's entropy is at most the logarithm of its different characters, so strings of too few are not scanned."""
    near = rf"(?i).{{0,{NEAR}}}(?:{ALLOW_WORDS}).{{0,{NEAR}}}"
    parts = F.when(candidate.rlike(f"(?i){ALLOW_WORDS}"), F.split(candidate, near, -1)).otherwise(F.array(candidate))
    many = math.ceil(2**least - 1e-9)
    high = F.exists(parts, lambda p: (F.length(p) >= WINDOW) & (F.size(F.array_distinct(F.split(p, ""))) >= many) & (entropy(p, alphabet) >= least))
    return ~candidate.rlike(ALLOW_FORMS) & high


def _runs(text: Column) -> Column:
    """Place and characters of each run."""

    def placed(parts: Column) -> Column:
        ends = running(F.transform(parts, _length), _sum)
        found = F.filter(F.arrays_zip(parts.alias("s"), ends.alias("end")), lambda x: x["s"].rlike(RUN))
        return F.transform(found, lambda x: F.struct((x["end"] - _length(x["s"])).alias("at"), x["s"].alias("s")))

    return _let(F.split(text, RUN_EDGES, -1), placed).cast("array<struct<at:long,s:string>>")


def _in_run(run: Column) -> Column:
    """Spans of all kinds but assignments in a run; of base kinds first."""
    always = lambda m: F.lit(True)
    kinds = [("access", ACCESS, always), ("hex", HEX, always)]
    kinds += [(kind, pattern, lambda m, a=alphabet, t=least: _is_secret(m, a, t)) for kind, (alphabet, pattern, least) in CLASSES.items()]
    return F.concat(*(F.when(run["s"].rlike(pattern), _places(run["s"], run["at"], pattern, keep, kind, 1 + k)).otherwise(_none()) for k, (kind, pattern, keep) in enumerate(kinds)))


def scan(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str, str]:
    """All columns of docs and two more, whose names are returned: base spans, and all spans; arrays of (start, ord, end, kind) in order."""
    whole, low, found, base, spans = c.free_names(docs, "whole", "low", "found", "base", "spans")
    out = docs.withColumn(whole, F.coalesce(F.col(c.quoted(text)), F.lit("")))
    # each is used more than once below, so it has a column of its own
    out = out.withColumn(low, F.lower(whole)).withColumn(found, F.when(F.col(whole).rlike(RUN), F.flatten(F.transform(_runs(F.col(whole)), _in_run))).otherwise(_none()))
    hinted = F.lit(False)
    for hint in ASSIGN_HINTS:
        hinted |= F.contains(F.col(low), F.lit(hint))
    assign = _places(F.col(whole), F.lit(0), ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6, "assign", 0)
    out = out.withColumn(base, F.array_sort(F.concat(F.when(hinted, assign).otherwise(_none()), F.filter(found, lambda s: s["ord"] <= 2))))
    apart = _let(_gaps(F.col(base)), lambda gaps: F.flatten(F.transform(F.filter(found, lambda s: s["ord"] > 2), lambda m: _apart(m, gaps))))
    return out.withColumn(spans, F.array_sort(F.concat(F.col(base), apart))).drop(whole, low, found), base, spans


def _ends(spans: Column) -> Column:
    """For spans in order: how far each and those before it reach."""
    return running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))


def _gaps(base: Column) -> Column:
    """start and end of what no base span (they are in order) covers, in order; the last gap has no end."""

    def of(ends: Column) -> Column:
        start = F.concat(F.array(F.lit(0).cast("long")), ends)
        end = F.concat(F.transform(base, lambda s: s["start"]), F.array(F.lit(1 << 62)))
        return F.filter(F.arrays_zip(start.alias("start"), end.alias("end")), lambda g: g["start"] < g["end"])

    return _let(_ends(base), of).cast("array<struct<start:long,end:long>>")


def _below(values: Column, holds) -> Column:
    """How many of the first elements of an array hold, those that do standing before those that do not; by binary search."""
    n = F.size(values)
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(31))))

    def step(lo, add):
        at = lo + add
        return F.when((add <= n - lo) & holds(F.get(values, F.least(at, n) - 1)), at).otherwise(lo)

    return F.aggregate(steps, F.lit(0), step).cast("int")


def _range(values: Column, first: Column, last: Column, of) -> Column:
    """``of`` the elements from first (from 0) up to but without last."""
    return F.transform(F.slice(values, first + 1, F.greatest(F.lit(0), last - first)), of)


def _apart(span: Column, gaps: Column) -> Column:
    """The parts of a span that lie in gaps."""
    part = lambda g: _span(F.greatest(g["start"], span["start"]), F.least(g["end"], span["end"]), span["ord"], span["kind"])
    some = _range(gaps, _below(gaps, lambda g: g["end"] <= span["start"]), _below(gaps, lambda g: g["start"] < span["end"]), part)
    none = (F.size(gaps) == 1) & (F.get(gaps, F.lit(0))["start"] == 0)
    return F.when(none, F.array(_span(span["start"], span["end"], span["ord"], span["kind"]))).otherwise(some).cast(f"array<{_SPAN}>")


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of each document."""
    found, base, spans = scan(docs.select(F.col(c.quoted(id_col)).alias("doc_id"), F.col(c.quoted(text)).alias("text")))

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(F.col(base)), 256).alias("base_sha256"), joined(F.col(spans)).alias("spans"))


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", length: str | None = "n_chars") -> DataFrame:
    """Documents with every span (overlapping ones as one) replaced by ``mark``; ``length``, if there, is brought up to date."""
    found, _, spans = scan(docs, text)
    (clean,) = c.free_names(found, "clean")
    body = F.col(c.quoted(text))

    def covered(ends: Column) -> Column:
        """start and end of the stretches that overlapping spans cover, in order."""
        fresh = F.filter(F.arrays_zip(F.col(spans)["start"].alias("start"), F.concat(F.array(F.lit(0).cast("long")), ends).alias("before")), lambda x: x["start"] >= x["before"])
        end = F.concat(F.slice(F.transform(fresh, lambda x: x["before"]), 2, F.greatest(F.lit(0), F.size(fresh) - 1)), F.array(F.element_at(ends, -1)))
        return F.arrays_zip(F.transform(fresh, lambda x: x["start"]).alias("start"), end.alias("end"))

    def piece(chunk: Column, i: Column, cover: Column) -> Column:
        """A chunk of the text less what is covered; a mark stands where a covered stretch begins."""
        a, b = i.cast("long") * CHUNK, i.cast("long") * CHUNK + CHUNK
        here = _range(cover, _below(cover, lambda s: s["end"] <= a), _below(cover, lambda s: s["start"] < b), lambda s: s)

        def cut(own: Column) -> Column:
            def before(s: Column, k: Column) -> Column:
                start = F.greatest(a, F.coalesce(F.get(own, k - 1)["end"], a))
                kept = F.substr(chunk, (start - a + 1).cast("int"), F.greatest(F.lit(0), s["start"] - start).cast("int"))
                return F.when(s["start"] >= a, F.concat(kept, F.lit(mark))).otherwise(F.lit(""))

            after = F.substr(chunk, (F.least(b, F.element_at(own, -1)["end"]) - a + 1).cast("int"))
            return F.when(F.size(own) == 0, chunk).otherwise(F.concat(F.array_join(F.transform(own, before), ""), after))

        return _let(here, cut).cast("string")

    chunks = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    pieces = _let(_let(_ends(F.col(spans)), covered).cast("array<struct<start:long,end:long>>"), lambda cover: F.transform(chunks, lambda x, i: piece(x, i, cover)))
    some = F.size(spans) > 0
    out = found.withColumn(clean, F.when(some, F.array_join(pieces, "")).otherwise(body))

    def column(name: str) -> Column:
        own = F.col(c.quoted(name))
        if name == text:
            own = F.col(clean)
        elif name == length:
            own = F.when(some, F.length(clean).cast(docs.schema[name].dataType)).otherwise(own)
        return own.alias(name)

    return out.select(*map(column, docs.columns))
