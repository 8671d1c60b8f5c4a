"""Column functions on text: lines, white space, headers, names, dates, tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What ends a line, and what counts as white space at a line's ends.
LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"
RARE_BREAK = r"[\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"
SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def let(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of`` a value that is computed once, also within lambdas."""
    return F.element_at(F.transform(F.array(value), of), 1)


def lines(text: Column) -> Column:
    """Lines of a text, without the empty one that a final break would leave. Few texts need the long pattern."""
    parts = F.when(text.rlike(RARE_BREAK), F.split(text, LINE_BREAK, -1)).otherwise(F.split(text, "\n", -1))
    return let(parts, lambda x: F.when(F.element_at(x, -1) == "", F.slice(x, 1, F.size(x) - 1)).otherwise(x))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE))


def is_header(line: Column, shortest: int = 3, longest: int = 80, letters: int = 3, upper: float = 0.8) -> Column:
    """Short lines most of whose letters are capitals. Other lines are known by their length."""

    def short(own: Column) -> Column:
        n = F.length(F.regexp_replace(own, r"\P{L}", ""))
        up = F.length(F.regexp_replace(own, r"\P{Lu}", ""))
        return F.when(F.length(own).between(shortest, longest), (n >= letters) & (up >= upper * n)).otherwise(F.lit(False))

    return let(strip(line), short)


def slug(x: Column) -> Column:
    return F.translate(x, "/\\", "__")


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"[^/](\.[^./]+)$", 1))


def base_name(path: Column) -> Column:
    return F.regexp_extract(F.translate(path, "\\", "/"), r"([^/]*)/*$", 1)


def safe_name(name: Column, longest: int = 80) -> Column:
    """A file name without reserved characters, cut so that a short extension stays."""
    decoded = F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)
    base = base_name(decoded)
    clean = F.regexp_replace(F.when(base == "", F.lit("arquivo")).otherwise(base), r'[<>:"/\\|?*\x00-\x1F]', "_")
    ext = F.regexp_extract(clean, r"[^.](\.[^.]+)$", 1)
    keep = (F.length(ext) > 0) & (F.length(ext) <= min(10, longest - 1))
    cut = F.when(keep, F.concat(F.substr(clean, F.lit(1), F.lit(longest) - F.length(ext)), ext)).otherwise(F.substr(clean, F.lit(1), F.lit(longest)))
    return F.when(F.length(clean) <= longest, clean).otherwise(cut)


def header_file_name(disposition: Column) -> Column:
    found = F.regexp_extract(disposition, 'filename="?([^"]+)"?', 1)
    return F.when(found != "", found)


def tokens_estimate(text: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4)).cast("long")


def iso_utc(x: Column) -> Column:
    """Adds Z to a time that names no zone."""
    bare = F.contains(x, F.lit("T")) & ~F.endswith(x, F.lit("Z")) & ~F.contains(F.substr(x, F.lit(11)), F.lit("+"))
    return F.when(bare, F.concat(x, F.lit("Z"))).otherwise(x)


def percent(score: Column) -> Column:
    """Score in percent, halves to even."""
    return F.bround(score * 100, 0).cast("int")


def section(markdown: Column, title: str) -> Column:
    """Text after a title up to the next line that begins with ``## ``."""
    return F.regexp_extract(markdown, rf"(?s)\Q{title}\E(.*?)(?:\n(?=## )|$)", 1)


def bullets(text: Column) -> Column:
    own = F.transform(lines(text), strip)
    return F.transform(F.filter(own, lambda x: F.startswith(x, F.lit("- "))), lambda x: strip(F.substr(x, F.lit(3))))


def profile_units(markdown: Column, uses: str = "## Aplicações típicas", terms: str = "## Tecnologias e termos relacionados") -> Column:
    """A unit a bullet of the uses, and one of all terms."""
    words = strip(section(markdown, terms))
    return F.concat(bullets(section(markdown, uses)), F.when(words != "", F.array(words)).otherwise(F.array().cast("array<string>")))


def day_prefix(x: Column) -> Column:
    """The date that a time begins with; null is ''."""
    return F.substring(F.coalesce(x, F.lit("")), 1, 10)


def compact_day(day: Column) -> Column:
    """YYYYMMDD of YYYY-MM-DD."""
    return F.replace(day, F.lit("-"), F.lit(""))


def yesterday() -> Column:
    return F.date_format(F.date_sub(F.current_date(), 1), "yyyy-MM-dd")


def has_error_code(body: Column, code: str) -> Column:
    """Whether a JSON object names an error; other texts do not."""
    return F.coalesce(F.get_json_object(body, "$.error_code") == code, F.lit(False))
