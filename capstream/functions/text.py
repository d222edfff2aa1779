"""Text measures and cleaning as Spark column expressions."""

from __future__ import annotations

import html
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# What these stand for must be the same everywhere for results to agree.
MEANINGFUL = r"[A-Za-z0-9\x{3040}-\x{30ff}\x{3400}-\x{9fff}]+"
UNREADABLE = ("[unrecognized]", "[unabletorecognize]")
TERMINAL_PUNCTUATION = (".", "!", "?", "。", "！", "？", "…")
NON_DIALOGUE = (
    r"(?iu)^[\s♪♫♬【】\[\]()<>\-_.:：,，]*"
    r"(?:music|bgm|soundtrack|instrumental|音乐|纯音乐|音效)"
    r"[\s♪♫♬【】\[\]()<>\-_.:：,，]*$"
)
TITLE_PATTERNS = (r"(?i)Title\s*[:：]\s*(.+)", r"(?i)\[P\d+\](.+)")
OVERLAP_WINDOW = 12

#: White space as Unicode has it, with the four separators that Java leaves out.
SPACE = r"(?U)[\s\x1C-\x1F]+"
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\u0085\u2028\u2029]"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def once(value: Column, of: Callable[[Column], Column]) -> Column:
    """`of` the value, which is worked out once however often it is used, also within lambdas.

    A column of its own does not do that: the optimizer puts its expression in wherever it is named.
    """
    return F.transform(F.array(value), of)[0]


def compact(c: Column) -> Column:
    """Without any white space; null is empty."""
    return F.regexp_replace(_text(c), SPACE, "")


def spaced(c: Column) -> Column:
    """White space collapsed to single blanks and trimmed; null is empty."""
    return F.trim(F.regexp_replace(_text(c), SPACE, " "))


def trimmed(c: Column) -> Column:
    """Without white space, of any kind, at either end; null stays null."""
    return F.btrim(c, F.lit(SPACES))


def head(c: Column, n: int) -> Column:
    """The first n characters of spaced(c); the whole text is only looked at where its beginning is mostly blank."""
    short = spaced(F.left(F.ltrim(_text(c), F.lit(SPACES)), F.lit(8 * n)))
    return F.left(F.when(F.length(short) > n, short).otherwise(spaced(c)), F.lit(n))


def tail(c: Column, n: int) -> Column:
    """The last n characters of spaced(c)."""
    short = spaced(F.right(F.rtrim(_text(c), F.lit(SPACES)), F.lit(8 * n)))
    return F.right(F.when(F.length(short) > n, short).otherwise(spaced(c)), F.lit(n))


def comparison_key(c: Column) -> Column:
    """Letters and digits only, case folded: what two captions are compared by."""
    return F.replace(F.lower(F.regexp_replace(_text(c), r"[^\p{L}\p{N}]+", "")), F.lit("ß"), F.lit("ss"))


def is_readable(c: Column) -> Column:
    own = trimmed(_text(c))
    return (own != "") & ~(own.startswith("[") & compact(own).isin(*UNREADABLE))


def meaningful_length(c: Column) -> Column:
    """Number of ASCII letters and digits, kana and CJK characters: what goes when they are taken out.

    Java takes a class of characters out several times as fast as everything but that class.
    """
    return (F.length(_text(c)) - F.length(F.regexp_replace(_text(c), MEANINGFUL, ""))).cast("long")


@F.pandas_udf(StringType())
def unescape_html(s: pd.Series) -> pd.Series:
    """All of HTML5's entities, named and numbered, as Arrow batches."""
    return s.map(html.unescape, na_action="ignore")


def clean_markup(c: Column) -> Column:
    """Subtitle text without override blocks, tags, entities, extra blanks and blank lines; only text with an ampersand goes to Python."""
    c = F.replace(F.replace(_text(c), F.lit("\\N"), F.lit("\n")), F.lit("\\n"), F.lit("\n"))
    c = F.regexp_replace(F.regexp_replace(c, r"\{[^}]*\}", ""), "<[^>]+>", "")
    c = F.coalesce(unescape_html(F.when(F.contains(c, F.lit("&")), c)), c)
    lines = F.filter(F.transform(F.split(c, LINE_BREAK), spaced), lambda x: x != "")
    return F.concat_ws("\n", lines)


def is_dialogue(c: Column) -> Column:
    """Not empty, and not only a note about music."""
    return (trimmed(_text(c)) != "") & ~compact(c).rlike(NON_DIALOGUE)


def _first(values: Column) -> Column:
    return F.try_element_at(F.filter(values, lambda x: x.isNotNull()), F.lit(1))


def extract_title(log: Column) -> Column:
    """The title that the first line with one names, else null."""
    named = lambda line: F.coalesce(*[F.when(line.rlike(p), trimmed(F.regexp_extract(line, p, 1))) for p in TITLE_PATTERNS])
    return _first(F.transform(F.split(_text(log), LINE_BREAK), named))


def last_log_line(log: Column) -> Column:
    lines = F.filter(F.transform(F.split(_text(log), LINE_BREAK), trimmed), lambda x: x != "")
    return F.coalesce(F.try_element_at(lines, F.lit(-1)), F.lit("unknown error"))


def join_lines(lines: Column) -> Column:
    """Lines end to end, with a blank only between ASCII letters or digits."""

    def add(acc: Column, line: Column) -> Column:
        gap = F.when(acc.rlike("[A-Za-z0-9]$") & line.rlike("^[A-Za-z0-9]"), " ").otherwise("")
        return F.when(line == "", acc).otherwise(F.concat(acc, gap, line))

    return F.aggregate(F.transform(lines, spaced), F.lit(""), add)


def overlap_of(end: Column, start: Column, window: int = OVERLAP_WINDOW) -> Column:
    """Length of the longest end of the one that the other starts with, of at most `window` characters each: tail() and head()."""
    out = F.lit(0)
    for n in range(1, window + 1):
        out = F.when((F.length(end) >= n) & (F.length(start) >= n) & (F.right(end, F.lit(n)) == F.left(start, F.lit(n))), n).otherwise(out)
    return F.coalesce(out, F.lit(0)).cast("long")


def overlap(left: Column, right: Column, window: int = OVERLAP_WINDOW) -> Column:
    """Length of the longest end of `left`, up to `window`, that `right` starts with."""
    return overlap_of(tail(left, window), head(right, window), window)


def ends_sentence(c: Column) -> Column:
    return F.right(F.rtrim(_text(c), F.lit(SPACES)), F.lit(1)).isin(*TERMINAL_PUNCTUATION)


def first_occurrences(values: Column) -> Column:
    """Non-empty values in order of first occurrence."""
    return F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != "")))
