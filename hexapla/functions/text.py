"""Text functions on columns. All but the UDFs at the end are built-in expressions."""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from difflib import SequenceMatcher
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CJK = r"\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}"
#: Marks that are taken out before syllables are counted, and the characters that are a syllable each.
UNSUNG = "，。、；：！？「」『』（）()《》〈〉“”‘’…—～~·-–.!?,;:\"'[]{}|/\\"
SUNG = r"\x{3040}-\x{30ff}\x{3400}-\x{9fff}"
#: File extensions that are written differently.
EXTENSION_ALIASES = {"mp4": "m4a", "jpeg": "jpg", "htm": "html"}


def strip(c: Column) -> Column:
    """White space of any kind off both ends; ``trim`` takes spaces only."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def normalise_newlines(c: Column) -> Column:
    """CRLF and CR to LF, and stripped; null is empty."""
    return strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"\r\n?", "\n"))


def as_text(c: Column) -> Column:
    """Anything as a string, null as an empty one."""
    return F.coalesce(c.cast("string"), F.lit(""))


def markup_to_lines(c: Column) -> Column:
    """Line breaks and block ends to LF, other tags away; entities stay (see ``html_to_text``)."""
    broken = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>", "")
    broken = F.regexp_replace(broken, r"(?i)<br\s*/?>|</p>\s*<p[^>]*>|</?(p|div|li|ul|ol|h[1-6]|tr|table|section|article)\b[^>]*>", "\n")
    return F.regexp_replace(broken, r"(?s)<[^>]*>", "")


def tidy_lines(c: Column) -> Column:
    """Every line stripped, runs of blank lines made one, the whole stripped."""
    lines = F.transform(F.split(F.regexp_replace(c, r"\r\n?", "\n"), "\n"), strip)
    return strip(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"))


def html_to_text(c: Column, closed: bool = False) -> Column:
    """HTML to plain text: tags to lines, entities to characters, lines tidied. ``closed``: only entities with a semicolon, so
    that one which the end of a text has cut off, or a URL's ``&copy=``, stays."""
    return tidy_lines((html_unescape_closed if closed else html_unescape)(markup_to_lines(c)))


def keep_alnum(c: Column) -> Column:
    """Letters and digits only."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}]", "")


def compare_key(c: Column, variants: dict[str, str] | None = None) -> Column:
    """For comparing titles: variant characters folded, letters and digits only, lower case."""
    folded = F.translate(c, "".join(variants), "".join(variants.values())) if variants else c
    return F.lower(keep_alnum(folded))


def drop_space(c: Column) -> Column:
    """No white space."""
    return F.regexp_replace(c, r"\s+", "")


def syllable_count(c: Column) -> Column:
    """CJK and kana characters, one each, and runs of the letters A to Z, after marks and white space are taken out. Digits are
    not sung. Words with nothing but space or marks between them are one run: ``hello world`` counts 1."""
    bare = F.regexp_replace(F.translate(c, UNSUNG, ""), r"(?U)\s+", "")
    return F.regexp_count(bare, F.lit(f"[{SUNG}]")) + F.regexp_count(bare, F.lit("[A-Za-z]+"))


def class_count(c: Column, chars: str) -> Column:
    """How many characters of a class (a regular expression's brackets) there are."""
    return F.regexp_count(c, F.lit(chars))


def noise_set(c: Column, known: str) -> Column:
    """The distinct characters outside a class, sorted and joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.filter(F.split(F.regexp_replace(c, known, ""), ""), lambda x: x != ""))), "")


def safe_name(c: Column) -> Column:
    """Letters, digits, spaces, ``_`` and ``-``; ``Unknown`` if nothing is left."""
    kept = strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\p{L}\p{N} _-]", ""))
    return F.when(kept == "", F.lit("Unknown")).otherwise(kept)


def numbered_name(seq: Column, name: Column) -> Column:
    """The number in three digits at least, ``_``, and the safe name."""
    return F.format_string("%03d_%s", seq.cast("int"), safe_name(name))


def with_suffix(name: Column, default: str, suffix: str) -> Column:
    """The stripped name, or the default, ending in ``suffix``."""
    n = strip(F.coalesce(name, F.lit("")))
    n = F.when(n == "", F.lit(default)).otherwise(n)
    return F.when(n.endswith(suffix), n).otherwise(F.concat(n, F.lit(suffix)))


def extension(c: Column, default: str = "") -> Column:
    """Lower case, no point before it, aliases replaced."""
    e = F.regexp_replace(F.lower(strip(F.coalesce(c, F.lit("")))), r"^\.", "")
    named = e
    for k, v in EXTENSION_ALIASES.items():
        named = F.when(e == k, F.lit(v)).otherwise(named)
    return F.when(e == "", F.lit(default)).otherwise(named)


def url_name(c: Column) -> Column:
    """The last part of a URL's path, without query and fragment."""
    return F.regexp_extract(c, r"([^/?#]*)(?:[?#].*)?$", 1)


def url_extension(c: Column) -> Column:
    """The extension of a URL's last part; empty if it has none."""
    return extension(F.regexp_extract(url_name(c), r"\.([A-Za-z0-9]+)$", 1))


def path_number(c: Column) -> Column:
    """The number of a path like ``012_34_a``: digits behind ``_``, with ``_a`` or ``_b``."""
    return F.regexp_extract(c, r"_(\d+(?:_[ab])?)", 1)


def number_head(c: Column, default: int = 1_000_000) -> Column:
    """The digits at the start as a number, for sorting; the default if there are none."""
    return F.coalesce(F.regexp_extract(c, r"^(\d+)", 1).try_cast("int"), F.lit(default))


def natural_key(c: Column) -> Column:
    """Sorts runs of digits by value: an array of (number, text), numbers before texts."""
    parts = F.regexp_extract_all(c, F.lit(r"\d+|\D+"), F.lit(0))
    return F.transform(parts, lambda x: F.struct(F.coalesce(x.try_cast("decimal(38,0)"), F.lit(-1).cast("decimal(38,0)")).alias("n"), F.when(x.rlike(r"^\d"), F.lit("")).otherwise(x).alias("t")))


def minutes(seconds: Column) -> Column:
    """m:ss."""
    s = F.bround(seconds).cast("long")
    return F.format_string("%d:%02d", F.floor(s / 60).cast("long"), s % 60)


def hours(seconds: Column) -> Column:
    """XhYYm."""
    s = F.bround(seconds).cast("long")
    return F.format_string("%dh%02dm", F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"))


def hex_code(c: Column) -> Column:
    """A code point as lower-case hex of four digits at least."""
    h = F.lower(F.hex(c))
    return F.when(F.length(h) < 4, F.lpad(h, 4, "0")).otherwise(h)


def code_of_hex(c: Column) -> Column:
    """A code point from hex; null if it isn't hex."""
    return F.when(c.rlike(r"^[0-9A-Fa-f]{1,8}$"), F.conv(c, 16, 10).cast("long"))


def ocr_line(c: Column) -> Column:
    """A recognised line without coordinates, runs of points, table bars and repeated spaces."""
    for pattern, to in ((r"\[?\(?\d+(?:\.\d+)?,\s*\d+(?:\.\d+)?\)?\]?", " "), (r"…+|\.{3,}", " "), (r"[|¦]+", " "), (r"[·•]+", " "), (r"\s+", " ")):
        c = F.regexp_replace(c, pattern, to)
    return strip(c)


def index_line(c: Column) -> Column:
    """A line of an index as (kind, name, number): ``song`` for a name and a number behind it, ``category`` for a name in
    brackets, else ``other``."""
    bracket, song = r"(?U)^\s*【\s*(.+?)\s*】\s*$", r"(?U)^\s*(.*\S)\s+(\d+)\s*$"
    kind = F.when(c.rlike(bracket), "category").when(c.rlike(song), "song").otherwise("other")
    name = F.when(c.rlike(bracket), F.regexp_extract(c, bracket, 1)).otherwise(F.regexp_extract(c, song, 1))
    return F.struct(kind.alias("kind"), name.alias("name"), F.when(kind == "song", F.regexp_extract(c, song, 2).try_cast("long")).alias("number"))


def grade(c: Column) -> Column:
    """The digit 0 to 7 of a symbol; null if it has none."""
    return F.nullif(F.regexp_extract(c, "([0-7])", 1), F.lit(""))


def font_family(c: Column) -> Column:
    """A font's name without the six letters and ``+`` of a subset."""
    return F.regexp_replace(c, r"^[A-Z]{6}\+", "")


def plain_symbol(c: Column, names: dict[str, str]) -> Column:
    """A symbol by the table ``names``; one that it lacks stays."""
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair]) if names else None
    return c if known is None else F.coalesce(F.try_element_at(known, c), c)


def plain_key(c: Column, pairs: dict[str, str] | None = None) -> Column:
    """NFKC, without points and spaces, lower case, and of ``pairs`` of characters that mean the same the second."""
    key = F.lower(F.regexp_replace(nfkc(c), r"[\s.．。·]", ""))
    return F.translate(key, "".join(pairs), "".join(pairs.values())) if pairs else key


class Phrases:
    """A trie of phrases and what they become, for converting texts from left to right by the longest phrase at each place."""

    def __init__(self, table: dict[str, str]):
        self.root: dict = {}
        for phrase, other in table.items():
            node = self.root
            for ch in phrase:
                node = node.setdefault(ch, {})
            if phrase:
                node[""] = other

    def convert(self, text: str) -> str:
        out, at = [], 0
        while at < len(text):
            node, k, found, end = self.root, at, None, at + 1
            while k < len(text) and (node := node.get(text[k])) is not None:
                k += 1
                if "" in node:
                    found, end = node[""], k
            out.append(text[at] if found is None else found)
            at = end
        return "".join(out)


def converted(c: Column, table: dict[str, str]) -> Column:
    """A text with the phrases of a conversion table, given by the caller, replaced: at each place the longest that stands
    there, from left to right; what has been replaced is not looked at again."""
    phrases = Phrases(table)

    @F.pandas_udf(T.StringType())
    def convert(s: pd.Series) -> pd.Series:
        return s.map(lambda x: x if x is None else phrases.convert(x))

    return convert(c)


@F.pandas_udf(T.StringType())
def html_unescape(s: pd.Series) -> pd.Series:
    """Entities to characters."""
    return s.map(lambda x: x if x is None else html.unescape(x))


def _closed(m: re.Match) -> str:
    return html.unescape(m[0]) if m[1].startswith("#") or m[1] in html5 else m[0]


@F.pandas_udf(T.StringType())
def html_unescape_closed(s: pd.Series) -> pd.Series:
    """Entities that end in a semicolon to characters."""
    entity = re.compile(r"&(#[0-9]+;|#[xX][0-9A-Fa-f]+;|[A-Za-z][0-9A-Za-z]*;)")
    return s.map(lambda x: x if x is None else entity.sub(_closed, x))


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Unicode's compatibility composition."""
    return s.map(lambda x: x if x is None else unicodedata.normalize("NFKC", x))


@F.pandas_udf(T.DoubleType())
def seq_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the matching blocks' length over both lengths; null if either is null. Not an edit distance."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y, autojunk=False).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def _coverage(x: str | None, y: str | None, percent: int = 0) -> float | None:
    if x is None or y is None:
        return None
    if not x or x in y:
        return 1.0
    if percent and 100 * (Counter(x) & Counter(y)).total() < percent * len(x):
        return 0.0
    return sum(b.size for b in SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks()) / len(x)


@F.pandas_udf(T.DoubleType())
def seq_coverage(part: pd.Series, whole: pd.Series) -> pd.Series:
    """The part of ``part`` that is found in ``whole`` in order: 1 if contained, else matching blocks' length over its own."""
    return pd.Series([_coverage(x, y) for x, y in zip(part, whole, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def coverage_from(part: pd.Series, whole: pd.Series, percent: pd.Series) -> pd.Series:
    """``seq_coverage``, or 0 where ``whole`` hasn't ``percent`` of the characters of ``part``, in whatever order."""
    return pd.Series([_coverage(*x) for x in zip(part, whole, percent, strict=True)], dtype="float64")


@F.pandas_udf(T.IntegerType())
def display_width(s: pd.Series) -> pd.Series:
    """Columns that a text takes in a terminal: two for wide characters."""
    return s.map(lambda x: 0 if x is None else sum(2 if unicodedata.east_asian_width(ch) in "WF" else 1 for ch in x)).astype("int32")
