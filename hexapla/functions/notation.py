"""Numbered notation on slides: the kinds of lines and characters, header lines and stanza labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters of the notation font. Heads of notes, rests, marks that take a column, overlaid marks, and
# characters that the font doesn't have.
NOTE_HEADS = "1234567" + "qwertyu" + "QWERTYU" + "!#$@" + "adfghjs" + "ADFGHJS"
RESTS = "`"
COLUMN_MARKS = "/\\|?[]()"
OVERLAYS = "089=-ikKPpo_+:.*^~'\"%&"
BAR_LINES = "\\|?"
NOISE = "–—︱。、，,;；:："
# Chinese numerals of stanzas, version marks, and the letters that stand for these in file names.
NUMERALS = "一二三四五六七八九十"
VERSIONS = "甲乙丙丁"
VERSION_OF_SUFFIX = {"a": "甲", "b": "乙", "c": "丙", "d": "丁"}
CHORUS = "副歌"
# The forms of header lines, labels and slide numbers.
_CJK = r"[\x{3400}-\x{9fff}\x{3040}-\x{30ff}]"
_HEADER = (
    r"(?U)^\s*(?:[\[（(『]\s*([甲乙丙丁A-Za-z0-9]{1,3})\s*[)）』\]]\s*)?(\d+)\s*(?:[\[（(『]\s*([甲乙丙丁]{1,2})\s*[)）』\]]\s*)?"
    r"(?:\(\s*(\d+)\s*\))?\s*[、.．]?\s*(.*)$"
)
_KEY, _TIME, _TEMPO = r"[降升]?[A-Ga-g][大小]?\s*调", r"\b\d+\s*/\s*\d+\b", r"[♩♪]\s*=?\s*\d+|[=＝]\s*\d+"
_LABEL = rf"[（(]\s*({CHORUS}|[{NUMERALS}]+|\d+)\s*[)）]\s*$"
_MARKER = r"(?U)^\s*(\d+)\s*/\s*(\d+)\s*$"
_TRAILER = r"(?U)^[。.，,、；;：:！!？?…—\-–\s]+$"
_TITLE_ENDS = r"[、．.,，:：;；\-–—=♩♪·()（）]+"


def _class(chars: str) -> str:
    """A regular expression's brackets with these characters."""
    return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]"


_KNOWN = _class("".join(sorted({*NOTE_HEADS, *RESTS, *COLUMN_MARKS, *OVERLAYS, *BAR_LINES})))


def count_of(c: Column, chars: str) -> Column:
    """How many of the characters a text has."""
    return F.regexp_count(c, F.lit(_class(chars)))


def is_notation(line: Column) -> Column:
    """A line with characters, none of them CJK, of which six in ten at least belong to the notation."""
    bare = F.regexp_replace(line, r"(?U)\s", "")
    known = F.regexp_count(bare, F.lit(_KNOWN))
    return (F.length(bare) > 0) & ~line.rlike(_CJK) & (10 * known >= 6 * F.length(bare))


def noise(notes: Column) -> Column:
    """The distinct characters that don't belong into notation, sorted."""
    found = F.regexp_extract_all(notes, F.lit(f"({_class(NOISE)})"), F.lit(1))
    return F.array_sort(F.array_distinct(found))


def signature(notes: Column) -> Column:
    """The notes without white space, and without bar lines at the ends."""
    bare = F.regexp_replace(notes, r"(?U)\s", "")
    return F.regexp_replace(bare, rf"^{_class(BAR_LINES)}+|{_class(BAR_LINES)}+$", "")


def _taken(line: Column, pattern: str) -> tuple[Column, Column]:
    """The first match without white space, empty if there is none, and the line with a space in its place."""
    found = F.regexp_extract(line, f"(?U)({pattern})", 1)
    return F.regexp_replace(found, r"(?U)\s", ""), F.regexp_replace(line, f"(?U)^(.*?)(?:{pattern})", "$1 ")


def header(line: Column) -> Column:
    """A header line as (old_no, new_no, version, tail_label, title_line, title, key_sig, time_sig, tempo): the number, a new
    number and a version in parentheses, the title, and behind it key, time and tempo in any order and perhaps a stanza's
    label. Fields that aren't there are empty, and all but ``title_line`` are if the line has no number in front."""
    part = lambda i: F.regexp_extract(line, _HEADER, i)
    key, rest = _taken(part(5), _KEY)
    time, rest = _taken(rest, _TIME)
    tempo, rest = _taken(rest, _TEMPO)
    tail = F.regexp_extract(rest, f"(?U){_LABEL}", 1)
    title = F.regexp_replace(F.regexp_replace(rest, f"(?U){_LABEL}", ""), r"(?U)\s", "")
    title = F.regexp_replace(title, f"^{_TITLE_ENDS}|{_TITLE_ENDS}$", "")
    version = F.coalesce(F.nullif(part(1), F.lit("")), part(3))
    return F.struct(
        part(2).alias("old_no"), part(4).alias("new_no"), version.alias("version"), tail.alias("tail_label"),
        F.regexp_replace(line, r"(?U)^\s+|\s+$", "").alias("title_line"), title.alias("title"),
        key.alias("key_sig"), time.alias("time_sig"), tempo.alias("tempo"),
    )


def label_of_line(line: Column) -> Column:
    """The label that a line of its own gives, as ``(三)``; empty if it is none."""
    return F.regexp_extract(line, rf"(?U)^\s*{_LABEL}", 1)


def label_kind(label: Column) -> Column:
    """A label as (kind, number): a chorus has number 0; any other label is a verse, numbered by one numeral or digits, else
    0; a blank one has an empty kind."""
    bare = F.regexp_replace(F.coalesce(label, F.lit("")), r"(?U)^\s+|\s+$", "")
    number = F.when(F.length(bare) == 1, F.nullif(F.instr(F.lit(NUMERALS), bare), F.lit(0)))
    number = F.coalesce(number, F.when(bare.rlike(r"^\d+$"), bare.try_cast("int")), F.lit(0))
    chorus = bare.contains(CHORUS)
    kind = F.when(bare == "", "").when(chorus, "chorus").otherwise("verse")
    return F.struct(kind.alias("kind"), F.when(chorus | (bare == ""), F.lit(0)).otherwise(number).alias("number"))


def marker(line: Column) -> Column:
    """(k, m) of a line ``k/m`` that ends a slide; null if it is none."""
    there = line.rlike(_MARKER)
    part = lambda i: F.regexp_extract(line, _MARKER, i).try_cast("int")
    return F.when(there, F.struct(part(1).alias("k"), part(2).alias("m")))


def is_trailer(line: Column) -> Column:
    """A line of punctuation only."""
    return line.rlike(_TRAILER)
