"""Reports as tables, symbol strings and path helpers."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from hexapla.functions.text import display_width


def text_report(sections: dict[str, tuple[DataFrame, Column, list[Column | str], int | None]], keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """(section, ordinal, text): for each section the lines of a table in an order without ties, the first so many if a
    number is given.

    Sections without a number can be of any size: their rows are dealt out by ranges of the order, and numbered from the
    counts of the ranges before. ``keep`` writes a table and reads it back; the ranges must be the same when they are counted
    and when they are numbered.
    """
    out = None
    for name, (rows, line, order, most) in sections.items():
        keyed = rows.select(F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"o{k}") for k, c in enumerate(order)]).alias("o"), line.alias("text"))
        if most is not None:
            one = keyed.orderBy("o").limit(most).withColumn("ordinal", F.row_number().over(Window.orderBy("o")))
        else:
            ranged = keep(keyed.repartitionByRange("o").withColumn("part", F.spark_partition_id()))
            counts = ranged.groupBy("part").agg(F.count("*").alias("n"))
            before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
            numbered = ranged.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy("o")))
            one = numbered.join(counts.select("part", before.alias("before")), "part").withColumn("ordinal", (F.col("before") + F.col("place")).cast("int"))
        one = one.select(F.lit(name).alias("section"), "ordinal", "text")
        out = one if out is None else out.unionByName(one)
    return out


def map_lines(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One ``text`` line a row, joined by ``|``; refused if a row lacks one of the columns."""
    lacking = F.lit(False)
    for c in columns:
        lacking = lacking | F.col(c).isNull() | (F.col(c).cast("string") == "")
    if not rows.filter(lacking).isEmpty():
        raise ValueError("rows without all columns")
    return rows.select(F.concat_ws("|", *columns).alias("text"))


def symbol_string(elements: DataFrame, keys: list[str], order: str, symbol: str, hold: Column) -> DataFrame:
    """(keys, symbols, plain): the symbols of each line in order, and without holds."""
    every = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(symbol).alias("s"), hold.alias("h"))))
    grouped = elements.groupBy(*keys).agg(every.alias("e"))
    text = lambda a: F.array_join(F.transform(a, lambda x: x["s"]), "")
    return grouped.select(*keys, text(F.col("e")).alias("symbols"), text(F.filter("e", lambda x: ~x["h"])).alias("plain"))


def split_codes(rows: DataFrame, keys: list[str], codes: str) -> DataFrame:
    """(keys, pos, code) of sequences of codes separated by spaces; codes, not characters, are the elements."""
    return rows.select(*keys, F.posexplode(F.filter(F.split(codes, " "), lambda x: x != "")).alias("pos", "code"))


def resolve_path(path: Column, root: str) -> Column:
    """A relative path below ``root``; absolute ones stay."""
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), F.regexp_replace(path, r"^(\./)+", "")))


def relative_path(path: Column, root: str) -> Column:
    """A path below ``root`` without it; others stay."""
    base = root.rstrip("/") + "/"
    return F.when(path.startswith(base), F.substring(path, len(base) + 1, 1 << 20)).otherwise(path)


def sibling(path: Column, ext: str) -> Column:
    """The path with another extension."""
    return F.regexp_replace(path, r"\.[^./]*$", "." + ext)


def repaired(text: Column, wrong: str = "latin-1", right: str = "gbk") -> Column:
    """A text that was decoded with the wrong character set, decoded with the right one; as it is if that can't be."""

    @F.pandas_udf(T.StringType())
    def repair(s: pd.Series) -> pd.Series:
        def one(x):
            try:
                return x if x is None else x.encode(wrong).decode(right)
            except UnicodeError:
                return x

        return s.map(one)

    return repair(text)


def centred(text: Column, width: Column, pad: int) -> Column:
    """Padded on both sides to ``pad`` columns, given how many it takes."""
    left = F.greatest(F.floor((F.lit(pad) - width) / 2), F.lit(0)).cast("int")
    right = F.greatest(F.lit(pad) - width - left, F.lit(0)).cast("int")
    return F.concat(F.repeat(F.lit(" "), left), text, F.repeat(F.lit(" "), right))


def text_width(text: Column, widths: dict[str, float], default: float = 1.0) -> Column:
    """The sum of the characters' widths."""
    table = F.create_map(*[F.lit(x) for kv in widths.items() for x in kv])
    each = F.transform(F.filter(F.split(text, ""), lambda x: x != ""), lambda c: F.coalesce(F.try_element_at(table, c), F.lit(default)))
    return F.aggregate(each, F.lit(0.0), lambda s, x: s + x)


def score_lines(notes: DataFrame, cells: DataFrame, keys: list[str], labels: Callable[[Column], Column], head: int = 6, least: int = 2) -> DataFrame:
    """(keys, part, text): a score's lines in columns. ``notes`` are (keys, slot, symbol), numbered from 0 without gaps, and
    ``cells`` (keys, part, slot, syllable), parts from 1; the notes are part 0.

    Each slot takes as many columns of a terminal as the widest symbol or syllable of its keys, ``least`` at least, and a space;
    wide characters take two. A part's line has all slots of the notes, empty ones too, so that the right borders are in
    line; syllables of other slots are left out. In front is the part's label in ``head`` columns.
    """
    both = notes.select(*keys, F.lit(0).alias("part"), "slot", F.col("symbol").alias("s")).unionByName(cells.select(*keys, F.col("part").cast("int").alias("part"), "slot", F.col("syllable").alias("s")))
    sized = both.withColumn("w", display_width(F.coalesce("s", F.lit(""))))
    widest = sized.groupBy(*keys).agg(F.greatest(F.max("w"), F.lit(least)).alias("width"), (F.max(F.when(F.col("part") == 0, F.col("slot"))) + 1).alias("n"))
    lines = sized.groupBy(*keys, "part").agg(F.map_from_entries(F.collect_list(F.struct("slot", F.struct("s", "w")))).alias("at")).join(widest.filter("n is not null"), keys)
    padded = lambda text, w, width: F.concat(text, F.repeat(F.lit(" "), F.greatest(width - w, F.lit(0))))
    cell = lambda k: F.struct(F.coalesce(F.try_element_at("at", k)["s"], F.lit("")).alias("s"), F.coalesce(F.try_element_at("at", k)["w"], F.lit(0)).alias("w"))
    slots = F.transform(F.transform(F.sequence(F.lit(0), F.col("n") - 1), cell), lambda c: F.concat(padded(c["s"], c["w"], F.col("width")), F.lit(" ")))
    label = labels(F.col("part"))
    front = padded(label, display_width(label), F.lit(head))
    return lines.select(*keys, "part", F.concat(front, F.lit("│"), F.array_join(slots, ""), F.lit("│")).alias("text"))
