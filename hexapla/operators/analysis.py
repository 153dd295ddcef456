"""A score's rows laid on the lines of its text edition, with what that teaches and where the syllables stand.

Rows are the heights of a page with notes enough. Those that fit a line of the same document, by what is known of the codes or is
learned on the way, are its matches. Below a matched row, the first block of sung rows belongs to it; the syllables of the
block's topmost row are laid on the row's notes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hexapla.operators.sequence import gap_groups
from hexapla.operators.vote import LINE, align_rounds, greedy_align

ROW = ["doc", "page", "y"]


@dataclass(frozen=True)
class Analysis:
    """``matches`` (doc, page, y, line, learned, skipped), ``cells`` (doc, page, y, place, syllable, note, code, distance, span),
    ``votes`` (code, symbol, n, total), ``modifiers`` (doc, code) and ``marks`` (code)."""

    matches: DataFrame
    cells: DataFrame
    votes: DataFrame
    modifiers: DataFrame
    marks: DataFrame


def melody_rows(notes: DataFrame, least: int) -> DataFrame:
    """From (doc, page, y, x, code): (doc, page, y, codes, places) of heights with ``least`` notes, from left to right."""
    rows = notes.groupBy(*ROW).agg(F.array_sort(F.collect_list(F.struct("x", "code"))).alias("s")).filter(F.size("s") >= least)
    return rows.select(*ROW, F.transform("s", lambda e: e["code"]).alias("codes"), F.transform("s", lambda e: e["x"].cast("double")).alias("places"))


def _matches(pairs: DataFrame, known: DataFrame, gap: float) -> DataFrame:
    """Pairs (doc, page, y, line, codes, places, symbols) that align with what is known."""
    each = pairs.select(*ROW, F.explode(F.array_distinct("codes")).alias("code")).distinct().join(known, "code")
    said = each.groupBy(*ROW).agg(F.collect_list(F.struct("code", "symbol")).alias("said"))

    def align(batches):
        for pdf in batches:
            out = []
            for doc, page, y, line, codes, places, symbols, table in zip(*[pdf[c] for c in ("doc", "page", "y", "line", "codes", "places", "symbols", "said")], strict=True):
                got = greedy_align(list(codes), list(places), list(symbols), {} if table is None else {e["code"]: e["symbol"] for e in table}, gap)
                if got:
                    out.append((doc, page, y, line, [{"code": c, "symbol": s} for c, s in sorted(got[0].items())], got[1]))
            yield pd.DataFrame(out, columns=["doc", "page", "y", "line", "learned", "skipped"])

    kinds = {f.name: f.dataType.simpleString() for f in pairs.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in (*ROW, "line")) + ", learned array<struct<code:string,symbol:string>>, skipped array<string>"
    return pairs.join(said, ROW, "left").select(*ROW, "line", "codes", "places", "symbols", "said").mapInPandas(align, schema)


def cells_of(hits: DataFrame, sung: DataFrame, window: float, block_gap: float, tolerance: float) -> DataFrame:
    """The syllables of the topmost row of each hit's block of sung rows, each on its nearest note, the left one of equals:
    rows at most ``window`` below, up to the first step of more than ``block_gap``. ``span`` is 2 if a syllable is further than
    ``tolerance`` from its note and nearer to the middle between that and a neighbour."""
    heights = sung.select("doc", "page", F.col("y").alias("sy")).distinct()
    near = hits.select(*ROW).join(heights, ["doc", "page"]).filter((F.col("sy") > F.col("y")) & (F.col("sy") <= F.col("y") + window))
    top = gap_groups(near, ROW, ["sy"], F.col("sy"), block_gap, "island").filter("island = 0").groupBy(*ROW).agg(F.min("sy").alias("sy"))
    said = top.join(sung.select("doc", "page", F.col("y").alias("sy"), F.col("x").cast("double").alias("sx"), "syllable"), ["doc", "page", "sy"])
    said = said.withColumn("place", F.row_number().over(Window.partitionBy(*ROW).orderBy("sx", "syllable")) - 1)
    both = said.join(hits, ROW).withColumn("best", F.array_min(F.transform("places", lambda p, i: F.struct(F.abs(p - F.col("sx")).alias("d"), i.alias("i")))))
    at = F.col("best.i")
    middle = lambda other: F.abs(F.col("sx") - (F.get("places", at) + F.get("places", other)) / 2) < F.col("best.d")
    wide = (F.col("best.d") > tolerance) & (F.coalesce(middle(at - 1), F.lit(False)) | F.coalesce(middle(at + 1), F.lit(False)))
    return both.select(*ROW, "place", "syllable", at.alias("note"), F.get("codes", at).alias("code"), F.col("best.d").alias("distance"), F.when(wide, 2).otherwise(1).alias("span"))


def analysed(
    notes: DataFrame, lines: DataFrame, sung: DataFrame, known: DataFrame | None = None, least: int = 4, gap: float = 15.0, window: float = 60.0, block_gap: float = 20.0, tolerance: float = 8.0,
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Analysis:
    """``notes`` are (doc, page, y, x, code), ``lines`` (doc, line, symbols), ``sung`` (doc, page, y, x, syllable). Without a
    dictionary ``known`` (code, symbol), one is learned from all documents' rows and lines together. Votes count the codes of
    matched rows with the symbols beside them, once a match; the symbol of most votes stands for a code, the lower of equals.
    Modifiers are codes of matched rows that are not known, and marks the known codes that take no beat."""
    rows = keep(melody_rows(notes, least))
    # rows are tried with their own document's lines only, those that are no longer than they are
    pairs = keep(rows.join(lines.filter(F.size("symbols") > 0), "doc").filter(F.size("codes") >= F.size("symbols")).select(*ROW, "line", "codes", "places", "symbols"))
    known = keep(align_rounds(pairs.select("codes", "places", "symbols"), gap=gap, keep=keep) if known is None else known.select("code", "symbol"))
    matches = keep(_matches(pairs, known, gap))
    hits = matches.select(*ROW).distinct().join(rows, ROW)
    own = matches.join(rows.select(*ROW, F.explode(F.array_distinct("codes")).alias("code")), ROW).join(known, "code").filter(F.col("symbol") != LINE)
    votes = own.select("code", "symbol").unionByName(matches.select(F.explode("learned").alias("v")).select("v.code", "v.symbol"))
    votes = votes.groupBy("code", "symbol").agg(F.count("*").alias("n"))
    best = votes.groupBy("code").agg(F.min_by(F.struct("symbol", "n"), F.struct(-F.col("n"), "symbol")).alias("b"), F.sum("n").alias("total"))
    modifiers = hits.select("doc", F.explode("codes").alias("code")).distinct().join(known, "code", "left_anti").select("doc", "code")
    return Analysis(matches, cells_of(hits, sung, window, block_gap, tolerance), best.select("code", "b.symbol", "b.n", "total"), modifiers, known.filter(F.col("symbol") == LINE).select("code"))
