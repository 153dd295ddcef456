"""Scores assembled from positioned notes and syllables: phrases, melody lines, beats, aligned syllables and line facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hexapla.operators.sequence import best_of, gap_groups, grid_positions, nearest


PHRASE = ["doc", "page", "phrase"]


def phrases(notes: DataFrame, gap: float) -> DataFrame:
    """From (doc, page, y, x, note, hold): the same with ``phrase``, layers of a page at most ``gap`` apart."""
    heights = notes.select("doc", "page", "y").distinct()
    grouped = gap_groups(heights, ["doc", "page"], ["y"], F.col("y"), gap, "phrase")
    return notes.join(grouped, ["doc", "page", "y"])


def lyric_blocks(placed: DataFrame, syllables: DataFrame, window: float, gap: float) -> DataFrame:
    """(doc, page, phrase, y, stanza, n): the rows of syllables that belong to each phrase, numbered from 1, and how many
    syllables they have.

    Of the rows of the page at most ``window`` below the phrase's last layer, those down to the first step of more than
    ``gap`` are its block. Of several rows only those stay that are as long as most of them are, the shorter of equals:
    titles and keys that stand above a score are of other lengths.
    """
    lowest = placed.groupBy(*PHRASE).agg(F.max("y").alias("bottom"))
    lines = syllables.groupBy("doc", "page", "y").agg(F.count("*").alias("n"))
    near = lowest.join(lines, ["doc", "page"]).filter((F.col("y") > F.col("bottom")) & (F.col("y") <= F.col("bottom") + window))
    block = gap_groups(near, PHRASE, ["y"], F.col("y"), gap, "island").filter("island = 0")
    usual = block.groupBy(*PHRASE).agg(F.mode("n", True).alias("usual"))
    kept = block.join(usual, PHRASE).filter("n = usual")
    return kept.withColumn("stanza", F.row_number().over(Window.partitionBy(*PHRASE).orderBy("y"))).select(*PHRASE, "y", "stanza", "n")


def melodies(placed: DataFrame, blocks: DataFrame, syllables: DataFrame, tolerance: float) -> DataFrame:
    """(doc, page, phrase, y, n): of each phrase the layer whose number of notes that aren't holds differs least from the
    first row's syllables (if there are any), then that with fewest syllables further than ``tolerance`` from its nearest
    note, then the topmost one. Layers of holds only count too."""
    first = blocks.filter("stanza = 1").select(*PHRASE, F.col("y").alias("row_y"), F.col("n").alias("said"))
    layers = placed.groupBy(*PHRASE, "y").agg(F.count_if(~F.col("hold")).alias("n")).join(first, PHRASE, "left")
    layers = layers.withColumn("layer", F.xxhash64(*PHRASE, "y"))
    sung = syllables.select("doc", "page", F.col("y").alias("row_y"), F.col("x").alias("sx"), "syllable")
    asked = layers.select("doc", "page", "row_y", "layer").join(sung, ["doc", "page", "row_y"])
    heads = placed.select(F.xxhash64(*PHRASE, "y").alias("layer"), "note", F.col("x").alias("nx"))
    far = nearest(asked, heads, "layer", "syllable", "note", "sx", "nx").groupBy("layer").agg(F.count_if(F.col("distance") > tolerance).alias("bad"))
    scored = layers.join(far, "layer", "left").withColumn("delta", F.coalesce(F.abs(F.col("n") - F.col("said")), F.lit(0)))
    return best_of(scored, PHRASE, ["delta", F.coalesce("bad", F.lit(0)), "y"]).select(*PHRASE, "y", "n")


def assemble(notes: DataFrame, syllables: DataFrame, gap: float, pitch: float, window: float, block_gap: float, tolerance: float) -> tuple[DataFrame, DataFrame]:
    """(notes, syllables) of the melody lines.

    Notes get ``line`` and ``beat``. The rows of a phrase's block are the line's stanzas; each of their syllables belongs to
    the nearest note of the line: ``note`` and ``distance``.
    """
    placed = phrases(notes, gap)
    blocks = lyric_blocks(placed, syllables, window, block_gap)
    lines = melodies(placed, blocks, syllables, tolerance).select(*PHRASE, F.xxhash64(*PHRASE).alias("line"), F.col("y").alias("line_y"))
    of_line = placed.join(lines, PHRASE).filter("y = line_y")
    on_grid = grid_positions(of_line, ["line"], ["x", "note"], F.col("x"), pitch).select("doc", "line", "note", "hold", "x", "beat", "span")
    rows = blocks.join(lines.select(*PHRASE, "line"), PHRASE).select("doc", "page", "y", "line", "stanza")
    said = syllables.join(rows, ["doc", "page", "y"]).select("doc", "line", "stanza", "syllable", F.col("x").alias("sx"))
    # a row may stand in two blocks, and its syllables are then sung on both lines
    near = nearest(said, on_grid.select("line", "note", F.col("x").alias("nx")), "line", "syllable", "note", "sx", "nx")
    return on_grid, said.drop("sx").join(near.select("line", "syllable", "note", "distance"), ["line", "syllable"])


def line_facts(notes: DataFrame, syllables: DataFrame, tolerance: float) -> DataFrame:
    """(doc, line, stanza, notes, syllables, count_delta, align_ok) of each line and stanza, stanza 0 for lines without
    syllables; ``notes`` are those that aren't holds. A delta of 0 is one to one, above 0 melisma, below a defect."""
    n = notes.groupBy("doc", "line").agg(F.count_if(~F.col("hold")).alias("notes"))
    s = syllables.groupBy("line", "stanza").agg(F.count("*").alias("syllables"), F.max("distance").alias("worst"))
    joined = n.join(s, "line", "left").withColumns({"stanza": F.coalesce("stanza", F.lit(0)), "syllables": F.coalesce("syllables", F.lit(0))})
    delta = F.col("notes") - F.col("syllables")
    return joined.select("doc", "line", "stanza", "notes", "syllables", delta.alias("count_delta"), ((delta == 0) & (F.coalesce("worst", F.lit(0.0)) <= tolerance)).alias("align_ok"))


def headers(facts: DataFrame, misaligned: Column) -> DataFrame:
    """(doc, lines, notes, syllables, defects, ok): a document fails on lines with too few notes, or misaligned ones."""
    return facts.groupBy("doc").agg(
        F.count("*").alias("lines"), F.sum("notes").alias("notes"), F.sum("syllables").alias("syllables"),
        F.count_if(F.col("count_delta") < 0).alias("defects"), (~F.bool_or((F.col("count_delta") < 0) | misaligned)).alias("ok"),
    )
