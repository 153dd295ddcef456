"""Ordered sequences: gaps and islands, grids, pairing, fills, and nearest, range and interval joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def gap_groups(rows: DataFrame, keys: list[str], order: list[str], position: Column, gap: float, name: str = "island") -> DataFrame:
    """``rows`` with the number, from 0, of the group of positions that are at most ``gap`` apart within ``keys``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    step = position - F.lag(position).over(w)
    return rows.withColumn(name, F.sum(F.when(step > gap, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def grid_positions(rows: DataFrame, keys: list[str], order: list[str], position: Column, pitch: float) -> DataFrame:
    """``rows`` with ``beat``: 1 for the first, then the distance in pitches rounded half to even, 1 at least; and
    ``span``, the beats to the next, 1 for the last."""
    w = Window.partitionBy(*keys).orderBy(*order)
    step = F.greatest(F.lit(1), F.bround((position - F.lag(position).over(w)) / pitch).cast("long"))
    placed = rows.withColumn("beat", F.sum(F.coalesce(step, F.lit(1))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return placed.withColumn("span", F.greatest(F.lit(1), F.coalesce(F.lead("beat").over(w) - F.col("beat"), F.lit(1))))


def forward_fill(rows: DataFrame, keys: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """``rows`` with the last value, not null, up to and with each row."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(w))


def offsets(rows: DataFrame, keys: list[str], order: list[str], size: Column, name: str = "offset") -> DataFrame:
    """``rows`` with the sum of the sizes before each."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(name, F.coalesce(F.sum(size).over(w), F.lit(0)))


def numbered(rows: DataFrame, keys: list[str], order: list[str], name: str = "seq") -> DataFrame:
    """``rows`` numbered from 1 within ``keys``."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def collision_names(rows: DataFrame, base: str, order: list[str], name: str = "unique_name") -> DataFrame:
    """``rows`` with the base name, followed by ``_2``, ``_3`` ... from its second use on."""
    n = F.row_number().over(Window.partitionBy(base).orderBy(*order))
    return rows.withColumn(name, F.when(n == 1, F.col(base)).otherwise(F.concat(F.col(base), F.lit("_"), n.cast("string"))))


def best_of(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in an order that has no ties."""
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rank = 1").drop("_rank")


def pair_lines(rows: DataFrame, keys: list[str], order: list[str], leads: Column, text: Column, label: Column | None = None) -> DataFrame:
    """(keys, order, lead, follow): each leading line with the line after it, if that does not lead too; and lines that
    follow nothing, with a null lead. Labels that don't directly follow a leading line are passed over."""
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = rows.select(*keys, *order, text.alias("_text"), leads.alias("_leads"), (label if label is not None else F.lit(False)).alias("_label"))
    near = marked.withColumns({"_next": F.lead("_text").over(w), "_next_leads": F.lead("_leads").over(w), "_after": F.coalesce(F.lag("_leads").over(w), F.lit(False))})
    follow = F.when(F.coalesce(~F.col("_next_leads"), F.lit(False)), F.col("_next")).otherwise(F.lit(""))
    kept = near.filter(F.col("_leads") | (~F.col("_after") & ~F.col("_label")))
    return kept.select(*keys, *order, F.when(F.col("_leads"), F.col("_text")).alias("lead"), F.when(F.col("_leads"), follow).otherwise(F.col("_text")).alias("follow"))


def nearest(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str, left_at: str, right_at: str) -> DataFrame:
    """(key, left_id, right_id, distance): for each left row the right row of the same key that is nearest; ties go to the
    lower right position, then id.

    Both sides are united and sorted once by key and position: the nearest row is the last before or the first after, so
    no pairs are made, however many rows a key has.
    """
    side = lambda df, i, a, s: df.select(F.col(key).alias(key), F.col(i).alias("_id"), F.col(a).cast("double").alias("_at"), F.lit(s).alias("_side"))
    both = side(left, left_id, left_at, 1).unionByName(side(right, right_id, right_at, 0))
    spot = F.when(F.col("_side") == 0, F.struct("_at", "_id"))
    back = Window.partitionBy(key).orderBy("_at", "_side", F.desc("_id")).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(key).orderBy("_at", F.desc("_side"), "_id").rowsBetween(0, Window.unboundedFollowing)
    seen = both.withColumns({"_b": F.last(spot, ignorenulls=True).over(back), "_a": F.first(spot, ignorenulls=True).over(ahead)}).filter("_side = 1")
    before, after = F.col("_at") - F.col("_b._at"), F.col("_a._at") - F.col("_at")
    first = F.col("_b").isNotNull() & (F.col("_a").isNull() | (before <= after))
    pick = F.when(first, F.col("_b")).otherwise(F.col("_a"))
    return seen.select(key, F.col("_id").alias(left_id), pick["_id"].alias(right_id), F.abs(F.col("_at") - pick["_at"]).alias("distance"))


def first_within(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str, left_at: str, right_at: str, window: float) -> DataFrame:
    """(key, left_id, right_id): for each left row the first right row of the key in (at, at + window]; ties go to the lower
    id. Left rows without one are left out. One sort, no pairs."""
    side = lambda df, i, a, s: df.select(F.col(key).alias(key), F.col(i).alias("_id"), F.col(a).cast("double").alias("_at"), F.lit(s).alias("_side"))
    both = side(left, left_id, left_at, 1).unionByName(side(right, right_id, right_at, 0))
    ahead = Window.partitionBy(key).orderBy("_at", "_side", "_id").rowsBetween(0, Window.unboundedFollowing)
    seen = both.withColumn("_a", F.first(F.when(F.col("_side") == 0, F.struct("_at", "_id")), ignorenulls=True).over(ahead)).filter("_side = 1")
    return seen.filter(F.col("_a._at") <= F.col("_at") + window).select(key, F.col("_id").alias(left_id), F.col("_a._id").alias(right_id))


def overlaps(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str, left_span: tuple[str, str], right_span: tuple[str, str], cell: float) -> DataFrame:
    """(key, left_id, right_id) of spans of the same key that overlap, strictly: start < other's end both ways.

    Of two spans that overlap, one begins inside the other, or both begin together. A span is therefore filed under cells of
    its own size class: it is in one or two cells of a width between its length and twice that. Starts of spans are looked up
    in the cells that hold them, one for each size class that the key has, so a span of any length makes as few rows.
    ``cell`` is the width of the least class; all shorter spans are in it.
    """

    def spans(df, i, span, p):
        a, b = F.col(span[0]).cast("double"), F.col(span[1]).cast("double")
        level = F.greatest(F.ceil(F.log2((b - a) / cell)), F.lit(0)).cast("int")
        return df.filter(b > a).select(F.col(key).alias(f"{p}_key"), F.col(i).alias(f"{p}_id"), a.alias(f"{p}_a"), b.alias(f"{p}_b"), level.alias(f"{p}_level"))

    def inside(holders, h, starters, s, strict):
        """Pairs in which a starter begins within a holder; at the same start only if not ``strict``."""
        width = F.lit(cell) * F.pow(F.lit(2.0), F.col(f"{h}_level"))
        place = F.explode(F.array_distinct(F.array(F.floor(F.col(f"{h}_a") / width), F.floor(F.col(f"{h}_b") / width))))
        filed = holders.withColumn(f"{h}_cell", place)
        levels = holders.groupBy(F.col(f"{h}_key").alias("k")).agg(F.collect_set(f"{h}_level").alias("levels"))
        asked = starters.join(levels, F.col(f"{s}_key") == F.col("k")).withColumn("level", F.explode("levels"))
        asked = asked.withColumn("cell", F.floor(F.col(f"{s}_a") / (F.lit(cell) * F.pow(F.lit(2.0), F.col("level")))))
        begins = (F.col(f"{s}_a") > F.col(f"{h}_a")) if strict else (F.col(f"{s}_a") >= F.col(f"{h}_a"))
        on = (F.col(f"{h}_key") == F.col(f"{s}_key")) & (F.col(f"{h}_level") == F.col("level")) & (F.col(f"{h}_cell") == F.col("cell"))
        return filed.join(asked, on & begins & (F.col(f"{s}_a") < F.col(f"{h}_b"))).select("l_key", "l_id", "r_id")

    one, two = spans(left, left_id, left_span, "l"), spans(right, right_id, right_span, "r")
    found = inside(one, "l", two, "r", False).unionByName(inside(two, "r", one, "l", True))
    return found.select(F.col("l_key").alias(key), F.col("l_id").alias(left_id), F.col("r_id").alias(right_id))


def layers(glyphs: DataFrame, keys: list[str], y: str, digits: int = 1) -> DataFrame:
    """``glyphs`` with ``layer``, the rounded height, and ``slot``, the number from left to right on it (x0, then the rest)."""
    rest = [c for c in glyphs.columns if c not in (*keys, y, "x0")]
    placed = glyphs.withColumn("layer", F.bround(F.col(y), digits))
    return placed.withColumn("slot", F.row_number().over(Window.partitionBy(*keys, "layer").orderBy("x0", *rest)))


def melody_layers(placed: DataFrame, keys: list[str], least: int, tall: Column) -> DataFrame:
    """Layers of at least ``least`` glyphs of which not more than half are over-tall."""
    out = placed.groupBy(*keys, "layer").agg(F.count("*").alias("n"), F.count_if(tall).alias("tall"))
    return out.filter((F.col("n") >= least) & (F.col("tall") * 2 <= F.col("n")))


def isomorphic(codes: Column, symbols: Column) -> Column:
    """Whether two arrays are of equal length, and each code always stands beside the same symbol."""
    pairs = F.array_distinct(F.arrays_zip(codes.alias("c"), symbols.alias("s")))
    return (F.size(codes) == F.size(symbols)) & (F.size(pairs) == F.size(F.array_distinct(codes)))


def syllable_spans(aligned: DataFrame, keys: list[str], slot: str, x: Column, element: Column, tolerance: float) -> DataFrame:
    """``aligned`` with ``span``: 2 where a syllable is more than ``tolerance`` from its element and nearer to the middle
    between that and a neighbour, else 1."""
    w = Window.partitionBy(*keys).orderBy(slot)
    delta = F.abs(x - element)
    to = lambda other: F.abs(x - (element + other) / 2)
    mid = F.least(to(F.lag(element).over(w)), to(F.lead(element).over(w)))
    return aligned.withColumn("span", F.when((delta > tolerance) & (mid < delta), 2).otherwise(1))
