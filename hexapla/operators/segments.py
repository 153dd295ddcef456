"""Which texts may hold an item nearly whole: an index of the items' segments.

An item of L characters that may lose k of them is cut into k + 1 segments. Each loss, and each place where a text has
something between two of the item's characters, spoils one segment at most, so that a text with no more than k of them
together has a segment whole. Texts are joined with items by hashes of segments; characters of a text that begin no segment
of any item are passed over first, by a bitmap of bounded size. What is found stays to be compared.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of a segment that are looked up: as many of these as it has.
SIZES = (9, 6, 4, 3, 2)
#: Bits of the bitmap of all segments; more of them only let more characters through.
BITS = 1 << 24

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def run_hashes(text: str, size: int) -> np.ndarray:
    """A signed 64-bit hash of the ``size`` characters from each place on."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    n = len(points) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    points = (points ^ (points << np.uint64(23))) * np.uint64(0xD6E8FEB86659FD93)
    total = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(points * _powers(_BASE, len(points)), out=total[1:])
    h = (total[size:] - total[:-size]) * _powers(_INVERSE, n) + np.uint64(size)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xE7037ED1A0B428DB)
    return (h ^ (h >> np.uint64(29))).view(np.int64)


def _in_order(own: np.ndarray, runs: np.ndarray, places: np.ndarray, need: int) -> bool:
    """Whether ``need`` of ``own`` are found one behind the other in a text whose sorted ``runs`` stand at ``places``."""
    low, high = np.searchsorted(runs, own), np.searchsorted(runs, own, "right")
    ends: list[int] = []
    for k, (a, z) in enumerate(zip(low.tolist(), high.tolist(), strict=True)):
        if len(ends) >= need or len(ends) + len(own) - k < need:
            break
        for at in places[a:z][::-1].tolist():
            j = bisect_left(ends, at)
            ends[j : j + 1] = [at]
    return len(ends) >= need


def _sharing(text: str, items: list[str], lost: list[int], sizes: list[int], held: dict[tuple[str, int], np.ndarray]) -> list[bool]:
    """Whether the text has, one behind the other, as many of each item's runs of so many characters as are left if the ``lost``
    places spoil as many as they can. The text's runs are put in order once, and looked up for all items at once; ``held``
    keeps the items' runs."""
    fits = [False] * len(items)
    for q in set(sizes):
        some = [i for i, s in enumerate(sizes) if s == q]
        for i in some:
            if (items[i], q) not in held:
                held[items[i], q] = run_hashes(items[i], q)
        own = [held[items[i], q] for i in some]
        there, places, every = run_hashes(text, q), None, np.concatenate(own)
        runs = np.sort(there)
        found = runs[np.minimum(np.searchsorted(runs, every), len(runs) - 1)] == every if len(runs) else np.zeros(len(every), bool)
        for i, h, hit in zip(some, own, np.split(found, np.cumsum([len(h) for h in own[:-1]])), strict=True):
            need = len(h) - lost[i] * q
            fits[i] = need <= 0
            if not fits[i] and np.count_nonzero(hit) >= need:
                places = np.argsort(there, kind="stable") if places is None else places
                fits[i] = _in_order(h[hit], runs, places, need)
    return fits


@F.pandas_udf(T.ArrayType(T.BooleanType()))
def shares_runs(items: pd.Series, lost: pd.Series, sizes: pd.Series, text: pd.Series) -> pd.Series:
    """``_sharing`` of each text with its items."""
    held: dict[tuple[str, int], np.ndarray] = {}

    def one(xs, ks, qs, t):
        if len(held) > 4096:
            held.clear()
        return _sharing(t, list(xs), ks.tolist(), qs.tolist(), held)

    return pd.Series([one(*v) for v in zip(items, lost, sizes, text, strict=True)])


def losses(length: Column, percent: int) -> Column:
    """How many of ``length`` characters a text may lack that has ``percent`` of them."""
    return F.floor(length * (100 - percent) / 100).cast("int")


def segment_size(length: Column, percent: int) -> Column:
    """How many characters of each of an item's segments are looked up, or null where segments would be single characters."""
    whole = F.floor(length / (losses(length, percent) + 1))
    return F.coalesce(*[F.when(whole >= s, F.lit(s)) for s in SIZES])


@F.pandas_udf(T.ArrayType(T.LongType()))
def _item_keys(item: pd.Series, parts: pd.Series, size: pd.Series) -> pd.Series:
    """Hashes of the middle of each of the item's segments."""

    def one(text, n, q):
        h, ends = run_hashes(text, q), [len(text) * k // n for k in range(n + 1)]
        return sorted({int(h[a + (z - a - q) // 2]) for a, z in zip(ends, ends[1:], strict=False)})

    return pd.Series([one(*x) for x in zip(item, parts, size, strict=True)])


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Which remainders by BITS some key has, packed; at most one row for 64 of them comes to the driver."""
    spot = F.col("key").bitwiseAND(F.lit(BITS - 1))
    words = keys.select(F.shiftright(spot, 6).alias("word"), F.expr(f"shiftleft(1L, cast((key & {BITS - 1}) & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    out, got = np.zeros(BITS // 64, np.int64), words.toPandas()
    out[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def _text_keys(bitmap: np.ndarray, sizes: list[int]) -> Callable[[Column], Column]:
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def keys(text: pd.Series) -> pd.Series:
        def one(t):
            found = [np.zeros(0, np.int64)]
            for q in sizes if t else ():
                h = run_hashes(t, q)
                spot = h & (BITS - 1)
                found.append(h[(bitmap[spot >> 6] >> (spot & 63).astype(np.uint64)) & np.uint64(1) > 0])
            return np.unique(np.concatenate(found))

        return text.map(one, na_action=None)

    return keys


#: Characters of the runs that are counted in both before a text is compared.
RUN = 6
#: Segments of the items that are looked at in one text at once.
BLOCK = 20_000


def candidates(items: DataFrame, docs: DataFrame, percent: int, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """(doc_id, item_id, item, text) of texts (doc_id, text) that have a segment of an item (item_id, item) whole, and as many of
    its shorter runs as the losses leave. Items that are too short for segments have none. ``keep`` writes the items' keys and
    reads them back.

    A text meets all items that it shares a segment with in one row, or in one for each block of them where they are many."""
    n = F.length("item")
    cut = items.select("item_id", "item", (losses(n, percent) + 1).alias("parts"), segment_size(n, percent).alias("size")).filter("size is not null")
    keyed = keep(cut.select("item_id", "size", F.explode(_item_keys("item", "parts", "size")).alias("key")))
    sizes = sorted(r[0] for r in keyed.select("size").distinct().collect())
    blocks = 1 + keyed.count() // BLOCK
    there = docs.select("doc_id", F.explode(_text_keys(_bitmap(keyed), sizes)("text")).alias("key"))
    pairs = there.join(keyed, "key").select("doc_id", "item_id").distinct()
    asked = items.select("item_id", F.struct("item_id", "item", losses(n, percent).alias("lost"), F.least(segment_size(n, percent), F.lit(RUN)).alias("size")).alias("x"), F.pmod(F.xxhash64("item_id"), F.lit(blocks)).alias("block"))
    met = pairs.join(asked, "item_id").groupBy("doc_id", "block").agg(F.collect_list("x").alias("xs"))
    # few texts may be left, in few tasks, and looking at them takes long
    met = met.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id").join(docs.select("doc_id", "text"), "doc_id")
    of = lambda c: F.transform("xs", lambda x: x[c])
    found = met.select("doc_id", "text", F.arrays_zip("xs", shares_runs(of("item"), of("lost"), of("size"), F.col("text")).alias("fits")).alias("v"))
    found = found.withColumn("v", F.filter("v", lambda v: v["fits"])).filter(F.size("v") > 0)
    return found.select("doc_id", "text", F.explode("v.xs").alias("x")).select("doc_id", "x.item_id", "x.item", "text")
