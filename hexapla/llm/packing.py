"""Packing of token sequences: shortest pack first over the length histogram.

A document's ids are cut into full sequences and one rest. Full sequences stand alone. Of the rests only the number of
each length is kept: lengths are placed longest first, each into the pattern with the most room left, and the counts of
patterns are updated, so that the work depends on the number of lengths and not of documents. Patterns are then joined
back to the rests by rank within their length. Ranks come from counts by length and salt; a length has a salt for every
``SALT_ROWS`` of its pieces, so no length, however common, is gathered in one task, and tasks don't grow with the input.

Defined cases: null and empty texts have the end id alone and are packed like any other. Rows with equal or null doc_ids
are pieces of their own. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hexapla.llm.common import releasing, written
from hexapla.llm.tokens import encoder, over_ids

#: Ids in a sequence.
SIZE = 1024
#: Distinct pieces of text whose ids a task keeps while it cuts documents.
MOST_PIECES = 1_000_000
#: Ranks are counted apart for each length and salt; a salt is to have so many pieces.
SALT_ROWS = 1_024


def pack_histogram(counts: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths, each with the number of sequences that follow it.

    ``counts`` gives how many pieces have each length (1 to ``size``). Patterns wait in a heap, the shortest pack first;
    as lengths fall, a pattern into which one length fits takes it for as many sequences as there are pieces left.
    """
    open_, closed, made = [], [], 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        refill = []
        while left and open_ and -open_[0][0] >= length:
            room, _, lengths, n = heapq.heappop(open_)
            taken = min(n, left)
            left -= taken
            refill.append((room + length, lengths + (length,), taken))
            if n > taken:
                refill.append((room, lengths, n - taken))
        while left:  # the same length again beside itself, in patterns just filled, before a new one is begun
            room, lengths, n = min(refill, default=(0, (), 0), key=lambda x: x[0])
            if -room < length:
                break
            refill.remove((room, lengths, n))
            taken = min(n, left)
            left -= taken
            refill.append((room + length, lengths + (length,), taken))
            if n > taken:
                refill.append((room, lengths, n - taken))
        if left:
            each = size // length
            full, rest = divmod(left, each)
            refill += [(-(size - each * length), (length,) * each, full)] * (full > 0)
            refill += [(-(size - rest * length), (length,) * rest, 1)] * (rest > 0)
        for room, lengths, n in refill:
            made += 1
            if room:
                heapq.heappush(open_, (room, made, lengths, n))
            else:
                closed.append((lengths, n))
    return closed + [(lengths, n) for _, _, lengths, n in open_]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, rank after the last, sequence of the first rank, offset): which ranks of a length go where."""
    out, used, sequence = [], defaultdict(int), 0
    for lengths, n in patterns:
        at = 0
        for length in lengths:
            out.append((length, used[length], used[length] + n, sequence, at))
            used[length] += n
            at += length
        sequence += n
    return out


def pieces(docs: DataFrame, path: str, end: int = 0, size: int = SIZE) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document's ids cut into full sequences and a rest."""

    def make_row():
        step = 4 * size

        def row(i, ids):
            n = len(ids) // 4
            for at in range(0, len(ids), step):
                part = ids[at : at + step]
                yield i, at // 4, len(part) // 4, zlib.crc32(part), n

        return row

    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    schema = pa.schema([(n, pa.int64()) for n in names])
    # a worker that kept its pieces would hold them through later stages that have no use for them
    run = releasing(over_ids(path, end, make_row, schema, MOST_PIECES), lambda: encoder(path, MOST_PIECES).forget())
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def packed(cut: DataFrame, size: int = SIZE, salt_rows: int = SALT_ROWS) -> DataFrame:
    """``cut`` (doc_id, start, length, ...) with ``sequence_id`` and ``offset``. ``cut`` is read more than once and should
    be a written table.

    To the driver come the counts of at most ``size`` lengths, and what is broadcast has one row for each length or for
    each length and pattern, however many documents there are. The ranks' bases, a row for every ``salt_rows`` pieces and
    one a length, are joined on the partitioning that the ranks have already.
    """
    spark = cut.sparkSession
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    salts = spark.createDataFrame([(k, -(-n // salt_rows)) for k, n in sorted(histogram.items())] or [(0, 1)], "s_length long, salts long")
    salted = cut.join(F.broadcast(salts), F.col("length") == F.col("s_length")).withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.col("salts"))).select(*cut.columns, "salt")
    counts = written(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "pack-counts")
    full = histogram.pop(size, 0)
    patterns = pack_histogram(histogram, size)
    places = [*slots(patterns), *([(size, 0, full, sum(n for _, n in patterns), 0)] if full else [])]
    place = spark.createDataFrame(places or [(0, 0, 0, 0, 0)], "p_length long, lo long, hi long, first long, offset long")
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    bases = written(counts.select(F.col("length").alias("b_length"), F.col("salt").alias("b_salt"), F.coalesce(before, F.lit(0)).alias("base")), "pack-bases")
    tie = [c for c in ("ids_crc32", "doc_tokens") if c in cut.columns]
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", *tie)) - 1
    ranked = salted.withColumn("within", within).join(bases, (F.col("length") == F.col("b_length")) & (F.col("salt") == F.col("b_salt")))
    ranked = ranked.withColumn("rank", F.col("base") + F.col("within"))
    on = (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    return ranked.join(F.broadcast(place), on).select(*cut.columns, (F.col("first") + F.col("rank") - F.col("lo")).alias("sequence_id"), "offset")


def packed_documents(docs: DataFrame, path: str, end: int = 0, size: int = SIZE) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text) and their places in sequences of ``size`` ids."""
    return packed(written(pieces(docs, path, end, size), "pack-pieces"), size)
