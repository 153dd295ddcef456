"""Phrases of two to five words that occur together more often than their parts would, language by language.

Every occurrence of a word begins a path: that word and up to four more of its piece of text. Paths are counted in tries:

- each task builds tries of blocks of text, merges them while they have no more than ``MOST_PATHS`` paths, and writes them
  sorted by path: how many words each path shares with the one before, then, level by level, the words that it does not;
- the paths are divided into ranges of about ``RANGE_PATHS``, at quantiles of the written tries. A range may begin at any
  path, so that a word or a pair of words, however frequent, is divided like the rest. With more than ``MOST_RANGES``
  ranges, tries are dealt out twice;
- the tries of a range, each sorted, are merged, and phrases counted as runs of their paths. A phrase whose paths may lie in
  several ranges too is the beginning of a range's first or last path; those partial counts, ten for each range at most, are
  added up after.

Phrases that occur often enough are kept with all their parts, since these occur at least as often. One join of this common
trie with itself gives each phrase the counts of its parts. The phrase that is a word shorter at its end, its parent, and the
one that lacks its first word, its suffix link, tell what lies in longer phrases.

Defined cases: a null text is empty, a null language is ``und``, as is the language of that name. Equal rows count each.
Texts are read whole; longer ones than a block are cut between pieces. Words are what lies between spaces and tabs, whatever
else they contain. Ties in score, count and rank are ordered by count and by the phrase's bytes. A language without phrases
has no rows, an empty table none at all. Columns other than ``text`` and ``lang`` are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexapla.llm.common import releasing, small_batches, written

#: Words of the longest phrase, occurrences of the rarest, share of a longer phrase's count that drops it, and rows of a
#: language.
DEPTH, LEAST, SHARE, FIRST = 5, 100, 100, 2000
#: Bytes of text in a block; paths in a task's trie, in a range, and between two of the marks that give the quantiles.
BLOCK_BYTES, MOST_PATHS, RANGE_PATHS, STEP = 2 << 20, 450_000, 500_000, 10_000
#: Bytes that a task passes to Python at a time.
BATCH_BYTES = 4 << 20
#: Ranges that tries are dealt out to at a time, marks that these are chosen from, and bytes of a word in a mark.
MOST_RANGES, MOST_MARKS, MARK_BYTES = 1024, 1_000_000, 64

_FOLD = bytes(10 if chr(c) in ".,;:!?\n\v\f\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_PIECE = re.compile(rb"[.,;:!?\n\v\f\r]")


class Trie(NamedTuple):
    """Sorted paths with their counts; ``columns[d]`` has the place of each path's word d among the sorted ``words``, from 1, or
    0 where the path has ended."""

    words: list[bytes] | pa.LargeBinaryArray
    columns: list[np.ndarray]
    counts: np.ndarray


def _keys(columns: list[np.ndarray], size: int) -> list[np.ndarray]:
    """Paths packed to as few numbers as hold them, in the order of the paths."""
    bits = max(1, size.bit_length())
    per = 63 // bits
    out = []
    for at in range(0, len(columns), per):
        key = np.zeros(len(columns[0]), np.uint64)
        for c in columns[at : at + per]:
            key = (key << np.uint64(bits)) | c.astype(np.uint64)
        out.append(key)
    return out


def _merged(words: list[bytes], columns: list[np.ndarray], counts: np.ndarray | None) -> Trie:
    """The paths of sorted runs, one after the other, as one trie; equal paths are added up. Without counts, each counts 1."""
    keys = _keys(columns, len(words))
    order = np.argsort(keys[0], kind="stable")  # merges the runs
    lead = keys[0][order]
    if len(keys) > 1:
        same = np.concatenate([[False], lead[1:] == lead[:-1], [False]])
        tied = np.flatnonzero(same[1:] | same[:-1])
        some = order[tied]
        order[tied] = some[np.lexsort([k[some] for k in reversed(keys)])]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
    first = np.flatnonzero(new)
    added = np.diff(first, append=len(order)) if counts is None else np.add.reduceat(counts[order], first) if len(first) else counts
    return Trie(words, [c[order[first]] for c in columns], added)


def trie_of(texts: list[bytes]) -> Trie:
    """The paths of all words of some texts."""
    number = defaultdict(count().__next__)
    number[b"\n"]
    ids = np.fromiter(map(number.__getitem__, filter(None, b"\n".join(texts).translate(_FOLD).replace(b"\n", b" \n ").split(b" "))), np.int64)
    del number[b"\n"]
    words = sorted(number)
    place = np.zeros(len(words) + 1, np.uint32)
    place[[number[w] for w in words]] = np.arange(1, len(words) + 1)
    line = np.concatenate([place[ids], np.zeros(DEPTH, np.uint32)])
    at = np.flatnonzero(line)
    columns = [line[at]]
    for d in range(1, DEPTH):
        columns.append(np.where(columns[-1] > 0, line[at + d], 0).astype(np.uint32))
    return _merged(words, columns, None)


def merged(tries: list[Trie]) -> Trie:
    """Several tries as one."""
    if len(tries) == 1:
        t = tries[0]
        return t if isinstance(t.words, list) else t._replace(words=t.words.to_pylist())
    each = pa.concat_arrays([pa.array(t.words, pa.large_binary()) for t in tries]).dictionary_encode()
    order = pc.array_sort_indices(each.dictionary)
    place = np.zeros(len(order), np.uint32)
    place[order] = np.arange(1, len(order) + 1)
    words, maps = each.dictionary.take(order).to_pylist(), np.split(place[each.indices], np.cumsum([len(t.words) for t in tries])[:-1])
    columns = [np.concatenate([np.append(np.uint32(0), m)[t.columns[d]] for m, t in zip(maps, tries, strict=True)]) for d in range(DEPTH)]
    return _merged(words, columns, np.concatenate([t.counts for t in tries]))


def part(t: Trie, a: int, z: int) -> Trie:
    """The paths from a up to z."""
    columns = [c[a:z] for c in t.columns]
    used = np.zeros(len(t.words) + 1, bool)
    for c in columns:
        used[c] = True
    used[0] = False
    place = np.cumsum(used).astype(np.uint32)
    place[0] = 0
    return Trie([t.words[k - 1] for k in np.flatnonzero(used).tolist()], [place[c] for c in columns], t.counts[a:z])


def _prefix_changes(t: Trie) -> list[np.ndarray]:
    """For each depth the paths whose first words, up to it, differ from those of the path before."""
    out, new = [], np.zeros(len(t.counts), bool)
    new[:1] = True
    for c in t.columns:
        new = new.copy()
        new[1:] |= c[1:] != c[:-1]
        out.append(np.flatnonzero(new))
    return out


def pack(t: Trie) -> bytes:
    """A trie as bytes."""
    shared = np.full(len(t.counts), DEPTH, np.uint8)
    levels = []
    for d, at in reversed(list(enumerate(_prefix_changes(t)))):
        shared[at] = d
        levels.append(t.columns[d][at].astype("<u2" if len(t.words) < 1 << 16 else "<u4"))
    parts = [np.frombuffer(b"\n".join(t.words), np.uint8), shared, t.counts.astype("<u4" if t.counts.max(initial=0) < 1 << 32 else "<u8"), *levels[::-1]]
    head = np.array([[p.dtype.itemsize, len(p)] for p in parts], "<i8")
    return zstandard.compress(head.tobytes() + b"".join(p.tobytes() for p in parts), 1)


def unpack(data: bytes) -> Trie:
    """The trie of what ``pack`` made of it."""
    t = unlisted(data)
    return t._replace(words=t.words.to_pylist())


def unlisted(data: bytes) -> Trie:
    """The same for merging only, its words an Arrow array: as objects they take several times the memory of its paths."""
    data, at, parts = zstandard.decompress(data), 16 * (DEPTH + 3), []
    for width, n in np.frombuffer(data, "<i8", 2 * (DEPTH + 3)).reshape(-1, 2).tolist():
        parts.append(np.frombuffer(data, f"<u{width}", n, at))
        at += width * n
    words, shared, counts, *levels = parts
    columns = [level[np.cumsum(shared <= d) - 1].astype(np.uint32) for d, level in enumerate(levels)]
    starts = np.concatenate([[0], np.flatnonzero(words == 10) + 1, [len(words) + 1]]) if len(words) else np.zeros(1, np.int64)
    kept = words[words != 10]
    offsets = starts - np.arange(len(starts))
    offsets[0] = 0
    return Trie(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(kept)]), columns, counts.astype(np.int64))


def below(t: Trie, path: list[bytes]) -> int:
    """How many paths come before ``path``, whose words need not be in the trie."""
    a, z = 0, len(t.counts)
    for d, w in enumerate(path):
        k = bisect_left(t.words, w)
        c = t.columns[d][a:z]
        if k == len(t.words) or t.words[k] != w:
            return a + int(np.searchsorted(c, k + 1))
        a, z = a + int(np.searchsorted(c, k + 1)), a + int(np.searchsorted(c, k + 1, "right"))
    return a


def phrases(t: Trie, least: int) -> Iterator[tuple[str, int, int]]:
    """(phrase, depth, count) of those with ``least`` occurrences, and of the beginnings of the first and the last path."""
    total = np.concatenate([[0], np.cumsum(t.counts)])
    for d, at in enumerate(_prefix_changes(t)):
        n = np.diff(total[np.append(at, len(t.counts))])
        wanted = n >= least
        wanted[[0, -1]] = True
        wanted &= t.columns[d][at] > 0
        for i, c in zip(at[wanted].tolist(), n[wanted].tolist(), strict=True):
            yield b" ".join(t.words[t.columns[k][i] - 1] for k in range(d + 1)).decode(), d + 1, c


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in parts of about a block, cut between its pieces."""
    at = 0
    while len(text) - at > BLOCK_BYTES and (m := _PIECE.search(text, at + BLOCK_BYTES)):
        yield text[at : m.start()]
        at = m.end()
    yield text[at:]


def _path(t: Trie, i: int) -> list[bytes]:
    """A path's words, long ones cut: any list of words divides paths."""
    return [t.words[c[i] - 1][:MARK_BYTES] for c in t.columns if c[i]]


_TRIES = "range long, lang string, body binary, paths long, words long, marks array<array<binary>>"


def _row(spot: int, lang: str, t: Trie) -> pa.RecordBatch:
    marks = [_path(t, i) for i in range(STEP // 2, len(t.counts), STEP)]
    columns = [[spot], [lang], [pack(t)], [len(t.counts)], [int(t.counts.sum())], [marks]]
    types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.binary()))]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types, strict=True)], ["range", "lang", "body", "paths", "words", "marks"])


class _Held:
    """Tries of one range that wait to be merged, by language."""

    def __init__(self):
        self.tries, self.size = defaultdict(list), 0

    def add(self, lang: str, t: Trie) -> bool:
        """Whether they are too many now."""
        if len(t.counts):
            self.tries[lang].append(t)
            self.size += len(t.counts)
        if self.size <= MOST_PATHS:
            return False
        self.tries = defaultdict(list, {k: [merged(v)] for k, v in self.tries.items()})
        self.size = sum(len(v[0].counts) for v in self.tries.values())
        return self.size > MOST_PATHS // 2

    def empty(self, spot: int) -> Iterator[pa.RecordBatch]:
        for lang, v in self.tries.items():
            yield _row(spot, lang, merged(v))
        self.tries, self.size = defaultdict(list), 0


def built(docs: DataFrame) -> DataFrame:
    """Tries of the paths of ``docs`` (lang, text), all of range 0."""

    def build(batches):
        held, texts, size = _Held(), defaultdict(list), 0
        for b in batches:
            for at in range(0, b.num_rows, 512):
                rows = b.slice(at, 512)
                for lang, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                    for piece in _pieces(text):
                        texts[lang].append(piece)
                        size += len(piece) + 1
                        if size > BLOCK_BYTES:
                            full = [held.add(k, trie_of(v)) for k, v in texts.items()]
                            texts, size = defaultdict(list), 0
                            if full[-1]:
                                yield from held.empty(0)
        for k, v in texts.items():
            held.add(k, trie_of(v))
        yield from held.empty(0)

    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")).mapInArrow(releasing(build), _TRIES)


def bounds(tries: DataFrame, per: int) -> DataFrame:
    """(b_range, first, cuts): where the paths of each range are cut into new ones of about ``per`` paths, and the number of the
    first of these. Beyond ``MOST_MARKS`` a share of the marks is chosen by hash; that only moves the cuts."""
    marks = tries.select("range", "lang", F.explode("marks").alias("path"))
    total = tries.agg(F.sum("paths")).first()[0] or 0
    keep = min(1.0, MOST_MARKS * STEP / max(1, total))
    if keep < 1 and tries.select("range").distinct().count() == 1:
        marks, per = marks.filter(F.pmod(F.xxhash64("lang", "path"), F.lit(1 << 20)) < int(keep * (1 << 20))), per * keep
    every = max(1, round(per / STEP))
    order = Window.partitionBy("range").orderBy("lang", "path")
    chosen = marks.withColumn("n", F.row_number().over(order)).filter(F.col("n") % every == 0)
    cuts = chosen.groupBy("range").agg(F.sort_array(F.collect_list(F.struct("lang", "path"))).alias("cuts"))
    both = tries.select("range").distinct().withColumnRenamed("range", "b_range").join(cuts, F.col("b_range") == F.col("range"), "left")
    both = both.select("b_range", F.coalesce("cuts", F.array().cast("array<struct<lang:string,path:array<binary>>>")).alias("cuts"))
    return written(both.withColumn("first", F.col("b_range") * F.lit(4 * MOST_RANGES)), "collocations-bounds")


def dealt(tries: DataFrame, where: DataFrame, parts: int) -> DataFrame:
    """Tries cut at the bounds of their ranges and brought together by new range. The new ranges of one old range, which are
    numbered in a row, go to partitions in a row: dealt by a hash, a few partitions would get several times the usual."""

    def cut(batches):
        for b in batches:
            for i in range(b.num_rows):
                lang, body, cuts, first = (c[i].as_py() for c in b.columns)
                t = unpack(body)
                ahead = sum(c["lang"] < lang for c in cuts)
                ends = [below(t, c["path"]) for c in cuts[ahead:] if c["lang"] == lang]
                rows = []
                for k, (a, z) in enumerate(zip([0, *ends], [*ends, len(t.counts)], strict=True)):
                    if a < z:
                        rows.append((first + ahead + k, lang, pack(part(t, a, z))))
                        if len(rows) == 64:
                            yield _lots(rows)
                            rows = []
                if rows:
                    yield _lots(rows)

    cuts = tries.join(where, F.col("range") == F.col("b_range")).select("lang", "body", "cuts", "first")
    lots = cuts.mapInArrow(releasing(cut), "range long, lang string, body binary")
    old = F.floor(F.col("range") / (4 * MOST_RANGES))
    spot = F.pmod(F.pmod(F.xxhash64(old), F.lit(parts)) + F.col("range"), F.lit(parts)).cast("int")
    return lots.repartitionById(parts, spot).sortWithinPartitions("range")


def _lots(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [pa.int64(), pa.string(), pa.binary()], strict=True)], ["range", "lang", "body"])


def remerged(lots: DataFrame) -> DataFrame:
    """Tries of the same range merged, up to the size of a task's."""

    def merge(batches):
        held, now = _Held(), None
        for b in batches:
            for i in range(b.num_rows):
                spot, lang, body = (c[i].as_py() for c in b.columns)
                if spot != now and now is not None:
                    yield from held.empty(now)
                now = spot
                if held.add(lang, unlisted(body)):
                    yield from held.empty(now)
        if now is not None:
            yield from held.empty(now)

    return lots.mapInArrow(releasing(merge), _TRIES)


def counted(lots: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, depth, n) of the merged tries of each range; see ``phrases``."""

    def count_(batches):
        tries, now = defaultdict(list), None

        def found():
            for lang, v in tries.items():
                rows = list(phrases(merged(v), least))
                for at in range(0, len(rows), 10_000):
                    phrase, depth, n = zip(*rows[at : at + 10_000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), pa.array(phrase), pa.array(depth, pa.int32()), pa.array(n, pa.int64())], ["lang", "phrase", "depth", "n"])

        for b in batches:
            for i in range(b.num_rows):
                spot, lang, body = (c[i].as_py() for c in b.columns)
                if spot != now:
                    yield from found()
                    tries, now = defaultdict(list), spot
                tries[lang].append(unlisted(body))
        yield from found()

    return lots.mapInArrow(releasing(count_), "lang string, phrase string, depth int, n long")


def common_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, depth, n) of all phrases of up to DEPTH words that occur ``least`` times, and (lang, total) words."""
    with small_batches(docs.sparkSession, BATCH_BYTES):
        parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tries = written(built(docs), "collocations-tries")
        totals = written(tries.groupBy("lang").agg(F.sum("words").alias("total")), "collocations-words")
        ranges = (tries.agg(F.sum("paths")).first()[0] or 0) // RANGE_PATHS + 1
        while ranges > MOST_RANGES:
            wide = -(-ranges // MOST_RANGES)
            tries = written(remerged(dealt(tries, bounds(tries, RANGE_PATHS * wide), parts)), "collocations-merged")
            ranges = wide
        lots = dealt(tries, bounds(tries, RANGE_PATHS), max(1, min(parts, (tries.agg(F.sum("paths")).first()[0] or 0) // RANGE_PATHS + 1)))
        found = counted(lots, least).groupBy("lang", "phrase", "depth").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
        return written(found, "collocations-phrases"), totals


def with_parts(nodes: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(lang, phrase, depth, n, parent, suffix, lefts, rights) of phrases of two words and more: what is a word shorter at the end
    and at the beginning, and counts of the first 1, 2, ... words and of what follows them.

    One join looks up all parts. Joins from level to level, each of which reads the level before for both sides, would double the
    plan with every level; the driver holds that plan and all its stages."""
    words, cuts = F.split("phrase", " "), depth - 1
    some = lambda start, length: F.array_join(F.slice(words, start, length), " ")
    each = F.sequence(F.lit(1), F.col("depth") - 1)
    left = F.transform(each, lambda k: F.struct((k - 1).alias("place"), some(F.lit(1), k).alias("part")))
    right = F.transform(each, lambda k: F.struct((k - 1 + cuts).alias("place"), some(k + 1, F.col("depth") - k).alias("part")))
    asked = nodes.filter("depth > 1").select("lang", "phrase", "depth", "n", F.inline(F.concat(left, right)))
    counts = nodes.select(F.col("lang").alias("p_lang"), F.col("phrase").alias("p_phrase"), F.col("n").alias("m"))
    found = asked.join(counts, (F.col("lang") == F.col("p_lang")) & (F.col("part") == F.col("p_phrase")))
    wide = found.groupBy("lang", "phrase", "depth", "n").agg(*(F.max(F.when(F.col("place") == k, F.col("m"))).alias(f"m{k}") for k in range(2 * cuts)))
    sides = (F.slice(F.array(*(f"m{k}" for k in range(at, at + cuts))), F.lit(1), F.col("depth") - 1) for at in (0, cuts))
    ends = some(F.lit(1), F.col("depth") - 1).alias("parent"), some(F.lit(2), F.col("depth") - 1).alias("suffix")
    return wide.select("lang", "phrase", "depth", "n", *ends, *(c.alias(name) for c, name in zip(sides, ("lefts", "rights"), strict=True)))


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, first: int = FIRST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``first`` phrases by score. A phrase cut after k words has score
    floor(1000 * a * n / (l * r)), with a, l and r the counts of the phrase and its two parts and n that of all words; the
    least score counts. Phrases go that lie in a longer one that occurs ``share`` per cent as often."""
    nodes, totals = common_phrases(docs, least)
    scored = written(with_parts(nodes), "collocations-parts")
    longer = scored.filter("depth > 2").select("lang", F.explode(F.array("parent", "suffix")).alias("inner"), "n")
    longer = longer.groupBy(F.col("lang").alias("i_lang"), "inner").agg(F.max("n").alias("longest"))
    free = scored.join(longer, (F.col("lang") == F.col("i_lang")) & (F.col("phrase") == F.col("inner")), "left").filter(f"longest is null or 100 * longest < {share} * n")
    totals = totals.select(F.col("lang").alias("t_lang"), "total")
    exact = lambda x: f"cast({x} as decimal(19, 0))"
    score = f"({exact('1000 * n')} * {exact('total')}) div ({exact('lefts[k - 1]')} * {exact('rights[k - 1]')})"
    cuts = free.join(totals, F.col("lang") == F.col("t_lang")).withColumn("cut", F.expr(f"array_min(transform(sequence(1, depth - 1), k -> struct({score} as score, k as k)))"))
    rows = cuts.select("lang", "phrase", F.col("n").alias("a"), F.expr("lefts[cut.k - 1]").alias("l"), F.expr("rights[cut.k - 1]").alias("r"), F.col("total").alias("n"), "cut.score")
    best = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    for keys in (["lang", F.pmod(F.xxhash64("phrase"), F.lit(64))], ["lang"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best)).cast("long")).filter(F.col("rank") <= first)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
