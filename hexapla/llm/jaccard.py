"""N-gram Jaccard join by T-occurrence search (DivideSkip), and the classes of linked documents.

Two documents link when their sets of 5-word shingles have a Jaccard similarity of 0.75 or more. A set that overlaps
another so much shares three quarters of its shingles with it. This is used four times over; none of the steps loses a
link:

1. Shingles that no other document has are counted for each document; documents with less than three quarters of shared
   ones cannot link. To count, blocks of documents send the shingles' hashes, packed, to buckets of hashes, and get a bit
   for each back; only buckets that a block has hashes for get a row, so that rows and bytes grow with the shingles. (32 bits of the hash within a bucket are compared; equal bits of different shingles keep a document too many.)
2. Documents with equal sets form a class; its least doc_id stands for it from here on.
3. Of each representative's shingles, rarest first, a prefix of one quarter and one is kept; linked sets share a shingle
   of their prefixes. Sets that share prefix shingles form groups, the components of that relation.
4. Within a group the sets are searched one by one in an inverted index of those before, by DivideSkip: the longest lists
   are set apart, as many as the required overlap and the longest one's length say; the short ones are merged (by a heap;
   by counting where they hold many documents), documents that occur often enough there are probed for in the long lists
   by bisection, and those that reach the required overlap are compared. This finds every link.

The links themselves can be as many as the pairs of documents, so they are counted where they are found: each document
gets the number of its links, copies counted by the sizes of their classes, and of the links only those that join
components leave the task. Groups too large for one task are searched by pairs of blocks; a set is in the task of its
block and another one if it shares a shingle of its prefix with a set of that block, so each pair is compared once.

Where components are all that is asked for (deduplication), lists whose documents all are in the component of the set at
hand are passed over, since only links to other components change the result. Large groups are then thinned out: each
set is compared with the least set of its lists, the linked ones become components, and only shingles whose documents are
in different components are kept. What is left is searched by pairs of blocks.

Defined cases: a text that is null, empty or without words has an empty set and is linked with nothing. Repeated rows are
linked as copies, and each counts as a link of the others. Rows without doc_id are left out of the join, form no component
and have no number of links (null). Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexapla.llm.common import releasing, without, written
from hexapla.llm.graph import components
from hexapla.llm.shingles import shingle_sets

#: Similarity in percent.
PERCENT = 75
#: Bytes of text, and texts (numbered in 16 bits), whose shingles are made at a time, and shingles of a block of sets.
CHUNK_BYTES, CHUNK_ROWS, BLOCK_SHINGLES = 2 << 20, 1 << 15, 250_000
#: Shingles that a bucket of hashes is to have.
BUCKET = 1_000_000
#: A group of more sets, or more shingles, is thinned out and searched by pairs of blocks of so many.
GROUP_SETS, GROUP_SHINGLES = 3_000, 2_000_000
#: So many documents are merged by a heap at most; what a list's length, as its binary logarithm, counts against probing.
HEAP, PROBE = 256, 1.0


def need(n: int | np.ndarray, percent: int = PERCENT):
    """The least overlap of a set of ``n`` with any set it links to."""
    return -(-percent * n // 100)


def _mark(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """doc_ids and sets, a bounded number of bytes at a time."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            for i, t in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                ids.append(i)
                texts.append(t or b"")
                size += len(texts[-1])
                if size > CHUNK_BYTES or len(ids) == CHUNK_ROWS:
                    yield ids, shingle_sets(texts)
                    ids, texts, size = [], [], 0
    if ids:
        yield ids, shingle_sets(texts)


class _Sender:
    """Deals the shingles of a block out to buckets."""

    def __init__(self, buckets: int):
        self.buckets, self.seq, self.task = buckets, 0, TaskContext.get().partitionId() if TaskContext.get() else 0

    def number(self) -> int:
        self.seq += 1
        return (self.task << 32) | self.seq

    @staticmethod
    def head(block: int) -> int:
        """The bucket, below 0, of a block's head: heads are spread over tasks, and sort before their block's rows."""
        return -1 - (block ^ (block >> 32) * 7919) % 4096

    def deal(self, tokens: np.ndarray) -> tuple[np.ndarray, dict[int, tuple[int, int]]]:
        """The order of the tokens by bucket, and where each bucket that has tokens begins and ends in it."""
        bucket = ((tokens >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.uint16 if self.buckets <= 1 << 16 else np.int64)
        order = np.argsort(bucket, kind="stable")
        dealt = bucket[order]
        first = np.flatnonzero(np.concatenate([np.ones(min(len(dealt), 1), bool), dealt[1:] != dealt[:-1]]))
        return order, dict(zip(dealt[first].tolist(), zip(first.tolist(), [*first[1:].tolist(), len(dealt)], strict=True), strict=False))


_BUCKETED = "block long, bucket int, head binary, body binary"


def _bucket_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), pa.int32(), pa.binary(), pa.binary()], strict=True)], ["block", "bucket", "head", "body"])


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of each bucket, of batches sorted by bucket."""
    now, rows = None, []
    for b in batches:
        for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if rows and row[1] != now:
                yield now, rows
                rows = []
            now = row[1]
            rows.append(row)
    if rows:
        yield now, rows


def _frequency(rows: list[tuple]) -> list[np.ndarray]:
    """For each row's hashes how many rows' documents have them."""
    parts = [np.frombuffer(r[3], "<u4") for r in rows]
    _, inverse, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    return np.split(counts[inverse], np.cumsum([len(p) for p in parts])[:-1])


def shared_counts(docs: DataFrame, buckets: int, parts: int) -> DataFrame:
    """(doc_id, n, mark, class, shared): each row's number of shingles, a digest of the set and the first half of it as a
    number, and how many shingles other rows have too."""

    def send(batches):
        s = _Sender(buckets)
        for ids, sets in _chunks(batches):
            block, tokens = s.number(), np.concatenate(sets)
            lengths = np.fromiter(map(len, sets), np.int64, len(sets))
            order, cuts = s.deal(tokens)
            low = (tokens[order] & np.uint64(0xFFFFFFFF)).astype("<u4")
            # whose the shingles are stays with the block's head, in the order in which the buckets' answers come back
            owner = np.repeat(np.arange(len(sets)), lengths)[order].astype("<u2")
            rows = [(block, s.head(block), np.array(ids, "<i8").tobytes() + lengths.astype("<i8").tobytes(), b"".join(map(_mark, sets)) + owner.tobytes())]
            rows += [(block, b, b"", low[i:j].tobytes()) for b, (i, j) in cuts.items()]
            yield _bucket_rows(rows)

    def count(batches):
        for bucket, rows in _by_bucket(batches):
            if bucket < 0:
                for at in range(0, len(rows), 64):
                    yield _bucket_rows(rows[at : at + 64])
                continue
            yield _bucket_rows([(r[0], bucket, len(df).to_bytes(4, "little"), np.packbits(df > 1).tobytes()) for r, df in zip(rows, _frequency(rows), strict=True)])

    def gather(batches):
        for rows in _blocks(batches):
            head = rows[0]
            if head[1] >= 0:
                raise ValueError("a block has lost its head")
            k = len(head[2]) // 16
            ids, lengths = np.frombuffer(head[2], "<i8").reshape(2, k)
            bits = [np.unpackbits(np.frombuffer(r[3], np.uint8), count=int.from_bytes(r[2], "little")) for r in rows[1:]]
            owner = np.frombuffer(head[3], "<u2", offset=16 * k)
            shared = np.bincount(owner, np.concatenate(bits) if bits else None, k).astype(np.int64)
            marks = [head[3][16 * i : 16 * i + 16] for i in range(k)]
            numbers = np.frombuffer(head[3], "<i8", 2 * k)[::2]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, lengths, marks, numbers, shared)], ["doc_id", "n", "mark", "class", "shared"])

    sent = docs.mapInArrow(releasing(send), _BUCKETED).repartition(parts, "bucket").sortWithinPartitions("bucket")
    back = sent.mapInArrow(releasing(count), _BUCKETED).repartition("block").sortWithinPartitions("block", "bucket")
    return back.mapInArrow(releasing(gather), "doc_id long, n long, mark binary, class long, shared long")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each block, of batches sorted by block and bucket."""
    now, rows = None, []
    for b in batches:
        for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if rows and row[0] != now:
                yield rows
                rows = []
            now = row[0]
            rows.append(row)
    if rows:
        yield rows


def set_blocks(docs: DataFrame, by_class: bool = False) -> DataFrame:
    """(block, head, body): blocks of documents with their sets; ``head`` has ids and sizes, ``body`` the hashes. The ids
    are doc_ids, or the numbers of the classes."""

    def make(batches):
        s, ids, sets = _Sender(1), [], []

        def row():
            head = np.concatenate([np.array(ids, "<i8"), np.fromiter(map(len, sets), np.int64, len(sets)).astype("<i8")]).tobytes()
            return _bucket_rows([(s.number(), -1, head, np.concatenate(sets).astype("<u8").tobytes())])

        size = 0
        for some, found in _chunks(batches):
            for i, x in zip(some, found, strict=True):
                ids.append(int.from_bytes(_mark(x)[:8], "little", signed=True) if by_class else i)
                sets.append(x)
                size += len(x)
                if size > BLOCK_SHINGLES:
                    yield row()
                    ids, sets, size = [], [], 0
        if ids:
            yield row()

    return docs.mapInArrow(releasing(make), _BUCKETED)


def _open(head: bytes, body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, lengths = np.frombuffer(head, "<i8").reshape(2, -1)
    return ids, lengths, np.frombuffer(body, "<u8")


def sets_of(blocks: DataFrame) -> DataFrame:
    """(rep, n, tokens) of each document in blocks."""

    def unpack(batches):
        for b in batches:
            for head, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids, lengths, tokens = _open(head, body)
                parts = np.split(tokens, np.cumsum(lengths)[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(lengths), pa.array([p.tobytes() for p in parts])], ["rep", "n", "tokens"])

    return blocks.select("head", "body").mapInArrow(releasing(unpack), "rep long, n long, tokens binary")


def prefixes(blocks: DataFrame, buckets: int, parts: int, percent: int = PERCENT) -> DataFrame:
    """(token, rep): of each set the shingles of its prefix that another set has, rarest first."""

    def send(batches):
        s = _Sender(buckets)
        for b in batches:
            for block, _, _, body in zip(*[c.to_pylist() for c in b.columns], strict=True):
                tokens = np.frombuffer(body, "<u8")
                order, cuts = s.deal(tokens)
                low = (tokens[order] & np.uint64(0xFFFFFFFF)).astype("<u4")
                rows = [(block, k, b"", low[i:j].tobytes()) for k, (i, j) in cuts.items()]
                if rows:
                    yield _bucket_rows(rows)

    def count(batches):
        for bucket, rows in _by_bucket(batches):
            yield _bucket_rows([(r[0], bucket, b"", df.astype("<u4").tobytes()) for r, df in zip(rows, _frequency(rows), strict=True)])

    def gather(batches):
        s = _Sender(buckets)
        for rows in _blocks(batches):
            ids, lengths, tokens = _open(rows[0][2], rows[0][3])
            order, _ = s.deal(tokens)
            df = np.zeros(len(tokens), np.int64)
            df[order] = np.concatenate([np.frombuffer(r[3], "<u4") for r in rows[1:]]) if len(rows) > 1 else 0
            out_t, out_r, at = [], [], 0
            for rep, n in zip(ids.tolist(), lengths.tolist(), strict=True):
                t, d = tokens[at : at + n], df[at : at + n]
                at += n
                if np.count_nonzero(d > 1) >= need(n, percent):
                    first = np.lexsort((t, d))[: n - need(n, percent) + 1]
                    first = first[d[first] > 1]
                    out_t.append(t[first].astype(np.int64))
                    out_r.append(np.full(len(first), rep, np.int64))
            if out_t:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_t)), pa.array(np.concatenate(out_r))], ["token", "rep"])

    sent = blocks.mapInArrow(releasing(send), _BUCKETED).repartition(parts, "bucket").sortWithinPartitions("bucket")
    back = sent.mapInArrow(releasing(count), _BUCKETED).unionByName(blocks).repartition("block").sortWithinPartitions("block", "bucket")
    return back.mapInArrow(releasing(gather), "token long, rep long")


def occurrences(lists: list[array], least: int, work: Counter) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that are in ``least`` of the lists or more, and in how many, by DivideSkip. ``work`` counts the merges by
    heap, those by counting, and the lists probed.

    With L lists set apart, a number must be in ``least`` - L of the others. The more are set apart, the fewer candidates
    there are to merge and the more to probe; L is ``least`` over one and the weighted logarithm of the longest list.
    """
    lists.sort(key=len)
    apart = min(int(least / (PROBE * math.log2(len(lists[-1]) + 1) + 1)), least - 1)
    short, long = lists[: len(lists) - apart], lists[len(lists) - apart :]
    if sum(map(len, short)) > HEAP:
        counts = np.bincount(np.concatenate([np.frombuffer(x, np.int32) for x in short]))
        found = np.flatnonzero(counts >= least - apart)
        overlap = counts[found]
        work["counted"] += 1
    else:
        merged = [(y, n) for y, run in groupby(heapq.merge(*short)) if (n := sum(1 for _ in run)) >= least - apart]
        found, overlap = np.array(merged, np.int64).reshape(-1, 2).T
        work["heaped"] += 1
    for left in range(apart - 1, -1, -1):
        if not len(found):
            break
        ids = np.frombuffer(long[left], np.int32)
        overlap = overlap + (ids[np.minimum(np.searchsorted(ids, found), len(ids) - 1)] == found)
        able = overlap + left >= least
        found, overlap = found[able], overlap[able]
        work["probed"] += 1
    return found, overlap


class Search:
    """T-occurrence search of sets among those before, for links that join components."""

    def __init__(self, percent: int = PERCENT):
        self.percent, self.work = percent, Counter()
        self.sizes: list[int] = []
        self.lists: dict[int, array] = {}
        self.only: dict[int, int] = {}  # of a list whose documents are in one component, one of them
        self.above: list[int] = []

    def root(self, x: int) -> int:
        while self.above[x] != x:
            self.above[x] = x = self.above[self.above[x]]
        return x

    def add(self, tokens: np.ndarray, label: int | None = None, search: bool = True) -> list[int]:
        """Search for a set, add it, and give those before it that joined it to a new component. ``label``: an earlier
        set whose component it is in already."""
        k = len(self.sizes)
        self.sizes.append(len(tokens))
        self.above.append(k if label is None else self.root(label))
        keys, joined = tokens.tolist(), []
        if search:
            joined = self._search(k, [t for t in keys if t in self.lists])
        for t in keys:
            if t in self.lists:
                self.lists[t].append(k)
                if t in self.only and self.root(self.only[t]) != self.root(k):
                    del self.only[t]
            else:
                self.lists[t], self.only[t] = array("i", (k,)), k
        return joined

    def _search(self, k: int, keys: list[int]) -> list[int]:
        least, mine, joined = need(self.sizes[k], self.percent), self.root(k), []
        if len(keys) < least:
            return joined
        lists = [self.lists[t] for t in keys if t not in self.only or self.root(self.only[t]) != mine]
        if len(lists) < least:
            return joined
        for y, overlap in zip(*(x.tolist() for x in occurrences(lists, least, self.work)), strict=True):
            if self.root(y) != self.root(k) and 100 * overlap >= self.percent * (self.sizes[k] + self.sizes[y] - overlap):
                self.above[self.root(k)] = self.root(y)
                joined.append(y)
        return joined


class AllLinks:
    """T-occurrence search of sets among those before, for the number of links of each."""

    def __init__(self, percent: int = PERCENT):
        self.percent, self.work = percent, Counter()
        self.reps: list[int] = []
        self.lists: dict[int, array] = {}
        self.joins: list[tuple[int, int]] = []  # links that join components
        self.sizes, self.copies, self.links, self.label = np.zeros((4, 64), np.int64)

    def add(self, rep: int, copies: int, tokens: np.ndarray, search: bool = True, keep: bool = True) -> None:
        """Search for a set that stands for ``copies`` documents, and ``keep`` it in the index. A set that comes twice,
        one right after the other, counts once."""
        k = len(self.reps)
        if k and self.reps[-1] == rep:
            return
        if k == len(self.sizes):
            self.sizes, self.copies, self.links, self.label = (np.concatenate([x, np.zeros(k, np.int64)]) for x in (self.sizes, self.copies, self.links, self.label))
        self.reps.append(rep)
        self.sizes[k], self.copies[k], self.label[k] = len(tokens), copies, k
        keys = tokens.tolist()
        found = self._search(k, [x for t in keys if (x := self.lists.get(t)) is not None]) if search else ()
        if len(found):
            self.links[k] += self.copies[found].sum()
            self.links[found] += copies
            labels, firsts = np.unique(self.label[found], return_index=True)
            self.joins += [(rep, self.reps[found[i]]) for i in firsts]
            self.label[k] = labels[0]
            if len(labels) > 1:
                self.label[:k][np.isin(self.label[:k], labels)] = labels[0]
        if keep:
            for t in keys:
                if t in self.lists:
                    self.lists[t].append(k)
                else:
                    self.lists[t] = array("i", (k,))

    def _search(self, k: int, lists: list[array]) -> np.ndarray:
        """The sets before ``k`` that it links to, of which ``lists`` are those of its shingles."""
        least = need(int(self.sizes[k]), self.percent)
        if len(lists) < least:
            return np.zeros(0, np.int64)
        found, overlap = occurrences(lists, least, self.work)
        return found[100 * overlap >= self.percent * (self.sizes[k] + self.sizes[found] - overlap)]

    def counted(self) -> list[tuple[int, int | None, int]]:
        """(set, null, number of links) of the sets with links, and (set, other set, 0) of the links that join components."""
        some = np.flatnonzero(self.links[: len(self.reps)])
        return [(self.reps[i], None, n) for i, n in zip(some.tolist(), self.links[some].tolist(), strict=True)] + [(a, b, 0) for a, b in self.joins]


def linked(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sets link."""
    same = len(x) + len(y) - len(np.union1d(x, y))
    return 100 * same >= percent * (len(x) + len(y) - same)


_TASK = "task long, side int, rep long, label long, tokens binary"


def search_groups(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): links between representatives of a task that join its components. ``members`` are (task, side, rep, label,
    tokens); in a task with two sides only links between the sides are searched, and equal labels are joined already."""

    def run(batches):
        now, s, reps, labels, out, sides = None, None, [], {}, [], set()
        for b in batches:
            for task, side, rep, label, tokens in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if task != now:
                    now, s, reps, labels, sides = task, Search(percent), [], {}, set()
                sides.add(side)
                joined = s.add(np.frombuffer(tokens, "<u8"), labels.get(label), side == max(sides) and (side > 0 or len(sides) == 1))
                labels.setdefault(label, len(reps))
                reps.append(rep)
                out += [(rep, reps[y]) for y in joined]
            if len(out) > 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])

    dealt = members.repartition("task").sortWithinPartitions("task", "side", F.octet_length("tokens"), "rep")
    return dealt.select("task", "side", "rep", "label", "tokens").mapInArrow(releasing(run), "a long, b long")


def _stars(prefix: DataFrame) -> DataFrame:
    """(a, b): each set and the least set of each of its lists."""
    least = written(prefix.groupBy("token").agg(F.min("rep").alias("b"), F.count("*").alias("c")).filter("c > 1").select(F.col("token").alias("k"), "b"), "jaccard-least")
    return prefix.join(least, F.col("token") == F.col("k")).filter("rep <> b").select(F.col("rep").alias("a"), "b").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    one = sets.select(F.col("rep").alias("a"), F.col("tokens").alias("x"))
    two = sets.select(F.col("rep").alias("b"), F.col("tokens").alias("y"))

    def compare(batches):
        for b in batches:
            keep = [linked(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), percent) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(releasing(compare), "a long, b long")


def links(prefix: DataFrame, sets: DataFrame, percent: int = PERCENT, group_sets: int = GROUP_SETS, group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """(a, b): links between representatives with the components of all links. ``prefix`` (token, rep) and ``sets`` (rep, n,
    tokens) are written tables."""
    sizes = sets.select("rep", "n")
    stars = written(_stars(prefix), "jaccard-stars")
    groups = written(components(stars), "jaccard-groups")  # node, component
    weight = groups.join(sizes, F.col("node") == F.col("rep")).groupBy("component").agg(F.count("*").alias("m"), F.sum("n").alias("t"))
    large = written(weight.filter((F.col("m") > group_sets) | (F.col("t") > group_shingles)).select(F.col("component").alias("l")), "jaccard-large")
    small = groups.join(large, F.col("component") == F.col("l"), "left_anti")
    members = small.join(sets, F.col("node") == F.col("rep")).select(F.col("component").alias("task"), F.lit(0).alias("side"), "rep", F.col("rep").alias("label"), "tokens")
    found = search_groups(members, percent)
    if large.isEmpty():
        return found
    inside = groups.join(large, F.col("component") == F.col("l"), "left_semi")
    pairs = stars.join(inside.select(F.col("node").alias("i")), F.col("a") == F.col("i"), "left_semi")
    near = written(_verified(pairs, sets, percent), "jaccard-near")
    joined = components(near).select(F.col("node").alias("j"), F.col("component").alias("joined"))
    labels = written(inside.select("node").join(joined, F.col("node") == F.col("j"), "left").select("node", F.coalesce("joined", "node").alias("label")), "jaccard-labels")
    marked = prefix.join(labels, F.col("rep") == F.col("node")).select("token", "rep", "label")
    mixed = marked.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
    left = written(marked.join(mixed.select(F.col("token").alias("k"), "lo"), F.col("token") == F.col("k")).select("rep", "label", "lo"), "jaccard-left")
    again = written(components(left.filter("label <> lo").select(F.col("label").alias("a"), F.col("lo").alias("b")).distinct()), "jaccard-again")
    residue = left.select("rep", "label").distinct().join(again, F.col("label") == F.col("node")).select("rep", "label", F.col("component").alias("g"))
    residue = written(residue, "jaccard-residue")
    weights = residue.join(sizes.withColumnRenamed("rep", "r"), F.col("rep") == F.col("r")).groupBy("g").agg(F.count("*").alias("m"), F.sum("n").alias("t"))
    blocks = weights.select(F.col("g").alias("h"), F.greatest(F.ceil(F.col("m") / group_sets), F.ceil(F.col("t") / group_shingles)).cast("int").alias("k"))
    placed = residue.join(blocks, F.col("g") == F.col("h")).withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("k")).cast("int"))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    task = F.xxhash64("g", F.least("mine", "other"), F.greatest("mine", "other"))
    tasks = other.select(task.alias("task"), F.when(F.col("mine") > F.col("other"), 1).otherwise(0).alias("side"), F.col("rep").alias("r"), "label")
    more = search_groups(tasks.join(sets, F.col("r") == F.col("rep")).select("task", "side", "rep", "label", "tokens"), percent)
    return found.unionByName(near).unionByName(more)


def count_groups(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b, n): the number of links that each set of a task has in it (b is null), and the links that join components (n
    is 0). ``members`` are (task, side, rep, copies, tokens); sets of side 2 are searched among themselves, and those of
    side 1 among those of side 0."""

    def run(batches):
        now, s = None, AllLinks(percent)
        for b in batches:
            out = []
            for task, side, rep, copies, tokens in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if task != now:
                    out += s.counted()
                    now, s = task, AllLinks(percent)
                s.add(rep, copies, np.frombuffer(tokens, "<u8"), side > 0, side != 1)
            if out:
                yield _link_rows(out)
        if out := s.counted():
            yield _link_rows(out)

    dealt = members.repartition("task").sortWithinPartitions("task", "side", "rep")
    return dealt.select("task", "side", "rep", "copies", "tokens").mapInArrow(releasing(run), "a long, b long, n long")


def _link_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["a", "b", "n"])


def all_links(prefix: DataFrame, sets: DataFrame, copies: DataFrame, percent: int = PERCENT, group_sets: int = GROUP_SETS, group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """(a, b, n) as of ``count_groups``, over all sets; a set's numbers add up. ``prefix`` (token, rep), ``sets`` (rep, n,
    tokens) and ``copies`` (c, copies, size), the rows of each class and the size of its set, are written tables."""
    stars = written(_stars(prefix), "jaccard-stars")
    groups = written(components(stars).join(copies, F.col("node") == F.col("c")).select("node", "component", "copies", "size"), "jaccard-groups")
    weight = groups.groupBy("component").agg(F.count("*").alias("m"), F.sum("size").alias("t")).filter((F.col("m") > group_sets) | (F.col("t") > group_shingles))
    blocks = F.greatest(F.ceil(F.col("m") / group_sets), F.ceil(F.col("t") / group_shingles)).cast("int")
    large = written(weight.select(F.col("component").alias("l"), blocks.alias("k")), "jaccard-large")
    small = groups.join(large, F.col("component") == F.col("l"), "left_anti")
    tasks = small.select(F.col("component").alias("task"), F.lit(2).alias("side"), F.col("node").alias("r"), "copies")
    if not large.isEmpty():
        placed = groups.join(large, F.col("component") == F.col("l")).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
        marked = written(prefix.join(placed, F.col("rep") == F.col("node")).select("token", "rep", "copies", "l", "mine").distinct(), "jaccard-marked")
        there = marked.groupBy("token").agg(F.collect_set("mine").alias("blocks")).withColumnRenamed("token", "t")
        near = marked.join(there, F.col("token") == F.col("t")).groupBy("rep", "copies", "l", "mine").agg(F.array_distinct(F.flatten(F.collect_set("blocks"))).alias("blocks"))
        other = near.withColumn("other", F.explode("blocks"))
        task = F.xxhash64("l", F.least("mine", "other"), F.greatest("mine", "other"))
        side = F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") > F.col("other"), 1).otherwise(0)
        tasks = tasks.unionByName(other.select(task.alias("task"), side.alias("side"), F.col("rep").alias("r"), "copies"))
    return count_groups(tasks.join(sets, F.col("r") == F.col("rep")).select("task", "side", "rep", "copies", "tokens"), percent)


def linked_documents(docs: DataFrame, percent: int = PERCENT, group_sets: int = GROUP_SETS, group_shingles: int = GROUP_SHINGLES, count: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs`` (doc_id, text); with ``count`` also n_links, with how many
    other rows it links."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, size // 6 // BUCKET)
    parts = max(1, min(buckets, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    counted = written(shared_counts(docs.filter("doc_id is not null"), buckets, parts), "jaccard-counts")
    near = counted.filter((F.col("n") > 0) & (100 * F.col("shared") >= percent * F.col("n")))
    # written, so that both sides of the join are plain exchanges, of which Spark splits large partitions
    reps = written(near.groupBy("mark", "class").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.count("*").alias("copies")), "jaccard-reps")
    classes = written(near.join(reps.select(F.col("mark").alias("m"), "rep"), F.col("mark") == F.col("m")).select("doc_id", "class", "rep").distinct(), "jaccard-classes")
    few = max(1, (reps.agg(F.sum("n")).first()[0] or 0) // BUCKET)
    texts = docs.join(reps.select(F.col("rep").alias("r")), F.col("doc_id") == F.col("r"), "left_semi")
    blocks = written(set_blocks(texts, count), "jaccard-sets")
    sets = sets_of(blocks)
    prefix = written(prefixes(blocks, few, max(1, min(few, parts)), percent), "jaccard-prefixes")
    if count:
        copies = reps.select(F.col("class").alias("c"), "copies", F.col("n").alias("size"))
        every = written(all_links(prefix, sets, copies, percent, group_sets, group_shingles), "jaccard-links")
        number = lambda side: reps.select(F.col("class").alias(f"c{side}"), F.col("rep").alias(f"r{side}"))
        pairs = every.filter("b is not null").join(number("a"), F.col("a") == F.col("ca")).join(number("b"), F.col("b") == F.col("cb")).select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    else:
        pairs = links(prefix, sets, percent, group_sets, group_shingles)
    joined = written(components(written(pairs, "jaccard-pairs")), "jaccard-components")
    found = classes.join(joined.select("node", "component"), F.col("rep") == F.col("node"), "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component"))
    out = counted.select("doc_id", "class", F.col("n").alias("n_shingles")).join(found.withColumnRenamed("doc_id", "f"), F.col("doc_id") == F.col("f"), "left")
    out = out.select("doc_id", "class", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    if count:
        found = every.filter("b is null").groupBy("a").agg(F.sum("n").alias("more"))
        numbers = written(copies.join(found, F.col("c") == F.col("a"), "left").select("c", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n_links")), "jaccard-numbers")
        mine = classes.join(numbers, F.col("class") == F.col("c")).select(F.col("doc_id").alias("d"), "c", "n_links")
        out = out.join(mine, (F.col("doc_id") == F.col("d")) & (F.col("class") == F.col("c")), "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    out = out.drop("class", "d", "c")
    lost = docs.filter("doc_id is null")
    none = lost.mapInArrow(releasing(_sizes), "doc_id long, n_shingles long").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"), *([F.lit(None).cast("long").alias("n_links")] if count else []))
    return out.unionByName(none)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, sets in _chunks(batches):
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(x) for x in sets], pa.int64())], ["doc_id", "n_shingles"])


def deduplicated(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each component, that of its least doc_id, with all columns; rows without doc_id stay.

    Of repeated rows of that id all stay: they are one document."""
    joined = linked_documents(docs, percent)
    return without(docs, written(joined.filter("doc_id <> component_id").select("doc_id"), "jaccard-gone"))
