"""Benchmark decontamination: BM25 retrieval of test items for every passage, by block-max WAND, and verification.

The test items are the indexed collection; every passage of every training document is a query. Items are taken by classes
of length, up to a power of two. For each class a passage is a window of twice that many words, and windows begin every
that many words, so that each item's copy lies whole in one of them. Scores are BM25, with the statistics of all items,
divided by the item's score with itself, so that one threshold serves all items, and all items above it are retrieved. Posting lists are cut into blocks that carry their greatest score. WAND skips items whose terms'
greatest scores can't reach the threshold, and blocks whose can't. Before that, windows are left out for which the
greatest scores within every range of items miss the threshold; this loses nothing, because no item can score more.

A retrieved item is verified in the document: ``OVERLAP`` of its question and of its answer must both be found, in runs of
``SHINGLE`` words or, since a changed word takes up to five runs from a short part, word by word: the item is located by
the offset at which most of its words stand, and the words of each part are aligned in order with those around its place.
The answer is the item's last sentence and eight words at least, but not more than half of
the item, or the second half of an item of one sentence.

Items are read in blocks of bounded size; for each block all documents are searched. Neither the number of items in a
block nor their order changes a score: frequencies and lengths are counted over all items first, and passages depend on
the item's class of length.

Defined cases: null and empty texts and items, and items without words, match nothing. Items shorter than a shingle count
as one. Repeated rows of documents or items each give their rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexapla.llm.common import releasing, without, written

K1, B = 1.2, 0.75
#: Part of an item's score with itself that a passage must reach.
THRESHOLD = 0.6
#: Words of the runs that are compared, and the part of the question's and of the answer's that must be there.
SHINGLE, OVERLAP = 5, 0.6
#: Postings in a block of the index.
BLOCK = 64
#: Ranges of items that have a greatest score each for every term, to rule out windows.
RANGES = 64
#: Bytes of item texts that are indexed, and sent to the executors, at a time.
ITEM_BYTES = 2 << 20
#: The length of the items of the first class, in words.
LEAST_STEP = 32

#: The answer has so many words at least, taken from the question's end if the last sentence is shorter.
LEAST_ANSWER = 8

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of digits, letters a-z after lower-casing A-Z, and whatever is not ASCII, of a text in UTF-8."""
    return (text or b"").translate(_FOLD).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The words before and in the last sentence; halves if there is one sentence."""
    words = words_of(text.encode())
    ends = [m.end() for m in re.finditer(r"[.?!]\s+(?=\S)", text)]
    last = len(words_of(text[ends[-1] :].encode())) if ends else len(words) // 2
    cut = len(words) - min(max(last, LEAST_ANSWER), len(words) // 2)
    return words[:cut], words[cut:]


def shingles(words: list, size: int = SHINGLE) -> set[tuple]:
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))} if words else set()


def common_words(part: list, region: list) -> int:
    """The length of the longest common subsequence, by bits."""
    masks: dict = {}
    for i, w in enumerate(part):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(part)) - 1
    v = full
    for w in region:
        u = v & masks.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(part) - v.bit_count()


class Places:
    """Where the words of a text stand, to locate items in it."""

    def __init__(self, words: list[bytes], terms: np.ndarray):
        self.words, self.order = words, np.argsort(terms, kind="stable")
        self.sorted = terms[self.order]

    def aligned(self, item: list[bytes], terms: list[int], cut: int) -> tuple[float, float]:
        """The parts of the question's and of the answer's words that stand in order at one place of the text, the place
        where the lesser part is greatest. ``cut`` words are the question; words may be shifted by ``slack``."""
        n, slack = len(item), max(3, len(item) // 8)
        low, high = np.searchsorted(self.sorted, terms), np.searchsorted(self.sorted, terms, side="right")
        starts = np.concatenate([self.order[a:b] - i for i, (a, b) in enumerate(zip(low, high, strict=True))]) + n
        votes = np.bincount(starts, minlength=1)
        near = np.convolve(votes, np.ones(2 * slack + 1, np.int64))[slack : slack + len(votes)]
        best = (0.0, 0.0)
        places = np.flatnonzero(near >= OVERLAP * n)
        for piece in np.split(places, np.flatnonzero(np.diff(places // (slack + 1))) + 1):
            if len(piece):
                at = int(piece[np.argmax(near[piece])]) - n
                question, answer = (self.words[max(at + i - slack, 0) : max(at + j + slack, 0)] for i, j in ((0, cut), (cut, n)))
                found = (common_words(item[:cut], question) / cut if cut else 1.0, common_words(item[cut:], answer) / (n - cut) if n > cut else 1.0)
                best = max(best, found, key=min)
        return best


class Statistics:
    """What BM25 needs of all items: their number, their mean length in words, and how many have each word."""

    def __init__(self, n: int, mean: float, having: dict[bytes, int]):
        self.n, self.mean, self.having = n, mean, having

    @staticmethod
    def of(said: list[list[bytes]]) -> Statistics:
        return Statistics(len(said), sum(map(len, said)) / max(len(said), 1), Counter(w for words in said for w in set(words)))

    def weights(self, words: list[bytes]) -> dict[bytes, float]:
        """The part of each word in the item's score with itself."""
        idf = {w: math.log(1 + (self.n - self.having[w] + 0.5) / (self.having[w] + 0.5)) for w in set(words)}
        size = K1 * (1 - B + B * len(words) / self.mean)
        weight = {w: idf[w] * f * (K1 + 1) / (f + size) for w, f in Counter(words).items()}
        total = sum(weight.values())
        return {w: x / total for w, x in weight.items()}


class Postings:
    """Posting lists with block maxima of the items of one class of length, by number of the term."""

    def __init__(self, step: int, items: list[int], weights: list[dict[int, float]], n_terms: int):
        self.step = step
        postings: list[list[tuple[int, float]]] = [[] for _ in range(n_terms)]
        for k, weight in zip(items, weights, strict=True):
            for t, x in weight.items():
                postings[t].append((k, x))
        self.ids = [[k for k, _ in p] for p in postings]
        self.scores = [[x for _, x in p] for p in postings]
        self.block_max = [[max(s[i : i + BLOCK]) for i in range(0, len(s), BLOCK)] for s in self.scores]
        self.greatest = np.array([max(s, default=0.0) for s in self.scores])
        place = {k: i for i, k in enumerate(items)}
        wide = max(-(-len(items) // RANGES), 1)
        self.ranges = np.zeros((n_terms, -(-len(items) // wide)), np.float32)
        for t, (ids, scores) in enumerate(zip(self.ids, self.scores, strict=True)):
            np.maximum.at(self.ranges[t], np.array([place[k] for k in ids], np.int64) // wide, scores)
        self.used = self.greatest > 0

    def retrieve(self, terms: list[int], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """All items that score ``threshold`` or more for a query of distinct terms, by block-max WAND."""
        found: list[tuple[int, float]] = []
        lists = [[self.ids[t][0], 0, t] for t in terms]  # current item, place, term
        reach = threshold - 1e-9
        while lists:
            lists.sort(key=lambda x: x[0])
            bound, pivot = 0.0, -1
            for k, (_, _, t) in enumerate(lists):
                bound += self.greatest[t]
                if bound >= reach:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == item:
                pivot += 1
            # the blocks in which the pivot item would be
            at = [bisect_left(self.ids[t], item, p) for _, p, t in lists[: pivot + 1]]
            near = sum(self.block_max[t][i // BLOCK] for i, (_, _, t) in zip(at, lists, strict=False) if i < len(self.ids[t]))
            if near < reach:  # no item before the next block's end can reach the threshold
                ends = [self.ids[t][min((i // BLOCK + 1) * BLOCK, len(self.ids[t])) - 1] + 1 for i, (_, _, t) in zip(at, lists, strict=False) if i < len(self.ids[t])]
                if pivot + 1 < len(lists):
                    ends.append(lists[pivot + 1][0])
                target = max(item + 1, min(ends, default=item + 1))
                self._advance(lists, pivot + 1, target)
            elif lists[0][0] == item:
                score = sum(self.scores[t][p] for _, p, t in lists[: pivot + 1])
                if score >= reach:
                    found.append((item, score))
                self._advance(lists, pivot + 1, item + 1)
            else:
                self._advance(lists, pivot, item)
        return found

    def _advance(self, lists: list[list[int]], many: int, target: int) -> None:
        """Move the first ``many`` lists to their first item from ``target`` on; lists that end go."""
        for x in lists[:many]:
            if x[0] < target:
                x[1] = bisect_left(self.ids[x[2]], target, x[1])
                x[0] = self.ids[x[2]][x[1]] if x[1] < len(self.ids[x[2]]) else -1
        lists[:] = [x for x in lists if x[0] >= 0]

    def windows(self, terms: np.ndarray, threshold: float) -> Iterator[list[int]]:
        """The distinct terms of each window in which some range of items may reach the threshold.

        A window is two steps long. For each step the greatest scores of its distinct terms are added up by range of
        items; a window's sum is at most those of its two steps.
        """
        known = np.flatnonzero((terms >= 0) & self.used[terms])
        if not len(known):
            return
        pairs = np.unique(known // self.step * len(self.ids) + terms[known])
        steps, of_step = pairs // len(self.ids), pairs % len(self.ids)
        firsts = np.flatnonzero(np.diff(steps, prepend=-1))
        sums = np.zeros((int(steps[-1]) + 2, self.ranges.shape[1]), np.float32)
        sums[steps[firsts]] = np.add.reduceat(self.ranges[of_step], firsts, axis=0)
        last = max(len(terms) - 1, 0) // self.step
        for k in np.flatnonzero((sums[:-1] + sums[1:]).max(axis=1) >= threshold - 1e-4):
            if k and k == last:
                continue  # the window before has these words too
            low, high = np.searchsorted(steps, (k, k + 2))
            query = np.unique(of_step[low:high])
            if self.ranges[query].sum(axis=0).max() >= threshold - 1e-4:
                yield query.tolist()

class ItemIndex:
    """Items, their terms, and their posting lists by class of length. ``statistics`` are those of all items, of which
    ``items`` may be some."""

    def __init__(self, items: list[tuple[int, str]], statistics: Statistics | None = None):
        self.items = [(i, t, w) for i, t in items if (w := words_of((t or "").encode()))]
        said = [w for _, _, w in self.items]
        weights = list(map((statistics or Statistics.of(said)).weights, said))
        self.terms = {w: k for k, w in enumerate(dict.fromkeys(w for x in weights for w in x))}
        classes: dict[int, list[int]] = {}
        for k, words in enumerate(said):
            classes.setdefault(LEAST_STEP << max((len(words) - 1) // LEAST_STEP, 0).bit_length(), []).append(k)
        numbered = [{self.terms[w]: x for w, x in weight.items()} for weight in weights]
        self.classes = [Postings(step, ks, [numbered[k] for k in ks], len(self.terms)) for step, ks in sorted(classes.items())]
        parts = [question_and_answer(t) for _, t, _ in self.items]
        self.parts = [(shingles(q), shingles(a)) for q, a in parts]
        self.cuts = [len(q) for q, _ in parts]

    def search(self, text: bytes | None, threshold: float = THRESHOLD) -> list[tuple[int, float, float, float, int]]:
        """(item_id, best score, question's overlap, answer's overlap, passages) of each verified item of a text."""
        words = words_of(text)
        terms = np.fromiter(map(self.terms.get, words, _minus_one), np.int64, len(words))
        best: dict[int, tuple[float, int]] = {}
        for postings in self.classes:
            for query in postings.windows(terms, threshold):
                for item, score in postings.retrieve(query, threshold):
                    seen = best.get(item, (0.0, 0))
                    best[item] = (max(seen[0], score), seen[1] + 1)
        if not best:
            return []
        wanted = set().union(*[self.parts[i][0] | self.parts[i][1] for i in best])
        sizes = {len(s) for s in wanted}
        here = {s for n in sizes for i in range(len(words) - n + 1) if (s := tuple(words[i : i + n])) in wanted}
        out, places = [], Places(words, terms)
        for item, (score, passages) in sorted(best.items()):
            question, answer = (len(p & here) / len(p) if p else 1.0 for p in self.parts[item])
            if question < OVERLAP or answer < OVERLAP:
                said = self.items[item][2]
                question, answer = map(max, (question, answer), places.aligned(said, [self.terms[w] for w in said], self.cuts[item]))
            if question >= OVERLAP and answer >= OVERLAP:
                out.append((self.items[item][0], float(score), question, answer, passages))
        return out


class _MinusOne:
    """An endless supply of -1, the second argument of ``dict.get`` under ``map``."""

    def __iter__(self) -> Iterator[int]:
        return self

    def __next__(self) -> int:
        return -1


_minus_one = _MinusOne()

SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, passages long"


def _said(items: DataFrame) -> DataFrame:
    """(row, item_id, text, n, words) of the items with words: how many words, and the distinct ones."""

    def split(batches):
        for b in batches:
            said = [(i, t, len(w), sorted(set(w))) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if (w := words_of(t.encode()))]
            if said:
                types = [pa.int64(), pa.string(), pa.int64(), pa.list_(pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*said, strict=True), types, strict=True)], ["item_id", "text", "n", "words"])

    rows = items.filter("text is not null").select(F.col("item_id").cast("long"), "text")
    found = rows.mapInArrow(releasing(split), "item_id long, text string, n long, words array<binary>")
    return written(found.withColumn("row", F.monotonically_increasing_id()), "items")


def _item_blocks(items: DataFrame, most: int = ITEM_BYTES) -> Iterator[tuple[list[tuple[int, str]], Statistics]]:
    """Blocks of items, with the statistics of all items for the words of the block. The words are counted by Spark, and
    only one block is on the driver at a time."""
    said = _said(items)
    n, mean = said.agg(F.count("*"), F.avg("n")).first()
    having = said.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("having"))
    counted = said.select("row", F.explode("words").alias("word")).join(having, "word").groupBy("row").agg(F.collect_list(F.struct("word", "having")).alias("counts"))
    rows = written(said.drop("words").join(counted, "row"), "items-counted")
    block: list[tuple[int, str]] = []
    words: dict[bytes, int] = {}
    room = most
    for r in rows.orderBy("n", "item_id", "text").toLocalIterator():
        length = len(r["text"].encode())
        if block and length > room:
            yield block, Statistics(n, mean, words)
            block, words, room = [], {}, most
        block.append((r["item_id"], r["text"]))
        words.update((bytes(c["word"]), c["having"]) for c in r["counts"])
        room -= length
    if block:
        yield block, Statistics(n, mean, words)


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap, passages) of each document and test item found in it."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]

    def part(block, statistics):
        index = spark.sparkContext.broadcast(ItemIndex(block, statistics))

        def scan(batches):
            for batch in batches:
                out = [(i, *f) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True) for f in index.value.search(t, threshold)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

        return docs.mapInArrow(releasing(scan), SCHEMA)

    found = None
    for block, statistics in _item_blocks(items, item_bytes):
        one = part(block, statistics)
        found = one if found is None else found.unionByName(one)
    return spark.createDataFrame([], SCHEMA) if found is None else found


def decontaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` in whose text no test item was found, with all columns. Rows without a doc_id are compared as
    one id."""
    return without(docs, written(contaminated(docs, items, threshold).select("doc_id"), "contaminated"))
