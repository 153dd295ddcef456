"""Substring dedup by words: words of 50-word windows that begin in an earlier document too are removed.

Documents are streamed against compressed full-text indexes (see ``fmindex``), one for each shard of the text that documents
share:

- every window has a least 16-word string in it, by hash, its anchor; a text is cut into overlapping segments, one for each run
  of successive windows with the same anchor. Equal windows have equal anchors, so that only segments whose anchor other
  texts have too can hold a shared window. Anchors are counted by buckets of their hashes; blocks of documents send them
  packed and get a number back for each;
- where more than ``HOT`` texts have an anchor, its segments' windows are counted in the same way, by hashes of their own, and
  the shared ones are segments by themselves, with that hash as their anchor;
- the segments are dealt out by anchor. Each block sends a segment once, with the least doc_id that has it, and keeps to itself
  where it has it. A shard indexes the different segments, and streams them backward through its indexes: where the
  matching statistics reach 50 words, the interval of suffixes gives the least doc_id that has the window;
- the block removes the words of windows whose least doc_id is smaller than the document's own.

Of documents with equal texts only the first is cut into segments; the others go as a whole if they have 50 words. Results are
exact: hashes only choose what is compared, but for texts and hot windows of equal 64-bit hashes among n, with a chance of
about n²/2⁶⁵.

Defined cases: a null text has no words. Documents without doc_id are in no order: they lose nothing and take nothing from
others. Repeated rows of a doc_id don't take from each other. Words are taken as they are, whatever their bytes. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexapla.llm.common import written
from hexapla.llm.fmindex import FMIndex
from hexapla.llm.jaccard import _blocks, _bucket_rows, _BUCKETED, _by_bucket, _Sender
from hexapla.llm.shingles import _BYTE, _mix, _SPACE, powers
from hexapla.llm.substrings import _pack, _unite, _unpack

#: Words of the windows compared, and of their anchors.
DEPTH, ANCHOR = 50, 16
WINDOW = DEPTH - ANCHOR + 1
#: Texts with an anchor from which on windows are dealt out one by one.
HOT = 10_000
#: Bytes of text in a block, anchors in a bucket, and segments in an index.
BLOCK_BYTES, BUCKET, MOST_SEGMENTS = 2 << 20, 250_000, 20_000

_TURN = 0x9E3779B97F4A7C15


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of all words of the texts, put one after the other with a space behind each, and how many words each
    text has."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    edge = np.flatnonzero(np.diff(_SPACE[data], prepend=True))
    starts, ends = edge[0::2], edge[1::2]
    hashes, at = [], 0
    while at < len(starts):  # the sums of a bounded number of bytes at a time, but whole words
        z = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK_BYTES, "right")))
        a, n = starts[at], int(ends[z - 1] - starts[at])
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data[a : a + n]] * powers("power", n + 1)[:n], out=total[1:])
        s, e = starts[at:z] - a, ends[at:z] - a
        hashes.append(_mix((total[e] - total[s]) * powers("inverse", n + 1)[s] + (e - s).astype(np.uint64)))
        at = z
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)])))
    return starts, ends, np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), counts


def _runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each place on."""
    out, got = hashes, 1
    while got < size:
        step = min(got, size - got)
        out = out[: len(out) - step] * np.uint64(pow(_TURN, step, 1 << 64)) + (out[step:] if step == got else _mix(out[step:]))
        got += step
    return _mix(out)


def segments(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, windows, anchor) of all segments, in order: the segment covers ``windows`` successive windows of its text,
    the first from word ``start`` on."""
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    if len(hashes) < DEPTH:
        return none
    least, n = _runs(hashes, ANCHOR), 1
    size = len(least) - WINDOW + 1
    while 2 * n <= WINDOW:
        least = np.minimum(least[:-n], least[n:])
        n *= 2
    least = np.minimum(least[:size], least[WINDOW - n : WINDOW - n + size])
    owner = np.repeat(np.arange(len(counts)), counts)
    inside = np.flatnonzero(owner[:size] == owner[DEPTH - 1 : DEPTH - 1 + size])
    if not len(inside):
        return none
    anchor, owner = least[inside], owner[inside]
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]))
    # a run of more windows than an anchor has places holds the anchor twice
    runs = np.diff(np.append(first, len(anchor)))
    more = np.maximum(-(-runs // WINDOW), 1)
    step = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
    first, runs = np.repeat(first, more) + step * WINDOW, np.minimum(np.repeat(runs, more) - step * WINDOW, WINDOW)
    text = owner[first]
    return text, inside[first] - (np.cumsum(counts) - counts)[text], runs, anchor[first]


def _each(text: np.ndarray, start: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, start) of the single windows of segments."""
    step = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    return np.repeat(text, runs), np.repeat(start, runs) + step


def _window_hashes(hashes: np.ndarray, counts: np.ndarray, text: np.ndarray, start: np.ndarray) -> np.ndarray:
    return _runs(hashes, DEPTH)[(np.cumsum(counts) - counts)[text] + start] if len(text) else np.zeros(0, np.uint64)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list]]:
    """The columns of rows (doc_id, mark, text, ...), a bounded number of bytes at a time."""
    held, size = [], 0
    for b in batches:
        for at in range(0, b.num_rows, 512):
            for row in zip(*[c.to_pylist() for c in b.slice(at, 512).columns], strict=True):
                held.append(row)
                size += len(row[2])
                if size > BLOCK_BYTES:
                    yield [list(c) for c in zip(*held, strict=True)]
                    held, size = [], 0
    if held:
        yield [list(c) for c in zip(*held, strict=True)]


ALONE, SHARED, MANY = 0, 1, 2


def _tokens(hashes: np.ndarray, counts: np.ndarray, codes: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of what is counted: the segments' anchors, or, given these anchors' numbers, the windows of hot ones."""
    text, start, runs, anchor = segments(hashes, counts)
    if codes is None:
        return text, anchor
    hot = np.frombuffer(b"".join(codes), np.uint8) == MANY
    text, start = _each(text[hot], start[hot], runs[hot])
    return text, _window_hashes(hashes, counts, text, start)


def numbers(docs: DataFrame, hot: int, buckets: int, parts: int, windows: bool = False) -> DataFrame:
    """(doc_id, mark, codes) of rows (doc_id, mark, text): for each of the text's segments, in order, a byte that tells whether only
    this text has the anchor, others do, or more than ``hot``. ``windows``: of rows (doc_id, mark, text, codes), for each window
    of the segments with many."""

    def send(batches):
        s = _Sender(buckets)
        for ids, marks, texts, *codes in _texts(batches):
            _, _, hashes, counts = words_of(texts)
            text, token = _tokens(hashes, counts, codes[0] if windows else None)
            order, cuts = s.deal(token)
            block, per = s.number(), np.bincount(text, minlength=len(texts)).astype("<i8")
            mine = np.frombuffer(b"".join(m[:8] for m in marks), "<u8")[text]
            # which bucket has which token stays with the block's head, in the order in which the answers come back
            head = np.array(ids, "<i8").tobytes() + per.tobytes() + b"".join(marks)
            rows = [(block, s.head(block), head, _pack(order.astype("<u4")))]
            rows += [(block, b, b"", _pack(mine[order[i:j]], (token[order[i:j]] & np.uint64(0xFFFFFFFF)).astype("<u4"))) for b, (i, j) in cuts.items()]
            yield _bucket_rows(rows)

    def count_(batches):
        for bucket, rows in _by_bucket(batches):
            if bucket < 0:
                for at in range(0, len(rows), 16):
                    yield _bucket_rows(rows[at : at + 16])
                continue
            mine, low = zip(*[_unpack(r[3], ["<u8", "<u4"]) for r in rows], strict=True)
            sizes = [len(x) for x in low]
            mine, low = np.concatenate(mine), np.concatenate(low)
            order = np.lexsort((mine, low))
            m, t = mine[order], low[order]
            head = np.concatenate([[True], t[1:] != t[:-1]])
            new = np.concatenate([[True], (t[1:] != t[:-1]) | (m[1:] != m[:-1])])
            many = np.bincount(np.cumsum(head) - 1, new)
            code = np.empty(len(t), np.uint8)
            code[order] = np.where(many > hot, MANY, np.where(many > 1, SHARED, ALONE))[np.cumsum(head) - 1]
            yield _bucket_rows([(r[0], bucket, b"", _pack(x)) for r, x in zip(rows, np.split(code, np.cumsum(sizes)[:-1]), strict=True)])

    def gather(batches):
        for rows in _blocks(batches):
            n = len(rows[0][2]) // 32
            ids, per = np.frombuffer(rows[0][2][: 16 * n], "<i8").reshape(2, -1)
            order = _unpack(rows[0][3], ["<u4"])[0]
            codes = np.empty(len(order), np.uint8)
            codes[order] = np.concatenate([_unpack(r[3], ["<u1"])[0] for r in rows[1:]]) if len(order) else 0
            found = [x.tobytes() if x.any() else None for x in np.split(codes, np.cumsum(per)[:-1])]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([rows[0][2][16 * (n + k) : 16 * (n + k + 1)] for k in range(n)], pa.binary()), pa.array(found, pa.binary())], ["doc_id", "mark", "codes"])

    sent = docs.mapInArrow(send, _BUCKETED).repartition(parts, "bucket").sortWithinPartitions("bucket")
    back = sent.mapInArrow(count_, _BUCKETED).repartition("block").sortWithinPartitions("block", "bucket")
    return back.mapInArrow(gather, "doc_id long, mark binary, codes binary")


def least_owners(strings: list[bytes], anchors: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """For each window of these different segments (words with single spaces between) the least owner of a segment that has it.
    Segments with equal anchors are indexed together while they fit; where they don't, each index is searched for all of them."""
    if not strings:
        return np.zeros(0, np.int64)
    number = defaultdict(count(1).__next__)
    sizes = np.fromiter((x.count(b" ") + 1 for x in strings), np.int64, len(strings))
    order = np.argsort(anchors, kind="stable")
    sizes, owners, anchors = sizes[order], owners[order], anchors[order]
    symbols = np.fromiter(map(number.__getitem__, b" ".join([strings[k] for k in order.tolist()]).split(b" ")), np.int64, int(sizes.sum()))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    groups = [*np.flatnonzero(np.diff(anchors, prepend=~anchors[:1])).tolist(), len(order)]
    out = np.full(len(symbols), np.iinfo(np.int64).max)
    at = 0
    while at < len(order):
        fit = [z for z in groups if at < z <= at + MOST_SEGMENTS]
        z = fit[-1] if fit else next(z for z in groups if z > at)
        stream, lengths = symbols[ends[at] : ends[z]], sizes[at:z]
        for a in range(at, z, MOST_SEGMENTS):
            e = min(z, a + MOST_SEGMENTS)
            alphabet = np.unique(symbols[ends[a] : ends[e]])
            place = np.zeros(len(number) + 1, np.int64)
            place[alphabet] = np.arange(1, len(alphabet) + 1)
            index = FMIndex(place[symbols[ends[a] : ends[e]]], sizes[a:e], owners[a:e], len(alphabet) + 1, DEPTH)
            length, owner = index.matching_statistics(place[stream], lengths)
            here = out[ends[at] : ends[z]]
            np.minimum(here, np.where(length == DEPTH, owner, np.iinfo(np.int64).max), out=here)
        at = z
    # a segment's windows begin at all but its last words; back to the order in which they came
    begins, windows = ends[:-1], sizes - DEPTH + 1
    back = np.argsort(order, kind="stable")
    spot, step = _each(begins[back], np.zeros(len(order), np.int64), windows[back])
    return out[spot + step]


def spans(cut: DataFrame, buckets: int, parts: int) -> DataFrame:
    """(doc_id, mark, spans) of the rows of ``cut`` (doc_id, mark, text, codes, single) that lose words; spans are pairs of 32-bit
    integers, the first word and the one after the last of each run of removed words."""

    def send(batches):
        s = _Sender(buckets)
        for ids, marks, texts, codes, single in _texts(batches):
            starts, ends, hashes, counts = words_of(texts)
            data, before = b" ".join(texts), np.cumsum(counts) - counts
            text, start, runs, anchor = segments(hashes, counts)
            code = np.frombuffer(b"".join(codes), np.uint8)
            hot = code == MANY
            t, a = _each(text[hot], start[hot], runs[hot])
            wanted = np.frombuffer(b"".join(x or b"" for x in single), np.uint8) != ALONE
            # texts whose hot windows are all their own have no numbers for them
            known = np.fromiter((x is not None for x in single), bool, len(single))[t]
            t, a = t[known][wanted], a[known][wanted]
            some = code == SHARED
            text, start, runs = np.concatenate([text[some], t]), np.concatenate([start[some], a]), np.concatenate([runs[some], np.ones(len(t), np.int64)])
            anchor = np.concatenate([anchor[some], _window_hashes(hashes, counts, t, a)])
            order, cuts = s.deal(anchor)
            block, doc = s.number(), np.array(ids, "<i8")
            first, last = starts[before[text] + start], ends[before[text] + start + runs + DEPTH - 2]
            rows, which_all = [], np.zeros(len(order), "<u4")
            for b, (i, j) in cuts.items():
                here, which = order[i:j], {}
                each = [which.setdefault(b" ".join(data[x:y].split()), len(which)) for x, y in zip(first[here].tolist(), last[here].tolist(), strict=True)]
                which_all[i:j] = each
                one = np.unique(np.array(each), return_index=True)[1]
                least = np.full(len(which), np.iinfo(np.int64).max)
                np.minimum.at(least, each, doc[text[here]])
                rows.append((block, b, b"", _pack(np.frombuffer(b"\n".join(which), np.uint8), anchor[here][one], least)))
            head = _pack(doc, np.frombuffer(b"".join(marks), np.uint8), text[order].astype("<u4"), start[order].astype("<u4"), runs[order].astype("<u1"), which_all, np.array([[b, j - i] for b, (i, j) in cuts.items()], "<i8").ravel())
            yield _bucket_rows([(block, s.head(block), b"", head), *rows])

    def search(batches):
        for bucket, rows in _by_bucket(batches):
            if bucket < 0:
                for at in range(0, len(rows), 16):
                    yield _bucket_rows(rows[at : at + 16])
                continue
            known: dict[bytes, int] = {}
            anchors, held = [], []
            for block, _, _, body in rows:
                data, anchor, least = _unpack(body, ["<u1", "<u8", "<i8"])
                mine = np.fromiter((known.setdefault(x, len(known)) for x in data.tobytes().split(b"\n")), np.int64, len(anchor))
                new = mine >= len(anchors)
                anchors += anchor[new].tolist()
                held.append((block, mine, least))
            owners = np.full(len(known), np.iinfo(np.int64).max)
            for _, mine, least in held:
                np.minimum.at(owners, mine, least)
            strings = list(known)
            found = least_owners(strings, np.array(anchors, np.uint64), owners)
            windows = np.fromiter((x.count(b" ") + 2 - DEPTH for x in strings), np.int64, len(strings))
            begins = np.cumsum(windows) - windows
            for block, mine, _ in held:
                at, step = _each(begins[mine], np.zeros(len(mine), np.int64), windows[mine])
                yield _bucket_rows([(block, bucket, b"", _pack(found[at + step]))])

    def gather(batches):
        for rows in _blocks(batches):
            ids, marks, text, start, runs, each, sizes = _unpack(rows[0][3], ["<i8", "<u1", "<u4", "<u4", "<u1", "<u4", "<i8"])
            marks, sizes, at, gone = marks.tobytes(), dict(sizes.reshape(-1, 2).tolist()), 0, []
            spots = {}
            for b, n in sizes.items():
                spots[b] = (at, at + n)
                at += n
            for r in rows[1:]:
                least, (i, j) = _unpack(r[3], ["<i8"])[0], spots[r[1]]
                one = np.unique(each[i:j], return_index=True)[1]
                windows = runs[i:j][one].astype(np.int64)
                begins = np.cumsum(windows) - windows
                n = runs[i:j].astype(np.int64)
                t, a = _each(text[i:j].astype(np.int64), start[i:j].astype(np.int64), n)
                spot, step = _each(begins[each[i:j]], np.zeros(j - i, np.int64), n)
                lost = least[spot + step] < ids[t]
                gone.append((t[lost], a[lost]))
            if gone:
                t, a = (np.concatenate(x) for x in zip(*gone, strict=True))
                t, a, z = _unite(t, a, a + DEPTH)
                if len(t):
                    texts, first = np.unique(t, return_index=True)
                    both = np.split(np.stack([a, z], axis=1).astype("<u4"), first[1:])
                    yield pa.RecordBatch.from_arrays([pa.array(ids[texts]), pa.array([marks[16 * k : 16 * k + 16] for k in texts.tolist()], pa.binary()), pa.array([x.tobytes() for x in both])], ["doc_id", "mark", "spans"])

    sent = cut.mapInArrow(send, _BUCKETED).repartition(parts, "bucket").sortWithinPartitions("bucket")
    back = sent.mapInArrow(search, _BUCKETED).repartition("block").sortWithinPartitions("block", "bucket")
    return back.mapInArrow(gather, "doc_id long, mark binary, spans binary")


def removed_spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, mark, copy, spans) of distinct rows: whether the text is that of a smaller doc_id, and what it loses else."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, size // 100 // BUCKET)
    parts = max(1, min(buckets, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    same = lambda a, b: (F.col(f"{a}.doc_id") == F.col(f"{b}.doc_id")) & (F.col(f"{a}.mark") == F.col(f"{b}.mark"))
    marked = written(numbers(docs, hot, buckets, parts), "passages-anchors").distinct()
    first = written(marked.groupBy("mark").agg(F.min("doc_id").alias("first")).withColumnRenamed("mark", "f_mark"), "passages-first")
    known = written(marked.join(first, F.col("mark") == F.col("f_mark")).select("doc_id", "mark", (F.col("doc_id") > F.col("first")).alias("copy"), "codes"), "passages-copies")
    wanted = known.filter("not copy and codes is not null").select("doc_id", "mark", "codes")
    cut = docs.alias("d").join(wanted.alias("w"), same("d", "w")).select("d.doc_id", "d.mark", "d.text", "w.codes")
    many = F.col("codes").cast("string").contains(chr(MANY))
    single = written(numbers(cut.filter(many), hot, buckets, parts, windows=True).distinct(), "passages-windows")
    cut = cut.alias("c").join(single.alias("n"), same("c", "n"), "left").select("c.doc_id", "c.mark", "c.text", "c.codes", F.col("n.codes").alias("single"))
    found = written(spans(cut, buckets, parts), "passages-spans").distinct()
    return known.alias("k").join(found.alias("f"), same("k", "f"), "left").select("k.doc_id", "k.mark", "k.copy", "f.spans")


def deduplicated(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, kept, n_words, n_removed, n_spans) of each row of ``docs`` (doc_id, text); ``kept`` are the words that stay, with
    single spaces between. ``hot``: texts with an anchor from which on its windows are dealt out one by one."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), F.unhex(F.md5(text.cast("binary"))).alias("mark"), text.cast("binary").alias("text"))
    info = written(removed_spans(rows.filter("doc_id is not null"), hot), "passages-info")
    on = (F.col("r.doc_id") == F.col("i.doc_id")) & (F.col("r.mark") == F.col("i.mark"))
    joined = rows.alias("r").join(info.alias("i"), on, "left").select("r.doc_id", "r.mark", "r.text", "i.copy", "i.spans")

    def remove(batches):
        for ids, _, texts, copies, spans_ in _texts(batches):
            out = []
            for i, t, copy, s in zip(ids, texts, copies, spans_, strict=True):
                words = t.split()
                n = len(words)
                if copy and n >= DEPTH:
                    out.append((i, b"", n, n, 1))
                    continue
                runs = np.frombuffer(s or b"", "<u4").reshape(-1, 2).tolist()
                for a, z in reversed(runs):
                    del words[a:z]
                out.append((i, b" ".join(words), n, n - len(words), len(runs)))
            types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), types, strict=True)], ["doc_id", "kept", "n_words", "n_removed", "n_spans"])

    return joined.mapInArrow(remove, "doc_id long, kept binary, n_words long, n_removed long, n_spans long")
