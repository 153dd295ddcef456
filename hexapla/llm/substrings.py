"""Suffix-array dedup: bytes of 50-byte strings that begin in an earlier document too are removed.

The collection whose suffixes are sorted is made of segments. Every 50-byte string has a least 16-byte string in it, by
hash, its anchor; a document is cut into overlapping segments, one for each run of successive 50-byte strings with the
same anchor, so that each 50-byte string is in one segment whole, and equal strings have equal anchors. It follows that

- segments whose anchor occurs in one text only need not be sorted. Anchors are counted by buckets of their hashes: blocks
  of documents send them packed, and get one bit for each back;
- segments with different anchors need not be sorted together. Those left are dealt out by anchor, and the collection of
  each bucket is built column by column (see ``bwt``), one symbol of each segment a round, in sequential files;
- equal segments are sent once by each block, and sorted once, with the least doc_id. Strings of a segment that differ
  from those of all others of its anchor in the bytes around the anchor are cut off before;
- where one anchor has too many segments for a collection, each of their strings is a document of several collections.

In the sorted suffixes, runs with 50 bytes in common give each 50-byte string its least doc_id; where that is smaller
than the document's own, the string's bytes go. Of documents with equal texts only the first is cut into segments; the
others go as a whole if they have 50 bytes.

Defined cases: a null text is empty. Documents without doc_id are in no order: they lose nothing and take nothing from
others. Repeated rows of a doc_id don't take from each other. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexapla.llm.bwt import least_by_prefix
from hexapla.llm.common import new_path, written
from hexapla.llm.jaccard import _blocks, _bucket_rows, _BUCKETED, _by_bucket, _Sender
from hexapla.llm.shingles import powers

#: Bytes of the strings compared, and of their anchors.
DEPTH, ANCHOR = 50, 16
WINDOW = DEPTH - ANCHOR + 1
#: Offsets of the anchor in a string that are looked at together when segments are compared.
OFFSETS = 9
#: Bytes of text in a block, anchors in a bucket of counts, and segments sorted together.
BLOCK_BYTES, BUCKET, MOST_SEGMENTS = 2 << 20, 250_000, 100_000

_BYTE = np.random.default_rng(50).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _anchor_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ANCHOR bytes from each place on (ANCHOR is a power of two)."""
    h, n = _BYTE[data], 1
    while n < ANCHOR:
        h = h[:-n] * np.uint64(pow(_BASE, n, 1 << 64)) + h[n:]
        n *= 2
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def segments(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, strings, anchor) of all segments of the texts, in order: the segment covers ``strings`` successive
    DEPTH-byte strings from ``start`` on."""
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < DEPTH:
        return none
    least, n = _anchor_hashes(data), 1
    size = len(least) - WINDOW + 1
    while 2 * n <= WINDOW:
        least = np.minimum(least[:-n], least[n:])
        n *= 2
    least = np.minimum(least[:size], least[WINDOW - n : WINDOW - n + size])
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)
    inside = np.flatnonzero(owner[: len(least)] == owner[DEPTH - 1 : DEPTH - 1 + len(least)])
    if not len(inside):
        return none
    anchor, owner = least[inside], owner[inside]
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]))
    # a run of more strings than an anchor has places holds the anchor twice
    runs = np.diff(np.append(first, len(anchor)))
    more = np.maximum(-(-runs // WINDOW), 1)
    step = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
    first, runs = np.repeat(first, more) + step * WINDOW, np.minimum(np.repeat(runs, more) - step * WINDOW, WINDOW)
    text = owner[first]
    return text, inside[first] - (ends - sizes)[text], runs, anchor[first]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list]]:
    """The columns of rows (doc_id, mark, text, ...), a bounded number of bytes at a time."""
    held, size = [], 0
    for b in batches:
        for at in range(0, b.num_rows, 512):
            part = b.slice(at, 512)
            columns = [part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).cast(pa.binary()).to_pylist(), *[c.to_pylist() for c in part.columns[3:]]]
            for row in zip(*columns, strict=True):
                held.append(row)
                size += len(row[2])
                if size > BLOCK_BYTES:
                    yield [list(c) for c in zip(*held, strict=True)]
                    held, size = [], 0
    if held:
        yield [list(c) for c in zip(*held, strict=True)]


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value."""
    parts = [a.tobytes() for a in arrays]
    return zstandard.compress(np.array([len(p) for p in parts], "<u4").tobytes() + b"".join(parts), 1)


def _unpack(data: bytes, kinds: list[str]) -> list[np.ndarray]:
    data = zstandard.decompress(data)
    sizes = np.frombuffer(data[: 4 * len(kinds)], "<u4").tolist()
    out, at = [], 4 * len(kinds)
    for n, kind in zip(sizes, kinds, strict=True):
        out.append(np.frombuffer(data[at : at + n], kind))
        at += n
    return out


def shared_anchors(docs: DataFrame, buckets: int, parts: int) -> DataFrame:
    """(doc_id, mark, bits): for each segment of each row, in order, whether another row's segment has its anchor."""

    def send(batches):
        s = _Sender(buckets)
        for ids, marks, texts in _texts(batches):
            text, _, _, anchor = segments(texts)
            order, cuts = s.deal(anchor)
            block, low = s.number(), (anchor[order] & np.uint64(0xFFFFFFFF)).astype("<u4")
            per = np.bincount(text, minlength=len(texts)).astype("<i8")
            rows = [(block, s.head(block), np.array(ids, "<i8").tobytes() + per.tobytes(), b"".join(marks) + anchor.tobytes())]
            # an anchor counts once for each text: a second one in the same text is no other row's
            for b, (i, j) in cuts.items():
                rows.append((block, b, text[order[i:j]].astype("<u4").tobytes(), low[i:j].tobytes()))
            yield _bucket_rows(rows)

    def count(batches):
        for bucket, rows in _by_bucket(batches):
            if bucket < 0:
                for at in range(0, len(rows), 16):
                    yield _bucket_rows(rows[at : at + 16])
                continue
            low = np.concatenate([np.frombuffer(r[3], "<u4") for r in rows])
            sizes = [len(r[3]) // 4 for r in rows]
            text = np.concatenate([np.frombuffer(r[2], "<u4").astype(np.uint64) for r in rows]) | (np.repeat(np.arange(len(rows)), sizes).astype(np.uint64) << np.uint64(32))
            order = np.lexsort((text, low))
            a, t = low[order], text[order]
            head = np.concatenate([[True], a[1:] != a[:-1]]) if len(a) else np.zeros(0, bool)
            other = np.concatenate([[False], (a[1:] == a[:-1]) & (t[1:] != t[:-1])]) if len(a) else head
            group = np.cumsum(head) - 1
            shared = np.zeros(len(a), bool)
            shared[order] = (np.bincount(group, other) > 0)[group] if len(a) else other
            yield _bucket_rows([(r[0], bucket, b"", np.packbits(x).tobytes()) for r, x in zip(rows, np.split(shared, np.cumsum(sizes)[:-1]), strict=True)])

    def gather(batches):
        s = _Sender(buckets)
        for rows in _blocks(batches):
            ids, per = np.frombuffer(rows[0][2], "<i8").reshape(2, -1)
            n = len(ids)
            marks, anchor = [rows[0][3][16 * i : 16 * i + 16] for i in range(n)], np.frombuffer(rows[0][3][16 * n :], "<u8")
            order, cuts = s.deal(anchor)
            bits = np.zeros(len(anchor), np.uint8)
            for r in rows[1:]:
                i, j = cuts[r[1]]
                bits[order[i:j]] = np.unpackbits(np.frombuffer(r[3], np.uint8), count=j - i)
            found = [np.packbits(x).tobytes() if x.any() else None for x in np.split(bits, np.cumsum(per)[:-1])]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(marks, pa.binary()), pa.array(found, pa.binary())], ["doc_id", "mark", "bits"])

    sent = docs.mapInArrow(send, _BUCKETED).repartition(parts, "bucket").sortWithinPartitions("bucket")
    back = sent.mapInArrow(count, _BUCKETED).repartition("block").sortWithinPartitions("block", "bucket")
    return back.mapInArrow(gather, "doc_id long, mark binary, bits binary")


_SENT = ["<u4", "<u4", "<i8", "<u4", "<u1", "<u8", "<u1"]  # text, start, doc_id, which; strings, anchor and bytes of each


def _hashed(data: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function that gives a hash of data[a:z] for arrays of such places."""
    n = len(data) + 1
    total = np.zeros(n, np.uint64)
    np.cumsum(_BYTE[data] * powers("power", n)[: n - 1], out=total[1:])
    inverse = powers("inverse", n)
    return lambda a, z: (total[z] - total[a]) * inverse[a]


def shared_parts(kept: list[bytes], anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(low, high): of each of these different segments the strings that another one may have, from number ``low`` up to
    ``high``; none where they are equal. The strings left out are in no other segment.

    A string has its anchor at one of WINDOW offsets. These are taken in four ranges; all strings of a range have some bytes
    around the anchor in common, and another segment with the string has the same bytes around its own.
    """
    sizes = np.fromiter(map(len, kept), np.int64, len(kept))
    low, high = np.full(len(kept), np.iinfo(np.int64).max), np.zeros(len(kept), np.int64)
    data = np.frombuffer(b"".join(kept), np.uint8)
    begins, hashed = np.cumsum(sizes) - sizes, _hashed(data)
    owner = np.repeat(np.arange(len(kept)), sizes)
    at = np.flatnonzero(_anchor_hashes(data) == anchors[owner[: len(data) - ANCHOR + 1]]) if len(data) else np.zeros(0, np.int64)
    who = owner[at]
    place = at - begins[who]
    for a in range(0, WINDOW, OFFSETS):
        z = min(a + OFFSETS, WINDOW) - 1
        right = ANCHOR + WINDOW - 1 - z
        inside = np.flatnonzero((place >= a) & (place + right <= sizes[who]))
        key, mine, spot = hashed(at[inside] - a, at[inside] + right), who[inside], place[inside]
        order = np.lexsort((mine, key))
        key, mine, spot = key[order], mine[order], spot[order]
        first = np.concatenate([np.ones(min(len(key), 1), bool), key[1:] != key[:-1]])
        other = np.concatenate([np.zeros(min(len(key), 1), bool), (key[1:] == key[:-1]) & (mine[1:] != mine[:-1])])
        group = np.cumsum(first) - 1
        found = np.flatnonzero((np.bincount(group, other) > 0)[group]) if len(group) else group
        mine, spot = mine[found], spot[found]
        np.minimum.at(low, mine, np.maximum(spot - z, 0))
        np.maximum.at(high, mine, np.minimum(spot - a, sizes[mine] - DEPTH) + 1)
    return np.minimum(low, high), high


def sort_segments(kept: list[bytes], anchors: np.ndarray, ids: np.ndarray, folder: str | None = None) -> list[np.ndarray]:
    """For each of these different segments the least doc_id of each of its strings, among all of them."""
    low, high = shared_parts(kept, anchors)
    out = [np.full(len(x) - DEPTH + 1, i) for x, i in zip(kept, ids.tolist(), strict=True)]
    some = np.flatnonzero(low < high)
    some = some[np.argsort(anchors[some], kind="stable")]
    parts = [kept[k][a : z + DEPTH - 1] for k, a, z in zip(some.tolist(), low[some].tolist(), high[some].tolist(), strict=True)]
    first = np.flatnonzero(np.diff(anchors[some], prepend=~anchors[some[:1]]))
    ends = [*first[1:].tolist(), len(some)]
    at = 0
    while at < len(some):
        fit = [z for z in ends if at < z <= at + MOST_SEGMENTS]
        end = fit[-1] if fit else next(z for z in ends if z > at)
        sort = least_by_prefix if fit else _sort_by_string
        for k, least in zip(some[at:end].tolist(), sort(parts[at:end], ids[some[at:end]], DEPTH, folder), strict=True):
            out[k][low[k] : high[k]] = least
        at = end
    return out


def _sort_by_string(parts: list[bytes], ids: np.ndarray, depth: int, folder: str | None) -> list[np.ndarray]:
    """The same for too many segments of one anchor: all their strings, ordered by hash, in collections of bounded size.
    Where equal strings are in several collections, these are joined by one more of one string for each."""
    sizes = np.fromiter((len(x) - depth + 1 for x in parts), np.int64, len(parts))
    owner = np.repeat(np.arange(len(parts)), sizes)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    start = np.repeat(np.cumsum(sizes + depth - 1) - sizes - depth + 1, sizes) + step
    data = b"".join(parts)
    hashes = _hashed(np.frombuffer(data, np.uint8))(start, start + depth)
    order = np.argsort(hashes, kind="stable")
    string = lambda i: data[start[i] : start[i] + depth]
    least, cut = ids[owner], []
    for at in range(0, len(order), MOST_SEGMENTS):
        here = order[at : at + MOST_SEGMENTS]
        least[here] = np.concatenate(least_by_prefix([string(i) for i in here], least[here], depth, folder))
        cut += [np.flatnonzero(hashes[here] == hashes[here[k]]) + at for k in ((0,) if at + len(here) == len(order) else (0, len(here) - 1))]
    ends = np.unique(np.concatenate(cut)) if len(order) > MOST_SEGMENTS else np.zeros(0, np.int64)
    one: dict[tuple[int, bytes], int] = {}
    for i in order[ends].tolist():
        one.setdefault((int(least[i]), string(i)), i)
    if one:
        joined = np.concatenate(least_by_prefix([w for _, w in one], np.array([i for i, _ in one]), depth, folder))
        lowest = {}
        for (_, w), i in zip(one, joined.tolist(), strict=True):
            lowest[w] = i
        for i in order[ends].tolist():
            least[i] = lowest[string(i)]
    return np.split(least, np.cumsum(sizes)[:-1])


def spans(cut: DataFrame, buckets: int, parts: int, folder: str) -> DataFrame:
    """(doc_id, mark, spans) of the rows of ``cut`` (doc_id, mark, text, bits) that lose bytes; spans are pairs of 32-bit
    integers, the start and the end of each run of removed bytes. The collections' files are put under ``folder``."""

    def send(batches):
        s = _Sender(buckets)
        for ids, marks, texts, bits in _texts(batches):
            text, start, runs, anchor = segments(texts)
            per = np.bincount(text, minlength=len(texts)).tolist()
            flags = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(bits, per, strict=True)]
            at = np.flatnonzero(np.concatenate(flags)) if flags else np.zeros(0, np.int64)
            text, start, runs, anchor = text[at], start[at], runs[at], anchor[at]
            order, cuts = s.deal(anchor)
            block, doc = s.number(), np.array(ids, "<i8")
            rows = [(block, s.head(block), doc.tobytes(), b"".join(marks))]
            for b, (i, j) in cuts.items():
                here = order[i:j]
                which: dict[bytes, int] = {}
                each = [which.setdefault(texts[t][a : a + n + DEPTH - 1], len(which)) for t, a, n in zip(text[here].tolist(), start[here].tolist(), runs[here].tolist(), strict=True)]
                one = np.unique(np.array(each), return_index=True)[1]
                body = _pack(text[here].astype("<u4"), start[here].astype("<u4"), doc[text[here]], np.array(each, "<u4"), runs[here][one].astype("<u1"), anchor[here][one], np.frombuffer(b"".join(which), np.uint8))
                rows.append((block, b, b"", body))
            yield _bucket_rows(rows)

    def sort(batches):
        for bucket, rows in _by_bucket(batches):
            if bucket < 0:
                for at in range(0, len(rows), 64):
                    yield _bucket_rows(rows[at : at + 64])
                continue
            known: dict[bytes, int] = {}
            anchors, least, held = [], [], []
            for block, _, _, body in rows:
                text, start, doc, each, runs, anchor, data = _unpack(body, _SENT)
                data, at, mine = data.tobytes(), 0, np.empty(len(runs), np.int64)
                for k, n in enumerate((runs.astype(np.int64) + DEPTH - 1).tolist()):
                    mine[k] = known.setdefault(data[at : at + n], len(known))
                    at += n
                    if mine[k] == len(anchors):
                        anchors.append(anchor[k])
                each = mine[each]
                least += [np.iinfo(np.int64).max] * (len(known) - len(least))
                held.append((block, text, start, doc, each))
            ids = np.array(least, np.int64)
            for _, _, _, doc, each in held:
                np.minimum.at(ids, each, doc)
            found = sort_segments(list(known), np.array(anchors, np.uint64), ids, folder)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            begins, flat = np.cumsum(sizes) - sizes, np.concatenate(found)
            for block, text, start, doc, each in held:
                n = sizes[each]
                owner = np.repeat(np.arange(len(each)), n)
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                gone = flat[begins[each][owner] + step] < doc[owner]
                a, t = start[owner][gone].astype(np.int64) + step[gone], text[owner][gone].astype(np.int64)
                t, a, z = _unite(t, a, a + DEPTH)
                if len(t):
                    yield _bucket_rows([(block, bucket, b"", _pack(t.astype("<u4"), a.astype("<u4"), z.astype("<u4")))])

    def gather(batches):
        for rows in _blocks(batches):
            ids = np.frombuffer(rows[0][2], "<i8")
            marks = rows[0][3]
            parts_ = [_unpack(r[3], ["<u4"] * 3) for r in rows[1:]]
            if parts_:
                t, a, z = _unite(*[np.concatenate([p[k] for p in parts_]).astype(np.int64) for k in range(3)])
                texts, first = np.unique(t, return_index=True)
                both = np.split(np.stack([a, z], axis=1).astype("<u4"), first[1:])
                yield pa.RecordBatch.from_arrays([pa.array(ids[texts]), pa.array([marks[16 * k : 16 * k + 16] for k in texts.tolist()], pa.binary()), pa.array([x.tobytes() for x in both])], ["doc_id", "mark", "spans"])

    sent = cut.mapInArrow(send, _BUCKETED).repartition(parts, "bucket").sortWithinPartitions("bucket")
    back = sent.mapInArrow(sort, _BUCKETED).repartition("block").sortWithinPartitions("block", "bucket")
    return back.mapInArrow(gather, "doc_id long, mark binary, spans binary")


def _unite(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans with those of the same owner that overlap or touch united."""
    if not len(owner):
        return owner, start, end
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], end[order]
    shift = owner * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + shift)
    first = np.flatnonzero(np.concatenate([[True], start[1:] + shift[1:] > reach[:-1]]))
    return owner[first], start[first], (np.append(reach[first[1:] - 1], reach[-1]) - shift[first])


def removed_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, copy, spans) of distinct rows: whether the text is that of a smaller doc_id, and what it loses else."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, size // 19 // BUCKET)
    parts = max(1, min(buckets, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    marked = written(shared_anchors(docs, buckets, parts), "substrings-anchors").distinct()
    first = written(marked.groupBy("mark").agg(F.min("doc_id").alias("first")).withColumnRenamed("mark", "f_mark"), "substrings-first")
    known = written(marked.join(first, F.col("mark") == F.col("f_mark")).select("doc_id", "mark", (F.col("doc_id") > F.col("first")).alias("copy"), "bits"), "substrings-copies")
    wanted = known.filter("not copy and bits is not null").select(F.col("doc_id").alias("w_id"), F.col("mark").alias("w_mark"), "bits")
    cut = docs.join(wanted, (F.col("doc_id") == F.col("w_id")) & (F.col("mark") == F.col("w_mark"))).select("doc_id", "mark", "text", "bits")
    found = written(spans(cut, buckets, parts, new_path(spark, "substrings-columns")), "substrings-spans").distinct()
    found = found.select(F.col("doc_id").alias("s_id"), F.col("mark").alias("s_mark"), "spans")
    return known.join(found, (F.col("doc_id") == F.col("s_id")) & (F.col("mark") == F.col("s_mark")), "left").select("doc_id", "mark", "copy", "spans")


def deduplicated(docs: DataFrame) -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans) of each row of ``docs`` (doc_id, text); ``kept`` are the bytes that stay."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), F.unhex(F.md5(text.cast("binary"))).alias("mark"), text.alias("text"))
    info = removed_spans(rows.filter("doc_id is not null")).select(F.col("doc_id").alias("i_id"), F.col("mark").alias("i_mark"), "copy", "spans")
    info = written(info, "substrings-info")
    joined = rows.join(info, (F.col("doc_id") == F.col("i_id")) & (F.col("mark") == F.col("i_mark")), "left").select("doc_id", "mark", "text", "copy", "spans")

    def remove(batches):
        for ids, _, texts, copies, spans_ in _texts(batches):
            out = []
            for i, t, copy, s in zip(ids, texts, copies, spans_, strict=True):
                if copy and len(t) >= DEPTH:
                    out.append((i, b"", len(t), len(t), 1))
                elif s:
                    runs = np.frombuffer(s, "<u4").reshape(-1, 2).tolist()
                    kept, at = [], 0
                    for a, z in runs:
                        kept.append(t[at:a])
                        at = z
                    kept = b"".join([*kept, t[at:]])
                    out.append((i, kept, len(t), len(t) - len(kept), len(runs)))
                else:
                    out.append((i, t, len(t), 0, 0))
            types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), types, strict=True)], ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return joined.mapInArrow(remove, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")
