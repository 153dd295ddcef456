"""Token ids: encoding of whole texts with the tokenizers library, and a binary file format for them.

``PieceEncoder`` gives the ids of the library's ``encode``: it cuts texts at single spaces and line feeds, where the
byte-level pre-tokenizer cuts too, has the library encode each distinct piece once, and joins the kept ids. Texts
with other white space, or with a special token's string, go to the library whole.

The file format. A shard holds the documents of a range of doc_ids in ascending order: the magic ``HXID``, the length
of the index as eight bytes, the index as an Arrow stream, then one zstandard frame for each document, compressed by
itself with a dictionary that all shards share. The dictionary was trained on serialized id arrays. The index keeps its
hash, and each document's id, number of ids, and offset and length of the frame. A shard's first and last doc_id are in the
names of its folders. So a short document costs the index of its shard and its own frame, each read at its offset. Ids are serialized as unsigned little-endian integers of 16 bits where the vocabulary allows it, else of 32.
Shards and dictionary are written by Spark's own writers, so they can be in any store that Spark can write, and what a
lost executor had to write is written by another.

Defined cases: a null or empty text has the end id alone. Rows are in the order of doc_id, null first, then of text;
repeated rows are documents of their own, and a null doc_id cannot be asked for by ``wanted``. The dictionary is trained on
the first ``DICT_IDS`` ids of at most ``DICT_DOCS`` sampled documents; with too few or too short ones to train on there is
none, the dictionary file is empty and its hash that of no bytes, and frames are compressed without. An empty table has
shards without documents, or none. Other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import accumulate, islice

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hexapla.llm.common import new_path, written

MAGIC = b"HXID"
#: Distinct pieces whose ids a worker keeps; beyond, it forgets those that came once, then those not in the texts at hand.
MOST_PIECES = 600_000
#: Characters of the texts encoded at a time, beyond the last one's.
CHUNK_CHARS = 4_000_000
#: The dictionary is trained on so many documents at most, and on so many ids of each, and has so many bytes at most.
DICT_DOCS, DICT_IDS, DICT_BYTES = 2_000, 4_096, 64 << 10
#: A shard holds about so many bytes of text; its task keeps its compressed frames in memory.
SHARD_CHARS = 12 << 20
LEVEL = 3
#: White space (as the pre-tokenizer's pattern takes it) other than the space and the line feed.
OTHER_SPACE = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_ASCII_SPACE = OTHER_SPACE[:8]
_DOUBLE = ("  ", "\n\n", " \n", "\n ")


class PieceEncoder:
    """Encodes texts to the bytes of unsigned 32-bit ids, as ``Tokenizer.encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str, most: int = MOST_PIECES):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tails: dict[str, bytes] = {}
        self.first, self.spaced = {}, {}  # ids of pieces at a line's start, and of pieces after a space
        self.again: set[str] = set()  # of the latter, those that were kept already when they came
        (self.newline,) = self._whole(["\n"])
        self.newline_id = int.from_bytes(self.newline, "little")
        self.model = self.tokenizer.model if _is_plain_byte_level(self.tokenizer) else None

    def forget(self) -> None:
        """Drop the kept pieces, not the tokenizer."""
        self.tails, self.first, self.spaced, self.again = {}, {}, {}, set()

    def plain(self, text: str) -> bool:
        """Whether single spaces and line feeds are all its white space, so that it can be cut there."""
        return not any(s in text for s in _DOUBLE) and not any(c in text for c in (_ASCII_SPACE if text.isascii() else OTHER_SPACE)) and not any(s in text for s in self.special)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, before: str, pieces: list[str]) -> list[bytes]:
        """The ids of ``before`` + piece for each piece, encoded as the lines of one text: a line feed between pieces
        without white space is a token of its own, and its id is in no other."""
        import numpy as np

        if not pieces:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast(["\n".join([before + p for p in pieces])], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(ids == self.newline_id)
        if len(ends) != len(pieces) - 1:
            return self._whole([before + p for p in pieces])
        data, cuts = ids.tobytes(), (4 * ends).tolist()
        return [data[i:j] for i, j in zip([0, *[c + 4 for c in cuts]], [*cuts, len(data)], strict=True)]

    def _words(self, before: str, words: list[str]) -> list[bytes]:
        """The same for words of Latin letters, each of which is one piece of the pre-tokenizer's: the library's model is
        given their bytes in its own alphabet."""
        lead, tokenize = _ALPHABET[32] if before else "", self.model.tokenize
        spelt = [w if w.isascii() else w.encode().decode("latin-1").translate(_ALPHABET) for w in words]
        return [array("I", [t.id for t in tokenize(lead + w)]).tobytes() for w in spelt]

    def _make_room(self, begin: list[str], after: list[str]) -> None:
        """Where too many pieces are kept, forget those that were in the texts of one call only, and not in these. If it
        takes more, forget all that these texts don't have."""
        self.again.update(filter(self.spaced.__contains__, after))
        if len(self.spaced) + len(self.first) > self.most:
            self.spaced = {p: self.spaced[p] for p in self.again}
            self.first = {p: self.first[p] for p in begin if p in self.first}
        if len(self.spaced) + len(self.first) > self.most:
            self.spaced = {p: self.spaced[p] for p in after if p in self.spaced}
            self.again = set(self.spaced)

    def _learn(self, kept: dict[str, bytes], pieces: list[str], before: str) -> None:
        """Keep the ids of ``before`` + piece. A letter or digit and a tail of points and commas are separate anyway."""
        pieces = {p for p in pieces if p not in kept}
        stems = list({p.rstrip(".,") for p in pieces}.difference(kept, ("",)))
        latin = [p for p in stems if p.isalpha() and (p.isascii() or max(p) < "\u0250")] if self.model else []
        kept.update(zip(latin, self._words(before, latin), strict=True))
        rest = list(set(stems).difference(latin)) if latin else stems
        kept.update(zip(rest, self._pieces(before, rest), strict=True))
        for p in pieces.difference(stems):
            stem = p.rstrip(".,")
            kept[p] = kept[stem] + self._tail(p[len(stem) :]) if stem and stem[-1].isalnum() else self._whole([before + p])[0]

    def _tail(self, tail: str) -> bytes:
        if tail not in self.tails:
            self.tails[tail] = self._whole([tail])[0]
        return self.tails[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [self.plain(t) for t in texts]
        cut = iter(self._cut([t for t, p in zip(texts, plain, strict=True) if p]))
        rest = iter(self._whole([t for t, p in zip(texts, plain, strict=True) if not p]))
        return [next(cut if p else rest) for p in plain]

    def _cut(self, texts: list[str]) -> list[bytes]:
        """The ids of plain texts. Arrow finds the distinct pieces of all of them, so that Python handles each once."""
        import numpy as np

        if not texts:
            return []
        # a piece at a line's start has the line feed with it, at a text's start one whose id is left out
        words = pc.split_pattern(pa.array(["\n" + t.replace("\n", " \n") for t in texts], pa.large_string()), " ")
        coded = words.values.dictionary_encode()
        pieces, heads = coded.dictionary.to_numpy(zero_copy_only=False), pc.starts_with(coded.dictionary, "\n").to_numpy(zero_copy_only=False)
        begin, after = [p[1:] for p in pieces[heads].tolist()], pieces[~heads].tolist()
        self._make_room(begin, after)
        self._learn(self.first, begin, "")
        self._learn(self.spaced, after, " ")
        found = [*map(self.spaced.__getitem__, after), *(self.newline + self.first[p] for p in begin)]
        of = np.argsort(np.argsort(heads, kind="stable"))[coded.indices.to_numpy()]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        taken = sizes[of]
        ends = np.concatenate([[0], np.cumsum(taken)])
        places = np.arange(ends[-1]) + np.repeat((np.cumsum(sizes) - sizes)[of] - ends[:-1], taken)
        data, cuts = np.frombuffer(b"".join(found), "<u4")[places].tobytes(), (4 * ends[words.offsets.to_numpy()]).tolist()
        return [data[i + 4 : j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


def _byte_alphabet() -> dict[int, str]:
    """The letter of byte-level vocabularies for each byte: itself if it can be printed, else the next one from U+0100 on."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in printed)
    return {b: chr(b) for b in printed} | {b: chr(0x100 + k) for k, b in enumerate(others)}


_ALPHABET = _byte_alphabet()


def _is_plain_byte_level(tokenizer) -> bool:
    """Whether the tokenizer is a byte-level one that changes nothing before or after its model."""
    parts = json.loads(tokenizer.to_str())
    first = parts["pre_tokenizer"] or {}
    return parts["normalizer"] is None and first.get("type") == "ByteLevel" and not first["add_prefix_space"] and first["use_regex"]


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str, most: int = MOST_PIECES) -> PieceEncoder:
    """This worker's encoder for the vocabulary file, which keeps ``most`` pieces."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    _encoders[path].most = most
    return _encoders[path]


def chunks(batches: Iterator[pa.RecordBatch], most: int = CHUNK_CHARS) -> Iterator[tuple[list, list[str]]]:
    """(keys, texts) of the first two columns, a bounded number of characters at a time; null texts are empty."""
    keys, texts, chars = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            keys.append(key)
            texts.append(text.as_py() or "")
            chars += len(texts[-1])
            if chars > most or len(texts) >= 4096:
                yield keys, texts
                keys, texts, chars = [], [], 0
    if keys:
        yield keys, texts


def over_ids(path: str, end: int, make_row: Callable[[], Callable], schema: pa.Schema, most: int = MOST_PIECES) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow over (doc_id, text): ``make_row()``, called once a task, gives a function that yields the tuples of
    a document from its id and its ids, as bytes that end with the id ``end``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, last, row = encoder(path, most), end.to_bytes(4, "little"), make_row()
        gc.disable()  # the ids make many small objects and no cycles
        try:
            for keys, texts in chunks(batches):
                out = [x for i, ids in zip(keys, enc.encode(texts), strict=True) for x in row(i, ids + last)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
        finally:
            gc.enable()

    return run


def narrow(ids: bytes, wide: bool) -> bytes:
    """The serialized form of 32-bit ids: 16-bit unless ``wide``."""
    import numpy as np

    return ids if wide else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def widen(data: bytes, wide: bool) -> bytes:
    """The 32-bit ids of a serialized form."""
    import numpy as np

    return data if wide else np.frombuffer(data, "<u2").astype("<u4").tobytes()


def train_dictionary(docs: DataFrame, path: str, end: int, wide: bool, total: int) -> bytes:
    """A zstandard dictionary from a bounded sample of serialized id arrays; empty where there is too little to train on."""
    import zstandard

    per_million = -(-2 * DICT_DOCS * 1_000_000 // max(total, 1))
    picked = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < per_million).select("doc_id", "text").limit(DICT_DOCS)
    make_row = lambda: lambda _, ids: [(narrow(ids[: 4 * DICT_IDS], wide),)]
    found = picked.mapInArrow(over_ids(path, end, make_row, pa.schema([("ids", pa.binary())])), "ids binary").collect()
    samples = [bytes(r["ids"]) for r in found]
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, sum(map(len, samples)) // 10), samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _codec(dictionary: bytes):
    import zstandard

    d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d), zstandard.ZstdDecompressor(dict_data=d)


def write_ids(docs: DataFrame, path: str, target: str, end: int, shard_chars: int = SHARD_CHARS) -> None:
    """Encode ``docs`` (doc_id, text), end each with ``end``, and write shard files and the dictionary under ``target``.

    The rows are dealt out by ranges of doc_id and sorted, and each task encodes its range and writes its shard. A null
    text is empty; rows with equal doc_ids all stay, in the order of their texts, and null ids come first.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    wide = max(end, encoder(path).tokenizer.get_vocab_size() - 1) >= 1 << 16
    total, chars = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    dictionary = train_dictionary(docs, path, end, wide, total)
    mark = hashlib.sha256(dictionary).hexdigest()

    def make_row():
        pack = _codec(dictionary)[0].compress
        return lambda i, ids: [(i, len(ids) // 4, pack(narrow(ids, wide)))]

    framed = over_ids(path, end, make_row, pa.schema([("doc_id", pa.int64()), ("n_ids", pa.int64()), ("frame", pa.binary())]))

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts, frames = [], [], []
        for b in framed(batches):
            for into, column in zip((ids, counts, frames), b.columns, strict=True):
                into += column.to_pylist()
        if ids:
            offsets = [0, *accumulate(map(len, frames))]
            index = pa.table({"doc_id": pa.array(ids, pa.int64()), "n_ids": pa.array(counts, pa.int64()), "offset": pa.array(offsets[:-1], pa.int64()), "length": pa.array(map(len, frames), pa.int64())})
            index = index.replace_schema_metadata({"dict_hash": mark, "id_bytes": "4" if wide else "2"})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, index.schema) as writer:
                writer.write_table(index)
            head = sink.getvalue().to_pybytes()
            whole = b"".join((MAGIC, len(head).to_bytes(8, "little"), head, *frames))
            yield pa.RecordBatch.from_arrays([pa.array([ids[0]], pa.int64()), pa.array([ids[-1]], pa.int64()), pa.array([whole])], ["first", "last", "shard"])

    dealt = docs.repartitionByRange(max(1, -(-chars // shard_chars)), "doc_id").sortWithinPartitions("doc_id", "text")
    # the text writer writes a string's bytes as they are, and a line feed after them
    named = dealt.mapInArrow(shard, "first long, last long, shard binary").select("first", "last", F.col("shard").cast("string"))
    named.write.partitionBy("first", "last").text(f"{target}/shards")
    spark.createDataFrame([(mark, bytearray(dictionary))], "dict_hash string, dictionary binary").coalesce(1).write.parquet(f"{target}/dictionary")


def shards(spark: SparkSession, target: str, wanted: list[int] | None = None) -> DataFrame:
    """The shard files (path, content) of ``target``, those only whose range of doc_ids has one of the ``wanted``: ranges are
    in the names of the files' folders, so that Spark passes over the others without opening them."""
    files = spark.read.format("binaryFile").load(f"{target}/shards")
    if wanted is None or "first" not in files.columns:
        return files.select("path", "content")
    near = F.exists(F.array(*map(F.lit, wanted)).cast("array<bigint>"), lambda i: i.between(F.col("first").cast("long"), F.col("last").cast("long")))
    return files.filter(F.coalesce(near, F.lit(False)) | F.col("first").isNull()).select("path", "content")


def frames_of(get: Callable[[int, int], bytes], mark: str, dictionary: bytes, only: set[int] | None) -> Iterator[tuple]:
    """(shard_first, place, doc_id, local_start, n_ids, ids) of a shard's documents, of ``only`` some; ``get(offset, size)`` gives
    bytes of the shard: the head, and each document's frame."""
    start = get(0, 12)
    if start[:4] != MAGIC:
        raise ValueError("not a shard of ids")
    head = int.from_bytes(start[4:], "little")
    index = pa.ipc.open_stream(get(12, head)).read_all()
    meta = index.schema.metadata
    if meta[b"dict_hash"].decode() != mark:
        raise ValueError("the shard was written with another dictionary")
    unpack, wide, before = _codec(dictionary)[1].decompress, meta[b"id_bytes"] == b"4", 0
    first = index.column("doc_id")[0].as_py()
    for k, (i, n, at, size) in enumerate(zip(*[index.column(c).to_pylist() for c in ("doc_id", "n_ids", "offset", "length")], strict=True)):
        if only is None or i in only:
            yield first, k, i, before, n, widen(unpack(get(12 + head + at, size)), wide)
        before += n


def arrow_file(path: str) -> pa.NativeFile:
    """A file of the shared folder opened by Arrow, for reading parts of it."""
    system, name = pa.fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
    return system.open_input_file(name)


def read_ids(spark: SparkSession, target: str, wanted: list[int] | None = None) -> DataFrame:
    """(shard_first, place, doc_id, local_start, n_ids, ids) from the files: ``ids`` as unsigned little-endian 32-bit
    integers, ``local_start`` the ids before it in its shard, ``place`` its number there.

    With ``wanted``, only shards whose ranges have one of these documents are opened, and of them only the index and these
    documents' frames are read; where Arrow can't open files of the folder's kind, Spark reads those shards whole."""
    mark, dictionary = spark.read.parquet(f"{target}/dictionary").first()
    dictionary, names = bytes(dictionary), ["shard_first", "place", "doc_id", "local_start", "n_ids", "ids"]
    only = None if wanted is None else set(wanted)
    files, parts = shards(spark, target, wanted), wanted is not None
    try:
        pa.fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", target))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        parts = False

    def rows(value: pa.Scalar) -> Iterator[tuple]:
        if parts:
            with arrow_file(value.as_py()) as f:
                yield from frames_of(lambda at, size: f.read_at(size, at), mark, dictionary, only)
        else:
            data = memoryview(value.as_buffer())
            yield from frames_of(lambda at, size: bytes(data[at : at + size]), mark, dictionary, only)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                found = rows(value)
                while out := list(islice(found, 1024)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int64()] * 5 + [pa.binary()], strict=True)], names)

    return files.select("path" if parts else "content").mapInArrow(read, "shard_first long, place long, doc_id long, local_start long, n_ids long, ids binary")


def round_trip(docs: DataFrame, path: str, end: int = 2) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of files written from ``docs`` and read back.

    A document's start is the number of ids of all shards before its own, from one row a shard, and its place there.
    """
    spark = docs.sparkSession
    target = new_path(spark, "token-ids")
    write_ids(docs, path, target, end)
    read = written(read_ids(spark, target).select("shard_first", "place", "doc_id", "local_start", "n_ids", F.crc32("ids").alias("ids_crc32")), "token-ids-read")
    shards = read.groupBy("shard_first").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy(F.col("shard_first").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1))
    # written, so that Spark broadcasts it by its known size only
    starts = written(shards.select(F.col("shard_first").alias("s_first"), F.coalesce(before, F.lit(0)).alias("before")), "token-ids-starts")
    return read.join(starts, F.col("shard_first").eqNullSafe(F.col("s_first"))).select(
        "doc_id", (F.col("before") + F.col("local_start")).alias("start"), F.col("n_ids").alias("n_tokens"), "ids_crc32"
    )
