"""Binary files decoded in tasks: the text records of slide decks, and the durations of recordings."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexapla.sources import compound

# Types of text records in a deck's stream (the text's role, UTF-16 text, Latin-1 text), and the role of a body.
ROLE, WIDE, NARROW = 0x0F9F, 0x0FA0, 0x0FA8
BODY = 5
# The name of the stream of records in a deck's compound file.
DECK = "PowerPoint Document"
# Bit rates (kbit/s) and sampling rates (Hz) of MPEG 1 and 2 layer III by their index in a frame's header.
_RATES = {1: (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320), 2: (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160)}
_HERTZ = {1: (44100, 48000, 32000), 2: (22050, 24000, 16000)}


def text_records(data: bytes) -> Iterator[tuple[int | None, str]]:
    """(role, text) of a deck's stream in order. A record is eight bytes of header, whose low four bits are all set if what
    follows are records, and its content. What a record's length doesn't fit into is passed over to its container's end."""
    role, ends, at = None, [len(data)], 0
    while ends:
        if at + 8 > ends[-1]:
            at = max(at, ends.pop()) if len(ends) == 1 else ends.pop()
            continue
        flags, kind, size = struct.unpack_from("<HHI", data, at)
        at += 8
        if at + size > ends[-1]:
            at = ends.pop()
        elif flags & 15 == 15:
            ends.append(at + size)
        else:
            if kind == ROLE:
                role = int.from_bytes(data[at : at + min(size, 4)], "little")
            elif kind in (WIDE, NARROW):
                yield role, data[at : at + size].decode("utf-16-le" if kind == WIDE else "latin-1", "replace")
            at += size


def decks(listing: DataFrame) -> DataFrame:
    """(path, stanza_no, text, error): the bodies of each deck, numbered from 1, of ``listing`` (path, content): decks as they lie
    on disk, compound files, or the streams of records taken out of them. One that can't be read gives one row with its
    ``error``, and the others go on."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    if content is None or len(content) < 8:
                        raise ValueError("not a stream of records")
                    content = bytes(content)
                    if content.startswith(compound.MAGIC):
                        content = compound.Compound(content).stream(DECK)
                    bodies = [t for role, t in text_records(content) if role == BODY and t.strip()]
                    if not bodies:
                        raise ValueError("no text in it")
                    out += [(path, k, t, None) for k, t in enumerate(bodies, 1)]
                except (ValueError, struct.error) as e:
                    out.append((path, None, None, str(e)))
            yield pd.DataFrame(out, columns=["path", "stanza_no", "text", "error"]).astype({"stanza_no": "Int32"})

    return listing.select("path", "content").mapInPandas(read, "path string, stanza_no int, text string, error string")


def _boxes(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    while at + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, at)
        head = 8
        if size == 1:
            size, head = struct.unpack_from(">Q", data, at + 8)[0], 16
        size = size or end - at
        if size < head or at + size > end:
            raise ValueError("a box is cut off")
        yield kind, at + head, at + size
        at += size


def mp4_seconds(data: bytes) -> float:
    """The duration in the movie header."""
    for kind, a, z in _boxes(data, 0, len(data)):
        if kind == b"moov":
            for inner, b, _ in _boxes(data, a, z):
                if inner == b"mvhd":
                    scale, length = struct.unpack_from(">IQ", data, b + 20) if data[b] == 1 else struct.unpack_from(">II", data, b + 12)
                    return length / scale
    raise ValueError("no movie header")


def mp3_seconds(data: bytes) -> float:
    """From the first frame: its count of frames if it has one, else its bit rate and the file's size."""
    at = 0
    if data[:3] == b"ID3" and len(data) > 10:
        at = 10 + sum((b & 127) << s for b, s in zip(data[6:10], (21, 14, 7, 0), strict=True))
    while at + 4 <= len(data):
        a, b, c = data[at], data[at + 1], data[at + 2]
        version = {3: 1, 2: 2}.get(b >> 3 & 3)
        rate, hertz = c >> 4, c >> 2 & 3
        if a == 0xFF and b >> 5 == 7 and version and b >> 1 & 3 == 1 and 0 < rate < 15 and hertz < 3:
            for tag in (b"Xing", b"Info"):
                spot = data.find(tag, at, at + 64)
                if spot >= 0 and data[spot + 7] & 1:
                    return struct.unpack_from(">I", data, spot + 8)[0] * (1152 if version == 1 else 576) / _HERTZ[version][hertz]
            return (len(data) - at) * 8 / (_RATES[version][rate - 1] * 1000)
        at += 1
    raise ValueError("no frame")


READERS = {"m4a": mp4_seconds, "mp4": mp4_seconds, "m4b": mp4_seconds, "mp3": mp3_seconds}


def durations(listing: DataFrame) -> DataFrame:
    """(path, seconds, reason) of recordings (path, ext, content): in thousandths, by the extension's reader; null with the
    reason where a file is missing, can't be read, or has no length."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, ext, content in zip(pdf["path"], pdf["ext"], pdf["content"], strict=True):
                seconds, reason = None, None
                try:
                    if content is None:
                        raise ValueError("no file")
                    if ext not in READERS:
                        raise ValueError(f"no reader for {ext}")
                    seconds = round(READERS[ext](bytes(content)), 3)
                    if seconds <= 0:
                        seconds, reason = None, "no length"
                except (ValueError, struct.error, ZeroDivisionError, IndexError) as e:
                    reason = str(e)
                out.append((path, seconds, reason))
            yield pd.DataFrame(out, columns=["path", "seconds", "reason"])

    return listing.select("path", "ext", "content").mapInPandas(read, "path string, seconds double, reason string")


def duration_maps(versions: DataFrame, read: DataFrame) -> DataFrame:
    """From (no, version, path) and ``durations``: (no, seconds, reasons), maps by version. Every real version has a key in
    ``seconds``, null where there is none, and then one in ``reasons``."""
    real = versions.filter((F.col("version") != "") & ~F.col("version").startswith("_"))
    joined = real.join(read, "path", "left").withColumn("reason", F.when(F.col("seconds").isNull(), F.coalesce("reason", F.lit("no file"))))
    entries = lambda v: F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col(v).isNotNull() | F.lit(v == "seconds"), F.struct("version", v)))))
    return joined.groupBy("no").agg(entries("seconds").alias("seconds"), entries("reason").alias("reasons"))
