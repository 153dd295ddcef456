"""Burrows-Wheeler transform and common prefixes of a collection, built column by column.

Every round inserts one symbol of each document, from the last to the first: the suffixes of length j are put among the
shorter ones. Where they go follows from the symbols alone, and how much they have in common with their neighbours from
the least common prefix between the places of their tails. The transform, the common prefixes and the suffixes' owners
are files that each round reads once from front to back and writes anew. They lie in a folder of the cluster's shared
file system, one for each collection, that goes when the collection is done; a lost task leaves its folder behind and
begins another. Collections below ``IN_MEMORY``, and those on file systems that Arrow can't open, keep them in memory.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs

#: Files of the construction and the type of their records.
FILES = {"symbol": np.uint16, "prefix": np.uint8, "owner": np.int32, "length": np.uint8}
#: Collections of more bytes have their columns in files.
IN_MEMORY = 64 << 10
#: Documents may have so many bytes at most: lengths and common prefixes are files of single bytes.
MOST_BYTES = 255


def _range_minimum(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of values[low..high] for each pair, low <= high."""
    out = np.empty(len(low), values.dtype)
    width = np.frexp((high - low + 1).astype(np.float64))[1] - 1  # floor of the binary logarithm
    table = values
    for k in range(int(width.max(initial=0)) + 1):
        at = np.flatnonzero(width == k)
        out[at] = np.minimum(table[low[at]], table[high[at] - (1 << k) + 1])
        if len(table) > (1 << k):
            table = np.minimum(table[: -(1 << k)], table[1 << k :])
    return out


class Columns:
    """The columns of a collection: files in a folder of their own, or arrays where no folder is given."""

    def __init__(self, folder: str | None = None):
        self.held, self.names, self.system, self.path = {}, {}, None, None
        if folder:
            try:
                self.system, path = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", folder))
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
                return
            self.path = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
            self.system.create_dir(self.path, recursive=True)

    def write(self, **columns: np.ndarray) -> None:
        for name, values in columns.items():
            values = np.ascontiguousarray(values, FILES[name])
            if self.system is None:
                self.held[name] = values
            else:
                # a new file for each round, so that no store has to bring a file that is written over to its disks
                before, self.names[name] = self.names.get(name), f"{self.path}/{name}-{uuid.uuid4().hex}"
                with self.system.open_output_stream(self.names[name]) as out:
                    out.write(values.data.cast("B") if len(values) else b"")
                if before:
                    self.system.delete_file(before)

    def read(self) -> list[np.ndarray]:
        if self.system is None:
            return [self.held[name] for name in FILES]
        found = []
        for name, kind in FILES.items():
            with self.system.open_input_stream(self.names[name]) as file:
                found.append(np.frombuffer(file.read(), kind))
        return found

    def __enter__(self) -> Columns:
        return self

    def __exit__(self, *_) -> None:
        if self.system is not None:
            self.system.delete_dir(self.path)


def build(documents: list[bytes], folder: str | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, length, prefix): all suffixes of the documents in order, and what each has in common with the one before.

    The end of a document sorts before any byte, and equal suffixes sort by their documents' numbers. ``folder`` is where
    the files are put.
    """
    m = len(documents)
    sizes = np.fromiter(map(len, documents), np.int64, m)
    if m and sizes.max() > MOST_BYTES:
        raise ValueError("a document is too long")
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(documents), np.uint8).astype(np.uint16) + 1  # 0 is the end
    before = lambda doc, length: np.where(sizes[doc] > length, data[np.maximum(ends[doc] - length - 1, 0)] if len(data) else 0, 0).astype(np.uint16)
    with Columns(folder if len(data) > IN_MEMORY else None) as columns:
        first = np.arange(m)
        columns.write(symbol=before(first, np.zeros(m, np.int64)), prefix=np.zeros(m), owner=first, length=np.zeros(m))
        for j in range(1, int(sizes.max(initial=0)) + 1):
            symbol, prefix, owner, length = columns.read()
            order = np.argsort(symbol, kind="stable")
            order = order[len(symbol) - np.count_nonzero(symbol) :]  # without documents that have ended
            fresh = np.flatnonzero(length[order] == j - 1)  # ranks of the suffixes of length j
            tails = order[fresh]
            same_before = np.zeros(len(fresh), bool)
            same_before[fresh > 0] = symbol[order[fresh[fresh > 0] - 1]] == symbol[tails[fresh > 0]]
            own = np.zeros(len(fresh), np.uint8)
            k = np.flatnonzero(same_before)
            own[k] = np.minimum(_range_minimum(prefix, order[fresh[k] - 1] + 1, tails[k]), 254) + 1
            last = fresh + 1 < len(order)
            same_after = np.zeros(len(fresh), bool)
            same_after[last] = symbol[order[fresh[last] + 1]] == symbol[tails[last]]
            k = np.flatnonzero(same_after)
            after = np.minimum(_range_minimum(prefix, tails[k] + 1, order[fresh[k] + 1]), 254) + 1
            place = m + fresh
            n = len(symbol) + len(place)
            old = np.ones(n, bool)
            old[place] = False
            out = {name: np.empty(n, kind) for name, kind in FILES.items()}
            for name, values in zip(FILES, (symbol, prefix, owner, length), strict=True):
                out[name][old] = values
            who = owner[tails].astype(np.int64)
            out["owner"][place], out["length"][place], out["symbol"][place] = who, j, before(who, np.full(len(who), j))
            out["prefix"][place] = own
            out["prefix"][place[k] + 1] = after
            columns.write(**out)
        _, prefix, owner, length = columns.read()
    return owner, length, prefix


def least_by_prefix(documents: list[bytes], values: np.ndarray, depth: int, folder: str | None = None) -> list[np.ndarray]:
    """For each document and each place where ``depth`` bytes begin, the least value of a document with these bytes."""
    owner, length, prefix = build(documents, folder)
    long = np.flatnonzero(length >= depth)
    groups = np.cumsum(prefix >= depth, dtype=np.int64)  # equal prefixes follow each other: count the breaks
    groups = np.arange(len(prefix)) - groups
    _, group = np.unique(groups[long], return_inverse=True)
    least = np.full(group.max(initial=-1) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, values[owner[long]])
    sizes = np.fromiter((max(len(d) - depth + 1, 0) for d in documents), np.int64, len(documents))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(starts[-1], np.int64)
    place = starts[owner[long]] + (sizes[owner[long]] - 1 - (length[long].astype(np.int64) - depth))
    out[place] = least[group]
    return np.split(out, starts[1:-1]) if len(documents) else []
