"""Compound files, the container of old office documents: named streams in chains of sectors. Read and written by the published
format: a header, an allocation table that links sectors, another for small streams, and a directory."""

from __future__ import annotations

import struct

# The signature, marks of a chain's end, of the table's own and of free sectors, and the kinds of entries.
MAGIC = bytes.fromhex("d0cf11e0a1b11ae1")
END, TABLE, FREE, NONE = 0xFFFFFFFE, 0xFFFFFFFD, 0xFFFFFFFF, 0xFFFFFFFF
STORAGE_, STREAM, ROOT = 1, 2, 5
SECTOR, SMALL, CUTOFF = 512, 64, 4096


def _chain(table: list[int], start: int) -> list[int]:
    """The sectors from ``start`` on; an error if they run in a circle or out of the table."""
    out, seen = [], set()
    while start != END:
        if start >= len(table) or start in seen:
            raise ValueError("a chain of sectors runs in a circle" if start in seen else "a chain of sectors is broken")
        seen.add(start)
        out.append(start)
        start = table[start]
    return out


def _numbers(data: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(data) // 4}I", data[: len(data) // 4 * 4]))


class Compound:
    """A compound file's directory and streams."""

    def __init__(self, data: bytes):
        if len(data) < SECTOR or data[:8] != MAGIC:
            raise ValueError("not a compound file")
        shift, small_shift = struct.unpack_from("<HH", data, 30)
        if shift not in (9, 12) or small_shift > shift:
            raise ValueError("unknown size of sectors")
        self.data, self.size, self.small = data, 1 << shift, 1 << small_shift
        first, self.cutoff, small_first, _, more, _ = struct.unpack_from("<I4xIIIII", data, 48)
        listed = _numbers(data[76:SECTOR])
        seen = set()
        while more not in (END, FREE):
            if more in seen:
                raise ValueError("a chain of sectors runs in a circle")
            seen.add(more)
            *rest, more = _numbers(self._sector(more))
            listed += rest
        self.table = [x for k in listed if k != FREE for x in _numbers(self._sector(k))]
        self.small_table = _numbers(self._read(small_first)) if small_first not in (END, FREE) else []
        entries = self._read(first)
        self.entries = [self._entry(entries[k : k + 128]) for k in range(0, len(entries) - 127, 128)]
        if not self.entries or self.entries[0][1] != ROOT:
            raise ValueError("no directory")
        self._held = None

    def _sector(self, k: int) -> bytes:
        at = (k + 1) * self.size
        if k > 0xFFFFFFFA or at >= len(self.data):
            raise ValueError("the file is cut off")
        return self.data[at : at + self.size]

    def _read(self, start: int) -> bytes:
        return b"".join(map(self._sector, _chain(self.table, start)))

    @staticmethod
    def _entry(raw: bytes) -> tuple[str, int, tuple[int, int, int], int, int]:
        """(name, kind, (left, right, child), start, size)."""
        n, kind = struct.unpack_from("<HB", raw, 64)
        start, size = struct.unpack_from("<II", raw, 116)
        return raw[: max(min(n, 64) - 2, 0)].decode("utf-16-le", "replace"), kind, struct.unpack_from("<III", raw, 68), start, size

    def names(self) -> dict[str, int]:
        """The entries at the top by name."""
        out, todo, seen = {}, [self.entries[0][2][2]], set()
        while todo:
            k = todo.pop()
            if k < len(self.entries) and k not in seen:
                seen.add(k)
                name, _, (left, right, _), _, _ = self.entries[k]
                out[name] = k
                todo += [left, right]
        return out

    def stream(self, name: str) -> bytes:
        """A stream's bytes. Small ones are in the sectors of the root's own stream."""
        k = self.names().get(name)
        if k is None or self.entries[k][1] != STREAM:
            raise ValueError(f"no stream {name}")
        _, _, _, start, size = self.entries[k]
        if size >= self.cutoff:
            got = self._read(start)
        elif size == 0:
            got = b""
        else:
            whole = self._read(self.entries[0][3])
            got = b"".join(whole[s * self.small : (s + 1) * self.small] for s in _chain(self.small_table, start))
        if len(got) < size:
            raise ValueError("the file is cut off")
        return got[:size]


def written(streams: dict[str, bytes], backward: bool = False) -> bytes:
    """A compound file of some streams, the sectors of each in order, or ``backward``, from its last to its first."""
    sectors: list[bytes] = []
    table: list[int] = []

    def put(data: bytes, size: int, into: list[bytes], links: list[int]) -> int:
        parts = [data[a : a + size].ljust(size, b"\0") for a in range(0, len(data), size)]
        if not parts:
            return END
        at = len(into)
        into += parts[::-1] if backward else parts
        links += [*([END] if backward else []), *([at + k for k in range(len(parts) - 1)] if backward else [at + k + 1 for k in range(len(parts) - 1)]), *([] if backward else [END])]
        return at + len(parts) - 1 if backward else at

    small: list[bytes] = []
    small_table: list[int] = []
    entries = []
    for name, data in streams.items():
        start = put(data, SECTOR, sectors, table) if len(data) >= CUTOFF else put(data, SMALL, small, small_table)
        entries.append((name, STREAM, start, len(data)))
    whole = b"".join(small)
    root = put(whole, SECTOR, sectors, table)
    small_first = put(struct.pack(f"<{len(small_table)}I", *small_table), SECTOR, sectors, table) if small_table else END
    raw = b""
    for k, (name, kind, start, size) in enumerate([("Root Entry", ROOT, root, len(whole)), *entries]):
        said = name.encode("utf-16-le")
        right = k + 1 if 0 < k < len(entries) else NONE
        raw += said.ljust(64, b"\0") + struct.pack("<HBB", len(said) + 2, kind, 1) + struct.pack("<III", NONE, right, 1 if k == 0 and entries else NONE) + bytes(36) + struct.pack("<IQ", start, size)
    first = put(raw, SECTOR, sectors, table)
    own = 1
    while own * SECTOR // 4 < len(table) + own:
        own += 1
    if own > 109:
        raise ValueError("too large for a table in the header")
    spots = range(len(sectors), len(sectors) + own)
    table += [TABLE] * own
    table += [FREE] * (own * SECTOR // 4 - len(table))
    head = MAGIC + bytes(16) + struct.pack("<HHHHH", 0x3E, 3, 0xFFFE, 9, 6) + bytes(6) + struct.pack("<IIIIIIIIII", 0, own, first, 0, CUTOFF, small_first, 1 if small_table else 0, END, 0, spots[0])
    head += struct.pack("<108I", *[*list(spots)[1:], *[FREE] * (109 - own)])
    return head + b"".join(sectors) + struct.pack(f"<{len(table)}I", *table)
