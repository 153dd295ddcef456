"""Word shingles of texts as sorted arrays of 64-bit hashes, a chunk of texts at a time."""

from __future__ import annotations

import numpy as np

WORDS = 5
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_TURN = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_tables: dict[str, np.ndarray] = {}


def powers(name: str, n: int) -> np.ndarray:
    """The first ``n`` powers, or more, of the base ("power") or of its inverse ("inverse")."""
    if len(_tables.get(name, ())) < n:
        _tables[name] = _powers(max(n, 1 << 20), _BASE if name == "power" else pow(_BASE, -1, 1 << 64))
    return _tables[name]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the lower-cased texts, and how many words each text has."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    data = np.frombuffer((b" ".join(texts) + b" ").translate(_FOLD), np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space])))
    starts, ends = edge[0::2], edge[1::2]
    if len(ends) < len(starts):
        ends = np.append(ends, len(data))
    n = len(data) + 1
    total = np.zeros(n, np.uint64)
    np.cumsum(_BYTE[data] * powers("power", n)[: n - 1], out=total[1:])
    words = (total[ends] - total[starts]) * powers("inverse", n)[starts]
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)])))
    return _mix(words + (ends - starts).astype(np.uint64)), counts


def shingle_sets(texts: list[bytes], size: int = WORDS) -> list[np.ndarray]:
    """The distinct shingles of each text, sorted: of ``size`` words, or of all words if there are fewer."""
    words, counts = word_hashes(texts)
    if len(words) >= size:
        hashes = sum((words[k : len(words) - size + 1 + k] * _TURN[k % 5] + np.uint64(k) for k in range(size)), np.uint64(0))
        hashes = _mix(hashes)
    out, at = [], 0
    for n in counts.tolist():
        if n >= size:
            out.append(np.unique(hashes[at : at + n - size + 1]))
        elif n:
            own = sum((words[at + k : at + k + 1] * _TURN[k % 5] for k in range(n)), np.array([n << 56], np.uint64))
            out.append(_mix(own))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out
