"""Substring dedup by words against a plain version."""

import hashlib
import random

import numpy as np
import pytest

from hexapla.llm import passages, queries

SF = "/root/testdata/sf0.001"
D = passages.DEPTH


def brute(rows):
    """(doc_id, kept, n_words, n_removed, n_spans) of each row."""
    words = [[w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in t or "").split(" ") if w] for _, t in rows]
    first = {}
    for (i, _), ws in zip(rows, words, strict=True):
        for a in range(len(ws) - D + 1):
            if i is not None:
                w = tuple(ws[a : a + D])
                first[w] = min(first.get(w, i), i)
    out = []
    for (i, _), ws in zip(rows, words, strict=True):
        gone = [False] * len(ws)
        for a in range(len(ws) - D + 1):
            if i is not None and first[tuple(ws[a : a + D])] < i:
                gone[a : a + D] = [True] * D
        kept = " ".join(w for w, g in zip(ws, gone, strict=True) if not g)
        out.append((i, kept, len(ws), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))))
    return sorted(out, key=str)


def run(docs, **more):
    return sorted(((r.doc_id, r.kept.decode(), r.n_words, r.n_removed, r.n_spans) for r in passages.deduplicated(docs, **more).collect()), key=str)


def cases():
    r = random.Random(4)
    prose = lambda n, v=3000: " ".join(f"w{r.randint(0, v)}" for _ in range(n))
    shared, long, banner = prose(80), prose(30_000), prose(60)
    rows = [(1, shared), (2, prose(30) + " " + shared + "\n\n" + prose(20)), (3, shared.upper()), (4, shared.replace(" ", " \t\n ")), (5, None), (6, ""), (7, " \n"), (8, prose(49)), (8, prose(60))]
    rows += [(9, long), (10, long), (11, "x " + long + " y"), (0, long[len(long) // 3 : len(long) // 2]), (None, shared), (None, long), (12, "a b " * 100), (13, "a b " * 60), (14, "a b " * 24 + "c"), (-5, "a b " * 30)]
    rows += [(15, " ".join(shared.split()[:50])), (16, " ".join(shared.split()[10:59])), (17, " ".join(shared.split()[-50:]) + " " + " ".join(shared.split()[:50])), (17, shared)]
    # a banner that all have, at different places, between words that none has twice
    rows += [(100 + k, prose(k % 7, 10**9) + " " + banner + " " + prose(k % 11, 10**9)) for k in range(60)]
    rows += [(200 + k, t) for k, (_, t) in enumerate(r.sample(rows, 20))]
    # near copies: every twentieth word changed
    rows += [(300 + k, " ".join(w if r.random() < 0.97 else "new" for w in shared.split() * 2)) for k in range(30)]
    return rows


@pytest.mark.parametrize("hot", [10_000, 5, 0])
def test_all_cases(spark, hot):
    """Hot anchors' windows one by one, or none, give the same."""
    rows = cases()
    docs = spark.createDataFrame([(i, t, 1, b"m", "c") for i, t in rows], "doc_id long, text string, spans int, mark binary, codes string").repartition(5)
    assert run(docs, hot=hot) == brute(rows)


def test_empty_table(spark):
    assert passages.deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_several_indexes(monkeypatch):
    """An anchor's segments in several indexes, and several anchors in one."""
    monkeypatch.setattr(passages, "MOST_SEGMENTS", 7)
    r = random.Random(1)
    base = [f"w{r.randint(0, 9)}" for _ in range(70)]
    strings = list({" ".join(base[:k] + ["x"] * (r.random() < 0.3) + base[k : 52 + k % 9]) for k in range(20) for _ in range(3)})
    anchors = np.array([r.choice([3, 3, 3, 5, 6]) for _ in strings], np.uint64)
    owners = np.array([r.randint(0, 30) for _ in strings])
    want = []
    for s, a in zip(strings, anchors, strict=True):
        ws = s.split(" ")
        for k in range(len(ws) - D + 1):
            w = f" {' '.join(ws[k : k + D])} "
            want.append(min(o for t, b, o in zip(strings, anchors, owners, strict=True) if a == b and w in f" {t} "))
    assert {5, 6} < set(anchors.tolist())
    # other anchors never share windows in use; here they may, so that only lower owners could come in
    data = [s.encode() for s in strings]
    got = passages.least_owners(data, anchors, owners).tolist()
    assert all(g <= w for g, w in zip(got, want, strict=True)) and len(got) == len(want)
    same = passages.least_owners(data, np.full(len(strings), 9, np.uint64), owners).tolist()
    want = [min(o for t, o in zip(strings, owners, strict=True) if f" {' '.join(s.split(' ')[k : k + D])} " in f" {t} ") for s in strings for k in range(len(s.split(" ")) - D + 1)]
    assert same == want


def test_query_on_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, kept, n, gone, _ in brute(rows)}
    got = {tuple(r) for r in queries.op11_passages(spark, SF).collect()}
    assert got == want and sum(x[2] for x in got)
