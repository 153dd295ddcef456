"""The Merkle manifest against a plain version: all cases, several fanouts, many levels of digits and of nodes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from hexapla.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g long, key string, height int"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves, fanout):
    """The root, and each leaf's runs on the way to it: (digests before, digests after)."""
    levels, paths = [leaves], []
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([digest("".join(now[i : i + fanout])) for i in range(0, len(now), fanout)])
    for i in range(len(leaves)):
        path = []
        for now in levels[:-1]:
            a = i - i % fanout
            path.append(("".join(now[a:i]), "".join(now[i + 1 : a + fanout])))
            i //= fanout
        paths.append(path)
    return levels[-1][0] if leaves else None, paths


def brute(rows, fanout):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    out, found = [], {}
    for name in names:
        group = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        found[name] = (group, *tree([leaf(r) for r in group], fanout))
    root, tops = tree([found[n][1] for n in names], fanout)
    for name, top in zip(names, tops, strict=True):
        group, subroot, paths = found[name]
        for r, path in zip(group, paths, strict=True):
            path = path + top
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            node = leaf((*r[:3], r[3] + 1, r[4])) if changed else leaf(r)
            for a, b in path:
                node = digest(a + node + b)
            out.append((r[0], leaf(r), subroot, root, digest("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=str)


def audited(docs, fanout):
    altered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    got = manifest.audited(docs, fanout=fanout, altered={"n_chars": F.col("n_chars") + 1}, where=altered)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize(("fanout", "most", "block"), [(2, 20_000, 1024), (3, 2, 9), (16, 5, 4), (2, 1, 2)])
def test_manifest(spark, monkeypatch, fanout, most, block):
    monkeypatch.setattr(manifest, "MOST", most)
    monkeypatch.setattr(manifest, "BLOCK", block)
    r = random.Random(fanout)
    ids = [*range(-3, 40), None, None, 5, 5, -(1 << 63), (1 << 63) - 1, *[r.randint(-(1 << 62), 1 << 62) for _ in range(20)]]
    rows = [(i, r.choice(["web", None, "a:b"]), r.choice(["en", "de", None, "", "é", "~"]), r.choice([None, r.randint(0, 99)]), r.choice([None, "", "1:x", "ünïcode\n", "x" * 200_000])) for i in ids]
    rows += [rows[0], rows[0], rows[7], (99, "only", "alone", 1, "x")]  # equal rows, and a group of one
    docs = spark.createDataFrame([(*x, 1, "k", 2) for x in rows], SCHEMA).repartition(3)
    assert audited(docs, fanout) == brute(rows, fanout)


def test_one_group_and_none(spark):
    rows = [(i, None, "en", i, "t") for i in range(5)]
    assert audited(spark.createDataFrame([(*x, 1, "k", 2) for x in rows], SCHEMA), 2) == brute(rows, 2)
    one = [(None, None, None, None, None)]
    assert audited(spark.createDataFrame([(*x, None, None, None) for x in one], SCHEMA), 2) == brute(one, 2)
    assert audited(spark.createDataFrame([], SCHEMA), 2) == []


def test_tampering_is_found(spark):
    docs = spark.createDataFrame([(i, "s", "en", i, f"text {i}") for i in range(50)], "doc_id long, source string, lang string, n_chars long, text string")
    got = manifest.audited(docs, altered={"text": F.concat("text", F.lit("."))}, where=F.col("doc_id").isin(3, 17))
    assert {r.doc_id for r in got.filter("not verified").collect()} == {3, 17}
    assert manifest.audited(docs).filter("verified").count() == 50
