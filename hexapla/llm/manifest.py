"""Merkle manifest of a dataset: digests of rows, joined to one root for each group and one for all.

Every row is a leaf. The leaves of a group ascend by key; their ranks, written in base ``fanout``, are the paths of a trie,
and a node's digest is that of its children's, so that a proof is as long as the trie is deep. Three steps:

- Ranks without a sort of all keys. The key's hexadecimal digits are counted from the top: a histogram by the first digits,
  then, only within buckets that hold more than ``MOST`` rows, by three digits more, and so on. A bucket's first rank is the
  sum of what stands before it among its siblings at each level, of which there are at most 4,096; rows are sorted within
  buckets only. Equal rows are counted before.
- The trie, longest prefix first: the nodes that share all but the last ``levels`` digits of their path are reduced by one
  task to the digest of that shorter path, then these by the next ``levels`` digits. The groups' roots are leaves of one more
  trie, in the order of the groups.
- Proofs from the top down: each block of nodes gets the siblings on its way to the root, and hands them on to its members.

Defined cases: every null, of the key too, is the value ``-``. Rows without key come first, ordered by their digests; so are
rows with equal keys. Equal rows are leaves of their own, each with its own proof. Null is a group like others, and the
first. A group of one leaf has that leaf as its root. Texts are hashed whole. An empty table has no rows and the root None.
Columns that are not named as fields are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexapla.llm.common import written

#: Rows that may be sorted by one task, and hexadecimal digits taken at a time.
MOST, DIGITS = 20_000, 3
#: Nodes that one task reduces at a time, at most, where the fanout allows.
BLOCK = 1024
#: The fields of a document, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: bytes) -> bytes:
    """Lower-case hexadecimal SHA-256."""
    return hashlib.sha256(text).hexdigest().encode()


def leaf_digest(*fields: Column) -> Column:
    """The digest of a row: each field's UTF-8 length, a colon and its value, or ``-`` for null, all put together."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]).cast("binary"), 256)


def numbered_groups(sizes: DataFrame) -> DataFrame:
    """``sizes`` (grp, n) with the number ``g`` of each group, from 0, null first and by bytes else. Groups are put in ranges;
    only the ranges' sizes are summed in one place."""
    dealt = written(sizes.repartitionByRange(F.col("grp").asc_nulls_first()).withColumn("part", F.spark_partition_id()), "manifest-groups")
    before = dealt.groupBy(F.col("part").alias("b_part")).agg(F.count("*").alias("here"))
    before = before.select("b_part", (F.sum("here").over(Window.orderBy("b_part")) - F.col("here")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("grp").asc_nulls_first())) - 1
    return dealt.withColumn("place", place).join(before, F.col("part") == F.col("b_part")).select("grp", "n", (F.col("before") + F.col("place")).alias("g"))


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (g, key, n, and others) with the rank of the first of their n copies among the rows of their group, from 0, by
    ``key``, a string of hexadecimal digits behind one mark. Rows with equal g and key must have been counted before."""
    ends = rows.filter("key >= '1'").agg(F.min("key"), F.max("key")).first()
    same = 0
    if ends[0] is not None:
        same = next((i for i, (a, b) in enumerate(zip(*ends, strict=True)) if a != b), len(ends[0]))
    out, left, depth = None, rows.withColumns({"parent": F.lit(""), "first": F.lit(0).cast("long")}), max(1, same) + DIGITS
    while True:
        prefix = F.substring("key", 1, depth)
        counts = left.groupBy("g", "parent", "first", prefix.alias("prefix")).agg(F.sum("n").alias("size"), F.count("*").alias("keys"))
        before = F.sum("size").over(Window.partitionBy("g", "parent").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1))
        heads = counts.select(F.col("g").alias("h_g"), "prefix", (F.col("first") + F.coalesce(before, F.lit(0))).alias("first"), (F.col("keys") > MOST).alias("heavy"))
        heads = written(heads, "manifest-digits")
        joined = left.drop("parent", "first").join(heads, (F.col("g") == F.col("h_g")) & (prefix == F.col("prefix"))).drop("h_g")
        before = F.sum("n").over(Window.partitionBy("g", "prefix").orderBy("key").rowsBetween(Window.unboundedPreceding, -1))
        done = joined.filter("not heavy").withColumn("rank", F.col("first") + F.coalesce(before, F.lit(0))).drop("prefix", "first", "heavy")
        out = done if out is None else out.unionByName(done)
        if heads.filter("heavy").isEmpty():
            return out
        left = joined.filter("heavy").drop("heavy").withColumnRenamed("prefix", "parent")
        depth += DIGITS


def _levels(digests: list[bytes], fanout: int, levels: int) -> list[list[bytes]]:
    """The digests of a block of nodes, and of the nodes above them, level by level."""
    out = [digests]
    for _ in range(levels):
        now = out[-1]
        out.append([digest(b"".join(now[i : i + fanout])) for i in range(0, len(now), fanout)])
    return out


def _paths(found: list[list[bytes]], fanout: int) -> list[list[bytes]]:
    """For each of a block's nodes what stands left and right of its path, level by level."""
    out = []
    for i in range(len(found[0])):
        path, at = [], i
        for now in found[:-1]:
            run = at - at % fanout
            path += [b"".join(now[run:at]), b"".join(now[at + 1 : run + fanout])]
            at //= fanout
        out.append(path)
    return out


def _height(n: Column, fanout: int) -> Column:
    """The least h with fanout**h >= n."""
    powers = []
    while not powers or powers[-1] < 1 << 62:
        powers.append(fanout ** len(powers))
    return F.aggregate(F.array(*[F.when(n > F.lit(p), 1).otherwise(0) for p in powers[:-1]]), F.lit(0), lambda a, x: a + x)


@dataclass(frozen=True)
class Trie:
    """Written nodes: ``levels[p]`` has (g, height, index, digest) of the nodes p * step levels above the leaves."""

    levels: list[DataFrame]
    fanout: int
    step: int

    @property
    def roots(self) -> DataFrame:
        """(g, digest), one row for each group."""
        return self.levels[-1].select("g", "digest")

    def steps(self, p: int) -> Column:
        """How many levels the nodes of ``levels[p]`` are reduced by at a time."""
        return F.least(F.greatest(F.col("height") - p * self.step, F.lit(0)), F.lit(self.step))


def build(leaves: DataFrame, fanout: int) -> Trie:
    """The trie over written ``leaves`` (g, height, index, digest)."""
    step = 1
    while fanout ** (step + 1) <= BLOCK:
        step += 1
    wide, trie = fanout**step, Trie([leaves], fanout, step)
    for p in range(-(-(leaves.agg(F.max("height")).first()[0] or 0) // step)):

        def reduce(key, t):
            t = t.sort_by("index")
            top = _levels([d.encode() for d in t["digest"].to_pylist()], fanout, t["steps"][0].as_py())[-1]
            return pa.table({"g": t["g"][:1], "height": t["height"][:1], "index": pa.array([key[1].as_py()]), "digest": [x.decode() for x in top]})

        blocks = trie.levels[-1].select("g", "height", "index", "digest", trie.steps(p).alias("steps")).groupBy("g", F.expr(f"index div {wide}").alias("block"))
        trie.levels.append(written(blocks.applyInArrow(reduce, "g long, height int, index long, digest string"), "manifest-nodes"))
    return trie


_PATH = "g long, index long, path array<binary>"


def paths(trie: Trie, above: DataFrame | None, down_to: int = 0) -> DataFrame:
    """(g, index, path) of the nodes of ``levels[down_to]``: the digests left and right of each on its way up, level by level.
    ``above`` has the further paths of the roots, where they are leaves of another trie."""
    if above is None:
        above = trie.roots.select("g", F.lit(0).cast("long").alias("index"), F.array().cast("array<binary>").alias("path"))
    fanout = trie.fanout
    for p in range(len(trie.levels) - 2, down_to - 1, -1):

        def hand_on(t, a):
            t = t.sort_by("index")
            rest = a["path"][0].as_py()
            found = _paths(_levels([d.encode() for d in t["digest"].to_pylist()], fanout, t["steps"][0].as_py()), fanout)
            return pa.table({"g": t["g"], "index": t["index"], "path": pa.array([x + rest for x in found], pa.list_(pa.binary()))})

        above = written(_with_paths(trie, p, trie.levels[p], above).applyInArrow(hand_on, _PATH), "manifest-paths")
    return above


def _with_paths(trie: Trie, p: int, nodes: DataFrame, above: DataFrame):
    """Blocks of ``nodes`` of ``levels[p]``, each together with the path of its own node, one level of the list up."""
    block = F.expr(f"index div {trie.fanout**trie.step}").alias("block") if p < len(trie.levels) - 1 else F.col("index").alias("block")
    return nodes.withColumn("steps", trie.steps(p)).groupBy("g", block).cogroup(above.groupBy("g", F.col("index").alias("block")))


def audited(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", key: str = "doc_id", fanout: int = 2, altered: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """Each row's leaf, its group's root, the root of all, the digest of its proof, and what its proof gives for the row as it
    is found now: (``key``, leaf, subroot, root, proof_sha256, folded_root, verified).

    ``altered`` has other values of fields for the rows ``where`` holds, as a copy of the data might have them."""
    now = [(altered or {}).get(f, F.col(f)) for f in fields]
    other = F.when(where, leaf_digest(*now)) if altered and where is not None else F.lit(None).cast("string")
    rows = docs.select(F.col(group).alias("grp"), F.col(key).alias("id"), leaf_digest(*[F.col(f) for f in fields]).alias("leaf"), other.alias("found"))
    rows = written(rows.groupBy("grp", "id", "leaf").agg(F.first("found").alias("found"), F.count("*").alias("n")), "manifest-leaves")
    number = F.coalesce(F.concat(F.lit("1"), F.lpad(F.hex(F.col("id").cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")), F.lit("0" * 17))
    groups = written(numbered_groups(rows.groupBy("grp").agg(F.sum("n").alias("n"))), "manifest-numbers")
    many = groups.count()
    heights = groups.select(F.col("grp").alias("h_grp"), "g", _height(F.col("n"), fanout).alias("height"))
    keyed = rows.join(heights, F.col("grp").eqNullSafe(F.col("h_grp"))).select("g", "height", F.concat(number, F.upper("leaf")).alias("key"), "id", "leaf", "found", "n")
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy")
    placed = ranked(keyed)
    leaves = written(placed.select("g", "height", "rank", "id", "leaf", "found", "n", copies).select("g", "height", (F.col("rank") + F.col("copy")).alias("index"), F.col("leaf").alias("digest"), "id", "found"), "manifest-ranks")
    trie = build(leaves, fanout)
    roots = written(trie.roots.select(F.lit(0).cast("long").alias("g"), _height(F.lit(many), fanout).alias("height"), F.col("g").alias("index"), "digest"), "manifest-roots")
    top = build(roots, fanout)
    root = top.roots.first()
    root = root[1] if root else None
    above = paths(top, None).select(F.col("index").alias("g"), F.lit(0).cast("long").alias("index"), "path")
    above = paths(trie, above, 1) if len(trie.levels) > 1 else above

    def prove(t, a):
        t = t.sort_by("index")
        rest = a["path"][0].as_py()
        digests = [d.encode() for d in t["digest"].to_pylist()]
        proofs, folded = [], []
        for own, found, path in zip(digests, t["found"].to_pylist(), _paths(_levels(digests, fanout, t["steps"][0].as_py()), fanout), strict=True):
            path += rest
            proofs.append(digest(b"".join(path)).decode())
            node = found.encode() if found else own
            for left, right in zip(path[::2], path[1::2], strict=True):
                node = digest(left + node + right)
            folded.append(node.decode())
        return pa.table({"g": t["g"], "id": t["id"], "leaf": t["digest"], "proof_sha256": proofs, "folded_root": folded})

    proved = _with_paths(trie, 0, trie.levels[0], above).applyInArrow(prove, f"g long, id {docs.schema[key].dataType.simpleString()}, leaf string, proof_sha256 string, folded_root string")
    own = trie.roots.select(F.col("g").alias("r_g"), F.col("digest").alias("subroot"))
    out = proved.join(own, F.col("g") == F.col("r_g"))
    return out.select(F.col("id").alias(key), "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof_sha256", "folded_root", F.coalesce(F.col("folded_root") == F.lit(root), F.lit(False)).alias("verified"))
