"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexapla.llm.common import releasing, written

#: So many edges at most are united in one task.
ONE_TASK = 1_000_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "k")
    return both.filter("b > a").join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    k = least.select(F.col("a").alias("k"), "m")
    moved = down.join(k, F.col("a") == F.col("k")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _by_one_task(edges: DataFrame) -> DataFrame:
    """(a, b): each node and the least node of its component, by union-find in a single task."""

    def unite(batches):
        above: dict[int, int] = {}

        def root(x):
            while above.setdefault(x, x) != x:
                above[x] = x = above.setdefault(above[x], above[x])
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(a), root(b)
                above[max(a, b)] = min(a, b)
        nodes = list(above)
        for at in range(0, len(nodes), 65536):
            part = [x for x in nodes[at : at + 65536] if root(x) != x]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], ["a", "b"])

    return edges.select("a", "b").coalesce(1).mapInArrow(releasing(unite), "a long, b long")


def components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(node, component): for each node of ``edges`` (a, b) the least node it can reach.

    ``edges`` should be a written table. Up to ``one_task`` edges, which take a bounded amount of memory, are united in one
    task. More are contracted until every node hangs on the least one of its component; each round is written, so that the
    lineage stays short. Nodes without an edge to another node are not in the result.
    """
    edges = edges.filter("a <> b")
    if edges.count() <= one_task:
        now = written(_by_one_task(edges), "components")
        roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
        return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
    now = written(_small_star(_large_star(edges)), "components")
    mark = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == mark or state[0] == 0:
            break
        mark = state
        now = written(_small_star(_large_star(now)), "components")
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
