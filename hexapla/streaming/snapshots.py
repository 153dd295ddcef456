"""Streams: an extension beyond what batch snapshots need.

``merge_stream`` applies the conditional upsert to every micro-batch; ``session_stream`` is the streaming form of gaps and
islands, with a watermark for late events.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hexapla.operators.merge import last_wins, upsert


def merge_stream(stream: DataFrame, target: str, checkpoint: str, key: str, order: str, kinds: dict[str, str], overwrite: tuple[str, ...] = (), schema=None) -> StreamingQuery:
    """Upsert a stream into snapshots under ``target``: batch n reads ``target/n-1`` and writes ``target/n``, so that a batch
    that is run again gives the same table."""

    def apply(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        fresh = last_wins(batch, [key], order)[0].select(*schema.fieldNames())
        before = spark.read.schema(schema).parquet(f"{target}/{n - 1}") if n else spark.createDataFrame([], schema)
        upsert(before, fresh, key, kinds, overwrite).write.mode("overwrite").parquet(f"{target}/{n}")

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def session_stream(stream: DataFrame, keys: list[str], at: str, gap: str, late: str) -> DataFrame:
    """(keys, begins, ends, n): sessions of events at most ``gap`` apart; events later than ``late`` are left out."""
    out = stream.withWatermark(at, late).groupBy(*keys, F.session_window(at, gap).alias("s")).agg(F.count("*").alias("n"))
    return out.select(*keys, F.col("s.start").alias("begins"), F.col("s.end").alias("ends"), "n")


def run_to_end(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Run a stream over what there is, giving each micro-batch to ``sink``."""
    stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
