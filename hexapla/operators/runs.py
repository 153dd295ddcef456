"""Incremental runs over items: which are to be done, done one by one with failures kept apart, and remembered in a log."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "key string, mark string, result string"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All that was ever logged; nothing where no run has been yet."""
    try:
        return spark.read.schema(LOG).parquet(path)
    except Exception as e:  # noqa: BLE001  Spark has no class of its own for a missing path
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], LOG)


def planned(items: DataFrame, log: DataFrame, explicit: list[str] | None = None, force: bool = False, limit: int | None = None) -> DataFrame:
    """The items (key, mark, ...) of a run, in the order of their numbers: those named explicitly, else all with ``force``, else
    those that the log doesn't have with their mark. ``limit`` takes the first so many of them."""
    if explicit:
        chosen = items.filter(F.col("key").isin(list(explicit)))
    else:
        same = (F.col("i.key") == F.col("l.key")) & F.col("i.mark").eqNullSafe(F.col("l.mark"))
        chosen = items if force else items.alias("i").join(log.alias("l"), same, "left_anti")
    return chosen.orderBy(F.coalesce(F.expr("try_cast(regexp_extract(key, '^[0-9]+', 0) as bigint)"), F.lit(1 << 62)), "key").limit(limit) if limit else chosen


def attempted(items: DataFrame, work: Callable[[dict], str]) -> DataFrame:
    """(key, mark, result, error) of each item; what ``work`` raises is that item's error, and the others go on."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for item in pdf.to_dict("records"):
                try:
                    out.append((item["key"], item["mark"], work(item), None))
                except Exception as e:  # noqa: BLE001  one item's failure is its own
                    out.append((item["key"], item["mark"], None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["key", "mark", "result", "error"])

    return items.mapInPandas(each, "key string, mark string, result string, error string")


def run(items: DataFrame, log_path: str, work: Callable[[dict], str], keep: Callable[[DataFrame], DataFrame], dry_run: bool = False, **plan) -> DataFrame:
    """(key, mark, result, error) of the items that this run tried (see ``planned``). What went well is appended to the log, so
    that the next run takes up what is left; with ``dry_run`` nothing is. A run that is cut off has logged nothing and is
    done anew. ``keep`` writes a table and reads it back, so that each item is worked on once."""
    tried = keep(attempted(planned(items, read_log(items.sparkSession, log_path), **plan), work))
    if not dry_run:
        tried.filter("error is null").select("key", "mark", "result").write.mode("append").parquet(log_path)
    return tried
