"""What the operators of this subpackage share: written intermediate tables and small column helpers."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the contracts: runs of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a session with a local master, whose driver and executors are one process, may leave it unset (a test): a
    temporary folder is made and set.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="hexapla-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: whatever reads the result survives the loss of the executors that made it, and Spark knows
    the table's size, so that it broadcasts the table only where it fits ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """What is run within passes to Python in Arrow batches of about ``size`` bytes, one row at least; by default a batch is
    up to 64 MiB, which each task holds outside its executor's heap, twice while it grows."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def without(docs: DataFrame, ids: DataFrame, keep: bool = False) -> DataFrame:
    """The rows of ``docs`` whose doc_id, null as a value, is not in ``ids`` (or, with ``keep``, is), with their own
    columns, whatever their names."""
    on = F.col("own.doc_id").eqNullSafe(F.col("other.doc_id"))
    return docs.alias("own").join(ids.select("doc_id").distinct().alias("other"), on, "left_semi" if keep else "left_anti")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once: a lambda variable is bound, whereas a plain reference to a
    computed column inside a lambda is evaluated again for each element."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def give_back() -> None:
    """Return to the system what this process has freed. Arrow's pool and the C library keep it otherwise, and Spark keeps
    idle workers, so that it would count against whatever the executor does next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], forget: Callable[[], None] | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: ``run``, after whose end a task calls ``forget`` and returns its memory."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            if forget:
                forget()
            give_back()

    return whole
