"""Catalogue records: pages of JSON, reports, maps and their schemas. Nothing is inferred."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexapla.functions.text import url_name
from hexapla.operators.merge import last_wins

_NAMES = T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))
_KEYED = [T.StructField("id", T.LongType()), T.StructField("name", T.StringType())]
RECORD = T.StructType([
    T.StructField("no", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("lyrics", T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))), T.StructField("lyrics_chorus", T.StringType()),
    T.StructField("sheet_score_pdf_url", T.StringType()), T.StructField("num_score_pdf_url", T.StringType()),
    T.StructField("history", T.StringType()), T.StructField("updated_at", T.StringType()),
    T.StructField("lyricists", _NAMES), T.StructField("composers", _NAMES),
    T.StructField("category", T.StructType([*_KEYED, T.StructField("slug", T.StringType()), T.StructField("updated_at", T.StringType())])),
    T.StructField("tags", _NAMES),
    T.StructField("audio_files", T.ArrayType(T.StructType([T.StructField("file_url", T.StringType()), T.StructField("audio_category", T.StructType(_KEYED))]))),
])
PAGE = T.StructType([T.StructField("data", T.ArrayType(RECORD)), T.StructField("current_page", T.LongType()), T.StructField("last_page", T.LongType()), T.StructField("total", T.LongType())])


def pages(spark: SparkSession, path: str) -> DataFrame:
    """One row for each page file, with ``raw``; a malformed page, or one that is no object, has nulls."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("raw"))
    return raw.select("file", "raw", F.from_json("raw", PAGE, {"mode": "PERMISSIVE"}).alias("page")).select("file", "raw", "page.*")


def records(found: DataFrame) -> DataFrame:
    """The records of pages in order: ``seq`` from page and place. A page that is a bare list counts too; others are empty."""
    bare = F.from_json("raw", T.ArrayType(RECORD))
    data = F.coalesce("data", F.when(F.trim("raw").startswith("["), bare), F.array().cast(T.ArrayType(RECORD)))
    rows = found.select("current_page", F.posexplode(data).alias("place", "r"))
    return rows.select("current_page", "place", "r.*").filter(F.col("no").isNotNull() | F.col("name").isNotNull())


def total_check(found: DataFrame) -> DataFrame:
    """One row: the total that pages declare, the records there are, pages missing, and whether all agree."""
    there = F.sum(F.size(F.coalesce("data", F.array().cast(T.ArrayType(RECORD)))))
    out = found.agg(F.max("total").alias("declared"), F.coalesce(there, F.lit(0)).alias("there"), (F.max("last_page") - F.count_distinct("current_page")).alias("pages_missing"))
    return out.withColumn("agrees", (F.col("declared") == F.col("there")) & (F.col("pages_missing") == 0))


def first_pages(found: DataFrame, pages_: int, per_page: int = 10) -> DataFrame:
    """The records of the first pages, ``per_page`` each."""
    return records(found).orderBy("current_page", "place").limit(pages_ * per_page)


def url_map(spark: SparkSession, path: str) -> DataFrame:
    """(key, id, dirname, url) of files of lines ``id|dirname|url``: lines of fewer fields are dropped, the key is the URL's
    last part, and the last line of a key wins; of several files, the later one by name."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("line", "value"))
    lines = whole.select(F.struct("file", "line").alias("line"), F.split("value", r"\|").alias("f")).filter(F.size("f") >= 3)
    rows = lines.select("line", F.get("f", F.lit(0)).alias("id"), F.get("f", F.lit(1)).alias("dirname"), F.trim(F.get("f", F.lit(2))).alias("url"))
    return last_wins(rows.withColumn("key", url_name(F.col("url"))), ["key"], "line")[0].select("key", "id", "dirname", "url")


def append_lines(rows: DataFrame, columns: list[str], path: str) -> None:
    """Append rows as lines joined by ``|``."""
    rows.select(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("value")).write.mode("append").text(path)


def report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Entries of a JSON report, an array in one file; a missing or malformed one is empty."""
    try:
        raw = spark.read.text(path, wholetext=True)
    except Exception as e:  # noqa: BLE001  Spark has no class of its own for a missing path
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)
    return raw.select(F.explode(F.coalesce(F.from_json("value", T.ArrayType(schema)), F.array().cast(T.ArrayType(schema)))).alias("r")).select("r.*")


def _replace(spark: SparkSession, staged: str, path: str) -> None:
    """Put what was written at ``staged`` in place of ``path``, by renames of the store."""
    jvm = spark.sparkContext._jvm
    there, new, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, staged, f"{path}-replaced-{uuid.uuid4().hex}"))
    store = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    before = store.exists(there)
    if before and not store.rename(there, old):
        raise OSError(f"{path} can't be moved away")
    if not store.rename(new, there):
        if before:
            store.rename(old, there)
        raise OSError(f"{staged} can't be moved to {path}")
    if before:
        store.delete(old, True)


def write_report(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines. They are written beside the path and then put in its place, so that a failed write leaves what was
    there; ``rows`` may be read from the path itself."""
    staged = f"{path.rstrip('/')}-staged-{uuid.uuid4().hex}"
    rows.write.json(staged)
    _replace(rows.sparkSession, staged, path.rstrip("/"))


def rebuild_table(rows: DataFrame, path: str) -> int:
    """A table rebuilt as a whole: written aside, counted, and swapped in; how many rows it has."""
    staged = f"{path.rstrip('/')}-staged-{uuid.uuid4().hex}"
    rows.write.parquet(staged)
    n = rows.sparkSession.read.schema(rows.schema).parquet(staged).count()
    _replace(rows.sparkSession, staged, path.rstrip("/"))
    return n
