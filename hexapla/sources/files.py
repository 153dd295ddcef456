"""Files as rows: listings, keys from names, integrity and digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexapla.functions.text import extension, natural_key, path_number
from hexapla.functions.values import intact
from hexapla.operators.sequence import best_of


def files(spark: SparkSession, path: str, pattern: str = "*", content: bool = False) -> DataFrame:
    """(path, directory, name, stem, ext, size, modified[, content]) of all files below a path. Without ``content`` nothing is
    read of them."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    out = found.select(
        "path", F.regexp_extract("path", r"([^/]*)/[^/]*$", 1).alias("directory"), name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"),
        extension(F.regexp_extract(name, r"\.([^.]*)$", 1)).alias("ext"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), *(["content"] if content else []),
    )
    return out


def record_directories(listing: DataFrame) -> DataFrame:
    """(no, directory): the record numbers of directories named like ``012_34_a``."""
    return listing.select(path_number(F.concat(F.lit("_"), F.regexp_extract("directory", r"^\d+_(.*)$", 1))).alias("no"), "directory").filter("no <> ''").distinct()


def index_by_number(listing: DataFrame) -> DataFrame:
    """(number, path): for each number the first file by path whose stem ends in it."""
    numbered = listing.withColumn("number", F.regexp_extract("stem", r"(\d+(?:_[ab])?)$", 1)).filter("number <> ''")
    return best_of(numbered, ["number"], ["path"]).select("number", "path")


def name_candidates(numbers: DataFrame) -> DataFrame:
    """(number, candidate): the number as it is, and padded to three digits."""
    padded = F.when(F.length("number") < 3, F.lpad("number", 3, "0")).otherwise(F.col("number"))
    return numbers.select("number", F.explode(F.array_distinct(F.array("number", padded))).alias("candidate"))


def integrity(listing: DataFrame) -> DataFrame:
    """(path, strict, lenient): whether each file with content is what its extension says."""
    return listing.select("path", intact(F.col("content"), F.col("ext")).alias("i")).select("path", "i.strict", "i.lenient")


def checksums(listing: DataFrame) -> DataFrame:
    """(directory, manifest): the files of each directory with their digests, by name."""
    entry = F.struct(F.col("name").alias("file"), F.sha2("content", 256).alias("sha256"))
    return listing.groupBy("directory").agg(F.array_sort(F.collect_list(entry)).alias("manifest"))


def stale(listing: DataFrame, derived: DataFrame) -> DataFrame:
    """Files with no derived file of the same stem, or an older one."""
    d = derived.select(F.col("stem").alias("_stem"), F.col("modified").alias("_modified"))
    return listing.join(d, F.col("stem") == F.col("_stem"), "left").filter("_stem is null or _modified < modified").drop("_stem", "_modified")


def deletable(twins: DataFrame) -> DataFrame:
    """Candidates for deletion, (path, digest, twin_digest), of which the digests are equal; never others."""
    return twins.filter(F.col("digest").isNotNull() & (F.col("digest") == F.col("twin_digest")))


def texts_in_order(spark: SparkSession, path: str) -> DataFrame:
    """(name, text) of text files, numbers in names by value."""
    found = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]*)$", 1).alias("name"), F.col("value").alias("text"))
    return found.orderBy(natural_key(F.col("name")))
