"""Reconciliation of what is expected with what exists, and data-quality checks that are tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def presence(sets: dict[str, DataFrame], key: str) -> DataFrame:
    """(key, in_<name> ...): which of several sets has each key. One aggregation over the union of the key columns."""
    every = None
    for name, df in sets.items():
        one = df.select(F.col(key).alias(key), F.lit(name).alias("_set"))
        every = one if every is None else every.unionByName(one)
    return every.groupBy(key).agg(*[F.bool_or(F.col("_set") == n).alias(f"in_{n}") for n in sets])


def dangling(refs: DataFrame, ref: str, existing: DataFrame, key: str) -> DataFrame:
    """References, not null, to keys that don't exist."""
    return refs.filter(F.col(ref).isNotNull()).join(existing.select(F.col(key).alias("_k")).distinct(), F.col(ref) == F.col("_k"), "left_anti")


def match_state(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """(key, state) with state matched, missing or extra."""
    e, a = expected.select(F.col(key).alias("_e")).distinct(), actual.select(F.col(key).alias("_a")).distinct()
    state = F.when(F.col("_e").isNull(), "extra").when(F.col("_a").isNull(), "missing").otherwise("matched")
    return e.join(a, F.col("_e") == F.col("_a"), "full_outer").select(F.coalesce("_e", "_a").alias(key), state.alias("state"))


def scorecard(rows: DataFrame, group: str, present: str, good: str) -> DataFrame:
    """By group: expected, existing, complete, missing, corrupt, and the floor percentage of complete ones."""
    return rows.groupBy(group).agg(
        F.count("*").alias("expected"), F.count_if(present).alias("existing"), F.count_if(good).alias("complete"),
        F.count_if(~F.col(present)).alias("missing"), F.count_if(F.col(present) & ~F.col(good)).alias("corrupt"),
        F.expr(f"100 * count_if({good}) div greatest(count(*), 1)").alias("percent"),
    )


def status_text(expected: Column, there: Column, directory: Column | None = None) -> Column:
    """no_files, completed, failed, or partial(x/y); dir_missing where there should be files and ``directory`` is false."""
    missing = F.lit(False) if directory is None else ~F.coalesce(directory, F.lit(False))
    return (
        F.when(expected == 0, "no_files").when(missing, "dir_missing").when(there == expected, "completed").when(there == 0, "failed")
        .otherwise(F.concat(F.lit("partial("), there.cast("string"), F.lit("/"), expected.cast("string"), F.lit(")")))
    )


def status_rollup(items: DataFrame, parent: str, present: str, good: str) -> DataFrame:
    """(parent, expected, there, status, passed): ``passed`` is null unless something is there."""
    out = items.groupBy(parent).agg(F.count("*").alias("expected"), F.count_if(present).alias("there"), F.bool_and(F.col(present) & F.col(good)).alias("passed"))
    return out.select(parent, "expected", "there", status_text(F.col("expected"), F.col("there")).alias("status"), F.when(F.col("there") > 0, F.col("passed")).alias("passed"))


def missing_fields(fields: dict[str, Column]) -> Column:
    """The names of fields whose condition (blank) holds, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in fields.items()]))


def coverage(rows: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row: how many rows, and how many fulfil each condition."""
    return rows.agg(F.count("*").alias("total"), *[F.count_if(c).alias(n) for n, c in conditions.items()])


def distribution(rows: DataFrame, column: str) -> DataFrame:
    """(value, n)."""
    return rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def digest_duplicates(rows: DataFrame, key: str, content: Column) -> DataFrame:
    """(digest, copies, first, bytes): contents that occur more than once, and what the copies take."""
    d = rows.select(F.col(key).alias("_k"), F.md5(content).alias("digest"), F.octet_length(content).cast("long").alias("_n"))
    out = d.groupBy("digest").agg(F.count("*").alias("copies"), F.min("_k").alias("first"), F.max("_n").alias("_n")).filter("copies > 1")
    return out.select("digest", "copies", "first", ((F.col("copies") - 1) * F.col("_n")).alias("bytes"))


def count_against_declared(rows: DataFrame, declared: Column) -> DataFrame:
    """One row: what was declared, what is there, and whether they agree."""
    return rows.agg(F.max(declared).cast("long").alias("declared"), F.count("*").alias("there")).withColumn("agrees", F.col("declared") == F.col("there"))
