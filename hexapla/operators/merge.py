"""Merging snapshots: upserts, replacement of children, updates from maps, migrations and snapshot diffs.

Keys must be unique on both sides where a docstring says so; ``last_wins`` makes them so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hexapla.functions.blank import keep_nonblank


def upsert(target: DataFrame, source: DataFrame, key: str, kinds: dict[str, str], overwrite: tuple[str, ...] = ()) -> DataFrame:
    """Rows of either table, one for each key (unique in both). A key that the target lacks is inserted with the source's
    values as they come, blank or not, in all columns that the source has. Where the target has the key, columns in
    ``kinds`` take the source's value unless it is blank for its kind, those in ``overwrite`` always do, and others keep
    the target's."""
    t, s = target.alias("t"), source.alias("s")
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    there, fresh = F.col(f"s.{key}").isNotNull(), F.col(f"t.{key}").isNull()
    out = [F.coalesce(F.col(f"s.{key}"), F.col(f"t.{key}")).alias(key)]
    for c in (c for c in target.columns if c != key):
        old = F.col(f"t.{c}")
        new = F.col(f"s.{c}") if c in source.columns else F.lit(None).cast(target.schema[c].dataType)
        if c in kinds:
            out.append(F.when(fresh, new).when(there, keep_nonblank(new, old, kinds[c])).otherwise(old).alias(c))
        elif c in overwrite:
            out.append(F.when(there, new).otherwise(old).alias(c))
        else:
            out.append(F.when(fresh, new).otherwise(old).alias(c))
    return joined.select(*out)


def replace_children(children: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """The children of parents that ``fresh`` doesn't have, and all of ``fresh``: no stale child of a rewritten parent."""
    return children.join(fresh.select(key).distinct(), key, "left_anti").unionByName(fresh)


def split_rejects(rows: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Accepted rows (no reason), and rejected ones with their ``reason``."""
    marked = rows.withColumn("reason", F.nullif(reason, F.lit("")))
    return marked.filter("reason is null").drop("reason"), marked.filter("reason is not null")


def update_from(target: DataFrame, values: DataFrame, key: str, columns: list[str], overwrite: bool = False) -> DataFrame:
    """``columns`` of the target from ``values`` (unique keys) where it has them; with ``overwrite`` its nulls count too."""
    found = values.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in columns])
    joined = target.join(found, F.col(key) == F.col("_k"), "left")
    take = lambda c: F.when(F.col("_k").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)) if overwrite else F.coalesce(f"_{c}", c)
    return joined.select(*[take(c).alias(c) if c in columns else F.col(c) for c in target.columns])


def backfill(target: DataFrame, source: DataFrame, key: str, column: str, kind: str = "text") -> DataFrame:
    """Fill ``column`` from the source only where the target's is blank."""
    found = source.select(F.col(key).alias("_k"), F.col(column).alias("_v"))
    joined = target.join(found, F.col(key) == F.col("_k"), "left")
    return joined.select(*[keep_nonblank(F.col(c), F.coalesce("_v", c), kind).alias(c) if c == column else F.col(c) for c in target.columns])


def delete_where(rows: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """What is left, and a one-row count of what was deleted."""
    gone = F.coalesce(condition, F.lit(False))
    return rows.filter(~gone), rows.agg(F.count_if(gone).alias("deleted"))


def last_wins(rows: DataFrame, keys: list[str], order: str) -> tuple[DataFrame, DataFrame]:
    """The row of greatest ``order`` for each key, and the rows it overwrote."""
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order))))
    return ranked.filter("_rank = 1").drop("_rank"), ranked.filter("_rank > 1").drop("_rank")


def migrate(rows: DataFrame, defaults: dict[str, Column], order: list[str]) -> DataFrame:
    """Add the columns that are missing with their defaults, and put all into ``order``; unknown columns are refused."""
    unknown = [c for c in rows.columns if c not in order]
    missing = [c for c in order if c not in rows.columns and c not in defaults]
    if unknown or missing:
        raise ValueError(f"unknown columns {unknown}, columns without default {missing}")
    return rows.select(*[F.col(c) if c in rows.columns else defaults[c].alias(c) for c in order])


def table_difference(one: DataFrame, two: DataFrame) -> DataFrame:
    """Rows that only one of two tables has, counting repeats, with ``side``; empty if the tables are equal."""
    two = two.select(*one.columns)
    return one.exceptAll(two).withColumn("side", F.lit("one")).unionByName(two.exceptAll(one).withColumn("side", F.lit("two")))


def changed(new: Column, old: Column) -> Column:
    """Incoming stamp not blank, and different; an older one counts too."""
    return F.coalesce(new != "", F.lit(False)) & ~new.eqNullSafe(old)


def snapshot_diff(source: DataFrame, target: DataFrame, key: str, stamp: str, payload: str | None = None) -> DataFrame:
    """(key, state) with state new, changed, same or site_only. A target without ``payload`` counts as changed."""
    s = source.select(F.col(key).alias("_s"), F.col(stamp).alias("_new"))
    t = target.select(F.col(key).alias("_t"), F.col(stamp).alias("_old"), (F.col(payload) if payload else F.lit("")).alias("_payload"))
    state = (
        F.when(F.col("_t").isNull(), "new")
        .when(F.col("_s").isNull(), "site_only")
        .when(changed(F.col("_new"), F.col("_old")) | F.col("_payload").isNull(), "changed")
        .otherwise("same")
    )
    return s.join(t, F.col("_s") == F.col("_t"), "full_outer").select(F.coalesce("_s", "_t").alias(key), state.alias("state"))


def apply_diff(target: DataFrame, source: DataFrame, diff: DataFrame, key: str, kinds: dict[str, str], overwrite: tuple[str, ...] = ()) -> DataFrame:
    """Upsert only what the diff calls new or changed."""
    wanted = diff.filter(F.col("state").isin("new", "changed")).select(key)
    return upsert(target, source.join(wanted, key, "left_semi"), key, kinds, overwrite)


def pending(available: DataFrame, done: DataFrame, key: str, mark: str) -> DataFrame:
    """Available rows that are not done, or were done with another ``mark`` (a path or a digest)."""
    d = done.select(F.col(key).alias("_k"), F.col(mark).alias("_m"))
    joined = available.join(d, F.col(key) == F.col("_k"), "left")
    return joined.filter(F.col("_k").isNull() | ~F.col("_m").eqNullSafe(F.col(mark))).drop("_k", "_m")


def only_changed(target: DataFrame, values: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of ``values`` that differ from the target's, null-safe, or whose key it lacks."""
    t = target.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in columns])
    joined = values.join(t, F.col(key) == F.col("_k"), "left")
    same = F.col("_k").isNotNull()
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return joined.filter(~same).select(*values.columns)


def selection(rows: DataFrame, key: str, tokens: list[str]) -> DataFrame:
    """Rows whose numeric ``key`` is named: single numbers and ranges ``a-b``, ends included."""
    condition = F.lit(False)
    for t in tokens:
        low, _, high = t.partition("-")
        condition = condition | F.col(key).between(int(low), int(high or low))
    return rows.filter(condition)
