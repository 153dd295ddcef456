"""Snapshots merged and compared. The second snapshot of a table is derived from its keys by fixed rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexapla.operators import merge
from hexapla.plans.registry import query
from hexapla.sources.tables import table


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(old, new) of customer: some keys are in one only, some values blank, some stamps different."""
    c = table(spark, sf_dir, "customer")
    old = c.filter("c_custkey % 11 <> 0").selectExpr("c_custkey", "c_name as name", "c_mktsegment as segment", "cast(c_nationkey as string) as stamp", "c_acctbal as balance", "if(c_custkey % 13 = 0, null, 'raw') as raw")
    new = c.filter("c_custkey % 7 <> 0").selectExpr(
        "c_custkey", "case when c_custkey % 5 = 0 then 'Unknown' when c_custkey % 5 = 1 then '' else concat(c_name, '+') end as name",
        "if(c_custkey % 3 = 0, null, lower(c_mktsegment)) as segment", "case when c_custkey % 4 = 0 then '' when c_custkey % 4 = 1 then 'new' else cast(c_nationkey as string) end as stamp",
        "if(c_custkey % 2 = 0, null, c_acctbal + 1) as balance", "'raw2' as raw",
    )
    return old, new


_SNAPSHOTS = """
    o AS (SELECT c_custkey, c_name AS name, c_mktsegment AS segment, c_nationkey::VARCHAR AS stamp, c_acctbal AS balance,
                 CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 'raw' END AS raw FROM customer WHERE c_custkey % 11 <> 0),
    n AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'Unknown' WHEN c_custkey % 5 = 1 THEN '' ELSE c_name || '+' END AS name,
                 CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE lower(c_mktsegment) END AS segment,
                 CASE WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 4 = 1 THEN 'new' ELSE c_nationkey::VARCHAR END AS stamp,
                 CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_acctbal + 1 END AS balance, 'raw2' AS raw FROM customer WHERE c_custkey % 7 <> 0)"""
_STATE = """CASE WHEN o.c_custkey IS NULL THEN 'new' WHEN n.c_custkey IS NULL THEN 'site_only'
            WHEN (n.stamp <> '' AND n.stamp IS DISTINCT FROM o.stamp) OR o.raw IS NULL THEN 'changed' ELSE 'same' END"""
_KINDS = {"name": "name", "segment": "text", "raw": "text"}


@query("snapshot_diff", f"WITH {_SNAPSHOTS} SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, {_STATE} AS state FROM o FULL JOIN n ON o.c_custkey = n.c_custkey")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New, changed, same and site-only keys."""
    old, new = _snapshots(spark, sf_dir)
    return merge.snapshot_diff(new, old, "c_custkey", "stamp", "raw")


_UPSERT = """coalesce(o.c_custkey, n.c_custkey) AS c_custkey,
    CASE WHEN o.c_custkey IS NULL THEN n.name WHEN n.name IS NULL OR n.name IN ('', 'Unknown') THEN o.name ELSE n.name END AS name,
    CASE WHEN o.c_custkey IS NULL THEN n.segment WHEN n.segment IS NULL OR n.segment = '' THEN o.segment ELSE n.segment END AS segment,
    CASE WHEN o.c_custkey IS NULL THEN n.stamp ELSE o.stamp END AS stamp, CASE WHEN n.c_custkey IS NULL THEN o.balance ELSE n.balance END AS balance,
    CASE WHEN o.c_custkey IS NULL THEN n.raw WHEN n.raw IS NULL OR n.raw = '' THEN o.raw ELSE n.raw END AS raw"""


@query("keep_nonblank_upsert", f"WITH {_SNAPSHOTS} SELECT {_UPSERT} FROM o FULL JOIN n ON o.c_custkey = n.c_custkey")
def keep_nonblank_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conditional upsert: blank incoming values keep the old ones, by each column's kind of blank; new keys are inserted as
    they come (K1, K4)."""
    old, new = _snapshots(spark, sf_dir)
    return merge.upsert(old, new, "c_custkey", _KINDS, ("balance",))


@query(
    "apply_diff",
    f"""WITH {_SNAPSHOTS}, w AS (SELECT n.* FROM n LEFT JOIN o ON o.c_custkey = n.c_custkey WHERE {_STATE} IN ('new', 'changed')),
        n2 AS (SELECT * FROM w) SELECT {_UPSERT.replace("n.", "n2.")} FROM o FULL JOIN n2 ON o.c_custkey = n2.c_custkey""",
)
def apply_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert of what the diff calls new or changed only."""
    old, new = _snapshots(spark, sf_dir)
    return merge.apply_diff(old, new, merge.snapshot_diff(new, old, "c_custkey", "stamp", "raw"), "c_custkey", _KINDS, ("balance",))


@query("watermark", "SELECT max(strftime(ts, '%Y-%m-%d %H:%M:%S')) AS watermark FROM events WHERE ts IS NOT NULL")
def watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The greatest stamp, as text."""
    return table(spark, sf_dir, "events").agg(F.max(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("watermark"))


@query(
    "pending_by_mark",
    """WITH a AS (SELECT conv_id, turn, role, md5(text) AS mark FROM conversations), f AS (SELECT conv_id, mark FROM a WHERE turn = 0), l AS (SELECT conv_id, mark FROM a WHERE turn = 1)
       SELECT f.conv_id, f.mark FROM f WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.conv_id = f.conv_id AND (l.mark = f.mark OR length(l.mark || f.mark) = 0))""",
)
def pending_by_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is not done, or was done from other content: first turns whose text is not that of the second."""
    every = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5("text").alias("mark"))
    return merge.pending(every.filter("turn = 0").drop("turn"), every.filter("turn = 1").drop("turn"), "conv_id", "mark")


@query(
    "replace_children",
    """SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_orderkey % 10 <> 0 OR l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 = 0)
       UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 10 = 0""",
)
def replace_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of rewritten orders replaced as a whole (K2)."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    fresh = table(spark, sf_dir, "orders").filter("o_orderkey % 10 = 0").selectExpr("o_orderkey as l_orderkey", "o_custkey as l_partkey", "o_totalprice as l_quantity")
    return merge.replace_children(lines, fresh, "l_orderkey")


@query(
    "update_from_map",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 AND r.k IS NOT NULL THEN 'returned' ELSE o_orderstatus END AS o_orderstatus
       FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R') r ON o_orderkey = k""",
)
def update_from_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column updated from a table of values; null values keep the old."""
    values = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey").distinct().selectExpr("l_orderkey as o_orderkey", "if(l_orderkey % 4 = 0, 'returned', null) as o_orderstatus")
    return merge.update_from(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), values, "o_orderkey", ["o_orderstatus"])


@query(
    "overwrite_from_map",
    """SELECT o_orderkey, CASE WHEN r.k IS NULL THEN o_orderstatus WHEN o_orderkey % 4 = 0 THEN 'returned' END AS o_orderstatus
       FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R') r ON o_orderkey = k""",
)
def overwrite_from_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with null values written too (K8, K9)."""
    values = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey").distinct().selectExpr("l_orderkey as o_orderkey", "if(l_orderkey % 4 = 0, 'returned', null) as o_orderstatus")
    return merge.update_from(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), values, "o_orderkey", ["o_orderstatus"], overwrite=True)


@query(
    "backfill_empty",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN CASE WHEN s_suppkey IS NULL THEN '' ELSE s_name END ELSE c_name END AS name
       FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""",
)
def backfill_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only blank values filled from a second source."""
    target = table(spark, sf_dir, "customer").selectExpr("c_custkey", "if(c_custkey % 3 = 0, '', c_name) as name")
    return merge.backfill(target, table(spark, sf_dir, "supplier").selectExpr("s_suppkey as c_custkey", "s_name as name"), "c_custkey", "name")


@query("delete_count", "SELECT count(*) FILTER (o_orderstatus = 'F') AS deleted FROM orders")
def delete_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a deletion takes (K5)."""
    return merge.delete_where(table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "F")[1]


@query("rejected_rows", "SELECT o_orderkey, CASE WHEN o_totalprice < 20000 THEN 'too cheap' ELSE 'failed' END AS reason FROM orders WHERE o_totalprice < 20000 OR o_orderstatus = 'F'")
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects with their reason."""
    reason = F.when(F.col("o_totalprice") < 20000, "too cheap").when(F.col("o_orderstatus") == "F", "failed")
    return merge.split_rejects(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), reason)[1].select("o_orderkey", "reason")


_LAST = "row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC)"


@query("last_wins_dedupe", f"SELECT user_id, event_type, event_id, value FROM (SELECT *, {_LAST} AS r FROM events) WHERE r = 1")
def last_wins_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user and type."""
    return merge.last_wins(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id")[0]


@query("duplicates_log", f"SELECT user_id, event_type, event_id FROM (SELECT *, {_LAST} AS r FROM events) WHERE r > 1")
def duplicates_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events that a later one overwrote."""
    return merge.last_wins(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], "event_id")[1]


@query("write_if_changed", "SELECT c_custkey, c_acctbal + CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS balance FROM customer WHERE c_custkey % 6 = 0 OR c_custkey % 9 = 0")
def write_if_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only rows whose payload differs from what is stored, or that are new."""
    c = table(spark, sf_dir, "customer")
    return merge.only_changed(c.filter("c_custkey % 9 <> 0").selectExpr("c_custkey", "c_acctbal as balance"), c.selectExpr("c_custkey", "c_acctbal + if(c_custkey % 6 = 0, 1, 0) as balance"), "c_custkey", ["balance"])


@query("migrated", """SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN 'failed' ELSE 'unchecked' END AS integrity_status,
    '{"' || lower(c_mktsegment) || '":"' || c_name || '"}' AS versions, 0 AS n FROM customer""")
def migrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns added by cases, as JSON and with defaults, in the canonical order."""
    status = F.when(F.col("c_acctbal") < 0, "failed").otherwise("unchecked")
    versions = F.to_json(F.create_map(F.lower("c_mktsegment"), "c_name"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", "c_name")
    added = rows.withColumns({"integrity_status": status, "versions": versions}).drop("c_acctbal", "c_name")
    return merge.migrate(added, {"n": F.lit(0)}, ["c_custkey", "c_mktsegment", "integrity_status", "versions", "n"])


@query("table_difference", "SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 0 THEN upper(n_name) || '!' ELSE n_name END AS n_name, 'two' AS side FROM nation WHERE n_nationkey % 5 = 0 UNION ALL SELECT n_nationkey, n_name, 'one' FROM nation WHERE n_nationkey % 5 = 0")
def table_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that one of two tables has."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return merge.table_difference(n, n.selectExpr("n_nationkey", "if(n_nationkey % 5 = 0, concat(upper(n_name), '!'), n_name) as n_name"))


@query("selected_range", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey BETWEEN 10 AND 40 OR o_orderkey = 77")
def selected_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows named by numbers and ranges."""
    return merge.selection(table(spark, sf_dir, "orders"), "o_orderkey", ["10-40", "77"]).select("o_orderkey", "o_totalprice")


@query(
    "parent_with_children",
    """SELECT o_orderkey, o_orderstatus, count(l_orderkey) AS n_lines, coalesce(string_agg(l_partkey::VARCHAR, ',' ORDER BY l_partkey), '') AS parts
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2""",
)
def parent_with_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parents with their children in order."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list("l_partkey")), lambda x: x.cast("string")), ",").alias("p"))
    joined = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select("o_orderkey", "o_orderstatus", F.coalesce("n", F.lit(0)).alias("n_lines"), F.coalesce("p", F.lit("")).alias("parts"))


@query("score_rollups", "SELECT l_orderkey, sum(l_quantity) AS quantity, count(*) FILTER (l_returnflag = 'R') AS returned, min(l_discount) AS least_discount, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1")
def score_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums, counts and minima by parent."""
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity"), F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.min("l_discount").alias("least_discount"), F.count_distinct("l_suppkey").alias("suppliers"))


@query("reference_checks", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def reference_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates that several sources refer to."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    nations = table(spark, sf_dir, "nation").filter("n_regionkey = 1")
    return c.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi").join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("c_custkey")


