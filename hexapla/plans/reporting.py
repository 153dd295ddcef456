"""Reports and renderings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hexapla.operators import reports
from hexapla.plans.registry import query
from hexapla.sources.scratch import kept
from hexapla.sources.tables import table


@query(
    "text_report",
    """SELECT 'statuses' AS section, row_number() OVER (ORDER BY n DESC, s) AS ordinal, s || ': ' || n AS text FROM (SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1)
       UNION ALL SELECT 'dearest', row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey), o_orderkey::VARCHAR FROM (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)
       UNION ALL SELECT 'all', row_number() OVER (ORDER BY o_custkey, o_orderkey), o_orderkey || ' ' || o_orderstatus FROM orders""",
)
def text_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of three sections as a table."""
    o = table(spark, sf_dir, "orders")
    counts = o.groupBy("o_orderstatus").agg(F.count("*").alias("n")).withColumn("least", -F.col("n"))
    dear = o.withColumn("least", -F.col("o_totalprice"))
    return reports.text_report({
        "statuses": (counts, F.concat_ws(": ", "o_orderstatus", "n"), ["least", "o_orderstatus"], None),
        "dearest": (dear, F.col("o_orderkey").cast("string"), ["least", "o_orderkey"], 5),
        "all": (o, F.concat_ws(" ", "o_orderkey", "o_orderstatus"), ["o_custkey", "o_orderkey"], None),
    }, keep=kept)


@query("map_lines", "SELECT c_custkey || '|' || c_name || '|' || c_mktsegment AS text FROM customer")
def map_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a rebuilt map file."""
    return reports.map_lines(table(spark, sf_dir, "customer"), ["c_custkey", "c_name", "c_mktsegment"])


@query("symbol_strings", "SELECT conv_id, string_agg(upper(role[1]), '' ORDER BY turn) AS symbols, coalesce(string_agg(upper(role[1]), '' ORDER BY turn) FILTER (role <> 'system'), '') AS plain FROM conversations GROUP BY 1")
def symbol_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line's symbols, and without holds."""
    marked = table(spark, sf_dir, "conversations").withColumn("s", F.upper(F.substring("role", 1, 1)))
    return reports.symbol_string(marked, ["conv_id"], "turn", "s", F.col("role") == "system")


@query("split_codes", "SELECT p_partkey, unnest(range(0, len(w)))::INT AS pos, unnest(w) AS code FROM (SELECT p_partkey, list_filter(string_split(p_type || ' ' || p_name, ' '), lambda x: x <> '') AS w FROM part)")
def split_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of codes as rows."""
    return reports.split_codes(table(spark, sf_dir, "part").withColumn("c", F.concat_ws(" ", "p_type", "p_name")), ["p_partkey"], "c")


@query("resolved_paths", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '/abs/' || doc_id || '.pdf' ELSE '/root/d/' || doc_id || '.pdf' END AS full_path, CASE WHEN doc_id % 2 = 0 THEN '/abs/' || doc_id || '.pdf' ELSE 'd/' || doc_id || '.pdf' END AS short_path, CASE WHEN doc_id % 2 = 0 THEN '/abs/' ELSE '/root/d/' END || doc_id || '.png' AS image FROM documents")
def resolved_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths below a root, relative again, and their images."""
    p = F.expr("if(doc_id % 2 = 0, concat('/abs/', doc_id, '.pdf'), concat('./d/', doc_id, '.pdf'))")
    full = reports.resolve_path(p, "/root/")
    return table(spark, sf_dir, "documents").select("doc_id", full.alias("full_path"), reports.relative_path(full, "/root").alias("short_path"), reports.sibling(full, "png").alias("image"))


@query(
    "score_report",
    """WITH e AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS i, l_quantity::INT % 8 AS d FROM lineitem),
       n AS (SELECT k, i, repeat(d::VARCHAR, 1 + d % 3) AS s, CASE d % 4 WHEN 0 THEN '詩' WHEN 1 THEN 'la' WHEN 2 THEN '愛歌' END AS one, CASE WHEN d > 5 THEN 'sing' END AS two FROM e),
       w AS (SELECT k, count(*) AS n, greatest(2, max(length(s)), max(CASE WHEN one = '詩' THEN 2 WHEN one = '愛歌' THEN 4 ELSE coalesce(length(one), 0) END), max(coalesce(length(two), 0))) AS width FROM n GROUP BY k),
       p AS (SELECT k, i, 0 AS part, s, length(s) AS cols FROM n UNION ALL SELECT k, i, 1, one, CASE WHEN one = 'la' THEN 2 ELSE 2 * length(one) END FROM n WHERE one IS NOT NULL UNION ALL SELECT k, i, 2, two, 4 FROM n WHERE two IS NOT NULL),
       q AS (SELECT DISTINCT k, part FROM p),
       g AS (SELECT q.k, q.part, n.i, coalesce(p.s, '') || repeat(' ', (w.width - coalesce(p.cols, 0))::INT) || ' ' AS cell FROM q JOIN w ON q.k = w.k JOIN n ON n.k = q.k LEFT JOIN p ON p.k = q.k AND p.part = q.part AND p.i = n.i)
       SELECT k AS l_orderkey, part, CASE part WHEN 0 THEN '譜    │' ELSE '詞' || part || '   │' END || string_agg(cell, '' ORDER BY i) || '│' AS text FROM g GROUP BY k, part""",
)
def score_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as scores: notes, and two stanzas with gaps below them, in columns by what they take in a terminal."""
    i = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")) - 1
    e = table(spark, sf_dir, "lineitem").select("l_orderkey", i.alias("slot"), (F.col("l_quantity").cast("int") % 8).alias("d"))
    notes = e.select("l_orderkey", "slot", F.expr("repeat(cast(d as string), 1 + d % 3)").alias("symbol"))
    said = F.explode(F.array(F.struct(F.lit(1).alias("part"), F.expr("case d % 4 when 0 then '詩' when 1 then 'la' when 2 then '愛歌' end").alias("syllable")), F.struct(F.lit(2).alias("part"), F.expr("case when d > 5 then 'sing' end").alias("syllable"))))
    cells = e.select("l_orderkey", "slot", said.alias("c")).select("l_orderkey", "slot", "c.*").filter("syllable is not null")
    return reports.score_lines(notes, cells, ["l_orderkey"], lambda part: F.when(part == 0, "譜").otherwise(F.concat(F.lit("詞"), part.cast("string"))))
