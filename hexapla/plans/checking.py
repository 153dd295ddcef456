"""Scorecards, reconciliation and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexapla.functions import values
from hexapla.operators import reconcile, resources
from hexapla.plans.registry import query
from hexapla.sources.tables import table


def _delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, o_orderpriority, present, good): orders that have lines, and none of them returned."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("returned"))
    joined = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select("o_orderkey", "o_orderpriority", F.col("l_orderkey").isNotNull().alias("present"), F.coalesce(~F.col("returned"), F.lit(False)).alias("good"))


_DELIVERED = """
    l AS (SELECT l_orderkey k, bool_or(l_returnflag = 'R') AS returned FROM lineitem GROUP BY 1),
    j AS (SELECT o_orderkey, o_orderpriority AS grp, l.k IS NOT NULL AS present, coalesce(NOT l.returned, false) AS good
          FROM orders LEFT JOIN l ON o_orderkey = l.k)"""


@query(
    "scorecard",
    f"""
    WITH {_DELIVERED}
    SELECT grp, count(*) AS expected, count(*) FILTER (present) AS existing, count(*) FILTER (good) AS complete,
           count(*) FILTER (NOT present) AS missing, count(*) FILTER (present AND NOT good) AS corrupt,
           100 * count(*) FILTER (good) // greatest(count(*), 1) AS percent
    FROM j GROUP BY 1""",
)
def scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority: expected, existing, complete, missing, corrupt."""
    return reconcile.scorecard(_delivered(spark, sf_dir).withColumnRenamed("o_orderpriority", "grp"), "grp", "present", "good")


@query(
    "status_rollup",
    """
    WITH f AS (SELECT o_custkey, l_orderkey IS NOT NULL AS present, coalesce(bool_and(l_returnflag <> 'R'), false) AS good
               FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey, o_orderkey, l_orderkey),
    g AS (SELECT o_custkey, count(*) AS expected, count(*) FILTER (present) AS there, bool_and(present AND good) AS passed FROM f GROUP BY 1)
    SELECT o_custkey, expected, there, CASE WHEN expected = 0 THEN 'no_files' WHEN there = expected THEN 'completed'
           WHEN there = 0 THEN 'failed' ELSE 'partial(' || there || '/' || expected || ')' END AS status,
           CASE WHEN there > 0 THEN passed END AS passed FROM g""",
)
def status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's orders: how many have lines, and whether all passed."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return reconcile.status_rollup(_delivered(spark, sf_dir).join(orders, "o_orderkey"), "o_custkey", "present", "good")


@query(
    "coverage_counts",
    """SELECT count(*) AS total, count(*) FILTER (text <> '') AS with_text, count(*) FILTER (l.doc_id IS NOT NULL) AS labelled,
       count(*) FILTER (quality = 1) AS good, count(*) FILTER (d.lang IS NOT NULL) AS with_lang, count(*) FILTER (n_chars > 1000) AS long
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def coverage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts with predicates in one pass."""
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").withColumn("has", F.lit(True)), "doc_id", "left")
    return reconcile.coverage(rows, {"with_text": F.col("text") != "", "labelled": F.col("has"), "good": F.col("quality") == 1, "with_lang": F.col("lang").isNotNull(), "long": F.col("n_chars") > 1000})


@query("status_distribution", "SELECT o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 1")
def status_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status (A2)."""
    return reconcile.distribution(table(spark, sf_dir, "orders"), "o_orderstatus")


@query("top_priorities", "SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, value LIMIT 3")
def top_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three most frequent priorities, ties by name."""
    return reconcile.distribution(table(spark, sf_dir, "orders"), "o_orderpriority").orderBy(F.desc("n"), "value").limit(3)


@query(
    "report_samples",
    """SELECT o_orderpriority, o_orderkey, k FROM (SELECT o_orderpriority, o_orderkey,
       row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k <= 5""",
)
def report_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five dearest orders of each priority, as a report lists them."""
    rows = table(spark, sf_dir, "orders").withColumn("k", F.expr("row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey)"))
    return rows.filter("k <= 5").select("o_orderpriority", "o_orderkey", "k")


@query(
    "three_way_reconcile",
    """WITH u AS (SELECT doc_id AS id, 'documents' AS s FROM documents UNION ALL SELECT doc_id, 'labels' FROM labels UNION ALL SELECT page_id, 'pages' FROM pages)
       SELECT id, bool_or(s = 'documents') AS in_documents, bool_or(s = 'labels') AS in_labels, bool_or(s = 'pages') AS in_pages FROM u GROUP BY 1""",
)
def three_way_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of three tables has each id."""
    ids = {n: table(spark, sf_dir, n).select(F.col(c).alias("id")) for n, c in (("documents", "doc_id"), ("labels", "doc_id"), ("pages", "page_id"))}
    return reconcile.presence(ids, "id")


@query("dangling_refs", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def dangling_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without labels."""
    return reconcile.dangling(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", table(spark, sf_dir, "labels"), "doc_id")


@query(
    "expected_vs_actual",
    """WITH e AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderkey % 3 <> 0), a AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
       SELECT coalesce(e.k, a.k) AS k, CASE WHEN e.k IS NULL THEN 'extra' WHEN a.k IS NULL THEN 'missing' ELSE 'matched' END AS state
       FROM e FULL JOIN a ON e.k = a.k""",
)
def expected_vs_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and lines: matched, missing, extra."""
    expected = table(spark, sf_dir, "orders").filter("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("k"))
    return reconcile.match_state(expected, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")), "k")


@query(
    "set_operations",
    """WITH a AS (SELECT doc_id AS id FROM labels WHERE quality = 1), b AS (SELECT doc_id AS id FROM labels WHERE toxic = 1)
       SELECT 'both' AS part, id FROM (SELECT id FROM a INTERSECT SELECT id FROM b) UNION ALL
       SELECT 'only_good', id FROM (SELECT id FROM a EXCEPT SELECT id FROM b) UNION ALL
       SELECT 'only_toxic', id FROM (SELECT id FROM b EXCEPT SELECT id FROM a)""",
)
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences both ways and the intersection."""
    labels = table(spark, sf_dir, "labels")
    good, toxic = (labels.filter(f"{c} = 1").select(F.col("doc_id").alias("id")) for c in ("quality", "toxic"))
    tag = lambda n, df: df.select(F.lit(n).alias("part"), "id")
    return tag("both", good.intersect(toxic)).unionByName(tag("only_good", good.subtract(toxic))).unionByName(tag("only_toxic", toxic.subtract(good)))


@query(
    "digest_duplicates",
    """SELECT digest, count(*) AS copies, min(doc_id) AS first, (count(*) - 1) * max(n) AS bytes
       FROM (SELECT doc_id, md5(text) AS digest, strlen(text) AS n FROM documents) GROUP BY 1 HAVING count(*) > 1""",
)
def digest_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that occur more than once, and what the copies take."""
    return reconcile.digest_duplicates(table(spark, sf_dir, "documents"), "doc_id", F.col("text"))


@query(
    "required_fields",
    """WITH d AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '' ELSE source END AS source, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE lang END AS lang, n_chars FROM documents)
       SELECT doc_id, array_to_string(list_filter([CASE WHEN coalesce(source, '') = '' THEN 'source' END, CASE WHEN coalesce(lang, '') = '' THEN 'lang' END,
              CASE WHEN n_chars < 100 THEN 'text:short' END], lambda x: x IS NOT NULL), ',') AS problems FROM d""",
)
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The problems of each record."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.col("source")).alias("source"), F.when(F.col("doc_id") % 7 != 0, F.col("lang")).alias("lang"), "n_chars")
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return d.select("doc_id", F.array_join(reconcile.missing_fields({"source": blank("source"), "lang": blank("lang"), "text:short": F.col("n_chars") < 100}), ",").alias("problems"))


@query(
    "declared_count",
    "SELECT max(o_orderkey) + 1 AS declared, count(*) AS there, max(o_orderkey) + 1 = count(*) AS agrees FROM orders",
)
def declared_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared total against the rows that are there."""
    return reconcile.count_against_declared(table(spark, sf_dir, "orders"), F.col("o_orderkey") + 1)


@query(
    "category_counts",
    """SELECT source, count(*) AS n, arg_min(lang, doc_id) AS first_lang, max(n_chars) AS longest FROM documents GROUP BY 1""",
)
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension rebuilt from its facts, with the attributes first seen."""
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"), F.min_by("lang", "doc_id").alias("first_lang"), F.max("n_chars").alias("longest"))


@query(
    "reason_lists",
    """SELECT o_orderkey, concat_ws(';', CASE WHEN o_orderstatus = 'F' THEN 'failed' END, CASE WHEN o_totalprice < 50000 THEN 'cheap' END,
       CASE WHEN o_orderpriority LIKE '1%' THEN 'urgent' END) AS reasons FROM orders""",
)
def reason_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons joined in a fixed order."""
    found = values.reasons([(F.col("o_orderstatus") == "F", "failed"), (F.col("o_totalprice") < 50000, "cheap"), (F.col("o_orderpriority").startswith("1"), "urgent")])
    return table(spark, sf_dir, "orders").select("o_orderkey", found.alias("reasons"))


@query(
    "unavailable_summary",
    """WITH r AS (SELECT user_id AS no, CASE WHEN event_id % 11 = 0 THEN 'site_removed' WHEN event_id % 3 <> 0 THEN NULL
                         WHEN event_id % 5 = 0 THEN 'http_4xx' ELSE 'network' END AS reason FROM events)
       SELECT no, count(*) FILTER (reason <> 'site_removed') AS unavailable, array_to_string(list_sort(list(DISTINCT reason)), ',') AS reasons
       FROM r WHERE reason IS NOT NULL GROUP BY 1""",
)
def unavailable_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why each record's resources are unavailable."""
    e = table(spark, sf_dir, "events")
    status = F.when(F.col("event_id") % 5 == 0, 404).otherwise(503)
    url = F.when(F.col("event_id") % 3 != 0, F.lit("u"))
    checked = e.select(F.col("user_id").alias("no"), resources.reason(url, values.failure_class(status), F.col("event_id") % 11 == 0).alias("reason"))
    return resources.unavailable_summary(checked).withColumn("reasons", F.array_join("reasons", ","))


@query(
    "missing_versions",
    """WITH o AS (SELECT DISTINCT user_id AS no, event_type AS category FROM events), w AS (SELECT DISTINCT user_id AS no, event_type AS category FROM events WHERE event_id % 2 = 0),
       u AS (SELECT DISTINCT user_id AS no, event_type AS category FROM events WHERE event_id % 7 = 0)
       SELECT no, category FROM o ANTI JOIN w USING (no, category) ANTI JOIN u USING (no, category)""",
)
def missing_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offered, neither owned nor known to be unavailable."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("no"), F.col("event_type").alias("category"))
    pick = lambda c: e.filter(c).select("no", "category").distinct()
    return resources.to_download(pick("true"), pick("event_id % 2 = 0"), pick("event_id % 7 = 0"))


@query(
    "site_removed",
    """WITH f AS (SELECT DISTINCT user_id AS no, event_type AS category FROM events WHERE event_id % 2 = 0), p AS (SELECT DISTINCT user_id AS no, event_type AS category FROM events),
       l AS (SELECT DISTINCT user_id AS no, event_type AS category FROM events WHERE event_id % 3 = 0)
       SELECT no, category, false AS site_removed FROM f UNION ALL
       SELECT no, category, true FROM p ANTI JOIN f USING (no, category) SEMI JOIN l USING (no, category)""",
)
def site_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions that the site dropped but of which a file exists."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("no"), F.col("event_type").alias("category"))
    pick = lambda c: e.filter(c).select("no", "category").distinct()
    return resources.carry_removed(pick("event_id % 2 = 0"), pick("true"), pick("event_id % 3 = 0"))


@query(
    "expected_resources",
    """WITH m AS (SELECT doc_id::VARCHAR AS no, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 's' || doc_id END AS s, 'n' || doc_id AS n, source, lang FROM documents)
       SELECT no, 'pdf' AS kind, 'staff' AS tag, s AS url FROM m UNION ALL SELECT no, 'pdf', 'numbered', n FROM m UNION ALL SELECT no, 'audio', lang, 'a' || source FROM m""",
)
def expected_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One view of all the resources that records should have."""
    version = lambda u: F.struct(u.alias("url"))
    d = table(spark, sf_dir, "documents")
    m = d.select(
        F.col("doc_id").cast("string").alias("no"), F.when(F.col("doc_id") % 4 != 0, F.concat(F.lit("s"), "doc_id")).alias("staff_pdf"), F.concat(F.lit("n"), "doc_id").alias("numbered_pdf"),
        F.create_map(F.col("lang"), version(F.concat(F.lit("a"), "source")), F.lit("_meta"), version(F.lit("x"))).alias("versions"),
    )
    return resources.expected_resources(m)


@query(
    "checked_resources",
    """WITH r AS (SELECT o_orderkey AS no, 'order' AS kind, o_orderpriority AS tag FROM orders),
       c AS (SELECT o_orderkey AS no, 'order' AS kind, o_orderpriority AS tag, o_orderkey % 3 = 0 AS ok, (200 + o_orderkey % 4 * 100)::INT AS http_status, NULL::VARCHAR AS error FROM orders WHERE o_orderkey % 2 = 0)
       SELECT r.*, ok, http_status, error FROM r LEFT JOIN c USING (no, kind, tag)""",
)
def checked_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check results joined to the manifest."""
    o = table(spark, sf_dir, "orders")
    r = o.select(F.col("o_orderkey").alias("no"), F.lit("order").alias("kind"), F.col("o_orderpriority").alias("tag"))
    c = o.filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("no"), F.lit("order").alias("kind"), F.col("o_orderpriority").alias("tag"), F.expr("o_orderkey % 3 = 0").alias("ok"), F.expr("cast(200 + o_orderkey % 4 * 100 as int)").alias("http_status"), F.lit(None).cast("string").alias("error"))
    return resources.with_checks(r, c)


@query(
    "duration_stats",
    """SELECT event_type, count(*) AS entries, count(*) FILTER (v > 20) AS filled, count(*) FILTER (v IS NULL) AS nulls, avg(CASE WHEN v > 20 THEN v END) AS mean
       FROM (SELECT event_type, CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS v FROM events) GROUP BY 1""",
)
def duration_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of maps by key: filled, null, and their mean."""
    m = table(spark, sf_dir, "events").select(F.create_map("event_type", F.when(F.col("event_id") % 9 != 0, F.col("value"))).alias("m"))
    long = F.when(F.col("v") > 20, F.col("v"))
    return m.select(F.explode("m").alias("event_type", "v")).groupBy("event_type").agg(F.count("*").alias("entries"), F.count(long).alias("filled"), F.count_if(F.col("v").isNull()).alias("nulls"), F.avg(long).alias("mean"))


@query(
    "key_set_agreement",
    """SELECT event_id, NOT (event_id % 4 = 0 OR event_id % 6 = 0) AS same FROM events""",
)
def key_set_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether three columns name the same keys."""
    e = table(spark, sf_dir, "events")
    one = F.create_map(F.col("event_type"), F.lit("p"))
    two = F.when(F.col("event_id") % 4 != 0, F.create_map(F.col("event_type"), F.lit("q")))
    three = F.create_map(F.when(F.col("event_id") % 6 == 0, F.lit("?")).otherwise(F.col("event_type")), F.lit("r"))
    return e.select("event_id", values.same_keys(one, two, three).alias("same"))


@query(
    "directory_status",
    """SELECT c_custkey, CASE WHEN n = 0 THEN 'no_files' WHEN c_custkey % 6 = 0 THEN 'dir_missing' WHEN there = n THEN 'completed' WHEN there = 0 THEN 'failed' ELSE 'partial(' || there || '/' || n || ')' END AS status
       FROM (SELECT c_custkey, count(o_orderkey) AS n, count(o_orderkey) FILTER (o_orderstatus <> 'F') AS there FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)""",
)
def directory_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is there of each parent's files, parents without any and missing directories included."""
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") != "F").alias("there"))
    joined = table(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").fillna(0, ["n", "there"])
    return joined.select("c_custkey", reconcile.status_text(F.col("n"), F.col("there"), F.col("c_custkey") % 6 != 0).alias("status"))
