"""Sources and sinks on files. Each query writes its files into the shared folder first: pages, maps and reports by Spark, and
the few files of the listings, of which there is one or two a nation, through the store's own interface."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from hexapla.plans.registry import query
from hexapla.operators import runs
from hexapla.sources import files, paged, records
from hexapla.sources.scratch import kept, shared_path
from hexapla.sources.tables import table

#: Records on a page, and files of a map.
PER_PAGE, MAP_FILES = 10, 7


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as pages of JSON, one file each: some are bare lists, every thirteenth is broken."""
    rows = table(spark, sf_dir, "customer").select(F.floor(F.col("c_custkey") / PER_PAGE).cast("int").alias("p"), "c_custkey", "c_name", "c_mktsegment")
    record = F.struct(F.col("c_custkey").cast("string").alias("no"), F.col("c_name").alias("name"), F.array(F.struct(F.col("c_mktsegment").alias("text"))).alias("lyrics"))
    data = rows.groupBy("p").agg(F.array_sort(F.collect_list(F.struct("c_custkey", record.alias("r")))).alias("d")).select("p", F.transform("d", lambda x: x["r"]).alias("data"))
    page = F.to_json(F.struct("data", (F.col("p") + 1).alias("current_page"), F.lit(10_000).alias("last_page")))
    value = F.when(F.col("p") % 13 == 12, "{broken").when(F.col("p") % 5 == 4, F.to_json("data")).otherwise(page)
    path = shared_path(spark, "pages")
    data.select("p", value.alias("value")).repartition("p").write.partitionBy("p").text(path)
    return records.pages(spark, path)


@query("page_records", "SELECT c_custkey::VARCHAR AS no, c_name AS name, c_mktsegment AS verse, (c_custkey % 10)::INT AS place FROM customer WHERE c_custkey // 10 % 13 <> 12")
def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of all pages that can be read, whatever their form."""
    return records.records(_pages(spark, sf_dir)).select("no", "name", F.get("lyrics", F.lit(0))["text"].alias("verse"), "place")


@query(
    "paged_scan",
    """WITH p AS (SELECT c_custkey // 10 + 1 AS number, count(*) AS n FROM customer GROUP BY 1),
       o AS (SELECT number, CASE WHEN number % 4 = 3 AND number % 8 <> 7 THEN 'cache' WHEN number % 6 = 5 THEN 'missing' WHEN number % 9 = 8 THEN 'corrupt' ELSE 'site' END AS origin, n FROM p)
       SELECT run, number::INT AS number, CASE WHEN run = 2 AND origin = 'site' THEN 'cache' ELSE origin END AS origin,
              CASE WHEN origin IN ('missing', 'corrupt') THEN 0 ELSE n END AS there, (SELECT count(*) FROM customer) AS declared FROM o, (VALUES (1), (2)) r(run)""",
)
def paged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as pages of a site, read twice through a cache that has a few pages beforehand, some of them broken; pages that
    are missing or broken on the site are counted as empty (S3, S5)."""
    rows = table(spark, sf_dir, "customer").select((F.floor(F.col("c_custkey") / PER_PAGE) + 1).cast("int").alias("number"), "c_custkey")
    total = rows.agg(F.max("number").alias("last_page"), F.count("*").alias("total"))
    data = rows.groupBy("number").agg(F.array_sort(F.collect_list(F.struct(F.col("c_custkey").cast("string").alias("no")))).alias("data")).join(total)
    page = F.to_json(F.struct("data", F.col("number").alias("current_page"), "last_page", "total"))
    on_site = data.filter("number % 6 <> 5 or number = 1").select("number", F.when((F.col("number") % 9 == 8), "{broken").otherwise(page).alias("value"))
    cached = data.filter("number % 4 = 3").select("number", F.when(F.col("number") % 8 == 7, "[oh").otherwise(page).alias("value"))
    site, cache = shared_path(spark, "site"), shared_path(spark, "cache")
    for rows_, folder in ((on_site, site), (cached, cache)):
        paged.write_pages(rows_, folder)
    spark.dataSource.register(paged.PagedSource)
    got = None
    for run in (1, 2):
        read = kept(spark.read.format("paged").option("path", site).option("cache", cache).load())
        one = F.from_json("raw", records.PAGE)
        one = read.select(F.lit(run).alias("run"), "number", "origin", F.coalesce(F.size(one["data"]), F.lit(0)).cast("long").alias("there"), one["total"].alias("total"))
        got = one if got is None else got.unionByName(one)
    declared = got.agg(F.max("total").alias("declared"))
    return got.drop("total").join(declared)


@query("first_pages", "SELECT c_custkey::VARCHAR AS no FROM customer WHERE c_custkey // 10 % 13 <> 12 AND c_custkey // 10 % 5 <> 4 ORDER BY c_custkey LIMIT 70")
def first_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the first seven numbered pages."""
    return records.first_pages(_pages(spark, sf_dir).filter("current_page is not null"), 7, PER_PAGE).select("no")


_MAP = "o_orderkey::VARCHAR AS id, 'd' || o_custkey AS dirname, 'https://h/' || o_orderkey || '/f' || o_custkey || '.pdf' || CASE WHEN o_orderkey % 2 = 0 THEN '?v=1' ELSE '' END AS url"


@query("url_map_entries", f"SELECT key, id, dirname, url FROM (SELECT 'f' || o_custkey || '.pdf' AS key, {_MAP}, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 7 DESC, o_orderkey DESC) AS r FROM orders WHERE o_orderkey % 11 <> 0) WHERE r = 1")
def url_map_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map of lines in several files by the last part of the URL; short lines are dropped and the last line wins."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % MAP_FILES).cast("int").alias("f"), F.expr(
        "if(o_orderkey % 11 = 0, concat(o_orderkey, '|short'), concat(o_orderkey, '|d', o_custkey, '|https://h/', o_orderkey, '/f', o_custkey, '.pdf', if(o_orderkey % 2 = 0, '?v=1', '')))").alias("value"))
    path = shared_path(spark, "map")
    rows.repartition("f").sortWithinPartitions("f", "o_orderkey").select("f", "value").write.partitionBy("f").text(path)
    return records.url_map(spark, path)


@query("replaced_report", "SELECT n_nationkey, upper(n_name) AS n_name FROM nation WHERE n_nationkey % 3 = 0")
def replaced_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written twice; the second takes the first's place at once."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    path = shared_path(spark, "report")
    records.write_report(n, path)
    records.write_report(spark.read.schema(n.schema).json(path).filter("n_nationkey % 3 = 0").withColumn("n_name", F.upper("n_name")), path)
    return spark.read.schema(n.schema).json(path)


@query("rebuilt_table", "SELECT o_orderpriority, count(*) AS n, min(o_orderkey) AS first_seen FROM orders GROUP BY 1")
def rebuilt_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of groups rebuilt as a whole, aside, and swapped in (K6)."""
    o = table(spark, sf_dir, "orders")
    path = shared_path(spark, "groups")
    o.select("o_orderpriority", F.lit(0).cast("long").alias("n"), F.col("o_orderkey").alias("first_seen")).limit(0).write.parquet(path)
    records.rebuild_table(o.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_seen")), path)
    return spark.read.parquet(path)


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files for each of the 25 nations: a score, broken in every third directory, and a recording, which is an older copy
    of the directory's first one in every fourth."""
    root = shared_path(spark, "files")
    store = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    at = lambda p: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{p}")
    for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").collect():
        k, suffix = r.n_nationkey, ("_a", "_b", "")[r.n_nationkey % 3]
        head = b"bad" if k % 3 == 0 else b"%PDF-"
        for name, data, hours in ((f"score_{k:03d}.pdf", head + r.n_name.encode(), 2), (f"score_{k:03d}.MP3", b"ID3" + str(r.n_regionkey).encode(), 1 if k % 4 == 0 else 3)):
            path = at(f"{k:03d}_{k + 100}{suffix}/{name}")
            out = store.create(path)
            out.write(bytearray(data))
            out.close()
            store.setTimes(path, 1_700_000_000_000 + hours * 3_600_000, -1)
    return kept(files.files(spark, root, content=True))


_FILES = """
    n AS (SELECT n_nationkey AS k, lpad(n_nationkey::VARCHAR, 3, '0') AS pad, n_name, n_regionkey, lpad(n_nationkey::VARCHAR, 3, '0') || '_' || (n_nationkey + 100) || CASE n_nationkey % 3 WHEN 0 THEN '_a' WHEN 1 THEN '_b' ELSE '' END AS directory FROM nation),
    f AS (SELECT k, directory, 'score_' || pad || '.pdf' AS name, 'pdf' AS ext, CASE WHEN k % 3 = 0 THEN 'bad' ELSE '%PDF-' END || n_name AS content FROM n
          UNION ALL SELECT k, directory, 'score_' || pad || '.MP3', 'mp3', 'ID3' || n_regionkey FROM n)"""


@query("file_listing", f"WITH {_FILES} SELECT directory, name, ext, length(content) AS size FROM f")
def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files below a folder with their extensions and sizes."""
    return _files(spark, sf_dir).select("directory", "name", "ext", "size")


@query("directory_numbers", f"WITH {_FILES} SELECT DISTINCT directory, substring(directory, 5) AS no FROM f")
def directory_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record numbers that directories are named by."""
    return files.record_directories(_files(spark, sf_dir)).select("directory", "no")


@query("file_index", f"WITH {_FILES} SELECT c.number, c.candidate, f.name FROM (SELECT k::VARCHAR AS number, unnest(list_distinct([k::VARCHAR, pad])) AS candidate FROM n) c JOIN f ON f.name = 'score_' || c.candidate || '.MP3'")
def file_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, as they are or padded, with the first file whose name ends in them."""
    index = files.index_by_number(_files(spark, sf_dir)).withColumnRenamed("number", "candidate")
    numbers = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("number"))
    return files.name_candidates(numbers).join(index, "candidate").select("number", "candidate", F.regexp_extract("path", "([^/]*)$", 1).alias("name"))


@query("file_integrity", f"WITH {_FILES} SELECT name, ext = 'mp3' OR content LIKE '\\%PDF%' ESCAPE '\\' AS strict, ext = 'mp3' OR content LIKE '\\%PDF%' ESCAPE '\\' AS lenient FROM f")
def file_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether files begin as their extensions say."""
    return files.integrity(_files(spark, sf_dir)).select(F.regexp_extract("path", "([^/]*)$", 1).alias("name"), "strict", "lenient")


@query("manifests", f"WITH {_FILES} SELECT directory, string_agg(name || ' ' || sha256(content), chr(10) ORDER BY name) AS manifest FROM f GROUP BY 1")
def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checksums of each directory, by name."""
    lines = F.transform("manifest", lambda x: F.concat_ws(" ", x["file"], x["sha256"]))
    return files.checksums(_files(spark, sf_dir)).select("directory", F.array_join(lines, "\n").alias("manifest"))


@query("stale_files", f"WITH {_FILES} SELECT name FROM f WHERE ext = 'pdf' AND k % 4 = 0")
def stale_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores whose recording is older than they are (I8)."""
    every = _files(spark, sf_dir)
    return files.stale(every.filter("ext = 'pdf'"), every.filter("ext = 'mp3'")).select("name")


@query("deletable_twins", f"WITH {_FILES}, m AS (SELECT name, content, row_number() OVER (PARTITION BY content ORDER BY name) AS r, first_value(name) OVER (PARTITION BY content ORDER BY name) AS first_name FROM f) SELECT name, first_name FROM m WHERE r > 1")
def deletable_twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that repeat an earlier one, byte by byte, and may go."""
    d = _files(spark, sf_dir).select("name", F.md5("content").alias("digest"), "size")
    first = d.groupBy("digest").agg(F.min_by("name", "name").alias("first_name")).withColumnRenamed("digest", "twin_digest")
    twins = d.join(first, F.col("digest") == F.col("twin_digest"), "left").filter("name <> first_name").withColumnRenamed("name", "path")
    return files.deletable(twins).select(F.col("path").alias("name"), "first_name")


@query("element_counts", "SELECT tag, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS tag FROM part) WHERE tag <> '' GROUP BY 1")
def element_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each element of an array occurs (A5)."""
    tags = table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("tag")).filter("tag <> ''")
    return tags.groupBy("tag").agg(F.count("*").alias("n"))


@query("wanted_files", f"WITH {_FILES} SELECT DISTINCT name FROM f WHERE ext = 'pdf' AND k % 2 = 0")
def wanted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of names: those that are PDF files and exist, each once, sorted."""
    every = _files(spark, sf_dir)
    asked = every.select("name").unionByName(every.select(F.concat(F.lit("none_"), "name").alias("name"))).unionByName(every.select("name"))
    asked = asked.filter(F.regexp_extract("name", r"(\d+)\.[^.]*$", 1).cast("int") % 2 == 0)
    return asked.filter(F.lower("name").endswith(".pdf")).distinct().join(every.select("name"), "name", "left_semi").orderBy("name")


@query(
    "incremental_runs",
    """WITH c AS (SELECT c_custkey AS k, c_custkey::VARCHAR AS key, c_nationkey % 5 = 4 AS bad, CASE WHEN c_custkey % 7 = 0 THEN 'b' ELSE 'a' END AS later FROM customer),
       r1 AS (SELECT key, 'a' AS mark, bad FROM c ORDER BY k LIMIT 100),
       r2 AS (SELECT key, later AS mark, bad FROM c WHERE NOT EXISTS (SELECT 1 FROM r1 WHERE r1.key = c.key AND r1.mark = c.later AND NOT r1.bad)),
       r3 AS (SELECT key, later AS mark, bad FROM c WHERE key IN ('1', '2', '9')),
       r4 AS (SELECT key, later AS mark, bad FROM c WHERE bad)
       SELECT run, key, mark, CASE WHEN bad THEN 'ValueError: no ' || key ELSE 'done ' || key || mark END AS said
       FROM (SELECT 1 AS run, * FROM r1 UNION ALL SELECT 2, * FROM r2 UNION ALL SELECT 3, * FROM r3 UNION ALL SELECT 4, * FROM r4)""",
)
def incremental_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs over customers: the first hundred; what is left, was changed or failed; three by name; and a dry run, which
    finds only what failed again (I5)."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key"), (F.col("c_nationkey") % 5 == 4).alias("bad"), "c_custkey")
    before, later = c.withColumn("mark", F.lit("a")), c.withColumn("mark", F.when(F.col("c_custkey") % 7 == 0, "b").otherwise("a"))

    def work(item: dict) -> str:
        if item["bad"]:
            raise ValueError(f"no {item['key']}")
        return f"done {item['key']}{item['mark']}"

    log, got = shared_path(spark, "log"), None
    for k, (items, plan) in enumerate([(before, {"limit": 100}), (later, {}), (later, {"explicit": ["1", "2", "9"], "force": True}), (later, {"dry_run": True})], 1):
        one = runs.run(items, log, work, kept, **plan).select(F.lit(k).alias("run"), "key", "mark", F.coalesce("result", "error").alias("said"))
        got = one if got is None else got.unionByName(one)
    return got


@query("log_of_runs", "SELECT c_custkey::VARCHAR AS key, CASE WHEN c_nationkey % 5 = 4 THEN 0 ELSE 1 END AS times FROM customer")
def log_of_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run cut off after its first part and begun again does each item once."""
    items = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.lit("m").alias("mark"), (F.col("c_nationkey") % 5 == 4).alias("bad"))
    log = shared_path(spark, "log")

    def work(item: dict) -> str:
        return str(1 // (not item["bad"]))

    for plan in ({"limit": 60}, {}, {}):
        runs.run(items, log, work, kept, **plan)
    times = runs.read_log(spark, log).groupBy(F.col("key").alias("l_key")).agg(F.count("*").alias("n"))
    return items.join(times, F.col("key") == F.col("l_key"), "left").select("key", F.coalesce("n", F.lit(0)).cast("int").alias("times"))


@query("report_entries", "SELECT 'r' || n_regionkey AS report, n_name AS name, n_nationkey AS hits FROM nation WHERE n_regionkey <> 3")
def report_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of JSON reports, an array in a file, one for each region; one is broken and one isn't there."""
    entries = table(spark, sf_dir, "nation").select("n_regionkey", F.struct(F.col("n_name").alias("name"), F.col("n_nationkey").cast("long").alias("hits")).alias("e"))
    text = entries.groupBy("n_regionkey").agg(F.to_json(F.collect_list("e")).alias("value")).withColumn("value", F.when(F.col("n_regionkey") == 3, F.substring("value", 1, 20)).otherwise(F.col("value")))
    folder, got = shared_path(spark, "reports"), None
    text.repartition("n_regionkey").write.partitionBy("n_regionkey").text(folder)
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("hits", T.LongType())])
    for k in range(6):  # there is no sixth
        one = records.report(spark, f"{folder}/n_regionkey={k}", schema).select(F.lit(f"r{k}").alias("report"), "name", "hits")
        got = one if got is None else got.unionByName(one)
    return got


@query("texts_by_number", "SELECT 'page_' || p_partkey || '.json' AS name, p_name AS text, row_number() OVER (ORDER BY p_partkey) AS place FROM part WHERE p_partkey <= 150")
def texts_by_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files in the order of the numbers in their names."""
    folder = shared_path(spark, "texts")
    paged.write_pages(table(spark, sf_dir, "part").filter("p_partkey <= 150").select(F.col("p_partkey").cast("int").alias("number"), F.col("p_name").alias("value")).repartition(4), folder)
    found = kept(files.texts_in_order(spark, folder).withColumn("at", F.monotonically_increasing_id()))
    return found.select("name", "text", F.row_number().over(Window.orderBy("at")).cast("long").alias("place"))


@query(
    "page_totals",
    """SELECT count(*) AS declared, count(*) FILTER (c_custkey // 10 % 13 <> 12) AS there, count(DISTINCT c_custkey // 10) FILTER (c_custkey // 10 % 13 = 12) AS pages_missing,
       count(*) FILTER (c_custkey // 10 % 13 = 12) = 0 AS agrees FROM customer""",
)
def page_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What pages declare against what is on those that can be read."""
    rows = table(spark, sf_dir, "customer").select(F.floor(F.col("c_custkey") / PER_PAGE).cast("int").alias("p"), "c_custkey")
    total = rows.agg(F.count_distinct("p").alias("last_page"), F.count("*").alias("total"))
    data = rows.groupBy("p").agg(F.collect_list(F.struct(F.col("c_custkey").cast("string").alias("no"))).alias("data")).join(total)
    value = F.when(F.col("p") % 13 == 12, "{broken").otherwise(F.to_json(F.struct("data", (F.col("p") + 1).alias("current_page"), "last_page", "total")))
    folder = shared_path(spark, "pages")
    data.select("p", value.alias("value")).repartition("p").write.partitionBy("p").text(folder)
    return records.total_check(records.pages(spark, folder))
