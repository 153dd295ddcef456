"""Decks and recordings, whose bytes are put together from table rows, and small functions of texts and numbers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexapla.functions import text, values
from hexapla.operators import reports, vote
from hexapla.plans.registry import query
from hexapla.sources import compound, media
from hexapla.sources.tables import table


def _number(value: Column, size: int, little: bool) -> Column:
    """A number as ``size`` bytes."""
    big = F.lpad(F.hex(value.cast("long")), 2 * size, "0")
    pairs = F.regexp_extract_all(big, F.lit("(..)"), F.lit(1))
    return F.unhex(F.array_join(F.reverse(pairs) if little else pairs, ""))


def _record(kind: int, content: Column, container: bool = False) -> Column:
    return F.concat(_number(F.lit(15 if container else 0), 2, True), _number(F.lit(kind), 2, True), _number(F.octet_length(content), 4, True), content)


@query(
    "deck_bodies",
    """SELECT path, stanza_no, text, error FROM (
       SELECT 'deck' || n_nationkey AS path, 1 AS stanza_no, n_name AS text, NULL::VARCHAR AS error, n_nationkey FROM nation UNION ALL
       SELECT 'deck' || n_nationkey, 2, 'second ' || n_nationkey, NULL, n_nationkey FROM nation) WHERE n_nationkey % 5 <> 3 AND NOT (n_nationkey % 5 = 1 AND stanza_no = 2)
       UNION ALL SELECT 'deck' || n_nationkey, NULL, NULL, 'no text in it' FROM nation WHERE n_nationkey % 5 = 3""",
)
def deck_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bodies in streams of nested records; one stream in five is cut off, and one has titles only."""
    name, more = F.encode("n_name", "UTF-16LE"), F.encode(F.concat(F.lit("second "), "n_nationkey"), "ISO-8859-1")
    role = lambda k: _record(media.ROLE, _number(F.lit(k), 4, True))
    body = F.when(F.col("n_nationkey") % 5 == 3, 0).otherwise(media.BODY)
    first = F.concat(_record(media.ROLE, _number(body, 4, True)), _record(media.WIDE, name))
    second = F.concat(_record(media.ROLE, _number(body, 4, True)), _record(media.NARROW, more))
    stream = F.concat(_record(1000, F.concat(role(0), _record(media.NARROW, F.encode(F.lit("a title"), "ISO-8859-1")), _record(1001, first, True)), True), _record(1002, F.concat(_record(7, name), second), True))
    cut = F.when(F.col("n_nationkey") % 5 == 1, F.substring(stream, F.lit(1), F.octet_length(stream) - 3)).otherwise(stream)
    return media.decks(table(spark, sf_dir, "nation").select(F.concat(F.lit("deck"), "n_nationkey").alias("path"), cut.alias("content")))


@query(
    "deck_files",
    """SELECT 'deck' || c_custkey || '.ppt' AS path, CASE WHEN c_custkey % 6 < 4 THEN k END::INT AS stanza_no, CASE WHEN c_custkey % 6 < 4 THEN c_name || ' ' || k || repeat('~', CASE WHEN c_custkey % 6 < 2 THEN 900 ELSE 0 END) END AS text,
       CASE c_custkey % 6 WHEN 4 THEN 'a chain of sectors runs in a circle' WHEN 5 THEN 'the file is cut off' END AS error
       FROM customer, range(1, 1 + CASE WHEN c_custkey % 6 < 4 THEN 3 ELSE 1 END) r(k)""",
)
def deck_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decks as they lie on disk: large ones and small ones, whose sectors are in order or from last to first, and some with a
    circular chain or without an end (S18, K22)."""

    @F.pandas_udf(T.BinaryType())
    def file(stream: pd.Series, form: pd.Series) -> pd.Series:
        def one(x, k):
            got = compound.written({"Current User": b"someone", media.DECK: x}, backward=k % 2 == 1)
            table = int.from_bytes(got[76:80], "little")
            if k == 4:  # the directory's sector leads to itself
                at = (table + 1) * compound.SECTOR + 4 * int.from_bytes(got[48:52], "little")
                got = got[:at] + got[48:52] + got[at + 4 :]
            return got[: -len(got) // 2] if k == 5 else got

        return pd.Series([one(*v) for v in zip(stream, form, strict=True)])

    form = (F.col("c_custkey") % 6).cast("int")
    body = lambda k: F.concat("c_name", F.lit(f" {k}"), F.repeat(F.lit("~"), F.when(form < 2, 900).otherwise(0)))
    record = lambda k: F.concat(_record(media.ROLE, _number(F.lit(media.BODY), 4, True)), _record(media.WIDE, F.encode(body(k), "UTF-16LE")))
    stream = _record(1000, F.concat(record(1), record(2), record(3)), True)
    decks = table(spark, sf_dir, "customer").select(F.concat(F.lit("deck"), "c_custkey", F.lit(".ppt")).alias("path"), file(stream, form).alias("content"))
    return media.decks(decks)


@query(
    "recording_lengths",
    """SELECT p_partkey::VARCHAR AS no, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE round(p_size * 1000 / 441.0, 3) END AS video, round((400 * p_size) * 8 / 128000.0, 3) AS sound,
       CASE WHEN p_partkey % 3 = 0 THEN 'no movie header' END AS reason, CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS failed FROM part""",
)
def recording_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations from headers by version, keys kept where a file can't be read."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    header = F.concat(F.unhex(F.lit("00" * 12)), _number(F.lit(441), 4, False), _number(F.col("p_size") * 1000, 4, False))
    box = lambda kind, content: F.concat(_number(F.octet_length(content) + 8, 4, False), F.encode(F.lit(kind), "US-ASCII"), content)
    movie = F.concat(box("ftyp", F.encode(F.lit("M4A "), "US-ASCII")), box("moov", box("mvhd", header)))
    movie = F.when(F.col("p_partkey") % 3 == 0, box("ftyp", F.encode(F.lit("M4A "), "US-ASCII"))).otherwise(movie)
    sound = F.unhex(F.concat(F.lit("fffb9000"), F.repeat(F.lit("00"), (F.col("p_size") * 400 - 4).cast("int"))))
    files = F.explode(F.array(*[F.struct(F.lit(v).alias("version"), F.concat(F.lit(f"{v}/"), "p_partkey").alias("path"), F.lit(e).alias("ext"), c.alias("content")) for v, e, c in (("video", "m4a", movie), ("sound", "mp3", sound))]))
    found = p.select(F.col("p_partkey").cast("string").alias("no"), files.alias("f")).select("no", "f.*")
    named = found.select("no", "version", "path").unionByName(p.selectExpr("cast(p_partkey as string) as no", "'_error' as version", "'none' as path"))
    maps = media.duration_maps(named, media.durations(found))
    return maps.select("no", F.col("seconds")["video"].alias("video"), F.col("seconds")["sound"].alias("sound"), F.try_element_at("reasons", F.lit("video")).alias("reason"), F.size("reasons").alias("failed"))


@query("category_lookup", "SELECT n_nationkey, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey <> 3")
def category_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories by number from their own table; null where there is none."""
    r = table(spark, sf_dir, "region").filter("r_regionkey <> 3").select("r_regionkey", "r_name")
    return table(spark, sf_dir, "nation").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("n_nationkey", "r_name")


@query("font_names", "SELECT p_partkey, p_brand AS family FROM part")
def font_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Font names without the mark of a subset, where there is one, and repaired."""
    broken = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("ABCDEF+"), "p_brand")).otherwise(F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", reports.repaired(text.font_family(broken)).alias("family"))


@query("text_widths", "SELECT p_partkey, length(p_name) + 2 AS columns, (0.5 * (length(p_name) - length(replace(p_name, 'a', ''))) + length(replace(p_name, 'a', '')))::DOUBLE AS em FROM part")
def text_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns in a terminal, wide characters two, and widths in em."""
    return table(spark, sf_dir, "part").select("p_partkey", text.display_width(F.concat("p_name", F.lit("詩"))).cast("long").alias("columns"), reports.text_width(F.col("p_name"), {"a": 0.5}).alias("em"))


@query("centred_texts", "SELECT p_partkey, repeat(' ', greatest((60 - length(p_name)) // 2, 0)::INT) || p_name || repeat(' ', (60 - length(p_name) - (60 - length(p_name)) // 2)::INT) AS line FROM part")
def centred_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts in the middle of sixty columns."""
    return table(spark, sf_dir, "part").select("p_partkey", reports.centred(F.col("p_name"), F.length("p_name"), 60).alias("line"))


@query("shared_tails", "SELECT conv_id, CASE WHEN conv_id % 4 = 0 THEN [] WHEN conv_id % 4 = 1 THEN ['b', 'c'] WHEN conv_id % 4 = 2 THEN ['b'] ELSE [] END AS tail FROM (SELECT DISTINCT conv_id FROM conversations)")
def shared_tails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that all stanzas have in common, up to the first that differs."""
    boxes = F.expr("case conv_id % 4 when 0 then array(array('a', 'b')) when 1 then array(array('a', 'b', 'c'), array('x', 'b', 'c'), array('y', 'b', 'c')) when 2 then array(array('a', 'b', 'c'), array('x', 'b', 'd')) else array(array('a', 'b', 'c'), array('a', 'x', 'c')) end")
    return table(spark, sf_dir, "conversations").select("conv_id").distinct().select("conv_id", values.shared_tail(boxes).alias("tail"))


@query("plain_keys", "SELECT p_partkey, lower(replace(p_name, ' ', '')) || '1a你神奇' AS key FROM part")
def plain_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compatibility characters made plain, points and spaces away, variant characters folded."""
    return table(spark, sf_dir, "part").select("p_partkey", text.plain_key(F.concat("p_name", F.lit("．１ ·Ａ祢祂綺")), {"祂": "神", "祢": "你", "綺": "奇"}).alias("key"))


@query(
    "symbol_grades",
    """WITH e AS (SELECT event_id, event_type AS symbol, json_extract_string(props, '$.k') AS k FROM events)
       SELECT event_id, CASE WHEN symbol = 'click' THEN '1.' WHEN symbol = 'view' THEN '-' ELSE symbol || k END AS plain,
              CASE WHEN symbol = 'click' THEN '1' WHEN symbol <> 'view' THEN nullif(regexp_extract(symbol || k, '[0-7]'), '') END AS grade FROM e""",
)
def symbol_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols made plain by a table, others as they are, and the first digit 0 to 7 in them."""
    k = F.get_json_object("props", "$.k")
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type").isin("click", "view"), F.col("event_type")).otherwise(F.concat("event_type", k)).alias("symbol"))
    plain = text.plain_symbol(F.col("symbol"), {"click": "1.", "view": "-"})
    return e.select("event_id", plain.alias("plain"), text.grade(plain).alias("grade"))


@query("box_centres", "SELECT l_orderkey, l_linenumber, (l_quantity + l_extendedprice) / 2 AS middle, abs(l_quantity - l_extendedprice) AS apart FROM lineitem")
def box_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The middle and the size of each box."""
    a, b = F.col("l_quantity"), F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ((a + b) / 2).alias("middle"), F.abs(a - b).alias("apart"))


@query("written_json", "SELECT c_custkey, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer")
def written_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as JSON and read back, nulls kept apart from empty texts (M3)."""
    record = F.struct(F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("segment"))
    made = table(spark, sf_dir, "customer").select("c_custkey", F.to_json(record).alias("j"))
    return made.select("c_custkey", F.from_json("j", "name string, segment string").alias("r")).select("c_custkey", "r.*")


@query("stamped_now", "SELECT n_nationkey, TRUE AS recent FROM nation")
def stamped_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows stamped with the time of the query (M8)."""
    return table(spark, sf_dir, "nation").withColumn("at", F.current_timestamp()).select("n_nationkey", F.col("at").between(F.current_timestamp() - F.expr("interval 1 hour"), F.current_timestamp()).alias("recent"))


@query("named_numbers", "SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'category' WHEN p_partkey % 4 = 3 THEN 'other' ELSE 'song' END AS kind, CASE WHEN p_partkey % 4 = 3 THEN '' ELSE p_brand END AS name, CASE WHEN p_partkey % 4 IN (1, 2) THEN p_partkey END AS number FROM part")
def named_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an index: a name and a number, or a category in brackets."""
    line = F.expr("case p_partkey % 4 when 0 then concat(' 【', p_brand, '】') when 1 then concat(p_brand, ' ', p_partkey) when 2 then concat(p_brand, '\\t', p_partkey, ' ') else concat(p_partkey, ' ', p_brand) end")
    return table(spark, sf_dir, "part").select("p_partkey", text.index_line(line).alias("l")).select("p_partkey", "l.*")


@query("line_mark_codes", "SELECT DISTINCT p_brand AS code, '|' AS symbol FROM part WHERE p_size > 48 AND p_brand <> 'Brand#1'")
def line_mark_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of over-tall glyphs as line marks, but for those that are known."""
    known = spark.createDataFrame([("Brand#1", "1")], "code string, symbol string")
    glyphs = table(spark, sf_dir, "part").select(F.col("p_brand").alias("code"), "p_size")
    return vote.geometry_marks(glyphs, "code", F.col("p_size") > 48, F.lit(False), known)


@query("learned_dictionary", """SELECT code, symbol, source FROM (SELECT user_id::VARCHAR AS code, 'kept' AS symbol, 'seed' AS source FROM events WHERE user_id % 10 = 0 GROUP BY 1 UNION ALL
    SELECT user_id::VARCHAR, event_type, 'learned' FROM (SELECT user_id, event_type, n, sum(n) OVER (PARTITION BY user_id) AS total, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS r
    FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)) WHERE r = 1 AND n >= 3 AND n * 100 >= total * 25 AND user_id % 10 <> 0)""")
def learned_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored dictionary learned anew: what was learned before is cleared, the seed stays, new codes are saved."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("code"), F.col("event_type").alias("symbol"), "user_id")
    seed = e.filter("user_id % 10 = 0").select("code").distinct().withColumns({"symbol": F.lit("kept"), "source": F.lit("seed")})
    stored = seed.unionByName(e.filter("user_id % 3 = 1").select("code").distinct().withColumns({"symbol": F.lit("old"), "source": F.lit("learned")}))
    return vote.relearned(stored, vote.majority(e, "code", "symbol", 3, 25), "learned")
