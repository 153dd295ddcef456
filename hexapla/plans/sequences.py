"""Ordered sequences on events and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexapla.operators import sequence
from hexapla.plans.registry import query
from hexapla.sources.tables import table


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``sec``, seconds since 1970."""
    return table(spark, sf_dir, "events").withColumn("sec", F.unix_timestamp("ts"))


_EVENTS = "e AS (SELECT *, floor(epoch(ts))::BIGINT AS sec FROM events)"


@query(
    "gap_groups",
    f"""WITH {_EVENTS}, g AS (SELECT *, CASE WHEN sec - lag(sec) OVER w > 3600 THEN 1 ELSE 0 END AS s FROM e WINDOW w AS (PARTITION BY user_id ORDER BY sec, event_id))
        SELECT user_id, event_id, sum(s) OVER (PARTITION BY user_id ORDER BY sec, event_id)::BIGINT AS island FROM g""",
)
def gap_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of events at most an hour apart."""
    return sequence.gap_groups(_events(spark, sf_dir), ["user_id"], ["sec", "event_id"], F.col("sec"), 3600).select("user_id", "event_id", "island")


@query(
    "island_sizes",
    f"""WITH {_EVENTS}, g AS (SELECT *, CASE WHEN sec - lag(sec) OVER w > 3600 THEN 1 ELSE 0 END AS s FROM e WINDOW w AS (PARTITION BY user_id ORDER BY sec, event_id)),
        i AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY sec, event_id) AS island FROM g)
        SELECT user_id, island::BIGINT AS island, count(*) AS n, min(sec) AS begins, max(sec) AS ends FROM i GROUP BY 1, 2""",
)
def island_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each session's size, start and end."""
    g = sequence.gap_groups(_events(spark, sf_dir), ["user_id"], ["sec", "event_id"], F.col("sec"), 3600)
    return g.groupBy("user_id", "island").agg(F.count("*").alias("n"), F.min("sec").alias("begins"), F.max("sec").alias("ends"))


@query(
    "grid_positions",
    f"""WITH {_EVENTS}, s AS (SELECT *, coalesce(greatest(1, round_even((sec - lag(sec) OVER w) / 1800.0, 0)::BIGINT), 1) AS step FROM e WINDOW w AS (PARTITION BY user_id ORDER BY sec, event_id)),
        b AS (SELECT *, sum(step) OVER (PARTITION BY user_id ORDER BY sec, event_id)::BIGINT AS beat FROM s)
        SELECT user_id, event_id, beat, greatest(1, coalesce(lead(beat) OVER (PARTITION BY user_id ORDER BY sec, event_id) - beat, 1)) AS span FROM b""",
)
def grid_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events on a grid of half hours, and the beats to the next."""
    return sequence.grid_positions(_events(spark, sf_dir), ["user_id"], ["sec", "event_id"], F.col("sec"), 1800.0).select("user_id", "event_id", "beat", "span")


_SIDES = f"{_EVENTS}, c AS (SELECT user_id, event_id, sec FROM e WHERE event_type = 'click'), p AS (SELECT user_id, event_id, sec FROM e WHERE event_type = 'purchase')"


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = _events(spark, sf_dir)
    side = lambda t, n: e.filter(F.col("event_type") == t).select("user_id", F.col("event_id").alias(n), F.col("sec").alias(f"{n}_at"))
    return side("click", "click"), side("purchase", "purchase")


@query(
    "nearest_event",
    f"""WITH {_SIDES} SELECT user_id, click, purchase, distance FROM (SELECT c.user_id, c.event_id AS click, p.event_id AS purchase, abs(c.sec - p.sec)::DOUBLE AS distance,
        row_number() OVER (PARTITION BY c.event_id ORDER BY abs(c.sec - p.sec), p.sec, p.event_id) AS r FROM c JOIN p USING (user_id)) WHERE r = 1""",
)
def nearest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The purchase nearest to each click of a user."""
    left, right = _sides(spark, sf_dir)
    out = sequence.nearest(left, right, "user_id", "click", "purchase", "click_at", "purchase_at")
    return out.filter("purchase is not null")


@query(
    "block_below",
    f"""WITH {_SIDES} SELECT user_id, click, purchase FROM (SELECT c.user_id, c.event_id AS click, p.event_id AS purchase,
        row_number() OVER (PARTITION BY c.event_id ORDER BY p.sec, p.event_id) AS r FROM c JOIN p ON c.user_id = p.user_id AND p.sec > c.sec AND p.sec <= c.sec + 86400) WHERE r = 1""",
)
def block_below(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first purchase within a day after each click."""
    left, right = _sides(spark, sf_dir)
    return sequence.first_within(left, right, "user_id", "click", "purchase", "click_at", "purchase_at", 86400)


@query(
    "interval_overlap",
    f"""WITH {_EVENTS}, a AS (SELECT user_id, event_id AS i, sec AS s, sec + 1800 AS t FROM e WHERE event_id % 2 = 0), b AS (SELECT user_id, event_id AS j, sec - 600 AS s, sec + 600 AS t FROM e WHERE event_id % 2 = 1)
        SELECT user_id, i, j FROM a JOIN b USING (user_id) WHERE a.s < b.t AND b.s < a.t""",
)
def interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping spans of a user's even and odd events."""
    e = _events(spark, sf_dir)
    a = e.filter("event_id % 2 = 0").selectExpr("user_id", "event_id as i", "sec as s", "sec + 1800 as t")
    b = e.filter("event_id % 2 = 1").selectExpr("user_id", "event_id as j", "sec - 600 as s", "sec + 600 as t")
    return sequence.overlaps(a, b, "user_id", "i", "j", ("s", "t"), ("s", "t"), 3600.0)


@query(
    "pair_turns",
    """WITH m AS (SELECT *, role = 'user' AS leads, role = 'system' AS label FROM conversations),
       n AS (SELECT *, lead(text) OVER w AS nt, lead(leads) OVER w AS nl, coalesce(lag(leads) OVER w, false) AS a FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
       SELECT conv_id, turn, CASE WHEN leads THEN text END AS lead, CASE WHEN leads THEN CASE WHEN NOT nl THEN nt ELSE '' END ELSE text END AS follow
       FROM n WHERE leads OR (NOT a AND NOT label)""",
)
def pair_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's turn with the answer to it, and answers to nothing."""
    return sequence.pair_lines(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], F.col("role") == "user", F.col("text"), F.col("role") == "system")


@query(
    "header_fill",
    """SELECT conv_id, turn, last_value(CASE WHEN role <> 'assistant' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS header FROM conversations""",
)
def header_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last turn that is a header, filled forward."""
    c = table(spark, sf_dir, "conversations")
    return sequence.forward_fill(c, ["conv_id"], ["turn"], F.when(F.col("role") != "assistant", F.col("text")), "header").select("conv_id", "turn", "header")


@query("blank_before_header", "SELECT conv_id, turn, role <> 'assistant' AND coalesce(lag(role = 'assistant') OVER (PARTITION BY conv_id ORDER BY turn), false) AS blank_before FROM conversations")
def blank_before_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a blank line goes before a turn: a header after an answer."""
    before = F.expr("coalesce(lag(role = 'assistant') over (partition by conv_id order by turn), false)")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", ((F.col("role") != "assistant") & before).alias("blank_before"))


@query("cumulative_offsets", "SELECT conv_id, turn, coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS sec FROM conversations")
def cumulative_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each turn begins in its conversation."""
    return sequence.offsets(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], F.length("text"), "sec").select("conv_id", "turn", "sec")


@query("numbered_lines", "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS seq FROM orders")
def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows numbered within their parent."""
    return sequence.numbered(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "seq")


@query("collision_names", "SELECT p_partkey, CASE WHEN r = 1 THEN p_name ELSE p_name || '_' || r END AS unique_name FROM (SELECT p_partkey, p_name, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS r FROM part)")
def collision_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names made unique by a counter."""
    return sequence.collision_names(table(spark, sf_dir, "part"), "p_name", ["p_partkey"]).select("p_partkey", "unique_name")


@query("best_line", "SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_quantity, l_tax) AS r FROM lineitem) WHERE r = 1")
def best_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's dearest line."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_tax")
    return sequence.best_of(rows, ["l_orderkey"], [F.desc("l_extendedprice"), "l_partkey", "l_suppkey", "l_quantity", "l_tax"]).select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")


@query(
    "positional_match",
    """WITH r AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS k FROM conversations)
       SELECT u.conv_id, u.k, u.text AS asked, a.text AS answered FROM r u LEFT JOIN r a ON u.conv_id = a.conv_id AND u.k = a.k AND a.role = 'assistant' WHERE u.role = 'user'""",
)
def positional_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later rows laid on the slots of the first ones by ordinal."""
    r = sequence.numbered(table(spark, sf_dir, "conversations"), ["conv_id", "role"], ["turn"], "k")
    a = r.filter("role = 'assistant'").select("conv_id", "k", F.col("text").alias("answered"))
    return r.filter("role = 'user'").select("conv_id", "k", F.col("text").alias("asked")).join(a, ["conv_id", "k"], "left")


@query(
    "layers",
    """WITH g AS (SELECT user_id, event_id, round_even(value / 10, 0) AS layer, epoch(ts) AS x FROM events)
       SELECT user_id, layer, event_id, row_number() OVER (PARTITION BY user_id, layer ORDER BY x, event_id) AS slot FROM g""",
)
def layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of a user on layers of rounded height, from left to right (L1)."""
    g = table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("value") / 10).alias("y"), F.unix_micros(F.col("ts").cast("timestamp")).alias("x0"))
    return sequence.layers(g, ["user_id"], "y", 0).select("user_id", "layer", "event_id", "slot")


@query(
    "melody_layers",
    """WITH g AS (SELECT user_id, round_even(value / 10, 0) AS layer, event_type = 'purchase' AS tall FROM events)
       SELECT user_id, layer, count(*) AS n, count(*) FILTER (tall) AS tall FROM g GROUP BY 1, 2 HAVING count(*) >= 2 AND 2 * count(*) FILTER (tall) <= count(*)""",
)
def melody_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers of enough points, not most of them tall (L2)."""
    g = table(spark, sf_dir, "events").select("user_id", F.bround(F.col("value") / 10, 0).alias("layer"), (F.col("event_type") == "purchase").alias("is_tall"))
    return sequence.melody_layers(g, ["user_id"], 2, F.col("is_tall"))


@query(
    "syllable_spans",
    f"""WITH {_EVENTS}, x AS (SELECT user_id, event_id, sec, value * 1000 AS v FROM e),
        d AS (SELECT *, abs(v - (sec % 100000)) AS delta, least(coalesce(abs(v - ((sec % 100000) + lag(sec % 100000) OVER w) / 2.0), 1e18), coalesce(abs(v - ((sec % 100000) + lead(sec % 100000) OVER w) / 2.0), 1e18)) AS mid FROM x WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
        SELECT user_id, event_id, CASE WHEN delta > 8 AND mid < delta THEN 2 ELSE 1 END AS span FROM d""",
)
def syllable_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which points lie nearer to the middle between two elements."""
    e = _events(spark, sf_dir).select("user_id", "event_id", (F.col("value") * 1000).alias("v"), (F.col("sec") % 100000).alias("el"))
    return sequence.syllable_spans(e, ["user_id"], "event_id", F.col("v"), F.col("el"), 8.0).select("user_id", "event_id", "span")
