"""Assembled scores, on events as positioned marks and on conversations as code sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hexapla.functions import notation
from hexapla.operators import analysis, assembly, slides, vote
from hexapla.plans.registry import query
from hexapla.sources.scratch import kept
from hexapla.sources.tables import table


#: Phrase gap, pitch, window, block gap and tolerance of the queries below.
_SIZES = {"gap": 2.0, "pitch": 60.0, "window": 8.0, "block_gap": 2.0, "tolerance": 900.0}


def _marks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events of a user as a page's marks: views are syllables, the others notes on layers, and purchases holds."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("user_id").alias("doc"), F.lit(1).alias("page"), F.floor(F.col("value") / 8).cast("double").alias("y"), (F.unix_timestamp("ts") % 3600).cast("double").alias("x"))
    notes = e.filter("event_type <> 'view'").select("doc", "page", "y", "x", F.col("event_id").alias("note"), (F.col("event_type") == "purchase").alias("hold"))
    return notes, e.filter("event_type = 'view'").select("doc", "page", "y", "x", F.col("event_id").alias("syllable"))


_MARKS = """
    e AS (SELECT event_id, event_type, user_id AS doc, floor(value / 8)::DOUBLE AS y, (floor(epoch(ts))::BIGINT % 3600)::DOUBLE AS x FROM events),
    n AS (SELECT *, event_type = 'purchase' AS hold FROM e WHERE event_type <> 'view'), s AS (SELECT * FROM e WHERE event_type = 'view'),
    h AS (SELECT doc, y, sum(g) OVER (PARTITION BY doc ORDER BY y) AS phrase FROM (SELECT doc, y, CASE WHEN y - lag(y) OVER (PARTITION BY doc ORDER BY y) > 2 THEN 1 ELSE 0 END AS g FROM (SELECT DISTINCT doc, y FROM n))),
    c AS (SELECT doc, phrase, y, count(*) FILTER (NOT hold) AS k FROM n JOIN h USING (doc, y) GROUP BY 1, 2, 3),
    w AS (SELECT doc, y, count(*) AS m FROM s GROUP BY 1, 2),
    nb AS (SELECT p.doc, p.phrase, w.y, w.m FROM (SELECT doc, phrase, max(y) AS bottom FROM c GROUP BY 1, 2) p JOIN w ON w.doc = p.doc AND w.y > p.bottom AND w.y <= p.bottom + 8),
    bl AS (SELECT * FROM (SELECT *, sum(g) OVER (PARTITION BY doc, phrase ORDER BY y) AS island FROM (SELECT *, CASE WHEN y - lag(y) OVER (PARTITION BY doc, phrase ORDER BY y) > 2 THEN 1 ELSE 0 END AS g FROM nb)) WHERE island = 0),
    um AS (SELECT doc, phrase, m FROM (SELECT doc, phrase, m, row_number() OVER (PARTITION BY doc, phrase ORDER BY count(*) DESC, m) AS r FROM bl GROUP BY 1, 2, 3) WHERE r = 1),
    st AS (SELECT bl.doc, bl.phrase, bl.y, bl.m, row_number() OVER (PARTITION BY bl.doc, bl.phrase ORDER BY bl.y) AS stanza FROM bl JOIN um ON bl.doc = um.doc AND bl.phrase = um.phrase AND bl.m = um.m),
    bad AS (SELECT c.doc, c.phrase, c.y, count(*) AS bad FROM c JOIN st ON st.doc = c.doc AND st.phrase = c.phrase AND st.stanza = 1 JOIN s ON s.doc = c.doc AND s.y = st.y
            WHERE (SELECT min(abs(n.x - s.x)) FROM n WHERE n.doc = c.doc AND n.y = c.y) > 900 GROUP BY 1, 2, 3),
    l AS (SELECT doc, phrase, y, k FROM (SELECT c.*, row_number() OVER (PARTITION BY c.doc, c.phrase ORDER BY coalesce(abs(c.k - st.m), 0), coalesce(bad.bad, 0), c.y) AS r
          FROM c LEFT JOIN st ON st.doc = c.doc AND st.phrase = c.phrase AND st.stanza = 1 LEFT JOIN bad ON bad.doc = c.doc AND bad.phrase = c.phrase AND bad.y = c.y) WHERE r = 1),
    d AS (SELECT l.doc, l.phrase, st.stanza, s.event_id, min(abs(s.x - n.x)) AS distance FROM l JOIN st ON st.doc = l.doc AND st.phrase = l.phrase JOIN s ON s.doc = st.doc AND s.y = st.y JOIN n ON n.doc = l.doc AND n.y = l.y GROUP BY 1, 2, 3, 4),
    t AS (SELECT doc, phrase, stanza, count(*) AS syllables, max(distance) AS worst FROM d GROUP BY 1, 2, 3),
    f AS (SELECT l.doc, coalesce(t.stanza, 0)::INT AS stanza, l.k AS notes, coalesce(t.syllables, 0) AS syllables, l.k - coalesce(t.syllables, 0) AS count_delta,
                 l.k = coalesce(t.syllables, 0) AND coalesce(t.worst, 0) <= 900 AS align_ok FROM l LEFT JOIN t ON l.doc = t.doc AND l.phrase = t.phrase)"""


@query("line_facts", f"WITH {_MARKS} SELECT doc, stanza, notes, syllables, count_delta, align_ok FROM f")
def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Melody lines with their stanzas: counts, their difference and alignment."""
    notes, syllables = assembly.assemble(*_marks(spark, sf_dir), **_SIZES)
    return assembly.line_facts(notes, syllables, _SIZES["tolerance"]).drop("line")


@query("score_headers", f"WITH {_MARKS} SELECT doc, count(*) AS lines, sum(notes)::BIGINT AS notes, sum(syllables)::BIGINT AS syllables, count(*) FILTER (count_delta < 0) AS defects, NOT bool_or(count_delta < 0) AS ok FROM f GROUP BY 1")
def score_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of melody lines, and whether any has too few notes."""
    notes, syllables = assembly.assemble(*_marks(spark, sf_dir), **_SIZES)
    return assembly.headers(assembly.line_facts(notes, syllables, _SIZES["tolerance"]), F.lit(False))


@query(
    "header_fields",
    """SELECT p_partkey, p_partkey::VARCHAR AS old_no, CASE WHEN p_partkey % 3 = 0 THEN (p_partkey + 1)::VARCHAR ELSE '' END AS new_no,
       CASE p_partkey % 4 WHEN 0 THEN '甲' WHEN 2 THEN '乙' ELSE '' END AS version, CASE WHEN p_partkey % 11 = 0 THEN '三' ELSE '' END AS tail_label,
       '晨光' || replace(p_name, ' ', '') || '歌' AS title, CASE WHEN p_partkey % 5 = 0 THEN '降E大调' WHEN p_partkey % 5 < 4 THEN 'G调' ELSE '' END AS key_sig,
       CASE WHEN p_partkey % 7 = 0 THEN '' ELSE (2 + p_size % 5)::VARCHAR || '/4' END AS time_sig, CASE WHEN p_partkey % 2 = 0 THEN '♩=' || (60 + p_size) ELSE '' END AS tempo FROM part""",
)
def header_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header lines put together from their fields, in the orders that occur, and taken apart again."""
    line = F.expr("""concat(if(p_partkey % 4 = 0, '(甲)', ''), ' ', p_partkey, if(p_partkey % 4 = 2, ' (乙)', ''), if(p_partkey % 3 = 0, concat(' (', p_partkey + 1, ')'), ''),
        if(p_partkey % 6 < 3, ' 、', ''), '晨光', p_name, '歌  ', if(p_partkey % 5 = 0, ' 降E大调', if(p_partkey % 5 < 4, ' G 调', '')), if(p_partkey % 7 = 0, '', concat(' ', 2 + p_size % 5, ' / 4')),
        if(p_partkey % 2 = 0, concat(' ♩= ', 60 + p_size), ''), if(p_partkey % 11 = 0, '   (三)', ''))""")
    return table(spark, sf_dir, "part").select("p_partkey", notation.header(line).alias("h")).select("p_partkey", "h.*").drop("title_line")


@query(
    "stanza_labels",
    """SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'chorus' WHEN 5 THEN '' ELSE 'verse' END AS kind,
       CASE p_size % 6 WHEN 1 THEN p_size WHEN 2 THEN 1 + p_partkey % 10 ELSE 0 END::INT AS number FROM part""",
)
def stanza_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of stanzas as kind and number: choruses, digits, one numeral, two of them, words, none."""
    label = F.expr("case p_size % 6 when 0 then ' 副歌 ' when 1 then cast(p_size as string) when 2 then substring('一二三四五六七八九十', cast(1 + p_partkey % 10 as int), 1) when 3 then '十一' when 4 then '和散那' else ' ' end")
    return table(spark, sf_dir, "part").select("p_partkey", notation.label_kind(label).alias("l")).select("p_partkey", "l.kind", "l.number")


@query(
    "notation_lines",
    r"""SELECT doc_id, line_no, NOT regexp_matches(line, '[\x{3400}-\x{9fff}\x{3040}-\x{30ff}]') AND length(bare) > 0
              AND length(regexp_replace(bare, '[^1-7qwertyuQWERTYU!#$@adfghjsADFGHJS`/\\|?()\[\]089=ikKPpo_+:.*^~''"%&-]', '', 'g')) * 10 >= 6 * length(bare) AS is_notation,
       length(regexp_replace(line, '[^1-7qwertyuQWERTYU!#$@adfghjsADFGHJS]', '', 'g')) AS notes FROM (
       SELECT doc_id, line_no, ls[line_no + 1] AS line, regexp_replace(ls[line_no + 1], '[\t\n\f\r ]', '', 'g') AS bare
       FROM (SELECT doc_id, ls, unnest(range(0, len(ls)))::INT AS line_no FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)))""",
)
def notation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which lines are notation, and how many notes each has."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.select("doc_id", "line_no", notation.is_notation(F.col("line")).alias("is_notation"), notation.count_of(F.col("line"), notation.NOTE_HEADS).cast("long").alias("notes"))


@query("field_checks", "SELECT doc_id, length(text) = n_chars AS same_size, lang IS NOT DISTINCT FROM CASE WHEN doc_id % 8 = 0 THEN NULL ELSE lang END AS same_lang FROM documents")
def field_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored fields against the source, null-safe."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", (F.length("text") == F.col("n_chars")).alias("same_size"), F.col("lang").eqNullSafe(F.when(F.col("doc_id") % 8 != 0, F.col("lang"))).alias("same_lang"))


_BARRED = """WITH l AS (SELECT doc_id, unnest(string_split(lower(text), chr(10))) AS line FROM documents WHERE lang = 'en'),
    w AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id % 3 = 0 AS barred, regexp_extract_all(line, '[a-z]+') AS ws FROM l),
    p AS (SELECT id, barred, left(md5(x), 5) AS code, upper(x) AS symbol FROM (SELECT id, barred, unnest(ws) AS x FROM w)),
    odd AS (SELECT DISTINCT id FROM p GROUP BY id, code HAVING count(DISTINCT symbol) > 1),
    v0 AS (SELECT DISTINCT code, symbol FROM p WHERE NOT barred AND id NOT IN (SELECT id FROM odd)),
    k0 AS (SELECT code, min(symbol) AS symbol FROM v0 GROUP BY code HAVING count(*) = 1),
    bad AS (SELECT DISTINCT p.id FROM p JOIN k0 USING (code) WHERE p.symbol <> k0.symbol),
    fits AS (SELECT * FROM p WHERE barred AND id NOT IN (SELECT id FROM odd UNION ALL SELECT id FROM bad)),
    v1 AS (SELECT DISTINCT code, symbol FROM fits UNION SELECT * FROM v0),
    k AS (SELECT code, min(symbol) AS symbol FROM v1 GROUP BY code HAVING count(*) = 1
          UNION ALL SELECT 'bar', '|' WHERE (SELECT count(*) FROM fits) >= 2)"""


def _barred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row, codes, places, symbols) of all lines of English documents: words, and five digits of their hashes, which differ
    for most words. In every third document each word has a bar close behind it."""
    line = F.explode(F.split(F.lower("text"), "\n")).alias("line")
    rows = table(spark, sf_dir, "documents").filter("lang = 'en'").select("doc_id", line).select("doc_id", F.regexp_extract_all("line", F.lit("[a-z]+"), F.lit(0)).alias("w"))
    hashed = F.transform("w", lambda x: F.left(F.md5(x), F.lit(5)))
    codes = F.when(F.col("doc_id") % 3 == 0, F.flatten(F.transform(hashed, lambda x: F.array(x, F.lit("bar"))))).otherwise(hashed)
    places = F.transform(codes, lambda c, i: i * 20.0 - F.when(c == "bar", 10.0).otherwise(0.0))
    return rows.filter(F.size("w") > 0).select("doc_id", codes.alias("codes"), places.alias("places"), F.transform("w", F.upper).alias("symbols"))


@query("greedy_votes", f"{_BARRED} SELECT code, symbol FROM k")
def greedy_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary learned from all rows laid on their lines, in rounds (L5, L6, A11, A12). Codes of several words are
    conflicts; rows in which a code would stand for two symbols don't fit; the bar turns out to be a line mark."""
    return vote.align_rounds(_barred(spark, sf_dir), keep=kept)


@query(
    "decoded_rows",
    f"""{_BARRED}, d AS (SELECT id, list_transform(ws, lambda x: left(md5(x), 5)) AS cs FROM w WHERE len(ws) > 0),
        e AS (SELECT id, pos, symbol FROM (SELECT id, unnest(cs) AS code, unnest(range(len(cs))) AS pos FROM d) LEFT JOIN k USING (code)),
        g AS (SELECT id, bool_or(pos = 0 AND symbol IS NULL) AS gone, string_agg(symbol, ' ' ORDER BY pos) AS said FROM e GROUP BY id)
        SELECT sha256(coalesce(CASE WHEN gone THEN NULL ELSE said END, '?')) AS said, count(*) AS n FROM g GROUP BY 1""",
)
def decoded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows decoded by what was learned from them; codes that weren't are merged into the one before (L4)."""
    rows = kept(_barred(spark, sf_dir).select(F.monotonically_increasing_id().alias("row"), "codes", "places", "symbols"))
    got = vote.decoded_rows(rows, vote.align_rounds(rows, keep=kept))
    return got.groupBy(F.sha2(F.coalesce(F.array_join("symbols", " "), F.lit("?")), 256).alias("said")).agg(F.count("*").alias("n"))


@query(
    "row_line_matches",
    """WITH r AS (SELECT user_id AS row, list(event_type ORDER BY ts, event_id)[1:6] AS c FROM events GROUP BY 1), l AS (SELECT o_custkey AS line, list(o_orderpriority ORDER BY o_orderkey)[1:6] AS s FROM orders GROUP BY 1)
       SELECT row, line FROM r JOIN l ON len(c) = len(s) AND len(c) >= 4 WHERE len(list_distinct(list_transform(range(1, len(c) + 1), lambda i: c[i] || '~' || s[i]))) = len(list_distinct(c))""",
)
def row_line_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's first six events against each customer's first six orders: rows whose codes each stand beside one symbol of
    the line (J22)."""
    first = lambda df, by, order, value: df.groupBy(by).agg(F.slice(F.transform(F.array_sort(F.collect_list(F.struct(*order, value))), lambda x: x[value]), 1, 6).alias("s"))
    rows = first(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "event_type").select(F.col("user_id").alias("row"), F.col("s").alias("codes"))
    lines = first(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderkey"], "o_orderpriority").select(F.col("o_custkey").alias("line"), F.col("s").alias("symbols"))
    return vote.all_rows_on_lines(rows, lines, keep=kept)


_FAULTS = "p_partkey % 5 = 1 AS numbering, p_partkey % 11 = 3 AS structure, p_partkey % 7 = 2 AND p_partkey % 13 <> 4 AS tune, p_partkey % 13 = 4 AS short, p_partkey % 3 = 0 AS chorus, p_partkey % 17 = 5 AS renamed"


@query(
    "slide_headers",
    f"""SELECT p_partkey || '.ppt' AS file, p_partkey AS number, CASE WHEN renamed THEN 'lyric' ELSE 'exact' END AS kind, chorus::INT::BIGINT AS chorus_slides, 4::BIGINT AS pair_count,
        CASE WHEN short THEN 22 ELSE 24 END::BIGINT AS note_total, NOT numbering AS marker_ok, NOT structure AS structure_ok, NOT tune AS repeats, 'ok' AS verse_match,
        array_to_string(list_filter([CASE WHEN numbering THEN 'numbering' END, CASE WHEN structure THEN 'structure' END, CASE WHEN tune THEN 'tune' END, CASE WHEN short THEN 'too few notes' END], lambda x: x IS NOT NULL), ';') AS review_reason
        FROM (SELECT p_partkey, {_FAULTS} FROM part)""",
)
def slide_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two slides for each part, some with a fault, and what the checks find.

    The lyrics spell the part's number in CJK characters, each line in another alphabet, so each hymn has its own. The first
    line has a verse number, which is not sung.
    """
    p = table(spark, sf_dir, "part").selectExpr("p_partkey", *[x.strip().replace(" AS ", " as ") for x in _FAULTS.split(", ")])
    spelt = lambda a: F.translate(F.lpad(F.col("p_partkey").cast("string"), 6, "0"), "0123456789", a)
    first, second = (spelt("天地日月山川風雲花草"), spelt("春夏秋冬晨午暮夜星光")), (spelt("東西南北中上下左右前"), spelt("父母兄弟姊妹親友鄰人"))
    name = F.concat(F.lit("讚美"), spelt("一二三四五六七八九十"))
    title = F.when(F.col("renamed"), "不同的名字").otherwise(name)
    notes = lambda other: F.when(F.col("short"), "1 2 3 5 6").when(other, "1 2 3 5 6 6").otherwise("1 2 3 5 6 5")
    more = F.when(F.col("structure"), "（旁白）\r").otherwise("")
    body = lambda said, other, ahead="": F.concat(notes(other), F.lit("\r" + ahead), said[0], F.lit("，\r"), F.lit("5 5 3 3 2 1 |\r"), said[1], F.lit("。\r"))
    one = F.concat(F.col("p_partkey").cast("string"), F.lit("、"), title, F.lit(" G调 3/4 ♩=88\r"), body(first, F.lit(False), "1. "), more, F.lit("1/2\r。"))
    two = F.concat(F.when(F.col("chorus"), "1\r(副歌)\r").otherwise(""), body(second, F.col("tune")), F.when(F.col("numbering"), "2/3").otherwise("2/2"))
    two = F.when(F.col("chorus"), F.substring(two, 3, 1 << 20)).otherwise(two)
    text = F.explode(F.array(F.struct(F.lit(1).alias("stanza_no"), one.alias("text")), F.struct(F.lit(2).alias("stanza_no"), two.alias("text"))))
    shown = p.select(F.concat(F.col("p_partkey").cast("string"), F.lit(".ppt")).alias("file"), text.alias("s")).select("file", "s.*")
    verse = lambda said: F.concat(said[0], F.lit("\n"), said[1])
    texts = F.explode(F.array(F.struct(F.lit(1).alias("verse_no"), verse(first).alias("verse")), F.struct(F.lit(2).alias("verse_no"), F.when(F.col("chorus"), "").otherwise(verse(second)).alias("verse"))))
    verses = p.select(F.col("p_partkey").alias("number"), texts.alias("v")).select("number", "v.*")
    choruses = p.select(F.col("p_partkey").alias("number"), F.when(F.col("chorus"), verse(second)).alias("chorus"))
    got = slides.slide_headers(shown, p.select(F.col("p_partkey").alias("number"), name.alias("title")), verses, choruses, keep=kept)
    return got.select("file", "number", "kind", "chorus_slides", "pair_count", "note_total", "marker_ok", "structure_ok", "repeats", "verse_match", "review_reason")


@query(
    "score_analysis",
    """WITH e AS (SELECT o_custkey AS doc, l_orderkey AS row, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS i, l_quantity::INT % 7 + 1 AS d, l_partkey % 19 - 9 AS off FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
       r AS (SELECT doc, row, list(d ORDER BY i) AS ds, count(*) AS n FROM e GROUP BY 1, 2),
       l AS (SELECT doc, CASE WHEN row % 3 = 0 THEN list_reverse(ds) ELSE ds END AS ds FROM r),
       hit AS (SELECT doc, row, n FROM r WHERE n >= 4 AND EXISTS (SELECT 1 FROM l WHERE l.doc = r.doc AND l.ds = r.ds)),
       s AS (SELECT e.doc, e.row, e.d, hit.n, 20.0 * i + off AS sx, row_number() OVER (PARTITION BY e.row ORDER BY 20.0 * i + off, i) - 1 AS place FROM e JOIN hit ON e.row = hit.row),
       c AS (SELECT s.*, k, abs(20.0 * k - sx) AS dist FROM s, range(40) g(k) WHERE k < n QUALIFY row_number() OVER (PARTITION BY row, place ORDER BY dist, k) = 1)
       SELECT doc, row, place::INT AS place, k::INT AS note, dist::DOUBLE AS distance,
              CASE WHEN dist > 8 AND ((k > 0 AND abs(20.0 * k - 10 - sx) < dist) OR (k < n - 1 AND abs(20.0 * k + 10 - sx) < dist)) THEN 2 ELSE 1 END AS span FROM c""",
)
def score_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of a customer's score, matched with the customer's lines, every third of which is read backward; and the
    syllables below each matched row on its notes (L16, J19, J20, L13)."""
    e = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    i = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")) - 1
    digit = (F.col("l_quantity").cast("int") % 7 + 1).cast("string")
    e = e.select(F.col("o_custkey").alias("doc"), F.lit(1).alias("page"), (F.col("l_orderkey") * 100.0).alias("y"), i.alias("i"), digit.alias("d"), (F.col("l_partkey") % 19 - 9).alias("off"))
    e = kept(e.withColumn("sx", 20.0 * F.col("i") + F.col("off")))
    notes = e.select("doc", "page", "y", (20.0 * F.col("i")).alias("x"), F.concat(F.lit("c"), "d").alias("code"))
    said = F.transform(F.array_sort(F.collect_list(F.struct("i", "d"))), lambda v: v["d"])
    lines = e.groupBy("doc", "y").agg(said.alias("s")).select("doc", F.col("y").alias("line"), F.when((F.col("y") / 100).cast("long") % 3 == 0, F.reverse("s")).otherwise(F.col("s")).alias("symbols"))
    below = F.explode(F.array(F.lit(12.0), F.lit(40.0)))  # the second row is another block
    sung = e.select("doc", "page", "y", "i", "sx", below.alias("down")).select("doc", "page", (F.col("y") + F.col("down")).alias("y"), F.col("sx").alias("x"), F.col("i").alias("syllable"))
    known = spark.range(1, 8).select(F.concat(F.lit("c"), "id").alias("code"), F.col("id").cast("string").alias("symbol"))
    got = analysis.analysed(notes, lines, sung, known, keep=kept)
    return got.cells.select("doc", (F.col("y") / 100).cast("long").alias("row"), "place", "note", "distance", "span")
