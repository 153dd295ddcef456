"""One query per operator, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexapla.llm import chat, collocations, contamination, jaccard, language, licences, manifest, packing, passages, quality, secrets, substrings, tokens

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdict of every document."""
    return quality.judged(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses, and a digest of what it keeps, when 50-byte strings of earlier documents are removed."""
    found = substrings.deduplicated(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, lang, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, i, ws[i : i + 4] AS v
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, v) AS c FROM g) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, range(5) AS s(k) GROUP BY doc_id),
c AS (SELECT w.doc_id, lang, source, len(ws)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             len(ls)::BIGINT AS n_lines FROM w LEFT JOIN rep USING (doc_id)),
m AS (SELECT *, 1000 * n_symbols // greatest(word_chars, 1) AS a, 1000 * n_dup_lines // greatest(n_lines, 1) AS b,
             1000 * n_repeat_words // greatest(n_words, 1) AS e, 10 * word_chars // greatest(n_words, 1) AS f FROM c),
v AS (SELECT lang, source, 'a' AS metric, a AS x FROM m WHERE n_words > 0 UNION ALL
      SELECT lang, source, 'b', b FROM m WHERE n_words > 0 UNION ALL
      SELECT lang, source, 'e', e FROM m WHERE n_words > 0 UNION ALL
      SELECT lang, source, 'f', f FROM m WHERE n_words > 0),
s AS (SELECT level, CASE WHEN level < 2 THEN lang END AS lang, CASE WHEN level < 1 THEN source END AS source, metric,
             (x >> greatest(length(bin(x)) - 5, 0)) << greatest(length(bin(x)) - 5, 0) AS cell, count(*) AS n
      FROM v, range(3) AS l(level) GROUP BY ALL),
p AS (SELECT *, CASE WHEN metric = 'a' THEN (cell >> greatest(length(bin(cell)) - 5, 0)) + 16 * greatest(length(bin(cell)) - 5, 0) ELSE cell END AS spot FROM s),
u AS (SELECT *, sum(n) OVER o AS upto, sum(n) OVER w AS total, (sum(n * spot) OVER o)::DOUBLE AS sum_upto, (sum(n * spot) OVER w)::DOUBLE AS sum_all,
             (sum(n * spot * spot) OVER w)::DOUBLE AS squares FROM p
      WINDOW w AS (PARTITION BY level, lang, source, metric), o AS (PARTITION BY level, lang, source, metric ORDER BY cell)),
x AS (SELECT *, sum_upto * total::DOUBLE - sum_all * upto::DOUBLE AS apart FROM u),
y AS (SELECT level, lang, source, metric, cell, total - upto AS above,
             apart * apart / (upto::DOUBLE * (total - upto)::DOUBLE) / (total::DOUBLE * squares - sum_all * sum_all) AS explained
      FROM x WHERE upto < total QUALIFY row_number() OVER (PARTITION BY level, lang, source, metric ORDER BY explained DESC, cell) = 1),
q0 AS (SELECT level, lang, source, metric, min(cell) FILTER (4 * upto >= total) AS q1, min(cell) FILTER (4 * upto >= 3 * total) AS q3,
             max(total) AS n_docs FROM u GROUP BY ALL),
q AS (SELECT level, lang, source, metric, n_docs, q1, q3 + (1 << greatest(length(bin(q3)) - 5, 0)) AS q3 FROM q0),
fence AS (SELECT q.level, q.lang, q.source, q.metric, n_docs,
                 CASE WHEN q.metric = 'f' THEN q3 + 3 * (q3 - q1) WHEN explained >= 0.6 AND above * 4 <= n_docs THEN cell END AS high,
                 CASE WHEN q.metric = 'f' THEN q1 - 3 * (q3 - q1) END AS low
          FROM q LEFT JOIN y ON q.level = y.level AND q.metric = y.metric AND q.lang IS NOT DISTINCT FROM y.lang AND q.source IS NOT DISTINCT FROM y.source),
keys AS (SELECT DISTINCT lang, source, metric FROM v),
best AS (SELECT k.lang, k.source, k.metric, min(f.level) AS level
         FROM keys k JOIN fence f ON k.metric = f.metric AND (f.level = 2 OR (f.n_docs >= 200
              AND f.lang IS NOT DISTINCT FROM k.lang AND (f.level = 1 OR f.source IS NOT DISTINCT FROM k.source)))
         GROUP BY ALL),
lim AS (SELECT b.*, f.low, f.high FROM best b JOIN fence f ON f.metric = b.metric AND f.level = b.level
        AND (b.level = 2 OR (f.lang IS NOT DISTINCT FROM b.lang AND (b.level = 1 OR f.source IS NOT DISTINCT FROM b.source)))),
far AS (SELECT DISTINCT m.doc_id FROM m JOIN lim ON m.lang IS NOT DISTINCT FROM lim.lang
            AND m.source IS NOT DISTINCT FROM lim.source
        WHERE (CASE metric WHEN 'a' THEN a WHEN 'b' THEN b WHEN 'e' THEN e ELSE f END) > high
           OR (metric = 'f' AND f < low)),
j AS (SELECT m.*, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed, far.doc_id IS NOT NULL AS is_far
      FROM m LEFT JOIN far ON m.doc_id = far.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND NOT is_far) AS kept FROM j
"""


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.scanned(_table(spark, sf_dir, "documents"))


def _op5_sql() -> str:
    """The rules matched one by one: positions from the matches and the pieces between them."""
    parts = []
    for i, r in enumerate(secrets.RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(f"""
            SELECT doc_id, {i} AS ord, '{r.kind}' AS kind, {r.least} AS least, string_split_regex(t, '{pattern}') AS p,
                   regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {r.group}) AS g FROM d""")
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    a AS ({" UNION ALL ".join(parts)}),
    e AS (SELECT doc_id, ord, kind, least, m, g, p, unnest(range(1, len(m) + 1)) AS i FROM a WHERE len(m) > 0),
    s AS (SELECT doc_id, ord, kind, length(g[i]) AS n, length(m[i]) AS width,
                 list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS b, least FROM e),
    k AS (SELECT doc_id, ord, kind, b::BIGINT AS b, kind || ':' || b::BIGINT || ':' || (b + width)::BIGINT AS x FROM s WHERE n >= least),
    r AS (SELECT doc_id, count(*) FILTER (ord = 0) AS n0, count(*) FILTER (ord = 1) AS n1, count(*) FILTER (ord = 2) AS n2,
                 string_agg(x, ',' ORDER BY b, ord) FILTER (ord < 3) AS base, string_agg(x, ',' ORDER BY b, ord) AS every
          FROM k GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
    FROM d LEFT JOIN r ON d.doc_id = r.doc_id"""


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """The place of a public tokenizer's vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under Jaccard similarity of 0.75 or more of 5-word shingles, and with how many
    documents it links."""
    return jaccard.linked_documents(_table(spark, sf_dir, "documents"), count=True)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return language.identified(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document packed into sequences of 1024 ids."""
    return packing.packed_documents(_table(spark, sf_dir, "documents"), vocabulary(), end=0)


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as compressed shards and read back."""
    return tokens.round_trip(_table(spark, sf_dir, "documents"), vocabulary(), end=2)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test items found in every document."""
    return contamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that consists of control strings, formatted and read back."""
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.round_trip(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every document."""
    return licences.licences(_table(spark, sf_dir, "documents")).drop("places")


def op11_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses, and a digest of what it keeps, when 50-word windows of earlier documents are removed."""
    found = passages.deduplicated(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents by language, and which of them still prove after some were altered."""
    altered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return manifest.audited(_table(spark, sf_dir, "documents"), altered={"n_chars": F.col("n_chars") + 1}, where=altered)


def _op12_sql() -> str:
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    leaf = lambda n: f"sha256({' || '.join(map(field, ('doc_id', 'source', 'lang', n, 'text')))})"
    bits = "list_reduce(range(8), lambda a, k: xor(a >> 1, CASE WHEN a % 2 = 1 THEN 3988292384 ELSE 0 END), xor(c, b))"
    crc = f"xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda c, b: {bits}, 4294967295), 4294967295)"
    up = lambda name: f"SELECT lev + 1, g, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY lev, g, i // 2, n"
    fold = lambda name, nodes: f"""SELECT f.lev + 1, f.g, f.id, f.at // 2, sha256(CASE WHEN f.at % 2 = 1 THEN s.h || f.h ELSE f.h || coalesce(s.h, '') END), f.proof || coalesce(s.h, ''), (f.n + 1) // 2
            FROM {name} f LEFT JOIN {nodes} s ON s.lev = f.lev AND s.g = f.g AND s.i = xor(f.at, 1) WHERE f.n > 1"""  # noqa: E731
    return f"""
    WITH RECURSIVE d AS (SELECT *, {leaf('n_chars')} AS leaf, {leaf('(n_chars + 1)')} AS other, {crc} % 7 = 0 AS altered FROM documents),
    k AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM d),
    nodes AS (SELECT 0 AS lev, g, i, n, leaf AS h FROM k UNION ALL {up('nodes')}),
    tops AS (SELECT 0 AS lev, 0 AS g, g AS i, (SELECT count(*) FROM nodes WHERE n = 1) AS n, h FROM nodes WHERE n = 1 UNION ALL {up('tops')}),
    low AS (SELECT 0 AS lev, g, i AS id, i AS at, CASE WHEN altered THEN other ELSE leaf END AS h, '' AS proof, n FROM k UNION ALL {fold('low', 'nodes')}),
    high AS (SELECT 0 AS lev, 0 AS g, g || ':' || id AS id, g AS at, h, proof, (SELECT count(*) FROM nodes WHERE n = 1) AS n FROM low WHERE n = 1 UNION ALL {fold('high', 'tops')})
    SELECT k.doc_id, k.leaf, s.h AS subroot, t.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
    FROM k JOIN nodes s ON s.n = 1 AND s.g = k.g JOIN tops t ON t.n = 1 JOIN high f ON f.n = 1 AND f.id = k.g || ':' || k.i"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of each language whose words occur together most beyond chance."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
o AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS (SELECT lang, m, array_to_string(ws[i : i + m - 1], ' ') AS phrase, count(*) AS c FROM o, range(1, 6) AS s(m) WHERE i + m - 1 <= len(ws) GROUP BY ALL),
f AS (SELECT * FROM g WHERE c >= 100),
total AS (SELECT lang, sum(c)::BIGINT AS n FROM g WHERE m = 1 GROUP BY lang),
x AS (SELECT lang, m, phrase, c, string_split(phrase, ' ') AS ws FROM f WHERE m > 1),
inner_ AS (SELECT DISTINCT y.lang, y.phrase FROM x y JOIN (SELECT lang, c, m, unnest(range(2, m)) AS k, ws FROM x) z ON y.lang = z.lang AND y.m = z.k AND z.c >= y.c
           WHERE list_contains(list_transform(range(1, z.m - z.k + 2), lambda i: array_to_string(z.ws[i : i + z.k - 1], ' ')), y.phrase)),
cut AS (SELECT x.*, unnest(range(1, m)) AS k FROM x),
s AS (SELECT cut.lang, cut.phrase, cut.c AS a, l.c AS l, r.c AS r, total.n, k, ((1000 * cut.c::HUGEINT * total.n::HUGEINT) // (l.c::HUGEINT * r.c::HUGEINT))::BIGINT AS score
      FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = array_to_string(ws[1 : k], ' ') JOIN f r ON r.lang = cut.lang AND r.phrase = array_to_string(ws[k + 1 :], ' ')
      JOIN total ON total.lang = cut.lang),
b AS (SELECT * FROM s WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM inner_) QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n, score FROM q WHERE rank <= 2000
"""


QUERIES: dict[str, Query] = {"op1_jaccard": op1_jaccard, "op2_language": op2_language, "op3_packing": op3_packing, "op4_token_ids": op4_token_ids, "op5_secrets": op5_secrets, "op6_substrings": op6_substrings, "op7_quality": op7_quality, "op8_decontamination": op8_decontamination, "op9_chat": op9_chat, "op10_licences": op10_licences, "op11_passages": op11_passages, "op12_manifest": op12_manifest, "op13_collocations": op13_collocations}
ORACLE: dict[str, str] = {"op5_secrets": _op5_sql(), "op7_quality": OP7_SQL, "op12_manifest": _op12_sql(), "op13_collocations": OP13_SQL}
