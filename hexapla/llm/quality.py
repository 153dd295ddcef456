"""Quality rules with adaptive thresholds (built-in functions only).

Each document gets integer metrics from its whole text. Mergeable quantile sketches of the metrics are kept per
language and source: log-linear histograms that keep the five leading bits of a value, so that counts of equal cells
add up in any order and a quantile is off by less than one part in sixteen, always to the lower side. Sketches of
groups below ``min_docs`` documents are merged upwards: language and source, then language, then all. The thresholds
come from the sketches alone and are joined back to the documents: for word length, which has a spread, fences beyond
the quartiles; for shares that are nought in most documents, and whose quartiles say nothing, the cut of the sketch that
sets its upper part apart best, by the variance between both parts. A cut that explains too little of the variance, or
has too many documents above it, is no threshold, and the group has none for that metric.

Defined cases: a null or empty text has no words, fails the base rules and is not kept. Null languages or sources are
groups of their own. Repeated rows are each judged and returned. An empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hexapla.llm.common import WORD, let, without, written

WINDOW = 5
#: How each metric gets its thresholds: fences in interquartile ranges, low and high; or a cut, in the metric's unit or by
#: its cells' ranks, which are as logarithms (symbols spread over orders of magnitude).
METRICS = {"symbols_pm": "ranks", "dup_lines_pm": "values", "repeat_pm": "values", "word_len_x10": "fences"}
#: Interquartile ranges from the quartiles to the fences.
RANGES = 3
#: A cut must explain so much of the variance, and have one document in so many above it at most.
EXPLAINED, ONE_IN = 0.6, 4
#: Groups with fewer documents take the thresholds of the group above.
MIN_DOCS = 200


def _repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words that lie in a window of ``window`` words found twice or more in the array."""

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(p: Column) -> Column:
            twin = lambda k: F.get(p, k)["h"]
            found = F.filter(p, lambda x, k: F.coalesce(twin(k - 1) == x["h"], F.lit(False)) | F.coalesce(twin(k + 1) == x["h"], F.lit(False)))
            return F.sort_array(F.transform(found, lambda x: x["i"]))

        def length(at: Column) -> Column:
            steps = F.transform(at, lambda a, k: F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - a, F.lit(window))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)

        return let(let(pairs, places), length)

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - window), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(window)]))
    return F.when(F.size(words) < window + 1, F.lit(0).cast("long")).otherwise(
        let(hashes, lambda h: F.when(F.size(h) == F.size(F.array_distinct(h)), F.lit(0).cast("long")).otherwise(covered(h)))
    )


def features(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each row's whole text. Windows are compared by their 64-bit hash."""
    text = F.coalesce(F.col("text"), F.lit(""))
    of_words = let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("r")))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d")))
    counted = docs.select(
        "doc_id", "lang", "source", of_words.alias("w"), of_lines.alias("l"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
    )
    return counted.select(
        "doc_id", "lang", "source", F.col("w.n").alias("n_words"), "word_chars", "n_symbols",
        F.col("l.d").alias("n_dup_lines"), F.col("w.r").alias("n_repeat_words"), F.col("l.n").alias("n_lines"),
    )


def _metrics() -> dict[str, str]:
    return {
        "symbols_pm": "1000 * n_symbols div greatest(word_chars, 1)",
        "dup_lines_pm": "1000 * n_dup_lines div greatest(n_lines, 1)",
        "repeat_pm": "1000 * n_repeat_words div greatest(n_words, 1)",
        "word_len_x10": "10 * word_chars div greatest(n_words, 1)",
    }


def cell(value: Column) -> Column:
    """The sketch's cell of a value: the value with all but its five leading bits cleared."""
    shift = F.greatest(F.length(F.bin(value)) - 5, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def rank(cell_: Column) -> Column:
    """The cell's place among the cells: its leading bits, and sixteen for each bit that was cleared."""
    shift = F.greatest(F.length(F.bin(cell_)) - 5, F.lit(0))
    return (F.call_function("shiftright", cell_, shift) + 16 * shift).cast("long")


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, metric, cell, n) over documents with words; merging two sketches is adding ``n`` by cell."""
    parts = F.array(*[F.struct(F.lit(m).alias("metric"), cell(F.col(m)).alias("cell")) for m in METRICS])
    return (
        measured.filter("n_words > 0").select("lang", "source", F.explode(parts).alias("p"))
        .groupBy("lang", "source", F.col("p.metric").alias("metric"), F.col("p.cell").alias("cell"))
        .agg(F.count("*").alias("n"))
    )


def thresholds(sketch: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, metric, low, high, n_docs) for each language and source, from the sketch of the narrowest group
    that has ``min_docs`` documents. A value is far if it is above ``high`` or below ``low``."""
    level = F.explode(F.array(*[F.lit(k) for k in range(3)])).alias("level")
    leveled = sketch.select(
        level, "lang", "source", "metric", "cell", "n"
    ).withColumns({"lang": F.when(F.col("level") < 2, F.col("lang")), "source": F.when(F.col("level") < 1, F.col("source"))})
    merged = leveled.groupBy("level", "lang", "source", "metric", "cell").agg(F.sum("n").alias("n"))
    by = lambda kind: F.col("metric").isin([m for m, k in METRICS.items() if k == kind])
    merged = merged.withColumn("at", F.when(by("ranks"), rank(F.col("cell"))).otherwise(F.col("cell")))
    key = ["level", "lang", "source", "metric"]
    whole, upto = Window.partitionBy(*key), Window.partitionBy(*key).orderBy("cell")
    run = merged.withColumns({
        "upto": F.sum("n").over(upto), "total": F.sum("n").over(whole),
        "sum_upto": F.sum(F.expr("n * at")).over(upto).cast("double"), "sum": F.sum(F.expr("n * at")).over(whole).cast("double"),
        "squares": F.sum(F.expr("n * at * at")).over(whole).cast("double"),
    })
    # between the parts' means; divided by the product of the parts' sizes and by the variance it is the part explained
    apart = run.withColumn("apart", F.expr("sum_upto * total - sum * upto"))
    explained = F.expr("case when upto < total then apart * apart / (double(upto) * (total - upto)) / (total * squares - sum * sum) end")
    scored = apart.withColumn("explained", explained)
    quartile = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("cell")))
    cut = F.max(F.when(F.col("explained").isNotNull(), F.struct("explained", (-F.col("cell")).alias("less"), (F.col("total") - F.col("upto")).alias("above"))))
    # the upper quartile by its cell's end: where all values are in a cell, that cell is the spread
    q3 = quartile(3) + F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.length(F.bin(quartile(3))) - 5, F.lit(0)))
    groups_ = scored.groupBy(*key).agg(quartile(1).alias("q1"), q3.alias("q3"), F.max("total").alias("n_docs"), cut.alias("cut"))
    good = (F.col("cut.explained") >= EXPLAINED) & (F.col("cut.above") * ONE_IN <= F.col("n_docs"))
    fences = groups_.withColumns({
        "high": F.when(by("fences"), F.expr(f"q3 + {RANGES} * (q3 - q1)")).when(good, -F.col("cut.less")).cast("long"),
        "low": F.when(by("fences"), F.expr(f"q1 - {RANGES} * (q3 - q1)")).cast("long"),
    })
    groups = sketch.select("lang", "source", "metric").distinct()
    pick = None
    for k in range(3):
        f = fences.filter((F.col("level") == k) & ((F.col("n_docs") >= min_docs) | F.lit(k == 2)))
        f = f.select(F.lit(k).alias("level"), F.col("lang").alias("f_lang"), F.col("source").alias("f_source"), F.col("metric").alias("f_metric"), "low", "high", "n_docs")
        on = F.col("metric") == F.col("f_metric")
        on = on & F.col("lang").eqNullSafe(F.col("f_lang")) if k < 2 else on
        on = on & F.col("source").eqNullSafe(F.col("f_source")) if k < 1 else on
        part = groups.join(f, on).select("lang", "source", "metric", "level", "low", "high", "n_docs")
        pick = part if pick is None else pick.unionByName(part)
    best = pick.groupBy("lang", "source", "metric").agg(F.min_by(F.struct("low", "high", "n_docs"), "level").alias("b"))
    return best.select("lang", "source", "metric", "b.low", "b.high", "b.n_docs")


def measured(docs: DataFrame) -> DataFrame:
    """The counts of each row with the metrics made from them, written to the shared folder."""
    return written(features(docs), "quality-counts").withColumns({m: F.expr(e) for m, e in _metrics().items()})


def judged(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Each row's counts, metrics, ``base_failed``, ``kept`` and ``failed`` (the metrics that were far).

    The counts are written to the shared folder once, since both the sketches and the filter read them. The thresholds
    have one row per language and source; they too are written, so that Spark broadcasts them by their known size and
    otherwise joins by shuffle, splitting hot groups.
    """
    rows = measured(docs)
    wide = thresholds(sketches(rows), min_docs).groupBy("lang", "source").pivot("metric", list(METRICS)).agg(F.first("low").alias("low"), F.first("high").alias("high"))
    limits = written(wide.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), *[F.col(f"{m}_{x}") for m in METRICS for x in ("low", "high")]).coalesce(1), "quality-thresholds")
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    failed = F.array_compact(F.array(*[F.when(F.coalesce(F.col(m) > F.col(f"{m}_high"), F.lit(False)) | F.coalesce(F.col(m) < F.col(f"{m}_low"), F.lit(False)), F.lit(m)) for m in METRICS]))
    base = F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")
    return joined.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *METRICS,
        base.alias("base_failed"), failed.alias("failed"),
    ).withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))


def quality_filter(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns.

    Verdicts are joined back by doc_id. Rows of equal ids stay if one of them is kept; ids are unique in a corpus, so
    this only matters for malformed input. A null doc_id is matched as a value.
    """
    return without(docs, judged(docs, min_docs).filter("kept"), keep=True)
