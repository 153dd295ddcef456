"""Matching of titles and passages that are nearly equal. Candidates are blocked first, so that nothing is compared with
everything."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hexapla.functions.notation import VERSIONS
from hexapla.functions.text import coverage_from, seq_ratio
from hexapla.operators import segments


def _runs(c: Column, size: int) -> Column:
    """The distinct runs of ``size`` characters; the whole of a shorter text."""
    n = F.greatest(F.length(c) - (size - 1), F.lit(1))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(c, i, F.lit(size))))


def exact_then_fuzzy(asked: DataFrame, titles: DataFrame, percent: int = 75) -> DataFrame:
    """From (asked, name[, version]) and (number, title): (asked, number, ratio, kind). Equal titles come first, ``exact`` or,
    where several numbers have the title, ``multi`` with the lowest; else, as ``fuzzy``, the title of the greatest
    matching-blocks ratio, ``percent`` at least, ties to the lower number. Titles of several numbers match exactly only. A
    title that ends in a version mark is compared without it, and not at all with a name of another version. Empty names
    and titles match nothing.

    Candidates share a run of two characters, or a character where both are short. M matches without a common run have M - 1
    gaps, so two titles of L characters together, M of them at least ``percent`` L / 200, have at most 200 / (3 ``percent``
    - 200) characters; none is lost. (At two thirds and less, all share single characters.)
    """
    both = 200 // (3 * percent - 200) if 3 * percent > 200 else None
    keys = lambda c: F.array_distinct(F.concat(_runs(c, 2), F.when(F.lit(both is None) | (F.length(c) < (both or 0)), _runs(c, 1)).otherwise(F.array())))
    asked = asked.select("asked", "name", F.coalesce("version", F.lit("")).alias("version") if "version" in asked.columns else F.lit("").alias("version")).filter("name <> ''")
    one = titles.filter("title <> ''").groupBy("title").agg(F.min("number").alias("number"), F.count("*").alias("n"))
    equal = asked.join(one, F.col("name") == F.col("title"))
    exact = equal.select("asked", "number", F.lit(1.0).alias("ratio"), F.when(F.col("n") == 1, "exact").otherwise("multi").alias("kind"))
    marked = F.right("title", F.lit(1)).isin(*VERSIONS)
    base = F.when(marked, F.expr("left(title, length(title) - 1)")).otherwise(F.col("title"))
    known = one.filter("n = 1").select("number", base.alias("base"), F.when(marked, F.right("title", F.lit(1))).otherwise("").alias("mark")).filter("base <> ''")
    known = known.withColumn("run", F.explode(keys(F.col("base"))))
    rest = asked.join(exact.select("asked"), "asked", "left_anti").withColumn("run", F.explode(keys(F.col("name"))))
    la, lb = F.length("name"), F.length("base")
    fits = (F.col("version") == "") | (F.col("mark") == "") | (F.col("version") == F.col("mark"))
    pairs = rest.join(known, "run").filter(fits & (200 * F.least(la, lb) >= percent * (la + lb))).select("asked", "name", "number", "base").distinct()
    near = pairs.withColumn("ratio", seq_ratio("name", "base")).filter(F.col("ratio") * 100 >= percent)
    best = near.groupBy("asked").agg(F.min_by(F.struct("number", "ratio"), F.struct(-F.col("ratio"), "number")).alias("b"))
    return exact.unionByName(best.select("asked", "b.number", "b.ratio", F.lit("fuzzy").alias("kind")))


def _by_rare_characters(items: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, item_id) of documents that may have ``percent`` of an item's characters, none lost.

    Such a document lacks few of them, so it has one of the item's rarest characters, taken until they are more than it may
    lack. Only documents with so many of the item's characters, each as often, are left.
    """
    letters = lambda df, i, c: df.select(i, F.explode(F.split(c, "")).alias("ch")).filter("ch <> ''").groupBy(i, "ch").agg(F.count("*").alias("n"))
    there = letters(docs, "doc_id", "text")
    wanted = letters(items, "item_id", "item")
    often = there.groupBy("ch").agg(F.count("*").alias("df")).join(wanted.select("ch").distinct(), "ch", "left_semi")
    order = Window.partitionBy("item_id").orderBy(F.coalesce("df", F.lit(0)), "ch")
    size = F.sum("n").over(Window.partitionBy("item_id"))
    ranked = wanted.join(often, "ch", "left").withColumns({"before": F.sum("n").over(order) - F.col("n"), "size": size})
    need = F.ceil(percent * F.col("size") / 100)
    keys = ranked.filter(F.col("before") <= F.col("size") - need).select("item_id", "ch", need.alias("need"))
    pairs = there.select("doc_id", "ch").join(keys, "ch").select("doc_id", "item_id", "need").distinct()
    both = pairs.join(wanted.withColumnRenamed("n", "m"), "item_id").join(there, ["doc_id", "ch"])
    return both.groupBy("doc_id", "item_id", "need").agg(F.sum(F.least("n", "m")).alias("shared")).filter("shared >= need").select("doc_id", "item_id")


def _short_pairs(items: DataFrame, docs: DataFrame, percent: int) -> DataFrame | None:
    """(doc_id, item_id, item, text) by rare characters; None if there are no items, so that nobody counts the documents'
    characters for them."""
    return None if items.isEmpty() else _by_rare_characters(items, docs, percent).join(items, "item_id").join(docs, "doc_id")


#: Items of fewer characters are looked for by their rarest characters.
SHORT = 12


def best_coverage(items: DataFrame, docs: DataFrame, percent: int = 90, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """From (item_id, item) and (doc_id, text): (item_id, doc_id, coverage) of the document that covers most of each item, in
    order, ``percent`` at least, ties to the lower doc_id. Empty items match nothing.

    An item of ``SHORT`` characters or more that may lose k of them is looked for by k + 1 segments: all documents are found
    that lack some of its characters, or have others between them, at no more than k places together. Shorter items are
    looked for by their rarest characters, whatever stands between them. ``keep`` writes a table and reads it back.
    """
    items, docs = items.select("item_id", "item").filter("item <> ''"), docs.select("doc_id", "text")
    length = F.length("item")
    fits = (length >= SHORT) & segments.segment_size(length, percent).isNotNull()
    pairs = segments.candidates(items.filter(fits), docs, percent, keep)
    pairs = pairs if (short := _short_pairs(items.filter(~fits), docs, percent)) is None else pairs.unionByName(short)
    # a text that contains the item covers all of it: those behind the first such one need not be compared
    seen = keep(pairs.select("item_id", "doc_id", "item", F.col("text").contains(F.col("item")).alias("whole")))
    first = seen.filter("whole").groupBy("item_id").agg(F.min("doc_id").alias("first"))
    asked = seen.filter("not whole").join(first, "item_id", "left").filter(F.col("first").isNull() | (F.col("doc_id") < F.col("first")))
    # comparing takes long, and few pairs would else be left in a few tasks
    spread = asked.join(docs, "doc_id").repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "item_id", "doc_id")
    scored = spread.select("item_id", "doc_id", coverage_from("item", "text", F.lit(percent)).alias("coverage"))
    scored = scored.unionByName(first.select("item_id", F.col("first").alias("doc_id"), F.lit(1.0).alias("coverage")))
    best = scored.groupBy("item_id").agg(F.min_by(F.struct("doc_id", "coverage"), F.struct(-F.col("coverage"), "doc_id")).alias("b"))
    return best.select("item_id", "b.doc_id", "b.coverage").filter(F.col("coverage") * 100 >= percent)


def contained(items: DataFrame, docs: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """From (item_id, item) and (doc_id, text): (item_id, doc_id) where the document contains the item. Empty items are left
    out. An item is its only segment; of one character, it is looked for by that."""
    items, docs = items.select("item_id", "item").filter("item <> ''"), docs.select("doc_id", "text")
    one = segments.segment_size(F.length("item"), 100).isNull()
    pairs = segments.candidates(items.filter(~one), docs, 100, keep)
    pairs = pairs if (short := _short_pairs(items.filter(one), docs, 100)) is None else pairs.unionByName(short)
    return pairs.filter(F.col("text").contains(F.col("item"))).select("item_id", "doc_id")


def tolerant_join(one: DataFrame, two: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name, found): rows of ``one`` with whether ``two`` has a row of the same key whose name is equal, or contains it
    or is contained in it. Empty names are in every other."""
    other = two.select(F.col(key).alias("_k"), F.col(name).alias("_n"))
    fits = (F.col(key) == F.col("_k")) & ((F.col(name) == F.col("_n")) | F.col(name).contains(F.col("_n")) | F.col("_n").contains(F.col(name)))
    return one.select(key, name).join(other, fits, "left_semi").withColumn("found", F.lit(True)).unionByName(one.select(key, name).join(other, fits, "left_anti").withColumn("found", F.lit(False)))


def chorus_lines(lyrics: DataFrame, choruses: DataFrame, long: int = 6) -> DataFrame:
    """(number, line_no) of lines (number, line_no, stanza_no, text) that are the chorus: they have the first stanza only, and a
    line of the number's official chorus (number, chorus) is equal or, from ``long`` characters of the text on, contains it or
    is contained in it. Texts are compared as they come; empty ones and empty lines of the chorus are no match."""
    alone = lyrics.groupBy("number", "line_no").agg(F.count_distinct("stanza_no").alias("n"), F.min("stanza_no").alias("only"))
    asked = lyrics.filter("stanza_no = 1 and text <> ''").join(alone.filter("n = 1 and only = 1").select("number", "line_no"), ["number", "line_no"])
    official = choruses.select(F.col("number").alias("c_number"), F.explode(F.array_distinct(F.split("chorus", r"\r?\n|\r"))).alias("line")).filter("line <> ''")
    fits = (F.col("text") == F.col("line")) | ((F.length("text") >= long) & (F.col("line").contains(F.col("text")) | F.col("text").contains(F.col("line"))))
    return asked.join(official, (F.col("number") == F.col("c_number")) & fits, "left_semi").select("number", "line_no").distinct()
