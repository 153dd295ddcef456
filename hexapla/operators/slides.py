"""Hymns on slides: lines of slides to notes and lyrics, their hymn by title or lyrics, and the checks of a file.

A slide's lines are classified by columns and windows, never by a loop: a notation line takes the line behind it as its
lyric, unless that is notation too; labels may stand between; what is left over is an orphan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hexapla.functions import notation, values
from hexapla.functions.text import converted, seq_coverage, syllable_count
from hexapla.operators.matching import best_coverage, exact_then_fuzzy

#: Similarity at which a stanza counts as one of the hymn's, and at which it may be.
SURE, PERHAPS = 0.75, 0.45
#: Slides whose lyrics are looked up when the title doesn't tell the hymn.
LOOKED_UP = 3

SLIDE = ["file", "stanza_no"]
# Variant characters that are taken as equal in comparisons.
VARIANTS = {"爲": "為", "裏": "裡", "祢": "你", "禰": "你", "麽": "麼", "么": "麼", "什": "甚", "哪": "那", "牠": "他"}


def compare_text(c: Column, table: dict[str, str] | None = None) -> Column:
    """For comparing titles and lyrics: phrases converted by a ``table`` of simplified and traditional forms, if one is given,
    variants folded, letters a to z, digits and CJK characters only, lower case."""
    text = F.coalesce(c, F.lit(""))
    folded = F.translate(converted(text, table) if table else text, "".join(VARIANTS), "".join(VARIANTS.values()))
    return F.lower(F.regexp_replace(folded, r"[^0-9A-Za-z\x{3400}-\x{9fff}]", ""))


def slide_lines(slides: DataFrame) -> DataFrame:
    """From (file, stanza_no, text), lines ending in CR: (file, stanza_no, pos, line, kind, lyric, ...) of the lines that
    count. ``kind`` is header, label, notes (with its ``lyric``), lyric or orphan; with ``k`` and ``m`` of the slide's last
    ``k/m`` line. That line, what is behind it and lines of punctuation at the end don't count."""
    parts = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\r"), lambda x: F.regexp_replace(x, r"(?U)\s+$", "")), lambda x: F.trim(x) != "")
    rows = slides.select(*SLIDE, F.posexplode_outer(parts).alias("pos", "line"))
    whole = Window.partitionBy(*SLIDE)
    last = F.max(F.when(notation.marker(F.col("line")).isNotNull(), F.struct("pos", notation.marker(F.col("line")).alias("at")))).over(whole)
    rows = rows.withColumn("mark", last).filter("mark is null or pos < mark.pos or pos is null or pos = 0")
    said = (~notation.is_trailer(F.col("line"))) & F.coalesce(F.col("pos") < F.col("mark.pos"), F.lit(True)) & F.col("line").isNotNull()
    rows = rows.withColumns({"k": F.col("mark.at.k"), "m": F.col("mark.at.m"), "end": F.max(F.when(said, F.col("pos"))).over(whole)})
    # one row stays of a slide without lines, so that it is counted
    rows = rows.withColumn("line", F.when(F.coalesce(F.col("pos") <= F.col("end"), F.lit(False)), F.col("line"))).filter("line is not null or coalesce(pos, 0) = 0")
    lines = rows.withColumn("notes", F.coalesce(notation.is_notation(F.col("line")), F.lit(False)))
    head = (F.col("pos") == 0) & F.col("line").isNotNull() & ~F.col("notes")
    order = Window.partitionBy(*SLIDE).orderBy("pos")
    before, after, after_notes = F.lag("notes").over(order), F.lead("line").over(order), F.lead("notes").over(order)
    kind = (
        F.when(F.col("line").isNull(), "none").when(head, "header").when(F.col("notes"), "notes").when(F.coalesce(before, F.lit(False)), "lyric")
        .when(notation.label_of_line(F.col("line")) != "", "label").otherwise("orphan")
    )
    lyric = F.when(F.col("notes") & ~F.coalesce(after_notes, F.lit(True)), F.trim(after)).when(F.col("notes"), "")
    return lines.select(*SLIDE, "pos", "k", "m", F.trim("line").alias("line"), kind.alias("kind"), lyric.alias("lyric"))


def stanzas(lines: DataFrame) -> DataFrame:
    """(file, stanza_no, k, m, header, label, label_kind, pairs, orphans, said, tune) of each slide: ``pairs`` are (line_no,
    notes, lyric); the label is that behind the header, else the first of its own line; ``said`` all lyrics, ``tune`` the
    notes' signature."""
    of = lambda kind, c: F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("pos", *c)))), lambda x: x)
    one = lines.groupBy(*SLIDE).agg(
        F.first("k").alias("k"), F.first("m").alias("m"), F.max(F.when(F.col("kind") == "header", F.col("line"))).alias("head"),
        of("label", ["line"]).alias("labels"), of("notes", ["line", "lyric"]).alias("rows"), F.count_if(F.col("kind") == "orphan").alias("orphans"),
    )
    header = notation.header(F.col("head"))
    own = F.coalesce(notation.label_of_line(F.get(F.col("labels"), F.lit(0))["line"]), F.lit(""))
    label = F.coalesce(F.nullif(header["tail_label"], F.lit("")), own)
    pairs = F.transform("rows", lambda x, i: F.struct((i + 1).alias("line_no"), x["line"].alias("notes"), x["lyric"].alias("lyric")))
    return one.select(
        *SLIDE, "k", "m", F.when(F.col("head").isNotNull(), header).alias("header"), label.alias("label"), notation.label_kind(label)["kind"].alias("label_kind"),
        pairs.alias("pairs"), "orphans", F.array_join(F.transform("rows", lambda x: x["lyric"]), "").alias("said"),
        F.array_join(F.transform("rows", lambda x: notation.signature(x["line"])), "|").alias("tune"),
    )


def file_facts(slides: DataFrame) -> DataFrame:
    """(file, old_no, ..., version, slide_count, period, repeats, marker_ok, structure_ok) of each file, from ``stanzas``: the
    first header's fields, the version by the letter behind the file name's number where the header has none."""
    got = slides.groupBy("file").agg(
        F.min_by("header", F.when(F.col("header").isNotNull(), F.col("stanza_no"))).alias("h"), F.count("*").alias("slide_count"),
        F.transform(F.array_sort(F.collect_list(F.struct("stanza_no", "tune"))), lambda x: x["tune"]).alias("tunes"),
        F.bool_and(F.coalesce(F.col("k") == F.col("stanza_no"), F.lit(False))).alias("numbered"), F.min("m").alias("least"), F.max("m").alias("most"), F.count("m").alias("marked"),
        F.bool_and((F.size("pairs") > 0) & (F.col("orphans") == 0)).alias("structure_ok"),
    )
    suffix = F.regexp_replace(F.regexp_extract("file", r"([^/]*?)(?:\.[^./]*)?$", 1), r"^\d+", "")
    letters = F.create_map(*[F.lit(x) for kv in notation.VERSION_OF_SUFFIX.items() for x in kv])
    version = F.coalesce(F.nullif(F.col("h.version"), F.lit("")), F.try_element_at(letters, F.lower(suffix)), suffix)
    fields = [F.coalesce(F.col(f"h.{c}"), F.lit("")).alias(c) for c in ("old_no", "new_no", "title", "title_line", "key_sig", "time_sig", "tempo")]
    marker = F.col("numbered") & (F.col("marked") == F.col("slide_count")) & (F.col("least") == F.col("slide_count")) & (F.col("most") == F.col("slide_count"))
    period = values.period(F.col("tunes"))
    return got.select("file", *fields, version.alias("version"), "slide_count", period["period"].alias("period"), period["repeats"].alias("repeats"), F.coalesce(marker, F.lit(False)).alias("marker_ok"), "structure_ok")


def hymn_of_files(facts: DataFrame, slides: DataFrame, hymns: DataFrame, verses: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """(file, number, score, kind): each file's hymn. Titles decide, by version where they have one; where they give none or
    several, the lyrics of the first slides are looked up among all verses, and the first slide that is covered by one to
    nine tenths names the hymn (``lyric``). ``hymns`` are (number, title), ``verses`` (number, verse_no, verse)."""
    titles = hymns.select("number", compare_text(F.col("title")).alias("title"))
    asked = facts.select(F.col("file").alias("asked"), compare_text(F.col("title")).alias("name"), "version")
    # items and texts stand in the lookup several times; were they not tables, each would bring the titles' plan with it
    found = keep(exact_then_fuzzy(asked, keep(titles)).withColumnRenamed("asked", "file"))
    known = facts.select("file").join(found, "file", "left").withColumn("kind", F.coalesce("kind", F.lit("none")))
    open_ = slides.join(known.filter("kind in ('none', 'multi')").select("file"), "file", "left_semi")
    first = open_.withColumn("place", F.row_number().over(Window.partitionBy("file").orderBy("stanza_no"))).filter(F.col("place") <= LOOKED_UP)
    items = keep(first.select(F.struct("file", "place").alias("item_id"), compare_text(F.col("said")).alias("item")))
    texts = keep(verses.select(F.struct("number", "verse_no").alias("doc_id"), compare_text(F.col("verse")).alias("text")).filter("text <> ''"))
    said = best_coverage(items, texts, keep=keep).select("item_id.file", "item_id.place", F.col("doc_id.number").alias("l_number"), F.round("coverage", 3).alias("l_score"))
    by_lyric = said.groupBy("file").agg(F.min_by(F.struct("l_number", "l_score"), "place").alias("l"))
    got = known.join(by_lyric, "file", "left")
    there = F.col("l").isNotNull()
    return got.select("file", F.when(there, F.col("l.l_number")).otherwise(F.col("number")).alias("number"), F.when(there, F.col("l.l_score")).otherwise(F.round(F.coalesce("ratio", F.lit(0.0)), 3)).alias("score"), F.when(there, F.lit("lyric")).otherwise(F.col("kind")).alias("kind"))


def stanza_matches(slides: DataFrame, hymn: DataFrame, verses: DataFrame, choruses: DataFrame) -> DataFrame:
    """(file, stanza_no, is_chorus, verse_no, score): what each slide is within its file's hymn. A slide is compared with the
    verses of that hymn only: one that contains its lyrics, else the one that covers most of them, the first of equals. It is
    the chorus if its label says so, or if the chorus covers more of it than any verse and ``SURE`` at least."""
    asked = slides.join(hymn.select("file", "number"), "file").select(*SLIDE, "number", "label_kind", compare_text(F.col("said")).alias("item"))
    texts = verses.select("number", "verse_no", compare_text(F.col("verse")).alias("t")).filter("t <> ''")
    scored = asked.filter("item <> ''").join(texts, "number").withColumn("c", F.round(seq_coverage("item", "t"), 3))
    best = F.min_by(F.struct("verse_no", "c"), F.struct(~F.col("t").contains(F.col("item")), -F.col("c"), "verse_no"))
    verse = scored.groupBy(*SLIDE).agg(best.alias("v")).select(*SLIDE, "v.verse_no", F.col("v.c").alias("verse_score"))
    sung = asked.filter("item <> ''").join(choruses.select("number", compare_text(F.col("chorus")).alias("t")).filter("t <> ''"), "number")
    sung = sung.select(*SLIDE, F.round(seq_coverage("item", "t"), 3).alias("chorus_score"))
    got = slides.select(*SLIDE, "label_kind").join(verse, SLIDE, "left").join(sung, SLIDE, "left")
    got = got.withColumns({"verse_score": F.coalesce("verse_score", F.lit(0.0)), "chorus_score": F.coalesce("chorus_score", F.lit(0.0))})
    chorus = (F.col("label_kind") == "chorus") | ((F.col("chorus_score") > F.col("verse_score")) & (F.col("chorus_score") >= SURE))
    number = F.when(chorus | (F.col("verse_score") == 0), F.lit(0)).otherwise(F.col("verse_no"))
    return got.select(*SLIDE, chorus.alias("is_chorus"), number.cast("int").alias("verse_no"), F.when(chorus, F.col("chorus_score")).otherwise(F.col("verse_score")).alias("score"))


def line_counts(slides: DataFrame) -> DataFrame:
    """(file, stanza_no, line_no, notes, lyric, note_count, rest_count, syllable_count, count_delta, align_ok, noise)."""
    rows = slides.select(*SLIDE, F.explode("pairs").alias("p")).select(*SLIDE, "p.*")
    n, r, s = notation.count_of(F.col("notes"), notation.NOTE_HEADS), notation.count_of(F.col("notes"), notation.RESTS), syllable_count(F.col("lyric"))
    return rows.select("*", n.alias("note_count"), r.alias("rest_count"), s.alias("syllable_count"), (n - s).alias("count_delta"), ((n >= s) & (s > 0)).alias("align_ok"), F.array_join(notation.noise(F.col("notes")), "/").alias("noise"))


def slide_headers(slides: DataFrame, hymns: DataFrame, verses: DataFrame, choruses: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """One row for each file of ``slides`` (file, stanza_no, text): its facts, its hymn, the counts of its lines, and whether
    all checks are passed; ``review_reason`` lists what isn't, in a fixed order.

    The checks are: the hymn is known; slides are numbered k of m; every slide is notes with lyrics and nothing else; the tune
    repeats; all stanzas are the hymn's. Lines with fewer notes than syllables, and noise, are reasons too. ``keep`` writes a
    table and reads it back: the slides are read several times.
    """
    one = keep(stanzas(slide_lines(slides)))
    facts = keep(file_facts(one))
    hymn = keep(hymn_of_files(facts, one, hymns, verses, keep))
    matched = stanza_matches(one, hymn, verses, choruses).groupBy("file").agg(F.count_if("is_chorus").alias("chorus_slides"), F.min("score").alias("verse_score"))
    lines = line_counts(one).groupBy("file").agg(
        F.count("*").alias("pair_count"), F.sum("note_count").alias("note_total"), F.count_if(F.col("count_delta") < 0).alias("short"), F.count_if(F.col("noise") != "").alias("noisy")
    )
    counts = ["pair_count", "note_total", "short", "noisy"]
    got = facts.join(hymn, "file").join(matched, "file").join(lines, "file", "left").fillna(0, counts)
    got = got.withColumn("verse_match", F.when(F.col("verse_score") >= SURE, "ok").when(F.col("verse_score") >= PERHAPS, "partial").otherwise("fail"))
    reason = values.reasons([
        (F.col("kind").isin("none", "multi"), "hymn unknown"), ((F.col("kind") == "fuzzy") & (F.col("verse_match") != "ok"), "title fuzzy"),
        (~F.col("marker_ok"), "numbering"), (~F.col("structure_ok"), "structure"), (~F.col("repeats"), "tune"),
        (F.col("verse_match") != "ok", "lyrics"), (F.col("short") > 0, "too few notes"), (F.col("noisy") > 0, "noise"),
    ])
    return got.withColumn("review_reason", reason).withColumn("ok", F.col("review_reason") == "")
