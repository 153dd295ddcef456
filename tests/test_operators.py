"""Edge cases of operators that the catalogue's tables don't have."""

import re

import pytest
from pyspark.sql import functions as F

from hexapla.functions.blank import BLANKS, is_blank
from hexapla.operators import merge, reconcile, resources, sequence, vote


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_blank_kinds(spark):
    for kind, spellings in BLANKS.items():
        df = spark.createDataFrame([(s,) for s in (*spellings, None, "x")], "v string")
        assert [r[0] for r in df.select(is_blank(F.col("v"), kind)).collect()] == [True] * (len(spellings) + 1) + [False]


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("1", "a", "{}", 1), ("2", None, "{x}", 2)], "no string, name string, audio string, n int")
    new = spark.createDataFrame([("1", "Unknown", "{y}", 5), ("2", "b", "{}", None), ("51_a", "c", "", 7)], "no string, name string, audio string, n int")
    kinds = {"name": "name", "audio": "json_object"}
    out = merge.upsert(old, new, "no", kinds, ("n",))
    assert rows(out) == [("1", "a", "{y}", 5), ("2", "b", "{x}", None), ("51_a", "c", "", 7)]
    blank = new.select("no", F.lit("").alias("name"), F.lit("[]").alias("audio"), "n")
    assert rows(merge.upsert(out, blank.withColumn("audio", F.lit("")), "no", kinds, ("n",))) == rows(out)


def test_upsert_inserts_as_it_comes(spark):
    """A new key is a plain insert: its blanks are values, and columns without a rule are taken too."""
    old = spark.createDataFrame([("1", "a", "completed", 5, "x")], "no string, name string, status string, n int, own string")
    new = spark.createDataFrame([("2", "Unknown", "pending", 7), ("1", "Unknown", "pending", 6)], "no string, name string, status string, n int")
    out = merge.upsert(old, new, "no", {"name": "name", "status": "download_status"})
    assert rows(out) == [("1", "a", "completed", 5, "x"), ("2", "Unknown", "pending", 7, None)]


def test_diff_states(spark):
    src = spark.createDataFrame([("1", "t1"), ("2", "t0"), ("3", ""), ("4", "t"), ("6", "t")], "no string, up string")
    dst = spark.createDataFrame([("1", "t1", "r"), ("2", "t1", "r"), ("3", "t", "r"), ("5", "t", "r"), ("6", "t", None)], "no string, up string, raw string")
    assert rows(merge.snapshot_diff(src, dst, "no", "up", "raw")) == [("1", "same"), ("2", "changed"), ("3", "same"), ("4", "new"), ("5", "site_only"), ("6", "changed")]


def test_migrate_refuses(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert merge.migrate(df, {"c": F.lit(0)}, ["b", "a", "c"]).columns == ["b", "a", "c"]
    with pytest.raises(ValueError, match="unknown"):
        merge.migrate(df, {}, ["a"])
    assert merge.table_difference(df, df.select("b", "a")).count() == 0


def test_status_texts(spark):
    df = spark.createDataFrame([(0, 0), (2, 2), (2, 0), (3, 1)], "e int, t int")
    assert [r[0] for r in df.select(reconcile.status_text(F.col("e"), F.col("t"))).collect()] == ["no_files", "completed", "failed", "partial(1/3)"]


def test_versions(spark):
    items = spark.createDataFrame([("1", 0, "vocal", "http://h/a.mp4"), ("1", 1, "vocal", "http://h/b.mp4?x"), ("1", 2, "piano", None), ("1", 3, "_meta", "x"), ("1", 4, None, "x")], "no string, pos int, category string, url string")
    found = {r.category: (r.url, r.filename, r.ext, r.reason) for r in resources.versions(items).collect()}
    assert found == {"vocal": ("http://h/b.mp4?x", "b.mp4", "m4a", None), "piano": (None, None, "mp3", "no_url")}
    assert set(resources.version_map(resources.versions(items)).first()["versions"]) == {"vocal", "piano"}


def test_nearest_ties_and_absence(spark):
    left = spark.createDataFrame([("k", 1, 5.0), ("k", 2, 10.0), ("z", 3, 0.0)], "k string, l int, x double")
    right = spark.createDataFrame([("k", 10, 4.0), ("k", 11, 6.0), ("k", 12, 10.0), ("k", 13, 10.0)], "k string, r int, y double")
    assert rows(sequence.nearest(left, right, "k", "l", "r", "x", "y")) == [("k", 1, 10, 1.0), ("k", 2, 12, 0.0), ("z", 3, None, None)]
    assert rows(sequence.first_within(left, right, "k", "l", "r", "x", "y", 2.0)) == [("k", 1, 11)]


def test_overlaps_are_strict_and_single(spark):
    a = spark.createDataFrame([("k", 1, 0.0, 10.0), ("k", 2, 10.0, 11.0), ("k", 3, 5.0, 5.0)], "k string, i int, s double, t double")
    b = spark.createDataFrame([("k", 7, 2.0, 10.0), ("k", 8, 10.0, 20.0), ("q", 9, 0.0, 99.0)], "k string, j int, s double, t double")
    assert rows(sequence.overlaps(a, b, "k", "i", "j", ("s", "t"), ("s", "t"), 1.0)) == [("k", 1, 7), ("k", 2, 8)]


def test_grid_half_even(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 31.5), (3, 84.0), (4, 85.0)], "i int, x double").withColumn("g", F.lit(0))
    out = sequence.grid_positions(df, ["g"], ["x", "i"], F.col("x"), 21.0)
    assert [(r.beat, r.span) for r in out.orderBy("i").collect()] == [(1, 2), (3, 2), (5, 1), (6, 1)]


def test_pairs(spark):
    lines = [("n", "1 2"), ("t", "words"), ("t", "orphan"), ("n", "3"), ("n", "4"), ("l", "label"), ("l", "other"), ("n", "5")]
    df = spark.createDataFrame([(0, i, k, t) for i, (k, t) in enumerate(lines)], "f int, i int, kind string, t string")
    out = sequence.pair_lines(df, ["f"], ["i"], F.col("kind") == "n", F.col("t"), F.col("kind") == "l")
    assert [(r.lead, r.follow) for r in out.orderBy("i").collect()] == [("1 2", "words"), (None, "orphan"), ("3", ""), ("4", "label"), ("5", "")]


def test_isomorphic(spark):
    df = spark.createDataFrame([(["a", "b", "a"], ["1", "2", "1"]), (["a", "a"], ["1", "2"]), (["a"], ["1", "2"])], "c array<string>, s array<string>")
    assert [r[0] for r in df.select(sequence.isomorphic(F.col("c"), F.col("s"))).collect()] == [True, False, False]


def test_layers_and_spans(spark):
    g = spark.createDataFrame([("d", 1, 5.04, 3.0), ("d", 1, 5.01, 1.0), ("d", 1, 9.0, 2.0)], "doc string, page int, cy double, x0 double")
    out = sequence.layers(g, ["doc", "page"], "cy")
    assert [(r.layer, r.slot) for r in out.orderBy("layer", "slot").collect()] == [(5.0, 1), (5.0, 2), (9.0, 1)]
    s = spark.createDataFrame([(1, 0.0, 0.0), (2, 30.0, 20.0), (3, 40.0, 40.0)], "i int, x double, e double").withColumn("g", F.lit(0))
    assert [r.span for r in sequence.syllable_spans(s, ["g"], "i", F.col("x"), F.col("e"), 8.0).orderBy("i").collect()] == [1, 2, 1]


def test_votes(spark):
    v = spark.createDataFrame([("1", "b"), ("1", "a"), ("1", "b"), ("1", "a"), ("2", "c")], "code string, symbol string")
    assert rows(vote.majority(v, "code", "symbol", 2, 50)) == [("1", "a", 2, 4)]
    assert rows(vote.majority(v, "code", "symbol", 2, 51)) == []
    assert rows(vote.without_conflicts(v, "code", "symbol")) == [("2", "c")]


def test_anchors_and_pairs():
    a, b = list("abcde?ghijk"), list("abcdeFghijk")
    assert vote.anchor_blocks(a, b) == [(0, 0, 5), (6, 6, 5)]
    assert vote.anchor_blocks(["?"] * 4, ["?"] * 4) == []
    codes = [f"c{x}" for x in range(11)]
    assert vote.pair_votes(codes, a, b) == [("c5", "F")]
    assert vote.pair_votes(codes, list("abcde?ghijk"), list("abcdeFXghijk")) == []
    assert vote.pair_votes(codes[:4], list("a?c?"), list("abcd")) == []
    # from an anchor to the next known element, ahead and behind
    assert vote.pair_votes(codes, list("12345?7?"), list("12345678")) == [("c5", "6")]
    assert vote.pair_votes(codes, list("?1?34567"), list("x1234567")) == [("c2", "2")]
    assert vote.pair_votes(codes, list("?1?34567"), list("x9234567")) == []
    # two anchors of three cover enough together; unknown elements don't count against the coverage
    assert vote.pair_votes(codes, list("123?567??"), list("1234567")) == [("c3", "4")]


def test_longest_runs():
    import random
    from difflib import SequenceMatcher

    r = random.Random(2)
    for _ in range(400):
        a, b = (r.choices("abc" if r.random() < 0.7 else "ab", k=r.randint(0, 14)) for _ in "xy")
        a = [x if r.random() < 0.9 else "?" for x in a]
        found = SequenceMatcher(None, [x if x != "?" else f"?{k}" for k, x in enumerate(a)], b, autojunk=False).find_longest_match()
        assert vote.Runs(b).longest(a, "?") == ((found.a, found.b, found.size) if found.size else (0, 0, 0))


def test_greedy_alignment():
    far = [0.0, 20.0, 40.0, 60.0]
    assert vote.greedy_align(["x", "y", "x"], far, ["1", "2", "1"], {}, 15) == ({"x": "1", "y": "2"}, [])
    assert vote.greedy_align(["x", "x"], far, ["1", "2"], {}, 15) is None  # one code, two symbols
    assert vote.greedy_align(["bar", "x"], far, ["1"], {"bar": "|"}, 15) == ({"x": "1"}, [])
    assert vote.greedy_align(["x", "dot", "y"], [0.0, 8.0, 25.0], ["1", "2"], {}, 15) == ({"x": "1", "y": "2"}, ["dot"])
    assert vote.greedy_align(["x", "dot", "y"], far, ["1", "2"], {"x": "1"}, 15) == ({"dot": "2"}, ["y"])  # behind the end, unknown codes may follow
    assert vote.greedy_align(["x", "y"], far, ["1"], {"x": "1"}, 15) == ({}, ["y"])
    assert vote.greedy_align(["x", "y"], far, ["1"], {"x": "1", "y": "2"}, 15) is None  # a known note is left over
    assert vote.greedy_align(["x"], far, ["1", "2"], {}, 15) is None
    assert vote.greedy_align([], [], [], {}, 15) == ({}, [])


def test_alignment_in_rounds(spark):
    """A clean row starts it; what it teaches lets others align; conflicts are unlearned, marks fixed after two skips."""
    data = [
        (list("abc"), [0.0, 20.0, 40.0], list("123")),
        (list("a.b"), [0.0, 5.0, 20.0], list("12")),
        (list("d.c"), [0.0, 5.0, 20.0], list("43")),
        (list("xy"), [0.0, 20.0], list("56")), (list("xz"), [0.0, 20.0], list("77")),
    ]
    rows_ = spark.createDataFrame(data, "codes array<string>, places array<double>, symbols array<string>").repartition(2)
    got = {r.code: r.symbol for r in vote.align_rounds(rows_).collect()}
    assert got == {"a": "1", "b": "2", "c": "3", "d": "4", "y": "6", ".": "|"} or got == {"a": "1", "b": "2", "c": "3", "d": "4", "y": "6", "z": "7", ".": "|"}
    known = spark.createDataFrame([("a", "1"), ("b", "2"), ("bar", "|")], "code string, symbol string")
    asked = spark.createDataFrame([(1, ["a", "?", "b", "bar", "a"]), (2, ["?", "a"]), (3, []), (4, ["bar", "?", "b"]), (5, None)], "row int, codes array<string>")
    assert {r.row: r.symbols for r in vote.decoded_rows(asked, known).collect()} == {1: ["1", "2", "1"], 2: None, 3: [], 4: ["2"], 5: None}


def test_rows_on_lines(spark):
    """Rows against lines, all pairs, with and without a key; a symbol may stand for several codes."""
    import random

    r = random.Random(5)
    make = lambda n, letters: [(k % 3, k, r.choices(letters, k=r.randint(0, 7))) for k in range(n)]
    rows_, lines = make(60, "abcd"), make(80, "123")
    df, dl = spark.createDataFrame(rows_, "doc int, row int, codes array<string>"), spark.createDataFrame(lines, "doc int, line int, symbols array<string>")
    fits = lambda c, s: len(c) == len(s) >= 4 and len(set(zip(c, s, strict=True))) == len(set(c))
    want = [(i, k) for _, i, c in rows_ for _, k, s in lines if fits(c, s)]
    assert rows(vote.rows_on_lines(df, dl)) == sorted(want, key=str) and len(want) > 20
    want = [(d, i, k) for d, i, c in rows_ for e, k, s in lines if d == e and fits(c, s)]
    assert rows(vote.rows_on_lines(df, dl, ["doc"])) == sorted(want, key=str)


def test_all_rows_on_lines(spark, monkeypatch):
    """All pairs, in blocks: each pair once, and no pair of a row and a line is compared, only shapes are."""
    import random

    r = random.Random(6)
    make = lambda n, letters: [(k, r.choices(letters, k=r.randint(0, 7))) for k in range(n)]
    rows_, lines = make(90, "abcd"), make(120, "123")
    df, dl = spark.createDataFrame(rows_, "row int, codes array<string>"), spark.createDataFrame(lines, "line int, symbols array<string>")
    fits = lambda c, s: len(c) == len(s) >= 4 and len(set(zip(c, s, strict=True))) == len(set(c))
    want = [(i, k) for i, c in rows_ for k, s in lines if fits(c, s)]
    compared = []
    monkeypatch.setattr(vote, "BLOCK", 3)
    real = vote.rows_on_lines
    monkeypatch.setattr(vote, "rows_on_lines", lambda a, b, **k: compared.append((a, b)) or real(a, b, **k))
    assert rows(vote.all_rows_on_lines(df, dl)) == sorted(want, key=str) and len(want) > 50
    shapes = lambda seqs: len({tuple(s.index(x) for x in s) for _, s in seqs if len(s) >= 4})
    assert [(a.count(), b.count()) for a, b in compared] == [(shapes(rows_), shapes(lines))]


@pytest.mark.parametrize("rounds", [1, 4])
def test_learning_rounds_against_a_plain_version(spark, rounds):
    """Lines of texts, their rarer words unknown: the same dictionary as by rounds in plain Python."""
    from collections import Counter

    from hexapla.sources.scratch import kept

    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect() if r.text]
    said = [re.findall("[a-z]+", line.lower()) for t in texts for line in t.split("\n")]
    # some lines are noisy: a word in three is another's
    lines = [(k, [f"c{w}" for w in ws], [("x" + w if k % 5 == 0 and i % 3 == 0 else w) for i, w in enumerate(ws)]) for k, ws in enumerate(said) if ws]
    often = Counter(w for _, codes, _ in lines for w in codes)
    seed = {c: c[1:] for c, n in often.items() if n >= 6}
    known, votes, todo = dict(seed), {}, {k for k, _, _ in lines}
    for _ in range(rounds):
        for k, codes, symbols in lines:
            if k in todo:
                votes[k] = vote.pair_votes(codes, [known.get(c, "?") for c in codes], symbols) if any(c not in known for c in codes) and any(c in known for c in codes) else []
        tally = Counter((c, s) for v in votes.values() for c, s in v)
        fresh = {}
        for c in {c for c, _ in tally} - known.keys():
            n, s = min((-n, s) for (code, s), n in tally.items() if code == c)
            total = sum(n for (code, _), n in tally.items() if code == c)
            if -n >= 2 and -n * 100 >= 60 * total:
                fresh[c] = s
        if not fresh:
            break
        known |= fresh
        todo = {k for k, codes, _ in lines if fresh.keys() & set(codes)}
    df = spark.createDataFrame(lines, "line long, codes array<string>, symbols array<string>").repartition(3)
    got = {r.code: r.symbol for r in vote.learn_rounds(df, spark.createDataFrame(list(seed.items()), "code string, symbol string"), 2, 60, rounds, kept).collect()}
    assert got == known and len(known) > len(seed) + 20


def test_learning_rounds(spark):
    """A code learned in one round is the anchor that teaches the next; only lines that hold a new code are looked at again."""
    lines = [("abcde?ghijk", "abcdeFghijk")] * 2 + [("xyFzzw", "xyFzzw")] * 2 + [("abc", "abc"), ("qqqq", "qqqq"), ("", "")]
    codes = [[f"c{x}" if x != "?" else "cF" for x in a] for a, _ in lines]
    df = spark.createDataFrame([(k, c, list(b)) for k, (c, (_, b)) in enumerate(zip(codes, lines, strict=True))], "line long, codes array<string>, symbols array<string>").repartition(2)
    seed = spark.createDataFrame([(f"c{x}", x) for x in "abcdeghijkxyz"], "code string, symbol string")
    learned = vote.learn_rounds(df, seed, 2, 60)
    assert set(rows(learned)) - {(f"c{x}", x) for x in "abcdeghijkxyz"} == {("cF", "F")}
    assert rows(vote.learn_rounds(df, seed, 3, 60)) == rows(seed)
    assert rows(vote.learn_rounds(df.filter("false"), seed, 2, 60)) == rows(seed)


def test_reports(spark):
    from hexapla.operators import reports

    df = spark.createDataFrame([("a", None)], "a string, b string")
    with pytest.raises(ValueError, match="without"):
        reports.map_lines(df, ["a", "b"])
    wide = spark.createDataFrame([("ab", 2)], "t string, w int")
    row = wide.select(reports.centred(F.col("t"), F.col("w"), 5).alias("c"), reports.text_width(F.col("t"), {"a": 0.5}).alias("x"), reports.repaired(F.lit("ÖÐ")).alias("g")).first()
    assert tuple(row) == (" ab  ", 1.5, "中")


def test_fuzzy_titles_lose_nothing(spark):
    import itertools
    from difflib import SequenceMatcher

    from hexapla.operators import matching

    titles = [(k, "".join(t)) for k, t in enumerate([*itertools.product("abcd", repeat=3), *itertools.product("ab", "cd", "ab", "ef"), *itertools.product("ae", "bf", "c", "dg", "h")])]
    names = ["ac", "xa", "bxdx", "axcx", "abd", "a", "abcdh", "ebgh", "acbfe", "bdbe", "zz"]
    got = {r.asked: (r.number, r.ratio) for r in matching.exact_then_fuzzy(spark.createDataFrame(list(enumerate(names)), "asked int, name string"), spark.createDataFrame(titles, "number int, title string")).collect()}
    for k, name in enumerate(names):
        exact = [(1.0, i) for i, t in titles if t == name]
        best = exact or sorted((-SequenceMatcher(None, name, t, autojunk=False).ratio(), i) for i, t in titles)
        ratio, number = abs(best[0][0]), best[0][1]
        assert got.get(k) == ((number, ratio) if ratio >= 0.75 else None), name
    assert 0 in got


def test_titles_in_cjk_and_by_version(spark):
    """Every pair of short titles is found that the ratio allows; version marks keep versions apart."""
    import random
    from difflib import SequenceMatcher

    from hexapla.operators import matching

    r = random.Random(3)
    titles = [(k, "".join(r.choices("主耶穌我愛恩典之光", k=r.randint(1, 9)))) for k in range(250)]
    names = [(k, "".join(r.choices("主耶穌我愛恩典之光", k=r.randint(1, 9)))) for k in range(250)] + [(900, "恩典"), (901, "主耶穌")]
    titles += [(300, "恩之典之"), (301, "主我耶我穌")]
    single = {t for _, t in titles if sum(u == t for _, u in titles) == 1}
    got = {x.asked: (x.number, x.ratio, x.kind) for x in matching.exact_then_fuzzy(spark.createDataFrame(names, "asked int, name string"), spark.createDataFrame(titles, "number int, title string")).collect()}
    for k, name in names:
        same = [i for i, t in titles if t == name]
        if same:
            assert got[k] == (min(same), 1.0, "exact" if len(same) == 1 else "multi")
            continue
        best = min(((-SequenceMatcher(None, name, t, autojunk=False).ratio(), i) for i, t in titles if t in single), default=(0, 0))
        assert got.get(k) == ((best[1], -best[0], "fuzzy") if best[0] <= -0.75 else None), name
    asked = spark.createDataFrame([(1, "萬古靈磐", "甲"), (2, "萬古靈磐", "乙"), (3, "萬古靈磐", ""), (4, "", ""), (5, "萬古靈磐", "丙")], "asked int, name string, version string")
    known = spark.createDataFrame([("51_a", "萬古靈磐甲"), ("51_b", "萬古靈磐乙"), ("9", "甲"), ("8", "")], "number string, title string")
    found = {x.asked: x.number for x in matching.exact_then_fuzzy(asked, known).collect()}
    assert found == {1: "51_a", 2: "51_b", 3: "51_a"}
    one = spark.createDataFrame([(1, "恩典"), (2, "主耶穌")], "asked int, name string")
    two = spark.createDataFrame([(1, "恩之典"), (2, "主我耶我穌")], "number int, title string")
    assert {x.asked: round(x.ratio, 3) for x in matching.exact_then_fuzzy(one, two).collect()} == {1: 0.8, 2: 0.75}


def test_coverage_of_cjk_and_containment(spark):
    """Items without word boundaries, against all pairs."""
    import random
    from difflib import SequenceMatcher

    from hexapla.operators import matching

    r = random.Random(4)
    docs = ["".join(r.choices("主耶穌我愛恩典之光在天上的父", k=r.randint(5, 60))) for _ in range(60)] + ["plain words here", ""]
    items = []
    for k in range(40):
        d = r.choice(docs[:60])
        a = r.randint(0, max(0, len(d) - 20))
        x = list(d[a : a + r.randint(2, 25)])
        for _ in range(r.randint(0, 2)):
            x[r.randrange(len(x))] = "新"
        items.append("".join(x))
    i, d = spark.createDataFrame(list(enumerate(items)), "item_id int, item string"), spark.createDataFrame(list(enumerate(docs)), "doc_id int, text string")
    want = []
    for k, x in enumerate(items):
        best = min((-(1.0 if x in y else sum(b.size for b in SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks()) / len(x)), j) for j, y in enumerate(docs))
        want += [(k, best[1], -best[0])] if best[0] <= -0.9 else []
    assert rows(matching.best_coverage(i, d)) == sorted(want, key=str) and len(want) > 15
    more = spark.createDataFrame([(100, "words"), (101, "n words h"), (102, ""), (103, "在天")], "item_id int, item string").unionByName(i)
    held = {(x.item_id, x.item): x.item for x in more.collect()}
    assert rows(matching.contained(more, d)) == sorted([(k, j) for (k, x) in held for j, y in enumerate(docs) if x and x in y], key=str)


def test_coverage_of_short_and_edited_items(spark):
    from difflib import SequenceMatcher

    from hexapla.operators import matching

    words = [f"{a}{b}ord" for a in "bcdfgh" for b in "aeiou"]
    items = ["sing", "sing to joy", "sing to the king of joy", " ".join(words[:15]), " ".join(words[10:30]), "!?", "", " ".join(words[3:9])]
    docs = ["oh sing to the kinh of joy!", "we sing to joy", "all " + " ".join(words[:15]), " ".join([*words[10:19], "x", *words[20:30]]), "what!?", "sing to the king of joy", " ".join(words[2:10])]
    i, d = spark.createDataFrame(list(enumerate(items)), "item_id int, item string"), spark.createDataFrame(list(enumerate(docs)), "doc_id int, text string")
    want = []
    for k, x in enumerate(items):
        best = min((-(1.0 if x in y else sum(b.size for b in SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks()) / len(x)), j) for j, y in enumerate(docs))
        want += [(k, best[1], -best[0])] if x and best[0] <= -0.9 else []
    assert rows(matching.best_coverage(i, d)) == sorted(want, key=str)


def test_coverage_of_edited_items_of_all_lengths(spark):
    """Characters changed, dropped and put between, as many as an item may lose, anywhere: as all pairs."""
    import random
    from difflib import SequenceMatcher

    from hexapla.operators import matching

    r = random.Random(9)
    cjk = [chr(0x4E00 + k) for k in range(900)]
    docs = ["".join(r.choices(cjk, k=r.randint(20, 400))) for _ in range(40)] + [" ".join("".join(r.choices("abcdefghiklmnoprstuvwy", k=r.randint(3, 9))) for _ in range(r.randint(10, 60))) for _ in range(40)] + ["", None]
    items = []
    for _ in range(150):
        d = r.choice(docs[:80])
        a = r.randint(0, max(0, len(d) - 60))
        x = list(d[a : a + r.randint(12, 300)])
        for _ in range(r.randint(0, len(x) // 10)):
            at, how = r.randrange(len(x)), r.random()
            x[at : at + 1] = ["新"] if how < 0.5 else [] if how < 0.75 else [x[at], "#"]
        items.append("".join(x))
    words = docs[60].split(" ")
    items += [" ".join(w[:-1] + "ß" if k % 4 == 0 else w for k, w in enumerate(words)), docs[3], docs[3][:12], docs[3][5:18]]
    i, d = spark.createDataFrame(list(enumerate(items)), "item_id int, item string"), spark.createDataFrame(list(enumerate(docs)), "doc_id int, text string")
    want = []
    for k, x in enumerate(items):
        best = min((-(1.0 if x in y else sum(b.size for b in SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks()) / len(x)), j) for j, y in enumerate(docs) if y)
        want += [(k, best[1], -best[0])] if best[0] <= -0.9 else []
    assert rows(matching.best_coverage(i, d)) == sorted(want, key=str) and len(want) > 130


def test_lookup_of_hymns_reads_tables(spark, monkeypatch):
    """What is looked up by lyrics are tables, not the plan of the titles' matching once more for each use."""
    from hexapla.operators import slides
    from hexapla.sources.scratch import kept

    plans = []

    def covered(items, docs, keep):
        plans.extend(df._jdf.queryExecution().optimizedPlan().toString() for df in (items, docs))
        return spark.createDataFrame([(("f", 1), (7, 1), 1.0)], "item_id struct<file: string, place: int>, doc_id struct<number: int, verse_no: int>, coverage double")

    monkeypatch.setattr(slides, "best_coverage", covered)
    facts = spark.createDataFrame([("f", "甲乙丙", ""), ("g", "天地日月", "")], "file string, title string, version string")
    said = spark.createDataFrame([("f", 1, "山川風雲"), ("g", 1, "花草")], "file string, stanza_no int, said string")
    hymns = spark.createDataFrame([(7, "春夏秋冬"), (8, "天地日月")], "number int, title string")
    verses = spark.createDataFrame([(7, 1, "山川風雲"), (8, 1, "花草")], "number int, verse_no int, verse string")
    got = {r.file: (r.number, r.kind) for r in slides.hymn_of_files(facts, said, hymns, verses, kept).collect()}
    assert got == {"f": (7, "lyric"), "g": (8, "exact")}
    assert len(plans) == 2 and not any("Join" in p or "Window" in p for p in plans)


def test_coverage_leaves_out_what_cannot_win(spark, monkeypatch):
    """Without short items nobody counts characters, and texts behind the first that has an item whole are not compared; a text
    before it, which has the item with something between, is, and wins."""
    import pandas as pd

    from hexapla.operators import matching

    def compared(part, whole, percent):
        if any("不比" in t for t in whole):
            raise ValueError("compared")
        return pd.Series([0.95] * len(part))

    monkeypatch.setattr(matching, "coverage_from", F.pandas_udf(compared, "double"))
    monkeypatch.setattr(matching, "_by_rare_characters", lambda *a: pytest.fail("characters counted"))
    item, other = "".join(chr(0x4E00 + k) for k in range(40)), "".join(chr(0x5E00 + k) for k in range(40))
    docs = [other[:20] + "新" + other[20:], "甲" + item, "乙" + item, item[:20] + "不比" + item[20:]]
    i, d = spark.createDataFrame([(1, item), (2, other)], "item_id int, item string"), spark.createDataFrame(list(enumerate(docs)), "doc_id int, text string")
    assert rows(matching.best_coverage(i, d)) == [(1, 1, 1.0), (2, 0, 0.95)]


def test_candidates_grow_with_the_rows(spark):
    """Ten times the rows, ten times the pairs to compare."""
    import random

    from hexapla.operators import segments

    counts = []
    for n in (300, 3000):
        r = random.Random(n)
        texts = [(k, "".join(chr(0x4E00 + int(5000 * r.random() ** 2)) for _ in range(40))) for k in range(n)]
        items = [(k, t[3:30]) for k, t in texts if k % 3 == 0]
        counts.append(segments.candidates(spark.createDataFrame(items, "item_id int, item string"), spark.createDataFrame(texts, "doc_id int, text string"), 90).count())
    assert counts[0] >= 100 and counts[1] <= 11 * counts[0]


def test_deletion_needs_equal_digests(spark):
    from hexapla.sources import files

    twins = spark.createDataFrame([("p", "d", "d"), ("q", "d", "e"), ("r", None, None)], "path string, digest string, twin_digest string")
    assert [r.path for r in files.deletable(twins).collect()] == ["p"]


def test_lines_of_slides(spark):
    """Headers, labels, pairs, orphans, what stands behind the number, and slides with nothing on them."""
    from hexapla.operators import slides

    texts = [
        ("a", 1, "7、来 ♩=80 (三)\r1 2 3\r主愛我\r(副歌)\r5 6\r5 5\r旁白\r又一行\r1/3\r。\r後面"),
        ("a", 2, "1 2 3\r主愛我\r( 二 )\r3 2 1\r我愛主\r。\r…"),
        ("a", 3, None), ("b", 1, "   \r \r"), ("b", 2, "只有標題"), ("b", 3, "3/3"),
    ]
    df = spark.createDataFrame(texts, "file string, stanza_no int, text string").repartition(2)
    got = {(r.file, r.stanza_no): r for r in slides.stanzas(slides.slide_lines(df)).collect()}
    assert len(got) == 6
    a = got["a", 1]
    assert [(p.line_no, p.notes, p.lyric) for p in a.pairs] == [(1, "1 2 3", "主愛我"), (2, "5 6", ""), (3, "5 5", "旁白")]
    assert (a.k, a.m, a.orphans, a.label, a.label_kind, a.header.title, a.header.old_no, a.tune, a.said) == (1, 3, 1, "三", "verse", "来", "7", "123|56|55", "主愛我旁白")
    b = got["a", 2]
    assert (b.k, b.header, b.label, b.orphans, len(b.pairs)) == (None, None, "二", 0, 2)
    for key in (("a", 3), ("b", 1), ("b", 3)):
        assert (got[key].pairs, got[key].orphans, got[key].label) == ([], 0, "")
    assert got["b", 2].header.title_line == "只有標題" and got["b", 3].k == 3
    facts = {r.file: r for r in slides.file_facts(slides.stanzas(slides.slide_lines(df))).collect()}
    assert (facts["a"].slide_count, facts["a"].title, facts["a"].marker_ok, facts["a"].structure_ok) == (3, "来", False, False)
    assert slides.slide_lines(df.filter("false")).count() == 0


def test_chorus_or_verse(spark):
    from hexapla.operators import slides

    verses = [("1", 1, "主愛我我知道"), ("1", 2, "因聖經告訴我"), ("2", 1, "因聖經告訴我"), ("1", 3, "")]
    shown = [("f", 1, "", "主愛我，我知道"), ("f", 2, "", "因聖經告訢我"), ("f", 3, "", "是主真愛我"), ("f", 4, "chorus", "另外的字"), ("f", 5, "", ""), ("g", 1, "", "因聖經告訴我")]
    s = spark.createDataFrame(shown, "file string, stanza_no int, label_kind string, said string")
    v = spark.createDataFrame(verses, "number string, verse_no int, verse string")
    c = spark.createDataFrame([("1", "是主真愛我是主真愛我"), ("2", None)], "number string, chorus string")
    hymn = spark.createDataFrame([("f", "1"), ("g", None)], "file string, number string")
    got = rows(slides.stanza_matches(s, hymn, v, c))
    assert got == [("f", 1, False, 1, 1.0), ("f", 2, False, 2, 0.833), ("f", 3, True, 0, 1.0), ("f", 4, True, 0, 0.0), ("f", 5, False, 0, 0.0), ("g", 1, False, 0, 0.0)]
