"""Collocations against a plain version, and the tries by themselves."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hexapla.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split("[.,;:!?\n-\r]", text.translate(LOWER)):
        yield [w for w in re.split("[ \t]", piece) if w]


def brute(rows, least, first, share=100):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for ws in pieces(text or ""):
            n[lang or "und"] += len(ws)
            for d in range(1, 6):
                counts[lang or "und"].update(tuple(ws[i : i + d]) for i in range(len(ws) - d + 1))
    out = []
    for lang, c in counts.items():
        common = {p: a for p, a in c.items() if a >= least and len(p) > 1}
        dropped = {q for p, b in common.items() for d in range(2, len(p)) for i in range(len(p) - d + 1) if 100 * b >= share * c[q := p[i : i + d]]}
        scored = []
        for p, a in common.items():
            if p not in dropped:
                score, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p), c[p[:k]], c[p[k:]]))
        scored.sort(key=lambda x: (x[0], x[1], x[2].encode()))
        out += [(lang, i + 1, p, -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(scored[:first])]
    return sorted(out)


def mixed(seed, texts, size, words):
    r = random.Random(seed)
    vocabulary = ["The", "of", "é", "~", "x\x01", "ß", "'s", *[f"w{k}" for k in range(words)]]
    out = []
    for _ in range(texts):
        parts = [r.choice([*vocabulary, "red fish", "one of us all"]) + r.choice([" "] * 9 + ["  ", "\t", ". ", ",", "\n", "\r\n"]) for _ in range(r.randint(0, size))]
        out.append((r.choice(["en", "en", "en", "de", None, "und"]), "".join(parts)))
    return [*out, ("en", None), (None, ""), ("fr", "seul"), ("en", ".,;"), ("en", " \t ")]


@pytest.mark.parametrize(("least", "first", "share"), [(3, 2000, 100), (8, 5, 100), (4, 50, 60)])
def test_all_cases(spark, least, first, share):
    rows = mixed(least, 60, 120, 12)
    rows += rows[:9]
    docs = spark.createDataFrame([(a, b, 1, "r", 2) for a, b in rows], "lang string, text string, rank int, phrase string, n int").repartition(3)
    got = sorted(tuple(r) for r in collocations.collocations(docs, least, share, first).collect())
    assert got == brute(rows, least, first, share) and any(len(r[2].split(" ")) > 2 for r in got)


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


@pytest.mark.parametrize(("most", "per"), [(4096, 30_000), (2, 15_000)])
def test_ranges(spark, monkeypatch, most, per):
    """Many ranges, which divide a frequent pair of words too, dealt out once and twice."""
    monkeypatch.setattr(collocations, "RANGE_PATHS", per)
    monkeypatch.setattr(collocations, "MOST_RANGES", most)
    r = random.Random(most)
    text = lambda n: " ".join("hot pair" if r.random() < 0.3 else f"v{int(300 * r.random() ** 3)}" for _ in range(n))
    rows = [(r.choice(["en", "de"]), text(4000)) for _ in range(60)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert sorted(tuple(x) for x in collocations.collocations(docs, 20, first=300).collect()) == brute(rows, 20, 300)


def test_tries():
    """Tries written and read, cut anywhere and merged again, are the same."""
    r = random.Random(0)
    texts = [t.encode() for _, t in mixed(5, 30, 80, 9) if t]
    whole = collocations.trie_of(texts)
    paths = lambda t: [(tuple(t.words[c[i] - 1] for c in t.columns if c[i]), n) for i, n in enumerate(t.counts.tolist())]
    plain = Counter(tuple(w.encode() for w in ws[i : i + 5]) for t in texts for ws in pieces(t.decode()) for i in range(len(ws)))
    assert paths(whole) == sorted(plain.items())
    assert paths(collocations.unpack(collocations.pack(whole))) == paths(whole)
    assert paths(collocations.merged([collocations.trie_of(texts[:9]), collocations.trie_of(texts[9:11]), collocations.trie_of(texts[11:])])) == paths(whole)
    keys = [p for p, _ in paths(whole)]
    for cut in [*r.sample(keys, 20), (b"",), (b"zzz",), (b"w1", b"w", b"a"), (b"\xff" * 9,), ()]:
        at = collocations.below(whole, list(cut))
        assert at == sum(k < cut for k in keys)
        parts = [collocations.part(whole, 0, at), collocations.part(whole, at, len(keys))]
        assert paths(parts[0]) + paths(parts[1]) == paths(whole)
        assert paths(collocations.merged([collocations.unpack(collocations.pack(p)) for p in parts[::-1]])) == paths(whole)
    assert paths(collocations.unpack(collocations.pack(collocations.trie_of([])))) == []


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 10)
    text = b"one two three four five six, seven. eight nine ten;" * 3 + b"end"
    got = list(collocations._pieces(text))
    assert len(got) > 3 and [ws for g in got for ws in pieces(g.decode()) if ws] == [ws for ws in pieces(text.decode()) if ws]


def test_ranges_are_dealt_evenly(spark):
    """No task gets many more ranges than another: it reads them at once."""
    r = random.Random(3)
    docs = spark.createDataFrame([("en", " ".join(f"v{r.randrange(5000)}" for _ in range(10_000))) for _ in range(32)], "lang string, text string").repartition(2)
    tries = collocations.built(docs).cache()
    lots = collocations.dealt(tries, collocations.bounds(tries, 10_000), 8)
    each = Counter(row[0] for row in lots.select(F.spark_partition_id(), "range").distinct().collect())
    assert len(each) == 8 and sum(each.values()) > 24 and max(each.values()) - min(each.values()) <= 1


def test_words_of_tries_to_merge_are_no_objects():
    texts = [t.encode() for _, t in mixed(7, 30, 80, 9) if t]
    tries = [collocations.trie_of(texts[:9]), collocations.trie_of([]), collocations.trie_of(texts[9:])]
    bare = [collocations.unlisted(collocations.pack(t)) for t in tries]
    assert not any(isinstance(t.words, list) for t in bare) and [t.words.to_pylist() for t in bare] == [t.words for t in tries]
    whole = collocations.trie_of(texts)
    for got in (collocations.merged(bare), collocations.merged(tries), collocations.merged([bare[0], *tries[1:]])):
        assert got.words == whole.words and [c.tolist() for c in [*got.columns, got.counts]] == [c.tolist() for c in [*whole.columns, whole.counts]]
    assert collocations.merged(bare[:1]).words == tries[0].words and collocations.merged(bare[1:2]).words == []


def test_tasks_return_their_memory(spark, monkeypatch):
    run = []
    monkeypatch.setattr(collocations, "releasing", lambda f: run.append(f.__name__) or f)
    docs = spark.createDataFrame([("en", "a b c")], "lang string, text string")
    tries = collocations.built(docs).cache()
    lots = collocations.dealt(tries, collocations.bounds(tries, 10), 2)
    assert collocations.counted(lots, 1).count() == 6 and collocations.remerged(lots).count() == 1
    assert run == ["build", "cut", "count_", "merge"]


def test_plan_of_parts_does_not_grow_with_depth(spark, capsys):
    """The driver holds a plan and its stages: 52 joins for five words, when each level read the one before twice."""
    nodes = spark.createDataFrame([("en", "a", 1, 9), ("en", "a a", 2, 7), ("en", "a a a", 3, 5), ("en", "a a a a", 4, 3), ("de", "a", 1, 2)], "lang string, phrase string, depth int, n long")
    plans = []
    for depth in (4, 8):
        parts = collocations.with_parts(nodes, depth)
        parts.explain()
        plans.append(capsys.readouterr().out.count("Join"))
        got = {r.phrase: (r.lang, r.n, r.parent, r.suffix, r.lefts, r.rights) for r in parts.collect()}
        assert got == {"a a": ("en", 7, "a", "a", [9], [9]), "a a a": ("en", 5, "a a", "a a", [9, 7], [7, 9]), "a a a a": ("en", 3, "a a a", "a a a", [9, 7, 5], [5, 7, 9])}
    assert plans == [1, 1]


@pytest.mark.parametrize("before", [None, "32m"])
def test_python_tasks_get_small_batches(spark, monkeypatch, before):
    """A task's input in one batch stands beside the executor's heap."""

    def bounded(run):
        def checked(batches):
            def each():
                for b in batches:
                    assert b.num_rows == 1 or b.nbytes < 50_000
                    yield b

            return run(each())

        return checked

    monkeypatch.setattr(collocations, "BATCH_BYTES", 20_000, raising=False)
    monkeypatch.setattr(collocations, "RANGE_PATHS", 10_000)
    monkeypatch.setattr(collocations, "releasing", bounded)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    r = random.Random(2)
    rows = [("en", " ".join(f"v{r.randrange(400)}" for _ in range(2000))) for _ in range(40)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    if before:
        spark.conf.set(key, before)
    try:
        assert sorted(tuple(x) for x in collocations.collocations(docs, 3).collect()) == brute(rows, 3, 2000)
        assert spark.conf.get(key, None) == before
    finally:
        spark.conf.unset(key)
