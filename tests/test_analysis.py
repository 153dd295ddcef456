"""The analysis of scores against a plain version."""

import random
from collections import Counter

from hexapla.operators import analysis
from hexapla.operators.vote import LINE, greedy_align


def made(seed):
    """Documents whose rows are some of their lines, with bars, dots and noise between, and rows of other tunes."""
    r = random.Random(seed)
    notes, lines, sung = [], [], []
    for doc in range(6):
        for line in range(4):
            symbols = r.choices("1234567", k=r.randint(3, 7))
            lines.append((doc, line, symbols))
            y, x, codes = 100.0 * line + r.choice([0, 30]), 0.0, []
            for s in symbols if r.random() < 0.8 else r.choices("1234567", k=5):
                codes.append((x, f"c{s}" if r.random() < 0.97 else "odd"))
                if r.random() < 0.2:
                    codes.append((x + 6, "dot"))
                if r.random() < 0.2:
                    codes.append((x + 9, "bar"))
                x += 20.0
            notes += [(doc, 1, y, a, c) for a, c in codes]
            for below in r.sample([12, 24, 40, 55, 80], r.randint(0, 3)):
                sung += [(doc, 1, y + below, 20.0 * k + r.choice([-9, -3, 0, 5, 10]), f"s{k}") for k in range(r.randint(1, 5))]
    return notes, lines, sung


def plain(notes, lines, sung, known, least=4, gap=15.0, window=60.0, block_gap=20.0, tolerance=8.0):
    rows = {}
    for d, p, y, x, c in sorted(notes):
        rows.setdefault((d, p, y), []).append((x, c))
    rows = {k: v for k, v in rows.items() if len(v) >= least}
    matches, votes, cells = [], Counter(), []
    for k, v in rows.items():
        for doc, line, symbols in lines:
            if doc == k[0] and len(v) >= len(symbols):
                got = greedy_align([c for _, c in v], [x for x, _ in v], symbols, known, gap)
                if got:
                    matches.append((*k, line, sorted(got[0].items()), got[1]))
                    votes.update([(c, known[c]) for c in {c for _, c in v} if known.get(c, LINE) != LINE] + list(got[0].items()))
    hits = {m[:3] for m in matches}
    for d, p, y in hits:
        heights = sorted({s[2] for s in sung if s[:2] == (d, p) and y < s[2] <= y + window})
        if not heights:
            continue
        v = rows[d, p, y]
        for place, (sx, syllable) in enumerate(sorted((s[3], s[4]) for s in sung if s[:3] == (d, p, heights[0]))):
            delta, i = min((abs(x - sx), i) for i, (x, _) in enumerate(v))
            wide = delta > tolerance and any(0 <= j < len(v) and abs(sx - (v[i][0] + v[j][0]) / 2) < delta for j in (i - 1, i + 1))
            cells.append((d, p, y, place, syllable, i, v[i][1], delta, 2 if wide else 1))
    learned = {}
    for c in {c for c, _ in votes}:
        n, s = min((-n, s) for (code, s), n in votes.items() if code == c)
        learned[c] = (s, -n, sum(n for (code, _), n in votes.items() if code == c))
    return matches, cells, learned, {(k[0], c) for k in hits for _, c in rows[k] if c not in known}


def frames(spark, notes, lines, sung):
    return (
        spark.createDataFrame(notes, "doc int, page int, y double, x double, code string").repartition(3),
        spark.createDataFrame(lines, "doc int, line int, symbols array<string>"), spark.createDataFrame(sung, "doc int, page int, y double, x double, syllable string"),
    )


def compared(got, want):
    matches, cells, learned, modifiers = want
    found = [(m.doc, m.page, m.y, m.line, [tuple(v) for v in m.learned], m.skipped) for m in got.matches.collect()]
    assert sorted(found) == sorted(matches)
    assert sorted(tuple(c) for c in got.cells.collect()) == sorted(cells)
    assert {v.code: (v.symbol, v.n, v.total) for v in got.votes.collect()} == learned
    assert {tuple(m) for m in got.modifiers.collect()} == modifiers


def test_analysis_with_a_dictionary(spark):
    known = {**{f"c{k}": str(k) for k in range(1, 6)}, "bar": LINE}
    data = made(1)
    want = plain(*data, known)
    assert len(want[0]) > 8 and len(want[1]) > 15 and want[3] and {c[-1] for c in want[1]} == {1, 2}
    compared(analysis.analysed(*frames(spark, *data), spark.createDataFrame(list(known.items()), "code string, symbol string")), want)


def test_analysis_that_learns(spark):
    data = made(2)
    got = analysis.analysed(*frames(spark, *data))
    from hexapla.operators.vote import align_rounds

    notes, lines, sung = frames(spark, *data)
    rows = analysis.melody_rows(notes, 4)
    pairs = rows.join(lines, "doc").filter("size(codes) >= size(symbols)")
    known = {x.code: x.symbol for x in align_rounds(pairs.select("codes", "places", "symbols")).collect()}
    compared(got, plain(*data, known))
    assert {m.code for m in got.marks.collect()} == {c for c, s in known.items() if s == LINE}
    assert analysis.analysed(notes.filter("false"), lines, sung).matches.count() == 0
