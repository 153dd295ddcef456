"""The registered queries against their SQL, and the pipeline against a plain version of it."""

import hashlib
import random
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from compare import connect, same_rows  # noqa: E402
from hexapla.llm import chat, contamination, packing, quality, queries, secrets  # noqa: E402
from test_ops import brute_components, brute_spans, check_packing  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    same_rows(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE) - {"op8_decontamination", "op9_chat"}))
def test_whole_tables(spark, name):
    ids = {r.doc_id for r in queries.QUERIES[name](spark, SF).select("doc_id").distinct().collect()}
    assert ids == {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}


def test_decontamination_of_the_whole_table(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in queries.op8_decontamination(spark, SF).collect()}
    index = contamination.ItemIndex(items)
    assert got == {(i, f[0]) for i, t in texts for f in index.search(t.encode())}
    assert {(i, k) for i, t in texts for k, x in items if x in t} <= got and got


def test_chat_of_the_whole_table(spark):
    turns = defaultdict(list)
    for r in sorted(spark.read.parquet(f"{SF}/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)):
        turns[r.conv_id].append((r.role, r.text or ""))
    turns[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = set()
    for c, ts in turns.items():
        loss = "".join(t for r, t in ts if r == "assistant")
        want.add((c, len(ts), digest("".join(f"{r}\n{t}\n" for r, t in ts)), len(loss), digest(loss), len(chat.chatml(ts))))
    assert {tuple(r) for r in queries.op9_chat(spark, SF).collect()} == want


def test_pipeline_in_all_cases(spark, tmp_path):
    """Nulls in all columns, empty and very long texts, repeated rows and ties, columns of inner names, an empty table."""
    import corpus_pipeline

    r = random.Random(2)
    prose = lambda n: " ".join(f"{r.choice('abcdefgh')}{r.randint(0, 10**6)}" for _ in range(n))
    item, long, same = prose(40), prose(60_000), prose(80)
    texts = [(1, same), (2, same), (3, same + " tail"), (4, None), (5, ""), (6, long), (7, f"{prose(60)} {item} {prose(60)}"), (8, prose(60) + " password: abcdefgh12"), (9, prose(50)), (9, prose(55)), (None, prose(70)), (10, "few words only")]
    rows = [(i, t, None if i == 9 else "en", None if i == 8 else "s", None if i == 9 else len(t or ""), "x", 1) for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rank string, length int").repartition(3)
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    for name, table in (("documents.parquet", docs), ("none", docs.filter("false"))):
        table.write.parquet(f"file://{tmp_path}/{name}")
    seen, now = [], spark.read.parquet(f"file://{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.written(stage(spark, now, f"file://{tmp_path}"), "test-stage")
        assert now.columns == docs.columns
        seen.append(sorted((x.doc_id or 0) for x in now.collect()))
    assert seen == [[0, 1, 2, 3, 6, 7, 8, 9, 9], [0, 1, 6, 7, 8, 9, 9], [0, 1, 6, 8, 9, 9], [0, 1, 6, 8, 9, 9]]
    kept = {(x.doc_id, x.text) for x in now.collect()}
    check_packing(corpus_pipeline.run(spark, f"file://{tmp_path}").collect(), sorted(kept, key=str), packing.SIZE)
    assert "[secret]" in next(t for i, t in kept if i == 8) and next(t for i, t in kept if i == 6) == long
    empty = spark.read.parquet(f"file://{tmp_path}/none")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, f"file://{tmp_path}").count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "packing"]
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in quality.judged(docs).filter("kept").select("doc_id").collect()}
    parts = brute_components([(i, texts[i]) for i in sorted(kept)])
    kept = {i for i in kept if parts[i] == i}
    index = contamination.ItemIndex([(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    kept = {i for i in kept if not index.search(texts[i].encode())}

    def clean(t):
        out, at = "", 0
        for a, _, b, _ in brute_spans(t):
            if a >= at:
                out += t[at:a] + "[secret]"
            at = max(at, b)
        return out + t[at:]

    rows = corpus_pipeline.run(spark, SF).collect()
    check_packing(rows, [(i, clean(texts[i])) for i in kept], packing.SIZE)
    assert Counter(r.doc_id for r in rows).keys() == kept and secrets.BASE_RULES
