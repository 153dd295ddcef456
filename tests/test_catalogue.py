"""Every query of the catalogue against its SQL."""

import duckdb
import pytest

from compare import connect, same_rows
from hexapla.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    df = catalogue.QUERIES[name](spark, SF)
    if name in catalogue.ORACLE:
        same_rows(df, con, catalogue.ORACLE[name])
    else:
        assert df.count() > 0


def test_html_to_text_leaves_cut_entities(spark, tmp_path):
    """Entities without a semicolon, as where a page is cut, stay; the SQL leaves them too."""
    pages = ["<p>a &amp; b&amp</p><p>&am", "x&copy=1 &copy; &lt;b&gt; &amp;lt; &ampx; &quot;", "&middot;&amp", None]
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    df = catalogue.QUERIES["html_to_text"](spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    same_rows(df, con, catalogue.ORACLE["html_to_text"])
    assert [r.text for r in df.orderBy("page_id").collect()] == ["a & b&amp\n&am", 'x&copy=1 © <b> &lt; &ampx; "', "·&amp", ""]


def test_lyric_coverage_finds_what_is_contained(spark):
    """Every item that stands in a document is found with its first one; other finds have nine tenths."""
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    texts = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r.item_id: (r.doc_id, r.coverage) for r in catalogue.QUERIES["lyric_coverage"](spark, SF).collect()}
    first = {k: next((i for i, t in texts if x in t), None) for k, x in items.items()}
    assert {k: v for k, v in got.items() if v[1] == 1 and first[k] is not None} == {k: (i, 1.0) for k, i in first.items() if i is not None}
    assert all(v[1] >= 0.9 for v in got.values()) and any(i is not None for i in first.values())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
