"""From raw documents to packed training sequences, in five stages.

Each stage works on what its predecessor kept: quality rules (rejected documents go), the n-gram Jaccard join (one
document of each group of near copies stays, the one with the least doc_id), benchmark decontamination (documents in
which a test item is found go), secret scans (secrets are replaced by a mark), and packing. All but the last return the
columns of documents.

Defined cases: documents with a null or empty text, or with too few words, go in the first stage. Nulls in other columns
are values like others: a null language or source is a group of its own, a null doc_id is never a copy of another
document. Repeated rows of a doc_id are judged by the id: all stay if one is kept, all go if one has a test item; rows
with equal texts and different ids leave the least id. Long texts are worked on whole. An empty table gives an empty
result in every stage, and an empty ``benchmark`` rejects nothing. Further columns pass through the first four stages,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hexapla.llm import contamination, jaccard, packing, quality, secrets
from hexapla.llm.common import written
from hexapla.llm.queries import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail the base rules nor are far from the rest of their language and source."""
    return quality.quality_filter(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones."""
    return jaccard.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test item of ``benchmark``."""
    return contamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced."""
    return secrets.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences of 1024 ids."""
    return packing.packed_documents(docs, vocabulary(), end=0)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scans),
    ("packing", pack),
]

#: SQL can't express the tokenizer of the last stage; the tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written as Parquet and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
