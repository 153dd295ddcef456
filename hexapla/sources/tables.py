"""The driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` under ``sf_dir``, through Spark's own reader, so that any store Spark can open will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
