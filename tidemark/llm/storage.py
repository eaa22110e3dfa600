"""Cutting lineage with tables written to the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_path


def table_path(spark: SparkSession, name: str) -> str:
    """A fresh directory under the session's ``spark.checkpoint.dir``."""
    return scratch_path(spark, f"llm-{name}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    path = table_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
