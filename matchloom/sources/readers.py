"""Readers of stored data. Schemas are given, never inferred from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def plan_rows(spark: SparkSession, path: str, scope_id: str, schema: str) -> DataFrame:
    """A scope's plan; other scopes are pruned at the scan."""
    return spark.read.schema(schema).parquet(path).filter(F.col("scope") == scope_id)


def images(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of log files with their order within the file."""
    return spark.read.text(path).withColumn("seq", F.monotonically_increasing_id()).withColumnRenamed("value", "line")


def with_columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """``df`` with the wanted columns, null where the stored schema has none."""
    return df.select(*[F.col(c).cast(t).alias(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in wanted.items()])
