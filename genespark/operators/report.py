"""Counts and shares behind the report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shares(df: DataFrame, column: str) -> DataFrame:
    """Rows and percentage per value of ``column``."""
    counts = df.groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.select(F.lit(column).alias("what"), "label", "n", F.round(100 * F.col("n") / total, 1).alias("pct"))


def label_counts(df: DataFrame, column: str, what: str) -> DataFrame:
    """Rows per value of ``column``."""
    return df.groupBy(F.col(column).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(what).alias("what"), "label", "n")
