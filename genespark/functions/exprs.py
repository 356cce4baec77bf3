"""Column expressions shared by the operators (all JVM-side)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def safe_log10(x: Column) -> Column:
    """log10 with log10(0) = -inf (Spark alone gives NULL)."""
    return F.when(x <= 0, F.lit(-INF)).otherwise(F.log10(x))


def log_delta(best: Column, other: Column) -> Column:
    """log10(best) - log10(other): +inf when other is 0, -inf when only best is 0."""
    return (
        F.when(best.isNull() | other.isNull(), F.lit(None).cast("double"))
        .when(other <= 0, F.lit(INF))
        .when(best <= 0, F.lit(-INF))
        .otherwise(F.log10(best) - F.log10(other))
    )


def capped_delta(delta: Column, cap: float = 400.0) -> Column:
    """Delta bounded to +-cap, for formats without infinity."""
    return F.greatest(F.lit(-cap), F.least(F.lit(cap), delta))


def signal_class(coverage: Column, has_hit: Column, threshold: float = 50.0) -> Column:
    """none / domain_only / broad; blank when a hit carries no coverage."""
    return (
        F.when(~has_hit, F.lit("none"))
        .when(coverage.isNull(), F.lit(""))
        .when(coverage >= threshold, F.lit("broad"))
        .otherwise(F.lit("domain_only"))
    )


def at_terminus(start: Column, end: Column, length: Column, window_bp: int = 1000) -> Column:
    """Gene lies within ``window_bp`` of a contig end; unknown length is false."""
    return F.coalesce(
        (length > 0) & ((start <= window_bp) | (length - end <= window_bp)), F.lit(False)
    )


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def count_if(condition: Column) -> Column:
    return F.sum(flag(condition)).cast("bigint")


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0."""
    return F.when(den > 0, num / den)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_equal(left: list[Column], right: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [x == y for x, y in zip(left, right)])
