"""Join patterns: joins with hot keys, interval overlap by bins, rank bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def split_join(
    big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner", condition: Column | None = None,
) -> DataFrame:
    """Equi-join of a table whose keys may be hot with one that has few rows per key.

    A plain shuffled join: adaptive execution cuts the partitions of hot keys of
    ``big`` by their measured size and copies their partners, for any number of
    keys. ``how`` is inner, left, left_semi or left_anti; ``condition`` may name
    the columns of both sides and is checked inside the join.
    """
    on = list(on)
    if condition is None:
        return big.join(small, on, how)
    small = small.select(*[F.col(c).alias(f"_k_{c}") if c in on else F.col(c) for c in small.columns])
    for c in on:
        condition = condition & (F.col(c) == F.col(f"_k_{c}"))
    return big.join(small, condition, how).drop(*[f"_k_{c}" for c in on])


def _bins(start: Column, end: Column, width: int) -> Column:
    lo = F.floor(start / width).cast("bigint")
    return F.explode(F.sequence(lo, F.greatest(lo, F.floor(end / width).cast("bigint"))))


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_span: tuple[str, str] = ("start", "end"),
    right_span: tuple[str, str] = ("r_start", "r_end"),
    width: int = 100_000,
) -> DataFrame:
    """Inner join of closed intervals that share a position, within equal ``on``.

    Both sides are copied into the fixed-width bins they touch. A pair is kept
    only in the bin where its overlap begins, so no pair appears twice. A bin
    that holds many left intervals is a hot key like any other.
    """
    ls, le = left_span
    rs, re = right_span
    lb = left.withColumn("_bin", _bins(F.col(ls), F.col(le), width))
    rb = right.withColumn("_bin", _bins(F.col(rs), F.col(re), width))
    met = split_join(lb, rb, [*on, "_bin"])
    first = F.floor(F.greatest(F.col(ls), F.col(rs)) / width).cast("bigint")
    return met.where(
        (F.col(ls) <= F.col(re)) & (F.col(rs) <= F.col(le)) & (F.col("_bin") == first)
    ).drop("_bin")


def overlap_semi(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    key: Sequence[str],
    condition: Column,
    left_span: tuple[str, str] = ("start", "end"),
    right_span: tuple[str, str] = ("r_start", "r_end"),
    width: int = 100_000,
) -> DataFrame:
    """Distinct ``key`` values of left intervals that overlap some right interval.

    Only existence is asked, so each left row stops at its first partner and
    no pairs are built, however deep the intervals pile up.
    """
    ls, le = left_span
    rs, re = right_span
    lb = left.withColumn("_bin", _bins(F.col(ls), F.col(le), width))
    rb = right.withColumn("_bin", _bins(F.col(rs), F.col(re), width))
    met = split_join(lb, rb, [*on, "_bin"], "left_semi",
                     condition=condition & (F.col(ls) <= F.col(re)) & (F.col(rs) <= F.col(le)))
    return met.select(*key).distinct()


def point_join(
    points: DataFrame, spans: DataFrame, on: Sequence[str], at: str, span: tuple[str, str] = ("r_start", "r_end"),
    width: int = 100_000,
) -> DataFrame:
    """Inner join of points with the closed intervals that contain them."""
    pb = points.withColumn("_bin", F.floor(F.col(at) / width).cast("bigint"))
    sb = spans.withColumn("_bin", _bins(F.col(span[0]), F.col(span[1]), width))
    met = split_join(pb, sb, [*on, "_bin"])
    return met.where((F.col(at) >= F.col(span[0])) & (F.col(at) <= F.col(span[1]))).drop("_bin")


def near_family_pairs(positions: DataFrame, k: int = 10, strain: str = "short") -> DataFrame:
    """Distinct (family_a < family_b, strain) with copies on one contig at most k ranks apart.

    A rank belongs to one gene of a strain, so a (strain, contig, rank bin)
    never holds more than k + 1 rows and each row meets at most 2k others:
    the work is linear in the number of genes, whatever family is frequent.
    """
    base = positions.select(
        strain, "contig", "family", "rank", F.floor(F.col("rank") / (k + 1)).cast("bigint").alias("_bin"))
    right = base.select(
        strain, "contig", F.col("family").alias("_f2"), F.col("rank").alias("_r2"),
        F.explode(F.array(F.col("_bin"), F.col("_bin") - 1)).alias("_bin"),
    )
    gap = F.col("_r2") - F.col("rank")
    near = base.join(right, [strain, "contig", "_bin"]).where(
        (gap > 0) & (gap <= k) & (F.col("family") != F.col("_f2")))
    return near.select(
        F.least("family", "_f2").alias("family_a"), F.greatest("family", "_f2").alias("family_b"), strain
    ).distinct()
