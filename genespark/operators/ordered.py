"""Ordered operators that stay distributed when one group holds most rows.

A window over ``partitionBy(group)`` sends a whole group to one task. Here rows
are range-partitioned by (group, order) first, so a large group spans many
chunks; each chunk is scanned alone and a small per-chunk summary carries the
state of the preceding chunks of the same group into it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genespark.session import materialize

CHUNK = "_chunk"


def chunk_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Range-partition by (group, order) and fix the chunk number of every row.

    The result is written once: a range partitioning depends on a sample, so
    recomputing it could move rows between chunks.
    """
    keyed = df.repartitionByRange(*[F.col(c) for c in group], *order)
    return materialize(keyed.withColumn(CHUNK, F.spark_partition_id()))


def running(
    chunked: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    outs: Mapping[str, tuple[str, Column, bool]],
) -> DataFrame:
    """Add running aggregates over chunked rows.

    ``outs`` maps a new column to (kind, expression, inclusive): kind is
    ``sum``, ``min``, ``max`` or ``last`` (last non-null value); with
    ``inclusive`` false only preceding rows count. ``order`` must be total.
    """
    group = list(group)
    whole = Window.partitionBy(*group, CHUNK).orderBy(*order)
    local = chunked.withColumn("_rn", F.row_number().over(whole))
    for name, (_, expr, _) in outs.items():
        local = local.withColumn(f"_in_{name}", expr)
    summary = [
        _total(kind, F.col(f"_in_{name}")).alias(f"_tot_{name}") for name, (kind, _, _) in outs.items()
    ]
    before = Window.partitionBy(*group).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = local.groupBy(*group, CHUNK).agg(*summary)
    carry = carry.select(
        *group, CHUNK,
        *[_fold(kind, F.col(f"_tot_{name}")).over(before).alias(f"_carry_{name}")
          for name, (kind, _, _) in outs.items()],
    )
    joined = local.join(carry, [*group, CHUNK], "left")
    result = joined
    for name, (kind, _, inclusive) in outs.items():
        frame = whole.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        here = _fold(kind, F.col(f"_in_{name}")).over(frame)
        result = result.withColumn(name, _merge(kind, F.col(f"_carry_{name}"), here))
    drop = ["_rn"] + [f"{p}{n}" for n in outs for p in ("_in_", "_carry_")]
    return result.drop(*drop)


def _total(kind: str, col: Column) -> Column:
    if kind == "last":
        return F.max_by(col, F.when(col.isNotNull(), F.col("_rn")))
    return {"sum": F.sum, "min": F.min, "max": F.max}[kind](col)


def _fold(kind: str, col: Column) -> Column:
    if kind == "last":
        return F.last(col, ignorenulls=True)
    return {"sum": F.sum, "min": F.min, "max": F.max}[kind](col)


def _merge(kind: str, carry: Column, here: Column) -> Column:
    if kind == "sum":
        return F.when(carry.isNull() & here.isNull(), F.lit(None)).otherwise(
            F.coalesce(carry, F.lit(0)) + F.coalesce(here, F.lit(0)))
    if kind == "max":
        return F.greatest(carry, here)
    if kind == "min":
        return F.least(carry, here)
    return F.coalesce(here, carry)


def rank_within(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], out: str = "rank", start: int = 0
) -> DataFrame:
    """Position of every row in its group's order, counting from ``start``."""
    rows = chunk_rows(df, group, order)
    counted = running(rows, group, order, {out: ("sum", F.lit(1).cast("bigint"), True)})
    return counted.withColumn(out, F.col(out) + F.lit(start - 1)).drop(CHUNK)


def interval_union(
    df: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end", out: str = "covered"
) -> DataFrame:
    """Length of the union of closed intervals per key (touching intervals merge).

    A position counts once however many intervals cover it: each interval adds
    only the part beyond the furthest end seen before it.
    """
    spans = df.groupBy(*keys, start).agg(F.max(end).alias(end))
    order = [F.col(start)]
    rows = running(
        chunk_rows(spans, keys, order), keys, order, {"_reach": ("max", F.col(end), False)}
    )
    new_from = F.greatest(F.col(start), F.coalesce(F.col("_reach") + 1, F.col(start)))
    added = F.greatest(F.lit(0), F.col(end) - new_from + 1)
    return rows.groupBy(*keys).agg(F.sum(added).cast("bigint").alias(out))


def benjamini_hochberg(
    df: DataFrame, p: str, out: str, total: Column | None = None, ties: Sequence[str] = ()
) -> DataFrame:
    """q = min over larger p of p * m / rank, at most 1.

    ``total`` is the true number of hypotheses when the rows are only those
    that were tested; the untested ones count as p = 1. The running minimum
    walks from the largest p down, over range-partitioned rows.
    """
    order = [F.col(p).desc(), *[F.col(c).desc() for c in ties]]
    rows = chunk_rows(df, [], order)
    n_rows = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    m = n_rows if total is None else total
    ranked = running(rows, [], order, {"_down": ("sum", F.lit(1).cast("bigint"), True)})
    ranked = ranked.withColumn("_scaled", F.col(p) * m / (n_rows - F.col("_down") + 1))
    stepped = running(ranked.drop("_down"), [], order, {out: ("min", F.col("_scaled"), True)})
    return stepped.withColumn(out, F.least(F.lit(1.0), F.col(out))).drop("_scaled", CHUNK)


def average_rank(df: DataFrame, value: str, group: Sequence[str] = (), out: str = "rank") -> DataFrame:
    """Rank of ``value`` (1-based) where ties share their mean position.

    Distinct values are counted first, so the ordered pass runs over distinct
    values and not over rows.
    """
    group = list(group)
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    order = [F.col(value)]
    below = running(
        chunk_rows(counts, group, order), group, order, {"_below": ("sum", F.col("_n"), False)}
    )
    ranks = below.select(
        *group, value, (F.coalesce(F.col("_below"), F.lit(0)) + (F.col("_n") + 1) / 2).alias(out)
    )
    return df.join(ranks, [*group, value])


def values_at(
    df: DataFrame, value: str, group: Sequence[str], at: Mapping[str, Column], also: Sequence[Column] = ()
) -> DataFrame:
    """Values at 0-based positions of each group's sorted values, without gathering a group.

    ``at`` maps an output name to a position, an expression of ``n`` (the group
    size). Distinct values are counted first, so repeats cost nothing.
    """
    group = list(group)
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    sizes = counts.groupBy(*group).agg(F.sum("_n").cast("bigint").alias("n"), *also)
    order = [F.col(value)]
    rows = running(
        chunk_rows(counts, group, order), group, order, {"_upto": ("sum", F.col("_n"), True)})
    if group:
        rows = rows.join(sizes, group)
    else:
        rows = rows.withColumn("n", sizes.select("n").scalar())
    holds = lambda pos: (F.col("_upto") > pos) & (F.col("_upto") - F.col("_n") <= pos)
    picked = rows.groupBy(*group).agg(
        *[F.max(F.when(holds(pos), F.col(value))).alias(name) for name, pos in at.items()])
    return sizes.join(picked, group) if group else picked.withColumn("n", sizes.select("n").scalar())


def median_within(df: DataFrame, value: str, group: Sequence[str], out: str = "median") -> DataFrame:
    """Exact median and size ``n`` per group."""
    low, high = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    mid = values_at(df, value, group, {"_low": low, "_high": high})
    return mid.select(*group, "n", ((F.col("_low") + F.col("_high")) / 2).alias(out))
