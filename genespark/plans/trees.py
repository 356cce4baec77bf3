"""A binary tree over the strains: the parent of node i is i div 2; strain k is tip n + k."""

from __future__ import annotations

from pyspark.sql import functions as F

from genespark.plans.views import Tables


def edges(t: Tables):
    n = t.strains.count()
    tips = t.strains.select((F.substring("short", 2, 9).cast("bigint") + n).alias("i"))
    up = F.sequence(F.lit(0), F.floor(F.log2(F.col("i").cast("double"))).cast("int"))
    nodes = tips.select(F.explode(F.transform(up, lambda s: F.floor(F.col("i") / F.pow(F.lit(2.0), s)).cast("bigint"))).alias("i")).distinct()
    name = lambda c: F.concat(F.lit("n"), c.cast("string"))
    return nodes.where(F.col("i") > 1).select(
        name(F.floor(F.col("i") / 2)).alias("parent"), name(F.col("i")).alias("child"))
