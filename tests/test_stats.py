import itertools
import math
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from genespark.functions.stats import hypergeom_tail, ln_factorial
from genespark.operators.cooccurrence import stratified_tail
from genespark.operators.ordered import average_rank, benjamini_hochberg, interval_union, median_within, rank_within


def exact_tail(k, n, m, d):
    lo, hi = max(0, m + d - n), min(m, d)
    return float(sum(Fraction(comb(m, i) * comb(n - m, d - i), comb(n, d)) for i in range(max(k, lo), hi + 1)))


def test_hypergeometric_tail_is_exact(spark):
    rows = [(k, n, m, d) for n, m, d in [(10, 4, 5), (60, 30, 30), (200, 7, 150), (1000, 400, 300), (5, 5, 5), (8, 0, 3)]
            for k in range(max(0, m + d - n), min(m, d) + 2)]
    df = spark.createDataFrame(rows, "k bigint, n bigint, m bigint, d bigint")
    for r in df.withColumn("p", hypergeom_tail(F.col("k"), F.col("n"), F.col("m"), F.col("d"))).collect():
        want = exact_tail(r.k, r.n, r.m, r.d)
        assert r.p == pytest.approx(want, rel=1e-9, abs=1e-300), r


def test_ln_factorial(spark):
    df = spark.range(0, 3000, 7).withColumn("v", ln_factorial(F.col("id")))
    for r in df.collect():
        assert r.v == pytest.approx(math.lgamma(r.id + 1), rel=1e-13, abs=1e-12)


def test_stratified_tail_matches_enumeration():
    # clades of 4 and 3 strains; shuffle b inside each clade
    a = [[1, 1, 0, 0], [1, 0, 0]]
    k = [(4, 2, 2), (3, 1, 2)]
    got = 0
    total = 0
    for x in itertools.combinations(range(4), 2):
        for y in itertools.combinations(range(3), 2):
            both = sum(a[0][i] for i in x) + sum(a[1][i] for i in y)
            got += both >= 2
            total += 1
    assert stratified_tail(2, k) == pytest.approx(got / total)
    assert stratified_tail(0, k) == 1.0
    assert stratified_tail(9, k) == 0.0


def test_ranks_and_medians_split_a_hot_group(spark):
    rows = [("hot", i * 37 % 5000) for i in range(5000)] + [("b", 3), ("b", 3), ("b", 9), ("c", 1)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    got = {(r.g, r.v): r["rank"] for r in rank_within(df.distinct(), ["g"], [F.col("v")]).collect()}
    assert all(got["hot", v] == i for i, v in enumerate(sorted({v for g, v in rows if g == "hot"})))
    med = {r.g: (r.median, r.n) for r in median_within(df, "v", ["g"]).collect()}
    assert med == {"hot": (2499.5, 5000), "b": (3.0, 3), "c": (1.0, 1)}
    avg = {(r.g, r.v, r["rank"]) for r in average_rank(df.where("g = 'b'"), "v", ["g"]).collect()}
    assert avg == {("b", 3, 1.5), ("b", 9, 3.0)}


def test_interval_union(spark):
    rows = [("a", 1, 10), ("a", 5, 12), ("a", 13, 20), ("a", 30, 30), ("b", 4, 8), ("b", 4, 6)]
    df = spark.createDataFrame(rows, "k string, start bigint, end bigint")
    assert {r.k: r.covered for r in interval_union(df, ["k"]).collect()} == {"a": 21, "b": 5}


def test_bh_with_untested_hypotheses(spark):
    p = [0.001, 0.02, 0.02, 0.5, 0.9]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(p)], "i int, p double")
    padded = sorted(p) + [1.0] * 5
    want = {x: min(padded[j] * 10 / (j + 1) for j in range(i, 10)) for i, x in enumerate(padded)}
    for r in benjamini_hochberg(df, "p", "q", F.lit(10), ["i"]).collect():
        assert r.q == pytest.approx(min(1.0, min(v for x, v in want.items() if x == r.p)), rel=1e-12)
