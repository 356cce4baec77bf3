import random

from pyspark.sql import functions as F

from genespark.operators.joins import (
    near_family_pairs, overlap_join, overlap_semi, point_join, split_join)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_split_join_equals_a_plain_join(spark):
    big = spark.createDataFrame([("x" if i % 3 else f"k{i % 5}", i) for i in range(200)], "k string, v int")
    small = spark.createDataFrame([("x", 1), ("k0", 2), ("k1", 3), ("zz", 4)], "k string, w int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = split_join(big, small, ["k"], how)
        want = big.join(small, ["k"], how)
        assert rows(got.select(want.columns)) == rows(want), how


def spans(seed, n, name):
    r = random.Random(seed)
    out = []
    for i in range(n):
        s = r.choice([5, r.randrange(1, 2000)])
        out.append((f"{name}{i}", "c" + str(i % 2), s, s + r.randrange(0, 300)))
    return out


def test_overlap_and_point_joins_match_brute_force(spark):
    a, b = spans(1, 120, "a"), spans(2, 60, "b")
    da = spark.createDataFrame(a, "ia string, c string, start bigint, end bigint")
    db = spark.createDataFrame(b, "ib string, c string, r_start bigint, r_end bigint")
    want = {(x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3]}
    got = [(r.ia, r.ib) for r in overlap_join(da, db, ["c"], width=70).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    semi = {r.ia for r in overlap_semi(da, db, ["c"], ["ia"], F.col("ia") != F.col("ib"), width=70).collect()}
    assert semi == {x for x, _ in want}
    pts = {(r.ia, r.ib) for r in point_join(da, db, ["c"], "start", width=70).collect()}
    assert pts == {(x[0], y[0]) for x in a for y in b if x[1] == y[1] and y[2] <= x[2] <= y[3]}


def test_near_family_pairs_match_brute_force(spark):
    r = random.Random(3)
    pos = [("s" + str(i % 2), "c" + str(i % 3), "F" + str(r.randrange(8)), i) for i in range(150)]
    df = spark.createDataFrame(pos, "short string, contig string, family string, rank bigint")
    want = {(min(x[2], y[2]), max(x[2], y[2]), x[0]) for x in pos for y in pos
            if x[:2] == y[:2] and x[2] != y[2] and abs(x[3] - y[3]) <= 10}
    assert {tuple(x) for x in near_family_pairs(df, 10).collect()} == want
