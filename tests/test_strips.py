"""Cells, flank pairs and breakpoints of loci against plain versions, on rows with nulls and repeated calls."""
import collections
import random

from genespark.operators import loci as L

K = 4


def made(spark):
    r = random.Random(12)
    fams = [f"f{i}" for i in range(9)]
    cols = [(f"L{n}", i, f, "left" if i < 2 else "right" if i > 4 else "locus") for n in range(3) for i, f in enumerate(r.choices(fams, k=6) + [None])]
    pos = [(s, c, r.choice(fams), i) for s in ("s1", "s2", "s3", None) for c in ("k1", "k2", None) for i in sorted(r.sample(range(60), 14))]
    calls = [(f, s, r.choice(["present", "genome_only", None])) for f in fams for s in ("s1", "s3", "s4", None) for _ in range(r.choice([0, 1, 1, 2]))]
    spans = [(s, c, 3, 50) for s in ("s1", "s2") for c in ("k1", "k2")]
    return (cols, pos, calls, spans), (
        spark.createDataFrame(cols, "locus_id string, col int, family string, part string"),
        spark.createDataFrame(pos, "short string, contig string, family string, rank bigint").repartition(3),
        spark.createDataFrame(calls, "family string, short string, state string"),
        spark.createDataFrame(spans, "short string, contig string, first_rank bigint, last_rank bigint"))


def placed_copies(cols, pos, locus, short):
    """Copies of the locus's families in a strain, each with the ranks to the nearest other family on its contig, or None."""
    own = {f for n, _, f, _ in cols if n == locus and f}
    mine = [p for p in pos if p[0] == short and p[2] in own]
    for p in mine:
        gaps = [abs(q[3] - p[3]) for q in mine if p[1] and q[1] == p[1] and q[2] != p[2] and abs(q[3] - p[3]) <= K]
        yield p, min(gaps, default=None)


def plain_cells(cols, pos, calls, spans):
    for locus in {c[0] for c in cols}:
        rows = [c[1:] for c in cols if c[0] == locus]
        for short in ("s1", "s2", "s3", "s4"):
            told = collections.defaultdict(list)
            for f, s, state in calls:
                if s == short and f in {c[1] for c in rows}:
                    told[f].append(state)
            have = {}
            for (_, contig, f, rank), gap in placed_copies(cols, pos, locus, short):
                span = [x for x in spans if x[:2] == (short, contig)]
                at = (gap, contig, rank, any(rank - x[2] <= K or x[3] - rank <= K for x in span)) if gap is not None else None
                have[f] = min((x for x in (have.get(f), at) if x), default=None)
            if not have and not told:
                continue
            inside = [(c, f) for c, f, _ in rows if have.get(f)]
            first, last = min(inside, default=None), max(inside, default=None)
            for c, f, part in rows:
                for state in told.get(f, [None]):
                    shown = "1" if have.get(f) else "2" if f in have or state else "0"
                    code = {"1": "3", "2": "4", "0": "0"}[shown] if state == "genome_only" else shown
                    off = first and ((c < first[0] and have[first[1]][3]) or (c > last[0] and have[last[1]][3]))
                    yield locus, short, c, f, part, shown if f in have else "0", "5" if off and code in "02" else code


def test_cells_equal_the_plain_version_without_joins(spark):
    plain, tables = made(spark)
    cols, pos, calls, spans = tables
    cells = L.cell_states(cols, pos, calls, spans, K)
    want = collections.Counter(plain_cells(*plain))
    assert collections.Counter(map(tuple, cells.collect())) == want and any(n > 1 for n in want.values())
    assert {x[-1] for x in want} == set("012345")
    # Genes are read once a strain; they are not copied for every locus of their family.
    assert "Join" not in cells._jdf.queryExecution().optimizedPlan().toString()
    pairs = L.flank_pairs(cols, pos, K)
    assert "Join" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    found = {}
    for locus in {c[0] for c in plain[0]}:
        side = lambda p: {f for n, _, f, q in plain[0] if n == locus and q == p and f}
        for short in ("s1", "s2", "s3", "s4"):
            good = [p for p, gap in placed_copies(plain[0], plain[1], locus, short) if gap is not None]
            met = [(abs(a[3] - b[3]), a[1], min(a[3], b[3]), max(a[3], b[3])) for a in good if a[2] in side("left") for b in good
                   if b[2] in side("right") and a[1] == b[1] and abs(a[3] - b[3]) <= 3 + 2 * K]
            if met:
                found[locus, short] = min(met)[1:]
    assert {(x.locus_id, x.short): (x.contig, x.lower, x.upper) for x in pairs.collect()} == found and found


def test_breakpoints_join_no_cells(spark):
    cells = [("L", "s", 0, "1"), ("L", "s", 1, "0"), ("L", "s", 1, "3"), ("L", "s", 2, "5"), ("L", "t", 0, "1"), ("L", "t", 2, "0"), ("L", "u", 0, "1"), ("L", "u", 1, "5"),
             ("L", "v", 0, "1"), ("L", "v", 1, "0")]
    rows = [("L", "s", "full"), ("L", "t", "full"), ("L", "u", "uninformative")]
    out = L.breakpoints(spark.createDataFrame(cells, "locus_id string, short string, col int, code string"),
                        spark.createDataFrame(rows, "locus_id string, short string, row_class string"),
                        spark.createDataFrame([(s, "x") for s in "stuv"], "short string, species string"))
    # t has a gap between its columns, v has no class; of the two calls of s each meets its neighbours
    assert sorted(map(tuple, out.collect())) == [("L", 1, "x", 1, 1), ("L", 2, "x", 0, 1)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_module_sums_equal_drawn_rows_counted_as_rows(spark):
    from pyspark.sql import functions as F

    from genespark.operators import neighborhood as N
    r = random.Random(3)
    genes = [(s, c, i, None if i == 7 else 1000 * i + r.randrange(900), f"f{r.randrange(8)}") for s in ("s1", "s2", None) for c in ("k1", "k2", None)
             for i in range(25)]
    genes = [(s, c, i + 100 * ("k1", "k2", None).index(c), x, f) for s, c, i, x, f in genes]
    g = spark.createDataFrame(genes, "short string, contig string, rank bigint, start bigint, family string")
    modules = spark.createDataFrame([(1, "f0"), (1, "f1"), (2, "f2"), (2, "f5"), (2, "f6"), (None, "f3")], "module_id bigint, family string")
    accessory = spark.createDataFrame([(f"f{i}",) for i in (0, 2, 3, 4)], "family string")
    got = {x.module_id: x for x in N.score_modules(g, modules, accessory, max_kb=9, min_gap=3, n_perm=25).collect()}
    sizes, rows = [], []
    for m, own in ((1, {"f0", "f1"}), (2, {"f2", "f5", "f6"})):
        for s in ("s1", "s2"):
            at = sorted((x for x in genes if x[0] == s), key=lambda x: (x[1] or "", x[2]))
            pool = [x for x in at if x[4] in {"f0", "f2", "f3", "f4"}] + [x for x in at if x[4] in own - {"f0", "f2", "f3", "f4"}]
            mine = [x for x in at if x[4] in own]
            sizes.append((m, s, len(mine), len(pool)))
            rows += [(m, s, 0, *x[1:]) for x in mine] + [(m, s, -1 - i, *x[1:]) for i, x in enumerate(pool)]
    drawn = N.draws(spark.createDataFrame(sizes, "module_id bigint, short string, n bigint, pool bigint"), 25, 0).collect()
    at = {(m, s, p): x for m, s, p, *x in rows if p < 0}
    sets = [x for x in rows if x[2] == 0] + [(d.module_id, d.short, d.perm, *at[d.module_id, d.short, -1 - d.idx]) for d in drawn]
    per = N.pair_counts(spark.createDataFrame(sets, "module_id bigint, short string, perm int, contig string, rank bigint, start bigint, family string"), 9000, 3)
    want = {(x.module_id, x.perm): x for x in per.groupBy("module_id", "perm").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in N.COUNTS]).collect()}
    for m in (1, 2):
        assert [got[m][c] for c in ("member_genes", *N.COUNTS)] == [want[m, 0][c] for c in ("n", *N.COUNTS)]
        for den, tag in (("informative", ""), ("total", "_total")):
            v = [want[m, p]["colocalized"] / want[m, p][den] for p in range(1, 26) if want[m, p][den]]
            assert abs(got[m][f"null_mean_frac{tag}"] - sum(v) / len(v)) < 1e-12
    assert got.keys() == {1, 2}


def test_draws_follow_the_hash_of_the_engine_and_are_no_rows(spark, monkeypatch):
    import numpy as np
    from pyspark.sql import functions as F

    from genespark.operators import neighborhood as N
    one = spark.range(1).select(F.lit(9).cast("bigint").alias("module_id"), F.lit("a").alias("short")).select(
        F.xxhash64(F.lit(0), "module_id", "short").alias("h"), F.transform(F.sequence(F.lit(1), F.lit(40)), lambda p: F.xxhash64(
            F.lit(0), "module_id", "short", p, F.lit(5).cast("bigint"))).alias("x")).first()
    with np.errstate(over="ignore"):
        keys = N._mixed(N._turn((np.array([one.h]).view("u8") + (N.P5 + np.uint64(4))) ^ (np.arange(1, 41, dtype="u8") * N.P1), 23) * N.P2 + N.P3)
        assert N._hashes(keys, np.array([5]))[:, 0].tolist() == one.x
    written = []
    monkeypatch.setattr(N, "materialize", lambda df: written.append(df.columns) or df)
    g = spark.createDataFrame([("s", "k", i, i, f"f{i % 3}") for i in range(12)], "short string, contig string, rank bigint, start bigint, family string")
    N.score_modules(g, spark.createDataFrame([(1, "f0")], "module_id bigint, family string"), g.select("family").distinct(), n_perm=5).collect()
    assert ["module_id", "short", "perm", "idx"] not in written
