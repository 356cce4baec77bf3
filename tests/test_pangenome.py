import random

import pytest
from pyspark.sql import functions as F

from genespark.operators import cooccurrence as C
from genespark.operators import graph as GR
from genespark.operators import islands as I
from genespark.operators import loci as L
from genespark.operators import neighborhood as N
from genespark.operators import overlap as O
from genespark.operators import pangenome as G
from genespark.sources.tables import closure


def test_frequency_classes(spark):
    strains = spark.createDataFrame(
        [(f"I{i}", "IN", 1) for i in range(20)] + [("X", "IN", 0), ("O1", "OUT", 1), ("O2", "OUT", 1), ("O3", "OUT", 1)],
        "short string, grp string, is_rep int")
    cells = [("core", f"I{i}") for i in range(19)] + [("soft", f"I{i}") for i in range(18)] + [("shell", f"I{i}") for i in range(3)] \
        + [("cloud", "I0"), ("cloud", "I1"), ("single", "I0"), ("nonrep", "X"), ("outer", "O1"), ("outer", "O2"), ("outer", "O3")]
    m = spark.createDataFrame(cells, "family string, short string")
    fams = spark.createDataFrame([(f,) for f in {c[0] for c in cells} | {"none"}], "family string")
    got = {r.family: (r.bin, r.bin_out) for r in G.frequency_table(m, fams, strains).collect()}
    assert got == {"core": ("core", "ingroup_only"), "soft": ("soft_core", "ingroup_only"), "shell": ("shell", "ingroup_only"),
                   "cloud": ("cloud", "ingroup_only"), "single": ("singleton", "ingroup_only"),
                   "nonrep": ("nonrep_only", "ingroup_only"), "outer": ("outgroup_only", "core"), "none": ("absent", "absent")}
    few = {r.family: r.bin_out for r in G.frequency_table(m, fams, strains, out_min=4).collect()}
    assert set(few.values()) == {"-"}


def test_screened_pairs_match_brute_force(spark):
    r = random.Random(5)
    n, fams = 80, [f"F{i}" for i in range(30)]
    have = {f: {s for s in range(n) if r.random() < (0.5 if i % 3 else 0.2) or (i < 4 and s < 30)} for i, f in enumerate(fams)}
    cells = spark.createDataFrame([(f, f"S{s:03d}") for f in fams for s in have[f]], "family string, short string")
    strains = spark.createDataFrame([(f"S{s:03d}",) for s in range(n)], "short string")
    got = {(x.family_a, x.family_b): (x.n_both, x.n_a, x.n_b) for x in C.screened_pairs(cells, C.strain_index(strains), n, 0.2, 7).collect()}
    import math
    want = {}
    for a in fams:
        for b in fams:
            if a < b:
                both, ca, cb = len(have[a] & have[b]), len(have[a]), len(have[b])
                v = ca * cb * (n - ca) * (n - cb) / (n * n * (n - 1))
                z = (both - ca * cb / n - 0.5) / math.sqrt(v)
                if z > 0 and 0.5 * math.erfc(z / math.sqrt(2)) <= 0.2:
                    want[a, b] = (both, ca, cb)
    assert got == want
    words = C.strain_words(cells, C.strain_index(strains))
    pairs = spark.createDataFrame(list(want), "family_a string, family_b string")
    assert {(x.family_a, x.family_b): x.n_both for x in C.overlaps_of(pairs, words, "n_both").collect()} == {k: v[0] for k, v in want.items()}


def test_islands_break_at_core_and_contig(spark):
    freq = spark.createDataFrame([("c", "core"), ("a", "shell"), ("b", "cloud"), ("d", "singleton")], "family string, bin string")
    pos = [("s", "k1", f, i, i) for i, f in enumerate(["a", "b", "c", "a", "x", "b", "d"])] + [("s", "k2", "a", 7, 7), ("s", "k2", "b", 9, 9)]
    df = spark.createDataFrame([(*p, p[4] + (50 if p[2] == "a" else 5)) for p in pos],
                               "short string, contig string, family string, rank bigint, start bigint, end bigint")
    ends = {(r.contig, r.first_rank): r.end for r in I.runs_of(I.accessory_rows(df, freq)).collect()}
    assert ends == {("k1", 0): 50, ("k1", 5): 11, ("k2", 7): 57}   # the largest gene end, not the end of the last gene
    got = {(r.contig, r.first_rank, r.last_rank, r["size"]) for r in I.runs_of(I.accessory_rows(df, freq)).collect()}
    assert got == {("k1", 0, 1, 2), ("k1", 5, 6, 2), ("k2", 7, 9, 2)}   # x is unknown, so core; a gap in rank does not break


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(f"n{i:04d}", f"n{i + 1:04d}") for i in range(n) if i != 150], "a string, b string")
    nodes = spark.createDataFrame([(f"n{i:04d}",) for i in range(n + 1)] + [("zz",)], "node string")
    got = {r.node: r.component for r in GR.connected_components(edges, nodes).collect()}
    assert got["n0150"] == "n0000" and got["n0151"] == "n0151" and got["n0300"] == "n0151" and got["zz"] == "zz"


def test_dollo_with_a_polytomy(spark):
    e = [("r", "x"), ("r", "y"), ("x", "a"), ("x", "b"), ("x", "c"), ("x", "d"), ("y", "e"), ("y", "f")]
    edges = spark.createDataFrame(e, "parent string, child string")
    m = spark.createDataFrame([("f1", "a"), ("f1", "b"), ("f2", "a"), ("f2", "e"), ("f3", "e")], "family string, short string")
    cl = closure(edges)
    res = GR.dollo(edges, cl, m)
    got = {r.family: (r.gain_node, r.n_loss_events) for r in res.collect()}
    assert got == {"f1": ("x", 1), "f2": ("r", 2), "f3": ("e", 0)}     # absent children of one polytomy are one loss
    strains = spark.createDataFrame([(s, "OUT" if s in "ef" else "IN") for s in "abcdef"], "short string, grp string")
    fams = spark.createDataFrame([("f1",), ("f2",), ("f3",), ("f4",)], "family string")
    d = {r.family: r.direction_tree for r in GR.tree_direction(res, fams, cl, m, strains).collect()}
    assert d == {"f1": "gain", "f2": "loss", "f3": "outgroup_only", "f4": "absent"}


def test_unrooted_tree_is_refused(spark):
    edges = spark.createDataFrame([("r", "a"), ("r", "b"), ("r", "c")], "parent string, child string")
    m = spark.createDataFrame([("f", "a")], "family string, short string")
    with pytest.raises(ValueError):
        GR.dollo(edges, closure(edges), m)


def test_modules_are_connected_and_beat_one_module(spark):
    clique = lambda p, n: [(f"{p}{i}", f"{p}{j}") for i in range(n) for j in range(i + 1, n)]
    e = clique("a", 5) + clique("b", 5) + [("a0", "b0")]
    pairs = spark.createDataFrame([(x, y, 1e-6, "trans") for x, y in e] + [("a1", "b4", 1e-9, "unexplained_physical")],
                                  "family_a string, family_b string, q double, classification string")
    got = {r.family: r.module_id for r in GR.trans_modules(pairs).collect()}
    assert len({got[f"a{i}"] for i in range(5)}) == 1 and len({got[f"b{i}"] for i in range(5)}) == 1 and got["a1"] != got["b1"]
    assert GR.trans_modules(pairs.where("classification = 'x'")).count() == 0


def test_pcoa_keeps_distances(spark):
    pts = {f"p{i}": (i % 4 * 3.0, i // 4 * 1.0) for i in range(12)}
    d = [(a, b, ((x[0] - y[0]) ** 2 + (x[1] - y[1]) ** 2) ** 0.5) for a, x in pts.items() for b, y in pts.items()]
    c = {r["item"]: r.coords for r in GR.pcoa(spark.createDataFrame(d, "a string, b string, dist double"), 2).collect()}
    for a, b, want in d:
        assert sum((x - y) ** 2 for x, y in zip(c[a], c[b])) ** 0.5 == pytest.approx(want, abs=1e-6)


def test_accumulation_matches_brute_force(spark):
    r = random.Random(7)
    n = 70
    have = {f"f{i}": {s for s in range(n) if i < 3 or r.random() < i / 20} for i in range(20)}
    m = spark.createDataFrame([(f, f"s{s}") for f, v in have.items() for s in v], "family string, short string")
    strains = spark.createDataFrame([(f"s{s}",) for s in range(n)], "short string")
    got = {x.n_strains: (x.pan_mean, x.core_mean) for x in GR.accumulation(m, strains, 2, 3).collect()}
    order = {}
    for p in range(2):
        h = strains.select("short", F.xxhash64(F.lit(3), F.lit(p), "short").alias("h")).orderBy("h", "short").collect()
        order[p] = [int(x.short[1:]) for x in h]
    for k in range(1, n + 1):
        pan = [sum(bool(v & set(o[:k])) for v in have.values()) for o in order.values()]
        core = [sum(set(o[:k]) <= v for v in have.values()) for o in order.values()]
        assert got[k] == (sum(pan) / 2, sum(core) / 2), k


def test_placement_window_and_exemplar(spark):
    mem = spark.createDataFrame([("L", "a"), ("L", "b"), ("L", "c")], "locus_id string, family string")
    pos = [("s1", "k", "a", 0), ("s1", "k", "b", 5), ("s1", "k", "c", 12), ("s1", "k", "a", 11), ("s2", "k", "a", 0), ("s2", "k", "b", 1),
           ("s2", "k", "c", 20), ("s3", "k", "a", 3), ("s3", "k", "b", 4), ("s3", "k", "c", 5)]
    p = spark.createDataFrame(pos, "short string, contig string, family string, rank bigint")
    got = {r.short: (r.lo, r.hi) for r in L.placements(mem, p).collect()}
    assert got == {"s1": (5, 12), "s3": (3, 5)}
    spans = spark.createDataFrame([("s1", "k", 0, 30), ("s3", "k", 0, 9)], "short string, contig string, first_rank bigint, last_rank bigint")
    info = spark.createDataFrame([("s1", "OUT", 10, None), ("s3", "IN", 5, None)], "short string, grp string, n50 bigint, priority int")
    ex = L.exemplars(L.placements(mem, p), spans, info).first()
    assert (ex.exemplar, ex.tier) == ("s1", "full")                      # tier comes before ingroup
    assert L.exemplars(L.placements(mem, p), spans, info, 3, 3).first().exemplar == "s3"


def test_cells_and_classes(spark):
    cols = spark.createDataFrame([("L", i, f, p) for i, (f, p) in enumerate(
        [("l", "left"), ("a", "locus"), ("b", "locus"), ("r", "right")])], "locus_id string, col int, family string, part string")
    pos = [("full", "k", f, i) for i, f in enumerate("labr")] + [("empty", "k", "l", 0), ("empty", "k", "r", 1)] \
        + [("far", "k", "l", 0), ("far", "k", "r", 1), ("far", "k2", "a", 90)] + [("cut", "k", "l", 20), ("cut", "k", "a", 21)]
    p = spark.createDataFrame(pos, "short string, contig string, family string, rank bigint")
    m = p.select("family", "short").withColumn("state", F.lit("present")).unionByName(
        spark.createDataFrame([("b", "far", "genome_only")], "family string, short string, state string"))
    spans = spark.createDataFrame([("full", "k", 0, 3), ("empty", "k", 0, 1), ("far", "k", 0, 1), ("far", "k2", 80, 200), ("cut", "k", 0, 22)],
                                  "short string, contig string, first_rank bigint, last_rank bigint")
    cells = L.cell_states(cols, p, m, spans)
    codes = {r.short: r.codes for r in L.code_strings(cells).collect()}
    assert codes == {"full": "1111", "empty": "1001", "far": "1241", "cut": "1155"}
    mask = spark.createDataFrame([("L", 1, 2, 1), ("L", 2, 2, 1)], "locus_id string, col int, support bigint, used int")
    cls = {r.short: r.row_class for r in L.row_classes(cells, L.flank_pairs(cols, p), mask).collect()}
    assert cls == {"full": "full", "empty": "empty", "far": "partial", "cut": "uninformative"}


def test_permutation_zero_is_the_observation(spark):
    genes = spark.createDataFrame([("s", f"g{i}", "k", i * 100 + 1, i * 100 + 50, "f" + str(i % 2)) for i in range(50)],
                                  "short string, protein_id string, contig string, start bigint, end bigint, family string")
    els = spark.createDataFrame([("e", "s", "k", 1, 1000)], "element_id string, short string, contig string, start bigint, end bigint")
    ctg = spark.createDataFrame([("s", "k", 5000)], "short string, contig string, length bigint")
    tgt = spark.createDataFrame([("f0",)], "family string")
    r = O.element_permutation(genes, els, ctg, tgt, 50).first()
    assert r.observed == 5 and 0 < r.p_perm_greater <= 1 and r.null_max >= r.null_q95


def test_draws_are_distinct_and_repeatable(spark):
    sizes = spark.createDataFrame([(1, "s", 5, 9), (2, "s", 2, 2)], "module_id bigint, short string, n bigint, pool bigint")
    a = sorted(map(tuple, N.draws(sizes, 20, 4).collect()))
    assert a == sorted(map(tuple, N.draws(sizes.repartition(3), 20, 4).collect()))
    per = {}
    for m, s, p, i in a:
        per.setdefault((m, p), []).append(i)
    assert all(len(set(v)) == len(v) and max(v) < (9 if k[0] == 1 else 2) for k, v in per.items()) and len(per) == 40


def test_nearest_other_and_flank_pairs_match_brute_force_without_pairs(spark):
    r = random.Random(3)
    place = [("s", "c", i, f"F{r.randrange(9)}") for i in range(120)] + [("t", "d", 2 * i, f"F{r.randrange(4)}") for i in range(60)]
    pos = spark.createDataFrame(place, "short string, contig string, rank bigint, family string")
    cols = [("L", 0, "F0", "left"), ("L", 1, "F1", "left"), ("L", 2, "F2", "locus"), ("L", 3, "F3", "right"), ("L", 4, "F0", "right")]
    cdf = spark.createDataFrame(cols, "locus_id string, col int, family string, part string")
    mine = [p for p in place if p[3] in {c[2] for c in cols}]
    want = {}
    for s, c, i, f in mine:
        near = [(abs(j - i), j - i, g) for t, d, j, g in mine if (t, d) == (s, c) and g != f and abs(j - i) <= 4]
        if near:
            want[s, i] = min(near)[1:]
    near = L.nearest_other(L._copies(cdf, pos), 4)
    assert {(x.short, x.rank): (x.delta, x.neighbour) for x in near.collect()} == want
    assert "Join" not in L.nearest_other(pos.withColumn("locus_id", F.lit("L")))._jdf.queryExecution().optimizedPlan().toString()
    side = lambda part: [p for p in mine if (p[0], p[2]) in want and p[3] in {c[2] for c in cols if c[3] == part}]
    best = {}
    for s, c, i, _ in side("left"):
        for t, d, j, _ in side("right"):
            if (s, c) == (t, d) and abs(i - j) <= 9:
                best[s] = min(best.get(s, (99,)), (abs(i - j), c, min(i, j), max(i, j)))
    got = {x.short: (x.upper - x.lower, x.contig, x.lower, x.upper) for x in L.flank_pairs(cdf, pos, 4).collect()}
    assert got == best
