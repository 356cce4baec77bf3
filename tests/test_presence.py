import pytest

from genespark.operators import presence as P

H = "query_id string, query_proteome string, target_id string, target_proteome string, evalue double, bitscore double, qcov int"


def judged(spark, rows, paralogs=(("q", "p"),), **kw):
    hits = spark.createDataFrame(rows, H)
    par = spark.createDataFrame(list(paralogs), "protein_id string, paralog_id string")
    return {(r.query_id, r.target_id): r.status for r in P.compete(hits, par, **kw).collect()}


def hit(q, t, e, tp="B", qcov=80):
    return (q, "A", t, tp, e, 50.0, qcov)


def test_paralog_competition(spark):
    rows = [hit("q", "t1", 1e-8), hit("p", "t1", 1e-12), hit("q", "t2", 1e-9), hit("p", "t2", 1e-9), hit("q", "t3", 1e-25),
            hit("p", "t3", 1e-60), hit("q", "t4", 1e-5)]
    s = judged(spark, rows)
    assert s["q", "t1"] == "paralog_filtered"      # the paralog is better
    assert s["q", "t2"] == "kept"                  # a tie is not better
    assert s["q", "t3"] == "kept"                  # absolute floor
    assert ("q", "t4") not in s                    # the significance limit is strict
    assert judged(spark, rows, rescue_evalue=0)["q", "t3"] == "paralog_filtered"
    assert judged(spark, rows, rescue_evalue=None, rescue_delta=5.0)["q", "t1"] == "kept"


def test_proteome_scope_and_zero_evalues(spark):
    rows = [hit("q", "t1", 1e-8), hit("p", "t9", 0.0), hit("q", "t2", 0.0, "C"), hit("p", "t8", 0.0, "C")]
    s = judged(spark, rows, scope="proteome", rescue_evalue=None, rescue_delta=100.0)
    assert s["q", "t1"] == "paralog_filtered"      # a paralog E of 0 is never within reach
    assert s["q", "t2"] == "kept"


def test_paralog_best_is_taken_before_any_filter(spark):
    assert judged(spark, [hit("q", "t", 1e-6), hit("p", "t", 1e-7)], evalue=5e-7)[("p", "t")] == "kept"
    assert judged(spark, [hit("q", "t", 1e-6), hit("p", "t", 1e-7)])[("q", "t")] == "paralog_filtered"


def test_cells_floor_and_candidates(spark):
    rows = [hit("q", "t1", 1e-8), hit("q", "t2", 1e-9), hit("q", "t3", 1e-9, "C", 10), hit("z", "t5", 1e-7, "C", 10)]
    hits = spark.createDataFrame(rows, H)
    none = spark.createDataFrame([], "protein_id string, paralog_id string")
    bands = spark.createDataFrame([("A", "IN"), ("B", "IN"), ("C", "OUT")], "proteome string, band string")
    out = bands.where("band = 'OUT'")
    j = P.coverage_floor(P.compete(hits, none), out, 40)
    cells = {(r.protein_id, r.proteome): (r.best_evalue, r.best_target) for r in P.presence_cells(j).collect()}
    assert cells == {("q", "A"): (None, None), ("q", "B"): (1e-9, "t2")}
    assert [(r.query_id, r.target_proteome) for r in P.flipped_cells(j, out).orderBy("query_id").collect()] == [("q", "C"), ("z", "C")]
    got = P.candidate_ids(P.candidates(P.presence_cells(j), bands, "IN", 1.0, 0.0)).collect()
    assert [r.candidate for r in got] == ["A::q"]


def test_floor_without_coverage_fails(spark):
    hits = spark.createDataFrame([hit("q", "t", 1e-9, "C", None)], H)
    none = spark.createDataFrame([], "protein_id string, paralog_id string")
    out = spark.createDataFrame([("C", "OUT")], "proteome string, band string")
    with pytest.raises(Exception, match="no qcov"):
        P.coverage_floor(P.compete(hits, none), out, 40).collect()


def test_bad_scope():
    with pytest.raises(ValueError):
        P._scope_key("genome")
