import pytest
from pyspark.sql import functions as F

from genespark.functions import ids as ID
from genespark.operators import checks as K
from genespark.operators.pangenome import gap_blocks
from genespark.operators.select import short_names
from genespark.sources import tables as TB
from genespark.sources import text as TX
from genespark.sources import uniprot as UP


def text(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_tabular_layouts_and_bad_width(spark):
    df = text(spark, "# c", "", "q\tt\t1e-9\t50", "q\tt\t1e-9\t50\t10\t99.5\t80\t300\t310", "q\tt\t1e-9\t50\t10\t99.5\t80\t70\t300\t310")
    rows = [(r.qcov, r.scov, r.qlen) for r in TX.tabular_hits(df).collect()]
    assert rows == [(None, None, None), (80.0, None, 300), (80.0, 70.0, 300)]      # not measured is never 0
    with pytest.raises(Exception, match="unrecognized"):
        TX.tabular_hits(text(spark, "q\tt\t1\t2\t3")).collect()


def test_file_names(spark):
    df = text(spark, "A_vs_B.tsv", "X_vs_A_vs_C.tsv.gz", "D.tsv")
    assert [r[0] for r in df.select(TX.proteome_of_file(F.col("value"))).collect()] == ["B", "C", "D"]


def test_fasta_from_files(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">p1 first one\nMKV\nLL*\n>p2\nAC\n>p1 second\nGG\n")
    got = {r.id: (r.header, r.sequence, r.n_copies) for r in TX.fasta(TX.fasta_records(spark, str(tmp_path))).collect()}
    assert got == {"p1": ("p1 first one", "MKVLL*", 2), "p2": ("p2", "AC", 1)}


def test_gff_parents_and_gene_priority(spark):
    cds = text(spark, "k\t.\tCDS\t10\t20\t.\t+\t.\tID=x;Parent=A,B", "k\t.\tCDS\t40\t60\t.\t+\t.\tParent=A",
               "k\t.\tCDS\t1\t5\t.\t+\t.\tParent=C;protein_id=P9")
    got = {r.protein_id: (r.start, r.end) for r in TX.protein_positions(cds).collect()}
    assert got == {"A": (10, 60), "B": (10, 20), "P9": (1, 5)}
    g = text(spark, "k\t.\tmRNA\t7\t20\t.\t+\t.\tID=g1", "k\t.\tgene\t9\t20\t.\t+\t.\tID=g1", "k\t.\tgene\tx\t20\t.\t+\t.\tID=g2")
    assert [(r.id, r.start) for r in TX.gene_index(g).collect()] == [("g1", 9)]


def test_matrix_states_and_regions(spark):
    w = spark.createDataFrame([("F1", "present", "absent"), ("F2", "genome_only", "maybe")], "family string, S1 string, S2 string")
    only = spark.createDataFrame([("F1",)], "family string")
    assert [(r.family, r.short) for r in TB.wide_matrix(w, only).collect()] == [("F1", "S1")]
    with pytest.raises(Exception, match="unknown matrix state"):
        TB.wide_matrix(w).collect()
    s = spark.createDataFrame([("S1",)], "short string")
    bad = spark.createDataFrame([("e1", "S1", "9", "3"), ("e2", "SX", "1", "3")], "id string, strain string, start string, end string")
    with pytest.raises(ValueError, match="e1: end before start"):
        TB.checked_regions(bad.orderBy("id"), s)


def test_record_parsing(spark):
    rec = "\n".join(["ID   X_Y   Reviewed;   9 AA.", "AC   P12345; Q1;", "DE   SubName: Full=Sub name {ECO:1};", "DE            EC=1.1.1.1;",
                     "OX   NCBI_TaxID=5141;", "DR   RefSeq; XP_1.1; -.", "DR   RefSeq; XP_2.1; -.", "DR   GO; GO:0001; C:cell; IEA.",
                     "DR   Pfam; PF00001; 7tm; 1.", "SQ   SEQUENCE   3 AA;", "     MK V"])
    r = UP.parse(text(spark, rec, "ID   Z_Z   Unreviewed;\nAC   A0A000;\n")).collect()
    assert len(r) == 1 and (r[0].accession, r[0].reviewed, r[0].description, r[0].ec_numbers) == ("P12345", "1", "Sub name", "1.1.1.1")
    assert (r[0].xrefs, r[0].go_ids, r[0].pfam_names, r[0].seq_len) == ("RefSeq:XP_1.1", "GO:0001:C", "7tm", 3)


def test_ids(spark):
    df = text(spark, "sp|P12345|N_X", "gi|1|gb|AB1|", "pir||S1", "plain", "other|x")
    assert [r[0] for r in df.select(ID.collapsed_id(F.col("value"))).collect()] == ["P12345", "AB1", "S1", "plain", "other|x"]
    k = text(spark, "Neurospora crassa (strain X)", "[Candida] glabrata", "Mucor sp. X", "Mucor")
    assert [r[0] for r in k.select(ID.species_key(F.col("value"))).collect()] == ["neurospora crassa", "candida glabrata", "", ""]
    lin = spark.createDataFrame([(["p", "", "c", "", "o", "", "g"], ["P", "x", "c", "", "o", "f", "h"])], "a array<string>, b array<string>")
    assert lin.select(ID.match_depth(F.col("a"), F.col("b"))).first()[0] == 5


def test_short_names_are_unique(spark):
    sp = spark.createDataFrame([("Abcde fghij a",), ("Abcdz fghix b",), ("Abcdq fghi c",), ("Mucor",)], "species string")
    got = {r.species: r.short for r in short_names(sp).collect()}
    assert sorted(got.values()) == ["Abcdfgh2", "Abcdfgh3", "Abcdfghi", "Muco"] and got["Abcde fghij a"] == "Abcdfghi"


def test_gap_blocks_attach_rescue_hits(spark):
    e = [("r", "g1", 1, 0, 10), ("r", "g2", 1, 5, 12), ("r", "g3", 1, 200, 210), ("r", "h1", 0, 40, 41), ("r", "h2", 0, 180, 181)]
    df = spark.createDataFrame(e, "region string, id string, is_gene int, start bigint, end bigint")
    got = {r.id: r.block for r in gap_blocks(df, 50).collect()}
    assert got == {"g1": 0, "g2": 0, "g3": 1, "h1": 0, "h2": 1}


def test_checks_stop_quiet_failures(spark):
    none = spark.createDataFrame([], "short string")
    one = spark.createDataFrame([("a",)], "short string")
    with pytest.raises(K.InputError):
        K.require_rows(none, "hits")
    assert K.require_rows(none, "hits", True) is none
    with pytest.raises(K.InputError):
        K.require_some_known(one, spark.createDataFrame([("b",)], "short string"), "short", "strains")
    with pytest.raises(K.InputError):
        K.require_measured(one.withColumn("q", F.lit(None).cast("int")), "q", F.lit(True), "floor")


def test_closure_of_a_comb_makes_each_pair_once(spark):
    from genespark.sources.tables import closure
    n = 700
    edges = [(f"n{i}", f"n{i + 1}") for i in range(n)] + [(f"n{i}", f"t{i}") for i in range(n + 1)]
    got = closure(spark.createDataFrame(edges, "parent string, child string"))
    want = (n + 1) * (n + 2) // 2 + n + 1
    assert got.count() == want == got.distinct().count()


def test_short_names_settle_collisions_like_one_after_another(spark):
    names = [f"{g} {e} {i}" for i in range(15) for g, e in (("Abcd", "efgh"), ("Abcd", "efgi"), ("Abcd", "efg"), ("X", ""))]
    used, want = set(), {}
    for s in sorted(names):
        parts = s.split()
        epithet = "".join(c for c in parts[1] if c.isalpha())[:4]
        base = (parts[0][:4].capitalize() + epithet)[:8]
        short, k = base, 2
        while short in used:
            short, k = f"{base[:8 - len(str(k))]}{k}", k + 1
        used.add(short)
        want[s] = short
    got = {r.species: r.short for r in short_names(spark.createDataFrame([(s,) for s in names], "species string")).collect()}
    assert got == want


def test_gene_ids_lose_transcript_and_protein_suffixes(spark):
    from pyspark.sql import functions as F

    from genespark.functions.ids import gene_of_protein, species_key
    ids = {"NCU00499-t26_1-p1": "NCU00499", "Afu1g01620-T-p1": "Afu1g01620", "G-T1-p1": "G", "G-p2": "G", "G1": "G1"}
    got = spark.createDataFrame([(k,) for k in ids], "id string").select("id", gene_of_protein(F.col("id")).alias("g"))
    assert {r.id: r.g for r in got.collect()} == ids
    names = {"Mucor cf x": "", "Mucor spp. a": "", "Mucor aff x": "", "[Candida] glabrata": "candida glabrata", "Mucor": ""}
    got = spark.createDataFrame([(k,) for k in names], "n string").select("n", species_key(F.col("n")).alias("k"))
    assert {r.n: r.k for r in got.collect()} == names


def test_large_families_are_listed_in_full(spark):
    from genespark.operators.families import cluster_summary
    rows = [(f"m{i:06d}", "big") for i in range(10_001)] + [("a", "small")]
    got = cluster_summary(spark.createDataFrame(rows, "member string, family string")).collect()
    assert sorted((r.family, r.block, r["size"], len(r.members.split(","))) for r in got) == [
        ("big", 0, 10_001, 10_000), ("big", 1, 10_001, 1), ("small", 0, 1, 1)]


def test_short_names_need_as_many_rounds_as_digits(spark, monkeypatch):
    from genespark.operators import select
    rounds = []
    keep = select.materialize
    monkeypatch.setattr(select, "materialize", lambda df: rounds.append(1) or keep(df))
    names = [f"Abcd {e} {i:03d}" for i in range(130) for e in ("efgh", "efgi")]
    got = [r.short for r in short_names(spark.createDataFrame([(s,) for s in names], "species string")).collect()]
    assert len(set(got)) == 260 and len(rounds) <= 4


def test_species_files_are_one_for_each_species(spark, tmp_path):
    from genespark.sources.sinks import write_by_species
    rows = [(f"S{i % 5}", f"P{i}", "F") for i in range(400)]
    df = spark.createDataFrame(rows, "source_proteome string, protein_id string, family string").repartition(16, "protein_id")
    write_by_species(df, str(tmp_path / "s"))
    back = spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "s"))
    assert {(r.source_proteome, r.protein_id, r.family) for r in back.collect()} == set(rows) and back.count() == 400
    assert len(list((tmp_path / "s").glob("*/*.csv"))) < 2 * 16


def test_alignment_shards_are_about_one_file_for_each_genome(spark, tmp_path):
    from genespark.sources.sinks import write_shards
    rows = [(f"S{i % 5}" if i % 40 else None, f"F{i % 3}", f"P{i}", 10.0 ** -(i % 30)) for i in range(400)]
    df = spark.createDataFrame(rows, "genome string, aligned_via string, protein_id string, evalue double").repartition(16, "protein_id")
    write_shards(df, str(tmp_path / "s"))
    back = spark.read.schema("aligned_via string, protein_id string, evalue double, genome string").json(str(tmp_path / "s"))
    assert {(r.genome, r.aligned_via, r.protein_id, r.evalue) for r in back.collect()} == set(rows) and back.count() == 400
    assert len(list((tmp_path / "s").glob("*/*.json.gz"))) < 2 * 16


def test_member_hits_equal_expanded_hits(spark):
    from genespark.operators import annotate as A
    hits = spark.createDataFrame([("f", "a", 1e-6), ("f", "a", 1e-9), ("g", "a", 1e-7), ("g", "b", None), (None, "b", 1e-8), ("f", None, 1e-8)],
                                 "family string, short string, evalue double")
    mem = spark.createDataFrame([("x", "f"), ("x", "g"), ("y", "f"), ("y", "f"), ("z", "f"), (None, "g"), ("w", None)], "member string, family string")
    want = A.expand_hits(hits, mem).groupBy("member", "short").agg(F.min("evalue").alias("e"), F.count("*").alias("n")).collect()
    got = A.member_hits(hits, mem)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want)))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")


def test_wide_tables_are_read_by_rows(spark):
    from conftest import SMALL
    from genespark.plans import QUERIES
    from genespark.plans.views import Tables
    for name in ("S14_wide_matrix", "S17_distances"):
        plan = QUERIES[name](Tables(spark, SMALL))._jdf.queryExecution().optimizedPlan().toString()
        assert "S3" not in plan, name   # no column, and no literal, for each strain
    names = spark.createDataFrame([(0, "S1"), (1, "S2")], "i int, short string")
    rows = spark.createDataFrame([("F1", ["present", "absent"]), ("F2", ["genome_only", "present"])], "family string, states array<string>")
    assert sorted(map(tuple, TB.matrix_rows(rows, names).collect())) == [("F1", "S1", "present"), ("F2", "S1", "genome_only"), ("F2", "S2", "present")]


@pytest.mark.parametrize("side", [2, 100])
def test_distance_tiles_equal_the_plain_average(spark, side):
    import random
    r = random.Random(side)
    header = [f"S{i}" for i in range(7)]
    # a row twice, one that is missing, ones that the header does not have, and no name
    rows = [(n, [r.choice([None, r.random()]) for _ in header]) for n in [*header[:6], "S2", "X", "Y", "Y", None]]
    got = {(x.a, x.b): x.dist for x in TB.distance_rows(spark.createDataFrame(rows, "name string, cells array<double>"), header, side).collect()}
    seen = {}
    for n, cells in rows:
        for m, v in zip(header, cells):
            if n and n != m:
                seen.setdefault((min(n, m), max(n, m)), []).append(v)
    want = {(n, n): 0.0 for n, _ in rows}
    for (a, b), v in seen.items():
        v = [x for x in v if x is not None]
        want[a, b] = want[b, a] = sum(v) / len(v) if v else None
    assert got.keys() == want.keys()
    assert all((got[k] is None) == (want[k] is None) and (want[k] is None or abs(got[k] - want[k]) < 1e-12) for k in want)
