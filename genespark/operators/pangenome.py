"""Family x strain matrix: counts, rescue, frequency bins, per-strain tables, assembly quality.

The matrix is kept long and sparse: one row per present cell with ``state``
(present / genome_only) and ``copies``; an absent cell has no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genespark.functions.exprs import at_terminus, count_if, flag, ratio
from genespark.operators.checks import require_some_known
from genespark.operators.joins import overlap_semi, split_join
from genespark.session import materialize
from genespark.operators.ordered import average_rank, chunk_rows, median_within, running

CLASSES = ["core", "soft_core", "shell", "cloud", "singleton", "nonrep_only", "absent"]
COUNTED = ["core", "soft_core", "shell", "cloud", "singleton", "nonrep_only", "outgroup_only"]


def copy_matrix(members: DataFrame, strains: DataFrame, sep: str = "|") -> DataFrame:
    """Members per (family, strain); the strain is the id part before the first separator."""
    own = members.withColumn("short", F.substring_index("member", sep, 1))
    known = require_some_known(own, strains, "short", "member prefixes").join(strains.select("short"), "short", "left_semi")
    return known.groupBy("family", "short").agg(F.count(F.lit(1)).alias("copies")).withColumn(
        "state", F.lit("present"))


def unknown_members(members: DataFrame, strains: DataFrame, sep: str = "|") -> DataFrame:
    """Members whose prefix is no known strain, counted per prefix."""
    own = members.withColumn("short", F.substring_index("member", sep, 1))
    return own.join(strains.select("short"), "short", "left_anti").groupBy("short").agg(
        F.count(F.lit(1)).alias("n_unknown"))


def representatives(df: DataFrame, inventory: DataFrame | None) -> DataFrame:
    """Rows of representative strains; no inventory keeps every strain."""
    if inventory is None:
        return df
    return df.join(inventory.where(F.col("is_rep") == 1).select("short"), "short", "left_semi")


def absent_cells(matrix: DataFrame, families: DataFrame, strains: DataFrame) -> DataFrame:
    """(strain, family) cells with no presence, as rescue queries.

    A strain misses most families of a large pangenome, so the answer itself
    has families x strains rows; each strain row meets the family list in as
    many blocks as leave about a million cells to a block.
    """
    n = max(1, -(-families.count() * strains.count() // 1_000_000))
    blocks = families.select("family", F.pmod(F.xxhash64("family"), F.lit(n)).alias("_block"))
    spread = strains.select("short", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))).alias("_block"))
    every = spread.join(blocks, "_block").select("family", "short")
    return every.join(matrix.select("family", "short"), ["family", "short"], "left_anti")


def background_families(freq: DataFrame) -> DataFrame:
    """Shell and cloud families."""
    return freq.where(F.col("bin").isin("shell", "cloud")).select("family")


def qualifying_hits(hits: DataFrame, min_pident: float = 90.0, min_qcov: float = 80.0) -> DataFrame:
    return hits.where((F.col("pident") >= min_pident) & (F.col("qcovs") >= min_qcov)).withColumn(
        "start", F.least("sstart", "send")).withColumn("end", F.greatest("sstart", "send"))


def rescue_filter(
    hits: DataFrame, genes: DataFrame, lengths: DataFrame, min_rep_length: int = 150,
    hotspot_bp: int = 2000, hotspot_families: int = 3,
) -> DataFrame:
    """A16 (with J8): qualifying hits labelled overlap / short_rep / hotspot / accepted, in that order.

    ``hits`` carry hit_id, family, short, contig, start, end; ``genes`` carry
    family, short, contig, start, end.
    """
    other = genes.where(F.col("family").isNotNull()).select(
        "short", "contig", F.col("family").alias("r_family"), F.col("start").alias("r_start"),
        F.col("end").alias("r_end"))
    on_gene = overlap_semi(
        hits.select("hit_id", "family", "short", "contig", "start", "end"), other, ["short", "contig"], ["hit_id"],
        F.col("family") != F.col("r_family"), width=20_000).withColumn("_on_gene", F.lit(1))
    rows = hits.join(on_gene, "hit_id", "left").join(lengths.withColumnRenamed("length", "_len"), "family", "left")
    rows = rows.withColumn("_first", F.when(F.col("_on_gene") == 1, "overlap").when(
        F.col("_len") < min_rep_length, "short_rep").otherwise("clear"))
    rows = rows.withColumn("_window", F.floor(F.col("start") / hotspot_bp).cast("bigint"))
    crowd = rows.where(F.col("_first") == "clear").select("short", "contig", "_window", "family").distinct().groupBy(
        "short", "contig", "_window").agg(F.count(F.lit(1)).alias("_families"))
    rows = rows.join(crowd, ["short", "contig", "_window"], "left")
    label = F.when(F.col("_first") != "clear", F.col("_first")).when(
        F.col("_families") >= hotspot_families, "hotspot").otherwise("accepted")
    return rows.withColumn("outcome", label).drop("_on_gene", "_len", "_first", "_window", "_families")


def apply_rescue(matrix: DataFrame, accepted: DataFrame, families: DataFrame, strains: DataFrame) -> DataFrame:
    """Absent -> genome_only for accepted cells of known families and strains; never a downgrade."""
    cells = accepted.select("family", "short").distinct().join(families.select("family"), "family", "left_semi").join(
        strains.select("short"), "short", "left_semi")
    new = cells.join(matrix, ["family", "short"], "left_anti").select(
        "family", "short", F.lit(0).cast("bigint").alias("copies"), F.lit("genome_only").alias("state"))
    return matrix.select("family", "short", "copies", "state").unionByName(new)


def rescue_funnel(
    all_hits: DataFrame, labelled: DataFrame, matrix: DataFrame, families: DataFrame, strains: DataFrame
) -> DataFrame:
    """Funnel counts as (metric, value) rows."""
    parsed = all_hits.agg(F.count(F.lit(1)).alias("value")).select(F.lit("rows_parsed").alias("metric"), "value")
    stage = labelled.agg(
        F.count(F.lit(1)).alias("rows_passed_threshold"),
        *[count_if(F.col("outcome") == o).alias(f"rows_rejected_{o}") for o in ("overlap", "short_rep", "hotspot")])
    names = stage.columns
    stage = stage.unpivot([], names, "metric", "value")
    cells = labelled.where(F.col("outcome") == "accepted").select("family", "short").distinct()
    state = cells.join(families.select("family", F.lit(1).alias("_f")), "family", "left").join(
        strains.select("short", F.lit(1).alias("_s")), "short", "left").join(
        matrix.select("family", "short", F.lit(1).alias("_p")), ["family", "short"], "left")
    known = F.col("_f").isNotNull() & F.col("_s").isNotNull()
    done = state.agg(count_if(known & F.col("_p").isNull()).alias("applied"), count_if(~known).alias("skipped"))
    return parsed.unionByName(stage).unionByName(done.unpivot([], ["applied", "skipped"], "metric", "value"))


def best_rescue_positions(hits: DataFrame) -> DataFrame:
    """Highest-bitscore qualifying hit per (family, strain); ties by contig and start."""
    best = hits.where(F.col("contig") != "").groupBy("family", "short").agg(
        F.min(F.struct((-F.col("bitscore")).alias("b"), "contig", "start", "end")).alias("h"))
    return best.select("family", "short", "h.contig", "h.start", "h.end")


def _bin(count: Column, reps: int, cuts: Sequence[float]) -> Column:
    core, soft, shell = cuts
    freq = count / reps
    return (F.when(count <= 1, "singleton").when(freq >= core, "core").when(freq >= soft, "soft_core")
            .when(freq >= shell, "shell").otherwise("cloud"))


def frequency_table(
    matrix: DataFrame, families: DataFrame, strains: DataFrame, cuts: Sequence[float] = (0.95, 0.90, 0.15),
    out_min: int = 3,
) -> DataFrame:
    """Frequency, carrier count and class per family, for ingroup and (if large enough) outgroup.

    One conditional aggregate over the sparse cells; only representatives count.
    """
    is_in, rep = F.col("grp") == "IN", F.col("is_rep") == 1
    is_out = F.col("grp") == "OUT"
    size = strains.agg(count_if(is_in & rep).alias("i"), count_if(is_out & rep).alias("o")).first()
    n_in, n_out = size["i"] or 0, size["o"] or 0
    counts = matrix.join(strains.select("short", "grp", "is_rep"), "short").groupBy("family").agg(
        count_if(is_in & rep).alias("c_in"), count_if(is_out & rep).alias("c_out"),
        count_if(is_in & ~rep).alias("x_in"), count_if(is_out & ~rep).alias("x_out"))
    t = families.select("family").join(counts, "family", "left").fillna(0)
    c = F.col
    in_any, out_any = (c("c_in") + c("x_in")) > 0, (c("c_out") + c("x_out")) > 0
    binned = n_out >= out_min
    bin_in = (F.when(c("c_in") >= 1, _bin(c("c_in"), max(n_in, 1), cuts)).when(c("x_in") > 0, "nonrep_only")
              .when(out_any, "outgroup_only").otherwise("absent"))
    bin_out = (F.when(F.lit(not binned), "-").when(c("c_out") >= 1, _bin(c("c_out"), max(n_out, 1), cuts))
               .when(c("x_out") > 0, "nonrep_only").when(in_any, "ingroup_only").otherwise("absent"))
    return t.select(
        "family", (c("c_in") / n_in if n_in else F.lit(0.0)).alias("frequency"), c("c_in").alias("strain_count"),
        bin_in.alias("bin"), F.when(F.lit(binned), c("c_out") / max(n_out, 1)).alias("frequency_out"),
        F.when(F.lit(binned), c("c_out")).alias("strain_count_out"), bin_out.alias("bin_out"))


def class_overlap(freq: DataFrame) -> DataFrame:
    """All 49 cells of ingroup class x outgroup class, empty ones included."""
    side = lambda c: F.when(F.col(c).isin("outgroup_only", "ingroup_only"), "absent").otherwise(F.col(c))
    counts = freq.where(F.col("bin_out") != "-").groupBy(side("bin").alias("in_class"), side("bin_out").alias("out_class")).agg(
        F.count(F.lit(1)).alias("n_families"))
    labels = F.array(*[F.lit(x) for x in CLASSES])
    grid = freq.sparkSession.range(1).select(F.explode(labels).alias("in_class")).select(
        "in_class", F.explode(labels).alias("out_class"))
    return grid.join(counts, ["in_class", "out_class"], "left").fillna(0, ["n_families"])


def strain_classes(matrix: DataFrame, freq: DataFrame, strains: DataFrame) -> DataFrame:
    """Per strain, families present by the class of the strain's own group."""
    cells = split_join(matrix.select("family", "short"), freq.select("family", "bin", "bin_out"), ["family"], "left")
    cells = cells.join(strains.select("short", "grp"), "short")
    # bin_out is "-" for every family when the outgroup is not binned
    label = F.when((F.col("grp") == "OUT") & (F.col("bin_out") != "-"), F.col("bin_out")).otherwise(F.col("bin"))
    counts = cells.groupBy("short").agg(
        F.count(F.lit(1)).alias("n_families"), *[count_if(label == k).alias(k) for k in COUNTED])
    return strains.select("short", "grp", "is_rep").join(counts, "short", "left").fillna(0, ["n_families", *COUNTED])


def outlier_flags(
    rows: DataFrame, value: str = "singleton", group: str = "grp", multiplier: float = 0.6745, threshold: float = 3.5
) -> DataFrame:
    """Modified z per group from its representatives' median and MAD; null z when undefined."""
    rows = materialize(rows)
    reps = rows.where(F.col("is_rep") == 1)
    med = median_within(reps, value, [group], "_med")
    med = materialize(med)
    dev = reps.join(med, group).withColumn("_dev", F.abs(F.col(value) - F.col("_med")))
    mad = median_within(dev, "_dev", [group], "_mad").drop("n")
    z = F.when((F.col("n") >= 3) & (F.col("_mad") > 0), multiplier * (F.col(value) - F.col("_med")) / F.col("_mad"))
    out = rows.join(med, group, "left").join(mad, group, "left").withColumn(f"{value}_z", z)
    return out.withColumn("is_outlier", F.when(z.isNull(), "-").when(F.abs(z) > threshold, "Y").otherwise("N")).drop(
        "_med", "_mad", "n")


def strain_content(matrix: DataFrame, freq: DataFrame, strains: DataFrame) -> DataFrame:
    """Families present, accessory families (class other than core), core families missing."""
    n_core = freq.agg(count_if(F.col("bin") == "core").alias("n")).scalar()
    cells = split_join(matrix.select("family", "short"), freq.select("family", "bin"), ["family"], "left")
    c = cells.groupBy("short").agg(
        F.count(F.lit(1)).alias("n_families_present"), count_if(F.col("bin") != "core").alias("accessory_present"),
        count_if(F.col("bin") == "core").alias("_core"))
    return strains.select("short").join(c, "short", "left").fillna(0).select(
        "short", "n_families_present", "accessory_present", (n_core - F.col("_core")).alias("core_missing"))


def terminus_enrichment(
    genes: DataFrame, contigs: DataFrame, matrix: DataFrame, freq: DataFrame, strains: DataFrame, window_bp: int = 1000
) -> DataFrame:
    """Genes at contig ends, all and private (families carried by exactly one strain); every strain has a row."""
    single = freq.where(F.col("bin") == "singleton").select("family")
    private = matrix.join(single, "family", "left_semi").groupBy("family").agg(
        F.count(F.lit(1)).alias("n"), F.min("short").alias("short")).where(F.col("n") == 1).select(
        "family", "short", F.lit(True).alias("_private"))
    rows = split_join(genes, contigs.select("short", "contig", "length"), ["short", "contig"])
    rows = rows.join(private, ["family", "short"], "left")
    end = at_terminus(F.col("start"), F.col("end"), F.col("length"), window_bp)
    mine = F.coalesce("_private", F.lit(False))
    out = rows.groupBy("short").agg(
        F.count(F.lit(1)).alias("n_all_proteins"), count_if(end).alias("n_all_at_terminus"),
        count_if(mine).alias("n_private_proteins"), count_if(mine & end).alias("n_private_at_terminus"))
    out = strains.select("short").join(out, "short", "left").fillna(0)
    pct = lambda a, b: F.round(100 * ratio(F.col(a), F.col(b)), 2)
    return out.withColumn("pct_private_at_terminus", pct("n_private_at_terminus", "n_private_proteins")).withColumn(
        "pct_all_at_terminus", pct("n_all_at_terminus", "n_all_proteins"))


def assembly_stats(contigs: DataFrame) -> DataFrame:
    """Contig count, total length and N50 per strain.

    Equal lengths are merged first; N50 is the largest length whose running
    sum over longer-or-equal lengths reaches half the total.
    """
    by_len = contigs.groupBy("short", "length").agg(F.count(F.lit(1)).alias("_n"))
    tot = by_len.groupBy("short").agg(
        F.sum("_n").cast("bigint").alias("n_contigs"), F.sum(F.col("length") * F.col("_n")).cast("bigint").alias("total_length"))
    order = [F.col("length").desc()]
    run = running(chunk_rows(by_len, ["short"], order), ["short"], order,
                  {"_upto": ("sum", F.col("length") * F.col("_n"), True)}).join(tot, "short")
    n50 = run.where(F.col("_upto") * 2 >= F.col("total_length")).groupBy("short").agg(F.max("length").alias("n50"))
    return tot.join(n50, "short")


def spearman(rows: DataFrame, x: str, y: str, z: str) -> DataFrame:
    """Spearman rho of x and y, raw and with z held fixed; null when constant or n < 3."""
    r = materialize(rows.select(x, y, z))
    for c in (x, y, z):
        r = average_rank(r, c, out=f"_r_{c}")
    a, b, g = (f"_r_{c}" for c in (x, y, z))
    m = r.agg(
        F.count(F.lit(1)).alias("n_strains"),
        *[F.when(F.stddev_pop(p).isNotNull() & (F.stddev_pop(p) > 0) & (F.stddev_pop(q) > 0), F.corr(p, q)).alias(k)
          for k, p, q in (("xy", a, b), ("xz", a, g), ("yz", b, g))])
    denom = F.sqrt((1 - F.col("xz") * F.col("xz")) * (1 - F.col("yz") * F.col("yz")))
    ok = F.col("n_strains") >= 3
    return m.select(
        F.lit(f"{x}_vs_{y}").alias("comparison"), "n_strains", F.when(ok, F.col("xy")).alias("rho_raw"),
        F.when(ok & (denom > 0), (F.col("xy") - F.col("xz") * F.col("yz")) / denom).alias("rho_partial_length"))


def correlation_table(rows: DataFrame) -> DataFrame:
    pairs = [(a, b) for a in ("accessory_present", "core_missing") for b in ("n_contigs", "n50")]
    out = None
    for a, b in pairs:
        one = spearman(rows, a, b, "total_length")
        out = one if out is None else out.unionByName(one)
    return out


def diagnose_rescue(funnel: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Share of qualifying hits on a gene of another family."""
    v = lambda m: F.max(F.when(F.col("metric") == m, F.col("value")))
    passed, over = v("rows_passed_threshold"), v("rows_rejected_overlap")
    return funnel.agg(passed.alias("passed"), over.alias("overlap")).select(
        F.lit("rescue_redundancy").alias("diagnostic"), ratio(F.col("overlap"), F.col("passed")).alias("value"),
        F.when(F.col("passed").isNull() | (F.col("passed") == 0), "ok").when(
            F.col("overlap") / F.col("passed") > threshold, "triggered").otherwise("ok").alias("status"))


def diagnose_confound(corr: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Largest |rho| of accessory content against assembly measures."""
    mine = corr.where(F.col("comparison").startswith("accessory_present"))
    worst = mine.agg(F.max(F.greatest(F.abs("rho_raw"), F.abs("rho_partial_length"))).alias("value"))
    return worst.select(F.lit("assembly_quality_confound").alias("diagnostic"), "value",
                        F.when(F.coalesce(F.col("value") > threshold, F.lit(False)), "triggered").otherwise("ok")
                        .alias("status"))


def representative_per_group(inventory: DataFrame) -> DataFrame:
    """the strain with the largest (N50, name) stands for its dereplication group."""
    best = inventory.groupBy("dedup_group").agg(F.max(F.struct("n50", "short")).alias("b")).select(
        "dedup_group", F.col("b.short").alias("_best"))
    return inventory.join(best, "dedup_group").withColumn(
        "is_representative", (F.col("short") == F.col("_best")).cast("int")).drop("_best")


def fill_labels(samples: DataFrame, labels: DataFrame, stratum: bool = False) -> DataFrame:
    """Empty taxon_group (and stratum) filled from clade labels; never overwritten."""
    blank = lambda c: F.when(F.trim(c) == "", None).otherwise(F.col(c))
    out = samples.join(labels.select("short", F.col("clade").alias("_clade")), "short", "left")
    out = out.withColumn("taxon_group", F.coalesce(blank("taxon_group"), "_clade", F.lit("")))
    if stratum:
        out = out.withColumn("stratum", F.coalesce(blank("stratum"), "_clade", F.lit("")))
    return out.drop("_clade")


def unlabelled_share(strains: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Share of strains without a clade label, and whether the stratified null is then weak."""
    share = F.avg(flag(F.col("clade").isNull() | (F.trim("clade") == "")))
    return strains.agg(share.alias("share")).select(
        "share", F.when(F.col("share") > threshold, "warn").otherwise("ok").alias("status"))


def contig_spans(positions: DataFrame) -> DataFrame:
    """First and last rank per (strain, contig)."""
    return positions.groupBy("short", "contig").agg(F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"))


def family_positions(genes: DataFrame, rescue: DataFrame | None = None) -> DataFrame:
    """0-based gene rank per strain over all genes and rescue hits; then genes without family are dropped."""
    rows = genes.select("short", "contig", "start", "end", F.col("protein_id").alias("id"), "family")
    if rescue is not None:
        rows = rows.unionByName(rescue.select(
            "short", "contig", "start", "end", F.concat(F.lit("~"), "family").alias("id"), "family"))
    order = [F.col("contig"), F.col("start"), F.col("id"), F.col("family"), F.col("end")]
    run = running(chunk_rows(rows, ["short"], order), ["short"], order,
                  {"rank": ("sum", F.lit(1).cast("bigint"), True)})
    return run.where(F.col("family").isNotNull()).select(
        "short", "family", "contig", (F.col("rank") - 1).alias("rank"), "start", "end", "id")


def contig_rank(genes: DataFrame) -> DataFrame:
    """0-based rank per (strain, contig)."""
    order = [F.col("start"), F.col("protein_id")]
    group = ["short", "contig"]
    run = running(chunk_rows(genes, group, order), group, order, {"rank": ("sum", F.lit(1).cast("bigint"), True)})
    return run.withColumn("rank", F.col("rank") - 1).drop("_chunk")


def sliding_windows(positions: DataFrame, n: int) -> DataFrame:
    """Windows of n consecutive placed genes on one contig, as (first rank, families).

    Consecutive means by index among the placed genes, so rows meet by an
    equi-join on an index block and no ordered window crosses a chunk border.
    """
    order = [F.col("rank")]
    idx = running(chunk_rows(positions.select("short", "contig", "family", "rank"), ["short"], order), ["short"], order,
                  {"_i": ("sum", F.lit(1).cast("bigint"), True)})
    member = idx.select("short", "contig", "family", "rank", F.explode(
        F.sequence(F.greatest(F.lit(1).cast("bigint"), F.col("_i") - (n - 1)), F.col("_i"))).alias("window"), "_i")
    return member.groupBy("short", "window").agg(
        F.count(F.lit(1)).alias("n"), F.min("contig").alias("contig"), F.max("contig").alias("_c2"),
        F.min("rank").alias("first_rank"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", "family"))), lambda s: s["family"]), ",")
        .alias("families")).where((F.col("n") == n) & (F.col("contig") == F.col("_c2"))).drop("_c2", "n", "window")


def gap_blocks(entries: DataFrame, max_gap: int) -> DataFrame:
    """Block number per entry of a region; a gene-free gap over ``max_gap`` starts a new block.

    Only genes make blocks. A rescue entry joins the nearest block (a tie goes to the earlier one).
    ``entries`` has region, id, is_gene, start, end; ``max_gap`` <= 0 keeps one block.
    """
    group, order = ["region"], [F.col("start"), F.col("id")]
    gene = F.col("is_gene") == 1
    rows = running(chunk_rows(entries, group, order), group, order, {"_reach": ("max", F.when(gene, F.col("end")), False)})
    new = gene & (F.lit(max_gap) > 0) & (F.col("start") - F.col("_reach") > max_gap)
    rows = materialize(rows.withColumn("_new", F.coalesce(new, F.lit(False)).cast("int")))
    rows = materialize(running(rows, group, order, {"block": ("sum", F.col("_new").cast("bigint"), True)}))
    genes = rows.where(gene).select("region", "id", "start", "end", "block")
    span = genes.groupBy("region", "block").agg(F.min("start").alias("_s"), F.max("end").alias("_e"))
    # a rescue entry sits in or after block b, so b and b + 1 are its only possible neighbours
    r = rows.where(~gene).select("region", "id", "start", "end", F.explode(F.array("block", F.col("block") + 1)).alias("block"))
    d = F.when(F.col("start").between(F.col("_s"), F.col("_e")), 0).otherwise(
        F.least(F.abs(F.col("start") - F.col("_s")), F.abs(F.col("start") - F.col("_e"))))
    near = r.join(span, ["region", "block"], "left").groupBy("region", "id", "start", "end").agg(F.min(F.struct(
        F.coalesce(d, F.lit(2**62)).alias("d"), "block")).alias("n"))
    return genes.unionByName(near.select("region", "id", "start", "end", F.col("n.block").alias("block")))
