"""Gene families: clusters, profile presence, screens, recovery and control scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genespark.functions.exprs import count_if, ratio
from genespark.operators.joins import split_join
from genespark.operators.presence import band_sizes
from genespark.operators.ordered import rank_within, values_at

LIST_ROWS = 10_000  # members in one row of a member list; a larger family has several numbered rows


def sized(members: DataFrame) -> DataFrame:
    return members.groupBy("family").agg(F.count(F.lit(1)).alias("size"))


def size_band(members: DataFrame, low: int = 2, high: int = 100) -> DataFrame:
    """Family size and band small / kept / oversized."""
    return sized(members).withColumn(
        "band", F.when(F.col("size") < low, "small").when(F.col("size") > high, "oversized").otherwise("kept"))


def singletons(members: DataFrame) -> DataFrame:
    """Members of families of exactly one."""
    return members.groupBy("family").agg(F.count(F.lit(1)).alias("size"), F.min("member").alias("member")).where(
        F.col("size") == 1).select("family", "member")


def candidate_families(members: DataFrame, cands: DataFrame) -> DataFrame:
    """Families with at least one candidate member."""
    return members.join(cands.select(F.col("protein_id").alias("member")), "member", "left_semi").select(
        "family").distinct()


def extend_queries(ids: DataFrame, paralogs: DataFrame) -> DataFrame:
    """P10: the proteins and their paralogs."""
    extra = paralogs.join(ids, "protein_id", "left_semi").select(F.col("paralog_id").alias("protein_id"))
    return ids.select("protein_id").union(extra).distinct()


def whole_list(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Size ``n`` and sorted, comma-joined values per key, for lists that are one value of their row's subject."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list(value)), ",").alias(out))


def list_blocks(members: DataFrame, rows: int | None = None) -> DataFrame:
    """(family, block, list): sorted members, ``rows`` to a block. No family is gathered in one task or row."""
    ranked = rank_within(members.select("family", "member"), ["family"], [F.col("member")], "_r")
    block = F.floor(F.col("_r") / (rows or LIST_ROWS)).cast("bigint")
    return ranked.groupBy("family", block.alias("block")).agg(F.array_sort(F.collect_list("member")).alias("list"))


def cluster_summary(members: DataFrame) -> DataFrame:
    """Size and members per cluster; the members of a large one stand in several numbered rows."""
    lists = list_blocks(members).select("family", "block", F.array_join("list", ",").alias("members"))
    return lists.join(sized(members), "family")


def family_payload(members: DataFrame, species: DataFrame) -> DataFrame:
    """Size and distinct species of each family (species are as few as genomes)."""
    tagged = members.join(species, "member", "left")
    sp = tagged.where(F.col("species").isNotNull()).select("family", "species").distinct()
    return sized(members).join(
        whole_list(sp, ["family"], "species", "species").withColumnRenamed("n", "n_species"), "family", "left"
    ).fillna(0, ["n_species"])


def species_novelties(found: DataFrame, samples: DataFrame, members: DataFrame) -> DataFrame:
    """Novel proteins with species, family, family size and the other family members.

    Only families with a novel protein are listed. ``block`` numbers the rows of a
    protein whose family fills several lists.
    """
    species = samples.where(F.col("grp") == "IN").select(F.col("short").alias("source_proteome"), "species")
    rows = found.join(species, "source_proteome").join(
        members.select(F.col("member").alias("protein_id"), "family"), "protein_id", "left")
    sizes = sized(members).withColumnRenamed("size", "family_size")
    wanted = members.join(rows.select("family"), "family", "left_semi")
    others = F.array_except("list", F.array("protein_id"))
    return rows.join(sizes, "family", "left").join(list_blocks(wanted), "family", "left").withColumns({
        "family_size": F.coalesce("family_size", F.lit(1)), "block": F.coalesce("block", F.lit(0)),
        "other_members": F.when(F.size(others) > 0, F.array_join(others, ","))}).drop("list")


def short_union(hits: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """``covered`` positions of closed intervals on a query, per key.

    Starts are distinct per key, so a key has no more rows than the query has
    positions and a plain window holds it.
    """
    spans = hits.groupBy(*keys, start).agg(F.max(end).alias(end))
    before = Window.partitionBy(*keys).orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
    fresh = spans.withColumn("_from", F.greatest(F.col(start), F.coalesce(F.max(end).over(before) + 1, F.col(start))))
    return fresh.groupBy(*keys).agg(F.sum(F.greatest(F.lit(0), F.col(end) - F.col("_from") + 1)).cast("bigint").alias("covered"))


def domain_coverage(hits: DataFrame, domain_evalue: float | None = 1e-5) -> DataFrame:
    """W7 per (proteome, family, target): merged profile positions, profile length and full E."""
    if domain_evalue is not None:
        hits = hits.where(F.col("i_evalue") < domain_evalue)
    keys = ["proteome", "query", "target"]
    spans = short_union(hits, keys, "hmm_from", "hmm_to")
    heads = hits.groupBy(*keys).agg(F.min("qlen").alias("qlen"), F.min("full_evalue").alias("full_evalue"))
    return heads.join(spans, keys)


def family_presence(
    hits: DataFrame, evalue: float = 1e-3, coverage: float = 0.3, residues: int = 100,
    domain_evalue: float | None = 1e-5,
) -> DataFrame:
    """(family, proteome, best_evalue) where one target alone passes E-value and coverage."""
    cov = domain_coverage(hits, domain_evalue)
    enough = F.coalesce(ratio(F.col("covered"), F.col("qlen")), F.lit(0.0)) >= coverage
    if residues > 0:
        enough = enough | (F.col("covered") >= residues)
    return cov.where((F.col("full_evalue") < evalue) & enough).groupBy(
        F.col("query").alias("family"), "proteome").agg(F.min("full_evalue").alias("best_evalue"))


def family_cells(members: DataFrame, sources: DataFrame, presence: DataFrame) -> DataFrame:
    """Family presence given to every member; the member's own genome is always present.

    Members without a known source genome are skipped.
    """
    own = members.join(sources, "member")
    spread = split_join(own, presence, ["family"]).select(
        F.col("member").alias("protein_id"), "source_proteome", "proteome", "best_evalue")
    selves = own.select(
        F.col("member").alias("protein_id"), "source_proteome", F.col("source_proteome").alias("proteome"),
        F.lit(None).cast("double").alias("best_evalue"))
    return spread.where(F.col("proteome") != F.col("source_proteome")).unionByName(selves)


def discovery_cells(
    members: DataFrame, sources: DataFrame, presence: DataFrame, singleton_cells: DataFrame
) -> DataFrame:
    """Families of two or more by profile, singletons by their scored hits."""
    alone = singletons(members).select("family")
    fam = family_cells(members.join(alone, "family", "left_anti"), sources, presence)
    lone = members.join(alone, "family", "left_semi").join(sources, "member")
    hit = lone.join(singleton_cells.withColumnRenamed("query_id", "member"), "member").select(
        F.col("member").alias("protein_id"), "source_proteome", "proteome", "best_evalue"
    ).where(F.col("proteome") != F.col("source_proteome"))
    selves = lone.select(
        F.col("member").alias("protein_id"), "source_proteome", F.col("source_proteome").alias("proteome"),
        F.lit(None).cast("double").alias("best_evalue"))
    return fam.unionByName(hit).unionByName(selves)


def screen(cands: DataFrame, members: DataFrame, near: DataFrame, broad: DataFrame) -> DataFrame:
    """A10: class of each candidate from near-ingroup and broad-outgroup presence of its family."""
    rep = cands.join(members.select(F.col("member").alias("protein_id"), "family"), "protein_id", "left").withColumn(
        "rep", F.coalesce("family", "protein_id"))
    n = near.select(F.col("family").alias("rep"), F.lit(1).alias("_near")).distinct()
    b = broad.select(F.col("family").alias("rep"), F.lit(1).alias("_broad")).distinct()
    label = F.when(F.col("_broad") == 1, "false_novelty").when(F.col("_near") == 1, "clade_specific").otherwise(
        "target_specific")
    return rep.join(n, "rep", "left").join(b, "rep", "left").withColumn("novelty_category", label).drop(
        "_near", "_broad", "family")


def genome_hit_coverage(hits: DataFrame, lengths: DataFrame, evalue: float = 1e-5) -> DataFrame:
    """Per (query, genome) covered share of the query (at most 1), HSP count and best E."""
    ok = hits.where(F.col("evalue") <= evalue)
    keys = ["query", "genome"]
    spans = short_union(
        ok.select(*keys, F.least("qstart", "qend").alias("a"), F.greatest("qstart", "qend").alias("b")), keys, "a", "b")
    head = ok.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_hsps"), F.min("evalue").alias("best_evalue"),
        F.min(F.least("qstart", "qend")).alias("span_start"), F.max(F.greatest("qstart", "qend")).alias("span_end"))
    cov = F.when(F.col("length") > 0, F.least(F.lit(1.0), F.col("covered") / F.col("length")))
    return head.join(spans, keys).join(lengths, "query", "left").withColumn("query_span_cov", cov)


def busco_recovery(busco: DataFrame, members: DataFrame, min_species: int = 2) -> DataFrame:
    """Per BUSCO recovered (one family, all mapped) / split / partial."""
    mapped = busco.join(members.select(F.col("member").alias("protein_id"), "family"), "protein_id", "left")
    n_fam = F.countDistinct("family")
    n_un = count_if(F.col("family").isNull())
    return mapped.groupBy("busco_id").agg(
        F.count(F.lit(1)).alias("n_species"), n_fam.alias("n_families"), n_un.alias("n_unmapped"),
        F.when((n_fam == 1) & (n_un == 0), "recovered").when(n_fam > 1, "split").otherwise("partial")
        .alias("verdict")).where(F.col("n_species") >= min_species)


def overmerged(busco: DataFrame, members: DataFrame, min_species: int = 2) -> DataFrame:
    """Families that hold more than one eligible BUSCO."""
    ok = busco.groupBy("busco_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_species)
    return busco.join(ok, "busco_id", "left_semi").join(
        members.select(F.col("member").alias("protein_id"), "family"), "protein_id").groupBy("family").agg(
        F.countDistinct("busco_id").alias("n_buscos")).where(F.col("n_buscos") > 1)


def length_bucket(length):
    return (F.when(length.isNull(), "unknown").when(length < 150, "<150aa").when(length < 300, "150-300aa")
            .when(length < 600, "300-600aa").otherwise(">600aa"))


def busco_presence(
    busco: DataFrame, lengths: DataFrame, members: DataFrame, fam_presence: DataFrame, row_proteins: DataFrame,
    min_species: int = 2,
) -> DataFrame:
    """Presence verdict per (BUSCO, species) for BUSCOs whose members lie in one family.

    ``row_proteins`` holds the proteins with a matrix row; ``fam_presence`` the
    (family, proteome) cells. A species whose own copy is a row of the family
    is not scored.
    """
    fam = members.select(F.col("member").alias("protein_id"), "family")
    mapped = busco.join(fam, "protein_id", "left")
    one = mapped.groupBy("busco_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("family").alias("nf"), F.min("family").alias("family_rep")
    ).where((F.col("n") >= min_species) & (F.col("nf") == 1)).select("busco_id", "family_rep")
    rows = row_proteins.select("protein_id", F.lit(1).alias("_row")).distinct()
    rep_rows = fam.join(rows, "protein_id", "left_semi").select(
        F.col("family").alias("family_rep"), F.lit(1).alias("_has_row")).distinct()
    present = fam_presence.select(
        F.col("family").alias("family_rep"), F.col("proteome").alias("species"), F.lit(1).alias("_present")).distinct()
    pairs = mapped.join(one, "busco_id").join(rows, "protein_id", "left").where(
        ~(F.col("family").isNotNull() & F.col("_row").isNotNull()))
    pairs = pairs.join(rep_rows, "family_rep", "left").join(present, ["family_rep", "species"], "left").join(
        lengths, "busco_id", "left")
    return pairs.select(
        "busco_id", "species", "family_rep", "length", length_bucket(F.col("length")).alias("length_bucket"),
        F.when(F.col("_has_row").isNull(), "no_row").when(F.col("_present") == 1, "present").otherwise("absent")
        .alias("verdict"))


def bucket_rates(pairs: DataFrame) -> DataFrame:
    scored = pairs.where(F.col("verdict") != "no_row")
    return scored.groupBy("length_bucket").agg(
        F.count(F.lit(1)).alias("n"), (count_if(F.col("verdict") == "present") / F.count(F.lit(1)))
        .alias("recovery_rate"))


def length_summary(lengths: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """N, elements at n/4, n/2, 3n/4 (not interpolated) and tail shares."""
    n = F.col("n")
    x = F.col("length")
    also = [(F.sum(F.when(x > 600, F.col("_n")).otherwise(0))).alias("_gt"),
            (F.sum(F.when(x < 150, F.col("_n")).otherwise(0))).alias("_lt")]
    out = values_at(lengths, "length", group, {
        "p25": F.floor(n / 4), "median": F.floor(n / 2), "p75": F.floor(3 * n / 4)}, also)
    return out.select(*group, "n", "p25", "median", "p75", F.round(F.col("_gt") / n, 3).alias("frac_gt600"),
                      F.round(F.col("_lt") / n, 3).alias("frac_lt150"))


def resolve_controls(
    controls: DataFrame, members: DataFrame, busco: DataFrame, domain_hits: DataFrame, max_evalue: float | None = None
) -> DataFrame:
    """Control anchor -> family, by protein, by BUSCO id or by the best profile hit."""
    fam = members.select(F.col("member").alias("_pid"), F.col("family").alias("_fam"))
    b = busco.groupBy(F.col("busco_id").alias("anchor")).agg(F.min("protein_id").alias("_bp"))
    best = domain_hits if max_evalue is None else domain_hits.where(F.col("full_evalue") <= max_evalue)
    best = best.groupBy(F.col("target").alias("anchor")).agg(
        F.min_by("query", F.struct("full_evalue", "query")).alias("_hit"))
    kind = F.col("anchor_type")
    out = controls.join(b, "anchor", "left").withColumn(
        "_pid", F.when(kind == "protein_id", F.col("anchor")).when(kind == "busco", F.col("_bp")))
    out = out.join(fam, "_pid", "left").join(best, "anchor", "left")
    rep = F.when(kind == "fasta", F.col("_hit")).otherwise(F.col("_fam"))
    note = (F.when(rep.isNotNull(), "")
            .when(kind == "protein_id", "protein not in any profiled family")
            .when((kind == "busco") & F.col("_bp").isNull(), "no BUSCO map entry")
            .when(kind == "busco", "busco protein not in any profiled family")
            .when(kind == "fasta", "no family profile hit").otherwise("unknown anchor_type"))
    return out.withColumn("resolved_family", rep).withColumn("note", note).drop("_pid", "_bp", "_fam", "_hit")


def score_controls(
    resolved: DataFrame, fam_presence: DataFrame, bands: DataFrame, min_frac: float = 0.75, other_max: float = 0.0
) -> DataFrame:
    """Family call and outcome (hit / miss / tn / fp / unresolved) per control."""
    n_in, n_out = band_sizes(bands)
    counts = fam_presence.select("family", "proteome").distinct().join(bands, "proteome", "left").groupBy(
        F.col("family").alias("resolved_family")).agg(
        count_if(F.col("band") == "IN").alias("_i"), count_if(F.col("band") == "OUT").alias("_o"))
    frac = lambda c, n: F.col(c) / n if n else F.lit(0.0)
    novel = (frac("_i", n_in) >= min_frac) & (frac("_o", n_out) <= other_max)
    out = resolved.join(counts, "resolved_family", "left").withColumn(
        "actual_call", F.when(F.col("_i").isNull(), "unresolved").when(novel, "novel").otherwise("not_novel"))
    call, cls = F.col("actual_call"), F.lower(F.trim("class"))
    outcome = (F.when(call == "unresolved", "unresolved")
               .when(cls == "positive", F.when(call == "novel", "hit").otherwise("miss"))
               .when(cls == "negative", F.when(call == "novel", "fp").otherwise("tn")).otherwise("n/a"))
    return out.withColumn("outcome", outcome).drop("_i", "_o")


def control_summary(scored: DataFrame) -> DataFrame:
    pos, neg = F.lower(F.trim("class")) == "positive", F.lower(F.trim("class")) == "negative"
    res = F.col("outcome") != "unresolved"
    hits, fps = count_if(F.col("outcome") == "hit"), count_if(F.col("outcome") == "fp")
    return scored.agg(
        F.count(F.lit(1)).alias("n_controls"), count_if(pos).alias("n_positive"),
        count_if(pos & res).alias("n_positive_resolved"), hits.alias("positive_hits"),
        ratio(hits, count_if(pos & res)).alias("recall"), ratio(hits, count_if(pos)).alias("recall_all"),
        count_if(neg).alias("n_negative"), count_if(neg & res).alias("n_negative_resolved"),
        fps.alias("negative_fp"), ratio(fps, count_if(neg & res)).alias("fp_rate"),
        count_if(~res).alias("n_unresolved"))


def ambiguous_families(
    members: DataFrame, sources: DataFrame, fam_presence: DataFrame, bands: DataFrame,
    min_frac: float = 0.75, other_max: float = 0.0, max_members: int = 100,
) -> DataFrame:
    """Families with a duplicated genome, enough ingroup and too much outgroup; not oversized."""
    dup = members.join(sources, "member").groupBy("family").agg(
        F.count(F.lit(1)).alias("known"), F.countDistinct("source_proteome").alias("genomes")).where(
        F.col("known") > F.col("genomes"))
    fits = sized(members).where(F.col("size") <= max_members)
    n_in, n_out = band_sizes(bands)
    frac = fam_presence.select("family", "proteome").distinct().join(bands, "proteome").groupBy("family").agg(
        count_if(F.col("band") == "IN").alias("n_in"), count_if(F.col("band") == "OUT").alias("n_out"))
    share = lambda c, n: F.col(c) / n if n else F.lit(0.0)
    return frac.where((share("n_in", n_in) >= min_frac) & (share("n_out", n_out) > other_max)).join(
        dup.select("family"), "family", "left_semi").join(fits.select("family", "size"), "family")


def negative_control_thresholds(reps: DataFrame, domain_hits: DataFrame, default: float = 1e-3) -> DataFrame:
    """Best negative-control E per family, else the default, with its source."""
    best = domain_hits.groupBy(F.col("query").alias("family")).agg(F.min("full_evalue").alias("_e"))
    return reps.join(best, "family", "left").select(
        "family", F.coalesce("_e", F.lit(default)).alias("threshold_evalue"),
        F.when(F.col("_e").isNull(), "global_default").otherwise("negative_control").alias("calibration_source"))


SWEEP_GATES = ("presence_recovery", "recall", "fp_rate")
SWEEP_DEFAULTS = {"min_seq_id": 0.3, "cov": 0.8, "hmm_evalue": 1e-3, "hmm_cov": 0.3, "hmm_residues": 100.0}


def score_sweep(
    points: DataFrame, min_busco: float = 0.8, min_presence: float = 0.8, max_fp: float = 0.0
) -> DataFrame:
    """A gate applies only if its metric was measured somewhere; a blank gate cell is not scored."""
    seen = points.agg(*[F.max(F.col(c).isNotNull().cast("int")).alias(c) for c in SWEEP_GATES])
    on = {c: seen.select(c).scalar() == 1 for c in SWEEP_GATES}
    blank = F.col("n_novelties").isNull()
    for c in SWEEP_GATES:
        blank = blank | (on[c] & F.col(c).isNull())
    used = lambda c: F.when(on[c], F.col(c)).otherwise(F.lit(0.0))
    run_ok = F.coalesce("run_ok", F.lit(1))
    busco = F.coalesce("busco_recovery", F.lit(0.0))
    ok = (run_ok >= 1) & (busco >= min_busco)
    ok = ok & (~on["fp_rate"] | (F.col("fp_rate") <= max_fp))
    ok = ok & (~on["presence_recovery"] | (F.col("presence_recovery") >= min_presence))
    score = F.round(busco + used("recall") + used("presence_recovery") - used("fp_rate"), 6)
    return (points.withColumn("run_ok", run_ok).withColumn("unscored", blank.cast("int"))
            .withColumn("admissible", F.when(blank, 0).otherwise(F.coalesce(ok.cast("int"), F.lit(0))))
            .withColumn("composite", F.when(~blank, score)))


def knee(scored: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """the chosen sweep point; falls back to all completed, scored points when none is admissible."""
    any_ok = scored.agg(F.max("admissible").alias("a")).scalar()
    pool = scored.where(F.when(any_ok == 1, F.col("admissible") == 1).otherwise(
        (F.col("run_ok") >= 1) & (F.col("unscored") == 0)))
    top = pool.agg(F.max("composite").alias("t")).scalar()
    default = F.lit(0)
    same = F.lit(True)
    for c, v in SWEEP_DEFAULTS.items():
        same = same & (F.col(c) == v)
    default = F.when(same, 0).otherwise(1)
    return pool.where(F.col("composite") >= top - tolerance).orderBy(
        "n_novelties", default, F.col("composite").desc(), F.col("recall").desc(), *SWEEP_DEFAULTS
    ).limit(1).withColumn("used_fallback", F.when(any_ok == 1, 0).otherwise(1))
