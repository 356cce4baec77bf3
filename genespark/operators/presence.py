"""Pairwise presence calls from protein hits, with paralog competition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genespark.functions.exprs import count_if, log_delta, signal_class
from genespark.operators.joins import split_join

CELL = ["query_proteome", "query_id", "target_proteome"]


def filter_hits(hits: DataFrame, evalue: float | None = None, bitscore: float | None = None) -> DataFrame:
    """Keep ``evalue <= cutoff`` and ``bitscore >= cutoff``."""
    if evalue is not None:
        hits = hits.where(F.col("evalue") <= evalue)
    if bitscore is not None:
        hits = hits.where(F.col("bitscore") >= bitscore)
    return hits


def significant(hits: DataFrame, evalue: float = 1e-5) -> DataFrame:
    """Strict significance, ``evalue < E``."""
    return hits.where(F.col("evalue") < evalue)


# Coarse bands of the group labels.
INGROUP_ROLES = ("IN", "DISCOVERY_TARGET")
OUTGROUP_ROLES = ("OUT", "DISCOVERY_OUT", "NEAR_INGROUP", "BROAD_OUTGROUP")


def banded(samples: DataFrame, in_groups=("IN",), out_groups=("OUT",)) -> DataFrame:
    """Genome -> IN / OUT band; genomes of other groups are dropped.

    The default is strict; pass INGROUP_ROLES and OUTGROUP_ROLES for the coarse bands.
    """
    band = F.when(F.col("grp").isin(*in_groups), "IN").when(F.col("grp").isin(*out_groups), "OUT")
    return samples.select(F.col("short").alias("proteome"), band.alias("band")).where(F.col("band").isNotNull())


def _scope_key(scope: str) -> Column:
    if scope not in ("target", "proteome"):
        raise ValueError(f"competition scope must be target or proteome, not {scope!r}")
    return F.col("target_id" if scope == "target" else "target_proteome")


def best_self_hits(hits: DataFrame) -> DataFrame:
    """Best non-self hit of every protein inside its own genome; ties by target id."""
    best = hits.where(F.col("query_id") != F.col("target_id")).groupBy("query_id").agg(
        F.min(F.struct("evalue", "target_id", "bitscore")).alias("b"))
    return best.select(F.col("query_id").alias("protein_id"), F.col("b.target_id").alias("paralog_id"),
                       F.col("b.bitscore").alias("bitscore"), F.col("b.evalue").alias("evalue"))


def best_evalues(hits: DataFrame, scope: str = "target") -> DataFrame:
    """Best E-value of every query against every competition key, over all hits."""
    return hits.groupBy("query_proteome", "query_id", _scope_key(scope).alias("key")).agg(
        F.min("evalue").alias("best_evalue"))


def compete(
    hits: DataFrame,
    paralogs: DataFrame,
    queries: DataFrame | None = None,
    evalue: float = 1e-5,
    scope: str = "target",
    rescue_evalue: float | None = 1e-20,
    rescue_delta: float | None = None,
) -> DataFrame:
    """Paralog competition.

    Returns the significant hits of the ``queries`` genomes with ``paralog_id``,
    ``paralog_evalue`` and ``status`` (kept / paralog_filtered). A hit is
    filtered when the query's own paralog reaches the same key with a smaller
    E-value, unless the hit passes the absolute floor or lies within
    ``rescue_delta`` orders of magnitude. The paralog's best E-value is taken
    over all hits, before any filter.
    """
    best = best_evalues(hits, scope).select(
        "query_proteome", F.col("query_id").alias("paralog_id"), "key",
        F.col("best_evalue").alias("paralog_evalue"))
    judged = significant(hits, evalue)
    if queries is not None:
        judged = judged.join(queries.select(F.col("proteome").alias("query_proteome")), "query_proteome", "left_semi")
    partner = paralogs.select(F.col("protein_id").alias("query_id"), "paralog_id")
    judged = split_join(judged, partner, ["query_id"], "left").withColumn("key", _scope_key(scope))
    judged = judged.join(best, ["query_proteome", "paralog_id", "key"], "left").drop("key")
    beaten = F.col("paralog_evalue") < F.col("evalue")
    rescued = F.lit(False)
    if rescue_evalue:
        rescued = rescued | (F.col("evalue") <= rescue_evalue)
    if rescue_delta is not None:
        rescued = rescued | (log_delta(F.col("evalue"), F.col("paralog_evalue")) < rescue_delta)
    status = F.when(F.coalesce(beaten & ~rescued, F.lit(False)), "paralog_filtered").otherwise("kept")
    return judged.withColumn("status", status)


def coverage_floor(judged: DataFrame, others: DataFrame, floor: float | None) -> DataFrame:
    """A4: mark kept hits to other-group genomes with ``qcov < floor``.

    A judged hit without a coverage value is an error, never skipped.
    """
    if not floor:
        return judged
    side = others.select(F.col("proteome").alias("target_proteome"), F.lit(True).alias("_other"))
    judged = judged.join(side, "target_proteome", "left")
    is_judged = F.col("_other") & (F.col("status") == "kept")
    qcov = F.when(
        is_judged & F.col("qcov").isNull(),
        F.raise_error(F.lit("coverage floor requested but a judged hit has no qcov")).cast("double"),
    ).otherwise(F.col("qcov").cast("double"))
    return judged.withColumn(
        "status", F.when(F.coalesce(is_judged, F.lit(False)) & (qcov < floor), "coverage_floor")
        .otherwise(F.col("status"))).drop("_other")


def flipped_cells(judged: DataFrame, others: DataFrame) -> DataFrame:
    """Other-group cells that lose every hit to the coverage floor."""
    side = others.select(F.col("proteome").alias("target_proteome"))
    cells = judged.where(F.col("status") != "paralog_filtered").join(side, "target_proteome", "left_semi")
    return cells.groupBy(*CELL).agg(F.max((F.col("status") == "kept").cast("int")).alias("kept")).where(
        F.col("kept") == 0).select(*CELL)


def presence_cells(judged: DataFrame) -> DataFrame:
    """A1 + A2: long presence table of the proteins with a kept hit.

    One row per present (source, protein, proteome) with the best E-value and
    its target (ties by target id); the source genome's own cell has neither.
    """
    hit = F.struct(F.col("target_proteome").alias("proteome"), "evalue", "target_id")
    own = F.struct(
        F.col("query_proteome").alias("proteome"), F.lit(None).cast("double").alias("evalue"),
        F.lit(None).cast("string").alias("target_id"))
    kept = judged.where(F.col("status") == "kept").select(
        F.col("query_proteome").alias("source_proteome"), F.col("query_id").alias("protein_id"),
        F.explode(F.array(hit, own)).alias("c"))
    cells = kept.groupBy("source_proteome", "protein_id", "c.proteome").agg(
        F.min(F.struct("c.evalue", "c.target_id")).alias("best"))
    return cells.select(
        "source_proteome", "protein_id", "proteome", F.col("best.evalue").alias("best_evalue"),
        F.col("best.target_id").alias("best_target"))


def band_counts(cells: DataFrame, bands: DataFrame, keys=("source_proteome", "protein_id")) -> DataFrame:
    """Present genomes per protein in each band."""
    return cells.join(bands, "proteome", "left").groupBy(*keys).agg(
        count_if(F.col("band") == "IN").alias("n_in"), count_if(F.col("band") == "OUT").alias("n_out"))


def band_sizes(bands: DataFrame) -> tuple[int, int]:
    """Genomes per band: one row read from the sample sheet."""
    row = bands.agg(*[count_if(F.col("band") == b).alias(b) for b in ("IN", "OUT")]).first()
    return row["IN"] or 0, row["OUT"] or 0


def candidates(
    cells: DataFrame, bands: DataFrame, query_group: str = "IN", min_frac: float = 0.75, other_max_frac: float = 0.0
) -> DataFrame:
    """Fraction of the query group >= min_frac and of the other group <= other_max_frac."""
    size_in, size_out = band_sizes(bands)
    out = band_counts(cells, bands)
    frac = lambda n, size: n / size if size else F.lit(0.0)
    out = out.withColumn("in_frac", frac(F.col("n_in"), size_in)).withColumn(
        "out_frac", frac(F.col("n_out"), size_out))
    mine, other = ("in_frac", "out_frac") if query_group == "IN" else ("out_frac", "in_frac")
    return out.where((F.col(mine) >= min_frac) & (F.col(other) <= other_max_frac))


def strict_candidates(cells: DataFrame, samples: DataFrame, min_frac: float = 0.75) -> DataFrame:
    """P5: in-group fraction reached and no hit in any genome of another label."""
    return candidates(cells, samples.select(
        F.col("short").alias("proteome"), F.when(F.col("grp") == "IN", "IN").otherwise("OUT").alias("band")),
        "IN", min_frac, 0.0)


def candidate_ids(df: DataFrame) -> DataFrame:
    """K2: ``source::protein``."""
    return df.select(F.concat_ws("::", "source_proteome", "protein_id").alias("candidate"))


def other_evidence(judged: DataFrame, others: DataFrame) -> DataFrame:
    """A3: one row per other-group cell with any significant hit, removed ones included."""
    side = others.select(F.col("proteome").alias("target_proteome"))
    cells = judged.join(side, "target_proteome", "left_semi").groupBy(*CELL).agg(
        F.min(F.struct("evalue", "target_id", (-F.col("bitscore")).alias("neg_bits"), "qcov", "status",
                       "paralog_evalue")).alias("b"),
        F.max("qcov").alias("max_qcov"), F.count(F.lit(1)).alias("n_hits"),
        F.max((F.col("status") == "kept").cast("int")).alias("any_kept"), F.first("paralog_id").alias("paralog_id"))
    return cells.select(
        F.col("query_id").alias("protein_id"), F.col("query_proteome").alias("source_proteome"),
        F.col("target_proteome").alias("other_proteome"), F.col("b.target_id").alias("best_target_id"),
        F.col("b.evalue").alias("best_evalue"), (-F.col("b.neg_bits")).alias("best_bitscore"),
        F.col("b.qcov").alias("best_qcov"), "max_qcov", "n_hits",
        F.when(F.col("any_kept") == 1, "kept").otherwise(F.col("b.status")).alias("status"), "paralog_id",
        F.col("b.paralog_evalue").alias("paralog_evalue"),
        log_delta(F.col("b.evalue"), F.col("b.paralog_evalue")).alias("paralog_delta"))


def low_coverage_report(judged: DataFrame, mine: DataFrame, floor: float) -> DataFrame:
    """A5: per protein, query-group cells whose best coverage stays below ``floor``."""
    side = mine.select(F.col("proteome").alias("target_proteome"))
    cells = judged.where((F.col("status") == "kept") & (F.col("target_proteome") != F.col("query_proteome")))
    cells = cells.join(side, "target_proteome", "left_semi").groupBy(*CELL).agg(F.max("qcov").alias("best_qcov"))
    low = F.col("best_qcov") < floor
    counts = cells.groupBy("query_proteome", "query_id").agg(
        F.count(F.lit(1)).alias("query_hit_cells"), count_if(low).alias("query_lowcov_cells"),
        F.array_join(F.array_sort(F.collect_set(F.when(low, F.col("target_proteome")))), ",")
        .alias("query_lowcov_proteomes"))
    every = judged.where(F.col("status") == "kept").select("query_proteome", "query_id").distinct()
    return every.join(counts, ["query_proteome", "query_id"], "left").select(
        F.col("query_id").alias("protein_id"), F.col("query_proteome").alias("source_proteome"),
        F.lit(float(floor)).alias("qcov_threshold"),
        F.coalesce("query_hit_cells", F.lit(0)).alias("query_hit_cells"),
        F.coalesce("query_lowcov_cells", F.lit(0)).alias("query_lowcov_cells"),
        F.coalesce("query_lowcov_proteomes", F.lit("")).alias("query_lowcov_proteomes"))


def candidate_signal(
    cands: DataFrame, protein_evidence: DataFrame | None, genome_evidence: DataFrame | None, threshold: float = 50.0
) -> DataFrame:
    """Signal summary per candidate; an input of ``None`` means not measured (columns stay null)."""
    out = cands.select("source_proteome", "protein_id")
    key = ["protein_id"]
    if protein_evidence is not None:
        removed = F.col("status") != "kept"
        p = protein_evidence.groupBy(*key).agg(
            F.max("max_qcov").cast("double").alias("other_protein_max_qcov"),
            count_if(removed).alias("other_protein_n_filtered"),
            F.min(F.when(removed, F.col("paralog_evalue"))).alias("other_protein_min_paralog_evalue"),
            F.lit(True).alias("_p"))
        out = out.join(p, key, "left").withColumn(
            "other_protein_n_filtered", F.coalesce("other_protein_n_filtered", F.lit(0)))
    else:
        out = out.select("*", F.lit(None).cast("double").alias("other_protein_max_qcov"),
                         F.lit(None).cast("bigint").alias("other_protein_n_filtered"),
                         F.lit(None).cast("double").alias("other_protein_min_paralog_evalue"),
                         F.lit(None).cast("boolean").alias("_p"))
    if genome_evidence is not None:
        t = genome_evidence.groupBy(*key).agg(
            F.max("query_span_cov").alias("other_tblastn_max_cov"),
            F.countDistinct("genome").alias("other_tblastn_n_genomes"), F.lit(True).alias("_t"))
        out = out.join(t, key, "left").withColumn(
            "other_tblastn_n_genomes", F.coalesce("other_tblastn_n_genomes", F.lit(0)))
    else:
        out = out.select("*", F.lit(None).cast("double").alias("other_tblastn_max_cov"),
                         F.lit(None).cast("bigint").alias("other_tblastn_n_genomes"),
                         F.lit(None).cast("boolean").alias("_t"))
    cover = F.greatest("other_protein_max_qcov", F.col("other_tblastn_max_cov") * 100)
    has_hit = F.coalesce("_p", F.lit(False)) | F.coalesce("_t", F.lit(False))
    label = signal_class(cover, has_hit, threshold)
    if protein_evidence is None and genome_evidence is None:
        label = F.lit(None).cast("string")
    return out.withColumn("other_signal_class", label).drop("_p", "_t")


def context_presence(judged: DataFrame, cands: DataFrame) -> DataFrame:
    """Best kept hit per (candidate, context genome); report only."""
    ids = cands.select(F.col("protein_id").alias("query_id")).distinct()
    kept = judged.where(F.col("status") == "kept").join(ids, "query_id", "left_semi")
    return kept.groupBy(F.col("query_id").alias("protein_id"), F.col("target_proteome").alias("proteome")).agg(
        F.min("evalue").alias("best_evalue"))


def to_wide(cells: DataFrame, genomes: list[str], value: str | None = None) -> DataFrame:
    """K1: wide export, one column per genome in sorted order.

    ``value`` None writes 0/1, otherwise that column (best_evalue or best_target).
    """
    genomes = sorted(genomes)
    agg = F.max(F.lit(1)) if value is None else F.first(value, ignorenulls=True)
    wide = cells.groupBy("protein_id", "source_proteome").pivot("proteome", genomes).agg(agg)
    return wide.fillna(0, genomes) if value is None else wide


def near_universal(cells: DataFrame, bands: DataFrame, core_min: float = 0.95) -> DataFrame:
    """Ingroup proteins present in at least ``core_min`` of all genomes."""
    size_in, size_out = band_sizes(bands)
    counts = band_counts(cells, bands)
    mine = bands.where(F.col("band") == "IN").select(F.col("proteome").alias("source_proteome"))
    frac = (F.col("n_in") + F.col("n_out")) / (size_in + size_out)
    return counts.join(mine, "source_proteome", "left_semi").withColumn("frac", frac).where(F.col("frac") >= core_min)


def losses(
    cells: DataFrame, bands: DataFrame, members: DataFrame, species: DataFrame,
    out_min_frac: float = 0.75, in_max_frac: float = 0.0,
) -> DataFrame:
    """Outgroup proteins kept by most of the outgroup and by at most ``in_max_frac`` of the ingroup.

    ``out_breadth`` and ``in_retained`` count distinct species over the kept
    members of the protein's family; a protein without family uses its own cells.
    """
    kept = candidates(cells, bands, "OUT", out_min_frac, in_max_frac)
    fam = members.select(F.col("member").alias("protein_id"), F.col("family"))
    kept = kept.join(fam, "protein_id", "left").withColumn(
        "unit", F.coalesce("family", F.concat_ws("::", F.lit("own"), "source_proteome", "protein_id")))
    seen = kept.select("source_proteome", "protein_id", "unit").join(
        cells.select("source_proteome", "protein_id", "proteome"), ["source_proteome", "protein_id"])
    seen = seen.join(bands, "proteome").join(
        species.select(F.col("short").alias("proteome"), "species"), "proteome")
    width = seen.select("unit", "band", "species").distinct().groupBy("unit").agg(
        count_if(F.col("band") == "OUT").alias("out_breadth"), count_if(F.col("band") == "IN").alias("in_retained"))
    return kept.join(width, "unit", "left").drop("unit").fillna(0, ["out_breadth", "in_retained"])
