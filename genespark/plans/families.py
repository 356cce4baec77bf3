"""Family, profile, screening and recovery queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from genespark.operators import families as FM
from genespark.operators import presence as P
from genespark.operators.ordered import interval_union
from genespark.plans.presence import CELLS, COUNTS, FLOORED, cells, judged, judged_sql
from genespark.plans.registry import query
from genespark.plans.views import Tables, ctes


@query("P6_family_size_band", ctes("fx_clusters") + """
    select family, count(*) as size, case when count(*) < 2 then 'small' when count(*) > 12 then 'oversized'
           else 'kept' end as band from fx_clusters group by 1""")
def family_size_band(t: Tables):
    return FM.size_band(t.clusters, 2, 12)


@query("P7_singletons", ctes("fx_clusters") + """
    select family, min(member) as member from fx_clusters group by 1 having count(*) = 1""")
def singletons(t: Tables):
    return FM.singletons(t.clusters)


CAND = """select source_proteome, protein_id from counts
    where n_in / (select count(*) from fx_samples where grp = 'IN') >= 0.2
      and n_out / (select count(*) from fx_samples where grp = 'OUT') <= 0.5"""


def cands(t: Tables):
    return P.candidates(cells(t), P.banded(t.samples), "IN", 0.2, 0.5).select("source_proteome", "protein_id")


def fam_base():
    return ctes("fx_samples", "fx_hits", "fx_paralogs", "fx_members", "fx_clusters", judged=judged_sql(),
                cells=CELLS.format(src="judged"), counts=COUNTS, cand=CAND)


@query("P8_candidate_families", fam_base() + """
    select distinct family from fx_clusters where member in (select protein_id from cand)""")
def candidate_families(t: Tables):
    return FM.candidate_families(t.clusters, cands(t))


@query("P10_query_extension", fam_base() + """
    select protein_id from cand union
    select paralog_id from fx_paralogs where protein_id in (select protein_id from cand)""")
def query_extension(t: Tables):
    return FM.extend_queries(cands(t), t.paralogs)


@query("A24_cluster_summary", ctes("fx_clusters") + """
    select family, block, size, string_agg(member, ',' order by member) as members
    from (select *, (row_number() over (partition by family order by member) - 1) // 10000 as block,
                 count(*) over (partition by family) as size from fx_clusters)
    group by 1, 2, 3""")
def cluster_summary(t: Tables):
    return FM.cluster_summary(t.clusters)


@query("A28_family_payload", ctes("fx_members", "fx_sources") + """
    , sp as (select distinct family, source_proteome as species from fx_members m join fx_sources s using (member))
    select f.family, f.size, coalesce(n, 0) as n_species, species
    from (select family, count(*) as size from fx_members group by 1) f
    left join (select family, count(*) as n, string_agg(species, ',' order by species) as species
               from sp group by 1) x on x.family = f.family""")
def family_payload(t: Tables):
    return FM.family_payload(t.members, t.sources.withColumnRenamed("source_proteome", "species"))


UNION_SQL = """
    , o as (select *, max({e}) over (partition by {k} order by {s}, {e}
                rows between unbounded preceding and 1 preceding) as reach from {src}),
    cov as (select {k}, cast(sum(greatest(0, {e} - greatest({s}, coalesce(reach + 1, {s})) + 1)) as bigint) as covered
            from o group by {k})"""
GATED = "select * from fx_domain_hits where i_evalue < 1e-5"
DOM = UNION_SQL.format(k="proteome, query, target", s="hmm_from", e="hmm_to", src="gated")
FAMPRES = """
    , heads as (select proteome, query, target, min(qlen) as qlen, min(full_evalue) as fe from gated group by all),
    fampres as (select h.query as family, h.proteome, min(fe) as best_evalue
        from heads h join cov c on c.proteome = h.proteome and c.query = h.query and c.target = h.target
        where fe < 1e-3 and (covered / qlen >= 0.3 or covered >= 100) group by 1, 2)"""


@query("W7_interval_union", ctes("fx_domain_hits", gated=GATED) + DOM + "select * from cov")
def interval_union_query(t: Tables):
    return interval_union(t.domain_hits.where(F.col("i_evalue") < 1e-5), ["proteome", "query", "target"],
                          "hmm_from", "hmm_to")


@query("A7_family_presence", ctes("fx_domain_hits", gated=GATED) + DOM + FAMPRES + "select * from fampres")
def family_presence(t: Tables):
    return FM.family_presence(t.domain_hits)


FAMCELLS = """
    , own as (select m.*, s.source_proteome from {members} m join fx_sources s using (member)),
    famcells as (select member as protein_id, source_proteome, proteome, best_evalue
        from own join fampres using (family) where proteome <> source_proteome
        union all select member, source_proteome, source_proteome, null from own)"""


@query("A8_family_member_cells", ctes("fx_domain_hits", "fx_members", "fx_sources", gated=GATED) + DOM + FAMPRES
       + FAMCELLS.format(members="fx_members") + """
    select protein_id, source_proteome, count(*) as n_present, min(best_evalue) as best from famcells group by 1, 2""")
def family_member_cells(t: Tables):
    return FM.family_cells(t.members, t.sources, FM.family_presence(t.domain_hits)).groupBy(
        "protein_id", "source_proteome").agg(F.count("*").alias("n_present"), F.min("best_evalue").alias("best"))


def singleton_presence(t: Tables):
    return judged(t).where(F.col("status") == "kept").groupBy(
        "query_id", F.col("target_proteome").alias("proteome")).agg(F.min("evalue").alias("best_evalue"))


DISC = """
    , clusters as (select member, concat('F', substr(family, 2)) as family from fx_clusters),
    alone as (select family from clusters group by 1 having count(*) = 1),
    own as (select m.*, s.source_proteome, a.family is not null as lone
            from clusters m join fx_sources s using (member) left join alone a using (family)),
    sing as (select query_id, target_proteome as proteome, min(evalue) as best_evalue from judged
             where status = 'kept' group by 1, 2),
    disc as (
        select member as protein_id, source_proteome, proteome, best_evalue from own join fampres using (family)
        where not lone and proteome <> source_proteome
        union all
        select member, source_proteome, proteome, best_evalue from own join sing on query_id = member
        where lone and proteome <> source_proteome
        union all select member, source_proteome, source_proteome, null from own)"""


def disc_base():
    return ctes("fx_samples", "fx_hits", "fx_paralogs", "fx_clusters", "fx_sources", "fx_domain_hits", "fx_roles",
                judged=judged_sql(), gated=GATED) + DOM + FAMPRES + DISC


def f_clusters(t: Tables):
    return t.clusters.withColumn("family", F.concat(F.lit("F"), F.substring("family", 2, 20)))


def discovery(t: Tables):
    return FM.discovery_cells(f_clusters(t), t.sources, FM.family_presence(t.domain_hits), singleton_presence(t))


@query("A9_discovery_cells", disc_base() + "select * from disc")
def discovery_cells(t: Tables):
    return discovery(t)


DCAND = """
    , dc as (select source_proteome, protein_id,
              count(*) filter (where grp = 'DISCOVERY_TARGET') as n_in,
              count(*) filter (where grp = 'DISCOVERY_OUT') as n_out
            from disc left join fx_roles on short = proteome group by 1, 2),
    dcand as (select * from dc where n_in / (select count(*) from fx_roles where grp = 'DISCOVERY_TARGET') >= 0.4
              and n_out / (select count(*) from fx_roles where grp = 'DISCOVERY_OUT') <= 0.8)"""


def discovery_candidates(t: Tables):
    bands = P.banded(t.roles, ("DISCOVERY_TARGET",), ("DISCOVERY_OUT",))
    return P.candidates(discovery(t), bands, "IN", 0.4, 0.8).select("source_proteome", "protein_id", "n_in", "n_out")


@query("A9_discovery_candidates", disc_base() + DCAND + "select * from dcand")
def discovery_candidates_query(t: Tables):
    return discovery_candidates(t)


@query("A10_screen_classes", disc_base() + DCAND + """
    , r as (select d.source_proteome, d.protein_id, coalesce(c.family, d.protein_id) as rep
            from dcand d left join clusters c on c.member = d.protein_id),
    near as (select distinct family from fampres join fx_roles on short = proteome
             where grp = 'NEAR_INGROUP' and best_evalue < 1e-8),
    broad as (select distinct family from fampres join fx_roles on short = proteome
              where grp = 'BROAD_OUTGROUP' and best_evalue < 1e-10)
    select source_proteome, protein_id, rep,
           case when b.family is not null then 'false_novelty' when n.family is not null then 'clade_specific'
                else 'target_specific' end as novelty_category
    from r left join near n on n.family = rep left join broad b on b.family = rep""")
def screen_classes(t: Tables):
    pres = FM.family_presence(t.domain_hits)
    role = lambda g, e: pres.where(F.col("best_evalue") < e).join(
        t.roles.where(F.col("grp") == g).select(F.col("short").alias("proteome")), "proteome", "left_semi")
    found = discovery_candidates(t).select("source_proteome", "protein_id")
    return FM.screen(found, f_clusters(t), role("NEAR_INGROUP", 1e-8), role("BROAD_OUTGROUP", 1e-10))


@query("A11_context_presence", fam_base() + FLOORED + """
    select query_id as protein_id, target_proteome as proteome, min(evalue) as best_evalue
    from floored where status = 'kept' and query_id in (select protein_id from cand) group by 1, 2""")
def context_presence(t: Tables):
    out = P.banded(t.samples).where(F.col("band") == "OUT")
    floored = P.coverage_floor(judged(t), out, 40)
    return P.context_presence(floored, cands(t))


@query("A13_genome_hit_coverage", ctes("fx_genome_hits", "fx_domain_hits", g="""
    select family as query, short as genome, qstart, qend, evalue from fx_genome_hits where evalue <= 1e-5""")
       + UNION_SQL.format(k="query, genome", s="qstart", e="qend", src="g") + """
    , h as (select query, genome, count(*) as n_hsps, min(evalue) as best_evalue, min(qstart) as span_start,
                   max(qend) as span_end from g group by 1, 2),
    l as (select query, max(qlen) as length from fx_domain_hits group by 1)
    select h.*, covered, length, round(least(1.0, covered / length), 6) as query_span_cov
    from h join cov using (query, genome) left join l using (query)""")
def genome_hit_coverage(t: Tables):
    lengths = t.domain_hits.groupBy("query").agg(F.max("qlen").alias("length"))
    hits = t.genome_hits.select(F.col("family").alias("query"), F.col("short").alias("genome"), "qstart", "qend",
                                "evalue")
    return FM.genome_hit_coverage(hits, lengths).withColumn("query_span_cov", F.round("query_span_cov", 6))


BREC = """
    , r as (select busco_id, count(*) as n_species, count(distinct family) as n_families,
                   count(*) filter (where family is null) as n_unmapped
            from fx_busco b left join fx_members m on m.member = b.protein_id group by 1)"""


@query("A29_busco_recovery", ctes("fx_busco", "fx_members") + BREC + """
    select *, case when n_families = 1 and n_unmapped = 0 then 'recovered' when n_families > 1 then 'split'
                   else 'partial' end as verdict from r where n_species >= 2""")
def busco_recovery(t: Tables):
    return FM.busco_recovery(t.busco, t.members)


@query("A29_overmerged_families", ctes("fx_busco", "fx_members") + BREC + """
    select family, count(distinct busco_id) as n_buscos from fx_busco b join fx_members m on m.member = b.protein_id
    where busco_id in (select busco_id from r where n_species >= 2) group by 1 having count(distinct busco_id) > 1""")
def overmerged(t: Tables):
    return FM.overmerged(t.busco, t.members)


# a family map that puts most copies of a BUSCO together, so that one-family BUSCOs exist
BF = """select protein_id as member, concat('F', case when cast(substr(busco_id, 2) as int) % 4 = 0
        then substr(protein_id, 2) else substr(busco_id, 2) end) as family from fx_busco
        where cast(substr(protein_id, 2) as int) % 9 <> 0"""
PAIRS = """
    , m as (select b.*, f.family from fx_busco b left join bf f on f.member = b.protein_id),
    one as (select busco_id, min(family) as family_rep from m group by 1
            having count(*) >= 2 and count(distinct family) = 1),
    mrow as (select protein_id from fx_busco where cast(substr(protein_id, 2) as int) % 7 <> 0),
    reps as (select distinct family from bf where member in (select protein_id from mrow)),
    pairs as (
        select m.busco_id, m.species, family_rep, l.length,
               case when l.length is null then 'unknown' when l.length < 150 then '<150aa'
                    when l.length < 300 then '150-300aa' when l.length < 600 then '300-600aa' else '>600aa' end
                 as length_bucket,
               case when family_rep not in (select family from reps) then 'no_row'
                    when exists (select 1 from fampres p where p.family = family_rep and p.proteome = m.species)
                    then 'present' else 'absent' end as verdict
        from m join one using (busco_id) left join fx_busco_lengths l using (busco_id)
        where not (m.family is not null and m.protein_id in (select protein_id from mrow)))"""


def pairs_base():
    return ctes("fx_busco", "fx_busco_lengths", "fx_domain_hits", gated=GATED) + DOM + FAMPRES + f", bf as ({BF})" + PAIRS


def busco_pairs(t: Tables):
    b = t.busco
    num = F.substring("protein_id", 2, 20)
    fam = F.concat(F.lit("F"), F.when(F.substring("busco_id", 2, 9).cast("int") % 4 == 0, num).otherwise(
        F.substring("busco_id", 2, 9)))
    bf = b.where(num.cast("int") % 9 != 0).select(F.col("protein_id").alias("member"), fam.alias("family"))
    rows = b.where(num.cast("int") % 7 != 0).select("protein_id")
    return FM.busco_presence(b, t.busco_lengths, bf, FM.family_presence(t.domain_hits), rows)


@query("A30_busco_presence", pairs_base() + "select * from pairs")
def busco_presence(t: Tables):
    return busco_pairs(t)


@query("A30_bucket_rates", pairs_base() + """
    select length_bucket, count(*) as n, round(count(*) filter (where verdict = 'present') / count(*), 6)
      as recovery_rate from pairs where verdict <> 'no_row' group by 1""")
def bucket_rates(t: Tables):
    return FM.bucket_rates(busco_pairs(t)).withColumn("recovery_rate", F.round("recovery_rate", 6))


@query("A31_length_summary", ctes("fx_domain_hits") + """
    , q as (select proteome, query, min(qlen) + 40 as length from fx_domain_hits group by 1, 2),
    s as (select proteome, list_sort(list(length)) as l, count(*) as n,
                 count(*) filter (where length > 600) as gt, count(*) filter (where length < 150) as lt
          from q group by 1)
    select proteome, n, l[n // 4 + 1] as p25, l[n // 2 + 1] as median, l[3 * n // 4 + 1] as p75,
           round(gt / n, 3) as frac_gt600, round(lt / n, 3) as frac_lt150 from s""")
def length_summary(t: Tables):
    lens = t.domain_hits.groupBy("proteome", "query").agg((F.min("qlen") + 40).alias("length"))
    return FM.length_summary(lens, ["proteome"])


RESOLVED = """
    , best as (select target as anchor, arg_min(query, {'e': full_evalue, 'q': query}) as hit
               from fx_domain_hits group by 1),
    bp as (select busco_id as anchor, min(protein_id) as bp from fx_busco group by 1),
    res as (select c.*, case c.anchor_type when 'protein_id' then m1.family when 'busco' then m2.family
                        else best.hit end as resolved_family, bp.bp
        from fx_controls c left join fx_members m1 on m1.member = c.anchor
        left join bp on bp.anchor = c.anchor left join fx_members m2 on m2.member = bp.bp
        left join best on best.anchor = c.anchor)"""


@query("A49_control_anchors", ctes("fx_controls", "fx_members", "fx_busco", "fx_domain_hits") + RESOLVED + """
    select control_id, class, anchor_type, anchor, resolved_family,
           case when resolved_family is not null then ''
                when anchor_type = 'protein_id' then 'protein not in any profiled family'
                when anchor_type = 'busco' and bp is null then 'no BUSCO map entry'
                when anchor_type = 'busco' then 'busco protein not in any profiled family'
                else 'no family profile hit' end as note from res""")
def control_anchors(t: Tables):
    return FM.resolve_controls(t.controls, t.members, t.busco, t.domain_hits)


SCORED = """
    , fc as (select family, count(*) filter (where grp = 'IN') as i, count(*) filter (where grp = 'OUT') as o
             from fampres left join fx_samples on short = proteome group by 1),
    sc as (select res.* exclude (bp), case when fc.family is null then 'unresolved'
             when i / (select count(*) from fx_samples where grp = 'IN') >= 0.95
              and o / (select count(*) from fx_samples where grp = 'OUT') <= 0.9 then 'novel'
             else 'not_novel' end as actual_call
           from res left join fc on fc.family = resolved_family),
    scored as (select *, case when actual_call = 'unresolved' then 'unresolved'
             when class = 'positive' then case when actual_call = 'novel' then 'hit' else 'miss' end
             else case when actual_call = 'novel' then 'fp' else 'tn' end end as outcome from sc)"""


def scored_controls(t: Tables):
    res = FM.resolve_controls(t.controls, t.members, t.busco, t.domain_hits)
    return FM.score_controls(res, FM.family_presence(t.domain_hits), P.banded(t.samples), 0.95, 0.9)


def scored_base():
    return ctes("fx_controls", "fx_members", "fx_busco", "fx_samples", "fx_domain_hits", gated=GATED) + DOM + FAMPRES \
        + RESOLVED + SCORED


@query("A32_control_scores", scored_base() + """
    select control_id, class, anchor_type, anchor, resolved_family, actual_call, outcome from scored""")
def control_scores(t: Tables):
    return scored_controls(t).drop("note")


@query("A32_control_summary", scored_base() + """
    , k as (select count(*) as n_controls, count(*) filter (where class = 'positive') as n_positive,
        count(*) filter (where class = 'positive' and outcome <> 'unresolved') as n_positive_resolved,
        count(*) filter (where outcome = 'hit') as positive_hits,
        count(*) filter (where class = 'negative') as n_negative,
        count(*) filter (where class = 'negative' and outcome <> 'unresolved') as n_negative_resolved,
        count(*) filter (where outcome = 'fp') as negative_fp,
        count(*) filter (where outcome = 'unresolved') as n_unresolved from scored)
    select *, round(positive_hits / n_positive_resolved, 6) as recall, round(positive_hits / n_positive, 6) as recall_all,
        round(negative_fp / n_negative_resolved, 6) as fp_rate from k""")
def control_summary(t: Tables):
    out = FM.control_summary(scored_controls(t))
    for c in ("recall", "recall_all", "fp_rate"):
        out = out.withColumn(c, F.round(c, 6))
    return out


@query("A34_ambiguous_families", ctes("fx_members", "fx_sources", "fx_samples", "fx_domain_hits", gated=GATED) + DOM
       + FAMPRES + """
    , fc as (select family, count(*) filter (where grp = 'IN') as n_in, count(*) filter (where grp = 'OUT') as n_out
             from fampres join fx_samples on short = proteome group by 1),
    d as (select family from fx_members join fx_sources using (member) group by 1
          having count(*) > count(distinct source_proteome)),
    z as (select family, count(*) as size from fx_members group by 1 having count(*) <= 100)
    select family, n_in, n_out, size from fc join d using (family) join z using (family)
    where n_in / (select count(*) from fx_samples where grp = 'IN') >= 0.75 and n_out > 0""")
def ambiguous_families(t: Tables):
    return FM.ambiguous_families(t.members, t.sources, FM.family_presence(t.domain_hits), P.banded(t.samples))


@query("A36_negative_control_thresholds", ctes("fx_clusters", "fx_domain_hits", "fx_roles") + """
    , b as (select query as family, min(full_evalue) as e from fx_domain_hits join fx_roles on short = proteome
            where grp = 'DISCOVERY_OUT' group by 1)
    select f.family, coalesce(e, 1e-3) as threshold_evalue,
           case when e is null then 'global_default' else 'negative_control' end as calibration_source
    from (select distinct concat('F', substr(family, 2)) as family from fx_clusters) f left join b using (family)""")
def negative_control_thresholds(t: Tables):
    neg = t.domain_hits.join(
        t.roles.where(F.col("grp") == "DISCOVERY_OUT").select(F.col("short").alias("proteome")), "proteome", "left_semi")
    return FM.negative_control_thresholds(f_clusters(t).select("family").distinct(), neg)


SWEEP = """
    , sw as (select *, case when n_novelties is null or recall is null then 1 else 0 end as unscored from fx_sweep),
    sc as (select *, case when unscored = 1 then 0 when run_ok >= 1 and busco_recovery >= 0.5 and fp_rate <= 0.1
                     then 1 else 0 end as admissible,
             case when unscored = 0 then round(busco_recovery + recall - fp_rate, 6) end as composite from sw)"""


def sweep(t: Tables):
    cast = t.sweep
    for c in ("min_seq_id", "cov", "hmm_evalue", "hmm_cov", "busco_recovery", "recall", "fp_rate"):
        cast = cast.withColumn(c, F.col(c).cast("double"))
    return FM.score_sweep(cast, 0.5, 0.8, 0.1)


SWEEP_COLS = ["hmm_residues", "n_novelties", "run_ok", "unscored", "admissible", "composite"]


@query("A33_sweep_scores", ctes("fx_sweep") + SWEEP + """
    select hmm_residues, n_novelties, run_ok, unscored, admissible, composite::double as composite from sc""")
def sweep_scores(t: Tables):
    return sweep(t).select(*SWEEP_COLS)


@query("F5_sweep_knee", ctes("fx_sweep") + SWEEP + """
    , pool as (select * from sc where case when (select max(admissible) from sc) = 1 then admissible = 1
               else run_ok >= 1 and unscored = 0 end)
    select hmm_residues, n_novelties, run_ok, unscored, admissible, composite::double as composite from pool
    where composite >= (select max(composite) from pool) - 0.1
    order by n_novelties, case when abs(min_seq_id - 0.3) < 1e-9 and hmm_residues = 100 then 0 else 1 end,
             composite desc, recall desc, min_seq_id, hmm_residues limit 1""")
def sweep_knee(t: Tables):
    return FM.knee(sweep(t), 0.1).select(*SWEEP_COLS)
