"""Pairwise presence, evidence and gain / loss queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from genespark.operators import presence as P
from genespark.plans.registry import query
from genespark.plans.views import Tables, ctes

MIN_FRAC = 0.2
OTHER_MAX = 0.5

JUDGED = """
    select h.*, p.paralog_id, b.best_evalue as paralog_evalue,
           case when b.best_evalue < h.evalue and not ({rescue}) then 'paralog_filtered' else 'kept' end as status
    from fx_hits h
    join fx_samples s on s.short = h.query_proteome and s.grp = '{group}'
    left join fx_paralogs p on p.protein_id = h.query_id
    left join (select query_proteome, query_id, {key} as k, min(evalue) as best_evalue
               from fx_hits group by 1, 2, 3) b
      on b.query_proteome = h.query_proteome and b.query_id = p.paralog_id and b.k = h.{key}
    where h.evalue < {evalue}"""
CELLS = """
    select query_proteome as source_proteome, query_id as protein_id, target_proteome as proteome,
           min(evalue) as best_evalue, arg_min(target_id, {{'e': evalue, 't': target_id}}) as best_target
    from {src} where status = 'kept' group by 1, 2, 3
    union all
    select distinct query_proteome, query_id, query_proteome, cast(null as double), cast(null as varchar)
    from {src} where status = 'kept'"""
COUNTS = """
    select c.source_proteome, c.protein_id,
           cast(count(*) filter (where s.grp = 'IN') as bigint) as n_in,
           cast(count(*) filter (where s.grp = 'OUT') as bigint) as n_out
    from cells c left join fx_samples s on s.short = c.proteome group by 1, 2"""


def judged_sql(group="IN", key="target_id", rescue="h.evalue <= 1e-20", evalue="1e-5"):
    return JUDGED.format(group=group, key=key, rescue=rescue, evalue=evalue)


def base(**kw):
    src = kw.pop("src", "judged")
    return ctes("fx_samples", "fx_hits", "fx_paralogs", judged=judged_sql(**kw), cells=CELLS.format(src=src),
                counts=COUNTS)


def judged(t: Tables, group="IN", **kw):
    mine = P.banded(t.samples).where(F.col("band") == group)
    return P.compete(t.hits, t.paralogs, mine, **kw)


def cells(t: Tables, group="IN", **kw):
    return P.presence_cells(judged(t, group, **kw))


def others(t: Tables, band="OUT"):
    return P.banded(t.samples).where(F.col("band") == band)


@query("pairwise_candidates", base() + """
    select concat(source_proteome, '::', protein_id) as candidate from counts
    where n_in / (select count(*) from fx_samples where grp = 'IN') >= 0.2
      and n_out / (select count(*) from fx_samples where grp = 'OUT') <= 0.5""")
def pairwise_candidates(t: Tables):
    return P.candidate_ids(P.candidates(cells(t), P.banded(t.samples), "IN", MIN_FRAC, OTHER_MAX))


@query("P1_filter_hits", ctes("fx_hits") + """
    select query_proteome, target_proteome, count(*) as n_hits, cast(sum(bitscore) as double) as bits
    from fx_hits where evalue <= 1e-8 and bitscore >= 10 group by 1, 2""")
def filter_hits(t: Tables):
    return P.filter_hits(t.hits, 1e-8, 10).groupBy("query_proteome", "target_proteome").agg(
        F.count("*").alias("n_hits"), F.sum("bitscore").alias("bits"))


@query("P2_significant_hits", ctes("fx_hits") + """
    select query_proteome, count(*) as n_hits, min(evalue) as best from fx_hits where evalue < 1e-5 group by 1""")
def significant_hits(t: Tables):
    return P.significant(t.hits).groupBy("query_proteome").agg(
        F.count("*").alias("n_hits"), F.min("evalue").alias("best"))


@query("P3_role_bands", ctes("fx_samples") + """
    select short as proteome, grp as band from fx_samples where grp in ('IN', 'OUT')""")
def role_bands(t: Tables):
    return P.banded(t.samples)


@query("P4_candidate_fractions", base() + """
    , f as (select *, n_in / (select count(*) from fx_samples where grp = 'IN') as i,
                   n_out / (select count(*) from fx_samples where grp = 'OUT') as o from counts)
    select source_proteome, protein_id, n_in, n_out, round(i, 6) as in_frac, round(o, 6) as out_frac
    from f where i >= 0.2 and o <= 0.5""")
def candidate_fractions(t: Tables):
    out = P.candidates(cells(t), P.banded(t.samples), "IN", MIN_FRAC, OTHER_MAX)
    return out.withColumn("in_frac", F.round("in_frac", 6)).withColumn("out_frac", F.round("out_frac", 6))


STRICT = {"evalue": 1e-50}


@query("P5_strict_candidates", base(evalue="1e-50") + """
    select source_proteome, protein_id, n_in from counts
    where n_in / (select count(*) from fx_samples where grp = 'IN') >= 0.05 and n_out = 0""")
def strict_candidates(t: Tables):
    return P.strict_candidates(cells(t, **STRICT), t.samples, 0.05).select("source_proteome", "protein_id", "n_in")


STATUS_SUMMARY = """
    select query_proteome, status, count(*) as n_hits, count(distinct query_id) as n_queries
    from judged group by 1, 2"""


def status_summary(df):
    return df.groupBy("query_proteome", "status").agg(
        F.count("*").alias("n_hits"), F.countDistinct("query_id").alias("n_queries"))


@query("J1_paralog_competition_target", base() + STATUS_SUMMARY)
def competition_target(t: Tables):
    return status_summary(judged(t))


@query("J1_paralog_competition_proteome", base(key="target_proteome") + STATUS_SUMMARY)
def competition_proteome(t: Tables):
    return status_summary(judged(t, scope="proteome"))


@query("J1_paralog_rescue_delta", base(
    rescue="case when b.best_evalue <= 0 then false when h.evalue <= 0 then true "
           "else log10(h.evalue) - log10(b.best_evalue) < 3.5 end") + STATUS_SUMMARY)
def competition_delta(t: Tables):
    return status_summary(judged(t, rescue_evalue=None, rescue_delta=3.5))


@query("J1_singleton_scores", base() + """
    select target_proteome as proteome, query_id, min(evalue) as best_evalue from judged
    where status = 'kept' and cast(substr(query_id, 2) as bigint) % 4 = 1 group by 1, 2""")
def singleton_scores(t: Tables):
    scored = judged(t).where(F.col("status") == "kept")
    singles = t.part.where(F.col("p_partkey") % 4 == 1).select(F.concat(F.lit("P"), "p_partkey").alias("query_id"))
    return scored.join(singles, "query_id", "left_semi").groupBy(
        F.col("target_proteome").alias("proteome"), "query_id").agg(F.min("evalue").alias("best_evalue"))


@query("A1_presence_cells", base() + "select source_proteome, protein_id, proteome from cells")
def presence_cells(t: Tables):
    return cells(t).select("source_proteome", "protein_id", "proteome")


@query("A2_best_hit_per_cell", base() + "select * from cells where best_evalue is not null")
def best_hit_cells(t: Tables):
    return cells(t).where(F.col("best_evalue").isNotNull())


EVIDENCE = """
    select query_id as protein_id, query_proteome as source_proteome, target_proteome as other_proteome,
           max(qcov) as max_qcov, count(*) as n_hits, max(paralog_id) as paralog_id,
           max(case when status = 'kept' then 1 else 0 end) as any_kept,
           arg_min({'t': target_id, 'q': qcov, 's': status, 'p': paralog_evalue, 'b': bitscore},
                   {'e': evalue, 't': target_id, 'b': -bitscore, 'q': qcov}) as b, min(evalue) as best_evalue
    from %s j join fx_samples s on s.short = j.target_proteome and s.grp = 'OUT' group by 1, 2, 3"""
EVIDENCE_ROWS = """
    select protein_id, source_proteome, other_proteome, b.t as best_target_id, best_evalue,
           b.b as best_bitscore, b.q as best_qcov, max_qcov, n_hits,
           case when any_kept = 1 then 'kept' else b.s end as status, paralog_id, b.p as paralog_evalue,
           round(case when b.p is null then null when b.p <= 0 then 'inf'::double
                when best_evalue <= 0 then '-inf'::double else log10(best_evalue) - log10(b.p) end, 6) as paralog_delta
    from ev"""


@query("A3_other_group_evidence", base() + ", ev as (" + EVIDENCE % "judged" + ")" + EVIDENCE_ROWS)
def other_group_evidence(t: Tables):
    return P.other_evidence(judged(t), others(t)).withColumn("paralog_delta", F.round("paralog_delta", 6))


FLOORED = """, floored as (
    select j.* exclude (status), case when s.grp = 'OUT' and j.status = 'kept' and j.qcov < 40
           then 'coverage_floor' else j.status end as status
    from judged j left join fx_samples s on s.short = j.target_proteome)"""


def floored(t: Tables):
    return P.coverage_floor(judged(t), others(t), 40)


@query("A4_coverage_floor", ctes("fx_samples", "fx_hits", "fx_paralogs", judged=judged_sql()) + FLOORED + """
    select query_proteome, query_id, target_proteome, target_id, evalue, bitscore, qcov
    from floored where status = 'coverage_floor'""")
def coverage_floor(t: Tables):
    return floored(t).where(F.col("status") == "coverage_floor").select(
        "query_proteome", "query_id", "target_proteome", "target_id", "evalue", "bitscore", "qcov")


@query("U3_flipped_cells", ctes("fx_samples", "fx_hits", "fx_paralogs", judged=judged_sql()) + FLOORED + """
    select distinct query_proteome, query_id, target_proteome from judged j
    join fx_samples s on s.short = j.target_proteome and s.grp = 'OUT' where status = 'kept'
    except
    select query_proteome, query_id, target_proteome from floored where status = 'kept'""")
def flipped(t: Tables):
    return P.flipped_cells(floored(t), others(t))


@query("A5_low_coverage_report", ctes("fx_samples", "fx_hits", "fx_paralogs", judged=judged_sql()) + FLOORED + """
    , best as (select query_proteome, query_id, target_proteome, max(qcov) as q from floored f
               join fx_samples s on s.short = f.target_proteome and s.grp = 'IN'
               where status = 'kept' and target_proteome <> query_proteome group by 1, 2, 3),
    c as (select query_proteome, query_id, count(*) as n, count(*) filter (where q < 40) as low,
                 string_agg(case when q < 40 then target_proteome end, ',' order by target_proteome) as names
          from best group by 1, 2)
    select e.query_id as protein_id, e.query_proteome as source_proteome, 40.0::double as qcov_threshold,
           coalesce(n, 0) as query_hit_cells, coalesce(low, 0) as query_lowcov_cells,
           coalesce(names, '') as query_lowcov_proteomes
    from (select distinct query_proteome, query_id from floored where status = 'kept') e
    left join c on c.query_proteome = e.query_proteome and c.query_id = e.query_id""")
def low_coverage(t: Tables):
    mine = P.banded(t.samples).where(F.col("band") == "IN")
    return P.low_coverage_report(floored(t), mine, 40)


@query("A6_candidate_signal", base() + ", ev as (" + EVIDENCE % "judged" + """), er as (%s),
    cand as (select source_proteome, protein_id from counts
             where n_in / (select count(*) from fx_samples where grp = 'IN') >= 0.2
               and n_out / (select count(*) from fx_samples where grp = 'OUT') <= 0.5),
    p as (select protein_id, cast(max(max_qcov) as double) as q,
                 count(*) filter (where status <> 'kept') as nf,
                 min(case when status <> 'kept' then paralog_evalue end) as mp from er group by 1)
    select c.source_proteome, c.protein_id, p.q as other_protein_max_qcov,
           coalesce(p.nf, 0) as other_protein_n_filtered, p.mp as other_protein_min_paralog_evalue,
           case when p.protein_id is null then 'none' when p.q is null then ''
                when p.q >= 50 then 'broad' else 'domain_only' end as other_signal_class
    from cand c left join p on p.protein_id = c.protein_id""" % EVIDENCE_ROWS)
def signal(t: Tables):
    j = judged(t)
    cands = P.candidates(P.presence_cells(j), P.banded(t.samples), "IN", MIN_FRAC, OTHER_MAX)
    out = P.candidate_signal(cands, P.other_evidence(j, others(t)), None)
    return out.drop("other_tblastn_max_cov", "other_tblastn_n_genomes")


@query("A25_near_universal", base() + """
    select source_proteome, protein_id, n_in, n_out,
           round((n_in + n_out) / (select count(*) from fx_samples where grp in ('IN', 'OUT')), 6) as frac
    from counts where (n_in + n_out) / (select count(*) from fx_samples where grp in ('IN', 'OUT')) >= 0.4""")
def near_universal(t: Tables):
    return P.near_universal(cells(t), P.banded(t.samples), 0.4).withColumn("frac", F.round("frac", 6))


FAMILIES = """select concat('P', p_partkey) as member, concat('F', p_partkey % 200) as family from part
              where p_partkey % 7 <> 0"""


def part_families(t: Tables):
    return t.part.where(F.col("p_partkey") % 7 != 0).select(
        F.concat(F.lit("P"), "p_partkey").alias("member"),
        F.concat(F.lit("F"), F.col("p_partkey") % 200).alias("family"))


@query("A26_losses", ctes("fx_samples", "fx_hits", "fx_paralogs", judged=judged_sql("OUT"),
                          cells=CELLS.format(src="judged"), counts=COUNTS, fams=FAMILIES) + """
    , kept as (select c.*, coalesce(f.family, concat('own::', source_proteome, '::', protein_id)) as unit, f.family
             from counts c left join fams f on f.member = c.protein_id
             where n_out / (select count(*) from fx_samples where grp = 'OUT') >= 0.2
               and n_in / (select count(*) from fx_samples where grp = 'IN') <= 0.5),
    w as (select k.unit, count(distinct case when s.grp = 'OUT' then s.species end) as out_breadth,
                 count(distinct case when s.grp = 'IN' then s.species end) as in_retained
          from kept k join cells c on c.source_proteome = k.source_proteome and c.protein_id = k.protein_id
          join fx_samples s on s.short = c.proteome group by 1)
    select k.source_proteome, k.protein_id, k.n_in, k.n_out, k.family, w.out_breadth, w.in_retained
    from kept k join w on w.unit = k.unit""")
def losses(t: Tables):
    out = P.losses(cells(t, "OUT"), P.banded(t.samples), part_families(t), t.samples, 0.2, 0.5)
    return out.drop("in_frac", "out_frac")


@query("A27_novelties_from_matrix", base() + """
    select source_proteome, count(*) as n_novel from counts
    where n_in / (select count(*) from fx_samples where grp = 'IN') >= 0.2
      and n_out / (select count(*) from fx_samples where grp = 'OUT') <= 0.2 group by 1""")
def novelties(t: Tables):
    return P.candidates(cells(t), P.banded(t.samples), "IN", 0.2, 0.2).groupBy("source_proteome").agg(
        F.count("*").alias("n_novel"))


@query("A12_species_novelties", base(evalue="1e-50") + """
    , fams as (%s), sizes as (select family, count(*) as n from fams group by 1)
    select c.protein_id, c.source_proteome, s.species, c.n_in, f.family, coalesce(z.n, 1) as family_size, 0 as block,
           (select string_agg(m.member, ',' order by m.member) from fams m
            where m.family = f.family and m.member <> c.protein_id) as other_members
    from counts c join fx_samples s on s.short = c.source_proteome
    left join fams f on f.member = c.protein_id left join sizes z on z.family = f.family
    where s.grp = 'IN' and c.n_out = 0
      and c.n_in / (select count(*) from fx_samples where grp = 'IN') >= 0.05""" % FAMILIES)
def species_novelties(t: Tables):
    from genespark.operators.families import species_novelties as op
    found = P.strict_candidates(cells(t, **STRICT), t.samples, 0.05)
    return op(found, t.samples, part_families(t)).select(
        "protein_id", "source_proteome", "species", "n_in", "family", "family_size", F.col("block").cast("int").alias("block"), "other_members")


@query("K1_wide_matrix", base() + "select protein_id, source_proteome, " + ", ".join(
    f"cast(max(case when proteome = 'N{i}' then 1 else 0 end) as int) as N{i}" for i in range(25))
    + " from cells group by 1, 2")
def wide_matrix(t: Tables):
    return P.to_wide(cells(t), [f"N{i}" for i in range(25)])


@query("K1_wide_evalues", base() + "select protein_id, source_proteome, " + ", ".join(
    f"max(case when proteome = 'N{i}' then best_evalue end) as N{i}" for i in range(25))
    + " from cells group by 1, 2")
def wide_evalues(t: Tables):
    return P.to_wide(cells(t), [f"N{i}" for i in range(25)], "best_evalue")


@query("K6_evidence_sidecar", base() + """
    select source_proteome, protein_id, proteome, best_evalue from cells where best_evalue is not null""")
def evidence_sidecar(t: Tables):
    from genespark.plans.more import scratch
    from genespark.sources.sinks import write_evidence
    path = scratch(t, "evidence")
    write_evidence(cells(t).select("source_proteome", "protein_id", "proteome", "best_evalue"), path)
    return t.spark.read.parquet(path)
