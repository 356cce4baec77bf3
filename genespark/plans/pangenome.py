"""Pangenome matrix, bins, quality and rank queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from genespark.operators import pangenome as G
from genespark.plans.registry import query
from genespark.plans.views import Tables, ctes


def matrix(t: Tables):
    return t.presence.withColumn("state", F.lit("present"))


def families(t: Tables):
    return t.genes.select("family").distinct()


def genes(t: Tables):
    return t.genes.select("short", "protein_id", "family", "contig", F.col("g_start").alias("start"),
                          (F.col("g_start") + F.col("g_len")).alias("end"))


def freq(t: Tables):
    return G.frequency_table(matrix(t), families(t), t.strains)


FREQ = """
    fams as (select distinct family from fx_genes),
    nn as (select count(*) filter (where grp = 'IN' and is_rep = 1) as n_in,
                  count(*) filter (where grp = 'OUT' and is_rep = 1) as n_out from fx_strains),
    cc as (select family, count(*) filter (where grp = 'IN' and is_rep = 1) as c_in,
              count(*) filter (where grp = 'OUT' and is_rep = 1) as c_out,
              count(*) filter (where grp = 'IN' and is_rep = 0) as x_in,
              count(*) filter (where grp = 'OUT' and is_rep = 0) as x_out
           from fx_presence join fx_strains using (short) group by 1),
    c0 as (select family, coalesce(c_in, 0) as c_in, coalesce(c_out, 0) as c_out, coalesce(x_in, 0) as x_in,
                  coalesce(x_out, 0) as x_out, n_in, n_out from fams left join cc using (family), nn),
    freq as (select family, c_in / n_in as frequency, c_in as strain_count,
        case when c_in >= 1 then case when c_in <= 1 then 'singleton' when c_in / n_in >= 0.95 then 'core'
               when c_in / n_in >= 0.9 then 'soft_core' when c_in / n_in >= 0.15 then 'shell' else 'cloud' end
             when x_in > 0 then 'nonrep_only' when c_out + x_out > 0 then 'outgroup_only' else 'absent' end as bin,
        case when n_out >= 3 then c_out / n_out end as frequency_out,
        case when n_out >= 3 then c_out end as strain_count_out,
        case when n_out < 3 then '-' when c_out >= 1 then case when c_out <= 1 then 'singleton'
               when c_out / n_out >= 0.95 then 'core' when c_out / n_out >= 0.9 then 'soft_core'
               when c_out / n_out >= 0.15 then 'shell' else 'cloud' end
             when x_out > 0 then 'nonrep_only' when c_in + x_in > 0 then 'ingroup_only' else 'absent' end as bin_out
      from c0)"""


def freq_base(*more: str) -> str:
    return ctes("fx_genes", "fx_strains", "fx_presence", *more) + ", " + FREQ


@query("A14_copy_matrix", ctes("fx_genes", "fx_strains") + """
    select family, short, count(*) as copies, 'present' as state from fx_genes
    where short in (select short from fx_strains) group by 1, 2""")
def copy_matrix(t: Tables):
    members = t.genes.select("family", F.concat_ws("|", "short", "protein_id").alias("member"))
    return G.copy_matrix(members, t.strains)


@query("A14_unknown_prefixes", ctes("fx_genes", "fx_strains") + """
    select short, count(*) as n_unknown from fx_genes
    where short not in (select short from fx_strains where is_rep = 1) group by 1""")
def unknown_prefixes(t: Tables):
    members = t.genes.select("family", F.concat_ws("|", "short", "protein_id").alias("member"))
    return G.unknown_members(members, t.strains.where(F.col("is_rep") == 1))


@query("A17_frequency_bins", freq_base() + """
    select family, round(frequency, 6) as frequency, strain_count, bin, round(frequency_out, 6) as frequency_out,
           strain_count_out, bin_out from freq""")
def frequency_bins(t: Tables):
    return freq(t).withColumn("frequency", F.round("frequency", 6)).withColumn(
        "frequency_out", F.round("frequency_out", 6))


@query("A18_class_overlap", freq_base() + """
    , l as (select unnest(['core', 'soft_core', 'shell', 'cloud', 'singleton', 'nonrep_only', 'absent']) as c)
    select a.c as in_class, b.c as out_class, count(f.family) as n_families
    from l a cross join l b left join freq f on f.bin_out <> '-'
      and a.c = case when bin in ('outgroup_only', 'ingroup_only') then 'absent' else bin end
      and b.c = case when bin_out in ('outgroup_only', 'ingroup_only') then 'absent' else bin_out end
    group by 1, 2""")
def class_overlap(t: Tables):
    return G.class_overlap(freq(t))


KINDS = G.COUNTED
PER_STRAIN = """
    , lab as (select p.short, case when s.grp = 'OUT' and (select count(*) from freq where bin_out <> '-') > 0
                then bin_out else bin end as k
              from fx_presence p join fx_strains s using (short) left join freq using (family)),
    ps as (select s.short, s.grp, s.is_rep, count(l.short) as n_families, """ + ", ".join(
    f"count(*) filter (where k = '{k}') as {k}" for k in KINDS) + """
           from fx_strains s left join lab l using (short) group by 1, 2, 3)"""


@query("A19_strain_classes", freq_base() + PER_STRAIN + "select * from ps")
def strain_classes(t: Tables):
    return G.strain_classes(matrix(t), freq(t), t.strains)


@query("W11_outlier_flags", freq_base() + PER_STRAIN + """
    , v as (select *, cloud + shell as x from ps),
    med as (select grp, median(x) as m, count(*) as n from v where is_rep = 1 group by 1),
    mad as (select grp, median(abs(x - m)) as d from v join med using (grp) where is_rep = 1 group by 1),
    z as (select short, v.grp, x, case when n >= 3 and d > 0 then 0.6745 * (x - m) / d end as z
          from v left join med using (grp) left join mad using (grp))
    select short, grp, x, round(z, 6)::double as x_z,
           case when z is null then '-' when abs(z) > 1.5 then 'Y' else 'N' end as is_outlier from z""")
def outlier_flags(t: Tables):
    rows = G.strain_classes(matrix(t), freq(t), t.strains).select(
        "short", "grp", "is_rep", (F.col("cloud") + F.col("shell")).alias("x"))
    return G.outlier_flags(rows, "x", threshold=1.5).withColumn("x_z", F.round("x_z", 6)).drop("is_rep")


CONTIGS = "select short, contig, max(g_start + g_len) as length from fx_genes group by 1, 2"
STATS = """
    , tot as (select short, count(*) as n_contigs, cast(sum(length) as bigint) as total_length from ctg group by 1),
    run as (select c.short, length, sum(length) over (partition by c.short order by length desc, contig) as upto
            from ctg c),
    st as (select tot.*, n50 from tot join (select r.short, max(length) as n50 from run r join tot using (short)
           where upto * 2 >= total_length group by 1) using (short))"""
CONTENT = """
    , con as (select s.short, count(p.family) as n_families_present,
                count(*) filter (where f.bin <> 'core') as accessory_present,
                (select count(*) from freq where bin = 'core') - count(*) filter (where f.bin = 'core') as core_missing
              from fx_strains s left join fx_presence p using (short) left join freq f using (family) group by 1)"""


def contigs(t: Tables):
    return genes(t).groupBy("short", "contig").agg(F.max("end").alias("length"))


@query("W6_assembly_stats", ctes("fx_genes", ctg=CONTIGS) + STATS + "select * from st")
def assembly_stats(t: Tables):
    return G.assembly_stats(contigs(t))


@query("A21_strain_content", freq_base() + CONTENT + "select * from con")
def strain_content(t: Tables):
    return G.strain_content(matrix(t), freq(t), t.strains)


@query("A22_terminus_enrichment", freq_base() + f", ctg as ({CONTIGS})" + """
    , one as (select family, min(short) as short from fx_presence join freq using (family)
              where bin in ('singleton', 'cloud') group by 1 having count(*) <= 20),
    g as (select e.short, g_start <= 40000 or length - (g_start + g_len) <= 40000 as e,
                 o.short is not null as p
          from fx_genes e join ctg using (short, contig)
          left join one o on o.family = e.family and o.short = e.short)
    select short, count(p) as n_all_proteins, count(*) filter (where e) as n_all_at_terminus,
           count(*) filter (where p) as n_private_proteins, count(*) filter (where p and e) as n_private_at_terminus,
           round(100 * count(*) filter (where p and e) / nullif(count(*) filter (where p), 0), 2)
             as pct_private_at_terminus,
           round(100 * count(*) filter (where e) / nullif(count(p), 0), 2) as pct_all_at_terminus
    from fx_strains left join g using (short) group by 1""".replace("having count(*) <= 20", "").replace(
        "select family, min(short) as short from fx_presence join freq using (family)\n"
        "              where bin in ('singleton', 'cloud') group by 1",
        "select family, min(short) as short from fx_presence join freq using (family)\n"
        "              where short in (select short from fx_strains where is_rep = 0) and bin = 'shell'\n"
        "              group by 1 having count(*) = 1"))
def terminus_enrichment(t: Tables):
    # private here: shell families carried by exactly one non-representative strain
    pool = G.representatives(matrix(t), t.strains.withColumn("is_rep", 1 - F.col("is_rep")))
    rare = freq(t).withColumn("bin", F.when(F.col("bin") == "shell", "singleton").otherwise("core"))
    return G.terminus_enrichment(genes(t), contigs(t), pool, rare, t.strains, 40_000)


CORR = """
    , r as (select *, rank() over (order by {x}) + (count(*) over (partition by {x}) - 1) / 2 as rx,
              rank() over (order by {y}) + (count(*) over (partition by {y}) - 1) / 2 as ry,
              rank() over (order by total_length) + (count(*) over (partition by total_length) - 1) / 2 as rz
            from con join st using (short)),
    k as (select count(*) as n_strains, case when stddev_pop(rx) > 0 and stddev_pop(ry) > 0 then corr(rx, ry) end as xy,
            case when stddev_pop(rx) > 0 and stddev_pop(rz) > 0 then corr(rx, rz) end as xz,
            case when stddev_pop(ry) > 0 and stddev_pop(rz) > 0 then corr(ry, rz) end as yz from r)"""
CORR_OUT = """select '{x}_vs_{y}' as comparison, n_strains, round(xy, 6) as rho_raw,
    round((xy - xz * yz) / sqrt((1 - xz * xz) * (1 - yz * yz)), 6) as rho_partial_length from k"""


def corr_rows(t: Tables):
    return G.strain_content(matrix(t), freq(t), t.strains).join(G.assembly_stats(contigs(t)), "short")


@query("M13_spearman", freq_base() + f", ctg as ({CONTIGS})" + CONTENT + STATS
       + CORR.format(x="accessory_present", y="n50") + CORR_OUT.format(x="accessory_present", y="n50"))
def spearman(t: Tables):
    return G.spearman(corr_rows(t), "accessory_present", "n50", "total_length").withColumn(
        "rho_raw", F.round("rho_raw", 6)).withColumn("rho_partial_length", F.round("rho_partial_length", 6))


@query("W10_average_rank", ctes("fx_genes") + """
    , z as (select short, family, count(*) as n from fx_genes group by 1, 2)
    select short, family, n, rank() over (partition by short order by n)
           + (count(*) over (partition by short, n) - 1) / 2 as rank from z""")
def average_rank(t: Tables):
    from genespark.operators.ordered import average_rank as op
    return op(t.genes.groupBy("short", "family").agg(F.count("*").alias("n")), "n", ["short"])


@query("P11_background_families", freq_base() + "select family from freq where bin in ('shell', 'cloud')")
def background(t: Tables):
    return G.background_families(freq(t))


@query("P12_absent_cells", ctes("fx_genes", "fx_strains", "fx_presence") + """
    select f.family, s.short from (select distinct family from fx_genes) f cross join fx_strains s
    where not exists (select 1 from fx_presence p where p.family = f.family and p.short = s.short)""")
def absent_cells(t: Tables):
    return G.absent_cells(matrix(t), families(t), t.strains)


@query("P13_representatives", ctes("fx_presence", "fx_strains") + """
    select * from fx_presence where short in (select short from fx_strains where is_rep = 1)""")
def representatives(t: Tables):
    return G.representatives(t.presence, t.strains)


HITS = """
    , q as (select *, least(sstart, send) as st, greatest(sstart, send) as en from fx_genome_hits
            where pident >= 90 and qcovs >= 80),
    lens as (select concat('F', p_partkey % 200) as family, min(p_size) * 9 as length from part
             where p_partkey % 200 < 190 group by 1),
    f1 as (select q.*, case when exists (select 1 from thin g where g.short = q.short and g.contig = q.contig
              and g.family <> q.family and g_start <= en and g_start + g_len >= st) then 'overlap'
              when l.length < 150 then 'short_rep' else 'clear' end as first
           from q left join lens l using (family)),
    crowd as (select short, contig, st // 2000 as w, count(distinct family) as n from f1 where first = 'clear'
              group by 1, 2, 3),
    lab as (select f1.*, case when first <> 'clear' then first when n >= 3 then 'hotspot' else 'accepted' end as outcome
            from f1 left join crowd c on c.short = f1.short and c.contig = f1.contig and c.w = st // 2000)"""
THIN = "select * from fx_genes"


def qualifying(t: Tables):
    return G.qualifying_hits(t.genome_hits)


def labelled(t: Tables):
    lengths = t.part.where(F.col("p_partkey") % 200 < 190).groupBy(
        F.concat(F.lit("F"), F.col("p_partkey") % 200).alias("family")).agg((F.min("p_size") * 9).alias("length"))
    return G.rescue_filter(qualifying(t), genes(t), lengths)


@query("A16_rescue_filter", ctes("fx_genome_hits", "fx_genes", thin=THIN) + HITS
       + "select hit_id, family, short, contig, st as start, en as end, outcome from lab")
def rescue_filter(t: Tables):
    return labelled(t).select("hit_id", "family", "short", "contig", "start", "end", "outcome")


@query("J8_overlap_other_family", ctes("fx_genome_hits", "fx_genes", thin=THIN) + HITS
       + "select hit_id from lab where outcome = 'overlap'")
def overlap_other(t: Tables):
    return labelled(t).where(F.col("outcome") == "overlap").select("hit_id")


RESC = """
    , cells as (select distinct family, short from lab where outcome = 'accepted'),
    known as (select c.*, s.short is not null as ok, p.short is not null as has from cells c
              left join (select short from fx_strains where is_rep = 1) s on s.short = c.short
              left join fx_presence p on p.family = c.family and p.short = c.short)"""


def rep_strains(t: Tables):
    return t.strains.where(F.col("is_rep") == 1)


@query("A15_apply_rescue", ctes("fx_genome_hits", "fx_genes", "fx_strains", "fx_presence", thin=THIN) + HITS + RESC + """
    select family, short, copies, 'present' as state from fx_presence
    union all select family, short, 0, 'genome_only' from known where ok and not has""")
def apply_rescue(t: Tables):
    ok = labelled(t).where(F.col("outcome") == "accepted")
    return G.apply_rescue(matrix(t), ok, families(t), rep_strains(t))


@query("K8_rescue_funnel", ctes("fx_genome_hits", "fx_genes", "fx_strains", "fx_presence", thin=THIN) + HITS + RESC + """
    select 'rows_parsed' as metric, count(*) as value from fx_genome_hits
    union all select 'rows_passed_threshold', count(*) from lab
    union all select 'rows_rejected_' || o, (select count(*) from lab where outcome = o)
      from (select unnest(['overlap', 'short_rep', 'hotspot']) as o)
    union all select 'applied', count(*) filter (where ok and not has) from known
    union all select 'skipped', count(*) filter (where not ok) from known""")
def rescue_funnel(t: Tables):
    return G.rescue_funnel(t.genome_hits, labelled(t), matrix(t), families(t), rep_strains(t))


@query("A44_diagnostics", freq_base("fx_genome_hits") + f", ctg as ({CONTIGS}), thin as ({THIN})" + HITS + CONTENT + STATS
       + CORR.format(x="accessory_present", y="n50") + ", k1 as (" + CORR_OUT.format(x="accessory_present", y="n50") + """)
    , a as (select count(*) filter (where outcome = 'overlap') / count(*) as v from lab)
    select 'rescue_redundancy' as diagnostic, round(v, 6) as value, case when v > 0.5 then 'triggered' else 'ok' end
      as status from a
    union all
    select 'assembly_quality_confound', greatest(abs(rho_raw), abs(rho_partial_length)),
      case when greatest(abs(rho_raw), abs(rho_partial_length)) > 0.3 then 'triggered' else 'ok' end from k1""")
def diagnostics(t: Tables):
    funnel = G.rescue_funnel(t.genome_hits, labelled(t), matrix(t), families(t), rep_strains(t))
    corr = G.spearman(corr_rows(t), "accessory_present", "n50", "total_length")
    return G.diagnose_rescue(funnel).unionByName(G.diagnose_confound(corr)).withColumn("value", F.round("value", 6))


@query("W8_rescue_positions", ctes("fx_genome_hits") + """
    , q as (select family, short, min({'b': -bitscore, 'c': contig, 's': least(sstart, send), 'e': greatest(sstart, send)}) as h
            from fx_genome_hits where pident >= 90 and qcovs >= 80 group by 1, 2)
    select family, short, h.c as contig, h.s as start, h.e as "end" from q""")
def rescue_positions(t: Tables):
    return G.best_rescue_positions(qualifying(t))


# placed genes: two in three genes have a family; rescue hits come from strains' best genome hits
RANKED = """
    , allg as (select short, contig, g_start as start, g_start + g_len as "end", protein_id as id,
                 case when g_start % 3 = 0 then null else family end as family from fx_genes
               union all
               select short, h.c, h.s, h.e, concat('~', family), family from (
                 select family, short, min({'b': -bitscore, 'c': contig, 's': least(sstart, send), 'e': greatest(sstart, send)}) as h
                 from fx_genome_hits where pident >= 100 and qcovs >= 90 group by 1, 2)),
    pos as (select * from (select short, family, contig, start, "end", id,
              row_number() over (partition by short order by contig, start, id, family nulls first, "end") - 1 as rank from allg)
            where family is not null)"""


def placed(t: Tables):
    return t.once("placed", lambda: _placed(t))


def _placed(t: Tables):
    some = genes(t).withColumn("family", F.when(F.col("start") % 3 != 0, F.col("family")))
    return G.family_positions(some, G.best_rescue_positions(G.qualifying_hits(t.genome_hits, 100, 90)))


@query("W2_family_rank", ctes("fx_genes", "fx_genome_hits") + RANKED
       + 'select short, family, contig, rank, start, "end", id from pos')
def family_rank(t: Tables):
    return placed(t)


@query("W3_contig_rank", ctes("fx_genes") + """
    select short, protein_id, contig, row_number() over (partition by short, contig order by g_start, protein_id) - 1
      as rank from fx_genes""")
def contig_rank(t: Tables):
    return G.contig_rank(genes(t).drop("end", "family")).drop("start")


@query("A47_contig_spans", ctes("fx_genes", "fx_genome_hits") + RANKED
       + "select short, contig, min(rank) as first_rank, max(rank) as last_rank from pos group by 1, 2")
def contig_spans(t: Tables):
    return G.contig_spans(placed(t))


@query("W5_sliding_windows", ctes("fx_genes", "fx_genome_hits") + RANKED + """
    , i as (select short, contig, family, rank, row_number() over (partition by short order by rank) as i from pos),
    w as (select a.short, a.i, a.rank as first_rank, min(b.contig) as contig, max(b.contig) as c2, count(*) as n,
                 string_agg(b.family, ',' order by b.i) as families
          from i a join i b on b.short = a.short and b.i between a.i and a.i + 4 group by 1, 2, 3)
    select short, contig, first_rank, families from w where n = 5 and contig = c2""")
def sliding_windows(t: Tables):
    return G.sliding_windows(placed(t), 5)


@query("F9_group_representatives", ctes("fx_genes", "fx_strains", ctg=CONTIGS) + STATS + """
    , inv as (select st.short, n50, s.clade as dedup_group from st join fx_strains s using (short))
    select short, n50, dedup_group, case when row_number() over (partition by dedup_group
      order by n50 desc, short desc) = 1 then 1 else 0 end as is_representative from inv""")
def group_representatives(t: Tables):
    inv = G.assembly_stats(contigs(t)).join(t.strains, "short").select(
        "short", "n50", F.col("clade").alias("dedup_group"))
    return G.representative_per_group(inv)


@query("J22_fill_taxon_group", ctes("fx_samples", "fx_strains") + """
    , s as (select short, case when substr(taxon_group, 2) in ('1', '3') then '' else taxon_group end as taxon_group
            from fx_samples),
    l as (select replace(short, 'S', 'N') as short, clade from fx_strains)
    select s.short, coalesce(nullif(trim(taxon_group), ''), clade, '') as taxon_group from s left join l using (short)""")
def fill_taxon_group(t: Tables):
    s = t.samples.select("short", F.when(F.col("taxon_group").isin("R1", "R3"), "").otherwise(
        F.col("taxon_group")).alias("taxon_group"))
    labels = t.strains.select(F.regexp_replace("short", "S", "N").alias("short"), "clade")
    return G.fill_labels(s, labels)


@query("A48_unlabelled_share", ctes("fx_strains") + """
    , s as (select avg(case when clade in ('C0', 'C1', 'C2') then 1.0 else 0.0 end) as share from fx_strains)
    select round(share, 6) as share, case when share > 0.5 then 'warn' else 'ok' end as status from s""")
def unlabelled_share(t: Tables):
    s = t.strains.withColumn("clade", F.when(F.col("clade") == "C3", F.col("clade")).otherwise(""))
    return G.unlabelled_share(s).withColumn("share", F.round("share", 6))


@query("A20_group_tables", freq_base() + """
    select 'bin' as what, bin as label, count(*) as n, round(100 * count(*) / (select count(*) from freq), 1) as pct
    from freq group by 2
    union all select 'bin_out', bin_out, count(*), round(100 * count(*) / (select count(*) from freq), 1)
    from freq group by 2""")
def group_tables(t: Tables):
    from genespark.operators.report import shares
    f = freq(t)
    return shares(f, "bin").unionByName(shares(f, "bin_out"))
