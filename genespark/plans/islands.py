"""Accessory island queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from genespark.operators import islands as I
from genespark.operators import pangenome as G
from genespark.plans.pangenome import FREQ, RANKED, freq, genes, matrix, placed
from genespark.plans.registry import query
from genespark.plans.views import Tables, ctes
from genespark.session import materialize

PAIRS = """
    , allpairs as (select distinct least(f, g) as family_a, greatest(f, g) as family_b from (
        select family as f, concat('F', (cast(substr(family, 2) as int) + d) % 200) as g
        from (select distinct family from fx_genes), (select unnest([1, 3, 7, 20, 50]) as d))),
    cpairs as (select *, case (cast(substr(family_a, 2) as int) + cast(substr(family_b, 2) as int)) % 3
        when 0 then 'starship_explained' when 1 then 'unexplained_physical' else 'trans' end as classification
        from allpairs)"""
RUNS = """
    , z as (select p.short, p.contig, p.family, p.rank, p.start, p."end", coalesce(f.bin in ('core', 'soft_core'), true) as core
            from pos p left join freq f using (family)),
    y as (select *, cast(sum(case when core then 1 else 0 end) over (partition by short, contig order by rank) as bigint)
              as run from z),
    acc as (select * exclude (core) from y where not core),
    runs as (select short, contig, run, count(*) as size, min(rank) as first_rank, max(rank) as last_rank,
               min(start) as start, max("end") as "end" from acc group by 1, 2, 3 having count(*) >= 2)"""
ISL = """
    , m as (select distinct short, contig, run, family from acc),
    sup as (select a.short, a.contig, a.run, count(*) as n_supporting_pairs,
              string_agg(distinct classification, ',' order by classification) as classifications
            from m a join cpairs p on a.family = p.family_a and classification <> 'trans'
            join m b on b.short = a.short and b.contig = a.contig and b.run = a.run and b.family = p.family_b
            group by 1, 2, 3),
    s2 as (select s.*, r.size, (select string_agg(m.family, ',' order by m.family) from m
             where m.short = s.short and m.contig = s.contig and m.run = s.run) as fams
           from sup s join runs r using (short, contig, run)),
    isl as (select fams, classifications, count(*) as n_strains,
              min({'s': short, 'c': contig, 'r': run, 'z': size, 'n': n_supporting_pairs}) as e from s2 group by 1, 2)"""


def isl_base():
    return ctes("fx_genes", "fx_genome_hits", "fx_strains", "fx_presence") + RANKED + ", " + FREQ + PAIRS + RUNS + ISL


def class_pairs(t: Tables):
    num = F.substring("f", 2, 9).cast("int")
    p = t.genes.select(F.col("family").alias("f")).distinct().select(
        "f", F.explode(F.array(*[F.lit(d) for d in (1, 3, 7, 20, 50)])).alias("d"))
    p = p.select("f", F.concat(F.lit("F"), (num + F.col("d")) % 200).alias("g")).select(
        F.least("f", "g").alias("family_a"), F.greatest("f", "g").alias("family_b")).distinct()
    k = (F.substring("family_a", 2, 9).cast("int") + F.substring("family_b", 2, 9).cast("int")) % 3
    return p.withColumn("classification", F.when(k == 0, "starship_explained").when(k == 1, "unexplained_physical")
                        .otherwise("trans"))


def rows(t: Tables):
    return materialize(I.accessory_rows(placed(t), freq(t)))


def supported(t: Tables, acc):
    return I.supported_runs(acc, class_pairs(t))


def islands(t: Tables, acc=None):
    acc = rows(t) if acc is None else acc
    return materialize(I.distinct_islands(supported(t, acc), acc))


@query("W4_accessory_runs", isl_base() + "select * from runs")
def accessory_runs(t: Tables):
    return I.runs_of(rows(t))


@query("J15_supported_runs", isl_base() + """
    select short, contig, run, n_supporting_pairs, classifications, size from s2""")
def supported_runs(t: Tables):
    return supported(t, rows(t)).select("short", "contig", "run", "n_supporting_pairs", "classifications", "size")


def with_lists(t: Tables):
    acc = rows(t)
    isl = islands(t, acc)
    mem = materialize(I.island_members(isl, acc))
    return acc, isl, mem


@query("A23_islands", isl_base() + """
    select n_strains, e.s as example_strain, e.z as island_size, e.n as n_supporting_pairs, classifications,
           fams as member_families,
           case when list_has_any(string_split(fams, ','), ['F3', 'F17', 'F33', 'F104']) then 'Y' else 'N' end
             as has_captain from isl""")
def island_table(t: Tables):
    acc, isl, mem = with_lists(t)
    marker = t.genes.where(F.col("family").isin("F3", "F17", "F33", "F104")).select("family")
    return I.marker_flag(isl, mem, marker, "captain").join(I.member_lists(mem), "island_id").select(
        "n_strains", "example_strain", "island_size", "n_supporting_pairs", "classifications", "member_families",
        "has_captain")


@query("A20_island_sizes", isl_base() + "select e.z as island_size, count(*) as n_islands from isl group by 1")
def island_sizes(t: Tables):
    return I.size_distribution(islands(t))


@query("A20_marker_summary", isl_base() + """
    , h as (select count(*) as n, count(*) filter (where list_has_any(string_split(fams, ','), ['F3', 'F17', 'F33']))
            as k from isl)
    select 'captain' as marker_name, k as n_islands_with_marker, n as n_islands_total, round(100 * k / n, 1)
      as pct_islands_with_marker from h""")
def marker_summary(t: Tables):
    acc, isl, mem = with_lists(t)
    marker = t.genes.where(F.col("family").isin("F3", "F17", "F33")).select("family")
    return I.marker_summary(I.marker_flag(isl, mem, marker, "captain"), ["captain"])


@query("J14_island_instances", isl_base() + """
    , rs as (select r.*, (select string_agg(m.family, ',' order by m.family) from m where m.short = r.short
               and m.contig = r.contig and m.run = r.run) as fams from runs r)
    select short, contig, run, size, start, "end" from rs where fams in (select fams from isl)""")
def island_instances(t: Tables):
    acc = rows(t)
    return I.instances(acc, islands(t, acc)).select("short", "contig", "run", "size", "start", "end")


# a few families stand for an island: the first three members of each
@query("A42_haplotypes", isl_base() + """
    , im as (select fams || classifications as id, unnest(string_split(fams, ',')) as family from isl),
    pt as (select id, s.short, coalesce(string_agg(p.family, ',' order by p.family), '') as pat, count(p.family) as k
           from (select distinct id from im) cross join fx_strains s
           left join (select im.id, p.family, p.short from im join fx_presence p using (family)) p using (id, short)
           group by 1, 2),
    h as (select id, pat, k, count(*) as n from pt group by 1, 2, 3)
    select k as n_present, n as n_strains, count(*) as n_patterns from h group by 1, 2""")
def haplotypes(t: Tables):
    acc, isl, mem = with_lists(t)
    return I.haplotypes(mem, matrix(t), t.strains).groupBy("n_present", "n_strains").agg(
        F.count("*").alias("n_patterns"))


REFS = ", refs as (select short, cast(substr(short, 2) as int) as priority from fx_strains where is_rep = 0)"
SHOWN = REFS + """
    , im as (select {'f': fams, 'c': classifications} as id, e.s as ex, unnest(string_split(fams, ',')) as family,
               len(string_split(fams, ',')) as n from isl),
    pl as (select short, family, p.c as contig, p.s as start, p.e as "end" from (
             select short, family, min({'c': contig, 's': start, 'i': id, 'e': "end"}) as p from pos
             where id[1] <> '~' group by 1, 2)),
    okref as (select im.id, r.short, r.priority from im join pl using (family) join refs r using (short)
              group by 1, 2, 3 having count(*) = max(im.n) and count(distinct contig) = 1),
    pick as (select id, min({'p': priority, 's': short}) as q from okref group by 1),
    sh0 as (select i.id, coalesce(q.s, ex) as display_strain from (select distinct id, ex from im) i left join pick using (id)),
    shown as (select s.id, display_strain, count(pl.family) as n_members_with_coordinates,
                count(distinct contig) as n_contigs_in_locus,
                case when count(distinct contig) = 1 then min(contig) end as span_contig,
                case when count(distinct contig) = 1 then min(start) end as span_start,
                case when count(distinct contig) = 1 then max("end") end as span_end
              from sh0 s join im using (id) left join pl on pl.short = display_strain and pl.family = im.family group by 1, 2)"""


def shown_of(t: Tables, isl, mem):
    refs = t.strains.where(F.col("is_rep") == 0).select("short", F.substring("short", 2, 9).cast("int").alias("priority"))
    return materialize(I.display_strain(isl, mem, placed(t), refs))


def shown(t: Tables):
    acc, isl, mem = with_lists(t)
    return mem, shown_of(t, isl, mem)


@query("J24_display_strain", isl_base() + SHOWN + """
    select id.f as member_families, id.c as classifications, display_strain, span_contig, span_start, span_end,
      n_members_with_coordinates, n_contigs_in_locus from shown""")
def display_strain(t: Tables):
    acc, isl, mem = with_lists(t)
    return shown_of(t, isl, mem).join(I.member_lists(mem), "island_id").join(
        isl.select("island_id", "classifications"), "island_id").drop("island_id")


@query("F1_top_islands", isl_base() + SHOWN + """
    select island_size, n_strains, fams as member_families, classifications from (
      select e.z as island_size, n_strains, fams, classifications, from isl
      join shown on shown.id = {'f': fams, 'c': classifications} where n_strains >= 2 and span_contig is not null)
    qualify rank() over (order by island_size desc, n_strains desc) <= 50""")
def top_islands(t: Tables):
    acc, isl, mem = with_lists(t)
    top = I.top_islands(isl, shown_of(t, isl, mem), 2, 50)
    return top.join(I.member_lists(mem), "island_id").select("island_size", "n_strains", "member_families", "classifications")


@query("W18_column_order", isl_base() + SHOWN + """
    , p as (select short, family, contig, min(rank) as rank from pos group by 1, 2, 3),
    g as (select s.id, im.family, display_strain, min(case when p.contig = span_contig then rank end) as o, min(rank) as a
          from shown s join im using (id) left join p on p.short = display_strain and p.family = im.family group by 1, 2, 3)
    select display_strain, family, row_number() over (partition by id order by case when o is not null then 0
      when a is not null then 1 else 2 end, coalesce(o, a), family) - 1 as column_no from g""")
def column_order(t: Tables):
    mem, sh = shown(t)
    return I.column_order(mem, placed(t), sh).join(sh.select("island_id", "display_strain"), "island_id").select(
        "display_strain", "family", F.col("column").cast("bigint").alias("column_no"))


def family_genes(t: Tables):
    """Genes that have a family; ``placed`` takes the same ones."""
    return genes(t).where(F.col("start") % 3 != 0)


def rescue_hits(t: Tables):
    return G.best_rescue_positions(G.qualifying_hits(t.genome_hits, 100, 90))


@query("W19_column_copy", isl_base() + SHOWN + """
    , rs as (select family, short, min({'b': -bitscore, 'c': contig, 's': least(sstart, send), 'e': greatest(sstart, send)}) as h
             from fx_genome_hits where pident >= 100 and qcovs >= 90 group by 1, 2),
    gg as (select s.id, im.family, min({'t': case when g.contig = span_contig and g.g_start between span_start and span_end
               then 0 when g.contig = span_contig then 1 else 2 end, 's': g.g_start, 'c': g.contig}) as b
             from shown s join im using (id)
             join fx_genes g on g.short = display_strain and g.family = im.family and g_start % 3 <> 0 group by 1, 2)
    select display_strain, im.family, coalesce(b.c, rs.h.c) as contig, coalesce(b.s, rs.h.s) as start,
      case when b is not null then 'gene' when rs.h is not null then 'rescue' else 'none' end as source
    from shown s join im using (id) left join gg on gg.id = s.id and gg.family = im.family
    left join rs on rs.family = im.family and rs.short = display_strain""")
def column_copy(t: Tables):
    mem, sh = shown(t)
    return I.column_copy(mem, sh, family_genes(t), rescue_hits(t)).join(sh.select("island_id", "display_strain"), "island_id").drop(
        "island_id")
