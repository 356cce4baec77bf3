"""Locus queries: loci of two families each, one for every family, followed across all strains."""

from __future__ import annotations

from pyspark.sql import functions as F

from genespark.operators import loci as L
from genespark.operators import pangenome as G
from genespark.operators import select as S
from genespark.plans.pangenome import RANKED, contigs, families, genes, matrix, placed
from genespark.plans.registry import query
from genespark.plans.views import Tables, ctes

num = lambda c: F.substring(c, 2, 9).cast("int")


def members(t: Tables):
    """Each family with the third one after it."""
    f = families(t)
    two = F.explode(F.array(num("family"), (num("family") + 3) % 200))
    return f.select(F.concat(F.lit("L"), num("family")).alias("locus_id"), two.alias("f")).select(
        "locus_id", F.concat(F.lit("F"), "f").alias("family"))


def placement_rows(t: Tables):
    return t.once("placements", lambda: L.placements(members(t), placed(t)))


@query("W12_placements", ctes("fx_genes", "fx_genome_hits") + RANKED + """
    , lm as (select concat('L', i) as locus_id, concat('F', i) as a, concat('F', (i + 3) % 200) as b from (
        select distinct cast(substr(family, 2) as int) as i from fx_genes)),
    pr as (select locus_id, x.short, min({'w': abs(x.rank - y.rank), 'c': x.contig, 'l': least(x.rank, y.rank),
             'h': greatest(x.rank, y.rank)}) as m
           from lm join pos x on x.family = a join pos y on y.family = b and y.short = x.short and y.contig = x.contig
           where abs(x.rank - y.rank) <= 11 group by 1, 2)
    select locus_id, short, m.c as contig, m.l as lo, m.h as hi from pr""")
def placements(t: Tables):
    return L.placements(members(t), placed(t))


def strain_table(t: Tables):
    n50 = G.assembly_stats(contigs(t)).select("short", "n50")
    return t.once("strain_table", lambda: t.strains.join(n50, "short", "left").select(
        "short", "grp", F.col("clade").alias("species"), "n50",
        F.when(F.col("is_rep") == 0, num("short")).alias("priority")))


def spans(t: Tables):
    return t.once("spans", lambda: G.contig_spans(placed(t)))


def exemplar_rows(t: Tables):
    return t.once("exemplars", lambda: L.exemplars(placement_rows(t), spans(t), strain_table(t)))


@query("F8_exemplars")
def exemplars(t: Tables):
    return exemplar_rows(t)


def column_rows(t: Tables):
    return t.once("columns", lambda: L.columns(exemplar_rows(t), placed(t), 3))


@query("W14_columns")
def columns(t: Tables):
    return column_rows(t)


def state_matrix(t: Tables):
    from genespark.operators.pangenome import best_rescue_positions, qualifying_hits
    m = t.genes.where(F.col("g_start") % 3 != 0).select("family", "short").distinct().withColumn("state", F.lit("present"))
    r = best_rescue_positions(qualifying_hits(t.genome_hits, 100, 90)).select("family", "short").join(
        m, ["family", "short"], "left_anti").withColumn("state", F.lit("genome_only"))
    return m.unionByName(r)


def cell_rows(t: Tables):
    return t.once("cells", lambda: L.cell_states(column_rows(t), placed(t), state_matrix(t), spans(t)))


@query("M23_cell_states")
def cell_states(t: Tables):
    return cell_rows(t).groupBy("locus_id", "col", "part", "base", "code").agg(F.count("*").alias("n_strains"))


@query("W13_nearest_other_family", ctes("fx_genes", "fx_genome_hits") + RANKED + """
    , lm as (select concat('L', i) as locus_id, unnest([concat('F', i), concat('F', (i + 3) % 200)]) as family from (
        select distinct cast(substr(family, 2) as int) as i from fx_genes)),
    c as (select locus_id, short, contig, family, rank from lm join pos using (family)),
    m as (select x.locus_id, x.short, x.contig, x.family, x.rank, min({'a': abs(y.rank - x.rank), 'd': y.rank - x.rank, 'n': y.family}) as m
          from c x join c y on x.locus_id = y.locus_id and x.short = y.short and x.contig = y.contig and x.family <> y.family
          and abs(y.rank - x.rank) <= 10 group by 1, 2, 3, 4, 5)
    select locus_id, short, contig, family, rank, m.n as neighbour, m.d as delta from m""")
def nearest_other(t: Tables):
    return L.nearest_other(L._copies(members(t), placed(t)))


def mask_rows(t: Tables):
    return t.once("mask", lambda: L.informative_columns(cell_rows(t)))


def pair_rows(t: Tables):
    return t.once("pairs", lambda: L.flank_pairs(column_rows(t), placed(t), 40))


def class_rows(t: Tables):
    return t.once("classes", lambda: L.row_classes(cell_rows(t), pair_rows(t), mask_rows(t)))


@query("M23_row_classes")
def row_classes(t: Tables):
    return class_rows(t).groupBy("locus_id", "row_class").agg(F.count("*").alias("n_strains"))


@query("W15_contig_breaks")
def contig_breaks(t: Tables):
    return cell_rows(t).where(F.col("code") == L.BREAK).groupBy("locus_id", "col").agg(F.count("*").alias("n_strains"))


@query("A43_collapsed_rows")
def collapsed_rows(t: Tables):
    return L.collapse_rows(class_rows(t))


@query("A43_species_counts")
def species_counts(t: Tables):
    return L.species_counts(class_rows(t), strain_table(t))


@query("W16_breakpoints")
def breakpoints(t: Tables):
    return L.breakpoints(cell_rows(t), class_rows(t), strain_table(t))


def rank_rows(t: Tables):
    return t.once("ranks", lambda: L.locus_ranks(class_rows(t), column_rows(t), strain_table(t)))


@query("M26_locus_ranks")
def locus_ranks(t: Tables):
    return rank_rows(t)


@query("F7_drawn_set")
def drawn_set(t: Tables):
    return S.drawn_set(rank_rows(t), 5, 20).select("locus_id", "carriers", "losses", "reason")


@query("F4_candidate_loci", ctes("fx_genes", "fx_presence", "fx_strains") + """
    , l as (select family as locus_id, count(*) as carriers, (select count(*) from fx_genes g where g.family = p.family) as size
            from fx_presence p group by 1),
    b as (select *, (carriers / (select count(*) from fx_strains) >= 0.2)::int + (carriers / (select count(*) from fx_strains) >= 0.5)::int
             as stratum from l where carriers >= 2),
    r as (select *, row_number() over (partition by stratum order by size desc, locus_id) as r from b)
    select locus_id, carriers, size, stratum from r order by r, stratum limit 60""")
def candidate_loci(t: Tables):
    size = t.genes.groupBy(F.col("family").alias("locus_id")).agg(F.count("*").alias("size"))
    loci = t.presence.groupBy(F.col("family").alias("locus_id")).agg(F.count("*").alias("carriers")).join(size, "locus_id")
    return S.candidate_loci(loci, t.strains.count(), 60, strata=(0.2, 0.5))


@query("M24_dna_calls")
def dna_calls(t: Tables):
    c = cell_rows(t).where(F.col("part") == "locus")
    h = F.pmod(F.xxhash64("locus_id", "short", "col"), F.lit(3))
    calls = c.select("locus_id", "short", "col", F.when(h == 0, "present").when(h == 1, "absent").otherwise("unchecked").alias("call"))
    return L.apply_dna_calls(cell_rows(t), class_rows(t), mask_rows(t), calls, t.strains.count()).groupBy(
        "locus_id", "row_class").agg(F.count("*").alias("n_strains"))


def dna_recount(t: Tables):
    """Calls from the genome hits of each column's family; a gene's query part is 20 to 219."""
    def make():
        cols = column_rows(t).where(F.col("part") == "locus").select("locus_id", "col", "family")
        h = t.genome_hits.select("family", "short", "pident", "qstart", "qend").join(cols, "family").drop("family")
        g = cols.select("locus_id", "col", F.lit(20).alias("g_start"), F.lit(219).alias("g_end"))
        return L.gene_coverage(h, g, 90, 0.5).select("locus_id", "short", "col", "call")
    calls = t.once("calls", make)
    return L.dna_recount(cell_rows(t), class_rows(t), mask_rows(t), calls, column_rows(t), strain_table(t))


@query("M24_recounted_rows")
def recounted_rows(t: Tables):
    rows, _, _, summary = dna_recount(t)
    return rows.groupBy("locus_id", "row_class").agg(F.count("*").alias("n_strains")).join(summary, "locus_id", "left")


@query("M26_recounted_ranks")
def recounted_ranks(t: Tables):
    return dna_recount(t)[1]


@query("W16_recounted_breakpoints")
def recounted_breakpoints(t: Tables):
    return dna_recount(t)[2]


@query("M25_gene_coverage", ctes("fx_genome_hits") + """
    , g as (select family as locus_id, short, 1 as col, greatest(qstart, 20) as a, least(qend, 219) as b from fx_genome_hits
            where pident >= 90 and greatest(qstart, 20) <= least(qend, 219)),
    o as (select *, max(b) over (partition by locus_id, short order by a, b rows between unbounded preceding and 1 preceding) as r from g),
    c as (select locus_id, short, sum(greatest(0, b - greatest(a, coalesce(r + 1, a)) + 1)) as n from o group by 1, 2),
    e as (select distinct family as locus_id, short from fx_genome_hits)
    select locus_id, short, 1 as col, round(coalesce(n, 0) / 200, 6)::double as share,
      case when coalesce(n, 0) / 200 >= 0.5 then 'present' else 'absent' end as call from e left join c using (locus_id, short)""")
def gene_coverage(t: Tables):
    h = t.genome_hits.select(F.col("family").alias("locus_id"), "short", F.lit(1).alias("col"), "pident", "qstart", "qend")
    g = families(t).select(F.col("family").alias("locus_id"), F.lit(1).alias("col"), F.lit(20).alias("g_start"), F.lit(219).alias("g_end"))
    return L.gene_coverage(h, g, 90, 0.5).withColumn("share", F.round("share", 6))


@query("M29_dna_targets")
def dna_targets(t: Tables):
    return L.dna_targets(class_rows(t), pair_rows(t), placed(t), column_rows(t), genes(t))
