"""Sheet, table and report-row queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from genespark.operators import annotate as A
from genespark.operators import islands as I
from genespark.operators import loci as L
from genespark.plans import loci as LP
from genespark.plans.islands import family_genes, rescue_hits, shown, with_lists
from genespark.plans.pangenome import freq, genes, matrix, placed
from genespark.plans.registry import ORACLES, query
from genespark.plans.views import Tables, ctes
from genespark.sources import tables as TB
from genespark.sources import text as TX

num = lambda c: F.substring(c, 2, 9).cast("int")


@query("S1_sample_sheet", """select case c_nationkey % 3 when 0 then 'IN' when 1 then 'DISCOVERY_TARGET' else 'OUT' end as grp,
    c_name as species, concat('S', c_custkey) as short, c_mktsegment as taxon_group,
    case when c_custkey % 2 = 0 then concat('st', c_nationkey) else c_mktsegment end as stratum_label from customer""")
def sample_sheet(t: Tables):
    n = F.col("c_nationkey") % 3
    df = t.customer.select(
        F.when(n == 0, " IN").when(n == 1, "TARGET").otherwise("OUT ").alias("GROUP"), F.col("c_name").alias("Species"),
        F.concat(F.lit(" S"), "c_custkey").alias("Short"), F.col("c_mktsegment").alias("TaxonGroup"),
        F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("st"), "c_nationkey")).alias("Stratum"))
    return TB.sample_sheet(df).select("grp", "species", "short", "taxon_group", "stratum_label")


@query("S7_marker_families", ctes("fx_genes") + """
    select distinct short, family from fx_genes where g_start % 3 <> 0""")
def marker_families(t: Tables):
    m = F.concat_ws("|", "short", "protein_id", "contig", "family", "g_start")
    e = F.when(F.col("g_start") % 3 != 0, "1e-9").otherwise("0.5")
    text = t.genes.select(F.concat_ws("  ", m, F.lit("-"), F.lit("CAP"), F.lit("-"), e, F.lit("55.1")).alias("value"))
    members = t.genes.select(m.alias("member"), "family").distinct()
    return TX.marker_families(text, members, 1e-5)


@query("S19_busco_table", """select concat('B', p_partkey) as busco_id, 'N1' as species, concat('P', p_partkey) as protein_id
    from part where p_size % 3 <> 0""")
def busco_table(t: Tables):
    b = t.part.select(F.concat(F.lit("B"), "p_partkey").alias("busco_id"), F.when(F.col("p_size") % 3 != 0, "Complete").otherwise(
        "Missing").alias("status"), F.concat(F.lit("P"), "p_partkey", F.lit(":12-90")).alias("sequence"))
    return TB.busco_table(b, "N1")


@query("S20_region_violations", """
    select reason, count(*) as n from (select case when s_suppkey % 13 = 1 then 'unknown strain'
      when s_suppkey % 13 = 2 then 'coordinates are not integers' when s_suppkey % 13 = 3 then 'end before start' end as reason
      from supplier) where reason is not null group by 1""")
def region_violations(t: Tables):
    k = F.col("s_suppkey") % 13
    df = t.supplier.select(
        F.concat(F.lit("E"), "s_suppkey").alias("id"), F.when(k == 1, "nobody").otherwise(F.concat(F.lit("S"), "s_suppkey")).alias("strain"),
        F.when(k == 2, "x").otherwise("100").alias("start"), F.when(k == 3, "50").otherwise("900").alias("end"))
    return TB.region_violations(df, t.strains).groupBy("reason").agg(F.count("*").alias("n"))


@query("S21_controls", "select count(*) as n from part where p_size % 4 not in (1, 2)")
def control_rows(t: Tables):
    k = F.col("p_size") % 4
    df = t.part.select(F.concat(F.when(k == 1, "EXAMPLE_").otherwise("C"), "p_partkey").alias("control_id"),
                       F.when(k == 2, "<anchor>").otherwise("P1").alias("anchor"))
    return TB.controls(df).agg(F.count("*").alias("n"))


TRAITS = """with tr as (select concat('sp', c_custkey % 300) as species, 'guild' as trait,
    case c_nationkey % 5 when 0 then 'none' when 1 then 'plant' when 2 then 'animal' when 3 then 'soil' else 'typo' end as value from customer)"""


@query("S22_trait_violations", TRAITS + """
    select reason, count(*) as n from (
      select 'not in vocabulary' as reason from tr where value = 'typo'
      union all select 'none beside other values' from (select species from tr group by 1
        having max(case when value = 'none' then 1 else 0 end) = 1 and count(distinct value) > 1)) group by 1""")
def trait_violations(t: Tables):
    v = F.element_at(F.array(*[F.lit(x) for x in ("none", "plant", "animal", "soil", "typo")]), (F.col("c_nationkey") % 5 + 1).cast("int"))
    tr = t.customer.select(F.concat(F.lit("sp"), F.col("c_custkey") % 300).alias("species"), F.lit("guild").alias("trait"), v.alias("value"))
    vocab = tr.select("trait", "value").distinct().where(F.col("value") != "typo")
    return TB.trait_violations(tr, vocab).groupBy("reason").agg(F.count("*").alias("n"))


@query("S23_representative_violations", """select concat('sp', c_custkey % 300) as species, count(*) filter (where c_nationkey % 7 = 0)
    as n_representatives from customer group by 1 having count(*) filter (where c_nationkey % 7 = 0) <> 1""")
def representative_violations(t: Tables):
    p = t.customer.select(F.concat(F.lit("sp"), F.col("c_custkey") % 300).alias("species"), (F.col("c_nationkey") % 7 == 0).cast("int").alias("is_rep"))
    return TB.representative_violations(p)


@query("S25_feature_map", "select concat('P', p_partkey) as protein_id, concat('G', p_partkey % 500) as gene_id from part where p_size % 2 = 0")
def feature_map(t: Tables):
    df = t.part.select(F.when(F.col("p_size") % 2 == 0, "CDS").otherwise("gene").alias("feature"), F.concat(F.lit("P"), "p_partkey").alias(
        "product_accession"), F.concat(F.lit("G"), F.col("p_partkey") % 500).alias("GeneID"), F.lit(None).cast("string").alias("locus_tag"))
    return TB.feature_map(df)


@query("S26_gene_names", """select concat('G', p_partkey) as gene_key, case when p_size % 4 = 0 then '' else p_brand end as gene_name,
    p_name as product from part""")
def gene_names(t: Tables):
    q = F.lit('"')
    df = t.part.select(F.concat(q, F.lit("G"), "p_partkey", q).alias("id"), F.when(F.col("p_size") % 4 == 0, "N/A").otherwise(
        F.col("p_brand")).alias("name"), F.concat(q, "p_name", q).alias("prod"))
    return TB.gene_names(df, "id", "name", "prod")


@query("S27_genome_files", """select concat('Genus', c_nationkey, ' sp', c_custkey) as species, concat('st', c_custkey) as strain,
    concat('Fungi;P', c_nationkey % 3, ';Genus', c_nationkey) as lineage from customer where c_custkey % 5 <> 0 and c_nationkey <> 3""")
def genome_files(t: Tables):
    g, k = F.concat(F.lit("Genus"), "c_nationkey"), F.col("c_custkey")
    files = t.customer.select(F.concat(g, F.lit("_sp"), k, F.lit("_st"), k, F.lit(".v1")).alias("basename"), (k % 5 != 0).cast("int").alias("has_dna"))
    blank = lambda c: F.lit("").alias(c)
    tax = t.customer.where(F.col("c_nationkey") != 3).select(
        F.concat(g, F.lit(" sp"), k).alias("SPECIES"), F.concat(F.lit("P"), F.col("c_nationkey") % 3).alias("PHYLUM"), blank("SUBPHYLUM"),
        blank("CLASS"), blank("SUBCLASS"), blank("ORDER"), blank("FAMILY"), g.alias("GENUS"))
    return TB.genome_files_to_pool(files, tax)[0].select("species", "strain", "lineage")


@query("P3_coarse_bands", ctes("fx_roles") + """
    select short as proteome, case grp when 'DISCOVERY_TARGET' then 'IN' else 'OUT' end as band from fx_roles""")
def coarse_bands(t: Tables):
    from genespark.operators.presence import INGROUP_ROLES, OUTGROUP_ROLES, banded
    return banded(t.roles, INGROUP_ROLES, OUTGROUP_ROLES)


def family_classes(t: Tables):
    names = F.array(*[F.lit(x) for x in ("HET", "MFS_1", "Kinase", "none")])
    return A.dominant_class(t.domains.select("family", F.element_at(names, (F.substring("domain", 2, 9).cast("int") % 4 + 1)).alias("domain")))


@query("J26_island_rows")
def island_rows(t: Tables):
    acc, isl, mem = with_lists(t)
    refs = t.strains.where(F.col("is_rep") == 0).select("short", num("short").alias("priority"))
    from genespark.session import materialize
    sh = materialize(I.display_strain(isl, mem, placed(t), refs))
    cols = materialize(I.column_order(mem, placed(t), sh))
    return I.island_rows(isl, sh, cols, I.column_copy(mem, sh, family_genes(t), rescue_hits(t)), family_classes(t), I.haplotypes(mem, matrix(t), t.strains))


@query("J27_locus_rows")
def locus_rows(t: Tables):
    return L.locus_rows(LP.exemplar_rows(t), LP.column_rows(t), LP.class_rows(t), LP.rank_rows(t), freq(t), family_classes(t))


def scratch(t: Tables, name: str) -> str:
    import uuid
    from genespark.session import checkpoint_root
    return f"{checkpoint_root(t.spark)}/genespark/{name}-{uuid.uuid4().hex}"


@query("S4_hit_table_union", ctes("fx_hits") + """
    select query_id, target_id, evalue, bitscore, query_proteome, target_proteome from fx_hits""")
def hit_table_union(t: Tables):
    path = scratch(t, "hits")
    cols = ["query_id", "target_id", "evalue", "bitscore", "query_proteome", "target_proteome"]
    t.hits.select(*cols).withColumn("part", F.col("query_proteome")).write.option("header", True).option("sep", "\t").partitionBy(
        "part").csv(path)
    return TB.hit_tables(t.spark, path).select(*cols)


@query("S24_pfam2go", """select distinct concat('PF', p_size) as accession, concat('GO:', p_partkey % 4) as go_id from part""")
def pfam2go(t: Tables):
    return TX.pfam2go(t.part.select(F.concat(F.lit("Pfam:PF"), "p_size", F.lit(" Dom > GO:x ; GO:"), F.col("p_partkey") % 4).alias(
        "value"))).distinct()


@query("K2_candidate_list", ORACLES["pairwise_candidates"])
def candidate_list(t: Tables):
    from genespark.plans.presence import pairwise_candidates
    return pairwise_candidates(t)


@query("K3_species_files", ctes("fx_genes") + "select short as source_proteome, protein_id, family from fx_genes")
def species_files(t: Tables):
    from genespark.sources.sinks import write_by_species
    path = scratch(t, "species")
    write_by_species(t.genes.select(F.col("short").alias("source_proteome"), "protein_id", "family"), path)
    return t.spark.read.option("header", True).option("sep", "\t").csv(path)


@query("K5_long_matrix", ctes("fx_presence") + "select family, short, copies, 'present' as state from fx_presence")
def long_matrix(t: Tables):
    from genespark.sources.sinks import write_matrix
    path = scratch(t, "matrix")
    write_matrix(matrix(t), path)
    return t.spark.read.parquet(path)


@query("J23_unknown_ids", ctes("fx_genes", "fx_presence") + """
    select short, family, count(*) as n from fx_genes g
    where not exists (select 1 from fx_presence p where p.family = g.family and p.short = g.short) group by 1, 2""")
def unknown_ids(t: Tables):
    return t.genes.join(t.presence, ["family", "short"], "left_anti").groupBy("short", "family").agg(F.count("*").alias("n"))


@query("F2_trait_species", """
    with l as (select concat('sp', c_custkey) as species, c_custkey as k, c_nationkey as c, c_custkey % 40 as d from customer),
    f as (select c, d from l where k = 7)
    select l.species, case when l.d = f.d then 'GENUS' else 'ORDER' end as rank_name, case when l.d = f.d then 7 else 5 end as depth
    from l, f where k <> 7 and l.c = f.c and k % 3 = 0 order by 3 desc, 1 limit 8""")
def trait_species(t: Tables):
    from genespark.operators.select import nearest_species
    from genespark.plans.annotate import species_pool
    tr = t.customer.where(F.col("c_custkey") % 3 == 0).select(F.concat(F.lit("sp"), "c_custkey").alias("species"))
    return nearest_species(species_pool(t), "sp7", "ORDER", 8, None, tr)


@query("W1_best_self_hit", ctes("fx_family_hits") + """
    select query_id as protein_id, arg_min(target_id, {'e': evalue, 't': target_id}) as paralog_id, min(evalue) as evalue
    from fx_family_hits group by 1""")
def best_self_hit(t: Tables):
    from genespark.operators.presence import best_self_hits
    own = t.part.select(F.concat(F.lit("P"), "p_partkey").alias("query_id")).withColumn("target_id", F.col("query_id")).withColumn(
        "evalue", F.lit(0.0))
    return best_self_hits(t.family_hits.unionByName(own).withColumn("bitscore", F.lit(50.0))).select("protein_id", "paralog_id", "evalue")


@query("W21_gap_blocks", ctes("fx_genes") + """
    , e as (select distinct short || contig as region, protein_id || family as id, g_start as s, g_start + g_len as e from fx_genes
            where g_start % 9 <> 0),
    r as (select *, max(e) over (partition by region order by s, id rows between unbounded preceding and 1 preceding) as reach from e),
    b as (select *, sum(case when s - reach > 9000 then 1 else 0 end) over (partition by region order by s, id) as block from r)
    select region, id, s as start, e as end, cast(block as bigint) as block from b""")
def gap_blocks(t: Tables):
    from genespark.operators.pangenome import gap_blocks as op
    e = t.genes.select(F.concat("short", "contig").alias("region"), F.concat("protein_id", "family").alias("id"),
                       (F.col("g_start") % 9 != 0).cast("int").alias("is_gene"), F.col("g_start").alias("start"),
                       (F.col("g_start") + F.col("g_len")).alias("end")).distinct()
    out = op(e, 9000)
    return out.join(e.where("is_gene = 1").select("region", "id", "start", "end"), ["region", "id", "start", "end"], "left_semi").select(
        "region", "id", "start", "end", "block")
