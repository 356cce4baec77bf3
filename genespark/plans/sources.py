"""Format queries: text derived from the tables is parsed back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from genespark.plans.registry import query
from genespark.plans.views import Tables, ctes
from genespark.sources import tables as TB
from genespark.sources import text as TX
from genespark.sources import uniprot as UP


def tab(*cols):
    return F.concat_ws("\t", *[c if not isinstance(c, str) else F.col(c).cast("string") for c in cols])


def as_lines(df, *cols, sep="\t"):
    return df.select(F.concat_ws(sep, *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]).alias("value"))


@query("S2_tabular_hits", ctes("fx_hits") + """
    select query_id, target_id, evalue, bitscore, case when k = 1 then qcov::double end as qcov,
           case when k = 1 then 300 end as length from (select *, substr(query_id, 2)::bigint % 2 as k from fx_hits)""")
def tabular_hits(t: Tables):
    h = t.hits
    odd = F.substring("query_id", 2, 20).cast("bigint") % 2 == 1
    narrow = as_lines(h.where(~odd), "query_id", "target_id", "evalue", "bitscore")
    wide = as_lines(h.where(odd), "query_id", "target_id", "evalue", "bitscore", F.lit(300), F.lit(88.5), "qcov",
                    F.lit(50), F.lit(310), F.lit(290))
    return TX.tabular_hits(narrow.unionByName(wide)).select(
        "query_id", "target_id", "evalue", "bitscore", "qcov", "length")


@query("S3_search_table", ctes("fx_hits") + "select query_id, target_id, evalue, bitscore from fx_hits")
def search_table(t: Tables):
    return TX.table_hits(as_lines(t.hits, "target_id", F.lit("-"), "query_id", F.lit("-"), "evalue", "bitscore", F.lit("0.1"),
                                  sep="   "))


@query("S5_proteome_of_file", ctes("fx_hits") + "select distinct target_proteome as proteome from fx_hits")
def proteome_of_file(t: Tables):
    name = F.concat("query_proteome", F.lit("_vs_"), "target_proteome", F.lit(".tsv.gz"))
    return t.hits.select(TX.proteome_of_file(name).alias("proteome")).distinct()


@query("S6_domain_table", ctes("fx_domain_hits") + """
    select target, query, qlen, full_evalue, i_evalue, hmm_from, hmm_to from fx_domain_hits""")
def domain_table(t: Tables):
    d = F.lit("-")
    return TX.domain_table(as_lines(
        t.domain_hits, "target", d, d, "query", d, "qlen", "full_evalue", d, d, d, d, d, "i_evalue", d, d, "hmm_from",
        "hmm_to", d, sep="  "))


@query("S8_genome_hits", ctes("fx_genome_hits") + """
    select family, short, contig, pident::double as pident, sstart, send, bitscore, qcovs::double as qcovs
    from fx_genome_hits""")
def genome_hits(t: Tables):
    z = F.lit(0)
    return TX.genome_hits(as_lines(
        t.genome_hits, "family", F.concat_ws("|", "short", "contig"), "pident", z, z, z, z, z, "sstart", "send", "evalue",
        "bitscore", "qcovs"))


@query("S9_cluster_table", ctes("fx_members") + "select family, member from fx_members")
def cluster_table(t: Tables):
    return TX.clusters(as_lines(t.members, "family", "member"))


@query("S10_fasta", """select concat('doc', doc_id) as id, length(regexp_replace(text, '\\s', '', 'g')) as length,
    md5(regexp_replace(text, '\\s', '', 'g')) as digest from documents where not contains(text, chr(10) || '>')""")
def fasta(t: Tables):
    rec = t.documents.where(~F.col("text").contains("\n>")).select(
        F.concat(F.lit(">doc"), "doc_id", F.lit(" "), "lang", F.lit("\n"), "text").alias("value"))
    return TX.fasta(rec).select("id", "length", F.md5(F.col("sequence").cast("binary")).alias("digest"))


GFF = ("select concat(protein_id, '_', substr(family, 2)) as pid, short, contig, g_start + 1 as s, g_start + g_len + 1 as e "
       "from fx_genes")


def gff_rows(t: Tables):
    return t.genes.select(
        F.concat_ws("_", "protein_id", F.substring("family", 2, 9)).alias("pid"), F.col("short").alias("file"), "contig",
        (F.col("g_start") + 1).alias("s"), (F.col("g_start") + F.col("g_len") + 1).alias("e"))


def gff_lines(t: Tables, attrs, kind="CDS"):
    rows = gff_rows(t)
    d = F.lit(".")
    first = rows.select("file", tab("contig", d, F.lit(kind), "s", (F.col("s") + 50), d, F.lit("+"), d, attrs).alias("value"))
    second = rows.select("file", tab("contig", d, F.lit(kind), (F.col("e") - 90), "e", d, F.lit("+"), d, attrs).alias("value"))
    return first.unionByName(second)


SPANS = ctes("fx_genes", g=GFF) + "select short as file, pid as {out}, min(contig) as contig, min(s) as start, max(e) as \"end\" from g group by 1, 2"


@query("S11_protein_positions", SPANS.format(out="protein_id"))
def protein_positions(t: Tables):
    attrs = F.when(F.col("s") % 2 == 0, F.concat(F.lit("ID=x;protein_id="), "pid")).otherwise(
        F.concat(F.lit("ID=x;Parent="), "pid"))
    return TX.protein_positions(gff_lines(t, attrs))


@query("S12_locus_positions", SPANS.format(out="locus_tag"))
def locus_positions(t: Tables):
    return TX.locus_positions(gff_lines(t, F.concat(F.lit("ID=y;locus_tag="), "pid", F.lit(";note=a"))))


@query("S13_gene_index", ctes("fx_genes", g=GFF) + """
    select short as file, pid as id, arg_min(contig, {'c': contig, 's': s}) as contig,
           min({'c': contig, 's': s}).s as start from g group by 1, 2""")
def gene_index(t: Tables):
    rows = gff_rows(t)
    d = F.lit(".")
    line = lambda kind, s: rows.select("file", tab("contig", d, F.lit(kind), s, "e", d, F.lit("+"), d, F.concat(
        F.lit("Name=n;ID="), "pid")).alias("value"))
    return TX.gene_index(line("gene", F.col("s").cast("string")).unionByName(line("mRNA", F.lit("1"))))


@query("S14_wide_matrix", ctes("fx_presence") + """
    select family, short, 'present' as state, copies from fx_presence""")
def wide_matrix(t: Tables):
    names = t.spark.range(t.strains.count()).select(F.col("id").cast("int").alias("i"), F.concat(F.lit("S"), "id").alias("short"))
    have = t.presence.select("family", "short").distinct()
    every = have.select("family").distinct().crossJoin(names).join(have.withColumn("state", F.lit("present")), ["family", "short"], "left")
    wide = every.groupBy("family").agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("state", F.lit("absent")).alias("s")))).alias("x"))
    wide = wide.select("family", F.transform("x", lambda x: x["s"]).alias("states"))
    some = t.genes.select("family").distinct()
    return TB.with_copies(TB.matrix_rows(wide, names, some), t.presence)


@query("S17_distances", ctes("fx_strains") + """
    , s as (select cast(substr(short, 2) as int) as i from fx_strains)
    select concat('S', a.i) as a, concat('S', b.i) as b,
      round(case when a.i = b.i then 0.0 else (abs(a.i - b.i) * 2 + 0.01) / 2 end, 6)::double as dist from s a cross join s b""")
def distances(t: Tables):
    i = F.substring("short", 2, 9).cast("int")
    base = t.strains.select("short", i.alias("i"))
    n = base.count()
    cell = lambda j: F.when(F.col("i") == j, 0.5).otherwise(F.abs(F.col("i") - j) + F.when(F.col("i") < j, 0.01).otherwise(0.0))
    cells = F.transform(F.slice(F.sequence(F.lit(0), F.lit(n)), 1, n), cell)
    wide = base.repartition(n // 64 + 1, "short").select(F.col("short").alias("name"), cells.alias("cells"))
    return TB.distance_rows(wide, [f"S{j}" for j in range(n)]).withColumn("dist", F.round("dist", 6))


REC = """concat('ID   ', n, '_X   ', case when k % 3 = 0 then 'Reviewed' else 'Unreviewed' end, ';', chr(10), 'AC   A', k, ';', chr(10),
 'DE   RecName: Full=Name ', k, ';', chr(10), 'OX   NCBI_TaxID=', k % 9, ';', chr(10), 'DR   RefSeq; RS', k, '.1; -.', chr(10),
 'DR   RefSeq; ZZ', k, '.1; -.', chr(10), 'DR   GO; GO:', 1000 + k, '; F:binding; IEA.', chr(10),
 'DR   Pfam; PF', k % 50, '; Dom', k % 50, '; 1.', chr(10), 'PE   ', k % 5, ': x;', chr(10), 'SQ   SEQUENCE', chr(10), '     ', s)"""


@query("S18_uniprot_records", """select concat('A', c_custkey) as accession,
    case when c_custkey % 3 = 0 then '1' else '0' end as reviewed, concat('Name ', c_custkey) as description,
    cast(c_custkey % 9 as varchar) as taxon_id, concat('RefSeq:RS', c_custkey, '.1') as xrefs,
    concat('GO:', 1000 + c_custkey, ':F') as go_ids, concat('PF', c_custkey % 50) as pfam_ids,
    concat('Dom', c_custkey % 50) as pfam_names, md5(upper(regexp_replace(c_mktsegment || c_custkey, '\\s', '', 'g'))) as seq_md5
    from customer""")
def uniprot_records(t: Tables):
    return uniprot(t).select("accession", "reviewed", "description", "taxon_id", "xrefs", "go_ids", "pfam_ids", "pfam_names",
                             "seq_md5")


def uniprot(t: Tables):
    text = REC.replace("chr(10)", "'\\n'")
    rec = t.customer.selectExpr("c_name as n", "c_custkey as k", "concat(c_mktsegment, c_custkey) as s").selectExpr(
        f"{text} as value")
    return UP.parse(rec)


@query("S29_refseq_lookup", "select concat('RS', c_custkey, '.1') as refseq, concat('A', c_custkey) as accession from customer")
def refseq_lookup(t: Tables):
    return UP.refseq_lookup(uniprot(t))


@query("S30_contig_slices", """select doc_id, substr(regexp_replace(text, '\\s', '', 'g'), 11, 30) as slice
    from documents where not contains(text, chr(10) || '>')""")
def contig_slices(t: Tables):
    rec = t.documents.where(~F.col("text").contains("\n>"))
    contigs = TX.fasta(rec.select(F.concat(F.lit(">doc"), "doc_id", F.lit("\n"), "text").alias("value")))
    want = rec.select("doc_id", F.concat(F.lit("doc"), "doc_id").alias("contig"), F.lit(11).alias("start"), F.lit(40).alias("end"))
    return TX.contig_slices(contigs, want).select("doc_id", "slice")


@query("S28_tree_closure", ctes("fx_strains") + """
    , k as (select cast(substr(short, 2) as bigint) + (select count(*) from fx_strains) as i from fx_strains),
    r as (with recursive w(tip, node) as (select i, i from k union all select tip, node // 2 from w where node > 1)
          select * from w)
    select concat('n', node) as node, concat('n', tip) as tip from r""")
def tree_closure(t: Tables):
    from genespark.plans.trees import edges
    return TB.closure(edges(t))
