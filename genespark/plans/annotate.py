"""Annotation, matching and selection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from genespark.functions import exprs as EX
from genespark.functions import ids as ID
from genespark.operators import annotate as A
from genespark.operators import presence as P
from genespark.operators import select as S
from genespark.plans.families import CAND, cands, fam_base
from genespark.plans.presence import base, cells, judged, others
from genespark.plans.registry import query
from genespark.plans.views import Tables, ctes

pid = lambda: F.concat(F.lit("P"), "p_partkey")
src = lambda: F.concat(F.lit("N"), F.col("p_partkey") % 25)


def model(t: Tables):
    return t.part.where(F.col("p_partkey") % 5 == 0).select(
        src().alias("source_proteome"), pid().alias("protein_id"), F.col("p_brand").alias("gene_name"),
        F.when(F.col("p_partkey") % 10 == 0, F.col("p_name")).otherwise("").alias("product"))


def protein_domains(t: Tables):
    two = F.array(F.struct(F.lit(2).alias("hit_order"), F.concat(F.lit("D"), "p_size").alias("domain")),
                  F.struct(F.lit(1).alias("hit_order"), F.concat(F.lit("D"), F.col("p_size") % 7).alias("domain")))
    return t.part.where(F.col("p_partkey") % 3 == 0).select(pid().alias("protein_id"), F.explode(two).alias("x")).select(
        "protein_id", "x.hit_order", "x.domain")


def best_hit(t: Tables):
    return t.part.where(F.col("p_partkey") % 2 == 0).select(pid().alias("protein_id"), F.col("p_type").alias("hit"))


def annotated(t: Tables):
    prot = t.part.select(src().alias("source_proteome"), pid().alias("protein_id"))
    return A.annotate(prot, model(t), protein_domains(t), best_hit(t))


ANN = """select concat('N', k % 25) as source_proteome, concat('P', k) as protein_id, gn as gene_name,
    case when mp <> '' then mp when pf <> '' then pf else sw end as product_description,
    case when mp <> '' then concat('ModelOrg_N', k % 25) when pf <> '' then 'Pfam' when sw <> '' then 'SwissProt'
         when gn <> '' then concat('ModelOrg_N', k % 25) else '' end as function_source, sw as best_swissprot, pf as pfam_names
    from (select p_partkey as k, case when p_partkey % 5 = 0 then p_brand else '' end as gn,
      case when p_partkey % 10 = 0 then p_name else '' end as mp,
      case when p_partkey % 3 = 0 then concat('D', p_size % 7, ',D', p_size) else '' end as pf,
      case when p_partkey % 2 = 0 then p_type else '' end as sw from part)"""


@query("J3_annotation_priority", ANN)
def annotation(t: Tables):
    return annotated(t)


@query("J4_cross_references", f"with ann as ({ANN}) " + """
    select a.source_proteome, a.protein_id, x.p_type as uniprot from ann a
    left join part x on concat('P', x.p_partkey) = a.protein_id and concat('N', x.p_size % 25) = a.source_proteome""")
def cross_references(t: Tables):
    x = t.part.select(F.concat(F.lit("N"), F.col("p_size") % 25).alias("source_proteome"), pid().alias("protein_id"),
                      F.col("p_type").alias("uniprot"))
    return A.add_xrefs(annotated(t).select("source_proteome", "protein_id"), x)


@query("J2_member_hits", ctes("fx_members", "fx_genome_hits") + """
    select member, short, min(evalue) as best_evalue, count(*) as n from fx_genome_hits join fx_members using (family)
    where evalue <= 1e-5 group by 1, 2""")
def member_hits(t: Tables):
    h = t.genome_hits.where(F.col("evalue") <= 1e-5).select("family", "short", "evalue")
    return A.member_hits(h, t.members)


RECS = """, rec as (select concat('A', c_custkey) as accession, c_custkey % 50 as md5, c_nationkey as tax,
      case when c_custkey % 3 = 0 then '1' else '0' end as reviewed from customer where c_custkey % 4 <> 1),
    rs as (select concat('RS', c_custkey % 900) as refseq, concat('A', c_custkey) as accession from customer),
    pr as (select case p_partkey % 4 when 0 then concat('A', p_partkey) when 1 then concat('RS', p_partkey)
             else concat('X', p_partkey) end as protein_id,
             case when p_partkey % 4 = 0 then concat('A', p_partkey) end as accession, p_size + p_partkey % 3 as md5,
             p_partkey % 25 as tax from part),
    i as (select protein_id, accession, 'id' as match, 1 as n_candidates from pr where accession in (select accession from rec)),
    r as (select protein_id, min(rs.accession) as accession, 'refseq' as match, count(*) as n_candidates
          from pr join rs on refseq = protein_id where protein_id not in (select protein_id from i) group by 1),
    r2 as (select * from r where accession in (select accession from rec)),
    s as (select protein_id, arg_min({'a': rec.accession, 'o': rec.tax = pr.tax},
             {'o': rec.tax <> pr.tax, 'u': reviewed <> '1', 'a': rec.accession}) as b, count(*) as n_candidates
          from pr join rec using (md5) where protein_id not in (select protein_id from i union select protein_id from r2)
          group by 1),
    f as (select * from i union all select * from r2 union all
          select protein_id, b.a, case when b.o then 'seq_own' else 'seq_other' end, n_candidates from s)"""


@query("J5_record_match", "with z as (select 1)" + RECS + """
    select pr.protein_id, f.accession, coalesce(match, 'none') as match, coalesce(n_candidates, 0) as n_candidates
    from pr left join f using (protein_id)""")
def record_match(t: Tables):
    k = F.col("p_partkey")
    prot = t.part.select(
        F.when(k % 4 == 0, F.concat(F.lit("A"), k)).when(k % 4 == 1, F.concat(F.lit("RS"), k)).otherwise(
            F.concat(F.lit("X"), k)).alias("protein_id"), F.when(k % 4 == 0, F.concat(F.lit("A"), k)).alias("accession"),
        (F.col("p_size") + k % 3).alias("seq_md5"), (k % 25).cast("int").alias("taxon_id"))
    c = F.col("c_custkey")
    rec = t.customer.where(c % 4 != 1).select(
        F.concat(F.lit("A"), c).alias("accession"), (c % 50).alias("seq_md5"), F.col("c_nationkey").alias("taxon_id"),
        F.when(c % 3 == 0, "1").otherwise("0").alias("reviewed"))
    rs = t.customer.select(F.concat(F.lit("RS"), c % 900).alias("refseq"), F.concat(F.lit("A"), c).alias("accession"))
    return A.match_records(prot, rec, rs)


@query("J6_model_key", """select concat('N', k % 25) as source_proteome, id as protein_id,
    case k % 3 when 0 then b when 1 then regexp_replace(b, '-t\\d+_\\d+-p\\d+$', '') else concat('G', k) end as gene_key
    from (select p_partkey as k, concat('P', p_partkey, '-t26_1-p1') as b,
      concat('N', p_partkey % 25, '__P', p_partkey, '-t26_1-p1') as id from part)""")
def model_key(t: Tables):
    k = F.col("p_partkey")
    prot = t.part.select(
        src().alias("source_proteome"), F.concat(src(), F.lit("__"), pid(), F.lit("-t26_1-p1")).alias("protein_id"),
        F.when(k % 3 == 0, "direct").when(k % 3 == 1, "strip").otherwise("hit").alias("mode"))
    hits = t.part.select(F.concat(src(), F.lit("__"), pid(), F.lit("-t26_1-p1")).alias("protein_id"), F.explode(F.array(
        F.struct(F.lit(1).alias("hit_order"), F.concat(F.lit("G"), k).alias("key")),
        F.struct(F.lit(2).alias("hit_order"), F.lit("G0").alias("key")))).alias("x")).select("protein_id", "x.hit_order", "x.key")
    return A.model_key(prot, hits)


@query("J7_position_fallback", ctes("fx_genes") + """
    , g as (select short, protein_id, min(contig) as contig, min(g_start) as s, min(g_start + g_len) as e from fx_genes group by 1, 2),
    x as (select *, cast(substr(short, 2) as int) % 3 as k, s % 10 as d from g),
    f1 as (select * from x where k <> 1 or d < 3), f2 as (select * from x where k <> 0 or d < 1),
    n as (select short, count(*) as n from x group by 1),
    c as (select n.short, n, (select count(*) from f1 where f1.short = n.short) as k1,
             (select count(*) from f2 where f2.short = n.short) as k2 from n)
    select short, round(case when k1 / n < 0.5 and k2 > k1 then k2 else k1 end / n, 4) as matched,
      case when case when k1 / n < 0.5 and k2 > k1 then k2 else k1 end / n < 0.5 then 'abort'
           when 1 - case when k1 / n < 0.5 and k2 > k1 then k2 else k1 end / n > 0.02 then 'warn' else 'ok' end as status
    from c""")
def position_fallback(t: Tables):
    g = t.genes.groupBy("short", "protein_id").agg(
        F.min("contig").alias("contig"), F.min("g_start").alias("start"), F.min(F.col("g_start") + F.col("g_len")).alias("end"))
    k, d = F.substring("short", 2, 9).cast("int") % 3, F.col("start") % 10
    prot = g.select("short", "protein_id", F.concat(F.lit("L"), "protein_id").alias("gene_name"))
    by_locus = g.where((k != 0) | (d < 1)).select("short", F.concat(F.lit("L"), "protein_id").alias("locus_tag"), "contig",
                                                "start", "end")
    return A.position_status(A.position_choice(prot, g.where((k != 1) | (d < 3)), by_locus))


@query("P21_position_lookup", ctes("fx_genes") + """
    , g as (select concat(protein_id, '_', short, '_', family) as id, contig, min(g_start) as s from fx_genes
            where g_start % 5 <> 0 group by 1, 2)
    select distinct concat(f.protein_id, '_', f.short, '_', f.family, '-T1-p1') as protein_id, g.contig, g.s as start
    from fx_genes f left join g on g.id = concat(f.protein_id, '_', f.short, '_', f.family)""")
def position_lookup(t: Tables):
    name = F.concat_ws("_", "protein_id", "short", "family")
    index = t.genes.where(F.col("g_start") % 5 != 0).groupBy(name.alias("id"), "contig").agg(F.min("g_start").alias("start"))
    return A.lookup_position(t.genes.select(F.concat(name, F.lit("-T1-p1")).alias("protein_id")).distinct(), index)


@query("J17_support", fam_base() + """
    , b as (select concat('P', p_partkey) as protein_id from part where p_partkey % 3 = 0)
    select protein_id, case when c is not null and b.k is not null then 'pairwise+profile' when c is not null then 'pairwise'
      else 'profile' end as support
    from (select distinct protein_id, 1 as c from cand) full join (select protein_id, 1 as k from b) b using (protein_id)""")
def support(t: Tables):
    return A.support(cands(t), t.part.where(F.col("p_partkey") % 3 == 0).select(pid().alias("protein_id")))


def novel_rows(t: Tables):
    j = judged(t)
    c = P.presence_cells(j)
    novel = P.candidates(c, P.banded(t.samples), "IN", 0.2, 0.5)
    sup = A.support(novel, t.part.where(F.col("p_partkey") % 3 == 0).select(pid().alias("protein_id")))
    return A.novelty_rows(novel, c, [f"N{i}" for i in range(25)], P.other_evidence(j, others(t)), t.members, sup, annotated(t))


@query("J25_novelty_rows", fam_base() + f", ann as ({ANN})" + """
    , ps as (select c.source_proteome, c.protein_id, """ + " || ".join(
    f"max(case when proteome = 'N{i}' then '1' else '0' end)" for i in range(25)) + """ as presence, count(*) as n_present
      from cells c join cand using (source_proteome, protein_id) group by 1, 2),
    ev as (select query_proteome, query_id, max(qcov) as q, count(distinct target_proteome) as n from judged
           join fx_samples on short = target_proteome and grp = 'OUT' group by 1, 2)
    select p.source_proteome, p.protein_id, presence, n_present, q as other_max_qcov, coalesce(n, 0) as n_other_cells, m.family,
      case when cast(substr(p.protein_id, 2) as int) % 3 = 0 then 'pairwise+profile' else 'pairwise' end as support,
      product_description, function_source
    from ps p left join ev on query_proteome = p.source_proteome and query_id = p.protein_id
    left join fx_members m on m.member = p.protein_id
    left join ann on ann.source_proteome = p.source_proteome and ann.protein_id = p.protein_id""")
def novelty_rows(t: Tables):
    return novel_rows(t)


@query("F11_top_novelties", fam_base() + """
    select source_proteome, protein_id, n_in from counts join cand using (source_proteome, protein_id)
    order by n_in desc, source_proteome, protein_id limit 20""")
def top_novelties(t: Tables):
    c = P.candidates(cells(t), P.banded(t.samples), "IN", 0.2, 0.5)
    return S.top_by(c.select("source_proteome", "protein_id", "n_in"), [F.desc("n_in"), "source_proteome", "protein_id"], 20)


@query("J18_nearest_species", """
    with l as (select concat('sp', c_custkey) as species, c_custkey as k, c_nationkey % 3 as a, c_nationkey % 6 as b, c_nationkey as c,
      c_custkey % 40 as d from customer), f as (select * from l where k = 7)
    select species, case when l.d = f.d and l.c = f.c then 'GENUS' when l.c = f.c then 'ORDER' end as rank_name,
       case when l.d = f.d and l.c = f.c then 7 when l.c = f.c then 5 end as depth
    from l, (select a as fa, b as fb, c, d from f) f where k <> 7 and l.a = fa and l.b = fb and l.c = f.c and k % 11 <> 0
    order by 3 desc, 1 limit 12""")
def nearest(t: Tables):
    return S.nearest_species(species_pool(t), "sp7", "ORDER", 12, t.customer.where(F.col("c_custkey") % 11 == 0).select(
        F.concat(F.lit("sp"), "c_custkey").alias("species")))


def species_pool(t: Tables):
    n, k = F.col("c_nationkey"), F.col("c_custkey")
    s = lambda p, x: F.concat(F.lit(p), x.cast("string"))
    return t.customer.select(s("sp", k).alias("species"), F.array(
        s("p", n % 3), F.lit(""), s("c", n % 6), F.lit(""), s("o", n), F.lit(""), s("g", k % 40)).alias("lineage"))


@query("F13_target_study", """
    with l as (select concat('sp', c_custkey) as species, c_custkey as k, c_nationkey as c, c_custkey % 40 as d from customer),
    o as (select * from l where k % 97 = 5),
    n as (select l.species from l, (select c, d from l where k = 7) f where k <> 7 and l.c = f.c and k % 97 <> 5
          order by case when l.d = f.d then 7 else 5 end desc, species limit 5)
    select species, 'IN' as grp from n union all select 'sp7', 'IN' union all select species, 'OUT' from o""")
def target_study(t: Tables):
    out = t.customer.where(F.col("c_custkey") % 97 == 5).select(F.concat(F.lit("sp"), "c_custkey").alias("species"))
    return S.target_study(species_pool(t), "sp7", 5, out)


@query("F3_sample_selection", """
    with s as (select concat('S', c_custkey) as short, c_nationkey % 3 as a, c_nationkey as b from customer),
    o as (select short, concat('o', b) as taxon, row_number() over (partition by b order by short) as r from s where a = 1 and b <> 4)
    select short, 'IN' as grp, 'o4' as taxon from s where b = 4
    union all select short, 'OUT', taxon from o where r <= 3 and taxon <> 'o7'""")
def sample_selection(t: Tables):
    n = F.col("c_nationkey")
    s = t.customer.select(F.concat(F.lit("S"), "c_custkey").alias("short"), F.array(
        F.concat(F.lit("p"), n % 3), F.concat(F.lit("o"), n), F.concat(F.lit("g"), "c_custkey")).alias("lineage"))
    return S.select_samples(s, "o4", None, ("o7",), 3)


@query("F6_short_names", """
    select species, case when k = 1 then base else substr(base, 1, 8 - length(cast(k as varchar))) || k end as short from (
      select species, base, row_number() over (partition by base order by species) as k from (
        select distinct species, upper(g[1]) || lower(substr(g, 2)) || e as base from (
          select c_mktsegment || ' ' || x || ' ' || c_name as species, substr(c_mktsegment, 1, 4) as g, substr(x, 1, 4) as e
          from (select *, ['alba', 'nigra', 'rubra'][c_custkey % 3 + 1] as x from customer))))""")
def short_names(t: Tables):
    sp = t.customer.select(F.concat(F.col("c_mktsegment"), F.lit(" "), F.element_at(F.array(
        F.lit("alba"), F.lit("nigra"), F.lit("rubra")), (F.col("c_custkey") % 3 + 1).cast("int")), F.lit(" "), "c_name").alias("species"))
    return S.short_names(sp)


@query("F10_longest_isoforms", """
    select concat('G', c_nationkey) as gene_id, arg_min(concat('P', c_custkey), {'l': -length(c_name || c_mktsegment),
      'p': concat('P', c_custkey)}) as protein_id, max(length(c_name || c_mktsegment)) as length
    from customer where c_custkey % 5 <> 0 group by 1""")
def longest_isoforms(t: Tables):
    p = t.customer.select(F.concat(F.lit("P"), "c_custkey").alias("protein_id"), F.length(
        F.concat("c_name", "c_mktsegment")).cast("bigint").alias("length"))
    g = t.customer.where(F.col("c_custkey") % 5 != 0).select(
        F.concat(F.lit("P"), "c_custkey").alias("protein_id"), F.concat(F.lit("G"), "c_nationkey").alias("gene_id"))
    return S.longest_isoforms(p, g)


@query("P14_prefixed_ids", ctes("fx_genes") + """
    select distinct short || '|' || protein_id || '|x' as member, short, protein_id || '|x' as rest from fx_genes""")
def prefixed_ids(t: Tables):
    m = t.genes.select(ID.prefixed(F.col("short"), F.concat("protein_id", F.lit("|x"))).alias("member")).distinct()
    return m.select("member", ID.prefix_of(F.col("member")).alias("short"), ID.rest_of(F.col("member")).alias("rest"))


@query("P15_collapsed_ids", """
    select concat('F', k % 20) as family, case k % 4 when 0 then concat('sp|A', k, '|N') when 1 then concat('gi|1|gb|B', k, '|')
      when 2 then concat('gnl|db|C', k) else concat('plain', k) end as member from (select p_partkey as k from part)""")
def collapsed_ids(t: Tables):
    k = F.col("p_partkey")
    s = lambda a, b="": F.concat(F.lit(a), k.cast("string"), F.lit(b))
    full = F.when(k % 4 == 0, s("sp|A", "|N")).when(k % 4 == 1, s("gi|1|gb|B", "|")).when(k % 4 == 2, s("gnl|db|C")).otherwise(
        s("plain"))
    h = t.part.select(full.alias("id"), F.concat(F.lit("F"), k % 20).alias("family"))
    c = h.select("family", ID.collapsed_id(F.col("id")).alias("member"))
    return A.restore_ids(c, h.select("id"), ID.collapsed_id(F.col("id")))


@query("P16_descriptions", """select concat('P', p_partkey) as id, p_brand as gene_name, p_name as description from part
    """.replace("p_brand as", "replace(p_brand, ' ', '') as"))
def descriptions(t: Tables):
    h = F.concat(pid(), F.lit(" "), F.col("p_name"), F.lit(" OS=Some fungus GN="), F.regexp_replace("p_brand", " ", ""), F.lit(" PE=1"))
    return A.descriptions(t.part.select(pid().alias("id"), h.alias("header")))


NAMES = "['HET', 'NACHT', 'Ank_2', 'MFS_1', 'ketoacyl-synt', 'Kinase', 'none', 'ABC_tran', 'ethet']"


@query("P17_domain_classes", f"""
    with d as (select concat('F', p_partkey % 200) as family, {NAMES}[p_size % 9 + 1] as n from part),
    c as (select family, case when lower(n) = 'none' then 'unannotated' when lower(n) like 'het%' or lower(n) like '%nacht%'
        or lower(n) like '%ank%' then 'nlr' when lower(n) like '%ketoacyl-synt%' then 'secondary_metabolite'
        when lower(n) like '%mfs\\_%' escape '\\' or lower(n) like '%abc\\_tran%' escape '\\' then 'transporter' else 'other' end as cls from d),
    k as (select family, cls, count(*) as n from c group by 1, 2)
    select family, arg_min(cls, {{'r': case when cls in ('other', 'unannotated') then 1 else 0 end, 'n': -n,
      'o': list_position(['nlr', 'secondary_metabolite', 'transporter', 'other', 'unannotated'], cls)}}) as dominant_class
    from k group by 1""")
def domain_classes(t: Tables):
    names = F.array(*[F.lit(x.strip(" '")) for x in NAMES.strip("[]").split(",")])
    d = t.part.select(F.concat(F.lit("F"), F.col("p_partkey") % 200).alias("family"),
                      F.element_at(names, (F.col("p_size") % 9 + 1).cast("int")).alias("domain"))
    return A.dominant_class(d)


@query("P18_terminus", ctes("fx_genes") + """
    , l as (select short, contig, max(g_start + g_len) as n from fx_genes group by 1, 2)
    select short, count(*) filter (where g_start <= 50000 or n - (g_start + g_len) <= 50000) as n_terminal
    from fx_genes join l using (short, contig) group by 1""")
def terminus(t: Tables):
    from genespark.plans.pangenome import contigs, genes
    g = genes(t).join(contigs(t), ["short", "contig"])
    return g.groupBy("short").agg(EX.count_if(EX.at_terminus(F.col("start"), F.col("end"), F.col("length"), 50000)).alias("n_terminal"))


@query("P19_signal_class", ctes("fx_hits") + """
    select query_id, case when q is null then '' when q >= 95 then 'broad' else 'domain_only' end as signal from (
      select query_id, max(case when qcov % 7 = 0 then qcov end) as q from fx_hits group by 1)""")
def signal_class(t: Tables):
    h = t.hits.groupBy("query_id").agg(F.max(F.when(F.col("qcov") % 7 == 0, F.col("qcov"))).alias("q"))
    return h.select("query_id", EX.signal_class(F.col("q"), F.lit(True), 95).alias("signal"))


@query("A35_module_domains", ctes("fx_domains") + """
    , m as (select cast(substr(family, 2) as int) % 12 as module_id, family, domain from fx_domains),
    k as (select module_id, domain, count(*) as k, row_number() over (partition by module_id order by count(*) desc, domain) as r
          from m group by 1, 2)
    select module_id, (select count(distinct family) from m where m.module_id = k.module_id) as n_families_with_domain,
      string_agg(domain || '(' || k || ')', ',' order by r) as top_domains from k where r <= 15 group by 1""")
def module_domains(t: Tables):
    mods = t.domains.select("family", (F.substring("family", 2, 9).cast("int") % 12).alias("module_id")).distinct()
    return A.module_domains(mods, t.domains)


@query("J21_domain_go", """
    with d as (select distinct concat('PF', p_size, '.3') as domain_accession from part),
    g as (select distinct concat('PF', p_size) as accession, concat('GO:', p_partkey % 4) as go_id from part where p_size % 3 <> 0)
    select domain_accession, coalesce(string_agg(go_id, ',' order by go_id), '') as go_ids from d
    left join g on accession = split_part(domain_accession, '.', 1) group by 1""")
def domain_go(t: Tables):
    from genespark.sources.text import pfam2go
    d = t.part.select(F.concat(F.lit("PF"), "p_size", F.lit(".3")).alias("domain_accession")).distinct()
    text = t.part.where(F.col("p_size") % 3 != 0).select(F.concat(
        F.lit("Pfam:PF"), "p_size", F.lit(" Dom > GO:x ; GO:"), F.col("p_partkey") % 4).alias("value"))
    return A.add_go(d, pfam2go(text))


@query("A45_report_counts", fam_base() + f", ann as ({ANN})" + """
    select 'novelty_per_species' as what, source_proteome as label, count(*) as n from cand group by 2
    union all select 'annotation_source', function_source, count(*) from ann group by 2
    union all select 'family_size', cast(size as varchar), count(*) from (select count(*) as size from fx_members group by family) group by 2""")
def report_counts(t: Tables):
    from genespark.operators.families import sized
    from genespark.operators.report import label_counts
    return (label_counts(cands(t), "source_proteome", "novelty_per_species")
            .unionByName(label_counts(annotated(t), "function_source", "annotation_source"))
            .unionByName(label_counts(sized(t.members), "size", "family_size")))
