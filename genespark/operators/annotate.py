"""Annotation joins, record matching and report rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genespark.functions.ids import CLASS_ORDER, domain_class, gene_of_protein
from genespark.operators.joins import split_join
from genespark.session import materialize


def expand_hits(hits: DataFrame, members: DataFrame) -> DataFrame:
    """A representative's hit given to every member of its family."""
    return split_join(hits, members, ["family"])


def member_hits(hits: DataFrame, members: DataFrame) -> DataFrame:
    """Best E-value and number of hits per (member, strain).

    Members of the same families (as often each) share their result. It is made once
    for each such list of families, and given to its members at the end: nothing
    is shuffled after that.
    """
    per = hits.groupBy("family", "short").agg(F.min("evalue").alias("best_evalue"), F.count(F.lit(1)).alias("n"))
    lists = materialize(members.where(F.col("family").isNotNull()).groupBy("member").agg(F.array_sort(F.collect_list("family")).alias("families")))
    kinds = lists.select("families").distinct().select("families", F.explode("families").alias("family"))
    found = expand_hits(per, kinds).groupBy("families", "short").agg(
        F.min("best_evalue").alias("best_evalue"), F.sum("n").cast("bigint").alias("n"))
    return split_join(found, lists, ["families"]).select("member", "short", "best_evalue", "n")


def annotate(
    proteins: DataFrame, model: DataFrame, domains: DataFrame, best: DataFrame
) -> DataFrame:
    """Product and its source by priority model organism, domains, best database hit.

    ``domains`` has one row per (protein_id, hit_order, domain): lists keep hit order.
    """
    lists = domains.groupBy("protein_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("hit_order", "domain"))), lambda s: s["domain"]), ",").alias("pfam_names"))
    m = model.select("source_proteome", "protein_id", "gene_name", F.col("product").alias("_mp"))
    out = proteins.join(m, ["source_proteome", "protein_id"], "left").join(lists, "protein_id", "left").join(
        best.select("protein_id", F.col("hit").alias("best_swissprot")), "protein_id", "left")
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    has = lambda c: blank(c) != ""
    product = F.when(has("_mp"), F.col("_mp")).when(has("pfam_names"), F.col("pfam_names")).otherwise(blank("best_swissprot"))
    source = (F.when(has("_mp"), F.concat(F.lit("ModelOrg_"), "source_proteome")).when(has("pfam_names"), "Pfam")
              .when(has("best_swissprot"), "SwissProt")
              .when(has("gene_name"), F.concat(F.lit("ModelOrg_"), "source_proteome")).otherwise(""))
    return out.select("source_proteome", "protein_id", blank("gene_name").alias("gene_name"),
                      product.alias("product_description"), source.alias("function_source"),
                      blank("best_swissprot").alias("best_swissprot"), blank("pfam_names").alias("pfam_names"))


def add_xrefs(proteins: DataFrame, xrefs: DataFrame) -> DataFrame:
    """Cross references by (proteome, protein); a protein id alone is not unique."""
    return proteins.join(xrefs, ["source_proteome", "protein_id"], "left")


def match_records(proteins: DataFrame, records: DataFrame, refseq: DataFrame) -> DataFrame:
    """Record per protein by id, then RefSeq, then sequence of the own species, then of another one.

    ``proteins`` has protein_id, accession (from the id, may be null), seq_md5, taxon_id. Ties: own
    species, reviewed, lowest accession; the number of candidates is kept.
    """
    acc = records.select("accession")
    by_id = proteins.where(F.col("accession").isNotNull()).join(acc, "accession", "left_semi").select(
        "protein_id", "accession", F.lit("id").alias("match"), F.lit(1).cast("bigint").alias("n_candidates"))
    rest = proteins.join(by_id.select("protein_id"), "protein_id", "left_anti")
    ref = refseq.groupBy(F.col("refseq").alias("protein_id")).agg(
        F.min("accession").alias("accession"), F.count(F.lit(1)).alias("n_candidates"))
    by_ref = rest.select("protein_id").join(ref, "protein_id").join(acc, "accession", "left_semi").select(
        "protein_id", "accession", F.lit("refseq").alias("match"), "n_candidates")
    rest = rest.join(by_ref.select("protein_id"), "protein_id", "left_anti")
    # records per (sequence, taxon) are first reduced, so a sequence shared by very many records stays small
    per = records.groupBy("seq_md5", F.col("taxon_id").alias("_tax")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct((F.col("reviewed") != "1").alias("u"), "accession")).alias("b"))
    tot = per.groupBy("seq_md5").agg(F.sum("n").alias("n_candidates"), F.min("b").alias("any"))
    own = per.select("seq_md5", F.col("_tax").alias("taxon_id"), F.col("b").alias("own"))
    by_seq = rest.join(tot, "seq_md5").join(own, ["seq_md5", "taxon_id"], "left").select(
        "protein_id", F.coalesce("own.accession", "any.accession").alias("accession"),
        F.when(F.col("own").isNotNull(), "seq_own").otherwise("seq_other").alias("match"), "n_candidates")
    found = by_id.unionByName(by_ref).unionByName(by_seq)
    return proteins.select("protein_id").join(found, "protein_id", "left").select(
        "protein_id", "accession", F.coalesce("match", F.lit("none")).alias("match"),
        F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"))


def model_key(proteins: DataFrame, hits: DataFrame, pattern: str = r"-t\d+_\d+-p\d+$") -> DataFrame:
    """Lookup key of a protein: itself, itself without a suffix pattern, or the key of its best hit."""
    bare = F.when(F.col("protein_id").startswith(F.concat(F.col("source_proteome"), F.lit("__"))),
                  F.expr("substring(protein_id, length(source_proteome) + 3)")).otherwise(F.col("protein_id"))
    best = hits.groupBy("protein_id").agg(F.min_by("key", F.struct("hit_order", "key")).alias("_hit"))
    rows = proteins.withColumn("_bare", bare).join(best, "protein_id", "left")
    key = (F.when(F.col("mode") == "direct", F.col("_bare"))
           .when(F.col("mode") == "strip", F.regexp_replace("_bare", pattern, "")).otherwise(F.col("_hit")))
    return rows.select("source_proteome", "protein_id", key.alias("gene_key"))


def _matches(proteins: DataFrame, by_id: DataFrame, by_locus: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Positions by protein id, and by gene name <-> locus tag; a name or tag that occurs twice is not used."""
    names = proteins.groupBy("short", F.col("gene_name").alias("locus_tag")).agg(
        F.min("protein_id").alias("protein_id"), F.count(F.lit(1)).alias("_k")).where(
        (F.col("_k") == 1) & (F.col("locus_tag") != ""))
    return proteins.join(by_id, ["short", "protein_id"]), names.join(by_locus, ["short", "locus_tag"])


def position_choice(
    proteins: DataFrame, by_id: DataFrame, by_locus: DataFrame, fallback_below: float = 0.5
) -> DataFrame:
    """Per strain whether locus tags are used, and the share of proteins placed; strains without a match stay, with 0."""
    first, second = _matches(proteins, by_id, by_locus)
    n = proteins.groupBy("short").agg(F.count(F.lit(1)).alias("n"))
    k1 = first.groupBy("short").agg(F.count(F.lit(1)).alias("k1"))
    k2 = second.groupBy("short").agg(F.count(F.lit(1)).alias("k2"))
    use = (F.col("k1") / F.col("n") < fallback_below) & (F.col("k2") > F.col("k1"))
    return n.join(k1, "short", "left").join(k2, "short", "left").fillna(0).select(
        "short", use.alias("use_locus"), (F.when(use, F.col("k2")).otherwise(F.col("k1")) / F.col("n")).alias("matched"))


def choose_positions(
    proteins: DataFrame, by_id: DataFrame, by_locus: DataFrame, fallback_below: float = 0.5
) -> DataFrame:
    """Positions by protein id, or by locus tag where ids match too rarely and tags match more."""
    first, second = _matches(proteins, by_id, by_locus)
    cols = ["short", "protein_id", "contig", "start", "end"]
    out = first.select(*cols, F.lit(False).alias("use_locus")).unionByName(
        second.select(*cols, F.lit(True).alias("use_locus")))
    return out.join(position_choice(proteins, by_id, by_locus, fallback_below), ["short", "use_locus"])


def position_status(choice: DataFrame, abort_below: float = 0.5, warn_above: float = 0.02) -> DataFrame:
    """Ok / warn / abort per strain from the share of placed proteins."""
    m = F.col("matched")
    return choice.select("short", F.round(m, 4).alias("matched"), F.when(m < abort_below, "abort").when(
        1 - m > warn_above, "warn").otherwise("ok").alias("status"))


def lookup_position(proteins: DataFrame, index: DataFrame) -> DataFrame:
    """Position by the id itself, else without protein suffix, else by gene id; first match wins."""
    ids = F.array(F.col("protein_id"), F.regexp_replace("protein_id", r"-p\d+$", ""), gene_of_protein(F.col("protein_id")))
    tries = proteins.select("protein_id", F.posexplode(ids).alias("t", "id"))
    best = tries.join(index.select("id", "contig", "start"), "id").groupBy("protein_id").agg(
        F.min(F.struct("t", "contig", "start")).alias("b"))
    return proteins.join(best, "protein_id", "left").select("protein_id", "b.contig", "b.start")


def support(primary: DataFrame, second: DataFrame, names: tuple[str, str] = ("pairwise", "profile")) -> DataFrame:
    """Which modes call a protein."""
    a = primary.select("protein_id", F.lit(names[0]).alias("_a")).distinct()
    b = second.select("protein_id", F.lit(names[1]).alias("_b")).distinct()
    return a.join(b, "protein_id", "full").select("protein_id", F.concat_ws("+", "_a", "_b").alias("support"))


def descriptions(headers: DataFrame) -> DataFrame:
    """Gene name and description of a header; the smallest header wins for a repeated id."""
    rest = F.regexp_replace("header", r"^\S+\s*", "")
    one = headers.groupBy("id").agg(F.min("header").alias("header"))
    return one.select("id", F.regexp_extract(rest, r"\bGN=(\S+)", 1).alias("gene_name"),
                      F.trim(F.regexp_replace(rest, r"\s*\bOS=.*$", "")).alias("description"))


def restore_ids(clusters: DataFrame, headers: DataFrame, collapsed: Column) -> DataFrame:
    """Cluster members back to full ids; a collapsed id of two headers is an error."""
    m = headers.select(F.col("id").alias("full_id"), collapsed.alias("member"))
    one = m.groupBy("member").agg(F.min("full_id").alias("full_id"), F.countDistinct("full_id").alias("_n"))
    full = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("two headers collapse to "), F.col("member"))).cast("string")
                  ).otherwise(F.col("full_id"))
    return clusters.join(one, "member", "left").select("family", F.coalesce(full, F.col("member")).alias("member"))


def dominant_class(domains: DataFrame) -> DataFrame:
    """Most frequent real class per family (ties by precedence); other / unannotated only without a real one."""
    c = domains.withColumn("cls", domain_class(F.col("domain"))).groupBy("family", "cls").agg(F.count(F.lit(1)).alias("n"))
    rank = F.lit(len(CLASS_ORDER))
    for i, name in enumerate(CLASS_ORDER):
        rank = F.when(F.col("cls") == name, i).otherwise(rank)
    real = F.when(F.col("cls").isin("other", "unannotated"), 1).otherwise(0)
    return c.groupBy("family").agg(F.min_by("cls", F.struct(real, -F.col("n"), rank)).alias("dominant_class"))


def module_domains(modules: DataFrame, domains: DataFrame, top: int = 15) -> DataFrame:
    """Per module, families with a domain and its most frequent domains as ``name(count)``."""
    d = modules.join(domains.select("family", "domain").distinct(), "family")
    n = d.groupBy("module_id").agg(F.countDistinct("family").alias("n_families_with_domain"))
    c = d.groupBy("module_id", "domain").agg(F.count(F.lit(1)).alias("k"))
    w = Window.partitionBy("module_id").orderBy(F.desc("k"), "domain")
    best = c.withColumn("r", F.row_number().over(w)).where(F.col("r") <= top).groupBy("module_id").agg(F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("r", "domain", "k"))),
                    lambda s: F.concat(s["domain"], F.lit("("), s["k"].cast("string"), F.lit(")"))), ",").alias("top_domains"))
    return n.join(best, "module_id")


def add_go(rows: DataFrame, pfam2go: DataFrame) -> DataFrame:
    """GO ids of a domain, by its accession without version."""
    go = pfam2go.groupBy("accession").agg(F.array_join(F.array_sort(F.collect_set("go_id")), ",").alias("go_ids"))
    return rows.withColumn("accession", F.substring_index("domain_accession", ".", 1)).join(go, "accession", "left").drop(
        "accession").fillna("", ["go_ids"])


def presence_string(cells: DataFrame, genomes: list[str]) -> DataFrame:
    """One character per genome, in genome order; a protein has at most one cell per genome."""
    place = cells.sparkSession.createDataFrame(list(zip(genomes, range(len(genomes)), strict=True)), "proteome string, _i int")
    have = cells.join(place, "proteome", "left").groupBy("source_proteome", "protein_id").agg(
        F.array_sort(F.collect_set("_i")).alias("_p"), F.countDistinct("proteome").alias("n_present"))
    gaps = F.zip_with(F.concat("_p", F.array(F.lit(len(genomes)))), F.concat(F.array(F.lit(-1)), "_p"), lambda a, b: F.repeat(F.lit("0"), a - b - 1))
    return have.select("source_proteome", "protein_id", F.array_join(gaps, "1").alias("presence"), "n_present")


def novelty_rows(
    novel: DataFrame, cells: DataFrame, genomes: list[str], evidence: DataFrame, members: DataFrame, supports: DataFrame,
    annotation: DataFrame,
) -> DataFrame:
    """One report row per novel protein: presence string, evidence maximum, family, support, annotation."""
    key = ["source_proteome", "protein_id"]
    own = cells.join(novel.select(*key), key, "left_semi")
    e = evidence.groupBy(*key).agg(F.max("max_qcov").alias("other_max_qcov"), F.count(F.lit(1)).alias("n_other_cells"))
    fam = members.select(F.col("member").alias("protein_id"), "family")
    return (novel.select(*key).join(presence_string(own, genomes), key, "left").join(e, key, "left")
            .join(fam, "protein_id", "left").join(supports, "protein_id", "left")
            .join(annotation.select(*key, "product_description", "function_source"), key, "left")
            .fillna(0, ["n_other_cells"]))
