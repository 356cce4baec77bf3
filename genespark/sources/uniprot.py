"""UniProt flat-file records as column expressions, and the lookup tables built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Cross-reference databases kept by their first field and by their last field.
FIRST_FIELD = ["RefSeq", "GeneID", "KEGG", "OrthoDB", "PDB", "STRING", "VEuPathDB", "eggNOG", "OMA", "SGD", "PomBase",
               "CGD", "InParanoid", "PhylomeDB", "TreeFam"]
LAST_FIELD = ["EnsemblFungi"]


def records(spark: SparkSession, paths) -> DataFrame:
    """One row per ``//``-terminated record."""
    return spark.read.option("lineSep", "\n//\n").text(paths)


def normal_sequence(seq: Column) -> Column:
    """Upper case, no white space, no trailing stop."""
    return F.regexp_replace(F.upper(F.regexp_replace(seq, r"\s", "")), r"\*+$", "")


def sequence_md5(seq: Column) -> Column:
    return F.md5(normal_sequence(seq).cast("binary"))


def _one(pattern: str) -> Column:
    return F.regexp_extract("value", "(?m)" + pattern, 1)


def _all(pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all("value", F.lit("(?m)" + pattern), F.lit(group))


def _joined(values: Column) -> Column:
    return F.array_join(values, "|")


def parse(df: DataFrame) -> DataFrame:
    """Records -> 17 columns; a record without accession or sequence is dropped.

    Lists keep the order of the file and are joined by ``|``. Only the first
    RefSeq line counts.
    """
    seq = normal_sequence(F.regexp_extract("value", r"(?s)\nSQ [^\n]*\n(.*)$", 1))
    xref = F.transform(
        F.regexp_extract_all("value", F.lit(r"(?m)^DR   ([A-Za-z0-9]+; [^\n]*)$"), F.lit(1)),
        lambda x: F.struct(F.substring_index(x, ";", 1).alias("db"),
                           F.split(F.regexp_replace(F.regexp_replace(x, r"^[^;]+;\s*", ""), r"\.?\s*$", ""), r";\s*")
                           .alias("f")))
    kept = F.filter(xref, lambda x: x["db"].isin(*FIRST_FIELD, *LAST_FIELD))
    named = F.transform(kept, lambda x: F.struct(x["db"].alias("db"), F.trim(F.when(
        x["db"].isin(*LAST_FIELD), F.element_at(F.split(F.element_at(x["f"], -1), r"\. \["), 1)).otherwise(
        F.element_at(x["f"], 1))).alias("v")))
    named = F.filter(named, lambda x: ~x["v"].isin("", "-"))
    first_ref = F.element_at(F.concat(F.filter(named, lambda x: x["db"] == "RefSeq"), F.array(F.lit(None))), 1)
    rest = F.concat(
        F.when(first_ref.isNotNull(), F.array(first_ref)).otherwise(F.filter(named, lambda x: F.lit(False))),
        F.filter(named, lambda x: x["db"] != "RefSeq"))
    parts = F.split(F.col("value"), r"(?m)^RN   ")
    refs = F.slice(parts, F.lit(2), F.size(parts))
    pubs = F.transform(refs, lambda r: F.concat_ws(
        "~", F.regexp_extract(r, r"PubMed=(\d+)", 1), F.regexp_extract(r, r"DOI=([^;\s]+)", 1)))
    rec = _one(r"^DE   RecName: Full=([^;{]+)")
    sub = _one(r"^DE   SubName: Full=([^;{]+)")
    out = df.select(
        _one(r"^AC   ([A-Z0-9]+)").alias("accession"), _one(r"^ID   (\S+)").alias("entry_name"),
        F.when(_one(r"^ID   \S+\s+(Reviewed)") == "Reviewed", "1").otherwise("0").alias("reviewed"),
        _one(r"^PE   (\d)").alias("protein_existence"), _one(r"^OX   .*?NCBI_TaxID=(\d+)").alias("taxon_id"),
        F.trim(_one(r"^GN   .*?Name=([^;{]+)")).alias("gene_name"),
        F.trim(F.when(rec != "", rec).otherwise(sub)).alias("description"),
        _joined(_all(r"^DE .*?EC=([0-9n.\-]+)")).alias("ec_numbers"),
        _joined(F.transform(_all(r"^DR   GO; (GO:\d+; [CFP]:)"), lambda x: F.concat(
            F.substring_index(x, ";", 1), F.lit(":"), F.substring(x, -2, 1)))).alias("go_ids"),
        _joined(_all(r"^DR   Pfam; (PF\d+);")).alias("pfam_ids"),
        _joined(F.transform(_all(r"^DR   Pfam; PF\d+; ([^;]+);"), lambda x: F.trim(x))).alias("pfam_names"),
        _joined(_all(r"^DR   InterPro; (IPR\d+);")).alias("interpro_ids"),
        _one(r"^DR   AlphaFoldDB; ([^;]+);").alias("alphafold_id"),
        _joined(F.transform(rest, lambda x: F.concat_ws(":", x["db"], x["v"]))).alias("xrefs"),
        _joined(F.filter(pubs, lambda p: p != "~")).alias("pubs"), F.md5(seq.cast("binary")).alias("seq_md5"),
        F.length(seq).alias("seq_len"))
    return out.where((F.col("accession") != "") & (F.col("seq_len") > 0))


def refseq_lookup(records: DataFrame) -> DataFrame:
    """RefSeq id -> accession."""
    ids = F.filter(F.split("xrefs", r"\|"), lambda x: x.startswith("RefSeq:"))
    return records.select("accession", F.explode(ids).alias("x")).select(
        F.regexp_replace("x", "^RefSeq:", "").alias("refseq"), "accession").distinct()


def proteome_lookup(entries: DataFrame) -> DataFrame:
    """Accession -> proteome (lowest id wins), with the proteome's taxon."""
    return entries.groupBy("accession").agg(F.min(F.struct("proteome_id", "taxon_id")).alias("p")).select(
        "accession", "p.proteome_id", "p.taxon_id")


def proteome_counts(wanted: DataFrame, lookup: DataFrame) -> DataFrame:
    """Records per wanted proteome; a missing one has 0."""
    n = lookup.groupBy("proteome_id").agg(F.count(F.lit(1)).alias("n_records"))
    return wanted.select("proteome_id").join(n, "proteome_id", "left").fillna(0, ["n_records"])
