"""Delimited tables: sample sheets, matrices, region tables, traits, pools."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Older spellings of the group labels.
GROUP_ALIASES = {"TARGET": "DISCOVERY_TARGET", "DISC_OUT": "DISCOVERY_OUT", "NEAR_IN": "NEAR_INGROUP",
                 "BROAD_OUT": "BROAD_OUTGROUP"}
SAMPLE_COLUMNS = ["GROUP", "Species", "Strain", "Protein", "DNA", "Short", "TaxonGroup", "GFF3", "SourceDB",
                  "NCBI_TaxID", "Stratum"]
STATES = ["present", "genome_only", "absent"]


def delimited(spark: SparkSession, paths, sep: str = "\t") -> DataFrame:
    """Header table read as strings; an empty cell is null (not measured)."""
    return spark.read.option("header", True).option("sep", sep).csv(paths)


def sample_sheet(df: DataFrame) -> DataFrame:
    """Trimmed cells, aliases resolved, missing optional columns blank, stratum label filled."""
    cell = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) if c in df.columns else F.lit("")
    group = cell("GROUP")
    alias = group
    for a, b in GROUP_ALIASES.items():
        alias = F.when(group == a, b).otherwise(alias)
    out = df.select(alias.alias("grp"), *[cell(c).alias(n) for c, n in zip(SAMPLE_COLUMNS[1:], [
        "species", "strain", "protein", "dna", "short", "taxon_group", "gff3", "source_db", "taxid", "stratum"])])
    return out.withColumn("stratum_label", F.when(F.col("stratum") != "", F.col("stratum")).otherwise(F.col("taxon_group")))


def hit_tables(spark: SparkSession, paths) -> DataFrame:
    """Union of parsed hit tables by column name; files without rows add nothing."""
    from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType
    kinds = {"query_id": StringType(), "target_id": StringType(), "evalue": DoubleType(), "bitscore": DoubleType(),
             "query_proteome": StringType(), "target_proteome": StringType(), "length": IntegerType(),
             "pident": DoubleType(), "qcov": DoubleType(), "scov": DoubleType(), "qlen": IntegerType(),
             "slen": IntegerType()}
    schema = StructType([StructField(k, t) for k, t in kinds.items()])
    return spark.read.schema(schema).option("header", True).option("sep", "\t").option("enforceSchema", False).csv(paths)


def wide_matrix(df: DataFrame, families: DataFrame | None = None) -> DataFrame:
    """Wide 3-state matrix -> present and genome_only cells; the family filter runs before the unpivot."""
    strains = [c for c in df.columns if c != "family"]
    names = df.sparkSession.createDataFrame(list(enumerate(strains)), "i int, short string")
    return matrix_rows(df.select("family", F.array(*strains).alias("states")), names, families)


def matrix_rows(rows: DataFrame, names: DataFrame, families: DataFrame | None = None) -> DataFrame:
    """S14 for any number of strains: rows (family, states), the header as ``names`` (i, short), i counting from 0."""
    if families is not None:
        rows = rows.join(families.select("family"), "family", "left_semi")
    long = rows.select("family", F.posexplode("states").alias("i", "state"))
    bad = F.raise_error(F.concat(F.lit("unknown matrix state: "), F.coalesce("state", F.lit("NULL")))).cast("string")
    long = long.withColumn("state", F.when(F.col("state").isin(*STATES), F.col("state")).otherwise(bad))
    return long.where(F.col("state") != "absent").join(names, "i").select("family", "short", "state")


def with_copies(cells: DataFrame, copies: DataFrame | None) -> DataFrame:
    """Copy numbers from an optional side table; without it they stay null."""
    if copies is None:
        return cells.withColumn("copies", F.lit(None).cast("bigint"))
    return cells.join(copies.select("family", "short", "copies"), ["family", "short"], "left")


def distances(df: DataFrame, name: str = "#query") -> DataFrame:
    """Square distance table -> symmetric (a, b, dist) with a zero diagonal.

    Both orientations of a pair are averaged; see ``distance_rows``.
    """
    cols = [c for c in df.columns if c != name]
    return distance_rows(df.select(F.col(name).alias("name"), F.array(*[F.col(c).cast("double") for c in cols]).alias("cells")), cols)


def distance_rows(rows: DataFrame, header: list[str], side: int = 512) -> DataFrame:
    """S17 for any number of names: rows (name, cells) under one header.

    A row is cut into tiles of ``side`` cells. A tile of the square and the one mirrored
    at the diagonal meet in one task and are averaged as matrices; no cell is shuffled
    as a row. Names that are rows only follow those of the header.
    """
    known = set(header)
    more = rows.select("name").where(F.col("name").isNotNull()).distinct().collect()
    names = [*header, *sorted(r["name"] for r in more if r["name"] not in known)]
    at = {n: i for i, n in enumerate(names)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, cells in zip(b["name"].to_pylist(), b["cells"]):
                values = cells.values if cells.is_valid else pa.array([], pa.float64())
                x, null = values.fill_null(0.0).to_numpy(zero_copy_only=False), values.is_null().to_numpy(zero_copy_only=False)
                i, starts = at[name], range(0, len(x), side)
                j = np.array([k // side for k in starts], "i4")
                own = np.full(len(j), i // side, "i4")
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(own, j)), pa.array(np.maximum(own, j)), pa.array(own), pa.array(j), pa.array(
                    np.full(len(j), i, "i4")), pa.array([x[k:k + side].tobytes() for k in starts], pa.binary()), pa.array(
                    [np.packbits(null[k:k + side]).tobytes() if null[k:k + side].any() else None for k in starts], pa.binary())],
                    ["p", "q", "bi", "bj", "i", "x", "null"])

    def met(t: pa.Table) -> pa.Table:
        p, q = t["p"][0].as_py(), t["q"][0].as_py()
        total, count = np.zeros((side, side)), np.zeros((side, side), "i4")
        seen = np.zeros((side, side), bool)
        for bi, bj, i, x, null in zip(*(t[c].to_pylist() for c in ("bi", "bj", "i", "x", "null"))):
            x = np.frombuffer(x)
            told = np.ones(len(x), bool) if null is None else ~np.unpackbits(np.frombuffer(null, "u1"), count=len(x)).astype(bool)
            for mirrored in {(bi, bj) != (p, q)} if p != q else (False, True):
                row = (slice(0, len(x)), i - bi * side) if mirrored else (i - bi * side, slice(0, len(x)))
                total[row] += np.where(told, x, 0.0)
                count[row] += told
                seen[row] = True
        if p == q:
            np.fill_diagonal(seen, False)
        a, b = np.nonzero(seen)
        n = count[a, b]
        dist = pa.array(total[a, b] / np.maximum(n, 1), mask=n == 0)
        part = lambda at, block: pa.DictionaryArray.from_arrays(pa.array(at, pa.int32()), pa.array(names[block * side:(block + 1) * side], pa.string())).cast(pa.string())
        x, y = part(a, p), part(b, q)
        one = pa.table([x, y, dist], ["a", "b", "dist"])
        return one if p == q else pa.concat_tables([one, pa.table([y, x, dist], ["a", "b", "dist"])])
    tiles = rows.where(F.col("name").isNotNull()).select("name", "cells").mapInArrow(
        cut, "p int, q int, bi int, bj int, i int, x binary, null binary")
    pairs = tiles.groupBy("p", "q").applyInArrow(met, "a string, b string, dist double")
    return pairs.unionByName(rows.select(F.col("name").alias("a"), F.col("name").alias("b"), F.lit(0.0).alias("dist")).distinct())


def busco_table(df: DataFrame, species: str) -> DataFrame:
    """Complete rows of a full table; ``:start-end`` is stripped from the protein."""
    return df.where(F.col("status") == "Complete").select(
        "busco_id", F.lit(species).alias("species"), F.regexp_replace("sequence", r":\d+-\d+.*$", "").alias("protein_id"))


def region_violations(df: DataFrame, strains: DataFrame) -> DataFrame:
    """Every bad row of a coordinate region table with its reason."""
    s, e = F.col("start").try_cast("bigint"), F.col("end").try_cast("bigint")
    known = df.join(strains.select(F.col("short").alias("strain"), F.lit(1).alias("_k")), "strain", "left")
    why = (F.when(F.coalesce(F.trim("id"), F.lit("")) == "", "missing id").when(F.col("_k").isNull(), "unknown strain")
           .when(s.isNull() | e.isNull(), "coordinates are not integers").when(s < 1, "start below 1")
           .when(e < s, "end before start"))
    return known.withColumn("reason", why).where(F.col("reason").isNotNull()).drop("_k")


def checked_regions(df: DataFrame, strains: DataFrame, shown: int = 20) -> DataFrame:
    """The table with typed coordinates; fails with the first bad rows if there are any."""
    bad = region_violations(df, strains).limit(shown).collect()
    if bad:
        raise ValueError("; ".join(f"{r['id']}: {r['reason']}" for r in bad))
    return df.withColumn("start", F.col("start").cast("bigint")).withColumn("end", F.col("end").cast("bigint"))


def controls(df: DataFrame) -> DataFrame:
    """Control rows without template placeholders."""
    anchor = F.coalesce("anchor", F.lit(""))
    return df.where(~F.trim("control_id").startswith("EXAMPLE_") & ~anchor.contains("<") & ~anchor.contains(">"))


def trait_violations(traits: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Values outside the vocabulary, and ``none`` next to another value of the same trait."""
    unknown = traits.join(vocabulary, ["trait", "value"], "left_anti").select(
        "species", "trait", "value", F.lit("not in vocabulary").alias("reason"))
    mixed = traits.groupBy("species", "trait").agg(
        F.max((F.col("value") == "none").cast("int")).alias("n"), F.countDistinct("value").alias("k")).where(
        (F.col("n") == 1) & (F.col("k") > 1)).select(
        "species", "trait", F.lit("none").alias("value"), F.lit("none beside other values").alias("reason"))
    return unknown.unionByName(mixed)


def representative_violations(pool: DataFrame) -> DataFrame:
    """Species that do not have exactly one representative row."""
    return pool.groupBy("species").agg(F.sum((F.col("is_rep") == 1).cast("int")).alias("n_representatives")).where(
        F.col("n_representatives") != 1)


def feature_map(df: DataFrame) -> DataFrame:
    """Protein -> gene from the coding rows of a feature table."""
    return df.where(F.col("feature") == "CDS").select(
        F.col("product_accession").alias("protein_id"), F.coalesce("GeneID", "locus_tag").alias("gene_id")).where(
        F.col("protein_id").isNotNull() & F.col("gene_id").isNotNull()).distinct()


def closure(edges: DataFrame) -> DataFrame:
    """(node, tip) for every node and the tips below it, from (parent, child) edges of a tree.

    Round k knows the ancestors up to distance 2**k and every node's 2**k-th
    ancestor; that one ancestor's list is what the next distances add, so each
    pair is made once and the rounds grow with the logarithm of the depth.
    """
    from genespark.session import materialize
    tips = edges.select(F.col("child").alias("tip")).distinct().join(
        edges.select(F.col("parent").alias("tip")).distinct(), "tip", "left_anti")
    jump = materialize(edges.select(F.col("child").alias("below"), F.col("parent").alias("up")).distinct())
    reach = jump.select("below", F.col("up").alias("node"))
    while jump.limit(1).count():
        more = jump.join(reach.withColumnRenamed("below", "up"), "up").select("below", "node")
        reach = materialize(reach.unionByName(more))
        jump = materialize(jump.join(jump.select(F.col("below").alias("up"), F.col("up").alias("_u")), "up").select(
            "below", F.col("_u").alias("up")))
    own = tips.select(F.col("tip").alias("node"), "tip")
    return reach.join(tips.withColumnRenamed("tip", "below"), "below", "left_semi").select(
        "node", F.col("below").alias("tip")).unionByName(own)


def gene_names(df: DataFrame, gene: str, name: str, product: str) -> DataFrame:
    """Gene id -> name and product; quotes are stripped and N/A is blank."""
    cell = lambda c: F.trim(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), '^"+|"+$', ""))
    known = lambda c: F.when(cell(c) == "N/A", "").otherwise(cell(c))
    rows = df.select(cell(gene).alias("gene_key"), known(name).alias("gene_name"), known(product).alias("product"))
    return rows.where(F.col("gene_key") != "").groupBy("gene_key").agg(
        F.max(F.struct("gene_name", "product")).alias("r")).select("gene_key", "r.gene_name", "r.product")


def header_field(headers: DataFrame, field: str) -> DataFrame:
    """Protein id -> value of ``field=`` in its header."""
    return headers.select("id", F.regexp_extract("header", rf"\b{field}=(\S+)", 1).alias("gene_key")).where(
        F.col("gene_key") != "")


# Ranks of the metadata table that make up a lineage, shallow to deep.
LINEAGE = ["PHYLUM", "SUBPHYLUM", "CLASS", "SUBCLASS", "ORDER", "FAMILY", "GENUS"]


def genome_files_to_pool(files: DataFrame, taxonomy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pool, unmatched) from genome file names ``Genus_species_strain.version`` and a taxonomy table.

    ``files`` has basename and has_dna; a species without taxonomy or DNA goes to unmatched with a reason.
    """
    part = F.split("basename", "_")
    species = F.concat_ws(" ", part[0], F.substring_index(F.get(part, F.lit(1)), ".", 1))
    strain = F.substring_index(F.array_join(F.slice(part, F.lit(3), F.greatest(F.size(part), F.lit(1))), "_"), ".", 1)
    rows = files.withColumn("species", F.when(F.size(part) >= 2, species)).withColumn("strain", strain).withColumn(
        "_key", F.lower("species"))
    cell = lambda c: F.nullif(F.trim(F.coalesce(F.col(c), F.lit(""))), F.lit(""))
    tax = taxonomy.select(F.lower(F.trim("SPECIES")).alias("_key"), F.concat_ws(
        ";", F.lit("Fungi"), *[cell(c) for c in LINEAGE]).alias("lineage"))
    tax = tax.groupBy("_key").agg(F.min("lineage").alias("lineage"))
    rows = rows.join(tax, "_key", "left")
    why = (F.when(F.col("species").isNull(), "unparseable filename").when(F.col("lineage").isNull(), "no taxonomy match")
           .when(F.col("has_dna") != 1, "no matching DNA file"))
    rows = rows.withColumn("reason", why)
    return (rows.where(F.col("reason").isNull()).select("species", "strain", "basename", "lineage"),
            rows.where(F.col("reason").isNotNull()).select("basename", "reason"))


def metadata_to_pool(rows: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pool, missing) from a metadata table whose annotation folder is ``Species_strain``."""
    name = F.regexp_replace(F.rtrim(F.regexp_replace(F.concat_ws("_", F.trim("SPECIES"), F.nullif(
        F.trim(F.coalesce("STRAIN", F.lit(""))), F.lit(""))), "_+$", "")), " ", "_")
    cell = lambda c: F.nullif(F.trim(F.coalesce(F.col(c), F.lit(""))), F.lit(""))
    keyed = rows.withColumn("basename", name)
    pool = keyed.join(files.select("basename").distinct(), "basename", "left_semi").select(
        F.trim("SPECIES").alias("species"), F.trim("STRAIN").alias("strain"), "basename",
        F.concat_ws(";", F.lit("Fungi"), *[cell(c) for c in LINEAGE]).alias("lineage"))
    return pool, keyed.join(files.select("basename"), "basename", "left_anti").select("basename")
