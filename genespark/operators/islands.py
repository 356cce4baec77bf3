"""Accessory islands: maximal runs of non-core families, their support, dedup and display."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genespark.functions.exprs import count_if
from genespark.operators.families import whole_list
from genespark.operators.joins import split_join
from genespark.operators.ordered import chunk_rows, rank_within, running
from genespark.operators.sets import FirstHolder, Patterns, meet_all, numbered_sets, numbers
from genespark.session import materialize

RUN = ["short", "contig", "run"]


def is_core(freq: DataFrame) -> DataFrame:
    return freq.select("family", F.col("bin").isin("core", "soft_core").alias("core"))


def set_signature(col: str) -> list[Column]:
    """128-bit, order-free signature of a set of distinct values (two independent hashes)."""
    return [F.bit_xor(F.xxhash64(F.col(col))).alias("sig1"),
            F.bit_xor(F.xxhash64(F.col(col), F.lit("second"))).alias("sig2"), F.count(F.lit(1)).alias("n_members")]


def accessory_rows(positions: DataFrame, freq: DataFrame) -> DataFrame:
    """Non-core genes with the number of their run on the contig; an unknown family counts as core.

    Runs never cross a contig, so the run number is the count of core genes
    before the gene on its contig: one distributed running sum.
    """
    rows = split_join(positions.select("short", "contig", "family", "rank", "start", "end"), is_core(freq), ["family"], "left")
    rows = rows.withColumn("core", F.coalesce("core", F.lit(True)))
    group, order = ["short", "contig"], [F.col("rank")]
    run = running(chunk_rows(rows, group, order), group, order,
                  {"run": ("sum", F.col("core").cast("bigint"), True)})
    return run.where(~F.col("core")).drop("core", "_chunk")


def unknown_share(positions: DataFrame, freq: DataFrame) -> DataFrame:
    """Share of placed genes whose family has no class; above 10 % suggests an id mismatch."""
    miss = F.avg(F.col("core").isNull().cast("double"))
    return positions.select("family").join(is_core(freq), "family", "left").agg(miss.alias("share")).withColumn(
        "status", F.when(F.col("share") > 0.1, "warn").otherwise("ok"))


def runs_of(rows: DataFrame, min_size: int = 2) -> DataFrame:
    """Runs with at least ``min_size`` genes: size and rank span."""
    return rows.groupBy(*RUN).agg(
        F.count(F.lit(1)).alias("size"), F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"),
        F.min("start").alias("start"), F.max("end").alias("end")).where(F.col("size") >= min_size)


def supported_runs(rows: DataFrame, pairs: DataFrame, min_size: int = 2) -> DataFrame:
    """Runs that hold both families of a physically linked pair, with support counts and classes."""
    members = rows.select(*RUN, "family").distinct()
    p = pairs.where(F.col("classification").isin("starship_explained", "unexplained_physical"))
    first = split_join(members, p.select(F.col("family_a").alias("family"), "family_b", "classification"), ["family"])
    second = members.select(*RUN, F.col("family").alias("family_b"))
    got = first.join(second, [*RUN, "family_b"]).groupBy(*RUN).agg(
        F.count(F.lit(1)).alias("n_supporting_pairs"), F.min("classification").alias("_lo"),
        F.max("classification").alias("_hi"))
    label = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(F.concat_ws(",", "_lo", "_hi"))
    return got.withColumn("classifications", label).drop("_lo", "_hi").join(runs_of(rows, min_size), RUN)


def signatures(rows: DataFrame) -> DataFrame:
    return rows.select(*RUN, "family").distinct().groupBy(*RUN).agg(*set_signature("family"))


def distinct_islands(supported: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per (member set, class set); the example is the first instance by strain, contig, run."""
    keyed = supported.join(signatures(rows), RUN)
    best = F.min(F.struct("short", "contig", "run", "size", "n_supporting_pairs"))
    out = keyed.groupBy("sig1", "sig2", "n_members", "classifications").agg(
        F.count(F.lit(1)).alias("n_strains"), best.alias("e"))
    return out.select(
        F.concat_ws("-", F.hex("sig1"), F.hex("sig2"), F.col("n_members").cast("string"), "classifications")
        .alias("island_id"), "n_strains", F.col("e.short").alias("example_strain"), F.col("e.contig").alias("contig"),
        F.col("e.run").alias("run"), F.col("e.size").alias("island_size"),
        F.col("e.n_supporting_pairs").alias("n_supporting_pairs"), "classifications", "sig1", "sig2", "n_members")


def island_members(islands: DataFrame, rows: DataFrame) -> DataFrame:
    """Long member table (island_id, family), read from each island's example run."""
    ex = islands.select("island_id", F.col("example_strain").alias("short"), "contig", "run")
    return rows.select(*RUN, "family").distinct().join(ex, RUN).select("island_id", "family")


def member_lists(members: DataFrame) -> DataFrame:
    return whole_list(members, ["island_id"], "family", "member_families").drop("n")


def marker_flag(islands: DataFrame, members: DataFrame, marker: DataFrame, name: str) -> DataFrame:
    hit = members.join(marker.select("family").distinct(), "family", "left_semi").select("island_id").distinct()
    return islands.join(hit.withColumn("_m", F.lit(1)), "island_id", "left").withColumn(
        f"has_{name}", F.when(F.col("_m") == 1, "Y").otherwise("N")).drop("_m")


def size_distribution(islands: DataFrame) -> DataFrame:
    """Islands per size."""
    return islands.groupBy("island_size").agg(F.count(F.lit(1)).alias("n_islands"))


def marker_summary(islands: DataFrame, names: list[str]) -> DataFrame:
    """Islands with each marker, total and percentage."""
    n = F.count(F.lit(1))
    agg = islands.agg(n.alias("n_islands_total"), *[count_if(F.col(f"has_{m}") == "Y").alias(m) for m in names])
    out = agg.unpivot(["n_islands_total"], names, "marker_name", "n_islands_with_marker")
    return out.withColumn("pct_islands_with_marker", F.when(
        F.col("n_islands_total") > 0, F.round(100 * F.col("n_islands_with_marker") / F.col("n_islands_total"), 1)
    ).otherwise(0.0))


def instances(rows: DataFrame, islands: DataFrame, min_size: int = 2) -> DataFrame:
    """Every run whose member set equals the member set of a known island."""
    known = islands.groupBy("sig1", "sig2", "n_members").agg(F.min("island_id").alias("island_id"))
    return runs_of(rows, min_size).join(signatures(rows), RUN).join(known, ["sig1", "sig2", "n_members"]).drop(
        "sig1", "sig2", "n_members")


def top_islands(islands: DataFrame, shown: DataFrame, min_strains: int = 2, n: int = 50) -> DataFrame:
    """largest islands among those with a span in at least ``min_strains`` strains; ties by strains, then id."""
    located = shown.where(F.col("span_contig").isNotNull()).select("island_id")
    return islands.join(located, "island_id", "left_semi").where(F.col("n_strains") >= min_strains).orderBy(
        F.desc("island_size"), F.desc("n_strains"), "island_id").limit(n)


def haplotypes(members: DataFrame, matrix: DataFrame, strains: DataFrame) -> DataFrame:
    """Strains grouped by identical presence pattern over each island's families.

    Patterns are counted where a block of islands meets the strains; only the groups leave a task.
    """
    n = strains.count()
    known = numbers(members)
    sets = numbered_sets(members, known, ["island_id"], [F.col("island_id")])
    held = numbered_sets(matrix.select("family", "short"), known, ["short"], [F.col("short").asc_nulls_last()])
    groups = meet_all(sets, held, Patterns, "no bigint, n_present bigint, n_strains bigint, other bigint", block=4096)
    per = materialize(groups.join(sets.select("no", "island_id"), "no").drop("no"))
    some = per.join(held.select(F.col("no").alias("other"), F.col("short").alias("example_strain")), "other")
    rest = members.select("island_id").distinct().join(
        per.groupBy("island_id").agg(F.sum("n_strains").alias("_k")), "island_id", "left").select(
        "island_id", F.lit(0).cast("bigint").alias("n_present"),
        (F.lit(n) - F.coalesce("_k", F.lit(0))).cast("bigint").alias("n_strains"),
        F.lit(None).cast("string").alias("example_strain")).where(F.col("n_strains") > 0)
    return some.select("island_id", "n_present", "n_strains", "example_strain").unionByName(rest)


def display_strain(islands: DataFrame, members: DataFrame, positions: DataFrame, references: DataFrame) -> DataFrame:
    """First reference strain that holds all members on one contig, else the example strain; then the span.

    A family stands at its first annotated gene in a strain (by contig, start,
    id); rescue hits have no gene and do not count. The span runs from the
    smallest start to the largest end of the members found; it is null where
    they lie on several contigs or none is found. Blocks of islands meet the
    references' contigs in order of priority, and an island stops at its first;
    a reference named twice with one priority is passed over.
    """
    place = positions.where(~F.col("id").startswith("~")).groupBy("short", "family").agg(
        F.min(F.struct("contig", "start", "id", "end")).alias("p")).select("short", "family", "p.contig", "p.start", "p.end")
    once = references.groupBy("short", "priority").agg(F.count(F.lit(1)).alias("_m")).where("_m = 1").select("short", "priority")
    known = numbers(members)
    sets = numbered_sets(members, known, ["island_id"], [F.col("island_id")])
    sites = numbered_sets(place.where(F.col("contig").isNotNull()).join(once, "short").select("short", "contig", "priority", "family"),
                          known, ["priority", "short", "contig"], [F.col("priority"), F.col("short"), F.col("contig")])
    held = meet_all(sets, sites, FirstHolder, "no bigint, other bigint")
    best = held.join(sets.select("no", "island_id"), "no").join(
        sites.select(F.col("no").alias("other"), F.struct("priority", "short").alias("b")), "other").select("island_id", "b")
    shown = islands.select("island_id", "example_strain").join(best, "island_id", "left").select(
        "island_id", F.coalesce("b.short", "example_strain").alias("short"))
    met = shown.join(members, "island_id").join(place, ["short", "family"])
    span = met.groupBy("island_id").agg(
        F.count(F.lit(1)).alias("n_members_with_coordinates"), F.countDistinct("contig").alias("n_contigs_in_locus"),
        F.min("contig").alias("_c"), F.min("start").alias("_s"), F.max("end").alias("_e"))
    one = lambda c: F.when(F.col("n_contigs_in_locus") == 1, F.col(c))
    return shown.join(span, "island_id", "left").select(
        "island_id", F.col("short").alias("display_strain"), one("_c").alias("span_contig"), one("_s").alias("span_start"),
        one("_e").alias("span_end"), F.coalesce("n_members_with_coordinates", F.lit(0)).alias("n_members_with_coordinates"),
        F.coalesce("n_contigs_in_locus", F.lit(0)).alias("n_contigs_in_locus"))


def column_order(members: DataFrame, positions: DataFrame, shown: DataFrame) -> DataFrame:
    """Columns by smallest rank on the shown contig, then anywhere in the shown strain, unplaced last by name."""
    s = shown.select("island_id", F.col("display_strain").alias("short"), "span_contig")
    want = members.join(s, "island_id")
    p = positions.groupBy("short", "family", "contig").agg(F.min("rank").alias("rank"))
    got = want.join(p, ["short", "family"], "left").groupBy("island_id", "family").agg(
        F.min(F.when(F.col("contig") == F.col("span_contig"), F.col("rank"))).alias("_on"), F.min("rank").alias("_any"))
    tier = F.when(F.col("_on").isNotNull(), 0).when(F.col("_any").isNotNull(), 1).otherwise(2)
    got = got.withColumn("_tier", tier).withColumn("_at", F.coalesce("_on", "_any", F.lit(0)))
    return rank_within(got, ["island_id"], [F.col("_tier"), F.col("_at"), F.col("family")], "column").select(
        "island_id", "family", "column")


def column_copy(
    members: DataFrame, shown: DataFrame, genes: DataFrame, rescue: DataFrame
) -> DataFrame:
    """Copy shown per column: inside the span, then on the contig, then anywhere (lowest start); else the rescue hit."""
    s = shown.select("island_id", F.col("display_strain").alias("short"), "span_contig", "span_start", "span_end")
    want = members.join(s, "island_id")
    on = F.col("contig") == F.col("span_contig")
    tier = F.when(on & F.col("start").between(F.col("span_start"), F.col("span_end")), 0).when(on, 1).otherwise(2)
    best = want.join(genes.select("short", "family", "contig", "start"), ["short", "family"]).groupBy(
        "island_id", "family").agg(F.min(F.struct(tier.alias("t"), "start", "contig")).alias("g"))
    r = rescue.select("short", "family", F.col("contig").alias("_rc"), F.col("start").alias("_rs"))
    return want.join(best, ["island_id", "family"], "left").join(r, ["short", "family"], "left").select(
        "island_id", "family", F.coalesce("g.contig", "_rc").alias("contig"), F.coalesce("g.start", "_rs").alias("start"),
        F.when(F.col("g").isNotNull(), "gene").when(F.col("_rc").isNotNull(), "rescue").otherwise("none").alias("source"))


def island_rows(
    islands: DataFrame, shown: DataFrame, columns: DataFrame, copies: DataFrame, classes: DataFrame, groups: DataFrame
) -> DataFrame:
    """One row per island: ordered families with class and location per column, haplotype count.

    The lists are whole; ``columns`` and ``copies`` hold the same row by row.
    """
    fits = columns.groupBy("island_id").agg(F.count(F.lit(1)).alias("n_columns"))
    cell = columns.join(
        copies.select("island_id", "family", "contig", "start"), ["island_id", "family"], "left").join(
        classes, "family", "left")
    item = F.struct("column", "family", F.coalesce("dominant_class", F.lit("unannotated")).alias("cls"),
                    F.coalesce(F.concat_ws(":", "contig", "start"), F.lit("")).alias("loc"))
    lists = cell.groupBy("island_id").agg(F.array_sort(F.collect_list(item)).alias("x"))
    join = lambda f: F.array_join(F.transform("x", lambda s: s[f]), ",")
    haps = groups.groupBy("island_id").agg(F.count(F.lit(1)).alias("n_haplotypes"))
    return islands.select("island_id", "n_strains", "island_size").join(
        shown.select("island_id", "display_strain", "span_contig", "span_start", "span_end"), "island_id").join(
        fits, "island_id").join(lists, "island_id", "left").join(haps, "island_id", "left").select(
        "island_id", "n_strains", "island_size", "display_strain", "span_contig", "span_start", "span_end", "n_columns",
        join("family").alias("families"), join("cls").alias("classes"), join("loc").alias("locations"), "n_haplotypes")
