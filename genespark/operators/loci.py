"""Loci seen across strains: placements, exemplar, columns, cell states, row classes, ranks.

Tables are long: (locus_id, short, col, code). A strain without any copy of a
locus's families has no rows; it is uninformative by definition and only counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genespark.functions.exprs import count_if
from genespark.operators import strips
from genespark.operators.joins import split_join
from genespark.operators.ordered import rank_within
from genespark.session import materialize

ABSENT, IN_PLACE, ELSEWHERE, RESCUE_IN, RESCUE_OUT, BREAK, DNA_PRESENT, DNA_ABSENT = "01234567"
ROW = ["locus_id", "short"]
MIN_EMPTY, MIN_FULL = 10, 2


def _copies(families: DataFrame, positions: DataFrame, *more: str) -> DataFrame:
    return split_join(positions.select("short", "contig", "family", "rank", *more), families.select("locus_id", "family").distinct(),
                      ["family"])


def placements(members: DataFrame, positions: DataFrame, k: int = 10) -> DataFrame:
    """Strains that hold every member of a locus on one contig within size - 1 + k ranks.

    Every copy is tried as the right end of a window. A window is never longer
    than the limit, so an end only meets the copies of two neighbouring rank
    bins. The tightest window wins, then the lower start, then the contig name.
    """
    need = members.groupBy("locus_id").agg(F.countDistinct("family").alias("need"))
    c = materialize(_copies(members, positions).join(need, "locus_id").withColumn("span", F.col("need") - 1 + k).withColumn(
        "_bin", F.floor(F.col("rank") / (F.col("span") + 1)).cast("bigint")))
    ends = c.select("locus_id", "short", "contig", "need", "span", F.col("rank").alias("hi"),
                    F.explode(F.array("_bin", F.col("_bin") - 1)).alias("_bin"))
    met = ends.join(c.select("locus_id", "short", "contig", "_bin", "family", "rank"), ["locus_id", "short", "contig", "_bin"])
    met = met.where((F.col("rank") <= F.col("hi")) & (F.col("rank") >= F.col("hi") - F.col("span")))
    last = met.groupBy("locus_id", "short", "contig", "need", "hi", "family").agg(F.max("rank").alias("r"))
    win = last.groupBy("locus_id", "short", "contig", "need", "hi").agg(
        F.count(F.lit(1)).alias("n"), F.min("r").alias("lo")).where(F.col("n") == F.col("need"))
    best = win.groupBy(*ROW).agg(F.min(F.struct((F.col("hi") - F.col("lo")).alias("w"), "contig", "lo", "hi")).alias("b"))
    return best.select(*ROW, "b.contig", "b.lo", "b.hi")


def exemplars(
    placed: DataFrame, spans: DataFrame, strains: DataFrame, flank: int = 5, flank_min: int = 3
) -> DataFrame:
    """F8: one carrier per locus: tier (full, short_flanks, contig_end), preferred list, ingroup, quality, name.

    ``strains`` carries short, grp, n50 (nullable) and priority (nullable order of preferred strains).
    """
    p = placed.join(spans, ["short", "contig"], "left").withColumn("left_avail", F.col("lo") - F.coalesce("first_rank", "lo")
        ).withColumn("right_avail", F.coalesce("last_rank", "hi") - F.col("hi")).withColumn(
        "contig_genes", F.coalesce("last_rank", "hi") - F.coalesce("first_rank", "lo") + 1).join(
        strains.select("short", "grp", "n50", "priority"), "short", "left")
    both = lambda n: (F.col("left_avail") >= n) & (F.col("right_avail") >= n)
    tier = F.when(both(flank), 0).when(both(flank_min), 1).otherwise(2)
    order = F.struct(
        tier.alias("t"), F.when(tier == 2, -(F.col("left_avail") + F.col("right_avail"))).otherwise(0).alias("f"),
        F.coalesce("priority", F.lit(2**31 - 1)).alias("p"), (F.col("grp") == "OUT").alias("o"), F.col("n50").isNull().alias("u"),
        (-F.coalesce("n50", "contig_genes")).alias("q"), "short", "contig", "lo", "hi", "left_avail", "right_avail")
    best = p.groupBy("locus_id").agg(F.min(order).alias("b"))
    label = F.when(F.col("b.t") == 0, "full").when(F.col("b.t") == 1, "short_flanks").otherwise("contig_end")
    return best.select("locus_id", F.col("b.short").alias("exemplar"), "b.contig", "b.lo", "b.hi", label.alias("tier"))


def columns(exemplar: DataFrame, positions: DataFrame, flank: int = 5) -> DataFrame:
    """Columns of a locus: genes of the exemplar's block, and up to ``flank`` placed genes on each side."""
    where = exemplar.select("locus_id", F.col("exemplar").alias("short"), "contig", "lo", "hi")
    near = positions.join(where.select("short", "contig").distinct(), ["short", "contig"], "left_semi")
    order = rank_within(near.select("short", "contig", "family", "rank"), ["short", "contig"], [F.col("rank")], "i")
    seq = order.join(where, ["short", "contig"])
    ends = seq.where(F.col("rank").between(F.col("lo"), F.col("hi"))).groupBy("locus_id").agg(
        F.min("i").alias("_a"), F.max("i").alias("_b"))
    cols = seq.join(ends, "locus_id").where(F.col("i").between(F.col("_a") - flank, F.col("_b") + flank))
    first = cols.groupBy("locus_id").agg(F.min("i").alias("_f"))
    part = F.when(F.col("i") < F.col("_a"), "left").when(F.col("i") > F.col("_b"), "right").otherwise("locus")
    return cols.join(first, "locus_id").select(
        "locus_id", (F.col("i") - F.col("_f")).cast("int").alias("col"), "family", part.alias("part"))


def neighbours(copies: DataFrame, k: int = 10) -> DataFrame:
    """Every copy with ``neighbour`` and ``delta`` of the nearest copy of a different family of its locus, null beyond k ranks.

    Copies of one (locus, strain) are dealt together and read once up and once down
    the ranks: where the family changes, the copy before is the nearest different
    one for the whole run of equal families. No pair is built. A rank is one gene.
    """
    group, at = Window.partitionBy(*ROW, "contig"), [F.col("rank"), F.col("family")]
    here = F.struct(F.col("rank").alias("r"), F.col("family").alias("f"))

    def beside(df: DataFrame, out: str, order: list[Column]) -> DataFrame:
        w = group.orderBy(*order)
        df = df.withColumn("_b", F.lag(here).over(w))
        df = df.withColumn("_b", F.when(F.col("_b.f") != F.col("family"), F.col("_b")))
        return df.withColumn(out, F.last("_b", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_b")
    rows = beside(beside(copies.repartition(*ROW), "_up", at), "_down", [c.desc() for c in at])
    side = lambda c: F.when(F.abs(F.col(f"{c}.r") - F.col("rank")) <= k, F.struct(
        F.abs(F.col(f"{c}.r") - F.col("rank")).alias("a"), (F.col(f"{c}.r") - F.col("rank")).alias("d"), F.col(f"{c}.f").alias("n")))
    known = F.col("locus_id").isNotNull() & F.col("short").isNotNull() & F.col("contig").isNotNull()
    near = F.when(known, F.least(side("_up"), side("_down")))
    return rows.withColumn("_n", near).withColumn("neighbour", F.col("_n.n")).withColumn("delta", F.col("_n.d")).drop("_up", "_down", "_n")


def nearest_other(copies: DataFrame, k: int = 10) -> DataFrame:
    """For each copy the nearest copy of a different family of its locus within k ranks (a tie goes left)."""
    return neighbours(copies, k).where(F.col("neighbour").isNotNull()).select(
        "locus_id", "short", "contig", "family", "rank", "neighbour", "delta")


def cell_states(
    cols: DataFrame, positions: DataFrame, matrix: DataFrame, spans: DataFrame, k: int = 10
) -> DataFrame:
    """M23 + W15: base state and display code per (locus, strain, column)."""
    return strips.cell_states(cols, positions, matrix, spans, k)


def flank_pairs(cols: DataFrame, positions: DataFrame, k: int = 10) -> DataFrame:
    """Closest in-place left / right flank copies on one contig within n_locus + 2k ranks, per strain."""
    return strips.flank_pairs(cols, positions, k)


def informative_columns(cells: DataFrame, min_strains: int = 2) -> DataFrame:
    """Locus columns in place in enough strains; every locus column when none is."""
    c = cells.where(F.col("part") == "locus").groupBy("locus_id", "col").agg(count_if(F.col("base") == IN_PLACE).alias("support"))
    any_ok = c.groupBy("locus_id").agg(F.max((F.col("support") >= min_strains).cast("int")).alias("_any"))
    return c.join(any_ok, "locus_id").select("locus_id", "col", "support", ((F.col("support") >= min_strains) | (
        F.col("_any") == 0)).cast("int").alias("used"))


def row_classes(cells: DataFrame, pairs: DataFrame, mask: DataFrame, empty_frac: float = 0.8) -> DataFrame:
    """Full / partial / empty / uninformative per (locus, strain), with the code string."""
    used = mask.where(F.col("used") == 1).select("locus_id", "col", F.lit(True).alias("_used"))
    n = lambda c: count_if(F.coalesce("_used", F.lit(False)) & c)
    k = cells.join(used, ["locus_id", "col"], "left").groupBy(*ROW).agg(
        n(F.lit(True)).alias("n"), n(F.col("base") == ABSENT).alias("a"), n(F.col("base") == IN_PLACE).alias("i"), codes())
    ok = pairs.select(*ROW, F.lit(1).alias("_intact"))
    label = (F.when(F.col("_intact").isNull(), "uninformative").when(F.col("a") / F.col("n") >= empty_frac, "empty")
             .when(F.col("i") == F.col("n"), "full").otherwise("partial"))
    return k.where(F.col("n") > 0).join(ok, ROW, "left").select(*ROW, label.alias("row_class"), "codes")


def codes() -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "code"))), lambda s: s["code"]), "").alias("codes")


def code_strings(cells: DataFrame) -> DataFrame:
    """One character per column (a locus has a few dozen columns)."""
    return cells.groupBy(*ROW).agg(codes())


def collapse_rows(rows: DataFrame) -> DataFrame:
    """Strains with equal class and codes become one row."""
    return rows.groupBy("locus_id", "row_class", "codes").agg(F.count(F.lit(1)).alias("n_strains"), F.min("short").alias("example"))


def species_counts(rows: DataFrame, strains: DataFrame) -> DataFrame:
    """Strains per class and species, for every locus and species; strains without any copy are uninformative."""
    classes = ["full", "partial", "empty", "model_difference", "variable_gap"]
    sp = strains.select("short", "species")
    per = rows.join(sp, "short").groupBy("locus_id", "species").agg(*[count_if(F.col("row_class") == c).alias(c) for c in classes])
    size = sp.groupBy("species").agg(F.count(F.lit(1)).alias("total"))
    every = rows.select("locus_id").distinct().withColumn("_s", F.explode(size.agg(F.collect_list(F.struct("species", "total"))).scalar()))
    out = every.select("locus_id", "_s.species", "_s.total").join(per, ["locus_id", "species"], "left").fillna(0, classes)
    return out.select("locus_id", "species", *classes, (F.col("total") - sum(F.col(c) for c in classes)).alias("uninformative"))


def breakpoints(cells: DataFrame, rows: DataFrame, strains: DataFrame) -> DataFrame:
    """Boundaries where a strain changes between in place and absent (by species) or contig break."""
    # A row's class stands before its cells, in their order; tables of rows are small in files, not in memory, so none is joined.
    both = cells.select(*ROW, "col", "code", F.lit(None).cast("string").alias("row_class")).unionByName(rows.select(
        *ROW, F.lit(None).cast(cells.schema["col"].dataType).alias("col"), F.lit(None).cast("string").alias("code"), "row_class"))
    at = Window.partitionBy(*ROW).orderBy("col")
    c = both.withColumn("prev", F.collect_list("code").over(at.rangeBetween(-1, -1))).withColumn(
        "row_class", F.first("row_class", ignorenulls=True).over(at.rowsBetween(Window.unboundedPreceding, 0))).where(
        F.col("col").isNotNull() & F.col("row_class").isNotNull()).withColumn("prev", F.explode("prev")).join(
        strains.select("short", "species"), "short")
    here, there = F.col("code").isin(IN_PLACE, RESCUE_IN), F.col("prev").isin(IN_PLACE, RESCUE_IN)
    with_ = lambda x: (here & (F.col("prev") == x)) | (there & (F.col("code") == x))
    out = c.groupBy("locus_id", F.col("col").alias("boundary"), "species").agg(
        count_if(with_(ABSENT) & (F.col("row_class") != "uninformative")).alias("indel"), count_if(with_(BREAK)).alias("contig_break"))
    return out.where((F.col("indel") > 0) | (F.col("contig_break") > 0))


def _score(a: Column, b: Column) -> Column:
    return F.when((a >= MIN_EMPTY) & (b >= MIN_FULL), F.least(a, b)).otherwise(F.lit(-1).cast("bigint"))


def locus_ranks(
    rows: DataFrame, cols: DataFrame, strains: DataFrame, missing: str = ABSENT, fixed_diff: float = 0.95,
    poly: tuple[int, float, float] = (20, 0.05, 0.95), confirmed: DataFrame | None = None,
) -> DataFrame:
    """whole_annot, whole_dna, presence, species and within-species scores per locus (-1 = not met).

    With ``confirmed`` (locus_id, short) the whole scores count only these strains'
    empty sites; ``missing`` is the code that makes a partial strain a loss.
    """
    at = cols.where(F.col("part") == "locus").groupBy("locus_id").agg((F.min("col") + 1).alias("_a"), F.count(F.lit(1)).cast("int").alias("_k"))
    block = F.expr("substring(codes, _a, _k)")
    carrier = (F.when(F.col("row_class").isin("full", "model_difference", "variable_gap"), True).when(F.col("row_class") == "empty", False)
               .otherwise(~block.contains(missing)))
    live = rows.where(F.col("row_class") != "uninformative").join(at, "locus_id").withColumn("_c", carrier).join(
        strains.select("short", "species"), "short")
    n_species = strains.select("species").distinct().count()
    sp = live.groupBy("locus_id", "species").agg(count_if(F.col("_c")).alias("car"), count_if(~F.col("_c")).alias("loss"))
    n, f = F.col("car") + F.col("loss"), F.col("loss") / (F.col("car") + F.col("loss"))
    poly_ok = (n >= poly[0]) & (f >= poly[1]) & (f <= poly[2])
    worst = F.when(poly_ok, F.struct((-F.least("car", "loss")).alias("s"), "species"))
    per = sp.groupBy("locus_id").agg(
        F.sum("car").alias("carriers"), F.sum("loss").alias("losses"), count_if(n >= 10).alias("_ns"),
        (F.max(F.when(n >= 10, f)) - F.min(F.when(n >= 10, f))).alias("_d"), F.min(worst).alias("_w"))
    told = rows.withColumn("_sure", F.lit(True)) if confirmed is None else rows.join(
        confirmed.select(*ROW).distinct().withColumn("_sure", F.lit(True)), ROW, "left")
    is_ = lambda x: (F.col("row_class") == x) & (F.coalesce("_sure", F.lit(False)) | (F.lit(x) != "empty"))
    c = told.groupBy("locus_id").agg(*[count_if(is_(x)).alias(f"_{x}") for x in ("full", "empty", "model_difference", "variable_gap")])
    wide = c.join(per, "locus_id", "left").fillna(0, ["carriers", "losses"])
    diff = F.round("_d", 3)
    return wide.select(
        "locus_id", _score(F.col("_empty"), F.col("_full")).alias("whole_annot"),
        _score(F.col("_empty"), F.col("_full") + F.col("_model_difference") + F.col("_variable_gap")).alias("whole_dna"),
        _score(F.col("losses"), F.col("carriers")).alias("presence"),
        F.when(F.lit(n_species >= 2) & (F.col("_ns") >= 2) & (F.col("_d") >= fixed_diff), diff).otherwise(-1.0).alias("species_difference"),
        F.coalesce(-F.col("_w.s"), F.lit(-1)).cast("bigint").alias("within"), F.col("_w.species").alias("within_species"),
        "carriers", "losses")


def dna_cells(cells: DataFrame, rows: DataFrame, calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells of the strains that calls change, with their new codes, and these strains (locus_id, short).

    Only strains with intact flanks, a classifying gap and at least one present /
    absent call count. Absent, elsewhere and rescue-elsewhere cells of the locus
    become dna_present or dna_absent.
    """
    ok = rows.where(F.col("row_class").isin("partial", "empty")).select(*ROW)
    use = calls.where(F.col("call").isin("present", "absent")).join(ok, ROW, "left_semi").select(*ROW, "col", "call")
    touched = use.select(*ROW).distinct()
    new = cells.join(touched, ROW, "left_semi").join(use, [*ROW, "col"], "left")
    change = (F.col("part") == "locus") & F.col("code").isin(ABSENT, ELSEWHERE, RESCUE_OUT) & F.col("call").isNotNull()
    return new.withColumn("code", F.when(change, F.when(F.col("call") == "present", DNA_PRESENT).otherwise(DNA_ABSENT)).otherwise(
        F.col("code"))).drop("call"), touched


def dna_recount(
    cells: DataFrame, rows: DataFrame, mask: DataFrame, calls: DataFrame, cols: DataFrame, strains: DataFrame, empty_frac: float = 0.8,
    min_frac: float = 0.5,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """M24, M26, W16 after sequence calls: rows, ranks, breakpoints, and a summary per locus.

    Classes are recomputed for the touched strains only. In the ranks an empty site
    counts if the sequence confirms it, and a partial strain is a loss if sequence
    is missing. In the breakpoint track only changes between in place and
    sequence-confirmed absent count. The summary has the strains checked and
    unchecked, the empty sites confirmed, and those that became model differences.
    """
    n_cells = cells.select(*ROW).distinct().groupBy("locus_id").agg(F.count(F.lit(1)).alias("n_strains"))
    new, touched = dna_cells(cells, rows, calls)
    new, touched = materialize(new), materialize(touched)
    after = materialize(_dna_classes(rows, new, touched, mask.join(n_cells, "locus_id"), F.col("n_strains"), empty_frac, min_frac))
    ranks = locus_ranks(after, cols, strains, DNA_ABSENT, confirmed=touched)
    every = cells.join(touched, ROW, "left_anti").unionByName(new.select(*cells.columns))
    track = F.when(F.col("code").isin(ABSENT, DNA_PRESENT), ELSEWHERE).when(F.col("code") == DNA_ABSENT, ABSENT).otherwise(F.col("code"))
    tracks = breakpoints(every.withColumn("code", track), after, strains)
    before = rows.where(F.col("row_class").isin("partial", "empty")).select(*ROW, F.col("row_class").alias("_was"))
    told = before.join(after.select(*ROW, "row_class"), ROW).join(touched.withColumn("_t", F.lit(True)), ROW, "left")
    is_ = F.col("_t").isNotNull()
    summary = told.groupBy("locus_id").agg(
        count_if(is_).alias("checked"), count_if(~is_).alias("unchecked"), count_if(is_ & (F.col("row_class") == "empty")).alias("empty_confirmed"),
        count_if(is_ & (F.col("_was") == "empty") & (F.col("row_class") == "model_difference")).alias("empty_to_model_difference"))
    return after, ranks, tracks, summary


def apply_dna_calls(
    cells: DataFrame, rows: DataFrame, mask: DataFrame, calls: DataFrame, n_strains: int, empty_frac: float = 0.8,
    min_frac: float = 0.5,
) -> DataFrame:
    """Row classes after sequence calls (locus_id, short, col, call in present / absent / unchecked); see ``dna_cells``."""
    new, touched = dna_cells(cells, rows, calls)
    return _dna_classes(rows, new, touched, mask, F.lit(n_strains), empty_frac, min_frac)


def _dna_classes(rows: DataFrame, new: DataFrame, touched: DataFrame, mask: DataFrame, n_strains: Column, empty_frac: float, min_frac: float) -> DataFrame:
    used = new.join(mask.where(F.col("used") == 1).select("locus_id", "col", (F.col("support") >= min_frac * n_strains).alias("_common")),
                    ["locus_id", "col"])
    good = F.col("code").isin(IN_PLACE, RESCUE_IN)
    k = used.groupBy(*ROW).agg(
        F.count(F.lit(1)).alias("n"), count_if(F.col("code") == DNA_ABSENT).alias("a"), count_if(good).alias("i"),
        count_if(F.col("code") == DNA_PRESENT).alias("p"), count_if((F.col("code") == DNA_PRESENT) & F.col("_common")).alias("pc"))
    label = (F.when(F.col("a") / F.col("n") >= empty_frac, "empty").when(F.col("i") == F.col("n"), "full")
             .when(F.col("i") + F.col("p") == F.col("n"), F.when(F.col("pc") == 0, "variable_gap").otherwise("model_difference"))
             .otherwise("partial"))
    changed = k.select(*ROW, label.alias("row_class")).join(code_strings(new), ROW)
    return rows.join(touched, ROW, "left_anti").select(*ROW, "row_class", "codes").unionByName(changed)


def gene_coverage(hsps: DataFrame, genes: DataFrame, min_identity: float = 90.0, min_share: float = 0.8) -> DataFrame:
    """Covered share of each gene from sequence matches of enough identity; present at ``min_share``.

    Matches are clipped to the gene before their union is measured.
    """
    from genespark.operators.ordered import interval_union
    key = ["locus_id", "short", "col"]
    m = hsps.where(F.col("pident") >= min_identity).join(genes, ["locus_id", "col"]).select(
        *key, F.greatest("qstart", "g_start").alias("a"), F.least("qend", "g_end").alias("b")).where(F.col("a") <= F.col("b"))
    cov = interval_union(m, key, "a", "b", "covered")
    every = hsps.select(*key).distinct().join(genes, ["locus_id", "col"])
    share = F.coalesce(F.col("covered"), F.lit(0)) / (F.col("g_end") - F.col("g_start") + 1)
    return every.join(cov, key, "left").select(*key, share.alias("share"), F.when(share >= min_share, "present").otherwise(
        "absent").alias("call"))


def dna_targets(rows: DataFrame, pairs: DataFrame, positions: DataFrame, cols: DataFrame, genes: DataFrame) -> DataFrame:
    """Per strain to check, the target span between the innermost in-place flank copies in base pairs.

    Spans under 50 bp count as absent; flanks without coordinates stay unchecked. Of genes
    that begin at one place the longest gives the end.
    """
    need = rows.where(F.col("row_class").isin("partial", "empty")).select(*ROW).join(pairs, ROW)
    ends = genes.groupBy("short", "contig", "start").agg(F.max("end").alias("end"))
    at = lambda c, out: positions.select("short", "contig", "rank", "start").join(ends, ["short", "contig", "start"], "left").select(
        "short", "contig", F.col("rank").alias(c), F.col("start").alias(f"{out}_start"), F.col("end").alias(f"{out}_end"))
    out = need.join(at("lower", "l"), ["short", "contig", "lower"], "left").join(at("upper", "u"), ["short", "contig", "upper"], "left")
    n = F.col("u_end") - F.col("l_start") + 1
    return out.select(*ROW, "contig", F.col("l_start").alias("start"), F.col("u_end").alias("end"), F.when(n.isNull(), "unchecked").when(
        n < 50, "absent").otherwise("check").alias("status")).distinct()


def locus_rows(
    exemplar: DataFrame, cols: DataFrame, classes: DataFrame, ranks: DataFrame, bins: DataFrame, domain_class: DataFrame
) -> DataFrame:
    """One row per locus: exemplar span, ordered columns with bin and class, class counts and ranks."""
    item = F.struct("col", "family", F.coalesce("bin", F.lit("-")).alias("bin"),
                    F.coalesce("dominant_class", F.lit("unannotated")).alias("cls"))
    lists = cols.join(bins.select("family", "bin"), "family", "left").join(domain_class, "family", "left").groupBy(
        "locus_id").agg(F.array_sort(F.collect_list(item)).alias("x"))
    join = lambda f: F.array_join(F.transform("x", lambda s: s[f]), ",")
    n = classes.groupBy("locus_id").agg(*[count_if(F.col("row_class") == c).alias(f"n_{c}") for c in ("full", "partial", "empty")])
    return exemplar.join(lists, "locus_id").join(n, "locus_id", "left").join(ranks, "locus_id", "left").withColumn(
        "families", join("family")).withColumn("bins", join("bin")).withColumn("classes", join("cls")).drop("x")
