"""Are the genes of a module closer on the contig than random genes of the same strain?"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genespark.functions.exprs import count_if, ratio
from genespark.operators import strips
from genespark.operators.joins import split_join
from genespark.operators.ordered import rank_within
from genespark.session import materialize

UNIT = ["module_id", "short", "perm"]
COUNTS = ["total", "cross_contig", "adjacent", "informative", "colocalized"]


def pair_counts(genes: DataFrame, max_bp: int = 100_000, min_gap: int = 11) -> DataFrame:
    """Gene pairs per (module, strain, perm), same-family pairs left out.

    ``informative`` pairs lie on one contig at least ``min_gap`` ranks apart,
    ``colocalized`` ones also within ``max_bp``. Every count is made of frames
    that start at the first row, so each is one pass, minus the same count inside
    the family; no pair is built.
    """
    def frames(group):
        by_rank = Window.partitionBy(*group).orderBy("rank")
        by_start = Window.partitionBy(*group).orderBy("start")
        n = F.count(F.lit(1))
        upto = lambda k: n.over(by_rank.rangeBetween(Window.unboundedPreceding, k))
        every = n.over(Window.partitionBy(*group))
        far, later = every - upto(min_gap - 1), every - upto(-1)
        near_bp = n.over(by_start.rangeBetween(Window.unboundedPreceding, max_bp)) - upto(min_gap - 1)
        return later - 1, far, F.greatest(F.lit(0), near_bp)
    same, far, near = frames([*UNIT, "contig"])
    f_same, f_far, f_near = frames([*UNIT, "contig", "family"])
    rows = genes.select(*UNIT, "contig", "family", "rank", (same - f_same).alias("s"), (far - f_far).alias("i"),
                        (near - f_near).alias("c"))
    fam = rows.groupBy(*UNIT, "family").agg(F.count(F.lit(1)).alias("n"), F.sum("s").alias("s"), F.sum("i").alias("i"),
                                            F.sum("c").alias("c"))
    out = fam.groupBy(*UNIT).agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("ff"), F.sum("s").alias("same"),
        F.sum("i").alias("informative"), F.sum("c").alias("colocalized"))
    total = (F.col("n") * (F.col("n") - 1) / 2 - F.col("ff")).cast("bigint")
    return out.select(*UNIT, "n", total.alias("total"), (total - F.col("same")).alias("cross_contig"),
                      (F.col("same") - F.col("informative")).alias("adjacent"), "informative", "colocalized")


def draws(sizes: DataFrame, n_perm: int, seed: int) -> DataFrame:
    """``n`` different pool numbers per (module, strain, perm), seeded by the names alone.

    A sparse draw takes the first n different values of a keyed sequence of hashes
    modulo the pool's size; a dense one (over a quarter of the pool, or the rare
    sequence that repeats itself too often) the n numbers with the smallest keyed
    hashes. Either is a uniform sample without replacement and costs about n steps.
    """
    kind = sizes.schema["module_id"].dataType.simpleString()
    rows = sizes.select("module_id", "short", F.col("n").cast("bigint").alias("n"), F.col("pool").cast("bigint").alias("pool"),
                        _prefix(seed).alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                n = b["n"][i].as_py()
                idx = drawn(b["h"][i].as_py(), n, b["pool"][i].as_py(), n_perm)
                at = np.full(idx.size, i)
                yield pa.RecordBatch.from_arrays([b["module_id"].take(pa.array(at)), b["short"].take(pa.array(at)), pa.array(
                    np.repeat(np.arange(1, n_perm + 1, dtype="i4"), idx.shape[1])), pa.array(idx.reshape(-1))], ["module_id", "short", "perm", "idx"])
    return rows.mapInArrow(run, f"module_id {kind}, short string, perm int, idx bigint")


def _prefix(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "module_id", "short")


# Constants of XXH64, as in Spark's xxhash64.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, k: int) -> np.ndarray:
    return (x << np.uint64(k)) | (x >> np.uint64(64 - k))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


def _hashes(perm_hash: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``xxhash64`` of every value (a long) after each of the hashes: one row per hash."""
    v = _turn(values.astype("u8") * P2, 31) * P1
    return _mixed(_turn((perm_hash[:, None] + (P5 + np.uint64(8))) ^ v[None, :], 27) * P1 + P4).view("i8")


def _first_distinct(v: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Which values of each row are among its first n different ones, and the rows that have n."""
    order = np.argsort(v, axis=1, kind="stable")
    by = np.take_along_axis(v, order, 1)
    new = np.ones(v.shape, bool)
    new[:, 1:] = by[:, 1:] != by[:, :-1]
    first = np.empty(v.shape, bool)
    np.put_along_axis(first, order, new, 1)
    upto = np.cumsum(first, 1)
    return first & (upto <= n), upto[:, -1] >= n


def drawn(prefix: int, n: int, pool: int, n_perm: int) -> np.ndarray:
    """The ``n_perm`` draws of one (module, strain): rows of ``n`` pool numbers; see ``draws``."""
    start = np.array([prefix], "i8").view("u8")
    perm = np.arange(1, n_perm + 1, dtype="u8")
    with np.errstate(over="ignore"):
        keys = _mixed(_turn((start + (P5 + np.uint64(4))) ^ (perm * P1), 23) * P2 + P3)
        n = max(0, min(n, pool))
        out = np.empty((n_perm, n), "i8")
        if not n:
            return out
        todo = np.arange(n_perm)
        if 4 * n <= pool:
            most = 2 * n + 64
            for length in (min(most, n + n // 4 + 16), most):  # a start of the sequence is enough for nearly all
                v = np.mod(_hashes(keys[todo], np.arange(1, length + 1)), pool)
                picked, whole = _first_distinct(v, n)
                out[todo[whole]] = v[whole][picked[whole]].reshape(-1, n)
                todo = todo[~whole]
                if not len(todo):
                    return out
        step = max(1, (1 << 22) // pool)
        for i in range(0, len(todo), step):
            h = _hashes(keys[todo[i:i + step]], np.arange(pool))
            out[todo[i:i + step]] = np.argsort(h, axis=1, kind="stable")[:, :n]
    return out


def _frames(group: np.ndarray, rank: np.ndarray, start: np.ndarray, max_bp: int, min_gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row, ordered by group and rank: rows of the group later, at least ``min_gap`` ranks later, and of these within ``max_bp``."""
    n = len(group)
    new = np.ones(n, bool)
    new[1:] = group[1:] != group[:-1]
    no = np.cumsum(new) - 1
    end = np.append(np.flatnonzero(new)[1:], n)[no]
    same = new.copy()
    same[1:] |= rank[1:] != rank[:-1]
    first = np.maximum.accumulate(np.where(same, np.arange(n), 0))
    by_rank = no * (int(rank.max() - rank.min()) + min_gap + 2) + (rank - rank.min())
    by_start = no * (int(start.max() - start.min()) + max_bp + 2) + (start - start.min())
    upto = np.searchsorted(by_rank, by_rank + (min_gap - 1), "right")
    ordered = by_start if (by_start[1:] >= by_start[:-1]).all() else np.sort(by_start)
    near = np.searchsorted(ordered, by_start + max_bp, "right") - upto
    return end - first - 1, end - upto, np.maximum(near, 0)


def set_counts(contig: np.ndarray, family: np.ndarray, rank: np.ndarray, start: np.ndarray, sets: np.ndarray, max_bp: int, min_gap: int) -> np.ndarray:
    """``pair_counts`` of every row of ``sets`` (numbers of genes): n and the five counts of ``COUNTS``, one row per set."""
    k, n = sets.shape
    which = np.repeat(np.arange(k), n)

    def sums(*keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        order = np.lexsort((rank, *keys))
        place = np.empty(len(order), "i8")
        place[order] = np.arange(len(order))
        change = np.zeros(len(order), "i8")
        for key in keys:
            change[1:] |= key[order[1:]] != key[order[:-1]]
        group = np.cumsum(change)
        at = np.sort(place[sets], axis=1).reshape(-1)
        got = _frames(which * (group[-1] + 1) + group[at], rank[order[at]], start[order[at]], max_bp, min_gap)
        return [x.reshape(k, n).sum(1) for x in got], order[at]
    (same, far, near), _ = sums(contig)
    (f_same, f_far, f_near), at = sums(contig, family)
    fam = which * (int(family.max()) + 1) + family[at]
    new = np.ones(len(fam), bool)
    new[1:] = fam[1:] != fam[:-1]
    size = np.diff(np.append(np.flatnonzero(new), len(fam)))
    ff = np.bincount(which[new], weights=size * (size - 1) // 2, minlength=k).astype("i8")
    total = n * (n - 1) // 2 - ff
    same, far, near = same - f_same, far - f_far, near - f_near
    return np.stack([np.full(k, n), total, total - same, same - far, far, near], 1)


def unit_sums(rows: DataFrame, kind: str, n_perm: int, max_bp: int, min_gap: int) -> DataFrame:
    """Per (module, perm) partial sums over strains of what ``pair_counts`` gives per strain; perm 0 is the observation.

    ``rows`` hold a strain's units (module, its prefix, n, pool), the genes of its
    pool, the modules' own genes beyond it, and the modules' genes. A draw is a row of
    numbers in a task, never a row of a table.
    """
    names = ["strains_scored", "member_genes", *COUNTS]

    def of(t: pa.Table) -> Iterator[pa.RecordBatch]:
        code = lambda c: t[c].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy().astype("i8")
        number = lambda c: t[c].fill_null(0).to_numpy()
        s, contig, family, what = code("short"), code("contig"), code("family") + 1, t["kind"].to_numpy()
        rank, idx, n, pool, h, module = (number(c) for c in ("rank", "idx", "n", "pool", "h", "module_id"))
        start = t["start"]
        low = pc.min(start).as_py() or 0
        start = start.fill_null(low - max_bp - 1).to_numpy()  # unplaced genes come first, and only they are near each other
        bound = np.searchsorted(s * 4 + what, np.arange(4 * (int(s[-1]) + 1) + 1))
        sums: dict[int, np.ndarray] = {}
        for strain in range(int(s[-1]) + 1):
            units, base, extra, own = (np.arange(bound[4 * strain + k], bound[4 * strain + k + 1]) for k in range(4))
            base = base[np.argsort(idx[base], kind="stable")]
            for u in units:
                mine, more = own[module[own] == module[u]], extra[module[extra] == module[u]]
                sets = drawn(h[u], int(n[u]), int(pool[u]), n_perm)
                add = sums.setdefault(int(module[u]), np.zeros((n_perm + 1, 7), "i8"))
                for first, genes, asked in ((0, mine, np.arange(len(mine))[None, :]), (1, np.concatenate(
                        [base, more[np.argsort(idx[more], kind="stable")]]), sets)):
                    if asked.size:
                        got = set_counts(contig[genes], family[genes], rank[genes], start[genes], asked, max_bp, min_gap)
                        add[first:first + len(got), 0] += 1
                        add[first:first + len(got), 1:] += got
        for m, v in sums.items():
            some = np.flatnonzero(v[:, 0])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), m)).cast({"int": pa.int32(), "bigint": pa.int64()}[kind]), pa.array(some.astype("i4")), *[
                pa.array(v[some, i]) for i in range(7)]], ["module_id", "perm", *names])
    got = strips.by_strain(rows, of, f"module_id {kind}, perm int, " + ", ".join(f"{x} bigint" for x in names))
    return got.groupBy("module_id", "perm").agg(*[F.sum(x).cast("bigint").alias(x) for x in names])


def score_modules(
    genes: DataFrame, modules: DataFrame, accessory: DataFrame, max_kb: float = 100, min_gap: int = 11, n_perm: int = 200,
    seed: int = 0,
) -> DataFrame:
    """Observed and null co-location per module.

    ``genes``: every gene with short, contig, rank, start, family. The pool of a
    strain is its accessory genes and the module's own ones.
    """
    g = materialize(genes.select("short", "contig", "rank", "start", "family"))
    mine = split_join(g, modules.select("family", "module_id"), ["family"])
    size = mine.groupBy("module_id", "short").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 2)
    acc = accessory.select("family", F.lit(1).alias("_a")).distinct()
    order = [F.col("contig"), F.col("rank")]
    pool = materialize(rank_within(g.join(acc, "family", "left_semi"), ["short"], order, "idx"))
    base = pool.groupBy("short").agg(F.count(F.lit(1)).alias("_p"))
    extra = rank_within(mine.join(acc, "family", "left_anti"), ["module_id", "short"], order, "_x")
    extra = materialize(extra.join(base, "short", "left").withColumn("idx", F.coalesce("_p", F.lit(0)) + F.col("_x")).drop("_p", "_x"))
    more = extra.groupBy("module_id", "short").agg(F.count(F.lit(1)).alias("_e"))
    sizes = size.join(base, "short", "left").join(more, ["module_id", "short"], "left").select(
        "module_id", "short", "n", (F.coalesce("_p", F.lit(0)) + F.coalesce("_e", F.lit(0))).alias("pool"))
    kind = modules.schema["module_id"].dataType.simpleString()
    types = {"module_id": kind, "contig": "string", "family": "string", "rank": "bigint", "start": "bigint", "idx": "bigint",
             "n": "bigint", "pool": "bigint", "h": "bigint"}
    part = lambda df, no: df.select("short", F.lit(no).alias("kind"), *[
        (F.col(c) if c in df.columns else F.lit(None)).cast(v).alias(c) for c, v in types.items()])
    of_strain = [sizes.withColumn("h", _prefix(seed)), pool, extra, mine]
    parts = [part(df.where(F.col("module_id").isNotNull()) if "module_id" in df.columns else df, i) for i, df in enumerate(of_strain)]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    per = materialize(unit_sums(rows, kind, n_perm, int(round(max_kb * 1000)), min_gap))
    obs = per.where(F.col("perm") == 0).drop("perm")
    out = obs
    for den, tag in (("informative", ""), ("total", "_total")):
        o = obs.select("module_id", ratio(F.col("colocalized"), F.col(den)).alias("o"))
        nul = per.where((F.col("perm") > 0) & (F.col(den) > 0)).withColumn("v", F.col("colocalized") / F.col(den)).join(o, "module_id")
        st = nul.groupBy("module_id").agg(
            F.avg("v").alias(f"null_mean_frac{tag}"), F.stddev_samp("v").alias(f"null_sd_frac{tag}"),
            ((1 + count_if(F.col("v") >= F.col("o"))) / (1 + F.count(F.lit(1)))).alias("_p"))
        out = out.join(o.withColumnRenamed("o", f"obs_frac{tag}"), "module_id").join(st, "module_id", "left").withColumn(
            f"p_empirical{tag}", F.when(F.col(f"obs_frac{tag}").isNotNull(), F.col("_p"))).withColumn(
            f"effect_ratio{tag}", ratio(F.col(f"obs_frac{tag}"), F.col(f"null_mean_frac{tag}"))).drop("_p")
    return out
