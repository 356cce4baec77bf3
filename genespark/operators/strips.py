"""Locus columns read strain by strain: cells and flank pairs from one pass over a strain's genes.

Rows of whole strains come together, ordered by contig and rank, in bounded Arrow batches.
A gene is a row once, however many loci its family belongs to; each locus picks the genes of
its families by their numbers. The columns of all loci (a few dozen each) are known to every task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ABSENT, IN_PLACE, ELSEWHERE, RESCUE_IN, RESCUE_OUT, BREAK = range(6)
SPAN, STATE, GENE = range(3)
ROWS = 1 << 18  # rows of whole strains that are read at once, more only for a single larger strain
OUT = 1 << 16
NONE = np.iinfo("i8").max


def by_strain(rows: DataFrame, of: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``of`` on tables of whole strains, ordered by strain, kind, contig and rank."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, limit = [], 0, ROWS
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n < limit:
                continue
            t = pa.Table.from_batches(held)
            cut = pc.index(pc.equal(t["short"], t["short"][-1]), True).as_py()
            if cut:
                yield from of(t.slice(0, cut))
            held, n = t.slice(cut).to_batches(), t.num_rows - cut
            limit = max(ROWS, 2 * n)
        if n:
            yield from of(pa.Table.from_batches(held))
    return rows.where(F.col("short").isNotNull()).repartition("short").sortWithinPartitions("short", "kind", "contig", "rank").mapInArrow(run, schema)


def _codes(names: pa.ChunkedArray) -> tuple[np.ndarray, list]:
    """Numbers of the names in their byte order, -1 for null."""
    d = names.combine_chunks().dictionary_encode()
    values = d.dictionary.to_pylist()
    order = sorted(range(len(values)), key=values.__getitem__)
    at = np.empty(len(values) + 1, "i8")
    at[order], at[-1] = np.arange(len(values)), -1
    return at[d.indices.fill_null(len(values)).to_numpy()], [values[i] for i in order]


def _named(at: np.ndarray, names: list) -> pa.Array:
    return pa.DictionaryArray.from_arrays(pa.array(at, pa.int32()), pa.array(names, pa.string())).cast(pa.string())


class Loci:
    """Columns of every locus, with families as numbers."""

    def __init__(self, cols: DataFrame):
        rows = cols.where(F.col("locus_id").isNotNull()).select("locus_id", "col", "family", "part").collect()
        self.families = sorted({r.family for r in rows if r.family is not None})
        no = {f: i for i, f in enumerate(self.families)}
        by: dict[str, list] = {}
        for r in rows:
            by.setdefault(r.locus_id, []).append((r.col, -1 if r.family is None else no[r.family], r.part))
        self.names = sorted(by)
        self.parts = sorted({r.part for r in rows})
        self.loci = []
        for i, name in enumerate(self.names):
            col, fam, part = (np.array(x) for x in zip(*by[name]))
            own = np.unique(fam[fam >= 0])
            self.loci.append((i, col, fam, np.searchsorted(self.parts, part), own))


class Strains:
    """The genes of some whole strains: strain, contig, family, rank and the group (strain, contig), in this order."""

    def __init__(self, t: pa.Table, loci: Loci):
        s, self.shorts = _codes(t["short"])
        c, self.contigs = _codes(t["contig"])
        kind = t["kind"].to_numpy()
        f = pc.index_in(t["family"], value_set=pa.array(loci.families, pa.string())).fill_null(-1).to_numpy()
        self.n, self.width = len(self.shorts), len(self.contigs) + 1
        self.all = (s, c, f, kind)
        gene = (kind == GENE) & (f >= 0)
        self.s, self.c, self.f = s[gene], c[gene], f[gene]
        self.r = t["rank"].filter(pa.array(gene)).to_numpy().astype("i8")
        self.group = self.s * self.width + self.c + 1
        self.order = np.argsort(self.f, kind="stable")
        self.bounds = np.searchsorted(self.f[self.order], np.arange(len(loci.families) + 1))

    def of(self, families: np.ndarray) -> np.ndarray:
        """Places of the genes of some families, in order."""
        return np.sort(np.concatenate([self.order[self.bounds[i]:self.bounds[i + 1]] for i in families])) if len(families) else self.order[:0]

    def gaps(self, at: np.ndarray, k: int) -> np.ndarray:
        """Ranks to the nearest gene of another family on the contig among ``at``; k + 1 where it is farther or none."""
        g, f, r = self.group[at], self.f[at], self.r[at]
        n = len(at)
        if not n:
            return r
        new = np.ones(n, bool)
        new[1:] = (g[1:] != g[:-1]) | (f[1:] != f[:-1])
        starts = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        up = starts[run] - 1
        down = np.append(starts[1:], n)[run]
        a, b = np.full(n, k + 1), np.full(n, k + 1)
        ok = (up >= 0) & (g[up] == g)
        a[ok] = r[ok] - r[up[ok]]
        ok = (down < n) & (g[np.minimum(down, n - 1)] == g)
        b[ok] = r[down[ok]] - r[ok]
        out = np.minimum(np.minimum(a, b), k + 1)
        out[self.c[at] < 0] = k + 1
        return out


def _first(key: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
    """Per key its smallest (value, place) as value * n + place; NONE where a key has nothing."""
    out = np.full(size, NONE)
    np.minimum.at(out, key, value * len(key) + np.arange(len(key)))
    return out


def _span_ends(t: pa.Table, x: Strains, k: int) -> np.ndarray:
    """Whether each gene lies at most ``k`` ranks from an end of its contig."""
    s, c, _, kind = x.all
    is_span = kind == SPAN
    key = (s * x.width + c + 1)[is_span]
    low, high = (t[n].filter(pa.array(is_span)).fill_null(NONE >> 2).to_numpy().astype("i8") for n in ("rank", "last"))
    known = c[is_span] >= 0
    key, low, high = key[known], low[known], high[known]
    if not len(key):
        return np.zeros(len(x.s), bool)
    at = np.minimum(np.searchsorted(key, x.group), len(key) - 1)
    return (key[at] == x.group) & ((x.r - low[at] <= k) | (high[at] - x.r <= k))


def _states(t: pa.Table, x: Strains, n_families: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys strain * families + family that have calls, their first call, how many, and all calls (0 null, 1, 2 genome_only)."""
    s, _, f, kind = x.all
    mine = (kind == STATE) & (f >= 0)
    key = s[mine] * n_families + f[mine]
    state = t["state"].filter(pa.array(mine))
    v = np.where(state.is_valid().to_numpy(), 1 + pc.equal(state, "genome_only").fill_null(False).to_numpy().astype("i8"), 0)
    order = np.argsort(key, kind="stable")
    keys, first, count = np.unique(key[order], return_index=True, return_counts=True)
    return keys, first, count, v[order]


def cell_states(cols: DataFrame, positions: DataFrame, matrix: DataFrame, spans: DataFrame, k: int) -> DataFrame:
    """Cells (locus_id, short, col, family, part, base, code as numbers in text) of every strain with a copy or a call of a locus."""
    loci = Loci(cols)
    none = lambda kind: F.lit(None).cast(kind)
    rows = positions.select("short", F.lit(GENE).alias("kind"), "contig", "family", F.col("rank").cast("bigint").alias("rank"),
                            none("bigint").alias("last"), none("string").alias("state"))
    rows = rows.unionByName(matrix.select("short", F.lit(STATE).alias("kind"), none("string").alias("contig"), "family",
                                          none("bigint").alias("rank"), none("bigint").alias("last"), "state"))
    rows = rows.unionByName(spans.select("short", F.lit(SPAN).alias("kind"), "contig", none("string").alias("family"),
                                         F.col("first_rank").cast("bigint").alias("rank"), F.col("last_rank").cast("bigint").alias("last"), none("string").alias("state")))
    kind = cols.schema["col"].dataType.simpleString()
    small = {"int": pa.int32(), "bigint": pa.int64()}[kind]

    def of(t: pa.Table) -> Iterator[pa.RecordBatch]:
        x = Strains(t, loci)
        end = _span_ends(t, x, k)
        keys, first_call, calls, call = _states(t, x, len(loci.families))
        parts, size = [], 0
        for locus in loci.loci:
            made = _cells(x, end, (keys, first_call, calls, call), locus, len(loci.families), k)
            parts.append(made)
            size += len(made[0])
            if size >= ROWS:
                yield from out(parts, x)
                parts, size = [], 0
        yield from out(parts, x)

    def out(parts: list, x: Strains) -> Iterator[pa.RecordBatch]:
        if not sum(len(p[0]) for p in parts):
            return
        lo, s, col, fam, part, base, code = (np.concatenate(c) for c in zip(*parts))
        digit = [str(i) for i in range(6)]
        family = _named(np.where(fam < 0, len(loci.families), fam), [*loci.families, None])
        b = pa.RecordBatch.from_arrays([_named(lo, loci.names), _named(s, x.shorts), pa.array(col, small), family, _named(part, loci.parts),
                                        _named(base, digit), _named(code, digit)], ["locus_id", "short", "col", "family", "part", "base", "code"])
        for i in range(0, b.num_rows, OUT):
            yield b.slice(i, OUT)
    return by_strain(rows, of, f"locus_id string, short string, col {kind}, family string, part string, base string, code string")


def _cells(x: Strains, end: np.ndarray, states: tuple, locus: tuple, n_families: int, k: int) -> tuple[np.ndarray, ...]:
    no, col, fam, part, own = locus
    m = len(own)
    at = x.of(own)
    n = max(len(at), 1)
    key = x.s[at] * m + np.searchsorted(own, x.f[at])
    best = _first(key, x.gaps(at, k), x.n * m).reshape(x.n, m)
    have = best != NONE
    placed = have & (best // n <= k)
    ends = np.zeros((x.n, m), bool)
    ends[placed] = end[at[best[placed] % n]]
    keys, first_call, calls, call = states
    asked = np.arange(x.n)[:, None] * n_families + own
    where = np.minimum(np.searchsorted(keys, asked), max(len(keys) - 1, 0))
    told = (keys[where] == asked) if len(keys) else np.zeros(asked.shape, bool)
    some = np.flatnonzero((have | told).any(1))
    have, placed, ends, where, told = have[some], placed[some], ends[some], where[some], told[some]
    # columns of the first and last families that are in place; each column has one family
    low = np.array([col[fam == f].min() for f in own], "i8")
    high = np.array([col[fam == f].max() for f in own], "i8")
    line = np.arange(len(some))
    if m and len(some):
        a = np.where(placed, low, NONE).argmin(1)
        b = np.where(placed, high, -NONE).argmax(1)
        any_ = placed.any(1)
        off = ((col < low[a][:, None]) & (any_ & ends[line, a])[:, None]) | ((col > high[b][:, None]) & (any_ & ends[line, b])[:, None])
    else:
        off = np.zeros((len(some), len(col)), bool)
    j = np.searchsorted(own, fam)
    pick = lambda v: np.where(fam >= 0, v[:, np.minimum(j, m - 1)], False) if m else np.zeros((len(some), len(col)), bool)
    have, placed, told = pick(have), pick(placed), pick(told)
    n_calls = np.where(told, calls[where[:, np.minimum(j, m - 1)]], 1) if len(keys) and m else np.ones(told.shape, "i8")
    begin = np.where(told, first_call[where[:, np.minimum(j, m - 1)]], 0) if len(keys) and m else np.zeros(told.shape, "i8")
    shape, reps = told.shape, n_calls.reshape(-1)  # a cell with several calls is several rows
    flat = lambda v: np.repeat(np.broadcast_to(v, shape).reshape(-1), reps)
    step = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
    have, placed, told, off = flat(have), flat(placed), flat(told), flat(off)
    state = np.where(told, call[flat(begin) + step], 0) if len(call) else np.zeros(len(told), "i8")
    shown = np.where(placed, IN_PLACE, np.where(have | (state > 0), ELSEWHERE, ABSENT))
    base = np.where(have, shown, ABSENT)
    code = np.where((state == 2) & (shown != ABSENT), np.where(shown == IN_PLACE, RESCUE_IN, RESCUE_OUT), shown)
    code = np.where(off & ((code == ABSENT) | (code == ELSEWHERE)), BREAK, code)
    return np.full(len(code), no), flat(some[:, None]), flat(col), flat(fam), flat(part), base, code


def flank_pairs(cols: DataFrame, positions: DataFrame, k: int) -> DataFrame:
    """Closest in-place copies of both flanks on one contig within n_locus + 2k ranks: (locus_id, short, contig, lower, upper)."""
    loci = Loci(cols)
    rows = positions.select("short", F.lit(GENE).alias("kind"), "contig", "family", F.col("rank").cast("bigint").alias("rank"))

    def of(t: pa.Table) -> Iterator[pa.RecordBatch]:
        x = Strains(t, loci)
        made = [y for y in (_pairs(x, locus, loci.parts, k) for locus in loci.loci) if len(y[0])]
        if not made:
            return
        lo, s, c, lower, upper = (np.concatenate(v) for v in zip(*made))
        b = pa.RecordBatch.from_arrays([_named(lo, loci.names), _named(s, x.shorts), _named(c, x.contigs), pa.array(lower, pa.int64()), pa.array(
            upper, pa.int64())], ["locus_id", "short", "contig", "lower", "upper"])
        for i in range(0, b.num_rows, OUT):
            yield b.slice(i, OUT)
    return by_strain(rows, of, "locus_id string, short string, contig string, lower bigint, upper bigint")


def _pairs(x: Strains, locus: tuple, parts: list, k: int) -> tuple[np.ndarray, ...]:
    no, _, fam, part, own = locus
    is_ = lambda name: np.array([((fam == f) & (part == parts.index(name))).any() if name in parts else False for f in own], bool)
    span = int((part == parts.index("locus")).sum() if "locus" in parts else 0) + 2 * k
    at = x.of(own)
    at = at[x.gaps(at, k) <= k]
    side = np.searchsorted(own, x.f[at])
    left, right = is_("left")[side], is_("right")[side]
    keep = left | right
    at, left, right = at[keep], left[keep], right[keep]
    if not len(at):
        return (at,) * 5
    g, r, place = x.group[at], x.r[at], np.arange(len(at))

    def last(flag: np.ndarray, asks: np.ndarray) -> np.ndarray:
        before = np.maximum.accumulate(np.where(flag, place, -1))
        ok = asks & (before >= 0) & (g[before] == g)
        return np.where(ok, r[before], -NONE)
    lower = np.maximum(last(left, right), last(right, left))
    found = lower != -NONE
    found[found] = r[found] - lower[found] <= span
    at, lower, r = at[found], lower[found], r[found]
    if not len(at):
        return (at,) * 5
    best = _first(x.s[at], r - lower, x.n)
    best = best[best != NONE] % len(at)
    return np.full(len(best), no), x.s[at[best]], x.c[at[best]], lower[best], r[best]
