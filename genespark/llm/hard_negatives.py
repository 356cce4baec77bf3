"""Hard negatives: rows of another label that score almost as high as an anchor's own positives.

Anchors are clustered by direction. A batch is a number of anchors of one cluster
with their mean direction c and the largest angle t between c and a member. For a
candidate x at angle s from c no member a scores above |a| |x| cos(max(0, s - t)).
A tile of candidates is sorted by |x| cos(max(0, s - t)) once per batch; every
member walks this one list and stops where |a| times the bound is below what it
still needs: its k-th positive, or the larger of its window's lower end and its
k-th negative. A first walk through the tile of the batch's own cluster gives each
member a floor, which all other tiles start from.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genespark.llm import blocks
from genespark.session import materialize

POSITIVES = NEGATIVES = 5
CLUSTERS, SAMPLE, STEPS = 64, 8192, 8  # directions; anchors they are fitted on, at most; rounds of fitting
BATCH, TILE = 256, 16_384  # anchors of a batch, candidates of a tile
BATCHES = 32  # batches that meet a tile in one task
STEP = 512  # places of the list that are scored at a time, at first
EXACT = float(1 << 53)
LOWEST = -np.iinfo("i8").max
MOST = np.iinfo("i8").max - 1  # a score beyond a long is held at its end
NOBODY = np.iinfo("i8").max
SLACK = 1e-7  # of angles and, per unit of length, of bounds, against rounding


def scaled_rows(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(row, vec_id, label, v): v = floor(scale * x) per component, as exact doubles; ``row`` tells repeated rows apart.

    Rows with a null label or vector, or a null, NaN or infinite component, are
    left out, finite ones of any size stay. Written once, so that ``row`` is fixed.
    """
    x = F.transform("embedding", lambda c: c.cast("double"))
    whole = lambda c: F.when(F.abs(c) < float(1 << 52), F.floor(c * float(scale)).cast("double")).otherwise(c * float(scale))
    fit = F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.exists(
        x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.where(fit).select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), F.transform(x, whole).alias("v"))
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()).select("row", "vec_id", "label", "v"))


def _unit(m: np.ndarray) -> np.ndarray:
    """Rows at length 1; those of length 0 stay."""
    m = m / np.maximum(np.abs(m).max(axis=1, initial=0, keepdims=True), 1e-300)  # no overflow in the squares
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n > 0, n, 1)


def _lengths(m: np.ndarray) -> np.ndarray:
    most = np.abs(m).max(axis=1, initial=0)
    return most * np.linalg.norm(m / np.where(most > 0, most, 1)[:, None], axis=1)


def directions(anchors: DataFrame, clusters: int = CLUSTERS, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Directions of clusters per vector length, by spherical k-means on about ``sample`` anchors, drawn by hash of their number."""
    n = max(anchors.count(), 1)
    # Drawn by hash; the limit only guards the driver against an unlucky draw.
    some = anchors.where(F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < int(min(1, sample / n) * (1 << 20))).orderBy("row").limit(2 * sample)
    by_width: dict[int, list] = {}
    for r in some.select("v").toLocalIterator():
        by_width.setdefault(len(r.v), []).append(r.v)
    out = {}
    for width, rows in by_width.items():
        m = _unit(np.array(rows, "f8").reshape(len(rows), width))
        k = max(1, min(clusters, len(m) // 4))
        c = m[np.linspace(0, len(m) - 1, k).astype(int)]
        for _ in range(STEPS):
            at = (m @ c.T).argmax(axis=1)
            total = np.zeros_like(c)
            np.add.at(total, at, m)
            c = np.where(np.bincount(at, minlength=k)[:, None] > 0, _unit(total), c)
        out[width] = c
    return out


def _assign(centres: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
            cluster = np.zeros(batch.num_rows, "i4")
            for w in np.unique(size).tolist():
                at = np.flatnonzero(size == w)
                if w in centres:
                    cluster[at] = (_unit(_matrix(batch.column("v").take(pa.array(at)), w)) @ centres[w].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size.astype("i4")), pa.array(cluster)], [*batch.schema.names, "width", "cluster"])
    return run


def _matrix(lists, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)


PACKED = "number bigint, cluster int, width int, payload binary"


def _pack(size: int):
    """Sorted rows -> payloads of at most ``size`` rows of one width (and batches of one cluster, where there is one)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, key = 0, [], None

        def out():
            nonlocal made
            table = pa.Table.from_batches(held).combine_chunks()
            cols = {n: table[n].combine_chunks() for n in table.schema.names if n not in ("v", "cluster", "width")}
            m = _matrix(table["v"].combine_chunks(), key[0])
            most = np.abs(m).max(initial=0)
            kind = "i1" if most < 128 else "i2" if most < 1 << 15 else "f8"
            payload = blocks.pack(**{n: pa.array([c.to_pylist()]) if pa.types.is_list(c.type) else [c.to_numpy(zero_copy_only=False)] for n, c in cols.items()},
                                  v=[m.astype(kind).reshape(-1)])
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([blocks.block_number(made)], pa.int64()), pa.array([key[1]], pa.int32()), pa.array([key[0]], pa.int32()), pa.array([payload], pa.binary())],
                ["number", "cluster", "width", "payload"])

        for batch in batches:
            w, c = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("width", "cluster"))
            edges = np.flatnonzero((w[1:] != w[:-1]) | (c[1:] != c[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
                if a == b:
                    continue
                if held and key != (int(w[a]), int(c[a])):
                    yield out()
                    held = []
                key = int(w[a]), int(c[a])
                while a < b:
                    room = size - sum(h.num_rows for h in held)
                    held.append(batch.slice(a, min(room, b - a)))
                    a += min(room, b - a)
                    if sum(h.num_rows for h in held) == size:
                        yield out()
                        held = []
        if held:
            yield out()
    return run


class Packed:
    """A payload's columns as arrays; ``v`` is a matrix."""

    def __init__(self, data: bytes, width: int):
        t = blocks.unpack(data)
        for n in t.schema.names:
            c = t[n].combine_chunks().flatten()
            setattr(self, n, np.array(c.to_pylist()) if pa.types.is_list(c.type) else c.to_numpy(zero_copy_only=False))
        self.v = self.v.reshape(-1, width) if width else np.zeros((len(self.row), 0))


def _merge(score: np.ndarray, *ids: np.ndarray, k: int) -> list[np.ndarray]:
    """Best k of each row: highest score, then smallest ids."""
    order = np.lexsort((*ids[::-1], -score), axis=1)[:, :k]
    return [np.take_along_axis(x, order, 1) for x in (score, *ids)]


def _whole(m: np.ndarray) -> np.ndarray:
    """Whole doubles as Python integers."""
    return np.frompyfunc(int, 1, 1)(m) if m.size else m.astype(object)


def scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, as longs; beyond a long they are held at its end."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(a.shape[1], 1)
    if most < EXACT:
        return (a.astype("f8") @ x.astype("f8").T).astype("i8")
    return np.clip(_whole(a.astype("f8")) @ _whole(x.astype("f8")).T, -MOST, MOST).astype("i8")


def shared_list(members: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, bound): candidates by falling angular bound for all ``members``; a member's score is at most its length times the bound."""
    units = _unit(members.astype("f8"))
    centre = _unit(units.mean(axis=0, keepdims=True))[0]
    reach = float(np.arccos(np.clip(units @ centre, -1, 1)).max(initial=0)) + SLACK
    candidates = candidates.astype("f8")
    length = _lengths(candidates)
    angle = np.arccos(np.clip(_unit(candidates) @ centre, -1, 1)) - SLACK
    bound = length * (np.cos(np.clip(angle - reach, 0, math.pi)) + SLACK)
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


class Positives:
    """The k best rows of the anchor's own label."""

    columns = ["anchor", "vec_id", "row", "score"]

    def __init__(self, a: Packed, k: int):
        self.a, self.k = a, k
        self.best = np.full((len(a.row), k), LOWEST)
        self.ids, self.rows = np.full((len(a.row), k), NOBODY), np.full((len(a.row), k), NOBODY)

    def floor(self) -> np.ndarray:
        return np.maximum(self.best[:, -1], self.a.floor.reshape(len(self.a.row), -1)[:, 0])

    def take(self, who: np.ndarray, score: np.ndarray, x: Packed, at: np.ndarray) -> None:
        a = self.a
        other = (x.label[at][None, :] != a.label[who][:, None]) | (x.row[at][None, :] == a.row[who][:, None])
        score = np.where(other | (score < a.floor.reshape(len(a.row), -1)[who]), LOWEST, score)
        every = [np.broadcast_to(v[at], score.shape) for v in (x.vec_id, x.row)]
        self.best[who], self.ids[who], self.rows[who] = _merge(
            np.hstack([self.best[who], score]), np.hstack([self.ids[who], every[0]]), np.hstack([self.rows[who], every[1]]), k=self.k)

    def table(self) -> list[np.ndarray]:
        found = self.best > LOWEST
        return [np.repeat(self.a.row, found.sum(axis=1)), self.ids[found], self.rows[found], self.best[found]]


class Negatives:
    """For each of the anchor's positives, the k best rows of other labels within the window below the positive's score."""

    columns = ["anchor", "place", "vec_id", "row", "score"]

    def __init__(self, a: Packed, k: int):
        self.a, self.k = a, k
        self.top = a.top.reshape(len(a.row), -1)  # score of each positive; LOWEST where there is none
        self.least = a.floor.reshape(len(a.row), -1)
        self.best = np.full((*self.top.shape, k), LOWEST)
        self.ids, self.rows = np.full(self.best.shape, NOBODY), np.full(self.best.shape, NOBODY)

    def floor(self) -> np.ndarray:
        # A positive below zero has an empty window, and needs nothing.
        need = np.where(self.top >= 0, np.maximum(self.best[:, :, -1], self.least), NOBODY)
        return need.min(axis=1)

    def take(self, who: np.ndarray, score: np.ndarray, x: Packed, at: np.ndarray) -> None:
        a = self.a
        own = x.label[at][None, :] == a.label[who][:, None]
        every = [np.broadcast_to(v[at], score.shape) for v in (x.vec_id, x.row)]
        for j in range(self.top.shape[1]):
            inside = ~own & (score <= self.top[who, j][:, None]) & (score >= self.least[who, j][:, None])
            some = np.flatnonzero(inside.any(axis=1))
            if not len(some):
                continue
            w, s = who[some], np.where(inside, score, LOWEST)[some]
            self.best[w, j], self.ids[w, j], self.rows[w, j] = _merge(
                np.hstack([self.best[w, j], s]), np.hstack([self.ids[w, j], every[0][some]]), np.hstack([self.rows[w, j], every[1][some]]), k=self.k)

    def table(self) -> list[np.ndarray]:
        found = self.best > LOWEST
        i, j, _ = np.nonzero(found)
        return [self.a.row[i], j, self.ids[found], self.rows[found], self.best[found]]


def walk(wanted: Positives | Negatives, x: Packed) -> int:
    """All members walk the list of one tile to their certified ends; how many (member, candidate) pairs were scored."""
    a = wanted.a
    order, bound = shared_list(a.v, x.v)
    length = _lengths(a.v.astype("f8"))
    at, step, scored = 0, STEP, 0
    active = np.arange(len(a.row))
    while at < len(order) and len(active):
        # A bound that overflowed certifies nothing.
        most = length[active] * bound[at]
        active = active[np.isnan(most) | (most + np.abs(most) * SLACK >= wanted.floor()[active])]
        if not len(active):
            break
        part = order[at:at + step]
        wanted.take(active, scores(a.v[active], x.v[part]), x, part)
        scored += len(active) * len(part)
        at, step = at + step, step * 2
    return scored


def _meet(kind, k: int):
    def run(key, tile: pa.Table, batches: pa.Table) -> pa.Table:
        tiles = [Packed(r["payload"], r["width"]) for r in tile.to_pylist()]
        out = [pa.table([pa.array([], pa.int64())] * len(kind.columns), kind.columns)]
        for r in batches.to_pylist() if tiles else []:
            wanted = kind(Packed(r["payload"], r["width"]), k)
            for x in tiles:
                if x.v.shape[1] == r["width"]:
                    walk(wanted, x)
            out.append(pa.table([pa.array(c.astype("i8")) for c in wanted.table()], kind.columns))
        return pa.concat_tables(out)
    return run


def _scan(tiles: DataFrame, anchors: DataFrame, kind, k: int, only_own: bool, n_batches: int) -> DataFrame:
    """What the walks of all batches through all tiles find, or only those through a tile of the batch's own cluster."""
    batches = materialize(anchors.repartitionByRange(n_batches, "width", "cluster", "row").sortWithinPartitions("width", "cluster", "row").mapInArrow(_pack(BATCH), PACKED))
    groups = max(1, math.ceil(n_batches / BATCHES))
    part = F.pmod(F.xxhash64("number"), F.lit(groups)).cast("int").alias("part")
    asked = batches.select(part, "width", "cluster", "payload")
    if only_own:
        own = tiles.groupBy("width", "cluster").agg(F.min("number").alias("tile"))
        right = asked.join(own, ["width", "cluster"]).select("tile", "part", "width", "payload")
        left = tiles.withColumnRenamed("number", "tile").join(right.select("tile", (F.col("part") + 0).alias("part")).distinct(), "tile").select("tile", "part", "width", "payload")
    else:
        # The stated anchors meet all rows, in blocks: a task has one shard of tiles and BATCHES batches, about.
        shard = F.shiftright("number", blocks.BLOCK_BITS)
        last = tiles.agg(F.max(shard).alias("m")).first()["m"] or 0
        right = asked.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last).cast("bigint"))).alias("tile"), "part", "width", "payload")
        left = tiles.select(shard.alias("tile"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), "width", "payload")
    found = left.groupBy("tile", "part").cogroup(right.groupBy("tile", "part")).applyInArrow(_meet(kind, k), ", ".join(f"{c} bigint" for c in kind.columns))
    return materialize(found)


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= k)


def _lists(scores: Column, at: Column, k: int, other: Column) -> Column:
    """Scores by place (from 1) as an array of ``k``; ``other`` at places without one."""
    got = F.map_from_entries(F.collect_list(F.struct(at, scores)))
    return F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: F.coalesce(F.try_element_at(got, i), other))


def mined(rows: DataFrame, anchors: DataFrame, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, low: tuple[int, int] = (4, 5)) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score for every anchor.

    ``rows`` comes from ``scaled_rows``, ``anchors`` is a part of it. An anchor's
    positives are its best ``n_positives`` other rows of its label; a positive's
    negatives the best ``n_negatives`` rows of other labels that score at most what
    it scores and at least ``low`` (numerator, denominator) of it. Scores are exact;
    ties go to the smaller vec_id. A repeated row is an anchor and a candidate of its
    own. Candidates of another length than the anchor's take no part. A positive
    without negatives, and so one below zero, has no row; empty tables give none.
    """
    centres = directions(anchors)
    layout = "row bigint, vec_id bigint, label bigint, v array<double>, width int, cluster int"
    ranged = lambda df, n: df.repartitionByRange(n, "width", "cluster", "row").sortWithinPartitions("width", "cluster", "row")
    placed = rows.select("row", "vec_id", "label", "v").mapInArrow(_assign(centres), layout)
    tiles = materialize(ranged(placed, max(1, math.ceil(rows.count() / TILE))).mapInArrow(_pack(TILE), PACKED))
    asked = materialize(anchors.select("row", "vec_id", "label", "v").mapInArrow(_assign(centres), layout))
    n_batches = max(1, math.ceil(asked.count() / BATCH))

    def with_floor(found: DataFrame) -> DataFrame:
        """Anchors with the score of the k-th positive so far."""
        kth = _best(found, ["anchor"], n_positives).where(F.col("_at") == n_positives).select(F.col("anchor").alias("row"), F.array("score").alias("floor"))
        return asked.join(kth, "row", "left").withColumn("floor", F.coalesce("floor", F.array(F.lit(LOWEST))))

    start = asked.withColumn("floor", F.array(F.lit(LOWEST)))
    first = _scan(tiles, start, Positives, n_positives, True, n_batches)
    positives = materialize(_best(_scan(tiles, with_floor(first), Positives, n_positives, False, n_batches), ["anchor"], n_positives))

    num, den = low
    tops = positives.groupBy(F.col("anchor").alias("row")).agg(_lists(F.col("score"), F.col("_at"), n_positives, F.lit(LOWEST)).alias("top"))
    # The window's lower end, num * s / den rounded up, without leaving the range of a long.
    div = lambda a, b: F.call_function("div", a, F.lit(b))
    least = F.transform("top", lambda s: F.when(s >= 0, div(s, den) * num + div(s % den * num + (den - 1), den)).otherwise(F.lit(LOWEST)))
    window = materialize(asked.join(tops, "row").withColumn("floor", least))
    first = _scan(tiles, window, Negatives, n_negatives, True, n_batches)
    kth = _best(first, ["anchor", "place"], n_negatives).where(F.col("_at") == n_negatives).groupBy(F.col("anchor").alias("row")).agg(
        _lists(F.col("score"), F.col("place") + 1, n_positives, F.lit(LOWEST)).alias("_kth"))
    raised = window.join(kth, "row", "left").withColumn("floor", F.when(F.col("_kth").isNull(), F.col("floor")).otherwise(
        F.zip_with("floor", "_kth", lambda f, s: F.greatest(f, s)))).drop("_kth")
    found = _best(_scan(tiles, raised, Negatives, n_negatives, False, n_batches), ["anchor", "place"], n_negatives)
    names = asked.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    pairs = positives.select("anchor", (F.col("_at") - 1).cast("bigint").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(pairs, ["anchor", "place"]).join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("_at").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def mine_hard_negatives(vectors: DataFrame, every: int = 100) -> DataFrame:
    """Hard negatives of the rows whose vec_id is divisible by ``every``; see ``mined``. Columns other than vec_id, embedding and label are not read."""
    rows = scaled_rows(vectors.select("vec_id", "embedding", "label"))
    return mined(rows, rows.where(F.col("vec_id") % every == 0))
