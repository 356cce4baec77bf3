"""Exact top-k search by inner product, a block of documents at a time.

Vectors are range-sorted by a locality code and cut into blocks; a dimension is
a term. A block keeps the smallest and largest value per term, and a forward
index: the matrix of its vectors. The sum over terms of the larger of q * min and
q * max bounds every score in the block. Each query visits blocks from the highest
bound down and stops where the bound is below its k-th best score; at equality it
goes on, for a smaller id may tie. Tiles of blocks meet batches of queries in
tasks of bounded size; per query and tile at most k rows come out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genespark.llm import blocks
from genespark.session import materialize

BLOCK = 128  # vectors of a block
TILE = 16_384  # vectors of a tile, about
BATCH = 1024  # queries of a batch
BATCHES = 8  # batches that meet a tile in one task
BITS = 12  # of the locality code
EXACT = 1 << 53
LOWEST = -np.iinfo("i8").max  # no score; its negative exists
MOST = np.iinfo("i8").max - 1  # scores beyond a long are held at its end


def whole_numbers(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64) -> DataFrame:
    """(vec_id, v) with v = floor(scale * x) per component, as exact doubles, however large.

    Vectors that are null or hold a null, NaN or infinite component are left out.
    """
    x = F.transform(vec_col, lambda c: c.cast("double"))
    bad = F.exists("_x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = lambda c: F.when(F.abs(c) < float(1 << 52), F.floor(c * float(scale)).cast("double")).otherwise(c * float(scale))
    return vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), x.alias("_x")).where(F.col("_x").isNotNull() & ~bad).select(
        "vec_id", F.transform("_x", whole).alias("v"))


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _exact(m: np.ndarray) -> np.ndarray:
    """Whole doubles as Python integers."""
    return np.frompyfunc(int, 1, 1)(m) if m.size else m.astype(object)


def _packed(ids: np.ndarray, m: np.ndarray) -> bytes:
    most = np.abs(m).max(initial=0)
    kind = "i1" if most < 128 else "i2" if most < 1 << 15 else "f8"
    return blocks.pack(ids=[ids], width=[[m.shape[1]]], m=[m.astype(kind).reshape(-1)])


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    t = blocks.unpack(data)
    ids, width, m = (t[c].combine_chunks().flatten().to_numpy() for c in ("ids", "width", "m"))
    return ids, m.reshape(len(ids), int(width[0]))


def _code(batches):
    """Add the locality code of every vector: signs of its sums over random subsets of the terms."""
    for batch in batches:
        size = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
        code = np.zeros(batch.num_rows, "i4")
        for width in np.unique(size):
            at = np.flatnonzero(size == width)
            m = _matrix(batch.column("v").take(pa.array(at)), width).astype("f8")
            planes = np.random.default_rng(int(width)).choice([-1.0, 1.0], (width, BITS))
            code[at] = (m @ planes > 0) @ (1 << np.arange(BITS))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size.astype("i4")), pa.array(code)], ["vec_id", "v", "width", "code"])


def _pack_rows(rows: int, key):
    """Consecutive rows of one width, ``rows`` at a time -> (number, payload)."""
    def run(batches):
        held: dict[int, list[pa.RecordBatch]] = {}
        made = 0

        def emit(width: int, all_: bool):
            nonlocal made
            parts = pa.Table.from_batches(held.pop(width)).combine_chunks().to_batches()[0]
            at = 0
            while parts.num_rows - at >= rows or all_ and at < parts.num_rows:
                one = parts.slice(at, rows)
                at += one.num_rows
                payload = _packed(one.column("vec_id").to_numpy(), _matrix(one.column("v"), width))
                yield pa.RecordBatch.from_arrays([pa.array([key(made)], pa.int64()), pa.array([payload], pa.binary())], ["number", "payload"])
                made += 1
            if at < parts.num_rows:
                held[width] = [parts.slice(at)]

        for batch in batches:
            width = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
            for w in np.unique(width).tolist():
                own = batch.take(pa.array(np.flatnonzero(width == w))).select(["vec_id", "v"])
                held.setdefault(w, []).append(own)
                if sum(b.num_rows for b in held[w]) >= rows:
                    yield from emit(w, False)
        for w in list(held):
            yield from emit(w, True)
    return run


def _merge(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Best k of each row, by score, then smaller id."""
    order = np.lexsort((ids, -score), axis=1)[:, :k]
    return np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)


def search(queries: tuple[np.ndarray, np.ndarray], parts: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best k (score, id) per query over the blocks ``parts``, and how many (query, block) pairs were scored.

    Missing places have the lowest possible score. The query's own id is no candidate.
    """
    qid, q = queries
    low = LOWEST
    best, who = np.full((len(qid), k), low), np.full((len(qid), k), np.iinfo("i8").max)
    parts = [p for p in parts if p[1].shape[1] == q.shape[1]]
    if not parts:
        return best, who, 0
    largest = max(float(np.abs(m.astype("f8")).max(initial=0)) for _, m in parts)
    small = largest * float(np.abs(q.astype("f8")).max(initial=0)) * max(q.shape[1], 1) < EXACT
    whole = (lambda m: m.astype("f8")) if small else (lambda m: _exact(m.astype("f8")))  # exact either way
    q = whole(q)
    hi, lo = (whole(np.stack([f(m, axis=0) for _, m in parts])) for f in (np.max, np.min))
    bound = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
    order = np.argsort(-bound.astype("f8"), axis=1, kind="stable")
    scored = 0
    for r in range(len(parts)):
        active = np.flatnonzero(np.take_along_axis(bound, order[:, r:r + 1], 1)[:, 0] >= best[:, -1])
        if not len(active):
            break
        scored += len(active)
        for b in np.unique(order[active, r]).tolist():
            mine = active[order[active, r] == b]
            ids, m = parts[b]
            score = q[mine] @ whole(m).T
            score = (score if small else np.clip(score, -MOST, MOST)).astype("i8")
            score[ids[None, :] == qid[mine][:, None]] = low
            every = np.broadcast_to(ids, score.shape)
            best[mine], who[mine] = _merge(np.hstack([best[mine], score]), np.hstack([who[mine], every]), k)
    return best, who, scored


def _meet(k: int):
    names = ["query_id", "vec_id", "score"]

    def run(key, tile: pa.Table, batches: pa.Table) -> pa.Table:
        parts = [_unpacked(p) for p in tile["payload"].to_pylist()]
        out = []
        for p in batches["payload"].to_pylist() if parts else []:
            queries = _unpacked(p)
            best, who, _ = search(queries, parts, k)
            found = best > LOWEST
            out.append(pa.table([pa.array(np.repeat(queries[0], found.sum(axis=1))), pa.array(who[found]), pa.array(best[found])], names))
        empty = pa.table([pa.array([], pa.int64())] * 3, names)
        return pa.concat_tables([empty, *out])

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` best candidates of every query: query_id, rank (from 1), vec_id, score.

    Both tables have vec_id and v (array<double> of whole numbers). The score is the inner product;
    ties go to the smaller vec_id. Candidates are all vectors of the query's
    length with another vec_id; a repeated candidate counts as often as it
    stands there, a repeated query id is one query (its smallest vector). Scores
    are exact; one beyond the range of a long is held at its end. A query without candidates has no row; empty tables give an empty result.
    """
    packed = "number bigint, payload binary"
    coded = vectors.select("vec_id", "v").mapInArrow(_code, "vec_id bigint, v array<double>, width int, code int")
    n_tiles = max(1, math.ceil(vectors.count() / TILE))
    # The last key deals equal rows out.
    sorted_ = coded.withColumn("_n", F.monotonically_increasing_id()).repartitionByRange(n_tiles, "width", "code", "vec_id", "_n").sortWithinPartitions(
        "width", "code", "vec_id").drop("_n")
    tiles = materialize(sorted_.select("vec_id", "v").mapInArrow(_pack_rows(BLOCK, lambda n: _partition()), packed))
    single = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    n_batches = max(1, math.ceil(single.count() / BATCH))
    asked = materialize(single.repartition(n_batches, "vec_id").mapInArrow(_pack_rows(BATCH, lambda n: _partition() * 1000 + n), packed))
    last = tiles.agg(F.max("number").alias("m")).first()["m"]
    groups = max(1, math.ceil(n_batches / BATCHES))
    group = F.pmod(F.xxhash64("number"), F.lit(groups)).cast("int")
    left = tiles.withColumnRenamed("number", "tile").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = asked.select(group.alias("part"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last or 0).cast("bigint"))).alias("tile"), "payload")
    met = left.groupBy("tile", "part").cogroup(right.groupBy("tile", "part")).applyInArrow(_meet(k), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _partition() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()
