"""Leading eigenvectors of a large symmetric matrix, with nothing of its length on the driver."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genespark.session import materialize

BLOCK = 256  # rows and columns of a matrix block
EXTRA = 4  # vectors of a step beyond those asked for
TOLERANCE = 1e-10  # of a residual, as a part of the largest eigenvalue


def _blocks(entries: DataFrame, n: int) -> DataFrame:
    """(bi, bj, m): dense blocks of the matrix (i, j, v), rows within blocks first."""
    def dense(key, rows):
        bi, bj = (k.as_py() for k in key)
        m = np.zeros((min(BLOCK, n - bi * BLOCK), min(BLOCK, n - bj * BLOCK)))
        m[rows["i"].to_numpy() - bi * BLOCK, rows["j"].to_numpy() - bj * BLOCK] = rows["v"].to_numpy()
        return pa.table({"bi": [bi], "bj": [bj], "m": [m.tobytes()]}, pa.schema([("bi", pa.int32()), ("bj", pa.int32()), ("m", pa.binary())]))

    at = lambda c: F.floor(F.col(c) / BLOCK).cast("int")
    return entries.select("i", "j", "v", at("i").alias("bi"), at("j").alias("bj")).groupBy("bi", "bj").applyInArrow(dense, "bi int, bj int, m binary")


def _each(blocks: DataFrame, fn, columns: list[str], extra: str = "") -> DataFrame:
    """(b, x) with x = fn(arrays of ``columns``), row block by row block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                got = fn(batch.column("b")[k].as_py(), *[np.frombuffer(batch.column(c)[k].as_py()) for c in columns])
                yield pa.RecordBatch.from_arrays([pa.array([batch.column("b")[k].as_py()], pa.int32()), pa.array([got.tobytes()], pa.binary())], ["b", "x"])
    return blocks.mapInArrow(run, "b int, x binary")


def _summed(parts: DataFrame) -> DataFrame:
    """(b, x): sums of the blocks (b, x) with one number."""
    def add(key, rows):
        total = sum(np.frombuffer(x.as_py()) for x in rows["x"])
        return pa.table({"b": [key[0].as_py()], "x": [total.tobytes()]}, pa.schema([("b", pa.int32()), ("x", pa.binary())]))
    return parts.groupBy("b").applyInArrow(add, "b int, x binary")


def _times(matrix: DataFrame, x: DataFrame, p: int) -> DataFrame:
    """Matrix times the n x p table of row blocks ``x``."""
    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, m, v in zip(*(batch.column(c).to_pylist() for c in ("b", "m", "x")), strict=True):
                v = np.frombuffer(v).reshape(-1, p)
                y = np.frombuffer(m).reshape(-1, len(v)) @ v
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([y.tobytes()], pa.binary())], ["b", "x"])

    met = matrix.withColumnRenamed("bi", "b").join(x.select(F.col("b").alias("bj"), "x"), "bj").select("b", "m", "x")
    return _summed(met.mapInArrow(product, "b int, x binary"))


def _gram(x: DataFrame, y: DataFrame, p: int, q: int) -> np.ndarray:
    """x' y, p x q: each block's share is a row of cells, summed by cell."""
    both = x.join(y.select("b", F.col("x").alias("y")), "b")

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((p, q))
        for batch in batches:
            for u, v in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                total += np.frombuffer(u).reshape(-1, p).T @ np.frombuffer(v).reshape(-1, q)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(p * q, dtype="i4")), pa.array(total.reshape(-1))], ["cell", "v"])

    cells = both.mapInArrow(share, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(p * q)
    for r in cells:
        out[r["cell"]] = r["v"]
    return out.reshape(p, q)


def _joined(v: DataFrame, p: int, w: DataFrame, q: int) -> DataFrame:
    """[v w]: columns of two tables side by side."""
    both = v.join(w.select("b", F.col("x").alias("y")), "b")
    return _each(both, lambda b, x, y: np.hstack([x.reshape(-1, p), y.reshape(-1, q)]), ["x", "y"])


def _right(x: DataFrame, p: int, c: np.ndarray) -> DataFrame:
    """x c for a small matrix c."""
    return _each(x, lambda b, v: v.reshape(-1, p) @ c, ["x"])


def _orthonormal(v: DataFrame | None, p: int, w: DataFrame, q: int) -> tuple[DataFrame | None, int]:
    """Orthonormal columns of ``w`` without their parts in ``v``, and how many are left of q."""
    scale = None
    for _ in range(3):
        if v is not None:
            c = _gram(v, w, p, q)
            both = w.join(v.select("b", F.col("x").alias("y")), "b")
            w = materialize(_each(both, lambda b, x, y, c=c, q=q: x.reshape(-1, q) - y.reshape(-1, p) @ c, ["x", "y"]))
        g = _gram(w, w, q, q)
        values, vectors = np.linalg.eigh((g + g.T) / 2)
        scale = max(values[-1], 0.0) if scale is None else scale
        good = values > max(scale, 1e-300) * 1e-20 if scale else np.zeros(q, bool)
        good &= values > max(values[-1], 0) * 1e-13
        if not good.any():
            return None, 0
        w = materialize(_right(w, q, vectors[:, good] / np.sqrt(values[good])))
        q = int(good.sum())
    return w, q


def leading_positive(entries: DataFrame, n: int, k: int, seed: int = 1) -> DataFrame:
    """(i, coords): the ``k`` largest positive eigenvalues' vectors of the symmetric matrix (i, j, v), each times the value's root.

    Block Krylov iteration: a block of vectors is multiplied by the matrix again
    and again, made orthogonal to all before, and the matrix is projected on their
    span. Its positive end is found whatever lies at the negative one. Vectors are
    tables of row blocks; only matrices as large as the span visit the driver. It
    stops when the residuals are below ``TOLERANCE`` or the span is all of the
    space; fewer positive values give fewer coordinates.
    """
    empty = entries.sparkSession.createDataFrame([], "i bigint, coords array<double>")
    if not n:
        return empty
    matrix = materialize(_blocks(entries, n))
    q = min(n, k + EXTRA)
    numbers = entries.sparkSession.range(math.ceil(n / BLOCK)).select(F.col("id").cast("int").alias("b"))
    start = _each(numbers, lambda b, q=q: np.random.default_rng([seed, b]).standard_normal((min(BLOCK, n - b * BLOCK), q)), [])
    w, q = _orthonormal(None, 0, materialize(start), q)
    v, p = w, q
    t = np.zeros((0, 0))
    while True:
        mw = materialize(_times(matrix, w, q))
        c = _gram(v, mw, p, q)
        grown = np.zeros((p, p))
        grown[:p - q, :p - q] = t
        grown[:, p - q:] = c
        grown[p - q:, :p - q] = c[:p - q].T
        t = (grown + grown.T) / 2
        values, vectors = np.linalg.eigh(t)
        top = np.argsort(-values)[:k]
        top = top[values[top] > max(np.abs(values).max(), 1e-300) * 1e-12]
        w, q_new = _orthonormal(v, p, mw, q) if p < n else (None, 0)
        if w is None:
            break
        # What the matrix makes of a Ritz vector outside the span is in the new columns.
        beta = _gram(w, mw, q_new, q)
        rest = np.linalg.norm(beta @ vectors[p - q:, top], axis=0) if len(top) else np.ones(1)
        if len(top) == k and (rest <= TOLERANCE * np.abs(values).max()).all():
            break
        v, p, q = materialize(_joined(v, p, w, q_new)), p + q_new, q_new
    if not len(top):
        return empty
    coords = _right(v, p, vectors[:, top] * np.sqrt(values[top]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, x in zip(batch.column("b").to_pylist(), batch.column("x").to_pylist(), strict=True):
                x = np.frombuffer(x).reshape(-1, len(top))
                yield pa.RecordBatch.from_arrays([pa.array(b * BLOCK + np.arange(len(x))), pa.array(list(x), pa.list_(pa.float64()))], ["i", "coords"])

    return coords.mapInArrow(rows, "i bigint, coords array<double>")
