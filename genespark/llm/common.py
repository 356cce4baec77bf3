"""Helpers shared by the text operators: written tables, row batches, components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genespark.session import materialize

WHITE = " \t\n\x0b\x0c\r"
SLOTS = 24  # bits of a key that ``parted`` marks


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table that ``materialize`` wrote, once no later plan reads it."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


def whole_text(col: str = "text") -> Column:
    """A null text counts as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Identity of a document: its id and its text. Repeated rows share it and get the same result."""
    return F.xxhash64(F.lit("row"), F.col(id_col), F.col(text_col), F.crc32(F.col(text_col).cast("binary")))


def slices(batches: Iterator[pa.RecordBatch], column: str, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a piece has at most ``rows`` rows and, if it has two or more, ``size`` bytes of ``column``."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype("i8"))
        at = 0
        while at < n:
            before = upto[at - 1] if at else 0
            end = int(np.searchsorted(upto, before + size, side="right"))
            end = min(max(end, at + 1), at + rows, n)
            yield batch.slice(at, end - at)
            at = end


def parted(rows: DataFrame, on: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``on`` may be one of that column of ``keys``, and the rows where it is none for certain.

    A key marks one of 2 ** ``SLOTS`` bits, so at most 2 ** (SLOTS - 6) words are
    broadcast, however many keys there are, and no row is shuffled. An exact join of
    the first part then moves few rows besides those it finds, and the others not at all.
    """
    slot = F.xxhash64(on).bitwiseAND((1 << SLOTS) - 1)
    word, bit = F.shiftright(slot, 6), slot.bitwiseAND(63).cast("int")
    mark = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    marks = materialize(keys.select(word.alias("_word"), mark.alias("_mark")).groupBy("_word").agg(F.bit_or("_mark").alias("_marks")))
    met = rows.withColumn("_word", word).join(F.broadcast(marks), "_word", "left")
    may = F.coalesce(F.getbit("_marks", bit) == 1, F.lit(False))
    return met.where(may).select(*rows.columns), met.where(~may).select(*rows.columns)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes that have an edge; ``component`` is the smallest node reachable.

    ``edges`` has two bigint columns a and b. Each round every node takes the
    smallest label around it and then its label's label, so the rounds grow with
    the logarithm of the longest path. It runs until nothing changes. A node's
    neighbours are aggregated on the map side, so a hub is not gathered.
    """
    both = materialize(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where(F.col("a") != F.col("b")).distinct())
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")))
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_near")))
        step = labels.join(near, "node").select("node", F.least("label", "_near").alias("_c"), "label")
        jump = labels.select(F.col("node").alias("_c"), F.col("label").alias("_j"))
        step = materialize(step.join(jump, "_c").select("node", F.least("_c", "_j").alias("new"), "label"))
        moved = step.where(F.col("new") != F.col("label")).limit(1).count()
        drop_written(labels)
        labels = step.select("node", F.col("new").alias("label"))
        if not moved:
            drop_written(both)
            return labels.select("node", F.col("label").alias("component"))
