"""Incremental hit intake with presence refreshed per touched genome.

A late paralog hit can remove an earlier call, so presence is never only
appended: every batch recomputes the genomes it touches, from all their hits.

The store is compacted as it grows: ``FAN`` folders of one level become one of the
next, with the best hit per key. Which folders hold batches 0 to n follows from n
alone (its digits in base ``FAN``), so a retried batch writes and reads the same
ones, and a batch reads at most ``FAN - 1`` folders a level, however long the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from genespark.operators.presence import compete, presence_cells

KEY = ["query_proteome", "query_id", "target_proteome", "target_id"]
FAN = 16
STORED = "query_id string, target_proteome string, target_id string, evalue double, query_proteome string"


def folders(n: int, fan: int = 0) -> list[tuple[int, int]]:
    """(level, number) of the folders that together hold the first ``n`` batches, oldest first."""
    fan = fan or FAN
    level = 0
    while fan ** (level + 1) <= n:
        level += 1
    out, start = [], 0
    for k in range(level, -1, -1):
        for _ in range((n - start) // fan**k):
            out.append((k, start // fan**k))
            start += fan**k
    return out


def _path(store: str, level: int, number: int) -> str:
    return f"{store}/level={level}/part={number}"


def _read(spark: SparkSession, store: str, parts: list[tuple[int, int]]) -> DataFrame:
    rows = spark.read.option("basePath", store).schema(STORED).parquet(*[_path(store, *p) for p in parts])
    return rows.select(*KEY, "evalue")


def _write(hits: DataFrame, store: str, level: int, number: int) -> None:
    """The best hit per key; a retry replaces the folder."""
    hits.groupBy(*KEY).agg(F.min("evalue").alias("evalue")).write.mode("overwrite").partitionBy("query_proteome").parquet(_path(store, level, number))


def merge_batch(batch: DataFrame, batch_id: int, store: str, out: str, paralogs: DataFrame, **rules) -> None:
    """Store the batch's best hit per key, then rewrite the presence of the genomes it names.

    Each batch has a folder of its own, so a retried batch replaces itself, and
    in it one per genome: only the touched genomes' folders are read.
    """
    spark, n = batch.sparkSession, batch_id + 1
    _write(batch, store, 0, batch_id)
    level = 1
    while n % FAN**level == 0:
        number = n // FAN**level - 1
        _write(_read(spark, store, [(level - 1, number * FAN + i) for i in range(FAN)]), store, level, number)
        level += 1
    touched = _read(spark, store, [(0, batch_id)]).select("query_proteome").distinct()
    names = [r["query_proteome"] for r in touched.collect()]  # as many as genomes in the batch
    hits = _read(spark, store, folders(n)).where(F.col("query_proteome").isin(names)).groupBy(*KEY).agg(F.min("evalue").alias("evalue"))
    cells = presence_cells(compete(hits, paralogs, **rules))
    # one marker row per genome, so that a genome that lost every call is rewritten too
    marks = touched.select(F.col("query_proteome").alias("source_proteome"), *[
        F.lit(None).cast(f.dataType).alias(f.name) for f in cells.schema.fields if f.name != "source_proteome"])
    cells.unionByName(marks).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "source_proteome").parquet(out)


def start_intake(
    spark: SparkSession, source: str, schema, store: str, out: str, checkpoint: str, paralogs: DataFrame,
    arrived: str | None = None, delay: str = "1 day", files_per_batch: int = 100, **rules,
) -> StreamingQuery:
    """Start the stream over a folder of hit files; it stops when the present files are read.

    With an arrival time column, repeats of a hit within ``delay`` are dropped
    before the merge and their state is bounded by the watermark.
    """
    hits = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    if arrived is not None:
        hits = hits.withWatermark(arrived, delay).dropDuplicatesWithinWatermark([*KEY, "evalue"])
    return (hits.writeStream.foreachBatch(lambda df, i: merge_batch(df, i, store, out, paralogs, **rules))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_presence(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).where(F.col("protein_id").isNotNull())
