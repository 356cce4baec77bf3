"""Sharding by longest processing time.

Rows with equal texts form a group that stays together. Groups, sorted by size, go
one by one to the least loaded shard. Groups of one size are alike, so the number
of groups of each size is all that the schedule needs: the driver gets one pair a
size, at most sqrt(2 * bytes) of them (245,000 for 30 GB, since different sizes add
up), and takes a whole size through the heap at once. Each group then finds its
shard by its rank among the groups of its size.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genespark.llm.common import whole_text
from genespark.operators.ordered import rank_within
from genespark.session import materialize


def take_turns(loads: list[int], size: int, count: int) -> list[int]:
    """How many of ``count`` items of one size each shard gets, one after another to the least loaded (ties: the smaller shard).

    The k-th item of a shard is taken when its load is ``load + k * size``; the
    ``count`` smallest of these are taken. All full rounds below a common load are
    counted at once, the rest, fewer than shards, go through a heap.
    """
    low, high = min(loads) - 1, max(loads) + size * count
    upto = lambda t: sum((t - x) // size + 1 for x in loads if x <= t)
    while low < high:  # the highest load that no more than ``count`` items are taken at or below
        mid = (low + high + 1) // 2
        low, high = (mid, high) if upto(mid) <= count else (low, mid - 1)
    got = [(low - x) // size + 1 if x <= low else 0 for x in loads]
    heap = [(x + k * size, i) for i, (x, k) in enumerate(zip(loads, got, strict=True))]
    heapq.heapify(heap)
    for _ in range(count - sum(got)):
        load, i = heapq.heappop(heap)
        got[i] += 1
        heapq.heappush(heap, (load + size, i))
    return got


def longest_first(counts: list[tuple[int, int]], shards: int) -> list[tuple[int, list[int]]]:
    """(size, number of groups) -> (size, ranks at which the next shard begins), largest size first."""
    loads, out = [0] * shards, []
    for size, count in sorted(counts, reverse=True):
        got = take_turns(loads, size, count)
        starts = []
        for i, k in enumerate(got):
            starts.append(sum(got[:i]))
            loads[i] += k * size
        out.append((size, starts[1:]))
    return out


def shard_groups(rows: DataFrame, shards: int = 16) -> DataFrame:
    """Add ``shard`` (int) to rows with a group key ``grp`` (bigint) and a positive ``size`` (bigint).

    ``rows`` is read twice, so pass a written table. Rows of one ``grp``
    get one shard. An empty table gives an empty result.
    """
    groups = materialize(rank_within(rows.groupBy("grp").agg(F.sum("size").cast("bigint").alias("size")), ["size"], [F.col("grp")], "_r"))
    got = groups.groupBy("size").agg(F.count(F.lit(1)).alias("n")).toArrow()
    plan = longest_first(list(zip(got["size"].to_pylist(), got["n"].to_pylist(), strict=True)), shards)
    starts = materialize(rows.sparkSession.createDataFrame(plan, "size bigint, _starts array<bigint>"))
    shard = F.size(F.filter("_starts", lambda x: x <= F.col("_r")))
    return rows.join(groups.join(starts, "size").select("grp", shard.alias("shard")), "grp")


def slots(rows: DataFrame, by: str = "shard", order: tuple[str, ...] = ()) -> DataFrame:
    """Add ``slot``: a gapless number from 0 within each ``by``.

    A shard holds a fixed share of the table, so it is not ranked in one task:
    rows are ranked inside the chunk they were written in, and the counts of the
    chunks before it (one row per chunk and shard) are added.
    """
    kept = materialize(rows.withColumn("_chunk", F.spark_partition_id()))
    inside = Window.partitionBy(by, "_chunk").orderBy(*order)
    before = Window.partitionBy(by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    start = kept.groupBy(by, "_chunk").agg(F.count(F.lit(1)).alias("_n")).select(
        by, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranked = kept.withColumn("_r", F.row_number().over(inside) - 1)
    return ranked.join(start, [by, "_chunk"]).withColumn("slot", (F.col("_start") + F.col("_r")).cast("bigint")).drop(
        "_chunk", "_start", "_r")


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Shard and slot of every document by law ``bytes``: shard sizes near equal, equal texts together.

    Size is the text's UTF-8 bytes plus one; a null text has size 1 and is a
    group of its own kind together with empty texts. Repeated rows keep one slot
    each. Two texts whose 64-bit hashes are equal would merely stay together.
    Columns: doc_id, size, text_crc32, law, shard, slot, grown_shard (null).
    Further columns of ``docs`` are not read.
    """
    text = whole_text()
    rows = materialize(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("grp")))
    placed = slots(shard_groups(rows, shards), "shard", ("doc_id", "text_crc32", "size", "grp"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
