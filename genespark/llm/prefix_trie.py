"""Prefix trie of conversations: every shared beginning once, with its members, leaves and saved tokens.

A conversation is a path of turns; a turn is two 64-bit hashes of (role, text), so
texts are read once and never shuffled. Paths are range-sorted into shards and cut
into blocks of bounded size. In a block the turns get dense ids and the paths form
a matrix padded with 0; it is put in order by ``numpy.lexsort``. A cell that
differs from the row above, OR-accumulated along the row, starts a node, and
``reduceat`` between starts gives every figure of a depth at once. Nodes on the
path of a block's first or last row may go on in its neighbours: only these travel
on, as partial figures, and are recombined by key; their number is that of the
blocks times the depth.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genespark.llm.blocks import block_number
from genespark.session import materialize

WORD = "[^\\x20\\x09-\\x0D]+"
EVERY, BORROWED = 20, 4  # a conversation may begin with that of the multiple of EVERY below it, by less than BORROWED turns
SHARD_TURNS, SHARD_ROWS = 1 << 20, 1 << 16
CELLS = 1 << 22  # of a block's matrix
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = ("block bigint, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
        "saved_tokens bigint, ends_sha256 string, key binary, parent_key binary, chain int, words bigint, ends binary")
_SCHEMA = pa.schema([
    (name, {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[kind])
    for name, kind in (c.split() for c in NODE.split(", "))])


def turn_paths(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (first hash, second hash, words of the text).

    Turns go by number, a null number first; equal numbers by role, then by the
    hash of role and text. Null roles and texts are empty. Repeated rows are turns
    of their own. Rows without conv_id belong to no conversation and are left out.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn"), role.alias("role"), F.xxhash64(role, text).alias("a"),
                 F.xxhash64(F.lit("turn"), text, role).alias("b"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("w")).alias("t"))
    return rows.groupBy("conv_id").agg(F.transform(
        F.array_sort(F.collect_list("t")), lambda t: F.struct(t["a"], t["b"], t["w"])).alias("turns"))


def rebuilt(paths: DataFrame, every: int = EVERY, borrowed: int = BORROWED) -> DataFrame:
    """Each conversation with its first h turns taken from that of ``conv_id - conv_id % every``; h = crc32(conv_id) % ``borrowed``.

    All of them if that one has fewer than h, none if it is absent; then follow
    the conversation's own turns after its first h.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % borrowed).cast("int")
    heads = paths.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("_base"), F.slice("turns", 1, borrowed - 1).alias("_head"))
    own = paths.withColumns({"_base": F.col("conv_id") - F.col("conv_id") % every, "_h": h})
    none = F.slice("turns", 1, 0)
    tail = F.when(F.size("turns") > F.col("_h"), F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns") - F.col("_h"), F.lit(0)))).otherwise(none)
    head = F.coalesce(F.slice("_head", F.lit(1), F.col("_h")), none)
    return own.join(heads, "_base", "left").select("conv_id", F.concat(head, tail).alias("turns"))


class Rows:
    """Conversations of a block as flat arrays."""

    def __init__(self, conv: np.ndarray, first: np.ndarray, second: np.ndarray, words: np.ndarray, length: np.ndarray):
        self.conv, self.first, self.second, self.words, self.length = conv, first, second, words, length

    def matrix(self) -> tuple[np.ndarray, np.ndarray]:
        """Padded turn ids and words: ids are dense from 1, in the order of the hashes; 0 where a row has ended."""
        n, depth = len(self.conv), int(self.length.max(initial=0))
        order = np.lexsort((self.second, self.first))
        a, b = self.first[order], self.second[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        ids = np.empty(len(a), "i8")
        ids[order] = np.cumsum(new)
        row = np.repeat(np.arange(n), self.length)
        col = np.arange(len(ids)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        m, w = np.zeros((n, depth), "i8"), np.zeros((n, depth), "i8")
        m[row, col], w[row, col] = ids, self.words
        return m, w

    def keys(self, row: int) -> list[bytes]:
        """Key of every beginning of a row: a digest of its turns, the empty one included."""
        at = int(self.length[:row].sum())
        running = hashlib.blake2b(digest_size=16)
        out = [running.digest()]
        for i in range(at, at + int(self.length[row])):
            running.update(self.first[i].tobytes() + self.second[i].tobytes())
            out.append(running.digest())
        return out


def _sha(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest() if len(ids) else NO_ENDS


def block_nodes(rows: Rows, block: int) -> pa.Table:
    """Nodes of one block: finished ones, and partial ones (``chain`` 0 or 1) on the paths of its first and last row."""
    m, w = rows.matrix()
    n, depth = m.shape
    # The shard arrives in this order of paths; equal paths are put in the order of conv_id.
    order = np.lexsort((rows.conv, *m.T[::-1]))
    first_keys, last_keys = rows.keys(int(order[0])), rows.keys(int(order[-1]))
    m, w, conv, length = m[order], w[order], rows.conv[order], rows.length[order]
    change = np.ones((n, depth), bool)
    change[1:] = m[1:] != m[:-1]
    np.logical_or.accumulate(change, axis=1, out=change)
    shared = int((np.cumsum(m[0] != m[-1]) == 0).sum() if depth else 0)
    shared = min(shared, int(length[0]), int(length[-1]))  # turns that the first and last row have in common

    done: list[dict] = []
    partial: list[dict] = []
    below = {"start": np.zeros(0, "i8"), "leaves": np.zeros(0, "i8"), "saved": np.zeros(0, "i8"), "open": np.zeros(0, bool)}
    waiting: dict | None = None  # finished nodes of the depth below, which lack their parent
    for d in range(depth, -1, -1):
        starts = np.flatnonzero(change[:, d - 1]) if d else np.zeros(1, "i8")
        real = m[starts, d - 1] > 0 if d else np.ones(1, bool)
        size = np.diff(np.append(starts, n))
        least = np.minimum.reduceat(conv, starts)
        ends = np.add.reduceat((length == d).astype("i8"), starts)
        at, size, least, ends = starts[real], size[real], least[real], ends[real]
        parent = np.searchsorted(at, below["start"], side="right") - 1
        shut = ~below["open"]
        children = np.bincount(parent[shut], minlength=len(at))
        leaves, saved = np.zeros(len(at), "i8"), np.zeros(len(at), "i8")
        np.add.at(leaves, parent, below["leaves"])
        np.add.at(saved, parent, below["saved"])
        is_first = (at == 0) & (length[0] >= d)
        is_last = (at + size == n) & (length[-1] >= d)
        open_ = is_first | is_last
        words = w[at, d - 1] if d else np.zeros(1, "i8")
        childless = np.bincount(parent, minlength=len(at)) == 0
        leaves += childless & ~open_
        saved += np.where(open_, 0, (size - 1) * words)
        key = np.empty(len(at), object)
        for k in np.flatnonzero(open_).tolist():
            key[k] = (last_keys if is_last[k] else first_keys)[d]
            above = (last_keys if is_last[k] else first_keys)[d - 1] if d else None
            ids = conv[at[k]:at[k] + ends[k]]
            row = {"conv_id": least[k], "depth": d, "n_convs": size[k], "n_children": children[k], "n_leaves": leaves[k], "saved_tokens": saved[k],
                   "key": key[k], "parent_key": above, "words": words[k], "ends": ",".join(map(str, ids.tolist())).encode() if len(ids) else None}
            partial.append(row | {"chain": 0 if is_last[k] else 1})
            if d <= shared and (len(first_keys) > shared + 1):
                # The first row's chain goes through this node as well; there it only hands sums upwards.
                partial.append({"depth": d, "key": key[k], "parent_key": above, "chain": 1})
        if waiting is not None:
            up = np.searchsorted(at, waiting["start"], side="right") - 1
            done.append(waiting["rows"] | {
                "parent_conv_id": np.where(open_[up], -1, least[up]), "parent_open": open_[up], "parent_key": key[up]})
        mine = ~open_
        waiting = {"start": at[mine], "rows": {
            "conv_id": least[mine], "depth": np.full(int(mine.sum()), d), "n_convs": size[mine], "n_children": children[mine],
            "n_leaves": leaves[mine], "saved_tokens": saved[mine],
            "ends_sha256": [_sha(conv[a:a + e]) for a, e in zip(at[mine].tolist(), ends[mine].tolist(), strict=True)]}}
        below = {"start": at, "leaves": leaves, "saved": saved, "open": open_}

    parts = [pa.Table.from_pylist([{"block": block} | {k: int(v) if isinstance(v, np.integer) else v for k, v in r.items()} for r in partial], _SCHEMA)]
    for r in done:
        k = len(r["conv_id"])
        if k:
            columns = {name: pa.array(r[name]) for name in ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")}
            columns |= {"parent_conv_id": pa.array(r["parent_conv_id"], pa.int64(), mask=r["parent_open"]),
                        "parent_key": pa.array(r["parent_key"].tolist(), pa.binary()), "block": pa.array(np.full(k, block))}
            parts.append(pa.table([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(k, f.type) for f in _SCHEMA], schema=_SCHEMA))
    return pa.concat_tables(parts)


def _cut(batches: Iterator[pa.RecordBatch], rows: int, cells: int) -> Iterator[pa.Table]:
    """Consecutive rows in blocks of at most ``rows`` rows and ``cells`` padded cells (one row may have more)."""
    held: list[pa.RecordBatch] = []
    count = widest = 0
    for batch in batches:
        lengths = pc.list_value_length(batch.column("turns")).to_numpy(zero_copy_only=False)
        at = 0
        for i, n in enumerate(lengths.tolist()):
            wide = max(widest, n)
            if count + i - at and (count + i - at + 1 > rows or wide * (count + i - at + 1) > cells):
                held.append(batch.slice(at, i - at))
                yield pa.Table.from_batches(held)
                held, count, at, wide = [], 0, i, n
            widest = wide
        held.append(batch.slice(at))
        count += batch.num_rows - at
    if count:
        yield pa.Table.from_batches(held)


def _shard(rows: int, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, table in enumerate(_cut(batches, rows, cells)):
            turns = table["turns"].combine_chunks()
            turns = turns if isinstance(turns, pa.ListArray) else pa.concat_arrays(turns.chunks)
            flat = turns.flatten()
            a, b, w = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            length = pc.list_value_length(turns).to_numpy(zero_copy_only=False).astype("i8")
            conv = table["conv_id"].to_numpy()
            yield from block_nodes(Rows(conv, a, b, w, length), block_number(k)).combine_chunks().to_batches(max_chunksize=1 << 14)
    return run


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, block) -> (key, ends_sha256); the ids go through the digest and are not gathered."""
    key, running = None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([running.hexdigest()])], ["key", "ends_sha256"])

    for batch in batches:
        for k, ids in zip(batch.column("key"), batch.column("ends"), strict=True):
            k = k.as_py()
            if k != key:
                if running is not None:
                    yield out()
                key, running = k, hashlib.sha256(ids.as_py())
            else:
                running.update(b"," + ids.as_py())
    if running is not None:
        yield out()


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("bigint").alias(column)


def trie(paths: DataFrame, shard_turns: int = SHARD_TURNS, shard_rows: int = SHARD_ROWS, cells: int = CELLS) -> DataFrame:
    """Nodes of the trie of ``paths`` (conv_id, turns): one row per distinct beginning of a conversation, the empty one included.

    conv_id (smallest member), depth, parent_conv_id, n_convs (members), n_children,
    n_leaves (childless nodes of the subtree), saved_tokens (over the subtree, members
    but one times words of the last turn), ends_sha256 (digest of the ascending ids of
    members that end here). ``conv_id`` is one row's. A conversation is one row of 24
    bytes a turn. An empty table has no members and so no root: no rows. The ids that
    end at one node pass through one digest, in order, as the digest asks: packed by
    block and only for nodes that span blocks.
    """
    paths = materialize(paths)
    n = paths.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("turns")).alias("turns")).first()
    shards = max(1, math.ceil(n["rows"] / shard_rows), math.ceil((n["turns"] or 0) / shard_turns))
    ordered = paths.select("conv_id", "turns").repartitionByRange(shards, "turns", "conv_id").sortWithinPartitions("turns", "conv_id")
    nodes = materialize(ordered.mapInArrow(_shard(shard_rows, cells), NODE))
    inner, part = nodes.where(F.col("chain").isNull()), nodes.where(F.col("chain").isNotNull())

    here = F.when(F.col("n_convs").isNotNull(), F.struct("block", "chain"))
    merged = part.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"), F.max("words").alias("words"),
        *[_total(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.min(here).alias("owner"))
    met = merged.groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("_more"))
    merged = materialize(merged.join(met, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("_more", F.lit(0))).drop("_more"))

    # A node's own share is handed up once, along the chain of the block that owns it.
    own = merged.select(
        "key", F.col("owner.block").alias("block"), F.col("owner.chain").alias("chain"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("_saved"), (F.col("n_children") == 0).cast("bigint").alias("_leaves"))
    chain = Window.partitionBy("block", "chain").orderBy(F.desc("depth"))
    handed = part.select("key", "block", "chain", "depth").join(own, ["key", "block", "chain"], "left").select(
        "key", *[F.sum(F.coalesce(c, F.lit(0))).over(chain).alias(c) for c in ("_saved", "_leaves")])
    sums = handed.groupBy("key").agg(F.sum("_saved").alias("_saved"), F.sum("_leaves").alias("_leaves"))
    ended = part.where(F.col("ends").isNotNull()).select("key", "block", "ends").repartition("key").sortWithinPartitions("key", "block").mapInArrow(
        _hash_ends, "key binary, ends_sha256 string")
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    shape = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    shared = merged.join(sums, "key").join(ended, "key", "left").join(parents, "parent_key", "left").withColumns({
        "n_leaves": F.col("n_leaves") + F.col("_leaves"), "saved_tokens": F.col("saved_tokens") + F.col("_saved"),
        "ends_sha256": F.coalesce("ends_sha256", F.lit(NO_ENDS))}).select(shape)

    # A block has its own rows of the nodes above it, so children of a hot node meet them block by block.
    above = part.where(F.col("n_convs").isNotNull()).select("block", "key").distinct().join(merged.select("key", F.col("conv_id").alias("_above")), "key").withColumnRenamed(
        "key", "parent_key")
    rest = inner.join(above, ["block", "parent_key"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above")).select(shape)
    return rest.unionByName(shared)


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of all rebuilt conversations of a table (conv_id, turn, role, text); other columns are not read."""
    return trie(rebuilt(turn_paths(turns.select("conv_id", "turn", "role", "text"))))
