"""Near-duplicate groups: SimHash fingerprints, then MinHash bands find candidates, an exact check decides.

Texts link when the Jaccard similarity of their sets of ``WIDTH``-word shingles is
at least ``SIMILAR``. Texts with one set are one node. Candidates come first from
op7's method, 64-bit SimHash fingerprints (here of ``WIDTH`` words) that differ in
two bits at most, found by multi-index lookups (``simhash.linked``). They are the
closest copies; under 1 % of the pairs at similarity 0.8 are that near, so the
others come from keys of minima: a pair of similarity J shares one of the ``BANDS``
keys of ``ROWS`` minima with probability 1 - (1 - J ** ROWS) ** BANDS: 0.9996 at
0.8, 1.0000 from 0.85 on.

Pairs of a key are never listed while they may be many. In a round each key that
has members of several groups checks them against one of them, which joins a large
group of near copies without its pairs. Rounds go on while they link texts. What is
then still open mostly shares passages and is below ``SIMILAR``; it gets finer keys: of a
set of n shingles, sorted by falling rarity, the first n - ceil(SIMILAR n) + 1 must
have one in common with those of any similar set. A passage of many texts is common
and not among them. A set of ``WHOLE`` shingles or more is thinned by hash to a quarter
of them, a sixteenth and so on, to 128 at least on average; the thinned sets of a pair at
0.8 then keep a similarity of ``THINNED`` (3.4 standard deviations below, so under
0.1 % are missed). Rounds go on over these keys, and only pairs that share such a
rare shingle are checked in the end.

Before its texts are fetched a pair must pass ``_alike``: each set has one parity bit
for each of ``64 * WORDS`` residues of its hashes, and the bits in which two sets differ
are no more than the shingles that one has and the other has not. This loses no
link, and of texts that merely share a passage few pass: pairs that are listed
grow with the links and not with the square of the texts that share a key.
"""

from __future__ import annotations

from functools import reduce
from operator import add as plus

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genespark.llm import simhash
from genespark.llm.common import components, drop_written, parted, slices
from genespark.session import materialize

WIDTH, SIMILAR = 5, 0.8
BANDS, ROWS = 20, 5
SEED = 42
WHOLE, THINNED = 512, 0.68
FEW = 0.01  # a round that links fewer than this part of the open nodes is the last over its keys
_ODD = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, dtype="u8") * np.uint64(2) + np.uint64(1)
_ADD = np.random.default_rng(SEED + 1).integers(0, 1 << 63, BANDS * ROWS, dtype="u8")
WORDS = 16  # 64-bit words of a set's parities
MARK = f"struct<n:bigint,{','.join(f'p{i}:bigint' for i in range(WORDS))}>"
SPREAD = 1 << 15  # shingles of one text that are permuted at a time


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; words as in ``simhash``, a shorter text is one shingle, a wordless one has none."""
    return np.unique(simhash.shingle_hashes(text or "", width))


def _digest(values: np.ndarray) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(values.tobytes()) - (1 << 63)


def bands(found: np.ndarray) -> list[int]:
    """Keys of a set: a digest of ``ROWS`` minima each, numbered by band; none for the empty set."""
    if not len(found):
        return []
    least = np.full(len(_ODD), np.iinfo("u8").max, "u8")
    for at in range(0, len(found), SPREAD):
        part = found[at:at + SPREAD]
        for i, (m, c) in enumerate(zip(_ODD, _ADD, strict=True)):
            x = part * m + c
            least[i] = min(least[i], (x ^ (x >> np.uint64(29))).min())
    return [_digest(np.append(b, np.uint64(i))) for i, b in enumerate(least.reshape(BANDS, ROWS))]


def parities(found: np.ndarray) -> np.ndarray:
    """``WORDS`` words: whether an odd number of the set's hashes falls on each of 64 * ``WORDS`` residues."""
    odd = np.bincount((found % np.uint64(64 * WORDS)).astype("i8"), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype("u1"), bitorder="little").view("<i8")


def with_keys(docs: DataFrame) -> DataFrame:
    """Add ``_set``, a digest of the text's shingle set, ``_bands``, its keys, ``_mark``, its size and parities, and ``_bits``, the text's SimHash; other columns pass through."""
    schema = docs.selectExpr("*", "0L as _set", "array(0L) as _bands", f"cast(null as {MARK}) as _mark", "0L as _bits").schema

    def add(batches):
        for batch in slices(batches, "text", 1024, 8 << 20):
            hashes = [simhash.shingle_hashes(t or "", WIDTH) for t in batch.column("text").to_pylist()]
            sets = [np.unique(h) for h in hashes]
            marks = np.column_stack([np.array([len(s) for s in sets], "i8"), np.array([parities(s) for s in sets])])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([_digest(s) for s in sets], pa.int64()), pa.array([bands(s) for s in sets], pa.list_(pa.int64())),
                 pa.StructArray.from_arrays([pa.array(c) for c in marks.T.copy()], ["n", *(f"p{i}" for i in range(WORDS))]),
                 pa.array([simhash.majority(h) for h in hashes], pa.int64())],
                [*batch.schema.names, "_set", "_bands", "_mark", "_bits"])

    return docs.mapInArrow(add, schema)


def _alike(x: str, y: str, similar: float) -> Column:
    """Whether two sets may be similar enough by their marks: never false for a pair that is."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    differ = reduce(plus, [F.bit_count(F.col(f"{x}.p{i}").bitwiseXOR(F.col(f"{y}.p{i}"))) for i in range(WORDS)])
    return (F.least(n, m) >= similar * F.greatest(n, m) - 1e-6) & ((1 + similar) * differ <= (1 - similar) * (n + m) + 1e-6)


def _fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes (node, _bits) whose fingerprints differ in two bits at most; one node stands for all of its fingerprint."""
    least = materialize(nodes.groupBy("_bits").agg(F.min("node").alias("node")))
    same = nodes.join(least.withColumnRenamed("node", "lead"), "_bits").where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b"))
    near = simhash.linked(least, "_bits").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    of = lambda side: least.select(F.col("_bits").alias(side), F.col("node").alias(f"_{side}"))
    pairs = materialize(same.unionByName(near.join(of("a"), "a").join(of("b"), "b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))))
    drop_written(least)
    return pairs


def _checked(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """Of pairs (a, b) of nodes those whose sets are similar enough."""
    def check(batches):
        held: dict[int, np.ndarray] = {}
        for batch in slices(batches, "_ta", 256, 8 << 20):
            ok = []
            for a, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("a", "_ta", "_tb")), strict=True):
                if a not in held:
                    held = {a: shingles(ta)}
                x, y = held[a], shingles(tb)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(both >= similar * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def asked(side):  # texts of the pairs, and few others, are moved
        return parted(texts, "_set", pairs.select(F.col(side).alias("_set")))[0].select(F.col("_set").alias(side), F.col("text").alias(f"_t{side}"))

    left, right = asked("a"), asked("b")
    return pairs.join(right, "b").join(left, "a").select("a", "b", "_ta", "_tb").mapInArrow(check, "a bigint, b bigint")


def thinned(found: np.ndarray, similar: float) -> list[tuple[int, np.ndarray]]:
    """(level, part of the set whose hashes end in 2 * level zero bits), at every level where a similar set may be.

    Level 0 has sets below ``WHOLE / similar``, level k those from ``WHOLE`` * 4 ** (k - 1)
    to below ``WHOLE / similar`` * 4 ** k, so two sets whose sizes are as near as ``similar`` asks share one.
    """
    out, level = [], 0
    while not level or WHOLE * 4 ** (level - 1) <= len(found):
        if len(found) < WHOLE / similar * 4**level:
            out.append((level, found[found & np.uint64(4**level - 1) == 0]))
        level += 1
    return out


def _rare_keys(texts: DataFrame, similar: float) -> DataFrame:
    """(key, node): the shingles of each thinned set, by falling rarity, that one of any similar set must be among; keys of one node are left out."""
    def spread(batches):
        for batch in slices(batches, "text", 256, 4 << 20):
            parts = [(node, level, x) for node, t in zip(batch.column("_set").to_pylist(), batch.column("text").to_pylist(), strict=True)
                     for level, x in thinned(shingles(t), similar)]
            n = np.array([len(x) for *_, x in parts], "i8")
            level = np.array([level for _, level, _ in parts], "i8")
            keys = np.concatenate([np.zeros(0, "u8"), *[x ^ (_ODD[0] * np.uint64(level)) for _, level, x in parts]]).view("i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(np.repeat(np.array([node for node, *_ in parts], "i8"), n)), pa.array(np.repeat(16 * n + level, n))], ["key", "node", "part"])

    # ``part`` is 16 times the size of the thinned set plus its level.
    rows = materialize(texts.select("_set", "text").mapInArrow(spread, "key bigint, node bigint, part bigint"))
    seen = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = Window.partitionBy("node", "part")
    size, level = F.shiftright("part", 4), F.col("part").bitwiseAND(15)
    met = rows.join(seen, "key").withColumns({
        "_at": F.row_number().over(own.orderBy("n", "key")), "_alone": size - F.count(F.lit(1)).over(own)})
    # Shingles of one set only are the rarest, and take the first places.
    least = F.when(level == 0, similar).otherwise(THINNED * similar / SIMILAR)
    places = size - F.ceil(size * least - 1e-9) + 1
    rare = materialize(met.where(F.col("_at") + F.col("_alone") <= places).select("key", "node"))
    drop_written(rows)
    return rare


class _Groups:
    """Nodes, the links found so far, and the groups they make."""

    def __init__(self, texts: DataFrame, similar: float):
        self.texts, self.similar = texts, similar
        self.edges: DataFrame | None = None
        self.joined: DataFrame | None = None
        self.checked = 0  # pairs

    def open(self, keys: DataFrame) -> DataFrame:
        """(key, node, component) of the keys with members of several groups."""
        now = keys.withColumn("component", F.col("node")) if self.joined is None else keys.join(self.joined, "node", "left").withColumn(
            "component", F.coalesce("component", "node"))
        several = now.groupBy("key").agg((F.min("component") != F.max("component")).alias("_open")).where("_open").select("key")
        return now.join(several, "key")

    def marked(self, keys: DataFrame) -> DataFrame:
        """Rows with a ``node``, and the node's ``_mark``."""
        return keys.join(self.texts.select(F.col("_set").alias("node"), "_mark"), "node")

    def alike(self, pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b) of nodes those that may be similar enough by their marks."""
        mark = lambda side: self.texts.select(F.col("_set").alias(side), F.col("_mark").alias(f"_{side}"))
        return pairs.join(mark("a"), "a").join(mark("b"), "b").where(_alike("_a", "_b", self.similar)).select("a", "b")

    def check(self, pairs: DataFrame) -> int:
        """Check pairs (a, b) of nodes; how many are links."""
        pairs = materialize(pairs.distinct())
        self.checked += pairs.count()
        found = materialize(_checked(pairs, self.texts, self.similar))
        drop_written(pairs)
        links = found.count()
        if links:
            self.edges = found if self.edges is None else materialize(self.edges.unionByName(found))
            self.joined = components(self.edges)
        return links

    def rounds(self, keys: DataFrame, turn: int = 0) -> DataFrame | None:
        """Check every open key's members against one of them, while that links texts; the keys that stay open, None if there are none."""
        while True:
            now = materialize(self.open(keys).select("key", "node", "component"))
            nodes = now.select("node").distinct().count()
            if not nodes:
                return None
            lead = now.groupBy("key").agg(F.min_by(F.struct("node", "component"), F.xxhash64("node", F.lit(turn))).alias("lead"))
            links = self.check(self.alike(now.join(lead, "key").where(F.col("component") != F.col("lead.component")).select(
                F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")).distinct()))
            drop_written(now)
            turn += 1
            if links <= FEW * nodes:
                return self.open(keys)


def groups(rows: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(_set, component) of every node of a written table with ``text``, ``_n`` and the columns of ``with_keys``."""
    return linked_groups(rows, similar)[0]


def linked_groups(rows: DataFrame, similar: float = SIMILAR) -> tuple[DataFrame, int]:
    """``groups``, and how many pairs were checked."""
    one = rows.groupBy("_set").agg(F.min("_n").alias("_n"))
    keyed = rows.select("_n", "_set", F.explode("_bands").alias("key")).join(one.select("_n"), "_n", "left_semi")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    buckets = materialize(keyed.join(shared, "key").select("key", F.col("_set").alias("node")))
    nodes = materialize(rows.select("_n", F.col("_set").alias("node"), "_bits").join(one.select("_n"), "_n", "left_semi").select("node", "_bits"))
    pairs = _fingerprint_pairs(nodes)
    drop_written(nodes)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("_set"))
    near = materialize(buckets.select(F.col("node").alias("_set")).unionByName(ends).distinct())
    # Texts that share no key are not moved; the others are written once for all rounds.
    may, _ = parted(rows.select("_n", "_set", "text", "_mark"), "_set", near)
    texts = materialize(may.join(one.join(near, "_set").select("_n"), "_n", "left_semi").select("_set", "text", "_mark"))
    state = _Groups(texts, similar)
    state.check(state.alike(pairs))
    drop_written(pairs)
    left = state.rounds(buckets)
    if left is not None:
        still = materialize(left.select(F.col("node").alias("_set")).distinct())
        rare = _rare_keys(parted(texts, "_set", still)[0].join(still, "_set", "left_semi"), similar)
        left = state.rounds(rare)
        if left is not None:
            left = materialize(state.marked(left))
            other = left.select("key", F.col("node").alias("b"), F.col("component").alias("_c"), F.col("_mark").alias("_m"))
            state.check(left.withColumnRenamed("node", "a").join(other, "key").where("a < b and component <> _c").where(
                _alike("_mark", "_m", similar)).select("a", "b"))
            drop_written(left)
        drop_written(rare)
    for done in (buckets, near, texts):
        drop_written(done)
    names = rows.select("_set").distinct()
    if state.joined is None:
        return names.withColumn("component", F.col("_set")), state.checked
    found = names.join(state.joined.withColumnRenamed("node", "_set"), "_set", "left").withColumn("component", F.coalesce("component", "_set"))
    return found, state.checked
