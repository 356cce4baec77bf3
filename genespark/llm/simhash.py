"""SimHash fingerprints and near-duplicate groups by multi-index hashing.

Two fingerprints of 64 bits link when at most two bits differ. Cut into halves
a and b, such a pair has one of these forms, and each is an exact lookup:

* a equal, b in at most 2 bits: b has three parts, one of them equal;
* a in exactly 1 bit, b in at most 1: probe every a' of the radius-1 ball around
  a; b has two parts, one of them equal;
* b equal, a in exactly 2 bits: a has three parts, one of them equal.

A ball is enumerated from one side only: of two halves that differ in one bit,
the one with a zero there probes. So a key holds at least 42 bits of the
fingerprint, candidates stay few even among thousands of near copies, and each
candidate is verified on all 64 bits. Texts with equal fingerprints are one
node; a node has at most 64 + 2016 others within two bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genespark.llm.common import components, drop_written, slices
from genespark.session import materialize

SEED = 42
SPREAD = 1 << 15  # words of one text whose hashes are unpacked to bits at a time


def shingle_hashes(text: str, width: int = 3) -> np.ndarray:
    """Unsigned XXH64 of a text's shingles in order, repeats included; none for a wordless text."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and the ASCII white space
    if not words:
        return np.zeros(0, "<u8")
    if len(words) <= width:
        shingles: Iterator[bytes] = iter([b" ".join(words)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
        n = len(words) - width + 1
    return np.fromiter(map(partial(xxh64_intdigest, seed=SEED), shingles), "<u8", n)


def majority(hashes: np.ndarray) -> int:
    """Signed 64-bit SimHash: a bit is set where over half the hashes have it."""
    ones = np.zeros(64, "i8")
    for at in range(0, len(hashes), SPREAD):
        part = hashes[at:at + SPREAD].view("u1").reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype="i8")
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: str, width: int = 3) -> int:
    """Signed 64-bit SimHash of one text; see ``fingerprints``."""
    return majority(shingle_hashes(text, width))


def fingerprints(docs: DataFrame, width: int = 3, out: str = "fingerprint_bits") -> DataFrame:
    """Add a bigint SimHash of the ``text`` of every document; other columns pass through.

    Words are the runs of non-white characters with A-Z lower-cased, shingles
    are ``width`` words with repeats. A text with fewer words has one shingle,
    its whole sequence. Null and wordless texts have fingerprint zero.
    """
    if out in docs.columns:
        raise ValueError(f"documents already have a column {out}")
    schema = docs.withColumn(out, F.lit(0).cast("bigint")).schema

    def add(batches):
        for batch in slices(batches, "text", 2048, 8 << 20):
            bits = [fingerprint(t or "", width) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bits, pa.int64())], [*batch.schema.names, out])

    return docs.mapInArrow(add, schema)


def _bits(x: Column, low: int, n: int) -> Column:
    return F.shiftrightunsigned(x, low).bitwiseAND(F.lit((1 << n) - 1))


def _keys(x: str) -> tuple[Column, Column]:
    """Arrays of (table keys, probe keys) of the fingerprint column ``x``."""
    a, b = _bits(F.col(x), 32, 32), _bits(F.col(x), 0, 32)
    thirds, halves = ((0, 11), (11, 11), (22, 10)), ((0, 16), (16, 16))

    def keys(form: int, whole: Column, cut: Column, parts) -> list[Column]:
        return [F.xxhash64(F.lit(form), F.lit(p), whole, _bits(cut, *part)) for p, part in enumerate(parts)]

    same_a, same_b = keys(0, a, b, thirds), keys(2, b, a, thirds)
    table = F.array(*same_a, *keys(1, a, b, halves), *same_b)
    zeros = F.filter(F.sequence(F.lit(0), F.lit(31)), lambda i: F.getbit(a, i) == 0)
    flip = lambda i: a + F.call_function("shiftleft", F.lit(1).cast("bigint"), i)
    ball = F.flatten(F.transform(zeros, lambda i: F.array(*keys(1, flip(i), b, halves))))
    return table, F.concat(F.array(*same_a, *same_b), ball)


def linked(nodes: DataFrame, x: str = "fingerprint_bits", distance: int = 2) -> DataFrame:
    """Pairs (a, b), a <> b, of distinct fingerprints that differ in at most two bits; each pair once or twice."""
    if distance > 2:
        raise ValueError("the probes enumerate up to two differing bits")
    table, probe = _keys(x)
    left = nodes.select(F.col(x).alias("a"), F.explode(probe).alias("key"))
    right = nodes.select(F.col(x).alias("b"), F.explode(table).alias("key"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return left.join(right, "key").where((F.col("a") != F.col("b")) & near).select("a", "b")


def near_duplicate_groups(rows: DataFrame, x: str = "fingerprint_bits", distance: int = 2) -> DataFrame:
    """Add ``component`` and ``component_id`` to a written table with doc_id and the fingerprint ``x``.

    ``component_id`` is the smallest doc_id that links lead to, the document's
    own included; a null doc_id counts only where the group has no other.
    ``component`` numbers the groups. Repeated rows keep one row each; an empty
    table gives an empty result.
    """
    nodes = materialize(rows.groupBy(x).agg(F.min("doc_id").alias("least")))
    pairs = materialize(linked(nodes, x, distance).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    joined = components(pairs).withColumnRenamed("node", x)
    classes = nodes.join(joined, x, "left").withColumn("component", F.coalesce("component", x))
    names = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(classes.join(names, "component").select(x, "component", "component_id"))
    for old in (pairs, joined, nodes):
        drop_written(old)
    return rows.join(named, x)


def simhash_documents(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    rows = materialize(fingerprints(docs.select("doc_id", "text")).drop("text"))
    return near_duplicate_groups(rows).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint_bits"), 16, "0")).alias("fingerprint"), "component_id")
