"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Documents become pieces of at most ``capacity`` tokens; only longer documents
are cut. A piece longer than half a sequence opens one of its own. The others
are placed in bulk-synchronous rounds:

1. pieces are range-sorted by length and gaps (the free ends of sequences) by
   size, and each has a rank among its equals;
2. a successor sweep from the longest pieces down gives each length the
   smallest gap size that still holds it. The sweep works on the number of
   pieces per length and of gaps per size, at most ``2 * capacity`` numbers,
   and yields ranges of ranks;
3. conflicts are settled by rank: the first pieces of a length take the first
   gaps of the size (as many pieces per gap as fit), the others the next size;
4. pieces join their gaps on (size, rank), and the gaps shrink;

until all pieces are placed. A gap that was used shrinks below the length that
used it, so gaps at least halve and the rounds are few. Sequences are opened
before a round: as many as the tokens need beyond the gaps, and, when a round
placed nothing, as many as the rest needs. No size class is gathered in a task:
ranks come from range-partitioned chunks and are then only shifted.
"""

from __future__ import annotations

import math
import struct
import zlib
from bisect import bisect_left
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genespark.llm import pretokens
from genespark.llm.common import drop_written, slices
from genespark.llm.sharding import slots
from genespark.session import materialize

CAPACITY = 2048
END_ID = 0
KNOWN_WORDS = 300_000  # words whose ids a worker remembers at a time
PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class WordIds(dict):
    """Ids of texts as little-endian 32-bit bytes, equal to those of the tokenizer file.

    A word's ids do not depend on its neighbours, so a worker asks the model once
    per distinct word and remembers a bounded number of them.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = pretokens.load(path)
        self.special = pretokens.special_strings(self.tokenizer)
        self.model, self.letters = self.tokenizer.model, pretokens.byte_letters()

    def __missing__(self, word: str) -> bytes:
        """Ids of a word that is lower-cased and split off already, so only the model is asked."""
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = ids = _packed([t.id for t in self.model.tokenize(word.translate(self.letters))])
        return ids

    def of(self, text: str) -> bytes:
        parts = self.special.split(text) if "<|" in text else [text]
        out = []
        for k, part in enumerate(parts):
            low = part.lower()
            if k % 2:
                out.append(_packed([self.tokenizer.token_to_id(part)]))
            elif pretokens.WIDE.search(part) or pretokens.WIDE.search(low) or "İ" in part:
                # only the library normalises and splits such texts right
                out.append(_packed(self.tokenizer.encode(part, add_special_tokens=False).ids))
            else:
                out += map(self.__getitem__, pretokens.word_pattern().findall(low))
        return b"".join(out)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(1)
def word_ids(path: str) -> WordIds:
    """One per worker, so tasks that follow each other share what it remembers."""
    return WordIds(path)


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length and crc32 of its ids (the document's end id included)."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches):
        ids_of = word_ids(path)
        end = END_ID.to_bytes(4, "little")
        for batch in slices(batches, "text", 1024, 4 << 20):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = memoryview(ids_of.of(text or "") + end)
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = zip(*rows, strict=True)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, PIECE)


@dataclass
class Sizes:
    """Number of unplaced pieces by length, rank of the first of them, and number of gaps by size."""

    capacity: int
    pieces: dict[int, int]
    first: dict[int, int] = field(default_factory=dict)
    gaps: dict[int, int] = field(default_factory=dict)

    def to_open(self, stuck: bool) -> int:
        """Empty sequences to add before the next round."""
        tokens = sum(n * c for n, c in self.pieces.items())
        least = min(self.pieces)
        free = 0 if stuck else sum(g * c for g, c in self.gaps.items() if g >= least)
        return math.ceil(max(0, tokens - free) / self.capacity)

    def sweep(self) -> tuple[list[tuple], list[tuple]]:
        """One round: (length, from rank, to rank, gap, gap rank, pieces per gap) and
        (gap, from rank, to rank, new gap, new rank) rows; updates the counts.
        """
        used = dict.fromkeys(self.gaps, 0)
        open_sizes = sorted(g for g, c in self.gaps.items() if c)
        match, shrink, after = [], [], {}

        def moved(gap: int, start: int, n: int, new: int) -> None:
            if n:
                shrink.append((gap, start, start + n, new, after.get(new, 0)))
                after[new] = after.get(new, 0) + n

        for length in sorted(self.pieces, reverse=True):
            while self.pieces[length]:
                at = bisect_left(open_sizes, length)
                if at == len(open_sizes):
                    break
                gap = open_sizes[at]
                each = gap // length
                bins = min(self.gaps[gap] - used[gap], -(-self.pieces[length] // each))
                n = min(self.pieces[length], bins * each)
                start, rank = used[gap], self.first.get(length, 0)
                match.append((length, rank, rank + n, gap, start, each))
                moved(gap, start, n // each, gap - each * length)
                moved(gap, start + n // each, bins - n // each, gap - n % each * length)
                used[gap] += bins
                self.pieces[length] -= n
                self.first[length] = rank + n
                if used[gap] == self.gaps[gap]:
                    del open_sizes[at]
        for gap, c in self.gaps.items():
            moved(gap, used[gap], c - used[gap], gap)
        self.pieces = {k: c for k, c in self.pieces.items() if c}
        self.gaps = after
        return match, shrink


def _ranges(spark, rows: list[tuple], names: str) -> DataFrame:
    """A round's ranges: their number is bounded by the capacity, so they are broadcast."""
    return F.broadcast(spark.createDataFrame(rows, ", ".join(f"{n} bigint" for n in names.split())))


def _within(table: DataFrame, ranges: DataFrame, size: str, rank: str) -> DataFrame:
    """Rows whose size and rank fall in a range; its columns are _size, _lo, _hi and more."""
    return table.join(ranges, (F.col(size) == F.col("_size")) & (F.col(rank) >= F.col("_lo")) & (F.col(rank) < F.col("_hi")))


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` from 1 to ``capacity``.

    ``offset`` is the place in the sequence, gapless from 0. Repeated rows are
    separate pieces. ``pieces`` is read twice (range sorting samples it first),
    so pass a written table. An empty table gives an empty result. Columns that start
    with an underscore, sequence_id, offset and slot are the operator's own.
    """
    spark = pieces.sparkSession
    own = [c for c in pieces.columns if c != "length"]
    by_length = pieces.repartitionByRange("length", F.xxhash64(*own))
    ranked = materialize(slots(by_length, "length", tuple(own)).withColumnRenamed("slot", "_rank"))
    counts = {r["length"]: r["n"] for r in ranked.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Long pieces open a sequence each; the sequences of a length are numbered on from those of longer pieces.
    base, opened = [], 0
    for length in sorted(counts, reverse=True):
        if 2 * length > capacity:
            base.append((length, 0, counts[length], opened))
            opened += counts[length]
    long = _within(ranked, _ranges(spark, base, "_size _lo _hi _base"), "length", "_rank").withColumn(
        "sequence_id", F.col("_base") + F.col("_rank"))
    done = [materialize(long.select(*pieces.columns, "sequence_id", F.lit(0).cast("bigint").alias("offset")))]
    gaps = materialize(long.where(F.col("length") < capacity).select(
        "sequence_id", (capacity - F.col("length")).alias("_gap"), F.col("_rank").alias("_gap_rank")))
    rest = materialize(ranked.where(2 * F.col("length") <= capacity))
    drop_written(ranked)
    state = Sizes(capacity, {k: c for k, c in counts.items() if 2 * k <= capacity},
                  gaps={capacity - k: c for k, c in counts.items() if capacity / 2 < k < capacity})
    stuck = False
    while state.pieces:
        more = state.to_open(stuck)
        at = state.gaps.get(capacity, 0)
        if more:
            gaps = gaps.unionByName(spark.range(more).select(
                (F.col("id") + opened).alias("sequence_id"), F.lit(capacity).cast("bigint").alias("_gap"), (F.col("id") + at).alias("_gap_rank")))
            state.gaps[capacity] = at + more
            opened += more
        match, shrink = state.sweep()
        stuck = not match
        nth = F.col("_rank") - F.col("_lo")
        placed = _within(rest, _ranges(spark, match, "_size _lo _hi _gap _first _each"), "length", "_rank").withColumns(
            {"_gap_rank": F.col("_first") + F.floor(nth / F.col("_each")), "_nth": nth % F.col("_each")})
        done.append(materialize(placed.join(gaps, ["_gap", "_gap_rank"]).select(
            *pieces.columns, "sequence_id", (capacity - F.col("_gap") + F.col("_nth") * F.col("length")).alias("offset"))))
        old = (gaps, rest)
        gaps = materialize(_within(gaps, _ranges(spark, shrink, "_size _lo _hi _new _base"), "_gap", "_gap_rank").select(
            "sequence_id", F.col("_new").alias("_gap"), (F.col("_base") + F.col("_gap_rank") - F.col("_lo")).alias("_gap_rank")))
        left = [(k, state.first.get(k, 0), state.first.get(k, 0) + c) for k, c in state.pieces.items()]
        rest = materialize(_within(rest, _ranges(spark, left, "_size _lo _hi"), "length", "_rank").select(*rest.columns))
        for t in old:
            drop_written(t)
    out = done[0]
    for t in done[1:]:
        out = out.unionByName(t)
    return out


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Ids are those of the ``tokenizers`` file ``path`` without added special
    tokens, then the end id 0. A null text is empty: one piece of one token.
    Repeated rows are packed once each, a null doc_id stays null, other columns
    are not read.
    """
    return pack_pieces(materialize(pieces_of(docs, path, capacity)), capacity)
