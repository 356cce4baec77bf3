"""Substring deduplication by content-defined chunking.

A gear rolling hash runs over the bytes of a text; of every ``NEAR`` places in a
row where a cut may fall, a chunk ends at the one with the smallest hash. A cut
depends on the bytes around it alone, so an insertion moves no cuts further on and
a passage that stands in two documents is cut alike in both, but for its ends: at
most ``NEAR`` + 3 + ``LEAST`` - 1 words at its head and ``NEAR`` at its tail are lost,
so a passage of 50 words always has ``MIN_WORDS`` in whole chunks, if no word stands
there several times in a row. Chunks are deduplicated by
digest: the first occurrence (smallest doc_id, then place) stays. A later one is
removed where it lies in a run of consecutive repeated chunks of at least
``MIN_WORDS`` words, so short phrases that many texts share are left alone. Text
without white space has cuts at characters, and ``WORD_BYTES`` bytes of it count
as a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genespark.llm.common import row_key, slices
from genespark.session import materialize

WINDOW = 8  # bytes; each moves the 64 bits of the gear hash by 8
NEAR = 12  # places among which the smallest hash ends a chunk
LEAST = 4  # words that a digest covers
MAX_BYTES = 4096
MIN_WORDS = 20
UNBROKEN = 32  # bytes without white space, from which on a cut may fall inside a word
WORD_BYTES = 6  # of an unbroken stretch, that count as a word
_GEAR = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype="u8")
_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash after each byte: h = (h << 8) + table[byte], so that ``WINDOW`` bytes count."""
    h = _GEAR[data]
    step = 1
    while step < WINDOW:  # h over 2s bytes from two h over s bytes
        h[step:] += h[:-step] << np.uint64(8 * step)
        step *= 2
    return h ^ (h >> np.uint64(32))


def unbroken(data: np.ndarray) -> np.ndarray:
    """Per byte: whether it and the ``UNBROKEN`` - 1 bytes before it have no white space."""
    at = np.arange(len(data))
    return at - np.maximum.accumulate(np.where(_WHITE[data], at, -1)) >= UNBROKEN


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of one text, as byte positions; the last is its length.

    A cut may fall after white space and, in text without it (``unbroken``), where
    the hash picks an end of a character, every ``WORD_BYTES`` bytes on average. The
    rightmost smallest hash of ``NEAR`` such
    places in a row is a cut; a place with the hash of the one before is none, so
    a word that is said over and over is not cut. A chunk has at most
    ``MAX_BYTES`` bytes: text without a cut is cut there, at the start of a character.
    """
    n = len(data)
    if not n:
        return np.zeros(0, "i8")
    hashes = gear(data)
    ends = np.append(data[1:] & 0xC0 != 0x80, True)  # of characters
    share = np.where(data < 128, WORD_BYTES, 2).astype("u8")  # other characters mostly have three bytes
    places = np.flatnonzero(_WHITE[data] | unbroken(data) & ends & ((hashes >> np.uint64(40)) % share == 0))
    value = hashes[places]
    new = np.ones(len(places), bool)
    new[1:] = value[1:] != value[:-1]
    places, value = places[new] + 1, value[new]
    found = np.zeros(0, "i8")
    if len(places) >= NEAR:
        best = value[:len(value) - NEAR + 1].copy()
        where = np.arange(len(best))
        for k in range(1, NEAR):
            other = value[k:k + len(best)]
            less = other <= best
            best[less] = other[less]
            where[less] = np.flatnonzero(less) + k
        found = places[np.unique(where)]
    out, last = [], 0
    for at in [*found.tolist(), n]:
        while at - last > MAX_BYTES:
            forced = last + MAX_BYTES
            while data[forced] & 0xC0 == 0x80:
                forced -= 1
            out.append(forced)
            last = forced
        if at > last:
            out.append(at)
            last = at
    return np.array(out, "i8")


def split_text(text: str) -> list[tuple[int, int, int, int]]:
    """Chunks of a text: (first code point, end code point, words, 64-bit digest)."""
    return [(a, b, n, d) for a, b, n, _, d in measured(text)]


def measured(text: str) -> list[tuple[int, int, int, int, int]]:
    """Chunks of a text: (first code point, end code point, words, unbroken bytes, 64-bit digest).

    The digest is taken of the chunk with each run of white space as one space,
    so a passage that was wrapped anew is still the same. Of a chunk with fewer
    than ``LEAST`` words it is taken together with the chunks before that make up
    as many, so that a run does not go on by a word or two that many texts have.
    """
    from xxhash import xxh3_64_intdigest

    raw = np.frombuffer(text.encode(), "u1")
    white = _WHITE[raw]
    keep = np.ones(len(raw), bool)
    keep[1:] = ~(white[1:] & white[:-1])
    place = np.flatnonzero(keep)
    data = np.where(white, np.uint8(32), raw)[place]
    ends = cuts(data)
    starts = np.concatenate([[0], ends[:-1]]).astype("i8") if len(ends) else ends
    place = np.append(place, len(raw))
    point = np.concatenate([[0], np.cumsum(raw & 0xC0 != 0x80)])  # code points before each byte
    word = data != 32
    solid = np.concatenate([[0], np.cumsum(unbroken(data))])
    begins = np.concatenate([[0], np.cumsum(word & np.concatenate([[True], ~word[:-1]]))]) if len(data) else np.zeros(1, "i8")
    body = data.tobytes()
    # The last chunk start that leaves enough words before the end, or the text's start.
    enough = np.searchsorted((held := begins + solid // WORD_BYTES)[starts], held[ends] - LEAST, side="right") - 1
    since = starts[np.clip(np.minimum(enough, np.arange(len(starts))), 0, None)]
    return [
        (int(point[place[a]]), int(point[place[b]]), int(begins[b] - begins[a]), int(solid[b] - solid[a]), xxh3_64_intdigest(body[c:b]) - (1 << 63))
        for a, b, c in zip(starts.tolist(), ends.tolist(), since.tolist(), strict=True)]


def chunks(docs: DataFrame) -> DataFrame:
    """One row per chunk: id, key, n (from 0), start and end (code points, end exclusive), words, solid, digest, again.

    ``id`` is the doc_id (where null: ``key``), ``key`` tells texts with one
    doc_id apart, ``solid`` counts the ``unbroken`` bytes, ``again`` says that the text had the chunk before. Null and
    empty texts have no chunk.
    """
    names = ["id", "key", "n", "start", "end", "words", "solid", "digest", "again"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.bool_()]

    def run(batches):
        for batch in slices(batches, "text", 1024, 4 << 20):
            found = [measured(t or "") for t in batch.column("text").to_pylist()]
            sizes = np.array([len(x) for x in found], "i8")
            row = pa.array(np.repeat(np.arange(len(found)), sizes))
            flat = np.array([c for x in found for c in x], "i8").reshape(-1, 5).T
            n = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            again = np.ones(len(n), bool)
            at = 0
            for x in found:
                again[at + np.unique(flat[4][at:at + len(x)], return_index=True)[1]] = False
                at += len(x)
            columns = [batch.column("id").take(row), batch.column("key").take(row), n, *flat, again]
            yield pa.RecordBatch.from_arrays([pa.array(c).cast(t) for c, t in zip(columns, types, strict=True)], names)

    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), row_key()).alias("id"), row_key().alias("key"), "text")
    return rows.mapInArrow(run, "id bigint, key bigint, n int, start int, end int, words int, solid int, digest bigint, again boolean")


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Spans of texts that repeat an earlier run of chunks: id, key, start, end, words, first_doc_id.

    Documents without one have no row. ``first_doc_id`` is the document that
    keeps the span's first chunk. Rows with one doc_id are one document: what
    their texts share stays, and repeated rows get the same spans. A null doc_id
    stands for a document of its own. Of what a text repeats within itself the
    first occurrence stays.
    """
    table = materialize(chunks(docs))
    first = table.where("not again").groupBy("digest").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id")).where(
        "first_id < last_id").select("digest", "first_id")
    later = table.join(first, "digest", "left").where("again or id > first_id")
    one = later.groupBy("id", "key", "n").agg(
        F.min("start").alias("start"), F.min("end").alias("end"), F.min("words").alias("words"), F.min("solid").alias("solid"),
        F.min(F.coalesce("first_id", "id")).alias("from"))
    # A document's repeated chunks are ranked together: they are parts of one text.
    order = Window.partitionBy("id", "key").orderBy("n")
    return (one.withColumn("run", F.col("n") - F.row_number().over(order)).groupBy("id", "key", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words"), F.sum("solid").alias("solid"), F.min_by("from", "n").alias("first_doc_id"))
        .where(F.col("words") + F.floor(F.col("solid") / WORD_BYTES) >= min_words).drop("run", "solid"))


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, start, end, n_words and first_doc_id of every passage that repeats an earlier one.

    Positions are code points of the whole text, end exclusive.
    """
    return repeated_spans(docs.select("doc_id", "text"), min_words).select(
        F.when(F.col("id") != F.col("key"), F.col("id")).alias("doc_id"), "start", "end", F.col("words").cast("bigint").alias("n_words"), "first_doc_id")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Documents with later copies of passages cut out of ``text``; all rows and columns stay.

    A text of which nothing is left is the empty text. Texts without repeats are
    unchanged, null texts stay null.
    """
    spans = repeated_spans(docs.select("doc_id", "text"), min_words).groupBy(F.col("id").alias("_id"), F.col("key").alias("_key")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_cut"))
    starts = F.concat(F.array(F.lit(0)), F.col("_cut.end"))
    ends = F.concat(F.col("_cut.start"), F.array(F.length("text")))
    kept = F.array_join(F.zip_with(starts, ends, lambda a, b: F.substring(F.col("text"), a + 1, b - a)), "")
    own = docs.withColumns({"_key": row_key(), "_id": F.coalesce(F.col("doc_id").cast("bigint"), row_key())})
    return own.join(spans, ["_id", "_key"], "left").withColumn(
        "text", F.when(F.col("_cut").isNull(), F.col("text")).otherwise(kept)).select(*docs.columns)
