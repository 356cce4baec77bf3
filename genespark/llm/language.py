"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is folded to lower-case letters and single spaces; its 1-, 2- and 3-grams
are hashed into ``BUCKETS`` features. Fitting counts the features per language;
scoring adds the log probabilities of a document's features, for a batch of
documents at a time in numpy. The matrix (buckets x languages) is broadcast; its
size is bounded by ``BUCKETS`` and ``MAX_LANGUAGES``.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genespark.llm.common import slices

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
MAX_LANGUAGES = 256
SAMPLE = 10_000  # training documents per language, about
FIT_TASKS = 32
PART = 1 << 10  # buckets of one row of counts
UNKNOWN = "und"


@lru_cache(1)
def _fold() -> np.ndarray:
    """Code point -> its lower-case letter, or a space."""
    out = np.full(0x110000, 32, "u4")
    for c in range(0x110000):
        ch = chr(c)
        if unicodedata.category(ch)[0] == "L":
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def features(texts: list[str]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(letters per text, [(text number, bucket) of every n-gram, one pair of arrays per order])."""
    padded = [f" {t} " for t in texts]
    x = _fold()[np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "u4")]
    doc = np.repeat(np.arange(len(texts), dtype="i4"), [len(t) for t in padded])
    letters = np.bincount(doc[x != 32], minlength=len(texts))
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != 32) | (x[:-1] != 32) | (doc[1:] != doc[:-1])
    x, doc, out = x[keep], doc[keep], []
    for n in ORDERS:
        if len(x) < n:
            break
        key = np.full(len(x) - n + 1, n, "u4")
        for k in range(n):
            key = (key + x[k:len(x) - n + 1 + k]) * np.uint32(2654435761)
            key ^= key >> np.uint32(15)
        own = doc[:len(x) - n + 1] == doc[n - 1:]
        out.append((doc[:len(x) - n + 1][own], (key[own] % np.uint32(BUCKETS)).astype("i4")))
    return letters, out


def _count(batches):
    """(text, lang) -> feature counts of this task, one row per language and range of buckets."""
    counts: dict[str, np.ndarray] = {}
    for batch in slices(batches, "text", 1024, 2 << 20):
        langs = batch.column("lang").to_pylist()
        names = sorted(set(langs))
        code = np.array([names.index(v) for v in langs])
        for doc, bucket in features([t or "" for t in batch.column("text").to_pylist()])[1]:
            both = np.bincount(code[doc] * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
            for name, row in zip(names, both, strict=True):
                counts[name] = counts[name] + row if name in counts else row
    for name, row in counts.items():
        for part in range(0, BUCKETS, PART):
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([part], pa.int32()), pa.array([row[part:part + PART].astype("<i8").tobytes()], pa.binary())],
                ["lang", "part", "n"])


def _add(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(b, "<i8") for b in group["n"].to_pylist())
    return pa.table([group["lang"][:1], group["part"][:1], pa.array([total.tobytes()], pa.binary())], ["lang", "part", "n"])


def held_out(id_col: str = "doc_id") -> Column:
    """Documents of every fifth id hash are never learned from; a null id is held out too."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, sample: int = SAMPLE, max_languages: int = MAX_LANGUAGES) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log priors, log probabilities by bucket and language) from ``text`` and ``lang``.

    All rows are counted for the priors. Feature counts come from about
    ``sample`` documents per language, picked by a hash of the id; languages
    with fewer use all. More than ``max_languages`` languages are an error, for
    the matrix is broadcast.
    """
    size = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(max_languages + 1).collect()
    if len(size) > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages if the broadcast matrix may grow")
    langs = [r["lang"] for r in size]
    if not langs:
        return [], np.zeros(0), np.zeros((BUCKETS, 0), "f4")
    rate = F.element_at(F.create_map(*[F.lit(v) for r in size for v in (r["lang"], min(1.0, sample / r["n"]))]), F.col("lang"))
    pick = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fit")), F.lit(1 << 30)) < rate * (1 << 30)
    rows = docs.where(pick).repartition(FIT_TASKS, F.xxhash64("doc_id", "text")).select("text", "lang")
    schema = "lang string, part int, n binary"
    got = rows.mapInArrow(_count, schema).groupBy("lang", "part").applyInArrow(_add, schema).toArrow()
    counts = np.zeros((BUCKETS, len(langs)), "f8")
    for lang, part, n in zip(*(got[c].to_pylist() for c in ("lang", "part", "n")), strict=True):
        counts[part:part + PART, langs.index(lang)] = np.frombuffer(n, "<i8")
    logs = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * BUCKETS)).astype("f4")
    prior = np.array([r["n"] for r in size], "f8")
    return langs, np.log(prior / prior.sum()), logs


def score_texts(texts: list[str], langs: list[str], prior: np.ndarray, logs: np.ndarray) -> tuple[list[str], np.ndarray]:
    """(language, posterior) of each text; ``und`` and 0 where there are no letters or no languages. Ties go to the first language."""
    letters, grams = features(texts)
    if not langs:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    total = np.tile(prior, (len(texts), 1))
    for doc, bucket in grams:
        for k in range(len(langs)):
            total[:, k] += np.bincount(doc, logs[bucket, k], minlength=len(texts))
    best = total.argmax(axis=1)
    top = total[np.arange(len(texts)), best]
    share = 1 / np.exp(total - top[:, None]).sum(axis=1)
    known = letters > 0
    return [langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, share, 0.0)


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document.

    Learns only from ``text`` and ``lang`` of documents that are not held out
    and whose lang is not null; predictions see the text alone. A text that is
    null or has no letters gets ``und`` and score 0. A null doc_id counts as
    held out. Repeated rows give a row each; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", held_out().alias("held_out"))
    model = docs.sparkSession.sparkContext.broadcast(fit(docs.where("not held_out and lang is not null"), sample))

    def run(batches):
        for batch in slices(batches, "text", 1024, 2 << 20):
            names, share = score_texts([t or "" for t in batch.column("text").to_pylist()], *model.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(share, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")
