"""Blocks of documents with a dictionary of their distinct pieces.

Several text operators split every document into pieces (pre-tokens, marked
words), work once per *distinct* piece of the whole table, and bring the result
back to the documents. Rows of (document, piece) would be as many as there are
words, so documents are taken in blocks of a bounded number of bytes:

* a block lists its distinct pieces once, and a document refers to a piece by
  its number in the block's list;
* the lists are dealt by the hash of the piece into buckets, so a bucket meets
  each distinct piece of the table, and each block holds a piece at most once:
  a word that stands in every document is one row per block, not a hot key;
* what a bucket finds goes back to the blocks.

Lists travel as small Arrow streams in binary columns. The number of buckets
follows the size of the table, so a bucket stays small.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 16_384
BLOCK_BYTES = 24 << 20
BUCKET_BYTES = 16 << 20
BLOCK_BITS = 24  # of a block's number within its task


def pack(**columns) -> bytes:
    """Columns as one compressed Arrow stream."""
    batch = pa.record_batch(list(columns.values()), list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> pa.Table:
    with pa.ipc.open_stream(pa.py_buffer(data)) as stream:
        return stream.read_all()


def bucket_count(docs: DataFrame, column: str = "text") -> int:
    """Buckets of about ``BUCKET_BYTES`` of text, and at least one per shuffle partition."""
    total = docs.agg(F.sum(F.octet_length(column)).alias("s")).first()["s"] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / BUCKET_BYTES))


def dealt(pieces: Sequence[str], buckets: int) -> list[np.ndarray]:
    """Numbers of the pieces that fall in each bucket."""
    at = np.fromiter((zlib.crc32(p.encode()) % buckets for p in pieces), "i8", len(pieces))
    order = np.argsort(at, kind="stable")
    return np.split(order, np.searchsorted(at[order], np.arange(1, buckets)))


def block_number(n: int) -> int:
    """A number of its own for the n-th block of this task; a task that is run again gives the same."""
    from pyspark import TaskContext

    return (TaskContext.get().partitionId() << BLOCK_BITS) + n
