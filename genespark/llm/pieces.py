"""SentencePiece encoding and decoding through a table of distinct marked words.

The library writes a space as a marker and puts one in front of a text. Where
no piece of the model has a marker behind another character, no merge crosses
the start of a run of markers, so a text is a sequence of *chunks*, each a run of
markers and the characters up to the next run, and chunks are segmented
independently. Each distinct chunk of the table is segmented once by the library
and joined back to its places in the documents (``blocks`` describes how the
lists travel); a block decodes its distinct chunks once. The model is checked
for this property.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genespark.llm import blocks
from genespark.llm.common import slices

MARK = "▁"
CHUNK = re.compile(" +[^ ]*")


def load(path: str):
    """The processor of a model file whose pieces do not cross markers."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    crossing = re.compile(f"[^{MARK}]{MARK}")
    if any(crossing.search(sp.id_to_piece(i)) for i in range(sp.get_piece_size())):
        raise ValueError("this model has pieces with a marker behind another character")
    if sp.normalize(f"x  {MARK}ﬁ") != f"{MARK}x{MARK * 3}ﬁ":
        raise ValueError("this model changes texts before it segments them")
    return sp


def chunks(text: str) -> list[str]:
    """Chunks of a text with its leading marker; markers are written as spaces. An empty text has none."""
    return CHUNK.findall(" " + text.replace(MARK, " ")) if text else []


def segment(sp, distinct: list[str]) -> list[list[int]]:
    """Ids of every chunk."""
    ids = sp.encode([c[1:] for c in distinct], num_threads=1)  # the library adds the first marker itself
    lone = sp.piece_to_id(MARK)
    return [[lone] if c == " " else x for c, x in zip(distinct, ids, strict=True)]


def decode(sp, ids: list[list[int]]) -> list[bytes]:
    """Text of every chunk, its leading space included."""
    return [b" " + t.encode() for t in sp.decode(ids, num_threads=1)]


def _blocks(batches):
    """(block number, batch, chunk numbers of each text, distinct chunks) of every block."""
    for number, batch in enumerate(slices(batches, "text", blocks.BLOCK_ROWS, blocks.BLOCK_BYTES)):
        known: dict[str, int] = {}
        codes = []
        for text in batch.column("text").to_pylist():
            own = chunks(text or "")
            for c in own:  # in order of appearance: both reads of a block number its chunks alike
                if c not in known:
                    known[c] = len(known)
            codes.append(np.fromiter(map(known.__getitem__, own), "u4", len(own)))
        yield blocks.block_number(number), batch, codes, list(known)


def _numbers(batches):
    """Documents -> one row per block with the chunk numbers of its documents."""
    for block, batch, codes, _ in _blocks(batches):
        flat = np.concatenate(codes)
        planes = flat.view("u1").reshape(-1, 4).T  # equal bytes side by side compress well
        payload = blocks.pack(doc_id=pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("doc_id")),
                              n=[np.array([len(c) for c in codes], "i8")], planes=[planes.reshape(-1)])
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([payload], pa.binary())], ["block", "docs"])


def _lists(buckets: int):
    """Documents -> the distinct chunks of every block, dealt to buckets."""
    def run(batches):
        for block, _, _, known in _blocks(batches):
            words = pa.array(known, pa.string())
            for bucket, mine in enumerate(blocks.dealt(known, buckets)):
                if len(mine):
                    payload = blocks.pack(chunk=words.take(pa.array(mine)), step=np.diff(mine, prepend=0).astype("u4"))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([bucket], pa.int32()), pa.array([block], pa.int64()), pa.array([payload], pa.binary())],
                        ["bucket", "block", "payload"])
    return run


def _segment_bucket(path: str):
    def run(group: pa.Table) -> pa.Table:
        sp = load(path)
        lists = [blocks.unpack(p) for p in group["payload"].to_pylist()]
        words = pa.chunked_array([x["chunk"].combine_chunks() for x in lists]).combine_chunks().dictionary_encode()
        distinct, ids = words.dictionary.to_pylist(), []
        for at in range(0, len(distinct), 10_000):
            ids += segment(sp, distinct[at:at + 10_000])
        ids = pa.array(ids, pa.list_(pa.uint16() if sp.get_piece_size() <= 1 << 16 else pa.uint32()))
        at, out = 0, []
        for x in lists:
            out.append(blocks.pack(step=x["step"].combine_chunks(), ids=ids.take(words.indices[at:at + len(x)])))
            at += len(x)
        return pa.table([group["block"].combine_chunks(), pa.array(out, pa.binary())], ["block", "payload"])

    return run


def _join_block(path: str):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(group: pa.Table) -> pa.Table:
        sp = load(path)
        parts = [blocks.unpack(p) for p in group["payload"].drop_null().to_pylist()]
        size = sum(len(p) for p in parts)
        count, ids, back = np.zeros(size, "i8"), np.empty(size, object), np.empty(size, object)
        for p in parts:
            code, own = np.cumsum(p["step"].to_numpy().astype("i8")), p["ids"].to_pylist()
            count[code] = [len(x) for x in own]
            ids[code] = [b" ".join(b"%d" % i for i in x) for x in own]
            back[code] = decode(sp, own)
        docs, = (blocks.unpack(p) for p in group["docs"].drop_null().to_pylist())
        doc_id, n, planes = (docs[c].combine_chunks().flatten() for c in ("doc_id", "n", "planes"))
        codes = np.ascontiguousarray(planes.to_numpy().reshape(4, -1).T).view("u4").reshape(-1)
        if len(codes) and codes.max() >= size:
            raise RuntimeError("a block's documents and its list of chunks differ: the input changed between two reads")
        tokens, shas, decoded, at = [], [], [], 0
        last = b"%d" % sp.eos_id()
        for k in n.to_pylist():
            own = codes[at:at + k]
            at += k
            tokens.append(int(count[own].sum()) + 1)
            shas.append(hashlib.sha256(b" ".join([*ids[own], last])).hexdigest())
            decoded.append(hashlib.sha256(b"".join(back[own])[1:]).hexdigest())
        return pa.table([doc_id, pa.array(tokens, pa.int64()), pa.array(shas), pa.array(decoded)], schema=schema)

    return run


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens (end id included), ids_sha256 and decoded_sha256 of every document.

    The ids are those of the sentencepiece library with an end id and without a
    begin id; they are decoded by its rules. A null text is empty: one id, and
    the empty text back. Repeated rows give a row each, a null doc_id stays
    null, other columns are not read. ``docs`` is read twice and must give the
    same rows in the same files both times; a difference is reported.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    lists = docs.mapInArrow(_lists(blocks.bucket_count(docs)), "bucket int, block bigint, payload binary")
    found = lists.groupBy("bucket").applyInArrow(_segment_bucket(path), "block bigint, payload binary")
    both = docs.mapInArrow(_numbers, "block bigint, docs binary").unionByName(found, allowMissingColumns=True)
    return both.groupBy("block").applyInArrow(
        _join_block(path), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
