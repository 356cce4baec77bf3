"""Token counts without token ids.

Pre-tokens are split off per document and counted (``blocks`` describes how
they travel). Every distinct pre-token of the table goes through the tokenizer
once; its number of tokens is joined to the per-document frequencies and summed.
No list of ids is built for a document.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genespark.llm import blocks, pretokens
from genespark.llm.common import slices
from genespark.session import materialize

MOST = np.iinfo("u2").max
PART = "bucket int, block bigint, payload binary, doc_id bigint, ord int, n_bytes bigint, n_tokens bigint"


def _frequencies(path: str, buckets: int):
    """Documents -> one row per document, and the block's pre-token frequencies dealt to buckets."""
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("payload", pa.binary()), ("doc_id", pa.int64()),
                        ("ord", pa.int32()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        tokenizer = pretokens.load(path)
        special = pretokens.special_strings(tokenizer)
        for number, batch in enumerate(slices(batches, "text", blocks.BLOCK_ROWS, blocks.BLOCK_BYTES)):
            block, known = blocks.block_number(number), {}
            codes, ords, freqs, sizes, specials = [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                text = text or ""
                parts = special.split(text) if "<|" in text else [text]
                counted = Counter()
                for part in parts[::2]:
                    counted.update(pretokens.byte_level_pieces(part, tokenizer))
                sizes.append(len(text.encode()))
                specials.append(len(parts) // 2)
                codes.append(np.fromiter((known.setdefault(p, len(known)) for p in counted), "u4", len(counted)))
                freqs.append(np.fromiter(counted.values(), "u4", len(counted)))
                ords.append(np.full(len(counted), i, "u2"))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.nulls(n, pa.int32()), pa.array(np.full(n, block)), pa.nulls(n, pa.binary()),
                batch.column("doc_id").cast(pa.int64()), pa.array(np.arange(n, dtype="i4")),
                pa.array(sizes, pa.int64()), pa.array(specials, pa.int64())], schema=schema)
            code, ord_, freq = (np.concatenate(x) for x in (codes, ords, freqs))
            order = np.argsort(code, kind="stable")
            ord_, freq = ord_[order], freq[order]
            start = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(known)))]).astype("i8")
            pieces = pa.array(list(known), pa.string())
            for bucket, mine in enumerate(blocks.dealt(list(known), buckets)):
                if not len(mine):
                    continue
                held = start[mine + 1] - start[mine]
                rows = np.repeat(start[mine], held) + np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
                payload = blocks.pack(pieces=pa.ListArray.from_arrays(pa.array([0, len(mine)], pa.int32()), pieces.take(pa.array(mine))),
                                      held=[held.astype("u4")], ord=[ord_[rows]], freq=[freq[rows]])
                yield pa.RecordBatch.from_arrays([
                    pa.array([bucket], pa.int32()), pa.array([block], pa.int64()), pa.array([payload], pa.binary()),
                    *(pa.nulls(1, t) for t in schema.types[3:])], schema=schema)
    return run


def _count_pieces(path: str):
    """One bucket: tokens of each distinct pre-token, joined to the frequencies and summed per document."""
    schema = pa.schema([("block", pa.int64()), ("payload", pa.binary())])

    def run(group: pa.Table) -> pa.Table:
        tokenizer = pretokens.load(path)
        lists = [blocks.unpack(p) for p in group["payload"].to_pylist()]
        pieces = pa.chunked_array([x["pieces"].combine_chunks().flatten() for x in lists]).combine_chunks().dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        tokens = np.empty(len(distinct), "i8")
        for at in range(0, len(distinct), 10_000):
            part = tokenizer.encode_batch_fast(distinct[at:at + 10_000], add_special_tokens=False)
            tokens[at:at + len(part)] = [len(e.ids) for e in part]
        each, at, out = tokens[pieces.indices.to_numpy()], 0, []
        for x in lists:
            held, ord_, freq = (x[c].combine_chunks().flatten().to_numpy() for c in ("held", "ord", "freq"))
            n = np.repeat(each[at:at + len(held)], held) * freq
            at += len(held)
            sums = np.bincount(ord_, n.astype("f8")).astype("i8")  # exact below 2^53
            there = np.flatnonzero(sums)
            out.append(blocks.pack(ord=there.astype("u2"), n=sums[there].astype("u4" if sums.max(initial=0) < 2**32 else "u8")))
        return pa.table([group["block"].combine_chunks(), pa.array(out, pa.binary())], schema=schema)

    return run


def _sum_block(group: pa.Table) -> pa.Table:
    docs = group.filter(pc.is_valid(group["ord"]))
    total = np.zeros(docs.num_rows, "i8")
    for p in group["payload"].drop_null().to_pylist():
        part = blocks.unpack(p)
        total[part["ord"].to_numpy()] += part["n"].to_numpy().astype("i8")
    total = total[docs["ord"].to_numpy()] + docs["n_tokens"].to_numpy()
    return pa.table([docs["doc_id"], docs["n_bytes"], pa.array(total)], ["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every document.

    ``path`` is a byte-level BPE file of the ``tokenizers`` library; no tokens
    are added at the ends, and its special strings inside a text count one
    token each, as by default there. A null text is empty: no bytes, no tokens.
    Repeated rows give a row each, a null doc_id stays null, and other columns
    are not read.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    parts = materialize(docs.mapInArrow(_frequencies(path, blocks.bucket_count(docs)), PART))
    found = parts.where("payload is not null").select("bucket", "block", "payload").groupBy("bucket").applyInArrow(
        _count_pieces(path), "block bigint, payload binary")
    rows = parts.where("payload is null").select("block", "doc_id", "ord", "n_bytes", "n_tokens")
    both = rows.unionByName(found, allowMissingColumns=True)
    out = both.groupBy("block").applyInArrow(_sum_block, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
