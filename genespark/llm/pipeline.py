"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``. ``run`` writes each stage's result as Parquet and
reads it again for the next one. A stage deletes what earlier stages wrote for
themselves, unless ``docs`` still reads it: so write a stage's result before you
call a stage on other documents.
"""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genespark.llm import packing, pii, quality, similar, substrings
from genespark.llm.common import drop_written, parted
from genespark.session import materialize, recorded

TOKENIZER = "word_bpe_49k.json"
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# By stages that have run in this thread, and not deleted yet.
_written: ContextVar[tuple[DataFrame, ...]] = ContextVar("written_by_stages", default=())


def _delete_unread(spark: SparkSession, docs: DataFrame) -> None:
    """Delete the tables of earlier stages that ``docs`` doesn't read; those of other sessions are forgotten."""
    read, left = set(docs.inputFiles()), []
    for table in _written.get():
        if table.sparkSession is not spark:
            continue
        if read.isdisjoint(table.inputFiles()):
            drop_written(table)
        else:
            left.append(table)
    _written.set(tuple(left))


def _tidy(stage: Stage) -> Stage:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _delete_unread(spark, docs)
        with recorded() as tables:
            out = stage(spark, docs, sf_dir)
        _written.set((*_written.get(), *tables))
        return out

    return run_stage


def _nested(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text): the caller's other columns in a struct, so that their names meet none of an operator's."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select(F.struct(*rest or [F.lit(0).alias("none")]).alias("row"), "doc_id", "text")


def _plain(out: DataFrame, docs: DataFrame, new: dict | None = None) -> DataFrame:
    """The columns of ``docs`` again; ``new`` has those that change."""
    kept = {"doc_id": F.col("doc_id"), "text": F.col("text")} | (new or {})
    return out.select(*[(kept[c] if c in kept else F.col("row").getField(c)).alias(c) for c in docs.columns])


def _with_text(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The caller's columns with the changed text; ``n_chars``, where there is such a column, follows it."""
    return _plain(out, docs, {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else None)


@_tidy
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules keep, unchanged."""
    signals = materialize(quality.quality_signals(docs.select(F.struct("*").alias("row"), "text")).drop("text"))
    return quality.judge(signals).where("kept").select("row.*")


@_tidy
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 5-word shingle similarity 0.8 or more join: a row with the group's smallest doc_id."""
    rows = materialize(similar.with_keys(_nested(docs)).withColumn("_n", F.monotonically_increasing_id()))
    groups = similar.groups(rows)
    # A null doc_id stays only where the group has no other.
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_n"))
    members = materialize(rows.select("_set", "doc_id", "_n").join(groups, "_set").select("component", "doc_id", "_n"))
    first = members.groupBy("component").agg(F.min_by("_n", order).alias("_n"))
    gone = materialize(members.join(first.select("_n"), "_n", "left_anti").select("_n"))
    near, rest = parted(rows, "_n", gone)
    return rest.unionByName(near.join(gone, "_n", "left_anti")).transform(_plain, docs)


@_tidy
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that an earlier document has."""
    return _with_text(substrings.without_repeats(_nested(docs)), docs)


@_tidy
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data generalised and disclosing terms removed."""
    return _with_text(pii.sanitised(_nested(docs)), docs)


@_tidy
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("best_fit_packing", pack),
]
ORACLE_SQL = None  # expectation-maximisation, components and tokenizers are not SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    last = None
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
        if last is not None:
            drop_written(last)
        last = docs
    _delete_unread(spark, docs)
    return docs
