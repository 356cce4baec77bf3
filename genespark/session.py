"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_record: ContextVar[list[DataFrame] | None] = ContextVar("written_tables", default=None)


@contextmanager
def recorded() -> Iterator[list[DataFrame]]:
    """The tables that ``materialize`` writes inside the block, for a caller that deletes them after use."""
    tables: list[DataFrame] = []
    token = _record.set(tables)
    try:
        yield tables
    finally:
        _record.reset(token)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (tests, a laptop) a temporary folder is chosen for the session.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="genespark-")
        spark.conf.set(CHECKPOINT_KEY, root)
    return root


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Used where a value depends on how rows were partitioned (a chunk number) or
    where a loop would otherwise grow its plan. The files survive the loss of
    any executor, and the re-read table carries real size statistics, so the
    optimizer can decide by itself whether a side is small enough to broadcast.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/genespark/{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    if (tables := _record.get()) is not None:
        tables.append(table)
    return table
