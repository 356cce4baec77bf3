"""P20: checks that stop a run instead of returning a quiet, empty answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class InputError(ValueError):
    """An input that cannot give a meaningful result."""


def require_rows(df: DataFrame, what: str, allow_empty: bool = False) -> DataFrame:
    """Zero parsed rows from existing input is an error, unless the caller expects it."""
    if not allow_empty and df.limit(1).count() == 0:
        raise InputError(f"no rows parsed from {what}")
    return df


def require_some_known(df: DataFrame, known: DataFrame, key: str, what: str) -> DataFrame:
    """Every id unknown means a wrong naming, not an absent result."""
    if df.limit(1).count() and df.join(known.select(key), key, "left_semi").limit(1).count() == 0:
        raise InputError(f"none of the {what} is known: check the id format")
    return df


def require_measured(df: DataFrame, column: str, judged: Column, what: str) -> DataFrame:
    """A filter on a measured column needs the measurement in every judged row."""
    bad = df.where(judged & F.col(column).isNull()).limit(1).count()
    if bad:
        raise InputError(f"{what} was requested but {column} is missing in some rows")
    return df
