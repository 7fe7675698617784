"""Cleaning: duplicate rows, sparse columns, sparse rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefeed.functions import col, null_like
from tidefeed.storage import materialize

# Fixed value: the share of missing cells from which a column is dropped.
SPARSE_THRESHOLD = 0.9


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One copy of each row. Copies collapse within each task before the shuffle."""
    return df.dropDuplicates()


def _missing_counts(df: DataFrame) -> list[Column]:
    return [F.count_if(null_like(df, name)).alias(f"m{i}") for i, name in enumerate(df.columns)]


def _kept_columns(df: DataFrame, counts: dict, threshold: float, keep: Sequence[str]) -> list[str]:
    rows = counts["rows"]
    if rows < 2:
        return df.columns
    limit = int(rows * threshold)
    return [
        name for i, name in enumerate(df.columns) if name in keep or counts[f"m{i}"] < limit
    ]


def drop_sparse_columns(
    df: DataFrame, threshold: float = SPARSE_THRESHOLD, keep: Sequence[str] = ()
) -> DataFrame:
    """Drop the columns in which at least ``int(rows * threshold)`` cells are missing (or zero).

    Which columns stay depends on the data, so this runs one aggregate over all columns; a single row
    of counts comes back. Columns in ``keep`` always stay. Tables of fewer than two rows are unchanged,
    as the formula would leave them no column.
    """
    return _without_sparse(df, threshold, keep)[0]


def _without_sparse(
    df: DataFrame, threshold: float, keep: Sequence[str], *metrics: Column
) -> tuple[DataFrame, dict]:
    count = F.count(F.lit(1)).alias("rows")
    counts = df.agg(count, *_missing_counts(df), *metrics).first().asDict()
    return df.select(*map(col, _kept_columns(df, counts, threshold, keep))), counts


def drop_sparse_rows(df: DataFrame, threshold: float = SPARSE_THRESHOLD) -> DataFrame:
    """Drop the rows in which at least ``int(columns * threshold)`` cells are missing (or zero).

    The limit is never below one cell, so a row without missing cells always stays.
    """
    limit = max(1, int(len(df.columns) * threshold))
    missing = F.lit(0)
    for name in df.columns:
        missing = missing + null_like(df, name).cast("int")
    return df.where(missing < limit)


def clean(
    df: DataFrame,
    threshold: float = SPARSE_THRESHOLD,
    *,
    dedupe: bool = True,
    sparse_rows: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Drop duplicate rows, then (on request) sparse rows, then sparse columns.

    With ``dedupe`` the distinct rows are stored once and the missing cells are counted while they are
    written: one scan and one shuffle, and the readers of the result prune the dropped columns. Without
    it the rows stay where they are and only the count reads them twice.
    """
    return clean_observed(
        df, threshold, dedupe=dedupe, sparse_rows=sparse_rows, keep=keep
    )[0]


def clean_observed(
    df: DataFrame,
    threshold: float = SPARSE_THRESHOLD,
    metrics: Sequence[Column] = (),
    *,
    dedupe: bool = True,
    sparse_rows: bool = False,
    keep: Sequence[str] = (),
    copies: str | None = None,
) -> tuple[DataFrame, dict]:
    """As ``clean``, with the values of ``metrics`` over the rows kept, taken in the same pass.

    With ``copies`` a column of this name says how often each distinct row was there, so that sums over
    the table as received need no other scan of it.
    """
    if copies and dedupe:
        rows = df.groupBy(*map(col, df.columns)).agg(F.count(F.lit(1)).alias(copies))
        keep = [*keep, copies]
    else:
        rows = drop_duplicate_rows(df) if dedupe else df
    if sparse_rows:
        rows = drop_sparse_rows(rows, threshold)
    if not dedupe:
        return _without_sparse(rows, threshold, keep, *metrics)
    stored, counts = materialize(rows, "clean", *_missing_counts(rows), *metrics)
    return stored.select(*map(col, _kept_columns(stored, counts, threshold, keep))), counts
