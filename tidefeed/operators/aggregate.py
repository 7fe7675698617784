"""Totals per key, column totals, and flags against the mean.

Every grouping is a hash aggregate with a partial step before the shuffle, so a key that holds a large
share of all rows reaches the shuffle as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefeed.functions import as_number, col, island_key, norm_key, type_of
from tidefeed.operators.table import Split, require_columns, require_numeric, split

# The alert column and its two labels.
ALERT_COLUMN = "Alertas"
ABOVE_MEAN = "Vermelho"
NOT_ABOVE = "Verde"

_MEAN = "__mean"


def _has_key(df: DataFrame, key: str) -> Column:
    if isinstance(type_of(df, key), T.IntegralType):
        return col(key).isNotNull()
    return norm_key(df, key).isNotNull()


def split_keys(df: DataFrame, key: str) -> Split:
    """Set aside the rows whose key has no integer value; the totals leave them out."""
    require_columns(df, key)
    has_key = _has_key(df, key)
    return split(df, F.when(~has_key, F.lit(f"key:{key}")), has_key)


def _total(df: DataFrame, key: str, group: Column, measure: str) -> DataFrame:
    total = F.coalesce(F.sum(as_number(df, measure)), F.lit(0.0))
    return (
        df.where(_has_key(df, key))
        .groupBy(group.alias(key))
        .agg(total.alias(f"Total_{measure}"))
        .withColumn(key, col(key).cast("string"))
    )


def group_sum(df: DataFrame, key: str, measure: str) -> DataFrame:
    """``(key STRING, Total_<measure> DOUBLE)``: the sum per integer key. Missing values add nothing."""
    require_columns(df, key)
    require_numeric(df, measure)
    return _total(df, key, norm_key(df, key), measure)


def group_sum_island(df: DataFrame, key: str, measure: str) -> DataFrame:
    """As ``group_sum``, per island: the first two digits of the key as an integer (``05`` is ``5``)."""
    require_columns(df, key)
    require_numeric(df, measure)
    return _total(df, key, island_key(df, key), measure)


def group_sum_text(df: DataFrame, key: str, measure: str) -> DataFrame:
    """The sum per text key of a measure that may be text; what is no number adds nothing."""
    require_columns(df, key, measure)
    total = F.coalesce(F.sum(col(measure).try_cast("double")), F.lit(0.0))
    return df.groupBy(col(key).cast("string").alias(key)).agg(total.alias(f"Total_{measure}"))


def column_sum(df: DataFrame, name: str) -> DataFrame:
    """One row ``sum``: the total of the numbers in a column, 0 where there are none."""
    require_columns(df, name)
    return df.agg(F.coalesce(F.sum(col(name).try_cast("double")), F.lit(0.0)).alias("sum"))


def column_mean(df: DataFrame, name: str) -> DataFrame:
    """One row ``mean``: the total of the valid cells divided by the number of all rows."""
    require_numeric(df, name)
    total = F.coalesce(F.sum(as_number(df, name)), F.lit(0.0))
    return df.agg(F.try_divide(total, F.count(F.lit(1))).alias("mean"))


def mean_alert(df: DataFrame, name: str) -> DataFrame:
    """Add the alert column: ``Vermelho`` where a value is above the column's mean, else ``Verde``.

    The mean is one row by construction, so broadcasting it is safe at any size.
    """
    mean = column_mean(df, name).withColumnRenamed("mean", _MEAN)
    above = as_number(df, name) > F.col(_MEAN)
    return (
        df.crossJoin(F.broadcast(mean))
        .withColumn(ALERT_COLUMN, F.when(above, F.lit(ABOVE_MEAN)).otherwise(F.lit(NOT_ABOVE)))
        .drop(_MEAN)
    )
