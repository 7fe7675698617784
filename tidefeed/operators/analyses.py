"""The five reports: alert summary, statistics, statistics per key, correlation, regression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.functions import as_number, as_text, col, island_code, join_or, norm_key
from tidefeed.operators.aggregate import ABOVE_MEAN, ALERT_COLUMN, NOT_ABOVE
from tidefeed.operators.table import require_columns

def alert_rows(df: DataFrame, code: str, alert: str = ALERT_COLUMN) -> DataFrame:
    """The distinct ``(alert, code)`` pairs, one per row, of the two known labels."""
    require_columns(df, code, alert)
    known = df.where(col(alert).isin(ABOVE_MEAN, NOT_ABOVE))
    return known.select(col(alert), as_text(df, code).alias(code)).distinct()


def alert_summary(df: DataFrame, code: str, alert: str = ALERT_COLUMN) -> DataFrame:
    """One row ``(vermelho, verde)``: the island codes under each label in text order, joined by commas.

    A code counts under its island, the first two digits, so a list has a hundred entries at most.
    ``alert_rows`` gives the full codes as rows.
    """
    require_columns(df, code, alert)
    pairs = df.select(island_code(df, code).alias("island"), col(alert).alias("alert"))

    def listed(label: str):
        return join_or(F.collect_set(F.when(F.col("alert") == label, F.col("island"))))

    return pairs.agg(listed(ABOVE_MEAN).alias("vermelho"), listed(NOT_ABOVE).alias("verde"))


def stats(df: DataFrame, value: str) -> DataFrame:
    """One row ``(registros, media, desvio)``: count, mean and population standard deviation."""
    require_columns(df, value)
    v = as_number(df, value)
    return df.agg(
        F.count(v).alias("registros"), F.avg(v).alias("media"), F.stddev_pop(v).alias("desvio")
    )


def stats_by(df: DataFrame, key: str, value: str, ordered: bool = True) -> DataFrame:
    """Mean and population standard deviation per integer key, in ascending order of the key."""
    require_columns(df, key, value)
    v = as_number(df, value)
    grouped = (
        df.where(norm_key(df, key).isNotNull() & v.isNotNull())
        .groupBy(norm_key(df, key).alias(key))
        .agg(F.avg(v).alias("media"), F.stddev_pop(v).alias("desvio"))
    )
    return grouped.orderBy(col(key)) if ordered else grouped


def _pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    require_columns(df, x, y)
    pairs = df.select(as_number(df, x).alias("x"), as_number(df, y).alias("y"))
    return pairs.where(F.col("x").isNotNull() & F.col("y").isNotNull())


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row ``correlacao``: Pearson's coefficient over the pairs in which both values are valid.

    NULL where a column is constant or there is no pair.
    """
    spread = F.stddev_pop("x") * F.stddev_pop("y")
    return _pairs(df, x, y).agg(F.try_divide(F.covar_pop("x", "y"), spread).alias("correlacao"))


def linreg(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row ``(intercepto, coeficiente)`` of the least-squares line of y on x."""
    return _pairs(df, x, y).agg(
        F.regr_intercept("y", "x").alias("intercepto"), F.regr_slope("y", "x").alias("coeficiente")
    )
