"""Totals and statistics that build up over micro-batches or runs.

Each batch is reduced to partial results per key and stored under its own number. Reading combines the
partial results, so what is kept grows with the keys and not with the rows, and a replayed batch
replaces its own part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidefeed.functions import as_number, col, norm_key
from tidefeed.operators.aggregate import group_sum
from tidefeed.operators.table import require_columns

_PARTIALS = T.StructType(
    [
        T.StructField("key", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("m2", T.DoubleType()),
    ]
)


def group_totals(stream: DataFrame, key: str, measure: str, base: str) -> StreamingQuery:
    """Work off a stream, storing the total per key of each micro-batch; see ``totals_so_far``."""

    def take(batch: DataFrame, number: int) -> None:
        totals = group_sum(batch, key, measure)
        totals.write.mode("overwrite").parquet(f"{base}/totals/batch_id={number}")

    return (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def totals_so_far(spark: SparkSession, key: str, measure: str, base: str) -> DataFrame:
    """The total per key over all micro-batches that ``group_totals`` has stored."""
    total = f"Total_{measure}"
    layout = T.StructType(
        [T.StructField(key, T.StringType()), T.StructField(total, T.DoubleType())]
    )
    stored = spark.read.schema(layout).parquet(f"{base}/totals")
    return stored.groupBy(col(key)).agg(F.sum(col(total)).alias(total))


def accumulated(df: DataFrame, key: str, value: str, number: int, base: str) -> None:
    """Store the count, mean and squared deviation per key of one run's values."""
    require_columns(df, key, value)
    v = as_number(df, value)
    n = F.count(v)
    partials = (
        df.where(norm_key(df, key).isNotNull() & v.isNotNull())
        .groupBy(norm_key(df, key).alias("key"))
        .agg(n.alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * n).alias("m2"))
    )
    partials.write.mode("overwrite").parquet(f"{base}/partials/batch_id={number}")


def pooled_stats(spark: SparkSession, base: str, by_key: bool = False) -> DataFrame:
    """Count, mean and population standard deviation over the values of all stored runs.

    ``(registros, media, desvio)``, per ``key`` on request. Each partial result is compared with the
    overall mean of its key, which keeps the precision that differences of large sums would lose.
    """
    parts = spark.read.schema(_PARTIALS).parquet(f"{base}/partials")
    keys = ["key"] if by_key else []
    weighted = F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n"))
    means = parts.groupBy(*keys).agg(weighted.alias("pooled"))
    joined = parts.join(means, keys) if by_key else parts.crossJoin(F.broadcast(means))
    shifted = F.col("mean") - F.col("pooled")
    return joined.groupBy(*keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("registros"),
        F.first("pooled").alias("media"),
        _root_mean(F.sum(F.col("m2") + F.col("n") * shifted * shifted)).alias("desvio"),
    )


def _root_mean(squares: Column) -> Column:
    return F.sqrt(F.try_divide(squares, F.sum("n")))
