"""Look up one feed's totals in another's by island code, and the merge of all three feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.functions import col, island_code, norm_key, type_of
from tidefeed.operators.table import require_columns

_CODE, _LAST = "__island", "__last"


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    code: str,
    value: str,
    suffix: str,
    *,
    order_by: str | None = None,
    fill: float | None = 0.0,
) -> DataFrame:
    """Add ``<value><suffix>`` of the right row with the same island code to every left row.

    Of several right rows with one code the last by ``order_by`` (by default the key itself) counts. A
    left row without a match gets ``fill``. The right side is first brought down to one row per
    two-digit code, a hundred at most, so broadcasting it is safe and the left side is not shuffled.
    """
    require_columns(left, code)
    require_columns(right, code, value)
    added = value + suffix
    order = col(order_by) if order_by else norm_key(right, code)
    lookup = (
        right.select(
            island_code(right, code).alias(_CODE),
            F.struct(order.alias("at"), col(value).alias("value")).alias(_LAST),
        )
        .groupBy(_CODE)
        .agg(F.max(_LAST).alias(_LAST))
        .select(_CODE, F.col(f"{_LAST}.value").alias(added))
    )
    joined = (
        left.withColumn(_CODE, island_code(left, code))
        .join(F.broadcast(lookup), _CODE, "left")
        .drop(_CODE)
    )
    if fill is None:
        return joined
    filled = F.coalesce(col(added), F.lit(fill).cast(type_of(right, value)))
    return joined.withColumn(added, filled)


def merge_three(
    a: DataFrame, b: DataFrame, c: DataFrame, code: str, value_b: str, value_c: str
) -> dict[str, DataFrame]:
    """The pairwise merges AB, AC and BC and the full merge ABC of three tables of totals."""
    for table in (a, b, c):
        require_columns(table, code)
    ab = lookup_join(a, b, code, value_b, "_B")
    return {
        "AB": ab,
        "ABC": lookup_join(ab, c, code, value_c, "_C"),
        "AC": lookup_join(a, c, code, value_c, "_C"),
        "BC": lookup_join(b, c, code, value_c, "_C"),
    }
