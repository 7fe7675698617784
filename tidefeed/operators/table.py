"""Plain table operators: column checks, row masks, adding and removing rows and columns."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefeed.functions import as_number, col, type_of
from tidefeed.storage import materialize, new_folder

#: Up to this size a list of distinct keys is broadcast, else it is joined by shuffle.
BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Split:
    """Rows of which each passed a check or carries, in ``motivo``, the reason why it did not.

    ``good`` may state the check once more as a plain condition, which unlike the reason can be pushed
    into a scan. Reading both sides scans the source twice; ``stored`` writes them side by side in one
    pass.
    """

    marked: DataFrame
    accepted_columns: tuple[str, ...]
    rejected_columns: tuple[str, ...]
    good: Column | None = None

    @property
    def accepted(self) -> DataFrame:
        passed = F.col("motivo").isNull() if self.good is None else self.good
        return self.marked.where(passed).select(*map(col, self.accepted_columns))

    @property
    def rejected(self) -> DataFrame:
        return self.marked.where(F.col("motivo").isNotNull()).select(
            *map(col, self.rejected_columns)
        )

    def stored(self, label: str = "split") -> Split:
        """The same parts, read from two partitions of a table in the shared folder."""
        spark = self.marked.sparkSession
        path = new_folder(spark, label)
        sided = self.marked.withColumn("aceito", F.col("motivo").isNull())
        sided.write.partitionBy("aceito").parquet(path)
        kept = spark.read.schema(sided.schema).parquet(path)
        return StoredSplit(kept, self.accepted_columns, self.rejected_columns)


class StoredSplit(Split):
    """Parts that lie in partitions of their own, so that each side reads only its files."""

    @property
    def accepted(self) -> DataFrame:
        return self.marked.where(F.col("aceito")).select(*map(col, self.accepted_columns))

    @property
    def rejected(self) -> DataFrame:
        return self.marked.where(~F.col("aceito")).select(*map(col, self.rejected_columns))


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")


def require_numeric(df: DataFrame, name: str) -> None:
    require_columns(df, name)
    if not isinstance(type_of(df, name), T.NumericType):
        raise ValueError(f"column {name} is not numeric")


def split(df: DataFrame, reason: Column, good: Column | None = None) -> Split:
    """Part ``df`` by an expression that is NULL for good rows and names the fault of bad ones."""
    columns = tuple(df.columns)
    return Split(df.withColumn("motivo", reason), columns, (*columns, "motivo"), good)


def is_number(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if is_number(f)]


def missing_number(df: DataFrame) -> Column:
    """NULL, or the first numeric column that a row misses the value of."""
    faults = [F.when(col(name).isNull(), F.lit(f"missing:{name}")) for name in _numeric(df)]
    return F.coalesce(*faults, F.lit(None).cast("string"))


def typed_rows(df: DataFrame) -> Split:
    """Set aside rows that miss the value of a numeric column; text columns may be empty."""
    return split(df, missing_number(df), all_of(col(name).isNotNull() for name in _numeric(df)))


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(Column.__and__, conditions, F.lit(True))


def keep_rows(df: DataFrame, mask: Column) -> DataFrame:
    """Rows for which ``mask`` holds."""
    return df.where(mask)


def age_filter(df: DataFrame, name: str, max_age: int = 120) -> DataFrame:
    """Rows whose ``name`` lies in 0..``max_age``; an absent column leaves the table as it is."""
    if name not in df.columns:
        return df
    return df.where(as_number(df, name).between(0, max_age))


def threshold_flag(df: DataFrame, name: str, mean: float | Column, flag: str) -> DataFrame:
    """Add the text ``True`` where a value is above ``mean``, else (and for bad values) ``False``."""
    require_columns(df, name)
    above = as_number(df, name) > mean
    return df.withColumn(flag, F.when(above, F.lit("True")).otherwise(F.lit("False")))


def fitting_rows(df: DataFrame, batch: DataFrame) -> Split:
    """The rows of a batch that fit the columns of a table, in its types, and those that do not."""
    if set(batch.columns) != set(df.columns):
        raise ValueError("the batch must have the columns of the table")
    faults, typed = [], []
    for field in df.schema:
        value = col(field.name).try_cast(field.dataType)
        faults.append(F.when(col(field.name).isNotNull() & value.isNull(), F.lit(f"type:{field.name}")))
        if is_number(field):
            faults.append(F.when(value.isNull(), F.lit(f"missing:{field.name}")))
        typed.append(value.alias(field.name))
    record = F.to_json(F.struct(*map(col, df.columns))).alias("registro")
    marked = batch.select(*typed, F.coalesce(*faults, F.lit(None)).alias("motivo"), record)
    return Split(marked, tuple(df.columns), ("motivo", "registro"))


def append_rows(df: DataFrame, batch: DataFrame) -> DataFrame:
    """Add the rows of a batch that fit; ``fitting_rows`` gives the others too."""
    return df.unionByName(fitting_rows(df, batch).accepted)


def drop_keys(df: DataFrame, keys: DataFrame, *on: str) -> DataFrame:
    """Remove the rows whose key occurs in ``keys``.

    Repeated keys collapse before they are shuffled. The distinct list is stored, and its size is taken
    on the way. A short list is broadcast and ``df`` is not shuffled at all. A long one is joined by shuffle
    straight from its table, a shape in which adaptive execution can split a hot key of ``df``.
    """
    require_columns(df, *on)
    require_columns(keys, *on)
    distinct = keys.select(*map(col, on)).distinct()
    size = reduce(Column.__add__, [_stored_bytes(distinct, name) for name in on])
    listed, seen = materialize(distinct, "keys", F.sum(size).alias("bytes"))
    if (seen["bytes"] or 0) <= BROADCAST_BYTES:
        listed = F.broadcast(listed)
    return df.join(listed, list(on), "left_anti")


def _stored_bytes(df: DataFrame, name: str) -> Column:
    """What a value takes up, with room for the overhead of a hash table."""
    overhead, dtype = F.lit(32), type_of(df, name)
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return overhead + F.coalesce(F.octet_length(col(name)), F.lit(0))
    if isinstance(dtype, (T.ArrayType, T.StructType)):
        text = F.to_json(F.struct(col(name)))  # never shorter than half of what the value takes
        return overhead + 2 * F.octet_length(text)
    return overhead


def add_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.withColumn(name, value)


def align_column(df: DataFrame, values: DataFrame, name: str, *on: str) -> Split:
    """Add the column ``name`` of another table, whose rows belong one to one to those of ``df`` by the key ``on``.

    Rows that have no partner are set aside with all columns and the reason: ``unmatched`` where no value has
    the key or the key is NULL, ``repeated`` where several rows or values have it, ``unused`` for a value without a
    row, whose other columns are NULL. An existing column ``name`` is replaced. Repeated values collapse
    to one row per key before they move, so a hot key costs one row; that of a hot key of ``df`` is told by a
    count of its rows, which collapses likewise, and the rows themselves are joined in a shape that adaptive
    execution can split.
    """
    require_columns(df, *on)
    require_columns(values, name, *on)
    keys = [f"__on{i}" for i in range(len(on))]

    def keyed(rows: DataFrame, *more: Column) -> DataFrame:
        return rows.select(*(col(c).alias(k) for c, k in zip(on, keys)), *more)

    known = all_of(col(k).isNotNull() for k in keys)
    given = keyed(values, col(name).alias("__value")).groupBy(*keys).agg(F.count("*").alias("__values"), F.first("__value").alias("__value"))
    asked = keyed(df).where(known).groupBy(*keys).agg(F.count("*").alias("__rows"))
    pairs = materialize(given.join(asked, keys, "full"), "aligned")[0]
    reason = (
        F.when(~known & F.col("__values").isNotNull(), "unused").when(F.col("__values").isNull(), "unmatched")
        .when(F.col("__rows").isNull(), "unused").when((F.col("__values") > 1) | (F.col("__rows") > 1), "repeated")
    )
    pairs = pairs.withColumn("motivo", reason)
    kept = [c for c in df.columns if c != name]
    same = all_of(col(c) == F.col(k) for c, k in zip(on, keys))
    met = df.join(pairs.where("__rows is not null"), same, "left")
    one = F.col("motivo").isNull()
    found = met.select(
        *map(col, kept), F.when(one, F.col("__value")).alias(name),
        F.when(F.col("__rows").isNull(), "unmatched").otherwise(F.col("motivo")).alias("motivo"),
    )
    held = dict(zip(on, keys))
    blank = [(F.col(held[c]) if c in held else F.lit(None)).cast(type_of(df, c)).alias(c) for c in kept]
    left = pairs.where("motivo = 'unused'").select(*blank, F.col("__value").alias(name), "motivo")
    return Split(found.unionAll(left), (*kept, name), (*kept, name, "motivo"))


def aligned(df: DataFrame, values: DataFrame, name: str, *on: str) -> DataFrame:
    """``df`` with the column of ``align_column``; refused if any row or value has no partner.

    The rows are counted while they are stored.
    """
    parts = align_column(df, values, name, *on)
    stored, seen = materialize(parts.marked, "aligned", F.count("motivo").alias("refused"), F.first("motivo", ignorenulls=True).alias("why"))
    if seen["refused"]:
        raise ValueError(f"column {name} does not fit: {seen['refused']} of {seen['rows']} rows, the first {seen['why']}")
    return stored.select(*map(col, parts.accepted_columns))


def remove_column(df: DataFrame, name: str) -> DataFrame:
    """Drop a column; an absent one is no fault."""
    return df.drop(name)
