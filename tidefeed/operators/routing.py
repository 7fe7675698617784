"""Route rows to their feed: by file name, by the variant that is set, by an allow-list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefeed.functions import col, fold_case
from tidefeed.operators.table import Split, require_columns, split
from tidefeed.schemas import FEEDS

# The origins, in the order in which a file name is matched against them.
ORIGINS = ("hospital", "oms", "secretaria")

# The two columns per feed that a listing shows.
LISTED_FIELDS = {
    "oms": ("cep", "data"),
    "hospital": ("id_hospital", "data"),
    "secretaria": ("cep", "diagnostico"),
}


def origin_of(name: Column, origins: tuple[str, ...] = ORIGINS) -> Column:
    """The first origin whose name occurs in a file name; NULL where none does."""
    return F.coalesce(*[F.when(name.contains(word), F.lit(word)) for word in origins])


def by_origin(
    df: DataFrame, name: Column | None = None, origins: tuple[str, ...] = ORIGINS
) -> Split:
    """Label each row with the origin of its file in ``origem``; rows of unknown files are set aside."""
    source = F.col("_metadata.file_name") if name is None else name
    marked = df.withColumn("origem", origin_of(source, origins))
    return split(marked, F.when(F.col("origem").isNull(), F.lit("origem:unknown")))


def _refused(name: str, origins: tuple[str, ...]) -> Column:
    listed = F.coalesce(fold_case(col(name)).isin(*origins), F.lit(False))
    return F.when(~listed, F.lit(f"{name}:refused"))


def allow_list(df: DataFrame, name: str = "origem", origins: tuple[str, ...] = ORIGINS) -> Split:
    """Fold the case of the origin and set aside rows whose origin is not listed."""
    require_columns(df, name)
    return split(df.withColumn(name, fold_case(col(name))), _refused(name, origins))


def split_union(df: DataFrame, variants: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """The records of a tagged union as one table per variant column, in the variant's own layout."""
    names = variants or tuple(f"linha_{feed}" for feed in FEEDS)
    require_columns(df, *names)
    # A variant counts only where no earlier one is set, so a record goes to one table.
    tables, earlier = {}, F.lit(True)
    for name in names:
        tables[name] = df.where(earlier & col(name).isNotNull()).select(f"`{name}`.*")
        earlier = earlier & col(name).isNull()
    return tables


def union_fault() -> Column:
    """NULL for a tagged record whose origin is listed and whose variant is that of its origin."""
    origin = fold_case(F.col("origem"))
    fits = F.coalesce(*[F.when(origin == f, F.col(f"linha_{f}").isNotNull()) for f in FEEDS])
    return F.coalesce(
        _refused("origem", tuple(FEEDS)), F.when(~fits, F.lit("linha:mismatch"))
    )


def filled_numbers(df: DataFrame) -> DataFrame:
    """Numbers that a set variant leaves out are 0: the sender's format does not put zeros on the wire."""
    filled = {}
    for feed, layout in FEEDS.items():
        variant = col(f"linha_{feed}")
        fields = [
            (F.coalesce(value, F.lit(0).cast(f.dataType)) if isinstance(f.dataType, T.NumericType) else value).alias(f.name)
            for f in layout
            for value in [variant[f.name]]
        ]
        filled[f"linha_{feed}"] = F.when(variant.isNotNull(), F.struct(*fields))
    return df.withColumns(filled)


def check_union(df: DataFrame) -> Split:
    """Set aside records of a refused origin, and those whose variant is not that of their origin."""
    return split(df.withColumn("origem", fold_case(F.col("origem"))), union_fault())


def listed_fields(df: DataFrame, feed: str) -> DataFrame:
    """The two columns of a feed that its listing shows."""
    return df.select(*LISTED_FIELDS[feed])


def write_by_origin(df: DataFrame, path: str) -> None:
    """Write routed rows to one folder per origin, in one pass and without a shuffle."""
    df.write.mode("overwrite").partitionBy("origem").parquet(path)
