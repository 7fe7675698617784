"""Column expressions shared by the operators. All are built-in functions, so they stay in codegen.

Functions whose meaning depends on the type of a column take the DataFrame and the column's name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for a missing value.
NULL_TOKENS = ("", "null", "NULL", "NaN")

# Fixed value: what an empty list is shown as.
EMPTY_LIST_TEXT = "(nenhum)"


def col(name: str) -> Column:
    """The column of exactly this name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def null_like(df: DataFrame, name: str) -> Column:
    """True where a cell counts as missing: NULL, the empty text, and also zero."""
    dtype = type_of(df, name)
    if isinstance(dtype, T.StringType):
        return col(name).isNull() | (col(name) == "")
    if isinstance(dtype, T.NumericType):
        return col(name).isNull() | (col(name) == 0)
    return col(name).isNull()


def null_tokens(c: Column) -> Column:
    """Turn the texts that stand for a missing value into NULL."""
    return F.when(~c.isin(*NULL_TOKENS), c)


def as_number(df: DataFrame, name: str) -> Column:
    """A numeric column as DOUBLE. Text is not parsed: it has no numeric value."""
    if isinstance(type_of(df, name), T.NumericType):
        return col(name).cast("double")
    return F.lit(None).cast("double")


def fmt6(c: Column) -> Column:
    """A floating number as text with six decimals."""
    return F.when(c.isNotNull(), F.format_string("%.6f", c))


def as_text(df: DataFrame, name: str) -> Column:
    """The text form of a cell: floating numbers have six decimals, everything else is plain."""
    if isinstance(type_of(df, name), T.FractionalType):
        return fmt6(col(name).cast("double"))
    return col(name).cast("string")


def norm_key(df: DataFrame, name: str) -> Column:
    """A grouping key as BIGINT: fractions are cut off, text is read up to its first non-digit.

    NULL where the cell has no integer value.
    """
    dtype = type_of(df, name)
    if isinstance(dtype, T.IntegralType):
        return col(name).cast("bigint")
    if isinstance(dtype, T.NumericType):
        return col(name).try_cast("bigint")
    return F.regexp_extract(col(name).cast("string"), r"^\s*([+-]?[0-9]+)", 1).try_cast("bigint")


def _leading_digits(df: DataFrame, name: str) -> Column:
    """The first two digits of a code, or as many as there are."""
    if isinstance(type_of(df, name), T.NumericType):
        digits = F.ltrim(norm_key(df, name).cast("string"), F.lit("-"))
    else:
        digits = F.regexp_replace(col(name).cast("string"), "[^0-9]", "")
    return F.substring(digits, 1, 2)


def island_code(df: DataFrame, name: str) -> Column:
    """The first two digits of a code, padded with a zero; ``00`` where there is no digit."""
    return F.lpad(F.coalesce(_leading_digits(df, name), F.lit("")), 2, "0")


def island_key(df: DataFrame, name: str) -> Column:
    """The island code as an integer (``05`` is 5); zero where a text has no digit."""
    return F.coalesce(_leading_digits(df, name).try_cast("int"), F.lit(0))


def only_digits(c: Column, length: int) -> Column:
    """True for text of exactly ``length`` characters, all of them digits."""
    return (F.length(c) == length) & ~c.rlike("[^0-9]")


def fold_case(c: Column) -> Column:
    return F.lower(c)


def join_or(values: Column, separator: str = ", ", empty: str = EMPTY_LIST_TEXT) -> Column:
    """An array of texts in ascending order as one text, or ``empty`` for an empty array."""
    return F.coalesce(
        F.nullif(F.array_join(F.sort_array(values), separator), F.lit("")), F.lit(empty)
    )
