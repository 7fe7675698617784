"""CSV and JSON outputs."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefeed.functions import as_text, col
from tidefeed.storage import run_together

#: The number of objects in one array file.
ROWS_PER_ARRAY = 50_000


def text_form(df: DataFrame) -> DataFrame:
    """Every column as text; floating numbers have six decimals."""
    return df.select(*[as_text(df, name).alias(name) for name in df.columns])


def _one_line(value: Column) -> Column:
    for plain, written in (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r")):
        value = F.replace(value, F.lit(plain), F.lit(written))
    return F.when(value == "", F.lit("\\e")).otherwise(value)


def write_csv(
    df: DataFrame, path: str, *, separator: str = ",", line_safe: bool = False
) -> int:
    """Write a folder of CSV files with headers, replacing what is there; gives the number of rows.

    An empty table is written too, with a warning. Blanks are kept. With ``line_safe`` line breaks and
    backslashes are written as ``\\n``, ``\\r`` and ``\\s`` and the empty text as ``\\e``, so that each row is
    one line and NULL is told from the empty text; ``read_delimited(line_safe=True)`` undoes this.
    """
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    text = text_form(df)
    if line_safe:
        text = text.select(*[_one_line(col(name)).alias(name) for name in text.columns])
    text = text.observe(seen, F.count(F.lit(1)).alias("rows"))
    options = {"header": True, "sep": separator, "quote": '"', "escape": '"', "emptyValue": '""'}
    options |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    text.write.mode("overwrite").options(**options).csv(path)
    rows = seen.get["rows"]
    if rows == 0:
        warnings.warn(f"the table saved in {path} is empty", stacklevel=2)
    return rows


def write_json(df: DataFrame, path: str) -> None:
    """Write a folder of files with one JSON object per line, replacing what is there."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def as_json(df: DataFrame) -> Column:
    """The row as a JSON object, with quotes and backslashes escaped."""
    return F.to_json(F.struct(*map(col, df.columns)), {"ignoreNullFields": "false"})


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_ARRAY) -> None:
    """Write a folder of files that each hold one JSON array of objects, replacing what is there.

    A task starts a new array, and with it a new file, every ``rows_per_file`` objects: whoever reads an
    array file has to take it in one piece.
    """

    def framed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, place = "", 0
        for batch in batches:
            lines = []
            for line in batch["value"]:
                opens = place % rows_per_file == 0
                if place:
                    lines.append(held + "]" if opens else held)
                held = ("[" if opens else ",") + line
                place += 1
            yield pd.DataFrame({"value": lines}, dtype=object)
        if place:
            yield pd.DataFrame({"value": [held + "]"]})

    lines = df.select(as_json(df).alias("value")).mapInPandas(framed, "value string")
    lines.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).text(path)


def audit_outputs(
    outputs: Mapping[str, DataFrame], base: str, required: Sequence[str] = (), numeric: Sequence[str] = ()
) -> DataFrame:
    """Write each named table that has what is asked of it, and say what became of each.

    One row per table: ``saida``, ``linhas`` as counted while they were written, ``vazia``, and the columns for which it was
    refused, comma-joined: ``ausentes`` of those that are ``required`` or ``numeric``, ``nao_numericas`` of the latter. A refused
    table is not written and has NULL for ``linhas`` and ``vazia``.
    """
    faults = {}
    for name, df in outputs.items():
        missing = [c for c in dict.fromkeys([*required, *numeric]) if c not in df.columns]
        words = [c for c in numeric if c in df.columns and not isinstance(df.schema[c].dataType, T.NumericType)]
        faults[name] = ",".join(missing), ",".join(words)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")  # the row says that a table is empty
        rows = write_outputs({n: df for n, df in outputs.items() if not any(faults[n])}, base)
    found = [(n, rows.get(n), None if n not in rows else rows[n] == 0, *faults[n]) for n in outputs]
    spark = next(iter(outputs.values())).sparkSession
    return spark.createDataFrame(found, "saida string, linhas long, vazia boolean, ausentes string, nao_numericas string")


def write_outputs(outputs: Mapping[str, DataFrame], base: str) -> dict[str, int]:
    """Write each named table to its own folder below ``base``; gives the number of rows of each."""
    jobs = [
        lambda df=df, name=name: write_csv(df, f"{base.rstrip('/')}/{name}")
        for name, df in outputs.items()
    ]
    if not jobs:
        return {}
    spark = next(iter(outputs.values())).sparkSession
    return dict(zip(outputs, run_together(spark, *jobs)))
