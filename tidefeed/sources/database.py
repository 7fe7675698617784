"""Database tables as partitioned scans: SQLite files by ranges of row ids, servers by JDBC."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import quote

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "tidefeed_table_file"
ROWS_PER_PARTITION = 1_000_000
#: Files up to this size are read whole unless the caller says how many rows a partition should hold.
WHOLE_FILE_BYTES = 64 * 1024 * 1024
#: Row ids may have wide gaps; a file is never cut into more ranges than this.
MAX_RANGES = 10_000
#: The names of a table's row id.
ROW_ID_NAMES = ("rowid", "_rowid_", "oid")
_FETCHED = 10_000
_UNFIT = "__unfit"
_UNFIT_FIELD = T.StructField(_UNFIT, T.StringType())

# Executors need not have this package installed: the classes below travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_database(
    spark: SparkSession,
    path: str,
    table: str | None = None,
    schema: T.StructType | None = None,
    rows_per_partition: int | None = None,
):
    """A table of a SQLite file, or of all in a folder or of a glob; by default the first in its catalog.

    Cells that do not fit the type of their column set a row aside; binary cells count as missing. The
    path must be one that all executors can open, such as a mounted share.
    """
    from tidefeed.functions import col
    from tidefeed.sources.files import as_record, record_split

    spark.dataSource.register(TableFileSource)
    reader = spark.read.format(FORMAT)
    if rows_per_partition:
        reader = reader.option("rows_per_partition", rows_per_partition)
    if table:
        reader = reader.option("table", table)
    if schema is not None:
        reader = reader.schema(T.StructType([*map(_widest, schema), _UNFIT_FIELD]))
    rows = reader.load(path)
    fields = schema or [f for f in rows.schema if f.name != _UNFIT]
    faults = [F.when(F.col(_UNFIT).isNotNull(), F.concat(F.lit("type:"), F.col(_UNFIT)))]
    typed = []
    for field in fields:
        value = col(field.name).try_cast(field.dataType)
        lost = col(field.name).isNotNull() & value.isNull()
        faults.append(F.when(lost, F.lit(f"type:{field.name}")))
        typed.append(value.alias(field.name))
    record = as_record(rows.drop(_UNFIT))
    return record_split(rows, typed, F.coalesce(*faults), record, F.col(_UNFIT).isNull())


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int,
    upper: int,
    partitions: int,
    **properties: str,
) -> DataFrame:
    """A server's table, read in parallel by ranges of a numeric column."""
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties,
    )


class RowRange(InputPartition):
    """The rows of one file with ids from ``first`` to ``last``, both included; all rows without ids.

    ``row_id`` is the name under which the table gives its row ids.
    """

    def __init__(
        self, file: str, first: int | None = None, last: int | None = None, row_id: str = "rowid"
    ):
        self.file, self.first, self.last, self.row_id = file, first, last, row_id


def _open(file: str):
    import sqlite3

    connection = sqlite3.connect(f"file:{quote(file)}?mode=ro&immutable=1", uri=True)
    connection.text_factory = lambda raw: raw.decode("utf-8", "replace")
    return connection


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def mounted(path: str) -> Path:
    """A path that the operating system of every executor can open."""
    plain = path.removeprefix("file://").removeprefix("file:")
    if "://" in plain:
        raise ValueError(f"database files must lie on a mounted path: {path}")
    return Path(plain)


def _files(path: str) -> list[str]:
    """The database files of a folder, or those that a path or glob names."""
    import glob

    place = mounted(path)
    if place.is_dir():
        found = sorted(str(f) for f in place.iterdir() if f.suffix in (".db", ".sqlite"))
    elif place.is_file():
        found = [str(place)]
    else:
        found = sorted(f for f in glob.glob(str(place)) if Path(f).is_file())
    if not found:
        raise FileNotFoundError(f"no database file at {path}")
    return found


def _table(connection, wanted: str | None) -> str:
    if wanted:
        return wanted
    row = connection.execute(
        "SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY rowid LIMIT 1"
    ).fetchone()
    if row is None:
        raise ValueError("no table found")
    return row[0]


class TableFileSource(DataSource):
    """Spark data source for SQLite files, with one partition per range of row ids."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        """Column types from the first value of each column that is not NULL."""
        kinds = {"integer": T.LongType(), "real": T.DoubleType()}
        fields: dict[str, T.DataType | None] = {}
        for file in _files(self.options["path"]):
            connection = _open(file)
            table = _quoted(_table(connection, self.options.get("table")))
            names = [d[0] for d in connection.execute(f"SELECT * FROM {table} LIMIT 0").description]
            for name in names:
                if fields.setdefault(name) is None:
                    c = _quoted(name)
                    first = connection.execute(
                        f"SELECT typeof({c}) FROM {table} WHERE {c} IS NOT NULL LIMIT 1"
                    ).fetchone()
                    if first:
                        fields[name] = kinds.get(first[0], T.StringType())
            connection.close()
            if None not in fields.values():
                break
        columns = [T.StructField(n, t or T.StringType()) for n, t in fields.items()]
        return T.StructType([*columns, _UNFIT_FIELD])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        stride = self.options.get("rows_per_partition")
        stride = int(stride) if stride else None
        return TableFileReader(schema, self.options["path"], self.options.get("table"), stride)


class TableFileReader(DataSourceReader):
    def __init__(self, schema: T.StructType, path: str, table: str | None, stride: int | None):
        self.columns = [f for f in schema if f.name != _UNFIT]
        self.path, self.table, self.stride = path, table, stride

    def partitions(self) -> list[RowRange]:
        ranges = []
        for file in _files(self.path):
            if self.stride is None and Path(file).stat().st_size <= WHOLE_FILE_BYTES:
                ranges.append(RowRange(file))
                continue
            connection = _open(file)
            ranges += self._ranges(connection, file)
            connection.close()
        return ranges

    def _ranges(self, connection, file: str) -> list[RowRange]:
        """Ranges that cover all row ids. A table is read whole where it has none, or no free name for
        them: a column called like one hides it."""
        import sqlite3

        table = _quoted(_table(connection, self.table))
        cursor = connection.execute(f"SELECT * FROM {table} LIMIT 0")
        taken = {d[0].lower() for d in cursor.description}
        row_id = next((name for name in ROW_ID_NAMES if name not in taken), None)
        if row_id is None:
            return [RowRange(file)]
        try:
            ends = f"SELECT min({row_id}), max({row_id}) FROM {table}"
            first, last = connection.execute(ends).fetchone()
        except sqlite3.OperationalError:
            return [RowRange(file)]
        if not isinstance(first, int) or not isinstance(last, int):  # empty, or a view
            return [RowRange(file)]
        stride = max(self.stride or ROWS_PER_PARTITION, (last - first) // MAX_RANGES + 1)
        starts = range(first, last + 1, stride)
        return [RowRange(file, at, min(at + stride - 1, last), row_id) for at in starts]

    def read(self, partition: RowRange) -> Iterator:
        import pyarrow as pa

        connection = _open(partition.file)
        table = _quoted(_table(connection, self.table))
        names = ", ".join(_quoted(f.name) for f in self.columns)
        query, bounds = f"SELECT {names} FROM {table}", ()
        if partition.first is not None:
            query += f" WHERE {partition.row_id} BETWEEN ? AND ?"
            bounds = (partition.first, partition.last)
        cursor = connection.execute(query, bounds)
        kinds = [_accepted_kinds(f.dataType) for f in self.columns]
        arrow = [_arrow_type(f.dataType) for f in self.columns] + [pa.string()]
        header = [f.name for f in self.columns] + [_UNFIT]
        while rows := cursor.fetchmany(_FETCHED):
            unfit: list[str | None] = [None] * len(rows)
            arrays = []
            for field, kind, cells in zip(self.columns, kinds, map(list, zip(*rows))):
                for i, cell in enumerate(cells):
                    if cell is None or isinstance(cell, kind):
                        continue
                    if not isinstance(cell, bytes) or str not in kind:
                        unfit[i] = unfit[i] or field.name
                    cells[i] = None
                arrays.append(cells)
            filled = [pa.array(c, t) for c, t in zip([*arrays, unfit], arrow)]
            yield pa.RecordBatch.from_arrays(filled, names=header)
        connection.close()


def _widest(field: T.StructField) -> T.StructField:
    """The field as the file stores it: whole numbers have 64 bits, others are floating or text."""
    if isinstance(field.dataType, T.IntegralType):
        return T.StructField(field.name, T.LongType())
    if isinstance(field.dataType, T.NumericType):
        return T.StructField(field.name, T.DoubleType())
    return T.StructField(field.name, T.StringType())


def _accepted_kinds(dtype: T.DataType) -> tuple[type, ...]:
    if isinstance(dtype, T.LongType):
        return (int,)
    return (int, float) if isinstance(dtype, T.DoubleType) else (str,)


def _arrow_type(dtype: T.DataType):
    import pyarrow as pa

    if isinstance(dtype, T.LongType):
        return pa.int64()
    return pa.float64() if isinstance(dtype, T.DoubleType) else pa.string()
