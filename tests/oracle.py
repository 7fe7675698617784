"""Run a named query in Spark and its SQL in DuckDB, and compare types and rows."""

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SAME_TYPE = {
    "string": {"VARCHAR"},
    "int": {"INTEGER"},
    "bigint": {"BIGINT"},
    "double": {"DOUBLE"},
    "timestamp_ntz": {"TIMESTAMP"},
    "timestamp": {"TIMESTAMP"},
}


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _rows(rows, order):
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def compare(df, con, sql):
    """Raise AssertionError where the two results differ; give the number of rows."""
    got = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = [str(d[1]) for d in cursor.description]
    want = cursor.fetchall()
    assert sorted(df.columns) == sorted(names), (df.columns, names)
    for name, dtype in zip(names, types):
        ours = df.schema[name].dataType.simpleString()
        assert dtype in SAME_TYPE.get(ours, {dtype}), (name, ours, dtype)
    ours = _rows(got, [df.columns.index(n) for n in sorted(names)])
    theirs = _rows(want, [names.index(n) for n in sorted(names)])
    assert len(ours) == len(theirs), (len(ours), len(theirs))
    for a, b in zip(ours, theirs):
        assert a == b, (a, b)
    return len(ours)
