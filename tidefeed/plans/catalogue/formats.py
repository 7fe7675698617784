"""Sources and sinks: each query lands a table in a format and reads it back."""

from __future__ import annotations

import os
import sqlite3
import uuid
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefeed.operators import typed_rows
from tidefeed.plans.catalogue.registry import query, table
from tidefeed.sinks import (
    as_json,
    audit_outputs,
    text_form,
    write_csv,
    write_json,
    write_json_arrays,
    write_outputs,
)
from tidefeed.sources import (
    any_of,
    audit_files,
    id_number_pairs,
    load,
    load_split,
    read_database,
    read_delimited,
)
from tidefeed.sources.database import mounted
from tidefeed.storage import new_folder


@query("select * from customer")
def scan_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = new_folder(spark, "customer") + ".csv"
    write_csv(customer, path)
    return load(spark, path, customer.schema)


@query("select * from supplier")
def scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    path = new_folder(spark, "supplier") + ".csv"
    write_csv(supplier, path)
    # The narrowest integer type is inferred, which depends on how large the keys are.
    return load(spark, path).withColumn("s_suppkey", F.col("s_suppkey").cast("bigint"))


@query("select * from part")
def scan_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    path = new_folder(spark, "part") + ".txt"
    write_csv(part, path, separator="\t")
    return load(spark, path, part.schema)


@query("""select p_partkey, p_name || ',"' || p_brand || '"' p_name, p_size from part""")
def scan_csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    quoted = F.concat("p_name", F.lit(',"'), "p_brand", F.lit('"')).alias("p_name")
    part = table(spark, sf_dir, "part").select("p_partkey", quoted, "p_size")
    path = new_folder(spark, "quoted") + ".csv"
    write_csv(part, path)
    return load(spark, path, part.schema)


@query("select p_partkey, p_name, p_retailprice, cast(p_size as bigint) p_size from part")
def scan_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice", "p_size")
    path = new_folder(spark, "part") + ".json"
    write_json_arrays(part, path)
    return load(spark, path)


@query("select * from customer")
def scan_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = new_folder(spark, "customer") + ".jsonl"
    write_json(customer, path)
    return load(spark, path, customer.schema)


@query("select s_suppkey, s_name, s_acctbal from supplier")
def scan_multi_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    in_debt = F.col("s_acctbal") < 0
    base = new_folder(spark, "supplier")
    write_outputs(
        {"saida0.csv": supplier.where(in_debt), "saida1.csv": supplier.where(~in_debt)}, base
    )
    names = [f"saida{i}.csv" for i in range(11)]  # those that are not there are left out
    return load_split(spark, f"{any_of(base, names)}/*.csv", supplier.schema).accepted


@query("select cast(o_orderkey as varchar) id, o_totalprice value from orders where o_orderstatus <> 'P'")
def scan_id_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    readable = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("string"))
    orders = table(spark, sf_dir, "orders")
    path = new_folder(spark, "pairs") + ".csv"
    write_csv(
        orders.select(
            "o_orderkey", F.coalesce(readable, F.lit("n/d")).alias("total"), "o_orderpriority"
        ),
        path,
    )
    return id_number_pairs(spark, path)


@query("select * from supplier")
def scan_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks land their rows as database files of a bounded size; the scan cuts them by row ids."""
    return _through_database(spark, table(spark, sf_dir, "supplier"))


@query("""
select case when s_nationkey % 3 = 0 then null else s_suppkey end rowid, s_name, s_nationkey, s_acctbal
from supplier
""")
def scan_database_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of the table's own hides the usual name of its row ids, and is often NULL."""
    hidden = F.when(F.col("s_nationkey") % 3 != 0, F.col("s_suppkey")).alias("rowid")
    supplier = table(spark, sf_dir, "supplier")
    return _through_database(spark, supplier.select(hidden, "s_name", "s_nationkey", "s_acctbal"))


def _through_database(spark: SparkSession, supplier: DataFrame) -> DataFrame:
    place = mounted(new_folder(spark, "supplier") + ".db")
    place.mkdir(parents=True)
    folder, names = str(place), ", ".join(supplier.columns)

    def store(batches: list[pd.DataFrame], number: int) -> pd.DataFrame:
        # Built in memory and moved into place in one step: a retried task replaces its files.
        database = sqlite3.connect(":memory:")
        database.execute(f"create table suppliers ({names})")
        table = pd.concat(batches).convert_dtypes().astype(object)
        rows = table.where(table.notna(), None).itertuples(index=False, name=None)
        database.executemany("insert into suppliers values (?, ?, ?, ?)", rows)
        file = f"{folder}/part-{TaskContext.get().partitionId():06d}-{number:06d}.db"
        unfinished = f"{file}.{uuid.uuid4().hex}"
        Path(unfinished).write_bytes(database.serialize())
        os.replace(unfinished, file)
        database.close()
        return pd.DataFrame({"rows": [sum(map(len, batches))]})

    def land(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        number = 0
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= 500_000:
                yield store(held, number)
                held, number = [], number + 1
        if held:
            yield store(held, number)

    landed = supplier.mapInPandas(land, "rows long").agg(F.max("rows")).first()[0]
    parts = read_database(
        spark, folder, schema=supplier.schema, rows_per_partition=max(1, landed // 4)
    )
    return parts.accepted


@query("""
select s_suppkey, s_name, s_acctbal from supplier
union all select c_custkey, c_name, c_acctbal from customer
""")
def scan_csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables under the same names in another order, and a third that has other names."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    customer = table(spark, sf_dir, "customer")
    swapped = customer.select(
        F.col("c_acctbal").alias("s_acctbal"),
        F.col("c_name").alias("s_name"),
        F.col("c_custkey").alias("s_suppkey"),
    )
    foreign = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    base = new_folder(spark, "headers")
    write_outputs({"a.csv": supplier, "b.csv": swapped, "c.csv": foreign}, base)
    return load(spark, f"{any_of(base, ['a.csv', 'b.csv', 'c.csv'])}/*.csv", supplier.schema)


@query("""
select p_partkey, case p_size % 6 when 0 then ' ' || p_name || ' ' when 1 then '' when 2 then null
       when 3 then p_name || chr(10) || p_brand when 4 then '"' || p_name || '",\\n' || p_brand
       else p_name || '\\' end p_name
from part
""".replace("\\\\", "\\"))
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blanks at both ends, the empty text beside NULL, line breaks, quotes, separators, backslashes."""
    kind, name, brand = F.col("p_size") % 6, F.col("p_name"), F.col("p_brand")
    hard = (
        F.when(kind == 0, F.concat(F.lit(" "), name, F.lit(" ")))
        .when(kind == 1, "")
        .when(kind == 3, F.concat(name, F.lit("\n"), brand))
        .when(kind == 4, F.concat(F.lit('"'), name, F.lit('",\\n'), brand))
        .when(kind == 5, F.concat(name, F.lit("\\")))
    )
    part = table(spark, sf_dir, "part").select("p_partkey", hard.alias("p_name"))
    path = new_folder(spark, "hard")
    write_csv(part, path, line_safe=True)
    return read_delimited(spark, path, schema=part.schema, line_safe=True).accepted


@query("""
select p_partkey, case p_size % 3 when 0 then p_name || chr(10) || '"' || p_brand || '",' || chr(10) || chr(10) || p_type
       else p_name end p_name, p_size
from part
""")
def scan_csv_multi_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted fields over several lines, blank ones among them, with quotes and separators inside."""
    broken = F.concat("p_name", F.lit('\n"'), "p_brand", F.lit('",\n\n'), "p_type")
    name = F.when(F.col("p_size") % 3 == 0, broken).otherwise(F.col("p_name")).alias("p_name")
    part = table(spark, sf_dir, "part").select("p_partkey", name, "p_size")
    path = new_folder(spark, "multi-line")
    part.write.options(header=True, escape='"').csv(path)
    return read_delimited(spark, path, schema=part.schema, multi_line=True).accepted


@query("""
select 'quote' motivo, p_partkey || ',"' || p_name || ',' || p_size registro from part where p_size % 7 = 0
""")
def quote_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a quote that is not closed are set aside; those beside them are not."""
    part = table(spark, sf_dir, "part")
    closed = F.when(F.col("p_size") % 7 == 0, "").otherwise('"')
    line = F.concat(F.col("p_partkey").cast("string"), F.lit(',"'), "p_name", closed, F.lit(","), F.col("p_size").cast("string"))
    path = new_folder(spark, "open-quotes")
    part.select(line.alias("p_partkey,p_name,p_size")).write.options(header=True, quote="", sep="\x01").csv(path)
    return read_delimited(spark, path, schema=part.select("p_partkey", "p_name", "p_size").schema).rejected


@query("""
select p_partkey, p_name from part
""")
def scan_json_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array files beside files that hold something else; the others are set aside."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    base = new_folder(spark, "mixed")
    write_json_arrays(part, f"{base}/a.json")
    table(spark, sf_dir, "nation").select(F.to_json(F.struct("n_name")).alias("value")).write.text(
        f"{base}/b.json"
    )
    return load(spark, f"{base}/*.json", part.schema)


def _by_class(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Parts by size, a class that no part is in, one whose price is text and one that has none."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    size = F.col("p_size")
    return {
        "pequenas": part.where(size <= 10),
        "medias": part.where((size > 10) & (size <= 30)),
        "enormes": part.where(size > 1000),
        "em_texto": part.where(size > 30).withColumn("p_retailprice", F.format_string("%.2f", "p_retailprice")),
        "sem_preco": part.where(size > 30).drop("p_retailprice"),
    }


@query("""
select 'pequenas' saida, count(*) linhas, count(*) = 0 vazia, '' ausentes, '' nao_numericas from part where p_size <= 10
union all select 'medias', count(*), count(*) = 0, '', '' from part where p_size > 10 and p_size <= 30
union all select 'enormes', count(*), count(*) = 0, '', '' from part where p_size > 1000
union all select 'em_texto', null, null, '', 'p_retailprice'
union all select 'sem_preco', null, null, 'p_retailprice', ''
""")
def output_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each output: rows, whether it is empty, and columns for which it was refused."""
    base = new_folder(spark, "audited")
    return audit_outputs(_by_class(spark, sf_dir), base, required=["p_partkey"], numeric=["p_retailprice"])


@query("""
select p_size tamanho, count(*) linhas, cast(null as varchar) falta from part where p_size % 5 <> 0 group by p_size
union all select p_size, 0, 'no rows' from part where p_size % 10 = 0 group by p_size
union all select p_size, 0, 'no header' from part where p_size % 10 = 5 group by p_size
""")
def file_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each size: with all its parts, with a header alone, or with blank lines alone."""
    size, base = F.col("p_size"), new_folder(spark, "files")
    header, row = F.lit("p_partkey,p_name"), F.concat(F.col("p_partkey").cast("string"), F.lit(","), F.col("p_name"))
    text = (
        F.when(size % 10 == 5, "\n \n")
        .when(size % 10 == 0, F.concat(header, F.lit("\n")))
        .otherwise(F.concat(header, F.lit("\n"), F.array_join("rows", "\n\n")))
    )
    files = table(spark, sf_dir, "part").groupBy("p_size").agg(F.collect_list(row).alias("rows"))
    files.select("p_size", text.alias("value")).repartition("p_size").write.partitionBy("p_size").text(base)
    found = audit_files(spark, f"{base}/*")
    number = F.regexp_extract("file", "p_size=([0-9]+)", 1).cast("int").alias("tamanho")
    return found.select(number, F.col("rows").alias("linhas"), F.col("fault").alias("falta"))


def _uneven_lines(spark: SparkSession, sf_dir: str):
    """Orders as CSV, and beside them lines with a field too few (suppliers) and too many (parts)."""
    base = new_folder(spark, "uneven")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    short = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    long = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_type")
    write_outputs({"orders.csv": orders, "short.csv": short, "long.csv": long}, base)
    names = ["orders.csv", "short.csv", "long.csv"]
    return load_split(spark, f"{any_of(base, names)}/*.csv", orders.schema)


@query("select o_orderkey, o_orderstatus, o_totalprice from orders")
def arity_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _uneven_lines(spark, sf_dir).accepted


@query("""
select 'arity' motivo, s_suppkey || ',' || s_name registro from supplier
union all
select 'arity', p_partkey || ',' || p_brand || ',' || p_size || ',' || p_type from part
""")
def arity_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _uneven_lines(spark, sf_dir).rejected


@query("""
select 'type:o_custkey' motivo,
       '{"o_orderkey":"' || o_orderkey || '","o_custkey":"' || o_orderpriority || '"}' registro
from orders where o_orderstatus = 'P'
""")
def type_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text in an integer column sets its row aside; the file survives."""
    orders = table(spark, sf_dir, "orders")
    spoiled = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(
        F.col("o_custkey").cast("string")
    )
    path = new_folder(spark, "spoiled") + ".csv"
    write_csv(orders.select("o_orderkey", spoiled.alias("o_custkey")), path)
    layout = T.StructType([orders.schema["o_orderkey"], orders.schema["o_custkey"]])
    return load_split(spark, path, layout).rejected


@query("select o_orderkey, o_custkey k, o_orderstatus from orders where o_orderpriority <> '1-URGENT'")
def typed_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_rows(_with_gaps(spark, sf_dir)).accepted


@query("""
select o_orderkey, cast(null as bigint) k, o_orderstatus, 'missing:k' motivo
from orders where o_orderpriority = '1-URGENT'
""")
def typed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_rows(_with_gaps(spark, sf_dir)).rejected


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")).alias("k")
    return table(spark, sf_dir, "orders").select("o_orderkey", known, "o_orderstatus")


@query("""
select cast(c_custkey as varchar) c_custkey, c_name, cast(c_nationkey as varchar) c_nationkey,
       printf('%.6f', c_acctbal) c_acctbal, c_mktsegment
from customer
""")
def csv_text_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_form(table(spark, sf_dir, "customer"))


@query("""
select p_partkey, '{"p_partkey":' || p_partkey || ',"p_name":"\\"' || p_name || '\\\\\\"","p_size":'
       || p_size || '}' linha
from part
""")
def json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as JSON text, with quotes and backslashes in a value."""
    marked = F.concat(F.lit('"'), "p_name", F.lit('\\"')).alias("p_name")
    part = table(spark, sf_dir, "part").select("p_partkey", marked, "p_size")
    return part.select("p_partkey", as_json(part).alias("linha"))
