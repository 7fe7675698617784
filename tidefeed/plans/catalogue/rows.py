"""Masks, flags, and adding and removing rows and columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.functions import island_code, norm_key, null_tokens
from tidefeed.operators import (
    add_column,
    align_column,
    aligned,
    age_filter,
    append_rows,
    drop_keys,
    keep_rows,
    remove_column,
    threshold_flag,
)
from tidefeed.plans.catalogue.registry import island_sql, query, table


@query("select l_orderkey, l_linenumber, l_tax from lineitem where l_discount > l_tax")
def keep_by_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    kept = keep_rows(items, F.col("l_discount") > F.col("l_tax"))
    return kept.select("l_orderkey", "l_linenumber", "l_tax")


@query("select o_orderkey, o_totalprice / 1000 idade from orders where o_totalprice / 1000 between 0 and 120")
def age_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = (F.col("o_totalprice") / 1000).alias("idade")
    return age_filter(table(spark, sf_dir, "orders").select("o_orderkey", age), "idade")


@query("""
select l_orderkey, l_linenumber, l_quantity,
       case when l_quantity > 25 then 'True' else 'False' end acima
from lineitem
""", name="threshold_flag")
def above_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return threshold_flag(items, "l_quantity", 25.0, "acima")


@query("""
select * from customer
where c_custkey not in (select o_custkey from orders where o_totalprice > 450000)
""", name="drop_keys")
def without_large_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = table(spark, sf_dir, "orders").where(F.col("o_totalprice") > 450000)
    keys = large.select(F.col("o_custkey").alias("c_custkey"))
    return drop_keys(table(spark, sf_dir, "customer"), keys, "c_custkey")


@query("select s_suppkey, s_name, s_nationkey from supplier")
def drop_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_column(remove_column(table(spark, sf_dir, "supplier"), "s_acctbal"), "absent")


@query(
    "select *, l_extendedprice * (1 - l_discount) valor from lineitem", name="add_column"
)
def with_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return add_column(table(spark, sf_dir, "lineitem"), "valor", revenue)


def _values_for_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders, and an outside value for each: none for some, two for others, and some for orders there are not."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    value = (F.col("o_totalprice") * 2).alias("dobro")
    values = orders.where("o_orderkey % 11 <> 0").select("o_orderkey", value)
    twice = orders.where("o_orderkey % 13 = 0").select("o_orderkey", value)
    beyond = table(spark, sf_dir, "customer").select((-1 - F.col("c_custkey")).alias("o_orderkey"), F.col("c_acctbal").alias("dobro"))
    return orders, values.unionAll(twice).unionAll(beyond)


@query("""
select o_orderkey, o_totalprice, o_totalprice * 2 dobro from orders
where (o_orderkey % 11 = 0) = (o_orderkey % 13 = 0)
""")
def align_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, values = _values_for_orders(spark, sf_dir)
    return align_column(orders, values, "dobro", "o_orderkey").accepted


@query("""
select o_orderkey, o_totalprice, cast(null as double) dobro,
       case when o_orderkey % 11 = 0 and o_orderkey % 13 <> 0 then 'unmatched' when o_orderkey % 11 <> 0 then 'repeated' end motivo
from orders where (o_orderkey % 11 = 0) <> (o_orderkey % 13 = 0)
union all
select -1 - c_custkey, null, c_acctbal, 'unused' from customer
""")
def align_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a value or with two, and values without an order."""
    orders, values = _values_for_orders(spark, sf_dir)
    return align_column(orders, values, "dobro", "o_orderkey").rejected


@query("select s_suppkey, s_name, s_nationkey, s_acctbal, s_acctbal / 2 metade from supplier")
def align_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that fits row for row is added; one that does not would be refused."""
    supplier = table(spark, sf_dir, "supplier")
    return aligned(supplier, supplier.select("s_suppkey", (F.col("s_acctbal") / 2).alias("metade")), "metade", "s_suppkey")


@query("""
select c_custkey k, c_name nome, c_acctbal saldo from customer
union all
select s_suppkey, s_name, s_acctbal from supplier where s_acctbal >= 0
""", name="append_rows")
def append_typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that misses some amounts: its other rows are added."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_name").alias("nome"), F.col("c_acctbal").alias("saldo")
    )
    known = F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal"))
    batch = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("nome"), known.alias("saldo"), F.col("s_suppkey").alias("k")
    )
    return append_rows(customer, batch)


@query("""
select event_id, case when event_type in ('purchase') then event_type end tipo
from events
""", name="null_tokens")
def tokens_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that stand for a missing value, one per kind of event, become NULL."""
    tokens = {"click": "", "view": "null", "signup": "NULL", "error": "NaN"}
    spoiled = F.coalesce(
        *[F.when(F.col("event_type") == kind, F.lit(text)) for kind, text in tokens.items()],
        F.col("event_type"),
    )
    return table(spark, sf_dir, "events").select("event_id", null_tokens(spoiled).alias("tipo"))


@query(f"""
select l_orderkey, l_linenumber, {island_sql("l_partkey")} por_numero,
       {island_sql("cast(trunc(l_extendedprice) as bigint)")} por_fracao,
       {island_sql("l_shipdate")} por_texto
from lineitem
""", name="island_code")
def island_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The island code of whole numbers, of fractions and of text with other characters in it."""
    items = table(spark, sf_dir, "lineitem").withColumn(
        "texto", F.date_format("l_shipdate", "yyyy-MM-dd")
    )
    return items.select(
        "l_orderkey",
        "l_linenumber",
        island_code(items, "l_partkey").alias("por_numero"),
        island_code(items, "l_extendedprice").alias("por_fracao"),
        island_code(items, "texto").alias("por_texto"),
    )


@query("""
select o_orderkey, cast(trunc(o_totalprice) as bigint) de_fracao,
       cast(substr(o_orderpriority, 1, 1) as bigint) de_texto, cast(null as bigint) de_palavra
from orders
""", name="norm_key")
def integer_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer keys from fractions, from text that starts with a number, and from text that does not."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        norm_key(orders, "o_totalprice").alias("de_fracao"),
        norm_key(orders, "o_orderpriority").alias("de_texto"),
        norm_key(orders, "o_orderstatus").alias("de_palavra"),
    )
