"""Merges of totals on a common island code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.operators import (
    group_sum,
    group_sum_island,
    linreg,
    lookup_join,
    merge_three,
    pearson,
)
from tidefeed.plans.catalogue.registry import (
    island_key_sql,
    island_sql,
    query,
    rounded,
    table,
)

_A_SQL = f"""
select {island_key_sql("o_custkey")} cep, sum(o_totalprice) a from orders group by 1
"""
_B_SQL = f"""
select {island_key_sql("c_custkey")} cep, sum(c_acctbal) b from customer group by 1
"""
_C_SQL = f"""
select {island_key_sql("l_partkey")} cep, sum(l_quantity) c from lineitem group by 1
"""


def _totals(spark: SparkSession, sf_dir: str, name: str, key: str, measure: str, total: str):
    rows = table(spark, sf_dir, name).select(
        F.col(key).alias("cep"), F.col(measure).alias(total)
    )
    return group_sum_island(rows, "cep", total)


def _merged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    merged = merge_three(
        _totals(spark, sf_dir, "orders", "o_custkey", "o_totalprice", "a"),
        _totals(spark, sf_dir, "customer", "c_custkey", "c_acctbal", "b"),
        _totals(spark, sf_dir, "lineitem", "l_partkey", "l_quantity", "c"),
        "cep",
        "Total_b",
        "Total_c",
    )[name]
    return merged.select("cep", *[rounded(c) for c in merged.columns if c != "cep"])


@query(f"""
select cep, round(a, 2) "Total_a", round(coalesce(b, 0), 2) "Total_b_B"
from ({_A_SQL}) left join ({_B_SQL}) using (cep)
""")
def merge_ab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, "AB")


@query(f"""
select cep, round(a, 2) "Total_a", round(coalesce(c, 0), 2) "Total_c_C"
from ({_A_SQL}) left join ({_C_SQL}) using (cep)
""")
def merge_ac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, "AC")


@query(f"""
select cep, round(b, 2) "Total_b", round(coalesce(c, 0), 2) "Total_c_C"
from ({_B_SQL}) left join ({_C_SQL}) using (cep)
""")
def merge_bc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, "BC")


@query(f"""
select cep, round(a, 2) "Total_a", round(coalesce(b, 0), 2) "Total_b_B",
       round(coalesce(c, 0), 2) "Total_c_C"
from ({_A_SQL}) left join ({_B_SQL}) using (cep) left join ({_C_SQL}) using (cep)
""")
def merge_abc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, "ABC")


@query(f"""
select o_orderkey, cep, coalesce(v, 0.0) "Total_saldo_C"
from (select o_orderkey, cast(o_custkey as bigint) cep, {island_sql("o_custkey")} code from orders)
left join (select {island_sql("s_nationkey")} code, round(sum(s_acctbal), 2) v
           from supplier group by s_nationkey) using (code)
""", name="lookup_join")
def order_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order looks up a total by the first two digits of its customer; many find none."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("cep"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("cep"), F.col("s_acctbal").alias("saldo")
    )
    totals = group_sum(suppliers, "cep", "saldo")
    totals = totals.withColumn("Total_saldo", rounded("Total_saldo"))
    return lookup_join(orders, totals, "cep", "Total_saldo", "_C")


@query(f"""
select p_partkey cep, v p_last
from (select p_partkey, {island_sql("p_partkey")} code from part)
left join (select {island_sql("c_custkey")} code, max_by(c_name, c_custkey) v
           from customer group by 1) using (code)
""", name="lookup_last_wins")
def last_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many right rows have one code: the last by its key counts."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cep"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cep"), F.col("c_name").alias("p")
    )
    return lookup_join(parts, customers, "cep", "p", "_last", fill=None)


@query(f"""
select round(corr(b, coalesce(c, 0)), 6) correlacao
from ({_B_SQL}) left join ({_C_SQL}) using (cep)
""")
def pearson_of_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = _merged(spark, sf_dir, "BC")
    return pearson(merged, "Total_b", "Total_c_C").select(rounded("correlacao", 6))


@query(f"""
select round(regr_intercept(a, coalesce(c, 0)), 2) intercepto,
       round(regr_slope(a, coalesce(c, 0)), 6) coeficiente
from ({_A_SQL}) left join ({_C_SQL}) using (cep)
""")
def linreg_of_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = linreg(_merged(spark, sf_dir, "AC"), x="Total_c_C", y="Total_a")
    return line.select(rounded("intercepto"), rounded("coeficiente", 6))
