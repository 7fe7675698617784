"""Totals, alerts, statistics, correlation and regression."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.operators import (
    alert_rows,
    alert_summary,
    append_rows,
    column_mean,
    column_sum,
    group_sum,
    group_sum_island,
    group_sum_text,
    linreg,
    mean_alert,
    pearson,
    stats,
    stats_by,
)
from tidefeed.plans.catalogue.registry import island_key_sql, query, rounded, table

_PER_SUPPLIER = """
select cast(l_suppkey as varchar) l_suppkey, sum(l_quantity) "Total_l_quantity"
from lineitem group by 1
"""

_PER_ISLAND = f"""
select {island_key_sql("l_partkey")} l_partkey, sum(l_quantity) "Total_l_quantity"
from lineitem group by 1
"""


@query(f'select l_suppkey, round("Total_l_quantity", 2) "Total_l_quantity" from ({_PER_SUPPLIER})',
       name="group_sum")
def per_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = group_sum(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity")
    return totals.withColumn("Total_l_quantity", rounded("Total_l_quantity"))


@query(f'select l_partkey, round("Total_l_quantity", 2) "Total_l_quantity" from ({_PER_ISLAND})',
       name="group_sum_island")
def per_island(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = group_sum_island(table(spark, sf_dir, "lineitem"), "l_partkey", "l_quantity")
    return totals.withColumn("Total_l_quantity", rounded("Total_l_quantity"))


@query("""
select l_returnflag, round(sum(case when l_linestatus = 'F' then l_extendedprice else 0 end), 2)
       "Total_valor"
from lineitem group by 1
""", name="group_sum_text")
def per_flag_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts as text, half of which are no numbers; three groups hold all rows."""
    amount = F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice").cast("string"))
    items = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.coalesce(amount, F.lit("n/d")).alias("valor")
    )
    totals = group_sum_text(items, "l_returnflag", "valor")
    return totals.withColumn("Total_valor", rounded("Total_valor"))


@query("select round(sum(l_quantity), 2) sum from lineitem", name="column_sum")
def quantity_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_sum(table(spark, sf_dir, "lineitem"), "l_quantity").select(rounded("sum"))


@query("""
select round(sum(case when l_returnflag <> 'R' then l_quantity end) / count(*), 6) mean
from lineitem
""", name="column_mean")
def quantity_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean counts the rows without a value too."""
    known = F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("q")
    items = table(spark, sf_dir, "lineitem").select(known)
    return column_mean(items, "q").select(rounded("mean", 6))


@query(f"""
select l_suppkey, round("Total_l_quantity", 2) "Total_l_quantity",
       case when "Total_l_quantity" >
              (select sum("Total_l_quantity") / count(*) from ({_PER_SUPPLIER}))
            then 'Vermelho' else 'Verde' end "Alertas"
from ({_PER_SUPPLIER})
""", name="mean_alert")
def supplier_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = group_sum(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity")
    flagged = mean_alert(totals, "Total_l_quantity")
    return flagged.withColumn("Total_l_quantity", rounded("Total_l_quantity"))


_ISLAND_ALERTS = f"""
select l_partkey, case when "Total_l_quantity" >
       (select sum("Total_l_quantity") / count(*) from ({_PER_ISLAND}))
       then 'Vermelho' else 'Verde' end "Alertas"
from ({_PER_ISLAND})
"""


def _island_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return mean_alert(group_sum_island(items, "l_partkey", "l_quantity"), "Total_l_quantity")


@query(f"""
select coalesce(string_agg(lpad(cast(l_partkey as varchar), 2, '0'), ', '
                order by lpad(cast(l_partkey as varchar), 2, '0'))
                filter (where "Alertas" = 'Vermelho'), '(nenhum)') vermelho,
       coalesce(string_agg(lpad(cast(l_partkey as varchar), 2, '0'), ', '
                order by lpad(cast(l_partkey as varchar), 2, '0'))
                filter (where "Alertas" = 'Verde'), '(nenhum)') verde
from ({_ISLAND_ALERTS})
""", name="alert_summary")
def island_alert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_summary(_island_alerts(spark, sf_dir), "l_partkey")


@query(f"""
select "Alertas", l_suppkey from (
  select l_suppkey, case when "Total_l_quantity" >
         (select sum("Total_l_quantity") / count(*) from ({_PER_SUPPLIER}))
         then 'Vermelho' else 'Verde' end "Alertas"
  from ({_PER_SUPPLIER}))
""", name="alert_rows")
def supplier_alert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = group_sum(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity")
    return alert_rows(mean_alert(totals, "Total_l_quantity"), "l_suppkey")


# Several runs' totals per supplier, pooled: one run per status of the line.
_POOLED_SQL = """
select cast(l_suppkey as bigint) l_suppkey, sum(l_quantity) total
from lineitem group by l_suppkey, l_linestatus
"""


def _pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    shipped = F.col("l_linestatus") == "F"
    first = group_sum(items.where(shipped), "l_suppkey", "l_quantity")
    return append_rows(first, group_sum(items.where(~shipped), "l_suppkey", "l_quantity"))


@query(f"""
select count(*) registros, round(avg(total), 6) media, round(stddev_pop(total), 6) desvio
from ({_POOLED_SQL})
""")
def stats_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = stats(_pooled(spark, sf_dir), "Total_l_quantity")
    return totals.select("registros", rounded("media", 6), rounded("desvio", 6))


@query(f"""
select l_suppkey, round(avg(total), 6) media, round(stddev_pop(total), 6) desvio
from ({_POOLED_SQL}) group by l_suppkey order by l_suppkey
""")
def stats_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = stats_by(_pooled(spark, sf_dir), "l_suppkey", "Total_l_quantity")
    return totals.select("l_suppkey", rounded("media", 6), rounded("desvio", 6))


@query("""
select l_returnflag bandeira, 'Verde' "Alertas", count(*) linhas from lineitem group by 1
""", name="mean_alert_constant")
def constant_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column whose values are all equal is nowhere above its mean."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("bandeira"), F.lit(1.0).alias("valor")
    )
    flagged = mean_alert(items, "valor")
    return flagged.groupBy("bandeira", "Alertas").agg(F.count(F.lit(1)).alias("linhas"))


@query("select round(corr(l_extendedprice, l_quantity), 6) correlacao from lineitem", name="pearson")
def price_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return pearson(items, "l_extendedprice", "l_quantity").select(rounded("correlacao", 6))


@query("""
select round(corr(x, y), 6) correlacao from (
  select case when l_returnflag <> 'R' then l_extendedprice end x,
         case when l_linestatus = 'F' then l_quantity end y from lineitem)
""")
def pearson_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only pairs in which both values are there count."""
    items = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("x"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).alias("y"),
    )
    return pearson(items, "x", "y").select(rounded("correlacao", 6))


@query("select cast(null as double) correlacao")
def pearson_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").withColumn("x", F.lit(0.1))
    return pearson(items, "x", "l_quantity")


@query("""
select round(regr_intercept(l_extendedprice, l_quantity), 4) intercepto,
       round(regr_slope(l_extendedprice, l_quantity), 4) coeficiente
from lineitem
""", name="linreg")
def price_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = linreg(table(spark, sf_dir, "lineitem"), x="l_quantity", y="l_extendedprice")
    return line.select(rounded("intercepto", 4), rounded("coeficiente", 4))
