"""Learnt rules, checked on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.operators import validate
from tidefeed.plans import weekly
from tidefeed.plans.catalogue.registry import query, table


def _ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = F.floor(F.col("o_totalprice") / 1000).cast("int").alias("idade")
    return table(spark, sf_dir, "orders").select("o_orderkey", age)


@query("""
select o_orderkey, cast(floor(o_totalprice / 1000) as int) idade from orders
where floor(o_totalprice / 1000) between 0 and 120
""")
def validate_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(_ages(spark, sf_dir), order_by=["o_orderkey"]).accepted


@query("""
select o_orderkey, cast(floor(o_totalprice / 1000) as int) idade, 'invalid:idade' motivo
from orders where floor(o_totalprice / 1000) > 120
""")
def validate_range_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(_ages(spark, sf_dir), order_by=["o_orderkey"]).rejected


@query("""
select o_orderkey, 10000 + o_custkey * 70 cep_region from orders
where length(cast(10000 + o_custkey * 70 as varchar)) = 5
""")
def validate_region_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name says it is a region code, so it must have five digits."""
    code = (10000 + F.col("o_custkey") * 70).alias("cep_region")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", code)
    return validate(orders, order_by=["o_orderkey"]).accepted


@query("""
select c_custkey, case when c_acctbal < 0 then 100 + c_nationkey else 10 + c_nationkey end cep
from customer where c_acctbal >= 0
""")
def validate_learnt_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first codes in the order of the balance have two digits, so all must."""
    code = F.when(F.col("c_acctbal") < 0, 100 + F.col("c_nationkey"))
    customer = table(spark, sf_dir, "customer").withColumn(
        "cep", F.coalesce(code, 10 + F.col("c_nationkey"))
    )
    ordered = customer.select("c_custkey", "cep", (-F.col("c_acctbal")).alias("order"))
    checked = validate(ordered, order_by=["order", "c_custkey"], exempt=("data", "order")).accepted
    return checked.select("c_custkey", "cep")


@query("""
select event_id, case when event_type = 'error' then 7 when event_type = 'click' then 1 else 0 end
       clicou
from events where event_type <> 'error'
""")
def validate_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In the order of the labels the first values are 0 and 1, so a 7 is at fault."""
    clicked = F.when(F.col("event_type") == "error", 7).otherwise(
        (F.col("event_type") == "click").cast("int")
    )
    events = table(spark, sf_dir, "events").select("event_id", clicked.alias("clicou"))
    return validate(events, order_by=["clicou", "event_id"]).accepted


@query("""
select o_orderkey, o_orderstatus nota, strftime(o_orderdate, '%d-%m-%Y') data
from (select o_orderkey, o_orderdate, case when o_orderstatus = 'P' then '' else o_orderstatus end
      o_orderstatus from orders)
where o_orderstatus = ''
""")
def validate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text fits no rule, so a filled text column rules a row out; the column ``data`` is exempt."""
    note = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", note.alias("nota"), F.date_format("o_orderdate", "dd-MM-yyyy").alias("data")
    )
    return validate(orders, order_by=["o_orderkey"]).accepted


@query("""
select event_id, case when event_type = 'click' then 1 else 0 end clicou from events where event_id % 97 <> 0
""")
def validate_treat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearly all values are 0 or 1, so the few others are rejected, in whatever order the rows come."""
    clicked = F.when(F.col("event_id") % 97 == 0, 7).otherwise((F.col("event_type") == "click").cast("int"))
    events = table(spark, sf_dir, "events").select("event_id", clicked.alias("clicou"))
    return weekly.treat(events, ["event_id", "clicou"])


def _stray_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of two digits, but for one row in fifty; a column of which one value in ten is no 0 or 1."""
    code = F.when(F.col("o_orderkey") % 50 == 0, 100).otherwise(10 + F.col("o_custkey") % 90).alias("cep")
    often = F.when(F.col("o_orderkey") % 10 == 0, 5).otherwise(F.col("o_custkey") % 2).alias("vezes")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey"), code, often)


@query("""
select o_orderkey, 10 + o_custkey % 90 cep, case when o_orderkey % 10 = 0 then 5 else o_custkey % 2 end vezes
from orders where o_orderkey % 50 <> 0
""")
def validate_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of all rows, without an order: too few strays to keep the code's rule from being learnt."""
    return validate(_stray_codes(spark, sf_dir)).accepted


@query("""
select o_orderkey, cast(100 as bigint) cep, cast(5 as bigint) vezes, 'invalid:cep' motivo from orders where o_orderkey % 50 = 0
""")
def validate_unordered_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(_stray_codes(spark, sf_dir)).rejected
