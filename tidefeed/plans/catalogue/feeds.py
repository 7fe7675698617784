"""The three feeds, derived from the test tables: their rows grow with events, orders and lineitem."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.plans.catalogue.registry import table
from tidefeed.schemas import FEEDS


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _day(moment: str) -> Column:
    return F.date_format(moment, "dd-MM-yyyy")


def _region(moment: str) -> Column:
    """A five-digit code: a two-digit island from the day, a three-digit region from the month."""
    return (10 + F.dayofmonth(moment)) * 1000 + F.month(moment)


def _shaped(df: DataFrame, feed: str, **columns: Column) -> DataFrame:
    layout = FEEDS[feed]
    return df.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in layout])


def oms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shaped(
        table(spark, sf_dir, "events"),
        "oms",
        num_obitos=F.floor("value"),
        populacao=1000 + F.col("user_id"),
        cep=10 + F.dayofmonth("ts"),
        num_recuperados=F.floor(F.col("value") * 2),
        num_vacinados=F.length("event_type") * 100,
        data=_day("ts"),
    )


def hospital(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shaped(
        table(spark, sf_dir, "orders"),
        "hospital",
        id_hospital=F.substring("o_orderpriority", 1, 1),
        data=_day("o_orderdate"),
        internado=_flag(F.col("o_orderstatus") == "F"),
        idade=F.floor(F.col("o_totalprice") / 4000),
        sexo=_flag(F.month("o_orderdate") <= 6),
        cep=_region("o_orderdate"),
        sintoma1=_flag(F.col("o_totalprice") > 250000),
        sintoma2=_flag(F.col("o_orderpriority") < "3"),
        sintoma3=_flag(F.year("o_orderdate") < 1998),
        sintoma4=_flag(F.col("o_orderstatus") == "O"),
    )


def secretaria(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shaped(
        table(spark, sf_dir, "lineitem"),
        "secretaria",
        diagnostico=_flag(F.col("l_returnflag") == "R"),
        vacinado=_flag(F.col("l_linestatus") == "F"),
        cep=_region("l_shipdate"),
        escolaridade=F.col("l_linenumber"),
        populacao=F.floor("l_extendedprice"),
        data=_day("l_shipdate"),
    )


def _region_sql(moment: str) -> str:
    return f"cast((10 + day({moment})) * 1000 + month({moment}) as int)"


OMS_SQL = """
select cast(floor(value) as int) num_obitos, cast(1000 + user_id as int) populacao,
       cast(10 + day(ts) as int) cep, cast(floor(value * 2) as int) num_recuperados,
       cast(length(event_type) * 100 as int) num_vacinados, strftime(ts, '%d-%m-%Y') data
from events
"""

HOSPITAL_SQL = f"""
select cast(substr(o_orderpriority, 1, 1) as int) id_hospital,
       strftime(o_orderdate, '%d-%m-%Y') data,
       case when o_orderstatus = 'F' then 1 else 0 end internado,
       cast(floor(o_totalprice / 4000) as int) idade,
       case when month(o_orderdate) <= 6 then 1 else 0 end sexo,
       {_region_sql("o_orderdate")} cep,
       case when o_totalprice > 250000 then 1 else 0 end sintoma1,
       case when o_orderpriority < '3' then 1 else 0 end sintoma2,
       case when year(o_orderdate) < 1998 then 1 else 0 end sintoma3,
       case when o_orderstatus = 'O' then 1 else 0 end sintoma4
from orders
"""

SECRETARIA_SQL = f"""
select case when l_returnflag = 'R' then 1 else 0 end diagnostico,
       case when l_linestatus = 'F' then 1 else 0 end vacinado,
       {_region_sql("l_shipdate")} cep, l_linenumber escolaridade,
       cast(floor(l_extendedprice) as int) populacao, strftime(l_shipdate, '%d-%m-%Y') data
from lineitem
"""
