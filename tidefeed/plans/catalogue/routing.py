"""Routing by file name, by origin and by variant."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.operators import allow_list, by_origin, check_union, listed_fields, split_union
from tidefeed.operators.routing import write_by_origin
from tidefeed.plans.catalogue import feeds
from tidefeed.plans.catalogue.registry import query, table
from tidefeed.sinks import write_outputs
from tidefeed.storage import new_folder

# What the file of an event is called: some names hold two origins, one holds none.
FILE_NAMES = {
    "click": "hospital_oms.csv",
    "view": "oms_secretaria.txt",
    "purchase": "secretaria.db",
    "signup": "oms.txt",
    "error": "outro.csv",
}


def _with_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.coalesce(
        *[F.when(F.col("event_type") == kind, F.lit(n)) for kind, n in FILE_NAMES.items()]
    )
    return table(spark, sf_dir, "events").select("event_id", names.alias("arquivo"))


_FILES_SQL = """
select event_id, case event_type when 'click' then 'hospital_oms.csv'
  when 'view' then 'oms_secretaria.txt' when 'purchase' then 'secretaria.db'
  when 'signup' then 'oms.txt' when 'error' then 'outro.csv' end arquivo
from events
"""


@query(f"""
select event_id, arquivo, case when arquivo like '%hospital%' then 'hospital'
  when arquivo like '%oms%' then 'oms' else 'secretaria' end origem
from ({_FILES_SQL}) where arquivo <> 'outro.csv'
""")
def route_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_origin(_with_files(spark, sf_dir), F.col("arquivo")).accepted


@query(f"""
select event_id, arquivo, cast(null as varchar) origem, 'origem:unknown' motivo
from ({_FILES_SQL}) where arquivo = 'outro.csv'
""")
def route_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_origin(_with_files(spark, sf_dir), F.col("arquivo")).rejected


@query("""
select event_id, value, case event_type when 'click' then 'hospital' when 'view' then 'oms'
  when 'signup' then 'oms' when 'purchase' then 'secretaria' end origem
from events where event_type <> 'error'
""")
def route_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events land in outputs of these names, are routed by where each row lies, and are written by origin in one pass."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    base = new_folder(spark, "landed")
    drops = {name: events.where(F.col("event_type") == kind).drop("event_type") for kind, name in FILE_NAMES.items()}
    write_outputs(drops, f"{base}/in")
    landed = spark.read.schema("event_id long, value double").option("header", True).csv(f"{base}/in/*")
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    write_by_origin(by_origin(landed, folder).accepted, f"{base}/out")
    return spark.read.schema("event_id long, value double, origem string").parquet(f"{base}/out")


@query("""
select event_id, case event_type when 'click' then 'hospital' when 'view' then 'oms'
  when 'purchase' then 'secretaria' end origem
from events where event_type in ('click', 'view', 'purchase')
""")
def allow_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Origins in mixed case; those that are not on the list are left out."""
    sent = {"click": "HOSPITAL", "view": "Oms", "purchase": "secretaria", "signup": "OUTRO"}
    origin = F.coalesce(
        *[F.when(F.col("event_type") == kind, F.lit(name)) for kind, name in sent.items()]
    )
    events = table(spark, sf_dir, "events").select("event_id", origin.alias("origem"))
    return allow_list(events).accepted


def tagged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The feeds as tagged records, by feed."""
    return {
        name: feed(spark, sf_dir).select(
            F.lit(name.upper()).alias("origem"),
            F.lit(f"{name}_virtual").alias("nome_arquivo"),
            F.struct("*").alias(f"linha_{name}"),
        )
        for name, feed in (
            ("oms", feeds.oms),
            ("hospital", feeds.hospital),
            ("secretaria", feeds.secretaria),
        )
    }


def union_of(parts: dict[str, DataFrame]) -> DataFrame:
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), parts.values()
    )


@query(f"""
select 'oms' variante, count(*) linhas, cast(sum(num_obitos) as bigint) medida from ({feeds.OMS_SQL})
union all
select 'hospital', count(*), cast(sum(internado) as bigint) from ({feeds.HOSPITAL_SQL})
union all
select 'secretaria', count(*), cast(sum(vacinado) as bigint) from ({feeds.SECRETARIA_SQL})
""", name="split_union")
def split_union_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged records of all feeds, taken apart again: rows and a measure per variant."""
    parts = split_union(check_union(union_of(tagged(spark, sf_dir))).accepted)
    measures = {"oms": "num_obitos", "hospital": "internado", "secretaria": "vacinado"}
    totals = [
        parts[f"linha_{feed}"].agg(
            F.lit(feed).alias("variante"),
            F.count(F.lit(1)).alias("linhas"),
            F.sum(measure).alias("medida"),
        )
        for feed, measure in measures.items()
    ]
    return reduce(DataFrame.unionByName, totals)


@query(f"select id_hospital, data from ({feeds.HOSPITAL_SQL})")
def project_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listed_fields(feeds.hospital(spark, sf_dir), "hospital")
