"""The weekly run, its report, and the streaming queries."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefeed.plans import weekly
from tidefeed.plans.catalogue import feeds
from tidefeed.plans.catalogue.registry import query, rounded, table
from tidefeed.plans.catalogue.routing import tagged, union_of
from tidefeed.schemas import FEEDS
from tidefeed.storage import materialize, new_folder, remove
from tidefeed.streaming import (
    accumulated,
    group_totals,
    last_round,
    pooled_stats,
    run_timed,
    start_rounds,
    totals_so_far,
)

# The totals of a run, as common table expressions. Valid hospital rows are those of a valid age; the
# other rules hold for every derived row.
_RUN_SQL = f"""
with oms as ({feeds.OMS_SQL}), hospital as ({feeds.HOSPITAL_SQL}),
secretaria as ({feeds.SECRETARIA_SQL}),
h as (select distinct * from hospital where idade between 0 and 120),
per_hospital as (
  select cast(id_hospital as varchar) id, cast(sum(internado) as double) t from h group by 1),
per_code as (
  select cast(cep as varchar) id, cast(sum(num_obitos) as double) t
  from (select distinct * from oms) group by 1),
per_island as (
  select cast(cep // 1000 as varchar) id, cast(sum(vacinado) as double) t
  from (select distinct * from secretaria) group by 1),
a as (select cast(cep // 1000 as varchar) id, cast(sum(internado) as double) t from h group by 1),
b as (select cast(cep as varchar) id, cast(sum(num_obitos) as double) t from oms group by 1),
c as (select cast(cep // 1000 as varchar) id, cast(sum(vacinado) as double) t
      from secretaria group by 1)
"""


_OUTPUTS_SQL = f"""
{_RUN_SQL}
select 'hospital' saida, id chave, t v1, cast(null as double) v2, cast(null as double) v3,
       cast(null as varchar) alerta from per_hospital
union all
select 'oms', id, t, null, null,
       case when t > (select avg(t) from per_code) then 'Vermelho' else 'Verde' end from per_code
union all select 'secretaria', id, t, null, null, null from per_island
union all
select 'merge_AB', a.id, a.t, coalesce(b.t, 0), null, null from a left join b on a.id = b.id
union all
select 'merge_AC', a.id, a.t, coalesce(c.t, 0), null, null from a left join c on a.id = c.id
union all
select 'merge_BC', b.id, b.t, coalesce(c.t, 0), null, null from b left join c on b.id = c.id
union all
select 'merge_ABC', a.id, a.t, coalesce(b.t, 0), coalesce(c.t, 0), null
from a left join b on a.id = b.id left join c on a.id = c.id
"""


@query(_OUTPUTS_SQL)
def weekly_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven outputs of a run over the three feeds, under common column names."""
    outputs = weekly.run(
        feeds.oms(spark, sf_dir), feeds.secretaria(spark, sf_dir), feeds.hospital(spark, sf_dir)
    )
    return reduce(
        DataFrame.unionByName, [_common(name, table) for name, table in outputs.items()]
    )


def _common(name: str, output: DataFrame) -> DataFrame:
    key, *others = output.columns
    values = [c for c in others if c != "Alertas"]
    v: list[Column] = [F.col(c) for c in values] + [F.lit(None).cast("double")] * 3
    alert = F.col("Alertas") if "Alertas" in others else F.lit(None).cast("string")
    return output.select(
        F.lit(name).alias("saida"),
        F.col(key).alias("chave"),
        v[0].alias("v1"),
        v[1].alias("v2"),
        v[2].alias("v3"),
        alert.alias("alerta"),
    )


@query(f"""
{_RUN_SQL},
alerts as (select id, t > (select avg(t) from per_code) red from per_code)
select 'alertas' analise, id chave, case when red then 'Vermelho' else 'Verde' end texto,
       cast(null as double) v1, cast(null as double) v2, cast(null as double) v3 from alerts
union all
select 'estatisticas', null, null, cast(count(*) as double), round(avg(t), 6),
       round(stddev_pop(t), 6) from per_hospital
union all
select 'estatisticas_por_hospital', id, null, round(avg(t), 6), round(stddev_pop(t), 6), null
from per_hospital group by id
union all
select 'correlacao', null, null, round(corr(b.t, coalesce(c.t, 0)), 6), null, null
from b left join c on b.id = c.id
union all
select 'regressao', null, null, round(regr_intercept(a.t, coalesce(c.t, 0)), 6),
       round(regr_slope(a.t, coalesce(c.t, 0)), 6), null
from a left join c on a.id = c.id
""")
def weekly_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five analyses of a run whose outputs were saved and loaded again, under common names.

    The saved outputs are removed once the analyses are stored.
    """
    base = new_folder(spark, "weekly-saved")
    try:
        weekly.run(
            feeds.oms(spark, sf_dir),
            feeds.secretaria(spark, sf_dir),
            feeds.hospital(spark, sf_dir),
            base,
        )
        parts = weekly.report(weekly.load_outputs(spark, base))
        found = reduce(DataFrame.unionByName, [_analysis(name, part) for name, part in parts.items()])
        return materialize(found, "report")[0]
    finally:
        remove(spark, base)


def _analysis(name: str, part: DataFrame) -> DataFrame:
    texts = {"alertas": ("cep", "Alertas"), "estatisticas_por_hospital": ("id_hospital", None)}
    key, text = texts.get(name, (None, None))
    values = [rounded(c, 6).cast("double") for c in part.columns if c not in (key, text)]
    v = values + [F.lit(None).cast("double")] * (3 - len(values))
    return part.select(
        F.lit(name).alias("analise"),
        (F.col(key) if key else F.lit(None)).cast("string").alias("chave"),
        (F.col(text) if text else F.lit(None)).cast("string").alias("texto"),
        *[c.alias(f"v{i}") for i, c in enumerate(v, 1)],
    )


@query("""
select cast(user_id as varchar) user_id, round(sum(value), 2) "Total_value" from events group by 1
""")
def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream, worked off once: the totals equal those of the table."""
    base = new_folder(spark, "totals")
    layout = table(spark, sf_dir, "events").schema
    # A pattern, as a stream takes a folder or a pattern but not the path of one file.
    stream = spark.readStream.schema(layout).parquet(f"{sf_dir}/events.parquet*")
    group_totals(stream, "user_id", "value", base).awaitTermination()
    totals = totals_so_far(spark, "user_id", "value", base)
    return totals.withColumn("Total_value", rounded("Total_value"))


#: The most records in one landed file: a compressed file is read by one task.
RECORDS_PER_FILE = 500_000


def land(records: DataFrame, landing: str) -> None:
    """Add a drop of tagged records to a landing folder, as compressed JSON lines.

    As plain text a record takes about ten times its size in a table, mostly for the names of its fields.
    """
    options = {"compression": "lz4", "maxRecordsPerFile": RECORDS_PER_FILE}
    records.write.mode("append").options(**options).json(landing)


@query(_OUTPUTS_SQL)
def stream_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds land and nothing runs; the third lands and one round runs over all of them.

    Zeros are left out of the records that land, as the senders' format does. All outputs of the round.
    """
    landing, base = new_folder(spark, "landing"), new_folder(spark, "rounds")
    drops = {feed: _without_zeros(drop, feed) for feed, drop in tagged(spark, sf_dir).items()}
    for feed in ("oms", "hospital"):
        land(drops[feed], landing)
    start_rounds(spark, landing, base).awaitTermination()
    if last_round(spark, base) is not None:
        raise AssertionError("a round ran before all feeds were there")
    land(drops["secretaria"], landing)
    start_rounds(spark, landing, base).awaitTermination()
    number = last_round(spark, base)
    outputs = weekly.load_outputs(spark, f"{base}/rounds/round={number}")
    return reduce(DataFrame.unionByName, [_common(name, part) for name, part in outputs.items()])


@query(f"""
with oms as ({feeds.OMS_SQL}), hospital as ({feeds.HOSPITAL_SQL}), secretaria as ({feeds.SECRETARIA_SQL})
select 1 rodada, 'oms' feed, count(*) registros, cast(sum(num_obitos) as bigint) total from oms
union all select 1, 'hospital', count(*), cast(sum(internado) as bigint) from hospital
union all select 1, 'secretaria', count(*), cast(sum(vacinado) as bigint) from secretaria
union all select 2, 'oms', count(*), cast(sum(num_obitos) as bigint) from oms
union all select 2, 'hospital', count(*), cast(sum(internado) as bigint) from hospital
union all select 2, 'secretaria', count(*), cast(sum(vacinado) as bigint) from secretaria
""")
def stream_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run in an interval takes up a drop, is stopped after its round, and started again over a second drop."""
    landing, base = new_folder(spark, "timed-landing"), new_folder(spark, "timed")
    measures = {"oms": "num_obitos", "hospital": "internado", "secretaria": "vacinado"}

    def totals(drops: Mapping[str, DataFrame], folder: str, number: int) -> None:
        parts = [
            drop.agg(F.count("*").alias("registros"), F.sum(measures[feed]).cast("long").alias("total")).withColumn("feed", F.lit(feed))
            for feed, drop in drops.items()
        ]
        reduce(DataFrame.unionByName, parts).coalesce(1).write.mode("overwrite").parquet(f"{folder}/totais")

    numbers = []
    for _ in range(2):
        land(union_of(tagged(spark, sf_dir)), landing)
        numbers.append(run_timed(spark, landing, base, totals, every="200 milliseconds", rounds=1))
    layout = "registros long, total long, feed string"
    rounds = [spark.read.schema(layout).parquet(f"{base}/rounds/round={n}/totais").withColumn("rodada", F.lit(i)) for i, n in enumerate(numbers, 1)]
    return reduce(DataFrame.unionByName, rounds).select("rodada", "feed", "registros", "total")


def _without_zeros(drop: DataFrame, feed: str) -> DataFrame:
    variant = F.col(f"linha_{feed}")
    fields = [
        (F.nullif(variant[f.name], F.lit(0)) if isinstance(f.dataType, T.NumericType) else variant[f.name]).alias(f.name)
        for f in FEEDS[feed]
    ]
    return drop.withColumn(f"linha_{feed}", F.struct(*fields))


@query("""
select key, count(*) registros, round(avg(v), 6) media, round(stddev_pop(v), 6) desvio
from (select l_suppkey key, l_quantity v from lineitem
      union all select l_suppkey, l_extendedprice from lineitem)
group by key
""")
def stream_accumulate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs' partial results per key, pooled on reading."""
    base = new_folder(spark, "partials")
    items = table(spark, sf_dir, "lineitem")
    for number, measure in enumerate(["l_quantity", "l_extendedprice"]):
        accumulated(items, "l_suppkey", measure, number, base)
    pooled = pooled_stats(spark, base, by_key=True)
    return pooled.select("key", "registros", rounded("media", 6), rounded("desvio", 6))
