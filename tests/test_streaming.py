import time
from pathlib import Path

import pytest
from conftest import values
from pyspark.sql import functions as F

from tidefeed.operators import group_sum, stats, stats_by
from tidefeed.plans.catalogue import rounds as round_queries
from tidefeed.schemas import FEEDS
from tidefeed.storage import shared_root
from tidefeed.streaming import (
    accumulated,
    accumulating_round,
    group_totals,
    last_round,
    pooled_stats,
    start_rounds,
    totals_so_far,
)
from tidefeed.streaming import rounds as rounds_module

DAY = "01-02-2024"
ROWS = {
    "oms": [(10 * i, 1000, 10 + i, i, i, DAY) for i in range(1, 6)],
    "hospital": [(1, DAY, 1, 20 + i, 0, 11001, 0, 1, 0, 1) for i in range(6)],
    "secretaria": [(1, 1, 11002, 3, 1000 + i, DAY) for i in range(7)],
}


@pytest.fixture
def drop(spark, tmp_path):
    def land(feed, origin=None, rows=None):
        records = spark.createDataFrame(rows or ROWS[feed], FEEDS[feed])
        records.coalesce(1).select(
            F.lit(origin or feed).alias("origem"),
            F.lit("f").alias("nome_arquivo"),
            F.struct("*").alias(f"linha_{feed}"),
        ).write.mode("append").json(f"{tmp_path}/landing")

    return land


@pytest.fixture
def follow(spark, tmp_path):
    """Work off what has landed, noting the rows per feed of every round."""
    seen = []

    def job(feeds, folder, number):
        seen.append((Path(folder).name, {f: df.count() for f, df in feeds.items()}))

    def run(**options):
        query = start_rounds(spark, f"{tmp_path}/landing", f"{tmp_path}/base", job, **options)
        query.awaitTermination()
        return seen

    return run


def test_a_round_waits_for_all_feeds_and_then_starts_anew(spark, tmp_path, drop, follow):
    drop("oms")
    drop("hospital", origin="HOSPITAL")
    assert follow() == []
    assert last_round(spark, f"{tmp_path}/base") is None
    drop("oms", rows=ROWS["oms"][:2])
    drop("secretaria")
    assert follow() == [("round=1", {"oms": 7, "hospital": 6, "secretaria": 7})]
    assert last_round(spark, f"{tmp_path}/base") == 1
    drop("oms")
    drop("hospital")
    assert len(follow()) == 1
    drop("secretaria", rows=ROWS["secretaria"][:1])
    assert follow()[1] == ("round=3", {"oms": 5, "hospital": 6, "secretaria": 1})


def test_refused_records_do_not_complete_a_round(spark, tmp_path, drop, follow):
    drop("oms")
    drop("hospital")
    drop("oms", origin="secretaria")
    drop("secretaria", origin="clinica")
    assert follow() == []
    staged = spark.read.parquet(f"{tmp_path}/base/staging")
    reasons = staged.where(F.col("destino") == "recusado").groupBy("motivo").count()
    assert values(reasons) == [("linha:mismatch", 5), ("origem:refused", 7)]


def test_records_that_cannot_be_read_are_set_aside_with_their_text(spark, tmp_path, drop, follow):
    for feed in FEEDS:
        drop(feed)
    good = '{"num_obitos":1,"populacao":1,"cep":11,"num_recuperados":1,"num_vacinados":1}'
    lines = [
        '{"origem":"oms","linha_oms":' + good.replace(":11", ':"x"') + "}",
        '{"origem":"oms","linha_oms":' + good.replace('"cep":11,', "") + "}",
        '{"origem":"oms","linha_oms":',
        '{"origem":"oms","linha_oms":' + good + "}",
    ]
    (tmp_path / "landing" / "part-x.json").write_text("\n".join(lines) + "\n")
    assert follow()[0][1]["oms"] == len(ROWS["oms"]) + 2  # the code left out is 0
    refused = spark.read.parquet(f"{tmp_path}/base/staging").where("destino = 'recusado'")
    assert values(refused.select("motivo", "_corrupt_record")) == [
        ("json", lines[2]),
        ("json", lines[0]),
    ]


def test_a_replayed_batch_changes_nothing(spark, tmp_path, drop):
    for feed in FEEDS:
        drop(feed)
    base, seen = f"{tmp_path}/base", []

    def job(feeds, folder, number):
        seen.append({f: df.count() for f, df in feeds.items()})

    batch = spark.read.schema(rounds_module.DROP).json(f"{tmp_path}/landing")
    rounds_module._take(batch, 0, base, job)
    rounds_module._take(batch, 0, base, job)
    assert len(seen) == 1


def test_a_round_that_failed_is_run_again(spark, tmp_path, drop):
    for feed in FEEDS:
        drop(feed)
    base, seen = f"{tmp_path}/base", []
    batch = spark.read.schema(rounds_module.DROP).json(f"{tmp_path}/landing")

    def failing(feeds, folder, number):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        rounds_module._take(batch, 0, base, failing)
    assert last_round(spark, base) is None
    rounds_module._take(batch, 0, base, lambda feeds, *_: seen.append(feeds["oms"].count()))
    assert seen == [5]
    assert last_round(spark, base) == 0


def test_drops_land_compressed_in_bounded_files(spark, tmp_path, rows, monkeypatch):
    """The landed records take a fraction of their plain text, and no file holds more than the most records."""
    monkeypatch.setattr(round_queries, "RECORDS_PER_FILE", 3000)
    records = spark.range(10_000).coalesce(1).select(
        F.lit("OMS").alias("origem"),
        F.lit("f").alias("nome_arquivo"),
        F.struct(*[(F.col("id") % (i + 7)).cast("int").alias(f.name) if f.name != "data" else F.lit(DAY).alias("data") for i, f in enumerate(FEEDS["oms"])]).alias("linha_oms"),
    )
    round_queries.land(records, f"{tmp_path}/landing")
    records.write.json(f"{tmp_path}/plain")
    size = {d: sum(p.stat().st_size for p in (tmp_path / d).glob("part-*")) for d in ("landing", "plain")}
    assert size["landing"] < size["plain"] / 4
    landed = spark.read.schema(rounds_module.DROP).json(f"{tmp_path}/landing")
    assert landed.groupBy(F.input_file_name()).count().agg(F.max("count"), F.count("*")).first()[:] == (3000, 4)
    assert values(landed.select("origem", "linha_oms")) == values(records.select("origem", "linha_oms"))


def test_rounds_write_the_weekly_outputs(spark, tmp_path, drop):
    for feed in FEEDS:
        drop(feed)
    base = f"{tmp_path}/base"
    job = accumulating_round(f"{base}/acumulado")
    start_rounds(spark, f"{tmp_path}/landing", base, job).awaitTermination()
    written = spark.read.option("header", True).csv(f"{base}/rounds/round=0/oms")
    assert sorted(r.cep for r in written.collect()) == ["11", "12", "13", "14", "15"]
    names = {p.name for p in Path(f"{base}/rounds/round=0").iterdir() if p.is_dir()}
    assert {"hospital", "oms", "secretaria", "merge_ABC"} <= names
    report = spark.read.option("header", True).csv(f"{base}/rounds/round=0/relatorio/alertas")
    assert values(report)[0] == ("Verde", "11") and report.count() == 5
    assert not [p for p in Path(shared_root(spark)).iterdir() if p.name.startswith("weekly-")]
    assert not list(Path(f"{base}/staging").rglob("part-*"))
    assert not list(Path(f"{base}/batches").rglob("part-*"))
    for feed in FEEDS:
        drop(feed)
    start_rounds(spark, f"{tmp_path}/landing", base, job).awaitTermination()
    assert tuple(pooled_stats(spark, f"{base}/acumulado").first()) == (2, 6.0, 0.0)


def test_timed_rounds_until_stopped(spark, tmp_path, drop):
    seen = []
    for feed in FEEDS:
        drop(feed)
    query = start_rounds(
        spark,
        f"{tmp_path}/landing",
        f"{tmp_path}/base",
        lambda feeds, folder, number: seen.append(folder),
        every="1 second",
    )
    deadline = time.time() + 60
    while not seen and time.time() < deadline:
        time.sleep(0.2)
    time.sleep(2.5)  # further looks find no files and run nothing
    query.stop()
    assert not query.isActive and len(seen) == 1


def test_stream_totals_equal_those_of_the_table(spark, tmp_path):
    for part in range(4):
        values_ = [(i % 3, float(i * part)) for i in range(20)]
        df = spark.createDataFrame(values_, "k int, v double").coalesce(1)
        df.write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k int, v double").option("maxFilesPerTrigger", 1)
    base = f"{tmp_path}/base"
    group_totals(stream.parquet(f"{tmp_path}/in"), "k", "v", base).awaitTermination()
    assert len(list(Path(f"{base}/totals").glob("batch_id=*"))) == 4
    table = spark.read.parquet(f"{tmp_path}/in")
    assert values(totals_so_far(spark, "k", "v", base)) == values(group_sum(table, "k", "v"))


def test_accumulated_statistics(spark, rows, tmp_path):
    first = rows("id string, v double", *[(str(i % 3), 1e6 + i) for i in range(30)], ("x", 5.0))
    second = rows("id string, v double", *[(str(i % 2), 7.0 * i) for i in range(11)], ("1", None))
    base = str(tmp_path)
    accumulated(first, "id", "v", 0, base)
    accumulated(second, "id", "v", 1, base)
    accumulated(second, "id", "v", 1, base)  # a repeated run replaces its part
    both = first.where("id <> 'x'").unionByName(second)
    pooled, direct = pooled_stats(spark, base).first(), stats(both, "v").first()
    assert tuple(pooled) == pytest.approx(tuple(direct), rel=1e-12)
    per_key = pooled_stats(spark, base, by_key=True).orderBy("key").collect()
    expected = stats_by(both, "id", "v").collect()
    assert [(r.key, r.media) for r in per_key] == [(r.id, pytest.approx(r.media)) for r in expected]
    assert [r.desvio for r in per_key] == pytest.approx([r.desvio for r in expected])
