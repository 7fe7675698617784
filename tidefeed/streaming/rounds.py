"""Rounds over landed drops: a run starts once all three feeds have sent rows.

Everything a round needs is on shared storage below one base folder:

    staging/batch_id=K/destino=F/   the records of micro-batch K, by feed, and those set aside
    batches/batch_id=K/             the number of records per feed since the last round, up to K
    rounds/round=K/<output>/        what the round that micro-batch K completed has written
    rounds_done/round=K/            the record that this round is complete, written last

A replayed micro-batch has the number it had before. It replaces its own folders and runs its round
again only if that round was not recorded, so a restart neither loses nor repeats records. What a
recorded round has used up is removed, and each batch reads one folder of counts, so neither grows
with the batches.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidefeed.functions import fold_case
from tidefeed.operators.routing import filled_numbers, union_fault
from tidefeed.plans import weekly
from tidefeed.schemas import FEEDS, TAGGED_UNION
from tidefeed.sinks import write_outputs
from tidefeed.storage import exists, remove
from tidefeed.streaming.accumulate import accumulated

REFUSED = "recusado"

_CORRUPT = "_corrupt_record"

#: What is read of a drop: the tagged record, and its text where it is not one.
DROP = T.StructType([*TAGGED_UNION, T.StructField(_CORRUPT, T.StringType())])

_DONE = T.StructType([T.StructField("round", T.LongType()), T.StructField("batch", T.LongType())])
_COUNTS = T.StructType(
    [T.StructField("feed", T.StringType()), T.StructField("rows", T.LongType())]
)

#: Takes the round's feeds, the folder for its outputs and its number.
RoundJob = Callable[[Mapping[str, DataFrame], str, int], object]


def weekly_round(feeds: Mapping[str, DataFrame], folder: str, number: int) -> dict[str, DataFrame]:
    """The weekly run of a round, with the five analyses beside its outputs in ``relatorio``."""
    outputs = weekly.run(feeds["oms"], feeds["secretaria"], feeds["hospital"], folder)
    write_outputs(weekly.report(outputs), f"{folder}/relatorio")
    return outputs


def accumulating_round(base: str) -> RoundJob:
    """As ``weekly_round``, and the hospital totals build up over the rounds below ``base``.

    ``pooled_stats`` reads them.
    """

    def job(feeds: Mapping[str, DataFrame], folder: str, number: int) -> None:
        totals = weekly_round(feeds, folder, number)["hospital"]
        measure = f"Total_{weekly.HOSPITAL_MEASURE}"
        accumulated(totals, weekly.HOSPITAL_KEY, measure, number, base)

    return job


def start_rounds(
    spark: SparkSession,
    landing: str,
    base: str,
    job: RoundJob = weekly_round,
    *,
    every: str | None = None,
    files_per_batch: int | None = None,
    file_format: str = "json",
    recorded: Callable[[int], object] | None = None,
) -> StreamingQuery:
    """Follow a landing folder of tagged records and run ``job`` for each complete set of feeds.

    With ``every`` (say ``"10 minutes"``) the folder is looked at in that interval until the query is
    stopped; a look that finds nothing runs nothing. Without it the files that are there are worked off
    and the query ends. ``recorded`` is called with the number of each round once it is recorded.
    """
    base = base.rstrip("/")
    drops = spark.readStream.schema(DROP).format(file_format)
    if files_per_batch:
        drops = drops.option("maxFilesPerTrigger", files_per_batch)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        drops.load(landing)
        .writeStream.foreachBatch(lambda batch, number: _take(batch, number, base, job, recorded))
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(**trigger)
        .start()
    )


def run_timed(
    spark: SparkSession, landing: str, base: str, job: RoundJob = weekly_round, *, every: str, rounds: int, wait: float = 600, **reading
) -> int:
    """Look at the landing folder in an interval until ``rounds`` more rounds are recorded, then stop the query.

    Gives the number of the last round. The query is stopped between two looks, so no round is cut off. An
    error of the query is raised, and so is it when the rounds have not come after ``wait`` seconds.
    """
    base = base.rstrip("/")
    recorded = threading.Semaphore(0)
    query = start_rounds(spark, landing, base, job, every=every, recorded=lambda number: recorded.release(), **reading)
    try:
        until = time.monotonic() + wait
        for _ in range(rounds):
            while not recorded.acquire(timeout=0.2):
                if not query.isActive:
                    query.awaitTermination()  # raises what ended it
                    raise RuntimeError("the query was stopped by someone else")
                if time.monotonic() > until:
                    raise TimeoutError(f"fewer than {rounds} rounds in {wait} seconds")
        while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
            time.sleep(0.05)
    finally:
        query.stop()
    return last_round(spark, base)


def _take(batch: DataFrame, number: int, base: str, job: RoundJob, recorded: Callable[[int], object] | None = None) -> None:
    spark = batch.sparkSession
    previous = last_round(spark, base)
    if previous is not None and previous >= number:
        return
    first = 0 if previous is None else previous + 1
    counts = _stage(batch, number, first, base)
    if not all(counts.values()):
        return
    job(_feeds(spark, first, number, base), f"{base}/rounds/round={number}", number)
    done = spark.createDataFrame([(number, number)], _DONE).select("batch")
    done.write.mode("overwrite").parquet(f"{base}/rounds_done/round={number}")
    for k in range(first, number + 1):
        for feed in FEEDS:  # refused records stay
            remove(spark, f"{base}/staging/batch_id={k}/destino={feed}")
        remove(spark, f"{base}/batches/batch_id={k}")
    if recorded:
        recorded(number)


def _stage(batch: DataFrame, number: int, first: int, base: str) -> dict[str, int]:
    """Store a batch by feed in one pass, with the refused records beside it, and count on the way.

    Gives the records per feed since batch ``first``. Numbers that a record leaves out are 0.
    """
    spark = batch.sparkSession
    unread = F.when(F.col(_CORRUPT).isNotNull(), F.lit("json"))
    fault = F.coalesce(unread, union_fault())
    checked = batch.withColumn("origem", fold_case(F.col("origem"))).withColumn("motivo", fault)
    checked = filled_numbers(checked)
    destination = F.when(F.col("motivo").isNull(), F.col("origem")).otherwise(F.lit(REFUSED))
    seen = Observation(f"batch-{number}")
    counted = [F.count_if(F.col("destino") == feed).alias(feed) for feed in FEEDS]
    staged = checked.withColumn("destino", destination).observe(seen, *counted)
    staged.write.mode("overwrite").partitionBy("destino").parquet(
        f"{base}/staging/batch_id={number}"
    )
    before = {}
    if number > first:
        earlier = spark.read.schema(_COUNTS).parquet(f"{base}/batches/batch_id={number - 1}")
        before = {row.feed: row.rows for row in earlier.collect()}
    total = {feed: before.get(feed, 0) + seen.get[feed] for feed in FEEDS}
    counts = spark.createDataFrame(list(total.items()), _COUNTS).coalesce(1)
    counts.write.mode("overwrite").parquet(f"{base}/batches/batch_id={number}")
    return total


def _feeds(spark: SparkSession, first: int, last: int, base: str) -> dict[str, DataFrame]:
    added = [T.StructField(name, T.StringType()) for name in ("motivo", "destino")]
    layout = T.StructType([*TAGGED_UNION, *added, T.StructField("batch_id", T.LongType())])
    rows = spark.read.schema(layout).parquet(f"{base}/staging")
    rows = rows.where(F.col("batch_id").between(first, last))
    return {
        feed: rows.where(F.col("destino") == feed).select(f"linha_{feed}.*") for feed in FEEDS
    }


def last_round(spark: SparkSession, base: str) -> int | None:
    """The number of the last complete round, which is that of the batch that completed it."""
    if not exists(spark, f"{base}/rounds_done"):
        return None
    done = spark.read.schema(_DONE).parquet(f"{base}/rounds_done")
    return done.agg(F.max("round")).first()[0]


def round_output(
    spark: SparkSession, base: str, number: int, name: str, schema: T.StructType
) -> DataFrame:
    """One output of a round, as a table."""
    path = f"{base.rstrip('/')}/rounds/round={number}/{name}"
    return spark.read.schema(schema).option("header", True).csv(path)
