"""What the operators share: reading tables, joins with a checked side, components of a graph."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.storage import materialize

#: A stored table of at most so many bytes (rows times the given width) may be broadcast.
BROADCAST_BYTES = 32 * 1024 * 1024


_shipped: set[str] = set()


def shipped(df: DataFrame) -> DataFrame:
    """``df``, after making sure that its tasks can import this package, once per application.

    Functions that run in tasks call others of the package, which executors need not have installed.
    """
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        file = Path(tempfile.mkdtemp(prefix=f"{package.name}-")) / f"{package.name}.zip"
        with zipfile.ZipFile(file, "w") as held:
            for source in sorted(package.rglob("*.py")):
                held.write(source, source.relative_to(package.parent))
        context.addPyFile(str(file))
        _shipped.add(context.applicationId)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder, which cuts its lineage."""
    return materialize(df, label)[0]


def checked(df: DataFrame, label: str, width: Column | int = 64) -> DataFrame:
    """Store ``df`` and mark it for broadcast if its measured size is small.

    ``width`` is the size of a row in bytes, a number or an expression. A larger table is left as it is,
    and Spark joins it by a shuffle; the result is the same.
    """
    size = F.sum(F.lit(width) if isinstance(width, int) else width)
    out, seen = materialize(df, label, size.alias("bytes"))
    return F.broadcast(out) if (seen["bytes"] or 0) <= BROADCAST_BYTES else out


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of plans that nobody holds any more.

    Spark removes them when the driver's JVM happens to collect its garbage, which an idle driver does
    twice an hour. Between large steps that is too late for the executors' disks.
    """
    gc.collect()
    spark._jvm.System.gc()


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Components of an undirected graph: rows ``node``, ``root``, the root the smallest node reachable.

    Alternating large-star and small-star steps: each node's neighbours are linked to the smallest of
    them, until no link changes. A hub meets its neighbours only in an aggregate with a partial step and
    in joins that adaptive execution can split. Each step is a stored table, so a lost executor costs no
    more than the step at hand. Loops and repeated edges are allowed; NULL ends are not.
    """
    links = stored(
        edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .where("u > v")
        .distinct(),
        "links",
    )
    state = None
    while True:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.greatest("v", "m").alias("u"), "m", F.col("u").alias("w"))
        step = (
            small.select(F.explode(F.array("u", "w")).alias("u"), F.col("m").alias("v"))
            .where("u > v")
            .distinct()
        )
        digest = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        links, seen = materialize(step, "links", digest.alias("digest"))
        now = (seen["rows"], seen["digest"])
        if now == state or not seen["rows"]:
            break
        state = now
    roots = links.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)


def ids(rows: Sequence[int] | None) -> str:
    """Ids as text, sorted as text, comma-joined; an absent id is the empty text."""
    return ",".join(sorted({"" if x is None else str(x) for x in rows or ()}))
