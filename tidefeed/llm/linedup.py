"""Line dedup with levelled sorted runs of line hashes.

A run is a stored table sorted by line hash: for each line key the number of documents that hold it and
the largest ``doc_id`` among them. Documents come in batches. A batch's lines are aggregated to one row
per key and merge-joined with the runs: the anti-join gives its new keys, the rest are known ones. Both are
added as a run of level 0, which says which are new, so that the number of different lines is known at any
time without a merge. Once a level has ``fanout`` runs they are merged into one run of the next level, so ``n`` batches
leave about ``fanout * log(n)`` runs and each key is rewritten ``log(n)`` times. Lines are dropped where the text
lies: a text gets the list of its keys to drop, and no text moves. All of it is DataFrame work.

A key is the line without blanks at both ends and in lower case (A-Z), known by two 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.llm.sharing import checked, stored
from tidefeed.storage import materialize, new_folder

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Space, tab, line feed, vertical tab, form feed, carriage return.
_BLANKS = " \t\n\x0b\x0c\r"
KEY = ("h1", "h2")


def lines_of(text: Column) -> Column:
    """The lines of a text; NULL and '' are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(_BLANKS)), _UPPER, _UPPER.lower())


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key, F.length(key)).alias("h2")]


def _text_hash() -> Column:
    """Tells rows of one ``doc_id``, or without any, apart by their text."""
    return F.xxhash64(F.lit("text"), F.col("text"))


def keyed_lines(docs: DataFrame, min_chars: int, *more: Column) -> DataFrame:
    """``doc_id``, ``h1``, ``h2`` of each distinct long line of each row, and ``more``."""
    keys = F.array_distinct(
        F.filter(F.transform(lines_of(F.col("text")), line_key), lambda k: F.length(k) >= min_chars)
    )
    lines = docs.select("doc_id", *more, F.explode(keys).alias("key"))
    return lines.select(*lines.columns[:-1], *_hashes(F.col("key")))


class LineRuns:
    """Runs of line hashes by level. All runs are tables in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = 4):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []

    def all(self) -> DataFrame | None:
        """All runs as one table, in which a key may have several rows."""
        runs = [run for level in self.levels for run in level]
        out = runs[0] if runs else None
        for run in runs[1:]:
            out = out.unionAll(run)
        return out

    def fresh(self, batch: DataFrame) -> DataFrame:
        """The rows of ``batch`` whose key no run holds: a merge anti-join."""
        known = self.all()
        return batch if known is None else batch.join(known.select(*KEY).hint("merge"), [*KEY], "left_anti")

    def add(self, batch: DataFrame) -> None:
        """Add keys with ``n_docs`` and ``last_doc`` as a run, the new ones marked, and merge the levels that are full."""
        known, batch = self.all(), stored(batch, "line-batch")
        new = self.fresh(batch).withColumn("new", F.lit(True))
        if known is not None:
            old = batch.join(known.select(*KEY).hint("merge"), [*KEY], "left_semi")
            new = new.unionAll(old.withColumn("new", F.lit(False)))
        self._put(0, new)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            merged = full[0]
            for run in full[1:]:
                merged = merged.unionAll(run)
            self._put(level + 1, merged_keys(merged))
            level += 1

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(stored(run.sortWithinPartitions(*KEY), "line-run"))


    def n_keys(self) -> int:
        """How many different keys the runs hold."""
        runs = self.all()
        return 0 if runs is None else runs.where("new").count()


def merged_keys(runs: DataFrame) -> DataFrame:
    """One row per key; it is new if one of its rows is, so the mark adds up over runs as the counts do."""
    return runs.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"), F.max("new").alias("new"))


def build_runs(docs: DataFrame, min_chars: int = 40, batches: int = 4, fanout: int = 3) -> LineRuns:
    """Runs over all documents, in batches by ``doc_id``, so that a document is counted in one batch."""
    spark = docs.sparkSession
    folder = new_folder(spark, "lines")
    lines = keyed_lines(docs, min_chars).where(F.col("doc_id").isNotNull())
    lines.withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")).write.partitionBy(
        "batch"
    ).parquet(folder)
    schema = lines.withColumn("batch", F.lit(0)).schema
    lines = spark.read.schema(schema).parquet(folder)
    runs = LineRuns(spark, fanout)
    for number in range(batches):
        once = lines.where(F.col("batch") == number).groupBy(*KEY, "doc_id").agg(F.lit(1).alias("one"))
        runs.add(once.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc")))
    return runs


def hot_keys(runs: LineRuns, min_docs: int) -> DataFrame:
    return merged_keys(runs.all()).where(F.col("n_docs") >= min_docs).select(*KEY, "last_doc")


def dedup_lines(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 3
) -> DataFrame:
    """``docs`` with ``text`` rid of repeated lines, ``n_lines`` before and ``n_dropped``.

    A line whose key has ``min_chars`` code points or more and occurs in ``min_docs`` documents or more
    stays only in the document with the largest ``doc_id`` among them, there in all its places. Other
    lines stay. Rows: one for each row of ``docs``, other columns as they are (a column named like one of
    the counts is replaced). NULL and '' have one line, which stays; the text then is ''. Rows that
    repeat a ``doc_id`` count as one document. A row without ``doc_id`` isn't counted as a document and
    loses the lines that others lose. An empty table gives an empty one.
    """
    hot = checked(hot_keys(build_runs(docs, min_chars, batches, fanout), min_docs), "hot-lines", 40)
    doomed = (
        keyed_lines(docs, min_chars, _text_hash().alias("of_text"))
        .join(hot, [*KEY])
        .where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
        .groupBy(F.col("doc_id").alias("__of_doc"), F.col("of_text").alias("__of_text"))
        .agg(F.collect_set(F.struct("h1", "h2")).alias("__doomed"))
    )
    doomed = checked(doomed, "doomed-lines", F.lit(32) + 32 * F.size("__doomed"))
    lines = lines_of(F.col("text"))

    def stays(line: Column) -> Column:
        key = line_key(line)
        long = F.length(key) >= min_chars
        return ~(long & F.array_contains(F.col("__doomed"), F.struct(*_hashes(key))))

    own = F.col("doc_id").eqNullSafe(F.col("__of_doc")) & (_text_hash() == F.col("__of_text"))
    joined = docs.join(doomed, own, "left")
    kept = F.when(F.col("__doomed").isNull(), lines).otherwise(F.filter(lines, stays))
    return joined.withColumns(
        {"n_lines": F.size(lines).cast("long"), "__kept": kept}
    ).withColumns(
        {
            "n_dropped": F.col("n_lines") - F.size("__kept"),
            "text": F.array_join("__kept", "\n"),
        }
    ).drop("__of_doc", "__of_text", "__doomed", "__kept")


def count_fresh(docs: DataFrame, runs: LineRuns, min_chars: int = 40) -> int:
    """How many distinct line keys of ``docs`` no run holds yet, as a feed's next batch would add them."""
    return materialize(runs.fresh(keyed_lines(docs, min_chars).select(*KEY).distinct()), "fresh")[1]["rows"]
