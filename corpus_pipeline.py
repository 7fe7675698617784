"""A training corpus from raw documents: five stages, each written as Parquet and read by the next.

Toxic documents go; lines that many documents share go from all but one; of near copies one stays;
documents contaminated by the benchmark go; what is left is cut into pieces.

All stages: a NULL text is an empty one, which is neither toxic nor contaminated and copies nothing, so its row stays. Rows
that repeat a ``doc_id`` are judged each by its own text, but for the near copies, where they are one
document with all their texts. Rows without ``doc_id`` stay in the near-copy stage and count as no document among those that
share a line. Columns beside ``doc_id`` and ``text`` are carried on as they are. An empty table gives an empty one with the
same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.llm import decontam, jaccard, linedup, pieces, toxicity
from tidefeed.llm.sharing import checked, stored, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose severity model says that they aren't toxic."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, docs.columns).where(~F.col("toxic")).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that five or more share; ``n_chars``, if there is one, is that of the new text."""
    out = linedup.dedup_lines(docs, min_chars=40, min_docs=5)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    found = jaccard.similar_documents(docs)
    gone = checked(found.where("doc_id <> component_id").select("doc_id").distinct(), "near-copies", 16)
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated."""
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), docs.columns)
    return found.where(~F.col("contaminated")).select(*docs.columns)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document, with the ids of both."""
    keep = [c for c in docs.columns if c != "text"]
    return pieces.encode(docs, F.col("doc_id"), keep, k=2)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_copies_stage),
    ("benchmark decontamination", decontamination_stage),
    ("SentencePiece encoding", sentencepiece_stage),
]
#: SQL can express neither the model of the first stage nor the sampling of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
