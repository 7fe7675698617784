"""Duplicate rows, sparse columns and sparse rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.functions import null_like
from tidefeed.operators import (
    clean,
    drop_duplicate_rows,
    drop_sparse_columns,
    drop_sparse_rows,
)
from tidefeed.plans.catalogue.registry import query, table


@query("select distinct * from (select * from events union all select * from events)")
def dedupe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return drop_duplicate_rows(events.unionByName(events))


@query("select distinct user_id, event_type from events")
def dedupe_hot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few distinct rows, each with very many copies."""
    return drop_duplicate_rows(table(spark, sf_dir, "events").select("user_id", "event_type"))


@query("select doc_id, quality from labels")
def sparse_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most documents are not toxic, so at this threshold the zeros of that column count as missing."""
    return drop_sparse_columns(table(spark, sf_dir, "labels"), 0.8)


@query("select * from labels where doc_id <> 0 and quality <> 0 and toxic <> 0")
def sparse_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_sparse_rows(table(spark, sf_dir, "labels"), 0.5)


@query("select distinct doc_id, quality from labels")
def clean_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return clean(labels.unionByName(labels), 0.8)


@query("""
select count(*) linhas, count(*) filter (where doc_id = 0) doc_id,
       count(*) filter (where quality = 0) quality, count(*) filter (where toxic = 0) toxic
from labels
""")
def null_like_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    counts = [F.count_if(null_like(labels, name)).alias(name) for name in labels.columns]
    return labels.agg(F.count(F.lit(1)).alias("linhas"), *counts)
