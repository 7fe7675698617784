"""Columns computed from whole texts in numpy, and bounded samples of labelled rows to learn from."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from tidefeed.functions import col
from tidefeed.llm.sharing import shipped, stored
from tidefeed.llm.text import groups, text_buffers

#: From the bytes of a group of texts and their offsets to one array per new column.
Compute = Callable[[np.ndarray, np.ndarray], Sequence[np.ndarray | list]]


def with_columns(docs: DataFrame, keep: Sequence[str], added: str, compute: Compute, text: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` and those of the DDL text ``added``, computed from ``text``.

    ``compute`` gets a bounded group of texts at a time. A kept column with the name of a new one is left
    out. NULL texts count as empty.
    """
    def run(kept: list[pa.Array], given: list[pa.Array]) -> Iterator[list[pa.Array]]:
        data, offsets = text_buffers(given[0])
        for a, b in groups(offsets):
            made = compute(data, offsets[a : b + 1])
            yield [c.slice(a, b - a) for c in kept] + [pa.array(x) for x in made]

    return mapped(docs, keep, [text], added, run)


#: From the kept columns of a batch and the given ones to batches of kept and new columns.
Run = Callable[[list[pa.Array], list[pa.Array]], Iterator[list[pa.Array]]]


def mapped(docs: DataFrame, keep: Sequence[str], given: Sequence[Column | str], added: str, run: Run) -> DataFrame:
    """The columns ``keep`` of ``docs`` but those that ``added`` names, and the latter, by ``run``.

    On the way the kept columns have plain names, so theirs may hold anything. A column that is given by
    name and kept too, as texts often are, is sent once.
    """
    new = _parse_datatype_string(added)
    keep = [c for c in dict.fromkeys(keep) if c not in new.fieldNames()]
    plain = [f"__kept{i}" for i in range(len(keep))]
    kept_at = [keep.index(c) if isinstance(c, str) and c in keep else None for c in given]
    others = [col(c) if isinstance(c, str) else c for c, i in zip(given, kept_at, strict=True) if i is None]
    place = iter(range(len(keep), len(keep) + len(others)))
    at = [next(place) if i is None else i for i in kept_at]
    rows = docs.select(
        *(col(c).alias(p) for c, p in zip(keep, plain, strict=True)),
        *(c.alias(f"__given{i}") for i, c in enumerate(others)),
    )
    schema = StructType(rows.schema.fields[: len(keep)] + new.fields)
    n, names = len(keep), schema.fieldNames()

    def batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for arrays in run(batch.columns[:n], [batch.column(i) for i in at]):
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return shipped(rows).mapInArrow(batched, schema).toDF(*keep, *new.fieldNames())


def crc_part(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; NULL counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """``doc_id``, ``text``, ``label`` of at most ``max_rows`` labelled documents, stored.

    Which rows is decided by a hash of the id, so by nothing in them. A document labelled more than once
    has its largest label; NULL labels and ids are left out.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most max_rows pairs
    return stored(texts, "sample")


def sorted_lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Position of each wanted value in the sorted ``keys``, -1 where it is not there."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values (rows) of each text, 0 for a text without words."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), np.float64), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]
