"""Language ID with word-first backoff.

A word seen while learning is scored by its log frequency in each language. A word not seen falls back to
its longest character n-grams that were seen, from five characters down to one, and is scored by the mean
of their log frequencies. A text's scores are the sums over its words.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidefeed.functions import col
from tidefeed.llm import text as T
from tidefeed.llm.columns import sorted_lookup, with_columns
from tidefeed.llm.sharing import stored

GRAMS = (5, 4, 3, 2, 1)


class LanguageModel(NamedTuple):
    """For words and for each n-gram length (longest first): sorted hashes and log frequencies by language."""

    langs: list[str]
    word_keys: np.ndarray
    word_logs: np.ndarray
    gram_keys: list[np.ndarray]
    gram_logs: list[np.ndarray]


def _gram_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the n-grams of ``size`` characters within the words, and the word of each."""
    heads = (data & 0xC0) != 0x80  # the first byte of each character
    inside = np.zeros(len(data) + 1, np.int8)
    inside[start] += 1
    inside[end] -= 1
    at = np.flatnonzero(heads & (np.cumsum(inside[:-1]) > 0))
    word = np.searchsorted(start, at, "right") - 1
    bounds = np.concatenate([at, [len(data)]])
    n = len(at) - size + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    ok = word[:n] == word[size - 1 :]
    stop = np.minimum(bounds[size:], end[word[size - 1 :]])
    return at[:n][ok], stop[ok], word[:n][ok]


def _salted(hashes: np.ndarray, size: int) -> np.ndarray:
    """Words (size 0) and n-grams of each length have hashes of their own."""
    return T.mix(hashes + T.salt(size)) if size else hashes


def _counts(data: np.ndarray, offsets: np.ndarray) -> list[list]:
    """For each text its distinct words and n-grams, with counts, as parallel lists."""
    w = T.words(data, offsets, T.LETTERS)
    word_text = w.text_of()
    kinds, keys, texts = [np.zeros(len(w.hash), np.int8)], [w.hash], [word_text]
    for size in GRAMS:
        start, end, word = _gram_spans(w.data, w.start, w.end, size)
        keys.append(_salted(T.span_hash(w.data, start, end), size))
        kinds.append(np.full(len(start), size, np.int8))
        texts.append(word_text[word])
    kind, key, of = np.concatenate(kinds), np.concatenate(keys), np.concatenate(texts)
    order = np.lexsort((key, kind, of))
    kind, key, of = kind[order], key[order], of[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (kind[1:] != kind[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.concatenate([at, [len(key)]]))
    cut = np.searchsorted(of[at], np.arange(1, len(offsets) - 1))
    rows = [np.split(x, cut) for x in (kind[at].astype(np.int32), key[at].view(np.int64), count.astype(np.int32))]
    return rows


def learn(
    docs: DataFrame, max_rows: int = 8000, min_count: int = 2, max_entries: int = 400_000, max_cells: int = 1_600_000
) -> LanguageModel | None:
    """Fit to at most ``max_rows`` rows of ``docs`` (``doc_id``, ``text``, ``lang``), None without any. NULL languages are
    left out, NULL texts empty.

    Rows are chosen in the order of a hash of the id within each language: all languages have their first row, then all
    their second, and so on, so languages have equal shares as far as they have rows. Words and n-grams that occur
    less than ``min_count`` times are left out, and of each kind all but the ``max_entries`` most frequent, or fewer where the
    model would have more than ``max_cells`` numbers, one for each entry and language.
    """
    known = docs.where(F.col("lang").isNotNull())  # texts are read for the chosen rows only
    turns = known.select("doc_id", "lang", F.pmod(F.xxhash64(F.lit("salt"), "doc_id"), F.lit(64)).alias("salt"))
    for by in (["lang", "salt"], ["lang"]):  # a language of most rows is brought down in parts first
        place = F.row_number().over(Window.partitionBy(*by).orderBy(F.xxhash64("doc_id"), "doc_id"))
        turns = turns.withColumn("turn", place).where(F.col("turn") <= max_rows)
    chosen = turns.orderBy("turn", F.xxhash64("doc_id", "lang"), "doc_id", "lang").limit(max_rows).select("doc_id", "lang")
    chosen = F.broadcast(stored(chosen, "chosen").distinct())  # at most max_rows rows
    sample = stored(known.select("doc_id", "lang", F.lower("text").alias("text")).join(chosen, ["doc_id", "lang"]), "sample")
    langs = sorted(r[0] for r in sample.select("lang").distinct().collect())
    if not langs:
        return None
    counted = with_columns(sample, ["lang"], "kind array<int>, key array<bigint>, n array<int>", _counts)
    by_lang = (
        counted.select("lang", F.explode(F.arrays_zip("kind", "key", "n")).alias("e"))
        .groupBy(F.col("e.kind").alias("kind"), F.col("e.key").alias("key"), "lang")
        .agg(F.sum("e.n").alias("n"))
    )
    totals = by_lang.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by_lang"))
    totals = stored(totals.where(F.col("n") >= min_count), "totals")
    most = max(1, min(max_entries, max_cells // len(langs)))
    keys, logs = [], []
    for kind in (0, *GRAMS):
        found = totals.where(F.col("kind") == kind).orderBy(F.desc("n"), "key").limit(most)
        numbers = F.transform(F.lit(langs), lambda lang: F.coalesce(F.try_element_at("by_lang", lang), F.lit(0)).cast("int"))
        table = found.select("key", numbers.alias("n")).toArrow()
        key = table.column("key").to_numpy().view(np.uint64)
        n = table.column("n").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(len(key), len(langs))
        order = np.argsort(key)
        total = n.sum(axis=0) + 0.1 * (len(key) + 1)
        keys.append(key[order])
        logs.append(np.log((n[order] + 0.1) / total).astype(np.float32))
    return LanguageModel(langs, keys[0], logs[0], keys[1:], logs[1:])


def _scores(data: np.ndarray, offsets: np.ndarray, m: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Log scores by text and language, and the number of scored words."""
    w = T.words(data, offsets, T.LETTERS)
    score = np.zeros((len(w.hash), len(m.langs)), np.float32)
    at = sorted_lookup(m.word_keys, w.hash)
    score[at >= 0] = m.word_logs[at[at >= 0]]
    _, one, back = np.unique(w.hash[at < 0], return_index=True, return_inverse=True)
    unseen = np.sort(np.flatnonzero(at < 0)[one])  # one of each unseen word
    rank = np.argsort(np.argsort(np.flatnonzero(at < 0)[one]))
    found, left = np.zeros((len(unseen), len(m.langs)), np.float32), np.arange(len(unseen))
    hit = np.zeros(len(unseen), bool)
    for size, keys, logs in zip(GRAMS, m.gram_keys, m.gram_logs, strict=True):
        if not len(left):
            break
        start, end, word = _gram_spans(w.data, w.start[unseen[left]], w.end[unseen[left]], size)
        look = sorted_lookup(keys, _salted(T.span_hash(w.data, start, end), size))
        word, look = word[look >= 0], look[look >= 0]
        n = np.bincount(word, minlength=len(left))
        for k in range(len(m.langs)):
            total = np.bincount(word, logs[look, k], minlength=len(left))
            found[left, k] = np.where(n > 0, total / np.maximum(n, 1), 0)
        hit[left] = n > 0
        left = left[n == 0]
    score[at < 0] = found[rank[back]] if len(unseen) else score[at < 0]
    counts = at >= 0
    counts[at < 0] = hit[rank[back]] if len(unseen) else counts[at < 0]
    text = w.text_of()
    total = np.stack([np.bincount(text, score[:, k], minlength=len(offsets) - 1) for k in range(len(m.langs))], axis=1)
    return total, np.bincount(text, counts, minlength=len(offsets) - 1)


def predict(docs: DataFrame, model: LanguageModel | None, keep: list[str], evidence: float = 20.0) -> DataFrame:
    """The columns ``keep`` of every row with ``lang_pred`` and ``score``, the share of the best language.

    Whole texts are read, in lower case. ``und`` with score 0 where the text is NULL or has no letter, or
    nothing was learned. The share counts at most ``evidence`` words, so it doesn't go to 1 by length alone.
    Equal scores go to the first language by name. Letters of no known n-gram leave all languages equal.
    """
    context = docs.sparkSession.sparkContext
    sent = context.broadcast(None if model is None else tuple(model))

    def compute(data: np.ndarray, offsets: np.ndarray) -> list:
        if sent.value is None:
            return [["und"] * (len(offsets) - 1), np.zeros(len(offsets) - 1)]
        m = LanguageModel(*sent.value)
        total, n = _scores(data, offsets, m)
        mean = total / np.maximum(n, 1)[:, None] * np.minimum(n, evidence)[:, None]
        share = np.exp(mean - mean.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        return [[m.langs[k] for k in share.argmax(axis=1)], share.max(axis=1)]

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    keep = [c for c in keep if c not in ("text", "lang_pred", "score")]
    low = docs.select(*map(col, keep), F.lower("text").alias("text"), lettered.alias("__lettered"))
    out = with_columns(low, [*keep, "__lettered"], "lang_pred string, score double", compute)
    return out.withColumns(
        {
            "lang_pred": F.when(F.col("__lettered"), F.col("lang_pred")).otherwise("und"),
            "score": F.when(F.col("__lettered"), F.col("score")).otherwise(0.0),
        }
    ).drop("__lettered")
