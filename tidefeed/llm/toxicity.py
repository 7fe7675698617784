"""Toxicity: severity grades by cumulative-link ordinal regression on sparse text features.

Grades run from 0 (not toxic) to 3. The labels only say toxic or not, so the grade of a labelled toxic
document follows from how many different indicative features it holds: those that are in toxic documents
significantly more often than in others. The features are words and word beginnings that tell the labels
apart. One weight per feature is shared by all thresholds: P(grade >= k) = sigmoid(score - threshold_k), with rising
thresholds. The result is the expected grade.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.llm import text as T
from tidefeed.llm.columns import labelled_sample, per_text, sorted_lookup, with_columns
from tidefeed.llm.sharing import stored

ADDED = "expected_severity double, severity int, p_toxic double, toxic boolean"


class SeverityModel(NamedTuple):
    """Word hashes in order, a weight for each, and the rising thresholds."""

    words: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray


#: Word beginnings of so many characters are features beside whole words, as languages inflect and compound.
PREFIXES = (3, 4, 5, 6, 7)


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each distinct word and word beginning of each text, in order of texts."""
    w = T.words(data, offsets, T.ALNUM)
    doc = w.text_of()
    hashes, of = [w.hash], [doc]
    heads = np.flatnonzero((w.data & 0xC0) != 0x80)  # the first byte of each character
    head = np.searchsorted(heads, w.start)
    bounds = np.concatenate([heads, np.full(max(PREFIXES) + 1, len(w.data))])
    for size in PREFIXES:
        end = bounds[head + size]
        longer = end < w.end
        hashes.append(T.mix(T.span_hash(w.data, w.start[longer], end[longer]) + T.salt(size)))
        of.append(doc[longer])
    hashes, doc = np.concatenate(hashes), np.concatenate(of)
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[new], d[new]


def _word_lists(data: np.ndarray, offsets: np.ndarray) -> list[list[np.ndarray]]:
    h, d = _features(data, offsets)
    return [np.split(h.view(np.int64), np.searchsorted(d, np.arange(1, len(offsets) - 1)))]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_cumulative_link(
    rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, n_columns: int, l2: float = 0.02, steps: int = 300
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds from the ones of a sparse 0/1 matrix, by Adam on the whole of it."""
    n, top = len(grades), int(grades.max(initial=1))
    share = [np.clip((grades >= k).mean() if n else 0.5, 1e-3, 1 - 1e-3) for k in range(1, top + 1)]
    cuts = np.array([-np.log(p / (1 - p)) for p in share])
    gaps = np.log(np.expm1(np.maximum(np.diff(cuts), 0.1)))  # thresholds: first, then softplus steps
    theta = np.concatenate([np.zeros(n_columns), cuts[:1], gaps])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, first, gaps = theta[:n_columns], theta[n_columns], theta[n_columns + 1 :]
        cuts = first + np.concatenate([[0.0], np.cumsum(np.logaddexp(0, gaps))])
        score = np.bincount(rows, w[columns], minlength=n)
        above = sigmoid(score[:, None] - cuts)  # P(grade >= k) for k = 1..top
        padded = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        at = np.arange(n)
        p = np.maximum(padded[at, grades] - padded[at, grades + 1], 1e-9)
        slope = padded * (1 - padded)
        d_score = -(slope[at, grades] - slope[at, grades + 1]) / p
        d_cuts = np.zeros(top)
        for k in range(1, top + 1):
            d_cuts[k - 1] = (slope[:, k] / p * ((grades == k).astype(float) - (grades == k - 1))).sum()
        gradient = np.concatenate(
            [
                np.bincount(columns, d_score[rows], minlength=n_columns) / max(n, 1) + l2 * w / max(n, 1) * 10,
                [d_cuts.sum() / max(n, 1)],
                np.array([d_cuts[k:].sum() for k in range(1, top)]) * sigmoid(gaps) / max(n, 1),
            ]
        )
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta = theta - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    first, gaps = theta[n_columns], theta[n_columns + 1 :]
    return theta[:n_columns], first + np.concatenate([[0.0], np.cumsum(np.logaddexp(0, gaps))])


def learn(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = 12000,
    min_docs: int = 5,
    min_z: float = 5.0,
    max_words: int = 20000,
    steps_of_grade: tuple[int, ...] = (4, 10),
) -> SeverityModel | None:
    """Fit to at most ``max_rows`` labelled documents; None if none of them is toxic or none is not.

    Features are the words and word beginnings in ``min_docs`` sampled documents or more whose share among
    toxic documents differs from that among others by ``min_z`` standard errors, the strongest ``max_words``
    of them. A toxic document's grade is 1, and one more for each number in ``steps_of_grade`` that its
    different indicative features reach; a word mostly brings several.
    """
    sample = labelled_sample(docs, labels, "toxic", max_rows)
    lists = stored(with_columns(sample, ["label"], "words array<bigint>", _word_lists), "word-lists")
    n1, n0 = lists.agg(F.sum(F.expr("int(label > 0)")), F.sum(F.expr("int(label <= 0)"))).head()
    if not n1 or not n0:
        return None
    a, b = F.col("toxic_docs"), F.col("clean_docs")
    pooled = (a + b) / (n1 + n0)
    z = (a / n1 - b / n0) / F.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0) + 1e-12)
    chosen = (
        lists.select("label", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.sum(F.expr("int(label > 0)")).alias("toxic_docs"), F.sum(F.expr("int(label <= 0)")).alias("clean_docs"))
        .where((a + b >= min_docs) & (F.abs(z) >= min_z))
        .select("word", z.alias("z"))
        .orderBy(F.desc(F.abs("z")), "word")
        .limit(max_words)
        .toPandas()
    )
    words = np.sort(chosen["word"].to_numpy(np.int64))
    indicative = np.sort(chosen.loc[chosen["z"] > 0, "word"].to_numpy(np.int64))
    listed = F.array(*[F.lit(int(x)) for x in words]) if len(words) else F.array().cast("array<bigint>")
    kept = lists.select(F.expr("int(label > 0)").alias("toxic"), F.array_intersect("words", listed).alias("words"))
    kept = kept.toPandas()
    held = [np.asarray(x, np.int64) for x in kept["words"]]
    rows = np.repeat(np.arange(len(held)), [len(x) for x in held])
    flat = np.concatenate(held) if held else np.zeros(0, np.int64)
    hits = np.bincount(rows, np.isin(flat, indicative), minlength=len(held))
    toxic = kept["toxic"].to_numpy()
    grades = toxic * (1 + sum((hits >= s).astype(int) for s in steps_of_grade))
    weights, thresholds = fit_cumulative_link(rows, sorted_lookup(words, flat), grades, len(words))
    order = np.argsort(words.view(np.uint64))
    return SeverityModel(words.view(np.uint64)[order], weights[order], thresholds)


def score(docs: DataFrame, model: SeverityModel | None, keep: list[str], threshold: float = 0.5) -> DataFrame:
    """The columns ``keep`` of every row, and ``expected_severity``, ``severity`` (the likeliest grade),
    ``p_toxic`` = P(grade >= 1) and ``toxic``: whether that is ``threshold`` or more.

    Whole texts are read. NULL and empty texts have no words, and so the prior; repeated rows each have
    their row. Without a model (nothing to learn from) all is 0 and false. Kept columns named like a new
    one are replaced.
    """
    if model is None:
        model = SeverityModel(np.zeros(0, np.uint64), np.zeros(0), np.array([np.inf]))
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def compute(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        words, weights, cuts = sent.value
        hashes, of = _features(data, offsets)
        at = sorted_lookup(words, hashes)
        known = np.flatnonzero(at >= 0)
        total = np.bincount(of[known], weights[at[known]], len(offsets) - 1)
        above = sigmoid(total[:, None] - cuts)
        grade = np.concatenate([np.ones((len(total), 1)), above], axis=1) - np.concatenate([above, np.zeros((len(total), 1))], axis=1)
        return [above.sum(axis=1), grade.argmax(axis=1).astype(np.int32), above[:, 0], above[:, 0] >= threshold]

    return with_columns(docs, keep, ADDED, compute)
