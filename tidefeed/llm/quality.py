"""Quality classifier: random-indexing word vectors, pooled per document, into a two-layer network.

Every token has a fixed sparse ternary index vector, made from its hash. A word's vector is the sum of the
index vectors that stand next to it in a bounded sample of labelled documents, plus its own, at length 1.
Tokens are words and their shapes (case, digits, signs), so text made of signs or capitals has a place of
its own. A document is the mean of its tokens' vectors with a few pooled counts. The network has one
hidden layer; its probabilities are calibrated by one temperature on rows kept apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.llm import text as T
from tidefeed.llm.columns import labelled_sample, per_text, sorted_lookup, with_columns
from tidefeed.llm.sharing import shipped, stored
from tidefeed.llm.toxicity import sigmoid

DIM = 64
_SHAPE = np.uint64(0x5A17)


class QualityModel(NamedTuple):
    """Known tokens and their vectors, scaling of the inputs, both layers, the temperature."""

    tokens: np.ndarray
    vectors: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float


def _byte_counts(data: np.ndarray, marks: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(marks[data], dtype=np.int32)])
    return total[end] - total[start]


_UPPERS = T._byte_class(((0x41, 0x5A),), inside=True)
_DIGITS = T._byte_class(((0x30, 0x39),), inside=True)
_SIGNS = ~T.ALNUM & T.NOT_BLANK


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, T.Words]:
    """Hashes of the blank-separated tokens (A-Z folded) and of their shapes."""
    w = T.words(data, offsets, T.NOT_BLANK)
    long = w.end - w.start
    upper, digit, sign = (_byte_counts(w.data, m, w.start, w.end) for m in (_UPPERS, _DIGITS, _SIGNS))
    shape = np.minimum(upper, 3) + 4 * np.minimum(digit, 3) + 16 * np.minimum(sign, 4) + 80 * np.minimum(long // 6, 5)
    if len(w.end):
        shape = shape + 512 * w.data[w.end - 1].astype(np.int64) * (sign > 1)
    return w.hash, T.mix(shape.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + _SHAPE), w


def index_vectors(hashes: np.ndarray, dim: int = DIM, ones: int = 8) -> np.ndarray:
    """Sparse ternary vectors: ``ones`` entries of +1 or -1 at places drawn from the hash."""
    out = np.zeros((len(hashes), dim), np.float32)
    rows = np.arange(len(hashes))
    for j in range(ones):
        drawn = T.mix(hashes + T.salt(j + 1))
        np.add.at(out, (rows, (drawn % np.uint64(dim)).astype(np.int64)), np.where(drawn >> np.uint64(63), 1, -1))
    return out


def pooled(data: np.ndarray, offsets: np.ndarray, known: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """For each text: mean vector of its known tokens and shapes, and pooled counts."""
    word, shape, w = tokens(data, offsets)
    n = np.maximum(np.diff(w.first), 1)
    total = np.zeros((len(offsets) - 1, vectors.shape[1]))
    doc = w.text_of()
    hits = []
    for hashes in (word, shape):
        at = sorted_lookup(known, hashes)
        has = np.flatnonzero(at >= 0)
        hits.append(np.bincount(doc[has], minlength=len(n)))
        if len(has):  # count each token of a text once, then weigh its vector
            pair, count = np.unique(doc[has] * len(known) + at[has], return_counts=True)
            d, k = pair // len(known), pair % len(known)
            for a in range(0, len(pair), 65536):
                rows, first = np.unique(d[a : a + 65536], return_index=True)
                total[rows] += np.add.reduceat(vectors[k[a : a + 65536]] * count[a : a + 65536, None], first, axis=0)
    order = np.lexsort((word, doc))
    new = np.ones(len(order), bool)
    new[1:] = (word[order][1:] != word[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    distinct = np.bincount(doc[order][new], minlength=len(n))
    size = np.diff(offsets)
    sums = [per_text(_byte_counts(w.data, m, w.start, w.end), w.first) for m in (_UPPERS, _DIGITS, _SIGNS)]
    extra = [hits[0] / n, hits[1] / n, distinct / n, np.log1p(n), size / n / 10, *(s / np.maximum(size, 1) for s in sums)]
    lines = np.searchsorted(np.flatnonzero(w.data == 10), offsets - offsets[0])
    extra.append(np.log1p(np.diff(lines)))
    return np.concatenate([total / n[:, None], np.stack(extra, axis=1)], axis=1)


def _vocabulary(sample: DataFrame, min_docs: int, max_words: int) -> np.ndarray:
    """The tokens and shapes that are in the most sampled documents, as sorted hashes."""

    def lists(data: np.ndarray, offsets: np.ndarray) -> list:
        word, shape, w = tokens(data, offsets)
        return [[np.unique(np.concatenate([word[a:b], shape[a:b]])).view(np.int64) for a, b in zip(w.first, w.first[1:])]]

    counts = (
        with_columns(sample, [], "tokens array<bigint>", lists)
        .select(F.explode("tokens").alias("token"))
        .groupBy("token")
        .count()
        .where(F.col("count") >= min_docs)
        .orderBy(F.desc("count"), "token")
        .limit(max_words)
    )
    return np.sort(counts.toPandas()["token"].to_numpy(np.int64).view(np.uint64))


def _word_vectors(sample: DataFrame, known: np.ndarray, window: int = 2) -> np.ndarray:
    """Sums of the index vectors of neighbours, gathered by task and added up."""
    sent = sample.sparkSession.sparkContext.broadcast(known)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        out, index = np.zeros((len(known), DIM), np.float32), index_vectors(known)
        for batch in batches:
            data, offsets = T.text_buffers(batch.column(0))
            for a, b in T.groups(offsets):
                word, shape, w = tokens(data, offsets[a : b + 1])
                doc, at, look = w.text_of(), sorted_lookup(known, word), sorted_lookup(known, shape)
                np.add.at(out, at[(at >= 0) & (look >= 0)], index[look[(at >= 0) & (look >= 0)]])
                for step in range(1, window + 1):
                    ok = (doc[step:] == doc[:-step]) & (at[step:] >= 0) & (at[:-step] >= 0)
                    left, right = at[:-step][ok], at[step:][ok]
                    np.add.at(out, left, index[right])
                    np.add.at(out, right, index[left])
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()])], names=["part"])

    parts = shipped(sample.select("text").coalesce(8)).mapInArrow(gather, "part binary").toPandas()["part"]
    total = sum((np.frombuffer(x, np.float32).reshape(-1, DIM) for x in parts), np.zeros((len(known), DIM), np.float32))
    total = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-6) + index_vectors(known) / np.sqrt(8)
    return (total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-6)).astype(np.float32)


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, l2: float = 1e-4, seed: int = 7) -> tuple:
    """One hidden layer of tanh units and a logistic output, by Adam on small batches."""
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 0.1, hidden), np.zeros(1)]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), 128):
            xb, yb = x[order[a : a + 128]], y[order[a : a + 128]]
            h = np.tanh(xb @ params[0] + params[1])
            d = (sigmoid(h @ params[2] + params[3][0]) - yb) / len(xb)
            dh = np.outer(d, params[2]) * (1 - h * h)
            step += 1
            for i, g in enumerate((xb.T @ dh + l2 * params[0], dh.sum(0), h.T @ d + l2 * params[2], np.array([d.sum()]))):
                m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
                params[i] = params[i] - 0.003 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return params[0], params[1], params[2], float(params[3][0])


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
    loss = [np.mean(np.logaddexp(0, logits / t) - y * logits / t) for t in grid]
    return float(grid[int(np.argmin(loss))])


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = 10000, min_docs: int = 5, max_words: int = 20000) -> QualityModel | None:
    """Fit to at most ``max_rows`` labelled rows of ``labels``; None if they hold fewer than two classes.

    A tenth of the sampled rows sets the temperature, the rest the network.
    """
    sample = labelled_sample(docs, labels, "quality", max_rows)
    known = _vocabulary(sample, min_docs, max_words)
    vectors = _word_vectors(sample, known)
    sent = docs.sparkSession.sparkContext.broadcast((known, vectors))
    made = with_columns(
        sample, ["doc_id", "label"], "x array<double>", lambda data, offsets: [list(pooled(data, offsets, *sent.value))]
    ).toPandas().sort_values("doc_id", kind="stable")
    y = (made["label"].to_numpy() > 0).astype(float)
    if len(set(y)) < 2:
        return None
    x = np.stack(made["x"].to_numpy())
    centre, spread = x.mean(0), x.std(0) + 1e-6
    x = (x - centre) / spread
    held = np.arange(len(x)) % 10 == 9
    if len(set(y[~held])) < 2:
        held[:] = False
    w1, b1, w2, b2 = fit_network(x[~held], y[~held])
    logits = np.tanh(x[held] @ w1 + b1) @ w2 + b2
    return QualityModel(known, vectors, centre, spread, w1, b1, w2, b2, _temperature(logits, y[held]) if held.any() else 1.0)


def score(docs: DataFrame, model: QualityModel | None, keep: list[str], threshold: float = 0.3) -> DataFrame:
    """The columns ``keep`` of every row with ``score`` (probability of label 1) and ``predicted``.

    Whole texts are read. NULL and empty texts have a score too, from their counts; repeated rows each have
    a row. Without a model every score is 0.5. Kept columns named like a new one are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(None if model is None else tuple(model))

    def compute(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        if sent.value is None:
            p = np.full(len(offsets) - 1, 0.5)
        else:
            m = QualityModel(*sent.value)
            x = (pooled(data, offsets, m.tokens, m.vectors) - m.centre) / m.spread
            p = sigmoid((np.tanh(x @ m.w1 + m.b1) @ m.w2 + m.b2) / m.temperature)
        return [p, (p >= threshold).astype(np.int32)]

    return with_columns(docs, keep, "score double, predicted int", compute)
