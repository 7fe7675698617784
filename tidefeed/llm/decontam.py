"""Benchmark decontamination by winnowing.

Both sides are cut into words. Of every ``w`` consecutive k-grams a text keeps the one with the smallest
hash, so two texts that share ``k + w - 1`` words in a row share a kept k-gram: with ``k + w - 1`` equal to
the window of the contamination rule, no window is missed. Items shorter than a window are matched whole:
all their runs of that length are kept, which is winnowing with ``w`` = 1. The kept hashes (fingerprints)
of documents and items are joined, and each hit is extended to the left and right, word by word, as far
as both texts agree. Runs of a window's length or more mark the document's words.

A bit map of fixed size, made from the items' fingerprints, travels to the tasks, so that most of the
documents' fingerprints never leave them. It only saves work: what passes it is still joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.llm import text as T
from tidefeed.llm.columns import mapped, with_columns
from tidefeed.llm.sharing import checked, ids, stored

_NOT_WORD = bytes(b if (b >= 0x80 or chr(b).isalnum()) else 32 for b in range(256))
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in _NOT_WORD)


class Winnowing(NamedTuple):
    """``window`` words make a hit; k-grams of ``k`` words; the bit map has 2**``filter_bits`` bits."""

    window: int = 13
    k: int = 6
    filter_bits: int = 24

    @property
    def w(self) -> int:
        return self.window - self.k + 1


def split_words(text: str | None) -> list[bytes]:
    """Lower-case words (letters, digits, everything outside ASCII) as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def kept_grams(w: T.Words, plan: Winnowing) -> tuple[np.ndarray, np.ndarray]:
    """Position and hash of the winnowed k-grams of texts of a window's length or more; ties are all kept."""
    grams = T.gram_hash(w.hash, plan.k)
    starts = T.whole_grams(w.first, plan.window)
    if not starts.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = T.sliding_min(grams, plan.w)[: len(starts)]
    # A k-gram is kept if it is the minimum of a window around it; windows across texts don't count.
    least = np.where(starts, least, np.uint64(0))
    padded = np.concatenate([np.zeros(plan.w - 1, np.uint64), least, np.zeros(plan.w - 1, np.uint64)])
    most = ~T.sliding_min(~padded, plan.w)
    at = np.flatnonzero(most == grams)
    return at, grams[at]


def _prints(w: T.Words, plan: Winnowing, lengths: list[int], items: bool) -> tuple[np.ndarray, np.ndarray]:
    """Word position and hash of all fingerprints, those of short runs salted by their length."""
    at, hashes = kept_grams(w, plan)
    places, out = [at], [hashes]
    n = np.diff(w.first)
    for size in lengths:
        ok = T.whole_grams(w.first, size)
        if items:  # an item of this length is its own only run
            ok &= np.repeat(n, n)[: len(ok)] == size
        places.append(np.flatnonzero(ok))
        out.append(T.mix(T.gram_hash(w.hash, size)[ok] + T.salt(size)))
    return np.concatenate(places), np.concatenate(out)


def fingerprints(
    texts: DataFrame, key: list[str], text: str, plan: Winnowing, lengths: list[int], items: bool = False, bits=None
) -> DataFrame:
    """``key``, ``print``, ``pos``: the fingerprints of each text that the bit map lets pass."""

    def compute(data: np.ndarray, offsets: np.ndarray) -> list:
        w = T.words(data, offsets, T.ALNUM)
        at, hashes = _prints(w, plan, lengths, items)
        if bits is not None:
            slot = hashes & np.uint64((1 << plan.filter_bits) - 1)
            hit = (bits.value[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0
            at, hashes = at[hit], hashes[hit]
        of = np.searchsorted(w.first, at, "right") - 1
        order = np.argsort(of, kind="stable")
        cut = np.searchsorted(of[order], np.arange(1, len(offsets) - 1))
        pos = (at - w.first[of])[order].astype(np.int32)
        return [np.split(hashes[order].view(np.int64), cut), np.split(pos, cut)]

    made = with_columns(texts, key, "prints array<bigint>, places array<int>", compute, text)
    pairs = F.explode(F.arrays_zip("prints", "places")).alias("e")
    return made.select(*key, pairs).select(*key, F.col("e.prints").alias("print"), F.col("e.places").alias("pos"))


def _bit_map(prints: DataFrame, plan: Winnowing) -> np.ndarray:
    """Bits of the fingerprints that occur, gathered as at most 2**filter_bits / 32 words."""
    slot = F.col("print").bitwiseAND(F.lit((1 << plan.filter_bits) - 1))
    words = prints.select(slot.alias("slot")).selectExpr("shiftright(slot, 5) as at", "shiftleft(1L, int(slot & 31)) as bit")
    found = words.groupBy("at").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(1 << (plan.filter_bits - 5), np.uint32)
    out[found["at"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).astype(np.uint32)
    return out.view(np.uint8)


def extended(doc: list[bytes], item: list[bytes], seeds: list[int], window: int) -> list[tuple[int, int]]:
    """Runs of the document's words, from where to where, in which the item's windows occur.

    A hit is extended to both sides of its position as far as windows reach, and further wherever the last
    window found goes on.
    """
    need = min(window, len(item))
    if not need:
        return []
    known = {tuple(item[i : i + need]) for i in range(len(item) - need + 1)}
    runs: list[tuple[int, int]] = []
    tried = -1
    for seed in sorted(seeds):
        at, stop = max(0, tried + 1, seed - need + 1), seed
        while at <= stop and at + need <= len(doc):
            if tuple(doc[at : at + need]) in known:
                runs.append((at, at + need))
                stop = max(stop, at + 1)
            tried = at
            at += 1
    return merged(runs)


FOUND = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<array<int>>, items array<bigint>"
FOUND_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.list_(pa.int32())), pa.list_(pa.int64())]


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, keep: list[str], plan: Winnowing = Winnowing(), share: int = 20
) -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` with what the items of ``benchmark`` hit in its text.

    ``n_words``, ``n_hit`` (words inside an occurrence of a window of an item), ``n_items`` and ``items``
    (ids of items with occurring windows), ``items_sha256`` (of the ids as text, sorted, comma-joined),
    ``spans`` (word ranges hit, merged) and ``contaminated``: ``n_hit`` > 0 and ``share * n_hit >= n_words``.

    NULL and empty texts have no words and no hits; so have items without words. Rows that repeat a
    ``doc_id``, or have none, are judged by their own text. Items that repeat an id count as one id; one
    without an id hits words and counts as an item with an empty id, not listed in ``items``. Empty
    tables give no hits. Kept columns named like a new one are replaced.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", F.col("text").alias("item_text")).where(F.col("item_text").isNotNull()).distinct()
    items = stored(items.withColumn("item_key", F.xxhash64(F.coalesce("item_id", F.lit(-1)), "item_text")), "items")
    sized = with_columns(items, [], "n int", lambda d, o: [np.diff(T.words(d, o, T.ALNUM).first).astype(np.int32)], "item_text")
    lengths = sorted(r[0] for r in sized.where(f"n > 0 and n < {plan.window}").distinct().collect())
    item_prints = fingerprints(items, ["item_key"], "item_text", plan, lengths, items=True)
    item_prints = checked(item_prints.select("item_key", "print").distinct(), "item-prints", 24)
    bits = spark.sparkContext.broadcast(_bit_map(item_prints, plan))
    # Rows of one doc_id, or without any, are told apart by their text, so they gather nothing together.
    of_text = F.xxhash64("doc_id", "text")
    hits = (
        fingerprints(docs.select("doc_id", "text", of_text.alias("of_text")), ["doc_id", "of_text"], "text", plan, lengths, bits=bits)
        .join(item_prints, "print")
        .groupBy("doc_id", "of_text", "item_key")
        .agg(F.collect_set("pos").alias("seeds"))
        .join(items, "item_key")
        .groupBy(F.col("doc_id").alias("__of_doc"), F.col("of_text").alias("__of_text"))
        .agg(F.collect_list(F.struct("item_id", "item_text", "seeds")).alias("__hits"))
    )
    hits = checked(hits, "hits", F.expr("32 + aggregate(__hits, 0L, (s, h) -> s + 40 + octet_length(h.item_text) + 8 * size(h.seeds))"))
    joined = docs.join(hits, F.col("doc_id").eqNullSafe(F.col("__of_doc")) & (of_text == F.col("__of_text")), "left")

    def judge(kept: list[pa.Array], given: list[pa.Array]) -> Iterator[list[pa.Array]]:
        for a in range(0, len(given[0]), 500):
            pairs = zip(*(c.slice(a, 500).to_pylist() for c in given), strict=True)
            rows = [_judged(text, found, plan.window, share) for text, found in pairs]
            made = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), FOUND_TYPES, strict=True)]
            yield [c.slice(a, 500) for c in kept] + made

    return mapped(joined, keep, ["text", "__hits"], FOUND, judge)


def _judged(text: str | None, hits: list[dict] | None, window: int, share: int) -> tuple:
    words, spans, of = split_words(text), [], []
    for hit in hits or ():
        if runs := extended(words, split_words(hit["item_text"]), hit["seeds"], window):
            spans += runs
            of.append(hit["item_id"])
    spans = merged(spans)
    n_hit = sum(b - a for a, b in spans)
    digest = hashlib.sha256(ids(of).encode()).hexdigest()
    flag = n_hit > 0 and share * n_hit >= len(words)
    return len(words), n_hit, len(set(of)), digest, flag, [list(s) for s in spans], sorted({x for x in of if x is not None})


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges without overlaps, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out
