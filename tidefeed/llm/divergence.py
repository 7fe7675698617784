"""How sources differ in their use of words, over the words that enough documents of a language hold.

Which words these are is found by iceberg refinement of prefixes. A prefix is in at least as many documents as each of
its words, so a prefix in too few documents can be discarded with all its words before any of them is moved.
Level by level the prefixes get longer (4 bytes, then twice as many each time): a level counts, per language, the
distinct documents of each prefix of its length whose shorter prefix was kept, and those of each word that ends
within it. It keeps what is in enough documents. No level follows once only complete words are left.

Prefixes travel as 64-bit hashes, and those kept go to the tasks of the next level as a bit map of fixed size.
Both can only let more through, never less: words are counted by their letters. Tasks add up what they have seen
before anything is shuffled, so a row leaves a task per prefix, not per document.

Counts per source are then taken for the kept words alone. Sources of a language are compared in blocks: a task gets
two blocks of sources and one of words, and puts out a partial sum for each pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefeed.llm import text as T
from tidefeed.llm.sharing import checked, shipped, stored
from tidefeed.storage import materialize

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Levels(NamedTuple):
    """Bytes of the first level's prefixes, bits of the map (a power of two), entries that a task holds."""

    first: int = 4
    filter_bits: int = 24
    held: int = 1 << 19


class Blocks(NamedTuple):
    """Sources and words that a task compares at once."""

    sources: int = 256
    words: int = 2048


def texts_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans as lower-case texts."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(_LOWER[data[at]]))


#: From words and the salt of each word's language to words picked, their keys, and whether the key is the whole word's.
Pick = Callable[[T.Words, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _salts(langs: list[str]) -> np.ndarray:
    made = [int.from_bytes(hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for x in langs]
    return np.array(made, np.uint64)


class _Tally:
    """Counts by group and key, and the word of each key that is a whole one's."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.entries = 0

    def add(self, group: np.ndarray, key: np.ndarray, n: np.ndarray, word: pa.Array) -> None:
        self.parts.append((group, key, n, word))
        self.entries += len(key)

    def merge(self) -> None:
        group, key, n = (np.concatenate([p[i] for p in self.parts]) for i in range(3))
        word = pa.concat_arrays([p[3] for p in self.parts])
        order = np.lexsort((key, group))
        group, key = group[order], key[order]
        new = np.ones(len(key), bool)
        new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        at = np.flatnonzero(new)
        total = np.add.reduceat(n[order], at) if len(at) else n
        self.parts, self.entries = [(group[at], key[at], total, word.take(pa.array(order[at])))], len(at)


def _distinct(text: np.ndarray, key: np.ndarray) -> np.ndarray:
    """One of each pair of text and key."""
    pairs = T.mix(key + (text.astype(np.uint64) + _U(1)) * T.salt(11))
    return np.unique(pairs, return_index=True)[1]


def counted(rows: DataFrame, by: list[str], pick: Pick, per_text: bool, held: int) -> DataFrame:
    """``by``, ``word``, ``key``, ``n`` of the texts of ``rows`` (``by``, the first the language, and ``text``): texts that hold
    the key, or occurrences. ``word`` is NULL for the key of a prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[tuple, int] = {}
        tally = _Tally()

        def put() -> pa.RecordBatch:
            (group, key, n, word), = tally.parts
            listed = list(names)
            columns = [pa.array([x[i] for x in listed], pa.string()).take(pa.array(group)) for i in range(len(by))]
            columns += [word.cast(pa.string()), pa.array(key.view(np.int64)), pa.array(n)]
            tally.parts, tally.entries = [], 0
            return pa.RecordBatch.from_arrays(columns, names=[*by, "word", "key", "n"])

        for batch in batches:
            if not tally.parts:
                names = {}
            rows_by = zip(*(c.to_pylist() for c in batch.columns[: len(by)]))
            group_of = np.array([names.setdefault(x, len(names)) for x in rows_by], np.int64)
            salts = _salts([x[0] for x in names])
            data, offsets = T.text_buffers(batch.column(len(by)))
            for a, b in T.groups(offsets):
                w = T.words(data, offsets[a : b + 1], T.LETTERS)
                text = w.text_of()
                group = group_of[a:b][text]
                at, key, whole = pick(w, salts[group])
                if per_text:
                    one = _distinct(text[at], key)
                    at, key, whole = at[one], key[one], whole[one]
                    order = np.argsort(key, kind="stable")
                else:
                    order = np.lexsort((key, group[at]))
                at, key, whole = at[order], key[order], whole[order]
                new = np.ones(len(at), bool)
                new[1:] = (key[1:] != key[:-1]) | (group[at][1:] != group[at][:-1])
                first = np.flatnonzero(new)
                n = np.diff(np.concatenate([first, [len(at)]])).astype(np.int64)
                at, key, whole = at[first], key[first], whole[first]
                listed = np.flatnonzero(whole)
                found = texts_of(w.data, w.start[at[listed]], w.end[at[listed]])
                place = np.full(len(at), -1)
                place[listed] = np.arange(len(listed))
                word = found.take(pa.array(place, mask=place < 0)) if len(at) else found
                tally.add(group[at], key, n, word)
                if tally.entries > held:
                    tally.merge()
                    if tally.entries > held // 2:
                        yield put()
        if tally.parts:
            tally.merge()
            yield put()

    listed = ", ".join(f"{c} string" for c in by)
    return shipped(rows.select(*by, "text")).mapInArrow(run, f"{listed}, word string, key long, n long")


def _passes(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    slot = key & _U(8 * len(bits) - 1)
    return (bits[slot >> _U(3)] >> (slot & _U(7)).astype(np.uint8)) & 1 > 0


def bit_map(keys: DataFrame, bits: int) -> np.ndarray:
    """The lowest ``bits`` bits of each ``key`` as a map, gathered as at most 2**bits / 32 numbers."""
    slot = F.col("key").bitwiseAND(F.lit((1 << bits) - 1))
    parts = keys.select(slot.alias("slot")).selectExpr("shiftright(slot, 5) as at", "shiftleft(1L, int(slot & 31)) as bit")
    found = parts.groupBy("at").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(1 << (bits - 5), np.uint32)
    out[found["at"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).astype(np.uint32)
    return out.view(np.uint8)


def _prefix_keys(w: T.Words, at: np.ndarray, size: int, salt: np.ndarray) -> np.ndarray:
    """Keys of the words ``at``: of their first ``size`` bytes, if they have more, else of all."""
    end = np.minimum(w.end[at], w.start[at] + size)
    return T.mix(T.span_hash(w.data, w.start[at], end) + salt[at] + (w.end[at] > end).astype(np.uint64) * T.salt(13))


def _level(size: int, before: int, bits) -> Pick:
    def pick(w: T.Words, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.arange(len(w.start))
        if before:
            at = np.flatnonzero(w.end - w.start > before)
            at = at[_passes(bits.value, _prefix_keys(w, at, before, salt))]
        return at, _prefix_keys(w, at, size, salt), w.end[at] - w.start[at] <= size

    return pick


def common_words(docs: DataFrame, least: int, levels: Levels = Levels()) -> DataFrame:
    """``lang``, ``word``, ``key``: the words that ``least`` or more rows of a ``lang`` hold."""
    context = docs.sparkSession.sparkContext
    kept, size, before, bits = None, levels.first, 0, None
    while True:
        seen = counted(docs, ["lang"], _level(size, before, bits), True, levels.held)
        seen = seen.groupBy("lang", "word", "key").agg(F.sum("n").alias("docs")).where(F.col("docs") >= least).drop("docs")
        seen, found = materialize(seen, "prefixes", F.count("word").alias("words"))
        words = seen.where("word is not null")
        kept = words if kept is None else kept.unionAll(words)
        if found["rows"] == found["words"]:
            return kept
        bits = context.broadcast(bit_map(seen.where("word is null").select("key"), levels.filter_bits))
        size, before = 2 * size, size


def _kept_only(bits) -> Pick:
    def pick(w: T.Words, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        key = T.mix(w.hash + salt)
        at = np.flatnonzero(_passes(bits.value, key))
        return at, key[at], np.ones(len(at), bool)

    return pick


def _share(n: str | Column, total: str, words: str) -> Column:
    """1 + floor(1000000000 * (n + 5) / (total + 5 * words)), exact at any size."""
    more = (F.col(n) if isinstance(n, str) else n).cast("decimal(19,0)") + F.lit(5)
    scaled = (F.lit(1_000_000_000).cast("decimal(10,0)") * more).cast("decimal(30,0)")
    return 1 + F.call_function("div", scaled, (F.col(total) + 5 * F.col(words)).cast("decimal(20,0)"))


def _pair_sums(lang_rows: pa.Table) -> pa.Table:
    """Partial sums of the pairs of two blocks of sources over one block of words."""
    x, y = (lang_rows.column(c)[0].as_py() for c in ("x", "y"))
    words = int(lang_rows.column("words").to_numpy().max())  # only rows without a word have it
    source, p = lang_rows.column("number").to_numpy(), lang_rows.column("p").to_numpy()
    word = lang_rows.column("word").combine_chunks().dictionary_encode()
    at = word.indices.fill_null(-1).to_numpy()
    base = at < 0  # a source's share for words that it lacks
    order = np.argsort(source[base], kind="stable")
    number, low = source[base][order], p[base][order]
    shares = np.repeat(low[:, None], len(word.dictionary), axis=1)
    shares[np.searchsorted(number, source[~base]), at[~base]] = p[~base]
    block = lang_rows.column("block").to_numpy()[base][order]
    left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
    out = []
    for i in left:
        others = right[number[right] > number[i]] if x == y else right
        sums = np.abs(shares[others] - shares[i]).sum(axis=1) + np.abs(low[others] - low[i]) * (words - shares.shape[1])
        out.append(np.stack([np.full(len(others), number[i]), number[others], sums], axis=1))
    found = np.concatenate([np.zeros((0, 3), np.int64), *out])
    lang = pa.array([lang_rows.column("lang")[0].as_py()] * len(found), pa.string())
    return pa.table([lang, *(pa.array(found[:, i]) for i in range(3))], names=["lang", "a", "b", "value"])


def _met(rows: DataFrame, blocks: Blocks) -> DataFrame:
    """The rows (``number``, ``sources``), once for each block of sources that theirs is compared with."""
    rows = rows.withColumn("block", F.floor(F.col("number") / blocks.sources))
    last = F.floor((F.col("sources") - 1) / blocks.sources)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return rows.withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")})


def divergence(docs: DataFrame, least: int = 30, top: int = 50, levels: Levels = Levels(), blocks: Blocks = Blocks()) -> DataFrame:
    """How the sources of each ``lang`` differ: ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    ``docs``: ``text``, ``lang``, ``source``, NULL being the empty text; other columns aren't read, repeated rows are
    documents of their own. Words are runs of letters and what lies outside ASCII, A-Z in lower case; those count
    that ``least`` documents of the language hold. A word's share in a group is 1 + floor(10**9 * (count + 5) /
    (all counts + 5 * words)). Part ``pair``: for each other source the sum of the shares' differences, 0 where no word
    counts. Part ``term``: the ``top`` words whose share exceeds that in the whole language, and by how much. Ranks go by
    value, largest first, then by item. Empty tables have no rows; a language's only source has no pairs.
    """
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    kept = stored(common_words(named, least, levels), "kept-words")
    bits = docs.sparkSession.sparkContext.broadcast(bit_map(kept.select("key"), levels.filter_bits))
    seen = counted(named, ["lang", "source"], _kept_only(bits), False, levels.held)
    sums = seen.groupBy("lang", "source", "word").agg(F.sum("n").alias("n"))
    listed = kept.select("lang", "word")
    counts = stored(sums.join(checked(listed, "listed", F.octet_length("word") + 24), ["lang", "word"]), "counts")

    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"))
    groups = named.groupBy("lang", "source").agg(F.count("*").alias("n_docs")).drop("n_docs")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    place = Window.partitionBy("lang").orderBy("source")
    facts = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0, ["total", "v"])
    facts = facts.withColumns(
        {"number": (F.row_number().over(place) - 1).cast("long"), "sources": F.count("*").over(Window.partitionBy("lang")),
         "word_blocks": F.greatest(F.lit(1), F.ceil(F.col("v") / blocks.words)).cast("int")}
    )
    facts = checked(facts, "groups", F.octet_length("lang") + F.octet_length("source") + 64)
    shared = stored(counts.join(facts, ["lang", "source"]).withColumn("p", _share("n", "total", "v")), "shares")

    whole = counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    lang_totals = checked(counts.groupBy("lang").agg(F.sum("n").alias("total")).join(sizes, "lang"), "langs", F.octet_length("lang") + 24)
    usual = whole.join(lang_totals, "lang").select("lang", "word", _share("n", "total", "v").alias("q"))
    above = shared.join(usual, ["lang", "word"]).where("p > q").withColumn("value", F.expr("p - q"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "word")
    terms = above.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("word").alias("item"), "value", "rank")

    word_block = F.pmod(F.xxhash64("word"), F.col("word_blocks")).cast("int")
    held = kept.join(facts.select("lang", "word_blocks").distinct(), "lang").groupBy("lang", word_block.alias("word_block")).agg(F.count("*").alias("words"))
    lacking = facts.withColumn("p", F.when(F.col("v") > 0, _share(F.lit(0), "total", "v")).otherwise(0))
    lacking = lacking.withColumns({"word": F.lit(None).cast("string"), "word_block": F.explode(F.sequence(F.lit(0), F.col("word_blocks") - 1))})
    lacking = lacking.join(checked(held, "word-blocks", 32), ["lang", "word_block"], "left").na.fill(0, ["words"])
    given = ["lang", "word_block", "number", "sources", "word", "p", "words"]
    having = shared.withColumns({"word_block": word_block, "words": F.lit(0).cast("long")})
    both = _met(lacking.select(*given).unionAll(having.select(*given)), blocks)
    at = ["lang", "word_block", "x", "y"]
    both = both.select(*at, "block", "number", "word", "p", "words")
    sums = shipped(both).groupBy(*at).applyInArrow(_pair_sums, "lang string, a long, b long, value long")
    pairs = stored(sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "pairs")
    names = facts.select("lang", "number", "source")
    pairs = pairs.unionAll(pairs.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    pairs = pairs.join(names.select("lang", F.col("number").alias("a"), "source"), ["lang", "a"])
    pairs = pairs.join(names.select("lang", F.col("number").alias("b"), F.col("source").alias("item")), ["lang", "b"])
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))
    return pairs.unionAll(terms)

