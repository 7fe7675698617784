"""N-gram Jaccard join by universe partition and the pigeonhole principle.

A document's set is that of its distinct shingles (hashes of five words). Two sets that are similar enough
differ in at most H = floor((1 - t) / (1 + t) * (|x| + |y|)) elements. The universe is cut by hash into
segments, as many for each band of sizes as its pairs need: if differences are fewer than segments, two
similar sets agree on a whole segment. Each document is filed under the part of its set in each segment
(its signature), in its own band and, if its partners may be smaller, in the band below.

Credit. A filed segment catches a pair that doesn't differ there: credit 1. In the bands of small sets,
where segments would be mostly empty, half as many are used and the one-deletion neighbourhood of a segment
is filed too, which also catches one difference: credit 2. The band takes what costs fewer entries and empty
segments. A document whose credits exceed H finds all its partners. Empty segments give no credit, nor
do hot ones, those that more than ``hot`` documents share: these are left out of the search. There are
more segments than H, so most documents can spare a few.

Documents left short of credit are joined among themselves on the rarest quarter of their shingles: two
similar sets share one of these (prefix filter). A pair that the segments miss has two such documents, so
no pair is missed. Where a rare shingle is still shared by many documents, all are compared with one of
them, which joins a group of copies; then only those that lie in different components are compared, a large
group in blocks, each pair of blocks by a task of its own.

Equal texts are one document to all this. Candidates are verified exactly on whole shingle sets, after a
bound that no similar pair fails: a set's shingles are dealt over at least twice as many buckets, and a bit says
whether a bucket has an odd number. Where the bits of two sets differ, so do the sets. A few bits per shingle thus
rule out nearly all pairs before whole sets move. Only links that connect are needed, so pairs already
connected are not compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefeed.llm import text as T
from tidefeed.llm.columns import with_columns
from tidefeed.llm.sharing import checked, components, release, shipped, stored

SIZE = 5
#: Similar: SHARE * intersection >= OF * union ... as whole numbers: 100 * intersection >= 75 * union.
OF, SHARE = 100, 75
_BLANKS = " \t\n\x0b\x0c\r"
#: A set has at least so many buckets for its bits.
LEAST_BITS = 128
_U = np.uint64


def most_different(a: int | np.ndarray, b: int | np.ndarray) -> int | np.ndarray:
    """The most elements in which similar sets of these sizes differ."""
    return (OF - SHARE) * (a + b) // (OF + SHARE)


def largest_partner(n: int | np.ndarray) -> int | np.ndarray:
    return n * OF // SHARE


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts: text number and hash, in order of both. A text of fewer words than a
    shingle has one, all of it; one without words has none."""
    w = T.words(data, offsets, T.NOT_BLANK)
    ok = T.whole_grams(w.first, SIZE)
    text = w.text_of()
    of, hashes = [text[: len(ok)][ok]], [T.gram_hash(w.hash, SIZE)[ok]]
    n = np.diff(w.first)
    for size in range(1, SIZE):
        short = np.flatnonzero(n == size)
        if len(short):
            first = w.first[short]
            of.append(short)
            hashes.append(T.mix(T.gram_hash(w.hash, size)[first] + T.salt(size)))
    of, hashes = np.concatenate(of), np.concatenate(hashes)
    order = np.lexsort((hashes, of))
    of, hashes = of[order], hashes[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])
    return of[new], hashes[new]


#: Lower bounds of the size bands, each 16/9 of the one before.
_EDGES = [1, 2, 3, 4, 6]
while _EDGES[-1] < 1 << 40:
    _EDGES.append(_EDGES[-1] * 16 // 9)
EDGES = np.array(_EDGES)


def band_plan(band: int) -> tuple[int, bool]:
    """Number of segments of a band, and whether one-deletion neighbourhoods are filed.

    Without deletions 1.1 times the most differences plus 2, so that a few may be empty or hot; with them
    about half. Deletions cost an entry for each element, but keep segments of small sets from being empty.
    """
    top = int(EDGES[band + 1]) - 1
    differences = int(most_different(top, largest_partner(top)))
    if top <= 48:
        return max(1, (differences + 3) // 2), True
    return differences * 11 // 10 + 2, False


def _filed(n: np.ndarray, of: np.ndarray, hashes: np.ndarray, band: np.ndarray, use: np.ndarray) -> tuple:
    """Entries (set number, signature) of the sets marked in ``use``, each in its ``band``; credits by set."""
    plans = [band_plan(b) for b in range(int(band.max(initial=0)) + 1)]
    count = np.array([p[0] for p in plans])
    deletes = np.array([p[1] for p in plans])
    mine = use[of]
    of, hashes = of[mine], hashes[mine]
    segment = (T.mix(hashes + T.salt(3)) >> _U(20)) % count[band[of]].astype(np.uint64)
    order = np.lexsort((segment, of))
    of, segment, value = of[order], segment[order], T.mix(hashes[order] + T.salt(5))
    start = np.ones(len(of), bool)
    start[1:] = (of[1:] != of[:-1]) | (segment[1:] != segment[:-1])
    at = np.flatnonzero(start)
    if not len(at):
        return at, np.zeros(0, np.uint64), np.zeros(len(n), np.int64)
    size = np.diff(np.concatenate([at, [len(of)]]))
    total = np.add.reduceat(value, at)
    place = T.mix(segment[at] + T.salt(7) + band[of[at]].astype(np.uint64) * T.salt(9))
    docs, sigs = [of[at]], [T.mix(total + place)]
    wide = deletes[band[of[at]]] & (size > 1)
    credit = np.bincount(of[at], 1 + wide, minlength=len(n)).astype(np.int64)
    if wide.any():
        each = np.repeat(np.arange(len(at)), size)
        pick = wide[each]
        docs.append(of[pick])
        sigs.append(T.mix(total[each[pick]] - value[pick] + place[each[pick]]))
    return np.concatenate(docs), np.concatenate(sigs), credit


def entries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Set sizes, text number and signature of all entries, and the credit each set can spare (< 0: short)."""
    of, hashes = shingle_sets(data, offsets)
    n = np.bincount(of, minlength=len(offsets) - 1)
    band = np.searchsorted(EDGES, np.maximum(n, 1), "right") - 1
    low = EDGES[band]
    below = (n > 1) & ((low - 1) * OF >= n * SHARE) & (n > 0)
    docs, sigs, credit = _filed(n, of, hashes, band, n > 0)
    spare = credit - most_different(n, largest_partner(n)) - 1
    docs2, sigs2, credit2 = _filed(n, of, hashes, np.maximum(band - 1, 0), below)
    spare2 = np.where(below, credit2 - most_different(n, low - 1) - 1, spare)
    spare = np.where(n > 0, np.minimum(spare, spare2), 0)
    return n, np.concatenate([docs, docs2]), np.concatenate([sigs, sigs2]), spare


def _split(values: np.ndarray, of: np.ndarray, n: int) -> list[np.ndarray]:
    order = np.argsort(of, kind="stable")
    return np.split(values[order], np.searchsorted(of[order], np.arange(1, n)))


def _sizes(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    of, _ = shingle_sets(data, offsets)
    return [np.bincount(of, minlength=len(offsets) - 1)]


#: Of a spare entry's key: a bit that no signature has set, and so many for the credit to spare.
_SPARE_BITS = 20


def _signatures(data: np.ndarray, offsets: np.ndarray) -> list:
    """Signatures as even numbers, and one odd number for each set, which holds what credit it can spare."""
    n, docs, sigs, spare = entries(data, offsets)
    held = np.flatnonzero(n > 0)
    half = 1 << (_SPARE_BITS - 1)
    low = np.clip(spare[held], -half, half - 1) + half
    spread = T.mix(np.arange(len(held), dtype=np.uint64) + T.mix(offsets[held + 1].astype(np.uint64))) << _U(_SPARE_BITS)
    odd = ((spread | low.astype(np.uint64)) << _U(1)) | _U(1)
    docs, sigs = np.concatenate([docs, held]), np.concatenate([sigs & ~_U(1), odd])
    return [_split(sigs.view(np.int64), docs, len(n))]


def _parities(data: np.ndarray, offsets: np.ndarray) -> list:
    """Sizes, and for each set the bits of its buckets: a power of two of them, two to four for each shingle."""
    of, hashes = shingle_sets(data, offsets)
    n = np.bincount(of, minlength=len(offsets) - 1)
    width = np.maximum(LEAST_BITS, 1 << np.ceil(np.log2(np.maximum(2 * n, 1))).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(width)])
    bucket = ((hashes >> _U(33)) % width[of].astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(first[of] + bucket, minlength=first[-1]) & 1).astype(np.uint8)
    words = np.packbits(odd, bitorder="little").view(np.int64)
    return [n, np.split(words, first[1:-1] // 64)]


def _halved(bits: Column) -> Column:
    """The bits over half as many buckets."""
    half = (F.size(bits) / 2).cast("int")
    return F.zip_with(F.slice(bits, 1, half), F.slice(bits, half + 1, half), lambda x, y: x.bitwiseXOR(y))


def _least_difference(a: str, b: str) -> Column:
    """A lower bound of how many elements two sets of similar sizes differ in."""
    left, right = F.col(a), F.col(b)
    x = F.when(F.size(left) > F.size(right), _halved(left)).otherwise(left)
    y = F.when(F.size(right) > F.size(left), _halved(right)).otherwise(right)
    differ = F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(differ, F.lit(0), lambda total, n: total + n)


def _full_sets(data: np.ndarray, offsets: np.ndarray) -> list:
    of, hashes = shingle_sets(data, offsets)
    m = len(offsets) - 1
    return [np.bincount(of, minlength=m), _split(hashes.view(np.int64), of, m)]


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts the keys; start and size of each group in it."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    at = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return order, at, np.diff(np.concatenate([at, [len(keys)]]))


def _small_pairs(docs: np.ndarray, at: np.ndarray, size: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs within the groups of 2 to ``most`` members, most being a small constant."""
    left, right = [], []
    for k in range(2, most + 1):
        members = docs[at[size == k][:, None] + np.arange(k)]
        i, j = np.triu_indices(k, 1)
        left.append(members[:, i].ravel())
        right.append(members[:, j].ravel())
    a, b = np.concatenate(left), np.concatenate(right)
    return np.minimum(a, b), np.maximum(a, b)


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ok = a != b
    order = np.lexsort((b[ok], a[ok]))
    a, b = a[ok][order], b[ok][order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


#: So many pairs and hot entries are gathered before they are put out, in batches of at most so many rows.
HELD, PART = 1 << 20, 1 << 16


def _candidates(hot: int, star: bool):
    """From entries ``key``, ``doc_id`` sorted by both: pairs ``a``, ``b``; for a hot entry ``a`` with NULL
    ``b``, ``n`` of them. With ``star``, members of a hot group are paired with its smallest.

    A group is held only up to the size at which it is hot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        lost: list[np.ndarray] = []
        waiting = 0
        keys = docs = np.zeros(0, np.int64)  # what has come of the last group, while it is small
        open_key, least = None, None  # of a hot group that may go on

        def put(members: np.ndarray, first: np.ndarray) -> None:
            lost.append(members)
            if star:
                pairs.append((first, members))

        def settle(keys: np.ndarray, docs: np.ndarray) -> None:
            _, at, size = _groups(keys)
            pairs.append(_distinct(*_small_pairs(docs, at, size, hot)))
            big = size > hot
            put(docs[np.repeat(big, size)], np.repeat(docs[at[big]], size[big]))

        for batch in batches:
            more_keys, more_docs = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if open_key is not None:
                n = int(np.searchsorted(more_keys, open_key, "right"))
                put(more_docs[:n], np.full(n, least))
                waiting += n
                more_keys, more_docs = more_keys[n:], more_docs[n:]
            if len(more_keys):
                keys, docs = np.concatenate([keys, more_keys]), np.concatenate([docs, more_docs])
                cut = int(np.searchsorted(keys, keys[-1], "left"))
                settle(keys[:cut], docs[:cut])
                waiting += len(pairs[-1][0]) + cut
                keys, docs, open_key = keys[cut:], docs[cut:], None
                if len(keys) > hot:
                    open_key, least = keys[0], docs[0]
                    put(docs, np.full(len(docs), least))
                    waiting += len(docs)
                    keys = docs = np.zeros(0, np.int64)
            if waiting > HELD:
                yield from _in_parts(_put_out(pairs, lost))
                pairs, lost, waiting = [], [], 0
        settle(keys, docs)
        yield from _in_parts(_put_out(pairs, lost))

    return run


_FOUND = "a long, b long, n long, spare long"


def _candidates_and_spares(hot: int):
    """``_candidates`` of the even keys; odd ones say what credit a document ``a`` can ``spare``, with NULL ``b`` and ``n``."""
    candidates = _candidates(hot, star=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spares: list[pa.RecordBatch] = []

        def entries() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                odd = (batch.column(0).to_numpy() & 1) == 1
                spares.append(_spared(batch.filter(pa.array(odd))))
                yield batch.filter(pa.array(~odd))

        for found in candidates(entries()):
            yield from spares
            spares.clear()
            yield found.append_column("spare", pa.nulls(found.num_rows, pa.int64()))

    return run


def _spared(entries: pa.RecordBatch) -> pa.RecordBatch:
    held = (entries.column(0).to_numpy().view(np.uint64) >> _U(1)) & _U((1 << _SPARE_BITS) - 1)
    nothing = pa.nulls(len(held), pa.int64())
    columns = [entries.column(1), nothing, nothing, pa.array(held.astype(np.int64) - (1 << (_SPARE_BITS - 1)))]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b", "n", "spare"])


def _in_parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices, as the executor holds a whole batch outside its heap."""
    for at in range(0, batch.num_rows, PART):
        yield batch.slice(at, PART)


def _put_out(pairs: list[tuple[np.ndarray, np.ndarray]], lost: list[np.ndarray]) -> pa.RecordBatch:
    a, b = _distinct(*(np.concatenate(x).astype(np.int64) for x in zip(*pairs)))
    members, n = np.unique(np.concatenate(lost), return_counts=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([a, members])),
            pa.array(np.concatenate([b, np.zeros(len(members), np.int64)]), mask=np.arange(len(a) + len(members)) >= len(a)),
            pa.array(np.concatenate([np.zeros(len(a), np.int64), n])),
        ],
        names=["a", "b", "n"],
    )


#: Groups of more documents are compared in blocks of about so many.
BLOCK = 1024


def _dealt(met: DataFrame, block: int) -> DataFrame:
    """The rows of each ``key``, ``k`` of them, dealt over pairs of blocks ``x`` <= ``y``; ``own`` is a row's
    block. Each row comes once for each block, so two documents meet in one pair of blocks across, or in
    one where both are that block's own."""
    blocks = F.ceil(F.col("k") / F.lit(block)).cast("int")
    cut = met.withColumn("own", F.pmod(F.xxhash64("doc_id", F.lit(17)), blocks.cast("long")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return cut.withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other")}).drop("k", "other")


#: Ranges of sizes grow by this factor, more than similar sets may differ by, so these lie in one range or in two adjacent ones.
_RANGE = 1.4


def _of_like_size(held: DataFrame) -> DataFrame:
    """The rows ``key``, ``doc_id``, ``root``, ``n``, once for the range of their size (``sizes``) and once for the next, so that two
    documents of a key that may be similar share a range, which is that of the larger one's size; ranges that hold no other root, or
    no document of their own sizes, are left out. ``k`` is how many share key and range."""
    size = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(_RANGE))).cast("int")
    held = held.withColumn("at", size).withColumn("sizes", F.explode(F.array("at", F.col("at") + 1)))
    groups = held.groupBy("key", "sizes").agg(
        F.count("*").alias("k"), F.min("root").alias("r0"), F.max("root").alias("r1"), F.max("at").alias("top")
    )
    return held.drop("at").join(groups.where("r0 < r1 and top = sizes").select("key", "sizes", "k"), ["key", "sizes"])


_AT = ("key", "x", "y")


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of different roots that sizes and bits do not rule out.

    From entries ``key``, ``x``, ``y``, ``own``, ``doc_id``, ``root``, ``n``, ``bits``, ``keys``, sorted by
    the first three. Only one pair of blocks is held at a time. A pair that meets under several keys comes
    from the smallest of them.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        at = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(len(_AT))], axis=1)
        cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1), len(at)]
        for a, b in zip(cuts, cuts[1:]):
            if held and last != tuple(at[a]):
                yield from _pairs_across(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = tuple(at[a])
    if held:
        yield from _pairs_across(held)


def _pairs_across(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    group = pa.Table.from_batches(held)
    key, x, y = (group.column(i)[0].as_py() for i in range(3))
    if x < y:  # those of the first block, then those of the other
        group = group.take(pa.array(np.argsort(group.column(3).to_numpy(), kind="stable")))
    own, docs, roots, sizes = (group.column(i).to_numpy() for i in (3, 4, 5, 6))
    if (roots == roots[0]).all():
        return
    levels = _by_width(group.column(7).combine_chunks())
    lists = group.column(8).combine_chunks()
    of, flat = np.repeat(np.arange(len(docs)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
    of, flat = of[flat < key], flat[flat < key]  # the smaller keys of each document
    names, at, n = np.unique(flat, return_inverse=True, return_counts=True)
    of, at = of[n[at] > 1], at[n[at] > 1]
    begin = np.searchsorted(of, np.arange(len(docs) + 1))
    mark, met = np.zeros(len(names), bool), np.zeros(len(docs), bool)
    split = int(np.searchsorted(own, y)) if x < y else 0
    for i in range(split if x < y else len(docs) - 1):
        rest = slice(split if x < y else i + 1, None)
        least, most = np.minimum(sizes[i], sizes[rest]), np.maximum(sizes[i], sizes[rest])
        j = np.flatnonzero((roots[rest] != roots[i]) & (OF * least >= SHARE * most) & (docs[rest] != docs[i])) + rest.start
        if not len(j):
            continue
        mine = at[begin[i] : begin[i + 1]]
        if len(mine):
            mark[mine] = True
            sharing = of[mark[at]]
            mark[mine] = False
            met[sharing] = True
            j = j[~met[j]]
            met[sharing] = False
        j = j[(OF + SHARE) * _differences(levels, i, j) <= (OF - SHARE) * (sizes[i] + sizes[j])]
        if len(j):
            ends = np.minimum(docs[i], docs[j]), np.maximum(docs[i], docs[j])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in ends], names=["a", "b"])


def _by_width(bits: pa.ListArray) -> tuple[np.ndarray, np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Of sets with their bits: how many words each has, its place among those of the same width, and by width their
    words and those over half as many buckets."""
    width, flat = bits.value_lengths().to_numpy(), bits.flatten().to_numpy().view(np.uint64)
    first, place, tables = np.concatenate([[0], np.cumsum(width)]), np.zeros(len(width), np.int64), {}
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        place[at] = np.arange(len(at))
        words = flat[first[at][:, None] + np.arange(w)]
        tables[w] = words, words[:, : w // 2] ^ words[:, w // 2 :]
    return width, place, tables


def _differences(levels: tuple, i: int, j: np.ndarray) -> np.ndarray:
    """A lower bound of how many elements set ``i`` and each of the sets ``j`` of similar sizes differ in."""
    width, place, tables = levels
    mine, out = tables[width[i]], np.zeros(len(j), np.int64)
    for w in np.unique(width[j]).tolist():
        at = np.flatnonzero(width[j] == w)
        theirs = tables[w]
        a = mine[1 if width[i] > w else 0][place[i]]
        b = theirs[1 if w > width[i] else 0][place[j[at]]]
        out[at] = np.bitwise_count(a ^ b).sum(axis=1)
    return out


def _side(sets: DataFrame, name: str, *columns: str) -> DataFrame:
    return sets.select(F.col("doc_id").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in columns))


def _ends(pairs: DataFrame) -> DataFrame:
    """The documents of the pairs, to read no other's text."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    return checked(ends, "ends", 16)


def _near(pairs: DataFrame, singles: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` that sizes and bits do not rule out."""
    texts = singles.join(_ends(pairs), "doc_id", "left_semi")
    sets = stored(with_columns(texts, ["doc_id"], "n long, bits array<bigint>", _parities), "bits")
    least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    return (
        pairs.join(_side(sets, "a", "n", "bits"), "a")
        .join(_side(sets, "b", "n", "bits"), "b")
        .where(OF * least >= SHARE * most)
        .where((OF + SHARE) * _least_difference("bits_a", "bits_b") <= (OF - SHARE) * (F.col("n_a") + F.col("n_b")))
        .select("a", "b")
        .distinct()
    )


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets are similar. Only sets that are met move."""
    shared = F.size(F.array_intersect("set_a", "set_b"))
    met = {end: checked(pairs.select(F.col(end).alias("doc_id")).distinct(), "met", 16) for end in ("a", "b")}
    a, b = (sets.join(met[end], "doc_id", "left_semi") for end in ("a", "b"))
    return (
        pairs.join(_side(a, "a", "set", "n"), "a")
        .join(_side(b, "b", "set", "n"), "b")
        .where(OF * shared >= SHARE * (F.col("n_a") + F.col("n_b") - shared))
        .select("a", "b")
    )


def _connecting(near: DataFrame, singles: DataFrame) -> DataFrame:
    """Enough similar pairs of the candidates ``near`` to connect all that they connect.

    First each document is compared with the smallest of its candidates, which joins groups of copies by
    one comparison each; then the pairs whose ends are not connected yet.
    """
    texts = singles.join(_ends(near), "doc_id", "left_semi")
    sets = stored(with_columns(texts, ["doc_id"], "n long, set array<bigint>", _full_sets), "sets")
    least = stored(near.groupBy("b").agg(F.min("a").alias("a")), "least")
    first = stored(_similar(least, sets), "linked-first")
    release(near.sparkSession)
    roots = components(first, "a", "b")
    for end in ("a", "b"):
        near = near.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
    apart = near.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")
    apart = stored(apart.join(least, ["a", "b"], "left_anti"), "apart")
    linked = stored(first.unionAll(_similar(apart, sets)), "linked")
    release(near.sparkSession)
    return linked


def _prefixes(order: np.ndarray | None):
    """The first quarter of each set in an order of all shingles: by how many documents share their slot
    (in powers of two), then by hash."""

    def compute(data: np.ndarray, offsets: np.ndarray) -> list:
        of, hashes = shingle_sets(data, offsets)
        n = np.bincount(of, minlength=len(offsets) - 1)
        rank = order.value[(hashes & _U(_SLOTS - 1)).astype(np.int64)]
        by = np.lexsort((hashes, rank, of))
        first = np.concatenate([[0], np.cumsum(n)])
        need = n - (SHARE * n + OF - 1) // OF + 1
        take = by[np.arange(len(by)) - np.repeat(first[:-1], n) < np.repeat(need, n)]
        return [n, _split(hashes[take].view(np.int64), of[take], len(n))]

    return compute


_SLOTS = 1 << 16


def _slot_counts(docs: DataFrame) -> np.ndarray:
    """How many of the documents' shingles fall in each of 65,536 slots, rounded to powers of two."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(_SLOTS, np.int64)
        for batch in batches:
            data, offsets = T.text_buffers(batch.column(0))
            for a, b in T.groups(offsets):
                _, hashes = shingle_sets(data, offsets[a : b + 1])
                out += np.bincount((hashes & _U(_SLOTS - 1)).astype(np.int64), minlength=_SLOTS)
        slot = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(out[slot])], names=["slot", "n"])

    found = shipped(docs.select("text")).mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(_SLOTS, np.int64)
    out[found["slot"].to_numpy()] = found["n"].to_numpy()
    return np.ceil(np.log2(out + 1) * 2).astype(np.int16)


def _entries(docs: DataFrame, lists: str) -> DataFrame:
    return docs.select(F.explode(lists).alias("key"), "doc_id").repartition("key").sortWithinPartitions("key", "doc_id")


def links(docs: DataFrame, hot: int = 8) -> DataFrame:
    """Enough links ``a`` < ``b`` of similar documents to connect all that are connected.

    ``docs``: ``doc_id`` and ``text``, neither NULL, texts with words.
    """
    digest = F.unhex(F.sha2("text", 256))
    keyed = docs.select("doc_id", "text", digest.alias("digest"))
    twins = keyed.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    twins = checked(twins.drop("n"), "twins", 72)
    marked = keyed.join(twins, "digest", "left")
    copies = marked.where("doc_id != first").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    singles = marked.where("first is null or doc_id = first").select("doc_id", "text")

    filed = with_columns(singles, ["doc_id"], "sigs array<bigint>", _signatures)
    found = stored(_entries(filed, "sigs").mapInArrow(_candidates_and_spares(hot), _FOUND), "segment-pairs")
    release(docs.sparkSession)
    credit = found.where("b is null").groupBy(F.col("a").alias("doc_id"))
    credit = credit.agg(F.sum("n").alias("lost"), F.min("spare").alias("spare"))
    # A hot entry of a band with deletions costs two credits at most.
    short = credit.where("spare < 2 * coalesce(lost, 0)").select("doc_id")
    short = checked(short, "short-of-credit", 16)

    rest = stored(singles.join(short, "doc_id", "left_semi"), "rest")
    order = docs.sparkSession.sparkContext.broadcast(_slot_counts(rest))
    prefixes = with_columns(rest, ["doc_id"], "n long, tokens array<bigint>", _prefixes(order))
    prefixes = stored(prefixes, "prefixes")
    more = stored(
        _entries(prefixes, "tokens").mapInArrow(_candidates(2 * hot, star=True), "a long, b long, n long"), "prefix-pairs"
    )
    pairs = stored(found.drop("spare").unionAll(more).where("b is not null").select("a", "b").distinct(), "pairs")
    near = stored(_near(pairs, singles), "near")
    release(docs.sparkSession)
    linked = _connecting(near, singles)
    roots = components(linked, "a", "b").select(F.col("node").alias("doc_id"), "root")
    rooted = prefixes.join(roots, "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    held = rooted.select(F.explode("tokens").alias("key"), "doc_id", "root", "n")
    mixed = held.groupBy("key").agg(F.count("*").alias("k"), F.min("root").alias("r0"), F.max("root").alias("r1"))
    mixed = mixed.where(f"k > {2 * hot} and r0 < r1").select("key")
    met = stored(_of_like_size(held.join(mixed, "key")), "mixed")
    keys = met.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))
    texts = rest.join(checked(met.select("doc_id").distinct(), "mixed-docs", 16), "doc_id", "left_semi")
    bits = with_columns(texts, ["doc_id"], "size long, bits array<bigint>", _parities).drop("size")
    met = met.join(keys, "doc_id").join(bits, "doc_id")
    met = _dealt(met.select("key", "k", "doc_id", "root", "n", "bits", "keys", "sizes"), BLOCK)
    met = met.withColumns({c: F.col(c) + F.shiftleft("sizes", 20) for c in ("own", "x", "y")})  # blocks of one range of sizes
    smaller = F.filter("keys", lambda k: k < F.col("key")).alias("keys")  # a block looks at no others
    met = met.select(*_AT, "own", "doc_id", "root", "n", "bits", smaller)
    across = met.repartition(*_AT).sortWithinPartitions(*_AT).mapInArrow(_across, "a long, b long")
    late = _connecting(stored(across.distinct(), "across"), singles)
    return copies.unionAll(linked).unionAll(late)


def similar_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest ``doc_id``
    reachable by links. See the head of this module for what a link is and how links are found.

    NULL and empty texts and those without words have no shingles and link with nothing. Rows that repeat
    a ``doc_id`` are one node: it has the links of all its texts, and each row its own ``n_shingles``. A row
    without ``doc_id`` links with nothing and has no component. Other columns aren't read.
    """
    sized = with_columns(docs, ["doc_id"], "n_shingles long", _sizes)
    usable = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    usable = usable.where(F.length(F.trim("text", F.lit(_BLANKS))) > 0)
    roots = components(links(usable), "a", "b")
    roots = checked(roots.select(F.col("node").alias("doc_id"), "root"), "roots", 24)
    return sized.join(roots, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id")
    )
