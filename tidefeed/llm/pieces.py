"""SentencePiece encoding and decoding: distinct sampled segmentations without replacement.

The model file gives the pieces; a piece's probability falls with its rank (Zipf), as the models of merges
hold ranks and no probabilities. A text's segmentations are the paths of its lattice. Each path's log
probability plus Gumbel noise is its perturbed score; the ``k`` best paths are ``k`` draws without
replacement. They are found by an A-star search from the top: the root has the largest perturbed score
of all, and whenever a set of paths is split, one part keeps the maximum and the others draw theirs below
it. The agenda holds for each node of each emitted path the set of paths that leave it there, with that
set's exact maximum, so the best entry is the next path, and nothing is explored in vain.

Pieces don't cross from one blank-separated chunk to the next, so lattices are built once for each distinct
chunk of a group of texts. All texts of a group walk through their lattices in step, in numpy. Noise
depends on the row key, the sample's number and the position, and on nothing else.

Texts are taken as they are: no normalisation but a blank put before the text, and characters without a
piece are sent as bytes. Decoding gives back every text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefeed.functions import col
from tidefeed.llm import text as T
from tidefeed.llm.columns import mapped

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Texts of about so many bytes walk together, which bounds the memory of a task.
WALK_BYTES = 1 << 18
_U = np.uint64


class Pieces(NamedTuple):
    """Surfaces by id (None for control pieces), byte ids, and the prefixes of all surfaces: their hashes in
    order, and the piece that each is, or -1."""

    surfaces: list[bytes | None]
    byte_id: np.ndarray
    prefixes: np.ndarray
    piece_at: np.ndarray
    slots: np.ndarray
    log_p: np.ndarray
    longest: int


def _hash_of(parts: Sequence[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(parts), np.uint8)
    end = np.cumsum([len(p) for p in parts])
    return T.span_hash(data, np.concatenate([[0], end[:-1]]), end, T.EXACT)


@lru_cache(maxsize=4)
def load(model: bytes, flatten: float = 1.0) -> Pieces:
    """The pieces of a model file's content. ``flatten`` below 1 makes rare pieces likelier."""
    import sentencepiece

    reader = sentencepiece.SentencePieceProcessor(model_proto=model)
    n = reader.vocab_size()
    surfaces: list[bytes | None] = [None] * n
    byte_id, rank = np.full(256, -1), np.full(n, float(n))
    for i in range(n):
        if reader.is_byte(i):
            byte_id[int(reader.id_to_piece(i)[1:-1], 16)] = i
        elif not (reader.is_control(i) or reader.is_unknown(i) or reader.is_unused(i)):
            surfaces[i] = reader.id_to_piece(i).replace("▁", " ").encode()
            rank[i] = -reader.get_score(i)
    if (byte_id < 0).any():
        raise ValueError("the model has no byte pieces")
    log_p = -flatten * np.log(rank + 10)
    log_p -= np.log(np.exp(log_p).sum())
    starts: dict[bytes, int] = {}
    for i, s in enumerate(surfaces):
        if s:
            chars = s.decode()
            for size in range(1, len(chars)):
                starts.setdefault(chars[:size].encode(), -1)
            starts[s] = i
    keys = list(starts)
    hashes = _hash_of(keys)
    order = np.argsort(hashes)
    longest = max(len(s.decode()) for s in surfaces if s)
    hashes = hashes[order]
    return Pieces(surfaces, byte_id, hashes, np.array(list(starts.values()))[order], _slots(hashes), log_p, longest)


_SLOT_BITS = 18


def _slots(keys: np.ndarray) -> np.ndarray:
    """Where the sorted keys begin that share their top bits."""
    tops = np.arange((1 << _SLOT_BITS) + 1, dtype=np.uint64)
    return np.searchsorted(keys >> _U(64 - _SLOT_BITS), tops).astype(np.int32)


def _look_up(p: Pieces, wanted: np.ndarray) -> np.ndarray:
    """Place of each hash among the prefixes, -1 where it is not there."""
    top = (wanted >> _U(64 - _SLOT_BITS)).astype(np.int64)
    at, stop = p.slots[top].astype(np.int64), p.slots[top + 1]
    out = np.full(len(wanted), -1)
    on = np.flatnonzero(at < stop)
    while len(on):
        hit = p.prefixes[at[on]] == wanted[on]
        out[on[hit]] = at[on[hit]]
        on = on[~hit]
        at[on] += 1
        on = on[at[on] < stop[on]]
    return out


def decode(ids: Sequence[int], pieces: Pieces) -> str:
    """The text of a sequence of ids."""
    of_byte = {int(i): bytes([b]) for b, i in enumerate(pieces.byte_id)}
    data = b"".join(of_byte[i] if i in of_byte else pieces.surfaces[i] or b"" for i in map(int, ids))
    return data.decode("utf-8", "replace").removeprefix(" ")


class Lattice(NamedTuple):
    """Nodes are numbered through all chunks; edges are sorted by node. ``cdf`` cumulates
    the shares of a node's edges."""

    base: np.ndarray
    is_end: np.ndarray
    offset: np.ndarray
    first: np.ndarray
    source: np.ndarray
    target: np.ndarray
    piece: np.ndarray
    share: np.ndarray
    cdf: np.ndarray


def lattice(data: np.ndarray, start: np.ndarray, end: np.ndarray, p: Pieces) -> Lattice:
    """Lattices of the chunks that the spans name, back to back in ``data``."""
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    chunk = np.searchsorted(start, heads, "right") - 1
    n_chars = np.bincount(chunk, minlength=len(start))
    first_char = np.concatenate([[0], np.cumsum(n_chars)])
    base = first_char[:-1] + np.arange(len(start))
    n_nodes = len(heads) + len(start)
    node = np.arange(len(heads)) + chunk
    left = first_char[chunk + 1] - np.arange(len(heads))  # characters to the end of the chunk
    bounds = np.concatenate([heads, [len(data)]])
    alive = np.arange(len(heads))
    us, vs, ids = [], [], []
    single = np.zeros(len(heads), bool)
    for size in range(1, p.longest + 1):
        alive = alive[left[alive] >= size]
        if not len(alive):
            break
        look = _look_up(p, T.span_hash(data, heads[alive], bounds[alive + size], T.EXACT))
        alive, look = alive[look >= 0], look[look >= 0]
        piece = p.piece_at[look]
        is_piece = piece >= 0
        us.append(node[alive[is_piece]])
        vs.append(node[alive[is_piece]] + size)
        ids.append(piece[is_piece])
        if size == 1:
            single[alive[is_piece]] = True
    lone = np.flatnonzero(~single)  # sent as bytes; the edge keeps its place in the data
    us.append(node[lone])
    vs.append(node[lone] + 1)
    ids.append(-1 - heads[lone])
    # Long pieces first, as they tend to be the likely ones, which a walk then meets soon. A node has one piece of
    # each length at most, so each length fills one more place of its nodes.
    first = np.zeros(n_nodes + 1, np.int64)
    for u in us:
        first[u + 1] += 1
    np.cumsum(first, out=first)
    free, order = first[:-1].copy(), np.empty(first[-1], np.int64)
    stops = np.cumsum([len(u) for u in us])
    for u, stop in zip(us[::-1], stops[::-1]):
        order[free[u]] = np.arange(stop - len(u), stop)
        free[u] += 1
    u, v, piece = (np.concatenate(x)[order] for x in (us, vs, ids))
    width = np.zeros(len(data), np.int64)
    width[heads] = np.diff(bounds)
    log_w = np.where(piece >= 0, p.log_p[np.maximum(piece, 0)], 0)
    bytewise = piece < 0
    log_w[bytewise] = p.log_p[p.byte_id[0]] * width[-1 - piece[bytewise]]
    beta = np.zeros(n_nodes)
    # From the ends of the chunks backward: all nodes of one distance together.
    edge_left = np.zeros(n_nodes, np.int64)
    edge_left[node] = left
    edge_left = edge_left[u]
    furthest = int(left.max(initial=0))
    by = np.argsort(edge_left.astype(np.int16) if furthest < 1 << 15 else edge_left, kind="stable")
    cuts = np.searchsorted(edge_left[by], np.arange(1, furthest + 2))
    from_node, to_node, weight = u[by], v[by], log_w[by]
    new = np.ones(len(by), bool)
    new[1:] = from_node[1:] != from_node[:-1]  # a node's edges are all of one distance
    heads_of = np.flatnonzero(new)
    groups = np.searchsorted(heads_of, cuts)
    for d in range(len(cuts) - 1):
        a, b = cuts[d], cuts[d + 1]
        value = weight[a:b] + beta[to_node[a:b]]
        at = heads_of[groups[d] : groups[d + 1]] - a
        top = np.maximum.reduceat(value, at)
        total = np.add.reduceat(np.exp(value - np.repeat(top, np.diff(np.append(at, b - a)))), at)
        beta[from_node[a + at]] = top + np.log(total)
    share = np.exp(log_w + beta[v] - beta[u])
    total = np.concatenate([[0.0], np.cumsum(share)])
    cdf = total[1:] - total[first[u]]
    cdf[first[1:][np.diff(first) > 0] - 1] = 1.0  # the last edge of a node takes what rounding leaves
    is_end = np.zeros(n_nodes, bool)
    is_end[base + n_chars] = True
    offset = np.zeros(n_nodes, np.int64)
    offset[node] = heads - start[chunk]
    return Lattice(base, is_end, offset, first, u, v, piece, share, cdf)


#: Lattices are built for so many bytes of chunks at a time, whose arrays fit a processor's cache.
LATTICE_BYTES = 1 << 16


def lattices(data: np.ndarray, bounds: np.ndarray, p: Pieces) -> Lattice:
    """As ``lattice`` for the chunks between the ``bounds``, built block by block."""
    parts, nodes, edges = [], 0, 0
    for a, b in T.groups(bounds, LATTICE_BYTES):
        lat = lattice(data[bounds[a] : bounds[b]], bounds[a:b] - bounds[a], bounds[a + 1 : b + 1] - bounds[a], p)
        piece = np.where(lat.piece < 0, lat.piece - bounds[a], lat.piece)
        first = lat.first + edges if not parts else lat.first[1:] + edges
        parts.append(Lattice(lat.base + nodes, lat.is_end, lat.offset, first, lat.source + nodes, lat.target + nodes, piece, lat.share, lat.cdf))
        nodes, edges = nodes + len(lat.offset), edges + len(piece)
    return Lattice(*map(np.concatenate, zip(*parts, strict=True)))


def _uniform(key: np.ndarray) -> np.ndarray:
    return ((T.mix(key) >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53


class Walk(NamedTuple):
    """Steps of paths in order: occurrence of a chunk and edge."""

    occ: np.ndarray
    edge: np.ndarray


def walk(lat: Lattice, occ: np.ndarray, node: np.ndarray, key: np.ndarray, place: np.ndarray) -> Walk:
    """From a node of each occurrence (in order) to the end of its chunk, along random edges.

    ``key`` and ``place`` are given by occurrence number: the seed, and where in its text the chunk begins.
    """
    occs, edges, steps = [], [], []
    active, at, t = np.arange(len(occ)), node, 0
    going = ~lat.is_end[at]
    active, at = active[going], at[going]
    count = np.zeros(len(occ), np.int64)
    while len(active):
        o = occ[active]
        r = _uniform(key[o] + (place[o] + lat.offset[at]).astype(np.uint64) * T.salt(1))
        e = lat.first[at]
        on = np.flatnonzero(lat.cdf[e] < r)
        while len(on):
            e[on] += 1
            on = on[lat.cdf[e[on]] < r[on]]
        occs.append(active)
        edges.append(e)
        count[active] += 1
        at = lat.target[e]
        going = ~lat.is_end[at]
        active, at, t = active[going], at[going], t + 1
    begin = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(begin[-1], np.int64)
    for t, (a, e) in enumerate(zip(occs, edges, strict=True)):
        out[begin[a] + t] = e
    return Walk(np.repeat(occ, count), out)


def gumbel_below(log_mass: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The largest perturbed score of a set of paths with this mass, given that it is below ``top``."""
    with np.errstate(divide="ignore", invalid="ignore"):
        out = log_mass - np.log(np.exp(np.minimum(log_mass - top, 700)) - np.log(u))
    return np.where(np.isneginf(log_mass), -np.inf, out)


class Sample(NamedTuple):
    ids: np.ndarray
    log_p: float
    score: float
    inclusion: float


def chunks_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the chunks: a blank after something else begins one, a line feed is one."""
    blank, feed = data == 32, data == 10
    begin = blank.copy()
    begin[1:] &= ~blank[:-1]
    begin |= feed
    begin[1:] |= feed[:-1]
    begin[offsets[:-1][offsets[:-1] < len(data)]] = True
    start = np.flatnonzero(begin)
    return start, np.concatenate([start[1:], [len(data)]]) if len(start) else start


def sample_texts(data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray, p: Pieces, k: int) -> list[list[Sample]]:
    """The samples of each text, best perturbed score first."""
    n = len(offsets) - 1
    # Put a blank before each text that isn't empty.
    length = np.diff(offsets)
    shift = np.cumsum(length > 0)
    data, old = np.full(int(length.sum() + shift[-1]) if n else 0, 32, np.uint8), data[offsets[0] : offsets[-1]]
    new_offsets = np.concatenate([[0], np.cumsum(length) + shift])
    data[np.arange(len(old)) + np.repeat(shift, length)] = old
    offsets = new_offsets
    start, end = chunks_of(data, offsets)
    if not len(start):
        return [[] for _ in range(n)]
    hashes = T.span_hash(data, start, end, T.EXACT)
    _, one, kind = np.unique(hashes, return_index=True, return_inverse=True)
    spans = end[one] - start[one]
    where = np.concatenate([[0], np.cumsum(spans)])
    chunk_data = data[np.arange(where[-1]) - np.repeat(where[:-1] - start[one], spans)]
    lat = lattices(chunk_data, where, p)
    text = np.searchsorted(offsets, start, "right") - 1
    first_occ = np.searchsorted(text, np.arange(n + 1))
    place = start - offsets[text]
    texts = np.flatnonzero(np.diff(first_occ) > 0)

    def keyed(number: int) -> np.ndarray:
        return T.mix(seeds + T.salt(number * 4 + 1))[text]

    tops = np.full(n, -np.inf)
    tops[texts] = -np.log(-np.log(_uniform(T.mix(seeds[texts] + T.salt(2)))))
    chunk_node = lat.base[kind]
    path = walk(lat, np.arange(len(start)), chunk_node, keyed(0), place)
    done = [_settled(lat, path, text, n, np.zeros(len(path.edge), bool), tops, keyed(0), place)]
    samples: list[list[tuple]] = [[] for _ in range(n)]
    for i in texts:
        samples[i].append((0, tops[i]))
    excluded: dict[tuple[int, int], list[int]] = {}
    for number in range(1, k + 1):
        best = np.full(n, -np.inf)
        of = np.zeros(n, np.int64)
        for s, d in enumerate(done):
            held = np.flatnonzero(np.diff(d.first) > 0)
            if len(held):
                top = np.maximum.reduceat(d.rest, d.first[held])
                better = top > best[held]
                best[held[better]], of[held[better]] = top[better], s
        if number == k:
            break
        prefix_occ, prefix_edge, cont_occ, cont_node = [], [], [], []
        alive = np.flatnonzero(best > -np.inf)
        draw, noise = (_uniform(seeds + T.salt(number * 4 + j)) for j in (2, 3))
        places, masses = [], []
        for i in alive.tolist():
            d = done[of[i]]
            a, b = d.first[i], d.first[i + 1]
            at = int(a + d.rest[a:b].argmax())
            node = d.node[at]
            lo, hi = lat.first[node], lat.first[node + 1]
            out = excluded.setdefault((int(of[i]), at), [int(d.edge[at])])
            share = lat.share[lo:hi].copy()
            for edge in out:
                share[edge - lo] = 0.0
            run = share.cumsum()
            pick = int(lo + min(run.searchsorted(draw[i] * run[-1]), share.nonzero()[0][-1]))
            out.append(pick)
            left = run[-1] - lat.share[pick]
            places.append((d, at))
            masses.append(d.prefix[at] + np.log(left) if left > 1e-15 and len(out) < hi - lo else -np.inf)
            prefix_occ.append(d.occ[a : at + 1])
            prefix_edge += (d.edge[a:at], [pick])
            here = d.occ[at]
            later = slice(here + 1, first_occ[i + 1])
            cont_occ.append(np.arange(here, first_occ[i + 1]))
            cont_node += ([lat.target[pick]], chunk_node[later])
            samples[i].append((number, best[i]))
        for (d, at), rest in zip(places, gumbel_below(np.array(masses), best[alive], noise[alive])):
            d.rest[at] = rest
        if not len(alive):
            done.append(_settled(lat, Walk(np.zeros(0, np.int64), np.zeros(0, np.int64)), text, n, np.zeros(0, bool), best, keyed(number), place))
            continue
        head = Walk(np.concatenate(prefix_occ), np.concatenate(prefix_edge))
        tail = walk(lat, np.concatenate(cont_occ), np.concatenate(cont_node), keyed(number), place)
        order = np.argsort(np.concatenate([head.occ, tail.occ]), kind="stable")
        path = Walk(np.concatenate([head.occ, tail.occ])[order], np.concatenate([head.edge, tail.edge])[order])
        old_part = np.concatenate([np.ones(len(head.occ), bool), np.zeros(len(tail.occ), bool)])[order]
        done.append(_settled(lat, path, text, n, old_part, best, keyed(number), place))
    kappa = best
    ids, begin = zip(*(_ids(lat, d.edge, d.first, chunk_data, p) for d in done), strict=True)
    out: list[list[Sample]] = []
    for i in range(n):
        mine = []
        for number, score in samples[i]:
            log_p = float(done[number].total[i])
            gap = log_p - kappa[i]
            inclusion = 0.0 if np.isinf(kappa[i]) or gap > 30 else float(np.log(-np.expm1(-np.exp(gap)))) if gap > -30 else float(gap)
            mine.append(Sample(ids[number][begin[number][i] : begin[number][i + 1]], log_p, float(score), inclusion))
        out.append(mine)
    return out


class Settled(NamedTuple):
    """Paths of one number: steps with their nodes, log probability before each, and the largest perturbed
    score of the paths that leave it there."""

    occ: np.ndarray
    edge: np.ndarray
    node: np.ndarray
    first: np.ndarray
    prefix: np.ndarray
    rest: np.ndarray
    total: np.ndarray


def _settled(lat: Lattice, path: Walk, text: np.ndarray, n: int, shared: np.ndarray, tops, key, place) -> Settled:
    of = text[path.occ]
    first = np.searchsorted(of, np.arange(n + 1))
    node = lat.source[path.edge]
    share = np.minimum(lat.share[path.edge], 1.0)
    run = np.concatenate([[0.0], np.cumsum(np.log(share))])
    prefix = run[:-1] - run[first[of]]
    with np.errstate(divide="ignore"):
        mass = prefix + np.log1p(-share)
    lone = (lat.first[node + 1] - lat.first[node] < 2) | (share > 1 - 1e-15) | shared
    rest = np.full(len(of), -np.inf)
    on = np.flatnonzero(~lone)
    occ = path.occ[on]
    u = _uniform(key[occ] + (place[occ] + lat.offset[node[on]]).astype(np.uint64) * T.salt(3) + T.salt(5))
    rest[on] = gumbel_below(mass[on], tops[of[on]], u)
    return Settled(path.occ, path.edge, node, first, prefix, rest, run[first[1:]] - run[first[:-1]])


def _ids(lat: Lattice, edge: np.ndarray, first: np.ndarray, data: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all steps, characters without a piece as bytes, and where each text's begin."""
    piece = lat.piece[edge]
    lone = np.flatnonzero(piece < 0)
    at = -1 - piece[lone]
    lead = data[at]
    width = np.ones(len(edge), np.int64)
    width[lone] = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
    begin = np.concatenate([[0], np.cumsum(width)])
    out = np.zeros(begin[-1], np.int32)
    out[begin[:-1]] = np.maximum(piece, 0)
    for j in range(4):
        has = width[lone] > j
        out[begin[lone[has]] + j] = p.byte_id[data[at[has] + j]]
    return out, begin[first]


SAMPLED = (
    "n_samples int, n_pieces array<int>, log_probs array<double>, inclusion array<double>, "
    "digests array<string>, round_trip boolean, ids array<array<int>>"
)


def encode(
    docs: DataFrame,
    key: Column,
    keep: list[str],
    k: int = 2,
    model: str = MODEL,
    flatten: float = 1.0,
    with_ids: bool = False,
    with_texts: bool = False,
) -> DataFrame:
    """The columns ``keep`` of every row with ``k`` distinct segmentations of its whole text.

    ``n_samples`` (fewer than ``k`` where there are no more), and by sample, best perturbed score first:
    ``n_pieces``, ``log_probs``, ``inclusion`` (log of the probability of being among the samples, given the
    best score left out), ``ids`` (the segmentation itself), ``digests`` (SHA-256 of the ids as 4-byte
    little-endian). ``round_trip``: each sample decodes to the text. With ``with_ids`` also ``pieces``, the
    ids of the first. ``decode_samples`` turns ``ids`` back into texts; ``with_texts`` adds the same column
    ``texts`` in this pass, which spares the executors a second set of Python workers.

    ``key`` seeds the noise: equal keys and texts have equal samples, wherever the row lies. NULL and
    empty texts have no samples and a true round trip. Kept columns named like a new one are replaced. The
    model file is read where the job is submitted.
    """
    with open(model, "rb") as file:
        built = load(file.read(), flatten)  # here, as building takes more memory than the tables that the tasks get
    sent = docs.sparkSession.sparkContext.broadcast((built, surface_table(built)))
    added = SAMPLED + (", pieces array<int>" if with_ids else "") + (", texts array<string>" if with_texts else "")

    def run(kept: list[pa.Array], given: list[pa.Array]) -> Iterator[list[pa.Array]]:
        p, table = sent.value
        data, offsets = T.text_buffers(given[1])
        seeds = given[0].to_numpy().view(np.uint64)
        for a, b in T.groups(offsets, WALK_BYTES):
            found = sample_texts(data, offsets[a : b + 1], seeds[a:b], p, k)
            nested = _nested([[s.ids for s in samples] for samples in found])
            decoded = _decoded(nested.values.values.to_numpy(), _offsets(nested.values), *table)
            back, bounds = decoded
            rows, at = [], 0
            for i, samples in enumerate(found, a):
                text = data[offsets[i] : offsets[i + 1]]
                same = all(np.array_equal(back[bounds[j] + 1 : bounds[j + 1]], text) for j in range(at, at + len(samples)))
                at += len(samples)
                rows.append(
                    (
                        len(samples),
                        [len(s.ids) for s in samples],
                        [s.log_p for s in samples],
                        [s.inclusion for s in samples],
                        [hashlib.sha256(s.ids.astype("<i4").tobytes()).hexdigest() for s in samples],
                        same and bool(samples or not len(text)),
                        *([samples[0].ids if samples else []] if with_ids else []),
                    )
                )
            made = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _TYPES, strict=False)]
            made.insert(_IDS_AT, nested)
            if with_texts:
                made.append(pa.ListArray.from_arrays(nested.offsets, _without_blank(*decoded)))
            yield [c.slice(a, b - a) for c in kept] + made

    return mapped(docs, keep, [F.xxhash64(key), "text"], added, run)


@lru_cache(maxsize=4)
def _surface_table(surfaces: tuple[bytes | None, ...], byte_id: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(byte_id, np.int64)
    sizes = np.array([len(s) if s else 0 for s in surfaces])
    at = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    flat = b"".join(s or b"" for s in surfaces) + bytes(range(256))
    sizes[ids], at[ids] = 1, len(flat) - 256 + np.arange(256)
    return sizes, at, np.frombuffer(flat, np.uint8)


def surface_table(p: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length and place of each id's bytes, and the bytes."""
    return _surface_table(tuple(p.surfaces), p.byte_id.astype(np.int64).tobytes())


_TYPES = [
    pa.int32(),
    pa.list_(pa.int32()),
    pa.list_(pa.float64()),
    pa.list_(pa.float64()),
    pa.list_(pa.string()),
    pa.bool_(),
    pa.list_(pa.int32()),
]
#: Where the ids of all samples stand among the new columns.
_IDS_AT = 6


def _nested(ids: list[list[np.ndarray]]) -> pa.Array:
    """The ids of all samples of all texts as array<array<int>>."""
    flat = [x for samples in ids for x in samples]
    samples = np.cumsum([0, *(len(x) for x in ids)]).astype(np.int32)
    steps = np.cumsum([0, *(len(x) for x in flat)]).astype(np.int32)
    values = pa.array(np.concatenate([np.zeros(0, np.int32), *flat]).astype(np.int32))
    return pa.ListArray.from_arrays(pa.array(samples), pa.ListArray.from_arrays(pa.array(steps), values))


def _bytes_of(ids: np.ndarray, sizes: np.ndarray, at: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The bytes that the ids decode to, with the blank before the text."""
    n = sizes[ids]
    stop = np.cumsum(n)
    return flat[np.arange(stop[-1] if len(stop) else 0) + np.repeat(at[ids] - (stop - n), n)]


def decode_samples(df: DataFrame, keep: Sequence[str], ids: str = "ids", texts: str = "texts", model: str = MODEL) -> DataFrame:
    """The columns ``keep`` of every row and ``texts``, the text of each sequence of ids in ``ids``.

    ``ids`` is an array of arrays of numbers, as ``encode`` gives it. A sequence with a NULL or with a number
    that is no piece's has the text NULL, and so has a NULL sequence; NULL ``ids`` give NULL. Control pieces
    stand for nothing, bytes that are no UTF-8 become the replacement character, and one blank at the
    beginning goes, which ``encode`` has put there. A kept column named ``texts`` is replaced. The model
    file is read where the job is submitted.
    """
    with open(model, "rb") as file:
        held = df.sparkSession.sparkContext.broadcast(surface_table(load(file.read())))

    def run(kept: list[pa.Array], given: list[pa.Array]) -> Iterator[list[pa.Array]]:
        outer, inner = _offsets(given[0]), _offsets(given[0].values)
        for a, b in T.groups(inner[outer], WALK_BYTES // 2):
            yield [c.slice(a, b - a) for c in kept] + [_texts_of(given[0].slice(a, b - a), *held.value)]

    return mapped(df, keep, [col(ids).cast("array<array<int>>")], f"`{texts}` array<string>", run)


def _offsets(lists: pa.Array) -> np.ndarray:
    """The offsets of an array of lists, which may come without any if it is empty."""
    return lists.offsets.to_numpy().astype(np.int64) if len(lists) else np.zeros(1, np.int64)


def _texts_of(rows: pa.Array, *table: np.ndarray) -> pa.Array:
    """The text of each sequence of ids in an array<array<int>>, as array<string>."""
    samples = rows.values
    outer, inner = _offsets(rows), _offsets(samples)
    steps = inner[outer[0] : outer[-1] + 1]
    numbers = samples.values.slice(steps[0], steps[-1] - steps[0])
    found = _texts(numbers.fill_null(-1).to_numpy(), steps - steps[0], *table)
    held = samples.slice(outer[0], outer[-1] - outer[0]).is_valid()
    found = pc.if_else(held, found, pa.scalar(None, pa.string()))
    return pa.ListArray.from_arrays(pa.array((outer - outer[0]).astype(np.int32)), found, mask=rows.is_null())


def _texts(ids: np.ndarray, steps: np.ndarray, *table: np.ndarray) -> pa.Array:
    """The text of each sequence of ids, NULL where a number is no piece's."""
    alien = (ids < 0) | (ids >= len(table[0]))
    found = _without_blank(*_decoded(np.where(alien, 0, ids), steps, *table))
    wrong = np.diff(np.concatenate([[0], np.cumsum(alien)])[steps]) > 0
    return pc.if_else(pa.array(wrong), pa.scalar(None, pa.string()), found)


def _decoded(ids: np.ndarray, steps: np.ndarray, sizes: np.ndarray, at: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all sequences, and where each begins and ends."""
    return _bytes_of(ids, sizes, at, flat), np.concatenate([[0], np.cumsum(sizes[ids])])[steps]


def _without_blank(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The sequences of bytes as texts, without one blank at the beginning of each."""
    led = np.flatnonzero(bounds[1:] > bounds[:-1])
    led = led[data[bounds[led]] == 32]
    stays = np.ones(len(data), bool)
    stays[bounds[led]] = False
    size = np.diff(bounds)
    size[led] -= 1
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    raw = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(data[stays])])
    try:
        return raw.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.as_py().decode("utf-8", "replace") for x in raw], pa.string())
