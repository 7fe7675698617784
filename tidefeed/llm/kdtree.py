"""Exact top-k search by inner product over KD-trees, one per shard.

Vectors become whole numbers, ``floor(scale * x)``, so scores are exact and ties well defined. Of equal
vectors only the first ``k + 1`` rows can be among a query's best (one may be the query's own row), so no more
are indexed; equal queries are searched for once.

The top of the tree, ``cells``, is split at the medians of a bounded sample and only decides which vectors lie
together. A cell of many vectors is dealt over several shards of a bounded size, each with a KD-tree of its
own over all its vectors: median splits on the widest axis and a tight box for each node, stored as one row.

A box bounds the score of all that lie in it: on each axis the end on the query's side. Queries first search
one shard of their own cell, best box first, which gives each a score that its result must reach. With
it they go to the other shards whose boxes can reach it, and there prune nodes by it, again best box first.
Queries meet a shard in blocks of a bounded size. In many dimensions boxes hardly prune and all shards are
read; the result is exact either way.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefeed.functions import col
from tidefeed.llm.sharing import checked, shipped, stored
from tidefeed.storage import materialize

#: Below any score: norms are held so that scores stay within this.
NO_SCORE = -(1 << 62)
_LAST = (1 << 63) - 1


class Sizes(NamedTuple):
    """A shard has about ``shard_bytes`` of vectors, a leaf ``leaf`` vectors; queries come in blocks of
    ``block``. The cells are fitted to at most ``sample_rows`` vectors of ``sample_bytes`` together."""

    shard_bytes: int = 1 << 21
    leaf: int = 256
    block: int = 2048
    sample_rows: int = 32768
    sample_bytes: int = 1 << 24
    per_cell: int = 16


class Tree(NamedTuple):
    """A balanced KD-tree. ``order`` sorts the points by leaf; ``lo`` and ``hi`` are the nodes' boxes, level by
    level from the root; node ``i`` has the children ``2 i + 1`` and ``2 i + 2``."""

    order: np.ndarray
    lo: np.ndarray
    hi: np.ndarray


def spans_of(n: int, depth: int) -> list[tuple[int, int]]:
    """From where to where the leaves of a tree of ``n`` points lie."""
    spans = [(0, n)]
    for _ in range(depth):
        spans = [half for a, b in spans for half in ((a, (a + b) // 2), ((a + b) // 2, b))]
    return spans


def depth_of(n: int, leaf: int) -> int:
    return max(0, int(np.ceil(np.log2(n / leaf)))) if n else 0


def build(points: np.ndarray, leaf: int) -> Tree:
    """Split at the median of the axis on which a node is widest, until leaves hold ``leaf`` points at most."""
    n, depth = len(points), depth_of(len(points), leaf)
    order = np.arange(n)
    for level in range(depth):
        for a, b in spans_of(n, level):
            mine = points[order[a:b]]
            axis = int(np.argmax(mine.max(axis=0) - mine.min(axis=0))) if mine.shape[1] else 0
            if mine.shape[1]:
                order[a:b] = order[a:b][np.argpartition(mine[:, axis], (a + b) // 2 - a)]
    starts = [a for a, _ in spans_of(n, depth)]
    lo, hi = (f.reduceat(points[order], starts, axis=0) for f in (np.minimum, np.maximum))
    los, his = [lo], [hi]
    for _ in range(depth):
        los.append(np.minimum(los[-1][::2], los[-1][1::2]))
        his.append(np.maximum(his[-1][::2], his[-1][1::2]))
    return Tree(order, np.concatenate(los[::-1]), np.concatenate(his[::-1]))


def box_bounds(queries: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The most that a point in each box can score with each query, rounded up where doubles round."""
    q, lo, hi = (x.astype(np.float64) for x in (queries, lo, hi))
    out = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
    reach = np.abs(q).max(initial=0) * max(np.abs(lo).max(initial=0), np.abs(hi).max(initial=0)) * max(1, q.shape[1])
    return out if reach < 1 << 52 else out + reach * 1e-12


def _exact_type(queries: np.ndarray, points: np.ndarray) -> type:
    """The fastest type in which all inner products and their parts are exact."""
    most = 1.0
    for x in (queries, points):
        most *= np.sqrt((x.astype(np.float64) ** 2).sum(axis=1).max(initial=0))
    return np.float32 if most < 1 << 23 else np.float64 if most < 1 << 52 else np.int64


class _Best:
    """The best ``k`` of each query so far, and the score that a candidate must reach."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k, self.floor, self.need = k, floor, floor.copy()
        self.held = np.zeros((0, 4), np.int64)  # query, score, id, row

    def add(self, found: list[np.ndarray]) -> None:
        held = np.concatenate([self.held, *found])
        held = held[np.lexsort((held[:, 3], held[:, 2], -held[:, 1], held[:, 0]))]
        first = np.searchsorted(held[:, 0], held[:, 0], "left")
        rank = np.arange(len(held)) - first
        last = held[rank == self.k - 1]
        self.need[last[:, 0]] = np.maximum(self.need[last[:, 0]], last[:, 1])
        self.held = held[rank < self.k]


def best_first(points: np.ndarray, ids: np.ndarray, rows: np.ndarray, lo: np.ndarray, hi: np.ndarray, leaf: int,
               queries: np.ndarray, floor: np.ndarray, k: int) -> np.ndarray:
    """Query number, score, id and row of each query's best ``k`` points that score ``floor`` or more.

    ``points`` come in the order of the leaves. Nodes that can't reach a query's floor are left with all that
    lies below them; each query visits the leaves that are left by falling bound, one, then two, then four, and
    stops where the bound is below its k-th score.
    """
    n, depth = len(points), depth_of(len(points), leaf)
    best = _Best(floor, k)
    alive, bounds, at = np.ones((len(queries), 1), bool), None, 0
    for level in range(depth + 1):
        if level:
            alive = np.repeat(alive, 2, axis=1)
        nodes = slice(at, at + (1 << level))
        bounds = np.full(alive.shape, -np.inf)
        some = np.flatnonzero(alive.any(axis=1))
        bounds[some] = box_bounds(queries[some], lo[nodes], hi[nodes])
        alive &= bounds >= floor[:, None]
        at += 1 << level
    bounds[~alive] = -np.inf
    order = np.argsort(-bounds, axis=1, kind="stable")
    spans, kind = spans_of(n, depth), _exact_type(queries, points)
    q, p = queries.astype(kind), points.astype(kind)
    seen, step = 0, 1
    while seen < order.shape[1]:
        leaves = order[:, seen : seen + step]
        visit = np.take_along_axis(bounds, leaves, axis=1) >= best.need[:, None]
        if not visit.any():
            break
        asking, which = np.nonzero(visit)
        number = leaves[asking, which]
        by = np.argsort(number, kind="stable")
        cuts = np.flatnonzero(np.diff(number[by])) + 1
        found = []
        for group in np.split(by, cuts):
            a, b = spans[number[group[0]]]
            who = asking[group]
            score = q[who] @ p[a:b].T
            need = best.need[who].astype(kind)
            if b - a > k:
                need = np.maximum(need, np.partition(score, b - a - k, axis=1)[:, b - a - k])
            i, j = np.nonzero(score >= need[:, None])
            found.append(np.stack([who[i], score[i, j].astype(np.int64), ids[a + j], rows[a + j]], axis=1))
        best.add(found)
        seen, step = seen + step, step * 2
    return best.held


def _cells(sample: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Axis and threshold of the inner nodes of a tree with ``cells`` leaves or a few more."""
    depth = depth_of(cells, 1) if len(sample) else 0
    axes, cuts, groups = [], [], [sample]
    for _ in range(depth):
        halves = []
        for mine in groups:
            spread = mine.max(axis=0) - mine.min(axis=0) if len(mine) else np.zeros(sample.shape[1], np.int64)
            axis = int(np.argmax(spread)) if len(spread) else 0
            cut = int(np.median(mine[:, axis])) if len(spread) and len(mine) else 0
            right = mine[:, axis] > cut if len(spread) else np.zeros(len(mine), bool)
            axes.append(axis)
            cuts.append(cut)
            halves += [mine[~right], mine[right]]
        groups = halves
    return np.array(axes, np.int64), np.array(cuts, np.int64)


def _descend(points: np.ndarray, axes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    if not points.shape[1]:
        return node
    while len(axes) and node.min(initial=len(axes)) < len(axes):
        node = 2 * node + 1 + (points[np.arange(len(points)), axes[node]] > cuts[node])
    return node - len(axes)


def _matrices(column: pa.Array):
    """Rows and values of each dimension of a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    flat, first = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(size)])
    for dim in np.unique(size):
        at = np.flatnonzero(size == dim)
        yield int(dim), at, flat[first[at][:, None] + np.arange(dim)].reshape(len(at), dim).astype(np.int64)


def _located(rows: DataFrame, trees) -> DataFrame:
    """The rows with ``dim`` and ``cell`` of their ``v``."""
    names = rows.columns
    where = rows.schema.fieldNames().index("v")

    def run(batches):
        for batch in batches:
            dims, cells = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int32)
            for dim, at, points in _matrices(batch.column(where)):
                dims[at] = dim
                if dim in trees.value:
                    cells[at] = _descend(points, *trees.value[dim])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(dims), pa.array(cells)], names=[*names, "dim", "cell"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return shipped(rows).mapInArrow(run, f"{schema}, dim int, cell int")


SHARD = ["dim", "cell", "part"]
_INDEX = "dim int, cell int, part int, ids array<bigint>, rows array<bigint>, points array<bigint>, lo array<bigint>, hi array<bigint>"
_HITS = "q long, score long, id long, row long"


def _indexed(leaf: int):
    def run(group: pa.Table) -> pa.Table:
        (_, _, points), = _matrices(group.column("v"))
        tree = build(points, leaf)
        one = {c: pa.array([group.column(c)[0].as_py()], pa.int32()) for c in SHARD}
        ids, rows = (group.column(c).to_numpy()[tree.order] for c in ("id", "row"))
        lists = {"ids": ids, "rows": rows, "points": points[tree.order].ravel(), "lo": tree.lo.ravel(), "hi": tree.hi.ravel()}
        return pa.table(one | {c: pa.array([x], pa.list_(pa.int64())) for c, x in lists.items()})

    return run


def _searched(leaf: int, k: int):
    def run(asked: pa.Table, index: pa.Table) -> pa.Table:
        hits = np.zeros((0, 4), np.int64)
        if asked.num_rows and index.num_rows:
            (dim, at, queries), = _matrices(asked.column("v"))
            ids, rows, points, lo, hi = (
                index.column(c).combine_chunks().flatten().to_numpy() for c in ("ids", "rows", "points", "lo", "hi")
            )
            nodes = (2 << depth_of(len(ids), leaf)) - 1
            points, lo, hi = points.reshape(len(ids), dim), lo.reshape(nodes, dim), hi.reshape(nodes, dim)
            hits = best_first(points, ids, rows, lo, hi, leaf, queries, asked.column("floor").to_numpy(), k)
            hits[:, 0] = asked.column("q").to_numpy()[hits[:, 0]]
        return pa.table([pa.array(hits[:, i]) for i in range(4)], names=["q", "score", "id", "row"])

    return run


def _search(asked: DataFrame, index: DataFrame, blocks: int, leaf: int, k: int) -> DataFrame:
    """The hits of each row of ``asked`` (shard, ``q``, ``v``, ``floor``) in its shard."""
    asked = asked.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int"))
    wanted = asked.select(*SHARD, "block").distinct().toDF("d", "c", "p", "for_block")
    met = index.join(wanted, F.expr("dim = d and cell = c and part = p"))
    left, right = shipped(asked).groupBy(*SHARD, "block"), met.groupBy("d", "c", "p", "for_block")
    return left.cogroup(right).applyInArrow(_searched(leaf, k), _HITS)


def _others(asked: DataFrame, boxes, parts: DataFrame) -> DataFrame:
    """Each query with every shard but the one it has searched whose cell's box reaches its floor."""

    def run(batches):
        for batch in batches:
            who, cells = [], []
            floor = batch.column(6).to_numpy()
            for dim, at, queries in _matrices(batch.column(4)):
                if dim in boxes.value:
                    cell, lo, hi = boxes.value[dim]
                    i, j = np.nonzero(box_bounds(queries, lo, hi) >= floor[at][:, None])
                    who.append(at[i])
                    cells.append(cell[j])
            if who:
                took = batch.take(pa.array(np.concatenate(who)))
                cell = pa.array(np.concatenate(cells), pa.int32())
                yield pa.RecordBatch.from_arrays([took.column(0), cell, *took.columns[1:]], names=names)

    names = ["dim", "cell", "home", "home_part", "q", "v", "asks", "floor"]
    given = asked.select("dim", F.col("cell").alias("home"), F.col("part").alias("home_part"), "q", "v", "asks", "floor")
    met = shipped(given).mapInArrow(run, "dim int, cell int, home int, home_part int, q long, v array<bigint>, asks boolean, floor long")
    met = met.join(parts, ["dim", "cell"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return met.where("cell <> home or part <> home_part").select(*SHARD, "q", "v", "floor")


def _first_of_equals(base: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of each vector by ``id`` and ``row``; first within salted parts, so that a vector
    that very many rows have is not sorted in one task."""
    salt = F.pmod(F.xxhash64("row"), F.lit(64))
    for by in (["v", "salt"], ["v"]):
        base = base.withColumn("salt", salt) if "salt" in by else base
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("id", "row"))
        base = base.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")
    return base.drop("salt")


def _fitted(cand: DataFrame, rows: int, dim: int, sizes: Sizes):
    """Axes and thresholds of the cells by dimension, fitted to a bounded sample chosen by a hash."""
    most = max(1, min(sizes.sample_rows, sizes.sample_bytes // max(8, 8 * dim)))
    picked = cand.select("v").orderBy(F.xxhash64("row"), "row").limit(most).toArrow()
    cells = -(-rows * 8 * max(1, dim) // sizes.shard_bytes)
    trees = {}
    for d, at, points in _matrices(picked.column("v")):
        share = max(1, min(cells * len(at) // max(1, picked.num_rows), len(at) // sizes.per_cell))
        trees[d] = _cells(points, share)
    return trees


def _boxes(index: DataFrame) -> dict:
    """The boxes of all cells by dimension; there are a few thousand cells at most."""
    root = F.arrays_zip(F.slice("lo", 1, F.col("dim")).alias("lo"), F.slice("hi", 1, F.col("dim")).alias("hi"))
    ends = index.where("dim > 0").select("dim", "cell", F.posexplode(root).alias("pos", "e"))
    ends = ends.groupBy("dim", "cell", "pos").agg(F.min("e.lo").alias("lo"), F.max("e.hi").alias("hi"))
    rows = ends.groupBy("dim", "cell").agg(F.sort_array(F.collect_list(F.struct("pos", "lo", "hi"))).alias("box"))
    out: dict = {}
    flat = rows.select("dim", "cell", F.col("box.lo").alias("lo"), F.col("box.hi").alias("hi")).orderBy("dim", "cell").toArrow()
    dims = flat.column("dim").to_numpy()
    for dim in np.unique(dims):
        mine = flat.filter(pa.array(dims == dim))
        lo, hi = (mine.column(c).combine_chunks().flatten().to_numpy().reshape(-1, dim) for c in ("lo", "hi"))
        out[int(dim)] = (mine.column("cell").to_numpy(), lo, hi)
    return out


def top_k(vectors: DataFrame, asks: Column, k: int = 20, scale: int = 64, sizes: Sizes = Sizes()) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` other rows of the highest inner product
    for every row of ``vectors`` (``vec_id``, ``embedding``) for which ``asks`` holds.

    Components are ``floor(scale * x)``, x as double; scores are exact. Ties go to the smaller ``vec_id``, then
    to rows without one (which come out as NULL, as would the largest long), then by row. A query finds every
    row but itself, also those that repeat its ``vec_id``; rows that repeat a query each get a result. Vectors
    that are NULL or hold NULL or non-finite components take no part, nor do those so long that a score may
    not fit a long (a norm of 2**31 or more). Vectors of different dimension don't meet; those
    without components score 0. A query with fewer than ``k`` others gets all of them. Other columns aren't read.
    """
    spark = vectors.sparkSession
    number = F.transform(col("embedding"), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    whole = F.coalesce(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
    length = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.pow(F.floor(F.lit(float(scale)) * x.cast("double")), F.lit(2.0)))
    given = vectors.select("vec_id", "embedding", F.coalesce(asks, F.lit(False)).alias("asks")).where(whole).where(length < float(1 << 62))
    given = given.select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("vec_id").cast("long"), F.lit(_LAST)).alias("id"), "asks", number.alias("v")
    )
    base, _ = materialize(given, "vectors")
    cand, seen = materialize(_first_of_equals(base, k + 1).select("row", "id", "v"), "candidates", F.max(F.size("v")).alias("dim"))
    trees = spark.sparkContext.broadcast(_fitted(cand, seen["rows"], seen["dim"] or 0, sizes))
    placed = stored(_located(cand, trees), "placed")
    per_shard = F.greatest(F.lit(1), F.floor(F.lit(sizes.shard_bytes) / (8 * F.greatest("dim", F.lit(1)))))
    parts = placed.groupBy("dim", "cell").agg(F.ceil(F.count("*") / F.first(per_shard)).cast("int").alias("parts"))
    parts = checked(parts, "parts", 12)
    deal = lambda key: F.pmod(F.xxhash64(key), F.col("parts")).cast("int")
    dealt = placed.join(parts, ["dim", "cell"]).withColumn("part", deal("row")).drop("parts")
    index = stored(shipped(dealt).groupBy(*SHARD).applyInArrow(_indexed(sizes.leaf), _INDEX), "kd-index")

    asking = base.where("asks").groupBy("v").agg(F.min("row").alias("q"))
    asking, asked = materialize(asking.select("q", "v"), "queries")
    blocks = max(1, -(-asked["rows"] // sizes.block))
    home = _located(asking, trees).join(parts, ["dim", "cell"]).withColumn("part", deal("q")).drop("parts")
    home = home.withColumn("floor", F.lit(NO_SCORE))
    first = stored(_search(home.select(*SHARD, "q", "v", "floor"), index, blocks, sizes.leaf, k + 1), "home-hits")
    floor = first.groupBy("q").agg(F.when(F.count("*") > k, F.min("score")).alias("reached"))
    known = home.join(floor, "q", "left").withColumn("floor", F.coalesce("reached", "floor")).drop("reached").withColumn("asks", F.lit(True))
    boxes = _boxes(index)
    boxes[0] = (np.zeros(1, np.int32), np.zeros((1, 0)), np.zeros((1, 0)))
    others = _others(known, spark.sparkContext.broadcast(boxes), parts)
    hits = stored(first.unionAll(_search(others, index, blocks, sizes.leaf, k + 1)), "hits")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id", "row"))
    best = hits.withColumn("rank", rank).where(F.col("rank") <= k + 1)
    lists = best.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "id", "row"))).alias("best"))
    rows = base.where("asks").join(asking, "v").select("row", "id", "q").join(lists, "q")
    found = rows.select("id", F.posexplode(F.slice(F.filter("best", lambda e: e["row"] != F.col("row")), 1, k)).alias("at", "e"))
    return found.select(
        F.nullif(F.col("id"), F.lit(_LAST)).alias("query_id"), (F.col("at") + 1).alias("rank"),
        F.nullif(F.col("e.id"), F.lit(_LAST)).alias("vec_id"), F.col("e.score").alias("score"),
    )
