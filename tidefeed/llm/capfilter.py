"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector passes it if their inner product exceeds a bound. The directions form a
structured product code: the rotated space is cut into blocks, each block has a small random code, and a
direction is one code word per block. So a vector's scores are a few small tables, and all directions
that it exceeds are listed by walking through the blocks with a bound on what the rest can add (list
decoding), without looking at the others. Vectors close to each other exceed many of the same directions;
others share few. Several independent codes are used.

Vectors that pass the same filter and have the same label meet in a bucket, in blocks of bounded size that
are compared by matrix products. A pair that meets in several buckets is counted in the first of them, so
links are counted exactly without being written out; components are built from one link per vector,
block and cluster.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.llm.sharing import components, shipped, stored


class CapCode(NamedTuple):
    """``codes`` product codes of ``blocks`` blocks with ``words`` code words each; filters are exceeded where
    the inner product is ``bound`` standard deviations or more; each vector keeps its best ``least`` at least."""

    codes: int = 3
    blocks: int = 4
    words: int = 16
    bound: float = 3.8
    least: int = 4
    seed: int = 11


def directions(dim: int, plan: CapCode) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each code a rotation and the code words by block, each of length 1."""
    rng = np.random.default_rng([plan.seed, dim])
    size = -(-dim // plan.blocks)
    out = []
    for _ in range(plan.codes):
        rotation = np.linalg.qr(rng.normal(size=(size * plan.blocks, size * plan.blocks)))[0][:dim]
        words = rng.normal(size=(plan.blocks, plan.words, size))
        out.append((rotation, words / np.linalg.norm(words, axis=2, keepdims=True)))
    return out


def list_decode(x: np.ndarray, code: tuple[np.ndarray, np.ndarray], plan: CapCode) -> list[np.ndarray]:
    """For each row of ``x`` (length 1) the numbers of all directions that it exceeds.

    Where fewer than ``least`` are exceeded, the best ``least`` are added, found with the best two words of
    each block. So each vector has filters, however it lies.
    """
    rotation, words = code
    turned = (x @ rotation).reshape(len(x), plan.blocks, -1)
    scores = np.einsum("nbd,bwd->nbw", turned, words) / np.sqrt(plan.blocks)
    rest = np.concatenate([np.cumsum(scores.max(axis=2)[:, ::-1], axis=1)[:, ::-1], np.zeros((len(x), 1))], axis=1)
    bound = plan.bound / np.sqrt(x.shape[1])
    row, number, total = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x))
    for b in range(plan.blocks):
        grown = total[:, None] + scores[row, b]
        ok = grown + rest[row, b + 1][:, None] >= bound
        at, word = np.nonzero(ok)
        row, number, total = row[at], number[at] * plan.words + word, grown[at, word]
    order = np.argsort(row, kind="stable")
    found = np.split(number[order], np.searchsorted(row[order], np.arange(1, len(x))))
    for i in np.flatnonzero(np.bincount(row, minlength=len(x)) < plan.least):
        best = np.argsort(-scores[i], axis=1, kind="stable")[:, :2]
        combos = np.array(np.meshgrid(*best, indexing="ij")).reshape(plan.blocks, -1)
        value = scores[i][np.arange(plan.blocks)[:, None], combos].sum(axis=0)
        take = combos[:, np.argsort(-value, kind="stable")[: plan.least]]
        extra = np.zeros(take.shape[1], np.int64)
        for b in range(plan.blocks):
            extra = extra * plan.words + take[b]
        found[i] = np.union1d(found[i], extra)
    return found


def _unit(values: list | None) -> np.ndarray | None:
    """The vector at length 1 in double precision; None if it is no usable vector."""
    if not values or any(v is None for v in values):
        return None
    v = np.asarray(values, np.float64)
    if not np.isfinite(v).all() or not (biggest := np.abs(v).max()) > 0:
        return None
    v = v / biggest
    return v / np.sqrt((v * v).sum())


def _filters(plan: CapCode):
    """From rows ``cls``, ``vector`` to ``cls``, ``filters`` (sorted numbers) of the usable vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, list] = {}
        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                batch = whole.slice(a, 1000)
                vectors = [_unit(v) for v in batch.column(1).to_pylist()]
                rows = np.array([i for i, v in enumerate(vectors) if v is not None], np.int64)
                dims = np.array([len(vectors[i]) for i in rows], np.int64)
                filters: dict[int, list[np.ndarray]] = {int(i): [] for i in rows}
                for dim in np.unique(dims):
                    of = rows[dims == dim]
                    x = np.stack([vectors[i] for i in of])
                    if dim not in made:
                        made[dim] = directions(int(dim), plan)
                    for c, code in enumerate(made[dim]):
                        base = (int(dim) * plan.codes + c) * plan.words**plan.blocks
                        for i, numbers in zip(of, list_decode(x, code, plan), strict=True):
                            filters[int(i)].append(np.sort(numbers) + base)
                lists = pa.array([np.concatenate(filters[int(i)]) for i in rows], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), lists], names=["cls", "filters"])

    return run


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member of each one's component."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, least)
        np.minimum.at(root, j, least)
        root = root[root]
        if (root == before).all():
            return root


def _compare(least: float):
    """Links within buckets, whose rows come one after the other: rows ``cls``, ``n_links``, ``root``."""

    def bucket(rows: list[dict]) -> tuple[list, np.ndarray, np.ndarray]:
        f, p, q = rows[0]["filter"], rows[0]["p"], rows[0]["q"]
        rows = sorted(rows, key=lambda r: r["cls"])
        x = np.stack([_unit(r["vector"]) for r in rows])
        block = np.array([r["block"] for r in rows])
        left, right = np.flatnonzero(block == p), np.flatnonzero(block == q)
        i, j = np.nonzero(x[left] @ x[right].T >= least - 1e-9)
        i, j = left[i], right[j]
        ok = i < j if p == q else np.ones(len(i), bool)
        i, j = i[ok], j[ok]
        ok = np.einsum("nd,nd->n", x[i], x[j]) >= least
        i, j = i[ok], j[ok]
        n_links = np.zeros(len(rows), np.int64)
        roots = _roots(len(rows), i, j)
        if len(i):
            lower = [[g for g in r["filters"] if g < f] for r in rows]
            names, at = np.unique(np.concatenate([np.asarray(g, np.int64) for g in lower]), return_inverse=True)
            member = np.zeros((len(rows), len(names)), np.float32)
            member[np.repeat(np.arange(len(rows)), [len(g) for g in lower]), at] = 1
            met = (member[left] @ member[right].T) > 0
            place = np.zeros(len(rows), np.int64)
            place[left] = np.arange(len(left))
            of_i = place[i]
            place[right] = np.arange(len(right))
            new = ~met[of_i, place[j]]
            weight = np.array([r["weight"] for r in rows], np.int64)
            np.add.at(n_links, i[new], weight[j[new]])
            np.add.at(n_links, j[new], weight[i[new]])
        return [r["cls"] for r in rows], n_links, roots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[dict]) -> pa.RecordBatch:
            cls, n_links, roots = bucket(rows)
            ids = np.asarray(cls, np.int64)
            ok = (n_links > 0) | (roots != np.arange(len(ids)))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids[ok]), pa.array(n_links[ok]), pa.array(ids[roots][ok])], names=["cls", "n_links", "root"]
            )

        rows: list[dict] = []
        for batch in batches:
            for a in range(0, batch.num_rows, 2000):
                for row in batch.slice(a, 2000).to_pylist():
                    if rows and any(row[k] != rows[0][k] for k in ("label", "filter", "p", "q")):
                        if len(rows) > 1:
                            yield out(rows)
                        rows = []
                    rows.append(row)
        if len(rows) > 1:
            yield out(rows)

    return run


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = 0.98,
    plan: CapCode = CapCode(),
    block: int = 512,
) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Two vectors link if their labels are equal and not NULL and their cosine in double precision is
    ``least`` or more. ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id
    reachable by links, ``kept`` says that this is the row's own id. Links are exact where found; pairs
    that share no filter are missed (recall is measured in the tests).

    Vectors that are NULL, empty or zero, or hold NULL or non-finite components, link with nothing, copies
    included. Vectors of different lengths don't link. Equal vectors with one label are one class and
    compared once; rows that repeat an id are rows of their own. A row without id has the smallest id of its
    component, NULL if that has none, and counts as kept only in that case. Other columns aren't read.
    """
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    usable = rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", F.isnull))
    classes = usable.groupBy("label", "vector").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("weight"))
    classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()), "vectors")
    filters = shipped(classes.select("cls", "vector")).mapInArrow(_filters(plan), "cls long, filters array<bigint>")
    filters = stored(filters, "filters")
    full = classes.join(filters, "cls")
    passed = full.select("cls", "label", F.explode("filters").alias("filter"))
    sizes = passed.groupBy("label", "filter").agg(F.count("*").alias("n")).where("n > 1")
    n_blocks = F.ceil(F.col("n") / block).cast("int")
    placed = (
        passed.join(sizes, ["label", "filter"])
        .withColumn("block", F.pmod(F.xxhash64("cls", "filter"), n_blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
        .select("cls", "filter", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"))
    )
    keys = ["label", "filter", "p", "q"]
    met = placed.join(full.drop("least_id"), "cls").select(*keys, "cls", "block", "weight", "vector", "filters")
    met = met.repartition(*keys).sortWithinPartitions(*keys)
    found = stored(shipped(met).mapInArrow(_compare(least), "cls long, n_links long, root long"), "links-found")
    linked = found.groupBy("cls").agg(F.sum("n_links").alias("n_links"))
    roots = components(found.where("cls != root"), "cls", "root").select(F.col("node").alias("cls"), "root")
    of_class = stored(
        full.select("cls", "label", "vector", "least_id", "weight")
        .join(linked, "cls", "left")
        .join(roots, "cls", "left")
        .select(
            "label",
            "vector",
            "least_id",
            (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("root", "cls").alias("root"),
        ),
        "vector-classes",
    )
    smallest = of_class.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_class = of_class.join(smallest, "root").select("label", "vector", "n_links", "component_id", F.lit(True).alias("used"))
    out = rows.join(of_class, ["label", "vector"], "left")
    component = F.when(F.col("used"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
