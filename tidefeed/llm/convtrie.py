"""The prefix trie of conversations by union-find over sorted neighbours.

A conversation is a path of turns, each the 128-bit hash of its role and text. Conversations with equal paths are
one item with a number of ends. The distinct paths are sorted by range; of two neighbours only the length
of the common prefix (LCP) matters. Blocks of a task's sorted paths are worked off one by one:

* every path starts as a component of its own, whose node is its end;
* the edges between neighbours are taken by falling LCP. An edge of LCP d unites two components, each brought up to a
  child of the node at depth d, or being that node already: a merge makes a branching node. The nodes on the
  way up have one child each and come out as a chain;
* a node whose interval touches neither end of the block is finished and put out.

What is left of a block, its contracted forest, are the nodes along its first and its last path, with sums of
what hangs there. These few rows are merged across boundaries in sorted order by one task, which holds one
open path: nodes beyond the LCP with the next block are closed, the others add up. A finished node whose parent was
open then looks up its parent in what that task has put out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.functions import col
from tidefeed.llm.sharing import checked, shipped, stored
from tidefeed.storage import materialize

NONE = (1 << 63) - 1
NOTHING = hashlib.sha256(b"").hexdigest()
#: Ids in a piece of text on the way to a digest.
PIECE = 512


def turn_paths(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turns`` (array of ``token``, ``size``): each conversation's turns by ``turn``, NULL first, then by the
    hash of role and text. NULL role and text are empty; rows without ``conv_id`` are left out."""
    role, text = (F.coalesce(col(c), F.lit("")) for c in ("role", "text"))
    token = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    turn = F.struct(col("turn").alias("turn"), token.alias("token"), F.length(text).cast("long").alias("size"))
    known = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    turns = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["token"].alias("token"), t["size"].alias("size")))
    return known.groupBy("conv_id").agg(turns.alias("turns"))


def rebuilt(paths: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Each conversation ``c`` with its first ``h`` turns replaced by those of ``c - c % every``, as far as that
    has them; ``h`` is the crc32 of the id's digits modulo ``most``."""
    heads = paths.where(F.col("conv_id") % every == 0)
    heads = heads.select(F.col("conv_id").alias("head"), F.slice("turns", 1, most).alias("lent"))
    mine = paths.withColumns(
        {"head": F.col("conv_id") - F.col("conv_id") % every, "h": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")}
    )
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    lent = F.slice(F.coalesce("lent", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    return mine.join(heads, "head", "left").select("conv_id", F.concat(lent, own).alias("turns"))


def _id_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From sorted ``s1``, ``s2``, ``conv_id``: pieces of each group's ids as text, with first id and number."""
    for batch in batches:
        s1, s2, ids = (batch.column(i).to_numpy() for i in range(3))
        new = np.flatnonzero((s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])) + 1
        cuts = np.unique(np.concatenate([[0], new, np.arange(0, len(ids), PIECE), [len(ids)]])).astype(np.int64)
        text = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(cuts, cuts[1:])]
        at = cuts[:-1]
        columns = [s1[at], s2[at], ids[at], np.diff(cuts), text]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["s1", "s2", "least", "n", "text"])


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each group of the sorted pieces, with the SHA-256 of its ids; nothing but the hash is held."""
    key, n, least, digest, out = None, 0, 0, None, []

    def put() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["s1", "s2", "n", "least", "digest"])

    for batch in batches:
        for s1, s2, first, many, text in zip(*(c.to_pylist() for c in batch.columns)):
            if (s1, s2) == key:
                digest.update(b",")
            else:
                if key:
                    out.append((*key, n, least, digest.hexdigest()))
                key, n, least, digest = (s1, s2), 0, first, hashlib.sha256()
            digest.update(text.encode())
            n += many
        if len(out) > 4096:
            yield put()
            out = []
    if key:
        out.append((*key, n, least, digest.hexdigest()))
        yield put()


def _ends(paths: DataFrame, parts: int) -> DataFrame:
    """``n``, ``least`` and ``digest`` of the ids of each distinct path. Ids are sorted by range, so that a path
    that very many conversations have is spread over tasks; only their texts meet."""
    ids = paths.select("s1", "s2", "conv_id").repartitionByRange(parts, "s1", "s2", "conv_id").sortWithinPartitions("s1", "s2", "conv_id")
    texts = shipped(ids).mapInArrow(_id_texts, "s1 long, s2 long, least long, n long, text string")
    texts = texts.repartition("s1", "s2").sortWithinPartitions("s1", "s2", "least")
    return texts.mapInArrow(_id_digests, "s1 long, s2 long, n long, least long, digest string")


class _Items:
    """Sorted distinct paths of a block: their turns one after another, ends, least ids and digests."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches)
        turns = table.column("turns").combine_chunks()
        self.length = turns.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.length)])
        flat = turns.flatten()
        binary = flat.field("token").cast(pa.large_binary())
        n = len(binary)
        offsets = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + n + 1]
        data = binary.buffers()[2]
        held = bytes(memoryview(data)[offsets[0] : offsets[-1]]) if n else b""
        self.token = np.frombuffer(held, np.uint64).reshape(n, 2)
        self.size = flat.field("size").to_numpy().astype(np.int64)
        self.n, self.least = (table.column(c).to_numpy() for c in ("n", "least"))
        self.digest = table.column("digest").to_pylist()

    def lcp(self) -> np.ndarray:
        """Length of the common prefix of each path and the next."""
        m = np.minimum(self.length[:-1], self.length[1:])
        at = np.repeat(np.arange(len(m)), m)
        j = np.arange(len(at)) - np.repeat(np.concatenate([[0], np.cumsum(m)])[:-1], m)
        differ = (self.token[self.first[at] + j] != self.token[self.first[at + 1] + j]).any(axis=1)
        out = m.copy()
        np.minimum.at(out, at[differ], j[differ])
        return out

    def path(self, item: int) -> tuple[list[bytes], list[int]]:
        a, b = self.first[item], self.first[item + 1]
        return [t.tobytes() for t in self.token[a:b]], self.size[a:b].tolist()


class _Node:
    """The topmost node of a component: depth, interval, the path that ends there, and sums over finished children."""

    __slots__ = ("depth", "lo", "hi", "end", "n", "least", "kids", "leaves", "saved", "hung")

    def __init__(self, depth: int, lo: int, hi: int, end: int = -1):
        self.depth, self.lo, self.hi, self.end = depth, lo, hi, end
        self.n = self.kids = self.leaves = self.saved = 0
        self.least, self.hung = NONE, []  # hung: finished chains whose parent this is

    def take(self, other: _Node) -> None:
        """The other component's node at the same depth is the same node."""
        self.lo, self.hi, self.end = min(self.lo, other.lo), max(self.hi, other.hi), max(self.end, other.end)
        self.n, self.least = self.n + other.n, min(self.least, other.least)
        self.kids, self.leaves, self.saved = self.kids + other.kids, self.leaves + other.leaves, self.saved + other.saved
        if len(self.hung) < len(other.hung):
            self.hung, other.hung = other.hung, self.hung
        self.hung += other.hung


class _Forest:
    """Union-find over the items of a block."""

    def __init__(self, items: _Items):
        self.items, self.m = items, len(items.length)
        self.root = list(range(self.m))
        self.node = [_Node(int(d), i, i, i) for i, d in enumerate(items.length)]
        self.total = np.concatenate([[0], np.cumsum(items.size)])
        self.chains: list[tuple] = []  # item, bottom, top, n, least, kids, leaves, saved below the bottom, end
        self.parent: list[int] = []  # id of a chain's parent, where that is finished
        self.ref: list[tuple[int, int]] = []  # side and depth of an open parent, else -1
        self.open: tuple[dict, dict] = ({}, {})
        edges = items.lcp()
        for i in np.argsort(-edges, kind="stable").tolist():
            self._unite(i, i + 1, int(edges[i]))
        last = self.node[self._find(0)]
        self._raised(last, -1)
        self.common = last.depth

    def _find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def _unite(self, i: int, j: int, depth: int) -> None:
        a, b = self._find(i), self._find(j)
        one, two = (self._raised(self.node[x], depth) for x in (a, b))
        one.take(two)
        if one.hi - one.lo < 2 * (two.hi - two.lo):
            a, b = b, a
        self.root[b] = a
        self.node[a], self.node[b] = one, None

    def _raised(self, node: _Node, depth: int) -> _Node:
        """The component's node at ``depth``; what is deeper comes out as a chain, or is kept where it is open."""
        if node.depth == depth:
            return node
        items = self.items
        up = _Node(depth, node.lo, node.hi)
        if node.lo == 0 or node.hi == self.m - 1:
            side = int(node.lo > 0)
            held = self.open[side]
            held[node.depth] = node
            for d in range(depth + 1, node.depth):
                held[d] = None
            for chain in node.hung:
                self.ref[chain] = (side, node.depth)
            return up
        n, least = node.n, node.least
        if node.end >= 0:
            n, least = n + int(items.n[node.end]), min(least, int(items.least[node.end]))
        leaves = node.leaves if node.kids else 1
        for chain in node.hung:
            self.parent[chain] = least
        first = int(items.first[node.lo])
        up.hung.append(len(self.chains))
        self.chains.append((first, node.depth, depth + 1, n, least, node.kids, leaves, node.saved, node.end))
        self.parent.append(0)
        self.ref.append((-1, -1))
        up.n, up.least, up.kids, up.leaves = n, least, 1, leaves
        up.saved = node.saved + (n - 1) * int(self.total[first + node.depth] - self.total[first + depth])
        return up

    def nodes(self) -> dict[str, np.ndarray | list]:
        """The finished nodes, one for each depth of each chain."""
        first, bottom, top, n, least, kids, leaves, saved, end = (
            np.array(c, np.int64) for c in (zip(*self.chains) if self.chains else [[]] * 9)
        )
        many = bottom - top + 1
        of = np.repeat(np.arange(len(many)), many)
        depth = bottom[of] - (np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many))
        low, high = depth == bottom[of], depth == top[of]
        side, at = (np.array(c, np.int64) for c in (zip(*self.ref) if self.ref else [[]] * 2))
        parent = np.where(high, np.array(self.parent, np.int64)[of], least[of])
        ended = np.where(low, end[of], -1)
        return {
            "conv_id": least[of], "depth": depth, "parent": parent,
            "ref_side": np.where(high, side[of], -1), "ref_depth": np.where(high, at[of], -1),
            "n_convs": n[of], "n_children": np.where(low, kids[of], 1), "n_leaves": leaves[of],
            "saved_tokens": saved[of] + (n[of] - 1) * (self.total[first[of] + bottom[of]] - self.total[first[of] + depth - 1]),
            "digest": [self.items.digest[e] if e >= 0 else NOTHING for e in ended.tolist()],
        }

    def spine(self, side: int) -> tuple[list[int], list[str | None]]:
        """Of the open nodes by depth: ends, least id of these, sums over finished children; the digests."""
        held, numbers, digests = self.open[side], [], []
        for depth in sorted(held):
            node = held[depth] or _Node(depth, 0, 0)
            end = node.end
            mine = (int(self.items.n[end]), int(self.items.least[end])) if end >= 0 else (0, NONE)
            numbers += [*mine, node.n, node.least, node.kids, node.leaves, node.saved]
            digests.append(self.items.digest[end] if end >= 0 else None)
        return numbers, digests


NODES = (
    "conv_id long, depth long, parent long, ref_side long, ref_depth long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, digest string"
)
SPINES = (
    "first array<binary>, first_sizes array<bigint>, last array<binary>, last_sizes array<bigint>, common long, "
    "left array<bigint>, left_digests array<string>, right array<bigint>, right_digests array<string>"
)
_NODE_NAMES = [c.split()[0] for c in NODES.split(", ")]
_SPINE_TYPES = {
    "first": pa.list_(pa.binary()), "first_sizes": pa.list_(pa.int64()), "last": pa.list_(pa.binary()),
    "last_sizes": pa.list_(pa.int64()), "common": pa.int64(), "left": pa.list_(pa.int64()), "left_digests": pa.list_(pa.string()),
    "right": pa.list_(pa.int64()), "right_digests": pa.list_(pa.string()),
}


def _block_forest(batches: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
    """Finished nodes, and in one more row the spines of what is open."""
    items = _Items(batches)
    forest = _Forest(items)
    nodes = forest.nodes()
    n = len(nodes["depth"])
    (first, first_sizes), (last, last_sizes) = items.path(0), items.path(len(items.length) - 1)
    (left, left_digests), (right, right_digests) = forest.spine(0), forest.spine(1)
    spine = dict(first=first, first_sizes=first_sizes, last=last, last_sizes=last_sizes, common=forest.common, left=left,
                 left_digests=left_digests, right=right, right_digests=right_digests)
    columns = [pa.concat_arrays([pa.array([number] * n, pa.int64()), pa.array([number], pa.int64())])]
    for c in _NODE_NAMES:
        kind = pa.string() if c == "digest" else pa.int64()
        columns.append(pa.concat_arrays([pa.array(nodes[c], kind), pa.nulls(1, kind)]))
    for c, kind in _SPINE_TYPES.items():
        columns.append(pa.concat_arrays([pa.nulls(n, kind), pa.array([spine[c]], kind)]))
    return pa.RecordBatch.from_arrays(columns, names=["block", *_NODE_NAMES, *_SPINE_TYPES])


def _forests(block_turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, turns = [], 0
        for batch in batches:
            sizes = batch.column(0).value_lengths().to_numpy(zero_copy_only=False) + 1  # a path costs something, too
            at = 0
            while at < batch.num_rows:
                fits = int(np.searchsorted(np.cumsum(sizes[at:]), block_turns - turns, "left")) + 1
                part = batch.slice(at, fits)
                held.append(part)
                turns += int(sizes[at : at + fits].sum())
                at += part.num_rows
                if turns >= block_turns:
                    yield _block_forest(held, number)
                    held, turns, number = [], 0, number + 1
        if held:
            yield _block_forest(held, number)

    return run


_MERGED = (
    "block long, side long, at long, node long, conv_id long, depth long, parent_node long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, digest string"
)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spines of all blocks in sorted order to finished nodes (``block`` NULL) and to what open node became which."""
    path: list[list] = []  # of each open node: token, size, number, ends, least, sums over finished children, digest
    names = [c.split()[0] for c in _MERGED.split(", ")]
    out: list[tuple] = []
    made = 0

    def close(depth: int) -> None:
        while len(path) > depth:
            _, size, number, ends, least, n, kid_least, kids, leaves, saved, digest = path.pop()
            n, least, leaves = n + ends, min(least, kid_least), leaves if kids else 1
            saved += (n - 1) * size
            up = path[-1] if path else None
            out.append((None, None, None, number, least, len(path), up[2] if up else None, n, kids, leaves, saved, digest or NOTHING))
            if up:
                up[5:10] = up[5] + n, min(up[6], least), up[7] + 1, up[8] + leaves, up[9] + saved

    def put(block: int, side: int, depth: int, token: bytes, size: int, sums: list[int], digest: str | None) -> None:
        nonlocal made
        if depth == len(path):
            made += 1
            path.append([token, size, made, 0, NONE, 0, NONE, 0, 0, 0, None])
        node = path[depth]
        ends, least, n, kid_least, kids, leaves, saved = sums
        node[3:] = [node[3] + ends, min(node[4], least), node[5] + n, min(node[6], kid_least), node[7] + kids,
                    node[8] + leaves, node[9] + saved, digest or node[10]]
        out.append((block, side, depth, node[2], *[None] * 8))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string() if c == "digest" else pa.int64() for c in names]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for row in batch.to_pylist():
            tokens, sizes = [b"", *row["first"]], [0, *row["first_sizes"]]
            same = 0
            while same < min(len(path), len(tokens)) and path[same][0] == tokens[same]:
                same += 1
            close(same)
            for d, token in enumerate(tokens):
                put(row["block"], 0, d, token, sizes[d], row["left"][7 * d : 7 * d + 7], row["left_digests"][d])
            close(row["common"] + 1)
            for k, d in enumerate(range(row["common"] + 1, len(row["last"]) + 1)):
                token, size = row["last"][d - 1], row["last_sizes"][d - 1]
                put(row["block"], 1, d, token, size, row["right"][7 * k : 7 * k + 7], row["right_digests"][k])
            if len(out) > 10_000:
                yield batch_of(out)
                out.clear()
    close(0)
    if out:
        yield batch_of(out)


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(paths: DataFrame, block_turns: int = 1 << 19, task_turns: int = 1 << 14) -> DataFrame:
    """The nodes of the trie of ``paths`` (``conv_id``, ``turns``: array of ``token``, ``size``), from ``turn_paths``.

    One row per node: ``conv_id`` the smallest member, ``depth``, ``parent_conv_id`` that of its parent (NULL for the root),
    ``n_convs`` members, ``n_children``, ``n_leaves`` of its subtree, ``saved_tokens`` over its subtree (members but one
    times the size of the node's turn), ``ends_sha256`` of the ids that end there, ascending, joined by commas.
    ``conv_id`` is unique and not NULL, as ``turn_paths`` gives it. Without conversations there is no node;
    a conversation without turns ends at the root. A task holds the hashes of about ``block_turns`` turns, or of one
    longer conversation. There are tasks for every ``task_turns`` turns, up to the session's number of shuffle
    partitions, and more only from a million turns each.
    """
    spark = paths.sparkSession
    keyed = paths.withColumns({"s1": F.xxhash64("turns.token"), "s2": F.xxhash64(F.lit(1), "turns.token")})
    held, seen = materialize(keyed, "paths", F.sum(F.size("turns") + 1).alias("turns"))
    turns = seen["turns"] or 0
    parts = max(1, -(-turns // (1 << 20)), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // task_turns)))
    ends = stored(_ends(held, parts), "ends").select("n", "least", "digest")
    items = held.join(ends, F.col("conv_id") == F.col("least")).select("turns", "n", "least", "digest")
    items = stored(items, "items")  # the range of paths is sampled from it
    ordered = items.repartitionByRange(parts, "turns").sortWithinPartitions("turns")
    made = stored(shipped(ordered).mapInArrow(_forests(block_turns), f"block long, {NODES}, {SPINES}"), "forests")
    spines = made.where("common is not null").select("block", *_SPINE_TYPES)
    spines = spines.repartition(1).sortWithinPartitions("first")  # a row for each block
    merged = stored(shipped(spines).mapInArrow(_merged, _MERGED), "merged")
    ids = merged.where("block is null").select("node", F.col("conv_id").alias("id"))
    top = merged.where("block is null").drop("node").join(ids.withColumnRenamed("node", "parent_node"), "parent_node", "left")
    top = top.select("conv_id", "depth", F.col("id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "digest")
    became = merged.where("block is not null").join(ids, "node").select("block", F.col("side").alias("ref_side"), F.col("at").alias("ref_depth"), "id")
    became = checked(became, "became", 32)
    nodes = made.where("common is null").join(became, ["block", "ref_side", "ref_depth"], "left")
    nodes = nodes.select(
        "conv_id", "depth", F.coalesce("id", "parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "digest"
    )
    return nodes.unionAll(top).toDF(*NODE)
