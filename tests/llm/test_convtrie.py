"""The prefix trie against a plain trie, over block and partition boundaries, and on messy conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from conftest import values

from tidefeed.llm import convtrie

DDL = "conv_id long, turn long, role string, text string, depth int, token string, n int"


def brute_force(turns, every=None, most=6):
    """Nodes of the trie of rows ``conv_id``, ``turn``, ``role``, ``text``, rebuilt where ``every`` is given."""
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            role, text = role or "", text or ""
            token = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0), token, len(text), (role, text)))
    paths = {c: [(t[3], t[2]) for t in sorted(rows)] for c, rows in own.items()}
    if every:
        h = {c: zlib.crc32(str(c).encode()) % most for c in paths}
        head = {c: c - int(c / every) * every if c < 0 else c % every for c in paths}
        paths = {c: paths.get(c - head[c], [])[: h[c]] + p[h[c] :] for c, p in paths.items()}
    members, size = defaultdict(list), {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(t for t, _ in path[:d])].append(c)
            size[tuple(t for t, _ in path[:d])] = path[d - 1][1] if d else 0
    kids = defaultdict(list)
    for key in members:
        if key:
            kids[key[:-1]].append(key)
    sums = {}
    for key in sorted(members, key=len, reverse=True):
        leaves = sum(sums[k][0] for k in kids[key]) or 1
        sums[key] = leaves, (len(members[key]) - 1) * size[key] + sum(sums[k][1] for k in kids[key])
    out = []
    for key, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(paths[c]) == len(key))
        above = min(members[key[:-1]]) if key else None
        out.append((min(ids), len(key), above, len(ids), len(kids[key]), *sums[key], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is not None, str(x)) for x in r))


def random_turns(n, seed=0):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        for t in range(rng.randrange(0, 7)):
            out.append((c, t, rng.choice(["user", "tool"]), rng.choice(["", "é", "hello", "hello there"][: 2 + t % 3])))
    return out


@pytest.mark.parametrize("block, task", [(3, 10), (40, 400), (1 << 19, 1 << 14)])
def test_against_a_plain_trie(rows, block, task):
    turns = random_turns(150)
    turns += [(1000 + c, t, "user", "the same") for c in range(70) for t in range(4)]  # a third are one conversation
    df = rows(DDL, *[(*t, 1, "t", 2) for t in turns])
    assert values(convtrie.prefix_trie(convtrie.turn_paths(df), block, task)) == brute_force(turns)


def test_rebuilt_conversations(rows):
    turns = [(c, t, "user", f"{c} {t}") for c in [*range(95, 130), 300, 407, -3, -205] for t in range(c % 9)]
    turns += [(c, 1, "user", "only") for c in (100, 200, 301, 302, 303, 304)]
    df = rows(DDL, *[(*t, 1, "t", 2) for t in turns])
    found = values(convtrie.prefix_trie(convtrie.rebuilt(convtrie.turn_paths(df)), 6, 20))
    assert found == brute_force(turns, 100)
    assert any(r[1] == 0 and r[7] != convtrie.NOTHING for r in found)  # some have lost all their turns


def test_messy_conversations(rows):
    long = "word " * 20000
    turns = [
        (1, None, "user", "first"), (1, 2, None, long), (1, 1, "user", None), (1, 1, "user", None), (2, 0, "", ""),
        (2, 1, None, None), (None, 1, "user", "lost"), (3, 0, "1:a", "b"), (4, 0, "1", ":ab"), (5, 0, "x" * 11, ""),
        (5, None, "x", "x" * 10), *[(6, t, "r", "deep") for t in range(600)], *[(7, t, "r", "deep") for t in range(700)],
    ]
    df = rows(DDL, *[(*t, 1, "t", 2) for t in turns])
    assert values(convtrie.prefix_trie(convtrie.turn_paths(df), 4, 5)) == brute_force(turns)
    for none in (df.limit(0), df.where("conv_id is null")):
        assert convtrie.prefix_trie(convtrie.rebuilt(convtrie.turn_paths(none))).count() == 0
    one = df.where("conv_id = 2 and turn = 0")
    assert values(convtrie.prefix_trie(convtrie.turn_paths(one)).select("depth", "n_leaves")) == [(0, 1), (1, 1)]


def test_digest_of_many_ids_in_pieces(rows, spark):
    ids = range(0, 4000, 3)
    df = rows(DDL, *[(c, 0, "user", "one for all", 1, "t", 2) for c in ids])
    top = convtrie.prefix_trie(convtrie.turn_paths(df)).where("depth = 1").first()
    assert top.ends_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert (top.n_convs, top.saved_tokens) == (len(ids), (len(ids) - 1) * len("one for all"))
