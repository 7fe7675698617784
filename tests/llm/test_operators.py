"""The operators on hand-made tables: NULLs, empty and long texts, ties, repeats, clashing names, nothing."""

import base64
import hashlib
import itertools
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import values

from tidefeed.llm import capfilter, columns, decontam, jaccard, langid, linedup, pieces, quality, toxicity, urlrules, warc
from tidefeed.llm import text as T
from tidefeed.llm.columns import crc_part
from tidefeed.llm.sharing import components

LONG = " ".join(f"word{i % 977}" for i in range(60000))
DOCS = "doc_id long, text string, lang string, n_words int, hits string, digest string, `a.b` int"


@pytest.fixture
def messy(rows):
    """Documents with everything that may be wrong with them."""
    line = "a line of more than forty characters that many share"
    texts = [
        (1, "one two three four five six seven eight nine ten"),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (5, LONG),
        (6, LONG + " end"),
        (7, "One TWO three four five six seven eight nine ten"),
        (7, "One TWO three four five six seven eight nine ten"),
        (None, "one two three four five six seven eight nine ten"),
        (8, "só é"),
        (9, "café ☃ ▁ x\x00y"),
        *[(10 + i, f"{line}\n{i} own") for i in range(6)],
    ]
    return rows(DOCS, *[(i, t, None, 7, "h", "d", 1) for i, t in texts])


def shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").split(" ") if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def roots_of(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_word_hashes_follow_the_words():
    texts = ["Ab aB", "", "ab", "x" * 300_000 + " ab", "é-é"]
    data, offsets = T.text_buffers(pa.array(texts))
    w = T.words(data, offsets, T.NOT_BLANK)
    assert np.diff(w.first).tolist() == [2, 0, 1, 2, 1]
    assert len({w.hash[i] for i in (0, 1, 2, 4)}) == 1 and len(set(w.hash.tolist())) == 3
    assert np.diff(T.words(data, offsets, T.ALNUM).first).tolist() == [2, 0, 1, 2, 2]
    assert [x for x in T.groups(offsets)] == [(0, 3), (3, 4), (4, 5)]


def test_components(rows):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(40)]
    links += [(500, 500 + i) for i in range(1, 60)] + [(7, 7)]
    nodes = {n for a, b in links for n in (a, b) if a != b}
    found = dict(values(components(rows("a long, b long", *links))))
    assert found == {n: r for n, r in roots_of(nodes, [x for x in links if x[0] != x[1]]).items()}
    assert components(rows("a long, b long")).count() == 0


# 1


def items_hit(text, items, window=13):
    words = decontam.split_words(text)
    hit, found = set(), set()
    for number, item in items:
        mine = decontam.split_words(item)
        size = min(window, len(mine))
        for i, j in itertools.product(range(len(mine) - size + 1), range(len(words) - size + 1)):
            if size and mine[i : i + size] == words[j : j + size]:
                hit |= set(range(j, j + size))
                found.add(number)
    return len(words), len(hit), len(found)


def test_decontamination_against_brute_force(rows):
    rng = random.Random(1)
    word = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(word, k=n))) for i, n in enumerate([1, 2, 3, 6, 12, 13, 14, 20, 40, 60])]
    items += [(90, "la la la la la la la la la la la la la la la la"), (91, ""), (92, None), (93, items[8][1])]
    docs = []
    for i in range(60):
        parts = [" ".join(rng.choices(word, k=rng.randrange(40))) for _ in range(3)]
        cut = decontam.split_words(rng.choice(items)[1])
        a = rng.randrange(len(cut) + 1)
        parts.insert(1, "; ".join(w.decode().upper() for w in cut[a : a + rng.randrange(5, 30)]))
        docs.append((i, " ".join(parts)))
    docs += [(100, "la " * 50), (101, None), (102, ""), (103, "w1")]
    out = decontam.decontaminate(rows("doc_id long, text string", *docs), rows("item_id long, text string", *items), ["doc_id"])
    found = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in out.collect()}
    assert found == {i: items_hit(t, items) for i, t in docs}
    assert sum(n > 0 for _, n, _ in found.values()) > 20


def test_decontamination_of_messy_rows(messy, rows):
    items = rows("item_id long, text string", (5, "three four five"), (5, "six seven"), (None, "word3 word4"), (None, None))
    out = decontam.decontaminate(messy, items, messy.columns)
    assert out.count() == messy.count()
    by = {r.doc_id: r for r in out.where("doc_id in (1, 2, 3, 5, 7)").collect()}
    assert by[1].n_hit == by[7].n_hit == 5 and by[1].n_items == 1 and by[1].contaminated and by[1].hits == "h"
    assert by[1].items_sha256 == hashlib.sha256(b"5").hexdigest() and by[1].spans == [[2, 7]]
    assert (by[2].n_words, by[3].n_words, by[5].n_words) == (0, 0, 60000) and by[5].items == []
    assert out.where("doc_id is null").first().n_hit == 5
    assert decontam.decontaminate(messy, items.limit(0), ["doc_id"]).where("n_hit > 0").count() == 0
    assert decontam.decontaminate(messy.limit(0), items, ["doc_id"]).count() == 0


# 2


def segmentations(text, p):
    """All segmentations of a text and their probabilities, by plain recursion."""
    surface = {s.decode(): (i, p.log_p[i]) for i, s in enumerate(p.surfaces) if s}
    text = " " + text

    def paths(at):
        if at == len(text):
            yield (), 0.0
        for size in range(1, min(p.longest, len(text) - at) + 1):
            part = text[at : at + size]
            if part in surface:
                step, cost = (surface[part][0],), surface[part][1]
            elif size == 1:
                step = tuple(int(p.byte_id[b]) for b in part.encode())
                cost = p.log_p[p.byte_id[0]] * len(step)
            else:
                continue
            for rest, more in paths(at + size):
                yield step + rest, cost + more

    every = dict(paths(0))
    total = np.logaddexp.reduce(list(every.values()))
    return {k: v - total for k, v in every.items()}


@pytest.fixture(scope="module")
def model():
    with open(pieces.MODEL, "rb") as file:
        return pieces.load(file.read(), 0.3)


def draws(text, n, k, model):
    one = np.frombuffer(text.encode(), np.uint8)
    seeds = T.mix(np.arange(n, dtype=np.uint64))
    return pieces.sample_texts(np.tile(one, n), np.arange(n + 1) * len(one), seeds, model, k)


def test_samples_are_drawn_without_replacement(model):
    text = "hers ☃"
    exact = segmentations(text, model)
    first, second, n = Counter(), Counter(), 4000
    for samples in draws(text, n, 2, model):
        a, b = (tuple(int(i) for i in s.ids) for s in samples)
        assert a != b and samples[0].score > samples[1].score
        assert samples[0].log_p == pytest.approx(exact[a]) and samples[1].log_p == pytest.approx(exact[b])
        first[a] += 1
        second[b] += 1
    prob = {k: np.exp(v) for k, v in exact.items()}
    for s in sorted(prob, key=prob.get)[-5:]:
        after = sum(p * prob[s] / (1 - p) for t, p in prob.items() if t != s)
        assert first[s] / n == pytest.approx(prob[s], abs=0.04)
        assert second[s] / n == pytest.approx(after, abs=0.04)


def test_samples_run_out(model):
    text = "ab"
    exact = segmentations(text, model)
    found = draws(text, 3, len(exact) + 5, model)
    for samples in found:
        assert {tuple(int(i) for i in s.ids) for s in samples} == set(exact)
        assert all(s.inclusion == 0 for s in samples)
        assert all(a.score >= b.score for a, b in zip(samples, samples[1:]))


def test_a_task_that_samples_holds_little(spark, monkeypatch):
    """Two megabytes of texts of mostly different words, by the function that runs in a task."""
    from pyspark.sql import functions as F

    taken = {}
    monkeypatch.setattr(pieces, "mapped", lambda docs, keep, given, added, run: taken.update(run=run))
    pieces.encode(spark.range(1), F.col("id"), ["id"])
    draw = random.Random(7)
    texts = [" ".join(f"{draw.randrange(16**9):x}" for _ in range(400)) for _ in range(520)]
    keys = pa.array(range(len(texts)), pa.int64())

    def ids():
        return [x for made in taken["run"]([keys], [keys, pa.array(texts)]) for x in made[1 + pieces._IDS_AT].to_pylist()]

    ids()  # tables that stay are built by now
    tracemalloc.start()
    for _ in taken["run"]([keys], [keys, pa.array(texts)]):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6
    few = ids()
    monkeypatch.setattr(pieces, "WALK_BYTES", 1 << 20)
    assert few == ids()  # samples don't depend on which texts walk together


def test_encoding_of_messy_rows(messy, rows, model):
    from pyspark.sql import functions as F

    out = pieces.encode(messy, F.col("doc_id"), messy.columns, k=3, with_ids=True)
    found = out.collect()
    assert len(found) == messy.count() and all(r.round_trip for r in found)
    by = {r.doc_id: r for r in found}
    assert by[2].n_samples == by[3].n_samples == 0 and by[5].n_samples == 3 and by[1].hits == "h"
    for r in found:
        assert pieces.decode(r.pieces, model) == (r.text or "")
        assert all(x <= 0 for x in r.inclusion) and len(set(r.digests)) == r.n_samples
    twice = [r.digests for r in found if r.doc_id == 7]
    assert twice[0] == twice[1]  # equal keys and texts
    again = pieces.encode(messy.repartition(3), F.col("doc_id"), ["doc_id"], k=3)
    assert {(r.doc_id, tuple(r.digests)) for r in again.collect()} == {(r.doc_id, tuple(r.digests)) for r in found}
    assert pieces.encode(messy.limit(0), F.col("doc_id"), ["doc_id"]).count() == 0


def test_all_samples_come_out_and_decode(spark, messy, rows, model):
    from pyspark.sql import functions as F

    out = pieces.encode(messy, F.col("doc_id"), ["doc_id", "text"], k=3)
    back = pieces.decode_samples(out, out.columns)
    found = back.collect()
    assert len(found) == messy.count() and max(r.n_samples for r in found) == 3
    for r in found:
        assert [len(x) for x in r.ids] == r.n_pieces and len({tuple(x) for x in r.ids}) == r.n_samples
        assert [hashlib.sha256(np.array(x, "<i4").tobytes()).hexdigest() for x in r.ids] == r.digests
        assert r.texts == [r.text] * r.n_samples
    assert values(pieces.encode(messy, F.col("doc_id"), ["doc_id", "text"], k=3, with_texts=True)) == values(back)
    assert pieces.decode_samples(out.limit(0), ["doc_id"]).count() == 0
    a, bad = int(model.byte_id[ord("a")]), int(model.byte_id[0xFF])
    odd = rows(
        "n int, ids array<array<int>>, texts int",
        *[(0, None, 1), (1, [], 1), (2, [[], None, [a]], 1), (3, [[a, None], [a, 10**6], [-1], [a, a]], 1), (4, [[a, bad, a]], 1)],
    )
    texts = dict(values(pieces.decode_samples(odd, ["n", "texts"])))
    assert texts == {0: None, 1: [], 2: ["", None, "a"], 3: [None, None, None, "aa"], 4: ["a\ufffda"]}


def test_query_and_last_stage_carry_all_samples(spark):
    import corpus_pipeline
    from tidefeed.llm.catalogue import QUERIES

    at = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{at}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    for out in (QUERIES["op2_sentencepiece"](spark, at), corpus_pipeline.sentencepiece_stage(spark, docs, at)):
        found = out.collect()
        assert len(found) == len(text) and all(len(r.ids) == r.n_samples for r in found)
        assert max(r.n_samples for r in found) == 2
    for r in QUERIES["op2_sentencepiece"](spark, at).collect():
        assert r.texts == [text[r.doc_id]] * r.n_samples


# 3


def linked_vectors(data, least=0.98):
    units = {}
    for k, (_, v, label) in enumerate(data):
        if v is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.asarray(v, np.float64)
            units[k] = (x / np.sqrt((x * x).sum()), label)
    return [
        (a, b)
        for a, b in itertools.combinations(units, 2)
        if units[a][1] == units[b][1] and len(units[a][0]) == len(units[b][0]) and units[a][0] @ units[b][0] >= least
    ]


@pytest.mark.parametrize("block", [512, 7])
def test_near_vectors_against_brute_force(rows, block):
    rng = np.random.default_rng(5)
    data = []
    for centre in rng.normal(size=(60, 24)):
        for _ in range(rng.integers(1, 9)):
            v = centre + rng.normal(size=24) * rng.choice([0.02, 0.08, 0.14])
            data.append([len(data), [float(np.float32(x)) for x in v], int(rng.integers(0, 2))])
    data += [[len(data) + i, data[3][1], data[3][2]] for i in range(5)]  # copies
    none = [None, [], [0.0] * 24, [1.0, None], [float("nan")] * 24, [float("inf")] * 24]
    data += [[1000 + i, v, 1] for i, v in enumerate(none)] + [[1010 + i, v, 1] for i, v in enumerate(none)]
    data += [[2000, data[0][1], None], [2001, data[0][1], None], [2002, [1.0, 0.0], 1], [2003, [2.0, 0.0], 1]]
    links = linked_vectors(data)
    n = Counter(x for pair in links for x in pair)
    roots = roots_of(range(len(data)), links)
    df = rows("vec_id long, embedding array<float>, label int, filters int, cls int", *[(*d, 1, 2) for d in data])
    found = values(capfilter.near_duplicates(df, block=block))
    want = sorted((d[0], n[k], data[roots[k]][0], roots[k] == k) for k, d in enumerate(data))
    got = sorted(found)
    missed = sum(a != b for a, b in zip(got, want))
    assert len(got) == len(want) and missed <= 0.01 * len(want)
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want)
    assert capfilter.near_duplicates(df.limit(0)).count() == 0


def test_list_decoding_lists_all(rows):
    plan = capfilter.CapCode(blocks=2, words=8, bound=1.5)
    x = np.random.default_rng(1).normal(size=(50, 10))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rotation, words = code = capfilter.directions(10, plan)[0]
    every = np.array([np.concatenate([words[0][i], words[1][j]]) for i in range(8) for j in range(8)]) / np.sqrt(2)
    scores = (x @ rotation) @ every.T
    for found, mine in zip(capfilter.list_decode(x, code, plan), scores):
        above = set(np.flatnonzero(mine >= plan.bound / np.sqrt(10)))
        assert above <= set(found) and (set(found) == above or len(above) < plan.least)


# 4


def check_jaccard(rows, docs, **options):
    df = rows("doc_id long, text string, digest int, sigs int", *[(*d, 1, 2) for d in docs])
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(df).collect()}
    sets = {i: shingles(t) for i, t in docs}
    links = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    roots = roots_of(sets, links)
    assert found == {i: (len(s), roots[i]) for i, s in sets.items()}
    return links


def test_jaccard_against_brute_force(rows):
    rng = random.Random(11)
    word = [f"v{i}" for i in range(400)]
    docs = []
    for size in [1, 2, 4, 5, 6, 8, 9, 11, 14, 20, 33, 50, 80, 200, 600]:
        for _ in range(4):
            base = rng.choices(word, k=size)
            for _ in range(6):
                mine = list(base)
                for _ in range(rng.choice([0, 0, 1, 1, 2, max(1, size // 40)])):
                    at = rng.randrange(len(mine) + 1)
                    mine[at : at + rng.randrange(2)] = [rng.choice(word)] * rng.randrange(2)
                docs.append((len(docs), " ".join(mine)))
    assert len(check_jaccard(rows, docs)) > 100


def test_jaccard_of_large_groups_and_shared_passages(rows):
    """Groups beyond what a signature may have: copies with small changes, and a passage in half of all."""
    rng = random.Random(12)
    word = [f"v{i}" for i in range(5000)]
    passage, base = rng.choices(word, k=60), rng.choices(word, k=150)
    docs = []
    for i in range(90):
        mine = list(base)
        mine[rng.randrange(150)] = f"own{i}"
        docs.append((len(docs), " ".join(mine)))
    for i in range(120):
        docs.append((len(docs), " ".join(passage + rng.choices(word, k=rng.randrange(0, 60)))))
    for k in range(100, 190, 6):  # near copies at the edge of similarity among those
        docs.append((len(docs), docs[k][1] + " " + " ".join(rng.choices(word, k=rng.randrange(4, 30)))))
    assert len(check_jaccard(rows, docs)) > 4000


def test_jaccard_deals_a_large_group_in_blocks(rows):
    """No task key holds more than two blocks of a hot group, and each two of its documents meet once."""
    met = rows("key long, k long, doc_id long", *[(5, 300, i) for i in range(300)], *[(6, 9, i) for i in range(9)])
    tasks = defaultdict(list)
    for r in jaccard._dealt(met, 20).collect():
        tasks[r.key, r.x, r.y].append((r.own, r.doc_id))
    assert len([t for t in tasks if t[0] == 5]) > 100 and len([t for t in tasks if t[0] == 6]) == 1
    assert max(map(len, tasks.values())) <= 80
    seen = Counter()
    for (key, x, y), members in tasks.items():
        for (o, a), (p, b) in itertools.combinations(members, 2):
            if x == y or o != p:
                seen[key, min(a, b), max(a, b)] += 1
    assert set(seen.values()) == {1} and len(seen) == 300 * 299 // 2 + 9 * 8 // 2


def test_jaccard_in_blocks_against_brute_force(rows, monkeypatch):
    """Documents of a template with own words, mostly below the threshold towards each other."""
    monkeypatch.setattr(jaccard, "BLOCK", 10)
    rng = random.Random(21)
    word = [f"v{i}" for i in range(5000)]
    template, docs = rng.choices(word, k=48), []
    for i in range(110):
        docs.append((i, " ".join(template + rng.choices(word, k=rng.randrange(9, 15)))))
    for k in range(0, 110, 5):
        docs.append((len(docs), docs[k][1] + " " + " ".join(rng.choices(word, k=rng.randrange(3, 15)))))
    assert len(check_jaccard(rows, docs)) > 20


def test_jaccard_files_documents_of_one_range_of_sizes_once(rows):
    """Two that may be similar meet in the larger one's range; the next range is left out if no document is of its sizes."""
    held = [(7, i, i, n) for i, n in enumerate([100, 104, 108])]  # one range
    held += [(8, 10 + i, 10 + i, n) for i, n in enumerate([90, 104, 120, 140, 150])]  # several
    found = jaccard._of_like_size(rows("key long, doc_id long, root long, n long", *held)).collect()
    assert Counter(r.doc_id for r in found if r.key == 7) == {0: 1, 1: 1, 2: 1}
    met = {(a.doc_id, b.doc_id) for a, b in itertools.combinations(sorted(found, key=lambda r: r.doc_id), 2) if (a.key, a.sizes) == (b.key, b.sizes)}
    alike = {(a[1], b[1]) for a, b in itertools.combinations(held, 2) if a[0] == b[0] and 100 * min(a[3], b[3]) >= 75 * max(a[3], b[3])}
    assert alike <= met and all(r.k == sum((o.key, o.sizes) == (r.key, r.sizes) for o in found) for r in found)


def test_jaccard_puts_pairs_out_in_bounded_batches():
    """A hot group of many entries comes out in batches of at most PART rows."""
    n = 3 * jaccard.PART
    docs = np.arange(n)
    entries = pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int64)), pa.array(docs)], names=["key", "doc_id"])
    out = list(jaccard._candidates(8, star=True)(iter([entries])))
    assert max(b.num_rows for b in out) <= jaccard.PART and sum(b.num_rows for b in out) == 2 * n - 1


def test_a_kept_text_is_sent_to_the_tasks_once(rows):
    """A column that is kept and given is one and the same array in the task."""

    def run(kept, given):
        yield [*kept, pa.array([kept[1].buffers()[2].address == given[0].buffers()[2].address] * len(kept[0]))]

    df = rows("doc_id long, text string", (1, "one"), (2, None), (3, "three"))
    out = columns.mapped(df, ["doc_id", "text"], ["text"], "same boolean", run)
    assert sorted(tuple(r) for r in out.collect()) == [(1, "one", True), (2, None, True), (3, "three", True)]


def test_jaccard_candidates_hold_no_hot_group():
    """A group over many batches is told entry by entry; pairs and losses are those of whole partitions."""
    keys = np.repeat([1, 2, 3, 4, 5], [2, 500, 3, 1, 40])
    docs = np.concatenate([np.arange(10, 10 + n) for n in (2, 500, 3, 1, 40)])
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[a : a + 7]), pa.array(docs[a : a + 7])], names=["key", "doc_id"]) for a in range(0, len(keys), 7)]
    for star in (False, True):
        pairs, lost = set(), Counter()
        for out in jaccard._candidates(8, star)(iter(batches)):
            for r in out.to_pylist():
                if r["b"] is None:
                    lost[r["a"]] += r["n"]
                else:
                    pairs.add((r["a"], r["b"]))
        want = {(10, 11), (10, 12), (11, 12)} | ({(10, i) for i in range(11, 510)} if star else set())
        assert pairs == want and lost == Counter([*range(10, 510), *range(10, 50)])


def test_jaccard_of_messy_rows(messy):
    out = jaccard.similar_documents(messy)
    found = defaultdict(set)
    for r in out.collect():
        found[r.doc_id].add((r.n_shingles, r.component_id))
    assert out.count() == messy.count()
    assert found[1] == found[7] == {(6, 1)} and found[None] == {(6, None)}
    assert found[2] == {(0, 2)} and found[3] == {(0, 3)} and found[4] == {(0, 4)}
    assert found[5] == {(977, 5)} and found[6] == {(978, 5)}
    assert jaccard.similar_documents(messy.limit(0)).count() == 0


def test_enough_credit_for_every_size():
    """Whatever misses a pair must leave its documents short of credit: bands cover all sizes."""
    for n in [1, 2, 3, 5, 8, 13, 40, 47, 48, 49, 100, 1000]:
        band = int(np.searchsorted(jaccard.EDGES, n, "right")) - 1
        assert jaccard.EDGES[band] <= n < jaccard.EDGES[band + 1]
        # A partner lies in the same band or in one next to it.
        assert jaccard.EDGES[max(band - 1, 0)] <= -(-n * 75 // 100) and n * 100 // 75 < jaccard.EDGES[band + 2]


def test_broken_records_do_not_cost_the_others(spark, rows, tmp_path):
    import gzip

    def record(body, page="1", length=None, kind="response", more=""):
        digest = warc.digest_text(b"good")
        size = "" if length == "none" else f"Content-Length: {length or len(body)}\r\n"
        head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nX-Page-ID: {page}\r\nWARC-Payload-Digest: sha1:{digest}\r\n{more}{size}\r\n"
        return head.encode() + body + b"\r\n\r\n"

    good = b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\ngood"
    framed = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n%b\r\ngood\r\n0\r\n\r\n"
    twice = "WARC-Segment-Number: 1\r\nWARC-Segment-Origin-ID: x\r\nWARC-Segment-Total-Length: 43\r\n"
    parts = [
        record(good, "1"), record(good, "2", "none"), record(good, "three"), record(framed % b"4", "4"), record(framed % b"zz", "5"),
        record(framed % b"-4", "6"), record(good.replace(b": 4", b": x"), "7"), record(good, "8", more=twice), record(good, "8", more=twice),
        record(good, "9", "many"), b"junk WARC/ junk", record(good, "10"),
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts) + gzip.compress(record(good, "11"))[:-30])
    (tmp_path / "b.warc").write_bytes(b"".join(parts) + record(good, "12", 10**9))
    (tmp_path / "c.warc").write_bytes(b"no record at all")
    found = Counter((r.page_id, r.intact) for r in warc.read_archives(spark, str(tmp_path)).collect())
    ok = {(1, True): 2, (None, True): 2, (4, True): 2, (10, True): 2}
    assert found == ok | {(i, False): 2 for i in (2, 5, 6, 7, 9)} | {(8, False): 1, (11, False): 1, (12, False): 1}


# 5


def test_cumulative_link_recovers_order():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 6)) < 0.4
    true = np.array([2.0, 1.0, 0.0, -1.0, 3.0, 0.5])
    noisy = x @ true + rng.logistic(size=3000)
    grades = np.digitize(noisy, [1.0, 2.5, 4.0])
    rows, columns = np.nonzero(x)
    weights, cuts = toxicity.fit_cumulative_link(rows, columns, grades, 6, steps=600)
    assert np.all(np.diff(cuts) > 0) and np.allclose(weights, true, atol=0.4) and np.allclose(cuts, [1, 2.5, 4], atol=0.4)


def test_toxicity(rows, messy):
    rng = random.Random(4)
    clean, bad = [f"c{i}" for i in range(200)], ["vile", "nasty", "awful", "rotten"]
    docs, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        words = rng.choices(clean, k=60)
        for w in rng.sample(bad, rng.randrange(1, 5)) if toxic else ():
            words[rng.randrange(60)] = w
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs, labels = rows("doc_id long, text string", *docs), rows("doc_id long, toxic int", *labels, (3, None), (None, 1))
    model = toxicity.learn(docs, labels)
    out = toxicity.score(docs, model, ["doc_id"])
    assert [r.doc_id for r in out.where("toxic").orderBy("doc_id").collect()] == list(range(0, 600, 5))
    worst = {r.severity: r.expected_severity for r in out.orderBy("expected_severity").collect()}
    assert worst[3] > worst[1] > worst[0] >= 0
    assert toxicity.score(messy, model, messy.columns).where("not toxic").count() == messy.count()
    assert toxicity.learn(docs, labels.where("toxic = 0")) is None
    assert toxicity.learn(docs.limit(0), labels) is None
    assert toxicity.score(messy, None, ["doc_id"]).where("toxic").count() == 0


# 6


def test_archive_round_trip(rows):
    big = "é" * 50_000
    pages = rows(
        "page_id long, url string, html string, payload string",
        (1, "http://a/", "<p>x</p>", "p"),
        (2, "http://a/2", "<p>x</p>", "p"),
        (3, None, big, "p"),
        (4, "http://b/\r\nX: y", "", "p"),
        (5, "http://b/", None, "p"),
        (None, "http://c/", "<p>x</p>", "p"),
        (6, "http://c/", "WARC/1.1\r\n\r\n\r\n\r\nContent-Length: 3\r\n\r\nabc", "p"),
        (7, "http://d/", big + "!", "p"),
        (7, "http://d/", big + "!", "p"),
    )
    back = warc.round_trip(pages, segment_bytes=1000, records_per_file=3).collect()
    assert len(back) == 9 and all(r.intact for r in back)
    want = {1: ("<p>x</p>", 2), 2: ("<p>x</p>", None), 3: (big, None), 4: ("", 5), 5: ("", None), None: ("<p>x</p>", 2)}
    for r in back:
        html, refers = want.get(r.page_id, (None, None))
        if html is not None:
            data = html.encode()
            digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
            assert (r.payload_bytes, r.payload_digest, r.refers_to) == (len(data), digest, refers)
            assert r.record_type == ("revisit" if refers else "response")
            assert refers or bytes(r.payload) == data
    assert [r.record_type for r in back if r.page_id == 7] == ["response", "response"]
    assert warc.round_trip(pages.limit(0)).count() == 0
    only = warc.round_trip(pages, min_bytes=9).collect()
    assert Counter(r.record_type for r in only) == {"response": 9}


def test_chunked_framing():
    for size in (0, 1, 9, 8192, 20000):
        data = bytes(random.Random(size).randbytes(size))
        assert warc.unchunked(warc.chunked(data, 100)) == data
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nT: v\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_broken_segments_are_told(spark, tmp_path):
    records = warc.page_records("1", 1, "u", b"x" * 500, None, 200)
    assert len(records) > 2
    (tmp_path / "a.warc").write_bytes(b"".join(r + b"\r\n\r\n" for r in records[1:] + records[:1]))
    assert warc.read_archives(spark, str(tmp_path / "a.warc")).first().intact  # in any order
    (tmp_path / "b.warc").write_bytes(b"".join(r + b"\r\n\r\n" for r in records[:-1]))
    row = warc.read_archives(spark, str(tmp_path / "b.warc")).first()
    assert (row.intact, row.payload, row.page_id) == (False, None, 1)


# 7 and 8


def test_quality(rows, messy):
    rng = random.Random(6)
    word = [f"c{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(500):
        good = i % 4 != 0
        words = rng.choices(word, k=50) if good else [w.upper() + "!!" for w in rng.choices(word[:40], k=50)]
        docs.append((i, " ".join(words)))
        labels.append((i, int(good)))
    docs, labels = rows("doc_id long, text string", *docs), rows("doc_id long, quality int", *labels, (1, None))
    model = quality.learn(docs, labels.where(crc_part("doc_id", 5) != 0))
    held = quality.score(docs, model, ["doc_id"]).where(crc_part("doc_id", 5) == 0)
    assert held.where("(predicted = 1) = (doc_id % 4 != 0)").count() >= 0.95 * held.count()
    out = quality.score(messy, model, messy.columns)
    assert out.where("score between 0 and 1").count() == messy.count()
    assert quality.learn(docs, labels.where("quality = 1")) is None
    assert quality.score(messy, None, ["doc_id"]).where("score = 0.5").count() == messy.count()


def test_crc_part(spark):
    found = spark.range(50).select("id", crc_part("id", 5).alias("p")).collect()
    assert all(r.p == zlib.crc32(str(r.id).encode()) % 5 for r in found)


def test_more_languages_than_any_fixed_number(rows):
    """All languages have a row in the sample as long as it has room; beyond that the sample is still bounded."""
    docs = rows("doc_id long, text string, lang string", *[(i, f"w{i % 1300} x{i % 1300}", f"l{i % 1300}") for i in range(2600)])
    model = langid.learn(docs, min_count=1)
    assert len(model.langs) == 1300 and len(model.word_keys) <= 1_600_000 // 1300
    assert len(langid.learn(docs, max_rows=50, min_count=1).langs) == 50


def test_language(rows, messy):
    rng = random.Random(8)
    syllables = {"aa": ["ka", "mo", "ti", "re"], "bb": ["sch", "eng", "ver", "ung"], "cc": ["é", "lla", "ción", "que"]}
    docs = []
    for i in range(150):
        lang = sorted(syllables)[i % 3]
        words = ["".join(rng.choices(syllables[lang], k=rng.randrange(2, 6))) for _ in range(30)]
        docs.append((i, " ".join(words), lang))
    learnt = rows("doc_id long, text string, lang string", *docs, (900, None, "aa"), (901, "x", None))
    model = langid.learn(learnt.where("doc_id % 4 <> 2"))
    assert model.langs == ["aa", "bb", "cc"]
    out = langid.predict(learnt, model, ["doc_id", "lang"]).where("doc_id < 900")
    assert out.where("lang = lang_pred").count() == 150
    fresh = rows("doc_id long, text string", (1, "kamotirekamotire"), (2, "123 --- !!"), (3, None), (4, ""), (5, "ŋ"))
    found = {r.doc_id: r.lang_pred for r in langid.predict(fresh, model, ["doc_id"]).collect()}
    assert (found[1], found[2], found[3], found[4]) == ("aa", "und", "und", "und") and found[5] in model.langs
    assert langid.predict(messy, model, messy.columns).where("score between 0 and 1").count() == messy.count()
    assert langid.learn(learnt.where("lang is null")) is None
    assert langid.predict(messy, None, ["doc_id"]).where("lang_pred = 'und'").count() == messy.count()


# 9


def test_line_dedup_of_messy_rows(messy):
    out = linedup.dedup_lines(messy)
    assert out.count() == messy.count() and set(messy.columns) <= set(out.columns)
    by = {r.doc_id: r for r in out.collect()}
    assert [by[10 + i].n_dropped for i in range(6)] == [1, 1, 1, 1, 1, 0]
    assert by[10].text == "0 own" and by[15].text.endswith("\n5 own") and by[15].n_lines == 2
    assert (by[2].n_lines, by[2].text, by[3].n_lines, by[4].n_lines) == (1, "", 1, 2)
    assert linedup.dedup_lines(messy.limit(0)).count() == 0


def test_line_dedup_against_brute_force(rows):
    rng = random.Random(9)
    pool = [f"line {i} " + "x" * rng.choice([20, 33, 40]) for i in range(12)]
    docs = [(i, "\n".join(rng.choice(["", " ", "\t"]) + rng.choice([str.upper, str])(rng.choice(pool)) for _ in range(rng.randrange(5)))) for i in range(40)]

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").lower()

    holders = defaultdict(set)
    for i, text in docs:
        for line in text.split("\n"):
            holders[key(line)].add(i)
    want = {}
    for i, text in docs:
        lines = text.split("\n")
        kept = [x for x in lines if len(key(x)) < 40 or len(holders[key(x)]) < 5 or i == max(holders[key(x)])]
        want[i] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    for batches, fanout in ((1, 2), (7, 2), (5, 3)):
        out = linedup.dedup_lines(rows("doc_id long, text string", *docs), batches=batches, fanout=fanout)
        assert {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in out.collect()} == want


def test_runs_are_compacted_by_level(rows):
    docs = rows("doc_id long, text string", *[(i, f"line {i} " + "y" * 40) for i in range(40)])
    runs = linedup.build_runs(docs, batches=9, fanout=3)
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    assert linedup.merged_keys(runs.all()).count() == 40
    assert linedup.count_fresh(docs, runs) == 0
    more = rows("doc_id long, text string", (90, "new " + "z" * 40), (91, "new " + "z" * 40))
    assert linedup.count_fresh(more, runs) == 1


# 10


@pytest.mark.parametrize("share", [0.16, 0.7])
def test_mined_rules_against_enumeration(rows, share):
    """All combinations of tokens, at the thresholds of the query, also where most labels are bad."""
    rng = random.Random(31)
    pages = [(f"http://{rng.choice('abc')}/{rng.choice('def')}/{rng.choice('gh')}", rng.random() < share) for _ in range(300)]
    pages += [("http://a/x/y", True)] * 9 + [("http://b/d/x", True)] * 7
    sets = [({f"h:{h}", *(f"p:{x}" for x in path.split("/"))}, bad) for url, bad in pages for h, path in [url[7:].split("/", 1)]]
    held = {}
    for combination in {c for s, _ in sets for k in (1, 2, 3) for c in itertools.combinations(sorted(s), k)}:
        among = [bad for s, bad in sets if s.issuperset(combination)]
        if sum(among) >= 0.002 * len(sets) and sum(among) >= 0.5 * len(among):
            held[combination] = sum(among) / len(among)
    want = {c: p for c, p in held.items() if not any(tuple(x for x in c if x != y) in held for y in c)}
    mined = urlrules.mine(rows("url string, bad boolean", *pages))
    found = {tuple(r.rule): r.confidence for r in mined.collect()}
    assert want and found == pytest.approx(want)
    best = {}
    for url, _ in pages:
        s = {f"h:{url[7:].split('/', 1)[0]}", *(f"p:{x}" for x in url[7:].split("/")[1:])}
        if hits := [p for c, p in want.items() if s.issuperset(c)]:
            best[url] = max(hits)
    urls = rows("url string", *[(u,) for u, _ in pages])
    assert {r.url: r.confidence for r in urlrules.matches(urls, mined).collect()} == pytest.approx(best)


def test_tokens_that_always_come_together_are_mined_as_one(rows):
    args = "&".join(f"utm{i}=1" for i in range(40))
    pages = [(f"http://s{i}.io/buy?{args}", i % 4 > 0) for i in range(40)] + [(f"http://t{i}.io/buy?q", False) for i in range(900)]
    mined = urlrules.mine(rows("url string, bad boolean", *pages))
    assert sorted((r.rule, r.rarest, r.confidence) for r in mined.collect()) == sorted(([f"q:utm{i}"], f"q:utm{i}", 0.75) for i in range(40))
    urls = rows("url string", ("http://a.org/?utm7",), ("http://a.org/buy",))
    assert [r.url for r in urlrules.matches(urls, mined).collect()] == ["http://a.org/?utm7"]


def test_a_rule_is_filed_under_its_rarest_token(rows):
    bad = [(f"http://{h}{i}.x.com/a/b", True) for i in range(20) for h in "pq"]
    good = [(f"http://p{i}.x.com/a", False) for i in range(200)] + [(f"http://p{i}.x.com/b", False) for i in range(90)]
    mined = urlrules.mine(rows("url string, bad boolean", *bad, *good), min_support=0.05, min_confidence=0.9)
    assert [(r.rule, r.rarest) for r in mined.collect()] == [(["p:a", "p:b"], "p:b")]


def test_url_rules(rows):
    bad = [f"http://x{i}.spam.org/buy/{i}?ref=1" for i in range(30)]
    good = [f"http://y{i}.fine.org/read/{i}?ref=1" for i in range(70)] + [f"http://z.org/buy/{i}?ref=1" for i in range(20)]
    labelled = rows("url string, bad boolean", *[(u, True) for u in bad], *[(u, False) for u in good], (None, True), ("", None))
    mined = urlrules.mine(labelled, min_support=0.05, min_confidence=0.9)
    assert [r.rule for r in mined.collect()] == [["h:spam"]]
    urls = [
        ("http://q.spam.org/", ("q.spam.org", "/", None, "block")),
        ("http://WWW.Example.COM/en/1?x", ("www.example.com", "/en/1", "www.example.com/en/", "allow")),
        ("http://m.example.com/en/1#y", ("m.example.com", "/en/1", "example.com/en/", "block")),
        ("http://example.com", ("example.com", "", None, "allow")),
        ("https://a.net/fr/x", ("a.net", "/fr/x", "net/fr/", "block")),
        ("https://notexample.com/en/", ("notexample.com", "/en/", "com/", "allow")),
        ("://h?q", ("h", "", None, "allow")),
        ("no scheme", ("", "", None, "allow")),
        ("", ("", "", None, "allow")),
        (None, ("", "", None, "allow")),
        (None, ("", "", None, "allow")),
    ]
    pages = rows("page_id long, url string, host int, rule int", *[(i, u, 1, 2) for i, (u, _) in enumerate(urls)])
    found = urlrules.judge(pages, labelled, urlrules.RULES, min_support=0.05, min_confidence=0.9).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in found] == [w for _, w in urls]
    assert urlrules.judge(pages.limit(0), labelled, urlrules.RULES).count() == 0
    assert urlrules.judge(pages, labelled.limit(0), urlrules.RULES).where("verdict = 'block'").count() == 2
