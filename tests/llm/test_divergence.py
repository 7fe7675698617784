"""Divergence of sources against plain counting, with small blocks and levels, and on messy documents."""

import random
import re
from collections import Counter, defaultdict

from conftest import values

from tidefeed.llm import divergence

DDL = "doc_id long, text string, lang string, source string, word string, n int, p int, `rank` int"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return ["".join(c.lower() if c.isascii() else c for c in t) for t in TERM.findall(text or "")]


def brute_force(docs, least, top):
    docs = [(lang or "", source or "", terms_of(text)) for text, lang, source in docs]
    holds, groups = Counter(), defaultdict(Counter)
    for lang, source, terms in docs:
        holds.update((lang, t) for t in set(terms))
        groups[lang, source].update(terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (k, t), n in holds.items() if k == lang and n >= least)
        mine = {s: c for (k, s), c in groups.items() if k == lang}
        whole = sum(mine.values(), Counter())

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        usual, p = shares(whole), {s: shares(c) for s, c in mine.items()}
        for s in mine:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in mine if o != s]
            more = [(usual[t] - p[s][t], t.encode(), t) for t in kept if mine[s][t] and p[s][t] > usual[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(more)[:top])):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(found)]
    return sorted(out, key=lambda r: tuple((x is not None, str(x)) for x in r))


def found(rows, docs, least=3, top=4, **sizes):
    df = rows(DDL, *[(i, *d, "w", 1, 2, 3) for i, d in enumerate(docs)])
    return values(divergence.divergence(df.repartition(3), least, top, **sizes))


def test_against_plain_counting(rows):
    rng = random.Random(4)
    vocabulary = ["a", "An", "ant", "anti", "antics", "anticipation", "é", "éé", "ééé", "straße", "Donaudampfschifffahrt" * 3]
    vocabulary += [f"{a}{b}{c}" for a in ("pre", "un") for b in ("fix", "seen") for c in ("ed", "edly", "ing", "ings")]
    docs = []
    for i in range(200):
        words = rng.choices(vocabulary[: 4 + i % 20], k=rng.randrange(0, 12)) + ["rare" * (i % 50)]
        docs.append((", ".join(words) + f" {i}x{i}", rng.choice(["en", "de", None]), f"s{rng.randrange(7) if i % 3 else 0}"))
    want = brute_force(docs, 3, 4)
    assert found(rows, docs) == want
    small = dict(levels=divergence.Levels(first=1, filter_bits=5, held=8), blocks=divergence.Blocks(sources=2, words=3))
    assert found(rows, docs, **small) == want  # a map so full that it lets most through, and many flushes
    assert {r[2] for r in want} == {"pair", "term"}


def test_messy_documents(rows):
    long = "word " * 30000 + "end"
    docs = [
        (None, "en", "a"), ("", "en", "b"), ("1 2 3 \x00 @ [ `", "en", None), (long, "en", "c"), ("WORD Word wORD", "en", "c"), ("word", "en", "c"),
        ("word", None, None), ("alone", "fr", "x"), ("Ä ä Ä", "tr", "\U0001f600"), ("Ä", "tr", "￿"), ("Ä end", "tr", "a"), ("x" * 70000, "tr", "a"),
        ("x" * 70000, "tr", "b"), ("y" + "x" * 70000, "tr", "b"), ("x" * 70000, "tr", "￿"),
    ]
    assert found(rows, docs) == brute_force(docs, 3, 4)
    assert found(rows, docs, least=100) == brute_force(docs, 100, 4)  # no word counts
    assert found(rows, []) == []
    none = [(None, None, None), (None, "en", "a"), (None, "en", "b")]
    assert found(rows, none) == brute_force(none, 3, 4)


def test_refinement_discards_words_before_they_move(rows):
    docs = [(f"common{'x' * (i % 3)} q{chr(97 + i // 26)}{chr(97 + i % 26)}zzzz", "en", "a") for i in range(90)]
    df = rows("text string, lang string, source string", *docs)
    kept = divergence.common_words(df, 5)
    assert sorted(r.word for r in kept.collect()) == ["common", "commonx", "commonxx"]


def test_shares_are_exact_beyond_a_long(rows):
    n = 9_000_000_000_000_000
    df = rows("n long, total long, v long", (n, 3 * n, 7), (0, 1, 1))
    p = [r[0] for r in df.select(divergence._share("n", "total", "v")).collect()]
    assert p == [1 + 10**9 * (n + 5) // (3 * n + 35), 1 + 10**9 * 5 // 6]
