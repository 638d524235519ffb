from __future__ import annotations

import hashlib
import random
from collections import Counter

import edge
import numpy as np
import pytest
from edge import SF_SMALL
from oracle import compare, duck

from vigil.llm import substrings
from vigil.llm.words import hash_words, split_words


def brute(rows, window=50):
    low = {}
    for i, t in rows:
        w = edge.words(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if i is not None:
                low[key] = min(low.get(key, i), i)
    out = []
    for i, t in rows:
        w = edge.words(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and low[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        out.append((i, w, [x for x, g in zip(w, gone, strict=True) if not g]))
    return out


def digests(rows):
    return Counter((i, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
                   for i, w, kept in rows)


def passages(seed: int, n: int = 60):
    """Documents that share passages, nested and overlapping ones too, and copies of whole documents."""
    rng = random.Random(seed)
    shared = [edge.prose(rng, rng.choice([49, 50, 51, 80, 200]), 30) for _ in range(8)]
    shared.append(shared[-1][: len(shared[-1]) // 2] + " " + edge.prose(rng, 60))
    rows = []
    for i in rng.sample(range(1000), n):
        parts = [edge.prose(rng, rng.randrange(80), 30)]
        for _ in range(rng.randrange(4)):
            parts += [rng.choice(shared), edge.prose(rng, rng.randrange(60), 30)]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(parts)))
    # A passage whose last word is longer by a byte below the space in another document.
    low = edge.prose(rng, 60, 30)
    rows += [(4000, low + " x"), (4001, low + "\x01"), (4002, low), (4003, low + "\x01 y"), (4004, "z " + low)]
    return rows + [(2000 + k, rows[k][1]) for k in range(5)] + [(3000, "a " * 200), (3001, "a " * 150)]


@pytest.mark.parametrize("limit", [2000, 1])
def test_shared_passages_match_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(substrings.repeated_ranges, "__defaults__", (50, 12, limit))
    rows = passages(limit)
    got = substrings.dedup_digests(edge.documents(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == digests(brute(rows))


def test_edge_table_matches_brute_force(spark):
    got = substrings.dedup_digests(edge.documents(spark)).collect()
    assert Counter(tuple(r) for r in got) == digests(brute(edge.texts()))
    assert substrings.dedup_digests(edge.documents(spark, [])).count() == 0


def test_texts_lose_only_the_repeated_words(spark):
    rows = edge.texts() + passages(5)
    docs = edge.documents(spark, rows)
    got = substrings.dedup_substrings(docs)
    assert got.schema == docs.schema
    want = Counter()
    for (i, t), (_, w, kept) in zip(rows, brute(rows), strict=True):
        want[(i, t if len(w) == len(kept) else " ".join(kept))] += 1
    out = got.collect()
    assert Counter((r.doc_id, r.text) for r in out) == want
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out)
    assert Counter(r.score for r in out) == Counter(r.score for r in docs.collect())


def test_segments_cover_every_window_once(monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK_WORDS", 64)
    import pyarrow as pa

    rng = random.Random(4)
    texts = [edge.prose(rng, n, 20) for n in (0, 49, 50, 51, 300, 120)]
    w = split_words(pa.array(texts))
    seen = Counter()
    for text, start, n, _, _ in substrings.segments(hash_words(w), w.first):
        for t, s, k in zip(text, start, n, strict=True):
            seen.update((int(t), int(s) + i) for i in range(int(k)))
    assert seen == Counter((t, s) for t, x in enumerate(texts) for s in range(len(x.split()) - 49))


def test_sliding_min():
    x = np.random.default_rng(0).integers(0, 100, 500)
    for width in (1, 2, 3, 39, 64):
        assert (substrings.sliding_min(x, width) == [x[i:i + width].min() for i in range(501 - width)]).all()


def test_maximal_repeats_of_a_subtree():
    tree = substrings.Subtree([b"a b c d", b"x b c d", b"b c"], [3, 3, 1], 2)
    assert sorted((depth, sorted(leaves)) for depth, leaves in ((d, tree.leaves[a:b]) for d, a, b in tree.deep_nodes())) == [
        (2, [(0, 1), (1, 1), (2, 0)]), (2, [(0, 2), (1, 2)]), (3, [(0, 1), (1, 1)])]
    # "c d" is part of "b c d" wherever it is.
    assert sorted((depth, sorted(leaves)) for depth, leaves in tree.maximal_repeats()) == [
        (2, [(0, 1), (1, 1), (2, 0)]), (3, [(0, 1), (1, 1)])]


@pytest.mark.parametrize("seed", range(40))
def test_maximal_repeats_match_brute_force(seed):
    """Every repeated run of words that cannot be extended on either side, and no other; words with bytes below a space too."""
    rng = random.Random(seed)
    alphabet = [b"a", b"a\x01", b"b", b"\x00", b"ab"][: rng.randrange(1, 6)]
    window = rng.randrange(1, 4)
    texts = [[rng.choice(alphabet) for _ in range(rng.randrange(window, 12))] for _ in range(rng.randrange(1, 6))]
    places: dict[tuple, set] = {}
    for t, words in enumerate(texts):
        for k in range(len(words)):
            for m in range(window, len(words) - k + 1):
                places.setdefault(tuple(words[k:k + m]), set()).add((t, k))
    want = []
    for run, at in places.items():
        after = {texts[t][k + len(run)] if k + len(run) < len(texts[t]) else None for t, k in at}
        before = {texts[t][k - 1] if k else None for t, k in at}
        if len(at) > 1 and (len(after) > 1 or None in after) and (len(before) > 1 or None in before):
            want.append((len(run), sorted(at)))
    tree = substrings.Subtree([b" ".join(t) for t in texts], [len(t) - window + 1 for t in texts], window)
    assert sorted((depth, sorted(leaves)) for depth, leaves in tree.maximal_repeats()) == sorted(want)


def test_query_matches_its_sql(spark):
    ok, message = compare(substrings.op6_substrings(spark, SF_SMALL), duck(SF_SMALL), substrings.ORACLE)
    assert ok, message
