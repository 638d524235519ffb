from __future__ import annotations

import math
import re
from collections import Counter

import edge
import xxhash

from vigil.llm import quality


def bucket(*parts: str) -> int:
    h = 42
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), h)
    return (h - (1 << 64) if h >> 63 else h) % quality.BUCKETS


def expected(rows, trusted):
    grams = []
    for _, text in rows:
        w = edge.words(text)
        grams.append([bucket(x) for x in w] + [bucket(a, b) for a, b in zip(w, w[1:], strict=False)])
    corpus, good = Counter(), Counter()
    for (i, _), g in zip(rows, grams, strict=True):
        corpus.update(g)
        if i is not None and i in trusted:
            good.update(g)
    share = sum(good.values()) / max(1, sum(corpus.values()))
    out = Counter()
    for (i, text), g in zip(rows, grams, strict=True):
        w, t = edge.words(text), text or ""
        seen = Counter(zip(w, w[1:], w[2:], strict=False))
        inside = [False] * len(w)
        for k in range(len(w) - 2):
            if seen[tuple(w[k:k + 3])] > 1:
                inside[k:k + 3] = [True] * 3
        lines = [x for x in t.split("\n") if edge.words(x)]
        base = (len(w), sum(map(len, w)), len(re.findall(quality.SYMBOLS, t)), len(lines) - len(set(lines)),
                sum(inside))
        failed = len(w) < 50 or 100 * base[4] > 50 * len(w)
        score = sum(math.log((good[b] + quality.PRIOR) / (corpus[b] * share + quality.PRIOR)) for b in g) / len(g) if g else 0.0
        out[(i, *base, failed, round(score, 9), not failed and score >= quality.MIN_SCORE)] += 1
    return out


def run(spark, docs, trusted):
    good = spark.createDataFrame([(x,) for x in trusted], "id long")
    rows = quality.score_quality(docs, good).collect()
    return Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed,
                    round(r.score, 9), r.kept) for r in rows)


def test_edge_table_matches_brute_force(spark):
    trusted = [1, 2, 11, 12, 15, 22, 22, None, 999]
    assert run(spark, edge.documents(spark), trusted) == expected(edge.texts(), set(trusted) - {None})


def test_without_trusted_documents_every_score_is_zero(spark):
    got = quality.score_quality(edge.documents(spark), spark.createDataFrame([], "id long")).collect()
    assert {r.score for r in got} == {0.0}


def test_empty_table(spark):
    assert run(spark, edge.documents(spark, []), [1]) == Counter()


def test_symbol_junk_is_rejected_and_prose_kept(spark):
    import random

    rng = random.Random(3)
    clean = [(i, edge.prose(rng, 200, 3000)) for i in range(60)]
    junk = [(100 + i, " ".join(w + "###" for w in edge.prose(rng, 200, 50).split())) for i in range(10)]
    got = run(spark, edge.documents(spark, clean + junk), [i for i, _ in clean[::2]])
    kept = {r[0] for r in got if r[-1]}
    assert kept == {i for i, _ in clean}
