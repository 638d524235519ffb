from __future__ import annotations

import math
import random
import re
from collections import Counter

import edge
import numpy as np
import pytest
from edge import SF_SMALL
from oracle import compare, duck

from vigil.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text: str | None) -> list[str]:
    return TERM.findall(edge.lower(text or ""))


def expected(items, docs, top=10) -> Counter:
    """Every score of every item, ranked."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    total = sum(1 for _, c in held if c)
    length = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = Counter()
    for item, text in items:
        found = []
        for doc, c in held:
            m = 100 - 90 + 90 * sum(c.values()) * total // length if length else 0
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(found)[:top], 1):
            out[(item, rank, doc, -score)] += 1
    return out


def ranked(spark, items, docs, **options) -> Counter:
    rows = search.rank_documents(
        spark.createDataFrame(items, "item_id long, text string, terms string, score string")
        if items and len(items[0]) == 4 else spark.createDataFrame(items, "item_id long, text string"), docs, **options)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    return Counter(tuple(r) for r in rows.collect())


def test_edge_table_matches_brute_force(spark):
    docs = edge.documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(k, t[:400] if t else t) for k, (_, t) in enumerate(edge.texts())]
    items += [(0, "w1 w2 w3"), (0, "w1 w2 w3"), (None, "SPAM spam w7"), (900, None), (901, " .-! "), (902, "unseen")]
    assert ranked(spark, [(*i, None, None) for i in items], docs) == expected(items, rows)
    assert ranked(spark, items, edge.documents(spark, [])) == Counter()
    assert ranked(spark, [], docs) == Counter()


@pytest.mark.parametrize("seed", [1, 2])
def test_small_blocks_and_trees_give_the_same_ranking(spark, monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(search, "BLOCK_TERMS", 60)  # many blocks
    monkeypatch.setattr(search, "CHUNK_DOCS", 40)
    monkeypatch.setattr(search, "SAMPLE_DOCS", 15)

    def text(n):
        return " ".join(f"t{min(int(rng.paretovariate(0.6)), 300)}" for _ in range(n))

    rows = [(i, text(rng.randint(0, 30))) for i in range(400)] + [(7, "t1 t2")] * 30 + [(None, "t1 t2 t3")] * 3
    items = [(i, text(12)) for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert ranked(spark, items, docs) == expected(items, rows)


def test_bounds_prune_pairs_of_nodes():
    rng = np.random.default_rng(5)
    weights = rng.integers(1, 9_000, 500).astype(float)
    items = [np.sort(rng.choice(np.arange(50 * (k % 10), 50 * (k % 10) + 50), 12, replace=False)) for k in range(64)]
    root = search.item_tree(items, weights, np.arange(500))
    impacts = np.zeros((1024, 500), np.float32)
    for d in range(1024):
        at = 50 * (d // 103) + rng.choice(50, 8, replace=False)
        impacts[d, at[at < 500]] = rng.integers(1, 900_000, (at < 500).sum())
    best = search.Best(64, 10, np.zeros(64, np.int64))
    visits = search.walk(root, search.DocTree(impacts), best, np.zeros(1024, bool), np.arange(1024))
    for k, terms_of in enumerate(items):
        scores = (impacts[:, terms_of].astype(float) @ weights[terms_of]).astype(np.int64)
        order = np.lexsort((np.arange(1024), -scores))[:10]
        order = order[scores[order] > 0]
        assert best.found[k][2].tolist() == order.tolist() and best.found[k][0].tolist() == scores[order].tolist()
    assert visits < 64 * 1024 / 4


def test_query_matches_its_sql(spark):
    ok, message = compare(search.op12_search(spark, SF_SMALL), duck(SF_SMALL), search.ORACLE)
    assert ok, message
