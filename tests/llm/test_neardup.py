from __future__ import annotations

import edge
import numpy as np
import pytest
from edge import SF_SMALL
from oracle import compare, duck

from vigil.llm import neardup


def clustered(seed: int, n: int, dim: int = 16):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        center = rng.normal(size=dim)
        for _ in range(int(rng.integers(1, 8))):
            out.append((center + rng.normal(size=dim) * rng.choice([0.0, 0.03, 0.08])) * rng.uniform(0.1, 10))
    return out


def brute(rows):
    good = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and all(
        x is not None and np.isfinite(x) for x in v) and any(v)]
    links = set()
    for i in good:
        for j in good:
            a, b = rows[i], rows[j]
            if i < j and a[2] == b[2] and len(a[1]) == len(b[1]):
                u, v = np.array(a[1], float), np.array(b[1], float)
                if u @ v / np.sqrt((u @ u) * (v @ v)) >= neardup.COSINE:
                    links.add((i, j))
    root = edge.find_all(len(rows), links)
    low = {}
    for i, r in enumerate(root):
        low[r] = min(low.get(r, rows[i][0]), rows[i][0])
    return sorted((rows[i][0], sum(i in x for x in links), low[root[i]], rows[i][0] == low[root[i]])
                  for i in range(len(rows)))


def run(spark, rows):
    full = [(*r, "x", 1, None) for r in rows]
    df = spark.createDataFrame(full, "vec_id long, embedding array<float>, label int, n string, code int, id long")
    return sorted(tuple(r) for r in neardup.near_duplicate_embeddings(df.repartition(3)).collect())


@pytest.mark.parametrize("block", [4096, 3])
def test_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", block)
    vectors = [np.float32(v).tolist() for v in clustered(1, 60)]
    rows = [(i, v, i % 2) for i, v in enumerate(vectors)]
    rows += [(1000 + i, vectors[0], 0) for i in range(30)]
    nan, inf = float("nan"), float("inf")
    rows += [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [nan] + [1.0] * 15, 0), (2003, [inf] + [1.0] * 15, 0),
             (2004, [None] + [1.0] * 15, 0), (2005, [], 0), (2006, vectors[0], None), (2007, [1.0, 2.0, 3.0], 0),
             (2008, [1.0, 2.0, 3.0], 0), (2009, vectors[1], 7)]
    assert run(spark, rows) == brute(rows)


def test_no_vector_at_all(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, 0), (2, [1.0, 0.0], None)]) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_cells_come_nearest_first_and_all_within_reach():
    rng = np.random.default_rng(0)
    a, b = rng.uniform(size=9), rng.uniform(size=9)
    cells = list(neardup.multi_sequence(a, b, 0.7))
    far = [np.hypot(a[c // 9], b[c % 9]) for c in cells]
    assert far == sorted(far)
    assert set(cells) == {i * 9 + j for i in range(9) for j in range(9) if np.hypot(a[i], b[j]) <= 0.7}


def test_border_distance_is_a_lower_bound():
    points = np.random.default_rng(2).normal(size=(300, 8))
    away = neardup.border_distances(points, neardup.k_means(points, 6))
    apart = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    assert (away[:, away.argmin(axis=1)] <= apart + 1e-9).all()


def test_a_hot_cluster_does_not_hide_the_loose_links_of_small_groups(spark, monkeypatch):
    """The sample holds many pairs of one tight cluster and hardly any of the loose pairs, as on a large table."""
    monkeypatch.setattr(neardup, "SAMPLE_ROWS", 60)
    monkeypatch.setattr(neardup, "ROWS_PER_CELL", 16)
    rng = np.random.default_rng(5)
    hot = rng.normal(size=16)
    vectors = [hot + rng.normal(size=16) * 1e-3 for _ in range(600)]
    for _ in range(150):
        a, away = neardup.unit(rng.normal(size=(2, 16)))
        away = neardup.unit((away - (away @ a) * a)[None])[0]
        turn = np.arccos(rng.uniform(0.981, 0.99))
        vectors += [a, np.cos(turn) * a + np.sin(turn) * away]
    rows = [(i, np.float32(v).tolist(), 0) for i, v in enumerate(vectors)]
    assert run(spark, rows) == brute(rows)


def test_query_matches_its_sql(spark):
    ok, message = compare(neardup.op3_neardup(spark, SF_SMALL), duck(SF_SMALL), neardup.ORACLE)
    assert ok, message
