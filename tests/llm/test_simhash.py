from __future__ import annotations

import random
from collections import Counter

import edge
import numpy as np
import pytest
import xxhash

from vigil.llm import simhash
from vigil.llm.components import components


def fingerprint(text: str | None) -> int:
    w = edge.words(edge.lower(text or ""))
    shingles = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [fingerprint(t) for _, t in rows]
    root = edge.find_all(len(rows), [(i, j) for i in range(len(rows)) for j in range(i)
                                     if (prints[i] ^ prints[j]).bit_count() <= 3])
    low = {}
    for r, (i, _) in zip(root, rows, strict=True):
        if i is not None:
            low[r] = min(low.get(r, i), i)
    return prints, [low.get(r) for r in root]


def test_edge_table_matches_brute_force(spark):
    rows = edge.texts()
    prints, roots = brute(rows)
    got = simhash.near_duplicates(edge.documents(spark)).collect()
    assert Counter((r.doc_id, r.bits % (1 << 64), r.component_id) for r in got) == Counter(
        zip([i for i, _ in rows], prints, roots, strict=True))


def test_one_row_of_each_group_stays(spark):
    rows = edge.texts()
    _, roots = brute(rows)
    docs = edge.documents(spark)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids.pop(None) == 2  # not judged
    assert ids == Counter({i for (i, _), r in zip(rows, roots, strict=True) if i is not None and i == r})


def test_columns_named_like_those_at_work_come_through(spark):
    names = ("_stay_id", "_own_id", "_own_version", "_stay_version", "row", "bits", "version", "component_id", "a.b")
    rows = [(i, f"some words that repeat {i // 2} and more {i // 2}", *[f"{n}{i}" for n in names]) for i in range(20)]
    rows.append((None, "no id", *names))
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    got = simhash.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert {tuple(r) for r in got.collect()} <= set(rows) and {r[0] for r in got.collect()} >= {None, 0}


def test_empty_table(spark):
    assert simhash.near_duplicates(edge.documents(spark, [])).count() == 0
    assert simhash.drop_near_duplicates(edge.documents(spark, [])).count() == 0


def clustered(seed: int, centers: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    out = []
    for c in rng.integers(0, 1 << 63, centers, dtype=np.uint64):
        for _ in range(int(rng.integers(1, 12))):
            x = int(c)
            for bit in rng.integers(0, 64, int(rng.integers(0, 6))):
                x ^= 1 << int(bit)
            out.append(x)
    return np.unique(np.array(out, np.uint64))


@pytest.mark.parametrize("limit", [40, 500_000])
def test_trie_join_links_all_within_the_budget(spark, limit):
    values = clustered(1, 150)
    prints = spark.createDataFrame([(int(x),) for x in values.view(np.int64)], "bits long")
    at = {int(x): i for i, x in enumerate(values.view(np.int64))}
    links = [(at[r.u], at[r.v]) for r in simhash.fingerprint_links(prints, 3, limit).collect()]
    assert all((int(values[a]) ^ int(values[b])).bit_count() <= 3 for a, b in links)
    every = [(i, i + 1 + int(j)) for i in range(len(values))
             for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= 3)]
    assert edge.find_all(len(values), links) == edge.find_all(len(values), every)


def test_shuffled_and_broadcast_subtree_pairs_give_the_same_links(spark, monkeypatch):
    values = clustered(4, 30).view(np.int64).tolist()
    prints = spark.createDataFrame([(v,) for v in set(values)], "bits long")

    def groups():
        links = simhash.fingerprint_links(prints, 3, 40).collect()
        index = {v: k for k, v in enumerate(sorted(set(values)))}
        return edge.find_all(len(index), [(index[r.u], index[r.v]) for r in links])

    shared = groups()
    monkeypatch.setattr(simhash, "BROADCAST_PAIRS", 0)
    assert groups() == shared


def test_trie_join_of_many_close_fingerprints_is_whole():
    values = np.unique(np.array([(a << 40) | (1 << b) | (1 << c) for a in range(2) for b in range(30)
                                 for c in range(30)], np.uint64))
    found = np.vstack(list(simhash.trie_join(values, values, 0, True, 3)))
    every = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values))
             if (int(values[i]) ^ int(values[j])).bit_count() <= 3}
    assert len(found) == len(every) and set(map(tuple, found.tolist())) == every


def test_components_of_paths_stars_and_cycles(spark):
    rng = random.Random(2)
    names = rng.sample(range(10 ** 6), 400)
    links = [(names[i], names[i + 1]) for i in range(99)]  # a path in random order
    links += [(names[100], names[i]) for i in range(101, 200)] + [(names[i], names[i]) for i in range(200, 210)]
    links += [(names[i], names[i + 1]) for i in range(210, 250)] + [(names[250], names[210])]
    links += [(i, i + 1) for i in range(2 * 10 ** 6, 2 * 10 ** 6 + 60)]  # a path in order
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    nodes = sorted({x for e in links for x in e})
    at = {x: i for i, x in enumerate(nodes)}
    root = edge.find_all(len(nodes), [(at[a], at[b]) for a, b in links])
    assert got == {x: nodes[root[at[x]]] for x in nodes if nodes[root[at[x]]] != x}
