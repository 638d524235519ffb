from __future__ import annotations

import random

import edge
import numpy as np
import pyarrow as pa
from edge import SF_CHECK

from vigil.llm import toxicity
from vigil.llm.common import read_table

NASTY = ["idiot", "scum", "moron"]


def corpus(n: int = 240, seed: int = 5):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = edge.prose(rng, 150, 2000).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                w[rng.randrange(len(w))] = rng.choice(NASTY)
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


def fit(spark, rows, labels):
    docs = edge.documents(spark, rows)
    return docs, toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_catches_toxic_documents_and_leaves_clean_ones(spark):
    rows, labels = corpus()
    docs, model = fit(spark, rows[:160], labels[:160])
    fresh = edge.documents(spark, rows[160:])
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(fresh, model).collect()}
    assert got == dict(labels[160:])
    kept = toxicity.drop_toxic(fresh, model)
    assert kept.schema == fresh.schema
    assert {r.doc_id for r in kept.collect()} == {i for i, y in labels[160:] if not y}


def test_copies_of_one_toxic_document_teach_nothing_about_its_words(spark):
    rows, labels = corpus()
    odd = edge.prose(random.Random(9), 150, 10 ** 6)
    rows += [(1000 + i, odd + f" end{i}") for i in range(60)]
    labels += [(1000 + i, 1) for i in range(60)]
    _, model = fit(spark, rows, labels)
    shuffled = " ".join(random.Random(1).sample(odd.split(), 150))
    odd_ratio, unknown_ratio = model.ratios(pa.array([shuffled, "nobody knows these"]))
    assert abs(odd_ratio - unknown_ratio) < 0.002


def test_best_cut():
    x = np.array([0.1, 0.1 + 1e-12, 0.1 - 1e-12, 0.2, 0.5, 0.6])
    assert np.isclose(toxicity.best_cut(x, np.array([0, 1, 0, 0, 1, 1])), 0.35)
    assert np.isclose(toxicity.best_cut(x, np.array([0, 0, 0, 0, 0, 1])), 0.55)


def test_edge_rows_have_scores(spark):
    rows, labels = corpus(80)
    _, model = fit(spark, rows, labels)
    got = toxicity.score_toxicity(edge.documents(spark), model).collect()
    assert len(got) == len(edge.texts())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    blank = {r.score for r in got if r.doc_id in (4, 5, 6)}
    assert len(blank) == 1 and blank.pop() < 0.5
    model.bias = 50.0  # even where a ratio of 0 lies beyond the cut
    model.blank = -100.0 / model.slope
    kept = toxicity.drop_toxic(edge.documents(spark), model).collect()
    assert {4, 5, 6} <= {r.doc_id for r in kept} and None in {r.doc_id for r in kept if r.text is None}
    assert toxicity.score_toxicity(edge.documents(spark, []), model).count() == 0


def test_one_class_or_no_labels(spark):
    rows, labels = corpus(20)
    docs, none = fit(spark, rows, [])
    assert {r.predicted for r in toxicity.score_toxicity(docs, none).collect()} == {0}
    _, only = fit(spark, rows, [(i, 1) for i, _ in labels])
    assert {r.predicted for r in toxicity.score_toxicity(docs, only).collect()} == {1}


def test_model_matches_counts_and_probabilities_by_hand(spark):
    """Continuation counts, discounts and interpolated probabilities from dictionaries of words."""
    rows, labels = corpus(160)
    rng = random.Random(2)
    for k, (i, text) in enumerate(rows):
        w = text.split()
        for _ in range(6 if labels[k][1] else 0):
            w[rng.randrange(len(w))] = "utter fool"
        rows[k] = (i, " ".join(w))
    _, model = fit(spark, rows, labels)
    seen = {}  # (class, v, w) -> words before v; a word before the first is ^
    for (_, text), (_, toxic) in zip(rows, labels, strict=True):
        held = ["^", "^", *edge.words(edge.lower(text))]
        for u, v, w in zip(held, held[1:], held[2:], strict=False):
            seen.setdefault((v, w), {}).setdefault(u, set()).add(toxic)
    pairs = {k: [sum(c in t for t in us.values()) for c in (0, 1)] for k, us in seen.items()}
    words, begun = {}, {}
    for (v, w), n in pairs.items():
        for c in (0, 1):
            words.setdefault(w, [0, 0, 0])[c] += n[c] > 0
            begun.setdefault(v, [0, 0])[c] += n[c]
        words[w][2] += 1
    totals = [sum(n[c] for n in words.values()) for c in (0, 1)]
    places, types = sum(n[2] for n in words.values()), len(words)
    pair_totals = [sum(n[c] for n in pairs.values()) for c in (0, 1)]

    def own(n, c, totals):
        ratio = totals[c] / totals[1 - c]
        expected = (n[0] + n[1]) * totals[c] / sum(totals)
        return max(n[c] - toxicity.FACTOR * ratio * n[1 - c]
                   - toxicity.DEVIATIONS * (max(expected, 1) * (1 + ratio)) ** 0.5, 0)

    rests = [1 - sum(own(n, c, totals) / totals[c] for n in words.values()) for c in (0, 1)]

    def word_p(w, c):
        return own(words[w], c, totals) / totals[c] + rests[c] * (words[w][2] + 1) / (places + types + 1)

    def share(v, w, c):
        return own(pairs[v, w], c, pair_totals) / max(begun[v][c], 1)

    def p(v, w, c):
        left = 1.0
        if v in words:
            left = max(1 - sum(share(a, b, c) for a, b in pairs if a == v), 1e-6)
        return (share(v, w, c) if v in words else 0.0) + left * word_p(w, c)

    assert len(model.pairs) and own(words["utter"], 1, totals) > 0
    assert words["fool"][1] == 1 and own(words["fool"], 1, totals) == 0  # a continuation count: it follows one word
    assert all(own(n, c, totals) == 0 for n in words.values() for c in (0, 1) if n[c] < toxicity.DEVIATIONS)
    for _, text in rows[:9]:
        held = ["^", *edge.words(edge.lower(text))][:40]
        want = np.mean([np.log(p(v, w, 1) / p(v, w, 0)) for v, w in zip(held, held[1:], strict=False)])
        assert np.isclose(model.ratios(pa.array([" ".join(held[1:])]))[0], want, atol=1e-9)


def test_ratio_is_that_of_the_probabilities(spark):
    rows, labels = corpus()
    _, model = fit(spark, rows, labels)
    h, before, _ = toxicity.words_and_contexts(pa.array(["Idiot w5 zzz scum"]))
    total = 0.0
    for w, v in zip(h, before, strict=True):
        place = {int(x): i for i, x in enumerate(model.words)}
        p = model.word_p[place.get(int(w), -1)] * model.left[place.get(int(v), -1)]
        key = toxicity.pair_key(np.array([v]), np.array([w]))[0]
        if key in model.pairs:
            p = p + model.pair_p[list(model.pairs).index(key)]
        total += np.log(p[1] / p[0])
    assert np.isclose(model.ratios(pa.array(["Idiot w5 zzz scum"]))[0], total / 4)


def test_query_on_held_out_documents(spark):
    got = toxicity.op2_toxicity(spark, SF_CHECK)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = read_table(spark, SF_CHECK, "labels").withColumnRenamed("doc_id", "id")
    rows = got.join(labels, got.doc_id == labels.id).collect()
    clean = [r.predicted for r in rows if not r.toxic]
    toxic = [r.predicted for r in rows if r.toxic]
    assert sum(clean) <= 0.02 * len(clean)
    assert sum(toxic) >= 0.5 * len(toxic)
