from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import edge
import numpy as np
import pyarrow as pa
import pytest
from edge import SF_CHECK
from pyspark.sql import functions as F

from vigil.llm import lm
from vigil.llm.common import read_table


def tokens(text):
    return [*edge.words(edge.lower(text or "")), None]


def base(rows, learnt):
    """(id, n_tokens, n_known, train_tokens, base_score) of every row."""
    counts = Counter(t for (_, text), learn in zip(rows, learnt, strict=True) if learn for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    return [(i, len(w := tokens(text)), sum(counts[t] > 0 for t in w), n,
             round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in w), 6)) for i, text in rows]


def taught(i):
    return i is None or zlib.crc32(str(i).encode()) % lm.HELD_OUT != lm.REMAINDER


@pytest.mark.parametrize("frequent", [1 << 19, 5])
def test_base_scores_match_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    monkeypatch.setattr(lm, "SHORT_LIST", min(64, frequent))
    rows = edge.texts()
    got = lm.score_texts(edge.documents(spark), ~lm.held_out(F.col("doc_id"))).collect()
    want = base(rows, [taught(i) for i, _ in rows])
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == Counter(want)
    assert all(r.held_out == (not taught(r.doc_id)) for r in got)
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_nothing_to_learn_from_and_empty_table(spark):
    got = lm.score_texts(edge.documents(spark), F.lit(False)).collect()
    assert len(got) == len(edge.texts())
    assert {(r.n_known, r.train_tokens, r.base_score) for r in got} == {(0, 0, 0.0)}
    assert all(abs(r.score) < 1e-9 for r in got)
    assert lm.score_texts(edge.documents(spark, []), F.lit(True)).count() == 0


def test_words_with_equal_counts_are_listed_up_to_the_bound(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 40)
    monkeypatch.setattr(lm, "SHORT_LIST", 25)
    end = int(lm.END.astype(np.int64))
    equal = spark.createDataFrame([(end, 7), *[(i, 3) for i in range(1, 401)]], "h long, c long")
    listed = {r.h for r in lm.frequent_words(equal).collect()}
    assert end in listed and 15 <= len(listed) <= 60
    some = spark.createDataFrame([(end, 7), *[(i, 3) for i in range(1, 401)], *[(1000 + i, 50) for i in range(30)]], "h long, c long")
    assert {r.h for r in lm.frequent_words(some).collect()} == {end, *range(1000, 1030)}


def test_one_training_step_matches_the_written_out_objective(monkeypatch):
    """Each example: its word against the batch's noise words, by logistic loss; then one Adagrad step."""
    rng = np.random.default_rng(3)
    n, width, noise_words = 6, 4, 5
    monkeypatch.setattr(lm, "NOISE", noise_words)
    p = rng.dirichlet(np.ones(n))
    model = lm.Bilinear(np.log(p), width)
    model.table += rng.normal(0, 0.2, model.table.shape).astype(np.float32)
    before = model.table.astype(float).copy()
    w, one, two = rng.integers(0, n, 8), rng.integers(0, n + 1, 8), rng.integers(0, n + 1, 8)
    squares = np.full(model.table.shape, 0.01, np.float32)
    touched = np.zeros(len(model.table))
    model.train(w, one, two, 0.1, np.random.default_rng(9), squares, touched)
    draws = np.random.default_rng(9).random(noise_words)
    sums = np.cumsum(np.exp(np.log(p).astype(np.float32).astype(float)))
    noise = [min(int(np.searchsorted(sums, d * sums[-1])), n - 1) for d in draws]

    def loss(table):
        left, mix, right = table[:n + 1], table[n + 1:n + 3], table[n + 3:]
        total = 0.0
        for y, a, b in zip(w, one, two, strict=True):
            for k, (word, real) in enumerate([(y, True), *[(x, False) for x in noise]]):
                s = sum((left[a][i] * mix[0][i] + left[b][i] * mix[1][i]) * right[word][i] for i in range(width))
                s += right[word][width] - math.log(noise_words) - math.log(p[word])
                total += math.log1p(math.exp(-s)) if real else math.log1p(math.exp(s))
        return total / len(w)

    gradient = np.zeros_like(before)
    for at in np.ndindex(before.shape):
        up, down = before.copy(), before.copy()
        up[at] += 1e-5
        down[at] -= 1e-5
        gradient[at] = (loss(up) - loss(down)) / 2e-5
    want = before - 0.1 * gradient / np.sqrt(0.01 + gradient ** 2)
    assert np.allclose(model.table, want, atol=2e-4)


def test_class_probabilities_add_up_to_one():
    model = lm.Bilinear(np.log(np.random.default_rng(1).dirichlet(np.ones(20))))
    near, far, total = model.scores()
    p = np.exp(near[:, None] + far[None] - total[:, :, None])
    assert p.shape == (21, 21, 20) and np.allclose(p.sum(axis=2), 1, atol=1e-5)


def test_contexts_stay_inside_their_text():
    h, first = lm.tokens_of(pa.array(["a B", None, "c", "A b a"]))
    one, two = lm.contexts(np.arange(len(h)), first, 99)
    assert one.tolist() == [99, 0, 1, 99, 99, 4, 99, 6, 7, 8]
    assert two.tolist() == [99, 99, 0, 99, 99, 99, 99, 99, 6, 7]
    assert h[0] == h[6] == h[8] and h[1] == h[7] and h[2] == h[3] == h[5] == h[9] == lm.END


def test_training_learns_what_follows_what():
    rng = np.random.default_rng(0)
    follow = rng.permutation(30)
    w = [0, 1]
    for _ in range(60_000):
        w.append(int(follow[w[-2]]) if rng.random() < 0.8 else int(rng.integers(30)))
    w = np.array(w)
    model = lm.Bilinear(np.log(np.bincount(w, minlength=30) / len(w)))
    squares, touched = np.full_like(model.table, 1e-6), np.zeros(len(model.table))
    for _ in range(3):
        model.train(w[2:], w[1:-1], w[:-2], 0.1, rng, squares, touched)
    near, far, total = model.scores()
    got = (near[w[1:-1], w[2:]] + far[w[:-2], w[2:]] - total[w[1:-1], w[:-2]]).mean()
    assert got > np.log(1 / 30) + 1.0


def test_the_rounds_together_train_on_every_position(spark):
    """A word's context row moves only if the word after it is an example."""
    texts = [" ".join(f"w{k}x{i}" for i in range(n)) for k, n in enumerate((40, 1, 2, 3, 5))]
    h, _ = lm.tokens_of(pa.array(texts))
    short = np.unique(h)
    model = lm.Bilinear(np.full(len(short) + 1, -np.log(len(short) + 1)))
    start = model.table.copy()
    for turn in range(len(lm.RATES)):
        model.table = lm.train_round(spark.createDataFrame([(t,) for t in texts], "text string"), short, model, turn)
    moved = (model.table != start).any(axis=1)
    before_another = [*lm.class_lookup(short, h[h != lm.END]), len(short) + 1]  # each word, and a text's beginning
    assert moved[before_another].all()


def test_each_position_is_trained_on_once():
    h, first = lm.tokens_of(pa.array(["a b c d e f g h i", None, "a", "b a", "c b a", ""]))
    places = np.concatenate([lm.round_places(h, first, turn) for turn in range(len(lm.RATES))])
    assert sorted(places.tolist()) == list(range(len(h)))


def test_model_beats_the_frequencies_on_held_out_documents(spark):
    rows = lm.op9_lm(spark, SF_CHECK).collect()
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF_CHECK, "documents").collect()]
    want = Counter(base(docs, [taught(i) for i, _ in docs]))
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want
    fresh = [r for r in rows if r.held_out]
    assert sum(r.score for r in fresh) > sum(r.base_score for r in fresh) * 0.995


def test_score_is_a_probability_of_the_text(spark):
    """Over all one-word texts of a closed vocabulary and the unseen ones, the probabilities add up to at most one."""
    rng = random.Random(1)
    names = [f"w{i}" for i in range(40)]
    taught_rows = [(i, " ".join(rng.choices(names, k=20))) for i in range(50)]
    asked = [(1000 + k, w) for k, w in enumerate(names)] + [(2000, "")]
    docs = edge.documents(spark, taught_rows + asked)
    got = {r.doc_id: r.score for r in lm.score_texts(docs, F.col("doc_id") < 1000).collect()}
    assert sum(10 ** got[i] for i, _ in asked) <= 1 + 1e-6
