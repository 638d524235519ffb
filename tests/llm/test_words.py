from __future__ import annotations

import random

import edge
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from vigil.llm import words
from vigil.llm.common import ascii_lower, word_count, words_of

ALPHABET = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "a", "B", "é", "漢", "\x85", " ", " ", "\x1c", "\x00", "ab"]


def samples(n=300):
    rng = random.Random(2)
    return [None, "", *["".join(rng.choices(ALPHABET, k=rng.randrange(30))) for _ in range(n)]]


def test_spans_are_the_words_of_each_text():
    texts = samples()
    w = words.split_words(pa.array(texts))
    got = [[bytes(w.data[w.starts[i]:w.ends[i]]).decode() for i in range(w.first[d], w.first[d + 1])]
           for d in range(len(texts))]
    assert got == [edge.words(t) for t in texts]
    lower = words.split_words(pa.array(texts), lower=True)
    assert bytes(lower.data).decode() == edge.lower("".join(t or "" for t in texts))


def test_equal_words_have_equal_hashes_in_any_batch(monkeypatch):
    texts = samples()
    whole = words.split_words(pa.array(texts))
    at_once = words.hash_words(whole)
    monkeypatch.setattr(words, "CHUNK", 7)
    assert (words.hash_words(whole) == at_once).all()
    known = {}
    for h, a, b in zip(at_once, whole.starts, whole.ends, strict=True):
        assert known.setdefault(bytes(whole.data[a:b]), h) == h
    assert len(set(known.values())) == len(known)
    cut = words.split_words(pa.array(texts).slice(50, 100))
    assert (words.hash_words(cut) == at_once[whole.first[50]:whole.first[150]]).all()


def test_slices_keep_every_row_in_order():
    batch = pa.RecordBatch.from_arrays([pa.array(samples())], names=["text"])
    for limit in (1, 50, 10 ** 9):
        parts = list(words.slices(batch, "text", limit))
        assert sum((p.column(0).to_pylist() for p in parts), []) == batch.column(0).to_pylist()


def test_grams_tell_runs_apart():
    h = np.arange(1, 50, dtype=np.uint64)
    assert len(set(words.hash_grams(h, 3).tolist())) == 47 and len(words.hash_grams(h[:2], 3)) == 0


def test_sql_words_are_the_same(spark):
    texts = [t for t in samples() if t is None or "\x00" not in t]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", words_of(F.col("t")).alias("w"), word_count(F.col("t")).alias("n"),
                     ascii_lower(F.col("t")).alias("low")).collect()
    assert [(r.w, r.n) for r in rows] == [(edge.words(t), len(edge.words(t))) for t in texts]
    assert [r.low for r in rows] == [None if t is None else edge.lower(t) for t in texts]
