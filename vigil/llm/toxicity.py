"""Toxicity: class-conditional Kneser-Ney word-pair models, compared by length-normalised likelihood.

Each class has a pair model that backs off to the class's word model, which
backs off to one word model shared by both classes. All counts are
Kneser-Ney continuation counts: after how many different words an expression
was seen, so copies of a passage count once. Every expression's count in a
class is discounted and the discounts go to the shared backoff. The discount
is what the shared counts explain (``discounted``), not one constant: with a
constant one, every pair seen once in a class speaks for it, and those pairs
drown the others. So rare expressions are smoothed by the shared counts, and
no bar selects expressions. A document's mean log-likelihood ratio over its
words is turned into a probability by a logistic curve fitted on the training
documents, with its middle at the cut that errs least there.

The classifier is fitted on a bounded sample of the labelled rows
(``SAMPLE_DOCS`` a class, those of the smallest hash), so its size is
bounded; every whole document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, stored
from .words import BASE, hash_words, mix, slices, split_words

SAMPLE_DOCS = 5_000  # training documents of each class, at most
FACTOR = 2.0  # a class count's discount: so many times what the other class lets expect ...
DEVIATIONS = 4.0  # ... and so many standard deviations of the difference
START = np.uint64(0x5851F42D4C957F2D)  # stands before a text's first word
HELD_OUT = 5  # documents whose crc32 modulo this is 0 are never learnt from


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(BASE) + second)


def words_and_contexts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, of the word before each, and the text each is in."""
    words = split_words(texts, lower=True)
    h = hash_words(words)
    before = np.concatenate([[START], h[:-1]]) if len(h) else h
    before[words.first[:-1][words.counts() > 0]] = START
    return h, before, words.doc_of()


def pair_counts(docs: DataFrame) -> DataFrame:
    """(text, toxic) -> (v, w, toxic, other): after how many different words the pair was seen, in either class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w, v, doc = words_and_contexts(part.column(0))
                u = np.concatenate([[START], v[:-1]]) if len(v) else v
                u[v == START] = START
                toxic = np.asarray(part.column(1).to_numpy(zero_copy_only=False), bool)[doc]
                key = mix(pair_key(pair_key(u, v), w) + toxic)
                _, once = np.unique(key, return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(x[once].view(np.int64)) for x in (u, v, w)], pa.array(toxic[once])],
                    names=["u", "v", "w", "toxic"])

    places = docs.select("text", "toxic").mapInArrow(run, "u long, v long, w long, toxic boolean").groupBy(
        "v", "w", "u").agg(F.max("toxic").alias("toxic"), F.min("toxic").alias("only"))
    return places.groupBy("v", "w").agg(F.count_if(F.col("toxic")).alias("toxic"), F.count_if(~F.col("only")).alias("other"))


@dataclass
class Model:
    """Tables sorted by key; column 0 is the ordinary class, column 1 the toxic one."""

    words: np.ndarray  # hashes of the known words
    word_p: np.ndarray  # their probability in each class
    left: np.ndarray  # what is left for the backoff after each of them
    pairs: np.ndarray  # keys of the known pairs
    pair_p: np.ndarray  # their discounted share
    slope: float = 1.0
    bias: float = 0.0
    blank: float = 0.0  # ratio of a text without words

    def ratios(self, texts: pa.Array) -> np.ndarray:
        """Mean log-likelihood ratio of each text (``blank`` without words)."""
        w, v, doc = words_and_contexts(texts)
        if not len(w):
            return np.full(len(texts), self.blank)
        place = np.searchsorted(self.words, w)
        place[place == len(self.words)] = 0
        known = self.words[place] == w if len(self.words) else np.zeros(len(w), bool)
        place[~known] = len(self.words)  # the row of unknown words
        before = np.concatenate([[len(self.words)], place[:-1]])
        before[v == START] = len(self.words)
        p = self.left[before] * self.word_p[place]
        both = np.flatnonzero(known & (before < len(self.words)))
        if len(self.pairs) and len(both):
            key = pair_key(v[both], w[both])
            at = np.searchsorted(self.pairs, key)
            at[at == len(self.pairs)] = 0
            hit = self.pairs[at] == key
            p[both[hit]] += self.pair_p[at[hit]]
        n = np.bincount(doc, minlength=len(texts))
        mean = np.bincount(doc, np.log(p[:, 1] / p[:, 0]), len(texts)) / np.maximum(n, 1)
        return np.where(n > 0, mean, self.blank)

    def score(self, ratios: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * ratios + self.bias, -500, 500)))


def discounted(total_other: int, total_toxic: int) -> list[Column]:
    """Columns (own_other, own_toxic): the counts ``other`` and ``toxic`` of an expression less their discounts.

    A discount is ``FACTOR`` times what the other class's count lets expect, at the classes' totals, and
    ``DEVIATIONS`` standard deviations of the difference between the two, were the classes alike. Without counts of
    the other class nothing can be told apart, so nothing is kept.
    """
    total = max(total_other + total_toxic, 1)
    both = F.col("other") + F.col("toxic")
    out = []
    for name, own, rival, rivals in (("other", total_other, "toxic", total_toxic),
                                     ("toxic", total_toxic, "other", total_other)):
        ratio = own / max(rivals, 1)
        spread = F.sqrt(F.greatest(both * F.lit(own / total), F.lit(1.0)) * F.lit(1 + ratio))
        kept = F.col(name) - F.col(rival) * F.lit(FACTOR * ratio) - spread * F.lit(DEVIATIONS)
        out.append((F.greatest(kept, F.lit(0.0)) if own and rivals else F.lit(0.0)).alias(f"own_{name}"))
    return out


def build(words: pd.DataFrame, pairs: pd.DataFrame, word_totals: np.ndarray, types: int, distinct: int) -> Model:
    """Model from the expressions that keep a count of their own; all others are their shared backoff as a whole.

    words (w, own_other, own_toxic, places, and the counts of the pairs they begin: other_in, toxic_in) hold the words
    of the pairs (v, w, own_other, own_toxic) too; the totals are over all words.
    """
    words = words.iloc[np.argsort(words["w"].to_numpy(np.int64).view(np.uint64))]
    h = words["w"].to_numpy(np.int64).view(np.uint64)
    own = words[["own_other", "own_toxic"]].to_numpy(float) / np.maximum(word_totals, 1)
    rest = 1 - own.sum(axis=0)
    shared = (words["places"].to_numpy(float) + 1) / (types + distinct + 1)
    word_p = np.vstack([own + rest * shared[:, None], rest])  # last: a word of neither, whose shared part cancels
    pv, pw = (pairs[c].to_numpy(np.int64).view(np.uint64) for c in ("v", "w"))
    at = np.searchsorted(h, pv)
    at[at == len(h)] = 0
    real = h[at] == pv if len(h) else np.zeros(len(pv), bool)  # the start of a text is no word
    pv, pw, at = pv[real], pw[real], at[real]
    begun = words[["other_in", "toxic_in"]].to_numpy(float)
    share = pairs[["own_other", "own_toxic"]].to_numpy(float)[real] / np.maximum(begun[at], 1)
    left = np.ones((len(h) + 1, 2))
    np.subtract.at(left, at, share)
    key = pair_key(pv, pw)
    by_key = np.argsort(key)
    return Model(h, word_p, np.maximum(left, 1e-6), key[by_key], share[by_key])


def logistic_fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope of a logistic curve by Newton's method on the standardised values, and the bias that puts its middle
    where the fewest values are on the wrong side."""
    if not len(x) or y.min() == y.max():
        return 0.0, (4.0 if len(y) and y.min() == 1 else -4.0)
    mean, scale = x.mean(), x.std() or 1.0
    a = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    weight = np.full(len(y), 1 / len(y))
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        gradient = a.T @ ((p - y) * weight) + 1e-5 * beta
        curve = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-5 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    slope = max(float(beta[0] / scale), 1e-6)
    return slope, -slope * best_cut(x, y)


def best_cut(x: np.ndarray, y: np.ndarray) -> float:
    """The cut with the fewest errors (1 below, 0 above it); of several the middle of the widest gap.

    Values that differ by rounding only are never cut apart.
    """
    order = np.argsort(x)
    x, y = x[order], y[order]
    wrong = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
    low, high = np.concatenate([[x[0] - 1], x]), np.concatenate([x, [x[-1] + 1]])
    apart_here = high - low > 1e-6
    gap = np.where(apart_here & (wrong == wrong[apart_here].min()), high - low, -1)
    k = int(gap.argmax())
    return float((low[k] + high[k]) / 2)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fits the model on ``sample_docs`` labelled documents of each class at most.

    ``labels`` holds (doc_id, toxic); rows with a null in either are ignored,
    and of a document with both labels the toxic one counts.
    """
    marks = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("boolean").alias("toxic")).dropna()
    marks = marks.groupBy("id").agg(F.max("toxic").alias("toxic"))
    known = stored(marks.join(docs.select(F.col(id_col).alias("_id")).distinct(), F.col("id") == F.col("_id"))
                   .select("id", "toxic"), "toxicity-known")
    picked = None
    for kind in (False, True):
        part = known.filter(F.col("toxic") == kind).orderBy(F.xxhash64("id"), "id").limit(sample_docs)
        picked = part if picked is None else picked.union(part)
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(picked), F.col("_id") == F.col("id")).select("text", "toxic").dropDuplicates(["text"])
    sample = stored(sample, "toxicity-sample")
    pairs = stored(pair_counts(sample), "toxicity-pairs")
    words = pairs.groupBy("w").agg(
        F.count_if(F.col("other") > 0).alias("other"), F.count_if(F.col("toxic") > 0).alias("toxic"),
        F.count(F.lit(1)).alias("places"))
    begun = pairs.groupBy(F.col("v").alias("_v")).agg(
        F.sum("other").alias("other_in"), F.sum("toxic").alias("toxic_in"))
    words = stored(words.join(begun, F.col("w") == F.col("_v"), "left").drop("_v").fillna(0), "toxicity-words")
    word_sums = words.agg(F.sum("other"), F.sum("toxic"), F.sum("places"), F.count(F.lit(1))).first()
    pair_sums = pairs.agg(F.sum("other"), F.sum("toxic")).first()
    other, toxic, places, distinct, other_pairs, toxic_pairs = (x or 0 for x in (*word_sums, *pair_sums))
    own = "own_other > 0 OR own_toxic > 0"
    own_pairs = pairs.select("v", "w", *discounted(other_pairs, toxic_pairs)).filter(own)
    ends = own_pairs.select(F.explode(F.array("v", "w")).alias("_end")).distinct()
    own_words = words.select("*", *discounted(other, toxic)).join(ends, F.col("w") == F.col("_end"), "left").filter(
        f"{own} OR _end IS NOT NULL")
    model = build(own_words.toPandas(), own_pairs.toPandas(), np.array([other, toxic], float), places, distinct)
    fitted = _ratios(sample.select("toxic", "text"), model, "toxic boolean").toPandas()
    model.slope, model.bias = logistic_fit(fitted["ratio"].to_numpy(float), fitted["toxic"].to_numpy(float))
    ordinary = fitted.loc[~fitted["toxic"].astype(bool), "ratio"]
    model.blank = float(ordinary.median()) if len(ordinary) else 0.0
    return model


def _ratios(rows: DataFrame, model: Model, first: str) -> DataFrame:
    """(first column, text) -> (first column, ratio)."""
    sent = rows.sparkSession.sparkContext.broadcast(model.__dict__)
    name = first.split()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(**sent.value)
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(own.ratios(part.column(1)))], names=[name, "ratio"])

    return rows.mapInArrow(run, first + ", ratio double")


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted), a row a row.

    Null, empty and blank texts say nothing and are scored as the middle
    ordinary training document is. An empty table gives an empty result;
    other input columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    logit = F.col("ratio") * model.slope + model.bias
    score = 1 / (1 + F.exp(-F.greatest(F.least(logit, F.lit(500.0)), F.lit(-500.0))))
    return _ratios(rows, model, f"doc_id {kind}").select("doc_id", score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(id_column):
    """Whether a document is never learnt from."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def train_on_tables(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of ``documents`` and ``labels``, learnt from the documents that are not held out."""
    return train(docs, labels.filter(~held_out(F.col("doc_id"))))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows that the model rejects (score 0.5 or more); columns and repeated rows stay as they are.

    Null, empty and blank texts are judged as the middle ordinary training document is.
    """
    names = docs.columns
    sent = docs.sparkSession.sparkContext.broadcast(model.__dict__)
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(**sent.value)
        for batch in batches:
            for part in slices(batch, "text"):
                yield part.filter(pa.array(own.score(own.ratios(part.column(at))) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train_on_tables(docs, read_table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
