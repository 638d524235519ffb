"""Language-model scoring with a log-bilinear neural model trained by noise-contrastive estimation.

The model predicts a word's class from the two words before it. The
``SHORT_LIST - 1`` most frequent words (the end of a text is one) are classes
of their own, all others share the last class, inside which they have their
smoothed frequency; so every word, seen or not, has a probability, and the
probabilities of a context add up to one. The score of class ``w`` after
``a, b`` is ``(c1 * r_a + c2 * r_b) . q_w + bias_w``.

Word counts cover all training documents. Training runs in the tasks that
read them, and the tasks' parameters are averaged, once a round. The rounds
take turns at the positions of a document and together visit every one once. Because a context is two classes, the
normaliser of every context is one batched matrix product away, and is
computed once; scoring looks it up.

Counts of the ``FREQUENT`` most frequent words are broadcast; the other words
of a document are joined with the count table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, stored
from .words import hash_words, slices, split_words

SHORT_LIST = 1024  # classes
FREQUENT = 1 << 18  # words whose counts are broadcast, at most
WIDTH = 32
NOISE = 128  # noise words, shared by a batch of examples
BATCH = 2048
RATES = (0.1, 0.05)  # of the rounds
END = np.uint64(0xD6E8FEB86659FD93)  # stands for the end of a text
HELD_OUT, REMAINDER = 7, 2  # documents whose crc32 modulo the first is the second are never learnt from


def held_out(id_column):
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % HELD_OUT == REMAINDER, F.lit(False))


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (the words, then one end, of each text) and where each text's begin."""
    words = split_words(texts, lower=True)
    h = hash_words(words)
    return np.insert(h, words.first[1:], END), words.first + np.arange(len(words.first))


def token_counts(texts: DataFrame) -> DataFrame:
    """(text) -> (h, c): how often each token occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                h, c = np.unique(tokens_of(part.column(0))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], names=["h", "c"])

    return texts.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def frequent_words(vocabulary: DataFrame) -> DataFrame:
    """Of (h, c) the end and the most frequent words: all from a count on that at most ``FREQUENT`` words reach.

    Where these are fewer than the classes, because many words share the
    next count, those of them with the smallest hash are taken too.
    """
    step = F.floor(F.log2(F.col("c").cast("double")) * 16).cast("int")
    bins = sorted((r[0], r[1]) for r in vocabulary.groupBy(step.alias("step")).count().collect())
    room, low = FREQUENT, 1 << 20
    while bins and bins[-1][1] <= room:
        low, size = bins.pop()
        room -= size
    listed = step >= low
    if FREQUENT - room < SHORT_LIST and bins:
        ranked = F.pmod(F.xxhash64("h"), F.lit(1 << 20))  # uniform: the share stays below the room left
        listed = listed | (step == bins[-1][0]) & (ranked < int((1 << 20) * 0.9 * room / bins[-1][1]))
    return vocabulary.filter(listed | (F.col("h") == int(END.astype(np.int64))))


def contexts(classes: np.ndarray, first: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes one and two places before each token; ``start`` before a text's beginning."""
    one = np.concatenate([[start], classes[:-1]])
    two = np.concatenate([[start, start], classes[:-2]])[: len(classes)]
    one[first[:-1]] = start
    two[first[:-1]] = start
    second = first[:-1] + 1
    two[second[second < first[1:]]] = start
    return one, two


class Bilinear:
    """Parameters: ``left`` (a row a context class, the last one the text's beginning), two rows of diagonal weights,
    ``right`` (a row a class; the last column is its bias)."""

    def __init__(self, log_noise: np.ndarray, width: int = WIDTH, seed: int = 1):
        rng = np.random.default_rng(seed)
        n = len(log_noise)
        self.log_noise = log_noise.astype(np.float32)
        left = rng.normal(0, 0.1, (n + 1, width + 1)).astype(np.float32)
        left[:, -1] = 0
        right = rng.normal(0, 0.1, (n, width + 1)).astype(np.float32)
        right[:, -1] = self.log_noise
        self.table = np.vstack([left, np.ones((2, width + 1), np.float32), right])
        self.classes = n

    def views(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = self.classes + 1
        return self.table[:n], self.table[n:n + 2, :-1], self.table[n + 2:]

    def train(self, w: np.ndarray, one: np.ndarray, two: np.ndarray, rate: float, rng: np.random.Generator,
              squares: np.ndarray, touched: np.ndarray) -> None:
        """One pass over the examples: logistic regression of each word against the batch's noise words (Adagrad)."""
        left, mix, right = self.views()
        n = self.classes + 1
        cumulative = np.cumsum(np.exp(self.log_noise.astype(np.float64)))
        for at in range(0, len(w), BATCH):
            y, a, b = w[at:at + BATCH], one[at:at + BATCH], two[at:at + BATCH]
            noise = np.minimum(np.searchsorted(cumulative, rng.random(NOISE) * cumulative[-1]), self.classes - 1)
            shift = np.float32(np.log(NOISE)) + self.log_noise
            ra, rb = left[a, :-1], left[b, :-1]
            context = ra * mix[0] + rb * mix[1]
            qy, qn = right[y], right[noise]
            hit = _sigmoid((context * qy[:, :-1]).sum(axis=1) + qy[:, -1] - shift[y]) - 1
            miss = _sigmoid(context @ qn[:, :-1].T + qn[:, -1] - shift[noise])
            back = hit[:, None] * qy[:, :-1] + miss @ qn[:, :-1]
            slope = np.zeros_like(self.table)
            _add_rows(slope, a, back * mix[0])
            _add_rows(slope, b, back * mix[1])
            slope[n, :-1] = (back * ra).sum(axis=0)
            slope[n + 1, :-1] = (back * rb).sum(axis=0)
            _add_rows(slope, n + 2 + y, np.column_stack([hit[:, None] * context, hit]))
            _add_rows(slope, n + 2 + noise, np.column_stack([miss.T @ context, miss.sum(axis=0)]))
            slope /= len(y)
            squares += slope * slope
            self.table -= rate * slope / np.sqrt(squares)
            touched[:n] += np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
            touched[n + 2:] += np.bincount(y, minlength=self.classes)
            touched[n:n + 2] += len(y)

    def scores(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score of each class after each class one place before (with the bias), two places before, and the
        logarithm of every context's normaliser, by batched matrix products."""
        left, mix, right = (x.astype(np.float32) for x in self.views())
        q = right[:, :-1].T
        near = (left[:, :-1] * mix[0]) @ q + right[:, -1]
        far = (left[:, :-1] * mix[1]) @ q
        total = np.empty((len(near), len(far)), np.float32)
        for i, row in enumerate(near):
            both = far + row
            top = both.max(axis=1)
            total[i] = top + np.log(np.exp(both - top[:, None]).sum(axis=1))
        return near, far, total


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _add_rows(out: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    cuts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    out[ordered[cuts], : values.shape[1]] += np.add.reduceat(values[order], cuts, axis=0)


def class_lookup(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Place of each hash in the sorted ``words``; their number where it isn't among them."""
    if not len(words):
        return np.zeros(len(h), np.int64)
    at = np.searchsorted(words, h)
    at[at == len(words)] = 0
    return np.where(words[at] == h, at, len(words))


def round_places(h: np.ndarray, first: np.ndarray, turn: int) -> np.ndarray:
    """The tokens that a round trains on: every ``len(RATES)``-th of each text, from where its first word says."""
    size = np.diff(first)
    place = np.arange(len(h)) - np.repeat(first[:-1], size)
    start = (h[first[:-1]] % np.uint64(len(RATES))).astype(np.int64)
    return np.flatnonzero((place + np.repeat(start, size)) % len(RATES) == turn)


def train_round(texts: DataFrame, short: np.ndarray, model: Bilinear, turn: int) -> np.ndarray:
    """Trains the model in every task, from the same start, on that task's documents; the weighted mean of the tables."""
    spark = texts.sparkSession
    sent = spark.sparkContext.broadcast((short, model.table, model.log_noise))
    width = model.table.shape[1]
    names = [f"v{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, table, log_noise = sent.value
        own = Bilinear(log_noise, width - 1)
        own.table = table.copy()
        rng = np.random.default_rng(turn)
        squares, touched = np.full_like(table, 1e-6), np.zeros(len(table))
        for batch in batches:
            for part in slices(batch, "text"):
                h, first = tokens_of(part.column(0))
                c = class_lookup(words, h)
                one, two = contexts(c, first, own.classes)
                picked = rng.permutation(round_places(h, first, turn))
                own.train(c[picked], one[picked], two[picked], RATES[turn], rng, squares, touched)
        weight = touched + 1e-3
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(table))), pa.array(weight),
             *[pa.array(own.table[:, i].astype(np.float64) * weight) for i in range(width)]],
            names=["row", "weight", *names])

    kinds = ", ".join(["row long", "weight double", *[f"{n} double" for n in names]])
    sums = texts.select("text").mapInArrow(run, kinds).groupBy("row").agg(
        F.sum("weight").alias("weight"), *[F.sum(n).alias(n) for n in names]).orderBy("row").toPandas()
    if not len(sums):
        return model.table
    return (sums[names].to_numpy() / sums[["weight"]].to_numpy()).astype(np.float32)


def score_texts(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row a row.

    ``learn`` is the condition under which a row is learnt from. Tokens are
    the words in A-Z lower case, then one end; a null text is empty. All
    rows are scored, ``score`` being the model's log10 probability of the
    text and ``base_score`` that of the smoothed word frequencies. With
    nothing to learn from, every token is unknown. Repeated rows are scored
    (and learnt from) one by one. An empty table gives an empty result;
    other input columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.coalesce(learn, F.lit(False)).alias("learn"))
    known = base.filter("learn")
    vocabulary = stored(token_counts(known), "lm-counts")
    n, v = (x or 0 for x in vocabulary.agg(F.sum("c"), F.count(F.lit(1))).first())
    top = frequent_words(vocabulary).toPandas().sort_values(["c", "h"], ascending=[False, True])
    hashes, counts = top["h"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64)
    listed = np.arange(len(hashes)) < SHORT_LIST - 1
    listed &= hashes != END
    if n:
        listed[hashes == END] = True  # the end is a class however rare
    order = np.argsort(hashes[listed])
    short, short_counts = hashes[listed][order], counts[listed][order]
    rest_n, rest_v = n - int(short_counts.sum()), v - len(short)
    model = Bilinear(np.log((np.append(short_counts, rest_n) + 1) / (n + len(short) + 1)))
    for turn in range(len(RATES) if n else 0):
        model.table = train_round(known, short, model, turn)
    by_hash = np.argsort(hashes)
    sent = spark.sparkContext.broadcast((short, hashes[by_hash], counts[by_hash], *model.scores()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        listed_words, words, times, near, far, total = sent.value
        logs, rare_class = np.append(np.log10(times + 1.0), 0.0), len(listed_words)
        class_of = np.append(class_lookup(listed_words, words), rare_class)
        row = TaskContext.get().partitionId() << 40
        names = ["row", "doc_id", "n_tokens", "n_known", "n_rest", "logs", "rest_logs", "model", "h", "n"]
        for batch in batches:
            for part in slices(batch, "text"):
                h, first = tokens_of(part.column(1))
                at = class_lookup(words, h)
                c = class_of[at]
                one, two = contexts(c, first, rare_class + 1)
                log_p = (near[one, c] + far[two, c] - total[one, two]).astype(np.float64) / np.log(10)
                cut, size = first[:-1], np.diff(first)
                found = at < len(words)
                rest = c == rare_class
                sums = [np.add.reduceat(x, cut) for x in (
                    found.astype(np.int64), rest.astype(np.int64), logs[at], logs[at] * rest, log_p)]
                rows = row + np.arange(len(size))
                row += len(size)
                m = len(size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), part.column(0), pa.array(size), *[pa.array(s) for s in sums],
                     pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())], names=names)
                far_words, owner = h[~found], np.repeat(rows, size)[~found]
                order = np.lexsort((far_words, owner))
                far_words, owner = far_words[order], owner[order]
                new = np.ones(len(far_words), bool)
                new[1:] = (far_words[1:] != far_words[:-1]) | (owner[1:] != owner[:-1])
                begin = np.flatnonzero(new)
                m = len(begin)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner[begin]), pa.nulls(m, part.column(0).type), *[pa.nulls(m, pa.int64())] * 3,
                     *[pa.nulls(m, pa.float64())] * 3, pa.array(far_words[begin].view(np.int64)),
                     pa.array(np.diff(np.append(begin, len(far_words))))], names=names)

    seen = stored(base.select("doc_id", "text").mapInArrow(
        run, f"row long, doc_id {kind}, n_tokens long, n_known long, n_rest long, logs double, rest_logs double, "
             "model double, h long, n long"), "lm-seen")
    rare = seen.filter("h IS NOT NULL").select("row", "h", "n").join(
        vocabulary.withColumnRenamed("h", "_h"), F.col("h") == F.col("_h")).groupBy(F.col("row").alias("_row")).agg(
        F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("more_logs"))
    whole = seen.filter("h IS NULL").join(rare, F.col("row") == F.col("_row"), "left").fillna(
        0, ["more_known", "more_logs"])
    more = F.col("more_logs")
    return whole.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.col("more_known")).alias("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        (F.col("model") + F.col("rest_logs") + more - F.col("n_rest") * float(np.log10(rest_n + rest_v + 1)))
        .alias("score"))


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score_texts(docs, ~held_out(F.col("doc_id")))
