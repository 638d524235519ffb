"""Quality rules: base checks, and a hashed n-gram log-likelihood ratio with a fixed threshold.

Words and word pairs are hashed into ``BUCKETS`` buckets. Two multinomials
over the buckets are counted, one over the trusted documents and one over
the whole corpus, both smoothed with the same share of prior mass. A
document's score is the mean, over its n-grams, of the logarithm of their
ratio; every document at or over ``MIN_SCORE`` is kept, the same way each
time.

Native: DataFrame functions only. The corpus is counted with partial
aggregates; what is sent to the executors is one number a bucket, whatever
the corpus' size. The trusted multinomial is fitted on a bounded sample of
the trusted documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CHARS, SPACE_CLASS, read_table, stored, words_of

BUCKETS = 1 << 18
PRIOR = 3.0  # pseudo-count of a bucket in the trusted multinomial (the corpus one is scaled to it)
MIN_SCORE = -0.2
TRUSTED_DOCS = 50_000  # bound of the sample of trusted documents (the corpus is counted whole)
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"


def base_columns(text: Column) -> dict[str, Column]:
    """Counts of a text that need no words array: ``word_chars``, ``n_symbols``, ``n_dup_lines`` (null: 0)."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda s: F.btrim(s, F.lit(SPACE_CHARS)) != "")
    return {
        "word_chars": F.length(F.regexp_replace(whole, SPACE_CLASS, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(whole, SYMBOLS.replace("[", "[^") + "+", "")).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }


def repeated_words(rows: DataFrame, words: str, out: str, size: int = 3) -> DataFrame:
    """Adds ``out``: words inside windows of ``size`` words that occur twice or more in the array ``words``.

    Windows are compared by a 64-bit hash. Where some are equal, they are
    sorted with their places, and equal neighbours are repeats: ``n log n``
    for a document, however long.
    """
    count = F.greatest(F.size(words) - (size - 1), F.lit(0))
    rows = rows.withColumn("_hashes", F.transform(F.slice(words, 1, count), lambda w, i: F.xxhash64(
        w, *[F.get(F.col(words), i + k) for k in range(1, size)])))
    places = F.sequence(F.lit(0), F.size("_hashes") - 1)
    rows = rows.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
        F.sort_array(F.arrays_zip(F.col("_hashes").alias("h"), places.alias("i")))).otherwise(
        F.array().cast("array<struct<h:bigint,i:int>>")))

    def twin(p: Column, j: Column, step: int) -> Column:
        return F.coalesce(F.get(F.col("_sorted"), j + step)["h"] == p["h"], F.lit(False))

    rows = rows.withColumn("_starts", F.sort_array(F.transform(
        F.filter("_sorted", lambda p, j: twin(p, j, -1) | twin(p, j, 1)), lambda p: p["i"])))
    covered = F.transform("_starts", lambda s, j: F.least(
        F.lit(size), F.coalesce(F.get(F.col("_starts"), j + 1) - s, F.lit(size))))
    return rows.withColumn(out, F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)).drop(
        "_hashes", "_sorted", "_starts")


def _pair_bucket(first: Column, second: Column) -> Column:
    return F.pmod(F.xxhash64(first, second), F.lit(BUCKETS))


def _word_bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS))


def _grams(words: Column) -> Column:
    """Array of (w, x): every word and the one after it (null after the last)."""
    return F.arrays_zip(words.alias("w"), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))).alias("x"))


def bucket_counts(docs: DataFrame) -> DataFrame:
    """(text, trusted) -> (bucket, trusted count, corpus count) over all words and word pairs."""
    grams = docs.select(words_of(F.col("text")).alias("words"), F.col("trusted").cast("long").alias("trusted")).select(
        "trusted", F.explode(_grams(F.col("words"))).alias("g"))
    first, second = F.col("g.w"), F.col("g.x")
    buckets = grams.select("trusted", F.explode(F.array(
        _word_bucket(first), F.when(second.isNotNull(), _pair_bucket(first, second)))).alias("bucket"))
    return buckets.filter("bucket IS NOT NULL").groupBy("bucket").agg(
        F.sum("trusted").alias("trusted"), F.count(F.lit(1)).alias("corpus"))


def bucket_weights(counts: DataFrame) -> DataFrame:
    """(bucket, weight): the log ratio of the two smoothed multinomials; at most ``BUCKETS`` rows."""
    share = counts.agg((F.sum("trusted").cast("double") / F.sum("corpus")).alias("share"))
    expected = F.col("corpus") * F.coalesce(share.scalar(), F.lit(0.0))
    return counts.select("bucket", F.log((F.col("trusted") + PRIOR) / (expected + PRIOR)).alias("weight"))


def score_quality(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_score: float = MIN_SCORE, trusted_docs: int = TRUSTED_DOCS) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept), a row a row.

    ``trusted`` holds the ids of the trusted documents in its first column
    (nulls and repeats are ignored); beyond ``trusted_docs`` those of the
    smallest hash are taken, so their ids can be broadcast. Null, empty and blank texts have no
    words: all counts and the score are 0, ``base_failed`` is true. A null id
    is never trusted. Without trusted documents every score is 0. An empty
    table gives an empty result; other input columns are ignored.

    The weights, at most ``BUCKETS`` rows, are broadcast; the n-grams of a
    document are looked up and summed inside its task, so one row a document
    is shuffled.
    """
    known = trusted.select(F.col(trusted.columns[0]).alias("_known")).filter("_known IS NOT NULL").distinct()
    known = known.orderBy(F.xxhash64("_known"), "_known").limit(trusted_docs).withColumn("trusted", F.lit(True))
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    marked = base.join(F.broadcast(known), F.col("doc_id") == F.col("_known"), "left").select(
        "text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    weights = stored(bucket_weights(stored(bucket_counts(marked), "quality-counts")), "quality-weights")

    rows = base.withColumn("row", F.monotonically_increasing_id()).withColumns(base_columns(F.col("text")))
    rows = rows.withColumn("words", words_of(F.col("text"))).drop("text")
    rows = repeated_words(rows, "words", "n_repeat_words").withColumn("n_words", F.size("words").cast("long"))
    keys = ["row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    grams = rows.select(*keys, F.explode_outer(_grams(F.col("words"))).alias("g"))
    first, second = F.col("g.w"), F.col("g.x")
    looked = grams.select(*keys, F.when(first.isNotNull(), _word_bucket(first)).alias("one"),
                          F.when(second.isNotNull(), _pair_bucket(first, second)).alias("two"))
    for name in ("one", "two"):
        table = F.broadcast(weights.select(F.col("bucket").alias(f"{name}_b"), F.col("weight").alias(f"{name}_w")))
        looked = looked.join(table, F.col(name) == F.col(f"{name}_b"), "left")
    total = looked.groupBy(*keys).agg(
        F.sum(F.coalesce("one_w", F.lit(0.0)) + F.coalesce("two_w", F.lit(0.0))).alias("total"))
    total = total.withColumn("score", F.when(F.col("n_words") > 0, F.col("total") / (2 * F.col("n_words") - 1))
                             .otherwise(F.lit(0.0)))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return total.select(*keys[1:], failed.alias("base_failed"), "score",
                        (~failed & (F.col("score") >= min_score)).alias("kept"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted documents: those that ``labels`` marks as of good quality."""
    good = read_table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return score_quality(read_table(spark, sf_dir, "documents"), good)
