"""Mixing sources to target weights: random keys, range sort, prefix sums, exact cut.

Every document gets a hash-random key. The key space is cut into ranges
(``KEY_DIGITS`` hex digits); a prefix sum over the ranges of a source, which
are few, plus one inside each range gives the number of words before a
document in its source's random order. A source whose target is ``e`` full
epochs and ``r`` words takes every document ``e`` times and the first ``r``
words of that order once more, so it takes exactly ``floor(target)`` words;
at most one document a source is cut. No task ever holds more than one key
range of one source.

Native: DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import read_table, stored, word_count, words_of

WEIGHTS = (1, 2, 3)  # of the sources in code-point order, repeating
MAX_EPOCHS = 3  # a target stops at this many times its source's size
KEY_DIGITS = 3  # 16**3 key ranges a source
SEED = "mix-1"
ADDED = ("mix_size", "mix_source_size", "mix_target", "mix_taken")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> the same with ``weight`` and ``target``; one row a source.

    The level ``l`` of ``target = least(max_epochs * source_size, l * weight)``
    that shares out the whole total: with the sources in the order in which
    they reach their stop, the level rises while sources stop and falls after,
    so its maximum is the answer.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    ranked = sizes.withColumn("weight", weight).withColumn(
        "_stop", max_epochs * F.col("source_size") / F.col("weight"))
    earlier = Window.orderBy("_stop", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left_size = F.sum("source_size").over(whole) - max_epochs * F.coalesce(F.sum("source_size").over(earlier), F.lit(0))
    left_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    return (
        ranked.withColumn("_left_size", left_size).withColumn("_left_weight", left_weight)
        .withColumn("_level", F.max(F.col("_left_size").cast("double") / F.col("_left_weight")).over(whole))
        .select("source", "source_size", "weight",
                F.least((max_epochs * F.col("source_size")).cast("double"), F.col("_level") * F.col("weight"))
                .alias("target"))
    )


def _planned(docs: DataFrame, size: Column, tie: Column, id_col: str, source_col: str, weights: tuple[int, ...],
             max_epochs: int, seed: str) -> DataFrame:
    """(row, size, source_size, target, taken): the input's row as one struct, so that no name of it can clash."""
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), tie))
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(size, F.lit(0)).cast("long").alias("size"),
        F.col(id_col).alias("id"), F.col(source_col).alias("of"), key.alias("key"))
    base = base.withColumn("part", F.substring("key", 1, KEY_DIGITS))

    ranges = stored(base.groupBy(F.col("of").alias("source"), F.col("part").alias("range")).agg(
        F.sum("size").alias("range_size")), "mix-ranges")
    targets = source_targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")),
                             weights, max_epochs)
    up_to = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("start", F.coalesce(F.sum("range_size").over(up_to), F.lit(0)))
    starts = starts.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).select(
        "source", "range", "start", "source_size", "target")

    placed = base.join(starts, F.col("of").eqNullSafe(F.col("source")) & (F.col("part") == F.col("range")))
    inside = Window.partitionBy("of", "part").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0))
    rest = F.floor("target") - epochs * F.col("source_size")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return placed.select("row", "size", "source_size", "target", (epochs * F.col("size") + cut).cast("long").alias("taken"))


def plan_mix(docs: DataFrame, size: Column, tie: Column | None = None, id_col: str = "doc_id",
             source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
             seed: str = SEED) -> DataFrame:
    """``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_taken`` (words taken, repeats counted).

    A null size counts 0; a null source is a source of its own, the last
    one. A document's key hashes its id and ``tie``, a text that tells apart
    documents with null or repeated ids (such as a digest of their content);
    what is still equal is ordered by id and size, and repeated rows are
    counted one by one. An empty table gives an empty result. Input columns
    named like the added ones are replaced.
    """
    plan = _planned(docs, size, F.lit("") if tie is None else tie, id_col, source_col, weights, max_epochs, seed)
    keep = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c.lower() not in ADDED]
    return plan.select(*keep, *[F.col(n.removeprefix("mix_")).alias(n) for n in ADDED])


def content_tie(text: Column) -> Column:
    """Digest of a document's text, for ``plan_mix``."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def mix_documents(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source",
                  weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document taken ``k`` times is there ``k`` times.

    The one document a source that the budget cuts gets one more row that
    holds only its first words, joined by one space. Documents without a
    word are not in the mix (there is nothing to take). ``n_chars``, where
    there is such a column, follows the text of a cut row; all other columns
    come through as they are, whatever their names.
    """
    words = F.col(text_col)
    plan = _planned(docs, word_count(words), content_tie(words), id_col, source_col, weights, max_epochs, seed)
    whole = F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(F.lit(0)).cast("int")
    part = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(F.lit(0)).cast("long")
    parts = F.concat(F.array_repeat(F.lit(0).cast("long"), whole),
                     F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<long>")))
    rows = plan.select("row", F.explode(parts).alias("take"))
    whole_text = F.col(f"row.`{text_col}`")
    head = F.array_join(F.slice(words_of(whole_text), 1, F.greatest(F.col("take"), F.lit(1)).cast("int")), " ")
    rows = rows.withColumn("head", F.when(F.col("take") > 0, head))

    def column(c: str) -> Column:
        own = F.col(f"row.`{c}`")
        if c == text_col:
            return F.coalesce("head", own).alias(c)
        if c == "n_chars":
            return F.coalesce(F.length("head").cast("long"), own).alias(c)
        return own.alias(c)

    return rows.select(*[column(c) for c in docs.columns])


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "source", word_count(F.col("text")).alias("words"), content_tie(F.col("text")).alias("tie"))
    return plan_mix(stored(docs, "op10-sizes"), F.col("words"), F.col("tie")).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"))


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM sized GROUP BY source),
lev AS (
  SELECT *, CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER w, 0) AS DOUBLE)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM src WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tgt AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), max(level) OVER () * weight) AS target FROM lev),
ordered AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN tgt t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
            + greatest(0, least(size, budget - (budget // source_size) * source_size - before)) END AS BIGINT) AS taken
FROM ordered
"""
