"""URL filter: rules first, and a logistic regression on hashed character n-grams for the rest.

The model sees the character n-grams of the host and of the path (marked by
which of the two they come from), hashed into ``FEATURES`` weights. It is
trained in numpy on a small table of labelled URLs; applying it needs only
the weights, whose size is fixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, read_table
from .words import BASE, mix

# --- fixed values: rules as (verdict, host, path) --------------------------------
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# -----------------------------------------------------------------------------------
FEATURES = 1 << 16
GRAM_SIZES = (2, 3, 4, 5)
LABELLED_ROWS = 4000  # bound of the training table, for each verdict
STEPS, RATE, DECAY = 300, 4.0, 1e-4


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for a null url or one without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = [F.coalesce(F.regexp_extract(url, pattern, i), F.lit("")) for i in (1, 2)]
    return ascii_lower(part[0]), part[1]


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host followed by path) and its verdict; null where none does."""
    name = verdict = None
    for kind, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)) if name is None else name.when(fits, F.lit(h + p))
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    if name is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return name, verdict


def url_features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every n-gram of ``^host$`` and ``/path$``."""
    rows, feats = [], []
    for side, texts in enumerate((hosts, paths)):
        raw = [b"\x02" + t.encode() + b"\x03" for t in texts]
        size = np.array([len(r) for r in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64) + np.uint64(1 + 256 * side)
        row = np.repeat(np.arange(len(raw)), size)
        left = np.repeat(np.cumsum(size), size) - np.arange(len(data))  # bytes from here to the text's end
        gram = np.zeros(len(data), np.uint64)
        for k in range(max(GRAM_SIZES)):
            gram = gram * np.uint64(BASE) + np.concatenate([data[k:], np.zeros(min(k, len(data)), np.uint64)])
            if k + 1 in GRAM_SIZES:
                own = left > k
                rows.append(row[own])
                feats.append((mix(gram[own] + np.uint64(k)) % np.uint64(FEATURES)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(feats)


def _logit(rows: np.ndarray, feats: np.ndarray, n: int, weights: np.ndarray, bias: float) -> np.ndarray:
    sums = np.bincount(rows, weights[feats], n)
    return bias + sums / np.sqrt(np.maximum(np.bincount(rows, minlength=n), 1))


def _chance(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def train(hosts: list[str], paths: list[str], blocked: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient descent on the whole (small) table; the classes weigh the same.

    Without rows of both classes the weights are 0 and the bias says the class at hand (allow, if none).
    """
    weights, n = np.zeros(FEATURES), len(blocked)
    yes = blocked.sum()
    if not n or yes in (0, n):
        return weights, (4.0 if n and yes else -4.0)
    share = np.where(blocked, 0.5 / yes, 0.5 / (n - yes))
    rows, feats = url_features(hosts, paths)
    scale = 1 / np.sqrt(np.maximum(np.bincount(rows, minlength=n), 1))
    bias, speed, bias_speed = 0.0, np.zeros(FEATURES), 0.0
    for _ in range(STEPS):
        miss = (_chance(_logit(rows, feats, n, weights, bias)) - blocked) * share
        speed = 0.9 * speed - RATE * (np.bincount(feats, (miss * scale)[rows], FEATURES) + DECAY * weights)
        bias_speed = 0.9 * bias_speed - 0.1 * miss.sum()
        weights, bias = weights + speed, bias + bias_speed
    return weights, float(bias)


def judge_urls(pages: DataFrame, labelled: DataFrame, rules=RULES, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score), a row a row.

    ``labelled`` is a small table (url, blocked); it is collected, so its
    bound is the caller's. The verdict is the fitting rule's, or ``block``
    where the model's probability ``score`` is 0.5 or more. Null urls and
    urls without ``://`` have an empty host and path and are judged as such.
    An empty table gives an empty result; other input columns are ignored.
    """
    host, path = url_parts(F.col("url"))
    table = labelled.select(F.col("url"), F.col("blocked").cast("int").alias("blocked")).filter(
        "blocked IS NOT NULL").select(host.alias("h"), path.alias("p"), "blocked").collect()
    weights, bias = train([r.h for r in table], [r.p for r in table], np.array([r.blocked for r in table], float))
    sent = pages.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            rows, feats = url_features(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            p = _chance(_logit(rows, feats, n, sent.value, bias))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*batch.schema.names, "score"])

    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    parts = base.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": rule, "rule_verdict": verdict})
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema)
    own = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return parts.mapInArrow(score, kinds + ", score double").select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"), "score")


def rule_labels(pages: DataFrame, rules=RULES, bound: int = LABELLED_ROWS, url_col: str = "url") -> DataFrame:
    """A small labelled table (url, blocked): of the distinct urls that a rule decides, the ``bound`` of the smallest
    hash of each verdict."""
    host, path = url_parts(F.col("url"))
    _, verdict = rule_columns(host, path, rules)
    known = pages.select(F.col(url_col).cast("string").alias("url")).withColumn("verdict", verdict)
    labelled = known.filter("verdict IS NOT NULL").distinct().select("url", (F.col("verdict") == "block").alias("blocked"))
    block, allow = (labelled.filter(kind).orderBy(F.xxhash64("url"), "url").limit(bound)
                    for kind in ("blocked", "NOT blocked"))
    return block.union(allow)


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return judge_urls(pages, rule_labels(pages))
