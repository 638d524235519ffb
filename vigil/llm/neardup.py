"""Near-duplicate embeddings through an inverted multi-index.

Each half of the unit vectors has a codebook of its own; the two codebooks
form a product grid, and every vector is listed in its own cell. A query
visits the cells in the order of their distance (a multi-sequence traversal
of the two sorted lists of half distances) until the cells within reach are
done, and is verified against every vector listed there.

The distance of a cell is how far the query is from it across the codebooks'
borders. No vector within ``sqrt(2 - 2 * cosine)`` can be in a cell farther
than that, so with this reach no link is lost; only the codebooks come from a
sample, and they decide the work, not the result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, stored
from .components import components, spanning_links

COSINE = 0.98
SAMPLE_ROWS = 10_000  # on which codebooks are fitted
ROWS_PER_CELL = 2048  # at which codebooks are sized
MAX_CODES = 256
ROUNDS = 12
BLOCK_ROWS = 4096  # listed rows, and queries, that a task compares at once


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def k_means(points: np.ndarray, k: int) -> np.ndarray:
    """Codebook of ``k`` points, from an even choice of the (hash-ordered) sample."""
    codes = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(ROUNDS):
        own = (((codes * codes).sum(axis=1) - 2 * points @ codes.T)).argmin(axis=1)
        size = np.bincount(own, minlength=k)
        sums = np.zeros_like(codes)
        np.add.at(sums, own, points)
        codes[size > 0] = sums[size > 0] / size[size > 0, None]
    return codes


def border_distances(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """How far each point is from each code's region: 0 for its own, else the distance to the border between the two."""
    d = (points * points).sum(axis=1)[:, None] - 2 * points @ codes.T + (codes * codes).sum(axis=1)
    own = d.argmin(axis=1)
    gap = np.sqrt(np.maximum(((codes[:, None] - codes[None]) ** 2).sum(axis=2), 0))[own]
    near = np.take_along_axis(d, own[:, None], axis=1)
    out = (d - near) / np.maximum(2 * gap, 1e-12)
    out[np.arange(len(points)), own] = 0
    return np.maximum(out, 0)


def multi_sequence(first: np.ndarray, second: np.ndarray, reach: float) -> Iterator[int]:
    """Cells (first * codes + second) in the order of their distance, up to ``reach``."""
    a, b = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    x, y = (first * first).tolist(), (second * second).tolist()
    limit = reach * reach
    heap, k = [(x[a[0]] + y[b[0]], 0, 0)], len(a)
    while heap:
        far, i, j = heapq.heappop(heap)
        if far > limit:
            return
        yield a[i] * k + b[j]
        if j + 1 < k:
            heapq.heappush(heap, (x[a[i]] + y[b[j + 1]], i, j + 1))
        if j == 0 and i + 1 < k:
            heapq.heappush(heap, (x[a[i + 1]] + y[b[0]], i + 1, 0))


def fit(sample: np.ndarray, rows: int) -> list[np.ndarray]:
    """Codebooks of both halves, from a sample of unit vectors."""
    half = sample.shape[1] // 2
    k = int(min(MAX_CODES, max(2, math.ceil(math.sqrt(rows / ROWS_PER_CELL))), max(1, len(sample))))
    return [k_means(part, k) for part in (sample[:, :half], sample[:, half:])]


def sufficient_reach(cosine: float) -> float:
    """The distance of unit vectors at ``cosine``: no cell farther away holds a link."""
    return math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9


def embedding_links(classes: DataFrame, cosine: float = COSINE) -> tuple:
    """``classes`` (id, label, vec, n: how many rows have that vector), all of one dimension ->
    (id, links) and (u, v): rows linked with each id's vector other than its own class', and joining links."""
    spark = classes.sparkSession
    rows = classes.count()
    picked = classes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("vec").toPandas()
    sample = unit(np.stack(picked["vec"].to_numpy()).astype(np.float64))
    sent = spark.sparkContext.broadcast((fit(sample, rows), sufficient_reach(cosine)))
    half = sample.shape[1] // 2

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebooks, far = sent.value
        for batch in batches:
            for part in (batch.slice(i, 2048) for i in range(0, batch.num_rows, 2048)):
                raw = np.stack(part.column(2).to_numpy(zero_copy_only=False))
                v = unit(raw.astype(np.float64))
                first, second = (border_distances(x, b) for x, b in zip((v[:, :half], v[:, half:]), codebooks,
                                                                        strict=True))
                cells = [list(multi_sequence(a, b, far)) for a, b in zip(first, second, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([r.tobytes() for r in v], pa.binary()), part.column(3),
                     pa.array(cells, pa.list_(pa.int64()))], names=["id", "label", "vec", "n", "cells"])

    kind = classes.schema["label"].dataType.simpleString()
    visits = stored(classes.select("id", "label", "vec", "n").mapInArrow(
        visit, f"id long, label {kind}, vec binary, n long, cells array<long>"), "neardup-visits")
    cell = visits.select("id", "label", "vec", "n", F.posexplode("cells").alias("place", "cell"))
    sizes = cell.groupBy("label", "cell").agg(
        F.count_if(F.col("place") == 0).alias("listed"), F.count(F.lit(1)).alias("asked")).filter("listed > 0").select(
        F.col("label").alias("_label"), F.col("cell").alias("_cell"),
        F.ceil(F.col("listed") / BLOCK_ROWS).cast("int").alias("rows"),
        F.ceil(F.col("asked") / BLOCK_ROWS).cast("int").alias("cols"))
    spread = cell.join(sizes, (F.col("label") == F.col("_label")) & (F.col("cell") == F.col("_cell"))).drop(
        "_label", "_cell")
    # A cell's rows and its queries are cut into blocks; each block of rows meets each block of queries once.
    turn = F.xxhash64("id")
    asking = spread.select("id", "label", "vec", "n", "cell", F.lit(False).alias("own"), F.explode(F.sequence(
        F.lit(0), F.col("rows") - 1)).alias("row"), F.pmod(turn, F.col("cols")).cast("int").alias("col"))
    listed = spread.filter("place = 0").select(
        "id", "label", "vec", "n", "cell", F.lit(True).alias("own"),
        F.pmod(turn, F.col("rows")).cast("int").alias("row"),
        F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("col"))

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        ids = group["id"].to_numpy()
        v = np.stack([np.frombuffer(x, np.float64) for x in group["vec"]])
        own = group["own"].to_numpy(bool)
        here, ask = np.flatnonzero(own), np.flatnonzero(~own)
        weight = group["n"].to_numpy(np.int64)[here]
        names, at = np.unique(ids, return_inverse=True)
        links = np.zeros(len(ask), np.int64)

        def pairs() -> Iterator[np.ndarray]:
            for low in range(0, len(ask), 512):
                q = ask[low:low + 512]
                hit = (v[q] @ v[here].T >= cosine) & (ids[q][:, None] != ids[here][None])
                links[low:low + 512] = hit @ weight
                i, j = np.nonzero(hit)
                yield np.column_stack([at[q][i], at[here][j]])

        us, vs = spanning_links(len(names), pairs())
        some = links > 0
        return pd.DataFrame({
            "u": np.concatenate([ids[ask][some], names[us]]),
            "v": pd.array([None] * int(some.sum()) + names[vs].tolist(), dtype="Int64"),
            "links": np.concatenate([links[some], np.zeros(len(us), np.int64)])})

    found = stored(listed.union(asking).groupBy("label", "cell", "row", "col").applyInPandas(
        verify, "u long, v long, links long"), "neardup-found")
    return (found.filter("v IS NULL").groupBy(F.col("u").alias("id")).agg(F.sum("links").alias("links")),
            found.filter("v IS NOT NULL").select("u", "v"))


def near_duplicate_embeddings(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                              label_col: str = "label", cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row a row.

    Vectors are compared only with vectors of the same label (null labels:
    with none) and the same number of components. A vector that is null,
    empty, zero, or holds a null or a non-finite component links with
    nothing: no links, a component of its own, kept. Repeated vectors are one
    class; they link with each other and are compared once. A null id has a
    null component unless it links. An empty table gives an empty result;
    other input columns are ignored.
    """
    vec = F.col(vec_col).cast("array<double>")
    finite = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    base = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), vec.alias("_v"))
    base = base.withColumn("fine", F.coalesce(
        F.col("label").isNotNull() & finite & F.exists("_v", lambda x: x != 0), F.lit(False)))
    base = base.withColumn("code", F.when(F.col("fine"), F.xxhash64("label", "_v")))
    classes = stored(base.filter("fine").groupBy("code", "label", "_v").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n")).select(
        "code", "label", F.col("_v").alias("vec"), "id", "n", F.size("_v").alias("size")), "neardup-classes")
    counts = edges = None
    for size in sorted(r[0] for r in classes.select("size").distinct().collect()):
        found = embedding_links(classes.filter((F.col("size") == size) & F.col("id").isNotNull()), cosine)
        counts = found[0] if counts is None else counts.union(found[0])
        edges = found[1] if edges is None else edges.union(found[1])
    if counts is None:
        return base.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    roots = components(edges, "neardup")
    known = classes.join(counts.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left").join(
        roots, F.col("id") == F.col("node"), "left").select(
        F.col("code").alias("_code"), F.col("label").alias("_label"), F.col("vec").alias("_vec"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("root", "id").alias("root"))
    joined = base.join(known, (F.col("code") == F.col("_code")) & (F.col("label") == F.col("_label"))
                       & (F.col("_v") == F.col("_vec")), "left")
    return joined.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                         F.coalesce("root", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_embeddings(read_table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE vecs AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM vecs a JOIN vecs b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (
  SELECT vec_id AS u, vec_id AS v FROM embeddings
  UNION
  SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
low AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN low l ON e.vec_id = l.u LEFT JOIN counts c ON e.vec_id = c.u
"""
