"""Ranked lexical search by a dual tree: hierarchies over items and over documents, walked together.

A document is the vector of its impacts on the items' terms; a node of the
document tree holds the maximum of each coordinate over its documents, a
node of the item tree the maximum (a term's weight or 0) over its items.
Their product bounds every score between the two nodes. A pair of nodes is
dropped only where that bound is below the weakest k-th score of the items
in it, so the result is exact; what is left is split on both sides down to
single items and documents, where the bound is the score itself. All values
are integers below 2**53, so float64 matrix products give them exactly.

Items come in blocks of about ``BLOCK_TERMS`` terms, whatever their number;
a block is what a task holds of them, with ``CHUNK_DOCS`` documents at a
time. The k-th scores start at those among a bounded sample of the
documents, which are lower bounds of the final ones: they spare work and
decide nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import read_table, stored
from .words import Words, hash_words, slices, split_words

TOP = 10
BLOCK_TERMS = 16_384  # terms of a block of items, about, an item's terms counted once each
BLOCK_ITEMS = 1_024  # items of a block, about
CHUNK_DOCS = 1_024  # documents of a tree
FAN = 8  # children of an inner node
LEAF_DOCS = 16  # documents of a leaf
SAMPLE_DOCS = 2_048  # documents that give the first k-th scores
SALTS = 16  # parts of an item's candidates before the last ranking
IMPACT = 1_000_000_000


def split_terms(texts: pa.Array) -> Words:
    """Terms of every text: runs of anything but ASCII other than letters and digits, A-Z lower-cased."""
    texts = texts.cast(pa.large_string()).fill_null("")
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 32
    table[48:58] = np.arange(48, 58)
    table[65:91] = table[97:123] = np.arange(97, 123)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = table[np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]]] if raw is not None else b""
    return split_words(pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(bytes(data))))


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, terms): the distinct term hashes of every row of ``items``."""
    kind = items.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_terms(part.column(1))
                h = hash_words(words).view(np.int64)
                terms = [np.unique(h[a:b]) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(terms, pa.list_(pa.int64()))], names=["item_id", "terms"])

    return items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"item_id {kind}, terms array<long>")


def doc_vectors(docs: DataFrame, vocabulary: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, tf): all terms of a document counted, and those of the sorted vocabulary by their place."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_terms(part.column(1))
                h = hash_words(words)
                at = np.searchsorted(known, h)
                at[at == len(known)] = 0
                hit = known[at] == h if len(known) else np.zeros(len(h), bool)
                key, tf = np.unique(words.doc_of()[hit] * max(len(known), 1) + at[hit], return_counts=True)
                doc, term = np.divmod(key, max(len(known), 1))
                ends = np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(words.counts().astype(np.int64)),
                     *[pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (term, tf)]],
                    names=["doc_id", "n", "terms", "tf"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n long, terms array<int>, tf array<int>")


def document_frequencies(vectors: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary: partial counts a task, summed by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["term", "df"])

    rows = vectors.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(size, np.int64)
    for term, df in rows.collect():  # at most one row a term of the block
        out[term] = df
    return out


@dataclass
class ItemNode:
    items: np.ndarray
    terms: np.ndarray  # coordinates that are not 0
    weights: np.ndarray  # their maxima over the items
    children: list[ItemNode]


def item_tree(items: list[np.ndarray], weights: np.ndarray, df: np.ndarray) -> ItemNode:
    """Items with the same most frequent terms (so of one language) stand side by side, ``FAN`` to a node."""
    def node(children: list[ItemNode]) -> ItemNode:
        terms = np.unique(np.concatenate([c.terms for c in children]))
        return ItemNode(np.concatenate([c.items for c in children]), terms, weights[terms], children)

    order = sorted(range(len(items)), key=lambda i: [int(t) for t in items[i][np.argsort(-df[items[i]], kind="stable")][:4]])
    level = [ItemNode(np.array([i]), items[i], weights[items[i]], []) for i in order]
    while len(level) > 1:
        level = [node(level[i:i + FAN]) for i in range(0, len(level), FAN)]
    return level[0]


class Best:
    """The best documents of every item so far: scores descending, then ids ascending, a null id last."""

    def __init__(self, n_items: int, top: int, floor: np.ndarray) -> None:
        self.top = top
        self.found = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in range(n_items)]
        self.floor = floor.copy()  # a score below it is not among an item's best

    def add(self, item: int, scores: np.ndarray, nulls: np.ndarray, ids: np.ndarray) -> None:
        scores, nulls, ids = (np.concatenate(x) for x in zip(self.found[item], (scores, nulls, ids), strict=True))
        order = np.lexsort((ids, nulls, -scores))[:self.top]
        self.found[item] = scores[order], nulls[order], ids[order]
        if len(order) == self.top:
            self.floor[item] = max(self.floor[item], scores[order[-1]])


class DocTree:
    """A tree over some documents: ``levels[0]`` the root's maxima, ``levels[-1]`` the documents' impacts."""

    def __init__(self, impacts: np.ndarray) -> None:
        self.levels = [impacts]
        size = LEAF_DOCS
        while len(self.levels[0]) > 1:
            low = self.levels[0]
            low = np.vstack([low, np.zeros((-len(low) % size, low.shape[1]), low.dtype)])
            self.levels.insert(0, low.reshape(-1, size, low.shape[1]).max(axis=1))
            size = FAN

    def children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        size = LEAF_DOCS if level == len(self.levels) - 2 else FAN
        below = (nodes[:, None] * size + np.arange(size)).ravel()
        return below[below < len(self.levels[level + 1])]


def walk(root: ItemNode, tree: DocTree, best: Best, nulls: np.ndarray, ids: np.ndarray) -> int:
    """Walks both trees together; the number of pairs of nodes whose bound was taken."""
    visits = 0
    stack = [(root, 0, np.arange(len(tree.levels[0])))]
    last = len(tree.levels) - 1
    while stack:
        node, level, docs = stack.pop()
        visits += len(docs)
        bound = tree.levels[level][np.ix_(docs, node.terms)].astype(np.float64) @ node.weights
        weakest = max(best.floor[node.items].min(), 1)
        alive = bound >= weakest
        if not alive.any():
            continue
        docs, bound = docs[alive], bound[alive]
        if level == last and not node.children:
            best.add(int(node.items[0]), bound.astype(np.int64), nulls[docs], ids[docs])
            continue
        if level < last:
            docs, level = tree.children(level, docs), level + 1
        for child in node.children or [node]:
            stack.append((child, level, docs))
    return visits


def search_block(vectors: DataFrame, root: ItemNode, size: int, average: tuple[int, int], floor: np.ndarray,
                 top: int) -> DataFrame:
    """(item, doc_id, score): every task's best documents of every item of a block."""
    sent = vectors.sparkSession.sparkContext.broadcast((root, floor))
    n_docs, n_terms = average

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, start = sent.value
        best = Best(len(start), top, start)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_DOCS):
                part = batch.slice(at, CHUNK_DOCS)
                n = part.column(1).to_numpy()
                m = 10 + (90 * n * n_docs) // n_terms
                terms, tf = (part.column(k).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for k in (2, 3))
                held = np.asarray(part.column(2).value_lengths())
                row = np.repeat(np.arange(part.num_rows), held)
                impacts = np.zeros((part.num_rows, size), np.float32)  # below 2**20: exact
                impacts[row, terms] = (IMPACT * tf) // (1000 * tf + 8 * m[row])
                # Documents that share their strongest term stand side by side.
                order = np.argsort((impacts[:, tree.terms] * tree.weights.astype(np.float32)).argmax(axis=1), kind="stable")
                order = order[held[order] > 0]
                if not len(order):
                    continue
                ids = part.column(0)
                walk(tree, DocTree(impacts[order]), best, np.asarray(ids.is_null())[order],
                     ids.fill_null(0).to_numpy()[order])
        for item, (scores, nulls, ids) in enumerate(best.found):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(scores), item, np.int32)), pa.array(ids, mask=nulls), pa.array(scores)],
                    names=["item", "doc_id", "score"])

    return vectors.mapInArrow(run, "item int, doc_id long, score long")


def best_of(rows: DataFrame, keys: list[str], top: int) -> DataFrame:
    """The ``top`` rows of each key with their rank; a key with many rows is ranked in parts first."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    some = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys, part).orderBy(*order))).filter(
        F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(
        F.col("rank") <= top)


def rank_documents(items: DataFrame, docs: DataFrame, item_col: str = "item_id", id_col: str = "doc_id",
                   text_col: str = "text", top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item with a score above 0, best first.

    Scores as in the contract of ``op12_search``. Every row of ``items`` is
    an item of its own, so repeated rows give repeated results; every row of
    ``docs`` is a document, repeated rows are ranked one by one. Equal
    scores go by ascending id, a null id last. Null, empty and blank texts
    hold no terms: such items give no rows, such documents are not counted
    or found. Empty tables give an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    kind = items.schema[item_col].dataType.simpleString()
    asked = stored(item_terms(items, item_col, text_col), "search-items").withColumn(
        "row", F.monotonically_increasing_id()).filter(F.size("terms") > 0)
    asked = stored(asked, "search-asked")
    n_items, total = asked.agg(F.count(F.lit(1)), F.sum(F.size("terms"))).first()
    blocks = max(1, -(-(total or 0) // BLOCK_TERMS), -(-n_items // BLOCK_ITEMS))
    out = None
    for block in range(blocks):
        held = asked.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).collect()  # bounded by the block
        if not held:
            continue
        vocabulary = np.unique(np.concatenate([np.array(r.terms, np.int64) for r in held]).view(np.uint64))
        vectors = stored(doc_vectors(docs, vocabulary, id_col, text_col), "search-vectors")
        n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not n_terms:
            break
        df = document_frequencies(vectors, len(vocabulary))
        weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1)))
        terms = [np.searchsorted(vocabulary, np.array(r.terms, np.int64).view(np.uint64)) for r in held]
        root = item_tree([np.sort(t) for t in terms], weights, df)
        average = (int(n_docs), int(n_terms))

        floor = np.zeros(len(held), np.int64)
        sample = stored(vectors.filter("n > 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS), "search-sample")
        first = best_of(search_block(sample, root, len(vocabulary), average, floor, top), ["item"], top)
        for item, score in first.filter(F.col("rank") == top).select("item", "score").collect():  # one an item
            floor[item] = score

        found = stored(search_block(vectors, root, len(vocabulary), average, floor, top), "search-found")
        names = spark.createDataFrame([(k, r.item_id) for k, r in enumerate(held)], f"_item int, item_id {kind}")
        ranked = best_of(found, ["item"], top).join(F.broadcast(names), F.col("item") == F.col("_item")).select(
            "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = ranked if out is None else out.union(ranked)
    empty = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return empty if out is None else out


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(read_table(spark, sf_dir, "benchmark"), read_table(spark, sf_dir, "documents"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS terms FROM documents),
item AS (
  SELECT row_number() OVER () AS i, item_id, list_distinct(regexp_extract_all({_LOWER}, '{_TERM}')) AS terms
  FROM benchmark),
stats AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS n, CAST(sum(len(terms)) AS BIGINT) AS l FROM doc),
tf AS (
  SELECT r, doc_id, len(terms) AS size, t.term, count(*) AS tf
  FROM doc, unnest(terms) AS t(term) GROUP BY ALL),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, stats GROUP BY term),
score AS (
  SELECT i.i, i.item_id, tf.r, tf.doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size * n) // l)))) AS BIGINT) AS score
  FROM (SELECT i, item_id, unnest(terms) AS term FROM item) i
  JOIN tf ON tf.term = i.term JOIN weight ON weight.term = i.term, stats
  GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM score WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
