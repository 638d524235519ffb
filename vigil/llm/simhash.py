"""SimHash near-duplicates: fingerprints, and a binary trie joined with itself.

A fingerprint bit is 1 where over half of a text's shingle hashes have it.
The distinct fingerprints form a binary trie over their bits; two nodes of
the same depth are visited together with the number of bits in which their
paths differ, and a pair of nodes whose count is over the error budget is
left, with all below it. The top of the trie is cut into subtrees small
enough for a task; each pair of subtrees within the budget is one group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, stored
from .components import components, spanning_links
from .words import slices

SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42
SUBTREE_ROWS = 4_000_000  # fingerprints in a subtree of the top cut, at most (down to CUT_BITS): the fewer, the more copies
LEAST_SUBTREES = 8  # of the top cut, about, however few rows there are
CUT_BITS = 16  # the cut lies within so many bits
BROADCAST_PAIRS = 500_000  # rows (of 24 bytes) of subtree pairs up to which they are broadcast
LEAF_PAIRS = 32  # a node pair with at most so many pairs of fingerprints is compared directly
FRONTIER = 1 << 15  # node pairs expanded at once


def bit_majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Fingerprint of each run ``hashes[first[d]:first[d + 1]]``; 0 for an empty run."""
    n = np.diff(first)
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    step = 1 << 16
    sums = np.zeros((len(n), 64), np.int64)
    for at in range(0, len(hashes), step):  # bits of a bounded number of hashes at a time
        part = hashes[at:at + step]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        low = max(0, int(np.searchsorted(first, at, side="right")) - 1)
        high = int(np.searchsorted(first, at + len(part), side="left"))
        own = [d for d in range(low, high) if n[d]]
        cuts = np.maximum(first[own] - at, 0)
        sums[own] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    ones = sums[full] * 2 > n[full, None]
    out[full] = np.packbits(ones, axis=1).view(">u8").ravel().astype(np.uint64)
    return out


def text_hashes(text: str | None, shingle: int, seed: int) -> list[int]:
    """Hashes of a text's shingles: whole words in A-Z lower case, joined by one space."""
    import xxhash

    words = text.encode().lower().split() if text else []
    if not words:
        return []
    digest = xxhash.xxh64_intdigest
    line = b" ".join(words)
    if len(words) <= shingle:
        return [digest(line, seed)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    count = len(words) - shingle + 1
    return [digest(line[a:b], seed) for a, b in zip(starts[:count].tolist(), (ends[shingle - 1:] - 1).tolist(),
                                                    strict=True)]


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS, seed: int = HASH_SEED,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, version, bits): one row an input row; ``bits`` is the fingerprint as a signed long (no words: zero),
    ``version`` a hash of the text that tells apart different texts under one id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                runs = [text_hashes(t, shingle, seed) for t in part.column(2).to_pylist()]
                first = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int64)
                flat = np.fromiter((h for r in runs for h in r), np.uint64, int(first[-1]))
                bits = bit_majority(flat, first).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(bits)],
                                                 names=["doc_id", "version", "bits"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.hash(text).alias("version"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, version int, bits long")


def _children(prints: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where the one-branch of each node ``prints[lo:hi]`` (common bits above ``depth``) begins."""
    shift = np.uint64(63 - depth)
    first = (prints[lo] >> shift) | np.uint64(1)
    return np.clip(np.searchsorted(prints, first << shift, side="left"), lo, hi)


def trie_join(left: np.ndarray, right: np.ndarray, depth: int, same: bool, budget: int) -> Iterator[np.ndarray]:
    """Index pairs (rows of a 2-column array) of fingerprints within ``budget`` bits.

    ``left`` and ``right`` are sorted distinct fingerprints of two subtrees
    at ``depth`` (one subtree twice if ``same``: then each pair comes once).
    """
    if not len(left) or not len(right):
        return
    top = 0 if same or not depth else int((left[0] ^ right[0]) >> np.uint64(64 - depth)).bit_count()
    zero = np.zeros(1, np.int64)
    stack = [(depth, zero, zero + len(left), zero, zero + len(right), zero + top)]
    while stack:
        d, a, b, x, y, far = stack.pop()
        if len(a) > FRONTIER:
            half = len(a) // 2
            stack.append((d, a[half:], b[half:], x[half:], y[half:], far[half:]))
            a, b, x, y, far = a[:half], b[:half], x[:half], y[:half], far[:half]
            if len(a) > FRONTIER:
                stack.append((d, a, b, x, y, far))
                continue
        small = ((b - a) * (y - x) <= LEAF_PAIRS) | (d == 64)
        if small.any():
            na, nx = (b - a)[small], (y - x)[small]
            size = na * nx
            node = np.repeat(np.arange(len(size)), size)
            within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            i = a[small][node] + within // nx[node]
            j = x[small][node] + within % nx[node]
            near = np.bitwise_count(left[i] ^ right[j]) <= budget
            if same:
                near &= i < j
            if near.any():
                yield np.column_stack([i[near], j[near]])
        a, b, x, y, far = (v[~small] for v in (a, b, x, y, far))
        if not len(a):
            continue
        p, q = _children(left, a, b, d), _children(right, x, y, d)
        kids = [(a, p, x, q, far), (p, b, q, y, far), (a, p, q, y, far + 1), (p, b, x, q, far + 1)]
        na, nb, nx, ny, nf = (np.concatenate(c) for c in zip(*kids, strict=True))
        live = (na < nb) & (nx < ny) & (nf <= budget)
        if same:
            live &= na <= nx  # the mirror image of a pair is the same pair
        stack.append((d + 1, na[live], nb[live], nx[live], ny[live], nf[live]))


def cut_trie(counts: dict[int, int], limit: int, bits: int = CUT_BITS) -> list[tuple[int, int]]:
    """Nodes (prefix, depth) that cover the trie, each with at most ``limit`` rows or ``bits`` deep; counts by prefix."""
    out = []
    stack = [(0, 0, sorted(counts.items()))]
    while stack:
        prefix, depth, inside = stack.pop()
        if depth == bits or sum(c for _, c in inside) <= limit:
            out.append((prefix, depth))
            continue
        half = ((prefix << 1) + 1) << (bits - depth - 1)
        for kid, part in ((0, [x for x in inside if x[0] < half]), (1, [x for x in inside if x[0] >= half])):
            if part:
                stack.append(((prefix << 1) + kid, depth + 1, part))
    return sorted(out, key=lambda x: x[0] << (bits - x[1]))


def subtree_pairs(spark: SparkSession, nodes: list[tuple[int, int]], budget: int) -> DataFrame:
    """(node, low, high, depth): the pairs of cut nodes whose common bits differ in at most ``budget``, for each of the two.

    The cut, at most 2**CUT_BITS nodes, is sent to the tasks; each makes the
    pairs of some of them, so their number, which grows faster than the cut,
    is nowhere held at once.
    """
    prefix, depth = (np.array(x, np.int64) for x in zip(*nodes, strict=True))
    starts = np.array([p << (64 - d) for p, d in nodes], np.uint64).view(np.int64)
    sent = spark.sparkContext.broadcast((prefix, depth, starts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, depth, starts = sent.value
        for batch in batches:
            for i in batch.column(0).to_pylist():
                low = np.minimum(depth[i:], depth[i])
                near = np.bitwise_count((prefix[i] >> (depth[i] - low)) ^ (prefix[i:] >> (depth[i:] - low))) <= budget
                j = np.flatnonzero(near)  # the first is the node itself
                node = np.concatenate([np.full(len(j), i), i + j[1:]])
                other = np.concatenate([j, j[1:]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node.astype(np.int32)), pa.array(np.full(len(node), starts[i])), pa.array(starts[i + other]),
                     pa.array(low[other].astype(np.int32))], names=["node", "low", "high", "depth"])

    return spark.range(len(nodes)).mapInArrow(run, "node int, low long, high long, depth int")


def fingerprint_links(prints: DataFrame, budget: int = MAX_BITS, subtree_rows: int = SUBTREE_ROWS) -> DataFrame:
    """(u, v): links between the distinct fingerprints ``bits``, enough of them to join all that is linked.

    The trie is cut near its top into subtrees of at most ``subtree_rows``;
    a fingerprint goes to each pair of subtrees that its own forms with one
    within the budget. The driver sees the 2**CUT_BITS counts and the cut.
    """
    spark = prints.sparkSession
    top = F.shiftrightunsigned("bits", 64 - CUT_BITS)
    counts = {r[0]: r[1] for r in prints.groupBy(top.alias("p")).count().collect()}
    total = sum(counts.values())
    nodes = cut_trie(counts, min(subtree_rows, -(-total // LEAST_SUBTREES))) if counts else [(0, 0)]
    starts = [p << (64 - d) for p, d in nodes]
    owner = [(p, int(i)) for p, i in zip(counts, np.searchsorted(
        np.array(starts, np.uint64), np.array(list(counts), np.uint64) << np.uint64(64 - CUT_BITS), "right") - 1,
        strict=True)]
    groups = stored(subtree_pairs(spark, nodes, budget), "simhash-pairs")
    owners = spark.createDataFrame(owner, "p long, node int")  # 2**CUT_BITS rows at most
    # The few subtrees would be few join keys; their pairs are broadcast as long as they are small.
    near = F.broadcast(groups) if groups.count() <= BROADCAST_PAIRS else groups
    spread = prints.select("bits", top.alias("p")).join(F.broadcast(owners), "p").join(near, "node")

    def join(group: pd.DataFrame) -> pd.DataFrame:
        depth, low, high = (int(group[c].iat[0]) for c in ("depth", "low", "high"))
        values = np.sort(group["bits"].to_numpy().view(np.uint64))
        if low == high:
            us, vs = spanning_links(len(values), trie_join(values, values, depth, True, budget))
        else:
            cut = int(np.searchsorted(values, np.uint64(high & (1 << 64) - 1)))
            pairs = trie_join(values[:cut], values[cut:], depth, False, budget)
            us, vs = spanning_links(len(values), (p + np.array([0, cut]) for p in pairs))
        back = values.view(np.int64)
        return pd.DataFrame({"u": back[us], "v": back[vs]})

    return spread.select("bits", "low", "high", "depth").groupBy("low", "high", "depth").applyInPandas(
        join, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, version, bits, component_id): the smallest id reachable over links of at most ``max_bits`` bits.

    Null, empty and blank texts have fingerprint zero and link like any
    other. Texts with fewer words than a shingle have one hash, of all their
    words. Repeated rows come back once each; rows with a null id keep it and
    never give a component its name unless it has no other (then null). An
    empty table gives an empty result. Other input columns are ignored.
    """
    rows = stored(fingerprints(docs, shingle, id_col=id_col, text_col=text_col), "simhash-prints")
    distinct = stored(rows.groupBy("bits").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = components(fingerprint_links(distinct.select("bits"), max_bits), "simhash")
    named = distinct.join(roots, F.col("bits") == F.col("node"), "left").select(
        "bits", F.coalesce("root", "bits").alias("root"), "first_id")
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = named.select("bits", F.col("root").alias("_root")).join(ids, F.col("_root") == F.col("root")).select(
        F.col("bits").alias("_bits"), "component_id")
    return rows.join(classes, F.col("bits") == F.col("_bits")).select(
        "doc_id", "version", "bits", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: of the group's smallest id.

    Of repeated rows with that id one stays; of different texts under it the
    one of the smallest hash. Rows with a null id are not judged; they stay.
    """
    found = near_duplicates(docs, shingle, max_bits, id_col, text_col)
    stay = found.filter("doc_id = component_id").groupBy(F.col("doc_id").alias("_stay_id")).agg(
        F.min("version").alias("_stay_version"))
    # The input's row is one struct, so that no name of it can clash.
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.col(id_col).cast("long").alias("_own_id"), F.hash(F.col(text_col).cast("string")).alias("_own_version"))
    # Sorted and merged at every size: the texts move once, whatever the number of groups.
    kept = marked.join(stay.hint("merge"), (F.col("_own_id") == F.col("_stay_id"))
                       & (F.col("_own_version") == F.col("_stay_version")), "left_semi")
    kept = kept.dropDuplicates(["_own_id", "_own_version"])
    return kept.union(marked.filter("_own_id IS NULL")).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
