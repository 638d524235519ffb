"""Substring dedup by prefix-partitioned suffix trees.

A window is a run of ``WINDOW`` words, the head of a suffix of its text. Two
suffixes that meet in a node at least that deep are a repeat.

1. Suffixes are led to their tree by the gram of ``GRAM`` words with the
   smallest hash in their window, the prefix of the suffix that starts there;
   equal windows have equal grams at the same place. Neighbouring suffixes
   with the same gram travel as one segment, a text once instead of once a
   suffix. (A prefix at each suffix's own first word would send every repeated
   word ``WINDOW`` times.) Segments of equal content are one content, kept with
   the smallest document it is in: all later ones are repeats as a whole.
2. Contents that share a gram with a different content form the group of that
   prefix. Only for these are the words fetched.
3. A group of at most ``GROUP_CONTENTS`` becomes a subtree over all suffixes of
   its segments, kept as the sorted suffixes and the words that neighbours have
   in common. Its internal nodes at least a window deep are the repeats; those
   that no word to the left extends are the maximal ones, and give the ranges.
   The suffixes of a larger group are split by a longer prefix, the whole
   window, where a node is a group of its own and its smallest document is a
   partial aggregate.
4. The ranges found are joined with the texts, and their words removed.

Texts cross the network compressed, keyed by document; no step holds more
than one document, one group or one batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, stored
from .words import BASE, hash_grams, hash_words, mix, powers, slices, split_words

WINDOW = 50
GRAM = 12
GROUP_CONTENTS = 2000
LONG_WORD = 64  # bytes; a longer word is compared by its digest
CHUNK_WORDS = 1 << 20  # words whose anchors are looked for at once (below 2**24)

SEGMENTS = "gram long, seg long, doc_id long, version int, start int, n int"


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have:])


def segments(h: np.ndarray, first: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> Iterator[tuple]:
    """Segments of texts with word hashes ``h[first[d]:first[d + 1]]``: arrays (text, start, n, gram, content hash).

    ``start`` counts from the text's first word; a segment holds the ``n``
    windows from there on.
    """
    place = np.uint64((1 << 24) - 1)
    begin = 0
    while begin + window <= len(h):
        own = h[begin:begin + CHUNK_WORDS + window - 1]
        count = len(own) - window + 1
        grams = hash_grams(own, gram)
        keys = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
        anchor = (sliding_min(keys, window - gram + 1) & place).astype(np.int64)
        at = begin + np.arange(count)
        text = np.searchsorted(first, at, side="right") - 1
        whole = at + window <= first[text + 1]
        new = np.ones(count, bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        new &= whole
        low = np.flatnonzero(new)
        if len(low):
            n = np.add.reduceat(whole.astype(np.int64), low)
            p, q = powers(len(own) + 1)
            sums = np.zeros(len(own) + 1, np.uint64)
            np.cumsum(own * p[: len(own)], out=sums[1:])
            content = mix((sums[low + n + window - 1] - sums[low]) * q[low] + n.astype(np.uint64) * np.uint64(BASE))
            yield text[low], at[low] - first[text[low]], n, grams[anchor[low]], content
        begin += CHUNK_WORDS


def _segment_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column(2))
                for text, start, n, key, content in segments(hash_words(words), words.first, window, gram):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key.view(np.int64)), pa.array(content.view(np.int64)),
                        part.column(0).take(pa.array(text)), part.column(1).take(pa.array(text)),
                        pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
                        names=["gram", "seg", "doc_id", "version", "start", "n"])

    return docs.select("doc_id", "version", "text").mapInArrow(run, SEGMENTS)


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` with its column ``text`` as compressed bytes ``body`` in the last place (null: null)."""
    names = docs.columns
    at = names.index("text")
    kept = [n for n in names if n != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in slices(batch, "text"):
                body = [None if t is None else press.compress(t.encode()) for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [c for i, c in enumerate(part.columns) if i != at] + [pa.array(body, pa.binary())],
                    names=[*kept, "body"])

    kinds = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in kept)
    return docs.mapInArrow(run, f"{kinds}, body binary")


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, bytes | None]]:
    """The text of every row of batches whose third column is ``body``: (batch, row, text)."""
    import zstandard

    press = zstandard.ZstdDecompressor()
    for batch in batches:
        bodies = batch.column(2)
        for row in range(batch.num_rows):
            body = bodies[row].as_py()
            yield batch, row, None if body is None else press.decompress(body)


def _short(word: bytes) -> bytes:
    return word if len(word) <= LONG_WORD else b"\0" + hashlib.sha256(word).hexdigest().encode()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)],
                                      schema=schema)


def _fetch(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """Words of the wanted segments (doc_id, version, gram, seg, start, n, long_prefix), each content of a text once.

    A row is a content under its gram, with its words; or, where
    ``long_prefix``, one of its windows under the hashes of all its words.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("gram", pa.int64()), ("more", pa.int64()), ("doc_id", pa.int64()),
                            ("version", pa.int32()), ("starts", pa.list_(pa.int32())), ("n", pa.int32()),
                            ("words", pa.binary())])
        out: list[tuple] = []
        size = 0
        for batch, row, text in unpacked(batches):
            words = (text or b"").split()
            doc, version = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
            by_content: dict[tuple, list[int]] = {}
            for s in batch.column(3)[row].as_py():
                by_content.setdefault((s["gram"], s["seg"], s["n"], s["long_prefix"]), []).append(s["start"])
            for (gram, _, n, long_prefix), starts in by_content.items():
                own = [_short(w) for w in words[starts[0]:starts[0] + n + window - 1]]
                if not long_prefix:
                    out.append((gram, 0, doc, version, starts, n, b" ".join(own)))
                else:
                    for k in range(n):
                        digest = hashlib.blake2b(b" ".join(own[k:k + window]), digest_size=16).digest()
                        out.append((int.from_bytes(digest[:8], "little", signed=True),
                                    int.from_bytes(digest[8:], "little", signed=True), doc, version, starts, k, None))
                size += len(own) * 8
            if size > 1 << 22:
                yield _batch(out, schema)
                out, size = [], 0
        if out:
            yield _batch(out, schema)

    lists = wanted.groupBy(F.col("doc_id").alias("_doc"), F.col("version").alias("_version")).agg(
        F.collect_list(F.struct("gram", "seg", "start", "n", "long_prefix")).alias("wanted"))
    texts = packed(docs).join(lists.hint("merge"), (F.col("doc_id") == F.col("_doc"))
                              & (F.col("version") == F.col("_version"))).select("doc_id", "version", "body", "wanted")
    return texts.mapInArrow(
        run, "gram long, more long, doc_id long, version int, starts array<int>, n int, words binary")


class Subtree:
    """Suffix tree of one prefix's segments, kept as its sorted suffixes and the words that neighbours have in common.

    ``texts`` are words joined by one space; the first ``counts[t]`` suffixes
    of text ``t`` are leaves, each to its text's end.
    """

    def __init__(self, texts: list[bytes], counts: list[int], window: int = WINDOW):
        self.window = window
        # A space after the last word: suffixes that begin with the same words are neighbours, whatever bytes words have.
        self.texts = [text + b" " for text in texts]
        self.ends = [[-1, *(i for i, c in enumerate(text) if c == 32)] for text in self.texts]
        self.leaves = sorted(((t, k) for t, n in enumerate(counts) for k in range(n)), key=self._path)
        self.common = [self._common(a, b) for a, b in zip(self.leaves, self.leaves[1:], strict=False)]

    def _path(self, leaf: tuple[int, int], words: int | None = None) -> bytes:
        t, k = leaf
        ends = self.ends[t]
        return self.texts[t][ends[k] + 1:None if words is None else ends[k + words]]

    def _common(self, a: tuple[int, int], b: tuple[int, int]) -> int:
        """Words at the head of both suffixes, 0 where they are fewer than a window."""
        low = self.window
        if self._path(a, low) != self._path(b, low):
            return 0
        high = min(len(self.ends[t]) - 1 - k for t, k in (a, b))
        while low < high:
            half = (low + high + 1) // 2
            if self._path(a, half) == self._path(b, half):
                low = half
            else:
                high = half - 1
        return low

    def deep_nodes(self) -> Iterator[tuple[int, int, int]]:
        """Internal nodes at least a window deep: (depth in words, first leaf, leaf after the last), inner ones first."""
        path: list[tuple[int, int]] = []  # (depth, first leaf) from the highest node to the lowest
        for at, depth in enumerate([*self.common, 0]):
            first = at
            while path and path[-1][0] > depth:
                deep, first = path.pop()
                yield deep, first, at + 1
            if depth and (not path or path[-1][0] < depth):
                path.append((depth, first))

    def maximal_repeats(self) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """(words, leaves) of every deep node whose occurrences cannot all be extended by one word to the left.

        One that can be is part of the repeat that starts a word before it.
        """
        for depth, a, b in self.deep_nodes():
            leaves = self.leaves[a:b]
            before = {self._path((t, k - 1), 1) if k else None for t, k in leaves}
            if len(before) > 1 or None in before:
                yield depth, leaves


def _subtree_ranges(contents: DataFrame, window: int) -> DataFrame:
    """Contents under their prefixes -> ranges (doc_id, version, start, n) of windows that an earlier document has."""
    def solve(group: list[tuple]) -> Iterator[tuple]:
        docs = [g[0] for g in group]
        late: dict[int, dict[int, int]] = {}  # by text: first window of a repeat -> windows
        for depth, leaves in Subtree([g[4] for g in group], [g[3] for g in group], window).maximal_repeats():
            low = min(docs[t] for t, _ in leaves)
            for t, k in leaves:
                if docs[t] > low:
                    runs = late.setdefault(t, {})
                    runs[k] = max(runs.get(k, 0), depth - window + 1)
        for t, runs in late.items():
            end = 0
            for k in sorted(runs):
                # What an earlier run of this text covers is not given twice.
                first, end = max(k, end), max(end, k + runs[k])
                if first < end:
                    for start in group[t][2]:
                        yield docs[t], group[t][1], start + first, end - first

    schema = pa.schema([("doc_id", pa.int64()), ("version", pa.int32()), ("start", pa.int32()), ("n", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, group = None, []
        for batch in batches:
            rows: list[tuple] = []
            for gram, *content in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if gram != prefix:
                    rows += solve(group) if len(group) > 1 else ()
                    prefix, group = gram, []
                group.append(tuple(content))
            yield _batch(rows, schema)
        if len(group) > 1:
            yield _batch(list(solve(group)), schema)

    return (contents.select("gram", "doc_id", "version", "starts", "n", "words")
            .repartition("gram").sortWithinPartitions("gram", "doc_id")
            .mapInArrow(run, "doc_id long, version int, start int, n int"))


def _versions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, version, text); the version keeps apart different texts under one id."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.hash(text).alias("version"), text.alias("text"))


def repeated_ranges(docs: DataFrame, window: int = WINDOW, gram: int = GRAM,
                    group_contents: int = GROUP_CONTENTS) -> DataFrame:
    """(doc_id, version, text) -> (doc_id, version, start, n): windows that also start in a smaller ``doc_id``."""
    rows = stored(_segment_rows(docs.filter("doc_id IS NOT NULL"), window, gram), "substrings-segments")
    contents = rows.groupBy("gram", "seg", "n").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    groups = contents.groupBy(F.col("gram").alias("_gram")).agg(
        F.count(F.lit(1)).alias("kinds"), F.min("low").alias("first"), F.max("low").alias("last"))
    groups = groups.filter("first < last")
    marked = contents.join(groups.hint("merge"), F.col("gram") == F.col("_gram"), "left").select(
        F.col("gram").alias("_gram"), F.col("seg").alias("_seg"), F.col("n").alias("_n"), "low", "high",
        F.col("kinds").isNotNull().alias("mixed"), F.coalesce(F.col("kinds") > group_contents, F.lit(False))
        .alias("long_prefix")).filter("low < high OR mixed")
    found = stored(rows.join(marked.hint("merge"), (F.col("gram") == F.col("_gram")) & (F.col("seg") == F.col("_seg"))
                             & (F.col("n") == F.col("_n"))).filter("doc_id > low OR mixed").select(
        "doc_id", "version", "gram", "seg", "start", "n", "long_prefix", (F.col("doc_id") > F.col("low")).alias("late")),
        "substrings-marked")
    wanted = stored(_fetch(docs, found.filter("NOT late"), window), "substrings-words")
    trees = _subtree_ranges(wanted.filter("words IS NOT NULL"), window)
    single = wanted.filter("words IS NULL")
    # Written, so that the join below has two plain shuffles, which Spark splits where one passage is in very many contents.
    low = stored(single.groupBy(F.col("gram").alias("_gram"), F.col("more").alias("_more")).agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high"), "substrings-nodes")
    nodes = single.join(low, (F.col("gram") == F.col("_gram")) & (F.col("more") == F.col("_more"))).filter(
        "doc_id > low").select("doc_id", "version", F.explode(F.transform("starts", lambda s: s + F.col("n"))).alias("start"),
                               F.lit(1).alias("n"))
    return found.filter("late").select("doc_id", "version", "start", "n").union(trees).union(nodes)


def kept_words(words: list[bytes], ranges: list[dict] | None, window: int) -> list[bytes]:
    """Words outside all ranges; a range of ``n`` windows covers ``n + window - 1`` words."""
    if not ranges:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    start = np.array([r["start"] for r in ranges])
    np.add.at(edge, start, 1)
    np.add.at(edge, start + np.array([r["n"] for r in ranges]) + window - 1, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def _with_ranges(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc_id, version, body, ranges, other columns) of every row of (doc_id, version, text, other columns)."""
    texts = docs.select("doc_id", "version", "text")
    ranges = stored(repeated_ranges(texts, window, gram), "substrings-ranges").groupBy(
        F.col("doc_id").alias("_doc"), F.col("version").alias("_version")).agg(
        F.collect_list(F.struct("start", "n")).alias("ranges"))
    joined = packed(docs).join(ranges.hint("merge"), (F.col("doc_id") == F.col("_doc"))
                               & (F.col("version") == F.col("_version")), "left")
    return joined.select("doc_id", "version", "body", "ranges", *docs.columns[3:])


def dedup_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                  gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), a row a row; see ``dedup_substrings``."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("kept_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch, row, text in unpacked(batches):
            words = (text or b"").split()
            kept = kept_words(words, batch.column(3)[row].as_py(), window)
            out.append((batch.column(0)[row].as_py(), len(words), len(words) - len(kept),
                        hashlib.sha256(b" ".join(kept)).hexdigest()))
            if len(out) == 4096:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    return _with_ranges(_versions(docs, id_col, text_col), window, gram).mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     gram: int = GRAM) -> DataFrame:
    """``docs`` with each text's words covered by a window that also starts in a document with a smaller id removed.

    Windows are judged on the input, by their words as they are. A text that
    loses words becomes its kept words, joined by one space (``n_chars``,
    where there is such a column, follows); others stay as they are. Null,
    empty and short texts have no windows; a document does not repeat itself,
    nor do repeated rows or different texts under one id; rows with a null id
    stay as they are. An empty table gives an empty result.
    """
    names = docs.columns
    others = [f"c{i}" for i in range(len(names))]
    place = {n: i + 4 for i, n in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 1024) for i in range(0, whole.num_rows, 1024)):
                texts = []
                for part, row, text in unpacked(iter([batch])):
                    ranges = part.column(3)[row].as_py()
                    texts.append(b" ".join(kept_words(text.split(), ranges, window)) if ranges else text)
                text = pa.array([None if t is None else t.decode() for t in texts], pa.string())
                columns = [batch.column(place[n]) for n in names]
                columns[names.index(text_col)] = text
                if "n_chars" in names:
                    at = names.index("n_chars")
                    cut = pc.is_valid(batch.column(3))
                    columns[at] = pc.if_else(cut, pc.utf8_length(text).cast(columns[at].type), columns[at])
                yield pa.RecordBatch.from_arrays(columns, names=names)

    base = docs.toDF(*others)
    text = F.col(others[names.index(text_col)]).cast("string")
    # The text travels once, compressed; its own place is filled in from there.
    rows = base.select(
        F.col(others[names.index(id_col)]).cast("long").alias("doc_id"), F.hash(text).alias("version"),
        text.alias("text"), *[F.lit(None).cast("string").alias(c) if n == text_col else F.col(c)
                              for c, n in zip(others, names, strict=True)])
    return _with_ranges(rows, window, gram).mapInArrow(run, docs.schema)


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_digests(read_table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i, sha256(array_to_string(words[i:i + 49], ' ')) AS k
  FROM docs, unnest(range(1, len(words) - 48)) AS t(i)),
low AS (SELECT k, min(doc_id) AS low FROM windows GROUP BY k),
late AS (SELECT doc_id, i FROM windows JOIN low USING (k) WHERE low < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM late, unnest(range(0, 50)) AS u(j)),
every AS (SELECT doc_id, p, words[p] AS word FROM docs, unnest(range(1, len(words) + 1)) AS t(p)),
kept AS (
  SELECT e.doc_id, count(*) AS n, string_agg(e.word, ' ' ORDER BY e.p) AS text
  FROM every e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.p = g.p GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
