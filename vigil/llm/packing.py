"""Best-fit packing of tokenised documents into fixed-length sequences.

A task packs its documents online with a fixed number of open bins. The bins
are kept by free space in a bitset (bit ``f`` set: some open bin has ``f``
tokens free), so the best fit for a piece of ``n`` tokens is the lowest set
bit from ``n`` up. When all bins are open and none fits, the fullest closes.
"""

from __future__ import annotations

import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, stored
from .words import slices

CAPACITY = 1024
END_ID = 2
OPEN_BINS = 4096
PIECES_PER_TASK = 1_000_000
CACHED_WORDS = 200_000  # words whose ids a worker remembers (a limit on its memory, not on what is tokenised)

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"


class BestFit:
    """Bounded-space online best fit; ``place`` gives (bin number, offset)."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = 0
        self.open = 0
        self.made = 0

    def place(self, n: int) -> tuple[int, int]:
        fits = self.bits >> n
        if fits:
            space = n + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            if self.open == self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            space, number = self.capacity, self.made
            self.made += 1
        left = space - n
        if left:
            self.free[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.capacity - space

    def whole(self, count: int) -> np.ndarray:
        """Numbers of ``count`` bins that a piece each fills; the open bins stay as they are."""
        self.made += count
        return np.arange(self.made - count, self.made)

    def _take(self, space: int) -> int:
        held = self.free[space]
        number = held.pop()
        if not held:
            self.bits &= ~(1 << space)
        self.open -= 1
        return number


class Encoder:
    """Ids of a byte-level BPE vocabulary file, each word's remembered.

    A text is cut before every single space that stands between two
    characters other than white space; the vocabulary's own splitting rule
    always cuts there, so the ids of the parts are the ids of the text.
    Texts with other runs of white space go whole through the tokenizer.

    tiktoken stands in for ``tokenizers`` (the ids are the same, tested), and
    knows no added tokens: ``ids`` takes a text that spells one as plain text,
    ``document_ids`` cuts texts at them first, as ``tokenizers`` does.
    """

    def __init__(self, path: str):
        import json

        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        vocab, added = content["model"]["vocab"], content.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added) or content.get("normalizer"):
            raise ValueError(f"{path}: added tokens that match by more than their spelling are not supported")
        # The public byte-to-character map of byte-level BPE vocabularies: printable bytes stand for
        # themselves, the others for the characters from 256 up.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        to_byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(to_byte[c] for c in t): i for t, i in vocab.items() if all(c in to_byte for c in t)}
        self.added = {t["content"]: np.array([t["id"]], np.uint32) for t in added}
        for token in self.added:
            ranks.pop(token.encode(), None)
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cuts = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        self.encode = tiktoken.Encoding(
            "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[str, bytes] = {}

    def document_ids(self, text: str) -> np.ndarray:
        """The text's ids as unsigned 32-bit numbers, added tokens that it spells being one id each."""
        if not any(token in text for token in self.added):
            return self.ids(text)
        parts = self.cuts.split(text)  # every other one is an added token
        return np.concatenate([self.added[p] if i % 2 else self.ids(p) for i, p in enumerate(parts)])

    def ids(self, text: str) -> np.ndarray:
        """The ids of plain text as unsigned 32-bit numbers."""
        if not text:
            return np.zeros(0, np.uint32)
        known, encode = self.known, self.encode
        out = []
        parts = text.split(" ")
        for i, part in enumerate(parts):
            got = known.get(part) if i else None
            if got is None:
                if not part or part[0].isspace() or part[-1].isspace() or not part.isprintable() and _odd(part):
                    return np.array(encode(text), np.uint32)
                got = np.array(encode(" " + part if i else part), np.uint32).tobytes()
                if i and len(part) < 40 and len(known) < CACHED_WORDS:
                    known[part] = got
            out.append(got)
        return np.frombuffer(b"".join(out), np.uint32)


def _odd(part: str) -> bool:
    """Whether a part holds white space or control characters other than line feeds between other characters."""
    return any(not c.isprintable() and c != "\n" for c in part)


def encoder(path: str) -> Encoder:
    """One encoder a process, kept across tasks."""
    store = sys.modules.setdefault("_packing_encoders", types.ModuleType("_packing_encoders"))
    if not hasattr(store, "by_path"):
        store.by_path = {}
    if path not in store.by_path:
        store.by_path[path] = Encoder(path)
    return store.by_path[path]


def piece_lengths(n: int, capacity: int) -> list[int]:
    """A document of ``n`` tokens is whole up to ``capacity``; a longer one gives a first rest, then full pieces."""
    first = n % capacity or capacity
    return [first] + [capacity] * ((n - first) // capacity)


def tokenised_pieces(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID,
                     capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """Pieces of every document: ids of the whole text, the end id, cut only where longer than ``capacity``.

    The vocabulary's added tokens are one id each where a text spells them. A null or empty text is just the end id. With ``with_ids`` a column
    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path("byte_bpe_50k.json")
        enc = encoder(path)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for part in slices(batch, "text"):
                cols: list[list] = [[] for _ in range(5 + with_ids)]
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.concatenate([enc.document_ids(text or ""), end])
                    at = 0
                    for k, n in enumerate(piece_lengths(len(ids), capacity)):
                        own = ids[at:at + n].tobytes()
                        for c, v in zip(cols, (doc, k, at, n, zlib.crc32(own), own), strict=False):
                            c.append(v)
                        at += n
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, kinds, strict=False)], names=names[: len(cols)])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(pieces, PIECE_SCHEMA + (", ids binary" if with_ids else ""))


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         pieces_per_task: int = PIECES_PER_TASK) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to every row of ``pieces`` (which is read twice: store it first).

    The pieces are dealt at random (by a hash of the document) over as many
    tasks as hold about ``pieces_per_task`` each, and come to the packer in
    that hash's order (its ties broken by all fields used), so a repeated task gives the same bins. Pieces of full
    length are sequences of their own. Other columns pass through.
    """
    schema = pieces.schema
    names = [f.name for f in schema.fields]
    at = names.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        packer = BestFit(capacity, open_bins)
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column(at).to_numpy()
            seq, off = np.empty((2, len(length)), np.int64)
            full, rests = np.flatnonzero(length == capacity), np.flatnonzero(length != capacity)
            seq[full], off[full] = packer.whole(len(full)), 0
            for low in range(0, len(rests), open_bins):  # of the rests at hand, the longest first
                part = rests[low:low + open_bins]
                for i in part[np.argsort(-length[part], kind="stable")].tolist():
                    seq[i], off[i] = packer.place(int(length[i]))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(names))],
                 pa.array(seq + base), pa.array(off)],
                names=[*names, "sequence_id", "offset"])

    tasks = max(1, -(-pieces.count() // pieces_per_task))
    deal = F.xxhash64("doc_id", "piece")
    out = schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    return (pieces.repartition(tasks, deal).sortWithinPartitions(deal, "doc_id", "piece", "start", "length", "ids_crc32")
            .mapInArrow(run, f"{out}, sequence_id long, offset long"))


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """Tokenises and packs every document; see ``op5_pack`` for the columns.

    Null and empty texts are one end id; repeated rows are packed once each;
    an empty table gives an empty result; other input columns are ignored.
    """
    return pack(stored(tokenised_pieces(docs, **options), "packing-pieces"))


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
