"""Vectorised words of a batch of texts: spans and 64-bit hashes, straight from Arrow buffers.

A word's hash is a polynomial over its bytes modulo 2**64, finished by a
64-bit mixer: equal words have equal hashes everywhere, and distinct ones
differ but for chance (about 1 in 10**19 for a pair).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# --- fixed values -----------------------------------------------------------
SPACES = (9, 10, 11, 12, 13, 32)
BASE = 0x9E3779B97F4A7C15  # odd: has an inverse modulo 2**64
MIX_1, MIX_2 = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53  # public 64-bit finaliser
# ----------------------------------------------------------------------------
CHUNK = 1 << 20  # bytes hashed at once
SLICE_BYTES = 2 << 20  # bytes of text taken from a batch at once


@dataclass
class Words:
    """Words of some texts: word ``i`` is ``data[starts[i]:ends[i]]``; text ``d`` has words ``first[d]:first[d + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    offsets: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(MIX_1)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(MIX_2)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse, i below ``n``, modulo 2**64."""
    out = []
    for b in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.full(n, b, dtype=np.uint64)
        p[:1] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Consecutive parts of a batch with about ``limit`` bytes of text each (a longer text is a part of its own)."""
    i = batch.schema.get_field_index(column)
    sizes = np.asarray(pc.binary_length(batch.column(i)).fill_null(0), dtype=np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def split_words(texts: pa.Array, lower: bool = False) -> Words:
    """Spans of the words of every text (null: none)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[off[0]:off[-1]] if raw is not None else np.zeros(0, np.uint8)
    off = off - off[0]
    word_byte = np.ones(256, dtype=bool)
    word_byte[list(SPACES)] = False
    inside = word_byte[data]
    n = len(data)
    before = np.zeros(n + 1, dtype=bool)  # before[i]: the byte before i belongs to the same text's word
    before[1:] = inside
    before[off] = False
    after = np.zeros(n + 1, dtype=bool)
    after[:n] = inside
    after[off] = False
    starts = np.flatnonzero(inside & ~before[:n])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    if lower:
        table = np.arange(256, dtype=np.uint8)
        table[65:91] += 32
        data = table[data]
    return Words(data, starts, ends, np.searchsorted(starts, off), off)


def hash_words(w: Words) -> np.ndarray:
    """64-bit hash of every word."""
    out = np.empty(len(w.starts), dtype=np.uint64)
    p, q = powers(CHUNK)
    at = 0
    while at < len(out):
        base = int(w.starts[at])
        to = max(at + 1, int(np.searchsorted(w.ends, base + CHUNK, side="right")))
        s, e = w.starts[at:to] - base, w.ends[at:to] - base
        size = int(e[-1])
        if size > len(p):
            p, q = powers(size)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum((w.data[base:base + size].astype(np.uint64) + np.uint64(1)) * p[:size], out=sums[1:])
        out[at:to] = mix((sums[e] - sums[s]) * q[s])
        at = to
    return out


def hash_grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` word hashes (one value a start; shorter inputs give none)."""
    if len(h) < n:
        return np.zeros(0, dtype=np.uint64)
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out = out * np.uint64(BASE) + h[k: len(h) - n + 1 + k]
    return mix(out)
