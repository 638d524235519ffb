from __future__ import annotations

import random
import zlib
from collections import defaultdict

import edge
import numpy as np
import public_tokenizers
import pytest
from edge import SF_SMALL
from tokenizers import Tokenizer

from vigil.llm import packing
from vigil.llm.common import read_table

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(PATH)


def test_ids_are_the_tokenizers(encoder, reference):
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "B", "é", "12", "!", "'s", "don't", "\x00", "\x1c", "\x85", "\u00a0", "漢",
             "<|endoftext|>", "\r\n", "\u200b", "\u2028", "\U0001f600", " the", "..."]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert encoder.ids(text).tolist() == reference(text), repr(text)


def test_added_tokens_are_one_id_as_the_tokenizer_takes_them(spark, encoder):
    default = Tokenizer.from_file(PATH)
    ids = lambda text: default.encode(text, add_special_tokens=False).ids
    assert ids("a <|endoftext|> b") == [64, 220, 50256, 275]
    rng = random.Random(2)
    parts = [" ", "\n", "a", "é", "12", " the", "<|endoftext|>", "<|endoftext", "|>", "<|", "<|ENDOFTEXT|>", "  ", "\t"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(2000)]
    for text in texts:
        assert encoder.document_ids(text).tolist() == ids(text), repr(text)
    rows = [(i, t) for i, t in enumerate(["a <|endoftext|> b", "<|endoftext|>" * 1500, "x", *texts[:50]])]
    check_pieces(packing.pack_documents(edge.documents(spark, rows)).collect(), rows, ids)


def check_sequences(rows, capacity=1024):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def check_pieces(rows, texts, reference):
    """Every row of ``texts`` comes back whole, as pieces of at most 1024 ids of which only the first may be short."""
    want = defaultdict(int)
    for doc, text in texts:
        ids = reference(text) + [2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[(doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    got = defaultdict(int)
    for r in rows:
        got[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
    assert got == want


def test_edge_table(spark, reference):
    rows = packing.pack_documents(edge.documents(spark)).collect()
    check_pieces(rows, edge.texts(), reference)
    check_sequences(rows)
    assert packing.pack_documents(edge.documents(spark, [])).count() == 0


def test_whole_table_in_few_sequences(spark, reference):
    rows = packing.op5_pack(spark, SF_SMALL).collect()
    texts = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").collect()]
    check_pieces(rows, texts, reference)
    least = -(-sum(r.length for r in rows) // 1024)
    assert check_sequences(rows) <= 1.02 * least + 1


def test_reruns_agree_and_ids_round_trip(spark, reference):
    pieces = packing.stored(packing.tokenised_pieces(edge.documents(spark), with_ids=True), "test-pieces")
    one, two = (
        sorted(map(tuple, packing.pack(pieces, pieces_per_task=7).collect()), key=repr) for _ in range(2))
    assert one == two
    by_doc = {i: t for i, t in edge.texts() if i not in (None, 22)}
    back = defaultdict(dict)
    for r in pieces.collect():
        back[r.doc_id][r.piece] = np.frombuffer(r.ids, "<u4").tolist()
    for doc, text in by_doc.items():
        assert sum((back[doc][k] for k in sorted(back[doc])), []) == reference(text) + [2]


def test_full_pieces_close_no_bin(spark):
    """With any number of full pieces between them, the rests need as many sequences as without."""
    rests = [(i, 0, 0, n, 0) for i, n in enumerate(([700] * 40 + [324] * 40))]
    full = [(1000 + i, 0, 0, 1024, 0) for i in range(400)]

    def sequences(rows):
        df = spark.createDataFrame(rows, packing.PIECE_SCHEMA).coalesce(1)
        out = packing.pack(df, open_bins=1).collect()
        assert sorted(r[:5] for r in map(tuple, out)) == sorted(rows)
        return check_sequences(out)

    assert sequences(rests + full) == sequences(rests) + len(full)


def test_best_fit_takes_the_fullest_bin_that_fits_and_closes_the_fullest():
    p = packing.BestFit(10, 2)
    assert [p.place(n) for n in (6, 7)] == [(0, 0), (1, 0)]
    assert p.place(3) == (1, 7)  # exactly fits the fuller bin, which is then full
    assert p.place(4) == (0, 6)
    assert [p.place(n) for n in (9, 5)] == [(2, 0), (3, 0)]
    assert p.place(8) == (4, 0)  # both are open and too full: the one with 9 closes
    assert p.place(1) == (4, 8)
    assert p.place(5) == (3, 5)


def test_best_fit_matches_a_plain_search():
    rng = random.Random(3)
    for _ in range(50):
        p, free, made = packing.BestFit(32, 5), {}, 0
        for n in (rng.randint(1, 32) for _ in range(200)):
            fits = [f for f in free.values() if f >= n]
            number, offset = p.place(n)
            if fits:
                assert free[number] == min(fits) and offset == 32 - free[number]
            else:
                if len(free) == 5:
                    tight = min(free.values())
                    closed = [b for b, f in free.items() if f == tight][-1]
                    open_now = {b for held in p.free for b in held} | {number}
                    closed = next(iter(set(free) - open_now), closed)
                    assert free.pop(closed) == tight
                assert (number, offset) == (made, 0)
                made += 1
                free[number] = 32
            free[number] -= n
            if not free[number]:
                del free[number]
