from __future__ import annotations

import importlib
import sys
from collections import Counter, defaultdict

import corpus_pipeline
import edge
import test_mixing
import test_simhash
import test_substrings
from edge import SF_CHECK

import __spark_entry__
from vigil.llm import packing, toxicity
from vigil.llm.common import read_table, stored

LAST = "pack"


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "substrings", "mix", LAST]


def test_each_stage_matches_brute_force_on_what_it_was_given(spark, monkeypatch):
    docs = read_table(spark, SF_CHECK, "documents").filter("doc_id < 400")  # a fixture: brute force is quadratic
    docs = stored(docs, "test-pipeline")
    stages = dict(corpus_pipeline.STAGES)
    kept = {}
    now = docs
    for name, _ in corpus_pipeline.STAGES:
        given = now.collect()
        now = stored(stages[name](spark, now, SF_CHECK), f"test-{name}")
        kept[name] = now.collect()
        assert name == LAST or now.schema == docs.schema
        if name == "toxicity":
            model = toxicity.train_on_tables(docs, read_table(spark, SF_CHECK, "labels"))
            reject = {r.doc_id for r in toxicity.score_toxicity(docs, model).collect() if r.predicted}
            assert Counter(kept[name]) == Counter(r for r in given if r.doc_id not in reject)
        if name == "near_duplicates":
            _, roots = test_simhash.brute([(r.doc_id, r.text) for r in given])
            assert Counter(kept[name]) == Counter(r for r, root in zip(given, roots, strict=True) if r.doc_id == root)
        if name == "substrings":
            want = {i: " ".join(w) for i, _, w in test_substrings.brute([(r.doc_id, r.text) for r in given])}
            assert {r.doc_id: " ".join(edge.words(r.text)) for r in kept[name]} == want
            assert len(kept[name]) == len(given)
        if name == "mix":
            planned = test_mixing.expected([(r.doc_id, r.source, r.text) for r in given])
            taken = Counter()
            for r in kept[name]:
                taken[r.doc_id] += len(edge.words(r.text))
            assert taken == Counter({doc: t for doc, _, _, _, t in planned if t})
        if name == LAST:
            enc = packing.Encoder(__import__("public_tokenizers").path("byte_bpe_50k.json"))
            sizes = Counter()
            for r in kept[name]:
                sizes[r.doc_id] += r.length
            want = Counter()
            for r in given:
                want[r.doc_id] += len(enc.ids(r.text)) + 1
            assert sizes == want
            held = defaultdict(int)
            for r in kept[name]:
                held[r.sequence_id] += r.length
            assert max(held.values()) <= 1024 and len(held) <= 1.05 * sum(held.values()) / 1024 + 1


def test_run_applies_all_stages(spark):
    got = corpus_pipeline.run(spark, edge.SF_SMALL)
    assert {"doc_id", "piece", "length", "sequence_id", "offset"} <= set(got.columns)
    assert got.count() > 0


def test_an_empty_table_gives_no_rows(spark, tmp_path):
    for name in ("documents", "labels"):
        read_table(spark, edge.SF_SMALL, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_entry_registers_the_queries():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_entry_without_the_subpackage(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)  # as if it were not there
    try:
        entry = importlib.reload(__spark_entry__)
        assert entry.queries() and not [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    finally:
        monkeypatch.undo()
        importlib.reload(__spark_entry__)


