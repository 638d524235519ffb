from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import edge
from edge import SF_SMALL
from oracle import compare, duck
from pyspark.sql import functions as F

from vigil.llm import mixing
from vigil.llm.common import word_count


def targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Resharing round by round, as the rule says it."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    order += [None] if None in sizes else []
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    out, left, free = {}, float(sum(sizes.values())), set(order)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= 3 * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def expected(rows):
    sizes = defaultdict(int)
    for _, source, text in rows:
        sizes[source] += len(edge.words(text))
    goal = targets(sizes)
    by_source = defaultdict(list)
    for doc, source, text in rows:
        tie = hashlib.md5((text or "").encode()).hexdigest()
        key = hashlib.md5(f"{mixing.SEED}:{'' if doc is None else doc}:{tie}".encode()).hexdigest()
        by_source[source].append((key, doc if doc is not None else -1, len(edge.words(text)), doc))
    out = Counter()
    for source, docs in by_source.items():
        total, before = sizes[source], 0
        for _, _, size, doc in sorted(docs):
            budget = int(goal[source] + 1e-9)
            epochs = budget // total if total else 0
            taken = epochs * size + max(0, min(size, budget - epochs * total - before))
            out[(doc, size, total, round(goal[source], 6), taken)] += 1
            before += size
    return out


def plan(spark, docs):
    got = mixing.plan_mix(docs, word_count(F.col("text")), mixing.content_tie(F.col("text"))).collect()
    return Counter((r.doc_id, r.mix_size, r.mix_source_size, round(r.mix_target, 6), r.mix_taken) for r in got)


def test_edge_table_matches_brute_force(spark):
    docs = edge.documents(spark)
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    assert plan(spark, docs) == expected(rows)
    assert plan(spark, edge.documents(spark, [])) == Counter()


def test_mix_holds_the_planned_words(spark):
    docs = edge.documents(spark)
    planned = Counter()
    for (doc, _, _, _, taken), k in plan(spark, docs).items():
        planned[doc] += taken * k
    mix = mixing.mix_documents(docs)
    assert mix.columns == docs.columns
    taken = Counter()
    texts = defaultdict(list)
    for r in mix.collect():
        taken[r.doc_id] += len(edge.words(r.text))
        assert r.n_chars == len(r.text)
        texts[r.doc_id].append(r.text)
    assert taken == Counter({k: v for k, v in planned.items() if v})
    whole = {t for _, t in edge.texts()}
    cut = [t for held in texts.values() for t in held if t not in whole]
    assert len(cut) <= 6  # one a source
    assert all(any(" ".join(edge.words(x)).startswith(t) for x in whole if x) for t in cut)


def test_columns_named_like_those_at_work_come_through(spark):
    names = ("_text", "mix_size", "mix_taken", "_part", "_take", "row", "size", "source_size", "target", "taken", "key", "of",
             "part", "range", "start", "before", "head", "take", "id", "a.b")
    rows = [(i, f"w{i} " * 30, "ab"[i % 2], *[f"{n}{i}" for n in names]) for i in range(40)]
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, schema)
    got = mixing.mix_documents(docs)
    assert got.columns == docs.columns
    extra = {r[0]: r[3:] for r in rows}
    assert all(tuple(r)[3:] == extra[r.doc_id] for r in got.collect())


def test_null_ids_are_spread_over_many_ranges(spark):
    docs = spark.createDataFrame([(None, f"text {i}", "s") for i in range(3000)], "doc_id long, text string, source string")
    key = F.md5(F.concat_ws(":", F.lit(mixing.SEED), F.lit(""), mixing.content_tie(F.col("text"))))
    largest = docs.groupBy(F.substring(key, 1, mixing.KEY_DIGITS)).count().agg(F.max("count")).first()[0]
    assert largest < 15
    assert sum(r.mix_taken for r in mixing.plan_mix(docs, word_count(F.col("text")), mixing.content_tie(
        F.col("text"))).collect()) == 6000


def test_targets_stop_and_reshare(spark):
    rng = random.Random(7)
    for _ in range(8):
        sizes = {f"s{i:02d}": rng.choice([0, 1, 5, 100, 10_000, 10 ** 7]) for i in range(rng.randint(1, 9))}
        sizes[None] = rng.choice([0, 50])
        table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(table).collect()}
        want = targets(sizes)
        assert got.keys() == want.keys()
        assert all(abs(got[s] - want[s]) <= 1e-6 * max(1, want[s]) for s in want)


def test_query_matches_its_sql(spark):
    ok, message = compare(mixing.op10_mix(spark, SF_SMALL), duck(SF_SMALL), mixing.ORACLE)
    assert ok, message
