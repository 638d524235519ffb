from __future__ import annotations

import random
from collections import defaultdict

from edge import SF_SMALL
from oracle import compare, duck

from vigil.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, size string, range int, name string, position int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, None, 2) for r in rows], SCHEMA).repartition(3)


def brute(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn or 0, role or "unknown", text or "", turn))
    out = []
    for conv, turns in talks.items():
        for person in {r for _, _, r, _, _ in turns} - {"system"}:
            at = 0
            for place, (_, _, role, text, turn) in enumerate(sorted(turns, key=lambda t: t[:4])):
                kind = "assistant" if role == person else "system" if role == "system" else "user"
                head = f"<|{'user:' + role if kind == 'user' else kind}|>\n"
                shown = head + text + "<|end|>\n"
                mask = (at + len(head), at + len(shown)) if kind == "assistant" else (None, None)
                out.append((conv, person, turn, place, kind, role, shown, at, at + len(shown), *mask))
                at += len(shown)
    return sorted(out, key=repr)


def run(spark, rows):
    return sorted((tuple(r) for r in chat.rotate(frame(spark, rows)).collect()), key=repr)


def conversations():
    rng = random.Random(1)
    rows = [(1, t, rng.choice(["ann", "bob", "eve", "system"]), f"turn {t} é漢") for t in range(700)]  # many ranges
    rows += [(2, 0, "system", "rules"), (2, 1, "user", "hi"), (2, 2, "assistant", "hello")]
    rows += [(3, 0, "system", "nobody speaks")]
    rows += [(4, 0, "user", None), (4, 0, "user", None), (4, 0, "assistant", ""), (4, None, "user", "no turn"),
             (4, 1, None, "who?"), (4, -3, "user", "early"), (4, 10 ** 12, "user", "x" * 50_000)]
    rows += [(None, 0, "user", "lost"), (None, 1, "assistant", "also lost")]
    return rows


def test_matches_brute_force(spark):
    rows = conversations()
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_spans_and_masks_point_into_the_rendered_dialogue(spark):
    talks = defaultdict(list)
    for r in chat.rotate(frame(spark, conversations())).collect():
        talks[(r.conv_id, r.perspective)].append(r)
    for rows in talks.values():
        whole = "".join(r.rendered for r in sorted(rows, key=lambda r: r.position))
        for r in rows:
            assert whole[r.char_start:r.char_end] == r.rendered
            if r.loss_start is not None:
                assert whole[r.loss_start:r.loss_end] == r.rendered.split("\n", 1)[1]
                assert r.name == r.perspective


def test_many_turns_with_one_number_or_none(spark):
    rows = [(1, 7, "ab"[i % 2], f"text {i}") for i in range(3000)] + [(1, None, "a", f"lost {i % 5}") for i in range(500)]
    assert run(spark, rows) == brute(rows)


def test_query_matches_its_sql(spark):
    ok, message = compare(chat.op4_rotate(spark, SF_SMALL), duck(SF_SMALL), chat.ORACLE)
    assert ok, message
