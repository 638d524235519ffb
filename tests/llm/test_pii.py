from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import edge
import pytest
from edge import SF_SMALL

from vigil.llm import pii

SCHEMA = "doc_id long, text string"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base(text: str | None) -> list[tuple[int, int, int]]:
    """The base patterns as they are written down."""
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    kinds = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, (pattern, ok) in enumerate(kinds) for m in re.finditer(pattern, text) if ok(m)]


def spans(text: str | None) -> str:
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base(text))


def test_base_patterns_match_the_plain_ones():
    rng = random.Random(3)
    parts = ["a", "Z", "9", "0", "255", "256", ".", ".", "@", "@", "-", "+", "%", "_", " ", " ", "(", ")", "é", "\n", "4111 1111 1111 1111",
             "4012888888881881", "1.2.3.4", "x@y.z", "+1 (279) 555-0024", "00192.168.0.1"]
    for _ in range(4_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == base(text), text


def test_long_texts_take_linear_time():
    for text in ("x" * 300_000, "x" * 300_000 + "@", "1" * 300_000, "1 " * 150_000, "+1" + " " * 300_000, "a@" * 150_000,
                 "1.1.1 " * 50_000, "a.b@c " * 50_000, "(" * 300_000 + "1", "é1" * 100_000):
        found = pii.base_spans(text)
        list(pii.open_spans(text, found))


def simulate(rows) -> dict[str, int]:
    """The accepted identifiers, by dictionaries in place of joins."""
    edges = set()
    for _, text in rows:
        seeds = pii.base_spans(text or "")
        mentions = [(k, a, b) for k, a, b in seeds] + [(None, a, b) for a, b in pii.open_spans(text or "", seeds)]
        for k, a, b in mentions:
            forms = tuple(f for f in range(4) if k is None and pii.FORMS[f].fullmatch(text[a:b]))
            for c in pii.contexts(text, a, b):
                edges.add((c, pii.mention_key(text[a:b]), k, forms))
    slots = defaultdict(list)
    for c, key, k, forms in edges:
        slots[c].append((key, k, forms))
    scores: dict[tuple[str, int], float] = {}
    for _ in range(pii.MAX_ROUNDS):
        new: dict[tuple[str, int], float] = {}
        for held in slots.values():
            for kind in range(4):
                seeds = sum(k == kind for _, k, _ in held)
                fitting = [key for key, k, forms in held if k is None and kind in forms]
                if seeds < pii.MIN_SUPPORT:
                    continue
                found = sum(scores.get((key, kind), 0.0) for key in fitting)
                misses = len(held) - seeds - len(fitting)
                share = (seeds + found) / (seeds + found + misses + pii.OPEN_WEIGHT * (len(fitting) - found) + pii.PRIOR)
                if share >= pii.PROMOTE:
                    for key in fitting:
                        new[key, kind] = max(new.get((key, kind), 0), share)
        if {k: round(v, 6) for k, v in new.items()} == {k: round(v, 6) for k, v in scores.items()}:
            break
        scores = new
    out: dict[str, tuple[float, int]] = {}
    for (key, kind), score in scores.items():
        if score >= pii.ACCEPT:
            out[key] = max(out.get(key, (0.0, 0)), (score, -kind))
    return {key: -kind for key, (_, kind) in out.items()}


def planted(seed: int = 2):
    rng = random.Random(seed)
    rows, n = [], 0

    def add(text):
        nonlocal n
        rows.append((n, f"{edge.prose(rng, 5)} {text} {edge.prose(rng, 5)}"))
        n += 1

    for i in range(12):
        add(f"you can ring me at +44 20 7946 0{i:03d} before noon")
        add(f"host address is 10.0.{i}.7 in the log")
        add(f"order number {rng.randrange(10 ** 9)} shipped")
    for i in range(5):
        add(f"you can ring me at 020 7946 1{i:03d} before noon")  # no plus sign: open
        add(f"host address is 10.0.{i}.900 in the log")  # a part above 255: open
    add("a note with 020 7946 1003 in other words")  # a discovered one in an unseen context
    rows += [(n + 1, rows[0][1])] * 40 + [(None, None), (n + 2, ""), (n + 3, " \n")]
    return rows


def test_contexts_discover_unseen_identifiers(spark):
    rows = planted()
    got = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    for doc, text in rows:
        added = {text[s.start:s.end] for s in got[doc].spans if s not in got[doc].base}
        if text and ("020 7946 1" in text):
            assert added == {re.search(r"020 7946 1\d{3}", text)[0]}
        elif text and ".900" in text:
            assert added == {re.search(r"10\.0\.\d\.900", text)[0]}
        else:
            assert not added, text


def test_graph_scores_match_a_simulation(spark):
    rng = random.Random(8)
    rows = planted(4)
    for i in range(250):  # contexts that are shared by kinds, forms and open numbers at random
        a, b = rng.choice("abcdef"), rng.choice("uvw")
        what = rng.choice([f"+1 555 000 {rng.randrange(60):04d}", f"9.8.7.{rng.randrange(50)}", f"m{rng.randrange(40)}@x.org",
                           f"555 000 {rng.randrange(60):04d}", f"9.8.7.{300 + rng.randrange(20)}", f"id{rng.randrange(10 ** 5)}"])
        rows.append((10_000 + i, f"{a} {b} {what} {rng.choice('xyz')}"))
    accepted = simulate(rows)
    assert accepted
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = Counter((r.doc_id, tuple(tuple(s) for s in r.spans)) for r in pii.find_personal_data(table).collect())
    want = Counter()
    for doc, text in rows:
        held = pii.base_spans(text or "")
        more = [(accepted[key], a, b) for a, b in pii.open_spans(text or "", held)
                if (key := pii.mention_key(text[a:b])) in accepted]
        want[doc, tuple(sorted(held + more))] += 1
    assert got == want


def test_edge_table_and_empty_table(spark):
    docs = edge.documents(spark, [*edge.texts(), (50, "mail A.B@c-d.example.org, or 1.2.3.4!")])
    got = Counter((r.doc_id, pii_text(r.base)) for r in pii.find_personal_data(docs).collect())
    assert got == Counter((r.doc_id, spans(r.text)) for r in docs.collect())
    assert pii.find_personal_data(edge.documents(spark, [])).count() == 0


def pii_text(found) -> str:
    return ",".join(f"{pii.KINDS[s.kind]}:{s.start}:{s.end}" for s in found)


@pytest.mark.parametrize("sf", [SF_SMALL])
def test_query_base_columns(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = pii.op11_pii(spark, sf).collect()
    assert Counter(r.doc_id for r in rows) == Counter(docs.keys())
    for r in rows:
        want = base(docs[r.doc_id])
        counts = [sum(k == j for k, _, _ in want) for j in range(4)]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        assert r.base_sha256 == hashlib.sha256(spans(docs[r.doc_id]).encode()).hexdigest()
        assert set(filter(None, spans(docs[r.doc_id]).split(","))) <= set(filter(None, r.spans.split(",")))
