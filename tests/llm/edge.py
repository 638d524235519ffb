"""Small tables with every awkward case: nulls, blanks, long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random
import re

SF_SMALL, SF_CHECK = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Extra columns whose names the operators use themselves.
CLASHES = ("size", "target", "version", "bits", "score", "kept", "words", "range", "n", "row")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def texts(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """(doc_id, text); ids are unique but for repeated rows and nulls."""
    rng = random.Random(seed)
    base = prose(rng, 300)
    passage = prose(rng, 70)
    near = base.split(" ")
    near[150] = "changed"
    rows = [
        (1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n\r\x0b\x0c"), (7, "one"),
        (8, "Two Words"), (9, "a b c"), (10, "été   naïve 漢字 \x85 \U0001f600"),
        (11, prose(rng, 90) + " " + passage + " " + prose(rng, 40)), (12, prose(rng, 20) + "\n" + passage),
        (13, passage + "\t" + prose(rng, 30)), (14, "x" * 100_000), (15, prose(rng, 30_000)),
        (16, "spam " * 500), (17, "\n".join(["the same line of words here"] * 40)), (18, base.upper()),
        (19, "bad### words*** here&&& " * 30), (20, prose(rng, 50)), (21, "  " + prose(rng, 49) + "  "),
        (22, prose(rng, 120)), (22, rows_same := prose(rng, 80)), (22, rows_same), (None, base), (None, None),
    ]
    return rows


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"{c} string" for c in CLASHES)
    sources = ["a", "b", "\U00010000", "￿", "Z", None]
    full = [(i, t, None if k % 5 == 0 else "en", sources[k % len(sources)], None if t is None else len(t),
             *[None if k % 3 else c for c in CLASHES]) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, schema).repartition(3)


def find_all(n: int, links) -> list[int]:
    """Smallest index reachable from each of ``n`` over the links."""
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        p, q = find(a), find(b)
        parent[max(p, q)] = min(p, q)
    return [find(i) for i in range(n)]
