from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import edge
from edge import SF_SMALL
from oracle import compare, duck
from pyspark.sql import functions as F

from vigil.llm import merkle

EMPTY = "doc_id long, text string, lang string, source string, n_chars long"


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row: dict, text: str | None) -> str:
    out = ""
    for name in merkle.FIELDS:
        value = text if name == "text" else row[name]
        out += "-" if value is None else f"{len(str(value).encode())}:{value}"
    return h(out)


def climb(nodes: list[str]) -> list[list[str]]:
    """All levels, the nodes themselves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i:i + 8])) for i in range(0, len(last), 8)])
    return levels


def walk(levels: list[list[str]], place: int, value: str) -> tuple[str, str]:
    """The siblings on the way up, and what ``value`` folds to."""
    proof = ""
    for nodes in levels[:-1]:
        first = place - place % 8
        left, right = nodes[first:place], nodes[place + 1:first + 8]
        proof += "".join(left + right)
        value = h("".join(left) + value + "".join(right))
        place //= 8
    return proof, value


def expected(rows: list[dict]) -> Counter:
    by_lang: dict = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append(r)
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        by_lang[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[lang] = climb([leaf(r, r["text"]) for r in by_lang[lang]])
    top = climb([trees[x][-1][0] for x in order])
    root = top[-1][0]
    out = Counter()
    for k, lang in enumerate(order):
        for place, r in enumerate(by_lang[lang]):
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None:
                text = edge.lower(text)
            proof, folded = walk(trees[lang], place, leaf(r, text))
            more, folded = walk(top, k, folded)
            out[(r["doc_id"], leaf(r, r["text"]), trees[lang][-1][0], root, h(proof + more), folded, folded == root)] += 1
    return out


def audited(docs) -> Counter:
    text = F.when(merkle.tampered(F.col("doc_id")), merkle.ascii_lower(F.col("text"))).otherwise(F.col("text"))
    got = merkle.audit(docs, {"text": text}).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return Counter(tuple(r) for r in got.collect())


def test_edge_table_matches_brute_force(spark):
    docs = edge.documents(spark)  # null and repeated ids, null languages, clashing names
    assert audited(docs) == expected([r.asDict() for r in docs.collect()])


def test_many_groups_lone_leaves_and_repeated_rows(spark):
    rows = [(i, f"Text {i}", f"l{i % 11:02d}", "s", i) for i in range(700)]
    rows += [(9_000, "Alone", "z", "s", 1), (9_001, None, None, None, None), (9_002, "", "", "", 0)]
    rows += [(5, "Again", "l00", "s", 5)] * 300  # a run of equal leaves, with equal inner nodes
    docs = spark.createDataFrame(rows, EMPTY).repartition(7)
    assert audited(docs) == expected([r.asDict() for r in docs.collect()])


def test_empty_table_and_a_single_row(spark):
    assert audited(spark.createDataFrame([], EMPTY)) == Counter()
    one = spark.createDataFrame([(1, "A", "en", "s", 1)], EMPTY)
    assert audited(one) == expected([r.asDict() for r in one.collect()])


def test_records_are_content_addressed(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "en", "s", i) for i in range(100)], EMPTY)
    leaves = docs.select(F.col("doc_id").alias("id"), merkle.group_key(F.col("lang")).alias("group"),
                         merkle.leaf_of(*[F.col(f) for f in merkle.FIELDS]).alias("digest"))
    manifest = merkle.build_manifest(leaves, ["id"])
    records = {r.digest: r.children for r in manifest.records().collect()}
    assert all(h("".join(children)) == digest for digest, children in records.items())
    reached, todo = set(), [manifest.root]
    while todo:
        node = todo.pop()
        reached.add(node)
        todo += records.get(node, [])
    assert {r.digest for r in leaves.collect()} <= reached


def test_query_matches_its_sql(spark):
    ok, message = compare(merkle.op13_manifest(spark, SF_SMALL), duck(SF_SMALL), merkle.ORACLE)
    assert ok, message
