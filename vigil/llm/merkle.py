"""Merkle dataset manifest: a content-addressed DAG, proofs by descent from its root.

Every row is a leaf; the leaves of a group, in order, form a tree of fan-out
``FANOUT``, and the groups' roots form one more. The manifest is a set of
records, digest -> digests of the children. Requests for leaves descend from
the root: at each step the record of a node is looked up by digest, the
child that the next digit of a leaf's rank selects is followed, and the
children left out are kept as a path segment. Requests with the same digits
so far travel as one row, so no step has more rows than its level has nodes
and the root's record is looked up once, not once a leaf. At the leaves the
segments are reversed, which gives each proof from the leaf up.

DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ascii_lower, read_table, stored

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")  # hashed into a leaf, in this order
PATH = "array<struct<left:string,right:string>>"
_PART_BITS = 33  # monotonically_increasing_id: the partition is above these bits, the place in it below


def digest_of(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated texts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value (integers decimal)."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return digest_of(*[encoded(v) for v in values])


def placed(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``place`` (rank in the group, from 0) and ``size`` (rows of the group).

    One range sort, then a prefix sum over the runs of a group, one a range
    partition at most; a group of any size is spread over many partitions.
    """
    kept = rows.columns
    ordered = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    ordered = stored(ordered.withColumn("_at", F.monotonically_increasing_id()), f"{name}-order")
    ordered = ordered.withColumn("_part", F.shiftright("_at", _PART_BITS)).withColumn(
        "_at", F.col("_at").bitwiseAND((1 << _PART_BITS) - 1))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = ordered.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first")).select(
        F.col(group).alias("_group"), F.col("_part").alias("_run"),
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("_shift"),
        F.sum("n").over(whole).alias("size"))
    return ordered.join(runs, (F.col(group) == F.col("_group")) & (F.col("_part") == F.col("_run"))).select(
        *kept, (F.col("_at") + F.col("_shift")).alias("place"), "size")


def _parents(nodes: DataFrame) -> DataFrame:
    """The next level: every ``FANOUT`` consecutive nodes of a group become one (at most ``FANOUT`` rows a key)."""
    runs = nodes.groupBy("group", F.expr(f"place div {FANOUT}").alias("run")).agg(
        F.max("size").alias("size"), F.sort_array(F.collect_list(F.struct("place", "digest"))).alias("nodes"))
    children = F.transform("nodes", lambda n: n["digest"])
    return runs.select(
        "group", F.col("run").alias("place"), F.expr(f"(size + {FANOUT - 1}) div {FANOUT}").alias("size"),
        children.alias("children"), digest_of(F.array_join(children, "")).alias("digest"))


@dataclass
class Tree:
    """Trees of some groups: ``levels[k]`` holds the records that join level ``k`` to ``k + 1``."""

    levels: list[DataFrame] = field(default_factory=list)
    roots: DataFrame | None = None  # group, digest, height

    def records(self, level: int) -> DataFrame:
        """digest -> children, once a digest."""
        return self.levels[level].select(F.col("digest").alias("_digest"), "children").dropDuplicates(["_digest"])


def build(nodes: DataFrame, name: str) -> Tree:
    """Trees over (group, place, size, digest); a level is written before the next one is made."""
    tree, tops = Tree(), [nodes.filter("size = 1").select("group", "digest", F.lit(0).alias("height"))]
    largest = nodes.agg(F.max("size")).first()[0] or 0
    while largest > 1:
        nodes = stored(_parents(nodes.filter("size > 1")), f"{name}-level")
        tree.levels.append(nodes)
        tops.append(nodes.filter("size = 1").select("group", "digest", F.lit(len(tree.levels)).alias("height")))
        largest = -(-largest // FANOUT)
    tree.roots = tops[0]
    for top in tops[1:]:
        tree.roots = tree.roots.union(top)
    return tree


@dataclass
class Manifest:
    leaves: DataFrame  # the rows, with group, place, size, digest
    tree: Tree  # a tree a group
    groups: DataFrame  # group, digest, height, place in the order of the groups
    top: Tree  # the tree over the groups' roots
    root: str | None  # None for an empty table

    def records(self) -> DataFrame:
        """(digest, children): the whole content-addressed store."""
        out = None
        for tree in (self.top, self.tree):
            for level in range(len(tree.levels)):
                part = tree.records(level).withColumnRenamed("_digest", "digest")
                out = part if out is None else out.union(part)
        return out


def group_key(value: Column) -> Column:
    """A key without nulls that sorts as the value does: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def build_manifest(leaves: DataFrame, order: list[str]) -> Manifest:
    """The manifest of ``leaves``: columns ``group`` (see ``group_key``), ``digest`` and any others.

    Leaves ascend by ``order`` in their group, nulls first; ties go by
    digest, and equal leaves, which cannot be told apart, are leaves of
    their own each. A lone leaf is its group's root, a lone group's root the
    root. An empty table has no root.
    """
    rows = stored(leaves, "merkle-leaves").withColumn("_row", F.monotonically_increasing_id())
    rows = stored(placed(rows, "group", [*order, "digest", "_row"], "merkle").drop("_row"), "merkle-places")
    tree = build(rows.select("group", "place", "size", "digest"), "merkle")
    groups = stored(placed(tree.roots.withColumn("all", F.lit("")), "all", ["group"], "merkle-groups"), "merkle-groups")
    top = build(groups.select(F.col("all").alias("group"), "place", "size", "digest"), "merkle-top")
    root = top.roots.select("digest").first()
    return Manifest(rows, tree, groups.select("group", "digest", "height", "place"), top, root[0] if root else None)


def _segment(digit: Column) -> Column:
    """The children that a digit leaves out, on its left and its right."""
    return F.struct(F.array_join(F.slice("children", 1, digit), "").alias("left"),
                    F.array_join(F.slice("children", digit + 2, FANOUT), "").alias("right"))


def _descend(frontier: DataFrame, records: DataFrame, carried: list[str]) -> DataFrame:
    """One step down: a row a child, its path longer by the children left out."""
    found = frontier.join(records, F.col("digest") == F.col("_digest"))
    steps = found.select(*carried, "path", "children", F.col("place").alias("_above"),
                         F.posexplode("children").alias("_digit", "digest"))
    return steps.select(*carried, (F.col("_above") * FANOUT + F.col("_digit")).alias("place"), "digest",
                        F.concat("path", F.array(_segment(F.col("_digit")))).alias("path"))


def proofs(manifest: Manifest) -> DataFrame:
    """The leaves with ``subroot``, ``root`` and ``path``: a (left, right) pair of joined siblings a level, leaf first.

    Folding a leaf through its path, ``H(left, digest, right)`` at each
    step, gives the root.
    """
    spark = manifest.leaves.sparkSession
    start = [] if manifest.root is None else [(0, manifest.root)]
    at = spark.createDataFrame(start, "place long, digest string").withColumn("path", F.array().cast(PATH))
    for level in reversed(range(len(manifest.top.levels))):
        at = _descend(at, manifest.top.records(level), [])
    names = manifest.groups.select("group", "height", F.col("place").alias("_place"))
    at = at.join(names, F.col("place") == F.col("_place")).select(
        "group", "height", F.lit(0).cast("long").alias("place"), "digest", F.col("digest").alias("subroot"), "path")
    at = stored(at, "merkle-subroots")

    carried = ["group", "subroot"]
    columns = [*carried, "place", "digest", "path"]
    frontier = None
    for level in reversed(range(len(manifest.tree.levels))):
        joining = at.filter(F.col("height") == level + 1).select(*columns)  # trees of this height begin here
        frontier = joining if frontier is None else frontier.union(joining)
        if level:
            frontier = _descend(frontier, manifest.tree.records(level), carried)
    alone = at.filter("height = 0").select("group", "subroot", F.col("place").alias("_run"), "path",
                                           F.array("digest").alias("children"), F.lit(True).alias("_alone"))
    runs = alone
    if frontier is not None:
        runs = frontier.join(manifest.tree.records(0), F.col("digest") == F.col("_digest")).select(
            "group", "subroot", F.col("place").alias("_run"), "path", "children",
            F.lit(False).alias("_alone")).union(alone)

    # The last digit: a run of leaves meets its requests, so paths are never multiplied by the leaves in a shuffle.
    runs = runs.withColumnRenamed("group", "_group")
    leaves = manifest.leaves.withColumn("_of", F.expr(f"place div {FANOUT}"))
    met = leaves.join(runs, (F.col("group") == F.col("_group")) & (F.col("_of") == F.col("_run")))
    digit = F.expr(f"CAST(place % {FANOUT} AS INT)")
    path = F.when(F.col("_alone"), F.col("path")).otherwise(F.concat("path", F.array(_segment(digit))))
    return met.withColumn("path", F.reverse(path)).withColumn("root", F.lit(manifest.root)).select(
        *manifest.leaves.columns, "subroot", "root", "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, leaf, lambda acc, s: digest_of(s["left"], acc, s["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, leaf level first, left to right."""
    return digest_of(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def tampered(id_column: Column) -> Column:
    """Whether a row is checked with a changed text."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def audit(docs: DataFrame, claimed: dict[str, Column] | None = None, order_col: str = "doc_id",
          group_col: str = "lang", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Proof of every row of ``docs``, and whether what is claimed of it folds to the root.

    ``claimed`` gives, by field, the values to check in place of the
    manifest's own. Returns (order column, leaf, subroot, root,
    proof_sha256, folded_root, verified). Null fields are hashed as ``-``
    and differ from empty ones; rows of a null group form the first group,
    rows with a null order come first; repeated rows are leaves each; other
    input columns are ignored. An empty table gives an empty result.
    """
    own = [F.col(f"`{f}`") for f in fields]
    claims = [(claimed or {}).get(f, F.col(f"`{f}`")) for f in fields]
    leaves = docs.select(F.col(f"`{order_col}`").alias("id"), group_key(F.col(f"`{group_col}`")).alias("group"),
                         leaf_of(*own).alias("digest"), leaf_of(*claims).alias("claimed"))
    proved = proofs(build_manifest(leaves, ["id"]))
    return proved.select(
        F.col("id").alias(order_col), F.col("digest").alias("leaf"), "subroot", "root",
        proof_digest(F.col("path")).alias("proof_sha256"), fold(F.col("claimed"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    text = F.when(tampered(F.col("doc_id")), ascii_lower(F.col("text"))).otherwise(F.col("text"))
    return audit(docs, {"text": text})


def _oracle(levels: int = 8) -> str:
    """SQL for up to ``FANOUT ** levels`` leaves a group, and as many groups."""
    def enc(c: str) -> str:
        return f"coalesce(CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(enc(text if f == "text" else f) for f in FIELDS) + ")"

    crc = ("list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda d: CAST(ord(d) AS BIGINT))), lambda a, d: list_reduce(list_concat([xor(a, d)], "
           "list_transform(range(8), lambda z: 0::BIGINT)), lambda x, z: xor(x >> 1, (x & 1) * 3988292384)))")
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"""
    hashed AS (
      SELECT doc_id, coalesce('=' || lang, '') AS grp, {leaf('text')} AS leaf,
             CASE WHEN xor({crc}, 4294967295) % 3 = 0 THEN {leaf(f'({lower})')} ELSE {leaf('text')} END AS claimed
      FROM documents),
    leaves AS (
      SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
             count(*) OVER (PARTITION BY grp) AS size FROM hashed),
    l0 AS (SELECT 'g' || grp AS grp, place, size, leaf AS digest FROM leaves)"""]

    def climb(prefix: str) -> None:
        for k in range(1, levels + 1):
            parts.append(f"""
    {prefix}{k} AS (
      SELECT grp, place // {FANOUT} AS place, (max(size) + {FANOUT - 1}) // {FANOUT} AS size,
             sha256(string_agg(digest, '' ORDER BY place)) AS digest
      FROM {prefix}{k - 1} WHERE size > 1 GROUP BY grp, place // {FANOUT})""")
        parts.append(f"{prefix}all AS (" + " UNION ALL ".join(
            f"SELECT {k} AS level, grp, place, size, digest FROM {prefix}{k}" for k in range(levels + 1)) + ")")

    climb("l")
    parts.append("""subroots AS (
      SELECT substr(grp, 2) AS grp, digest, row_number() OVER (ORDER BY substr(grp, 2)) - 1 AS place, count(*) OVER () AS size
      FROM lall WHERE size = 1),
    t0 AS (SELECT 't' AS grp, place, size, digest FROM subroots)""")
    climb("t")
    parts.append(f"""root AS (SELECT digest FROM tall WHERE size = 1),
    sib AS (
      SELECT a.grp, a.level, a.place,
             coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS lft,
             coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS rgt
      FROM (SELECT * FROM lall WHERE size > 1 UNION ALL SELECT * FROM tall WHERE size > 1) a
      JOIN (SELECT * FROM lall WHERE size > 1 UNION ALL SELECT * FROM tall WHERE size > 1) b
        ON a.grp = b.grp AND a.level = b.level AND a.place // {FANOUT} = b.place // {FANOUT}
      GROUP BY a.grp, a.level, a.place),
    f0 AS (
      SELECT l.doc_id, l.leaf, l.grp, l.place, s.digest AS subroot, s.place AS top, claimed AS folded, '' AS proof
      FROM leaves l JOIN subroots s ON l.grp = s.grp)""")
    at = "f0"
    for kind in ("g", "t"):
        for k in range(levels):
            key = "'g' || f.grp" if kind == "g" else "'t'"
            place = f"(f.place // {FANOUT ** k})" if kind == "g" else f"(f.top // {FANOUT ** k})"
            parts.append(f"""{kind}f{k} AS (
      SELECT f.doc_id, f.leaf, f.grp, f.place, f.subroot, f.top,
             CASE WHEN s.grp IS NULL THEN folded ELSE sha256(s.lft || folded || s.rgt) END AS folded,
             proof || coalesce(s.lft || s.rgt, '') AS proof
      FROM {at} f LEFT JOIN sib s ON s.grp = {key} AND s.level = {k} AND s.place = {place})""")
            at = f"{kind}f{k}"
    return ("WITH " + ",\n".join(parts) + f"""
    SELECT doc_id, leaf, subroot, r.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
           folded = r.digest AS verified
    FROM {at}, root r""")


ORACLE = _oracle()
