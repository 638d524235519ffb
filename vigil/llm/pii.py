"""Personal data by bootstrapped contextual extraction.

Seeds are the identifiers that the base patterns of ``KINDS`` find. Every
mention of an identifier, seed or open (a run of words with digits that no
base pattern took), has lexical patterns: the words around it. Patterns and
identifiers form a graph, whose edges are distinct, so copies of a passage
count once. Spark scores it in rounds:

* a pattern's confidence in a kind is the share of that kind's identifiers
  among those in its slot: seeds count in full, open ones of a fitting form
  with their score so far and, for the rest, as ``OPEN_WEIGHT`` of a miss;
  seeds of other kinds and open ones of another form are misses;
* patterns with ``MIN_SUPPORT`` seeds and a confidence of ``PROMOTE`` are
  promoted, and an open identifier scores as the best promoted pattern.

After the last round the open identifiers with a score of ``ACCEPT`` are
personal data wherever they stand. Texts are read once; what is scored holds
mentions only. A join with the patterns or identifiers of a round is salted,
so a context or an identifier with a third of all mentions is spread.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, read_table, stored
from .words import slices

# --- fixed values: the base patterns --------------------------------------------
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")  # possessive: no retries, so linear on any text
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IP_PART, CARD_DIGITS, PHONE_DIGITS = 255, (16, 19), (8, 15)
# ----------------------------------------------------------------------------------
DIGITS = re.compile("[0-9]+")
ATOM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789.@_%+()-")
ATOM_REST = re.compile(r"[A-Za-z0-9.@_%+()-]*")
# Forms an open identifier may have, by kind; others are misses of a pattern of that kind.
FORMS = (re.compile("(?=.*[A-Za-z]).*"), re.compile(r"[0-9]+(\.[0-9]+){2,}"),
         re.compile(r"(?:[^A-Za-z0-9@]*[0-9]){12,19}[^A-Za-z0-9@]*"), re.compile(r"(?:[^A-Za-z0-9@]*[0-9]){7,15}[^A-Za-z0-9@]*"))
SHORTEST, LONGEST = 5, 64  # letters and digits, and characters, of an open identifier
WINDOW = 64  # characters on each side that give the words of a pattern
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = re.compile(r"^[^\w]+|[^\w]+$")
ASCII_LOWER = str.maketrans(UPPER, LOWER)

MIN_SUPPORT, PROMOTE, ACCEPT, OPEN_WEIGHT, PRIOR = 3, 0.5, 0.8, 0.5, 0.5
MAX_ROUNDS = 8
SALTS = 16
MENTION = "struct<kind:int,start:int,end:int,key:string,forms:int,contexts:array<string>>"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each ``@``: a local part holds none, so each decides by itself."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            free = match.end()
        at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(int(d) for d in digits[-1::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(DIGITS.findall(text))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all base identifiers, by kind and then start, in code points."""
    out = [(0, a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= IP_PART for x in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 2 * CARD_DIGITS[1]:
            digits = _digits(m[0])
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                out.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if PHONE_DIGITS[0] <= len(_digits(m[0])) <= PHONE_DIGITS[1]:
            out.append((3, m.start(), m.end()))
    return out


def open_spans(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Runs of words with a digit each, one space between them, that touch no base identifier."""
    runs: list[list[int]] = []
    done = 0
    for m in DIGITS.finditer(text):
        if m.start() < done:
            continue
        start = m.start()
        while start > done and text[start - 1] in ATOM:
            start -= 1
        end = ATOM_REST.match(text, m.end()).end()
        if runs and start - runs[-1][1] == 1 and text[start - 1] == " ":
            runs[-1][1] = end
        else:
            runs.append([start, end])
        done = end
    covered: list[list[int]] = []  # base spans, those that overlap made one
    for a, b in sorted((a, b) for _, a, b in taken):
        if covered and a < covered[-1][1]:
            covered[-1][1] = max(b, covered[-1][1])
        else:
            covered.append([a, b])
    k = 0
    for start, end in runs:
        while k < len(covered) and covered[k][1] <= start:
            k += 1
        if k < len(covered) and covered[k][0] < end:
            continue
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        while end > start and not (text[end - 1].isalnum() or text[end - 1] == ")"):
            end -= 1
        if text[start:start + 1] == "(" and ")" not in text[start:end]:
            start += 1
        if text[end - 1:end] == ")" and "(" not in text[start:end]:
            end -= 1
        if end - start <= LONGEST and sum(c.isalnum() for c in text[start:end]) >= SHORTEST:
            yield start, end


def _plain(word: str) -> str:
    """A context word: lower case, digits alike, without punctuation around it unless it is nothing else."""
    word = DIGITS.sub("0", word.translate(ASCII_LOWER))
    return EDGE.sub("", word) or word


def contexts(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns of a mention: one or two words before, two words after, one on each side."""
    before = [_plain(w) for w in WORD.findall(text[max(0, start - WINDOW):start])[-2:]]
    after = [_plain(w) for w in WORD.findall(text[end:end + WINDOW])[:2]]
    left, right = ["^", "^", *before][-2:], [*after, "$", "$"][:2]
    return [f"{left[1]} _", f"{left[0]} {left[1]} _", f"_ {right[0]} {right[1]}", f"{left[1]} _ {right[0]}"]


def mention_key(found: str) -> str:
    """What makes two mentions one identifier: separators and case aside, the same characters."""
    key = re.sub(r"[ ()+-]", "", found).translate(ASCII_LOWER)
    return key if len(key) <= LONGEST else "#" + hashlib.sha256(key.encode("utf-8", "surrogatepass")).hexdigest()


def extract(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, mentions): the base identifiers (kind from 0) and the open ones (kind null) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    fields = [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("key", pa.string()),
              ("forms", pa.int32()), ("contexts", pa.list_(pa.string()))]

    def mentions(text: str) -> list[tuple]:
        seeds = base_spans(text)
        out = [(k, a, b, mention_key(text[a:b]), 0, contexts(text, a, b)) for k, a, b in seeds]
        for a, b in open_spans(text, seeds):
            forms = sum(1 << k for k, form in enumerate(FORMS) if form.fullmatch(text[a:b]))
            out.append((None, a, b, mention_key(text[a:b]), forms, contexts(text, a, b)))
        return [dict(zip((f for f, _ in fields), m, strict=True)) for m in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [mentions(t) if t else [] for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.list_(pa.struct(fields)))], names=["doc_id", "mentions"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, mentions array<{MENTION}>")


def _salted(many: DataFrame, few: DataFrame, keys: list[str], spread: str) -> DataFrame:
    """Inner join of ``many`` with ``few`` (rows unique by the keys), a hot key's rows dealt out by ``spread``."""
    few = few.select(*[F.col(c).alias(f"_{c}") if c in keys else F.col(c) for c in few.columns],
                     F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_few_salt"))
    many = many.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    on = F.col("_salt") == F.col("_few_salt")
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    return many.join(few, on).drop("_salt", "_few_salt", *[f"_{k}" for k in keys])


def score_graph(mentions: DataFrame, min_support: int = MIN_SUPPORT, promote: float = PROMOTE,
                max_rounds: int = MAX_ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Mentions (kind, key, forms, contexts) -> scored open identifiers (key, kind, score), promoted patterns
    (context, kind, seeds, confidence)."""
    edges = stored(mentions.select("kind", "key", "forms", F.explode("contexts").alias("context")).distinct(), "pii-edges")

    def fits(kind: int) -> Column:
        return F.col("kind").isNull() & (F.col("forms").bitwiseAND(1 << kind) != 0)

    counts = edges.groupBy("context").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("kind") == k).alias(f"seeds{k}") for k in range(len(KINDS))],
        *[F.count_if(fits(k)).alias(f"open{k}") for k in range(len(KINDS))])
    by_kind = F.explode(F.array(*[F.struct(
        F.lit(k).alias("kind"), F.col(f"seeds{k}").alias("seeds"), F.col(f"open{k}").alias("open"),
        (F.col("n") - F.col(f"seeds{k}") - F.col(f"open{k}")).alias("misses")) for k in range(len(KINDS))])).alias("p")
    patterns = counts.select("context", by_kind).select("context", "p.*").filter(F.col("seeds") >= min_support)
    patterns = stored(patterns, "pii-patterns")

    # Edges of the graph that can carry a score: an open identifier in the slot of a pattern of a kind it fits.
    fitting = F.explode(F.filter(F.sequence(F.lit(0), F.lit(len(KINDS) - 1)), lambda k: F.getbit("forms", k) == 1))
    loose = edges.filter("kind IS NULL").select("context", "key", fitting.alias("kind"))
    graph = stored(_salted(loose, patterns.select("context", "kind"), ["context", "kind"], "key"), "pii-graph")

    found, state = None, None
    for _ in range(max_rounds):
        known = patterns.withColumn("found", F.lit(0.0))
        if found is not None:
            sums = _salted(graph, found, ["key", "kind"], "context").groupBy("context", "kind").agg(
                F.sum("score").alias("found"))
            known = patterns.join(sums, ["context", "kind"], "left").fillna(0.0, ["found"])
        good = F.col("seeds") + F.col("found")
        share = good / (good + F.col("misses") + OPEN_WEIGHT * (F.col("open") - F.col("found")) + PRIOR)
        promoted = stored(known.withColumn("confidence", share).filter(F.col("confidence") >= promote).select(
            "context", "kind", "seeds", "confidence"), "pii-promoted")
        found = stored(_salted(graph, promoted, ["context", "kind"], "key").groupBy("key", "kind").agg(
            F.max("confidence").alias("score")), "pii-found")
        now = found.agg(F.count(F.lit(1)), F.round(F.sum("score"), 3)).first()
        if now == state:
            break
        state = now
    return found, promoted


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       accept: float = ACCEPT) -> DataFrame:
    """(doc_id, base, spans): arrays of (kind, start, end), a row a row.

    ``base`` holds what the base patterns find, ``spans`` that and the
    identifiers found by context; kinds are numbers into ``KINDS``, places
    code points, the end exclusive. Null, empty and blank texts have none;
    repeated rows and copies are tagged alike but count once in the graph;
    an empty table gives an empty result; other columns are ignored.
    """
    read = stored(extract(docs, id_col, text_col), "pii-mentions").withColumn("_row", F.monotonically_increasing_id())
    mentions = read.select("_row", F.explode("mentions").alias("m")).select("_row", "m.*")
    found, _ = score_graph(mentions)
    # One kind a key: the best score, the earlier kind on a tie.
    accepted = stored(found.filter(F.col("score") >= accept).groupBy("key").agg(
        F.max_by("kind", F.struct("score", -F.col("kind"))).alias("as_kind")), "pii-accepted")
    tagged = _salted(mentions.filter("kind IS NULL").select("_row", "key", "start", "end"), accepted, ["key"], "_row")
    added = tagged.groupBy(F.col("_row").alias("_of")).agg(  # the spans of one text
        F.collect_list(F.struct(F.col("as_kind").alias("kind"), "start", "end")).alias("added"))
    seeds = F.transform(F.filter("mentions", lambda m: m["kind"].isNotNull()), lambda m: F.struct(
        m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    base = read.select("_row", "doc_id", F.sort_array(seeds).alias("base"))
    return base.join(added, F.col("_row") == F.col("_of"), "left").select(
        "doc_id", "base", F.sort_array(F.concat("base", F.coalesce("added", none))).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = find_personal_data(read_table(spark, sf_dir, "documents"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return tagged.select(
        "doc_id", *counts, F.sha2(span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_found"))
