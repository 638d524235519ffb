"""JSON message parsing shared by the topic, the stream and JSON-lines files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from vigil.config import REQUIRED_COLUMNS
from vigil.functions import opens_with
from vigil.schema import ABSENT_KEYS, INVALID_MESSAGE, MESSAGE_TEXT, VISIT_RAW
from vigil.session import work_dir


# json.loads takes no single quotes.
_OPTIONS = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
_END = "_end"
_MARKED = StructType([*VISIT_RAW.fields, StructField(_END, LongType())])


def _strict(text: Column, tail: Column, schema, ends, pick) -> Column:
    """``pick`` of ``text`` parsed as the one element before ``tail`` (``ends`` knows it again); null otherwise.

    Spark's parser stops after the first value of a text, whatever follows.
    So the text is put into an array with a tail that holds its own hash: the
    array has two elements and ends with that hash only when the text is one
    complete value (a second value is a third element, a bracket that closes
    early leaves the tail out, anything else is an error).
    """
    parsed = F.from_json(F.concat(F.lit("["), text, F.lit(","), tail, F.lit("]")), ArrayType(schema), _OPTIONS)
    whole = F.filter(F.array(parsed), lambda p: (F.size(p) == 2) & ends(F.get(p, 1)))
    return F.get(F.transform(whole, lambda p: pick(F.get(p, 0))), 0)


def _visits(value: str) -> Column:
    """The visits of a message (a lone object is one); null when the message is invalid.

    A message is valid when a strict JSON parser takes the whole text and
    finds an object or an array; elements of an array that are no objects
    give no visits.
    """
    text = F.col(value)
    mark = F.xxhash64(text)
    end = F.concat(F.lit(f'{{"{_END}":'), mark.cast("string"), F.lit("}"))
    lone = _strict(text, end, _MARKED, lambda e: e[_END] == mark, F.array)
    several = _strict(text, F.concat(F.lit("["), end, F.lit("]")), ArrayType(_MARKED),
                      lambda e: F.get(e, 0)[_END] == mark, lambda v: v)
    none = _strict(text, mark.cast("string"), StringType(), lambda e: e == mark.cast("string"),
                   lambda v: F.array().cast(ArrayType(_MARKED)))
    return F.when(opens_with(text, "{"), lone).when(opens_with(text, "["), F.coalesce(several, none))


def is_valid_message(df: DataFrame, value: str = "value") -> Column:
    """Column: the message is one JSON object, or an array, that Spark's parser accepts.

    Scalars, ``null``, blank and broken messages are invalid. A number where
    text is expected stays valid and becomes its text.
    """
    return _visits(value).isNotNull()


def valid_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """Keep only valid messages, unchanged."""
    return df.filter(is_valid_message(df, value))


def parse_messages(df: DataFrame, value: str = "value", keep: Sequence[str] = (),
                   mark_invalid: bool = False, keep_message: bool = False) -> DataFrame:
    """The visits of valid messages as raw columns (all text), one row each; objects of an array are a visit each.

    Invalid messages are dropped; with ``mark_invalid`` each leaves one row
    of nulls whose column ``INVALID_MESSAGE`` is true, so that the pass that
    cleanses can count it; ``keep_message`` adds its text as ``MESSAGE_TEXT``. Each message is parsed once: ``inline`` expands
    the parsed array in a Generate node, below which a filter on its output
    cannot be pushed.
    """
    kept = [F.col(k) for k in keep]
    names = [f.name for f in VISIT_RAW]
    visits = F.filter(_visits(value), lambda v: v.isNotNull())
    if not mark_invalid:
        return df.select(*kept, F.inline(visits)).select(*kept, *names)

    def row(flag: bool, column) -> Column:
        return F.struct(F.lit(flag).alias(INVALID_MESSAGE), *[column(n).alias(n) for n in names])

    marked = F.coalesce(
        F.transform(visits, lambda v: row(False, v.getField)),
        F.array(row(True, lambda n: F.lit(None).cast("string"))))
    # A message that is none has no rules switched off.
    after = [F.when(F.col(INVALID_MESSAGE), F.lit(0)).otherwise(F.col(k)).alias(k) if k == ABSENT_KEYS else F.col(k)
             for k in keep]
    text = [F.when(F.col(INVALID_MESSAGE), F.col(MESSAGE_TEXT)).alias(MESSAGE_TEXT)] if keep_message else []
    kept += [F.col(value).alias(MESSAGE_TEXT)] if keep_message else []
    return df.select(*kept, F.inline(marked)).select(*after, *names, INVALID_MESSAGE, *text)


_ALL_KEYS = (1 << len(REQUIRED_COLUMNS)) - 1
BROADCAST_SOURCES = 10_000  # sources that lack a key, at most, for their list to be broadcast


def _seen_keys(value: str) -> list[Column]:
    """Two steps of columns: the visits, then the required keys that a message has as a bit mask."""
    text = F.col(value)
    names = F.when(opens_with(text, "{"), F.json_object_keys(text)).otherwise(
        F.flatten(F.transform(F.from_json(text, "array<map<string,string>>"), F.map_keys)))

    def all_of(v: Column) -> Column:
        return reduce(lambda a, b: a & b, [v[c].isNotNull() for c in REQUIRED_COLUMNS])

    held = reduce(lambda a, b: a + b, [F.when(F.array_contains(names, c), F.lit(1 << k)).otherwise(F.lit(0))
                                       for k, c in enumerate(REQUIRED_COLUMNS)])
    # Names are looked for only where no visit of the message has a value under each of them.
    return [F.when(F.col("_visits").isNull(), F.lit(0)).when(F.exists("_visits", all_of), F.lit(_ALL_KEYS)).otherwise(held)]


def absent_keys(df: DataFrame, by: str | None = None, value: str = "value") -> DataFrame:
    """(source, ABSENT_KEYS): the required keys that no valid message of a source has; one row a source that lacks any.

    A partial aggregate of one integer a source. A source without any of the
    keys lacks none in this sense (see ``absent_mask``). Without ``by`` the
    whole frame is one source, named null.
    """
    source = F.lit(None).cast("string") if by is None else F.col(by)
    seen = df.select(source.alias("_source"), value, _visits(value).alias("_visits")).select(
        "_source", *[c.alias("_held") for c in _seen_keys(value)])
    held = F.bit_or("_held")
    return seen.groupBy("_source").agg(F.when(held == 0, F.lit(0)).otherwise(_ALL_KEYS - held).alias(ABSENT_KEYS)).filter(
        F.col(ABSENT_KEYS) != 0)


def message_profile(df: DataFrame, value: str = "value") -> DataFrame:
    """``message_quality`` and ``ABSENT_KEYS`` of the whole frame, in one pass (one row)."""
    seen = df.select(value, _visits(value).alias("_visits")).select(
        F.coalesce(F.size("_visits"), F.lit(-1)).alias("_n"), *[c.alias("_held") for c in _seen_keys(value)])
    held = F.coalesce(F.bit_or("_held"), F.lit(0))
    return seen.agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(F.col("_n") >= 0).alias("valid_messages"),
        F.count_if(F.col("_n") < 0).alias("invalid_messages"),
        F.coalesce(F.sum(F.greatest("_n", F.lit(0)).cast("long")), F.lit(0)).alias("visits"),
        F.when(held == 0, F.lit(0)).otherwise(_ALL_KEYS - held).alias(ABSENT_KEYS))


def mark_absent_keys(df: DataFrame, by: str, value: str = "value") -> DataFrame:
    """``df`` with ``ABSENT_KEYS`` of each row's source.

    The sources that lack a key, few as a rule, are written to the work
    folder first: with none of them there is no join, up to
    ``BROADCAST_SOURCES`` are broadcast, more are joined by a shuffle.
    """
    spark = df.sparkSession
    path = work_dir(spark, "absent-keys")
    absent_keys(df, by, value).write.parquet(path)
    lacking = spark.read.schema(f"_source string, {ABSENT_KEYS} int").parquet(path)
    count = lacking.count()
    if not count:
        return df.withColumn(ABSENT_KEYS, F.lit(0))
    few = F.broadcast(lacking) if count <= BROADCAST_SOURCES else lacking
    return df.join(few, F.col(by) == F.col("_source"), "left").drop("_source").fillna(0, [ABSENT_KEYS])


def message_quality(df: DataFrame, value: str = "value") -> DataFrame:
    """Messages received, kept and dropped as invalid JSON, and visits in the kept ones (one aggregate row)."""
    parsed = df.select(F.coalesce(F.size(_visits(value)), F.lit(-1)).alias("_visits"))
    valid = F.col("_visits") >= 0
    return parsed.agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(valid).alias("valid_messages"),
        F.count_if(~valid).alias("invalid_messages"),
        F.coalesce(F.sum(F.when(valid, F.col("_visits")).cast("long")), F.lit(0)).alias("visits"),
    )
