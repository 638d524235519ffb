"""Cleansing rules, in order: trim, drop missing, parse date, drop bad date,
valid codes, conform columns.

Every rule is ``DataFrame -> DataFrame`` and only touches columns that exist
(a frame without ``diagnosis_code`` skips the code rule), so batch and stream
share them. Where one frame holds many files, the column ``ABSENT_KEYS``
says for each row which keys its file lacks, and their rules skip the row. All rules are narrow: Catalyst merges the filters into one and
the whole chain runs inside one whole-stage-codegen span with no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructType

from vigil.config import REQUIRED_COLUMNS, TRIM_COLUMNS, VALID_CODES
from vigil.functions import space_trim, strict_date
from vigil.schema import ABSENT_KEYS, INVALID_MESSAGE, VISIT_CLEANSED

MISSING_REQUIRED = "missing_required"
BAD_DATE = "bad_date"
INVALID_CODE = "invalid_code"
REJECT_REASONS = (MISSING_REQUIRED, BAD_DATE, INVALID_CODE)
# Outcome of a row: kept, one of the reasons, or a message that is no JSON.
KEPT, NOT_JSON = "kept", "invalid_message"


def _string_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}


def trim_fields(df: DataFrame, columns: Iterable[str] = TRIM_COLUMNS) -> DataFrame:
    """Trim the space character off the listed text columns that exist."""
    names = [f.name for f in df.schema.fields]
    targets = set(columns) & _string_columns(df)
    if not targets:
        return df
    return df.select(*[space_trim(F.col(c)).alias(c) if c in targets else F.col(c) for c in names])


def drop_missing(df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Drop rows with a null in any required column that exists; '' survives."""
    cols = set(df.columns)
    present = [c for c in required if c in cols]
    return df.dropna(how="any", subset=present) if present else df


def parse_visit_date(df: DataFrame, column: str = "visit_date") -> DataFrame:
    """Parse the date strictly and drop rows where it did not parse."""
    types = {f.name: f.dataType for f in df.schema.fields}
    if column not in types:
        return df
    if not isinstance(types[column], DateType):
        df = df.withColumn(column, strict_date(F.col(column)))
    return df.filter(F.col(column).isNotNull())


Codes = Iterable[str] | DataFrame


def _code_table(codes: DataFrame) -> DataFrame:
    return codes.select(F.col(codes.columns[0]).alias("_valid_code")).dropna()


def keep_valid_codes(df: DataFrame, codes: Codes = VALID_CODES, column: str = "diagnosis_code") -> DataFrame:
    """Keep rows whose code is in the valid set (case-sensitive, null dropped).

    A list becomes an ``InSet`` predicate inside the scan stage. A code table
    (its first column) becomes a left-semi join: Spark broadcasts it when its
    bytes are few, else shuffles and splits a hot code.
    """
    if column not in df.columns:
        return df
    if isinstance(codes, DataFrame):
        table = _code_table(codes)
        return df.join(table, df[column] == table["_valid_code"], "left_semi")
    return df.filter(F.col(column).isin(list(codes)))


def conform(df: DataFrame, schema: StructType = VISIT_CLEANSED) -> DataFrame:
    """Select the schema's columns in its order; absent ones become typed nulls.

    A frame that shares no column with the schema is returned unchanged.
    """
    present = set(df.columns)
    if not any(f.name in present for f in schema.fields):
        return df
    if [f.name for f in schema.fields] == df.columns:
        return df
    return df.select(*[
        F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def absent_mask(keys: Iterable[str]) -> int:
    """Value of ``ABSENT_KEYS`` for a file without ``keys``.

    A file without any required column has nothing to be kept by: its rows
    stay subject to the rules.
    """
    held = set(keys)
    mask = sum(1 << k for k, c in enumerate(REQUIRED_COLUMNS) if c in held)
    return 0 if mask == (1 << len(REQUIRED_COLUMNS)) - 1 else mask


def _applies(failed: Column, key: str, types: Iterable[str]) -> Column:
    """``failed``, unless the row's file lacks the key."""
    if ABSENT_KEYS not in types:
        return failed
    return failed & (F.col(ABSENT_KEYS).bitwiseAND(1 << REQUIRED_COLUMNS.index(key)) == 0)


_DATE_MISSING = "_visit_date_missing"
_CODE_VALID = "_code_valid"


def _prepared(df: DataFrame, codes: Codes) -> tuple[DataFrame, dict]:
    """Trimmed and parsed columns, each computed once; a flag telling a missing
    date from one that did not parse, and one telling a valid code.

    The parsed date comes out of a Generate node (one row in, one out): a
    filter on it cannot be pushed below, so the parse is not copied into the
    filter. Filters on the other columns are pushed, and run before the
    parse; columns that nobody reads are pruned.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    trim_set = set(TRIM_COLUMNS) & {n for n, t in types.items() if isinstance(t, StringType)}

    def value(name: str) -> Column:
        return space_trim(F.col(name)) if name in trim_set else F.col(name)

    columns = [value(n).alias(n) for n in types if n != "visit_date"]
    extra = []
    if "visit_date" in types:
        typed = isinstance(types["visit_date"], DateType)
        date = value("visit_date") if typed else strict_date(value("visit_date"))
        columns.append(F.inline(F.array(F.struct(
            date.alias("visit_date"), F.col("visit_date").isNull().alias(_DATE_MISSING)))))
    with_codes = "diagnosis_code" in types
    if with_codes and not isinstance(codes, DataFrame):
        valid = F.coalesce(value("diagnosis_code").isin(list(codes)), F.lit(False))
        extra.append(valid.alias(_CODE_VALID))
    out = df.select(*extra, *columns)
    if with_codes and isinstance(codes, DataFrame):
        table = _code_table(codes).distinct()
        joined = out.join(table, out["diagnosis_code"] == table["_valid_code"], "left")
        out = joined.withColumn(_CODE_VALID, F.col("_valid_code").isNotNull()).drop("_valid_code")
    return out, types


def _keep(types: dict) -> Column | None:
    """The cleanse predicate over prepared columns (required, parsed date, code)."""
    checks = [~_applies(F.col(c).isNull(), c, types) if ABSENT_KEYS in types else F.col(c).isNotNull()
              for c in REQUIRED_COLUMNS if c in types]
    if "diagnosis_code" in types:
        checks.append(~_applies(~F.col(_CODE_VALID), "diagnosis_code", types) if ABSENT_KEYS in types
                      else F.col(_CODE_VALID))
    return reduce(lambda a, b: a & b, checks) if checks else None


def cleanse(df: DataFrame, codes: Codes = VALID_CODES, schema: StructType = VISIT_CLEANSED) -> DataFrame:
    """All rules in order, ending with ``conform``.

    Built as one projection (trim, parse, conform) and one filter (required
    fields, parsed date, valid code), the plan that the rule-by-rule chain
    stands for, with each date parsed once.
    """
    prepared, types = _prepared(df, codes)
    keep = _keep(types)
    names = [F.col(n) for n in types]
    return conform((prepared.filter(keep) if keep is not None else prepared).select(*names), schema)


def _prepared_reason(types: dict) -> Column:
    """``reject_reason`` over prepared columns: null checks and flags, no parsing."""
    checks: list[tuple[Column, str]] = []
    missing = [_applies(F.col(c).isNull(), c, types) for c in REQUIRED_COLUMNS if c in types and c != "visit_date"]
    if "visit_date" in types:
        missing.append(_applies(F.col(_DATE_MISSING), "visit_date", types))
    if missing:
        checks.append((reduce(lambda a, b: a | b, missing), MISSING_REQUIRED))
    if "visit_date" in types:
        checks.append((_applies(F.col("visit_date").isNull(), "visit_date", types), BAD_DATE))
    if "diagnosis_code" in types:
        checks.append((_applies(~F.col(_CODE_VALID), "diagnosis_code", types), INVALID_CODE))
    return _first_failing(checks)


def _cleanse_observed(df: DataFrame, observe, codes: Codes, schema: StructType) -> DataFrame:
    prepared, types = _prepared(df, codes)
    metrics = quality_columns(_prepared_reason(types))
    if INVALID_MESSAGE in types:
        metrics.append(F.count_if(F.col(INVALID_MESSAGE)).alias("invalid_messages"))
    observed = observe(prepared, metrics)
    keep = _keep(types)
    kept = observed.filter(keep) if keep is not None else observed
    return conform(kept.select(*[F.col(n) for n in types if n != INVALID_MESSAGE]), schema)


def cleanse_observed(
    df: DataFrame, codes: Codes = VALID_CODES, schema: StructType = VISIT_CLEANSED, name: str = "cleanse_quality",
) -> tuple[DataFrame, Observation]:
    """``cleanse`` plus before / after / removed counts from the same pass.

    Trim and date parse run once per row in a projection; the observed
    metrics and the filter above it only test nulls and flags (the filter
    cannot be pushed below the metrics node). Rows that stand for invalid
    messages (column ``INVALID_MESSAGE``) count as rows before, lack the
    required fields, and are counted again as ``invalid_messages``. Run any
    action on the returned frame (a write) and read ``observation.get``.
    """
    obs = Observation(name)
    return _cleanse_observed(df, lambda d, m: d.observe(obs, *m), codes, schema), obs


def cleanse_observed_stream(
    df: DataFrame, codes: Codes = VALID_CODES, schema: StructType = VISIT_CLEANSED, name: str = "cleanse_quality",
) -> DataFrame:
    """Streaming form: the counts appear under ``observedMetrics[name]`` per micro-batch."""
    return _cleanse_observed(df, lambda d, m: d.observe(name, *m), codes, schema)


# What a CSV writer strips off both ends of a field unless told otherwise.
_FIELD_PADDING = "".join(chr(c) for c in range(33))


def outcomes(df: DataFrame, codes: Codes = VALID_CODES, observation: Observation | None = None) -> DataFrame:
    """Every row with its outcome: (visit columns as text, the frame's other columns, ``outcome``).

    A kept row has its cleansed values, a rejected one the values it came
    with, so one write partitioned by ``outcome`` gives the cleansed rows and
    the quarantined ones. ``observation`` gets the counts of the pass.
    """
    visit = [f.name for f in VISIT_CLEANSED.fields if f.name in df.columns]
    extra = [c for c in df.columns if c not in visit and c not in (INVALID_MESSAGE, ABSENT_KEYS)]
    prepared, types = _prepared(df.withColumn("_raw", F.struct(*visit)), codes)
    if observation is not None:
        metrics = quality_columns(_prepared_reason(types))
        if INVALID_MESSAGE in types:
            metrics.append(F.count_if(F.col(INVALID_MESSAGE)).alias("invalid_messages"))
        prepared = prepared.observe(observation, *metrics)
    reason = F.coalesce(_prepared_reason(types), F.lit(KEPT))
    if INVALID_MESSAGE in types:
        reason = F.when(F.col(INVALID_MESSAGE), F.lit(NOT_JSON)).otherwise(reason)
    told = prepared.withColumn("outcome", reason)

    def value(f) -> Column:
        if f.name not in visit:
            return F.lit(None).cast("string").alias(f.name)
        cleansed = F.btrim(F.col(f.name).cast("string"), F.lit(_FIELD_PADDING))
        raw = F.col(f"_raw.{f.name}").cast("string")
        return F.when(F.col("outcome") == KEPT, cleansed).otherwise(raw).alias(f.name)

    return told.select(*[value(f) for f in VISIT_CLEANSED.fields], *extra, "outcome")


def reject_reason(df: DataFrame, codes: Iterable[str] = VALID_CODES) -> Column:
    """The first rule a row of ``df`` fails, or null when ``cleanse`` keeps it.

    Evaluated on the raw columns, for a list of codes; agrees row for row
    with ``cleanse``.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = set(types)
    checks: list[tuple[Column, str]] = []
    required = [c for c in REQUIRED_COLUMNS if c in cols]
    if required:
        missing = [_applies(F.col(c).isNull(), c, types) for c in required]
        checks.append((reduce(lambda a, b: a | b, missing), MISSING_REQUIRED))
    if "visit_date" in cols:
        if isinstance(types["visit_date"], DateType):
            parsed = F.col("visit_date")
        else:
            parsed = strict_date(space_trim(F.col("visit_date")))
        checks.append((_applies(parsed.isNull(), "visit_date", types), BAD_DATE))
    if "diagnosis_code" in cols:
        valid = space_trim(F.col("diagnosis_code")).isin(list(codes))
        checks.append((_applies(~F.coalesce(valid, F.lit(False)), "diagnosis_code", types), INVALID_CODE))
    return _first_failing(checks)


def _first_failing(checks: list[tuple[Column, str]]) -> Column:
    if not checks:
        return F.lit(None).cast("string")
    cond, label = checks[0]
    reason = F.when(cond, F.lit(label))
    for cond, label in checks[1:]:
        reason = reason.when(cond, F.lit(label))
    return reason


def quality_columns(reason: Column) -> list[Column]:
    """Aggregates for rows before / after / removed and each reject reason."""
    before = F.count(F.lit(1))
    after = F.count_if(reason.isNull())
    return [
        before.alias("rows_before"),
        after.alias("rows_after"),
        (before - after).alias("rows_removed"),
        *[F.count_if(reason == F.lit(r)).alias(r) for r in REJECT_REASONS],
    ]


def quality(df: DataFrame, by: Column | str | None = None, codes: Codes = VALID_CODES) -> DataFrame:
    """Before / after / removed counts per source in one pass over the raw rows.

    ``by`` defaults to the input file (``_metadata.file_path``) of a file
    scan. It is a hash aggregate with map-side partial counts, so a source
    holding a third of all rows costs one partial row per task, not a hot
    partition.
    """
    key = F.col("_metadata.file_path") if by is None else (F.col(by) if isinstance(by, str) else by)
    source = df.select("*", key.alias("_quality_source"))
    prepared, types = _prepared(source, codes)
    return prepared.groupBy(F.col("_quality_source").alias("source")).agg(*quality_columns(_prepared_reason(types)))
