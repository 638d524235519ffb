"""Random small frames checked against plain-Python brute force."""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter, defaultdict
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vigil.config import VALID_CODES
from vigil.operators import cleanse, outbreaks
from vigil.schema import VISIT_CLEANSED, VISIT_RAW

PAD = st.sampled_from(["", " ", "  ", "\t"])
DATES = st.one_of(
    st.dates(dt.date(2023, 12, 1), dt.date(2024, 3, 1)).map(lambda d: d.isoformat()),
    st.sampled_from(["2024-1-5", "bad", "2024-02-30", "2024-01-05T10:00:00", "", "20240105"]),
)
CODES = st.sampled_from([*VALID_CODES, "B05", "b50", "U07.1", ""])


def padded(inner):
    return st.one_of(st.none(), st.tuples(PAD, inner, PAD).map(lambda t: "".join(t)))


ROWS = st.lists(
    st.tuples(
        padded(st.sampled_from(["P-1", "P-2", ""])),
        padded(st.sampled_from(["H1", "H2"])),
        padded(st.sampled_from(["Nairobi", "Kisumu"])),
        padded(DATES),
        padded(st.sampled_from(["Malaria", "Cholera"])),
        padded(CODES),
        st.just("2024-01-05T10:00:00+00:00"),
    ),
    max_size=25,
)


def _space_trim(v):
    return None if v is None else v.strip(" ")


def _strict_date(v):
    if v is None or not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", v):
        return None
    try:
        return dt.date.fromisoformat(v)
    except ValueError:
        return None


def brute_cleanse(rows):
    out = []
    for r in rows:
        pid, hosp, county, date, disease, code, etu = [_space_trim(v) for v in r[:6]] + [r[6]]
        if None in (pid, disease, code, date):
            continue
        d = _strict_date(date)
        if d is None or code not in VALID_CODES:
            continue
        out.append((pid, hosp, county, d, disease, code, etu))
    return out


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS)
def test_cleanse_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows, VISIT_RAW)
    got = Counter(tuple(r) for r in cleanse(df).collect())
    assert got == Counter(brute_cleanse(rows))


def brute_report(visits):
    daily = Counter((c, d, day) for c, d, day in visits)
    by_pair = defaultdict(list)
    for (c, d, day), n in daily.items():
        by_pair[(c, d)].append((day, n))
    out = []
    for (c, d), days in by_pair.items():
        days.sort()
        sums = [sum(n for _, n in days[max(0, i - 6): i + 1]) for i in range(len(days))]
        for i in range(1, len(days)):
            if Decimal(sums[i]) > Decimal(sums[i - 1]) * Decimal("1.5"):
                out.append((c, d, days[i][0], sums[i]))
    return out


VISITS = st.lists(
    st.tuples(st.sampled_from(["A", "B", None]), st.sampled_from(["X", "Y"]), st.integers(1, 20)),
    max_size=60,
)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(visits=VISITS)
def test_report_equals_brute_force(spark, visits):
    rows = [("P", "H", c, dt.date(2024, 1, day), d, "B50", None) for c, d, day in visits]
    df = spark.createDataFrame(rows, VISIT_CLEANSED)
    got = [tuple(r) for r in outbreaks(df).collect()]
    want = brute_report([(c, d, dt.date(2024, 1, day)) for c, d, day in visits])
    assert Counter(got) == Counter(want)
    # Ordered by date, county, disease with nulls last.
    keys = [(r[2], r[0] is None, r[0] or "", r[1]) for r in got]
    assert keys == sorted(keys)


def _brute_valid(line: str) -> bool:
    import json

    try:
        return isinstance(json.loads(line), dict | list)
    except ValueError:
        return False


TEXT = st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x2FF, exclude_characters='"\\'), max_size=8)
FIELDS = st.sampled_from(["patient_id", "county", "visit_date", "disease", "diagnosis_code", "other"])
VALUES = st.one_of(TEXT, st.integers(-5, 5), st.none(), st.booleans(), st.lists(st.integers(0, 3), max_size=2))


@st.composite
def messages(draw):
    import json

    obj = json.dumps(draw(st.dictionaries(FIELDS, VALUES, max_size=4)))
    kind = draw(st.sampled_from(["plain", "padded", "truncated", "garbage", "scalar", "array", "blank"]))
    if kind == "padded":
        return draw(st.sampled_from([" ", "\t", "\n ", ""])) + obj + draw(st.sampled_from([" ", "\r", ""]))
    if kind == "truncated":
        return obj[: draw(st.integers(0, max(0, len(obj) - 1)))]
    if kind == "garbage":
        return obj + draw(st.sampled_from([" x", ",", " ]", "{"]))
    if kind == "scalar":
        return draw(st.sampled_from(["123", "null", "true", '"text"', "1.5"]))
    if kind == "array":
        return f"[{obj}]"
    if kind == "blank":
        return ""
    return obj


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lines=st.lists(messages(), min_size=1, max_size=30))
def test_message_validity_equals_a_strict_json_check(spark, lines):
    from vigil.sources.messages import parse_messages, valid_messages

    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = Counter(r.value for r in valid_messages(df).collect())
    assert got == Counter(v for v in lines if _brute_valid(v))
    assert parse_messages(df).count() == sum(got.values())


def brute_reason(r):
    pid, _, _, date, disease, code, _ = [_space_trim(v) for v in r[:6]] + [r[6]]
    if None in (pid, disease, code, date):
        return "missing_required"
    if _strict_date(date) is None:
        return "bad_date"
    if code not in VALID_CODES:
        return "invalid_code"
    return None


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS)
def test_quality_counts_equal_brute_force(spark, rows):
    from pyspark.sql import functions as F

    from vigil.operators import cleanse_observed, quality

    df = spark.createDataFrame(rows, VISIT_RAW)
    reasons = Counter(brute_reason(r) for r in rows)
    want = {
        "rows_before": len(rows), "rows_after": reasons[None], "rows_removed": len(rows) - reasons[None],
        "missing_required": reasons["missing_required"], "bad_date": reasons["bad_date"],
        "invalid_code": reasons["invalid_code"],
    }
    q = quality(df, by=F.lit("all")).collect()
    if rows:
        assert {k: q[0][k] for k in want} == want
    cleansed, obs = cleanse_observed(df)
    cleansed.write.format("noop").mode("overwrite").save()
    assert {k: obs.get[k] for k in want} == want
