"""Outbreak report semantics: ROWS frame, previous row, strict growth, null county."""

from __future__ import annotations

import datetime as dt

from vigil.operators import daily_counts, lag_rolling_cases, outbreaks, rolling_cases
from vigil.schema import VISIT_CLEANSED


def visits(spark, counts):
    """counts: list of (county, disease, day-of-january, n) -> n visit rows each."""
    rows = []
    for county, disease, day, n in counts:
        rows += [("P", "H", county, dt.date(2024, 1, day), disease, "B50", None)] * n
    return spark.createDataFrame(rows, VISIT_CLEANSED)


def by_date(df):
    return {r.visit_date.day: r for r in df.collect()}


def test_window_counts_rows_not_dates(spark):
    days = [1, 2, 3, 4, 5, 6, 7, 9]  # a gap before the 9th
    df = visits(spark, [("C", "D", d, 1) for d in days])
    rolled = by_date(rolling_cases(daily_counts(df)))
    assert rolled[7].cases_last_7_days == 7
    assert rolled[9].cases_last_7_days == 7  # 7 latest rows: 3..9, not 3..9 by date


def test_gap_day_uses_latest_rows(spark):
    df = visits(spark, [("C", "D", 1, 1), ("C", "D", 2, 1), ("C", "D", 9, 1)])
    rolled = by_date(lag_rolling_cases(rolling_cases(daily_counts(df))))
    assert rolled[9].cases_last_7_days == 3 and rolled[9].prev_7_day == 2


def test_first_row_has_no_previous_and_no_alert(spark):
    df = visits(spark, [("C", "D", 1, 10)])
    assert lag_rolling_cases(rolling_cases(daily_counts(df))).first().prev_7_day is None
    assert outbreaks(df).count() == 0


def test_growth_is_strict(spark):
    eq = visits(spark, [("C", "D", 1, 2), ("C", "D", 2, 1)])  # 2 -> 3 is exactly 1.5x
    assert outbreaks(eq).count() == 0
    above = visits(spark, [("C", "D", 1, 2), ("C", "D", 2, 2)])  # 2 -> 4
    assert [r.cases_last_7_days for r in outbreaks(above).collect()] == [4]


def test_warm_up_rows_alert(spark):
    df = visits(spark, [("C", "D", 1, 1), ("C", "D", 2, 1)])  # 1 -> 2: no guard, alerts
    assert outbreaks(df).count() == 1


def test_null_county_is_its_own_group_and_sorts_last(spark):
    df = visits(spark, [(None, "D", 1, 1), (None, "D", 2, 2), ("A", "D", 1, 1), ("A", "D", 2, 2)])
    rows = outbreaks(df).collect()
    assert [(r.county, r.cases_last_7_days) for r in rows] == [("A", 3), (None, 3)]


def test_report_columns_and_types(spark):
    df = visits(spark, [("C", "D", 1, 1), ("C", "D", 2, 2)])
    out = outbreaks(df)
    assert out.columns == ["county", "disease", "visit_date", "cases_last_7_days"]
    assert out.schema["cases_last_7_days"].dataType.typeName() == "long"


def test_onset_on_the_fixture(spark):
    from vigil.operators import cleanse
    from vigil.sources.fixture import load_raw_visits

    rep = outbreaks(cleanse(load_raw_visits(spark, "/root/testdata/sf0.01")))
    assert rep.count() == 35
    onset = rep.filter("county = 'Mombasa' AND disease = 'Malaria' AND visit_date = DATE'2024-01-15'").collect()
    assert [r.cases_last_7_days for r in onset] == [19]


def test_plan_keeps_partial_aggregation_and_one_sort_for_both_windows(spark):
    from vigil.operators import cleanse
    from vigil.sources.fixture import load_raw_visits

    rep = outbreaks(cleanse(load_raw_visits(spark, "/root/testdata/sf0.001")), ordered=False)
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Sort [") == 1
