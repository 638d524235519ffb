"""Outbreak report: daily counts, 7-row rolling sum, previous row, growth filter.

Plan shape (checked with ``explain``): scan (3 columns, partition column
free) -> partial hash aggregate -> exchange on (county, disease, visit_date)
-> final aggregate -> exchange on (county, disease) -> sort -> one Window
node for both the rolling sum and the lag -> filter. The first exchange
carries at most keys x map tasks rows thanks to the map-side partial
aggregate, so a county holding a third of all visits does not make a hot
task; the second carries one row per (county, disease, day).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.config import GROWTH_FACTOR, WINDOW_PRECEDING_ROWS

KEYS = ("county", "disease")
REPORT_COLUMNS = ("county", "disease", "visit_date", "cases_last_7_days")


def _by_pair_in_date_order():
    return Window.partitionBy(*KEYS).orderBy("visit_date")


def daily_counts(visits: DataFrame) -> DataFrame:
    """Cases per county, disease and visit date (null county is its own group)."""
    return visits.groupBy(*KEYS, "visit_date").agg(F.count(F.lit(1)).alias("cases"))


def rolling_cases(daily: DataFrame, preceding_rows: int = WINDOW_PRECEDING_ROWS) -> DataFrame:
    """Sum of the current and ``preceding_rows`` earlier *rows* (observed days, not calendar days)."""
    frame = _by_pair_in_date_order().rowsBetween(-preceding_rows, Window.currentRow)
    return daily.withColumn("cases_last_7_days", F.sum("cases").over(frame))


def lag_rolling_cases(rolled: DataFrame) -> DataFrame:
    """The rolling sum one row earlier in the same pair; null on a pair's first row."""
    return rolled.withColumn("prev_7_day", F.lag("cases_last_7_days", 1).over(_by_pair_in_date_order()))


def growth_filter(lagged: DataFrame, factor: Decimal = GROWTH_FACTOR) -> DataFrame:
    """Strict growth: ``prev is not null and cur > prev * factor``, compared exactly as decimals."""
    prev = F.col("prev_7_day")
    return lagged.filter(prev.isNotNull() & (F.col("cases_last_7_days") > prev * F.lit(Decimal(factor))))


def order_report(df: DataFrame) -> DataFrame:
    """``ORDER BY visit_date, county, disease`` with nulls last."""
    return df.orderBy(
        F.col("visit_date").asc_nulls_last(), F.col("county").asc_nulls_last(), F.col("disease").asc_nulls_last()
    )


def alerts(daily: DataFrame, preceding_rows: int = WINDOW_PRECEDING_ROWS, factor: Decimal = GROWTH_FACTOR) -> DataFrame:
    """The report's rows, in no order, from daily counts."""
    return growth_filter(lag_rolling_cases(rolling_cases(daily, preceding_rows)), factor).select(*REPORT_COLUMNS)


def outbreaks(
    visits: DataFrame,
    preceding_rows: int = WINDOW_PRECEDING_ROWS,
    factor: Decimal = GROWTH_FACTOR,
    ordered: bool = True,
) -> DataFrame:
    """County/disease pairs whose rolling case count jumps from one observed day to the next.

    No warm-up guard: a pair's second row compares a two-day sum with a
    one-day sum, as the original report does.
    """
    report = alerts(daily_counts(visits), preceding_rows, factor)
    return order_report(report) if ordered else report
