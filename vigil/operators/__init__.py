"""DataFrame -> DataFrame operators: cleansing rules, curation and the outbreak report."""

from vigil.operators.rules import (
    cleanse,
    conform,
    drop_missing,
    keep_valid_codes,
    cleanse_observed,
    cleanse_observed_stream,
    parse_visit_date,
    quality,
    reject_reason,
    trim_fields,
)
from vigil.operators.curation import curate
from vigil.operators.report import daily_counts, growth_filter, lag_rolling_cases, outbreaks, rolling_cases

__all__ = [
    "cleanse",
    "conform",
    "curate",
    "daily_counts",
    "drop_missing",
    "growth_filter",
    "keep_valid_codes",
    "lag_rolling_cases",
    "cleanse_observed",
    "cleanse_observed_stream",
    "outbreaks",
    "parse_visit_date",
    "quality",
    "reject_reason",
    "rolling_cases",
    "trim_fields",
]
