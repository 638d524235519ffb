"""Curate: cleansed visits to the typed table shape (event time as an instant)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

from vigil.functions import strict_date, utc_instant
from vigil.operators.rules import conform
from vigil.schema import VISIT


def curate(df: DataFrame) -> DataFrame:
    """Type ``visit_date`` as a date and ``event_time_utc`` as a timestamp, then conform.

    Columns already typed are left alone; text that does not parse becomes
    null (no error under ANSI mode). Rows are never dropped here.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    if "visit_date" in types and not isinstance(types["visit_date"], DateType):
        df = df.withColumn("visit_date", strict_date(F.col("visit_date")))
    if isinstance(types.get("event_time_utc"), StringType):
        df = df.withColumn("event_time_utc", utc_instant(F.col("event_time_utc")))
    return conform(df, VISIT)
