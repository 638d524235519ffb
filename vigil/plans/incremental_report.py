"""The outbreak report kept up to date: only what new loads touch is counted again.

State, under one folder:

* ``partials``: the daily counts of each load of the curated zone, under the
  load's own name and version, so a load is counted once a version and a
  replaced load replaces its counts. The curate stream's output comes as
  micro-batches of a stream over its folder, each a load of its own here.
* ``report``: the report's rows, replaced by one switch.

A refresh counts the loads whose version is not in the state, takes the
county/disease pairs that these (or the versions they replace) hold, sums the
partials of those pairs and runs the windows over them; all other pairs keep
their rows. Every step is made anew from whole partials, so a refresh that
failed is simply run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.config import GROWTH_FACTOR, WINDOW_PRECEDING_ROWS
from vigil.loads import committed, current_versions, new_version, switch, version_path
from vigil.operators.report import alerts, daily_counts, order_report
from vigil.schema import REPORT, VISIT
from vigil.session import delete_path, list_folders, path_exists
from vigil.sources.files import BATCH, STREAM
from vigil.streaming.ingest import DRAIN, run_to_end

BUCKETS = 64  # partitions of a load's counts by pair, so that a refresh reads those of the changed pairs
_PAIR = ("county", "disease")
_PARTIAL = "county string, disease string, visit_date date, cases long, bucket int"


def _bucket() -> Column:
    return F.pmod(F.xxhash64(*_PAIR), F.lit(BUCKETS)).cast("int")


def _count(visits: DataFrame, root: str, load: str, version: str) -> None:
    """Daily counts of one load, whole before they count."""
    spark = visits.sparkSession
    path = version_path(root, load, version)
    delete_path(spark, path)  # a refresh that failed before its switch
    counts = daily_counts(visits).withColumn("bucket", _bucket())
    counts.repartition("bucket").write.partitionBy("bucket").parquet(path)
    switch(spark, root, load, version)


def _partials(spark: SparkSession, root: str, versions: list[tuple[str, str]]) -> DataFrame:
    paths = [version_path(root, load, version) for load, version in versions]
    if not paths:
        return spark.createDataFrame([], _PARTIAL)
    return spark.read.schema(_PARTIAL).option("basePath", root).parquet(*paths).select(
        "county", "disease", "visit_date", "cases", "bucket")


def _same_pair(left: DataFrame, right: DataFrame) -> Column:
    return left["county"].eqNullSafe(right["county"]) & left["disease"].eqNullSafe(right["disease"])


def _count_new(spark: SparkSession, curated: str, root: str) -> list[str]:
    """Counts every load, or new version of one, that has not been counted; their names."""
    batch = f"{curated}/{BATCH}"
    counted = current_versions(spark, root)
    new = {load: v for load, v in current_versions(spark, batch).items() if counted.get(load) != v}
    for load, version in new.items():
        _count(spark.read.schema(VISIT).parquet(version_path(batch, load, version)), root, load, version)
    names = list(new)
    if path_exists(spark, f"{curated}/{STREAM}"):
        def count(visits: DataFrame, batch_id: int) -> None:
            name = f"{STREAM}.{batch_id:012d}"
            _count(visits, root, name, new_version(name))
            names.append(name)

        stream = spark.readStream.schema(VISIT).parquet(f"{curated}/{STREAM}")
        writer = stream.writeStream.option("checkpointLocation", f"{root}-stream-checkpoint").foreachBatch(count)
        run_to_end(DRAIN.apply(writer).start())
    return names


def refresh_report(spark: SparkSession, curated_path: str, state_path: str, window: int = WINDOW_PRECEDING_ROWS,
                   factor=GROWTH_FACTOR) -> DataFrame:
    """Brings the report in ``state_path`` up to date with the curated zone; the ordered report.

    Equals ``outbreaks`` over the whole zone, whatever the order of loads,
    late visits and replaced loads included.
    """
    curated, state = curated_path.rstrip("/"), state_path.rstrip("/")
    root, out = f"{state}/partials", f"{state}/report"
    names = set(_count_new(spark, curated, root))
    now = current_versions(spark, root)
    reported = current_versions(spark, out).get("report")
    # Loads that were counted by a refresh that failed before the report count as changed too: see the report's mark.
    done = _reported_versions(spark, out, reported)
    names |= {load for load, v in now.items() if done.get(load) != v}
    if not names and reported:
        return order_report(_report(spark, out, reported))
    replaced = [(load, done[load]) for load in names if load in done and done[load] != now[load]]
    touched = _partials(spark, root, [(load, now[load]) for load in names] + [
        (load, v) for load, v in replaced if path_exists(spark, version_path(root, load, v))])
    lost = any(not path_exists(spark, version_path(root, load, v)) for load, v in replaced)
    pairs = touched.select(*_PAIR).distinct()
    totals = _partials(spark, root, list(now.items()))
    if lost or not reported:
        kept = spark.createDataFrame([], REPORT)  # counted from scratch
    else:
        buckets = [r.bucket for r in touched.select("bucket").distinct().collect()]  # at most BUCKETS
        totals = totals.filter(F.col("bucket").isin(buckets))
        totals = totals.join(pairs, _same_pair(totals, pairs), "left_semi")
        held = _report(spark, out, reported)
        kept = held.join(pairs, _same_pair(held, pairs), "left_anti")
    daily = totals.groupBy(*_PAIR, "visit_date").agg(F.sum("cases").alias("cases"))
    version = new_version("report")
    rows = kept.select(*REPORT.fieldNames()).union(alerts(daily, window, factor).select(*REPORT.fieldNames()))
    rows.write.parquet(version_path(out, "report", version))
    marks = [(load, v) for load, v in sorted(now.items())]
    spark.createDataFrame(marks, "load string, version string").coalesce(1).write.parquet(f"{out}/counted/{version}")
    switch(spark, out, "report", version)
    held = committed(spark, out, "report")["report"]
    for folder in list_folders(spark, f"{out}/counted"):
        if folder.rsplit("/", 1)[-1] not in held:
            delete_path(spark, folder)
    return order_report(_report(spark, out, version))


def _report(spark: SparkSession, out: str, version: str) -> DataFrame:
    return spark.read.schema(REPORT).parquet(version_path(out, "report", version))


def _reported_versions(spark: SparkSession, out: str, version: str | None) -> dict[str, str]:
    """The load versions that a version of the report holds (one short row a load)."""
    if version is None:
        return {}
    rows = spark.read.schema("load string, version string").parquet(f"{out}/counted/{version}")
    return {r.load: r.version for r in rows.collect()}
