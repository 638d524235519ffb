"""Streams share the batch transforms: same rows, and restarts add none."""

from __future__ import annotations

from tests_helpers import same_rows

from vigil.operators import cleanse, curate
from vigil.sinks import write_lines
from vigil.sources import parse_messages, read_curated, read_message_files
from vigil.sources.fixture import load_visit_messages
from vigil.streaming import run_to_end, stream_curate, stream_raw
from vigil.streaming.ingest import QUALITY_METRICS

SF = "/root/testdata/sf0.001"


def _lanes(spark, tmp):
    landing, raw, cur = f"{tmp}/landing", f"{tmp}/raw", f"{tmp}/curated"
    write_lines(load_visit_messages(spark, SF).repartition(3), landing)
    run_to_end(stream_raw(read_message_files(spark, landing, 1), raw, f"{tmp}/ck/raw"))
    q = run_to_end(stream_curate(read_message_files(spark, raw, 1), cur, f"{tmp}/ck/cur"))
    return landing, raw, cur, q


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp):
    landing, raw, cur, q = _lanes(spark, tmp)
    batch = curate(cleanse(parse_messages(load_visit_messages(spark, SF))))
    streamed = read_curated(spark, cur)
    assert streamed.count() == 582
    assert same_rows(streamed, batch)
    assert spark.read.text(raw).count() == load_visit_messages(spark, SF).count()
    # Restart both queries on their checkpoints: nothing new arrives, nothing is rewritten.
    run_to_end(stream_raw(read_message_files(spark, landing, 1), raw, f"{tmp}/ck/raw"))
    run_to_end(stream_curate(read_message_files(spark, raw, 1), cur, f"{tmp}/ck/cur"))
    assert read_curated(spark, cur).count() == 582


def test_stream_reports_quality_per_batch(spark, tmp):
    _, _, _, q = _lanes(spark, tmp)
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 3  # one file per trigger
    totals = [p["observedMetrics"][QUALITY_METRICS] for p in batches]
    assert sum(int(m["rows_after"]) for m in totals) == 582
    assert sum(int(m["rows_before"]) for m in totals) == 1020 + 120
    assert sum(int(m["invalid_messages"]) for m in totals) == 120


def test_a_hot_date_is_written_by_several_tasks_and_others_by_one(spark, tmp):
    import glob
    import json

    def visit(i: int, day: int) -> str:
        return json.dumps({"patient_id": f"p{i}-{'x' * 200}", "visit_date": f"2024-01-{day:02d}", "disease": "Malaria",
                           "diagnosis_code": "B50"})

    days = [5] * 45_000 + [day for day in range(6, 16) for _ in range(20)]
    messages = spark.createDataFrame([(visit(i, d),) for i, d in enumerate(days)], "value string")
    write_lines(messages.repartition(8), f"{tmp}/landing")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "128k")
    try:
        run_to_end(stream_curate(read_message_files(spark, f"{tmp}/landing"), f"{tmp}/cur", f"{tmp}/ck"))
    finally:
        spark.conf.unset(key)
    assert read_curated(spark, f"{tmp}/cur").count() == len(days)
    files = {d: len(glob.glob(f"{tmp}/cur/stream/visit_date=2024-01-{d:02d}/*.parquet")) for d in range(5, 16)}
    # Dates that share the hot one's shuffle partition are split with it; the others are not.
    assert files[5] >= 3 and min(files[d] for d in range(6, 16)) == 1


def test_events_per_flush_and_time_trigger(spark, tmp):
    from vigil.streaming import Trigger

    landing, raw = f"{tmp}/landing", f"{tmp}/raw"
    messages = load_visit_messages(spark, SF)
    write_lines(messages.repartition(2), landing)
    # Long-running query flushing on a timer, as with FLUSH_BY_TIME; stopped once caught up.
    q = stream_raw(read_message_files(spark, landing, 1), raw, f"{tmp}/ck/raw", Trigger(processing_time="1 second"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    per_flush = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(per_flush) == 2 and sum(per_flush) == messages.count()
    assert spark.read.text(raw).count() == messages.count()


def test_report_over_stream_output_equals_batch(spark, tmp):
    from vigil.operators import outbreaks

    _, _, cur, _ = _lanes(spark, tmp)
    batch = outbreaks(cleanse(parse_messages(load_visit_messages(spark, SF))))
    streamed = outbreaks(read_curated(spark, cur))
    assert streamed.count() == 38
    assert same_rows(streamed, batch)
