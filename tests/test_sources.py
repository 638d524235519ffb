"""Zone listing, CSV / JSON lines parsing and round trips."""

from __future__ import annotations

import os

import pytest

from vigil.schema import VISIT_RAW
from vigil.sinks import encode_json, write_csv
from vigil.sources import EmptyZoneError, read_csv, read_jsonl, require_files
from vigil.sources.messages import message_quality, parse_messages, valid_messages

HEADER = "patient_id,hospital,county,visit_date,disease,diagnosis_code"
LINE = "P-1,H,C,2024-01-05,Malaria,B50"


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_suffix_filter_flat_and_recursive(spark, tmp):
    for name in ["a.csv", "B.CSV", "c.txt", "sub/d.csv"]:
        put(f"{tmp}/{name}", f"{HEADER}\n{LINE}\n")
    assert read_csv(spark, tmp, recursive=False).count() == 2
    assert read_csv(spark, tmp, recursive=True).count() == 3


def test_empty_zone_raises(spark, tmp):
    put(f"{tmp}/only.txt", "x\n")
    with pytest.raises(EmptyZoneError):
        read_csv(spark, tmp, recursive=False)
    os.makedirs(f"{tmp}/empty")
    with pytest.raises(EmptyZoneError):
        require_files(spark, f"{tmp}/empty", None, True)
    with pytest.raises(EmptyZoneError):
        require_files(spark, tmp, ("csv",), True)
    require_files(spark, tmp, ("TXT",), False)


def test_six_and_seven_column_files_mix(spark, tmp):
    put(f"{tmp}/old.csv", f"{HEADER}\n{LINE}\n")
    put(f"{tmp}/new.csv", f"{HEADER},event_time_utc\n{LINE},2024-01-05T10:00:00+00:00\n")
    got = sorted((r.event_time_utc or "") for r in read_csv(spark, tmp).collect())
    assert got == ["", "2024-01-05T10:00:00+00:00"]


def test_header_order_by_name(spark, tmp):
    put(f"{tmp}/swapped.csv", "county,patient_id\nNairobi,P-9\n")
    by_pos = read_csv(spark, tmp).first()
    assert by_pos.patient_id == "Nairobi"  # positional: swapped silently
    by_name = read_csv(spark, tmp, by_header=True).first()
    assert (by_name.patient_id, by_name.county, by_name.hospital) == ("P-9", "Nairobi", None)
    # More files, each with its own order and columns, and one without rows.
    put(f"{tmp}/more.csv", f"{HEADER},event_time_utc,note\n{LINE},2024-01-05T10:00:00+00:00,n\n")
    put(f"{tmp}/header_only.CSV", "disease,visit_date,patient_id\n")
    got = {r.patient_id: (r.county, r.disease, r.event_time_utc) for r in read_csv(spark, tmp, by_header=True).collect()}
    assert got == {"P-9": ("Nairobi", None, None), "P-1": ("C", "Malaria", "2024-01-05T10:00:00+00:00")}
    # A file without a header is an error, never a swap.
    put(f"{tmp}/bare.csv", f"{LINE}\n")
    with pytest.raises(Exception, match="no header"):
        read_csv(spark, tmp, by_header=True).collect()


def test_csv_round_trip_merges_empty_and_null(spark, tmp):
    df = spark.createDataFrame([("", "H", " C ", None, "D", "B50", None)], VISIT_RAW)
    write_csv(df, f"{tmp}/out", keep_padding=True)
    row = read_csv(spark, f"{tmp}/out").first()
    assert row.patient_id is None and row.visit_date is None
    assert row.county == " C "


def test_json_lines_bad_lines_dropped(spark, tmp):
    good = '{"patient_id":"P-1","visit_date":"2024-01-05","disease":"Malaria","diagnosis_code":"B50"}'
    lines = ["{bad", "123", "null", f"[{good}]", "", good, '  ' + good + '  ']
    put(f"{tmp}/z/a.jsonl", "\n".join(lines) + "\n")
    put(f"{tmp}/z/deep/b.JSONL", good + "\n")
    put(f"{tmp}/z/skip.txt", good + "\n")
    got = read_jsonl(spark, f"{tmp}/z", suffixes=("jsonl",)).collect()
    assert len(got) == 4 and {r.patient_id for r in got} == {"P-1"}


def test_arrays_of_visits_are_expanded_and_invalid_messages_marked(spark):
    values = ['[{"patient_id":"a"},{"patient_id":"b"}]', "[]", '{"patient_id":"c"}', "[1]", "{bad", "null", "7", "",
              '[{"patient_id":"d"}', None, ' [ {"patient_id":"e"} ] ']
    df = spark.createDataFrame([(v,) for v in values], "value string")
    assert [r.patient_id for r in parse_messages(df).collect() if r.patient_id] == ["a", "b", "c", "e"]
    marked = parse_messages(df, mark_invalid=True).collect()
    assert [r.patient_id for r in marked if not r._invalid_message and r.patient_id] == ["a", "b", "c", "e"]
    assert sum(r._invalid_message for r in marked) == message_quality(df).first().invalid_messages >= 6


def test_json_trailing_text(spark):
    # A message is one JSON value and nothing after it.
    df = spark.createDataFrame([('{"patient_id":"a"} x',), ('{"patient_id":"b"} {"c":1}',), ('{"patient_id":"c"} \n',)], "value string")
    assert [r.patient_id for r in parse_messages(df).collect()] == ["c"]


def test_json_number_in_text_field(spark):
    df = spark.createDataFrame([('{"patient_id":5,"disease":"D"}',)], "value string")
    assert parse_messages(df).first().patient_id == "5"


def test_json_missing_key_is_null_and_dropped_by_cleanse(spark):
    from vigil.operators import cleanse

    df = spark.createDataFrame([('{"patient_id":"P","visit_date":"2024-01-05","disease":"D"}',)], "value string")
    parsed = parse_messages(df)
    assert parsed.first().diagnosis_code is None
    assert cleanse(parsed).count() == 0


def test_message_quality_counts(spark):
    from vigil.sources.fixture import load_visit_messages

    msgs = load_visit_messages(spark, "/root/testdata/sf0.001")
    q = message_quality(msgs).first()
    assert q.messages == q.valid_messages + q.invalid_messages
    assert q.valid_messages == valid_messages(msgs).count() == q.visits == 1020


def test_encode_json_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert encode_json(df).first().value == '{"x":"a","y":null}'


def test_curated_scan_prunes_partitions(spark, tmp):
    from vigil.operators import cleanse
    from vigil.sinks import write_curated
    from vigil.sources import read_curated
    from vigil.sources.fixture import load_raw_visits

    write_curated(cleanse(load_raw_visits(spark, "/root/testdata/sf0.001")), f"{tmp}/cur", "all")
    df = read_curated(spark, f"{tmp}/cur").filter("visit_date = DATE'2024-01-15' AND county = 'Kisumu'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(visit_date" in plan
    assert "PushedFilters: [IsNotNull(county), EqualTo(county,Kisumu)]" in plan
    assert df.count() > 0


def test_jsonl_sink_round_trip(spark, tmp):
    from vigil.sinks import write_jsonl
    from vigil.sources.fixture import load_raw_visits
    from tests_helpers import same_rows

    raw = load_raw_visits(spark, "/root/testdata/sf0.001")
    write_jsonl(raw, f"{tmp}/j")
    back = read_jsonl(spark, f"{tmp}/j", suffixes=("json",))
    assert same_rows(back, raw)


def test_csv_quoting_options(spark, tmp):
    put(f"{tmp}/q.csv", f'{HEADER}\n"P-1","Mama ""Lucy"" Clinic","C, West",2024-01-05,Malaria,B50\n')
    row = read_csv(spark, tmp, options={"escape": '"'}).first()
    assert (row.hospital, row.county, row.disease) == ('Mama "Lucy" Clinic', "C, West", "Malaria")
