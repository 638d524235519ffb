"""The batch jobs end to end over zones on disk: CSV lane, JSON lane, curate, report."""

from __future__ import annotations

import datetime as dt

from vigil.config import LakeConfig
from vigil.plans.batch import cleanse_csv_zone, cleanse_jsonl_zone, curate_zone, daily_report, load_direct
from vigil.sinks import write_csv, write_lines
from vigil.sources import read_curated, register_table, scan_table
from vigil.sources.fixture import load_raw_visits, load_visit_messages

SF = "/root/testdata/sf0.01"


def test_csv_lane_counts_and_report(spark, tmp):
    cfg = LakeConfig(lake_root=tmp)
    write_csv(load_raw_visits(spark, SF), cfg.raw_path, keep_padding=True)
    res = cleanse_csv_zone(spark, cfg.raw_path, cfg.cleansed_path)
    # CSV turns '' into null, so the 5% blank patient ids are missing here.
    assert res.rows_before == 10000 and res.rows_after + res.rows_removed == 10000
    assert res.missing_required > 1500
    curate_zone(spark, cfg.cleansed_path, cfg.curated_path)
    assert read_curated(spark, cfg.curated_path).count() == res.rows_after
    path = daily_report(spark, cfg, f"{tmp}/reports", dt.date(2024, 2, 1))
    assert path.endswith("report_date=20240201")
    assert spark.read.option("header", True).csv(path).count() > 0


def test_json_lane_matches_the_fixture_counts(spark, tmp):
    cfg = LakeConfig(lake_root=tmp)
    write_lines(load_visit_messages(spark, SF).repartition(2), f"{cfg.raw_path}/2024")
    res = cleanse_jsonl_zone(spark, cfg.raw_path, cfg.cleansed_path, suffixes=None,
                             quality_path=f"{tmp}/quality")
    # 10,200 visits (200 of them in arrays) and a row for each invalid message that is not blank.
    assert (res.rows_before, res.rows_after, res.invalid_messages) == (10200 + 1000, 5736, 1000)
    assert res.rows_removed == res.missing_required + res.bad_date + res.invalid_code == 11200 - 5736
    per_file = spark.read.option("header", True).option("inferSchema", True).csv(f"{tmp}/quality/jsonl").collect()
    assert len(per_file) == 2 and sum(r.rows_after for r in per_file) == 5736
    assert sum(r.rows_before for r in per_file) == 11200


def test_direct_load_keeps_empty_ids_and_feeds_the_table(spark, tmp):
    cfg = LakeConfig(lake_root=tmp, database="ph_jobs")
    res = load_direct(load_raw_visits(spark, SF), cfg.curated_path)
    assert res.rows_after == 5580
    name = register_table(spark, cfg.curated_path, cfg.database, cfg.table)
    assert scan_table(spark, name).filter("patient_id = ''").count() > 0


def test_quality_per_file(spark, tmp):
    from pyspark.sql import functions as F

    from vigil.operators import quality
    from vigil.sources import read_csv

    write_csv(load_raw_visits(spark, SF).repartition(3, "county"), f"{tmp}/raw", keep_padding=True)
    per_file = quality(read_csv(spark, f"{tmp}/raw")).collect()
    assert len(per_file) == 3 and all(r.source.endswith(".csv") for r in per_file)
    assert sum(r.rows_before for r in per_file) == 10000
    total = quality(read_csv(spark, f"{tmp}/raw"), by=F.lit("all")).first()
    assert sum(r.rows_after for r in per_file) == total.rows_after


def test_command_line_jobs(spark, tmp, monkeypatch, capsys):
    import json

    from vigil.__main__ import main

    monkeypatch.setenv("LAKE_ROOT", tmp)
    monkeypatch.setenv("LAKE_DATABASE", "ph_cli")
    write_csv(load_raw_visits(spark, SF), f"{tmp}/raw", keep_padding=True)
    assert main(["cleanse-csv"]) == 0
    counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counts["rows_before"] == 10000
    assert main(["curate"]) == 0
    assert main(["register"]) == 0
    assert main(["report", "--report-date", "2024-02-01"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out.endswith("reports/report_date=20240201")


def test_command_line_stream_from_raw_and_catalog(spark, tmp, monkeypatch, capsys):
    import json

    from vigil.__main__ import main
    from vigil.sources import read_curated

    monkeypatch.setenv("LAKE_ROOT", tmp)
    monkeypatch.setenv("LAKE_DATABASE", "ph_cli_stream")
    write_lines(load_visit_messages(spark, "/root/testdata/sf0.001"), f"{tmp}/raw/stream")
    assert main(["stream-curate", "--from-raw", "--drain"]) == 0
    assert read_curated(spark, f"{tmp}/curated").count() == 582
    assert main(["register"]) == 0
    assert main(["catalog"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert "spark_catalog" in out["catalogs"] and "ph_cli_stream" in out["databases"]
    assert out["tables"] == ["patient_visits", "patient_visits_batch", "patient_visits_stream"]
    # A later batch over the stream output shows up after a refresh.
    from vigil.sources import refresh_table, scan_table

    write_lines(load_visit_messages(spark, "/root/testdata/sf0.001"), f"{tmp}/raw/stream", mode="append")
    assert main(["stream-curate", "--from-raw", "--drain"]) == 0
    refresh_table(spark, "ph_cli_stream.patient_visits")
    assert scan_table(spark, "ph_cli_stream.patient_visits").count() == 2 * 582


def test_batch_json_cleanse_of_a_stream_raw_zone(spark, tmp):
    import os

    from vigil.sources import read_message_files
    from vigil.streaming import run_to_end, stream_raw

    cfg = LakeConfig(lake_root=tmp)
    write_lines(load_visit_messages(spark, "/root/testdata/sf0.001"), f"{tmp}/landing")
    streamed = f"{cfg.raw_path}/stream"
    run_to_end(stream_raw(read_message_files(spark, f"{tmp}/landing"), streamed, f"{tmp}/ck"))
    # A stray part file of a failed micro-batch: not in the commit log, so never read.
    with open(f"{streamed}/part-99999-stray.txt", "w") as f:
        f.write('{"patient_id":"X","visit_date":"2024-01-05","disease":"D","diagnosis_code":"B50"}\n')
    assert os.path.isdir(f"{streamed}/_spark_metadata")
    res = cleanse_jsonl_zone(spark, cfg.raw_path, cfg.cleansed_path)
    assert (res.rows_before, res.rows_after, res.invalid_messages) == (1020 + 100, 582, 100)
    # Files that were put there by other means are read too.
    with open(f"{cfg.raw_path}/more.JSONL", "w") as f:
        f.write('[{"patient_id":"X","visit_date":"2024-01-05","disease":"D","diagnosis_code":"B50"}]\n')
    res = cleanse_jsonl_zone(spark, cfg.raw_path, cfg.cleansed_path)
    assert (res.rows_before, res.rows_after) == (1021 + 100, 583)


def test_empty_json_zone_fails_fast(spark, tmp):
    import os

    import pytest

    from vigil.sources import EmptyZoneError

    with pytest.raises(EmptyZoneError):
        cleanse_jsonl_zone(spark, f"{tmp}/missing", f"{tmp}/out")
    os.makedirs(f"{tmp}/raw/2024")
    with open(f"{tmp}/raw/2024/notes.txt", "w") as f:
        f.write("not a visit\n")
    with pytest.raises(EmptyZoneError):
        cleanse_jsonl_zone(spark, f"{tmp}/raw", f"{tmp}/out")


def test_command_line_lake_defaults_to_the_shared_folder(spark, monkeypatch):
    import pytest

    from vigil.__main__ import main
    from vigil.session import work_root
    from vigil.sources import EmptyZoneError

    monkeypatch.delenv("LAKE_ROOT", raising=False)
    with pytest.raises(EmptyZoneError) as err:
        main(["cleanse-csv"])  # nothing there yet: the error names the zone it looked at
    assert f"{work_root(spark)}/vigil-lake/raw" in str(err.value)


def test_lanes_keep_each_others_rows(spark, tmp):
    import os

    cfg = LakeConfig(lake_root=tmp)
    os.makedirs(f"{tmp}/raw/deep")
    names = "hospital,patient_id,visit_date,county,diagnosis_code,disease"
    with open(f"{tmp}/raw/a.CSV", "w") as f:
        f.write(names + "\n" + "".join(f"H,P-{i},2024-01-05,C,B50,Malaria\n" for i in range(7)))
    with open(f"{tmp}/raw/deep/b.jsonl", "w") as f:
        visit = '{"patient_id":"J-%d","visit_date":"2024-01-06","disease":"D","diagnosis_code":"B50"}'
        f.write(visit % 1 + "\n[" + visit % 2 + "," + visit % 3 + "]\n{broken\n\n7\n")
    csv = cleanse_csv_zone(spark, cfg.raw_path, cfg.cleansed_path, quality_path=f"{tmp}/quality")
    lines = cleanse_jsonl_zone(spark, cfg.raw_path, cfg.cleansed_path, quality_path=f"{tmp}/quality")
    assert (csv.rows_before, csv.rows_after) == (7, 7)
    assert (lines.rows_before, lines.rows_after, lines.invalid_messages) == (5, 3, 2)
    curate_zone(spark, cfg.cleansed_path, cfg.curated_path)
    got = read_curated(spark, cfg.curated_path).collect()
    assert len(got) == 10 and {r.hospital for r in got if r.patient_id.startswith("P")} == {"H"}
    late = load_direct(load_raw_visits(spark, "/root/testdata/sf0.001").limit(40), cfg.curated_path)
    curate_zone(spark, cfg.cleansed_path, cfg.curated_path)  # again: its own load is replaced, no other
    assert read_curated(spark, cfg.curated_path).count() == 10 + late.rows_after
    assert sorted(os.listdir(f"{tmp}/quality")) == ["csv", "jsonl"]


def test_a_zone_of_files_without_a_kept_row_is_no_error(spark, tmp):
    import os

    cfg = LakeConfig(lake_root=tmp)
    os.makedirs(cfg.raw_path)
    with open(f"{cfg.raw_path}/only_header.csv", "w") as f:
        f.write("patient_id,hospital,county,visit_date,disease,diagnosis_code\n")
    res = cleanse_csv_zone(spark, cfg.raw_path, cfg.cleansed_path)
    assert (res.rows_before, res.rows_after) == (0, 0)
    with open(f"{cfg.raw_path}/bad.csv", "w") as f:
        f.write("patient_id,hospital,county,visit_date,disease,diagnosis_code\nP,H,C,never,D,B50\n")
    assert cleanse_csv_zone(spark, cfg.raw_path, cfg.cleansed_path).rows_removed == 1
    curate_zone(spark, cfg.cleansed_path, cfg.curated_path)
    assert read_curated(spark, cfg.curated_path).count() == 0


def test_jobs_run_in_utc_whatever_the_session_says(spark, tmp, monkeypatch):
    from vigil.__main__ import main
    from vigil.sinks import write_csv as put

    monkeypatch.setenv("LAKE_ROOT", tmp)
    put(load_raw_visits(spark, "/root/testdata/sf0.001"), f"{tmp}/raw", keep_padding=True)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert main(["cleanse-csv"]) == 0 and main(["curate"]) == 0
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_work_folders_can_be_dropped_once_read(spark, tmp):
    import pytest

    from vigil.session import drop_work_dirs, path_exists, work_dir, work_dirs

    path = work_dir(spark, "dropped")
    spark.range(3).write.parquet(path)
    assert path_exists(spark, path) and path in work_dirs()
    drop_work_dirs(spark, [path])
    assert not path_exists(spark, path)
    with pytest.raises(ValueError):
        drop_work_dirs(spark, [tmp])  # never a folder that is not its own
