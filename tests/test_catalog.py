"""The curated zone as a table: one external table a writer, a view of both; loads appear after a refresh."""

from __future__ import annotations

import pytest

from vigil.operators import cleanse
from vigil.sinks import write_curated, write_lines
from vigil.sources import (
    list_catalogs,
    list_databases,
    list_tables,
    read_curated,
    read_message_files,
    refresh_table,
    register_table,
    scan_table,
)
from vigil.sources.fixture import load_raw_visits, load_visit_messages
from vigil.streaming import run_to_end, stream_curate

SF = "/root/testdata/sf0.001"


def test_register_scan_and_refresh(spark, tmp):
    visits = cleanse(load_raw_visits(spark, SF))
    early = visits.filter("visit_date < DATE'2024-01-15'")
    late = visits.filter("visit_date >= DATE'2024-01-15'")
    loc = f"{tmp}/curated"
    write_curated(early, loc, "early")
    name = register_table(spark, loc, database="ph_test", table="visits")
    assert scan_table(spark, name).count() == early.count()
    write_curated(late, loc, "late")
    assert scan_table(spark, name).count() == early.count()  # not yet visible
    refresh_table(spark, name)
    assert scan_table(spark, name).count() == visits.count() == 566
    assert spark.sql("SHOW PARTITIONS ph_test.visits_batch").count() == visits.select("visit_date").distinct().count()
    # Idempotent on the same location, however it is written.
    for same in (loc, f"file://{loc}/", f"file:{loc}"):
        assert register_table(spark, same, database="ph_test", table="visits") == name
    assert "spark_catalog" in list_catalogs(spark)
    assert "ph_test" in list_databases(spark)
    assert list_tables(spark, "ph_test") == ["visits", "visits_batch"]


def test_batch_and_stream_output_are_one_table(spark, tmp):
    loc = f"{tmp}/curated"
    write_curated(cleanse(load_raw_visits(spark, SF)), loc, "all")
    name = register_table(spark, loc, database="ph_both", table="visits")
    write_lines(load_visit_messages(spark, SF), f"{tmp}/landing")
    run_to_end(stream_curate(read_message_files(spark, f"{tmp}/landing"), loc, f"{tmp}/ck"))
    assert read_curated(spark, loc).count() == 566 + 582
    refresh_table(spark, name)
    assert scan_table(spark, name).count() == 566 + 582
    assert list_tables(spark, "ph_both") == ["visits", "visits_batch", "visits_stream"]
    # More of either shows up after a refresh.
    write_curated(cleanse(load_raw_visits(spark, SF)).limit(5), loc, "five")
    write_lines(load_visit_messages(spark, SF), f"{tmp}/landing", mode="append")
    run_to_end(stream_curate(read_message_files(spark, f"{tmp}/landing"), loc, f"{tmp}/ck"))
    refresh_table(spark, name)
    assert scan_table(spark, name).count() == read_curated(spark, loc).count() == 566 + 5 + 2 * 582


def test_a_late_load_adds_to_its_date_and_a_repeated_one_replaces_itself(spark, tmp):
    visits = cleanse(load_raw_visits(spark, SF))
    loc = f"{tmp}/curated"
    write_curated(visits, loc, "first")
    one = visits.filter("visit_date = DATE'2024-01-05'").limit(1)
    for _ in range(2):
        write_curated(one, loc, "late")
        assert read_curated(spark, loc).count() == 567
    write_curated(visits.filter("visit_date = DATE'2024-01-10'"), loc, "first")
    assert read_curated(spark, loc).count() == visits.filter("visit_date = DATE'2024-01-10'").count() + 1


def test_a_streams_folder_is_refused(spark, tmp):
    write_lines(load_visit_messages(spark, SF), f"{tmp}/landing")
    run_to_end(stream_curate(read_message_files(spark, f"{tmp}/landing"), f"{tmp}/curated", f"{tmp}/ck"))
    with pytest.raises(ValueError, match="stream"):
        write_curated(cleanse(load_raw_visits(spark, SF)), f"{tmp}/curated/stream", "x")
    assert read_curated(spark, f"{tmp}/curated").count() == 582


def test_table_is_never_silently_repointed(spark, tmp):
    visits = cleanse(load_raw_visits(spark, SF))
    write_curated(visits, f"{tmp}/a", "all")
    write_curated(visits.filter("visit_date < DATE'2024-01-10'"), f"{tmp}/b", "all")
    name = register_table(spark, f"{tmp}/a", database="ph_repoint", table="visits")
    with pytest.raises(ValueError):
        register_table(spark, f"{tmp}/b", database="ph_repoint", table="visits")
    assert scan_table(spark, name).count() == 566
    register_table(spark, f"{tmp}/b", database="ph_repoint", table="visits", replace=True)
    assert scan_table(spark, name).count() == visits.filter("visit_date < DATE'2024-01-10'").count()
    assert read_curated(spark, f"{tmp}/a").count() == 566  # dropping the external table kept its files
