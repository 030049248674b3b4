"""Streams, table versions and increments: replays, late events, concurrent writers."""

import datetime as dt
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from contract import streams
from quayside.operators import loads as load_ops
from quayside.operators.increments import merge_counts, read_counts, refresh_from_increment, write_increment
from quayside.plans.log import current_log, read_log
from quayside.plans.stage import stage_files
from quayside.sources import versions
from quayside.streaming.staging import BatchLedger, file_arrivals, stage_arrivals
from quayside.streaming.windows import closed_windows, keep_windows, read_windows, windowed_counts
from tests.oracle import compare
from tests.test_stage import FIELDS, Site, file_row, param_row


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ------------------------------------------------------------------ staging stream


@pytest.fixture
def site(spark, tmp_path):
    return Site(spark, tmp_path, [file_row(skip=2)], FIELDS, [param_row()])


def run(site, stage=stage_files, per_batch=None, available_now=True):
    arrivals = file_arrivals(site.spark, f"{site.root}/in", "*.csv", per_batch)
    query = stage_arrivals(arrivals, site.expected, site.options, f"{site.root}/mark", f"{site.root}/ledger", available_now=available_now, stage=stage)
    query.awaitTermination()


def test_batches_of_one_load_add_up(spark, site):
    """Two files of a COB and dataset arrive in different batches; one with too many bad rows is left out."""
    site.write("in/20240105/f1.csv", "Id,Note\n1,a\n")
    run(site)
    site.write("in/20240105/f2.csv", "Id,Note\n2,b\n")
    site.write("in/20240105/f_bad.csv", "Id,Note\nx,b\ny,c\n3,d\n")
    run(site)
    assert site.rows("STAGING.SYS_T", "T_Id") == [(1,), (2,)]
    log = current_log(spark, site.options.log_path).select("process_parameters.file_name", "process_status", "process_result").collect()
    state = {r["file_name"]: (r["process_status"], r["process_result"]["exception"] or r["process_result"]["msg_copy_result"][0]["status"]) for r in log}
    assert state == {"f1.csv": ("SUCCESS", "LOADED"), "f2.csv": ("SUCCESS", "LOADED"), "f_bad.csv": ("SUCCESS", "LOAD_SKIPPED")}


@pytest.mark.parametrize("after", [False, True])
def test_interrupted_batch_is_staged_again(spark, site, after):
    site.write("in/20240105/f1.csv", "Id,Note\n1,a\n")
    site.write("in/20240105/f2.csv", "Id,Note\n2,b\n")

    def stops(*args):
        if after:
            stage_files(*args)
        raise InterruptedError

    with pytest.raises(Exception, match="InterruptedError"):
        run(site, stops)
    book = BatchLedger(spark, f"{site.root}/ledger")
    assert book.has(0, "begun") and not book.has(0, "done")
    began = book.begin(0, 99)
    run(site)
    assert site.rows("STAGING.SYS_T", "T_Id") == [(1,), (2,)]
    log = current_log(spark, site.options.log_path)
    assert log.count() == 2 and {r[0] for r in log.select("start_timestamp").collect()} == {began}
    assert book.has(0, "done") and book.entries().count() == 2


def test_done_batch_is_not_staged_again(spark, site):
    site.write("in/20240105/f1.csv", "Id,Note\n1,a\n")
    book = BatchLedger(spark, f"{site.root}/ledger")
    book.write(0, "done", dt.datetime(2024, 1, 1), 1)
    run(site)
    assert read_log(spark, site.options.log_path).count() == 0


def event_tables(spark, root, bad_of_type):
    """Eight events of each type on one day, so many of them with a value that cannot be read."""
    at = dt.datetime(2024, 1, 5, 8)
    rows = [(8 * t + i, at, 5 if i < bad else 6, kind, 1.5) for t, (kind, bad) in enumerate(bad_of_type.items()) for i in range(8)]
    table = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double")
    table.coalesce(1).write.parquet(f"{root}/events.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{root}/events.parquet/*.parquet')")
    return duck


def test_stream_whose_files_are_all_left_out(spark, tmp_path):
    """No row is staged, so no file says what columns the table has."""
    duck = event_tables(spark, tmp_path, {"click": streams.BAD_LIMIT, "view": 8})
    staged = streams.staging_stream(spark, str(tmp_path))
    assert staged.count() == 0 and compare(staged, duck, streams.SQL_STAGING_STREAM) == []


def test_stream_with_some_files_left_out_has_the_same_columns(spark, tmp_path):
    duck = event_tables(spark, tmp_path, {"click": streams.BAD_LIMIT, "view": streams.BAD_LIMIT - 1})
    staged = streams.staging_stream(spark, str(tmp_path))
    assert staged.count() == 9 - streams.BAD_LIMIT and compare(staged, duck, streams.SQL_STAGING_STREAM) == []


def test_log_of_a_stream_whose_files_are_all_left_out(spark, tmp_path):
    """The refused loads are in the log though nothing is staged."""
    duck = event_tables(spark, tmp_path, {"click": streams.BAD_LIMIT, "view": 8})
    log = streams.staging_stream_log(spark, str(tmp_path))
    assert {(r["dataset_name"], r["n_rows"], r["n_loaded"], r["n_bad"]) for r in log.collect()} == {("events_click", 8, 0, 6), ("events_view", 8, 0, 8)}
    assert compare(log, duck, streams.SQL_STAGING_STREAM_LOG) == []


# ------------------------------------------------------------------ windows


def events(spark, path, *rows):
    at = [(dt.datetime(2024, 1, 1, h, m), k) for h, m, k in rows]
    spark.createDataFrame(at, "at timestamp, k string").coalesce(1).write.mode("append").parquet(path)


def test_late_events_are_dropped_and_windows_close(spark, tmp_path):
    source, out, closed = (str(tmp_path / n) for n in ("in", "out", "closed"))

    def counted():
        stream = spark.readStream.schema("at timestamp, k string").parquet(source)
        return windowed_counts(stream, "at", ["k"], "1 hour")

    def both():
        keep_windows(counted(), out, f"{out}-mark").awaitTermination()
        closed_windows(counted(), closed, f"{closed}-mark").awaitTermination()

    events(spark, source, (8, 5, "a"), (8, 50, "a"), (9, 10, "b"))
    both()
    # 8:45 is within 30 minutes of 9:10 and its window is open; the watermark then goes to 10:30
    events(spark, source, (8, 45, "a"), (11, 0, "a"))
    both()
    events(spark, source, (8, 59, "a"), (10, 40, "a"))
    both()
    got = rows_of(read_windows(spark, out, ["k"]).select(F.hour("window_start"), "k", "n_events"))
    assert got == [(10, "a", 1), (11, "a", 1), (8, "a", 3), (9, "b", 1)]
    assert rows_of(spark.read.parquet(closed).select(F.hour("window_start"), "k", "n_events")) == [(8, "a", 3), (9, "b", 1)]


def test_windows_of_a_table(spark):
    table = spark.createDataFrame([(dt.datetime(2024, 1, 1, 8, 10),), (None,)], "at timestamp")
    assert windowed_counts(table, "at", slide="30 minutes").count() == 2


# ------------------------------------------------------------------ versions


def test_one_of_two_writers_wins(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.read_version(spark, root) is None and versions.current_version(spark, root) is None
    assert versions.publish_version(spark.range(2), root) == 1
    assert versions.publish_version(spark.range(3), root, after=1) == 2
    with pytest.raises(versions.VersionConflict):
        versions.publish_version(spark.range(9), root, after=1)
    assert versions.read_version(spark, root).count() == 3 and versions.read_version(spark, root, 1).count() == 2
    assert len([d for d in os.listdir(root) if d.startswith("v") and "-" in d]) == 2
    assert versions.drop_versions(spark, root) == [1]
    with pytest.raises(ValueError, match="dropped"):
        versions.read_version(spark, root, 1)


def test_schema_swap_keeps_open_readers(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.swap_schema(spark, root, {"a": "int", "b": "string"}) == [("a", "added", None, "int"), ("b", "added", None, "string")]
    assert versions.read_version(spark, root).count() == 0
    versions.publish_version(spark.createDataFrame([(1, "7"), (2, "x")], "a int, b string"), root)
    old = versions.read_version(spark, root)
    changes = versions.swap_schema(spark, root, {"B": "int", "c": "date"})
    assert sorted(c[:2] for c in changes) == [("B", "retyped"), ("a", "removed"), ("c", "added")]
    assert rows_of(old) == [(1, "7"), (2, "x")]
    assert rows_of(versions.read_version(spark, root)) == [(7, None), (None, None)]
    assert versions.swap_schema(spark, root, {"B": "int", "c": "date"}) == []
    assert versions.current_version(spark, root) == 3


# ------------------------------------------------------------------ increments


def test_increments_equal_the_full_run(spark, tmp_path):
    path = str(tmp_path / "counts")
    assert read_counts(spark, path) is None
    nights = [
        [("d", i % 7, "SUCCESS") for i in range(20)] + [("e", None, "SUCCESS"), ("e", 5, "FAILED")],
        [("d", 50, "SUCCESS"), (None, 3, "SUCCESS")] + [("f", i, "SUCCESS") for i in range(4)],
        [],
    ]
    bounds = None
    for i, night in enumerate(nights):
        new = spark.createDataFrame(night, "dataset_name string, rows_loaded bigint, process_status string")
        for _ in range(2):
            write_increment(new, path, str(i))
        bounds = refresh_from_increment(spark, path, str(i), bounds)
    every = spark.createDataFrame(sum(nights, []), "dataset_name string, rows_loaded bigint, process_status string")
    full = load_ops.outlier_bounds(every)
    assert rows_of(bounds.where("dataset_name is not null")) == rows_of(full.where("dataset_name is not null"))
    assert rows_of(merge_counts(read_counts(spark, path))) == rows_of(read_counts(spark, path))
