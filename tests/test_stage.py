"""End-to-end: files in a folder -> staged tables -> log -> status -> retry."""

import datetime as dt
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from quayside.operators import loads, status
from quayside.plans import calendar, catalog, expected, monitor, sync
from quayside.plans.log import current_log, read_log
from quayside.plans.stage import StageOptions, manifest_of, stage_files, table_path
from quayside.sources.listing import list_files
from quayside.streaming.ingest import file_stream, ingest
from tests.test_plans import FIELD, FILE, PARAM, field_row, file_row, param_row

AS_OF = dt.datetime(2024, 1, 10, 12)


class Site:
    """A stage folder with its configuration."""

    def __init__(self, spark, root, files, fields, params, **options):
        self.spark, self.root = spark, str(root)
        fl, fd = spark.createDataFrame(files, FILE), spark.createDataFrame(fields, FIELD)
        pm = sync.prepare_parameters(spark.createDataFrame(params, PARAM))
        self.catalog = expected.dataset_catalog(pm, catalog.feed_rollup(catalog.field_catalog(fl, fd, "DVLP_SALES")))
        ends = spark.sql("SELECT date '2024-01-01' AS a, date '2024-01-31' AS z")
        self.calendar = calendar.calendar(ends, spark.createDataFrame([], "d date"))
        self.expected = expected.at_cob(expected.with_cobs(self.catalog, self.calendar, F.lit(AS_OF), 180))
        self.options = StageOptions(f"{self.root}/in", f"{self.root}/out", f"{self.root}/log", **{"allow_create": True, **options})

    def write(self, name, text, encoding="windows-1252"):
        path = f"{self.root}/in/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding=encoding, newline="") as f:
            f.write(text)

    def stage(self, regex=None, as_of=AS_OF, include_empty=False, **changes):
        files = list_files(self.spark, f"{self.root}/in", regex, include_empty=include_empty)
        manifest = manifest_of(files, f"{self.root}/in")
        out = stage_files(self.spark, manifest, self.expected, replace(self.options, **changes), F.lit(as_of))
        return {(r["dataset_name"], r["process_parameters"]["file_name"]): r for r in out.collect()}

    def rows(self, table, *columns, where="true"):
        df = self.spark.read.option("mergeSchema", True).parquet(table_path(self.options, table))
        return sorted(tuple(r) for r in df.where(where).select(*columns).collect())


FIELDS = [field_row("Id", 1, "NUMERIC", precision=10), field_row("Day", 2, "DATE"), field_row("Note", 3)]


def test_csv_by_header_with_lineage(spark, tmp_path):
    site = Site(spark, tmp_path, [file_row()], FIELDS, [param_row()])
    site.write("in/20240105/f1.csv", 'ï»¿day,"ID",extraCol,note\r\n05/01/2024,7,12,"é, ""q"""\r\n06/01/2024,,x,\r\n')
    loads_ = site.stage()
    entry = loads_["ds", "f1.csv"]
    assert entry["process_status"] == "SUCCESS" and entry["cob_id"] == 20240105
    assert entry["process_result"]["msg_copy_result"][0]["rows_loaded"] == 2
    assert entry["process_parameters"]["event_trigger"] == {"Adf": "none"} and entry["blob_file"]["file_count"] == 1
    got = site.rows("STAGING.SYS_T", "file_row_number", "T_Id", "T_Day", "T_Note", "EXTRA_COL", "file_name", "cob_id", "scope.region", "staged_at")
    name = "in/20240105/f1.csv"
    assert got == [
        (1, 7, dt.date(2024, 1, 5), 'é, "q"', "12", name, 20240105, "EU", AS_OF),
        (2, None, dt.date(2024, 1, 6), None, "x", name, 20240105, "EU", AS_OF),
    ]
    assert [r["process_status"] for r in read_log(spark, site.options.log_path).orderBy("logged_at").collect()] == ["RUNNING", "SUCCESS"]


def test_staging_twice_gives_the_same_rows(spark, tmp_path):
    site = Site(spark, tmp_path, [file_row()], FIELDS, [param_row()])
    site.write("in/20240105/f1.csv", "Id,Day,Note\n1,05/01/2024,a\n")
    site.write("in/20240105/f2.csv", "Note,Id\nb,2\n")
    for _ in range(2):
        site.stage()
        assert site.rows("STAGING.SYS_T", "T_Id", "T_Note", "file_row_number") == [(1, "a", 1), (2, "b", 1)]


def test_reload_by_file_and_second_file(spark, tmp_path):
    site = Site(spark, tmp_path, [file_row(by_file=True)], FIELDS, [param_row()])
    site.write("in/20240105/f1.csv", "Id,Day,Note\n1,05/01/2024,a\n")
    site.stage()
    site.write("in/20240105/f2.csv", "Id,Day,Note\n2,05/01/2024,b\n")
    site.stage("f2")
    site.write("in/20240105/f1.csv", "Id,Day,Note\n9,05/01/2024,z\n")
    site.stage("f1")
    assert site.rows("STAGING.SYS_T", "T_Id", "T_Note") == [(2, "b"), (9, "z")]


def test_error_policy_and_known_failures(spark, tmp_path):
    files = [file_row("strict", table="A"), file_row("skip2", skip=2, table="B"), file_row("lost", "NOPE", table="C")]
    fields = [field_row("Id", 1, "NUMERIC", feed=f, precision=5) for f in ("strict", "skip2", "lost")]
    params = [param_row("s", "/s/|:YYYYMMDD:|/", feed="strict"), param_row("k", "/k/|:YYYYMMDD:|/", feed="skip2"), param_row("l", "/l/|:YYYYMMDD:|/", feed="lost")]
    site = Site(spark, tmp_path, files, fields, params)
    bad = "Id\n1\nx\n"
    site.write("s/20240105/f.csv", bad)
    site.write("k/20240105/f_one.csv", bad)
    site.write("k/20240105/f_two.csv", bad + "y\n2,3\n")
    site.write("l/20240105/f.csv", bad)
    site.write("zzz/f.csv", bad)
    got = site.stage()
    assert got["s", "f.csv"]["process_status"] == "FAILED" and "1 bad rows" in got["s", "f.csv"]["process_result"]["exception"]
    one, two = (got["k", f]["process_result"]["msg_copy_result"][0] for f in ("f_one.csv", "f_two.csv"))
    assert (one["status"], one["rows_loaded"], one["errors_seen"]) == ("LOADED", 1, 1)
    assert (two["status"], two["rows_loaded"], two["rows_parsed"], two["errors_seen"]) == ("LOAD_SKIPPED", 0, 4, 3)
    assert site.rows("STAGING.SYS_B", "T_Id", "file_name") == [(1, "k/20240105/f_one.csv")]
    assert "File Format not found: NOPE" in got["l", "f.csv"]["process_result"]["exception"]
    assert got[None, "f.csv"]["process_result"]["exception"] == "There is no metadata for the folder/file: zzz/f.csv"


def test_creation_needs_permission(spark, tmp_path):
    site = Site(spark, tmp_path, [file_row()], FIELDS, [param_row()], allow_create=False)
    site.write("in/20240105/f.csv", "Id,Note\n1,a\n")
    assert "does not exist or not authorized" in site.stage()["ds", "f.csv"]["process_result"]["exception"]
    assert site.stage(allow_create=True)["ds", "f.csv"]["process_result"]["create_table_result"] == "Table created"
    site.write("in/20240105/f.csv", "Id,Note,newOne\n1,a,5\n")
    site.stage()
    assert "NEW_ONE" not in spark.read.parquet(table_path(site.options, "STAGING.SYS_T")).columns
    assert site.stage(allow_create=True)["ds", "f.csv"]["process_result"]["create_table_result"] == "Alter table executed"
    assert site.rows("STAGING.SYS_T", "T_Id", "NEW_ONE") == [(1, 5)]


def test_creation_is_for_development_only(spark, tmp_path):
    site = Site(spark, tmp_path, [file_row(skip=1)], FIELDS, [param_row()])
    site.write("in/20240105/f.csv", "Id,Note\nbad,a\n")
    assert site.stage()["ds", "f.csv"]["process_result"]["msg_copy_result"][0]["status"] == "LOAD_SKIPPED"
    site.write("in/20240105/f.csv", "Id,Note,extra\n1,a,b\n")
    refused = site.stage(database_target="PROD_SALES")["ds", "f.csv"]
    assert refused["process_status"] == "FAILED" and "does not exist" in refused["process_result"]["exception"]
    assert site.stage()["ds", "f.csv"]["process_status"] == "SUCCESS"
    kept = site.stage(database_target="PROD_SALES")["ds", "f.csv"]
    assert kept["process_status"] == "SUCCESS" and "only permitted" in kept["process_result"]["create_table_result"]
    assert site.rows("STAGING.SYS_T", "T_Id", "EXTRA") == [(1, "b")]


def test_empty_reload_clears_the_earlier_load(spark, tmp_path):
    site = Site(spark, tmp_path, [file_row()], FIELDS, [param_row()])
    site.write("in/20240105/f.csv", "Id,Note\n1,a\n")
    site.write("in/20240106/f.csv", "Id,Note\n2,b\n")
    site.stage()
    site.write("in/20240105/f.csv", "Id,Note\n")
    assert site.stage("20240105")["ds", "f.csv"]["process_status"] == "SUCCESS"
    assert site.rows("STAGING.SYS_T", "T_Id", "cob_id") == [(2, 20240106)]


def test_no_reload_and_positions_without_header_mapping(spark, tmp_path):
    site = Site(spark, tmp_path, [file_row()], FIELDS, [param_row(reload=False, infer=False)])
    site.write("in/20240105/f1.csv", "whatever,x,y\n1,05/01/2024,a\n")
    assert ("ds", "f1.csv") in site.stage()
    site.write("in/20240106/f2.csv", "h,h,h\n2,05/01/2024,b\n")
    again = site.stage()
    assert set(again) == {("ds", "f2.csv")}
    assert site.rows("STAGING.SYS_T", "T_Id", "T_Note") == [(1, "a"), (2, "b")]


def test_other_formats_and_several_datasets(spark, tmp_path):
    files = [file_row(f, fmt, table=f.upper()) for f, fmt in (("j", "JSON_FORMAT"), ("p", "PARQUET_FORMAT"), ("t", "TEXT_FORMAT"), ("n", "CSV_FORMAT_NO_HEADER"))]
    fields = [field_row("Id", 1, "NUMERIC", feed=f, precision=9) for f in "jpn"] + [field_row("line", 1, feed="t", length=50)]
    fields += [field_row("Both", 2, feed="n", in_source=False, derived="concat('x', c1)")]
    params = [param_row(f, f"/{f}/|:YYYYMMDD:|/", "*", feed=f) for f in "jptn"] + [param_row("n2", "/n/|:YYYYMMDD:|/", "*.csv", feed="n")]
    site = Site(spark, tmp_path, files, fields, params)
    site.write("j/20240105/a.json", '{"Id": 1}\n{"Id": ""}\n')
    spark.createDataFrame([(3,)], "Id int").coalesce(1).write.parquet(f"{site.root}/tmp")
    part = next(f for f in os.listdir(f"{site.root}/tmp") if f.endswith(".parquet"))
    os.makedirs(f"{site.root}/in/p/20240105")
    with open(f"{site.root}/tmp/{part}", "rb") as src, open(f"{site.root}/in/p/20240105/a.parquet", "wb") as dst:
        dst.write(src.read())
    site.write("t/20240105/a.txt", "head\nx,y\n\nz\n")
    site.write("n/20240105/a.csv", "4\n5\n")
    got = site.stage()
    assert {k[0] for k, r in got.items() if r["process_status"] == "SUCCESS"} == {"j", "p", "t", "n", "n2"}, [(k, r["process_result"]["exception"]) for k, r in got.items()]
    assert site.rows("STAGING.SYS_J", "file_row_number", "T_Id") == [(1, 1), (2, None)]
    assert site.rows("STAGING.SYS_P", "T_Id", "file_row_number") == [(3, 1)]
    assert site.rows("STAGING.SYS_T", "T_line", where="T_line is not null") == [("x,y",), ("z",)]
    assert site.rows("STAGING.SYS_N", "T_Id", "T_Both", "dataset_name") == [(4, "x4", "n"), (4, "x4", "n2"), (5, "x5", "n"), (5, "x5", "n2")]


def test_trigger_file_loads_its_folder(spark, tmp_path):
    site = Site(spark, tmp_path, [file_row(pattern="data_*.csv")], FIELDS, [param_row(file="go.txt", trigger=True)])
    for n in (1, 2):
        site.write(f"in/20240105/data_{n}.csv", f"Id,Note\n{n},a\n")
    site.write("in/20240105/other.csv", "Id\n9\n")
    site.write("in/20240105/go.txt", "")
    got = site.stage("go.txt", include_empty=True)
    assert got["ds", "go.txt"]["process_result"]["msg_copy_result"][0]["rows_loaded"] == 2
    assert site.rows("STAGING.SYS_T", "T_Id") == [(1,), (2,)]


def test_dirty_cells(spark, tmp_path):
    """Line ends and delimiters inside quotes, in the header too; text longer than its field."""
    site = Site(spark, tmp_path, [file_row(skip=1)], [field_row("a,b", 1), field_row("Note", 2, length=8)], [param_row()])
    site.write("in/20240105/f1.csv", '"a,b",note\n"line1\nline2",x\ny,"p,q"\nz,much longer than eight\n')
    result = site.stage()["ds", "f1.csv"]["process_result"]["msg_copy_result"][0]
    assert (result["rows_parsed"], result["rows_loaded"], result["errors_seen"]) == (3, 0, 1)
    site = Site(spark, tmp_path / "ok", [file_row(skip=2)], [field_row("a,b", 1), field_row("Note", 2, length=8)], [param_row()])
    site.write("in/20240105/f1.csv", '"a,b",note\n"line1\nline2",x\ny,"p,q"\nz,much longer than eight\n')
    site.stage()
    assert site.rows("STAGING.SYS_T", "`T_a,b`", "T_Note") == [("line1\nline2", "x"), ("y", "p,q")]


def test_columns_are_typed_by_all_rows(spark, tmp_path):
    site = Site(spark, tmp_path, [file_row()], [field_row("Id", 1)], [param_row()])
    site.write("in/20240105/f1.csv", "id,late\n" + "".join(f"{i},{i}\n" for i in range(10_003)) + "x,word\n")
    assert site.stage()["ds", "f1.csv"]["process_status"] == "SUCCESS"
    assert site.rows("STAGING.SYS_T", "LATE", where="T_Id = 'x'") == [("word",)]


def test_broken_json_is_an_error(spark, tmp_path):
    site = Site(spark, tmp_path, [file_row(fmt="JSON_FORMAT", skip=2)], [field_row("a", 1)], [param_row(file="*.json")])
    site.write("in/20240105/f.json", '{"a": "1"}\n{bad json\n{"a": "2"}\n', "utf-8")
    result = site.stage()["ds", "f.json"]["process_result"]["msg_copy_result"][0]
    assert (result["rows_parsed"], result["rows_loaded"], result["errors_seen"]) == (3, 2, 1)
    assert site.rows("STAGING.SYS_T", "T_a") == [("1",), ("2",)]


def test_parquet_without_declared_fields(spark, tmp_path):
    site = Site(spark, tmp_path, [file_row(fmt="PARQUET_FORMAT")], [field_row("other", 1)], [param_row(file="*.parquet")])
    spark.range(3).selectExpr("id", "cast(id as string) AS word").coalesce(1).write.parquet(f"{site.root}/in/in/20240105")
    (entry,) = site.stage(r"[.]parquet$").values()
    assert entry["process_status"] == "SUCCESS", entry["process_result"]["exception"]
    assert site.rows("STAGING.SYS_T", "ID", "WORD") == [(0, 0), (1, 1), (2, 2)]


def test_monitoring_loop(spark, tmp_path):
    site = Site(spark, tmp_path, [file_row()], FIELDS, [param_row(time="09:00:00")])
    site.write("in/20240105/f1.csv", "Id,Note\n1,a\n")
    site.write("in/20240105/f2.csv", "Id,Note\n2,b\n")
    site.stage("f1")
    log = current_log(spark, site.options.log_path)
    report = status.load_status(log, site.calendar, site.catalog, loads.outlier_bounds(loads.with_load_totals(log)), F.lit(AS_OF), 180).first()
    assert report["staging_progress"] == "Staging finished" and report["kpi_expected_end"] == "Overdue"
    assert report["expected_staging_timestamp"] == dt.datetime(2024, 1, 8, 9) and report["folder_path_cob"] == "/in/20240105/"
    later = dt.datetime(2124, 1, 1)
    listed = monitor.list_latest(spark, f"file:{site.root}/in", site.expected, log, F.lit(later), 3).withColumn("flag_last_version", F.lit(True))
    assert listed.where("name IS NOT NULL").count() == 2 and listed.where("name IS NULL").count() == 1
    monitor.list_and_retry(spark, listed, with_literal_names(site.expected, "f2.csv"), site.options, F.lit(later), 5)
    state = {r["process_parameters"]["file_name"]: r["process_status"] for r in current_log(spark, site.options.log_path).collect()}
    assert state == {"f1.csv": "SUCCESS", "f2.csv": "SUCCESS"}
    assert site.rows("STAGING.SYS_T", "T_Id") == [(2,)]


def with_literal_names(exp, name):
    return exp.withColumn("file_name", F.lit(name)).withColumn("file_name_cob", F.lit(name))


def test_stream_takes_each_file_once(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "id int, kind string"

    def run():
        ingest(file_stream(spark, source, schema), target, mark, partitions=["kind"]).awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(target).select("id", "kind").collect())

    os.makedirs(source)
    for n, rows in (("a", "1,x\n2,y\n"), ("b", "3,x\n")):
        with open(f"{source}/{n}.csv", "w") as f:
            f.write(rows)
        expected_rows = [(1, "x"), (2, "y")] if n == "a" else [(1, "x"), (2, "y"), (3, "x")]
        assert run() == expected_rows
    assert run() == [(1, "x"), (2, "y"), (3, "x")]


@pytest.mark.parametrize("root", ["file:///a/b", "/a/b", "file:/a/b/", "s3://bucket/a/b"])
def test_stage_root_forms(root):
    from quayside.plans.stage import _bare

    assert _bare(root) == "/a/b"
