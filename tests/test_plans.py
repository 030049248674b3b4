import datetime as dt
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quayside.functions.text import glob_like
from quayside.plans import calendar, catalog, expected, sync, validate

FILE = (
    "source_system_code string, source_feed_code string, stage_name string, source_file_path string, "
    "source_file_name_pattern string, destination_schema_name string, destination_table_name string, is_enabled boolean, "
    "file_format string, date_input_format string, timestamp_input_format string, skip_row_on_error int, "
    "delete_stage_by_file_name boolean, timezone string"
)
FIELD = (
    "source_system_code string, source_feed_code string, source_field_name string, target_field_name string, "
    "field_ordinal int, data_type_name string, data_type_length int, data_type_precision int, data_type_scale int, "
    "is_in_source boolean, is_in_target boolean, is_deleted boolean, derived_expression string"
)
PARAM = (
    "dataset_name string, container_name string, file_path string, file_name string, source_system_code string, "
    "source_feed_code string, is_enabled boolean, is_trigger_file boolean, allow_reload boolean, is_cloud_copy boolean, "
    "allow_infer_schema boolean, entity_code string, department_code string, region string, market string, "
    "expected_stage_time string, warehouse_size string, tags string"
)


def file_row(feed="f", fmt="CSV_FORMAT", path=None, pattern=None, skip=0, by_file=False, table="T", enabled=True):
    return ("SYS", feed, "EXT.IN", path, pattern, "STAGING", table, enabled, fmt, "DD/MM/YYYY", "DD/MM/YYYY HH24:MI:SS", skip, by_file, None)


def field_row(name, ordinal, kind="VARCHAR", feed="f", length=20, precision=0, scale=0, in_source=True, in_target=True, deleted=False, derived=None):
    return ("sys", feed, name, f"T_{name}", ordinal, kind, length if kind == "VARCHAR" else 0, precision, scale, in_source, in_target, deleted, derived)


def param_row(name="ds", path="/in/|:YYYYMMDD:|/", file="f*.csv", feed="f", enabled=True, trigger=False, reload=True, infer=True, container="", time=None):
    return (name, container, path, file, "SYS", feed, enabled, trigger, reload, False, infer, "E1", None, "EU", None, time, None, "a##b")


@pytest.fixture
def config(spark):
    def build(files, fields, params):
        fl = spark.createDataFrame(files, FILE)
        fd = spark.createDataFrame(fields, FIELD)
        pm = sync.prepare_parameters(spark.createDataFrame(params, PARAM))
        rollup = catalog.feed_rollup(catalog.field_catalog(fl, fd, "DVLP_SALES"))
        return expected.dataset_catalog(pm, rollup)

    return build


def span(spark, first, last):
    return spark.sql(f"SELECT date '{first}' AS a, date '{last}' AS z")


def test_calendar_equals_pandas_rule(spark):
    off = [dt.date(2024, 1, 1), dt.date(2024, 12, 25), dt.date(2024, 12, 26), dt.date(2024, 12, 27), dt.date(2025, 1, 1)]
    holidays = spark.createDataFrame([(d,) for d in off], "d date")
    got = calendar.calendar(span(spark, "2023-12-20", "2024-12-31"), holidays).orderBy("my_date").collect()
    assert len(got) == 378 and got[0]["cob_id"] == 20231220
    step = pd.offsets.CustomBusinessDay(1, holidays=[d for d in off if d.year == 2024])
    for r in got:
        assert r["next_business_day"] == (pd.Timestamp(r["my_date"]) + step).date()
        assert r["is_bank_holiday"] == (r["my_date"] in off)


def test_calendar_merge_and_span(spark):
    ends = calendar.default_span(spark.sql("SELECT date '2024-05-05' AS d")).first()
    assert tuple(ends) == (dt.date(2021, 1, 1), dt.date(2027, 12, 31))
    none = spark.createDataFrame([], "d date")
    week = calendar.calendar(span(spark, "2024-01-01", "2024-01-07"), none)
    then, now = dt.datetime(2020, 1, 1), dt.datetime(2024, 1, 1)
    stored = calendar.stored_calendar(week.where("cob_id <= 20240103")).withColumn("first_time_inserted", F.lit(then)).withColumn("last_modified", F.lit(then))
    out = calendar.merge_calendar(stored, week.where("cob_id >= 20240103"), F.lit(now)).orderBy("cob_id").collect()
    assert len(out) == 7
    assert [r["last_modified"] for r in out] == [then, then] + [now] * 5
    assert out[2]["first_time_inserted"] == then and out[6]["day_week_name"] == "Sun" and out[6]["day_of_week"] == 0


def test_feed_rollup(spark):
    files = spark.createDataFrame([file_row(), file_row("bare", "JSON_FORMAT")], FILE)
    fields = spark.createDataFrame(
        [
            field_row("b", 2, "NUMERIC", precision=18, scale=2),
            field_row("a", 1, feed="F", derived="trim(a)"),
            field_row("c", 2, "DATE"),
            field_row("x", 9, in_source=False, derived="current_date()"),
            field_row("y", 9, in_source=False),
            field_row("gone", 3, deleted=True),
            field_row("skip", 4, in_target=False),
            field_row("neg", -1),
        ],
        FIELD,
    )
    rows = {r["source_feed_code"]: r for r in catalog.feed_rollup(catalog.field_catalog(files, fields, "DVLP_SALES")).collect()}
    f = rows["f"]
    assert f["destination_full_table_name"] == "STAGING.SYS_T" and f["timezone"] == "Europe/London" and f["environment"] == "DVLP"
    assert f["list_column_name_source"] == ["a", "b", "c"] and f["list_column_name_target"] == ['"T_A"', '"T_B"', '"T_C"']
    assert f["list_create_column_name_target"] == ['"T_A" VARCHAR(20)', '"T_B" NUMERIC(18,2)', '"T_C" DATE', '"T_X" VARCHAR(20)', '"T_Y" VARCHAR(20)']
    assert f["list_derived_expression"] == ["trim(a)", "", ""] and f["list_source_reference"] == ["$1", "$2", "$2"]
    assert f["list_extra_field_name"] == ['"T_X"'] and f["list_extra_derived_expression"] == ["current_date()"]
    assert [x["source_field_name"] for x in f["fields"]] == ["a", "b", "c", "x", "y"] and f["has_field_data"]
    bare = rows["bare"]
    assert bare["has_field_data"] is False and bare["fields"] == [] and bare["list_column_name_source"] == []


def test_feed_rollup_is_shuffled_with_the_catalog(spark):
    """Fields are dealt to their feeds once; grouping them shuffles no row again."""
    files = spark.createDataFrame([file_row(), file_row("g")], FILE)
    fields = spark.createDataFrame([field_row("a", 1), field_row("b", 2, feed="G")], FIELD)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fields_of = catalog.field_catalog(files, fields, "DVLP_SALES")
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (fields_of, catalog.feed_rollup(fields_of))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert [p.count("Exchange hashpartitioning") for p in plans] == [2, 2]


def test_feeds_that_differ_by_case_only_stay_apart(spark):
    """Each has all fields of the code; fields of one place and name are ordered by their lists."""
    files = spark.createDataFrame([file_row("f", "PARQUET_FORMAT"), file_row("F")], FILE)
    fields = spark.createDataFrame([field_row("a", 1, "NUMERIC", precision=9), field_row("a", 1, "DATE"), field_row("a", 1, feed="F", derived="trim(a)")], FIELD)
    rows = {r["source_feed_code"]: r for r in catalog.feed_rollup(catalog.field_catalog(files, fields, "DVLP_SALES")).collect()}
    assert sorted(rows) == ["F", "f"]
    for r in rows.values():
        assert r["list_data_type_name"] == ["DATE", "NUMERIC(9)", "VARCHAR(20)"] and r["list_derived_expression"] == ["", "", "trim(a)"]
        assert [x["data_type_name"] for x in r["fields"]] == ["DATE", "NUMERIC", "VARCHAR"]
    assert rows["f"]["list_source_reference"] == ["$1:a"] * 3 and rows["F"]["list_source_reference"] == ["$1"] * 3


def test_expected_datasets(spark, config):
    days = calendar.calendar(span(spark, "2023-01-01", "2024-12-31"), spark.createDataFrame([], "d date"))
    cat = config([file_row(pattern="all_*.csv"), file_row("g")], [field_row("a", 1)], [param_row(), param_row("off", enabled=False), param_row("fix", "static", "x.csv", "g")])
    out = expected.at_cob(expected.with_cobs(cat, days, F.lit(dt.date(2024, 6, 30)), 180))
    assert out.count() == 2 * 181
    row = out.where("dataset_name = 'ds' AND cob_id = 20240630").first()
    assert row["folder_path_cob"] == "/in/20240630/" and row["source_file_name_pattern"] == "all_*.csv" and row["tags"] == ["a", "b"]
    assert row["scope"].asDict() == {"entity_code": "E1", "department_code": None, "region": "EU", "market": None}
    assert out.where("cob_id = 20240102").count() == 0 and out.where("cob_id = 20240103 OR cob_id = 19000101").count() == 4
    assert out.where("dataset_name = 'fix'").first()["file_name_no_extension"] == "x"


def test_match_is_the_theta_join(spark, config):
    days = calendar.calendar(span(spark, "2024-01-01", "2024-01-31"), spark.createDataFrame([], "d date"))
    cat = config(
        [file_row()],
        [],
        [param_row("plain"), param_row("wild", "/i_/|:YYYYMMDD:|/", "F?_|:YYYYMMDD:|*".replace("?", "")),
         param_row("boxed", container="sales"), param_row("root", "/", "*.csv"), param_row("static", "/in/", "s.csv")],
    )
    exp = expected.at_cob(expected.with_cobs(cat, days, F.lit(dt.date(2024, 1, 31)), 180))
    files = spark.createDataFrame(
        [("in/20240105/sub/", "f1.csv", ""), ("/IX//20240105", "fa20240105.csv", None), ("in/20240105", "F2.CSV", "test1-sales"),
         ("in", "s.csv", ""), ("other/20240105", "f1.csv", ""), ("", "q.csv", "")],
        "folder_path string, file_name string, container string",
    )
    rich = expected.enrich_manifest(files)
    got = {(r["folder_path"], r["file_name"], r["dataset_name"]) for r in expected.match_datasets(rich, exp).collect()}
    like = F.expr("upper(file_name) LIKE replace(upper(file_name_cob), '*', '%') AND concat('/', upper(source_folder), '/') LIKE concat(upper(folder_path_cob), '%')")
    same = F.coalesce(F.expr("nullif(f.container_name, '')"), F.lit("-")) == F.coalesce(F.expr("nullif(e.container_name, '')"), F.lit("-"))
    brute = rich.alias("f").join(exp.drop("file_name").alias("e"), (F.col("f.cob_id") == F.col("e.cob_id")) & like & same)
    assert got == {(r["folder_path"], r["file_name"], r["dataset_name"]) for r in brute.select("folder_path", "file_name", "dataset_name").collect()}
    assert ("in/20240105/sub/", "f1.csv", "plain") in got and ("in/20240105", "F2.CSV", "boxed") in got and ("in", "s.csv", "static") in got


def test_upload_plan(spark, config):
    days = calendar.calendar(span(spark, "2024-01-01", "2024-01-31"), spark.createDataFrame([], "d date"))
    files = [file_row(path="//srv/|:ENVIRONMENT:|/|:YYYYMM:|/"), file_row("none"), file_row("off", path="p", enabled=False)]
    cat = config(files, [], [param_row("b", file="b.csv"), param_row("a", file="a_|:YYYYMMDD:|.csv"), param_row("n", feed="none"), param_row("o", feed="off")])
    exp = expected.at_cob(expected.with_cobs(cat, days, F.lit(dt.date(2024, 1, 31)), 180))
    out = expected.upload_plan(spark.createDataFrame(files, FILE), exp, 20240105, "INT_SALES").collect()
    assert len(out) == 1
    assert out[0]["file_detail"] == '{"source_file_path":"//srv/int/202401/","destination_file_path":"/in/20240105/","file_list":["a_20240105.csv","b.csv"]}'


def test_validation(spark):
    files = spark.createDataFrame([file_row(), file_row(), file_row("g", "NOPE")], FILE)
    fields = spark.createDataFrame([field_row("a", 1), field_row("a", 2)], FIELD)
    params = spark.createDataFrame([param_row(), param_row()], PARAM)
    formats = spark.createDataFrame([("CSV_FORMAT",)], "n string")
    stages = spark.createDataFrame([("EXT.IN",)], "n string")
    with pytest.raises(ValueError) as e:
        validate.validate_metadata(files, fields, params, formats, stages)
    text = str(e.value)
    assert "file format: NOPE" in text and "source file:" in text and "source field:" in text and "target field:" in text and "dataset:" in text
    clean = [df.dropDuplicates(k) for df, k in ((files.limit(1), ["source_feed_code"]), (fields.limit(1), ["source_field_name"]), (params, ["dataset_name"]))]
    assert validate.validate_metadata(*clean, formats, stages) == "Metadata was successfully verified."


def test_sync_parameters(spark):
    now = dt.datetime(2024, 1, 1)
    seed = spark.createDataFrame([param_row(path=" in "), param_row("new", infer=None)], PARAM)
    stored = sync.prepare_parameters(seed.limit(0)).withColumn("first_time_inserted", F.lit(now)).withColumn("last_modified", F.lit(now))
    out = sync.sync_table("stage_me_parameters", stored, seed, F.lit(now)).orderBy("dataset_name").collect()
    assert [r["file_path"] for r in out] == ["/in/", "/in/|:YYYYMMDD:|/"]
    assert [r["allow_infer_schema"] for r in out] == [True, True] and out[0]["tags"] == ["a", "b"]


def test_sync_fields_trims_and_ignores_case(spark):
    then, now = dt.datetime(2020, 1, 1), dt.datetime(2024, 1, 1)
    shape = "source_system_code string, source_feed_code string, source_field_name string, field_ordinal int"
    stored = spark.createDataFrame([("S", "F", "fld", 1, then, then)], shape + ", first_time_inserted timestamp, last_modified timestamp")
    seed = spark.createDataFrame([("s", "f", " Fld ", 2)], shape)
    (row,) = sync.sync_table("source_field", stored, seed, F.lit(now)).collect()
    assert (row["source_field_name"], row["field_ordinal"], row["first_time_inserted"], row["last_modified"]) == ("Fld", 2, then, now)


def test_overall_config(spark):
    files = spark.createDataFrame([file_row(), file_row("alone")], FILE)
    fields = spark.createDataFrame([field_row("a", 1)], FIELD)
    params = spark.createDataFrame([param_row(), param_row("orphan", feed="zzz")], PARAM)
    params = params.withColumn("last_modified", F.lit(None).cast("timestamp")).withColumn("first_time_inserted", F.lit(None).cast("timestamp"))
    out = {(r["source_feed_code"], r["dataset_name"]): r for r in catalog.overall_config(catalog.field_catalog(files, fields, "DVLP_X"), params).collect()}
    assert set(out) == {("f", "ds"), ("alone", "N/A"), (None, "orphan")}
    assert out["f", "ds"]["task_list_name"] == "TASK_IN_CSV" and out["alone", "N/A"]["task_list_name"] is None
    assert out[None, "orphan"]["source_file_is_enabled"] is False


def test_views_and_sql_functions(spark):
    from quayside.functions.sql import register_functions
    from quayside.plans.views import register_views

    now = F.lit(dt.datetime(2024, 1, 20))
    empty = dt.datetime(2024, 1, 10)
    tables = {
        "source_file": spark.createDataFrame([file_row()], FILE),
        "source_field": spark.createDataFrame([field_row("a", 1)], FIELD),
        "stage_me_parameters": sync.prepare_parameters(spark.createDataFrame([param_row(time="09:00:00")], PARAM))
        .withColumn("last_modified", F.lit(empty)).withColumn("first_time_inserted", F.lit(empty)),
        "calendar": calendar.calendar(span(spark, "2024-01-01", "2024-01-31"), spark.createDataFrame([], "d date")),
        "load_log": spark.createDataFrame(
            [(1, 20240105, "ds", ({"file_stage_me": "in/20240105/f1.csv", "container_name": ""}), {"msg_copy_result": [{"rows_loaded": 5, "rows_parsed": 5}], "exception": None},
              "SUCCESS", empty, empty, {"file_list": [{"name": "x/f1.csv", "size": 3, "last_modified": "Wed, 03 Jan 2024 10:11:12 GMT"}]})],
            "id bigint, cob_id int, dataset_name string, process_parameters struct<file_stage_me:string,container_name:string>, "
            "process_result struct<msg_copy_result:array<struct<rows_loaded:bigint,rows_parsed:bigint>>,exception:string>, process_status string, "
            "start_timestamp timestamp, end_timestamp timestamp, blob_file struct<file_list:array<struct<name:string,size:bigint,last_modified:string>>>",
        ),
        "file_listing": spark.createDataFrame(
            [(20240105, "EXT.IN", "file:/x", "in/20240105/", "csv", "file:/x/in/20240105/f*.csv", empty, empty, True)],
            "cob_id int, stage_name string, stage_url string, folder string, file_extension string, name string, last_modified timestamp, process_timestamp timestamp, flag_last_version boolean",
        ),
        "outlier_bounds": spark.createDataFrame([("ds", 1.0, 1.0, 1.0, 0.0, 9.0, "[0 - 9]")], "dataset_name string, q_three double, q_one double, outlier_range double, lower_bound double, upper_bound double, bounds string"),
        "accounts": spark.createDataFrame([("bob", None, "r", 1), ("BOB", "Bob", None, 2)], "login_name string, display_name string, default_role string, last_success_login int"),
    }
    names = register_views(spark, tables, "DVLP_SALES", now)
    assert len(names) == 9
    row = spark.sql("SELECT * FROM vw_load_status").first()
    assert row["expected_rows_status"] == "OK [0 - 9]" and row["wait_for_staging_seconds"] == 568128 and row["kpi_expected_end"] == "Overdue"
    assert spark.sql("SELECT file_name FROM vw_unstaged_files").collect() == [("f*.csv",)]
    assert spark.sql("SELECT count(*) FROM vw_expected_datasets WHERE cob_id = 20240105").first()[0] == 1
    assert sorted(tuple(r) for r in spark.sql("SELECT user_name, display_name, default_role FROM vw_users").fillna("-").collect()) == [("BOB", "Bob", "r"), ("SYSTEM", "System", "-")]
    register_functions(spark)
    got = spark.sql("SELECT find_cob('in/20240105/f'), find_cob('f_20240105'), replace_cob_pattern('a|:YYYYMM:|_|:YYYYMMDD:|', 20240105), strip_empty('a||b|', '|')").first()
    assert tuple(got) == ("20240105", None, "a202401_20240105", "a|b")


def test_upload_request(spark):
    plan = spark.createDataFrame([("{}", "a")], "file_detail string, source_file_path string")
    assert tuple(expected.upload_request(plan, 20240105, "INT_X").first()) == ("{}", 20240105, "INT_X")


def test_many_datasets_of_one_folder_are_told_apart_by_a_key(spark):
    n = 1000
    rows = [("ds%d" % i, f"SALES_{i:04d}_*.csv") for i in range(n)]
    exp = spark.createDataFrame(rows, "dataset_name string, file_name_cob string").withColumns(
        {"cob_id": F.lit(20240105), "container_name": F.lit(""), "folder_path_cob": F.lit("/in/")}
    )
    files = spark.createDataFrame(
        [(20240105, "", "in/sub", f"sales_{i:04d}_x.csv") for i in range(n)] + [(20240105, "", "in", "salesX0007Y.csv")],
        "cob_id bigint, container_name string, source_folder string, file_name string",
    )
    # a file is tested against its own dataset, not against every dataset of the folder
    assert expected.name_candidates(files, exp).count() == n + 1
    got = {(r["file_name"], r["dataset_name"]) for r in expected.match_datasets(files, exp).collect()}
    assert got == {(f"sales_{i:04d}_x.csv", f"ds{i}") for i in range(n)} | {("salesX0007Y.csv", "ds7")}


NAMES = ["", "a", "A_b", "ab", "a%b", "ab.csv", "xab.csv", "a\\b", "aXb.csv", "ä_b", "AÄb", "a\nb", "𝒳ab", "aab"]
PATTERNS = ["", "*", "a*", "A_b*", "_b", "a%", "a_b.csv", "*ab*", "__*", "ab", "Ä_*", "𝒳_*", "a*b_", "___b*"]


def test_match_equals_like_on_every_pair(spark):
    files = spark.createDataFrame([(1, "", "in", x) for x in [*NAMES, None, "ab"]], "cob_id bigint, container_name string, source_folder string, file_name string")
    exp = spark.createDataFrame([(1, "", "/in/", x) for x in [*PATTERNS, None]], "cob_id int, container_name string, folder_path_cob string, file_name_cob string")
    got = sorted((r["file_name"], r["file_name_cob"]) for r in expected.match_datasets(files, exp).collect())
    pairs = spark.createDataFrame([(x, p) for x in [*NAMES, "ab"] for p in PATTERNS], "x string, p string")
    want = sorted((r["x"], r["p"]) for r in pairs.where(glob_like("x", "p")).collect())
    assert got == want and len(want) > 40


def test_upload_chunks(spark):
    files = [("S", f"f{i}", True, "src/" if i else "") for i in range(3)]
    feeds = spark.createDataFrame(files, "source_system_code string, source_feed_code string, is_enabled boolean, source_file_path string")
    names = [("S", "f1", 7, f"n{i}.csv", "/land/") for i in range(100)] + [("S", "f2", 7, "again.csv", "/land/")] * 50 + [("S", "f2", 7, "b.csv", "/other/")]
    exp = spark.createDataFrame(
        [*names, ("S", "f0", 7, "gone.csv", "/land/"), ("S", "f1", 8, "late.csv", "/land/")],
        "source_system_code string, source_feed_code string, cob_id int, file_name_cob string, folder_path_cob string",
    )
    out = expected.upload_chunks(feeds, exp, 7, "INT_SALES", limit=20, together=9).collect()
    for folder, n in [("/land/", 150), ("/other/", 1)]:
        mine = [json.loads(r["file_detail"]) for r in out if r["destination_file_path"] == folder]
        assert sorted(d["chunk"] for d in mine) == list(range(1, -(-n // 20) + 1))
        assert {d["n_chunks"] for d in mine} == {-(-n // 20)}
        assert all(len(d["file_list"]) == 20 for d in mine if d["chunk"] < d["n_chunks"])
        assert sorted(x for d in mine for x in d["file_list"]) == sorted(x[3] for x in names if x[4] == folder)
    plan = expected.upload_chunks(feeds, exp.limit(0), 7, "INT_SALES", limit=20)
    assert plan.count() == 0
