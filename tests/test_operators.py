import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.operators import compare, dedupe, errors, funnel, headers, loads, merge, profile, project, ranks, unstaged, usage

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


# ------------------------------------------------------------------ ranks, bounds


def brute_bounds(values):
    values = sorted(values, key=lambda v: (v is None, v))
    n = len(values)
    q3, q1 = ([None] + values)[math.floor(n * 0.75)], ([None] + values)[math.floor(n * 0.25)]
    return q3, q1


@FEW
@given(st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.integers(-50, 10**12))), min_size=1, max_size=40))
def test_quartiles_against_brute_force(spark, loads_):
    df = spark.createDataFrame([(g, v, "SUCCESS") for g, v in loads_], "dataset_name string, rows_loaded bigint, process_status string")
    got = {r["dataset_name"]: r for r in loads.outlier_bounds(df).collect()}
    for g in {g for g, _ in loads_}:
        q3, q1 = brute_bounds([v for h, v in loads_ if h == g])
        assert (got[g]["q_three"], got[g]["q_one"]) == (q3, q1)
        if q3 is not None and q1 is not None:
            assert got[g]["lower_bound"] >= 0 or q1 < 0 and got[g]["lower_bound"] == 0


def test_bounds_of_few_loads_and_text(spark):
    data = [("one", 5)] + [("three", v) for v in (1, 2, 3)] + [("many", v) for v in range(1000, 9000, 1000)]
    df = spark.createDataFrame([(d, v, "SUCCESS") for d, v in data] + [("many", 10**9, "FAILED")], "dataset_name string, rows_loaded bigint, process_status string")
    got = {r["dataset_name"]: r for r in loads.outlier_bounds(df).collect()}
    assert got["one"]["q_three"] is None and got["one"]["bounds"] is None
    assert got["three"]["q_three"] == 2 and got["three"]["lower_bound"] is None
    assert got["many"]["bounds"] == "[0 - 12,000]"


def test_ranks_of_a_hot_value_and_order(spark):
    # one group holds most rows and one value most of that group
    hot = spark.range(20000).select(F.lit("hot").alias("g"), F.when(F.col("id") < 15000, 7).otherwise(F.col("id")).alias("v"))
    cold = spark.createDataFrame([("cold", -3), ("cold", -3), ("cold", -100), ("cold", None)], "g string, v bigint")
    got = ranks.value_ranks(hot.unionByName(cold), ["g"], "v")
    first = got.where("g = 'hot' AND v = 7").first()
    assert (first["n_at_value"], first["first_rank"], first["last_rank"], first["group_rows"]) == (15000, 1, 15000, 20000)
    assert got.where("g = 'hot'").agg(F.max("last_rank")).first()[0] == 20000
    assert rows_of(got.where("g = 'cold'").select("v", "first_rank", "last_rank"), "first_rank") == [(-100, 1, 1), (-3, 2, 3), (None, 4, 4)]
    assert got.where("g = 'hot'").groupBy("first_rank").count().where("count > 1").count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 8, 11])
def test_ntile(spark, n):
    df = spark.range(1, n + 1)
    mine = [r[0] for r in df.select(ranks.ntile_of(F.col("id"), F.lit(n), 4)).collect()]
    assert mine == [r[0] for r in spark.sql(f"SELECT ntile(4) OVER (ORDER BY id) FROM range(1, {n + 1})").collect()]


def test_load_totals_and_latest_state(spark):
    log = spark.createDataFrame(
        [
            (1, "RUNNING", dt.datetime(2024, 1, 1), None),
            (1, "SUCCESS", dt.datetime(2024, 1, 2), {"msg_copy_result": [{"rows_loaded": 2, "rows_parsed": 3}, {"rows_loaded": 1, "rows_parsed": None}]}),
            (2, "FAILED", dt.datetime(2024, 1, 1), {"msg_copy_result": []}),
        ],
        "id int, process_status string, logged_at timestamp, process_result struct<msg_copy_result:array<struct<rows_loaded:int,rows_parsed:int>>>",
    )
    now = loads.latest_log(log)
    assert rows_of(now.select("id", "process_status")) == [(1, "SUCCESS"), (2, "FAILED")]
    assert rows_of(loads.load_totals(now)) == [(1, 3, 3)]
    assert rows_of(loads.with_load_totals(now).select("id", "rows_loaded")) == [(1, 3), (2, None)]


# ------------------------------------------------------------------ merge


def test_merge_upsert_conditions(spark):
    """Two keys, one of them null (never equal), a condition on both sides, and columns that only one of the steps may write."""
    target = spark.createDataFrame(
        [("n", 1, 10.0, "old"), ("n", 2, 20.0, "old"), ("s", 1, 30.0, "old"), (None, 1, 40.0, "old")], "area string, no int, amount double, note string"
    )
    source = spark.createDataFrame(
        [("n", 1, 11.0, "new"), ("n", 2, 5.0, "new"), ("w", 9, 90.0, "new"), (None, 1, 41.0, "new")], "area string, no int, amount double, note string"
    )
    larger = F.col("s.amount") > F.col("t.amount")
    out = merge.merge_upsert(target, source, ["area", "no"], update=["amount"], insert=["area", "no", "note"], matched_when=larger)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [
            ("n", 1, 11.0, "old"),  # larger: its amount only
            ("n", 2, 20.0, "old"), ("n", 2, None, "new"),  # not larger: unmatched, so both stay
            ("s", 1, 30.0, "old"), ("w", 9, None, "new"), (None, 1, 40.0, "old"), (None, 1, None, "new"),
        ],
        key=str,
    )


KEYED = st.dictionaries(st.integers(0, 8), st.integers(0, 3), max_size=6)


@FEW
@given(KEYED, KEYED)
def test_sync_makes_target_equal_and_is_idempotent(spark, old, new):
    then, now = dt.datetime(2020, 1, 1), dt.datetime(2024, 1, 1)
    target = spark.createDataFrame([(k, v, then, then) for k, v in old.items()], "k int, v int, first_time_inserted timestamp, last_modified timestamp")
    source = spark.createDataFrame(list(new.items()), "k int, v int")
    once = merge.merge_sync(target, source, ["k"], F.lit(now))
    twice = merge.merge_sync(once, source, ["k"], F.lit(now))
    assert rows_of(once) == rows_of(twice) == sorted((k, v, then if k in old else now, now) for k, v in new.items())
    actions = dict(rows_of(merge.sync_actions(target, source, ["k"])))
    assert actions == {k: "DISABLE" if k not in new else "UPDATE" if k in old else "INSERT" for k in {*old, *new}}


def test_conform_and_schema_changes(spark):
    df = spark.createDataFrame([(1, "x", "7")], "a int, b string, c string")
    out = merge.conform(df, {"A": "bigint", "c": "int", "b": "int", "d": "date"})
    assert out.dtypes == [("A", "bigint"), ("c", "int"), ("b", "int"), ("d", "date")]
    assert out.first() == (1, 7, None, None)
    assert merge.schema_changes({"a": "int", "b": "string"}, {"A": "bigint", "c": "int"}) == [
        ("A", "retyped", "int", "bigint"), ("c", "added", None, "int"), ("b", "removed", "string", None),
    ]


# ------------------------------------------------------------------ compare, dedupe, funnel


def test_compare(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "k int, v string, last_modified int")
    other = spark.createDataFrame([(1, "a", 9), (2, "x", 2), (4, None, 4)], "k int, v string, last_modified int")
    assert rows_of(compare.compare_tables(base, base, "b", "t")) == []
    assert rows_of(compare.compare_tables(base, other, "b", "t"), "k", "side") == [("b", 2, "b"), ("t", 2, "x"), ("b", 3, "c"), ("t", 4, None)]
    twice = base.unionByName(base.where("k = 1")).unionByName(base.where("k = 1"))
    assert rows_of(compare.compare_tables(twice, other.where("k = 1"), "b", "t"), "k") == [("b", 1, "a")] * 2 + [("b", 2, "b"), ("b", 3, "c")]
    assert rows_of(compare.compare_tables(base, twice, "b", "t")) == [("t", 1, "a")] * 2
    assert rows_of(compare.compare_cells(base, other, ["k"])) == [(2, "v", "b", "x"), (3, "v", "c", None)]


def test_dedupe(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c")], "k int, v string")
    assert rows_of(dedupe.duplicate_keys(df, ["k"])) == [(None, 2), (1, 2)]
    assert rows_of(dedupe.occurring_once(df)) == [(2, "b")]
    allowed = spark.createDataFrame([("a",), ("b",)], "x string")
    assert rows_of(dedupe.missing_references(df, "v", allowed)) == [("c",)]


@FEW
@given(st.lists(st.one_of(st.none(), st.integers(0, 10)), max_size=20), st.lists(st.integers(0, 10), min_size=1, max_size=4))
def test_funnel_never_grows(spark, values, limits):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    filters = [(f"v>{x}", F.col("v") > x) for x in limits]
    counts = [r["n_rows"] for r in funnel.filter_funnel(df, filters).orderBy("step").collect()]
    assert counts[0] == len(values) and counts == sorted(counts, reverse=True)
    assert counts[-1] == funnel.apply_filters(df, filters).count()


# ------------------------------------------------------------------ projection, errors


def test_typed_projection(spark):
    df = spark.createDataFrame(
        [("1", "2024-13-01", "01/07/2024 12:00:00.000", "abcdef", None), ("", "", "", "", None), ("x", "05/01/2024", "", "q", "x,05/01/2024,,q,extra")],
        "c1 string, c2 string, c3 string, c4 string, _corrupt string",
    )
    fields = [
        project.Field("Num", "num", 1, "NUMERIC", precision=10),
        project.Field("Day", "day", 2, "DATE"),
        project.Field("At", "at", 3, "DATETIME"),
        project.Field("Txt", "txt", 4, "VARCHAR", length=3),
        project.Field("Txt", "upper_txt", 4, derived="upper(Txt)"),
        project.Field("Out", "out", 5, in_target=False),
        project.Field("Const", "const", 9, in_source=False, derived="concat('k', '1')"),
    ]
    out = project.typed_projection(df, fields)
    assert out.columns == ["num", "day", "at", "txt", "upper_txt", "const", "_bad"]
    first, second, third = out.collect()
    assert (first["num"], first["day"], first["txt"], first["upper_txt"], first["const"]) == (1, None, None, "ABCDEF", "k1")
    assert first["at"] == dt.datetime(2024, 7, 1, 11) and first["_bad"]
    assert second["num"] is None and second["upper_txt"] is None and not second["_bad"]
    assert third["day"] == dt.date(2024, 1, 5) and third["_bad"]


def test_error_policy(spark):
    df = spark.createDataFrame([("a", False), ("b", True), ("b", False), ("c", True), ("c", True), ("c", False)], "file string, bad boolean")
    assert rows_of(errors.apply_error_policy(df, "file", "bad", 2)) == [("a", False), ("b", False)]
    assert rows_of(errors.apply_error_policy(df, "file", "bad", 1)) == [("a", False)]
    assert errors.apply_error_policy(df.where("file = 'a'"), "file", "bad", 0).count() == 1
    with pytest.raises(Exception, match="bad row in file"):
        errors.apply_error_policy(df, "file", "bad", 0).collect()


def test_error_policy_parses_once(spark, tmp_path):
    text = spark.createDataFrame([(f, v) for f in "abc" for v in ("1", "x" if f > "a" else "2", "y" if f > "b" else "3")], "file string, v string")
    text.write.partitionBy("file").text(f"{tmp_path}/in")
    parsed = spark.read.text(f"{tmp_path}/in").select("file", F.col("value").try_cast("int").alias("n"))
    bad = F.col("n").isNull()
    once = errors.apply_error_policy(parsed, "file", bad, 2, work=f"{tmp_path}/work")
    assert once.columns == ["file", "n"] and rows_of(once) == rows_of(errors.apply_error_policy(parsed, "file", bad, 2))
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and plan.count("FileScan parquet") == 2
    assert "ReadSchema: struct<_is_bad:boolean,file:string>" in plan or "ReadSchema: struct<file:string,_is_bad:boolean>" in plan


# ------------------------------------------------------------------ headers, profile


def test_header_map(spark):
    heads = spark.createDataFrame([("f1", 'ï»¿id, "Name" ,NAME,x y'), ("f2", "name;id")], "path string, header string")
    fields = spark.createDataFrame([("ID",), (" Name",), ("X Y",), ("lost",)], "source_field_name string")
    assert rows_of(headers.header_map(heads.where("path = 'f1'"), fields)) == [("f1", "ID", 1), ("f1", "X Y", 4)]
    assert rows_of(headers.header_map(heads.where("path = 'f2'"), fields, ";")) == [("f2", " Name", 1), ("f2", "ID", 2)]
    assert rows_of(headers.header_columns(heads.where("path = 'f1'")).select("target_field_name")) == [("ID",), ("NAME",), ("NAME",), ("X_Y",)]


def test_profile(spark):
    files = {
        "comma": ['a,b,tradeId,"q,r",flag,void', '1,1.5,x,"1,5",True,', '2,,y,z,False,'],
        "pipe": ["a|b,c|d", "1|x|2", "2||3"],
        "tie": ["a;b,c", "1;2,3"],
        "tab": ["a\tb", "1\t", "3\t4"],
    }
    lines = spark.createDataFrame([(p, i == 0, x) for p, lines in files.items() for i, x in enumerate(lines)], "path string, is_header boolean, line string")
    got = {(r["path"], r["source_field_name"]): r for r in profile.profile_delimited(lines).collect()}
    kinds = {k: (r["data_type_name"], r["data_type_length"], r["data_type_precision"], r["data_type_scale"]) for k, r in got.items()}
    integer, floating, string = ("NUMERIC", 0, 38, 0), ("NUMERIC", 0, 38, 18), ("VARCHAR", 1000, 0, 0)
    assert kinds == {
        ("comma", "a"): integer, ("comma", "b"): floating, ("comma", "tradeId"): string, ("comma", "q,r"): string,
        ("comma", "void"): floating, ("pipe", "a"): integer, ("pipe", "b,c"): string, ("pipe", "d"): integer, ("tie", "a;b"): string,
        ("tie", "c"): integer, ("tab", "a"): integer, ("tab", "b"): floating,
    }
    assert got["comma", "tradeId"]["target_field_name"] == "TRADE_ID" and got["comma", "void"]["field_ordinal"] == 6


def test_profile_reads_all_lines_and_wide_ones(spark):
    rows = [("late", True, "n,m")] + [("late", False, f"{i},1") for i in range(300)] + [("late", False, "word,1")]
    wide = ",".join('"a,b"' for _ in range(6000))
    rows += [("wide", True, wide), ("wide", False, wide)]
    got = profile.profile_delimited(spark.createDataFrame(rows, "path string, is_header boolean, line string"))
    kinds = {r["source_field_name"]: r["data_type_name"] for r in got.where("path = 'late'").collect()}
    assert kinds == {"n": "VARCHAR", "m": "NUMERIC"}
    assert got.where("path = 'wide'").count() == 6000


def test_quoted_headers(spark):
    heads = spark.createDataFrame([("f", '"a,b", "c ""d""" ,e,')], "path string, header string")
    got = [(r["position"], r["cell"]) for r in headers.header_cells(heads).orderBy("position").collect()]
    assert got == [(1, "a,b"), (2, "c d"), (3, "e"), (4, "")]


def test_infer_types(spark):
    df = spark.createDataFrame([("1", "1.5", "2024-01-05", "true", "x", "", "2024-01-05 01:02:03")] * 2 + [("", "2", "", "False", "1", "", "")], ", ".join(f"c{i} string" for i in range(1, 8)))
    got = [r["type_name"] for r in profile.infer_types(df, df.columns).orderBy("position").collect()]
    assert got == ["NUMERIC", "DOUBLE", "DATE", "BOOLEAN", "STRING", "STRING", "TIMESTAMP"]


# ------------------------------------------------------------------ monitoring


def test_unstaged_rules(spark):
    now, old = dt.datetime(2024, 1, 10, 12), dt.datetime(2024, 1, 10, 9)
    url = "azure://acct/test1-sales"
    names = ["new", "done", "stale", "hopeless", "retryable", "unknown"]
    listing = spark.createDataFrame(
        [(20240110, "EXT.S", url, "in/", "csv", f"{url}/in/{n}.csv", old, old, True) for n in names]
        + [(20240110, "EXT.S", url, "in/", "csv", f"{url}/in/young.csv", dt.datetime(2024, 1, 10, 11, 45), old, True),
           (20240110, "EXT.S", url, "in/", "csv", f"{url}/in/new.csv", old, old, False)],
        "cob_id int, stage_name string, stage_url string, folder string, file_extension string, name string, last_modified timestamp, process_timestamp timestamp, flag_last_version boolean",
    )
    expected = spark.createDataFrame(
        [(20240110, "EXT.S", "csv", "/in/", f"{n}.csv", f"{n}.csv") for n in [*names[:-1], "young"]],
        "cob_id int, stage_name string, file_extension string, folder_path_cob string, file_name string, file_name_cob string",
    )
    log = spark.createDataFrame(
        [
            ({"file_stage_me": "in/done.csv", "container_name": "sales"}, {"exception": None}, "SUCCESS", now),
            ({"file_stage_me": "in/stale.csv", "container_name": "sales"}, {"exception": None}, "SUCCESS", dt.datetime(2024, 1, 1)),
            ({"file_stage_me": "in/hopeless.csv", "container_name": "sales"}, {"exception": "x Object 'T' does not exist or not authorized."}, "FAILED", now),
            ({"file_stage_me": "in/retryable.csv", "container_name": "sales"}, {"exception": "timeout"}, "FAILED", now),
            ({"file_stage_me": "in/new.csv", "container_name": "other"}, {"exception": None}, "SUCCESS", now),
        ],
        "process_parameters struct<file_stage_me:string,container_name:string>, process_result struct<exception:string>, process_status string, start_timestamp timestamp",
    )
    out = unstaged.unstaged_files(listing, expected, log, F.lit(now))
    assert rows_of(out.select("file_name")) == [("new.csv",), ("retryable.csv",), ("stale.csv",)]
    row = out.where("file_name = 'new.csv'").first()
    assert (row["folder_path"], row["container_name"], row["task_name"]) == ("/in/", "sales", "_in_new20240110")
    assert unstaged.retry_set(out, listing, 5).count() == 3


def test_usage_edges(spark):
    history = spark.createDataFrame([(1, "PROD_DW_LOAD_WH"), (1, "PROD_DW_LOAD_WH"), (2, "INT_X_2XL"), (3, "ODD")], "warehouse_id int, warehouse_name string")
    got = rows_of(usage.compute_clusters(history, ("LOAD",)).select("warehouse_id", "warehouse_name", "warehouse_size", "environment_code"))
    assert got == [(1, "PROD_DW_LOAD_WH_XS", "X-Small", "PROD"), (2, "INT_X_2XL", "2X-Large", "INT_"), (3, "ODD", "Unknow", "ODD")]
    days = usage.date_dimension(spark.sql("SELECT date '2024-03-01' AS d"), 730)
    assert days.count() == 730 and days.agg(F.min("date")).first()[0] == dt.date(2022, 3, 3)
