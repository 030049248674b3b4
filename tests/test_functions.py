import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quayside.functions import dates, names, paths, text, types


def check(evaluate, expression, cases, kind="string"):
    assert evaluate(expression, list(cases), kind) == list(cases.values())


def test_cob_from_path(evaluate):
    check(
        evaluate,
        paths.cob_from_path("x"),
        {
            "in/2024/202401/20240131/f.csv": 20240131,
            "in/f_20240131.csv": 20240131,
            "in/static/f.csv": 19000101,
            "in/202401312359/f-20240101.csv": 202401312359,
            "19000100/a.csv": 19000101,
            "19000101.20240101": 19000101,
            "": 19000101,
            "in/20240131x/20240201": 20240201,
        },
    )


def test_find_cob_differs_from_the_path_rule(evaluate):
    check(
        evaluate,
        paths.find_cob("x"),
        {
            "in/20240131/f.csv": "20240131",
            "in/f_20240131.csv": None,
            "in/f-20240131.csv": "-20240131.",
            "20240131": "20240131",
            "in/2024013/f": None,
        },
    )


def test_templates(spark):
    df = spark.createDataFrame(
        [
            ("/in/|:YYYYMM:|/|:YYYYMMDD:|/", 20240105),
            ("in/|:YYYY:|-|:MM:|_|:DD:|", 20240105),
            ("static", 19000101),
            ("/a/|:MON:||:YY:|/b", 20240105),
        ],
        "p string, cob int",
    )
    out = df.select(
        paths.expand_template("p", "cob").alias("folder"), paths.template_pattern("p", "cob").alias("pattern")
    ).withColumn("search", paths.folder_pattern(F.lit("x|:YYYY:|"), "pattern", "folder"))
    rows = [tuple(r) for r in out.collect()]
    assert rows[0] == ("/in/202401/20240105/", ".*/202401.*/20240105.*/", ".*202401.*/20240105.*/")
    assert rows[1][0] == "/in/2024-01_05/"
    assert rows[2][0] == "/static/" and rows[2][1] == ".*/"
    assert rows[3][0] == "/a/Jan24/b/"


def test_folder_pattern_of_fixed_folder(evaluate):
    fixed = paths.folder_pattern("x", F.lit(".*/"), "x")
    assert evaluate(fixed, ["/a/b/", "a/"]) == [".*a/b/", ".*a/"]


def test_file_name_tokens(evaluate):
    expression = paths.file_name_for_cob("x", F.lit(20240105))
    check(evaluate, expression, {"f|:YYYYMMDD:|.csv": "f20240105.csv", "|:YYYY:|_|:YYYYMM:|": "2024_202401", "f": "f"})


def test_source_path(evaluate):
    expression = paths.expand_source_path("x", F.lit(20240105), "DVLP_SALES")
    check(
        evaluate,
        expression,
        {"//srv/|:ENVIRONMENT:|/|:YYYYMM:|/": "//srv/dvlp/202401/", "plain": "plain", "a|:DD:|b|": "a05b"},
    )


@pytest.mark.parametrize(
    "given, bare",
    [
        ("test3-sales", "sales"),
        ("int1-sales", "sales"),
        ("prodint-x", "x"),
        ("dvlp-a-b", "a-b"),
        ("rlse2-a", "a"),
        ("prod-a", "prod-a"),
        ("sales", "sales"),
        ("test-test-a", "a"),
    ],
)
def test_container_name(evaluate, given, bare):
    assert evaluate(paths.container_name("x"), [given]) == [bare]


def test_container_from_url(evaluate):
    urls = ["azure://acct/test1-sales", "s3://bucket/test1-sales"]
    assert evaluate(paths.container_from_url("x", False), urls) == ["sales", ""]
    assert evaluate(paths.container_from_url("x", True), urls) == ["test1-sales", ""]


def test_path_helpers(evaluate):
    check(evaluate, paths.tidy_path("x"), {"/a//b/": "a/b", "": "", "a": "a"})
    check(evaluate, paths.slash_wrapped("x"), {"a": "/a/", "/a/": "/a/", "a/": "/a/", "": "/"})
    check(evaluate, paths.without_leaf("x"), {"a/b.csv": "a/", "a/": "a/", "b": ""})
    check(evaluate, paths.ancestors(paths.folder_parts("x")), {"/": ["/"], "/a/b/": ["/", "/a/", "/a/b/"]})
    check(
        evaluate,
        paths.literal_anchor("x"),
        {"/a/b/": "/a/b/", "/a/b_c/d/": "/a/", "/a_/": "/", "/a/%/": "/a/", "/": "/"},
    )
    check(evaluate, paths.file_extension("x"), {"a.tar.gz": "gz", "a": "a"})


def test_name_rules_disagree(evaluate):
    given = ["Trade Date", "tradeID", "COBID", "cobId", "_x", "a  (b)/c", "ABCdef", "Price£"]
    assert evaluate(names.inferred_name("x"), given) == [
        "TRADE_DATE", "TRADE_ID", "COBID", "COBID", "X", "A_BC", "ABCDEF", "PRICE£",
    ]
    assert evaluate(names.profiled_name("x"), given) == [
        "TRADE_DATE", "TRADE_I_D", "C_O_B_I_D", "COB_ID", "_X", "ABC", "A_B_CDEF", "PRICE",
    ]
    assert evaluate(names.header_name("x"), given) == [
        "TRADE_DATE", "TRADEID", "COBID", "COBID", "_X", "A_B_C", "ABCDEF", "PRICE_",
    ]


def test_text_helpers(evaluate):
    check(evaluate, text.strip_empty("x", "|"), {"a||b|": "a|b", "": "", "a": "a"})
    check(evaluate, text.split_tags("x"), {"a##b#a": ["a", "b", "a"], "": []})
    check(evaluate, text.trigger_map("x"), {"k:v,k2:v2:rest": {"k": "v", "k2": "v2"}, "": {"Adf": "none"}, "a:1,a:2": {"a": "2"}})
    check(evaluate, text.strip_bom("x"), {"ï»¿id": "id", "﻿id": "id", "þÿid": "id", "id": "id"})
    check(evaluate, text.split_part("x", ".", 0), {"a.b": "a"})
    assert evaluate(text.null_if_empty("x"), ["", "a", None]) == [None, "a", None]
    assert evaluate(text.same_or_both_empty("x", F.lit(None)), ["", "a", None]) == [True, False, True]
    assert evaluate(text.glob_like("x", F.lit("tr*_a.csv")), ["TRADE_A.CSV", "tr_a.csv", "trade.csv"]) == [True, True, False]
    assert evaluate(text.thousands("x"), [1234567.5, 12.0, None], "double") == ["1,234,568", "12", None]


def test_boundary_counts(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:59", "2024-01-01 00:01:01"), ("2024-01-01 01:00:00", "2024-01-01 00:59:59")], "a string, b string")
    a, b = F.to_timestamp("a"), F.to_timestamp("b")
    rows = df.select(*[dates.boundaries(u, a, b) for u in ("second", "minute", "hour")]).collect()
    assert [tuple(r) for r in rows] == [(2, 1, 0), (-1, -1, -1)]


def test_date_helpers(evaluate, spark):
    assert evaluate(dates.parse_http_date("x"), ["Wed, 03 Feb 2021 10:11:12 GMT", "nonsense"]) == [dt.datetime(2021, 2, 3, 10, 11, 12), None]
    assert evaluate(dates.cob_date("x"), [20240131, 19000101, 20241301], "int") == [dt.date(2024, 1, 31), dt.date(1900, 1, 1), None]
    assert evaluate(dates.cob_of("x"), [dt.date(2024, 1, 5)], "date") == [20240105]
    summer, winter = dt.datetime(2024, 7, 1, 12), dt.datetime(2024, 1, 1, 12)
    assert evaluate(dates.local_to_utc("x", "Europe/London"), [summer, winter], "timestamp_ntz") == [dt.datetime(2024, 7, 1, 11), winter]
    parts = spark.sql("SELECT date '2024-01-07' AS d").select(*[c.alias(n) for n, c in dates.day_parts("d").items()]).first()
    assert parts["day_of_week"] == 0 and parts["month_name_year"] == "Jan-24" and parts["day_name"] == "Sun"


@pytest.mark.parametrize(
    "given, java",
    [
        ("DD/MM/YYYY HH24:MI:SS.FF3", "dd/MM/yyyy HH:mm:ss.SSS"),
        ("DY, DD MON YYYY", "E, dd MMM yyyy"),
        ("yyyymmdd", "yyyyMMdd"),
        ("MON-YY", "MMM-yy"),
    ],
)
def test_format_translation(given, java):
    assert dates.java_format(given) == java


def test_types(spark):
    rows = [
        ("VARCHAR", 20, 0, 0, "VARCHAR(20)", "StringType()", "string"),
        ("NUMERIC", 0, 0, 0, "NUMERIC(38)", "IntegerType()", "decimal(38,0)"),
        ("NUMERIC", 0, 18, 0, "NUMERIC(18)", "DecimalType(18,0)", "decimal(18,0)"),
        ("NUMERIC", 0, 18, 2, "NUMERIC(18,2)", "DecimalType(18,2)", "decimal(18,2)"),
        ("DATE", 0, 0, 0, "DATE", "DateType()", "date"),
        ("TIME", 8, 0, 0, "TIME", "TimeType()", "string"),
        ("DOUBLE", 0, 0, 0, "DOUBLE", "StringType()", "double"),
        ("BINARY", 0, 0, 2, "BINARY", "StringType()", "string"),
    ]
    df = spark.createDataFrame(rows, "n string, l int, p int, s int, sized string, frame string, spark string")
    for r in df.select("*", types.sized_type("n", "l", "p", "s").alias("a"), types.frame_type("n", "p", "s").alias("b")).collect():
        assert (r["a"], r["b"], types.spark_type(r["n"], r["p"], r["s"])) == (r["sized"], r["frame"], r["spark"])
    assert isinstance(Decimal(1), Decimal)
