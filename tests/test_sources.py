import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quayside.sources import formats, listing, scan, sinks


def write(path, text, encoding="windows-1252"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return str(path)


def cells(df, *names):
    return [tuple(r) for r in df.orderBy(scan.PATH, scan.SEQ).select(*names).collect()]


def test_six_delimited_formats(spark, tmp_path):
    body = 'k,"a,b",\r\n1,"café ""x""",y\\z\r\n'
    path = write(tmp_path / "f.csv", body)
    quoted = [("1", 'café "x"', "y\\z")]
    for name in ("CSV_FORMAT", "CSV_FORMAT_PARSE_HEADER"):
        assert cells(scan.read_delimited(spark, path, formats.get_format(name), 3), "c1", "c2", "c3") == quoted
    header = [("k", "a,b", None)]
    got = cells(scan.read_delimited(spark, path, formats.get_format("CSV_FORMAT_NO_HEADER"), 3), "c1", "c2", "c3")
    assert [tuple(v or None for v in r) for r in got] == header + quoted
    for name, rows in (("CSV_FORMAT_NO_ENCLOSE", 1), ("CSV_FORMAT_NO_ENCLOSE_PARSE_HEADER", 1), ("CSV_FORMAT_NO_ENCLOSE_NO_HEADER", 2)):
        got = cells(scan.read_delimited(spark, path, formats.get_format(name), 3), "c1", "c2")
        assert len(got) == rows and got[-1] == ("1", '"café ""x"""')


def test_wrong_cell_count_is_marked(spark, tmp_path):
    path = write(tmp_path / "f.csv", "a,b\n1,2\n1\n1,2,3\n")
    df = scan.read_delimited(spark, path, formats.get_format("CSV_FORMAT"), 2)
    assert [bool(r[0]) for r in cells(df, scan.CORRUPT)] == [False, True, True]


def test_text_lines_keep_blanks_and_charset(spark, tmp_path):
    path = write(tmp_path / "t.txt", "été\n\nb€\n")
    assert cells(scan.read_lines(spark, path, "windows-1252"), "value") == [("été",), ("",), ("b€",)]


def test_json_and_parquet_by_name(spark, tmp_path):
    path = write(tmp_path / "j.json", '{"a": "", "b": 2}\n{"b": 3}\n')
    df = scan.read_named(spark, path, formats.get_format("JSON_FORMAT"), "a string, b string")
    assert cells(df, "a", "b") == [("", "2"), (None, "3")]
    spark.range(5).write.parquet(str(tmp_path / "p"))
    assert scan.read_named(spark, str(tmp_path / "p"), formats.get_format("PARQUET_FORMAT")).count() == 5


def test_unknown_format():
    with pytest.raises(ValueError, match="File Format not found: NOPE"):
        formats.get_format("NOPE")


def test_row_numbers_over_many_splits(spark, tmp_path):
    lines = [f"{i},{'x' * (i % 90)}" for i in range(20000)]
    big = write(tmp_path / "big.csv", "h,t\n" + "\n".join(lines) + "\n")
    small = write(tmp_path / "small.csv", "h,t\n0,a\n1,b\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = scan.read_delimited(spark, [big, small], formats.get_format("CSV_FORMAT_NO_ENCLOSE"), 2)
        assert df.select(scan.BLOCK).distinct().count() > 5
        numbered = scan.number_rows(df)
        plan = numbered._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" in plan and numbered.where("file_row_number <> cast(c1 AS bigint) + 1").isEmpty()
        assert numbered.count() == 20002
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_row_numbers_refuse_another_cut(spark, tmp_path):
    path = write(tmp_path / "f.csv", "h\n" + "\n".join(map(str, range(5000))) + "\n")
    fmt = formats.get_format("CSV_FORMAT")
    df = scan.read_delimited(spark, path, fmt, 1)
    stats = scan.split_stats(df)
    moved = stats.withColumn("_first", F.col("_first") + 1)
    assert scan.number_rows(df, splits=stats).agg(F.max("file_row_number")).first()[0] == 5000
    with pytest.raises(Exception, match="splits changed"):
        scan.number_rows(df, splits=moved).collect()


def test_headers_and_samples(spark, tmp_path):
    a = write(tmp_path / "a.csv", "ï»¿id,name\n1,x\n")
    b = write(tmp_path / "b.csv", "k\n" + "\n".join(map(str, range(300))) + "\n")
    heads = {r["path"].rsplit("/", 1)[1]: r["header"] for r in scan.header_lines(spark, [a, b], "windows-1252").collect()}
    assert heads == {"a.csv": "id,name", "b.csv": "k"}
    lines = scan.marked_lines(scan.read_lines(spark, [a, b]))
    counts = {(r["path"].rsplit("/", 1)[1], r["is_header"]): r["count"] for r in lines.groupBy("path", "is_header").count().collect()}
    assert counts == {("a.csv", True): 1, ("a.csv", False): 1, ("b.csv", True): 1, ("b.csv", False): 300}
    assert lines.where("path LIKE '%b.csv' AND is_header").first()["line"] == "k"
    with pytest.raises(ValueError, match="cannot be split"):
        scan.read_lines(spark, [a], "UTF-16")
    assert scan.sample_rows(spark.range(50), 7, seed=1).count() == 7 and scan.sample_rows(spark.range(50), 3).count() == 3


def test_listing(spark, tmp_path):
    write(tmp_path / "x/2024/a.csv", "1234")
    write(tmp_path / "x/b.txt", "1")
    files = listing.list_files(spark, str(tmp_path), r"[.]csv$", with_md5=True)
    row = files.first()
    assert files.count() == 1 and row["size"] == 4 and row["md5"] == "81dc9bdb52d04dc20036dbd8313ed055"
    plan = listing.list_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_listing_of_wanted_folders(spark, tmp_path):
    for name in ("in/a/x.csv", "in/a/deep/y.csv", "in/b/z.csv", "in/{c}[1]/q.csv", "other/big/n.csv"):
        write(tmp_path / name, "1")
    write(tmp_path / "in/a/empty.csv", "")
    wanted = spark.createDataFrame([("/in/a/",), ("/in/a/deep/",), ("in/{c}[1]",), ("/in/none/",)], "folder_path_cob string")
    assert sorted(r[0] for r in listing.top_folders(wanted).collect()) == ["/in/a/", "/in/none/", "/in/{c}[1]/"]
    files = listing.list_wanted(spark, str(tmp_path), wanted, include_empty=True)
    names = sorted(r["name"].split("/in/", 1)[1] for r in files.select("name").collect())
    assert names == sorted(["a/x.csv", "a/deep/y.csv", "a/empty.csv", "{c}[1]/q.csv"])
    # the scan was given the wanted folders; what lies beside them was never listed
    assert not [f for f in listing.list_wanted(spark, str(tmp_path), wanted).inputFiles() if "/other/" in f or "/b/" in f]
    assert listing.list_wanted(spark, str(tmp_path), wanted.where(F.lit(False)), with_md5=True).count() == 0
    assert listing.list_wanted(spark, str(tmp_path), wanted.where("folder_path_cob = '/in/none/'"), include_empty=True).count() == 0


def test_listing_log_versions(spark):
    keys = "cob_id int, stage_name string, folder string, file_extension string, name string, process_timestamp int"
    log = spark.createDataFrame([(1, "s", "a/", "csv", "f1", 1, True), (2, "s", "a/", "csv", "f2", 1, True)], keys + ", flag_last_version boolean")
    fresh = spark.createDataFrame([(1, "s", "a/", "csv", None, 2)], keys)
    out = listing.append_listing(log, fresh)
    assert sorted(tuple(r) for r in out.select("cob_id", "process_timestamp", "flag_last_version").collect()) == [(1, 1, False), (1, 2, True), (2, 1, True)]
    flagged = listing.flag_latest(out.drop("flag_last_version"), listing.LISTING_KEYS, "process_timestamp")
    assert flagged.where("flag_last_version").count() == 2


LOAD = "v int, file_name string, cob_id int, dataset_name string"


def load(spark, *rows):
    return spark.createDataFrame(list(rows), LOAD)


def stored(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("v", "file_name", "cob_id", "dataset_name").collect())


def test_reload_by_dataset_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append_load(load(spark, (1, "a", 1, "x"), (2, "a", 1, "y z"), (3, "a", 2, "x")), path)
    for _ in range(2):
        sinks.reload_by_dataset(load(spark, (9, "b", 1, "x")), path)
        assert stored(spark, path) == [(2, "a", 1, "y z"), (3, "a", 2, "x"), (9, "b", 1, "x")]
    sinks.clear_partitions(spark, path, [(1, "y z"), (5, "none")])
    assert stored(spark, path) == [(3, "a", 2, "x"), (9, "b", 1, "x")]


def test_reload_by_file_keeps_the_other_files(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.reload_by_file(load(spark, (1, "in/a", 1, "x"), (2, "in/b", 1, "x"), (3, "in/a", 2, "x"), (4, "in/a", 1, "old")), path)
    for _ in range(2):
        sinks.reload_by_file(load(spark, (9, "in/a", 1, "x")), path)
        # found by COB and file name, whatever dataset it was loaded under
        assert stored(spark, path) == [(2, "in/b", 1, "x"), (3, "in/a", 2, "x"), (9, "in/a", 1, "x")]


def test_ledger_export_publish_and_seed(spark, tmp_path):
    manifest = spark.createDataFrame([("a",), ("b",), ("c",)], "file string")
    log = spark.createDataFrame([("a", "SUCCESS"), ("a", "SUCCESS"), ("b", "FAILED")], "file string, process_status string")
    assert sorted(r[0] for r in sinks.not_yet_loaded(manifest, log, ["file"]).collect()) == ["b", "c"]
    sinks.export_csv(manifest, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).columns == ["file"]
    sinks.publish(manifest, "config_files", "1")
    sinks.publish(manifest.limit(1), "config_files", "2")
    assert spark.table("config_files").count() == 1 and spark.table("config_files__v1").count() == 3
    seed = write(tmp_path / "s.csv", "a,b\n1,true\n", "utf-8")
    assert sinks.seed_csv(spark, seed, "a int, b boolean", "seed").first() == (1, True)
    assert spark.table("seed").count() == 1


def test_grace_period(spark):
    from quayside.streaming.ingest import drop_recent, widen_path

    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10),), (dt.datetime(2024, 1, 1, 11, 45),)], "m timestamp")
    assert drop_recent(df, "m", F.lit(dt.datetime(2024, 1, 1, 12))).count() == 1
    assert widen_path("in/2024/a1/20240101") == "in/*/a1/*"
