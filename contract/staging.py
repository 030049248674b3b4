"""Staging queries: casting, error policy, reloads, profiling and ingest."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract.common import stamp, table
from quayside.functions.dates import cob_of
from quayside.operators.errors import apply_error_policy
from quayside.operators.headers import header_columns, header_map
from quayside.operators.profile import infer_types, profile_delimited
from quayside.operators.project import BAD, Field, Formats, typed_projection
from quayside.plans.calendar import calendar
from quayside.plans.catalog import feed_rollup, field_catalog
from quayside.plans.expected import at_cob, dataset_catalog, with_cobs
from quayside.plans.stage import StageOptions, manifest_of, stage_files, table_path
from quayside.session import scratch_path
from quayside.sources.formats import FORMATS
from quayside.sources.listing import list_files, list_storage, list_wanted
from quayside.sources.scan import BLOCK, PATH, ROW, SEQ, marked_lines, number_rows, read_named
from quayside.sources.sinks import append_load, not_yet_loaded, reload_by_dataset, reload_by_file
from quayside.streaming.ingest import file_stream, ingest


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder on the shared storage of the cluster; a temporary one in a local session only."""
    if spark.conf.get("spark.checkpoint.dir", None):
        return scratch_path(spark, "", label)
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"quayside-{label}-")


# ---------------------------------------------------------------- casting


def _raw_lines(spark, sf_dir) -> DataFrame:
    """Line items as cells of text; some dates, numbers and flags are unreadable."""
    day = F.date_format("l_shipdate", "dd/MM/yyyy")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("c1"),
        F.when(F.col("l_quantity") == 13, "n/a").when(F.col("l_quantity") < 3, "")
        .otherwise(F.col("l_quantity").cast("int").cast("string")).alias("c2"),
        F.when(F.col("l_suppkey") == 7, F.concat(day, F.lit("?"))).otherwise(day).alias("c3"),
        F.date_format(F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_linenumber")), "dd/MM/yyyy HH:mm:ss.SSS").alias("c4"),
        F.when(F.col("l_tax") > 0.06, "maybe").otherwise((F.col("l_returnflag") == "R").cast("string")).alias("c5"),
        F.concat("l_returnflag", F.when(F.col("l_linenumber") == 7, F.col("l_linestatus")).otherwise("")).alias("c6"),
        "l_partkey", "l_suppkey", "l_linenumber",
    )


_FIELDS = [
    Field("id", "order_id", 1, "NUMERIC", precision=0),
    Field("qty", "quantity", 2, "NUMERIC", precision=18, scale=2),
    Field("day", "ship_day", 3, "DATE"),
    Field("at", "shipped_at", 4, "DATETIME"),
    Field("back", "returned", 5, "BOOLEAN"),
    Field("state", "state", 6, "VARCHAR", length=1),
    Field("code", "code", 6, "STRING", derived="lower(code)"),
    Field("gone", "gone", -1, "STRING"),
    Field("label", "label", 9, "STRING", in_source=False, derived="concat('L', l_linenumber)"),
]


def _typed(spark, sf_dir):
    keep = ["l_partkey", "l_suppkey", "l_linenumber"]
    return typed_projection(_raw_lines(spark, sf_dir), _FIELDS, Formats(timezone="UTC"), keep=keep)


def typed(spark, sf_dir):
    return _typed(spark, sf_dir).select(
        F.col("order_id").cast("bigint").alias("order_id"), F.col("quantity").cast("double").alias("quantity"), "ship_day",
        stamp("shipped_at").alias("shipped_at"), "returned", "state", "code", "label",
        F.col(BAD).alias("is_bad"), "l_partkey", "l_suppkey", "l_linenumber",
    )


_TYPED = """
typed AS (
  SELECT l_orderkey AS order_id, CASE WHEN l_quantity <> 13 AND l_quantity >= 3 THEN CAST(CAST(l_quantity AS INT) AS DOUBLE) END AS quantity,
         CASE WHEN l_suppkey <> 7 THEN CAST(l_shipdate AS DATE) END AS ship_day,
         strftime(l_shipdate + to_hours(l_linenumber), '%Y-%m-%d %H:%M:%S') AS shipped_at,
         CASE WHEN l_tax <= 0.06 THEN l_returnflag = 'R' END AS returned, CASE WHEN l_linenumber <> 7 THEN l_returnflag END AS state,
         lower(l_returnflag || CASE WHEN l_linenumber = 7 THEN l_linestatus ELSE '' END) AS code, 'L' || l_linenumber AS label,
         l_quantity = 13 OR l_suppkey = 7 OR l_tax > 0.06 OR l_linenumber = 7 AS is_bad, l_partkey, l_suppkey, l_linenumber
  FROM lineitem)"""

SQL_TYPED = f"WITH {_TYPED} SELECT * FROM typed"


def error_policy(spark, sf_dir):
    """A file per part; files with three bad rows or more are left out."""
    return apply_error_policy(_typed(spark, sf_dir), "l_partkey", BAD, 3, work=f"{work_dir(spark, 'policy')}/rows").select(
        F.col("order_id").cast("bigint").alias("order_id"), "l_partkey", "l_suppkey", "l_linenumber"
    )


SQL_ERROR_POLICY = f"""WITH {_TYPED}
SELECT order_id, l_partkey, l_suppkey, l_linenumber FROM typed
WHERE NOT is_bad AND l_partkey NOT IN (SELECT l_partkey FROM typed WHERE is_bad GROUP BY l_partkey HAVING count(*) >= 3)"""


def inferred_types(spark, sf_dir):
    cells = _raw_lines(spark, sf_dir).select(
        "c1", "c2", "c6",
        F.col("l_linenumber").cast("double").cast("string").alias("c7"),
        F.when(F.col("l_linenumber") > 0, "").alias("c8"),
        F.when(F.length("c3") == 10, F.concat_ws("-", F.substring("c3", 7, 4), F.substring("c3", 4, 2), F.substring("c3", 1, 2))).alias("c9"),
        F.when(F.col("l_linenumber") > 3, "true").when(F.col("l_linenumber") > 2, "").otherwise("False").alias("c10"),
        F.lit("x").alias("key"),
    )
    return infer_types(cells, ["c1", "c2", "c6", "c7", "c8", "c9", "c10"])


SQL_INFERRED_TYPES = """
WITH n AS (SELECT count(*) AS n, count_if(l_quantity = 13) AS words FROM lineitem)
SELECT 1 AS position, 'c1' AS column_name, 'NUMERIC' AS type_name FROM n WHERE n > 0
UNION ALL SELECT 2, 'c2', CASE WHEN words > 0 THEN 'STRING' ELSE 'NUMERIC' END FROM n
UNION ALL SELECT 3, 'c6', 'STRING' FROM n UNION ALL SELECT 4, 'c7', 'DOUBLE' FROM n
UNION ALL SELECT 5, 'c8', 'STRING' FROM n UNION ALL SELECT 6, 'c9', 'DATE' FROM n
UNION ALL SELECT 7, 'c10', 'BOOLEAN' FROM n"""

# ---------------------------------------------------------------- reloads


def _loaded_lines(spark, sf_dir):
    """Rows already staged: COB by month, dataset by status, file by supplier."""
    return table(spark, sf_dir, "lineitem").select(
        cob_of(F.trunc(F.to_date("l_shipdate"), "month")).alias("cob_id"),
        F.col("l_linestatus").alias("dataset_name"),
        F.col("l_suppkey").alias("file_name"),
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag",
        F.lit(1).alias("load"),
    )


_LOADED = """
first_load AS (
  SELECT CAST(strftime(date_trunc('month', l_shipdate), '%Y%m%d') AS INT) AS cob_id, l_linestatus AS dataset_name,
         l_suppkey AS file_name, l_orderkey, l_partkey, l_linenumber, l_returnflag, 1 AS load FROM lineitem),
second_load AS (SELECT * EXCLUDE (load), 2 AS load FROM first_load WHERE l_returnflag = 'R' AND cob_id > 20000101)"""


def _reload(spark, sf_dir, sink):
    """The table after a first load and a load of part of the files, by the sink of the staging run."""
    path = work_dir(spark, "reload")
    first = _loaded_lines(spark, sf_dir)
    append_load(first, path)
    sink(first.where("l_returnflag = 'R' AND cob_id > 20000101").withColumn("load", F.lit(2)), path)
    back = spark.read.parquet(path)
    return back.select(*[F.col(c).cast(t).alias(c) for c, t in first.dtypes])


def reload_dataset(spark, sf_dir):
    return _reload(spark, sf_dir, reload_by_dataset)


SQL_RELOAD_BY_DATASET = f"""WITH {_LOADED}
SELECT * FROM first_load WHERE (cob_id, dataset_name) NOT IN (SELECT (cob_id, dataset_name) FROM second_load)
UNION ALL SELECT * FROM second_load"""


def reload_file(spark, sf_dir):
    return _reload(spark, sf_dir, reload_by_file)


SQL_RELOAD_BY_FILE = f"""WITH {_LOADED}
SELECT * FROM first_load WHERE (cob_id, file_name) NOT IN (SELECT (cob_id, file_name) FROM second_load)
UNION ALL SELECT * FROM second_load"""


def not_loaded(spark, sf_dir):
    """Orders whose lines were all returned, or that have none, are not loaded."""
    manifest = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    log = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.when(F.col("l_returnflag") == "R", "FAILED").otherwise("SUCCESS").alias("process_status")
    )
    return not_yet_loaded(manifest, log, ["l_orderkey"])


SQL_NOT_LOADED = """
SELECT o_orderkey AS l_orderkey, o_orderstatus FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag <> 'R')"""

# ---------------------------------------------------------------- headers, profiles


def _order_headers(spark, sf_dir):
    head = (
        F.when(F.col("o_orderstatus") == "F", F.lit('ï»¿africa, "America" ,ASIA,Other Col'))
        .when(F.col("o_orderstatus") == "O", F.lit("Asia,asia,EUROPE,x-y"))
        .otherwise(F.concat(F.lit("k"), "o_custkey", F.lit(",middle east")))
    )
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("path"), head.alias("header"))


def headers(spark, sf_dir):
    """Header of one file per order against the region names as fields."""
    fields = table(spark, sf_dir, "region").select(F.col("r_name").alias("source_field_name"))
    return header_map(_order_headers(spark, sf_dir), fields)


SQL_HEADERS = """
SELECT o_orderkey AS path, f.name AS source_field_name, f.p AS position FROM orders JOIN (
  SELECT 'F' AS s, 'AFRICA' AS name, 1 AS p UNION ALL SELECT 'F', 'AMERICA', 2 UNION ALL SELECT 'F', 'ASIA', 3
  UNION ALL SELECT 'O', 'EUROPE', 3 UNION ALL SELECT 'P', 'MIDDLE EAST', 2) f ON f.s = o_orderstatus
WHERE f.name IN (SELECT r_name FROM region)"""


def header_only(spark, sf_dir):
    return header_columns(_order_headers(spark, sf_dir))


SQL_HEADER_ONLY = """
SELECT o_orderkey AS path, f.p AS position, f.c AS source_field_name, f.t AS target_field_name FROM orders JOIN (
  SELECT 'F' AS s, 1 AS p, 'africa' AS c, 'AFRICA' AS t UNION ALL SELECT 'F', 2, 'America', 'AMERICA'
  UNION ALL SELECT 'F', 3, 'ASIA', 'ASIA' UNION ALL SELECT 'F', 4, 'Other Col', 'OTHER_COL'
  UNION ALL SELECT 'O', 1, 'Asia', 'ASIA' UNION ALL SELECT 'O', 2, 'asia', 'ASIA' UNION ALL SELECT 'O', 3, 'EUROPE', 'EUROPE'
  UNION ALL SELECT 'O', 4, 'x-y', 'X_Y' UNION ALL SELECT 'P', 2, 'middle east', 'MIDDLE_EAST') f ON f.s = o_orderstatus
UNION ALL SELECT o_orderkey, 1, 'k' || o_custkey, 'K' || o_custkey FROM orders WHERE o_orderstatus = 'P'"""


def profile(spark, sf_dir):
    """A delimited file per customer and status; the status decides the delimiter."""
    orders = table(spark, sf_dir, "orders")
    delimiter = F.when(F.col("o_orderstatus") == "F", ",").when(F.col("o_orderstatus") == "O", "|").otherwise(";")
    path = F.concat("o_custkey", F.lit("/"), "o_orderstatus")
    names = ["orderKey", "TotalPrice", "Prio rity", "big", "ok"]
    heads = orders.select("o_custkey", "o_orderstatus").distinct().select(
        path.alias(PATH), F.lit(-1).cast("bigint").alias(SEQ),
        F.call_function("concat_ws", delimiter, *[F.lit(c) for c in names]).alias("value"),
    )
    cells = [
        F.col("o_orderkey").cast("string"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
        F.replace("o_orderpriority", F.lit(" "), F.lit("_")),
        F.when(F.col("o_totalprice") > 100000, F.floor("o_totalprice").cast("string")).otherwise(""),
        F.when(F.col("o_totalprice") > 200000, "True").otherwise("False"),
    ]
    lines = orders.select(path.alias(PATH), F.col("o_orderkey").alias(SEQ), F.call_function("concat_ws", delimiter, *cells).alias("value"))
    return profile_delimited(marked_lines(heads.unionByName(lines).withColumn(BLOCK, F.lit(0))))


SQL_PROFILE = """
WITH l AS (SELECT o_custkey || '/' || o_orderstatus AS path, o_totalprice FROM orders),
f AS (SELECT path, count_if(o_totalprice <= 100000) AS blanks FROM l GROUP BY path),
c AS (
  SELECT path, 'orderKey' AS source_field_name, 'ORDER_KEY' AS target_field_name, 1 AS field_ordinal, 'integer' AS k FROM f
  UNION ALL SELECT path, 'TotalPrice', 'TOTAL_PRICE', 2, 'floating' FROM f
  UNION ALL SELECT path, 'Prio rity', 'PRIORITY', 3, 'string' FROM f
  UNION ALL SELECT path, 'big', 'BIG', 4, CASE WHEN blanks = 0 THEN 'integer' ELSE 'floating' END FROM f)
SELECT path, source_field_name, target_field_name, field_ordinal,
       CASE WHEN k = 'string' THEN 'VARCHAR' ELSE 'NUMERIC' END AS data_type_name,
       CASE WHEN k = 'string' THEN 1000 ELSE 0 END AS data_type_length,
       CASE WHEN k = 'string' THEN 0 ELSE 38 END AS data_type_precision,
       CASE WHEN k = 'floating' THEN 18 ELSE 0 END AS data_type_scale,
       'TRUE' AS is_in_source, 'TRUE' AS is_in_target, 'FALSE' AS is_deleted, CAST(NULL AS VARCHAR) AS derived_expression
FROM c"""

# ---------------------------------------------------------------- files


def row_numbers(spark, sf_dir):
    """Row numbers given to every line of the line item file, summed up."""
    lines = number_rows(read_named(spark, f"{sf_dir}/lineitem.parquet", FORMATS["PARQUET_FORMAT"]).select(
        "l_orderkey", PATH, BLOCK, SEQ, ROW
    ))
    return lines.groupBy(F.regexp_extract(PATH, "([^/]+)[.]parquet", 1).alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("file_row_number").alias("n_numbers"),
        F.min("file_row_number").alias("first_number"),
        F.max("file_row_number").alias("last_number"),
    )


SQL_ROW_NUMBERS = """
SELECT 'lineitem' AS file, count(*) AS n_rows, count(*) AS n_numbers, 1::BIGINT AS first_number, count(*) AS last_number FROM lineitem"""


def file_listing(spark, sf_dir):
    """Listed files of the folder with the rows the three largest tables hold."""
    listed = list_files(spark, sf_dir, regex=r"/(orders|lineitem|events)[.]parquet$").select(
        F.regexp_extract("name", "([^/]+)$", 1).alias("file_name"), (F.col("size") > 0).alias("has_bytes")
    )
    counts = None
    for name in ("orders", "lineitem", "events"):
        rows = table(spark, sf_dir, name).select(F.col("_metadata.file_name").alias("file_name"))
        counts = rows if counts is None else counts.unionByName(rows)
    return listed.join(counts.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rows")), "file_name", "left")


SQL_FILE_LISTING = """
SELECT 'orders.parquet' AS file_name, TRUE AS has_bytes, count(*) AS n_rows FROM orders
UNION ALL SELECT 'lineitem.parquet', TRUE, count(*) FROM lineitem
UNION ALL SELECT 'events.parquet', TRUE, count(*) FROM events"""


def storage_listing(spark, sf_dir):
    """Every line item is a stored file below its order's folder; the orders that
    are not pending expect csv files there."""
    url = "azure://store/box/"
    listing = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit(url + "in/o"), "l_orderkey", F.lit("/p"), "l_linenumber", F.lit("/f"), "l_partkey", F.lit("_"),
                 "l_suppkey", F.when(F.col("l_returnflag") == "A", ".txt").otherwise(".csv")).alias("name"),
        F.col("l_quantity").alias("size"),
    )
    expected = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(
        cob_of("o_orderdate").alias("cob_id"),
        F.lit("EXT.BOX").alias("stage_name"),
        F.concat(F.lit("/in/o"), "o_orderkey", F.lit("/")).alias("folder_path_cob"),
        F.lit("csv").alias("file_extension"),
    )
    out = list_storage(listing, expected, url, F.lit("2002-01-01").cast("timestamp_ntz"))
    return out.select("cob_id", "stage_name", "folder", "file_extension", "name", "size", "file_path")


SQL_STORAGE_LISTING = """
WITH f AS (
  SELECT l_orderkey, 'in/o' || l_orderkey || '/p' || l_linenumber || '/f' || l_partkey || '_' || l_suppkey || '.csv' AS file_path,
         l_quantity AS size FROM lineitem WHERE l_returnflag <> 'A')
SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS cob_id, 'EXT.BOX' AS stage_name, 'in/o' || o_orderkey || '/' AS folder,
       'csv' AS file_extension, 'azure://store/box/' || file_path AS name, size, file_path
FROM orders JOIN f ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'
UNION ALL
SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INT), 'EXT.BOX', 'in/o' || o_orderkey || '/', 'csv', NULL, NULL, NULL
FROM orders WHERE o_orderstatus <> 'P'"""


def wanted_listing(spark, sf_dir):
    """Orders as text files by status and month. Every second month of the finished ones is expected, the open ones as a
    whole and by month, and a folder that does not exist; the others are not to be walked."""
    root = work_dir(spark, "wanted")
    month = F.date_format("o_orderdate", "yyyyMM")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("value"), F.col("o_orderstatus").alias("kind"), month.alias("month"))
    orders.hint("rebalance", "kind", "month").write.partitionBy("kind", "month").text(f"{root}/in")
    months = orders.select("kind", "month").distinct()
    by_month = months.where("kind = 'O' OR kind = 'F' AND month % 2 = 0").select(F.concat(F.lit("/in/kind="), "kind", F.lit("/month="), "month", F.lit("/")))
    whole = spark.createDataFrame([("/in/kind=O/",), ("/in/kind=X",)], "folder_path_cob string")
    expected = by_month.toDF("folder_path_cob").unionByName(whole).withColumns(
        {"cob_id": F.lit(20020101), "stage_name": F.lit("EXT.BOX"), "file_extension": F.lit("txt")}
    )
    files = list_wanted(spark, root, expected)
    # names are absolute; the root is where their part below it begins
    below = files.withColumn("name", F.regexp_extract("name", "/in/.*$", 0))
    found = list_storage(below, expected, "", F.lit("2002-01-01").cast("timestamp_ntz"))
    other = below.where(F.contains("name", F.lit("kind=P")) | F.rlike("name", F.lit("kind=F/month=....[0-9]*[13579]/"))).agg(F.count(F.lit(1))).scalar()
    return found.groupBy("folder").agg(F.sum("size").alias("n_bytes"), (F.count("name") > 0).alias("has_files")).withColumn("n_unwanted", other)


SQL_WANTED_LISTING = """
WITH b AS (SELECT o_orderstatus AS kind, strftime(o_orderdate, '%Y%m') AS month, sum(length(CAST(o_orderkey AS VARCHAR)) + 1) AS n FROM orders GROUP BY ALL),
w AS (
  SELECT 'in/kind=' || kind || '/month=' || month || '/' AS folder, n FROM b WHERE kind = 'O' OR kind = 'F' AND CAST(month AS INT) % 2 = 0
  UNION ALL SELECT 'in/kind=O/', sum(n) FROM b WHERE kind = 'O'
  UNION ALL SELECT 'in/kind=X', NULL)
SELECT folder, CAST(n AS BIGINT) AS n_bytes, n IS NOT NULL AS has_files, 0::BIGINT AS n_unwanted FROM w"""


def expected_files(codes, name, folder, kind, declared, days, as_of, bad_rows=1) -> DataFrame:
    """The datasets of ``codes`` (code) at the COBs of a calendar: one feed and dataset each, all loading into one table."""
    none = F.lit(None).cast("string")
    files = codes.select(
        F.lit("SYS").alias("source_system_code"), F.col("code").alias("source_feed_code"),
        F.lit("EXT.IN").alias("stage_name"), none.alias("source_file_path"),
        none.alias("source_file_name_pattern"), F.lit("DW").alias("destination_schema_name"),
        F.lit(name.upper()).alias("destination_table_name"), F.lit(True).alias("is_enabled"),
        F.lit(f"{kind.upper()}_FORMAT").alias("file_format"), F.lit("DD/MM/YYYY").alias("date_input_format"),
        F.lit("DD/MM/YYYY HH24:MI:SS").alias("timestamp_input_format"), F.lit(bad_rows).alias("skip_row_on_error"),
        F.lit(False).alias("delete_stage_by_file_name"), F.lit("UTC").alias("timezone"),
    )
    field = F.explode(F.array(*[F.struct(*[F.lit(v) for v in d]) for d in declared])).alias("d")
    names = ["source_field_name", "target_field_name", "field_ordinal", "data_type_name", "data_type_length",
             "data_type_precision", "data_type_scale"]
    fields = files.select("source_system_code", "source_feed_code", field).select(
        "source_system_code", "source_feed_code", *[F.col(f"d.col{i + 1}").alias(n) for i, n in enumerate(names)],
        F.lit(True).alias("is_in_source"), F.lit(True).alias("is_in_target"), F.lit(False).alias("is_deleted"),
        none.alias("derived_expression"),
    )
    before, after = folder.split("|code|")
    parameters = files.select(
        F.concat(F.lit(f"{name}_"), "source_feed_code").alias("dataset_name"), "source_system_code", "source_feed_code",
        F.lit("").alias("container_name"),
        F.concat(F.lit(before), "source_feed_code", F.lit(after)).alias("file_path"),
        F.lit(f"*.{kind}").alias("file_name"), F.lit(True).alias("is_enabled"), F.lit(False).alias("is_trigger_file"),
        F.lit(True).alias("allow_reload"), F.lit(False).alias("is_cloud_copy"), F.lit(True).alias("allow_infer_schema"),
        F.col("source_feed_code").alias("entity_code"), none.alias("department_code"), none.alias("region"),
        none.alias("market"), none.alias("expected_stage_time"), none.alias("warehouse_size"),
        F.array().cast("array<string>").alias("tags"),
    )
    catalog = dataset_catalog(parameters, feed_rollup(field_catalog(files, fields, "DVLP_SALES")))
    return at_cob(with_cobs(catalog, days, as_of, days=3000))


def staged_orders(spark, sf_dir, kind="csv"):
    """Orders written as files, one folder per month, then staged from configuration: matched, cast, checked, given
    lineage and loaded. The note, with quotes, delimiters and a line end, is not declared: its column is inferred."""
    root = work_dir(spark, "stage")
    orders = table(spark, sf_dir, "orders")
    month = cob_of(F.trunc(F.to_date("o_orderdate"), "month"))
    text = orders.select(
        F.concat(F.lit("k"), "o_orderkey").alias("Key"),
        F.col("o_custkey").cast("string").alias("customer"),
        F.when(F.col("o_totalprice") > 1000, F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("price"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"),
        F.concat(F.lit('a "b",\n'), "o_orderpriority").alias("note"),
        # folders become status=F/month=m-20010131; "-" sets the COB apart
        F.concat(F.lit("m-"), month).alias("month"),
        F.col("o_orderstatus").alias("status"),
    )
    folders = ["status", "month"]
    writer = text.hint("rebalance", *folders).write.partitionBy(*folders).option("header", True).option("escape", '"')
    writer.format(kind).save(f"{root}/in")

    # headers match without case, names inside records as they are written
    declared = [("KEY" if kind == "csv" else "Key", "order_key", 1, "VARCHAR", 40, 0, 0), ("Customer" if kind == "csv" else "customer", "customer_id", 2, "NUMERIC", 0, 0, 0),
                ("price", "price", 3, "NUMERIC", 0, 18, 2), ("day", "order_day", 4, "DATE", 0, 0, 0)]
    span = orders.agg(F.trunc(F.to_date(F.min("o_orderdate")), "month"), F.to_date(F.max("o_orderdate"))).toDF("a", "z")
    days = calendar(span, orders.select(F.to_date("o_orderdate")).where(F.lit(False)))
    as_of = F.lit("2002-01-01 00:00:00").cast("timestamp")
    codes = orders.select(F.col("o_orderstatus").alias("code")).distinct()
    expected = expected_files(codes, "orders", "/in/status=|code|/month=m-|:YYYYMMDD:|/", kind, declared, days, as_of)
    manifest = manifest_of(list_files(spark, f"{root}/in", rf"[.]{kind}$"), root)
    # the files' charset is one of the JVM's
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    options = StageOptions(root, f"{root}/out", f"{root}/log", allow_create=True)
    loads = stage_files(spark, manifest, expected, options, as_of)
    loads.where("process_status <> 'SUCCESS'").select(F.assert_true(F.lit(False), "a load failed")).collect()
    staged = spark.read.parquet(table_path(options, "DW.ORDERS"))
    return staged.select(
        "order_key", F.col("customer_id").cast("bigint").alias("customer_id"), F.col("price").cast("double").alias("price"),
        "order_day", F.col("NOTE").alias("note"), F.col("scope.entity_code").alias("entity_code"), "dataset_name",
    )


def staged_json(spark, sf_dir):
    return staged_orders(spark, sf_dir, "json")


def staged_parquet(spark, sf_dir):
    return staged_orders(spark, sf_dir, "parquet")


SQL_STAGED_ORDERS = """
SELECT 'k' || o_orderkey AS order_key, o_custkey AS customer_id, CASE WHEN o_totalprice > 1000 THEN o_totalprice END AS price,
       CAST(o_orderdate AS DATE) AS order_day, 'a "b",' || chr(10) || o_orderpriority AS note, o_orderstatus AS entity_code,
       'orders_' || o_orderstatus AS dataset_name
FROM orders"""


def stream_ingest(spark, sf_dir):
    """Events written as files and taken in by an available-now stream."""
    root = work_dir(spark, "stream")
    events = table(spark, sf_dir, "events")
    plain = events.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    plain.write.option("header", True).option("escape", '"').csv(f"{root}/in")
    schema = "event_id bigint, ts string, user_id bigint, event_type string, value double, props string"
    stream = file_stream(spark, f"{root}/in", schema, header=True, escape='"', maxFilesPerTrigger=4)
    ingest(stream, f"{root}/out", f"{root}/checkpoint", partitions=["event_type"]).awaitTermination()
    return spark.read.parquet(f"{root}/out").select("event_id", "ts", "user_id", "event_type", "value", "props")


SQL_STREAM_INGEST = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props FROM events"""

QUERIES = {
    "typed_projection": typed,
    "error_policy": error_policy,
    "infer_types": inferred_types,
    "reload_by_dataset": reload_dataset,
    "reload_by_file": reload_file,
    "not_yet_loaded": not_loaded,
    "header_map": headers,
    "header_columns": header_only,
    "profile_delimited": profile,
    "file_row_numbers": row_numbers,
    "file_listing": file_listing,
    "list_storage": storage_listing,
    "list_wanted": wanted_listing,
    "stage_files": staged_orders,
    "stage_json": staged_json,
    "stage_parquet": staged_parquet,
    "stream_ingest": stream_ingest,
}

ORACLES = {
    "typed_projection": SQL_TYPED,
    "error_policy": SQL_ERROR_POLICY,
    "infer_types": SQL_INFERRED_TYPES,
    "reload_by_dataset": SQL_RELOAD_BY_DATASET,
    "reload_by_file": SQL_RELOAD_BY_FILE,
    "not_yet_loaded": SQL_NOT_LOADED,
    "header_map": SQL_HEADERS,
    "header_columns": SQL_HEADER_ONLY,
    "profile_delimited": SQL_PROFILE,
    "file_row_numbers": SQL_ROW_NUMBERS,
    "file_listing": SQL_FILE_LISTING,
    "list_storage": SQL_STORAGE_LISTING,
    "list_wanted": SQL_WANTED_LISTING,
    "stage_files": SQL_STAGED_ORDERS,
    "stage_json": SQL_STAGED_ORDERS,
    "stage_parquet": SQL_STAGED_ORDERS,
    "stream_ingest": SQL_STREAM_INGEST,
}
