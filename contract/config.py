"""Configuration-model queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract.common import stamp, table, when_text
from quayside.functions import names, paths, text
from quayside.functions.dates import boundaries, cob_of, java_format, local_to_utc, parse_http_date
from quayside.operators.compare import compare_cells, compare_tables
from quayside.operators.dedupe import duplicate_keys, missing_references, occurring_once
from quayside.operators.merge import conform, count_actions, merge_sync, merge_upsert, sync_actions
from quayside.plans.calendar import calendar, stored_calendar
from quayside.plans.catalog import feed_rollup, field_catalog
from quayside.plans.catalog import overall_config as build_overall_config
from quayside.plans.expected import at_cob, dataset_catalog, enrich_manifest, match_datasets, with_cobs
from quayside.plans.expected import upload_chunks as build_upload_chunks
from quayside.plans.expected import upload_plan as build_upload_plan
from quayside.plans.sync import sync_table
from quayside.plans.validate import metadata_problems as find_problems

# ---------------------------------------------------------------- shaped inputs


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a feed."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("source_system_code"),
        F.concat(F.lit("o"), "o_orderkey").alias("source_feed_code"),
        F.concat(F.lit("EXT.S"), status).alias("stage_name"),
        F.when(status != "P", F.concat(F.lit("src/|:ENVIRONMENT:|/|:YYYY:|/c"), "o_custkey", F.lit("/")))
        .alias("source_file_path"),
        F.when(status == "F", "trigger_*.csv").alias("source_file_name_pattern"),
        F.when(status == "F", "STAGING").otherwise("DW").alias("destination_schema_name"),
        F.concat(F.lit("T"), "o_custkey").alias("destination_table_name"),
        (F.col("o_totalprice") > 50000).alias("is_enabled"),
        F.when(status == "O", "PARQUET_FORMAT").otherwise("CSV_FORMAT").alias("file_format"),
        F.lit("DD/MM/YYYY").alias("date_input_format"),
        F.lit("DD/MM/YYYY HH24:MI:SS").alias("timestamp_input_format"),
        F.lit(0).alias("skip_row_on_error"),
        F.lit(False).alias("delete_stage_by_file_name"),
        F.when(status == "P", "UTC").alias("timezone"),
    )


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line item is a field of its order's feed; the feed code differs in case."""
    lineitem = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    flag = F.col("l_returnflag")
    is_number = flag == "A"
    name = F.concat_ws("_", F.lit("f"), "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd"))
    return lineitem.join(orders, "l_orderkey").select(
        F.lower("o_orderpriority").alias("source_system_code"),
        F.concat(F.lit("O"), "l_orderkey").alias("source_feed_code"),
        name.alias("source_field_name"),
        F.concat(F.lit("t_"), name).alias("target_field_name"),
        F.when(F.col("l_linenumber") < 7, F.col("l_linenumber")).alias("field_ordinal"),
        F.when(is_number, "NUMERIC").when(flag == "N", "VARCHAR").when(F.col("l_tax") > 0.04, "DATE").otherwise("DOUBLE")
        .alias("data_type_name"),
        F.when(flag == "N", F.col("l_quantity").cast("int")).otherwise(0).alias("data_type_length"),
        F.when(is_number & (F.col("l_linenumber") > 3), 18).otherwise(0).alias("data_type_precision"),
        F.when(is_number & (F.col("l_linenumber") > 5), 2).otherwise(0).alias("data_type_scale"),
        (F.col("l_discount") > 0.01).alias("is_in_source"),
        F.when(F.col("l_quantity") > 5, F.col("l_quantity") < 48).alias("is_in_target"),
        (F.col("l_extendedprice") < 5000).alias("is_deleted"),
        F.when(F.col("l_discount") < 0.03, F.concat(F.lit("upper("), name, F.lit(")"))).alias("derived_expression"),
    )


_FEEDS = """
feeds AS (
  SELECT o_orderpriority AS source_system_code, 'o' || o_orderkey AS source_feed_code, 'EXT.S' || o_orderstatus AS stage_name,
         CASE WHEN o_orderstatus <> 'P' THEN 'src/|:ENVIRONMENT:|/|:YYYY:|/c' || o_custkey || '/' END AS source_file_path,
         CASE WHEN o_orderstatus = 'F' THEN 'STAGING' ELSE 'DW' END AS destination_schema_name,
         'T' || o_custkey AS destination_table_name, o_totalprice > 50000 AS is_enabled,
         CASE WHEN o_orderstatus = 'O' THEN 'PARQUET_FORMAT' ELSE 'CSV_FORMAT' END AS file_format,
         CASE WHEN o_orderstatus = 'P' THEN 'UTC' END AS timezone, o_orderkey, o_orderdate, o_totalprice, o_orderstatus, o_custkey
  FROM orders),
fields AS (
  SELECT lower(o_orderpriority) AS source_system_code, 'O' || l_orderkey AS source_feed_code,
         'f_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey || '_' || strftime(l_shipdate, '%Y%m%d') AS source_field_name,
         't_f_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey || '_' || strftime(l_shipdate, '%Y%m%d') AS target_field_name,
         CASE WHEN l_linenumber < 7 THEN l_linenumber END AS field_ordinal,
         CASE WHEN l_returnflag = 'A' THEN 'NUMERIC' WHEN l_returnflag = 'N' THEN 'VARCHAR' WHEN l_tax > 0.04 THEN 'DATE'
              ELSE 'DOUBLE' END AS data_type_name,
         CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS INT) ELSE 0 END AS len,
         CASE WHEN l_returnflag = 'A' AND l_linenumber > 3 THEN 18 ELSE 0 END AS prec,
         CASE WHEN l_returnflag = 'A' AND l_linenumber > 5 THEN 2 ELSE 0 END AS scale,
         l_discount > 0.01 AS is_in_source, CASE WHEN l_quantity > 5 THEN l_quantity < 48 END AS is_in_target,
         l_extendedprice < 5000 AS is_deleted,
         CASE WHEN l_discount < 0.03 THEN 'upper(f_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey || '_'
              || strftime(l_shipdate, '%Y%m%d') || ')' END AS derived_expression
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
size_rule(plain, sized, digits, fraction, form) AS (VALUES
  (TRUE, NULL, NULL, NULL, ''), (FALSE, TRUE, NULL, NULL, '(L)'), (FALSE, FALSE, TRUE, FALSE, '(P)'),
  (FALSE, FALSE, FALSE, FALSE, '(38)'), (FALSE, FALSE, TRUE, TRUE, '(P,S)'), (FALSE, FALSE, FALSE, TRUE, '')),
frame_rule(kind, digits, form) AS (VALUES ('DATE', NULL, 'DateType()'), ('NUMERIC', FALSE, 'IntegerType()'),
  ('NUMERIC', TRUE, 'DecimalType(P,S)')),
catalog AS (
  SELECT s.source_system_code, s.source_feed_code, s.stage_name, s.file_format, s.is_enabled,
         CASE WHEN destination_schema_name LIKE '%STAGING%'
              THEN destination_schema_name || '.' || s.source_system_code || '_' || destination_table_name
              ELSE destination_schema_name || '.' || destination_table_name END AS destination_full_table_name,
         coalesce(timezone, 'Europe/London') AS timezone, source_field_name, target_field_name, field_ordinal,
         data_type_name || replace(replace(replace(size_rule.form, 'L', len::VARCHAR), 'P', prec::VARCHAR), 'S', scale::VARCHAR) AS data_type_size,
         coalesce(replace(replace(frame_rule.form, 'P', prec::VARCHAR), 'S', scale::VARCHAR), 'StringType()') AS frame_data_type,
         is_in_source, is_in_target, derived_expression, 'INT_SALES' AS current_database_name, 'INT' AS environment
  FROM feeds s LEFT JOIN fields f ON lower(s.source_system_code) = lower(f.source_system_code)
       AND lower(s.source_feed_code) = lower(f.source_feed_code) AND f.is_deleted = FALSE
       LEFT JOIN size_rule ON size_rule.plain = (data_type_name IN ('DOUBLE', 'DATE'))
            AND coalesce(size_rule.sized, len > 0) = (len > 0)
            AND coalesce(size_rule.digits, prec > 0) = (prec > 0) AND coalesce(size_rule.fraction, scale > 0) = (scale > 0)
       LEFT JOIN frame_rule ON frame_rule.kind = data_type_name AND coalesce(frame_rule.digits, prec > 0) = (prec > 0))"""

_CATALOG_COLUMNS = [
    "source_system_code", "source_feed_code", "stage_name", "file_format", "is_enabled", "destination_full_table_name",
    "timezone", "source_field_name", "target_field_name", "field_ordinal", "data_type_size", "frame_data_type",
    "is_in_source", "is_in_target", "derived_expression", "current_database_name", "environment",
]


def _catalog(spark, sf_dir):
    return field_catalog(feeds(spark, sf_dir), fields(spark, sf_dir), "INT_SALES")


def catalog(spark, sf_dir):
    return _catalog(spark, sf_dir).select(*_CATALOG_COLUMNS)


SQL_CATALOG = f"WITH {_FEEDS} SELECT {', '.join(_CATALOG_COLUMNS)} FROM catalog"

_ROLLUP_LISTS = {
    "list_data_type_name": "data_type_size",
    "list_column_name_source": "CASE WHEN is_in_source THEN source_field_name END",
    "list_column_position_source": "CASE WHEN is_in_source THEN CAST(ordinal AS VARCHAR) END",
    "list_column_name_target": "CASE WHEN is_in_source THEN upper('\"' || target_field_name || '\"') END",
    "list_create_column_name_target": "upper('\"' || target_field_name || '\"') || ' ' || data_type_size",
    "list_frame_struct_field": "CASE WHEN is_in_source THEN upper('\"' || target_field_name || '\"') || '#' || frame_data_type END",
    "list_source_reference": (
        "CASE WHEN is_in_source THEN CASE WHEN file_format LIKE '%PARQUET%' THEN '$1:' || source_field_name "
        "ELSE '$' || ordinal END END"
    ),
    "list_derived_expression": "CASE WHEN is_in_source THEN coalesce(derived_expression, '') END",
    "list_extra_field_name": (
        "CASE WHEN NOT is_in_source AND length(derived_expression) > 0 THEN upper('\"' || target_field_name || '\"') END"
    ),
    "list_extra_derived_expression": (
        "CASE WHEN NOT is_in_source AND length(derived_expression) > 0 THEN derived_expression END"
    ),
}


def rollup(spark, sf_dir):
    """A feed's field list is its order's lines."""
    out = feed_rollup(_catalog(spark, sf_dir))
    return out.select(
        "source_system_code", "source_feed_code", "destination_full_table_name", "has_field_data",
        *[F.array_join(F.col(c).cast("array<string>"), "~").alias(c) for c in _ROLLUP_LISTS],
    )


SQL_ROLLUP = f"""WITH {_FEEDS},
d AS (SELECT *, coalesce(field_ordinal, 1) AS ordinal FROM catalog
      WHERE coalesce(field_ordinal, 1) >= 0 AND coalesce(is_in_target, TRUE))
SELECT source_system_code, source_feed_code, max(destination_full_table_name) AS destination_full_table_name,
       count(is_in_source) > 0 AS has_field_data,
       {", ".join(f"coalesce(string_agg({v}, '~' ORDER BY ordinal, source_field_name), '') AS {k}" for k, v in _ROLLUP_LISTS.items())}
FROM d GROUP BY source_system_code, source_feed_code"""


def overall_config(spark, sf_dir):
    """Feeds of settled orders against the datasets of large orders."""
    orders = table(spark, sf_dir, "orders")
    some_feeds = feeds(spark, sf_dir).where("stage_name <> 'EXT.SP'")
    parameters = orders.where("o_totalprice > 200000").select(
        F.col("o_orderpriority").alias("source_system_code"),
        F.concat(F.lit("o"), "o_orderkey").alias("source_feed_code"),
        F.concat(F.lit("ds_"), "o_orderkey").alias("dataset_name"),
        F.when(F.col("o_orderstatus") == "F", "box").alias("container_name"),
        F.lit("/in/").alias("file_path"),
        F.concat(F.lit("f"), "o_orderkey", when_text("o_orderstatus", {"F": ".csv", "O": ".tar.gz"}, "")).alias("file_name"),
        F.when(F.col("o_totalprice") > 300000, True).alias("is_trigger_file"),
        F.lit(None).cast("boolean").alias("is_cloud_copy"),
        (F.col("o_custkey") > 100).alias("is_enabled"),
        F.lit(None).cast("timestamp").alias("last_modified"),
        F.lit(None).cast("timestamp").alias("first_time_inserted"),
    )
    out = build_overall_config(field_catalog(some_feeds, fields(spark, sf_dir), "INT_SALES"), parameters)
    return out.select(
        "source_system_code", "source_feed_code", "source_field_name", "source_file_is_enabled", "dataset_name",
        "container_name", "file_path", "file_name", "file_extension", "is_trigger_file", "is_cloud_copy",
        "task_list_name", "parameters_is_enabled",
    )


SQL_OVERALL_CONFIG = f"""WITH {_FEEDS},
sp AS (
  SELECT o_orderpriority AS system, 'o' || o_orderkey AS feed, 'ds_' || o_orderkey AS dataset_name,
         CASE WHEN o_orderstatus = 'F' THEN 'box' END AS container_name, '/in/' AS file_path,
         'f' || o_orderkey || CASE o_orderstatus WHEN 'F' THEN '.csv' WHEN 'O' THEN '.tar.gz' ELSE '' END AS file_name,
         CASE WHEN o_totalprice > 300000 THEN TRUE END AS is_trigger_file, o_custkey > 100 AS is_enabled
  FROM orders WHERE o_totalprice > 200000)
SELECT source_system_code, source_feed_code, source_field_name, coalesce(fl.is_enabled, FALSE) AS source_file_is_enabled,
       coalesce(dataset_name, 'N/A') AS dataset_name, coalesce(container_name, 'N/A') AS container_name,
       coalesce(file_path, 'N/A') AS file_path, coalesce(file_name, 'N/A') AS file_name,
       split_part(file_name, '.', -1) AS file_extension, coalesce(is_trigger_file, FALSE) AS is_trigger_file,
       FALSE AS is_cloud_copy, upper('TASK_' || split_part(stage_name, '.', -1) || '_' || split_part(file_name, '.', -1)) AS task_list_name,
       coalesce(sp.is_enabled, FALSE) AS parameters_is_enabled
FROM (SELECT * FROM catalog WHERE stage_name <> 'EXT.SP') fl
FULL JOIN sp ON fl.source_system_code = sp.system AND fl.source_feed_code = sp.feed"""


def _order_calendar(orders: DataFrame) -> DataFrame:
    span = orders.agg(F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("last_day"))
    off = orders.select(F.to_date("o_orderdate").alias("d")).where(
        F.date_format("d", "MM-dd").isin("01-01", "12-24", "12-25", "12-26", "05-01")
    )
    return calendar(span, off)


_ORDER_CALENDAR = """
span AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z FROM orders),
days AS (SELECT CAST(unnest(generate_series(a, z + 3, INTERVAL 1 DAY)) AS DATE) AS my_date FROM span),
off AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS my_date FROM orders
        WHERE strftime(o_orderdate, '%m-%d') IN ('01-01', '12-24', '12-25', '12-26', '05-01')),
working AS (SELECT my_date FROM days WHERE dayofweek(my_date) NOT IN (0, 6) AND my_date NOT IN (SELECT my_date FROM off)),
calendar AS (
  SELECT d.my_date, d.my_date IN (SELECT my_date FROM off) AS is_bank_holiday,
         (SELECT min(w.my_date) FROM working w WHERE w.my_date > d.my_date) AS next_business_day,
         CAST(strftime(d.my_date, '%Y%m%d') AS INT) AS cob_id
  FROM days d, span WHERE d.my_date <= span.z)"""


def calendar_nbd(spark, sf_dir):
    """Calendar over the order dates, with the orders of each day."""
    orders = table(spark, sf_dir, "orders")
    per_day = orders.groupBy(cob_of("o_orderdate").alias("cob_id")).agg(F.count(F.lit(1)).alias("n_orders"))
    return stored_calendar(_order_calendar(orders)).join(per_day, "cob_id", "left")


SQL_CALENDAR_NBD = f"""WITH {_ORDER_CALENDAR},
n AS (SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS cob_id, count(*) AS n_orders FROM orders GROUP BY ALL)
SELECT c.cob_id, my_date, CAST(year(my_date) AS INT) AS year, CAST(month(my_date) AS INT) AS month,
       strftime(my_date, '%b') AS month_name, CAST(day(my_date) AS INT) AS day_of_mon, strftime(my_date, '%a') AS day_week_name,
       CAST(dayofweek(my_date) AS INT) AS day_of_week, CAST(weekofyear(my_date) AS INT) AS week_of_year,
       CAST(dayofyear(my_date) AS INT) AS day_of_year, is_bank_holiday, next_business_day, n_orders
FROM calendar c LEFT JOIN n USING (cob_id)"""


def _supplier_datasets(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    feed_code = F.concat(F.lit("n"), "s_nationkey")
    nation_feeds = table(spark, sf_dir, "nation").select(
        F.lit("SUP").alias("source_system_code"),
        F.concat(F.lit("n"), "n_nationkey").alias("source_feed_code"),
        F.lit("EXT.SUP").alias("stage_name"),
        F.lit(None).cast("string").alias("source_file_path"),
        F.when(F.col("n_regionkey") == 1, "all_*.csv").when(F.col("n_regionkey") == 2, "").alias("source_file_name_pattern"),
        F.lit("STAGING").alias("destination_schema_name"),
        F.col("n_name").alias("destination_table_name"),
        F.lit(True).alias("is_enabled"),
        F.lit("CSV_FORMAT").alias("file_format"),
        F.lit("DD/MM/YYYY").alias("date_input_format"),
        F.lit("DD/MM/YYYY").alias("timestamp_input_format"),
        F.lit(0).alias("skip_row_on_error"),
        F.lit(False).alias("delete_stage_by_file_name"),
        F.lit(None).cast("string").alias("timezone"),
    )
    no_fields = fields(spark, sf_dir).where(F.lit(False))
    parameters = supplier.select(
        F.concat(F.lit("ds_"), "s_suppkey").alias("dataset_name"),
        F.lit("SUP").alias("source_system_code"),
        feed_code.alias("source_feed_code"),
        F.lit("c").alias("container_name"),
        F.when(F.col("s_acctbal") > 5000, "in/|:YYYYMM:|/|:YYYYMMDD:|")
        .when(F.col("s_acctbal") > 3000, "/arch/|:YYYY:|-|:MM:|/x/")
        .otherwise(F.concat(F.lit("/static/"), feed_code, F.lit("/"))).alias("file_path"),
        F.concat(F.lit("s"), "s_suppkey", F.lit("_|:YYYYMMDD:|_|:YYYY:|.csv")).alias("file_name"),
        (F.col("s_acctbal") > 0).alias("is_enabled"),
        *[F.lit(False).alias(c) for c in ("is_trigger_file", "allow_reload", "is_cloud_copy", "allow_infer_schema")],
        *[F.lit(None).cast("string").alias(c) for c in
          ("entity_code", "department_code", "region", "market", "expected_stage_time", "warehouse_size")],
        F.array().cast("array<string>").alias("tags"),
    )
    return dataset_catalog(parameters, feed_rollup(field_catalog(nation_feeds, no_fields, "INT_SALES")))


def expected_datasets(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    as_of = F.lit("2001-06-30").cast("date")
    out = at_cob(with_cobs(_supplier_datasets(spark, sf_dir), _order_calendar(orders), as_of, days=180))
    return out.select(
        "dataset_name", "cob_id", "stage_name", "file_extension", "file_name_no_extension", "source_file_name_pattern",
        "folder_pattern_cob", "folder_path_cob", "file_name_cob", "folder_pattern",
    )


SQL_EXPECTED_DATASETS = f"""WITH {_ORDER_CALENDAR},
cobs AS (SELECT 19000101 AS cob_id UNION ALL
         SELECT cob_id FROM (SELECT cob_id FROM calendar WHERE my_date <= DATE '2001-06-30' ORDER BY cob_id DESC LIMIT 180)),
p AS (
  SELECT 'ds_' || s_suppkey AS dataset_name, s_acctbal AS b, s_nationkey, s_suppkey, n_regionkey,
         CAST(cob_id AS VARCHAR) AS c, cob_id
  FROM supplier JOIN nation ON n_nationkey = s_nationkey CROSS JOIN cobs WHERE s_acctbal > 0)
SELECT dataset_name, cob_id, 'EXT.SUP' AS stage_name, 'csv' AS file_extension,
       's' || s_suppkey || '_|:YYYYMMDD:|_|:YYYY:|' AS file_name_no_extension,
       CASE WHEN n_regionkey = 1 THEN 'all_*.csv' ELSE 's' || s_suppkey || '_|:YYYYMMDD:|_|:YYYY:|.csv' END AS source_file_name_pattern,
       CASE WHEN b > 5000 THEN '.*/' || left(c, 6) || '.*/' || c || '.*/'
            WHEN b > 3000 THEN '.*/' || left(c, 4) || '.*/' || c[5:6] || '.*/' ELSE '.*/' END AS folder_pattern_cob,
       CASE WHEN b > 5000 THEN '/in/' || left(c, 6) || '/' || c || '/'
            WHEN b > 3000 THEN '/arch/' || left(c, 4) || '-' || c[5:6] || '/x/'
            ELSE '/static/n' || s_nationkey || '/' END AS folder_path_cob,
       's' || s_suppkey || '_' || c || '_' || left(c, 4) || '.csv' AS file_name_cob,
       CASE WHEN b > 5000 THEN '.*' || left(c, 6) || '.*/' || c || '.*/'
            WHEN b > 3000 THEN '.*' || left(c, 4) || '.*/' || c[5:6] || '.*/'
            ELSE '.*static/n' || s_nationkey || '/' END AS folder_pattern
FROM p"""


def upload_plan(spark, sf_dir):
    """Each line item is a file to upload, its order the source folder."""
    cob = 20010131
    order_files = feeds(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("source_system_code")
    )
    lineitem = table(spark, sf_dir, "lineitem").join(orders, "l_orderkey")
    wanted = at_cob(
        lineitem.select(
            "source_system_code",
            F.concat(F.lit("o"), "l_orderkey").alias("source_feed_code"),
            F.lit(cob).alias("cob_id"),
            F.lit("/land/|:YYYYMMDD:|/").alias("file_path"),
            F.concat(F.lit("l"), "l_linenumber", F.lit("_"), "l_partkey", F.lit("_|:YYYYMM:|.csv")).alias("file_name"),
        )
    )
    per_order = order_files.withColumn(
        "source_file_path", F.concat("source_file_path", "source_feed_code", F.lit("/"))
    )
    return build_upload_plan(per_order, wanted, cob, "INT_SALES")


SQL_UPLOAD_PLAN = """
WITH f AS (
  SELECT 'src/int/2001/c' || o_custkey || '/o' || o_orderkey || '/' AS source_file_path, '/land/20010131/' AS destination_file_path,
         'l' || l_linenumber || '_' || l_partkey || '_200101.csv' AS file_name
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' AND o_totalprice > 50000)
SELECT source_file_path, destination_file_path, CAST(count(*) AS INT) AS n_files,
       CAST(to_json({'source_file_path': source_file_path, 'destination_file_path': destination_file_path,
                     'file_list': list(file_name ORDER BY file_name)}) AS VARCHAR) AS file_detail
FROM f GROUP BY source_file_path, destination_file_path"""


#: Files in one chunk of an upload.
CHUNK = 250


def upload_chunks(spark, sf_dir):
    """The upload plan of few large source folders, one for each priority, in chunks of bounded size."""
    cob = 20010131
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("source_system_code")
    )
    wanted = at_cob(
        table(spark, sf_dir, "lineitem").join(orders, "l_orderkey").select(
            "source_system_code",
            F.concat(F.lit("o"), "l_orderkey").alias("source_feed_code"),
            F.lit(cob).alias("cob_id"),
            F.lit("/land/|:YYYYMMDD:|/").alias("file_path"),
            F.concat(F.lit("l"), "l_linenumber", F.lit("_"), "l_partkey", F.lit("_|:YYYYMM:|.csv")).alias("file_name"),
        )
    )
    by_priority = feeds(spark, sf_dir).withColumn(
        "source_file_path", F.regexp_replace("source_file_path", "^.*$", F.concat(F.lit("src/p"), F.substring("source_system_code", 1, 1), F.lit("/")))
    )
    return build_upload_chunks(by_priority, wanted, cob, "INT_SALES", limit=CHUNK, together=1000)


SQL_UPLOAD_CHUNKS = f"""
WITH f AS (
  SELECT 'src/p' || left(o_orderpriority, 1) || '/' AS source_file_path, '/land/20010131/' AS destination_file_path,
         'l' || l_linenumber || '_' || l_partkey || '_200101.csv' AS file_name
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' AND o_totalprice > 50000),
n AS (
  SELECT *, (row_number() OVER (PARTITION BY source_file_path ORDER BY md5(file_name)) - 1) // {CHUNK} + 1 AS chunk,
         (count(*) OVER (PARTITION BY source_file_path) + {CHUNK - 1}) // {CHUNK} AS n_chunks
  FROM f)
SELECT source_file_path, destination_file_path, chunk, n_chunks, CAST(count(*) AS INT) AS n_files,
       CAST(to_json({{'source_file_path': source_file_path, 'destination_file_path': destination_file_path, 'chunk': chunk,
                      'n_chunks': n_chunks, 'file_list': list(file_name ORDER BY file_name)}}) AS VARCHAR) AS file_detail
FROM n GROUP BY source_file_path, destination_file_path, chunk, n_chunks"""


def matched_files(spark, sf_dir):
    """Each order is an arrived file; a dataset takes the files of one status in
    one priority folder, and another one takes every file of a container."""
    orders = table(spark, sf_dir, "orders")
    digit = F.substring("o_orderpriority", 1, 1)
    cob = cob_of("o_orderdate")
    files = enrich_manifest(
        orders.select(
            "o_orderkey",
            F.concat(F.lit("/in/"), cob, F.lit("/p"), digit, F.lit("//sub/")).alias("folder_path"),
            F.concat(F.lit("o"), "o_orderkey", F.lit("_"), F.lower("o_orderstatus"), F.lit(".csv")).alias("file_name"),
            F.concat(when_text("o_orderstatus", {"F": "test3-", "O": "dvlp-"}, ""), F.lit("sales")).alias("container"),
        )
    )
    datasets = orders.select(digit.alias("digit"), "o_orderstatus").distinct().select(
        F.concat_ws("_", F.lit("ds"), "digit", "o_orderstatus").alias("dataset_name"),
        F.lit("sales").alias("container_name"),
        F.concat(F.lit("/in/|:YYYYMMDD:|/p"), "digit", F.lit("/")).alias("file_path"),
        F.concat(F.lit("O*_"), "o_orderstatus", F.lit(".csv")).alias("file_name"),
    )
    everything = orders.select("o_orderstatus").distinct().select(
        F.concat_ws("_", F.lit("all"), "o_orderstatus").alias("dataset_name"),
        F.lit("sales").alias("container_name"),
        F.lit("/_n/").alias("file_path"),
        F.concat(F.lit("*_"), "o_orderstatus", F.lit("*")).alias("file_name"),
    )
    as_of = F.lit("2001-12-31").cast("date")
    expected = at_cob(with_cobs(datasets.unionByName(everything), _order_calendar(orders), as_of, days=3000))
    return match_datasets(files, expected).select("o_orderkey", "cob_id", "source_folder", "container_name", "dataset_name")


SQL_MATCHED_FILES = """
WITH f AS (
  SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS cob_id, left(o_orderpriority, 1) AS digit, o_orderstatus,
         'in/' || strftime(o_orderdate, '%Y%m%d') || '/p' || left(o_orderpriority, 1) || '/sub' AS source_folder,
         'o' || o_orderkey || '_' || lower(o_orderstatus) || '.csv' AS file_name
  FROM orders),
d AS (
  SELECT DISTINCT 'ds_' || left(o_orderpriority, 1) || '_' || o_orderstatus AS dataset_name, 'O*_' || o_orderstatus || '.csv' AS pattern,
         '/in/%/p' || left(o_orderpriority, 1) || '/' AS path FROM orders
  UNION ALL SELECT DISTINCT 'all_' || o_orderstatus, '*_' || o_orderstatus || '*', '/_n/' FROM orders)
SELECT o_orderkey, cob_id, source_folder, 'sales' AS container_name, dataset_name
FROM f JOIN d ON upper(file_name) LIKE replace(upper(pattern), '*', '%')
      AND upper('/' || source_folder || '/') LIKE replace(upper(path), '/%/', '/' || cob_id || '/') || '%'"""


def cob_paths(spark, sf_dir):
    """COB of order files whose date stands in a folder, in the name, or nowhere."""
    day = F.date_format("o_orderdate", "yyyyMMdd")
    path = (
        F.when(F.col("o_orderstatus") == "F",
               F.concat(F.lit("in/"), F.date_format("o_orderdate", "yyyy/yyyyMM"), F.lit("/"), day, F.lit("/f.csv")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("in/f_"), day, F.lit("-"), "o_custkey", F.lit(".csv")))
        .otherwise(F.concat(F.lit("in/static/o"), "o_orderkey", F.lit(".csv")))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", paths.cob_from_path(path).alias("cob_id"), paths.find_cob(path).alias("found")
    )


SQL_COB_PATHS = r"""
WITH p AS (
  SELECT o_orderkey, CASE o_orderstatus
           WHEN 'F' THEN 'in/' || strftime(o_orderdate, '%Y/%Y%m/%Y%m%d') || '/f.csv'
           WHEN 'O' THEN 'in/f_' || strftime(o_orderdate, '%Y%m%d') || '-' || o_custkey || '.csv'
           ELSE 'in/static/o' || o_orderkey || '.csv' END AS path
  FROM orders)
SELECT o_orderkey,
       coalesce(list_filter(list_transform(list_filter(string_split_regex(path, '[-_/.]'),
                lambda x: regexp_full_match(x, '[0-9]+')), lambda x: TRY_CAST(x AS BIGINT)), lambda n: n > 19000100)[1], 19000101) AS cob_id,
       replace(nullif(regexp_extract(path, '(^|[^\w]|\s)\d{8}([^\w]|\s|$)'), ''), '/', '') AS found
FROM p"""


def path_parts(spark, sf_dir):
    """Folder, name and extension of every page address; tidy and stripped forms."""
    return table(spark, sf_dir, "pages").select(
        "page_id",
        paths.leaf("url").alias("leaf"),
        paths.without_leaf("url").alias("folder"),
        paths.file_extension("url").alias("extension"),
        paths.tidy_path("url").alias("tidy"),
        text.strip_empty("url", "/").alias("stripped"),
        paths.slash_wrapped("url").alias("wrapped"),
        paths.container_name(F.concat(F.lit("test2-"), F.split_part("url", F.lit("/"), F.lit(3)))).alias("container"),
        text.split_part("url", ".", 0).alias("first_part"),
        F.array_join(F.map_values(text.trigger_map(F.concat(F.lit("a:"), "page_id", F.lit(",b:x:y")))), ";").alias("trigger"),
        text.strip_bom(F.concat(F.lit("ï»¿"), "url")).alias("no_bom"),
        F.array_join(text.split_tags(F.replace("url", F.lit("/"), F.lit("#"))), "+").alias("tags"),
    )


SQL_PATH_PARTS = """
SELECT page_id, split_part(url, '/', -1) AS leaf,
       CASE WHEN split_part(url, '/', -1) = '' THEN url ELSE replace(url, split_part(url, '/', -1), '') END AS folder,
       split_part(url, '.', -1) AS extension,
       array_to_string(list_filter(string_split(url, '/'), lambda x: x <> ''), '/') AS tidy,
       array_to_string(list_filter(string_split(url, '/'), lambda x: x <> ''), '/') AS stripped,
       CASE WHEN url LIKE '/%' THEN '' ELSE '/' END || url || CASE WHEN url LIKE '%/' THEN '' ELSE '/' END AS wrapped,
       split_part(url, '/', 3) AS container, split_part(url, '.', 1) AS first_part,
       page_id || ';x' AS trigger, url AS no_bom,
       array_to_string(list_filter(string_split(replace(url, '/', '#'), '#'), lambda x: x <> ''), '+') AS tags
FROM pages"""


def normalise_names(spark, sf_dir):
    """The three name rules over names made of every part's text columns."""
    mixed = F.concat(F.lit("Part"), F.initcap("p_name"), F.lit("  (#"), "p_brand", F.lit(") "), F.lower("p_type"), F.lit("ID_"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        names.inferred_name(mixed).alias("inferred"),
        names.profiled_name(mixed).alias("profiled"),
        names.header_name(mixed).alias("header"),
    )


SQL_NORMALISE_NAMES = r"""
WITH p AS (
  SELECT p_partkey, 'Part' || array_to_string(list_transform(string_split(p_name, ' '),
             lambda w: upper(w[1]) || lower(w[2:])), ' ') || '  (#' || p_brand || ') ' || lower(p_type) || 'ID_' AS m
  FROM part)
SELECT p_partkey,
       regexp_replace(regexp_replace(upper(regexp_replace(regexp_replace(regexp_replace(m, '[(#)]', '', 'g'), ' +', '_', 'g'),
             '([^A-Z])([A-Z])', '\1_\2', 'g')), '_+', '_', 'g'), '^_', '') AS inferred,
       upper(regexp_replace(m, '\W', '', 'g')[1] ||
             regexp_replace(regexp_replace(m, '\W', '', 'g')[2:], '([A-Z])', '_\1', 'g')) AS profiled,
       regexp_replace(upper(m), '[^A-Za-z0-9]+', '_', 'g') AS header
FROM p"""


def date_rules(spark, sf_dir):
    """Boundary counts, header dates, zone conversion and configured formats."""
    written = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    end = F.col("ts") + F.make_dt_interval(secs=F.col("value").cast("decimal(18,6)"))
    day_text = F.date_format("ts", "dd/MM/yyyy HH:mm:ss")
    parsed = F.try_to_timestamp(day_text, F.lit(java_format("DD/MM/YYYY HH24:MI:SS")))
    return table(spark, sf_dir, "events").select(
        "event_id",
        boundaries("second", "ts", end).alias("seconds"),
        boundaries("minute", "ts", end).alias("minutes"),
        boundaries("hour", "ts", end).alias("hours"),
        stamp(parse_http_date(written)).alias("header_date"),
        stamp(local_to_utc("ts", "America/New_York")).alias("utc"),
        stamp(parsed).alias("parsed"),
        text.thousands(F.col("value") * 1000).alias("thousands"),
    )


SQL_DATE_RULES = """
WITH e AS (SELECT *, ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS fin FROM events)
SELECT event_id, date_diff('second', ts, fin) AS seconds, date_diff('minute', ts, fin) AS minutes,
       date_diff('hour', ts, fin) AS hours, strftime(ts, '%Y-%m-%d %H:%M:%S') AS header_date,
       strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS utc, strftime(ts, '%Y-%m-%d %H:%M:%S') AS parsed,
       format('{:,}', CAST(round(value * 1000, 0) AS BIGINT)) AS thousands
FROM e"""

_NOW = "2002-01-01 00:00:00"


def _stored_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_orderdate < '2000-01-01'").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.col("o_orderdate").alias("first_time_inserted"),
        F.col("o_orderdate").alias("last_modified"),
    )


def _seed_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select(
        "o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), "o_orderstatus"
    )


def _stamped(df):
    return df.withColumn("first_time_inserted", stamp("first_time_inserted")).withColumn("last_modified", stamp("last_modified"))


def merge_upsert_orders(spark, sf_dir):
    """Open orders update the stored ones when their stored price is below 250000."""
    as_of = F.lit(_NOW).cast("timestamp_ntz")
    return _stamped(
        merge_upsert(
            _stored_orders(spark, sf_dir), _seed_orders(spark, sf_dir), ["o_orderkey"],
            matched_when=F.col("t.o_totalprice") < 250000, insert=["o_orderkey", "o_totalprice"], as_of=as_of,
        )
    )


_MERGE = """
t AS (SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderdate FROM orders WHERE o_orderdate < '2000-01-01'),
s AS (SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'F')"""

SQL_MERGE_UPSERT = f"""WITH {_MERGE}
SELECT t.o_orderkey, CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice, t.o_orderstatus,
       strftime(t.o_orderdate, '%Y-%m-%d %H:%M:%S') AS first_time_inserted,
       CASE WHEN s.o_orderkey IS NULL THEN strftime(t.o_orderdate, '%Y-%m-%d %H:%M:%S') ELSE '{_NOW}' END AS last_modified
FROM t LEFT JOIN s ON s.o_orderkey = t.o_orderkey AND t.o_totalprice < 250000
UNION ALL
SELECT o_orderkey, o_totalprice, NULL, '{_NOW}', '{_NOW}' FROM s
WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey AND t.o_totalprice < 250000)"""


def merge_sync_orders(spark, sf_dir):
    as_of = F.lit(_NOW).cast("timestamp_ntz")
    return _stamped(merge_sync(_stored_orders(spark, sf_dir), _seed_orders(spark, sf_dir), ["o_orderkey"], as_of))


SQL_MERGE_SYNC = f"""WITH {_MERGE}
SELECT s.*, coalesce(strftime(t.o_orderdate, '%Y-%m-%d %H:%M:%S'), '{_NOW}') AS first_time_inserted, '{_NOW}' AS last_modified
FROM s LEFT JOIN t USING (o_orderkey)"""


def merge_actions(spark, sf_dir):
    return count_actions(sync_actions(_stored_orders(spark, sf_dir), _seed_orders(spark, sf_dir), ["o_orderkey"]))


SQL_MERGE_ACTIONS = f"""WITH {_MERGE}
SELECT CASE WHEN s.o_orderkey IS NULL THEN 'DISABLE' WHEN t.o_orderkey IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS action,
       count(*) AS n_rows
FROM t FULL JOIN s ON s.o_orderkey = t.o_orderkey GROUP BY ALL"""


def duplicate_lines(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


SQL_DUPLICATE_LINES = """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1"""


def rows_once(spark, sf_dir):
    """Line positions that occur in exactly one row."""
    return occurring_once(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


SQL_ROWS_ONCE = """
SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem GROUP BY ALL HAVING count(*) = 1"""


def missing_orders(spark, sf_dir):
    """Customers named by orders, checked against those of the known nations."""
    customers = table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey")
    return missing_references(table(spark, sf_dir, "orders"), "o_custkey", customers)


SQL_MISSING_ORDERS = """
SELECT DISTINCT o_custkey AS value FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)"""


def problems(spark, sf_dir):
    """Orders as feeds keyed by customer and status, line items as their fields."""
    files = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("source_system_code"), F.col("o_custkey").alias("source_feed_code"),
        F.col("o_orderpriority").alias("file_format"), F.concat(F.lit("S."), "o_orderstatus").alias("stage_name"),
    )
    fields_ = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("source_system_code"), F.col("l_orderkey").alias("source_feed_code"),
        F.col("l_linenumber").alias("source_field_name"), F.col("l_suppkey").alias("target_field_name"),
    )
    parameters = table(spark, sf_dir, "customer").select(F.concat_ws("_", "c_mktsegment", "c_nationkey").alias("dataset_name"))
    known = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' AND o_orderpriority < '4'")
    return find_problems(
        files, fields_, parameters, known.select("o_orderpriority"),
        known.select(F.concat(F.lit("S."), "o_orderstatus")),
    ).withColumnRenamed("check", "check_name")


SQL_PROBLEMS = """
WITH k AS (SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority < '4')
SELECT DISTINCT 'file format' AS check_name, o_orderpriority AS key, 1::BIGINT AS n_rows FROM orders
WHERE o_orderpriority NOT IN (SELECT o_orderpriority FROM k)
UNION ALL SELECT DISTINCT 'stage', 'S.' || o_orderstatus, 1 FROM orders WHERE o_orderstatus NOT IN (SELECT o_orderstatus FROM k)
UNION ALL SELECT 'source file', CAST(to_json({'source_system_code': o_orderstatus, 'source_feed_code': o_custkey}) AS VARCHAR), count(*)
          FROM orders GROUP BY o_orderstatus, o_custkey HAVING count(*) > 1
UNION ALL SELECT 'source field', CAST(to_json({'source_system_code': l_returnflag, 'source_feed_code': l_orderkey,
          'source_field_name': l_linenumber}) AS VARCHAR), count(*) FROM lineitem GROUP BY l_returnflag, l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'target field', CAST(to_json({'source_system_code': l_returnflag, 'source_feed_code': l_orderkey,
          'target_field_name': l_suppkey}) AS VARCHAR), count(*) FROM lineitem GROUP BY l_returnflag, l_orderkey, l_suppkey HAVING count(*) > 1
UNION ALL SELECT 'dataset', CAST(to_json({'dataset_name': c_mktsegment || '_' || c_nationkey}) AS VARCHAR), count(*)
          FROM customer GROUP BY c_mktsegment, c_nationkey HAVING count(*) > 1"""


def _edited(spark, sf_dir):
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return (
        table(spark, sf_dir, "orders").where("NOT (o_orderstatus = 'P' AND o_orderdate >= '2001-01-01')")
        .withColumn("o_totalprice", F.when(urgent, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
        .withColumn("o_orderstatus", F.when(urgent, F.lower("o_orderstatus")).otherwise(F.col("o_orderstatus")))
    )


_EDITED = """
e AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '1-URGENT' THEN lower(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus,
             CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderpriority
      FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderdate >= '2001-01-01')),
b AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders)"""


def compare_orders(spark, sf_dir):
    return compare_tables(table(spark, sf_dir, "orders"), _edited(spark, sf_dir), "base", "target", ignore=["o_orderdate"])


SQL_COMPARE_ORDERS = f"""WITH {_EDITED}
SELECT 'base' AS side, * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM e)
UNION ALL SELECT 'target', * FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM b)"""


def compare_repeated(spark, sf_dir):
    """Line items without their keys: many rows are equal, on either side more often than on the other."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_discount")
    other = rows.where("l_discount > 0.02").unionByName(rows.where("l_quantity < 10"))
    return compare_tables(rows, other, "base", "target")


SQL_COMPARE_REPEATED = """
WITH b AS (SELECT l_returnflag, l_linestatus, l_linenumber, l_quantity, l_discount FROM lineitem),
e AS (SELECT * FROM b WHERE l_discount > 0.02 UNION ALL SELECT * FROM b WHERE l_quantity < 10)
SELECT 'base' AS side, * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM e)
UNION ALL SELECT 'target', * FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM b)"""


def synced_fields(spark, sf_dir):
    """Field rows of a seed, padded and in other case, over those stored for the orders that are not pending."""
    shape = [F.col("o_orderpriority").alias("source_system_code"), F.col("o_orderstatus").alias("source_feed_code")]
    orders = table(spark, sf_dir, "orders")
    name = F.concat(F.lit("Field"), "o_orderkey")
    stored = orders.where("o_orderstatus <> 'P'").select(
        *shape, name.alias("source_field_name"), F.col("o_custkey").alias("field_ordinal"),
        F.col("o_orderdate").alias("first_time_inserted"), F.col("o_orderdate").alias("last_modified"),
    )
    seed = orders.where("o_totalprice > 50000").select(
        F.lower("o_orderpriority").alias("source_system_code"), F.lower("o_orderstatus").alias("source_feed_code"),
        F.concat(F.lit(" "), F.upper(name), F.lit("  ")).alias("source_field_name"), F.lit(1).cast("bigint").alias("field_ordinal"),
    )
    return _stamped(sync_table("source_field", stored, seed, F.lit(_NOW).cast("timestamp_ntz")))


SQL_SYNCED_FIELDS = f"""
SELECT lower(o_orderpriority) AS source_system_code, lower(o_orderstatus) AS source_feed_code, 'FIELD' || o_orderkey AS source_field_name,
       CAST(1 AS BIGINT) AS field_ordinal,
       CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') ELSE '{_NOW}' END AS first_time_inserted,
       '{_NOW}' AS last_modified
FROM orders WHERE o_totalprice > 50000"""


def compare_order_cells(spark, sf_dir):
    base = table(spark, sf_dir, "orders").drop("o_orderdate", "o_totalprice")
    return compare_cells(base, _edited(spark, sf_dir).drop("o_orderdate", "o_totalprice"), ["o_orderkey"])


SQL_COMPARE_CELLS = f"""WITH {_EDITED},
j AS (SELECT coalesce(b.o_orderkey, e.o_orderkey) AS k, b, e FROM b FULL JOIN e ON b.o_orderkey = e.o_orderkey)
SELECT k AS o_orderkey, 'o_custkey' AS column_name, CAST(b.o_custkey AS VARCHAR) AS base_value, CAST(e.o_custkey AS VARCHAR) AS other_value
FROM j WHERE b.o_custkey IS DISTINCT FROM e.o_custkey
UNION ALL SELECT k, 'o_orderstatus', b.o_orderstatus, e.o_orderstatus FROM j WHERE b.o_orderstatus IS DISTINCT FROM e.o_orderstatus
UNION ALL SELECT k, 'o_orderpriority', b.o_orderpriority, e.o_orderpriority FROM j WHERE b.o_orderpriority IS DISTINCT FROM e.o_orderpriority"""


def conform_schema(spark, sf_dir):
    return conform(
        table(spark, sf_dir, "customer"),
        {"C_CUSTKEY": "string", "c_acctbal": "bigint", "c_name": "int", "c_mktsegment": "string", "added": "date"},
    )


SQL_CONFORM_SCHEMA = """
SELECT CAST(c_custkey AS VARCHAR) AS "C_CUSTKEY", CAST(trunc(c_acctbal) AS BIGINT) AS c_acctbal,
       TRY_CAST(c_name AS INT) AS c_name, c_mktsegment, CAST(NULL AS DATE) AS added FROM customer"""

QUERIES = {
    "field_catalog": catalog,
    "feed_rollup": rollup,
    "overall_config": overall_config,
    "calendar_nbd": calendar_nbd,
    "expected_datasets": expected_datasets,
    "upload_plan": upload_plan,
    "upload_chunks": upload_chunks,
    "match_datasets": matched_files,
    "cob_from_path": cob_paths,
    "path_parts": path_parts,
    "normalise_names": normalise_names,
    "date_rules": date_rules,
    "merge_upsert": merge_upsert_orders,
    "merge_sync": merge_sync_orders,
    "merge_actions": merge_actions,
    "duplicate_keys": duplicate_lines,
    "occurring_once": rows_once,
    "missing_references": missing_orders,
    "metadata_problems": problems,
    "compare_tables": compare_orders,
    "compare_repeated": compare_repeated,
    "sync_fields": synced_fields,
    "compare_cells": compare_order_cells,
    "conform_schema": conform_schema,
}

ORACLES = {
    "field_catalog": SQL_CATALOG,
    "feed_rollup": SQL_ROLLUP,
    "overall_config": SQL_OVERALL_CONFIG,
    "calendar_nbd": SQL_CALENDAR_NBD,
    "expected_datasets": SQL_EXPECTED_DATASETS,
    "upload_plan": SQL_UPLOAD_PLAN,
    "upload_chunks": SQL_UPLOAD_CHUNKS,
    "match_datasets": SQL_MATCHED_FILES,
    "cob_from_path": SQL_COB_PATHS,
    "path_parts": SQL_PATH_PARTS,
    "normalise_names": SQL_NORMALISE_NAMES,
    "date_rules": SQL_DATE_RULES,
    "merge_upsert": SQL_MERGE_UPSERT,
    "merge_sync": SQL_MERGE_SYNC,
    "merge_actions": SQL_MERGE_ACTIONS,
    "duplicate_keys": SQL_DUPLICATE_LINES,
    "occurring_once": SQL_ROWS_ONCE,
    "missing_references": SQL_MISSING_ORDERS,
    "metadata_problems": SQL_PROBLEMS,
    "compare_tables": SQL_COMPARE_ORDERS,
    "compare_repeated": SQL_COMPARE_REPEATED,
    "sync_fields": SQL_SYNCED_FIELDS,
    "compare_cells": SQL_COMPARE_CELLS,
    "conform_schema": SQL_CONFORM_SCHEMA,
}
