"""Queries of what changes over time: streams, table versions, increments, logs of listings."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract.common import stamp, table
from contract.observe import SQL_OUTLIER_BOUNDS, shipment_loads
from contract.staging import expected_files, work_dir
from quayside.functions.dates import cob_of
from quayside.operators.increments import refresh_from_increment, write_increment
from quayside.plans.calendar import calendar
from quayside.plans.stage import StageOptions, stage_files, table_path
from quayside.plans.log import current_log, load_id
from quayside.sources.listing import append_listing
from quayside.sources.scan import BLOCK, PATH, SEQ, number_rows, read_lines
from quayside.sources.sinks import export_csv, read_table, seed_csv
from quayside.sources.versions import current_version, publish_version, read_version, swap_schema
from quayside.streaming.staging import BatchLedger, file_arrivals, stage_arrivals
from quayside.streaming.windows import keep_windows, read_windows, windowed_counts

# ---------------------------------------------------------------- staging stream


class Interrupted(RuntimeError):
    pass


def _interrupted(at: set[int], ledger: BatchLedger):
    """Staging that stops once in each batch of ``at``: in the even ones before anything was staged, in the others after."""

    def stage(spark, manifest, expected, options, as_of):
        batch = ledger.entries().where("state = 'begun'").agg(F.max("batch")).first()[0]
        if batch in at and batch % 2 == 0:
            at.remove(batch)
            raise Interrupted
        out = stage_files(spark, manifest, expected, options, as_of)
        if batch in at:
            at.remove(batch)
            raise Interrupted
        return out

    return stage


def _event_files(spark, sf_dir, root) -> DataFrame:
    """Events as delimited files by type and day; a few values cannot be read."""
    events = table(spark, sf_dir, "events").where("ts is not null")
    text = events.select(
        F.concat(F.lit("e"), "event_id").alias("Id"),
        F.col("user_id").cast("string").alias("User"),
        F.when(F.col("user_id") % 23 == 5, "?").otherwise(F.col("value").cast("decimal(18,2)").cast("string")).alias("Amount"),
        F.date_format("ts", "dd/MM/yyyy").alias("Day"),
        F.concat(F.lit("d-"), F.date_format("ts", "yyyyMMdd")).alias("cob"),
        F.col("event_type").alias("kind"),
    )
    folders = ["kind", "cob"]
    text.hint("rebalance", *folders).write.partitionBy(*folders).option("header", True).csv(f"{root}/in")
    return events


def _staging_stream(spark, sf_dir):
    """The staged table and the log after a stream that was stopped in the middle of two of its batches."""
    root = work_dir(spark, "staging-stream")
    events = _event_files(spark, sf_dir, root)
    declared = [("Id", "event_key", 1, "VARCHAR", 40, 0, 0), ("User", "user_id", 2, "NUMERIC", 0, 0, 0),
                ("Amount", "amount", 3, "NUMERIC", 0, 18, 2), ("Day", "event_day", 4, "DATE", 0, 0, 0)]
    span = events.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).toDF("a", "z")
    days = calendar(span, events.select(F.to_date("ts")).where(F.lit(False)))
    as_of = F.lit("2025-01-01 00:00:00").cast("timestamp")
    codes = events.select(F.col("event_type").alias("code")).distinct()
    expected = expected_files(codes, "events", "/in/kind=|code|/cob=d-|:YYYYMMDD:|/", "csv", declared, days, as_of, bad_rows=BAD_LIMIT)
    # the files' charset is one of the JVM's
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    options = StageOptions(root, f"{root}/out", f"{root}/log", allow_create=True)
    ledger = f"{root}/ledger"
    stage = _interrupted({1, 2}, BatchLedger(spark, ledger))
    arrivals = file_arrivals(spark, f"{root}/in", "*.csv", files_per_batch=60)
    while True:
        try:
            stage_arrivals(arrivals, expected, options, f"{root}/checkpoint", ledger, stage=stage).awaitTermination()
            break
        except PySparkException as e:
            if Interrupted.__name__ not in str(e):
                raise
    staged = read_table(spark, table_path(options, "DW.EVENTS"), empty=STAGED)
    return staged, current_log(spark, options.log_path)


#: Files with so many unreadable rows are left out.
BAD_LIMIT = 6

#: Columns of the staged table where every file was left out, so that no row says what they are.
STAGED = "event_key string, user_id decimal(38,0), amount decimal(18,2), event_day date, cob_id int, scope struct<entity_code: string>, dataset_name string"


def staging_stream(spark, sf_dir):
    """Staged events and where they came from."""
    staged, _ = _staging_stream(spark, sf_dir)
    return staged.select(
        "event_key", F.col("user_id").cast("bigint").alias("user_id"), F.col("amount").cast("double").alias("amount"), "event_day",
        F.col("cob_id").cast("int").alias("cob_id"), F.col("scope.entity_code").alias("entity_code"), "dataset_name",
    )


_EVENT_FILES = f"""
e AS (
  SELECT 'e' || event_id AS event_key, user_id, CAST(CAST(value AS DECIMAL(18, 2)) AS DOUBLE) AS amount, CAST(ts AS DATE) AS event_day,
         CAST(strftime(ts, '%Y%m%d') AS INT) AS cob_id, event_type AS entity_code, 'events_' || event_type AS dataset_name,
         user_id IS NOT NULL AND user_id % 23 = 5 AS is_bad
  FROM events WHERE ts IS NOT NULL),
f AS (
  SELECT cob_id, dataset_name, count(*) AS n_rows, count_if(is_bad) AS n_bad, count_if(is_bad) >= {BAD_LIMIT} AS skipped
  FROM e GROUP BY ALL)"""

SQL_STAGING_STREAM = f"""WITH {_EVENT_FILES}
SELECT event_key, user_id, amount, event_day, cob_id, entity_code, dataset_name
FROM e JOIN f USING (cob_id, dataset_name) WHERE NOT is_bad AND NOT skipped"""


def staging_stream_log(spark, sf_dir):
    """Rows read, loaded and refused for each COB and dataset, by the log of the same stream: one state for each load."""
    _, log = _staging_stream(spark, sf_dir)
    result = log.select("cob_id", "dataset_name", "process_status", F.explode("process_result.msg_copy_result").alias("r"))
    return result.groupBy(F.col("cob_id").cast("int").alias("cob_id"), "dataset_name", "process_status").agg(
        F.sum("r.rows_parsed").alias("n_rows"), F.sum("r.rows_loaded").alias("n_loaded"), F.sum("r.errors_seen").alias("n_bad"))


SQL_STAGING_STREAM_LOG = f"""WITH {_EVENT_FILES}
SELECT cob_id, dataset_name, 'SUCCESS' AS process_status, n_rows::BIGINT AS n_rows,
       CASE WHEN skipped THEN 0 ELSE n_rows - n_bad END::BIGINT AS n_loaded, n_bad::BIGINT AS n_bad FROM f"""

# ---------------------------------------------------------------- windows


def windowed_loads(spark, sf_dir):
    """Events by hour and type, counted by a stream whose files follow each other in time; it is stopped and started again."""
    root = work_dir(spark, "windows")
    events = table(spark, sf_dir, "events").where("ts is not null")
    schema = events.schema
    first, last = events.select(F.min(F.unix_micros(F.col("ts").cast("timestamp"))), F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()
    slices = 4

    def counts():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
        timed = stream.select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
        return windowed_counts(timed, "ts", ["event_type"], measures={"total": F.sum(F.col("value").cast("decimal(18,2)"))})

    for i in range(slices):
        place = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - first) * slices / (last - first + 1))
        events.where(place == i).coalesce(1).write.parquet(f"{root}/in/{i}")
        if i in (1, slices - 1):
            keep_windows(counts(), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    found = read_windows(spark, f"{root}/out", ["event_type"])
    return found.select(stamp("window_start").alias("window_start"), stamp("window_end").alias("window_end"), "event_type", "n_events",
                        F.col("total").cast("double").alias("total"))


SQL_WINDOWED_LOADS = """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, event_type, count(*) AS n_events,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total
FROM events WHERE ts IS NOT NULL GROUP BY ALL"""

# ---------------------------------------------------------------- versions


def swapped_schema(spark, sf_dir):
    """Orders under a schema with a column added, one dropped and two of another type, beside what a reader that had
    opened the version before still sees."""
    root = f"{work_dir(spark, 'versions')}/orders"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    publish_version(orders, root)
    before = read_version(spark, root)
    schema = {"o_orderkey": "bigint", "o_custkey": "string", "o_totalprice": "decimal(18,2)", "o_orderpriority": "int", "note": "string"}
    changes = swap_schema(spark, root, schema)
    same = swap_schema(spark, root, schema)
    after = read_version(spark, root)
    old = before.select("o_orderkey", F.col("o_orderstatus").alias("old_status"), F.col("o_custkey").alias("old_customer"))
    return after.join(old, "o_orderkey").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("double").alias("o_totalprice"), "o_orderpriority", "note", "old_status", "old_customer",
        F.lit(current_version(spark, root)).cast("int").alias("version"), F.lit(len(same)).alias("n_same"),
        F.lit(",".join(sorted(f"{c}:{what}" for c, what, _, _ in changes))).alias("changes"),
    )


SQL_SWAPPED_SCHEMA = """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS o_totalprice,
       CAST(NULL AS INT) AS o_orderpriority, CAST(NULL AS VARCHAR) AS note, o_orderstatus AS old_status, o_custkey AS old_customer,
       2 AS version, 0 AS n_same,
       'note:added,o_custkey:retyped,o_orderpriority:retyped,o_orderstatus:removed,o_totalprice:retyped' AS changes
FROM orders"""

# ---------------------------------------------------------------- increments


def bounds_by_increment(spark, sf_dir):
    """Bounds after three increments of a load history, one of them written twice."""
    path = f"{work_dir(spark, 'increments')}/counts"
    loads = shipment_loads(spark, sf_dir)
    cuts = ["1900-01-01", "1995-01-01", "1997-01-01", "2100-01-01"]
    bounds = None
    for i, name in enumerate(("a", "b", "b", "c")):
        lo, hi = cuts["abc".index(name)], cuts["abc".index(name) + 1]
        write_increment(loads.where(F.col("month").isNull() & F.lit(name == "c") | F.col("month").between(lo, F.date_sub(F.lit(hi), 1))), path, name)
        if i != 1:
            bounds = refresh_from_increment(spark, path, name, bounds)
            kept = f"{path}-bounds-{i}"
            bounds.write.parquet(kept)
            bounds = spark.read.schema(bounds.schema).parquet(kept)
    return bounds


# ---------------------------------------------------------------- further sources and sinks


def text_lines(spark, sf_dir):
    """Every line of text files, blank ones included, with its number in the file."""
    root = work_dir(spark, "lines")
    lines = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.concat_ws(";", "o_orderkey", "o_orderstatus")).alias("value"), "o_orderstatus")
    lines.hint("rebalance", "o_orderstatus").write.partitionBy("o_orderstatus").text(f"{root}/in")
    numbered = number_rows(read_lines(spark, f"{root}/in").select("value", "o_orderstatus", PATH, BLOCK, SEQ))
    per_file = numbered.groupBy("o_orderstatus", PATH).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") == "").alias("blank"), F.max("file_row_number").alias("last"), F.countDistinct("file_row_number").alias("numbers"))
    return per_file.groupBy("o_orderstatus").agg(
        F.sum("n").alias("n_lines"), F.sum("blank").alias("n_blank"), F.sum("last").alias("last_numbers"), F.sum("numbers").alias("n_numbers"))


SQL_TEXT_LINES = """
SELECT o_orderstatus, count(*) AS n_lines, count_if(o_orderkey % 5 = 0)::BIGINT AS n_blank, count(*) AS last_numbers, count(*) AS n_numbers
FROM orders GROUP BY o_orderstatus"""


def csv_round_trip(spark, sf_dir):
    """Suppliers exported as delimited files with a header and seeded from them again."""
    root = work_dir(spark, "export")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", F.col("s_acctbal").cast("decimal(18,2)").alias("s_acctbal"))
    export_csv(suppliers, f"{root}/out")
    seed_csv(spark, f"{root}/out", "s_suppkey bigint, s_name string, s_nationkey bigint, s_acctbal decimal(18,2)", "seeded_suppliers")
    return spark.table("seeded_suppliers").withColumn("s_acctbal", F.col("s_acctbal").cast("double"))


SQL_CSV_ROUND_TRIP = """
SELECT s_suppkey, s_name, s_nationkey, CAST(CAST(s_acctbal AS DECIMAL(18, 2)) AS DOUBLE) AS s_acctbal FROM supplier"""


def listing_log(spark, sf_dir):
    """A log of two listings: folders listed again lose the flag on their earlier rows."""
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(
        cob_of("o_orderdate").alias("cob_id"), F.lit("EXT.BOX").alias("stage_name"), F.concat(F.lit("in/"), "o_orderstatus", F.lit("/")).alias("folder"),
        F.lit("csv").alias("file_extension"), F.concat(F.lit("f"), "o_orderkey").alias("name"), "o_orderpriority",
    )
    log = rows.where("name is not null").withColumn("flag_last_version", F.lit(True)).withColumn("listing", F.lit(1))
    fresh = rows.where("o_orderpriority = '1-URGENT'").withColumn("listing", F.lit(2))
    return append_listing(log, fresh).select("cob_id", "folder", "name", "listing", "flag_last_version")


SQL_LISTING_LOG = """
WITH r AS (SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS cob_id, 'in/' || o_orderstatus || '/' AS folder, 'f' || o_orderkey AS name, o_orderpriority FROM orders)
SELECT cob_id, folder, name, 1 AS listing, (cob_id, folder) NOT IN (SELECT (cob_id, folder) FROM r WHERE o_orderpriority = '1-URGENT') AS flag_last_version FROM r
UNION ALL SELECT cob_id, folder, name, 2, TRUE FROM r WHERE o_orderpriority = '1-URGENT'"""


def load_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of loads: equal for equal parts, different for different ones, per COB."""
    lines = table(spark, sf_dir, "lineitem").select(
        cob_of("l_shipdate").alias("cob_id"), F.concat(F.lit("f"), "l_orderkey").alias("file"), F.lit("in").alias("folder"), F.concat(F.lit("d"), "l_suppkey").alias("dataset"))
    ids = lines.withColumn("id", load_id(F.lit("2002-01-01").cast("timestamp"), "cob_id", "file", "folder", "dataset"))
    return ids.groupBy("cob_id").agg(F.count(F.lit(1)).alias("n_loads"), F.countDistinct("id").alias("n_ids"))


SQL_LOAD_IDS = """
SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS INT) AS cob_id, count(*) AS n_loads, count(DISTINCT (l_orderkey, l_suppkey)) AS n_ids
FROM lineitem GROUP BY ALL"""

QUERIES = {
    "staging_stream": staging_stream,
    "staging_stream_log": staging_stream_log,
    "windowed_loads": windowed_loads,
    "swapped_schema": swapped_schema,
    "bounds_by_increment": bounds_by_increment,
    "text_lines": text_lines,
    "csv_round_trip": csv_round_trip,
    "listing_log": listing_log,
    "load_ids": load_ids,
}

ORACLES = {
    "staging_stream": SQL_STAGING_STREAM,
    "staging_stream_log": SQL_STAGING_STREAM_LOG,
    "windowed_loads": SQL_WINDOWED_LOADS,
    "swapped_schema": SQL_SWAPPED_SCHEMA,
    "bounds_by_increment": SQL_OUTLIER_BOUNDS,
    "text_lines": SQL_TEXT_LINES,
    "csv_round_trip": SQL_CSV_ROUND_TRIP,
    "listing_log": SQL_LISTING_LOG,
    "load_ids": SQL_LOAD_IDS,
}
