"""Load observability and usage queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract.common import stamp, table, when_text
from quayside.functions.dates import cob_of
from quayside.operators import loads, status, unstaged, usage
from quayside.operators.funnel import filter_choices, filter_funnel, filter_limits
from quayside.plans.calendar import calendar
from quayside.plans.expected import at_cob
from quayside.sources.listing import flag_latest

# ---------------------------------------------------------------- shaped inputs


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event is one load: errors failed, sign-ups still run."""
    day = F.date_format("ts", "yyyyMMdd")
    events = table(spark, sf_dir, "events").withColumns(
        {
            "k": F.get_json_object("props", "$.k").cast("bigint"),
            "path": F.concat(F.lit("in/"), "event_type", F.lit("/"), day, F.lit("/u"), "user_id", F.lit(".csv")),
            "state": when_text("event_type", {"error": "FAILED", "signup": "RUNNING"}, "SUCCESS"),
        }
    )
    k, path, state = F.col("k"), F.col("path"), F.col("state")
    results = F.when(
        state == "SUCCESS",
        F.array(
            F.struct(k.alias("rows_loaded"), (k + 3).alias("rows_parsed")),
            F.struct((k * 2).alias("rows_loaded"), (k * 2).alias("rows_parsed")),
        ),
    ).when(state == "FAILED", F.array().cast("array<struct<rows_loaded:bigint,rows_parsed:bigint>>"))
    changed = F.col("ts") - F.expr("interval 1 hour")
    http = F.concat(F.date_format(changed, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))

    def listed(suffix, size):
        return F.struct(
            F.concat(F.lit("stage/"), path, F.lit(suffix)).alias("name"),
            size.alias("size"),
            http.alias("last_modified"),
        )

    end = F.col("ts") + F.make_dt_interval(mins=F.floor("value").cast("int"))
    return events.select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_type") == "purchase", 19000101).otherwise(cob_of("ts")).alias("cob_id"),
        F.concat(F.lit("ds_"), "user_id").alias("dataset_name"),
        F.struct(path.alias("file_stage_me")).alias("process_parameters"),
        F.struct(results.alias("msg_copy_result")).alias("process_result"),
        state.alias("process_status"),
        F.col("ts").alias("start_timestamp"),
        F.when(state != "RUNNING", end).alias("end_timestamp"),
        F.struct(
            F.when(state != "RUNNING", F.array(listed("", k * 100), listed(".part2", k))).alias("file_list")
        ).alias("blob_file"),
    )


_EVENT_LOG = """
log AS (
  SELECT event_id AS id,
         CASE WHEN event_type = 'purchase' THEN 19000101 ELSE CAST(strftime(ts, '%Y%m%d') AS INT) END AS cob_id,
         'ds_' || user_id AS dataset_name,
         'in/' || event_type || '/' || strftime(ts, '%Y%m%d') || '/u' || user_id || '.csv' AS file_stage_me,
         CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'RUNNING' ELSE 'SUCCESS' END AS process_status,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         ts AS start_timestamp,
         CASE WHEN event_type <> 'signup' THEN ts + to_minutes(CAST(floor(value) AS BIGINT)) END AS end_timestamp
  FROM events
),
totals AS (
  SELECT id, CAST(sum(l) AS BIGINT) AS rows_loaded, CAST(sum(p) AS BIGINT) AS rows_parsed FROM (
    SELECT id, k AS l, k + 3 AS p FROM log WHERE process_status = 'SUCCESS'
    UNION ALL SELECT id, k * 2, k * 2 FROM log WHERE process_status = 'SUCCESS')
  GROUP BY id
)"""


def shipment_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset per supplier, a load per shipping month."""
    month = F.trunc(F.to_date("l_shipdate"), "month").alias("month")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("dataset_name"), month)
        .agg(F.count(F.lit(1)).alias("rows_loaded"))
        .withColumn("process_status", F.lit("SUCCESS"))
    )


_SHIPMENT_LOADS = """
loads AS (
  SELECT l_suppkey AS dataset_name, date_trunc('month', l_shipdate) AS month, count(*) AS rows_loaded
  FROM lineitem GROUP BY ALL)"""


def _bounds_sql(loads_name: str, tag: str = "") -> str:
    """Quartiles as elements of each dataset's sorted list; element 0 is no element."""
    return f"""
history{tag} AS (
  SELECT dataset_name, list_sort(list(CAST(rows_loaded AS DOUBLE)), 'ASC', 'NULLS LAST') AS n FROM {loads_name} GROUP BY dataset_name),
spread{tag} AS (
  SELECT dataset_name, n[CAST(floor(0.25 * len(n)) AS BIGINT)] AS q_one, n[CAST(floor(0.75 * len(n)) AS BIGINT)] AS q_three FROM history{tag}),
fence{tag} AS (SELECT *, round(1.5 * (q_three - q_one), 0) AS outlier_range FROM spread{tag}),
ends{tag} AS (
  SELECT *, if(q_one < outlier_range, 0.0, q_one - outlier_range) AS lower_bound, q_three + outlier_range AS upper_bound FROM fence{tag}),
bounds{tag} AS (
  SELECT *, format('[{{:,}} - {{:,}}]', CAST(round(lower_bound) AS BIGINT), CAST(round(upper_bound) AS BIGINT)) AS bounds FROM ends{tag})"""


_BOUND_COLS = """dataset_name, q_three, q_one, outlier_range, CAST(lower_bound AS DOUBLE) AS lower_bound,
       CAST(upper_bound AS DOUBLE) AS upper_bound, bounds"""

# ---------------------------------------------------------------------- queries


def outlier_bounds(spark, sf_dir):
    return loads.outlier_bounds(shipment_loads(spark, sf_dir))


SQL_OUTLIER_BOUNDS = f"WITH {_SHIPMENT_LOADS}, {_bounds_sql('loads')} SELECT {_BOUND_COLS} FROM bounds"


def outlier_refresh(spark, sf_dir):
    all_loads = shipment_loads(spark, sf_dir)
    new_year = F.lit("2000-01-01").cast("date")
    current = loads.outlier_bounds(all_loads.where(F.col("month") < new_year))
    fresh = loads.outlier_bounds(all_loads.where((F.col("month") >= new_year) & (F.col("rows_loaded") > 8)))
    return loads.refresh_bounds(current, fresh)


SQL_OUTLIER_REFRESH = f"""WITH {_SHIPMENT_LOADS},
early AS (SELECT * FROM loads WHERE month < DATE '2000-01-01'),
late AS (SELECT * FROM loads WHERE month >= DATE '2000-01-01' AND rows_loaded > 8),
{_bounds_sql('early', '_old')}, {_bounds_sql('late', '_new')}
SELECT {_BOUND_COLS} FROM bounds_new
UNION ALL
SELECT {_BOUND_COLS} FROM bounds_old WHERE dataset_name NOT IN (SELECT dataset_name FROM bounds_new)"""


def row_count_ranks(spark, sf_dir):
    return loads.row_count_ranks(shipment_loads(spark, sf_dir))


SQL_ROW_COUNT_RANKS = f"""WITH {_SHIPMENT_LOADS},
r AS (SELECT dataset_name, rows_loaded,
             row_number() OVER (PARTITION BY dataset_name ORDER BY rows_loaded) AS rn,
             ntile(4) OVER (PARTITION BY dataset_name ORDER BY rows_loaded) AS t,
             count(*) OVER (PARTITION BY dataset_name) AS c
      FROM loads)
SELECT dataset_name, rows_loaded, count(*) AS n_at_value, min(rn) AS first_rank, max(rn) AS last_rank,
       max(c) AS group_rows, CAST(min(t) AS INT) AS first_quarter, CAST(max(t) AS INT) AS last_quarter
FROM r GROUP BY dataset_name, rows_loaded"""


def load_totals(spark, sf_dir):
    return loads.load_totals(event_log(spark, sf_dir))


SQL_LOAD_TOTALS = f"WITH {_EVENT_LOG} SELECT id, rows_loaded, rows_parsed FROM totals"


def load_log_latest(spark, sf_dir):
    """Log entries appended per user and type; the newest entry is the state."""
    entries = table(spark, sf_dir, "events").select(
        F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("id"),
        F.struct("ts", "event_id").alias("logged_at"),
        F.col("event_id").alias("entry"),
        "value",
    )
    return loads.latest_log(entries)


SQL_LOAD_LOG_LATEST = """
SELECT id, entry, value FROM (
  SELECT user_id || '/' || event_type AS id, event_id AS entry, value,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1"""


def latest_listing(spark, sf_dir):
    """Each event lists (user, type) again; only the newest listing is current."""
    log = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return flag_latest(log, ["user_id", "event_type"], "ts").select(
        "event_id", "user_id", "event_type", "flag_last_version"
    )


SQL_LATEST_LISTING = """
SELECT event_id, user_id, event_type,
       ts = max(ts) OVER (PARTITION BY user_id, event_type) AS flag_last_version
FROM events"""

_AS_OF = "2024-01-25 00:00:00"


def _event_calendar(events: DataFrame) -> DataFrame:
    span = events.agg(F.to_date(F.min("ts")).alias("first_day"), F.to_date(F.max("ts")).alias("last_day"))
    off = events.select(F.to_date("ts").alias("d")).where(F.date_format("d", "MM-dd").isin("01-01", "01-15"))
    return calendar(span, off)


_EVENT_CALENDAR = """
days AS (
  SELECT CAST(d AS DATE) AS my_date
  FROM (SELECT unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE) + 3, INTERVAL 1 DAY)) AS d FROM events)),
off AS (SELECT DISTINCT CAST(ts AS DATE) AS my_date FROM events WHERE strftime(ts, '%m-%d') IN ('01-01', '01-15')),
working AS (SELECT my_date FROM days WHERE dayofweek(my_date) NOT IN (0, 6) AND my_date NOT IN (SELECT my_date FROM off)),
calendar AS (
  SELECT d.my_date, (SELECT min(w.my_date) FROM working w WHERE w.my_date > d.my_date) AS next_business_day,
         CAST(strftime(d.my_date, '%Y%m%d') AS INT) AS cob_id
  FROM days d WHERE d.my_date <= (SELECT CAST(max(ts) AS DATE) FROM events))"""


def load_status(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    log = event_log(spark, sf_dir)
    finished = loads.with_load_totals(log).select("dataset_name", "rows_loaded", "process_status")
    catalog = events.select("user_id").distinct().select(
        F.concat(F.lit("ds_"), "user_id").alias("dataset_name"),
        F.lit("/in/|:YYYYMM:|/|:YYYYMMDD:|/").alias("file_path"),
        F.concat(F.lit("u"), "user_id", F.lit("_|:YYYYMMDD:|.csv")).alias("file_name"),
        F.when(F.col("user_id") > 20, "09:00:00").alias("expected_stage_time"),
    )
    report = status.load_status(
        log, _event_calendar(events), catalog, loads.outlier_bounds(finished), F.lit(_AS_OF).cast("timestamp"), horizon=180
    )
    return report.select(
        "staging_log_id", "cob_id", "stage_status", "dataset_name", "log_file_path", "log_file_name",
        "staging_duration_seconds", stamp("blob_last_modified").alias("blob_last_modified"), "blob_bytes",
        "blob_location", "wait_for_staging_seconds", stamp("expected_staging_timestamp").alias("expected_at"),
        "minutes_past_expected", "rows_loaded", "rows_parsed", "folder_path_cob", "file_name_cob", "folder_pattern",
        "bounds", "expected_rows_status", "kpi_expected_end", "staging_progress",
    )


SQL_LOAD_STATUS = f"""WITH {_EVENT_LOG}, {_EVENT_CALENDAR},
finished AS (SELECT l.dataset_name, t.rows_loaded FROM log l LEFT JOIN totals t USING (id) WHERE process_status = 'SUCCESS'),
{_bounds_sql('finished')},
cobs AS (SELECT cob_id FROM calendar WHERE my_date <= DATE '2024-01-25' ORDER BY cob_id DESC LIMIT 180),
users AS (SELECT DISTINCT user_id, 'ds_' || user_id AS dataset_name FROM events),
p AS (
  SELECT u.dataset_name, c.cob_id, CASE WHEN u.user_id > 20 THEN '09:00:00' END AS expected_stage_time,
         '/in/' || left(CAST(c.cob_id AS VARCHAR), 6) || '/' || c.cob_id || '/' AS folder_path_cob,
         'u' || u.user_id || '_' || c.cob_id || '.csv' AS file_name_cob,
         '.*' || left(CAST(c.cob_id AS VARCHAR), 6) || '.*/' || c.cob_id || '.*/' AS folder_pattern
  FROM users u CROSS JOIN cobs c),
s AS (
  SELECT l.id AS staging_log_id,
         CASE WHEN cob_id = 19000101 THEN CAST(strftime(start_timestamp, '%Y%m%d') AS INT) ELSE cob_id END AS cob_id,
         process_status AS stage_status, dataset_name,
         replace(file_stage_me, split_part(file_stage_me, '/', -1), '') AS log_file_path,
         split_part(file_stage_me, '/', -1) AS log_file_name, start_timestamp, end_timestamp,
         date_diff('second', start_timestamp, end_timestamp) AS staging_duration_seconds,
         CASE WHEN process_status <> 'RUNNING' THEN date_trunc('second', start_timestamp - INTERVAL 1 HOUR) END AS blob_last_modified,
         CASE WHEN process_status <> 'RUNNING' THEN 101 * k END AS blob_bytes,
         CASE WHEN process_status <> 'RUNNING'
              THEN 'stage/' || replace(file_stage_me, split_part(file_stage_me, '/', -1), '') END AS blob_location,
         t.rows_loaded, t.rows_parsed
  FROM log l LEFT JOIN totals t USING (id)),
j AS (
  SELECT s.*, p.folder_path_cob, p.file_name_cob, p.folder_pattern, b.lower_bound, b.upper_bound, b.bounds,
         CAST(c.next_business_day || ' ' || p.expected_stage_time AS TIMESTAMP) AS expected
  FROM s JOIN calendar c ON s.cob_id = c.cob_id
  LEFT JOIN p ON p.dataset_name = s.dataset_name AND p.cob_id = s.cob_id
  LEFT JOIN bounds b ON b.dataset_name = s.dataset_name),
m AS (SELECT *, date_diff('minute', expected, coalesce(end_timestamp, TIMESTAMP '{_AS_OF}')) AS late FROM j)
SELECT staging_log_id, cob_id, stage_status, dataset_name, log_file_path, log_file_name, staging_duration_seconds,
       strftime(blob_last_modified, '%Y-%m-%d %H:%M:%S') AS blob_last_modified, blob_bytes, blob_location,
       date_diff('second', blob_last_modified, start_timestamp) AS wait_for_staging_seconds,
       strftime(expected, '%Y-%m-%d %H:%M:%S') AS expected_at, late AS minutes_past_expected,
       rows_loaded, rows_parsed, folder_path_cob, file_name_cob, folder_pattern, bounds,
       CASE WHEN upper(stage_status) <> 'SUCCESS' THEN NULL
            WHEN rows_loaded BETWEEN lower_bound AND upper_bound THEN 'OK ' || bounds
            ELSE 'Out of bounds ' || bounds END AS expected_rows_status,
       CASE WHEN late IS NULL THEN 'N/A' WHEN late <= 0 THEN 'On Time' ELSE 'Overdue' END AS kpi_expected_end,
       CASE WHEN end_timestamp IS NULL THEN 'Staging started' ELSE 'Staging finished' END AS staging_progress
FROM m"""


def unstaged_files(spark, sf_dir):
    """Orders are listed files, large orders are expected, line items are load attempts."""
    return _unstaged(spark, sf_dir)[0].select(
        "cob_id", "stage_name", "container_name", "folder_path", "file_name", "external_file_path",
        stamp("last_modified").alias("last_modified"), "task_name",
    )


def _unstaged(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    url = F.lit("azure://store/test1-sales")
    key_path = F.concat(F.lit("/in/o"), "o_orderkey", F.lit("/"))
    listing = orders.select(
        cob_of("o_orderdate").alias("cob_id"),
        F.concat(F.lit("st."), F.split_part("o_orderpriority", F.lit("-"), F.lit(1))).alias("stage_name"),
        url.alias("stage_url"),
        F.lit("in/").alias("folder"),
        F.lit("csv").alias("file_extension"),
        F.concat(url, key_path, F.lit("data.csv")).alias("name"),
        (F.col("o_orderdate") + F.expr("interval 12 hours")).alias("last_modified"),
        F.col("o_orderdate").alias("process_timestamp"),
        (F.col("o_orderstatus") != "P").alias("flag_last_version"),
    )
    expected = at_cob(
        orders.where("o_totalprice > 100000").select(
            cob_of("o_orderdate").alias("cob_id"),
            F.concat(F.lit("st."), F.split_part("o_orderpriority", F.lit("-"), F.lit(1))).alias("stage_name"),
            F.lit("csv").alias("file_extension"),
            key_path.alias("file_path"),
            F.lit("data.csv").alias("file_name"),
        )
    )
    failed = F.col("l_returnflag") == "R"
    log = table(spark, sf_dir, "lineitem").select(
        F.struct(
            F.concat(F.lit("in/o"), "l_orderkey", F.lit("/data.csv")).alias("file_stage_me"),
            F.lit("sales").alias("container_name"),
        ).alias("process_parameters"),
        F.struct(
            F.when(failed & (F.col("l_linestatus") == "F"), "SQL compilation error: bad cast")
            .when(failed, "timeout").alias("exception")
        ).alias("process_result"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("process_status"),
        F.col("l_shipdate").alias("start_timestamp"),
    )
    as_of = F.lit("2001-12-31 00:00:00").cast("timestamp_ntz")
    return unstaged.unstaged_files(listing, expected, log, as_of), listing


_UNSTAGED = """
listed AS (
  SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS cob_id, 'st.' || split_part(o_orderpriority, '-', 1) AS stage_name,
         '/in/o' || o_orderkey || '/data.csv' AS external_file_path, o_orderdate + INTERVAL 12 HOUR AS last_modified,
         o_orderstatus <> 'P' AS flag_last_version, o_totalprice
  FROM orders),
log AS (
  SELECT '/in/o' || l_orderkey || '/data.csv' AS path, l_shipdate AS start_timestamp,
         CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCESS' END AS process_status,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'SQL compilation error: bad cast'
              WHEN l_returnflag = 'R' THEN 'timeout' END AS exception
  FROM lineitem),
history AS (
  SELECT path, max(start_timestamp) FILTER (process_status <> 'FAILED') AS last_good,
         count(*) FILTER (process_status = 'FAILED' AND regexp_matches(exception,
           'There is no metadata for the folder/file|Object.*does not exist or not authorized|SQL compilation error')) AS n_hopeless
  FROM log GROUP BY path),
unstaged AS (
  SELECT cob_id, stage_name, 'sales' AS container_name, regexp_replace(external_file_path, '[^/]*$', '') AS folder_path,
         'data.csv' AS file_name, external_file_path, last_modified
  FROM listed LEFT JOIN history ON path = external_file_path
  WHERE flag_last_version AND o_totalprice > 100000 AND coalesce(last_good <= last_modified, true)
    AND coalesce(n_hopeless, 0) = 0 AND last_modified < TIMESTAMP '2001-12-31' - INTERVAL 30 MINUTE)"""

SQL_UNSTAGED_FILES = f"""WITH {_UNSTAGED}
SELECT cob_id, stage_name, container_name, folder_path, file_name, external_file_path,
       strftime(last_modified, '%Y-%m-%d %H:%M:%S') AS last_modified,
       replace(folder_path, '/', '_') || 'data' || cob_id AS task_name FROM unstaged"""


def retry_set(spark, sf_dir):
    open_files, listing = _unstaged(spark, sf_dir)
    return unstaged.retry_set(open_files, listing, k=365)


SQL_RETRY_SET = f"""WITH {_UNSTAGED},
cobs AS (SELECT DISTINCT cob_id FROM listed WHERE flag_last_version ORDER BY cob_id DESC LIMIT 365)
SELECT cob_id, file_name, folder_path, container_name AS container, external_file_path FROM unstaged
WHERE cob_id BETWEEN (SELECT min(cob_id) FROM cobs) AND (SELECT max(cob_id) FROM cobs)"""


def last_k_cobs(spark, sf_dir):
    """COB range of the hourly listing (3 latest loaded) and of the retry (5 latest listed)."""
    loaded = table(spark, sf_dir, "lineitem").select(cob_of("l_shipdate").alias("cob_id"))
    listed = table(spark, sf_dir, "orders").select(cob_of("o_orderdate").alias("cob_id"))
    return (
        unstaged.cob_range(loaded, 3).select(F.lit("list").alias("task"), "*")
        .unionByName(unstaged.cob_range(listed, 5).select(F.lit("retry").alias("task"), "*"))
    )


SQL_LAST_K_COBS = """
SELECT 'list' AS task, min(cob_id) AS cob_start, max(cob_id) AS cob_end FROM (
  SELECT DISTINCT CAST(strftime(l_shipdate, '%Y%m%d') AS INT) AS cob_id FROM lineitem ORDER BY cob_id DESC LIMIT 3)
UNION ALL
SELECT 'retry', min(cob_id), max(cob_id) FROM (
  SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS cob_id FROM orders ORDER BY cob_id DESC LIMIT 5)"""


def date_dimension(spark, sf_dir):
    """The 730 days up to the last shipment, with the lines shipped on each."""
    lineitem = table(spark, sf_dir, "lineitem")
    per_day = lineitem.groupBy(F.to_date("l_shipdate").alias("date")).agg(F.count(F.lit(1)).alias("n_lines"))
    dimension = usage.date_dimension(per_day.agg(F.max("date").alias("last_day")), days=730)
    return dimension.join(per_day, "date", "left").withColumn("n_lines", F.coalesce("n_lines", F.lit(0)))


SQL_DATE_DIMENSION = """
WITH last AS (SELECT CAST(max(l_shipdate) AS DATE) AS d FROM lineitem),
days AS (SELECT CAST(unnest(generate_series(d - 729, d, INTERVAL 1 DAY)) AS DATE) AS date FROM last),
n AS (SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS n_lines FROM lineitem GROUP BY ALL)
SELECT date, CAST(year(date) AS INT) AS year, CAST(quarter(date) AS INT) AS quarter, CAST(month(date) AS INT) AS month_num,
       strftime(date, '%b') AS month_name, strftime(date, '%b-%y') AS month_name_year,
       CAST(weekofyear(date) AS INT) AS week_num, CAST(day(date) AS INT) AS day_num, strftime(date, '%a') AS day_name,
       CAST(dayofweek(date) AS INT) AS day_of_week, CAST(dayofyear(date) AS INT) AS day_of_year,
       coalesce(n_lines, 0) AS n_lines
FROM days LEFT JOIN n USING (date)"""


def pipe_usage(spark, sf_dir):
    history = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("pipe_id"),
        F.col("event_type").alias("pipe_name"),
        F.col("ts").alias("start_time"),
        (F.col("ts") + F.make_dt_interval(mins=F.floor("value").cast("int"))).alias("end_time"),
        F.col("value").alias("credits_used"),
        F.get_json_object("props", "$.k").cast("bigint").alias("bytes_inserted"),
        F.col("user_id").alias("files_inserted"),
    )
    return usage.pipe_usage(history).drop("start_time", "end_time")


SQL_PIPE_USAGE = """
SELECT event_id AS pipe_id, event_type AS pipe_name, value AS credits_used,
       CAST(json_extract(props, '$.k') AS BIGINT) AS bytes_inserted, user_id AS files_inserted,
       CAST(ts AS DATE) AS start_date,
       date_diff('hour', ts, ts + to_minutes(CAST(floor(value) AS BIGINT))) AS operation_hours,
       CAST(hour(ts) AS INT) AS time_of_day
FROM events"""


def compute_metering(spark, sf_dir):
    history = table(spark, sf_dir, "events").select(
        F.col("ts").alias("start_time"),
        (F.col("ts") + F.make_dt_interval(hours=F.floor("value").cast("int"))).alias("end_time"),
        F.col("event_id").alias("warehouse_id"),
        F.col("event_type").alias("warehouse_name"),
        F.col("value").alias("credits_used"),
    )
    return usage.compute_metering(history).drop("start_time", "end_time")


SQL_COMPUTE_METERING = """
WITH h AS (SELECT *, ts + to_hours(CAST(floor(value) AS BIGINT)) AS end_time FROM events)
SELECT event_id AS warehouse_id, event_type AS warehouse_name, value AS credits_used, CAST(ts AS DATE) AS start_date,
       CAST(end_time AS DATE) AS end_date, date_diff('hour', ts, end_time) AS operation_hours,
       strftime(ts, '%H:%M:%S') AS time_of_day
FROM h"""


def storage_monthly(spark, sf_dir):
    return usage.storage_monthly(
        table(spark, sf_dir, "orders").select(
            F.col("o_orderdate").alias("usage_date"),
            F.floor(F.col("o_totalprice") * 1000000).alias("storage_bytes"),
            (F.col("o_custkey") * 1000000).alias("stage_bytes"),
            F.col("o_orderkey").alias("failsafe_bytes"),
        )
    )


SQL_STORAGE_MONTHLY = """
WITH u AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS usage_month,
         CAST(floor(o_totalprice * 1000000) AS BIGINT) AS a, o_custkey * 1000000 AS b, o_orderkey AS c
  FROM orders)
SELECT usage_month, CAST(sum(a + b + c) AS DOUBLE) / count(*) / 1099511627776.0::DOUBLE AS total_tb,
       CAST(sum(a) AS DOUBLE) / count(*) / 1099511627776.0::DOUBLE AS storage_tb,
       CAST(sum(b) AS DOUBLE) / count(*) / 1099511627776.0::DOUBLE AS stage_tb,
       CAST(sum(c) AS DOUBLE) / count(*) / 1099511627776.0::DOUBLE AS failsafe_tb
FROM u GROUP BY usage_month"""


def credit_estimate(spark, sf_dir):
    size = when_text(
        "event_type", {"view": "X-Small", "click": "Small", "purchase": "Medium", "signup": "4X-Large"}, "Other"
    )
    return usage.credit_estimate(
        table(spark, sf_dir, "events").select(
            F.concat(F.lit("User_"), "user_id").alias("user_name"),
            size.alias("warehouse_size"),
            F.lit(1).alias("warehouse_id"),
            F.concat(F.lit("WH_"), size).alias("warehouse_name"),
            F.col("ts").alias("start_time"),
            F.floor(F.col("value") * 1000).alias("total_elapsed_time"),
            F.get_json_object("props", "$.k").cast("bigint").alias("credits_used_cloud_services"),
        )
    )


SQL_CREDIT_ESTIMATE = """
WITH q AS (
  SELECT upper('User_' || user_id) AS user_name,
         CASE event_type WHEN 'view' THEN 'X-Small' WHEN 'click' THEN 'Small' WHEN 'purchase' THEN 'Medium'
                         WHEN 'signup' THEN '4X-Large' ELSE 'Other' END AS warehouse_size,
         CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 4 WHEN 'signup' THEN 128 ELSE 0 END AS w,
         CAST(date_trunc('month', ts) AS DATE) AS month_date, CAST(floor(value * 1000) AS BIGINT) AS ms,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k
  FROM events)
SELECT user_name, warehouse_size, 1 AS warehouse_id, 'WH_' || warehouse_size AS warehouse_name, month_date,
       count(*) AS count_execution, CAST(sum(ms * w) AS DOUBLE) / 3600000.0::DOUBLE AS estimated_credits,
       CAST(sum(k) AS BIGINT) AS credits_used_cloud_services
FROM q GROUP BY ALL"""


def users_union(spark, sf_dir):
    return usage.users(
        table(spark, sf_dir, "customer").select(
            F.concat(F.lower("c_mktsegment"), F.lit("_"), "c_nationkey").alias("login_name"),
            F.when(F.col("c_acctbal") > 9000, F.col("c_name")).alias("display_name"),
            F.col("c_mktsegment").alias("default_role"),
            F.col("c_acctbal").alias("last_success_login"),
        )
    )


SQL_USERS_UNION = """
SELECT upper(lower(c_mktsegment) || '_' || c_nationkey) AS user_name,
       coalesce(max(CASE WHEN c_acctbal > 9000 THEN c_name END), upper(lower(c_mktsegment) || '_' || c_nationkey)) AS display_name,
       max(c_mktsegment) AS default_role, max(c_acctbal) AS last_success_login
FROM customer GROUP BY upper(lower(c_mktsegment) || '_' || c_nationkey)
UNION SELECT 'SYSTEM', 'System', NULL, NULL"""


def compute_clusters(spark, sf_dir):
    balance = F.col("c_acctbal")
    suffix = (
        F.when(balance < 0, "WH").when(balance < 2000, "XS").when(balance < 4000, "M")
        .when(balance < 6000, "2XL").when(balance < 8000, "4XL").otherwise("ODD")
    )
    name = F.concat(F.lit("TEST_"), "c_mktsegment", F.lit("_"), suffix)
    history = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("warehouse_id"), name.alias("warehouse_name"))
    return usage.compute_clusters(history, ("BUILDING", "MACHINERY"))


SQL_COMPUTE_CLUSTERS = """
WITH h AS (
  SELECT DISTINCT c_nationkey AS warehouse_id, c_mktsegment AS db,
         CASE WHEN c_acctbal < 0 THEN 'WH' WHEN c_acctbal < 2000 THEN 'XS' WHEN c_acctbal < 4000 THEN 'M'
              WHEN c_acctbal < 6000 THEN '2XL' WHEN c_acctbal < 8000 THEN '4XL' ELSE 'ODD' END AS suffix
  FROM customer)
SELECT warehouse_id, 'TEST_' || db || '_' || suffix AS warehouse_name_original,
       CASE WHEN db IN ('BUILDING', 'MACHINERY') AND suffix = 'WH' THEN 'TEST_' || db || '_WH_XS'
            ELSE 'TEST_' || db || '_' || suffix END AS warehouse_name,
       'TEST' AS warehouse_environment, db AS warehouse_database,
       CASE suffix WHEN 'WH' THEN 'X-Small' WHEN 'XS' THEN 'X-Small' WHEN 'M' THEN 'Medium' WHEN '2XL' THEN '2X-Large'
                   WHEN '4XL' THEN '4X-Large' ELSE 'Unknow' END AS warehouse_size,
       'TEST' AS environment_code
FROM h"""


def funnel(spark, sf_dir):
    return filter_funnel(
        table(spark, sf_dir, "lineitem"),
        [
            ("l_shipdate", F.col("l_shipdate").between("1997-01-01", "2000-12-31")),
            ("l_returnflag", F.col("l_returnflag") == "R"),
            ("l_quantity", F.col("l_quantity").between(10, 40)),
            ("l_linestatus", F.col("l_linestatus") == "O"),
        ],
    )


SQL_FUNNEL = """
WITH p AS (
  SELECT l_shipdate BETWEEN '1997-01-01' AND '2000-12-31' AS a, l_returnflag = 'R' AS b,
         l_quantity BETWEEN 10 AND 40 AS c, l_linestatus = 'O' AS d
  FROM lineitem)
SELECT 0 AS step, 'Original data' AS label, count(*) AS n_rows FROM p
UNION ALL SELECT 1, 'Filter: ''l_shipdate''', count(*) FROM p WHERE a
UNION ALL SELECT 2, 'Filter: ''l_returnflag''', count(*) FROM p WHERE a AND b
UNION ALL SELECT 3, 'Filter: ''l_quantity''', count(*) FROM p WHERE a AND b AND c
UNION ALL SELECT 4, 'Filter: ''l_linestatus''', count(*) FROM p WHERE a AND b AND c AND d"""


def filter_options(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    choices = filter_choices(lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"])
    limits = filter_limits(lineitem, ["l_quantity"]).select(
        F.lit("max l_quantity").alias("column_name"), F.col("max_l_quantity").cast("bigint").cast("string").alias("value")
    )
    return choices.unionByName(limits)


SQL_FILTER_OPTIONS = """
SELECT DISTINCT 'l_returnflag' AS column_name, l_returnflag AS value FROM lineitem
UNION ALL SELECT DISTINCT 'l_linestatus', l_linestatus FROM lineitem
UNION ALL SELECT DISTINCT 'l_linenumber', CAST(l_linenumber AS VARCHAR) FROM lineitem
UNION ALL SELECT 'max l_quantity', CAST(CAST(max(l_quantity) AS BIGINT) AS VARCHAR) FROM lineitem"""

QUERIES = {
    "outlier_bounds": outlier_bounds,
    "outlier_refresh": outlier_refresh,
    "row_count_ranks": row_count_ranks,
    "load_totals": load_totals,
    "load_log_latest": load_log_latest,
    "latest_listing": latest_listing,
    "load_status": load_status,
    "unstaged_files": unstaged_files,
    "retry_set": retry_set,
    "last_k_cobs": last_k_cobs,
    "date_dimension": date_dimension,
    "pipe_usage": pipe_usage,
    "compute_metering": compute_metering,
    "storage_monthly": storage_monthly,
    "credit_estimate": credit_estimate,
    "users_union": users_union,
    "compute_clusters": compute_clusters,
    "filter_funnel": funnel,
    "filter_options": filter_options,
}

ORACLES = {
    "outlier_bounds": SQL_OUTLIER_BOUNDS,
    "outlier_refresh": SQL_OUTLIER_REFRESH,
    "row_count_ranks": SQL_ROW_COUNT_RANKS,
    "load_totals": SQL_LOAD_TOTALS,
    "load_log_latest": SQL_LOAD_LOG_LATEST,
    "latest_listing": SQL_LATEST_LISTING,
    "load_status": SQL_LOAD_STATUS,
    "unstaged_files": SQL_UNSTAGED_FILES,
    "retry_set": SQL_RETRY_SET,
    "last_k_cobs": SQL_LAST_K_COBS,
    "date_dimension": SQL_DATE_DIMENSION,
    "pipe_usage": SQL_PIPE_USAGE,
    "compute_metering": SQL_COMPUTE_METERING,
    "storage_monthly": SQL_STORAGE_MONTHLY,
    "credit_estimate": SQL_CREDIT_ESTIMATE,
    "users_union": SQL_USERS_UNION,
    "compute_clusters": SQL_COMPUTE_CLUSTERS,
    "filter_funnel": SQL_FUNNEL,
    "filter_options": SQL_FILTER_OPTIONS,
}
