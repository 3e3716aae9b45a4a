"""Time-window, anomaly and windowed top-k queries.

The events lie minutes apart, so the windows are hours and days long here.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tickstone.operators import aggregates, parse, topk, windows
from tickstone.plans.inputs import CLICKS_SQL, READINGS_SQL, clicks, readings
from tickstone.plans.registry import query

# Sliding windows of one day every six hours: a row lies in four of them.
SLIDING_SQL = """
spread AS (
  SELECT time_bucket(INTERVAL 6 HOUR, {ts}) - k * INTERVAL 6 HOUR AS window_start,
         time_bucket(INTERVAL 6 HOUR, {ts}) - k * INTERVAL 6 HOUR + INTERVAL 1 DAY AS window_end, s.*
  FROM {source} s, (SELECT unnest(range(4)) AS k))"""
EVENT_WINDOWS = f"{READINGS_SQL}, {SLIDING_SQL.format(ts='event_time', source='readings')}"
CLICK_WINDOWS = SLIDING_SQL.format(ts="click_time", source="clicks")


def _flat(df):
    """Window edges as columns, deviations rounded as in the SQL."""
    flat = parse.flatten_window(df, iso=False) if "window" in df.columns else df
    return flat.withColumn("stddev_value", F.round("stddev_value", 4)) if "stddev_value" in flat.columns else flat


@query(
    "window_iso",
    """
    SELECT strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%S') AS window_start,
           strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S') AS window_end,
           event_type AS device_id, count(*) AS count
    FROM events GROUP BY ALL
    """,
)
def window_iso(spark, sf_dir):
    return parse.flatten_window(windows.hourly(readings(spark, sf_dir), "event_time", "device_id", size="1 day"))


@query(
    "window_stats",
    f"""
    WITH {EVENT_WINDOWS}
    SELECT window_start, window_end, device_id, count(*) AS count, avg(value) AS avg_value,
           round(stddev_samp(value), 4) AS stddev_value, max(value) AS max_value, min(value) AS min_value
    FROM spread GROUP BY ALL
    """,
)
def window_stats(spark, sf_dir):
    return _flat(windows.window_stats(readings(spark, sf_dir), "event_time", ["device_id"], "value", "1 day", "6 hours"))


@query(
    "tumbling",
    f"""
    WITH {READINGS_SQL}
    SELECT date_trunc('hour', event_time) AS window_start, date_trunc('hour', event_time) + INTERVAL 1 HOUR
             AS window_end, device_id, avg(value) AS avg_value, max(value) AS max_value,
           min(value) AS min_value, count(*) AS count
    FROM readings GROUP BY ALL
    """,
)
def tumbling(spark, sf_dir):
    return _flat(windows.tumbling(readings(spark, sf_dir), "event_time", ["device_id"], "value", "1 hour"))


@query(
    "sliding",
    f"""
    WITH {EVENT_WINDOWS}
    SELECT window_start, window_end, device_id, avg(value) AS avg_value,
           round(stddev_samp(value), 4) AS stddev_value
    FROM spread GROUP BY ALL
    """,
)
def sliding(spark, sf_dir):
    return _flat(windows.sliding(readings(spark, sf_dir), "event_time", ["device_id"], "value", "1 day", "6 hours"))


@query(
    "windowed_average",
    f"""
    WITH {EVENT_WINDOWS}
    SELECT window_start, window_end, device_id, avg(value) AS avg_value, count(*) AS count
    FROM spread GROUP BY ALL
    """,
)
def windowed_average(spark, sf_dir):
    return _flat(
        windows.sliding(
            readings(spark, sf_dir), "event_time", ["device_id"], "value", "1 day", "6 hours", ("avg", "count")
        )
    )


@query(
    "hourly",
    """
    SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
           event_type AS device_id, count(*) AS count
    FROM events GROUP BY ALL
    """,
)
def hourly(spark, sf_dir):
    return _flat(windows.hourly(readings(spark, sf_dir), "event_time", "device_id"))


@query(
    "throughput",
    """
    SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
           count(*) AS messages, round(count(*) / 3600.0, 9) AS per_second
    FROM events GROUP BY ALL
    """,
)
def throughput(spark, sf_dir):
    rates = parse.flatten_window(windows.throughput(readings(spark, sf_dir), "event_time", "1 hour"), iso=False)
    return rates.withColumn("per_second", F.round("per_second", 9))


@query(
    "distinct_exact",
    f"""
    WITH {CLICKS_SQL}, {CLICK_WINDOWS}
    SELECT window_start, window_end, user_id, count(DISTINCT page_url) AS distinct_count FROM spread GROUP BY ALL
    """,
)
def distinct_exact(spark, sf_dir):
    return _flat(
        aggregates.distinct_per_window(
            clicks(spark, sf_dir), "click_time", "user_id", "page_url", "1 day", "6 hours"
        )
    )


@query("distinct_approx")
def distinct_approx(spark, sf_dir):
    return _flat(
        aggregates.distinct_per_window(
            clicks(spark, sf_dir), "click_time", "user_id", "page_url", "1 day", "6 hours", approx=True
        )
    )


@query(
    "distinct_within_bound",
    f"""
    WITH {CLICKS_SQL}, {CLICK_WINDOWS}
    SELECT window_start, window_end, user_id, count(DISTINCT page_url) AS distinct_count, TRUE AS within_bound FROM spread GROUP BY ALL
    """,
)
def distinct_within_bound(spark, sf_dir):
    """The approximate count beside the exact one, within four standard errors (5 % each) and one."""
    count = lambda approx: _flat(
        aggregates.distinct_per_window(clicks(spark, sf_dir), "click_time", "user_id", "page_url", "1 day", "6 hours", approx=approx)
    )
    exact, about = count(False), count(True).withColumnRenamed("distinct_count", "about")
    both = exact.join(about, ["window_start", "window_end", "user_id"])
    within = F.abs(F.col("about") - F.col("distinct_count")) <= 0.2 * F.col("distinct_count") + 1
    return both.select("window_start", "window_end", "user_id", "distinct_count", within.alias("within_bound"))


SUSPICIOUS_SQL = f"""
    WITH {CLICKS_SQL}, {CLICK_WINDOWS}
    SELECT window_start, window_end, user_id, count(DISTINCT page_url) AS distinct_page_count
    FROM spread GROUP BY ALL HAVING count(DISTINCT page_url) >= 5
"""


@query("suspicious_users", SUSPICIOUS_SQL)
def suspicious_users(spark, sf_dir):
    found = aggregates.suspicious_users(clicks(spark, sf_dir), "click_time", size="1 day", slide="6 hours")
    return _flat(found)


TOP_COUNTS = """
counts AS (
  SELECT window_start, window_end, {key}, count(*) AS count FROM spread GROUP BY ALL)"""


def _top_sql(key: str, k: int) -> str:
    return f"""
    WITH {CLICKS_SQL}, {CLICK_WINDOWS}, {TOP_COUNTS.format(key=key)}
    SELECT * FROM counts ORDER BY window_start DESC, count DESC, {key} LIMIT {k}
    """


@query("top_pages_global", _top_sql("page_url", 5))
def top_pages_global(spark, sf_dir):
    return _flat(topk.top_global(clicks(spark, sf_dir), "click_time", "page_url", 5, "1 day", "6 hours"))


@query("top_users_global", _top_sql("user_id", 3))
def top_users_global(spark, sf_dir):
    return _flat(topk.top_global(clicks(spark, sf_dir), "click_time", "user_id", 3, "1 day", "6 hours"))


@query(
    "top_per_window",
    f"""
    WITH {CLICKS_SQL}, {CLICK_WINDOWS}, {TOP_COUNTS.format(key="page_url")}
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY count DESC, page_url) AS rank FROM counts)
    WHERE rank <= 5
    """,
)
def top_per_window(spark, sf_dir):
    best = _flat(topk.top_per_window(clicks(spark, sf_dir), "click_time", "page_url", 5, "1 day", "6 hours"))
    return best.withColumn("rank", F.col("rank").cast("bigint"))


ANOMALY_SQL = f"""
WITH {EVENT_WINDOWS},
stats AS (
  SELECT window_start, window_end, device_id, count(*) AS count, avg(value) AS avg_value,
         coalesce(nullif(stddev_samp(value), 0), 0.001) AS stddev_value, max(value) AS max_value,
         min(value) AS min_value
  FROM spread GROUP BY ALL),
scored AS (
  SELECT *, (max_value - avg_value) / stddev_value AS z_max, (min_value - avg_value) / stddev_value AS z_min
  FROM stats),
anomalies AS (
  SELECT window_start, window_end, device_id, count, avg_value,
         round(stddev_value, 4) AS stddev_value, max_value, min_value, round(z_max, 6) AS z_score_max,
         round(z_min, 6) AS z_score_min, z_max > 6 AS is_anomaly_high, z_min < -6 AS is_anomaly_low,
         z_max > 6 OR z_min < -6 AS is_anomaly,
         CASE WHEN z_max > 6 THEN 'HIGH_VALUE' WHEN z_min < -6 THEN 'LOW_VALUE' ELSE 'NORMAL' END AS anomaly_type,
         round(CASE WHEN z_max > 6 THEN z_max WHEN z_min < -6 THEN abs(z_min) ELSE 0.0 END, 6) AS anomaly_score
  FROM scored)
"""


def _anomalies(df):
    found = windows.detect_anomalies(df, size="1 day", slide="6 hours", sigma=6.0)
    scores = ["z_score_max", "z_score_min", "anomaly_score"]
    return _flat(found).withColumns({c: F.round(c, 6) for c in scores})


@query("anomalies", f"{ANOMALY_SQL} SELECT * FROM anomalies")
def anomalies(spark, sf_dir):
    return _anomalies(readings(spark, sf_dir))


@query(
    "anomaly_alerts",
    f"""{ANOMALY_SQL}
    SELECT window_start, window_end, device_id, anomaly_type, anomaly_score, avg_value, max_value, min_value
    FROM anomalies WHERE is_anomaly
    """,
)
def anomaly_alerts(spark, sf_dir):
    return windows.anomaly_alerts(_anomalies(readings(spark, sf_dir)))
