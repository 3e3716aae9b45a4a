"""Sources, parsing, projection and filter queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tickstone.functions import format_ts, initial, initial_pandas, render_details, safe_double, safe_long
from tickstone.operators import filters, parse, report
from tickstone.plans.inputs import EVENT_RECORD, cents_of, envelope, payload_number, table
from tickstone.plans.registry import query
from tickstone.sources import read_table, select_topic

NTZ = "timestamp_ntz"


@query(
    "topic_snapshot",
    """
    SELECT CAST(user_id AS VARCHAR) AS key, event_id AS "offset", ts AS "timestamp",
           CASE WHEN event_id % 10 = 3 THEN NULL ELSE event_type END AS event_type
    FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'
    """,
)
def topic_snapshot(spark, sf_dir):
    topic = envelope(table(spark, sf_dir, "events"))
    part = select_topic(topic, "events", datetime(2024, 1, 5), datetime(2024, 1, 20))
    parsed = parse.parse_topic(part, EVENT_RECORD, keep=("key", "offset", "timestamp"))
    return parsed.select("key", "offset", "timestamp", "event_type")


@query(
    "table_range",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1997-12-31'
    """,
)
def table_range(spark, sf_dir):
    picked = read_table(
        spark,
        path=f"{sf_dir}/orders.parquet",
        start=datetime(1996, 1, 1),
        end=datetime(1997, 12, 31),
        column="o_orderdate",
    )
    return picked.select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "topic_encode",
    """
    SELECT CAST(user_id AS VARCHAR) AS key, '{"event_id":' || event_id || ',"event_type":"' || event_type
           || '","value":' || value || '}' AS value
    FROM events
    """,
)
def topic_encode(spark, sf_dir):
    return parse.to_topic(table(spark, sf_dir, "events"), "user_id", ["event_id", "event_type", "value"])


@query(
    "parse_json",
    """
    SELECT CAST(user_id AS VARCHAR) AS key, CASE WHEN ok THEN event_id END::DOUBLE AS event_id,
           CASE WHEN ok THEN event_type END AS event_type, CASE WHEN ok THEN value END AS value,
           CASE WHEN ok THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS event_time
    FROM (SELECT *, event_id % 10 <> 3 AS ok FROM events)
    """,
)
def parse_json(spark, sf_dir):
    parsed = parse.parse_topic(envelope(table(spark, sf_dir, "events")), EVENT_RECORD)
    return parsed.select("key", F.col("event_id").cast("double"), "event_type", "value", "event_time")


@query(
    "event_time_date",
    """
    SELECT event_id, t AS event_time, CAST(CAST(t AS DATE) AS VARCHAR) AS date,
           strftime(t, '%Y-%m-%d %H:%M:%S') AS shown
    FROM (SELECT event_id, CASE WHEN event_id % 11 <> 5 THEN ts END AS t FROM events)
    """,
)
def event_time_date(spark, sf_dir):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = F.when(F.col("event_id") % 11 == 5, "not a time").otherwise(stamp)
    raw = table(spark, sf_dir, "events").select("event_id", text.alias("timestamp"))
    dated = parse.with_date(parse.with_event_time(raw))
    return dated.select(
        "event_id",
        F.col("event_time").cast(NTZ).alias("event_time"),
        F.col("date").cast("string").alias("date"),
        format_ts("timestamp").alias("shown"),
    )


@query("processing_time", "SELECT event_id, ts, true AS stamped_later FROM events")
def processing_time(spark, sf_dir):
    """The time itself is that of the run, so only its order is compared."""
    stamped = parse.with_processing_time(table(spark, sf_dir, "events").select("event_id", "ts"))
    later = F.col("processing_time") > F.col("ts").cast("timestamp")
    return stamped.select("event_id", "ts", later.alias("stamped_later"))


def _small_records(spark, sf_dir):
    """Short JSON records; every seventh lacks its closing brace."""
    value = F.concat(
        F.lit('{"event_id":'), "event_id", F.lit(',"event_type":"'), "event_type", F.lit('"'),
        F.when(F.col("event_id") % 7 == 2, "").otherwise("}"),
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("key"), value.alias("value"), "event_id", "ts"
    )


@query(
    "quarantine",
    """
    SELECT CAST(user_id AS VARCHAR) AS key,
           CASE WHEN event_id % 7 <> 2 THEN event_type END AS event_type,
           CASE WHEN event_id % 7 = 2
                THEN '{"event_id":' || event_id || ',"event_type":"' || event_type || '"' END AS quarantined
    FROM events
    """,
)
def quarantine(spark, sf_dir):
    valid, bad = parse.split_valid(_small_records(spark, sf_dir), "event_id BIGINT, event_type STRING")
    kept = valid.select("key", "event_type", F.lit(None).cast("string").alias("quarantined"))
    return kept.unionByName(bad.select("key", F.lit(None).alias("event_type"), F.col("value").alias("quarantined")))


@query(
    "enrich_or_pass",
    """
    SELECT event_id, CASE WHEN ok THEN 'true' END AS processed, CASE WHEN ok THEN event_type END AS event_type,
           CASE WHEN ok THEN epoch_us(ts) / 1e6 END AS processed_timestamp,
           CASE WHEN NOT ok
                THEN '{"event_id":' || event_id || ',"event_type":"' || event_type || '"' END AS passed
    FROM (SELECT *, event_id % 7 <> 2 AS ok FROM events)
    """,
)
def enrich_or_pass(spark, sf_dir):
    done = parse.enrich_or_pass(_small_records(spark, sf_dir), processed_at=F.col("ts"))
    processed = F.get_json_object("value", "$.processed")
    return done.select(
        "event_id",
        processed.alias("processed"),
        F.get_json_object("value", "$.event_type").alias("event_type"),
        F.get_json_object("value", "$.processed_timestamp").cast("double").alias("processed_timestamp"),
        F.when(processed.isNull(), F.col("value")).alias("passed"),
    )


@query(
    "route_counts",
    """
    SELECT CASE event_type WHEN 'click' THEN 'stock' WHEN 'view' THEN 'news' WHEN 'purchase' THEN 'news'
                ELSE 'unknown' END AS route, count(*) AS n
    FROM events GROUP BY 1
    """,
)
def route_counts(spark, sf_dir):
    kind = (
        F.when(F.col("event_type") == "click", "stock_price")
        .when(F.col("event_type") == "view", "news")
        .when(F.col("event_type") == "purchase", "reddit")
        .otherwise(F.col("event_type"))
    )
    feed = table(spark, sf_dir, "events").select(kind.alias("data_type"))
    return parse.route(feed, "data_type", parse.FEED_ROUTES).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@query(
    "fill_missing",
    """
    SELECT event_id, CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END AS amount, 'none' AS page
    FROM events
    """,
)
def fill_missing(spark, sf_dir):
    amount = F.when(F.col("event_type") == "purchase", F.col("value"))
    return parse.fill_missing(
        table(spark, sf_dir, "events").select("event_id", amount.alias("amount")), {"amount": 0.0, "page": "none"}
    )


@query(
    "safe_double",
    """
    SELECT event_id, CASE WHEN event_id % 6 = 5 THEN value ELSE 0.0 END AS number,
           CASE WHEN event_id % 6 = 5 THEN user_id ELSE 0 END AS volume
    FROM events
    """,
)
def safe_numbers(spark, sf_dir):
    def spoiled(column):
        texts = ["nan", "None", "", None, "abc"]
        text = F.when(F.col("event_id") % 6 == 5, F.col(column).cast("string"))
        for i, bad in enumerate(texts):
            text = text.when(F.col("event_id") % 6 == i, F.lit(bad))
        return text

    return table(spark, sf_dir, "events").select(
        "event_id", safe_double(spoiled("value")).alias("number"), safe_long(spoiled("user_id")).alias("volume")
    )


@query(
    "render_details",
    """
    SELECT event_id, 'price: ' || CAST(round(value * 100) AS BIGINT) || ', change: '
           || json_extract_string(props, '$.k') AS details
    FROM events
    """,
)
def details(spark, sf_dir):
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    data = F.to_json(
        F.struct(
            F.col("event_type").alias("type"),
            F.col("user_id").alias("ticker"),
            cents_of("value").cast("bigint").alias("price"),
            payload_number().alias("change"),
            stamp.alias("timestamp"),
        )
    )
    return table(spark, sf_dir, "events").select("event_id", render_details(data).alias("details"))


@query(
    "filter_range",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1997-07-01'
    """,
)
def filter_range(spark, sf_dir):
    picked = filters.in_days(table(spark, sf_dir, "lineitem"), "l_shipdate", "1997-01-01", "1997-06-30")
    return picked.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "filter_keys",
    "SELECT event_id, user_id, value FROM events WHERE event_type IN ('purchase', 'signup')",
)
def filter_keys(spark, sf_dir):
    picked = filters.in_keys(table(spark, sf_dir, "events"), "event_type", "purchase, signup")
    return picked.select("event_id", "user_id", "value")


@query(
    "key_range",
    """
    SELECT event_id, ts, event_type FROM events
    WHERE user_id = 7 AND ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-25' ORDER BY ts DESC
    """,
)
def key_range(spark, sf_dir):
    lo, hi = datetime(2024, 1, 3), datetime(2024, 1, 25)
    picked = filters.key_range(table(spark, sf_dir, "events"), "user_id", 7, "ts", lo, hi)
    return picked.select("event_id", "ts", "event_type")


@query(
    "look_back",
    """
    SELECT event_id, ts, value FROM events
    WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY
    """,
)
def look_back(spark, sf_dir):
    return filters.look_back(table(spark, sf_dir, "events"), "ts", "1W").select("event_id", "ts", "value")


def _series(spark, sf_dir):
    """Events as messages of a treat series; some lack their mood or key."""
    mood = (
        F.when(F.col("event_type") == "click", "satisfied")
        .when(F.col("event_type") == "view", "happy")
        .when(F.col("event_type") == "purchase", "zoomy")
        .when(F.col("event_type") == "signup", "bouncy")
    )
    return table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 4 != 0, F.col("event_id")).alias("key"),
        F.concat(F.lit("pet"), "user_id").alias("pet_name"),
        mood.alias("pet_mood_post_treat"),
        (payload_number() % 5 == 0).alias("final_treat"),
    )


@query(
    "trigger_rows",
    """
    SELECT 'pet' || user_id AS pet_name,
           CASE event_type WHEN 'purchase' THEN 'zoomy' ELSE 'bouncy' END AS pet_mood_post_treat
    FROM events
    WHERE event_type IN ('purchase', 'signup') AND CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 = 0
    """,
)
def trigger_rows(spark, sf_dir):
    return filters.trigger_rows(_series(spark, sf_dir))


@query(
    "series_text",
    """
    SELECT CASE WHEN event_id % 4 <> 0 THEN '메시지 #' || event_id || ': ' ELSE '메시지: ' END
           || '안녕하세요 주인님, 반려동물 pet' || user_id || '이(가) 간식을 먹고 지금 '
           || CASE event_type WHEN 'click' THEN 'satisfied' WHEN 'view' THEN 'happy' WHEN 'purchase' THEN 'zoomy'
                   WHEN 'signup' THEN 'bouncy' ELSE '알 수 없음' END || ' 상태입니다!' AS greeting,
           '마지막 간식입니까? ' || CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 = 0
                                      THEN 'True' ELSE 'False' END AS last_line
    FROM events
    """,
)
def series_text(spark, sf_dir):
    return report.series_text(_series(spark, sf_dir)).select("greeting", "last_line")


@query(
    "activity_text",
    """
    SELECT event_id, CASE event_type
      WHEN 'signup' THEN '🟢 사용자 ' || user_id || '가 로그인했습니다.'
      WHEN 'error' THEN '🔴 사용자 ' || user_id || '가 로그아웃했습니다.'
      WHEN 'purchase' THEN '💰 사용자 ' || user_id || '가 ' || CAST(round(value) AS BIGINT) || '원 결제했습니다.'
      WHEN 'view' THEN '👁️ 사용자 ' || user_id || '가 /p/' || event_id || ' 페이지를 조회했습니다.'
      ELSE '⚪ 알 수 없는 액션: {"user_id":' || user_id || ',"action":"click","amount":'
           || CAST(round(value) AS BIGINT) || ',"page":"/p/' || event_id || '"}' END AS line
    FROM events
    """,
)
def activity_text(spark, sf_dir):
    action = (
        F.when(F.col("event_type") == "signup", "login")
        .when(F.col("event_type") == "error", "logout")
        .when(F.col("event_type") == "view", "view_page")
        .otherwise(F.col("event_type"))
    )
    activity = table(spark, sf_dir, "events").select(
        "user_id",
        action.alias("action"),
        F.round("value").cast("bigint").alias("amount"),
        F.concat(F.lit("/p/"), "event_id").alias("page"),
    )
    lines = report.activity_text(activity)
    return lines.select(F.substring_index("page", "/", -1).cast("bigint").alias("event_id"), "line")


@query(
    "alert_labels",
    """
    SELECT event_id, coalesce(kind, 'unknown') AS type,
      CASE WHEN event_id % 5 = 0 THEN '알림 메시지 없음' ELSE 'm' || event_id END AS message,
      CASE kind WHEN 'price_surge' THEN '주가 급등 알림' WHEN 'price_drop' THEN '주가 급락 알림'
           WHEN 'volume_surge' THEN '거래량 급증 알림' WHEN 'sentiment_alert' THEN '감성 분석 알림'
           ELSE '주식 알림' END AS subject,
      coalesce(severity, 'info') AS severity,
      CASE WHEN severity IN ('high', 'critical') THEN 'critical' WHEN severity = 'warning' THEN 'warning'
           ELSE 'info' END AS severity_class,
      CASE WHEN value > 50 THEN 'up' ELSE 'down' END AS direction,
      CASE kind WHEN 'price_surge' THEN 'green' WHEN 'volume_surge' THEN 'orange' ELSE 'red' END AS color,
      CASE kind WHEN 'price_surge' THEN 'triangle-up' WHEN 'price_drop' THEN 'triangle-down'
           WHEN 'volume_surge' THEN 'star' ELSE 'circle' END AS symbol
    FROM (SELECT event_id, value,
            CASE event_type WHEN 'click' THEN 'price_surge' WHEN 'view' THEN 'price_drop'
                 WHEN 'purchase' THEN 'volume_surge' WHEN 'error' THEN 'sentiment_alert' END AS kind,
            CASE event_id % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'warning' WHEN 2 THEN 'critical' END AS severity
          FROM events)
    """,
)
def alert_labels(spark, sf_dir):
    kind = F
    for event, name in {
        "click": "price_surge", "view": "price_drop", "purchase": "volume_surge", "error": "sentiment_alert"
    }.items():
        kind = kind.when(F.col("event_type") == event, name)
    severity = F
    for rest, name in enumerate(["high", "warning", "critical"]):
        severity = severity.when(F.col("event_id") % 4 == rest, name)
    alerts = table(spark, sf_dir, "events").select(
        "event_id",
        kind.alias("type"),
        F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("m"), "event_id")).alias("message"),
        severity.alias("severity"),
        report.direction(F.col("value") - 50).alias("direction"),
    )
    return report.event_marks(report.alert_labels(alerts), "type")


@query(
    "initial_udf",
    """
    SELECT c_custkey, upper(substring(c_mktsegment, 1, 1)) AS initial,
           upper(substring(c_mktsegment, 1, 1)) AS initial_batched
    FROM customer WHERE c_acctbal > 26
    """,
)
def initial_udf(spark, sf_dir):
    people = filters.only(table(spark, sf_dir, "customer"), F.col("c_acctbal") > 26)
    name = F.lower("c_mktsegment")
    return people.select("c_custkey", initial(name).alias("initial"), initial_pandas(name).alias("initial_batched"))
