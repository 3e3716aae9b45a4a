"""Join, aggregate, top-k and partitioning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickstone.operators import aggregates, alerts, joins, partitioning, topk
from tickstone.plans.inputs import (
    POSTS_SQL,
    cents_of,
    keywords,
    order_documents,
    payload_number,
    posts,
    table,
    text_date,
)
from tickstone.plans.registry import query


@query(
    "latest_per_key",
    """
    SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    WHERE (l_suppkey, l_shipdate) IN (SELECT (l_suppkey, max(l_shipdate)) FROM lineitem GROUP BY l_suppkey)
    """,
)
def latest_per_key(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    return topk.latest_per_key(items, "l_suppkey", "l_shipdate")


@query(
    "asof_price",
    """
    WITH prices AS (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase'),
         marks AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'error')
    SELECT m.event_id, m.user_id, m.ts, p.value AS price
    FROM marks m ASOF JOIN prices p ON m.user_id = p.user_id AND m.ts >= p.ts
    """,
)
def asof_price(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    prices = events.where("event_type = 'purchase'").select("user_id", "ts", F.col("value").alias("price"), "event_id")
    marks = events.where("event_type = 'error'").select("event_id", "user_id", "ts")
    return joins.asof_join(marks, prices, "user_id", "ts", "price", tie="event_id")


@query(
    "mentions",
    f"""
    WITH {POSTS_SQL},
    words AS (SELECT DISTINCT regexp_extract(text, '[A-Za-z]{{8,}}') AS ticker FROM benchmark)
    SELECT doc_id, ticker FROM posts, words
    WHERE ticker <> '' AND (contains(lower(title), lower(ticker)) OR contains(lower(content), lower(ticker)))
    """,
)
def mentions(spark, sf_dir):
    found = joins.mention_join(posts(spark, sf_dir), keywords(spark, sf_dir), "doc_id")
    return found.select("doc_id", "ticker")


@query(
    "mentions_indexed",
    f"""
    WITH {POSTS_SQL},
    words AS (SELECT DISTINCT unnest([regexp_extract(text, '[A-Za-z]{{8,}}'), regexp_extract(text, '[A-Za-z]+'),
                              substr(regexp_extract(text, '[A-Za-z]+'), 1, 1)]) AS ticker FROM benchmark)
    SELECT doc_id, ticker FROM posts, words
    WHERE ticker <> '' AND (contains(lower(title), lower(ticker)) OR contains(lower(content), lower(ticker)))
    """,
)
def mentions_indexed(spark, sf_dir):
    """Keywords of any length, single letters among them."""
    first = F.regexp_extract("text", "[A-Za-z]+", 0)
    words = F.array(F.regexp_extract("text", "[A-Za-z]{8,}", 0), first, F.substring(first, 1, 1))
    listed = table(spark, sf_dir, "benchmark").select(F.explode(words).alias("ticker"))
    found = joins.mention_join(posts(spark, sf_dir), listed, "doc_id")
    return found.select("doc_id", "ticker")


@query(
    "thresholds",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, coalesce(CAST(s_nationkey AS DOUBLE), 2.0) AS threshold
    FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 5000) ON l_suppkey = s_suppkey
    """,
)
def thresholds(spark, sf_dir):
    own = table(spark, sf_dir, "supplier").where("s_acctbal > 5000")
    own = own.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("double").alias("threshold"))
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return joins.with_threshold(items, own, "l_suppkey", 2.0)


@query(
    "committed_only",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')
    """,
)
def committed_only(spark, sf_dir):
    done = table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'")
    done = done.select(F.col("o_orderkey").alias("l_orderkey"))
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return joins.committed_only(items, done, "l_orderkey")


@query(
    "drop_failed_orders",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    """,
)
def drop_failed_orders(spark, sf_dir):
    payments = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return joins.drop_failed(items, payments, "l_orderkey", "o_orderstatus = 'F'")


@query(
    "recent_baseline",
    """
    SELECT user_id, avg(round(value * 100)) AS avg_price, avg(k) AS avg_volume
    FROM (SELECT user_id, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
                 row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn <= 20 GROUP BY user_id
    """,
)
def recent_baseline(spark, sf_dir):
    averages = {"avg_price": cents_of("value"), "avg_volume": payload_number()}
    return topk.recent_baseline(table(spark, sf_dir, "events"), "user_id", "ts", averages, tie="event_id")


@query("count_by_status", "SELECT event_type AS status, count(*) AS count FROM events GROUP BY 1")
def count_by_status(spark, sf_dir):
    return aggregates.count_by(table(spark, sf_dir, "events").withColumnRenamed("event_type", "status"), ["status"])


@query(
    "count_by_device_status",
    "SELECT user_id AS device_id, event_type AS status, count(*) AS count FROM events GROUP BY 1, 2",
)
def count_by_device_status(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumnsRenamed({"user_id": "device_id", "event_type": "status"})
    return aggregates.count_by(events, ["device_id", "status"])


@query(
    "label_distribution",
    """
    SELECT CASE WHEN quality = 1 THEN 'positive' WHEN toxic = 1 THEN 'negative' ELSE 'neutral' END
             AS sentiment_label, count(*) AS count
    FROM labels GROUP BY 1
    """,
)
def label_distribution(spark, sf_dir):
    label = F.when(F.col("quality") == 1, "positive").when(F.col("toxic") == 1, "negative").otherwise("neutral")
    labelled = table(spark, sf_dir, "labels").select(label.alias("sentiment_label"))
    return aggregates.count_by(labelled, ["sentiment_label"])


MINUTES_SQL = """
    SELECT date_trunc('minute', ts) AS bucket, event_type AS action, count(*) AS cnt FROM events
    WHERE ts > (SELECT max(ts) FROM events) - INTERVAL {days} DAY GROUP BY 1, 2
"""


@query("minute_counts", MINUTES_SQL.format(days=1))
def minute_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "action")
    return aggregates.minute_counts(events, "ts", "action")


@query(
    "merge_minute_counts",
    f"""
    WITH old AS (
      SELECT date_trunc('minute', ts) AS bucket, event_type AS action, count(*) + 100 AS cnt FROM events
      WHERE event_id % 2 = 0 GROUP BY 1, 2),
    new AS ({MINUTES_SQL.format(days=7)})
    SELECT coalesce(new.bucket, old.bucket) AS bucket, coalesce(new.action, old.action) AS action,
           coalesce(new.cnt, old.cnt) AS cnt
    FROM old FULL JOIN new ON old.bucket = new.bucket AND old.action = new.action
    """,
)
def merge_minute_counts(spark, sf_dir):
    """A target that an earlier run filled from half of the events, and the counts of the last week."""
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "action")
    earlier = events.where("event_id % 2 = 0").groupBy(F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("bucket"), "action")
    old = earlier.agg((F.count(F.lit(1)) + 100).alias("cnt"))
    new = aggregates.minute_counts(events, "ts", "action", days=7)
    return aggregates.merge_counts(old, new, ["bucket", "action"])


@query(
    "daily_sentiment",
    """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, round(avg((value - 50) / 500), 6) AS avg_score,
           min(ts) AS first_timestamp
    FROM events GROUP BY 1
    """,
)
def daily_sentiment(spark, sf_dir):
    scores = table(spark, sf_dir, "events").select(
        F.col("ts").alias("timestamp"), ((F.col("value") - 50) / 500).alias("sentiment_score")
    )
    daily = aggregates.daily_sentiment(scores)
    return daily.select(text_date(), F.round("avg_score", 6).alias("avg_score"), "first_timestamp")


@query(
    "order_rollup",
    """
    SELECT 'O' || l_orderkey AS order_id, CAST(sum(l_linenumber) AS BIGINT) AS items,
           CAST(sum(l_linenumber * CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(l_quantity AS BIGINT)) AS BIGINT)
             AS amount
    FROM lineitem GROUP BY 1
    """,
)
def order_rollup(spark, sf_dir):
    return aggregates.order_rollup(order_documents(spark, sf_dir))


@query(
    "order_lines",
    """
    SELECT 'O' || l_orderkey AS order_id, CAST(i AS BIGINT) AS line, 'P' || l_partkey AS product_id,
           CAST(round(l_extendedprice * 100) AS BIGINT) AS price, CAST(l_quantity AS BIGINT) AS quantity,
           CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(l_quantity AS BIGINT) AS amount
    FROM (SELECT *, unnest(range(1, CAST(l_linenumber AS BIGINT) + 1)) AS i FROM lineitem)
    """,
)
def order_lines(spark, sf_dir):
    lines = aggregates.order_lines(order_documents(spark, sf_dir))
    return lines.withColumn("line", F.col("line").cast("bigint"))


HASH_SQL = "(('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8))::BIGINT % {n})"


@query("partition_hash", f"SELECT c_custkey, {HASH_SQL.format(key='c_custkey', n=8)} AS partition FROM customer")
def partition_hash(spark, sf_dir):
    assigned = partitioning.assign_partition(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", 8)
    return assigned.withColumn("partition", F.col("partition").cast("bigint"))


@query(
    "partition_rules",
    f"""
    SELECT c_custkey, CAST(CASE WHEN k IS NULL THEN 0 WHEN starts_with(k, 'KR') THEN 0 WHEN starts_with(k, 'US') THEN 1
           WHEN starts_with(k, 'JP') THEN 2 ELSE {HASH_SQL.format(key="k", n=6)} END AS BIGINT) AS partition
    FROM (SELECT c_custkey, CASE c_nationkey % 5 WHEN 0 THEN 'KR-' || c_custkey WHEN 1 THEN 'US-' || c_custkey
                 WHEN 2 THEN 'JP-' || c_custkey WHEN 3 THEN 'DE-' || c_custkey END AS k FROM customer)
    """,
)
def partition_rules(spark, sf_dir):
    region = F
    for rest, prefix in enumerate(["KR-", "US-", "JP-", "DE-"]):
        region = region.when(F.col("c_nationkey") % 5 == rest, F.concat(F.lit(prefix), "c_custkey"))
    keyed = table(spark, sf_dir, "customer").select("c_custkey", region.alias("key"))
    assigned = partitioning.assign_partition(keyed, "key", 6, partitioning.REGION_RULES)
    return assigned.select("c_custkey", F.col("partition").cast("bigint"))


@query(
    "partition_distribution",
    f"SELECT {HASH_SQL.format(key='user_id', n=3)} AS partition, user_id, count(*) AS count FROM events GROUP BY 1, 2",
)
def partition_distribution(spark, sf_dir):
    assigned = partitioning.assign_partition(table(spark, sf_dir, "events"), "user_id", 3)
    counted = partitioning.partition_distribution(assigned, "user_id")
    return counted.withColumn("partition", F.col("partition").cast("bigint"))


@query(
    "last_n",
    """
    SELECT user_id, ts, event_id, value, rank
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank FROM events)
    WHERE rank <= 10
    """,
)
def last_n(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    newest = topk.last_n(events, "user_id", "ts", 10, "event_id")
    return newest.withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "last_n_of_key",
    "SELECT ts, event_id, value FROM events WHERE user_id = 12 ORDER BY ts DESC, event_id DESC LIMIT 20",
)
def last_n_of_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return topk.last_n(events, "user_id", "ts", 20, "event_id", of=12).drop("user_id")


@query(
    "dedup_messages",
    "SELECT event_id AS id, event_type, value FROM events",
)
def dedup_messages(spark, sf_dir):
    """Every message is sent one to three times."""
    copies = F.explode(F.sequence(F.lit(0), F.col("event_id") % 3)).alias("attempt")
    sent = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "event_type", "value", copies)
    return alerts.dedup_messages(sent.drop("attempt"), "id")
