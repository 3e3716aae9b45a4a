"""Parsing, projections and lookups."""

import json

from conftest import at, rows

from tickstone import schemas
from tickstone.functions import format_ts, initial, initial_pandas, render_details, safe_double, safe_long, stable_bucket
from tickstone.operators import alerts, parse, report
from tickstone.operators.filters import trigger_rows
from tickstone.sources import in_memory


def records(spark, *values):
    data = [(f"k{i}".encode(), v.encode() if isinstance(v, str) else v, "t", 0, i, at("2024-01-01")) for i, v in enumerate(values)]
    return spark.createDataFrame(data, schemas.ENVELOPE)


GOOD = '{"timestamp":"2024-01-01T10:00:00","value":1.5,"device_id":"d1","status":"Normal"}'


def test_malformed_values_keep_their_row(spark):
    parsed = parse.parse_topic(records(spark, GOOD, "{broken", None), schemas.DEVICE_READING)
    assert rows(parsed, "key", "device_id", "value") == [("k0", "d1", 1.5), ("k1", None, None), ("k2", None, None)]


def test_volume_beyond_int(spark):
    tick = '{"ticker":"A","volume":5000000000}'
    assert parse.parse_topic(records(spark, tick), schemas.PRICE_TICK).first().volume == 5_000_000_000


def test_quarantine(spark):
    valid, bad = parse.split_valid(records(spark, GOOD, "{broken", None, "[1]"), schemas.DEVICE_READING)
    assert rows(valid, "key", "status") == [("k0", "Normal")]
    assert rows(bad, "key", "value") == [("k1", "{broken"), ("k2", None), ("k3", "[1]")]


def test_event_times(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00Z",), ("nonsense",), (None,)], "timestamp string")
    timed = parse.with_date(parse.with_event_time(df))
    assert [str(r.date) for r in timed.collect()] == ["2024-01-01", "None", "None"]
    seconds = spark.createDataFrame([(1704103200.5,)], "timestamp double")
    shown = parse.with_epoch_time(seconds).select(format_ts("event_time").alias("t")).first().t
    assert shown == "2024-01-01 10:00:00"


def test_enrich_keeps_unknown_fields_and_passes_the_rest(spark):
    values = ['{"id":7,"nested":{"a":[1,2]},"processed":"old"}', "{}", "[1,2]", "not json"]
    got = [r.value for r in parse.enrich_or_pass(records(spark, *values)).orderBy("offset").collect()]
    first, empty = json.loads(got[0]), json.loads(got[1])
    assert first["id"] == 7 and first["nested"] == {"a": [1, 2]} and first["processed"] is True
    assert empty["processed"] is True and isinstance(empty["processed_timestamp"], float)
    assert got[2:] == ["[1,2]", "not json"]


def test_routes_and_defaults(spark):
    df = spark.createDataFrame([("stock_price",), ("news",), ("reddit",), ("odd",), (None,)], "data_type string")
    split = parse.split_routes(df)
    assert {k: v.count() for k, v in split.items()} == {"stock": 1, "news": 2, "unknown": 2}
    filled = parse.fill_missing(df, {"data_type": "none", "url": ""})
    assert rows(filled.where("data_type = 'none'")) == [("none", "")]


def test_safe_numbers(spark):
    df = in_memory(spark, [("1.5",), ("nan",), (" None ",), ("",), ("x",), (None,)], "t string")
    got = [tuple(r) for r in df.select(safe_double("t"), safe_long("t")).collect()]
    assert got == [(1.5, 1)] + [(0.0, 0)] * 5 or got == [(1.5, 0)] + [(0.0, 0)] * 5
    nan = spark.createDataFrame([(float("nan"),)], "d double")
    assert nan.select(safe_double("d")).first()[0] == 0.0


def test_render_details(spark):
    df = spark.createDataFrame([('{"type":"x","ticker":"A","price":1.25,"note":"n","timestamp":"t"}',), ("raw",)], "d string")
    assert rows(df.select(render_details("d").alias("x"))) == [("price: 1.25, note: n",), ("raw",)]


def test_to_topic_and_back(spark):
    df = spark.createDataFrame([("A", 1, None)], "ticker string, n int, note string")
    out = parse.to_topic(df, "ticker").first()
    assert out.key == "A" and json.loads(out.value) == {"ticker": "A", "n": 1}


def test_initials(spark):
    df = spark.createDataFrame([("alice",), ("",), (None,)], "name string")
    got = [tuple(r) for r in df.select(initial("name"), initial_pandas("name")).collect()]
    assert got == [("A", "A"), (None, None), (None, None)]


def test_stable_bucket(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    # md5("a") starts with 0cc175b9, md5("b") with 92eb5ffe.
    assert [r[0] for r in df.select(stable_bucket("k", 10)).collect()] == [0x0CC175B9 % 10, 0x92EB5FFE % 10]


def test_series_and_triggers(spark):
    df = spark.createDataFrame(
        [(1, "Rex", "zoomy", True), (2, "Rex", "happy", True), (None, None, None, None), (4, "Bo", "bouncy", False)],
        "key int, pet_name string, pet_mood_post_treat string, final_treat boolean",
    )
    assert rows(trigger_rows(df)) == [("Rex", "zoomy")]
    lines = report.series_text(df, "Kim").collect()
    assert lines[0].greeting == "메시지 #1: 안녕하세요 Kim님, 반려동물 Rex이(가) 간식을 먹고 지금 zoomy 상태입니다!"
    assert lines[2].greeting.startswith("메시지: ") and "알 수 없음" in lines[2].greeting
    assert [r.last_line[-5:].strip() for r in lines] == ["True", "True", "False", "False"]


def test_activity_and_alert_labels(spark):
    df = spark.createDataFrame(
        [(1, "login", None, None), (2, "purchase", 500, None), (3, "dance", None, None)],
        "user_id int, action string, amount int, page string",
    )
    lines = [r.line for r in report.activity_text(df).collect()]
    assert lines == [
        "🟢 사용자 1가 로그인했습니다.", "💰 사용자 2가 500원 결제했습니다.",
        '⚪ 알 수 없는 액션: {"user_id":3,"action":"dance"}',
    ]
    raised = spark.createDataFrame([(None, None, None), ("price_drop", "m", "high")], "type string, message string, severity string")
    assert rows(report.alert_labels(raised), "subject", "severity_class") == [("주가 급락 알림", "critical"), ("주식 알림", "info")]


def test_message_dedup(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (1, "a")], "id int, v string")
    assert rows(alerts.dedup_messages(df)) == [(1, "a"), (2, "b")]
