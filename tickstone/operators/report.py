"""Per-ticker documents, daily report rows, alert lines and display lookups."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickstone.functions import lookup, safe_double, safe_long

# Texts and marks of the reports, alerts and log lines.
BUY_TEXT = "%s 매수 신호 감지"
SELL_TEXT = "%s 매도 신호 감지"
SIGNAL_LINE = "%s: %s 신호 감지 - %s"
OVERBOUGHT_LINE = "%s: RSI 과매수 상태 (RSI: %.1f) - 매도 고려"
OVERSOLD_LINE = "%s: RSI 과매도 상태 (RSI: %.1f) - 매수 고려"
BULLISH_LINE = "%s: 강세 추세 - 단기 이동평균선이 장기 이동평균선 위에 위치"
BEARISH_LINE = "%s: 약세 추세 - 단기 이동평균선이 장기 이동평균선 아래에 위치"
REPORT_DAYS_AHEAD = 2
RSI_MARKS = {"overbought": "⚠️", "oversold": "✅"}
MA_MARKS = {"bullish": "📈", "bearish": "📉"}
CHANGE_MARKS = {"up": "🚀", "down": "📉"}
NO_MARK = "➖"
EVENT_COLORS = {"price_surge": "green", "price_drop": "red", "volume_surge": "orange"}
EVENT_SYMBOLS = {"price_surge": "triangle-up", "price_drop": "triangle-down", "volume_surge": "star"}
EVENT_COLOR, EVENT_SYMBOL = "red", "circle"
ALERT_SUBJECTS = {
    "price_surge": "주가 급등 알림",
    "price_drop": "주가 급락 알림",
    "volume_surge": "거래량 급증 알림",
    "sentiment_alert": "감성 분석 알림",
}
ALERT_SUBJECT = "주식 알림"
ALERT_TYPE, ALERT_MESSAGE, ALERT_SEVERITY = "unknown", "알림 메시지 없음", "info"
SEVERITY_CLASSES = {"warning": "warning", "critical": "critical", "high": "critical"}
ACTIVITY_LINES = {
    "login": "🟢 사용자 %s가 로그인했습니다.",
    "logout": "🔴 사용자 %s가 로그아웃했습니다.",
    "purchase": "💰 사용자 %s가 %s원 결제했습니다.",
    "view_page": "👁️ 사용자 %s가 %s 페이지를 조회했습니다.",
}
OTHER_ACTIVITY = "⚪ 알 수 없는 액션: %s"
SERIES_KEYED = "메시지 #%s: 안녕하세요 %s님, 반려동물 %s이(가) 간식을 먹고 지금 %s 상태입니다!"
SERIES_PLAIN = "메시지: 안녕하세요 %s님, 반려동물 %s이(가) 간식을 먹고 지금 %s 상태입니다!"
SERIES_LAST = "마지막 간식입니까? %s"
SERIES_OWNER, SERIES_UNKNOWN = "주인", "알 수 없음"


def signals() -> Column:
    """Array of (type, direction, strength, description) from the buy and the sell signal."""

    def entry(column: str, direction: str, text: str) -> Column:
        return F.when(
            F.col(column).isNotNull(),
            F.struct(
                F.col(column).alias("type"),
                F.lit(direction).alias("direction"),
                F.coalesce("signal_strength", F.lit("medium")).alias("strength"),
                F.format_string(text, F.col(column)).alias("description"),
            ),
        )

    return F.array_compact(
        F.array(entry("buy_signal", "buy", BUY_TEXT), entry("sell_signal", "sell", SELL_TEXT))
    )


def ticker_documents(summary: DataFrame) -> DataFrame:
    """One document per ticker, ready for a JSON writer: safe numbers and nested ``signals``."""
    numbers = ["open", "high", "low", "close"]
    indicators = ["ma_short", "ma_long", "ma_50", "ma_200", "rsi", "macd", "macd_signal", "macd_histogram"]
    return summary.select(
        "ticker",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        *[safe_double(c).alias(c) for c in numbers],
        safe_long("volume").alias("volume"),
        *[safe_double(c).alias(c) for c in indicators],
        "trend",
        F.coalesce("ma_status", F.lit("unknown")).alias("ma_status"),
        F.coalesce("rsi_status", F.lit("unknown")).alias("rsi_status"),
        F.coalesce("change_pct", F.lit(0.0)).alias("change_pct"),
        signals().alias("signals"),
    )


def direction(change: Column | str) -> Column:
    """``up`` above 0, else ``down``."""
    value = F.col(change) if isinstance(change, str) else change
    return F.when(value > 0, "up").otherwise("down")


def sign_class(change: Column | str) -> Column:
    """``up``, ``down`` or ``flat``."""
    value = F.col(change) if isinstance(change, str) else change
    return F.when(value > 0, "up").when(value < 0, "down").otherwise("flat")


def report_rows(documents: DataFrame, run_date: date | str) -> DataFrame:
    """Rows of the daily report with their display marks."""
    return documents.select(
        F.date_add(F.lit(run_date).cast("date"), REPORT_DAYS_AHEAD).alias("report_date"),
        "ticker",
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("open", "close", "high", "low", "change_pct", "rsi")],
        F.coalesce("rsi_status", F.lit("unknown")).alias("rsi_status"),
        F.coalesce("ma_status", F.lit("unknown")).alias("ma_status"),
        lookup(sign_class("change_pct"), CHANGE_MARKS, NO_MARK).alias("change_mark"),
        lookup("rsi_status", RSI_MARKS, NO_MARK).alias("rsi_mark"),
        lookup("ma_status", MA_MARKS, NO_MARK).alias("ma_mark"),
    )


def report_alerts(documents: DataFrame) -> DataFrame:
    """Alert lines per ticker in order: strong signals, RSI state, average state."""
    strong = F.filter("signals", lambda s: s["strength"] == "strong")
    lines = F.transform(
        strong, lambda s: F.format_string(SIGNAL_LINE, F.col("ticker"), s["type"], s["description"])
    )
    rsi_line = F.when(
        F.col("rsi_status") == "overbought", F.format_string(OVERBOUGHT_LINE, "ticker", "rsi")
    ).when(F.col("rsi_status") == "oversold", F.format_string(OVERSOLD_LINE, "ticker", "rsi"))
    ma_line = F.when(F.col("ma_status") == "bullish", F.format_string(BULLISH_LINE, "ticker")).when(
        F.col("ma_status") == "bearish", F.format_string(BEARISH_LINE, "ticker")
    )
    every = F.concat(lines, F.array_compact(F.array(rsi_line, ma_line)))
    return documents.select("ticker", F.posexplode(every).alias("position", "alert"))


def alert_labels(df: DataFrame) -> DataFrame:
    """Alerts with defaults, mail subject and severity class."""
    return df.withColumns(
        {
            "type": F.coalesce("type", F.lit(ALERT_TYPE)),
            "message": F.coalesce("message", F.lit(ALERT_MESSAGE)),
            "severity": F.coalesce("severity", F.lit(ALERT_SEVERITY)),
        }
    ).withColumns(
        {
            "subject": lookup("type", ALERT_SUBJECTS, ALERT_SUBJECT),
            "severity_class": lookup("severity", SEVERITY_CLASSES, ALERT_SEVERITY),
        }
    )


def event_marks(df: DataFrame, column: str = "event_type") -> DataFrame:
    """Chart color and symbol per event type."""
    return df.withColumns(
        {
            "color": lookup(column, EVENT_COLORS, EVENT_COLOR),
            "symbol": lookup(column, EVENT_SYMBOLS, EVENT_SYMBOL),
        }
    )


def activity_text(df: DataFrame, name: str = "line") -> DataFrame:
    """Log line per user activity; an unknown action shows the whole record as JSON."""
    fields = {"login": [], "logout": [], "purchase": ["amount"], "view_page": ["page"]}
    text = F
    for action, line in ACTIVITY_LINES.items():
        args = [F.col(c).cast("string") for c in ("user_id", *fields[action])]
        text = text.when(F.col("action") == action, F.format_string(line, *args))
    whole = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    return df.withColumn(name, text.otherwise(F.format_string(OTHER_ACTIVITY, whole)))


def series_text(df: DataFrame, owner: str | None = None) -> DataFrame:
    """Greeting and last-flag line per series message; missing fields get their defaults."""
    name = F.lit(owner or SERIES_OWNER)
    pet = F.coalesce("pet_name", F.lit(SERIES_UNKNOWN))
    mood = F.coalesce("pet_mood_post_treat", F.lit(SERIES_UNKNOWN))
    last = F.when(F.coalesce("final_treat", F.lit(False)), "True").otherwise("False")
    greeting = F.when(
        F.col("key").isNotNull(), F.format_string(SERIES_KEYED, F.col("key").cast("string"), name, pet, mood)
    ).otherwise(F.format_string(SERIES_PLAIN, name, pet, mood))
    return df.withColumns({"greeting": greeting, "last_line": F.format_string(SERIES_LAST, last)})
