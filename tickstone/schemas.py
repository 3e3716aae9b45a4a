"""Record and table schemas as DDL strings (accepted by ``from_json``, readers and ``createDataFrame``).

Volumes are BIGINT throughout: an INT field would turn an over-range JSON number into NULL.
"""

ENVELOPE = "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"

# Records found in the JSON value of a topic message.
DEVICE_READING = "timestamp STRING, value DOUBLE, device_id STRING, status STRING"
CLICK = "user_id STRING, page_url STRING, click_time STRING, referrer STRING, user_agent STRING"
PRICE_TICK = (
    "ticker STRING, timestamp STRING, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, "
    "volume BIGINT, change_pct DOUBLE"
)
USER_EVENT = "user_id INT, event STRING, amount INT, page STRING, timestamp STRING"
USER_EVENT_SHORT = "user_id INT, event STRING, timestamp STRING"
USER_ACTIVITY = "user_id INT, action STRING, amount INT, page STRING, timestamp DOUBLE"
ORDER_PRODUCTS = "ARRAY<STRUCT<product_id: STRING, price: BIGINT, quantity: INT, amount: BIGINT>>"
ORDER = (
    f"order_id STRING, user_id INT, order_timestamp STRING, products {ORDER_PRODUCTS}, "
    "total_amount BIGINT, payment_method STRING, shipping_address STRING"
)
ORDER_EVENT = (
    "order_id INT, customer_id STRING, product_id STRING, quantity INT, status STRING, timestamp DOUBLE"
)
PAYMENT_EVENT = (
    "order_id INT, payment_method STRING, amount DOUBLE, status STRING, error_code STRING, timestamp DOUBLE"
)
TXN_MESSAGE = "transaction INT, message_id INT, timestamp STRING, value STRING"
ID_MESSAGE = "id STRING, value STRING, timestamp STRING"
RAW_STOCK = "ticker STRING, price DOUBLE, volume BIGINT, timestamp STRING, data_type STRING"
RAW_NEWS = (
    "ticker STRING, title STRING, content STRING, source STRING, url STRING, published_at STRING, "
    "timestamp STRING, data_type STRING, score INT, num_comments INT"
)
ALERT = (
    "type STRING, ticker STRING, message STRING, severity STRING, timestamp STRING, "
    "sentiment_score DOUBLE, sentiment_label STRING, source STRING, url STRING"
)
SERIES_MESSAGE = "pet_name STRING, pet_mood_post_treat STRING, final_treat BOOLEAN"
REGION_EVENT = "user_id STRING, region STRING, event STRING, timestamp DOUBLE"

# Rows analysed by the market job.
PRICE_ROW = (
    "ticker STRING, timestamp TIMESTAMP, date DATE, open DOUBLE, high DOUBLE, low DOUBLE, "
    "close DOUBLE, volume BIGINT"
)

# Relational tables; decimals apply at the sink boundary only.
STOCK_PRICES_MARKET = (
    "ticker STRING, date DATE, timestamp TIMESTAMP, open DECIMAL(10,2), high DECIMAL(10,2), "
    "low DECIMAL(10,2), close DECIMAL(10,2), volume BIGINT"
)
STOCK_ALERTS = (
    "ticker STRING, alert_type STRING, price DECIMAL(10,2), change_percent DECIMAL(8,4), "
    "timestamp TIMESTAMP, is_processed BOOLEAN"
)
STOCK_ANALYSIS_RESULTS = (
    "ticker STRING, date DATE, ma_short DECIMAL(10,2), ma_long DECIMAL(10,2), rsi DECIMAL(6,2), "
    "macd DECIMAL(10,4), signal DECIMAL(10,4), buy_signal STRING, sell_signal STRING, "
    "signal_strength STRING"
)
STOCK_PRICES = "ticker STRING, timestamp TIMESTAMP, price DECIMAL(10,2), volume BIGINT"
EVENTS = "ticker STRING, event_type STRING, timestamp TIMESTAMP, data STRING"
SENTIMENT_RESULTS = (
    "ticker STRING, source STRING, title STRING, content STRING, url STRING, "
    "sentiment_score DECIMAL(4,3), sentiment_label STRING, timestamp TIMESTAMP"
)
