from tickstone.streaming.run import await_any, foreach_batch, late_split, newest_records, read_table_sink, start, table_sink, update_sink
from tickstone.streaming.stateful import dedup_alerts_stream, market_events_stream, price_alerts_stream

__all__ = [
    "await_any",
    "dedup_alerts_stream",
    "foreach_batch",
    "late_split",
    "market_events_stream",
    "newest_records",
    "price_alerts_stream",
    "read_table_sink",
    "start",
    "table_sink",
    "update_sink",
]
