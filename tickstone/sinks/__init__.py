from tickstone.sinks.batch import append_rows, save, write_jdbc, write_topic
from tickstone.sinks.replay import read_committed, upsert_counts, write_replay_safe

__all__ = [
    "append_rows",
    "read_committed",
    "save",
    "upsert_counts",
    "write_jdbc",
    "write_replay_safe",
    "write_topic",
]
