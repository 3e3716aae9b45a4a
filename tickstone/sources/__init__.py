from tickstone.sources.tables import in_memory, read_table
from tickstone.sources.topics import TopicSpec, or_fallback, read_topic, select_topic, stream_files

__all__ = ["TopicSpec", "in_memory", "or_fallback", "read_table", "read_topic", "select_topic", "stream_files"]
