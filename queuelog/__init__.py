"""Topics of a partitioned message queue as Spark tables."""

from queuelog.operators.changelog import upsert_materialize
from queuelog.sources.datasource import register
from queuelog.sources.scan import read_log, read_log_stream, read_messages, register_topic, tag_filter
from queuelog.streaming.sink import write_log, write_log_stream

__all__ = [
    "read_log", "read_log_stream", "read_messages", "register", "register_topic", "tag_filter",
    "upsert_materialize", "write_log", "write_log_stream",
]
