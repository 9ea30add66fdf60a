"""Where event rows come from."""

from feedlab.sources.events import events, feed_actions, message_actions, stream_events
from feedlab.sources.readers import read_jdbc, read_log, read_table, read_tsv, run_sql

__all__ = ["events", "feed_actions", "message_actions", "read_jdbc", "read_log", "read_table", "read_tsv",
           "run_sql", "stream_events"]
