from basalt.streaming.streams import (  # noqa: F401
    five_minute_stats, raw_event_stream, read_table, start_deduping, start_five_minute_stats, start_ingest,
    start_with_handler,
)
