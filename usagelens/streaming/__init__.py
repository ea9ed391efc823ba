from usagelens.streaming.jobs import ingest_stream, monitor_stream, stream_daily_summary

__all__ = ["ingest_stream", "monitor_stream", "stream_daily_summary"]
