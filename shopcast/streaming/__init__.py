"""Structured Streaming plans."""

from shopcast.streaming.anomaly import (  # noqa: F401
    ANOMALY_SCHEMA, LiveCounters, drain, make_batch_writer, prepare_baseline, read_anomalies, read_sales_stream,
    read_scored, score_directory, start_anomaly_query, stream_stats, stream_totals, supervise)
