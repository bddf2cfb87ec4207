from clickstream.streaming.batches import (
    BATCH_INTERVAL,
    archive,
    batch_table,
    compact_table,
    each_batch,
    quarantine,
    record_offsets,
    replace_table,
    run_batches,
    write_batch,
)
from clickstream.streaming.history import (
    areas_of_days,
    daily_visits,
    refresh_visits,
    traffic_by_day,
    traffic_of_days,
)
from clickstream.streaming.kpis import run_job, run_kpis
from clickstream.streaming.rankings import run_top_products
from clickstream.streaming.sinks import KPI_SCHEMA, kpi_sink, latest_kpis
from clickstream.streaming.stopping import await_stop, request_stop, stop_at
from clickstream.streaming.visitors import run_views, run_visitors

__all__ = [
    "BATCH_INTERVAL",
    "KPI_SCHEMA",
    "archive",
    "areas_of_days",
    "await_stop",
    "batch_table",
    "compact_table",
    "daily_visits",
    "each_batch",
    "kpi_sink",
    "latest_kpis",
    "quarantine",
    "record_offsets",
    "refresh_visits",
    "replace_table",
    "request_stop",
    "run_batches",
    "run_job",
    "run_kpis",
    "run_top_products",
    "run_views",
    "run_visitors",
    "stop_at",
    "traffic_by_day",
    "traffic_of_days",
    "write_batch",
]
