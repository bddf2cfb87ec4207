"""Page views, visitors, product rankings and sales from web access logs, on Spark."""

from clickstream.functions import (
    between_times,
    identified,
    malformed,
    parse_log,
    recode,
    typed,
    valid,
)
from clickstream.operators import (
    area_distribution,
    areas_of,
    category_product_views,
    dedup_offsets,
    drop_replayed,
    kpi_values,
    offset_ranges,
    pv_uv,
    pv_uv_raw,
    pv_uv_raw_of,
    register_log,
    sales_between,
    sales_by_category,
    sales_by_day,
    sales_by_province,
    sales_today,
    starting_offsets_json,
    top_products,
    total_sales,
    traffic_report,
    visitor_provinces,
    visits,
    with_category,
)
from clickstream.plans import kafka_kpis, line_report, sql_report
from clickstream.schema import LOG, category_dim, log_schema
from clickstream.sources import (
    consumed_ranges,
    envelope,
    kafka_options,
    kafka_source,
    next_offsets,
    rate_cap,
    read_json,
    read_lines,
    register_tail,
    stream_lines,
)
from clickstream.streaming import (
    archive,
    areas_of_days,
    await_stop,
    batch_table,
    compact_table,
    daily_visits,
    each_batch,
    kpi_sink,
    latest_kpis,
    quarantine,
    record_offsets,
    refresh_visits,
    request_stop,
    run_batches,
    run_job,
    run_kpis,
    run_top_products,
    run_views,
    run_visitors,
    stop_at,
    traffic_by_day,
    traffic_of_days,
    write_batch,
)

__all__ = [
    "LOG",
    "archive",
    "area_distribution",
    "areas_of",
    "areas_of_days",
    "await_stop",
    "batch_table",
    "between_times",
    "category_dim",
    "category_product_views",
    "compact_table",
    "consumed_ranges",
    "daily_visits",
    "dedup_offsets",
    "drop_replayed",
    "each_batch",
    "envelope",
    "identified",
    "kafka_kpis",
    "kafka_options",
    "kafka_source",
    "kpi_sink",
    "kpi_values",
    "latest_kpis",
    "line_report",
    "log_schema",
    "malformed",
    "offset_ranges",
    "parse_log",
    "pv_uv",
    "pv_uv_raw",
    "pv_uv_raw_of",
    "quarantine",
    "next_offsets",
    "rate_cap",
    "read_json",
    "read_lines",
    "recode",
    "record_offsets",
    "refresh_visits",
    "register_log",
    "register_tail",
    "request_stop",
    "run_batches",
    "run_job",
    "run_kpis",
    "run_top_products",
    "run_views",
    "run_visitors",
    "sales_between",
    "sales_by_category",
    "sales_by_day",
    "sales_by_province",
    "sales_today",
    "sql_report",
    "starting_offsets_json",
    "stop_at",
    "stream_lines",
    "top_products",
    "total_sales",
    "traffic_by_day",
    "traffic_of_days",
    "traffic_report",
    "typed",
    "valid",
    "visitor_provinces",
    "visits",
    "with_category",
    "write_batch",
]
