from clickstream.operators.offsets import dedup_offsets, offset_ranges, starting_offsets_json
from clickstream.operators.ranking import category_product_views, top_products, with_category
from clickstream.operators.replays import drop_replayed
from clickstream.operators.sales import (
    kpi_values,
    sales_between,
    sales_by_category,
    sales_by_day,
    sales_by_province,
    sales_today,
    total_sales,
)
from clickstream.operators.traffic import (
    area_distribution,
    areas_of,
    pv_uv,
    pv_uv_raw,
    pv_uv_raw_of,
    register_log,
    traffic_report,
    visitor_provinces,
    visits,
)

__all__ = [
    "area_distribution",
    "areas_of",
    "category_product_views",
    "dedup_offsets",
    "drop_replayed",
    "kpi_values",
    "offset_ranges",
    "pv_uv",
    "pv_uv_raw",
    "pv_uv_raw_of",
    "register_log",
    "sales_between",
    "sales_by_category",
    "sales_by_day",
    "sales_by_province",
    "sales_today",
    "starting_offsets_json",
    "top_products",
    "total_sales",
    "traffic_report",
    "visitor_provinces",
    "visits",
    "with_category",
]
