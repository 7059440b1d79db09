"""The registered queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.plans import events, star, streams

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        star.revenue_by_region_year,
        star.line_counts_cube,
        star.orders_without_lines,
        star.duplicate_line_keys,
        star.top_customers_per_nation,
        star.monthly_revenue_trend,
        star.orders_priority_by_status,
        star.price_quantiles,
        star.nations_without_poor_suppliers,
        events.events_hourly,
        events.events_sliding,
        events.user_sessions,
        events.overlapping_sessions,
        events.peak_open_sessions,
        events.weekly_active_users,
        events.funnel_view_signup_purchase,
        events.last_view_before_purchase,
        events.json_prop_totals,
        events.latest_event_per_user,
        star.orders_by_year_sink,
        star.order_value_percentiles,
        streams.stream_events_hourly,
        streams.stream_user_sessions,
        streams.stream_dedup,
        streams.stream_view_to_purchase,
        streams.stream_inactive_users,
        streams.stream_revenue_upserts,
    )
}
