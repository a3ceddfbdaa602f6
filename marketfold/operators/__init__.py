"""Reports as functions from DataFrame to DataFrame."""

from marketfold.operators.franchise import (
    franchise_analytics,
    franchise_footprint,
    size_by_country,
)
from marketfold.operators.quality import table_profile
from marketfold.operators.sales import (
    customer_360,
    customer_geo,
    payment_breakdown,
    product_revenue,
    revenue_by_country,
    transaction_summary,
)
from marketfold.operators.trips import (
    add_derived_columns,
    add_rolling_revenue,
    clean_trips,
    compute_daily_zone_stats,
    compute_hourly_revenue,
    compute_pickup_zone_revenue,
    retention_report,
)

__all__ = [
    "add_derived_columns",
    "add_rolling_revenue",
    "clean_trips",
    "compute_daily_zone_stats",
    "compute_hourly_revenue",
    "compute_pickup_zone_revenue",
    "customer_360",
    "customer_geo",
    "franchise_analytics",
    "franchise_footprint",
    "payment_breakdown",
    "product_revenue",
    "retention_report",
    "revenue_by_country",
    "size_by_country",
    "table_profile",
    "transaction_summary",
]
