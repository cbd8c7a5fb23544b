"""Operators: functions from DataFrames to a DataFrame."""

from tallywork.operators.access import (
    country_revenue,
    has_rows,
    keyset_page,
    lateral_top_n,
    matching_either,
    offset_page,
    orders_per_user,
    orders_per_user_correlated,
    rows_on_day,
    union_or,
)
from tallywork.operators.chunks import process_in_chunks
from tallywork.operators.cohorts import (
    cohort_retention,
    cohort_retention_range,
    cohort_retention_wide,
    cohort_revenue,
)
from tallywork.operators.funnels import (
    funnel,
    funnel_by_segment,
    funnel_dropoff,
    funnel_metrics,
    time_to_convert,
)
from tallywork.operators.hierarchy import traverse_hierarchy
from tallywork.operators.histories import ranks_per_user, user_event_fill, user_moving_metrics
from tallywork.operators.quality import (
    check_constraints,
    dedup_latest,
    duplicate_audit,
    email_variants,
    table_counts,
)
from tallywork.operators.recurring import churn_nrr, mrr_movements
from tallywork.operators.revenue import latest, ltv_by_segment, order_revenue, revenue_summary
from tallywork.operators.rollups import daily_cells, summaries_of_cells, summary_of_cells
from tallywork.operators.timeseries import (
    date_spine_fill,
    gap_fill,
    period_over_period,
    rolling_activity,
    sessionize,
)
from tallywork.operators.windows import (
    first_last_compare,
    nth_per_group,
    period_growth,
    rank_orders,
    running_metrics,
    top_n_per_group,
)

__all__ = [
    "check_constraints",
    "churn_nrr",
    "cohort_retention",
    "cohort_retention_range",
    "cohort_retention_wide",
    "cohort_revenue",
    "country_revenue",
    "daily_cells",
    "date_spine_fill",
    "dedup_latest",
    "duplicate_audit",
    "email_variants",
    "first_last_compare",
    "funnel",
    "funnel_by_segment",
    "funnel_dropoff",
    "funnel_metrics",
    "gap_fill",
    "has_rows",
    "keyset_page",
    "lateral_top_n",
    "latest",
    "ltv_by_segment",
    "matching_either",
    "mrr_movements",
    "nth_per_group",
    "offset_page",
    "order_revenue",
    "orders_per_user",
    "orders_per_user_correlated",
    "period_growth",
    "period_over_period",
    "process_in_chunks",
    "rank_orders",
    "ranks_per_user",
    "revenue_summary",
    "rolling_activity",
    "rows_on_day",
    "running_metrics",
    "sessionize",
    "summaries_of_cells",
    "summary_of_cells",
    "table_counts",
    "time_to_convert",
    "top_n_per_group",
    "traverse_hierarchy",
    "union_or",
    "user_event_fill",
    "user_moving_metrics",
]
