"""Parametric DataFrame operators; the datasets and reports are built from these."""

from meterlens.operators.changes import change_feed
from meterlens.operators.compare import period_compare
from meterlens.operators.consolidate import consolidate
from meterlens.operators.current_state import extract_current_scd2, latest_by
from meterlens.operators.joins import lookup_join
from meterlens.operators.pivots import pivot_columns, pivot_sum
from meterlens.operators.ranking import top_n
from meterlens.operators.recipes import aggregate_by_day, basic_agg, entity_scorecard, filtered_view, with_costs
from meterlens.operators.tags import TAG_KEYS, costs_per_tag, tag_costs
from meterlens.operators.trends import rolling_avg, running_total, zscore_anomalies

__all__ = [
    "TAG_KEYS",
    "aggregate_by_day",
    "basic_agg",
    "change_feed",
    "consolidate",
    "costs_per_tag",
    "entity_scorecard",
    "extract_current_scd2",
    "filtered_view",
    "latest_by",
    "lookup_join",
    "period_compare",
    "pivot_columns",
    "pivot_sum",
    "rolling_avg",
    "running_total",
    "tag_costs",
    "top_n",
    "with_costs",
    "zscore_anomalies",
]
