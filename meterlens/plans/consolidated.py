"""Analytics over the datasets of several providers, united by ``consolidate``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.functions import SCOPE, Day, between_days, month_of, sum_if, trailing, up_to
from meterlens.operators.pivots import pivot_sum

# Consolidated dataset and the dataset each provider contributes.
CONSOLIDATED = {
    "all_billing_summary": "billing_summary",
    "all_cost_by_product": "cost_by_product",
    "all_job_runs": "job_runs_summary",
    "all_endpoint_usage": "endpoint_usage_summary",
    "all_mlflow_experiments": "mlflow_experiments_summary",
    "all_executive_summary": "executive_summary",
    "all_aiml_summary": "aiml_executive_summary",
    "all_model_serving_costs": "model_serving_costs",
}


def monthly_spend_by_account(all_cost_by_product: DataFrame, *, as_of: Day = None) -> DataFrame:
    bounded = all_cost_by_product if as_of is None else up_to(all_cost_by_product, "usage_date", as_of)
    return bounded.groupBy("source", SCOPE[0], month_of("usage_date").alias("month")).agg(
        F.sum("total_cost_usd").alias("total_cost_usd"), F.sum("total_dbus").alias("total_dbus")
    )


def account_comparison(all_cost_by_product: DataFrame, *, as_of: Day = None) -> DataFrame:
    """Cost of the last 7, 30 and 90 days per provider and product."""
    recent = trailing(all_cost_by_product, "usage_date", 90, as_of)
    last = lambda days: sum_if(between_days("usage_date", as_of, days, 0), "total_cost_usd")
    return recent.groupBy("source", *SCOPE[:2], "billing_origin_product").agg(
        last(7).alias("last_7d_cost"), last(30).alias("last_30d_cost"), F.sum("total_cost_usd").alias("total_cost_usd")
    )


def aiml_spend_comparison(all_aiml_summary: DataFrame, all_endpoint_usage: DataFrame, *, as_of: Day = None) -> DataFrame:
    """Daily AI/ML cost of the last 30 days per provider workspace with its request count.

    Costs are the summary's categories pivoted; requests come from endpoint usage and
    are NULL on a day without any.
    """
    day = ["source", *SCOPE[:2], "summary_date"]
    costs = pivot_sum(
        trailing(all_aiml_summary, "usage_date", 30, as_of).withColumnRenamed("usage_date", "summary_date"),
        day,
        "aiml_category",
        {"model_serving_cost": "Inference", "vector_search_cost": "Vector Search"},
        "total_cost_usd",
        total_col="total_aiml_cost",
    )
    requests = (
        trailing(all_endpoint_usage, "usage_date", 30, as_of)
        .withColumnRenamed("usage_date", "summary_date")
        .groupBy(*day)
        .agg(F.sum("request_count").alias("total_requests"))
    )
    return costs.join(requests, day, "left")
