"""Reporting views over ``billing_summary``.

Each takes the priced lines and an ``as_of`` day and returns a lazy DataFrame; register
it with ``createOrReplaceTempView`` to query it by name. Row order is the caller's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.functions import SCOPE, Day, exact_mean, month_to_date, spend, trailing, week_of
from meterlens.operators.ranking import top_n
from meterlens.operators.tags import costs_per_tag
from meterlens.operators.trends import running_total

_DATE = "usage_date"
_PRODUCT = "billing_origin_product"


def _spend_by(lines: DataFrame, *dims: str | Column, extra: tuple[Column, ...] = ()) -> DataFrame:
    return lines.groupBy(*SCOPE, *dims).agg(*spend(), *extra)


def _product(lines: DataFrame, name: str) -> DataFrame:
    return lines.where(F.col(_PRODUCT) == name)


def v_current_month_spend(lines: DataFrame, *, as_of: Day = None) -> DataFrame:
    return _spend_by(
        month_to_date(lines, _DATE, as_of), _PRODUCT, "is_serverless", extra=(F.count("*").alias("record_count"),)
    )


def v_daily_spend_trend(lines: DataFrame, *, as_of: Day = None) -> DataFrame:
    """Daily spend per product with the workspace's running total; products of a day share it."""
    daily = _spend_by(trailing(lines, _DATE, 30, as_of), _DATE, _PRODUCT)
    return running_total(daily, SCOPE, _DATE, "total_cost_usd", "cumulative_cost_usd")


def v_serverless_comparison(lines: DataFrame, *, as_of: Day = None) -> DataFrame:
    return _spend_by(
        trailing(lines, _DATE, 90, as_of),
        week_of(_DATE).alias("week_start"),
        "is_serverless",
        _PRODUCT,
        extra=(F.count_distinct("job_id").alias("distinct_jobs"),),
    )


def v_top_expensive_jobs(lines: DataFrame, *, as_of: Day = None, n: int = 20) -> DataFrame:
    job = ["job_id", "job_name", "run_as"]
    facts = (
        F.count("*").alias("billing_records"),
        F.min(_DATE).alias("first_run"),
        F.max(_DATE).alias("last_run"),
    )
    costs = _spend_by(trailing(lines, _DATE, 30, as_of).where("job_id IS NOT NULL"), *job, extra=facts)
    return top_n(costs, SCOPE, "total_cost_usd", n, tiebreak=job)


def v_cost_by_tags(lines: DataFrame, *, as_of: Day = None) -> DataFrame:
    return costs_per_tag(lines, as_of=as_of)


def v_warehouse_costs(lines: DataFrame) -> DataFrame:
    """All history. ``query_count`` counts billing records, not queries."""
    warehouses = _product(lines, "SQL").where("warehouse_id IS NOT NULL")
    return _spend_by(warehouses, "warehouse_id", _DATE, "sku_name", extra=(F.count("*").alias("query_count"),))


def v_model_serving_costs(lines: DataFrame, *, as_of: Day = None) -> DataFrame:
    return _spend_by(_product(trailing(lines, _DATE, 30, as_of), "MODEL_SERVING"), "endpoint_name", _DATE, "sku_name")


def v_dlt_pipeline_costs(lines: DataFrame, *, as_of: Day = None) -> DataFrame:
    return _spend_by(_product(trailing(lines, _DATE, 30, as_of), "DLT"), "dlt_pipeline_id", _DATE, "is_serverless")


def v_hourly_spend_pattern(lines: DataFrame, *, as_of: Day = None) -> DataFrame:
    """Cost by hour of the day and day of the week (1 = Sunday)."""
    hour, weekday = F.hour("usage_start_time"), F.dayofweek(_DATE)
    return (
        trailing(lines, _DATE, 30, as_of)
        .groupBy(*SCOPE, hour.alias("hour_of_day"), weekday.alias("day_of_week"), _PRODUCT)
        .agg(
            exact_mean("estimated_cost_usd").alias("avg_hourly_cost"),
            F.sum("estimated_cost_usd").alias("total_cost_usd"),
        )
    )


def v_notebook_costs(lines: DataFrame, *, as_of: Day = None) -> DataFrame:
    notebooks = _product(trailing(lines, _DATE, 30, as_of), "INTERACTIVE").where("notebook_id IS NOT NULL")
    return _spend_by(notebooks, "notebook_id", "notebook_path", "run_as", _DATE)
