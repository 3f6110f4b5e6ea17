"""Daily rollups: weekly and monthly cost, trends, anomalies, top consumers, active users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.functions import SCOPE, Day, month_of, percent, trailing, week_of
from meterlens.functions.measures import respend
from meterlens.operators.ranking import top_n
from meterlens.operators.trends import rolling_avg, zscore_anomalies

_JOB = [*SCOPE, "job_id"]


def _cost_per_period(cost_by_product: DataFrame, period: Column, name: str) -> DataFrame:
    return cost_by_product.groupBy(*SCOPE, period.alias(name), "billing_origin_product").agg(
        *respend(), F.sum("record_count").alias("record_count")
    )


def cost_weekly_rollup(cost_by_product: DataFrame) -> DataFrame:
    return _cost_per_period(cost_by_product, week_of("usage_date"), "week_start")


def cost_monthly_rollup(cost_by_product: DataFrame) -> DataFrame:
    return _cost_per_period(cost_by_product, month_of("usage_date"), "month_start")


def job_performance_trends(job_runs_summary: DataFrame, *, as_of: Day = None, by_days: bool = False) -> DataFrame:
    """Daily job metrics of the last 30 days with their 7-row moving averages."""
    daily = trailing(job_runs_summary, "run_date", 30, as_of).select(
        *_JOB,
        "job_name",
        "run_date",
        "total_runs",
        "successful_runs",
        "failed_runs",
        "avg_duration_seconds",
        "p95_duration_seconds",
        percent("successful_runs", "total_runs").alias("success_rate_pct"),
    )
    smoothed = {"ma7_avg_duration": "avg_duration_seconds", "ma7_success_rate": "success_rate_pct"}
    return rolling_avg(daily, _JOB, "run_date", smoothed, 7, by_days=by_days)


def cost_anomalies(cost_by_product: DataFrame, *, as_of: Day = None, by_days: bool = False) -> DataFrame:
    """Workspace days of the last 60 whose cost is far from that of the days before."""
    daily = (
        trailing(cost_by_product, "usage_date", 60, as_of)
        .groupBy(*SCOPE, "usage_date")
        .agg(F.sum("total_cost_usd").alias("daily_cost"))
    )
    return zscore_anomalies(
        daily,
        SCOPE,
        "usage_date",
        "daily_cost",
        mean_col="ma30_cost",
        stddev_col="stddev30_cost",
        label_col="anomaly_type",
        labels=("HIGH_SPEND", "LOW_SPEND", "NORMAL"),
        digits=2,
        by_days=by_days,
    )


def top_consumers_30d(cost_by_job: DataFrame, *, as_of: Day = None, n: int = 50) -> DataFrame:
    """The costliest jobs per workspace over the last 30 days."""
    consumer = ["job_id", "job_name", "run_as"]
    totals = (
        trailing(cost_by_job, "usage_date", 30, as_of)
        .groupBy(*SCOPE, *consumer)
        .agg(*respend(), F.sum("run_count").alias("total_runs"))
    )
    return top_n(totals, SCOPE, "total_cost_usd", n, tiebreak=consumer)


def user_activity_30d(user_activity_summary: DataFrame, *, as_of: Day = None) -> DataFrame:
    """Active days, events and services per user over the last 30 days."""
    recent = trailing(user_activity_summary, "event_date", 30, as_of)
    return recent.groupBy(*SCOPE, "user_email").agg(
        F.count_distinct("event_date").alias("active_days"),
        F.sum("event_count").alias("total_events"),
        F.min("first_activity").alias("first_seen"),
        F.max("last_activity").alias("last_seen"),
        F.sort_array(F.collect_set("service_name")).alias("services_used"),
    )


def job_success_rate_weekly(job_runs_summary: DataFrame) -> DataFrame:
    """Weekly outcome counts and success rate per job.

    The publish list names this table; its definition is ours.
    """
    outcomes = ["total_runs", "successful_runs", "failed_runs", "canceled_runs"]
    weekly = job_runs_summary.groupBy(*_JOB, "job_name", week_of("run_date").alias("week_start")).agg(
        *[F.sum(c).alias(c) for c in outcomes]
    )
    return weekly.withColumn("success_rate_pct", percent("successful_runs", "total_runs"))


def cost_trend_analysis(cost_by_product: DataFrame, *, by_days: bool = False) -> DataFrame:
    """Daily workspace cost with its 7- and 30-row moving averages.

    The publish list names this table; its definition is ours.
    """
    daily = cost_by_product.groupBy(*SCOPE, "usage_date").agg(F.sum("total_cost_usd").alias("total_cost_usd"))
    for name, rows in {"cost_7d_rolling_avg": 7, "cost_30d_rolling_avg": 30}.items():
        daily = rolling_avg(daily, SCOPE, "usage_date", {name: "total_cost_usd"}, rows, by_days=by_days)
    return daily
