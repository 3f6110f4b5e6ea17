"""Reporting views over the serving, tracking and AI/ML spend datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.functions import SCOPE, Day, day_of, days_before, percent, ratio, sum_if, trailing
from meterlens.functions.measures import respend
from meterlens.operators.compare import period_compare
from meterlens.operators.pivots import pivot_sum
from meterlens.operators.trends import running_total
from meterlens.plans.ml_spend import aiml_spend_over_period

_DATE = "usage_date"
_TOKENS = ["total_input_tokens", "total_output_tokens", "total_tokens"]


def _sums(columns: dict[str, str] | list[str]):
    names = columns if isinstance(columns, dict) else {c: c for c in columns}
    return [F.sum(src).alias(out) for out, src in names.items()]


def _activity():
    return [
        F.count_distinct(_DATE).alias("active_days"),
        F.min(_DATE).alias("first_usage"),
        F.max(_DATE).alias("last_usage"),
    ]


def v_model_serving_cost_summary(model_serving_costs: DataFrame, *, as_of: Day = None) -> DataFrame:
    recent = trailing(model_serving_costs, _DATE, 30, as_of)
    return recent.groupBy(*SCOPE, "endpoint_name", "entity_type", "entity_name").agg(*respend(), *_activity())


def v_foundation_model_leaderboard(foundation_model_usage: DataFrame, *, as_of: Day = None) -> DataFrame:
    """Tokens and requests per model over the last 30 days, and how widely it is used."""
    model = [*SCOPE[:2], "entity_name"]
    per_endpoint = (
        trailing(foundation_model_usage, _DATE, 30, as_of)
        .groupBy(*model, "workspace_id", "endpoint_name")
        .agg(*_sums(_TOKENS), F.sum("request_count").alias("total_requests"))
    )
    return per_endpoint.groupBy(*model).agg(
        *_sums([*_TOKENS, "total_requests"]),
        F.count_distinct("workspace_id").alias("workspaces_using"),
        F.count_distinct("endpoint_name").alias("endpoints_using"),
    )


def v_external_model_summary(external_model_usage: DataFrame, *, as_of: Day = None) -> DataFrame:
    totals = (
        trailing(external_model_usage, _DATE, 30, as_of)
        .groupBy(*SCOPE, "entity_name", "endpoint_name")
        .agg(*_sums(_TOKENS), F.sum("request_count").alias("total_requests"))
    )
    return totals.withColumn("output_input_ratio", F.round(ratio("total_output_tokens", "total_input_tokens"), 2))


def v_endpoint_daily_pattern(endpoint_usage_summary: DataFrame, *, as_of: Day = None) -> DataFrame:
    """Daily tokens and requests per endpoint with the day of the week (1 = Sunday); no lineage columns."""
    renamed = {
        "total_tokens": "total_tokens",
        "total_requests": "request_count",
        "input_tokens": "total_input_tokens",
        "output_tokens": "total_output_tokens",
    }
    recent = trailing(endpoint_usage_summary, _DATE, 30, as_of)
    daily = recent.groupBy("workspace_id", "endpoint_name", _DATE).agg(*_sums(renamed))
    return daily.withColumn("day_of_week", F.dayofweek(_DATE))


def v_inactive_endpoints(endpoint_inventory: DataFrame, *, as_of: Day = None) -> DataFrame:
    """Endpoints not billed in the last 7 days, or never.

    To replay a past ``as_of``, build the inventory from costs up to that day.
    """
    last = F.col("last_billing_date")
    silent = last.isNull() | (last < days_before(as_of, 7))
    return endpoint_inventory.where(silent).withColumn("days_since_last_billing", F.date_diff(day_of(as_of), last))


def _experiment_report(experiments_summary: DataFrame, *columns) -> DataFrame:
    ran = experiments_summary.where("total_runs > 0")
    return ran.select(*SCOPE, "experiment_id", F.col("name").alias("experiment_name"), *columns)


def v_mlflow_experiment_activity(experiments_summary: DataFrame, *, as_of: Day = None) -> DataFrame:
    return _experiment_report(
        experiments_summary,
        "lifecycle_stage",
        "total_runs",
        "successful_runs",
        "failed_runs",
        percent("successful_runs", "total_runs").alias("success_rate_pct"),
        "distinct_users",
        "first_run",
        "last_run",
        F.date_diff(day_of(as_of), F.to_date("last_run")).alias("days_since_last_run"),
    )


def v_mlflow_daily_activity(
    mlflow_runs_summary: DataFrame, *, as_of: Day = None, runs: DataFrame | None = None
) -> DataFrame:
    """Daily runs, outcomes and hours.

    ``distinct_users`` adds up per-experiment counts, so a person in two experiments
    counts twice; pass the tracked ``runs`` to count each person once a day.
    """
    recent = trailing(mlflow_runs_summary, "run_date", 30, as_of)
    daily = recent.groupBy(*SCOPE, "run_date").agg(
        F.sum("run_count").alias("total_runs"),
        sum_if(F.col("status") == "FINISHED", "run_count").alias("successful_runs"),
        sum_if(F.col("status") == "FAILED", "run_count").alias("failed_runs"),
        F.sum("distinct_users").alias("distinct_users"),
        F.round(F.avg("avg_duration_seconds"), 2).alias("avg_duration_seconds"),
        F.round(F.sum("total_compute_seconds") / F.lit(3600.0), 2).alias("total_compute_hours"),
    )
    if runs is None:
        return daily
    people = (
        trailing(runs.withColumn("run_date", F.to_date("start_time")), "run_date", 30, as_of)
        .groupBy(*SCOPE, "run_date")
        .agg(F.count_distinct("created_by").alias("distinct_users"))
    )
    return daily.drop("distinct_users").join(people, [*SCOPE, "run_date"], "left")


def v_top_experimenters(experiments_summary: DataFrame, *, as_of: Day = None, n: int = 50) -> DataFrame:
    """The experiments with the most runs among those that ran in the last 30 days."""
    recent = experiments_summary.where(F.col("last_run") >= days_before(as_of, 30))
    report = _experiment_report(
        recent,
        "total_runs",
        "successful_runs",
        "distinct_users",
        percent("successful_runs", "total_runs").alias("success_rate_pct"),
        "last_run",
    )
    return report.orderBy(F.desc("total_runs"), *SCOPE, "experiment_id").limit(n)


def v_vector_search_by_endpoint(vector_search_costs: DataFrame, *, as_of: Day = None) -> DataFrame:
    recent = trailing(vector_search_costs, _DATE, 30, as_of)
    return recent.groupBy(*SCOPE, "endpoint_name").agg(*respend(), *_activity())


def v_vector_search_daily_trend(vector_search_summary: DataFrame, *, as_of: Day = None) -> DataFrame:
    recent = trailing(vector_search_summary, _DATE, 30, as_of).select(
        *SCOPE, _DATE, "total_dbus", "total_cost_usd", "distinct_endpoints"
    )
    return running_total(recent, SCOPE, _DATE, "total_cost_usd", "cumulative_cost_usd")


def v_aiml_spend_by_category(
    aiml_executive_summary: DataFrame | None = None, *, as_of: Day = None, lines: DataFrame | None = None
) -> DataFrame:
    """AI/ML spend of the last 30 days by category.

    Endpoints and users are sums of daily distinct counts; from the priced ``lines``
    instead of the daily summary each counts once.
    """
    counts = {"total_endpoints": "distinct_endpoints", "total_users": "distinct_users"}
    if lines is not None:
        over_period = aiml_spend_over_period(trailing(lines, _DATE, 30, as_of))
        return over_period.withColumnsRenamed({src: out for out, src in counts.items()})
    recent = trailing(aiml_executive_summary, _DATE, 30, as_of)
    return recent.groupBy(*SCOPE, "aiml_category", "billing_origin_product").agg(*respend(), *_sums(counts))


def v_aiml_daily_trend(aiml_executive_summary: DataFrame, *, as_of: Day = None) -> DataFrame:
    categories = {
        "inference_cost": "Inference",
        "vector_search_cost": "Vector Search",
        "feature_serving_cost": "Feature Serving",
        "finetuning_cost": "Fine-tuning",
    }
    recent = trailing(aiml_executive_summary, _DATE, 30, as_of)
    return pivot_sum(recent, [*SCOPE, _DATE], "aiml_category", categories, "total_cost_usd", total_col="total_cost_usd")


def v_aiml_wow_comparison(aiml_executive_summary: DataFrame, *, as_of: Day = None) -> DataFrame:
    return period_compare(
        aiml_executive_summary,
        [*SCOPE, "aiml_category"],
        "total_cost_usd",
        as_of=as_of,
        current_col="this_week_cost",
        previous_col="last_week_cost",
        percent_col="change_pct",
    )


def v_aiml_complete_inventory(endpoint_inventory: DataFrame, experiments_summary: DataFrame) -> DataFrame:
    """Endpoints and experiments with runs, in one shape."""
    shape = ["resource_type", "resource_name", "resource_subtype", "model_name", "cost_30d", "last_updated"]
    endpoints = endpoint_inventory.withColumn("resource_type", F.lit("Model Serving")).withColumnsRenamed(
        {
            "endpoint_name": "resource_name",
            "entity_type": "resource_subtype",
            "entity_name": "model_name",
            "total_cost_usd_30d": "cost_30d",
            "change_time": "last_updated",
        }
    )
    experiments = (
        experiments_summary.where("total_runs > 0")
        .withColumn("resource_type", F.lit("MLflow Experiment"))
        .withColumnsRenamed(
            {"name": "resource_name", "lifecycle_stage": "resource_subtype", "last_update_time": "last_updated"}
        )
    )
    common = [c for c in shape if c not in ("model_name", "cost_30d")]
    return endpoints.select(*SCOPE, *shape).unionByName(
        experiments.select(*SCOPE, *common), allowMissingColumns=True
    )
