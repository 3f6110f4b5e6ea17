"""Parametric recipes for adding datasets and reports of one's own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.functions import SCOPE, Day, percent, ratio, trailing
from meterlens.functions.measures import respend
from meterlens.operators.joins import lookup_join


def basic_agg(daily: DataFrame, *dims: str, as_of: Day, days: int = 30) -> DataFrame:
    """Daily totals of a cost dataset over the trailing days."""
    recent = trailing(daily, "usage_date", days, as_of)
    return recent.groupBy(*SCOPE, "usage_date", *dims).agg(*respend(), F.count("*").alias("record_count"))


def aggregate_by_day(df: DataFrame, timestamp_col: str, metric: str, dims: Sequence[str] = ()) -> DataFrame:
    """Count, sum and mean of a metric per day, with the last time seen."""
    return df.groupBy(*SCOPE, F.to_date(timestamp_col).alias("date"), *dims).agg(
        F.count("*").alias("record_count"),
        F.sum(metric).alias("total_metric"),
        F.avg(metric).alias("avg_metric"),
        F.max(timestamp_col).alias("last_seen"),
    )


def with_costs(
    df: DataFrame,
    lines: DataFrame,
    on: Sequence[str] = ("workspace_id", "job_id"),
    *,
    store_at: str | None = None,
    salted: bool = False,
) -> DataFrame:
    """Attach cost to any feed by ids; rows without cost stay, with NULL.

    Billing is first summed to one row per key and day, so a feed row meets at most
    one row per billed day and no group is paired row by row. Put ``usage_date`` in
    ``on`` for a feed that has it, and the join keeps the feed's row count. ``store_at``
    writes the sums to that folder first: Spark then knows their size before the join
    and broadcasts them if they are small. ``salted`` splits heavy keys without adaptive
    execution, for sums small enough to be copied: see ``lookup_join``.
    """
    per_day = dict.fromkeys([*on, "usage_date"])
    costs = (
        lines.groupBy(*per_day)
        .agg(F.sum("estimated_cost_usd").alias("estimated_cost_usd"))
        .withColumnsRenamed({k: f"_cost_{k}" for k in on})
    )
    if store_at is not None:
        costs.write.parquet(store_at)
        costs = df.sparkSession.read.schema(costs.schema).parquet(store_at)
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return lookup_join(df, costs, {k: f"_cost_{k}" for k in on}, salt_on=plain if salted else ())


def filtered_view(df: DataFrame, condition: Column, columns: Sequence[str] = ()) -> DataFrame:
    """A focused subset: lineage columns plus the chosen ones, where the condition holds."""
    return df.where(condition).select(*SCOPE, *columns)


def entity_scorecard(
    jobs: DataFrame, runs: DataFrame, costs: DataFrame, *, as_of: Day, days: int = 30
) -> DataFrame:
    """Each current job with its run statistics and cost of the trailing days.

    Takes ``jobs_current``, ``job_runs_summary`` and ``cost_by_job``. Both sides are
    reduced to one row per job before they are joined.
    """
    job = ["workspace_id", "job_id"]
    run_stats = (
        trailing(runs, "run_date", days, as_of)
        .groupBy(*job)
        .agg(
            *[F.sum(c).alias(c) for c in ("total_runs", "successful_runs", "failed_runs")],
            F.avg("avg_duration_seconds").alias("avg_duration_seconds"),
        )
    )
    job_costs = trailing(costs, "usage_date", days, as_of).groupBy(*job).agg(*respend())
    return (
        jobs.select(*job, F.col("name").alias("job_name"), "run_as")
        .join(run_stats, job, "left")
        .join(job_costs, job, "left")
        .withColumns(
            {
                "cost_per_run": F.round(ratio("total_cost_usd", "total_runs"), 2),
                "success_rate_pct": percent("successful_runs", "total_runs"),
            }
        )
    )
