"""Job definitions and run reliability."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.functions import SCOPE, count_if, seconds_between
from meterlens.operators.current_state import extract_current_scd2


JOB_KEY = ["workspace_id", "job_id"]
#: What tells one run of a job from another.
RUN_KEY = [*SCOPE, "job_id", "run_id", "run_type"]


def jobs_current(jobs: DataFrame) -> DataFrame:
    return extract_current_scd2(jobs, JOB_KEY, tiebreak=["name"])


def merge_run_slices(slices: DataFrame) -> DataFrame:
    """One row per run from its hourly slices: whole period, final state of the latest slice."""
    return slices.groupBy(*RUN_KEY).agg(
        F.min("period_start_time").alias("period_start_time"),
        F.max("period_end_time").alias("period_end_time"),
        F.max(F.when(F.col("result_state").isNotNull(), F.struct("period_end_time", "result_state")))
        .getField("result_state")
        .alias("result_state"),
    )


def job_runs_daily(runs: DataFrame, *, merge_slices: bool = False) -> DataFrame:
    """Daily run counts by outcome and run durations per job.

    A run over an hour arrives as several slices; each counts as a run of its own
    unless ``merge_slices``.
    """
    scheduled = runs.where("run_type = 'JOB_RUN'")
    if merge_slices:
        scheduled = merge_run_slices(scheduled)
    seconds = seconds_between("period_start_time", "period_end_time")
    outcome = lambda state: count_if(F.col("result_state") == state)
    return (
        scheduled.withColumn("duration", seconds)
        .groupBy(*SCOPE, "job_id", F.to_date("period_start_time").alias("run_date"))
        .agg(
            F.count("*").alias("total_runs"),
            outcome("SUCCEEDED").alias("successful_runs"),
            outcome("FAILED").alias("failed_runs"),
            outcome("CANCELED").alias("canceled_runs"),
            F.avg("duration").alias("avg_duration_seconds"),
            F.max("duration").alias("max_duration_seconds"),
            F.min("duration").alias("min_duration_seconds"),
            F.percentile_approx("duration", 0.95).alias("p95_duration_seconds"),
        )
    )


def with_job_names(daily: DataFrame, jobs_current: DataFrame) -> DataFrame:
    """Add the current name; the left side has one row per job and day, so no key is hot."""
    names = jobs_current.select(*JOB_KEY, F.col("name").alias("job_name"))
    return daily.join(names, JOB_KEY, "left")


def job_runs_summary(runs: DataFrame, jobs_current: DataFrame, *, merge_slices: bool = False) -> DataFrame:
    """Daily run statistics with the job's current name."""
    return with_job_names(job_runs_daily(runs, merge_slices=merge_slices), jobs_current)
