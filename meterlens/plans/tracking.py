"""ML experiment and run tracking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.functions import SCOPE, seconds_between
from meterlens.operators.current_state import latest_by
from meterlens.operators.partials import Partials


def latest_experiments(experiments: DataFrame) -> DataFrame:
    """One row per experiment from a feed that holds several versions of it."""
    return latest_by(experiments, ["workspace_id", "experiment_id"], "update_time", ["delete_time", "name"])


RUN_KEY = ["workspace_id", "run_id"]


def latest_runs(runs: DataFrame) -> DataFrame:
    """One row per run from a feed that holds several versions of it."""
    return latest_by(runs, RUN_KEY, "update_time", ["end_time", "status"])


#: What is known of an experiment's runs. One state for each creator bounds the work of the distinct count.
RUN_STATS = Partials(
    keys=["experiment_id"],
    sums={
        "total_runs": "1L",
        "successful_runs": "IF(status = 'FINISHED', 1L, 0L)",
        "failed_runs": "IF(status = 'FAILED', 1L, 0L)",
    },
    lowest={"first_run": "start_time"},
    highest={"last_run": "start_time"},
    member="created_by",
    members="distinct_users",
)


def daily_run_states(runs: DataFrame) -> DataFrame:
    """The states of each date's runs, to be merged later."""
    return RUN_STATS.states(runs.withColumn("run_date", F.to_date("start_time")), "run_date")


def with_run_stats(experiments: DataFrame, run_states: DataFrame) -> DataFrame:
    """Every experiment with the counts, first and last start and distinct creators of its runs.

    Runs are matched on the experiment id alone.
    """
    or_zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return experiments.join(RUN_STATS.merge(run_states), "experiment_id", "left").select(
        *SCOPE,
        "experiment_id",
        "name",
        F.col("create_time").alias("creation_time"),
        F.col("update_time").alias("last_update_time"),
        F.when(F.col("delete_time").isNull(), "active").otherwise("deleted").alias("lifecycle_stage"),
        *[or_zero(c) for c in RUN_STATS.sums],
        "first_run",
        "last_run",
        or_zero("distinct_users"),
    )


def mlflow_experiments_summary(experiments: DataFrame, runs: DataFrame) -> DataFrame:
    """``with_run_stats`` straight from the runs."""
    return with_run_stats(experiments, RUN_STATS.states(runs))


def mlflow_runs_summary(runs: DataFrame) -> DataFrame:
    """Daily runs per experiment and status; durations skip runs that are still open."""
    seconds = seconds_between("start_time", "end_time")
    group = [*SCOPE, "run_date", "experiment_id", "status"]
    per_user = (
        runs.withColumns({"run_date": F.to_date("start_time"), "seconds": seconds})
        .groupBy(*group, "created_by")
        .agg(F.count("*").alias("runs"), F.count("seconds").alias("closed"), F.sum("seconds").alias("seconds"))
    )
    total = F.sum("seconds")
    return per_user.groupBy(*group).agg(
        F.sum("runs").alias("run_count"),
        F.count("created_by").alias("distinct_users"),
        (total.cast("double") / F.nullif(F.sum("closed"), F.lit(0))).alias("avg_duration_seconds"),
        total.alias("total_compute_seconds"),
    )
