"""User activity and data access from audit events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.functions import SCOPE

# The catalog service and its table actions, as they appear in audit events.
CATALOG_SERVICE = "unityCatalog"
TABLE_ACTIONS = ["getTable", "createTable", "deleteTable"]


def user_activity_summary(audit: DataFrame) -> DataFrame:
    """Daily events per user and service.

    Counted per action first; the distinct action count then needs no second pass
    over the events.
    """
    user_day = [*SCOPE, "event_date", "user_email", "service_name"]
    per_action = (
        audit.withColumn("user_email", F.col("user_identity.email"))
        .where("user_email IS NOT NULL")
        .groupBy(*user_day, "action_name")
        .agg(F.count("*").alias("events"), F.min("event_time").alias("first"), F.max("event_time").alias("last"))
    )
    return per_action.groupBy(*user_day).agg(
        F.sum("events").alias("event_count"),
        F.count("action_name").alias("distinct_actions"),
        F.min("first").alias("first_activity"),
        F.max("last").alias("last_activity"),
    )


def data_access_summary(audit: DataFrame) -> DataFrame:
    """Daily table accesses per user, action and table."""
    accesses = audit.where((F.col("service_name") == CATALOG_SERVICE) & F.col("action_name").isin(TABLE_ACTIONS))
    return accesses.groupBy(
        *SCOPE,
        "event_date",
        F.col("user_identity.email").alias("user_email"),
        "action_name",
        F.element_at("request_params", F.lit("full_name_arg")).alias("table_full_name"),
    ).agg(
        F.count("*").alias("access_count"),
        F.min("event_time").alias("first_access"),
        F.max("event_time").alias("last_access"),
    )


def events_by_action(audit: DataFrame, fragment: str, *, newest: int = 100) -> DataFrame:
    """The newest events whose action name contains ``fragment``."""
    ties = [F.col(c) for c in (*SCOPE, "action_name", "service_name")]
    return audit.where(F.col("action_name").contains(fragment)).orderBy(F.desc("event_time"), *ties).limit(newest)


def recipient_events(audit: DataFrame) -> DataFrame:
    """The newest 100 events on share recipients."""
    return events_by_action(audit, "recipient")


def daily_actions(audit: DataFrame) -> DataFrame:
    """How many events of each action a date has."""
    return audit.groupBy("event_date", "action_name").agg(F.count("*").alias("event_count"))


def dates_of_newest(actions: DataFrame, fragment: str, newest: int = 100) -> list[dt.date | None]:
    """The newest dates that together hold ``newest`` events (or all) whose action name contains ``fragment``.

    ``actions`` are ``daily_actions``. Each date has such an event, so there are at most
    ``newest``. Rows without a date come last, None.
    """
    matching = actions.where(F.col("action_name").contains(fragment)).groupBy("event_date").agg(F.sum("event_count").alias("events"))
    dates, found = [], 0
    for row in matching.orderBy(F.desc_nulls_last("event_date")).limit(newest).collect():
        if found >= newest:
            break
        dates.append(row["event_date"])
        found += row["events"]
    return dates
