"""Cost attribution by custom tags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.functions import SCOPE, Day, spend, trailing

# The tag keys attributed by default.
TAG_KEYS = ["cost_center", "team", "project", "environment"]


def tag_costs(lines: DataFrame, keys: Sequence[str] = TAG_KEYS, *, as_of: Day, days: int = 30) -> DataFrame:
    """Daily cost by the values of the given tag keys; NULL where a row lacks the key."""
    tagged = trailing(lines, "usage_date", days, as_of).where(F.col("custom_tags").isNotNull())
    return tagged.groupBy(*SCOPE, "usage_date", *[F.element_at("custom_tags", F.lit(k)).alias(k) for k in keys]).agg(*spend())


def costs_per_tag(lines: DataFrame, *, as_of: Day, days: int = 30) -> DataFrame:
    """Daily cost per (key, value) pair; a row with two tags counts under both."""
    tagged = trailing(lines, "usage_date", days, as_of).where(F.size("custom_tags") > 0)
    return (
        tagged.select(*SCOPE, "usage_date", F.explode("custom_tags").alias("tag_key", "tag_value"), "usage_quantity", "estimated_cost_usd")
        .groupBy(*SCOPE, "usage_date", "tag_key", "tag_value")
        .agg(*spend())
    )
