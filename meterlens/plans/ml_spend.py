"""Vector-search and combined AI/ML spend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.functions import SCOPE, spend
from meterlens.functions.measures import respend

# AI/ML products and the category each reports under.
CATEGORIES = {
    "MODEL_SERVING": "Inference",
    "VECTOR_SEARCH": "Vector Search",
    "ONLINE_TABLES": "Feature Serving",
    "FOUNDATION_MODEL_TRAINING": "Fine-tuning",
}


def vector_search_costs(lines: DataFrame) -> DataFrame:
    searches = lines.where("billing_origin_product = 'VECTOR_SEARCH'")
    return searches.groupBy(*SCOPE, "usage_date", "endpoint_name", "sku_name").agg(
        *spend(), F.count("*").alias("billing_records")
    )


def vector_search_summary(vector_search_costs: DataFrame) -> DataFrame:
    """Daily totals with the distinct endpoints, counted and listed in name order."""
    names = F.sort_array(F.collect_set("endpoint_name"))
    return vector_search_costs.groupBy(*SCOPE, "usage_date").agg(
        *respend(), F.size(names).cast("bigint").alias("distinct_endpoints"), names.alias("endpoint_names")
    )


def _aiml_spend(lines: DataFrame, group: list[str]) -> DataFrame:
    """AI/ML spend per group with distinct endpoints and users, labelled by category.

    Lines are first summed per endpoint and user; the two distinct counts, which make
    Spark expand every row several times, then see only those sums.
    """
    pairs = (
        lines.where(F.col("billing_origin_product").isin(list(CATEGORIES)))
        .groupBy(*group, "endpoint_name", "run_as")
        .agg(*spend())
    )
    category = F.lit("Other AI/ML")
    for product, name in CATEGORIES.items():
        category = F.when(F.col("billing_origin_product") == product, name).otherwise(category)
    return (
        pairs.groupBy(*group)
        .agg(
            *respend(),
            F.count_distinct("endpoint_name").alias("distinct_endpoints"),
            F.count_distinct("run_as").alias("distinct_users"),
        )
        .withColumn("aiml_category", category)
    )


def aiml_executive_summary(lines: DataFrame) -> DataFrame:
    """Daily AI/ML spend per product."""
    return _aiml_spend(lines, [*SCOPE, "usage_date", "billing_origin_product"])


def aiml_spend_over_period(lines: DataFrame) -> DataFrame:
    """AI/ML spend per product over all the lines given; an endpoint or user counts once, not once a day."""
    return _aiml_spend(lines, [*SCOPE, "billing_origin_product"])
