"""Model serving: entities, token usage, costs and inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.functions import SCOPE, Day, spend, trailing
from meterlens.operators.current_state import extract_current_scd2, latest_by
from meterlens.operators.partials import Partials

# What marks a foundation model in entity types and endpoint names.
FOUNDATION_TYPES = ["FOUNDATION_MODEL_API", "FOUNDATION_MODEL"]
FOUNDATION_ENDPOINTS = "^databricks-(meta-llama|mixtral|dbrx|bge|gte|mpnet)"
FOUNDATION_PRODUCTS = ["MODEL_SERVING", "FOUNDATION_MODEL_TRAINING"]

ENTITY_KEY = ["workspace_id", "served_entity_id"]
#: What a served entity gives to the usage of its dates.
ENTITY_ATTRIBUTES = ["endpoint_id", "endpoint_name", "served_entity_name", "entity_type", "entity_name"]
ENDPOINT_KEY = ["workspace_id", "endpoint_name"]
ENDPOINT_ATTRIBUTES = ["entity_type", "entity_name"]
#: The cost of an endpoint and the last date that has some.
ENDPOINT_COSTS = Partials(keys=ENDPOINT_KEY, sums={"total_cost_usd_30d": "total_cost_usd"}, highest={"last_billing_date": "usage_date"})

_TOKENS = ["total_input_tokens", "total_output_tokens", "total_tokens", "request_count"]


def served_entities_current(served_entities: DataFrame) -> DataFrame:
    return extract_current_scd2(
        served_entities,
        ENTITY_KEY,
        delete_col="endpoint_delete_time",
        tiebreak=["endpoint_name", "entity_name"],
    )


def endpoint_usage_daily(endpoint_usage: DataFrame) -> DataFrame:
    """Daily tokens and requests per served entity.

    ``total_tokens`` skips requests that report only one side, so it can be less than
    input plus output.
    """
    return endpoint_usage.groupBy(*SCOPE, "served_entity_id", F.to_date("request_time").alias("usage_date")).agg(
        F.sum("input_token_count").alias("total_input_tokens"),
        F.sum("output_token_count").alias("total_output_tokens"),
        F.sum(F.col("input_token_count") + F.col("output_token_count")).alias("total_tokens"),
        F.count("*").alias("request_count"),
        F.min("request_time").alias("first_request"),
        F.max("request_time").alias("last_request"),
    )


def with_entities(daily: DataFrame, served_current: DataFrame) -> DataFrame:
    """Add the current attributes of the served entity; NULL for one that is gone."""
    joined = daily.join(served_current.select(*ENTITY_KEY, *ENTITY_ATTRIBUTES), ENTITY_KEY, "left")
    return joined.select(*daily.columns, *ENTITY_ATTRIBUTES)


def endpoint_usage_summary(endpoint_usage: DataFrame, served_current: DataFrame) -> DataFrame:
    return with_entities(endpoint_usage_daily(endpoint_usage), served_current)


def _billing_by_endpoint(lines: DataFrame, *dims: str) -> DataFrame:
    return lines.groupBy(*SCOPE, "usage_date", "endpoint_name", "sku_name", *dims).agg(
        *spend(), F.count("*").alias("billing_records")
    )


def serving_costs_daily(lines: DataFrame) -> DataFrame:
    return _billing_by_endpoint(lines.where("billing_origin_product = 'MODEL_SERVING'"))


def endpoint_entities(served_current: DataFrame) -> DataFrame:
    """One entity served at each endpoint.

    An endpoint can serve several; the most recently changed one is taken (then the
    greatest id), so reruns agree.
    """
    entity = latest_by(served_current, ENDPOINT_KEY, "change_time", ["served_entity_id"])
    return entity.select(*ENDPOINT_KEY, *ENDPOINT_ATTRIBUTES)


def with_endpoint_entity(costs: DataFrame, served_current: DataFrame) -> DataFrame:
    """Add one entity served at the endpoint (``endpoint_entities``)."""
    joined = costs.join(endpoint_entities(served_current), ENDPOINT_KEY, "left")
    return joined.select(*costs.columns, *ENDPOINT_ATTRIBUTES)


def model_serving_costs(lines: DataFrame, served_current: DataFrame) -> DataFrame:
    """Daily serving cost per endpoint and SKU, with an entity served there."""
    return with_endpoint_entity(serving_costs_daily(lines), served_current)


def foundation_model_usage(endpoint_usage_summary: DataFrame, *, endpoint_pattern: str = FOUNDATION_ENDPOINTS) -> DataFrame:
    """Token usage of foundation models, told by entity type or by endpoint name."""
    by_type = F.col("entity_type").contains("FOUNDATION") | F.col("entity_type").isin(FOUNDATION_TYPES)
    by_name = F.col("endpoint_name").rlike(endpoint_pattern)
    return endpoint_usage_summary.where(by_type | by_name).select(
        *SCOPE, "usage_date", "endpoint_name", "entity_name", "entity_type", *_TOKENS
    )


def foundation_model_costs(lines: DataFrame, *, endpoint_pattern: str = FOUNDATION_ENDPOINTS) -> DataFrame:
    """Daily cost of foundation models, told by product, SKU or endpoint name."""
    sku = F.col("sku_name")
    ours = (
        F.col("billing_origin_product").isin(FOUNDATION_PRODUCTS)
        | sku.contains("FOUNDATION")
        | sku.contains("TOKEN")
        | F.col("endpoint_name").rlike(endpoint_pattern)
    )
    return _billing_by_endpoint(lines.where(ours), "billing_origin_product")


def external_model_usage(endpoint_usage_summary: DataFrame) -> DataFrame:
    return endpoint_usage_summary.where("entity_type = 'EXTERNAL_MODEL'").select(
        *SCOPE, "usage_date", "endpoint_name", "entity_name", *_TOKENS
    )


def endpoint_inventory(
    served_current: DataFrame, model_serving_costs: DataFrame, *, days: int | None = None, as_of: Day = None
) -> DataFrame:
    """Every current entity with the cost and last billing date of its endpoint.

    ``total_cost_usd_30d`` sums all the cost rows given, whatever its name says;
    ``days=30`` limits it to the trailing days.
    """
    costs = model_serving_costs if days is None else trailing(model_serving_costs, "usage_date", days, as_of)
    return with_endpoint_costs(served_current, ENDPOINT_COSTS.states(costs))


def endpoint_cost_states(costs: DataFrame) -> DataFrame:
    """The cost states of each date, to be merged later."""
    return ENDPOINT_COSTS.states(costs, "usage_date")


def with_endpoint_costs(served_current: DataFrame, cost_states: DataFrame) -> DataFrame:
    """Every current entity with the merged costs of its endpoint."""
    entities = served_current.select(
        *SCOPE,
        "endpoint_id",
        "endpoint_name",
        "served_entity_id",
        "served_entity_name",
        "entity_type",
        "entity_name",
        "entity_version",
        F.col("task").alias("task_type"),
        F.col("endpoint_config_version").alias("config_version"),
        "created_by",
        "change_time",
    )
    joined = entities.join(ENDPOINT_COSTS.merge(cost_states), ENDPOINT_KEY, "left")
    return joined.select(*entities.columns, "total_cost_usd_30d", "last_billing_date")
