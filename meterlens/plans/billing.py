"""Priced usage lines and the cost datasets summed from them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlens.functions import SCOPE, spend, sum_if
from meterlens.functions.measures import respend
from meterlens.operators.joins import broadcast_if_few, lookup_join
from meterlens.operators.pivots import pivot_columns

_ATTRIBUTION = [
    f"usage_metadata.{field}"
    for field in (
        "job_id",
        "job_name",
        "cluster_id",
        "warehouse_id",
        "notebook_id",
        "notebook_path",
        "dlt_pipeline_id",
        "endpoint_name",
    )
]
_FEATURES = [f"product_features.{field}" for field in ("is_serverless", "is_photon", "jobs_tier", "sql_tier")]

_PRICE_KEY = {"sku_name": "_price_sku", "cloud": "_price_cloud"}
#: Stands for the month of records that end before they start.
_NO_MONTH = -1
#: What tells records apart, for salting.
_RECORD = ["record_id", "workspace_id", "usage_start_time", "usage_quantity"]


def billing_summary(
    usage: DataFrame,
    prices: DataFrame,
    *,
    corrections: bool = False,
    price_at: str = "period",
    salted: bool = False,
    bucketed: bool = False,
) -> DataFrame:
    """One row per original usage record with its list-price cost, nested fields flattened.

    A price applies to a record of the same SKU and cloud that starts on or after the
    price's start and ends by its end (an open end is NULL). A record without a price,
    such as one across a price change, costs 0. ``price_at="start"`` looks only at the
    record's start, which prices such records too. ``corrections=True`` also keeps
    retractions and restatements, so that sums are net of them. ``salted`` is for a price
    list too large to broadcast where adaptive execution is off: see ``lookup_join``.
    ``bucketed`` is for SKUs with very many price versions: records meet only those of
    their own month; it first looks up the months of the usage, in a job of one column.
    """
    if price_at not in ("period", "start"):
        raise ValueError(f"price_at must be 'period' or 'start', not {price_at!r}")
    lines = usage if corrections else usage.where("record_type = 'ORIGINAL'")
    price_list = prices.select(
        F.col("sku_name").alias("_price_sku"),
        F.col("cloud").alias("_price_cloud"),
        F.col("pricing.default").alias("_unit_price"),
        F.col("price_start_time").alias("_price_from"),
        F.col("price_end_time").alias("_price_to"),
    )

    def in_force():
        still_open = F.col("_price_to").isNull()
        ends_in_time = (
            F.col("usage_start_time") < F.col("_price_to")
            if price_at == "start"
            else F.col("usage_end_time") <= F.col("_price_to")
        )
        return (F.col("_price_from") <= F.col("usage_start_time")) & (still_open | ends_in_time)

    if bucketed:
        priced = _meet_by_month(lines, price_list, in_force, _RECORD if salted else ())
    elif salted:
        priced = lookup_join(lines, price_list, _PRICE_KEY, also=in_force, salt_on=_RECORD)
    else:
        priced = lookup_join(lines, broadcast_if_few(price_list), _PRICE_KEY, also=in_force)
    free = F.lit(0).cast("decimal(18,4)")
    cost = F.col("usage_quantity") * F.coalesce("_unit_price", free)
    lineage = ["_ingested_at"] if "_ingested_at" in usage.columns else []
    # The columns of the priced lines, in this order.
    return priced.select(
        "_account_identifier",
        "_workspace_identifier",
        "account_id",
        "workspace_id",
        "usage_date",
        "usage_start_time",
        "usage_end_time",
        "sku_name",
        "cloud",
        "billing_origin_product",
        "usage_quantity",
        "usage_unit",
        cost.alias("estimated_cost_usd"),
        *_ATTRIBUTION,
        "identity_metadata.run_as",
        *_FEATURES,
        "custom_tags",
        *lineage,
    )


def _month(time: str) -> Column:
    return F.year(time) * 12 + F.month(time)


def price_months(price_list: DataFrame, first: int, last: int) -> DataFrame:
    """Each price once for every month from ``first`` to ``last`` in which it is in force, in ``_price_month``."""
    begin = F.greatest(_month("_price_from"), F.lit(first))
    end = F.least(F.coalesce(_month("_price_to"), F.lit(last)), F.lit(last))
    return price_list.where(begin <= end).withColumn("_price_month", F.explode(F.sequence(begin, end)))


def _meet_by_month(lines: DataFrame, price_list: DataFrame, in_force: Callable[[], Column], salt_on: Sequence[str]) -> DataFrame:
    """``lookup_join`` on the month too. A record starts in a month in which its price is in force, if it doesn't end before it starts.

    Records that do meet every price of their SKU and cloud once, under a month of their own.
    """
    backwards = F.coalesce(F.col("usage_end_time") < F.col("usage_start_time"), F.lit(False))
    start = F.when(~backwards, _month("usage_start_time"))
    months = lines.agg(F.min(start).alias("first"), F.max(start).alias("last")).first()
    by_month = price_months(price_list, months["first"] or 0, months["last"] or 0)
    by_month = by_month.unionByName(price_list.withColumn("_price_month", F.lit(_NO_MONTH)))
    keyed = lines.withColumn("_usage_month", F.when(backwards, F.lit(_NO_MONTH)).otherwise(_month("usage_start_time")))
    by_month = by_month if salt_on else broadcast_if_few(by_month)
    return lookup_join(keyed, by_month, _PRICE_KEY | {"_usage_month": "_price_month"}, also=in_force, salt_on=salt_on)


def overlapping_prices(prices: DataFrame) -> DataFrame:
    """Prices whose interval runs into the next one of the same SKU and cloud.

    Such a pair would price a record twice; a clean price list gives no rows.
    """
    in_order = Window.partitionBy("sku_name", "cloud").orderBy("price_start_time", F.col("price_end_time").asc_nulls_last())
    following = F.lead("price_start_time").over(in_order)
    return (
        prices.withColumn("next_start_time", following)
        .where("next_start_time IS NOT NULL AND (price_end_time IS NULL OR price_end_time > next_start_time)")
        .select("sku_name", "cloud", "price_start_time", "price_end_time", "next_start_time")
    )


def cost_by_product(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*SCOPE, "usage_date", "billing_origin_product", "is_serverless").agg(
        *spend(), F.count("*").alias("record_count")
    )


def cost_by_sku(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*SCOPE, "usage_date", "sku_name", "cloud", "usage_unit").agg(
        *spend(quantity_as="total_usage"), F.count("*").alias("record_count")
    )


def cost_by_job(lines: DataFrame) -> DataFrame:
    """``run_count`` counts billing records, not runs; the name is kept for compatibility."""
    per_job = lines.where("job_id IS NOT NULL").groupBy(
        *SCOPE, "usage_date", "job_id", "job_name", "run_as", "billing_origin_product"
    )
    return per_job.agg(*spend(), F.count("*").alias("run_count"))


def cost_by_user(lines: DataFrame) -> DataFrame:
    """Summed per job first, so the distinct count runs on few rows even for a very busy user."""
    user = [*SCOPE, "usage_date", "run_as", "billing_origin_product"]
    per_job = lines.where("run_as IS NOT NULL").groupBy(*user, "job_id").agg(*spend(), F.count("*").alias("record_count"))
    return per_job.groupBy(*user).agg(
        *respend(), F.count("job_id").alias("distinct_jobs"), F.sum("record_count").alias("record_count")
    )


def executive_summary(cost_by_product: DataFrame) -> DataFrame:
    """Daily spend with one column per headline product, and serverless against classic.

    Rows whose serverless flag is NULL count in neither of the two.
    """
    cost = "total_cost_usd"
    products = {
        "jobs_cost_usd": "JOBS",
        "sql_cost_usd": "SQL",
        "dlt_cost_usd": "DLT",
        "serving_cost_usd": "MODEL_SERVING",
        "interactive_cost_usd": "INTERACTIVE",
    }
    return cost_by_product.groupBy(*SCOPE, "usage_date").agg(
        *respend(),
        *pivot_columns("billing_origin_product", products, cost),
        sum_if(F.col("is_serverless"), cost).alias("serverless_cost_usd"),
        sum_if(~F.col("is_serverless"), cost).alias("classic_cost_usd"),
    )
