"""Every registered query with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.functions import SCOPE, add_time_dimensions, add_workspace_identifiers
from meterlens.operators import (
    aggregate_by_day,
    basic_agg,
    consolidate,
    entity_scorecard,
    extract_current_scd2,
    filtered_view,
    period_compare,
    pivot_sum,
    rolling_avg,
    tag_costs,
    top_n,
    with_costs,
    zscore_anomalies,
)
from meterlens.plans import (
    audit,
    billing,
    billing_reports,
    compute,
    consolidated,
    jobs,
    metadata,
    ml_reports,
    ml_spend,
    rollups,
    serving,
    tracking,
)
from meterlens.sources.scratch import new_folder
from meterlens.validation import oracle
from meterlens.validation.fixtures import ACCOUNT, BILLING_DAY, CLOCK_GAP, EVENTS_DAY, MONTH_END, raw_feed
from meterlens.validation.plain import plain
from meterlens.validation.world import World


@dataclass(frozen=True)
class Query:
    build: Callable[[World], DataFrame]
    sql: str | None = None
    casts: dict[str, str] = field(default_factory=dict)

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        # The test tables have a few rows on each of thousands of dates: list their folders in few tasks.
        spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", "16")
        return plain(self.build(World(spark, sf_dir)), self.casts.get("stat", "").split())

    @property
    def oracle_sql(self) -> str | None:
        return None if self.sql is None else oracle.plain(self.sql, **self.casts)


QUERIES: dict[str, Query] = {}

_MONEY = "total_dbus total_cost_usd"
_USAGE_COLUMNS = (
    "_account_identifier, _workspace_identifier, account_id, workspace_id, usage_date, usage_start_time, usage_end_time, "
    "sku_name, cloud, billing_origin_product, usage_quantity, usage_unit, estimated_cost_usd, job_id, job_name, warehouse_id, "
    "notebook_id, dlt_pipeline_id, endpoint_name, run_as, is_serverless, custom_tags"
)
_TAGS_SQL = """case when tag_team is not null then concat(case when tag_env is not null then concat('env=', tag_env, ',') else '' end,
 'team=', tag_team) when is_serverless is not null then '' end custom_tags"""
_TEXT_TIMES = "usage_date usage_start_time usage_end_time"


def _lines_sql(relation: str, lead: str = "") -> str:
    columns = _USAGE_COLUMNS.replace(", custom_tags", "")
    return f"select {lead}{columns}, {_TAGS_SQL} from {relation}"


def _line_columns(df: DataFrame, *lead: str) -> DataFrame:
    return df.select(*lead, *_USAGE_COLUMNS.split(", "))


def _add(name: str, build: Callable[[World], DataFrame], sql: str | None = None, **casts: str) -> None:
    QUERIES[name] = Query(build, sql or f"select * from {name}", casts)


# --- priced usage and cost datasets
for _name, _relation, _options in (
    ("billing_summary", "billing_summary", {}),
    ("billing_summary_price_at_start", "billing_at_start", {"price_at": "start"}),
    ("billing_summary_with_corrections", "billing_net", {"corrections": True}),
    # the path for a price list too large to broadcast: salted shuffle join
    ("billing_summary_salted", "billing_summary", {"salted": True}),
    ("billing_summary_bucketed", "billing_summary", {"bucketed": True}),
):
    _add(
        _name,
        lambda w, o=_options: _line_columns(billing.billing_summary(w.usage, w.prices, **o)),
        _lines_sql(_relation),
        double="usage_quantity estimated_cost_usd",
        text=_TEXT_TIMES,
    )
_add("cost_by_product", lambda w: w.by_product, double=_MONEY, text="usage_date")
_add("cost_by_sku", lambda w: billing.cost_by_sku(w.lines), double="total_usage total_cost_usd", text="usage_date")
_add("cost_by_job", lambda w: w.by_job, double=_MONEY, text="usage_date")
_add("cost_by_user", lambda w: billing.cost_by_user(w.lines), double=_MONEY, text="usage_date")
_EXEC_MONEY = (
    f"{_MONEY} jobs_cost_usd sql_cost_usd dlt_cost_usd serving_cost_usd interactive_cost_usd serverless_cost_usd classic_cost_usd"
)
_add("executive_summary", lambda w: billing.executive_summary(w.by_product), double=_EXEC_MONEY, text="usage_date")
_add(
    "list_prices",
    lambda w: w.prices.select(
        "_account_identifier", "sku_name", "cloud", F.col("pricing.default").alias("price"), "price_start_time", "price_end_time"
    ),
    "select 'acct_a' _account_identifier, sku_name, cloud, price, price_start_time, price_end_time from list_prices",
    double="price",
    text="price_start_time price_end_time",
)
_add(
    "workspace_info",
    lambda w: metadata.workspace_info(raw_feed(w.spark, w.sf_dir, "workspaces_latest"), ACCOUNT).drop("create_time"),
    "select 'acct_a' _account_identifier, * from workspaces_latest",
)
_add(
    "price_overlaps",
    lambda w: billing.overlapping_prices(w.prices.unionByName(w.prices.withColumn("price_end_time", F.lit(None).cast("timestamp")))),
    """select * from (select sku_name, cloud, price_start_time, price_end_time,
 lead(price_start_time) over (partition by sku_name, cloud order by price_start_time, price_end_time nulls last) next_start_time
 from (select * from list_prices union all select * replace (null as price_end_time) from list_prices))
 where next_start_time is not null and (price_end_time is null or price_end_time > next_start_time)""",
    text="price_start_time price_end_time next_start_time",
)

# --- jobs, compute, audit
_add(
    "jobs_current",
    lambda w: w.jobs_current.select(*SCOPE, "job_id", "name", "run_as", "change_time"),
    "select _account_identifier, _workspace_identifier, workspace_id, job_id, name, run_as, change_time from jobs_current",
    text="change_time",
)
_RUN_CASTS = {
    "text": "run_date",
    "count": "total_runs successful_runs failed_runs canceled_runs p95_duration_seconds",
    "stat": "avg_duration_seconds",
}
_add("job_runs_summary", lambda w: w.runs, **_RUN_CASTS)
_add(
    "job_runs_summary_merged",
    lambda w: jobs.job_runs_summary(w.feed("job_run_timeline"), w.jobs_current, merge_slices=True),
    "select * from job_runs_merged",
    **_RUN_CASTS,
)
_add(
    "clusters_current",
    lambda w: w.clusters_current.select(
        *SCOPE, "cluster_id", "cluster_name", "owned_by", "num_workers", "change_time", "delete_time"
    ),
    count="num_workers",
    text="change_time delete_time",
)
_add(
    "cluster_utilization",
    lambda w: compute.cluster_utilization(w.feed("node_timeline")),
    text="hour",
    count="total_network_in_bytes total_network_out_bytes",
    stat="avg_cpu_percent avg_memory_percent",
)
_add("user_activity_summary", lambda w: w.user_activity, text="event_date first_activity last_activity")
_add("data_access_summary", lambda w: audit.data_access_summary(w.feed("audit")), text="event_date first_access last_access")
_add(
    "recipient_events",
    lambda w: audit.recipient_events(w.feed("audit")).select(
        *SCOPE, "event_time", "event_date", "service_name", "action_name", "source_ip_address"
    ),
    text="event_time event_date",
)

# --- model serving, ML tracking, vector search
_add(
    "served_entities_current",
    lambda w: w.served_current.select(*SCOPE, "served_entity_id", "endpoint_name", "entity_type", "entity_name", "change_time"),
    text="change_time",
    drop="endpoint_delete_time",
)
_TOKENS = "total_input_tokens total_output_tokens total_tokens"
_add(
    "endpoint_usage_summary",
    lambda w: w.endpoint_usage.drop("endpoint_id", "served_entity_name"),
    count=_TOKENS,
    text="usage_date first_request last_request",
)
_add("model_serving_costs", lambda w: w.serving_costs, double=_MONEY, text="usage_date")
_add("foundation_model_usage", lambda w: w.foundation_usage, count=_TOKENS, text="usage_date")
_add("foundation_model_costs", lambda w: serving.foundation_model_costs(w.lines), double=_MONEY, text="usage_date")
_add("external_model_usage", lambda w: w.external_usage, count=_TOKENS, text="usage_date")
_INVENTORY = ["served_entity_id", "endpoint_name", "entity_type", "entity_name", "change_time", "total_cost_usd_30d", "last_billing_date"]
_INVENTORY_CASTS = {"double": "total_cost_usd_30d", "text": "change_time last_billing_date", "drop": "endpoint_delete_time"}
_add("endpoint_inventory", lambda w: w.inventory.select(*SCOPE, *_INVENTORY), **_INVENTORY_CASTS)
_add(
    "endpoint_inventory_30d",
    lambda w: serving.endpoint_inventory(w.served_current, w.serving_costs, days=30, as_of=BILLING_DAY).select(*SCOPE, *_INVENTORY),
    **_INVENTORY_CASTS,
)
_add("mlflow_experiments_summary", lambda w: w.experiments, text="creation_time last_update_time first_run last_run")
_add("mlflow_runs_summary", lambda w: w.ml_runs, text="run_date", count="total_compute_seconds", stat="avg_duration_seconds")
_add("vector_search_costs", lambda w: w.vector_costs, double=_MONEY, text="usage_date")
_add("vector_search_summary", lambda w: w.vector_summary, double=_MONEY, text="usage_date", listing="endpoint_names")
_add("aiml_executive_summary", lambda w: w.aiml, double=_MONEY, text="usage_date")

# --- rollups
_add("cost_weekly_rollup", lambda w: rollups.cost_weekly_rollup(w.by_product), double=_MONEY, count="record_count", text="week_start")
_add("cost_monthly_rollup", lambda w: rollups.cost_monthly_rollup(w.by_product), double=_MONEY, count="record_count", text="month_start")
_TREND_CASTS = {
    "count": "total_runs successful_runs failed_runs p95_duration_seconds",
    "text": "run_date",
    "stat": "avg_duration_seconds ma7_avg_duration ma7_success_rate",
}
_add("job_performance_trends", lambda w: rollups.job_performance_trends(w.runs, as_of=EVENTS_DAY), **_TREND_CASTS)
_add(
    "job_performance_trends_by_days",
    lambda w: rollups.job_performance_trends(w.runs, as_of=EVENTS_DAY, by_days=True),
    **_TREND_CASTS,
)
_add(
    "cost_anomalies",
    lambda w: rollups.cost_anomalies(w.by_product, as_of=BILLING_DAY),
    double="daily_cost",
    text="usage_date",
    stat="ma30_cost stddev30_cost z_score",
)
_add("top_consumers_30d", lambda w: rollups.top_consumers_30d(w.by_job, as_of=BILLING_DAY), double=_MONEY, count="total_runs")
_add(
    "user_activity_30d",
    lambda w: rollups.user_activity_30d(w.user_activity, as_of=EVENTS_DAY),
    count="total_events",
    text="first_seen last_seen",
    listing="services_used",
)
_add(
    "job_success_rate_weekly",
    lambda w: rollups.job_success_rate_weekly(w.runs),
    count="total_runs successful_runs failed_runs canceled_runs",
    text="week_start",
)
_add(
    "cost_trend_analysis",
    lambda w: rollups.cost_trend_analysis(w.by_product),
    double="total_cost_usd",
    text="usage_date",
    stat="cost_7d_rolling_avg cost_30d_rolling_avg",
)

# --- billing reports
for _name, _casts in {
    "v_daily_spend_trend": {"double": f"{_MONEY} cumulative_cost_usd", "text": "usage_date"},
    "v_serverless_comparison": {"double": _MONEY, "text": "week_start"},
    "v_top_expensive_jobs": {"double": _MONEY, "text": "first_run last_run"},
    "v_cost_by_tags": {"double": _MONEY, "text": "usage_date"},
    "v_model_serving_costs": {"double": _MONEY, "text": "usage_date"},
    "v_dlt_pipeline_costs": {"double": _MONEY, "text": "usage_date"},
    "v_hourly_spend_pattern": {"double": "avg_hourly_cost total_cost_usd"},
    "v_notebook_costs": {"double": _MONEY, "text": "usage_date"},
}.items():
    _add(_name, lambda w, view=getattr(billing_reports, _name): view(w.lines, as_of=BILLING_DAY), **_casts)
_add("v_current_month_spend", lambda w: billing_reports.v_current_month_spend(w.lines, as_of=MONTH_END), double=_MONEY)
_add("v_warehouse_costs", lambda w: billing_reports.v_warehouse_costs(w.lines), double=_MONEY, text="usage_date")

# --- AI/ML reports
for _name, _source, _day, _casts in (
    ("v_model_serving_cost_summary", "serving_costs", BILLING_DAY, {"double": _MONEY, "text": "first_usage last_usage"}),
    ("v_foundation_model_leaderboard", "foundation_usage", EVENTS_DAY, {"count": f"{_TOKENS} total_requests"}),
    ("v_external_model_summary", "external_usage", EVENTS_DAY, {"count": f"{_TOKENS} total_requests"}),
    (
        "v_endpoint_daily_pattern",
        "endpoint_usage",
        EVENTS_DAY,
        {"count": "total_tokens total_requests input_tokens output_tokens", "text": "usage_date"},
    ),
    ("v_mlflow_experiment_activity", "experiments", BILLING_DAY, {"text": "first_run last_run"}),
    (
        "v_mlflow_daily_activity",
        "ml_runs",
        BILLING_DAY,
        {"count": "total_runs successful_runs failed_runs distinct_users", "text": "run_date"},
    ),
    ("v_top_experimenters", "experiments", BILLING_DAY, {"text": "last_run"}),
    ("v_vector_search_by_endpoint", "vector_costs", BILLING_DAY, {"double": _MONEY, "text": "first_usage last_usage"}),
    ("v_vector_search_daily_trend", "vector_summary", BILLING_DAY, {"double": f"{_MONEY} cumulative_cost_usd", "text": "usage_date"}),
    ("v_aiml_spend_by_category", "aiml", BILLING_DAY, {"double": _MONEY, "count": "total_endpoints total_users"}),
    (
        "v_aiml_daily_trend",
        "aiml",
        BILLING_DAY,
        {
            "double": "total_cost_usd inference_cost vector_search_cost feature_serving_cost finetuning_cost",
            "text": "usage_date",
        },
    ),
    ("v_aiml_wow_comparison", "aiml", BILLING_DAY, {"double": "this_week_cost last_week_cost cost_change change_pct"}),
):
    _add(
        _name,
        lambda w, view=getattr(ml_reports, _name), source=_source, day=_day: view(getattr(w, source), as_of=day),
        **_casts,
    )
_add(
    "v_mlflow_daily_activity_exact",
    lambda w: ml_reports.v_mlflow_daily_activity(w.ml_runs, as_of=BILLING_DAY, runs=w.feed("runs_latest")),
    count="total_runs successful_runs failed_runs",
    text="run_date",
)
_add(
    "v_aiml_spend_by_category_exact",
    lambda w: ml_reports.v_aiml_spend_by_category(lines=w.lines, as_of=BILLING_DAY),
    double=_MONEY,
)
_add(
    "v_inactive_endpoints",
    lambda w: ml_reports.v_inactive_endpoints(
        serving.endpoint_inventory(w.served_current, w.serving_costs.where(F.col("usage_date") <= F.lit(BILLING_DAY))), as_of=BILLING_DAY
    ).select(*SCOPE, *_INVENTORY, "days_since_last_billing"),
    **_INVENTORY_CASTS,
)
_add(
    "v_aiml_complete_inventory",
    lambda w: ml_reports.v_aiml_complete_inventory(w.inventory, w.experiments),
    double="cost_30d",
    text="last_updated",
)

# --- several providers
_add(
    "all_billing_summary",
    lambda w: _line_columns(consolidate(w.provider_lines), "source"),
    _lines_sql("all_billing_summary", "source, "),
    double="usage_quantity estimated_cost_usd",
    text=_TEXT_TIMES,
)
_add("all_cost_by_product", lambda w: w.all_by_product, double=_MONEY, text="usage_date")
_add("all_job_runs", lambda w: w.all_job_runs, **_RUN_CASTS)
_add(
    "all_endpoint_usage",
    lambda w: w.all_endpoint_usage.drop("endpoint_id", "served_entity_name"),
    count=_TOKENS,
    text="usage_date first_request last_request",
)
_add("all_mlflow_experiments", lambda w: w.all_experiments, text="creation_time last_update_time first_run last_run")
_add(
    "all_executive_summary",
    lambda w: consolidate(
        {name: billing.executive_summary(billing.cost_by_product(df)) for name, df in w.provider_lines.items()}
    ),
    double=_EXEC_MONEY,
    text="usage_date",
)
_add("all_aiml_summary", lambda w: w.all_aiml, double=_MONEY, text="usage_date")
_add(
    "all_model_serving_costs",
    lambda w: consolidate({name: serving.model_serving_costs(df, w.served_current) for name, df in w.provider_lines.items()}),
    double=_MONEY,
    text="usage_date",
)
_add("monthly_spend_by_account", lambda w: consolidated.monthly_spend_by_account(w.all_by_product), double=_MONEY, text="month")
_add(
    "account_comparison",
    lambda w: consolidated.account_comparison(w.all_by_product, as_of=BILLING_DAY),
    double="last_7d_cost last_30d_cost total_cost_usd",
)
_add(
    "aiml_spend_comparison",
    lambda w: consolidated.aiml_spend_comparison(
        w.all_aiml, w.all_endpoint_usage.withColumn("usage_date", F.date_sub("usage_date", CLOCK_GAP)), as_of=BILLING_DAY
    ),
    double="model_serving_cost vector_search_cost total_aiml_cost",
    count="total_requests",
    text="summary_date",
)

# --- operators on their own
_add(
    "h_add_workspace_identifiers",
    lambda w: add_workspace_identifiers(raw_feed(w.spark, w.sf_dir, "workspaces_latest")).drop("create_time"),
)
_add(
    "h_extract_current_scd2",
    lambda w: extract_current_scd2(w.feed("jobs"), ["workspace_id", "job_id"]).select(*SCOPE, "job_id", "name", "run_as", "change_time"),
    "select _account_identifier, _workspace_identifier, workspace_id, job_id, name, run_as, change_time from jobs_current",
    text="change_time",
)
_add(
    "h_add_time_dimensions",
    lambda w: add_time_dimensions(w.feed("audit").select(*SCOPE, "source_ip_address", "event_time"), "event_time"),
    text="event_time date week_start month_start",
)


def _job_totals(w: World) -> DataFrame:
    recent = basic_agg(w.by_job, "job_id", "job_name", "run_as", as_of=BILLING_DAY)
    return recent.groupBy(*SCOPE, "job_id", "job_name", "run_as").agg(F.sum("total_cost_usd").alias("total_cost_usd"))


_add(
    "h_top_n",
    lambda w: top_n(_job_totals(w), SCOPE, "total_cost_usd", 10, tiebreak=["job_id", "job_name", "run_as"]),
    double="total_cost_usd",
)
_SKU = [*SCOPE, "sku_name", "cloud", "usage_unit"]
_add(
    "h_rolling_avg",
    lambda w: rolling_avg(billing.cost_by_sku(w.lines), _SKU, "usage_date", {"cost_3_row_avg": "total_cost_usd", "usage_3_row_avg": "total_usage"}, 3),
    f"""select *, avg(cast(total_cost_usd as double)) over w cost_3_row_avg, avg(cast(total_usage as double)) over w usage_3_row_avg from cost_by_sku
 window w as (partition by {', '.join(_SKU)} order by usage_date rows between 2 preceding and current row)""",
    double="total_usage total_cost_usd",
    text="usage_date",
    stat="cost_3_row_avg usage_3_row_avg",
)
_add(
    "h_zscore_anomalies",
    lambda w: zscore_anomalies(
        basic_agg(w.by_product, as_of=BILLING_DAY, days=90).select(*SCOPE, "usage_date", F.col("total_cost_usd").alias("daily_cost")),
        SCOPE,
        "usage_date",
        "daily_cost",
    ),
    double="daily_cost",
    text="usage_date",
    stat="avg_30d stddev_30d z_score",
)
_add(
    "h_period_compare",
    lambda w: period_compare(w.by_product, [*SCOPE, "billing_origin_product"], "total_cost_usd", as_of=BILLING_DAY),
    double="current_period_cost previous_period_cost cost_change cost_change_pct",
)
_PIVOT = {
    "jobs_cost": "JOBS",
    "sql_cost": "SQL",
    "dlt_cost": "DLT",
    "serving_cost": "MODEL_SERVING",
    "vector_search_cost": "VECTOR_SEARCH",
    "interactive_cost": "INTERACTIVE",
}


def _recent_products(w: World) -> DataFrame:
    return w.by_product.where(F.col("usage_date").between(F.date_sub(F.lit(BILLING_DAY), 30), F.lit(BILLING_DAY)))


_add(
    "h_pivot_sum",
    lambda w: pivot_sum(
        _recent_products(w), [*SCOPE, "usage_date"], "billing_origin_product", _PIVOT, "total_cost_usd", total_col="total_cost"
    ),
    double=" ".join([*_PIVOT, "total_cost"]),
    text="usage_date",
)
_add(
    "h_tag_costs",
    lambda w: tag_costs(w.lines, ["team", "env", "cost_center"], as_of=BILLING_DAY),
    double=_MONEY,
    text="usage_date",
)
_add("h_basic_agg", lambda w: basic_agg(w.by_product, as_of=BILLING_DAY), double=_MONEY, text="usage_date")
_add(
    "h_entity_scorecard",
    lambda w: entity_scorecard(
        w.jobs_current, w.runs.withColumn("run_date", F.date_sub("run_date", CLOCK_GAP)), w.by_job, as_of=BILLING_DAY
    ),
    double=_MONEY,
    count="total_runs successful_runs failed_runs",
    stat="avg_duration_seconds",
)
_add(
    "h_template_aggregated",
    lambda w: aggregate_by_day(
        w.feed("run_metrics_history").withColumn("step", F.col("step").cast("double")), "metric_time", "step", ["metric_name"]
    ),
    text="date last_seen",
    stat="avg_metric",
)
# The sums of the second are written first, so that Spark knows their size; the third has its keys salted.
for _name, _options in (
    ("h_template_with_costs", lambda w: {}),
    ("h_template_with_costs_broadcast", lambda w: {"store_at": new_folder(w.spark, "costs")}),
    ("h_template_with_costs_salted", lambda w: {"salted": True}),
):
    _add(
        _name,
        lambda w, options=_options: with_costs(w.jobs_current.select("workspace_id", "job_id", "name"), w.lines, **options(w)),
        "select * from h_template_with_costs",
        double="estimated_cost_usd",
        text="usage_date",
    )
_add(
    "h_template_filtered_view",
    lambda w: filtered_view(
        w.feed("run_metrics_history"), F.col("metric_name") == "loss", ["metric_id", "metric_name", "metric_value"]
    ),
)
