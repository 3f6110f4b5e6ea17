"""The three jobs: refresh (every few minutes), daily rollups, publishing.

Each is an ordered list of calls; scheduling and retries belong to the caller. All
are safe to run again after a failure.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.functions import Day, day_of, stamp_identifiers
from meterlens.operators import change_feed, consolidate
from meterlens.plans import audit, billing, billing_reports, compute, consolidated, jobs, metadata, ml_reports, ml_spend, rollups, serving, tracking
from meterlens.schemas import feed_schema
from meterlens.sources.failures import FAILURES, first_line
from meterlens.sources.feeds import evolved_schema
from meterlens.sources.layout import CLUSTER_COLUMNS, compact_all, merge_loads, refresh_clustered, retain, retain_bronze
from meterlens.sources.publish import Share, publish, shared_names
from meterlens.sources.files import has_files, is_written
from meterlens.sources.tables import MANY_DATES, Stored, Table, balanced, create_views, only_dates, rows_by_date
from meterlens.sources.together import together
from meterlens.streaming.entities import changed_entities, dates_of_entities, whole_entities
from meterlens.streaming.ingest import BRONZE, ingest_feed, read_bronze
from meterlens.streaming.refresh import Dates, consumed, dates_of_price_changes, rebuild_on_new_bronze, rebuild_on_new_rows

# Date column of each dataset that is rebuilt date by date.
_DATED = {
    **dict.fromkeys(
        [
            "billing_summary",
            "cost_by_product",
            "cost_by_sku",
            "cost_by_job",
            "cost_by_user",
            "executive_summary",
            "serving_costs_daily",
            "foundation_model_costs",
            "vector_search_costs",
            "vector_search_summary",
            "aiml_executive_summary",
            "endpoint_usage_daily",
            "endpoint_usage_summary",
            "foundation_model_usage",
            "external_model_usage",
            "model_serving_costs",
            "endpoint_cost_states",
        ],
        "usage_date",
    ),
    "job_runs_daily": "run_date",
    "job_runs_summary": "run_date",
    "mlflow_run_states": "run_date",
    "cluster_utilization": "_day",
    "mlflow_runs_summary": "run_date",
    "user_activity_summary": "event_date",
    "data_access_summary": "event_date",
    "audit_actions": "event_date",
}
# Datasets summed from the priced lines of the same dates, and from each other.
_FROM_LINES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "cost_by_product": billing.cost_by_product,
    "cost_by_sku": billing.cost_by_sku,
    "cost_by_job": billing.cost_by_job,
    "cost_by_user": billing.cost_by_user,
    "serving_costs_daily": serving.serving_costs_daily,
    "foundation_model_costs": serving.foundation_model_costs,
    "vector_search_costs": ml_spend.vector_search_costs,
    "aiml_executive_summary": ml_spend.aiml_executive_summary,
}
_FROM_SUMS = {
    "executive_summary": ("cost_by_product", billing.executive_summary),
    "vector_search_summary": ("vector_search_costs", ml_spend.vector_search_summary),
    "endpoint_cost_states": ("serving_costs_daily", serving.endpoint_cost_states),
}
# Datasets over the whole history: never stored, but merged from small states by date when read.
_MERGED: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "endpoint_inventory": (serving.with_endpoint_costs, ("served_entities_current", "endpoint_cost_states")),
    "mlflow_experiments_summary": (tracking.with_run_stats, ("mlflow_experiments", "mlflow_run_states")),
}
# Each report and the stored tables it reads.
REPORTS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "v_current_month_spend": (billing_reports.v_current_month_spend, ("billing_summary",)),
    "v_daily_spend_trend": (billing_reports.v_daily_spend_trend, ("billing_summary",)),
    "v_serverless_comparison": (billing_reports.v_serverless_comparison, ("billing_summary",)),
    "v_top_expensive_jobs": (billing_reports.v_top_expensive_jobs, ("billing_summary",)),
    "v_cost_by_tags": (billing_reports.v_cost_by_tags, ("billing_summary",)),
    "v_warehouse_costs": (lambda lines, as_of: billing_reports.v_warehouse_costs(lines), ("billing_summary",)),
    "v_model_serving_costs": (billing_reports.v_model_serving_costs, ("billing_summary",)),
    "v_dlt_pipeline_costs": (billing_reports.v_dlt_pipeline_costs, ("billing_summary",)),
    "v_hourly_spend_pattern": (billing_reports.v_hourly_spend_pattern, ("billing_summary",)),
    "v_notebook_costs": (billing_reports.v_notebook_costs, ("billing_summary",)),
    "v_model_serving_cost_summary": (ml_reports.v_model_serving_cost_summary, ("model_serving_costs",)),
    "v_foundation_model_leaderboard": (ml_reports.v_foundation_model_leaderboard, ("foundation_model_usage",)),
    "v_external_model_summary": (ml_reports.v_external_model_summary, ("external_model_usage",)),
    "v_endpoint_daily_pattern": (ml_reports.v_endpoint_daily_pattern, ("endpoint_usage_summary",)),
    "v_inactive_endpoints": (ml_reports.v_inactive_endpoints, ("endpoint_inventory",)),
    "v_mlflow_experiment_activity": (ml_reports.v_mlflow_experiment_activity, ("mlflow_experiments_summary",)),
    "v_mlflow_daily_activity": (ml_reports.v_mlflow_daily_activity, ("mlflow_runs_summary",)),
    "v_top_experimenters": (ml_reports.v_top_experimenters, ("mlflow_experiments_summary",)),
    "v_vector_search_by_endpoint": (ml_reports.v_vector_search_by_endpoint, ("vector_search_costs",)),
    "v_vector_search_daily_trend": (ml_reports.v_vector_search_daily_trend, ("vector_search_summary",)),
    "v_aiml_spend_by_category": (ml_reports.v_aiml_spend_by_category, ("aiml_executive_summary",)),
    "v_aiml_daily_trend": (ml_reports.v_aiml_daily_trend, ("aiml_executive_summary",)),
    "v_aiml_wow_comparison": (ml_reports.v_aiml_wow_comparison, ("aiml_executive_summary",)),
    "v_aiml_complete_inventory": (
        lambda inventory, experiments, as_of: ml_reports.v_aiml_complete_inventory(inventory, experiments),
        ("endpoint_inventory", "mlflow_experiments_summary"),
    ),
}
# Tables compacted by the daily job.
COMPACTED = ["billing_summary", "cost_by_product", "cost_by_sku", "cost_by_job", "job_runs_summary"]
_PRICE_KEY = ["sku_name", "cloud", "currency_code", "price_start_time"]


@dataclass(frozen=True)
class Merged:
    """A dataset that is put together from stored tables when it is read."""

    build: Callable[..., DataFrame]
    parts: tuple[Table, ...]
    date_col: str | None = None

    def exists(self) -> bool:
        return all(t.exists() for t in self.parts)

    def read(self) -> DataFrame:
        return self.build(*(t.read() for t in self.parts))


@dataclass(frozen=True)
class Lake:
    """Where one workspace's tables live."""

    spark: SparkSession
    root: str
    account: str | None = None
    workspace: str | None = None
    #: Tables whose changes streams may follow, with the columns that tell their rows apart.
    change_keys: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def bronze_path(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def bronze(self, name: str) -> DataFrame:
        """A bronze table by its documented schema, and what a run with ``evolve`` has added; no rows if there are none yet."""
        return read_bronze(self.spark, self.bronze_path(name), name, merge_schema=has_files(self.spark, f"{self.root}/evolved/{name}"))

    def gold(self, name: str) -> Table | Merged:
        if name in _MERGED:
            build, parts = _MERGED[name]
            return Merged(build, tuple(self.gold(x) for x in parts))
        return Table(self.spark, f"{self.root}/gold/{name}", _DATED.get(name), self.change_keys.get(name, ()))

    def clustered(self, name: str) -> Table:
        return Table(self.spark, f"{self.root}/clustered/{name}", BRONZE[name].date_col)

    def rollup(self, name: str) -> Table:
        return Table(self.spark, f"{self.root}/rollup/{name}")


def run_refresh(
    lake: Lake, sources: Mapping[str, str], *, evolve: bool = False, latest_tracking: bool = False, merge_slices: bool = False,
    datasets: Collection[str] | None = None,
) -> None:
    """Ingest what is new in each feed and bring the datasets up to date.

    ``sources`` maps feed names to folders of Parquet files; feeds left out are skipped
    along with the datasets that need them. ``evolve`` also ingests columns that a feed
    has gained. ``latest_tracking`` counts only the newest version of each experiment
    and run, for feeds that deliver a row again whenever it changes. ``merge_slices`` counts
    a run that spans hours or dates once, on the date of its first slice. Both should be
    the same at every refresh of a lake. ``datasets`` names the tables made of priced
    lines to keep (None: all); those that they are made of are kept too.
    """
    together(partial(_ingest, lake, table, sources[spec.feed], evolve) for table, spec in BRONZE.items() if spec.feed in sources)
    together(_refreshes(lake, sources, latest_tracking, merge_slices, datasets))


def _refreshes(
    lake: Lake, sources: Mapping[str, str], latest_tracking: bool, merge_slices: bool, datasets: Collection[str] | None
) -> Iterator[Callable[[], None]]:
    """The refreshes whose feeds are there; they do not depend on each other."""
    have = lambda *feeds: set(feeds) <= sources.keys()
    if have("usage", "list_prices") or have("served_entities", "endpoint_usage"):
        yield partial(_refresh_billing_and_serving, lake, sources, datasets)
    if have("jobs", "job_run_timeline"):
        yield partial(_refresh_jobs, lake, merge_slices)
    if have("audit"):
        yield partial(_refresh_audit, lake)
    if have("experiments_latest", "runs_latest"):
        yield partial(_refresh_tracking, lake, latest_tracking)
    if have("node_timeline"):
        yield partial(_refresh_utilization, lake, sources["node_timeline"])
    if have("clusters"):
        yield lambda: lake.gold("clusters_current").replace(compute.clusters_current(lake.bronze("clusters_bronze")))
    if have("workspaces_latest"):
        workspaces = _snapshot(lake, "workspaces_latest", sources["workspaces_latest"])
        yield partial(lake.gold("workspace_info").replace, workspaces)


def _refresh_billing_and_serving(lake: Lake, sources: Mapping[str, str], datasets: Collection[str] | None) -> None:
    """In this order: serving costs are part of the billing datasets."""
    if {"usage", "list_prices"} <= sources.keys():
        _refresh_billing(lake, _snapshot(lake, "list_prices", sources["list_prices"]), datasets)
    if {"served_entities", "endpoint_usage"} <= sources.keys():
        _refresh_serving(lake)


def _ingest(lake: Lake, table: str, source: str, evolve: bool) -> None:
    ingest_feed(
        lake.spark,
        table,
        source,
        lake.bronze_path(table),
        lake.checkpoint(table),
        account=lake.account,
        workspace=lake.workspace,
        schema=evolved_schema(lake.spark, BRONZE[table].feed, source) if evolve else None,
    )
    if evolve:  # a mark for readers that files may hold more columns
        lake.spark.range(1).write.mode("overwrite").parquet(f"{lake.root}/evolved/{table}")


def _ensure(table: Table, empty: Callable[[], DataFrame]) -> Table:
    """A table that no row has reached yet, as an empty one."""
    if not table.exists():
        table.replace(empty())
    return table


def _snapshot(lake: Lake, feed: str, path: str) -> DataFrame:
    raw = lake.spark.read.schema(feed_schema(feed)).parquet(path)
    return metadata.list_prices(raw, lake.account) if feed == "list_prices" else metadata.workspace_info(raw, lake.account)


def _on_new(lake: Lake, table: str, purpose: str, rebuild: Callable[[Dates], None]) -> None:
    rebuild_on_new_bronze(
        lake.spark, table, lake.bronze_path(table), lake.checkpoint(f"{purpose}_from_{table}"), rebuild
    )


def _refresh_billing(lake: Lake, new_prices: DataFrame, datasets: Collection[str] | None) -> None:
    """Rebuild the dates with new usage, and those whose prices changed.

    The new price list is kept aside until every date is rebuilt: after a failure the
    next run still sees the difference to the old one.
    """
    from_sums = {name: x for name, x in _FROM_SUMS.items() if datasets is None or name in datasets}
    sources = {source for source, _ in from_sums.values()}
    from_lines = {name: build for name, build in _FROM_LINES.items() if datasets is None or name in datasets or name in sources}
    incoming, current = lake.gold("list_prices_incoming"), lake.gold("list_prices")
    incoming.replace(new_prices)

    def rebuild(dates: Dates) -> None:
        usage = only_dates(lake.bronze("billing_usage_bronze"), "usage_date", dates)
        lines = billing.billing_summary(usage, incoming.read())
        # Many dates are cut by their rows of usage: counting them by their partition column reads no other.
        lake.gold("billing_summary").overwrite_dates(lines, rows_by_date(usage, "usage_date") if len(dates) > MANY_DATES else dates)
        stored = only_dates(lake.gold("billing_summary").read(), "usage_date", dates)
        together(partial(lake.gold(name).overwrite_dates, build(stored), dates) for name, build in from_lines.items())
        for name, (source, build) in from_sums.items():
            lake.gold(name).overwrite_dates(build(only_dates(lake.gold(source).read(), "usage_date", dates)), dates)
        if lake.gold("model_serving_costs").exists():
            _cost_endpoints(lake, lake.gold("served_entities_current"), dates)

    _on_new(lake, "billing_usage_bronze", "billing", rebuild)
    if current.exists():
        changes = change_feed(current.read(), incoming.read(), _PRICE_KEY)
        dates = dates_of_price_changes(changes, lake.bronze("billing_usage_bronze"))
        if dates:
            rebuild(dates)
    current.replace(incoming.read())
    lines = _ensure(lake.gold("billing_summary"), lambda: billing.billing_summary(lake.bronze("billing_usage_bronze"), incoming.read()))
    for name, build in from_lines.items():
        _ensure(lake.gold(name), lambda build=build: build(lines.read().where("false")))
    for name, (source, build) in from_sums.items():
        _ensure(lake.gold(name), lambda source=source, build=build: build(lake.gold(source).read().where("false")))


def _incoming(lake: Lake, name: str, state: DataFrame) -> tuple[Table, Table]:
    """The current state of entities as it was at the last refresh, and as it is now.

    The old one is kept until all dates of changed entities are rebuilt: after a failure
    the next run still sees the difference.
    """
    current, incoming = lake.gold(name), lake.gold(f"{name}_incoming")
    incoming.replace(state)
    if not current.exists():
        current.replace(incoming.read())
    return current, incoming


def _refresh_jobs(lake: Lake, merge_slices: bool = False) -> None:
    """Daily sums by date; names are rebuilt on the dates with new runs and on those of renamed jobs."""
    current, incoming = _incoming(lake, "jobs_current", jobs.jobs_current(lake.bronze("jobs_bronze")))
    daily, summary = lake.gold("job_runs_daily"), lake.gold("job_runs_summary")

    def name(dates: Dates) -> None:
        summary.overwrite_dates(jobs.with_job_names(only_dates(daily.read(), "run_date", dates), incoming.read()), dates, emptied=merge_slices)

    def rebuild(dates: Dates) -> None:
        runs = lake.bronze("job_runs_bronze")
        if merge_slices:  # a run counts on the date of its first slice, whichever of its dates has new ones
            runs, dates = whole_entities(runs, dates, "_day", jobs.RUN_KEY)
            sums = only_dates(jobs.job_runs_daily(runs, merge_slices=True), "run_date", dates)
        else:
            sums = jobs.job_runs_daily(only_dates(runs, "_day", dates))
        daily.overwrite_dates(sums, dates, emptied=merge_slices)
        name(dates)

    _on_new(lake, "job_runs_bronze", "daily", rebuild)
    _ensure(daily, lambda: jobs.job_runs_daily(lake.bronze("job_runs_bronze")))
    _ensure(summary, lambda: jobs.with_job_names(daily.read().where("false"), incoming.read()))
    renamed = changed_entities(current.read(), incoming.read(), jobs.JOB_KEY, ["name"])
    if dates := dates_of_entities(renamed, daily.read(), jobs.JOB_KEY, "run_date"):
        name(dates)
    current.replace(incoming.read())


def _refresh_utilization(lake: Lake, source: str) -> None:
    """Straight from the feed, which keeps its own history; only days with new samples are read again."""
    schema, day = feed_schema("node_timeline"), F.to_date("start_time").alias("_day")

    def rebuild(dates: Dates) -> None:
        samples = lake.spark.read.schema(schema).parquet(source)
        days = [d for d in dates or [] if d is not None]
        if days and None not in dates:  # a range on the stored column first: file statistics can skip by it
            until = days[-1] + dt.timedelta(days=1)
            samples = samples.where((F.col("start_time") >= F.lit(days[0])) & (F.col("start_time") < F.lit(until)))
        samples = only_dates(samples.withColumn("_day", F.to_date("start_time")), "_day", dates)
        hourly = compute.cluster_utilization(stamp_identifiers(samples, lake.account, lake.workspace))
        lake.gold("cluster_utilization").overwrite_dates(hourly.withColumn("_day", F.to_date("hour")), dates)

    stream = lake.spark.readStream.schema(schema).parquet(source).select(day)
    rebuild_on_new_rows(stream, "_day", lake.checkpoint("daily_from_node_timeline"), rebuild)


def _refresh_audit(lake: Lake) -> None:
    def rebuild(dates: Dates) -> None:
        events = only_dates(lake.bronze("audit_logs_bronze"), "event_date", dates)
        lake.gold("user_activity_summary").overwrite_dates(audit.user_activity_summary(events), dates)
        lake.gold("data_access_summary").overwrite_dates(audit.data_access_summary(events), dates)
        lake.gold("audit_actions").overwrite_dates(audit.daily_actions(events), dates)

    _on_new(lake, "audit_logs_bronze", "activity", rebuild)
    events = lambda: lake.bronze("audit_logs_bronze").where("false")
    _ensure(lake.gold("user_activity_summary"), lambda: audit.user_activity_summary(events()))
    _ensure(lake.gold("data_access_summary"), lambda: audit.data_access_summary(events()))
    _ensure(lake.gold("audit_actions"), lambda: audit.daily_actions(events()))


def recent_events(lake: Lake, fragment: str = "recipient", *, newest: int = 100) -> DataFrame:
    """The newest events whose action name contains ``fragment``, as ``audit.events_by_action`` finds them.

    Only the dates that hold them are read: the refresh counts the actions of each date.
    ``event_date`` is taken to be the date of ``event_time``; dates whose counts retention
    has dropped aren't looked at.
    """
    dates = audit.dates_of_newest(lake.gold("audit_actions").read(), fragment, newest)
    return audit.events_by_action(only_dates(lake.bronze("audit_logs_bronze"), "event_date", dates), fragment, newest=newest)


def _refresh_serving(lake: Lake) -> None:
    """Daily sums by date; attributes are rebuilt on the dates with new requests and on those of changed entities."""
    state = serving.served_entities_current(lake.bronze("served_entities_bronze"))
    current, incoming = _incoming(lake, "served_entities_current", state)
    daily, usage, costs = (lake.gold(x) for x in ("endpoint_usage_daily", "endpoint_usage_summary", "model_serving_costs"))
    filtered = {"foundation_model_usage": serving.foundation_model_usage, "external_model_usage": serving.external_model_usage}

    def name(dates: Dates) -> None:
        usage.overwrite_dates(serving.with_entities(only_dates(daily.read(), "usage_date", dates), incoming.read()), dates)
        rows = only_dates(usage.read(), "usage_date", dates)
        for dataset, build in filtered.items():
            lake.gold(dataset).overwrite_dates(build(rows), dates, emptied=True)

    def rebuild(dates: Dates) -> None:
        requests = only_dates(lake.bronze("endpoint_usage_bronze"), "_day", dates)
        daily.overwrite_dates(serving.endpoint_usage_daily(requests), dates)
        name(dates)

    _on_new(lake, "endpoint_usage_bronze", "daily", rebuild)
    _ensure(daily, lambda: serving.endpoint_usage_daily(lake.bronze("endpoint_usage_bronze")))
    _ensure(usage, lambda: serving.with_entities(daily.read().where("false"), incoming.read()))
    for dataset, build in filtered.items():
        _ensure(lake.gold(dataset), lambda build=build: build(usage.read().where("false")))
    changed = changed_entities(current.read(), incoming.read(), serving.ENTITY_KEY, serving.ENTITY_ATTRIBUTES)
    if dates := dates_of_entities(changed, daily.read(), serving.ENTITY_KEY, "usage_date"):
        name(dates)

    by_date = lake.gold("serving_costs_daily")
    if by_date.exists():
        if not costs.exists():
            every = balanced(serving.with_endpoint_entity(by_date.read(), incoming.read()), "usage_date", by_date.dates())
            costs.replace(every, laid_out=True)
        before, now = serving.endpoint_entities(current.read()), serving.endpoint_entities(incoming.read())
        changed = changed_entities(before, now, serving.ENDPOINT_KEY, serving.ENDPOINT_ATTRIBUTES)
        if dates := dates_of_entities(changed, by_date.read(), serving.ENDPOINT_KEY, "usage_date"):
            _cost_endpoints(lake, incoming, dates)
    current.replace(incoming.read())


def _cost_endpoints(lake: Lake, served: Table, dates: Dates) -> None:
    """Serving costs of the dates with the entities at their endpoints."""
    costs = only_dates(lake.gold("serving_costs_daily").read(), "usage_date", dates)
    lake.gold("model_serving_costs").overwrite_dates(serving.with_endpoint_entity(costs, served.read()), dates)


def _refresh_tracking(lake: Lake, latest: bool) -> None:
    """Daily runs, and the states that the experiments' summary is merged from, by date.

    With ``latest`` a new version may move a run to another date: all dates that hold a
    version of a run with new ones are written again.
    """
    experiments = lake.bronze("mlflow_experiments_bronze")
    lake.gold("mlflow_experiments").replace(tracking.latest_experiments(experiments) if latest else experiments)
    summary, states = lake.gold("mlflow_runs_summary"), lake.gold("mlflow_run_states")

    def rebuild(dates: Dates) -> None:
        runs = lake.bronze("mlflow_runs_bronze")
        if latest:
            versions, dates = whole_entities(runs, dates, "_day", tracking.RUN_KEY)
            runs = tracking.latest_runs(versions)
        runs = only_dates(runs, "_day", dates)
        summary.overwrite_dates(tracking.mlflow_runs_summary(runs), dates, emptied=latest)
        states.overwrite_dates(tracking.daily_run_states(runs), dates, emptied=latest)

    _on_new(lake, "mlflow_runs_bronze", "daily", rebuild)
    none = lambda: lake.bronze("mlflow_runs_bronze").where("false")
    _ensure(summary, lambda: tracking.mlflow_runs_summary(none()))
    _ensure(states, lambda: tracking.daily_run_states(none()))


def run_daily(
    lake: Lake, *, as_of: Day = None, compact_days: int | None = 7, bronze_days: int | None = None, aggregate_days: int | None = None
) -> DataFrame:
    """Write the rollups whose tables are there, bring the clustered copies up to date, compact; returns a report.

    Dates of bronze tables that many loads have added files to are merged, as far as every
    consumer has read them; copies of four tables are kept in cluster order. Each run writes the dates of the copies that have
    new rows, however old, and those without a date. Dated tables get even files in the
    ``compact_days`` days up to ``as_of`` (None: in all); this changes no content. Dates
    older than ``bronze_days`` or ``aggregate_days`` are dropped at the end (None: kept;
    ``layout.BRONZE_DAYS`` and ``layout.AGGREGATE_DAYS`` are the usual numbers). A step that
    fails is reported and the others go on.
    """
    gold = lambda name: lake.gold(name).read()
    builds = {
        "cost_weekly_rollup": lambda: rollups.cost_weekly_rollup(gold("cost_by_product")),
        "cost_monthly_rollup": lambda: rollups.cost_monthly_rollup(gold("cost_by_product")),
        "job_performance_trends": lambda: rollups.job_performance_trends(gold("job_runs_summary"), as_of=as_of),
        "cost_anomalies": lambda: rollups.cost_anomalies(gold("cost_by_product"), as_of=as_of),
        "top_consumers_30d": lambda: rollups.top_consumers_30d(gold("cost_by_job"), as_of=as_of),
        "user_activity_30d": lambda: rollups.user_activity_30d(gold("user_activity_summary"), as_of=as_of),
        "job_success_rate_weekly": lambda: rollups.job_success_rate_weekly(gold("job_runs_summary")),
        "cost_trend_analysis": lambda: rollups.cost_trend_analysis(gold("cost_by_product")),
    }
    steps = {name: lambda name=name, build=build: lake.rollup(name).replace(build()) for name, build in builds.items()}
    steps |= {name: partial(_refresh_clustered, lake, name) for name in CLUSTER_COLUMNS}
    failed = [row for row in together(partial(_reported, name, step) for name, step in steps.items()) if row]
    tables = {name: lake.gold(name) for name in COMPACTED if lake.gold(name).exists()}
    compacted = compact_all(lake.spark, tables, None if compact_days is None else _last_dates(lake.spark, as_of, compact_days))
    steps = {name: partial(_merge_bronze, lake, name) for name in BRONZE}
    failed += [row for row in together(partial(_reported, name, step) for name, step in steps.items()) if row]
    dropped = {}
    if bronze_days is not None:
        dropped |= {name: partial(_retain_bronze, lake, name, bronze_days, as_of) for name, spec in BRONZE.items() if spec.date_col}
    if aggregate_days is not None:
        dropped |= {name: partial(retain, lake.gold(name), aggregate_days, as_of=as_of) for name in _DATED if lake.gold(name).exists()}
    failed += [row for row in together(partial(_reported, name, step) for name, step in dropped.items()) if row]
    return compacted.unionByName(lake.spark.createDataFrame(failed, compacted.schema))


def _merge_bronze(lake: Lake, name: str) -> None:
    path = lake.bronze_path(name)
    if has_files(lake.spark, path):
        upto = consumed(lake.spark, f"{lake.root}/checkpoints", name, path)
        merge_loads(lake.spark, path, BRONZE[name].date_col, lake.bronze(name).schema, upto)


def _retain_bronze(lake: Lake, name: str, days: int, as_of: Day) -> None:
    if has_files(lake.spark, lake.bronze_path(name)):
        retain_bronze(lake.spark, lake.bronze_path(name), BRONZE[name].date_col, days, as_of=as_of)
        copy = lake.clustered(name)
        if name in CLUSTER_COLUMNS and copy.exists():
            retain(copy, days, as_of=as_of)


def _last_dates(spark: SparkSession, as_of: Day, days: int) -> list[dt.date]:
    newest = spark.range(1).select(day_of(as_of)).first()[0]
    return [newest - dt.timedelta(days=i) for i in range(days)]


def _reported(name: str, step: Callable[[], None]) -> tuple | None:
    try:
        step()
    except FAILURES as error:
        return name, None, first_line(error)


def _refresh_clustered(lake: Lake, name: str) -> None:
    copy = lake.clustered(name)

    def rebuild(dates: Dates) -> None:
        refresh_clustered(copy, only_dates(lake.bronze(name), copy.date_col, dates), CLUSTER_COLUMNS[name])

    _on_new(lake, name, "clustered", rebuild)


def run_publish(
    lake: Lake,
    target: str,
    shares: Iterable[Share] | None = None,
    *,
    views: Collection[str] = (),
    renew: bool = False,
) -> DataFrame:
    """Publish the given tables, by default (None) all shared ones; returns the report."""
    tables: dict[str, Table | Stored] = {}
    for name in shared_names():
        if name in BRONZE:
            if has_files(lake.spark, lake.bronze_path(name)):
                tables[name] = Stored(lake.bronze(name), BRONZE[name].date_col)
        else:
            gold, rollup = lake.gold(name), lake.rollup(name)
            tables[name] = gold if gold.exists() else rollup
    chosen = [Share(n) for n in shared_names()] if shares is None else shares
    return publish(lake.spark, tables, target, chosen, views=views, renew=renew)


def register_reports(lake: Lake, *, as_of: Day = None, prefix: str = "") -> list[str]:
    """Register the 24 reports over the stored tables as temporary views, to be queried by name.

    Reports whose tables aren't there are left out; returns the names that are registered.
    """
    views = {}
    for name, (report, inputs) in REPORTS.items():
        if all(lake.gold(x).exists() for x in inputs):
            views[f"{prefix}{name}"] = report(*(lake.gold(x).read() for x in inputs), as_of=as_of)
    create_views(views)
    return list(views)


def run_consolidate(spark: SparkSession, sources: Mapping[str, str], *, as_of: Day = None) -> dict[str, DataFrame]:
    """The consolidated datasets and their comparisons over folders that other workspaces have published.

    ``sources`` names each provider's folder. A dataset is the union of the providers that
    have it; one that none has is left out, and so are comparisons that need it.
    """
    found: dict[str, DataFrame] = {}
    for name, dataset in consolidated.CONSOLIDATED.items():
        parts = {s: spark.read.parquet(f"{p.rstrip('/')}/{dataset}") for s, p in sources.items() if is_written(spark, f"{p.rstrip('/')}/{dataset}")}
        if parts:
            found[name] = consolidate(parts)
    costs, aiml, usage = (found.get(x) for x in ("all_cost_by_product", "all_aiml_summary", "all_endpoint_usage"))
    if costs is not None:
        found["monthly_spend_by_account"] = consolidated.monthly_spend_by_account(costs, as_of=as_of)
        found["account_comparison"] = consolidated.account_comparison(costs, as_of=as_of)
    if aiml is not None and usage is not None:
        found["aiml_spend_comparison"] = consolidated.aiml_spend_comparison(aiml, usage, as_of=as_of)
    return found
