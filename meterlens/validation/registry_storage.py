"""Registered queries that write: ingestion, stored tables, maintenance, publishing.

Each writes to a new folder under the session's shared folder and reads back what it
stored, so its twin checks the content that went through.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.functions import SCOPE
from meterlens.jobs import Lake, recent_events, register_reports, run_consolidate, run_daily, run_refresh
from meterlens.operators import change_feed, extract_current_scd2
from meterlens.operators.changes import replayed
from meterlens.sources.feeds import Probe, read_snapshot, source_probe, union_evolving
from meterlens.sources.layout import CLUSTER_COLUMNS, clustered, compact, compact_dates, merge_loads, retain, retain_bronze, zordered
from meterlens.sources.publish import Share, publish
from meterlens.sources.scratch import new_folder
from meterlens.sources.tables import Table, create_views
from meterlens.streaming.ingest import BRONZE, bronze_stream, ingest, ingest_feed, newest_load, read_bronze
from meterlens.validation.fixtures import ACCOUNT, BILLING_DAY, EVENTS_DAY, WORKSPACE, raw_feed
from meterlens.validation.registry import _MONEY, _add
from meterlens.validation.world import World

_SCOPE_SQL = "_account_identifier, _workspace_identifier, workspace_id"
_STAMP_SQL = "'acct_a' _account_identifier, 'ws_a' _workspace_identifier"

# What is checked of each bronze table: an id and a time column, and a number to sum.
_BRONZE_CHECKS = {
    "billing_usage_bronze": ("sku_name", "usage_start_time", "usage_quantity"),
    "jobs_bronze": ("job_id", "change_time", "1"),
    "job_runs_bronze": ("run_id", "period_end_time", "1"),
    "clusters_bronze": ("cluster_id", "change_time", "num_workers"),
    "audit_logs_bronze": ("action_name", "event_time", "1"),
    "served_entities_bronze": ("served_entity_id", "change_time", "1"),
    "endpoint_usage_bronze": ("served_entity_id", "request_time", "input_token_count"),
    "mlflow_experiments_bronze": ("experiment_id", "update_time", "1"),
    "mlflow_runs_bronze": ("run_id", "start_time", "1"),
    "mlflow_metrics_bronze": ("metric_id", "metric_time", "step"),
}


def _ingested(w: World, table: str) -> DataFrame:
    folder = new_folder(w.spark, table)
    stream = raw_feed(w.spark, w.sf_dir, BRONZE[table].feed, stream=True)
    rows = bronze_stream(stream, table, ACCOUNT, WORKSPACE)
    ingest(rows, table, f"{folder}/table", f"{folder}/checkpoint")
    return read_bronze(w.spark, f"{folder}/table", table)


def _checked(bronze: DataFrame, ids: str, time: str, number: str) -> DataFrame:
    return bronze.groupBy(*SCOPE).agg(
        F.count("*").alias("row_count"),
        F.count_distinct(ids).alias("ids"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
        F.sum(F.expr(number).cast("double")).alias("total"),
    )


for _table, _check in _BRONZE_CHECKS.items():
    _id, _time, _number = _check
    _add(
        f"s_{_table}",
        lambda w, table=_table, check=_check: _checked(_ingested(w, table), *check),
        f"""select {_STAMP_SQL}, workspace_id, count(*) row_count, count(distinct {_id}) ids, min({_time}) first_time,
 max({_time}) last_time, sum(cast({_number} as double)) total from {BRONZE[_table].feed} group by all""",
        text="first_time last_time",
    )


_ACTIVITY_FEEDS = ["jobs", "job_run_timeline"]


def _refreshed(w: World) -> Lake:
    """Activity arriving in two loads that share dates, each followed by a refresh."""
    folder = new_folder(w.spark, "refresh")
    lake = Lake(w.spark, f"{folder}/lake", ACCOUNT, WORKSPACE)
    early = F.col("workspace_id").isin("0", "1")
    for part in (early, ~early):
        for feed in _ACTIVITY_FEEDS:
            raw_feed(w.spark, w.sf_dir, feed).where(part).write.mode("append").parquet(f"{folder}/in/{feed}")
        run_refresh(lake, {feed: f"{folder}/in/{feed}" for feed in _ACTIVITY_FEEDS})
    return lake


_add(
    "s_incremental_refresh",
    lambda w: _refreshed(w).gold("job_runs_summary").read(),
    "select * from job_runs_summary",
    text="run_date",
    count="total_runs successful_runs failed_runs canceled_runs p95_duration_seconds",
    stat="avg_duration_seconds",
)


# Entity feeds before the second load: older versions with other attributes.
_BEFORE = {
    "jobs": {"name": "concat('old ', name)"},
    "served_entities": {"entity_type": "if(entity_type = 'EXTERNAL_MODEL', 'CUSTOM', 'EXTERNAL_MODEL')", "entity_name": "'old'"},
}
_WHOLE = {"list_prices", "experiments_latest"}  # there from the start


def _changing_entities(w: World, feeds: list[str], early: str, **options) -> Lake:
    """Two loads that share dates, each followed by a refresh; entities have other attributes after the first.

    ``early`` tells which rows of the other feeds come first.
    """
    folder = new_folder(w.spark, "loads")
    lake = Lake(w.spark, f"{folder}/lake", ACCOUNT, WORKSPACE)
    for first in (True, False):
        for feed in feeds:
            rows = raw_feed(w.spark, w.sf_dir, feed)
            if feed in _BEFORE:
                if first:
                    older = {"change_time": "change_time - interval 5000 days"} | _BEFORE[feed]
                    rows = rows.withColumns({c: F.expr(e).cast(rows.schema[c].dataType) for c, e in older.items()})
            elif feed in _WHOLE:
                rows = rows if first else rows.where("false")
            else:
                rows = rows.where(F.expr(early) if first else ~F.expr(early))
            rows.write.mode("append").parquet(f"{folder}/in/{feed}")
        run_refresh(lake, {feed: f"{folder}/in/{feed}" for feed in feeds}, **options)
    return lake


_EARLY = "workspace_id in ('0', '1')"
_ODD_HOURS = "hour(period_start_time) % 2 = 1"
_RUN_CASTS = {"text": "run_date", "count": "total_runs successful_runs failed_runs canceled_runs p95_duration_seconds", "stat": "avg_duration_seconds"}
_JOB_FEEDS = ["jobs", "job_run_timeline"]
_SERVING_FEEDS = ["served_entities", "endpoint_usage"]
_COST_FEEDS = ["usage", "list_prices", *_SERVING_FEEDS]
_TOKENS = "total_input_tokens total_output_tokens total_tokens request_count"
_INVENTORY = ["served_entity_id", "endpoint_name", "entity_type", "entity_name", "change_time", "total_cost_usd_30d", "last_billing_date"]
_add("s_refresh_jobs", lambda w: _changing_entities(w, _JOB_FEEDS, _EARLY).gold("job_runs_summary").read(), "select * from job_runs_summary", **_RUN_CASTS)
_add(
    "s_refresh_jobs_merged",
    lambda w: _changing_entities(w, _JOB_FEEDS, _ODD_HOURS, merge_slices=True).gold("job_runs_summary").read(),
    "select * from job_runs_merged",
    **_RUN_CASTS,
)
_add(
    "s_refresh_serving",
    lambda w: _changing_entities(w, _SERVING_FEEDS, _EARLY).gold("endpoint_usage_summary").read().drop("endpoint_id", "served_entity_name"),
    "select * from endpoint_usage_summary",
    count=_TOKENS,
    text="usage_date first_request last_request",
)
_add(
    "s_refresh_external_usage",
    lambda w: _changing_entities(w, _SERVING_FEEDS, _EARLY).gold("external_model_usage").read(),
    "select * from external_model_usage",
    count=_TOKENS,
    text="usage_date",
)
_COST_LAKES: dict[tuple[str, str], Lake] = {}


def _cost_lake(w: World) -> Lake:
    """The lake that the two queries below read, made once in an application."""
    key = w.spark.sparkContext.applicationId, w.sf_dir
    if key not in _COST_LAKES:
        _COST_LAKES[key] = _changing_entities(w, _COST_FEEDS, _EARLY, datasets=["endpoint_cost_states"])
    return _COST_LAKES[key]


_add(
    "s_refresh_serving_costs",
    lambda w: _cost_lake(w).gold("model_serving_costs").read(),
    "select * from model_serving_costs",
    double=_MONEY,
    text="usage_date",
)
_add(
    "s_refresh_inventory",
    lambda w: _cost_lake(w).gold("endpoint_inventory").read().select(*SCOPE, *_INVENTORY),
    "select * from endpoint_inventory",
    double="total_cost_usd_30d",
    text="change_time last_billing_date",
    drop="endpoint_delete_time",
)
_add(
    "s_refresh_tracking",
    lambda w: _changing_entities(w, ["experiments_latest", "runs_latest"], _EARLY).gold("mlflow_experiments_summary").read(),
    "select * from mlflow_experiments_summary",
    text="creation_time last_update_time first_run last_run",
)


def _snapshot(w: World) -> DataFrame:
    folder = new_folder(w.spark, "snapshot")
    raw_feed(w.spark, w.sf_dir, "workspaces_latest").write.parquet(folder)
    taken = read_snapshot(w.spark, "workspaces_latest", folder, account=ACCOUNT, workspace=WORKSPACE, snapshot_time=True)
    return taken.withColumn("_snapshot_time", F.col("_snapshot_time").isNotNull()).drop("create_time")


_add("s_snapshot", _snapshot, f"select {_STAMP_SQL}, *, true _snapshot_time from workspaces_latest")


def _stored_activity(w: World) -> Table:
    table = Table(w.spark, new_folder(w.spark, "user_activity_summary"), "event_date")
    table.replace(w.user_activity)
    return table


def _replaced_from_itself(w: World) -> DataFrame:
    table = _stored_activity(w)
    table.replace(table.read())
    return table.read()


def _compacted(w: World) -> DataFrame:
    table = _stored_activity(w)
    compact(table, ["workspace_id"])
    return table.read()


def _compacted_dates(w: World) -> DataFrame:
    table = _stored_activity(w)
    compact_dates(table, [EVENTS_DAY - dt.timedelta(days=i) for i in range(7)], ["workspace_id"])
    return table.read()


for _name, _build in {
    "s_write_table": _replaced_from_itself,
    "s_compact": _compacted,
    "s_compact_dates": _compacted_dates,
}.items():
    _add(_name, _build, "select * from user_activity_summary", text="event_date first_activity last_activity")


def _clustered_audit(w: World) -> DataFrame:
    folder = new_folder(w.spark, "clustered")
    clustered(w.feed("audit"), CLUSTER_COLUMNS["audit_logs_bronze"], 4).write.parquet(folder)
    return w.spark.read.parquet(folder).select(*SCOPE, "event_time", "event_date", "service_name", "action_name", "source_ip_address")


_add(
    "s_cluster_layout",
    _clustered_audit,
    f"select {_STAMP_SQL}, workspace_id, event_time, event_date, service_name, action_name, source_ip_address from audit",
    text="event_time event_date",
)


def _by_view(w: World) -> DataFrame:
    create_views({"product_costs": w.by_product})
    return w.spark.sql("SELECT billing_origin_product, SUM(total_cost_usd) AS total_cost_usd FROM product_costs GROUP BY ALL")


_add(
    "s_named_view",
    _by_view,
    "select billing_origin_product, sum(total_cost_usd) total_cost_usd from cost_by_product group by all",
    double="total_cost_usd",
)


def _published(w: World) -> DataFrame:
    target = new_folder(w.spark, "share")
    tables = {"user_activity_summary": _stored_activity(w)}
    share = Share("user_activity_summary", alias="workspace_activity", only=("workspace_id", "2"))
    publish(w.spark, tables, target, [share, Share("cost_by_sku")])
    return w.spark.read.parquet(f"{target}/workspace_activity")


_add(
    "s_publish",
    _published,
    "select * from user_activity_summary where workspace_id = '2'",
    text="event_date first_activity last_activity",
)


def _publish_report(w: World) -> DataFrame:
    """One that is written, one written before, one whose read fails, one missing, and a view."""
    target = new_folder(w.spark, "share")
    broken = new_folder(w.spark, "broken")
    w.spark.range(5).selectExpr("cast(id as string) as value").write.text(broken)
    tables = {
        "user_activity_summary": _stored_activity(w),
        "cost_by_sku": w.by_product,
        "cost_by_job": w.spark.read.schema("a INT").parquet(broken),
    }
    publish(w.spark, tables, target, [Share("cost_by_sku")])
    shares = [Share(n) for n in ("user_activity_summary", "cost_by_sku", "cost_by_job", "jobs_current", "v_daily_spend_trend")]
    report = publish(w.spark, tables, target, shares, views=["v_daily_spend_trend"])
    return report.withColumn("detail", F.when(F.col("status") == "error", "failed").otherwise(F.col("detail")))


_add(
    "s_publish_report",
    _publish_report,
    """select * from (values ('user_activity_summary', 'user_activity_summary', 'added', null), ('cost_by_sku', 'cost_by_sku', 'skipped', 'already published'),
 ('cost_by_job', 'cost_by_job', 'error', 'failed'), ('jobs_current', 'jobs_current', 'skipped', 'missing'),
 ('v_daily_spend_trend', 'v_daily_spend_trend', 'skipped', 'view')) t(name, published_as, status, detail)""",
)


def _clustered_bronze(w: World) -> DataFrame:
    """The daily job's copy after two loads; the second brings dates long before those of the first."""
    folder = new_folder(w.spark, "clustered-bronze")
    lake = Lake(w.spark, f"{folder}/lake", ACCOUNT, WORKSPACE)
    audit = raw_feed(w.spark, w.sf_dir, "audit")
    late = (F.col("event_date") < F.lit(EVENTS_DAY - dt.timedelta(days=20))) | F.col("event_date").isNull()
    for part in (~late, late):
        audit.where(part).write.mode("append").parquet(f"{folder}/in/audit")
        run_refresh(lake, {"audit": f"{folder}/in/audit"})
        run_daily(lake, as_of=EVENTS_DAY)
    copy = lake.clustered("audit_logs_bronze").read()
    return copy.select(*SCOPE, "event_time", "event_date", "service_name", "action_name", "source_ip_address")


_add(
    "s_clustered_bronze",
    _clustered_bronze,
    f"select {_STAMP_SQL}, workspace_id, event_time, event_date, service_name, action_name, source_ip_address from audit",
    text="event_time event_date",
)


def _report_by_name(w: World) -> DataFrame:
    """A report read by its name from a refreshed lake."""
    register_reports(_billing_lake(w), as_of=BILLING_DAY, prefix="lake_")
    return w.spark.sql("SELECT * FROM lake_v_daily_spend_trend")


def _billing_lake(w: World) -> Lake:
    folder = new_folder(w.spark, "reports")
    lake = Lake(w.spark, f"{folder}/lake", ACCOUNT, WORKSPACE)
    for feed in ("usage", "list_prices"):
        raw_feed(w.spark, w.sf_dir, feed).write.parquet(f"{folder}/in/{feed}")
    run_refresh(lake, {feed: f"{folder}/in/{feed}" for feed in ("usage", "list_prices")}, datasets=[])
    return lake


_add(
    "s_report_by_name",
    _report_by_name,
    "select * from v_daily_spend_trend",
    double=f"{_MONEY} cumulative_cost_usd",
    text="usage_date",
)


def _refreshed_billing(w: World) -> DataFrame:
    """Two loads of usage at other prices, then the right prices: the stored sums must follow."""
    folder = new_folder(w.spark, "billing")
    half = F.pmod(F.xxhash64("record_id"), F.lit(2)) == 0
    lake = Lake(w.spark, f"{folder}/lake", ACCOUNT, WORKSPACE)
    prices = raw_feed(w.spark, w.sf_dir, "list_prices")
    other = prices.withColumn("pricing", F.struct((F.col("pricing.default") * 2).cast("decimal(18,4)").alias("default")).cast(prices.schema["pricing"].dataType))
    for part, price_list in ((half, other), (~half, other), (F.lit(False), prices)):
        raw_feed(w.spark, w.sf_dir, "usage").where(part).write.mode("append").parquet(f"{folder}/in/usage")
        price_list.write.mode("overwrite").parquet(f"{folder}/in/list_prices")
        run_refresh(lake, {feed: f"{folder}/in/{feed}" for feed in ("usage", "list_prices")}, datasets=["cost_by_product"])
    return lake.gold("cost_by_product").read()


_add(
    "s_refresh_billing",
    _refreshed_billing,
    "select * from cost_by_product",
    double=_MONEY,
    text="usage_date",
)


def _consolidated(w: World) -> DataFrame:
    """Two published folders as one dataset."""
    target = new_folder(w.spark, "providers")
    for name in ("east", "west"):
        publish(w.spark, {"cost_by_product": w.by_product}, f"{target}/{name}", [Share("cost_by_product")])
    found = run_consolidate(w.spark, {name: f"{target}/{name}" for name in ("east", "west", "none_yet")}, as_of=BILLING_DAY)
    return found["all_cost_by_product"]


_add(
    "s_consolidate",
    _consolidated,
    "select source, c.* from cost_by_product c, (values ('east'), ('west')) s(source)",
    double=_MONEY,
    text="usage_date",
)

# Feeds probed, with a date column and a number of days where only recent rows count.
_PROBED = {
    "usage": ("usage_date", 7, BILLING_DAY),
    "list_prices": (None, None, BILLING_DAY),
    "audit": ("event_date", 1, EVENTS_DAY),
    "workspaces_latest": (None, None, BILLING_DAY),
    "clusters": (None, None, BILLING_DAY),
    "jobs": (None, None, BILLING_DAY),
    "served_entities": (None, None, BILLING_DAY),
    "experiments_latest": (None, None, BILLING_DAY),
}


def _probed(w: World) -> DataFrame:
    reports = []
    for day in (BILLING_DAY, EVENTS_DAY):
        probes = {
            feed: Probe(lambda feed=feed: w.feed(feed), date_col, days)
            for feed, (date_col, days, clock) in _PROBED.items()
            if clock == day
        }
        reports.append(source_probe(w.spark, probes, as_of=day))
    missing = {"no_such_feed": Probe(lambda: w.spark.read.parquet(f"{w.sf_dir}/no_such_feed.parquet"))}
    reports.append(source_probe(w.spark, missing))
    report = union_evolving(*reports)
    return report.withColumn("error", F.col("error").isNotNull())


def _probe_sql() -> str:
    parts = []
    for feed, (date_col, days, clock) in _PROBED.items():
        newest = f"max({date_col})" if date_col else "cast(null as date)"
        recent = f" filter (where {date_col} >= DATE '{clock}' - {days})" if days else ""
        parts.append(f"select '{feed}' feed, count(*){recent} row_count, {newest} newest_date, false error from {feed}")
    parts.append("select 'no_such_feed', null, null, true")
    return "\nunion all ".join(parts)


_add("s_source_probe", _probed, _probe_sql(), text="newest_date")

# --- two states of the jobs, and what changed between them
_EARLIER = dt.datetime(2001, 1, 1)


def _job_changes(w: World) -> DataFrame:
    history = w.feed("jobs").select(*SCOPE, "job_id", "name", "run_as", "tags", "change_time", "delete_time")
    state = lambda h: extract_current_scd2(h, ["workspace_id", "job_id"]).drop("delete_time")
    before = state(history.where(F.col("change_time") < F.lit(_EARLIER)))
    return change_feed(before, state(history), [*SCOPE, "job_id"]).drop("tags")


_STATE_SQL = f"""(select {_STAMP_SQL}, workspace_id, job_id, name, run_as, change_time from (select *, row_number() over (
 partition by workspace_id, job_id order by change_time desc) rn from jobs {{where}}) where rn = 1 and delete_time is null)"""
_BEFORE_SQL = _STATE_SQL.format(where=f"where change_time < timestamp '{_EARLIER}'")
_AFTER_SQL = _STATE_SQL.format(where="")
_add(
    "s_change_feed",
    _job_changes,
    f"""select 'insert' _change_type, a.* from {_AFTER_SQL} a anti join {_BEFORE_SQL} b using (workspace_id, job_id)
 union all select 'delete', b.* from {_BEFORE_SQL} b anti join {_AFTER_SQL} a using (workspace_id, job_id)
 union all select 'update_preimage', b.* from {_BEFORE_SQL} b join {_AFTER_SQL} a using (workspace_id, job_id)
  where (a.name, a.run_as, a.change_time) is distinct from (b.name, b.run_as, b.change_time)
 union all select 'update_postimage', a.* from {_BEFORE_SQL} b join {_AFTER_SQL} a using (workspace_id, job_id)
  where (a.name, a.run_as, a.change_time) is distinct from (b.name, b.run_as, b.change_time)""",
    text="change_time",
)


def _evolved(w: World) -> DataFrame:
    """Files written before and after a column was added, read as one table."""
    folder = new_folder(w.spark, "evolving")
    metrics = w.feed("run_metrics_history").select(*SCOPE, "metric_id", "metric_name", "metric_value")
    is_old = F.col("metric_name") == "loss"
    metrics.where(is_old).drop("metric_value").write.parquet(f"{folder}/part=1")
    metrics.where(~is_old).write.parquet(f"{folder}/part=2")
    return read_bronze(w.spark, folder, merge_schema=True).drop("part")


_add(
    "s_evolve_schema",
    _evolved,
    f"""select {_STAMP_SQL}, workspace_id, metric_id, metric_name, case when metric_name <> 'loss' then metric_value end metric_value
 from run_metrics_history""",
)


def _retained(w: World) -> DataFrame:
    table = Table(w.spark, new_folder(w.spark, "retain"), "usage_date")
    table.replace(w.by_product.where(F.col("usage_date") >= F.lit(BILLING_DAY - dt.timedelta(days=400))))
    retain(table, 365, as_of=BILLING_DAY)
    return table.read()


_add(
    "s_retain",
    _retained,
    f"select * from cost_by_product where usage_date >= DATE '{BILLING_DAY}' - 365",
    double=_MONEY,
    text="usage_date",
)


_AUDIT_COLUMNS = ["event_time", "event_date", "service_name", "action_name", "source_ip_address"]
_AUDIT_SQL = f"select {_STAMP_SQL}, workspace_id, {', '.join(_AUDIT_COLUMNS)} from audit"


def _merged_bronze(w: World) -> DataFrame:
    """Audit events in ten loads that share all dates, merged after the eighth and after the last."""
    folder, table = new_folder(w.spark, "merged"), "audit_logs_bronze"
    audit = raw_feed(w.spark, w.sf_dir, "audit").withColumn("_part", F.pmod(F.xxhash64("event_time", "action_name"), F.lit(10)))
    for part in range(10):
        audit.where(F.col("_part") == part).drop("_part").write.mode("append").parquet(f"{folder}/in")
        ingest_feed(w.spark, table, f"{folder}/in", f"{folder}/table", f"{folder}/checkpoint", account=ACCOUNT, workspace=WORKSPACE)
        if part in (7, 9):
            merge_loads(w.spark, f"{folder}/table", "event_date", read_bronze(w.spark, f"{folder}/table", table).schema, newest_load(w.spark, f"{folder}/table"), most_files=2)
    return read_bronze(w.spark, f"{folder}/table", table).select(*SCOPE, *_AUDIT_COLUMNS)


_add("s_bronze_compacted", _merged_bronze, _AUDIT_SQL, text="event_time event_date")


def _recent_recipients(w: World) -> DataFrame:
    """Audit events in two loads that share dates, then the newest on recipients from the dates that hold them."""
    folder = new_folder(w.spark, "recipients")
    feed = raw_feed(w.spark, w.sf_dir, "audit").withColumn("_part", F.pmod(F.xxhash64("event_time", "action_name"), F.lit(2)))
    lake = Lake(w.spark, f"{folder}/lake", ACCOUNT, WORKSPACE)
    for part in range(2):
        feed.where(F.col("_part") == part).drop("_part").write.mode("append").parquet(f"{folder}/in")
        run_refresh(lake, {"audit": f"{folder}/in"})
    return recent_events(lake).select(*SCOPE, *_AUDIT_COLUMNS)


_add(
    "recipient_events_pruned",
    _recent_recipients,
    f"""{_AUDIT_SQL} where action_name like '%recipient%'
 order by event_time desc, workspace_id, action_name, service_name limit 100""",
    text="event_time event_date",
)


def _retained_lake(w: World) -> DataFrame:
    """Audit events, some of them without a date, with 20 days of bronze kept."""
    folder, table = new_folder(w.spark, "retained"), "audit_logs_bronze"
    undated = F.when(F.col("action_name") != "getTable", F.col("event_date"))
    raw_feed(w.spark, w.sf_dir, "audit").withColumn("event_date", undated).write.parquet(f"{folder}/in")
    ingest_feed(w.spark, table, f"{folder}/in", f"{folder}/table", f"{folder}/checkpoint", account=ACCOUNT, workspace=WORKSPACE)
    retain_bronze(w.spark, f"{folder}/table", "event_date", 20, as_of=EVENTS_DAY)
    return read_bronze(w.spark, f"{folder}/table", table).select(*SCOPE, *_AUDIT_COLUMNS)


_add(
    "s_retain_lake",
    _retained_lake,
    f"""select * replace (case when action_name <> 'getTable' then event_date end as event_date) from ({_AUDIT_SQL})
 where action_name = 'getTable' or event_date >= DATE '{EVENTS_DAY}' - 20""",
    text="event_time event_date",
)


_ACTIVITY_KEYS = [*SCOPE, "event_date", "user_email", "service_name"]


def _followed(w: World) -> DataFrame:
    """User activity refreshed from two loads, as a stream of its changes tells it."""
    folder = new_folder(w.spark, "followed")
    lake = Lake(w.spark, f"{folder}/lake", ACCOUNT, WORKSPACE, {"user_activity_summary": _ACTIVITY_KEYS})
    early = F.col("workspace_id").isin("0", "1") | (F.col("action_name") == "getTable")
    for part in (early, ~early):
        raw_feed(w.spark, w.sf_dir, "audit").where(part).write.mode("append").parquet(f"{folder}/in")
        run_refresh(lake, {"audit": f"{folder}/in"})
        told = lake.gold("user_activity_summary").read_changes().writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
        told.trigger(availableNow=True).start(f"{folder}/told").awaitTermination()
    return replayed(w.spark.read.parquet(f"{folder}/told"), _ACTIVITY_KEYS)


_add("s_change_stream", _followed, "select * from user_activity_summary", text="event_date first_activity last_activity")


def _zordered_runs(w: World) -> DataFrame:
    """ML runs laid out by start and experiment alike, in a table that is compacted once more."""
    table = Table(w.spark, new_folder(w.spark, "zordered"))
    runs = w.feed("runs_latest").select(*SCOPE, "run_id", "experiment_id", "start_time", "status")
    table.replace(zordered(runs, CLUSTER_COLUMNS["mlflow_runs_bronze"], 8), laid_out=True)
    compact(table, CLUSTER_COLUMNS["mlflow_runs_bronze"], interleave=True)
    return table.read()


_add("s_zordered", _zordered_runs, f"select {_STAMP_SQL}, workspace_id, run_id, experiment_id, start_time, status from runs_latest", text="start_time")
