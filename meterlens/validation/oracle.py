"""DuckDB SQL twins of the registered queries.

``RELATIONS`` names each dataset and report once, written the long way round (joins of
periods, distinct counts over the base rows), independently of how the Spark operators
compute it. ``oracle`` puts the relations a query needs in front of it as CTEs and
brings the result's columns to the plain types that the Spark side reports.
"""

from __future__ import annotations

import re

from meterlens.validation.fixtures import BILLING_DAY, CLOCK_GAP, EVENTS_DAY, MONTH_END, PROJECTIONS, projection_sql

_TODAY = f"DATE '{BILLING_DAY}'"
_MONTH_END = f"DATE '{MONTH_END}'"
_EVENTS_TODAY = f"DATE '{EVENTS_DAY}'"
_STAMP = "'acct_a' _account_identifier, 'ws_a' _workspace_identifier"
_SCOPE = "_account_identifier, _workspace_identifier, workspace_id"
_SPEND = "sum(usage_quantity) total_dbus, sum(estimated_cost_usd) total_cost_usd"
_RESPEND = "sum(total_dbus) total_dbus, sum(total_cost_usd) total_cost_usd"


def _last(days: int, col: str = "usage_date", today: str = _TODAY) -> str:
    return f"{col} >= {today} - {days} and {col} <= {today}"


def _priced(usage: str, ends_in_time: str = "u.usage_end_time <= p.price_end_time", kept: str = "record_type = 'ORIGINAL'") -> str:
    return f"""select {_STAMP}, u.*, u.usage_quantity * coalesce(p.price, 0) estimated_cost_usd
 from {usage} u left join list_prices p on u.sku_name = p.sku_name and u.cloud = p.cloud
 and u.usage_start_time >= p.price_start_time and (p.price_end_time is null or {ends_in_time})
 where {kept}"""


def _latest(source: str, keys: str, order: str = "change_time desc") -> str:
    return f"""select {_STAMP}, * exclude (rn) from
 (select *, row_number() over (partition by {keys} order by {order}) rn from {source}) where rn = 1"""


def _runs(source: str) -> str:
    return f"""select r.*, j.name job_name from (
 select {_STAMP}, workspace_id, job_id, cast(period_start_time as date) run_date, count(*) total_runs,
 sum(case when result_state = 'SUCCEEDED' then 1 else 0 end) successful_runs,
 sum(case when result_state = 'FAILED' then 1 else 0 end) failed_runs,
 sum(case when result_state = 'CANCELED' then 1 else 0 end) canceled_runs,
 avg(secs) avg_duration_seconds, max(secs) max_duration_seconds, min(secs) min_duration_seconds,
 quantile_disc(secs, 0.95) p95_duration_seconds
 from (select *, cast(epoch(date_trunc('second', period_end_time)) - epoch(date_trunc('second', period_start_time)) as bigint) as secs
  from {source}) where run_type = 'JOB_RUN' group by all) r
 left join jobs_current j on r.workspace_id = j.workspace_id and r.job_id = j.job_id"""


def _endpoint_costs(where: str, extra: str = "") -> str:
    return f"""select {_SCOPE}, usage_date, endpoint_name, sku_name{extra}, {_SPEND}, count(*) billing_records
 from billing_summary where {where} group by all"""


def _serving_costs(lines: str) -> str:
    return f"""select b.*, e.entity_type, e.entity_name from (
 select {_SCOPE}, usage_date, endpoint_name, sku_name, {_SPEND}, count(*) billing_records from {lines}
  where billing_origin_product = 'MODEL_SERVING' group by all) b
 left join (select * from (select *, row_number() over (partition by workspace_id, endpoint_name
   order by change_time desc, served_entity_id desc) rn from served_entities_current) where rn = 1) e
 on b.workspace_id = e.workspace_id and b.endpoint_name = e.endpoint_name"""


def _inventory(costs: str) -> str:
    return f"""select e.*, c.total_cost_usd_30d, c.last_billing_date from served_entities_current e left join (
 select workspace_id, endpoint_name, sum(total_cost_usd) total_cost_usd_30d, max(usage_date) last_billing_date
  from {costs} group by all) c on e.workspace_id = c.workspace_id and e.endpoint_name = c.endpoint_name"""


def _two_providers(relation: str, is_first: str) -> str:
    second = "'acct_b' as _account_identifier, 'ws_b' as _workspace_identifier"
    return f"""select 'account_a' source, * from {relation} where {is_first}
 union all select 'account_b' source, * replace ({second}) from {relation} where not ({is_first})"""


def _rolling(frame: str) -> str:
    return f"""select *, avg(cast(total_cost_usd as double)) over (w rows between 6 preceding and current row) cost_7d_rolling_avg,
 avg(cast(total_cost_usd as double)) over (w rows between 29 preceding and current row) cost_30d_rolling_avg
 from {frame} window w as (partition by {_SCOPE} order by usage_date)"""


_AIML = "('MODEL_SERVING', 'VECTOR_SEARCH', 'ONLINE_TABLES', 'FOUNDATION_MODEL_TRAINING')"
_CATEGORY = """case billing_origin_product when 'MODEL_SERVING' then 'Inference' when 'VECTOR_SEARCH' then 'Vector Search'
 when 'ONLINE_TABLES' then 'Feature Serving' when 'FOUNDATION_MODEL_TRAINING' then 'Fine-tuning' else 'Other AI/ML' end aiml_category"""
_FOUNDATION = "^databricks-(meta-llama|mixtral|dbrx|bge|gte|mpnet)"
_ZSCORE = "(daily_cost - {m}) / nullif({s}, 0)"


def _anomalies(daily: str, mean: str, stddev: str, score: str, label: str, labels: tuple[str, str, str]) -> str:
    z = _ZSCORE.format(m=mean, s=stddev)
    return f"""select *, {score.format(z=z)} z_score, case when {z} > 2 then '{labels[0]}' when {z} < -2 then '{labels[1]}'
 else '{labels[2]}' end {label} from (
 select *, avg(daily_cost) over w {mean}, stddev_samp(daily_cost) over w {stddev} from {daily}
 window w as (partition by {_SCOPE} order by usage_date rows between 29 preceding and 1 preceding)) where {mean} is not null"""


def _week(category: str, where: str, name: str) -> str:
    return f"(select {_SCOPE}, {category}, sum(total_cost_usd) {name} from {{relation}} where {where} group by all)"


def _compared(relation: str, dim: str, this: str, last: str, change: str, pct: str) -> str:
    current = _week(dim, _last(7), "c_cost").format(relation=relation)
    previous = _week(dim, f"usage_date >= {_TODAY} - 14 and usage_date < {_TODAY} - 7", "p_cost").format(relation=relation)
    keys = ["_account_identifier", "_workspace_identifier", "workspace_id", dim]
    picked = ", ".join(f"coalesce(c.{k}, p.{k}) {k}" for k in keys)
    matched = " and ".join(f"c.{k} = p.{k}" for k in keys)
    diff = "coalesce(c_cost, 0) - coalesce(p_cost, 0)"
    return f"""select {picked}, coalesce(c_cost, 0) {this}, coalesce(p_cost, 0) {last}, {diff} {change},
 round(100.0::double * cast({diff} as double) / nullif(cast(p_cost as double), 0), 2) + 0.0 {pct}
 from {current} c full outer join {previous} p on {matched}"""


RELATIONS: dict[str, str] = {
    **{feed: projection_sql(feed) for feed in PROJECTIONS},
    # current states
    "jobs_current": f"select * from ({_latest('jobs', 'workspace_id, job_id')}) where delete_time is null",
    "clusters_current": _latest("clusters", "workspace_id, cluster_id"),
    "served_entities_current": f"""select * from ({_latest('served_entities', 'workspace_id, served_entity_id')})
 where endpoint_delete_time is null""",
    # billing
    "billing_summary": _priced("usage"),
    "billing_at_start": _priced("usage", "u.usage_start_time < p.price_end_time"),
    "billing_net": _priced("usage", kept="true"),
    "cost_by_product": f"""select {_SCOPE}, usage_date, billing_origin_product, is_serverless, {_SPEND},
 count(*) record_count from billing_summary group by all""",
    "cost_by_sku": f"""select {_SCOPE}, usage_date, sku_name, cloud, usage_unit, sum(usage_quantity) total_usage,
 sum(estimated_cost_usd) total_cost_usd, count(*) record_count from billing_summary group by all""",
    "cost_by_job": f"""select {_SCOPE}, usage_date, job_id, job_name, run_as, billing_origin_product, {_SPEND},
 count(*) run_count from billing_summary where job_id is not null group by all""",
    "cost_by_user": f"""select {_SCOPE}, usage_date, run_as, billing_origin_product, {_SPEND},
 count(distinct job_id) distinct_jobs, count(*) record_count from billing_summary where run_as is not null group by all""",
    "executive_summary": f"""select {_SCOPE}, usage_date, {_SPEND},
 sum(case when billing_origin_product = 'JOBS' then estimated_cost_usd else 0 end) jobs_cost_usd,
 sum(case when billing_origin_product = 'SQL' then estimated_cost_usd else 0 end) sql_cost_usd,
 sum(case when billing_origin_product = 'DLT' then estimated_cost_usd else 0 end) dlt_cost_usd,
 sum(case when billing_origin_product = 'MODEL_SERVING' then estimated_cost_usd else 0 end) serving_cost_usd,
 sum(case when billing_origin_product = 'INTERACTIVE' then estimated_cost_usd else 0 end) interactive_cost_usd,
 sum(case when is_serverless = true then estimated_cost_usd else 0 end) serverless_cost_usd,
 sum(case when is_serverless = false then estimated_cost_usd else 0 end) classic_cost_usd
 from billing_summary group by all""",
    # jobs, compute, audit
    "job_runs_summary": _runs("job_run_timeline"),
    "merged_runs": """select workspace_id, job_id, run_id, run_type, min(period_start_time) period_start_time,
 max(period_end_time) period_end_time,
 (max(struct_pack(e := period_end_time, s := result_state)) filter (where result_state is not null)).s result_state
 from job_run_timeline group by all""",
    "job_runs_merged": _runs("merged_runs"),
    "cluster_utilization": f"""select {_STAMP}, cluster_id, date_trunc('hour', start_time) "hour",
 avg(cpu_user_percent + cpu_system_percent) avg_cpu_percent, max(cpu_user_percent + cpu_system_percent) max_cpu_percent,
 avg(mem_used_percent) avg_memory_percent, max(mem_used_percent) max_memory_percent,
 sum(network_received_bytes) total_network_in_bytes, sum(network_sent_bytes) total_network_out_bytes,
 count(*) sample_count from node_timeline group by all""",
    "user_activity_summary": f"""select {_STAMP}, workspace_id, event_date, email user_email, service_name, count(*) event_count,
 count(distinct action_name) distinct_actions, min(event_time) first_activity, max(event_time) last_activity
 from audit where email is not null group by all""",
    "data_access_summary": f"""select {_STAMP}, workspace_id, event_date, email user_email, action_name, full_name_arg table_full_name,
 count(*) access_count, min(event_time) first_access, max(event_time) last_access from audit
 where service_name = 'unityCatalog' and action_name in ('getTable', 'createTable', 'deleteTable') group by all""",
    "recipient_events": f"""select {_STAMP}, workspace_id, event_time, event_date, service_name, action_name, source_ip_address
 from audit where action_name like '%recipient%' order by event_time desc limit 100""",
    # serving
    "endpoint_usage_summary": f"""select u.*, e.endpoint_name, e.entity_type, e.entity_name from (
 select {_STAMP}, workspace_id, served_entity_id, cast(request_time as date) usage_date, sum(input_token_count) total_input_tokens,
 sum(output_token_count) total_output_tokens, sum(input_token_count + output_token_count) total_tokens,
 count(*) request_count, min(request_time) first_request, max(request_time) last_request
 from endpoint_usage group by all) u left join served_entities_current e
 on u.workspace_id = e.workspace_id and u.served_entity_id = e.served_entity_id""",
    "model_serving_costs": _serving_costs("billing_summary"),
    "foundation_model_usage": f"""select {_SCOPE}, usage_date, endpoint_name, entity_name, entity_type, total_input_tokens,
 total_output_tokens, total_tokens, request_count from endpoint_usage_summary
 where entity_type like '%FOUNDATION%' or regexp_matches(endpoint_name, '{_FOUNDATION}')""",
    "foundation_model_costs": _endpoint_costs(
        f"""billing_origin_product in ('MODEL_SERVING', 'FOUNDATION_MODEL_TRAINING') or sku_name like '%FOUNDATION%'
 or sku_name like '%TOKEN%' or regexp_matches(endpoint_name, '{_FOUNDATION}')""",
        ", billing_origin_product",
    ),
    "external_model_usage": f"""select {_SCOPE}, usage_date, endpoint_name, entity_name, total_input_tokens, total_output_tokens,
 total_tokens, request_count from endpoint_usage_summary where entity_type = 'EXTERNAL_MODEL'""",
    "endpoint_inventory": _inventory("model_serving_costs"),
    "endpoint_inventory_30d": _inventory(f"(select * from model_serving_costs where {_last(30)})"),
    "endpoint_inventory_to_date": _inventory(f"(select * from model_serving_costs where usage_date <= {_TODAY})"),
    # tracking
    "mlflow_experiments_summary": f"""select {_STAMP}, e.workspace_id, e.experiment_id, e.name, e.create_time creation_time,
 e.update_time last_update_time, case when e.delete_time is null then 'active' else 'deleted' end lifecycle_stage,
 coalesce(r.total_runs, 0) total_runs, coalesce(r.successful_runs, 0) successful_runs,
 coalesce(r.failed_runs, 0) failed_runs, r.first_run, r.last_run, coalesce(r.distinct_users, 0) distinct_users
 from experiments_latest e left join (select experiment_id, count(*) total_runs,
  count(case when status = 'FINISHED' then 1 end) successful_runs, count(case when status = 'FAILED' then 1 end) failed_runs,
  min(start_time) first_run, max(start_time) last_run, count(distinct created_by) distinct_users
  from runs_latest group by all) r on e.experiment_id = r.experiment_id""",
    "mlflow_runs_summary": f"""select {_STAMP}, workspace_id, cast(start_time as date) run_date, experiment_id, status,
 count(*) run_count, count(distinct created_by) distinct_users, avg(secs) avg_duration_seconds,
 sum(secs) total_compute_seconds from (select *,
  cast(epoch(date_trunc('second', end_time)) - epoch(date_trunc('second', start_time)) as bigint) as secs from runs_latest)
 group by all""",
    # AI/ML spend
    "vector_search_costs": _endpoint_costs("billing_origin_product = 'VECTOR_SEARCH'"),
    "vector_search_summary": f"""select {_SCOPE}, usage_date, {_RESPEND}, count(distinct endpoint_name) distinct_endpoints,
 list(distinct endpoint_name) filter (where endpoint_name is not null) endpoint_names from vector_search_costs group by all""",
    "aiml_executive_summary": f"""select {_SCOPE}, usage_date, billing_origin_product, {_SPEND},
 count(distinct endpoint_name) distinct_endpoints, count(distinct run_as) distinct_users, {_CATEGORY}
 from billing_summary where billing_origin_product in {_AIML} group by all""",
    # rollups
    "cost_weekly_rollup": f"""select {_SCOPE}, cast(date_trunc('week', usage_date) as date) week_start, billing_origin_product,
 {_RESPEND}, sum(record_count) record_count from cost_by_product group by all""",
    "cost_monthly_rollup": f"""select {_SCOPE}, cast(date_trunc('month', usage_date) as date) month_start, billing_origin_product,
 {_RESPEND}, sum(record_count) record_count from cost_by_product group by all""",
    "recent_runs": f"""select {_SCOPE}, job_id, job_name, run_date, total_runs, successful_runs, failed_runs, avg_duration_seconds,
 p95_duration_seconds, round(100.0::double * cast(successful_runs as double) / nullif(cast(total_runs as double), 0), 2) success_rate_pct
 from job_runs_summary where {_last(30, 'run_date', _EVENTS_TODAY)}""",
    "job_performance_trends": f"""select *, avg(avg_duration_seconds) over w ma7_avg_duration, avg(success_rate_pct) over w ma7_success_rate
 from recent_runs window w as (partition by {_SCOPE}, job_id order by run_date rows between 6 preceding and current row)""",
    "job_performance_trends_by_days": f"""select *, avg(avg_duration_seconds) over w ma7_avg_duration,
 avg(success_rate_pct) over w ma7_success_rate from recent_runs window w as (partition by {_SCOPE}, job_id order by run_date
 range between interval 6 days preceding and current row)""",
    "daily_costs": f"""select {_SCOPE}, usage_date, cast(sum(total_cost_usd) as double) daily_cost from cost_by_product group by all""",
    "daily_costs_60d": f"select * from daily_costs where {_last(60)}",
    "daily_costs_90d": f"select * from daily_costs where {_last(90)}",
    "cost_anomalies": _anomalies(
        "daily_costs_60d", "ma30_cost", "stddev30_cost", "round({z}, 2) + 0.0", "anomaly_type", ("HIGH_SPEND", "LOW_SPEND", "NORMAL")
    ),
    "top_consumers_30d": f"""select * from (select *, row_number() over (partition by {_SCOPE} order by total_cost_usd desc,
  job_id nulls first, job_name nulls first, run_as nulls first) cost_rank from (
  select {_SCOPE}, job_id, job_name, run_as, {_RESPEND}, sum(run_count) total_runs from cost_by_job
  where {_last(30)} group by all)) where cost_rank <= 50""",
    "user_activity_30d": f"""select {_SCOPE}, user_email, count(distinct event_date) active_days, sum(event_count) total_events,
 min(first_activity) first_seen, max(last_activity) last_seen, list(distinct service_name) services_used
 from user_activity_summary where {_last(30, 'event_date', _EVENTS_TODAY)} group by all""",
    "job_success_rate_weekly": f"""select *, round(100.0::double * cast(successful_runs as double) / nullif(cast(total_runs as double), 0), 2) success_rate_pct
 from (select {_SCOPE}, job_id, job_name, cast(date_trunc('week', run_date) as date) week_start, sum(total_runs) total_runs,
 sum(successful_runs) successful_runs, sum(failed_runs) failed_runs, sum(canceled_runs) canceled_runs
 from job_runs_summary group by all)""",
    "cost_trend_analysis": _rolling(
        f"(select {_SCOPE}, usage_date, sum(total_cost_usd) total_cost_usd from cost_by_product group by all)"
    ),
    # billing reports
    "v_current_month_spend": f"""select {_SCOPE}, billing_origin_product, is_serverless, {_SPEND}, count(*) record_count
 from billing_summary where month(usage_date) = month({_MONTH_END}) and year(usage_date) = year({_MONTH_END})
 and usage_date <= {_MONTH_END} group by all""",
    "v_daily_spend_trend": f"""select *, sum(total_cost_usd) over (partition by {_SCOPE} order by usage_date) cumulative_cost_usd
 from (select {_SCOPE}, usage_date, billing_origin_product, {_SPEND} from billing_summary where {_last(30)} group by all)""",
    "v_serverless_comparison": f"""select {_SCOPE}, cast(date_trunc('week', usage_date) as date) week_start, is_serverless,
 billing_origin_product, {_SPEND}, count(distinct job_id) distinct_jobs from billing_summary where {_last(90)} group by all""",
    "v_top_expensive_jobs": f"""select *, row_number() over (partition by {_SCOPE} order by total_cost_usd desc,
  job_id nulls first, job_name nulls first, run_as nulls first) cost_rank from (
 select {_SCOPE}, job_id, job_name, run_as, {_SPEND}, count(*) billing_records, min(usage_date) first_run, max(usage_date) last_run
 from billing_summary where job_id is not null and {_last(30)} group by all) qualify cost_rank <= 20""",
    "v_cost_by_tags": f"""select {_SCOPE}, usage_date, tag_key, tag_value, {_SPEND} from (
 select *, 'team' tag_key, tag_team tag_value from billing_summary where tag_team is not null
 union all select *, 'env' tag_key, tag_env tag_value from billing_summary where tag_env is not null)
 where {_last(30)} group by all""",
    "v_warehouse_costs": f"""select {_SCOPE}, warehouse_id, usage_date, sku_name, {_SPEND}, count(*) query_count
 from billing_summary where warehouse_id is not null and billing_origin_product = 'SQL' group by all""",
    "v_model_serving_costs": f"""select {_SCOPE}, endpoint_name, usage_date, sku_name, {_SPEND} from billing_summary
 where billing_origin_product = 'MODEL_SERVING' and {_last(30)} group by all""",
    "v_dlt_pipeline_costs": f"""select {_SCOPE}, dlt_pipeline_id, usage_date, is_serverless, {_SPEND} from billing_summary
 where billing_origin_product = 'DLT' and {_last(30)} group by all""",
    "v_hourly_spend_pattern": f"""select {_SCOPE}, hour(usage_start_time) hour_of_day, dayofweek(usage_date) + 1 day_of_week,
 billing_origin_product, cast(sum(estimated_cost_usd) as double) / count(*) avg_hourly_cost,
 sum(estimated_cost_usd) total_cost_usd from billing_summary where {_last(30)} group by all""",
    "v_notebook_costs": f"""select {_SCOPE}, notebook_id, cast(null as varchar) notebook_path, run_as, usage_date, {_SPEND}
 from billing_summary where notebook_id is not null and billing_origin_product = 'INTERACTIVE' and {_last(30)} group by all""",
    # AI/ML reports
    "v_model_serving_cost_summary": f"""select {_SCOPE}, endpoint_name, entity_type, entity_name, {_RESPEND},
 count(distinct usage_date) active_days, min(usage_date) first_usage, max(usage_date) last_usage
 from model_serving_costs where {_last(30)} group by all""",
    "v_foundation_model_leaderboard": f"""select _account_identifier, _workspace_identifier, entity_name,
 sum(total_input_tokens) total_input_tokens, sum(total_output_tokens) total_output_tokens, sum(total_tokens) total_tokens,
 sum(request_count) total_requests, count(distinct workspace_id) workspaces_using, count(distinct endpoint_name) endpoints_using
 from foundation_model_usage where {_last(30, today=_EVENTS_TODAY)} group by all""",
    "v_external_model_summary": f"""select {_SCOPE}, entity_name, endpoint_name, sum(total_input_tokens) total_input_tokens,
 sum(total_output_tokens) total_output_tokens, sum(total_tokens) total_tokens, sum(request_count) total_requests,
 round(cast(sum(total_output_tokens) as double) / nullif(cast(sum(total_input_tokens) as double), 0), 2) output_input_ratio
 from external_model_usage where {_last(30, today=_EVENTS_TODAY)} group by all""",
    "v_endpoint_daily_pattern": f"""select workspace_id, endpoint_name, usage_date, dayofweek(usage_date) + 1 day_of_week,
 sum(total_tokens) total_tokens, sum(request_count) total_requests, sum(total_input_tokens) input_tokens,
 sum(total_output_tokens) output_tokens from endpoint_usage_summary where {_last(30, today=_EVENTS_TODAY)} group by all""",
    "v_inactive_endpoints": f"""select *, date_diff('day', last_billing_date, {_TODAY}) days_since_last_billing
 from endpoint_inventory_to_date where last_billing_date < {_TODAY} - 7 or last_billing_date is null""",
    "v_mlflow_experiment_activity": f"""select {_SCOPE}, experiment_id, name experiment_name, lifecycle_stage, total_runs, successful_runs,
 failed_runs, round(100.0::double * cast(successful_runs as double) / nullif(cast(total_runs as double), 0), 2) success_rate_pct,
 distinct_users, first_run, last_run, date_diff('day', cast(last_run as date), {_TODAY}) days_since_last_run
 from mlflow_experiments_summary where total_runs > 0""",
    "v_mlflow_daily_activity": f"""select {_SCOPE}, run_date, sum(run_count) total_runs,
 sum(case when status = 'FINISHED' then run_count else 0 end) successful_runs,
 sum(case when status = 'FAILED' then run_count else 0 end) failed_runs, sum(distinct_users) distinct_users,
 round(avg(avg_duration_seconds), 2) avg_duration_seconds,
 round(cast(sum(total_compute_seconds) as double) / 3600, 2) total_compute_hours
 from mlflow_runs_summary where {_last(30, 'run_date')} group by all""",
    "v_mlflow_daily_activity_exact": f"""select d.* exclude (distinct_users), u.distinct_users from v_mlflow_daily_activity d join (
 select workspace_id, cast(start_time as date) run_date, count(distinct created_by) distinct_users from runs_latest group by all) u
 using (workspace_id, run_date)""",
    "v_top_experimenters": f"""select {_SCOPE}, experiment_id, name experiment_name, total_runs, successful_runs, distinct_users,
 round(100.0::double * cast(successful_runs as double) / nullif(cast(total_runs as double), 0), 2) success_rate_pct, last_run
 from mlflow_experiments_summary where last_run >= {_TODAY} - 30 and total_runs > 0
 order by total_runs desc, {_SCOPE}, experiment_id limit 50""",
    "v_vector_search_by_endpoint": f"""select {_SCOPE}, endpoint_name, {_RESPEND}, count(distinct usage_date) active_days,
 min(usage_date) first_usage, max(usage_date) last_usage from vector_search_costs where {_last(30)} group by all""",
    "v_vector_search_daily_trend": f"""select {_SCOPE}, usage_date, total_dbus, total_cost_usd, distinct_endpoints,
 sum(total_cost_usd) over (partition by {_SCOPE} order by usage_date) cumulative_cost_usd
 from vector_search_summary where {_last(30)}""",
    "v_aiml_spend_by_category": f"""select {_SCOPE}, aiml_category, billing_origin_product, {_RESPEND},
 sum(distinct_endpoints) total_endpoints, sum(distinct_users) total_users from aiml_executive_summary
 where {_last(30)} group by all""",
    "v_aiml_spend_by_category_exact": f"""select {_SCOPE}, billing_origin_product, {_CATEGORY}, {_SPEND},
 count(distinct endpoint_name) total_endpoints, count(distinct run_as) total_users from billing_summary
 where billing_origin_product in {_AIML} and {_last(30)} group by all""",
    "v_aiml_daily_trend": f"""select {_SCOPE}, usage_date, sum(total_cost_usd) total_cost_usd,
 sum(case when aiml_category = 'Inference' then total_cost_usd else 0 end) inference_cost,
 sum(case when aiml_category = 'Vector Search' then total_cost_usd else 0 end) vector_search_cost,
 sum(case when aiml_category = 'Feature Serving' then total_cost_usd else 0 end) feature_serving_cost,
 sum(case when aiml_category = 'Fine-tuning' then total_cost_usd else 0 end) finetuning_cost
 from aiml_executive_summary where {_last(30)} group by all""",
    "v_aiml_wow_comparison": _compared(
        "aiml_executive_summary", "aiml_category", "this_week_cost", "last_week_cost", "cost_change", "change_pct"
    ),
    "v_aiml_complete_inventory": f"""select {_SCOPE}, 'Model Serving' resource_type, endpoint_name resource_name,
 entity_type resource_subtype, entity_name model_name, total_cost_usd_30d cost_30d, change_time last_updated from endpoint_inventory
 union all select {_SCOPE}, 'MLflow Experiment', name, lifecycle_stage, null, null, last_update_time
 from mlflow_experiments_summary where total_runs > 0""",
    # several providers: billing split by account, activity by workspace parity
    "all_billing_summary": _two_providers("billing_summary", "account_id = '0'"),
    "all_cost_by_product": f"""select source, {_SCOPE}, usage_date, billing_origin_product, is_serverless, {_SPEND},
 count(*) record_count from all_billing_summary group by all""",
    "all_job_runs": _two_providers("job_runs_summary", "cast(workspace_id as int) % 2 = 0"),
    "all_endpoint_usage": _two_providers("endpoint_usage_summary", "cast(workspace_id as int) % 2 = 0"),
    "all_mlflow_experiments": _two_providers("mlflow_experiments_summary", "cast(workspace_id as int) % 2 = 0"),
    "all_executive_summary": f"""select source, {_SCOPE}, usage_date, {_SPEND},
 sum(if(billing_origin_product = 'JOBS', estimated_cost_usd, 0)) jobs_cost_usd,
 sum(if(billing_origin_product = 'SQL', estimated_cost_usd, 0)) sql_cost_usd,
 sum(if(billing_origin_product = 'DLT', estimated_cost_usd, 0)) dlt_cost_usd,
 sum(if(billing_origin_product = 'MODEL_SERVING', estimated_cost_usd, 0)) serving_cost_usd,
 sum(if(billing_origin_product = 'INTERACTIVE', estimated_cost_usd, 0)) interactive_cost_usd,
 sum(if(is_serverless, estimated_cost_usd, 0)) serverless_cost_usd,
 sum(if(not is_serverless, estimated_cost_usd, 0)) classic_cost_usd from all_billing_summary group by all""",
    "all_aiml_summary": f"""select source, {_SCOPE}, usage_date, billing_origin_product, {_SPEND},
 count(distinct endpoint_name) distinct_endpoints, count(distinct run_as) distinct_users, {_CATEGORY}
 from all_billing_summary where billing_origin_product in {_AIML} group by all""",
    "all_model_serving_costs": f"""select b.*, e.entity_type, e.entity_name from (
 select source, {_SCOPE}, usage_date, endpoint_name, sku_name, {_SPEND}, count(*) billing_records from all_billing_summary
  where billing_origin_product = 'MODEL_SERVING' group by all) b
 left join (select * from (select *, row_number() over (partition by workspace_id, endpoint_name
   order by change_time desc, served_entity_id desc) rn from served_entities_current) where rn = 1) e
 on b.workspace_id = e.workspace_id and b.endpoint_name = e.endpoint_name""",
    "monthly_spend_by_account": f"""select source, _account_identifier, cast(date_trunc('month', usage_date) as date) "month",
 sum(total_cost_usd) total_cost_usd, sum(total_dbus) total_dbus from all_cost_by_product group by all""",
    "account_comparison": f"""select source, _account_identifier, _workspace_identifier, billing_origin_product,
 sum(case when {_last(7)} then total_cost_usd else 0 end) last_7d_cost,
 sum(case when {_last(30)} then total_cost_usd else 0 end) last_30d_cost,
 sum(total_cost_usd) total_cost_usd from all_cost_by_product where {_last(90)} group by all""",
    "requests_on_billing_days": f"""select source, _account_identifier, _workspace_identifier, usage_date - {CLOCK_GAP} summary_date,
 sum(request_count) total_requests from all_endpoint_usage group by all""",
    "aiml_spend_comparison": f"""select c.*, r.total_requests from (
 select source, _account_identifier, _workspace_identifier, usage_date summary_date,
 sum(case when aiml_category = 'Inference' then total_cost_usd else 0 end) model_serving_cost,
 sum(case when aiml_category = 'Vector Search' then total_cost_usd else 0 end) vector_search_cost,
 sum(total_cost_usd) total_aiml_cost from all_aiml_summary where {_last(30)} group by all) c
 left join requests_on_billing_days r using (source, _account_identifier, _workspace_identifier, summary_date)""",
    # operators on their own
    "h_add_workspace_identifiers": f"select *, 'unknown_account' _account_identifier, 'unknown_workspace' _workspace_identifier from workspaces_latest",
    "h_add_time_dimensions": f"""select {_STAMP}, workspace_id, source_ip_address, event_time, cast(event_time as date) "date",
 hour(event_time) "hour", dayofweek(event_time) + 1 day_of_week, cast(date_trunc('week', event_time) as date) week_start,
 cast(date_trunc('month', event_time) as date) month_start from audit""",
    "h_top_n": f"""select * from (select *, row_number() over (partition by {_SCOPE} order by total_cost_usd desc, job_id nulls first,
  job_name nulls first, run_as nulls first) cost_rank from (select {_SCOPE}, job_id, job_name, run_as, sum(total_cost_usd) total_cost_usd
  from cost_by_job where {_last(30)} group by all)) where cost_rank <= 10""",
    "h_zscore_anomalies": _anomalies("daily_costs_90d", "avg_30d", "stddev_30d", "{z}", "anomaly_flag", ("HIGH", "LOW", "NORMAL")),
    "h_period_compare": _compared(
        "cost_by_product", "billing_origin_product", "current_period_cost", "previous_period_cost", "cost_change", "cost_change_pct"
    ),
    "h_pivot_sum": f"""select {_SCOPE}, usage_date,
 sum(case when billing_origin_product = 'JOBS' then total_cost_usd else 0 end) jobs_cost,
 sum(case when billing_origin_product = 'SQL' then total_cost_usd else 0 end) sql_cost,
 sum(case when billing_origin_product = 'DLT' then total_cost_usd else 0 end) dlt_cost,
 sum(case when billing_origin_product = 'MODEL_SERVING' then total_cost_usd else 0 end) serving_cost,
 sum(case when billing_origin_product = 'VECTOR_SEARCH' then total_cost_usd else 0 end) vector_search_cost,
 sum(case when billing_origin_product = 'INTERACTIVE' then total_cost_usd else 0 end) interactive_cost,
 sum(total_cost_usd) total_cost from cost_by_product where {_last(30)} group by all""",
    "h_tag_costs": f"""select {_SCOPE}, usage_date, tag_team team, tag_env env, cast(null as varchar) cost_center, {_SPEND}
 from billing_summary where {_last(30)} and (tag_team is not null or is_serverless is not null) group by all""",
    "h_basic_agg": f"""select {_SCOPE}, usage_date, {_RESPEND}, count(*) record_count from cost_by_product
 where {_last(30)} group by all""",
    "runs_on_billing_days": f"select * replace (run_date - {CLOCK_GAP} as run_date) from job_runs_summary",
    "h_entity_scorecard": f"""select j.workspace_id, j.job_id, j.name job_name, j.run_as, r.total_runs, r.successful_runs, r.failed_runs,
 r.avg_duration_seconds, c.total_dbus, c.total_cost_usd,
 round(cast(c.total_cost_usd as double) / nullif(cast(r.total_runs as double), 0), 2) cost_per_run,
 round(100.0::double * cast(r.successful_runs as double) / nullif(cast(r.total_runs as double), 0), 2) success_rate_pct
 from jobs_current j left join (select workspace_id, job_id, sum(total_runs) total_runs, sum(successful_runs) successful_runs,
  sum(failed_runs) failed_runs, avg(avg_duration_seconds) avg_duration_seconds from runs_on_billing_days
  where {_last(30, 'run_date')} group by all) r on j.workspace_id = r.workspace_id and j.job_id = r.job_id
 left join (select workspace_id, job_id, {_RESPEND} from cost_by_job where {_last(30)} group by all) c
 on j.workspace_id = c.workspace_id and j.job_id = c.job_id""",
    "h_template_aggregated": f"""select {_STAMP}, workspace_id, cast(metric_time as date) "date", metric_name, count(*) record_count,
 sum(cast(step as double)) total_metric, avg(step) avg_metric, max(metric_time) last_seen from run_metrics_history group by all""",
    "h_template_with_costs": """select j.workspace_id, j.job_id, j.name, b.usage_date, b.estimated_cost_usd from jobs_current j left join (
 select workspace_id, job_id, usage_date, sum(estimated_cost_usd) estimated_cost_usd from billing_summary group by all) b
 on j.workspace_id = b.workspace_id and j.job_id = b.job_id""",
    "h_template_filtered_view": f"""select {_STAMP}, workspace_id, metric_id, metric_name, metric_value from run_metrics_history
 where metric_name = 'loss'""",
}


def with_relations(sql: str) -> str:
    """The query preceded by the CTEs it needs, directly or through another."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in RELATIONS:
            if name not in needed and re.search(rf"(?<![\w']){name}(?![\w'])", text):
                needed.add(name)
                visit(RELATIONS[name])

    visit(sql)
    ctes = ",\n".join(f"{name} as ({RELATIONS[name]})" for name in _ordered(needed))
    return f"with {ctes}\n{sql}" if ctes else sql


def _ordered(names: set[str]) -> list[str]:
    done: list[str] = []

    def place(name: str) -> None:
        if name in done:
            return
        for other in names - {name}:
            if re.search(rf"(?<![\w']){other}(?![\w'])", RELATIONS[name]):
                place(other)
        done.append(name)

    for name in sorted(names):
        place(name)
    return done


def plain(
    sql: str, *, double: str = "", count: str = "", text: str = "", stat: str = "", listing: str = "", drop: str = ""
) -> str:
    """Cast columns to plain types: DOUBLE, BIGINT, text, statistics to 6 digits, lists as sorted text."""
    casts = [f"cast({c} as double) as {c}" for c in double.split()]
    casts += [f"cast({c} as bigint) as {c}" for c in count.split()]
    casts += [f"cast({c} as varchar) as {c}" for c in text.split()]
    casts += [f"round(cast({c} as double), 6) + 0.0 as {c}" for c in stat.split()]
    casts += [f"array_to_string(list_sort({c}), ',') as {c}" for c in listing.split()]
    excluded = f" exclude ({', '.join(drop.split())})" if drop else ""
    replaced = f" replace ({', '.join(casts)})" if casts else ""
    return with_relations(f"select *{excluded}{replaced} from ({sql})")
