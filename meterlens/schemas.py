"""Schemas of the source feeds, as Spark DDL.

Streams need a fixed schema up front. Only struct fields that a dataset reads are
listed; Parquet readers skip the others.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

_MODEL_CONFIG = "STRUCT<name: STRING, provider: STRING>"

_DDL = {
    "usage": """
        record_id STRING, account_id STRING, workspace_id STRING, sku_name STRING, cloud STRING,
        usage_start_time TIMESTAMP, usage_end_time TIMESTAMP, usage_date DATE,
        usage_quantity DECIMAL(18,4), usage_unit STRING,
        usage_metadata STRUCT<job_id: STRING, job_name: STRING, cluster_id: STRING, warehouse_id: STRING,
            notebook_id: STRING, notebook_path: STRING, dlt_pipeline_id: STRING, endpoint_name: STRING>,
        identity_metadata STRUCT<run_as: STRING>, custom_tags MAP<STRING, STRING>,
        billing_origin_product STRING,
        product_features STRUCT<is_serverless: BOOLEAN, is_photon: BOOLEAN, jobs_tier: STRING, sql_tier: STRING>,
        record_type STRING""",
    "list_prices": """
        sku_name STRING, cloud STRING, currency_code STRING, usage_unit STRING,
        pricing STRUCT<default: DECIMAL(18,4)>, price_start_time TIMESTAMP, price_end_time TIMESTAMP""",
    "jobs": """
        account_id STRING, workspace_id STRING, job_id STRING, name STRING, creator_id STRING, run_as STRING,
        tags MAP<STRING, STRING>, schedule STRUCT<cron: STRING, timezone: STRING>,
        change_time TIMESTAMP, delete_time TIMESTAMP""",
    "job_run_timeline": """
        workspace_id STRING, job_id STRING, run_id STRING, run_name STRING, run_type STRING,
        period_start_time TIMESTAMP, period_end_time TIMESTAMP, result_state STRING,
        termination_code STRING, compute_ids ARRAY<STRING>""",
    "clusters": """
        account_id STRING, workspace_id STRING, cluster_id STRING, cluster_name STRING, owned_by STRING,
        driver_node_type STRING, worker_node_type STRING, num_workers INT,
        autoscale STRUCT<min_workers: INT, max_workers: INT>, data_security_mode STRING, dbr_version STRING,
        change_time TIMESTAMP, delete_time TIMESTAMP""",
    "node_timeline": """
        cluster_id STRING, start_time TIMESTAMP, cpu_user_percent DOUBLE, cpu_system_percent DOUBLE,
        mem_used_percent DOUBLE, network_received_bytes BIGINT, network_sent_bytes BIGINT""",
    "audit": """
        account_id STRING, workspace_id STRING, event_time TIMESTAMP, event_date DATE, service_name STRING,
        action_name STRING, user_identity STRUCT<email: STRING, subject_name: STRING>,
        request_params MAP<STRING, STRING>, response STRUCT<status_code: INT, error_message: STRING>,
        source_ip_address STRING""",
    "workspaces_latest": """
        workspace_id STRING, workspace_name STRING, cloud STRING, region STRING, create_time TIMESTAMP""",
    "served_entities": f"""
        served_entity_id STRING, account_id STRING, workspace_id STRING, created_by STRING,
        endpoint_name STRING, endpoint_id STRING, served_entity_name STRING, entity_type STRING,
        entity_name STRING, entity_version STRING, endpoint_config_version INT, task STRING,
        external_model_config {_MODEL_CONFIG}, foundation_model_config {_MODEL_CONFIG},
        custom_model_config {_MODEL_CONFIG}, change_time TIMESTAMP, endpoint_delete_time TIMESTAMP""",
    "endpoint_usage": """
        account_id STRING, workspace_id STRING, served_entity_id STRING, client_request_id STRING,
        databricks_request_id STRING, requester_id STRING, status_code INT, request_time TIMESTAMP,
        input_token_count BIGINT, output_token_count BIGINT, input_character_count BIGINT,
        output_character_count BIGINT, is_streaming BOOLEAN, usage_context STRING""",
    "experiments_latest": """
        account_id STRING, workspace_id STRING, experiment_id STRING, name STRING,
        create_time TIMESTAMP, update_time TIMESTAMP, delete_time TIMESTAMP""",
    "runs_latest": """
        account_id STRING, workspace_id STRING, run_id STRING, experiment_id STRING, created_by STRING,
        start_time TIMESTAMP, end_time TIMESTAMP, run_name STRING, status STRING,
        params MAP<STRING, STRING>, tags MAP<STRING, STRING>, aggregated_metrics MAP<STRING, STRING>,
        update_time TIMESTAMP, delete_time TIMESTAMP""",
    "run_metrics_history": """
        account_id STRING, workspace_id STRING, experiment_id STRING, run_id STRING, metric_id STRING,
        metric_name STRING, metric_time TIMESTAMP, step BIGINT, metric_value DOUBLE,
        inserted_time TIMESTAMP""",
}

FEEDS = tuple(_DDL)


def feed_schema(feed: str) -> StructType:
    return StructType.fromDDL(_DDL[feed])
