"""Hand-checked frames for the edge cases of each operator."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterlens.functions import add_time_dimensions, add_workspace_identifiers, between_days, trailing
from meterlens.operators import (
    change_feed,
    consolidate,
    extract_current_scd2,
    period_compare,
    rolling_avg,
    tag_costs,
    top_n,
    with_costs,
    zscore_anomalies,
)
from meterlens.operators.tags import costs_per_tag
from meterlens.plans import audit, billing, jobs, ml_reports, rollups, serving, tracking

A, W = "acct", "ws"
TODAY = dt.date(2024, 1, 31)


def at(text):
    return dt.datetime.fromisoformat(text)


def scoped(df):
    return df.withColumns({"_account_identifier": F.lit(A), "_workspace_identifier": F.lit(W)})


def as_set(df, *cols):
    return {tuple(r) for r in df.select(*cols).collect()}


USAGE = """record_id STRING, workspace_id STRING, account_id STRING, sku_name STRING, cloud STRING, usage_start_time TIMESTAMP,
 usage_end_time TIMESTAMP, usage_date DATE, usage_quantity DECIMAL(18,4), usage_unit STRING,
 usage_metadata STRUCT<job_id: STRING, job_name: STRING, cluster_id: STRING, warehouse_id: STRING, notebook_id: STRING,
  notebook_path: STRING, dlt_pipeline_id: STRING, endpoint_name: STRING>,
 identity_metadata STRUCT<run_as: STRING>, custom_tags MAP<STRING, STRING>, billing_origin_product STRING,
 product_features STRUCT<is_serverless: BOOLEAN, is_photon: BOOLEAN, jobs_tier: STRING, sql_tier: STRING>, record_type STRING"""
PRICES = """sku_name STRING, cloud STRING, currency_code STRING, usage_unit STRING, pricing STRUCT<default: DECIMAL(18,4)>,
 price_start_time TIMESTAMP, price_end_time TIMESTAMP"""


def usage_row(rid, start, end, sku="S", serverless=None, tags=None, product="JOBS", kind="ORIGINAL"):
    return (
        *(rid, "1", "a", sku, "AWS", at(start), at(end), at(start).date(), Decimal(2), "DBU"),
        *(("j1", "job", None, None, None, None, None, None), ("u1",), tags, product),
        *((serverless, None, None, None), kind),
    )


def usage(spark, *rows):
    return scoped(spark.createDataFrame(list(rows), USAGE))


@pytest.fixture
def prices(spark):
    change = at("2024-01-10 12:00:00")
    return spark.createDataFrame(
        [
            ("S", "AWS", "USD", "DBU", (Decimal(1),), at("2024-01-01"), change),
            ("S", "AWS", "USD", "DBU", (Decimal(3),), change, None),
        ],
        PRICES,
    )


EDGES = [
    ("ends at the change", "2024-01-10 11:00:00", "2024-01-10 12:00:00", "S"),
    ("across the change", "2024-01-10 11:30:00", "2024-01-10 12:30:00", "S"),
    ("starts at the change", "2024-01-10 12:00:00", "2024-01-10 13:00:00", "S"),
    ("before any price", "2023-12-31 00:00:00", "2023-12-31 01:00:00", "S"),
    ("unknown sku", "2024-01-05 00:00:00", "2024-01-05 01:00:00", "X"),
]


@pytest.mark.parametrize("salted", [False, True])
@pytest.mark.parametrize("price_at, across", [("period", 0), ("start", 2)])
def test_price_edges(spark, prices, salted, price_at, across):
    rows = usage(spark, *[usage_row(name, start, end, sku) for name, start, end, sku in EDGES])
    lines = billing.billing_summary(rows, prices, price_at=price_at, salted=salted)
    costs = {(r.usage_start_time, r.sku_name): float(r.estimated_cost_usd) for r in lines.collect()}
    assert [costs[at(start), sku] for _, start, _, sku in EDGES] == [2, across, 6, 0, 0]


def test_overlapping_prices_are_found(spark, prices):
    assert billing.overlapping_prices(prices).count() == 0
    open_ended = prices.withColumn("price_end_time", F.lit(None).cast("timestamp"))
    assert billing.overlapping_prices(open_ended).count() == 1


def test_corrections(spark, prices):
    start, end = "2024-01-02 00:00:00", "2024-01-02 01:00:00"
    rows = usage(spark, usage_row("1", start, end), usage_row("2", start, end, kind="RETRACTION"))
    assert billing.billing_summary(rows, prices).count() == 1
    assert billing.billing_summary(rows, prices, corrections=True).count() == 2


def test_billing_columns(spark, prices):
    lines = billing.billing_summary(usage(spark, usage_row("1", "2024-01-02", "2024-01-03")), prices)
    assert len(lines.columns) == 27 and lines.schema["estimated_cost_usd"].dataType.simpleString().startswith("decimal")
    with_lineage = usage(spark, usage_row("1", "2024-01-02", "2024-01-03")).withColumn("_ingested_at", F.current_timestamp())
    assert billing.billing_summary(with_lineage, prices).columns[-1] == "_ingested_at"


def test_serverless_null_is_in_neither_half(spark, prices):
    days = [usage_row(str(i), "2024-01-02", "2024-01-03", serverless=s) for i, s in enumerate([True, False, None])]
    summary = billing.executive_summary(billing.cost_by_product(billing.billing_summary(usage(spark, *days), prices))).first()
    assert (summary.total_cost_usd, summary.serverless_cost_usd, summary.classic_cost_usd) == (6, 2, 2)


def test_tags(spark, prices):
    rows = [
        usage_row(str(i), "2024-01-30", "2024-01-31", tags=t)
        for i, t in enumerate([None, {}, {"team": "t", "env": "prod"}])
    ]
    lines = billing.billing_summary(usage(spark, *rows), prices)
    assert as_set(costs_per_tag(lines, as_of=TODAY), "tag_key", "tag_value") == {("team", "t"), ("env", "prod")}
    assert as_set(tag_costs(lines, ["team"], as_of=TODAY), "team") == {("t",), (None,)}


def test_scd2(spark):
    rows = [
        ("deleted last", at("2024-01-01"), None, "v1"),
        ("deleted last", at("2024-01-02"), at("2024-01-02"), "v2"),
        ("back again", at("2024-01-01"), at("2024-01-01"), "v1"),
        ("back again", at("2024-01-02"), None, "v2"),
        ("single", at("2024-01-01"), None, "v1"),
        ("tie", at("2024-01-01"), None, "v1"),
        ("tie", at("2024-01-01"), None, "v2"),
    ]
    df = spark.createDataFrame(rows, "id STRING, change_time TIMESTAMP, delete_time TIMESTAMP, name STRING")
    current = extract_current_scd2(df, ["id"], tiebreak=["name"])
    assert as_set(current, "id", "name") == {("back again", "v2"), ("single", "v1"), ("tie", "v2")}
    assert extract_current_scd2(df, ["id"], delete_col=None).count() == 4


def daily(spark, costs, start=dt.date(2024, 1, 1)):
    rows = [("1", start + dt.timedelta(days=i), float(c)) for i, c in enumerate(costs) if c is not None]
    return scoped(spark.createDataFrame(rows, "workspace_id STRING, usage_date DATE, daily_cost DOUBLE"))


def test_moving_average_counts_rows_unless_asked_for_days(spark):
    series = daily(spark, [1, 2, None, None, None, 6])
    rows = rolling_avg(series, ["workspace_id"], "usage_date", {"avg": "daily_cost"}, 3)
    days = rolling_avg(series, ["workspace_id"], "usage_date", {"avg": "daily_cost"}, 3, by_days=True)
    newest = lambda df: df.orderBy(F.desc("usage_date")).first()["avg"]
    assert (newest(rows), newest(days)) == (3.0, 6.0)


def test_anomalies_on_a_flat_series(spark):
    found = zscore_anomalies(daily(spark, [5, 5, 5, 5, 5, 50]), ["workspace_id"], "usage_date", "daily_cost")
    rows = found.orderBy("usage_date").collect()
    # the first day has no history; without deviation there is no score, and so no anomaly
    assert len(rows) == 5 and all(r.z_score is None and r.anomaly_flag == "NORMAL" for r in rows)
    assert rows[0].stddev_30d is None and rows[-1].stddev_30d == 0


def test_anomaly_labels(spark):
    found = zscore_anomalies(daily(spark, [5, 6, 5, 6, 50, 5]), ["workspace_id"], "usage_date", "daily_cost", digits=2)
    assert [r.anomaly_flag for r in found.orderBy("usage_date").collect()] == ["NORMAL", "NORMAL", "NORMAL", "HIGH", "NORMAL"]


def test_cost_anomalies_window(spark):
    product = daily(spark, range(80), TODAY - dt.timedelta(days=79)).withColumnRenamed("daily_cost", "total_cost_usd")
    assert rollups.cost_anomalies(product, as_of=TODAY).count() == 60


def test_time_dimensions(spark):
    df = spark.createDataFrame([(at("2024-01-07 23:30:00"),)], "ts TIMESTAMP")
    row = add_time_dimensions(df, "ts").first()
    assert (row.date, row.hour, row.day_of_week) == (dt.date(2024, 1, 7), 23, 1)
    assert (row.week_start, row.month_start) == (dt.date(2024, 1, 1), dt.date(2024, 1, 1))


def test_identifiers_come_from_the_session(spark):
    plain = spark.range(1)
    assert tuple(add_workspace_identifiers(plain).first())[1:] == ("unknown_account", "unknown_workspace")
    spark.conf.set("account_identifier", "acme")
    try:
        assert add_workspace_identifiers(plain).first()["_account_identifier"] == "acme"
    finally:
        spark.conf.unset("account_identifier")


def test_trailing_includes_both_ends(spark):
    series = daily(spark, range(40), TODAY - dt.timedelta(days=35))
    dates = [r.usage_date for r in trailing(series, "usage_date", 30, TODAY).orderBy("usage_date").collect()]
    assert (dates[0], dates[-1]) == (TODAY - dt.timedelta(days=30), TODAY)


def test_inactive_endpoints(spark):
    rows = [(str(d), TODAY - dt.timedelta(days=d)) for d in (6, 7, 8)] + [("never", None)]
    inventory = spark.createDataFrame(rows, "endpoint_name STRING, last_billing_date DATE")
    silent = ml_reports.v_inactive_endpoints(inventory, as_of=TODAY)
    assert as_set(silent, "endpoint_name", "days_since_last_billing") == {("8", 8), ("never", None)}


def test_week_over_week(spark):
    days = {"this": [0], "last": [10], "both": [3, 9], "from zero": [1]}
    rows = [("1", k, TODAY - dt.timedelta(days=d), Decimal(10)) for k, ds in days.items() for d in ds]
    rows.append(("1", "from zero", TODAY - dt.timedelta(days=12), Decimal(0)))
    rows.append(("1", "old", TODAY - dt.timedelta(days=15), Decimal(10)))
    rows.append(("1", "edge", TODAY - dt.timedelta(days=7), Decimal(10)))
    df = scoped(spark.createDataFrame(rows, "workspace_id STRING, category STRING, usage_date DATE, cost DECIMAL(18,4)"))
    result = period_compare(df, ["category"], "cost", as_of=TODAY)
    seen = {r[0]: tuple(None if v is None else float(v) for v in r[1:]) for r in result.collect()}
    assert seen == {
        "this": (10, 0, 10, None),
        "last": (0, 10, -10, -100),
        "both": (10, 10, 0, 0),
        "from zero": (10, 0, 10, None),
        "edge": (10, 0, 10, None),
    }


def test_tokens_with_one_side_missing(spark):
    rows = [("1", "e", at("2024-01-01"), i, o) for i, o in [(10, 5), (7, None), (None, None)]]
    requests = scoped(
        spark.createDataFrame(
            rows,
            "workspace_id STRING, served_entity_id STRING, request_time TIMESTAMP, input_token_count BIGINT, output_token_count BIGINT",
        )
    )
    day = serving.endpoint_usage_daily(requests).first()
    assert (day.total_input_tokens, day.total_output_tokens, day.total_tokens, day.request_count) == (17, 5, 15, 3)


def test_foundation_models(spark):
    rows = [
        ("databricks-mixtral-1", None),
        ("databricks-claude-1", None),
        (None, "FOUNDATION_MODEL_API"),
        (None, None),
        ("ep", "EXTERNAL_MODEL"),
    ]
    usage_rows = scoped(spark.createDataFrame(rows, "endpoint_name STRING, entity_type STRING")).withColumns(
        {
            "workspace_id": F.lit("1"),
            **{
                c: F.lit(1)
                for c in "usage_date entity_name total_input_tokens total_output_tokens total_tokens request_count".split()
            },
        }
    )
    found = serving.foundation_model_usage(usage_rows)
    assert as_set(found, "endpoint_name", "entity_type") == {("databricks-mixtral-1", None), (None, "FOUNDATION_MODEL_API")}
    assert serving.foundation_model_usage(usage_rows, endpoint_pattern="^databricks-").count() == 3


def test_run_slices(spark):
    schema = """workspace_id STRING, job_id STRING, run_id STRING, run_type STRING, period_start_time TIMESTAMP,
     period_end_time TIMESTAMP, result_state STRING"""
    hours = ["2024-01-01 00:00:00", "2024-01-01 01:00:00", "2024-01-01 02:00:00", "2024-01-01 02:30:00"]
    rows = [
        ("1", "j", "r", "JOB_RUN", at(a), at(b), "SUCCEEDED" if b == hours[-1] else None)
        for a, b in zip(hours, hours[1:], strict=False)
    ]
    slices = scoped(spark.createDataFrame(rows, schema))
    as_slices, merged = (jobs.job_runs_daily(slices, merge_slices=m).first() for m in (False, True))
    assert (as_slices.total_runs, as_slices.successful_runs, as_slices.max_duration_seconds) == (3, 1, 3600)
    assert (merged.total_runs, merged.successful_runs, merged.max_duration_seconds) == (1, 1, 9000)


def test_latest_versions_of_runs(spark):
    rows = [("1", "r", at("2024-01-01"), None, "RUNNING"), ("1", "r", at("2024-01-02"), at("2024-01-02"), "FINISHED")]
    schema = "workspace_id STRING, run_id STRING, update_time TIMESTAMP, end_time TIMESTAMP, status STRING"
    assert as_set(tracking.latest_runs(spark.createDataFrame(rows, schema)), "status") == {("FINISHED",)}


def test_same_workspace_id_in_two_accounts(spark):
    one = daily(spark, [1, 2]).withColumnRenamed("daily_cost", "total_cost_usd")
    two = one.withColumn("_account_identifier", F.lit("other"))
    both = consolidate({"a": one, "b": two})
    assert both.count() == 4 and both.columns[0] == "source"
    trend = rollups.cost_trend_analysis(both)
    assert as_set(trend.where("usage_date = '2024-01-02'"), "cost_7d_rolling_avg") == {(1.5,)}
    newer = one.withColumn("extra", F.lit(1))
    assert consolidate({"a": one, "b": newer}, allow_missing=True).where("extra IS NULL").count() == 2
    with pytest.raises(ValueError):
        consolidate({})


def test_top_n_breaks_ties(spark):
    df = spark.createDataFrame([("w", c, 1.0) for c in "dbca"] + [("w", "z", 2.0)], "w STRING, id STRING, cost DOUBLE")
    assert as_set(top_n(df, ["w"], "cost", 3, tiebreak=["id"]), "id", "cost_rank") == {("z", 1), ("a", 2), ("b", 3)}


def test_change_feed(spark):
    schema = "id STRING, value INT, tags MAP<STRING, STRING>"
    old = spark.createDataFrame([("same", 1, {"a": "1"}), ("gone", 1, None), ("changed", 1, None), (None, 1, None)], schema)
    new = spark.createDataFrame([("same", 1, {"a": "1"}), ("new", 1, None), ("changed", 1, {"b": "2"}), (None, 2, None)], schema)
    assert as_set(change_feed(old, new, ["id"]), "_change_type", "id", "value") == {
        ("insert", "new", 1),
        ("delete", "gone", 1),
        ("update_preimage", "changed", 1),
        ("update_postimage", "changed", 1),
        ("update_preimage", None, 1),
        ("update_postimage", None, 2),
    }


@pytest.mark.parametrize("form", ["plain", "salted", "stored"])
def test_costs_do_not_multiply_rows(spark, prices, form, tmp_path):
    rows = [usage_row(str(i), "2024-01-02", "2024-01-03") for i in range(3)]
    lines = billing.billing_summary(usage(spark, *rows), prices)
    runs = spark.createDataFrame(
        [("1", "j1", dt.date(2024, 1, 2), 1), ("1", "j1", dt.date(2024, 1, 2), 2), ("1", "none", dt.date(2024, 1, 2), 3)],
        "workspace_id STRING, job_id STRING, usage_date DATE, n INT",
    )
    joined = with_costs(runs, lines, ["workspace_id", "job_id", "usage_date"], salted=form == "salted", store_at=str(tmp_path / "costs") if form == "stored" else None)
    costs = {r.n: r.estimated_cost_usd for r in joined.collect()}
    assert costs == {1: 6, 2: 6, 3: None} and joined.columns.count("usage_date") == 1


def test_changes_inside_nested_maps(spark):
    """Maps have no order at any depth; only a value that differs is an update."""
    frame = lambda *m: spark.sql(f"SELECT 1 AS id, named_struct('a', map({m[0]}), 'b', array(map('k', map({m[1]})))) AS s")
    old = frame("'x', 1, 'y', 2", "'p', 1, 'q', 2")
    assert change_feed(old, frame("'y', 2, 'x', 1", "'q', 2, 'p', 1"), ["id"]).count() == 0
    assert change_feed(old, frame("'y', 2, 'x', 1", "'q', 2, 'p', 7"), ["id"]).count() == 2


def test_windows_without_a_day_have_no_end(spark):
    rows = spark.sql("SELECT date_add(current_date(), d) AS d FROM VALUES (-40), (-1), (0), (1) AS t(d)")
    assert trailing(rows, "d", 30, None).count() == 3
    assert trailing(rows, "d", 30, dt.date.today() - dt.timedelta(days=1)).count() >= 1
    assert rows.where(between_days("d", None, 30, 0)).count() == 3 and rows.where(between_days("d", None, 30, 0) & (F.col("d") > F.current_date())).count() == 1


def test_recipient_events_are_the_newest(spark):
    rows = [("1", at("2024-01-01") + dt.timedelta(minutes=i), f"add_recipient_{i}", "share") for i in range(120)]
    rows.append(("1", at("2024-02-01"), "getTable", "share"))
    events = scoped(spark.createDataFrame(rows, "workspace_id STRING, event_time TIMESTAMP, action_name STRING, service_name STRING"))
    found = audit.recipient_events(events)
    assert found.count() == 100 and found.agg(F.min("event_time")).first()[0] == at("2024-01-01 00:20:00")
