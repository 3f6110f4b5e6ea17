"""The physical plans we count on at scale."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from compare import plan_of
from test_micro import usage, usage_row
from meterlens.operators import extract_current_scd2, lookup_join, top_n, with_costs
from meterlens.plans import audit, billing, billing_reports, ml_reports, ml_spend
from meterlens.sources.tables import Table, only_dates
from meterlens.validation.world import World

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def world(spark):
    return World(spark, SF_DIR)


@pytest.fixture
def no_auto_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def stored_lines(world, tmp_path_factory):
    """Recent priced lines as the refresh stores them, one folder per date."""
    table = Table(world.spark, str(tmp_path_factory.mktemp("gold") / "billing_summary"), "usage_date")
    table.replace(world.lines.where("usage_date BETWEEN '2001-06-20' AND '2001-07-01'"))
    return table.read()


def test_prices_are_broadcast_and_usage_is_not_shuffled(spark, world, tmp_path):
    world.usage.limit(100).write.parquet(str(tmp_path / "usage"))
    usage = spark.read.parquet(str(tmp_path / "usage"))
    plan = plan_of(billing.billing_summary(usage, world.prices))
    joined = plan[plan.index("BroadcastHashJoin") :]
    assert "LeftOuter" in joined and "SortMergeJoin" not in plan
    left = joined[: joined.index("BroadcastExchange")]
    assert "Exchange" not in left  # the usage side goes straight from the scan into the join


def test_few_prices_summed_from_a_large_table_are_broadcast(spark, tmp_path):
    """Spark takes the aggregate to be too large; usage is read once and isn't shuffled for its prices."""
    usage(spark, usage_row("a", "2024-01-02", "2024-01-03"), usage_row("back", "2024-01-03", "2024-01-01")).write.parquet(str(tmp_path / "usage"))
    used = spark.read.parquet(str(tmp_path / "usage"))
    prices = spark.range(40_000).groupBy((F.col("id") % 2).alias("k")).agg(F.max("id").alias("m")).select(
        F.lit("S").alias("sku_name"), F.when(F.col("k") == 0, "AWS").otherwise("GCP").alias("cloud"),
        F.struct((F.col("m") - 39_990).cast("decimal(18,4)").alias("default")).alias("pricing"),
        F.lit(dt.datetime(2023, 1, 1)).alias("price_start_time"), F.lit(None).cast("timestamp").alias("price_end_time"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        for options in ({}, {"corrections": True}, {"bucketed": True}):
            lines = billing.billing_summary(used, prices, **options)
            plan = plan_of(lines)
            assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan and plan.count("ReadSchema") == 1
            assert [float(r[0]) for r in lines.select("estimated_cost_usd").collect()] == [16.0, 16.0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_large_price_list_is_joined_by_salted_shuffle(world, no_auto_broadcast):
    plan = plan_of(billing.billing_summary(world.usage, world.prices, salted=True))
    assert "SortMergeJoin [sku_name" in plan and "_salt" in plan and "BroadcastNestedLoopJoin" not in plan
    plain = plan_of(billing.billing_summary(world.usage, world.prices))
    assert "SortMergeJoin [sku_name" in plain and "explode" not in plain


def test_costs_are_joined_without_copies(world, no_auto_broadcast):
    plan = plan_of(with_costs(world.jobs_current, world.lines))
    assert "SortMergeJoin" in plan and "explode" not in plan


def test_adaptive_execution_splits_one_hot_key(spark, no_auto_broadcast, tmp_path):
    settings = {"skewJoin.skewedPartitionThresholdInBytes": "64k", "advisoryPartitionSizeInBytes": "64k", "skewJoin.skewedPartitionFactor": "2"}
    for k, v in settings.items():
        spark.conf.set(f"spark.sql.adaptive.{k}", v)
    try:
        left = spark.range(40_000).selectExpr("if(id % 4 = 0, 'k' || id, 'hot') k", "id", "uuid() u").repartition(4)
        right = spark.range(40_000).selectExpr("if(id = 1, 'hot', 'k' || id) rk", "id v")
        joined = lookup_join(left, right, {"k": "rk"})
        joined.write.parquet(str(tmp_path / "out"))
        rows = spark.read.parquet(str(tmp_path / "out")).where("k = 'hot'").groupBy(F.input_file_name().alias("f")).count().collect()
        assert sum(r["count"] for r in rows) == 30_000 and len(rows) > 1
    finally:
        for k in settings:
            spark.conf.unset(f"spark.sql.adaptive.{k}")


def test_salting_spreads_one_hot_key(spark, no_auto_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(4000).select(F.lit("hot").alias("k"), "id")
        right = spark.createDataFrame([("hot", 1)], "rk STRING, v INT")
        joined = lookup_join(left, right, {"k": "rk"}, salt_on=["id"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 4000 and len(sizes) == 4 and max(sizes) < 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_latest_and_top_rows_are_limited_before_the_shuffle(world):
    current = plan_of(extract_current_scd2(world.feed("jobs"), ["workspace_id", "job_id"]))
    top = plan_of(top_n(world.by_job, ["workspace_id"], "total_cost_usd", 20))
    for plan in (current, top):
        assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan


@pytest.mark.parametrize(
    "report",
    [billing_reports.v_daily_spend_trend, billing_reports.v_current_month_spend, billing_reports.v_hourly_spend_pattern],
)
def test_reports_prune_partitions_and_columns(stored_lines, report):
    plan = plan_of(report(stored_lines, as_of="2001-06-30"))
    filters = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "usage_date" in filters and ">=" in filters and "<=" in filters
    schema = plan[plan.index("ReadSchema") :]
    assert "custom_tags" not in schema and "cluster_id" not in schema


def test_product_filter_reaches_the_scan(stored_lines):
    plan = plan_of(ml_spend.vector_search_costs(stored_lines))
    assert "EqualTo(billing_origin_product,VECTOR_SEARCH)" in plan


def test_distinct_counts_see_sums_not_lines(world):
    plan = plan_of(ml_spend.aiml_executive_summary(world.lines))
    below_expand = plan[plan.index("Expand") :]
    assert "HashAggregate" in below_expand


def test_top_experiments_need_no_full_sort(world):
    assert "TakeOrderedAndProject" in plan_of(ml_reports.v_top_experimenters(world.experiments, as_of="2001-07-01"))


def test_nested_columns_are_pruned(spark, world, tmp_path):
    world.usage.limit(50).write.parquet(str(tmp_path / "usage"))
    usage = spark.read.parquet(str(tmp_path / "usage"))
    plan = plan_of(billing.cost_by_job(billing.billing_summary(usage, world.prices)))
    schema = plan[plan.index("ReadSchema") :].splitlines()[0]
    assert "warehouse_id" not in schema and "custom_tags" not in schema


def test_bucketed_prices_meet_few_records(spark):
    """With a price a day for a thousand days, a record meets those of its month, not all; the result is that of the plain join."""
    start = F.expr("timestamp'2020-01-01' + make_interval(0, 0, 0, cast(id as int))")
    price_list = spark.range(1000).select(
        F.lit("S").alias("sku_name"), F.lit("AWS").alias("cloud"), F.lit("USD").alias("currency_code"), F.lit("DBU").alias("usage_unit"),
        F.struct((F.col("id") + 1).cast("decimal(18,4)").alias("default")).alias("pricing"), start.alias("price_start_time"),
        F.when(F.col("id") < 999, start + F.expr("interval 1 day")).alias("price_end_time"),
    )
    rows = [usage_row(f"r{i}", f"20{20 + i % 3}-0{1 + i % 9}-1{i % 10} 0{i % 9}:00:00", f"20{20 + i % 3}-0{1 + i % 9}-1{i % 10} {i % 9 + 1:02}:00:00") for i in range(200)]
    rows += [usage_row("back", "2021-03-02 05:00:00", "2021-01-01 00:00:00"), usage_row("late", "2031-01-01 00:00:00", "2031-01-01 01:00:00")]
    used = usage(spark, *rows)
    priced = lambda **o: sorted(map(str, billing.billing_summary(used, price_list, **o).select("usage_start_time", "estimated_cost_usd").collect()))
    assert priced(bucketed=True) == priced() and len(priced()) > 202
    renamed = price_list.selectExpr("sku_name as _price_sku", "price_start_time as _price_from", "price_end_time as _price_to")
    met = used.join(billing.price_months(renamed, 2020 * 12 + 1, 2022 * 12 + 9), F.expr("sku_name = _price_sku and year(usage_start_time) * 12 + month(usage_start_time) = _price_month"))
    assert met.count() <= 33 * used.count() < 1000 * used.count() / 20


def test_newest_events_read_the_dates_that_hold_them(spark, tmp_path):
    """Of 40 dates three hold the newest eight; ties within the last one and undated rows are decided as without counts."""
    events = spark.range(400).selectExpr(
        "date_add(DATE '2024-01-01', cast(id % 40 AS INT)) AS event_date",
        "CASE WHEN id % 3 = 0 THEN concat('add_recipient_', id % 7) ELSE 'getTable' END AS action_name",
        *(f"'{c}' AS {c}" for c in ("_account_identifier", "_workspace_identifier", "workspace_id", "service_name")),
    )
    undated = events.limit(1).withColumns({"event_date": F.lit(None).cast("date"), "action_name": F.lit("old_recipient")})
    events = events.unionByName(undated).withColumn("event_time", F.col("event_date").cast("timestamp"))
    table = Table(spark, str(tmp_path / "events"), "event_date")
    table.replace(events)
    dates = audit.dates_of_newest(audit.daily_actions(events), "recipient", 8)
    found = audit.events_by_action(only_dates(table.read(), "event_date", dates), "recipient", newest=8)
    whole = audit.events_by_action(events, "recipient", newest=8)
    assert len(dates) == 3 and sorted(found.select(*whole.columns).collect()) == sorted(whole.collect())
    plan = plan_of(only_dates(table.read(), "event_date", dates))
    filters = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert str(min(dates)) in filters and str(max(dates)) in filters
    assert audit.dates_of_newest(audit.daily_actions(events), "recipient", 1000)[-1] is None
    assert audit.dates_of_newest(audit.daily_actions(events), "nothing") == []
