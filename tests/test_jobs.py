"""Ingestion, incremental rebuild, stored tables, maintenance and publishing."""

import datetime as dt
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from meterlens.jobs import Lake, register_reports, run_consolidate, run_daily, run_publish, run_refresh
from meterlens.operators import change_feed
from meterlens.operators.changes import replayed
from compare import plan_of
from meterlens.plans import billing, tracking
from meterlens.schemas import FEEDS, feed_schema
from meterlens.sources import files, layout
from meterlens.sources.files import move as files_move
from meterlens.sources.feeds import Probe, evolved_schema, read_snapshot, source_probe
from meterlens.sources.publish import Share, publish
from meterlens.sources.scratch import new_folder, shared_folder
from meterlens.sources.tables import Table, only_dates, rows_by_date
from meterlens.streaming import refresh
from meterlens.streaming.ingest import bronze_stream, ingest_feed, read_bronze, read_feed_stream
from meterlens.validation.fixtures import PROJECTIONS, raw_feed
from test_micro import PRICES, USAGE, as_set, at, usage_row

SF_DIR = "/root/testdata/sf0.001"


def add_usage(spark, folder, *rows):
    spark.createDataFrame(list(rows), USAGE).coalesce(1).write.mode("append").parquet(folder)


def set_prices(spark, folder, *rows):
    spark.createDataFrame(list(rows), PRICES).coalesce(1).write.mode("overwrite").parquet(folder)


def price(amount, start, end=None):
    return ("S", "AWS", "USD", "DBU", (Decimal(amount),), at(start), at(end) if end else None)


def day(n, rid="a"):
    return usage_row(rid, f"2024-01-{n:02} 00:00:00", f"2024-01-{n:02} 01:00:00", product="VECTOR_SEARCH")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), "acct", "ws")


def test_documented_feeds_have_stand_ins():
    assert set(FEEDS) == set(PROJECTIONS)


def test_ingest_is_repeatable_and_picks_up_new_files(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    arrive = lambda: ingest_feed(spark, "billing_usage_bronze", source, target, state, account="acct", workspace="ws")
    add_usage(spark, source, day(1), day(2))
    arrive()
    arrive()
    assert read_bronze(spark, target).count() == 2
    add_usage(spark, source, day(2, "late"))
    arrive()
    bronze = read_bronze(spark, target)
    assert as_set(bronze, "record_id", "usage_date") == {
        ("a", dt.date(2024, 1, 1)),
        ("a", dt.date(2024, 1, 2)),
        ("late", dt.date(2024, 1, 2)),
    }
    assert {"_account_identifier", "_workspace_identifier", "_ingested_at"} <= set(bronze.columns)


def test_ingest_takes_new_columns(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    add_usage(spark, source, day(1))
    ingest_feed(spark, "billing_usage_bronze", source, target, state)
    wider = spark.createDataFrame([day(2)], USAGE).withColumn("region", F.lit("eu"))
    wider.write.mode("append").parquet(source)
    schema = evolved_schema(spark, "usage", source)
    assert schema.names[-1] == "region"
    ingest_feed(spark, "billing_usage_bronze", source, target, state, schema=schema)
    assert as_set(read_bronze(spark, target, merge_schema=True), "region") == {(None,), ("eu",)}


def test_file_cap_splits_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    for n in range(1, 4):
        add_usage(spark, source, day(n))
    rows = bronze_stream(read_feed_stream(spark, "usage", source, max_files=1), "billing_usage_bronze")
    sizes = []
    query = rows.writeStream.foreachBatch(lambda df, _: sizes.append(df.count())).trigger(availableNow=True)
    query.option("checkpointLocation", str(tmp_path / "state")).start().awaitTermination()
    assert sizes == [1, 1, 1]


def test_refresh_follows_usage_and_prices(spark, tmp_path, lake, monkeypatch):
    sources = {"usage": str(tmp_path / "usage"), "list_prices": str(tmp_path / "prices")}
    rebuilt = []
    summary = billing.billing_summary

    def recorded(usage, prices, **options):
        rebuilt.append({r[0].day for r in usage.select("usage_date").distinct().collect()})
        return summary(usage, prices, **options)

    monkeypatch.setattr(billing, "billing_summary", recorded)
    stored = lambda name, *cols: as_set(lake.gold(name).read(), *cols)

    set_prices(spark, sources["list_prices"], price(1, "2024-01-01"))
    add_usage(spark, sources["usage"], day(1), day(2))
    run_refresh(lake, sources)
    run_refresh(lake, sources)  # nothing new: nothing rebuilt
    assert rebuilt == [{1, 2}]

    add_usage(spark, sources["usage"], day(2, "late"))
    run_refresh(lake, sources)
    assert rebuilt[1:] == [{2}]
    assert {(d.day, float(c)) for d, c in stored("executive_summary", "usage_date", "total_cost_usd")} == {(1, 2.0), (2, 4.0)}
    assert {(d.day, n) for d, n in stored("vector_search_costs", "usage_date", "billing_records")} == {(1, 1), (2, 2)}

    # the price is raised from the second day on: only that day is priced again
    set_prices(
        spark, sources["list_prices"], price(1, "2024-01-01", "2024-01-02"), price(5, "2024-01-02"), price(9, "2023-01-01", "2023-02-01")
    )
    run_refresh(lake, sources)
    assert {(d.day, float(c)) for d, c in stored("cost_by_product", "usage_date", "total_cost_usd")} == {(1, 2.0), (2, 20.0)}
    whole = summary(lake.bronze("billing_usage_bronze"), lake.gold("list_prices").read())
    columns = ["usage_date", "estimated_cost_usd", "endpoint_name"]
    assert as_set(lake.gold("billing_summary").read(), *columns) == as_set(whole, *columns)
    assert lake.gold("billing_summary").read().count() == whole.count() == 3


def test_a_long_backfill_is_a_short_range(spark):
    days = spark.range(3000).select(F.date_add(F.lit(dt.date(2010, 1, 1)), F.col("id").cast("int")).alias("d"))
    dates = refresh.distinct_dates(days, "d")
    assert len(dates) == 3000 and dates[0] == dt.date(2010, 1, 1)
    assert only_dates(days, "d", [*dates[:1000], *dates[1001:], None]).count() == 2999
    assert only_dates(days, "d", []).count() == 0
    assert only_dates(days, "d", dates[::2]).count() == 1500
    assert only_dates(days, "d", [d for i, d in enumerate(dates) if i % 3]).count() == 2000


def test_a_backfill_of_counted_dates_is_cut_without_a_sample(spark, tmp_path):
    """Rows are worked out once; a heavy date is cut, light ones have a file each, undated rows stay."""
    day = F.when(F.col("id") % 2 == 0, F.lit(dt.date(2010, 6, 1))).when(F.col("id") % 101 == 0, None)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    day = day.otherwise(F.date_add(F.lit(dt.date(2010, 1, 1)), (F.col("id") % 99).cast("int"))).alias("d")
    rows = spark.range(20_000).repartition(4).select("id", day)
    dates = rows_by_date(rows, "d")
    assert len(dates) == 101 and list(dates)[-1] is None and sum(dates.values()) == 20_000
    table = Table(spark, str(tmp_path / "t"), "d")
    for _ in range(2):  # a new table, and over the dates of one
        seen.value = 0
        table.overwrite_dates(rows.mapInArrow(count, rows.schema), dates)
        assert seen.value == 20_000
        assert table.read().count() == 20_000 and table.read().exceptAll(rows).count() == 0 and table.read().columns == ["id", "d"]
        files_of = {n: len([f for f in files.names(spark, f"{table.path()}/{n}") if f.startswith("part-")]) for n in files.names(spark, table.path()) if n.startswith("d=")}
        assert files_of["d=2010-06-01"] in (2, 3) and {n for d, n in files_of.items() if d != "d=2010-06-01"} == {1}


def test_only_dates_of_the_changed_price_are_rebuilt(spark):
    """A price that ends where the next one begins changes only what lies after that, and only for its SKU."""
    old = spark.createDataFrame([price(1, "2023-01-01")], PRICES)
    new = spark.createDataFrame([price(1, "2023-01-01", "2024-01-03"), price(5, "2024-01-03")], PRICES)
    other = usage_row("o", "2024-01-04 00:00:00", "2024-01-04 01:00:00", "OTHER")
    across = usage_row("x", "2024-01-02 23:30:00", "2024-01-03 00:30:00")
    used = spark.createDataFrame([day(1), across, day(3), day(5), other], USAGE)
    keys = ["sku_name", "cloud", "currency_code", "price_start_time"]
    dates = refresh.dates_of_price_changes(change_feed(old, new, keys), used)
    assert [d.day for d in dates] == [2, 3, 5]
    raised = spark.createDataFrame([price(2, "2023-01-01")], PRICES)
    assert len(refresh.dates_of_price_changes(change_feed(old, raised, keys), used)) == 4
    assert refresh.dates_of_price_changes(change_feed(old, old, keys), used) == []


def test_refresh_of_empty_feeds(spark, tmp_path, lake):
    """Every feed is there and none has rows: all datasets exist and are empty."""
    sources = {}
    for feed in FEEDS:
        sources[feed] = str(tmp_path / feed)
        spark.createDataFrame([], feed_schema(feed)).write.parquet(sources[feed])
    run_refresh(lake, sources)
    for name in ("billing_summary", "cost_by_user", "job_runs_summary", "endpoint_usage_summary", "endpoint_inventory", "user_activity_summary", "mlflow_experiments_summary"):
        assert lake.gold(name).read().count() == 0
    report = run_daily(lake, as_of=dt.date(2024, 1, 1))
    assert {r.table for r in report.collect() if r.error} == set()
    assert len(register_reports(lake, as_of=dt.date(2024, 1, 1))) == 24
    assert all(spark.table(name).count() == 0 for name in ("v_daily_spend_trend", "v_aiml_complete_inventory"))


def test_daily_job_without_some_feeds(spark, tmp_path, lake):
    sources = {"usage": str(tmp_path / "usage"), "list_prices": str(tmp_path / "prices")}
    set_prices(spark, sources["list_prices"], price(1, "2024-01-01"))
    add_usage(spark, sources["usage"], day(1))
    run_refresh(lake, sources)
    failed = {r.table for r in run_daily(lake, as_of=dt.date(2024, 1, 2)).collect() if r.error}
    assert failed == {"job_performance_trends", "user_activity_30d", "job_success_rate_weekly"}
    assert lake.rollup("cost_weekly_rollup").read().count() == 1


def test_clustered_copies_hold_all_dates(spark, tmp_path, lake):
    sources = {"usage": str(tmp_path / "usage"), "list_prices": str(tmp_path / "prices")}
    set_prices(spark, sources["list_prices"], price(1, "2023-01-01"))
    columns = ["record_id", "usage_date"]
    for rows in ([day(1), day(20)], [usage_row("late", "2023-05-01 00:00:00", "2023-05-01 01:00:00")]):
        add_usage(spark, sources["usage"], *rows)
        run_refresh(lake, sources)
        run_daily(lake, as_of=dt.date(2024, 1, 20))
        assert as_set(lake.clustered("billing_usage_bronze").read(), *columns) == as_set(lake.bronze("billing_usage_bronze"), *columns)
    assert lake.clustered("billing_usage_bronze").read().count() == 3


def test_rows_without_a_date_are_a_date_of_their_own(spark, tmp_path):
    one = dt.date(2024, 1, 1)
    rows = spark.createDataFrame([(None, 1), (one, 2), (dt.date(2024, 1, 2), 3)], "d DATE, v INT")
    table = Table(spark, str(tmp_path / "t"), "d")
    table.replace(rows)
    dates = refresh.distinct_dates(rows.where("v < 3"), "d")
    assert dates == [one, None]
    table.overwrite_dates(only_dates(table.read(), "d", dates).withColumn("v", F.col("v") * 10))
    assert as_set(table.read(), "v") == {(10,), (20,), (3,)}


def test_all_jobs(spark, tmp_path, lake):
    """All feeds through refresh, daily rollups and publishing."""
    sources = {}
    for feed in FEEDS:
        sources[feed] = str(tmp_path / feed)
        rows = raw_feed(spark, SF_DIR, feed)
        if feed == "usage":  # few dates, to keep the number of files down
            rows = rows.where("usage_date BETWEEN '2001-06-20' AND '2001-07-01'")
        if feed == "runs_latest":
            rows = rows.where("start_time BETWEEN '2001-06-20' AND '2001-07-01'")
        times = {"job_run_timeline": "period_start_time", "audit": "event_time", "endpoint_usage": "request_time", "run_metrics_history": "metric_time"}
        if feed in times:
            rows = rows.where(F.col(times[feed]) < "2024-01-04")
        rows.coalesce(2).write.parquet(sources[feed])
    run_refresh(lake, sources)
    lines = lake.gold("billing_summary").read()
    n_lines = lines.count()
    assert n_lines == lake.bronze("billing_usage_bronze").where("record_type = 'ORIGINAL'").count() > 0
    total = lambda name, col: lake.gold(name).read().agg(F.sum(col)).first()[0]
    assert total("cost_by_product", "total_cost_usd") == total("cost_by_sku", "total_cost_usd") == total("executive_summary", "total_cost_usd")
    halves = lake.gold("executive_summary").read().where("serverless_cost_usd + classic_cost_usd > total_cost_usd")
    assert halves.count() == 0

    report = run_daily(lake, as_of=dt.date(2001, 7, 1))
    assert {r.table for r in report.collect() if r.error} == set()
    assert lake.rollup("cost_weekly_rollup").read().agg(F.sum("total_cost_usd")).first()[0] == total("cost_by_product", "total_cost_usd")
    assert lake.gold("billing_summary").read().count() == n_lines

    target = str(tmp_path / "share")
    published = run_publish(lake, target)
    statuses = {r.name: (r.status, r.detail) for r in published.collect()}
    assert set(statuses.values()) == {("added", None)} and len(statuses) == 40
    assert run_publish(lake, str(tmp_path / "none"), []).count() == 0 and not (tmp_path / "none").exists()
    assert (tmp_path / "share" / "audit_logs_bronze").glob("event_date=*")
    whole = run_consolidate(spark, {"a": target, "b": target}, as_of=dt.date(2001, 7, 1))
    assert whole["all_cost_by_product"].count() == 2 * lake.gold("cost_by_product").read().count()
    assert set(whole) >= {"all_billing_summary", "account_comparison", "aiml_spend_comparison"}
    again = run_publish(lake, target, [Share("workspace_info"), Share("no_such_table")])
    assert [(r.status, r.detail) for r in again.collect()] == [("skipped", "already published"), ("skipped", "missing")]
    assert spark.read.parquet(f"{target}/cost_by_product").count() == lake.gold("cost_by_product").read().count()


def test_tracking_counts_versions_once_on_request(spark, tmp_path, lake):
    sources = {f: str(tmp_path / f) for f in ("experiments_latest", "runs_latest")}
    runs = raw_feed(spark, SF_DIR, "runs_latest").where("run_id IN ('1', '2')").withColumn("start_time", F.lit(at("2024-01-01")))
    raw_feed(spark, SF_DIR, "experiments_latest").write.parquet(sources["experiments_latest"])
    for hour, status in ((1, "RUNNING"), (2, "FINISHED")):
        version = {"status": F.lit(status), "update_time": F.lit(at(f"2024-01-01 0{hour}:00:00"))}
        runs.withColumns(version).write.mode("append").parquet(sources["runs_latest"])
        run_refresh(lake, sources, evolve=True, latest_tracking=True)
    summary = lake.gold("mlflow_runs_summary").read()
    assert as_set(summary.groupBy("status").agg(F.sum("run_count")), "*") == {("FINISHED", 2)}
    assert lake.gold("mlflow_experiments_summary").read().agg(F.sum("total_runs")).first()[0] == 2


def test_publish_reports_and_goes_on(spark, tmp_path):
    tables = {"bad": spark.range(3), "good": spark.range(3)}
    shares = [Share("bad", only=("no_such_column", "1")), Share("good", alias="renamed", only=("id", 1)), Share("a_view")]
    report = publish(spark, tables, str(tmp_path), shares, views=["a_view"])
    assert [r.status for r in report.collect()] == ["error", "added", "skipped"]
    assert as_set(spark.read.parquet(f"{tmp_path}/renamed"), "id") == {(1,)}
    newer = publish(spark, tables, str(tmp_path), [Share("good", alias="renamed")], renew=True)
    assert [r.status for r in newer.collect()] == ["added"]
    assert spark.read.parquet(f"{tmp_path}/renamed").count() == 3


def corrupt(folder):
    """A folder whose footer can be read as Parquet by no job."""
    folder.mkdir(parents=True)
    (folder / "part-0.parquet").write_bytes(b"not a table" * 100)
    return str(folder)


def test_a_failing_job_is_one_row_of_a_report(spark, tmp_path):
    bad = spark.read.schema("id LONG").parquet(corrupt(tmp_path / "bad"))
    report = publish(spark, {"bad": bad, "good": spark.range(3)}, str(tmp_path / "share"), [Share("bad"), Share("good")])
    assert [r.status for r in report.collect()] == ["error", "added"]
    probes = {"bad": Probe(lambda: bad), "good": Probe(lambda: spark.range(3))}
    assert [(r.row_count, r.error is None) for r in source_probe(spark, probes).collect()] == [(None, False), (3, True)]
    good, broken = Table(spark, str(tmp_path / "t")), Table(spark, str(tmp_path / "u"))
    for t in (good, broken):
        t.replace(spark.range(10))
    for f in (tmp_path / "u" / "slot1").glob("part-*"):
        f.write_bytes(b"not a table" * 100)
    assert [(r.table, r.error is None) for r in layout.compact_all(spark, {"broken": broken, "good": good}).collect()] == [("broken", False), ("good", True)]


def test_a_half_written_share_is_written_again(spark, tmp_path):
    goal = tmp_path / "share" / "good"
    spark.range(1).write.parquet(str(goal))
    (goal / "_SUCCESS").unlink()
    assert [r.status for r in publish(spark, {"good": spark.range(3)}, str(tmp_path / "share"), [Share("good")]).collect()] == ["added"]
    assert spark.read.parquet(str(goal)).count() == 3


def test_the_newest_date_is_that_of_all_rows(spark):
    rows = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2023, 1, 1),)], "d DATE")
    probe = {"old": Probe(lambda: rows, "d", 7)}
    assert [(r.row_count, r.newest_date) for r in source_probe(spark, probe, as_of=dt.date(2024, 6, 1)).collect()] == [(0, dt.date(2024, 1, 1))]


def test_a_run_whose_start_moved_is_counted_once(spark, tmp_path, lake):
    sources = {f: str(tmp_path / f) for f in ("experiments_latest", "runs_latest")}
    run = raw_feed(spark, SF_DIR, "runs_latest").where("run_id = '1'")
    raw_feed(spark, SF_DIR, "experiments_latest").write.parquet(sources["experiments_latest"])
    for start, updated in ((None, "2024-01-01"), ("2024-01-05", "2024-01-05"), ("2024-01-03", "2024-01-06")):
        version = {"start_time": F.lit(at(start) if start else None).cast("timestamp"), "update_time": F.lit(at(updated))}
        run.withColumns(version).write.mode("append").parquet(sources["runs_latest"])
        run_refresh(lake, sources, latest_tracking=True)
    summary = lake.gold("mlflow_runs_summary").read()
    assert as_set(summary, "run_date", "run_count") == {(dt.date(2024, 1, 3), 1)}


def test_table_replaced_from_itself(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.path()
    table.replace(spark.range(3))
    first = table.path()
    table.replace(table.read().where("id > 0"))
    assert table.path() != first and table.read().count() == 2
    table.replace(table.read().where("id > 1"))
    assert table.path() == first and as_set(table.read(), "id") == {(2,)}
    with pytest.raises(ValueError):
        table.overwrite_dates(spark.range(1))


def test_overwriting_dates_keeps_the_others(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "d DATE, v INT")
    table = Table(spark, str(tmp_path / "t"), "d")
    one, two = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    table.overwrite_dates(rows((one, 1), (two, 1)))
    for _ in range(2):
        table.overwrite_dates(rows((two, 5), (two, 6)))
    assert as_set(table.read(), "d", "v") == {(one, 1), (two, 5), (two, 6)}
    layout.retain(table, 0, as_of=two)
    assert as_set(table.read(), "d") == {(two,)}


def test_compaction_goes_on_past_a_failure(spark, tmp_path):
    good, missing = Table(spark, str(tmp_path / "good")), Table(spark, str(tmp_path / "missing"))
    good.replace(spark.range(100).repartition(8), laid_out=True)
    assert len(good.read().inputFiles()) == 8
    report = {r.table: r for r in layout.compact_all(spark, {"missing": missing, "good": good}).collect()}
    assert report["missing"].error and report["good"].files == 1
    assert len(good.read().inputFiles()) == 1 and good.read().count() == 100


def test_clustering_cuts_through_a_heavy_value(spark):
    df = spark.range(4000).select(F.lit("hot").alias("k"), "id")
    sizes = layout.clustered(df, ["k"], 4).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2000


def test_snapshot_and_probe(spark, tmp_path):
    folder = str(tmp_path / "workspaces")
    raw_feed(spark, SF_DIR, "workspaces_latest").write.parquet(folder)
    taken = read_snapshot(spark, "workspaces_latest", folder, account="acct", snapshot_time=True, workspace_level=False)
    assert taken.schema.names == [*feed_schema("workspaces_latest").names, "_account_identifier", "_snapshot_time"]
    gone = Probe(lambda: spark.read.parquet(str(tmp_path / "gone")))
    report = {r.feed: r for r in source_probe(spark, {"here": Probe(lambda: taken), "gone": gone}).collect()}
    assert report["here"].row_count == 25 and report["here"].error is None
    assert report["gone"].row_count is None and "PATH_NOT_FOUND" in report["gone"].error


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "x") != new_folder(spark, "x")


class Session:
    """Only the settings of a session."""

    def __init__(self, **conf):
        self.conf = {key.replace("_", "."): value for key, value in conf.items()}


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        shared_folder(Session(spark_master="yarn"))
    assert shared_folder(Session(spark_master="local[2]")) == shared_folder(Session(spark_master="local[2]"))


# --- entities that change, and states that are merged
def arrive(spark, folder, feed, *rows):
    """Rows given as dicts, written to a feed's folder with its documented columns."""
    schema = feed_schema(feed)
    whole = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    spark.createDataFrame(whole, schema).coalesce(1).write.mode("append").parquet(folder)


def recorded(monkeypatch, table_class=Table):
    """The dates that each overwriting names, by table."""
    written, overwrite = {}, table_class.overwrite_dates

    def wrapped(self, df, dates=None, **options):
        if dates is not None:
            written.setdefault(self.root.rsplit("/", 1)[1], []).append([d and d.day for d in dates])
        return overwrite(self, df, dates, **options)

    monkeypatch.setattr(table_class, "overwrite_dates", wrapped)
    return written


def slice_of(n, job="1", run="r", state="SUCCEEDED", hour=0, **more):
    start = f"2024-01-{n:02} {hour:02}:00:00"
    return {"workspace_id": "w", "job_id": job, "run_id": f"{run}{n}", "run_type": "JOB_RUN", "period_start_time": at(start),
            "period_end_time": at(f"2024-01-{n:02} {hour:02}:30:00"), "result_state": state} | more


def job(name, changed, key="1"):
    return {"account_id": "a", "workspace_id": "w", "job_id": key, "name": name, "change_time": at(changed)}


def test_a_renamed_job_rebuilds_its_dates_only(spark, tmp_path, lake, monkeypatch):
    sources = {f: str(tmp_path / f) for f in ("jobs", "job_run_timeline")}
    arrive(spark, sources["jobs"], "jobs", job("old", "2024-01-01"), job("other", "2024-01-01", "2"))
    arrive(spark, sources["job_run_timeline"], "job_run_timeline", slice_of(1), slice_of(3), slice_of(4, job="2"))
    run_refresh(lake, sources)
    written = recorded(monkeypatch)
    run_refresh(lake, sources)
    assert written == {}
    arrive(spark, sources["jobs"], "jobs", job("new", "2024-02-01"))
    run_refresh(lake, sources)
    assert written == {"job_runs_summary": [[1, 3]]}
    arrive(spark, sources["job_run_timeline"], "job_run_timeline", slice_of(4, run="late"))
    run_refresh(lake, sources)
    assert written["job_runs_summary"][1:] == [[4]] and written["job_runs_daily"] == [[4]]
    got = as_set(lake.gold("job_runs_summary").read(), "run_date", "job_name", "total_runs")
    assert {(d.day, n, c) for d, n, c in got} == {(1, "new", 1), (3, "new", 1), (4, "other", 1), (4, "new", 1)}


def test_a_failed_rebuild_of_names_is_made_up_for(spark, tmp_path, lake, monkeypatch):
    sources = {f: str(tmp_path / f) for f in ("jobs", "job_run_timeline")}
    arrive(spark, sources["jobs"], "jobs", job("old", "2024-01-01"))
    arrive(spark, sources["job_run_timeline"], "job_run_timeline", slice_of(1))
    run_refresh(lake, sources)
    arrive(spark, sources["jobs"], "jobs", job("new", "2024-02-01"))
    with monkeypatch.context() as broken:
        broken.setattr(Table, "overwrite_dates", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run_refresh(lake, sources)
    run_refresh(lake, sources)
    assert as_set(lake.gold("job_runs_summary").read(), "job_name") == {("new",)}


def test_a_run_over_midnight_counts_on_its_first_date(spark, tmp_path, lake):
    sources = {f: str(tmp_path / f) for f in ("jobs", "job_run_timeline")}
    arrive(spark, sources["jobs"], "jobs", job("n", "2024-01-01"))
    first = slice_of(1, hour=23, state=None) | {"run_id": "x", "period_end_time": at("2024-01-02")}
    second = slice_of(2, state="FAILED") | {"run_id": "x"}
    for rows in ([first, slice_of(2)], [second]):
        arrive(spark, sources["job_run_timeline"], "job_run_timeline", *rows)
        run_refresh(lake, sources, merge_slices=True)
    got = lake.gold("job_runs_summary").read().select("run_date", "total_runs", "failed_runs", "max_duration_seconds").collect()
    assert {(r[0].day, *r[1:]) for r in got} == {(1, 1, 1, 5400), (2, 1, 0, 1800)}


def entity(kind, changed, key="e", endpoint="p", **more):
    return {"served_entity_id": key, "account_id": "a", "workspace_id": "1", "endpoint_name": endpoint, "endpoint_id": "1", "entity_type": kind,
            "entity_name": f"{kind}-model", "change_time": at(changed)} | more


def request(n, key="e"):
    return {"account_id": "a", "workspace_id": "1", "served_entity_id": key, "request_time": at(f"2024-01-{n:02} 10:00:00"),
            "input_token_count": 10, "output_token_count": 1}


def test_a_changed_entity_leaves_the_reports_of_its_old_kind(spark, tmp_path, lake, monkeypatch):
    sources = {f: str(tmp_path / f) for f in ("usage", "list_prices", "served_entities", "endpoint_usage")}
    set_prices(spark, sources["list_prices"], price(1, "2023-01-01"))

    def serving_day(n, rid):
        row = usage_row(rid, f"2024-01-{n:02} 00:00:00", f"2024-01-{n:02} 01:00:00", product="MODEL_SERVING")
        return tuple((None,) * 7 + ("p",) if f == "usage_metadata" else v for f, v in zip(feed_schema("usage").names, row, strict=True))

    add_usage(spark, sources["usage"], serving_day(1, "a"), serving_day(6, "b"), day(7))
    arrive(spark, sources["served_entities"], "served_entities", entity("EXTERNAL_MODEL", "2024-01-01"), entity("CUSTOM", "2024-01-01", "f", "q"))
    arrive(spark, sources["endpoint_usage"], "endpoint_usage", request(1), request(2), request(5, "f"))
    run_refresh(lake, sources)
    days = lambda name: {d.day for (d,) in as_set(lake.gold(name).read(), "usage_date")}
    assert days("external_model_usage") == {1, 2} and days("foundation_model_usage") == set()
    written = recorded(monkeypatch)
    arrive(spark, sources["served_entities"], "served_entities", entity("FOUNDATION_MODEL", "2024-01-09"))
    run_refresh(lake, sources)
    assert days("external_model_usage") == set() and days("foundation_model_usage") == {1, 2}
    assert written == {
        **dict.fromkeys(["endpoint_usage_summary", "foundation_model_usage", "external_model_usage"], [[1, 2]]),
        "model_serving_costs": [[1, 6]],
    }
    assert as_set(lake.gold("model_serving_costs").read(), "entity_type") == {("FOUNDATION_MODEL",)}
    add_usage(spark, sources["usage"], serving_day(6, "c"), serving_day(8, "d"))
    run_refresh(lake, sources)
    assert written["model_serving_costs"][1:] == [[6, 8]]
    inventory = lake.gold("endpoint_inventory").read()
    assert as_set(inventory, "endpoint_name", "entity_type", "total_cost_usd_30d", "last_billing_date") == {
        ("p", "FOUNDATION_MODEL", Decimal(8), dt.date(2024, 1, 8)),
        ("q", "CUSTOM", None, None),
    }


def run_of(n, user, status="FINISHED", run=None):
    return {"account_id": "a", "workspace_id": "w", "run_id": run or f"r{n}{user}", "experiment_id": "x", "created_by": user, "status": status,
            "start_time": at(f"2024-01-{n:02} 01:00:00"), "update_time": at(f"2024-01-{n:02} 01:00:00")}


def test_experiments_are_merged_from_states_of_touched_dates(spark, tmp_path, lake, monkeypatch):
    sources = {f: str(tmp_path / f) for f in ("experiments_latest", "runs_latest")}
    experiment = {"account_id": "a", "workspace_id": "w", "experiment_id": "x", "name": "n"}
    arrive(spark, sources["experiments_latest"], "experiments_latest", experiment)
    arrive(spark, sources["runs_latest"], "runs_latest", run_of(1, "ann"), run_of(2, "ann", "FAILED"), run_of(2, None))
    run_refresh(lake, sources)
    read, states = [], tracking.daily_run_states

    def seen(runs):
        read.append(({d.day for (d,) in as_set(runs, "_day")}, plan_of(runs)))
        return states(runs)

    monkeypatch.setattr(tracking, "daily_run_states", seen)
    arrive(spark, sources["runs_latest"], "runs_latest", run_of(2, "bob"), run_of(2, "ann"))
    run_refresh(lake, sources)
    assert [days for days, _ in read] == [{2}]
    assert "PartitionFilters: [isnotnull(_day" in read[0][1] and "2024-01-02" in read[0][1]
    got = lake.gold("mlflow_experiments_summary").read().select("total_runs", "successful_runs", "failed_runs", "first_run", "last_run", "distinct_users")
    assert [tuple(r) for r in got.collect()] == [(5, 4, 1, at("2024-01-01 01:00:00"), at("2024-01-02 01:00:00"), 2)]


# --- bronze: merged loads, retention
def test_merged_loads_are_not_new_rows(spark, tmp_path, lake, monkeypatch):
    """After ten refreshes a closed date has few files, and no row is read or rebuilt twice."""
    sources = {"audit": str(tmp_path / "audit")}
    event = lambda n, action: {"account_id": "a", "workspace_id": "w", "event_time": at(f"2024-01-{n:02}"), "event_date": dt.date(2024, 1, n),
                               "service_name": "s", "action_name": action, "user_identity": ("u@x", "u")}
    for i in range(10):
        arrive(spark, sources["audit"], "audit", event(1, f"a{i}"), *([event(2, "b")] if i == 3 else []))
        run_refresh(lake, sources)
    path = lake.bronze_path("audit_logs_bronze")
    on = lambda day: [f for f in files.data_files(spark, path) if f"event_date=2024-01-{day:02}" in f]
    assert len(on(1)) == 10 and len(on(2)) == 1
    assert {r.error for r in run_daily(lake, as_of=dt.date(2024, 1, 9)).collect() if r.table == "audit_logs_bronze"} == set()
    assert len(on(1)) == 1 and len(on(2)) == 1
    actions = {(f"a{i}",) for i in range(10)} | {("b",)}
    assert lake.bronze("audit_logs_bronze").count() == 11 and as_set(lake.bronze("audit_logs_bronze"), "action_name") == actions
    written = recorded(monkeypatch)
    run_refresh(lake, sources)
    assert written == {}
    arrive(spark, sources["audit"], "audit", event(1, "late"))
    run_refresh(lake, sources)
    assert written["user_activity_summary"] == [[1]]
    counts = {(d.day, n) for d, n in as_set(lake.gold("user_activity_summary").read(), "event_date", "event_count")}
    assert counts == {(1, 11), (2, 1)}


def test_loads_that_a_consumer_has_not_read_are_kept(spark, tmp_path, lake):
    source = str(tmp_path / "usage")
    for n in range(4):
        add_usage(spark, source, day(1, f"r{n}"))
        ingest_feed(spark, "billing_usage_bronze", source, lake.bronze_path("billing_usage_bronze"), lake.checkpoint("billing_usage_bronze"))
        if n == 1:
            refresh.rebuild_on_new_bronze(spark, "billing_usage_bronze", lake.bronze_path("billing_usage_bronze"), lake.checkpoint("x_from_billing_usage_bronze"), lambda dates: None)
    path = lake.bronze_path("billing_usage_bronze")
    upto = refresh.consumed(spark, f"{lake.root}/checkpoints", "billing_usage_bronze", path)
    assert upto == 2
    merge = lambda: layout.merge_loads(spark, path, "usage_date", lake.bronze("billing_usage_bronze").schema, upto, most_files=1)
    assert merge() == ["usage_date=2024-01-01"] and merge() == []
    assert sorted(f.rsplit("/", 2)[1] for f in files.data_files(spark, path)) == ["_load=0", "_load=3", "_load=4"]
    assert lake.bronze("billing_usage_bronze").count() == 4


@pytest.mark.parametrize("broken_at", [0, 1])
def test_a_merge_that_broke_off_is_finished(spark, tmp_path, monkeypatch, broken_at):
    source, path, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for n in range(3):
        add_usage(spark, source, day(1, f"r{n}"), day(2, f"s{n}"))
        ingest_feed(spark, "billing_usage_bronze", source, path, state)
    bronze = lambda: read_bronze(spark, path, "billing_usage_bronze")
    move, calls = layout.move, []

    def failing(*args):
        calls.append(args)
        if len(calls) > broken_at:
            raise RuntimeError("lost")
        move(*args)

    with monkeypatch.context() as broken:
        broken.setattr(layout, "move", failing)
        with pytest.raises(RuntimeError):
            layout.merge_loads(spark, path, "usage_date", bronze().schema, 3, most_files=1)
    layout.merge_loads(spark, path, "usage_date", bronze().schema, 3, most_files=1)
    assert as_set(bronze(), "record_id") == {(f"{x}{n}",) for x in "rs" for n in range(3)} and bronze().count() == 6
    assert len(list(files.data_files(spark, path))) == 2


def test_a_retried_batch_adds_nothing(spark, tmp_path):
    source, path, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    add_usage(spark, source, day(1), day(2))
    ingest_feed(spark, "billing_usage_bronze", source, path, state)
    for mark in ("0", ".0.crc"):
        (tmp_path / "state" / "commits" / mark).unlink()
    ingest_feed(spark, "billing_usage_bronze", source, path, state)
    assert read_bronze(spark, path, "billing_usage_bronze").count() == 2


def test_retention_drops_dates_and_keeps_undated_rows(spark, tmp_path, lake):
    rows = spark.createDataFrame([(None, 1), (dt.date(2024, 1, 1), 2), (dt.date(2024, 1, 9), 3)], "d DATE, v INT")
    assert as_set(layout.retained(rows, "d", 3, as_of=dt.date(2024, 1, 10)), "v") == {(1,), (3,)}
    table = Table(spark, str(tmp_path / "t"), "d")
    table.replace(rows)
    kept = [f for f in files.data_files(spark, table.path()) if "2024-01-01" not in f]
    assert layout.retain(table, 3, as_of=dt.date(2024, 1, 10)) == [dt.date(2024, 1, 1)]
    assert as_set(table.read(), "v") == {(1,), (3,)} and sorted(files.data_files(spark, table.path())) == sorted(kept)
    sources = {"usage": str(tmp_path / "usage"), "list_prices": str(tmp_path / "prices")}
    set_prices(spark, sources["list_prices"], price(1, "2023-01-01"))
    add_usage(spark, sources["usage"], day(1), day(20))
    run_refresh(lake, sources)
    run_daily(lake, as_of=dt.date(2024, 1, 21), bronze_days=5, aggregate_days=30)
    assert lake.bronze("billing_usage_bronze").count() == 1 and lake.gold("cost_by_product").read().count() == 2
    run_daily(lake, as_of=dt.date(2024, 1, 21), bronze_days=5, aggregate_days=5)
    assert lake.gold("cost_by_product").read().count() == 1


def test_a_price_that_was_null_prices_its_dates(spark):
    keys = ["sku_name", "cloud", "currency_code", "price_start_time"]
    old = spark.createDataFrame([(*price(1, "2024-01-01")[:4], None, at("2024-01-01"), at("2024-01-31"))], PRICES)
    new = spark.createDataFrame([price(2, "2024-01-01", "2024-01-31")], PRICES)
    used = spark.createDataFrame([day(1), day(3), usage_row("u", "2024-02-20 00:00:00", "2024-02-20 01:00:00")], USAGE)
    assert [d.day for d in refresh.dates_of_price_changes(change_feed(old, new, keys), used)] == [1, 3]


# --- changes that streams follow
def test_changes_are_told_once(spark, tmp_path, monkeypatch):
    rows = lambda *r: spark.createDataFrame(list(r), "d DATE, k STRING, v INT")
    one, two = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    table = Table(spark, str(tmp_path / "t"), "d", ["d", "k"])
    told = lambda: {tuple(r) for r in spark.read.parquet(table.changes()).select("_change", "_change_type", "d", "k", "v").collect()}
    table.overwrite_dates(rows((one, "a", 1), (two, "a", 1), (None, "n", 0)), [one, two, None])
    first = {(1, "insert", one, "a", 1), (1, "insert", two, "a", 1), (1, "insert", None, "n", 0)}
    assert told() == first
    for broken_at in ("overwrite", "move"):
        with monkeypatch.context() as broken:
            if broken_at == "move":
                broken.setattr(files, "move", lambda s, a, b: (_ for _ in ()).throw(RuntimeError("lost")) if a.endswith("/changes") else files_move(s, a, b))
            else:
                broken.setattr(Table, "_overwrite", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                table.overwrite_dates(rows((two, "a", 2), (two, "b", 1)) if broken_at == "overwrite" else rows((two, "b", 3)), [one, two], emptied=True)
        assert len(told()) == (3 if broken_at == "overwrite" else 7)
        table.overwrite_dates(rows((None, "n", 0)), [None])
    assert told() == first | {
        (2, "delete", one, "a", 1), (2, "update_preimage", two, "a", 1), (2, "update_postimage", two, "a", 2), (2, "insert", two, "b", 1),
        (4, "delete", two, "a", 2), (4, "update_preimage", two, "b", 1), (4, "update_postimage", two, "b", 3),
    }
    same = replayed(spark.read.parquet(table.changes()), ["d", "k"])
    assert as_set(same, "d", "k", "v") == as_set(table.read(), "d", "k", "v") == {(two, "b", 3), (None, "n", 0)}
    stream = table.read_changes().writeStream.format("memory").queryName("told_once").trigger(availableNow=True)
    stream.option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination()
    assert spark.table("told_once").count() == 10


def test_compaction_bounds_the_rows_of_a_file(spark, tmp_path, monkeypatch):
    """A task sorts the rows of a file, however well they compress."""
    table = Table(spark, f"{tmp_path}/rows")
    table.replace(spark.range(1000).selectExpr("id a", "id % 7 b"))
    assert layout.compact(table, ["a", "b"], interleave=True) == 1
    monkeypatch.setattr(layout, "TARGET_FILE_ROWS", 100, raising=False)
    assert layout.compact(table, ["a", "b"], interleave=True) == 10
    assert sorted(r.a for r in table.read().collect()) == list(range(1000))


def test_interleaved_ranges_skip_files_by_either_column(spark, tmp_path):
    rows = spark.range(20_000).select((F.col("id") % 100).alias("a"), F.concat(F.lit("s"), F.lpad((F.col("id") * 7919 % 97).cast("string"), 2, "0")).alias("b"), "id")
    rows = rows.unionByName(spark.createDataFrame([(None, None, -1)], rows.schema))

    def opened(layout_of, folder, column, value):
        path = str(tmp_path / folder)
        layout_of(rows).write.parquet(path)
        footers = [pq.read_metadata(f.removeprefix("file:")).row_group(0) for f in files.data_files(spark, path)]
        at = [rg.column({"a": 0, "b": 1}[column]).statistics for rg in footers]
        assert len(at) == 16 and spark.read.parquet(path).count() == 20_001
        return sum(s.min <= value <= s.max for s in at)

    z = lambda df: layout.zordered(df, ["a", "b"], 16)
    assert opened(z, "z_a", "a", 50) <= 6 and opened(z, "z_b", "b", "s50") <= 6
    assert opened(lambda df: layout.clustered(df, ["a", "b"], 16), "sorted", "b", "s50") >= 12


def test_interleaved_files_hold_whole_blocks(spark, tmp_path):
    """Ranges from a random sample opened 5 to 9 of 16 files for a value, another number each time."""
    rows = spark.range(20_000).select((F.col("id") % 100).alias("a"), (F.col("id") * 7919 % 97).alias("b"), "id")
    for run in range(2):
        layout.zordered(rows, ["a", "b"], 16).write.parquet(str(tmp_path / str(run)))
        footers = [pq.read_metadata(f.removeprefix("file:")).row_group(0) for f in files.data_files(spark, str(tmp_path / str(run)))]
        for column, values in ((0, 100), (1, 97)):
            at = [rg.column(column).statistics for rg in footers]
            assert max(sum(s.min <= v <= s.max for s in at) for v in range(values)) <= 5
        assert len(footers) == 16 and max(rg.num_rows for rg in footers) <= 1.5 * 1250
    one = spark.range(8_000).select(F.when(F.col("id") < 7_000, 1).otherwise(F.col("id")).alias("a"), "id")  # a heavy cell
    sizes = [r["count"] for r in layout.zordered(one, ["a"], 8).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and sum(sizes) == 8_000 and max(sizes) <= 1_500
    assert layout.zordered(one.where("false"), ["a"], 8).count() == 0
    assert layout._file_cuts([(0, 10), (1, 10), (2, 10), (3, 10)], 2) == [(0, 0, []), (1, 0, []), (2, 1, []), (3, 1, [])]
    assert layout._file_cuts([(5, 40)], 4) == [(5, 0, [0.25, 0.5, 0.75])]
