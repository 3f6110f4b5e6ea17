"""Append-only ingestion of source feeds into bronze tables with Structured Streaming.

The file source hands over each new file once. A batch is a load: it writes folders of
its own below each date, ``_load=<number>``, and a retried one replaces them, so nothing
is there twice. Loads that all consumers have read are merged (``sources.layout``) into
``_load=0``, in files of another name that streams pass over. Nothing here keeps state:
late rows are simply new rows, and the datasets of their date are rebuilt (see
``refresh``).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlens.functions import stamp_identifiers
from meterlens.schemas import feed_schema
from meterlens.sources import files
from meterlens.sources.files import has_files
from meterlens.sources.tables import LOAD, balanced, rows_by_date

#: The hidden file that holds the number of the last load, and the names of files that streams take.
NEWEST, NEW_FILES = "_newest", "part-*"
# The dates to rebuild, in order, with None last for rows without a date. There is no limit: a calendar is short,
# and dates in a row become one range (``only_dates``).
Dates = list[dt.date | None]


@dataclass(frozen=True)
class Bronze:
    """How a feed is ingested.

    ``day`` is the column whose day partitions the table: a DATE column itself, or a
    timestamp whose date is added as ``_day``.
    """

    feed: str
    day: str | None = None
    day_is_date: bool = False
    max_files: int | None = None
    ingested_at: bool = False

    @property
    def date_col(self) -> str | None:
        return None if self.day is None else self.day if self.day_is_date else "_day"


BRONZE = {
    "billing_usage_bronze": Bronze("usage", "usage_date", True, max_files=1000, ingested_at=True),
    "jobs_bronze": Bronze("jobs"),
    "job_runs_bronze": Bronze("job_run_timeline", "period_start_time"),
    "clusters_bronze": Bronze("clusters"),
    "audit_logs_bronze": Bronze("audit", "event_date", True, max_files=1000),
    "served_entities_bronze": Bronze("served_entities", ingested_at=True),
    "endpoint_usage_bronze": Bronze("endpoint_usage", "request_time", ingested_at=True),
    "mlflow_experiments_bronze": Bronze("experiments_latest", ingested_at=True),
    "mlflow_runs_bronze": Bronze("runs_latest", "start_time", ingested_at=True),
    "mlflow_metrics_bronze": Bronze("run_metrics_history", "metric_time", ingested_at=True),
}


def read_feed_stream(
    spark: SparkSession, feed: str, path: str, *, max_files: int | None = None, schema: StructType | None = None
) -> DataFrame:
    """New files of a feed as a stream; ``schema`` widens the documented one (``evolved_schema``)."""
    reader = spark.readStream.schema(schema or feed_schema(feed))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def bronze_stream(stream: DataFrame, table: str, account: str | None = None, workspace: str | None = None) -> DataFrame:
    """The feed's rows with lineage columns, as the bronze table stores them."""
    spec = BRONZE[table]
    rows = stamp_identifiers(stream, account, workspace)
    if spec.ingested_at:
        rows = rows.withColumn("_ingested_at", F.current_timestamp())
    if spec.date_col == "_day":
        rows = rows.withColumn("_day", F.to_date(spec.day))
    return rows


def ingest(rows: DataFrame, table: str, target: str, checkpoint: str) -> None:
    """Append everything that has arrived, in batches of the source's file cap, then stop.

    A batch adds even files to each of its dates: a heavy date is split over tasks.
    """
    date_col = BRONZE[table].date_col

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        dates = rows_by_date(batch, date_col) if date_col else None
        loaded = balanced(batch, date_col, dates).withColumn(LOAD, F.lit(batch_id + 1))
        by = [date_col, LOAD] if date_col else [LOAD]
        loaded.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(target)
        files.replace_text(batch.sparkSession, f"{target}/{NEWEST}", str(batch_id + 1))

    query = rows.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


def newest_load(spark: SparkSession, path: str) -> int:
    """The number of the last load of a bronze table, 0 without any."""
    mark = f"{path}/{NEWEST}"
    return int(files.read_text(spark, mark)) if files.exists(spark, mark) else 0


def distinct_dates(rows: DataFrame, date_col: str) -> Dates:
    """The dates present."""
    return sorted((r[0] for r in rows.select(date_col).distinct().collect()), key=lambda d: (d is None, d or dt.date.min))


def ingest_feed(
    spark: SparkSession,
    table: str,
    source: str,
    target: str,
    checkpoint: str,
    *,
    account: str | None = None,
    workspace: str | None = None,
    schema: StructType | None = None,
) -> None:
    spec = BRONZE[table]
    stream = read_feed_stream(spark, spec.feed, source, max_files=spec.max_files, schema=schema)
    ingest(bronze_stream(stream, table, account, workspace), table, target, checkpoint)


def bronze_schema(spark: SparkSession, table: str) -> StructType:
    """The documented columns of a bronze table: its feed's and the lineage columns."""
    empty = spark.createDataFrame([], feed_schema(BRONZE[table].feed))
    return bronze_stream(empty, table, "", "").schema


def read_bronze(spark: SparkSession, path: str, table: str | None = None, *, merge_schema: bool = False) -> DataFrame:
    """A bronze table as a batch.

    With ``table`` its documented schema is taken, so an empty table, or one that isn't
    there yet, is read as no rows. ``merge_schema`` also finds columns that files have
    beyond it.
    """
    if table is None:
        return spark.read.option("mergeSchema", merge_schema).parquet(path).drop(LOAD)
    known = bronze_schema(spark, table)
    if not has_files(spark, path):
        return spark.createDataFrame([], known)
    if merge_schema:
        found = spark.read.option("mergeSchema", True).parquet(path).schema
        known = StructType(known.fields + [f for f in found.fields if f.name not in (*known.names, LOAD)])
    return spark.read.schema(known).parquet(path).drop(LOAD)
