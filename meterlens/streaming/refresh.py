"""Incremental rebuild of dated datasets from new bronze rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.sources import files
from meterlens.sources.files import has_files
from meterlens.streaming.ingest import BRONZE, LOAD, NEW_FILES, Dates, distinct_dates, newest_load, read_bronze

#: The hidden file in a consumer's checkpoint folder that holds the number of the last load it has read.
CONSUMED = "_consumed"


def rebuild_on_new_rows(rows: DataFrame, date_col: str, checkpoint: str, rebuild: Callable[[Dates], None]) -> None:
    """Call ``rebuild`` with the dates of the rows that came since the last call.

    ``rows`` is a stream; only its date column is read. ``rebuild`` overwrites whole
    dates, so a batch that is retried after a failure gives the same result.
    """

    def on_batch(batch: DataFrame, _batch_id: int) -> None:
        dates = distinct_dates(batch, date_col)
        if dates:
            rebuild(dates)

    query = rows.select(date_col).writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


def rebuild_on_new_bronze(
    spark: SparkSession, table: str, bronze_path: str, checkpoint: str, rebuild: Callable[[Dates], None]
) -> None:
    """``rebuild_on_new_rows`` over a bronze table, whose date column is its partition column; nothing for an empty one."""
    if not has_files(spark, bronze_path):
        return
    newest = newest_load(spark, bronze_path)
    schema = read_bronze(spark, bronze_path, table).schema.add(LOAD, "integer")
    new = spark.readStream.schema(schema).option("pathGlobFilter", NEW_FILES).parquet(bronze_path)
    rebuild_on_new_rows(new, BRONZE[table].date_col, checkpoint, rebuild)
    files.replace_text(spark, f"{checkpoint}/{CONSUMED}", str(newest))


def consumed(spark: SparkSession, checkpoints: str, table: str, bronze_path: str) -> int:
    """The last load that every consumer of a bronze table has read; of one without consumers, the newest."""
    loads = [newest_load(spark, bronze_path)]
    for name in files.names(spark, checkpoints):
        if name.endswith(f"_from_{table}"):
            mark = f"{checkpoints}/{name}/{CONSUMED}"
            loads.append(int(files.read_text(spark, mark)) if files.exists(spark, mark) else 0)
    return min(loads)


def changed_intervals(changes: DataFrame) -> DataFrame:
    """``_sku, _cloud, _from, _to``: for each changed price, the time in which it now prices otherwise.

    A price that came, went or has another amount differs in its whole validity. One whose
    end alone was moved, as when the next price is announced, differs between the two ends.
    """
    forever = F.timestamp_seconds(F.lit(253402214400))
    end = F.coalesce("price_end_time", forever)
    both = changes.groupBy("sku_name", "cloud", "currency_code", "price_start_time").agg(
        F.min(end).alias("_first_end"),
        F.max(end).alias("_to"),
        F.count("*").alias("_rows"),
        F.count_distinct(F.coalesce(F.to_json("pricing"), F.lit(""))).alias("_amounts"),
    )
    moved = (F.col("_rows") == 2) & (F.col("_amounts") == 1)
    start = F.when(moved, F.col("_first_end")).otherwise(F.col("price_start_time"))
    return both.select(F.col("sku_name").alias("_sku"), F.col("cloud").alias("_cloud"), start.alias("_from"), "_to")


def dates_of_price_changes(changes: DataFrame, usage: DataFrame) -> Dates:
    """Dates of the usage that a changed price bears on: same SKU and cloud, and within the changed time."""
    changed = changed_intervals(changes)
    bounds = changed.agg(F.to_date(F.min("_from")).alias("first"), F.to_date(F.max("_to")).alias("last")).first()
    if bounds["first"] is None:
        return []
    # As literals on the date column, so that partitions are pruned; a row may run over midnight, or have no date.
    day = dt.timedelta(days=1)
    last = min(bounds["last"], dt.date.max - day) + day
    near = F.col("usage_date").between(F.lit(bounds["first"] - day), F.lit(last))
    usage = usage.where(near | F.col("usage_date").isNull())
    touched = (
        (F.col("sku_name") == F.col("_sku"))
        & (F.col("cloud") == F.col("_cloud"))
        & (F.col("usage_start_time") <= F.col("_to"))
        & (F.coalesce("usage_end_time", "usage_start_time") >= F.col("_from"))
    )
    return distinct_dates(usage.join(changed, touched, "left_semi"), "usage_date")
