"""Batch access to source feeds: snapshots, schema evolution, health probes."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlens.functions import Day, days_before, stamp_identifiers
from meterlens.schemas import feed_schema
from meterlens.sources.failures import FAILURES, first_line
from meterlens.sources.together import together


def read_snapshot(
    spark: SparkSession,
    feed: str,
    path: str,
    *,
    account: str | None = None,
    workspace: str | None = None,
    workspace_level: bool = True,
    snapshot_time: bool = False,
) -> DataFrame:
    """A feed read whole, with lineage columns and on request the time of the snapshot."""
    df = stamp_identifiers(
        spark.read.schema(feed_schema(feed)).parquet(path), account, workspace, workspace_level=workspace_level
    )
    return df.withColumn("_snapshot_time", F.current_timestamp()) if snapshot_time else df


def evolved_schema(spark: SparkSession, feed: str, path: str) -> StructType:
    """The feed's documented schema plus any top-level columns its files have gained."""
    known = feed_schema(feed)
    found = spark.read.option("mergeSchema", True).parquet(path).schema
    return StructType(known.fields + [f for f in found.fields if f.name not in known.names])


def union_evolving(*frames: DataFrame) -> DataFrame:
    """Union of frames with different columns; a missing column is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


@dataclass(frozen=True)
class Probe:
    """What to check of a feed: count all rows, or those of the last ``days`` by ``date_col``."""

    read: Callable[[], DataFrame]
    date_col: str | None = None
    days: int | None = None


def source_probe(spark: SparkSession, probes: Mapping[str, Probe], *, as_of: Day = None) -> DataFrame:
    """Row count and newest date per feed, one row each; a feed that can't be read reports its error.

    The newest date is that of all rows, so a feed without recent rows shows how old it
    is. Each feed is its own job: one that fails leaves the others alone.
    """

    def one(name: str, probe: Probe) -> tuple:
        try:
            recent = F.lit(True) if probe.days is None else F.col(probe.date_col) >= days_before(as_of, probe.days)
            newest = F.max(probe.date_col).cast("date") if probe.date_col else F.lit(None).cast("date")
            count, newest_date = probe.read().agg(F.count_if(recent), newest).first()
            return name, count, newest_date, None
        except FAILURES as error:
            return name, None, None, first_line(error)

    rows = together(partial(one, name, probe) for name, probe in probes.items())
    return spark.createDataFrame(rows, "feed STRING, row_count BIGINT, newest_date DATE, error STRING")
