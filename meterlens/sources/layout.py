"""Maintenance of stored tables: compaction, clustering, retention."""

from __future__ import annotations

import bisect
import datetime as dt
import itertools
import math
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from meterlens.functions import Day, days_before
from meterlens.sources.failures import FAILURES, first_line
from meterlens.sources.scratch import new_folder
from meterlens.sources.files import data_files, delete, exists, move, names, read_text, write_text
from meterlens.sources.tables import LOAD, Table, balanced, date_of, folder_of, folders_by_date, only_dates

TARGET_FILE_BYTES = 512 * 1024 * 1024
#: A task sorts the rows of a file: rows that compress well make no larger ones.
TARGET_FILE_ROWS = 4_000_000
#: Rows that the bounds of a layout are taken from.
SAMPLE = 10_000
#: Rows are counted by so many of a cell's first bits.
CELL_BITS = 16
#: A date of a bronze table with more files is merged.
MOST_FILES = 8
_MERGING, _COMPLETE = "_merging", "_complete"
#: Days that bronze tables and aggregates are kept.
BRONZE_DAYS, AGGREGATE_DAYS = 90, 365

# Clustering columns per stored table.
CLUSTER_COLUMNS = {
    "billing_usage_bronze": ["usage_date", "workspace_id"],
    "audit_logs_bronze": ["event_date", "service_name"],
    "endpoint_usage_bronze": ["served_entity_id", "request_time"],
    "mlflow_runs_bronze": ["start_time", "experiment_id"],
}


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files below a path, from a distributed listing that opens none of them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def clustered(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """Range-partition and sort by the columns, so file statistics skip most files of a filter.

    A row hash after the columns lets the ranges cut through a single heavy value.
    """
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    ranged = df.repartitionByRange(files, *columns, F.xxhash64(*hashable))
    return ranged.sortWithinPartitions(*columns)


def range_rank(column: str, bounds: Sequence) -> Column:
    """How many of the ascending bounds a value reaches; 0 for NULL."""
    reached = (F.when(F.col(column) >= F.lit(b), 1).otherwise(0) for b in bounds)
    return sum(reached, F.lit(0))


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """One number whose bits are those of the ranks in turn, the first bits first."""
    taken = ((F.shiftright(rank.cast("bigint"), bit).bitwiseAND(F.lit(1)), bit * len(ranks) + len(ranks) - 1 - i) for i, rank in enumerate(ranks) for bit in range(bits))
    return sum((F.shiftleft(value, place) for value, place in taken), F.lit(0).cast("bigint"))


def _file_cuts(counts: Sequence[tuple[int, int]], files: int) -> list[tuple[int, int, list[float]]]:
    """For each cell with its rows, in order: the first of its files, and the shares of its rows at which the next ones begin.

    Files get about equal rows. A cut goes to the end of a cell that is at most a quarter of a
    file away, the one of the largest block of cells, so that files hold whole blocks; if there is
    none, it stays inside a heavy cell.
    """
    ends = list(itertools.accumulate(n for _, n in counts))
    each = ends[-1] / files if ends else 0
    cuts = []
    for k in range(1, files):
        low, high = (bisect.bisect_left(ends, each * (k + d)) for d in (-0.25, 0.25))
        near = [i for i in range(low, min(high + 1, len(ends) - 1)) if abs(ends[i] - each * k) <= each / 4]
        # the highest bit in which this cell and the next differ is that of the block that ends between them
        best = max(near, key=lambda i: ((counts[i][0] ^ counts[i + 1][0]).bit_length(), -abs(ends[i] - each * k)), default=None)
        cuts.append(each * k if best is None else ends[best])
    out = []
    for (cell, n), end in zip(counts, ends, strict=True):
        first = bisect.bisect_right(cuts, end - n)
        out.append((cell, first, [(x - end + n) / n for x in cuts[first : bisect.bisect_left(cuts, end)]]))
    return out


def zordered(df: DataFrame, columns: Sequence[str], files: int, bits: int = 4) -> DataFrame:
    """Lay rows out by all columns alike, so that file statistics skip files of a filter on any one of them.

    Each column is cut into 2^bits ranges of about equal size, by bounds from a sample of
    ``SAMPLE`` rows or so (it moves no row out of the result, only between files), and the
    interleaved bits of its ranges are a row's cell. Files are cut by counted rows at the
    ends of blocks of cells; a row hash cuts through a single heavy cell.
    """
    share = min(1.0, SAMPLE / max(1, df.count()))
    sampled = df.select(*columns).sample(share, seed=17).collect()
    ranks = []
    for i, column in enumerate(columns):
        values = sorted(r[i] for r in sampled if r[i] is not None)
        steps = range(1, 1 << bits) if values else ()
        ranks.append(range_rank(column, sorted({values[len(values) * k >> bits] for k in steps})))
    cell, block, file = "_cell", "_block", "_file"  # columns of their own, or the sort works the cell out again at each comparison
    placed = df.withColumn(cell, interleaved(ranks, bits))
    placed = placed.withColumn(block, F.shiftright(cell, max(0, bits * len(columns) - CELL_BITS)))
    counts = sorted((r[block], r["count"]) for r in placed.groupBy(block).count().collect())
    found = df.sparkSession.createDataFrame(_file_cuts(counts, files), f"{block} long, _first int, _begins array<double>")
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    part = F.shiftrightunsigned(F.xxhash64(*hashable), 11) / F.lit(float(1 << 53))
    number = F.col("_first") + F.size(F.filter("_begins", lambda x: x <= part))
    laid_out = placed.join(F.broadcast(found), block, "left").withColumn(file, F.coalesce(number, F.lit(0)))
    return laid_out.repartitionById(files, F.col(file)).sortWithinPartitions(cell, *columns).select(*df.columns)


def _planned_files(content: DataFrame, path: str, target_bytes: int) -> int:
    return max(1, math.ceil(stored_bytes(content.sparkSession, path) / target_bytes), math.ceil(content.count() / TARGET_FILE_ROWS))


def compact(table: Table, columns: Sequence[str] = (), target_bytes: int = TARGET_FILE_BYTES, *, interleave: bool = False) -> int:
    """Rewrite a whole table into files of about ``target_bytes`` in cluster order; returns their planned number.

    ``interleave`` lays a table without a date column out by all ``columns`` alike
    (``zordered``), not by the first before the others.
    """
    by = list(dict.fromkeys([*([table.date_col] if table.date_col else []), *columns]))
    content = table.read()
    files = _planned_files(content, table.path(), target_bytes)
    if interleave and by:
        laid_out = zordered(content, by, files)
    else:
        laid_out = clustered(content, by, files) if by else content.repartition(files)
    table.replace(laid_out, laid_out=True)
    return files


def compact_dates(
    table: Table, dates: Sequence, columns: Sequence[str] = (), target_bytes: int = TARGET_FILE_BYTES
) -> int:
    """Rewrite only some dates of a table; the cost does not grow with its history.

    The dates are staged in the shared folder first, as a table cannot overwrite the
    files it is being read from; the staged copy is removed afterwards.
    """
    staged = new_folder(table.spark, "compact")
    only_dates(table.read(), table.date_col, dates).write.partitionBy(table.date_col).parquet(staged)
    content = table.spark.read.schema(table.read().schema).parquet(staged)
    files = _planned_files(content, staged, target_bytes)
    table.overwrite_dates(clustered(content, [table.date_col, *columns], files), laid_out=True)
    delete(table.spark, staged)
    return files


def refresh_clustered(copy: Table, content: DataFrame, columns: Sequence[str]) -> None:
    """Write the given dates of a copy that is kept in cluster order, once.

    Adaptive execution cuts a heavy date into even files and merges light ones; inside a
    file rows are sorted, so its statistics let filters skip most row groups.
    """
    even = content.hint("rebalance", F.col(copy.date_col))
    copy.overwrite_dates(even.sortWithinPartitions(copy.date_col, *columns), laid_out=True)


def compact_all(
    spark: SparkSession, tables: Mapping[str, Table], dates: Sequence | None = None
) -> DataFrame:
    """Compact each table, going on past failures; one report row per table.

    With ``dates``, tables partitioned by date are rewritten only there.
    """
    report = []
    for name, table in tables.items():
        columns = CLUSTER_COLUMNS.get(name, ())
        try:
            whole = dates is None or table.date_col is None
            report.append((name, compact(table, columns) if whole else compact_dates(table, dates, columns), None))
        except FAILURES as error:
            report.append((name, None, first_line(error)))
    return spark.createDataFrame(report, "table STRING, files INT, error STRING")


def _files_by_date(spark: SparkSession, path: str, date_col: str | None) -> dict[str, list[tuple[int, str]]]:
    """Load number and path of every file of a bronze table, by the name of its date's folder ("" without dates)."""
    found: dict[str, list[tuple[int, str]]] = {}
    for file in data_files(spark, path):
        parts = file.rsplit("/", 3 if date_col else 2)
        if parts[-2].startswith(f"{LOAD}="):  # not what is staged
            found.setdefault(parts[-3] if date_col else "", []).append((int(parts[-2].partition("=")[2]), file))
    return found


def merge_loads(
    spark: SparkSession, path: str, date_col: str | None, schema: StructType, upto: int, *, most_files: int = MOST_FILES
) -> list[str]:
    """Rewrite the dates of a bronze table that have many files of loads up to ``upto`` into even ones.

    Loads that a consumer hasn't read yet must be newer than ``upto``. The new files are
    staged in a hidden folder; once that is complete, the old ones of each date go and the
    new ones come into its load 0, under a name that streams pass over. A run that broke off
    is finished by the next one. Returns the folders of the dates; readers in between may
    miss a date, so this belongs into the daily job.
    """
    _finish_merge(spark, path)
    many = [d for d, found in _files_by_date(spark, path, date_col).items() if sum(load <= upto for load, _ in found) > most_files]
    if not many:
        return []
    loads = spark.read.schema(StructType([*schema.fields, StructField(LOAD, IntegerType())])).parquet(path)
    rows = loads.where(F.col(LOAD) <= upto).drop(LOAD)
    staged = f"{path}/{_MERGING}"
    if date_col:
        dates = [date_of(d) for d in many]
        balanced(only_dates(rows, date_col, dates), date_col, dates).write.mode("overwrite").partitionBy(date_col).parquet(staged)
    else:
        balanced(rows, None).write.mode("overwrite").parquet(staged)
    write_text(spark, f"{staged}/{_COMPLETE}", f"{upto} {uuid.uuid4().hex}")
    _finish_merge(spark, path)
    return many


def _finish_merge(spark: SparkSession, path: str) -> None:
    """Put staged files in place of the loads that they were made of; again, after a failure, from where it stopped."""
    staged = f"{path}/{_MERGING}"
    if not exists(spark, f"{staged}/{_COMPLETE}"):
        delete(spark, staged)
        return
    upto, merge = read_text(spark, f"{staged}/{_COMPLETE}").split()
    for folder in [n for n in names(spark, staged) if "=" in n] or [""]:
        live = f"{path}/{folder}".rstrip("/")
        for load in names(spark, live):
            if load.startswith(f"{LOAD}=") and int(load.partition("=")[2]) <= int(upto):
                for file in names(spark, f"{live}/{load}"):
                    if not file.startswith(f"merged-{merge}"):
                        delete(spark, f"{live}/{load}/{file}")
        for file in data_files(spark, f"{staged}/{folder}".rstrip("/")):
            move(spark, file, f"{live}/{LOAD}=0/merged-{merge}-{file.rsplit('/', 1)[1]}")
    delete(spark, staged)


def retained(df: DataFrame, date_col: str, days: int, *, as_of: Day = None) -> DataFrame:
    """Rows no older than ``days`` before ``as_of``, and those without a date."""
    return df.where((F.col(date_col) >= days_before(as_of, days)) | F.col(date_col).isNull())


def _too_old(spark: SparkSession, folders: list[str], days: int, as_of: Day) -> list[dt.date]:
    first = spark.range(1).select(days_before(as_of, days)).first()[0]
    return [d for d in map(date_of, folders) if d is not None and d < first]


def retain(table: Table, days: int, *, as_of: Day = None) -> list[dt.date]:
    """Drop the dates older than ``days`` from a table partitioned by date, and return them.

    Their folders are removed and no row is rewritten; rows without a date stay.
    """
    old = _too_old(table.spark, folders_by_date(table.spark, table.path(), table.date_col), days, as_of)
    table.drop_dates(old)
    return old


def retain_bronze(spark: SparkSession, path: str, date_col: str, days: int, *, as_of: Day = None) -> list[dt.date]:
    """``retain`` for a bronze table.

    A row that comes later for a date that is gone makes its datasets anew from that row alone.
    """
    old = _too_old(spark, folders_by_date(spark, path, date_col), days, as_of)
    for d in old:
        delete(spark, f"{path}/{folder_of(date_col, d)}")
    return old
