"""Stored datasets: Parquet with atomic replacement.

A table has two slots below its root. A replacement fills the slot not in use and then
moves a small file, the pointer, into place that names the slot and the schema; the one
before it goes. So a table can be rewritten from its own content, a failed rewrite leaves
readers where they were, and at most two copies exist. One writer per table is assumed.
Overwriting dates works in place: a reader that listed the table before should list it
again.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Mapping, Sequence, Sized
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from meterlens.operators.changes import change_feed
from meterlens.sources import files

_POINTER = "current-"
#: The folder of a load of a bronze table.
LOAD = "_load"
#: The hidden folder of an overwriting that isn't finished, and the column of its number among the changes.
_CHANGING, _COMPLETE, CHANGE = "_changing", "_complete", "_change"
#: More dates at once are a backfill.
MANY_DATES = 64
#: The name of the folder of rows without a date.
_UNDATED = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Stored:
    """Something stored that isn't a ``Table``, with the column that it is partitioned by."""

    df: DataFrame
    date_col: str | None = None

    def read(self) -> DataFrame:
        return self.df


class Table:
    """Parquet files below ``root``, by date if there is a ``date_col``.

    With ``change_keys``, the columns that tell rows apart, each overwriting of dates also
    appends what it changes to a folder that streams can read (``read_changes``).
    """

    def __init__(self, spark: SparkSession, root: str, date_col: str | None = None, change_keys: Sequence[str] = ()):
        self.spark, self.root, self.date_col, self.change_keys = spark, root.rstrip("/"), date_col, list(change_keys)

    def _latest(self) -> tuple[int, dict] | None:
        """The number and content of the newest pointer."""
        numbers = [int(n[len(_POINTER) :]) for n in files.names(self.spark, self.root) if n.startswith(_POINTER)]
        return (max(numbers), json.loads(files.read_text(self.spark, f"{self.root}/{_POINTER}{max(numbers)}"))) if numbers else None

    def exists(self) -> bool:
        return any(n.startswith(_POINTER) for n in files.names(self.spark, self.root))

    def path(self) -> str:
        return self._current()[0]

    def _current(self) -> tuple[str, StructType]:
        latest = self._latest()
        if latest is None:
            raise FileNotFoundError(f"no table at {self.root}")
        return f"{self.root}/{latest[1]['slot']}", StructType.fromJson(latest[1]["schema"])

    def read(self) -> DataFrame:
        """The current content; no file is opened to learn its schema. A column added later is NULL in older files."""
        path, schema = self._current()
        return self.spark.read.schema(schema).parquet(path)

    def replace(self, df: DataFrame, *, laid_out: bool = False) -> None:
        """Replace the whole content. ``laid_out`` keeps the partitioning ``df`` comes with."""
        latest = self._latest()
        slot = "slot0" if latest and latest[1]["slot"] == "slot1" else "slot1"
        self._write(df if laid_out else balanced(df, self.date_col)).mode("overwrite").parquet(f"{self.root}/{slot}")
        self._point(latest, slot, df.schema)

    def overwrite_dates(self, df: DataFrame, dates: Iterable | None = None, *, emptied: bool = False, laid_out: bool = False) -> None:
        """Replace the dates present in ``df`` and keep all others; running it again changes nothing.

        ``dates`` are those that ``df`` was made for, or their numbers of rows by date (see
        ``balanced``). With ``emptied``, the ones among them that ``df`` has no row of any
        more are dropped; else they stay as they are.
        """
        if self.date_col is None:
            raise ValueError(f"{self.root} is not partitioned by date")
        dates = dates if dates is None or isinstance(dates, Mapping) else list(dates)
        if self.change_keys:
            self._overwrite_and_tell(df, dates, emptied)
        else:
            self._overwrite(df, dates, emptied, laid_out)

    def _overwrite(self, df: DataFrame, dates: list | Mapping | None, emptied: bool, laid_out: bool) -> None:
        latest = self._latest()
        if latest is None:
            self.replace(df if laid_out else balanced(df, self.date_col, dates), laid_out=True)
            return
        path, schema = self._current()
        writer = self._write(df if laid_out else balanced(df, self.date_col, dates)).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
        if emptied and dates:
            found = {r[0] for r in df.select(self.date_col).distinct().collect()}
            self.drop_dates(d for d in dates if d not in found)
        added = [f for f in df.schema.fields if f.name not in schema.names]
        if added:
            self._point(latest, latest[1]["slot"], StructType(schema.fields + added))

    def _overwrite_and_tell(self, df: DataFrame, dates: list | Mapping | None, emptied: bool) -> None:
        """Stage the new rows and what they change, then put both in their places.

        An overwriting that broke off is finished by the next one, so changes are told
        once, and after the table has them.
        """
        self._finish_change()
        if not self.exists():
            self.replace(df.where("false"))
        rows, changes = f"{self.root}/{_CHANGING}/rows", f"{self.root}/{_CHANGING}/changes"
        self._write(balanced(df, self.date_col, dates)).mode("overwrite").parquet(rows)
        staged = self.spark.read.schema(df.schema).parquet(rows)
        found = [date_of(d) for d in folders_by_date(self.spark, rows, self.date_col)]
        gone = [d for d in dates or () if d not in found] if emptied else []
        before = only_dates(self.read(), self.date_col, [*found, *gone])
        change_feed(before, staged.select(*before.columns), self.change_keys).write.mode("overwrite").parquet(changes)
        marker = {"gone": [d and str(d) for d in gone], "found": [d and str(d) for d in found], "schema": df.schema.jsonValue()}
        files.write_text(self.spark, f"{self.root}/{_CHANGING}/{_COMPLETE}", json.dumps(marker))
        self._finish_change()

    def _finish_change(self) -> None:
        staging = f"{self.root}/{_CHANGING}"
        if files.exists(self.spark, f"{staging}/{_COMPLETE}"):
            marker = json.loads(files.read_text(self.spark, f"{staging}/{_COMPLETE}"))
            dates = {k: [d and dt.date.fromisoformat(d) for d in marker[k]] for k in ("found", "gone")}
            if dates["found"]:
                rows = self.spark.read.schema(StructType.fromJson(marker["schema"])).parquet(f"{staging}/rows")
                self._overwrite(rows, dates["found"], emptied=False, laid_out=False)
            self.drop_dates(dates["gone"])
            if files.has_files(self.spark, f"{staging}/changes"):
                told = [int(n.partition("=")[2]) for n in files.names(self.spark, self.changes()) if n.startswith(f"{CHANGE}=")]
                files.move(self.spark, f"{staging}/changes", f"{self.changes()}/{CHANGE}={max(told, default=0) + 1}")
        files.delete(self.spark, staging)

    def changes(self) -> str:
        """The folder of the changes, one below it for each overwriting."""
        return f"{self.root}/changes"

    def read_changes(self) -> DataFrame:
        """A stream of the changes: ``_change_type``, the columns of the table, and ``_change``, the number of the overwriting."""
        schema = StructType([StructField("_change_type", StringType()), *self._current()[1].fields, StructField(CHANGE, LongType())])
        return self.spark.readStream.schema(schema).parquet(self.changes())

    def dates(self) -> list[dt.date | None]:
        """The dates that have a folder, None last; nothing is read."""
        return sorted(map(date_of, folders_by_date(self.spark, self.path(), self.date_col)), key=lambda d: (d is None, d or dt.date.min))

    def drop_dates(self, dates: Iterable) -> None:
        """Remove the folders of dates; no row is rewritten."""
        path = self.path()
        for d in dates:
            files.delete(self.spark, f"{path}/{folder_of(self.date_col, d)}")

    def _point(self, latest: tuple[int, dict] | None, slot: str, schema: StructType) -> None:
        number = latest[0] + 1 if latest else 1
        files.write_text(self.spark, f"{self.root}/{_POINTER}{number}", json.dumps({"slot": slot, "schema": schema.jsonValue()}))
        if latest:
            files.delete(self.spark, f"{self.root}/{_POINTER}{latest[0]}")

    def _write(self, df: DataFrame):
        return df.write.partitionBy(self.date_col) if self.date_col else df.write


def balanced(df: DataFrame, date_col: str | None, dates: Sized | None = None) -> DataFrame:
    """Even output files: adaptive execution splits a heavy date over tasks and merges light ones.

    Merged to one task, thousands of light dates would be written one after the other. So a
    backfill of many ``dates`` is cut by ranges of dates instead, heavy ones through their
    middle. If ``dates`` tells their rows (``rows_by_date``; proportions will do), that is
    done by these; else Spark samples ``df``, which works all of it out once more.
    """
    if date_col is None:
        return df.hint("rebalance")
    if dates is None or len(dates) <= MANY_DATES:
        return df.hint("rebalance", F.col(date_col))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not isinstance(dates, Mapping):
        return df.repartitionByRange(parts, F.col(date_col), F.monotonically_increasing_id())
    places = df.sparkSession.createDataFrame(_places(dates, parts), "_place_date DATE, _first_part INT, _n_parts INT")
    placed = df.join(F.broadcast(places), F.col(date_col).eqNullSafe(F.col("_place_date")), "left")
    spread = F.pmod(F.monotonically_increasing_id(), F.col("_n_parts")).cast("int")
    placed = placed.withColumn("_part", F.col("_first_part") + spread).repartitionById(parts, "_part")
    return placed.select(*(F.col(f"`{c}`") for c in df.columns))


def rows_by_date(rows: DataFrame, date_col: str) -> dict[dt.date | None, int]:
    """The dates present, in order, with None last for rows without one, and the number of rows of each."""
    counts = rows.groupBy(date_col).count().collect()
    return {d: n for d, n in sorted(counts, key=lambda r: (r[0] is None, r[0] or dt.date.min))}


def _places(weights: Mapping[dt.date | None, int], parts: int) -> list[tuple[dt.date | None, int, int]]:
    """Each date with the first part that it goes to and the number of its parts: one, if it is lighter than a part."""
    share = max(1, -(-sum(weights.values()) // parts))
    places, before = [], 0
    for d, n in weights.items():
        first = min(before // share, parts - 1)
        last = max(first, min((before + n - 1) // share, parts - 1)) if n > share else first
        places.append((d, first, last - first + 1))
        before += n
    return places


def folder_of(date_col: str, date: dt.date | None) -> str:
    """The name of a date's folder; rows without one have a folder too."""
    return f"{date_col}={_UNDATED if date is None else date}"


def date_of(folder: str) -> dt.date | None:
    value = folder.partition("=")[2]
    return None if value == _UNDATED else dt.date.fromisoformat(value)


def folders_by_date(spark: SparkSession, path: str, date_col: str) -> list[str]:
    return [n for n in files.names(spark, path) if n.startswith(f"{date_col}=")]


def create_views(datasets: dict[str, DataFrame]) -> None:
    """Register datasets or reports as temporary views, to be queried by name."""
    for name, df in datasets.items():
        df.createOrReplaceTempView(name)


def only_dates(df: DataFrame, date_col: str, dates: Iterable | None) -> DataFrame:
    """Rows of the given dates, as ranges of literals so the partitions are pruned.

    A None among the dates stands for rows without one; ``dates=None`` means all rows.
    Dates in a row make one range, so a long backfill is a short condition; others are listed.
    """
    if dates is None:
        return df
    days = list(dates)
    ranges: list[list[dt.date]] = []
    for d in sorted(x for x in days if x is not None):
        if ranges and d - ranges[-1][1] <= dt.timedelta(days=1):
            ranges[-1][1] = d
        else:
            ranges.append([d, d])
    col = f"`{date_col}`"
    single = [f"DATE '{a}'" for a, b in ranges if a == b]
    wanted = [f"{col} BETWEEN DATE '{a}' AND DATE '{b}'" for a, b in ranges if a < b]
    if single:
        wanted.append(f"{col} IN ({', '.join(single)})")
    if None in days:
        wanted.append(f"{col} IS NULL")
    # As SQL: the parser balances a long chain of ORs, where columns would nest one in the other.
    return df.where(" OR ".join(wanted) or "false")
