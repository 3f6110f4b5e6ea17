"""Written intermediates in the shared folder, and row keys."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.sources.scratch import new_folder

_SHIPPED: set[str] = set()
#: Rows of texts and arrays are large: batches are bounded by bytes, and row groups of written intermediates are small.
_BATCH, BATCH_BYTES, ROW_GROUP_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20, 16 << 20


def ship(spark: SparkSession) -> None:
    """Send this library to the executors, once in an application, so that their Python finds it.

    Sets the session's bound on the bytes of an Arrow batch too, unless it has one.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    archive = f"{tempfile.mkdtemp()}/{top.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table, so that later jobs neither compute it again nor lose it with an executor."""
    path = new_folder(df.sparkSession, name)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it one that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_key(id_column: str, text_column: str) -> Column:
    """A 64-bit key of a row's id and text, defined for nulls too; only equal rows share it."""
    return F.xxhash64(F.col(id_column).cast("string"), F.col(text_column))


def shards(df: DataFrame, column: str, target_bytes: int, least: int = 64) -> int:
    """How many shards give each about ``target_bytes`` of a text column."""
    total = df.agg(F.sum(F.octet_length(column).cast("long"))).head()[0] or 0
    return max(least, -(-total // target_bytes))
