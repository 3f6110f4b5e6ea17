"""Left joins from a large, possibly skewed frame to a lookup frame."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT_BUCKETS = 64
#: A lookup of at most so many rows is broadcast whatever Spark takes its size to be.
FEW_ROWS = 20_000


def broadcast_if_few(lookup: DataFrame) -> DataFrame:
    """``lookup`` with a hint to broadcast it if it has few rows and the session broadcasts at all.

    Spark takes an aggregate to be as large as its input, and shuffles the other side before it
    knows better. The rows are counted in a job of their own, up to one more than the few.
    """
    if lookup.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        return lookup
    return F.broadcast(lookup) if lookup.limit(FEW_ROWS + 1).count() <= FEW_ROWS else lookup


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    *,
    also: Callable[[], Column] | None = None,
    salt_on: Sequence[str] = (),
    buckets: int = SALT_BUCKETS,
) -> DataFrame:
    """Left join on ``on`` (left column to lookup column) plus an optional further condition.

    Spark broadcasts a lookup whose bytes it knows to be below its threshold, and ``left``
    is then not shuffled. Otherwise both are shuffled, and adaptive execution splits a key
    that holds much of ``left``.

    ``salt_on`` splits every key without adaptive execution: each left row goes to one of
    ``buckets`` by a hash of these columns and each lookup row to all of them, so it is for
    lookups that may be copied so often. The salt is a hash, not a random number, so a task
    retried after a lost executor sends its rows to the same place.
    """
    condition = [F.col(a) == F.col(b) for a, b in on.items()]
    if also is not None:
        condition.append(also())
    if not salt_on:
        return left.join(lookup, condition, "left").drop(*on.values())
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(buckets)))
    copies = lookup.withColumn("_salt_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(buckets - 1).cast("bigint"))))
    condition.append(F.col("_salt") == F.col("_salt_copy"))
    return spread.join(copies, condition, "left").drop("_salt", "_salt_copy", *on.values())
