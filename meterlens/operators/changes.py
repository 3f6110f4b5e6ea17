"""Row-level differences between two snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType

from meterlens.operators.current_state import latest_by


def _ordered(col: Column, dtype: DataType) -> Column:
    """``col`` with each map at any depth as its entries sorted by key."""
    if "map<" not in dtype.simpleString():
        return col
    if isinstance(dtype, MapType):
        entry = lambda e: F.struct(_ordered(e["key"], dtype.keyType).alias("key"), _ordered(e["value"], dtype.valueType).alias("value"))
        return F.array_sort(F.transform(F.map_entries(col), entry))
    if isinstance(dtype, ArrayType):
        return F.transform(col, lambda x: _ordered(x, dtype.elementType))
    return F.when(col.isNotNull(), F.struct(*[_ordered(col[f.name], f.dataType).alias(f.name) for f in dtype.fields]))


def _comparable(name: str, dtype: DataType) -> Column:
    """Maps have no equality and no order, so what holds one is compared through its sorted entries as text."""
    return F.to_json(F.struct(_ordered(F.col(name), dtype).alias("v"))) if "map<" in dtype.simpleString() else F.col(name)


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows inserted, deleted or updated from ``old`` to ``new``, labelled in ``_change_type``.

    An update gives two rows, ``update_preimage`` and ``update_postimage``. ``keys``
    must identify a row in each snapshot; NULL keys match NULL keys. One full outer
    join on the keys; unchanged rows are dropped in it.
    """
    columns = new.columns
    values = [f for f in new.schema.fields if f.name not in keys]
    before = old.select(F.struct(*columns).alias("_before"), *[F.col(k).alias(f"_b{i}") for i, k in enumerate(keys)])
    after = new.select(F.struct(*columns).alias("_after"), *[F.col(k).alias(f"_a{i}") for i, k in enumerate(keys)])
    same_key = [F.col(f"_b{i}").eqNullSafe(F.col(f"_a{i}")) for i in range(len(keys))]
    pairs = before.join(after, same_key, "full_outer")

    same = F.lit(True)
    for f in values:
        same = same & _comparable(f"_before.{f.name}", f.dataType).eqNullSafe(_comparable(f"_after.{f.name}", f.dataType))
    change = lambda kind, row: F.struct(F.lit(kind).alias("_change_type"), F.col(row).alias("_row"))
    changes = (
        F.when(F.col("_before").isNull(), F.array(change("insert", "_after")))
        .when(F.col("_after").isNull(), F.array(change("delete", "_before")))
        .when(~same, F.array(change("update_preimage", "_before"), change("update_postimage", "_after")))
    )
    return pairs.select(F.explode(changes).alias("_change")).select("_change._change_type", "_change._row.*")


def replayed(changes: DataFrame, keys: Sequence[str], order_col: str = "_change") -> DataFrame:
    """The rows that changes lead to: for each key the last one told, without those that were deleted."""
    told = changes.where("_change_type <> 'update_preimage'")
    return latest_by(told, keys, order_col).where("_change_type <> 'delete'").drop("_change_type", order_col)
