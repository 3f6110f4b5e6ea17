"""Spark results in the plain types of their SQL twins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DateType, DecimalType, IntegerType, MapType, StructField, TimestampType


def _plain(field: StructField, stats: Sequence[str]) -> str:
    name, dtype = f"`{field.name}`", field.dataType
    if field.name in stats:
        return f"round(CAST({name} AS DOUBLE), 6) + 0.0D AS {name}"
    if isinstance(dtype, DecimalType):
        return f"CAST({name} AS DOUBLE) AS {name}"
    if isinstance(dtype, (DateType, TimestampType)):
        return f"CAST({name} AS STRING) AS {name}"
    if isinstance(dtype, IntegerType):
        return f"CAST({name} AS BIGINT) AS {name}"
    if isinstance(dtype, ArrayType):
        return f"array_join(array_sort({name}), ',') AS {name}"
    if isinstance(dtype, MapType):
        return f"array_join(transform(sort_array(map_entries({name})), e -> concat_ws('=', e.key, e.value)), ',') AS {name}"
    return name


def plain(df: DataFrame, stats: Sequence[str] = ()) -> DataFrame:
    return df.selectExpr(*[_plain(f, stats) for f in df.schema.fields])
