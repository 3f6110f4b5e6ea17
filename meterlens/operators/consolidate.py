"""Same-shaped datasets of several providers as one."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def consolidate(datasets: Mapping[str, DataFrame], *, allow_missing: bool = False) -> DataFrame:
    """Union of the datasets with a leading ``source`` column naming where a row came from.

    Columns are matched by name. With ``allow_missing`` a provider on an older schema
    gets NULL in the columns it lacks.
    """
    if not datasets:
        raise ValueError("consolidate needs at least one dataset")
    labelled = [df.select(F.lit(source).alias("source"), "*") for source, df in datasets.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), labelled)
