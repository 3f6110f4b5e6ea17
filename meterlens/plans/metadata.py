"""Snapshots of small account-level feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame

from meterlens.functions import stamp_identifiers


def list_prices(feed: DataFrame, account: str | None = None) -> DataFrame:
    return stamp_identifiers(feed, account, workspace_level=False)


def workspace_info(feed: DataFrame, account: str | None = None) -> DataFrame:
    return stamp_identifiers(feed, account, workspace_level=False)
