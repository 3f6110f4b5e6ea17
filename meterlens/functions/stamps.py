"""Lineage columns that tell one account and workspace from another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Every dataset is keyed by these three: a workspace id alone may repeat across accounts.
SCOPE = ["_account_identifier", "_workspace_identifier", "workspace_id"]


def stamp_identifiers(
    df: DataFrame, account: str | None = None, workspace: str | None = None, *, workspace_level: bool = True
) -> DataFrame:
    """Add ``_account_identifier`` and, unless account-level, ``_workspace_identifier``.

    Values not passed come from the session settings ``account_identifier`` and
    ``workspace_identifier``.
    """
    conf = df.sparkSession.conf
    stamps = {"_account_identifier": F.lit(account or conf.get("account_identifier", "unknown_account"))}
    if workspace_level:
        stamps["_workspace_identifier"] = F.lit(workspace or conf.get("workspace_identifier", "unknown_workspace"))
    return df.withColumns(stamps)


def add_workspace_identifiers(df: DataFrame) -> DataFrame:
    """Both lineage columns, with the values configured on the session."""
    return stamp_identifiers(df)
