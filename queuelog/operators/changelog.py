"""Changelogs: the current state per key, and a changelog of state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelog.model import DELETE, UPDATE_BEFORE


def last_changes(changes: DataFrame, primary_key: list[str], ordering: list[str], kind: str = "row_kind") -> DataFrame:
    """The last change per key. Works on a stream in update mode.

    Update-before rows are left out: they share their position with the update-after row.
    Tasks aggregate before the shuffle, so a hot key sends one row per task.
    """
    rows = changes.where(F.col(kind) != UPDATE_BEFORE)
    last = F.max_by(F.struct(*changes.columns), F.struct(*ordering))
    return rows.groupBy(*[F.col(k).alias(f"_key_{k}") for k in primary_key]).agg(last.alias("_last")).select("_last.*")


def upsert_materialize(
    changes: DataFrame, primary_key: list[str], ordering: list[str], kind: str = "row_kind"
) -> DataFrame:
    """The table a changelog describes: last row per key, deleted keys left out."""
    if not primary_key:
        raise ValueError("upsert_materialize needs a primary key")
    return last_changes(changes, primary_key, ordering, kind).where(F.col(kind) != DELETE).drop(kind)
