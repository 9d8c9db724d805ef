"""Key joins of the sync and seed paths."""

from __future__ import annotations

from pyspark.sql import DataFrame


def restrict_to_known(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` appears in ``known`` (LEFT SEMI: no duplication, no columns added).

    Spark picks the strategy: with AQE a small ``known`` side becomes a broadcast at
    run time (bounded by ``spark.sql.autoBroadcastJoinThreshold``), otherwise both
    sides shuffle on the key.
    """
    return rows.join(known.select(key), key, "left_semi")


def new_only(rows: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` does not exist yet (LEFT ANTI)."""
    return rows.join(existing.select(key), key, "left_anti")


def lookup_dimension(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Equi-join to a dimension. The planner broadcasts it by its checked size or not at all."""
    return rows.join(dim, key, "left")
