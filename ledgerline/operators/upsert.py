"""Key-match logic of the upsert (B4, B5, J5) as a pure DataFrame plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_plan(
    target: DataFrame, source: DataFrame, pk: str, partition: str | None = None, touched: list | None = None
) -> tuple[DataFrame, Column]:
    """Rows of the new state of the partitions ``source`` touches, with an ``_origin`` column.

    ``_origin`` is ``kept`` (target row, key absent from source), ``updated`` (source
    row whose key existed) or ``inserted``. With a ``partition`` column the target is
    first restricted to the source's partitions: by a static ``IN`` filter when the
    caller passes the ``touched`` values (guaranteed partition pruning of the scan),
    otherwise by a semi join on the column.
    """
    if partition is not None and touched is not None:
        target = target.where(F.col(partition).isin(*touched))
    elif partition is not None:
        target = target.join(source.select(partition).distinct(), partition, "left_semi")
    target_keys = target.select(pk).withColumn("_hit", F.lit(True))
    marked = source.join(target_keys, pk, "left").select(
        *source.columns, F.when(F.col("_hit"), F.lit("updated")).otherwise(F.lit("inserted")).alias("_origin")
    )
    kept = target.join(source.select(pk), pk, "left_anti").select(*source.columns, F.lit("kept").alias("_origin"))
    merged = kept.unionByName(marked)
    return merged, F.col("_origin")


def upsert_state(target: DataFrame, source: DataFrame, pk: str) -> DataFrame:
    """B4 as a value: the table content after merging ``source`` into ``target``."""
    merged, _ = merge_plan(target, source.select(*target.columns), pk)
    return merged.drop("_origin")


def upsert_counts(target: DataFrame, source: DataFrame, pk: str) -> DataFrame:
    """One row (inserted, updated) from a left join of source keys to target keys."""
    hits = source.select(pk).join(target.select(pk).withColumn("_hit", F.lit(1)), pk, "left")
    return hits.agg(
        F.count(F.when(F.col("_hit").isNull(), 1)).alias("inserted"),
        F.count(F.col("_hit")).alias("updated"),
    )


def match_sides(target: DataFrame, source: DataFrame, pk: str) -> DataFrame:
    """Every key with the side(s) it appears on: matched, source_only, target_only."""
    t = target.select(pk).withColumn("_t", F.lit(True))
    s = source.select(pk).withColumn("_s", F.lit(True))
    j = t.join(s, pk, "full_outer")
    side = (
        F.when(F.col("_t") & F.col("_s"), F.lit("matched"))
        .when(F.col("_s"), F.lit("source_only"))
        .otherwise(F.lit("target_only"))
    )
    return j.select(pk, side.alias("side"))
