"""Ordered-neighbour helpers that stay balanced when one key holds a large share of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lead_by_key(
    df: DataFrame,
    key: str,
    order: list[str],
    value: str | Column,
    out: str,
    bucket: Column,
) -> DataFrame:
    """``lead(value) OVER (PARTITION BY key ORDER BY order...)`` without one task per key.

    A plain window sends every row of a key to one task; a key holding a third of the
    table would sit in a single task. Here ``bucket`` is a coarse expression that never
    decreases along ``order`` (for a date-ordered lead: the day). The lead is taken
    inside each (key, bucket) group, so a hot key is spread over as many tasks as it has
    buckets. The last row of a group takes the first row of the key's next non-empty
    bucket, found on a table with one row per (key, bucket): built by a partial
    aggregate (skew-safe) and ordered per key over its buckets only.

    Everything is a pure function of the rows (no sampled boundaries), so any number of
    re-executions, or re-computations after a lost executor, give the same result.
    """
    value_col = F.col(value) if isinstance(value, str) else value
    rows = df.withColumn("_ll_b", bucket).withColumn("_ll_val", value_col)
    run = Window.partitionBy(key, "_ll_b").orderBy(*order)
    local = rows.withColumn(out, F.lead("_ll_val").over(run)).withColumn(
        "_ll_last", F.lead(F.lit(True)).over(run).isNull()
    )
    if isinstance(value, str) and value == order[0]:
        # the led value is the leading order column: a group's first value is its minimum
        # (a hash aggregate on one column instead of a sort aggregate over a struct)
        firsts = rows.groupBy(key, "_ll_b").agg(F.min("_ll_val").alias("_ll_fv"))
    else:
        firsts = rows.groupBy(key, "_ll_b").agg(
            F.min(F.struct(*[F.col(c) for c in order], F.col("_ll_val").alias("v"))).alias("_ll_f")
        ).select(key, "_ll_b", F.col("_ll_f.v").alias("_ll_fv"))
    following = firsts.select(
        F.col(key),
        F.col("_ll_b"),
        F.lead(F.col("_ll_fv")).over(Window.partitionBy(key).orderBy("_ll_b")).alias("_ll_nv"),
    )
    stitched = local.join(following, [key, "_ll_b"], "left")
    return stitched.withColumn(out, F.when(F.col("_ll_last"), F.col("_ll_nv")).otherwise(F.col(out))).drop(
        "_ll_b", "_ll_val", "_ll_last", "_ll_nv"
    )


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return False
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return True


def first_by_key(df: DataFrame, key: str | list[str], rank: list[Column | str], payload: list[str] | None = None,
                 count_as: str | None = None) -> DataFrame:
    """Keep one row per key: the one with the smallest ``rank`` tuple.

    Expressed as ``groupBy(key).agg(min_by(row, rank))``: an aggregate with a map-side
    partial step, so a hot key is reduced inside each map task before the shuffle
    instead of being sorted in one task as ``row_number()`` would. Every orderable
    payload column is appended to the rank, so ties resolve the same way on every run.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = payload or [c for c in df.columns if c not in keys]
    types = {f.name: f.dataType for f in df.schema.fields}
    rank_cols = [F.col(r) if isinstance(r, str) else r for r in rank]
    tie = [F.col(c) for c in cols if _orderable(types[c])]
    order = F.struct(*[r.alias(f"_r{i}") for i, r in enumerate(rank_cols + tie)])
    packed = F.struct(*[F.col(c) for c in cols])
    counted = [F.count(F.lit(1)).alias(count_as)] if count_as else []
    return df.groupBy(*keys).agg(F.min_by(packed, order).alias("_fk"), *counted).select(
        *keys, *[F.col(f"_fk.{c}").alias(c) for c in cols], *([count_as] if count_as else [])
    )
