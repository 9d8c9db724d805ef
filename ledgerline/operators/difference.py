"""Where two states of a table differ, by a tree of hashes over key ranges (C4).

Leaves are (partition, range of the key's hash); a leaf holds the number of its rows and the
sum of their hashes, a partition the sums over its leaves. Partitions with equal sums are not
read again; of the others only rows in leaves that differ are compared, key by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Leaves of a partition.
LEAVES = 256


def _leaf(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(LEAVES)).cast("int").alias("_leaf")


def leaves(df: DataFrame, key: str, columns: list[str], partition: str) -> DataFrame:
    """(partition, leaf, rows, digest): two independent hashes of each row, summed exactly."""
    row = [F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)]
    return df.groupBy(partition, _leaf(key)).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(h.cast("decimal(38,0)")).alias(f"digest{i}") for i, h in enumerate(row)])


def differing_leaves(a: DataFrame, b: DataFrame, key: str, columns: list[str], partition: str) -> DataFrame:
    """(partition, leaf) of the leaves that are not equal."""
    sums = ["rows", "digest0", "digest1"]
    left = leaves(a, key, columns, partition).withColumnsRenamed({s: f"a_{s}" for s in sums})
    right = leaves(b, key, columns, partition).withColumnsRenamed({s: f"b_{s}" for s in sums})
    both = left.join(right, [partition, "_leaf"], "full_outer")
    same = [F.col(f"a_{s}").eqNullSafe(F.col(f"b_{s}")) for s in sums]
    return both.where(~(same[0] & same[1] & same[2])).select(partition, "_leaf")


def differences(a: DataFrame, b: DataFrame, key: str, columns: list[str], partition: str) -> DataFrame:
    """(key, before, after) of the rows that are in one state only (the other side null) or
    differ in ``columns``. Equal keys must be unique in each state."""
    found = differing_leaves(a, b, key, columns, partition)
    months = [r[0] for r in found.select(partition).distinct().collect()]  # a row a partition at most
    some = F.col(partition).isin(*months) if months else F.lit(False)

    def rows(df: DataFrame, name: str) -> DataFrame:
        here = df.where(some).select(F.col(key).alias("key"), partition, _leaf(key), F.struct(*columns).alias(name))
        return here.join(found, [partition, "_leaf"], "left_semi").select("key", name)

    return rows(a, "before").join(rows(b, "after"), "key", "full_outer").where(~F.col("before").eqNullSafe(F.col("after")))
