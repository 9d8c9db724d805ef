"""Conflict-constrained best-fit packing.

Documents are packed into bins of ``capacity``. A bin takes at most one document of a
source and one of a duplicate cluster; it carries both as bitmaps. Bins are kept in order
of their residual. A document, longest first, goes to the first bin from the successor of
its length upwards whose bitmaps do not meet the document's: the tightest compatible one;
without any it opens a bin. A document longer than a bin fills whole bins, and its rest is
packed like the others.

Documents are dealt to shards by a hash of id, text, source and, of rows equal in all of
them, the number of the copy (a few copies at a time), so every source and cluster is
spread evenly over the shards and a shard stays at about SHARD documents however many
there are. Bins do not cross shards. Only ids, lengths, sources and cluster ids travel.

Defined results: a null or empty text has length 0 and still gets a place; a null source
is a source of its own; equal texts are one cluster, or the documents of one component where the
caller names its column; rows that repeat an id are packed
row by row; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: UTF-8 bytes in a bin, documents in a shard.
CAPACITY = 16_384
SHARD = 4096
#: Copies of equal rows that go to one shard together: this part of a shard.
TOGETHER = 64
#: Bins looked at together in the successor search.
SCAN = 512

SCHEMA = "doc_id long, piece int, start long, length long, shard int, bin int, offset long"


class Bins:
    """Bins in order of residual, with bitmaps of the sources and clusters they hold."""

    def __init__(self, capacity: int, n_sources: int, n_clusters: int, most: int):
        self.capacity = capacity
        self.residual = np.zeros(most, np.int64)
        self.order = np.zeros(most, np.int32)  # bins by residual
        self.sources = np.zeros((n_sources // 64 + 1, most), np.uint64)
        self.clusters = np.zeros((n_clusters // 64 + 1, most), np.uint64)
        self.n = 0

    def place(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, offset) of a document; cluster -1 has no duplicates."""
        held = self.residual[self.order[: self.n]]
        at = int(np.searchsorted(held, length))
        chosen = -1
        while at < self.n:  # successor search
            part = self.order[at : min(at + SCAN, self.n)]
            clash = self.sources[source // 64, part] >> np.uint64(source % 64) & np.uint64(1)
            if cluster >= 0:
                clash |= self.clusters[cluster // 64, part] >> np.uint64(cluster % 64) & np.uint64(1)
            free = np.flatnonzero(clash == 0)
            if len(free):
                at += int(free[0])
                chosen = int(part[free[0]])
                break
            at += len(part)
        if chosen < 0:
            chosen, at = self.n, self.n
            self.residual[chosen] = self.capacity
            self.n += 1
        offset = self.capacity - int(self.residual[chosen])
        self.residual[chosen] -= length
        self.sources[source // 64, chosen] |= np.uint64(1 << source % 64)
        if cluster >= 0:
            self.clusters[cluster // 64, chosen] |= np.uint64(1 << cluster % 64)
        to = int(np.searchsorted(held[:at], self.residual[chosen]))
        self.order[to + 1 : at + 1] = self.order[to:at].copy()
        self.order[to] = chosen
        return chosen, offset


def pack_shard(items: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Bins of one shard. Items: doc_id, length, source, cluster, _key, copies."""
    items = items.loc[items.index.repeat(items["copies"])].reset_index(drop=True)
    items = items.sort_values(["length", "doc_id", "_key"], ascending=[False, True, True], kind="stable")
    source = pd.factorize(items["source"], use_na_sentinel=False)[0]
    again = items["cluster"].duplicated(keep=False).to_numpy()
    cluster = np.full(len(items), -1)
    cluster[again] = pd.factorize(items["cluster"][again])[0]
    full = (np.maximum(items["length"].to_numpy() - 1, 0) // capacity).astype(np.int64)
    rest = items["length"].to_numpy() - full * capacity
    bins = Bins(capacity, source.max(initial=0) + 1, cluster.max(initial=0) + 1, len(items))
    out, shard, ids = [], int(items["shard"].iloc[0]), items["doc_id"].astype(object).where(items["doc_id"].notna(), None)
    whole = 0  # whole bins are numbered from -1 downwards until the others are counted
    ids = ids.tolist()
    for i in np.argsort(-rest, kind="stable").tolist():
        for piece in range(full[i]):
            whole -= 1
            out.append((ids[i], piece, piece * capacity, capacity, shard, whole, 0))
        where, offset = bins.place(int(rest[i]), int(source[i]), int(cluster[i]))
        out.append((ids[i], int(full[i]), int(full[i]) * capacity, int(rest[i]), shard, where, offset))
    packed = pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])
    packed["doc_id"] = packed["doc_id"].astype("Int64")
    packed["bin"] = packed["bin"].where(packed["bin"] >= 0, bins.n - 1 - packed["bin"])
    return packed


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    capacity: int = CAPACITY,
    shard_size: int = SHARD,
    cluster_col: str | None = None,
) -> DataFrame:
    """One row for each piece of a document: doc_id, piece, start, length, shard, bin, offset.
    ``cluster_col`` names the near-duplicate component (``root`` of simhash.near_duplicates)."""
    data = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    digest = F.xxhash64(data)
    shards = max(1, math.ceil(docs.count() / shard_size))
    together = max(1, shard_size // TOGETHER)
    equal = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.octet_length(data).cast("long").alias("length"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        (F.when(F.col(f"`{cluster_col}`").isNull(), digest).otherwise(F.xxhash64(F.lit(3), F.col(f"`{cluster_col}`"))) if cluster_col else digest).alias("cluster"),
        digest.alias("_key"),
    )
    columns = equal.columns
    counted = equal.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    parts = counted.select(*columns, "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(together))).alias("first"))
    items = parts.select(
        *columns,
        F.least(F.lit(together), F.col("n") - F.col("first")).cast("int").alias("copies"),
        F.pmod(F.xxhash64(F.lit(7), "doc_id", "_key", "source", "first"), F.lit(shards)).cast("int").alias("shard"),
    )

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return pack_shard(group, capacity)

    return items.groupBy("shard").applyInPandas(run, SCHEMA)
