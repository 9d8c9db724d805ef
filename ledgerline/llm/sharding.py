"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

A topology is a tree of regions, racks and shards; a node weighs what its shards weigh.
A document descends it: at each level every child of the node reached so far draws
``-ln(u) / weight`` with ``u`` from a hash of the document's id and the child's name, and
the least draw wins. A draw depends on nothing but id, name and weight, so a weight that
changes moves documents into or out of the subtrees on its path only; between other
subtrees nothing moves.

A new shard opens a region of its own (``layout``): then its region's draw is the only
one that is new, and one more shard takes documents only into itself. A shard put into an
old rack would also raise that rack and region, whose new documents descend afresh and
may reach old shards there (``place`` allows it: movement stays inside the raised region).

A shard's documents are numbered without gaps: by one of ``BUCKETS`` hash buckets, then
id, size and checksum. Rows equal in these three are counted first and numbered as one
run, so neither a hot id nor a hot text meets in one task; a running sum is taken inside
(shard, bucket) and one over a shard's buckets.

Defined results: a null text is empty (size 1, checksum 0); a null id is hashed as an
empty id; documents of one id share a shard; equal rows take consecutive slots; an empty
table gives no rows; other columns, whatever their names, are ignored. A weight of 0 or
less draws nothing; a topology without a positive weight is an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import payload, written

#: Racks of a region and shards of a rack when a fleet is founded.
RACKS, SHARDS = 2, 2
#: Hash buckets of a shard, for numbering; copies of equal rows that are numbered by one task.
BUCKETS = 4096
COPIES = 1024
#: Documents go by id and shard count alone.
LAW = "key"


class Shard(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def layout(founded: int, opened: int = 0) -> list[Shard]:
    """The topology of ``founded`` equal shards, filled into racks and regions, and of ``opened``
    later ones, each a region of its own."""
    regions = -(-founded // (RACKS * SHARDS))
    first = [Shard(s // (RACKS * SHARDS), s // SHARDS % RACKS, s) for s in range(founded)]
    return first + [Shard(regions + i, 0, founded + i) for i in range(opened)]


def uniform(key: Column, name: Column) -> Column:
    """A draw in (0, 1) from the first 52 bits of a hash."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit("|"), name)), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def tree(topology: Sequence[Shard]) -> tuple[Column, Column]:
    """Racks by region and shards by rack as array literals: (children of the root and of
    every region, children of every rack); a child is (name, weight, number)."""
    live = [s for s in topology if s.weight > 0]
    if not live:
        raise ValueError("no shard has a positive weight")
    if len({s.shard for s in live}) < len(live):
        raise ValueError("a shard stands in the topology twice")
    racks = sorted({(s.region, s.rack) for s in live})
    regions = sorted({r for r, _ in racks})

    def child(name: str, weight: float, number: int) -> Column:
        return F.struct(F.lit(name).alias("name"), F.lit(float(weight)).alias("weight"), F.lit(number).alias("number"))

    def weight(region: int, rack: int | None = None) -> float:
        return sum(s.weight for s in live if s.region == region and rack in (None, s.rack))

    top = [F.array(*[child(f"region {r}", weight(r), i + 1) for i, r in enumerate(regions)])]
    below = [F.array(*[child(f"rack {r}/{k}", weight(r, k), i) for i, (r, k) in enumerate(racks) if r == of]) for of in regions]
    leaves = [F.array(*[child(f"shard {s.shard}", s.weight, s.shard) for s in live if (s.region, s.rack) == of]) for of in racks]
    return F.array(*top, *below), F.array(*leaves)


def drawn(key: Column, children: Column) -> Column:
    """The number of the child with the least draw."""
    draws = F.transform(
        children, lambda c: F.struct((-F.ln(uniform(key, c["name"])) / c["weight"]).alias("draw"), c["number"].alias("number"))
    )
    return F.array_min(draws)["number"]


def place(key: Column, topology: Sequence[Shard]) -> Column:
    """The shard of a key (a string column) in a topology."""
    upper, leaves = tree(topology)
    region = drawn(key, F.element_at(upper, 1))
    rack = drawn(key, F.element_at(upper, region + 1))
    return drawn(key, F.element_at(leaves, rack + 1)).cast("int")


def key_of(id_col: str) -> Column:
    return F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))


def movement(docs: DataFrame, before: Sequence[Shard], after: Sequence[Shard], id_col: str = "doc_id") -> DataFrame:
    """(from_shard, to_shard, documents) between two topologies, stays included."""
    key = key_of(id_col)
    moves = docs.select(place(key, before).alias("from_shard"), place(key, after).alias("to_shard"))
    return moves.groupBy("from_shard", "to_shard").agg(F.count(F.lit(1)).alias("documents"))


def numbered(runs: DataFrame, within: str, by: Sequence[str]) -> DataFrame:
    """``runs`` (with a count ``n``) and the first slot of each run in its group ``within``:
    groups are cut into ``bucket``s, so no task holds a whole group."""
    order = [F.col(c).asc_nulls_first() for c in by]
    inside = Window.partitionBy(within, "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = runs.groupBy(within, "bucket").agg(F.sum("n").alias("total"))
    over = Window.partitionBy(within).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(within, "bucket", F.coalesce(F.sum("total").over(over), F.lit(0)).alias("offset"))
    counted = runs.withColumn("ahead", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return counted.join(offsets, [within, "bucket"]).withColumn("first", F.col("offset") + F.col("ahead")).drop("offset", "ahead")


def spread(runs: DataFrame) -> DataFrame:
    """One row for each of a run's ``n`` copies, with its ``slot``; the copies of a long run go to many tasks."""
    parts = runs.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))).alias("part"))
    dealt = parts.repartition(*[c for c in runs.columns if c not in ("n", "first", "bucket")], "part")
    copies = F.sequence(F.lit(0).cast("long"), F.least(F.lit(COPIES).cast("long"), F.col("n") - F.col("part")) - 1)
    return dealt.select("*", F.explode(copies).alias("copy")).withColumn("slot", F.col("first") + F.col("part") + F.col("copy"))


def assign(
    docs: DataFrame,
    topology: Sequence[Shard],
    grown: Sequence[Shard] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (the shard in ``grown``; null without)."""
    text = payload(f"`{text_col}`")
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
    )
    runs = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    key = key_of("doc_id")
    bucket = F.conv(F.substring(F.md5(F.concat_ws("|", key, "size", "text_crc32")), 1, 3), 16, 10).cast("int")
    placed = runs.select(
        "*",
        place(key, topology).alias("shard"),
        (place(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        (bucket % BUCKETS).alias("bucket"),
    )
    slots = numbered(written(placed, "sharding"), "shard", ["doc_id", "size", "text_crc32"])
    return spread(slots).select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", "grown_shard")
