"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most ``distance`` bits apart share a variant at most half as many bits
from each. So every distinct fingerprint emits all variants within half the radius (2,081
for 64 bits and radius 4), variants are shuffled, and fingerprints that emit one variant
are linked; by the triangle inequality all of them are within the radius of each other.

The variants are many, so they travel packed. A block is a few thousand distinct
fingerprints (by hash). It emits its variants as sorted hashes (of HASH_BITS bits, or more
where the variants are so many that most hashes would be taken), cut into ranges and stored
as compressed gaps, about 2.7 bytes a variant. Where a block has less than PIECE variants a
range it cuts them into wider ranges, and a second shuffle brings these of SUPER blocks
together, which are then cut into ranges with the block of each variant (about 1.5 bytes
more): so rows grow with the variants, not with blocks times ranges. The task of a range
finds the hashes that occur twice or more and names them to their blocks. These emit the
variants again, exactly, for the named hashes only: inside a block equal variants become
links at once, and one owner of each variant is compared between blocks, packed again.
Links are stars around the least fingerprint of a variant, never all pairs; each is
verified by its bit distance, and what closes a circle is left out. Components follow by
large-star and small-star steps.

Defined results: null text = empty text = no words = fingerprint zero, linked like any
other; equal texts share a fingerprint; rows that repeat an id count as documents of that
id; a null id is never a component's id unless it is alone in it; other input columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_batches, payload, written
from ledgerline.llm.components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Distinct fingerprints in a block, and least bits of a variant's hash.
BLOCK = 8192
HASH_BITS = 44
#: Bits by which hashes outnumber variants at least, as far as 64 bits go.
SPARE_BITS = 7
#: Most partitions that blocks are dealt to.
MOST_TASKS = 10_000
#: Variants in a range, about.
RANGE = 1 << 21
#: Variants that a block sends to a range at least, about; and blocks that are brought together
#: where ranges are too many for that.
PIECE = 512
SUPER = 1024
#: Fingerprints whose variants are compared at a time when a block emits them again.
SLICE = 512


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash: bit i is set if it is set in over half of the shingles' XXH64."""
    import xxhash

    words = text.lower().split()  # ASCII letters; blank and U+0009 to U+000D, as bytes do it
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 8192):
        octets = hashes[part : part + 8192].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = ones * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, _key, fp): fp as signed long, _key a hash of the text."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), payload(text_col))

    def batch(rows: pa.RecordBatch) -> dict[str, list]:
        found = [fingerprint(t, shingle) for t in rows.column("_bytes").to_pylist()]
        signed = np.array(found, np.uint64).view(np.int64)
        return {"doc_id": rows.column("doc_id"), "_key": rows.column("_key"), "fp": signed}

    return map_batches(source.withColumn("_key", F.xxhash64("_bytes")), batch, "doc_id long, _key long, fp long")


def ball(radius: int) -> np.ndarray:
    """Masks of at most ``radius`` bits."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    return np.array(masks, np.uint64)


def hashed(variants: np.ndarray, bits: int) -> np.ndarray:
    """Hashes of ``bits`` bits, in place."""
    variants *= np.uint64(0x9E3779B97F4A7C15)
    variants >>= np.uint64(64 - bits)
    return variants


def bits_of(fingerprints: int, masks: int) -> tuple[int, int, int]:
    """Bits of a variant's hash, of its range, and of the ranges that a block cuts."""
    variants = max(1, fingerprints * masks)
    ranges = max(0, math.ceil(math.log2(variants / RANGE)))
    coarse = max(0, math.floor(math.log2(max(1, min(fingerprints, BLOCK) * masks / PIECE))))
    return min(64, max(HASH_BITS, math.ceil(math.log2(variants)) + SPARE_BITS)), ranges, min(ranges, coarse)


def pieces(values: np.ndarray, bits: int, ranges: int) -> Iterator[tuple[int, slice]]:
    """Sorted hashes of ``bits`` bits cut by their leading ``ranges`` bits: (range, where)."""
    if len(values):
        range_of = values >> np.uint64(bits - ranges) if ranges else np.zeros(len(values), np.uint64)
        begin = np.flatnonzero(np.diff(range_of, prepend=~range_of[0]))
        for a, b in zip(begin, np.append(begin[1:], len(values)), strict=True):
            yield int(range_of[a]), slice(a, b)


def pack(values: np.ndarray) -> bytes:
    """Sorted values as compressed gaps, one plane for each byte of a gap."""
    import zstandard

    gaps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(data[0], -1)
    gaps = np.zeros((planes.shape[1], 8), np.uint8)
    gaps[:, : data[0]] = planes.T
    return np.cumsum(gaps.view("<u8").ravel())


def forest(variant: np.ndarray, fp: np.ndarray, distance: int) -> np.ndarray:
    """Edges that connect fingerprints with equal variants: stars around the least one of a
    variant, verified by bit distance, without edges that close a circle. Shape (n, 2)."""
    by = np.lexsort((fp, variant))
    variant, fp = variant[by], fp[by]
    first = np.ones(len(fp), bool)
    first[1:] = variant[1:] != variant[:-1]
    least = fp[np.maximum.accumulate(np.where(first, np.arange(len(fp)), 0))]
    near = ~first & (least != fp) & (np.bitwise_count(least ^ fp) <= distance)
    ids, ends = np.unique(np.stack((least[near], fp[near])), return_inverse=True)
    a, b = np.unique(ends.reshape(2, -1), axis=1)
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    joined = label != np.arange(len(ids))
    return np.stack((ids[label[joined]], ids[joined]), axis=1)


def near_links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (a, b) among distinct fingerprints (column fp) that connect all pairs within
    ``distance`` bits, and no others."""
    import zstandard

    spark = distinct.sparkSession
    masks = ball((distance + 1) // 2)
    n = distinct.count()
    blocks = max(1, math.ceil(n / BLOCK))
    bits, range_bits, coarse_bits = bits_of(n, len(masks))
    slot_shift = np.uint64(bits - max(0, range_bits - 2))
    # Few bytes but much work: a partition for each block, up to a point.
    tasks = min(blocks, MOST_TASKS)
    block = F.pmod(F.xxhash64("fp"), F.lit(blocks)).cast("int").alias("block")
    by_block = distinct.select("fp", block).repartition(tasks, "block")
    mask_values = spark.sparkContext.broadcast(masks)

    def emit(group: pd.DataFrame) -> pd.DataFrame:
        fps = group["fp"].to_numpy().view(np.uint64)
        values = hashed(np.bitwise_xor.outer(fps, mask_values.value).ravel(), bits)
        values.sort()
        block = int(group["block"].iloc[0])
        rows = [(r, block, pack(values[here]), None) for r, here in pieces(values, bits, coarse_bits)]
        return pd.DataFrame(rows, columns=["range", "block", "data", "owners"])

    def gathered(group: pd.DataFrame) -> pd.DataFrame:
        """Wide ranges of SUPER blocks at most, cut into ranges with the block of each variant."""
        parts = [unpack(d) for d in group["data"]]
        owner = np.repeat((group["block"] % SUPER).to_numpy(np.uint16), [len(p) for p in parts])
        values = np.concatenate(parts)
        by = np.argsort(values, kind="stable")
        values, owner = values[by], owner[by]
        first = int(group["block"].iloc[0]) // SUPER * SUPER
        compress = zstandard.ZstdCompressor(level=1).compress
        rows = [
            (r, first, pack(values[here]), compress(owner[here].astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes()))
            for r, here in pieces(values, bits, range_bits)
        ]
        return pd.DataFrame(rows, columns=["range", "block", "data", "owners"])

    def blocks_of(first: int, owners: bytes | None, here: np.ndarray) -> np.ndarray:
        if owners is None:
            return np.full(np.count_nonzero(here), first, np.int32)
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(owners), np.uint8).reshape(2, -1)
        return first + np.ascontiguousarray(planes.T).view("<u2").ravel()[here].astype(np.int32)

    def repeated(group: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(d) for d in group["data"]]
        values = np.concatenate(parts)
        values.sort()
        twice = np.unique(values[1:][values[1:] == values[:-1]])
        del values
        found = []
        for part, first, owners in zip(parts, group["block"], group["owners"], strict=True):
            at = np.searchsorted(twice, part)
            here = at < len(twice)
            here[here] = twice[at[here]] == part[here]
            found.append((part[here], blocks_of(first, owners, here)))
        value, owner = (np.concatenate(x) for x in zip(*found, strict=True))
        by = np.lexsort((value, owner))
        value, owner = value[by], owner[by]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        value, owner = value[new], owner[new]  # one a block
        ordered = np.sort(value)
        across = np.isin(value, ordered[1:][ordered[1:] == ordered[:-1]])
        ends = np.append(np.flatnonzero(np.diff(owner)) + 1, len(owner))
        named, start = [], 0
        for end in ends[ends > 0]:
            here, kind = value[start:end], across[start:end]
            named += [(int(owner[start]), k, pack(x)) for k, x in enumerate((here[~kind], here[kind])) if len(x)]
            start = end
        return pd.DataFrame(named, columns=["block", "kind", "data"])

    def emit_again(fps: pd.DataFrame, named: pd.DataFrame) -> pd.DataFrame:
        """Links inside the block, and packed variants to compare between blocks."""
        out = []
        if len(fps) and len(named):
            lists = [[unpack(d) for d in named["data"][named["kind"] == k]] for k in (0, 1)]
            between = np.sort(np.concatenate([*lists[1], np.zeros(0, np.uint64)]))
            wanted = np.sort(np.concatenate([*lists[0], between]))
            own = fps["fp"].to_numpy().view(np.uint64)
            variants, owners, places = [], [], []
            for start in range(0, len(own), SLICE):
                part = own[start : start + SLICE]
                made = np.bitwise_xor.outer(part, mask_values.value).ravel()
                found = hashed(made.copy(), bits)
                at = np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)
                hit = np.flatnonzero(wanted[at] == found)
                variants.append(made[hit])
                owners.append(part[hit // len(mask_values.value)])
                places.append(found[hit])
            variant, owner, place = (np.concatenate(x) for x in (variants, owners, places))
            out += [(-1, a, b, None) for a, b in forest(variant, owner, distance).view(np.int64).tolist()]
            order = np.lexsort((owner, variant))  # one owner of a variant speaks for the block
            head = order[np.concatenate(([True], variant[order][1:] != variant[order][:-1]))]
            if len(between):
                at = np.minimum(np.searchsorted(between, place[head]), len(between) - 1)
                head = head[between[at] == place[head]]
                slot = (place[head] >> slot_shift).astype(np.int64)
                for s in np.unique(slot):
                    chosen = head[slot == s]
                    data = np.stack((variant[chosen], owner[chosen])).tobytes()
                    out.append((int(s), 0, 0, zstandard.ZstdCompressor(level=1).compress(data)))
        return pd.DataFrame(out, columns=["slot", "a", "b", "data"])

    def between_blocks(group: pd.DataFrame) -> pd.DataFrame:
        decode = zstandard.ZstdDecompressor().decompress
        parts = [np.frombuffer(decode(d), np.uint64).reshape(2, -1) for d in group["data"]]
        variant, owner = np.concatenate(parts, axis=1)
        return pd.DataFrame(forest(variant, owner, distance).view(np.int64), columns=["a", "b"])

    piece = "range int, block int, data binary, owners binary"
    packed = by_block.groupBy("block").applyInPandas(emit, piece)
    if coarse_bits < range_bits:
        packed = packed.groupBy("range", F.floor(F.col("block") / SUPER)).applyInPandas(gathered, piece)
    named = packed.groupBy("range").applyInPandas(repeated, "block int, kind int, data binary")
    named = named.repartition(tasks, "block")
    again = written(
        by_block.groupBy("block")
        .cogroup(named.groupBy("block"))
        .applyInPandas(emit_again, "slot int, a long, b long, data binary"),
        "simhash-variants",
    )
    across = again.where("slot >= 0").select("slot", "data").groupBy("slot").applyInPandas(between_blocks, "a long, b long")
    return again.where("slot < 0").select("a", "b").unionByName(across).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """One row a document: doc_id, _key, fp, component_id (least id reachable over links) and root
    (least fingerprint of the component: its own name, whatever ids its documents have)."""
    prints = written(fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = written(components(near_links(distinct, distance)), "simhash-roots")
    labelled = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = labelled.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members"))
    # Only fingerprints whose id is not their own least document's are looked up by component.
    merged = labelled.join(ids.where("members > 1"), "root").select("fp", "component_id", "root")
    classes = distinct.join(merged, "fp", "left").select(
        "fp", F.coalesce("component_id", "least").alias("component_id"), F.coalesce("root", "fp").alias("root")
    )
    return prints.join(classes, "fp").select("doc_id", "_key", "fp", "component_id", "root")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of least id (then least text hash) of every component, with their own
    columns. Components that share an id, or have none, stay apart. Of rows with equal id and text one stays."""
    groups = near_duplicates(docs, id_col, text_col)
    stays = groups.groupBy("root").agg(F.min(F.struct("doc_id", "_key")).alias("s")).select("s.*")
    # Names that no column of the documents has.
    taken, mark = {c.lower() for c in docs.columns}, "__"
    while {mark + "id", mark + "key"} & taken:
        mark += "_"
    own_id, own_key = mark + "id", mark + "key"
    mine = docs.withColumns({own_id: F.col(f"`{id_col}`").cast("long"), own_key: F.xxhash64(payload(text_col))})
    match = F.col(own_id).eqNullSafe(F.col("s.doc_id")) & (F.col(own_key) == F.col("s._key"))
    kept = mine.join(stays.alias("s"), match, "left_semi")
    return kept.dropDuplicates([own_id, own_key]).drop(own_id, own_key)
