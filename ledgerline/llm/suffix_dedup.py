"""Removal of repeated byte strings, by suffix arrays of document segments.

A byte goes if a SPAN-byte string that covers it also starts earlier: in a document of
smaller id, or earlier in the same one. Documents are UTF-8 bytes; matches never cross
them; all strings are judged on the input.

Spark deals the work out so that no task needs the whole corpus:

1. Anchors. In every SPAN-byte window the GRAM-byte string of least hash is its anchor
   (winnowing), so equal windows have an anchor in common. A segment is what a run of
   windows with one anchor covers. Anchor hashes are counted over the corpus; only anchors
   that occur twice or more go on.
2. Copies. Equal segments are grouped by 128 bits of hash of their content, beside the 64 of
   their anchor: all but the first are removed whole, and only the first goes on, so copies
   never pile up.
3. Suffix arrays. Different segments with one anchor are collected into buckets of
   bounded size. Windows that hold their anchor at nearly the same offset share a core;
   where a core occurs once, nothing can be equal. What is equal as a whole is found by its
   bytes; the Burrows-Wheeler transform and common
   prefixes of the rest are built column by column (``bwt``); runs of suffixes that share
   SPAN bytes are equal windows, and all but the earliest are removed. An anchor with more
   than HOT different segments is not collected: its segments are cut into their single
   windows, which are grouped by content as in step 2.
4. The removed ranges meet their documents again.

Defined results: null text = empty text; documents under SPAN bytes stay whole; rows that
repeat an id with other text come in the order of their numbers (``keyed``); of rows equal in id and
text one stays and the others count as later; a null id comes first; other columns are
ignored, or passed on by ``remove``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.llm.bwt import build
from ledgerline.llm.common import in_small_batches, payload, written
from ledgerline.llm.sharding import numbered

SPAN = 100
GRAM = 32
#: k-grams in a window.
WIDE = SPAN - GRAM + 1
SEED = 5
#: Bases (odd) of the hash and of a second one, which confirms that segments are equal.
BASE, SECOND_BASE = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
#: Bytes hashed at a time; longer documents are hashed in overlapping parts.
PART = 1 << 20
#: Segments in a bucket, about; more different segments of one anchor are split by window.
BUCKET = 4096
HOT = 4096
#: Strings in one suffix array, about.
COLLECTION = 1024
#: Offsets of the anchor in a window that are treated alike; their windows share the rest.
OFFSETS = 17
#: A place is a position in a document, below the number of its text among those of its id.
PLACE_BITS = 32
ODD = np.uint64(0x9E3779B97F4A7C15)
NO_ID = -(2**63)
#: Buckets in which the texts of one id are numbered.
NUMBERED = 4096


class Hasher:
    """Polynomial hashes of all windows of a byte array, modulo 2**64."""

    def __init__(self, size: int = 2 * PART + 2 * SPAN, base: int = BASE, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.symbol = rng.integers(1, 2**63, 256, np.uint64)
        base, inverse = np.uint64(base), np.uint64(pow(base, -1, 2**64))
        self.power = np.cumprod(np.full(size, base, np.uint64))
        self.inverse = np.cumprod(np.full(size, inverse, np.uint64))

    def sums(self, data: np.ndarray) -> np.ndarray:
        terms = self.symbol[data]
        terms *= self.power[: len(data)]
        out = np.empty(len(data) + 1, np.uint64)
        out[0] = 0
        np.cumsum(terms, out=out[1:])
        return out

    def windows(self, sums: np.ndarray, first: np.ndarray | slice, last: np.ndarray | slice) -> np.ndarray:
        """Hashes of data[first:last], equal for equal content wherever it stands."""
        value = sums[last] - sums[first]
        value *= self.inverse[: len(sums)][first]
        value ^= value >> np.uint64(32)
        value *= ODD
        value ^= value >> np.uint64(29)
        return value


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over each run of ``width`` values: doubling steps, then two that overlap."""
    step, out = 1, values
    while 2 * step <= width:
        out = pick(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(hasher: Hasher, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple:
    """(anchor hash, segment hash, document, segment start, segment length, whether its anchor
    stands in it twice) over documents that lie at starts:ends in ``data``. A segment is a run of windows with one anchor hash,
    at most WIDE of them."""
    n = len(data)
    if n < SPAN:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, bool))
    sums = hasher.sums(np.frombuffer(data, np.uint8))
    grams = hasher.windows(sums, slice(0, n - GRAM + 1), slice(GRAM, n + 1))
    least = sliding(grams, WIDE, np.minimum)  # a window each
    inside = np.zeros(n + 1, np.int32)
    fits = ends - starts >= SPAN
    inside[starts[fits]] += 1
    inside[ends[fits] - SPAN + 1] -= 1
    inside = np.cumsum(inside[: len(least)]) > 0  # not across documents
    begins = np.ones(len(least), bool)
    begins[1:] = (least[1:] != least[:-1]) | ~inside[:-1]
    run = np.flatnonzero(begins)
    length = np.diff(run, append=len(least))
    # Runs of repetitive text are long: they go in parts.
    pieces = -(-length // WIDE)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(run, pieces) + nth * WIDE
    windows = np.minimum(np.repeat(length, pieces) - nth * WIDE, WIDE)
    first, windows = first[inside[first]], windows[inside[first]]
    doc = np.searchsorted(ends, first, side="right")
    windows = np.minimum(windows, ends[doc] - SPAN + 1 - first)
    last = first + windows - 1 + SPAN
    # Anchors that stand twice in a segment: it may repeat a window within itself.
    padded = np.zeros(len(least) + 2 * (WIDE - 1), np.uint64)
    padded[WIDE - 1 : WIDE - 1 + len(least)] = least
    marks = np.flatnonzero(sliding(padded, WIDE, np.maximum) == grams)
    near = np.flatnonzero((grams[marks[1:]] == grams[marks[:-1]]) & (np.diff(marks) <= WIDE))
    left, right = np.append(marks[near], n), np.append(marks[near + 1], 2 * n)
    again = right[np.searchsorted(left, first)] <= last - GRAM
    return least[first], hasher.windows(sums, first, last), doc, first - starts[doc], last - first, again


def parts(texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined to about PART bytes: data, starts, ends, row, offset in the row. Long texts
    come in parts that overlap by less than a window, so each window is in one of them."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def joined() -> tuple:
        lengths = np.array([len(b) for _, _, b in held])
        ends = np.cumsum(lengths)
        rows, offsets = np.array([r for r, _, _ in held]), np.array([o for _, o, _ in held])
        return b"".join(b for _, _, b in held), ends - lengths, ends, rows, offsets

    for row, text in enumerate(texts):
        for offset in range(0, max(len(text) - SPAN + 1, 0), PART):
            piece = text[offset : offset + PART + SPAN - 1]
            held.append((row, offset, piece))
            size += len(piece)
            if size >= PART:
                yield joined()
                held, size = [], 0
    if held:
        yield joined()


def keyed(docs: DataFrame, id_col: str, text_col: str, *others: Column) -> DataFrame:
    """``docs`` as (_order, _part, _bytes, others). ``_order`` is the id and ``_part`` numbers the
    different texts of an id, by 128 bits of hash; it is 0 where ids do not repeat, and only
    the texts of ids that do are hashed. Texts of one id are numbered in buckets, so that an
    id (or null) with a third of all rows is not numbered by one task."""
    order = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("_order")
    rows = docs.select(order, payload(text_col), *others)
    counts = docs.select(order).groupBy("_order").agg(F.count(F.lit(1)).alias("n"))
    repeated = written(counts.where("n > 1").select("_order"), "dedup-ids")
    if repeated.isEmpty():
        return rows.select("_order", F.lit(0).alias("_part"), "_bytes", *others_of(rows))
    hashes = [F.xxhash64(F.lit(SEED + i), "_bytes").alias(f"_hash{i}") for i in (0, 1)]
    hashed = docs.select(order, payload(text_col)).join(repeated, "_order", "left_semi").select("_order", *hashes)
    texts = hashed.distinct().withColumns({"bucket": F.pmod("_hash0", F.lit(NUMBERED)).cast("int"), "n": F.lit(1)})
    numbers = numbered(written(texts, "dedup-texts"), "_order", ["_hash0", "_hash1"])
    numbers = written(numbers.select("_order", "_hash0", "_hash1", F.col("first").cast("int").alias("_part")), "dedup-numbers")
    found = rows.select("*", *hashes).join(numbers, ["_order", "_hash0", "_hash1"], "left")
    return found.select("_order", F.coalesce("_part", F.lit(0)).alias("_part"), "_bytes", *others_of(rows))


def others_of(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c not in ("_order", "_bytes")]


def anchor_rows(keyed: DataFrame, all_columns: bool) -> DataFrame:
    """(h, n) or (h, g, sure, _order, place, len) of every segment; n is 2 where the anchor stands
    in it twice, and len is negative. ``sure`` is a second hash of the segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        second = Hasher(base=SECOND_BASE, seed=SEED + 1) if all_columns else None
        for rows in batches:
            order, part = rows.column("_order").to_numpy(), rows.column("_part").to_numpy().astype(np.int64)
            for data, starts, ends, row, offset in parts(rows.column("_bytes").to_pylist()):
                h, g, doc, first, size, again = anchors(hasher, data, starts, ends)
                if all_columns:
                    place = (part[row[doc]] << PLACE_BITS) + offset[doc] + first
                    at = starts[doc] + first
                    sure = second.windows(second.sums(np.frombuffer(data, np.uint8)), at, at + size)
                    signed = np.where(again, -size, size).astype(np.int16)
                    columns = [h.view(np.int64), g.view(np.int64), sure.view(np.int64), order[row[doc]], place, signed]
                else:
                    columns = [h.view(np.int64), 1 + again.astype(np.int8)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    names = ["h", "g", "sure", "_order", "place", "len"] if all_columns else ["h", "n"]
    schema = "h long, g long, sure long, _order long, place long, len short" if all_columns else "h long, n byte"
    return in_small_batches(keyed).mapInArrow(run, schema)


def cores(bucket: pd.DataFrame) -> tuple:
    """Cuts the segments of a bucket into sub-segments: neighbouring windows that hold their
    anchor at nearly the same offset, and so have a long core in common. Returns, for each,
    the row of the bucket, first and last byte, and hash of anchor, offset and core. Equal windows have equal cores, wherever their segments were cut."""
    lengths = bucket["segment"].str.len().to_numpy()
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(bucket["segment"]), np.uint8)
    hasher = Hasher(len(data) + 1)
    sums = hasher.sums(data)
    grams = hasher.windows(sums, slice(0, len(data) - GRAM + 1), slice(GRAM, len(data) + 1))
    row = np.repeat(np.arange(len(bucket)), lengths)
    is_anchor = grams == bucket["h"].to_numpy().view(np.uint64)[row[: len(grams)]]
    follows = np.where(is_anchor, np.arange(len(grams)), len(data))
    follows = np.minimum.accumulate(follows[::-1])[::-1]  # the next anchor from here on
    first = np.arange(len(data))
    first = first[first + SPAN <= ends[row]]
    anchor = follows[first]
    kind = (anchor - first) // OFFSETS
    new = np.ones(len(first), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (kind[1:] != kind[:-1]) | (row[first[1:]] != row[first[:-1]])
    begin = np.flatnonzero(new)
    end = np.concatenate((begin[1:], [len(first)])) - 1
    a, b = first[begin], first[end] + SPAN
    core = anchor[begin] - kind[begin] * OFFSETS
    shared = hasher.windows(sums, core, core + SPAN - OFFSETS + 1)
    shared ^= grams[anchor[begin]] + kind[begin].astype(np.uint64) * ODD
    return row[a], a - (ends - lengths)[row[a]], b - (ends - lengths)[row[a]], shared


def twice(values: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    _, at, n = np.unique(values, return_inverse=True, return_counts=True)
    return n[at] > 1


def equal_windows(bucket: pd.DataFrame) -> pd.DataFrame:
    """Ranges of a bucket's segments that also stand earlier."""
    bucket = bucket.sort_values(["_order", "place"], kind="stable").reset_index(drop=True)
    row, begin, end, core = cores(bucket)
    kept = twice(core)  # other sub-segments cannot hold a window of another one
    row, begin, end, core = (x[kept] for x in (row, begin, end, core))
    at = bucket["place"].to_numpy()[row] + begin
    order = bucket["_order"].to_numpy()[row]
    by = np.lexsort((at, order))
    row, begin, end, core, at, order = (x[by] for x in (row, begin, end, core, at, order))
    segment = bucket["segment"].to_numpy()
    strings = [segment[r][a:b] for r, a, b in zip(row, begin, end, strict=True)]
    seen: dict[bytes, int] = {}
    head = np.array([seen.setdefault(x, i) for i, x in enumerate(strings)], np.int64)
    copies = (at != at[head]) | (order != order[head])
    out = [pd.DataFrame({"_order": order[copies], "place": at[copies], "size": (end - begin)[copies]})]
    first = np.flatnonzero(head == np.arange(len(head)))
    first = first[twice(core[first])]
    for part in buckets_of(core[first]):
        chosen = first[part]
        out.append(by_suffixes([strings[i] for i in chosen], order[chosen], at[chosen]))
    return pd.concat(out, ignore_index=True)


def buckets_of(keys: np.ndarray) -> Iterator[np.ndarray]:
    """Whole groups of equal keys, gathered to about COLLECTION strings."""
    by = np.argsort(keys, kind="stable")
    ordered = keys[by]
    start = 0
    while start < len(by):
        end = min(start + COLLECTION, len(by))
        if end < len(by):
            end = int(np.searchsorted(ordered, ordered[end - 1], side="right"))
        yield by[start:end]
        start = end


def by_suffixes(strings: list[bytes], owner: np.ndarray, place: np.ndarray) -> pd.DataFrame:
    """Ranges of strings, which stand at (owner, place), that also stand earlier in another."""
    string, start, prefix = build(strings)
    with_before = prefix >= SPAN
    group = np.cumsum(~with_before)
    member = with_before.copy()
    member[:-1] |= with_before[1:]
    string, start, group = string[member], start[member], group[member]
    at = place[string] + start
    by = np.lexsort((at, owner[string], group))
    group, owner, at = group[by], owner[string][by], at[by]
    first = np.ones(len(group), bool)
    first[1:] = group[1:] != group[:-1]
    head = np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
    later = (owner != owner[head]) | (at != at[head])
    return ranges(owner[later], at[later])


def ranges(order: np.ndarray, at: np.ndarray) -> pd.DataFrame:
    """Windows that touch as one range."""
    by = np.lexsort((at, order))
    order, at = order[by], at[by]
    new = np.ones(len(at), bool)
    new[1:] = (order[1:] != order[:-1]) | (at[1:] > at[:-1] + SPAN)
    end = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(at) - 1])).astype(int) if len(at) else np.zeros(0, int)
    return pd.DataFrame({"_order": order[new], "place": at[new], "size": at[end] - at[new] + SPAN})


def fetch_segments(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, n, _order, place, segment) of wanted (h, n, _order, place, len)."""
    part = F.shiftright("place", PLACE_BITS).cast("int").alias("_part")
    lists = wanted.groupBy("_order", part).agg(F.collect_list(F.struct("h", "n", "place", "len")).alias("_list"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = (1 << PLACE_BITS) - 1
        for rows in batches:
            out = []
            columns = (rows.column(c).to_pylist() for c in ("_order", "_bytes", "_list"))
            for order, data, found in zip(*columns, strict=True):
                for x in found:
                    at = x["place"] & mask
                    out.append((x["h"], x["n"], order, x["place"], data[at : at + x["len"]]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    names = ["h", "n", "_order", "place", "segment"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    schema = "h long, n long, _order long, place long, segment binary"
    return docs.join(lists.hint("shuffle_hash"), ["_order", "_part"]).select("_order", "_bytes", "_list").mapInArrow(run, schema)


def later_windows(segments: DataFrame) -> DataFrame:
    """Ranges (_order, place, size) of single windows of hot anchors that also stand earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = []
            columns = (rows.column(c).to_pylist() for c in ("_order", "place", "segment"))
            for order, place, data in zip(*columns, strict=True):
                for i in range(len(data) - SPAN + 1):
                    digest = hashlib.blake2b(data[i : i + SPAN], digest_size=16).digest()
                    out.append((digest, order, place + i))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    names, types = ["w", "_order", "place"], [pa.binary(), pa.int64(), pa.int64()]
    windows = segments.mapInArrow(run, "w binary, _order long, place long")
    first = windows.groupBy("w").agg(F.min(F.struct("_order", "place")).alias("first"), F.count(F.lit(1)).alias("n"))
    return later_than(windows, first, ["w"]).select("_order", "place", F.lit(SPAN).cast("long").alias("size"))


def later_than(rows: DataFrame, first: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that are not the first of their keys."""
    late = (F.col("_order") != F.col("first._order")) | (F.col("place") != F.col("first.place"))
    return rows.join(first.where("n > 1").select(*keys, "first"), keys).where(late)


def removed_ranges(docs: DataFrame) -> DataFrame:
    """(_order, place, size) of all byte ranges to remove. ``docs``: _order, _part, _bytes."""
    repeated = written(
        anchor_rows(docs, False).groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h"),
        "dedup-anchors",
    )
    found = written(anchor_rows(docs, True).join(repeated, "h"), "dedup-segments")
    first = written(
        found.groupBy("h", "g", "sure").agg(
            F.min(F.struct("_order", "place", "len")).alias("first"), F.count(F.lit(1)).alias("n")
        ),
        "dedup-first",
    )
    copies = later_than(found, first, ["h", "g", "sure"]).select("_order", "place", F.abs("len").cast("long").alias("size"))

    kinds = first.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.min("first.len").alias("least"))
    wanted = first.join(kinds.where("kinds > 1 OR least < 0"), "h").select(
        "h", F.col("kinds").alias("n"), "first._order", "first.place", F.abs("first.len").alias("len")
    )
    segments = written(fetch_segments(docs, wanted), "dedup-different")
    few = segments.where(F.col("n") <= HOT)
    buckets = max(1, math.ceil(few.count() / BUCKET))
    tasks = min(buckets, 20_000)
    by_anchor = few.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)).cast("int")).repartition(tasks, "bucket")
    inside = by_anchor.groupBy("bucket").applyInPandas(equal_windows, "_order long, place long, size long")
    return copies.unionByName(inside).unionByName(later_windows(segments.where(F.col("n") > HOT)))


def cut(rows: DataFrame) -> DataFrame:
    """``rows`` (_order, _part, _bytes and more) with the ranges to remove from each row, as
    pairs; the pair (-1, -1) tells that another row has its id and text."""
    lost = removed_ranges(rows.select("_order", "_part", "_bytes"))
    part = F.shiftright("place", PLACE_BITS).cast("int").alias("_part")
    start = F.col("place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    none = F.lit(-1).cast("long")
    equal = rows.groupBy("_order", "_part").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    marks = lost.select("_order", part, F.struct(start.alias("a"), (start + F.col("size")).alias("b")).alias("r"))
    marks = marks.unionByName(equal.select("_order", "_part", F.struct(none.alias("a"), none.alias("b")).alias("r")))
    lists = marks.groupBy("_order", "_part").agg(F.collect_set("r").alias("_ranges"))
    return rows.join(lists.hint("shuffle_hash"), ["_order", "_part"], "left")


def kept_spans(data: bytes, found: list[dict] | None, seen: set, key: tuple) -> tuple[int, int, bytes]:
    """(bytes removed, maximal removed runs, bytes kept)."""
    marks = sorted((x["a"], x["b"]) for x in found or ())
    if marks and marks[0][0] < 0:  # rows that repeat id and text hash meet in one task
        marks = [x for x in marks if x[0] >= 0]
        own = (*key, hashlib.sha256(data).digest())
        if own in seen and len(data) >= SPAN:
            marks = [(0, len(data))]
        seen.add(own)
    kept, removed, runs, end = [], 0, 0, 0
    last = -1
    for a, b in marks:
        if a > last:  # runs that touch are one
            kept.append(data[end:a])
            runs += 1
            removed += b - a
            last = end = b
        elif b > last:
            removed += b - last
            last = end = b
    kept.append(data[end:])
    return removed, runs, b"".join(kept)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for rows in batches:
            out = []
            columns = (rows.column(c).to_pylist() for c in ("_order", "_part", "_bytes", "_ranges"))
            for order, part, data, found in zip(*columns, strict=True):
                removed, runs, kept = kept_spans(data, found, seen, (order, part))
                doc_id = None if order == NO_ID else order
                out.append((doc_id, len(data), removed, runs, hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return cut(keyed(docs, id_col, text_col)).mapInArrow(run, schema)


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The documents without their removed bytes, with their own columns. Characters of which
    a part is removed go with it. ``length_col``, if there, gets the new number of code
    points."""
    others = [c for c in docs.columns if c not in (text_col, length_col)]
    row = F.struct(
        F.col(f"`{text_col}`").isNull().alias("gone"),
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)],
    )
    rows_of = keyed(docs, id_col, text_col, row.alias("_row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for rows in batches:
            texts = []
            columns = (rows.column(c).to_pylist() for c in ("_order", "_part", "_bytes", "_ranges"))
            for order, part, data, found in zip(*columns, strict=True):
                kept = kept_spans(data, found, seen, (order, part))[2]
                texts.append(kept.decode("utf-8", "replace" if kept == data else "ignore"))
            yield pa.RecordBatch.from_arrays([rows.column("_row"), pa.array(texts, pa.string())], names=["_row", "_text"])

    cleaned = cut(rows_of).mapInArrow(run, StructType([rows_of.schema["_row"], StructField("_text", StringType())]))
    new = {f"`{c}`": F.col(f"_row.c{i}") for i, c in enumerate(others)}
    new[f"`{text_col}`"] = F.when(~F.col("_row.gone"), F.col("_text"))
    if length_col in docs.columns:
        new[f"`{length_col}`"] = F.length("_text").cast(docs.schema[length_col].dataType)
    return cleaned.select(*[new[f"`{c}`"].alias(c) for c in docs.columns])
