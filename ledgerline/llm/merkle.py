"""Document fingerprints: Merkle trees over sections, paragraphs and pieces.

A text is cut into paragraphs (lines) and these into pieces (sentences, or slices of long
ones); a paragraph whose hash is 0 modulo SECTION ends a section, so that an edit does not
move the borders behind it. Every node's hash covers its children's. The root is the
fingerprint; two trees are compared from the root down, and only branches that differ are
opened, which gives the likeness (share of characters under equal nodes) and the places
of the edits.

``with_next`` also puts each document beside the next one in descending order of id. The
ids are dealt to ranges between sampled bounds, each range is read in order, and the first
document of a range is sent to the range before it as well: one shuffle of the texts, and
no window over the whole table.

Defined results: null text = empty text, with a fingerprint of its own; equal texts have
equal fingerprints and likeness 1; rows that repeat an id follow one another by text hash;
null ids come last; a single document is its own next; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import in_small_batches, payload

SECTION = 4
#: Longest piece, in characters.
PIECE = 200
#: Bytes of text in a range of ids, about, and the most ranges.
RANGE_BYTES = 8 << 20
MOST_RANGES = 100_000
#: Rows that are looked at for a bound.
SAMPLED = 32
SENTENCE = re.compile(r"[^.!?]*[.!?]+\s*|[^.!?]+")
#: Sorts below every id.
NO_ID = -(2**63)


class Node(NamedTuple):
    digest: bytes
    size: int
    children: tuple


def join(children: list[Node], size: int = 8) -> Node:
    digest = hashlib.blake2b(b"".join(c.digest for c in children), digest_size=size)
    return Node(digest.digest(), sum(c.size for c in children), tuple(children))


def paragraph(line: str) -> Node:
    pieces = []
    for sentence in SENTENCE.findall(line):
        pieces += [sentence[i : i + PIECE] for i in range(0, len(sentence), PIECE)]
    return join([Node(hashlib.blake2b(p.encode(), digest_size=8).digest(), len(p), ()) for p in pieces])


def tree(text: str) -> Node:
    """Root over sections over paragraphs over pieces. Line ends count one character."""
    sections, open_ = [], []
    for line in text.split("\n"):
        node = paragraph(line)
        node = node._replace(size=node.size + 1)
        open_.append(node)
        if node.digest[0] % SECTION == 0:
            sections.append(join(open_))
            open_ = []
    if open_:
        sections.append(join(open_))
    return join(sections, 16)


def shared(left: tuple, right: tuple) -> int:
    """Characters under equal nodes; nodes without an equal are opened together."""
    if not left or not right:
        return 0
    have = Counter(n.digest for n in right)
    same, mine = 0, []
    for node in left:
        if have[node.digest]:
            have[node.digest] -= 1
            same += node.size
        else:
            mine.append(node)
    taken = Counter(n.digest for n in right)
    taken.subtract(have)
    theirs = []
    for node in right:
        if taken[node.digest] > 0:
            taken[node.digest] -= 1
        else:
            theirs.append(node)
    return same + shared(tuple(c for n in mine for c in n.children), tuple(c for n in theirs for c in n.children))


def likeness(left: Node, right: Node) -> float:
    """2 x shared characters / all characters; 1 for equal roots."""
    if left.digest == right.digest:
        return 1.0
    total = left.size + right.size
    return min(1.0, 2.0 * shared(left.children, right.children) / total) if total else 0.0


def edits(left: Node, right: Node) -> list[tuple[int, int]]:
    """Character ranges of ``left`` whose pieces are not in ``right``, found by opening only
    branches that differ."""

    def walk(nodes: tuple, others: tuple, at: int) -> Iterator[tuple[int, int]]:
        have = Counter(n.digest for n in others)
        for node in nodes:
            if have[node.digest]:
                have[node.digest] -= 1
            elif not node.children:
                yield at, at + node.size
            else:
                yield from walk(node.children, tuple(c for o in others for c in o.children), at)
            at += node.size

    out: list[tuple[int, int]] = []
    for start, end in [] if left.digest == right.digest else walk(left.children, right.children, 0):
        if out and out[-1][1] == start:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def edited(text: str, other: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by the first as many of ``other``."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def bounds_of(rows: DataFrame, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds (id, text hash) of about equal ranges, from SAMPLED different rows a range, chosen by hash."""
    if ranges == 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    every = max(1, rows.count() // (ranges * SAMPLED))
    some = rows.where(F.pmod(F.xxhash64(F.lit(11), "_order", "_key"), F.lit(every)) == 0).distinct().collect()
    some = sorted((r[0], r[1]) for r in some)
    cut = sorted({some[len(some) * i // ranges] for i in range(1, ranges)}) if some else []
    return np.array([b[0] for b in cut], np.int64), np.array([b[1] for b in cut], np.int64)


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, range, copy, _key, _bytes), in order inside each partition: rows of a range by
    descending id, then a copy of the row that follows the range's last."""
    spark = docs.sparkSession
    order = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID))
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), order.alias("_order"), payload(text_col))
    total = source.agg(F.sum(F.octet_length("_bytes").cast("long"))).first()[0] or 0
    ranges = min(MOST_RANGES, max(1, math.ceil(total / RANGE_BYTES)))
    hashed = source.withColumn("_key", F.xxhash64("_bytes"))
    ids, keys = bounds_of(hashed.select("_order", "_key"), ranges)

    @F.pandas_udf("int")
    def range_of(order: pd.Series, key: pd.Series) -> pd.Series:
        order, key = order.to_numpy(), key.to_numpy()
        at, end = np.searchsorted(ids, order, "left"), np.searchsorted(ids, order, "right")
        for one in np.unique(order[end > at]):  # ids at which ranges are cut by the text's hash
            rows = order == one
            lo, hi = np.searchsorted(ids, one, "left"), np.searchsorted(ids, one, "right")
            at[rows] = lo + np.searchsorted(keys[lo:hi], key[rows], "right")
        return pd.Series(at.astype(np.int32))

    ranged = hashed.withColumn("range", range_of("_order", "_key"))
    first = F.max(F.struct("_order", "_key")).alias("first")
    heads = sorted(ranged.groupBy("range").agg(first).collect(), key=lambda r: r["range"])  # a row a range
    schema = "_order long, _key long, target int"
    above = [(h.first._order, h.first._key, heads[(i + 1) % len(heads)]["range"]) for i, h in enumerate(heads)]
    copies = (
        ranged.join(F.broadcast(spark.createDataFrame(above, schema)), ["_order", "_key"])
        .select("doc_id", "_order", F.col("target").alias("range"), F.lit(1).alias("copy"), "_key", "_bytes")
    )
    rows = ranged.select("doc_id", "_order", "range", F.lit(0).alias("copy"), "_key", "_bytes").unionByName(copies)
    return rows.repartition("range").sortWithinPartitions("range", "copy", F.desc("_order"), F.desc("_key"))


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_edits (ranges of the text that the edit changed)."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_edits"]

    def row(doc_id, text: str, root: Node, after: str, after_root: Node) -> tuple:
        new = edited(text, after)
        new_root = tree(new)
        return (
            doc_id,
            len(text),
            hashlib.sha256(new.encode()).hexdigest(),
            root.digest.hex(),
            new_root.digest.hex(),
            likeness(root, new_root),
            likeness(root, after_root),
            len(edits(root, new_root)),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before, which waits for its next
        for rows in batches:
            out = []
            columns = (rows.column(c).to_pylist() for c in ("doc_id", "range", "copy", "_bytes"))
            for doc_id, part, copy, data in zip(*columns, strict=True):
                if copy and held is None:
                    continue  # a second copy, as its row is in the table twice
                text = data.decode("utf-8", "replace")
                root = tree(text)
                if held is not None:
                    out.append(row(*held, text, root))
                held = None if copy else (doc_id, text, root)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names
            )

    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, n_edits long"
    )
    return in_small_batches(with_next(docs, id_col, text_col)).mapInArrow(run, schema)
