"""Ranked lexical search by the Best Position Algorithm.

Items (a stated query set) are ranked against all documents, in blocks of items. Each
block takes two passes:

1. every text is cut into terms once; of a document go on its number of terms and the
   counts of the terms that the block asks for. From these follow N, L and each df.
2. a task cuts its documents into segments of bounded size and makes, for every term asked
   for, the list of its impacts in descending order. For an item the lists of its terms are
   read downwards together; a document met for the first time is looked up in all the other
   lists (direct access), which gives its score and its position in each. A list's best
   position is the last one up to which all positions have been seen, by either access. A
   document not seen yet scores at most the sum of the impacts at the best positions: when
   that falls strictly below the kth score so far, the item is done with the segment. The
   kth score is carried from segment to segment. Lists are read in strides that double, so
   the bound is tested a logarithmic number of times.

A task gives k documents an item at most; these are ranked among tasks in two steps, first
in salted groups, so that no group grows with the corpus.

Defined results: a null text has no terms; an item or document without terms has no rows;
documents are ranked row by row, so repeated ids take a rank each; a null id comes after
all others of its score; each row of the items is ranked (a repeated one, repeatedly);
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import in_small_batches, payload, written

#: Maximal matches of this are terms; ASCII only is lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes that end a term become blanks, A-Z become a-z; UTF-8 bytes from 128 are left.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
TOP = 50
#: Terms (with repeats) of the items of one block; documents and postings of a segment.
BLOCK_TERMS = 200_000
SEGMENT_DOCS = 4096
SEGMENT_POSTINGS = 1 << 20
#: Groups of an item's candidates in the first of the two ranking steps.
SALTS = 64

POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"
FOUND = "item int, doc_id long, score long"


def terms_of(data: bytes) -> list[bytes]:
    return data.translate(FOLD).split()


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def postings(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Number of terms of every document that has one, and counts of its terms in the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, kinds = vocabulary.get, [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        for batch in batches:
            ids, sizes, terms, counts = [], [], [], []
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = terms_of(data.as_py())
                if not words:
                    continue
                known = [t for t in map(number, words) if t is not None]
                held, often = np.unique(np.array(known, np.int32), return_counts=True)
                ids.append(doc)
                sizes.append(len(words))
                terms.append(held)
                counts.append(often.astype(np.int32))
            columns = (ids, sizes, terms, counts)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n", "terms", "counts"])

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), payload(f"`{text_col}`", "text"))
    return in_small_batches(texts).mapInArrow(run, POSTINGS)


class Best:
    """The k best documents of an item so far; null ids come last among equals."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.doc = np.empty(0, np.int64), np.empty(0, np.int64)
        self.null = np.empty(0, bool)

    def floor(self) -> int:
        """The kth score; 0 while there are fewer, as only scores above 0 count."""
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        keep = score >= max(1, self.floor())
        if keep.any():
            score, doc = np.concatenate([self.score, score[keep]]), np.concatenate([self.doc, doc[keep]])
            null = np.concatenate([self.null, null[keep]])
            first = np.lexsort((doc, null, -score))[: self.k]
            self.score, self.doc, self.null = score[first], doc[first], null[first]


class Segment:
    """Impact lists of a bounded number of documents: per term, documents by descending impact."""

    def __init__(self, doc: np.ndarray, null: np.ndarray, n: np.ndarray, at: np.ndarray, term: np.ndarray, tf: np.ndarray,
                 weights: np.ndarray, documents: int, length: int):
        self.doc, self.null = doc, null
        m = 50 + 50 * n * documents // length
        impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[at]))
        order = np.lexsort((at, -impact, term))
        self.at, self.impact = at[order], impact[order]
        self.starts = np.searchsorted(term[order], np.arange(len(weights) + 1))
        self.work = np.zeros((0, len(doc)), np.int64), np.zeros((0, len(doc)), np.int64)

    def rank(self, terms: np.ndarray, best: Best) -> int:
        """Best Position Algorithm over the lists of ``terms``; returns the documents it met."""
        from_, to = self.starts[terms], self.starts[terms + 1]
        held = to > from_
        from_, to = from_[held], to[held]
        lists = len(from_)
        if not lists:
            return 0
        # positions of all lists in a row, with a place after each that is never seen
        offset = np.concatenate([[0], np.cumsum(to - from_ + 1)])
        docs = [self.at[a:b] for a, b in zip(from_, to, strict=True)]
        impacts = np.zeros(offset[-1], np.int64)
        if len(self.work[0]) < lists:
            self.work = np.zeros((lists, len(self.doc)), np.int64), np.full((lists, len(self.doc)), 0)
        value, place = self.work[0][:lists], self.work[1][:lists]
        value[:] = 0
        place[:] = offset[1:, None] - 1
        for i, (a, b) in enumerate(zip(from_, to, strict=True)):
            value[i, docs[i]] = impacts[offset[i] : offset[i] + b - a] = self.impact[a:b]
            place[i, docs[i]] = np.arange(offset[i], offset[i] + b - a)
        seen = np.zeros(offset[-1], bool)
        met = np.zeros(len(self.doc), bool)
        depth, stride, longest = 0, 1, int((to - from_).max())
        while depth < longest:
            fresh = np.zeros(len(self.doc), bool)
            for one in docs:  # sorted access
                fresh[one[depth : depth + stride]] = True
            fresh = np.flatnonzero(fresh & ~met)
            met[fresh] = True
            score = value[:, fresh].sum(axis=0)  # direct access: impacts and positions
            seen[place[:, fresh].ravel()] = True
            seen[offset[1:] - 1] = False
            best.add(score, self.doc[fresh], self.null[fresh])
            unseen = np.flatnonzero(~seen)
            next_ = unseen[np.searchsorted(unseen, offset[:-1])]  # the best position is the one before
            bound = np.where(next_ == offset[1:] - 1, 0, impacts[np.maximum(next_ - 1, 0)])
            bound[next_ == offset[:-1]] = impacts[offset[:-1]][next_ == offset[:-1]]
            if int(bound.sum()) < best.floor():
                break
            depth, stride = depth + stride, stride * 2
        return int(met.sum())


def ranked(frame: DataFrame, items: list[np.ndarray], weights: np.ndarray, documents: int, length: int, k: int) -> DataFrame:
    """The k best documents of every item in each task."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[Segment]:
        held: list[tuple] = []
        docs = rows = 0
        for whole in batches:
            for lo in range(0, whole.num_rows, SEGMENT_DOCS):
                batch = whole.slice(lo, SEGMENT_DOCS)
                terms, counts = batch.column(2), batch.column(3)
                sizes = np.diff(terms.offsets.to_numpy())
                if held and (docs + batch.num_rows > SEGMENT_DOCS or rows + int(sizes.sum()) > SEGMENT_POSTINGS):
                    yield made(held)
                    held, docs, rows = [], 0, 0
                ids = batch.column(0)
                held.append((
                    ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), batch.column(1).to_numpy(),
                    np.repeat(np.arange(batch.num_rows) + docs, sizes),
                    terms.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy().astype(np.int64),
                ))
                docs, rows = docs + batch.num_rows, rows + int(sizes.sum())
        if held:
            yield made(held)

    def made(held: list[tuple]) -> Segment:
        return Segment(*[np.concatenate(c) for c in zip(*held, strict=True)], weights, documents, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        for segment in segments(batches):
            for one, terms in zip(best, items, strict=True):
                segment.rank(terms, one)
        for i, one in enumerate(best):
            if len(one.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(one.score), i, np.int32)), pa.array(one.doc, mask=one.null), pa.array(one.score)],
                    names=["item", "doc_id", "score"],
                )

    return in_small_batches(frame).mapInArrow(run, FOUND)


def best_of(found: DataFrame, groups: list[str], k: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    placed = found.withColumn("rank", F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
    return placed.where(F.col("rank") <= k)


def search_block(spark, rows: list, docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame | None:
    """Ranks of one block of items: (item, rank, doc_id, score); ``item`` counts the rows of the block."""
    asked = [sorted(set(terms_of(r["text"]))) for r in rows]
    vocabulary = {t: i for i, t in enumerate(sorted({t for terms in asked for t in terms}))}
    if not vocabulary:
        return None
    held = written(postings(docs, vocabulary, id_col, text_col), "postings")
    documents, length = held.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not documents:
        return None
    df = np.zeros(len(vocabulary), np.int64)
    # at most a row a term of the block
    for term, n in held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect():
        df[term] = n
    weights = np.array([weight(documents, int(n)) for n in df], np.int64)
    items = [np.array([vocabulary[t] for t in terms], np.int64) for terms in asked]
    found = written(ranked(held, items, weights, documents, length, k), "found")
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    few = best_of(salted, ["item", "salt"], k).drop("salt", "rank")
    return best_of(few, ["item"], k).select("item", "rank", "doc_id", "score")


def search(
    items: DataFrame, docs: DataFrame, k: int = TOP, item_col: str = "item_id", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of highest score above 0 for each item."""
    spark = docs.sparkSession
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), payload(f"`{text_col}`", "text"))
    asked = asked.groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("copies"))
    n_terms = F.coalesce(F.sum(F.octet_length("text") / 2 + 1), F.lit(0)).alias("terms")  # a term and what ends it: two bytes at least
    blocks = max(1, math.ceil(asked.agg(n_terms).first()["terms"] / BLOCK_TERMS))
    asked = written(asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "items")
    kind = asked.schema["item_id"].dataType.simpleString()
    result = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in range(blocks):
        rows = asked.where(F.col("block") == block).select("item_id", "text", "copies").collect()
        ranks = search_block(spark, rows, docs, k, id_col, text_col) if rows else None
        if ranks is not None:
            names = spark.createDataFrame([(i, r["item_id"], r["copies"]) for i, r in enumerate(rows)], f"item int, item_id {kind}, copies long")
            copied = ranks.join(names, "item").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            result = result.unionByName(copied.select("item_id", "rank", "doc_id", "score"))
    return result
