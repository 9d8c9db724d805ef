"""Quality classifier by importance resampling.

Two hashed n-gram models (words, word pairs, pairs of word shapes, repeated words;
hashed into a fixed number of buckets) are fitted: one on target text (a bounded sample of documents labelled good and not toxic), one on the raw
corpus (all documents). A model is the share of documents that hold a bucket, so one
document that repeats an n-gram does not make it common. A bucket's log ratio compares the
two shares, smoothed by a share, so that rare n-grams stay near 0 and a ratio means the
same in a corpus of any size:

    ratio(b) = log((target(b) / target_documents + SMOOTH) / (raw(b) / documents + SMOOTH))

A document's ``log_ratio`` is the mean over its n-grams, repeats included. Its
``log_weight``, the importance weight that it is sampled by, is the sum of log ratios over
its n-grams, repeats included, in a target model that backs off to the raw model (ratio 0)
for a bucket unless the labels show that target text holds it less often: by a factor of
exp(FAR) at least, or by SURE standard errors of the fitted sample. It backs off above 0
too: raw text holds the target text, so a ratio above 0 is the share of the other text and
nearly the same for all of target text, however long a document is.

Documents are then sampled by Gumbel top-k on ``log_weight / TEMPERATURE``, the noise
being a function of the id and the seed. k is the number of all documents whose weight
is at or above the cut; the cut lets through all but SPARED of the good labelled
documents that were kept out of the fit.

Defined results: a null or empty text has weight 0 (nothing speaks against it); without
usable labels every document is selected; rows that repeat an id share its noise; rows
tied at the threshold are all selected; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import in_small_batches, payload, written

#: Each kind of n-gram has its own buckets: words, word pairs, and shape pairs with repeats.
WORD_BITS, PAIR_BITS, SHAPE_BITS = 17, 16, 14
BUCKETS = (1 << WORD_BITS) + (1 << PAIR_BITS) + (1 << SHAPE_BITS)
#: Most labelled documents used, chosen by a hash of the id; one in HELD_OUT calibrates.
LABEL_SAMPLE = 40_000
HELD_OUT = 5
#: Share of documents added to both shares of a ratio.
SMOOTH = 0.01
#: Where the target model does not back off: this log ratio, or as many standard errors.
FAR, SURE = 0.8, 3.0
#: Share of held-out good documents that may lie below the cut.
SPARED = 0.005
TEMPERATURE = 0.25
SEED = 17
#: Distinct words whose hashes a task keeps.
KEPT_WORDS = 300_000
#: Select the threshold exactly once so few rows are left to look at.
LAST_ROWS = 10_000


def shape(word: str) -> str:
    """Character classes of a word, runs of one class as one: ``Abc12--`` is ``Aa0-``."""
    if word.isalpha():
        if word.islower():
            return "a"
        if word.isupper():
            return "A"
        if word.istitle() and len(word) > 1:
            return "Aa"
    kinds = ("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return "".join(kind for kind, _ in groupby(kinds))


class Features:
    """Bucket numbers of the n-grams of a batch of texts: words, pairs of words, pairs of word
    shapes, and how often a word has just been repeated."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}
        self.hashes = np.zeros((2, 1024), np.uint64)  # of words and of their shapes

    def add(self, words: set[str]) -> None:
        import xxhash

        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        first, last = len(self.known), len(self.known) + len(new)
        if last > self.hashes.shape[1]:
            self.hashes = np.concatenate((self.hashes, np.zeros((2, last), np.uint64)), axis=1)
        digest = xxhash.xxh64_intdigest
        self.known.update(zip(new, range(first, last)))
        self.hashes[0, first:last] = np.fromiter((digest(w, SEED) for w in new), np.uint64, len(new))
        self.hashes[1, first:last] = np.fromiter((digest(shape(w), SEED + 1) for w in new), np.uint64, len(new))

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(buckets, document of each bucket)."""
        words = [t.decode("utf-8", "replace").split() for t in texts]
        self.add(set(chain.from_iterable(words)))
        counts = np.array([len(ws) for ws in words])
        number = np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), np.int64, counts.sum())
        single, form = self.hashes[0, number], self.hashes[1, number]
        doc = np.repeat(np.arange(len(texts)), counts)
        same = doc[1:] == doc[:-1]
        at = np.arange(len(single))
        again = np.zeros(len(single), bool)
        again[1:] = same & (number[1:] == number[:-1])
        run = at - np.maximum.accumulate(np.where(again, 0, at))
        repeated = run >= 2
        runs = mixed(np.minimum(run[repeated], 4).astype(np.uint64), np.uint64(SEED))
        pairs, forms = (mixed(x[:-1], x[1:])[same] for x in (single, form))
        kinds = ((single, WORD_BITS), (pairs, PAIR_BITS), (np.concatenate((forms, runs)), SHAPE_BITS))
        hashed, first = [], 0
        for values, bits in kinds:
            hashed.append((values >> np.uint64(64 - bits)).astype(np.int64) + first)
            first += 1 << bits
        return np.concatenate(hashed), np.concatenate((doc, doc[1:][same], doc[1:][same], doc[repeated]))


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    pair = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(29)))
    return (pair ^ (pair >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)


def label_sample(labels: DataFrame) -> DataFrame:
    """(doc_id, good, held_out) of at most LABEL_SAMPLE labelled documents, one row an id."""
    good = F.min(((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int"))
    order = F.xxhash64("doc_id", F.lit(SEED))
    usable = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    # About twice the sample by hash first, so that no task has to sort all labels.
    ids = usable.agg(F.approx_count_distinct("doc_id", 0.02)).first()[0]
    share = min(1.0, 2.0 * LABEL_SAMPLE / max(ids, 1))
    return (
        usable.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000_007)) < share * 1_000_000_007)
        .select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
        .groupBy("doc_id")
        .agg(good.alias("good"))
        .orderBy(F.pmod(order, F.lit(1_000_000_007)), "doc_id")
        .limit(LABEL_SAMPLE)
        .withColumn("held_out", F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(HELD_OUT)) == 0)
    )


def bucket_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents that hold a bucket, of all documents and of the fitted good ones; the last
    entry counts the documents themselves."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        raw, target = np.zeros(BUCKETS + 1, np.int64), np.zeros(BUCKETS + 1, np.int64)
        for rows in batches:
            buckets, doc = features(rows.column("_bytes").to_pylist())
            held = np.sort(doc * BUCKETS + buckets)  # np.unique takes 30 times as long
            doc, buckets = np.divmod(held[np.diff(held, prepend=-1) > 0], BUCKETS)
            fits = np.array(rows.column("fits").to_pylist(), bool)
            raw += np.bincount(buckets, minlength=BUCKETS + 1)
            target += np.bincount(buckets[fits[doc]], minlength=BUCKETS + 1)
            raw[BUCKETS] += len(fits)
            target[BUCKETS] += fits.sum()
        used = np.flatnonzero(raw)
        if len(used):
            yield pa.RecordBatch.from_pydict({"bucket": used, "raw": raw[used], "target": target[used]})

    sums = (
        in_small_batches(labelled).select("_bytes", F.expr("coalesce(good = 1 AND NOT held_out, false)").alias("fits"))
        .mapInArrow(count, "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toPandas()  # BUCKETS + 1 rows at most
    )
    raw, target = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    raw[sums["bucket"]], target[sums["bucket"]] = sums["raw"], sums["target"]
    return raw, target


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    target_share, raw_share = (x[:-1] / max(x[-1], 1) for x in (target, raw))
    return np.log((target_share + SMOOTH) / (raw_share + SMOOTH))


def model_weights(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of each bucket in the target model that backs off to the raw one."""
    ratios = log_ratios(raw, target)
    share, fitted = raw[:-1] / max(raw[-1], 1), target[-1]
    error = np.sqrt(fitted * share * (1 - share))
    missing = fitted * share - target[:-1]  # documents of the fitted sample short of the raw share
    told = (ratios <= -FAR) | (missing > SURE * error) & (error > 0)
    return np.where(told, np.minimum(ratios, 0), 0.0)


def score(labelled: DataFrame, models) -> DataFrame:
    """doc_id, _key, log_ratio, log_weight, gumbel_key, good, held_out of every document."""
    schema = "doc_id long, _key long, good int, held_out boolean, log_ratio double, log_weight double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        table, weights = models.value
        for rows in batches:
            buckets, doc = features(rows.column("_bytes").to_pylist())
            n = rows.num_rows
            size = np.maximum(np.bincount(doc, minlength=n), 1)
            mean = np.bincount(doc, table[buckets], n) / size
            weight = np.bincount(doc, weights[buckets], n).astype(float)  # integers without n-grams
            kept = [rows.column(c) for c in ("doc_id", "_key", "good", "held_out")]
            names = ["doc_id", "_key", "good", "held_out", "log_ratio", "log_weight"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(mean, pa.float64()), pa.array(weight, pa.float64())], names=names)

    uniform = (F.xxhash64(F.lit(SEED), F.coalesce("doc_id", F.lit(-1))).cast("double") / F.lit(2.0**64)) + F.lit(0.5)
    inside = F.greatest(F.least(uniform, F.lit(1 - 1e-12)), F.lit(1e-12))
    gumbel = -F.log(-F.log(inside))
    return in_small_batches(labelled).mapInArrow(run, schema).withColumn("gumbel_key", F.col("log_weight") / TEMPERATURE + gumbel)


def best_cut(scores: DataFrame) -> float | None:
    """The highest weight that lets through all but SPARED of the held-out good ids, each at
    the lowest weight of its rows; None without any."""
    lowest = scores.where("held_out AND good = 1").groupBy("doc_id").agg(F.min("log_weight").alias("log_weight"))
    good = np.sort(lowest.toPandas()["log_weight"].to_numpy())  # LABEL_SAMPLE rows at most
    return float(good[int(len(good) * SPARED)]) if len(good) else None


def kth_largest(values: DataFrame, column: str, k: int) -> float:
    """The k-th largest value, exactly: counts by equal steps between the ends narrow the
    range down until few rows are left."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    while True:
        inside = values.where(F.col(column).between(low, high))
        step = (high - low) / 1024
        if step <= 0 or low + step == low:
            return low
        bins = F.least(F.floor((F.col(column) - low) / step), F.lit(1023)).alias("bin")
        ranges = (
            inside.groupBy(bins)
            .agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("a"), F.max(column).alias("b"))
            .orderBy(F.desc("bin"))
            .collect()
        )
        for part in ranges:
            if k <= part.n:
                break
            k -= part.n
        low, high = part.a, part.b
        if part.n <= LAST_ROWS:
            last = values.where(F.col(column).between(low, high)).select(column).toPandas()[column]
            return float(np.sort(last.to_numpy())[::-1][k - 1])


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, log_ratio, log_weight, gumbel_key, selected (and ``_key``, a
    hash of the text)."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), payload(text_col))
    sample = written(label_sample(labels), "importance-labels")
    labelled = source.withColumn("_key", F.xxhash64("_bytes")).join(F.broadcast(sample), "doc_id", "left")
    raw, target = bucket_counts(labelled)
    models = (log_ratios(raw, target), model_weights(raw, target)) if target.any() else (np.zeros(BUCKETS),) * 2
    scores = written(score(labelled, docs.sparkSession.sparkContext.broadcast(models)), "importance-scores")
    cut = best_cut(scores)
    selected = F.lit(True)
    if cut is not None:
        k = scores.where(F.col("log_weight") >= cut).count()
        if k:
            selected = F.col("gumbel_key") >= kth_largest(scores, "gumbel_key", k)
    return scores.select("doc_id", "_key", "log_ratio", "log_weight", "gumbel_key", selected.alias("selected"))


def keep_selected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are selected, with their own columns. Only the ids of the rejected
    ones meet the documents again."""
    rejected = classify(docs, labels, id_col, text_col).where("NOT selected").select("doc_id", "_key").distinct()
    mine = F.xxhash64(payload(text_col))
    match = F.col(f"d.`{id_col}`").cast("long").eqNullSafe(F.col("r.doc_id")) & (mine == F.col("r._key"))
    return docs.alias("d").join(rejected.alias("r"), match, "left_anti")
