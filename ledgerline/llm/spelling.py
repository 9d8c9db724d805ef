"""Spelling variant grouping by dynamic programming along the sorted vocabulary.

The vocabulary is sorted twice, by the words and by the words reversed. Two words within
one edit share, with m the length of the shorter, either their first m // 2 code points or
(nearly) as many of the last: the first kind is found in the forward list, the other in the reversed
one, each pair once.

A list is cut into ranges of bounded size. A word goes to the range it stands in and to
every other range that can hold a near word: along the ranges' bounds the edit matrix of
the word against the prefix that a range shares is kept, and ranges whose shared prefix
already exceeds one edit are skipped together.

Inside a range the members are scanned in sorted order, all words of the range at once.
Members with a common prefix (an interval between the places where the adjacent common
prefix is shorter) share the rows of their edit matrix, which is a band of three cells;
an interval is split only where its members differ, one row is computed for each part, and
a part whose row exceeds one edit everywhere is skipped whole.

Defined results: a null text has no words; a null id is written as an empty one before the
colon; rows that repeat an id count each; words of any length are held without padding;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import in_small_batches, payload, written

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
RUN = re.compile("[a-zÀ-ÿ]+")
#: A run loses a code point where this divides its checksum.
MUTATED = 31
SHORTEST, FEWEST = 7, 2
#: A form occurs so many times as often as the word.
TIMES = 10
#: Above every code point of a run.
ABOVE = "Ā"
#: Words of a range; ranges of a list at most (beyond, ranges grow); sampled words a bound.
RANGE = 8192
RANGES = 4096
SAMPLED = 16
#: Leading code points that a bound keeps.
BOUND = 64
#: Words whose intervals are open at a time; words that a task counts before it passes them on.
TOGETHER = 4096
COUNTED = 400_000

ROUTED = "part int, word string, n long, member boolean"
BEST = "word string, n long, n_near long, best_n long, best string"


def counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word, n), n summed per task: words of a text, some without one code point."""

    def passed(held: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = defaultdict(int)
        for batch in batches:
            for doc, data in zip(batch.column(0), batch.column(1), strict=True):
                start = zlib.crc32(f"{'' if doc.as_py() is None else doc.as_py()}:".encode())
                for word, n in Counter(RUN.findall(data.as_py().translate(LOWER).decode(errors="replace"))).items():
                    size = len(word)
                    if size < SHORTEST:  # a deletion makes it shorter still
                        continue
                    h = zlib.crc32(word.encode(), start)
                    if h % MUTATED:
                        held[word] += n
                    elif size > SHORTEST:
                        held[word[: h % size] + word[h % size + 1 :]] += n
                if len(held) > COUNTED:
                    yield passed(held)
                    held.clear()
        yield passed(held)

    texts = docs.select(F.col(f"`{id_col}`").cast("string").alias("doc_id"), payload(f"`{text_col}`", "text"))
    return in_small_batches(texts).mapInArrow(run, "word string, n long")


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words that count, in the shared folder."""
    summed = counts(docs, id_col, text_col).groupBy("word").agg(F.sum("n").alias("n"))
    return written(summed.where(F.col("n") >= FEWEST), "vocabulary")


# ------------------------------------------------------------------------------------------
# Ranges of the sorted lists
# ------------------------------------------------------------------------------------------


def bounds_of(words: DataFrame) -> list[list[str]]:
    """First words of the ranges of the forward and of the reversed list, from a sample of
    at most about RANGES * SAMPLED words, chosen by hash."""
    total = words.count()
    ranges = min(RANGES, max(1, math.ceil(total / RANGE)))
    every = max(1, total // (ranges * SAMPLED))
    some = words.where(F.pmod(F.xxhash64("word"), F.lit(every)) == 0) if ranges > 1 else words.limit(0)
    some = [r[0] for r in some.select(F.substring("word", 1, BOUND)).collect()], [
        r[0] for r in some.select(F.substring(F.reverse("word"), 1, BOUND)).collect()
    ]
    cut = []
    for sample in map(sorted, some):
        at = [len(sample) * i // ranges for i in range(1, ranges)]
        cut.append(sorted({"", *(sample[i] for i in at if i < len(sample))}))
    return cut


def shared(a: str, b: str) -> str:
    n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[:n]


def dead_at(word: str, prefix: str) -> int:
    """Length of the shortest part of ``prefix`` that no beginning of ``word`` is within one
    edit of; 0 if there is none. Rows of three cells, as in :func:`stepped`."""
    a, b, c = 2, 0, 1
    for i, x in enumerate(prefix):
        was = word[i - 1] if 0 < i <= len(word) else ""
        here, then = word[i : i + 1], word[i + 1 : i + 2]
        a = min(a + (was != x), b + 1)
        b = min(b + (here != x), c + 1, a + 1) if here else 2
        c = min(c + (then != x), b + 1) if then else 2
        if min(a, b, c) > 1:
            return i + 1
    return 0


def reached(word: str, bounds: list[str]) -> list[int]:
    """Ranges that can hold a word near ``word`` with its first (len - 1) // 2 code points."""
    start = word[: (len(word) - 1) // 2]
    at, last = max(0, bisect_right(bounds, start) - 1), bisect_left(bounds, start + ABOVE) - 1
    found = []
    while at <= last:
        prefix = shared(bounds[at], bounds[at + 1]) if at + 1 < len(bounds) else ""
        dead = dead_at(word, prefix)
        if dead:  # all ranges inside that prefix are dead with it
            at = max(at + 1, bisect_right(bounds, prefix[:dead] + ABOVE) - 1)
        else:
            found.append(at)
            at += 1
    return found


def routed(words: DataFrame, bounds: list[list[str]]) -> DataFrame:
    """A row for each range that a word is a member of, or looks for near words in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, rows, own = [], [], []
            for i, word in enumerate(batch.column(0).to_pylist()):
                for turn, text in enumerate((word, word[::-1])):
                    home, first = bisect_right(bounds[turn], text) - 1, turn * len(bounds[0])
                    for at in {home, *reached(text, bounds[turn])}:
                        parts.append(first + at)
                        rows.append(i)
                        own.append(at == home)
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()), batch.column(0).take(taken), batch.column(1).take(taken), pa.array(own, pa.bool_())],
                names=["part", "word", "n", "member"],
            )

    return in_small_batches(words.select("word", "n")).mapInArrow(run, ROUTED)


# ------------------------------------------------------------------------------------------
# The scan of one range
# ------------------------------------------------------------------------------------------


class Words:
    """Words as one array of code points, without padding."""

    def __init__(self, words: list[str]):
        self.size = np.array([len(w) for w in words], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        # two code points that match nothing stand behind the last word
        self.points = np.concatenate([np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), np.zeros(2, np.uint32)])

    def at(self, which: np.ndarray, place: np.ndarray | int) -> np.ndarray:
        """Code points at a place; only meaningful where the word is long enough."""
        return self.points[np.minimum(self.start[which] + place, len(self.points) - 1)]


def common_prefixes(words: Words) -> np.ndarray:
    """Common prefix of each word with the one before it (of the first: -1)."""
    n = len(words.size)
    lcp = np.zeros(n, np.int64)
    lcp[:1] = -1
    open_, depth = np.arange(1, n), 0
    while len(open_):
        open_ = open_[np.minimum(words.size[open_], words.size[open_ - 1]) > depth]
        open_ = open_[words.at(open_, depth) == words.at(open_ - 1, depth)]
        depth += 1
        lcp[open_] = depth
    return lcp


def stepped(band: np.ndarray, asked: Words, which: np.ndarray, depth: int, point: np.ndarray) -> np.ndarray:
    """The next row of the matrices. ``band`` holds, for a prefix of ``depth`` code points, the
    distances to the word's prefixes of depth - 1, depth and depth + 1; 2 stands for more than 1."""
    a, b, c = band
    size = asked.size[which]
    a = np.minimum(a + (asked.at(which, depth - 1) != point), b + 1)
    a[depth > size] = 2
    new = np.minimum(np.minimum(b + (asked.at(which, depth) != point), c + 1), a + 1)
    new[depth + 1 > size] = 2
    c = np.minimum(c + (asked.at(which, depth + 1) != point), new + 1)
    c[depth + 2 > size] = 2
    return np.minimum(np.stack([a, new, c]), 2)


def near_in(members: list[str], words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (word, member) at exactly one edit that share the first (len(word) - 1) // 2 code
    points of the word; ``members`` are sorted and distinct."""
    listed, asked = Words(members), Words(words)
    lcp = common_prefixes(listed)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    opened = defaultdict(list)  # depth at which a word's scan starts: (word, first member, end)
    for i, word in enumerate(words):
        start = word[: (len(word) - 1) // 2]
        lo = bisect_left(members, start)
        hi = bisect_left(members, start + ABOVE, lo)
        if lo < hi:
            opened[len(start)].append((i, lo, hi))
    for depth, all_ in sorted(opened.items()):
        for first in range(0, len(all_), TOGETHER):
            scan(listed, lcp, asked, depth, np.array(all_[first : first + TOGETHER], np.int64), pairs)
    if not pairs:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def scan(listed: Words, lcp: np.ndarray, asked: Words, depth: int, opened: np.ndarray, pairs: list) -> None:
    """Scans the intervals of some words that share their first ``depth`` code points with them."""
    which, lo, hi = opened.T
    band = np.repeat(np.array([[1], [0], [1]]), len(which), axis=1)
    while len(which):
        ended = np.flatnonzero(listed.size[lo] == depth)  # the first of an interval may be its prefix
        over = asked.size[which[ended]] - depth
        fits = np.abs(over) <= 1
        ended, over = ended[fits], over[fits]
        hit = ended[band[over + 1, ended] == 1]
        pairs.append((which[hit], lo[hit]))
        lo = lo + (listed.size[lo] == depth)
        left = lo < hi
        which, lo, hi, band = which[left], lo[left], hi[left], band[:, left]
        # split where members differ at this depth
        splits = np.flatnonzero(lcp <= depth)
        a, b = np.searchsorted(splits, lo, "right"), np.searchsorted(splits, hi, "left")
        parts = b - a + 1
        of = np.repeat(np.arange(len(which)), parts)
        k = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
        if len(splits):
            starts = np.where(k == 0, lo[of], splits[np.clip(a[of] + k - 1, 0, len(splits) - 1)])
            ends = np.where(k == parts[of] - 1, hi[of], splits[np.clip(a[of] + k, 0, len(splits) - 1)])
        else:
            starts, ends = lo[of], hi[of]
        which, band = which[of], stepped(band[:, of], asked, which[of], depth, listed.at(starts, depth))
        alive = band.min(axis=0) <= 1 if len(which) else np.empty(0, bool)
        which, lo, hi, band = which[alive], starts[alive], ends[alive], band[:, alive]
        depth += 1


def leading(words: Words, a: np.ndarray, others: Words, b: np.ndarray, most: np.ndarray, backwards: bool) -> np.ndarray:
    """Whether words a and b share ``most`` code points at the beginning (of the words before reversal)."""
    same, depth = np.ones(len(a), bool), 0
    open_ = np.flatnonzero(most > 0)
    while len(open_):
        i, j = a[open_], b[open_]
        x = words.at(i, words.size[i] - 1 - depth) if backwards else words.at(i, depth)
        y = others.at(j, others.size[j] - 1 - depth) if backwards else others.at(j, depth)
        same[open_[x != y]] = False
        depth += 1
        open_ = open_[(x == y) & (most[open_] > depth)]
    return same


def near_of_range(group: pd.DataFrame, turned: bool) -> pd.DataFrame:
    """For the words of one range: how many near words it holds, and the commonest."""
    text = group["word"].tolist()
    if turned:
        text = [w[::-1] for w in text]
    group = group.assign(text=text).sort_values(["text"], kind="stable").reset_index(drop=True)
    own = np.flatnonzero(group["member"].to_numpy())
    text, n, word = group["text"].tolist(), group["n"].to_numpy(), group["word"].to_numpy(dtype=object)
    members = [text[i] for i in own]
    which, found = near_in(members, text)
    words, listed = Words(text), Words(members)
    half = np.minimum(words.size[which], listed.size[found]) // 2
    front = leading(words, which, listed, found, half, turned)
    keep = front != turned  # a pair that shares its first half belongs to the forward list
    which, found = which[keep], own[found[keep]]
    pairs = pd.DataFrame({"which": which, "best_n": n[found], "best": word[found]})
    pairs = pairs.sort_values(["which", "best_n", "best"], ascending=[True, False, True], kind="stable")
    top = pairs.drop_duplicates("which").set_index("which")
    often = pairs.groupby("which").size()
    rows = group.index[group["member"]] if not turned else group.index[:0]
    rows = rows.union(often.index)
    return pd.DataFrame({
        "word": word[rows], "n": n[rows], "n_near": often.reindex(rows).fillna(0).astype("int64").to_numpy(),
        "best_n": top["best_n"].reindex(rows).astype("Int64").to_numpy(), "best": top["best"].reindex(rows).astype(object).where(lambda s: s.notna(), None).to_numpy(),
    })


# ------------------------------------------------------------------------------------------
# Forms and roots
# ------------------------------------------------------------------------------------------


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, best, best_n) for every word of a vocabulary (word, n)."""
    bounds = bounds_of(words)
    forward = len(bounds[0])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return near_of_range(group, bool(group["part"].iloc[0] >= forward))

    found = routed(words, bounds).groupBy("part").applyInPandas(run, BEST)
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))).alias("best")
    summed = found.groupBy("word").agg(F.first("n").alias("n"), F.sum("n_near").alias("n_near"), best)
    return summed.select("word", "n", "n_near", F.col("best.best").alias("best"), (-F.col("best.less")).alias("best_n"))


def roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root) for the words that have a form (word, form). A form occurs TIMES as often
    as its word, so a chain has at most log(most) links; pointers are doubled."""
    links = max(1, math.ceil(math.log(max(most, 2) / FEWEST, TIMES)) + 1)
    now = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(links))):
        on = now.select(F.col("word").alias("root"), F.col("root").alias("then"))
        now = written(now.join(on, "root", "left").select("word", F.coalesce("then", "root").alias("root")), "roots")
    return now


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the vocabulary."""
    near = near_words(vocabulary(docs, id_col, text_col))
    is_form = F.col("best_n") >= TIMES * F.col("n")
    formed = written(
        near.select("word", F.when(is_form, F.col("best")).alias("form"), "n", "n_near", F.when(is_form, F.col("best_n")).alias("form_n")), "forms"
    )
    most = formed.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    rooted = formed.join(roots(formed.where(F.col("form").isNotNull()), most), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
