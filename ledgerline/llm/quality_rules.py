"""Quality rules, line first, in DataFrame functions only.

Every line with a word is judged on its own; a line fails by one of these rules:

* punctuation: many symbols or exclamation marks for its words, or many words without any
  sentence punctuation;
* navigation: mostly separators such as ``|`` between short items;
* boilerplate: mostly capitals over several words, or a short line with a stock phrase.

Failed lines are removed. A document is rejected if it fails the base rules (fewer than
MIN_WORDS words, or over MAX_REPEATED percent of its words in repeated 5-word windows),
or if removal takes more than MAX_LOST percent of its word characters.

Defined results: null text = empty text = no words, rejected by the base rules; equal rows
give equal rows; other columns are ignored, or passed on by ``clean``. Nothing here is
shuffled; all work is inside a row, and at most n log n in its words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACE_CLASS

MIN_WORDS = 10
WINDOW = 5
MAX_REPEATED = 20
MAX_LOST = 30
SYMBOLS = "#*$%&|<>"
#: Word separators without the line feed, for lines.
BLANKS = " \t\x0b\x0c\r"
SEPARATORS = "|•›»·"
SENTENCE_MARKS = r"[.!?…,;:。！？，、；：]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ"
LOWER = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýß"
STOCK_PHRASES = (
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "log in to",
    "privacy policy",
    "read more",
    "share this",
    "sign up for",
    "subscribe to",
    "terms of use",
)
STOCK_WORDS = 15


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def count_chars(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def repeated_words(words: Column) -> Column:
    """Words in windows found twice or more, each counted once."""

    def covered(windows: Column) -> Column:
        by_hash = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            def twice(x: Column, k: Column) -> Column:
                before, after = F.get(s, k - 1), F.get(s, k + 1)
                same = F.coalesce(before["h"] == x["h"], F.lit(False)) | F.coalesce(after["h"] == x["h"], F.lit(False))
                return F.when(same, x["i"])

            return F.sort_array(F.array_compact(F.transform(s, twice)))

        def step(acc: Column, at: Column) -> Column:
            added = F.least(F.lit(WINDOW), at - acc["last"])
            return F.struct((acc["n"] + added).alias("n"), at.alias("last"))

        none = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(let(by_hash, starts), none, step, lambda acc: acc["n"])

    def windows(hashes: Column) -> Column:
        first = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        made = F.transform(first, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))
        return F.when(F.size(hashes) >= WINDOW, made)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    found = let(
        let(hashes, windows),
        lambda w: F.when(w.isNull() | (F.size(F.array_distinct(w)) == F.size(w)), F.lit(0)).otherwise(covered(w)),
    )
    return F.coalesce(found, F.lit(0)).cast("long")


def duplicates(lines: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    worded = F.transform(F.filter(lines, lambda x: x["worded"]), lambda x: x["line"])
    return let(worded, lambda w: F.size(w) - F.size(F.array_distinct(w))).cast("long")


def line_fails(line: Column) -> Column:
    """Whether a line with at least one word fails a rule."""
    words = F.regexp_count(line, F.lit(f"[^{SPACE_CLASS[1:]}+"))
    upper, lower = count_chars(line, UPPER), count_chars(line, LOWER)
    symbols = count_chars(line, SYMBOLS)
    separators = count_chars(line, SEPARATORS)
    marks = count_chars(line, "!")

    def judge(n: Column) -> Column:
        punctuation = (
            ((symbols >= 3) & (symbols * 5 >= n))
            | ((marks >= 3) & (marks * 3 >= n))
            | ((n >= 20) & ~line.rlike(SENTENCE_MARKS))
        )
        navigation = (separators >= 2) & (separators * 3 >= n)
        phrase = F.lit(False)
        for p in STOCK_PHRASES:
            phrase = phrase | F.lower(line).contains(p)
        boilerplate = ((n >= 4) & (upper > 3 * lower)) | ((n <= STOCK_WORDS) & phrase)
        return punctuation | navigation | boilerplate

    return let(words, judge)


def judged(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``_q``: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, and the text left after line removal."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    words = F.array_remove(F.split(text, SPACE_CLASS + "+"), "")

    def with_verdict(line: Column) -> Column:
        worded = F.translate(line, BLANKS, "") != ""
        return F.struct(line.alias("line"), worded.alias("worded"), (worded & line_fails(line)).alias("fails"))

    lines = F.transform(F.split(text, "\n"), with_verdict)
    measures = F.struct(
        let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("again"))).alias("words"),
        F.length(F.translate(text, BLANKS + "\n", "")).cast("long").alias("word_chars"),
        count_chars(text, SYMBOLS).cast("long").alias("n_symbols"),
        let(lines, lambda ls: F.struct(duplicates(ls).alias("dup"), ls.alias("all"))).alias("lines"),
    )
    # Through a generator: a filter on the verdict is not pushed below it, which would measure twice.
    first = docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.array(measures)).alias("_m"))
    m = F.col("_m")
    failed = F.filter(m["lines"]["all"], lambda x: x["fails"])
    n_words, again = m["words"]["n"], m["words"]["again"]
    lost = F.aggregate(
        failed, F.lit(0).cast("long"), lambda a, x: a + F.length(F.translate(x["line"], BLANKS, ""))
    )
    base_failed = (n_words < MIN_WORDS) | (again * 100 > n_words * MAX_REPEATED)
    stays = F.filter(m["lines"]["all"], lambda x: ~x["fails"])
    left = F.array_join(F.transform(stays, lambda x: x["line"]), "\n")
    return first.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.struct(
            n_words.alias("n_words"),
            m["word_chars"].alias("word_chars"),
            m["n_symbols"].alias("n_symbols"),
            m["lines"]["dup"].alias("n_dup_lines"),
            again.alias("n_repeat_words"),
            base_failed.alias("base_failed"),
            (~base_failed & (lost * 100 <= m["word_chars"] * MAX_LOST)).alias("kept"),
            left.alias("left"),
        ).alias("_q"),
    )


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: its id, the counts, base_failed and kept."""
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return judged(source).select("doc_id", "_q.*").drop("left")


def clean(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The documents that are kept, without their failed lines; a text without failed lines
    stays as it is. ``length_col``, if there, gets the new number of code points."""
    # The marker column must not meet a column of the input.
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    kept = judged(plain, at[text_col]).where("_q.kept")
    new = {at[text_col]: F.when(F.col(at[text_col]).isNotNull(), F.col("_q.left"))}
    if length_col in at:
        new[at[length_col]] = F.length("_q.left").cast(docs.schema[length_col].dataType)
    kept = kept.select(*[new.get(c, F.col(c)).alias(c) for c in plain.columns])
    return kept.toDF(*docs.columns)
