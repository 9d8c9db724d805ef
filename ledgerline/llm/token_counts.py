"""Token counts without token ids.

A sentencepiece model whose pieces never hold a blank or line feed after another
character can be cut before each run of blanks and each line feed without changing its
result. So: (1) each task counts its pre-tokens per document; (2) the distinct
pre-tokens of the whole corpus are tokenised once; (3) the counts are joined back to the
per-document frequencies and summed.

The join has two halves, so that no key is hot. The most frequent pre-tokens (at most
``COMMON`` of at most ``COMMON_BYTES`` bytes: a table bounded by parameters, whatever the
corpus) are broadcast and joined before the shuffle; every other pre-token is joined by
shuffle, and is rare by choice. Both halves are exact.

Defined results: null text = empty text = 0 tokens; documents that repeat an id are
counted row by row; other input columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import in_small_batches, map_batches, payload, written
from ledgerline.llm.importance import kth_largest

#: Rows of the broadcast half and their longest pre-token: 150,000 x 64 bytes at most.
COMMON = 150_000
COMMON_BYTES = 64
#: Distinct pre-tokens a task gathers before it passes their counts on.
GATHERED = 200_000
LIMIT = 4096


def cutter(model_file: str):
    """The function that cuts a text into pre-tokens, each with its leading blank or line feed.

    Cutting at line feeds needs a vocabulary without them; otherwise only blanks are used."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any("▁" in p.lstrip("▁") for p in pieces):
        raise ValueError("the model joins characters across blanks; its texts cannot be cut")
    lines = not any("\n" in p for p in pieces)
    pattern = re.compile(r" +[^ \n]*|\n[^ \n]*" if lines else r" +[^ ]*")

    def cut(text: str) -> list[str]:
        return pattern.findall(" " + text.replace("▁", " ")) if text else []

    return model, cut


def count_pieces(model, tokens: list[str]) -> list[int]:
    """Pieces of each pre-token. The model puts one blank before what it encodes: that is the
    pre-token's own blank, or for a line feed one piece too many."""
    texts = [t[1:] if t[0] == " " else t for t in tokens]
    encoded = model.encode(texts, num_threads=1)
    return [1 if t == " " else len(ids) - (t[0] != " ") for t, ids in zip(tokens, encoded, strict=True)]


def frequencies(docs: DataFrame, model_file: str, common) -> DataFrame:
    """(doc_id, _key, token, n, n_bytes): how often a row of the input has each pre-token that
    is not in the broadcast ``common``, and one row more, under a key that no pre-token has,
    with its size and the pieces of all its common pre-tokens."""

    def batch(rows: pa.RecordBatch, tools) -> dict[str, list]:
        known = common.value
        tokens: list[str] = []
        counts: list[int] = []
        sizes: list[int] = []
        n_bytes: list[int] = []
        for row, text in zip(rows.column("doc_id").to_pylist(), rows.column("_bytes").to_pylist(), strict=True):
            found = Counter(tools[1](text.decode("utf-8", "replace")))
            rest = [t for t in found if t not in known]
            tokens.append(f"row {row}")
            counts.append(sum(n * known[t] for t, n in found.items() if t in known))
            tokens += rest
            counts += map(found.__getitem__, rest)
            sizes.append(len(rest) + 1)
            n_bytes += [len(text)] + [0] * len(rest)
        at = np.repeat(np.arange(rows.num_rows), sizes)
        ids = {c: rows.column(c).take(pa.array(at)) for c in ("doc_id", "_key")}
        return ids | {"token": tokens, "n": counts, "n_bytes": n_bytes}

    schema = "doc_id long, _key long, token string, n long, n_bytes long"
    return map_batches(docs, batch, schema, lambda: cutter(model_file))


def vocabulary(docs: DataFrame, model_file: str) -> DataFrame:
    """(token, n, pieces) of every distinct pre-token of the corpus."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, cut = cutter(model_file)
        found: Counter = Counter()
        for rows in batches:
            for text in rows.column("_bytes").to_pylist():
                found.update(cut(text.decode("utf-8", "replace")))
                if len(found) > GATHERED:
                    yield as_batch(found)
                    found.clear()
        if found:
            yield as_batch(found)

    def as_batch(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"token": list(found), "n": list(found.values())},
            schema=pa.schema([("token", pa.string()), ("n", pa.int64())]),
        )

    def batch(rows: pa.RecordBatch, tools) -> dict[str, list]:
        return {
            "token": rows.column("token"),
            "n": rows.column("n"),
            "pieces": count_pieces(tools[0], rows.column("token").to_pylist()),
        }

    distinct = in_small_batches(docs).mapInArrow(gather, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return map_batches(distinct, batch, "token string, n long, pieces int", lambda: cutter(model_file))


def count_tokens(
    docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), payload(text_col)).withColumn(
        "_key", F.xxhash64("_bytes")
    )
    words = written(vocabulary(source, model_file), "token-vocabulary")
    short = words.where(F.octet_length("token") <= COMMON_BYTES)
    # By a threshold, so that no more than these rows go to the driver.
    if short.count() > COMMON:
        short = short.where(F.col("n") > kth_largest(short, "n", COMMON))
    top = short.select("token", "pieces").collect()
    common = docs.sparkSession.sparkContext.broadcast({r.token: r.pieces for r in top})

    used = frequencies(source, model_file, common).join(words.select("token", "pieces"), "token", "left")
    # Equal rows share a key: their sums are divided again, and each gets its own row.
    totals = used.groupBy("doc_id", "_key").agg(
        F.max("n_bytes").alias("n_bytes"),
        F.count_if(F.col("pieces").isNull()).alias("copies"),
        F.sum(F.col("n") * F.coalesce("pieces", F.lit(1))).alias("tokens"),
    )
    n_tokens = F.expr("tokens div copies")
    return totals.select(
        "doc_id",
        "n_bytes",
        n_tokens.alias("n_tokens"),
        (n_tokens > limit).alias("over_limit"),
        F.explode(F.expr("array_repeat(0, int(copies))")).alias("_copy"),
    ).drop("_copy")
