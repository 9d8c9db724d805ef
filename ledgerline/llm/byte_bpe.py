"""Byte-level BPE encoding and decoding over padded numpy matrices.

Texts are split by the vocabulary's pattern; the distinct pieces of an Arrow batch are
grouped into buckets of like length and encoded together, one padded matrix per bucket.
In every round each row merges its leftmost pair of minimum rank; that shortens every
row by one column, and rows without a pair left are taken out of the matrix. Pairs are
looked up in an open-addressing hash table. Encoded pieces are kept per task, so a piece
is merged about once a task however often it occurs.

Defined results: null text = empty text = no ids; equal rows give equal rows; columns of
the input other than the id and the text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_batches, payload

NO_RANK = np.int32(2**31 - 1)
#: Longest piece that goes into a matrix; longer ones merge all equal pairs of a round at once.
MATRIX_WIDTH = 256
#: Cells of one matrix; bounds memory.
MATRIX_CELLS = 1 << 20
#: Encoded pieces a task keeps; a full store is emptied (pieces are then encoded again).
KEPT_PIECES = 250_000

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: base64 token, blank, rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PairTable:
    """Open-addressing hash table from a pair of ids to the id of their join, probed for
    whole arrays at a time."""

    def __init__(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray):
        self.bits = max(4, int(len(left) * 3).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NO_RANK, np.int32)
        todo = (left.astype(np.int64) << 32) | right
        values, slots = joined.astype(np.int32), self._home((left.astype(np.int64) << 32) | right)
        while len(todo):
            free = self.keys[slots] == -1
            self.keys[slots[free]] = todo[free]  # of several keys for one slot the last one stays
            won = self.keys[slots] == todo
            self.values[slots[won]] = values[won]
            todo, values, slots = todo[~won], values[~won], (slots[~won] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, NO_RANK where there is none (also for padding, -1)."""
        shape = left.shape
        keys = ((left.astype(np.int64) << 32) | right.astype(np.int64)).ravel()
        keys[((left < 0) | (right < 0)).ravel()] = -2
        slots = self._home(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.values[slots], NO_RANK)
        open_ = np.flatnonzero((found != keys) & (found != -1) & (keys != -2))
        slots = slots[open_]
        while len(open_):
            slots = (slots + 1) & ((1 << self.bits) - 1)
            found, wanted = self.keys[slots], keys[open_]
            hit = found == wanted
            out[open_[hit]] = self.values[slots[hit]]
            go_on = ~hit & (found != -1)
            open_, slots = open_[go_on], slots[go_on]
        return out.reshape(shape)


class ByteBPE:
    """Encoder and decoder for one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        # The pattern's \s means Unicode white space only; spelled out, as this module's \s is wider.
        white = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
        pattern = pattern.replace(r"[^\s", f"[^{white}").replace(r"\S", f"[^{white}]").replace(r"\s", f"[{white}]")
        self.split = regex.compile(pattern).findall
        self.ranks = ranks
        self.token = dict(zip(ranks.values(), ranks.keys(), strict=True))
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (ranks[t[:i]], ranks[t[i:]], r)
            for t, r in ranks.items()
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        ]
        self.pairs = PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T)
        self.kept: dict[str, bytes] = {}

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of every piece, each merged on its own."""
        out: list[np.ndarray] = [None] * len(pieces)  # type: ignore[list-item]
        order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
        start = 0
        while start < len(order):
            shortest = len(pieces[order[start]])
            if shortest > MATRIX_WIDTH:
                out[order[start]] = self._merge_long(self.byte_id[np.frombuffer(pieces[order[start]], np.uint8)])
                start += 1
                continue
            end, most = start, shortest + shortest // 8
            while end < len(order) and len(pieces[order[end]]) <= most and (end - start) * most < MATRIX_CELLS:
                end += 1
            rows = order[start:end]
            for i, ids in zip(rows, self._merge_matrix([pieces[i] for i in rows]), strict=True):
                out[i] = ids
            start = end
        return out

    def _merge_matrix(self, pieces: list[bytes]) -> list[np.ndarray]:
        width = len(pieces[-1])
        lengths = np.array([len(p) for p in pieces])
        ids = np.full((len(pieces), max(width, 1)), -1, np.int32)
        inside = np.arange(ids.shape[1]) < lengths[:, None]
        ids[inside] = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        done: list[np.ndarray] = [None] * len(pieces)  # type: ignore[list-item]
        rows = np.arange(len(pieces))
        ranks = self.pairs(ids[:, :-1], ids[:, 1:])
        while True:
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            best = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), NO_RANK)
            active = best != NO_RANK
            if not active.all():  # compaction
                for row, left in zip(rows[~active], ids[~active], strict=True):
                    done[row] = left[left >= 0]
                rows, ids, ranks, at, best = (x[active] for x in (rows, ids, ranks, at, best))
            if not len(rows):
                return done
            here, n = np.arange(len(rows)), ids.shape[1]
            ids[here, at] = best
            stays = np.ones(ids.shape, bool)
            stays[here, at + 1] = False
            ids = ids[stays].reshape(len(rows), n - 1)
            stays = np.ones(ranks.shape, bool)
            stays[here, at] = False
            ranks = ranks[stays].reshape(len(rows), n - 2)
            for side in (at - 1, at):  # the pairs that end and begin with the new id
                ok = (side >= 0) & (side < n - 2)
                i, j = here[ok], side[ok]
                ranks[i, j] = self.pairs(ids[i, j], ids[i, j + 1])

    def _merge_long(self, ids: np.ndarray) -> np.ndarray:
        """One row alone: a round merges every pair of minimum rank from left to right, unless
        that would make a pair of lower rank on the way; then only the leftmost."""
        ranks = self.pairs(ids[:-1], ids[1:])
        while len(ranks) and (best := ranks.min()) != NO_RANK:
            at = np.flatnonzero(ranks == best)
            run = np.concatenate(([True], np.diff(at) > 1))
            first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]  # equal pairs that overlap
            nearby = self.pairs(np.array([best]), ids[at[:1]])[0]
            for chosen in (at, at[:1]):
                new = ids.copy()
                new[chosen] = best
                new = np.delete(new, chosen + 1)
                left = np.delete(ranks, chosen)
                moved = chosen - np.arange(len(chosen))
                touched = np.concatenate((moved - 1, moved))
                touched = touched[(touched >= 0) & (touched < len(left))]
                left[touched] = self.pairs(new[touched], new[touched + 1])
                if nearby > best and (not len(touched) or left[touched].min() > best):
                    break
            ids, ranks = new, left
        return ids

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of every text, as little-endian unsigned 32-bit integers."""
        split = [self.split(t) for t in texts]
        if len(self.kept) > KEPT_PIECES:
            self.kept.clear()
        new = list({p for pieces in split for p in pieces}.difference(self.kept))
        for piece, ids in zip(new, self.encode_pieces([p.encode() for p in new]), strict=True):
            self.kept[piece] = ids.astype("<u4").tobytes()
        get = self.kept.__getitem__
        return [b"".join(map(get, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row a document: id, ids (array of int) and the bytes they decode to. Texts are
    encoded whole. ``ranks_path`` is a file that every executor has."""
    schema = "doc_id long, ids array<int>, decoded binary"

    def batch(rows: pa.RecordBatch, bpe: ByteBPE) -> dict[str, list]:
        encoded = bpe.encode(t.decode("utf-8", "replace") for t in rows.column("_bytes").to_pylist())
        return {
            "doc_id": rows.column("doc_id"),
            "ids": [np.frombuffer(x, "<u4").astype(np.int32) for x in encoded],
            "decoded": [bpe.decode(x) for x in encoded],
        }

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), payload(text_col))
    return map_batches(source, batch, schema, lambda: ByteBPE(load_ranks(ranks_path), pattern))


def digest_documents(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Like ``encode_documents``, with counts and SHA-256 digests in place of ids and bytes."""

    def batch(rows: pa.RecordBatch, bpe: ByteBPE) -> dict[str, list]:
        encoded = bpe.encode(t.decode("utf-8", "replace") for t in rows.column("_bytes").to_pylist())
        return {
            "doc_id": rows.column("doc_id"),
            "n_tokens": [len(x) // 4 for x in encoded],
            "ids_sha256": [hashlib.sha256(x).hexdigest() for x in encoded],
            "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in encoded],
        }

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), payload(text_col))
    return map_batches(source, batch, SCHEMA, lambda: ByteBPE(load_ranks(ranks_path), pattern))
