"""Problem 3: keep one copy of each message, with exact quotient hash tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skysift.operators.spread import spread, width
from skysift.session import materialize

#: 64-bit words of a fixed-width identifier: the number of what came before, bytes, a mark.
WORDS = 8
#: Bytes of an identifier that one fixed-width entry holds.
PIECE = WORDS * 8 - 10
#: Identifiers that one task's table holds, about: some 150 MB.
PER_TASK = 1_000_000
_MORE = 0xFFFF
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


class Identifiers:
    """Identifiers (stream, key) of a batch, to be cut into fixed-width entries.

    The bytes are ``length of stream (4 bytes), stream, key``: no two different pairs share
    them. An entry is ``number of the entry before (8 bytes), PIECE bytes, mark (2 bytes)``;
    the mark is the length of the last piece, or says that more follows. Entries that differ
    in anything differ as identifiers, whatever their length.
    """

    def __init__(self, stream: pa.Array, key: pa.Array) -> None:
        n = len(stream)
        parts = []
        for a in (stream, key):
            a = a.cast(pa.large_binary())
            _, off, data = a.buffers()
            off = np.frombuffer(off, np.int64)[a.offset : a.offset + n + 1] if n else np.zeros(1, np.int64)
            parts.append((off, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), np.diff(off)))
        self.size = parts[0][2] + parts[1][2] + 4
        self.to = np.concatenate([[0], np.cumsum(self.size)])
        self.flat = np.zeros(self.to[-1], np.uint8)
        for k in range(4):
            self.flat[self.to[:-1] + k] = parts[0][2] >> (8 * k) & 255
        begin = self.to[:-1] + 4
        for off, data, length in parts:
            within = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            self.flat[np.repeat(begin, length) + within] = data[np.repeat(off[:-1], length) + within]
            begin = begin + length
        self.pieces = -(-self.size // PIECE)

    def entries(self, level: int, rows: np.ndarray, before: np.ndarray) -> np.ndarray:
        """The entries of piece ``level`` of some rows, as rows of WORDS 64-bit words."""
        out = np.zeros((len(rows), WORDS * 8), np.uint8)
        length = np.minimum(PIECE, self.size[rows] - level * PIECE)
        within = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        out[np.repeat(np.arange(len(rows)), length), 8 + within] = self.flat[np.repeat(self.to[rows] + level * PIECE, length) + within]
        mark = np.where(self.pieces[rows] > level + 1, _MORE, length)
        out[:, -2], out[:, -1] = mark & 255, mark >> 8
        words = out.view("<u8")
        words[:, 0] = before
        return words

    def homes(self) -> np.ndarray:
        """A number of each whole identifier, the same wherever it stands: its quotient, in 31 bits."""
        rows, home = np.arange(len(self.size)), np.zeros(len(self.size), np.uint64)
        level = 0
        while len(rows):
            home[rows] = permute(self.entries(level, rows, home[rows]))[:, 0]
            level += 1
            rows = rows[self.pieces[rows] > level]
        return (home >> np.uint64(33)).astype(np.int64)


def permute(words: np.ndarray) -> np.ndarray:
    """A bijection of fixed-width entries (Feistel steps along the words): nothing is lost."""
    w = words.copy()
    n = w.shape[1]
    with np.errstate(over="ignore"):
        for k, odd in enumerate(_ODD):
            for i in range(n):
                x = w[:, i - 1] * np.uint64(odd) + np.uint64(i + k)
                x ^= x >> np.uint64(29)
                x *= np.uint64(_ODD[1])
                x ^= x >> np.uint64(32)
                w[:, i] ^= x
    return w


class QuotientTable:
    """Open-addressed table of permuted fixed-width entries, each with a number of its own.

    The quotient (high bits of the first word) names the home slot; the slot stores all words,
    that is the complete remainder, so a match is never false. Inserting is done for whole
    batches: one probe step for all pending entries at a time. An identifier of several pieces
    is a chain: each entry holds the number of the one before, so its last entry is new
    exactly if the identifier is.
    """

    def __init__(self, bits: int = 12) -> None:
        self.bits, self.used = bits, 0
        self.slots, self.full, self.number = np.zeros((1 << bits, WORDS), np.uint64), np.zeros(1 << bits, bool), np.zeros(1 << bits, np.int64)

    def _place(self, w: np.ndarray, numbers: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        mask = np.int64((1 << self.bits) - 1)
        at = (w[:, 0] >> np.uint64(64 - self.bits)).astype(np.int64)
        number, new, todo = np.zeros(len(w), np.int64), np.zeros(len(w), bool), np.arange(len(w))
        while len(todo):
            slot = at[todo]
            _, first = np.unique(slot, return_index=True)
            claims = todo[first[~self.full[slot[first]]]]  # the earliest row wins a free slot
            self.slots[at[claims]], self.full[at[claims]], new[claims] = w[claims], True, True
            self.number[at[claims]] = numbers[claims] if numbers is not None else self.used + 1 + np.arange(len(claims))
            self.used += len(claims)
            same = (self.slots[slot] == w[todo]).all(axis=1)
            number[todo[same]] = self.number[slot[same]]
            todo = todo[~same]
            at[todo] = (at[todo] + 1) & mask
        return number, new

    def insert(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each entry, and whether it was neither in the table nor earlier in ``w``."""
        while self.used + len(w) > (1 << self.bits) * 0.6:
            old, numbers, used = self.slots[self.full], self.number[self.full], self.used
            self.__init__(self.bits + 1)
            self._place(old, numbers)
            self.used = used
        return self._place(w)

    def first_seen(self, ids: Identifiers) -> np.ndarray:
        """True for each identifier that was neither in the table nor earlier in the batch."""
        rows, number, new = np.arange(len(ids.size)), np.zeros(len(ids.size), np.int64), np.zeros(len(ids.size), bool)
        level = 0
        while len(rows):
            number[rows], new[rows] = self.insert(permute(ids.entries(level, rows, number[rows].astype(np.uint64))))
            level += 1
            rows = rows[ids.pieces[rows] > level]
        return new


def _order(b: pa.RecordBatch) -> pa.Array:
    return pc.sort_indices(b, sort_keys=[("at_us", "ascending"), ("row_id", "ascending")])


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: rows beaten by a smaller row of the same message are surplus already."""
    for b in batches:
        if b.num_rows:
            b = b.take(_order(b))
            ids = Identifiers(b.column(0), b.column(1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(~QuotientTable().first_seen(ids)), pa.array(ids.homes())], [*b.schema.names, "surplus", "shard"])


def _global(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a shard in order of (at_us, row_id): the first of each message is kept."""
    table = QuotientTable()
    for b in batches:
        if b.num_rows:
            new = table.first_seen(Identifiers(b.column(0), b.column(1)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(~new)], [*b.schema.names, "surplus"])


def mark_surplus(rows: DataFrame, *carried: str) -> DataFrame:
    """Mark all but the first row of each message.

    ``rows(stream_name, dedupe_key, at_us, row_id)``; a message is (stream_name, dedupe_key),
    its first row the one with the smallest (at_us, row_id). Adds ``surplus boolean``; columns
    named in ``carried`` are kept, others dropped.

    A first quotient table per input batch finds rows beaten locally; what it leaves of each
    message, one candidate a batch, is written with them to the shared folder. Only candidates
    are shuffled, by quotient shard: shards are as many as bound a task's table, whatever the
    session's width. They are sorted and inserted once. Identifiers of any length take the same
    way, as chains of fixed-width entries.

    Null stream or key: equal to the empty string. Null at_us sorts last, then by row_id; rows
    equal in all four columns are copies and one is kept. Empty input gives no rows.
    """
    empty = F.lit("")
    plain = rows.select(F.coalesce("stream_name", empty).alias("stream_name"), F.coalesce("dedupe_key", empty).alias("dedupe_key"), F.col("at_us").cast("long").alias("at_us"), F.coalesce(F.col("row_id").cast("long"), F.lit(0).cast("long")).alias("row_id"), *carried)
    marked = T.StructType([*plain.schema.fields, T.StructField("surplus", T.BooleanType())])
    local = materialize(spread(plain, "row_id").mapInArrow(_local, T.StructType([*marked.fields, T.StructField("shard", T.LongType())])), "deliveries")
    open_ = local.where("not surplus").drop("surplus")
    tasks = max(width(rows), -(-open_.count() // PER_TASK))
    last = open_.repartition(tasks, "shard").sortWithinPartitions(F.col("at_us").asc_nulls_last(), "row_id").drop("shard").mapInArrow(_global, marked)
    return last.unionByName(local.where("surplus").drop("shard"))
