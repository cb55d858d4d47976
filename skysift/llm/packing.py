"""Problem 8: fill containers of fixed capacity (bounded-space online best-fit)."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.operators.spread import spread
from skysift.session import materialize

CAPACITY = 2048
#: Open containers of one packing task.
OPEN = 1024
#: Pieces that one task packs, about.
PER_TASK = 1_000_000


def tokenizer_files() -> tuple[str, str]:
    """Vocabulary file and split pattern of the public byte-level BPE with 50k tokens."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _count(vocabulary, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.value.splitlines())}
        encoding = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            sizes = [len(encoding.encode_ordinary(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64())], ["item", "size"])

    return run


def token_counts(texts: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(item, size): tokens of the whole text of ``texts(item long, text string)``; null text: 0.

    The driver reads the vocabulary file (a few megabytes) and sends it; executors need no copy.
    """
    with open(vocabulary, "rb") as f:
        sent = texts.sparkSession.sparkContext.broadcast(f.read())
    return spread(texts.select("item", F.coalesce("text", F.lit("")).alias("text")), "item").mapInArrow(_count(sent, pattern), "item long, size long")


class BestFit:
    """Open containers in a bitset by free space; best fit is its lowest set bit >= the size."""

    def __init__(self, capacity: int, most: int) -> None:
        self.capacity, self.most, self.open, self.made, self.bits = capacity, most, 0, 0, 0
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, size: int) -> int:
        """The container that takes an item of 1 .. capacity units."""
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            stack = self.at[free]
            number = stack.pop()
            if not stack:
                self.bits ^= 1 << free
            self.open -= 1
        else:
            if self.open >= self.most:
                fullest = (self.bits & -self.bits).bit_length() - 1
                self.at[fullest].pop()
                if not self.at[fullest]:
                    self.bits ^= 1 << fullest
                self.open -= 1
            free, number = self.capacity, self.made
            self.made += 1
        left = free - size
        if left:
            self.at[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number

    def left(self) -> dict[int, int]:
        """Containers still open, with their free space."""
        return {n: free for free, stack in enumerate(self.at) for n in stack}


def _pack(capacity: int, most: int):
    """Adds the container of each piece, and at the end one row per container left open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, names = TaskContext.get().partitionId(), ["item", "piece", "size", "bin", "left"]
        fit = BestFit(capacity, most)
        for b in batches:
            put = [fit.put(s) for s in b.column(2).to_pylist()]
            bins = (np.array(put, np.int64) + (part << 40)) if put else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(bins), pa.nulls(len(put), pa.int64())], names)
        left = fit.left()
        if left:
            bins = np.fromiter(left, np.int64) + (part << 40)
            none = pa.nulls(len(left), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array(bins), pa.array(list(left.values()), pa.int64())], names)

    return run


def _spread(df: DataFrame, count: int, *keys: str) -> DataFrame:
    """Tasks of about PER_TASK rows in an order that does not depend on how rows arrive."""
    n = max(1, -(-count // PER_TASK))
    mixed = F.xxhash64(*keys)
    return df.repartition(n, mixed).sortWithinPartitions(mixed, *keys)


def pack(items: DataFrame, capacity: int = CAPACITY, most: int = OPEN) -> DataFrame:
    """Containers of ``items(item long, size long)``.

    Columns: item, piece, begin, end (units of the item, end excluded), size, container.

    An item larger than the capacity is split into full pieces and a rest; no other is. Tasks
    pack their pieces online with at most ``most`` open containers, the fullest closing first
    when another is needed. What the tasks leave open is packed once more, container by
    container as if it were an item, so that tasks do not leave half-empty containers.

    Items of size 0 or null need no room and are left out; so are null items. Repeated items
    are items of their own. Empty input gives no rows.
    """
    sized = items.select("item", "size").where("item is not null and size > 0")
    whole = F.floor(F.col("size") / capacity).cast("long")
    pieces = sized.select("item", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("size") / capacity) - 1)).alias("piece"))
    pieces = pieces.select("item", "piece", F.when(F.col("piece") < whole, F.lit(capacity)).otherwise(F.col("size") - whole * capacity).cast("long").alias("size"))
    pieces = materialize(pieces, "pieces")
    packed = materialize(_spread(pieces, pieces.count(), "item", "piece").mapInArrow(_pack(capacity, most), "item long, piece long, size long, bin long, left long"), "packed")
    bundles = packed.where("left is not null").select(F.col("bin").alias("item"), F.lit(0).cast("long").alias("piece"), (capacity - F.col("left")).alias("size"))
    again = _spread(bundles, bundles.count(), "item", "piece").mapInArrow(_pack(capacity, most), "item long, piece long, size long, bin long, left long")
    moved = again.where("left is null").select(F.col("item").alias("bin"), F.col("bin").alias("to"))
    placed = packed.where("left is null").drop("left").join(moved, "bin", "left")
    container = F.when(F.col("to").isNull(), F.concat(F.lit("a"), F.hex("bin"))).otherwise(F.concat(F.lit("b"), F.hex("to")))
    begin = F.col("piece") * capacity
    return placed.select("item", "piece", begin.alias("begin"), (begin + F.col("size")).alias("end"), "size", container.alias("container"))
