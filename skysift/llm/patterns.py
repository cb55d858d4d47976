"""Problem 2: ordered patterns that many sequences hold (prefix-projected pattern growth)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.operators.spread import spread, width
from skysift.session import materialize

#: Tokens of one bucket of sequences, about: what one task projects at once.
BUCKET_TOKENS = 2_000_000
#: An entity with more different sequences than this is spread over the buckets.
HOT_SEQUENCES = 10_000

FOUND = "pattern array<int>, support long, entity string"


def _encode(letters: list[str]):
    """Token lists as 4-byte codes of the letters; other tokens are left out."""
    known = pa.array(letters, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            code = pc.index_in(lists.flatten(), value_set=known).to_numpy(zero_copy_only=False)
            to = np.asarray(lists.offsets, np.int64) - lists.offsets[0].as_py()
            kept = ~np.isnan(code) if code.dtype.kind == "f" else np.ones(len(code), bool)
            to = 4 * np.concatenate([[0], np.cumsum(kept)])[to]
            data = code[kept].astype("<i4").tobytes()
            out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(b), [None, pa.py_buffer(to.astype(np.int64).tobytes()), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([b.column(0), out.cast(pa.binary())], ["entity", "codes"])

    return run


def _flat(codes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all sequences one after the other, and where each begins."""
    if isinstance(codes, pa.ChunkedArray):
        codes = codes.combine_chunks()
    codes = codes.cast(pa.large_binary())
    _, off, buf = codes.buffers()
    off = np.frombuffer(off, np.int64)[codes.offset : codes.offset + len(codes) + 1] if len(codes) else np.zeros(1, np.int64)
    raw = np.frombuffer(buf, np.uint8)[off[0] : off[-1]] if buf is not None else np.zeros(0, np.uint8)
    return np.frombuffer(raw.tobytes(), "<i4"), (off - off[0]) // 4


def _project(letters: int, drop_empty: bool):
    """Each sequence on each of its tokens: what follows the token's first place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, to = _flat(b.column(0))
            row = np.repeat(np.arange(len(b)), np.diff(to))
            _, first = np.unique(row * letters + flat, return_index=True)
            begin, end = first + 1, to[row[first] + 1]
            some = (end > begin) | (not drop_empty)
            first, begin, end = first[some], begin[some], end[some]
            size = end - begin
            cut = np.concatenate([[0], np.cumsum(size)])
            data = flat[np.arange(cut[-1]) - np.repeat(cut[:-1] - begin, size)].astype("<i4").tobytes()
            suffix = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer((4 * cut).tobytes()), pa.py_buffer(data)])
            take = pa.array(row[first])
            yield pa.RecordBatch.from_arrays([pa.array(flat[first], pa.int32()), suffix.cast(pa.binary()), *(c.take(take) for c in b.columns[1:])], ["root", "suffix", *b.schema.names[1:]])

    return run


class Projection:
    """The suffixes of one prefix token in one bucket, with places of every token.

    A longer prefix is a list of rows and of pointers into their suffixes; growing it by a
    token moves the pointers of the rows that still hold it. Nothing is copied or walked again.
    """

    def __init__(self, shard: pa.Table) -> None:
        names, self.entities = np.full(shard.num_rows, -1), []
        entity = shard.column("entity").combine_chunks()
        if entity.null_count < len(entity):
            d = entity.dictionary_encode()
            self.entities = d.dictionary.to_pylist()
            names = pc.fill_null(d.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.argsort(names, kind="stable")
            shard, names = shard.take(pa.array(order)), names[order]
        flat, to = _flat(shard.column("suffix"))
        self.flat, self.begin, self.end, self.entity = flat, to[:-1], to[1:], names
        self.weight = np.where(names < 0, shard.column("weight").to_numpy(), 0)
        self.hot = shard.column("hot").to_numpy(zero_copy_only=False) if self.entities else None
        order = np.argsort(flat, kind="stable")
        self.letters, cut = np.unique(flat[order], return_index=True)
        self.places = {int(t): np.append(p, len(flat)) for t, p in zip(self.letters, np.split(order, cut[1:]))}

    def grown(self, rows: np.ndarray, at: np.ndarray, letter: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that hold the letter from their pointer on, with the pointers behind it."""
        places = self.places[letter]
        found = places[np.searchsorted(places[:-1], at)]
        held = found < self.end[rows]
        return rows[held], found[held] + 1

    def support(self, rows: np.ndarray) -> tuple[int, np.ndarray]:
        """How many entities the rows stand for, and which of them are hot (these are not counted)."""
        total = int(self.weight[rows].sum())
        if not self.entities:
            return total, rows[:0]
        e = self.entity[rows]
        first = (e >= 0) & np.append(True, e[1:] != e[:-1])
        hot = first & self.hot[rows]
        return total + int(first.sum() - hot.sum()), e[hot]


def _results(found: list) -> pa.Table:
    pattern, support, entity = zip(*found) if found else ((), (), ())
    return pa.table({"pattern": pa.array(pattern, pa.list_(pa.int32())), "support": pa.array(support, pa.int64()), "entity": pa.array(entity, pa.string())})


def _grow(least: float, max_len: int):
    """All patterns that begin with a shard's token and are frequent in its bucket."""

    def run(key: tuple[pa.Scalar, ...], shard: pa.Table) -> pa.Table:
        p, found = Projection(shard), []

        def visit(prefix: tuple[int, ...], rows: np.ndarray, at: np.ndarray, letters: list[int]) -> None:
            grown = {}
            for t in letters:
                r, a = p.grown(rows, at, t)
                support, hot = p.support(r)
                if support + len(hot) >= least:
                    found.append(((*prefix, t), support + len(hot), None))
                    grown[t] = r, a
            if len(prefix) + 1 < max_len:
                # what does not follow a prefix often does not follow a longer one often
                for t, (r, a) in grown.items():
                    visit((*prefix, t), r, a, list(grown))

        rows = np.arange(len(p.begin))
        support, hot = p.support(rows)
        found.append(((key[0].as_py(),), support + len(hot), None))
        if max_len > 1:
            visit((key[0].as_py(),), rows, p.begin, [int(t) for t in p.letters])
        return _results(found)

    return run


def _count(key: tuple[pa.Scalar, ...], shard: pa.Table, candidates: pa.Table) -> pa.Table:
    """Exact supports of the candidates in one shard; hot entities as rows of their own."""
    if not shard.num_rows or not candidates.num_rows:
        return _results([])
    trie: dict = {}
    for pattern in candidates.column("pattern").to_pylist():
        node = trie
        for t in pattern[1:]:
            node = node.setdefault(t, {})
        node[-1] = True
    p, found = Projection(shard), []

    def visit(node: dict, prefix: tuple[int, ...], rows: np.ndarray, at: np.ndarray) -> None:
        if -1 in node:
            support, hot = p.support(rows)
            if support:
                found.append((prefix, support, None))
            found.extend((prefix, 0, p.entities[e]) for e in hot)
        for t, child in node.items():
            if t >= 0 and t in p.places:
                r, a = p.grown(rows, at, t)
                if len(r):
                    visit(child, (*prefix, t), r, a)

    visit(trie, (key[0].as_py(),), np.arange(len(p.begin)), p.begin)
    return _results(found)


def frequent_patterns(sequences: DataFrame, min_share: float, min_len: int, max_len: int) -> DataFrame:
    """Ordered token lists (gaps allowed) held by at least ``min_share`` of the entities.

    ``sequences(entity, tokens array<string>)``. Returns pattern (tokens joined by a blank),
    length, support, entities (how many there are).

    Equal sequences are counted once with a weight. Each is projected on each of its tokens;
    the suffixes are spread by (token, bucket of sequences), so that no task holds a prefix
    with most of the rows. A worker grows a shard's prefixes recursively over pointers into its
    suffixes, to the end, keeping those frequent in its bucket: a pattern held by ``least``
    entities is held by ``least / buckets`` of them in some bucket, so none is lost. With more
    than one bucket a second pass counts the candidates exactly, each shard those of its token.
    Patterns stay in the cluster; the driver sees the alphabet only: tokens in at least
    ``least`` rows, at most (rows / least) times the tokens of a row.

    An entity counts once per pattern, also if it has several different sequences: these stand
    in one bucket, or, for an entity with more than HOT_SEQUENCES, in all, and then its
    patterns are told apart by a distinct count. Null entities and null or empty tokens are
    left out; entities without a token do not count. Tokens must not hold blanks. Empty input
    gives no rows.
    """
    spark = sequences.sparkSession
    clean = sequences.select(F.col("entity").cast("string").alias("entity"), F.filter("tokens", lambda t: t.isNotNull() & (t != "")).alias("tokens")).where("entity is not null and size(tokens) > 0")
    entities = clean.select("entity").distinct().count()
    least = max(1, math.ceil(min_share * entities - 1e-9))
    known = clean.select(F.explode(F.array_distinct("tokens")).alias("token")).groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    letters = sorted(r["token"] for r in known.collect())
    if not letters:
        return spark.createDataFrame([], "pattern string, length int, support long, entities long")
    rows = materialize(spread(clean, "entity").mapInArrow(_encode(letters), "entity string, codes binary").where("length(codes) > 0").distinct(), "sequences")
    each = rows.groupBy("entity").agg(F.count("*").alias("n"), F.min("codes").alias("codes"))
    none = F.lit(None).cast("string").alias("entity")
    single = each.where("n = 1").groupBy("codes").agg(F.count("*").alias("weight")).select("codes", "weight", none, F.lit(False).alias("hot"))
    several = rows.join(each.where("n > 1").select("entity", (F.col("n") > HOT_SEQUENCES).alias("hot")), "entity").select("codes", F.lit(1).cast("long").alias("weight"), "entity", "hot")
    weighted = materialize(single.unionByName(several), "weighted")
    total = weighted.agg(F.sum(F.length("codes"))).first()[0] // 4
    buckets = -(-total // BUCKET_TOKENS)
    shards = spread(weighted, "codes").mapInArrow(_project(len(letters), min_len > 1), "root int, suffix binary, weight long, entity string, hot boolean")
    home = F.when(F.col("entity").isNull() | F.col("hot"), F.xxhash64("suffix")).otherwise(F.xxhash64("entity"))
    parts, keys = width(sequences), ["root", "bucket"]
    shards = shards.withColumn("bucket", F.pmod(home, F.lit(buckets)).cast("int")).repartition(parts, *keys)
    if buckets > 1:
        shards = materialize(shards, "suffixes").repartition(parts, *keys)
    counted = shards.groupBy(*keys).applyInArrow(_grow(least / buckets, max_len), FOUND)
    if buckets > 1:
        unseen = math.ceil(least / buckets) - 1  # a bucket that does not report a pattern holds it at most so often
        sums = counted.groupBy("pattern").agg(F.sum("support").alias("support"), F.count("*").alias("n"))
        hopeful = sums.where(F.col("support") + (buckets - F.col("n")) * unseen >= least)
        hopeful = hopeful.select(F.col("pattern")[0].alias("root"), F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"), "pattern")
        counted = shards.groupBy(*keys).cogroup(hopeful.repartition(parts, *keys).groupBy(*keys)).applyInArrow(_count, FOUND)
    exact = counted.groupBy("pattern").agg((F.sum("support") + F.count_distinct("entity")).alias("support")).where((F.col("support") >= least) & F.size("pattern").between(min_len, max_len))
    names = F.array(*map(F.lit, letters))
    text = F.array_join(F.transform("pattern", lambda i: F.element_at(names, i + 1)), " ")
    return exact.select(text.alias("pattern"), F.size("pattern").alias("length"), "support", F.lit(entities).cast("long").alias("entities"))
