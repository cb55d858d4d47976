"""Problem 9: evaluation texts inside a corpus (greedy string tiling)."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.operators.spread import spread

#: Words of a seed of a run.
SEED = 3
#: Consecutive words that are a leak by themselves.
RUN = 12
#: Share of an item's words, in order, that is a leak.
SHARE = 0.8
#: A passage is at most this many times as long as the item.
PASSAGE = 2.0
#: Bytes of item text of one block; a task holds the index of one block at a time.
BLOCK_BYTES = 16_000_000
#: Bytes of documents that a task splits into words once and runs against all blocks.
CHUNK_BYTES = 16_000_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

_WORD = re.compile(r"[^\W_]+")
_UNSEEN = {ord(c): None for c in "­​‌‍⁠﻿"}


def words(text: str | None) -> list[str]:
    """Words without case, marks, punctuation, spacing and typographic variants of characters."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.translate(_UNSEEN))
        text = "".join(c for c in text if not unicodedata.combining(c))
    return _WORD.findall(text.casefold())


def lcs(masks: dict[int, int], n: int, passage: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel over the item's n words."""
    full = (1 << n) - 1
    s = full
    for w in passage:
        m = masks.get(w)
        if m:
            u = s & m
            s = ((s + u) | (s - u)) & full
    return n - s.bit_count()


def _hashes(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums from which the Karp-Rabin hash of any stretch follows by one subtraction."""
    n = len(code)
    while len(_POWERS[0]) < n + 1:
        for k, b in enumerate((_BASE, _INVERSE)):
            with np.errstate(over="ignore"):
                _POWERS[k] = np.concatenate([_POWERS[k], _POWERS[k] * np.uint64(pow(b, len(_POWERS[k]), 1 << 64))])
    with np.errstate(over="ignore"):
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(code.astype(np.uint64) * _POWERS[0][:n])]), _POWERS[1][:n]


class Tiling:
    """Greedy string tiling of a text with an item, by running Karp-Rabin of falling length.

    The longest match of words neither side has marked becomes a tile, again and again, down
    to single words. The first tile is the longest run the text has of the item, and all of
    them together cover as many of the item's words as the text holds, in any order.
    """

    def __init__(self, text: np.ndarray, item: np.ndarray) -> None:
        self.text, self.item = text, item
        self.free = [text > 0, np.ones(len(item), bool)]
        self.sums = [_hashes(text), _hashes(item)]

    def _windows(self, side: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the stretches of free words."""
        free, (sums, inverse) = self.free[side], self.sums[side]
        if len(free) < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        taken = np.concatenate([[0], np.cumsum(~free)])
        at = np.flatnonzero(taken[size:] == taken[:-size])
        with np.errstate(over="ignore"):
            return at, (sums[at + size] - sums[at]) * inverse[at]

    def _common(self, size: int) -> bool:
        return bool(np.isin(self._windows(0, size)[1], self._windows(1, size)[1]).any())

    def longest(self, most: int) -> int:
        """Length of the longest free match, at most ``most``: matches of a length have matches of all shorter ones."""
        low, high = 0, min(most, len(self.text), len(self.item))
        while low < high:
            middle = (low + high + 1) // 2
            if self._common(middle):
                low = middle
            else:
                high = middle - 1
        return low

    def tiles(self) -> list[tuple[int, int, int]]:
        """(place in the text, place in the item, words) of all tiles, longest first."""
        out, size = [], len(self.item)
        while size := self.longest(size):
            at, hash_ = self._windows(0, size)
            places, of_item = self._windows(1, size)
            by: dict[int, list[int]] = defaultdict(list)
            for h, i in zip(of_item.tolist(), places.tolist()):
                by[h].append(i)
            hits, before = np.isin(hash_, of_item), len(out)
            for d, h in zip(at[hits].tolist(), hash_[hits].tolist()):
                if not self.free[0][d : d + size].all():
                    continue
                for i in by[h]:
                    if self.free[1][i : i + size].all() and (self.text[d : d + size] == self.item[i : i + size]).all():
                        self.free[0][d : d + size] = self.free[1][i : i + size] = False
                        out.append((d, i, size))
                        break
            if len(out) == before:  # hashes alike, words not
                size -= 1
        return out


class ItemIndex:
    """Seeds of a block of items, as sorted arrays: three-word seeds for runs, rare words for shares."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.vocabulary: dict[str, int] = {}
        self.ids, self.codes = [], []
        for number, text in items:
            code = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)], np.int64)
            if len(code) >= SEED:
                self.ids.append(number)
                self.codes.append(code)
        self.base = len(self.vocabulary) + 1
        self._masks: dict[int, dict[int, int]] = {}
        self._seeds()
        self._rarest()

    @staticmethod
    def seeds(code: np.ndarray) -> np.ndarray:
        """Karp-Rabin hashes of all SEED words in a row."""
        n = max(len(code) - SEED + 1, 0)
        out = np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(SEED):
                out = out * np.uint64(_BASE) + code[k : k + n].astype(np.uint64)
        return out

    def _seeds(self) -> None:
        """Of every RUN words in a row of an item at least one seed, the rarest within reach."""
        each = [self.seeds(c) for c in self.codes]
        all_, inverse, count = np.unique(np.concatenate(each) if each else np.zeros(0, np.uint64), return_inverse=True, return_counts=True)
        often = np.split(count[inverse], np.cumsum([len(e) for e in each])[:-1]) if each else []
        seed, owner = [], []
        reach = RUN - SEED + 1
        for k, (e, n) in enumerate(zip(each, often)):
            at = -1
            while at + reach < len(e):
                ahead = n[at + 1 : at + 1 + reach]
                at += 1 + len(ahead) - 1 - int(ahead[::-1].argmin())
                seed.append(e[at])
                owner.append(k)
        order = np.argsort(np.array(seed, np.uint64), kind="stable")
        self.seed, self.owner = np.array(seed, np.uint64)[order], np.array(owner, np.int64)[order]

    def _rarest(self) -> None:
        """Each item's rarest words, of which a leak by share of words cannot miss ``least``.

        It misses at most n - need of an item's n words, so of any n - need + least places
        it has ``least``.
        """
        spread_over = np.bincount(np.concatenate([np.unique(c) for c in self.codes]), minlength=self.base) if self.codes else np.zeros(1, np.int64)
        length = np.array([0, *map(len, self.vocabulary)])
        self.need, self.least, self.rare, many = [], [], [], []
        for c in self.codes:
            need = math.ceil(SHARE * len(c) - 1e-9)
            least = min(need, max(1, len(c) // 5))
            order = np.lexsort((-length[c], spread_over[c]))
            code, n = np.unique(c[order[: len(c) - need + least]], return_counts=True)
            self.need.append(need)
            self.least.append(least)
            self.rare.append(code)
            many.append(n)
        code = np.concatenate(self.rare) if self.rare else np.zeros(0, np.int64)
        order = np.argsort(code, kind="stable")
        self.rare_code = code[order]
        self.rare_item = np.repeat(np.arange(len(self.rare)), [len(x) for x in self.rare])[order]
        self.rare_many = (np.concatenate(many) if many else code)[order]

    def masks(self, item: int) -> dict[int, int]:
        """For each word of an item a bit at each of its places."""
        if item not in self._masks:
            if len(self._masks) > 5000:
                self._masks.clear()
            m: dict[int, int] = defaultdict(int)
            for k, w in enumerate(self.codes[item].tolist()):
                m[w] |= 1 << k
            self._masks[item] = dict(m)
        return self._masks[item]

    def found(self, tokens: list[list[str]]) -> list[tuple[int, int, int, float]]:
        """(text number, item id, longest run, share in order) of the leaks in some texts, given as words."""
        get = self.vocabulary.get
        coded = [np.fromiter((get(w, 0) for w in t), np.int64, len(t)) for t in tokens]
        pause = np.zeros(1, np.int64)
        flat = np.concatenate([x for c in coded for x in (c, pause)]) if coded else pause
        first = np.concatenate([[0], np.cumsum([len(c) + 1 for c in coded])])
        out = []
        with_seed = self._with_seed(flat, first)
        for t, i in sorted(with_seed | set(self._covered(flat, first))):
            known = np.zeros(self.base, bool)
            known[self.codes[i]] = True
            text = np.where(known[coded[t]], coded[t], 0)
            longest = Tiling(text, self.codes[i]).longest(len(text)) if (t, i) in with_seed else 0
            run, share = self._tiled(text, i)
            if max(longest, run) >= RUN or share >= SHARE:
                out.append((t, self.ids[i], max(longest, run), share))
        return out

    def _with_seed(self, flat: np.ndarray, first: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) pairs that share a seed; each seed of a text counts once, however often it occurs."""
        known = flat > 0
        n = max(len(flat) - SEED + 1, 0)
        whole = np.logical_and.reduce([known[k : k + n] for k in range(SEED)])
        at = np.flatnonzero(whole)
        seed = self.seeds(flat)[at]
        place = np.searchsorted(self.seed, seed)
        hit = place < len(self.seed)
        hit[hit] = self.seed[place[hit]] == seed[hit]
        if not hit.any():
            return set()
        text = np.searchsorted(first, at[hit], side="right") - 1
        text, place = np.divmod(np.unique(text * (len(self.seed) + 1) + place[hit]), len(self.seed) + 1)
        many = np.searchsorted(self.seed, self.seed[place], side="right") - place
        entry = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(place, many)
        return set(zip(np.repeat(text, many).tolist(), self.owner[entry].tolist()))

    def _covered(self, flat: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int]]:
        """(text, item) pairs with enough of the item's rarest words in the text, in any order."""
        wanted = np.zeros(self.base, bool)
        wanted[self.rare_code] = True
        at = np.flatnonzero(wanted[flat])
        text, code = np.divmod(np.unique((np.searchsorted(first, at, side="right") - 1) * self.base + flat[at]), self.base)
        lo, hi = np.searchsorted(self.rare_code, code), np.searchsorted(self.rare_code, code, side="right")
        least, items = np.array(self.least, np.int64), max(len(self.ids), 1)
        # some texts at a time keep the postings small
        edges = np.searchsorted(text, np.arange(0, len(first) + 64, 64))
        for a, b in zip(edges[:-1], edges[1:]):
            many = (hi - lo)[a:b]
            entry = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo[a:b], many)
            key, inverse = np.unique(np.repeat(text[a:b], many) * items + self.rare_item[entry], return_inverse=True)
            enough = np.bincount(inverse, self.rare_many[entry], len(key)) >= least[key % items] if len(key) else np.zeros(0, bool)
            yield from ((int(k) // items, int(k) % items) for k in key[enough])

    def _tiled(self, text: np.ndarray, item: int) -> tuple[int, float]:
        """(longest tile, share of the item's words in order within a passage, exact where it reaches SHARE).

        Only stretches whose tiles cover enough of the item are looked at for the order of its
        words: no passage in a stretch has more of them in order than tiles cover.
        """
        code, n, need = self.codes[item], len(self.codes[item]), self.need[item]
        width = int(PASSAGE * n)
        rare = np.zeros(self.base, bool)
        rare[self.rare[item]] = True
        start = np.flatnonzero(text)
        end = np.minimum(start + width, len(text))
        all_, few = (np.concatenate([[0], np.cumsum(x)]) for x in (text > 0, rare[text]))
        start = start[(all_[end] - all_[start] >= need) & (few[end] - few[start] >= self.least[item])]
        longest, best, k = 0, 0, 0
        while k < len(start) and best < need:
            # the passages that begin in this stretch end at most one passage after it
            stop = int(np.searchsorted(start, start[k] + width))
            stretch = text[start[k] : start[stop - 1] + width]
            tiles = Tiling(stretch, code).tiles()
            longest = max(longest, tiles[0][2] if tiles else 0)
            if sum(size for _, _, size in tiles) >= need and lcs(self.masks(item), n, stretch.tolist()) >= need:
                for s in start[k:stop].tolist():
                    best = max(best, lcs(self.masks(item), n, text[s : s + width].tolist()))
                    if best >= need:
                        break
            k = stop
        return longest, best / n


def item_bodies(items: DataFrame) -> DataFrame:
    """(item_id, body): items without a first sentence that several items share."""
    sentence = F.regexp_extract("text", r"^\s*([^.?!]*[.?!]+)\s", 1)
    rows = items.select("item_id", "text", sentence.alias("first"), F.trim(F.regexp_replace(F.lower(sentence), r"\W+", " ")).alias("opening")).where("item_id is not null and text is not null")
    shared = rows.where("opening <> ''").groupBy("opening").agg(F.count("*").alias("n")).where("n > 1")
    joined = rows.join(shared, "opening", "left")
    body = F.when(F.col("n").isNull(), F.col("text")).otherwise(F.expr("substring(text, length(regexp_extract(text, '^(\\\\s*[^.?!]*[.?!]+\\\\s)', 1)) + 1)"))
    return joined.select("item_id", body.alias("body"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[list[str]]]]:
    ids, tokens, size = [], [], 0
    for b in batches:
        for number, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            ids.append(number)
            tokens.append(words(text))
            size += len(text)
            if size > CHUNK_BYTES:
                yield ids, tokens
                ids, tokens, size = [], [], 0
    if ids:
        yield ids, tokens


def leaked_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Documents that hold an item: doc_id, item_id, longest_run, share_in_order.

    ``documents(doc_id long, text)``, ``items(item_id long, text)``. A document holds an item
    if RUN consecutive words of it occur, or if SHARE of its words occur in order within a
    passage at most PASSAGE times as long as the item.

    Items are cut into blocks of bounded size, whose seed indexes are sent to the workers. The
    documents are read and split into words once, whole and without any shuffle, and run
    against one block after the other. Texts and items are joined on seeds they share: three
    words in a row, one of every RUN of an item, for runs; for shares an item's rarest words,
    of which no leak can miss more than a fifth of the item. Joined pairs are tiled greedily by
    running Karp-Rabin of falling length: the longest tile decides on a run; where the tiles of
    a passage, in any order, cover SHARE of the item, the words in order are counted exactly.

    Null texts or ids, items of fewer than SEED words: no rows. Repeated rows: one result row
    each pair. Empty input gives no rows.
    """
    spark = documents.sparkSession
    schema = "doc_id long, item_id long, longest_run int, share_in_order double"
    bodies = item_bodies(items)
    total = bodies.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES)
    if not blocks:
        return spark.createDataFrame([], schema)
    block = lambda b: bodies.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toLocalIterator()
    indexes = [spark.sparkContext.broadcast(ItemIndex([(r["item_id"], r["body"]) for r in block(b)])) for b in range(blocks)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, tokens in _chunks(batches):
            for index in indexes:
                rows = index.value.found(tokens)
                if len(indexes) > 1:
                    index.__dict__.pop("_value", None)  # the next block takes its place in memory
                if rows:
                    t, i, longest, share = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array([ids[x] for x in t], pa.int64()), pa.array(i, pa.int64()), pa.array(longest, pa.int32()), pa.array(share, pa.float64())], ["doc_id", "item_id", "longest_run", "share_in_order"])

    texts = spread(documents.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null and text is not null"), "doc_id")
    found = texts.mapInArrow(run, schema)
    return found.groupBy("doc_id", "item_id").agg(F.max("longest_run").alias("longest_run"), F.max("share_in_order").alias("share_in_order"))
