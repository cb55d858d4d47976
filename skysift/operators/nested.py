"""Problem 4: flatten nested JSON into related tables through Arrow buffers."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.operators.spread import spread

NODES = "stream_name string, dedupe_key string, node_path string, parent_path string, table_path string, ordinal long"
VALUES = "stream_name string, dedupe_key string, node_path string, member string, value string"

OPEN_OBJECT, OPEN_ARRAY, CLOSE_OBJECT, CLOSE_ARRAY, COMMA, COLON, NAME, VALUE, BEGIN = range(9)
TOP, OBJECT, ARRAY = range(3)

_KIND = np.full(256, VALUE, np.int8)
for _byte, _kind in zip(b"{[}],:", range(6)):
    _KIND[_byte] = _kind
_MARK = _KIND < 6
_BLANK = np.isin(np.arange(256), list(b" \t\n\r"))
_HEX = np.isin(np.arange(256), list(b"0123456789abcdefABCDEF"))
_ESCAPED = np.isin(np.arange(256), list(b'"\\/bfnrtu'))
_SCALAR = r"^(-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?|true|false|null)$"


def _grammar() -> np.ndarray:
    """Which token may follow which, inside which container: [container, before, token]."""
    ok = np.zeros((3, 9, 8), bool)
    ok[TOP, BEGIN, [OPEN_OBJECT, OPEN_ARRAY]] = True
    for before in (VALUE, CLOSE_OBJECT, CLOSE_ARRAY):
        ok[OBJECT, before, [COMMA, CLOSE_OBJECT]] = True
        ok[ARRAY, before, [COMMA, CLOSE_ARRAY]] = True
    ok[OBJECT, OPEN_OBJECT, [NAME, CLOSE_OBJECT]] = True
    ok[OBJECT, COMMA, NAME] = True
    ok[OBJECT, NAME, COLON] = True
    ok[OBJECT, COLON, [VALUE, OPEN_OBJECT, OPEN_ARRAY]] = True
    ok[ARRAY, OPEN_ARRAY, [VALUE, OPEN_OBJECT, OPEN_ARRAY, CLOSE_ARRAY]] = True
    ok[ARRAY, COMMA, [VALUE, OPEN_OBJECT, OPEN_ARRAY]] = True
    return ok


_FOLLOWS = _grammar()


def _spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """Strings cut out of a byte buffer, as one Arrow array."""
    size = np.maximum(end - begin, 0)
    to = np.concatenate([[0], np.cumsum(size)])
    bytes_ = data[np.arange(to[-1]) - np.repeat(to[:-1] - begin, size)]
    return pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(to.astype(np.int64).tobytes()), pa.py_buffer(bytes_.tobytes()))


class Tokens:
    """The tokens of a batch of JSON texts as flat arrays, each with the container it stands in.

    Only whole-buffer kernels run: quotes, brackets and scalars are found in the concatenated
    bytes, depth is a running sum, and a token's container is the last one opened at its depth.
    ``good`` tells which texts are JSON objects or arrays by the whole grammar, whatever their
    depth and whether or not members repeat; tokens of other texts are dropped. ``wrapped``
    tells which are one JSON string.
    """

    def __init__(self, text: pa.Array) -> None:
        text = text.cast(pa.large_string())
        n = len(text)
        _, off, buf = text.buffers()
        off = np.frombuffer(off, np.int64)[text.offset : text.offset + n + 1]
        self.data = d = np.frombuffer(buf, np.uint8)[off[0] : off[-1]] if buf is not None else np.zeros(0, np.uint8)
        self.off = off = off - off[0]
        row_of = lambda at: np.searchsorted(off, at, side="right") - 1
        bad = np.zeros(n, bool)
        begins = np.zeros(len(d) + 1, bool)
        begins[off] = True
        quote = d == 0x22
        slash = np.flatnonzero(d == 0x5C)
        if len(slash):
            # a run of backslashes escapes what follows if its length is odd
            head = np.append(True, np.diff(slash) > 1) | begins[slash]
            first = np.flatnonzero(head)
            start, stop = slash[first], slash[np.append(first[1:], len(slash)) - 1] + 1
            odd = stop[(stop - start) % 2 == 1]
            cut = begins[odd]
            bad[row_of(odd[cut] - 1)] = True
            odd = odd[~cut]
            quote[odd] = False
            wrong = ~_ESCAPED[d[odd]]
            four = odd[d[odd] == 0x75]
            for k in range(1, 5):
                at = np.minimum(four + k, len(d) - 1)
                bad[row_of(four[~_HEX[d[at]] | (row_of(at) != row_of(four)) | (four + k >= len(d))])] = True
            bad[row_of(odd[wrong])] = True
        q = np.flatnonzero(quote)
        uneven = np.diff(np.searchsorted(q, off)) % 2 == 1
        if uneven.any():
            bad |= uneven
            lost = uneven[row_of(q)]
            quote[q[lost]] = False
            q = q[~lost]
        inside = np.bitwise_xor.accumulate(quote.view(np.uint8)).view(bool) if len(d) else quote
        control = np.flatnonzero((d < 0x20) & inside)
        bad[row_of(control)] = True
        plain = ~inside & ~quote & ~_BLANK[d]
        mark = _MARK[d] & plain
        scalar = plain & ~mark
        before, after = np.append(False, scalar[:-1]) & ~begins[:-1], np.append(scalar[1:], False) & ~begins[1:]
        head = scalar & ~before if len(d) else scalar
        at_start = mark | head
        at_start[q[::2]] = True
        pos = np.flatnonzero(at_start)
        kind = _KIND[d[pos]]
        end = pos + 1
        is_string = quote[pos]
        end[is_string] = q[1::2] + 1
        is_scalar = head[pos]
        end[is_scalar] = np.flatnonzero(scalar & ~after) + 1
        row = row_of(pos)
        if is_scalar.any():
            words = _spans(d, pos[is_scalar], end[is_scalar])
            fine = pc.match_substring_regex(words, _SCALAR).to_numpy(zero_copy_only=False)
            bad[row[is_scalar][~fine]] = True
        opens, closes = kind <= OPEN_ARRAY, (kind == CLOSE_OBJECT) | (kind == CLOSE_ARRAY)
        total = np.cumsum(opens.astype(np.int64) - closes)
        count = np.bincount(row, minlength=n)
        to = np.concatenate([[0], np.cumsum(count)])
        base = np.append(0, total)[to[:-1]]
        depth = total - base[row]
        last = to[1:][count > 0] - 1
        bad[row[depth < 0]] = True
        final = np.zeros(len(pos), bool)
        final[last] = True
        bad[row[(depth == 0) != final]] = True
        bad[count == 0] = True
        self.wrapped = (count == 1) & ~bad
        lone = to[:-1][count == 1]
        self.wrapped[count == 1] &= is_string[lone]
        self.string_at, self.string_end = pos[to[:-1][self.wrapped]] + 1, end[to[:-1][self.wrapped]] - 1
        self._keep(~bad[row], pos, end, kind, row, depth, closes, opens, is_string)
        self._judge(bad)
        self.good = ~bad

    def _keep(self, keep, pos, end, kind, row, depth, closes, opens, is_string) -> None:
        self.pos, self.end, self.kind, self.row, self.opens, self.closes, self.is_string = (x[keep] for x in (pos, end, kind, row, opens, closes, is_string))
        self.level = (depth + closes)[keep] - self.opens  # of the container a token stands in; 0 is none
        o = np.flatnonzero(self.opens)
        n = len(self.pos) + 1
        key = (self.level[o] + 1) * n + o
        order = np.argsort(key)
        inner = self.level > 0
        self.owner = np.full(len(self.pos), -1)
        t = np.flatnonzero(inner)
        at = np.searchsorted(key[order], self.level[t] * n + t) - 1
        self.owner[t] = o[order][np.maximum(at, 0)] if len(o) else -1

    def _judge(self, bad: np.ndarray) -> None:
        """Check the grammar of what is left, and tell names from values."""
        if not len(self.pos):
            return
        before = np.append(BEGIN, self.kind[:-1])
        before[np.append(True, self.row[1:] != self.row[:-1])] = BEGIN
        inside = np.where(self.owner < 0, TOP, np.where(self.kind[self.owner] == OPEN_OBJECT, OBJECT, ARRAY))
        name = self.is_string & (inside == OBJECT) & ((before == OPEN_OBJECT) | (before == COMMA))
        self.kind = np.where(name, NAME, self.kind).astype(np.int8)
        before = np.where(before == BEGIN, BEGIN, np.append(BEGIN, self.kind[:-1]))
        bad[self.row[~_FOLLOWS[inside, before, self.kind]]] = True
        keep = ~bad[self.row]
        if not keep.all():
            number = np.cumsum(keep) - 1
            owner = np.where(self.owner < 0, -1, number[self.owner])
            for c in ("pos", "end", "kind", "row", "opens", "closes", "is_string", "level"):
                setattr(self, c, getattr(self, c)[keep])
            self.owner = owner[keep]

    def names(self, at: np.ndarray) -> pa.Array:
        """The member names of the values that are the tokens ``at``."""
        t = at - 2  # the name, a colon, the value
        names = _spans(self.data, self.pos[t] + 1, self.end[t] - 1)
        return unescaped(names)

    def place(self, at: np.ndarray) -> np.ndarray:
        """0-based place of the tokens ``at`` among the elements of their arrays."""
        n = len(self.pos) + 1
        comma = np.flatnonzero(self.kind == COMMA)
        key = np.sort(self.owner[comma].astype(np.int64) * n + comma)
        return np.searchsorted(key, self.owner[at] * n + at) - np.searchsorted(key, self.owner[at] * n)


def unescaped(text: pa.Array) -> pa.Array:
    """JSON string contents without escapes: kernels over the whole array, single texts only for ``\\u``."""
    if not pc.any(pc.match_substring(text, "\\")).as_py():
        return text
    escaped = text
    text = pc.replace_substring(text, "\\\\", "\x01")  # raw control characters cannot occur
    for mark, plain in (('\\"', '"'), ("\\/", "/"), ("\\b", "\b"), ("\\f", "\f"), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t")):
        text = pc.replace_substring(text, mark, plain)
    coded = np.flatnonzero(pc.match_substring(text, "\\u").to_numpy(zero_copy_only=False))
    text = pc.replace_substring(text, "\x01", "\\")
    if len(coded):
        mask = np.zeros(len(text), bool)
        mask[coded] = True
        d = escaped.take(pa.array(coded)).dictionary_encode()
        plain = pa.array([json.loads(f'"{x}"').encode("utf-8", "replace").decode() for x in d.dictionary.to_pylist()], text.type)
        text = pc.replace_with_mask(text, pa.array(mask), plain.take(d.indices))
    return text


def readable(text: pa.Array) -> pa.Array:
    """JSON objects and arrays as they stand, unwrapped if they are JSON text inside a JSON string; else null."""
    out = np.full(len(text), None, object)
    at = np.arange(len(text))
    for _ in range(3):
        t = Tokens(pc.fill_null(text, ""))
        good = np.flatnonzero(t.good)
        out[at[good]] = text.take(pa.array(good)).to_numpy(zero_copy_only=False)
        if not t.wrapped.any():
            break
        at = at[t.wrapped]
        text = unescaped(_spans(t.data, t.string_at, t.string_end))
    return pa.array(out, pa.string())


class Shredded(Tokens):
    """Containers of a batch of readable JSON texts: parents, paths and nodes, level by level."""

    def __init__(self, text: pa.Array) -> None:
        super().__init__(text)
        self.tok = np.flatnonzero(self.opens)
        number = np.full(len(self.pos) + 1, -1)
        number[self.tok] = np.arange(len(self.tok))
        self.container = number[self.owner]  # of every token, as a container number; -1: none
        self.parent = self.container[self.tok]
        self.is_object = self.kind[self.tok] == OPEN_OBJECT
        self.in_array = (self.parent >= 0) & ~self.is_object[self.parent]
        self.is_node = self.is_object & self.in_array
        level = self.level[self.tok]
        order = np.argsort(level, kind="stable")
        self.by_level = np.split(order, np.flatnonzero(np.diff(level[order])) + 1) if len(order) else []

    def paths(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each container its path, its path below its node, its path without indices, its place and its node.

        A container's node is the nearest object that is an array element, itself included; -1: none.
        """
        n = len(self.tok)
        path, below, table = (np.full(n, "", object) for _ in range(3))
        place, node = np.zeros(n, np.int64), np.where(self.is_node, np.arange(n), -1)
        arr = np.flatnonzero(self.in_array)
        place[arr] = self.place(self.tok[arr])
        for mine in self.by_level[1:]:
            up = self.parent[mine]
            node[mine] = np.where(node[mine] < 0, node[up], node[mine])
            for in_array in (False, True):
                m = mine[self.in_array[mine] == in_array]
                if not len(m):
                    continue
                if in_array:
                    number = pa.array(place[m])
                    path[m], below[m], table[m] = (_cat(pa.array(x[self.parent[m]], pa.large_string()), *rest) for x, rest in ((path, ("[", number, "]")), (below, ("[", number, "]")), (table, ("[]",))))
                else:
                    name = self.names(self.tok[m])
                    path[m], below[m], table[m] = (_joined(pa.array(x[self.parent[m]], pa.large_string()), name) for x in (path, below, table))
            below[mine[self.is_node[mine]]] = ""
        return path, below, table, place, node


def _cat(*parts: pa.Array | str) -> np.ndarray:
    """Element-wise concatenation of strings and numbers."""
    kind = pa.large_string()
    parts = [pa.scalar(x, kind) if isinstance(x, str) else x.cast(kind) for x in parts]
    return pc.binary_join_element_wise(*parts, pa.scalar("", kind)).to_numpy(zero_copy_only=False)


def _joined(up: pa.Array, name: pa.Array) -> np.ndarray:
    """Member names below their paths."""
    return _cat(up, pc.if_else(pc.equal(up, pa.scalar("", up.type)), "", "."), name)


#: Bytes of JSON shredded at once: the kernels' arrays take some tens of bytes for each.
CHUNK_BYTES = 1 << 20


def _chunks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Stretches of about CHUNK_BYTES of text, one row at least."""
    for b in batches:
        end = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            done = end[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(end, done + CHUNK_BYTES, side="right")))
            yield b.slice(at, stop - at)
            at = stop


def _readable_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _chunks(batches, 3):
        text = readable(b.column(3))
        keep = pc.is_valid(text)
        yield pa.RecordBatch.from_arrays([*b.columns[:3], text], b.schema.names).filter(keep)


def _node_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _chunks(batches, 2):
        s = Shredded(b.column(2))
        mine = np.flatnonzero(s.is_node)
        if not len(mine):
            continue
        path, _, table, place, node = s.paths()
        up = node[s.parent[mine]]
        above = np.where(up < 0, "$", path[up])
        row = s.row[s.tok[mine]]
        # paths repeat within a message where member names do
        once = ~pd.DataFrame({"row": row, "path": path[mine], "above": above}).duplicated().to_numpy()
        mine, above = mine[once], above[once]
        take = pa.array(row[once])
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0).take(take), b.column(1).take(take), pa.array(path[mine], pa.string()),
                pa.array(above, pa.string()), pa.array(table[mine], pa.string()), pa.array(place[mine]),
            ],
            ["stream_name", "dedupe_key", "node_path", "parent_path", "table_path", "ordinal"],
        )


def _value_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _chunks(batches, 2):
        s = Shredded(b.column(2))
        t = np.flatnonzero(s.kind == VALUE)
        if not len(t):
            continue
        path, below, _, _, node = s.paths()
        own = s.container[t]
        member = np.full(len(t), "", object)
        for in_object in (True, False):
            m = np.flatnonzero(s.is_object[own] == in_object)
            if len(m):
                up = pa.array(below[own[m]], pa.large_string())
                member[m] = _joined(up, s.names(t[m])) if in_object else _cat(up, "[", pa.array(s.place(t[m])), "]")
        home, take = node[own], pa.array(s.row[t])
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(take), b.column(1).take(take), pa.array(np.where(home < 0, "$", path[home]), pa.string()), pa.array(member, pa.string()), _spans(s.data, s.pos[t], s.end[t]).cast(pa.string())],
            ["stream_name", "dedupe_key", "node_path", "member", "value"],
        )


def latest_readable(events: DataFrame) -> DataFrame:
    """(stream_name, dedupe_key, json): the latest readable copy of each message, unwrapped.

    The kernels check the whole grammar on the bytes as they stand; nothing is printed anew, so
    numbers keep their digits. Of copies of equal age the greatest text counts.
    """
    rows = events.select("stream_name", "dedupe_key", "updated_at", F.col("payload").alias("json"))
    text = spread(rows.where("json is not null"), "dedupe_key").mapInArrow(_readable_batches, rows.schema)
    return text.groupBy("stream_name", "dedupe_key").agg(F.max_by("json", F.struct("updated_at", "json")).alias("json"))


def nested_nodes(events: DataFrame) -> DataFrame:
    """Each object that is an array element in a readable payload, once per message.

    node_path and parent_path link the tables; table_path (the path without indices) names the
    flat table a node belongs to, ordinal is its place in its array. Of a repeated message the
    latest readable copy counts. Null, broken or scalar payloads give no rows, as do empty
    arrays and elements that are no objects. Where a member name is repeated in an object, all
    its values count, and a path they share gives one row. Empty input gives no rows.
    """
    return latest_readable(events).mapInArrow(_node_batches, NODES)


def nested_values(events: DataFrame) -> DataFrame:
    """The scalar members below each node (``$``: outside all nodes), as JSON text.

    member is the path below the node: ``a``, ``b.c``, ``tags[0]``. Together with
    :func:`nested_nodes` this keeps everything a payload holds but empty containers: numbers
    and strings are the bytes of the payload.
    """
    return latest_readable(events).mapInArrow(_value_batches, VALUES)
