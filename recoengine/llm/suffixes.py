"""Suffix-array dedup on bytes by a hash-compared suffix sort.

Suffixes are sorted where windows are anchored: both the bytes from each anchor
on, and the bytes before it read backwards. Prefix polynomial hashes and binary
search find the common extension of two suffixes in logarithmic time, and a
mergesort orders them by it, a round's comparisons at once. A window that has
``d`` bytes before its anchor is repeated if another suffix of the same anchor
shares ``d`` bytes backwards and the rest forwards: both are read from the
common extensions of neighbours in the two orders. Neighbours in the finished
order are compared byte by byte; a hash collision sends the bucket through a
plain comparison of its strings. Windows of a split gram (over ``HOT`` anchors, or
under ``THIN`` windows an anchor) are counted as 128-bit digests instead.

Defined results: a null text has no bytes; a text shorter than a window stays
whole; equal texts repeat each other whatever their ids; cuts may split a
character, so kept bytes need not be valid UTF-8 (the document form replaces
the cut halves); an empty table gives no rows; further columns are not read by
the query and kept by the document form.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from recoengine.llm.common import as_bytes, byte_chunks, table
from recoengine.llm.windows import PrefixHash, byte_codes, merged_runs, packed_with_spans, repeated_spans, unpacked, with_spans

WINDOW = 400
GRAM = 32
#: Anchors of a gram over which it is split by window.
HOT = 8192
#: Windows an anchor on average, below which a gram is split by window too.
THIN = 16
BUCKET_ROWS = 3000


class Suffixes:
    """Strings within one buffer, compared through prefix hashes."""

    def __init__(self, buffer: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
        self.buffer, self.start, self.length = buffer, start, length
        self.hashes = PrefixHash(byte_codes(buffer, 5), 5)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of each pair of strings."""
        low = np.zeros(len(a), dtype=np.int64)
        high = np.minimum(self.length[a], self.length[b])
        sa, sb = self.start[a], self.start[b]
        open_ = low < high
        while open_.any():
            middle = (low + high + 1) >> 1
            same = self.hashes.of(sa, middle) == self.hashes.of(sb, middle)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
            open_ = low < high
        return low

    def before(self, a: np.ndarray, b: np.ndarray, n: np.ndarray | None = None) -> np.ndarray:
        """Whether string a sorts before b, ties by number; ``n``: their common
        prefixes, where known."""
        n = self.common(a, b) if n is None else n
        end_a, end_b = n == self.length[a], n == self.length[b]
        last = len(self.buffer) - 1
        ca = np.where(end_a, -1, self.buffer[np.minimum(self.start[a] + n, last)].astype(np.int64))
        cb = np.where(end_b, -1, self.buffer[np.minimum(self.start[b] + n, last)].astype(np.int64))
        return np.where(ca != cb, ca < cb, a < b)

    def order(self, group: np.ndarray) -> np.ndarray:
        """Mergesort of the strings within each group (groups ascending): runs
        double, and each string's place in a merged run is its place in its own
        plus what of the sibling run sorts before it."""
        out = np.argsort(group, kind="stable")
        g = group[out]
        begin = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        size = np.diff(np.append(begin, len(g)))
        base, total = np.repeat(begin, size), np.repeat(size, size)
        run = 1
        while run < size.max(initial=0):
            at = np.flatnonzero(total > run)  # groups that have two runs at least
            inner = at - base[at]
            own = inner // run * run
            sibling = np.where(inner // run % 2 == 0, own + run, own - run)
            low = np.minimum(sibling, total[at])
            high = np.minimum(sibling + run, total[at])
            first = low.copy()
            open_ = low < high
            while open_.any():
                k = np.flatnonzero(open_)
                middle = (low[k] + high[k]) >> 1
                less = self.before(out[base[at[k]] + middle], out[at[k]])
                low[k] = np.where(less, middle + 1, low[k])
                high[k] = np.where(less, high[k], middle)
                open_[k] = low[k] < high[k]
            merged = out.copy()
            place = base[at] + np.minimum(own, sibling) + (inner - own) + (low - first)
            merged[place] = out[at]
            out = merged
            run *= 2
        return out

    def neighbours(self, order: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Common prefix of each string in the order with the one before it (-1
        at a group's first). Verified by bytes, as is that the one before does
        sort before it: then the whole order holds, whatever collided."""
        common = np.full(len(order), -1, dtype=np.int64)
        same = np.flatnonzero(group[order[1:]] == group[order[:-1]]) + 1
        a, b = order[same - 1], order[same]
        found = self.common(a, b)
        for i in range(0, len(same), 4096):
            n = found[i:i + 4096]
            most = int(n.max(initial=0))
            reach = np.arange(most)
            last = len(self.buffer) - 1
            left = self.buffer[np.minimum(self.start[a[i:i + 4096], None] + reach, last)]
            right = self.buffer[np.minimum(self.start[b[i:i + 4096], None] + reach, last)]
            if ((left != right) & (reach < n[:, None])).any():
                raise Collision
        if not self.before(a, b, found).all():
            raise Collision
        common[same] = found
        return common


class Collision(Exception):
    """Two unequal strings have equal hashes."""


def _plain(buffer: np.ndarray, start: np.ndarray, length: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order and neighbours' common prefixes by comparing the strings."""
    strings = [buffer[s:s + n].tobytes() for s, n in zip(start, length)]
    order = np.array(sorted(range(len(strings)), key=lambda i: (group[i], strings[i], i)), dtype=np.int64)
    common = np.full(len(order), -1, dtype=np.int64)
    for k in range(1, len(order)):
        a, b = strings[order[k - 1]], strings[order[k]]
        if group[order[k - 1]] == group[order[k]]:
            n = min(len(a), len(b))
            unequal = np.flatnonzero(np.frombuffer(a[:n], np.uint8) != np.frombuffer(b[:n], np.uint8))
            common[k] = unequal[0] if len(unequal) else n
    return order, common


def suffix_order(buffer: np.ndarray, start: np.ndarray, length: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The strings' order within groups, and each one's common prefix with the
    one before it."""
    try:
        suffixes = Suffixes(buffer, start, length)
        order = suffixes.order(group)
        return order, suffixes.neighbours(order, group)
    except Collision:
        return _plain(buffer, start, length, group)


def _kernel(window: int):
    def kernel(rows: pa.Table) -> tuple:
        units = as_bytes(rows.column("units").combine_chunks())
        size = np.array([len(u) for u in units], dtype=np.int64)
        lead = rows.column("lead").to_numpy().astype(np.int64)
        group = np.unique(rows.column("key").to_numpy(), return_inverse=True)[1]
        text = np.frombuffer(b"".join(units), dtype=np.uint8)
        begin = np.cumsum(size) - size
        ahead, ahead_common = suffix_order(text, begin + lead, size - lead, group)
        # the same bytes backwards: what stands before each anchor
        back, back_common = suffix_order(text[::-1].copy(), len(text) - begin - lead, lead, group)
        most = size - lead  # bytes from the anchor on
        flags = np.zeros((len(units), int(lead.max(initial=0)) + 2), dtype=np.int8)
        classes_ahead = np.empty(len(units), dtype=np.int64)
        classes_back = np.empty(len(units), dtype=np.int64)
        for d in range(int(lead.max(initial=0)) + 1):
            mine = np.flatnonzero((lead >= d) & (most >= window - d))
            if len(mine) < 2:
                continue
            classes_ahead[ahead] = np.cumsum(ahead_common < window - d)
            classes_back[back] = np.cumsum(back_common < d)
            pair = classes_ahead[mine] * (len(units) + 1) + classes_back[mine]
            by = np.argsort(pair)
            pair = pair[by]
            like = pair[1:] == pair[:-1]
            twice = np.zeros(len(mine), dtype=bool)
            twice[by[1:]] |= like
            twice[by[:-1]] |= like
            flags[mine[twice], d + 1] = 1
        edge = np.diff(flags, axis=1, append=0)  # runs of d: columns are shifted by one
        row, first = np.nonzero(edge == 1)
        _, last = np.nonzero(edge == -1)
        anchor = rows.column("first").to_numpy().astype(np.int64)[row] + lead[row]
        return row, anchor - (last - 1), anchor - first + window

    return kernel


def repeated_byte_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT,
                        bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(text_key, spans): the byte spans under strings that start elsewhere too."""
    return repeated_spans(docs, window, gram, False, hot, bucket_rows, _kernel(window), THIN)


def remove_repeated_bytes(docs: DataFrame, **params) -> DataFrame:
    """One row a document: (doc_id, n_bytes, n_removed, n_spans, kept,
    kept_sha256), kept being the remaining bytes."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in byte_chunks(batches, "packed", 1 << 20):
            total, removed, spans_, kept = [], [], [], []
            for text, spans in zip(unpacked(chunk.column("packed")), chunk.column("spans").to_pylist()):
                runs = merged_runs(spans)
                total.append(len(text))
                removed.append(sum(e - s for s, e in runs))
                spans_.append(len(runs))
                kept.append(_without(text, runs))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans_, pa.int64()),
                 pa.array(kept, pa.binary()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return packed_with_spans(docs, repeated_byte_spans(docs, **params)).mapInArrow(
        cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")


def _without(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for s, e in runs:
        parts.append(text[at:s])
        at = e
    return b"".join([*parts, text[at:]])


def without_repeats(docs: DataFrame, **params) -> DataFrame:
    """The documents with repeated strings cut from their texts and all their
    columns (n_chars follows the text); characters cut in half go whole.
    Documents of which nothing is left go."""
    columns = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in byte_chunks(batches, "text", 4 << 20):
            texts = chunk.column("text").to_pylist()
            new, stays = [], []
            for text, spans in zip(texts, chunk.column("__spans").to_pylist()):
                left = _without(text.encode(), merged_runs(spans)).decode(errors="ignore") if spans else text
                new.append(left)
                stays.append(bool(left) or not spans)
            out = {c: chunk.column(c) for c in columns} | {"text": pa.array(new, pa.string())}
            if "n_chars" in out:
                kind = chunk.column("n_chars").type
                out["n_chars"] = pc.if_else(pc.is_valid(chunk.column("__spans")), pc.utf8_length(out["text"]).cast(kind), out["n_chars"])
            yield pa.RecordBatch.from_pydict(out).filter(pa.array(stays))

    spans = repeated_byte_spans(docs.select("doc_id", "text"), **params)
    return with_spans(docs, spans).mapInArrow(cut, docs.schema)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents")).drop("kept")
