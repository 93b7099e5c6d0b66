"""Finding windows of units (bytes or words) that occur more than once.

What the two exact substring operators share; how windows that may be equal
are compared is each operator's own.

1. ``anchors``: consecutive windows of a document whose smallest hashed gram
   (minimiser) is the same form one anchor. Equal windows have equal
   minimisers, so only anchors with the same gram can hold equal windows.
2. ``candidates``: documents with equal units are one class and one row stands
   for it; anchors whose gram occurs once among the classes go.
3. ``contexts``: the units around each remaining anchor are cut from the text,
   which moves compressed, and written once.
4. ``whole_spans``: the operator compares the contexts of a bucket of grams.
   ``split_spans``: a gram with over ``hot`` anchors is not gathered, and one
   with under ``thin`` windows an anchor on average (set by op7 alone, whose
   contexts are long) is not worth its contexts; each of their windows is a
   128-bit digest of its bytes (BLAKE2b) instead, counted with map-side
   combination.
5. ``spans_by_text``: the runs of repeated windows by text.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoengine.llm.common import as_bytes, byte_chunks, save

#: Bits that an anchor's place takes in the order of grams; a text is shorter.
_PLACE_BITS = 28


def _odd_numbers(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class PrefixHash:
    """Polynomial prefix hashes modulo 2**64 of a sequence of unit codes. Fast,
    but regular strings (as in a Thue-Morse pattern) collide under every base:
    for grouping and for comparisons that are verified, not for equality."""

    def __init__(self, codes: np.ndarray, seed: int) -> None:
        base = int(_odd_numbers(seed, 1)[0])
        n = len(codes)
        self.powers = _powers(base, n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(codes * self.powers[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """Hash of each run: equal runs have equal hashes, wherever they are."""
        return (self.sums[start + length] - self.sums[start]) * self.powers[len(self.sums) - 1 - start]

    def all(self, length: int) -> np.ndarray:
        """Hash of every run of ``length`` units."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return (self.sums[length:] - self.sums[:n]) * self.powers[::-1][:n]


_power_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i < n, doubled as needed."""
    table = _power_tables.get(base, np.ones(1, dtype=np.uint64))
    while len(table) < n:
        table = np.concatenate([table, table * np.uint64(pow(base, len(table), 1 << 64))])
        _power_tables[base] = table
    return table[:n]


def normalised(hashes: np.ndarray, total: int, base_seed: int) -> np.ndarray:
    """Hashes of a sequence of ``total`` units, made comparable with those of
    sequences of other lengths (the power they carry depends on it)."""
    base = int(_odd_numbers(base_seed, 1)[0])
    return hashes * np.uint64(pow(pow(base, -1, 1 << 64), total, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread hashes over all bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def group_runs(codes: np.ndarray, length: int, seed: int) -> np.ndarray:
    """A polynomial hash of every run of ``length`` codes, comparable across
    sequences; equal hashes need not be equal runs."""
    return mix(normalised(PrefixHash(codes, seed).all(length), len(codes), seed) + np.uint64(length))


_KEYS = _odd_numbers(64, 64)


def chained(state: np.ndarray, code: np.ndarray, seed: int) -> np.ndarray:
    """One step of a chain of hashes: a bijection of the state for each code and
    of the code for each state, without the linearity of a polynomial."""
    return mix(state * _KEYS[seed % 64] + mix(code ^ _KEYS[(seed + 1) % 64]))


def hash_runs(codes: np.ndarray, length: int, seed: int) -> np.ndarray:
    """A hash of every run of ``length`` codes, comparable across sequences."""
    n = max(0, len(codes) - length + 1)
    out = np.full(n, length, dtype=np.uint64)
    for i in range(length):
        out = chained(out, codes[i:i + n], seed)
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    span = 1
    out = x
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[:len(x) - width + 1], out[width - span:width - span + len(x) - width + 1])


def byte_codes(text: np.ndarray, seed: int = 1) -> np.ndarray:
    return _odd_numbers(seed, 256)[text]


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


#: Bytes of a word that are hashed eight at a time; longer words are digested.
_LONG_WORD = 64


def word_codes(text: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit code of each word, and the byte at which each begins. Words of
    one length up to eight bytes never share a code."""
    gap = np.concatenate([[True], _SPACE[text], [True]])
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edge[::2], edge[1::2]
    size = ends - starts
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)])
    # the eight bytes from each byte on, little end first
    eight = np.lib.stride_tricks.as_strided(padded, (len(text) + 1, 8), (1, 1))
    code = size.astype(np.uint64)
    at = np.arange(len(starts))
    for j in range(0, _LONG_WORD, 8):
        if j:
            at = at[size[at] > j]
        if not len(at):
            break
        part = np.ascontiguousarray(eight[starts[at] + j]).view("<u8").ravel()
        left = np.minimum(size[at] - j, 8).astype(np.uint64)
        part &= ~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * left)
        code[at] = chained(code[at], part, seed)
    whole = text.tobytes() if (size > _LONG_WORD).any() else b""
    for i in np.flatnonzero(size > _LONG_WORD).tolist():
        digest = hashlib.blake2b(whole[starts[i]:ends[i]], digest_size=8, key=seed.to_bytes(8, "little")).digest()
        code[i] = int.from_bytes(digest, "little")
    return code, starts


def _anchor_rows(codes: np.ndarray, window: int, gram: int, starts: np.ndarray, ends: np.ndarray) -> tuple:
    """Anchors of the documents [starts, ends) of a chunk: (document, key,
    place, first window, last window), places within the chunk."""
    empty = np.zeros(0, dtype=np.int64)
    if len(codes) < window:
        return empty, empty, empty, empty, empty
    if len(codes) >= 1 << _PLACE_BITS:
        raise ValueError(f"a text of over {(1 << _PLACE_BITS) - 1} units")
    grams = group_runs(codes, gram, 3)
    order = (grams >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(len(grams), dtype=np.uint64)
    least = sliding_min(order, window - gram + 1)
    place = (least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    counts = np.maximum(ends - starts - window + 1, 0)
    doc = np.repeat(np.arange(len(starts)), counts)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts)
    place = place[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1 if len(first) else first
    return doc[first], grams[place[first]].view(np.int64), place[first], at[first], at[last]


ANCHORS = ("doc_id {id}, text_key binary, class_key binary, n_units long, row long, "
           "keys array<long>, places array<int>, firsts array<int>, lasts array<int>")


def anchors(docs: DataFrame, window: int, gram: int, words: bool, id_type: str) -> DataFrame:
    """One row a document with its anchors; ``docs`` has doc_id and text.
    ``text_key`` names the text, ``class_key`` its units."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in byte_chunks(batches, "text", 1 << 20):
            texts = as_bytes(chunk.column("text"))
            joined = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
            ends = np.cumsum([len(t) + 1 for t in texts]) - 1
            starts = ends - [len(t) for t in texts]
            text_key = [hashlib.sha256(t).digest() for t in texts]
            if words:
                codes, at = word_codes(joined)
                starts, ends = np.searchsorted(at, starts), np.searchsorted(at, ends)
                class_key = [hashlib.sha256(b" ".join(t.split())).digest() for t in texts]
            else:
                codes, class_key = byte_codes(joined), text_key
            doc, key, place, first, last = _anchor_rows(codes, window, gram, starts, ends)
            cuts = pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32))
            own = starts[doc]
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (
                key, (place - own).astype(np.int32), (first - own).astype(np.int32), (last - own).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(text_key, pa.binary()), pa.array(class_key, pa.binary()),
                 pa.array(ends - starts, pa.int64()), chunk.column("row"), *lists],
                ["doc_id", "text_key", "class_key", "n_units", "row", "keys", "places", "firsts", "lasts"])

    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    return rows.mapInArrow(kernel, ANCHORS.format(id=id_type))


def candidates(found: DataFrame, hot: int, thin: int) -> tuple[DataFrame, DataFrame]:
    """(classes, candidates) of a saved ``anchors`` table. classes: (class_key,
    copies, n_units, row) with the row that stands for the class. candidates:
    (doc_id, text_key, row, key, split, place, first, last), one row for each
    anchor of such a row whose gram occurs twice or more; ``split`` if it has over
    ``hot`` anchors or under ``thin`` windows an anchor."""
    classes = found.groupBy("class_key").agg(F.count(F.lit(1)).alias("copies"), F.first("n_units").alias("n_units"),
                                             F.min("row").alias("row"))
    stand = found.where(F.size("keys") > 0).join(classes.select("row"), "row")
    each = stand.select("doc_id", "text_key", "row", F.explode(F.arrays_zip("keys", "places", "firsts", "lasts")).alias("a"))
    each = each.select("doc_id", "text_key", "row", F.col("a.keys").alias("key"), F.col("a.places").alias("place"),
                       F.col("a.firsts").alias("first"), F.col("a.lasts").alias("last"))
    shared = each.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("last") - F.col("first") + 1).alias("windows"))
    shared = shared.where("n > 1").select("key", ((F.col("n") > hot) | (F.col("windows") < F.lit(thin) * F.col("n"))).alias("split"))
    # joined from a table, not from the aggregation: a hot key's partition can
    # then be split between tasks
    return classes, each.join(save(shared, "shared-grams"), "key")


def packed_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, packed): texts compressed for the shuffle."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in byte_chunks(batches, "text", 2 << 20):
            texts = as_bytes(chunk.column("text"))
            squeeze = zstandard.ZstdCompressor(level=1).compress
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                 pa.array([squeeze(t) for t in texts], pa.binary())], ["doc_id", "text_key", "packed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(kernel, f"doc_id {kind}, text_key binary, packed binary")


def unpacked(packed: pa.Array) -> list[bytes]:
    expand = zstandard.ZstdDecompressor().decompress
    return [expand(x) for x in packed.to_pylist()]


def _window_digests(unit: bytes, window: int, words: bool) -> list[bytes]:
    """A 128-bit digest of the bytes of each window; words are joined by one
    space in ``unit``."""
    if words:
        gaps = np.flatnonzero(np.frombuffer(unit, dtype=np.uint8) == 0x20).tolist()
        starts, ends = [0, *[g + 1 for g in gaps]], [*gaps, len(unit)]
        cuts = zip(starts, ends[window - 1:])
    else:
        cuts = ((i, i + window) for i in range(len(unit) - window + 1))
    return [hashlib.blake2b(unit[a:b], digest_size=16).digest() for a, b in cuts]


CONTEXTS = "row long, first int, key long, lead int, units binary, digest binary"


def contexts(docs: DataFrame, cand: DataFrame, window: int, words: bool) -> DataFrame:
    """(row, first, key, lead, units) for each candidate: the units of its
    windows, as bytes; ``lead`` units stand before the gram. For candidates of
    split grams (row, first, digest) of each window instead."""
    items = cand.groupBy("doc_id", "text_key").agg(
        F.first("row").alias("row"), F.collect_list(F.struct("key", "split", "place", "first", "last")).alias("items"))
    texts = packed_texts(docs).withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    joined = texts.join(items, (F.col("_key") == F.col("text_key")) & F.col("_id").eqNullSafe(F.col("doc_id")))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in byte_chunks(batches, "packed", 512 << 10):
            lists = chunk.column("items")
            sizes = pc.list_value_length(lists).to_numpy()
            flat = lists.flatten()
            key, split, place, first, last = (flat.field(i) for i in range(5))
            owner = chunk.column("row").take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
            split, lead = split.to_numpy(zero_copy_only=False), pc.subtract(place, first)
            rows, units = zip(first.to_pylist(), last.to_pylist()), []
            for text, size in zip(unpacked(chunk.column("packed")), sizes.tolist()):
                parts = text.split() if words else text
                for _ in range(size):
                    a, b = next(rows)
                    units.append(b" ".join(parts[a:b + window]) if words else parts[a:b + window])
            whole = np.flatnonzero(~split)
            n = len(whole)
            at = pa.array(whole)
            yield pa.RecordBatch.from_arrays(
                [owner.take(at), first.take(at), key.take(at), lead.take(at), pa.array([units[i] for i in whole], pa.binary()),
                 pa.nulls(n, pa.binary())], ["row", "first", "key", "lead", "units", "digest"])
            thin = np.flatnonzero(split)
            for i in range(0, len(thin), 1000):
                some = thin[i:i + 1000]
                digests = [_window_digests(units[j], window, words) for j in some]
                n = np.array([len(d) for d in digests])
                begin = np.repeat(first.to_numpy()[some], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                total = int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [owner.take(pa.array(np.repeat(some, n))), pa.array(begin.astype(np.int32)), pa.nulls(total, pa.int64()),
                     pa.nulls(total, pa.int32()), pa.nulls(total, pa.binary()), pa.array([x for d in digests for x in d], pa.binary())],
                    ["row", "first", "key", "lead", "units", "digest"])

    return joined.select("packed", "row", "items").mapInArrow(kernel, CONTEXTS)


def whole_spans(rows: DataFrame, total: int, bucket_rows: int, kernel: Callable[[pa.Table], tuple]) -> DataFrame:
    """(row, start, end): the operator's ``kernel`` on buckets of grams. It
    returns arrays (context, start, end) of spans in units of the document."""
    n = max(1, math.ceil(total / bucket_rows))

    def run(table: pa.Table) -> pa.Table:
        context, start, end = kernel(table.combine_chunks())
        return pa.table({"row": table.column("row").combine_chunks().take(pa.array(context)),
                         "start": pa.array(start, pa.int64()), "end": pa.array(end, pa.int64())})

    whole = rows.where("key is not null").drop("digest").withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(n)).cast("int"))
    return whole.groupBy("bucket").applyInArrow(run, "row long, start long, end long")


def split_spans(rows: DataFrame, window: int) -> DataFrame:
    """(row, start, end) of repeated windows of split grams."""
    each = rows.where("key is null").select("row", F.col("first").cast("long").alias("start"), "digest")
    twice = save(each.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated-windows")
    return each.join(twice, "digest").select("row", "start", (F.col("start") + window).alias("end"))


def spans_by_text(found: DataFrame, classes: DataFrame, spans: DataFrame, window: int) -> DataFrame:
    """(text_key, spans): for each text with repeated windows the array of
    (start, end) in units, not merged; copies of a text are repeated whole."""
    whole = classes.where((F.col("copies") > 1) & (F.col("n_units") >= window)).select(
        "row", F.lit(0).cast("long").alias("start"), F.col("n_units").alias("end"))
    by_row = spans.unionByName(whole).groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    by_class = by_row.join(classes.select("row", "class_key"), "row")
    texts = found.groupBy("text_key").agg(F.first("class_key").alias("class_key"))
    return texts.join(by_class, "class_key").select("text_key", "spans")


def merged_runs(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs that the spans cover; touching ones are one run."""
    out: list[tuple[int, int]] = []
    for s, e in sorted((x["start"], x["end"]) for x in spans or ()):
        if out and s <= out[-1][1]:
            if e > out[-1][1]:
                out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


def repeated_spans(docs: DataFrame, window: int, gram: int, words: bool, hot: int, bucket_rows: int,
                   kernel: Callable[[pa.Table], tuple], thin: int = 0) -> DataFrame:
    """(text_key, spans) of the texts of ``docs`` (doc_id, text)."""
    found = save(anchors(docs, window, gram, words, docs.schema["doc_id"].dataType.simpleString()), "anchors")
    classes, cand = candidates(found, hot, thin)
    cand = save(cand, "candidates")
    counts = {r["split"]: r["count"] for r in cand.groupBy("split").count().collect()}  # two rows at most
    rows = save(contexts(docs, cand, window, words), "contexts")
    if found.groupBy("doc_id", "text_key").count().where("count > 1").limit(1).count():
        rows = rows.dropDuplicates(["row", "first"])  # repeated rows bring their windows again
    spans = whole_spans(rows, counts.get(False, 0), bucket_rows, kernel)
    if counts.get(True):
        spans = spans.unionByName(split_spans(rows, window))
    return save(spans_by_text(found, classes, spans, window), "spans")


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The documents with their text's spans (null: none)."""
    key = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    return docs.withColumn("__text_key", key).join(
        spans.withColumnRenamed("text_key", "__text_key").withColumnRenamed("spans", "__spans"), "__text_key", "left").drop("__text_key")


def packed_with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, packed, spans) of (doc_id, text): the text moves compressed."""
    return packed_texts(docs).join(spans, "text_key", "left").select("doc_id", "packed", "spans")
