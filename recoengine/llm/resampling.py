"""Importance resampling of documents towards a target text collection.

Features are all runs of one to three consecutive words, counted in hashed
buckets. A document's weight is the sum of its features' gains, the log ratio of
a bucket's smoothed share in the target to that in the documents; Gumbel noise
drawn from the id turns the highest scores into a sample without replacement.

Overlapped regex scanning: separators collapse to single spaces, then one
pattern whose lookarounds stand on word borders is run with ``overlapped=True``;
each match begins at a word and its groups end the runs of one, two and three
words there, so the spans come straight from the scan. The CRCs of a block of
spans are combined in numpy from those of their words. A document's buckets are
stored once as 16-bit numbers; counting and weighing read them from the table.

Defined results: a text that is null or has no word has no features, weight 0
and the noise as its score; a null id is an empty string in the noise and comes
first among ties; rows with equal ids are drawn each, rows that are equal in
score and id in any order; very long texts are scanned in blocks of ``BLOCK``
matches (a text of n bytes needs about 15 n bytes); empty tables give no rows,
and with an empty target all gains come from the smoothing; ``drawn_documents``
keeps further columns, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recoengine.llm.common import as_bytes, byte_chunks, save, shuffle_partitions, table

BUCKETS = 10_000
NGRAM = 3
MIN_WORDS = 20
#: Share of the documents with enough words that is drawn, in percent.
PERCENT = 5
SEED = 42
#: Matches that are scanned and hashed at once.
BLOCK = 1 << 16
#: Longest word whose CRC is combined by table.
TABLED = 64

#: What separates words: ASCII other than letters and digits.
SEPARATORS = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: One match a word; groups 0, 1 and 2 end the runs of one, two and three
#: words. Texts stand on lines of their own, so no run leaves its text.
RUNS = regex.compile(rb"(?<![^ \n])[^ \n]+(?= ([^ \n]+)(?: ([^ \n]+))?|(?![^ \n]))")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1)
    return out


_STEP = _crc_table()


def _shift_tables() -> np.ndarray:
    """(length, place, byte): what a CRC's byte becomes as so many bytes follow."""
    out = np.empty((TABLED + 1, 4, 256), dtype=np.uint32)
    byte = np.arange(256, dtype=np.uint32)
    for place in range(4):
        state = byte << np.uint32(8 * place)
        for length in range(TABLED + 1):
            out[length, place] = state
            state = _STEP[state & 0xFF] ^ (state >> 8)
    return out


_SHIFT = _shift_tables()


def _extended(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What the CRCs contribute once ``length`` more bytes follow."""
    t = _SHIFT
    return (t[length, 0, crc & 0xFF] ^ t[length, 1, (crc >> 8) & 0xFF]
            ^ t[length, 2, (crc >> 16) & 0xFF] ^ t[length, 3, crc >> 24])


def _space(crc: np.ndarray) -> np.ndarray:
    state = crc ^ np.uint32(0xFFFFFFFF)
    return _STEP[(state ^ 0x20) & 0xFF] ^ (state >> 8) ^ np.uint32(0xFFFFFFFF)


def _word_crcs(text: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC of each word: the same byte of all words at a time, longest first."""
    data = np.frombuffer(text, dtype=np.uint8)
    order = np.argsort(-size, kind="stable")
    begin, length = start[order], size[order]
    state = np.full(len(start), 0xFFFFFFFF, dtype=np.uint32)
    for j in range(TABLED):
        n = np.searchsorted(-length, -(j + 1), side="right")  # words of more than j bytes
        if not n:
            break
        state[:n] = _STEP[(state[:n] ^ data[begin[:n] + j]) & 0xFF] ^ (state[:n] >> 8)
    out = np.empty_like(state)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > TABLED).tolist():
        out[i] = zlib.crc32(memoryview(text)[int(start[i]):int(start[i] + size[i])])
    return out


def _span_crcs(text: bytes, spans: np.ndarray) -> np.ndarray:
    """Unsigned CRCs of all runs in rows (start, end of one word, of two, of
    three; -1 if there is none). The rows are matches that follow each other, so
    the later words of a run are those of the next rows; only the last row's
    stand outside."""
    start, *ends = spans.T
    begin, size = start, ends[0] - start
    for before, after in ((ends[0][-1], ends[1][-1]), (ends[1][-1], ends[2][-1])):
        if after >= 0:
            begin, size = np.append(begin, before + 1), np.append(size, after - before - 1)
    word = _word_crcs(text, begin, size)
    run = word[:len(start)]
    out = [run]
    for k, end in enumerate(ends[1:], 1):
        has = np.flatnonzero(end >= 0)
        longer = np.zeros(len(start), dtype=np.uint32)
        longer[has] = _extended(_space(run[has]), np.minimum(size[has + k], TABLED)) ^ word[has + k]
        for i in has[size[has + k] > TABLED].tolist():
            longer[i] = zlib.crc32(memoryview(text)[int(start[i]):int(end[i])])
        run = longer
        out.append(run[has])
    return np.concatenate(out)


def scan(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, features of each, buckets of all features, text by
    text)."""
    lines = [SEPARATORS.sub(b" ", t.translate(LOWER)).strip(b" ") for t in texts]
    last = np.cumsum([len(x) + 1 for x in lines])
    joined = b"\n".join(lines)
    found = RUNS.finditer(joined, overlapped=True)
    words = np.zeros(len(texts), dtype=np.int64)
    owners, buckets = [], []
    while block := [(m.start(), m.end(), m.end(1), m.end(2)) for m in islice(found, BLOCK)]:
        spans = np.array(block, dtype=np.int64)
        owner = np.searchsorted(last, spans[:, 0], side="right").astype(np.int32)
        words += np.bincount(owner, minlength=len(texts))
        owners += [owner, owner[spans[:, 2] >= 0], owner[spans[:, 3] >= 0]]
        buckets.append((_span_crcs(joined, spans) % np.uint32(BUCKETS)).astype(np.uint16))
    if not owners:
        return words, words, np.zeros(0, dtype=np.uint16)
    owner = np.concatenate(owners)
    return words, np.bincount(owner, minlength=len(texts)), np.concatenate(buckets)[np.argsort(owner, kind="stable")]


def features(docs: DataFrame, *keep: str) -> DataFrame:
    """(keep..., n_words, n_features, buckets) of rows with a text; buckets are
    compressed 16-bit numbers."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for chunk in byte_chunks(batches, "text", 4 << 20):
            words, size, buckets = scan(as_bytes(chunk.column("text")))
            packed = [squeeze(b.tobytes()) for b in np.split(buckets, np.cumsum(size)[:-1])]
            yield pa.RecordBatch.from_arrays(
                [*[chunk.column(c) for c in keep], pa.array(words), pa.array(size), pa.array(packed, pa.binary())],
                [*keep, "n_words", "n_features", "buckets"])

    ddl = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select(*keep, "text").mapInArrow(kernel, f"{ddl}n_words long, n_features long, buckets binary")


def _bucket_lists(packed: pa.Array) -> Iterator[np.ndarray]:
    expand = zstandard.ZstdDecompressor().decompress
    for x in packed:
        yield np.frombuffer(expand(x.as_py()), dtype=np.uint16)


def bucket_counts(found: DataFrame) -> np.ndarray:
    """How often each bucket occurs: tasks add up, at most ``BUCKETS`` rows reach the driver."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for b in batches:
            for x in _bucket_lists(b.column("buckets")):
                total += np.bincount(x, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    sums = found.select("buckets").mapInArrow(kernel, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, dtype=np.int64)
    for r in sums.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket, in thousandths."""
    s, t = int(documents.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((int(b) + 1) * (s + BUCKETS) / ((int(a) + 1) * (t + BUCKETS))))
                     for a, b in zip(documents, target)], dtype=np.int64)


def noise(key: object, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, from the id alone."""
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(found: DataFrame, gain: np.ndarray, key: str = "doc_id") -> DataFrame:
    """The rows of ``features`` with weight and score in place of the buckets."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            weight = [int(gain[x].sum()) for x in _bucket_lists(b.column("buckets"))]
            score = [w + noise(k) for w, k in zip(weight, b.column(key).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(key), b.column("n_words"), b.column("n_features"), pa.array(weight, pa.int64()),
                 pa.array(score, pa.int64()), b.column("row")], [key, "n_words", "n_features", "weight", "score", "row"])

    kind = found.schema[key].dataType.simpleString()
    return found.select(key, "n_words", "n_features", "buckets", "row").mapInArrow(
        kernel, f"{key} {kind}, n_words long, n_features long, weight long, score long, row long")


def highest(scored: DataFrame, key: str, percent: int, min_words: int) -> DataFrame:
    """(row, rank) of the drawn rows of a saved table: range partitions of
    (score, id, row) are numbered each and shifted by what stands before them,
    so no task orders more than its range."""
    spark = scored.sparkSession
    enough = scored.where(F.col("n_words") >= min_words).select(key, "score", "row")
    take = enough.count() * percent // 100
    order = [F.col("score").desc(), F.col(key).asc_nulls_first(), F.col("row").asc()]
    parts = save(enough.repartitionByRange(shuffle_partitions(spark), *order).withColumn("part", F.spark_partition_id()), "ranges")
    # one row a range
    before = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "before", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    wanted = before.select("part", F.coalesce("before", F.lit(0)).alias("before")).where(F.col("before") < take)
    ranked = parts.join(F.broadcast(wanted), "part").withColumn(
        "rank", F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order)))
    return ranked.where(F.col("rank") <= take).select("row", "rank")


def resampled(docs: DataFrame, target: DataFrame, key: str = "doc_id", percent: int = PERCENT,
              min_words: int = MIN_WORDS) -> DataFrame:
    """(key, n_words, n_features, weight, score, rank): rank is null where not drawn."""
    found = save(features(docs, key).withColumn("row", F.monotonically_increasing_id()), "features")
    gain = gains(bucket_counts(found), bucket_counts(features(target)))
    scored = save(scores(found, gain, key), "scores")
    return scored.join(highest(scored, key, percent, min_words), "row", "left").drop("row")


def drawn_documents(docs: DataFrame, target: DataFrame, key: str = "doc_id", percent: int = PERCENT,
                    min_words: int = MIN_WORDS) -> DataFrame:
    """The drawn rows with all their columns, as they were."""
    number = next(n for i in range(len(docs.columns) + 1) if (n := f"_number{i}") not in docs.columns)
    numbered = save(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = save(features(numbered.select(key, "text", F.col(number).alias("row")), key, "row"), "features")
    gain = gains(bucket_counts(found), bucket_counts(features(target)))
    drawn = highest(save(scores(found, gain, key), "scores"), key, percent, min_words)
    return numbered.join(drawn.select(F.col("row").alias(number)), number).select(*docs.columns)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))


#: CRCs by table over the bytes of each distinct feature; numbers are 64-bit so
#: that nothing overflows.
ORACLE = r"""
WITH RECURSIVE step(i, k, c) AS (
  SELECT i, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM step WHERE k = 8),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
target AS (
  SELECT regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
doc_features AS (
  SELECT r, unnest(flatten(list_transform([1, 2, 3], lambda n: list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))))) AS f
  FROM docs WHERE len(w) > 0),
target_features AS (
  SELECT unnest(flatten(list_transform([1, 2, 3], lambda n: list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))))) AS f
  FROM target WHERE len(w) > 0),
bytes AS (
  SELECT f, list_transform(range(1, 2 * octet_length(encode(f)) + 1, 2), lambda i: ('0x' || hex(encode(f))[i:i + 1])::BIGINT) AS b
  FROM (SELECT f FROM doc_features UNION SELECT f FROM target_features)),
buckets AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, crc_table),
s AS (SELECT bucket, count(*) AS n FROM doc_features JOIN buckets USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM target_features JOIN buckets USING (f) GROUP BY bucket),
gain AS (
  SELECT b AS bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM s), 0) + 10000)::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS g
  FROM range(10000) x(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b),
weighed AS (SELECT r, count(*) AS n, sum(g)::BIGINT AS w FROM doc_features JOIN buckets USING (f) JOIN gain USING (bucket) GROUP BY r),
scored AS (
  SELECT docs.r, doc_id, len(docs.w) AS words, coalesce(n, 0) AS n_features, coalesce(weighed.w, 0) AS weight,
    (coalesce(weighed.w, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
  FROM docs LEFT JOIN weighed USING (r)),
drawn AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, r) AS rank FROM scored WHERE words >= 20
  QUALIFY rank <= (SELECT count(*) * 5 // 100 FROM scored WHERE words >= 20))
SELECT doc_id, n_features, weight, score, rank FROM scored LEFT JOIN drawn USING (r)
"""
