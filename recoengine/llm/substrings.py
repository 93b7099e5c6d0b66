"""Substring dedup on words by super-k-mer partitioning.

Consecutive 35-word windows with the same minimiser travel as one packed string
(a super-k-mer) to the bucket of that minimiser. There all windows are sorted
by prefix doubling over word numbers: ranks of 1, 2, 4, ... 32 words and then
of two overlapping runs for the whole window. Equal ranks are equal windows,
without hashing. Only a minimiser with over ``HOT`` anchors is split instead:
its windows are counted as 128-bit digests of their bytes. Every word
under a window found twice goes.

Minimisers seen once, and copies of a document, are settled on narrow rows
before any text moves (see ``windows``).

Defined results: a null text has no words; a text of fewer words than a window
stays whole; texts with the same words are repeats of each other whatever
their ids; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from recoengine.llm.common import as_bytes, byte_chunks, table
from recoengine.llm.windows import merged_runs, packed_with_spans, repeated_spans, unpacked

WINDOW = 35
GRAM = 8
#: Anchors of a minimiser over which it is split by window.
HOT = 65_536
BUCKET_ROWS = 8192


def window_ranks(ids: np.ndarray, window: int) -> np.ndarray:
    """Rank of each run of ``window`` ids among all of them, by sorting."""
    rank, span = ids, 1
    while 2 * span <= window:
        rank = _pair(rank[:-span], rank[span:])
        span *= 2
    n = len(ids) - window + 1
    return _pair(rank[:n], rank[window - span:window - span + n])


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.unique(a.astype(np.int64) * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]


def _kernel(window: int):
    def kernel(rows: pa.Table) -> tuple:
        packed = [u.split(b" ") for u in as_bytes(rows.column("units").combine_chunks())]
        sizes = np.array([len(p) for p in packed], dtype=np.int64)
        numbers: dict[bytes, int] = {}
        ids = np.array([numbers.setdefault(w, len(numbers)) for p in packed for w in p], dtype=np.int64)
        rank = window_ranks(ids, window)
        counts = sizes - window + 1  # a packed string holds a window at least
        row = np.repeat(np.arange(len(packed)), counts)
        step = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        mine = rank[np.repeat(np.cumsum(sizes) - sizes, counts) + step]
        twice = np.bincount(mine, minlength=int(rank.max(initial=0)) + 1)[mine] > 1
        row, step = row[twice], step[twice]
        new = np.ones(len(row), dtype=bool)  # runs of neighbouring windows
        new[1:] = (row[1:] != row[:-1]) | (step[1:] != step[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(row)) - 1 if len(first) else first
        begin = rows.column("first").to_numpy().astype(np.int64)[row[first]]
        return row[first], begin + step[first], begin + step[last] + window

    return kernel


def repeated_word_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT,
                        bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(text_key, spans): the word spans under windows that start elsewhere too."""
    return repeated_spans(docs, window, gram, True, hot, bucket_rows, _kernel(window))


def remove_repeated_words(docs: DataFrame, **params) -> DataFrame:
    """One row a document: (doc_id, n_words, n_removed, kept, kept_sha256), kept
    being the remaining words joined by one space."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in byte_chunks(batches, "packed", 1 << 20):
            total, removed, kept = [], [], []
            for text, spans in zip(unpacked(chunk.column("packed")), chunk.column("spans").to_pylist()):
                words = text.split()
                runs = merged_runs(spans)
                total.append(len(words))
                removed.append(sum(e - s for s, e in runs))
                for s, e in reversed(runs):
                    del words[s:e]
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])],
                ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return packed_with_spans(docs, repeated_word_spans(docs, **params)).mapInArrow(
        cut, f"doc_id {kind}, n_words long, n_removed long, kept string, kept_sha256 string")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_words(table(spark, sf_dir, "documents")).drop("kept")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS k FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
often AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM windows SEMI JOIN often USING (k)),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (r, p) GROUP BY r),
lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN lost USING (r)
"""
