"""Token ids in ORC files.

Documents are range-partitioned by id, encoded, and written by Spark's ORC
writer: ids as integer runs (ORC's run-length encoding), with row indexes and
a Bloom filter on the document id, so that a reader splits the files by stripe
and skips the stripes and row groups that can't hold the ids it asks for. Each
file carries its ``part`` number, and ``local_start`` counts tokens from the
part's start; the parts' token totals, one row a file, give the global start.

Defined results: a null or empty text is the end id alone; null ids come
first; rows with equal ids are each kept, in order of their text's hash; an
empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recoengine.llm.common import byte_chunks, shuffle_partitions, table
from recoengine.llm.tokens import default_tokenizer, encoder
from recoengine.session import scratch_path

STORED = "doc_id long, part int, local_start long, n_tokens int, ids array<int>"
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "10000",
    "orc.stripe.size": str(16 << 20),
}


def write_token_ids(docs: DataFrame, path: str, tokenizer: str | None = None, parts: int | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> None:
    tokenizer = tokenizer or default_tokenizer()
    parts = parts or shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(parts, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, enc = TaskContext.get().partitionId(), 0, encoder(tokenizer)
        for chunk in byte_chunks(batches, "text", 8 << 20, keep_units=True):
            found = enc(chunk.column("text").to_pylist())
            sizes = np.array([len(x) // 4 for x in found], dtype=np.int64)
            ends = np.cumsum(sizes)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                                           pa.array(np.frombuffer(b"".join(found), dtype="<u4").astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(np.full(len(found), part, dtype=np.int32)),
                 pa.array(at + ends - sizes), pa.array(sizes.astype(np.int32)), ids],
                ["doc_id", "part", "local_start", "n_tokens", "ids"])
            at += int(ends[-1])

    rows.mapInArrow(encode, STORED).write.options(**ORC_OPTIONS).orc(path)


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, part_start): one row a file, from the files' counts alone."""
    totals = spark.read.schema(STORED).orc(path).groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    return totals.select("part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("part_start"))


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids); a filter on doc_id reaches the files."""
    stored = spark.read.schema(STORED).orc(path)
    # the parts are as many as the files: bounded by the writer's partitions
    starts = F.broadcast(part_starts(spark, path))
    return stored.join(starts, "part").select(
        "doc_id", (F.col("part_start") + F.col("local_start")).alias("start"),
        F.col("n_tokens").cast("long").alias("n_tokens"), "ids")


def ids_crc32(stored: DataFrame) -> DataFrame:
    """Adds the crc32 of the ids as little-endian unsigned 32-bit integers."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("ids")
            raw = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            at = 4 * np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
            view = memoryview(raw.tobytes())
            crc = [zlib.crc32(view[s:e]) for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n_tokens"),
                                              pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return stored.mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "token-ids")
    write_token_ids(docs, path)
    return ids_crc32(read_token_ids(spark, path))
