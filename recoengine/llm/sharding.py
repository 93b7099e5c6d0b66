"""Global shuffle into shards by a two-pass external shuffle.

Pass 1 scatters the rows uniformly, by a seeded hash of id and text, into
buckets of a size that a task holds in memory. Where rows of one id and text
have a good part of a bucket's bytes, they are numbered and scattered by their
number too. Pass 2 shuffles each bucket by
Fisher-Yates with a generator seeded by the bucket and deals its rows to the
shards in turn, going on where the bucket before it stopped. So the buckets in
order are one random permutation, and the shards' counts differ by one at most.

Where each bucket begins in the permutation is a table, summed in two steps, that
meets its bucket's rows in the task; nothing that grows with the buckets reaches
the driver.

Defined results: a null text has no bytes; equal rows stay separate rows, in any
order among themselves; a text of any length stays whole, in its bucket; an empty
table gives no rows; further columns travel with their row, but input columns
named shard or slot give way to the result's.
"""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recoengine.llm.common import save, table, text_bytes
from recoengine.session import scratch_path

SHARDS = 24
SEED = 8
#: Bytes of text that a bucket holds on average.
BUCKET_BYTES = 16 << 20
#: Heavy hashes that are broadcast, at most.
FEW = 100_000
#: Share of a bucket's bytes above which rows of one id and text are spread.
SPREAD = 1 / 8


def fisher_yates(n: int, rng: random.Random) -> np.ndarray:
    order = list(range(n))
    for i in range(n - 1, 0, -1):
        j = rng.randrange(i + 1)
        order[i], order[j] = order[j], order[i]
    return np.array(order, dtype=np.int64)


def _deal(shards: int, seed: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def deal(rows: pa.Table, start: pa.Table) -> pa.Table:
        bucket = rows.column("__bucket")[0].as_py()
        rows = rows.sort_by([("__hash", "ascending")])
        rows = rows.take(pa.array(fisher_yates(rows.num_rows, random.Random(f"{seed}:{bucket}"))))
        place = start.column("__start")[0].as_py() + np.arange(rows.num_rows, dtype=np.int64)
        rows = rows.drop_columns(["__bucket", "__hash"])
        return (rows.append_column("shard", pa.array((place % shards).astype(np.int32)))
                .append_column("slot", pa.array(place // shards)))

    return deal


#: Buckets whose counts are summed together.
GROUP = 4096


def _starts(counts: DataFrame) -> DataFrame:
    """(__at, __start) of (__bucket, n): the rows of all buckets before."""
    grouped = save(counts.withColumn("group", F.floor(F.col("__bucket") / GROUP).cast("int")), "bucket-counts")
    whole = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)  # a row for each GROUP buckets
    groups = grouped.groupBy("group").agg(F.sum("n").alias("n")).select("group", F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("before"))
    within = Window.partitionBy("group").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    own = grouped.withColumn("own", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return own.join(groups, "group").select(F.col("__bucket").alias("__at"), (F.col("before") + F.col("own")).alias("__start"))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task and each row's number among the task's rows of its hash."""
    task, seen = TaskContext.get().partitionId(), Counter()
    for b in batches:
        at = []
        for h in b.column("__hash").to_pylist():
            at.append(seen[h])
            seen[h] += 1
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(at), task, dtype=np.int32)), pa.array(at, pa.int64())],
                                         [*b.schema.names, "__task", "__at"])


def _spread(rows: DataFrame, heavy: DataFrame, seed: int) -> DataFrame:
    """The rows, those of ``heavy`` hashes with a hash of their own: they are
    counted by task, and each takes a number from 0 on among its equals."""
    heavy = F.broadcast(heavy) if heavy.count() <= FEW else heavy
    numbered = T.StructType([*rows.schema, T.StructField("__task", T.IntegerType()), T.StructField("__at", T.LongType())])
    equals = save(rows.join(heavy, "__hash", "left_semi").select(rows.columns).mapInArrow(_numbered, numbered), "equal-rows")
    counts = equals.groupBy("__hash", "__task").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__hash").orderBy("__task")) - F.col("__n")
    first = counts.select("__hash", "__task", before.alias("__first"))
    own = equals.join(save(first, "equal-starts"), ["__hash", "__task"]).withColumn(
        "__hash", F.xxhash64(F.lit(seed), F.col("__hash"), F.col("__first") + F.col("__at")))
    return rows.join(heavy, "__hash", "left_anti").select(rows.columns).unionByName(own.select(rows.columns))


def shard(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES,
          id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows as Parquet to ``path``, a folder for each shard; ``slot``
    numbers a shard's rows from 0."""
    hashed = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(id_col).isNull(), F.col(text_col))
    # a count and a sum: the number of buckets follows the bytes
    size = docs.agg(F.sum(text_bytes(text_col) + 64)).first()[0] or 0
    n = max(1, math.ceil(size / bucket_bytes))
    rows = docs.withColumn("__hash", hashed)
    sizes = rows.groupBy("__hash").agg(F.count(F.lit(1)).alias("n"), F.sum(text_bytes(text_col) + 64).alias("bytes"))
    heavy = save(sizes.where((F.col("n") > 1) & (F.col("bytes") > SPREAD * bucket_bytes)).select("__hash"), "heavy-rows")
    if n > 1 and heavy.limit(1).count():
        rows = _spread(rows, heavy, seed)
    rows = rows.withColumn("__bucket", F.pmod(F.col("__hash"), F.lit(n)).cast("int"))
    starts = save(_starts(rows.groupBy("__bucket").agg(F.count(F.lit(1)).alias("n"))), "bucket-starts")
    schema = T.StructType([f for f in docs.schema if f.name not in ("shard", "slot")])
    rows = rows.drop(*[c for c in ("shard", "slot") if c in docs.columns])
    out = T.StructType([*schema, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    dealt = rows.groupBy("__bucket").cogroup(starts.groupBy("__at")).applyInArrow(_deal(shards, seed), out)
    dealt.write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    schema = T.StructType([f for f in schema if f.name not in ("shard", "slot")])
    return spark.read.schema(T.StructType([*schema, T.StructField("slot", T.LongType()),
                                           T.StructField("shard", T.IntegerType())])).parquet(path)


def op8_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_path(spark, "shards")
    shard(docs, path)
    text = F.coalesce(F.col("text"), F.lit(""))
    return read_shards(spark, path, docs.schema).select(
        "doc_id", (text_bytes("text") + 8).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
