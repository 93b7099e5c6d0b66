"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recoengine.llm import tokens
from recoengine.session import prepare, scratch_path

#: A word: a run of characters that are not space, tab, line feed, vertical
#: tab, form feed or carriage return. ``bytes.split()`` splits alike.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, so a lost
    executor costs no more than the tasks of the step that runs."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(col: str | Column) -> Column:
    """Size of a text in UTF-8 bytes; null counts 0."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.octet_length(c), F.lit(0)).cast("long")


def byte_chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = 16 << 20,
                keep_units: bool = False) -> Iterator[pa.RecordBatch]:
    """The batches cut so that no chunk holds more than ``limit`` bytes of
    ``column`` (one row at least): bounds what a kernel keeps at once. A worker
    serves task after task: unless ``keep_units`` the token units that an
    earlier stage kept are dropped, and free memory is given back at the end."""
    if not keep_units:
        tokens.forget()
    for batch in batches:
        start, used = 0, 0
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for i, n in enumerate(sizes):
            if i > start and used + n > limit:
                yield batch.slice(start, i - start)
                start, used = i, 0
            used += n
        if batch.num_rows > start:
            yield batch.slice(start)
    pa.default_memory_pool().release_unused()


def as_bytes(array: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null as empty."""
    return [x or b"" for x in array.cast(pa.binary()).to_pylist()]
