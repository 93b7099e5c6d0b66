"""Scalar helpers: trimming, epoch and calendar conversion, list encoding,
vector arithmetic on array columns. Everything stays JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Java's String.trim strips every char <= U+0020; Spark's trim only spaces.
JAVA_WHITESPACE = "".join(chr(c) for c in range(0x00, 0x21))


def java_trim(c: Column | str) -> Column:
    """Trim like ``String.trim`` so "\\t12\\r" still parses."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(JAVA_WHITESPACE))


def epoch_seconds(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Whole epoch seconds of a timestamp column.

    Parquet timestamps without zone arrive as TIMESTAMP_NTZ; their epoch
    is taken zone-independently. Zoned timestamps use ``unix_seconds``.
    """
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col)
    return F.unix_seconds(col.cast("timestamp"))


def year_month(seconds: Column | str) -> Column:
    """Epoch seconds -> 'yyyyMM' in the session zone (pinned to UTC)."""
    col = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.date_format(F.timestamp_seconds(col), "yyyyMM")


def register_sql_functions(spark: SparkSession) -> None:
    """SQL-visible ``changeDate(bigint) -> string`` as a SQL function, so
    SQL text written against it keeps working and stays codegen'd."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION changeDate(x BIGINT) RETURNS STRING "
        "RETURN date_format(timestamp_seconds(x), 'yyyyMM')"
    )


def encode_recs(recs: Column | str) -> Column:
    """array<struct<mid,r>> -> 'mid:r|mid:r' ('' for an empty list)."""
    col = F.col(recs) if isinstance(recs, str) else recs
    return F.concat_ws(
        "|",
        F.transform(col, lambda x: F.concat(x["mid"].cast("string"), F.lit(":"), x["r"].cast("string"))),
    )


def dot(a: Column, b: Column) -> Column:
    """Dot product of two equal-length numeric arrays (double precision)."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0).cast("double"),
        lambda acc, v: acc + v,
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null (not NaN) when a norm is zero."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def log2_at_least_one(n: Column) -> Column:
    """log2(n) with a missing/zero counter read as 1 (log2(1) = 0)."""
    return F.log2(F.greatest(n.cast("double"), F.lit(1.0)))

