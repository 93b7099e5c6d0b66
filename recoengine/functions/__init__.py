"""Scalar column functions (all built-in Spark expressions, codegen'd)."""

from recoengine.functions.scalar import (  # noqa: F401
    JAVA_WHITESPACE,
    cosine,
    dot,
    encode_recs,
    epoch_seconds,
    java_trim,
    log2_at_least_one,
    register_sql_functions,
    year_month,
)
