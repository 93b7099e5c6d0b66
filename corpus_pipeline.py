"""The corpus pipeline: five operators in a row over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's ``docs``. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recoengine.llm import minhash, mixing, packing, quality, suffixes
from recoengine.llm.common import save, table
from recoengine.session import prepare


#: Bytes of the strings that the suffix-array stage cuts where they repeat: a
#: passage of 50 words has about this many or more.
REPEAT_BYTES = 200


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return minhash.one_of_each(docs)


def cut(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return suffixes.without_repeats(docs, window=REPEAT_BYTES)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("quality rules", good),
    ("MinHash near-dedup", distinct),
    ("suffix-array dedup", cut),
    ("mixing sources", mixed),
    ("packing", packed),
]

#: The quality trees and the packing can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), "stage")
    return docs
