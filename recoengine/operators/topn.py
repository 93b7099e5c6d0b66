"""Top-N per group and nested result lists.

``row_number() <= n`` over a window is planned by Spark as a partial
``WindowGroupLimit`` before the shuffle and a final one after it, so a
hot group (one genre holding a third of all movies) is cut to n rows per
map task before anything moves across the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                    rank_col: str = "rank") -> DataFrame:
    """Keep the first ``n`` rows of each group under a total ``order``;
    adds a 1-based ``rank_col``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def nest(df: DataFrame, keys: Sequence[str], rank_col: str, item_col: str, value_col: str,
         out_col: str = "recs", item_name: str = "mid", value_name: str = "r") -> DataFrame:
    """Flat ranked rows -> one row per key with ``array<struct<mid, r>>``
    ordered by rank. Input groups are already bounded by ``top_n_per_group``."""
    packed = F.sort_array(F.collect_list(F.struct(F.col(rank_col).alias("_k"),
                                                  F.col(item_col).alias(item_name),
                                                  F.col(value_col).alias(value_name))))
    return df.groupBy(*keys).agg(
        F.transform(packed, lambda s: F.struct(s[item_name].alias(item_name),
                                               s[value_name].alias(value_name))).alias(out_col)
    )


def flatten(df: DataFrame, keys: Sequence[str], list_col: str = "recs",
            rank_col: str = "rank") -> DataFrame:
    """Nested lists back to flat (key..., rank, mid, r) rows."""
    e = df.select(*keys, F.posexplode(list_col).alias("_pos", "_rec"))
    return e.select(*keys, (F.col("_pos") + 1).alias(rank_col),
                    F.col("_rec.mid").alias("mid"), F.col("_rec.r").alias("r"))


def with_place(ordered: DataFrame, path: str, place_col: str = "place") -> DataFrame:
    """The rows of an ordered frame with their place in it, from 1 on. The frame
    is written to ``path`` once with each row's partition and number; what stands
    before a partition is summed from one row a partition."""
    ordered.withColumn("_pos", F.monotonically_increasing_id()).write.parquet(path)
    rows = ordered.sparkSession.read.parquet(path).withColumn("_part", F.shiftright("_pos", 33))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    number = F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return rows.join(before, "_part").select(*ordered.columns, (F.col("_before") + number).alias(place_col))
