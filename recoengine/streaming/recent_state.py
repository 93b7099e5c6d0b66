"""Recent ratings as stream state (S7): the newest ratings of each user, kept by
the stream itself in place of a list store.

``applyInPandasWithState`` holds at most 21 ratings a user in the state store
(RocksDB, checkpointed with the stream), the users of a hash bucket under one key.
New ratings are merged in, late ones find their place, and the whole lists of the
batch's users go out; the sink keeps the latest list of each user. A timeout drops
users that stay idle for ``idle_ms``; a user who returns later starts a new list.
With timeouts the stream runs on without new data, so ``availableNow`` needs
``idle_ms=None``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from recoengine.sources.sinks import read_upserted, upsert_by_uid
from recoengine.streaming.recommender import RECENT_RATINGS, TRIGGER_INTERVAL, _batch_key

PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Keys of the state store: users share one by hash, and a batch rewrites those it meets.
STATE_BUCKETS = 1024
LISTS = "uid int, items array<struct<mid:int,score:double>>, newest long"


def _merge(keep: int, idle_ms: int | None):
    """The function of one bucket and batch. State and rows of many buckets travel
    in one Arrow batch, and the users of a bucket are merged at once: a user costs
    no call of its own."""
    row = np.dtype([("uid", "<i4"), ("timestamp", "<i8"), ("mid", "<i4"), ("score", "<f8"), ("until", "<i8")])

    def first(rows: np.ndarray) -> np.ndarray:
        """The ``keep`` newest of each user, by uid and falling (timestamp, mid, score)."""
        rows = rows[np.lexsort((rows["score"], rows["mid"], rows["timestamp"]))[::-1]]
        rows = rows[np.argsort(rows["uid"], kind="stable")]
        begin = np.flatnonzero(np.r_[True, rows["uid"][1:] != rows["uid"][:-1]])
        place = np.arange(len(rows)) - np.repeat(begin, np.diff(np.r_[begin, len(rows)]))
        return rows[place < keep]

    def merge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = np.frombuffer(bytearray(state.get[0]), dtype=row) if state.exists else np.zeros(0, dtype=row)
        came = np.zeros(0, dtype="<i4")
        now = state.getCurrentProcessingTimeMs() if idle_ms else 0
        if not state.hasTimedOut:
            for frame in frames:  # a bucket's batch may be long: never more than the lists and one frame
                new = np.zeros(len(frame), dtype=row)
                for name in ("uid", "timestamp", "mid"):
                    new[name] = frame[name].astype("int64")  # raises on nulls
                new["score"] = frame["score"]
                came = np.union1d(came, new["uid"])
                held = first(np.concatenate([held, new]))
        mine = np.isin(held["uid"], came)
        if idle_ms:
            held["until"][mine] = now + idle_ms
            held, mine = held[held["until"] > now], mine[held["until"] > now]
        if not len(held):
            state.remove()
            return
        state.update((held.tobytes(),))
        if idle_ms:
            state.setTimeoutDuration(max(1, int(held["until"].min()) - now))
        held = held[mine]
        if not len(held):
            return
        begin = np.flatnonzero(np.r_[True, held["uid"][1:] != held["uid"][:-1]])
        items = [{"mid": m, "score": s} for m, s in zip(held["mid"].tolist(), held["score"].tolist())]
        yield pd.DataFrame({"uid": held["uid"][begin], "items": [items[a:b] for a, b in zip(begin, [*begin[1:], len(held)])],
                            "newest": held["timestamp"][begin]})

    return merge


def recent_lists(ratings: DataFrame, n: int = RECENT_RATINGS, strict_limit: bool = False, idle_ms: int | None = None,
                 buckets: int = STATE_BUCKETS) -> DataFrame:
    """Stream of (uid, items, newest) from a decoded rating stream. ``buckets``
    can't change between restarts of a stream."""
    bucket = F.pmod(F.xxhash64("uid"), F.lit(buckets)).cast("int")
    return ratings.withColumn("_bucket", bucket).groupBy("_bucket").applyInPandasWithState(
        _merge(n if strict_limit else n + 1, idle_ms), LISTS, "rows binary", "update",
        GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout)


def start_recent(ratings: DataFrame, out_path: str, checkpoint: str, trigger: dict | None = None, **params) -> StreamingQuery:
    """Keep the lists of a decoded rating stream in ``out_path``."""
    spark = ratings.sparkSession
    before = spark.conf.get(PROVIDER_CONF, None)
    spark.conf.set(PROVIDER_CONF, ROCKS_DB)  # read when the query starts
    try:
        def process(batch: DataFrame, batch_id: int) -> None:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                if not batch.isEmpty():  # timers run batches without rows
                    upsert_by_uid(batch, out_path, batch_key=_batch_key(batch, batch_id))
            finally:
                batch.unpersist()

        return recent_lists(ratings, **params).writeStream.outputMode("update").foreachBatch(process) \
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": TRIGGER_INTERVAL})).start()
    finally:
        spark.conf.set(PROVIDER_CONF, before) if before else spark.conf.unset(PROVIDER_CONF)


def read_recent(spark: SparkSession, out_path: str) -> DataFrame | None:
    """(uid, pos, mid, score) as ``recommender.recent_ratings`` gives."""
    lists = read_upserted(spark, out_path, version_cols=["newest"])
    if lists is None:
        return None
    each = lists.select("uid", F.posexplode("items").alias("pos", "it"))
    return each.select("uid", "pos", F.col("it.mid").alias("mid"), F.col("it.score").alias("score"))
