"""Access by movie, and lists in chunks."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recoengine import schemas
from recoengine.operators import blocks, similarity
from recoengine.session import scratch_path
from recoengine.sources import tables


def scanned_rows(df):
    """Rows that the scan gave out: those of the row groups that were not left out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def _ratings(spark, n=60_000):
    uid, mid = F.pmod(F.xxhash64("id"), F.lit(3000)).cast("int"), F.pmod(F.xxhash64(F.col("id") + 10**7), F.lit(2000)).cast("int")
    return spark.range(n).select(uid.alias("uid"), mid.alias("mid"), F.lit(1.0).alias("score"), F.col("id").alias("timestamp"))


def test_lookup_by_movie_reads_few_row_groups(spark):
    ratings = _ratings(spark)
    plain, clustered = scratch_path(spark, "plain"), scratch_path(spark, "clustered")
    small = {"num_partitions": 4, "row_group_bytes": 16 * 1024}
    tables.write_table(ratings, plain, cluster_by="uid", **small)
    tables.write_table(ratings, clustered, zorder_by=["uid", "mid"], bloom_on=["mid"], **small)
    for key in ({"mid": 77}, {"uid": 1234}):
        want = sorted(map(tuple, ratings.where(F.col(next(iter(key))) == next(iter(key.values()))).select(*schemas.RATING.names).collect()))
        found = tables.lookup(spark, clustered, schemas.RATING, **key)
        assert sorted(map(tuple, found.collect())) == want and want
        assert scanned_rows(found) < 0.3 * 60_000
    assert scanned_rows(tables.lookup(spark, plain, schemas.RATING, mid=77)) > 0.5 * 60_000  # sorted by user only


def test_lookup_in_a_bucketed_table(spark):
    path = scratch_path(spark, "bucketed")
    tables.write_table(_ratings(spark, 5000), path, bucket_by=("uid", 8), zorder_by=["uid", "mid"], bloom_on=["mid"])
    found = tables.lookup(spark, path, schemas.RATING, uid=7)
    assert {r.uid for r in found.collect()} <= {7}
    assert "uid_bucket_8" in found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert found.count() == _ratings(spark, 5000).where("uid = 7").count()
    assert tables.lookup(spark, path, schemas.RATING, mid=None).count() == 0


def test_z_order_of_nulls_and_nothing(spark):
    rows = spark.createDataFrame([(None, 1, 1.0, 1), (1, None, 1.0, 1), (2, 2, 1.0, 2)], "uid int, mid int, score double, timestamp long")
    for data in (rows, rows.limit(0)):
        path = scratch_path(spark, "z")
        tables.write_table(data, path, zorder_by=["uid", "mid"])
        assert sorted(map(str, tables.read_table(spark, path, schemas.RATING).collect())) == sorted(map(str, data.select(*schemas.RATING.names).collect()))


def test_chunks_hold_the_ranked_lists(spark):
    rng = random.Random(2)
    rows = [(m, s, r) for m in range(6) for s in range(40 * m) for r in [rng.choice([0.61, 0.7, 0.7, 0.95, 1.0, 1.0 + 1e-12, -0.5, rng.random()])]]
    path = scratch_path(spark, "sims")
    spark.createDataFrame(rows, "mid int, sim_mid int, r double").write.parquet(path)
    sims = spark.read.parquet(path)
    lists = similarity.chunked_lists(sims, size=7, ranges=16)
    assert lists.agg(F.max(F.size("recs"))).first()[0] == 7
    got = [(r.mid, r["rank"], r.sim_mid, r.r) for r in similarity.flatten_chunks(lists, size=7).orderBy("mid", "rank").collect()]
    want = []
    for m in range(6):
        mine = sorted((-r, s) for x, s, r in rows if x == m)
        want += [(m, i + 1, s, -r) for i, (r, s) in enumerate(mine)]
    assert got == want
    assert sorted(map(tuple, similarity.explode_lists(lists).collect())) == sorted(rows)


def test_a_hot_items_list_is_ranked_in_several_tasks(spark):
    path = scratch_path(spark, "hot")
    spark.range(20_000).select(F.lit(1).alias("mid"), (F.col("id") + 2).cast("int").alias("sim_mid"), (F.rand(3) * 0.4 + 0.6).alias("r")).write.parquet(path)
    ranked = similarity.ranked_entries(spark.read.parquet(path))
    assert ranked.agg(F.countDistinct("rank"), F.max("rank")).first() == (20_000, 20_000)
    spread = ranked.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(spread) > 1 and max(r["count"] for r in spread) < 0.6 * 20_000


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_chunks_are_packed_as_the_pairs_come(spark, monkeypatch, size):
    monkeypatch.setattr(blocks, "MIN_STRIPE_ROWS", 40)
    rng = np.random.default_rng(4)
    f = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(rng.permutation(120), rng.choice([-1.0, 0.0, 0.5, 2.0], (120, 3)))],
                              "id int, features array<float>")
    lists = similarity.chunked_lists(similarity.item_similarity(f, 0.3, ordered=True), size=size, ordered=True)
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Window" not in plan  # items move, pairs don't
    want = similarity.chunked_lists(similarity.item_similarity(f, 0.3), size=size)
    rows = [sorted((r.mid, r.chunk, [(x.mid, round(x.r, 12)) for x in r.recs]) for r in x.collect()) for x in (lists, want)]
    assert rows[0] == rows[1] and len(rows[0]) > 100
