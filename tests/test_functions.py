import math

from pyspark.sql import functions as F

from recoengine.functions.scalar import cosine, dot, encode_recs, epoch_seconds, log2_at_least_one
from recoengine.operators.topn import flatten, nest


def test_encode_recs_format(spark):
    df = spark.createDataFrame([(2, [(231, 4.0), (2145, 3.1)]), (3, [])],
                               "uid int, recs array<struct<mid:int,r:double>>")
    got = {r.uid: r.s for r in df.select("uid", encode_recs("recs").alias("s")).collect()}
    assert got == {2: "231:4.0|2145:3.1", 3: ""}


def test_dot_and_cosine_on_arrays(spark):
    df = spark.createDataFrame([([3.0, 4.0], [3.0, 0.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    rows = df.select(dot(F.col("a"), F.col("b")).alias("d"), cosine(F.col("a"), F.col("b")).alias("c")).collect()
    assert rows[0].d == 9.0 and math.isclose(rows[0].c, 0.6)
    assert rows[1].c is None  # zero norm: null, never NaN


def test_log2_counter_floor(spark):
    df = spark.createDataFrame([(0,), (1,), (4,)], "n int")
    assert [r.v for r in df.select(log2_at_least_one(F.col("n")).alias("v")).collect()] == [0.0, 0.0, 2.0]


def test_nest_flatten_round_trip(spark):
    flat = spark.createDataFrame([(1, 1, 10, 0.9), (1, 2, 11, 0.5), (2, 1, 12, 0.7)],
                                 "uid int, rank int, mid int, r double")
    back = flatten(nest(flat, ["uid"], "rank", "mid", "r"), ["uid"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, flat.collect()))


def test_epoch_seconds_of_ntz_is_zone_independent(spark):
    df = spark.createDataFrame([("2009-12-14 02:52:24",)], "s string") \
        .select(F.col("s").cast("timestamp_ntz").alias("t"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        v = df.select(epoch_seconds("t", df.schema["t"].dataType).alias("e")).first().e
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert v == 1260759144
