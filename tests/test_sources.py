import pytest
from pyspark.sql import Row

from recoengine.session import scratch_path
from recoengine.sources import sinks, tables, text
from recoengine import schemas


def _write_lines(spark, lines, name):
    path = scratch_path(spark, name)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_movie_empty_last_field_accepted(spark):
    p = _write_lines(spark, ["7^A^^^^^^Drama^x^"], "m1")
    rows = text.load_movies(spark, p).collect()
    assert len(rows) == 1 and rows[0].mid == 7 and rows[0].directors == "" and rows[0].genres == "Drama"


def test_movie_fields_trimmed_like_java(spark):
    p = _write_lines(spark, ["\t12 ^ Name \x0b^^^^^^Comedy ^a^b"], "m2")
    r = text.load_movies(spark, p).first()
    assert r.mid == 12 and r.name == "Name" and r.genres == "Comedy"


def test_short_movie_line_modes(spark):
    p = _write_lines(spark, ["7^A^b", "8^B^^^^^^Drama^x^y"], "m3")
    with pytest.raises(Exception, match="malformed"):
        text.load_movies(spark, p, mode="failfast").collect()
    assert [r.mid for r in text.load_movies(spark, p, mode="drop").collect()] == [8]
    good, bad = text.load_movies(spark, p, mode="quarantine")
    assert good.count() == 1 and [r.line for r in bad.collect()] == ["7^A^b"]


def test_comma_in_tag_rejected(spark):
    p = _write_lines(spark, ["1,2,a,b,100", "1,2,ok,100"], "t1")
    good, bad = text.load_tags(spark, p, mode="quarantine")
    assert [r.tag for r in good.collect()] == ["ok"]
    assert bad.count() == 1


def test_ratings_extra_fields_ignored_and_long_timestamp(spark):
    p = _write_lines(spark, ["1,31,2.5,1260759144,extra", "1,x,2.5,1"], "r1")
    rows = text.load_ratings(spark, p, mode="drop").collect()
    assert rows == [Row(uid=1, mid=31, score=2.5, timestamp=1260759144)]


def test_write_read_table_binds_by_name(spark):
    df = spark.createDataFrame([(2, 1, 3.0, 5), (1, 2, 4.0, 6)], "mid int, uid int, score double, timestamp int")
    p = scratch_path(spark, "tbl")
    tables.write_table(df, p, sort_by="uid")
    back = tables.read_table(spark, p, schemas.RATING)
    assert back.schema == schemas.RATING
    assert sorted(map(tuple, back.collect())) == [(1, 2, 3.0, 5), (2, 1, 4.0, 6)]


def test_search_docs_unique_per_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "mid int, name string")
    p = scratch_path(spark, "docs")
    sinks.write_search_docs(df, p)
    got = sorted(map(tuple, spark.read.parquet(p).collect()))
    assert got == [(1, "b"), (2, "c")]


def test_cluster_by_writes_disjoint_key_ranges(spark):
    from pyspark.sql import functions as F
    df = spark.range(0, 2000).select((F.col("id") * 7919 % 2000).cast("int").alias("uid"),
                                     F.lit(1).alias("mid"), F.lit(1.0).alias("score"), F.lit(0).cast("long").alias("timestamp"))
    p = scratch_path(spark, "clustered")
    tables.write_table(df, p, cluster_by="uid", num_partitions=4)
    back = spark.read.parquet(p).withColumn("f", F.input_file_name())
    ranges = sorted((r.lo, r.hi) for r in back.groupBy("f").agg(F.min("uid").alias("lo"), F.max("uid").alias("hi")).collect())
    assert len(ranges) >= 2 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert back.count() == 2000
