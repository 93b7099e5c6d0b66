from pyspark.sql import functions as F

from recoengine.functions.scalar import year_month
from recoengine.operators import etl, statistics


def test_seconds_to_year_month(spark):
    assert spark.range(1).select(year_month(F.lit(1260759144)).alias("ym")).first().ym == "200912"


def _movies(spark, rows):
    return spark.createDataFrame(rows, "mid int, genres string")


def test_genre_membership_by_substring_and_misses(spark):
    movies = _movies(spark, [(1, "Musical"), (2, "Crime"), (3, None), (4, "Science Fiction|TV Movie"),
                             (5, "Drama")])
    ratings = spark.createDataFrame([(1, 1, 4.0), (1, 2, 4.0), (1, 3, 4.0), (1, 4, 2.0)],
                                    "uid int, mid int, score double")
    out = statistics.genre_top_n_flat(movies, statistics.average_scores(ratings)).collect()
    by_genre = {}
    for r in out:
        by_genre.setdefault(r.genres, []).append(r.mid)
    assert by_genre == {"Music": [1], "Science": [4], "Tv": [4]}  # 2: Ccrime; 3: null; 5: unrated


def test_top_n_tie_lower_mid_first(spark):
    movies = _movies(spark, [(9, "Action"), (3, "Action")])
    ratings = spark.createDataFrame([(1, 9, 4.0), (1, 3, 4.0)], "uid int, mid int, score double")
    out = statistics.genre_top_n(movies, statistics.average_scores(ratings), n=1).collect()
    assert out[0].genres == "Action" and [x.mid for x in out[0].recs] == [3]


def test_top_n_plans_partial_group_limit(spark):
    movies = _movies(spark, [(i, "Action") for i in range(50)])
    ratings = spark.createDataFrame([(1, i, float(i % 5)) for i in range(50)], "uid int, mid int, score double")
    df = statistics.genre_top_n_flat(movies, statistics.average_scores(ratings), n=10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert df.count() == 10


def test_rate_more_sorted(spark):
    ratings = spark.createDataFrame([(1, 5, 1.0, 0), (2, 5, 1.0, 0), (1, 7, 1.0, 0)],
                                    "uid int, mid int, score double, timestamp long")
    assert [(r.mid, r["count"]) for r in statistics.rate_more(ratings).collect()] == [(5, 2), (7, 1)]


def test_tags_by_movie_sorted_distinct(spark):
    tags = spark.createDataFrame([(1, 1, "b"), (2, 1, "a"), (3, 1, "b")], "uid int, mid int, tag string")
    assert etl.tags_by_movie(tags).first().tags == "a|b"


def test_search_documents_untagged_movie_keeps_null(spark):
    movies = spark.createDataFrame([(1,) + ("x",) * 9, (2,) + ("y",) * 9],
                                   "mid int, name string, descri string, timelong string, issue string, "
                                   "shoot string, language string, genres string, actors string, directors string")
    tags = spark.createDataFrame([(1, 1, "t", 0)], "uid int, mid int, tag string, timestamp long")
    got = {r.mid: r.tags for r in etl.search_documents(movies, tags).collect()}
    assert got == {1: "t", 2: None}


def test_statistics_come_sorted(spark, sf_dir):
    from recoengine import fixtures
    ratings = fixtures.ratings(spark, sf_dir)
    for df in (statistics.rate_more(ratings), statistics.rate_more_sql(ratings)):
        got = [(-r["count"], r.mid) for r in df.collect()]
        assert got == sorted(got) and len(got) == 200
    for df in (statistics.rate_more_recently(ratings), statistics.rate_more_recently_sql(ratings)):
        got = [(-int(r.yearmonth), -r["count"], r.mid) for r in df.collect()]
        assert got == sorted(got)


def test_sql_statements_leave_views_alone(spark):
    spark.createDataFrame([(1,)], "x int").createOrReplaceTempView("ratings")
    ratings = spark.createDataFrame([(1, 5, 1.0, 0)], "uid int, mid int, score double, timestamp long")
    assert statistics.average_scores_sql(ratings).first().avg == 1.0
    assert spark.table("ratings").columns == ["x"]
    spark.catalog.dropTempView("ratings")
