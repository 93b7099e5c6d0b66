"""The five jobs chained on text files made from the sf0.001 tables."""

import os
import re

from pyspark.sql import functions as F

from recoengine import fixtures, schemas
from recoengine.plans import jobs
from recoengine.session import scratch_path
from recoengine.sources import sinks
from recoengine.sources.text import to_lines
from recoengine.streaming import recommender as rec


def test_jobs_end_to_end(spark, sf_dir):
    raw = scratch_path(spark, "raw")
    to_lines(fixtures.movies(spark, sf_dir), schemas.MOVIE_FIELDS, "^").write.text(f"{raw}/movies")
    to_lines(fixtures.ratings(spark, sf_dir), ["uid", "mid", "score", "timestamp"], ",").write.text(f"{raw}/ratings")
    to_lines(fixtures.tags(spark, sf_dir), ["uid", "mid", "tag", "timestamp"], ",").write.text(f"{raw}/tags")
    store = scratch_path(spark, "store")
    paths = jobs.load_job(spark, f"{raw}/movies", f"{raw}/ratings", f"{raw}/tags", store)
    assert spark.read.parquet(paths[jobs.RATING]).count() == fixtures.ratings(spark, sf_dir).count()
    # the stored Rating table is uid-bucketed, and a batch's candidate plan
    # reads only the buckets of its users
    from recoengine.sources import tables
    rated = tables.read_table(spark, paths[jobs.RATING], schemas.RATING)
    bucket, _ = tables.stored_buckets(rated.columns, "uid")
    one = rated.select("uid", "mid").limit(1).collect()[0]
    sims = spark.createDataFrame([(one.mid, one.mid + 1, 0.9)], "mid int, sim_mid int, r double")
    cand = rec.candidates(spark.createDataFrame([(one.uid, one.mid)], "uid int, mid int"), sims,
                          rated.select("uid", "mid", bucket))
    cand.collect()
    plan = cand._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert re.search(r"FileScan parquet \[[^\]]*uid_bucket[^\]]*\].*PartitionFilters: \[[^\]]*uid_bucket", plan)
    docs = spark.read.parquet(paths[jobs.SEARCH_DOCS])
    assert docs.count() == docs.select("mid").distinct().count()

    stats = jobs.statistics_job(spark, store, store)
    g = spark.read.parquet(stats[jobs.GENRES_TOP])
    assert g.count() > 0 and g.where(F.size("recs") > 10).count() == 0

    off = jobs.offline_job(spark, store, store, rank=8, iterations=3)
    u = spark.read.parquet(off[jobs.USER_RECS])
    assert u.count() > 0 and u.where(F.size("recs") > 10).count() == 0

    best = jobs.parameter_job(spark, store, ranks=(4,), regs=(0.1, 0.01), iterations=2).collect()
    assert len(best) == 1

    inbox, out, ckpt = (scratch_path(spark, x) for x in ("in", "out", "ckpt"))
    os.makedirs(inbox)
    some = spark.read.parquet(paths[jobs.RATING]).limit(5).collect()
    with open(os.path.join(inbox, "m.txt"), "w") as fh:
        fh.write("\n".join(f"{r.uid}|{r.mid}|{r.score}|{r.timestamp}" for r in some) + "\n")
    q = jobs.streaming_job(spark, store, store, inbox, out, ckpt, trigger={"availableNow": True})
    q.awaitTermination()
    res = rec.read_results(spark, f"{out}/{jobs.STREAM_RECS}")
    assert res.count() == len({r.uid for r in some})


def test_load_job_stores_bad_lines(spark, tmp_path):
    (tmp_path / "movies.txt").write_text("1^A^^90 minutes^^1995^English^Action^x^y\nbad\n")
    (tmp_path / "ratings.txt").write_text("1,1,4.0,1260759144\n1,x,4.0,1\n1,1\n")
    (tmp_path / "tags.txt").write_text("1,1,fun,1260759144\n")
    paths = jobs.load_job(spark, *(str(tmp_path / f"{n}.txt") for n in ("movies", "ratings", "tags")),
                          scratch_path(spark, "store"), mode="quarantine")
    counts = {n: spark.read.parquet(p).count() for n, p in paths.items()}
    assert counts == {"Movie": 1, "Rating": 1, "Tag": 1, "MovieSearch": 1, "Movie_bad": 1, "Rating_bad": 2, "Tag_bad": 0}


def test_recent_table_needs_a_completed_write(spark):
    path = scratch_path(spark, "recent")
    os.makedirs(path)
    assert sinks.path_exists(spark, path) and not sinks.committed(spark, path)


def test_statistics_job_equals_the_separate_statistics(spark, sf_dir):
    from recoengine.operators import statistics
    from recoengine.sources import tables
    store, out = scratch_path(spark, "store"), scratch_path(spark, "stats")
    ratings, movies = fixtures.ratings(spark, sf_dir), fixtures.movies(spark, sf_dir)
    tables.write_table(ratings, f"{store}/{jobs.RATING}")
    tables.write_table(movies, f"{store}/{jobs.MOVIE}")
    paths = jobs.statistics_job(spark, store, out)

    def rows(df):
        return sorted(map(tuple, df.collect()))

    assert rows(spark.read.parquet(paths[jobs.RATE_MORE])) == rows(statistics.rate_more(ratings, sort=False))
    assert rows(spark.read.parquet(paths[jobs.MONTH_RATE_MORE]).select("mid", "count", "yearmonth")) == \
        rows(statistics.rate_more_recently(ratings, sort=False))
    assert rows(spark.read.parquet(paths[jobs.AVERAGE_SCORE])) == rows(statistics.average_scores(ratings))
