"""The five jobs of the recommender, each a function over paths:

    load_job       text files -> Movie / Rating / Tag tables + search docs
    statistics_job Rating, Movie -> four statistics tables
    offline_job    Rating, Movie -> ALS -> per-user lists + item similarity
    parameter_job  Rating -> ALS grid (rank x reg) -> best parameters
    streaming_job  rating stream + similarity + Rating + recent -> per-user lists

Run order: load -> {statistics, parameter, offline} -> streaming. Tables
are Parquet directories named after the original collections.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoengine import schemas
from recoengine.operators import als, als_split, etl, similarity, statistics
from recoengine.operators.topn import nest
from recoengine.session import prepare, release, scratch_path
from recoengine.sources import sinks, tables, text
from recoengine.streaming import recommender as rec
from recoengine.streaming.snapshots import Snapshots

# Stored table (collection) names.
MOVIE = "Movie"
RATING = "Rating"
TAG = "Tag"
SEARCH_DOCS = "MovieSearch"
RATE_MORE = "RateMoreMovies"
MONTH_RATE_MORE = "Month_RateMoreMovies"
AVERAGE_SCORE = "AverageMoviesScore"
GENRES_TOP = "GenresTop_AverageMoviesScore"
USER_RECS = "NotSeenMovieRecommends"
ITEM_RECS = "AcquaintanceMovieRecommends"
STREAM_RECS = "StreamingMovieRecommends"
RECENT = "RecentRatings"
FACTORS = "Factors"
ITEM_SIM = "ItemSimilarity"  # ranked long form, in versions that a stream takes up
# Micro-batches between compactions of the stream's results.
COMPACT_EVERY = 100
# Suffix of the tables of lines and messages that could not be read.
BAD = "_bad"


def _p(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def load_job(spark: SparkSession, movies_path: str, ratings_path: str, tags_path: str,
             out_dir: str, mode: str = "failfast") -> dict[str, str]:
    """Read the three text files into tables. ``mode``: what happens to
    malformed lines (``failfast``, ``drop``, or ``quarantine``: stored as
    ``<table>_bad``)."""
    prepare(spark)
    out = {n: _p(out_dir, n) for n in (MOVIE, RATING, TAG, SEARCH_DOCS)}
    parts = {MOVIE: text.load_movies(spark, movies_path, mode=mode), RATING: text.load_ratings(spark, ratings_path, mode=mode),
             TAG: text.load_tags(spark, tags_path, mode=mode)}
    if mode == "quarantine":
        for name, (_, bad) in parts.items():
            out[name + BAD] = _p(out_dir, name + BAD)
            tables.write_table(bad, out[name + BAD])
        parts = {name: good for name, (good, _) in parts.items()}
    movies = parts[MOVIE].persist(StorageLevel.MEMORY_AND_DISK)
    tags = parts[TAG].persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tables.write_table(movies, out[MOVIE], sort_by="mid")
        # looked up by user and by movie
        tables.write_table(parts[RATING], out[RATING], bucket_by=("uid", tables.uid_buckets(spark)), zorder_by=["uid", "mid"], bloom_on=["mid"])
        tables.write_table(tags, out[TAG], zorder_by=["uid", "mid"], bloom_on=["uid", "mid"])
        sinks.write_search_docs(etl.search_documents(movies, tags), out[SEARCH_DOCS], key="mid")
    finally:
        movies.unpersist()
        tags.unpersist()
    return out


def read_inputs(spark: SparkSession, in_dir: str) -> tuple[DataFrame, DataFrame]:
    return (tables.read_table(spark, _p(in_dir, RATING), schemas.RATING),
            tables.read_table(spark, _p(in_dir, MOVIE), schemas.MOVIE))


def statistics_job(spark: SparkSession, in_dir: str, out_dir: str,
                   genres=statistics.GENRES, n: int = statistics.TOP_N_GENRE) -> dict[str, str]:
    prepare(spark)
    ratings, movies = read_inputs(spark, in_dir)
    # one pass over the ratings: counts and sums by movie and month give all
    monthly = statistics.monthly_totals(ratings).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        avg = statistics.average_from_totals(monthly)
        tables.write_table(statistics.rate_more_from_totals(monthly), _p(out_dir, RATE_MORE))
        tables.write_table(monthly.select("mid", "count", "yearmonth"), _p(out_dir, MONTH_RATE_MORE))
        tables.write_table(statistics.genre_top_n(movies, avg, genres, n), _p(out_dir, GENRES_TOP))
        tables.write_table(avg, _p(out_dir, AVERAGE_SCORE), sort_by="mid")
    finally:
        monthly.unpersist()
    return {x: _p(out_dir, x) for x in (RATE_MORE, MONTH_RATE_MORE, GENRES_TOP, AVERAGE_SCORE)}


def offline_job(spark: SparkSession, in_dir: str, out_dir: str, rank: int = als.RANK,
                iterations: int = als.ITERATIONS, reg: float = als.REG, seed: int = 42,
                n: int = als.TOP_N_USER, threshold: float = similarity.SIM_THRESHOLD,
                exclude_seen: bool = False, split_hot: bool = False) -> dict[str, str]:
    """``split_hot``: fit with ``als_split``, which no hot user or item overloads."""
    prepare(spark)
    ratings, movies = read_inputs(spark, in_dir)
    if split_hot:
        users_f, items_f = als.save_tables(*als_split.fit(ratings, rank, iterations, reg, seed), _p(out_dir, FACTORS))
    else:
        users_f, items_f = als.save_factors(als.train(ratings, rank=rank, iterations=iterations, reg=reg, seed=seed), _p(out_dir, FACTORS))
    flat = als.recommend_from_factors(users_f, items_f, ratings, movies, n, exclude_seen,
                                      trained_on_ratings=True)
    tables.write_table(nest(flat, ["uid"], "rank", "mid", "r"), _p(out_dir, USER_RECS))
    publish_similarity(spark, similarity.item_similarity(items_f, threshold), out_dir)
    return {x: _p(out_dir, x) for x in (USER_RECS, ITEM_RECS, ITEM_SIM, FACTORS)}


def publish_similarity(spark: SparkSession, item_sim: DataFrame, out_dir: str) -> int:
    """Write a new version of the similarity table, which a running stream takes
    up with its next batch, and the stored lists (in chunks) from it."""
    snapshots = Snapshots(spark, _p(out_dir, ITEM_SIM))
    path = scratch_path(spark, "item-sim")
    tables.write_table(item_sim, path)
    version = snapshots.publish(similarity.ranked_entries(spark.read.parquet(path)))
    tables.write_table(similarity.chunked_lists(spark.read.parquet(path)), _p(out_dir, ITEM_RECS), sort_by=["mid", "chunk"])
    release(spark, path)
    return version


def parameter_job(spark: SparkSession, in_dir: str, ranks=als.GRID_RANKS, regs=als.GRID_REGS,
                  iterations: int = als.ITERATIONS, seed: int = 42, holdout: float = 0.0, halving: bool = False) -> DataFrame:
    """Returns the best (grid_pos, rank, reg, rmse) row as a DataFrame. ``halving``:
    successive halving, scored on each user's newest rating."""
    prepare(spark)
    ratings, _ = read_inputs(spark, in_dir)
    if halving:
        search = als.halving_search(ratings, ranks, regs, iterations, seed)
        last = search.agg({"round": "max"}).first()[0]
        return als.best_params(search.where(F.col("round") == last).select("grid_pos", "rank", "reg", "rmse"))
    grid = als.grid_search(ratings, ranks, regs, iterations, seed, holdout)
    return als.best_params(grid)


def recent_job(spark: SparkSession, in_dir: str, out_dir: str,
               n: int = rec.RECENT_RATINGS) -> str:
    """Materialise the per-user recent lists (newest n + 1 ratings by
    timestamp, then mid) as a uid-bucketed table the stream reads."""
    prepare(spark)
    ratings, _ = read_inputs(spark, in_dir)
    path = _p(out_dir, RECENT)
    tables.write_table(rec.recent_ratings(ratings, n=n, order=("timestamp", "mid")), path,
                       sort_by=["uid", "pos"], bucket_by=("uid", tables.uid_buckets(spark)))
    return path


def streaming_job(spark: SparkSession, in_dir: str, sim_dir: str, stream_path: str, out_dir: str,
                  checkpoint: str, recent_dir: str | None = None, trigger: dict | None = None,
                  stream_format: str = "text", mode: str = "failfast", refresh_recent: bool = False,
                  compact_every: int = COMPACT_EVERY, **stream_options):
    """Start the real-time recommender over the stored Rating table, the
    similarity table (its newest version at each batch) and the recent-ratings table (built by ``recent_job``
    into ``recent_dir``, default ``in_dir``, when it is absent, incomplete or
    ``refresh_recent`` is set). Per batch only the batch users' buckets of
    Rating and RecentRatings are read. ``mode``: a malformed message fails its
    batch (``failfast``), is dropped (``drop``) or stored (``quarantine``). The
    results are compacted beside the stream every ``compact_every`` batches."""
    prepare(spark)
    ratings, _ = read_inputs(spark, in_dir)
    item_sim = Snapshots(spark, _p(sim_dir, ITEM_SIM))
    if item_sim.latest() is None:  # lists stored without versions
        item_sim = similarity.explode_lists(tables.read_table(spark, _p(sim_dir, ITEM_RECS), schemas.ITEM_RECS))
    rdir = recent_dir or in_dir
    if refresh_recent or not sinks.committed(spark, _p(rdir, RECENT)):
        recent_job(spark, in_dir, rdir)
    recent = tables.read_table(spark, _p(rdir, RECENT), schemas.RECENT)
    bucket = tables.stored_buckets(ratings.columns, "uid")
    rated = ratings.select("uid", "mid", *([bucket[0]] if bucket else []))
    messages = rec.rating_stream(spark, stream_path, stream_format, **stream_options)
    return rec.start(messages, item_sim, rated, recent, _p(out_dir, STREAM_RECS), checkpoint, trigger,
                     compact_every=compact_every, decode=mode, bad_path=_p(out_dir, STREAM_RECS + BAD))
