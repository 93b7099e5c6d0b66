"""Registry of driver queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables through ``recoengine.fixtures`` and
runs the library operator on the whole input. Flat outputs (key, rank,
mid, value) stand for the nested lists so an SQL oracle can compare them;
similarity / product scores are rounded to 4 decimals after ranking.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoengine import fixtures, schemas
from recoengine.operators import als, als_split, blocks, etl, pruned, similarity, statistics
from recoengine.operators.topn import flatten, nest, with_place
from recoengine.session import prepare, scratch_path
from recoengine.sources.sinks import compact, dedup_by_key
from recoengine.sources.tables import lookup, read_table, write_table
from recoengine.sources.text import load_movies, load_ratings, load_tags, to_lines
from recoengine.streaming import recent_state
from recoengine.streaming import recommender as rec

Query = Callable[[SparkSession, str], DataFrame]

#: Of tables with a row or an entry a pair, which outgrow all others: an id and an exact
#: double, of which snappy saves nothing.
PAIR_CODEC = "zstd"


def q_rate_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return statistics.rate_more(fixtures.ratings(spark, sf_dir))


def q_rate_more_recently(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return statistics.rate_more_recently(fixtures.ratings(spark, sf_dir))


def q_rate_more_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order that the statistic comes in."""
    prepare(spark)
    return with_place(statistics.rate_more(fixtures.ratings(spark, sf_dir)), scratch_path(spark, "ordered"))


def q_rate_more_recently_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return with_place(statistics.rate_more_recently(fixtures.ratings(spark, sf_dir)), scratch_path(spark, "ordered"))


def q_change_date_sql_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly projection written as SQL text through the SQL function
    ``changeDate``."""
    prepare(spark)
    return statistics.run_sql(statistics.MONTH_SQL, fixtures.ratings(spark, sf_dir))


def q_rate_more_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return statistics.rate_more_sql(fixtures.ratings(spark, sf_dir))


def q_rate_more_recently_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return statistics.rate_more_recently_sql(fixtures.ratings(spark, sf_dir))


def q_average_scores_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return statistics.average_scores_sql(fixtures.ratings(spark, sf_dir))


def q_average_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return statistics.average_scores(fixtures.ratings(spark, sf_dir))


def q_genre_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    avg = statistics.average_scores(fixtures.ratings(spark, sf_dir))
    return statistics.genre_top_n_flat(fixtures.movies(spark, sf_dir), avg)


# ------------------------------------------------------- loader / tables ---

def q_tags_by_movie(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return etl.tags_by_movie(fixtures.tags(spark, sf_dir))


def q_search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = etl.search_documents(fixtures.movies(spark, sf_dir), fixtures.tags(spark, sf_dir))
    return dedup_by_key(docs, "mid").select(*etl.SEARCH_DOC_COLUMNS)


def _roundtrip(spark: SparkSession, df: DataFrame, columns: list[str], sep: str, loader, name: str):
    path = scratch_path(spark, name)
    to_lines(df, columns, sep).write.mode("overwrite").text(path)
    return loader(spark, path, mode="failfast")


def q_load_movies_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _roundtrip(spark, fixtures.movies(spark, sf_dir), schemas.MOVIE_FIELDS, "^",
                      load_movies, "movies-text")


def q_load_ratings_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _roundtrip(spark, fixtures.ratings(spark, sf_dir), ["uid", "mid", "score", "timestamp"],
                      ",", load_ratings, "ratings-text")


def q_load_tags_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _roundtrip(spark, fixtures.tags(spark, sf_dir), ["uid", "mid", "tag", "timestamp"],
                      ",", load_tags, "tags-text")


def q_write_read_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = scratch_path(spark, "rating-table")
    write_table(fixtures.ratings(spark, sf_dir), path, sort_by=["uid", "mid"])
    return read_table(spark, path, schemas.RATING)


def q_ratings_of_top_movie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ratings of the most rated movie, looked up by movie in the stored table."""
    prepare(spark)
    path = scratch_path(spark, "rating-table")
    write_table(fixtures.ratings(spark, sf_dir), path, bucket_by=("uid", 8), zorder_by=["uid", "mid"], bloom_on=["mid"])
    top = statistics.rate_more(read_table(spark, path, schemas.RATING), sort=False).orderBy(F.desc("count"), F.asc("mid")).first()
    return lookup(spark, path, schemas.RATING, mid=None if top is None else top["mid"])


def q_tags_of_user_and_movie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tags of the movie with the most tags by the user with the most tags."""
    prepare(spark)
    path = scratch_path(spark, "tag-table")
    write_table(fixtures.tags(spark, sf_dir), path, zorder_by=["uid", "mid"], bloom_on=["uid", "mid"])
    tags = read_table(spark, path, schemas.TAG)
    key = {c: tags.groupBy(c).count().orderBy(F.desc("count"), F.asc(c)).first() for c in ("uid", "mid")}
    found = [lookup(spark, path, schemas.TAG, **{c: None if r is None else r[c]}) for c, r in key.items()]
    return found[0].unionByName(found[1])


# ----------------------------------------------------- factor products ---

def _rounded(df: DataFrame, col: str = "r", digits: int = 4) -> DataFrame:
    r = F.round(col, digits)
    return df.withColumn(col, F.when(r == 0, F.lit(0.0)).otherwise(r))  # no negative zero


def _similarity(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    return similarity.item_similarity(fixtures.similarity_factors(spark, sf_dir), fixtures.SIMILAR_ABOVE, ordered=ordered)


def _stored_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-item lists, stored and read back; they come by mid within a stripe."""
    path = scratch_path(spark, "item-lists")
    write_table(similarity.item_similarity_lists(_similarity(spark, sf_dir, ordered=True), ordered=True), path, compression=PAIR_CODEC)
    return read_table(spark, path, schemas.ITEM_RECS)


def q_item_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _rounded(_similarity(spark, sf_dir))


def q_item_similarity_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored per-item lists, read back and taken apart by position."""
    prepare(spark)
    return _rounded(flatten(_stored_lists(spark, sf_dir).withColumnRenamed("mid", "item"), ["item"]).select(
        F.col("item").alias("mid"), F.col("rank").cast("int").alias("rank"), F.col("mid").alias("sim_mid"), "r"))


def _stored_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored per-item lists in chunks, read back; they come by mid and chunk
    within a stripe."""
    path = scratch_path(spark, "item-chunks")
    write_table(similarity.chunked_lists(_similarity(spark, sf_dir, ordered=True), ordered=True), path, compression=PAIR_CODEC)
    return spark.read.parquet(path)


def q_item_similarity_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _rounded(similarity.flatten_chunks(_stored_chunks(spark, sf_dir)))


def q_item_similarity_chunks_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _rounded(similarity.explode_lists(_stored_chunks(spark, sf_dir)))


def q_item_similarity_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored lists back to the long form that the stream reads."""
    prepare(spark)
    return _rounded(similarity.explode_lists(_stored_lists(spark, sf_dir)))


def _nested_roundtrip(spark: SparkSession, flat: DataFrame, key: str, value: str, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    write_table(nest(flat, [key], "rank", "mid", value), path)
    return flatten(spark.read.parquet(path), [key]).select(key, F.col("rank").cast("int").alias("rank"), "mid", "r")


def q_stored_user_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _rounded(_nested_roundtrip(spark, _factor_top10(spark, sf_dir, False, rounded=False), "uid", "r", "user-lists"))


def q_stored_genre_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _rounded(_nested_roundtrip(spark, q_genre_top10(spark, sf_dir), "genres", "avg", "genre-lists"))


def _factor_top10(spark: SparkSession, sf_dir: str, exclude_seen: bool, rounded: bool = True) -> DataFrame:
    prepare(spark)
    flat = als.recommend_from_factors(
        fixtures.user_factors(spark, sf_dir), fixtures.item_factors(spark, sf_dir), fixtures.ratings(spark, sf_dir),
        fixtures.movies(spark, sf_dir), 10, exclude_seen)
    return _rounded(flat) if rounded else flat


def q_factor_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _factor_top10(spark, sf_dir, exclude_seen=False)


def q_item_similarity_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _rounded(pruned.similar_pairs(fixtures.similarity_factors(spark, sf_dir), fixtures.SIMILAR_ABOVE)[0])


def _factor_top10_pruned(spark: SparkSession, sf_dir: str, exclude_seen: bool) -> DataFrame:
    prepare(spark)
    ratings, movies = fixtures.ratings(spark, sf_dir), fixtures.movies(spark, sf_dir)
    users, items, seen = als.rating_users_and_items(fixtures.user_factors(spark, sf_dir), fixtures.item_factors(spark, sf_dir),
                                                    ratings, movies, exclude_seen)
    return _rounded(pruned.top_n_products(users, items, 10, seen=seen)[0])


def q_factor_top10_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _factor_top10_pruned(spark, sf_dir, exclude_seen=False)


def q_factor_top10_unseen_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _factor_top10_pruned(spark, sf_dir, exclude_seen=True)


def q_factor_top10_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _factor_top10(spark, sf_dir, exclude_seen=True)


# ------------------------------------------------------------------ ALS ---

def _als_model(spark: SparkSession, sf_dir: str):
    return als.train(fixtures.ratings(spark, sf_dir), rank=als.RANK, iterations=als.ITERATIONS,
                     reg=als.REG, seed=42)


def _als_factors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Fit, then continue from factor tables written to the shared folder."""
    return als.save_factors(_als_model(spark, sf_dir), scratch_path(spark, "als-factors"))


def q_als_recommend(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    uf, itf = _als_factors(spark, sf_dir)
    return als.recommend_from_factors(uf, itf, fixtures.ratings(spark, sf_dir), fixtures.movies(spark, sf_dir),
                                      trained_on_ratings=True)


def q_als_recommend_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    uf, itf = _als_factors(spark, sf_dir)
    return als.recommend_from_factors(uf, itf, fixtures.ratings(spark, sf_dir), fixtures.movies(spark, sf_dir),
                                      exclude_seen=True, trained_on_ratings=True)


def q_als_item_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    _, itf = _als_factors(spark, sf_dir)
    return similarity.item_similarity(itf)


def q_als_predict_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    ratings = fixtures.ratings(spark, sf_dir)
    return als.predict_pairs(_als_model(spark, sf_dir), ratings)


def _factor_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return als.predict_from_factors(fixtures.user_factors(spark, sf_dir), fixtures.item_factors(spark, sf_dir),
                                    fixtures.ratings(spark, sf_dir).select("uid", "mid", "score"))


def q_predict_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _rounded(_factor_predictions(spark, sf_dir), "prediction")


def q_training_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return als.rmse_of_scored(_factor_predictions(spark, sf_dir)).select(F.round("rmse", 6).alias("rmse"), "n")


def q_holdout_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's newest rating against the factors' prediction, and the split's sizes."""
    prepare(spark)
    train, test = als.last_out(fixtures.ratings(spark, sf_dir))
    scored = als.predict_from_factors(fixtures.user_factors(spark, sf_dir), fixtures.item_factors(spark, sf_dir), test.select("uid", "mid", "score"))
    sizes = train.agg(F.count(F.lit(1)).alias("train")).join(test.agg(F.count(F.lit(1)).alias("test")))
    return sizes.join(als.rmse_of_scored(scored)).select("train", "test", F.col("n").alias("scored"), F.round("rmse", 6).alias("rmse"))


def q_als_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for the lists of any fitted model: (name, n) with n the number
    of rows against it."""
    prepare(spark)
    ratings, movies = fixtures.ratings(spark, sf_dir), fixtures.movies(spark, sf_dir)
    uf, itf = _als_factors(spark, sf_dir)
    saved = {}
    for name, frame in {"all": als.recommend_from_factors(uf, itf, ratings, movies),
                        "unseen": als.recommend_from_factors(uf, itf, ratings, movies, exclude_seen=True, trained_on_ratings=True),
                        "similar": similarity.item_similarity(itf)}.items():
        path = scratch_path(spark, f"als-{name}")
        write_table(frame, path)
        saved[name] = spark.read.parquet(path)
    lists, unseen, similar = saved["all"], saved["unseen"], saved["similar"]
    rated = ratings.select("uid", "mid").distinct()
    checks = {
        "user without ratings": lists.join(rated.select("uid").distinct(), "uid", "left_anti"),
        "item outside the movies": lists.join(movies.select("mid"), "mid", "left_anti"),
        "score not positive": lists.where("r <= 0"),
        "rank out of 1 to 10": lists.where("rank < 1 or rank > 10"),
        "scores not falling": lists.alias("a").join(lists.alias("b"), F.expr("a.uid = b.uid and a.rank + 1 = b.rank")).where("a.r < b.r"),
        "rank missing": lists.groupBy("uid").agg(F.max("rank").alias("m"), F.count(F.lit(1)).alias("n")).where("m != n"),
        "rated item among the unseen": unseen.join(rated, ["uid", "mid"], "left_semi"),
        "similar to itself": similar.where("mid = sim_mid"),
        "similar one way only": similar.select("mid", "sim_mid").exceptAll(similar.select(F.col("sim_mid").alias("mid"), F.col("mid").alias("sim_mid"))),
        "cosine out of range": similar.where(f"r <= {similarity.SIM_THRESHOLD} or r > 1.0001"),
    }
    out = None
    for name, frame in checks.items():
        one = frame.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def _residuals(ratings: DataFrame, users_f: DataFrame, items_f: DataFrame) -> DataFrame:
    # float factors leave about 1e-6 of the right-hand side
    return als_split.residuals(ratings, users_f, items_f).withColumn("residual", F.round("residual", 3))


def q_als_half_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users solved from fixed item factors: how far from the normal equations."""
    prepare(spark)
    ratings, items_f = fixtures.ratings(spark, sf_dir), fixtures.item_factors(spark, sf_dir)
    return _residuals(ratings, als_split.solve_users(ratings, items_f), items_f)


def q_als_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MLlib's fit: its last half-step must solve the users' normal equations."""
    prepare(spark)
    return _residuals(fixtures.ratings(spark, sf_dir), *_als_factors(spark, sf_dir))


def q_als_split_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of the fit that splits hot users and items."""
    prepare(spark)
    ratings = fixtures.ratings(spark, sf_dir)
    return _residuals(ratings, *als_split.fit(ratings))


def q_grid_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cell of the grid fitted again alone: its stored RMSE against the RMSE
    joined from its saved factors (``gap``, in thousandths), and how far that fit
    is from the normal equations."""
    prepare(spark)
    ratings = fixtures.ratings(spark, sf_dir)
    rank, reg = als.GRID_RANKS[0], als.GRID_REGS[0]
    cell = als.grid_search(ratings, ranks=[rank], regs=[reg]).select("rank", "reg", "rmse")
    users_f, items_f = als.save_factors(als.train(ratings, rank=rank, reg=reg), scratch_path(spark, "als-cell"))
    joined = als.rmse(ratings, als.predict_from_factors(users_f, items_f, ratings.select("uid", "mid"), rank=rank))
    off = als_split.residuals(ratings, users_f, items_f, reg).agg(F.round(F.max("residual"), 3).alias("residual"))
    return cell.join(joined.withColumnRenamed("rmse", "again")).join(off).select(
        "rank", "reg", F.round(F.abs(F.col("rmse") - F.col("again")) * 1000).cast("int").alias("gap"), "n", "residual")


def q_rmse_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RMSE join on a deterministic prediction: every rating row predicted
    by its movie's average score (duplicates multiply as in the original)."""
    prepare(spark)
    ratings = fixtures.ratings(spark, sf_dir)
    avg = statistics.average_scores(ratings).withColumnRenamed("avg", "prediction")
    predicted = ratings.select("uid", "mid").join(avg, "mid")
    out = als.rmse(ratings, predicted)
    return out.select(F.round("rmse", 6).alias("rmse"), "n")


def q_als_grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    grid = als.grid_search(fixtures.ratings(spark, sf_dir))
    best = als.best_params(grid).select("grid_pos", F.lit(True).alias("is_best"))
    return grid.join(F.broadcast(best), "grid_pos", "left") \
        .withColumn("is_best", F.coalesce("is_best", F.lit(False)))


# ------------------------------------------------------------ streaming ---

def _stream_tables(spark: SparkSession, sf_dir: str, store: bool = False):
    """Static side of the stream: item similarity, written as a table and read
    back (the offline job's output), rated items ('view' events) and recent
    ratings ('click' events). With ``store`` the per-user tables are written by
    uid bucket, as the jobs do, so a stream of several micro-batches reads the
    buckets of its users."""
    sim_path = scratch_path(spark, "item-sim")
    write_table(rec.ranked_similarity(_similarity(spark, sf_dir, ordered=True), ordered=True), sim_path, compression=PAIR_CODEC)
    rated = fixtures.seen(spark, sf_dir)
    recent = rec.recent_ratings(fixtures.recent_log(spark, sf_dir))
    if store:
        rated_path, recent_path = scratch_path(spark, "rated"), scratch_path(spark, "recent")
        write_table(rated, rated_path, sort_by=["uid", "mid"], bucket_by=("uid", 8))
        write_table(recent, recent_path, sort_by=["uid", "pos"], bucket_by=("uid", 8))
        rated, recent = spark.read.parquet(rated_path), read_table(spark, recent_path, schemas.RECENT)
    return spark.read.parquet(sim_path), rated, recent


def q_stream_recent_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recent lists kept as stream state, over several micro-batches and a restart."""
    prepare(spark)
    inbox, out, ckpt = (scratch_path(spark, x) for x in ("recent-in", "recent-out", "recent-ckpt"))
    lines = to_lines(fixtures.recent_log(spark, sf_dir), ["uid", "mid", "score", "timestamp"], "|")
    n_files = max(4, spark.sparkContext.defaultParallelism)
    for part in lines.randomSplit([0.5, 0.5], seed=7):
        part.repartition(n_files).write.mode("append").text(inbox)
        stream = rec.decode_ratings(rec.rating_stream(spark, inbox, maxFilesPerTrigger=(n_files + 1) // 2), mode="failfast")
        recent_state.start_recent(stream, out, ckpt, trigger={"availableNow": True}).awaitTermination()
    res = recent_state.read_recent(spark, out)
    return spark.createDataFrame([], "uid int, pos int, mid int, score double") if res is None else res


def _stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.stream_input(spark, sf_dir).select("uid", "mid", "score", "timestamp")


def q_decode_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    lines = to_lines(fixtures.rating_events(spark, sf_dir), ["uid", "mid", "score", "timestamp"], "|")
    return rec.decode_ratings(lines, mode="failfast")


def q_recent_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return rec.recent_ratings(fixtures.recent_log(spark, sf_dir))


def q_parse_recent_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user newest-first 'mid:score' lists of the whole log (as the list
    store holds them), cut and parsed by the list reader."""
    prepare(spark)
    item = F.concat(F.col("mid").cast("string"), F.lit(":"), F.col("score").cast("string"))
    newest = F.sort_array(F.collect_list(F.struct("ts", "event_id", item.alias("it"))), asc=False)
    lists = fixtures.recent_log(spark, sf_dir).groupBy("uid").agg(newest.alias("_l")).select("uid", F.col("_l.it").alias("items"))
    return rec.parse_recent_list(lists)


def q_stream_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    item_sim, rated, _ = _stream_tables(spark, sf_dir)
    latest = rec.latest_per_user(_stream_events(spark, sf_dir))
    return _rounded(rec.candidates(latest, item_sim, rated))


def q_stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    item_sim, rated, recent = _stream_tables(spark, sf_dir)
    latest = rec.latest_per_user(_stream_events(spark, sf_dir))
    cands = rec.candidates(latest, item_sim, rated)
    return _rounded(rec.score_candidates(cands, recent, item_sim, fixtures.SIMILAR_ABOVE))


def q_stream_recommend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End to end: incoming ratings written as 'uid|mid|score|epoch' text
    files, read by the file stream source a few files per micro-batch
    (availableNow), scored per batch in foreachBatch, upserted per user,
    read back from the sink (latest event per user wins)."""
    prepare(spark)
    item_sim, rated, recent = _stream_tables(spark, sf_dir, store=True)
    inbox = scratch_path(spark, "stream-in")
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    n_files = max(4, spark.sparkContext.defaultParallelism)
    to_lines(_stream_events(spark, sf_dir), ["uid", "mid", "score", "timestamp"], "|") \
        .repartition(n_files).write.mode("overwrite").text(inbox)
    # two or more micro-batches; a user's events may fall into any of them
    stream = rec.rating_stream(spark, inbox, maxFilesPerTrigger=(n_files + 1) // 2)
    q = rec.start(stream, item_sim, rated, recent, out, ckpt, trigger={"availableNow": True},
                  decode="failfast", threshold=fixtures.SIMILAR_ABOVE)
    q.awaitTermination()
    compact(spark, out, version_cols=rec.RESULT_VERSION)
    res = rec.read_results(spark, out)
    if res is None:  # no micro-batch ran: nothing was written
        return spark.createDataFrame([], "uid int, recs_str string")
    # the stored string, its scores rounded
    parts = F.transform(F.filter(F.split("recs_str", r"\|"), lambda x: x != ""), lambda x: F.split(x, ":"))
    shown = F.transform(parts, lambda p: F.format_string("%s:%.4f", p[0], F.round(p[1].cast("double"), 4)))
    return res.select("uid", F.concat_ws("|", shown).alias("recs_str"))


def queries() -> dict[str, Query]:
    return {
        "rate_more": q_rate_more,
        "rate_more_recently": q_rate_more_recently,
        "rate_more_order": q_rate_more_order,
        "rate_more_recently_order": q_rate_more_recently_order,
        "change_date_sql_udf": q_change_date_sql_udf,
        "average_scores": q_average_scores,
        "genre_top10": q_genre_top10,
        "rate_more_sql": q_rate_more_sql,
        "rate_more_recently_sql": q_rate_more_recently_sql,
        "average_scores_sql": q_average_scores_sql,
        "tags_by_movie": q_tags_by_movie,
        "search_documents": q_search_documents,
        "load_movies_roundtrip": q_load_movies_roundtrip,
        "load_ratings_roundtrip": q_load_ratings_roundtrip,
        "load_tags_roundtrip": q_load_tags_roundtrip,
        "write_read_table": q_write_read_table,
        "item_similarity": q_item_similarity,
        "item_similarity_lists": q_item_similarity_lists,
        "item_similarity_exploded": q_item_similarity_exploded,
        "item_similarity_chunks": q_item_similarity_chunks,
        "item_similarity_chunks_exploded": q_item_similarity_chunks_exploded,
        "ratings_of_top_movie": q_ratings_of_top_movie,
        "tags_of_user_and_movie": q_tags_of_user_and_movie,
        "stored_user_lists": q_stored_user_lists,
        "stored_genre_lists": q_stored_genre_lists,
        "factor_top10": q_factor_top10,
        "factor_top10_unseen": q_factor_top10_unseen,
        "item_similarity_pruned": q_item_similarity_pruned,
        "factor_top10_pruned": q_factor_top10_pruned,
        "factor_top10_unseen_pruned": q_factor_top10_unseen_pruned,
        "als_recommend": q_als_recommend,
        "als_recommend_unseen": q_als_recommend_unseen,
        "als_item_similarity": q_als_item_similarity,
        "als_predict_pairs": q_als_predict_pairs,
        "predict_pairs": q_predict_pairs,
        "training_rmse": q_training_rmse,
        "holdout_rmse": q_holdout_rmse,
        "als_half_step": q_als_half_step,
        "als_residuals": q_als_residuals,
        "als_split_residuals": q_als_split_residuals,
        "als_invariants": q_als_invariants,
        "grid_invariants": q_grid_invariants,
        "rmse_join": q_rmse_join,
        "als_grid_search": q_als_grid_search,
        "decode_ratings": q_decode_ratings,
        "recent_ratings": q_recent_ratings,
        "parse_recent_list": q_parse_recent_list,
        "stream_recent_ratings": q_stream_recent_ratings,
        "stream_candidates": q_stream_candidates,
        "stream_scores": q_stream_scores,
        "stream_recommend": q_stream_recommend,
    }
