"""Explicit-feedback ALS and what is derived from it (M1-M3, M5, M6, J4,
J5, J7, A6, A8, A9, F2, T4, T7, K6).

Training is MLlib's distributed ALS; scoring users x movies goes through
the blocked product kernel instead of a cartesian of ids, and the
similarity of item factors through the blocked cosine kernel.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recoengine.functions.scalar import dot
from recoengine.operators import blocks
from recoengine.operators.cells import CELL_ROWS, in_cells, stored_pairs
from recoengine.operators.similarity import SIM_THRESHOLD, item_similarity
from recoengine.operators.topn import nest
from recoengine.session import prepare, scratch_path

# ALS setting (rank, iterations, lambda), list length per
# user, and the parameter grid (ranks x lambdas).
RANK, ITERATIONS, REG = 50, 5, 0.01
TOP_N_USER = 10
GRID_RANKS = (40, 50, 60)
GRID_REGS = (0.1, 0.01)
# Ratings above which the fits of a grid keep the disk to themselves.
FIT_ROWS = 5_000_000
# Ratings of a block of MLlib's fit, about; a task holds the other side's factors of its
# block's ratings. (Below that, blocks follow the cluster's parallelism.)
BLOCK_RATINGS = 3_000_000
# Ratings that a task of the RMSE join groups by pair, about.
PAIR_ROWS = 500_000


def _training_frame(ratings: DataFrame) -> DataFrame:
    return ratings.select(F.col("uid").cast("int").alias("uid"), F.col("mid").cast("int").alias("mid"),
                          F.col("score").cast("float").alias("score"))


def fit_blocks(n_ratings: int, parallelism: int) -> int:
    """User and item blocks of a fit: the cluster's parallelism, or a multiple of it
    that keeps a block at ``BLOCK_RATINGS``, so what a task holds doesn't grow with
    the ratings."""
    least = max(10, parallelism)
    return least * max(1, math.ceil(n_ratings / BLOCK_RATINGS / least))


def train(ratings: DataFrame, rank: int = RANK, iterations: int = ITERATIONS, reg: float = REG,
          seed: int = 42, num_blocks: int | None = None, checkpoint_interval: int = 2) -> ALSModel:
    """Fit ALS on (uid, mid, score). Blocks default to what ``fit_blocks`` makes of the
    counted ratings; intermediate state is kept MEMORY_AND_DISK and the lineage
    is checkpointed to the shared folder every ``checkpoint_interval``
    iterations (each, with more blocks than tasks), so a lost executor costs a
    recompute, not the job."""
    spark = ratings.sparkSession
    prepare(spark)
    frame = _training_frame(ratings)
    own = num_blocks is None
    if own:  # counted and fitted from one pass over the source
        frame = frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        parallelism = spark.sparkContext.defaultParallelism
        nb = num_blocks or fit_blocks(frame.count(), parallelism)
        if nb > max(10, parallelism):  # more is shuffled: a fit keeps the files up to its last checkpoint
            checkpoint_interval = 1
        als = ALS(rank=rank, maxIter=iterations, regParam=reg, implicitPrefs=False, nonnegative=False,
                  userCol="uid", itemCol="mid", ratingCol="score", coldStartStrategy="drop",
                  seed=seed, numUserBlocks=nb, numItemBlocks=nb, checkpointInterval=checkpoint_interval,
                  intermediateStorageLevel="MEMORY_AND_DISK", finalStorageLevel="MEMORY_AND_DISK")
        return als.fit(frame)
    finally:
        if own:
            frame.unpersist()


def item_factors(model: ALSModel) -> DataFrame:
    """(id, features array<float>)."""
    return model.itemFactors.select(F.col("id").cast("int").alias("id"), "features")


def user_factors(model: ALSModel) -> DataFrame:
    return model.userFactors.select(F.col("id").cast("int").alias("id"), "features")


# The factor tables are broadcast to the pair side only when the measured size of
# each (rows x rank x 4 bytes) is below this bound; otherwise they meet in cells.
FACTOR_BROADCAST_BYTES = 64 * 1024 * 1024


def _predicted(columns: Sequence[str]):
    def kernel(pairs: pa.Table, u: np.ndarray, v: np.ndarray, known: np.ndarray) -> pa.Table:
        prediction = np.einsum("ij,ij->i", u, v)
        return pairs.select(list(columns)).append_column("prediction", pa.array(prediction, pa.float64(), mask=~known))
    return kernel


def predict_from_factors(users_f: DataFrame, items_f: DataFrame, pairs: DataFrame,
                         broadcast_limit: int = FACTOR_BROADCAST_BYTES, rank: int = RANK, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The rows of ``pairs`` (uid, mid, ...) with ``prediction``, the dot product
    of the two factor rows; pairs whose user or item has no factors vanish
    (cold-start drop = inner joins), duplicates are kept. The factor tables are
    broadcast after a size check; otherwise the pairs meet them in cells, so no
    vector travels with a pair."""
    p = pairs.withColumns({"uid": F.col("uid").cast("int"), "mid": F.col("mid").cast("int")})
    if max(users_f.count(), items_f.count()) * rank * 4 > broadcast_limit:
        schema = T.StructType([*p.schema, T.StructField("prediction", T.DoubleType())])
        return in_cells(p, users_f, items_f, _predicted(p.columns), schema, cell_rows)
    uf = F.broadcast(users_f.select("id", "features").toDF("uid", "_uf"))
    itf = F.broadcast(items_f.select("id", "features").toDF("mid", "_itf"))
    return p.join(uf, "uid").join(itf, "mid").withColumn("prediction", dot(F.col("_uf"), F.col("_itf"))) \
        .select(*pairs.columns, "prediction")


def predict_pairs(model: ALSModel, pairs: DataFrame,
                  broadcast_limit: int = FACTOR_BROADCAST_BYTES) -> DataFrame:
    """(uid, mid, prediction) for each input pair, from a fitted model."""
    return predict_from_factors(user_factors(model), item_factors(model), pairs.select("uid", "mid"),
                                broadcast_limit, model.rank)


def _score(model: ALSModel, rows: DataFrame) -> DataFrame:
    """``rows`` (uid, mid, ...) plus a ``prediction`` column through
    ``ALSModel.transform`` (compiled float dot product; its join
    partitioning is reused by a following per-pair aggregation)."""
    m = model.copy().setColdStartStrategy("drop").setPredictionCol("prediction")
    return m.transform(rows).withColumn("prediction", F.col("prediction").cast("double"))


def save_factors(model: ALSModel, path: str) -> tuple[DataFrame, DataFrame]:
    """Write user and item factors as tables and return them read back:
    later stages then start from storage, not from the fit's lineage, so a
    lost executor costs a re-read instead of a re-fit."""
    return save_tables(user_factors(model), item_factors(model), path)


def save_tables(users_f: DataFrame, items_f: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    spark = users_f.sparkSession
    users_f.write.mode("overwrite").parquet(f"{path}/user_factors")
    items_f.write.mode("overwrite").parquet(f"{path}/item_factors")
    return (spark.read.parquet(f"{path}/user_factors"), spark.read.parquet(f"{path}/item_factors"))


def recommend_from_factors(users_f: DataFrame, items_f: DataFrame, ratings: DataFrame, movies: DataFrame,
                           n: int = TOP_N_USER, exclude_seen: bool = False,
                           trained_on_ratings: bool = False) -> DataFrame:
    """(uid, rank, mid, r): best ``n`` positive predictions per rating user
    over the movies of the Movie table. By default rated movies stay
    candidates, as in the original job; ``exclude_seen`` removes them
    before the top-n (so lists still fill up to n). With
    ``trained_on_ratings`` the factors come from a fit on ``ratings``, so
    every factor user is a rating user and the pass over ratings that
    finds them is skipped."""
    users, items, seen = rating_users_and_items(users_f, items_f, ratings, movies, exclude_seen, trained_on_ratings)
    return blocks.top_n_products(users, items, n, seen=seen, positive_only=True)


def rating_users_and_items(users_f: DataFrame, items_f: DataFrame, ratings: DataFrame, movies: DataFrame, exclude_seen: bool,
                           trained_on_ratings: bool = False) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Factors of the rating users and of the Movie table's items, and the rated
    pairs if they are to be left out."""
    users = users_f if trained_on_ratings else users_f.join(
        ratings.select(F.col("uid").cast("int").alias("id")).distinct(), "id", "left_semi")
    items = items_f.join(movies.select(F.col("mid").cast("int").alias("id")), "id", "left_semi")
    return users, items, ratings.select("uid", "mid") if exclude_seen else None


def recommend_flat(model: ALSModel, ratings: DataFrame, movies: DataFrame, n: int = TOP_N_USER,
                   exclude_seen: bool = False) -> DataFrame:
    """As ``recommend_from_factors`` for a model fitted on ``ratings``."""
    return recommend_from_factors(user_factors(model), item_factors(model), ratings, movies, n, exclude_seen,
                                  trained_on_ratings=True)


def recommend(model: ALSModel, ratings: DataFrame, movies: DataFrame, n: int = TOP_N_USER,
              exclude_seen: bool = False) -> DataFrame:
    """(uid, recs array<struct<mid, r>>) as stored per user."""
    return nest(recommend_flat(model, ratings, movies, n, exclude_seen), ["uid"], "rank", "mid", "r")


def item_similarity_from_model(model: ALSModel, threshold: float = SIM_THRESHOLD) -> DataFrame:
    return item_similarity(item_factors(model), threshold)


def rmse(actual: DataFrame, predicted: DataFrame, dedup: bool = False) -> DataFrame:
    """One row (rmse, n) of actual (uid, mid, score) against predicted
    (uid, mid, prediction), matched on both keys.

    Semantics of the original join: a pair with k_a ratings and k_p
    predictions contributes every k_a x k_p combination; ``dedup`` scores
    each rating row once against the pair's mean prediction. Both sides are
    aggregated per pair before the join (count, sum, sum of squares), so
    the join is one-to-one and a heavily repeated pair never multiplies
    into k_a x k_p rows:
        sum_ij (a_i - p_j)^2 = k_a * k_p * ((mean a - mean p)^2 + var a + var p)
    No term can be negative, so nothing cancels for a good model. Pairs seldom
    repeat, so both sides are dealt by pair first, over as many tasks as the
    counted ratings need.
    """
    score = F.col("score").cast("double")
    parts = max(actual.sparkSession.sparkContext.defaultParallelism, math.ceil(actual.count() / PAIR_ROWS))
    actual = actual.select(F.col("uid").cast("int").alias("uid"), F.col("mid").cast("int").alias("mid"), "score").repartition(parts, "uid", "mid")
    predicted = predicted.select("uid", "mid", "prediction").repartition(parts, "uid", "mid")
    a = actual.groupBy("uid", "mid").agg(
        F.count(score).alias("ka"), F.avg(score).alias("ma"), F.var_pop(score).alias("va"))
    p = predicted.groupBy("uid", "mid").agg(
        F.count("prediction").alias("kp"), F.avg("prediction").alias("mp"), F.var_pop("prediction").alias("vp"))
    j = a.join(p, ["uid", "mid"])
    ka, kp = F.col("ka"), F.col("kp")
    apart = (F.col("ma") - F.col("mp")) ** 2 + F.col("va")
    if dedup:
        se, n = ka * apart, ka
    else:
        se, n = ka * kp * (apart + F.col("vp")), ka * kp
    return j.agg(F.sqrt(F.sum(se) / F.sum(n)).alias("rmse"), F.sum(n).cast("bigint").alias("n"))


def pair_sums(ratings: DataFrame) -> DataFrame:
    """(uid, mid, k, ka, ma, va), stored: ratings of each pair, those with a score,
    their mean and variance. All that ``model_rmse`` needs of them, whatever the model."""
    score = F.col("score").cast("double")
    return stored_pairs(_training_frame(ratings).groupBy("uid", "mid").agg(
        F.count(F.lit(1)).alias("k"), F.count(score).alias("ka"), F.avg(score).alias("ma"), F.var_pop(score).alias("va")))


def _squares(dedup: bool):
    """One row of some pairs: the sum of squared errors, the terms, and the pairs with an error."""
    def kernel(pairs: pa.Table, u: np.ndarray, v: np.ndarray, known: np.ndarray) -> pa.Table:
        k, ka, ma, va = (pairs.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("k", "ka", "ma", "va"))
        weight = np.ones(len(k)) if dedup else k
        use = known & (ka > 0)
        se = weight[use] * ka[use] * ((ma[use] - np.einsum("ij,ij->i", u, v)[use]) ** 2 + va[use])
        return pa.table({"se": [se.sum()], "n": [int((weight * k).sum())], "known": [int(use.sum())]})
    return kernel


def model_rmse(model: ALSModel, ratings: DataFrame, dedup: bool = False,
               broadcast_limit: int = FACTOR_BROADCAST_BYTES, sums: DataFrame | None = None) -> DataFrame:
    """``rmse(ratings, predict_pairs(model, ratings), dedup)`` without the
    self-join: predictions are made on the rating rows themselves, and a
    pair rated k times (one prediction p per pair) contributes
    k * sum_i (score_i - p)^2 over k*k terms, exactly what the join gives.
    With factor tables over ``broadcast_limit`` the pairs' ``sums`` (``pair_sums`` of the
    ratings, made here if not given) meet them in cells, which return sums of squares: the
    joins of ``ALSModel.transform`` would shuffle a vector with every rating."""
    users_f, items_f = user_factors(model), item_factors(model)
    if max(users_f.count(), items_f.count()) * model.rank * 4 > broadcast_limit:
        sums = pair_sums(ratings) if sums is None else sums
        found = in_cells(sums, users_f, items_f, _squares(dedup), "se double, n long, known long")
        total = F.when(F.sum("known") > 0, F.sum("se"))
        return found.agg(F.sqrt(total / F.sum("n")).alias("rmse"), F.sum("n").alias("n"))
    rows = _training_frame(ratings).withColumn("score", F.col("score").cast("double"))
    return rmse_of_scored(_score(model, rows), dedup)


def rmse_of_scored(scored: DataFrame, dedup: bool = False) -> DataFrame:
    """(rmse, n) of rating rows (uid, mid, score) that carry ``prediction``."""
    err2 = (F.col("score") - F.col("prediction")) ** 2
    per_pair = scored.groupBy("uid", "mid").agg(F.count(F.lit(1)).alias("k"), F.sum(err2).alias("se"))
    w = F.lit(1) if dedup else F.col("k")
    return per_pair.agg(F.sqrt(F.sum(w * F.col("se")) / F.sum(w * F.col("k"))).alias("rmse"),
                        F.sum(w * F.col("k")).alias("n"))


def grid_search(ratings: DataFrame, ranks: Sequence[int] = GRID_RANKS, regs: Sequence[float] = GRID_REGS,
                iterations: int = ITERATIONS, seed: int = 42, holdout: float = 0.0,
                dedup: bool = False, parallelism: int = 2) -> DataFrame:
    """(grid_pos, rank, reg, rmse) for every (rank, reg). Each fit and each
    RMSE is a distributed job; only one number per fit returns to the
    driver. ``holdout = 0`` scores on the training set like the original;
    ``holdout > 0`` scores on a random held-out share. ``parallelism``
    fits are submitted concurrently (as ``CrossValidator`` does) so small
    stages of one fit do not leave the cluster idle; over ``FIT_ROWS`` ratings
    they follow one another, a fit's shuffle files go before the next, and the
    ratings of each pair are summed once for all of them."""
    spark = ratings.sparkSession
    data = _training_frame(ratings).persist(StorageLevel.MEMORY_AND_DISK)
    grid = list(enumerate(product(ranks, regs)))

    def fit_one(item):
        pos, (rk, rg) = item
        model = train(fit_on, rank=rk, iterations=iterations, reg=rg, seed=seed, num_blocks=blocks_)
        res = model_rmse(model, test, dedup=dedup, sums=sums).first()
        model.userFactors.unpersist()
        model.itemFactors.unpersist()
        del model
        # Spark deletes the shuffle files of plans that the driver has collected
        spark.sparkContext._jvm.System.gc()
        return (pos, int(rk), float(rg), float(res["rmse"]) if res["rmse"] is not None else None)

    try:
        if holdout > 0:
            fit_on, test = data.randomSplit([1.0 - holdout, holdout], seed=seed)
        else:
            fit_on = test = data
        n_ratings = data.count()
        large, blocks_ = n_ratings > FIT_ROWS, fit_blocks(n_ratings, spark.sparkContext.defaultParallelism)
        sums = pair_sums(test) if large else None
        workers = 1 if large else max(1, min(int(parallelism), len(grid)))
        if workers == 1:
            rows = [fit_one(g) for g in grid]
        else:
            with ThreadPoolExecutor(max_workers=workers) as pool:
                rows = list(pool.map(inheritable_thread_target(spark)(fit_one), grid))
    finally:
        data.unpersist()
    return spark.createDataFrame(sorted(rows), "grid_pos int, rank int, reg double, rmse double")


def last_out(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test) by time: each user's newest rating (greatest timestamp, then
    mid, then score) is the test row, if the user has others. ``ratings`` is
    numbered and stored first, so that of equal rows one goes; the newest row is a
    maximum, combined before the shuffle."""
    spark = prepare(ratings.sparkSession)
    path = scratch_path(spark, "last-out")
    ratings.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    newest = rows.groupBy("uid").agg(F.max(F.struct("timestamp", "mid", "score", "_row"))["_row"].alias("_row"), F.count(F.lit(1)).alias("_n"))
    newest = newest.where("_n > 1").select("_row")
    return rows.join(newest, "_row", "left_anti").drop("_row"), rows.join(newest, "_row", "left_semi").drop("_row")


def halving_search(ratings: DataFrame, ranks: Sequence[int] = GRID_RANKS, regs: Sequence[float] = GRID_REGS,
                   iterations: int = ITERATIONS, seed: int = 42) -> DataFrame:
    """(round, grid_pos, rank, reg, iterations, rmse, kept): successive halving of
    the grid on the ``last_out`` split. Every setting is fitted with few iterations,
    the better half goes on with more, until one is left at ``iterations``. Only one
    number a fit returns to the driver."""
    train_rows, test = last_out(ratings)
    alive = list(enumerate(product(ranks, regs)))
    rounds = max(1, (len(alive) - 1).bit_length() + 1)
    out = []
    for k in range(rounds):
        budget = max(1, round(iterations * (k + 1) / rounds))
        scored = []
        for pos, (rank, reg) in alive:
            model = train(train_rows, rank=rank, iterations=budget, reg=reg, seed=seed)
            found = model_rmse(model, test).first()["rmse"]
            model.userFactors.unpersist()
            model.itemFactors.unpersist()
            scored.append((float("inf") if found is None else float(found), pos, int(rank), float(reg)))
        kept = {pos for _, pos, *_ in sorted(scored)[:max(1, (len(scored) + 1) // 2)]}
        out += [(k, pos, rank, reg, budget, rmse_, pos in kept) for rmse_, pos, rank, reg in scored]
        alive = [a for a in alive if a[0] in kept]
    return ratings.sparkSession.createDataFrame(out, "round int, grid_pos int, rank int, reg double, iterations int, rmse double, kept boolean")


def best_params(grid: DataFrame) -> DataFrame:
    """Smallest RMSE (first grid position on ties), one row."""
    return grid.orderBy(F.asc_nulls_last("rmse"), F.asc("grid_pos")).limit(1)
