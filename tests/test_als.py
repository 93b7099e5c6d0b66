from pyspark.sql import functions as F

from recoengine.operators import als


def test_rmse_duplicate_rating_terms(spark):
    actual = spark.createDataFrame([(1, 1, 3.0), (1, 1, 3.0)], "uid int, mid int, score double")
    pred = spark.createDataFrame([(1, 1, 2.0), (1, 1, 2.0)], "uid int, mid int, prediction double")
    assert als.rmse(actual, pred).first().n == 4
    r = als.rmse(actual, pred, dedup=True).first()
    assert r.n == 2 and abs(r.rmse - 1.0) < 1e-12


def test_train_predict_recommend_small(spark):
    rows = [(u, m, float((u * m) % 5 + 1)) for u in range(12) for m in range(15) if (u + m) % 3]
    ratings = spark.createDataFrame(rows, "uid int, mid int, score double")
    movies = spark.createDataFrame([(m,) for m in range(12)], "mid int")
    model = als.train(ratings, rank=4, iterations=3, reg=0.1, seed=1)
    pred = als.predict_pairs(model, ratings)
    assert pred.count() == len(rows)
    r = als.rmse(ratings, pred).first()
    dup = ratings.unionByName(ratings.limit(7))
    for dd in (False, True):
        a = als.rmse(dup, als.predict_pairs(model, dup), dedup=dd).first()
        b = als.model_rmse(model, dup, dedup=dd).first()
        # model_rmse predicts through MLlib (float dot), predict_pairs in double
        assert a.n == b.n and abs(a.rmse - b.rmse) <= 1e-6 * max(1.0, a.rmse)
    # RMSE from factors by hand equals the join result
    uf = {x.id: x.features for x in als.user_factors(model).collect()}
    itf = {x.id: x.features for x in als.item_factors(model).collect()}
    se = [(s - sum(a * b for a, b in zip(uf[u], itf[m]))) ** 2 for u, m, s in rows]
    assert abs(r.rmse - (sum(se) / len(se)) ** 0.5) < 1e-4
    recs = als.recommend_flat(model, ratings, movies, n=3)
    assert recs.where(F.col("mid") >= 12).count() == 0          # only Movie-table items
    assert recs.where(F.col("r") <= 0).count() == 0             # positive only
    assert recs.groupBy("uid").count().where("count > 3").count() == 0
    unseen = als.recommend_flat(model, ratings, movies, n=3, exclude_seen=True)
    assert unseen.join(ratings, ["uid", "mid"]).count() == 0


def test_grid_search_min_is_best(spark):
    rows = [(u, m, float((u + 2 * m) % 5 + 1)) for u in range(8) for m in range(8)]
    ratings = spark.createDataFrame(rows, "uid int, mid int, score double")
    grid = als.grid_search(ratings, ranks=(2, 3), regs=(0.1, 0.01), iterations=2)
    g = grid.collect()
    assert len(g) == 4
    best = als.best_params(grid).first()
    assert best.rmse == min(x.rmse for x in g)


def test_rmse_hot_pair_is_not_multiplied_into_rows(spark):
    k = 3000
    actual = spark.range(k).select(F.lit(1).alias("uid"), F.lit(1).alias("mid"),
                                   (F.col("id") % 2 + 1).cast("double").alias("score"))
    pred = spark.range(k).select(F.lit(1).alias("uid"), F.lit(1).alias("mid"),
                                 F.lit(1.5).alias("prediction"))
    r = als.rmse(actual, pred).first()
    assert r.n == k * k and abs(r.rmse - 0.5) < 1e-12
    d = als.rmse(actual, pred, dedup=True).first()
    assert d.n == k and abs(d.rmse - 0.5) < 1e-12


def test_grid_search_with_holdout_scores_held_out_rows(spark):
    rows = [(u, m, float((u + 2 * m) % 5 + 1)) for u in range(10) for m in range(10)]
    ratings = spark.createDataFrame(rows, "uid int, mid int, score double")
    g = als.grid_search(ratings, ranks=(2,), regs=(0.1,), iterations=2, holdout=0.3, parallelism=1).collect()
    assert len(g) == 1 and g[0].rmse is not None and g[0].rmse >= 0


def test_grid_query_runs_all_iterations(spark, sf_dir, monkeypatch):
    import inspect

    from recoengine.plans import catalog
    real, seen = als.grid_search, []

    def search(*args, **kw):
        bound = inspect.signature(real).bind(*args, **kw)
        bound.apply_defaults()
        seen.append(bound.arguments["iterations"])
        return real(*args, **kw)

    monkeypatch.setattr(als, "grid_search", search)
    found = catalog.q_grid_invariants(spark, sf_dir).first()
    assert (found["rank"], found.gap, found.residual) == (als.GRID_RANKS[0], 0, 0.0)
    assert seen == [als.ITERATIONS]


def test_model_rmse_in_cells_equals_the_transform(spark):
    rows = [(u, m, float((u * m) % 5 + 1)) for u in range(12) for m in range(15) if (u + m) % 3]
    ratings = spark.createDataFrame(rows + rows[:9], "uid int, mid int, score double")
    model = als.train(ratings, rank=4, iterations=2)
    a, b = als.model_rmse(model, ratings).first(), als.model_rmse(model, ratings, broadcast_limit=0)
    assert "FlatMapGroupsInArrow" in b._jdf.queryExecution().analyzed().toString()
    assert b.first().n == a.n and abs(b.first().rmse - a.rmse) < 1e-6


def test_rmse_tasks_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(als, "PAIR_ROWS", 10)
    ratings = spark.createDataFrame([(i, i % 7, 2.0) for i in range(300)], "uid int, mid int, score double")
    out = als.rmse(ratings, ratings.select("uid", "mid", F.lit(1.0).alias("prediction")))
    assert out._jdf.queryExecution().optimizedPlan().toString().count(", 30") >= 2  # both sides dealt over 30 tasks
    assert out.first().n == 300 and out.first().rmse == 1.0


def test_a_large_grid_sums_the_ratings_of_a_pair_once(spark, monkeypatch):
    rows = [(u, m, float((u + 2 * m) % 5 + 1)) for u in range(8) for m in range(8) if (u + m) % 4]
    ratings = spark.createDataFrame(rows + rows[:5], "uid int, mid int, score double")
    plain = [r.rmse for r in als.grid_search(ratings, ranks=(2, 3), regs=(0.1,), iterations=2).collect()]
    real, stored, plans = als.model_rmse, [], []
    save = als.stored_pairs

    def in_cells(*args, **kw):
        out = real(*args, broadcast_limit=0, **kw)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out

    monkeypatch.setattr(als, "FIT_ROWS", 0)
    monkeypatch.setattr(als, "model_rmse", in_cells)
    monkeypatch.setattr(als, "stored_pairs", lambda df: stored.append(save(df)) or stored[-1])
    cells = [r.rmse for r in als.grid_search(ratings, ranks=(2, 3), regs=(0.1,), iterations=2).collect()]
    assert len(stored) == 1 and stored[0].count() == len(rows) and max(abs(a - b) for a, b in zip(plain, cells)) < 1e-6
    # the cells return sums: nothing is grouped by pair after them
    assert len(plans) == 2 and all("FlatMapGroupsInArrow" in p and "Aggregate [uid" not in p for p in plans)


def test_rows_without_a_vector_have_an_empty_list(spark):
    # nulls are gone through again for each row by Spark's Arrow writer
    f = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], "id int, features array<float>")
    sent = []
    pairs = spark.createDataFrame([(i % 4, i % 3, 1.0) for i in range(50)], "uid int, mid int, score double")
    out = als.predict_from_factors(f, f, pairs, broadcast_limit=0)
    sent.append(out._jdf.queryExecution().optimizedPlan().toString())
    assert out.count() == 50 and "null AS features" not in sent[0]


def test_a_block_of_the_fit_does_not_grow_with_the_ratings(spark, monkeypatch):
    for n in (36_000_000, 216_000_000, 10**10):
        nb = als.fit_blocks(n, 12)
        assert nb % 12 == 0 and n / nb <= als.BLOCK_RATINGS
    assert als.fit_blocks(1000, 4) == 10 and als.fit_blocks(36_000_000, 12) == 12
    asked, real = [], als.ALS
    monkeypatch.setattr(als, "ALS", lambda **kw: asked.append((kw["numUserBlocks"], kw["numItemBlocks"])) or real(**kw))
    monkeypatch.setattr(als, "BLOCK_RATINGS", 20)
    ratings = spark.createDataFrame([(u, m, float((u + m) % 5 + 1)) for u in range(20) for m in range(20)], "uid int, mid int, score double")
    model = als.train(ratings, rank=2, iterations=1)
    assert model.userFactors.count() == 20
    als.grid_search(ratings, ranks=(2,), regs=(0.1,), iterations=1)
    assert asked == [(20, 20), (20, 20)] and not ratings.select("uid").is_cached
