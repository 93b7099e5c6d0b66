import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recoengine.operators import blocks, similarity
from recoengine.operators.topn import nest


def _factors(spark, mat, ids=None):
    ids = ids if ids is not None else list(range(len(mat)))
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, mat)],
                                 "id int, features array<float>")


def _f32(m):
    return np.asarray(m, dtype=np.float32).astype(np.float64)


def _naive_sim(mat, ids, t):
    m = _f32(mat)
    n = np.linalg.norm(m, axis=1)
    out = set()
    for i in range(len(m)):
        for j in range(len(m)):
            if i != j and n[i] > 0 and n[j] > 0:
                c = m[i] @ m[j] / (n[i] * n[j])
                if c > t:
                    out.add((ids[i], ids[j], round(c, 9)))
    return out


@pytest.mark.parametrize("stripe_rows", [7, 1000])
def test_similarity_matches_naive_and_is_symmetric(spark, stripe_rows):
    rng = np.random.default_rng(1)
    mat = rng.normal(size=(60, 4))
    ids = list(range(100, 160))
    df = similarity.item_similarity(_factors(spark, mat, ids), 0.6, stripe_rows=stripe_rows)
    got = {(r.mid, r.sim_mid, round(r.r, 9)) for r in df.collect()}
    assert got == _naive_sim(mat, ids, 0.6)
    assert all(a != b and 0.6 < r <= 1.0 + 1e-12 for a, b, r in got)
    assert {(b, a, r) for a, b, r in got} == got


def test_zero_vector_and_exact_threshold(spark):
    mat = [[3, 4], [3, 0], [0, 0], [6, 8]]  # cos(0,1) == 0.6 exactly
    got = {(r.mid, r.sim_mid) for r in similarity.item_similarity(_factors(spark, mat), 0.6).collect()}
    assert got == {(0, 3), (3, 0)}


def _naive_top(U, I, uids, mids, n, seen=(), positive=True):
    U, I = _f32(U), _f32(I)
    out = {}
    for a, u in enumerate(uids):
        sc = []
        for b, m in enumerate(mids):
            if (u, m) in seen:
                continue
            s = float(U[a] @ I[b])
            if positive and not s > 0:
                continue
            sc.append((-s, m))
        out[u] = [m for _, m in sorted(sc)[:n]]
    return {k: v for k, v in out.items() if v}


@pytest.mark.parametrize("stripe_rows", [5, 1000])
def test_top_n_products_matches_naive(spark, stripe_rows):
    rng = np.random.default_rng(7)
    U, I = rng.normal(size=(23, 3)), rng.normal(size=(31, 3))
    uids, mids = list(range(23)), list(range(500, 531))
    seen = {(u, m) for u in uids for m in mids if (u * 7 + m) % 5 == 0}
    seen_df = spark.createDataFrame(sorted(seen) + sorted(seen)[:3], "uid int, mid int")
    for s_df, s_set in [(None, set()), (seen_df, seen)]:
        df = blocks.top_n_products(_factors(spark, U, uids), _factors(spark, I, mids), 4, seen=s_df,
                                   stripe_rows=stripe_rows)
        got = {}
        for r in df.orderBy("uid", "rank").collect():
            got.setdefault(r.uid, []).append(r.mid)
        assert got == _naive_top(U, I, uids, mids, 4, s_set)


def test_top_n_ties_prefer_lower_mid(spark):
    U = [[1.0, 0.0]]
    I = [[1.0, 0.0]] * 5
    df = blocks.top_n_products(_factors(spark, U), _factors(spark, I, [9, 4, 7, 1, 3]), 2)
    assert [r.mid for r in df.orderBy("rank").collect()] == [1, 3]


def test_nest_keeps_rank_order(spark):
    flat = spark.createDataFrame([(1, 2, 10, 0.5), (1, 1, 11, 0.9)], "uid int, rank int, mid int, r double")
    assert [x.mid for x in nest(flat, ["uid"], "rank", "mid", "r").first().recs] == [11, 10]


@settings(max_examples=5, deadline=None)
@given(st.integers(min_value=2, max_value=25), st.integers(min_value=1, max_value=6))
def test_similarity_property_random_sizes(spark, n, stripe):
    rng = np.random.default_rng(n * 31 + stripe)
    mat = rng.normal(size=(n, 3))
    got = {(r.mid, r.sim_mid, round(r.r, 9))
           for r in similarity.item_similarity(_factors(spark, mat), 0.5, stripe_rows=stripe).collect()}
    assert got == _naive_sim(mat, list(range(n)), 0.5)


def test_a_tile_sends_its_pairs_back_in_bounded_batches(monkeypatch):
    monkeypatch.setattr(blocks, "SCREEN_CELLS", 1)
    x = np.random.default_rng(2).normal(size=(400, 4)).astype(np.float32) + 1
    rows = pa.table({"second": pa.array([i % 2 == 1 for i in range(400)]), "id": pa.array(range(400), pa.int32()), "features": pa.array(list(x))})
    got = list(blocks._similar_kernel(0.25, 2)((pa.scalar(1),), iter(rows.to_batches(max_chunksize=90))))
    pairs = {(a, b) for t in got for a, b in zip(t.column("mid").to_pylist(), t.column("sim_mid").to_pylist())}
    assert pairs == {(a, b) for a, b, _ in _naive_sim(x, list(range(400)), 0.25) if a % 2 != b % 2}
    assert sum(t.num_rows for t in got) == len(pairs) and max(t.num_rows for t in got) <= 16 * 200


@pytest.mark.parametrize("positive", [True, False])
def test_screened_top_n_is_exact(monkeypatch, positive):
    monkeypatch.setattr(blocks, "SCREEN_USERS", 7)
    monkeypatch.setattr(blocks, "SCREEN_ITEMS", 11)
    rng = np.random.default_rng(4)
    U, I = rng.normal(size=(40, 5)) * 1e-25, rng.normal(size=(90, 5)) * np.exp(rng.normal(size=(90, 1)))
    U[3], I[7], I[50] = 0, 0, I[20]
    I[60:] = I[20] * (1 + 1e-9 * rng.normal(size=(30, 1)))  # closer than single precision tells apart
    seen = np.unique(rng.integers(0, [40, 90], (500, 2)), axis=0)
    got = {}
    for row, col, value, pos in blocks._best(U, I, 6, positive, seen[:, 0], seen[:, 1]):
        for a, b, p in zip(row.tolist(), col.tolist(), pos.tolist()):
            got.setdefault(a, []).append(b)
            assert len(got[a]) == p + 1
    S = np.einsum("ik,jk->ij", U, I)
    S[seen[:, 0], seen[:, 1]] = -np.inf
    for a in range(40):
        want = [b for b in np.lexsort((np.arange(90), -S[a])) if S[a, b] > (0 if positive else -np.inf)][:6]
        assert np.allclose(S[a, got.get(a, [])], S[a, want], rtol=1e-12, atol=0) and len(got.get(a, [])) == len(want)
        if a != 3:
            assert got.get(a, []) == want or np.allclose(np.diff(np.sort(S[a, want])).min(), 0, atol=1e-30)


def test_similarity_is_one_streaming_kernel(spark):
    plan = blocks.similar_pairs(_factors(spark, np.eye(3)), 0.5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 1 and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("shape", [(1, 1), (5, 13), (40, 90), (33, 64)])
@pytest.mark.parametrize("same", [False, True])
def test_screening_marks_what_exceeds_the_limit(monkeypatch, shape, same):
    monkeypatch.setattr(blocks, "SCREEN_CELLS", 1)
    monkeypatch.setattr(blocks, "SCREEN_COLS", 13)
    rng = np.random.default_rng(6)
    a = rng.normal(size=(shape[0], 4)).astype(np.float32)
    b = a if same else rng.normal(size=(shape[1], 4)).astype(np.float32)
    got = [(rows.start + i, cols.start + j) for rows, cols, rr, cc in blocks._screened(a, b, np.float32(0.5), same) for i, j in zip(rr, cc)]
    assert len(got) == len(set(got))
    want = {(i, j) for i in range(len(a)) for j in range(len(b)) if a[i] @ b[j] > 0.5}
    if same:  # blocks below the diagonal are left out
        got, want = {p for p in got if p[0] < p[1]}, {p for p in want if p[0] < p[1]}
    assert set(got) == want


def test_few_pairs_of_a_tile_come_back_in_one_batch():
    x = np.random.default_rng(7).normal(size=(6000, 16)).astype(np.float32)
    x[3000:3010] = x[:10]
    rows = pa.table({"second": pa.array([i >= 3000 for i in range(6000)]), "id": pa.array(range(6000), pa.int32()), "features": pa.array(list(x))})
    got = list(blocks._similar_kernel(0.99, 2)((pa.scalar(1),), iter(rows.to_batches())))
    assert [t.num_rows for t in got] == [10, 10]  # one a direction; not one a step of the tile
    assert set(zip(got[0].column("mid").to_pylist(), got[0].column("sim_mid").to_pylist())) == {(i, 3000 + i) for i in range(10)}


def _listed(df):
    return {r.mid: [(x.mid, x.r) for x in r.recs] for r in df.collect()}


@pytest.mark.parametrize("whole", [1 << 20, 10])
def test_lists_in_order_shuffle_items_and_no_pairs(spark, monkeypatch, whole):
    monkeypatch.setattr(blocks, "WHOLE_ITEMS", whole)
    monkeypatch.setattr(blocks, "ORDERED_PAIRS", 50)
    monkeypatch.setattr(blocks, "MIN_STRIPE_ROWS", 40)
    rng = np.random.default_rng(9)
    rows = [(int(i), [float(x) for x in rng.choice([-1.0, 0.0, 0.5, 2.0], 3)]) for i in rng.integers(0, 150, 200)]  # ids and ties that repeat
    rows += [(None, [1.0, 1.0, 1.0]), (500, None), (501, [0.0, 0.0, 0.0]), (502, [1.0, None, 1.0]), (503, [float("nan"), 1.0, 1.0])]
    f = spark.createDataFrame(rows, "id int, features array<float>").repartition(3)
    ordered = similarity.item_similarity(f, 0.3, ordered=True)
    lists = similarity.item_similarity_lists(ordered, ordered=True)
    pairs = similarity.item_similarity(f, 0.3)
    want = _listed(similarity.item_similarity_lists(pairs))
    assert len(want) > 100 and lists.count() == len(want) and _listed(lists) == want
    ranked = similarity.ranked_similarity(ordered, ordered=True)
    assert sorted(map(tuple, ranked.select("mid", "rank", "sim_mid", "r").collect())) == \
        sorted((m, i + 1, s, r) for m, entries in want.items() for i, (s, r) in enumerate(entries))
    if whole > 10:
        fresh = similarity.item_similarity(_factors(spark, np.eye(3)), 0.3, ordered=True)
        for df in (similarity.item_similarity_lists(fresh, ordered=True), similarity.ranked_similarity(fresh, ordered=True)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 1 and plan.count("FlatMapGroupsInArrow") == 1 and "Window" not in plan


@pytest.mark.parametrize("size", [1, 2, 3, 5, 100])
def test_runs_are_packed_and_numbered_across_batches(size):
    mids = [4] * 3 + [7] + [2] * 6 + [9] * 2
    rows = pa.table({"mid": pa.array(mids, pa.int32()), "sim_mid": pa.array(range(12), pa.int32()), "r": pa.array([1 - i / 20 for i in range(12)])})
    batches = [b for part in rows.to_batches(max_chunksize=size) for b in (part.slice(0, 0), part)]
    packed = [x for b in similarity._pack(iter(batches)) for x in b.to_pylist()]
    assert [(x["mid"], [e["mid"] for e in x["recs"]]) for x in packed] == [(4, [0, 1, 2]), (7, [3]), (2, [4, 5, 6, 7, 8, 9]), (9, [10, 11])]
    numbered = [x for b in similarity._number(iter(batches)) for x in b.column("rank").to_pylist()]
    assert numbered == [1, 2, 3, 1, 1, 2, 3, 4, 5, 6, 1, 2]
    assert not list(similarity._pack(iter([]))) and not list(similarity._number(iter([])))


@pytest.mark.parametrize("positive", [True, False])
def test_items_pass_by_the_users_of_a_tile(spark, monkeypatch, positive):
    monkeypatch.setattr(blocks, "SCREEN_USERS", 7)
    monkeypatch.setattr(blocks, "SCREEN_ITEMS", 11)
    rng = np.random.default_rng(12)
    U, I = rng.normal(size=(60, 4)), rng.normal(size=(150, 4)) * np.exp(rng.normal(size=(150, 1)))
    I[90] = I[20]  # a tie
    mids = rng.permutation(150)
    score = np.einsum("ik,jk->ij", U.astype(np.float32).astype(np.float64), I.astype(np.float32).astype(np.float64))
    seen = {(int(u), int(mids[m])) for u in range(60) for m in np.argsort(-score[u])[:4]}  # the best ones
    rows = [*_factors(spark, U).collect(), (77, None), (None, [1.0] * 4), (78, [float("nan"), 1.0, 1.0, 1.0])]
    users = spark.createDataFrame(rows, "id int, features array<float>").repartition(3)
    items = spark.createDataFrame([*_factors(spark, I, mids).collect(), (900, None), (901, [float("inf"), 1.0, 1.0, 1.0]), (None, [9.0] * 4)], "id int, features array<float>")
    pairs = spark.createDataFrame([*sorted(seen), (5, None), (None, 5), (5, 9999), (9999, 5)], "uid int, mid int")
    df = blocks.top_n_products(users, items, 5, seen=pairs, positive_only=positive, stripe_rows=5)
    got = {}
    for r in sorted(df.collect()):
        got.setdefault(r.uid, []).append(r.mid)
        assert r["rank"] == len(got[r.uid])
    want = _naive_top(U, I, list(range(60)), mids.tolist(), 5, seen, positive)
    assert got == want
    # one task a stripe makes whole lists: no entry is shuffled, one partition a tile
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FlatMapGroupsInArrow") == 1 and "Window" not in plan and df.rdd.getNumPartitions() == 4


def test_a_row_of_an_id_that_comes_twice_has_its_own_list(spark):
    U, I = np.eye(2) + 1, np.array([[1.0, 2.0], [3.0, 1.0], [3.0, 1.0]])
    seen = spark.createDataFrame([(4, 8)], "uid int, mid int")
    got = sorted((r.uid, r["rank"], r.mid) for r in blocks.top_n_products(_factors(spark, U, [4, 4]), _factors(spark, I, [7, 8, 8]), 3, seen=seen).collect())
    assert got == [(4, 1, 7), (4, 1, 7)]


def test_tiles_are_not_dealt_by_hash(spark):
    x = np.random.default_rng(13).normal(size=(4000, 4))
    for df, full in ((blocks.similar_pairs(_factors(spark, x), 0.9, stripe_rows=1000), 10), (blocks.similar_pairs_by_item(_factors(spark, x), 0.9, stripe_rows=1000), 7)):
        sizes = [len(p) for p in df.select("mid").rdd.glom().collect()]
        assert sum(n > 0 for n in sizes) == full
