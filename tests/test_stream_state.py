"""What a running stream keeps and takes up: state, versions, results."""
import os
import time

from pyspark.sql import functions as F

from recoengine.operators import als
from recoengine.session import scratch_path
from recoengine.sources import sinks, tables
from recoengine.streaming import recent_state
from recoengine.streaming import recommender as rec
from recoengine.streaming.snapshots import Snapshots


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def _sim(spark, pairs):
    return spark.createDataFrame([x for a, b, r in pairs for x in ((a, b, r), (b, a, r))], "mid int, sim_mid int, r double")


def _recent(spark, uid, items):
    return spark.createDataFrame([(uid, i, m, s) for i, (m, s) in enumerate(items)], "uid int, pos int, mid int, score double")


def test_recent_lists_as_state_over_batches_and_a_restart(spark):
    inbox, out, ckpt = (scratch_path(spark, x) for x in ("in", "out", "ckpt"))
    log = [(u, m, (u + m) % 10 / 2, t) for t in range(60) for u, m in [(t % 3, t * 7 % 40)]] + [(9, 1, 1.0, 5), (9, 2, 2.0, 5), (0, 99, 5.0, 3)]
    parts = [log[:20], log[40:], log[20:40]]  # late ratings in the last file
    for i, part in enumerate(parts):
        _write(inbox, f"{i}.txt", [f"{u}|{m}|{s}|{t}" for u, m, s, t in part])
        stream = rec.decode_ratings(rec.rating_stream(spark, inbox, maxFilesPerTrigger=1))
        recent_state.start_recent(stream, out, ckpt, trigger={"availableNow": True}, n=4).awaitTermination()
    want = rec.recent_ratings(spark.createDataFrame(log, "uid int, mid int, score double, timestamp long"), n=4, order=("timestamp", "mid", "score"))
    assert sorted(map(tuple, recent_state.read_recent(spark, out).collect())) == sorted(map(tuple, want.collect()))


def test_state_of_idle_users_goes(spark):
    inbox, out, ckpt = (scratch_path(spark, x) for x in ("in", "out", "ckpt"))
    os.makedirs(inbox)
    q = recent_state.start_recent(rec.decode_ratings(rec.rating_stream(spark, inbox)), out, ckpt, trigger={"processingTime": "100 milliseconds"}, idle_ms=1)

    def lists():
        found = recent_state.read_recent(spark, out)
        return [] if found is None else sorted(map(tuple, found.collect()))

    def wait(want):
        for _ in range(60):
            if lists() == want or q.exception():
                break
            time.sleep(0.5)
        assert lists() == want, q.exception()

    try:
        _write(inbox, "a.txt", ["1|5|1.0|10", "2|6|1.0|11"])
        wait([(1, 0, 5, 1.0), (2, 0, 6, 1.0)])
        time.sleep(5)  # batches without rows fire the timers
        _write(inbox, "b.txt", ["1|7|2.0|12"])
        wait([(1, 0, 7, 2.0), (2, 0, 6, 1.0)])  # user 1 began anew
    finally:
        q.stop()


def test_a_new_similarity_version_is_used_without_a_restart(spark):
    inbox, out, ckpt, root = (scratch_path(spark, x) for x in ("in", "out", "ckpt", "versions"))
    versions = Snapshots(spark, root)
    assert versions.publish(rec.ranked_similarity(_sim(spark, [(5, 20, 0.9), (20, 10, 0.8)]))) == 1
    rated, recent = spark.createDataFrame([], "uid int, mid int"), _recent(spark, 1, [(10, 4.0)])
    os.makedirs(inbox)
    q = rec.start(rec.decode_ratings(rec.rating_stream(spark, inbox)), versions, rated, recent, out, ckpt, trigger={"processingTime": "200 milliseconds"})
    try:
        _write(inbox, "a.txt", ["1|5|5.0|100"])
        q.processAllAvailable()
        assert rec.read_results(spark, out).first().recs_str.startswith("20:")
        os.makedirs(f"{root}/part=gen-7")  # a version whose write never ended
        assert versions.latest() == 1
        assert versions.publish(rec.ranked_similarity(_sim(spark, [(5, 30, 0.9), (30, 10, 0.7)]))) == 8
        _write(inbox, "b.txt", ["1|5|5.0|200"])
        q.processAllAvailable()
        assert rec.read_results(spark, out).first().recs_str.startswith("30:") and versions.version == 8
    finally:
        q.stop()


def test_the_default_trigger_runs_batch_after_batch(spark):
    inbox, out, ckpt = (scratch_path(spark, x) for x in ("in", "out", "ckpt"))
    os.makedirs(inbox)
    rated, recent = spark.createDataFrame([], "uid int, mid int"), _recent(spark, 1, [(10, 4.0)])
    q = rec.start(rec.decode_ratings(rec.rating_stream(spark, inbox)), _sim(spark, [(5, 20, 0.9), (20, 10, 0.8)]), rated, recent, out, ckpt, compact_every=1)
    try:
        for i in range(4):
            _write(inbox, f"{i}.txt", [f"{i}|5|5.0|{i}"])
            q.processAllAvailable()
        assert q.isActive and q.lastProgress["batchId"] >= 3
        assert {r.uid for r in rec.read_results(spark, out).collect()} == {0, 1, 2, 3}
        for _ in range(100):  # the compaction runs beside the batches
            if sinks._state(spark, out)[0]:
                break
            time.sleep(0.2)
        assert sinks._state(spark, out)[0]
        assert {r.uid for r in rec.read_results(spark, out).collect()} == {0, 1, 2, 3}
    finally:
        q.stop()


def test_a_replayed_batch_overwrites_its_own_rows(spark):
    out = scratch_path(spark, "replay")
    process = rec.batch_writer(_sim(spark, [(5, 20, 0.9), (20, 10, 0.8)]), spark.createDataFrame([], "uid int, mid int"), _recent(spark, 1, [(10, 4.0)]), out)
    events = spark.createDataFrame([(u, 5, 5.0, 100) for u in range(30)], "uid int, mid int, score double, timestamp long")
    process(events, 0)
    process(events.where("uid < 5"), 1)
    before = sinks._rows(spark, out).count()
    process(events.where("uid < 5"), 1)
    process(events, 0)
    assert sinks._rows(spark, out).count() == before == 35
    assert rec.read_results(spark, out).count() == 30
    process(events.limit(0), 2)  # a batch without rows
    assert sinks.compact(spark, out, version_cols=rec.RESULT_VERSION, leave=1) == 1
    assert sinks._rows(spark, out).count() == rec.read_results(spark, out).count() == 30
    assert len(sinks.vacuum(spark, out)) == 2 and rec.read_results(spark, out).count() == 30


def test_a_batch_prunes_folders_without_collecting(spark, monkeypatch):
    rated, recent = scratch_path(spark, "rated"), scratch_path(spark, "recent")
    rows = spark.createDataFrame([(u, m) for u in range(400) for m in range(3)], "uid int, mid int")
    tables.write_table(rows, rated, bucket_by=("uid", 16))
    tables.write_table(rows.select("uid", F.col("mid").alias("pos"), F.lit(10).alias("mid"), F.lit(4.0).alias("score")), recent, bucket_by=("uid", 16))
    sims = rec.ranked_similarity(_sim(spark, [(5, 20, 0.9), (20, 10, 0.8), (5, 1, 0.95)]))
    events = spark.createDataFrame([(3, 5, 5.0, 100)], "uid int, mid int, score double, timestamp long")
    kind = type(events)
    real = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: (_ for _ in ()).throw(AssertionError("collected")))
    out = rec.recommend_batch(events, sims, spark.read.parquet(rated), spark.read.parquet(recent))
    monkeypatch.setattr(kind, "collect", real)
    assert [r.recs_str.split(":")[0] for r in out.collect()] == ["20"]
    for path in (rated, recent):
        rows = rec._rows_of(rec.batch_users(events), spark.read.parquet(path))
        assert {r.uid for r in rows.collect()} == {3}
        plan = rows._jdf.queryExecution().executedPlan()
        assert "dynamicpruningexpression(uid_bucket_16" in plan.toString()


def test_last_out_split(spark):
    rows = [(1, 1, 1.0, 5), (1, 2, 2.0, 9), (1, 3, 3.0, 9), (2, 1, 1.0, 1), (3, 1, 1.0, 1), (3, 1, 1.0, 1)]
    train, test = als.last_out(spark.createDataFrame(rows, "uid int, mid int, score double, timestamp long"))
    assert sorted(map(tuple, test.collect())) == [(1, 3, 3.0, 9), (3, 1, 1.0, 1)]
    assert sorted(map(tuple, train.collect())) == [(1, 1, 1.0, 5), (1, 2, 2.0, 9), (2, 1, 1.0, 1), (3, 1, 1.0, 1)]


def test_successive_halving(spark, sf_dir):
    from recoengine import fixtures
    found = als.halving_search(fixtures.ratings(spark, sf_dir), ranks=(2, 4), regs=(0.1, 0.01), iterations=3).collect()
    by_round = {k: [r for r in found if r["round"] == k] for k in {r["round"] for r in found}}
    assert [len(by_round[k]) for k in sorted(by_round)] == [4, 2, 1] and [sum(r.kept for r in by_round[k]) for k in sorted(by_round)] == [2, 1, 1]
    assert by_round[max(by_round)][0].iterations == 3
    for k in by_round:
        assert max(r.rmse for r in by_round[k] if r.kept) <= min([r.rmse for r in by_round[k] if not r.kept], default=1e9)


def test_a_large_similarity_table_is_read_where_it_is_stored(spark, monkeypatch):
    path = scratch_path(spark, "sims")
    rec.ranked_similarity(_sim(spark, [(5, 20, 0.9), (20, 10, 0.8), (5, 1, 0.95)])).write.parquet(path)
    rated, recent = spark.createDataFrame([(3, 1)], "uid int, mid int"), _recent(spark, 3, [(10, 4.0)])
    found, cached = [], []
    frame = type(rated)
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *a: cached.append("sim_mid" in self.columns) or persist(self, *a))
    for most in (rec.CACHED_ENTRIES, 5):
        monkeypatch.setattr(rec, "CACHED_ENTRIES", most)
        inbox, out, ckpt = (scratch_path(spark, x) for x in ("in", "out", "ckpt"))
        _write(inbox, "0.txt", ["3|5|5.0|100"])
        cached.clear()
        rec.start(rec.rating_stream(spark, inbox), spark.read.parquet(path), rated, recent, out, ckpt, trigger={"availableNow": True}, decode="failfast").awaitTermination()
        found.append([(r.uid, r.recs_str) for r in rec.read_results(spark, out).collect()])
        assert any(cached) == (most > 5)
    assert found[0] == found[1] and found[0][0][1].startswith("20:")
