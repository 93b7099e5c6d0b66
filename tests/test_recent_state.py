"""Recent lists by state bucket: what the state store holds, and users of one bucket."""
import os
import time

from recoengine.session import scratch_path
from recoengine.streaming import recent_state
from recoengine.streaming import recommender as rec


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_users_share_the_keys_of_the_state_store(spark):
    inbox, out, ckpt = (scratch_path(spark, x) for x in ("in", "out", "ckpt"))
    log = [(u, (u * 7 + t) % 50, t % 10 / 2, t * (-1) ** u) for t in range(4) for u in range(1500)]
    log += [(0, 5, 1.0, 9), (0, 5, 1.0, 9), (0, 4, 2.0, 9)]  # equal ratings and times
    for i, part in enumerate((log[::2], log[1::2])):
        _write(inbox, f"{i}.txt", [f"{u}|{m}|{s}|{t}" for u, m, s, t in part])
        stream = rec.decode_ratings(rec.rating_stream(spark, inbox))
        q = recent_state.start_recent(stream, out, ckpt, trigger={"availableNow": True}, n=2)
        q.awaitTermination()
        assert 0 < q.lastProgress["stateOperators"][0]["numRowsTotal"] <= recent_state.STATE_BUCKETS
    want = rec.recent_ratings(spark.createDataFrame(log, "uid int, mid int, score double, timestamp long"), n=2, order=("timestamp", "mid", "score"))
    assert sorted(map(tuple, recent_state.read_recent(spark, out).collect())) == sorted(map(tuple, want.collect()))


def test_an_idle_user_goes_while_another_of_its_bucket_stays(spark):
    inbox, out, ckpt = (scratch_path(spark, x) for x in ("in", "out", "ckpt"))
    os.makedirs(inbox)
    q = recent_state.start_recent(rec.decode_ratings(rec.rating_stream(spark, inbox)), out, ckpt, trigger={"processingTime": "100 milliseconds"},
                                  idle_ms=16_000, buckets=1)
    def wait(want):
        for _ in range(80):
            found = recent_state.read_recent(spark, out)
            if found is not None and sorted(map(tuple, found.collect())) == want or q.exception():
                break
            time.sleep(0.5)
        assert sorted(map(tuple, recent_state.read_recent(spark, out).collect())) == want, q.exception()

    try:
        _write(inbox, "a.txt", ["1|5|1.0|10", "2|6|1.0|11"])
        wait([(1, 0, 5, 1.0), (2, 0, 6, 1.0)])
        time.sleep(8)
        _write(inbox, "b.txt", ["2|7|1.0|12"])
        wait([(1, 0, 5, 1.0), (2, 0, 7, 1.0), (2, 1, 6, 1.0)])
        time.sleep(9)  # user 1 has been idle for over 16 s, user 2 has not
        _write(inbox, "c.txt", ["1|8|1.0|13", "2|8|1.0|13"])
        wait([(1, 0, 8, 1.0), (2, 0, 8, 1.0), (2, 1, 7, 1.0), (2, 2, 6, 1.0)])
    finally:
        q.stop()
