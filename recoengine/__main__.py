"""Command line for the jobs (spark-submit or python -m recoengine).

    python -m recoengine load       MOVIES RATINGS TAGS OUT [--mode drop]
    python -m recoengine statistics STORE OUT
    python -m recoengine offline    STORE OUT [--rank 50 --iterations 5 --reg 0.01 --exclude-seen]
    python -m recoengine params     STORE [--holdout 0.0]
    python -m recoengine recent     STORE OUT
    python -m recoengine stream     STORE SIM_DIR STREAM_PATH OUT CHECKPOINT [--once --mode drop --refresh-recent]

The master and resources come from spark-submit / the environment; set
``spark.checkpoint.dir`` to a shared folder on a cluster.
"""

from __future__ import annotations

import argparse
import os

from recoengine.plans import jobs
from recoengine.session import build_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="recoengine")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("load")
    p.add_argument("movies"), p.add_argument("ratings"), p.add_argument("tags"), p.add_argument("out")
    p.add_argument("--mode", default="failfast", choices=["failfast", "drop", "quarantine"])
    p = sub.add_parser("statistics")
    p.add_argument("store"), p.add_argument("out")
    p = sub.add_parser("offline")
    p.add_argument("store"), p.add_argument("out")
    p.add_argument("--rank", type=int, default=50)
    p.add_argument("--iterations", type=int, default=5)
    p.add_argument("--reg", type=float, default=0.01)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--exclude-seen", action="store_true")
    p = sub.add_parser("params")
    p.add_argument("store")
    p.add_argument("--holdout", type=float, default=0.0)
    p = sub.add_parser("recent")
    p.add_argument("store"), p.add_argument("out")
    p = sub.add_parser("stream")
    for a in ("store", "sim_dir", "stream_path", "out", "checkpoint"):
        p.add_argument(a)
    p.add_argument("--once", action="store_true", help="process what is there, then stop")
    p.add_argument("--mode", default="failfast", choices=["failfast", "drop", "quarantine"],
                   help="what happens to malformed messages")
    p.add_argument("--refresh-recent", action="store_true", help="rebuild the recent-ratings table first")
    args = ap.parse_args(argv)

    spark = build_session(os.environ.get("RECOENGINE_MASTER"), app_name=f"recoengine-{args.cmd}")
    if args.cmd == "load":
        print(jobs.load_job(spark, args.movies, args.ratings, args.tags, args.out, args.mode))
    elif args.cmd == "statistics":
        print(jobs.statistics_job(spark, args.store, args.out))
    elif args.cmd == "offline":
        print(jobs.offline_job(spark, args.store, args.out, rank=args.rank, iterations=args.iterations,
                               reg=args.reg, seed=args.seed, exclude_seen=args.exclude_seen))
    elif args.cmd == "params":
        jobs.parameter_job(spark, args.store, holdout=args.holdout).show(truncate=False)
    elif args.cmd == "recent":
        print(jobs.recent_job(spark, args.store, args.out))
    else:
        trigger = {"availableNow": True} if args.once else None
        jobs.streaming_job(spark, args.store, args.sim_dir, args.stream_path, args.out, args.checkpoint,
                           trigger=trigger, mode=args.mode, refresh_recent=args.refresh_recent).awaitTermination()
    spark.stop()


if __name__ == "__main__":
    main()
