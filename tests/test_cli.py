import os
import subprocess
import sys

from recoengine.session import scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_load_and_statistics(spark, tmp_path):
    raw = tmp_path
    (raw / "movies.txt").write_text("1^A^^90 minutes^^1995^English^Action|Musical^x^y\n"
                                    "2^B^^80 minutes^^1995^English^Drama^x^y\n")
    (raw / "ratings.txt").write_text("1,1,4.0,1260759144\n2,1,3.0,1260759145\n1,2,5.0,1260759146\n")
    (raw / "tags.txt").write_text("1,1,fun,1260759144\n")
    store = scratch_path(spark, "cli-store")
    env = dict(os.environ, RECOENGINE_MASTER="local[2]", PYTHONPATH=ROOT)
    for args in (["load", str(raw / "movies.txt"), str(raw / "ratings.txt"), str(raw / "tags.txt"), store],
                 ["statistics", store, store]):
        subprocess.run([sys.executable, "-m", "recoengine", *args], check=True, cwd=ROOT, env=env,
                       timeout=600, capture_output=True)
    top = spark.read.parquet(f"{store}/GenresTop_AverageMoviesScore").collect()
    assert {r.genres for r in top} == {"Action", "Drama", "Music"}
    assert spark.read.parquet(f"{store}/RateMoreMovies").count() == 2
