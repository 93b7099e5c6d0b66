"""Session helpers.

The library never owns the cluster configuration: it reads what the
session already says and only fills gaps (as in tests and local runs).
"""

from __future__ import annotations

import atexit
import io
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_PKG_DIR = os.path.dirname(os.path.abspath(__file__))

# Runtime SQL settings every query relies on; safe to set on any session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "recoengine",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster pass master=None and
    let spark-submit decide."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


_prepared: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Idempotent: fill unset runtime settings (what the user set stays),
    make sure a shared checkpoint dir exists and ship this package to the
    Python workers."""
    present = spark.conf.getAll
    for k, v in RUNTIME_CONF.items():
        if k not in present:
            spark.conf.set(k, v)
    key = spark.sparkContext.applicationId
    if key in _prepared:
        return spark
    shared_dir(spark)
    _ship_package(spark)
    atexit.register(_drop_scratch, spark)
    _prepared.add(key)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Read from the session; only when unset on a local master (tests, local
    runs) a fresh folder is created and registered. On a cluster a missing
    setting is an error: a folder of the driver's machine is not shared.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - key absent
            d = None
    if not d:
        jdir = sc._jsc.sc().getCheckpointDir()
        d = jdir.get() if jdir.isDefined() else None
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master or ""):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="recoengine-ckpt-")
        sc.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    elif not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(d)
    return d


def scratch_root(spark: SparkSession) -> str:
    """This application's own sub-folder of the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/recoengine/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique scratch path in the shared folder (never reused);
    ``release`` frees it, and all are removed when the application ends."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that no later step reads."""
    sc = spark.sparkContext
    for p in paths:
        if not p.startswith(scratch_root(spark) + "/"):
            raise ValueError(f"not a scratch path of this application: {p}")
        jpath = sc._jvm.org.apache.hadoop.fs.Path(p)
        jpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(jpath, True)


def _drop_scratch(spark: SparkSession) -> None:
    """At exit, while the session still lives: remove this application's
    scratch folder. A session stopped before leaves that to the owner of
    the shared folder."""
    try:
        sc = spark.sparkContext
        if sc._jsc is None:
            return
        jpath = sc._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
        jpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(jpath, True)
    except Exception:  # noqa: BLE001 - the JVM is already gone
        pass


def _ship_package(spark: SparkSession) -> None:
    """Zip the package and hand it to ``addPyFile`` so executors can
    import the pandas kernels (equivalent of ``--py-files``)."""
    buf = io.BytesIO()
    root = os.path.dirname(_PKG_DIR)
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(_PKG_DIR):
            if "__pycache__" in dirpath:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    # written into the shared folder (any Hadoop file system) and served to
    # executors by addPyFile, like --py-files
    out = scratch_path(spark, "pyfiles") + "/recoengine.zip"
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(out)
    stream = jpath.getFileSystem(sc._jsc.hadoopConfiguration()).create(jpath, True)
    try:
        stream.write(bytearray(buf.getvalue()))
    finally:
        stream.close()
    sc.addPyFile(out)
