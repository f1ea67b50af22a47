"""Session construction and the shared scratch location.

On a cluster the scratch location is the shared folder named by
``spark.checkpoint.dir``; it is only invented (as a local temp folder) when the
session has none, which is the case in tests and local runs.
"""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

_LOCAL_CHECKPOINT_ROOT: str | None = None
#: Calls to the file system at a time, where there is one for each of many files.
FILE_THREADS = 8


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "quayside",
                extra: dict | None = None) -> SparkSession:
    """A session with this library's settings. ``master`` and ``shuffle_partitions`` are left to
    spark-submit unless given; tests and the bench give them."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # the JVM compiles no method of more bytecode; beyond it Spark's row-wise code, in short methods, is faster
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", "16g")
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    dir). Only when neither is set, as in tests, a temp folder is created and
    registered as the checkpoint dir; off a ``local`` master that would be a folder
    of each machine's own, so there it is an error.
    """
    global _LOCAL_CHECKPOINT_ROOT
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset conf raises
            root = None
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if _LOCAL_CHECKPOINT_ROOT is None:
            _LOCAL_CHECKPOINT_ROOT = tempfile.mkdtemp(prefix="quayside-ckpt-")
        root = _LOCAL_CHECKPOINT_ROOT
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Cut lineage by writing ``df`` as a Parquet table under the shared
    checkpoint root and reading it back (one job; an eager ``checkpoint()``
    of an unpersisted plan computes it twice). Used for small side tables."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.parquet(path)
    out.path_ = path
    return out


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders this library wrote, where they are."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path  # looked up once: each look is several calls
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def delete(path: str) -> None:
        p = path_of(path)
        p.getFileSystem(conf).delete(p, True)

    if len(paths) < FILE_THREADS:
        for path in paths:
            delete(path)
        return
    with ThreadPoolExecutor(FILE_THREADS) as pool:
        list(pool.map(delete, paths))
