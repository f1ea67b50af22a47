"""A1 landing-zone catalogue and A4 Parquet scan.

The catalogue of a tree is a ``binaryFile`` listing with the ``content`` column pruned: Spark lists
a level of many folders in parallel (a job, from ``spark.sql.sources.parallelPartitionDiscovery.threshold``
folders on) and never opens the files. The flat catalogue is the listing of one folder; what lies in its
subfolders is not touched. ``catalog_changes`` compares two catalogues.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import FILE_THREADS


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified form of ``path`` as Spark prints it in ``path`` columns."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(hpath).toString().rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def ensure_dir(spark: SparkSession, path: str) -> str:
    """Create a folder (and parents) if it does not exist; returns the path."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hpath)
    return path


def _listed(name: str) -> bool:
    """Names that Spark's own listing shows."""
    return not (name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_"))


def _flat(spark: SparkSession, root: str, glob: str | None) -> DataFrame:
    """Files directly in ``root``: one listing of one folder."""
    jvm = spark.sparkContext._jvm
    path_of = jvm.org.apache.hadoop.fs.Path  # looked up once: each look is several calls
    folder = path_of(root)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.globStatus(folder):
        raise FileNotFoundError(f"PATH_NOT_FOUND: {root}")

    def row(status) -> tuple | None:
        if not status.isFile():
            return None
        path = status.getPath().toString()
        name = path.rsplit("/", 1)[-1]
        return (path, name, status.getLen(), status.getModificationTime()) if _listed(name) else None

    with ThreadPoolExecutor(FILE_THREADS) as pool:
        rows = [r for r in pool.map(row, fs.globStatus(path_of(folder, glob or "*")) or []) if r]
    files = spark.createDataFrame(rows, "path string, name string, size bigint, ms bigint")
    return files.select("path", "name", "size", F.timestamp_millis("ms").alias("mtime"))


def catalog(spark: SparkSession, root: str, recursive: bool = True, glob: str | None = None) -> DataFrame:
    """A1: ``DF[path, name, size, mtime]`` of every file under ``root``.

    ``recursive=False`` lists the files directly in ``root`` and no other folder. A missing
    root is an error (G3): PATH_NOT_FOUND.
    """
    if not recursive:
        return _flat(spark, root, glob)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select(
        F.col("path"),
        F.regexp_extract(F.col("path"), "[^/]*$", 0).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("mtime"),
    )


def catalog_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What happened between two catalogues: ``DF[path, name, change, size_before, size_after,
    mtime_before, mtime_after]``, a row per file that is ``new``, ``gone`` or ``changed`` (another size
    or modification time). A catalogue is lazy: write ``before`` (``session.materialize``) when it is taken."""
    sides = [df.select("path", *[F.col(c).alias(f"{c}_{side}") for c in ("name", "size", "mtime")], F.lit(True).alias(side))
             for df, side in ((before, "before"), (after, "after"))]
    both = sides[0].join(sides[1], "path", "full_outer")
    same = F.col("size_before").eqNullSafe(F.col("size_after")) & F.col("mtime_before").eqNullSafe(F.col("mtime_after"))
    change = F.when(F.col("before").isNull(), "new").when(F.col("after").isNull(), "gone").when(~same, "changed")
    return both.withColumn("change", change).where("change is not null").select(
        "path", F.coalesce("name_after", "name_before").alias("name"), "change",
        "size_before", "size_after", "mtime_before", "mtime_after")


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A4: a Parquet dataset (pushdown, pruning and vectorised reads are Spark's)."""
    paths = [path] if isinstance(path, str) else path
    return spark.read.parquet(*paths)
