"""The first lines of files, without a scan of the files.

``take`` runs one task on a file's first split, and the line reader stops when it has its
lines: what is read of a file is bounded by its first lines, not by its size. Files are read
side by side; their heads (``HEAD_FILES`` times ``HEAD_LINES`` lines at most) reach the driver,
which plans the conversion from them. Larger groups are planned from a scan instead.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

HEAD_LINES = 64
HEAD_FILES = 256
#: Heads that are read at a time.
THREADS = 8


@dataclass
class Head:
    file: str          # as ``_metadata.file_path`` prints it
    lines: list[str]
    whole: bool        # the file has no other lines


def listed_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """Files of a text scan of ``paths`` (the listing that planning the scan makes), sorted."""
    return sorted(spark.read.text(paths).inputFiles())


def file_heads(spark: SparkSession, files: list[str], n: int = HEAD_LINES) -> list[Head]:
    """The first ``n`` lines of each file, decoded as ``read_lines`` does."""
    jvm = spark.sparkContext._jvm

    def head(file: str) -> Head:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)).toString()
        lines = [r["value"] for r in spark.read.text(path).select(F.make_valid_utf8("value").alias("value")).take(n)]
        return Head(file, lines, len(lines) < n)

    with ThreadPoolExecutor(THREADS) as pool:
        return list(pool.map(head, files))


def plain_names(files: list[str]) -> bool:
    """No path has a character that a reader would take for a pattern."""
    return not any(c in f for f in files for c in "[]{}*?\\")


def first_records(heads: list[Head], n: int, blank, skip: int = 0) -> list[tuple[str, int, str]] | None:
    """The first ``n`` lines (file, number, text) that are not ``blank`` and not among the first
    ``skip`` of their file; None where the heads do not reach far enough."""
    out: list[tuple[str, int, str]] = []
    for head in heads:
        out += [(head.file, i, v) for i, v in enumerate(head.lines, 1) if i > skip and not blank(v)]
        if len(out) >= n:
            return out[:n]
        if not head.whole:
            return None
    return out
