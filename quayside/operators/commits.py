"""Results that appear at once.

Data is written to folders that nothing refers to yet; a small numbered *commit* file that
lists them is then moved into a log. A reader takes what the newest commits list, so it sees a
set of folders before or after a commit, never between, and never a folder that is being
replaced: folders are not changed once they are listed. Commit files are made once and never
overwritten: two writers of one number meet an error, not a lost update. A commit is one move,
which file systems do at once.

A published target (``publish_version``) has one commit per publish, naming the folder of every
feed. An ingest (``streaming.ingest``) has one commit per micro-batch, naming its folders.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from quayside.operators.origin import OFFSETS
from quayside.operators.sinks import write_staged
from quayside.session import remove
from quayside.sources.catalog import path_exists
from quayside.sources.feeds import FEED_BY_KEY

LOG = "_commits"
VERSIONS = "_versions"


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def commit_numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the commits in the log of ``root``, ascending (a listing of one folder)."""
    fs, log = _fs(spark, f"{root}/{LOG}")
    if not fs.exists(log):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(log)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def commit(spark: SparkSession, root: str, number: int, content: dict) -> None:
    """Write ``content`` as commit ``number``; an error if that commit exists."""
    fs, log = _fs(spark, f"{root}/{LOG}")
    fs.mkdirs(log)
    _, made = _fs(spark, f"{root}/{LOG}/.{number}-{uuid.uuid4().hex[:8]}")
    _, final = _fs(spark, f"{root}/{LOG}/{number:012d}.json")
    out = fs.create(made, False)
    try:
        out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(made, final):
        fs.delete(made, False)
        raise FileExistsError(f"commit {number} of {root} was made by another writer")


def read_commit(spark: SparkSession, root: str, number: int) -> dict:
    fs, path = _fs(spark, f"{root}/{LOG}/{number:012d}.json")
    stream = fs.open(path)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def current(spark: SparkSession, target: str) -> dict[str, str]:
    """Folder of each published feed, by the newest commit."""
    numbers = commit_numbers(spark, target)
    return read_commit(spark, target, numbers[-1]) if numbers else {}


def read_published(spark: SparkSession, target: str, feed: str) -> DataFrame:
    """A feed as the newest commit has it. The folder read stays as it is while it is read."""
    folder = current(spark, target).get(feed)
    if folder is None:
        raise FileNotFoundError(f"{feed} is not published in {target}")
    return spark.read.parquet(f"{target}/{folder}")


def publish_version(spark: SparkSession, staged: str, target: str, feeds: list[str], move: bool = False) -> int:
    """F3 without a gap: the staged feeds become new version folders of ``target``, and one commit
    switches readers to all of them at once; feeds not given stay as they are. With ``move`` the
    staged folders themselves become the versions (a rename: nothing is read or encoded again).
    Returns the commit's number. A failure before the commit publishes nothing."""
    for path, what in ((staged, "staged output not found"), (target, "publish target not reachable")):
        if not path_exists(spark, path):
            raise FileNotFoundError(f"{what}: {path}")
    missing = [f for f in feeds if not path_exists(spark, f"{staged}/feed={f}")]
    if missing:
        raise FileNotFoundError(f"staged output missing for: {', '.join(missing)}")
    numbers = commit_numbers(spark, target)
    number = numbers[-1] + 1 if numbers else 1
    content = read_commit(spark, target, number - 1) if numbers else {}
    made = {f: f"{VERSIONS}/feed={f}/v{number}-{uuid.uuid4().hex[:8]}" for f in feeds}
    try:
        for f, folder in made.items():
            source, place = f"{staged}/feed={f}", f"{target}/{folder}"
            if move:
                fs, to = _fs(spark, place)
                fs.mkdirs(to.getParent())
                if not fs.rename(_fs(spark, source)[1], to):
                    raise RuntimeError(f"could not move {source} to {place}")
            else:
                write_staged(spark.read.parquet(source), place, FEED_BY_KEY[f].row_group_bytes if f in FEED_BY_KEY else None)
                if path_exists(spark, f"{source}/{OFFSETS}"):
                    spark.read.parquet(f"{source}/{OFFSETS}").coalesce(1).write.parquet(f"{place}/{OFFSETS}")
        commit(spark, target, number, content | made)
    except BaseException:
        if not move:
            remove(spark, *[f"{target}/{folder}" for folder in made.values()])
        raise
    return number


def vacuum(spark: SparkSession, target: str, keep: int = 2) -> list[str]:
    """Delete commits but the newest ``keep`` and the version folders that none of these list.
    Readers that began under an older commit than those must be done."""
    numbers = commit_numbers(spark, target)
    old, kept = numbers[:-keep] if keep else numbers, numbers[-keep:] if keep else []
    listed = {folder for n in kept for folder in read_commit(spark, target, n).values()}
    gone = sorted({folder for n in old for folder in read_commit(spark, target, n).values()} - listed)
    remove(spark, *[f"{target}/{folder}" for folder in gone], *[f"{target}/{LOG}/{n:012d}.json" for n in old])
    return gone
