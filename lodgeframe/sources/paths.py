"""Path checks through the Hadoop file system, so they work on any storage Spark can read."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


# Files moved at once: most of a move is waiting for the storage and the JVM.
MOVES = 16


def _fs_and_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, sorted by name."""
    fs, jpath = _fs_and_path(spark, pattern)
    found = fs.globStatus(jpath)
    if not found:
        return []
    # All paths come as one text, since each call to the JVM takes its time; no path holds the character between them.
    paths = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found)
    return sorted(spark._jvm.scala.runtime.ScalaRunTime.genericWrapArray(paths).mkString("\0").split("\0"))


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs_and_path(spark, path)
    return fs.exists(jpath)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move one finished file into place; an earlier file of that name is replaced."""
    rename_all(spark, {source: target})


def rename_all(spark: SparkSession, targets: dict[str, str]) -> None:
    """Move finished files, all on one file system, into place, several at once; folders are made once."""
    if not targets:
        return
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs, _ = _fs_and_path(spark, next(iter(targets)))
    for parent in {target.rsplit("/", 1)[0] for target in targets.values()}:
        fs.mkdirs(path(parent))

    def move(source: str, target: str) -> None:
        jtarget = path(target)
        if fs.exists(jtarget):
            fs.delete(jtarget, False)
        if not fs.rename(path(source), jtarget):
            raise OSError(f"could not move {source} to {target}")

    with ThreadPoolExecutor(min(MOVES, len(targets))) as pool:
        for _ in pool.map(move, targets.keys(), targets.values()):
            pass


def create_once(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file; ``FileExistsError`` if there is one, so that of two writers one alone succeeds."""
    fs, jpath = _fs_and_path(spark, path)
    fs.mkdirs(jpath.getParent())
    try:
        stream = fs.create(jpath, False)
    except Exception as e:
        if fs.exists(jpath):
            raise FileExistsError(path) from e
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_small(spark: SparkSession, path: str) -> str:
    fs, jpath = _fs_and_path(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


class CommitLog:
    """Numbered commits of one table or store: files that are created once, each with a short text.

    Data is written first to a folder of its own; the commit makes it visible. A job that dies before its commit
    leaves nothing that readers see, and of two that claim the same number the second fails.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/commits"

    def numbers(self) -> list[int]:
        return sorted(int(p.rsplit("/", 1)[1]) for p in matches(self.spark, f"{self.root}/[0-9]*"))

    def text(self, number: int) -> str:
        return read_small(self.spark, f"{self.root}/{number:012d}")

    def commit(self, number: int, text: str) -> None:
        create_once(self.spark, f"{self.root}/{number:012d}", text)
