"""Driver-side file metadata through Spark's own file-system layer."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

RENAME_THREADS = 16

# Stores whose Hadoop paths refuse a colon in a file name.
NO_COLON = ("file", "hdfs", "viewfs", "webhdfs")


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def join(*parts: str) -> str:
    return "/".join(p.strip("/") if i else p.rstrip("/") for i, p in enumerate(parts) if p)


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def takes_colon(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).getUri().getScheme() not in NO_COLON


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def size(spark: SparkSession, path: str) -> int:
    return _fs(spark, path).getContentSummary(_path(spark, path)).getLength()


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a pattern, sorted."""
    found = _fs(spark, pattern).globStatus(_path(spark, pattern))
    return sorted(s.getPath().toString() for s in found or [])


def glob_below(spark: SparkSession, directory: str, pattern: str) -> list[str]:
    """Paths below a directory matching a pattern; the directory itself is taken literally."""
    return glob(spark, f"{literal(directory)}/{pattern}")


def literal(text: str) -> str:
    """The text as a glob that matches only itself."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", text)


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; at its path stands the old text or the whole new one."""
    part = f"{path.rpartition('/')[0]}/.{path.rpartition('/')[2]}.{uuid.uuid4().hex}"
    stream = _fs(spark, part).create(_path(spark, part), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    replace_all(spark, [(part, path)])


def in_parallel(step: Callable, items: Iterable) -> None:
    """Call a driver-side step of file metadata for each item; the first error is raised."""
    items = list(items)
    if items:
        with ThreadPoolExecutor(RENAME_THREADS) as pool:
            list(pool.map(step, items))


def replace_all(spark: SparkSession, moves: Iterable[tuple[str, str]], moved_before: bool = False) -> None:
    """Rename files, replacing what stands at the target. Only metadata moves, but for a target on
    another file system than its source, which is copied beside the target first.

    A file that stands there is set aside first and put back if the rename
    fails, so no target is left without its old or its new file. With ``moved_before``
    a missing source is one that was moved in an earlier try.
    """
    moves = list(moves)
    if not moves:
        return
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    to_path = jvm.org.apache.hadoop.fs.Path
    fs, source_fs = _fs(spark, moves[0][1]), _fs(spark, moves[0][0])
    near = fs.getUri().equals(source_fs.getUri())
    parents = {target.rsplit("/", 1)[0] for _, target in moves}

    def move(pair: tuple[str, str]) -> None:
        source, target = to_path(pair[0]), to_path(pair[1])
        aside = None
        if moved_before and not source_fs.exists(source):
            return
        if not near:
            part = to_path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
            jvm.org.apache.hadoop.fs.FileUtil.copy(source_fs, source, fs, part, False, conf)
            far, source = source, part
        if fs.exists(target):
            aside = to_path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
            if not fs.rename(target, aside):
                raise OSError(f"could not set {pair[1]} aside")
        try:
            if not fs.rename(source, target):
                raise OSError(f"could not rename {pair[0]} to {pair[1]}")
        except Exception:
            if aside is not None:
                fs.rename(aside, target)
            raise
        if aside is not None:
            fs.delete(aside, False)
        if not near:
            source_fs.delete(far, False)

    in_parallel(lambda parent: fs.mkdirs(to_path(parent)), parents)
    in_parallel(move, moves)
