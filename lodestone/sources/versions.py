"""Versioned table folders: readers see the newest version that was written to the end."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

MARKER, CLAIM = "_COMPLETE", "_CLAIMED"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def child_names(spark: SparkSession, path: str) -> list[str]:
    if not path_exists(spark, path):
        return []
    return [status.getPath().getName() for status in _fs(spark, path).listStatus(_path(spark, path))]


def file_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of each file under a folder, by its path from there."""
    fs, sizes = _fs(spark, path), {}
    start = fs.makeQualified(_path(spark, path)).toString().rstrip("/") + "/"
    found = fs.listFiles(_path(spark, path), True)
    while found.hasNext():
        status = found.next()
        sizes[status.getPath().toString().removeprefix(start)] = status.getLen()
    return sizes


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    stream = _fs(spark, path).create(_path(spark, path), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def drop(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def path_exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def _versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n[1:]) for n in child_names(spark, root) if n[:1] == "v" and n[1:].isdigit())


def latest_version(spark: SparkSession, root: str) -> str | None:
    for number in reversed(_versions(spark, root)):
        folder = f"{root}/v{number}"
        if path_exists(spark, f"{folder}/{MARKER}"):
            return folder
    return None


def complete_versions(spark: SparkSession, root: str) -> list[str]:
    """All that were written to the end, oldest first."""
    folders = (f"{root}/v{n}" for n in _versions(spark, root))
    return [folder for folder in folders if path_exists(spark, f"{folder}/{MARKER}")]


def older_versions(spark: SparkSession, root: str, folder: str) -> list[str]:
    """The versions before this one, unfinished ones included."""
    return [f"{root}/v{n}" for n in _versions(spark, root) if n < int(folder.rsplit("/v", 1)[1])]


def next_version(spark: SparkSession, root: str) -> str:
    """A fresh folder; the one a reader is using is never written to. It is claimed by a file
    that only one of several runs can create, so two runs at once never share a folder."""
    number = max(_versions(spark, root), default=0) + 1
    while not _created(spark, f"{root}/v{number}/{CLAIM}"):
        number += 1
    return f"{root}/v{number}"


def _created(spark: SparkSession, path: str) -> bool:
    fs = _fs(spark, path)
    try:
        fs.create(_path(spark, path), False).close()
    except Py4JJavaError:
        if fs.exists(_path(spark, path)):
            return False
        raise
    return True


def mark_complete(spark: SparkSession, folder: str) -> None:
    """The switch: from here on readers pick this version."""
    _fs(spark, folder).create(_path(spark, f"{folder}/{MARKER}"), True).close()


def drop_old_versions(spark: SparkSession, root: str, keep: int = 3) -> list[str]:
    """Delete all but the newest ``keep`` versions, counting complete ones only."""
    complete = [n for n in _versions(spark, root) if path_exists(spark, f"{root}/v{n}/{MARKER}")]
    oldest_kept = complete[-keep] if len(complete) >= keep else 0
    dropped = [f"{root}/v{n}" for n in _versions(spark, root) if n < oldest_kept]
    for folder in dropped:
        _fs(spark, folder).delete(_path(spark, folder), True)
    return dropped
