"""Single files of a folder through the file system's own calls: Spark's readers see neither markers nor empty files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Fixed value: the file that closes a drop.
READY = "_READY"


@dataclass(frozen=True)
class Marker:
    folder: str
    path: str
    modified: dt.datetime
    length: int


def _open(spark: SparkSession, path: str):
    """The Hadoop file system a path lies in, and the path itself."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _marker(status) -> Marker:
    path = status.getPath()
    modified = dt.datetime.fromtimestamp(status.getModificationTime() / 1000, dt.timezone.utc)
    return Marker(path.getParent().toString(), path.toString(), modified, status.getLen())


def ready_markers(spark: SparkSession, incoming: str) -> list[Marker]:
    """Markers of the drop folder and of the folders directly in it, oldest first.

    One per drop, however many files the drops hold.
    """
    found = []
    for pattern in (f"{incoming}/{READY}", f"{incoming}/*/{READY}"):
        system, path = _open(spark, pattern)
        found += [_marker(s) for s in system.globStatus(path) or []]
    return sorted(found, key=lambda m: (m.modified, m.folder))


def exists(spark: SparkSession, path: str) -> bool:
    system, found = _open(spark, path)
    return system.exists(found)


def put_marker(spark: SparkSession, folder: str) -> None:
    """Close a drop: its files are complete."""
    system, path = _open(spark, f"{folder}/{READY}")
    system.create(path, True).close()


def publish_parts(spark: SparkSession, written: str, folder: str, suffix: str, names: Collection[str] | None = None) -> int:
    """Copy the part files of a written table, or those named, into a folder under names that stay the same, over older ones."""
    system, path = _open(spark, f"{written}/part-*")
    parts = sorted((s.getPath() for s in system.globStatus(path) or []), key=lambda p: p.getName())
    parts = [p for p in parts if names is None or p.getName() in names]
    target_system, target = _open(spark, folder)
    target_system.mkdirs(target)
    for number, part in enumerate(parts):
        target_system, target = _open(spark, f"{folder}/part-{number:05d}{suffix}")
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
            system, part, target_system, target, False, True, spark._jsc.hadoopConfiguration())
    return len(parts)
