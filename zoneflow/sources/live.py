"""Which folders of a stored log are live.

A log that is compacted in place holds folders that readers must not add up:
merged days beside the batches they were merged from. The list of live folders
is a small stored table under a new version number; it appears with one rename,
so a reader sees the folders before a compaction or those after it, never both.
Folders of older versions stay until `expire` removes them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

LIVE, MERGED, NEW = "_live", "_merged", "_new"


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, place = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def holds(spark: SparkSession, path: str) -> bool:
    """Whether a folder has partitions: one whose batches brought nothing new has none."""
    return any("=" in n for n in _names(spark, path))


def version(spark: SparkSession, path: str) -> int:
    """Number of the newest list, 0 where a log was never compacted in place."""
    return max((int(n) for n in _names(spark, f"{path}/{LIVE}") if n.isdigit()), default=0)


def folders(spark: SparkSession, path: str) -> tuple[list[str], str]:
    """Live merged folders, and the folder that batches go to: "", the log itself, where none are listed."""
    newest = version(spark, path)
    if not newest:
        return [], ""
    rows = spark.read.schema("place int, folder string").parquet(f"{path}/{LIVE}/{newest:08d}").orderBy("place").collect()
    return [r["folder"] for r in rows[:-1]], rows[-1]["folder"]


def full(path: str, folder: str) -> str:
    return f"{path}/{folder}" if folder else path


def publish(spark: SparkSession, path: str, merged: list[str], current: str) -> None:
    """Make these the live folders: written aside, then renamed to the next version."""
    fs, aside = _fs(spark, f"{path}/{LIVE}/.{uuid.uuid4().hex}")
    rows = spark.createDataFrame(list(enumerate([*merged, current])), "place int, folder string")
    rows.coalesce(1).write.parquet(aside.toString())
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{LIVE}/{version(spark, path) + 1:08d}")
    # Renaming onto a folder would move into it: another writer has taken this version.
    if fs.exists(target) or not fs.rename(aside, target):
        raise RuntimeError(f"{target} was published by another writer")


def expire(spark: SparkSession, path: str) -> int:
    """Delete folders that are live no more, once no reader of an older list is left; returns their number."""
    fs, _ = _fs(spark, path)
    merged, current = folders(spark, path)
    dead = [f"{MERGED}/{day}/{n}" for day in _names(spark, f"{path}/{MERGED}") if "=" in day for n in _names(spark, f"{path}/{MERGED}/{day}") if "=" in n]
    dead = [f for f in dead if f not in merged] + [n for n in _names(spark, path) if n.startswith(f"{NEW}-") and n != current]
    dead += [n for n in _names(spark, path) if "=" in n and current]
    for folder in dead:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}"), True)
    return len(dead)
