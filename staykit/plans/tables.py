"""Tables that change in one step.

A table's folder holds versions, ``_v<number>-<random>``.  A version is written
whole, and counts once its marker file ``_committed`` is there, which is created
last; readers take the committed version with the highest number.  So a failure
at any point leaves the old or the new table, never half of one or none, on file
systems that can rename and on object stores.  After a commit all but the new and
the last version are removed (readers that began before it keep theirs).

Names of versions begin with ``_``, which Spark skips when it lists a folder: a
reader that is given the table's folder itself fails instead of mixing versions.
A folder that holds Parquet files directly (written by Spark alone, or by an
earlier release) is read as it is until it is first replaced.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

MARKER = "_committed"
_VERSION = re.compile(r"^_v(\d+)-")


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of a path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, folder) of every version, committed or not, in order."""
    found = [(int(m.group(1)), f"{path.rstrip('/')}/{name}") for name in _children(spark, path) if (m := _VERSION.match(name))]
    return sorted(found)


def _committed(spark: SparkSession, path: str) -> list[str]:
    out = []
    for _, folder in versions(spark, path):
        fs, marker = file_system(spark, f"{folder}/{MARKER}")
        if fs.exists(marker):
            out.append(folder)
    return out


def _has_files(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet file lies under ``path``, outside of versions and unfinished writes."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return False
    root = fs.makeQualified(p).toString()
    files = fs.listFiles(p, True)
    while files.hasNext():
        f = files.next().getPath().toString()[len(root):]
        if f.endswith(".parquet") and not any(part.startswith(("_", ".")) for part in f.split("/")):
            return True
    return False


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the table as it stands, or None if there is no such table."""
    done = _committed(spark, path)
    if done:
        return done[-1]
    return path if _has_files(spark, path) else None


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at ``path`` (a failed first write leaves none)."""
    return current(spark, path) is not None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` as it stands now."""
    return spark.read.parquet(current(spark, path) or path)


def _commit(spark: SparkSession, folder: str) -> None:
    fs, marker = file_system(spark, f"{folder}/{MARKER}")
    fs.create(marker, True).close()


def _remove_old(spark: SparkSession, path: str, keep: set[str]) -> None:
    """Remove versions and loose files other than ``keep``; what is newer than all of these belongs to another writer."""
    newest = max(int(_VERSION.match(k.rpartition("/")[2]).group(1)) for k in keep if _VERSION.match(k.rpartition("/")[2]))
    for name in _children(spark, path):
        folder = f"{path.rstrip('/')}/{name}"
        m = _VERSION.match(name)
        if folder not in keep and not (m and int(m.group(1)) > newest):
            fs, p = file_system(spark, folder)
            fs.delete(p, True)


def replace_table(df: DataFrame, path: str, partition_by=()) -> str:
    """Replace a table by ``df``, which may read that very table; the folder of the new version."""
    spark = df.sparkSession
    before = versions(spark, path)
    old = _committed(spark, path)[-1:]
    number = 1 + max((n for n, _ in before), default=0)
    folder = f"{path.rstrip('/')}/_v{number:09d}-{uuid.uuid4().hex[:12]}"
    w = df.write.option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(folder)
    _commit(spark, folder)
    _remove_old(spark, path, {folder, *old})
    return folder


def append_table(df: DataFrame, path: str, partition_by=()) -> str:
    """Add rows to a table; the folder they are in.  A table that is only ever appended to has no
    versions: its rows lie in its own folder, which Spark can read directly."""
    folder = current(df.sparkSession, path) or path
    w = df.write.mode("append").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(folder)
    return folder
