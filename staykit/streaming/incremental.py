"""Incremental snapshot load as a Structured Streaming job.

"A new monthly file arrives" becomes a file stream over the snapshot folder
with ``trigger(availableNow=True)``: each run picks up only files the
stream's checkpoint has not seen.  A file stream needs one fixed schema,
but snapshot headers drift, so the stream only discovers files (the
``binaryFile`` source, path column only) and ``foreachBatch`` reads each
batch's files with the same reader as the batch job and appends only the keys
not yet in the raw table.

Exactly-once: the stream checkpoint records processed files; a batch that is
re-run after a failure appends nothing twice and leaves nothing out, because
both appends are keyed against their table as written, and files are marked as
loaded after both (``raw_jobs``, ``mark_loaded``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..plans.ledger import mark_loaded, raw_jobs, report_changes, stage, start_marker, unseen_files
from ..plans.tables import file_system, read_table
from ..sources.snapshots import FileInfo, canonical_path, checked_names

# Schema of the binaryFile source (a stream must declare it).
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


def file_info(spark: SparkSession, path: str) -> FileInfo:
    """A file as it is now (it may have changed since the stream listed it)."""
    fs, p = file_system(spark, path)
    status = fs.getFileStatus(p)
    return FileInfo(path, status.getLen(), status.getModificationTime())


def append_batch(spark: SparkSession, batch: DataFrame, raw_path: str) -> None:
    """foreachBatch body: load the batch's files and append what is not there yet.

    Only ever appends: a batch that is run again finds its files marked as loaded,
    or, if it stopped before that, adds only what each table lacks.
    """
    paths = checked_names(sorted({canonical_path(r.path) for r in batch.select("path").distinct().collect()}))
    start_marker(spark, raw_path)
    files = unseen_files(spark, [file_info(spark, p) for p in paths], raw_path)
    if not files:
        return
    load = stage(spark, files, raw_path)
    report_changes(spark, load, raw_path)
    for job in raw_jobs(spark, load, raw_path).values():
        job()
    mark_loaded(spark, load, raw_path)


def start(spark: SparkSession, in_dir: str, raw_path: str, checkpoint: str, max_files: int = 1000):
    """Start the availableNow stream; returns the StreamingQuery."""
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
             .option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", max_files)
             .load(in_dir)
             .filter("length > 0").select("path"))
    return (files.writeStream
            .foreachBatch(lambda batch, _epoch: append_batch(batch.sparkSession, batch, raw_path))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def run_available(spark: SparkSession, in_dir: str, raw_path: str, checkpoint: str) -> DataFrame:
    """Process every file not yet seen, wait, and return the raw table."""
    q = start(spark, in_dir, raw_path, checkpoint)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_table(spark, raw_path)
