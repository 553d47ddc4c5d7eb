"""Reading monthly listing snapshot CSVs whose headers drift.

Spark's multi-file CSV read takes one header and matches every other file
*by position*, which silently misplaces columns when files order them
differently.  So the reader

1. lists the files (Spark's file index, any Hadoop file system); a name that
   is no CSV by its ending is refused, not skipped;
2. reads the first line of each file (a few bytes per file, on the driver,
   through the Hadoop file system API so ``.gz`` and remote stores work);
3. issues one distributed CSV read per distinct header, with an all-string
   schema equal to that header;
4. drops the retired columns, adds the file path as lineage, and unions the
   groups by name (a column a file lacks becomes NULL);
5. casts to the landing types (NA tokens to NULL; bad numbers to NULL).

There is one reader for files of any size, for batch and stream.  Records may
span lines, so a file is one task; a caller whose files are known to hold no
line breaks in values can pass ``multi_line=False``, and then Spark splits
plain files by blocks.  Compressed files are one task each either way: write
inputs as files of at most a few hundred MB.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import reduce
from typing import Iterable, NamedTuple, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import apart, null_tokens
from ..schemas import DROPPED_LISTING_COLUMNS, RAW_LISTING_SCHEMA

CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"'}


COMPRESSED = (".gz", ".bz2")
WIDE = 40  # columns from which a projection is too long for one compiled method


def canonical_path(path: str) -> str:
    """One spelling of a file's path, as :func:`lineage` writes it."""
    return re.sub(r"^file:/+", "file:/", path)


def lineage():
    """The path of a row's file: escapes undone, one spelling of the local scheme.

    The path is constant within a file, so only cheap tests run on every row: escapes
    are undone where there are any, and no regular expression is used.
    """
    path = F.col("_metadata.file_path")
    decoded = F.when(F.contains(path, F.lit("%")), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)
    return F.when(F.startswith(decoded, F.lit("file:/")), F.concat(F.lit("file:/"), F.ltrim(F.substr(decoded, F.lit(6)), F.lit("/")))
                  ).otherwise(decoded)


class FileInfo(NamedTuple):
    """A file as the file system tells it: path, length in bytes, time of change in milliseconds."""

    path: str
    length: int
    modified: int


def list_files(spark: SparkSession, root: str) -> list[str]:
    """Paths of the data files under ``root`` (see :func:`file_infos`)."""
    return [f.path for f in file_infos(spark, root)]


def file_infos(spark: SparkSession, root: str) -> list[FileInfo]:
    """Data files under ``root`` (recursively) as Spark's file index sees them.

    Empty files hold no header and no rows and are left out.  Any other file
    that is not named as a CSV raises, so no input is passed over in silence.
    """
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
               .load(root).select("path", "length", F.unix_millis("modificationTime").alias("modified")))
    files = sorted(FileInfo(canonical_path(r.path), r.length, r.modified) for r in listing.filter("length > 0").collect())
    checked_names([f.path for f in files])
    return files


def checked_names(files: Sequence[str]) -> list[str]:
    odd = [f for f in files if not (f.lower().endswith(".csv") or f.endswith(COMPRESSED))]
    if odd:
        raise ValueError(f"not named as CSV files: {odd[:5]}{' ...' if len(odd) > 5 else ''}")
    return list(files)


def first_line(spark: SparkSession, path: str) -> str:
    """First line of a (possibly compressed) file via the Hadoop FS API."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(conf).open(p)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
    if codec is not None:
        stream = codec.createInputStream(stream)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def parse_header(line: str) -> tuple[str, ...]:
    """Column names of a CSV header line (quoted names allowed)."""
    import csv

    return tuple(next(csv.reader([line.lstrip("\ufeff")])))


def group_by_header(spark: SparkSession, files: Iterable[str], threads: int = 16) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by their header; headers are probed concurrently."""
    from concurrent.futures import ThreadPoolExecutor

    files = list(files)
    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(files)))) as pool:
        headers = list(pool.map(lambda f: parse_header(first_line(spark, f)), files))
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for f, h in zip(files, headers):
        groups[h].append(f)
    return dict(groups)


def _drift_of(header: Sequence[str], schema: T.StructType, retired: Sequence[str]) -> tuple[list, list, list]:
    """(retired, absent, unknown) columns of a header; names are compared without case."""
    have = {c.lower() for c in header}
    landing, gone = {f.name.lower(): f.name for f in schema.fields}, {c.lower() for c in retired}
    return (sorted(c for c in header if c.lower() in gone),
            sorted(name for low, name in landing.items() if low not in have and low != "filename"),
            sorted(c for c in header if c.lower() not in landing and c.lower() not in gone))


def header_drift(spark: SparkSession, groups: dict, schema: T.StructType = RAW_LISTING_SCHEMA,
                 retired: Sequence[str] = DROPPED_LISTING_COLUMNS) -> DataFrame:
    """How each file's header differs from the landing table: filename, n_columns, and the columns that
    are retired (dropped on purpose), absent (read as NULL) and unknown (dropped, and to be looked at)."""
    rows = [(f, len(h), *_drift_of(h, schema, retired)) for h, files in groups.items() for f in files]
    return spark.createDataFrame(rows, "filename string, n_columns int, retired array<string>, absent array<string>, unknown array<string>")


def check_columns(groups: dict, schema: T.StructType = RAW_LISTING_SCHEMA, retired: Sequence[str] = DROPPED_LISTING_COLUMNS) -> None:
    """Raise if a file has a column that is neither in the landing table nor retired (the original's insert failed on those)."""
    odd = {f: unknown for h, files in groups.items() if (unknown := _drift_of(h, schema, retired)[2]) for f in files}
    if odd:
        some = "; ".join(f"{f}: {', '.join(c)}" for f, c in sorted(odd.items())[:5])
        raise ValueError(f"unknown columns in {len(odd)} file(s): {some}")


def read_csv_group(spark: SparkSession, header: Sequence[str], files: Sequence[str],
                   options: dict | None = None) -> DataFrame:
    """One CSV read of files sharing ``header``; every column read as text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    reader = spark.read.schema(schema).options(**{**CSV_OPTIONS, **(options or {})})
    return reader.csv(list(files)).withColumn("filename", lineage())


def _to_number(c, dtype: T.DataType):
    """Text to a number, NULL when it does not parse.  Integer targets also
    take whole decimals such as ``2.0`` (written by float-typed exporters);
    a fraction such as ``2.5`` stays NULL rather than being truncated."""
    direct = c.try_cast(dtype)
    if not isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return direct
    dec = c.try_cast("decimal(38,6)")
    whole = F.when(F.contains(c, F.lit(".")) & (dec == F.floor(dec)), dec.try_cast(dtype))
    return F.coalesce(direct, whole)


def typed_projection(df: DataFrame, schema: T.StructType = RAW_LISTING_SCHEMA) -> DataFrame:
    """Text frame to the landing schema: every target column, in order.

    NA tokens become NULL first; numbers that do not parse become NULL
    (``try_cast``) instead of failing the load.  Target columns the frame
    lacks are NULL; columns not in the target are dropped.
    """
    have = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(src)
        if isinstance(df.schema[src].dataType, T.StringType):
            if isinstance(f.dataType, T.StringType):
                c = null_tokens(c)
            elif isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
                c = _to_number(c, f.dataType)  # every NA token fails the cast anyway
            else:
                c = _to_number(null_tokens(c), f.dataType)  # 'NaN' must become NULL, not NaN
        else:
            c = c.cast(f.dataType)
        cols.append((apart(c) if f is schema.fields[-1] and len(cols) >= WIDE else c).alias(f.name))
    return df.select(*cols)


def read_csv_by_header(spark: SparkSession, root: str | None, schema: T.StructType,
                       dropped: Sequence[str] = (), with_lineage: bool = True, multi_line: bool = True,
                       files: Sequence[str] | None = None, groups: dict | None = None) -> DataFrame:
    """Every CSV under ``root`` (or just ``files``, or files grouped by header), read once per
    distinct header, typed to ``schema``.

    ``dropped`` columns go when present; unknown extra columns are dropped
    too (``header_drift`` names them; ``check_columns`` raises, as the original's insert did).
    """
    if groups is None:
        groups = group_by_header(spark, list_files(spark, root) if files is None else checked_names(files))
    if not groups:
        return spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]))
    opts = {"multiLine": "true" if multi_line else "false"}
    frames = [read_csv_group(spark, h, fs, opts).drop(*dropped) for h, fs in sorted(groups.items())]
    if not with_lineage:
        frames = [f.drop("filename") for f in frames]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return typed_projection(union, schema)


def read_snapshots(spark: SparkSession, root: str | None, schema: T.StructType = RAW_LISTING_SCHEMA,
                   dropped: Sequence[str] = DROPPED_LISTING_COLUMNS, multi_line: bool = True,
                   files: Sequence[str] | None = None, groups: dict | None = None) -> DataFrame:
    """Listing snapshot files (all under ``root``, just ``files``, or files grouped by header) as one typed
    frame with ``filename``."""
    return read_csv_by_header(spark, root, schema, dropped, multi_line=multi_line, files=files, groups=groups)


def read_lookup_csv(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """A lookup or census CSV (one or more files) with a fixed target schema."""
    return read_csv_by_header(spark, root, schema, with_lineage=False)
