"""Writing the derived fixture out as the files the original job reads.

Snapshot rows go to one CSV per (folder, month) in three header shapes, to
exercise the drift handling:

* months 1-4:  the landing columns in their natural order;
* months 5-8:  reversed order, plus two retired columns (``summary`` holding
  quoted multi-line text, and ``square_feet``);
* months 9-12: without ``beds`` and ``review_scores_rating``.

Files land as ``<root>/<shape>/src=<folder>/snapshot=<YYYY-MM-DD>/part-*``;
every (folder, month) has a number and is one partition, so it is exactly one
file, and no task sorts rows.  Only columns that hold values are shuffled; the
empty ones are added as they are written, and the shapes are written at the
same time.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.tables import file_system
from ..schemas import RAW_LISTING_COLUMNS

SHAPES = {
    "plain": (1, 4),
    "reordered": (5, 8),
    "narrow": (9, 12),
}
NARROW_MISSING = ("beds", "review_scores_rating")
# Keep text byte-exact: the writer trims blanks by default.
WRITE_OPTIONS = {"header": "true", "escape": '"', "quote": '"',
                 "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _shape_columns(shape: str) -> list:
    cols = [c for c in RAW_LISTING_COLUMNS if c != "filename"]
    if shape == "reordered":
        extra = [F.concat(F.lit("Summary of "), F.col("name"), F.lit('\nsecond "line"')).alias("summary"),
                 F.lit(None).cast("string").alias("square_feet")]
        return extra + [F.col(c) for c in reversed(cols)]
    if shape == "narrow":
        return [F.col(c) for c in cols if c not in NARROW_MISSING]
    return [F.col(c) for c in cols]


def export_snapshots(rows: DataFrame, root: str, compression: str | None = None,
                     filled: Sequence[str] | None = None, finish: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Write listing rows (with ``filename``) as monthly snapshot CSVs under ``root``.

    ``filled`` names the columns that can hold values, if the others are known to be
    NULL in every row (all can, without it).  ``finish`` makes listing rows of ``rows``
    after these are dealt out to their files, where ``rows`` say the same in fewer bytes."""
    spark, path = rows.sparkSession, F.col("filename")
    base, before = F.substring_index(path, "/", -1), F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    snapshot = F.split_part(base, F.lit("."), F.lit(1))
    # the files, few and known to the driver, which numbers them
    files = rows.select("filename").distinct().select(
        "filename", F.when(F.contains(path, F.lit("/")), before).otherwise("").alias("src"), snapshot.alias("snapshot"),
        F.month(F.try_to_date(snapshot)).alias("month")).filter("month is not null").collect()
    folder = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    if finish is None:
        held = [c for c in RAW_LISTING_COLUMNS if c != "filename" and (filled is None or c in filled)]
        empty = {f.name: F.lit(None).cast(f.dataType) for f in rows.schema.fields if f.name not in held and f.name != "filename"}
        rows, finish = rows.select(*held, "filename"), lambda df: df.withColumns(empty)

    def write(shape: str) -> None:
        first, last = SHAPES[shape]
        mine = [f for f in files if first <= f.month <= last]
        folders = sorted({f"{folder('src', f.src)}/{folder('snapshot', f.snapshot)}" for f in mine})
        fs, target = file_system(spark, f"{root}/{shape}")
        if not mine:
            fs.mkdirs(target)
            return
        # partition 0 stays empty: Spark writes a file for it in any case
        number = {name: i for i, name in enumerate(folders, 1)}
        numbers = spark.createDataFrame([(f.filename, number[f"{folder('src', f.src)}/{folder('snapshot', f.snapshot)}"]) for f in mine],
                                        "filename string, __file int")
        placed = (rows.join(F.broadcast(numbers), "filename").drop("filename")
                  .repartitionById(len(folders) + 1, "__file").drop("__file"))
        writer = finish(placed).select(*_shape_columns(shape)).write.mode("overwrite").options(**WRITE_OPTIONS)
        if compression:
            writer = writer.option("compression", compression)
        writer.csv(f"{root}/{shape}")
        for status in fs.listStatus(target):  # each partition's file goes to the folder of its file
            p = status.getPath()
            if not p.getName().startswith("part-"):
                continue
            i = int(p.getName().split("-")[1])
            if i == 0:
                fs.delete(p, False)
                continue
            _, to = file_system(spark, f"{root}/{shape}/{folders[i - 1]}/{p.getName()}")
            fs.mkdirs(to.getParent())
            if not fs.rename(p, to):
                raise OSError(f"could not place {to}")

    with ThreadPoolExecutor(max_workers=len(SHAPES)) as pool:
        list(pool.map(write, SHAPES))
    return root


def redeliver(spark: SparkSession, new_root: str, old_root: str) -> str:
    """Deliver the files of one export again under the names of another: a file of ``new_root``
    takes the place of the file of the same month in ``old_root``, or comes as a new one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(old_root).getFileSystem(conf)

    def by_month(root: str) -> dict:
        base, out = fs.makeQualified(path(root)).toString(), {}
        files = fs.listFiles(path(root), True) if fs.exists(path(root)) else None
        while files is not None and files.hasNext():
            p = files.next().getPath()
            if p.getName().startswith("part-"):
                out[p.getParent().toString()[len(base):].strip("/")] = p
        return out

    old = by_month(old_root)
    for month, p in by_month(new_root).items():
        target = old.get(month) or path(f"{old_root}/{month}/{p.getName()}")
        fs.mkdirs(target.getParent())
        if month in old:
            fs.delete(target, False)
        if not fs.rename(p, target):
            raise OSError(f"could not deliver {target}")
    return old_root


def export_table_csv(df: DataFrame, path: str) -> str:
    """A lookup or census table as CSV with a header."""
    df.write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)
    return path


def census_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first census table as text, with columns beyond those that the dimension reads:
    ``Peak_balance`` (decimals), ``Area_code`` (digits with leading zeros, in other nations with a letter),
    ``Share`` (whole numbers for nations of the first regions, decimals for the others), ``Persons_scaled`` (too
    long for 64 bits) and ``Remarks`` (no value)."""
    from .fixture import census_g01, read_table

    c, n = read_table(spark, sf_dir, "customer"), read_table(spark, sf_dir, "nation")
    extra = (c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_nationkey", "n_regionkey").agg(
        F.max("c_acctbal").cast("string").alias("Peak_balance"), F.count(F.lit(1)).alias("_n"))
        .select(F.concat(F.lit("LGA"), F.col("n_nationkey")).alias("LGA_CODE_2016"), F.col("n_regionkey").alias("region"), "Peak_balance",
                F.concat(F.when(F.col("n_nationkey") < 10, F.lit("00")).otherwise(F.lit("A")), F.col("n_nationkey")).alias("Area_code"),
                F.when(F.col("n_regionkey") <= 2, F.col("_n").cast("string"))
                .otherwise((F.col("_n") / 2).cast("decimal(20,1)").cast("string")).alias("Share"),
                F.concat(F.col("_n").cast("string"), F.lit("0" * 20)).alias("Persons_scaled"),
                F.lit(None).cast("string").alias("Remarks")))
    return census_g01(spark, sf_dir).join(extra, "LGA_CODE_2016")


def export_census_wide(wide: DataFrame, root: str) -> str:
    """``census_wide`` as CSVs of two shapes: the other regions' files have their columns
    reversed and lack ``Remarks``."""
    columns = [c for c in wide.columns if c != "region"]
    export_table_csv(wide.filter("region <= 2").select(*columns), f"{root}/first")
    export_table_csv(wide.filter("region > 2").select(*[c for c in reversed(columns) if c != "Remarks"]), f"{root}/second")
    return root


def lineage_columns(df: DataFrame) -> DataFrame:
    """Replace the file path by the source folder and the snapshot date it names."""
    from ..functions.clean import apart, snapshot_date

    path = F.col("filename")
    return (df.withColumn("folder", apart(F.regexp_extract(path, r"src=([^/]+)/", 1)))
            .withColumn("snapshot_date", snapshot_date(path)).drop("filename"))
