from pyspark.sql import functions as F

from staykit.sources import fixture as fx
from staykit.sources.export import export_snapshots
from staykit.streaming.incremental import run_available

SF = "/root/testdata/sf0.001"


def test_available_now_stream_appends_only_new_files(spark, scratch):
    root = scratch("stream")
    rows = fx.listing_rows(spark, SF)
    export_snapshots(rows.filter(F.col("calendar_last_scraped") < "1998-01-01"), f"{root}/in/a")
    raw_path, ckpt = f"{root}/raw", f"{root}/ckpt"
    n1 = run_available(spark, f"{root}/in", raw_path, ckpt).count()
    assert n1 > 0
    # nothing new: the checkpoint has seen every file
    assert run_available(spark, f"{root}/in", raw_path, ckpt).count() == n1
    # a new month's files arrive
    late = rows.filter(F.col("calendar_last_scraped") >= "1998-01-01")
    export_snapshots(late, f"{root}/in/b")
    n2 = run_available(spark, f"{root}/in", raw_path, ckpt).count()
    assert n2 == n1 + late.select("id", "filename").distinct().count()


def test_stream_reads_what_the_batch_reads_and_never_overwrites(spark, scratch):
    import gzip
    import os

    root = scratch("my stream").replace("file:", "", 1)
    os.makedirs(f"{root}/in")
    spark.conf.set("spark.hadoop.mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    spark.sparkContext._jsc.hadoopConfiguration().set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        for k, name in enumerate(("2020-01-01.gz", "2020-02-01.csv")):
            text = f"id,host_id\n{k},10\n{k + 10},11\nbad,1\n"
            with (gzip.open if name.endswith("gz") else open)(f"{root}/in/{name}", "wt") as f:
                f.write(text)
            run_available(spark, f"{root}/in", f"{root}/raw", f"{root}/ckpt")
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    assert sorted(r.id for r in spark.read.parquet(f"{root}/raw").collect()) == [0, 1, 10, 11]
    assert spark.read.parquet(f"{root}/raw.rejects").count() == 2
    # a batch that is run again adds nothing
    from staykit.streaming.incremental import append_batch

    batch = spark.createDataFrame([(f"file:{root}/in/2020-01-01.gz",)], "path string")
    append_batch(spark, batch, f"{root}/raw")
    assert spark.read.parquet(f"{root}/raw").count() == 4


def test_a_batch_that_stopped_before_its_rejects_is_made_good(spark, scratch, monkeypatch):
    import os

    import pytest
    from staykit.streaming import incremental

    root = scratch("stopped").replace("file:", "", 1)
    os.makedirs(f"{root}/in")
    for k in (1, 2):
        with open(f"{root}/in/2020-0{k}-01.csv", "w") as f:
            f.write(f"id,host_id\n{k},10\nbad,1\n")
    batch = spark.createDataFrame([(f"file:{root}/in/2020-0{k}-01.csv",) for k in (1, 2)], "path string")
    jobs = incremental.raw_jobs

    def stops(*args):
        def lost():
            raise OSError("lost")

        return dict(jobs(*args), raw_rejects=lost)

    incremental.append_batch(spark, batch.limit(1), f"{root}/raw")
    monkeypatch.setattr(incremental, "raw_jobs", stops)
    with pytest.raises(OSError):
        incremental.append_batch(spark, batch, f"{root}/raw")
    monkeypatch.setattr(incremental, "raw_jobs", jobs)
    for _ in range(2):
        incremental.append_batch(spark, batch, f"{root}/raw")
        assert sorted(r.id for r in spark.read.parquet(f"{root}/raw").collect()) == [1, 2]
        assert spark.read.parquet(f"{root}/raw.rejects").agg({"n_rows": "sum"}).first()[0] == 2
