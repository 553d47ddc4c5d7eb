"""Steps whose shuffles and times must not grow faster than their input."""

import pytest
from pyspark.sql import functions as F

from staykit.functions.clean import snapshot_date
from staykit.operators.keys import first_per_key, first_per_key_split, insert_if_absent, may_be_held, rows_to_add
from staykit.plans import catalog
from staykit.sources.export import export_snapshots
from staykit.sources.snapshots import read_snapshots
from staykit.schemas import RAW_LISTING_SCHEMA


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def keyed_rows(spark):
    rows = [(i, "f", i) for i in range(50)] + [(3, "f", 1), (3, "g", 1), (None, "f", 4), (None, "f", 2), (None, None, 7)]
    return spark.createDataFrame(rows, "id int, filename string, v int")


def test_split_needs_no_join_of_whole_rows(spark):
    df, before = keyed_rows(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as when the repeated keys are many
    try:
        out = first_per_key_split(df, ["id", "filename"])
        assert "SortMergeJoin" not in plan(out) and "ShuffledHashJoin" not in plan(out)
        assert sorted(map(str, out.collect())) == sorted(map(str, first_per_key(df, ["id", "filename"]).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bits_miss_no_held_key(spark, monkeypatch):
    from staykit.operators import keys

    monkeypatch.setattr(keys, "WORDS", 2)  # full bits flag too much, never too little
    df = keyed_rows(spark)
    held = df.filter("id < 10 or id is null").select("id", "filename")
    marked = may_be_held(df, held, ["id", "filename"], "m")
    assert marked.columns == [*df.columns, "m"] and marked.count() == df.count()
    assert marked.filter("(id < 10 or id is null) and not m").count() == 0
    assert sorted(map(str, first_per_key_split(df, ["id", "filename"]).collect())) == sorted(
        map(str, first_per_key(df, ["id", "filename"]).collect()))


def test_insert_split_is_the_same(spark):
    new, old = keyed_rows(spark), keyed_rows(spark).filter("id = 5").withColumn("v", F.lit(-1))
    got = [sorted(map(str, insert_if_absent(new, old, ["id", "filename"], split=s).collect())) for s in (False, True)]
    assert got[0] == got[1]


def test_keyed_rows_are_not_reduced_again(spark):
    new, old = keyed_rows(spark).filter("id > 3"), keyed_rows(spark).filter("id = 5")
    out = rows_to_add(new, old, ["id", "filename"], keyed=True)
    assert "Aggregate" not in plan(out)
    assert sorted(map(str, out.collect())) == sorted(map(str, rows_to_add(new, old, ["id", "filename"]).collect()))


def test_part_names_are_not_parsed_as_dates(spark):
    paths = spark.createDataFrame([("a/snapshot=2020-07-01/part-0.csv",), ("a/2020-08-01.csv",), ("part-1.csv",)], "p string")
    dated = paths.select(snapshot_date("p").alias("d"))
    assert [str(r.d) for r in dated.collect()] == ["2020-07-01", "2020-08-01", "None"]
    assert "< A)" in plan(dated)  # a name that begins with a letter fails without an exception


@pytest.mark.parametrize("compression", [None, "gzip"])
def test_export_of_filled_columns_is_whole(spark, scratch, compression):
    rows = [(i, f"x {i}, \"q\"\nline", 7, None if i % 3 else 2, f"in/{'late' if i % 2 else 'snap'}/2020-{1 + i % 12:02d}-01.csv")
            for i in range(60)] + [(99, "undated", 7, 1, None)]
    some = spark.createDataFrame(rows, "id long, name string, host_id long, beds int, filename string")
    df = some.select(*[F.col(f.name) if f.name in some.columns else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in RAW_LISTING_SCHEMA.fields])
    columns = ["id", "name", "host_id", "beds"]
    got = [sorted(map(str, read_snapshots(spark, export_snapshots(df, scratch("csv"), compression, f)).select(*columns).collect()))
           for f in (columns, None)]
    assert got[0] == got[1] and len(got[0]) == 60
    files = read_snapshots(spark, export_snapshots(df, scratch("csv"), compression, columns)).select("filename").distinct()
    assert files.count() == len({r[4] for r in rows if r[4]})  # one file a folder and month


def test_append_exports_no_files_it_does_not_load(spark, monkeypatch):
    def fail(*_):
        raise AssertionError("all snapshots exported")

    class Stop(Exception):
        pass

    def run(spark, inputs, out_root, **_):
        assert {"listings", "location", "g01", "g02"} == set(inputs) and "/in/a" in inputs["listings"]
        raise Stop

    monkeypatch.setattr(catalog, "_snapshot_files", fail)
    monkeypatch.setattr(catalog.refresh, "run", run)
    with pytest.raises(Stop):
        catalog.REGISTRY["pipeline_append"](spark, "/root/testdata/sf0.001")


def test_fact_alone_builds_no_owners(spark, monkeypatch):
    def fail(*_):
        raise AssertionError("owners built")

    from staykit.plans import layers

    monkeypatch.setattr(layers, "_WRITTEN", {})
    monkeypatch.setattr(catalog, "build_owners", fail)
    assert catalog.REGISTRY["active_filter"](spark, "/root/testdata/sf0.001").count() > 0
