"""Steps that must not shuffle or write more bytes than they need."""

import re

import pytest
from pyspark.sql import functions as F

from staykit.functions.clean import apart
from staykit.operators.constraints import broken_rules, foreign_key, repeated_rows
from staykit.operators.keys import first_per_key, rows_to_add
from staykit.operators.listings import exclude_moved
from staykit.plans import catalog
from staykit.plans.star import build_owners
from staykit.plans.tables import append_table, replace_table
from staykit.schemas import LOCATION_SCHEMA, RAW_LISTING_SCHEMA
from staykit.sources import fixture as fx
from staykit.sources.export import export_snapshots
from staykit.sources.snapshots import list_files, read_snapshots, typed_projection

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def nothing_small(spark):
    """No table is small enough for Spark to broadcast it by itself."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


LINES = ("select * from values (1L, 10.25D, 3, 5D, timestamp_ntz'1996-03-13 00:00:00', 0.08D, 0.1D, 'R', 'O'),"
         "(2L, 10.251D, 1, 5D, timestamp_ntz'1996-03-13 00:00:00', 0.02D, 0.1D, 'N', 'F'),"
         "(3L, null, 1, 5D, timestamp_ntz'1996-03-13 00:00:00', 0.02D, 0.1D, 'N', 'F'),"
         "(4L, -3.5D, 1, -5D, timestamp_ntz'1950-03-13 00:00:00', -0.02D, 7.5D, null, null),"
         "(5L, 99999999999.99D, 100000, 50000D, timestamp_ntz'9999-03-13 00:00:00', 0.02D, 0.1D, 'R', 'F'),"
         "(6L, 1.0D, null, null, null, null, null, null, null), (7L, double('NaN'), 1, 1D, null, 0.01D, 0.01D, 'R', 'O'),"
         "(8L, 0.01D, 0, 0D, timestamp_ntz'1970-01-01 00:00:00', 0D, 0D, 'R', 'O')"
         " as t(l_orderkey, l_extendedprice, l_linenumber, l_quantity, l_shipdate, l_tax, l_discount, l_returnflag, l_linestatus)")


def test_packed_lines_give_every_value_back(spark):
    lines = spark.sql(LINES)
    held = fx.packed(lines, ["l_orderkey"])
    assert {r.l_orderkey for r in held.filter("odd is null").collect()} == {1, 8}  # the others keep their values as they are
    assert held.filter("odd is null").select("_a", "_b").dropna().count() == 2
    back = held.select("l_orderkey", *[fx.line_column(c).alias(c) for c in fx.LINE_EXPR])
    assert rows_of(back) == rows_of(lines.select("l_orderkey", *[F.expr(e).alias(c) for c, e in fx.LINE_EXPR.items()]))


def test_lines_are_shuffled_for_orders_and_parts_only(spark, nothing_small):
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+?)#", plan(fx.listing_rows(spark, SF)))
    assert "l_orderkey" in exchanges and "l_partkey" in exchanges and "l_suppkey" not in exchanges


def test_export_after_dealing_out_is_the_same(spark, scratch):
    whole, narrow = scratch("csv"), scratch("csv")
    rows = fx.listing_rows(spark, SF)
    export_snapshots(rows, whole, filled=fx.LISTING_EXPR)
    catalog._export(spark, SF, fx.joined_lines(spark, SF), narrow, None)
    columns = [c for c in RAW_LISTING_SCHEMA.fieldNames() if c != "filename"]
    got = [read_snapshots(spark, p) for p in (whole, narrow)]
    assert rows_of(got[0].select(*columns)) == rows_of(got[1].select(*columns))
    names = [sorted(f[len("file:" + p) - 1:].rpartition("/")[0].lstrip("/") for f in list_files(spark, p)) for p in (whole, narrow)]
    assert names[0] == names[1] and len(set(names[0])) == len(names[0])  # one file a folder and month
    assert len(names[0]) == rows.select("filename").distinct().count()


def test_export_sorts_no_rows(spark, scratch, monkeypatch):
    from pyspark.sql import DataFrame

    def fail(*_, **__):
        raise AssertionError("rows sorted")

    monkeypatch.setattr(DataFrame, "sortWithinPartitions", fail)
    path = catalog._export(spark, SF, fx.joined_lines(spark, SF), scratch("csv"))
    files = list_files(spark, path)
    assert files and all(f.endswith(".csv.gz") for f in files)


def test_jobs_read_compressed_files(spark):
    assert all(f.endswith(".gz") for f in list_files(spark, catalog._snapshot_files(spark, SF)))
    assert all(f.endswith(".csv") for f in list_files(spark, catalog._snapshot_files(spark, SF, None)))  # csv_snapshot_scan


def test_wide_projection_is_not_one_method(spark):
    text = spark.createDataFrame([("7", "8", "a.csv"), (None, "x", "NA")], "id string, host_id string, filename string")
    out = typed_projection(text)
    wide = [line for line in plan(out).splitlines() if "Project [" in line and "listing_url" in line]
    assert wide and not any(re.search(r"\*\(\d+\)", line) for line in wide)
    assert [(r.id, r.host_id, r.filename) for r in out.collect()] == [(7, 8, "a.csv"), (None, None, None)]


def test_apart_is_the_column_itself(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert [r.c for r in df.select(apart("c").alias("c")).collect()] == ["a", None]


KEYED = [(i, "f", i) for i in range(40)] + [(3, "f", 1), (3, "f", 1), (4, "g", 1), (None, "f", 4), (None, "f", 2), (None, None, 7), (None, None, 7)]


def test_unique_rows_are_not_shuffled_to_find_repeated_ones(spark, nothing_small):
    df = spark.createDataFrame(KEYED, "id int, filename string, v int")
    out = repeated_rows(df, ["id", "filename"])
    assert "BroadcastHashJoin" in plan(out)  # tells rows of unique keys before any join by shuffle
    got = sorted((r.id or -1, r.filename or "", r.v, r.copies) for r in out.collect())
    assert got == [(-1, "", 7, 1), (-1, "f", 4, 1), (3, "f", 1, 1), (3, "f", 3, 1)]


def test_few_missing_parents_are_broadcast(spark, nothing_small):
    rows = spark.createDataFrame([(1, 10), (2, 20), (3, None), (4, 30)], "id int, host int")
    parent = spark.createDataFrame([(10,), (10,), (40,)], "host int")
    out = broken_rules(rows, [foreign_key("fk", "host", parent, "host")])
    text = plan(out)
    assert text.index("BroadcastHashJoin") < text.index("SortMergeJoin")  # the join of whole rows comes first in the plan
    assert sorted((r.id, tuple(r.broken)) for r in out.collect()) == [(1, ()), (2, ("fk",)), (3, ()), (4, ("fk",))]


def test_unmoved_listings_are_not_shuffled(spark, nothing_small):
    rows = [(i, "a", i) for i in range(50)] + [(3, "b", 1), (4, None, 1), (5, "a", 2)]
    df = spark.createDataFrame(rows, "id long, neighbourhood_cleansed string, v int")
    out = exclude_moved(df)
    assert re.search(r"BroadcastHashJoin [^\n]*LeftAnti", plan(out))
    assert rows_of(out) == sorted(str(r) for r in df.collect() if r.id not in (3, 4))


def test_owners_count_listings_by_ids_alone(spark, scratch):
    cols = "id long, host_id long, host_name string, host_location string, host_total_listings_count int, host_is_superhost string, " \
           "neighbourhood_cleansed string, filename string"
    rows = [(1, 7, "a", " x , y", 1, "t", "p", "2020-02-01.csv"), (1, 7, "b", "z", 2, "f", "p", "2020-01-01.csv"),
            (2, 7, "c", "z", 2, "f", "p", "2020-03-01.csv"), (9, None, "n", None, None, None, "p", "2020-03-01.csv"),
            (8, None, "m", None, None, None, "p", "2020-02-01.csv"), (5, 6, "q", "z", 1, "t", "p", "2020-01-01.csv"),
            (5, 6, "q", "z", 1, "t", "r", "2020-02-01.csv")]
    owners = build_owners(spark.createDataFrame(rows, cols), spark.createDataFrame([], LOCATION_SCHEMA))
    assert sorted((r.host_id or -1, r.host_name, r.host_tot_list_new) for r in owners.collect()) == [(-1, "m", 2), (7, "b", 2)]
    counted = [line for line in plan(owners).splitlines() if "Exchange hashpartitioning(host_id" in line and ", id#" in line]
    assert counted  # (host, id) pairs are shuffled without the host's attributes


def test_rows_to_add_of_a_table_compares_few(spark):
    new = spark.createDataFrame(KEYED, "id int, filename string, v int")
    old = new.filter("id in (3, 5) or id is null").withColumn("v", F.lit(-1))
    out = rows_to_add(new, old, ["id", "filename"], split=True)
    assert rows_of(out) == rows_of(first_per_key(new, ["id", "filename"]).join(old.select("id", "filename"), ["id", "filename"], "left_anti")
                                   .select(*new.columns))
    assert "BroadcastHashJoin" in plan(out)


def test_tables_are_compressed_by_zstd(spark, scratch):
    a, b = scratch("t"), scratch("t")
    for folder in (replace_table(spark.range(9), a), append_table(spark.range(9), b)):
        assert all(r.path.endswith(".zstd.parquet") for r in spark.read.format("binaryFile").load(f"{folder}/*.parquet").select("path").collect())
