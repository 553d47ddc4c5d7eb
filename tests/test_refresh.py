import os

import pytest
from pyspark.sql import functions as F

from staykit.plans import refresh
from staykit.plans.catalog import REGISTRY
from staykit.sources import fixture as fx
from staykit.sources.export import export_snapshots, export_table_csv

SF = "/root/testdata/sf0.001"


def test_refresh_rerun_and_incremental_append(spark, scratch):
    root = scratch("refresh")
    rows = fx.listing_rows(spark, SF)
    early = rows.filter(F.col("calendar_last_scraped") < "1999-01-01")
    inputs = {"listings": f"{root}/in1/listings", "location": f"{root}/in1/location",
              "g01": f"{root}/in1/g01", "g02": f"{root}/in1/g02"}
    export_snapshots(early, inputs["listings"])
    export_table_csv(fx.locality_lookup(spark, SF), inputs["location"])
    export_table_csv(fx.census_g01(spark, SF), inputs["g01"])
    export_table_csv(fx.census_g02(spark, SF), inputs["g02"])
    out_root = f"{root}/out"
    out = refresh.run(spark, inputs, out_root, mode="append")
    counts = {k: spark.read.parquet(out[k]).count() for k in ("raw_listings", "fact", "owners", "kpi_region_month")}
    # re-running on the same files adds nothing
    refresh.run(spark, inputs, out_root, mode="append")
    again = {k: spark.read.parquet(out[k]).count() for k in counts}
    assert again == counts
    # a second batch of files: only its keys are added, existing rows stay
    late = dict(inputs, listings=f"{root}/in2/listings")
    export_snapshots(rows.filter(F.col("calendar_last_scraped") >= "1999-01-01"), late["listings"])
    out = refresh.run(spark, late, out_root, mode="append")
    raw = spark.read.parquet(out["raw_listings"])
    assert raw.count() == counts["raw_listings"] + rows.filter(
        F.col("calendar_last_scraped") >= "1999-01-01").select("id", "filename").distinct().count()
    assert spark.read.parquet(out["kpi_region_month"]).count() >= counts["kpi_region_month"]
    # every keyed table was audited and is clean
    audits = {r.table_name: r for r in spark.read.parquet(out["audit_keys"]).collect()}
    assert set(audits) == {"raw_location", "owners", "census", "kpi_region_month", "kpi_segment_month", "kpi_host_region_month"}
    assert all(r.n_duplicate_keys == 0 for r in audits.values())


def test_end_to_end_query_runs(spark):
    a = REGISTRY["end_to_end_region_kpi"](spark, SF)
    assert a.count() > 0
    assert set(a.columns) >= {"lga_code", "year", "month", "Estimated_revenue"}


def test_append_of_an_empty_batch_adds_nothing(spark, scratch):
    root = scratch("refresh")
    rows = fx.listing_rows(spark, SF).filter(F.col("calendar_last_scraped") < "1997-01-01")
    inputs = {"listings": f"{root}/in/listings", "location": f"{root}/in/location",
              "g01": f"{root}/in/g01", "g02": f"{root}/in/g02"}
    export_snapshots(rows, inputs["listings"])
    export_table_csv(fx.locality_lookup(spark, SF), inputs["location"])
    export_table_csv(fx.census_g01(spark, SF), inputs["g01"])
    export_table_csv(fx.census_g02(spark, SF), inputs["g02"])
    out = refresh.run(spark, inputs, f"{root}/out", mode="append")
    before = {k: spark.read.parquet(out[k]).count() for k in ("fact", "owners", "kpi_region_month",
                                                              "kpi_segment_month", "kpi_host_region_month")}
    empty = dict(inputs, listings=f"{root}/in/none")
    export_snapshots(rows.limit(0), empty["listings"])
    refresh.run(spark, empty, f"{root}/out", mode="append")
    assert {k: spark.read.parquet(out[k]).count() for k in before} == before


def test_scoped_append_equals_full_rederivation(spark, scratch):
    """Building the star tables from the batch files only gives what re-deriving
    everything from all raw rows and skipping existing keys gives."""
    from staykit.operators.keys import rows_to_add
    from staykit.operators.listings import moved_ids
    from staykit.plans.star import build_fact, build_owners

    root = scratch("refresh")
    rows = fx.listing_rows(spark, SF)
    inputs = {"location": f"{root}/in/location", "g01": f"{root}/in/g01", "g02": f"{root}/in/g02"}
    export_table_csv(fx.locality_lookup(spark, SF), inputs["location"])
    export_table_csv(fx.census_g01(spark, SF), inputs["g01"])
    export_table_csv(fx.census_g02(spark, SF), inputs["g02"])
    export_snapshots(rows.filter(F.col("calendar_last_scraped") < "1998-06-01"), f"{root}/in/a")
    export_snapshots(rows.filter(F.col("calendar_last_scraped") >= "1998-06-01"), f"{root}/in/b")
    out = refresh.run(spark, dict(inputs, listings=f"{root}/in/a"), f"{root}/out", mode="append")
    fact1 = spark.createDataFrame(spark.read.parquet(out["fact"]).collect(), spark.read.parquet(out["fact"]).schema)
    own1 = spark.createDataFrame(spark.read.parquet(out["owners"]).collect(), spark.read.parquet(out["owners"]).schema)
    refresh.run(spark, dict(inputs, listings=f"{root}/in/b"), f"{root}/out", mode="append")

    raw = spark.read.parquet(out["raw_listings"])
    loc = spark.read.parquet(out["raw_location"])
    moved = moved_ids(raw)
    for table, first, build, keys in (("fact", fact1, build_fact, ["id", "year", "month"]),
                                      ("owners", own1, build_owners, ["host_id"])):
        full = build(raw, loc, moved).select(*first.columns)
        expected = first.unionByName(rows_to_add(full, first, keys).select(*first.columns))
        got = spark.read.parquet(out[table]).select(*first.columns)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_refresh_job_script(spark, scratch):
    import refresh_job

    root = scratch("job")
    rows = fx.listing_rows(spark, SF).filter(F.col("calendar_last_scraped") < "1996-01-01")
    export_snapshots(rows, f"{root}/listings")
    export_table_csv(fx.locality_lookup(spark, SF), f"{root}/location")
    export_table_csv(fx.census_g01(spark, SF), f"{root}/g01")
    export_table_csv(fx.census_g02(spark, SF), f"{root}/g02")
    out = refresh_job.main(["--listings", f"{root}/listings", "--location", f"{root}/location",
                            "--g01", f"{root}/g01", "--g02", f"{root}/g02", "--out", f"{root}/out"])
    assert spark.read.parquet(out["kpi_region_month"]).count() > 0


def test_replace_table_over_its_own_input(spark, scratch):
    path = scratch("own")
    spark.range(5).write.parquet(path)
    plain = path.replace("file:", "", 1)
    for p in (path, plain):
        df = refresh.read_table(spark, p).withColumn("id", F.col("id") + 1)
        refresh.replace_table(df, p)
    assert sorted(r.id for r in refresh.read_table(spark, path).collect()) == [2, 3, 4, 5, 6]


HEAD = "id,host_id,host_name,host_location,host_is_superhost,neighbourhood_cleansed,price,has_availability,availability_30\n"


def small_inputs(scratch, folder="in"):
    root = scratch("small").replace("file:", "", 1)
    inputs = {k: f"{root}/{folder}/{k}" for k in ("listings", "location", "g01", "g02")}
    for path in inputs.values():
        os.makedirs(path)
    with open(f"{inputs['location']}/l.csv", "w") as f:
        f.write("LOCALITY_ID,LOCALITY_NAME,LOCALITY_TYPE,POSTCODE,STATE,LGA_CODE,LGA_NAME\n1,Bondi,SUBURB,2026,NSW,L1,W\n")
    for name in ("g01", "g02"):
        with open(f"{inputs[name]}/c.csv", "w") as f:
            f.write("LGA_CODE_2016\nL1\n")
    return inputs, root


def month_file(inputs, name, *rows):
    with open(f"{inputs['listings']}/{name}", "w") as f:
        f.write(HEAD + "".join(f"{r}\n" for r in rows))


def rows_in(spark, out, table, *cols):
    return sorted(tuple(r) for r in spark.read.parquet(out[table]).select(*cols).collect())


def test_append_reads_files_whose_path_needs_escapes(spark, scratch):
    inputs, root = small_inputs(scratch, "my in")
    month_file(inputs, "2020-01-01.csv", "1,10,A,x,t,Bondi,$5.00,t,3")
    refresh.run(spark, inputs, f"{root}/out", mode="append")
    month_file(inputs, "2020-02-01.csv", "1,10,A,x,t,Bondi,$6.00,t,3", "2,10,A,x,t,Bondi,$7.00,t,3")
    out = refresh.run(spark, inputs, f"{root}/out", mode="append")
    assert rows_in(spark, out, "fact", "id", "month") == [(1, 1), (1, 2), (2, 2)]


def test_a_batch_that_stopped_after_raw_is_made_good(spark, scratch):
    inputs, root = small_inputs(scratch)
    month_file(inputs, "2020-01-01.csv", "1,10,A,x,t,Bondi,$5.00,t,3")
    refresh.run(spark, inputs, f"{root}/out", mode="append")
    month_file(inputs, "2020-02-01.csv", "2,11,B,x,f,Bondi,$6.00,t,3")
    refresh.run(spark, inputs, f"{root}/out", mode="append", until="raw")
    month_file(inputs, "2020-03-01.csv", "3,12,C,x,f,Bondi,$7.00,t,3")
    out = refresh.run(spark, inputs, f"{root}/out", mode="append")
    assert rows_in(spark, out, "fact", "id", "month") == [(1, 1), (2, 2), (3, 3)]
    assert rows_in(spark, out, "owners", "host_id") == [(10,), (11,), (12,)]
    assert [r[0] for r in rows_in(spark, out, "kpi_host_region_month", "month")] == [1, 2, 3]


def test_a_failed_first_write_does_not_block_appends(spark, scratch):
    inputs, root = small_inputs(scratch)
    os.makedirs(f"{root}/out/raw/listings/_temporary/0")
    month_file(inputs, "2020-01-01.csv", "1,10,A,x,t,Bondi,$5.00,t,3")
    out = refresh.run(spark, inputs, f"{root}/out", mode="append")
    assert rows_in(spark, out, "fact", "id") == [(1,)]


@pytest.mark.parametrize("committed", ["raw_rejects", "raw_listings"])
def test_an_append_that_wrote_one_of_raw_and_rejects_is_made_good(spark, scratch, monkeypatch, committed):
    inputs, root = small_inputs(scratch)
    month_file(inputs, "2020-01-01.csv", "1,10,A,x,t,Bondi,$5.00,t,3", "x1,10,A,x,t,Bondi,$5,t,3")
    refresh.run(spark, inputs, f"{root}/out", mode="append", until="raw")
    month_file(inputs, "2020-02-01.csv", "2,11,B,x,f,Bondi,$6.00,t,3", "x2,10,A,x,t,Bondi,$5,t,3", "x3,10,A,x,t,Bondi,$5,t,3")
    parallel = refresh._parallel

    def stops(spark, jobs, workers=4):
        parallel(spark, {committed: jobs[committed]}, workers)
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(refresh, "_parallel", stops)
        with pytest.raises(OSError):
            refresh.run(spark, inputs, f"{root}/out", mode="append")
    for _ in range(2):
        out = refresh.run(spark, inputs, f"{root}/out", mode="append", until="raw")
        assert rows_in(spark, out, "raw_listings", "id") == [(1,), (2,)]
        assert [(r[0].rpartition("/")[2], *r[1:]) for r in rows_in(spark, out, "raw_rejects", "filename", "reason", "n_rows")] == [
            ("2020-01-01.csv", "id", 1), ("2020-02-01.csv", "id", 2)]


def test_raw_rows_from_before_there_was_a_marker_count_as_loaded(spark, scratch, monkeypatch):
    inputs, root = small_inputs(scratch)
    month_file(inputs, "2020-01-01.csv", "1,10,A,x,t,Bondi,$5.00,t,3")
    with monkeypatch.context() as m:
        m.setattr(refresh, "start_marker", lambda *a: None)
        m.setattr(refresh, "mark_loaded", lambda *a: None)
        out = refresh.run(spark, inputs, f"{root}/out", mode="append", until="raw")
    assert not os.path.exists(out["loaded"])
    month_file(inputs, "2020-02-01.csv", "2,11,B,x,f,Bondi,$6.00,t,3")
    out = refresh.run(spark, inputs, f"{root}/out", mode="append")
    assert rows_in(spark, out, "raw_listings", "id") == rows_in(spark, out, "fact", "id") == [(1,), (2,)]


def test_rows_that_cannot_be_keyed_are_counted(spark, scratch):
    inputs, root = small_inputs(scratch)
    month_file(inputs, "2020-01-01.csv", "1,10,A,x,t,Bondi,$5.00,t,3", "x1,10,A,x,t,Bondi,$5,t,3", "x2,10,A,x,t,Bondi,$5,t,3", "4,?,A,x,t,Bondi,$5,t,3")
    month_file(inputs, "listings0.csv", "5,10,A,x,t,Bondi,$5.00,t,3", "6,10,A,x,t,Bondi,$5.00,t,3")
    out = refresh.run(spark, inputs, f"{root}/out")
    assert rows_in(spark, out, "raw_listings", "id") == [(1,)]
    assert [(r[0].rpartition("/")[2], *r[1:]) for r in rows_in(spark, out, "raw_rejects", "filename", "reason", "n_rows")] == [
        ("2020-01-01.csv", "host_id", 1), ("2020-01-01.csv", "id", 2), ("listings0.csv", "snapshot date", 2)]


def test_recompute_holds_what_the_given_files_hold(spark, scratch):
    inputs, root = small_inputs(scratch)
    month_file(inputs, "2020-01-01.csv", "1,10,A,x,t,Bondi,$5.00,t,3")
    refresh.run(spark, inputs, f"{root}/out")
    os.rename(f"{inputs['listings']}/2020-01-01.csv", f"{root}/old.csv")
    month_file(inputs, "2020-02-01.csv", "2,11,B,x,t,Bondi,$5.00,t,3")
    out = refresh.run(spark, inputs, f"{root}/out")
    assert rows_in(spark, out, "raw_listings", "id") == rows_in(spark, out, "fact", "id") == [(2,)]


def test_owner_attributes_are_those_of_the_first_snapshot(spark, scratch):
    inputs, root = small_inputs(scratch)
    month_file(inputs, "2020-01-01.csv", "7,10,Zoe,Bondi,t,Bondi,$5.00,t,3", "8,10,Amy,x,f,Bondi,$5.00,t,3")
    month_file(inputs, "2020-02-01.csv", "1,10,Amy,x,f,Bondi,$5.00,t,3")
    month_file(inputs, "2020-03-01.csv", "1,10,,x,,Bondi,$5.00,t,3")
    out = refresh.run(spark, inputs, f"{root}/out")
    assert rows_in(spark, out, "owners", "host_name", "host_is_superhost", "lga_code", "host_tot_list_new") == [("Zoe", "t", "L1", 3)]


def test_owner_plan_joins_the_lookup_to_one_row_a_host(spark):
    from staykit.plans.star import owner_rows
    from staykit.schemas import LOCATION_SCHEMA, RAW_LISTING_SCHEMA

    plan = owner_rows(spark.createDataFrame([], RAW_LISTING_SCHEMA), spark.createDataFrame([], LOCATION_SCHEMA))._jdf.queryExecution().analyzed().toString()
    assert plan.index("Join LeftOuter") < plan.index("Aggregate [host_id")  # the join stands above the aggregate


def names_of(rows):
    return [(r[0].rpartition("/")[2], *r[1:]) for r in rows]


def test_a_file_delivered_again_adds_its_new_keys(spark, scratch):
    inputs, root = small_inputs(scratch)
    month_file(inputs, "2020-01-01.csv", "1,10,A,x,t,Bondi,$5.00,t,3", "2,10,A,x,t,Bondi,$6.00,t,3", "bad,1,A,x,t,Bondi,$6.00,t,3")
    month_file(inputs, "2020-02-01.csv", "1,10,A,x,t,Bondi,$5.00,t,3")
    refresh.run(spark, inputs, f"{root}/out", mode="append")
    # January grows by a listing with a new host, loses one and repeats one with another price; one more bad row
    month_file(inputs, "2020-01-01.csv", "1,10,A,x,t,Bondi,$9.00,t,3", "3,11,B,x,t,Bondi,$7.00,t,3", "bad,1,A,x,t,Bondi,$6.00,t,3", "x,1,,,,,,,")
    out = refresh.run(spark, inputs, f"{root}/out", mode="append")
    assert names_of(rows_in(spark, out, "raw_listings", "filename", "id", "price")) == [
        ("2020-01-01.csv", 1, "$5.00"), ("2020-01-01.csv", 2, "$6.00"), ("2020-01-01.csv", 3, "$7.00"), ("2020-02-01.csv", 1, "$5.00")]
    assert rows_in(spark, out, "fact", "id", "month") == [(1, 1), (1, 2), (2, 1), (3, 1)]
    assert rows_in(spark, out, "owners", "host_id") == [(10,), (11,)]
    told = names_of(rows_in(spark, out, "raw_changes", "filename", "load", "n_before", "n_now", "n_added", "n_gone"))
    assert told == [("2020-01-01.csv", 2, 2, 2, 1, 1)]
    rejects = spark.read.parquet(out["raw_rejects"]).groupBy("filename", "reason").agg(F.sum("n_rows")).collect()
    assert names_of(rejects) == [("2020-01-01.csv", "id", 2)]
    # nothing has changed since: nothing is read or told again
    again = refresh.run(spark, inputs, f"{root}/out", mode="append")
    assert names_of(rows_in(spark, again, "raw_changes", "filename", "load", "n_before", "n_now", "n_added", "n_gone")) == told
    assert [(r[0], *r[2:]) for r in rows_in(spark, again, "loaded", "load", "filename", "n_rows", "n_rejects")] == [(1, 2, 1), (1, 1, 0), (2, 2, 2)]


def test_a_shrunk_file_is_reported_and_its_rows_stay(spark, scratch):
    inputs, root = small_inputs(scratch)
    month_file(inputs, "2020-01-01.csv", "1,10,A,x,t,Bondi,$5.00,t,3", "2,10,A,x,t,Bondi,$6.00,t,3")
    refresh.run(spark, inputs, f"{root}/out", mode="append", until="raw")
    month_file(inputs, "2020-01-01.csv")
    out = refresh.run(spark, inputs, f"{root}/out", mode="append", until="raw")
    assert rows_in(spark, out, "raw_listings", "id") == [(1,), (2,)]
    assert names_of(rows_in(spark, out, "raw_changes", "filename", "n_before", "n_now", "n_added", "n_gone")) == [("2020-01-01.csv", 2, 0, 0, 2)]


def test_a_changed_file_whose_load_stopped_is_told_once(spark, scratch, monkeypatch):
    inputs, root = small_inputs(scratch)
    month_file(inputs, "2020-01-01.csv", "1,10,A,x,t,Bondi,$5.00,t,3")
    refresh.run(spark, inputs, f"{root}/out", mode="append", until="raw")
    month_file(inputs, "2020-01-01.csv", "1,10,A,x,t,Bondi,$5.00,t,3", "2,10,A,x,t,Bondi,$6.00,t,3")

    def lost(*a):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(refresh, "mark_loaded", lost)
        with pytest.raises(OSError):
            refresh.run(spark, inputs, f"{root}/out", mode="append", until="raw")
    out = refresh.run(spark, inputs, f"{root}/out", mode="append", until="raw")
    assert rows_in(spark, out, "raw_listings", "id") == [(1,), (2,)]
    assert names_of(rows_in(spark, out, "raw_changes", "filename", "load", "n_before", "n_now", "n_added", "n_gone")) == [("2020-01-01.csv", 2, 1, 2, 1, 0)]


def test_every_csv_is_read_once(spark, scratch, monkeypatch):
    """The staged table is the only reader of the listing files; later jobs read that."""
    from staykit.plans import ledger
    from staykit.sources import snapshots

    inputs, root = small_inputs(scratch)
    month_file(inputs, "2020-01-01.csv", "1,10,A,x,t,Bondi,$5.00,t,3", "bad,1,A,x,t,Bondi,$6.00,t,3")
    load = ledger.stage(spark, snapshots.file_infos(spark, inputs["listings"]), f"{root}/raw")
    month_file(inputs, "2020-01-01.csv")  # whoever reads the file again finds no rows
    for job in ledger.raw_jobs(spark, load, f"{root}/raw").values():
        job()
    ledger.mark_loaded(spark, load, f"{root}/raw")
    assert [r.id for r in refresh.read_table(spark, f"{root}/raw").collect()] == [1]
    assert [r.n_rows for r in refresh.read_table(spark, f"{root}/raw.rejects").collect()] == [1]
    assert [(r.n_rows, r.n_rejects) for r in ledger.ledger(spark, f"{root}/raw").collect()] == [(1, 1)]
    assert not os.path.exists(load.path.replace("file:", "", 1))


def test_unknown_columns_are_named_or_raise(spark, scratch):
    inputs, root = small_inputs(scratch)
    month_file(inputs, "2020-01-01.csv", "1,10,A,x,t,Bondi,$5.00,t,3")
    with open(f"{inputs['listings']}/2020-02-01.csv", "w") as f:
        f.write("ID,host_id,summary,Pets,colour\n2,10,s,1,red\n")
    with pytest.raises(ValueError, match="2020-02-01.csv: Pets, colour"):
        refresh.run(spark, inputs, f"{root}/out", mode="append", strict_columns=True)
    assert refresh.current(spark, f"{root}/out/raw/listings") is None
    out = refresh.run(spark, inputs, f"{root}/out", mode="append", until="raw")
    told = {r.filename.rpartition("/")[2]: r for r in spark.read.parquet(out["loaded"]).collect() if r.load}
    assert (told["2020-01-01.csv"].unknown, told["2020-01-01.csv"].retired) == ([], [])
    assert (told["2020-02-01.csv"].unknown, told["2020-02-01.csv"].retired) == (["Pets", "colour"], ["summary"])
    assert "price" in told["2020-02-01.csv"].absent and "id" not in told["2020-02-01.csv"].absent


def test_a_recompute_that_stops_anywhere_leaves_whole_tables(spark, scratch, monkeypatch):
    """Each table is the old or the new one, and the next run completes what was left."""
    inputs, root = small_inputs(scratch)
    month_file(inputs, "2020-01-01.csv", "1,10,A,x,t,Bondi,$5.00,t,3")
    refresh.run(spark, inputs, f"{root}/out")
    os.rename(f"{inputs['listings']}/2020-01-01.csv", f"{root}/old.csv")
    month_file(inputs, "2020-02-01.csv", "2,11,B,x,t,Bondi,$5.00,t,3")
    replace, calls = refresh.replace_table, []

    def stops(df, path, *a):
        calls.append(path)
        if path.endswith("star/owners"):
            raise OSError("lost")
        return replace(df, path, *a)

    with monkeypatch.context() as m:
        m.setattr(refresh, "replace_table", stops)
        with pytest.raises(OSError):
            refresh.run(spark, inputs, f"{root}/out")
    ids = {n: [r[0] for r in refresh.read_table(spark, f"{root}/out/{p}").select(c).collect()]
           for n, p, c in (("raw", "raw/listings", "id"), ("owners", "star/owners", "host_id"), ("kpi", "kpi/host_region_month", "month"))}
    assert ids == {"raw": [2], "owners": [10], "kpi": [1]}
    out = refresh.run(spark, inputs, f"{root}/out")
    assert rows_in(spark, out, "owners", "host_id") == [(11,)] and rows_in(spark, out, "kpi_host_region_month", "month") == [(2,)]


def test_enforced_constraints_hold_rows_until_their_parent_comes(spark, scratch):
    root = scratch("refresh")
    rows = fx.listing_rows(spark, SF)
    g01, g02 = fx.census_g01(spark, SF), fx.census_g02(spark, SF)
    inputs = {"location": f"{root}/in/location", "g01": f"{root}/in/g01", "g02": f"{root}/in/g02"}
    export_table_csv(fx.locality_lookup(spark, SF), inputs["location"])
    export_table_csv(g02, inputs["g02"])
    early = F.col("calendar_last_scraped") < "1996-01-01"
    for n, part, census in ((1, early, g01.filter("length(LGA_CODE_2016) = 4")), (2, ~early, g01)):
        export_table_csv(census, inputs["g01"])
        export_snapshots(rows.filter(part), f"{root}/in/{n}")
        out = refresh.run(spark, dict(inputs, listings=f"{root}/in/{n}"), f"{root}/out", mode="append", enforce=True)
        if n == 1:
            held = spark.read.parquet(out["held_fact"])
            first = held.filter("length(lga_code) = 5").select("id", "year", "month").collect()
            assert first and {tuple(r.broken) for r in held.collect()} == {("fact_census_fk",)}
    fact, held = spark.read.parquet(out["fact"]), spark.read.parquet(out["held_fact"])
    known = {r.LGA_CODE_2016 for r in spark.read.parquet(out["census"]).collect()}
    assert {r.lga_code for r in fact.select("lga_code").distinct().collect()} <= known | {None}
    assert not known & {r.lga_code for r in held.collect()} and held.count() > 0
    moved = {r.id for r in rows.groupBy("id").agg(F.countDistinct(F.coalesce("neighbourhood_cleansed", F.lit("NaN"))).alias("n"))
             .filter("n > 1").collect()}
    keys = {(r.id, r.year, r.month) for r in fact.collect()}
    areas = {(r.id, r.year, r.month): r for r in held.collect()}
    assert all(tuple(r) in keys or tuple(r) in areas or r.id in moved for r in first) and any(tuple(r) in keys for r in first)
    assert spark.read.parquet(out["audit_fact_census_fk"]).count() == 0
