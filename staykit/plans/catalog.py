"""Every registered query: ``(spark, sf_dir) -> DataFrame``.

Each query reads the driver tables (through the fixture mapping in
:mod:`staykit.sources.fixture`) in full, runs one operator or job of the
refresh, and aliases every output column to the name its DuckDB oracle in
``duck_oracle.py`` uses.  Queries that exercise file formats first
write the derived data to a fresh folder under the shared checkpoint root.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import (host_city, is_true_flag, not_missing, parse_money, price_mixed_format,
                               snapshot_date, snapshot_month, snapshot_year)
from ..operators.constraints import BROKEN, broken_rules, foreign_key, not_null, repeated_rows
from ..operators.keys import (audit_duplicate_key, audit_foreign_key, audit_null_key, first_per_key,
                              insert_if_absent, key_report)
from ..operators.kpi import TIME_KEYS, group_kpis, host_region_kpis, mom_change, superhost_rate
from ..operators.listings import exclude_moved, lookup_region, moved_ids
from ..operators.median import exact_median
from ..schemas import (FACT_KEY, G01_SCHEMA, G02_SCHEMA, LOCATION_KEY, LOCATION_SCHEMA, RAW_LISTING_SCHEMA,
                       REGION_KEYS, SEGMENT_KEYS)
from ..session import scratch_path
from ..sources import fixture as fx
from ..sources.export import (census_wide, export_census_wide, export_snapshots, export_table_csv, lineage_columns,
                              redeliver)
from ..sources.inferred import read_inferred_csv
from ..sources.snapshots import file_infos, read_lookup_csv, read_snapshots, typed_projection
from . import refresh
from .layers import materialized, written_once
from .ledger import mark_loaded, raw_jobs, report_changes, stage, start_marker, unseen_files
from .quarantine import held_rows, load_checked
from .star import age_band_totals, build_census, build_fact, build_owners, fill_missing_region, \
    host_listing_count, load_raw, owner_rows
from .tables import append_table, read_table, replace_table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
REGION_MONTH = list(REGION_KEYS) + list(TIME_KEYS)
SEGMENT_MONTH = list(SEGMENT_KEYS) + list(TIME_KEYS)


# Registry keys whose function name carries a suffix (to keep the operator's
# own name free for the import).
_KEY_OF = {
    "typed_projection_roundtrip": "typed_projection",
    "first_per_key_lineitem": "first_per_key",
    "insert_if_absent_snapshots": "insert_if_absent",
    "fill_missing_region_owners": "fill_missing_region",
    "audit_null_key_region": "audit_null_key",
    "audit_duplicate_key_raw": "audit_duplicate_key",
    "audit_foreign_key_census": "audit_foreign_key",
    "price_mixed_format_rows": "price_mixed_format",
    "parse_money_lineitem": "parse_money",
    "snapshot_date_orders": "snapshot_date",
    "host_city_suppliers": "host_city",
    "host_listing_count_kept": "host_listing_count",
    "exclude_moved_raw": "exclude_moved",
    "superhost_rate_region": "superhost_rate",
    "repeated_rows_raw": "repeated_rows",
}


def query(fn: Query) -> Query:
    REGISTRY[_KEY_OF.get(fn.__name__, fn.__name__)] = fn
    return fn


# --------------------------------------------------------------------------- inputs
# Upstream layers are written once per application and read back (see layers).
def _rows(spark, d):
    return materialized(spark, d, "rows", lambda: fx.listing_rows(spark, d))


def _lines(spark, d):
    """What the snapshot files are written from: the same rows in fewer bytes."""
    return materialized(spark, d, "lines", lambda: fx.joined_lines(spark, d))


def _export(spark, d, lines, path, compression="gzip"):
    return export_snapshots(lines.withColumn("filename", fx.file_name()), path, compression,
                            finish=lambda placed: fx.listing_columns(spark, d, placed).drop("filename"))


def _raw(spark, d):
    return materialized(spark, d, "raw", lambda: load_raw(_rows(spark, d)))


def _location(spark, d):
    return materialized(spark, d, "location", lambda: fx.locality_lookup(spark, d))


def _star_inputs(spark, d):
    raw, loc = _raw(spark, d), _location(spark, d)
    return raw, loc, materialized(spark, d, "moved", lambda: moved_ids(raw))


def _fact(spark, d):
    return materialized(spark, d, "fact", lambda: build_fact(*_star_inputs(spark, d)))


def _star(spark, d):
    fact = _fact(spark, d)
    owners = materialized(spark, d, "owners", lambda: build_owners(*_star_inputs(spark, d)))
    return fact, owners


def _census_parts(spark, d):
    return (materialized(spark, d, "g01", lambda: fx.census_g01(spark, d)),
            materialized(spark, d, "g02", lambda: fx.census_g02(spark, d)))


def _snapshot_files(spark, d, compression="gzip"):
    name = f"snapshots-{compression or 'plain'}"
    return written_once(spark, d, name, lambda p: _export(spark, d, _lines(spark, d), p, compression))


def _csv_rows(spark, d, compression="gzip"):
    return read_snapshots(spark, _snapshot_files(spark, d, compression))


# --------------------------------------------------------------------------- sources
@query
def csv_snapshot_scan(spark, d):
    """The one scan of plain files; every other query reads compressed ones, which take a sixth of the space."""
    return lineage_columns(_csv_rows(spark, d, compression=None))


@query
def csv_gzip_scan(spark, d):
    return lineage_columns(_csv_rows(spark, d, compression="gzip"))


@query
def schema_drift_union(spark, d):
    rows = lineage_columns(_csv_rows(spark, d))
    return rows.groupBy("folder", "snapshot_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("beds").alias("n_beds"),
        F.count("review_scores_rating").alias("n_rated"), F.count("description").alias("n_described"),
        F.count("price").alias("n_priced"))


@query
def file_lineage(spark, d):
    rows = _csv_rows(spark, d)
    keyed = rows.select("filename", "id").withColumn("snapshot_date", snapshot_date("filename")) \
        .withColumn("folder", F.regexp_extract("filename", r"src=([^/]+)/", 1))
    return keyed.groupBy("folder", "snapshot_date").agg(
        F.countDistinct("filename").alias("n_files"), F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("id").alias("n_ids"))


@query
def csv_lookup_scan(spark, d):
    path = written_once(spark, d, "location-csv", lambda p: export_table_csv(_location(spark, d), p))
    return read_lookup_csv(spark, path, LOCATION_SCHEMA)


@query
def csv_census_scan(spark, d):
    path = written_once(spark, d, "g01-csv", lambda p: export_table_csv(_census_parts(spark, d)[0], p))
    return read_lookup_csv(spark, path, G01_SCHEMA)


@query
def csv_census_g02_scan(spark, d):
    path = written_once(spark, d, "g02-csv", lambda p: export_table_csv(_census_parts(spark, d)[1], p))
    return read_lookup_csv(spark, path, G02_SCHEMA)


@query
def csv_census_inferred(spark, d):
    """The first census table at its full width, types found from the data."""
    path = written_once(spark, d, "g01-wide-csv", lambda p: export_census_wide(census_wide(spark, d), p))
    return read_inferred_csv(spark, path, G01_SCHEMA)


@query
def load_snapshots(spark, d):
    """The load itself: files parsed once into a staged table, then one row a key."""
    files = file_infos(spark, _snapshot_files(spark, d))
    raw_path = scratch_path(spark, "raw-load")
    load = stage(spark, files, raw_path)
    return lineage_columns(load_raw(load.rows(spark)))


@query
def load_lookup(spark, d):
    path = written_once(spark, d, "location-csv", lambda p: export_table_csv(_location(spark, d), p))
    return first_per_key(read_lookup_csv(spark, path, LOCATION_SCHEMA), LOCATION_KEY)


@query
def load_census(spark, d):
    g01, g02 = _census_parts(spark, d)
    p1 = written_once(spark, d, "g01-csv", lambda p: export_table_csv(g01, p))
    p2 = written_once(spark, d, "g02-csv", lambda p: export_table_csv(g02, p))
    raw_dir = scratch_path(spark, "raw-census")
    replace_table(read_lookup_csv(spark, p1, G01_SCHEMA), f"{raw_dir}/g01")
    replace_table(read_lookup_csv(spark, p2, G02_SCHEMA), f"{raw_dir}/g02")
    return build_census(read_table(spark, f"{raw_dir}/g01"), read_table(spark, f"{raw_dir}/g02"))


# --------------------------------------------------------------------------- sinks / keys
@query
def typed_projection_roundtrip(spark, d):
    rows = _rows(spark, d)
    as_text = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    return typed_projection(as_text, RAW_LISTING_SCHEMA)


@query
def first_per_key_lineitem(spark, d):
    li = fx.read_table(spark, d, "lineitem")
    li = li.withColumn("year", F.year("l_shipdate").cast("int")).withColumn(
        "month", F.month("l_shipdate").cast("int"))
    return first_per_key(li, ["l_partkey", "year", "month"], order=["l_shipdate", "l_orderkey"])


@query
def insert_if_absent_snapshots(spark, d):
    rows = _rows(spark, d)
    early = rows.filter(F.year(F.to_date("calendar_last_scraped")) <= 1998)
    existing = load_raw(early).withColumn("name", F.concat(F.lit("old "), F.col("name")))
    merged = insert_if_absent(rows, existing, ["id", "filename"], split=True)
    return merged.select("id", "filename", "name", "host_id", "price")


@query
def overwrite_roundtrip(spark, d):
    g01, g02 = _census_parts(spark, d)
    census = build_census(g01, g02)
    path = scratch_path(spark, "census")
    replace_table(census, path)
    replace_table(read_table(spark, path), path)
    return read_table(spark, path)


@query
def fill_missing_region_owners(spark, d):
    raw, loc = _raw(spark, d), _location(spark, d)
    moved = materialized(spark, d, "moved", lambda: moved_ids(raw))
    return fill_missing_region(owner_rows(raw, loc, moved)).select("host_id", "lga_code")


@query
def audit_null_key_region(spark, d):
    return audit_null_key(_fact(spark, d), REGION_MONTH).select("id", "year", "month")


@query
def audit_duplicate_key_raw(spark, d):
    return audit_duplicate_key(_rows(spark, d), ["id", "filename"])


@query
def audit_foreign_key_census(spark, d):
    census = build_census(*_census_parts(spark, d))
    return audit_foreign_key(_fact(spark, d), census, "lga_code", "LGA_CODE_2016")


@query
def audit_owners_key(spark, d):
    return key_report(_star(spark, d)[1], ["host_id"])


@query
def audit_census_key(spark, d):
    return key_report(build_census(*_census_parts(spark, d)), ["LGA_CODE_2016"])


@query
def audit_kpi_key(spark, d):
    fact, owners = _star(spark, d)
    return key_report(group_kpis(fact, owners, REGION_KEYS), REGION_MONTH)


def _fact_rules(owners: DataFrame, census: DataFrame) -> list:
    """The fact's constraints, when every seventh owner is yet to come."""
    return [not_null("fact_null_key", FACT_KEY), not_null("fact_null_region", ["lga_code"]),
            foreign_key("fact_census_fk", "lga_code", census, "LGA_CODE_2016"),
            foreign_key("fact_owner_fk", "host_id", owners.filter("host_id % 7 <> 0"), "host_id")]


@query
def constraint_rows(spark, d):
    """Each fact row once for each constraint that it breaks."""
    fact, owners = _star(spark, d)
    judged = broken_rules(fact, _fact_rules(owners, build_census(*_census_parts(spark, d))))
    return judged.select("id", "year", "month", "host_id", "lga_code", F.explode(BROKEN).alias("rule"))


@query
def quarantine_release(spark, d):
    """The fact after two checked loads, held rows with the rules they break.  The first load meets a part of the
    census; its held rows are judged again by the second, which brings the other months and the whole census."""
    fact, owners = _star(spark, d)
    census = build_census(*_census_parts(spark, d))
    root = scratch_path(spark, "checked")
    table, held_path = f"{root}/fact", f"{root}/held"
    for late, areas in ((False, census.filter("length(LGA_CODE_2016) = 4")), (True, census)):
        new = fact.filter(F.col("month") > 6 if late else F.col("month") <= 6)
        load_checked(spark, new, held_rows(spark, held_path), held_path, _fact_rules(owners, areas), FACT_KEY,
                     lambda rows: append_table(rows, table))
    kept = read_table(spark, table).withColumn(BROKEN, F.array().cast("array<string>"))
    return kept.unionByName(read_table(spark, held_path)).select(
        "id", "year", "month", "host_id", "lga_code", F.array_join(BROKEN, ",").alias("broken"))


@query
def repeated_rows_raw(spark, d):
    """Snapshot rows that the raw load leaves out as repetitions of their key."""
    return repeated_rows(_rows(spark, d), ["id", "filename"]).select("id", "filename", "host_id", "name", "price", "copies")


@query
def load_rejects(spark, d):
    """Rows whose id or host id is no number, or whose file has no date, counted by file and reason."""
    from ..operators.quality import split_rejects

    rows = _rows(spark, d)
    text = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    bad = F.col("beds")
    text = text.withColumns({"id": F.when(bad.isin("6", "7"), F.concat(F.lit("x"), "id")).otherwise(F.col("id")),
                             "host_id": F.when(bad == "4", F.lit("1E+x")).otherwise(F.col("host_id")),
                             "filename": F.when(bad == "5", F.lit("in/undated.csv")).otherwise(F.col("filename"))})
    return split_rejects(typed_projection(text, RAW_LISTING_SCHEMA))[1]


# --------------------------------------------------------------------------- filters / scalars
@query
def active_filter(spark, d):
    f = _fact(spark, d).filter(is_true_flag("has_availability"))
    return f.select("id", "year", "month", "lga_code", F.col("price").cast("double").alias("price"))


@query
def avg_rating_not_missing(spark, d):
    f = _fact(spark, d).filter(is_true_flag("has_availability") & not_missing("review_scores_rating"))
    r = F.col("review_scores_rating").cast("decimal(18,6)")
    return f.groupBy(*REGION_MONTH).agg(
        F.try_divide(F.sum(r).cast("double"), F.count(r).cast("double")).alias("Average_of_review_scores_rating"))


@query
def price_mixed_format_rows(spark, d):
    rows = _rows(spark, d)
    return rows.select("id", "filename", F.col("price").alias("price_text"),
                       price_mixed_format("price").cast("double").alias("price"))


@query
def parse_money_lineitem(spark, d):
    li = fx.read_table(spark, d, "lineitem")
    text = F.concat(F.lit("$"), F.format_number("l_extendedprice", 2))
    return li.select("l_orderkey", "l_linenumber", text.alias("price_text"),
                     parse_money(text).cast("double").alias("price"))


@query
def snapshot_date_orders(spark, d):
    o = fx.read_table(spark, d, "orders")
    path = F.concat(F.lit("in/snap/"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".csv"))
    return o.select("o_orderkey", path.alias("filename"), snapshot_date(path).alias("snapshot_date"),
                    snapshot_year(path).alias("year"), snapshot_month(path).alias("month"))


@query
def host_city_suppliers(spark, d):
    s = fx.read_table(spark, d, "supplier")
    n = fx.read_table(spark, d, "nation")
    loc = F.concat(F.lit(" "), F.lower("n_name"), F.lit(" , X, Y"))
    return (s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey").alias("host_id"), loc.alias("host_location"),
                    host_city(loc).alias("host_loc_cleaned")))


@query
def age_bands(spark, d):
    g01, _ = _census_parts(spark, d)
    return age_band_totals(g01).select("LGA_CODE_2016", "Tot_P_un55", "Tot_p_up55")


# --------------------------------------------------------------------------- joins
@query
def census_join(spark, d):
    g01, g02 = _census_parts(spark, d)
    return g01.join(g02, "LGA_CODE_2016", "inner").select(
        "LGA_CODE_2016", "Tot_P_P", "Median_age_persons", "Median_mortgage_repay_monthly",
        "Average_household_size")


@query
def lookup_upper(spark, d):
    raw = _raw(spark, d)
    out = lookup_region(raw, "neighbourhood_cleansed", _location(spark, d), trim=False)
    return out.select("id", "filename", "neighbourhood_cleansed", "lga_code")


@query
def lookup_trim_upper(spark, d):
    raw = _raw(spark, d)
    name = F.split_part(F.col("host_location"), F.lit(","), F.lit(1))
    out = lookup_region(raw, name, _location(spark, d), trim=True)
    return out.select("id", "filename", "host_id", "lga_code")


@query
def host_listing_count_kept(spark, d):
    return host_listing_count(exclude_moved(_raw(spark, d)))


@query
def exclude_moved_raw(spark, d):
    return exclude_moved(_raw(spark, d)).select("id", "filename", "host_id", "neighbourhood_cleansed")


@query
def full_outer_change(spark, d):
    f = _fact(spark, d)
    t = is_true_flag("has_availability")
    g = f.groupBy(*REGION_MONTH).agg(F.count(F.when(t, F.col("id"))).alias("na"),
                                     F.count(F.when(F.col("has_availability") == "f", F.col("id"))).alias("ni"))
    g = mom_change(g, REGION_KEYS, "na", "change_for_active_listings")
    g = mom_change(g, REGION_KEYS, "ni", "change_for_inactive_listings")
    keep = ((F.col("na") > 0) | (F.col("ni") > 0)) & F.col("lga_code").isNotNull()
    return g.filter(keep).select(*REGION_MONTH, "change_for_active_listings", "change_for_inactive_listings")


@query
def superhost_count(spark, d):
    fact, owners = _star(spark, d)
    sup = owners.filter(is_true_flag("host_is_superhost")).select("host_id")
    return (fact.join(sup, "host_id").groupBy(*REGION_MONTH)
            .agg(F.countDistinct("host_id").alias("superhosts")))


@query
def superhost_rate_region(spark, d):
    fact, owners = _star(spark, d)
    return superhost_rate(fact, owners, REGION_KEYS)


# --------------------------------------------------------------------------- aggregates
@query
def active_rate(spark, d):
    f = _fact(spark, d)
    na = F.count(F.when(is_true_flag("has_availability"), F.col("id")))
    return f.groupBy(*REGION_MONTH).agg(
        (F.try_divide(na.cast("double"), F.count("id").cast("double")) * 100).alias("Active_listings_rate"))


@query
def distinct_hosts(spark, d):
    return _fact(spark, d).groupBy(*REGION_MONTH).agg(F.countDistinct("host_id").alias("distinct_hosts"))


@query
def price_stats(spark, d):
    f = _fact(spark, d).filter(is_true_flag("has_availability"))
    return f.groupBy(*REGION_MONTH).agg(
        F.min("price").cast("double").alias("min_price"), F.max("price").cast("double").alias("max_price"),
        F.try_divide(F.sum("price").cast("double"), F.count("price").cast("double")).alias("ave_price"))


@query
def price_median(spark, d):
    f = _fact(spark, d).filter(is_true_flag("has_availability"))
    m = exact_median(f, REGION_MONTH, "price", "median_price")
    return m.select(*REGION_MONTH, F.col("median_price").cast("double").alias("median_price"))


@query
def stays_and_revenue(spark, d):
    f = _fact(spark, d).filter(is_true_flag("has_availability"))
    stays = F.lit(30) - F.col("availability_30")
    return f.groupBy(*REGION_MONTH).agg(
        F.sum(stays).alias("Number_of_stays_sum"),
        F.try_divide(F.sum(stays).cast("double"), F.count(stays).cast("double")).alias("Number_of_stays_avg"),
        F.sum(stays * F.col("price")).cast("double").alias("Estimated_revenue"))


def _mom(f: DataFrame, keys) -> DataFrame:
    g = (f.filter(is_true_flag("has_availability")).groupBy(*keys, *TIME_KEYS)
         .agg(F.count("id").alias("active_listings")))
    return mom_change(g, keys, "active_listings", "change_pct", previous="prev_active_listings", absolute="change_abs")


@query
def mom_change_region(spark, d):
    return _mom(_fact(spark, d), REGION_KEYS)


@query
def mom_change_segment(spark, d):
    f = _fact(spark, d).fillna("NaN", subset=["property_type", "room_type"])
    return _mom(f, SEGMENT_KEYS)


# --------------------------------------------------------------------------- composite jobs
@query
def star_fact(spark, d):
    """The fact build itself, from the raw layer (moved set included)."""
    f = build_fact(_raw(spark, d), _location(spark, d))
    return f.withColumn("price", F.col("price").cast("double"))


@query
def star_owner(spark, d):
    """The owner build itself, from the raw layer (moved set included)."""
    return build_owners(_raw(spark, d), _location(spark, d))


@query
def star_census(spark, d):
    return build_census(*_census_parts(spark, d))


@query
def kpi_region_month(spark, d):
    fact, owners = _star(spark, d)
    return group_kpis(fact, owners, REGION_KEYS)


@query
def kpi_segment_month(spark, d):
    fact, owners = _star(spark, d)
    return group_kpis(fact, owners, SEGMENT_KEYS, string_keys=("property_type", "room_type"))


@query
def kpi_host_region_month(spark, d):
    fact, owners = _star(spark, d)
    return host_region_kpis(fact, owners)


def _lookup_files(spark, d) -> dict:
    return {
        "location": written_once(spark, d, "location-csv", lambda p: export_table_csv(_location(spark, d), p)),
        "g01": written_once(spark, d, "g01-csv", lambda p: export_table_csv(_census_parts(spark, d)[0], p)),
        "g02": written_once(spark, d, "g02-csv", lambda p: export_table_csv(_census_parts(spark, d)[1], p)),
    }


def _job_inputs(spark, d) -> dict:
    return {"listings": _snapshot_files(spark, d), **_lookup_files(spark, d)}


@query
def end_to_end_region_kpi(spark, d):
    """Every stage from the CSV files to the region KPI table (written, read back)."""
    out = refresh.run(spark, _job_inputs(spark, d), scratch_path(spark, "refresh"))
    return spark.read.parquet(out["kpi_region_month"])


def _refreshed(spark, d) -> str:
    return written_once(spark, d, "refresh", lambda p: refresh.run(spark, _job_inputs(spark, d), p))


@query
def pipeline_segment_kpi(spark, d):
    return read_table(spark, f"{_refreshed(spark, d)}/kpi/segment_month")


@query
def pipeline_host_kpi(spark, d):
    return read_table(spark, f"{_refreshed(spark, d)}/kpi/host_region_month")


@query
def pipeline_append(spark, d):
    """Facts after four appends of files.  The second stops after the raw layer and is made good by the
    third, whose files hold half of the listings; the fourth is given the same files, grown to all of them."""
    lines, year = _lines(spark, d), F.year(fx.line_column("shipped"))
    root = scratch_path(spark, "append")
    inputs = _lookup_files(spark, d)
    for part, cond, until in (("a", year < 1996, None), ("b", year == 1996, "raw"), ("c", (year > 1996) & (F.col("l_orderkey") % 2 == 0), None),
                              ("c", year > 1996, None)):
        redeliver(spark, _export(spark, d, lines.filter(cond), scratch_path(spark, "delivery")), f"{root}/in/{part}")
        out = refresh.run(spark, dict(inputs, listings=f"{root}/in/{part}"), f"{root}/out", mode="append", until=until)
    return spark.read.parquet(out["fact"]).select("id", "year", "month", "host_id", "lga_code",
                                                  F.col("price").cast("double").alias("price"))


@query
def changed_files(spark, d):
    """What a second delivery of every file changed: one third of the listings is new, one third gone."""
    lines = _lines(spark, d)
    root = scratch_path(spark, "changed")
    raw_path = f"{root}/raw"
    start_marker(spark, raw_path)
    for other in (0, 1):
        redeliver(spark, _export(spark, d, lines.filter(F.col("l_orderkey") % 3 != other), scratch_path(spark, "delivery")), f"{root}/in")
        load = stage(spark, unseen_files(spark, file_infos(spark, f"{root}/in"), raw_path), raw_path)
        report_changes(spark, load, raw_path)
        for job in raw_jobs(spark, load, raw_path).values():
            job()
        mark_loaded(spark, load, raw_path)
    return lineage_columns(read_table(spark, f"{raw_path}.changes")).drop("load")


@query
def header_drift(spark, d):
    """How the header of each file differs from the landing table."""
    from ..sources import snapshots

    files = snapshots.list_files(spark, _snapshot_files(spark, d))
    drift = snapshots.header_drift(spark, snapshots.group_by_header(spark, files))
    return lineage_columns(drift).withColumns({c: F.array_join(c, ",") for c in ("retired", "absent", "unknown")})


@query
def incremental_load(spark, d):
    """The snapshot load as an availableNow file stream with keyed appends."""
    from ..streaming.incremental import run_available

    root = scratch_path(spark, "stream")
    raw = run_available(spark, _snapshot_files(spark, d), f"{root}/raw", f"{root}/_checkpoint")
    return lineage_columns(raw)


@query
def load_quality_report(spark, d):
    from ..operators.quality import load_quality

    return load_quality(_raw(spark, d))


@query
def kpi_null_key_report(spark, d):
    from ..operators.quality import kpi_null_keys

    return kpi_null_keys(_fact(spark, d), REGION_KEYS)
