"""Star layer: the listing fact and the owner and census dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import apart, host_city, price_mixed_format, snapshot_date
from ..operators.keys import first_per_key, first_per_key_split, may_be_held, repeated_keys
from ..operators.listings import exclude_moved, lookup_region, moved_ids
from ..schemas import (CENSUS_AGE_55_PLUS, CENSUS_AGE_UNDER_55, CENSUS_COLUMNS, CENSUS_KEY,
                       DEFAULT_HOST_REGION, FACT_COLUMNS, FACT_KEY, OWNER_COLUMNS)


def load_raw(snapshots: DataFrame) -> DataFrame:
    """Raw landing table: one row per (id, filename), first in column order.

    ``snapshots`` should be a written (staged) table: its keys are counted first,
    and only keys met more than once are reduced."""
    return first_per_key_split(snapshots, ["id", "filename"]).withColumn("filename", apart("filename"))


def build_fact(raw: DataFrame, location: DataFrame, moved: DataFrame | None = None) -> DataFrame:
    """Listing fact, one row per (id, year, month).

    Moved listings out; region by the upper-cased place name; price parsed
    in either text regime; year and month from the snapshot file name.  A
    key met in two files keeps the row of the earlier snapshot date, then of the
    first file name.

    ``raw`` should be a written table.  Rows whose listing surely never moved and whose
    key is surely unique (see :func:`may_be_held`) pass without a shuffle; only the
    others meet the moved listings and are reduced by key.
    """
    moved = moved_ids(raw) if moved is None else moved
    dated = raw.select("*", snapshot_date("filename").alias("_date")).select(
        "*", F.month("_date").cast("int").alias("month"), F.year("_date").cast("int").alias("year"))

    def rows(part: DataFrame) -> DataFrame:
        placed = lookup_region(part, "neighbourhood_cleansed", location, trim=False)
        return placed.select(
            "filename", "id", "host_id", "neighbourhood_cleansed",
            price_mixed_format("price").alias("price"), "room_type", "property_type",
            "accommodates", "beds", "minimum_nights", "maximum_nights", "availability_30",
            "has_availability", "number_of_reviews", "calendar_last_scraped",
            "month", "year", "lga_code", "review_scores_rating", "_date")

    marked = may_be_held(dated, repeated_keys(dated, FACT_KEY), FACT_KEY, "_repeated")
    marked = may_be_held(marked, moved.select("id"), ["id"], "_moved")
    passed, doubtful = marked.filter("not (_repeated or _moved)"), marked.filter("_repeated or _moved")
    kept = first_per_key(rows(doubtful.join(moved.select("id"), "id", "left_anti")), FACT_KEY, order=["_date", "filename"])
    return rows(passed).select(*FACT_COLUMNS).unionByName(kept.select(*FACT_COLUMNS))


def host_listing_count(kept: DataFrame) -> DataFrame:
    """Distinct kept listings per host (over all months)."""
    return kept.groupBy("host_id").agg(F.countDistinct("id").alias("host_tot_list_new"))


def owner_rows(raw: DataFrame, location: DataFrame, moved: DataFrame | None = None) -> DataFrame:
    """One row per host, region NULL where the home town is not in the lookup.

    The attributes are those of the host's earliest snapshot date (of equal
    dates, of the smallest listing id, then first in column order).  The home
    town is the first comma-separated part of the host location, upper-cased
    (stored untrimmed, matched trimmed).  Two aggregates of kept rows, both
    combined map-side: the first attributes of each host, and its number of
    distinct listings (by themselves, so that only ids are shuffled for them); the
    lookup joins to one row a host.
    """
    kept = exclude_moved(raw, moved)
    attrs = ["host_name", "host_location", "host_total_listings_count", "host_is_superhost"]
    dated = kept.select("host_id", "id", *attrs, snapshot_date("filename").alias("_date"))
    one = dated.groupBy("host_id").agg(F.min(F.struct("_date", "id", *attrs)).alias("_first"))
    listed = host_listing_count(kept).withColumnRenamed("host_id", "_host")
    hosts = one.join(listed, F.col("host_id").eqNullSafe(F.col("_host"))).select(
        "host_id", *[F.col("_first")[c].alias(c) for c in attrs], "host_tot_list_new")
    hosts = hosts.withColumn("host_loc_cleaned", host_city("host_location"))
    return lookup_region(hosts, F.split_part(F.col("host_location"), F.lit(","), F.lit(1)), location,
                         trim=True).select(*OWNER_COLUMNS)


def build_owners(raw: DataFrame, location: DataFrame, moved: DataFrame | None = None,
                 default_region: str = DEFAULT_HOST_REGION) -> DataFrame:
    """Owner dimension, one row per host; hosts without a region get ``default_region``."""
    return fill_missing_region(owner_rows(raw, location, moved), default_region)


def fill_missing_region(owners: DataFrame, default_region: str = DEFAULT_HOST_REGION) -> DataFrame:
    """A NULL region becomes the default label (an update-in-place, as a projection)."""
    return owners.withColumn("lga_code", F.coalesce(F.col("lga_code"), F.lit(default_region)))


def age_band_totals(g01: DataFrame) -> DataFrame:
    """Population under 55 and 55-plus as NULL-propagating sums of the bands."""
    add = lambda cols: reduce(lambda a, b: a + b, [F.col(c) for c in cols])
    return g01.withColumn("Tot_P_un55", add(CENSUS_AGE_UNDER_55)).withColumn(
        "Tot_p_up55", add(CENSUS_AGE_55_PLUS))


def build_census(g01: DataFrame, g02: DataFrame) -> DataFrame:
    """Census dimension: G01 inner join G02 on the LGA code, one row per code."""
    g02 = g02.select("LGA_CODE_2016", "Median_age_persons", "Median_mortgage_repay_monthly",
                     "Average_household_size")
    g01 = age_band_totals(g01).select(*[c for c in CENSUS_COLUMNS if c not in g02.columns or c == "LGA_CODE_2016"])
    joined = g01.join(g02, "LGA_CODE_2016", "inner")
    return first_per_key(joined.select(*CENSUS_COLUMNS), CENSUS_KEY)


def build_star(raw: DataFrame, location: DataFrame, g01: DataFrame, g02: DataFrame):
    """(fact, owners, census) sharing one moved-listing set."""
    moved = moved_ids(raw)
    return (build_fact(raw, location, moved), build_owners(raw, location, moved),
            build_census(g01, g02))
