"""Listing-level operators: moved listings and locality lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import norm_key, text_or_missing
from .keys import divided, first_per_key

LOOKUP_KEY = "_place_key"


def moved_ids(raw: DataFrame, id_col: str = "id", place_col: str = "neighbourhood_cleansed") -> DataFrame:
    """Ids seen with more than one place over all snapshots.

    A missing place counts as the value ``NaN`` (as the original stored it),
    so a listing with a blank place in one month counts as moved.  Planned as
    a two-level hash aggregate (by id and place, then by id), both combined
    map-side, so a hot id never sits whole in one task.
    """
    return (raw.select(id_col, text_or_missing(place_col).alias("_place"))
            .groupBy(id_col).agg(F.countDistinct("_place").alias("_places"))
            .filter(F.col("_places") > 1).select(id_col))


def place_bounds(raw: DataFrame, id_col: str = "id", place_col: str = "neighbourhood_cleansed") -> DataFrame:
    """Per id the least and the greatest place seen: a state of which two can be merged.

    An id has moved if the two differ, whatever lies between them, so this says what
    :func:`moved_ids` says without a distinct count (a missing place is ``NaN``, too).
    """
    return (raw.select(id_col, text_or_missing(place_col).alias("_place"))
            .groupBy(id_col).agg(F.min("_place").alias("least"), F.max("_place").alias("greatest")))


def merge_place_bounds(state: DataFrame, batch: DataFrame, id_col: str = "id") -> DataFrame:
    """Bounds over the rows of both.  Any order of batches, and a batch merged twice, give the same."""
    return state.unionByName(batch).groupBy(id_col).agg(F.min("least").alias("least"), F.max("greatest").alias("greatest"))


def moved_by_bounds(state: DataFrame, id_col: str = "id") -> DataFrame:
    return state.filter("least <> greatest").select(id_col)


def exclude_moved(raw: DataFrame, moved: DataFrame | None = None, id_col: str = "id",
                  place_col: str = "neighbourhood_cleansed") -> DataFrame:
    """Rows of listings that never changed place.

    A left anti join, not ``NOT IN``: ids are NOT NULL, so the null-aware
    form (which wants a broadcast) is not needed and a large moved set can
    shuffle.  Only rows whose id may be one of them (see :func:`divided`) are
    looked at exactly; the others pass without a shuffle.
    """
    if moved is None:
        moved = moved_ids(raw, id_col, place_col)
    moved = moved.select(id_col)
    stayed, doubtful = divided(raw, moved, [id_col])
    return stayed.unionByName(doubtful.join(moved, id_col, "left_anti").select(*raw.columns))


def reduced_lookup(location: DataFrame, trim: bool, state: str | None = None) -> DataFrame:
    """Locality lookup reduced to one row per normalised name.

    Names are compared upper-cased (and trimmed when ``trim``).  Where a
    name has several rows the original fanned out and then kept an
    arbitrary one; here the row with the smallest (LGA_CODE, LOCALITY_TYPE,
    POSTCODE, STATE, LOCALITY_ID, LGA_NAME) wins.  ``state`` optionally
    restricts the lookup to one state, so a name shared with another state
    cannot give the wrong region (the original did not restrict it).
    """
    if state is not None:
        location = location.filter(F.col("STATE") == state)
    keyed = location.select(
        norm_key("LOCALITY_NAME", trim).alias(LOOKUP_KEY), "LGA_CODE", "LOCALITY_TYPE",
        "POSTCODE", "STATE", "LOCALITY_ID", "LGA_NAME")
    keyed = keyed.filter(F.col(LOOKUP_KEY).isNotNull())
    return first_per_key(keyed, [LOOKUP_KEY]).select(LOOKUP_KEY, "LGA_CODE")


def lookup_region(df: DataFrame, name_col, location: DataFrame, trim: bool,
                  out_col: str = "lga_code", state: str | None = None) -> DataFrame:
    """Left join a region code by a place name (upper-cased, trimmed if asked).

    Whether the reduced lookup is broadcast is left to Spark: it is when its
    measured bytes are below the session's broadcast threshold, else the join
    shuffles on the normalised name.
    """
    lk = reduced_lookup(location, trim, state=state)
    keyed = df.withColumn(LOOKUP_KEY, norm_key(name_col, trim))
    return (keyed.join(lk, LOOKUP_KEY, "left")
            .withColumnRenamed("LGA_CODE", out_col).drop(LOOKUP_KEY))
