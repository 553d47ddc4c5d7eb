"""KPI blocks over the listing fact.

The original computes each KPI table as nine grouped subqueries over the
fact, glued with seven inner joins and one full outer join.  Here the block
is one two-level aggregation:

* level 1 groups by (keys, month, host): every measure that is a count, sum,
  min or max, in partial form, plus one row per host so that distinct host
  counts become plain counts (no ``Expand``);
* the superhost flag joins onto the level-1 rows (one per group and host),
  not onto the raw fact;
* level 2 groups by (keys, month);
* the exact median comes from :func:`exact_median` and joins on the group;
* month-on-month change is one window over the aggregated rows.

What the chain of inner joins did is kept as an explicit gate: a group has
its measures only if it has an active listing, an active rated listing and
a superhost; otherwise it survives only through its inactive count, with all
other measures NULL.  Groups with a NULL key are dropped (the original's
primary key refused them).
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import is_false_flag, is_true_flag, not_missing, text_or_missing
from .median import exact_median

TIME_KEYS = ("year", "month")
RATING_TYPE = "decimal(18,6)"


def _ratio(num: Column, den: Column) -> Column:
    """num / den as DOUBLE, NULL when den is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def pct_change(cur: Column, prev: Column) -> Column:
    """round(100 * (cur - prev) / (prev + 1e-6), 2); the epsilon is kept on purpose."""
    return F.round(F.lit(100.0) * (cur - prev) / (prev + F.lit(1.0e-6)), 2)


def mom_change(df: DataFrame, keys: Sequence[str], count_col: str, alias: str,
               time_keys: Sequence[str] = TIME_KEYS, previous: str | None = None,
               absolute: str | None = None) -> DataFrame:
    """Percent change of ``count_col`` against the previous existing month.

    "Previous" is the last earlier month of the same keys whose count is
    positive (months without rows of that status do not exist for the
    original's lag), and the change is NULL where the count is 0.  The count
    of that month and the absolute change are added too where they are named.
    """
    w = (Window.partitionBy(*keys).orderBy(*time_keys)
         .rowsBetween(Window.unboundedPreceding, -1))
    cnt = F.col(count_col)
    prev = F.last(F.when(cnt > 0, cnt), ignorenulls=True).over(w)
    more = {previous: prev} if previous else {}
    if absolute:
        more[absolute] = F.when(cnt > 0, cnt - prev)
    return df.withColumns({**more, alias: F.when(cnt > 0, pct_change(cnt, prev))})


def superhost_rate(fact: DataFrame, owners: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Percent of a group's distinct hosts that are superhosts (one row per host before the join)."""
    g = [*keys, *TIME_KEYS]
    hosts = fact.select(*g, "host_id").distinct().join(
        owners.select("host_id", is_true_flag("host_is_superhost").alias("sup")), "host_id", "left")
    return hosts.groupBy(*g).agg(
        (_ratio(F.count(F.when(F.col("sup"), F.col("host_id"))), F.count("host_id")) * 100).alias("Superhost_rate"))


def _prepare(fact: DataFrame, keys: Sequence[str], string_keys: Sequence[str]) -> DataFrame:
    cols = [text_or_missing(k).alias(k) if k in string_keys else F.col(k) for k in keys]
    return fact.select(*cols, *TIME_KEYS, "id", "host_id", "price", "availability_30",
                       "has_availability", "review_scores_rating")


def month_filter(months) -> Column:
    """(year, month) in ``months`` as a literal predicate (prunes month partitions)."""
    if not months:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [(F.col("year") == y) & (F.col("month") == m) for y, m in months])


def month_counts(fact: DataFrame, keys: Sequence[str], string_keys: Sequence[str] = (), months=None) -> DataFrame:
    """Active (``na``) and inactive (``ni``) listings per keys and month, groups with a NULL key left out.

    This is all that month-on-month change needs, and a state that an append keeps up:
    see :func:`merge_month_counts`.  ``months`` restricts it (and the scan) to those months.
    """
    if months is not None:
        fact = fact.filter(month_filter(months))
    g = [*keys, *TIME_KEYS]
    key_ok = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in g])
    return _prepare(fact, keys, string_keys).groupBy(*g).agg(
        F.count(F.when(is_true_flag("has_availability"), F.col("id"))).alias("na"),
        F.count(F.when(is_false_flag("has_availability"), F.col("id"))).alias("ni")).filter(key_ok)


def merge_month_counts(state: DataFrame, batch: DataFrame, months) -> DataFrame:
    """The state with the given months counted anew (``batch``); months may come in any order, or again."""
    return state.filter(~month_filter(months)).unionByName(batch)


def group_kpis(fact: DataFrame, owners: DataFrame, keys: Sequence[str],
               string_keys: Sequence[str] = (), median: str = "exact",
               approx_accuracy: int = 10_000, months=None, counts: DataFrame | None = None) -> DataFrame:
    """The 13-measure KPI block by ``keys`` × (year, month).

    ``string_keys`` are text keys whose missing value is the text ``NaN``
    (a group of its own); every other key drops its NULL groups.
    ``median="approx"`` opts into ``percentile_approx`` (bounded sketch,
    not equal to the exact interpolated median); the default is exact.
    ``months`` restricts the output to those (year, month) pairs: the
    measures read only those months, and the month-on-month change, whose lag
    may reach back to any month, comes from ``counts`` (the month counts of all
    months, as an append keeps them) or, without it, from a counts-only aggregate
    over the whole fact.
    """
    keys = list(keys)
    g = keys + list(TIME_KEYS)
    f = _prepare(fact, keys, string_keys)
    active = is_true_flag("has_availability")
    inactive = is_false_flag("has_availability")
    key_ok = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in g])
    changes = None
    if months is not None:
        counts = month_counts(fact, keys, string_keys) if counts is None else counts
        counts = mom_change(counts, keys, "na", "change_for_active_listings")
        counts = mom_change(counts, keys, "ni", "change_for_inactive_listings")
        changes = counts.filter(month_filter(months)).select(
            *g, "change_for_active_listings", "change_for_inactive_listings")
        f = f.filter(month_filter(months))
    stays = F.lit(30) - F.col("availability_30")
    rated = active & not_missing("review_scores_rating")
    on_active = lambda c: F.when(active, c)

    per_host = f.groupBy(*g, "host_id").agg(
        F.count(on_active(F.col("id"))).alias("na"),
        F.count(F.when(inactive, F.col("id"))).alias("ni"),
        F.count("id").alias("n"),
        F.min(on_active(F.col("price"))).alias("pmin"),
        F.max(on_active(F.col("price"))).alias("pmax"),
        F.sum(on_active(F.col("price"))).alias("psum"),
        F.count(on_active(F.col("price"))).alias("pcnt"),
        F.sum(F.when(rated, F.col("review_scores_rating").cast(RATING_TYPE))).alias("rsum"),
        F.count(F.when(rated, F.col("review_scores_rating"))).alias("rcnt"),
        F.sum(on_active(stays)).alias("ssum"),
        F.count(on_active(stays)).alias("scnt"),
        F.sum(on_active(stays * F.col("price"))).alias("rev"),
    )
    sup = owners.select("host_id", is_true_flag("host_is_superhost").alias("sup"))
    per_host = per_host.join(sup, "host_id", "left")

    grp = per_host.groupBy(*g).agg(
        *[F.sum(c).alias(c) for c in ("na", "ni", "n", "psum", "pcnt", "rsum", "rcnt", "ssum", "scnt", "rev")],
        F.min("pmin").alias("pmin"), F.max("pmax").alias("pmax"),
        F.count("host_id").alias("h"),
        F.count(F.when(F.col("sup"), F.col("host_id"))).alias("h1"),
    ).filter(key_ok)
    # NULL-key groups never reach the output (and sit in window partitions
    # of their own), so both sides drop them and join on plain equality:
    # the aggregate outputs are already hash-partitioned by the group key.
    if median == "exact":
        med = exact_median(f.filter(active & key_ok), g, "price", "pmed")
    elif median == "approx":
        med = (f.filter(active & key_ok).groupBy(*g)
               .agg(F.percentile_approx("price", 0.5, approx_accuracy).alias("pmed")))
    else:
        raise ValueError(f"median must be 'exact' or 'approx', not {median!r}")
    grp = grp.join(med, g, "left")

    if changes is None:
        grp = mom_change(grp, keys, "na", "change_for_active_listings")
        grp = mom_change(grp, keys, "ni", "change_for_inactive_listings")
    else:
        grp = grp.join(changes, g, "left")

    left = (F.col("na") > 0) & (F.col("rcnt") > 0) & (F.col("h1") > 0)
    gated = lambda c: F.when(left, c)
    out = grp.filter(left | (F.col("ni") > 0)).select(
        *g,
        gated(_ratio(F.col("na"), F.col("n")) * 100).alias("Active_listings_rate"),
        gated(F.col("pmin").cast("double")).alias("min_price"),
        gated(F.col("pmax").cast("double")).alias("max_price"),
        gated(F.col("pmed").cast("double")).alias("median_price"),
        gated(_ratio(F.col("psum"), F.col("pcnt"))).alias("ave_price"),
        gated(F.col("h")).alias("distinct_hosts"),
        gated(_ratio(F.col("h1"), F.col("h")) * 100).alias("Superhost_rate"),
        gated(_ratio(F.col("rsum"), F.col("rcnt"))).alias("Average_of_review_scores_rating"),
        gated(F.col("change_for_active_listings")).alias("change_for_active_listings"),
        F.col("change_for_inactive_listings"),
        gated(F.col("ssum")).alias("Number_of_stays_sum"),
        gated(_ratio(F.col("ssum"), F.col("scnt"))).alias("Number_of_stays_avg"),
        gated(F.col("rev").cast("double")).alias("Estimated_revenue"),
    )
    return out


def host_region_kpis(fact: DataFrame, owners: DataFrame, months=None) -> DataFrame:
    """Distinct hosts, revenue and revenue per host by the host's region × month.

    Hosts count whether their listings are active or not; revenue counts
    active listings only.  The fact is reduced to one row per host and month
    before it meets the owner dimension.  ``months`` restricts the output.
    """
    if months is not None:
        fact = fact.filter(month_filter(months))
    active = is_true_flag("has_availability")
    rev = (F.lit(30) - F.col("availability_30")) * F.col("price")
    per_host = fact.groupBy("host_id", *TIME_KEYS).agg(F.sum(F.when(active, rev)).alias("rev"))
    region = owners.select("host_id", F.col("lga_code").alias("host_lga"))
    g = (per_host.join(region, "host_id", "inner")
         .groupBy("host_lga", *TIME_KEYS)
         .agg(F.count("host_id").alias("dist_host"), F.sum("rev").alias("rev")))
    return g.filter(F.col("host_lga").isNotNull()).select(
        *TIME_KEYS, "host_lga", "dist_host",
        F.col("rev").cast("double").alias("Estimated_Revenue"),
        _ratio(F.col("rev"), F.col("dist_host")).alias("Estimated_Revenue_host"),
    )
