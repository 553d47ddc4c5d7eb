"""Table layouts of the three layers (raw, star, kpi) and the fixed name lists.

Everything here is a constant.  The column names and the drop list are values
that must equal the original job's for files to load the same way, so
they are written out plainly in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Listing columns that some monthly files carry and that are
# dropped on load (dropped when present, ignored when absent).
# ---------------------------------------------------------------------------
DROPPED_LISTING_COLUMNS = (
    "summary", "space", "experiences_offered", "notes", "transit", "access",
    "interaction", "house_rules", "thumbnail_url", "medium_url",
    "xl_picture_url", "city", "state", "zipcode", "market", "smart_location",
    "country_code", "country", "is_location_exact", "bed_type",
    "square_feet", "weekly_price", "monthly_price", "security_deposit",
    "cleaning_fee", "guests_included", "extra_people",
    "jurisdiction_names", "is_business_travel_ready", "cancellation_policy",
    "require_guest_profile_picture", "require_guest_phone_verification",
    "street", "requires_license",
)

S = T.StringType()
L = T.LongType()
I = T.IntegerType()
D = T.DoubleType()

# ---------------------------------------------------------------------------
# The 74 listing columns of a snapshot file plus `filename`
# (the raw landing table), in their natural order, with the Spark type each
# is cast to after the all-string CSV read.
# ---------------------------------------------------------------------------
RAW_LISTING_FIELDS = (
    ("id", L), ("listing_url", S), ("scrape_id", S), ("last_scraped", S),
    ("name", S), ("description", S), ("neighborhood_overview", S),
    ("picture_url", S), ("host_id", L), ("host_url", S), ("host_name", S),
    ("host_since", S), ("host_location", S), ("host_about", S),
    ("host_response_time", S), ("host_response_rate", S),
    ("host_acceptance_rate", S), ("host_is_superhost", S),
    ("host_thumbnail_url", S), ("host_picture_url", S),
    ("host_neighbourhood", S), ("host_listings_count", I),
    ("host_total_listings_count", I), ("host_verifications", S),
    ("host_has_profile_pic", S), ("host_identity_verified", S),
    ("neighbourhood", S), ("neighbourhood_cleansed", S),
    ("neighbourhood_group_cleansed", S), ("latitude", D), ("longitude", D),
    ("property_type", S), ("room_type", S), ("accommodates", I),
    ("bathrooms", S), ("bathrooms_text", S), ("bedrooms", I), ("beds", I),
    ("amenities", S), ("price", S), ("minimum_nights", I),
    ("maximum_nights", I), ("minimum_minimum_nights", I),
    ("maximum_minimum_nights", I), ("minimum_maximum_nights", I),
    ("maximum_maximum_nights", I), ("minimum_nights_avg_ntm", D),
    ("maximum_nights_avg_ntm", D), ("calendar_updated", S),
    ("has_availability", S), ("availability_30", I), ("availability_60", I),
    ("availability_90", I), ("availability_365", I),
    ("calendar_last_scraped", S), ("number_of_reviews", I),
    ("number_of_reviews_ltm", I), ("number_of_reviews_l30d", I),
    ("first_review", S), ("last_review", S), ("review_scores_rating", D),
    ("review_scores_accuracy", D), ("review_scores_cleanliness", D),
    ("review_scores_checkin", D), ("review_scores_communication", D),
    ("review_scores_location", D), ("review_scores_value", D),
    ("license", S), ("instant_bookable", S),
    ("calculated_host_listings_count", I),
    ("calculated_host_listings_count_entire_homes", I),
    ("calculated_host_listings_count_private_rooms", I),
    ("calculated_host_listings_count_shared_rooms", I),
    ("reviews_per_month", D), ("filename", S),
)

RAW_LISTING_SCHEMA = T.StructType(
    [T.StructField(n, t, n not in ("id", "host_id")) for n, t in RAW_LISTING_FIELDS]
)
RAW_LISTING_COLUMNS = tuple(n for n, _ in RAW_LISTING_FIELDS)
RAW_LISTING_KEY = ("id", "filename")

# Locality lookup (one CSV).  POSTCODE is a code, kept as text.
LOCATION_FIELDS = (
    ("LOCALITY_ID", S), ("LOCALITY_NAME", S), ("LOCALITY_TYPE", S),
    ("POSTCODE", S), ("STATE", S), ("LGA_CODE", S), ("LGA_NAME", S),
)
LOCATION_SCHEMA = T.StructType([T.StructField(n, t) for n, t in LOCATION_FIELDS])
LOCATION_KEY = ("LOCALITY_NAME", "LOCALITY_TYPE", "POSTCODE", "STATE")

# Census files: only the columns the star build reads.  Fixed values.
CENSUS_AGE_UNDER_55 = (
    "Age_0_4_yr_P", "Age_5_14_yr_P", "Age_15_19_yr_P", "Age_20_24_yr_P",
    "Age_25_34_yr_P", "Age_35_44_yr_P", "Age_45_54_yr_P",
)
CENSUS_AGE_55_PLUS = ("Age_55_64_yr_P", "Age_65_74_yr_P", "Age_75_84_yr_P", "Age_85ov_P")
G01_FIELDS = (
    (("LGA_CODE_2016", S), ("Tot_P_P", L), ("Australian_citizen_P", L), ("Indigenous_P_Tot_P", L))
    + tuple((c, L) for c in CENSUS_AGE_UNDER_55 + CENSUS_AGE_55_PLUS)
)
G02_FIELDS = (
    ("LGA_CODE_2016", S), ("Median_age_persons", I),
    ("Median_mortgage_repay_monthly", I), ("Average_household_size", D),
)
G01_SCHEMA = T.StructType([T.StructField(n, t) for n, t in G01_FIELDS])
G02_SCHEMA = T.StructType([T.StructField(n, t) for n, t in G02_FIELDS])

# ---------------------------------------------------------------------------
# Star layer
# ---------------------------------------------------------------------------
FACT_COLUMNS = (
    "id", "host_id", "neighbourhood_cleansed", "price", "room_type",
    "property_type", "accommodates", "beds", "minimum_nights",
    "maximum_nights", "availability_30", "has_availability",
    "number_of_reviews", "calendar_last_scraped", "month", "year",
    "lga_code", "review_scores_rating",
)
FACT_KEY = ("id", "year", "month")

OWNER_COLUMNS = (
    "host_id", "host_name", "host_loc_cleaned", "host_total_listings_count",
    "host_is_superhost", "lga_code", "host_tot_list_new",
)
OWNER_KEY = ("host_id",)

CENSUS_COLUMNS = (
    "LGA_CODE_2016", "Tot_P_P", "Australian_citizen_P", "Indigenous_P_Tot_P",
    "Tot_P_un55", "Tot_p_up55", "Median_age_persons",
    "Median_mortgage_repay_monthly", "Average_household_size",
)
CENSUS_KEY = ("LGA_CODE_2016",)

# ---------------------------------------------------------------------------
# KPI layer: the 13 measures shared by the region and segment tables.
# ---------------------------------------------------------------------------
KPI_MEASURES = (
    "Active_listings_rate", "min_price", "max_price", "median_price",
    "ave_price", "distinct_hosts", "Superhost_rate",
    "Average_of_review_scores_rating", "change_for_active_listings",
    "change_for_inactive_listings", "Number_of_stays_sum",
    "Number_of_stays_avg", "Estimated_revenue",
)
REGION_KEYS = ("lga_code",)
SEGMENT_KEYS = ("property_type", "room_type", "accommodates")
HOST_REGION_MEASURES = ("dist_host", "Estimated_Revenue", "Estimated_Revenue_host")

# Label given to owners whose home town is not in the locality lookup.
DEFAULT_HOST_REGION = "Out of NSW"
# Text a missing string takes in the original loader; distinct counts and
# group keys treat it as a value of its own.
MISSING_TEXT = "NaN"
