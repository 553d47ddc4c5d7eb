from staykit.operators.listings import exclude_moved, lookup_region, moved_ids, reduced_lookup
from staykit.schemas import LOCATION_SCHEMA

LOC = [
    ("1", "Bondi", "SUBURB", "2026", "NSW", "LGA_B", "Waverley"),
    ("2", "bondi", "LOCALITY", "2026", "VIC", "LGA_A", "Other"),   # case-only duplicate, smaller code wins
    ("3", " Manly ", "SUBURB", "2095", "NSW", "LGA_M", "Northern Beaches"),  # blank-padded
]


def test_moved_counts_blank_and_case(spark):
    raw = spark.createDataFrame(
        [(1, "Bondi"), (1, "Bondi"), (2, "Bondi"), (2, None), (3, "Manly"), (3, "MANLY"), (4, None), (4, None)],
        "id int, neighbourhood_cleansed string")
    assert sorted(r.id for r in moved_ids(raw).collect()) == [2, 3]
    assert sorted({r.id for r in exclude_moved(raw).collect()}) == [1, 4]


def test_lookup_upper_vs_trim_upper(spark):
    loc = spark.createDataFrame(LOC, LOCATION_SCHEMA)
    df = spark.createDataFrame([("BONDI",), ("Manly",), ("nowhere",)], "place string")
    up = {r.place: r.lga_code for r in lookup_region(df, "place", loc, trim=False).collect()}
    tr = {r.place: r.lga_code for r in lookup_region(df, "place", loc, trim=True).collect()}
    assert up == {"BONDI": "LGA_A", "Manly": None, "nowhere": None}
    assert tr == {"BONDI": "LGA_A", "Manly": "LGA_M", "nowhere": None}


def test_reduced_lookup_one_row_per_name(spark):
    loc = spark.createDataFrame(LOC, LOCATION_SCHEMA)
    assert reduced_lookup(loc, trim=True).count() == 2


def test_state_filter_picks_the_right_region(spark):
    loc = spark.createDataFrame(LOC, LOCATION_SCHEMA)
    df = spark.createDataFrame([("Bondi",)], "place string")
    nsw = lookup_region(df, "place", loc, trim=True, state="NSW").first().lga_code
    assert nsw == "LGA_B"  # without the filter the VIC row (smaller code) would win


def test_lookup_without_broadcast_gives_the_same_regions(spark):
    loc = spark.createDataFrame(LOC, LOCATION_SCHEMA)
    df = spark.createDataFrame([("BONDI",), ("Manly",), ("nowhere",), (None,)], "place string")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for trim in (False, True):
        small = sorted(map(tuple, lookup_region(df, "place", loc, trim=trim).collect()), key=repr)
        try:
            for k in keys:
                spark.conf.set(k, "-1")  # no size-based broadcast either: a shuffle join
            big = lookup_region(df, "place", loc, trim=trim)
            assert "SortMergeJoin" in big._jdf.queryExecution().executedPlan().toString()
            big = sorted(map(tuple, big.collect()), key=repr)
        finally:
            for k, v in old.items():
                if v is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, v)
        assert small == big
