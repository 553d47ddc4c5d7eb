from staykit.operators.kpi import group_kpis
from staykit.operators.quality import kpi_null_keys, load_quality


def test_load_quality_counts(spark):
    raw = spark.createDataFrame(
        [("a/2020-01-01.csv", "$10.00", "Bondi", "t", 5.0),
         ("a/2020-01-01.csv", "$abc", None, None, float("nan")),
         ("a/2020-01-01.csv", None, "Bondi", "f", None)],
        "filename string, price string, neighbourhood_cleansed string, has_availability string, "
        "review_scores_rating double")
    r = load_quality(raw).first()
    assert (r.n_rows, r.n_price_missing, r.n_price_unparsed, r.n_place_missing,
            r.n_availability_missing, r.n_rating_missing) == (3, 1, 1, 1, 1, 2)


def test_kpi_null_keys(spark):
    fact = spark.createDataFrame([(1, None, 2020, 1), (2, "A", 2020, 1), (3, None, 2020, 1)],
                                 "id int, lga_code string, year int, month int")
    r = kpi_null_keys(fact, ["lga_code"]).first()
    assert (r.n_rows_null_key, r.n_listings) == (2, 2)


def test_approx_median_is_opt_in(spark):
    from decimal import Decimal
    fact = spark.createDataFrame(
        [(i, 1, "A", 2020, 1, Decimal(p), 10, "t", 5.0) for i, p in enumerate(["1", "2", "4", "9"])],
        "id bigint, host_id bigint, lga_code string, year int, month int, price decimal(12,2), "
        "availability_30 int, has_availability string, review_scores_rating double")
    owners = spark.createDataFrame([(1, "t")], "host_id bigint, host_is_superhost string")
    exact = group_kpis(fact, owners, ["lga_code"]).first().median_price
    approx = group_kpis(fact, owners, ["lga_code"], median="approx").first().median_price
    assert exact == 3.0 and approx in (2.0, 4.0)
