import random
from decimal import Decimal

import duckdb
import pytest

from duck_oracle import HOST_REGION_TAIL, kpi_query
from staykit.operators.kpi import group_kpis, host_region_kpis

FACT = ("id bigint, host_id bigint, lga_code string, property_type string, room_type string, accommodates int, "
        "year int, month int, price decimal(12,2), availability_30 int, has_availability string, "
        "review_scores_rating double")
OWN = "host_id bigint, host_is_superhost string, lga_code string"


def fact_row(i, host, lga, y, m, price, a30, act, rating, ptype="Apt", room="Entire", acc=2):
    return (i, host, lga, ptype, room, acc, y, m, None if price is None else Decimal(price), a30, act, rating)


def kpis(spark, rows, owners, keys=("lga_code",)):
    f = spark.createDataFrame(rows, FACT)
    o = spark.createDataFrame(owners, OWN)
    out = group_kpis(f, o, list(keys), string_keys=[k for k in keys if k in ("property_type", "room_type")])
    return {tuple(r[k] for k in list(keys) + ["year", "month"]): r.asDict() for r in out.collect()}


OWNERS = [(1, "t", "X"), (2, "f", "X")]


def test_gate_no_superhost_keeps_only_inactive_change(spark):
    rows = [fact_row(1, 2, "A", 2020, 1, "10", 10, "f", 80.0),
            fact_row(2, 2, "A", 2020, 2, "10", 10, "t", 90.0),
            fact_row(3, 2, "A", 2020, 2, "20", 10, "f", 80.0),
            fact_row(4, 2, "A", 2020, 2, "20", 10, "f", 80.0)]
    out = kpis(spark, rows, OWNERS)
    r = out[("A", 2020, 2)]
    assert all(r[m] is None for m in r if m not in ("lga_code", "year", "month", "change_for_inactive_listings"))
    assert r["change_for_inactive_listings"] == 100.0


def test_gate_only_inactive_group(spark):
    rows = [fact_row(1, 1, "A", 2020, 1, "10", 10, "f", 90.0)]
    out = kpis(spark, rows, OWNERS)
    assert list(out) == [("A", 2020, 1)]
    assert out[("A", 2020, 1)]["change_for_inactive_listings"] is None  # first month: no previous


def test_gate_passes_and_measures(spark):
    rows = [fact_row(1, 1, "A", 2020, 1, "10", 10, "t", 90.0),
            fact_row(2, 1, "A", 2020, 1, "30", 20, "t", None),
            fact_row(3, 2, "A", 2020, 1, "50", 0, "f", 70.0)]
    r = kpis(spark, rows, OWNERS)[("A", 2020, 1)]
    assert r["Active_listings_rate"] == pytest.approx(200 / 3)
    assert (r["min_price"], r["max_price"], r["median_price"], r["ave_price"]) == (10.0, 30.0, 20.0, 20.0)
    assert r["distinct_hosts"] == 2 and r["Superhost_rate"] == 50.0
    assert r["Average_of_review_scores_rating"] == 90.0
    assert (r["Number_of_stays_sum"], r["Number_of_stays_avg"], r["Estimated_revenue"]) == (30, 15.0, 500.0)


def test_null_region_dropped(spark):
    rows = [fact_row(1, 1, None, 2020, 1, "10", 10, "t", 90.0), fact_row(2, 1, None, 2020, 1, "10", 10, "f", 9.0)]
    assert kpis(spark, rows, OWNERS) == {}


def test_gap_month_bridged_and_rounding_epsilon(spark):
    # 800 active in Jan, none in Feb, 801 in Mar: Mar compares to Jan; 100*1/800 → 0.12 with the epsilon
    rows = [fact_row(i, 1, "A", 2020, 1, "10", 10, "t", 5.0) for i in range(800)]
    rows += [fact_row(10_000 + i, 1, "A", 2020, 3, "10", 10, "t", 5.0) for i in range(801)]
    rows += [fact_row(20_000, 1, "A", 2020, 2, "10", 10, "f", 5.0)]
    out = kpis(spark, rows, OWNERS)
    assert out[("A", 2020, 3)]["change_for_active_listings"] == 0.12
    assert out[("A", 2020, 1)]["change_for_active_listings"] is None
    assert out[("A", 2020, 2)]["change_for_active_listings"] is None


def random_fact(seed, n=1500):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append(fact_row(
            i, rnd.randint(1, 12), rnd.choice(["A", "B", "C", None]), rnd.choice([2019, 2020]), rnd.randint(1, 6),
            rnd.choice([None, f"{rnd.randint(1, 5000)}.{rnd.randint(0, 99):02d}"]), rnd.randint(0, 30),
            rnd.choice(["t", "t", "f", None]), rnd.choice([None, float(rnd.randint(0, 100)), float("nan")]),
            rnd.choice(["Apt", "House", None]), rnd.choice(["Entire", "Private"]), rnd.choice([1, 2, 3, None])))
    owners = [(h, rnd.choice(["t", "f", "f"]), rnd.choice(["X", "Y", "Out of NSW"])) for h in range(1, 12)]
    return rows, owners


def duck_rows(sql, tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df)
    res = con.execute(sql)
    cols = [c[0] for c in res.description]
    return cols, res.fetchall()


def norm(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 6)
    return v


@pytest.mark.parametrize("keys", [("lga_code",), ("property_type", "room_type", "accommodates")])
@pytest.mark.parametrize("seed", [1, 2])
def test_one_pass_equals_literal_join_sql(spark, keys, seed):
    rows, owners = random_fact(seed)
    f = spark.createDataFrame(rows, FACT)
    o = spark.createDataFrame(owners, OWN)
    string_keys = [k for k in keys if k in ("property_type", "room_type")]
    got = group_kpis(f, o, list(keys), string_keys=string_keys)
    pf = f.toPandas()
    for k in string_keys:
        pf[k] = pf[k].fillna("NaN")
    sql = kpi_query("fact", keys, lambda *tables, extra: "WITH " + ", ".join(f"{n} AS ({b})" for n, b in extra.items()) + " ")
    cols, want = duck_rows(sql, {"fact": pf, "owners": o.toPandas()})
    order = sorted(cols)
    a = sorted((tuple(norm(r[c]) for c in order) for r in got.collect()), key=repr)
    b = sorted((tuple(norm(r[cols.index(c)]) for c in order) for r in want), key=repr)
    assert a == b


def test_host_region_equals_sql(spark):
    rows, owners = random_fact(5)
    f = spark.createDataFrame(rows, FACT)
    o = spark.createDataFrame(owners, OWN)
    got = host_region_kpis(f, o)
    cols, want = duck_rows(HOST_REGION_TAIL, {"fact": f.toPandas(), "owners": o.toPandas()})
    order = sorted(cols)
    a = sorted((tuple(norm(r[c]) for c in order) for r in got.collect()), key=repr)
    b = sorted((tuple(norm(r[cols.index(c)]) for c in order) for r in want), key=repr)
    assert a == b


@pytest.mark.parametrize("keys", [("lga_code",), ("property_type", "room_type", "accommodates")])
def test_month_restricted_kpis_equal_full_kpis(spark, keys):
    from pyspark.sql import functions as F

    rows, owners = random_fact(9)
    f = spark.createDataFrame(rows, FACT)
    o = spark.createDataFrame(owners, OWN)
    months = [(2019, 3), (2020, 1), (2020, 6)]
    string_keys = [k for k in keys if k in ("property_type", "room_type")]
    part = group_kpis(f, o, list(keys), string_keys=string_keys, months=months)
    full = group_kpis(f, o, list(keys), string_keys=string_keys)
    keep = F.lit(False)
    for y, m in months:
        keep = keep | ((F.col("year") == y) & (F.col("month") == m))
    cols = sorted(part.columns)
    a = sorted((tuple(norm(r[c]) for c in cols) for r in part.collect()), key=repr)
    b = sorted((tuple(norm(r[c]) for c in cols) for r in full.filter(keep).collect()), key=repr)
    assert a and a == b
    h_part = host_region_kpis(f, o, months=months).collect()
    h_full = host_region_kpis(f, o).filter(keep).collect()
    assert sorted(map(tuple, h_part), key=repr) == sorted(map(tuple, h_full), key=repr)
