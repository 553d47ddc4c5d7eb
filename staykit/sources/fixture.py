"""The listing domain laid over the driver's generated tables.

The original ships no data, so the inputs are derived, by Spark, from the
TPC-H-like parquet tables; the derived data grows with them.

Listing snapshot rows (one per ``lineitem`` row):

=========================  =================================================
listing column             derived from
=========================  =================================================
id                         l_orderkey (an order plays a listing)
host_id / host_name        l_suppkey / s_name, with ' Ltd' every fourth month
host_location              ' ' + lower(supplier nation) + ' , X, Y'; the customer's
                           nation in November
host_is_superhost          't' when s_acctbal > 5000, the opposite in May
host_total_listings_count  s_nationkey + 1
neighbourhood_cleansed     customer nation name; lower-cased on returned
                           lines with the top discount (a case-only change,
                           which counts as a move but maps to the same region)
property/room type, size   p_type, p_brand, p_size
price                      '$1,234.56' text; plain '1234.56' in July files
has_availability           't' when l_linestatus = 'O', else 'f'
availability_30            least(l_quantity, 30)
review_scores_rating       round(l_discount * 100); missing on returned lines
filename                   in/snap/YYYY-MM-01.csv by ship month; lines with
                           l_tax >= 0.08 come from in/late/ (a second folder
                           holding the same month)
=========================  =================================================

Locality lookup (from nation ⋈ region): one row per nation outside region 0
(whose listings therefore have no region); region-2 names are blank-padded
(they match only trimmed); region-1 nations get a second, lower-case row with
another LGA code.  Census G01/G02: per nation, customer counts by account
balance band; region-3 nations miss the 85-plus band; G02 lacks region 4.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import apart
from ..schemas import (CENSUS_AGE_55_PLUS, CENSUS_AGE_UNDER_55, G01_SCHEMA, G02_SCHEMA,
                       LOCATION_SCHEMA, RAW_LISTING_SCHEMA)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Spark SQL text of every derived listing column, over the columns of ``unpacked``; the rest are NULL.
LISTING_EXPR = {
    "id": "l_orderkey",
    "name": "concat(p_name, ', ', o_orderpriority)",
    "description": "concat('Listing ', l_orderkey, ' line ', linenumber, '\n\"', c_mktsegment, '\" segment')",
    "last_scraped": "date_format(shipped, 'yyyy-MM-dd')",
    "host_id": "l_suppkey",
    "host_name": "concat(s_name, case when month(shipped) % 4 = 0 then ' Ltd' else '' end)",
    "host_location": "concat(' ', lower(case when month(shipped) = 11 then cn.n_name else sn.n_name end), ' , X, Y')",
    "host_is_superhost": "case when (s_acctbal > 5000) <> (month(shipped) = 5) then 't' else 'f' end",
    "host_total_listings_count": "s_nationkey + 1",
    "neighbourhood_cleansed": "case when lowered then lower(cn.n_name) else cn.n_name end",
    "property_type": "p_type",
    "room_type": "p_brand",
    "accommodates": "p_size",
    "beds": "linenumber",
    "price": ("case when month(shipped) = 7 then cast(cast(price as decimal(12,2)) as string) "
              "else concat('$', format_number(price, 2)) end"),
    "minimum_nights": "least(quantity, 7)",
    "maximum_nights": "quantity * 10",
    "has_availability": "case when offered then 't' else 'f' end",
    "availability_30": "least(quantity, 30)",
    "calendar_last_scraped": "date_format(shipped, 'yyyy-MM-dd')",
    "number_of_reviews": "tax",
    "review_scores_rating": "case when returned then null else cast(discount as double) end",
    "filename": "concat(case when late then 'in/late/' else 'in/snap/' end, date_format(shipped, 'yyyy-MM'), '-01.csv')",
}

# What the listing columns need of a line besides its keys.
LINE_EXPR = {
    "price": "l_extendedprice",
    "linenumber": "l_linenumber",
    "quantity": "cast(l_quantity as int)",
    "shipped": "cast(l_shipdate as date)",
    "tax": "cast(round(l_tax * 100) as int)",
    "discount": "cast(round(l_discount * 100) as int)",
    "late": "coalesce(l_tax >= 0.08, false)",
    "lowered": "coalesce(l_returnflag = 'R' and l_discount > 0.095, false)",
    "returned": "coalesce(l_returnflag = 'R', false)",
    "offered": "coalesce(l_linestatus = 'O', false)",
}
# Those of them (price in whole cents, shipped in days) that two longs hold, with their bits.
PACKED = {"_a": (("cents", 31), ("days", 17), ("quantity", 15)),
          "_b": (("linenumber", 15), ("tax", 10), ("discount", 10), ("late", 1), ("lowered", 1), ("returned", 1), ("offered", 1))}
MOST_BROADCAST = 1_000_000  # rows of the host table


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def packed(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys`` and the columns of ``LINE_EXPR``, small enough to be shuffled more than once.

    A row of ten columns takes 80 bytes and more in a shuffle, most of them zeros between
    small numbers.  Two longs hold the same where every value is there and fits its bits;
    a line for which that does not hold keeps its values as they are, in ``odd``.
    """
    whole = F.expr("try_cast(round(price * 100) as long)")
    small = lines.select(*keys, *[F.expr(e).alias(c) for c, e in LINE_EXPR.items()]).withColumns({
        # only cents that give the very same number back
        "cents": F.when((F.col("price") > 0) & (whole.cast("double") / F.lit(100.0) == F.col("price")), whole),
        "days": F.unix_date("shipped")})
    fits, longs = F.lit(True), {}
    for name, parts in PACKED.items():
        at, value = 0, F.lit(0).cast("long")
        for c, bits in parts:
            number = F.col(c).cast("long")
            fits = fits & number.between(0, (1 << bits) - 1)
            value, at = value.bitwiseOR(F.shiftleft(number, at)), at + bits
        longs[name] = value
    fits = F.coalesce(fits, F.lit(False))
    return small.select(*keys, *[F.when(fits, v).alias(n) for n, v in longs.items()],
                        F.when(~fits, F.struct(*LINE_EXPR)).alias("odd"))


def line_column(name: str) -> Column:
    """A column of ``LINE_EXPR``, read out of a packed line."""
    source = {"price": "cents", "shipped": "days"}.get(name, name)
    for long, parts in PACKED.items():
        at = 0
        for c, bits in parts:
            if c == source:
                number = F.shiftright(F.col(long), at).bitwiseAND(F.lit((1 << bits) - 1))
                value = (number.cast("double") / F.lit(100.0) if c == "cents" else F.date_from_unix_date(number.cast("int")) if c == "days"
                         else number == 1 if bits == 1 else number.cast("int"))
                return F.coalesce(value, F.col("odd")[name])
            at += bits
    raise KeyError(name)


def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed lines with what their order, customer and part give: all of a snapshot row but for the
    tables of hosts and nations, in few bytes (see :func:`listing_columns`)."""
    t = lambda n: read_table(spark, sf_dir, n)
    li = packed(t("lineitem"), ["l_orderkey", "l_partkey", "l_suppkey"])
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = t("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    p = t("part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    # orders and customers meet first, so that lines are shuffled for orders and parts only
    placed = o.join(c, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")
    return (li.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
            .join(p, F.col("l_partkey") == F.col("p_partkey")).drop("l_partkey", "p_partkey"))


def listing_columns(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Snapshot rows of ``joined_lines``.  Hosts are broadcast if the table has at most ``MOST_BROADCAST`` rows."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    hosts = s.join(n.alias("sn"), F.col("s_nationkey") == F.col("sn.n_nationkey"))
    if s.count() <= MOST_BROADCAST:
        hosts = F.broadcast(hosts)
    small = lines.select(*[c for c in lines.columns if c not in ("_a", "_b", "odd")], *[line_column(c).alias(c) for c in LINE_EXPR])
    j = (small.join(hosts, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(n.alias("cn"), F.col("c_nationkey") == F.col("cn.n_nationkey")))
    cols = []
    for field in RAW_LISTING_SCHEMA.fields:
        e = LISTING_EXPR.get(field.name)
        expr = F.expr(e) if e else F.lit(None)
        cols.append((apart(expr.cast(field.dataType)) if field.name == "id" else expr.cast(field.dataType)).alias(field.name))
    return j.select(*cols)


def file_name() -> Column:
    """The snapshot file of a packed line, as ``LISTING_EXPR`` has it."""
    return F.concat(F.when(line_column("late"), F.lit("in/late/")).otherwise(F.lit("in/snap/")),
                    F.date_format(line_column("shipped"), "yyyy-MM"), F.lit("-01.csv"))


def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot rows before any load rule (what the monthly files hold)."""
    return listing_columns(spark, sf_dir, joined_lines(spark, sf_dir))


def locality_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation").filter(F.col("n_regionkey") != 0)
    r = read_table(spark, sf_dir, "region")
    nr = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    base = nr.selectExpr(
        "cast(n_nationkey as string) as LOCALITY_ID",
        "case when n_regionkey = 2 then concat(' ', n_name, ' ') else n_name end as LOCALITY_NAME",
        "'SUBURB' as LOCALITY_TYPE", "cast(2000 + n_nationkey as string) as POSTCODE",
        "'NSW' as STATE", "concat('LGA', n_nationkey) as LGA_CODE", "r_name as LGA_NAME")
    dup = nr.filter(F.col("n_regionkey") == 1).selectExpr(
        "cast(n_nationkey + 100 as string) as LOCALITY_ID", "lower(n_name) as LOCALITY_NAME",
        "'LOCALITY' as LOCALITY_TYPE", "cast(2000 + n_nationkey as string) as POSTCODE",
        "'VIC' as STATE", "concat('LGA', n_nationkey + 100) as LGA_CODE", "r_name as LGA_NAME")
    return base.unionByName(dup).select(*[F.col(f.name).cast(f.dataType) for f in LOCATION_SCHEMA.fields])


def _balance_band(b: int):
    lo, hi = -1000 + 1000 * b, -1000 + 1000 * (b + 1)
    cond = F.col("c_acctbal") >= lo
    if b < 10:
        cond = cond & (F.col("c_acctbal") < hi)
    return F.count(F.when(cond, F.lit(1)))


def census_g01(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    bands = CENSUS_AGE_UNDER_55 + CENSUS_AGE_55_PLUS
    agg = (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
           .groupBy("n_nationkey", "n_regionkey")
           .agg(F.count(F.lit(1)).alias("Tot_P_P"),
                F.count(F.when(F.col("c_mktsegment") != "BUILDING", F.lit(1))).alias("Australian_citizen_P"),
                F.count(F.when(F.col("c_acctbal") < 0, F.lit(1))).alias("Indigenous_P_Tot_P"),
                *[_balance_band(i).alias(b) for i, b in enumerate(bands)]))
    agg = agg.withColumn("Age_85ov_P", F.when(F.col("n_regionkey") != 3, F.col("Age_85ov_P")))
    agg = agg.withColumn("LGA_CODE_2016", F.concat(F.lit("LGA"), F.col("n_nationkey")))
    return agg.select(*[F.col(f.name).cast(f.dataType) for f in G01_SCHEMA.fields])


def census_g02(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").filter(F.col("n_regionkey") != 4)
    agg = (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
           .groupBy("n_nationkey")
           .agg(F.floor(F.max("c_acctbal") / 250).alias("Median_age_persons"),
                F.floor(F.min("c_acctbal") + 2000).alias("Median_mortgage_repay_monthly"),
                (F.count(F.lit(1)) / 20.0).alias("Average_household_size")))
    agg = agg.withColumn("LGA_CODE_2016", F.concat(F.lit("LGA"), F.col("n_nationkey")))
    return agg.select(*[F.col(f.name).cast(f.dataType) for f in G02_SCHEMA.fields])
