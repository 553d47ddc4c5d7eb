"""Column expressions that clean listing text.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MISSING_TEXT

# Field contents that the original CSV loader turned into
# missing values (pandas' default NA tokens).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

PRICE_TYPE = "decimal(12,2)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def apart(col: Column | str) -> Column:
    """The column itself, in a form that keeps its projection out of whole-stage code.

    Whole-stage code makes one method of a projection.  With the 75 listing columns that has more than
    8,000 bytes, and such a method the JVM never compiles: each row is interpreted.  A projection
    with a higher-order function is generated apart, cut into methods that are compiled.
    """
    return F.transform(F.array(_c(col)), lambda x: x)[0]


def null_tokens(col: Column | str) -> Column:
    """NULL for the NA tokens, the text itself otherwise."""
    c = _c(col)
    return F.when(c.isin(*NULL_TOKENS), F.lit(None).cast("string")).otherwise(c)


def parse_money(col: Column | str) -> Column:
    """Money text such as ``$1,250.00`` to DECIMAL(12,2).

    Takes the text after the first ``$`` (so a sign written before it is
    lost, as in the original), drops thousands separators and casts.  Text
    that is not a number gives NULL instead of failing the job.
    """
    body = F.split_part(_c(col), F.lit("$"), F.lit(2))
    return F.regexp_replace(body, ",", "").try_cast(PRICE_TYPE)


def plain_number(col: Column | str) -> Column:
    """Plain numeric text (no currency sign) to DECIMAL(12,2), NULL if bad."""
    return F.trim(_c(col)).try_cast(PRICE_TYPE)


def price_mixed_format(col: Column | str) -> Column:
    """Price text in either regime: currency text or a plain number.

    The format is detected per value (a ``$`` present or not) instead of
    naming the one snapshot file that carried plain numbers.
    """
    c = _c(col)
    return F.when(F.contains(c, F.lit("$")), parse_money(c)).otherwise(plain_number(c))


def snapshot_date(path: Column | str) -> Column:
    """Snapshot date of a listing file path.

    The base name without extension (``.../2020-07-01.csv``) is the date.
    Files written by a distributed writer sit in a directory named after the
    date (``.../snapshot=2020-07-01/part-0.csv``); that directory is used
    when the base name is not a date.  The base name is cut with
    ``substring_index`` (no regex per row); the regex runs only in the
    fallback and only on the short folder name.  A base name that begins with
    a letter (``part-...``) is no date and is not tried: a failed parse costs
    an exception a row.
    """
    p = _c(path)
    stem = F.substring_index(F.substring_index(p, "/", -1), ".", 1)
    folder = F.substring_index(F.substring_index(p, "/", -2), "/", 1)
    in_folder = F.regexp_extract(folder, r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    return F.coalesce(
        F.when(stem < F.lit("A"), F.try_to_date(stem, "yyyy-MM-dd")),
        F.when(F.instr(p, "/") > 0, F.try_to_date(F.nullif(in_folder, F.lit("")), "yyyy-MM-dd")),
    )


def snapshot_year(path: Column | str) -> Column:
    return F.year(snapshot_date(path)).cast("int")


def snapshot_month(path: Column | str) -> Column:
    return F.month(snapshot_date(path)).cast("int")


def host_city(col: Column | str) -> Column:
    """Upper-cased first comma-separated part of a host location, untrimmed."""
    return F.upper(F.split_part(_c(col), F.lit(","), F.lit(1)))


def norm_key(col: Column | str, trim: bool = False) -> Column:
    """Join key for name lookups: upper case, and trimmed when asked."""
    u = F.upper(_c(col))
    return F.trim(u) if trim else u


def text_or_missing(col: Column | str) -> Column:
    """A missing string as the text ``NaN`` (how the original stored it)."""
    return F.coalesce(_c(col), F.lit(MISSING_TEXT))


def is_true_flag(col: Column | str) -> Column:
    return _c(col) == F.lit("t")


def is_false_flag(col: Column | str) -> Column:
    return _c(col) == F.lit("f")


def not_missing(col: Column | str) -> Column:
    """Neither NULL nor NaN."""
    c = _c(col)
    return c.isNotNull() & ~F.isnan(c)
