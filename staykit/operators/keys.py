"""Keyed loads and key audits.

* ``first_per_key`` — one row per key, the first in a stated total order
  (the original's "insert, skip on key conflict" kept an arbitrary one).
  It is an aggregate, ``min(struct(order..., rest...))``, not a window, so
  Spark combines map-side before the shuffle and a key holding a third of
  all rows never lands whole in one task.
* ``insert_if_absent`` — append only keys not yet present; the existing row
  wins over the new one.
* ``audit_*`` — the primary/foreign key constraints of the original tables,
  re-aimed as violation reports instead of aborting the load.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FIRST = "__first"
WORDS = 1 << 20  # of 64 bits each, see may_be_held


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Keep, for every key, the row that sorts first.

    The order is ``order`` followed by every other non-key column in frame
    order, ascending with NULLs first, so the choice is total and
    reproducible.  Output columns keep the frame's column order.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordered = list(order) + [c for c in rest if c not in order]
    picked = F.min(F.struct(*[F.col(c) for c in ordered])).alias(_FIRST)
    out = df.groupBy(*keys).agg(picked)
    return out.select(*[F.col(c) if c in keys else F.col(_FIRST)[c].alias(c) for c in df.columns])


def _held_words(held: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column, Column]:
    """(the words with bits of the keys of ``held``, the word of a row's key, its bit)."""
    hashed = F.xxhash64(*[F.col(k) for k in keys])
    place = F.pmod(F.call_function("shiftright", hashed, F.lit(6)), F.lit(WORDS))
    bit = hashed.bitwiseAND(F.lit(63)).cast("int")
    words = (held.select(place.alias("__word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("__bit"))
             .groupBy("__word").agg(F.bit_or("__bit").alias("__bits")))
    return words, place, bit


def _bit_set(bit: Column) -> Column:
    return F.call_function("shiftright", F.col("__bits"), bit).bitwiseAND(F.lit(1)) == 1


def may_be_held(df: DataFrame, held: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    """``df`` with a flag: false only if the key of a row is none of ``held``.

    The keys of ``held`` are hashed into ``WORDS`` words of 64 bits, which are broadcast:
    at most some 30 MB, whatever the number of keys.  So rows can be told apart without
    a shuffle; the few with the flag (more of them as the bits fill up) are then looked at
    exactly.  NULL keys are hashed like values.
    """
    words, place, bit = _held_words(held, keys)
    flag = F.coalesce(_bit_set(bit), F.lit(False))
    return (df.withColumn("__word", place).join(F.broadcast(words), "__word", "left")
            .withColumn(alias, flag).select(*df.columns, alias))


def divided(df: DataFrame, held: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is surely none of ``held``, the others), by the bits of :func:`may_be_held`."""
    words, place, bit = _held_words(held, keys)
    on = (place == F.col("__word")) & _bit_set(bit)
    return df.join(F.broadcast(words), on, "left_anti"), df.join(F.broadcast(words), on, "left_semi")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys held by more than one row (NULL equals NULL)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n")


def first_per_key_split(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """``first_per_key`` of a written table whose keys are nearly all unique.

    The aggregate of ``first_per_key`` sorts whole rows, which is waste where few
    keys have more than one.  Here the keys alone are counted (a hash aggregate on
    narrow rows); rows whose key is surely unique (see :func:`may_be_held`) pass
    through, and only the others are reduced.  So wide rows are not shuffled, however
    many keys are repeated (until they fill the bits, when all rows are reduced); a
    key that holds a third of the rows is combined map-side as before.
    The frame is read three times (the first time its keys only), so it should be a
    table, not a long computation.  NULL keys are equal to each other, as in grouping.
    """
    unique, doubtful = divided(df, repeated_keys(df, keys), keys)
    return unique.unionByName(first_per_key(doubtful, keys, order))


def insert_if_absent(new: DataFrame, existing: DataFrame, keys: Sequence[str],
                     order: Sequence[str] = (), split: bool = False) -> DataFrame:
    """Existing rows plus the first new row of every key not yet present.

    ``split`` says that ``new`` is a written table with few repeated keys."""
    return existing.unionByName(rows_to_add(new, existing, keys, order, split).select(*existing.columns))


def rows_to_add(new: DataFrame, existing: DataFrame, keys: Sequence[str],
                order: Sequence[str] = (), split: bool = False, keyed: bool = False) -> DataFrame:
    """Only the rows ``insert_if_absent`` would append (for append writes).

    ``split`` says that ``new`` is a written table with few repeated keys, ``keyed``
    that it holds one row a key as it is.  With ``split`` rows whose key is surely
    unique and not there yet pass without a shuffle; the others are reduced and compared."""
    held = existing.select(*keys)
    if not split or keyed:
        fresh = new if keyed else first_per_key(new, keys, order)
        return fresh.join(held, on=list(keys), how="left_anti")
    marked = may_be_held(may_be_held(new, repeated_keys(new, keys), keys, "__repeated"), held, keys, "__there")
    passed, doubtful = (marked.filter(c).select(*new.columns) for c in ("not (__repeated or __there)", "__repeated or __there"))
    return passed.unionByName(first_per_key(doubtful, keys, order).join(held, on=list(keys), how="left_anti").select(*new.columns))


def _any_null(keys: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def audit_null_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose primary key has a NULL part."""
    return df.filter(_any_null(keys))


def audit_duplicate_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def audit_foreign_key(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Foreign-key values of ``fact`` absent from ``dim``, with row counts.

    A NULL foreign key is allowed (as in SQL).  Rows are counted per key
    first (combined map-side), so the anti join sees one row a key and a key
    holding a third of the fact costs no more than any other.
    """
    counts = fact.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n_rows"))
    keys = dim.select(F.col(pk).alias(fk)).distinct()
    return counts.join(keys, fk, "left_anti")


def key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of counts for a keyed table: rows, rows with a NULL key part (in
    all and per part), and keys held by more than one row.

    One pass counts the rows of each key; the totals are sums over that.
    """
    keys = list(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return per_key.agg(
        total(F.col("_n")).alias("n_rows"), total(F.when(_any_null(keys), F.col("_n"))).alias("n_null_key"),
        *[total(F.when(F.col(k).isNull(), F.col("_n"))).alias(f"n_null_{k}") for k in keys],
        total(F.when(~_any_null(keys) & (F.col("_n") > 1), F.lit(1))).alias("n_duplicate_keys"))
