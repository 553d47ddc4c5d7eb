import random
from collections import Counter

import pytest

from staykit.operators.constraints import broken_rules, foreign_key, not_null, repeated_rows
from staykit.plans import quarantine
from staykit.plans.tables import append_table, read_table


def frame(spark, rows, schema="k long, f string, v int"):
    return spark.createDataFrame(rows, schema)


def test_rules_are_named_in_their_order(spark):
    rows = [(1, "a", 1), (None, "x", 1), (2, None, None), (3, "x", 1), (3, "x", 1)]
    parent = frame(spark, [("a",), ("a",), (None,)], "p string")
    got = broken_rules(frame(spark, rows), [not_null("pk", ["k"]), foreign_key("fk", "f", parent, "p"), not_null("v", ["v"])])
    assert Counter((r.k, r.f, tuple(r.broken)) for r in got.collect()) == Counter(
        [(1, "a", ()), (None, "x", ("pk", "fk")), (2, None, ("v",)), (3, "x", ("fk",)), (3, "x", ("fk",))])
    assert got.columns == ["k", "f", "v", "broken"]


def test_no_rules_and_no_rows(spark):
    assert [r.broken for r in broken_rules(frame(spark, [(1, "a", 1)]), []).collect()] == [[]]
    assert broken_rules(frame(spark, []), [not_null("pk", ["k"])]).count() == 0


def test_repeated_rows_against_counting(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 3, 4, 5, 6, 7]), rng.choice("ab"), rng.choice([None, 1, 2])) for _ in range(200)] + [(99, "z", 1)]
    want = Counter(rows)
    order = lambda r: (r[1], (r[2] is not None, r[2] or 0))
    for k in {r[0] for r in rows}:
        want[min((r for r in rows if r[0] == k), key=order)] -= 1
    got = repeated_rows(frame(spark, rows), ["k"])
    assert {tuple(r)[:3]: r.copies for r in got.collect()} == {r: n for r, n in want.items() if n}


def loads(spark, scratch, parts, parents, write=None):
    root = scratch("checked")
    table, held = f"{root}/t", f"{root}/held"

    def add(rows):
        have = read_table(spark, table).select("k") if quarantine.has_data(spark, table) else frame(spark, [], "k long")
        append_table(rows.dropDuplicates(["k"]).join(have, "k", "left_anti"), table)

    for part, parent in zip(parts, parents):
        rules = [not_null("pk", ["k"]), foreign_key("fk", "f", frame(spark, parent, "p string"), "p")]
        quarantine.load_checked(spark, frame(spark, part), quarantine.held_rows(spark, held), held, rules, ["k"], write or add)
    got = lambda p: sorted(tuple(r) for r in read_table(spark, p).select("k", "f", "v").collect())
    return (got(table) if write is None else None), [tuple(r) for r in read_table(spark, held).collect()], root


def test_a_late_parent_releases_its_rows(spark, scratch):
    part = [(1, "a", 1), (2, "b", 1), (3, "c", 1), (None, "a", 1)]
    table, held, _ = loads(spark, scratch, [part, [(4, "b", 2)]], [[("a",)], [("a",), ("b",)]])
    assert table == [(1, "a", 1), (2, "b", 1), (4, "b", 2)]
    assert sorted(h[1:] for h in held) == [("a", 1, ["pk"]), ("c", 1, ["fk"])]


def test_the_same_rows_again_are_held_once(spark, scratch):
    part = [(1, "a", 1), (2, "b", 1), (2, "b", 1)]
    table, held, _ = loads(spark, scratch, [part, part, []], [[("a",)]] * 3)
    assert table == [(1, "a", 1)] and held == [(2, "b", 1, ["fk"])]


def test_a_held_row_gives_way_to_a_good_row_of_its_key(spark, scratch):
    table, held, _ = loads(spark, scratch, [[(1, "b", 1)], [(1, "a", 2)], []], [[("a",)], [("a",)], [("a",), ("b",)]])
    assert table == [(1, "a", 2)] and held == []


def test_a_failed_write_loses_nothing(spark, scratch):
    root = scratch("checked")
    held = f"{root}/held"
    rule = lambda p: [foreign_key("fk", "f", frame(spark, p, "p string"), "p")]
    quarantine.load_checked(spark, frame(spark, [(1, "b", 1)]), None, held, rule([("a",)]), ["k"], lambda rows: None)

    def fail(rows):
        raise OSError("lost")

    with pytest.raises(OSError):
        quarantine.load_checked(spark, frame(spark, []), quarantine.held_rows(spark, held), held, rule([("b",)]), ["k"], fail)
    seen = []
    quarantine.load_checked(spark, frame(spark, []), quarantine.held_rows(spark, held), held, rule([("b",)]), ["k"],
                            lambda rows: seen.extend(map(tuple, rows.collect())))
    assert seen == [(1, "b", 1)] and read_table(spark, held).count() == 0
