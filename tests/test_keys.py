from staykit.operators.keys import (audit_duplicate_key, audit_foreign_key, audit_null_key, first_per_key,
                                    insert_if_absent, key_report, rows_to_add)


def test_first_per_key_total_order_nulls_first(spark):
    df = spark.createDataFrame(
        [(1, "b", 2), (1, "a", 9), (1, None, 5), (2, "z", 1), (2, "z", 0)], "k int, s string, n int")
    got = sorted(tuple(r) for r in first_per_key(df, ["k"]).collect())
    assert got == [(1, None, 5), (2, "z", 0)]
    got = sorted(tuple(r) for r in first_per_key(df, ["k"], order=["n"]).collect())
    assert got == [(1, "b", 2), (2, "z", 0)]


def test_first_per_key_keeps_column_order(spark):
    df = spark.createDataFrame([(5, 1, "x")], "a int, k int, b string")
    assert first_per_key(df, ["k"]).columns == ["a", "k", "b"]


def test_first_per_key_hot_key(spark):
    # one key holds a third of all rows; the aggregate combines map-side
    rows = [(0, i) for i in range(3000)] + [(i, i) for i in range(1, 6001)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(8)
    out = {r.k: r.v for r in first_per_key(df, ["k"]).collect()}
    assert out[0] == 0 and len(out) == 6001


def test_insert_if_absent_existing_wins(spark):
    existing = spark.createDataFrame([(1, "old")], "k int, v string")
    new = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k int, v string")
    got = sorted(tuple(r) for r in insert_if_absent(new, existing, ["k"]).collect())
    assert got == [(1, "old"), (2, "a")]
    assert sorted(tuple(r) for r in rows_to_add(new, existing, ["k"]).collect()) == [(2, "a")]


def test_insert_if_absent_rerun_is_idempotent(spark):
    new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    once = insert_if_absent(new, new.limit(0), ["k"])
    twice = insert_if_absent(new, once, ["k"])
    assert twice.count() == once.count() == 2


def test_audits(spark):
    fact = spark.createDataFrame([(1, "A"), (1, "A"), (2, None), (3, "Z")], "id int, fk string")
    dim = spark.createDataFrame([("A",)], "pk string")
    assert [r.id for r in audit_null_key(fact, ["id", "fk"]).collect()] == [2]
    assert [(r.id, r.fk, r.n_rows) for r in audit_duplicate_key(fact, ["id", "fk"]).collect()] == [(1, "A", 2)]
    assert [(r.fk, r.n_rows) for r in audit_foreign_key(fact, dim, "fk", "pk").collect()] == [("Z", 1)]


def test_foreign_key_audit_counts_before_the_join(spark):
    fact = spark.createDataFrame([(i, "hot" if i % 3 else "A") for i in range(900)], "id int, fk string")
    dim = spark.createDataFrame([("A",)], "pk string")
    out = audit_foreign_key(fact, dim, "fk", "pk")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftAnti") < plan.index("Aggregate [fk")  # the join stands above the counts
    assert [(r.fk, r.n_rows) for r in out.collect()] == [("hot", 600)]


def test_key_report(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, "a"), (2, None), (2, None), (None, None)]
    r = key_report(spark.createDataFrame(rows, "k int, s string"), ["k", "s"]).first().asDict()
    assert r == {"n_rows": 7, "n_null_key": 4, "n_null_k": 2, "n_null_s": 3, "n_duplicate_keys": 1}
    empty = key_report(spark.createDataFrame([], "k int"), ["k"]).first()
    assert tuple(empty) == (0, 0, 0, 0)
