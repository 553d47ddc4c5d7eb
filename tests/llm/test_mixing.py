import hashlib
import math
import re
from collections import Counter

import pytest

from staykit.llm import mixing

from text_cases import ODD


def drawn(rate, doc_id, seed=1):
    """Copies of a document by plain inversion."""
    parts = math.ceil(rate / mixing.CHUNK)
    total = 0
    for j in range(1, parts + 1):
        digest = hashlib.md5(f"{seed}:copies:{'null' if doc_id is None else doc_id}:{j}".encode()).hexdigest()
        u = (int(digest[:13], 16) + 0.5) / 2 ** 52
        lam, k = rate / parts, 0
        p = s = math.exp(-lam)
        while s <= u and k < 95:
            k += 1
            p *= lam / k
            s += p
        total += k if s > u else 96
    return total


def rates_of(sources, weight, total=None):
    n = Counter(sources)
    w = {s: round(weight(s, c) * 1_000_000) for s, c in n.items()}
    whole = sum(n.values()) if total is None else total
    return {s: whole * w[s] / sum(w.values()) / n[s] for s in n}


def check(docs, rows, weight, **options):
    got = mixing.mix_sources(docs, **options)
    assert got.columns[:-1] == docs.columns
    rates = rates_of([s for _, s in rows], weight, options.get("total"))
    want = Counter()
    for i, s in rows:
        for k in range(drawn(rates[s], i) if rates[s] else 0):
            want[(i, s, k + 1)] += 1
    assert Counter((r.doc_id, r.source, r[len(docs.columns)]) for r in got.collect()) == want
    return got


def test_table_with_default_weights(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.source) for r in docs.select("doc_id", "source").collect()]
    check(docs, rows, lambda s, n: n ** 0.5)


def test_given_weights_and_large_rates(spark):
    rows = [(i, "big" if i % 10 else "small") for i in range(400)] + [(1000 + i, "none") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    got = check(docs, rows, lambda s, n: {"big": 1.0, "small": 3.0}.get(s, 0.0), weights={"big": 1, "small": 3}, total=8000)
    n = Counter(r.source for r in got.collect())
    assert n["none"] == 0 and abs(n["big"] - 2000) < 250 and abs(n["small"] - 6000) < 400


def test_odd_documents(odd, nothing):
    rows = [(r[0], r[3]) for r in ODD]
    check(odd, rows, lambda s, n: n ** 0.5)
    check(odd, rows, lambda s, n: n ** 0.5, total=400)
    assert mixing.mix_sources(nothing).collect() == []


def test_many_sources_without_broadcast(odd, monkeypatch):
    rows = [(r[0], r[3]) for r in ODD]
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    check(odd, rows, lambda s, n: n ** 0.5)


def test_poisson_table(spark):
    from pyspark.sql import functions as F

    for rate in (0.01, 1.0, 16.0):
        sums = spark.range(1).select(mixing.poisson_table(F.lit(rate)).alias("s")).first().s
        assert len(sums) == mixing.PLACES and 1 - sums[-1] < 1e-14
        assert sums[3] == pytest.approx(sum(math.exp(-rate) * rate ** k / math.factorial(k) for k in range(4)))


def test_order_is_shuffled_and_reproducible(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "'s' as source")
    a = [r.doc_id for r in mixing.mix_sources(docs).collect()]
    b = [r.doc_id for r in mixing.mix_sources(docs.repartition(5)).collect()]
    assert a == b
    rising = sum(x < y for x, y in zip(a, a[1:])) / len(a)
    assert 0.45 < rising < 0.55


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert not re.search("Python|Arrow|Pandas|ExistingRDD", mixing.mix_sources(docs)._jdf.queryExecution().toString())


def test_small_weights_keep_their_source(spark):
    rows = [(100 * s + i, f"s{s}") for s in range(20) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    weights = {"s0": 4e-7, **{f"s{s}": 1e-6 for s in range(1, 20)}}
    rates = {r.source: r.rate for r in mixing.source_rates(docs, weights=weights, total=5000).collect()}
    assert rates["s0"] * 20 == pytest.approx(5000 * 0.4 / 19.4) and rates["s3"] * 20 == pytest.approx(5000 / 19.4)
    n = Counter(r.source for r in mixing.mix_sources(docs, weights=weights, total=5000).collect())
    assert 60 < n["s0"] < 150


def test_any_positive_weight_gives_a_rate(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "doc_id long, source string")
    rates = {r.source: r.rate for r in mixing.source_rates(docs, weights={"a": 1.0, "b": 1e-300, "c": 0}).collect()}
    assert rates["a"] == pytest.approx(3.0) and 0 < rates["b"] < 1e-11 and rates["c"] == 0
    assert all(r.rate == 0 for r in mixing.source_rates(docs, weights={}).collect())
    assert all(r.rate == pytest.approx(1.0) for r in mixing.source_rates(docs, alpha=-30).collect())
