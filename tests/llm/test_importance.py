import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from staykit.llm import importance

from text_cases import ODD, frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, most_words, buckets):
    words = WORD.findall((text or "").translate(LOWER))
    return [zlib.crc32(" ".join(words[i:i + n]).encode()) % buckets for n in range(1, most_words + 1)
            for i in range(len(words) - n + 1)], len(words)


def brute(rows, target, most_words=1, buckets=10_000, percent=10, least_words=20, seed=2024):
    """Rows (id, n_features, weight, score, rank) of (id, text) rows, each by its own definition."""
    own = [features(t, most_words, buckets) for _, t in rows]
    s, t = Counter(b for f, _ in own for b in f), Counter(b for x in target for b in features(x, most_words, buckets)[0])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in s}
    out = []
    for (i, _), (f, n_words) in zip(rows, own):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    pool = sorted((r for r in out if r[4] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): k for k, r in enumerate(pool[:percent * len(pool) // 100], 1)}
    return sorted(((*r[:4], ranks.get(id(r))) for r in out), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"most_words": 3, "buckets": 997, "percent": 35, "least_words": 50, "seed": 7}])
def test_equals_brute_force(spark, sample, options):
    docs, rows = sample
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in rows], [r.text for r in target.collect()], **options)
    assert result(importance.resample(docs, target, **options)) == want
    assert sum(r[4] is not None for r in want) > 5


def test_batch_masks_runs_across_texts():
    texts = ["a b c", "", "b c", "Éa-9\x00z", "c"]
    bucket, owner, n_words = importance.batch_features([t.encode() for t in texts], 3, 1000)
    assert n_words.tolist() == [3, 0, 2, 3, 1]
    for k, t in enumerate(texts):
        assert sorted(bucket[owner == k].tolist()) == sorted(features(t, 3, 1000)[0])


def test_odd_documents(spark, odd):
    target = [None, "", "the same words", "ünï 漢字"]
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(odd, benchmark, percent=60, least_words=4)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert result(got) == brute([(r[0], r[1]) for r in ODD], target, percent=60, least_words=4)
    nulls = [r for r in got.collect() if r.doc_id == 1]
    assert (nulls[0].n_features, nulls[0].weight, nulls[0]["rank"]) == (0, 0, None)


def test_repeated_rows_are_drawn_apart(spark):
    rows = [(None, "one two three")] * 30 + [(1, "one two three")] * 30
    got = importance.resample(frame(spark, [(i, t, "en", "a") for i, t in rows]), spark.createDataFrame([("two",)], "text string"),
                              percent=50, least_words=1)
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == list(range(1, 31))
    assert result(got) == brute(rows, ["two"], percent=50, least_words=1)


def test_equal_scores_spread_over_ranges(spark):
    rows = spark.range(4000).selectExpr("id place", "1 score")
    got = importance.ranked(rows, [F.desc("score")]).orderBy("place").collect()
    assert [r["rank"] for r in got] == list(range(1, 4001))


def test_empty_tables(spark, nothing, odd):
    some = spark.createDataFrame([("two",)], "text string")
    none = spark.createDataFrame([], "text string")
    assert importance.resample(nothing, some).collect() == []
    assert importance.resample(nothing, none).collect() == []
    assert result(importance.resample(odd, none)) == brute([(r[0], r[1]) for r in ODD], [])


def test_gains_need_no_text():
    assert np.array_equal(importance.batch_features([b"", b"\x00 ."], 2, 10)[0], [])
