import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from staykit.llm import ppm_language as ppm

from text_cases import ODD


def brute(texts, text, order):
    counts = defaultdict(lambda: defaultdict(int))
    for x in texts:
        x = b"\n" * order + x
        for i in range(order, len(x)):
            for k in range(order + 1):
                counts[x[i - k:i]][x[i]] += 1
    y, bits = b"\n" * order + text, 0.0
    for i in range(order, len(y)):
        for k in range(order, -1, -1):
            c = counts.get(y[i - k:i])
            if not c or (k and sum(c.values()) < 2):
                continue
            n, d = sum(c.values()), len(c)
            if y[i] in c:
                bits += math.log2((n + d) / c[y[i]])
                break
            bits += math.log2((n + d) / d)
        else:
            bits += 8
    return bits


@pytest.mark.parametrize("order", [0, 1, 2, 4])
def test_code_lengths_are_exact(order):
    samples = {"en": [b"the cat sat on the mat", b"", b"that is the thing"], "de": ["die Straße ist naß".encode(), b"das ist es"]}
    model = ppm.fit(samples, order)
    tables = ppm.CodeLengths(model["counts"], order)
    texts = [b"", b"the", "naß \x00 漢".encode(), b"\n\n", b"that cat is on the street" * 5]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    want = [[brute(samples[lang], t, order) for lang in tables.languages] for t in texts]
    assert np.allclose(tables.score(data, offsets), want, rtol=1e-5, atol=1e-4)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = ppm.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null").collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_documents(odd):
    rows = ppm.identify(odd).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    by_id = {r.doc_id: r for r in rows}
    for i in (1, 2, 3):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[6].lang_pred != "und"


def test_nothing_learned_from_held_out_or_unlabelled(spark):
    docs = spark.createDataFrame([(i, "abc", "xx") for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0] + [(1, "abc", None)],
                                 "doc_id long, text string, lang string")
    assert ppm.fit_sample(docs, ~ppm.held_out()) == {}
    assert {r.lang_pred for r in ppm.identify(docs).collect()} == {"und"}


def test_sample_is_bounded(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"),
                                   F.when(F.col("id") < 450, "a").otherwise("b").alias("lang"))
    got = ppm.fit_sample(docs, F.lit(True), fit_docs=20)
    assert {k: len(v) for k, v in got.items()} == {"a": 20, "b": 20}


def test_every_language_is_learned(spark):
    """Over 64 languages, the rarest in one document, and one whose documents are all long."""
    letters = {f"l{i:02}": [chr(0x4E00 + 8 * i + k) for k in range(8)] for i in range(70)}
    rows = [(lang, "".join(x[(k * k + n) % 8] + x[k % 8] for k in range(40))) for lang, x in letters.items()
            for n in range(1 if lang in ("l03", "l68") else 2)]
    rows += [("long", "wxyz " * 500)] * 2
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, lang string, text string")
    got = ppm.fit_sample(docs, F.lit(True), fit_chars=1000)
    assert set(got) == {*letters, "long"}
    assert max(len(x) for x in got["long"]) == 1000
    found = ppm.predict(docs, ppm.fit(got)).join(docs, "doc_id").collect()
    assert all(r.lang_pred == r.lang for r in found) and len(found) == len(rows)
    # the documents a language gives shrink as languages grow
    assert {len(v) for v in ppm.fit_sample(docs, F.lit(True), fit_chars=1000, most_docs=71).values()} == {1}


def test_empty_table(nothing):
    assert ppm.identify(nothing).collect() == []
