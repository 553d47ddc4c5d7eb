import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from staykit.llm import backoff_automaton as lm
from staykit.llm import blocks

from text_cases import ODD, frame

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


class Brute:
    """The smoothed probabilities by their definition, from dictionaries."""

    def __init__(self, texts, order, prior):
        self.order, self.prior, self.count = order, prior, Counter()
        self.n, seen = 0, set()
        for t in texts:
            tokens = ["<"] * (order - 1) + [("w", w) for w in words_of(t)] + [">"]
            for i in range(order - 1, len(tokens)):
                self.n += 1
                seen.add(tokens[i])
                for k in range(1, order + 1):
                    self.count[tuple(tokens[i - k + 1:i + 1])] += 1
                    if k < order:
                        self.count["context", tuple(tokens[i - k:i])] += 1
        self.v = len(seen)

    def p(self, token, context):
        if not context:
            return (self.count[token,] + 0.5) / (self.n + 0.5 * (self.v + 1))
        c = self.count["context", context]
        return (self.count[(*context, token)] + self.prior * self.p(token, context[1:])) / (c + self.prior)

    def score(self, text):
        tokens = ["<"] * (self.order - 1) + [("w", w) for w in words_of(text)] + [">"]
        at = range(self.order - 1, len(tokens))
        return (len(at), sum(self.count[tokens[i],] > 0 for i in at), sum(math.log10(self.p(tokens[i], ())) for i in at),
                sum(math.log10(self.p(tokens[i], tuple(tokens[i - self.order + 1:i]))) for i in at))


def is_held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def best_prior(texts, order):
    """The grid value under which tokens left out of the counts in turn are likeliest, by recounting."""
    total = Counter()
    model = Brute(texts, order, 1.0)
    for t in texts:
        tokens = ["<"] * (order - 1) + [("w", w) for w in words_of(t)] + [">"]
        for i in range(order - 1, len(tokens)):
            chain = [(model.count[tuple(tokens[i - k + 1:i + 1])] - 1, model.count["context", tuple(tokens[i - k + 1:i])] - 1)
                     for k in range(1, order + 1)]
            for m in lm.PRIORS:
                p = (chain[0][0] + 0.5) / (model.n - 1 + 0.5 * (model.v + 1))
                for c, context in chain[1:]:
                    p = (c + m * p) / (context + m)
                total[m] += math.log10(p)
    return max(lm.PRIORS, key=lambda m: total[m])


def check(df, rows, order=2, prior=None):
    prior = prior or best_prior([t for i, t in rows if not is_held_out(i)], order)
    model = Brute([t for i, t in rows if not is_held_out(i)], order, prior)
    want = sorted(((i, is_held_out(i), *model.score(t)) for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[2:]))
    got = sorted(df.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.base_score, r.score))
    assert [tuple(r[:4]) for r in got] == [r[:4] for r in want]
    assert {r.train_tokens for r in got} == {model.n}
    assert np.allclose([r.base_score for r in got], [r[4] for r in want], rtol=1e-9, atol=1e-9)
    assert np.allclose([r.score for r in got], [r[5] for r in want], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("order, prior", [(1, 4.0), (2, None), (4, 0.7)])
def test_equals_brute_force(sample, order, prior):
    docs, rows = sample
    got = lm.score_documents(docs, order, prior, block_bytes=100_000, range_bytes=50_000)
    check(got, [(r.doc_id, r.text) for r in rows], order, prior)


@pytest.mark.parametrize("order", [2, 3])
def test_odd_documents_and_cut_texts(odd, order):
    """Blocks of a few texts, and texts cut into pieces that begin with the words before them."""
    got = lm.score_documents(odd, order, block_bytes=3000, piece_bytes=700, range_bytes=1000)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    check(got, [(r[0], r[1]) for r in ODD], order)


def test_cut_anywhere(spark):
    """Cuts at every small size, words longer than a piece, runs of white space as long as pieces."""
    texts = ["a bb ccc  \t\n     dddddddddddddddd e f g h i", "         x", "x         ", "yyyyyyyyyyyyyyyyyyy", "a b a b a b"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(i + 10, t) for i, t in enumerate(texts)]
    for size in (1, 2, 5, 9):
        got = lm.score_documents(frame(spark, [(i, t, "en", "a") for i, t in rows]), 3, piece_bytes=size, block_bytes=200)
        check(got, rows, 3)


def test_pieces_join_to_the_text():
    data = np.frombuffer(b"one two three   four\nfive sixsixsixsixsix seven", np.uint8)
    got = list(lm.pieces(data, 3, 6))
    assert [p[1] for p in got] == [0, 2, 2, 2, 2][:len(got)] and [p[2] for p in got] == [False] * (len(got) - 1) + [True]
    words = [w for body, lead, _ in got for w in body.split()[lead:]]
    assert words == data.tobytes().split()


def test_probabilities_sum_to_one(sample):
    model = Brute([r.text for r in sample[1]], 3, 2.0)
    tokens = {k[0] for k in model.count if len(k) == 1 and k[0] != "<"}
    some = next(k for k in model.count if len(k) == 3 and k[0] != "context" and "<" not in k)
    unknown = ("w", "not a word")
    assert math.isclose(sum(model.p(t, some[:2]) for t in tokens) + model.p(unknown, some[:2]), 1, rel_tol=1e-9)


def test_lanes_do_not_matter(sample):
    texts = [r.text for r in sample[1]][:40]
    import pyarrow as pa
    table = pa.table({"place": range(40), "id": range(40), "held_out": [i % 5 == 0 for i in range(40)],
                      "lead": pa.array([0] * 40, pa.int32()), "first": [True] * 40, "last": [True] * 40,
                      "text": pa.array([t.lower().encode() for t in texts], pa.large_binary())})
    tokens = lm.Tokens(table, 3)
    model = lm.Automaton(tokens, tokens.own, 1000, 100, 2.0)
    whole = model.scores(10 ** 9)
    for lane in (1, 7, 64):
        assert np.allclose(model.scores(lane), whole, rtol=1e-12)


def test_better_than_its_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = lm.score_documents(docs).filter("held_out").groupBy().sum("score", "base_score").first()
    assert got[0] > got[1]


def test_empty_and_untrained(spark, nothing):
    assert lm.score_documents(nothing).collect() == []
    ids = [i for i in range(40) if is_held_out(i)]
    got = lm.score_documents(frame(spark, [(i, "some words", "en", "a") for i in ids])).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got} == {(3, 0, 0, 0.0, 0.0)}


def test_pack_round_trip():
    for values in ([], [0], [255, 256, 0], [2 ** 64 - 1, 0, 5]):
        x = np.array(values, np.uint64)
        assert np.array_equal(blocks.unpack(blocks.pack(x)), x)
        assert np.array_equal(blocks.unpack_sorted(blocks.pack_sorted(np.sort(x))), np.sort(x))
