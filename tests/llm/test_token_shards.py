import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from staykit.llm import token_shards as ts

from text_cases import ODD


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(ts.tokenizer_path())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("abT  \n\t.,'sé漢!*12　 ")), max_size=40) | st.text(max_size=30), max_size=4))
def test_ids_equal_the_library(library, texts):
    got = ts.word_encoder(ts.tokenizer_path()).encode_batch(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_strings_of_special_tokens(library):
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|>b c", "plain <|endoftex|> words", " <|endoftext|><|endoftext|> "]
    for plain in (False, True):
        library.encode_special_tokens = plain
        got = ts.word_encoder(ts.tokenizer_path(), plain).encode_batch(texts)
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert (50256 in np.frombuffer(got[0], "<u4")) != plain
    library.encode_special_tokens = False


def test_line_feeds_between_words(library):
    gaps = ["\n", "\n\n", " \n", "\n ", "\r\n", "\n\t", "\t\n", "\n\u3000", "\u3000\n", ".\n", "\n.", "\n's ", ",\n'", " ", "  ", "\n\n\n"]
    ends = ["", "\n", " ", "x", "é.", "漢", "7", "!?"]
    texts = [a + "word" + g + b for g in gaps for a in ends for b in ends] + [g.join(["one", "two.", "three"]) for g in gaps]
    texts += ["", "\n", " ", "a\n<|endoftext|> b\nc", "x" * 300 + "\n" + "y" * 300 + " z"]
    got = ts.WordEncoder(ts.tokenizer_path()).encode_batch(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_words_around_line_feeds_are_encoded_once(library):
    encoder, sent = ts.WordEncoder(ts.tokenizer_path()), []
    whole = encoder._whole
    encoder._whole = lambda texts: sent.extend(texts) or whole(texts)
    words = ["w" + chr(97 + k // 26) + chr(97 + k % 26) for k in range(60)]
    texts = ["first " + " ".join(f"{a}.\n{b}" for b in words) + " end" for a in words]
    got = encoder.encode_batch(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert sum(map(len, sent)) < sum(map(len, texts)) / 20


def test_long_words_are_not_kept(library):
    encoder = ts.WordEncoder(ts.tokenizer_path())
    text = "a " + "漢" * 65 + " b " + "漢" * 64
    for _ in range(2):
        got = encoder.encode_batch([text])
        assert np.frombuffer(got[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert "漢" * 64 in encoder.words.known and "漢" * 65 not in encoder.words.known


def shard_of(docs, terminals):
    tokens = np.array([t for d in docs for t in d], np.uint32)
    return ts.Shard(ts.shard_bytes(np.arange(len(docs)), tokens, np.array([len(d) for d in docs]), terminals))


def test_round_trip_and_random_access():
    rng = random.Random(3)
    phrases = [[rng.randrange(50) for _ in range(rng.randint(2, 9))] for _ in range(30)]
    docs = [[t for _ in range(rng.randint(0, 60)) for t in rng.choice(phrases)] + [2] for _ in range(300)]
    docs += [[7] * 5000 + [2], [2], [1, 2]]
    shard = shard_of(docs, 64)
    assert len(shard.rules) > 10 and len(shard.symbols) < sum(map(len, docs)) / 2
    assert [t.tolist() for _, t in shard.documents()] == docs
    for _ in range(500):
        d = rng.randrange(len(docs))
        a = rng.randint(0, len(docs[d]))
        b = rng.randint(a, len(docs[d]))
        assert shard.tokens(d, a, b).tolist() == docs[d][a:b]
    assert shard.tokens(300).tolist() == docs[300]


@pytest.mark.parametrize("terminals", [40, 65_530, 70_000])
def test_pairs_of_more_symbols_than_16_bits(terminals):
    rng = random.Random(5)
    phrases = [[rng.randrange(terminals) for _ in range(8)] for _ in range(20)]
    docs = [[t for _ in range(20) for t in rng.choice(phrases)] for _ in range(300)]
    docs += [list(range(terminals)), [terminals - 1] * 100]
    shard = shard_of(docs, terminals)
    assert len(shard.rules) > 20 and len(shard.symbols) < terminals + 20_000
    assert [t.tolist() for _, t in shard.documents()] == docs


def test_pairs_never_span_documents():
    docs = [[5, 2]] * 400
    shard = shard_of(docs, 8)
    assert [t.tolist() for _, t in shard.documents()] == docs
    assert all(2 not in r[:1] for r in shard.rules.tolist())


def expected(rows, library):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out, start = [], 0
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_documents(odd, library):
    got = ts.token_index(odd, shard_tokens=2_000).collect()
    assert sorted(map(tuple, got), key=repr) == expected([(r[0], r[1]) for r in ODD], library)


def test_table(sample, library):
    docs, rows = sample
    got = ts.token_index(docs, shard_tokens=30_000).collect()
    assert sorted(map(tuple, got), key=repr) == expected([(r.doc_id, r.text) for r in rows], library)


def test_empty_table(nothing):
    assert ts.token_index(nothing).collect() == []
