import hashlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from staykit.llm import piece_bpe

from text_cases import ODD


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_bpe.model_path())


def own(text):
    return np.frombuffer(piece_bpe.piece_model(piece_bpe.model_path()).encode_batch([text])[0], "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abcdeinrst  \n\t.,▁é漢😀<0x41>/s\x00")), max_size=60) | st.text(max_size=40))
def test_ids_and_text_equal_the_library(library, text):
    assert own(text) == library.encode(text)
    assert piece_bpe.piece_model(piece_bpe.model_path()).decode(own(text)) == library.decode(own(text))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 300) | st.integers(0, 31_999), max_size=8))
def test_decode_of_any_ids(library, ids):
    assert piece_bpe.piece_model(piece_bpe.model_path()).decode(ids) == library.decode(ids)


def test_runs_of_one_character(library):
    for c in " a=-\n":
        for n in (1, 2, 3, 15, 16, 17, 33, 64, 100):
            assert own(c * n) == library.encode(c * n)


def test_compatibility_equals_merging_again():
    model = piece_bpe.piece_model(piece_bpe.model_path())
    ids = sorted(model.ids.values())
    rng = np.random.default_rng(1)
    for left, right in rng.choice(ids, (4000, 2)).tolist():
        if not model.pieces[right].startswith(piece_bpe.MARK):
            assert model.fits(left, right) == (model.merged(model.pieces[left] + model.pieces[right]) == [left, right])


def test_documents(odd, library):
    rows = piece_bpe.encode_documents(odd).collect()
    assert len(rows) == len(ODD)
    expected = []
    for i, text, *_ in ODD:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)


def test_empty_table(nothing):
    assert piece_bpe.encode_documents(nothing, with_ids=True).collect() == []
