import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from staykit.llm import token_alignment as ta

from text_cases import ODD, frame


@pytest.fixture(scope="module")
def tokenizers():
    return ta.tokenizer_pair(*ta.default_paths())


@pytest.fixture(scope="module")
def libraries():
    """The two libraries on the files that the contract names, and the bytes of their ids."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(x): x for x in shown}
    byte_of.update({chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in shown)})
    return (lambda t: [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(t, add_special_tokens=False).ids],
            lambda t: [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
                       for i in b.encode(t) for p in [b.id_to_piece(i)]])


def brute(libraries, rows):
    """Result rows by trying every pair of tokens near each other."""
    linked, shown = [], []
    for _, text in rows:
        want = b" " + (text or "").encode()
        a, b = (libraries[0](" " + text), libraries[1](text)) if text else ([], [])
        if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            linked.append(Counter())
            shown.append((0, 0, 0, 0, ""))
            continue
        spans = []
        for tokens in (a, b):
            at, out = 0, []
            for i, x in tokens:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        links, low = Counter(), 0
        for i, s, e in spans[0]:
            while spans[1][low][2] <= s:
                low += 1
            k = low
            while k < len(spans[1]) and spans[1][k][1] < e:
                links[i, spans[1][k][0]] += 1
                k += 1
        common = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, at = [], 0
        for end in common:
            groups.append("|".join(",".join(str(i) for i, s, e in x if at <= s and e <= end) for x in spans) if len(common) < 2000
                          else None)
            at = end
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if None not in groups else None
        linked.append(links)
        shown.append((len(a), len(b), len(groups), sum(links.values()), digest))
    count = Counter(p for links in linked for p in links)
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return [(i, *s[:4], sum(t for p, t in links.items() if count[p] == most[p[0]]), sum(t * count[p] for p, t in links.items()), s[4])
            for (i, _), s, links in zip(rows, shown, linked)]


def check(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1:7])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:7] for r in got] == [r[:7] for r in want]
    assert all(w[7] is None or g[7] == w[7] for g, w in zip(got, want))


def test_equals_brute_force(sample, libraries):
    docs, rows = sample
    got = ta.align_documents(docs, block_bytes=200_000)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    check(got.collect(), brute(libraries, [(r.doc_id, r.text) for r in rows]))


def test_odd_documents(odd, libraries):
    """Nulls, empty and long texts, the space mark, control strings, repeated rows and ids."""
    want = brute(libraries, [(r[0], r[1]) for r in ODD])
    check(ta.align_documents(odd).collect(), want)
    check(ta.align_documents(odd, block_bytes=5000, part_chars=300, batch_bytes=1000, piece=7).collect(), want)
    marked = next(r for r in want if r[0] == 8)
    assert marked[1:] == (0, 0, 0, 0, 0, 0, "")


@pytest.mark.parametrize("piece", [1, 2, 3, 5, 16, 10 ** 6])
def test_pieces_stitch_to_the_whole(piece):
    rng = np.random.default_rng(piece)
    for density in (0.1, 0.5, 0.95):
        a = np.append(np.flatnonzero(rng.random(300) < density), 300)
        b = np.append(np.flatnonzero(rng.random(300) < 0.5), 300)
        ia, ib = ta.diagonal_cuts(a, b, piece)
        assert np.all(np.diff(ia + ib)[:-1] == piece) and ia[-1] == len(a) and ib[-1] == len(b)
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        for i, j in zip(ia, ib):
            assert sum(k == 0 for _, k in merged[:i + j]) == i
        of_a, of_b, joint = ta.align(a, b, piece)
        assert of_a.tolist() == [int((b < x).sum()) for x in a]
        assert of_b.tolist() == [int((a < x).sum()) for x in b]
        assert joint.tolist() == [x in set(a.tolist()) for x in b]


def test_parts_have_the_tokens_of_the_text(tokenizers):
    text = "Il était une fois 12 345 mots, d'un coup... a b  c   d_e _ f\n\tg's 漢字 x1 y2 ünï-cödé don't stop" * 40
    for most in (1, 2, 7, 50, 1000):
        parts = ta.text_parts(text, most)
        assert " ".join(parts) == text and (most > 1000 or len(parts) > 1)
        whole, cut = tokenizers.encode([text]), tokenizers.encode(parts)
        assert np.concatenate(cut[0]).tolist() == whole[0][0].tolist()
        assert sum(cut[1], []) == whole[1][0]
    assert ta.text_parts("x" * 100, 10) == ["x" * 100]


def test_fast_tokenizer_has_the_ids_of_the_named_file(tokenizers, libraries):
    odd = ["<|endoftext|> a<|endoftext|>b", " \n\n  x \r\n\t", "".join(map(chr, range(1, 2000))), "🏳️‍🌈     İİ",
           "'s't've'LL 's", "٣ ½ ² Ⅷ 1a", "﻿​­"]
    for text in odd:
        assert tokenizers.encode([text])[0][0].tolist() == [i for i, _ in libraries[0](" " + text)]


def test_hot_pairs_and_empty_table(spark, nothing, libraries):
    rows = [(i, "the same the same" if i % 3 else f"other {i}") for i in range(300)]
    got = ta.align_documents(frame(spark, [(i, t, "en", "a") for i, t in rows]), block_bytes=500)
    check(got.collect(), brute(libraries, rows))
    assert ta.align_documents(nothing).collect() == []
