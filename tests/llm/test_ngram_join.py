import random
import re

import pytest

from staykit.llm import ngram_join as nj
from staykit.llm.components import connected_components

from text_cases import ODD


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset([tuple(w[i:i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else []))


def brute(rows):
    """(doc_id, copy_id, class_id, n_links) of rows with different ids."""
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = {i: set() for i in ids}
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and 10 * len(x & y) >= 8 * len(x | y):
                links[a].add(b)
                links[b].add(a)
    out = []
    for i in ids:
        seen, todo = {i}, [i]
        while todo:
            for n in links[todo.pop()] - seen:
                seen.add(n)
                todo.append(n)
        copy = min(b for b in ids if b == i or sets[b] and sets[b] == sets[i])
        out.append((i, copy, min(seen), len(links[i])))
    return out


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.999), (0.8, 0.9), (0.95, 0.99)):
        bands, rows = nj.bands_and_rows(threshold, recall)
        assert 1 - (1 - threshold ** rows) ** bands >= recall and bands <= 24


def test_low_thresholds_take_the_bands_they_need():
    for threshold, recall in ((0.2, 0.999), (0.05, 0.99), (1.0, 0.999), (0.3, 0.5)):
        bands, rows = nj.bands_and_rows(threshold, recall)
        assert 1 - (1 - threshold ** rows) ** bands >= recall
    for threshold, recall in ((0, 0.9), (1.1, 0.9), (0.8, 1), (0.8, 0)):
        with pytest.raises(ValueError):
            nj.bands_and_rows(threshold, recall)


@pytest.mark.parametrize("block", [2, 512])
def test_table_against_all_pairs(sample, block):
    docs, rows = sample
    got = sorted(map(tuple, nj.link_documents(docs, block=block).collect()))
    assert got == brute([(r.doc_id, r.text) for r in rows])


def test_group_of_near_copies_in_blocks(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(9)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, nj.link_documents(docs, block=7, recall=0.999999).collect()))
    assert got == brute(rows)


def test_odd_documents(odd):
    rows = {r.doc_id: r for r in nj.link_documents(odd).collect()}
    assert nj.link_documents(odd).count() == len(ODD)
    assert (rows[5].class_id, rows[5].copy_id, rows[5].n_links) == (4, 4, 2)
    assert rows[7].class_id == 6 and rows[7].n_links == 1
    for i in (0, 1, 2, 3, 8, 12):
        assert (rows[i].class_id, rows[i].n_links) == (i, 0)
    assert rows[None].class_id is None


def test_keep_one_of_each(odd, nothing):
    kept = nj.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [-3, 0, 1, 2, 3, 4, 6, 8, 9, 10, 11, 12] and ids.count(None) == 1
    assert nj.keep_one_of_each(nothing).collect() == []
    assert nj.link_documents(nothing).collect() == []


def test_connected_components(spark):
    rng = random.Random(6)
    edges = [(k, k + 1) for k in range(0, 60)] + [(1000, 1000 + k) for k in range(1, 50)]
    edges += [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)] + [(-5, -5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {n: find(n) for e in edges if e[0] != e[1] for n in e}
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


def near(k, words=60):
    """The k-th of near copies: texts of 60 words that differ in one."""
    return " ".join([f"w{i}" for i in range(words)][:-1] + [f"last{k}"])


@pytest.mark.parametrize("ids, want", [
    ([None] * 6, 1),               # near copies without ids
    ([1, 1, 0, 0, None, 1], 1),    # and with ids that repeat
])
def test_one_of_near_copies_stays_whatever_the_ids(spark, ids, want):
    rows = [(i, near(k)) for k, i in enumerate(ids)]
    other = [(1, "another text under an id that repeats"), (None, "another text without an id"), (None, ""), (None, None), (1, ""), (1, "")]
    kept = nj.keep_one_of_each(spark.createDataFrame(rows + other, "doc_id long, text string"))
    got = [tuple(r) for r in kept.collect()]
    copies = [g for g in got if g[1] and g[1].startswith("w0")]
    assert len(copies) == want and copies[0][0] == min((i for i in ids if i is not None), default=None)
    assert sorted((g for g in got if g not in copies), key=repr) == sorted(set(other), key=repr)


def test_many_classes_without_ids(spark):
    rows = [(None, " ".join(f"g{g}w{i}" for i in range(40)) + f" end{k}") for g in range(50) for k in range(3)]
    kept = nj.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.text.split()[0] for r in kept.collect()) == sorted(f"g{g}w0" for g in range(50))
    links = nj.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(links) == 150 and {r.n_links for r in links} == {2} and {r.class_id for r in links} == {None}
