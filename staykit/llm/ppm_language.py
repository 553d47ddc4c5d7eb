"""Language identification by prediction by partial matching (PPM).

For every language a tree of byte contexts up to ``order`` bytes is counted
on a bounded sample of labelled documents and then frozen.  A text's score
under a language is the exact number of bits that the tree's coder would
spend on it: at each byte the longest context in the tree codes the byte with
probability n / (N + d), or escapes with d / (N + d) to the context one byte
shorter (N occurrences, d different bytes, escape method C, no exclusion), and
below order 0 every byte costs 8 bits.  Contexts seen only once are left out,
so their order varies.  The language with the fewest bits wins; the score is
its share when the code lengths are taken as likelihoods.

As the statistics are frozen, the bits of a byte depend on the ``order`` bytes
before it only, so they are looked up in tables and summed with numpy.

Null texts and texts without a letter give ``und`` with score 0, and so does
everything when no document is labelled.  Every text starts from a row of line
feeds as context.  Equal scores go to the language first in the alphabet.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_chunks, hash_cut, text_array, text_bytes

UNDETERMINED = "und"
TABLE_LANGUAGES = 8
_tables: dict[str, list["CodeLengths"]] = {}


def held_out(id_col="doc_id"):
    """Documents kept out of training: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_sample(docs: DataFrame, eligible, fit_docs: int = 300, fit_chars: int = 50_000, most_docs: int = 19_200,
               seed: int = 7) -> dict[str, list[bytes]]:
    """Texts of every language that ``lang`` names, by least hash of the id.

    Each language has at most ``fit_docs`` of them, or its share of ``most_docs`` (but
    one at least) once there are more than most_docs / fit_docs languages.  Texts of over
    ``fit_chars`` characters are taken only where a language has no other, and then their
    first ``fit_chars``.  Ids are picked first (only narrow rows are ranked), then their
    texts are fetched.
    """
    rows = docs.select("doc_id", "lang", "text")
    good = eligible & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
    ids = rows.filter(good).select("doc_id", "lang", (F.length("text") > fit_chars).alias("long"),
                                   F.xxhash64(F.lit(seed), "doc_id").alias("h"))
    counts = ids.groupBy("lang").agg(F.count_if(~F.col("long")).alias("short"), F.count_if("long").alias("long")).collect()
    if not counts:
        return {}
    each = max(1, min(fit_docs, most_docs // len(counts)))
    cuts = docs.sparkSession.createDataFrame([(r["lang"], r["short"] == 0, hash_cut(each, r["short"] or r["long"])) for r in counts],
                                             "lang string, long boolean, cut long")
    by_hash = Window.partitionBy("lang").orderBy("h", "doc_id")
    picked = (ids.join(F.broadcast(cuts), ["lang", "long"]).filter("h <= cut").withColumn("k", F.row_number().over(by_hash))
              .filter(F.col("k") <= each).select("doc_id", "lang", "long").limit(each * len(counts)).collect())
    if not picked:
        return {}
    ids = docs.sparkSession.createDataFrame([tuple(r) for r in picked], "doc_id long, lang string, long boolean").distinct()
    texts = (rows.filter(good).withColumn("long", F.length("text") > fit_chars)
             .join(F.broadcast(ids), ["doc_id", "lang", "long"], "left_semi")
             .select("doc_id", "lang", F.substring("text", 1, fit_chars).alias("text")).limit(len(picked)).collect())
    out: dict[str, list[bytes]] = {}
    for r in sorted(texts, key=lambda r: (r.lang, r.doc_id, r.text)):
        out.setdefault(r.lang, []).append(r.text.encode())
    return out


def count_contexts(texts: list[bytes], order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order k: the byte strings of k + 1 bytes (as integers) and their counts."""
    pad = b"\n" * order
    data = np.frombuffer(b"".join(pad + t for t in texts), np.uint8).astype(np.uint64)
    real = np.concatenate([np.r_[np.zeros(order, bool), np.ones(len(t), bool)] for t in texts]) if texts else np.zeros(0, bool)
    out = []
    code = data.copy()
    for k in range(order + 1):
        if k:
            code = code.copy()
            code[k:] |= data[:-k] << np.uint64(8 * k)
        out.append(np.unique(code[real], return_counts=True))
    return out


class CodeLengths:
    """Tables of the bits of a byte class after a context, for several languages at once."""

    def __init__(self, counts: dict[str, list], order: int, least_seen: int = 2):
        self.languages, self.order = sorted(counts), order
        seen = np.zeros(256, bool)
        for per_order in counts.values():
            seen[per_order[0][0].astype(np.int64)] = True
        seen[0x0A] = True
        # bytes that no language has seen share one class: no context holds them
        self.classes = np.zeros(256, np.int64)
        self.classes[seen] = np.arange(1, int(seen.sum()) + 1)
        self.n = n = int(seen.sum()) + 1
        many = len(self.languages)
        bits = np.full((1, n, many), 8.0)  # one row for each context of the order below
        nodes = np.zeros(1, np.int64)      # its number (as base-n integer of classes), sorted
        self.numbers, self.links = [], []
        for k in range(order + 1):
            stats, contexts = [], [np.zeros(1, np.int64)] if not k else []
            for lang in self.languages:
                code, count = counts[lang][k]
                classes = [self.classes[(code >> np.uint64(8 * j)).astype(np.int64) & 255] for j in range(k + 1)]
                context = sum((classes[j] * n ** (j - 1) for j in range(1, k + 1)), np.zeros(len(code), np.int64))
                which, at = np.unique(context, return_inverse=True)
                total = np.bincount(at, count, len(which)).astype(np.int64)
                distinct = np.bincount(at, minlength=len(which))
                kept = total >= least_seen if k else total > 0
                stats.append((which, at, classes[0], count, total, distinct, kept))
                contexts.append(which[kept])
            new = np.unique(np.concatenate(contexts))
            if k:
                shorter = new % n ** (k - 1)
                parent = np.searchsorted(nodes, shorter)
                # from a node of the order below and the byte before it to the longer context, or -1
                link = np.full((len(nodes), n), -1, np.int64)
                link[parent, new // n ** (k - 1)] = np.arange(len(new))
                self.links.append(link.ravel())
                rows = bits[parent]
            else:
                rows = bits
            rows = rows.copy()
            for l, (which, at, symbol, count, total, distinct, kept) in enumerate(stats):
                row = np.searchsorted(new, which[kept])
                rows[row, :, l] += np.log2((total + distinct) / np.maximum(distinct, 1))[kept][:, None]
                here = kept[at]
                rows[np.searchsorted(new, which[at[here]]), symbol[here], l] = np.log2(
                    (total + distinct)[at[here]] / count[here])
            self.numbers.append(rows.astype(np.float32))
            bits, nodes = rows, new
        # rows of all orders on end
        self.base = np.concatenate(([0], np.cumsum([len(r) for r in self.numbers])))
        self.table = np.concatenate([r.reshape(-1, many) for r in self.numbers])
        del self.numbers

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text (rows) under each language (columns)."""
        n_texts, pad = len(offsets) - 1, self.order
        size = np.diff(offsets)
        at = np.arange(len(data)) + np.repeat(pad * np.arange(1, n_texts + 1), size)
        c = np.full(len(data) + pad * (n_texts + 1), self.classes[0x0A], np.int64)
        c[at] = self.classes[data]
        row = np.zeros(len(data), np.int64)  # the row of the longest context so far
        node = np.zeros(len(data), np.int64)
        alive = None
        for k, link in enumerate(self.links, 1):
            before = c[at - k] if alive is None else c[at[alive] - k]
            step = link[node * self.n + before]
            ok = step >= 0
            alive = np.flatnonzero(ok) if alive is None else alive[ok]
            node = step[ok]
            row[alive] = self.base[k] + node
        cost = self.table[row * self.n + c[at]]
        out = np.zeros((n_texts, len(self.languages)))
        full = np.flatnonzero(size)
        if len(full):
            out[full] = np.add.reduceat(cost, offsets[:-1][full], axis=0, dtype=np.float64)
        return out


def fit(samples: dict[str, list[bytes]], order: int = 3) -> dict:
    """Frozen statistics: {"order": ..., "counts": {language: counts of each order}}."""
    return {"order": order, "counts": {lang: count_contexts(texts, order) for lang, texts in samples.items()}}


def code_lengths(model: dict) -> list[CodeLengths]:
    """Tables of a few languages each, in order: their size grows with the contexts times the
    languages of a table, and the bits under a language do not depend on the others."""
    langs = sorted(model["counts"])
    return [CodeLengths({x: model["counts"][x] for x in langs[i:i + TABLE_LANGUAGES]}, model["order"])
            for i in range(0, len(langs), TABLE_LANGUAGES)]


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the id, lang_pred and score.  One pass over the scan, no shuffle."""
    rows = docs.select(id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the fitting sample
    token = uuid.uuid4().hex  # tells this model's tables in a worker from those of another query
    schema = f"`{id_col}` {rows.schema[0].dataType.simpleString()}, lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frozen = shared.value
        if frozen["counts"] and token not in _tables:
            _tables.clear()
            _tables[token] = code_lengths(frozen)
        tables = _tables.get(token)
        languages = sorted(frozen["counts"])
        for batch in batches:
            texts = text_array(batch.column(1))
            data, offsets = text_bytes(texts)
            names, scores = [], []
            for i, j in byte_chunks(offsets):
                letters = [any(map(str.isalpha, t)) for t in texts[i:j].to_pylist()]
                if tables is None:
                    letters = [False] * (j - i)
                else:
                    part, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                    cost = np.hstack([t.score(part, at) for t in tables])
                    best = cost.argmin(axis=1)
                    gap = cost - cost[np.arange(j - i), best][:, None]
                    share = 1 / np.exp2(-np.minimum(gap, 1000)).sum(axis=1)
                for k, ok in enumerate(letters):
                    names.append(languages[best[k]] if ok else UNDETERMINED)
                    scores.append(float(share[k]) if ok else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             [id_col, "lang_pred", "score"])

    return rows.mapInArrow(run, schema)


def identify(docs: DataFrame, order: int = 3, **sample) -> DataFrame:
    """Fit on the documents that are not held out and predict all: doc_id, held_out, lang_pred, score."""
    model = fit(fit_sample(docs, ~held_out(), **sample), order)
    return (predict(docs, model).withColumn("held_out", held_out())
            .select("doc_id", "held_out", "lang_pred", "score"))
