"""Document fingerprints by consistent weighted sampling.

A document is a bag of five-word shingles, each weighted by its count.  For
every sample k and shingle s, a hash seeds r and c from Gamma(2, 1) and b from
U(0, 1), and the shingle with weight w gets

    t = floor(ln w / r + b),   ln a = ln c - r (t - b + 1)

The sample is the pair (s, t) with the least a.  Two documents agree in a
sample with the probability of their generalised Jaccard similarity, the sum
of least weights over the sum of largest ones.  A fingerprint is a row of
such samples, 16 bits of hash each in hexadecimal; likeness is the share of
equal samples.

Documents without words have the empty fingerprint: likeness 1 to each other,
0 to others.  Null texts are empty texts.  A text of under five words is one
shingle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix64, shingle_hashes, shuffle_width, text_array, text_bytes, written

SAMPLES = 64
_STEPS = 1 << 16  # of the tables of quantiles
_lookup: list[np.ndarray] = []


def gamma2_quantiles(n: int) -> np.ndarray:
    """Quantiles of Gamma(2, 1) at the middles of ``n`` equal steps (Newton's method on its distribution)."""
    u = (np.arange(n) + 0.5) / n
    # start from the square-root behaviour near 0 and the exponential tail
    x = np.where(u < 0.5, np.sqrt(2 * u), -np.log1p(-u) + 1)
    for _ in range(60):
        tail = np.exp(-x)
        step = (1 - (1 + x) * tail - u) / np.maximum(x * tail, 1e-300)
        x = np.maximum(x - np.clip(step, -1, 0.5 * x), 1e-12)
    return x


def _tables() -> list[np.ndarray]:
    """By 16 bits of hash: ln c, r and 1 - b."""
    if not _lookup:
        quantiles = gamma2_quantiles(_STEPS)
        _lookup.extend(x.astype(np.float32) for x in (np.log(quantiles), quantiles, 1 - (np.arange(_STEPS) + 0.5) / _STEPS))
    return _lookup


def weighted_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles (48 bits), their owners and counts, by owner."""
    h, owner = shingle_hashes(data, offsets)
    keys = np.sort((owner.astype(np.uint64) << np.uint64(48)) | (h >> np.uint64(16)))
    if not len(keys):
        return keys, keys.astype(np.int64), keys.astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    weight = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    return keys & np.uint64((1 << 48) - 1), (keys >> np.uint64(48)).astype(np.int64), weight


def sample(terms: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int, samples: int = SAMPLES,
           seed: int = 1) -> np.ndarray:
    """uint16[n, samples]: the samples of each of ``n`` owners (rows without terms are 0)."""
    out = np.zeros((n, samples), np.uint16)
    if not len(terms):
        return out
    log_c, quantile_r, rest_b = _tables()
    begin = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    size = np.diff(np.append(begin, len(owner)))
    heavy = np.flatnonzero(weight > 1)
    log_w = np.log(weight[heavy]).astype(np.float32)
    base = mix64(terms * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    factors = mix64(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
    for k in range(samples):
        h = base * factors[k]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        fields = h.astype("<u8", copy=False).view("<u2").reshape(-1, 4)
        r, a = quantile_r.take(fields[:, 2]), rest_b.take(fields[:, 1])
        b = 1 - a[heavy]
        a *= r
        np.subtract(log_c.take(fields[:, 3]), a, out=a)
        t = np.zeros(len(heavy), np.float32)
        if len(heavy):
            t = np.floor(log_w / r[heavy] + b)
            a[heavy] -= r[heavy] * t
        least = np.minimum.reduceat(a, begin)
        hit = np.flatnonzero(a == np.repeat(least, size))
        # of equal ones the term that comes first (terms are sorted, so this does not depend on the text)
        which = np.searchsorted(hit, begin)
        at = hit[which]
        level = np.zeros(len(at), np.int64)
        if len(heavy):
            pos = np.searchsorted(heavy, at)
            ok = (pos < len(heavy)) & (heavy[np.minimum(pos, len(heavy) - 1)] == at)
            level[ok] = t[pos[ok]].astype(np.int64)
        signature = mix64(terms[at] * np.uint64(0xC2B2AE3D27D4EB4F) + level.astype(np.uint64) + np.uint64(k))
        out[owner[begin], k] = (signature >> np.uint64(48)).astype(np.uint16)
    return out


def fingerprints(texts: list[str], samples: int = SAMPLES, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(uint16[n, samples], whether each text has words) of whole texts."""
    data, offsets = text_bytes(text_array(pa.array(texts, pa.large_string())))
    out, some = np.zeros((len(texts), samples), np.uint16), np.zeros(len(texts), bool)
    i = 0
    while i < len(texts):  # about 192 KiB of text at once keeps the arrays in cache
        j = max(i + 1, min(len(texts), int(np.searchsorted(offsets, offsets[i] + (3 << 16), side="right")) - 1, i + 60_000))
        terms, owner, weight = weighted_terms(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        out[i:j] = sample(terms, owner, weight, j - i, samples, seed)
        some[i:j] = np.bincount(owner, minlength=j - i) > 0
        i = j
    return out, some


def likeness(a: np.ndarray, a_words: np.ndarray, b: np.ndarray, b_words: np.ndarray) -> np.ndarray:
    share = (a == b).mean(axis=1)
    return np.where(a_words & b_words, share, (a_words == b_words).astype(float))


def as_hex(samples: np.ndarray, words: np.ndarray) -> list[str]:
    rows = samples.astype(">u2").tobytes().hex()
    width = samples.shape[1] * 4
    return [rows[i * width:(i + 1) * width] if w else "" for i, w in enumerate(words)]


def fingerprint_documents(docs: DataFrame, samples: int = SAMPLES, seed: int = 1, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """Per document: the id and its fingerprint (one pass, no shuffle)."""
    rows = docs.select(id_col, text_col)
    schema = f"`{id_col}` {rows.schema[0].dataType.simpleString()}, fingerprint string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, some = fingerprints(text_array(batch.column(1)).to_pylist(), samples, seed)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(as_hex(prints, some), pa.string())], [id_col, "fingerprint"])

    return rows.mapInArrow(run, schema)


# --- a document against an edited copy and its neighbour -------------------

_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compare(ids: list, texts: list[str], nexts: list[str], samples: int, seed: int) -> dict:
    edited = [_edited(t, f) for t, f in zip(texts, nexts)]
    own, own_words = fingerprints(texts, samples, seed)
    ed, ed_words = fingerprints(edited, samples, seed)
    nx, nx_words = fingerprints(nexts[-1:], samples, seed)
    # in a run of neighbours each text's next one is the following row
    nx, nx_words = np.concatenate((own[1:], nx)), np.concatenate((own_words[1:], nx_words))
    return {"doc_id": ids, "n_chars": [len(t) for t in texts],
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
            "fingerprint": as_hex(own, own_words), "edited_fingerprint": as_hex(ed, ed_words),
            "near_edited": likeness(own, own_words, ed, ed_words).tolist(),
            "near_next": likeness(own, own_words, nx, nx_words).tolist()}


def compare_with_next(docs: DataFrame, samples: int = SAMPLES, seed: int = 1) -> DataFrame:
    """Every document's fingerprint against those of its edited text and of the next document.

    The next one is that with the next smaller doc_id (after the last, the
    first); the edited text has the last half of the code points replaced by
    the next text's first ones.  Texts are shuffled once, by range of the id.
    Each task pairs neighbours within its range; the last of each range meets
    the first of the following one in a small table (two rows a task).
    Documents with equal ids follow each other by text; null ids come last.
    """
    spark = docs.sparkSession
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
            .repartitionByRange(shuffle_width(spark), F.col("doc_id").desc_nulls_last())
            .sortWithinPartitions(F.col("doc_id").desc_nulls_last(), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        ids, texts, held, first = [], [], 0, None
        fields = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

        def emit(done: dict, n: int, edge: list, text: list) -> pa.RecordBatch:
            done = done | {"part": [part] * n, "edge": edge, "text": text}
            return pa.RecordBatch.from_pydict(done, schema=arrow)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if first is None:
                    first = (doc_id, text)
                ids.append(doc_id)
                texts.append(text)
                held += len(text)
                if held >= 1 << 20 and len(ids) > 1:
                    n = len(ids) - 1
                    yield emit(_compare(ids[:-1], texts[:-1], texts[1:], samples, seed), n, [None] * n, [None] * n)
                    ids, texts, held = ids[-1:], texts[-1:], len(texts[-1])
        if first is None:
            return
        if len(ids) > 1:
            n = len(ids) - 1
            yield emit(_compare(ids[:-1], texts[:-1], texts[1:], samples, seed), n, [None] * n, [None] * n)
        blank = {f: [None, None] for f in fields}
        yield emit(blank | {"doc_id": [first[0], ids[-1]]}, 2, ["first", "last"], [first[1], texts[-1]])

    arrow = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                       ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                       ("near_next", pa.float64()), ("part", pa.int32()), ("edge", pa.string()), ("text", pa.string())])
    inner = written(spark, rows.mapInArrow(run, _RESULT + ", part int, edge string, text string"), "fingerprints")
    # which range follows which: one row a range, without texts
    order = Window.orderBy("part")
    ranges = inner.filter(F.col("edge") == "last").select("part")
    least = F.min("part").over(order)
    following = ranges.select("part", F.coalesce(F.lead("part").over(order), least).alias("to"))
    last = inner.filter(F.col("edge") == "last").select("part", "doc_id", "text")
    first = inner.filter(F.col("edge") == "first").select(F.col("part").alias("to"), F.col("text").alias("following"))
    pairs = last.join(following, "part").join(first, "to").select("doc_id", "text", "following")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in arrow][:7]
        for batch in batches:
            for row in batch.to_pylist():
                done = _compare([row["doc_id"]], [row["text"]], [row["following"]], samples, seed)
                yield pa.RecordBatch.from_pydict(done, schema=pa.schema([arrow.field(n) for n in names]))

    return inner.filter(F.col("edge").isNull()).drop("part", "edge", "text").unionByName(pairs.mapInArrow(finish, _RESULT))
