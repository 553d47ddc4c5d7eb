"""Target-distribution importance resampling over hashed n-grams.

Documents are drawn so that they resemble a target set (data selection by
importance resampling).  Both sides are bags of hashed n-grams: words are runs
of ASCII digits and letters (A-Z lower-cased) and all characters above ASCII; a
feature is a run of 1 to ``most_words`` consecutive words of one text joined by
one space, and its bucket is the crc32 of its bytes modulo ``buckets``.  The
gain of a bucket is the scaled logarithm of its smoothed share in the target
over that in the documents, a document's weight the sum of the gains of its
features, and adding Gumbel noise made from a hash of its id turns the highest
scores into a draw without replacement in proportion to the weights.

Texts are worked on in batches by concatenation: a batch's texts are joined
with a separator that no word holds, one regular expression pass finds all
words, ``searchsorted`` on the texts' offsets gives each word's text, n-grams
whose ends lie in different texts are masked, and a bincount adds them up.  The
crc32 of an n-gram continues that of the n-gram one word shorter.

Two passes over the texts (counts, then weights), one shuffle of narrow rows by
range of the score.  The driver holds one number a bucket.

Null texts and texts without a word have no features and weight 0.  Ranks go by
score, then id (a null id last; its noise is that of an empty id), then place in
the table, so repeated rows are drawn apart.  Extra columns are ignored.  Empty
tables give no rows, and an empty target counts nothing in every bucket.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from operator import methodcaller
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_chunks, shuffle_width, text_array, text_bytes, written

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # bytes of a word: 0-9, a-z and all of UTF-8 above ASCII
SENTINEL = b"\x00"  # between two texts; no word holds it


def batch_features(texts: list[bytes], most_words: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature, index of its text, words of each text) of a batch of texts."""
    joined = SENTINEL.join(texts).lower()  # of bytes: A-Z only
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(size + 1) - (size + 1)
    found = list(WORD.finditer(joined))
    starts = np.fromiter(map(methodcaller("start"), found), np.int64, len(found))
    owner = np.searchsorted(begins, starts, side="right") - 1
    words = list(map(methodcaller("group"), found))
    codes = list(map(crc32, words))
    all_codes, owners = [np.array(codes, np.uint32)], [owner]
    following = words
    for n in range(2, most_words + 1):
        if n == 2:
            following = [b" " + w for w in words]
        codes = list(map(crc32, following[n - 1:], codes))
        inside = owner[:len(codes)] == owner[n - 1:]
        all_codes.append(np.array(codes, np.uint32)[inside])
        owners.append(owner[:len(codes)][inside])
    return (np.concatenate(all_codes).astype(np.int64) % buckets, np.concatenate(owners),
            np.bincount(owner, minlength=len(texts)))


def _batches(batch: pa.RecordBatch, column: int):
    """(i, j, texts i to j in bytes) of about a megabyte each."""
    texts = text_array(batch.column(column))
    binary = texts.cast(pa.large_binary())
    for i, j in byte_chunks(text_bytes(texts)[1]):
        yield i, j, binary[i:j].to_pylist()


def bucket_counts(rows: DataFrame, text_col: str = "text", most_words: int = 1, buckets: int = 10_000) -> DataFrame:
    """How many features of all texts fall in each bucket: bucket, n (buckets without any are left out).

    A task adds up its own texts and gives at most one row a bucket.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, texts in _batches(batch, 0):
                total += np.bincount(batch_features(texts, most_words, buckets)[0], minlength=buckets)
        which = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": which, "n": total[which]})

    partial = rows.select(text_col).mapInArrow(run, "bucket long, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(documents: DataFrame, target: DataFrame, buckets: int = 10_000) -> np.ndarray:
    """The gain of every bucket, from the bucket counts of both sides (at most one row a bucket each)."""
    def counts(df: DataFrame) -> list[int]:
        n = [0] * buckets
        for r in df.limit(buckets).collect():
            n[r.bucket] = r.n
        return n

    s, t = counts(documents), counts(target)
    s_all, t_all = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(1000 * math.log((b + 1.0) * s_all / ((a + 1.0) * t_all))) for a, b in zip(s, t)], np.int64)


def document_weights(docs: DataFrame, gains: np.ndarray, most_words: int = 1, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per document: its place in the table (``place``), the id column, n_words, n_features and weight."""
    rows = docs.select(id_col, text_col)
    buckets = len(gains)
    schema = (f"place long, `{id_col}` {rows.schema[0].dataType.simpleString()}, "
              "n_words long, n_features long, weight long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place = TaskContext.get().partitionId() << 36
        for batch in batches:
            for i, j, texts in _batches(batch, 1):
                n = j - i
                bucket, owner, n_words = batch_features(texts, most_words, buckets)
                weight = np.bincount(owner, gains[bucket], n)  # whole numbers far below 2^53
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(place, place + n)), batch.column(0)[i:j], pa.array(n_words),
                     pa.array(np.bincount(owner, minlength=n)), pa.array(weight.astype(np.int64))],
                    ["place", id_col, "n_words", "n_features", "weight"])
                place += n

    return rows.mapInArrow(run, schema)


def gumbel_noise(id_col: str, seed: int):
    """floor(-1000 * ln(-ln(u))) of a number u in (0, 1) taken from a hash of the id."""
    label = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(label.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, by: list, place: str = "place", name: str = "rank") -> DataFrame:
    """``rows`` with their rank (1, 2, 3 ...) in the order ``by``, ending with the unique ``place``.

    Rows are dealt by range of that order and written with the number of their
    range; a range's rank begins after the rows of all ranges before it, and the
    only window without a key sees one row a range.
    """
    spark = rows.sparkSession
    order = [*by, F.col(place)]
    dealt = written(spark, rows.repartitionByRange(shuffle_width(spark), *order)
                    .withColumn("_range", F.spark_partition_id()), "ranked")
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_range").orderBy(*order)
    return (dealt.join(bases, "_range").withColumn(name, F.col("_base") + F.row_number().over(within))
            .drop("_range", "_base"))


def resample(docs: DataFrame, target: DataFrame, most_words: int = 1, buckets: int = 10_000, percent: int = 10,
             least_words: int = 20, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text") -> DataFrame:
    """Every document's id, n_features, weight, score and rank.

    Of the N documents with ``least_words`` words or more, floor(percent * N / 100)
    are drawn, the highest scores first; ``rank`` is their place in the draw
    and null for all others.
    """
    gains = bucket_gains(bucket_counts(docs, text_col, most_words, buckets),
                         bucket_counts(target, target_text_col, most_words, buckets), buckets)
    scored = document_weights(docs, gains, most_words, id_col, text_col)
    scored = written(docs.sparkSession, scored.withColumn("score", F.col("weight") + gumbel_noise(id_col, seed)), "importance")
    eligible = F.col("n_words") >= least_words
    n_drawn = scored.filter(eligible).count() * percent // 100
    drawn = F.when(F.col("rank") <= n_drawn, F.col("rank"))
    in_order = ranked(scored.filter(eligible), [F.desc("score"), F.asc_nulls_last(id_col)]).withColumn("rank", drawn)
    rest = scored.filter(~eligible).withColumn("rank", F.lit(None).cast("long"))
    return in_order.unionByName(rest).select(id_col, "n_features", "weight", "score", "rank")
