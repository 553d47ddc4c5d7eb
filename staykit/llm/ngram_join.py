"""Similarity join of documents on the Jaccard similarity of their n-gram sets.

Documents with equal sets of word n-grams form a *copy class*; all further
work is on one row a class.  MinHash signatures are cut into bands; the number
of bands and rows is chosen for a target recall at the threshold.  Classes
with an equal band meet by a shuffle on the band's hash, every bucket linking
its classes to the least one, and the connected components of these links are
the groups in which pairs are verified on the full n-gram sets.  A group above
``block`` classes is cut into blocks, and every two blocks are verified in a
task of their own, so no group meets in one task and no pair is left out.

Tasks give no pairs: per class the number of linked documents, and star edges
that span the links found, from which the final classes follow.

The result has a row for each document:

* ``copy_id``: the least doc_id of its copy class;
* ``class_id``: the least doc_id of all documents reached by links;
* ``n_links``: the documents (copies included) at or above the threshold.

Null texts and texts without words link to nothing (class_id and copy_id are
their doc_id).  Texts of fewer than n words have one n-gram of all their
words.  Rows with equal ids and texts are copies of each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_chunks, mix64, shingle_hashes, shuffle_width, text_array, text_bytes, unused_name, written
from .components import apart, connected_components


def bands_and_rows(threshold: float, recall: float, max_bands: int = 24) -> tuple[int, int]:
    """The most rows a band for which at most ``max_bands`` bands reach the recall at the threshold.

    Where not even bands of one row reach it so, they are taken in the number needed."""
    if not (0 < threshold <= 1 and 0 < recall < 1):
        raise ValueError(f"threshold {threshold} must lie in (0, 1], recall {recall} in (0, 1)")
    best = (1, 1)
    for rows in range(1, 33):
        miss = 1 - threshold ** rows
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(miss))) if miss > 0 else 1
        if bands > max_bands and rows > 1:
            break
        best = (bands, rows)
    return best


def distinct_shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes by text (sorted within each) and where each text's begin (n + 1 places)."""
    h, owner = shingle_hashes(data, offsets, width)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    if len(h):
        first = np.concatenate(([True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])))
        h, owner = h[first], owner[first]
    return h, np.searchsorted(owner, np.arange(len(offsets)))


def signatures(h: np.ndarray, begin: np.ndarray, bands: int, rows: int, seed: int) -> tuple[np.ndarray, ...]:
    """(two 64-bit keys of each set, band hashes) of the texts that have n-grams."""
    first = begin[:-1][np.diff(begin) > 0]
    k1 = np.add.reduceat(mix64(h ^ np.uint64(0xA0761D6478BD642F)), first)
    k2 = np.add.reduceat(mix64(h + np.uint64(0xE7037ED1A0B428DB)), first)
    out = np.zeros((len(first), bands), np.uint64)
    factors = mix64(np.arange(1, bands * rows + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)
    for band in range(bands):
        acc = np.full(len(first), band + 1, np.uint64)
        for r in range(rows):
            x = h * factors[band * rows + r]
            x ^= x >> np.uint64(32)
            x *= np.uint64(0x9FB21C651E98DF25)
            acc *= np.uint64(0xC2B2AE3D27D4EB4F)
            acc += np.minimum.reduceat(x, first)
        out[:, band] = mix64(acc)
    return k1.view(np.int64), k2.view(np.int64), out.view(np.int64)


def identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, t (the text) and th, a hash of it: ids may repeat or be null, so a document is known by both."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("id"), text.alias("t"), F.xxhash64(text).alias("th"))


def document_signatures(docs: DataFrame, width: int, bands: int, rows: int, seed: int, id_col: str, text_col: str) -> DataFrame:
    """(id, th, k1, k2, bands) of each document, th a hash of its text; no bands for one without words."""
    table = identified(docs, id_col, text_col).select("id", "t", "th")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(text_array(batch.column(1)))
            for i, j in byte_chunks(offsets, 1 << 18):
                h, begin = distinct_shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], width)
                some = np.diff(begin) > 0
                k1, k2 = np.zeros(j - i, np.int64), np.zeros(j - i, np.int64)
                lists = np.concatenate(([0], np.cumsum(some * bands))).astype(np.int32)
                values = np.zeros(0, np.int64)
                if some.any():
                    k1[some], k2[some], found = signatures(h, begin, bands, rows, seed)
                    values = found.ravel()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], batch.column(2)[i:j], pa.array(k1), pa.array(k2),
                     pa.ListArray.from_arrays(pa.array(lists), pa.array(values))],
                    ["id", "th", "k1", "k2", "bands"])

    return table.mapInArrow(run, "id long, th long, k1 long, k2 long, bands array<long>")


# --- verification ----------------------------------------------------------

def overlaps(h: np.ndarray, owner: np.ndarray, n: int, columns: int = 2048) -> np.ndarray:
    """Sizes of the intersections of ``n`` sets, by products of 0/1 matrices over the shared n-grams."""
    out = np.zeros((n, n), np.float32)
    order = np.argsort(h, kind="stable")
    h, owner = h[order], owner[order]
    new = np.concatenate(([True], h[1:] != h[:-1]))
    number = np.cumsum(new) - 1
    shared = np.bincount(number)[number] > 1
    owner, number = owner[shared], number[shared]
    if not len(owner):
        return out
    number = np.cumsum(np.concatenate(([True], number[1:] != number[:-1]))) - 1
    for c in range(0, int(number[-1]) + 1, columns):
        a, b = np.searchsorted(number, (c, c + columns))
        m = np.zeros((n, columns), np.float32)
        m[owner[a:b], number[a:b] - c] = 1
        out += m @ m.T
    return out


def verify(sets: list[np.ndarray], size: np.ndarray, side: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(documents linked to each set, the least index linked to it over any path) within one group.

    Pairs of different sides are compared, or all pairs when there is one side.
    """
    n = len(sets)
    counts = np.array([len(s) for s in sets], np.float32)
    both = overlaps(np.concatenate(sets), np.repeat(np.arange(n), counts.astype(np.int64)), n)
    linked = both >= np.float32(threshold) * (counts[:, None] + counts[None, :] - both) - np.float32(1e-3)
    close = np.argwhere(linked & (both < np.float32(threshold) * (counts[:, None] + counts[None, :] - both) + np.float32(1e-3)))
    for i, j in close.tolist():  # at the threshold: decide in exact arithmetic
        i_and_j, i_or_j = int(both[i, j]), int(counts[i] + counts[j] - both[i, j])
        linked[i, j] = i_and_j >= threshold * i_or_j
    np.fill_diagonal(linked, False)
    if side.any() and not side.all():
        linked &= side[:, None] != side[None, :]
    documents = linked.astype(np.float64) @ size
    label = np.arange(n)
    while True:  # spread the least index along the links
        low = np.minimum(label, np.where(linked, label[None, :], n).min(axis=1, initial=n))
        low = low[low]
        if (low == label).all():
            return documents.astype(np.int64), label
        label = low


def _groups(batches: Iterator[pa.RecordBatch], width: int):
    """Groups of rows that follow each other: (key, list of (node, k2, size, side, n-gram set))."""
    key, rows = None, []
    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(7)]
        data, offsets = text_bytes(text_array(batch.column(7)))
        for i, j in byte_chunks(offsets, 1 << 18):
            h, begin = distinct_shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], width)
            for k in range(i, j):
                now = (cols[0][k], cols[1][k], cols[2][k])
                if now != key:
                    if rows:
                        yield key, rows
                    key, rows = now, []
                rows.append((cols[3][k], cols[4][k], cols[5][k], cols[6][k], h[begin[k - i]:begin[k - i + 1]].copy()))
    if rows:
        yield key, rows


def _links(groups: DataFrame, width: int, threshold: float) -> DataFrame:
    """Per group and class: k1, k2, documents linked, and a class it is connected with (other)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, width):
            unique = {}
            for k1, k2, size, side, shingles in rows:
                own = mix64(shingles ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64).astype(np.int64)
                if int(own) == k1:  # another text may share the id
                    unique[(k1, k2)] = (size, side, shingles)
            if len(unique) < 2:
                continue
            keys = sorted(unique)
            documents, label = verify([unique[k][2] for k in keys], np.array([unique[k][0] for k in keys], np.float64),
                                      np.array([unique[k][1] for k in keys], bool), threshold)
            some = np.flatnonzero(documents)
            yield pa.RecordBatch.from_pydict(
                {"k1": [keys[i][0] for i in some], "k2": [keys[i][1] for i in some], "links": documents[some],
                 "other": [keys[label[i]][0] for i in some]},
                schema=pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("links", pa.int64()), ("other", pa.int64())]))

    return groups.mapInArrow(run, "k1 long, k2 long, links long, other long")


def link_documents(docs: DataFrame, threshold: float = 0.8, width: int = 5, recall: float = 0.999, block: int = 512,
                   seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The join's result: id, copy_id, class_id, n_links (see the module's text)."""
    linked = linked_rows(docs, threshold, width, recall, block, seed, id_col, text_col)
    return linked.select(F.col("id").alias(id_col), "copy_id", "class_id", "n_links")


def linked_rows(docs: DataFrame, threshold: float = 0.8, width: int = 5, recall: float = 0.999, block: int = 512,
                seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, th, copy_id, class_id, n_links, and whether the row is its class's first (``first_of_class``): that with the
    least id (null last), of equal ids that with the least hash of the text."""
    spark = docs.sparkSession
    n_parts = shuffle_width(spark)
    bands, rows = bands_and_rows(threshold, recall)
    sig = written(spark, document_signatures(docs, width, bands, rows, seed, id_col, text_col), "signatures")

    # one row a copy class
    classes = written(spark, sig.filter(F.size("bands") > 0).groupBy("k1", "k2").agg(
        F.min(F.struct(F.col("id").isNull().alias("no"), "id", "th")).alias("rep"), F.count("*").alias("size"), F.any_value("bands").alias("bands")), "classes")

    # classes that share a band, linked to the least of their bucket
    in_bands = classes.select("k1", F.posexplode("bands").alias("band", "h")).select(
        "k1", F.xxhash64("band", "h").alias("bucket"))
    buckets = (in_bands.groupBy("bucket").agg(F.min("k1").alias("root"), F.max("k1").alias("top"))
               .filter("root <> top").select(apart(F.col("bucket")).alias("b"), "root"))
    edges = (in_bands.join(buckets, F.col("bucket") == F.col("b")).filter("k1 <> root")
             .select(F.col("k1").alias("a"), F.col("root").alias("b")).distinct())
    groups = connected_components(edges)

    # groups above the block size are cut into blocks by hash
    members = classes.select("k1", "k2", "rep", "size").join(groups, F.col("k1") == F.col("node")).drop("node")
    sizes = members.groupBy("component").agg(F.count("*").alias("n")).select(apart(F.col("component")).alias("c"), "n")
    members = members.join(sizes, F.col("component") == F.col("c")).drop("c")
    members = members.withColumn("t", F.ceil(F.col("n") / block).cast("int"))
    members = members.withColumn("own", F.pmod(F.xxhash64("k1", "k2"), F.col("t")).cast("int"))
    texts = identified(docs, id_col, text_col).withColumnRenamed("t", "text")
    members = members.join(texts, F.col("rep.id").eqNullSafe(F.col("id")) & (F.col("rep.th") == F.col("th"))).drop("id", "th")
    pairs = members.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("t") - 1))).select(
        "component", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "k1", "k2", "size",
        (F.col("own") > F.col("o")).alias("side"), "text")
    pairs = pairs.repartition(n_parts, "component", "i", "j").sortWithinPartitions("component", "i", "j")
    links = written(spark, _links(pairs, width, threshold), "links")

    # final classes: least id over everything that links connect
    linked = connected_components(links.select(F.col("k1").alias("a"), F.col("other").alias("b")))
    counts = links.groupBy("k1", "k2").agg(F.sum("links").alias("links"))
    per_class = (classes.select("k1", "k2", "rep", "size")
                 .join(linked.withColumnRenamed("node", "k1"), "k1", "left").join(counts, ["k1", "k2"], "left"))
    least = (per_class.filter("component is not null").groupBy("component").agg(F.min("rep").alias("least"))
             .select(apart(F.col("component")).alias("c"), "least"))
    per_class = per_class.join(least, F.col("component") == F.col("c"), "left").select(
        F.col("k1").alias("c1"), F.col("k2").alias("c2"), F.col("rep.id").alias("copy_id"),
        F.coalesce("least", "rep").alias("least"),
        (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    has_words = F.size("bands") > 0
    out = sig.select("id", "th", "k1", "k2", has_words.alias("w")).join(
        per_class, F.col("w") & (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left")
    first = F.col("id").eqNullSafe(F.col("least.id")) & (F.col("th") == F.col("least.th"))
    return out.select("id", "th", F.coalesce("copy_id", "id").alias("copy_id"), F.coalesce("least.id", "id").alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links"), (~F.col("w") | F.coalesce(first, F.lit(False))).alias("first_of_class"))


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each class: that with the least id (all columns kept).

    Documents are known by id and text, so ids may repeat or be null (null comes last).
    Rows that repeat a document's id and text are one document.
    """
    names = docs.columns
    rank, hashed, kept_id, kept_text = (unused_name(docs, n) for n in ("rank_in_text", "hash_of_text", "kept_id", "kept_text"))
    kept = (linked_rows(docs, **options).filter("first_of_class")
            .select(F.col("id").alias(kept_id), F.col("th").alias(kept_text)).distinct())
    rows = docs.withColumn(hashed, F.xxhash64(F.col("text").cast("string")))
    rows = rows.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col(kept_id)) & (F.col(hashed) == F.col(kept_text)), "left_semi")
    once = Window.partitionBy("doc_id", hashed).orderBy(hashed)
    return rows.withColumn(rank, F.row_number().over(once)).filter(F.col(rank) == 1).select(*names)
