"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

# ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return (fixed values).
SPACES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True

BATCH_BYTES = 1 << 20
_POWER = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder, read back (cuts lineage)."""
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (case-insensitively)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def hash_cut(wanted: int, total: int) -> int:
    """The 64-bit hash below which about twice ``wanted`` of ``total`` rows lie (all, if there are few).

    Sampling for a fit first drops the rows above it where they are read, so
    what is then ordered or collected does not grow with the number of tasks.
    """
    if total <= 4 * wanted + 100:
        return (1 << 63) - 1
    return -(1 << 63) + int((1 << 64) * (2 * wanted + 50) / total)


def filesystem(uri: str):
    """(pyarrow file system, path in it) of a shared folder; plain paths are local."""
    from pyarrow import fs

    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), parsed.path or uri
    return fs.FileSystem.from_uri(uri)


def write_once(folder: str, name: str, chunks) -> tuple[str, int]:
    """Write ``chunks`` of bytes to a file of its own under the shared ``folder``.

    Every task attempt writes under a name of its own, so a retried or
    speculative attempt never touches the file of another; only the file named
    by the attempt whose rows Spark commits is read later.
    """
    file_system, root = filesystem(folder)
    file_system.create_dir(root, recursive=True)
    path, size = f"{root.rstrip('/')}/{name}-{os.urandom(8).hex()}", 0
    with file_system.open_output_stream(path) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    return path.rpartition("/")[2], size


def text_array(column) -> pa.Array:
    """An Arrow string column as one large_string array, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts on end and the offsets of each (views, not copies)."""
    n = len(array)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset:array.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def byte_chunks(offsets: np.ndarray, most: int = BATCH_BYTES):
    """Ranges [i, j) of whole texts with about ``most`` bytes each (one longer text makes its own range)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (in place on a uint64 array)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("p", ())) < n:
        size = max(n, BATCH_BYTES + 1)
        for name, base in (("p", _POWER), ("inverse", pow(_POWER, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["p"], _powers["inverse"]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every white-space separated word, and the index of its text.

    One running polynomial over all bytes gives each word's hash as a
    difference of two prefix sums, so no Python loop runs over words.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = ~IS_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] |= word[cuts]
    last[cuts - 1] |= word[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _power_tables(n)
    running = data.astype(np.uint64)
    running += np.uint64(1)
    running *= power[:n]
    np.cumsum(running, out=running)
    h = running[ends - 1]
    before = running[np.maximum(starts - 1, 0)]
    before[starts == 0] = 0
    h -= before
    h *= inverse[starts]
    h ^= (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix64(h), np.searchsorted(offsets[1:], starts, side="right")


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words, and the index of each one's text.

    A text of 1 to ``width`` - 1 words has one window of all its words; a text
    without words has none.
    """
    words, owner = word_hashes(data, offsets)
    n_texts = len(offsets) - 1
    factor = np.uint64(0xC2B2AE3D27D4EB4F)

    def combined(first: np.ndarray, size: int) -> np.ndarray:
        h = words[first] + np.uint64(size)
        for k in range(1, size):
            h *= factor
            h += words[first + k]
        return mix64(h)

    if len(words) >= width:
        at = np.flatnonzero(owner[:len(words) - width + 1] == owner[width - 1:])
        parts, owners = [combined(at, width)], [owner[at]]
    else:
        parts, owners = [], []
    counts = np.bincount(owner, minlength=n_texts) if len(words) else np.zeros(n_texts, np.int64)
    begin = np.concatenate(([0], np.cumsum(counts)))[:-1]
    for size in range(1, width):
        short = np.flatnonzero(counts == size)
        if len(short):
            parts.append(combined(begin[short], size))
            owners.append(short)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(parts), np.concatenate(owners)


class ChunkIds:
    """Token ids (as bytes of little-endian uint32) of text chunks, bounded in size.

    ``encode_many`` gets a list of unseen chunks and returns the ids of each as
    bytes.  It lives as long as the Python worker, so a chunk that recurs over
    many batches is encoded once; beyond ``limit`` entries what is new is kept
    for one batch only.  ``known`` is a plain dict, for which set differences
    cost in proportion to the set.
    """

    def __init__(self, encode_many, limit: int = 1_000_000):
        self.known: dict[str, bytes] = {}
        self.encode_many, self.limit, self.passing = encode_many, limit, []

    def learn(self, chunks: set) -> None:
        """Make the ids of all ``chunks`` available in ``known`` until the next call."""
        for c in self.passing:
            del self.known[c]
        new = list(chunks.difference(self.known))
        self.passing = new[max(0, self.limit - len(self.known)):]
        self.known.update(zip(new, self.encode_many(new)))

    def ids(self, chunks: list[str], longest: int = 64) -> list[bytes]:
        """The ids of distinct ``chunks``, in their order; of new ones, those of up to ``longest`` characters are kept."""
        out = list(map(self.known.get, chunks))
        at = [k for k, b in enumerate(out) if b is None]
        new = [chunks[k] for k in at]
        got = self.encode_many(new)
        for k, b in zip(at, got):
            out[k] = b
        kept = [(c, b) for c, b in zip(new, got) if len(c) <= longest]
        self.known.update(kept[:max(0, self.limit - len(self.known))])
        return out
