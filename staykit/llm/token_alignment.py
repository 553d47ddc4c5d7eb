"""Cross-tokenizer alignment by merge-path partitioning.

Two tokenizers cut the same bytes: A (byte-level BPE, a table of ranks) and B (a
piece model).  The ends of A's and B's tokens are two ascending lists, and merging
them aligns the tokens.  The merge is divided by diagonals of equal distance: on
each, a binary search finds how many of its steps come from A and how many from B,
for all diagonals at once.  The pieces between diagonals are of equal work and
independent; each finds the pairs of tokens whose bytes overlap and the places where
both lists end a token.  An end of both that a diagonal has parted is stitched: a
piece whose first B end equals the A end before it closes that group.

A link is a pair of overlapping tokens; groups are what common ends cut.  A link's
count is the number of documents in the corpus that hold its pair of ids linked.
Documents are cut into blocks (files in the shared folder) which list their different
pairs; pairs are counted over all blocks, and the counts go back to the blocks that
asked, so no table of pairs has to fit a worker, and a pair that is in every document
is one row a block.

Texts longer than ``PART_CHARS`` are worked on in parts.  They are cut at a single
space between two letters or digits, where both tokenizers always end a token and begin
the next with that space, so parts give the tokens of the whole text.

Texts that are null or empty, or whose tokens do not spell a space and the text, have
no tokens: zeros, and '' for the digest.  (B spells its space mark as a space, so texts
that hold the mark are such.)  Each row is a document; a null id is kept; repeated rows
count each.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .blocks import load_block, save_block
from .common import text_array, written

MARK = "▁"  # B's space mark (fixed value)
PART_CHARS = 1 << 18
BATCH_BYTES = 1 << 20
BLOCK_BYTES = 16 << 20
PIECE = 1 << 15  # steps of the merge between two diagonals
SAFE_CUT = re.compile(r"(?<=[^\W_]) (?=[^\W_])")
_pairs: dict[tuple[str, str], "TokenizerPair"] = {}


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


class Spelling:
    """The bytes of every token id."""

    def __init__(self, entries: list[bytes]):
        self.flat = np.frombuffer(b"".join(entries), np.uint8)
        self.size = np.array([len(e) for e in entries], np.int64)
        self.at = np.cumsum(self.size) - self.size

    def spell(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all tokens on end, their ends)."""
        size = self.size[ids]
        ends = np.cumsum(size)
        where = np.repeat(self.at[ids] - (ends - size), size)
        where += np.arange(len(where))
        return self.flat[where], ends


class TokenizerPair:
    """Tokenizers A and B, and the texts of their ids in a digest (with the mark that follows)."""

    def __init__(self, a_path: str, b_path: str):
        import base64

        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(a_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.a = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        entries = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            entries[rank] = token
        self.a_spelling = Spelling(entries)
        n = self.b.get_piece_size()
        self.b_spelling = Spelling([bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i)
                                    else self.b.id_to_piece(i).replace(MARK, " ").encode() for i in range(n)])
        self.n_a, self.n_b = len(entries), n
        self.marked = [f"{i}{mark}".encode() for size, marks in ((self.n_a, ",|"), (n, ",;")) for mark in marks for i in range(size)]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[list[int]]]:
        """A's ids of a space and each text, and B's ids of each text (which adds the space)."""
        return [self.a.encode_to_numpy(" " + t, disallowed_special=()) for t in texts], self.b.encode(texts, num_threads=1)


def tokenizer_pair(a_path: str, b_path: str) -> TokenizerPair:
    """The tokenizers of this Python worker (read once)."""
    if (a_path, b_path) not in _pairs:
        _pairs[a_path, b_path] = TokenizerPair(a_path, b_path)
    return _pairs[a_path, b_path]


# --- the merge -------------------------------------------------------------

def diagonal_cuts(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of the first ``piece``, 2 ``piece`` ... steps of the merge of two ascending lists come from each.

    Of equal values A's comes first.  All diagonals are searched at once.
    """
    d = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(d - len(b), 0), np.minimum(d, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        take = np.zeros(len(d), bool)
        take[open_] = a[middle[open_]] <= b[d[open_] - 1 - middle[open_]]
        low, high = np.where(open_ & take, middle + 1, low), np.where(open_ & ~take, middle, high)
    return low, d - low


def piece_overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one piece: the B token that holds each A token's last byte, the A token that holds
    each B token's last byte, and whether that A token ends there, too."""
    of_a = np.searchsorted(b, a)
    of_b = np.searchsorted(a, b)
    joint = np.zeros(len(b), bool)
    inside = of_b < len(a)
    joint[inside] = a[of_b[inside]] == b[inside]
    return of_a, of_b, joint


def align(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``piece_overlaps`` of two whole lists of ends, piece by piece."""
    of_a, of_b, joint = np.empty(len(a), np.int64), np.empty(len(b), np.int64), np.empty(len(b), bool)
    ia, ib = diagonal_cuts(a, b, piece)
    for i, i2, j, j2 in zip(ia[:-1].tolist(), ia[1:].tolist(), ib[:-1].tolist(), ib[1:].tolist()):
        x, y, both = piece_overlaps(a[i:i2], b[j:j2])
        of_a[i:i2], of_b[j:j2], joint[j:j2] = x + j, y + i, both
        if i and j < j2 and a[i - 1] == b[j]:  # a common end on both sides of the diagonal
            of_b[j], joint[j] = i - 1, True
    return of_a, of_b, joint


class Aligned:
    """Per text: numbers of tokens, groups and links, the digest's bytes, and the different pairs
    (A id times B's number of ids, plus B id; ascending) with how often each is linked."""

    def __init__(self, tokenizers: TokenizerPair, texts: list[str], piece: int = PIECE):
        n = len(texts)
        a_lists, b_lists = tokenizers.encode(texts)
        a_size = np.fromiter(map(len, a_lists), np.int64, n)
        b_size = np.fromiter(map(len, b_lists), np.int64, n)
        a = np.concatenate([np.zeros(0, np.uint32), *a_lists]).astype(np.int64)
        b = np.fromiter(chain.from_iterable(b_lists), np.int64, int(b_size.sum()))
        a_doc, b_doc = np.repeat(np.arange(n), a_size), np.repeat(np.arange(n), b_size)
        self.good = self._spelled(tokenizers, texts, a, b, a_size, b_size)
        if not self.good.all():
            kept_a, kept_b = self.good[a_doc], self.good[b_doc]
            a, a_doc, b, b_doc = a[kept_a], a_doc[kept_a], b[kept_b], b_doc[kept_b]
            a_size, b_size = a_size * self.good, b_size * self.good
        ends_a, ends_b = np.cumsum(tokenizers.a_spelling.size[a]), np.cumsum(tokenizers.b_spelling.size[b])
        of_a, of_b, joint_b = align(ends_a, ends_b, piece)
        joint_a = np.zeros(len(a), bool)
        joint_a[of_b[joint_b]] = True
        self.n_a, self.n_b = a_size, b_size
        self.n_groups = np.bincount(b_doc[joint_b], minlength=n)
        # links: one for every end of a token, common ends give one
        single = ~joint_b
        code = np.concatenate([a * tokenizers.n_b + b[of_a], a[of_b[single]] * tokenizers.n_b + b[single]])
        code += np.concatenate([a_doc, b_doc[single]]) * (tokenizers.n_a * tokenizers.n_b)
        pairs, self.times = np.unique(code, return_counts=True)
        doc, self.pairs = np.divmod(pairs, tokenizers.n_a * tokenizers.n_b)
        self.n_pairs = np.bincount(doc, minlength=n)
        self.n_links = np.bincount(doc, self.times, n).astype(np.int64)
        # the order of a digest: each group's A tokens, then its B tokens
        first_b = np.concatenate(([0], np.flatnonzero(joint_b) + 1))
        last_a = np.flatnonzero(joint_a) + 1
        place_a = np.arange(len(a)) + first_b[np.cumsum(joint_a) - joint_a]
        place_b = np.arange(len(b)) + last_a[np.cumsum(joint_b) - joint_b]
        label = np.empty(len(a) + len(b), np.int64)
        label[place_a] = a + tokenizers.n_a * joint_a
        label[place_b] = 2 * tokenizers.n_a + b + tokenizers.n_b * joint_b
        cuts = np.concatenate(([0], np.cumsum(a_size + b_size))).tolist()
        spelled = list(map(tokenizers.marked.__getitem__, label.tolist()))
        self.digest_bytes = [b"".join(spelled[i:j]) for i, j in zip(cuts[:-1], cuts[1:])]

    @staticmethod
    def _spelled(tokenizers: TokenizerPair, texts, a, b, a_size, b_size) -> np.ndarray:
        """Which texts both token lists spell, after a space.  Batches without a fault need one comparison a list."""
        raw = [t.encode() for t in texts]
        want = np.frombuffer(b"".join(chain.from_iterable((b" ", r) for r in raw)), np.uint8)
        good = np.ones(len(texts), bool)
        size = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
        begin = np.cumsum(size) - size
        for spelling, ids, counts in ((tokenizers.a_spelling, a, a_size), (tokenizers.b_spelling, b, b_size)):
            got, ends = spelling.spell(ids)
            if np.array_equal(got, want):
                continue
            to = np.concatenate(([0], ends))[np.cumsum(counts)]
            for k, (i, j) in enumerate(zip(np.concatenate(([0], to[:-1])).tolist(), to.tolist())):
                good[k] &= np.array_equal(got[i:j], want[begin[k]:begin[k] + size[k]])
        return good


def text_parts(text: str, most: int = PART_CHARS) -> list[str]:
    """A text cut at spaces that are certain to begin tokens of both tokenizers (and are left out)."""
    parts, begin = [], 0
    while len(text) - begin > most:
        cut = SAFE_CUT.search(text, begin + most)
        if cut is None:
            break
        parts.append(text[begin:cut.start()])
        begin = cut.end()
    return [*parts, text[begin:]] if begin else [text]


class Document:
    """Results of one document, added up over its parts."""

    def __init__(self):
        self.good, self.numbers, self.digest, self.pending = True, np.zeros(4, np.int64), hashlib.sha256(), b""
        self.pairs, self.times, self.held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0

    def add(self, numbers, digest_bytes: bytes, pairs: np.ndarray, times: np.ndarray, good: bool) -> None:
        self.good &= good
        if not self.good:
            return
        self.numbers += numbers
        self.digest.update(self.pending + digest_bytes[:-1])
        self.pending = digest_bytes[-1:]  # no mark after the last group
        self.pairs.append(pairs)
        self.times.append(times)
        self.held += len(pairs)
        if self.held > 1 << 20:
            self.settle()

    def settle(self) -> None:
        if len(self.pairs) > 2:
            pairs, at = np.unique(np.concatenate(self.pairs), return_inverse=True)
            self.times = [np.bincount(at, np.concatenate(self.times), len(pairs)).astype(np.int64)]
            self.pairs, self.held = [pairs], 0

    def result(self) -> tuple:
        """(n_a, n_b, n_groups, n_links, digest, pairs, times)"""
        if not self.good or not self.numbers[0]:
            none = np.zeros(0, np.int64)
            return 0, 0, 0, 0, "", none, none
        self.settle()
        return *self.numbers.tolist(), self.digest.hexdigest(), self.pairs[-1], self.times[-1]


def align_texts(tokenizers: TokenizerPair, texts: Iterator[str | None], part_chars: int = PART_CHARS,
                batch_bytes: int = BATCH_BYTES, piece: int = PIECE) -> Iterator[tuple]:
    """The result of each text, in order.  Short texts share a batch, long ones take several."""
    waiting: list[tuple[Document, str, bool]] = []
    held = 0

    def work() -> Iterator[tuple]:
        nonlocal held
        got = Aligned(tokenizers, [part for _, part, _ in waiting], piece)
        cuts = np.concatenate(([0], np.cumsum(got.n_pairs))).tolist()
        numbers = np.stack([got.n_a, got.n_b, got.n_groups, got.n_links], axis=1)
        for k, (document, _, last) in enumerate(waiting):
            document.add(numbers[k], got.digest_bytes[k], got.pairs[cuts[k]:cuts[k + 1]], got.times[cuts[k]:cuts[k + 1]],
                         bool(got.good[k]))
            if last:
                yield document.result()
        waiting.clear()
        held = 0

    for text in texts:
        document = Document()
        if not text:
            document.good = False
            if not waiting:
                yield document.result()
            else:
                waiting.append((document, "", True))
            continue
        parts = text_parts(text, part_chars)
        for k, part in enumerate(parts, 1):
            waiting.append((document, part, k == len(parts)))
            held += len(part)
            if held >= batch_bytes:
                yield from work()
    if waiting:
        yield from work()


# --- Spark -----------------------------------------------------------------

LISTS = pa.schema([("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                   ("groups_sha256", pa.string()), ("pairs", pa.large_list(pa.int64())), ("times", pa.large_list(pa.int64()))])


def write_blocks(rows: DataFrame, folder: str, paths: tuple[str, str], block_bytes: int, options: dict) -> DataFrame:
    """Align (id, text) rows and write the results as blocks: block, file, and the different pairs in
    the block with the number of documents in it that hold each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizers = tokenizer_pair(*paths)
        block, held = TaskContext.get().partitionId() << 24, 0
        ids: list = []
        results: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal block, held
            lists = [pa.LargeListArray.from_arrays(np.cumsum([0] + [len(r[k]) for r in results]),
                                                   np.concatenate([r[k] for r in results])) for k in (5, 6)]
            cols = [pa.array([r[k] for r in results]) for k in range(5)]
            table = pa.table([pa.array(ids, pa.int64()), *cols, *lists], schema=LISTS)
            plain = {"pairs.list.element": "DELTA_BINARY_PACKED", "times.list.element": "DELTA_BINARY_PACKED"}
            name = save_block(folder, f"links-{block:015x}", table, use_dictionary=False, column_encoding=plain)
            pairs, n_docs = np.unique(np.concatenate([r[5] for r in results]), return_counts=True)
            out = pa.RecordBatch.from_pydict({"block": [block], "file": [name], "pairs": [pairs], "n_docs": [n_docs]})
            block, held = block + 1, 0
            ids.clear()
            results.clear()
            return out

        for batch in batches:
            texts = text_array(batch.column(1))
            doc_ids = batch.column(0).to_pylist()
            strings = (t.as_py() for t in texts)
            for doc_id, result in zip(doc_ids, align_texts(tokenizers, strings, **options)):
                ids.append(doc_id)
                results.append(result)
                held += 8 * len(result[5]) // 3 + 64  # about the bytes of its text
                if held >= block_bytes:
                    yield flush()
        if ids:
            yield flush()

    return rows.mapInArrow(run, "block long, file string, pairs array<long>, n_docs array<long>")


def align_documents(docs: DataFrame, paths: tuple[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text",
                    block_bytes: int = BLOCK_BYTES, **options) -> DataFrame:
    """Per document: the id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    spark = docs.sparkSession
    paths = paths or default_paths()
    folder = scratch_path(spark, "links")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    blocks = written(spark, write_blocks(rows, folder, paths, block_bytes, options), "link-blocks")
    n_b = tokenizer_pair(*paths).n_b

    asked = blocks.select("block", F.explode(F.arrays_zip("pairs", "n_docs")).alias("x")).select("block", "x.pairs", "x.n_docs")
    counts = asked.groupBy("pairs").agg(F.sum("n_docs").alias("n"))
    best = counts.groupBy(F.expr(f"pairs div {n_b}").alias("a")).agg(F.max("n").alias("most"))
    judged = (counts.withColumn("a", F.expr(f"pairs div {n_b}")).join(best, "a")
              .select("pairs", "n", (F.col("n") == F.col("most")).alias("is_best")))
    answers = asked.select("block", "pairs").join(judged, "pairs")

    def look_up(block: pa.Table, answer: pa.Table) -> pa.Table:
        table = load_block(folder, block["file"][0].as_py())
        pairs = answer["pairs"].to_numpy()
        order = np.argsort(pairs)
        count, is_best = answer["n"].to_numpy()[order], answer["is_best"].to_numpy()[order]
        lists, times = table["pairs"].combine_chunks(), table["times"].combine_chunks().flatten().to_numpy()
        at = np.searchsorted(pairs[order], lists.flatten().to_numpy())
        doc = np.repeat(np.arange(table.num_rows), np.diff(lists.offsets.to_numpy()))
        n_best, count_sum = np.zeros(table.num_rows, np.int64), np.zeros(table.num_rows, np.int64)
        if len(at):
            np.add.at(n_best, doc, times * is_best[at])
            np.add.at(count_sum, doc, times * count[at])
        return pa.table({"id": table["id"], **{c: table[c] for c in ("n_a", "n_b", "n_groups", "n_links")},
                         "n_best": n_best, "count_sum": count_sum, "groups_sha256": table["groups_sha256"]})

    out = (blocks.select(F.col("block").alias("own"), "file").groupBy("own").cogroup(answers.groupBy("block"))
           .applyInArrow(look_up, "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"))
    return out.withColumnRenamed("id", id_col)
