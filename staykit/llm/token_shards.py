"""Token ids in binary shards, compressed by a Re-Pair grammar.

Documents are range-partitioned by id and sorted, encoded with a byte-level
BPE tokenizer (the ``tokenizers`` library), and written in shards.  In each
shard frequent pairs of neighbouring symbols are replaced by new symbols
(nonterminals), round after round, until a round no longer pays; a round
takes all pairs above a count at once, the more frequent first where they
overlap.  Pairs never span two documents.

A shard file holds, after the magic ``RPTK`` and five little-endian uint64
(terminals, rules, symbols, documents, high planes):

* rules: two uint32 each, for symbol ``terminals + k``;
* expansion lengths of the rules (uint32);
* document ids (int64) and the place of each document's first symbol (uint64);
* the tokens before every 4096th symbol (uint64);
* symbols: the low 16 bits of all, then each higher bit as a packed plane.

Expansion lengths allow random access: ``Shard.tokens`` decodes any range of a
document's tokens by expanding only the symbols that overlap it.

Null texts are taken as empty (a document of the end id alone).  Documents
with equal ids follow each other in the order of their texts; null ids come
first.  Extra columns are ignored; an empty table gives no shards.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import ChunkIds, byte_chunks, filesystem, shuffle_width, text_array, text_bytes, write_once, written

MAGIC = b"RPTK"  # fixed value
SAMPLE = 4096
TAIL = ".,!?*$%&#|;:"  # punctuation without the apostrophe, which the tokenizer treats on its own
NULL_ID = -(1 << 63)  # stands for a null document id in the file
_encoders: dict[tuple[str, bool], "WordEncoder"] = {}


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """The library's ids of whole texts, recurring words looked up.

    A byte-level tokenizer of this kind always cuts before a single space
    between two other characters, and around a single line feed there, so a text is a row of
    words with one space or line feed before each; new ones are encoded together in one call and
    cut at the ids that begin with a space.  Other texts go to the library whole, also those that hold the
    string of a special token, which the library takes as that token (as ordinary
    text with ``plain_specials``).
    """

    def __init__(self, path: str, plain_specials: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        self.specials = [] if plain_specials else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.n_ids = self.tokenizer.get_vocab_size()
        vocab = self.tokenizer.get_vocab()
        self.opens, self.feeds = np.zeros((2, self.n_ids), bool)
        for token, i in vocab.items():
            self.opens[i] = token.startswith("Ġ")  # the byte-level spelling of a space (fixed value)
            self.feeds[i] = token.startswith("Ċ")  # of a line feed
        self.words = ChunkIds(self._encode_words, 1_400_000)
        self.tails: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        # a word has a space before it, unless it begins with a line feed
        out: dict[str, bytes] = {}
        for before, opens in ((" ", self.opens), ("", self.feeds)):
            order = [w for w in words if (w[0] == "\n") == (before == "")]
            for i in range(0, len(order), 256):
                part = order[i:i + 256]
                raw = self._whole([before + before.join(part)])[0]
                cuts = (4 * np.flatnonzero(opens[np.frombuffer(raw, "<u4")])).tolist()
                if len(cuts) == len(part) and cuts[0] == 0:
                    out.update(zip(part, map(raw.__getitem__, map(slice, cuts, [*cuts[1:], len(raw)]))))
                else:
                    out.update(zip(part, self._whole([before + w for w in part])))
        return list(map(out.__getitem__, words))

    def _word_ids(self, words: pa.Array) -> "Runs":
        """Ids of distinct words, each with the space or line feed before it."""
        # a letter before punctuation always ends a token, so words are encoded without their tails
        cores = pc.utf8_rtrim(words, TAIL)
        cut = _flags(cores, -1, str.isalpha) & (pc.binary_length(cores).to_numpy() < pc.binary_length(words).to_numpy())
        cores = pc.if_else(pa.array(cut), cores, words).dictionary_encode()
        names, core = _strings(cores.dictionary), cores.indices.to_numpy()
        ids = self.words.ids(names)
        at = np.flatnonzero(cut)
        tails = [w[len(names[k]):] for w, k in zip(_strings(words.take(pa.array(at))), core[at].tolist())]
        number = {t: len(ids) + 1 + k for k, t in enumerate(dict.fromkeys(tails))}
        new = [t for t in number if t not in self.tails]
        self.tails.update(zip(new, self._whole(new)))
        pairs = np.full((len(words), 2), len(ids))  # the ids of a core, then those of its tail (or none)
        pairs[:, 0] = core
        pairs[at, 1] = np.fromiter(map(number.__getitem__, tails), np.int64, len(at))
        runs = Runs.of([*ids, b"", *map(self.tails.__getitem__, number)])
        return Runs(runs.take(pairs.ravel()), runs.size[pairs].sum(axis=1))

    def encode(self, texts: pa.Array) -> "Runs":
        """Ids of all texts (large strings, none null)."""
        n = len(texts)
        if not n:
            return Runs.of([])
        spaced = pc.replace_substring(texts, "\n", " \n")
        for s in self.specials:
            spaced = pc.if_else(pc.match_substring(texts, s), "", spaced)
        parts = pc.split_pattern(spaced, " ")
        begin = parts.offsets.to_numpy().astype(np.int64)
        begin -= begin[0]
        coded = parts.flatten().dictionary_encode()
        words, piece = coded.dictionary, coded.indices.to_numpy()
        # words with white space at an end would merge with their neighbour's: their texts are encoded whole
        line = pc.starts_with(words, "\n").to_numpy(zero_copy_only=False)
        odd = np.where(line, _flags(words, 1, _blank), _flags(words, 0, _blank)) | _flags(words, -1, _blank)
        first = begin[:-1]
        whole = np.logical_or.reduceat(odd[piece], first) if odd.any() else np.zeros(n, bool)
        # a text's first word is encoded as if after a line feed, whose id is left out
        opening = ["\n" + w for w in words.take(pa.array(piece[first[~whole]])).to_pylist()]
        heads = [b[4:] for b in self.words.ids(opening)] + self._whole(texts.filter(pa.array(whole)).to_pylist())
        ids = self._word_ids(words.filter(pa.array(~odd)))
        piece = (np.cumsum(~odd) - 1)[piece]
        piece[first[np.argsort(whole, kind="stable")]] = len(ids.size) + np.arange(n)
        if whole.any():
            keep = np.repeat(~whole, np.diff(begin))
            keep[first] = True
            piece, first = piece[keep], np.cumsum(keep)[first] - 1
        ids = ids.followed_by(Runs.of(heads))
        return Runs(ids.take(piece), np.add.reduceat(ids.size[piece], first))

    def ends_with(self, texts: pa.Array, end_id: int) -> "Runs":
        """Ids of all texts, ``end_id`` after each."""
        runs = self.encode(texts)
        size = runs.size + 1
        out = np.full(len(runs.ids) + len(size), end_id, "<u4")
        body = np.ones(len(out), bool)
        body[np.cumsum(size) - 1] = False
        out[body] = runs.ids
        return Runs(out, size)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian uint32 bytes."""
        runs = self.encode(pa.array(texts, pa.large_string()))
        return [runs.ids[i:i + n].tobytes() for i, n in zip(runs.begin.tolist(), runs.size.tolist())]


class Runs:
    """Sequences of token ids: all ids on end (little-endian uint32) and each one's size and place."""

    def __init__(self, ids: np.ndarray, size: np.ndarray):
        self.ids, self.size = ids, size
        self.begin = np.cumsum(size) - size

    @classmethod
    def of(cls, raw: list[bytes]) -> "Runs":
        return cls(np.frombuffer(b"".join(raw), "<u4"), np.fromiter(map(len, raw), np.int64, len(raw)) // 4)

    def followed_by(self, other: "Runs") -> "Runs":
        return Runs(np.concatenate((self.ids, other.ids)), np.concatenate((self.size, other.size)))

    def take(self, at: np.ndarray) -> np.ndarray:
        """The ids of the sequences ``at``, on end."""
        size = self.size[at]
        place = np.repeat(self.begin[at] - (np.cumsum(size) - size), size)
        place += np.arange(len(place))
        return self.ids[place]


def _blank(c: str) -> bool:
    return c == "" or c.isspace()


def _strings(words: pa.Array) -> list[str]:
    """The words, none of which holds a space, as Python strings."""
    if not len(words):
        return []
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), pa.scalar(" ", words.type))
    return joined[0].as_py().split(" ")


def _flags(strings: pa.Array, at: int, test) -> np.ndarray:
    """``test`` of the character at ``at`` of each string (-1: the last; none: an empty string)."""
    chars = pc.utf8_slice_codeunits(strings, at, at + 1 or None).dictionary_encode()
    return np.array([test(c) for c in chars.dictionary.to_pylist()], bool)[chars.indices.to_numpy()]


def word_encoder(path: str, plain_specials: bool = False) -> WordEncoder:
    if (path, plain_specials) not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        _encoders[path, plain_specials] = WordEncoder(path, plain_specials)
    return _encoders[path, plain_specials]


# --- grammar ---------------------------------------------------------------

def repair(tokens: np.ndarray, last: np.ndarray, terminals: int, least_count: int = 16,
           least_gain: float = 0.03, table_bits: int = 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, marks of each document's last symbol, rules) of a token sequence.

    ``last`` marks the last token of each document.  A round replaces all
    pairs that occur at least ``least_count`` times (or once in 2^16 symbols,
    if that is more); rounds go on while the last one shortened the sequence
    by ``least_gain`` or more.
    """
    # symbols are numbered without gaps, so that a pair mostly fits 32 bits
    used_terminals = np.flatnonzero(np.bincount(tokens, minlength=terminals))
    number = np.zeros(max(terminals, int(tokens.max(initial=0)) + 1), np.uint32)
    number[used_terminals] = np.arange(len(used_terminals))
    seq, last = number[tokens], last.copy()
    rules: list[np.ndarray] = []
    n_symbols = len(used_terminals)
    while len(seq) > 1:
        kind, bits = (np.uint32, 16) if n_symbols <= 1 << 16 else (np.uint64, 32)
        key = (seq[:-1].astype(kind) << kind(bits)) | seq[1:]
        joined = ~last[:-1]
        ordered = np.sort(key[joined])
        if not len(ordered):
            break
        begins = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        counts = np.diff(np.append(begins, len(ordered)))
        often = counts >= max(least_count, len(seq) >> 16)
        if not often.any():
            break
        pairs, counts = ordered[begins[often]], counts[often]
        order = np.argsort(-counts, kind="stable")
        pairs = pairs[order]
        # rank of the pair at each place, by a hash table; of pairs that share a slot the most frequent is kept
        shift = kind(2 * bits - table_bits)
        factor = kind(0x9E3779B97F4A7C15 >> (64 - 2 * bits))
        slots = np.full(1 << table_bits, len(pairs), np.int32)
        slot = (pairs * factor) >> shift
        slots[slot[::-1]] = np.arange(len(pairs) - 1, -1, -1, dtype=np.int32)
        rank = slots[(key * factor) >> shift]
        none = np.int32(len(pairs))
        rank[np.append(pairs, kind(0))[rank] != key] = none
        rank[~joined] = none
        # a place is replaced if its pair is more frequent than those that overlap it; the leftmost of equal ones
        chosen = rank < none
        chosen[1:] &= rank[1:] < rank[:-1]
        chosen[:-1] &= rank[:-1] <= rank[1:]
        at = np.flatnonzero(chosen)
        uses = np.bincount(rank[at], minlength=len(pairs))
        kept = uses >= 4  # fewer don't pay for the rule
        at = at[kept[rank[at]]]
        if not len(at):
            break
        number = np.cumsum(kept) - 1 + n_symbols
        used = pairs[kept]
        rules.append(np.stack([(used >> kind(bits)).astype(np.uint32), (used & kind((1 << bits) - 1)).astype(np.uint32)], axis=1))
        n_symbols += len(used)
        before = len(seq)
        seq[at] = number[rank[at]]
        last[at] = last[at + 1]
        keep = np.ones(before, bool)
        keep[at + 1] = False
        seq, last = seq[keep], last[keep]
        if before - len(seq) < least_gain * before:
            break
    symbols = np.append(used_terminals, terminals + np.arange(n_symbols - len(used_terminals))).astype(np.uint32)
    return symbols[seq], last, symbols[np.concatenate(rules)] if rules else np.zeros((0, 2), np.uint32)


def expansion_lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    size = np.ones(terminals + len(rules), np.int64)
    done, n = terminals, len(size)
    while done < n:  # a rule's parts come before it: do all whose parts are known at once
        parts = rules[done - terminals:]
        ready = int(np.argmax((parts >= done).any(axis=1))) if (parts >= done).any() else len(parts)
        size[done:done + ready] = size[parts[:ready]].sum(axis=1)
        done += ready
    return size


def expand(symbols: np.ndarray, rules: np.ndarray, terminals: int) -> np.ndarray:
    """All tokens of ``symbols``."""
    seq = symbols.astype(np.uint32)
    while True:
        high = seq >= terminals
        if not high.any():
            return seq
        size = 1 + high
        ends = np.cumsum(size)
        out = np.empty(int(ends[-1]), np.uint32)
        first = ends - size
        out[first] = seq
        at = first[high]
        parts = rules[seq[high] - terminals]
        out[at], out[at + 1] = parts[:, 0], parts[:, 1]
        seq = out


def shard_bytes(doc_ids: np.ndarray, tokens: np.ndarray, counts: np.ndarray, terminals: int) -> bytes:
    """A shard file of documents with ``counts`` tokens each."""
    last = np.zeros(len(tokens), bool)
    last[np.cumsum(counts) - 1] = True
    seq, last, rules = repair(tokens, last, terminals)
    size = expansion_lengths(rules, terminals)
    before = np.concatenate(([0], np.cumsum(size[seq])))
    first = np.concatenate(([0], np.flatnonzero(last) + 1))[:len(doc_ids)]
    planes = max(0, int(seq.max(initial=0)).bit_length() - 16)
    parts = [MAGIC, struct.pack("<5Q", terminals, len(rules), len(seq), len(doc_ids), planes),
             rules.astype("<u4").tobytes(), size[terminals:].astype("<u4").tobytes(), doc_ids.astype("<i8").tobytes(),
             first.astype("<u8").tobytes(), before[:-1][::SAMPLE].astype("<u8").tobytes(),
             (seq & 0xFFFF).astype("<u2").tobytes()]
    parts += [np.packbits((seq >> (16 + k) & 1).astype(bool)).tobytes() for k in range(planes)]
    return b"".join(parts)


class Shard:
    """A shard file, read from its bytes."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a token shard")
        self.terminals, n_rules, n, n_docs, planes = struct.unpack_from("<5Q", raw, 4)
        at = 44

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, count, at)
            at += out.nbytes
            return out

        self.rules = take("<u4", 2 * n_rules).reshape(-1, 2)
        self.size = np.concatenate((np.ones(self.terminals, np.int64), take("<u4", n_rules).astype(np.int64)))
        self.doc_ids = take("<i8", n_docs)
        self.first = take("<u8", n_docs).astype(np.int64)
        self.samples = take("<u8", -(-n // SAMPLE)).astype(np.int64)
        self.symbols = take("<u2", n).astype(np.uint32)
        for k in range(planes):
            bits = np.unpackbits(take("u1", -(-n // 8)), count=n)
            self.symbols |= bits.astype(np.uint32) << np.uint32(16 + k)

    def _tokens_before(self, symbol: int) -> int:
        block = symbol // SAMPLE
        if block == len(self.samples):
            block -= 1
        return int(self.samples[block] + self.size[self.symbols[block * SAMPLE:symbol]].sum())

    def tokens(self, doc: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Tokens [start, stop) of the ``doc``-th document, expanding only what overlaps them."""
        a = int(self.first[doc])
        b = int(self.first[doc + 1]) if doc + 1 < len(self.first) else len(self.symbols)
        base = self._tokens_before(a)
        stop = self._tokens_before(b) - base if stop is None else stop
        # go to the sampled block that holds the start, then count symbols
        lo = max(a, (int(np.searchsorted(self.samples, base + start, side="right")) - 1) * SAMPLE)
        offset = self._tokens_before(lo) - base
        ends = offset + np.cumsum(self.size[self.symbols[lo:b]])
        i = int(np.searchsorted(ends, start, side="right"))
        j = int(np.searchsorted(ends, stop, side="left")) + 1
        skip = start - (int(ends[i - 1]) if i else offset)
        return expand(self.symbols[lo + i:min(lo + j, b)], self.rules, self.terminals)[skip:skip + max(0, stop - start)]

    def documents(self) -> Iterator[tuple[int, np.ndarray]]:
        """All (doc_id, tokens) in order."""
        all_tokens = expand(self.symbols, self.rules, self.terminals)
        before = np.concatenate(([0], np.cumsum(self.size[self.symbols])))
        begin = before[self.first]
        for i, doc_id in enumerate(self.doc_ids.tolist()):
            yield doc_id, all_tokens[begin[i]:begin[i + 1] if i + 1 < len(begin) else len(all_tokens)]


# --- Spark -----------------------------------------------------------------

def write_shards(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 2,
                 shard_tokens: int = 4_000_000, id_col: str = "doc_id", text_col: str = "text",
                 plain_specials: bool = False) -> DataFrame:
    """Write all documents in ascending id order; returns the table of shards.
    ``plain_specials`` encodes the strings of special tokens in texts as ordinary text.

    Its rows (part, shard, file, n_docs, n_tokens) are in the order (part,
    shard).  The texts are shuffled once, by range of the id.
    """
    path = path or tokenizer_path()
    spark = docs.sparkSession
    rows = (docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
            .repartitionByRange(shuffle_width(spark), "i").sortWithinPartitions("i", "t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, shard = TaskContext.get().partitionId(), 0
        encoder = word_encoder(path, plain_specials)
        ids: list[np.ndarray] = []
        bodies: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal shard, held
            doc_ids, tokens, counts = np.concatenate(ids), np.concatenate(bodies), np.concatenate(sizes)
            raw = shard_bytes(doc_ids, tokens, counts, encoder.n_ids)
            name, _ = write_once(folder, f"tokens-{part:06d}-{shard:06d}", [raw])
            out = pa.RecordBatch.from_pydict({"part": [part], "shard": [shard], "file": [name], "n_docs": [len(doc_ids)],
                                              "n_tokens": [len(tokens)]})
            shard, held = shard + 1, 0
            ids.clear()
            bodies.clear()
            sizes.clear()
            return out

        for batch in batches:
            texts = text_array(batch.column(1))
            doc_ids = np.array(batch.column(0).fill_null(NULL_ID))
            for i, j in byte_chunks(text_bytes(texts)[1], 4 << 20):
                runs = encoder.ends_with(texts[i:j], end_id)
                ends = np.append(runs.begin, len(runs.ids))
                k, n = 0, j - i
                while k < n:  # a shard ends with the document that fills it
                    m = min(n, max(k + 1, int(np.searchsorted(ends, ends[k] + shard_tokens - held))))
                    ids.append(doc_ids[i + k:i + m])
                    bodies.append(runs.ids[ends[k]:ends[m]])
                    sizes.append(runs.size[k:m])
                    held += int(ends[m] - ends[k])
                    k = m
                    if held >= shard_tokens:
                        yield flush()
        if ids:
            yield flush()

    shards = rows.mapInArrow(run, "part long, shard long, file string, n_docs long, n_tokens long")
    return written(spark, shards, "token-shards")


def shard_starts(shards: DataFrame) -> DataFrame:
    """``shards`` with ``start``, the tokens of all shards before each.

    Sums go in two levels, per part and over parts, so that the only window
    without a key sees one row a part.
    """
    per_part = shards.groupBy("part").agg(F.sum("n_tokens").alias("t"))
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select("part", F.coalesce(F.sum("t").over(over), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (shards.join(bases, "part")
            .withColumn("start", F.col("base") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).drop("base"))


def read_shards(spark: SparkSession, shards: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (and ids)."""
    rows = shard_starts(shards).select("file", "start").repartition(shuffle_width(spark))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file_system, root = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with file_system.open_input_stream(f"{root.rstrip('/')}/{row['file']}") as f:
                    shard = Shard(f.read())
                start, cols = row["start"], [[], [], [], [], []]
                for doc_id, tokens in shard.documents():
                    cols[0].append(None if doc_id == NULL_ID else doc_id)
                    cols[1].append(start)
                    cols[2].append(len(tokens))
                    cols[3].append(zlib.crc32(tokens.astype("<u4").tobytes()))
                    if with_ids:
                        cols[4].append(tokens.astype(np.int32))
                    start += len(tokens)
                arrays = [pa.array(c, pa.int64()) for c in cols[:4]]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array(cols[4], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.mapInArrow(run, schema)


def token_index(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``docs`` as token shards under the shared scratch folder and read them back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    return read_shards(spark, write_shards(docs, folder, path, **options), folder)
