"""SentencePiece encoding and decoding by exact backtracking.

A merge-type (BPE) piece model is encoded without running the merges: the
valid encoding of a text is the only sequence of pieces in which every two
neighbours are *compatible*, that is, merging their joined text again gives
just these two.  So the encoder walks the text, takes the longest piece found
by an Aho-Corasick automaton at the current place, checks it against the
piece before, tries shorter ones when the check fails, and goes back a piece
when none is left; places that can't lead to an encoding are kept in a
bitfield and never tried again.

Characters outside the vocabulary become byte pieces and cut the text there.
Pieces hold the space mark only at their front, so a run of marks with the
word after it is encoded on its own and recurring ones are looked up.

Nulls are taken as empty texts.  An empty text is [begin, end] and decodes to
the empty text.  Repeated rows give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ChunkIds, text_array

MARK = "▁"  # the space mark (fixed value)
# piece types of the model file (fixed values)
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_RUNS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_models: dict[str, "PieceModel"] = {}


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceModel:
    """A BPE piece model with byte fallback, read from its file."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        if proto.trainer_spec.model_type != pb.TrainerSpec.BPE or not proto.trainer_spec.byte_fallback:
            raise ValueError("a BPE model with byte fallback is needed")
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("the model normalises its input; only identity models are supported")
        if any(p.type in (USER_DEFINED, UNUSED) for p in proto.pieces):
            raise ValueError("user-defined or unused pieces are not supported")
        self.dummy_prefix = norm.add_dummy_prefix
        self.pieces = [p.piece for p in proto.pieces]
        self.types = [p.type for p in proto.pieces]
        self.scores = [p.score for p in proto.pieces]
        self.begin, self.end = proto.trainer_spec.bos_id, proto.trainer_spec.eos_id
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.bytes = [0] * 256
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.bytes[int(p.piece[1:-1], 16)] = i
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces hold the space mark after their front")
        # order in which merges win (single characters are there from the start), and the last merge of each piece
        self.order = [-s for s in self.scores]
        self.halves: list[tuple[int, int] | None] = [None] * len(self.pieces)
        self.single: dict[str, tuple] = {}  # characters are found without the automaton, which keeps its root small
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.order[i] = float("-inf")
                self.single[piece] = (1, i)
                continue
            last = self.merged(piece, until=2)
            if len(last) == 2 and self.merged(piece) == [i]:  # others can't come from merges
                self.halves[i] = tuple(last)
                self.automaton.add_word(piece, (len(piece), i))
        multi = [s for p, s in zip(self.pieces, self.scores) if len(p) > 1 and p in self.ids and p.strip(MARK)]
        if len(set(multi)) < len(multi):
            raise ValueError("two pieces have equal scores")
        self.automaton.make_automaton()
        self.compatible: dict[int, bool] = {}
        self.words = ChunkIds(lambda words: self._encode_chunks([MARK + w for w in words]), 300_000)
        self.chunks = ChunkIds(self._encode_chunks, 50_000)
        self.characters = {p for p in self.ids if len(p) == 1}
        self.is_control = np.array([t == CONTROL for t in self.types])
        # flat bytes of every piece, for decoding
        flat = [self._decoded_piece(i) for i in range(len(self.pieces))]
        self.flat = np.frombuffer(b"".join(flat), np.uint8)
        self.flat_len = np.array([len(b) for b in flat], np.int64)
        self.flat_at = np.concatenate(([0], np.cumsum(self.flat_len)))[:-1]

    def _decoded_piece(self, i: int) -> bytes:
        if self.types[i] == CONTROL:
            return b""
        if self.types[i] == BYTE:
            return bytes([int(self.pieces[i][1:-1], 16)])
        if self.types[i] == UNKNOWN:
            return " ⁇ ".encode()
        return self.pieces[i].replace(MARK, " ").encode()

    def merged(self, text: str, until: int = 1) -> list[int]:
        """The ids that merging gives for a text whose characters are all pieces (best score first,
        leftmost first), stopped when ``until`` of them are left."""
        parts = list(text)
        ids, scores = self.ids, self.scores
        while len(parts) > until:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or scores[i] > best):
                    best, at = scores[i], k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ids[p] for p in parts]

    def fits(self, left: int, right: int) -> bool:
        """Whether the two pieces stay apart when their joined text is merged again.

        Only the parts that touch the border matter.  They are unfolded from
        the last merge back: a pair of such parts stands side by side until
        the next merge of either one, so it joins if its own merge comes
        earlier.  At equal order the place further left merges first.  Runs of
        space marks all have one score, so next to them the merges are run.
        """
        key = left << 32 | right
        known = self.compatible.get(key)
        if known is None:
            if len(self.compatible) > 400_000:
                self.compatible.clear()
            if self.pieces[left].endswith(MARK):
                known = self.merged(self.pieces[left] + self.pieces[right]) == [left, right]
            else:
                known = self._stay_apart(left, right)
            self.compatible[key] = known
        return known

    def _stay_apart(self, x: int, y: int) -> bool:
        ids, pieces, order, halves = self.ids, self.pieces, self.order, self.halves
        until, wins_ties = float("inf"), False  # the next merge of a part; whether the border comes first at a tie
        while True:
            joined = ids.get(pieces[x] + pieces[y])
            if joined is not None and (order[joined] < until or wins_ties and order[joined] == until):
                return False
            if halves[x] is None and halves[y] is None:
                return True
            if order[x] > order[y]:
                until, wins_ties, x = order[x], False, halves[x][1]
            else:  # of two equal pieces the right one was merged last
                until, wins_ties, y = order[y], True, halves[y][0]

    def encode_span(self, text: str) -> list[int]:
        """Ids of a text whose characters are all pieces."""
        n, single = len(text), self.single
        at = [[single[c]] for c in text]  # candidates at each place, shortest first
        for end, match in self.automaton.iter(text):
            at[end - match[0] + 1].append(match)
        failed = bytearray(n // 8 + 1)  # bitfield of places from which no encoding was found
        path: list[int] = []
        # candidates left to try at each piece of the path; a failed place is one where all were tried
        places, left, pos = [], [], 0
        todo, known = at[0], self.compatible.get
        k = len(todo)
        while pos < n:
            found = False
            while k:
                k -= 1
                length, i = todo[k]
                to = pos + length
                if to < n and failed[to >> 3] >> (to & 7) & 1:
                    continue
                if path and not (known(path[-1] << 32 | i) or self.fits(path[-1], i)):
                    continue
                found = True
                break
            if found:
                path.append(i)
                places.append(pos)
                left.append(k)
                pos = to
                if pos < n:
                    todo = at[pos]
                    k = len(todo)
            else:
                # With the piece before fixed nothing fits here; the encoding of a prefix is unique,
                # so no other way to reach this place can be right either.
                failed[pos >> 3] |= 1 << (pos & 7)
                if not path:
                    raise ValueError(f"no encoding of {text!r}")
                path.pop()
                pos, k = places.pop(), left.pop()
                todo = at[pos]
        return path

    def encode_chunk(self, chunk: str) -> list[int]:
        known = self.characters
        if known.issuperset(chunk):
            return self.encode_span(chunk)
        out, begin = [], 0
        for k, c in enumerate(chunk):
            if c not in known:
                if k > begin:
                    out += self.encode_span(chunk[begin:k])
                out += [self.bytes[b] for b in c.encode()]
                begin = k + 1
        if begin < len(chunk):
            out += self.encode_span(chunk[begin:])
        return out

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        return [np.array(self.encode_chunk(c), "<u4").tobytes() for c in chunks]

    def split(self, text: str) -> list[str]:
        """Chunks that no piece spans (each a run of space marks and what follows)."""
        if not text:
            return []
        marked = text.replace(" ", MARK)
        return _RUNS.findall(MARK + marked if self.dummy_prefix else marked)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian uint32 bytes, without begin and end."""
        docs, plain, words, chunks = [], [], set(), set()
        for text in texts:
            parts = text.split(" ")
            # single spaces between words: each word with one mark before it is a chunk
            plain.append(self.dummy_prefix and "" not in parts and MARK not in text)
            docs.append(parts if plain[-1] else self.split(text))
            (words if plain[-1] else chunks).update(docs[-1])
        self.words.learn(words)
        self.chunks.learn(chunks)
        get = {True: self.words.known.__getitem__, False: self.chunks.known.__getitem__}
        return [b"".join(map(get[p], d)) for d, p in zip(docs, plain)]

    def decode(self, ids) -> str:
        """The text of a sequence of ids, as the library's decode gives it."""
        return self.decode_bytes(np.asarray(ids, np.int64)).decode()

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """As ``decode``, in UTF-8."""
        size = self.flat_len[ids]
        broken = np.flatnonzero(self.is_control[ids[1:-1]]) + 1
        if len(broken):  # bytes on both sides of a control piece form no character together
            out, begun = [], False
            for part in np.split(ids, broken):
                text = self._join(part, self.flat_len[part], not begun)
                begun = begun or bool(self.flat_len[part].any())
                out.append(text)
            return b"".join(out)
        return self._join(ids, size, True)

    def _join(self, ids: np.ndarray, size: np.ndarray, at_start: bool) -> bytes:
        total = int(size.sum())
        if not total:
            return b""
        ends = np.cumsum(size)
        where = np.repeat(self.flat_at[ids] - (ends - size), size)
        where += np.arange(total)
        out = self.flat[where].tobytes()
        first = int(ids[np.argmax(size > 0)])
        if at_start and self.dummy_prefix and self.types[first] == NORMAL and self.pieces[first].startswith(MARK):
            out = out[1:]
        try:
            out.decode()
        except UnicodeDecodeError:  # byte pieces that form no character: one replacement mark a byte
            out = out.decode("utf-8", "surrogateescape")
            out = re.sub("[\udc80-\udcff]", "�", out).encode()
        return out


def piece_model(path: str) -> PieceModel:
    """The model of this Python worker (read once)."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def encode_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per document: the id column, n_tokens, ids_sha256 and decoded_sha256; with ``with_ids``
    also ``ids`` (array<int>) and ``decoded``.  One pass over the scan, no shuffle."""
    path = path or model_path()
    rows = docs.select(id_col, text_col)
    schema = f"`{id_col}` {rows.schema[0].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        begin, end = np.array([model.begin], "<u4").tobytes(), np.array([model.end], "<u4").tobytes()
        for batch in batches:
            texts = text_array(batch.column(1))
            for i in range(0, len(texts), 256):
                part = texts[i:i + 256]
                counts, shas, decoded_shas, all_ids, decoded = [], [], [], [], []
                for body in model.encode_batch(part.to_pylist()):
                    raw = begin + body + end
                    ids = np.frombuffer(raw, "<u4")
                    text = model.decode_bytes(ids.astype(np.int64))
                    counts.append(len(ids))
                    shas.append(hashlib.sha256(raw).hexdigest())
                    decoded_shas.append(hashlib.sha256(text).hexdigest())
                    if with_ids:
                        all_ids.append(ids.astype(np.int32))
                        decoded.append(text.decode())
                cols = [batch.column(0)[i:i + 256], pa.array(counts, pa.int64()), pa.array(shas), pa.array(decoded_shas)]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return rows.mapInArrow(run, schema)
