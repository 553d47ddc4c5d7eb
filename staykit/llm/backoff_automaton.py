"""Language-model scoring by a weighted backoff automaton.

The model is an n-gram model of words with hierarchical Dirichlet smoothing:

    P(w)     = (c(w) + 1/2) / (N + (V + 1) / 2)
    P(w | u) = (c(u w) + m P(w | u')) / (c(u) + m)

where u' is the context u without its first word, c counts n-grams in the training
documents, N and V are the tokens and distinct tokens in them, and all words that
training lacks share one more place in P(w).  The weight m is the value of a grid under
which the training tokens are likeliest when each is left out of the counts in turn;
these sums, too, are taken over all blocks.  Words are runs of characters other
than ASCII white space, A-Z lower-cased; every document has one end token after
its words, and its first words have begin marks as their context.

As an automaton: every context that training knows is a state.  It has an arc for
each word seen after it, weighted with log10 P(w | u), to the longest known context
that ends with that word, and a failure arc, weighted with log10(m / (c(u) + m)), to
u'.  The root has an arc for every word.  A document is scored by one traversal
from left to right that carries the state and adds up the weights.

The n-grams of a corpus outgrow any worker, so the automaton is never whole in one
place.  Documents are cut into blocks (files in the shared folder); a block asks for
the counts of the n-grams that occur in it and tells its own training counts; the
requests of all blocks meet by range of a 64-bit hash, where counts are added up, and
go back to the blocks.  A block then builds just the states and arcs that its documents
can reach.  No n-gram is left out, at any size.  Each block gives an n-gram once, so a
word that makes up a third of the corpus is one entry a block.

Texts longer than a piece (a megabyte) are cut at white space, and a piece begins with
the words before it as context, so neither blocks nor tasks grow with a text.

Null texts are taken as empty: one token, the end.  A null id is not held out.
Repeated rows are scored (and counted) each; extra columns are ignored; an empty
table gives no rows.  Without training documents P(w) is 1 and every score 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .blocks import load_block, pack, pack_sorted, save_block, unpack, unpack_sorted
from .common import IS_SPACE, byte_chunks, mix64, shuffle_width, text_array, text_bytes, word_hashes, written

# hashes of the marks; words get theirs from their bytes
BEGIN, END = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949C7DEFA1D2C45)
PIECE_BYTES = 1 << 20
BLOCK_BYTES = 8 << 20
RANGE_BYTES = 8 << 20  # text a range of hashes is laid out for
LANE = 2048            # tokens that one lane of a traversal reads
PRIORS = tuple(4.0 ** k for k in range(-1, 9))


def held_out(id_col: str = "doc_id", fold: int = 1):
    """Documents kept out of training: crc32 of the id as text, mod 5, is ``fold``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == fold, F.lit(False))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 0x41) & (data <= 0x5A), data + np.uint8(32), data)


# --- pieces and blocks -----------------------------------------------------

def pieces(data: np.ndarray, order: int, most: int = PIECE_BYTES) -> Iterator[tuple[bytes, int, bool]]:
    """A text cut at white space: (bytes, number of words at their front that are context only, whether it ends the text)."""
    begin, context = 0, []
    while True:
        cut = len(data)
        if cut - begin > most:
            space = np.flatnonzero(IS_SPACE[data[begin + most:begin + 2 * most]])
            if not len(space):  # a word longer than a piece stays whole
                space = np.flatnonzero(IS_SPACE[data[begin + most:]])
            cut = begin + most + int(space[0]) if len(space) else cut
        body = data[begin:cut].tobytes()
        yield b" ".join([*context, body]) if context else body, len(context), cut == len(data)
        if cut == len(data):
            return
        if order > 1:
            context = (context + body.split())[1 - order:]
        begin = cut


def write_blocks(rows: DataFrame, folder: str, order: int, block_bytes: int, piece_bytes: int) -> DataFrame:
    """Write (id, text, held_out) rows as blocks; the table of blocks: block, file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        place, block, held = part << 36, part << 24, 0
        cols: list[list] = [[], [], [], [], [], [], []]

        def flush() -> pa.RecordBatch:
            nonlocal block, held
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.bool_(), pa.bool_(), pa.large_binary())
            table = pa.table([pa.array(c, k) for c, k in zip(cols, kinds)],
                             ["place", "id", "held_out", "lead", "first", "last", "text"])
            name = save_block(folder, f"text-{block:015x}", table)
            out = pa.RecordBatch.from_pydict({"block": [block], "file": [name]})
            block, held = block + 1, 0
            for c in cols:
                c.clear()
            return out

        for batch in batches:
            texts = text_array(batch.column(1))
            data, offsets = text_bytes(texts)
            data = lower_ascii(data)
            ids, out = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for k in range(len(texts)):
                first = True
                for body, lead, last in pieces(data[offsets[k]:offsets[k + 1]], order, piece_bytes):
                    for c, v in zip(cols, (place, ids[k], out[k], lead, first, last, body)):
                        c.append(v)
                    first = False
                    held += len(body) + 64
                    if held >= block_bytes:
                        yield flush()
                place += 1
        if cols[0]:
            yield flush()

    return rows.mapInArrow(run, "block long, file string")


class Tokens:
    """The tokens of a block: hashes of all n-grams up to ``order``, in one flat row of positions.

    Every piece has order - 1 places for its context (begin marks, and the words
    before the piece), then its words, then the end if the text ends with it.
    """

    def __init__(self, table: pa.Table, order: int):
        self.order, self.n_pieces = order, table.num_rows
        texts = table["text"].combine_chunks()
        lead = table["lead"].to_numpy().astype(np.int64)
        last = table["last"].to_numpy(zero_copy_only=False)
        first = table["first"].to_numpy(zero_copy_only=False)
        train = ~table["held_out"].to_numpy(zero_copy_only=False)
        data, offsets = text_bytes(texts)
        hashes, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for i, j in byte_chunks(offsets):
            h, o = word_hashes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            hashes.append(h)
            owners.append(o + i)
        words, owner = np.concatenate(hashes), np.concatenate(owners)
        n_words = np.bincount(owner, minlength=self.n_pieces)
        slots = order - 1
        size = slots + n_words - lead + last
        begin = np.cumsum(size) - size
        self.piece = np.repeat(np.arange(self.n_pieces), size)
        token = np.full(int(size.sum()), BEGIN, np.uint64)
        within = np.arange(len(words)) - (np.cumsum(n_words) - n_words)[owner]
        token[begin[owner] + slots - lead[owner] + within] = words
        token[(begin + size - 1)[last]] = END
        offset = np.arange(len(token)) - begin[self.piece]
        self.scored = offset >= slots
        # where a context may end: at scored places and the last place before them
        self.context = self.scored.copy()
        counted = self.scored & train[self.piece]
        if slots:
            self.context[begin + slots - 1] = True
            counted[(begin + slots - 1)[first & train]] = True  # the begin marks, once a text
        self.begin, self.size, self.slots = begin, size, slots
        # n-grams of each order: their hashes (sorted), training counts here, and the index at each position
        self.keys, self.own, self.index = [], [], []
        h = token
        for k in range(1, order + 1):
            if k > 1:
                before = np.empty_like(h)
                before[0], before[1:] = 0, h[:-1]
                before *= np.uint64(0xC2B2AE3D27D4EB4F)
                before += token
                before += np.uint64(k)
                h = mix64(before)
            where = np.flatnonzero(self.context if k < order else self.scored)
            keys, index = np.unique(h[where], return_inverse=True)
            at = np.full(len(token), -1, np.int32)
            at[where] = index
            self.keys.append(keys)
            self.own.append(np.bincount(index, counted[where], len(keys)).astype(np.int64))
            self.index.append(at)
        self.is_end = token == END


# --- counts over all blocks ------------------------------------------------

def range_of(keys: np.ndarray, n_ranges: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(n_ranges)) >> np.uint64(32)


def requests(blocks: DataFrame, folder: str, order: int, n_ranges: int) -> DataFrame:
    """What each block asks of each range: n (order), range, block, its keys and its own training counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens = Tokens(load_block(folder, row["file"]), order)
                out: dict[str, list] = {"n": [], "range": [], "block": [], "keys": [], "own": []}
                for n, (keys, own) in enumerate(zip(tokens.keys, tokens.own), 1):
                    which, at = np.unique(range_of(keys, n_ranges), return_index=True)
                    for r, i, j in zip(which.tolist(), at.tolist(), [*at[1:].tolist(), len(keys)]):
                        for name, v in zip(out, (n, r, row["block"], pack_sorted(keys[i:j]), pack(own[i:j]))):
                            out[name].append(v)
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                    ("n", pa.int32()), ("range", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("own", pa.binary())]))

    return blocks.repartition(shuffle_width(blocks.sparkSession)).mapInArrow(
        run, "n int, `range` long, block long, keys binary, own binary")


def _add_up(table: pa.Table) -> pa.Table:
    """The requests of one range answered: the counts of each block's keys, and (block null) the
    number of keys that training knows and the sum of their counts."""
    keys = [unpack_sorted(k) for k in table["keys"].to_pylist()]
    known, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(known), np.int64)
    np.add.at(total, at, np.concatenate([unpack(c) for c in table["own"].to_pylist()]).astype(np.int64))
    answers, i = [], 0
    for k in keys:
        answers.append(pack(total[at[i:i + len(k)]]))
        i += len(k)
    n, r = table["n"][0].as_py(), table["range"][0].as_py()
    m = len(keys)
    return pa.table({"n": pa.array([n] * (m + 1), pa.int32()), "range": pa.array([r] * (m + 1), pa.int64()),
                     "block": pa.array([*table["block"].to_pylist(), None], pa.int64()),
                     "counts": pa.array([*answers, None], pa.binary()),
                     "seen": pa.array([0] * m + [int((total > 0).sum())], pa.int64()),
                     "total": pa.array([0] * m + [int(total.sum())], pa.int64())})


# --- the automaton ---------------------------------------------------------

class Automaton:
    """The states and arcs that the documents of one block can reach.

    ``counts`` has, for each order, the training counts of the block's n-grams.
    State 0 is the root.  Arcs are sorted by (state, token).
    """

    def __init__(self, tokens: Tokens, counts: list[np.ndarray], n_tokens: int, n_distinct: int, prior: float):
        order = tokens.order
        self.n_ids = len(tokens.keys[0])
        p = (counts[0] + 0.5) / (n_tokens + 0.5 * (n_distinct + 1))
        self.base = np.log10(p)
        ends = np.zeros(self.n_ids, bool)
        ends[tokens.index[0][tokens.is_end]] = True
        # states: all known contexts of 1 to order - 1 tokens
        self.state = []
        fail, fail_weight, n_states = [np.zeros(1, np.int64)], [np.zeros(1)], 1
        context_at = np.flatnonzero(tokens.context)
        for k in range(1, order):
            at = np.zeros(len(counts[k - 1]), np.int64)  # a place where the context ends
            at[tokens.index[k - 1][context_at]] = context_at
            known = np.flatnonzero((counts[k - 1] > 0) & ~ends[tokens.index[0][at]])
            number = np.full(len(counts[k - 1]), -1, np.int64)
            number[known] = n_states + np.arange(len(known))
            self.state.append(number)
            fail.append(self.state[k - 2][tokens.index[k - 2][at[known]]] if k > 1 else np.zeros(len(known), np.int64))
            fail_weight.append(np.log10(prior / (counts[k - 1][known] + prior)))
            n_states += len(known)
        self.fail, self.fail_weight = np.concatenate(fail), np.concatenate(fail_weight)
        # arcs: every token from the root, and every known n-gram of 2 to order tokens from its context
        keys, weights, targets = [], [], []
        scored_at = np.flatnonzero(tokens.scored)
        for k in range(1, order + 1):
            at = np.full(len(counts[k - 1]), -1, np.int64)
            at[tokens.index[k - 1][scored_at]] = scored_at
            used = np.flatnonzero(at >= 0)
            where = at[used]
            token = tokens.index[0][where].astype(np.int64)
            if k == 1:
                source = np.zeros(len(used), np.int64)
            else:
                context = tokens.index[k - 2][where - 1]
                shorter = np.zeros(len(counts[k - 1]))
                shorter[used] = p[tokens.index[k - 2][where]]
                seen = np.zeros(len(counts[k - 1]))
                seen[used] = counts[k - 2][context]
                p = np.where(seen > 0, (counts[k - 1] + prior * shorter) / (seen + prior), shorter)
                source = self.state[k - 2][context]
            if k < order:
                target = self.state[k - 1][used]
            else:  # a context has at most order - 1 tokens
                target = self.state[k - 2][tokens.index[k - 2][where]] if k > 1 else np.zeros(len(used), np.int64)
            kept = (counts[k - 1][used] > 0) | (k == 1)
            keys.append((source * self.n_ids + token)[kept])
            weights.append(np.log10(p[used])[kept])
            targets.append(np.maximum(target, 0)[kept])  # after an unknown word or the end nothing is known
        arcs = np.concatenate(keys)
        by_key = np.argsort(arcs)
        self.arcs, self.weights, self.targets = arcs[by_key], np.concatenate(weights)[by_key], np.concatenate(targets)[by_key]
        self.tokens = tokens

    def start(self, at: np.ndarray) -> np.ndarray:
        """The state after the token at each position, from what is known of the tokens up to it."""
        state = np.zeros(len(at), np.int64)
        for number, index in zip(self.state, self.tokens.index):
            here = number[index[at]]
            state = np.where(here >= 0, here, state)
        return state

    def step(self, state: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next states, weights) of reading one token in each state."""
        weight = np.zeros(len(state))
        state = state.copy()
        left = np.arange(len(state))
        while len(left):
            key = state[left] * self.n_ids + token[left]
            i = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            hit = self.arcs[i] == key
            done, i = left[hit], i[hit]
            weight[done] += self.weights[i]
            state[done] = self.targets[i]
            left = left[~hit]
            weight[left] += self.fail_weight[state[left]]
            state[left] = self.fail[state[left]]
        return state, weight

    def scores(self, lane: int = LANE) -> np.ndarray:
        """log10 probability of every piece.

        Many lanes read from left to right at once; a long piece is several
        lanes, each beginning in the state that the tokens before it give.
        """
        t = self.tokens
        length = t.size - t.slots
        lanes = -(-length // lane)
        piece = np.repeat(np.arange(t.n_pieces), lanes)
        number = np.arange(len(piece)) - (np.cumsum(lanes) - lanes)[piece]
        begin = t.begin[piece] + t.slots + number * lane
        length = np.minimum(length[piece] - number * lane, lane)
        by_length = np.argsort(-length, kind="stable")
        piece, begin, length = piece[by_length], begin[by_length], length[by_length]
        state = self.start(begin - 1) if t.slots else np.zeros(len(begin), np.int64)
        total = np.zeros(len(begin))
        active = np.searchsorted(-length, -np.arange(int(length.max(initial=0))), side="left")  # lanes longer than k
        for k, n in enumerate(active.tolist()):
            state, weight = self.step(state[:n], t.index[0][begin[:n] + k].astype(np.int64))
            total[:n] += weight
        return np.bincount(piece, total, t.n_pieces)


def left_out(tokens: Tokens, counts: list[np.ndarray], n_tokens: int, n_distinct: int, priors) -> np.ndarray:
    """For each prior, the log10 probability of the block's training tokens, each left out of the counts."""
    at = np.full(len(counts[-1]), -1, np.int64)
    scored_at = np.flatnonzero(tokens.scored)
    at[tokens.index[-1][scored_at]] = scored_at
    used = np.flatnonzero((at >= 0) & (tokens.own[-1] > 0))
    at, times = at[used], tokens.own[-1][used]
    by_order = [counts[k][tokens.index[k][at]] - 1 for k in range(tokens.order)]
    contexts = [counts[k][tokens.index[k][at - 1]] - 1 for k in range(tokens.order - 1)]
    out = np.zeros(len(priors))
    for i, m in enumerate(priors):
        p = (by_order[0] + 0.5) / (n_tokens - 1 + 0.5 * (n_distinct + 1))
        for c, context in zip(by_order[1:], contexts):
            p = (c + m * p) / (context + m)
        out[i] = np.log10(p) @ times
    return out


# --- Spark -----------------------------------------------------------------

def _with_counts(blocks: DataFrame, answers: DataFrame, folder: str, order: int, work, schema: str) -> DataFrame:
    """``work(the block's rows, its tokens, their training counts of each order)`` for every block."""
    def run(block: pa.Table, answer: pa.Table) -> pa.Table:
        table = load_block(folder, block["file"][0].as_py())
        parts: list[list] = [[] for _ in range(order)]
        for n, _, raw in sorted(zip(answer["n"].to_pylist(), answer["range"].to_pylist(), answer["counts"].to_pylist())):
            parts[n - 1].append(unpack(raw).astype(np.int64))
        return work(table, Tokens(table, order), [np.concatenate(p or [np.zeros(0, np.int64)]) for p in parts])

    per_block = answers.filter("block is not null").select("block", "n", "range", "counts").groupBy("block")
    return blocks.groupBy("block").cogroup(per_block).applyInArrow(run, schema)


def score_documents(docs: DataFrame, order: int = 2, prior: float | None = None, fold: int = 1, id_col: str = "doc_id",
                    text_col: str = "text", block_bytes: int = BLOCK_BYTES, piece_bytes: int = PIECE_BYTES,
                    range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per document: the id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    ``order`` is the longest n-gram, ``prior`` the weight m of the shorter context
    (chosen from ``PRIORS`` by leaving one out if not given).
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "language-model")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                       held_out(id_col, fold).alias("held_out"))
    blocks = written(spark, write_blocks(rows, folder, order, block_bytes, piece_bytes), "blocks")
    size = rows.agg(F.sum(F.octet_length("text")).alias("n"), F.count_if(~F.col("held_out")).alias("train")).first()
    n_ranges = min(1 << 31, 1 + (size.n or 0) // range_bytes)
    answers = written(spark, requests(blocks, folder, order, n_ranges).groupBy("n", "range").applyInArrow(
        _add_up, "n int, `range` long, block long, counts binary, seen long, total long"), "counts")
    known = answers.filter("n = 1 and block is null").agg(F.sum("seen").alias("seen"), F.sum("total").alias("total")).first()
    # the begin mark is counted once a training document, as a context; it is no token
    begins = size.train if order > 1 else 0
    n_distinct = (known.seen or 0) - (1 if begins else 0)
    n_tokens = (known.total or 0) - begins

    if prior is None:
        def fit(table: pa.Table, tokens: Tokens, counts: list[np.ndarray]) -> pa.Table:
            return pa.table({"prior": PRIORS, "fit": left_out(tokens, counts, n_tokens, n_distinct, PRIORS)})

        prior = PRIORS[0]
        if order > 1:
            fits = _with_counts(blocks, answers, folder, order, fit, "prior double, fit double").groupBy("prior").agg(F.sum("fit").alias("fit"))
            best = max(fits.collect(), key=lambda r: (r.fit, -r.prior), default=None)  # one row a prior
            prior = best.prior if best else prior

    def score(table: pa.Table, tokens: Tokens, counts: list[np.ndarray]) -> pa.Table:
        model = Automaton(tokens, counts, n_tokens, n_distinct, prior)
        where = np.flatnonzero(tokens.scored)
        piece, token = tokens.piece[where], tokens.index[0][where]
        per_piece = lambda weights=None: np.bincount(piece, weights, tokens.n_pieces)
        return pa.table({"place": table["place"], "id": table["id"], "held_out": table["held_out"],
                         "n_tokens": pa.array(per_piece().astype(np.int64)),
                         "n_known": pa.array(per_piece(counts[0][token] > 0).astype(np.int64)),
                         "base_score": pa.array(per_piece(model.base[token]), pa.float64()),
                         "score": pa.array(model.scores(), pa.float64())})

    scored = _with_counts(blocks, answers, folder, order, score,
                          "place long, id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    sums = scored.groupBy("place", "id", "held_out").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return sums.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known",
                       F.lit(n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
