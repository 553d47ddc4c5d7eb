"""Personal data: fixed patterns, and a character tagger that adds spans.

Four kinds are marked: email, ip, card and phone.  The base spans come from
patterns with checks (part sizes, Luhn digits, number of digits) over the whole
text.  A bidirectional LSTM over characters with a CRF on top adds spans that
the patterns miss; base spans always stay.  It is trained in numpy on windows of
a bounded sample: those around base spans, and those with a form that the
patterns miss, or a look-alike, written into them (``pii_forms``).

Every span holds an *anchor*: a digit, or in an address an at sign or a written
"at" (in brackets, or with a "dot" after it).  The tagger is constrained to
that, so only windows around anchors are decoded: any other window decodes to no
span.  Windows overlap by half; a span that touches an inner edge of its window
is left to the neighbour, or, where it is longer than a window's half, joined
with the neighbour's part.  The spans of all windows of a text are reconciled by
the set of disjoint spans with the greatest total score (base spans come first).

Null texts are empty texts and have no spans.  Spans are [start, end) in code
points.  Repeated rows give repeated rows; extra columns are ignored (or kept,
when texts are redacted).
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pii_forms
from .common import hash_cut, text_array

KINDS = ("email", "ip", "card", "phone")  # in the order of the result (fixed values)
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
N_LABELS = len(LABELS)
WINDOW, STEP = 96, 48
AT = r"[@\uff20]|[\[({<] ?at ?[\])}>]|\bat (?=.{1,40}? dot)"
_AT, _ANCHOR = re.compile(AT, re.I), re.compile(r"\d+|" + AT, re.I)
_USER = re.compile(r"[\w.+%-]+ ?$")

# --- base patterns ---------------------------------------------------------

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a digit run is taken whole, from its start: a later start can't be the leftmost match
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_SIXTEEN = re.compile(r"(?<![0-9])[0-9]{16}(?![0-9])")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain; time in proportion to the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
            at = text.find("@", done)
        else:
            done = at + 1  # no local part reaches over an @
            at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d)
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = []
    if "@" in text:
        out += [(0, a, b) for a, b in _emails(text)]
    if re.search("[0-9]", text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                    out.append((1, *m.span()))
        for m in _CARD.finditer(text):
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= len(_digits(m.group())) <= 15:
                    out.append((3, *m.span()))
    return out


# --- model -----------------------------------------------------------------

CLASSES = 128  # ASCII as it is; other letters, digits and the rest share the classes 1 to 3; 0 is outside the text


def char_classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    out = codes.astype(np.int64)
    for k in np.flatnonzero(codes >= 127):
        c = chr(codes[k])
        out[k] = 1 if c.isalpha() else 2 if c.isdigit() else 3
    out[codes == 0] = 3
    return out


def _lstm(x: np.ndarray, p: dict, d: str, keep: bool):
    """Hidden states (T, B, H) of one direction; gates in the order in, forget, out, cell."""
    steps, n = x.shape
    hidden = p[f"U{d}"].shape[0]
    h, c = np.zeros((n, hidden), np.float32), np.zeros((n, hidden), np.float32)
    out, cache = np.empty((steps, n, hidden), np.float32), []
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        z = p[f"W{d}"][x[t]] + h @ p[f"U{d}"]
        gates = 0.5 * np.tanh(0.5 * z[:, :3 * hidden]) + 0.5
        i, f, o = gates[:, :hidden], gates[:, hidden:2 * hidden], gates[:, 2 * hidden:]
        g = np.tanh(z[:, 3 * hidden:])
        before, c = c, f * c + i * g
        s = np.tanh(c)
        if keep:
            cache.append((t, h, before, i, f, o, g, s))
        h = o * s
        out[t] = h
    return out, cache


def _lstm_back(x: np.ndarray, p: dict, d: str, cache: list, dout: np.ndarray, grad: dict) -> None:
    n = x.shape[1]
    hidden = p[f"U{d}"].shape[0]
    dh, dc = np.zeros((n, hidden), np.float32), np.zeros((n, hidden), np.float32)
    for t, h, before, i, f, o, g, s in reversed(cache):
        dh = dh + dout[t]
        dc = dc + dh * o * (1 - s * s)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * s * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        np.add.at(grad[f"W{d}"], x[t], dz)
        grad[f"U{d}"] += h.T @ dz
        dh, dc = dz @ p[f"U{d}"].T, dc * f


def _logsumexp(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(a - m).sum(axis=axis))


# B-k or I-k before I-k; anything may come before O and B
ALLOWED = np.array([[not to.startswith("I") or (fr != "O" and fr[2:] == to[2:]) for to in LABELS] for fr in LABELS])


def initial(hidden: int, seed: int) -> dict:
    rng = np.random.default_rng(seed)
    p = {}
    for d in "fb":
        p[f"W{d}"] = (rng.standard_normal((CLASSES, 4 * hidden)) * 0.2).astype(np.float32)
        p[f"W{d}"][:, hidden:2 * hidden] += 1  # remember by default
        p[f"U{d}"] = (rng.standard_normal((hidden, 4 * hidden)) * 0.2).astype(np.float32)
    p["V"] = (rng.standard_normal((2 * hidden, N_LABELS)) * 0.2).astype(np.float32)
    p["b"] = np.zeros(N_LABELS, np.float32)
    p["A"] = np.zeros((N_LABELS, N_LABELS), np.float32)
    return p


def emissions(p: dict, x: np.ndarray) -> np.ndarray:
    return np.concatenate([_lstm(x, p, "f", False)[0], _lstm(x, p, "b", False)[0]], axis=2) @ p["V"] + p["b"]


def loss_and_gradient(p: dict, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Mean negative log-likelihood of the label paths ``y`` (T, B) and its gradient."""
    steps, n = x.shape
    hf, cf = _lstm(x, p, "f", True)
    hb, cb = _lstm(x, p, "b", True)
    h = np.concatenate([hf, hb], axis=2)
    e = (h @ p["V"] + p["b"]).astype(np.float64)
    a = np.where(ALLOWED, p["A"], -1e4).astype(np.float64)
    start = np.where([lab.startswith("I") for lab in LABELS], -1e4, 0.0)
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = e[0] + start
    for t in range(1, steps):
        alpha[t] = _logsumexp(alpha[t - 1][:, :, None] + a, 1) + e[t]
    for t in range(steps - 2, -1, -1):
        beta[t] = _logsumexp(a + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    z = _logsumexp(alpha[-1], 1)
    rows = np.arange(n)
    gold = sum(e[t, rows, y[t]] for t in range(steps)) + start[y[0]] + sum(a[y[t - 1], y[t]] for t in range(1, steps))
    de = np.exp(alpha + beta - z[None, :, None])
    da = np.zeros_like(a)
    for t in range(1, steps):
        da += np.exp(alpha[t - 1][:, :, None] + a + (e[t] + beta[t])[:, None, :] - z[:, None, None]).sum(axis=0)
        np.subtract.at(da, (y[t - 1], y[t]), 1)
    for t in range(steps):
        de[t, rows, y[t]] -= 1
    de = (de / n).astype(np.float32)
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    grad["A"] = np.where(ALLOWED, da / n, 0).astype(np.float32)
    hidden = p["Uf"].shape[0]
    grad["V"] = h.reshape(-1, 2 * hidden).T @ de.reshape(-1, N_LABELS)
    grad["b"] = de.sum(axis=(0, 1))
    dh = de @ p["V"].T
    _lstm_back(x, p, "f", cf, dh[:, :, :hidden], grad)
    _lstm_back(x, p, "b", cb, dh[:, :, hidden:], grad)
    return float((z - gold).mean()), grad


def train(windows: list[tuple[np.ndarray, np.ndarray]], hidden: int = 24, rounds: int = 700, batch: int = 64,
          rate: float = 0.02, seed: int = 3) -> dict | None:
    """Model trained on (classes, labels) windows of WINDOW characters by Adam; None without windows."""
    if not windows:
        return None
    x = np.stack([w[0] for w in windows], axis=1)
    y = np.stack([w[1] for w in windows], axis=1)
    rng, p = np.random.default_rng(seed), initial(hidden, seed)
    m, v = ({k: np.zeros_like(q) for k, q in p.items()} for _ in range(2))
    for step in range(1, rounds + 1):
        at = rng.choice(x.shape[1], min(batch, x.shape[1]), replace=False)
        _, grad = loss_and_gradient(p, x[:, at], y[:, at])
        norm = float(np.sqrt(sum((g.astype(np.float64) ** 2).sum() for g in grad.values())))
        scale = min(1.0, 5.0 / (norm + 1e-12))
        slow = rate * (1 - 0.9 * step / rounds)
        for k, g in grad.items():
            g = g * scale
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            p[k] -= (slow * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return p


def viterbi(e: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Best label paths (T, B) of emissions (T, B, labels)."""
    steps, n, _ = e.shape
    a = np.where(ALLOWED, a, np.float32(-1e4))
    score = e[0] + np.where([lab.startswith("I") for lab in LABELS], -1e4, 0.0)
    back = np.empty((steps, n, N_LABELS), np.int8)
    for t in range(1, steps):
        step = score[:, :, None] + a
        back[t] = step.argmax(axis=1)
        score = step.max(axis=1) + e[t]
    path = np.empty((steps, n), np.int64)
    path[-1] = score.argmax(axis=1)
    rows = np.arange(n)
    for t in range(steps - 1, 0, -1):
        path[t - 1] = back[t, rows, path[t]]
    return path


def posteriors(e: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Probability of each label at each place (T, B, labels), by scaled forward and backward passes."""
    steps = len(e)
    move = np.where(ALLOWED, np.exp(a.astype(np.float64)), 0.0)
    local = np.exp(e.astype(np.float64) - e.max(axis=2, keepdims=True))
    forward, backward = np.empty_like(local), np.ones_like(local)
    forward[0] = local[0] * [not lab.startswith("I") for lab in LABELS]
    forward[0] /= forward[0].sum(axis=1, keepdims=True)
    for t in range(1, steps):
        forward[t] = (forward[t - 1] @ move) * local[t]
        forward[t] /= forward[t].sum(axis=1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        backward[t] = (backward[t + 1] * local[t + 1]) @ move.T
        backward[t] /= backward[t].sum(axis=1, keepdims=True)
    both = forward * backward
    return both / both.sum(axis=2, keepdims=True)


# --- windows ---------------------------------------------------------------

def window_starts(text: str, everywhere: bool = False) -> list[int]:
    """Starts of the windows (a grid of STEP) that hold an anchor, or of all."""
    n = len(text)
    last = max(0, -(-(n - WINDOW) // STEP)) if n > WINDOW else 0
    if everywhere:
        return [k * STEP for k in range(last + 1)] if n else []
    found: set[int] = set()
    for m in _ANCHOR.finditer(text):
        lo = max(0, -(-(m.start() - WINDOW + 1) // STEP))
        found.update(range(min(lo, last), min((m.end() - 1) // STEP, last) + 1))
    return [k * STEP for k in sorted(found)]


def _labels_of(spans: list[tuple[int, int, int]], n: int) -> np.ndarray:
    y = np.zeros(n, np.int64)
    for kind, a, b in sorted(spans, key=lambda s: (-s[0], s[1])):  # of overlapping kinds the first wins
        y[a:b] = 2 * kind + 2
        y[a] = 2 * kind + 1
    for k in range(n):  # a span cut by another begins anew
        if y[k] and y[k] % 2 == 0 and (k == 0 or y[k - 1] not in (y[k], y[k] - 1)):
            y[k] -= 1
    return y


def labelled(text: str) -> list[tuple[int, int, int]]:
    """The base spans, and numbers of 16 digits: cards with a mistyped digit where the check fails."""
    spans = base_spans(text)
    return spans + [(2, *m.span()) for m in _SIXTEEN.finditer(text)
                    if not any(a < m.end() and m.start() < b for _, a, b in spans)]


def training_windows(texts: list[str], limit: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Up to ``limit`` windows with an anchor, labelled by ``labelled``."""
    out = []
    for text in texts:
        spans, x = labelled(text), char_classes(text)
        y = _labels_of(spans, len(text))
        for s in window_starts(text):
            if len(out) >= limit:
                return out
            wx, wy = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, np.int64)
            part = x[s:s + WINDOW]
            wx[:len(part)], wy[:len(part)] = part, y[s:s + WINDOW]
            if wy[0] and wy[0] % 2 == 0:
                wy[0] -= 1
            out.append((wx, wy))
    return out


def planted_windows(texts: list[str], limit: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """``limit`` windows with a form or a decoy in them (fewer where a base span already covers the form)."""
    rng, out = np.random.default_rng(seed), []
    for text, kind, start, end in pii_forms.planted(texts, limit, seed):
        spans = labelled(text)
        if kind is not None:
            if any(a < end and start < b for _, a, b in base_spans(text)):
                continue
            spans = [s for s in spans if s[2] <= start or end <= s[1]] + [(kind, start, end)]
        x, y = char_classes(text), _labels_of(spans, len(text))
        s = int(np.clip(start - rng.integers(4, WINDOW - 4), 0, max(0, len(text) - WINDOW)))
        wx, wy = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, np.int64)
        wx[:len(x[s:s + WINDOW])], wy[:len(y[s:s + WINDOW])] = x[s:s + WINDOW], y[s:s + WINDOW]
        if wy[0] and wy[0] % 2 == 0:
            wy[0] -= 1
        out.append((wx, wy))
    return out


def _has_anchor(kind: int, text: str, start: int, end: int) -> bool:
    if kind == 0:
        return bool(_AT.search(text, start, end))
    return any(c.isdecimal() for c in text[start:end])


def _trimmed(score: float, kind: int, a: int, b: int, text: str) -> tuple[float, int, int, int]:
    """The span without closing punctuation; an address that begins with its at sign takes the word before it."""
    while b - 1 > a and text[b - 1] in ".,;:!?":
        b -= 1
    if kind == 0 and _AT.match(text, a):
        word = _USER.search(text[max(0, a - STEP):a])
        a -= len(word.group()) if word else 0
    return score, kind, a, b


def _joined(parts: list[tuple[float, int, int, int, bool, bool]]) -> list[tuple[float, int, int, int]]:
    """Spans over several windows: overlapping parts of a kind, whole at both ends and too long for one window's half.

    Parts are (score, kind, start, end, cut at the left, cut at the right); the score is that of the weakest part."""
    out, now = [], None
    for score, kind, a, b, left, right in sorted(parts, key=lambda p: (p[1], p[2], p[3])):
        if now and now[1] == kind and a <= now[3]:
            now = [min(now[0], score), kind, now[2], max(b, now[3]), now[4], right if b >= now[3] else now[5]]
        else:
            now = [score, kind, a, b, left, right]
        if not now[4] and not now[5] and now[3] - now[2] > STEP:
            out.append(tuple(now[:4]))
    return out


def tagged_spans(p: dict, texts: list[str], everywhere: bool = False, at_once: int = 512) -> list[list[tuple[float, int, int, int]]]:
    """(score, kind, start, end) of the spans in each text's windows, not yet reconciled; the score is the mean
    log-odds of the span's labels."""
    out: list[list] = [[] for _ in texts]
    cut: dict[int, list] = {}
    todo = [(k, s) for k, text in enumerate(texts) for s in window_starts(text, everywhere)]
    classes = {k: char_classes(texts[k]) for k in {k for k, _ in todo}}
    for i in range(0, len(todo), at_once):
        part = todo[i:i + at_once]
        x = np.zeros((WINDOW, len(part)), np.int64)
        for c, (k, s) in enumerate(part):
            w = classes[k][s:s + WINDOW]
            x[:len(w), c] = w
        e = emissions(p, x)
        path = viterbi(e, p["A"])
        sure = np.take_along_axis(posteriors(e, p["A"]), path[:, :, None], 2)[:, :, 0].clip(1e-5, 1 - 1e-5)
        lead = np.log(sure / (1 - sure))
        for c, (k, s) in enumerate(part):
            labels, text = path[:, c], texts[k]
            t, end = 0, min(WINDOW, len(text) - s)
            while t < end:
                if labels[t] == 0:
                    t += 1
                    continue
                kind, u = (labels[t] - 1) // 2, t + 1
                while u < end and labels[u] == 2 * kind + 2:
                    u += 1
                left, right = t == 0 and s > 0, u == end and s + u < len(text)
                span = float(lead[t:u, c].mean()), int(kind), s + t, s + u
                if left or right:
                    cut.setdefault(k, []).append((*span, left, right))
                elif _has_anchor(kind, text, s + t, s + u):
                    out[k].append(_trimmed(*span, text))
                t = u
    for k, parts in cut.items():
        out[k] += [_trimmed(*s, texts[k]) for s in _joined(parts) if _has_anchor(s[1], texts[k], s[2], s[3])]
    return out


def reconcile(spans: list[tuple[float, int, int, int]], base: list[tuple[int, int, int]], least_score: float) -> list[tuple[int, int, int]]:
    """Base spans and the disjoint set of other spans with the greatest total score.

    A span found in several windows counts once, with its best score; spans
    that overlap a base span go.  Ties go to the span that ends first.
    """
    best: dict[tuple[int, int, int], float] = {}
    covered, until = [], 0  # merged ranges of the base spans
    for _, a, b in sorted(base, key=lambda s: s[1:]):
        if covered and a < until:
            until = covered[-1][1] = max(until, b)
        else:
            covered.append([a, b])
            until = b
    starts = [a for a, _ in covered]
    for score, kind, a, b in spans:
        if score >= least_score and score > best.get((kind, a, b), -1e30):
            best[(kind, a, b)] = score
    free = []
    for kind, a, b in sorted(best, key=lambda s: (s[2], s[1], s[0])):
        k = bisect_left(starts, b) - 1  # the last range that begins before the span's end
        if k < 0 or covered[k][1] <= a:
            free.append((kind, a, b))
    ends = [s[2] for s in free]
    total, back = [0.0], []
    for k, s in enumerate(free):
        j = bisect_right(ends, s[1], 0, k)
        take = total[j] + best[s]
        back.append((take > total[k], j))
        total.append(max(total[k], take))
    chosen, k = [], len(free)
    while k:
        took, j = back[k - 1]
        if took:
            chosen.append(free[k - 1])
        k = j if took else k - 1
    return sorted([*base, *chosen])


def find_spans(texts: list[str], p: dict | None, least_score: float = 1.0) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    if p is None:
        return [(b, sorted(b)) for b in base]
    return [(b, reconcile(s, b, least_score)) for b, s in zip(base, tagged_spans(p, texts))]


# --- Spark -----------------------------------------------------------------

def fit(docs: DataFrame, fit_docs: int = 600, fit_chars: int = 20_000, fit_windows: int = 1_500,
        planted: int = 6_000, text_col: str = "text", seed: int = 5, **options) -> dict | None:
    """The tagger, trained on at most ``fit_docs`` different texts of up to ``fit_chars`` characters with an
    anchor, by least hash of the text: ``fit_windows`` of their windows as they are, ``planted`` with a form in them."""
    text = F.col(text_col).cast("string")
    rows = (docs.select(text.alias("t")).filter(F.col("t").isNotNull() & (F.length("t") <= fit_chars) & F.col("t").rlike(r"(?i)\p{Nd}|" + AT))
            .select(F.xxhash64(F.lit(seed), "t").alias("h"), "t"))
    different = rows.agg(F.approx_count_distinct("h")).first()[0]
    rows = rows.filter(F.col("h") <= hash_cut(fit_docs, different))
    rows = rows.groupBy("h").agg(F.min("t").alias("t")).orderBy("h").limit(fit_docs).collect()
    texts = list(dict.fromkeys(r.t for r in rows))
    return train(training_windows(texts, fit_windows) + planted_windows(texts, planted, seed), **options)


def _digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def detect(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the id, n_email, n_ip, n_card, n_phone and base_sha256 (base spans), spans (all)."""
    rows = docs.select(id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    schema = f"`{id_col}` {rows.schema[0].dataType.simpleString()}, {counts}, base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_array(batch.column(1))
            for i in range(0, len(texts), 256):
                found = find_spans(texts[i:i + 256].to_pylist(), shared.value)
                arrays = [batch.column(0)[i:i + 256]]
                arrays += [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
                arrays.append(pa.array([hashlib.sha256(_digest(base).encode()).hexdigest() for base, _ in found]))
                arrays.append(pa.array([_digest(spans) for _, spans in found], pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, [id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return rows.mapInArrow(run, schema)


def redact_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span (joined ones together) replaced by its kind in brackets."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[0])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: dict | None) -> DataFrame:
    """``docs`` with all spans of the column ``text`` redacted and ``n_chars`` brought up to date; null texts stay."""
    names = [c.lower() for c in docs.columns]
    at = names.index("text")
    count = names.index("n_chars") if "n_chars" in names else None
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = text_array(part.column(at)).to_pylist()
                done = [redact_text(t, spans) for t, (_, spans) in zip(texts, find_spans(texts, shared.value))]
                null = part.column(at).is_null().to_pylist()
                columns = list(part.columns)
                columns[at] = pa.array([None if z else t for t, z in zip(done, null)], columns[at].type)
                if count is not None:
                    old = columns[count].to_pylist()
                    columns[count] = pa.array([len(t) if t != before else was for t, before, was in zip(done, texts, old)],
                                              columns[count].type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)


def detect_documents(docs: DataFrame, **sample) -> DataFrame:
    """Fit on a bounded sample of ``docs`` and mark personal data in all of them."""
    return detect(docs, fit(docs, **sample))


def redact_documents(docs: DataFrame, **sample) -> DataFrame:
    return redact(docs, fit(docs, **sample))
