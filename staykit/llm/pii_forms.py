"""Forms of personal data that the base patterns miss, written from templates into sample texts.

They are the labelled spans from which the tagger learns to add to the base
ones: addresses with the at sign or the dots spelled out, spaced or in another
script; IP numbers with guarded or spaced dots; card numbers of other groupings
or with a mistyped digit; phone numbers without a plus sign.  *Decoys* are
figures that look alike and are no personal data (dates, prices, versions,
times, keys).  Everything is drawn from a seeded generator.
"""

from __future__ import annotations

import random
import string

# Templates: u a user, d a domain, t its ending; # a digit, N a digit from 2 to 9, o an octet.
EMAILS = ("u(at)d.t", "u (at) d.t", "u[at]d.t", "u [at] d [dot] t", "u(at)d(dot)t", "u at d dot t", "u AT d DOT t", "u @ d.t",
          "u＠d.t", "u@éd.t", "u@düd.t", "u {at} d {dot} t")
IPS = ("o[.]o[.]o[.]o", "o . o . o . o", "o(.)o(.)o(.)o", "o dot o dot o dot o", "o[dot]o[dot]o[dot]o", "o. o. o. o")
CARDS = ("####-####-####-####", "#### #### #### ####", "################", "####.####.####.####", "####/####/####/####",
         "####  ####  ####  ####", "#### ###### #####", "####-######-#####", "####_####_####_####")
PHONES = ("(N##) N##-####", "(N##) ###-####", "(N##)###-####", "N##-N##-####", "N##.N##.####", "1-N##-N##-####", "0## #### ####",
          "0N## ### ####", "00## ## #######", "00## N## ######", "+##/N##/######", "0N##/#######", "(0##) #### ####", "0N## ######")
DECOYS = ("20##-0N-1#", "1#.0N.20##", "0N/1#/20##", "#.##", "#.#.#", "v#.#.##", "$#,###.##", "##,###.## EUR", "1#:##", "1#:##:##", "##-##",
          "N#", "N###", "20##", "N##,###", "#,###,###", "20##/20##", "##%", "no. #####", "ISBN 978-N-##-######-#", "#####-#####", "0.######",
          "N#x##", "x", "x", "at 1#:##", "at d", "dot d", "at d and dot t", "(a) d (b) u", "@u", "#d", "d2", "[##]", "(20##)", "pp. N##-N##",
          "o.o", "N### ####", "#### d ####", "##########################", "#####", "######")
ENDINGS = ("com", "org", "net", "de", "fr", "es", "io", "edu", "info", "co.uk")
TEMPLATES = (EMAILS, IPS, CARDS, PHONES)  # in the order of the kinds


def _word(rng: random.Random, words: list[str]) -> str:
    if words and rng.random() < 0.6:
        return rng.choice(words)
    return "".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(3, 9)))


def _user(rng: random.Random, words: list[str]) -> str:
    user = _word(rng, words)
    if rng.random() < 0.5:
        user += rng.choice("._-") + _word(rng, words)
    return user + str(rng.randint(0, 99)) if rng.random() < 0.3 else user


def filled(template: str, rng: random.Random, words: list[str]) -> str:
    """The template with its places filled (x: a key of 32 to 40 hexadecimal digits)."""
    if template == "x":
        return 'token = "' + "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice((32, 36, 40)))) + '"'
    make = {"u": lambda: _user(rng, words), "d": lambda: _word(rng, words), "t": lambda: rng.choice(ENDINGS),
            "#": lambda: str(rng.randint(0, 9)), "N": lambda: str(rng.randint(2, 9)), "o": lambda: str(rng.randint(0, 255))}
    out, k = [], 0
    while k < len(template):
        literal = next((w for w in ("dot", "DOT", "at", "AT", "token", "and", "no.", "pp.", "EUR", "ISBN") if template.startswith(w, k)), None)
        if literal:
            out.append(literal)
            k += len(literal)
        else:
            out.append(make.get(template[k], lambda c=template[k]: c)())
            k += 1
    return "".join(out)


def form(rng: random.Random, words: list[str], decoys: float = 0.4) -> tuple[int | None, str]:
    """(kind, or None for a decoy, text) of one form."""
    if rng.random() < decoys:
        return None, filled(rng.choice(DECOYS), rng, words)
    kind = rng.randrange(len(TEMPLATES))
    return kind, filled(rng.choice(TEMPLATES[kind]), rng, words)


def planted(texts: list[str], n: int, seed: int, around: int = 110) -> list[tuple[str, int | None, int, int]]:
    """``n`` times (text, kind or None, start, end): an excerpt of a sample text with a form written at a space."""
    rng = random.Random(seed)
    texts = [t for t in texts if t.strip()]
    words = sorted({w for t in texts for w in t[:2000].split() if 3 <= len(w) <= 9 and w.isascii() and w.isalpha()})[:5000]
    out = []
    for _ in range(n if texts else 0):
        text = rng.choice(texts)
        at = text.find(" ", rng.randrange(len(text)))
        at = len(text) if at < 0 else at
        kind, put = form(rng, words)
        before = text[max(0, at - around):at]
        before += " " if before else ""
        after = rng.choice(("", "", "", ".", ",", "!!", "###", ")")) + text[at:at + around]
        out.append((before + put + after, kind, len(before), len(before) + len(put)))
    return out
