"""Rows that every operator must take, and frames of them."""

LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(20_000))

# (doc_id, text, lang, source): nulls, empty and very long texts, repeated rows, ids that repeat
ODD = [
    (0, "one", "en", "a"), (1, None, None, None), (2, "", "en", "a"), (3, " \t\n\x0b ", "de", "a"),
    (4, "the same words in both of these two texts here", "en", "b"),
    (5, "the same words in both of these two texts here", "en", "b"),
    (5, "the same words in both of these two texts here", "en", "b"),
    (6, LONG, "en", "a"), (7, LONG + " tail", "fr", "c"), (8, "ünï cödé 漢字 😀 ▁ x", None, "c"),
    (9, "mail a.b@c-d.example.com or +1 (234) 555-6789, 10.0.0.255, 4111 1111 1111 1111.", "en", None),
    (None, "no id", "en", "a"), (-3, "negative id of a few words", "en", "a"), (10, "a\nb\na\n\nb", "es", "b"),
    (11, "<|im_end|><|endoftext|></s><0x41> \x00 \x7f", "en", "b"), (12, "x" * 50_000, "en", "b"),
]
CLASHES = ("n_words", "k1", "copies", "replica", "kept_id", "rank_in_text", "hash_of_text", "order_key", "fingerprint",
           "spans", "_c0", "_t", "_w", "kept", "rule", "start", "node", "component", "id", "t", "i", "size", "ids", "digest")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, clashes=False):
    rows = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
    schema = SCHEMA
    if clashes:
        rows = [(*r, *(f"extra {c}" for c in CLASHES)) for r in rows]
        schema += "".join(f", `{c}` string" for c in CLASHES)
    return spark.createDataFrame(rows, schema)
