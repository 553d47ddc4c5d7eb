import hashlib
from collections import Counter

import numpy as np
import sentencepiece

import corpus_pipeline
from staykit.llm import pii, piece_bpe, quality_rules
from staykit.llm.catalog import ORACLE, REGISTRY

from test_mixing import drawn, rates_of
from test_ngram_join import brute
from test_quality_rules import statistics

SMALL = "/root/testdata/sf0.001"


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    # quality: the learned list, applied row by row to separately computed statistics
    rules = quality_rules.learn_rules(quality_rules.labelled_sample(docs, labels))
    features = {r.doc_id: r.asDict() for r in quality_rules.judge(docs, []).collect()}
    good = []
    for i, r in rows.items():
        n, _, _, _, repeat = statistics(r.text)
        if n >= 10 and 100 * repeat <= 20 * n and not any(all(c.holds(features[i]) for c in rule) for rule in rules):
            good.append(i)
    # near duplicates
    kept = [c for i, _, c, _ in brute([(i, rows[i].text) for i in good]) if c == i]
    # personal data: the tagger of the stage
    left = docs.filter(docs.doc_id.isin(kept))
    model = pii.fit(left)
    texts = {i: pii.redact_text(rows[i].text, pii.find_spans([rows[i].text], model)[0][1]) for i in kept}
    # mixing
    rates = rates_of([rows[i].source for i in kept], lambda s, n: n ** 0.5)
    copies = {i: drawn(rates[rows[i].source], i) for i in kept}
    # encoding by the library
    library = sentencepiece.SentencePieceProcessor(model_file=piece_bpe.model_path())
    want = Counter()
    for i in kept:
        ids = library.encode(texts[i], add_bos=True, add_eos=True)
        want[(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), library.decode(ids))] += copies[i]
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert got == +want and len(got) > 50


def test_stages_keep_the_columns_and_survive_odd_documents(spark, odd, nothing, tmp_path):
    plain = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd, nothing, odd.select(*plain)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns, name
            out.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count()


def test_registry():
    assert [k.split("_")[0] for k in REGISTRY] == [f"op{n}" for n in range(1, 14)]
    assert set(ORACLE) <= set(REGISTRY)
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]
