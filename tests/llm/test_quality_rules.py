import re
from collections import Counter

from pyspark.sql import functions as F

from staykit.llm import quality_rules as q

from text_cases import ODD


def statistics(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    seen, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_statistics_of_odd_documents(spark):
    texts = [r[1] for r in ODD] + ["a b c d e a b c d e f", "x " * 11, "a b c d e " * 3 + "b c d e a", "\r\n\x0c# | # |\n# | # |", "Zé Zé Zé Zé Zé Zé"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in q.judge(docs, []).collect():
        want = statistics(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, texts[r.doc_id]
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def test_statistics_of_a_table(sample):
    docs, rows = sample
    got = {r.doc_id: r for r in q.judge(docs, []).collect()}
    for d in rows:
        r = got[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == statistics(d.text)


def rows_of(n, bad):
    blank = dict.fromkeys(q.FEATURES, 0.0)
    return [blank | {"n_words": float(i), "symbol_share": (i * 7 % 10) / 10, "bad": bad(i, (i * 7 % 10) / 10), "aside": i % 3 == 0} for i in range(n)]


def test_rules_find_planted_conjunctions():
    rows = rows_of(600, lambda n, s: n < 120 or (s >= 0.7 and n < 400))
    rules = q.learn_rules(rows)
    agree = sum(any(all(c.holds(r) for c in rule) for rule in rules) == r["bad"] for r in rows)
    assert agree >= 0.97 * len(rows) and 2 <= len(rules) <= 4


def test_noise_gives_no_rules():
    assert q.learn_rules(rows_of(600, lambda n, s: n * 2654435761 % 97 < 12)) == []
    assert q.learn_rules([]) == [] and q.learn_rules(rows_of(50, lambda n, s: False)) == []


def test_expressions_agree_with_the_rules(spark):
    rows = rows_of(300, lambda n, s: n < 60 or s >= 0.8)
    rules = q.learn_rules(rows)
    frame = spark.createDataFrame([(i, *(r[f] for f in q.FEATURES)) for i, r in enumerate(rows)],
                                  "i long, " + ", ".join(f"{f} double" for f in q.FEATURES))
    for i, v in frame.select("i", q.verdict(rules).alias("v")).collect():
        first = next((k for k, rule in enumerate(rules, 1) if all(c.holds(rows[i]) for c in rule)), 0)
        assert v == first


def test_labelled_tables_are_separated(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = q.judge_documents(docs, labels).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    share = {r[0]: r[1] for r in judged}
    assert share[1] > 0.95 and share[0] < 0.2


def test_no_python_in_the_plan(sample, spark):
    docs, _ = sample
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    plan = q.keep_good(docs, labels)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|ExistingRDD", plan)


def test_columns_stay_and_odd_rows_do_not_crash(odd, nothing, spark):
    labels = spark.createDataFrame([(0, 0), (None, 1), (4, None), (5, 1), (5, 0)], "doc_id long, quality int")
    kept = q.keep_good(odd, labels)
    assert kept.columns == odd.columns
    assert all(r.doc_id not in (0, 1, 2, 3) for r in kept.collect())
    assert q.judge_documents(odd, labels).count() == len(ODD)
    assert q.keep_good(nothing, labels.limit(0)).collect() == []
    assert q.judge_documents(odd, labels.limit(0)).count() == len(ODD)
