"""Quality rules: an ordered decision list learned from labelled statistics.

All statistics of a text are Spark expressions.  The list is learned by
sequential covering on a bounded sample of labelled documents: a rule starts
empty and grows by the threshold condition with the best gain until it covers
(almost) only bad documents, is pruned from its end on rows kept aside, and is
accepted if it is precise there; the rows it covers are taken out and the next
rule is grown.  The accepted rules become one ordered ``CASE WHEN``.

Words are runs of characters other than ASCII white space.  A null text has no
words.  Documents that fail the base test (under ten words, or more than a
fifth of the words in five-word windows that recur) are never kept.  Without
labelled rows the list is empty and the base test alone decides.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_cut

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
FEATURES = ("n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "mark_share")


# --- statistics ------------------------------------------------------------

def _bind(value: Column, use) -> Column:
    """``use`` of a value that is computed once (a lambda variable holds it)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _words_in_recurring_windows(words: Column) -> Column:
    """Words in five-word windows that occur twice or more: windows are compared as texts."""
    n = F.size(words)
    # words hold no spaces, so joined windows are equal only if their words are
    windows = F.transform(F.sequence(F.lit(0), n - WINDOW),
                          lambda i: F.struct(F.array_join(F.slice(words, i + 1, F.lit(WINDOW)), " ").alias("w"), i.alias("p")))

    def places(s: Column) -> Column:
        def recurs(x: Column, j: Column) -> Column:
            return (F.coalesce(F.get(s, j - 1)["w"] == x["w"], F.lit(False))
                    | F.coalesce(F.get(s, j + 1)["w"] == x["w"], F.lit(False)))
        return F.sort_array(F.transform(F.filter(s, recurs), lambda x: x["p"]))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1), x + WINDOW) - x)),
                           F.lit(0).cast("long"), lambda a, x: a + x)

    return _bind(_bind(F.sort_array(windows), places), covered)


def text_statistics(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the statistics of each text (the text itself goes)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept = [F.col(c) for c in keep]
    s = docs.select(*kept, text.alias("_t"), F.filter(F.split(text, SPACE), lambda w: w != "").alias("_w"))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    s = s.select(*kept, "_t", "_w", F.size("_w").cast("long").alias("n_words"), lines.alias("_l"),
                 F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"))
    # equal windows have equal hashes, so texts whose window hashes all differ need no comparison
    hashes = F.transform(F.sequence(F.lit(0), F.size("_h") - WINDOW),
                         lambda i: F.xxhash64(*(F.get(F.col("_h"), i + k) for k in range(WINDOW))))
    s = s.select(*kept, "_t", "_w", "_l", "_h", "n_words", F.when(F.size("_w") > WINDOW, hashes).alias("_x"))
    recurs = F.coalesce(F.size("_x") > F.size(F.array_distinct("_x")), F.lit(False))
    n_chars = F.length("_t")
    s = s.select(
        *kept, "n_words",
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (n_chars - F.length(F.regexp_replace("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.when(recurs, _words_in_recurring_windows(F.col("_w"))).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_l").alias("_lines"), F.size(F.array_distinct("_h")).alias("_distinct"),
        (n_chars - F.length(F.regexp_replace("_t", "[A-Z]+", ""))).alias("_upper"),
        (n_chars - F.length(F.regexp_replace("_t", r"[!?|]+", ""))).alias("_marks"))

    def share(a: str, b: str) -> Column:
        return F.col(a) / F.greatest(F.col(b), F.lit(1))

    return s.select(*kept, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    share("word_chars", "n_words").alias("mean_word"), share("n_symbols", "n_words").alias("symbol_share"),
                    share("n_dup_lines", "_lines").alias("dup_line_share"), share("n_repeat_words", "n_words").alias("repeat_share"),
                    share("_distinct", "n_words").alias("distinct_share"), share("_upper", "word_chars").alias("upper_share"),
                    share("_marks", "n_words").alias("mark_share"))


# --- learning --------------------------------------------------------------

@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature >= threshold, else feature <= threshold
    threshold: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] >= self.threshold if self.above else row[self.feature] <= self.threshold

    def column(self) -> Column:
        c = F.col(self.feature)
        return c >= F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _counts(rule: Rule, rows: list[dict]) -> tuple[int, int]:
    covered = [r for r in rows if all(c.holds(r) for c in rule)]
    bad = sum(r["bad"] for r in covered)
    return bad, len(covered) - bad


def _best_condition(rows: list[dict], features, steps: int) -> Condition | None:
    """The condition with the best FOIL gain over ``rows``; thresholds lie between quantiles."""
    p0, n0 = sum(r["bad"] for r in rows), sum(not r["bad"] for r in rows)
    best, best_gain = None, 1e-9
    for f in features:
        ordered = sorted(rows, key=lambda r: r[f])
        total, bad = len(ordered), 0
        cuts = {round(total * k / steps) for k in range(1, steps)} | set(range(1, min(total, 33))) | set(range(max(1, total - 32), total))
        for k in range(1, total):
            bad += ordered[k - 1]["bad"]
            low, high = ordered[k - 1][f], ordered[k][f]
            if k not in cuts or low == high:
                continue
            middle = (low + high) / 2
            for above, p, n in ((False, bad, k - bad), (True, p0 - bad, n0 - (k - bad))):
                if p:
                    gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                    if gain > best_gain:
                        best, best_gain = Condition(f, above, middle), gain
    return best


def learn_rules(rows: list[dict], features=FEATURES, precision: float = 0.95, least: int = 5, max_rules: int = 24,
                max_conditions: int = 4, steps: int = 64) -> list[Rule]:
    """An ordered list of rules for bad documents; ``rows`` hold the features, ``bad`` and ``aside`` (kept for pruning)."""
    grow, prune = [r for r in rows if not r["aside"]], [r for r in rows if r["aside"]]
    rules: list[Rule] = []
    while len(rules) < max_rules and any(r["bad"] for r in grow):
        covered, rule = grow, ()
        while len(rule) < max_conditions and any(not r["bad"] for r in covered):
            condition = _best_condition(covered, features, steps)
            if condition is None:
                break
            rule += (condition,)
            covered = [r for r in covered if condition.holds(r)]
        if not rule:
            break

        def worth(r: Rule) -> float:
            p, n = _counts(r, prune)
            return (p - n) / (p + n) if p + n else -1.0

        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)  # of equal ones the longest
        (p, n), (gp, gn) = _counts(rule, prune), _counts(rule, grow)
        if p + gp < least or p + n == 0 or (p + gp) / (p + n + gp + gn) < precision or p / (p + n) < precision:
            break
        rules.append(rule)
        grow = [r for r in grow if not all(c.holds(r) for c in rule)]
        prune = [r for r in prune if not all(c.holds(r) for c in rule)]
    return rules


def labelled_sample(docs: DataFrame, labels: DataFrame, fit_rows: int = 6_000, seed: int = 11) -> list[dict]:
    """Statistics of at most ``fit_rows`` labelled documents (by least hash of the id), for fitting only."""
    labelled = labels.select(F.col("doc_id").cast("long").alias("id"), (F.col("quality") == 0).alias("bad"),
                             F.xxhash64(F.lit(seed), F.col("doc_id").cast("long")).alias("h")).filter("id is not null and bad is not null")
    picked = (labelled.filter(F.col("h") <= hash_cut(fit_rows, labelled.count())).groupBy("h", "id")
              .agg(F.max("bad").alias("bad")).orderBy("h", "id").limit(fit_rows))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    rows = rows.join(F.broadcast(picked), F.col("doc_id") == F.col("id")).limit(fit_rows)
    aside = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(3)) == 0
    stats = text_statistics(rows.withColumn("aside", aside), keep=("doc_id", "bad", "aside"))
    found = [r.asDict() for r in stats.select("doc_id", "bad", "aside", *FEATURES).collect()]
    return sorted(found, key=lambda r: (r["doc_id"], *(r[f] for f in FEATURES)))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects a document (from 1), or 0."""
    out = None
    for k, rule in enumerate(rules, 1):
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        out = F.when(test, F.lit(k)) if out is None else out.when(test, F.lit(k))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def judge(docs: DataFrame, rules: list[Rule], keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Statistics and decisions: base_failed, rule (the first that rejects, or 0), kept."""
    s = text_statistics(docs, text_col, keep)
    s = s.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return s.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def judge_documents(docs: DataFrame, labels: DataFrame, **sample) -> DataFrame:
    """doc_id, statistics, base_failed and kept of every document, by rules learned from ``labels``."""
    rules = learn_rules(labelled_sample(docs, labels, **sample))
    return judge(docs, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                     "base_failed", "kept", "rule")


def keep_good(docs: DataFrame, labels: DataFrame, **sample) -> DataFrame:
    """The documents that are kept, all columns as they are."""
    rules = learn_rules(labelled_sample(docs, labels, **sample))
    names = docs.columns
    # columns are numbered meanwhile, so none can clash with a statistic
    numbered = docs.select(*(F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(names)))
    text = f"_c{[c.lower() for c in names].index('text')}"
    judged = judge(numbered, rules, keep=tuple(numbered.columns), text_col=text)
    # A filter is pushed below the projections it reads from, its columns spelled out: every statistic would be
    # computed anew inside the loops of the others.  No filter is pushed below a row number.
    judged = judged.withColumn("_row", F.monotonically_increasing_id()).filter("kept and _row >= 0")
    return judged.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(names)))
