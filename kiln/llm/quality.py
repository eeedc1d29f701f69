"""Quality rules: a learned decision list, in DataFrame functions only.

Statistics of each text are columns.  From labelled rows sequential covering learns
rules for low quality: a rule grows by the threshold condition with the best FOIL
gain on two thirds of the rows, is pruned to the prefix that does best on the other
third, and is kept while it is right there in ``LEAST_PRECISION`` of its cases; the
rows that it covers are then left out and the next rule grows.  The list becomes one
ordered conditional expression.

Thresholds are exact quantiles of rounded statistics.  Counts for all conditions of a
step come from one aggregate over (statistic, bin, label), so the driver gets a few
hundred rows a step, whatever the number of labels.

Defined cases: null and empty texts have no words, so they fail the base rules; with
no labels, or none of either class, the list is empty and keeps all that passes the
base; a label counts for every row with its id, null labels and ids don't; further
columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import query, table, written

BINS = 40
MOST_RULES = 12
MOST_CONDITIONS = 4
LEAST_PRECISION = 0.9
LEAST_CASES = 4
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

STATISTICS = ("words_log2", "word_length", "symbol_share", "upper_share", "mark_share", "dup_line_share", "repeat_share")


def rule_statistics() -> dict:
    """What rules are made of; rounded, so that their quantiles are exact in bounded memory."""
    def share(part: str, whole: str) -> Column:
        return F.round(F.col(part) / F.greatest(whole, F.lit(1)), 4)

    return dict(zip(STATISTICS, (
        F.round(F.log2(F.col("n_words") + 1), 2), F.round(F.col("word_chars") / F.greatest("n_words", F.lit(1)), 2), share("n_symbols", "word_chars"),
        share("n_upper", "word_chars"), share("n_marks", "word_chars"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"))))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that a text holds twice or more."""
    def counted(w):
        grams = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(
            let(F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i")))), lambda s: covered(places(s)))))

    def places(s):
        twice = F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["g"] == x["g"])) | F.coalesce(F.get(s, i + 1)["g"] == x["g"], F.lit(False)))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(at):
        return let(at, lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x))

    return F.when(F.size(words) < 4, 0).otherwise(counted(words))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id with the counts that rules use, of whole texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, r"[ \t-\r]+"), "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^ \t-\r]"))
    of_words = let(words, lambda w: F.struct(F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"), repeated_words(w).alias("n_repeat_words")))
    of_lines = let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    out = docs.select("doc_id", of_words.alias("w"), of_lines.alias("l"), *(
        F.regexp_count(text, F.lit(p)).alias(c) for c, p in (("n_symbols", "[#*$%&|<>]"), ("n_upper", r"\p{Lu}"), ("n_marks", "[!?]"))))
    return out.select("doc_id", *(F.col(c).cast("long").alias(c.split(".")[-1]) for c in (
        "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines", "n_upper", "n_marks")))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def condition(c: tuple) -> Column:
    name, above, at = c
    return F.col(name) > at if above else F.col(name) <= at


def conjunction(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & condition(c)
    return out


def bin_of(name: str, cuts: list) -> Column:
    """How many thresholds a statistic is above."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda x: x < F.col(name)))


def grown(rows: DataFrame, cuts: dict) -> list:
    """The conditions of a new rule, in the order in which they were added."""
    rule: list = []
    bins = F.array(*(F.struct(F.lit(s).alias("s"), bin_of(s, at).alias("bin")) for s, at in cuts.items() if at))
    while len(rule) < MOST_CONDITIONS:
        cells = (rows.filter(F.col("grow") & conjunction(rule)).select(F.inline(bins), "bad").groupBy("s", "bin").agg(F.sum(F.col("bad")).alias("p"), F.sum(1 - F.col("bad")).alias("n"))).collect()
        by = {s: [[0, 0] for _ in range(len(at) + 1)] for s, at in cuts.items() if at}
        for r in cells:
            by[r["s"]][r["bin"]] = [r["p"], r["n"]]
        totals = next(iter(by.values()))
        p0, n0 = (sum(x[j] for x in totals) for j in (0, 1))
        if not p0 or not n0:
            break
        best = (0.0, None)
        for s in sorted(by):
            p = n = 0
            for at, (dp, dn) in zip(cuts[s], by[s]):
                p, n = p + dp, n + dn                                   # rows at or below the threshold
                for above, cp, cn in ((False, p, n), (True, p0 - p, n0 - n)):
                    if cp:
                        gain = cp * (math.log2(cp / (cp + cn)) - math.log2(p0 / (p0 + n0)))
                        if gain > best[0] + 1e-9:
                            best = (gain, (s, above, at))
        if best[1] is None:
            break
        rule.append(best[1])
    return rule


def pruned(rows: DataFrame, rule: list) -> tuple[list, int, int]:
    """The prefix of a rule that does best on the rows that it didn't grow on; its right and wrong cases there."""
    cases = rows.filter(~F.col("grow")).agg(*(F.coalesce(F.sum(F.when(conjunction(rule[: k + 1]), y)), F.lit(0)).alias(f"{j}{k}")
                                              for k in range(len(rule)) for j, y in (("p", F.col("bad")), ("n", 1 - F.col("bad"))))).first()
    best = max(range(len(rule)), key=lambda k: ((cases[f"p{k}"] - cases[f"n{k}"]) / max(1, cases[f"p{k}"] + cases[f"n{k}"]), cases[f"p{k}"], -k))
    return rule[: best + 1], cases[f"p{best}"], cases[f"n{best}"]


def learn(rows: DataFrame) -> list:
    """Rules for low quality, in order, from the statistics, grow and bad (0 or 1); each a list of (statistic, above, threshold)."""
    rows = rows.select(*STATISTICS, "grow", "bad").persist()
    try:
        spread = [F.percentile(s, F.array(*(F.lit(i / BINS) for i in range(1, BINS)))).alias(s) for s in STATISTICS]
        both = rows.groupBy("bad").agg(*spread).collect()                  # of each class, as the low one can be rare
        if len(both) < 2:
            return []
        cuts = {s: sorted({x for r in both for x in r[s]}) for s in STATISTICS}
        rules: list = []
        left = rows
        while len(rules) < MOST_RULES:
            rule = grown(left, cuts)
            if not rule:
                break
            rule, right, wrong = pruned(left, rule)
            if right < LEAST_CASES or right < LEAST_PRECISION * (right + wrong):
                break
            rules.append(rule)
            left = left.filter(~conjunction(rule))
        return rules
    finally:
        rows.unpersist()


def verdict(rules: list) -> Column:
    """The decision list: False at the first rule that holds."""
    out = None
    for rule in rules:
        out = F.when(conjunction(rule), F.lit(False)) if out is None else out.when(conjunction(rule), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document row: doc_id, the base counts, base_failed, kept."""
    counted = written(statistics(docs), "statistics").withColumns(rule_statistics())
    known = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", (1 - F.col("quality")).cast("long").alias("bad"))
    rules = learn(counted.filter(~base_failed()).join(known, "doc_id").withColumn("grow", F.crc32(F.col("doc_id").cast("string")) % 3 != 0))
    return counted.select("doc_id", *BASE, base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"))


@query("op4_quality_rules")
def op4(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
