import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tideline.llm.quality_rules import (
    FEATURES,
    Condition,
    feature,
    learn_rules,
    quality_rules,
    text_statistics,
    verdict,
)


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {k for v in windows.values() if len(v) > 1 for i in v for k in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def counts(df):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return [(r.doc_id, tuple(r[n] for n in names)) for r in text_statistics(df).collect()]


def test_statistics(make):
    rng = random.Random(1)
    pool = ["a", "bb", "É!", "#x", "the", "\n", "\n\n", " ", "\t", "\x0b", " ", "日本", "a b c d e"]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    for i, found in counts(make(rows)):
        assert found == brute(rows[i][1]), rows[i][1]


def test_edge_cases(edge, nothing):
    texts = {r.doc_id: r.text for r in edge.collect()}
    assert len(counts(edge)) == 11
    for i, found in counts(edge):
        assert found == brute(texts[i])
    assert counts(nothing) == []


def labelled(make, n=600):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = ["".join(rng.choice("abcdef") for _ in range(rng.randint(2, 8))) for _ in range(40)]
        docs.append((i, " ".join(w + "###" * bad * (rng.random() < 0.8) for w in words)))
        labels.append((i, 0 if bad else 1))
    return make(docs), labels


def test_learned_list(spark, make):
    docs, labels = labelled(make)
    judged, rules = quality_rules(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert 1 <= len(rules) <= 8 and all(isinstance(c, Condition) for rule in rules for c in rule)
    known = dict(labels)
    right = sum(r.kept == bool(known[r.doc_id]) for r in judged.collect())
    assert right >= 0.99 * len(labels)


def test_nothing_to_learn(spark, make, edge, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    judged, rules = quality_rules(edge, none)
    assert rules == []
    assert all(r.kept != r.base_failed for r in judged.collect())
    one = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, quality int")
    assert quality_rules(edge, one)[1] == []
    assert quality_rules(nothing, one)[0].count() == 0


def test_order_of_conditions(spark):
    rules = [(Condition("n_words", False, 10.0),), (Condition("symbols_per_word", True, 0.5),)]
    rows = spark.createDataFrame([(5, 0), (20, 20), (20, 1), (0, 0)], "n_words long, n_symbols long")
    kept = [r[0] for r in rows.select(verdict(rules).alias("k")).collect()]
    assert kept == [False, False, True, False]
    assert [r[0] for r in rows.select(verdict([])).collect()] == [True] * 4


def test_repeats_of_a_very_long_text(make):
    text = ("one two three four five six " * 20_000).strip()
    [(_, found)] = counts(make([(1, text)]))
    assert found[0] == found[4] == 120_000


def test_learning_uses_no_identifiers(spark, make):
    docs, labels = labelled(make, 300)
    frame = spark.createDataFrame(labels, "doc_id long, quality int")
    stats = text_statistics(docs).join(frame, "doc_id").withColumn("row_key", F.col("doc_id"))
    assert learn_rules(stats) == learn_rules(stats.withColumn("doc_id", -F.col("doc_id")))


def statistics(spark, rows):
    """Labelled statistics: (label, words, symbols, punctuation)."""
    names = "n_words word_chars n_symbols n_punctuation n_upper n_dup_lines n_lines n_repeat_words n_distinct_words"
    full = [
        (i, label, words, words * 5, symbols, marks, words, 0, 10, 0, words)
        for i, (label, words, symbols, marks) in enumerate(rows)
    ]
    columns = ", ".join(f"{n} long" for n in names.split())
    return spark.createDataFrame(full, f"row_key long, quality int, {columns}")


def covered(rows, rules, label):
    kept = rows.withColumn("kept", verdict(rules))
    return kept.filter(~F.col("kept") & (F.col("quality") == label)).count()


@pytest.mark.parametrize(("rejects", "with_some"), [(60, 300), (15, 80)])
def test_rare_rejects_that_one_threshold_tells_apart(spark, rejects, with_some):
    rng = random.Random(rejects)
    rows = [(0, 100, 400, 10)] * rejects
    rows += [(1, 100, rng.randint(1, 89), 10) for _ in range(with_some)]
    rows += [(1, rng.randint(80, 120), 0, 10) for _ in range(20_000 - rejects - with_some)]
    df = statistics(spark, rows)
    rules = learn_rules(df)
    assert covered(df, rules, 0) == rejects and covered(df, rules, 1) == 0
    [(condition, *_)] = rules
    assert condition.feature == "symbols_per_word" and 0.9 < condition.threshold < 4.0


def plain_covering(rows, cuts=24, max_rules=8, max_conditions=4, min_precision=0.75, min_cover=5):
    """Sequential covering that tries every value of every statistic."""
    names = list(FEATURES)

    def gain(b, g, before):
        return b * (math.log2(b / (b + g)) - before)

    def holds(row, c):
        return row[c[0]] > c[2] if c[1] else row[c[0]] <= c[2]

    rules, left = [], rows
    for _ in range(max_rules):
        grow, prune = [r for r in left if not r["prune"]], [r for r in left if r["prune"]]
        rule = []
        while len(rule) < max_conditions:
            bad = sum(r["bad"] for r in grow)
            good = len(grow) - bad
            if not good or bad < min_cover:
                break
            before, options = math.log2(bad / len(grow)), []
            for n in names:
                values = sorted({r[n] for r in grow})
                for a, b in zip(values, values[1:]):
                    cut = (a + b) / 2 if a < (a + b) / 2 < b else a
                    for above in (False, True):
                        inside = [r["bad"] for r in grow if holds(r, (n, above, cut))]
                        k = sum(inside)
                        if k >= min_cover:
                            options.append((round(gain(k, len(inside) - k, before), 9), k, n, above, cut))
            if not options or max(options)[0] <= 1e-9:
                break
            rule.append(max(options)[2:])
            grow = [r for r in grow if holds(r, rule[-1])]
        if not rule:
            break
        scored = []
        for i in range(1, len(rule) + 1):
            inside = [r["bad"] for r in prune if all(holds(r, c) for c in rule[:i])]
            b, n = sum(inside), len(inside)
            scored.append(((2 * b - n) / max(1, n), b, -i, n))
        share, b, minus, n = max(scored)
        if not b or b / n < min_precision:
            break
        rule = rule[:-minus]
        rules.append(tuple((n_, a, round(t, 9)) for n_, a, t in rule))
        left = [r for r in left if not all(holds(r, c) for c in rule)]
    return rules


@pytest.mark.parametrize("seed", range(3))
def test_equals_covering_over_all_values(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(500):
        bad = rng.random() < 0.3
        words = rng.randint(10, 40) if bad and rng.random() < 0.5 else rng.randint(20, 200)
        symbols = rng.randint(20, 60) if bad and rng.random() < 0.6 else rng.randint(0, 30)
        rows.append((int(not bad), words, symbols, rng.randint(0, 50)))
    df = statistics(spark, rows)
    prune = F.pmod(F.xxhash64(F.lit("prune"), F.col("row_key")), F.lit(3)) == 0
    values = df.select((F.col("quality") == 0).alias("bad"), prune.alias("prune"),
                       *(feature(n).alias(n) for n in FEATURES)).collect()
    for cuts in (3, 24):
        found = [tuple((c.feature, c.above, round(c.threshold, 9)) for c in r) for r in learn_rules(df, cuts=cuts)]
        assert found == plain_covering([r.asDict() for r in values])
