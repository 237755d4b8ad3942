"""Quality rules: fixed limits, then a learned decision list.

The list is learned by sequential covering. From labelled statistics a rule grows one
threshold condition at a time, the one with the greatest information gain on two thirds
of the rows, and is then pruned to the prefix that is most precise on the other third.
Rows it covers are set aside and the next rule is learned from the rest. Rules find
rejected texts; what no rule covers is kept. The result is an ordered conditional
expression of Spark columns.

Everything that touches rows is a DataFrame expression. The driver sees counts per
feature and bin: some dozens of bins for each feature and each time a bin is cut again.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import stored, whole

SPACE = r"[\x20\x09-\x0D]+"
MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT_PERCENT = 20

#: Statistics a condition may use, as SQL over the columns of ``text_statistics``.
FEATURES = {
    "n_words": "cast(n_words AS double)",
    "chars_per_word": "try_divide(word_chars, n_words)",
    "symbols_per_word": "try_divide(n_symbols, n_words)",
    "punctuation_per_word": "try_divide(n_punctuation, n_words)",
    "upper_per_char": "try_divide(n_upper, word_chars)",
    "dup_line_share": "try_divide(n_dup_lines, n_lines)",
    "repeat_word_share": "try_divide(n_repeat_words, n_words)",
    "distinct_word_share": "try_divide(n_distinct_words, n_words)",
    "words_per_line": "try_divide(n_words, n_lines)",
}


def feature(name: str) -> Column:
    """The value of a statistic; 0 for a text without words."""
    return F.coalesce(F.expr(FEATURES[name]), F.lit(0.0))


def _repeat_words(words: Column) -> Column:
    """Words inside a window of five words that occurs at least twice in the text.

    Windows are compared by a 64-bit hash. Texts without a repeated window, most of
    them, end after one pass; the others sort their windows. The words covered by the
    union of windows starting at p1 < p2 < ... are 5 for the first start and
    min(5, distance to the start before) for each further one.
    """

    def covered(starts: Column) -> Column:
        return F.aggregate(
            starts,
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda acc, at: F.struct(
                at.alias("last"),
                (acc["n"] + F.least(F.lit(WINDOW), at - acc["last"])).alias("n"),
            ),
            lambda acc: acc["n"],
        )

    def repeated(ordered: Column) -> Column:
        again = F.filter(
            ordered,
            lambda e, k: F.coalesce(F.get(ordered, k - 1)["hash"] == e["hash"], F.lit(False))
            | F.coalesce(F.get(ordered, k + 1)["hash"] == e["hash"], F.lit(False)),
        )
        return covered(F.sort_array(F.transform(again, lambda e: e["at"])))

    def of(hashes: Column) -> Column:
        placed = F.sort_array(
            F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("at")))
        )
        return F.when(
            F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")
        ).otherwise(_let(placed, repeated))

    def hashed(single: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(single) - WINDOW),
            lambda i: F.xxhash64(*(F.get(single, i + k) for k in range(WINDOW))),
        )
        return F.when(F.size(single) < WINDOW, F.lit(0).cast("long")).otherwise(_let(windows, of))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), hashed)


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once, not at each of its uses."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of every whole text, one row per input row.

    Words are runs without ASCII white space; a line counts if it has a word. A null
    text has no words. Rows are not compared with each other, so repeated rows and
    repeated identifiers give a row each.
    """
    body = F.col("body")
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.trim(x, F.lit(" \t\x0b\x0c\r")) != "")
    words = F.array_remove(F.split(body, SPACE, -1), "")
    of_words = _let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words"),
            _repeat_words(w).alias("n_repeat_words"),
        ),
    )
    of_lines = _let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )

    def left(pattern: str) -> Column:
        """Characters left when those of the pattern are taken out."""
        return F.char_length(F.regexp_replace(body, pattern, "")).cast("long")

    return (
        docs.select(F.col(id_col).alias("id"), whole(text_col).alias("body"))
        .select(
            "id",
            of_words.alias("w"),
            of_lines.alias("l"),
            left(r"[^#*$%&|<>]+").alias("n_symbols"),
            left(r"[\p{L}\p{N}\s]+").alias("n_punctuation"),
            left(r"[^\p{Lu}]+").alias("n_upper"),
        )
        .select(F.col("id").alias(id_col), "w.*", "l.*", "n_symbols", "n_punctuation", "n_upper")
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = feature(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(columns: list[Column]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & c
    return out


def _gain(b: int, g: int, before: float) -> float:
    """What a condition that covers so many rows of each kind tells, weighed by the rejected."""
    return b * (math.log2(b / (b + g)) - before) if b else 0.0


class _Bins:
    """Covered rows counted by feature and bin, the bins refined where a better cut may lie."""

    def __init__(self, rows: DataFrame, cuts: int) -> None:
        self.rows = rows
        self.shares = [i / (cuts + 1) for i in range(1, cuts + 1)]
        #: By feature, in ascending order: (least value, greatest value, rejected, kept).
        self.bins = {name: [] for name in FEATURES}
        self._count({name: [(-math.inf, math.inf)] for name in FEATURES})

    def _count(self, parts: dict[str, list[tuple[float, float]]]) -> None:
        """Replace the bins inside the given ranges of values by finer ones."""
        ranges = [(name, low, high) for name, some in parts.items() for low, high in some]
        marks = self.rows.agg(
            *(
                F.percentile_approx(
                    F.when(F.col(name).between(low, high), F.col(name)), self.shares, 10000
                ).alias(f"m{i}")
                for i, (name, low, high) in enumerate(ranges)
            )
        ).first()
        entries = []
        for name, some in parts.items():
            own = [i for i, r in enumerate(ranges) if r[0] == name]
            if not own:
                continue
            points = sorted({p for i in own for p in (*(marks[i] or ()), ranges[i][1])})
            value = F.col(name)
            inside = F.lit(False)
            for low, high in some:
                inside = inside | value.between(low, high)
            # A quantile belongs to the bin below it.
            at = F.size(F.filter(F.array(*map(F.lit, points)), lambda p: p < value))
            entries.append(
                F.when(
                    inside,
                    F.struct(F.lit(name).alias("name"), at.alias("bin"), value.alias("value")),
                )
            )
        found = (
            self.rows.select("bad", F.explode(F.array_compact(F.array(*entries))).alias("f"))
            .groupBy("f.name", "f.bin")
            .agg(
                F.min("f.value").alias("low"),
                F.max("f.value").alias("high"),
                F.count_if("bad").alias("b"),
                F.count_if(~F.col("bad")).alias("g"),
            )
            .collect()
        )
        for name, some in parts.items():
            left = [
                x for x in self.bins[name] if not any(lo <= x[0] and x[1] <= hi for lo, hi in some)
            ]
            new = [(r.low, r.high, r.b, r.g) for r in found if r["name"] == name]
            self.bins[name] = sorted(left + new)

    def _options(self, name: str, before: float, min_cover: int):
        """(gain, condition, rejected, kept) for every cut between neighbouring bins."""
        bins = self.bins[name]
        bad, good = sum(x[2] for x in bins), sum(x[3] for x in bins)
        low_b = low_g = 0
        for (_, end, b, g), (begin, *_) in zip(bins, bins[1:]):
            low_b, low_g = low_b + b, low_g + g
            cut = (end + begin) / 2 if end < (end + begin) / 2 < begin else end
            for above, b, g in ((False, low_b, low_g), (True, bad - low_b, good - low_g)):
                if b >= min_cover:
                    yield _gain(b, g, before), Condition(name, above, cut), b, g

    def _better_inside(self, name: str, before: float, best: float) -> list[tuple[float, float]]:
        """Bins in which a cut may be as good as the best one so far.

        At most, a cut has all of a bin's rejected rows on its side and none of the others.
        """
        bins, found = self.bins[name], []
        bad, good = sum(x[2] for x in bins), sum(x[3] for x in bins)
        low_b = low_g = 0
        for low, high, b, g in bins:
            if b and g and low < high:
                below, above = (low_b + b, low_g), (bad - low_b, good - low_g - g)
                if max(_gain(*below, before), _gain(*above, before)) >= best - 1e-9:
                    found.append((low, high))
            low_b, low_g = low_b + b, low_g + g
        return found

    def best(self, before: float, min_cover: int):
        """The cut with the greatest gain over all values, or None."""
        while True:
            options = [o for n in FEATURES for o in self._options(n, before, min_cover)]
            top = max(options, key=_order, default=None)
            gain = max(top[0], 1e-9) if top else 1e-9
            parts = {n: self._better_inside(n, before, gain) for n in FEATURES}
            if not any(parts.values()):
                return top if top and top[0] > 1e-9 else None
            self._count({n: some for n, some in parts.items() if some})


def _order(option) -> tuple:
    """Of equally good cuts: the most rejected rows, then by feature, side and value."""
    gain, condition, b, _ = option
    return round(gain, 9), b, condition.feature, condition.above, condition.threshold


def learn_rules(
    labelled: DataFrame,
    label_col: str = "quality",
    cuts: int = 24,
    max_rules: int = 8,
    max_conditions: int = 4,
    min_precision: float = 0.75,
    min_cover: int = 5,
) -> list[Rule]:
    """Decision list for label 0 from statistics with a label.

    A condition is the best cut over all values that occur, midway between two of them.
    It is looked for in ``cuts`` quantile bins per statistic, and every bin in which a cut
    could be as good is cut again, until none could: what a bin may hold at best is known from
    its counts, so the search ends with the cut that trying all values would find.

    ``labelled`` has the columns of ``text_statistics`` and the label. Rows without a
    label are left out; no rows, or rows of one label only, give an empty list, which
    keeps every text. All labelled rows are used.
    """
    rows = stored(
        labelled.filter(F.col(label_col).isNotNull()).select(
            (F.col(label_col) == 0).alias("bad"),
            # The hash splits the rows for pruning.
            (F.pmod(F.xxhash64(F.lit("prune"), F.col("row_key")), F.lit(3)) == 0).alias("prune"),
            *(feature(n).alias(n) for n in FEATURES),
        ),
        "rule-rows",
    )

    def holds(condition: Condition) -> Column:
        value = F.col(condition.feature)
        return value > condition.threshold if condition.above else value <= condition.threshold

    def counts(df: DataFrame, conditions: list[Column]) -> list[tuple[int, int]]:
        """Rejected and other rows under each condition."""
        found = df.agg(
            *(F.count_if(c & F.col("bad")).alias(f"b{i}") for i, c in enumerate(conditions)),
            *(F.count_if(c & ~F.col("bad")).alias(f"g{i}") for i, c in enumerate(conditions)),
        ).first()
        return [(found[f"b{i}"], found[f"g{i}"]) for i in range(len(conditions))]

    found: list[Rule] = []
    rest = F.lit(True)
    for _ in range(max_rules):
        grow, prune = rows.filter(rest & ~F.col("prune")), rows.filter(rest & F.col("prune"))
        rule: list[Condition] = []
        [(bad, good)] = counts(grow, [F.lit(True)])
        while good and bad >= min_cover and len(rule) < max_conditions:
            covered = grow.filter(_all([holds(c) for c in rule]))
            top = _Bins(covered, cuts).best(math.log2(bad / (bad + good)), min_cover)
            if top is None:
                break
            _, condition, bad, good = top
            rule.append(condition)
        if not rule:
            break
        prefixes = [_all([holds(c) for c in rule[:i]]) for i in range(1, len(rule) + 1)]
        (b, g), length = max(
            ((n, i) for i, n in enumerate(counts(prune, prefixes), 1)),
            key=lambda x: ((x[0][0] - x[0][1]) / max(1, sum(x[0])), x[0][0]),
        )
        if not b or b / (b + g) < min_precision:
            break
        found.append(tuple(rule[:length]))
        rest = rest & ~prefixes[length - 1]
    return found


def verdict(rules: list[Rule]) -> Column:
    """The list as one ordered conditional expression: False where a rule covers the row."""
    out = None
    for rule in rules:
        covers = _all([c.column() for c in rule])
        out = F.when(covers, F.lit(False)) if out is None else out.when(covers, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> tuple[DataFrame, list[Rule]]:
    """Statistics and verdict of every text, and the rules.

    The statistics are computed once and stored; learning and scoring read those.
    Labels that repeat for an identifier count once, the lowest. A text that fails the
    base is rejected whatever the list says, and the list is learned from the others.
    """
    known = labels.groupBy(F.col(id_col).alias("label_id")).agg(F.min(label_col).alias("label"))
    stats = stored(text_statistics(docs, id_col, text_col), "text-statistics")
    labelled = (
        stats.withColumn("row_key", F.col(id_col))
        .filter(~base_failed())
        .join(known, F.col("row_key") == F.col("label_id"))
    )
    rules = learn_rules(labelled, "label")
    judged = stats.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & verdict(rules)
    )
    return judged, rules
