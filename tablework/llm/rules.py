"""Quality rules: text statistics and a decision list learned from labelled statistics.

Statistics are SQL functions over the whole text. The list is learned by sequential covering: a rule
grows by the threshold condition with the best information gain on two thirds of the labelled rows, is
pruned back on the last third, and covers rows before the next rule grows. A rule that does not hold on
the last third is dropped, and its first statistic is left out until another rule holds. Every step is one
aggregation that returns a histogram of a few hundred rows, whatever the number of labelled rows. The
list becomes one ordered conditional expression.

Results in odd cases: a null or empty text has no words, fails the base rule and is not kept; repeated
rows are judged alike; labels without a document, or null, teach nothing; without labels of both
classes the list is empty and the base rule decides; an empty table gives an empty result. Very long
texts are counted whole. Extra input columns are not carried along.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm.common import let, stored, words_of

MIN_WORDS = 50  # the base rule: fewer words, or more than half of them in repeated windows, fail
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

BINS = 32  # thresholds per statistic: quantiles of the labelled rows
MAX_RULES, MAX_CONDITIONS = 12, 4
MIN_PRECISION = 0.9  # of a rule on the rows that it did not grow on
MIN_COVERED = 3

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = {
    "symbol_share": lambda c: c["n_symbols"] / c["word_chars"],
    "upper_share": lambda c: c["n_upper"] / c["word_chars"],
    "bar_share": lambda c: c["n_bars"] / c["n_words"],
    "bang_share": lambda c: c["n_bangs"] / c["n_words"],
    "digit_share": lambda c: c["n_digits"] / c["word_chars"],
    "mean_word": lambda c: c["word_chars"] / c["n_words"],
    "repeat_share": lambda c: c["n_repeat_words"] / c["n_words"],
    "dup_line_share": lambda c: c["n_dup_lines"] / c["n_lines"],
    "words_per_line": lambda c: c["n_words"] / c["n_lines"],
    "n_words": lambda c: c["n_words"],
}


def number_of(text: Column, signs: str) -> Column:
    """Number of code points of the text that are among the signs."""
    return F.length(text) - F.length(F.translate(text, signs, ""))


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words which occurs twice or more, the first time included."""
    windows = F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)))

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = lambda s: lambda e, i: F.when((e["h"] == F.get(s, i - 1)["h"]) | (e["h"] == F.get(s, i + 1)["h"]), e["i"])
        starts = let(placed, lambda s: F.filter(F.transform(s, again(s)), lambda i: i.isNotNull()))
        spread = F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(F.size(F.array_distinct(spread)))

    return F.when(F.size(words) < 4, 0).otherwise(let(windows, covered))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and counts of whole texts (all long)."""

    def counted(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        doubled = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
        words = let(words_of(t), lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("again")))
        return let(
            F.struct(doubled.alias("lines"), words.alias("words")),
            lambda x: F.struct(
                x["words"]["n"].cast("long").alias("n_words"),
                (F.length(t) - number_of(t, WHITE)).cast("long").alias("word_chars"),
                number_of(t, SYMBOLS).cast("long").alias("n_symbols"),
                x["lines"]["dup"].cast("long").alias("n_dup_lines"),
                x["words"]["again"].cast("long").alias("n_repeat_words"),
                x["lines"]["n"].cast("long").alias("n_lines"),
                number_of(t, UPPER).cast("long").alias("n_upper"),
                number_of(t, "|").cast("long").alias("n_bars"),
                number_of(t, "!").cast("long").alias("n_bangs"),
                number_of(t, "0123456789").cast("long").alias("n_digits"),
            ),
        )

    made = let(F.coalesce(F.col(text_col), F.lit("")), counted)
    return docs.select(F.col(id_col).alias("doc_id"), F.inline(F.array(made)))


def with_features(counts: DataFrame) -> DataFrame:
    """Add the ratios that rules test; a ratio to nothing is zero."""
    safe = {c: F.when(F.col(c) == 0, F.lit(None)).otherwise(F.col(c)) for c in counts.columns if c != "doc_id"}
    plain = {c: F.col(c) for c in safe}
    choose = lambda f: F.coalesce(f({**plain, **{d: safe[d] for d in ("word_chars", "n_words", "n_lines")}}).cast("double"), F.lit(0.0))
    return counts.select("*", *(choose(f).alias(f"f_{name}") for name, f in FEATURES.items()))


def base_failed(n_words: str = "n_words", n_repeat: str = "n_repeat_words") -> Column:
    return (F.col(n_words) < MIN_WORDS) | (100 * F.col(n_repeat) > 50 * F.col(n_words))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(f"f_{self.feature}")
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def matches(rule: Rule) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.column()
    return out


def covered(rules: list[Rule]) -> Column:
    out = F.lit(False)
    for rule in rules:
        out = out | matches(rule)
    return out


def histogram(rows: DataFrame, thresholds: dict[str, list[float]]) -> dict[str, list[tuple[int, int]]]:
    """(bad, good) rows between the thresholds of each statistic, in one aggregation."""
    pairs = []
    for name, cuts in thresholds.items():
        above = F.lit(0)
        for t in cuts:
            above = above + (F.col(f"f_{name}") > F.lit(t)).cast("int")
        pairs.append(F.struct(F.lit(name).alias("feature"), above.alias("bin")))
    found = rows.select("bad", F.explode(F.array(*pairs)).alias("x")).groupBy("x.feature", "x.bin").agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("n"))
    out = {name: [(0, 0)] * (len(cuts) + 1) for name, cuts in thresholds.items()}
    for feature, b, bad, n in found.collect():  # at most features times (BINS + 1) rows
        out[feature][b] = (bad, n - bad)
    return out


def best_condition(hist: dict[str, list[tuple[int, int]]], thresholds: dict[str, list[float]]) -> tuple[Condition | None, int]:
    """The condition with the largest gain, and the good rows it still lets through. Ties go to the first."""
    bad, good = (sum(x[k] for x in next(iter(hist.values()))) for k in (0, 1))
    best, best_gain, left = None, 1e-9, good
    if not bad:
        return None, good
    before = math.log2(bad / (bad + good))
    for name, bins in hist.items():
        low = [0, 0]
        for i, t in enumerate(thresholds[name]):
            low = [low[0] + bins[i][0], low[1] + bins[i][1]]
            for above, p, n in ((True, bad - low[0], good - low[1]), (False, low[0], low[1])):
                gain = p * (math.log2(p / (p + n)) - before) if p else 0.0
                if gain > best_gain:
                    best, best_gain, left = Condition(name, above, t), gain, n
    return best, left


def learn(labelled: DataFrame) -> list[Rule]:
    """Rules that reject, in the order found. ``labelled`` is stored: features, bad (1 or 0), grow (boolean)."""
    names = list(FEATURES)
    steps = [i / BINS for i in range(1, BINS)]
    cuts = labelled.agg(*(F.percentile_approx(f"f_{n}", steps, 10_000).alias(n) for n in names)).first()
    thresholds = {n: sorted(set(cuts[n] or [])) for n in names}
    rules: list[Rule] = []
    failed: set[str] = set()  # statistics whose rules did not hold on the other rows since the last rule that did
    while len(rules) < MAX_RULES:
        usable = {n: t for n, t in thresholds.items() if n not in failed and t}
        open_rows = labelled.where(~covered(rules))
        rule: Rule = ()
        while usable and len(rule) < MAX_CONDITIONS:
            condition, good_left = best_condition(histogram(open_rows.where(F.col("grow") & matches(rule)), usable), usable)
            if condition is None:
                break
            rule += (condition,)
            if not good_left:
                break
        if not rule:
            break
        sums = []
        for k in range(1, len(rule) + 1):
            holds = matches(rule[:k]).cast("int")
            sums += [F.sum(holds * F.col("bad")), F.sum(holds)]
        totals = [x or 0 for x in open_rows.where(~F.col("grow")).agg(*sums).first()]
        scored = [((totals[2 * k] + 1) / (totals[2 * k + 1] + 2), totals[2 * k], totals[2 * k + 1], k + 1) for k in range(len(rule))]
        _, bad, n, length = max(scored, key=lambda s: (s[0], -s[3]))
        if bad >= MIN_COVERED and bad >= MIN_PRECISION * n:
            rules.append(rule[:length])
            failed = set()
        else:
            failed.add(rule[0].feature)
    return rules


def labelled_rows(featured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """Statistics with their labels; two thirds of the ids, by hash, are there to grow rules."""
    known = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("doc_id"), (F.col(label_col) == 0).cast("int").alias("bad"))
    kept = [f"f_{n}" for n in FEATURES]
    return featured.join(known, "doc_id").select("bad", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) != 0).alias("grow"), *kept)


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, as one ordered conditional expression; null if none does."""
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(matches(rule), F.lit(i)).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, base_failed, rule (the first that rejects) and kept per document."""
    counts = stored(statistics(docs, id_col, text_col), "text-statistics")
    featured = with_features(counts)
    rules = learn(stored(labelled_rows(featured, labels), "labelled-statistics"))
    judged = featured.select("doc_id", *COUNTS, base_failed().alias("base_failed"), verdict(rules).alias("rule"))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
