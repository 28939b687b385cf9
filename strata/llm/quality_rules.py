"""Quality rules as a learned decision list (operator 10).

Statistics of each text are Spark SQL expressions; sequential covering over labelled statistics
grows and prunes conjunctions of thresholds; the list is applied as one ordered CASE expression.
No Python runs on the executors.

Defined results: a null text has no words, so all its counts are 0 and the base rule rejects it;
an empty one alike. Repeated rows and rows without a label are scored like any other. Labels that
are null or neither 0 nor 1 are not learned from; a document labelled both ways counts as bad.
Without labels of both kinds the list is empty and the base rule alone decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import picked

# White space and the symbols that are counted.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"

# Bound of the learning sample: labelled rows of each class that may reach the driver.
SAMPLE_ROWS = 8_000

FEATURES = (
    "n_words",
    "mean_word_chars",
    "symbols_per_word",
    "repeat_share",
    "dup_line_share",
    "distinct_share",
    "shouts_per_word",
    "stops_per_word",
    "words_per_line",
)


def _with_repeated_words(split: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words of ``w`` in a three-word window that occurs twice or more.

    Hashes of the windows tell the texts without any repeat. In the others the windows themselves
    are sorted with their places and equal neighbours mark each other; marked places, in order,
    each cover three words less the overlap with the place before. Each step is a select of its
    own, so that its arrays are computed once.
    """
    n = F.size("w") - 2
    window_hashes = F.transform("w", lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)))
    hashed = split.withColumn("g", F.when(n > 0, F.slice(window_hashes, 1, n)))
    windows = F.arrays_zip(
        F.slice("w", 1, n).alias("a"),
        F.slice("w", 2, n).alias("b"),
        F.slice("w", 3, n).alias("c"),
        F.sequence(F.lit(0), n - 1).alias("at"),
    )
    order = hashed.withColumn("o", F.when(F.size(F.array_distinct("g")) < F.size("g"), F.sort_array(windows))).drop("g")
    pairs = F.size("o") - 1
    same = order.withColumn(
        "same",
        F.zip_with(
            F.slice("o", 1, pairs),
            F.slice("o", 2, pairs),
            lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]),
        ),
    )
    no = F.array(F.lit(False))
    marked = F.arrays_zip(F.col("o.at").alias("at"), F.concat(no, "same").alias("p"), F.concat("same", no).alias("q"))
    places = F.sort_array(F.transform(F.filter(marked, lambda x: x["p"] | x["q"]), lambda x: x["at"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda s, at: F.struct(at.alias("last"), (s["n"] + F.least(F.lit(3), at - s["last"])).alias("n")),
        lambda s: s["n"],
    )
    return same.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("o", "same")


def _occurrences(text: Column, characters: str) -> Column:
    """How often any of the characters stands in the text."""
    rest = text
    for character in characters:
        rest = F.replace(rest, F.lit(character), F.lit(""))
    return F.length(text) - F.length(rest)


def text_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The counts and shares of every whole text: ``key``, the base counts and FEATURES.

    Don't filter the result by its arrays' counts before it is written or collected: a filter
    pushed below the selects would compute the arrays again for each use.
    """
    split = picked(docs, {"k": key, "t": text}).select(
        "k",
        F.coalesce("t", F.lit("")).alias("t"),
        F.array_remove(F.split(F.coalesce("t", F.lit("")), SPACE), "").alias("w"),
        F.filter(F.split(F.coalesce("t", F.lit("")), "\n"), lambda line: line.rlike(NOT_SPACE)).alias("lines"),
    )
    counts = _with_repeated_words(split).select(
        "k",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _occurrences(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("lines").alias("n_lines"),
        F.size(F.array_distinct("w")).alias("n_distinct"),
        _occurrences(F.col("t"), "!?").alias("n_shouts"),
        _occurrences(F.col("t"), ".,").alias("n_stops"),
    )
    words = F.greatest("n_words", F.lit(1))
    return counts.select(
        F.col("k").alias(key),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("word_chars") / words).alias("mean_word_chars"),
        (F.col("n_symbols") / words).alias("symbols_per_word"),
        (F.col("n_repeat_words") / words).alias("repeat_share"),
        (F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))).alias("dup_line_share"),
        (F.col("n_distinct") / words).alias("distinct_share"),
        (F.col("n_shouts") / words).alias("shouts_per_word"),
        (F.col("n_stops") / words).alias("stops_per_word"),
        (F.col("n_words") / F.greatest("n_lines", F.lit(1))).alias("words_per_line"),
    )


def base_failed() -> Column:
    """Too few words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        column = x[:, FEATURES.index(self.feature)]
        return column > self.threshold if self.above else column <= self.threshold

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


@dataclass(frozen=True)
class Rule:
    """A conjunction of conditions; a text that meets all of them is rejected."""

    conditions: tuple[Condition, ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        met = np.ones(len(x), dtype=bool)
        for condition in self.conditions:
            met &= condition.holds(x)
        return met

    def column(self) -> Column:
        out = self.conditions[0].column()
        for condition in self.conditions[1:]:
            out = out & condition.column()
        return out


@dataclass(frozen=True)
class Learning:
    """Parameters of the covering.

    steps: thresholds tried for each feature (quantiles of the grow part); longest: conditions in
    a rule; most_rules: rules in a list; purity: share of bad rows a rule must reach on the prune
    part; support: bad rows it must cover there.
    """

    steps: int = 48
    longest: int = 4
    most_rules: int = 24
    purity: float = 0.95
    support: int = 5


def _grow(x: np.ndarray, bad: np.ndarray, how: Learning) -> Rule | None:
    """Adds the condition of the highest information gain until no good row is covered."""
    live, conditions = np.ones(len(x), dtype=bool), []
    while len(conditions) < how.longest:
        p0, n0 = int(bad[live].sum()), int((~bad[live]).sum())
        if not p0 or not n0:
            break
        best, before = None, np.log2(p0 / (p0 + n0))
        for j, feature in enumerate(FEATURES):
            values = x[live, j]
            cuts = np.unique(np.quantile(values, np.linspace(0, 1, how.steps + 2)[1:-1], method="lower"))
            order = np.argsort(values, kind="stable")
            bads = np.concatenate([[0], np.cumsum(bad[live][order])])
            below = np.searchsorted(values[order], cuts, side="right")
            for above, p, total in ((False, bads[below], below), (True, p0 - bads[below], len(values) - below)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / np.maximum(total, 1)) - before), -1.0)
                k = int(np.argmax(gain))
                if gain[k] > 1e-9 and (best is None or gain[k] > best[0] + 1e-12):
                    best = (float(gain[k]), Condition(feature, above, float(cuts[k])))
        if best is None:
            break
        conditions.append(best[1])
        live &= best[1].holds(x)
    return Rule(tuple(conditions)) if conditions else None


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """The prefix of the rule that separates the prune part best."""

    def worth(kept: Rule) -> float:
        met = kept.holds(x)
        p, n = int(bad[met].sum()), int((~bad[met]).sum())
        return (p - n) / (p + n) if p + n else -1.0

    cuts = [Rule(rule.conditions[:k]) for k in range(1, len(rule.conditions) + 1)]
    return max(cuts, key=lambda kept: (worth(kept), len(kept.conditions)))


def decision_list(x: np.ndarray, bad: np.ndarray, how: Learning = Learning()) -> list[Rule]:
    """Sequential covering: each rule is learned on what the earlier ones leave.

    Every third row, in the given order, prunes; the others grow. A rule that isn't pure enough on
    the prune part ends the list.
    """
    rules: list[Rule] = []
    part = np.arange(len(x)) % 3 == 0
    live = np.ones(len(x), dtype=bool)
    while len(rules) < how.most_rules:
        grow, prune = live & ~part, live & part
        if not bad[grow].any() or not bad[prune].any():
            break
        rule = _grow(x[grow], bad[grow], how)
        if rule is None:
            break
        rule = _prune(rule, x[prune], bad[prune])
        met = rule.holds(x[prune])
        if bad[prune][met].sum() < how.support or bad[prune][met].mean() < how.purity:
            break
        rules.append(rule)
        live &= ~rule.holds(x)
    return rules


def learn_rules(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    how: Learning = Learning(),
) -> list[Rule]:
    """Learns a list from ``label`` 0 (bad) and 1 (good).

    Of each class at most ``sample_rows`` labelled rows, those of the smallest key hashes, are
    learned from; they are the only rows that reach the driver. Texts the base rule rejects are not
    learned from, as the list never decides on them.
    """
    marked = (
        picked(labels, {"k": key, "y": label})
        .filter(F.col("k").isNotNull() & F.col("y").isin(0, 1))
        .groupBy("k")
        .agg(F.min("y").alias("y"))
    )
    chosen = None
    for value in (0, 1):
        part = marked.filter(F.col("y") == value).orderBy(F.xxhash64("k"), "k").limit(sample_rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 2 * sample_rows keys: a proven bound.
    sample = picked(docs, {"k": key, "t": text}).join(F.broadcast(chosen), "k")
    stats = text_statistics(sample, "k", "t").join(F.broadcast(chosen), "k")
    found = stats.select(F.xxhash64("k").alias("h"), "y", base_failed().alias("failed"), *FEATURES).collect()
    rows = [r for r in found if not r["failed"]]
    rows.sort(key=lambda r: (r["h"], *(r[f] for f in FEATURES)))
    if not rows:
        return []
    x = np.array([[float(r[f]) for f in FEATURES] for r in rows])
    bad = np.array([r["y"] == 0 for r in rows])
    return decision_list(x, bad, how) if bad.any() and not bad.all() else []


def verdict(rules: list[Rule]) -> Column:
    """The list as one ordered conditional: the number of the first rule met, else null."""
    out = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(rule.column(), F.lit(number)).otherwise(out)
    return out


def apply_rules(docs: DataFrame, rules: list[Rule], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``key``, counts, ``base_failed``, ``rule`` (that rejects it) and ``kept``."""
    scored = text_statistics(docs, key, text).withColumns({"base_failed": base_failed(), "rule": verdict(rules)})
    return scored.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep_good(docs: DataFrame, rules: list[Rule], key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is kept, all columns unchanged.

    The whole row rides along as one struct, so its columns can't clash with the statistics and
    no join is needed. The partition's number keeps Spark from pushing the filter below the
    statistics, which would then be computed again for each use.
    """
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    scored = apply_rules(packed.select("row", F.col(f"row.`{text}`").alias("t")), rules, "row", "t")
    scored = scored.select("row", "kept", F.spark_partition_id().alias("part"))
    return scored.filter("kept AND part >= 0").select("row.*")
