"""Quality rules learned as an ordered decision list.

Statistics of every text are computed in one pass. From labelled documents, sequential
covering learns rules for low quality: each rule is a conjunction of thresholds, grown
condition by condition by information gain on two thirds of the examples and pruned
from its end on the last third. The rules are applied as one ordered Spark conditional
expression, so scoring all documents is a projection without a shuffle.

Defined cases: a null text has no words; documents with few or mostly repeated words
fail the base rule; a null doc_id is kept as it is; repeated rows get the same result
each; labels that are null, conflicting (the lower one counts) or without a document
are no obstacle; without labels no rule is learned and only the base rule rejects;
other columns of the input, whatever their names, pass through ``reject`` untouched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.llm.common import text_of, unused

#: At most so many labelled documents train the rules, by hash order of their ids.
TRAIN_ROWS = 20_000
#: A learned rule must be right on so large a share of the pruning examples.
MIN_PRECISION = 0.95
#: It must also cover this share of the bad pruning examples, and one of them at least.
MIN_SHARE = 0.05

MIN_WORDS = 10
REPEAT_PERCENT = 20

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_distinct",
    "n_upper",
    "n_digits",
    "n_marks",
    "n_top_word",
    "n_bytes",
)
_SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])

_SPACE = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_MARKS = b"!?"


def repeated_words(words: list[bytes]) -> int:
    """Words inside five-word windows that occur at least twice."""
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(windows)) == len(windows):
        return 0
    first: dict = {}
    covered = bytearray(len(words))
    for at, window in enumerate(windows):
        earlier = first.setdefault(window, at)
        if earlier != at:
            covered[earlier : earlier + 5] = b"\1\1\1\1\1"
            covered[at : at + 5] = b"\1\1\1\1\1"
    return covered.count(1)


def statistics(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of COUNTS."""
    text = text or ""
    data = text.encode()
    words = data.split()
    seen: dict[bytes, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1

    def count(chars: bytes) -> int:
        return len(data) - len(data.translate(None, chars))

    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - count(_SPACE),
        count(_SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(seen),
        count(_UPPER),
        count(_DIGITS),
        count(_MARKS),
        max(seen.values(), default=0),
        len(data),
    )


@F.pandas_udf(_SCHEMA)
def _statistics(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame([statistics(t) for t in batch], columns=COUNTS, dtype="int64")


def measured(docs: DataFrame, name: str) -> DataFrame:
    """Add the counts of the text as one struct column."""
    return docs.withColumn(name, _statistics(text_of()))


def ratios(stats: str) -> dict[str, Column]:
    """The features that rules may test."""
    c = {n: F.col(f"{stats}.{n}").cast("double") for n in COUNTS}

    def over(a: str, b: str) -> Column:
        return c[a] / F.greatest(c[b], F.lit(1.0))

    return {
        "n_words": c["n_words"],
        "mean_word": over("word_chars", "n_words"),
        "symbols_per_word": over("n_symbols", "n_words"),
        "dup_line_share": over("n_dup_lines", "n_lines"),
        "repeat_share": over("n_repeat_words", "n_words"),
        "words_per_line": over("n_words", "n_lines"),
        "distinct_share": over("n_distinct", "n_words"),
        "upper_share": over("n_upper", "n_bytes"),
        "digit_share": over("n_digits", "n_bytes"),
        "marks_per_word": over("n_marks", "n_words"),
        "top_word_share": over("n_top_word", "n_words"),
    }


def base_failed(stats: str) -> Column:
    words, repeated = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeated > REPEAT_PERCENT * words)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        x = values[self.feature]
        return x > self.threshold if self.above else x <= self.threshold

    def column(self, features: dict[str, Column]) -> Column:
        x = features[self.feature]
        return x > self.threshold if self.above else x <= self.threshold


Rule = tuple[Condition, ...]


def _covers(rule: Rule, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    mask = np.ones(n, dtype=bool)
    for condition in rule:
        mask &= condition.holds(values)
    return mask


def _thresholds(values: dict[str, np.ndarray]) -> list[Condition]:
    out = []
    for feature, x in values.items():
        cuts = np.unique(np.quantile(x, np.linspace(0.005, 0.995, 100))) if len(x) else []
        for cut in cuts:
            out += [Condition(feature, True, float(cut)), Condition(feature, False, float(cut))]
    return out


def _grow(values, bad: np.ndarray, conditions: list[Condition]) -> Rule:
    rule: Rule = ()
    mask = np.ones(len(bad), dtype=bool)
    while True:
        p, n = int((mask & bad).sum()), int((mask & ~bad).sum())
        if n == 0 or p == 0:
            return rule
        before, best, chosen = math.log2(p / (p + n)), 1e-9, None
        for condition in conditions:
            inside = mask & condition.holds(values)
            q, m = int((inside & bad).sum()), int((inside & ~bad).sum())
            if q:
                gain = q * (math.log2(q / (q + m)) - before)
                if gain > best:
                    best, chosen = gain, condition
        if chosen is None:
            return rule
        rule += (chosen,)
        mask &= chosen.holds(values)


def _worth(rule: Rule, values, bad: np.ndarray) -> tuple[float, int]:
    mask = _covers(rule, values, len(bad))
    p, n = int((mask & bad).sum()), int((mask & ~bad).sum())
    return (p / (p + n) if p + n else 0.0), p


def learn(frame: pd.DataFrame, bad: np.ndarray) -> list[Rule]:
    """Sequential covering: grow a rule, prune it, keep it if the pruning examples bear
    it out, drop what it covers, go on.

    A rule that does not hold is not the end: the bad examples that it covers are set
    aside, as no rule of its kind is to be had, and the others are gone on with. What a
    rule must cover is a share of the bad examples, so a small set learns as well. The
    examples are dealt in turn, bad and good apart, so that both parts have both.
    """
    names = list(frame.columns)
    x = {c: frame[c].to_numpy(dtype=float) for c in names}
    bad = np.asarray(bad, dtype=bool)
    part = np.zeros(len(bad), dtype=bool)
    for kind in (bad, ~bad):
        part[np.flatnonzero(kind)[2::3]] = True
    least = max(1, math.ceil(MIN_SHARE * int((bad & part).sum())))
    left, rules = np.ones(len(bad), dtype=bool), []
    while True:
        grow = {c: x[c][left & ~part] for c in names}
        prune = {c: x[c][left & part] for c in names}
        grow_bad, prune_bad = bad[left & ~part], bad[left & part]
        if not grow_bad.any() or not prune_bad.any():
            return rules
        rule = _grow(grow, grow_bad, _thresholds(grow))
        while len(rule) > 1:
            (now, p), (shorter, q) = _worth(rule, prune, prune_bad), _worth(rule[:-1], prune, prune_bad)
            if shorter < max(now, MIN_PRECISION) or q < p:
                break
            rule = rule[:-1]
        precision, support = _worth(rule, prune, prune_bad) if rule else (0.0, 0)
        covered = _covers(rule, x, len(bad)) & left
        if precision >= MIN_PRECISION and support >= least:
            rules.append(rule)
            left &= ~covered
        elif rule and (covered & bad).any():
            left &= ~(covered & bad)
        else:
            return rules


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> pd.DataFrame:
    """Features and label of at most ``limit`` labelled documents. Both sides of the join
    are bounded by the limit: the ids are broadcast, the matching rows are gathered."""
    wanted = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    chosen = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id")
    rows = measured(chosen, "_stats")
    features = [c.alias(n) for n, c in ratios("_stats").items()]
    rows = rows.where(~base_failed("_stats")).select("doc_id", *features, "quality")
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", *features).limit(2 * limit).toPandas()


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> list[Rule]:
    rows = training_rows(docs, labels, limit)
    return learn(rows.drop(columns=["doc_id", "quality"]), rows["quality"].to_numpy() < 1)


def verdict(rules: list[Rule], stats: str) -> Column:
    """False where the first rule that fires rejects, true where none does."""
    features = ratios(stats)
    out = F.when(base_failed(stats), F.lit(False))
    for rule in rules:
        test = F.lit(True)
        for condition in rule:
            test = test & condition.column(features)
        out = out.when(test, F.lit(False))
    return out.otherwise(F.lit(True))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the counts and both verdicts of every row."""
    rows = measured(docs.select("doc_id", "text"), "_stats")
    return rows.select(
        "doc_id",
        *(F.col(f"_stats.{c}").alias(c) for c in COUNTS),
        base_failed("_stats").alias("base_failed"),
        verdict(rules, "_stats").alias("kept"),
    )


def reject(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows that the rules keep, with all their columns."""
    name = unused(docs, "_stats")
    return measured(docs, name).where(verdict(rules, name)).drop(name)
