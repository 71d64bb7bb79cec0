"""Quality rules: a learned decision list over text statistics, as Spark expressions.

`statistics` computes the statistics of every whole text with built-in functions only;
`learn` fits an ordered list of threshold conjunctions to labelled statistics by
sequential covering (grow a rule on one part of the sample, prune it on the other, remove
what it covers, repeat); `verdict` turns the list into one conditional expression.

A null text counts as empty. Every input row gives one output row, so repeated rows and
repeated or null ids stay apart. Other columns of the input, whatever their names, are
not read. An empty table gives an empty result; without labelled rows the list is empty
and only the base rules decide.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionledger.llm import sample

BLANKS = r"[ \t-\r]"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Labelled rows collected to fit the list; more are not used.
FIT_ROWS = 20_000

#: Features of the list, as SQL over the columns of `statistics`.
FEATURES = {
    "n_words": "n_words",
    "chars_per_word": "word_chars / n_words",
    "symbol_rate": "n_symbols / word_chars",
    "upper_rate": "n_upper / word_chars",
    "mark_rate": "n_marks / word_chars",
    "dup_line_rate": "n_dup_lines / n_lines",
    "repeat_rate": "n_repeat_words / n_words",
    "distinct_rate": "n_distinct / n_words",
}


def statistics(docs: DataFrame, text: str = "text", keep: list[str] | None = None, barrier: str | None = None) -> DataFrame:
    """Columns `keep` and the statistics of `text`, row by row, without a shuffle.

    n_words; word_chars, code points in words; n_symbols, n_upper (A-Z) and n_marks
    (`!?.,;:`), characters; n_lines with a word and n_dup_lines, those equal to an
    earlier line; n_distinct words; n_repeat_words, words inside three-word windows that
    occur twice or more in the text, the first included. `barrier` names a further column that
    is not deterministic: a filter that uses it is not pushed below the statistics, where it
    would repeat their expressions many times over.
    """
    keep = keep if keep is not None else ["doc_id"]
    t = docs.select(
        *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
        F.coalesce(F.col(text), F.lit("")).alias("t"),
    )
    t = t.select(
        "*",
        F.filter(F.split("t", BLANKS + "+"), lambda x: x != "").alias("w"),
        F.filter(F.split("t", "\n"), lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", "")) != "").alias("ln"),
    )
    # Hashes tell windows of one text apart; a repeat is looked for only if one occurs twice.
    t = t.select(
        "*", F.size("w").alias("n"),
        F.expr(
            "CASE WHEN size(w) >= 4 THEN transform(sequence(0, size(w) - 3),"
            " i -> xxhash64(w[i], w[i + 1], w[i + 2])) ELSE array() END"
        ).alias("h"),
    )
    t = t.select(
        "*", F.expr(
            "CASE WHEN size(array_distinct(h)) < size(h) THEN"
            " sort_array(transform(h, (x, i) -> struct(x AS x, i AS i))) END"
        ).alias("s"),
    )
    t = t.select("*", F.expr(
        "sort_array(transform(filter(s, (e, j) -> get(s, j - 1).x <=> e.x OR get(s, j + 1).x <=> e.x), e -> e.i))"
    ).alias("p"))
    removed = lambda chars: F.length("t") - F.length(F.translate("t", chars, ""))
    long = lambda c: c.cast("long")
    return t.select(
        *([F.monotonically_increasing_id().alias(barrier)] if barrier else []),
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        long(F.col("n")).alias("n_words"),
        long(F.length(F.translate("t", " \t\n\x0b\x0c\r", ""))).alias("word_chars"),
        long(removed(SYMBOLS)).alias("n_symbols"),
        long(removed("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).alias("n_upper"),
        long(removed("!?.,;:")).alias("n_marks"),
        long(F.size("ln")).alias("n_lines"),
        long(F.size("ln") - F.size(F.array_distinct("ln"))).alias("n_dup_lines"),
        long(F.size(F.array_distinct("w"))).alias("n_distinct"),
        F.expr(
            "CASE WHEN p IS NULL THEN 0L ELSE aggregate(transform(p, (x, j) ->"
            " least(3, coalesce(get(p, j + 1) - x, 3))), 0L, (a, x) -> a + x) END"
        ).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    """Too short, or more than half of the words repeat."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.coalesce(F.expr(FEATURES[self.feature].replace(" / ", " / nullif(") + (", 0)" if "/" in FEATURES[self.feature] else "")), F.lit(0.0))
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold!r}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int) -> Rule:
    """Conditions are added one by one, each the one with the largest information gain.

    A threshold lies halfway between two neighbouring values of the sample.
    """
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < most and bad[inside].any() and not bad[inside].all():
        p0, n0 = bad[inside].sum(), inside.sum()
        best, gain = None, 1e-9
        for f, values in x.items():
            v = values[inside]
            cuts = np.unique(np.quantile(v, np.linspace(0, 1, 129), method="lower"))[:-1]
            if not len(cuts):
                continue
            order = np.argsort(v, kind="stable")
            pos = np.concatenate([[0], np.cumsum(bad[inside][order])])
            k = np.searchsorted(v[order], cuts, "right")
            for above, p, n in ((False, pos[k], k), (True, p0 - pos[k], n0 - k)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = np.where((p > 0) & (n > 0), p * (np.log2(p / n) - np.log2(p0 / n0)), -1)
                i = int(np.argmax(g))
                if g[i] > gain:
                    between = (float(cuts[i]) + float(v[order][k[i]])) / 2
                    best, gain = Condition(f, above, between), float(g[i])
        if best is None:
            break
        rule += (best,)
        inside &= best.holds(x)
    return rule


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Rule, float, int]:
    """The best leading part of the rule on unseen rows: its precision and cover, too."""
    best: tuple[Rule, float, int] = ((), 0.0, 0)
    top = -1.0
    for k in range(1, len(rule) + 1):
        inside = _covers(rule[:k], x, len(bad))
        n, p = int(inside.sum()), int(bad[inside].sum())
        worth = (2 * p - n) / n if n else -1.0
        if worth > top:
            best, top = (rule[:k], (p + 0.0) / max(n, 1), p), worth
    return best


def learn(
    x: dict[str, np.ndarray], bad: np.ndarray, max_rules: int = 12, max_conditions: int = 4,
    min_precision: float = 0.9, min_support: int = 3,
) -> list[Rule]:
    """Ordered rules that reject; what no rule covers is kept.

    Rows are dealt to growing and pruning by position (two to one) after their order was
    fixed by the caller, so equal input gives an equal list. A rule is accepted if it is
    right for `min_precision` of the pruning rows it covers, at least `min_support`.
    """
    grow_part = np.arange(len(bad)) % 3 != 2
    left = np.ones(len(bad), bool)
    rules: list[Rule] = []
    while len(rules) < max_rules:
        g, p = left & grow_part, left & ~grow_part
        if not bad[g].any() or not bad[p].any():
            break
        rule = _grow({k: v[g] for k, v in x.items()}, bad[g], max_conditions)
        rule, precision, support = _prune(rule, {k: v[p] for k, v in x.items()}, bad[p])
        if not rule or precision < min_precision or support < min_support:
            break
        rules.append(rule)
        left &= ~_covers(rule, x, len(bad))
    return rules


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> DataFrame:
    """Statistics and label of at most `rows` labelled documents, chosen by a hash of the id.

    Null ids and labels don't count; of several labels of an id the smallest does. The
    sample's ids are few enough, by `rows`, to be sent to every task.
    """
    known = (
        labels.select(F.col("doc_id").alias("id"), F.col(label).alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isNotNull())
        .groupBy("id").agg(F.min("y").alias("y"))
    )
    chosen = sample.smallest_hashes(known, "id", rows)
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("text"))
    found = texts.join(F.broadcast(chosen), "id")
    return statistics(found, keep=["id", "y"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> list[Rule]:
    """The decision list for documents whose label is 0 (rejected) or 1."""
    labelled = labelled_sample(docs, labels, label, rows)
    values = [F.expr(e) if "/" not in e else F.expr(e.replace(" / ", " / nullif(") + ", 0)") for e in FEATURES.values()]
    got = labelled.select(
        "id", "y", *[F.coalesce(v.cast("double"), F.lit(0.0)).alias(k) for k, v in zip(FEATURES, values)]
    ).orderBy(F.xxhash64("id"), "id", *FEATURES).limit(2 * rows).collect()
    if not got:
        return []
    x = {k: np.array([r[k] for r in got]) for k in FEATURES}
    return learn(x, np.array([r["y"] == 0 for r in got]))


def verdict(rules: list[Rule]) -> tuple[Column, Column]:
    """Whether the list keeps a row, and the number of the rule that rejects it (else null)."""
    fired = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules))):
        both = F.lit(True)
        for c in rule:
            both = both & c.column()
        fired = F.when(both, F.lit(i)).otherwise(fired)
    return fired.isNull(), fired


def apply(docs: DataFrame, rules: list[Rule], keep: list[str] | None = None) -> DataFrame:
    """Statistics, `base_failed`, `kept` and `rule` of every row."""
    good, fired = verdict(rules)
    return (
        statistics(docs, keep=keep, barrier="_at")
        .withColumn("base_failed", base_failed())
        .withColumn("rule", fired)
        .withColumn("kept", ~F.col("base_failed") & good & (F.col("_at") >= 0))
        .drop("_at")
    )
