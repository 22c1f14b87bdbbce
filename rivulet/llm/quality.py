"""Quality rules: text statistics and learned decision lists, as DataFrame
expressions only.

`text_statistics` computes counts of every whole text inside its row.
`learn_rules` fits an ordered list of threshold conjunctions by sequential
covering (grow by information gain on two thirds of the labelled rows, prune
on the rest) and `RuleList.verdict` is the list as one conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]"
FEATURES = {
    "symbol_ratio": lambda c: c("n_symbols") / F.greatest(c("word_chars"), F.lit(1)),
    "dup_line_ratio": lambda c: c("n_dup_lines") / F.greatest(c("n_worded_lines"), F.lit(1)),
    "repeat_ratio": lambda c: c("n_repeat_words") / F.greatest(c("n_words"), F.lit(1)),
    "distinct_ratio": lambda c: c("n_distinct_words") / F.greatest(c("n_words"), F.lit(1)),
    "word_length": lambda c: c("word_chars") / F.greatest(c("n_words"), F.lit(1)),
    "upper_ratio": lambda c: c("n_upper") / F.greatest(c("word_chars"), F.lit(1)),
    "mark_ratio": lambda c: c("n_marks") / F.greatest(c("n_words"), F.lit(1)),
}
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
              "n_worded_lines", "n_distinct_words", "n_upper", "n_marks")


def _let(value: Column, body) -> Column:
    """body(value) with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _chars_of(text: Column, others: str) -> Column:
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def _shifted(positions: Column, by: int) -> Column:
    return F.transform(positions, lambda x: x + by)


def _repeated_window_words(words: Column, n: Column, window: int) -> Column:
    """Number of words that lie in a `window`-word window found twice or more."""
    m = n - (window - 1)
    cut = [F.slice(words, j + 1, m) for j in range(window)]
    hashes = F.transform(F.arrays_zip(*cut), lambda w: F.xxhash64(w))

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.arrays_zip(h.alias("h"), F.sequence(F.lit(1), m).alias("i")))

        def places(s: Column) -> Column:
            hs, gap = s.getField("h"), F.array(F.lit(None).cast("long"))
            k = F.size(hs)
            near = F.arrays_zip(hs.alias("h"), F.concat(F.slice(hs, 2, k - 1), gap).alias("after"),
                                F.concat(gap, F.slice(hs, 1, k - 1)).alias("before"), s.getField("i").alias("i"))
            same = F.filter(near, lambda z: (z["h"] == z["after"]) | (z["h"] == z["before"]))
            return _let(same.getField("i"), lambda p: F.size(F.array_distinct(F.concat(
                p, *[_shifted(p, j) for j in range(1, window)]))))

        return _let(pairs, places)

    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))

    return F.when(n < window, F.lit(0)).otherwise(_let(hashes, counted)).cast("long")


def text_statistics(docs: DataFrame, text_col: str = "text", window: int = 3) -> DataFrame:
    """`docs` without the text, with the STATISTICS of every whole text (all
    long). Words are runs without [\\x20\\x09-\\x0D]; a null text has none.

    n_dup_lines counts \\n-split lines with a word that equal an earlier one,
    n_repeat_words the words inside `window`-word windows found twice or more.
    Columns with the names of statistics are replaced."""
    names = [c for c in docs.columns if c != text_col and c not in STATISTICS]
    t = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        *names, F.array_remove(F.split(t, WHITE + "+"), "").alias("__words"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__lines"),
        _chars_of(t, r"[^#*$%&|<>]+").alias("n_symbols"), _chars_of(t, "[^A-Z]+").alias("n_upper"),
        _chars_of(t, "[^!?.,;:]+").alias("n_marks"))
    w, lines = F.col("__words"), F.col("__lines")
    return base.select(
        *names, F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"), "n_symbols",
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeated_window_words(w, F.size(w), window).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_worded_lines"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words"), "n_upper", "n_marks")


def base_failed() -> Column:
    """Fewer than 50 words, or over half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass
class RuleList:
    """Ordered rules; each is a list of (feature, ">" or "<=", threshold).
    A text is rejected by the first rule whose conditions all hold."""

    rules: list[list[tuple[str, str, float]]] = field(default_factory=list)

    def verdict(self) -> Column:
        """The number of the first rule that rejects (from 1), or 0."""
        out = F.lit(0)
        for i in range(len(self.rules), 0, -1):
            hold = F.lit(True)
            for name, op, t in self.rules[i - 1]:
                f = FEATURES[name](F.col)
                hold = hold & ((f > t) if op == ">" else (f <= t))
            out = F.when(hold, F.lit(i)).otherwise(out)
        return out

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(f"{n} {o} {t:.4g}" for n, o, t in r) for r in self.rules)


def labelled(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sample: int = 20_000) -> DataFrame:
    """(id, __label): at most about `sample` labelled ids, drawn by a hash of the
    id. Null ids and labels take no part; of several labels of an id the
    smallest counts."""
    lab = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(id_col).agg(
        F.min(label_col).alias("__label"))
    bound = int(min(1.0, sample / max(lab.count(), 1)) * (1 << 30))
    return lab.where(F.pmod(F.xxhash64(id_col, F.lit(7)), F.lit(1 << 30)) < bound)


def learn_rules(stats: DataFrame, id_col: str = "doc_id", bins: int = 24, precision: float = 0.95,
                max_rules: int = 8) -> RuleList:
    """Fit a decision list that rejects rows labelled 0 in `stats`, the text
    statistics of the rows of `labelled` with their __label.

    Feature values are cut at `bins` quantiles, so the data reach the driver as
    counts per cell of bins and label, at most as many as the labelled sample
    has rows. A rule is kept while its precision on the pruning third (on all
    rows where that has none) is at least `precision`; without rows of both
    labels the list is empty.
    """
    data = stats.select(
        *[FEATURES[f](F.col).alias(f) for f in FEATURES], (F.col("__label") == 0).alias("bad"),
        (F.pmod(F.xxhash64(id_col, F.lit(8)), F.lit(3)) == 0).alias("held"))
    cuts = data.agg(*[F.percentile_approx(f, [i / bins for i in range(1, bins)], 2000).alias(f) for f in FEATURES],
                    F.sum(F.col("bad").cast("int")).alias("n_bad"), F.count(F.lit(1)).alias("n")).first()
    if not cuts.n_bad or cuts.n_bad == cuts.n:
        return RuleList()
    cuts = {f: sorted(set(cuts[f])) for f in FEATURES}
    cell = [sum([(F.col(f) > t).cast("int") for t in cuts[f]], F.lit(0)).alias(f) for f in FEATURES]
    cells = data.select(*cell, "bad", "held").groupBy(*FEATURES, "bad", "held").count().collect()  # <= sample rows
    rules = _cover(np.array([[r[f] for f in FEATURES] for r in cells]), np.array([r["bad"] for r in cells]),
                   np.array([r["held"] for r in cells]), np.array([r["count"] for r in cells], float),
                   cuts, precision, max_rules)
    return _centred(rules, data)


def _centred(rules: RuleList, data: DataFrame) -> RuleList:
    """Each threshold moved to the middle between the two values next to it."""
    flat = [(f, t) for r in rules.rules for f, _, t in r]
    if not flat:
        return rules
    ends = data.agg(*[F.max(F.when(F.col(f) <= t, F.col(f))) for f, t in flat],
                    *[F.min(F.when(F.col(f) > t, F.col(f))) for f, t in flat]).first()
    middle = {x: (ends[i] + ends[i + len(flat)]) / 2 for i, x in enumerate(flat)
              if ends[i] is not None and ends[i + len(flat)] is not None}
    return RuleList([[(f, op, middle.get((f, t), t)) for f, op, t in r] for r in rules.rules])


def _cover(bins, bad, held, weight, cuts, precision, max_rules) -> RuleList:
    names, out = list(FEATURES), RuleList()
    left = np.ones(len(bad), bool)  # not yet covered by a rule
    grow = left & ~held

    def holds(rule, rows):
        ok = rows.copy()
        for f, op, t in rule:
            ok &= (bins[:, f] > t) if op == ">" else (bins[:, f] <= t)
        return ok

    def counts(rows):
        return weight[rows & bad].sum(), weight[rows & ~bad].sum()

    for _ in range(4 * max_rules):
        rule = _grown(bins, bad, weight, grow, [len(cuts[n]) for n in names], holds, counts)
        if not rule or len(out.rules) == max_rules:
            break
        # prune: the prefix that covers most unwanted rows on the held third at the asked precision
        best = None
        for j in range(1, len(rule) + 1):
            p, n = counts(holds(rule[:j], left & held))
            if not p + n:
                p, n = counts(holds(rule[:j], left))
            if p and p >= precision * (p + n) and (best is None or p > best[0]):
                best = (p, rule[:j])
        if best is None:
            grow &= ~(holds(rule, grow) & bad)  # set aside what no precise rule was found for
            continue
        out.rules.append([(names[f], op, float(cuts[names[f]][t])) for f, op, t in best[1]])
        left &= ~holds(best[1], left)
        grow &= left
    return out


def _grown(bins, bad, weight, rows, n_cuts, holds, counts) -> list:
    """A conjunction grown condition by condition, each with the greatest
    information gain on `rows`, until only unwanted rows are left."""
    rule, grown = [], rows
    while True:
        p, n = counts(grown)
        if not p or not n:
            return rule
        best = (1e-6, None)
        for f, k in enumerate(n_cuts):
            hp, hn = (np.bincount(bins[grown & m, f], weight[grown & m], k + 1) for m in (bad, ~bad))
            for t in range(k):
                for op, a, b in ((">", hp[t + 1:].sum(), hn[t + 1:].sum()), ("<=", hp[:t + 1].sum(), hn[:t + 1].sum())):
                    if a:
                        gain = a * (math.log2(a / (a + b)) - math.log2(p / (p + n)))
                        if gain > best[0]:
                            best = (gain, (f, op, t))
        if best[1] is None or best[1] in rule:
            return rule
        rule.append(best[1])
        grown = holds(rule, rows)
