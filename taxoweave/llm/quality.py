"""Weak supervision of document quality (native: DataFrame functions only).

Each rule votes good (1), bad (0) or abstains (null).  How often a rule gives each
vote on good and on bad documents is estimated by expectation-maximisation, without
labels, over the counts of vote patterns: 3 ** (number of rules) at most, whatever
the corpus.  A document is kept if its posterior probability of being good is at
least 0.5, instead of having to pass every rule.

Defined cases: a null text has no words; an empty text too; very long texts are measured
whole; repeated rows are judged one by one; a posterior of exactly the threshold is kept;
other columns are kept as they are, names that clash are avoided.  An empty table gives the
starting model and no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SPACES, fresh, quoted, step, words, written

SYMBOLS = "#*$%&|<>"
STOP_WORDS = ["the", "of", "and", "to", "der", "die", "und", "de", "la", "le", "et", "que", "el", "y"]


def measures(docs: DataFrame, text: str = "text", into: str = "measures") -> DataFrame:
    """Adds the struct column `into` with the counts that the rules use."""
    (into,) = fresh(docs, into)
    w, win, dup, pos = fresh(docs, into + "_words", into + "_windows", into + "_same", into + "_starts")
    body = F.coalesce(quoted(text), F.lit(""))
    W, V, S, P = (quoted(x) for x in (w, win, dup, pos))
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    n = F.size(W)
    df = step(docs, docs.columns, w, words(quoted(text)))
    # 3-word windows as hashes; those that occur again need sorting, which most texts do not
    hashes = F.when(n < 3, F.array().cast("array<bigint>")).otherwise(
        F.slice(
            F.transform(W, lambda x, i: F.xxhash64(x, F.get(W, i + 1), F.get(W, i + 2))), F.lit(1),
            F.greatest(n - 2, F.lit(0))
        )
    )
    df = step(df, [*docs.columns, w], win, hashes)
    empty = F.array().cast("array<struct<h:bigint,i:int>>")
    df = step(
        df, [*docs.columns, w], dup,
        F.when(F.size(F.array_distinct(V)) == F.size(V), empty).otherwise(
            F.sort_array(F.transform(V, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        )
    )
    again = F.transform(S, lambda x, j: F.when((j > 0) & (x.h == F.get(S, j - 1).h) | (x.h == F.get(S, j + 1).h), x.i))
    df = step(df, [*docs.columns, w], pos, F.sort_array(F.filter(again, lambda x: x.isNotNull())))
    covered = F.aggregate(
        F.transform(P, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(P, j + 1) - x, F.lit(3)))), F.lit(0),
        lambda a, x: a + x
    )
    chars = F.length(body)
    out = F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.translate(body, SPACES, "")).cast("long").alias("word_chars"),
        (chars - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        (chars - F.length(F.translate(body, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_upper"),
        (chars - F.length(F.translate(body, "!", ""))).cast("long").alias("n_exclamations"),
        F.size(F.array_intersect(W, F.array(*map(F.lit, STOP_WORDS)))).cast("long").alias("n_stop_words"),
    )
    return step(df, docs.columns, into, out)


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, 0).when(good, 1)


def rules(m: Column) -> dict[str, Column]:
    """Vote of each rule: 1 good, 0 bad, null abstains (also where a text has no words)."""
    n = m.n_words
    return {
        "length": _vote(n < 50, n >= 100),
        "mean_word": _vote(
            (m.word_chars < 3 * n) | (m.word_chars > 14 * n), (m.word_chars >= 4 * n) & (m.word_chars <= 10 * n)
        ),
        "symbols": _vote(m.n_symbols * 10 > n, m.n_symbols * 50 <= n),
        "upper": _vote(m.n_upper * 3 > m.word_chars, m.n_upper * 8 <= m.word_chars),
        "lines": _vote(m.n_dup_lines * 10 > m.n_lines * 3, m.n_dup_lines == 0),
        "repeats": _vote(m.n_repeat_words * 10 > n * 3, m.n_repeat_words * 10 <= n),
        "exclamations": _vote(m.n_exclamations * 10 > n, m.n_exclamations * 100 <= n),
        "stop_words": _vote((m.n_stop_words == 0) & (n >= 50), m.n_stop_words >= 2),
    }


@dataclass(frozen=True)
class QualityModel:
    """prior: share of good documents; rates[rule][y]: chance that the rule votes
    (bad, good, abstains) on a document of class y (0 bad, 1 good)."""

    prior: float
    rates: dict[str, tuple[tuple[float, float, float], tuple[float, float, float]]]

    def posterior(self, votes: dict[str, Column]) -> Column:
        """Probability that a document is good, given its votes."""
        log_odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, vote in votes.items():
            bad, good = self.rates[name]
            lr = [math.log(g / b) for g, b in zip(good, bad, strict=True)]
            log_odds = log_odds + F.when(vote == 0, lr[0]).when(vote == 1, lr[1]).otherwise(lr[2])
        return 1 / (1 + F.exp(-log_odds))


#: Rates before the first round: rules are better than chance, and bad votes are rare on good texts.
START = ((0.3, 0.5, 0.2), (0.02, 0.8, 0.18))


def fit(measured: DataFrame, column: str = "measures", rounds: int = 50, weight: float = 20.0) -> QualityModel:
    """Expectation-maximisation over the vote patterns of all rows.

    Spark counts the patterns, of which there are 3 ** (number of rules) at most; only
    these counts reach the driver.  `weight`: documents that the starting rates count
    as, which keeps the classes from changing places and every rate above 0."""
    votes = rules(quoted(column))
    names = list(votes)
    found = measured.groupBy(
        *(F.coalesce(v, F.lit(2)).alias(k) for k, v in votes.items())
    ).agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = sorted((tuple(r[k] for k in names), r.n) for r in found)
    prior, rates = 0.8, {k: START for k in names}
    for _ in range(rounds):
        sums = {k: [[weight * x for x in y] for y in START] for k in names}
        total = [0.2 * weight, 0.8 * weight]
        for votes_of, n in patterns:
            odds = math.log(prior / (1 - prior)) + sum(
                math.log(rates[k][1][v] / rates[k][0][v]) for k, v in zip(names, votes_of, strict=True)
            )
            good = n / (1 + math.exp(-max(-700.0, min(700.0, odds))))
            for y, part in ((0, n - good), (1, good)):
                total[y] += part
                for k, v in zip(names, votes_of, strict=True):
                    sums[k][y][v] += part
        prior = total[1] / sum(total)
        rates = {k: tuple(tuple(x / sum(y) for x in y) for y in sums[k]) for k in names}
    return QualityModel(prior, rates)


def base_failed(m: Column) -> Column:
    return (m.n_words < 50) | (100 * m.n_repeat_words > 50 * m.n_words)


def score(measured: DataFrame, model: QualityModel, column: str = "measures", into: str = "quality") -> DataFrame:
    """Adds `into`: posterior probability of being good."""
    return measured.withColumn(into, model.posterior(rules(quoted(column))))


def keep_good(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that pass the base limits and whose posterior is at least `threshold`."""
    m, q = fresh(docs, "measures", "quality")
    measured = written(measures(docs, text, m), "measured")  # measured once: the texts go along
    model = fit(measured, m)
    kept = score(measured, model, m, q).filter(~base_failed(quoted(m)) & (quoted(q) >= threshold))
    return kept.select(*(quoted(c) for c in docs.columns))
