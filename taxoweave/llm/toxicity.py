"""Toxicity by multiple-instance learning.

A text is a bag of sentences.  A sentence s that has a cue word has the probability
p(s) = sigmoid(b + sum of the weights of its distinct cue words), one without has p(s) = 0;
the text's is the noisy-or of all its sentences and a leak: 1 - (1 - leak) * prod(1 - p(s)).
The leak alone stands for what no cue tells.  Weights are trained from document labels
alone, by gradient steps on the likelihood of that same product (a sentence that a text has
n times counts n times), so the sentences that carry the label are found without sentence
labels.

Cue words: Spark counts over all labelled rows in how many toxic and other texts each word
occurs; words whose log-odds are `min_z` standard errors above 0 are the features.  No number
of them is set.  A word that no training text has could not be weighed, so the words are those
of the training sample: the `max_train` labelled rows of each class with the smallest hash of
the text (documented bound).  Only the cue sentences of that sample reach the driver.  Words
are lowered alike where they are counted and where they are sought.

Defined cases: null and empty texts have no sentences and get the leak; very long texts are
scored whole; null labels are not learned from; repeated rows are scored one by one, and
train once each; texts of equal hash at the training bound are taken in any order, being
equal; without labels of both classes,
empty tables included, every text gets the starting leak; columns named like the added ones
keep their names, the added ones get underscores.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fresh, quoted, small_batches, written

SENTENCE_END = re.compile(r"[.!?\n]+")
WORD = re.compile(r"[^\W_]+")
#: A sentence without a cue has this log-odds (about 1 in 3,000); a cue must lift it.
BASE = -8.0
#: Words up to which a word table is broadcast (about 30 bytes each).
BROADCAST_WORDS = 300_000


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]
    leak: float
    base: float = BASE

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, probability) of each sentence with a cue word."""
        out, start = [], 0
        if self.weights.keys().isdisjoint(WORD.findall(text.lower())):
            return out
        for m in [*SENTENCE_END.finditer(text), None]:
            end = m.start() if m else len(text)
            cues = self.weights.keys() & set(WORD.findall(text[start:end].lower()))
            if cues:
                z = self.base + sum(self.weights[c] for c in cues)
                out.append((start, end, 1 / (1 + float(np.exp(-z)))))
            start = m.end() if m else end
        return out

    def probability(self, sentences: list[tuple[int, int, float]]) -> float:
        rest = 1 - self.leak
        for _, _, p in sentences:
            rest *= 1 - p
        return 1 - rest


def least_count(n_toxic: int, n_clean: int, min_z: float) -> int:
    """The fewest toxic texts that a word passing the test of `cue_words` can have.  The test is
    easiest for a word that at most min_z ** 2 / 4 + 1 clean texts have, and easier with each toxic one."""

    def passes(t: int) -> bool:
        odds = (t + 0.5) / (n_toxic + 1) * (n_clean + 1)
        return any(
            math.log(odds / (c + 0.5)) >= min_z * math.sqrt(1 / (t + 0.5) + 1 / (c + 0.5)) - 1e-9
            for c in range(math.ceil(min_z**2 / 4) + 1)
        )

    return 1 + bisect_left(range(1, n_toxic + 1), True, key=passes)


def cue_words(train: DataFrame, max_train: int = 20_000, min_z: float = 3.0) -> list[str]:
    """Words of the training sample of `train` (text, toxic, k: the order of sampling) that
    occur in toxic texts significantly more often than in others, counted over all rows."""
    keys = written(train.select("toxic", "k"), "toxic-keys")
    n_toxic, n_all = keys.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    n_clean = n_all - n_toxic
    if not n_toxic or not n_clean:
        return []
    last = keys.filter("toxic = 1").select("k").orderBy("k").limit(max_train).agg(F.max("k")).first()[0]
    words = F.array_distinct(F.split(F.lower("text"), "[^\\p{L}\\p{N}]+"))
    of = lambda toxic: train.filter(F.col("toxic") == toxic).select("k", F.explode(words).alias("w"))
    # only words that enough toxic texts have can be cues, so only these are counted in the others
    toxic = written(
        of(1).filter("w <> ''").groupBy("w").agg(F.count(F.lit(1)).alias("t"), F.min("k").alias("k")).filter(
            (F.col("t") >= least_count(n_toxic, n_clean, min_z)) & (F.col("k") <= last)
        ).select("w", "t"), "toxic-words"
    )
    few = toxic.count() <= BROADCAST_WORDS
    known = toxic.select("w")
    clean = of(0).join(F.broadcast(known) if few else known, "w").groupBy("w").agg(F.count(F.lit(1)).alias("c"))
    counts = toxic.join(clean, "w", "left").select("w", "t", F.coalesce("c", F.lit(0)).alias("c"))
    rate_t = (F.col("t") + 0.5) / (n_toxic + 1.0)
    rate_c = (F.col("c") + 0.5) / (n_clean + 1.0)
    error = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    return sorted(
        r.w for r in counts.filter((rate_t > 2 * rate_c) & (F.log(rate_t / rate_c) >= min_z * error)).select("w").collect()
    )


@dataclass(frozen=True)
class Bags:
    """Labelled texts as cue sentences: sentence i stands in text `of_doc`[i], `times`[i] times;
    occurrence j is cue `cue`[j] in sentence `sentence`[j]."""

    y: np.ndarray
    importance: np.ndarray
    of_doc: np.ndarray
    times: np.ndarray
    sentence: np.ndarray
    cue: np.ndarray


def gradient(bags: Bags, w: np.ndarray, leak_z: float) -> tuple[np.ndarray, float]:
    """Of the weighted log likelihood, in the cue weights and in the log-odds of the leak."""
    z = BASE + np.bincount(bags.sentence, w[bags.cue], minlength=len(bags.of_doc))
    p = np.clip(1 / (1 + np.exp(-z)), 0, 1 - 1e-9)
    leak = 1 / (1 + np.exp(-leak_z))
    log_rest = np.log1p(-leak) + np.bincount(bags.of_doc, bags.times * np.log1p(-p), minlength=len(bags.y))
    rest = np.clip(np.exp(log_rest), 1e-12, 1 - 1e-12)
    # d loglik / d log_rest: -y * rest / (1 - rest) + (1 - y)
    g = bags.importance * ((1 - bags.y) - bags.y * rest / (1 - rest))
    grad_z = -g[bags.of_doc] * bags.times * p  # d log(1 - p) / dz = -p
    return np.bincount(bags.cue, grad_z[bags.sentence], minlength=len(w)), float(np.sum(-g * leak))


def fit(
    docs: DataFrame, text: str = "text", label: str = "toxic", max_train: int = 20_000, rounds: int = 300
) -> ToxicityModel:
    """Trains on rows of `docs` whose label (0 or 1) is not null."""
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.coalesce(quoted(text), F.lit("")).alias("text"), quoted(label).cast("int").alias("toxic")
    ).filter("toxic IN (0, 1)").withColumn("k", F.xxhash64("text", "toxic"))
    cues = cue_words(rows, max_train)
    start = dict.fromkeys(cues, 1.0)
    probe = ToxicityModel(start, 0.0)

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {c: i for i, c in enumerate(cues)}
        for batch in batches:
            found = []
            for t in batch.text:
                bag = Counter(
                    tuple(sorted(place[c] for c in probe.weights.keys() & set(WORD.findall(t[a:b].lower())))) for a, b,
                    _ in probe.sentences(t)
                )
                found.append([{"cues": list(x), "n": n} for x, n in sorted(bag.items())])
            yield pd.DataFrame({"toxic": batch.toxic, "k": batch.k, "bag": found})

    made = written(rows.mapInPandas(bags, "toxic int, k long, bag array<struct<cues:array<int>,n:int>>"), "bags")
    taken = [
        r for y in (0, 1) for r in made.filter(F.col("toxic") == y).orderBy("k").limit(max_train).select("toxic", "bag").collect()
    ]
    share = {0: 0, 1: 0} | {r.toxic: r["count"] for r in made.groupBy("toxic").count().collect()}
    if not taken or not share[0] or not share[1]:
        return ToxicityModel({}, 0.05)
    n_taken = {y: sum(r.toxic == y for r in taken) for y in (0, 1)}
    # rows of a class that was cut count for more
    importance = np.array([share[r.toxic] / n_taken[r.toxic] for r in taken])
    importance /= importance.sum()
    bags_taken = Bags(
        y=np.array([r.toxic for r in taken], float), importance=importance,
        of_doc=np.array([d for d, r in enumerate(taken) for _ in r.bag], int),
        times=np.array([b.n for r in taken for b in r.bag], float),
        sentence=np.array([s for s, b in enumerate(b for r in taken for b in r.bag) for _ in b.cues], int),
        cue=np.array([c for r in taken for b in r.bag for c in b.cues], int)
    )
    w = np.full(len(cues), -BASE)
    leak_z, step_w, step_l = -3.0, np.zeros(len(cues)), 0.0
    for _ in range(rounds):
        grad_w, grad_l = gradient(bags_taken, w, leak_z)
        grad_w = grad_w - 1e-5 * w
        step_w = 0.9 * step_w + 0.1 * grad_w**2
        step_l = 0.9 * step_l + 0.1 * grad_l**2
        w += 0.1 * grad_w / (np.sqrt(step_w) + 1e-8)
        leak_z += 0.05 * grad_l / (np.sqrt(step_l) + 1e-8)
    return ToxicityModel({c: float(x) for c, x in zip(cues, w, strict=True)}, float(1 / (1 + np.exp(-leak_z))))


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """Adds toxicity (0 to 1) and toxic_sentences: array of struct(start, end, probability)
    of the sentences that alone reach `threshold`, in characters."""
    small_batches(docs.sparkSession)
    name, where, tmp = fresh(docs, "toxicity", "toxic_sentences", "toxicity_found")

    @F.pandas_udf("struct<p:double,s:array<struct<start:int,end:int,probability:double>>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [model.sentences(t) for t in texts]
            yield pd.DataFrame(
                {
                    "p": [model.probability(f) for f in found],
                    "s": [[{"start": a, "end": b, "probability": p} for a, b, p in f if p >= threshold] for f in found]
                }
            )

    df = docs.withColumn(tmp, run(F.coalesce(quoted(text), F.lit(""))))
    return df.select(*(quoted(c) for c in docs.columns), quoted(tmp)["p"].alias(name), quoted(tmp)["s"].alias(where))
