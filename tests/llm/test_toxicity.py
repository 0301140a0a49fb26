"""Toxicity: cue words, gradient and held-out figures against plain computations."""

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxoweave.llm import queries as Q
from taxoweave.llm import toxicity

SF = "/root/testdata/sf0.01"


def labelled(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    return Q.documents(spark, SF).join(labels, "doc_id").filter("toxic IS NOT NULL").select(
        F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic")
    ).withColumn("k", F.xxhash64("text", "toxic"))


def plain_cues(rows, max_train, min_z=3.0):
    words = [set(re.findall(r"[^\W_]+", r.text.lower())) for r in rows]
    n = [sum(r.toxic == y for r in rows) for y in (0, 1)]
    sample = sorted(r.k for r in rows if r.toxic == 1)[:max_train]
    out = []
    for w in set().union(*(ws for ws, r in zip(words, rows, strict=True) if r.toxic == 1 and r.k <= sample[-1])):
        t, c = (sum(w in ws and r.toxic == y for ws, r in zip(words, rows, strict=True)) for y in (1, 0))
        odds = (t + 0.5) / (n[1] + 1) / ((c + 0.5) / (n[0] + 1))
        if odds > 2 and math.log(odds) >= min_z * math.sqrt(1 / (t + 0.5) + 1 / (c + 0.5)):
            out.append(w)
    return sorted(out)


@pytest.mark.parametrize("max_train", [20_000, 20])
def test_cue_words(spark, max_train):
    """No number of words is set: every word of the sample that passes the test is a cue."""
    train = labelled(spark)
    expected = plain_cues(train.collect(), max_train)
    assert expected and toxicity.cue_words(train, max_train) == expected


@pytest.mark.parametrize(("n_toxic", "n_clean"), [(1, 1), (3, 5000), (40, 300), (500, 500), (900, 20)])
def test_least_count(n_toxic, n_clean):
    """No word below the least count passes, whatever its clean texts."""
    t = np.arange(1, n_toxic + 1)[:, None] + 0.5
    c = np.arange(n_clean + 1)[None, :] + 0.5
    passed = np.log(t / (n_toxic + 1) / (c / (n_clean + 1))) >= 3 * np.sqrt(1 / t + 1 / c)
    least = np.flatnonzero(passed.any(axis=1))
    assert toxicity.least_count(n_toxic, n_clean, 3.0) == (least[0] + 1 if len(least) else n_toxic + 1)


def test_gradient():
    """Against differences of the likelihood, written out text by text."""
    rng = np.random.default_rng(5)
    texts = [[(set(rng.choice(5, rng.integers(1, 4)).tolist()), int(rng.integers(1, 4))) for _ in range(k)] for k in (0, 1, 3, 2, 4, 1)]
    y = np.array([0, 1, 1, 0, 1, 0], float)
    importance = rng.random(6)
    sentences = [(d, s, n) for d, bag in enumerate(texts) for s, n in bag]
    bags = toxicity.Bags(
        y, importance, np.array([d for d, _, _ in sentences]), np.array([n for _, _, n in sentences], float),
        np.array([i for i, (_, s, _) in enumerate(sentences) for _ in s]), np.array([c for _, s, _ in sentences for c in s])
    )

    def likelihood(w, leak_z):
        total = 0.0
        for bag, label, weight in zip(texts, y, importance, strict=True):
            rest = 1 - 1 / (1 + math.exp(-leak_z))
            for s, n in bag:
                rest *= (1 - 1 / (1 + math.exp(-toxicity.BASE - sum(w[c] for c in s)))) ** n
            total += weight * math.log(1 - rest if label else rest)
        return total

    w, leak_z, h = rng.normal(6, 1, 5), -2.0, 1e-6
    grad_w, grad_leak = toxicity.gradient(bags, w, leak_z)
    for i in range(5):
        step = h * np.eye(5)[i]
        assert abs(grad_w[i] - (likelihood(w + step, leak_z) - likelihood(w - step, leak_z)) / (2 * h)) < 1e-6
    assert abs(grad_leak - (likelihood(w, leak_z + h) - likelihood(w, leak_z - h)) / (2 * h)) < 1e-6


def test_bounded_sample(spark):
    """Words that only texts outside the sample have are not cues, and no cue keeps its first weight."""
    rows = [(f"vile{i % 4} talk here {i}. fine", 1) for i in range(60)] + [(f"good talk here {i}. fine", 0) for i in range(240)]
    model = toxicity.fit(spark.createDataFrame(rows, "text string, toxic int"), max_train=8)
    assert model.weights and set(model.weights) <= {f"vile{i}" for i in range(4)}
    assert all(abs(x + toxicity.BASE) > 1e-3 for x in model.weights.values())


def test_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").filter("toxic IS NOT NULL")
    rows = Q.op1_toxicity(spark, SF).join(labels, "doc_id").filter("held_out").collect()
    assert rows and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and 0 <= r.score <= 1 for r in rows)
    found = [r.predicted for r in rows if r.toxic == 1]
    wrong = [r.predicted for r in rows if r.toxic == 0]
    print(sum(found), len(found), sum(wrong), len(wrong))
    assert sum(found) / len(found) >= 0.6 and sum(wrong) / len(wrong) <= 0.02
