"""Encoders, word vectors, string similarity and clusters against known or brute-force answers."""

import math

import numpy as np
import pytest

from taxoweave.operators import models as M
from taxoweave.operators import vectors as V


def test_jaro_winkler(spark):
    known = [
        ("MARTHA", "MARHTA", 0.961111), ("DIXON", "DICKSONX", 0.813333), ("DWAYNE", "DUANE", 0.84), ("abc", "xyz", 0.0),
        ("same", "same", 1.0), ("", "a", 0.0), ("", "", 1.0), ("a", "b", 0.0), ("ab", "abc", 0.911111)
    ]
    df = spark.createDataFrame([*((a, b) for a, b, _ in known), (None, "a")], "a string, b string")
    got = {(r.a, r.b): r.s for r in df.withColumn("s", M.jaro_winkler("a", "b")).collect()}
    assert got.pop((None, "a")) is None
    assert all(math.isclose(got[a, b], s, abs_tol=1e-6) for a, b, s in known)


def test_encoder_sees_each_text_once(spark, tmp_path):
    log = str(tmp_path / "log")

    def encoder(texts):
        assert len(texts) <= 4
        with open(log, "a") as f:
            f.write("".join(t + "\n" for t in texts))
        return [[len(t), ord(t[0])] for t in texts]

    df = spark.createDataFrame([(f"text {i % 11}",) for i in range(50)] + [(None,)], "text string")
    out = {r.text: r.v for r in M.encode_texts(df, encoder, batch=4).collect()}
    assert out == {f"text {i}": [float(len(f"text {i}")), float(ord("t"))] for i in range(11)}
    assert sorted(open(log).read().split("\n")[:-1]) == sorted(out)


def test_word_vectors(spark):
    """Words of one kind of sentence are nearer to each other than to those of another kind."""
    pick = np.random.default_rng(1)
    kinds = [["pool", "spa", "sauna", "tub"], ["train", "bus", "metro", "tram"]]
    rows = [([str(pick.choice(kinds[i % 2])) for _ in range(6)],) for i in range(400)]
    words = M.train_word_vectors(spark.createDataFrame(rows, "words array<string>").coalesce(1), size=12, window=4)
    v = {r.word: np.array(r.v) / np.linalg.norm(r.v) for r in words.collect()}
    inside = np.mean([v[a] @ v[b] for k in kinds for a in k for b in k if a < b])
    across = np.mean([v[a] @ v[b] for a in kinds[0] for b in kinds[1]])
    assert set(v) == {*kinds[0], *kinds[1]} and inside > across


def test_label_vectors(spark):
    words = spark.createDataFrame(
        [("hot", [1.0, 2.0]), ("tub", [3.0, -1.0]), ("tub2", [0.5, 0.5])], "word string, v array<double>"
    )
    labels = spark.createDataFrame([(1, "hot tub"), (2, "hot hot tub2"), (3, "hot unknown")], "uri long, label string")
    out = {r.uri: r.v for r in M.label_vectors(labels, words).collect()}
    want = {}
    table = {r.word: np.array(r.v) for r in words.collect()}
    for r in labels.filter("uri < 3").collect():
        m = np.mean([table[w] for w in r.label.split()], axis=0)
        want[r.uri] = m / np.linalg.norm(m)
    assert set(out) == set(want) and all(np.allclose(out[k], want[k]) for k in want)


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_chain_is_one_cluster(spark, limit):
    """1,000 points, each near the next only, and 20 points apart from them."""
    rows = [
        (i, [math.cos(i / 1000), math.sin(i / 1000), 0.0]) for i in range(1000)
    ] + [(2000 + i, [0.0, 0.0, 1.0 + i]) for i in range(20)]
    df = spark.createDataFrame(rows, "uri long, v array<double>").repartition(4)
    out = {r.uri: r.cluster for r in V.similarity_clusters(df, 0.0011, broadcast_bytes=limit).collect()}
    assert out == {i: 0 for i in range(1000)} | {2000 + i: 2000 for i in range(20)}


def test_search_from_either_side(spark):
    rng = np.random.default_rng(4)
    q = [(i, rng.normal(size=8).tolist()) for i in range(60)]
    t = [(i, rng.normal(size=8).tolist()) for i in range(25)]
    queries, vectors = spark.createDataFrame(q, "c long, v array<double>"), spark.createDataFrame(
        t, "uri long, v array<double>"
    )
    unit = lambda rows: np.array([v / np.linalg.norm(v) for v in (np.array(r[1]) for r in rows)])
    s = unit(q) @ unit(t).T
    want = {(i, int(j)) for i in range(60) for j in np.argsort(-s[i])[:3] if s[i, j] >= 0.2}
    for limit in (1 << 20, 60 * 64 - 1, 0):  # the queries are sent, the vectors are, neither is
        got = {
            (r.c, r.uri): r.sim_score for r in V.similarity_search(
                queries, vectors, min_score=0.2, k=3, broadcast_bytes=limit
            ).collect()
        }
        assert set(got) == want and all(math.isclose(x, s[k], abs_tol=1e-9) for k, x in got.items())
    pairs = {
        (r.c, r.uri): r.sim_score for r in V.pair_similarity(
            spark.createDataFrame([(1, 2), (3, 4), (99, 1)], "c long, uri long"), queries, vectors
        ).collect()
    }
    assert set(pairs) == {(1, 2), (3, 4)} and math.isclose(pairs[1, 2], s[1, 2], abs_tol=1e-9)
    assert V.similarity_search(queries.limit(0), vectors).count() == 0


def test_word_vectors_keep_the_most_frequent_words(spark):
    """A bound on the words raises the least count; the rarest words go, none that is more frequent."""
    rows = [([f"w{i}"] * (i + 1),) for i in range(40)] + [(["often"] * 5000,), (["common"] * 3000,)]
    sentences = spark.createDataFrame(rows, "words array<string>")
    assert M.least_count(sentences, 1, 100) == 1 and M.least_count(sentences, 7, 100) == 7
    for most in (41, 20, 5, 2, 1):
        least = M.least_count(sentences, 1, most)
        left = [len(w) for (w,) in rows if len(w) >= least]
        assert len(left) <= most and (most < 3 or len(left) == most)
    words = M.train_word_vectors(sentences, size=4, max_words=10, partitions=1)
    assert {r.word for r in words.collect()} == {"often", "common", *(f"w{i}" for i in range(32, 40))}
