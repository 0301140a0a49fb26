"""Quality classifier, lexical search and whitening, against brute force and known answers."""

import math
import random
import re
import zlib
from collections import Counter
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from taxoweave.llm import classifier, lexical, whitening
from taxoweave.llm import queries as Q
from tests.llm.test_planted import edge, empty

SF = "/root/testdata/sf0.001"
SF_MORE = "/root/testdata/sf0.01"

# --- quality classifier


def brute_tokens(text):
    """Runs of letters and digits, or of other visible characters, as bytes."""
    return re.findall(rb"[0-9A-Za-z\x80-\xff]+|[!-/:-@\[-`{-~]+", text.encode())


def bucket_of(token):
    (found,) = classifier.token_buckets(pa.array([token.decode()]))
    return int(found[1][0])


def test_tokens_and_neighbours():
    texts = ["The cat!! sat, été\x01x", "", None, "a-b  c", " \n"]
    rows, buckets = (np.concatenate(x) for x in zip(*classifier.token_buckets(pa.array(texts)), strict=True))
    want = [(i, bucket_of(t)) for i, text in enumerate(texts) for t in brute_tokens(text or "")]
    assert list(zip(rows.tolist(), buckets.tolist(), strict=True)) == want
    place, sign = classifier.sparse_vectors()
    sums = classifier.neighbour_sums(rows, buckets, classifier.BUCKETS, classifier.SIZE)
    expected = np.zeros_like(sums)
    for i, (row, b) in enumerate(want):
        for j in range(max(0, i - 2), min(len(want), i + 3)):
            if j != i and want[j][0] == row:
                for p, s in zip(place[want[j][1]], sign[want[j][1]], strict=True):
                    expected[b, p] += s
    assert (sums == expected).all()


def test_word_vectors_over_all_texts(spark):
    texts = [f"the {x} dog runs to {x} houses" for x in ("red", "blue", "green")] * 5 + [None, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    words = classifier.word_vectors(docs)
    a, b, c = (words.vectors[bucket_of(w)] for w in (b"red", b"blue", b"houses"))
    assert a @ b > 0.99 and a @ b > a @ c and abs(np.linalg.norm(c) - 1) < 1e-6
    # long texts, cut into pieces, are pooled like their parts
    once, many = words.pooled(pa.array(["red dog ", "red dog " * 300_000]))
    assert np.allclose(once[:-1], many[:-1], atol=1e-4) and abs(many[-1] - math.log(600_001)) < 1e-9
    assert (words.pooled(pa.array(["", None])) == 0).all()


def test_network_gradients_and_temperature():
    rng = np.random.default_rng(5)
    x, y, w = rng.standard_normal((30, 4)), (rng.random(30) < 0.5).astype(float), rng.random(30) + 0.1
    net = classifier.Network(np.zeros(4), np.ones(4), [rng.standard_normal(s) for s in ((4, 3), 3, 3, 1)])
    loss = lambda: classifier.cross_entropy(net.forward(x)[1], y, w) + 0.005 * sum(
        (net.layers[i] ** 2).sum() for i in (0, 2)
    )
    for p, g in zip(net.layers, net.gradients(x, y, w, 0.01), strict=True):
        for at in np.ndindex(p.shape):
            keep, p[at] = p[at], p[at] + 1e-6
            up = loss()
            p[at] = keep - 1e-6
            down, p[at] = loss(), keep
            assert abs((up - down) / 2e-6 - g[at]) < 1e-6
    z = rng.standard_normal(4000)
    y = (rng.random(4000) < classifier.sigmoid(z)).astype(float)
    assert 2.6 < classifier.best_temperature(3 * z, y, np.ones(4000)) < 3.5


def test_op11_held_out(spark):
    labels = spark.read.parquet(f"{SF_MORE}/labels.parquet")
    rows = Q.op11_quality_classifier(spark, SF_MORE).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    # scores are probabilities: right on average, and far better than the share alone
    share = sum(r.quality for r in held) / len(held)
    assert abs(sum(r.score for r in held) / len(held) - share) < 0.06
    loss = sum(-math.log(r.score if r.quality else 1 - r.score) for r in held) / len(held)
    assert loss < -0.5 * (share * math.log(share) + (1 - share) * math.log(1 - share))


def test_quality_edges(spark):
    labelled = spark.createDataFrame(
        [(f"good words here {i}", 1) for i in range(30)] + [("bad!! bad!!", 0)] * 20 + [(None, 0), ("x", None), ("y", 7)],
        "text string, quality int"
    )
    docs = edge(spark).withColumn("quality_score", F.lit(3))
    words = classifier.word_vectors(docs)
    out = classifier.score(docs, classifier.fit(words, labelled))
    assert out.columns == [*docs.columns, "_quality_score"]
    rows = out.collect()
    assert len(rows) == 7 and all(0 <= r._quality_score <= 1 for r in rows)
    assert len({round(r._quality_score, 12) for r in rows if r.doc_id == 6}) == 1
    assert len({round(r._quality_score, 12) for r in rows if not (r.text or "").strip()}) == 1
    for few in (labelled.filter("quality = 1"), labelled.limit(0)):
        scores = {r._quality_score for r in classifier.score(docs, classifier.fit(words, few)).collect()}
        assert scores == {30.5 / 31 if few.count() else 0.5}
    nothing = empty(spark)
    assert classifier.score(nothing, classifier.fit(classifier.word_vectors(nothing), labelled)).collect() == []


# --- ranked lexical search


def brute_search(docs, items, k):
    """(item, rank, doc, score) by scoring everything; docs and items are (id, text)."""
    split = lambda t: re.findall(
        r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    )
    held = [(i, Counter(w), len(w)) for i, t in docs if (w := split(t))]
    n, total = len(held), sum(size for _, _, size in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, size in held:
            m = 50 + (50 * size * n) // total
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for
                t in set(split(text)) if t in c
            )
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def clustered(seed=3, n=900):
    """Texts of thirty topics, each with words of its own, and copies."""
    pick = random.Random(seed)
    topics = [[f"t{i}w{j}" for j in range(40)] for i in range(30)]
    docs = [(i, " ".join(pick.choices(topics[i % 30] + ["the", "Of", "été"], k=pick.randrange(5, 60)))) for i in range(n)]
    docs += [(n + i, docs[7][1]) for i in range(40)] + [docs[3], docs[3], (None, docs[5][1]), (9998, None), (9999, "., !")]
    items = [(i, " ".join(pick.sample(topics[i], 6)) + " the zzz") for i in range(12)] + [(50, docs[7][1]), (50, docs[7][1])]
    return docs, [*items, (51, None), (None, "THE été"), (53, "nowhere"), (54, "")]


@pytest.mark.parametrize("small", [False, True])
def test_search_brute_force(spark, monkeypatch, small):
    docs, items = clustered()
    if small:  # many shards, leaves and blocks of queries, and a first sample
        for name, value in (("SHARD", 100), ("LEAF", 4), ("BLOCK_ITEMS", 5), ("SAMPLE", 300)):
            monkeypatch.setattr(lexical, name, value)
    table = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n long, q string").repartition(3)
    found = lexical.search(table, spark.createDataFrame(items, "item_id long, text string"), k=20)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_search(docs, items, 20)


def test_search_prunes_whole_subtrees():
    docs, items = clustered(n=6000)
    texts = [t for _, t in docs if t and t != "., !"]
    split = [[zlib.crc32(w.encode()) for w in re.findall(r"\w+", t.lower())] for t in texts]
    terms = [(i, sorted({zlib.crc32(w.encode()) for w in t.lower().split()})) for i, (_, t) in enumerate(items[:12])]
    block = lexical.Block.of(terms)
    at = [Counter(int(np.searchsorted(block.terms, w)) for w in ws if w in set(block.terms.tolist())) for ws in split]
    df = Counter(t for c in at for t in c)
    rarity = [math.floor(1000 * math.log((2 * len(at) + 2) / (2 * df[t] + 1))) for t in range(len(block.terms))]
    weights = lexical.Weights(len(at), sum(map(len, split)), np.array(rarity, np.int64))
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(range(len(at)), pa.int64()), pa.array([len(w) for w in split]),
            pa.array([list(c) for c in at], pa.list_(pa.int32())), pa.array([[*c.values()] for c in at], pa.list_(pa.int32()))
        ],
        ["doc_id", "n", "at", "tf"]
    )
    search = lexical.Search(block, weights, 20)
    search.add(iter([batch]))
    assert search.rows == len(at) and search.scored < 0.35 * len(at) * len(terms)


def test_search_edges(spark):
    items = spark.createDataFrame([(1, "word same"), (2, None)], "item_id int, text string")
    found = lexical.search(edge(spark), items).collect()
    assert {(r.item_id, r.doc_id) for r in found} == {(1, 5), (1, 6)} and len(found) == 3
    for docs, asked in ((empty(spark), items), (edge(spark), items.limit(0)), (edge(spark), items.filter("item_id = 2"))):
        none = lexical.search(docs, asked)
        assert none.columns == ["item_id", "rank", "doc_id", "score"] and none.collect() == []


# --- whitening


@pytest.mark.parametrize(("d", "k", "widest"), [(1, 4, None), (7, 16, None), (60, 6, 20), (200, 5, None)])
def test_jacobi_davidson(d, k, widest):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((2 * d, d)) * np.linspace(2, 0.5, d)
    matrix, calls = a.T @ a, []

    def product(block):
        calls.append(block.shape[1])
        return matrix @ block

    values, vectors, norms = whitening.jacobi_davidson(product, d, k, widest=widest)
    want, exact = np.linalg.eigh(matrix)
    k = min(k, d)
    assert np.allclose(values, want[::-1][:k], rtol=1e-12)
    assert np.allclose(np.abs((vectors * exact[:, ::-1][:, :k]).sum(axis=0)), 1, atol=1e-9)
    assert (norms <= 64 * d * whitening.EPS * values[0]).all() and calls


def test_minres_solves():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((12, 12))
    a, right = a + a.T, rng.standard_normal((12, 3))
    shifts = np.array([0.3, -0.2, 5.0])
    got = whitening.minres(lambda z: a @ z - z * shifts, right, 12, 1e-14)
    for j, s in enumerate(shifts):
        assert np.allclose((a - s * np.eye(12)) @ got[:, j], right[:, j], atol=1e-6)


def brute_whitened(rows, k=16):
    """Rows (id, vector) by a full eigendecomposition and whole numbers of any size."""
    used = [
        (i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v and all(
            c is not None and math.isfinite(c) for c in v
        )
    ]
    fit = np.array(sorted({tuple(x) for _, x in used}), float)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    y = fit - fit.mean(axis=0)
    cov = y.T @ y / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    real = e > len(cov) * 2e-16 * e[0]
    e, u = e[real], u[:, real]
    z = (np.array([x for _, x in used], float) - fit.mean(axis=0)) @ u / np.sqrt(e)
    deviation = [sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)) for _, x in used]
    return [i for i, _ in used], n, deviation, z, e / np.trace(cov)


def test_op13_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    ids, n, deviation, z, share = brute_whitened(rows)
    found = {(r.vec_id, r.component): r for r in Q.op13_embedding_whitening(spark, SF).collect()}
    assert len(found) == 16 * len(ids)
    sign = np.sign([found[ids[0], c + 1].whitened * z[0, c] for c in range(16)])
    for j, i in enumerate(ids):
        for c in range(16):
            r = found[i, c + 1]
            assert (r.n, r.deviation) == (n, deviation[j])
            assert abs(r.whitened * sign[c] - z[j, c]) < 1e-7 and abs(r.explained - share[c]) < 1e-12
            assert 0 <= r.identity_error < 1e-9


def test_whitening_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (2, [0.5, -1.0, 3.0]), (None, [2.0, 0.0, 3.0]), (4, None), (5, []),
        (6, [1.0, None, 2.0]), (7, [nan, 1.0, 1.0]), (8, [1.0, -inf, 1.0]), (9, [1.0, 2.0])
    ]
    table = spark.createDataFrame([(*r, 0, "y") for r in rows], "vec_id int, embedding array<float>, n int, x string")
    used = whitening.points(table)
    out = whitening.transform(used, whitening.fit(used)).collect()
    ids, n, deviation, z, _ = brute_whitened([r for r in rows if r[0] != 9])
    assert len(out) == 2 * 4 and {r.n for r in out} == {3} and z.shape[1] == 2  # the third entry never varies
    assert sorted((str(r.vec_id), r.deviation) for r in out) == sorted(
        (str(i), d) for i, d in zip(ids, deviation, strict=True) for _ in range(2)
    )
    for few in (table.limit(0), table.filter("vec_id = 1"), table.filter("vec_id = 4")):
        used = whitening.points(few)
        assert whitening.transform(used, whitening.fit(used)).collect() == []


def test_wide_deviations(spark):
    rows = [(i, [float(i * 50_000_000), float((i * i) % 7)]) for i in range(50)]
    used = whitening.points(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    model = whitening.fit(used)
    assert not model.centre.narrow
    ids, _, deviation, _, _ = brute_whitened(rows)
    out = {r.vec_id: r.deviation for r in whitening.transform(used, model).collect()}
    assert out == {i: Decimal(d) for i, d in zip(ids, deviation, strict=True)}
