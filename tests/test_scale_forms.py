"""Forms made for large sides, against plain ones: pivots, impact tiers, levels, word places, bits."""

import random

import numpy as np
import pytest

from taxoweave.operators import concepts, impact, models, pivots, relations, retrieval, rules, vectors


def clustered(n, seed, d=16, centres=12):
    """Vectors near twelve directions, copies of one, and one of length 0."""
    rng = np.random.default_rng(seed)
    middle = np.random.default_rng(1).standard_normal((centres, d))
    rows = [(i, (middle[i % centres] + 0.15 * rng.standard_normal(d)).tolist()) for i in range(n)]
    return rows + [(n + i, middle[0].tolist()) for i in range(60)] + [(n + 90, [0.0] * d)]


def test_pivots_leave_out_only_what_cannot_match(spark):
    a, b = clustered(300, 2), clustered(500, 3)
    q = spark.createDataFrame(a, "c long, v array<double>")
    t = spark.createDataFrame(b, "uri long, v array<double>")
    index = pivots.plan(q, t, 0.9, 40, ("c", "uri"))
    assert index.share() < 0.3
    assert index.left.rows.count() == len(a) - 1 and max(
        r["count"] for r in index.right.rows.groupBy("block").count().collect()
    ) <= 80
    m, n = (np.array([v for _, v in x]) for x in (a, b))
    cos = (m @ n.T) / np.maximum(np.outer(np.linalg.norm(m, axis=1), np.linalg.norm(n, axis=1)), 1e-300)
    want = {(a[i][0], b[j][0]) for i, j in zip(*np.nonzero(cos >= 0.9), strict=True)}
    found = vectors.similarity_search(q, t, min_score=0.9, broadcast_bytes=0, block=40).collect()
    assert {(r.c, r.uri) for r in found} == want and len(found) == len(want)
    none = vectors.similarity_search(q, t.filter("uri < 0"), min_score=0.9, broadcast_bytes=0)
    assert none.collect() == []


def test_clusters_by_pivots(spark):
    t = spark.createDataFrame(clustered(400, 4), "uri long, v array<double>")
    index = pivots.plan(t, None, 0.875, 40, ("uri", "uri"))
    assert index.share() < 0.35
    plain = {r.uri: r.cluster for r in vectors.similarity_clusters(t, 0.5).collect()}
    blocks = {r.uri: r.cluster for r in vectors.similarity_clusters(t, 0.5, broadcast_bytes=0, block=40).collect()}
    assert blocks == plain and len(set(plain.values())) == 13


@pytest.mark.parametrize("k", [5, 50])
def test_impact_tiers(spark, k):
    """A word of half of all texts costs its highest tiers only."""
    pick = random.Random(4)
    rows = []
    for i in range(1500):
        rows += [("common", i, pick.choice([1, 1, 1, 2, 9]))] * (i % 2)
        rows += [(f"w{pick.randrange(200)}", i, pick.randrange(1, 4)) for _ in range(pick.randrange(1, 12))]
    table = spark.createDataFrame(rows, "term string, uri long, tf long").groupBy("term", "uri").sum("tf").toDF("term", "uri", "tf")
    asked = [(1, ["common", "w1", "w2"]), (2, ["common"]), (3, ["w5", "none"]), (4, ["none"]), (5, ["w7", "w7", "w8", "common"])]
    queries = spark.createDataFrame(asked, "c long, terms array<string>")
    index = impact.impact_index(table)
    plan = impact.plan_tiers(queries, index, k, 0.01)
    read = {r.c: r.x for r in plan.tiers.filter("term = 'common' AND (first OR needed)").groupBy("c").agg({"n": "sum"}).toDF("c", "x").collect()}
    assert read[1] < 750 * 0.75 and plan.share() < 1
    got = impact.bm25_by_impact(queries, index, k=k, plan=plan).collect()
    want = retrieval.bm25_search(queries, table, k=k).collect()
    key = lambda rows: sorted((r.c, r.uri, round(r.kw_score, 9)) for r in rows)
    assert key(got) == key(want) and want


def test_levels_have_plans_of_one_length(spark):
    anchors = spark.createDataFrame([(1, 0, 1.0), (1, 90, 0.3), (2, 50, 0.7)], "c int, uri long, score double")
    chain = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(i, 0) for i in range(100)], "src long, dst long")
    plans = {}
    for depth in (1, 6):
        out = relations.expand_relations(anchors, chain, depth=depth)
        plans[depth] = out._jdf.queryExecution().toString().count("\n")
        got = {(r.c, r.uri): (round(r.score, 9), r.depth) for r in out.collect()}
        want = {(1, 0): (1.0, 0), (1, 90): (0.3, 0), (2, 50): (0.7, 0), (2, 0): (round(0.7 * 0.35, 9), 1)}
        want |= {(1, i): (round(0.35**i, 9), i) for i in range(1, depth + 1)}
        want |= {(2, 50 + i): (round(0.7 * 0.35**i, 9), i) for i in range(1, depth + 1)}
        want |= {(2, i): (round(0.7 * 0.35 ** (i + 1), 9), i + 1) for i in range(1, depth)}
        assert got == want
    assert plans[1] == plans[6]


def test_phrases_by_places(spark):
    pick = random.Random(9)
    labels = [(i % 170, " ".join(pick.choices("abcd", k=pick.randrange(1, 7)))) for i in range(200)] + [(999, ""), (998, "a  b")]
    phrases = [(i, " ".join(pick.choices("abcde", k=pick.randrange(1, 4)))) for i in range(60)] + [(70, ""), (71, "a  b"), (72, "a b a b")]
    found = relations.phrase_matches(
        spark.createDataFrame(phrases, "c long, norm string"),
        relations.word_index(spark.createDataFrame(labels, "uri long, norm string"))
    )
    want = {(c, u) for c, p in phrases if p for u, t in labels if f" {p} " in f" {t} "}
    got = [tuple(r) for r in found.collect()]
    assert set(got) == want and len(got) == len(want)


def test_rules_by_bits(spark):
    pick = random.Random(6)
    attributes = [("t", g, f"{g}{i}") for g in "xyz" for i in range(100)] + [("u", "x", "y3"), ("u", "x", "shared"), ("t", "y", "shared")]
    groups = [("t", 1, "x", 3), ("t", 1, "y", 1), ("t", 2, "z", 5), ("u", 1, "x", 2)]
    held = [(p, a) for p in range(80) for _, _, a in pick.sample(attributes, pick.randrange(1, 30))] + [(200, "unknown"), (201, None)]
    dq = [("t", "x7")]
    make = spark.createDataFrame
    out = rules.evaluate_rules(
        make(held + held[:50], "p int, attr string"), make(groups, "theme string, alt_id int, grp string, required_count int"),
        make(attributes, "theme string, grp string, attr string"), make(dq, "theme string, attr string")
    )
    mine = {p: {a for q, a in held if q == p} for p, _ in held}
    has = lambda p, t, g: len(mine[p] & {a for th, gr, a in attributes if (th, gr) == (t, g)})
    want = {
        (p, t, alt) for p in mine for t, alt in {(t, alt) for t, alt, _, _ in groups} if all(
            has(p, t, g) >= n for th, al, g, n in groups if (th, al) == (t, alt)
        ) and not (t == "t" and "x7" in mine[p])
    }
    assert {tuple(r) for r in out.collect()} == want and want


def test_store_encodes_new_texts_only(spark, tmp_path):
    log, store = tmp_path / "log", str(tmp_path / "store")
    log.mkdir()

    def encoder(texts):
        for t in texts:
            with open(log / (t.replace(" ", "_") or "empty"), "a") as f:
                f.write("x")
        return [[len(t), 1.0] for t in texts]

    make = lambda *texts: spark.createDataFrame([(t,) for t in texts], "text string")
    first = models.encode_stored(make("a", "b b", "a", None, ""), encoder, store).collect()
    assert {(r.text, tuple(r.v)) for r in first} == {("a", (1.0, 1.0)), ("b b", (3.0, 1.0)), ("", (0.0, 1.0))}
    second = models.encode_stored(make("a", "new"), encoder, store).collect()
    assert {r.text for r in second} == {"a", "new"} and len(second) == 2
    assert (log / "a").read_text() == "x" and (log / "new").read_text() == "x"
    assert models.encode_stored(make().limit(0), encoder, store).collect() == []


def test_sketches_of_files_are_added(spark):
    rows = [(f"urn:s{i % 900}", f"urn:p#{i % 7}", f"urn:o{i}", "uri" if i % 2 else "literal", f"f{i % 3}") for i in range(6000)]
    t = spark.createDataFrame(rows, "s string, p string, o string, o_kind string, source_file string")
    known = concepts.triple_sketches(t.filter("source_file <> 'f2'"))
    both = concepts.sketched_stats(known.unionByName(concepts.triple_sketches(t.filter("source_file = 'f2'")))).first()
    exact = concepts.triple_stats(t).first()
    assert both.triples == exact.triples == 6000 and both.predicates == 7
    assert all(abs(both[c] - exact[c]) <= 0.03 * exact[c] for c in concepts.SKETCHED)
    assert concepts.sketched_stats(concepts.triple_sketches(t.limit(0))).first().asDict() == dict.fromkeys(["triples", *concepts.SKETCHED], 0)


def test_equal_queries_and_labels_are_matched_once_and_lose_no_pair(spark):
    """Many copies, several labels of a URI, a row given twice, nulls: as a plain join."""
    labels = [(i, ["red box", "blue box", "red"][i % 3]) for i in range(60)] + [(0, "hot rod"), (1, "blue box"), (2, None)]
    queries = [(i, ["red box", "redbox", "blue", None][i % 4], "hot rod") for i in range(40)] + [(1, "red", "red box"), (50, "cold", "blue")]
    n = spark.createDataFrame(labels, "uri long, norm string")
    q = spark.createDataFrame(queries, "c long, norm string, spaced string")
    first = [(c, u, 1) for c, a, _ in queries for u, b in labels if a is not None and a == b]
    hit = {c for c, _, _ in first}
    want = sorted(first + [(c, u, 2) for c, _, s in queries if c not in hit for u, b in labels if s == b])
    assert sorted(map(tuple, relations.direct_label_match(q, n).collect())) == want
    held = {(c, u) for c, a, _ in queries if a for u, b in labels if b and f" {a} " in f" {b} "}
    e = spark.createDataFrame([(3, "related", 999), (4, "other", 998)], "uri long, rel string, dst long").withColumnRenamed("uri", "src")
    near = held | {(c, 999) for c, u in held if u == 3}
    found = [tuple(r) for r in relations.partial_label_match(q.select("c", "norm"), n, e).collect()]
    assert set(found) == near and len(found) == len(near)
    con = spark.createDataFrame([("red", "blue"), ("blue", "red")], "pattern string, word string")
    bad = {(c, u) for c, a, _ in queries if a for u, b in labels if b and a != b for p, w in (("red", "blue"), ("blue", "red")) if p in a.split() and w in b.split()}
    found = [tuple(r) for r in relations.must_not_have_by_pattern(q.select("c", "norm"), con, n).collect()]
    assert set(found) == bad and len(found) == len(bad)


def test_classes_meet_in_blocks(spark):
    rows = spark.createDataFrame([(i, i % 2, None) for i in range(300)], "c long, k int, word string")
    members, forms = relations.classes(rows, "c")
    assert forms.count() == 2 and members.count() == 300
    others = spark.createDataFrame([(i, i % 2) for i in range(200)], "uri long, k int")
    named, labels = relations.classes(others, "uri")
    met = forms.join(labels, "k").select("c", "uri", "word")
    out = relations.expand_classes(met.unionByName(met), members, named, size=16)
    want = sorted((i, j, None) for i in range(300) for j in range(200) if i % 2 == j % 2)
    assert sorted(map(tuple, out.collect())) == sorted(want * 2)
    # a task holds blocks, not a class: no group of members is larger than a few blocks
    assert max(r[0] for r in relations._member_blocks(members, "c", 16).selectExpr("size(c_members)").collect()) < 64


def test_written_pairs_of_classes_are_small_and_arrays_are_not_sorted(spark, tmp_path):
    """2.25 million pairs of two classes, whose members are given in chunks that a file holds once."""
    left, right = (spark.range(1500).selectExpr("'x' AS k", "xxhash64(id) AS member").withColumnRenamed("k", k) for k in ("c", "uri"))
    pairs = spark.createDataFrame([("x", "x", 0.5)], "c string, uri string, score double")
    out = relations.expand_classes(pairs, left, right)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "first(uri_members" not in plan and "c_block#" not in plan.split("Join Inner")[0]
    out.write.parquet(f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.distinct().count() == back.count() == 1500 * 1500
    assert sum(f.stat().st_size for f in (tmp_path / "out").glob("*.parquet")) < 0.3 * 1500 * 1500


@pytest.mark.parametrize("name", ["d22_manual_mapping", "d25_association_boost", "c13_forbidden_context"])
def test_pairs_are_not_shuffled(spark, name):
    """Labels are put together by text before they meet the queries: no text is a join key of single rows."""
    from taxoweave import catalog

    plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    if name == "d22_manual_mapping":
        assert "Aggregate [norm#" in plan
    else:
        assert "c_members" in plan and "uri_members" in plan


def test_pairs_leave_a_worker_in_tiles_of_bounded_size():
    rng = np.random.default_rng(5)
    a, b = rng.standard_normal((700, 8)), rng.standard_normal((6000, 8))
    tiles = [*vectors._tiles(a, b, -100.0, None, None)]
    assert max(len(s) for _, _, s in tiles) <= vectors.CELLS < len(a) * len(b)
    assert sum(len(s) for _, _, s in tiles) == len(a) * len(b)
    i, j, s = (np.concatenate(x) for x in zip(*vectors._tiles(a, b, None, None, 3), strict=True))
    assert sorted(zip(i, j)) == sorted((r, c) for r in range(700) for c in np.argsort(-(a[r] @ b.T))[:3])
    assert [*vectors._tiles(a, b[:0], None, None, 3)] == []


def test_strict_concepts_are_made_without_joins(spark):
    rows = [
        ("a", "x#prefLabel", "n"), ("a", "x#prefLabel", "m"), ("a", "y/prefLabel", "n"), ("a", "x#broader", "b"),
        ("b", "x#other", "n"), ("b", "x#label", None), ("c", "x#label", "n"), ("c", "x#deprecated", "TRUE"),
        ("d", "x#label", "n"), ("d", "x#deprecated", "false"), (None, "x#label", "n"), ("e", "x#deprecated", "true")
    ]
    t = spark.createDataFrame(rows, "s string, p string, o string").selectExpr("*", "'literal' AS o_kind")
    found = concepts.concepts_strict(t)
    assert {(r.uri, r.prop, *r["values"]) for r in found.collect()} == {
        ("a", "prefLabel", "m", "n"), ("a", "broader", "b"), ("b", "label"), ("d", "label", "n")
    } and found.count() == 4
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def plain_cosine(a, b):
    if a is None or b is None or len(a) != len(b) or None in a or None in b:
        return 0.0
    x, y = np.array(a), np.array(b)
    n = np.linalg.norm(x) * np.linalg.norm(y)
    return 0.0 if n == 0 else float(x @ y / n)


def some_vectors(n, seed, d=4):
    """Keys with several vectors, copies, one of length 0 and a null."""
    rng = np.random.default_rng(seed)
    rows = [(int(i * 0.7), rng.standard_normal(d).round(1).tolist()) for i in range(n)]
    return [*rows, *rows[:3], (n, [0.0] * d), (n + 1, None)]


@pytest.mark.parametrize("size", [1 << 20, 0])
def test_best_similarity_has_a_row_a_pair(spark, size, monkeypatch):
    monkeypatch.setattr(vectors, "CELLS", 64)
    a, b = some_vectors(12, 6), some_vectors(90, 7)
    q, t = spark.createDataFrame(a, "c long, v array<double>"), spark.createDataFrame(b, "uri long, v array<double>")
    best = {}
    for c, x in a:
        for uri, y in b:
            if x and y and plain_cosine(x, y) >= 0.1:
                best[c, uri] = max(best.get((c, uri), -1), round(plain_cosine(x, y), 9))
    found = vectors.best_similarity(q, t, 0.1, broadcast_bytes=size).collect()
    assert {(r.c, r.uri): round(r.sim_score, 9) for r in found} == best and len(found) == len(best)
    top = vectors.best_similarity(q, t, 0.1, k=3, broadcast_bytes=size).collect()
    for c in {c for c, _ in best}:
        scores = sorted((-s for (x, _), s in best.items() if x == c))[:3]
        assert sorted(round(-r.sim_score, 9) for r in top if r.c == c) == scores
    assert vectors.best_similarity(q.filter("c < 0"), t, 0.1, 3, size).collect() == []


def test_slice_keeps_the_first_only_and_slots_are_not_shuffled(spark):
    """What a task gives of a concept's list does not grow with its vectors; pairs of slots meet no shuffle."""
    from taxoweave import catalog

    t = spark.range(4000).selectExpr("id AS uri", "array(1D, id / 4000) AS v").repartition(1)
    q = spark.createDataFrame([(1, [1.0, 0.0])], "c long, v array<double>")
    assert [r.uri for r in vectors.best_similarity(q, t, 0.1, 5).orderBy("uri").collect()] == [0, 1, 2, 3, 4]
    plan = lambda n: catalog.queries()[n](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    sliced, slots = plan("e26_kg_slice"), plan("d18_strict_theme_select")
    assert "WindowGroupLimit" in sliced and "MapInArrow" in sliced
    assert "Exchange" not in slots.split("MapInArrow")[0] or "BroadcastExchange" in slots.split("MapInArrow")[0]
    assert "SortMergeJoin" not in slots.split("MapInArrow")[0]


@pytest.mark.parametrize("size", [1 << 20, 0])
def test_slots_of_concepts_and_themes_with_and_without_vectors(spark, size):
    a, b = some_vectors(6, 8), some_vectors(40, 9)
    labels = [(i, f"red w{i % 5} w{i % 3}") for i in range(0, 60, 2)] + [(4, "red Red blue")]
    hints = [(0, "RED"), (1, "w1"), (1, "w2"), (2, "blue"), (77, "w4"), (7, "w3"), (0, "red")]
    frame = spark.createDataFrame
    found = vectors.slot_scores(
        frame(a, "c long, v array<double>"), frame(b, "uri long, v array<double>"), frame(labels, "uri long, label string"),
        frame(hints, "theme long, hint string"), 0.2, size
    ).collect()
    assert vectors.slot_scores(
        frame(a, "c long, v array<double>"), frame(b, "uri long, v array<double>").filter("uri < 0"),
        frame(labels, "uri long, label string"), frame(hints, "theme long, hint string"), 0.2, size
    ).selectExpr("sum(hits)", "max(sim)").collect() == [(sum(r.hits for r in found), 0.0)]
    hits, sims = {}, {}
    for uri, label in labels:
        for word in set(label.lower().split()):
            for theme in {h for h, w in hints if w.lower() == word}:
                hits[uri, theme] = hits.get((uri, theme), 0) + 1
    for c, x in a:
        for uri, y in b:
            if x and y:
                sims[uri, c] = max(sims.get((uri, c), -9), plain_cosine(x, y))
    want = {p: (round(sims.get(p, 0.0), 9), hits.get(p, 0)) for p in {*hits, *(p for p, s in sims.items() if s >= 0.2)}}
    assert {(r.uri, r.theme): (round(r.sim, 9), r.hits) for r in found} == want and len(found) == len(want)


@pytest.mark.parametrize("size", [1 << 20, 0])
def test_every_cosine_is_the_cosine_of_each_pair(spark, size, monkeypatch):
    monkeypatch.setattr(vectors, "CELLS", 64)
    a = [*some_vectors(9, 10), (50, [1.0, 2.0]), (51, []), (52, [1.0, None, 2.0, 0.0])]
    b = [*some_vectors(30, 11), (60, [2.0, 1.0]), (61, [1.0, None, 2.0, 0.0])]
    q, t = spark.createDataFrame(a, "c long, v array<double>"), spark.createDataFrame(b, "uri long, v array<double>")
    found = vectors.every_cosine(q, t, size)
    assert sorted((r.c, r.uri, round(r.sim_score, 9) + 0.0) for r in found.collect()) == sorted(
        (c, uri, round(plain_cosine(x, y), 9) + 0.0) for c, x in a for uri, y in b
    )
    assert ("MapInArrow" in found._jdf.queryExecution().executedPlan().toString()) == (size > 0)
    assert vectors.every_cosine(q.filter("c < 0"), t, size).collect() == []
