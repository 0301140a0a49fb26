"""Small planted cases for the corpus operators, against brute force or known answers."""

from pyspark.sql import functions as F

from taxoweave.llm import decontaminate, jaccard, kneser_ney, language, licenses, packing, pii, quality, queries, tokens, toxicity

EDGE = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "word " * 30000), (6, "same text again and again"),
    (6, "same text again and again")
]


def edge(spark):
    """Nulls, empty and very long texts, repeated rows, clashing column names."""
    return spark.createDataFrame(
        [(i, t, "x", 7, "en") for i, t in EDGE], "doc_id long, text string, measures string, score int, source string"
    )


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string, n_chars long")


def test_disclosing_term(spark, monkeypatch):
    rows = [
        (
            i, f"plain filler number{i} before secretword{'' if i % 2 else ' x'} bob@example.com after it ends{i}"
        ) for i in range(6)
    ]
    rows += [(100 + i, f"plain filler text before and after it without any mail {i}") for i in range(40)]
    rows += [(200, "a secretword stands alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for limit in (10_000, 0):  # by literals, and by a join
        monkeypatch.setattr(pii, "LITERAL_TERMS", limit)
        found = {r.doc_id: r.spans for r in pii.find(docs).collect()}
        assert [s.kind for s in found[200]] == [pii.TERM] and (found[200][0].start, found[200][0].end) == (2, 12)
        assert not found[100]
        clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
        assert clean[200] == "a [EMAIL TERM] stands alone here" and clean[101] == rows[7][1]
        assert "bob@" not in "".join(clean.values())


def test_disclosure_brute_force(spark):
    """Terms by pointwise mutual information over whole documents, from dictionaries."""
    import math
    import random
    import re

    pick = random.Random(11)
    vocabulary = [f"{a}{b}{c}" for a in "bdg" for b in "aeiou" for c in "nrt"]
    docs = []
    for i in range(240):
        w = pick.choices(vocabulary, k=pick.randrange(5, 40))
        if i % 6 == 0:
            at = pick.randrange(len(w))
            w[at:at] = [
                pick.choice(["mail", "write", "tonow"]), f"{pick.choice('xyz')}{i}@{pick.choice(['red', 'blue'])}.org"
            ] + (["office"] if i % 12 else [])
        if i % 10 == 3:
            w += ["token", f"a1b2c3d4e5f6a7b8c9d0e1f2{i:04d}"]
        docs.append((i, " ".join(w)))
    docs += [docs[0], docs[6], (500, None), (501, ""), (502, "mail me"), (503, "no office")]
    n, context, support, disclosure = len(docs), 5, 3, 0.9
    words_of = [set(re.findall(r"[a-z]+", (t or "").lower())) for _, t in docs]
    beside, having = {}, {}
    for d, (_, t) in enumerate(docs):
        for m in re.finditer(r"[a-z0-9]+@([a-z]+\.org)|a1b2[0-9a-f]{24}", t or ""):
            kind = 0 if "@" in m[0] else 4
            names = [(0, kind, m[0]), (2, kind, "")] + ([(1, 0, m[1])] if kind == 0 else [])
            near = re.findall(r"[a-z]+", t[: m.start()])[-context:] + re.findall(r"[a-z]+", t[m.end() :])[:context]
            for e in names:
                having.setdefault(e, set()).add(d)
                for w in near:
                    if len(w) >= 3:
                        beside.setdefault((e, w), set()).add(d)
    want = {}
    for (e, w), ds in beside.items():
        if len({docs[d][1] for d in ds}) < support:
            continue
        n_t, n_e, n_te = sum(w in x for x in words_of), len(having[e]), len(ds)
        pmi, ic = math.log(n * n_te / (n_t * n_e)), math.log(n / n_e)
        if ic > 0 and pmi >= disclosure * ic - 1e-9:
            best = want.setdefault(w, [])
            best.append((round(pmi / ic, 9), -e[1], e[0] < 2 and n_te >= n_t))
    want = {w: pii.REMOVED if any(x[2] for x in v) else pii.TERM - max(v)[1] for w, v in want.items()}
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    based = pii.secret_spans(pii.base_spans(df), "text", "spans", "more")
    got = {
        r.term: r.kind for r in pii.disclosing_terms(
            based.select("text", F.concat("spans", "more").alias("spans")), "spans"
        ).collect()
    }
    assert got == want and {"office", "token"} <= set(want)


def test_pii_many_spans(spark):
    """Places and marks where spans go over several chunks, overlap, or have few words near."""
    import re

    text = " - ".join(f"x{i}@mail.org, 10.0.{i % 256}.7 and 1.2.3.4.5.6.7.8@z.de" for i in range(700)) + " end"
    docs = spark.createDataFrame(
        [(1, text, "old"), (2, "far " + "9" * 500 + " 10.0.0.1 " + "8" * 500 + " away", "old")],
        "doc_id long, text string, spans string"
    )
    out = {r.doc_id: r["_spans"] for r in pii.base_spans(docs, into="_spans").collect()}
    email = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", text)]
    assert [(s.start, s.end) for s in out[1] if s.kind == 0] == email and len(email) == 1400
    clean = {r.doc_id: (r.text, r.spans) for r in pii.sanitise(docs).collect()}
    assert clean[1] == (" - ".join(["[EMAIL], [IP] and [EMAIL]"] * 700) + " end", "old")
    near = pii.base_spans(docs, into="_spans").filter("doc_id = 2").select(
        F.transform("_spans", lambda s: pii._beside(F.col("text"), s, 5)).alias("w")
    ).first().w
    assert ["far", "away"] in near


def test_pii_edges(spark):
    out = pii.sanitise(edge(spark)).collect()
    assert len(out) == len(EDGE) and {r.doc_id: r.text for r in out}[1] is None
    assert pii.find(empty(spark)).count() == 0


def test_quality_edges(spark):
    docs = edge(spark)
    m = {r.doc_id: r.m for r in quality.measures(docs, into="m").collect()}
    assert m[1].n_words == m[2].n_words == m[3].n_words == 0
    assert m[5].n_words == 30000 and m[5].n_repeat_words == 30000
    assert m[6].n_words == 5 and m[6].n_repeat_words == 0
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.keep_good(empty(spark)).count() == 0


def brute_repeats(words):
    wins = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return len({i + k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(3)})


def test_quality_counts(spark):
    texts = ["a b c d a b c", "x x x x", "a\nb\na\n\n \na", "a b a b a b", "#1 $2 <b>"]
    rows = quality.measures(
        spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), into="m"
    ).collect()
    for r in rows:
        words = r.text.split()
        lines = [x for x in r.text.split("\n") if x.split()]
        assert (r.m.n_words, r.m.word_chars, r.m.n_repeat_words, r.m.n_dup_lines) == (
            len(words), sum(map(len, words)), brute_repeats(words), len(lines) - len(set(lines))
        )


def test_decontaminate(spark):
    item = "One two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame(
        [
            (1, "Start: " + item.upper() + "; the end."), (2, "nothing here"), (3, None), (4, "short ONE-ITEM hit"),
            (5, "one two three four five six seven eight nine")
        ],
        "doc_id long, text string"
    )
    items = spark.createDataFrame([(10, item), (11, "one item"), (12, None), (13, "  ")], "item_id long, text string")
    for limit, hashes in ((50_000, 0), (0, 1000), (0, 0)):  # by literals, by broadcast hashes, and by a join
        found = {
            r.doc_id: (r.hit.n_words, list(r.hit["items"]), r.n) for r in decontaminate.find(
                docs, items, max_windows=limit, max_hashes=hashes
            ).withColumn("n", decontaminate.hit_words(F.col("hit"))).collect()
        }
        assert found[1] == (15, ["10"], 12) and found[2] == (2, [], 0) and found[3] == (0, [], 0) and found[4] == (4, ["11"], 2) and found[5][1] == []
    assert sorted(r.doc_id for r in decontaminate.clean(docs, items).collect()) == [2, 3, 5]
    spans = {r.doc_id: r.text for r in decontaminate.clean(docs, items, mode="spans").collect()}
    assert spans[1] == "Start; the end." and spans[2] == "nothing here" and spans[3] is None and spans[4] == "short hit"
    assert decontaminate.find(edge(spark), items).count() == len(EDGE)
    assert decontaminate.find(docs, items.limit(0)).filter("size(hit.items) > 0").count() == 0
    assert decontaminate.find(empty(spark), items).count() == 0 == decontaminate.find(
        empty(spark), items, max_windows=0
    ).count()
    assert decontaminate.find(
        edge(spark).withColumnRenamed("score", "hit"), items, max_windows=0, into="hits"
    ).count() == len(EDGE)


def test_jaccard_edges(spark):
    rows = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_components(edge(spark)).collect()}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 5), (6, 2, 6)} == rows
    assert jaccard.similar_components(empty(spark)).count() == 0


def brute_components(docs, n, percent):
    """{doc_id: smallest linked doc_id} of (doc_id, text) by all pairs."""
    sets = {
        i: {tuple(w[k : k + min(n, len(w))]) for k in range(len(w) - min(n, len(w)) + 1)} for i,
        t in docs if (w := (t or "").lower().split())
    }
    parent = {i: i for i, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def test_jaccard_blocks(spark):
    """A group larger than a block, and lists cut into parts: near copies of one text."""
    base = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(f"x{i}" if k == i % 50 else w for k, w in enumerate(base))) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute_components(docs, 4, 85)
    for block, bits in ((4096, 14), (5, 14), (4096, 2), (5, 2)):
        got = {r.doc_id: r.component_id for r in jaccard.similar_components(df, block=block, list_bits=bits).collect()}
        assert got == want


def test_jaccard_random_families(spark):
    """Families of texts at all distances, shared passages, copies, and texts of other lengths."""
    import random

    pick = random.Random(3)
    passage = [f"p{i}" for i in range(30)]
    docs = []
    for f in range(12):
        base = [f"f{f}w{pick.randrange(400)}" for _ in range(pick.choice([6, 40, 150]))]
        for _ in range(12):
            w = [
                pick.choice(
                    [x, x, f"new{pick.randrange(10**6)}"]
                ) if pick.random() < pick.choice([0.0, 0.02, 0.1]) else x for x in base
            ]
            if pick.random() < 0.4:
                at = pick.randrange(len(w))
                w[at:at] = passage
            docs.append((len(docs), " ".join(w[: pick.choice([len(w), len(w) - 3])])))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for n, percent, block, bits in ((4, 85, 2048, 14), (5, 80, 6, 2)):
        got = {
            r.doc_id: r.component_id for r in jaccard.similar_components(
                df, n=n, percent=percent, block=block, list_bits=bits
            ).collect()
        }
        assert got == brute_components(docs, n, percent)


def test_jaccard_suffix_filter():
    """The bound of the suffix filter is never below the overlap, also where a part is full."""
    import numpy as np

    rng = np.random.default_rng(1)
    for high in (256, 3):
        for _ in range(30):
            pool = (
                rng.integers(0, high, 3000).astype(np.uint64) << np.uint64(56)
            ) | rng.integers(0, 2**50, 3000).astype(np.uint64)
            a, b = (np.unique(rng.choice(pool, rng.integers(50, 2500))) for _ in range(2))
            shared = len(np.intersect1d(a, b))
            bins = [jaccard._bins(x) for x in (a, b)]
            assert jaccard._may_overlap(*bins, np.int64(shared), len(a), len(b))
            assert not jaccard._may_overlap(*bins, np.int64(min(len(a), len(b)) + 1), len(a), len(b))


def test_packing(spark):
    rows = [(i, "w " * n, f"s{i % 3}") for i, n in enumerate([5, 3, 9, 1, 1, 7, 25, 0, 4, 4])]
    docs = spark.createDataFrame([*rows, (99, None, None)], "doc_id long, text string, source string")
    out = packing.pack(
        docs, F.size(F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda x: x != "")), 10, shard_rows=1000
    ).collect()
    want = {i: len(t.split()) for i, t, _ in rows} | {99: 0}
    total, bins, source = {}, {}, {i: s for i, _, s in rows}
    for r in out:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
        bins.setdefault(r.bin, []).append(r)
    assert total == want
    for members in bins.values():
        spans = sorted((r.start, r.start + r.length) for r in members)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] <= 10
        named = [source[r.doc_id] for r in members if r.doc_id in source]
        assert len(named) == len(set(named))
    assert packing.pack(empty(spark), F.lit(1), 5).count() == 0


def test_best_fit_is_tightest():
    bins = packing.Bins(10)
    places = [bins.place(n, s, None)[0] for n, s in [(6, "a"), (7, "a"), (3, "b"), (4, "c"), (3, "b")]]
    assert places == [0, 1, 1, 0, 2]


def test_tokens(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    out = tokens.count_tokens(edge(spark), path).collect()
    t = Tokenizer.from_file(path)
    assert all(r.n_tokens == len(t.encode(r.text or "", add_special_tokens=False)) for r in out)
    odd = ["a  b", " x ", "a\n b", "<|endoftext|> hi<|endoftext|>", "é ü  x", "don't 12 3"]
    assert tokens.lengths(odd, path) == [len(t.encode(x, add_special_tokens=False)) for x in odd]


def test_language(spark):
    rows = [
        (
            i, ("the cat and the dog " if i % 2 else "le chat et le chien ") * (1 + i % 4), "en" if i % 2 else "fr"
        ) for i in range(40)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    out = language.identify(edge(spark), model).collect()
    assert {r.lang_pred for r in out if r.doc_id in (1, 2, 3)} == {"und"}
    seen = language.identify(docs, model)
    assert seen.filter("lang = lang_pred").count() == 40
    assert language.identify(docs, language.fit(empty(spark))).filter("lang_pred = 'und'").count() == 40
    assert language.codewords(9).shape[0] == 9 and len({tuple(x) for x in language.codewords(9)}) == 9


def test_toxicity(spark):
    toxic = [(i, f"Fine start {i}. What an idiot you are. Good end {i}.", 1) for i in range(30)]
    clean = [(100 + i, f"Fine start {i}. What a day you have. Good end {i}.", 0) for i in range(90)]
    docs = spark.createDataFrame([*toxic, *clean, (999, "no label", None)], "doc_id long, text string, toxic int")
    model = toxicity.fit(docs)
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(out[i].toxicity >= 0.3 for i, _, _ in toxic) and all(out[i].toxicity < 0.3 for i, _, _ in clean)
    s = out[0].toxic_sentences
    assert [toxic[0][1][x.start : x.end].strip() for x in s] == ["What an idiot you are"]
    assert toxicity.score(edge(spark), model).count() == len(EDGE)
    assert toxicity.fit(docs.filter("toxic IS NULL")).weights == {}


def test_licenses(spark):
    mit, bsd, apache = (licenses.TEMPLATES[k][1] for k in ("mit", "bsd-3-clause", "apache-2.0"))
    changed = bsd.replace("the copyright holder", "Example Labs Incorporated")
    texts = [
        ("Text.\nreleased under THE mit license\nmore", ["mit"]),
        ("Licensed under CC BY-NC 4.0.", ["cc-by-nc-4.0"]),
        ("no licence at all", []),
        ("Licensed under the\nApache License, Version 2.0.", ["apache-2.0"]),
        (None, []),
        ("", []),
        ("word", []),
        (
            "Before it. This work is licensed under a Creative Commons\n * Attribution 4.0 International License. And then more text follows.",
            ["cc-by-4.0"]
        ),
        ("Some tool. Released under the MIT License. See the site.", ["mit"]),
        ("code " * 2000 + mit + " more code" * 2000, ["mit"]),
        ("/* " + changed.replace("        ", " * ") + " */ int main", ["bsd-3-clause"]),
        ("# " + apache + " #", ["apache-2.0"]),
        ("Permission is hereby granted, free of charge, to nobody at all in this software licence text.", []),
    ]
    docs = spark.createDataFrame(
        [(i, t, 1) for i, (t, _) in enumerate(texts)] + [(1, texts[1][0], 1)], "doc_id long, text string, licenses int"
    )
    rows = licenses.scan(docs, into="licenses_").collect()
    assert all([m.name for m in r.licenses_] == texts[r.doc_id][1] for r in rows) and len(rows) == len(texts) + 1
    assert licenses.scan(edge(spark)).filter("size(licenses) > 0").count() == 0
    assert licenses.scan(empty(spark)).count() == 0
    # the anchors are in every text that reaches the threshold
    import re

    every = [g for v in licenses.TEMPLATES.values() for _, g in map(licenses.template_bigrams, v)]
    pattern = re.compile("|".join(licenses.anchors(every, 0.9)).replace("\\p{L}\\p{N}", "a-z0-9"))
    for g in every:
        without = [x for x in g if not pattern.search(x)]
        assert len(without) < licenses.fewest(g, 0.9)


def test_language_model(spark):
    docs = spark.createDataFrame(
        [(1, "A b a b c"), (2, "a B"), (3, None), (4, "c c c c a"), (4, "c c c c a")], "doc_id long, text string"
    )
    model = kneser_ney.train(docs)
    out = {r.doc_id: r for r in kneser_ney.score(docs, model).collect()}
    assert kneser_ney.info(model)["tokens"] == 5 + 2 + 5 + 5 + 5 and kneser_ney.info(model)["vocabulary"] == 4
    assert out[3].n_tokens == 1 and out[1].n_known == 6
    none = kneser_ney.train(docs.limit(0))
    assert kneser_ney.score(edge(spark), none).count() == len(EDGE)


def test_trigram_ranges():
    """Keys of ranges against plain order, with more bigrams and words than a 64-bit product holds."""
    import random

    import numpy as np

    rng = random.Random(3)
    for n_words, start in ((2**32 - 2, 2**40), (7, 0)):
        place = lambda: start + rng.randrange(40)
        bounds = sorted({(0, 0)} | {(place(), rng.randrange(n_words)) for _ in range(12)})
        if start:  # a range holds fewer than 2**32 bigrams
            bounds = sorted({*bounds, (start - 1, 0)})
        asked = [*((place(), rng.randrange(n_words)) for _ in range(500)), *bounds[2:]]
        ranges = kneser_ney.TrigramRanges(np.array(bounds, np.int64), n_words)
        places, words = np.array(asked, np.int64).T
        s, keys = ranges.keys(places, words)
        assert s.tolist() == [sum(b <= x for b in bounds) - 1 for x in asked]
        rank = sorted(range(len(asked)), key=lambda i: (s[i], keys[i]))
        assert [asked[i] for i in rank] == sorted(asked)
        for r, at, part in ranges.cut(places, words):
            back = ranges.trigrams(r, part)
            assert [(int(a), int(b)) for a, b in zip(*back, strict=True)] == [asked[i] for i in at]


def brute_kneser_ney(train):
    """(chance of a word after up to two words, all words) at order 3, from dictionaries."""
    split = lambda t: ["<s>", *(t or "").lower().split(), "</s>"]
    tri, raw = {}, {}
    for t in train:
        w = split(t)
        for i in range(1, len(w)):
            raw[w[i - 1], w[i]] = raw.get((w[i - 1], w[i]), 0) + 1
            if i > 1:
                tri[w[i - 2], w[i - 1], w[i]] = tri.get((w[i - 2], w[i - 1], w[i]), 0) + 1
    two = {g: n if g[0] == "<s>" else len({x for x in tri if x[1:] == g}) for g, n in raw.items()}
    one = {w: len({g for g in raw if g[1] == w}) for _, w in raw}
    d = [kneser_ney._discounts([sum(c == k for c in t.values()) for k in (1, 2, 3, 4)]) for t in (one, two, tri)]
    cut = lambda d, c: d[min(c, 3) - 1] if c else 0
    types = sum(one.values())
    rest = sum(cut(d[0], c) for c in one.values()) / types

    def chance(h, w):
        if not h:
            return max(one.get(w, 0) - cut(d[0], one.get(w, 0)), 0) / types + rest / (len(one) + 1)
        table, dd = (tri, d[2]) if len(h) == 2 else (two, d[1])
        follow = [c for g, c in table.items() if g[:-1] == h]
        if not follow:
            return chance(h[1:], w)
        c = table.get((*h, w), 0)
        return (max(c - cut(dd, c), 0) + sum(cut(dd, x) for x in follow) * chance(h[1:], w)) / sum(follow)

    return chance, set(one)


def brute_score(chance, text):
    from math import log10

    w = ["<s>", *(text or "").lower().split(), "</s>"]
    return sum(log10(chance(tuple(w[max(0, i - 2) : i]), w[i])) for i in range(1, len(w)))


def test_language_model_order_3(spark, monkeypatch):
    import random

    pick = random.Random(5)
    texts = [
        " ".join(pick.choices("abcdefgh", weights=[9, 7, 5, 3, 2, 1, 1, 1], k=pick.randrange(12))) for _ in range(60)
    ]
    texts += [None, "", *texts[:5], "x y a b c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    probe = [*texts[:20], None, "a b zzz c a", "h g f e d c", "x y a b c d", "zzz"]
    asked = spark.createDataFrame(list(enumerate(probe)), "doc_id long, text string")
    chance, vocabulary = brute_kneser_ney(texts)
    for h in [(), ("a",), ("<s>",), ("a", "b"), ("<s>", "a"), ("x", "y"), ("zzz", "a")]:  # all chances sum to 1, an unknown word included
        assert abs(sum(chance(h, w) for w in [*vocabulary, "zzz"]) - 1) < 1e-9
    for size, most in ((2_000_000, 100), (20, 1000), (20, 4)):  # the second cuts contexts over shards, the third widens shards
        monkeypatch.setattr(kneser_ney, "SHARD_TOKENS", size)
        monkeypatch.setattr(kneser_ney, "MAX_SHARDS", most)
        out = kneser_ney.score(asked, kneser_ney.train(docs)).collect()
        for r in out:
            assert abs(r.score - brute_score(chance, r.text)) < 1e-5
    two = {r.doc_id: r.score for r in kneser_ney.score(asked, kneser_ney.train(docs, order=2)).collect()}
    assert any(abs(two[r.doc_id] - r.score) > 0.01 for r in out)
    # nulls, empty and very long texts and repeated rows in the training table, clashing columns in the other
    model = kneser_ney.train(edge(spark))
    clash = {r.doc_id: r for r in kneser_ney.score(edge(spark), model).collect()}
    chance, _ = brute_kneser_ney([t for _, t in EDGE])
    for i, t in EDGE:
        assert clash[i].asDict()["score"] == 7 and abs(
            clash[i]["_score"] - brute_score(chance, t)
        ) < 1e-3 * max(1, abs(clash[i]["_score"]))
    assert kneser_ney.score(empty(spark), model).count() == 0


def test_language_model_many_texts(spark, monkeypatch):
    """The files of a model are searched once for many texts, and rows keep their order."""
    import random

    import pyarrow as pa

    pick = random.Random(9)
    texts = [" ".join(f"w{pick.randrange(400)}" for _ in range(pick.randrange(400))) for _ in range(1100)]
    texts[3:3], texts[600:600] = [None, ""], ["", "w1 " * 30000, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(kneser_ney, "SHARD_TOKENS", 20000)
    uri = kneser_ney.train(docs.filter("doc_id % 3 > 0"))
    rows = kneser_ney.score(docs, uri).collect()  # three Arrow batches
    assert all(r.n_tokens == len((r.text or "").split()) + 1 and r.text == texts[r.doc_id] for r in rows)

    model, looked = kneser_ney._opened(uri), []
    find = kneser_ney.Shards.find
    monkeypatch.setattr(
        kneser_ney.Shards, "find", lambda self, s, keys: looked.append((self.name, s)) or find(self, s, keys)
    )
    arrays = [pa.array(texts[i : i + 100], pa.string()) for i in range(0, len(texts), 100)]

    def scored():
        looked.clear()
        parts = [*kneser_ney._scored((x.fill_null("") for x in arrays), model)]
        return [tuple(x[i] for x in p) for p in parts for i in range(len(p[0]))]

    once = scored()
    assert len(looked) == len(set(looked)) > 8
    assert [(x[0], x[3]) for x in once] == [(r.n_tokens, r.score) for r in sorted(rows, key=lambda r: r.doc_id)]
    monkeypatch.setattr(kneser_ney, "TOGETHER", 1000)
    assert scored() == once and len(looked) > 2 * len(set(looked))  # 300 tokens a file
    monkeypatch.setattr(kneser_ney, "MOST", 1)
    assert scored() == once


def test_split_keys(tmp_path):
    import numpy as np

    keys = np.unique(np.random.default_rng(2).integers(0, 2**36, 3000).astype(np.uint64))
    store = kneser_ney.Folder(f"file://{tmp_path}")
    kneser_ney._save_split(store, "k", 0, keys)
    asked = np.unique(np.concatenate((keys[::7], keys[::5] + np.uint64(1), np.array([0, 2**63], np.uint64))))
    want = np.array([int(np.searchsorted(keys, x)) if x in keys else -1 for x in asked])
    assert (kneser_ney.SplitShards(store.uri, "k", [0]).find(0, asked) == want).all()


def test_packing_near_copies(spark, tmp_path):
    base = [f"word{i}" for i in range(60)]
    near = [
        " ".join([*base[:i], f"other{i}", *base[i + 1 :]]) for i in (5, 20, 40)
    ] + [" ".join(base), "  ".join(base), " ".join(base)]
    rows = [(i, t, f"s{i}" if i % 2 else None) for i, t in enumerate(near)] + [
        (10, "quite another short text", "x"), (11, None, "y"), (12, None, "z"),
        (3, "a text with an id of another", "w")
    ]
    spark.createDataFrame(
        rows, "doc_id long, text string, source string"
    ).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op3_best_fit_packing(spark, str(tmp_path)).collect()
    assert len(out) == len(rows)
    copies = [r.bin for r in out if r.length == 60]
    assert len(copies) == len(near) == len(set(copies))
    blank = [r.bin for r in out if r.doc_id in (11, 12)]
    assert blank[0] == blank[1]


def test_toxicity_brute_force(spark):
    """Scores are the noisy-or of the sentences, repeats included, and learning takes the same product."""
    import math
    import re

    model = toxicity.ToxicityModel({"bad": 6.0, "épouvantail": 9.0}, 0.01)
    text = "A bad day. Fine! " * 3 + "Épouvantail here\nnothing. BAD bad épouvantail"
    p = lambda z: 1 / (1 + math.exp(-z))
    rest = 0.99
    for s in re.split(r"[.!?\n]+", text):
        cues = {w for w in re.findall(r"[^\W_]+", s.lower()) if w in model.weights}
        rest *= 1 - p(model.base + sum(model.weights[w] for w in cues)) if cues else 1
    docs = spark.createDataFrame([(1, text, "x"), (2, None, "y")], "doc_id long, text string, toxicity string")
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert abs(
        out[1]["_toxicity"] - (1 - rest)
    ) < 1e-12 and out[1].toxicity == "x" and abs(out[2]["_toxicity"] - 0.01) < 1e-12
    # a weak cue that clean texts repeat is learned as weak
    rows = [
        (i, "Épouvantail là. " + "mild word. " * 30, 1) for i in range(20)
    ] + [(50 + i, "mild word. " * 30, 0) for i in range(60)]
    learned = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert "épouvantail" in learned.weights
    scored = toxicity.score(
        spark.createDataFrame([(1, "mild word. " * 200), (2, "Un Épouvantail")], "doc_id long, text string"), learned
    )
    got = {r.doc_id: r.toxicity for r in scored.collect()}
    assert got[1] < 0.3 <= got[2]
    assert toxicity.score(empty(spark), learned).count() == 0


def test_language_decoding(spark):
    import numpy as np

    codes = language.codewords(3)
    model = language.LanguageModel(
        ["a", "b", "c"], codes, np.eye(3, dtype=np.float32),
        language.bit_trust(np.array([[9, 9, 1], [9, 9, 9], [5, 9, 9]]), np.array([10, 10, 10])), 2.0
    )
    counts = np.array([[3.0, 1, 0], [0, 0, 0], [1, 1, 2]])
    best, score, second = model.predict(counts)
    for row, b, s, two in zip(counts, best, score, second, strict=True):
        margin = 2.0 * row / max(row.sum(), 1)
        loss = [
            sum(w * np.log1p(np.exp(-m * c)) for m, c, w in zip(margin, code, t, strict=True)) for code,
            t in zip(model.codes, model.trust, strict=True)
        ]
        share = sorted((float(np.exp(-x)) / sum(np.exp(-y) for y in loss) for x in loss), reverse=True)
        assert b == int(np.argmin(loss)) and abs(s - share[0]) < 1e-9 and abs(two - share[1]) < 1e-9
    assert np.allclose(model.trust.mean(axis=1), 1) and model.trust[0, 2] < model.trust[0, 0]
    many = language.codewords(20)
    columns = {tuple(c * c[0]) for c in many.T}
    assert len(columns) == many.shape[1]
    assert min((many[i] != many[j]).sum() for i in range(20) for j in range(i)) >= many.shape[1] // 4
    rows = [(1, "ab ab ab", "x"), (2, "ab ab ab", "y")]  # two languages that say the same
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = language.identify(docs, language.fit(docs)).collect()
    assert all(r.lang_ambiguous and r.lang_pred == "x" and abs(r.lang_score - 0.5) < 1e-6 for r in out)


def test_token_groups():
    assert list(tokens.byte_groups(["aa", "é", "b", "cc"], 4)) == [["aa", "é"], ["b", "cc"]]


def test_tokens_long_parts(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    odd = ["x" * 5000 + "  y " + "z1 " * 3000, "tab\t and  spaces \n\n here  now", "   ", "a  b  c", "ü" * 70 + " ü"]
    assert tokens.lengths(odd, path, max_bytes=64) == [len(t.encode(x, add_special_tokens=False)) for x in odd]
    assert not any(len(x) > tokens.PART_CHARS for x in tokens._tokenizer(path)[1])
    assert tokens.count_tokens(empty(spark), path).count() == 0


def test_tightest_compatible_bin_by_scan():
    """Every place is the one that a scan over all bins finds: the fullest that has room and neither
    the text's source nor its cluster; a new one if there is none."""
    import random

    for seed in range(6):
        pick = random.Random(seed)
        bins, scanned = packing.Bins(100), []
        texts = [
            (pick.randrange(0, 101), pick.choice([None, "a", "b", "c", "d"]), pick.choice([None, *range(8)])) for _ in range(300)
        ]
        texts += [(pick.randrange(1, 20), "hot", None) for _ in range(100)]  # one source with a quarter of all rows
        for length, source, cluster in sorted(texts, key=lambda t: -t[0]) if seed % 2 else texts:
            fits = [
                (100 - b["used"], i) for i, b in enumerate(scanned) if 100 - b["used"] >= length and (
                    source is None or source not in b["sources"]
                ) and (cluster is None or cluster not in b["clusters"])
            ]
            b, start = bins.place(length, source, cluster)
            if fits:
                assert (100 - scanned[b]["used"], b) == min(fits)
            else:
                assert b == len(scanned)
                scanned.append({"used": 0, "sources": set(), "clusters": set()})
            assert start == scanned[b]["used"]
            scanned[b]["used"] += length
            scanned[b]["sources"] |= {source} - {None}
            scanned[b]["clusters"] |= {cluster} - {None}


def test_packing_conflicts_with_clashing_names(spark, monkeypatch):
    """Sources beside null sources, clusters beside null clusters, few tasks for many shards."""
    monkeypatch.setattr(packing, "FEW_TASKS", 2)
    rows = [(i, f"w{i % 40} x", None if i % 3 == 0 else f"s{i % 5}", i % 7 * 10, 1, "x", 2) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long, bin int, shard string, rest int")
    for cluster in (None, F.when(F.col("doc_id") % 2 == 0, F.col("doc_id") % 11)):
        out = packing.pack(docs, F.col("size"), 100, cluster=cluster, shard_rows=50).collect()
        assert sorted(r.doc_id for r in out) == list(range(400))
        held = {}
        for r in out:
            held.setdefault(r.bin, []).append(r)
        assert len({r.bin.split("-")[0] for r in out}) == 8
        for parts in held.values():
            assert sum(r.length for r in parts) <= 100
            sources = [rows[r.doc_id][2] for r in parts if rows[r.doc_id][2]]
            assert len(sources) == len(set(sources))
            clusters = [r.doc_id % 11 for r in parts if r.doc_id % 2 == 0] if cluster is not None else [rows[r.doc_id][1] for r in parts]
            assert len(clusters) == len(set(clusters))


def test_decontaminate_ids(spark):
    """Items without an id mark words but are not listed, an id that repeats counts once, ties are all listed."""
    words = [f"w{i}" for i in range(30)]
    docs = spark.createDataFrame([(1, " ".join(words), "x"), (None, " ".join(words[5:25]), "y"), (3, "none", "z")], "doc_id long, text string, hit string")
    items = [(None, " ".join(words[0:12])), (7, " ".join(words[10:22])), (7, " ".join(words[18:29])), (8, " ".join(words[10:22])), (9, None)]
    for limit in (50_000, 0):
        out = decontaminate.find(docs, spark.createDataFrame(items, "item_id long, text string"), n=10, into="hit", max_windows=limit)
        assert out.columns == ["doc_id", "text", "hit", "_hit"]
        found = {r.doc_id: r["_hit"] for r in out.collect()}
        assert found[1]["items"] == ["7", "8"] and found[None]["items"] == ["7", "8"] and found[3]["items"] == []
        starts = {s.i for s in found[1]["starts"]}
        assert starts == {0, 1, 2, 10, 11, 12, 18, 19}


def test_jaccard_null_ids(spark):
    """Rows without an id take the component of what they link with; alone they have none."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (5, text), (None, text + " more"), (None, "quite another text of its own here"), (2, "short"), (2, "short")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, node int")
    found = jaccard.similar_components(docs, n=4, percent=85).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in found) == [
        (False, 2, 1, 2), (False, 2, 1, 2), (False, 5, 37, 5), (True, 0, 4, 0), (True, 0, 37, 5), (True, 0, 38, 5)
    ]


def test_language_of_two_halves(spark):
    """A text of two languages in equal parts is less sure than one of either, and the most doubtful are flagged."""
    train = [(i, " ".join(f"{a}{b}{a}o" for a in "kst" for b in "aei"), "x") for i in range(5)]
    train += [(10 + i, " ".join(f"u{a}{b}m" for a in "gbd" for b in "lrw"), "y") for i in range(5)]
    docs = spark.createDataFrame(train, "doc_id long, text string, lang string")
    model = language.fit(docs)
    halves = spark.createDataFrame([(1, train[0][1]), (2, train[5][1]), (3, train[0][1] + " " + train[5][1])], "doc_id long, text string")
    found = {r.doc_id: r for r in language.identify(halves, model).collect()}
    assert (found[1].lang_pred, found[2].lang_pred) == ("x", "y")
    assert not found[1].lang_ambiguous and not found[2].lang_ambiguous
    assert found[3].lang_score < min(found[1].lang_score, found[2].lang_score)
    most = language.identify(halves, model, ambiguous=0.0).collect()
    assert all(r.lang_ambiguous for r in most)


def test_added_columns_take_free_names(spark):
    """Columns named like the added one, in any case, keep their names and values."""
    docs = spark.createDataFrame([(1, "a text of some words", "m", "S", 3, 4)], "doc_id long, text string, measures string, Spans string, hit int, licenses int")
    items = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    for out, name in (
        (quality.measures(docs), "_measures"), (pii.find(docs), "_spans"), (decontaminate.find(docs, items), "_hit"), (licenses.scan(docs), "_licenses")
    ):
        assert out.columns == [*docs.columns, name]
        assert tuple(out.first())[:6] == (1, "a text of some words", "m", "S", 3, 4)


def test_words_and_sets_of_many_texts():
    """Words end where their text ends; sets of many texts are those of each alone."""
    import random

    import numpy as np
    import pyarrow as pa

    from taxoweave.llm import hashing

    rng = random.Random(4)
    texts = [
        "".join(rng.choice("aB é\t\nxy ") for _ in range(rng.randrange(50))) if rng.random() > 0.2 else rng.choice([None, ""])
        for _ in range(300)
    ]

    def each(values):
        for lo, hi, words, off in hashing.word_hashes(pa.array(values, pa.string())):
            sets, at = hashing.shingle_sets(words, off, 3)
            for i in range(hi - lo):
                yield words[off[i] : off[i + 1]].tolist(), sets[at[i] : at[i + 1]].tolist()

    together = list(each(texts))
    assert together == [pair for t in texts for pair in each([t])]
    for t, (words, found) in zip(texts, together, strict=True):
        assert len(words) == len((t or "").split())
        assert found == np.unique(hashing.shingles(np.array(words, np.uint64), 3)).tolist()


def test_jaccard_shared_rows(spark, monkeypatch):
    """Of short lists only rows that pass the length and the positional filter with another node stay."""
    import random

    monkeypatch.setattr(jaccard, "ROWS", 7)
    rng, rows = random.Random(9), []
    for h in range(300):
        cut = 1 if h % 50 == 0 else 0
        for _ in range(rng.choice([1, 2, 2, 2, 3, 5, jaccard.SHORT, jaccard.SHORT + 4])):
            size = rng.randrange(50, 90)
            row = (h, rng.randrange(10**6), size, rng.randrange(jaccard._prefix(size, 80)), cut)
            rows += [row] * rng.choice([1, 1, 2])
    schema = "h long, node long, size int, pos int, cut int"
    got = sorted(tuple(r) for r in jaccard._shared(spark.createDataFrame(rows, schema), 80).collect())
    lists = {}
    for r in set(rows):
        lists.setdefault(r[0], []).append(r)
    want = []
    for members in lists.values():
        for x in members:
            others = [y for y in members if y != x]
            long = [y for y in others if 100 * min(x[2], y[2]) >= 80 * max(x[2], y[2])]
            near = [y for y in long if 180 * (1 + min(x[2] - x[3] - 1, y[2] - y[3] - 1)) >= 80 * (x[2] + y[2])]
            if x[4] or (near if len(members) <= jaccard.SHORT else long):
                want.append(x)
    assert got == sorted(want)


def test_packing_reads_texts_once_for_the_join(spark, tmp_path):
    """Words are counted by the join that finds the near copies; the texts are not split again."""
    from taxoweave.llm.shared import words

    texts = ["  one\ttwo  three ", "", None, "\u00a0 four", "\x0b\n", "five six seven eight nine ten", None, "one two three"]
    rows = [(i, t, f"s{i}" if i % 2 else None) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = queries.documents(spark, str(tmp_path))
    found = queries.clustered(docs)
    assert not [f for f in found.inputFiles() if "documents.parquet" in f]
    got = {r.doc_id: (r.source, r.n_words, r.cluster is None) for r in found.collect()}
    counts = {r.doc_id: r.n for r in docs.select("doc_id", F.size(words(F.col("text"))).alias("n")).collect()}
    assert got == {i: (s, counts[i], t is None) for i, t, s in rows}
