"""The registered corpus queries on the smallest tables: SQL, contracts and held-out figures."""

import hashlib
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from taxoweave.llm import quality
from taxoweave.llm import queries as Q
from tests.test_oracle import table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    r = duck.execute(Q.oracle_sql()[name])
    df = Q.queries()[name](spark, SF)
    assert table(df.columns, [tuple(x) for x in df.collect()]) == table([x[0] for x in r.description], r.fetchall())


def test_op7_held_out(spark):
    docs = Q.documents(spark, SF).select("doc_id", "lang")
    rows = Q.op7_language_id(spark, SF).join(docs, "doc_id").filter("held_out").collect()
    assert rows and all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95



#: The contract's patterns, tried as they are.
BASE_KINDS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
}


def brute_base(text):
    """(start, place of the kind, kind, end) of all valid base spans."""
    def valid(kind, m):
        d = re.sub(r"[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
            return 14 <= len(d) <= 19 and sum(x - 9 * (x > 9) for x in doubled) % 10 == 0
        return kind == "email" or 10 <= len(d) <= 15

    return sorted(
        (m.start(), i, kind, m.end()) for i, (kind, p) in enumerate(BASE_KINDS.items()) for m in p.finditer(text) if valid(kind, m[0])
    )


def test_op5_base(spark):
    texts = {r.doc_id: r.text or "" for r in Q.documents(spark, SF).collect()}
    seen = 0
    for r in Q.op5_pii_sanitisation(spark, SF).collect():
        want = brute_base(texts[r.doc_id])
        for kind in BASE_KINDS:
            assert r[f"n_{kind}"] == sum(k == kind for _, _, k, _ in want)
        said = ",".join(f"{k}:{a}:{b}" for a, _, k, b in want)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert set(said.split(",")) - {""} <= set(r.spans.split(","))
        seen += len(want)
    assert seen > 5


def test_pipeline(spark):
    docs = Q.documents(spark, SF)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert 0 < docs.count() <= Q.documents(spark, SF).count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert packed.groupBy("bin").agg(F.sum("length").alias("n")).filter(
        F.col("n") > corpus_pipeline.BIN_WORDS
    ).count() == 0


def test_pipeline_edges(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    good = "The quick brown fox and the lazy dog went to the market of a town. " + " ".join(
        f"word{i}" for i in range(120)
    )
    odd = spark.createDataFrame(
        [
            (1, good, "en", "s", len(good)), (1, good, "en", "s", len(good)),
            (1, "another text of the same id", "en", "s", 27), (2, None, None, None, None), (3, "", "en", "s", 0),
            (4, good + " more", "en", "t", 0), (None, good + " x", "en", "t", 0)
        ],
        schema
    )
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SF).count() >= 0
    kept = corpus_pipeline.near_duplicates(spark, odd, SF).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == sorted(
        [(1, good), (1, "another text of the same id"), (2, ""), (3, "")]
    )


def brute_quality(rows):
    """Posteriors by expectation-maximisation over votes, in plain Python."""
    import math

    def votes(text):
        body = text or ""
        w = [x for x in re.split(r"[ \t\n\x0b\x0c\r]+", body) if x]
        n, chars = len(w), sum(map(len, w))
        wins = [tuple(w[i : i + 3]) for i in range(n - 2)]
        repeat = len({i + k for i, x in enumerate(wins) if wins.count(x) > 1 for k in range(3)})
        lines = [x for x in body.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        dup, upper = len(lines) - len(set(lines)), sum("A" <= c <= "Z" for c in body)
        symbols, bangs = sum(c in quality.SYMBOLS for c in body), body.count("!")
        stops = len(set(w) & set(quality.STOP_WORDS))
        vote = lambda bad, good: 0 if bad else 1 if good else 2
        found = [
            vote(n < 50, n >= 100), vote(
                chars < 3 * n or chars > 14 * n, 4 * n <= chars <= 10 * n
            ), vote(symbols * 10 > n, symbols * 50 <= n), vote(upper * 3 > chars, upper * 8 <= chars),
            vote(dup * 10 > len(lines) * 3, dup == 0), vote(
                repeat * 10 > n * 3, repeat * 10 <= n
            ), vote(bangs * 10 > n, bangs * 100 <= n), vote(stops == 0 and n >= 50, stops >= 2),
        ]
        return found, n < 50 or 100 * repeat > 50 * n, (n, chars, symbols, dup, repeat)

    seen = [votes(t) for t in rows]
    prior, rates = 0.8, [quality.START] * 8
    good_of = lambda v: 1 / (
        1 + math.exp(
            -(math.log(prior / (1 - prior)) + sum(math.log(r[1][x] / r[0][x]) for r, x in zip(rates, v, strict=True)))
        )
    )
    for _ in range(50):
        post = [good_of(v) for v, _, _ in seen]
        total = [sum(1 - p for p in post) + 4.0, sum(post) + 16.0]
        sums = [[[20.0 * x for x in y] for y in quality.START] for _ in range(8)]
        for p, (v, _, _) in zip(post, seen, strict=True):
            for s, x in zip(sums, v, strict=True):
                s[0][x] += 1 - p
                s[1][x] += p
        prior, rates = total[1] / sum(total), [tuple(tuple(x / sum(y) for x in y) for y in s) for s in sums]
    return [(good_of(v), failed, m) for v, failed, m in seen]


def test_op4_brute_force(spark):
    docs = {r.doc_id: r.text for r in Q.documents(spark, SF).collect()}
    want = dict(zip(docs, brute_quality(docs.values()), strict=True))
    for r in Q.op4_quality_rules(spark, SF).collect():
        p, failed, m = want[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m
        assert abs(r.posterior - p) < 1e-6 and r.base_failed == failed and r.kept == (not failed and p >= 0.5)


def test_pipeline_brute_force(spark):
    """What stays after the first three stages, from dictionaries and all pairs."""
    from tests.llm.test_planted import brute_components

    docs = {r.doc_id: r.text for r in Q.documents(spark, SF).collect()}
    kept = {
        i: t for (i, t),
        (p, failed, _) in zip(docs.items(), brute_quality(docs.values()), strict=True) if not failed and p >= 0.5
    }
    groups = brute_components([(i, re.sub("[A-Z]+", lambda m: m[0].lower(), t)) for i, t in kept.items()], 5, 80)
    kept = {i: t for i, t in kept.items() if groups[i] == i}
    split = lambda t: [
        x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x
    ]
    wins = {
        tuple(
            w[i : i + min(10, len(w))]
        ) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if (w := split(r.text)) for i in range(
            len(w) - min(10, len(w)) + 1
        )
    }
    sizes = {len(w) for w in wins}
    dirty = lambda w: any(tuple(w[i : i + k]) in wins for k in sizes for i in range(len(w) - k + 1))
    kept = {i for i, t in kept.items() if not dirty(split(t))}
    out = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in out.collect()} == kept and kept


def test_pipeline_with_clashing_names(spark):
    """Columns named like those that stages add keep their names and values, and come out of every stage but the last."""
    docs = Q.documents(spark, SF).limit(60)
    for name in ("measures", "spans", "hit", "quality", "node", "component", "text_key", "shard", "rest"):
        docs = docs.withColumn(name, F.concat(F.lit(name), "doc_id"))
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert all(r.spans == f"spans{r.doc_id}" and r.node == f"node{r.doc_id}" for r in docs.collect()), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).select("doc_id").distinct().count() == docs.count() > 0
