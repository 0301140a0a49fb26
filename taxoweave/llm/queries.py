"""One query opN_<name> for each corpus operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    classifier, decontaminate, jaccard, kneser_ney, language, lexical, licenses, packing, pii, quality, tokens, toxicity,
    whitening
)
from .shared import documents as all_columns
from .shared import written

#: Production parameters of packing: bins of so many words.
BIN_WORDS = 2048
#: Label rows up to which the labels are broadcast.
LABEL_ROWS = 1_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with the columns that the queries use, so no other column can clash with theirs."""
    docs = all_columns(spark, sf_dir)
    return docs.select(*(c for c in docs.columns if c in ("doc_id", "text", "lang", "source", "n_chars")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = written(quality.measures(documents(spark, sf_dir)).select("doc_id", "measures"), "quality")
    scored = quality.score(m, quality.fit(m))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    failed = quality.base_failed(F.col("measures"))
    return scored.select(
        "doc_id", *(F.col(f"measures.{c}") for c in counts), failed.alias("base_failed"),
        (~failed & (F.col("quality") >= 0.5)).alias("kept"), F.col("quality").alias("posterior")
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").filter(remainder(4) != 2)
    few = labels.count() <= LABEL_ROWS  # 16 bytes each
    model = toxicity.fit(docs.join(F.broadcast(labels) if few else labels, "doc_id").select("text", "toxic"))
    out = toxicity.score(docs, model)
    return out.select(
        "doc_id", (remainder(4) == 2).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.3).cast("int").alias("predicted"),
        F.size("toxic_sentences").cast("long").alias("n_toxic_sentences")
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = kneser_ney.train(docs.filter(remainder(7) != 2))
    total = kneser_ney.info(model)["tokens"]
    out = kneser_ney.score(docs, model)
    return out.select(
        "doc_id", (remainder(7) == 2).alias("held_out"), "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return packing.pack(clustered(docs), F.col("n_words"), BIN_WORDS, cluster=F.col("cluster"))


def clustered(docs: DataFrame) -> DataFrame:
    """(doc_id, source, n_words, cluster): `cluster` is equal for texts that near copies (five words, 0.8)
    connect; null for null texts.  The join has the words of every text, so no text is read again."""
    # hashes of texts stand for ids, so repeated and missing ids do no harm
    found = jaccard.similar_components(
        docs.select(
            F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("text_id"), "text",
            F.col("doc_id").alias("id"), "source"
        ),
        n=5, percent=80, doc_id="text_id", carried=("id", "source")
    )
    return found.select(
        F.col("id").alias("doc_id"), "source", "n_words", F.col("component_id").alias("cluster")
    )


def op5_pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"] < len(pii.KINDS))
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")
    return out.select(
        "doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)),
        F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans")
    )


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(
        documents(spark, sf_dir), n=4, percent=85
    ).select("doc_id", "n_shingles", "component_id")


def remainder(n: int):
    """crc32 of doc_id as text, modulo n."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.fit(docs.filter(remainder(3) != 1))
    out = language.identify(docs, model)
    return out.select(
        "doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
        F.col("lang_ambiguous").alias("ambiguous")
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = tokens.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > 1024).alias("over_limit")
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.col("licenses")
    out = licenses.scan(documents(spark, sf_dir))
    return out.select(
        "doc_id", F.size(found).cast("long").alias("n_licenses"),
        F.array_join(F.transform(found, lambda m: m["name"]), ",").alias("licenses"),
        F.round(F.array_max(F.transform(found, lambda m: m["dice"])), 6).alias("best_dice")
    )


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=10)
    hit, n = F.col("hit"), decontaminate.hit_words(F.col("hit"))
    return found.select(
        "doc_id", hit["n_words"].alias("n_words"), n.alias("n_hit"), F.size(hit["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(hit["items"], ","), 256).alias("items_sha256"), (n > 0).alias("contaminated")
    )


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").filter(remainder(3) != 1)
    few = labels.count() <= LABEL_ROWS  # 16 bytes each
    labelled = docs.join(F.broadcast(labels) if few else labels, "doc_id").select("text", "quality")
    out = classifier.score(docs, classifier.fit(classifier.word_vectors(docs), labelled))
    return out.select(
        "doc_id", (remainder(3) == 1).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted")
    )


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=50)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = whitening.points(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    out = whitening.transform(used, whitening.fit(used, k=16))
    return out.withColumn("deviation", F.col("deviation").try_cast("bigint"))  # null where beyond 64 bits


#: DuckDB scores every document for every item.
OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark),
c AS (SELECT count(*) AS n, sum(len(w)) AS l FROM d WHERE len(w) > 0),
t AS (SELECT q, item_id, unnest(w) AS t FROM b),
f AS (SELECT r, doc_id, m, t, count(*) AS tf FROM (SELECT r, doc_id, 50 + (50 * len(w) * n) // CAST(l AS BIGINT) AS m, unnest(w) AS t FROM d, c WHERE len(w) > 0) GROUP BY ALL),
i AS (SELECT t, count(*) AS df FROM f GROUP BY t),
s AS (SELECT q, item_id, r, doc_id, CAST(sum(CAST(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score FROM t JOIN f USING (t) JOIN i USING (t), c GROUP BY q, item_id, r, doc_id)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 50
"""


#: DuckDB says the same windows and hits from positions and joins.
OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS win FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
h AS (SELECT r, i, k, item_id FROM dw JOIN bw USING (k, win)),
hw AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM h) GROUP BY r),
hi AS (SELECT r, count(DISTINCT item_id) AS n, array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids FROM h GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hw.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(hi.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(hw.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)
"""


#: All pairs that share a shingle are compared, and links followed.
OP6_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(reached) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


def _op10_sql(threshold: float = 0.9) -> str:
    """Windows from every place of a template's bigram on, for texts that have enough of its bigrams."""
    made = [(name, *licenses.template_bigrams(t)) for name, v in licenses.TEMPLATES.items() for t in v]
    rows = ", ".join(
        f"({k}, '{name}', {n}, {licenses.fewest(g, threshold)}, [{', '.join(map(repr, g))}])" for k,
        (name, n, g) in enumerate(made)
    )
    return rf"""
WITH t(k, name, size, least, tg) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
w AS (SELECT r, list_filter(string_split_regex(lower(x), '[^\p{{L}}\p{{N}}]+'), lambda v: v <> '') AS w FROM d),
g AS MATERIALIZED (SELECT r, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS g FROM w WHERE len(w) > 1),
c AS (SELECT r, k, name, size, tg, g FROM g, t WHERE len(list_intersect(g, tg)) >= least),
s AS (SELECT r, k, name, size, tg, g, unnest(list_filter(range(1, len(g) + 1), lambda i: list_contains(tg, g[i]))) AS i FROM c),
m AS (SELECT r, name, tg, list_distinct(g[i:i + size - 1]) AS v FROM s),
b AS (SELECT r, name, max(2.0 * len(list_intersect(v, tg)) / (len(v) + len(tg))) AS dice FROM m GROUP BY r, name),
f AS (SELECT r, count(*) AS n, array_to_string(list_sort(list(name)), ',') AS names, round(max(dice), 6) AS best FROM b WHERE dice >= {threshold} GROUP BY r)
SELECT doc_id, coalesce(n, 0) AS n_licenses, coalesce(names, '') AS licenses, CAST(best AS DOUBLE) AS best_dice FROM d LEFT JOIN f USING (r)
"""


def queries() -> dict:
    ops = (
        op1_toxicity, op2_lm_scoring, op3_best_fit_packing, op4_quality_rules, op5_pii_sanitisation,
        op6_ngram_jaccard_join, op7_language_id, op8_token_counts, op9_benchmark_decontamination, op10_license_scan,
        op11_quality_classifier, op12_ranked_lexical_search, op13_embedding_whitening
    )
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return {
        "op6_ngram_jaccard_join": OP6_SQL, "op9_benchmark_decontamination": OP9_SQL, "op10_license_scan": _op10_sql(),
        "op12_ranked_lexical_search": OP12_SQL
    }
