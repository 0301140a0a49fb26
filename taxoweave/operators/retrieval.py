"""Keyword retrieval, candidate pools, scoring and ranking: all concepts at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import clamp01, normalize_label, ns_priority


def top_k(df: DataFrame, k: int, order: list[Column], by: str | list[str] = "c", rank: str | None = None) -> DataFrame:
    """The first `k` rows of each group; Spark pushes the limit below the shuffle."""
    name = rank or "_rank"
    out = df.withColumn(
        name, F.row_number().over(W.partitionBy(*([by] if isinstance(by, str) else by)).orderBy(*order))
    ).filter(F.col(name) <= k)
    return out if rank else out.drop(name)


def bm25_search(
    queries: DataFrame, postings: DataFrame, k: int = 500, min_score: float = 0.01, k1: float = 1.5, b: float = 0.75,
    variant: str = "lucene"
) -> DataFrame:
    """(c, uri, kw_score) of queries (c, terms) over postings (term, uri, tf).

    Variants: 'lucene' (idf = ln(1 + (N - df + .5) / (df + .5)), no k1 + 1) and 'okapi' (idf =
    ln((N - df + .5) / (df + .5)), negatives become a quarter of the mean idf, times k1 + 1).
    Only the postings of query terms are counted and joined ('okapi' counts all terms, whose mean
    it needs); lengths cost one aggregation.  Postings are read several times: stage them."""
    q = queries.select("c", F.explode(F.array_distinct("terms")).alias("term"))
    lengths = postings.groupBy("uri").agg(F.sum("tf").alias("dl"))
    size = lengths.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"))
    asked = postings.join(q.select("term").distinct(), "term", "left_semi")
    counted = asked if variant == "lucene" else postings
    df = counted.groupBy("term").agg(F.count(F.lit(1)).alias("df")).join(F.broadcast(size))
    n, d = F.col("n"), F.col("df")
    if variant == "lucene":
        idf, factor = F.log(1 + (n - d + 0.5) / (d + 0.5)), 1.0
    else:
        df = df.withColumn("raw", F.log((n - d + 0.5) / (d + 0.5)))
        df = df.join(F.broadcast(df.agg(F.avg("raw").alias("mean_idf"))))
        idf, factor = F.when(F.col("raw") < 0, 0.25 * F.col("mean_idf")).otherwise(F.col("raw")), k1 + 1
    stats = df.select("term", idf.alias("idf"), "avgdl")
    hits = asked.join(q.join(stats, "term"), "term").join(lengths, "uri")
    tf = F.col("tf")
    part = F.col("idf") * tf * factor / (tf + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))
    scored = hits.groupBy("c", "uri").agg(F.sum(part).alias("kw_score")).filter(F.col("kw_score") >= min_score)
    return top_k(scored, k, [F.desc(F.round("kw_score", 9)), F.asc("uri")])


def tfidf_search(
    queries: DataFrame, postings: DataFrame, min_df: int = 2, max_df: float = 0.95, min_score: float = 0.05
) -> DataFrame:
    """(c, uri, kw_score): the best query term's cosine with the concept's tf-idf vector
    (smooth idf, L2 norm), so the term's share of the norm."""
    n = postings.select("uri").distinct().agg(F.count(F.lit(1)).alias("n"))
    stats = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")).join(F.broadcast(n)).filter(
        (F.col("df") >= min_df) & (F.col("df") <= max_df * F.col("n"))
    )
    weights = postings.join(stats, "term").select(
        "term", "uri", (F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1)).alias("w")
    )
    norms = weights.groupBy("uri").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    q = queries.select("c", F.explode(F.array_distinct("terms")).alias("term"))
    return weights.join(q, "term").join(norms, "uri").groupBy("c", "uri").agg(
        F.max(F.col("w") / F.col("norm")).alias("kw_score")
    ).filter(F.col("kw_score") >= min_score)


def keyword_search(queries: DataFrame, index: DataFrame) -> DataFrame:
    """(c, uri, hits): concepts with any keyword of the query, and how many."""
    q = queries.select("c", F.explode(F.array_distinct("terms")).alias("keyword"))
    return index.join(q, "keyword").groupBy("c", "uri").agg(F.count_distinct("keyword").alias("hits"))


def keyword_hits(queries: DataFrame, texts: DataFrame, threshold: int = 1) -> DataFrame:
    """(c, uri, hits, score): in how many texts (uri, text) of a concept a keyword (c, terms) stands as
    a word, in the raw text or in the normalised one, summed over keywords; those with fewer
    than `threshold` go.  score: 0.1 and up to 0.2 by the share of keywords."""
    terms = F.filter(F.array_distinct("terms"), lambda w: F.length(w) > 1)
    q = queries.select("c", F.size(terms).alias("n"), F.explode(terms).alias("word"))
    words = lambda x: F.regexp_extract_all(F.lower(x), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    both = F.array_union(words(F.col("text")), words(normalize_label(F.col("text"))))
    tokens = texts.select("uri", F.explode(both).alias("word"))  # a word once a text
    hits = tokens.join(q, "word").groupBy("c", "uri", "n").agg(
        F.count(F.lit(1)).alias("hits")
    ).filter(F.col("hits") >= threshold)
    return hits.select("c", "uri", "hits", (0.1 + 0.2 * F.least(F.lit(1.0), F.col("hits") / F.col("n"))).alias("score"))


def needs_expansion(queries: DataFrame, hits: DataFrame, overrides: DataFrame, min_hits: int = 5) -> DataFrame:
    """Queries with fewer keyword hits than `min_hits`, unless expansion is skipped."""
    n = hits.groupBy("c").agg(F.count(F.lit(1)).alias("n_hits"))
    out = queries.join(n, "c", "left").join(overrides.select("c", "skip_expansion"), "c", "left")
    return out.select(
        "c", F.coalesce("n_hits", F.lit(0)).alias("n_hits"), F.coalesce("skip_expansion", F.lit(False)).alias("skip")
    ).filter((F.col("n_hits") < min_hits) & ~F.col("skip")).select("c", "n_hits")


def candidate_union(
    kw: DataFrame, sim: DataFrame, seeds: DataFrame | None = None, filters: DataFrame | None = None,
    seed_scores: DataFrame | None = None
) -> DataFrame:
    """(c, uri, kw_score, sim_score, is_seed): both pools, missing scores 0; seeds are added
    with their similarity, filtered URIs go."""
    pool = kw.select("c", "uri", "kw_score").join(sim.select("c", "uri", "sim_score"), ["c", "uri"], "full_outer")
    if seeds is not None:
        extra = seeds.select("c", "uri").distinct().withColumn("is_seed", F.lit(True))
        pool = pool.join(extra, ["c", "uri"], "full_outer")
        if seed_scores is not None:
            pool = pool.join(
                seed_scores.select("c", "uri", F.col("sim_score").alias("seed_sim")), ["c", "uri"], "left"
            ).withColumn(
                "sim_score", F.coalesce("sim_score", F.when(F.col("is_seed"), F.col("seed_sim")))
            ).drop("seed_sim")
    else:
        pool = pool.withColumn("is_seed", F.lit(False))
    if filters is not None:
        pool = pool.join(filters.select("c", "uri").distinct(), ["c", "uri"], "left_anti")
    zero = lambda x: F.coalesce(F.col(x), F.lit(0.0))
    return pool.select(
        "c", "uri", zero("kw_score").alias("kw_score"), zero("sim_score").alias("sim_score"),
        F.coalesce("is_seed", F.lit(False)).alias("is_seed")
    )


#: Factors of the namespace bias.
FACTORS = {"core": 1.10, "boost": 1.05, "context": 1.02, "penalty": 0.95, "strong": 0.85, "metadata": 0.90}


def infer_domain(pool: DataFrame, groups: dict[str, list[str]], top: int = 50, share: float = 0.4) -> DataFrame:
    """(c, domain) from the namespaces of the first `top` candidates in order of URI."""
    inside = lambda kinds: _any(F.col("uri"), [p for k in kinds for p in groups.get(k, [])])
    first = top_k(pool.select("c", "uri"), top, [F.asc("uri")])
    shares = first.groupBy("c").agg(
        F.avg(inside(["core", "lodging"]).cast("int")).alias("lodging"),
        F.avg(inside(["activity"]).cast("int")).alias("activity")
    )
    return shares.select(
        "c",
        F.when(
            F.col("lodging") >= share, "Lodging/Amenity"
        ).when(F.col("activity") >= share, "Activity").otherwise("General").alias("domain")
    )


def _any(uri: Column, prefixes: list[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | F.startswith(uri, F.lit(p))
    return out


def namespace_bias(
    score: Column, uri: Column, domain: Column, groups: dict[str, list[str]], factors: dict[str, float] = FACTORS
) -> Column:
    """struct(score, reason).  Metadata ends it; wrong domain and low priority compound;
    else the domain of the concept decides.  Scores stay above 0."""
    f = {k: F.lit(v) for k, v in factors.items()}
    is_in = {k: _any(uri, v) for k, v in groups.items()}
    at = lambda k: is_in.get(k, F.lit(False))
    pick = lambda factor, reason: F.struct((score * factor).alias("score"), F.lit(reason).alias("reason"))
    lodging = (
        F.when(at("core"), pick(f["core"], "core"))
        .when(at("lodging"), pick(f["boost"], "lodging"))
        .when(at("location") | at("visual") | at("preference"), pick(f["context"], "context"))
        .when(at("activity"), pick(f["penalty"], "activity against lodging"))
        .otherwise(pick(F.lit(1.0), "neutral"))
    )
    activity = (
        F.when(at("activity"), pick(f["boost"], "activity"))
        .when(at("location") | at("preference"), pick(f["context"], "context"))
        .when(at("core") | at("lodging"), pick(f["penalty"], "lodging against activity"))
        .otherwise(pick(F.lit(1.0), "neutral"))
    )
    out = (
        F.when(at("metadata"), pick(f["metadata"], "metadata"))
        .when(at("wrong") & at("low_priority"), pick(f["strong"] * f["penalty"], "wrong domain, low priority"))
        .when(at("wrong"), pick(f["strong"], "wrong domain"))
        .when(at("low_priority"), pick(f["penalty"], "low priority"))
        .when(domain == "Lodging/Amenity", lodging)
        .when(domain == "Activity", activity)
        .otherwise(pick(F.lit(1.0), "neutral"))
    )
    return F.struct(
        F.when(out["score"] <= 0, 1e-9).otherwise(out["score"]).alias("score"), out["reason"].alias("reason")
    )


def score_candidates(
    pool: DataFrame, overrides: DataFrame | None, domains: DataFrame, groups: dict[str, list[str]], alpha: float = 0.6,
    abs_min_sim: float = 0.12, dampen_below: float = 0.35, dampening: float = 0.15, seed_threshold: float = 0.80,
    factors: dict[str, float] = FACTORS
) -> DataFrame:
    """The scored candidates: seed boost, floor, dampening, weighted sum, namespace bias.

    `abs_min_sim` = 0 switches the floor off, as needed where there are no vectors."""
    df = pool.join(domains, "c", "left")
    if overrides is not None:
        df = df.join(
            overrides.select("c", "effective_alpha", "boost_enabled", "boost_threshold"), "c", "left"
        )
    else:
        df = df.select(
            "*", F.lit(None).cast("double").alias("effective_alpha"), F.lit(True).alias("boost_enabled"),
            F.lit(seed_threshold).alias("boost_threshold")
        )
    s, k = F.col("sim_score"), F.col("kw_score")
    boosted = F.col("is_seed") & F.coalesce("boost_enabled", F.lit(False)) & (
        s < F.coalesce("boost_threshold", F.lit(seed_threshold))
    )
    df = df.withColumn("is_boosted", boosted).withColumn(
        "boosted_sim_score", F.when(boosted, F.coalesce("boost_threshold", F.lit(seed_threshold))).otherwise(s)
    )
    df = df.filter(F.col("boosted_sim_score") >= abs_min_sim)
    bs = F.col("boosted_sim_score")
    df = df.withColumn(
        "dampened_kw_score", F.when(bs < dampen_below, k * dampening).otherwise(k)
    ).withColumn("alpha", F.coalesce("effective_alpha", F.lit(alpha)))
    a = F.col("alpha")
    df = df.withColumn("combined_score_unbiased", a * clamp01(F.col("dampened_kw_score")) + (1 - a) * clamp01(bs))
    u = F.col("combined_score_unbiased")
    df = df.withColumn("bias", namespace_bias(u, F.col("uri"), F.col("domain"), groups, factors))
    free = F.col("is_boosted")
    return df.select(
        "c", "uri", "sim_score", "boosted_sim_score", "kw_score", "dampened_kw_score",
        F.col("alpha").alias("effective_alpha"), u,
        F.when(free, u).otherwise(F.col("bias.score")).alias("combined_score"),
        F.when(free, "boosted seed").otherwise(F.col("bias.reason")).alias("bias_reason"), "is_seed"
    )


def dynamic_alpha(sim: Column, kw: Column, alpha: float = 0.6, low: float = 0.10) -> Column:
    """Keyword share of the older generator: little trust in keywords that vectors deny."""
    return F.when((sim < 0.55) & (kw > 0.50), low).otherwise(alpha)


def rank_candidates(scored: DataFrame, preferred: list[str], n: int = 75) -> DataFrame:
    """Adds `rank`, keeps the first `n`: score, namespace priority, similarity, URI."""
    order = [
        F.desc(F.round("combined_score", 9)), ns_priority(F.col("uri"), preferred).asc(),
        F.desc(F.round("sim_score", 9)), F.asc("uri")
    ]
    return top_k(scored, n, order, rank="rank")


def select_anchor(ranked: DataFrame, exact: DataFrame) -> DataFrame:
    """(c, anchor_uri, method): the best ranked label match (c, uri, kind), else rank 1."""
    df = ranked.select("c", "uri", "rank").join(exact.select("c", "uri", "kind"), ["c", "uri"], "left")
    best = F.min_by(F.struct("uri", "kind"), F.struct(F.col("kind").isNull(), F.col("rank")))
    return df.groupBy("c").agg(best.alias("b")).select(
        "c", F.col("b.uri").alias("anchor_uri"), F.coalesce("b.kind", F.lit("Top ranked")).alias("method")
    )


def priority_pool_fill(pool: DataFrame, limit: int) -> DataFrame:
    """Keyword matches first by similarity, then the others, to the limit; `place` is by similarity."""
    kept = top_k(pool, limit, [(F.col("kw_score") > 0).desc(), F.desc("sim_score"), F.asc("uri")])
    return kept.withColumn("place", F.row_number().over(W.partitionBy("c").orderBy(F.desc("sim_score"), F.asc("uri"))))


def dedupe_by_label(df: DataFrame, k: int = 5) -> DataFrame:
    """The best row of each label (blank labels all stay), then the first `k` of each concept."""
    blank = F.trim(F.coalesce("label", F.lit(""))) == ""
    key = F.when(blank, F.concat(F.lit("uri "), F.col("uri"))).otherwise(
        F.concat(F.lit("label "), F.lower(F.trim("label")))
    )
    best = top_k(df.withColumn("_key", key), 1, [F.desc("score"), F.asc("uri")], by=["c", "_key"]).drop("_key")
    return top_k(best, k, [F.desc("score"), F.asc("uri")], rank="rank")
