"""Queries from the pools to ranked candidates and anchors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relations as L
from ..operators import retrieval as R
from ..operators import vectors as V
from . import q_concepts as K
from .fixtures import Registry, view
from ..stages import staged

Q = Registry()

GROUPS = {
    "core": ["urn:fx:src0:"], "lodging": ["urn:fx:src1:"], "activity": ["urn:fx:src2:"], "location": ["urn:fx:src3:"],
    "metadata": ["urn:fx:src4:"], "low_priority": ["urn:fx:src5:"], "wrong": ["urn:fx:src5:", "urn:fx:src6:"]
}
PREFERRED = [f"urn:fx:src{i}:" for i in range(4)]

DV = "list_transform({0}, lambda x: CAST(x AS DOUBLE))"
COS = "list_cosine_similarity(" + DV.format("q.v") + ", " + DV.format("t.v") + ")"
SIMS = f"sims AS (SELECT q.c, t.uri, {COS} AS sim_score FROM fx_vec_q q, fx_vec_t t)"


def similar(spark, d, **options):
    return V.similarity_search(view(spark, d, "fx_vec_q"), view(spark, d, "fx_vec_t"), **options)


@Q.add(
    "d06_similarity_search",
    f"WITH {SIMS} SELECT c, uri, round(sim_score, 4) AS sim_score FROM sims WHERE sim_score >= 0.1"
)
def d06(spark, d):
    return similar(spark, d, min_score=0.1).withColumn("sim_score", F.round("sim_score", 4))


@Q.add(
    "d06_similarity_blocks",
    f"WITH {SIMS} SELECT c, uri, round(sim_score, 4) AS sim_score FROM sims WHERE sim_score >= 0.1"
)
def d06b(spark, d):
    """The same by pairs of blocks, as where both sides are too large to send."""
    return similar(spark, d, min_score=0.1, broadcast_bytes=0, index=False).withColumn("sim_score", F.round("sim_score", 4))


@Q.add(
    "d06_similarity_pivots",
    f"WITH {SIMS} SELECT c, uri, round(sim_score, 4) AS sim_score FROM sims WHERE sim_score >= 0.4"
)
def d06p(spark, d):
    """By pairs of blocks that the index of pivots does not rule out."""
    return similar(spark, d, min_score=0.4, broadcast_bytes=0, block=128).withColumn("sim_score", F.round("sim_score", 4))


@Q.add("b15_cosine", f"WITH {SIMS} SELECT c, uri, round(sim_score, 4) AS sim_score FROM sims")
def b15(spark, d):
    """The cosine of every query with every vector: all pairs are the feature here."""
    found = V.every_cosine(view(spark, d, "fx_vec_q"), view(spark, d, "fx_vec_t"))
    return found.withColumn("sim_score", F.round("sim_score", 4))


@Q.add(
    "c01_min_similarity",
    f"WITH {SIMS} SELECT c, uri, round(sim_score, 4) AS sim_score FROM sims WHERE sim_score >= 0.30"
)
def c01(spark, d):
    return similar(spark, d, min_score=0.30).withColumn("sim_score", F.round("sim_score", 4))


@Q.add(
    "f11_similarity_pool",
    f"WITH {SIMS} SELECT c, uri, round(sim_score, 4) AS sim_score FROM sims QUALIFY row_number() OVER (PARTITION BY c ORDER BY sim_score DESC, uri) <= 20"
)
def f11(spark, d):
    return similar(spark, d, min_score=None, k=20).withColumn("sim_score", F.round("sim_score", 4))


# the pool: keyword scores made comparable (share of the concept's best), and similarities
KW = K.bm25_sql("lucene") + ", kws AS (SELECT c, uri, kw_score / max(kw_score) OVER (PARTITION BY c) AS kw_score FROM kw)"
POOL = "WITH " + KW + f""", {SIMS}, near AS (SELECT c, uri, sim_score FROM sims WHERE sim_score >= 0.05), seeds AS (SELECT e.c, e.uri, s.sim_score FROM fx_seeds e LEFT JOIN sims s ON s.c = e.c AND s.uri = e.uri),
every AS (SELECT c, uri, kw_score, NULL AS sim_score, false AS is_seed FROM kws UNION ALL SELECT c, uri, NULL, sim_score, false FROM near UNION ALL SELECT c, uri, NULL, sim_score, true FROM seeds),
pool AS MATERIALIZED (SELECT c, uri, coalesce(max(kw_score), 0) AS kw_score, coalesce(max(sim_score), 0) AS sim_score, bool_or(is_seed) AS is_seed FROM every ANTI JOIN fx_filters USING (c, uri) GROUP BY c, uri)"""


def pool(spark, d):
    """The pool of candidates, written once: what follows reads it several times."""
    from pyspark.sql.window import Window as W

    kw = R.bm25_search(K.doc_queries(spark, d), K.doc_postings(spark, d))
    kw = kw.withColumn("kw_score", F.col("kw_score") / F.max("kw_score").over(W.partitionBy("c")))
    q, t, seeds = view(spark, d, "fx_vec_q"), view(spark, d, "fx_vec_t"), view(spark, d, "fx_seeds")
    near = V.similarity_search(q, t, min_score=0.05)
    return staged(
        R.candidate_union(kw, near, seeds, view(spark, d, "fx_filters"), V.pair_similarity(seeds, q, t)), "pool"
    )


@Q.add(
    "d05_candidate_union",
    POOL + " SELECT c, uri, round(kw_score, 4) AS kw_score, round(sim_score, 4) AS sim_score, is_seed FROM pool"
)
def d05(spark, d):
    return pool(spark, d).select(
        "c", "uri", F.round("kw_score", 4).alias("kw_score"), F.round("sim_score", 4).alias("sim_score"), "is_seed"
    )


def _sql_in(kind: str) -> str:
    return "(" + " OR ".join(f"starts_with(uri, '{p}')" for p in GROUPS[kind]) + ")"


DOMAINS = POOL + f", dom AS (SELECT c, CASE WHEN avg(CASE WHEN {_sql_in('core')} OR {_sql_in('lodging')} THEN 1.0 ELSE 0 END) >= 0.4 THEN 'Lodging/Amenity' WHEN avg(CASE WHEN {_sql_in('activity')} THEN 1.0 ELSE 0 END) >= 0.4 THEN 'Activity' ELSE 'General' END AS domain FROM (SELECT * FROM pool QUALIFY row_number() OVER (PARTITION BY c ORDER BY uri) <= 50) GROUP BY c)"


@Q.add("e11_infer_domain", DOMAINS + " SELECT c, domain FROM dom")
def e11(spark, d):
    return R.infer_domain(pool(spark, d), GROUPS)


SCORED = DOMAINS + f""", s1 AS (SELECT pool.*, domain, coalesce(effective_alpha, 0.6) AS alpha, is_seed AND coalesce(boost_enabled, false) AND sim_score < coalesce(boost_threshold, 0.8) AS boosted, coalesce(boost_threshold, 0.8) AS bt FROM pool LEFT JOIN dom USING (c) LEFT JOIN fx_overrides USING (c)),
s2 AS (SELECT *, CASE WHEN boosted THEN bt ELSE sim_score END AS bs FROM s1), s3 AS (SELECT *, CASE WHEN bs < 0.35 THEN kw_score * 0.15 ELSE kw_score END AS dk FROM s2 WHERE bs >= 0.12),
s4 AS (SELECT *, alpha * greatest(0, least(1, dk)) + (1 - alpha) * greatest(0, least(1, bs)) AS u FROM s3),
scored AS (SELECT *, CASE WHEN boosted THEN u WHEN {_sql_in('metadata')} THEN u * 0.9 WHEN {_sql_in('wrong')} AND {_sql_in('low_priority')} THEN u * 0.85 * 0.95 WHEN {_sql_in('wrong')} THEN u * 0.85 WHEN {_sql_in('low_priority')} THEN u * 0.95
WHEN domain = 'Lodging/Amenity' THEN u * CASE WHEN {_sql_in('core')} THEN 1.10 WHEN {_sql_in('lodging')} THEN 1.05 WHEN {_sql_in('location')} THEN 1.02 WHEN {_sql_in('activity')} THEN 0.95 ELSE 1 END
WHEN domain = 'Activity' THEN u * CASE WHEN {_sql_in('activity')} THEN 1.05 WHEN {_sql_in('location')} THEN 1.02 WHEN {_sql_in('core')} OR {_sql_in('lodging')} THEN 0.95 ELSE 1 END ELSE u END AS combined FROM s4)"""


def scored(spark, d):
    p = pool(spark, d)
    return R.score_candidates(p, view(spark, d, "fx_overrides"), R.infer_domain(p, GROUPS), GROUPS)


@Q.add(
    "c03_score_candidates",
    SCORED + " SELECT c, uri, round(bs, 4) AS boosted_sim_score, round(dk, 4) AS dampened_kw_score, alpha AS effective_alpha, round(u, 4) AS combined_score_unbiased, round(combined, 4) AS combined_score, is_seed FROM scored"
)
def c03(spark, d):
    r = lambda c: F.round(c, 4).alias(c)
    return scored(spark, d).select(
        "c", "uri", r("boosted_sim_score"), r("dampened_kw_score"), "effective_alpha", r("combined_score_unbiased"),
        r("combined_score"), "is_seed"
    )


PRIORITY = "CASE " + " ".join(
    f"WHEN starts_with(uri, '{p}') THEN {i}" for i, p in enumerate(PREFERRED)
) + " ELSE 14 END"
RANKED = SCORED + f", ranked AS (SELECT c, uri, combined, u, sim_score, row_number() OVER (PARTITION BY c ORDER BY round(combined, 9) DESC, {PRIORITY}, round(sim_score, 9) DESC, uri) AS rank FROM scored QUALIFY rank <= 75)"


def ranked(spark, d):
    return R.rank_candidates(scored(spark, d), PREFERRED)


@Q.add("rank_candidates", RANKED + " SELECT c, uri, rank, round(combined, 4) AS combined_score FROM ranked")
def f01(spark, d):
    """Flagship: all concepts at once, from texts and vectors to ranked candidates."""
    return ranked(spark, d).select(
        "c", "uri", F.col("rank").cast("long").alias("rank"), F.round("combined_score", 4).alias("combined_score")
    )


_NORM_DOC = "lower(regexp_replace(pref_label, '[^\\p{L}\\p{N}_\\s]', '', 'g'))"
EXACT = RANKED + f", labels AS (SELECT uri, {_NORM_DOC} AS norm FROM fx_docs WHERE pref_label <> ''), cq AS (SELECT r.c, l.norm || CASE WHEN r.c % 2 = 0 THEN '' ELSE 's' END AS norm FROM ranked r JOIN labels l USING (uri) WHERE r.rank = 3), ex AS (SELECT DISTINCT c, l.uri, CASE WHEN cq.norm = l.norm THEN 'Exact' WHEN cq.norm = l.norm || 's' THEN 'Plural input' ELSE 'Plural label' END AS kind FROM cq JOIN labels l ON cq.norm = l.norm OR cq.norm = l.norm || 's' OR cq.norm || 's' = l.norm)"


def exact(spark, d, r):
    labels = view(spark, d, "fx_docs").filter("pref_label <> ''").select(
        "uri", F.lower(F.regexp_replace("pref_label", r"[^\p{L}\p{N}_\s]", "")).alias("norm")
    )
    q = r.filter("rank = 3").join(labels, "uri").select(
        "c", F.concat("norm", F.when(F.col("c") % 2 == 0, "").otherwise("s")).alias("norm")
    )
    return L.label_matches(q, labels)


@Q.add(
    "f03_select_anchor",
    EXACT + " SELECT c, uri AS anchor_uri, coalesce(kind, 'Top ranked') AS method FROM ranked LEFT JOIN ex USING (c, uri) QUALIFY row_number() OVER (PARTITION BY c ORDER BY kind IS NULL, rank) = 1"
)
def f03(spark, d):
    r = ranked(spark, d)
    return R.select_anchor(r, exact(spark, d, r))


@Q.add(
    "c08_dynamic_alpha",
    POOL + " SELECT c, uri, CASE WHEN sim_score < 0.55 AND kw_score > 0.50 THEN CAST(0.10 AS DOUBLE) ELSE 0.6 END AS alpha FROM pool"
)
def c08(spark, d):
    return pool(spark, d).select("c", "uri", R.dynamic_alpha(F.col("sim_score"), F.col("kw_score")).alias("alpha"))


@Q.add(
    "f10_priority_pool_fill",
    POOL + ", f AS (SELECT c, uri, sim_score FROM pool QUALIFY row_number() OVER (PARTITION BY c ORDER BY CASE WHEN kw_score > 0 THEN 0 ELSE 1 END, sim_score DESC, uri) <= 30) SELECT c, uri, row_number() OVER (PARTITION BY c ORDER BY sim_score DESC, uri) AS place FROM f"
)
def f10(spark, d):
    return R.priority_pool_fill(pool(spark, d), 30).select("c", "uri", F.col("place").cast("long").alias("place"))


@Q.add(
    "f09_dedupe_by_label",
    POOL + ", l AS (SELECT c, pool.uri, sim_score AS score, CASE WHEN trim(pref_label) = '' THEN 'uri ' || pool.uri ELSE 'label ' || lower(trim(pref_label)) END AS k FROM pool JOIN fx_docs ON fx_docs.uri = pool.uri), b AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY c, k ORDER BY score DESC, uri) = 1) SELECT c, uri, row_number() OVER (PARTITION BY c ORDER BY score DESC, uri) AS rank FROM b QUALIFY rank <= 5"
)
def f09(spark, d):
    j = pool(spark, d).join(
        view(spark, d, "fx_docs").select("uri", F.col("pref_label").alias("label")), "uri"
    ).withColumnRenamed("sim_score", "score")
    return R.dedupe_by_label(j).select("c", "uri", F.col("rank").cast("long").alias("rank"))


@Q.add(
    "f07_negation_shortlist",
    RANKED + ", l AS (SELECT c, uri, u FROM ranked JOIN fx_docs USING (uri) WHERE pref_label <> '') SELECT c, uri, row_number() OVER (PARTITION BY c ORDER BY round(u, 9) DESC, uri) AS place FROM l QUALIFY place <= 30"
)
def f07(spark, d):
    labelled = view(spark, d, "fx_docs").filter("pref_label <> ''").select("uri")
    r = ranked(spark, d).join(labelled, "uri", "left_semi")
    return R.top_k(
        r, 30, [F.desc(F.round("combined_score_unbiased", 9)), F.asc("uri")], rank="place"
    ).select("c", "uri", F.col("place").cast("long").alias("place"))


@Q.add(
    "c10_manual_query_split",
    "SELECT c, coalesce(manual_query, concept) AS query FROM fx_queries LEFT JOIN fx_overrides USING (c)"
)
def c10(spark, d):
    o = F.broadcast(view(spark, d, "fx_overrides").select("c", "manual_query"))
    return view(spark, d, "fx_queries").join(o, "c", "left").select(
        "c", F.coalesce("manual_query", "concept").alias("query")
    )


@Q.add(
    "g01_pool_sets",
    "WITH " + KW + f", {SIMS}, near AS (SELECT c, uri FROM sims WHERE sim_score >= 0.05) SELECT 'both' AS kind, count(*) AS n FROM (SELECT c, uri FROM kws INTERSECT SELECT c, uri FROM near) UNION ALL SELECT 'any', count(*) FROM (SELECT c, uri FROM kws UNION SELECT c, uri FROM near) UNION ALL SELECT 'keyword only', count(*) FROM (SELECT c, uri FROM kws EXCEPT SELECT c, uri FROM near)"
)
def g01(spark, d):
    kw = R.bm25_search(K.doc_queries(spark, d), K.doc_postings(spark, d)).select("c", "uri")
    near = similar(spark, d, min_score=0.05).select("c", "uri")
    count = lambda df, k: df.agg(F.lit(k).alias("kind"), F.count(F.lit(1)).alias("n"))
    return count(kw.intersect(near), "both").unionByName(count(kw.union(near).distinct(), "any")).unionByName(
        count(kw.subtract(near), "keyword only")
    )
