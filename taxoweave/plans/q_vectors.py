"""Queries of vector similarity, slotting, opposites and clusters, and of mappings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relations as L
from ..operators import vectors as V
from . import q_candidates as A
from .fixtures import Registry, view

Q = Registry()

SIMS = "WITH " + A.SIMS + ", lab AS (SELECT uri, lower(pref_label) AS label, doc_id FROM fx_docs WHERE pref_label <> '')"


def labels(spark, d):
    return view(spark, d, "fx_docs").filter("pref_label <> ''").select(
        "uri", F.lower("pref_label").alias("label"), "doc_id"
    )


def top_sql(source: str, score: str, k: int, by: str = "c", key: str = "uri") -> str:
    return f"SELECT * FROM ({source}) QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY {score} DESC, {key}) <= {k}"


@Q.add(
    "e21_dynamic_synonyms",
    SIMS + ", j AS (SELECT c, label AS text, max(sim_score) AS score FROM sims JOIN lab USING (uri) WHERE sim_score >= 0.15 GROUP BY c, label) SELECT c, text, round(score, 4) AS score FROM j QUALIFY row_number() OVER (PARTITION BY c ORDER BY score DESC, text) <= 20"
)
def e21(spark, d):
    return V.dynamic_synonyms(
        A.similar(spark, d, min_score=0.15), labels(spark, d).withColumnRenamed("label", "text"), 0.15
    ).withColumn("score", F.round("score", 4))


@Q.add(
    "e22_dynamic_exclusions",
    SIMS + ", j AS (SELECT c, label AS text, CASE WHEN doc_id % 2 = 0 AND sim_score > 0.2 THEN 'synonym' WHEN doc_id % 2 <> 0 AND sim_score > 0.3 THEN 'exclusion' END AS kind FROM sims JOIN lab USING (uri)) SELECT DISTINCT * FROM j WHERE kind IS NOT NULL"
)
def e22(spark, d):
    t = labels(spark, d).select("uri", F.col("label").alias("text"), (F.col("doc_id") % 2 == 0).alias("is_label"))
    return V.dynamic_exclusions(A.similar(spark, d, min_score=0.1), t, 0.2, 0.3)


_PAIRS = SIMS + ", pr AS (SELECT c, uri, CASE doc_id % 3 WHEN 0 THEN 'prefLabel' WHEN 1 THEN 'altLabel' ELSE 'note' END AS prop, (doc_id % 7) / 7.0 AS kw, sim_score AS sim, doc_id % 5 = 0 AS associated, doc_id % 4 = 0 AS is_synonym, sim_score * 0.9 AS primary_sim FROM sims JOIN lab USING (uri) WHERE sim_score >= 0.1)"


def pairs(spark, d):
    """The shortlist by similarity, with what the texts say."""
    j = A.similar(spark, d, min_score=0.1).join(labels(spark, d), "uri")
    return j.selectExpr(
        "c", "uri", "CASE doc_id % 3 WHEN 0 THEN 'prefLabel' WHEN 1 THEN 'altLabel' ELSE 'note' END AS prop",
        "CAST(doc_id % 7 AS DOUBLE) / 7 AS kw", "sim_score AS sim", "doc_id % 5 = 0 AS associated",
        "doc_id % 4 = 0 AS is_synonym", "sim_score * 0.9 AS primary_sim"
    )


@Q.add(
    "e23_best_text_match",
    _PAIRS + ", s AS (SELECT c, uri, max(greatest(least(1, greatest(0, (0.5 * kw + 0.5 * sim) * CASE prop WHEN 'prefLabel' THEN 1.0 WHEN 'altLabel' THEN 0.9 ELSE 1.0 END + CASE WHEN associated THEN 0.4 ELSE 0 END + CASE WHEN is_synonym THEN 0.2 ELSE 0 END)), primary_sim)) AS score FROM pr GROUP BY c, uri) SELECT c, uri, round(score, 4) AS score FROM s WHERE score >= 0.3 QUALIFY row_number() OVER (PARTITION BY c ORDER BY round(score, 9) DESC, uri) <= 10"
)
def e23(spark, d):
    return V.best_text_match(
        pairs(spark, d), {"prefLabel": 1.0, "altLabel": 0.9}
    ).select("c", "uri", F.round("score", 4).alias("score"))


@Q.add(
    "e24_penalised_match",
    SIMS + ", m AS (SELECT c, uri, sim_score AS score, doc_id % 9 = 0 AS exact, doc_id FROM sims JOIN lab USING (uri) WHERE sim_score >= 0.1) SELECT c, uri, round(CASE WHEN exact THEN 1.01 WHEN doc_id % 4 = 1 AND c % 5 <> 0 THEN greatest(score - 0.5, 0.2 * score) ELSE score END, 4) + 0.0 AS score FROM m WHERE doc_id % 6 <> 5"
)
def e24(spark, d):
    m = A.similar(spark, d, min_score=0.1).join(labels(spark, d), "uri").select(
        "c", "uri", F.col("sim_score").alias("score"), (F.col("doc_id") % 9 == 0).alias("exact"), "doc_id"
    )
    out = V.penalised_match(
        m.drop("doc_id"), m.filter("doc_id % 6 = 5"), m.filter("doc_id % 4 = 1"), m.filter("c % 5 = 0")
    )
    return out.withColumn("score", F.round("score", 4) + 0.0)


_ARCH = SIMS + f", ar AS (SELECT a.c, b.c AS archetype, {A.COS.replace('q.v', 'a.v').replace('t.v', 'b.v')} AS s FROM fx_vec_q a, fx_vec_q b WHERE a.c % 2 = 1 AND b.c % 2 = 0), best AS (SELECT * FROM ar QUALIFY row_number() OVER (PARTITION BY c ORDER BY s DESC, archetype) <= 3)"


def archetypes(spark, d):
    q = view(spark, d, "fx_vec_q")
    return V.similarity_search(
        q.filter("c % 2 = 1"), q.filter("c % 2 = 0").withColumnRenamed("c", "archetype"), min_score=None, k=3,
        uri="archetype"
    )


@Q.add("e25_archetypes", _ARCH + " SELECT c, archetype, round(s, 4) AS sim_score FROM best")
def e25(spark, d):
    return archetypes(spark, d).withColumn("sim_score", F.round("sim_score", 4))


@Q.add(
    "e26_kg_slice",
    _ARCH + ", al AS (SELECT c, uri, sim_score FROM sims WHERE c % 2 = 1 UNION ALL SELECT b.c, s.uri, 0.5 * sim_score FROM best b JOIN sims s ON s.c = b.archetype), g AS (SELECT c, uri, max(sim_score) AS score FROM al GROUP BY c, uri) SELECT c, uri, round(score, 4) AS score FROM g WHERE score >= 0.15 QUALIFY row_number() OVER (PARTITION BY c ORDER BY score DESC, uri) <= 50"
)
def e26(spark, d):
    # nothing lower reaches the threshold, nor what 50 URIs precede for a concept or an archetype
    every = V.best_similarity(view(spark, d, "fx_vec_q"), view(spark, d, "fx_vec_t"), min_score=0.15, k=50)
    by = archetypes(spark, d).select("c", "archetype").join(
        every.withColumnRenamed("c", "archetype"), "archetype"
    ).select("c", "uri", "sim_score")
    return V.kg_slice(every.filter("c % 2 = 1"), by, 0.15, 50).select("c", "uri", F.round("score", 4).alias("score"))


@Q.add(
    "e27_essentials_check",
    _ARCH + ", req AS (SELECT doc_id % 10 AS archetype, uri FROM lab), have AS (SELECT DISTINCT c, uri FROM sims WHERE sim_score > 0) SELECT DISTINCT b.c, req.uri FROM best b JOIN req USING (archetype) WHERE (b.c, req.uri) NOT IN (SELECT (c, uri) FROM have)"
)
def e27(spark, d):
    """What a definition has is asked for the required pairs only."""
    req = labels(spark, d).select((F.col("doc_id") % 10).alias("archetype"), "uri")
    chosen = archetypes(spark, d)
    have = V.pair_similarity(
        chosen.join(req, "archetype"), view(spark, d, "fx_vec_q"), view(spark, d, "fx_vec_t")
    ).filter("sim_score > 0")
    return V.essentials_check(chosen, req, have)


_NEG = "neg AS (SELECT item_id AS c, unnest(string_split(lower(regexp_extract(text, '^([^ ]+ [^ ]+ [^ ]+ [^ ]+)', 1)), ' ')) AS word FROM benchmark WHERE item_id % 2 = 0)"


@Q.add(
    "e28_opposite_candidates",
    SIMS + f", {_NEG}, nn AS (SELECT c, count(DISTINCT word) AS n FROM neg GROUP BY c), tk AS (SELECT uri, unnest(list_distinct(string_split(label, ' '))) AS word FROM lab), h AS (SELECT s.c, s.uri, count(*) AS h, array_to_string(list_sort(list(DISTINCT word)), ',') AS matched FROM sims s JOIN tk USING (uri) JOIN (SELECT DISTINCT * FROM neg) g USING (c, word) GROUP BY s.c, s.uri), o AS (SELECT c, uri, 1 - sim_score AS distance, CASE WHEN n IS NULL THEN NULL ELSE coalesce(h, 0) / n END AS kw, matched FROM sims LEFT JOIN nn USING (c) LEFT JOIN h USING (c, uri) WHERE sim_score < 0.4), r AS (SELECT c, uri, CASE WHEN kw IS NULL THEN distance ELSE 0.5 * distance + 0.5 * kw END AS ranking_score, round(distance, 4) AS distance, round(coalesce(kw, 0), 4) AS keyword_score, coalesce(matched, '') AS matched FROM o WHERE kw IS NULL OR kw >= 0.06) SELECT * REPLACE (round(ranking_score, 4) AS ranking_score) FROM r QUALIFY row_number() OVER (PARTITION BY c ORDER BY round(r.ranking_score, 9) DESC, uri) <= 15"
)
def e28(spark, d):
    neg = view(spark, d, "benchmark").filter("item_id % 2 = 0").select(
        F.col("item_id").alias("c"),
        F.explode(F.split(F.lower(F.regexp_extract("text", "^([^ ]+ [^ ]+ [^ ]+ [^ ]+)", 1)), " ")).alias("word")
    )
    return V.opposite_candidates(view(spark, d, "fx_vec_q"), view(spark, d, "fx_vec_t"), labels(spark, d), neg)


@Q.add(
    "e35_theme_centroids",
    "SELECT label, i, round(avg(x), 5) AS x FROM (SELECT label, generate_subscripts(embedding, 1) - 1 AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) GROUP BY label, i"
)
def e35(spark, d):
    m = V.centroids(view(spark, d, "embeddings").select("label", F.col("embedding").alias("v")), "label")
    return m.select("label", F.posexplode("v").alias("i", "x")).select(
        "label", F.col("i").cast("long").alias("i"), F.round("x", 5).alias("x")
    )


_SLOT = SIMS + ", hint AS (SELECT CAST(vec_id AS BIGINT) AS theme, l.word AS hint FROM fx_vec_t JOIN (SELECT doc_id, unnest(string_split(label, ' ')) AS word FROM lab) l ON l.doc_id = vec_id), th AS (SELECT uri, c AS theme, max(sim_score) AS sim FROM sims GROUP BY ALL), tk AS (SELECT uri, unnest(list_distinct(string_split_regex(label, '[^a-zA-Z0-9_]+'))) AS hint FROM lab), hh AS (SELECT uri, theme, count(*) AS hits FROM tk JOIN (SELECT DISTINCT theme % 15 AS theme, hint FROM hint) USING (hint) GROUP BY ALL), sl AS (SELECT uri, theme, coalesce(sim, 0) AS sim, coalesce(hits, 0) AS hits FROM th FULL JOIN hh USING (uri, theme))"


def slots(spark, d, min_score):
    words = labels(spark, d).select("doc_id", F.explode(F.split("label", " ")).alias("hint"))
    hints = view(spark, d, "fx_vec_t").join(words, F.col("doc_id") == F.col("vec_id")).select(
        (F.col("vec_id") % 15).alias("theme"), "hint"
    )
    return V.slot_scores(
        view(spark, d, "fx_vec_q"), view(spark, d, "fx_vec_t"), labels(spark, d), hints, min_score
    ), hints


@Q.add(
    "d16_hint_semantic_slotting",
    _SLOT + " SELECT uri, theme, round(0.4 * CASE WHEN hits > 0 THEN 0.8 ELSE 0 END + 0.6 * sim, 4) AS confidence FROM sl WHERE 0.4 * CASE WHEN hits > 0 THEN 0.8 ELSE 0 END + 0.6 * sim >= 0.31 QUALIFY row_number() OVER (PARTITION BY uri ORDER BY round(0.4 * CASE WHEN hits > 0 THEN 0.8 ELSE 0 END + 0.6 * sim, 9) DESC, theme) = 1"
)
def d16(spark, d):
    return V.slot_by_hints(slots(spark, d, 0.5)[0], "best").withColumn("confidence", F.round("confidence", 4))


@Q.add(
    "d17_multi_theme_slotting",
    _SLOT + ", m AS (SELECT uri, theme, 0.3 * CASE WHEN hits > 0 THEN 0.8 ELSE 0 END + 0.7 * sim AS confidence FROM sl WHERE hits >= 1 OR sim >= 0.2) SELECT uri, theme, round(confidence, 4) AS confidence FROM m QUALIFY row_number() OVER (PARTITION BY theme ORDER BY confidence DESC, uri) <= 5"
)
def d17(spark, d):
    return V.slot_by_hints(slots(spark, d, 0.2)[0], "multi", 0.2).withColumn("confidence", F.round("confidence", 4))


@Q.add(
    "d18_strict_theme_select",
    _SLOT + " SELECT uri, theme, round(sim, 4) AS confidence FROM sl WHERE sim >= 0.1 AND (hits >= 1 OR theme NOT IN (SELECT theme % 15 FROM hint))"
)
def d18(spark, d):
    s, hints = slots(spark, d, 0.1)
    return V.slot_by_hints(s, "strict", 0.1, themes_with_hints=hints).withColumn("confidence", F.round("confidence", 4))


@Q.add(
    "d19_contradiction_filter",
    SIMS + ", ev AS (SELECT c, uri FROM sims WHERE sim_score >= 0.1), opp AS (SELECT (c + 1) % 5 AS c, uri, 'concept ' || CAST(c AS STRING) AS opposite, sim_score FROM sims WHERE sim_score >= 0.2), ex AS (SELECT c, uri FROM ev JOIN lab USING (uri) WHERE doc_id % 13 = 0), w AS (SELECT c, uri, max(sim_score) AS s, arg_max(opposite, sim_score) AS o FROM opp GROUP BY c, uri) SELECT ev.c, ev.uri, CASE WHEN ex.uri IS NOT NULL THEN 'specific exclusion' WHEN w.uri IS NOT NULL THEN 'opposite of ' || o ELSE 'kept' END AS reason, CASE WHEN ex.uri IS NOT NULL THEN 1 WHEN w.uri IS NOT NULL THEN round(s, 4) ELSE 0 END AS score FROM ev LEFT JOIN ex USING (c, uri) LEFT JOIN w USING (c, uri)".replace("ex.uri IS NOT NULL", "ex.m").replace(
        "SELECT c, uri FROM ev JOIN lab", "SELECT c, uri, true AS m FROM ev JOIN lab"
    ).replace("w.uri IS NOT NULL", "w.o IS NOT NULL")
)
def d19(spark, d):
    every = A.similar(spark, d, min_score=0.1)
    ev = every.select("c", "uri")
    ex = ev.join(labels(spark, d).filter("doc_id % 13 = 0"), "uri").select("c", "uri")
    opp = every.filter("sim_score >= 0.2").select(
        ((F.col("c") + 1) % 5).alias("c"), "uri",
        F.concat(F.lit("concept "), F.col("c").cast("string")).alias("opposite"), "sim_score"
    )
    kept, gone = V.contradictions(ev, ex, opp, 0.2)
    return kept.select(
        "c", "uri", F.lit("kept").alias("reason"), F.lit(0.0).alias("score")
    ).unionByName(gone.withColumn("score", F.round("score", 4)))


@Q.add(
    "f08_semantic_shortlist",
    SIMS + " SELECT c, uri, round(sim_score, 4) AS sim_score FROM sims WHERE sim_score >= 0.1 AND (c, uri) NOT IN (SELECT (c, uri) FROM fx_filters) QUALIFY row_number() OVER (PARTITION BY c ORDER BY sim_score DESC, uri) <= 150"
)
def f08(spark, d):
    from ..operators.retrieval import top_k

    s = A.similar(spark, d, min_score=0.1).join(view(spark, d, "fx_filters"), ["c", "uri"], "left_anti")
    return top_k(s, 150, [F.desc("sim_score"), F.asc("uri")]).withColumn("sim_score", F.round("sim_score", 4))


@Q.add("j03_primary_vector", "SELECT uri, vec_id FROM fx_vec_t")
def j03(spark, d):
    t = view(spark, d, "fx_vec_t")
    both = t.select("uri", F.lit("altLabel").alias("prop"), F.array(F.lit(0.0)).alias("v"), "vec_id").unionByName(
        t.select("uri", F.lit("prefLabel").alias("prop"), F.array(F.col("vec_id").cast("double")).alias("v"), "vec_id")
    )
    return V.primary_vector(both, ["prefLabel", "altLabel"]).select(
        "uri", F.get("v", F.lit(0)).cast("long").alias("vec_id")
    )


@Q.add(
    "k03_similarity_clusters",
    "WITH RECURSIVE " + "v AS (SELECT vec_id AS uri, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), e AS (SELECT a.uri AS x, b.uri AS y FROM v a, v b WHERE list_cosine_similarity(a.v, b.v) >= 1 - 1.25 * 1.25 / 2 - 1e-9), r(uri, cluster) AS (SELECT uri, uri FROM v UNION SELECT e.y, r.cluster FROM r JOIN e ON e.x = r.uri) SELECT uri, min(cluster) AS cluster FROM r GROUP BY uri"
)
def k03(spark, d):
    v = view(spark, d, "embeddings").select(F.col("vec_id").alias("uri"), F.col("embedding").alias("v"))
    return V.similarity_clusters(v, 1.25)


# relations over the parts' taxonomy
_EDGES = "edges AS (SELECT DISTINCT s AS src, o AS dst FROM fx_triples WHERE p = 'http://www.w3.org/2004/02/skos/core#broader')"
_ANCH = "anch AS (SELECT CAST(p_partkey % 40 AS BIGINT) AS c, 'urn:fx:part:#' || CAST(p_partkey AS STRING) AS uri, p_size / 50.0 AS score FROM part)"


def anchors(spark, d):
    return view(spark, d, "part").select(
        (F.col("p_partkey") % 40).cast("long").alias("c"),
        F.concat(F.lit("urn:fx:part:#"), F.col("p_partkey").cast("string")).alias("uri"),
        (F.col("p_size") / 50.0).alias("score")
    )


def edges(spark, d):
    from ..operators.concepts import concept_edges

    return concept_edges(view(spark, d, "fx_triples")).distinct()


@Q.add(
    "d11_relation_expansion",
    f"WITH {_EDGES}, {_ANCH}, near AS (SELECT c, dst AS uri, max(score * 0.35) AS score FROM anch JOIN edges ON src = uri WHERE score >= 0.6 GROUP BY c, dst) SELECT c, uri, round(score, 6) AS score, 0 AS depth FROM anch UNION ALL SELECT c, uri, round(least(1, score), 6), 1 FROM near WHERE (c, uri) NOT IN (SELECT (c, uri) FROM anch)"
)
def d11(spark, d):
    return L.expand_relations(anchors(spark, d), edges(spark, d)).withColumn("score", F.round("score", 6))


def _levels(depth: int) -> str:
    """What is reached at each level, from all levels before it."""
    out = "WITH w AS (SELECT s AS src, o AS dst FROM fx_triples WHERE p = 'http://www.w3.org/2004/02/skos/core#broader'), b AS MATERIALIZED (SELECT src, dst FROM w UNION SELECT dst, src FROM w), l0 AS MATERIALIZED (SELECT CAST(s_suppkey % 4 AS BIGINT) AS c, 'urn:fx:supplier:#' || CAST(s_suppkey AS STRING) AS uri, (1 + s_suppkey % 10) / 10.0 AS score, 0 AS depth FROM supplier)"
    for i in range(1, depth + 1):
        seen = " UNION ALL ".join(f"SELECT c, uri FROM l{j}" for j in range(i))
        out += f", l{i} AS MATERIALIZED (SELECT n.c, n.uri, n.score, {i} AS depth FROM (SELECT c, dst AS uri, least(1, max(score * 0.35)) AS score FROM l{i - 1} JOIN b ON src = uri {'WHERE score >= 0.6' if i == 1 else ''} GROUP BY c, dst) n ANTI JOIN ({seen}) s ON s.c = n.c AND s.uri = n.uri)"
    return out + " " + " UNION ALL ".join(f"SELECT c, uri, round(score, 6) AS score, depth FROM l{i}" for i in range(depth + 1))


@Q.add("d11_relation_depth", _levels(6))
def d11d(spark, d):
    """Six levels from suppliers over nations, regions and customers, both ways."""
    e = edges(spark, d)
    both = e.select("src", "dst").union(e.select("dst", "src")).distinct()
    start = view(spark, d, "supplier").select(
        (F.col("s_suppkey") % 4).cast("long").alias("c"),
        F.concat(F.lit("urn:fx:supplier:#"), F.col("s_suppkey").cast("string")).alias("uri"),
        ((1 + F.col("s_suppkey") % 10) / 10.0).alias("score")
    )
    return L.expand_relations(start, both, depth=6).withColumn("score", F.round("score", 6))


_MATCH = f"WITH {_EDGES}, {_ANCH}, mt AS (SELECT c, uri, score, score > 0.9 AS exact FROM anch UNION ALL SELECT DISTINCT c, dst, 0.2, false FROM anch JOIN edges ON src = uri)"


@Q.add(
    "d12_relationship_boost",
    _MATCH + ", bo AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges), hit AS (SELECT DISTINCT c, dst AS uri, true AS h FROM mt JOIN bo ON src = uri WHERE score >= 0.6) SELECT c, uri, round(CASE WHEN h AND NOT exact THEN least(1.01, score + 0.35) ELSE score END, 6) AS score, coalesce(h, false) AND NOT exact AS boosted FROM mt LEFT JOIN hit USING (c, uri)"
)
def d12(spark, d):
    a, e = anchors(spark, d), edges(spark, d)
    more = a.join(e, F.col("src") == F.col("uri")).select(
        "c", F.col("dst").alias("uri"), F.lit(0.2).alias("score"), F.lit(False).alias("exact")
    ).distinct()
    return L.relationship_boost(
        a.withColumn("exact", F.col("score") > 0.9).unionByName(more), e
    ).withColumn("score", F.round("score", 6))


_NAMES = "names AS (SELECT CAST(p_partkey AS BIGINT) AS uri, p_name AS norm FROM part), qs AS (SELECT CAST(p_partkey AS BIGINT) AS c, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, ' ', '') ELSE split_part(p_name, ' ', 1) END AS norm, p_name AS spaced, p_type AS domain FROM part)"


def names(spark, d):
    p = view(spark, d, "part")
    n = p.selectExpr("CAST(p_partkey AS BIGINT) AS uri", "p_name AS norm")
    q = p.selectExpr(
        "CAST(p_partkey AS BIGINT) AS c",
        "CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, ' ', '') ELSE split_part(p_name, ' ', 1) END AS norm",
        "p_name AS spaced", "p_type AS domain"
    )
    return n, q


@Q.add(
    "d20_direct_label_match",
    f"WITH {_NAMES}, f AS (SELECT c, uri, 1 AS attempt FROM qs JOIN names USING (norm)) SELECT * FROM f UNION ALL SELECT c, uri, 2 FROM qs JOIN names ON names.norm = spaced WHERE c NOT IN (SELECT c FROM f)"
)
def d20(spark, d):
    n, q = names(spark, d)
    return L.direct_label_match(q, n)


_NEDGE = "ne AS (SELECT a.uri AS src, a.uri + 7 AS dst FROM names a WHERE a.uri % 3 = 0)"


@Q.add(
    "d21_partial_label_match",
    f"WITH {_NAMES}, {_NEDGE}, di AS (SELECT DISTINCT c, uri FROM qs JOIN names ON contains(' ' || names.norm || ' ', ' ' || qs.norm || ' ')) SELECT c, uri FROM di UNION SELECT c, dst FROM di JOIN ne ON src = uri"
)
def d21(spark, d):
    n, q = names(spark, d)
    e = n.filter("uri % 3 = 0").select(
        F.col("uri").alias("src"), F.lit("related").alias("rel"), (F.col("uri") + 7).alias("dst")
    )
    return L.partial_label_match(q, n, e)


@Q.add(
    "d22_manual_mapping",
    f"WITH {_NAMES}, m AS (SELECT c, min(uri) AS uri, 50 AS confidence FROM qs JOIN names USING (norm) GROUP BY c), man AS (SELECT c, c + 1000 AS uri FROM qs WHERE c % 20 = 0) SELECT coalesce(m.c, man.c) AS c, coalesce(man.uri, m.uri) AS uri, CASE WHEN man.uri IS NOT NULL THEN 95 ELSE confidence END AS confidence FROM m FULL JOIN man ON m.c = man.c"
)
def d22(spark, d):
    n, q = names(spark, d)
    least = n.groupBy("norm").agg(F.min("uri").alias("uri"))
    m = q.join(least, "norm").groupBy("c").agg(F.min("uri").alias("uri")).withColumn("confidence", F.lit(50))
    return L.manual_mapping(m, q.filter("c % 20 = 0").select("c", (F.col("c") + 1000).alias("uri")))


@Q.add(
    "d23_fallback_match",
    f"WITH {_NAMES}, fb AS (SELECT DISTINCT p_type AS domain, p_size AS place, p_name AS norm FROM part), hit AS (SELECT domain, place, uri FROM fb JOIN names USING (norm) QUALIFY row_number() OVER (PARTITION BY domain ORDER BY place, uri) = 1) SELECT c, uri, place FROM qs JOIN hit USING (domain)"
)
def d23(spark, d):
    n, q = names(spark, d)
    fb = view(spark, d, "part").selectExpr("p_type AS domain", "p_size AS place", "p_name AS norm").distinct()
    return L.fallback_match(q, fb, n)


_CONTRA = "con AS (SELECT * FROM (VALUES ('small', 'large'), ('red', 'blue'), ('old', 'new'), ('blue', 'red')) v(pattern, word))"


@Q.add(
    "d24_must_not_have_by_pattern",
    f"WITH {_NAMES}, {_CONTRA}, qw AS (SELECT c, norm, unnest(list_distinct(string_split(norm, ' '))) AS pattern FROM qs), nw AS (SELECT uri, norm AS label, unnest(list_distinct(string_split(norm, ' '))) AS word FROM names) SELECT DISTINCT c, uri FROM qw JOIN con USING (pattern) JOIN nw USING (word) WHERE label <> norm"
)
def d24(spark, d):
    n, q = names(spark, d)
    con = spark.sql(f"WITH {_CONTRA} SELECT * FROM con")
    return L.must_not_have_by_pattern(q, con, n)


@Q.add(
    "d25_association_boost",
    f"WITH {_NAMES}, m AS (SELECT c, uri, (uri % 10) / 10.0 AS score FROM qs JOIN names ON split_part(qs.spaced, ' ', 1) = split_part(names.norm, ' ', 1)), ac AS (SELECT DISTINCT c, n.norm FROM qs JOIN names n ON n.uri % 40 = c % 40) SELECT c, m.uri, round(CASE WHEN (c, m.uri) IN (SELECT (ac.c, names.uri) FROM ac JOIN names USING (norm)) THEN least(1, score + 0.4) ELSE score END, 6) AS score FROM m"
)
def d25(spark, d):
    """Concepts and labels of the same first word, score and associations are scored once."""
    n, q = names(spark, d)
    first = lambda x: F.split_part(x, F.lit(" "), F.lit(1)).alias("w")
    asked, q = L.classes(q.select("c", first(F.col("spaced")), (F.col("c") % 40).alias("k")), "c")
    named, labels = L.classes(
        n.select("uri", "norm", first(F.col("norm")), ((F.col("uri") % 10) / 10.0).alias("score")), "uri"
    )
    m = q.join(labels, "w").select("c", "uri", "score")
    ac = q.join(n.select("norm", (F.col("uri") % 40).alias("k")).distinct(), "k").select("c", "norm").distinct()
    scored = L.association_boost(m, ac, labels).withColumn("score", F.round("score", 6))
    return L.expand_classes(scored, asked, named)


@Q.add(
    "c13_forbidden_context",
    f"WITH {_NAMES}, m AS (SELECT c, domain, uri FROM qs JOIN names ON qs.spaced = names.norm), fo AS (SELECT DISTINCT p_type AS domain, 'small' AS word FROM part WHERE p_type IN ('PROMO', 'SMALL') UNION SELECT DISTINCT p_type, 'red' FROM part WHERE p_type = 'ECONOMY'), bad AS (SELECT DISTINCT fo.domain, uri FROM names JOIN fo ON list_contains(string_split(norm, ' '), word)) SELECT c, domain, uri FROM m WHERE (domain, uri) NOT IN (SELECT (domain, uri) FROM bad)"
)
def c13(spark, d):
    n, q = names(spark, d)
    asked, q = L.classes(q.select("c", "domain", F.col("spaced").alias("norm")), "c")
    named, n = L.classes(n, "uri")
    m = q.join(n, "norm").select("c", "domain", "uri")
    p = view(spark, d, "part")
    fo = p.filter("p_type IN ('PROMO', 'SMALL')").selectExpr("p_type AS domain", "'small' AS word").union(
        p.filter("p_type = 'ECONOMY'").selectExpr("p_type", "'red'")
    ).distinct()
    return L.expand_classes(L.forbidden_context(m, n, fo), asked, named)


_GROUPS = [("lodging", ["box", "ring"]), ("activity", ["rod", "widget"])]


@Q.add(
    "b28_domain_of",
    "SELECT p_partkey, CASE WHEN contains(p_name, 'box') OR contains(p_name, 'ring') THEN 'lodging' WHEN contains(p_name, 'rod') OR contains(p_name, 'widget') THEN 'activity' ELSE 'service' END AS domain FROM part"
)
def b28(spark, d):
    return view(spark, d, "part").select("p_partkey", L.domain_of(F.col("p_name"), _GROUPS, "service").alias("domain"))


@Q.add(
    "b27_component_types",
    f"WITH {_NAMES} SELECT c, CASE WHEN norm IN (SELECT norm FROM names) THEN 'taxonomy' WHEN regexp_matches(norm, 'small|large') AND regexp_matches(norm, 'red|blue') THEN 'colour,size' WHEN regexp_matches(norm, 'small|large') THEN 'size' WHEN regexp_matches(norm, 'red|blue') THEN 'colour' ELSE 'unknown' END AS types FROM qs"
)
def b27(spark, d):
    n, q = names(spark, d)
    return L.component_types(q, [("small|large", "size"), ("red|blue", "colour")], n)


@Q.add(
    "b31_confidence",
    "WITH x AS (SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 'direct' WHEN 1 THEN 'partial' ELSE 'weak' END AS kind, o_orderkey % 5 = 0 AS exact, (o_custkey % 100) / 100.0 AS sim, (o_custkey % 10) / 10.0 AS ov, o_orderkey % 3 AS nw FROM orders), b AS (SELECT *, CASE WHEN nw <= 1 AND ov < 0.1 AND kind <> 'direct' THEN 1 WHEN kind = 'direct' THEN 90 WHEN kind = 'partial' THEN 60 ELSE 1 END AS lo, CASE WHEN nw <= 1 AND ov < 0.1 AND kind <> 'direct' THEN 39 WHEN kind = 'direct' THEN 95 WHEN kind = 'partial' THEN 75 ELSE 39 END AS hi FROM x) SELECT id, CAST(greatest(0, least(100, round_even((CASE WHEN exact THEN hi ELSE (lo + hi) / 2 END + (hi - lo) / 2 * ov) * sim, 0))) AS INT) AS confidence FROM b"
)
def b31(spark, d):
    x = view(spark, d, "orders").selectExpr(
        "o_orderkey AS id", "CASE o_orderkey % 3 WHEN 0 THEN 'direct' WHEN 1 THEN 'partial' ELSE 'weak' END AS kind",
        "o_orderkey % 5 = 0 AS exact", "CAST(o_custkey % 100 AS DOUBLE) / 100 AS sim",
        "CAST(o_custkey % 10 AS DOUBLE) / 10 AS ov", "o_orderkey % 3 AS nw"
    )
    return x.select("id", L.confidence(*(F.col(c) for c in ("kind", "exact", "sim", "ov", "nw"))).alias("confidence"))


@Q.add(
    "e31_mapping_weights",
    "WITH r AS (SELECT p_type AS theme, 1.0 + length(p_type) AS base, p_name AS c, CAST(p_partkey AS BIGINT) AS uri, p_size AS confidence FROM part), b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY theme, c ORDER BY confidence DESC, uri) = 1), t AS (SELECT theme, max(base) AS base, sum(confidence) AS total FROM b GROUP BY theme) SELECT theme, round(t.base / (SELECT sum(base) FROM t), 6) AS theme_weight, c, round(confidence / total, 6) AS concept_weight, uri AS best_uri FROM b JOIN t USING (theme)"
)
def e31(spark, d):
    r = view(spark, d, "part").selectExpr(
        "p_type AS theme", "CAST(1 + length(p_type) AS DOUBLE) AS base", "p_name AS c",
        "CAST(p_partkey AS BIGINT) AS uri", "p_size AS confidence"
    )
    return L.mapping_weights(r).withColumn("theme_weight", F.round("theme_weight", 6)).withColumn(
        "concept_weight", F.round("concept_weight", 6)
    )


@Q.add(
    "e36_theme_rollup",
    "SELECT theme, p_name AS name, count(*) OVER (PARTITION BY theme) AS n_names, 1 AS minimum_count, effect FROM (SELECT DISTINCT theme, p_name, CASE WHEN rule = 'Must have 1' THEN 'pass' ELSE 'boost' END AS effect FROM fx_themes JOIN part ON p_size = theme_id AND p_size <> 9) UNION ALL SELECT theme, NULL, 0, 1, 'pass' FROM fx_themes WHERE rule = 'Must have 1' AND theme_id NOT IN (SELECT p_size FROM part WHERE p_size <> 9)"
)
def e36(spark, d):
    t = view(spark, d, "fx_themes")
    a = t.select("theme", "theme_id").join(
        view(spark, d, "part").filter("p_size <> 9"), F.col("p_size") == F.col("theme_id")
    ).select("theme", F.col("p_name").alias("name"))
    return L.theme_rollup(t, a)
