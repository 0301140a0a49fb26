"""Queries of stage two: from assignments to definitions."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from ..functions.text import jaccard_words
from ..operators import definition as D
from . import q_candidates as A
from .fixtures import Registry, view
from ..stages import staged

Q = Registry()

THEMES = 15
FLOORS = {"sub 0": 0.10, "sub 9": 0.05}
LOCATION_NS = ["urn:fx:src3:"]

# every fourth candidate has no theme; the others get the theme of their rank
ASSIGN = A.RANKED + f", th AS (SELECT * FROM fx_themes), asg AS (SELECT c, uri, 'theme ' || CAST(rank % {THEMES} AS STRING) AS theme FROM ranked WHERE rank % 4 <> 0), neg AS (SELECT c, uri FROM ranked WHERE rank % 11 = 0), kept AS (SELECT * FROM asg WHERE (c, uri) NOT IN (SELECT (c, uri) FROM neg))"
CONFIG = ASSIGN + ", ov AS (SELECT c, theme, 20.0 AS weight, CAST(NULL AS STRING) AS rule FROM (SELECT DISTINCT c FROM ranked), th WHERE theme_id = c % 15), cfg AS (SELECT q.c, t.theme, CAST(coalesce(ov.weight, base_weight) AS DOUBLE) AS weight, CASE WHEN t.rule IN ('Must have 1', 'Optional') THEN t.rule ELSE 'Optional' END AS rule, subscore FROM (SELECT DISTINCT c FROM ranked) q CROSS JOIN th t LEFT JOIN ov ON ov.c = q.c AND ov.theme = t.theme)"
WEIGHTS = CONFIG + """, act AS (SELECT DISTINCT c, theme FROM kept), nw AS (SELECT cfg.*, weight / sum(weight) OVER (PARTITION BY c) AS norm_weight, a.theme IS NOT NULL AS is_on FROM cfg LEFT JOIN act a USING (c, theme)),
tw AS (SELECT *, CASE WHEN is_on THEN norm_weight / sum(CASE WHEN is_on THEN norm_weight ELSE 0 END) OVER (PARTITION BY c) ELSE 0 END AS w FROM nw)"""
ATTRS = WEIGHTS + """, aw AS (SELECT c, theme, uri, round(tw.w * greatest(1e-9, combined) / sum(greatest(1e-9, combined)) OVER (PARTITION BY c, theme), 6) AS concept_weight FROM kept JOIN tw USING (c, theme) JOIN ranked USING (c, uri)),
aw2 AS (SELECT * FROM aw WHERE concept_weight >= 0.001), un AS (SELECT c, uri, max(concept_weight) AS concept_weight, max(combined) AS score FROM aw2 JOIN ranked USING (c, uri) GROUP BY c, uri)"""
_SET = r"list_distinct(list_filter(string_split_regex(lower({0}), '\s+'), lambda x: x <> ''))"
TOP = ATTRS + f""", anchors AS (SELECT c, uri AS anchor_uri FROM ranked WHERE rank = 1), nearest AS (SELECT r.c, r.uri, combined, {_SET.format('q.concept')} AS x, {_SET.format('d.pref_label')} AS y FROM ranked r JOIN fx_queries q ON q.c = r.c JOIN fx_docs d ON d.uri = r.uri WHERE rank > 1),
variants AS (SELECT c, uri FROM nearest WHERE len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))) >= 0.1 QUALIFY row_number() OVER (PARTITION BY c ORDER BY combined DESC, uri) <= 3), core AS (SELECT c, anchor_uri AS uri FROM anchors UNION SELECT * FROM variants),
forced AS (SELECT c, uri, 0.05 AS concept_weight, combined AS score, true AS forced FROM core JOIN ranked USING (c, uri) WHERE (c, uri) NOT IN (SELECT (c, uri) FROM un)),
tops AS (SELECT c, uri, concept_weight, score, forced, row_number() OVER (PARTITION BY c ORDER BY round(score, 9) DESC, uri) AS rank FROM (SELECT c, uri, concept_weight, score, false AS forced FROM un UNION ALL SELECT * FROM forced) QUALIFY rank <= 25)"""


class Stage:
    """The tables of stage two, built once a query."""

    def __init__(self, spark, d):
        self.spark, self.d = spark, d
        self.ranked = staged(A.ranked(spark, d), "ranked")
        self.themes = view(spark, d, "fx_themes")
        self.concepts = self.ranked.select("c").distinct()
        sent = self.ranked.filter(F.col("rank") % 4 != 0)
        self.assigned = sent.select(
            "c", "uri", F.concat(F.lit("theme "), (F.col("rank") % THEMES).cast("string")).alias("theme")
        )
        self.negated = self.ranked.filter(F.col("rank") % 11 == 0).select("c", "uri")
        self.kept = D.exclude(self.assigned, self.negated)

    def config(self):
        over = F.broadcast(self.themes).join(self.concepts, F.col("theme_id") == F.col("c") % THEMES).select(
            "c", "theme", F.lit(20.0).alias("weight"), F.lit(None).cast("string").alias("rule")
        )
        return D.theme_config(self.concepts, self.themes, over)

    def weights(self):
        return D.redistribute(self.config(), self.kept)

    @cached_property
    def _attributes(self):
        return staged(D.attribute_weights(self.kept, self.weights(), self.ranked), "attributes")

    def attributes(self):
        return self._attributes

    def anchors(self):
        return self.ranked.filter("rank = 1").select(
            "c", F.col("uri").alias("anchor_uri"), F.lit("Top ranked").alias("method")
        )

    def core(self):
        q = view(self.spark, self.d, "fx_queries").select("c", "concept")
        labels = view(self.spark, self.d, "fx_docs").select("uri", "pref_label")
        r = self.ranked.join(q, "c").join(labels, "uri")
        return D.core_uris(r, self.anchors(), jaccard_words(F.col("concept"), F.col("pref_label")), threshold=0.1)

    def top(self):
        return D.top_defining(D.dedupe_attributes(self.attributes(), self.ranked), self.core(), self.ranked)

    def theme_subscores(self):
        return self.themes.filter("subscore IS NOT NULL").select("theme", "subscore", F.lit(1.0).alias("factor"))

    def subs(self):
        types = self.concepts.join(view(self.spark, self.d, "fx_overrides").select("c", "property_type"), "c", "left")
        return D.subscores(self.weights(), self.theme_subscores(), types, FLOORS)


@Q.add("e06_theme_config", CONFIG + " SELECT * FROM cfg")
def e06(spark, d):
    return Stage(spark, d).config()


@Q.add("c12_exclude_must_not_have", ASSIGN + " SELECT * FROM kept")
def c12(spark, d):
    return Stage(spark, d).kept


@Q.add("d15_validate_assignments", ASSIGN + """, sent AS (SELECT c, uri FROM ranked WHERE rank <= 30), ret AS (SELECT c, uri, CASE WHEN rank % 7 = 0 THEN 'no such theme' ELSE 'theme ' || CAST(rank % 15 AS STRING) END AS theme FROM ranked WHERE rank BETWEEN 5 AND 35),
j AS (SELECT c, uri, r.theme, CASE WHEN s.uri IS NULL THEN 'extra' WHEN r.uri IS NULL THEN 'missing' WHEN t.theme IS NULL THEN 'unknown theme' END AS problem FROM (SELECT *, uri AS u FROM sent) s FULL JOIN ret r USING (c, uri) LEFT JOIN th t ON t.theme = r.theme) SELECT c, uri, theme, coalesce(problem, 'ok') AS problem FROM j""".replace("s.uri IS NULL", "s.u IS NULL").replace("r.uri IS NULL", "r.theme IS NULL"))
def d15(spark, d):
    s = Stage(spark, d)
    back = s.ranked.filter("rank BETWEEN 5 AND 35").select(
        "c", "uri",
        F.when(F.col("rank") % 7 == 0, "no such theme").otherwise(
            F.concat(F.lit("theme "), (F.col("rank") % THEMES).cast("string"))
        ).alias("theme")
    )
    good, issues = D.validate_assignments(s.ranked.filter("rank <= 30"), back, s.themes)
    return good.withColumn("problem", F.lit("ok")).unionByName(issues)


@Q.add(
    "d10_known_negations",
    ASSIGN + ", conf AS (SELECT c, uri FROM fx_filters), found AS (SELECT c, uri || CASE WHEN c % 2 = 0 THEN '' ELSE '?' END AS uri FROM neg), k AS (SELECT c, uri, 'Found' AS scope FROM found WHERE uri IN (SELECT uri FROM fx_docs) UNION ALL SELECT c, uri, 'Config Override' FROM conf) SELECT c, uri, min(scope) AS scope FROM k GROUP BY c, uri"
)
def d10(spark, d):
    s = Stage(spark, d)
    found = s.negated.select("c", F.concat("uri", F.when(F.col("c") % 2 == 0, "").otherwise("?")).alias("uri"))
    return D.merge_negations(view(spark, d, "fx_filters"), found, view(spark, d, "fx_docs"))


@Q.add(
    "e07_theme_weights",
    WEIGHTS + " SELECT c, theme, round(norm_weight, 6) AS norm_weight, round(w, 6) AS weight FROM tw"
)
def e07(spark, d):
    return Stage(spark, d).weights().select(
        "c", "theme", F.round("norm_weight", 6).alias("norm_weight"), F.round("weight", 6).alias("weight")
    )


@Q.add(
    "e08_attribute_weights",
    ATTRS + " SELECT c, theme, uri, concept_weight, rank % 9 = 0 AS is_fallback FROM aw2 JOIN ranked USING (c, uri)"
)
def e08(spark, d):
    """Some assignments come from second replies, which leave a comment."""
    s = Stage(spark, d)
    second = s.ranked.filter("rank % 9 = 0").select("c", "uri", F.lit("Fallback Assignment").alias("comment"))
    return D.attribute_weights(s.kept.join(second, ["c", "uri"], "left"), s.weights(), s.ranked)


@Q.add(
    "f06_per_theme_cap",
    ATTRS + " SELECT c, theme, uri, row_number() OVER (PARTITION BY c, theme ORDER BY round(combined, 6) DESC, concept_weight DESC, uri) AS rank FROM (SELECT aw2.*, combined FROM aw2 JOIN ranked USING (c, uri)) QUALIFY rank <= 3"
)
def f06(spark, d):
    s = Stage(spark, d)
    scored = s.attributes().join(
        s.ranked.select("c", "uri", F.round("combined_score", 6).alias("confidence")), ["c", "uri"]
    )
    return D.per_theme_cap(scored, 3).select("c", "theme", "uri", F.col("rank").cast("long").alias("rank"))


@Q.add("e12_dedupe_attributes", ATTRS + " SELECT c, uri, concept_weight, round(score, 4) AS score FROM un")
def e12(spark, d):
    s = Stage(spark, d)
    return D.dedupe_attributes(s.attributes(), s.ranked).select(
        "c", "uri", "concept_weight", F.round("score", 4).alias("score")
    )


@Q.add("f04_core_variants", TOP + " SELECT * FROM core")
def f04(spark, d):
    return Stage(spark, d).core()


@Q.add("f05_top_defining", TOP + " SELECT c, uri, rank, forced, concept_weight FROM tops")
def f05(spark, d):
    return Stage(spark, d).top().select(
        "c", "uri", F.col("rank").cast("long").alias("rank"), "forced", "concept_weight"
    )


_HINTS = "hints AS (SELECT uri, CASE WHEN doc_id % 3 = 0 THEN 'CL' WHEN doc_id % 3 = 1 THEN 'VR' ELSE 'Both' END AS kind FROM fx_docs WHERE doc_id % 5 < 4)"


@Q.add(
    "e13_lodging_type",
    TOP + f", {_HINTS}, v AS (SELECT c, anchor_uri AS uri, 2 AS v FROM anchors UNION ALL SELECT c, uri, 1 FROM tops WHERE rank <= 10), vs AS (SELECT c, sum(CASE WHEN kind = 'CL' THEN v ELSE 0 END) AS cl, sum(CASE WHEN kind = 'VR' THEN v ELSE 0 END) AS vr, count(*) AS n FROM v LEFT JOIN hints USING (uri) GROUP BY c) SELECT c, CASE WHEN cl > vr AND cl / n >= 0.6 THEN 'CL' WHEN vr > cl AND vr / n >= 0.6 THEN 'VR' ELSE 'Both' END AS lodging_type FROM vs"
)
def e13(spark, d):
    s = Stage(spark, d)
    hints = view(spark, d, "fx_docs").filter("doc_id % 5 < 4").selectExpr(
        "uri", "CASE WHEN doc_id % 3 = 0 THEN 'CL' WHEN doc_id % 3 = 1 THEN 'VR' ELSE 'Both' END AS kind"
    )
    return D.lodging_type(s.anchors(), s.top(), hints)


@Q.add(
    "e14_unthemed_capture",
    TOP + ", p AS (SELECT c, quantile_cont(combined, 0.75) AS cut FROM ranked GROUP BY c) SELECT c, uri, round(combined, 6) AS combined_score FROM ranked JOIN p USING (c) WHERE combined >= cut AND combined > 0 AND (c, uri) NOT IN (SELECT (c, uri) FROM asg) AND (c, uri) NOT IN (SELECT (c, uri) FROM neg) AND (c, uri) NOT IN (SELECT (c, uri) FROM forced)"
)
def e14(spark, d):
    s = Stage(spark, d)
    return D.unthemed(s.ranked, s.assigned, s.negated, s.top().filter("forced"))


SUBS = WEIGHTS + """, ss AS (SELECT c, subscore, sum(w) AS w FROM tw WHERE is_on AND subscore IS NOT NULL GROUP BY c, subscore), fl AS (SELECT o.c, f.subscore, f.floor FROM fx_overrides o, (VALUES ('sub 0', 0.10), ('sub 9', 0.05)) f(subscore, floor) WHERE property_type = 'rental' AND o.c IN (SELECT c FROM ss)),
sj AS (SELECT c, subscore, coalesce(w, 1e-6) AS w, floor FROM ss FULL JOIN fl USING (c, subscore)), sh AS (SELECT c, subscore, greatest(w / sum(w) OVER (PARTITION BY c), coalesce(CAST(floor AS DOUBLE), 0)) AS s FROM sj), subs AS (SELECT c, subscore, round(s / sum(s) OVER (PARTITION BY c), 6) AS weight FROM sh)"""


@Q.add("e09_subscore_weights", SUBS + " SELECT c, subscore, weight FROM subs")
def e09(spark, d):
    return Stage(spark, d).subs()


@Q.add(
    "e15_affinity_score",
    TOP.replace(WEIGHTS, SUBS) + " SELECT c, round(0.6 * least(1, (SELECT sum(weight) FROM subs s WHERE s.c = t.c)) + 0.4 * least(1, sum(concept_weight)), 4) AS affinity_score FROM tops t GROUP BY c"
)
def e15(spark, d):
    s = Stage(spark, d)
    return D.affinity_score(s.concepts, s.subs(), s.top()).withColumn("affinity_score", F.round("affinity_score", 4))


@Q.add(
    "e16_requires_geo_check",
    TOP.replace(WEIGHTS, SUBS) + " SELECT c, c IN (SELECT c FROM subs WHERE subscore = 'sub 2') OR c IN (SELECT c FROM aw2 WHERE theme = 'theme 3') OR starts_with(anchor_uri, 'urn:fx:src3:') AS requires_geo_check FROM anchors"
)
def e16(spark, d):
    s = Stage(spark, d)
    return D.requires_geo_check(s.concepts, s.subs(), s.attributes(), s.anchors(), ["sub 2"], "theme 3", LOCATION_NS)


_STATUS = WEIGHTS.replace(
    ", nw AS",
    ", fail AS (SELECT c, theme FROM cfg WHERE rule = 'Must have 1' AND (c, theme) NOT IN (SELECT (c, theme) FROM act)), nw AS"
)


@Q.add(
    "e17_mandatory_theme_check",
    CONFIG + " SELECT c, theme FROM cfg WHERE rule = 'Must have 1' AND (c, theme) NOT IN (SELECT (c, theme) FROM kept JOIN ranked USING (c, uri) WHERE rank <= 8)"
)
def e17(spark, d):
    s = Stage(spark, d)
    return D.mandatory_failures(s.config(), s.kept.join(s.ranked.filter("rank <= 8"), ["c", "uri"], "left_semi"))


@Q.add(
    "e18_theme_status",
    ATTRS + ", a AS (SELECT c, theme, count(*) AS n FROM kept GROUP BY ALL), b AS (SELECT c, theme, count(*) AS n FROM aw2 GROUP BY ALL) SELECT c, theme, coalesce(a.n, 0) AS n_assigned, coalesce(b.n, 0) AS n_weighted, CASE WHEN b.n > 0 THEN 'Processed' WHEN a.n > 0 THEN 'All filtered' ELSE 'No assignment' END AS status, rule = 'Must have 1' AND a.n IS NULL AS rule_failed FROM cfg LEFT JOIN a USING (c, theme) LEFT JOIN b USING (c, theme)"
)
def e18(spark, d):
    s = Stage(spark, d)
    return D.theme_status(s.config(), s.kept, s.attributes())


@Q.add(
    "e19_definition_status",
    TOP.replace(WEIGHTS, _STATUS) + " SELECT c, CASE WHEN c % 5 = 4 THEN 'Failed' WHEN c IN (SELECT c FROM fail) THEN 'Success with Failed Rules' WHEN c NOT IN (SELECT c FROM tops) THEN 'Warning - No Final Attributes' ELSE 'Success' END AS status FROM anchors"
)
def e19(spark, d):
    s = Stage(spark, d)
    return D.definition_status(
        s.concepts, D.mandatory_failures(s.config(), s.kept), s.top(), s.concepts.filter("c % 5 = 4")
    )


@Q.add(
    "e29_normalise_joint",
    SUBS + ", i AS (SELECT c, 'theme' AS kind, theme AS name, w AS weight FROM tw UNION ALL SELECT c, 'subscore', subscore, weight FROM subs) SELECT c, kind, name, round(weight / sum(weight) OVER (PARTITION BY c), 5) AS weight FROM i"
)
def e29(spark, d):
    s = Stage(spark, d)
    items = s.weights().select("c", F.lit("theme").alias("kind"), F.col("theme").alias("name"), "weight").unionByName(
        s.subs().select("c", F.lit("subscore").alias("kind"), F.col("subscore").alias("name"), "weight")
    )
    return D.normalise_joint(items).withColumn("weight", F.round("weight", 5))


@Q.add(
    "e30_normalise_residual",
    ATTRS + ", x AS (SELECT c, theme, uri, round(tw.w, 4) AS target, round(round(tw.w, 4) * concept_weight / sum(concept_weight) OVER (PARTITION BY c, theme), 4) AS w FROM aw2 JOIN tw USING (c, theme)) SELECT c, theme, round(sum(w) + max(target) - sum(w), 4) AS total, count(*) AS n FROM x GROUP BY c, theme"
)
def e30(spark, d):
    s = Stage(spark, d)
    w = s.weights().select("c", "theme", F.round("weight", 4).alias("target"))
    out = D.normalise_residual(s.attributes().withColumnRenamed("concept_weight", "raw"), w)
    return out.groupBy("c", "theme").agg(F.round(F.sum("weight"), 4).alias("total"), F.count(F.lit(1)).alias("n"))


_PLACE = "row_number() OVER (PARTITION BY c ORDER BY {0}) - 1"
_WHOLE = TOP.replace(WEIGHTS, SUBS) + f""", af AS (SELECT c, 0.6 * least(1, (SELECT sum(weight) FROM subs s WHERE s.c = t.c)) + 0.4 * least(1, sum(concept_weight)) AS w FROM tops t GROUP BY c),
pc AS (SELECT c, quantile_cont(combined, 0.75) AS cut FROM ranked GROUP BY c), lo AS (SELECT c, uri, round(combined, 6) AS w FROM ranked JOIN pc USING (c) WHERE combined >= cut AND combined > 0 AND (c, uri) NOT IN (SELECT (c, uri) FROM asg) AND (c, uri) NOT IN (SELECT (c, uri) FROM neg) AND (c, uri) NOT IN (SELECT (c, uri) FROM forced)),
parts AS (SELECT 'definition' AS kind, c, 0 AS i, NULL AS uri, NULL AS label, w FROM af UNION ALL SELECT 'top', c, rank - 1, uri, NULL, concept_weight FROM tops UNION ALL SELECT 'theme', c, {_PLACE.format('theme')}, NULL, theme, w FROM tw
UNION ALL SELECT 'in theme ' || theme, c, row_number() OVER (PARTITION BY c, theme ORDER BY concept_weight DESC, uri) - 1, uri, NULL, concept_weight FROM aw2 UNION ALL SELECT 'unthemed', c, {_PLACE.format('w DESC, uri')}, uri, NULL, w FROM lo
UNION ALL SELECT 'subscore', c, {_PLACE.format('weight DESC, subscore')}, NULL, subscore, weight FROM subs)"""


@Q.add(
    "e20_assemble_definition",
    _WHOLE + " SELECT kind, q.concept, i, p.uri, coalesce(p.label, d.pref_label) AS label, round(w, 4) AS w FROM parts p JOIN fx_queries q ON q.c = p.c LEFT JOIN fx_docs d ON d.uri = p.uri"
)
def e20(spark, d):
    """The nested definitions, compared array by array."""
    from .q_validation import parts_of

    return parts_of(assembled(spark, d)).withColumn("w", F.round("w", 4))


@Q.add(
    "e20_definition_heads",
    TOP.replace(
        WEIGHTS,
        SUBS.replace(
            ", nw AS",
            ", fail AS (SELECT c, theme FROM cfg WHERE rule = 'Must have 1' AND (c, theme) NOT IN (SELECT (c, theme) FROM act)), nw AS"
        )
    ) + " SELECT q.concept, anchor_uri, round(combined, 4) AS combined_score, (SELECT count(*) FROM neg WHERE neg.c = a.c) AS n_not, CASE WHEN a.c IN (SELECT c FROM fail) THEN 'Success with Failed Rules' ELSE 'Success' END AS status, (SELECT count(*) FROM fail WHERE fail.c = a.c) AS n_failed FROM anchors a JOIN fx_queries q ON q.c = a.c JOIN ranked r ON r.c = a.c AND r.uri = a.anchor_uri"
)
def e20h(spark, d):
    out = assembled(spark, d)
    return out.select(
        F.col("input_concept").alias("concept"), F.col("travel_category.uri").alias("anchor_uri"),
        F.round("travel_category.combined_score", 4).alias("combined_score"),
        F.size("must_not_have").cast("long").alias("n_not"), F.col("processing_metadata.status").alias("status"),
        F.size("failed_fallback_themes").cast("long").alias("n_failed")
    )


def assembled(spark, d):
    """The definitions that the generator ends with, in the schema that files and triples take."""
    s = Stage(spark, d)
    top, subs, config = staged(s.top(), "top"), staged(s.subs(), "subs"), s.config()
    failures = D.mandatory_failures(config, s.kept)
    labels = view(spark, d, "fx_docs").select(
        "uri", F.col("pref_label").alias("label"), F.array("source").alias("types")
    )
    concepts = view(spark, d, "fx_queries").select("c", "concept").join(s.concepts, "c")
    geo = D.requires_geo_check(s.concepts, subs, s.attributes(), s.anchors(), ["sub 2"], "theme 3", LOCATION_NS)
    hints = view(spark, d, "fx_docs").selectExpr(
        "uri", "CASE WHEN doc_id % 3 = 0 THEN 'CL' WHEN doc_id % 3 = 1 THEN 'VR' ELSE 'Both' END AS kind"
    )
    loose = D.unthemed(s.ranked, s.assigned, s.negated, top.filter("forced"))
    run = D.theme_status(config, s.kept, s.attributes())
    return D.assemble(
        concepts, s.anchors(), s.ranked, top, config, s.weights(), s.attributes(), loose, subs, s.negated.withColumn(
            "scope", F.lit("Found")
        ), D.lodging_type(s.anchors(), top, hints), geo,
        D.affinity_score(s.concepts, subs, top), failures, D.definition_status(
            s.concepts, failures, top
        ), run, labels, version="1",
    )
