"""Stage two: themes, attribute weights, subscores and the assembled definition.

All concepts are treated at once; windows over the concept share one exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import normalize_concept
from .retrieval import top_k

MUST = "Must have 1"


def theme_config(concepts: DataFrame, themes: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """(c, theme, weight, rule, subscore): themes of every concept, overlaid by overrides (c,
    theme, weight, rule).  An unknown rule is Optional, a missing weight 0."""
    df = concepts.select("c").distinct().join(F.broadcast(themes))
    if overrides is None:
        df = df.select("*", F.lit(None).cast("double").alias("o_weight"), F.lit(None).cast("string").alias("o_rule"))
    else:
        df = df.join(
            F.broadcast(
                overrides.select("c", "theme", F.col("weight").alias("o_weight"), F.col("rule").alias("o_rule"))
            ),
            ["c", "theme"], "left"
        )
    rule = F.coalesce("o_rule", "rule")
    return df.select(
        "c", "theme", F.coalesce("o_weight", "base_weight", F.lit(0.0)).alias("weight"),
        F.when(rule.isin(MUST, "Optional"), rule).otherwise("Optional").alias("rule"), "subscore"
    )


def validate_assignments(sent: DataFrame, returned: DataFrame, themes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(assignments [c, uri, theme], issues [c, uri, theme, problem]) of what was sent (c, uri)
    and what came back (c, uri, theme): unknown URIs are ignored, missing ones get no theme,
    unknown themes are dropped; each is reported."""
    known = F.broadcast(themes.select("theme", F.lit(True).alias("is_theme")))
    both = sent.select("c", "uri", F.lit(True).alias("was_sent")).join(
        returned.select("c", "uri", "theme", F.lit(True).alias("was_returned")), ["c", "uri"], "full_outer"
    ).join(known, "theme", "left")
    problem = F.when(F.col("was_sent").isNull(), "extra").when(F.col("was_returned").isNull(), "missing").when(
        F.col("is_theme").isNull() & F.col("theme").isNotNull(), "unknown theme"
    )
    marked = both.withColumn("problem", problem)
    return marked.filter(
        "problem IS NULL AND theme IS NOT NULL"
    ).select("c", "uri", "theme").distinct(), marked.filter("problem IS NOT NULL").select(
        "c", "uri", "theme", "problem"
    )


def exclude(assignments: DataFrame, negated: DataFrame) -> DataFrame:
    """Assignments without the URIs that the concept must not have."""
    return assignments.join(negated.select("c", "uri").distinct(), ["c", "uri"], "left_anti")


def merge_negations(configured: DataFrame, found: DataFrame, known: DataFrame) -> DataFrame:
    """(c, uri, scope): configured and found URIs; the configured scope wins; found URIs must be known."""
    ok = found.join(
        known.select("uri").distinct(), "uri", "left_semi"
    ).select("c", "uri", F.lit("Found").alias("scope"))
    both = configured.select("c", "uri", F.lit("Config Override").alias("scope")).unionByName(ok)
    return both.groupBy("c", "uri").agg(F.min("scope").alias("scope"))


def redistribute(config: DataFrame, active: DataFrame) -> DataFrame:
    """(c, theme, norm_weight, weight): weights as shares; what inactive themes had goes to the
    active ones in proportion; inactive themes get 0."""
    df = config.join(
        active.select("c", "theme").distinct().withColumn("is_active", F.lit(True)), ["c", "theme"], "left"
    )
    by = W.partitionBy("c")
    total, on = F.sum("weight").over(by), F.coalesce("is_active", F.lit(False))
    df = df.withColumn("norm_weight", F.when(total > 0, F.col("weight") / total).otherwise(0.0)).withColumn("on", on)
    act = F.sum(F.when(F.col("on"), F.col("norm_weight")).otherwise(0.0)).over(by)
    return df.select(
        "c", "theme", "rule", "subscore", "norm_weight", "on",
        F.when(F.col("on") & (act > 0), F.col("norm_weight") / act).otherwise(0.0).alias("weight")
    )


def attribute_weights(
    assignments: DataFrame, theme_weights: DataFrame, candidates: DataFrame, min_weight: float = 0.001
) -> DataFrame:
    """(c, theme, uri, concept_weight, is_fallback): each theme's weight by the candidates' scores
    (at least 1e-9), in equal parts if there are none; rounded to 6, small ones dropped.
    is_fallback: the assignment has a comment, as second replies have."""
    fallback = F.col("comment").isNotNull() if "comment" in assignments.columns else F.lit(False)
    assignments = assignments.select("c", "uri", "theme", fallback.alias("is_fallback"))
    df = assignments.join(theme_weights.select("c", "theme", "weight"), ["c", "theme"]).join(
        candidates.select("c", "uri", "combined_score"), ["c", "uri"]
    )
    by = W.partitionBy("c", "theme")
    score = F.greatest(F.lit(1e-9), F.coalesce("combined_score", F.lit(0.0)))
    total, n = F.sum(score).over(by), F.count(F.lit(1)).over(by)
    w = F.when(total < 1e-9, F.col("weight") / n).otherwise(F.col("weight") * score / total)
    return df.select(
        "c", "theme", "uri", F.round(w, 6).alias("concept_weight"), "is_fallback"
    ).filter(F.col("concept_weight") >= min_weight)


def dedupe_attributes(weights: DataFrame, candidates: DataFrame) -> DataFrame:
    """(c, uri, concept_weight, score): a URI's largest weight over its themes."""
    df = weights.join(candidates.select("c", "uri", F.col("combined_score").alias("score")), ["c", "uri"])
    return df.groupBy("c", "uri").agg(F.max("concept_weight").alias("concept_weight"), F.max("score").alias("score"))


def core_uris(
    ranked: DataFrame, anchors: DataFrame, similarity: Column, variants: int = 3, threshold: float = 0.90
) -> DataFrame:
    """(c, uri): anchor, and the first `variants` candidates whose label is close to the concept."""
    near = ranked.join(anchors.select("c", "anchor_uri"), "c").filter(
        (F.col("uri") != F.col("anchor_uri")) & (similarity >= threshold)
    )
    near = top_k(near, variants, [F.desc("combined_score"), F.asc("uri")])
    return anchors.select("c", F.col("anchor_uri").alias("uri")).unionByName(near.select("c", "uri")).distinct()


def top_defining(
    attributes: DataFrame, core: DataFrame, candidates: DataFrame, n: int = 25, forced: float = 0.05
) -> DataFrame:
    """(c, uri, concept_weight, score, forced, rank): attributes by score; core URIs that are
    missing are forced in with a fixed weight."""
    add = core.join(attributes.select("c", "uri"), ["c", "uri"], "left_anti").join(
        candidates.select("c", "uri", F.col("combined_score").alias("score")), ["c", "uri"]
    )
    both = attributes.select("c", "uri", "concept_weight", "score", F.lit(False).alias("forced")).unionByName(
        add.select("c", "uri", F.lit(forced).alias("concept_weight"), "score", F.lit(True).alias("forced"))
    )
    return top_k(both, n, [F.desc(F.round("score", 9)), F.asc("uri")], rank="rank")


def lodging_type(
    anchors: DataFrame, top: DataFrame, hints: DataFrame, n: int = 10, threshold: float = 0.6
) -> DataFrame:
    """(c, lodging_type): votes of the anchor (2) and the first attributes (1) for the kinds of
    the hints (uri, kind in CL, VR, Both); the larger side needs `threshold` a vote checked."""
    votes = anchors.select("c", F.col("anchor_uri").alias("uri"), F.lit(2).alias("v")).unionByName(
        top.filter(F.col("rank") <= n).select("c", "uri", F.lit(1).alias("v"))
    )
    one = hints.groupBy("uri").agg(
        F.min(F.when(F.col("kind") == "CL", 0).when(F.col("kind") == "VR", 1).otherwise(2)).alias("k")
    )
    j = votes.join(one, "uri", "left")
    side = lambda k: F.sum(F.when(F.col("k") == k, F.col("v")).otherwise(0))
    s = j.groupBy("c").agg(side(0).alias("cl"), side(1).alias("vr"), F.count(F.lit(1)).alias("n"))
    cl, vr, m = F.col("cl"), F.col("vr"), F.col("n")
    return s.select(
        "c",
        F.when(
            (cl > vr) & (cl / m >= threshold), "CL"
        ).when((vr > cl) & (vr / m >= threshold), "VR").otherwise("Both").alias("lodging_type")
    )


def unthemed(
    candidates: DataFrame, assignments: DataFrame, excluded: DataFrame, promoted: DataFrame, percentile: float = 0.75
) -> DataFrame:
    """(c, uri, combined_score): candidates in no theme whose score reaches the concept's percentile."""
    cut = candidates.withColumn("cut", F.percentile("combined_score", percentile).over(W.partitionBy("c")))
    out = cut.filter((F.col("combined_score") >= F.col("cut")) & (F.col("combined_score") > 0))
    for gone in (assignments, excluded, promoted):
        out = out.join(gone.select("c", "uri").distinct(), ["c", "uri"], "left_anti")
    return out.select("c", "uri", F.round("combined_score", 6).alias("combined_score"))


def subscores(
    weights: DataFrame, theme_subscores: DataFrame, concepts: DataFrame, floors: dict[str, float] | None = None,
    floored_type: str = "rental"
) -> DataFrame:
    """(c, subscore, weight): active theme weights times subscore factors, as shares; concepts
    (c, property_type) of the floored type get floors and are normalised again."""
    s = weights.filter("on").select("c", "theme", "weight").join(
        F.broadcast(theme_subscores), "theme"
    ).groupBy("c", "subscore").agg(F.sum(F.col("weight") * F.col("factor")).alias("w"))
    by = W.partitionBy("c")
    if floors:
        dim = F.explode(
            F.array(*(F.struct(F.lit(k).alias("subscore"), F.lit(v).alias("floor")) for k, v in sorted(floors.items())))
        )
        need = concepts.filter(
            F.col("property_type") == floored_type
        ).select("c", dim.alias("f")).select("c", "f.subscore", "f.floor")
        have = s.select("c").distinct()
        s = s.join(
            need.join(have, "c", "left_semi"), ["c", "subscore"], "full_outer"
        ).select("c", "subscore", F.coalesce("w", F.lit(1e-6)).alias("w"), "floor")
    else:
        s = s.withColumn("floor", F.lit(None).cast("double"))
    total = F.sum("w").over(by)
    s = s.withColumn(
        "share", F.when(total > 1e-9, F.col("w") / total).otherwise(0.0)
    ).withColumn("share", F.greatest("share", F.coalesce("floor", F.lit(0.0))))
    s = s.withColumn("share", F.col("share") / F.sum("share").over(by))
    return s.filter(F.col("share") > 1e-9).select("c", "subscore", F.round("share", 6).alias("weight"))


def affinity_score(concepts: DataFrame, subs: DataFrame, top: DataFrame) -> DataFrame:
    """(c, affinity_score): 0.6 x subscores + 0.4 x top attributes, each at most 1."""
    a = subs.groupBy("c").agg(F.sum("weight").alias("s"))
    b = top.groupBy("c").agg(F.sum("concept_weight").alias("t"))
    part = lambda x: F.least(F.lit(1.0), F.coalesce(F.col(x), F.lit(0.0)))
    return concepts.select("c").distinct().join(a, "c", "left").join(b, "c", "left").select(
        "c", F.round(0.60 * part("s") + 0.40 * part("t"), 6).alias("affinity_score")
    )


def requires_geo_check(
    concepts: DataFrame, subs: DataFrame, weights: DataFrame, anchors: DataFrame, geo_subscores: list[str],
    location_theme: str, location_ns: list[str]
) -> DataFrame:
    """(c, requires_geo_check): a geographic subscore, a located theme with attributes, or an
    anchor in a location namespace."""
    at = F.lit(False)
    for p in location_ns:
        at = at | F.startswith("anchor_uri", F.lit(p))
    yes = subs.filter(F.col("subscore").isin(*geo_subscores)).select("c").union(
        weights.filter(F.col("theme") == location_theme).select("c")
    ).union(anchors.filter(at).select("c")).distinct()
    return concepts.select("c").distinct().join(yes.withColumn("geo", F.lit(True)), "c", "left").select(
        "c", F.coalesce("geo", F.lit(False)).alias("requires_geo_check")
    )


def mandatory_failures(config: DataFrame, active: DataFrame) -> DataFrame:
    """(c, theme): mandatory themes without an assignment."""
    return config.filter(F.col("rule") == MUST).select("c", "theme").join(
        active.select("c", "theme").distinct(), ["c", "theme"], "left_anti"
    )


def theme_status(config: DataFrame, assignments: DataFrame, weights: DataFrame) -> DataFrame:
    """(c, theme, n_assigned, n_weighted, status, rule_failed)."""
    a = assignments.groupBy("c", "theme").agg(F.count(F.lit(1)).alias("n_assigned"))
    w = weights.groupBy("c", "theme").agg(F.count(F.lit(1)).alias("n_weighted"))
    df = config.select("c", "theme", "rule").join(a, ["c", "theme"], "left").join(w, ["c", "theme"], "left")
    na, nw = F.coalesce("n_assigned", F.lit(0)), F.coalesce("n_weighted", F.lit(0))
    return df.select(
        "c", "theme", na.alias("n_assigned"), nw.alias("n_weighted"),
        F.when(nw > 0, "Processed").when(na > 0, "All filtered").otherwise("No assignment").alias("status"),
        ((F.col("rule") == MUST) & (na == 0)).alias("rule_failed")
    )


def definition_status(
    concepts: DataFrame, failures: DataFrame, top: DataFrame, errors: DataFrame | None = None
) -> DataFrame:
    """(c, status): Failed, then failed rules, then no attributes, then Success."""
    f = failures.groupBy("c").agg(F.count(F.lit(1)).alias("nf"))
    t = top.groupBy("c").agg(F.count(F.lit(1)).alias("nt"))
    df = concepts.select("c").distinct().join(f, "c", "left").join(t, "c", "left")
    bad = F.lit(False)
    if errors is not None:
        df = df.join(errors.select("c", F.lit(True).alias("bad")).distinct(), "c", "left")
        bad = F.coalesce("bad", F.lit(False))
    return df.select(
        "c",
        F.when(bad, "Failed").when(F.coalesce("nf", F.lit(0)) > 0, "Success with Failed Rules").when(
            F.coalesce("nt", F.lit(0)) == 0, "Warning - No Final Attributes"
        ).otherwise("Success").alias("status")
    )


def normalise_joint(items: DataFrame) -> DataFrame:
    """Weights of themes and subscores (c, kind, name, weight) as shares of one total."""
    total = F.sum("weight").over(W.partitionBy("c"))
    return items.select("c", "kind", "name", F.when(total > 0, F.col("weight") / total).otherwise(0.0).alias("weight"))


def normalise_residual(weights: DataFrame, targets: DataFrame, digits: int = 4) -> DataFrame:
    """Weights (c, theme, uri, raw) rounded to sum exactly to the theme's target: the last
    attribute takes the rounding rest."""
    by = W.partitionBy("c", "theme")
    df = weights.join(targets, ["c", "theme"]).withColumn(
        "w", F.round(F.col("target") * F.col("raw") / F.sum("raw").over(by), digits)
    )
    last = F.row_number().over(by.orderBy(F.desc("uri"))) == 1
    return df.withColumn("last", last).withColumn("total", F.sum("w").over(by)).select(
        "c", "theme", "uri",
        F.round(
            F.when(F.col("last"), F.col("w") + F.col("target") - F.col("total")).otherwise(F.col("w")), digits + 2
        ).alias("weight")
    )


# The fields of a definition file.
_TYPED = "uri: string, `skos:prefLabel`: string"
_ATTRIBUTE = f"struct<{_TYPED}, concept_weight: double, type: array<string>, comment: string>"
_THEME_RUN = "llm_assigned_count: bigint, attributes_after_weighting: bigint, status: string, rule_failed: boolean"
_STAGE1 = (
    "status: string, error: string, selection_method: string, sbert_candidate_count_initial: bigint, keyword_candidate_count_initial: bigint, unique_candidates_before_ranking: bigint,"
    " llm_candidate_count: bigint, duration_seconds: double, expansion: struct<attempted: boolean, successful: boolean, count: bigint, terms: array<string>, keyword_count: bigint,"
    " error: string, selection_method: string, duration_seconds: double>"
)
_NEGATION = "attempted: boolean, success: boolean, uris_found: bigint, error: string, candidates_checked: array<string>, identified_negating_uris: array<string>"
FIELDS = {
    "input_concept": "string",
    "normalized_concept": "string",
    "applicable_lodging_types": "string",
    "affinity_score_total_allocated": "double",
    "requires_geo_check": "boolean",
    "failed_fallback_themes": "map<string, string>",
    "travel_category": "struct<uri: string, label: string, types: array<string>, definitions: array<string>, sbert_score: double, keyword_score: double, combined_score: double,"
    " combined_score_unbiased: double, biased: boolean, effective_alpha: double, bias_reason: string>",
    "top_defining_attributes": f"array<{_ATTRIBUTE}>",
    "themes": f"array<struct<theme_name: string, theme_type: string, rule_applied: string, normalized_theme_weight: double, subScore: string, llm_summary: string, attributes: array<{_ATTRIBUTE}>>>",
    "key_associated_concepts_unthemed": f"array<struct<{_TYPED}, combined_score: double, type: array<string>>>",
    "additional_relevant_subscores": "array<struct<subscore_name: string, weight: double>>",
    "must_not_have": f"array<struct<{_TYPED}, scope: string>>",
    "processing_metadata": "struct<status: string, version: string, timestamp: string, total_duration_seconds: double, cache_version: string, llm_provider: string, llm_model: string>",
    "diagnostics": f"struct<lodging_type_determination: struct<result: string, reason: string>, llm_negation: struct<{_NEGATION}>, stage1: struct<{_STAGE1}>,"
    f" llm_slotting: struct<status: string, duration_seconds: double>, reprompting_fallback: struct<attempts: bigint, successes: bigint, failures: bigint>, stage2: struct<status: string>,"
    f" theme_processing: map<string, struct<{_THEME_RUN}>>, final_output: struct<must_not_have_count: bigint, additional_subscores_count: bigint>, error_details: string>",
}
#: The schema of a definition, from the assembly through files to triples.
DEFINITION = ", ".join(f"{k} {v}" for k, v in FIELDS.items())


def filled(definitions: DataFrame) -> DataFrame:
    """The fields of a definition in order; those that the rows lack are null."""
    have = set(definitions.columns)
    return definitions.select(*((F.col(k) if k in have else F.lit(None)).cast(v).alias(k) for k, v in FIELDS.items()))


def per_theme_cap(attributes: DataFrame, n: int = 10) -> DataFrame:
    """The first `n` attributes (c, theme, uri, confidence, concept_weight) of each theme by
    confidence, then weight."""
    return top_k(
        attributes, n, [F.desc("confidence"), F.desc("concept_weight"), F.asc("uri")], by=["c", "theme"], rank="rank"
    )


def _listed(df: DataFrame, name: str, order: list[Column], item: Column, by: str | list[str] = "c") -> DataFrame:
    """(by, name): `item` of all rows of a group, sorted by `order`."""
    keyed = F.array_sort(F.collect_list(F.struct(*(k.alias(f"k{i}") for i, k in enumerate(order)), item.alias("item"))))
    return df.groupBy(*([by] if isinstance(by, str) else by)).agg(F.transform(keyed, lambda x: x["item"]).alias(name))


def assemble(
    concepts: DataFrame, anchors: DataFrame, candidates: DataFrame, top: DataFrame, config: DataFrame,
    weights: DataFrame, attributes: DataFrame, loose: DataFrame, subs: DataFrame, negated: DataFrame,
    lodging: DataFrame, geo: DataFrame, scores: DataFrame, failures: DataFrame, status: DataFrame, run: DataFrame,
    labels: DataFrame, version: str = ""
) -> DataFrame:
    """One row a concept (c, concept) with the fields of `DEFINITION`; every array is sorted by
    an explicit key, so a second run gives the same rows.

    `run`: theme_status; `labels` (uri, label, types array<string>); missing labels are the URI."""
    names = labels.select("uri", "label", "types")
    with_label = lambda df: df.join(names, "uri", "left").withColumn("label", F.coalesce("label", "uri"))
    empty = F.array().cast("array<string>")
    types, label = F.coalesce("types", empty).alias("type"), F.col("label").alias("skos:prefLabel")
    none = F.lit(None).cast("string")
    score = candidates.select(
        "c", "uri", "sim_score", "kw_score", "combined_score", "combined_score_unbiased", "effective_alpha",
        "bias_reason"
    )
    first = with_label(
        anchors.select("c", F.col("anchor_uri").alias("uri"), "method").join(score, ["c", "uri"], "left")
    )
    category = F.struct(
        "uri", "label", F.coalesce("types", empty).alias("types"), empty.alias("definitions"), F.col("sim_score").alias("sbert_score"), F.col("kw_score").alias("keyword_score"), "combined_score",
        "combined_score_unbiased", (
            F.col("combined_score") != F.col("combined_score_unbiased")
        ).alias("biased"), "effective_alpha", "bias_reason",
    )
    attribute = lambda comment: F.struct("uri", label, "concept_weight", types, comment.alias("comment"))
    comment = F.when(F.col("is_fallback"), "Fallback Assignment")
    inside = _listed(
        with_label(attributes), "attributes", [-F.col("concept_weight"), F.col("uri")], attribute(comment),
        ["c", "theme"]
    )
    themes = config.select("c", "theme", "rule", "subscore").join(
        weights.select("c", "theme", "weight"), ["c", "theme"], "left"
    ).join(inside, ["c", "theme"], "left")
    theme = F.struct(
        F.col("theme").alias("theme_name"), none.alias("theme_type"), F.col("rule").alias("rule_applied"),
        F.round("weight", 6).alias("normalized_theme_weight"), F.col("subscore").alias("subScore"),
        none.alias("llm_summary"), F.coalesce("attributes", F.array()).alias("attributes")
    )
    runs = _listed(
        run, "runs", [F.col("theme")],
        F.struct(
            F.col("theme").alias("key"),
            F.struct(
                F.col("n_assigned").alias("llm_assigned_count"),
                F.col("n_weighted").alias("attributes_after_weighting"), "status", "rule_failed"
            ).alias("value")
        )
    )
    parts = [
        first.select("c", category.alias("travel_category"), "method"),
        _listed(with_label(top), "top_defining_attributes", [F.col("rank")], attribute(none)),
        _listed(themes, "themes", [F.col("theme")], theme),
        _listed(
            with_label(loose), "key_associated_concepts_unthemed", [-F.col("combined_score"), F.col("uri")],
            F.struct("uri", label, "combined_score", types)
        ),
        _listed(
            subs, "additional_relevant_subscores", [-F.col("weight"), F.col("subscore")],
            F.struct(F.col("subscore").alias("subscore_name"), "weight")
        ),
        _listed(with_label(negated), "must_not_have", [F.col("uri")], F.struct("uri", label, "scope")),
        _listed(
            failures, "failed", [F.col("theme")],
            F.struct(F.col("theme").alias("key"), F.lit("no assignment").alias("value"))
        ),
        runs,
        lodging.select("c", F.col("lodging_type").alias("applicable_lodging_types")),
        geo,
        scores.select("c", F.col("affinity_score").alias("affinity_score_total_allocated")),
        status,
    ]
    out = concepts.select(
        "c", F.col("concept").alias("input_concept"), normalize_concept(F.col("concept")).alias("normalized_concept")
    )
    for part in parts:
        out = out.join(part, "c", "left")
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    diagnostics = F.struct(
        F.struct(
            F.col("applicable_lodging_types").alias("result"), none.alias("reason")
        ).alias("lodging_type_determination"),
        F.struct((
            size("must_not_have") > 0
        ).alias("attempted"), (
            size("must_not_have") > 0
        ).alias("success"), size("must_not_have").alias("uris_found"), none.alias("error"), empty.alias(
            "candidates_checked"
        ),
                 F.coalesce(
                     F.transform("must_not_have", lambda m: m["uri"]), empty
                 ).alias("identified_negating_uris")).alias("llm_negation"),
        F.from_json(
            F.to_json(F.struct(F.lit("Completed").alias("status"), F.col("method").alias("selection_method"))),
            f"struct<{_STAGE1}>"
        ).alias("stage1"),
        F.lit(None).cast("struct<status: string, duration_seconds: double>").alias("llm_slotting"),
        F.lit(None).cast("struct<attempts: bigint, successes: bigint, failures: bigint>").alias("reprompting_fallback"),
        F.struct(F.col("status").alias("status")).alias("stage2"),
        F.map_from_entries("runs").alias("theme_processing"),
        F.struct(
            size("must_not_have").alias("must_not_have_count"),
            size("additional_relevant_subscores").alias("additional_subscores_count")
        ).alias("final_output"),
        none.alias("error_details"),
    )
    meta = F.struct(
        F.col("status"), F.lit(version).alias("version"), none.alias("timestamp"),
        F.lit(None).cast("double").alias("total_duration_seconds"), none.alias("cache_version"),
        none.alias("llm_provider"), none.alias("llm_model")
    )
    out = out.withColumn(
        "failed_fallback_themes",
        F.map_from_entries(F.coalesce("failed", F.array().cast("array<struct<key:string,value:string>>")))
    )
    for k, v in FIELDS.items():
        if v.startswith("array"):
            out = out.withColumn(k, F.coalesce(F.col(k).cast(v), F.array().cast(v)))
    return filled(out.withColumn("processing_metadata", meta).withColumn("diagnostics", diagnostics))
