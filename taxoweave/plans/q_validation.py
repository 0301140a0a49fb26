"""Queries of definitions as triples, their problems, and rule documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import uuid_of_uri
from ..operators import rules as U
from ..operators import validation as H
from ..operators.definition import DEFINITION, FIELDS, filled
from ..sources import files as S
from ..sources.files import ntriple_lines
from ..streaming.convert import convert_changed, convert_new, current_triples
from .fixtures import Registry, view
from ..stages import new_folder, staged

Q = Registry()

BASE = "urn:affinity:"
_ATTR = "SELECT l_orderkey AS k, l_linenumber AS n, CASE WHEN l_quantity = 50 THEN NULL WHEN l_linenumber = 7 THEN 'urn:fx:part:# ' || CAST(l_partkey AS STRING) WHEN l_partkey % 97 = 0 THEN 'urn:fx:part:#' || CAST(l_partkey + 1000000000 AS STRING) ELSE 'urn:fx:part:#' || CAST(l_partkey AS STRING) END AS uri, CASE WHEN l_quantity = 49 THEN NULL ELSE p_name END AS label, l_quantity / 100.0 AS weight, l_returnflag AS theme, l_linestatus AS line_status, p_type, l_partkey, l_suppkey FROM lineitem JOIN part ON p_partkey = l_partkey"
# places of the attributes in a definition: by line number, then part and supplier; also in its theme
_BY = "ORDER BY n, l_partkey, l_suppkey, weight"
PLACED = f"WITH a AS ({_ATTR}), x AS (SELECT k, 'order ' || CAST(k AS STRING) AS concept, row_number() OVER (PARTITION BY k {_BY}) - 1 AS i, row_number() OVER (PARTITION BY k, theme {_BY}) - 1 AS j, dense_rank() OVER (PARTITION BY k ORDER BY theme) - 1 AS t, uri, label, weight, theme, line_status, p_type, n FROM a)"


def definitions(spark, d, parts=None):
    """One definition an order: its lines are attributes, its return flags themes.  `parts`: the number of
    partitions; lines are small beside what is made of them, so it is not left to their size.

    An order's lines meet once, as they are in the table; what is made of them is made after that."""
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = view(spark, d, "part").selectExpr("p_partkey AS l_partkey", "p_name", "p_type")
    lines = view(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"
    ).join(part, "l_partkey").repartition(parts, "l_orderkey")
    lines.createOrReplaceTempView("lines_of_orders")
    rows = spark.sql(PLACED.replace("FROM lineitem JOIN part ON p_partkey = l_partkey", "FROM lines_of_orders") + " SELECT * FROM x")
    inside = rows.groupBy("k", "concept", "theme", "t").agg(
        F.expr("array_sort(collect_list(struct(j, i, uri, label, weight, p_type, line_status, n)))").alias("lines"),
        F.round(F.sum("weight"), 4).alias("w"), F.count(F.lit(1)).alias("n_all"), F.count("uri").alias("n_uri"),
    )
    whole = inside.groupBy("k", "concept").agg(
        F.expr("array_sort(collect_list(struct(t, theme, w, n_all, n_uri, lines)))").alias("inside")
    ).withColumn(
        "every",
        F.expr(
            "array_sort(transform(flatten(transform(inside, x -> x.lines)), a -> struct(a.i, a.uri, a.label, a.weight, a.p_type, a.line_status, a.n)))"
        )
    )
    attribute = "struct(a.uri, a.label AS `skos:prefLabel`, a.weight AS concept_weight, array(a.p_type) AS type, CAST(NULL AS STRING) AS comment)"
    listed = lambda where, take: f"transform(filter(every, a -> {where}), a -> {take})"
    whole = whole.selectExpr(
        "k", "concept", f"transform(every, a -> {attribute}) AS top_defining_attributes",
        listed("a.line_status = 'O'", "struct(a.uri, a.label AS `skos:prefLabel`, a.weight AS combined_score, array(a.p_type) AS type)") + " AS key_associated_concepts_unthemed",
        listed("a.n = 1", "struct(a.uri, a.label AS `skos:prefLabel`, 'Found' AS scope)") + " AS must_not_have",
        "transform(slice(every, 1, 1), a -> struct(a.uri, a.label, array(a.p_type) AS types, array('seen in ' || concept, '') AS definitions, a.weight AS sbert_score, CAST(NULL AS DOUBLE) AS keyword_score, a.weight AS combined_score, a.weight AS combined_score_unbiased, k % 2 = 0 AS biased, CAST(0.5 AS DOUBLE) AS effective_alpha, CASE WHEN k % 3 = 0 THEN 'core' ELSE '' END AS bias_reason))[0] AS travel_category",
        f"transform(inside, x -> struct(x.theme AS theme_name, CAST(NULL AS STRING) AS theme_type, CASE WHEN x.theme = 'R' THEN 'Must have 1' ELSE 'Optional' END AS rule_applied, x.w AS normalized_theme_weight, CAST(NULL AS STRING) AS subScore, '' AS llm_summary, transform(x.lines, a -> {attribute}) AS attributes)) AS themes",
        "transform(inside, x -> struct('sub ' || x.theme AS subscore_name, x.w AS weight)) AS additional_relevant_subscores",
        "map_from_entries(transform(inside, x -> struct(x.theme, struct(x.n_all AS llm_assigned_count, x.n_uri AS attributes_after_weighting, 'Processed' AS status, x.theme = 'A' AS rule_failed)))) AS runs",
    )
    d = whole.selectExpr(
        "concept AS input_concept", "concept AS normalized_concept", "CASE WHEN k % 2 = 0 THEN 'Both' ELSE '' END AS applicable_lodging_types", "CAST(k % 100 AS DOUBLE) / 100 AS affinity_score_total_allocated", "k % 3 = 0 AS requires_geo_check",
        "travel_category", "top_defining_attributes", "themes", "key_associated_concepts_unthemed", "additional_relevant_subscores", "must_not_have",
        "CASE WHEN k % 7 <> 0 THEN struct('Success' AS status, '1.0' AS version, '1995-01-01T00:00:00' AS timestamp, 1.5D AS total_duration_seconds, CAST(NULL AS STRING) AS cache_version, 'none' AS llm_provider, CAST(NULL AS STRING) AS llm_model) END AS processing_metadata",
        "from_json(to_json(struct(struct('Both' AS result) AS lodging_type_determination, struct(true AS attempted, size(must_not_have) > 0 AS success, size(must_not_have) AS uris_found, transform(must_not_have, m -> m.uri) AS identified_negating_uris) AS llm_negation, struct('Completed' AS status, size(top_defining_attributes) AS sbert_candidate_count_initial, struct(true AS attempted, array('term', concept) AS terms) AS expansion) AS stage1, struct('Done' AS status) AS llm_slotting, struct(k % 4 AS attempts) AS reprompting_fallback, struct('Completed' AS status) AS stage2, runs AS theme_processing, struct(size(must_not_have) AS must_not_have_count, size(additional_relevant_subscores) AS additional_subscores_count) AS final_output)), '" + FIELDS["diagnostics"] + "') AS diagnostics",
    )
    return filled(d)


_RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
_NAME = "url_encode(substr(regexp_replace(translate(trim({0}), ' /:#()', '____'), '[^\\p{{L}}\\p{{N}}_-]', '', 'g'), 1, 80))"
_ME = f"'{BASE}concept/' || " + _NAME.format("concept")
_AT = f"'{BASE}link/' || {_NAME.format('concept')} || '_"
_LABEL = "CASE WHEN coalesce(label, '') = '' THEN 'unknown' ELSE " + _NAME.format("label") + " END"
_TOP = f"{_AT}top_' || {_LABEL} || '_' || CAST(i AS VARCHAR)"
_THEME = f"{_AT}theme_' || theme || '_' || CAST(t AS VARCHAR)"
_IN_THEME = f"{_THEME} || '_' || {_LABEL} || '_' || CAST(j AS VARCHAR)"
_PLACE = "CAST(row_number() OVER (PARTITION BY k ORDER BY i) - 1 AS VARCHAR)"


def _node(
    source: str, s: str, kind: str | None, *pairs: tuple[str, str, str], link: tuple[str, str] | None = None
) -> list[str]:
    """SELECTs of the triples of one kind of node."""
    out = [] if kind is None else [(_RDF_TYPE, f"'{BASE}{kind}'", "uri")]
    out += [(p if p.startswith("http") else BASE + p, v, k) for p, v, k in pairs]
    rows = [f"SELECT {s} AS s, '{p}' AS p, CAST({v} AS VARCHAR) AS o, '{k}' AS o_kind FROM {source}" for p, v, k in out]
    return rows + ([f"SELECT {link[0]}, '{BASE}{link[1]}', {s}, 'uri' FROM {source}"] if link else [])


_RANKED = [
    ("attributeUri", "uri", "uri"), ("attributeSkosPrefLabel", "label", "literal"),
    ("attributeConceptWeight", "weight", "decimal"), ("attributeObservedType", "p_type", "literal")
]
_ONE = f"{_AT}stage1'"
_NEG = f"{_AT}negation'"
_DIAG = f"{_AT}diagnostics'"
_NODES = [
    *_node("o", _ME, "AffinityDefinition", (
        "http://www.w3.org/2004/02/skos/core#prefLabel", "'Affinity Definition for ' || chr(39) || concept || chr(39)",
        "literal"
    ), ("inputConcept", "concept", "literal"), ("normalizedConcept", "concept", "literal"),
           (
               "applicableLodgingTypes", "CASE WHEN k % 2 = 0 THEN 'Both' END", "literal"
           ), (
               "affinityScoreTotalAllocated", "(k % 100) / 100.0::DOUBLE", "decimal"
           ), ("requiresGeoCheck", "k % 3 = 0", "boolean")),
    *_node("(SELECT * FROM x WHERE i = 0 AND uri IS NOT NULL)", f"{_AT}anchor'", "TravelCategoryLink", (
        "linkedConceptUri", "uri", "uri"
    ), ("observedLabel", "label", "literal"), ("sbertScore", "weight", "double"), ("combinedScore", "weight", "double"),
           (
               "combinedScoreUnbiased", "weight", "double"
           ), ("isBiased", "k % 2 = 0", "boolean"), ("effectiveAlpha", "0.5::DOUBLE", "double"), (
               "biasReason", "CASE WHEN k % 3 = 0 THEN 'core' END", "literal"
           ), ("observedType", "p_type", "literal"),
           ("observedDefinition", "'seen in ' || concept", "literal"), link=(_ME, "hasTravelCategory")),
    *_node(
        "(SELECT * FROM x WHERE uri IS NOT NULL)", _TOP, "RankedAttributeLink", *_RANKED,
        link=(_ME, "hasTopDefiningAttribute")
    ),
    *_node("th", _THEME, "ThemeInstance", ("themeName", "theme", "literal"), (
        "themeRuleApplied", "CASE WHEN theme = 'R' THEN 'Must have 1' ELSE 'Optional' END", "literal"
    ), ("themeNormalizedWeight", "w", "decimal"),
           ("diagnosticThemeLLMAssignedCount", "n_all", "integer"), (
               "diagnosticThemeAttributesAfterWeighting", "n_uri", "integer"
           ), ("diagnosticThemeStatus", "'Processed'", "literal"), (
               "diagnosticThemeRuleFailed", "theme = 'A'", "boolean"
           ), link=(_ME, "hasTheme")),
    *_node(
        "(SELECT * FROM x WHERE uri IS NOT NULL)", _IN_THEME, "RankedAttributeLink", *_RANKED,
        link=(_THEME, "hasRankedAttribute")
    ),
    *_node(f"(SELECT * FROM (SELECT *, {_PLACE} AS u FROM x WHERE line_status = 'O') WHERE uri IS NOT NULL)", f"{_AT}unthemed_' || {_LABEL} || '_' || u", "UnthemedConceptLink", ("conceptUri", "uri", "uri"), (
        "conceptSkosPrefLabel", "label", "literal"
    ),
           (
               "conceptCombinedScore", "weight", "double"
           ), ("conceptObservedType", "p_type", "literal"), link=(_ME, "hasKeyAssociatedConceptUnthemed")),
    *_node(
        "th", f"{_AT}subscore_' || url_encode('sub_' || theme) || '_' || CAST(t AS VARCHAR)", "SubscoreWeighting",
        ("subscoreName", "'sub ' || theme", "literal"), ("weightValue", "w", "double"),
        link=(_ME, "hasAdditionalRelevantSubscore")
    ),
    *_node(f"(SELECT * FROM (SELECT *, {_PLACE} AS u FROM x WHERE n = 1) WHERE uri IS NOT NULL)", f"{_AT}must_not_have_' || {_LABEL} || '_' || u", "MustNotHaveLink", ("conceptUri", "uri", "uri"), (
        "conceptSkosPrefLabel", "label", "literal"
    ),
           ("identificationScope", "'Found'", "literal"), link=(_ME, "hasMustNotHaveConcept")),
    *_node("(SELECT * FROM o WHERE k % 7 <> 0)", f"{_AT}metadata'", "ProcessingMetadata", (
        "processingStatus", "'Success'", "literal"
    ), ("engineVersion", "'1.0'", "literal"), ("timestamp", "'1995-01-01T00:00:00'", "dateTime"),
           (
               "totalDurationSeconds", "1.5", "decimal"
           ), ("llmProviderUsed", "'none'", "literal"), link=(_ME, "hasProcessingMetadata")),
    *_node(
        "o", _DIAG, "DiagnosticsBundle", ("diagLodgingTypeDeterminationResult", "'Both'", "literal"),
        link=(_ME, "hasDiagnostics")
    ),
    *_node(
        "o", _NEG, "LLMNegationDiagnostics", ("llmNegAttempted", "true", "boolean"),
        ("llmNegSuccess", "n_not > 0", "boolean"), ("llmNegUrisFound", "n_not", "integer"),
        link=(_DIAG, "diagHasLLMNegationDiagnostics")
    ),
    *_node(
        "(SELECT * FROM x WHERE n = 1 AND uri IS NOT NULL)", _NEG, None, ("llmNegIdentifiedNegatingUri", "uri", "uri")
    ),
    *_node(
        "o", _ONE, "Stage1Diagnostics", ("s1Status", "'Completed'", "literal"),
        ("s1SbertCandidateCountInitial", "n_all", "integer"), link=(_DIAG, "diagHasStage1Diagnostics")
    ),
    *_node(
        "o", f"{_AT}expansion'", "ExpansionDiagnostics", ("expAttempted", "true", "boolean"),
        ("expTerm", "'term'", "literal"), ("expTerm", "concept", "literal"), link=(_ONE, "s1HasExpansionDetails")
    ),
    *_node(
        "o", f"{_AT}slotting'", "LLMSlottingDiagnostics", ("llmsStatus", "'Done'", "literal"),
        link=(_DIAG, "diagHasLLMSlottingDiagnostics")
    ),
    *_node(
        "o", f"{_AT}reprompting'", "RepromptingFallbackDiagnostics", ("rfAttempts", "k % 4", "integer"),
        link=(_DIAG, "diagHasRepromptingFallbackDiagnostics")
    ),
    *_node(
        "o", f"{_AT}stage2'", "Stage2Diagnostics", ("s2Status", "'Completed'", "literal"),
        link=(_DIAG, "diagHasStage2Diagnostics")
    ),
    *_node(
        "o", f"{_AT}counts'", "FinalOutputCounts", ("foMustNotHaveCount", "n_not", "integer"),
        ("foAdditionalSubscoresCount", "n_themes", "integer"), link=(_DIAG, "diagHasFinalOutputCounts")
    ),
]
_ORDERS = "o AS (SELECT k, concept, count(*) AS n_all, count(*) FILTER (n = 1) AS n_not, count(DISTINCT theme) AS n_themes FROM x GROUP BY k, concept), th AS (SELECT k, concept, theme, t, round(sum(weight), 4) AS w, count(*) AS n_all, count(uri) AS n_uri FROM x GROUP BY k, concept, theme, t)"
TRIPLES = PLACED.replace(
    "x AS (", "x AS MATERIALIZED ("
) + f", {_ORDERS}, dt AS MATERIALIZED (SELECT * FROM ({' UNION ALL '.join(_NODES)}) WHERE o IS NOT NULL)"
_JSON = BASE + "diagThemeProcessingDetailsJson"  # JSON text, which the engines write differently: read back in its own query
LINKS = f"('{BASE}attributeUri', '{BASE}linkedConceptUri')"
_SUM = "count(*) AS n, bit_xor(CAST('0x' || substr(md5(s || '|' || o), 1, 15) AS BIGINT)) AS checksum"


def summed(t):
    """Number and checksum of the triples, by property, kind and part of the subjects."""
    checksum = F.bit_xor(F.conv(F.substring(F.md5(F.concat("s", F.lit("|"), "o")), 1, 15), 16, 10).cast("long"))
    return t.groupBy(
        "p", "o_kind", F.substring(F.md5("s"), 1, 1).alias("part")
    ).agg(F.count(F.lit(1)).alias("n"), checksum.alias("checksum"))


USES = [BASE + "attributeUri", BASE + "linkedConceptUri"]


def triples(spark, d, properties=None):
    return H.definition_triples(definitions(spark, d), properties=properties)


@Q.add(
    "h01_definition_triples", TRIPLES + f" SELECT p, o_kind, substr(md5(s), 1, 1) AS part, {_SUM} FROM dt GROUP BY ALL"
)
def h01(spark, d):
    """All triples; the checksums change if any of them does."""
    return summed(triples(spark, d).filter(F.col("p") != _JSON))


@Q.add("h01_theme_processing", TRIPLES + f" SELECT {_DIAG} AS s, theme, n_all AS assigned, n_uri AS weighted FROM th")
def h01b(spark, d):
    """What the bundle of diagnostics says of the themes, read back from its JSON text."""
    t = triples(spark, d, [_JSON]).select(
        "s",
        F.explode(
            F.from_json("o", "map<string,struct<llm_assigned_count:bigint,attributes_after_weighting:bigint>>")
        ).alias("theme", "run")
    )
    return t.select(
        "s", "theme", F.col("run.llm_assigned_count").alias("assigned"),
        F.col("run.attributes_after_weighting").alias("weighted")
    )


@Q.add("h02_stable_links", TRIPLES + f" SELECT s, o FROM dt WHERE p = '{BASE}attributeUri'")
def h02(spark, d):
    return triples(spark, d, [BASE + "attributeUri"]).select("s", "o")


@Q.add(
    "a13_ntriple_lines",
    TRIPLES + f" SELECT '<' || s || '> <' || p || '> \"' || o || '\" .' AS value FROM dt WHERE p = '{BASE}observedLabel'"
)
def a13(spark, d):
    return ntriple_lines(triples(spark, d, [BASE + "observedLabel"]))


@Q.add(
    "j08_resumable_convert", TRIPLES + f" SELECT p, o_kind, substr(md5(s), 1, 1) AS part, {_SUM} FROM dt GROUP BY ALL"
)
def j08(spark, d):
    """Definitions as files, converted by the stream in batches that a restart would go on from."""
    base, files = new_folder(spark, "convert"), definition_files(spark, d)
    definitions(spark, d, files).write.parquet(f"{base}/in", compression="zstd")
    convert_new(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", max_files=files // 2)
    return summed(spark.read.parquet(f"{base}/out").filter(F.col("p") != _JSON))


def definition_files(spark, d):
    """An even number of files that grows with the orders, about 25,000 definitions in each; 4 at least."""
    return max(4, 2 * (view(spark, d, "orders").count() // 50_000))


_CHANGED = TRIPLES.replace("k % 3 = 0 AS VARCHAR) AS o, 'boolean'", "(k % 3 = 0) <> (k % 5 = 0) AS VARCHAR) AS o, 'boolean'")


@Q.add(
    "j08_changed_definitions", _CHANGED + f" SELECT p, o_kind, substr(md5(s), 1, 1) AS part, {_SUM} FROM dt GROUP BY ALL"
)
def j08c(spark, d):
    """Every definition comes twice, a fifth of them changed: the second time replaces only those."""
    base, files = new_folder(spark, "convert"), definition_files(spark, d)
    made = definitions(spark, d, files)
    made.write.parquet(f"{base}/in", compression="zstd")
    run = lambda: convert_changed(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", max_files=files // 2)
    run()
    fifth = F.substring("input_concept", 7, 20).cast("long") % 5 == 0
    again = spark.read.schema(made.schema).parquet(f"{base}/in").withColumn(
        "requires_geo_check", F.col("requires_geo_check") != fifth
    )
    again.write.mode("append").parquet(f"{base}/in", compression="zstd")  # reads the files that were there
    run()
    return summed(current_triples(spark, f"{base}/out").filter(F.col("p") != _JSON))


_PARTS = " UNION ALL ".join([
    "SELECT 'definition' AS kind, concept, 0 AS i, NULL AS uri, NULL AS label, (k % 100) / 100.0::DOUBLE AS w FROM o", "SELECT 'top', concept, i, uri, label, weight FROM x", "SELECT 'theme', concept, t, NULL, theme, w FROM th",
    "SELECT 'in theme ' || theme, concept, j, uri, label, weight FROM x", f"SELECT 'unthemed', concept, CAST({_PLACE} AS BIGINT), uri, label, weight FROM x WHERE line_status = 'O'", "SELECT 'subscore', concept, t, NULL, 'sub ' || theme, w FROM th",
])


def parts_of(d):
    """A definition's arrays as rows (kind, concept, i, uri, label, w)."""
    label = "`skos:prefLabel`"
    of = lambda kind, source, uri, name, w: d.selectExpr(
        "input_concept AS concept", f"posexplode({source}) AS (i, x)"
    ).selectExpr(
        f"{kind} AS kind", "concept", "CAST(i AS BIGINT) AS i", f"{uri} AS uri", f"{name} AS label", f"{w} AS w"
    )
    none = "CAST(NULL AS STRING)"
    inside = d.selectExpr("input_concept AS concept", "explode(themes) AS t").selectExpr(
        "concept", "t.theme_name AS theme", "posexplode(t.attributes) AS (i, x)"
    )
    out = d.selectExpr(
        "'definition' AS kind", "input_concept AS concept", "0L AS i", f"{none} AS uri", f"{none} AS label",
        "affinity_score_total_allocated AS w"
    )
    for df in (
        of(
            "'top'", "top_defining_attributes", "x.uri", f"x.{label}", "x.concept_weight"
        ), of("'theme'", "themes", none, "x.theme_name", "x.normalized_theme_weight"), inside.selectExpr(
            "'in theme ' || theme AS kind", "concept", "CAST(i AS BIGINT) AS i", "x.uri", f"x.{label} AS label",
            "x.concept_weight AS w"
        ),
        of(
            "'unthemed'", "key_associated_concepts_unthemed", "x.uri", f"x.{label}", "x.combined_score"
        ), of("'subscore'", "additional_relevant_subscores", none, "x.subscore_name", "x.weight"),
    ):
        out = out.unionByName(df)
    return out


@Q.add(
    "a11_read_definitions",
    TRIPLES.split(", dt AS")[0] + f" {_PARTS} UNION ALL SELECT 'issue FORMAT', NULL, NULL, NULL, '7', NULL"
)
def a11(spark, d):
    """Definitions through JSON array files, with a file of a single object and an item that is none."""
    base = new_folder(spark, "definitions")
    every = staged(definitions(spark, d), "made")
    S.write_definitions(every.filter("input_concept <> 'order 1'"), f"{base}/arrays", "gzip")
    one = every.filter("input_concept = 'order 1'").select(F.to_json(F.struct("*")).alias("value"))
    one.coalesce(1).write.text(f"{base}/single")
    spark.range(1).select(F.lit("[7]").alias("value")).coalesce(1).write.text(f"{base}/odd")
    good, issues = S.read_definitions(spark, f"{base}/*")
    return parts_of(staged(good, "read")).unionByName(
        issues.selectExpr(
            "concat('issue ', category) AS kind", "CAST(NULL AS STRING) AS concept", "CAST(NULL AS BIGINT) AS i",
            "CAST(NULL AS STRING) AS uri", "message AS label", "CAST(NULL AS DOUBLE) AS w"
        )
    )


@Q.add("a12_write_definitions", TRIPLES.split(", dt AS")[0] + " SELECT concept, n_all AS n_top, n_themes FROM o")
def a12(spark, d):
    """The written files as Spark's own reader of JSON arrays sees them."""
    path = new_folder(spark, "written")
    S.write_definitions(definitions(spark, d), path, "gzip")
    rows = spark.read.schema(DEFINITION).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return rows.select(
        F.col("input_concept").alias("concept"), F.size("top_defining_attributes").cast("long").alias("n_top"),
        F.size("themes").cast("long").alias("n_themes")
    )


_TYPES = "types AS (SELECT DISTINCT p_type AS type, CASE WHEN p_type <> 'PROMO' THEN 'urn:class:' || lower(p_type) END AS class FROM part)"


@Q.add(
    "h03_type_to_class",
    f"WITH {_TYPES} SELECT p_partkey, coalesce(class, 'unmapped') AS class FROM part JOIN types ON type = p_type"
)
def h03(spark, d):
    p = view(spark, d, "part")
    types = p.filter("p_type <> 'PROMO'").selectExpr(
        "p_type AS type", "'urn:class:' || lower(p_type) AS class"
    ).distinct()
    rows = p.select("p_partkey", F.col("p_type").alias("type"))
    good, bad = H.type_to_class(rows, types)
    return good.select("p_partkey", "class").unionByName(
        rows.join(F.broadcast(bad), "type", "left_semi").select("p_partkey", F.lit("unmapped").alias("class"))
    )


MISSING = PLACED + ", mi AS (SELECT 'WARNING' AS severity, 'DATA_MISSING' AS category, 'no uri' AS message, concept || '.top_defining_attributes[' || CAST(i AS VARCHAR) || ']' AS location FROM x WHERE uri IS NULL UNION ALL SELECT 'WARNING', 'DATA_MISSING', 'no label', concept || '.top_defining_attributes[' || CAST(i AS VARCHAR) || ']' FROM x WHERE label IS NULL)"


@Q.add("h04_missing_data_issues", MISSING + " SELECT * FROM mi")
def h04(spark, d):
    return H.missing_data_issues(definitions(spark, d))


_BAD = "array_to_string(list_sort(list_distinct(regexp_extract_all(uri, '[ <>\"{{}}|\\\\^`]'))), '')".replace("{{", "{").replace("}}", "}")


@Q.add(
    "h05_uri_issues",
    TRIPLES + f", u AS (SELECT DISTINCT 'subject' AS pos, s AS uri FROM dt UNION SELECT 'predicate', p FROM dt UNION SELECT 'object', o FROM dt WHERE o_kind = 'uri') SELECT 'ERROR' AS severity, 'URI' AS category, 'invalid characters: ' || {_BAD} AS message, pos || ' ' || uri AS location FROM u WHERE {_BAD} <> '' UNION ALL SELECT 'WARNING', 'URI', 'scheme is not http, https or urn', pos || ' ' || uri FROM u WHERE NOT regexp_matches(uri, '^(http|https|urn):')"
)
def h05(spark, d):
    return H.uri_issues(triples(spark, d))


_KNOWN = "known AS (SELECT s AS uri FROM fx_triples UNION SELECT o FROM fx_triples WHERE o_kind = 'uri')"


@Q.add(
    "h06_taxonomy_issues",
    TRIPLES + f", {_KNOWN} SELECT 'ERROR' AS severity, 'TAXONOMY' AS category, 'not in taxonomy: ' || o AS message, min(s) AS location FROM dt WHERE p IN {LINKS} AND o NOT IN (SELECT uri FROM known) GROUP BY o"
)
def h06(spark, d):
    return H.taxonomy_issues(triples(spark, d, USES), view(spark, d, "fx_triples"), USES)


@Q.add(
    "d09_uri_sources",
    TRIPLES + f", f AS (SELECT s AS uri, source_file FROM fx_triples UNION SELECT o, source_file FROM fx_triples WHERE o_kind = 'uri') SELECT uri, array_to_string(list_sort(list(DISTINCT source_file)), ',') AS files FROM f WHERE uri IN (SELECT o FROM dt WHERE p IN {LINKS}) GROUP BY uri"
)
def d09(spark, d):
    return H.uri_sources(triples(spark, d, USES), view(spark, d, "fx_triples"), USES)


_LOC = "CASE WHEN contains(p, '#') THEN list_extract(string_split(p, '#'), -1) ELSE list_extract(string_split(p, '/'), -1) END"


@Q.add(
    "h07_namespace_issues",
    f"WITH used AS (SELECT DISTINCT left(p, length(p) - length({_LOC})) AS namespace FROM fx_triples), req AS (SELECT DISTINCT CASE WHEN r_regionkey = 0 THEN 'http://www.w3.org/2004/02/skos/core#' ELSE 'urn:missing:' END AS namespace FROM region) SELECT namespace, 'missing' AS problem FROM req WHERE namespace NOT IN (SELECT * FROM used) UNION ALL SELECT namespace, 'not listed' FROM used WHERE namespace NOT IN (SELECT * FROM req)"
)
def h07(spark, d):
    req = view(spark, d, "region").select(
        F.when(
            F.col("r_regionkey") == 0, "http://www.w3.org/2004/02/skos/core#"
        ).otherwise("urn:missing:").alias("namespace")
    )
    return H.namespace_issues(view(spark, d, "fx_triples"), req)


@Q.add(
    "e33_issue_summary",
    MISSING + " SELECT severity, category, count(*) AS n, 0 AS critical FROM mi GROUP BY severity, category"
)
def e33(spark, d):
    return H.issue_summary(H.missing_data_issues(definitions(spark, d)))


@Q.add(
    "h09_validation_report",
    TRIPLES + ", mi AS (SELECT count(*) AS n FROM x WHERE uri IS NULL UNION ALL SELECT count(*) FROM x WHERE label IS NULL) SELECT (SELECT count(*) FROM dt) AS triples, (SELECT count(DISTINCT s) FROM dt) AS subjects, (SELECT count(DISTINCT p) FROM dt) AS predicates, 'WARNING' AS severity, 'DATA_MISSING' AS category, CAST(sum(n) AS BIGINT) AS n FROM mi"
)
def h09(spark, d):
    """The report's JSON text, read back."""
    from ..operators.concepts import triple_stats

    made = definitions(spark, d)
    t = staged(
        H.definition_triples(made).filter(F.col("p") != _JSON).withColumn("source_file", F.lit("definitions")),
        "triples"
    )  # read by several counts
    report = H.validation_report(triple_stats(t), H.missing_data_issues(made))
    schema = "statistics struct<triples:bigint,subjects:bigint,predicates:bigint>, issues array<struct<severity:string,category:string,n:bigint>>"
    return report.select(F.from_json("report", schema).alias("r")).select(
        "r.statistics.*", F.explode("r.issues").alias("i")
    ).select("triples", "subjects", "predicates", "i.*")


# rule documents: one for each part type, with headings, a rule sentence, key values and tables
_DOCS = r"""SELECT p_type AS doc_id, '===' || chr(10) || '# ' || p_type || ' theme' || chr(10) || '**Theme Id**: ' || p_type || '-1' || chr(10) || '## Conventional attributes' || chr(10) || 'A property must have ' || CAST(n AS STRING) || ' of the following attributes OR 2 of the following ski attributes AND 3-star rating' || chr(10) || '### Main list' || chr(10) || '| Attribute | AID | UUID |' || chr(10) || '|---|---|---|' || chr(10) || rows || chr(10) || 'Beach shacks do not qualify' || chr(10) || '## Vacation notes' || chr(10) || 'Rooms adjacent to stairs need documentation' || chr(10) || '| Theme | UUID | Automated | Properties |' || chr(10) || '| :-- | - | - | - |' || chr(10) || '| ' || p_type || ' | u-' || p_type || ' | Yes | 1,2' || CAST(n AS STRING) || ' |' || chr(10) || '======' || chr(10) || 'no heading, no block' AS text FROM (SELECT p_type, count(*) AS n, {agg} AS rows FROM (SELECT p_type, p_partkey, '| ' || p_name || ' | ' || CAST(p_partkey AS STRING) || CASE WHEN p_partkey % 2 = 0 THEN ' | id-' || CAST(p_partkey AS STRING) || ' |' ELSE ' |' END AS line FROM part) y GROUP BY p_type) z"""
_DOCS_DUCK = _DOCS.replace("{agg}", "string_agg(line, chr(10) ORDER BY p_partkey)")
_DOCS_SPARK = _DOCS.replace(
    "{agg}", "array_join(transform(array_sort(collect_list(struct(p_partkey, line))), s -> s.line), chr(10))"
)


def rule_docs(spark, d):
    view(spark, d, "part").createOrReplaceTempView("part")
    return spark.sql(_DOCS_SPARK)


def rule_lines(spark, d):
    return U.line_sections(U.split_blocks(rule_docs(spark, d)))


BLOCKS = f"WITH docs AS ({_DOCS_DUCK}), pb AS (SELECT doc_id, unnest(list_filter(list_transform(string_split_regex(text, '(?m)^={{3,}}$'), lambda x: trim(x, chr(10) || ' ')), lambda x: starts_with(x, '# '))) AS text FROM docs), blocks AS (SELECT doc_id, 0 AS block, text FROM pb)"
LINES = BLOCKS + r""", li AS (SELECT doc_id, block, unnest(range(0, len(string_split(text, chr(10))))) AS line_no, unnest(string_split(text, chr(10))) AS line FROM blocks),
h AS (SELECT *, nullif(regexp_extract(line, '^# +(.*)$', 1), '') AS h1, nullif(regexp_extract(line, '^## +(.*)$', 1), '') AS h2, nullif(regexp_extract(line, '^### +(.*)$', 1), '') AS h3 FROM li),
s1 AS (SELECT *, last_value(h1 IGNORE NULLS) OVER w AS heading, last_value(h2 IGNORE NULLS) OVER w AS section, count(h2) OVER w AS s FROM h WINDOW w AS (PARTITION BY doc_id, block ORDER BY line_no ROWS UNBOUNDED PRECEDING)),
sec AS (SELECT *, last_value(h3 IGNORE NULLS) OVER (PARTITION BY doc_id, block, s ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS subsection FROM s1)"""


@Q.add("i01_split_blocks", BLOCKS + " SELECT doc_id, CAST(block AS INT) AS block, text FROM blocks")
def i01(spark, d):
    return U.split_blocks(rule_docs(spark, d))


@Q.add(
    "i02_line_sections",
    LINES + " SELECT doc_id, CAST(line_no AS INT) AS line_no, heading, section, subsection, CASE WHEN contains(lower(coalesce(subsection, section, '')), 'conventional') THEN 'conventional' WHEN contains(lower(coalesce(subsection, section, '')), 'vacation') THEN 'vacation' END AS audience FROM sec"
)
def i02(spark, d):
    return rule_lines(spark, d).select("doc_id", "line_no", "heading", "section", "subsection", "audience")


TABLES = LINES + r""", tb AS (SELECT *, sum(CASE WHEN regexp_matches(trim(line), '^\|.*\|$') THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, block ORDER BY line_no) AS table_no FROM sec),
tr AS (SELECT *, list_transform(string_split(trim(trim(line), '|'), '|'), lambda x: trim(x)) AS cells, row_number() OVER (PARTITION BY doc_id, block, table_no ORDER BY line_no) - 1 AS row_no FROM tb WHERE regexp_matches(trim(line), '^\|.*\|$') AND NOT regexp_matches(trim(line), '^\|[\s:|-]+\|$')),
th AS (SELECT *, first_value(cells) OVER (PARTITION BY doc_id, block, table_no ORDER BY line_no) AS headers FROM tr), tc AS (SELECT doc_id, block, section, subsection, table_no, row_no, unnest(headers) AS header, coalesce(cells[unnest(range(1, len(headers) + 1))], '') AS cell FROM th WHERE row_no > 0)"""


@Q.add(
    "i03_markdown_tables",
    TABLES + " SELECT doc_id, section, subsection, CAST(row_no AS INT) AS row_no, header, cell FROM tc"
)
def i03(spark, d):
    return U.markdown_tables(rule_lines(spark, d)).select("doc_id", "section", "subsection", "row_no", "header", "cell")


@Q.add(
    "i04_key_values",
    LINES + r" SELECT doc_id, replace(lower(regexp_extract(line, '^\*\*([^*]+)\*\*: (.*)$', 1)), ' ', '_') AS key, regexp_extract(line, '^\*\*([^*]+)\*\*: (.*)$', 2) AS value FROM sec WHERE starts_with(line, '**')"
)
def i04(spark, d):
    return U.key_values(rule_lines(spark, d), ["Theme Id", "Version"]).drop("block")


@Q.add("i05_rule_groups", LINES + r""", r AS (SELECT doc_id, CAST(line_no AS INT) AS line_no, string_split_regex(line, '\s+OR\s+') AS alts FROM sec WHERE regexp_matches(line, '(?i)must have|of the following|minimum requirement|property has')),
a AS (SELECT doc_id, line_no, unnest(range(0, len(alts))) AS alt_id, unnest(alts) AS alt FROM r), c AS (SELECT doc_id, line_no, alt_id, unnest(range(0, len(string_split_regex(alt, '\s+AND\s+')))) AS conj_id, unnest(string_split_regex(alt, '\s+AND\s+')) AS text FROM a)
SELECT doc_id, line_no, CAST(alt_id AS INT) AS alt_id, CAST(conj_id AS INT) AS conj_id, text, CAST(coalesce(nullif(regexp_extract(text, '(?i)(\d+)\s+of\b', 1), ''), '1') AS INT) AS required_count, CAST(nullif(regexp_extract(text, '(?i)(\d+(?:\.\d+)?)\+?[- ]?stars?\b', 1), '') AS DOUBLE) AS stars, coalesce(nullif(lower(regexp_extract(text, '(?i)of the following ([a-z]+) ', 1)), ''), 'main') AS grp FROM c""")
def i05(spark, d):
    return U.rule_groups(rule_lines(spark, d)).drop("block")


@Q.add(
    "i06_attribute_groups",
    TABLES + " SELECT doc_id, CASE WHEN contains(lower(coalesce(subsection, section, '')), 'main') THEN 'main' WHEN contains(lower(coalesce(subsection, section, '')), 'vacation') THEN 'vacation' ELSE 'main' END AS grp, CAST(row_no AS INT) AS row_no, max(cell) FILTER (lower(header) = 'attribute') AS attribute, max(cell) FILTER (lower(header) = 'aid') AS aid, max(cell) FILTER (lower(header) = 'uuid') AS uuid FROM tc GROUP BY doc_id, grp, table_no, row_no HAVING attribute IS NOT NULL"
)
def i06(spark, d):
    return U.attribute_groups(U.markdown_tables(rule_lines(spark, d)), ["main", "vacation"]).drop("block")


@Q.add(
    "i07_exception_lines",
    LINES + ", k AS (SELECT doc_id, CAST(line_no AS INT) AS line_no, line, 'disqualifying' AS kind, 'do not qualify' AS p FROM sec UNION ALL SELECT doc_id, line_no, line, 'adjacent', 'adjacent to' FROM sec UNION ALL SELECT doc_id, line_no, line, 'documents', 'documentation|certificate' FROM sec UNION ALL SELECT doc_id, line_no, line, 'country', 'countr(y|ies)' FROM sec) SELECT doc_id, line_no, kind, line FROM k WHERE regexp_matches(lower(line), p)"
)
def i07(spark, d):
    return U.exception_lines(rule_lines(spark, d)).drop("block")


@Q.add(
    "i08_theme_summary",
    TABLES + " SELECT doc_id, CAST(row_no AS INT) AS row_no, max(cell) FILTER (lower(header) = 'theme') AS name, max(cell) FILTER (lower(header) = 'uuid') AS uuid, true AS automated, CAST(replace(max(cell) FILTER (lower(header) = 'properties'), ',', '') AS BIGINT) AS properties FROM tc GROUP BY doc_id, table_no, row_no HAVING name IS NOT NULL"
)
def i08(spark, d):
    return U.theme_summary(U.markdown_tables(rule_lines(spark, d)))


@Q.add(
    "i09_excluded_countries",
    "SELECT DISTINCT upper(left(replace(n_name, '_', ''), 3)) AS code FROM nation WHERE n_nationkey % 2 = 0"
)
def i09(spark, d):
    n = view(spark, d, "nation").selectExpr(
        "CASE WHEN n_nationkey % 2 = 0 THEN upper(left(replace(n_name, '_', ''), 3)) ELSE 'code' END || chr(9) || n_name AS line"
    )
    return U.excluded_countries(n)


RULES = "groups AS (SELECT * FROM (VALUES ('t1', 0, 'g0', 3), ('t2', 0, 'g1', 5), ('t2', 1, 'g1', 2), ('t2', 1, 'g2', 1), ('t3', 0, 'g3', 2), ('t3', 0, 'g4', 3)) v(theme, alt_id, grp, required_count))"
_RATTR = "SELECT DISTINCT t.theme, t.grp, p_partkey AS attr FROM part JOIN (SELECT DISTINCT theme, grp, CAST(substr(grp, 2) AS INT) AS m FROM groups) t ON p_partkey % 5 = t.m"
_HELD = "SELECT DISTINCT o_custkey AS p, l_partkey AS attr FROM orders JOIN lineitem ON l_orderkey = o_orderkey"


@Q.add(
    "i10_evaluate_rules",
    f"WITH {RULES}, ra AS ({_RATTR}), held AS ({_HELD}), dq AS (SELECT 't1' AS theme, p_partkey AS attr FROM part WHERE p_partkey % 101 = 0), n AS (SELECT p, theme, grp, count(*) AS n FROM held JOIN ra USING (attr) GROUP BY ALL), ok AS (SELECT p, theme, alt_id, count(*) AS ok FROM n JOIN groups USING (theme, grp) WHERE n >= required_count GROUP BY ALL), need AS (SELECT theme, alt_id, count(*) AS need FROM groups GROUP BY ALL) SELECT p, theme, alt_id FROM ok JOIN need USING (theme, alt_id) WHERE ok = need AND (p, theme) NOT IN (SELECT (p, theme) FROM held JOIN dq USING (attr))"
)
def i10(spark, d):
    for t in ("part", "orders", "lineitem"):
        view(spark, d, t).createOrReplaceTempView(t)
    groups = spark.sql(f"WITH {RULES} SELECT * FROM groups")
    attrs = spark.sql(f"WITH {RULES} {_RATTR}")
    dq = view(spark, d, "part").filter("p_partkey % 101 = 0").selectExpr("'t1' AS theme", "p_partkey AS attr")
    return U.evaluate_rules(spark.sql(_HELD), groups, attrs, dq)


_UUID = "left(md5('p' || CAST({0} AS STRING)), 8) || '-' || substr(md5('p' || CAST({0} AS STRING)), 9, 4) || '-' || substr(md5('p' || CAST({0} AS STRING)), 13, 4) || '-' || substr(md5('p' || CAST({0} AS STRING)), 17, 4) || '-' || substr(md5('p' || CAST({0} AS STRING)), 21, 12)"
_RU = f"SELECT p_partkey, {_UUID.format('p_partkey')} AS uuid FROM part"
_UR = f"SELECT 'urn:fx:rule:#' || {_UUID.format('p_partkey')} AS uri FROM part WHERE p_partkey % 2 = 0"


def mapped(spark, d):
    view(spark, d, "part").createOrReplaceTempView("part")
    return U.uuid_to_uri(spark.sql(_RU), spark.sql(_UR), uuid_of_uri(F.col("uri")))


@Q.add(
    "d13_uuid_to_uri",
    f"SELECT p_partkey, uuid, CASE WHEN p_partkey % 2 = 0 THEN 'urn:fx:rule:#' || uuid ELSE 'URI not found' END AS uri FROM ({_RU})"
)
def d13(spark, d):
    return mapped(spark, d)


@Q.add(
    "e34_coverage",
    "SELECT count(*) FILTER (p_partkey % 2 = 0) AS found, count(*) FILTER (p_partkey % 2 <> 0) AS not_found, round(100.0 * count(*) FILTER (p_partkey % 2 = 0) / count(*), 2) AS percent FROM part"
)
def e34(spark, d):
    return U.coverage(mapped(spark, d))


@Q.add(
    "d14_theme_rules_merge",
    f"WITH s AS (SELECT p_name AS name, {_UUID.format('p_partkey')} AS uuid FROM part), r AS (SELECT p_type AS rule, {_UUID.format('2 * p_partkey')} AS uuid FROM part) SELECT coalesce(s.uuid, r.uuid) AS uuid, coalesce(name, 'unmatched') AS name, coalesce(rule, 'No rule document') AS rule FROM s FULL JOIN r ON s.uuid = r.uuid"
)
def d14(spark, d):
    """Themes of all parts, rules of their doubles: both have some that the other lacks."""
    view(spark, d, "part").createOrReplaceTempView("part")
    s = spark.sql(f"SELECT p_name AS name, {_UUID.format('p_partkey')} AS uuid FROM part")
    r = spark.sql(f"SELECT p_type AS rule, {_UUID.format('2 * p_partkey')} AS uuid FROM part")
    merged, rest = U.theme_rules_merge(s, r)
    return merged.unionByName(rest.select("uuid", F.lit("unmatched").alias("name"), "rule"))
