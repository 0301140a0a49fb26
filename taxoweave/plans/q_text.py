"""Queries of the column functions (with their SQL for DuckDB)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.rules import rule_spans
from .fixtures import Registry, view

Q = Registry()

NORM = r"""array_to_string(list_filter(string_split_regex(lower(regexp_replace(replace(replace(regexp_replace({0}, '([a-z0-9])([A-Z])', '\1 \2', 'g'), '-', ' '), '_', ' '), '[^\p{{L}}\p{{N}}_\s]', '', 'g')), '\s+'), lambda x: x <> ''), ' ')"""
LABEL = r"""array_to_string(list_filter(string_split_regex(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}_\s]', '', 'g'), '\s+'), lambda x: x <> ''), ' ')"""


@Q.add("b01_normalize_concept", f"SELECT id, coalesce({NORM.format('name')}, '') AS norm FROM fx_names")
def b01(spark, d):
    return view(spark, d, "fx_names").select("id", X.normalize_concept(F.col("name")).alias("norm"))


@Q.add(
    "b02_normalize_label",
    f"SELECT id, {LABEL.format('name')} AS norm, replace(lower(name), ' ', '') AS squash FROM fx_names"
)
def b02(spark, d):
    n = F.col("name")
    return view(spark, d, "fx_names").select(
        "id", X.normalize_label(n).alias("norm"), X.normalize_squash(n).alias("squash")
    )


@Q.add(
    "b05_local_name",
    "SELECT DISTINCT s, CASE WHEN contains(s, '#') THEN list_extract(string_split(s, '#'), -1) ELSE list_extract(string_split(s, '/'), -1) END AS name, nullif(regexp_extract(lower(s), '([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})$', 1), '') AS uuid FROM fx_triples"
)
def b05(spark, d):
    s = F.col("s")
    return view(spark, d, "fx_triples").select("s").distinct().select(
        "s", X.local_name(s).alias("name"), X.uuid_of_uri(s).alias("uuid")
    )


@Q.add("b06_safe_uri_name", r"""SELECT id, CASE WHEN coalesce(length(name), 0) = 0 THEN 'unknown_concept' ELSE url_encode(translate(name, ' /:#', '____')) END AS safe,
CASE WHEN coalesce(length(name), 0) = 0 THEN 'unknown_top' ELSE url_encode(substr(regexp_replace(replace(replace(translate(trim(name), ' /:#', '____'), '(', ''), ')', ''), '[^\p{L}\p{N}_-]', '', 'g'), 1, 80)) || '_top' END AS local FROM fx_names""")
def b06(spark, d):
    n = F.col("name")
    return view(spark, d, "fx_names").select(
        "id", X.safe_uri_name(n).alias("safe"), X.safe_local_name(n, "top").alias("local")
    )


_STOP = "[" + ", ".join(f"'{w}'" for w in X.STOP_WORDS) + "]"


@Q.add(
    "b08_keywords_of",
    f"SELECT c, array_to_string(list_filter(string_split({NORM.format('concept')}, ' '), lambda x: length(x) > 2), ' ') AS long_words, array_to_string(list_sort(list_distinct(list_filter(string_split({NORM.format('concept')}, ' '), lambda x: length(x) > 1 AND NOT list_contains({_STOP}, x)))), ' ') AS content_words FROM fx_queries"
)
def b08(spark, d):
    n = X.normalize_concept(F.col("concept"))
    return view(spark, d, "fx_queries").select(
        "c", F.array_join(X.keywords_of(n), " ").alias("long_words"),
        F.array_join(F.array_sort(F.array_distinct(X.keywords_of(n, 1, X.STOP_WORDS))), " ").alias("content_words")
    )


@Q.add(
    "b09_bm25_tokens",
    rf"SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct, array_to_string(t[1:5], ' ') AS first_tokens FROM (SELECT doc_id, list_filter(regexp_extract_all(lower(definition), '[\p{{L}}\p{{N}}_]{{2,}}'), lambda x: NOT list_contains({_STOP}, x)) AS t FROM fx_docs)"
)
def b09(spark, d):
    t = view(spark, d, "fx_docs").select("doc_id", X.bm25_tokens(F.col("definition"), X.STOP_WORDS).alias("t"))
    return t.select(
        "doc_id", F.size("t").cast("long").alias("n_tokens"),
        F.size(F.array_distinct("t")).cast("long").alias("n_distinct"),
        F.array_join(F.slice("t", 1, 5), " ").alias("first_tokens")
    )


_SET = r"list_distinct(list_filter(string_split_regex(lower({0}), '\s+'), lambda x: x <> ''))"
_A, _B = _SET.format("coalesce(a, '')"), _SET.format("coalesce(b, '')")


@Q.add("b10_jaccard_words", f"""WITH p AS (SELECT id, name AS a, p_name || ' ' || p_type AS b FROM fx_names JOIN part ON id = p_partkey), s AS (SELECT id, a, {_A} AS x, {_B} AS y FROM p), n AS (SELECT id, a, len(list_intersect(x, y)) AS i, len(list_distinct(list_concat(x, y))) AS u FROM s)
SELECT id, CASE WHEN u = 0 THEN 1.0 ELSE i / u END AS jaccard, CASE WHEN a IS NULL THEN NULL WHEN u = 0 THEN 0.0 ELSE 0.7 * i / u END AS overlap FROM n""")
def b10(spark, d):
    p = view(spark, d, "part")
    j = view(spark, d, "fx_names").join(p, F.col("id") == F.col("p_partkey")).select(
        "id", F.col("name").alias("a"), F.concat_ws(" ", "p_name", "p_type").alias("b")
    )
    return j.select(
        "id", X.jaccard_words(F.col("a"), F.col("b")).alias("jaccard"),
        F.when(F.col("a").isNotNull(), X.word_overlap(F.col("a"), F.col("b"))).alias("overlap")
    )


@Q.add(
    "b13_label_match_kind",
    "SELECT p_partkey, CASE WHEN n = p_name THEN 'Exact' WHEN n = p_name || 's' THEN 'Plural input' WHEN p_name = n || 's' THEN 'Plural label' END AS kind FROM (SELECT p_partkey, p_name, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_name || 's' ELSE left(p_name, length(p_name) - 1) END AS n FROM part)"
)
def b13(spark, d):
    p = view(spark, d, "part").selectExpr(
        "p_partkey", "p_name",
        "CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_name || 's' ELSE left(p_name, length(p_name) - 1) END AS n"
    )
    return p.select("p_partkey", X.label_match_kind(F.col("n"), F.col("p_name")).alias("kind"))


PREFERRED = [f"urn:fx:src{i}:" for i in range(4)]


@Q.add(
    "b17_ns_priority",
    "SELECT uri, " + "CASE " + " ".join(
        f"WHEN starts_with(uri, '{p}') THEN {i}" for i, p in enumerate(PREFERRED)
    ) + " ELSE 14 END AS priority, greatest(0, least(1, doc_id / 500.0 - 0.5)) AS clamped FROM fx_docs"
)
def b17(spark, d):
    return view(spark, d, "fx_docs").select(
        "uri", X.ns_priority(F.col("uri"), PREFERRED).alias("priority"),
        X.clamp01(F.col("doc_id") / 500.0 - 0.5).alias("clamped")
    )


_URIS = "SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'urn:fx:part:#' || CAST(p_partkey AS STRING) WHEN 1 THEN 'ftp:' || p_name WHEN 2 THEN 'http://x/<' || p_brand || '>' ELSE 'urn:{' || p_type || '}' END AS uri FROM part"


@Q.add("b19_uri_checks", f"""WITH u AS ({_URIS}), b AS (SELECT id, uri, array_to_string(list_sort(list_distinct(regexp_extract_all(uri, '[ <>"{{}}|\\\\^`]'))), '') AS bad FROM u)
SELECT id, 'WARNING' AS severity, 'scheme is not http, https or urn' AS message FROM b WHERE NOT regexp_matches(uri, '^(http|https|urn):') UNION ALL SELECT id, 'ERROR', 'invalid characters: ' || bad FROM b WHERE bad <> ''""")
def b19(spark, d):
    view(spark, d, "part").createOrReplaceTempView("part")
    return spark.sql(_URIS).select(
        "id", F.explode(X.uri_problems(F.col("uri"))).alias("i")
    ).select("id", "i.severity", "i.message")


_LITERALS = "SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN 'boolean' WHEN 1 THEN 'integer' WHEN 2 THEN 'double' WHEN 3 THEN 'decimal' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'string' ELSE 'dateTime' END END AS kind, CASE WHEN o_orderkey % 7 = 0 THEN o_orderpriority WHEN o_orderkey % 10 = 9 THEN substr(CAST(o_orderdate AS STRING), 1, 10) || 'T00:00:00' WHEN o_orderkey % 5 = 0 THEN CASE WHEN o_orderstatus = 'F' THEN 'no' ELSE ' TRUE' END WHEN o_orderkey % 5 = 1 THEN CAST(o_custkey AS STRING) ELSE CAST(o_custkey AS STRING) || '.25' END AS value FROM orders"


@Q.add("b20_typed_literal", f"""WITH v AS ({_LITERALS}), m AS (SELECT id, value, CASE kind WHEN 'boolean' THEN CASE WHEN lower(trim(value)) IN ('true', '1', 'yes') THEN 'true' WHEN lower(trim(value)) IN ('false', '0', 'no') THEN 'false' END
WHEN 'integer' THEN CAST(TRY_CAST(value AS BIGINT) AS VARCHAR) WHEN 'double' THEN CASE WHEN TRY_CAST(value AS DOUBLE) IS NOT NULL THEN trim(value) END WHEN 'decimal' THEN CASE WHEN TRY_CAST(value AS DECIMAL(38,6)) IS NOT NULL THEN trim(value) END ELSE value END AS t, kind = 'dateTime' AND TRY_CAST(value AS TIMESTAMP) IS NULL AS no_time FROM v)
SELECT id, t AS text, value IS NOT NULL AND (t IS NULL OR no_time) AS failed FROM m""")
def b20(spark, d):
    view(spark, d, "orders").createOrReplaceTempView("orders")
    return spark.sql(_LITERALS).select(
        "id", X.typed_literal(F.col("value"), F.col("kind")).alias("x")
    ).select("id", "x.text", "x.failed")


@Q.add(
    "b21_nested_get",
    "SELECT event_id, coalesce(CAST(json_extract(props, '$.k') AS BIGINT), -1) AS k, coalesce(json_extract_string(props, '$.none'), 'default') AS missing FROM events"
)
def b21(spark, d):
    get = lambda path: F.get_json_object("props", path)
    return view(spark, d, "events").select(
        "event_id", F.coalesce(get("$.k").cast("long"), F.lit(-1)).alias("k"),
        F.coalesce(get("$.none"), F.lit("default")).alias("missing")
    )


_REPLIES = "SELECT event_id AS c, CASE event_id % 4 WHEN 0 THEN 'Here it is: ```json ' || props || ' ``` done' WHEN 1 THEN 'so ' || props || ' .' WHEN 2 THEN 'no object [1, 2]' ELSE '{broken' || props END AS reply FROM events"


@Q.add("b22_json_from_reply", f"""WITH r AS ({_REPLIES}), b AS (SELECT c, coalesce(nullif(regexp_extract(reply, '(?is)```json\\s*(\\{{.*?\\}})\\s*```', 1), ''), regexp_extract(reply, '(?s)(\\{{.*\\}})', 1)) AS body FROM r)
SELECT c, CASE WHEN json_valid(body) AND body <> '' THEN CAST(json_extract(body, '$.k') AS BIGINT) END AS k, json_valid(body) AND body <> '' AS is_object FROM b""")
def b22(spark, d):
    view(spark, d, "events").createOrReplaceTempView("events")
    r = spark.sql(_REPLIES).select("c", X.json_from_reply(F.col("reply")).alias("o"))
    return r.select(
        "c", F.get_json_object("o", "$.k").cast("long").alias("k"), F.col("o").isNotNull().alias("is_object")
    )


_RULES = "SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'must have ' || CAST(p_size AS STRING) || ' of the following' WHEN 1 THEN 'a ' || CAST(p_size % 6 AS STRING) || '-star hotel' ELSE 'Property has a pool' END AS rule, 'Pet-Friendly ' || p_type || ' Property 4 stars' AS theme, '===' || chr(10) || p_name || chr(10) || chr(10) || chr(10) || chr(10) || p_brand || ' ' AS section FROM part"


@Q.add("b23_count_and_stars", f"""WITH r AS ({_RULES}) SELECT id, CAST(coalesce(nullif(regexp_extract(rule, '(?i)(\\d+)\\s+of\\b', 1), ''), '1') AS INT) AS n, CAST(nullif(regexp_extract(rule, '(?i)(\\d+(?:\\.\\d+)?)\\+?[- ]?stars?\\b', 1), '') AS DOUBLE) AS stars,
array_to_string(list_filter(string_split_regex(regexp_replace(replace(lower(theme), '-', ' '), '\\b(property|properties|friendly|certified|stars?|theme)\\b', '', 'g'), '\\s+'), lambda x: x <> ''), ' ') AS theme, trim(regexp_replace(regexp_replace(section, '(?m)^=+$', '', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')) AS section FROM r""")
def b23(spark, d):
    view(spark, d, "part").createOrReplaceTempView("part")
    return spark.sql(_RULES).select(
        "id", X.required_count(F.col("rule")).alias("n"), X.required_stars(F.col("rule")).alias("stars"),
        X.theme_name(F.col("theme")).alias("theme"), X.clean_section(F.col("section")).alias("section")
    )


_SPAN_TEXT = "SELECT p_partkey AS doc_id, CASE p_partkey % 5 WHEN 0 THEN 'Properties must have ' || CAST(p_size AS STRING) || ' of the following' || chr(10) || 'rest of ' || p_name WHEN 1 THEN '**must have ' || p_name || '** OR **property has spa** tail **' || p_brand || '**' WHEN 2 THEN 'A minimum requirement is ' || CAST(p_size AS STRING) || chr(10) || 'more' WHEN 3 THEN 'Required: two of the following ' || p_type ELSE 'The Property has a ' || p_type || ' pool AND 3 stars' || chr(10) || 'Required: ' || p_name || chr(10) || 'properties have ' || p_brand END AS text FROM part"
_SPANS = [
    r"(?im)Properties must have[^\n]*", r"(?im)\*\*[^\n]*?\*\*(?:\s*(?:OR|AND)\s*\*\*[^\n]*?\*\*)*",
    r"(?im)Minimum requirement is[^\n]*", r"(?im)(?:Must have|Required:)[^\n]*"
]
_LAST = r"(?im)((?:Property has|Properties have)\s+[^\n]*?)(?:\s*(?:AND|OR|<br>|\n)|$)"


@Q.add(
    "b24_find_rule_spans",
    f"WITH t AS ({_SPAN_TEXT}), s AS (" + " UNION ".join(
        [
            *(f"SELECT doc_id, unnest(regexp_extract_all(text, '{x}')) AS span FROM t" for x in _SPANS),
            f"SELECT doc_id, unnest(regexp_extract_all(text, '{_LAST}', 1)) FROM t"
        ]
    ) + ") SELECT DISTINCT doc_id, span FROM s WHERE regexp_matches(lower(span), 'must have|of the following|minimum requirement|property has|properties have')"
)
def b24(spark, d):
    view(spark, d, "part").createOrReplaceTempView("part")
    return rule_spans(spark.sql(_SPAN_TEXT))
