"""Queries of concepts, edges, catalogues and term statistics."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import functions as F

from ..functions.text import STOP_WORDS
from ..operators import concepts as C
from ..operators import retrieval as R
from ..operators import vectors as V
from ..operators.impact import bm25_by_impact, impact_index
from ..sources import files as S
from .fixtures import RDFS, Registry, view
from ..stages import new_folder, staged

Q = Registry()

SHORT = "list_extract(string_split(list_extract(string_split({0}, '/'), -1), '#'), -1)"
P = SHORT.format("p")
LOCAL = "CASE WHEN contains({0}, '#') THEN list_extract(string_split({0}, '#'), -1) ELSE list_extract(string_split({0}, '/'), -1) END"
NS = "left({0}, length({0}) - length(" + LOCAL + "))"
S_NS, S_LOCAL = NS.format("s"), LOCAL.format("s")

CONCEPTS = f"""WITH t AS (SELECT s AS uri, {P} AS p, o FROM fx_triples), g AS (SELECT uri,
coalesce(list_sort(list(o) FILTER (p = 'prefLabel')), []) AS pref, coalesce(list_sort(list(o) FILTER (p = 'label')), []) AS rdfs, coalesce(list_sort(list(o) FILTER (p = 'altLabel')), []) AS alt,
coalesce(list_sort(list(o) FILTER (p = 'definition')), []) AS defs, coalesce(list_sort(list(o) FILTER (p = 'type')), []) AS types, coalesce(list_sort(list(o) FILTER (p = 'broader')), []) AS broader FROM t GROUP BY uri)"""


def concepts(spark, d):
    return C.triples_to_concepts(view(spark, d, "fx_triples"))


@Q.add(
    "a02_triples_to_concepts",
    CONCEPTS + f" SELECT uri, {NS.format('uri')} AS namespace, array_to_string(pref, '|') AS pref, array_to_string(rdfs, '|') AS rdfs, array_to_string(alt, '|') AS alt, array_to_string(defs, '|') AS defs, array_to_string(types, '|') AS types, array_to_string(broader, '|') AS broader FROM g WHERE len(pref) + len(rdfs) + len(alt) + len(defs) + len(types) > 0"
)
def a02(spark, d):
    j = lambda c, n: F.array_join(c, "|").alias(n)
    return concepts(spark, d).select(
        "uri", "namespace", j("pref_labels", "pref"), j("rdfs_labels", "rdfs"), j("alt_labels", "alt"),
        j("definitions", "defs"), j("types", "types"),
        F.array_join(
            F.coalesce(
                F.get(F.map_values(F.map_filter("props", lambda k, _: k == "broader")), F.lit(0)),
                F.array().cast("array<string>")
            ),
            "|"
        ).alias("broader")
    )


@Q.add("a03_concepts_strict", f"""WITH t AS (SELECT s, {P} AS prop, o FROM fx_triples), gone AS (SELECT DISTINCT s FROM t WHERE prop = 'deprecated' AND lower(o) = 'true')
SELECT s AS uri, prop, array_to_string(list_sort(list(DISTINCT o)), '|') AS vals FROM t WHERE prop IN ('prefLabel', 'label', 'altLabel', 'definition', 'type', 'broader') AND s NOT IN (SELECT s FROM gone) GROUP BY s, prop""")
def a03(spark, d):
    return C.concepts_strict(view(spark, d, "fx_triples")).select(
        "uri", "prop", F.array_join("values", "|").alias("vals")
    )


@Q.add("a04_concept_edges", f"SELECT s AS src, {P} AS rel, o AS dst FROM fx_triples WHERE {P} = 'broader'")
def a04(spark, d):
    return C.concept_edges(view(spark, d, "fx_triples"))


_CSV = "SELECT 'urn:fx:part:#' || CAST(p_partkey AS STRING) AS uri, CASE WHEN p_size <> 7 THEN p_brand END AS name, CASE WHEN p_size <> 9 THEN p_type END AS definition, p_partkey AS line FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT 'urn:fx:part:#' || CAST(p_partkey * 2 AS STRING), 'again ' || p_brand, p_name, 2000000000 + p_partkey FROM part"
FIRST_CSV = f"e AS (SELECT uri, coalesce(name, '') AS name, coalesce(definition, '') AS definition FROM ({_CSV}) QUALIFY row_number() OVER (PARTITION BY uri ORDER BY line) = 1)"


def enriched(spark, d):
    view(spark, d, "part").createOrReplaceTempView("part")
    return C.enrichment(spark.sql(_CSV))


@Q.add("a05_enrichment", f"WITH {FIRST_CSV} SELECT * FROM e")
def a05(spark, d):
    return enriched(spark, d)


@Q.add(
    "d01_enrich_docs",
    f"{CONCEPTS}, {FIRST_CSV} SELECT g.uri, name, definition FROM g LEFT JOIN e USING (uri) WHERE len(pref) + len(rdfs) + len(alt) + len(defs) + len(types) > 0"
)
def d01(spark, d):
    return C.enrich(concepts(spark, d), enriched(spark, d)).select(
        "uri", F.col("enriched_name").alias("name"), F.col("enriched_definition").alias("definition")
    )


_LINES = "SELECT p_partkey AS line_no, CASE p_partkey % 5 WHEN 0 THEN '# ' || p_name WHEN 1 THEN '  ' WHEN 2 THEN ' ' || p_name || ' ' WHEN 3 THEN upper(p_name) || ',extra' ELSE p_type END AS line FROM part"


def lines(spark, d):
    view(spark, d, "part").createOrReplaceTempView("part")
    return spark.sql(_LINES)


@Q.add(
    "a07_distinct_concepts",
    f"WITH l AS ({_LINES}) SELECT min(line_no) AS line_no, trim(line) AS concept FROM l WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#') GROUP BY trim(line)"
)
def a07(spark, d):
    return S.distinct_concepts(lines(spark, d))


@Q.add(
    "a08_corpus_terms",
    f"WITH l AS ({_LINES}), n AS (SELECT DISTINCT array_to_string(list_filter(string_split_regex(lower(regexp_replace(regexp_replace(string_split(line, ',')[1], '([a-z0-9])([A-Z])', '\\1 \\2', 'g'), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g')), '\\s+'), lambda x: x <> ''), ' ') AS term FROM l) SELECT term FROM n WHERE term <> ''"
)
def a08(spark, d):
    return S.corpus_terms(lines(spark, d))


@Q.add(
    "f12_first_concepts",
    f"WITH l AS ({_LINES}), c AS (SELECT min(line_no) AS line_no, trim(line) AS concept FROM l WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#') GROUP BY trim(line)) SELECT * FROM c ORDER BY line_no LIMIT 20"
)
def f12(spark, d):
    return S.first_concepts(S.distinct_concepts(lines(spark, d)), 20)


@Q.add(
    "a15_taxonomy_catalog",
    f"""SELECT source_file, {S_NS} AS item, count(DISTINCT s) AS n, 'namespace' AS kind FROM fx_triples GROUP BY ALL UNION ALL SELECT source_file, {P}, count(*), 'skos' FROM fx_triples WHERE contains(p, 'skos') GROUP BY ALL UNION ALL SELECT source_file, {P}, count(*), 'relationship' FROM fx_triples WHERE o_kind = 'uri' GROUP BY ALL"""
)
def a15(spark, d):
    return C.taxonomy_catalog(view(spark, d, "fx_triples"))


@Q.add(
    "h08_taxonomy_load_report",
    "SELECT source_file, count(DISTINCT uri) AS concepts FROM (SELECT source_file, s AS uri FROM fx_triples UNION ALL SELECT source_file, o FROM fx_triples WHERE o_kind = 'uri') GROUP BY source_file"
)
def h08(spark, d):
    return C.taxonomy_load_report(view(spark, d, "fx_triples"))


@Q.add(
    "e32_triple_stats",
    f"SELECT count(*) AS triples, count(DISTINCT s) AS subjects, count(DISTINCT p) AS predicates, count(DISTINCT CASE WHEN o_kind = 'uri' THEN o END) AS uri_objects, count(DISTINCT CASE WHEN o_kind = 'literal' THEN o END) AS literal_objects, count(DISTINCT {S_NS}) AS namespaces FROM fx_triples"
)
def e32(spark, d):
    return C.triple_stats(view(spark, d, "fx_triples"))


@Q.add(
    "e32_triple_sketches",
    "SELECT count(*) AS triples, true AS subjects, true AS predicates, true AS uri_objects, true AS literal_objects, true AS namespaces FROM fx_triples"
)
def e32s(spark, d):
    """The sketches of the files, joined: whether each estimate is within 3 % of the exact count."""
    t = view(spark, d, "fx_triples")
    exact = C.triple_stats(t).drop("triples").select(*(F.col(c).alias(f"x_{c}") for c in C.SKETCHED))
    near = lambda c: (F.abs(F.col(c) - F.col(f"x_{c}")) <= 0.03 * F.col(f"x_{c}")).alias(c)
    both = C.sketched_stats(staged(C.triple_sketches(t), "sketches")).join(F.broadcast(exact))  # one row each
    return both.select("triples", *(near(c) for c in C.SKETCHED))


WORDS = "nullif(array_to_string(list_transform(list_filter(string_split_regex(translate(regexp_replace({0}, '([a-z0-9])([A-Z])', '\\1 \\2', 'g'), '_-', '  '), '\\s+'), lambda x: x <> ''), lambda x: upper(left(x, 1)) || lower(substr(x, 2))), ' '), '')"
LABELLED = CONCEPTS + f", l AS (SELECT uri, types, coalesce(pref[1], rdfs[1], alt[1], CASE WHEN length(defs[1]) > 60 THEN left(defs[1], 60) || '...' ELSE defs[1] END, {WORDS.format(LOCAL.format('uri'))}, uri) AS label, coalesce(pref[1], rdfs[1], alt[1], {WORDS.format(LOCAL.format('uri'))}, uri) AS fallback_label FROM g WHERE len(pref) + len(rdfs) + len(alt) + len(defs) + len(types) > 0)"


@Q.add("b04_primary_label", LABELLED + " SELECT uri, label FROM l")
def b04(spark, d):
    return C.labelled(concepts(spark, d))


@Q.add(
    "d02_type_labels",
    LABELLED + ", x AS (SELECT a.uri, a.t, coalesce(b.fallback_label, a.t) AS name FROM (SELECT uri, unnest(types) AS t FROM l) a LEFT JOIN l b ON b.uri = a.t) SELECT uri, array_to_string(list_sort(list(DISTINCT name)), '|') AS type_labels FROM x WHERE name <> t OR regexp_matches(name, 'Concept|Class') GROUP BY uri"
)
def d02(spark, d):
    return C.type_labels(concepts(spark, d)).select("uri", F.array_join("type_labels", "|").alias("type_labels"))


_TOK = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]{{2,}}')"
WEIGHTED = CONCEPTS + f""", {FIRST_CSV}, parts AS (SELECT uri, 3 AS k, unnest({_TOK.format("array_to_string(pref, ' ')")}) AS term FROM g UNION ALL SELECT uri, 1, unnest({_TOK.format("array_to_string(alt, ' ')")}) FROM g
UNION ALL SELECT g.uri, 4, unnest({_TOK.format('name')}) FROM g JOIN e USING (uri) UNION ALL SELECT g.uri, 2, unnest({_TOK.format('definition')}) FROM g JOIN e USING (uri)), w AS (SELECT term, uri, CAST(sum(k) AS BIGINT) AS tf FROM parts GROUP BY term, uri)"""


@Q.add("e01_weighted_document", WEIGHTED + " SELECT * FROM w")
def e01(spark, d):
    return C.weighted_terms(concepts(spark, d), enriched(spark, d))


@Q.add(
    "e02_term_stats",
    WEIGHTED + " SELECT 'doc' AS kind, uri AS key, CAST(sum(tf) AS BIGINT) AS n FROM w GROUP BY uri UNION ALL SELECT 'term', term, count(*) FROM w GROUP BY term"
)
def e02(spark, d):
    docs, terms = C.term_stats(C.weighted_terms(concepts(spark, d), enriched(spark, d)))
    return docs.select(F.lit("doc").alias("kind"), F.col("uri").alias("key"), F.col("dl").alias("n")).unionByName(
        terms.select(F.lit("term").alias("kind"), F.col("term").alias("key"), F.col("df").alias("n"))
    )


@Q.add(
    "j01_embedding_text",
    CONCEPTS + " SELECT uri, array_to_string(list_concat(flatten(list_transform(pref, lambda x: [x, x, x])), flatten(list_transform(rdfs, lambda x: [x, x])), alt, defs), ' ') AS text FROM g WHERE len(pref) + len(rdfs) + len(alt) > 0"
)
def j01(spark, d):
    return C.embedding_text(concepts(spark, d))


INDEX = CONCEPTS + ", k AS (SELECT DISTINCT uri, unnest(list_filter(string_split(lower(regexp_replace(replace(replace(array_to_string(pref, ' '), '-', ' '), '_', ' '), '[^\\p{L}\\p{N}_\\s]', '', 'g')), ' '), lambda x: length(x) > 2)) AS keyword FROM g)"


@Q.add(
    "d04_keyword_index_search",
    INDEX + " SELECT c, k.uri, count(DISTINCT keyword) AS hits FROM (SELECT DISTINCT p_name AS c, unnest(string_split(p_name, ' ')) AS keyword FROM part) q JOIN k USING (keyword) GROUP BY c, k.uri"
)
def d04(spark, d):
    q = view(spark, d, "part").select(F.col("p_name").alias("c"), F.split("p_name", " ").alias("terms")).distinct()
    return R.keyword_search(q, C.keyword_index(concepts(spark, d)))


@Q.add("a16_vectors_checked", "SELECT vec_id, NOT (vec_id % 100 = 0) AS good FROM embeddings")
def a16(spark, d):
    e = view(spark, d, "embeddings").select(
        "vec_id",
        F.expr(
            "CASE WHEN vec_id % 100 = 0 THEN transform(embedding, (x, i) -> CASE WHEN i = 0 THEN CASE WHEN vec_id % 200 = 0 THEN float('NaN') ELSE float('Infinity') END ELSE x END) ELSE embedding END"
        ).alias("v")
    )
    good, bad = V.vectors_checked(e)
    return good.select("vec_id", F.lit(True).alias("good")).unionByName(
        bad.select("vec_id", F.lit(False).alias("good"))
    )


_TOKENS = rf"list_filter(regexp_extract_all(lower({{0}}), '[\p{{{{L}}}}\p{{{{N}}}}_]{{{{2,}}}}'), lambda x: NOT list_contains({[*STOP_WORDS]}, x))"
DOC_POSTINGS = f"q AS (SELECT c, unnest(list_distinct({_TOKENS.format('concept')})) AS term FROM fx_queries), w AS (SELECT term, uri, count(*) AS tf FROM (SELECT uri, unnest({_TOKENS.format('definition')}) AS term FROM fx_docs) GROUP BY term, uri), dl AS (SELECT uri, sum(tf) AS dl FROM w GROUP BY uri), st AS (SELECT term, count(*) AS df FROM w GROUP BY term), n AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl)"


def bm25_sql(variant: str) -> str:
    if variant == "lucene":
        idf, k = "ln(1 + (n - df + 0.5) / (df + 0.5))", 1.0
    else:
        idf, k = "CASE WHEN ln((n - df + 0.5) / (df + 0.5)) < 0 THEN 0.25 * (SELECT avg(ln((n - df + 0.5) / (df + 0.5))) FROM st, n) ELSE ln((n - df + 0.5) / (df + 0.5)) END", 2.5
    return f"{DOC_POSTINGS}, idf AS (SELECT term, {idf} AS idf FROM st, n), s AS (SELECT c, uri, sum(idf * tf * {k} / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / avgdl))) AS kw_score FROM w JOIN q USING (term) JOIN idf USING (term) JOIN dl USING (uri), n GROUP BY c, uri HAVING sum(idf * tf * {k} / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / avgdl))) >= 0.01), kw AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY c ORDER BY round(kw_score, 9) DESC, uri) <= 500)"


def doc_queries(spark, d):
    from ..functions.text import bm25_tokens

    return view(spark, d, "fx_queries").select("c", bm25_tokens(F.col("concept"), STOP_WORDS).alias("terms"))


def doc_postings(spark, d):
    """Written once: lengths, term statistics and hits read it."""
    return staged(C.text_postings(view(spark, d, "fx_docs"), "uri", "definition", STOP_WORDS), "postings")


@Q.add("e03_bm25_search", "WITH " + bm25_sql("lucene") + " SELECT c, uri, round(kw_score, 4) AS kw_score FROM kw")
def e03(spark, d):
    return R.bm25_search(doc_queries(spark, d), doc_postings(spark, d)).withColumn("kw_score", F.round("kw_score", 4))


@Q.add("e03_bm25_tiers", "WITH " + bm25_sql("lucene") + " SELECT c, uri, round(kw_score, 4) AS kw_score FROM kw")
def e03t(spark, d):
    """The same over postings in tiers of impact."""
    index = impact_index(doc_postings(spark, d))
    return bm25_by_impact(doc_queries(spark, d), index).withColumn("kw_score", F.round("kw_score", 4))


@Q.add("e03_bm25_okapi", "WITH " + bm25_sql("okapi") + " SELECT c, uri, round(kw_score, 4) AS kw_score FROM kw")
def e03o(spark, d):
    return R.bm25_search(
        doc_queries(spark, d), doc_postings(spark, d), variant="okapi"
    ).withColumn("kw_score", F.round("kw_score", 4))


@Q.add(
    "e04_tfidf_search",
    f"WITH {DOC_POSTINGS}, t AS (SELECT term, uri, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM w JOIN st USING (term), n WHERE df >= 2 AND df <= 0.95 * n), m AS (SELECT uri, sqrt(sum(w * w)) AS norm FROM t GROUP BY uri) SELECT c, uri, round(max(w / norm), 4) AS kw_score FROM t JOIN q USING (term) JOIN m USING (uri) GROUP BY c, uri HAVING max(w / norm) >= 0.05"
)
def e04(spark, d):
    return R.tfidf_search(doc_queries(spark, d), doc_postings(spark, d)).withColumn("kw_score", F.round("kw_score", 4))


@Q.add(
    "c09_needs_expansion",
    f"WITH {DOC_POSTINGS}, h AS (SELECT c, count(DISTINCT uri) AS n_hits FROM w JOIN q USING (term) WHERE tf >= 3 GROUP BY c) SELECT f.c, coalesce(n_hits, 0) AS n_hits FROM fx_queries f LEFT JOIN h USING (c) LEFT JOIN fx_overrides o USING (c) WHERE coalesce(n_hits, 0) < 5 AND NOT coalesce(skip_expansion, false)"
)
def c09(spark, d):
    index = doc_postings(spark, d).filter("tf >= 3").select(F.col("term").alias("keyword"), "uri")
    q = doc_queries(spark, d)
    return R.needs_expansion(q, R.keyword_search(q, index), view(spark, d, "fx_overrides"))


# files: the tables written in the form that a reader takes, and read back
#: Texts with line breaks, quotes and backslashes as literals with a language.
_COMMENTS = f"SELECT 'urn:fx:doc:#' || CAST(doc_id AS STRING) AS s, '{RDFS}comment' AS p, coalesce(text, '') || chr(92) || 'new' || chr(13) || chr(9) || chr(34) AS o, 'literal' AS o_kind, lang AS o_lang FROM documents"
BROKEN = ["<urn:broken> no", "ex:broken <urn:p> 'no prefix' ."]


@Q.add(
    "a01_read_triples",
    f"SELECT s, p, o, o_kind, NULL AS o_lang FROM fx_triples UNION ALL ({_COMMENTS}) UNION ALL SELECT 'ERROR', 'PARSING', '{BROKEN[0]}', 'issue', NULL UNION ALL SELECT 'ERROR', 'PARSING', 'unknown prefix', 'issue', NULL"
)
def a01(spark, d):
    """A folder of N-Triples, of Turtle and of RDF/XML, the first two with a broken statement."""
    base, t = new_folder(spark, "triples"), view(spark, d, "fx_triples")
    view(spark, d, "documents").createOrReplaceTempView("documents")
    texts = spark.sql(_COMMENTS)
    some = t.withColumn("o_lang", F.lit(None).cast("string"))
    of = lambda *files: some.filter(F.col("source_file").isin(*files)).drop("source_file")
    half = F.pmod(F.xxhash64("s"), F.lit(2)) == 0
    S.ntriple_lines(of("part", "region").unionByName(texts.filter(half))).write.text(f"{base}/lines.nt")
    statements = of("supplier", "customer").unionByName(texts.filter(~half))
    S.write_triples(statements, f"{base}/deep/statements.ttl", S.PREFIXES | {"doc": "urn:fx:doc:#"})
    for name, line in zip(("lines.nt", "statements.ttl"), BROKEN, strict=True):
        spark.createDataFrame([(line,)], "value string").write.text(f"{base}/broken/{name}")
    element = F.when(
        F.col("o_kind") == "uri", F.concat(F.lit('<skos:broader rdf:resource="'), "o", F.lit('"/>'))
    ).otherwise(F.concat(F.lit("<skos:prefLabel>"), "o", F.lit("</skos:prefLabel>")))
    nodes = t.filter("source_file = 'nation'").groupBy("s").agg(
        F.array_join(F.array_sort(F.collect_list(element)), "").alias("x")
    )
    xml = nodes.select(
        F.concat(F.lit('<rdf:Description rdf:about="'), "s", F.lit('">'), "x", F.lit("</rdf:Description>")).alias("x")
    ).agg(
        F.concat(
            F.lit('<?xml version="1.0"?><rdf:RDF xmlns:rdf="r" xmlns:skos="s">'),
            F.array_join(F.collect_list("x"), "\n"), F.lit("</rdf:RDF>")
        ).alias("value")
    )
    xml.write.text(f"{base}/deep/nodes.xml")
    good, bad = S.read_triples(spark, base)
    return good.select("s", "p", "o", "o_kind", "o_lang").unionByName(
        bad.select(
            F.col("severity").alias("s"), F.col("category").alias("p"),
            F.regexp_replace("message", "^(unknown prefix).*", "$1").alias("o"), F.lit("issue").alias("o_kind"),
            F.lit(None).cast("string").alias("o_lang")
        )
    )


@Q.add(
    "a06_read_concepts",
    f"WITH l AS ({_LINES}) SELECT trim(line) AS concept, count(*) AS n FROM l WHERE trim(line) <> '' GROUP BY trim(line)"
)
def a06(spark, d):
    path = new_folder(spark, "concepts")
    lines(spark, d).select("line").write.text(path)
    return S.read_concepts(spark, path).groupBy("concept").agg(F.count(F.lit(1)).alias("n"))


_NORM = r"array_to_string(list_filter(string_split_regex(lower(regexp_replace(translate(regexp_replace({0}, '([a-z0-9])([A-Z])', '\1 \2', 'g'), '-_', '  '), '[^\p{{L}}\p{{N}}_\s]', '', 'g')), '\s+'), lambda x: x <> ''), ' ')"


@Q.add(
    "a09_read_associations",
    f"SELECT {_NORM.format('p_type')} AS concept, {_NORM.format('p_name')} AS label FROM (SELECT DISTINCT p_type, 'Fine-' || p_name AS p_name FROM part) UNION ALL SELECT DISTINCT {_NORM.format('p_brand')}, {_NORM.format('p_brand')} FROM part"
)
def a09(spark, d):
    """A JSON object of lists and of plain strings."""
    p, path = view(spark, d, "part"), new_folder(spark, "associations")
    lists = p.groupBy("p_type").agg(F.collect_set(F.concat(F.lit("Fine-"), "p_name")).alias("v")).select(
        F.concat(F.to_json(F.array("p_type")), F.lit("\n"), F.to_json("v")).alias("x")
    )
    plain = p.select("p_brand").distinct().select(
        F.concat(F.to_json(F.array("p_brand")), F.lit("\n"), F.to_json(F.array("p_brand"))).alias("x"),
        F.lit(True).alias("one")
    )
    text = lambda x: F.concat(
        F.expr("substr(split_part(x, '\n', 1), 2, length(split_part(x, '\n', 1)) - 2)"), F.lit(": "), x
    )
    second = F.split_part("x", F.lit("\n"), F.lit(2))
    entries = lists.select(text(second).alias("e")).unionByName(
        plain.select(text(F.expr("substr(split_part(x, '\n', 2), 2, length(split_part(x, '\n', 2)) - 2)")).alias("e"))
    )

    def objects(batches):
        """The entries of a partition as one JSON object, an entry a line."""
        sign = "{"
        for batch in batches:
            for e in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"value": [sign + e]})
                sign = ","
        yield pa.RecordBatch.from_pydict({"value": ["{}" if sign == "{" else "}"]})

    entries.mapInArrow(objects, "value string").write.text(path)
    return S.read_associations(spark, path)


@Q.add(
    "a10_theme_dims",
    "SELECT 'theme' AS kind, p_type AS key, CAST(n AS VARCHAR) AS value FROM (SELECT p_type, CAST(count(*) AS DOUBLE) AS n FROM part GROUP BY p_type) UNION ALL SELECT 'subscore', p_type, 'size' FROM part GROUP BY p_type UNION ALL SELECT DISTINCT 'hint', p_type, p_brand FROM part UNION ALL SELECT 'override', lower(p_type) || ' case', 'true' FROM part GROUP BY p_type UNION ALL SELECT DISTINCT 'namespace', p_type, 'urn:' || p_brand FROM part"
)
def a10(spark, d):
    """A configuration file made of the part types (six, whatever the table's size), read on the driver."""
    rows = view(spark, d, "part").groupBy("p_type").agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("p_brand")).alias("brands")
    )
    config = rows.select(F.to_json(F.struct("p_type", "n", "brands")).alias("value")).collect()
    types = [json.loads(r.value) for r in config]
    text = json.dumps({
        "base_themes": {
            t["p_type"]: {
                "weight": t["n"], "rule_applied": "Optional", "relevant_subscores": {"size": 0.5},
                "hints": {"keywords": t["brands"]}
            } for t in types
        },
        "concept_overrides": {t["p_type"].capitalize() + "Case": {"skip_expansion": True} for t in types},
        "NAMESPACE_BIASING": {"enabled": True} | {t["p_type"]: ["urn:" + b for b in t["brands"]] for t in types},
    })
    path = new_folder(spark, "config")
    spark.createDataFrame([(text,)], "value string").write.text(path)
    dims = S.theme_dims(spark, S.read_config(spark, path))
    of = lambda kind, t, k, v: dims[t].select(
        F.lit(kind).alias("kind"), F.col(k).alias("key"), F.col(v).cast("string").alias("value")
    )
    return of("theme", "themes", "theme", "base_weight").unionByName(
        of("subscore", "theme_subscores", "theme", "subscore")
    ).unionByName(of("hint", "theme_hints", "theme", "hint")).unionByName(
        of("override", "overrides", "concept", "skip_expansion")
    ).unionByName(of("namespace", "namespaces", "grp", "prefix"))


@Q.add(
    "a14_write_mapping_csv",
    "SELECT p_type AS taxonomy_file, p_name AS concept, 'urn:fx:part:#' || CAST(p_partkey AS STRING) AS uri, p_brand AS theme, CAST(p_size AS VARCHAR) AS confidence, 15 AS n_columns FROM part"
)
def a14(spark, d):
    path = new_folder(spark, "mapping")
    rows = view(spark, d, "part").selectExpr(
        "p_type AS taxonomy_file", "p_name AS concept", "'urn:fx:part:#' || CAST(p_partkey AS STRING) AS uri",
        "p_brand AS theme", "p_size AS confidence"
    )
    S.write_mapping_csv(rows, path)
    back = spark.read.option("header", True).csv(path)
    return back.select(
        "taxonomy_file", F.col("`Travel Concept`").alias("concept"), F.col("`Matched Taxonomy URN`").alias("uri"),
        F.col("`Matched Sub-Theme`").alias("theme"), F.col("`Confidence (%)`").alias("confidence"),
        F.lit(len(back.columns) - 1).alias("n_columns")
    )


_HIT_WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+')"
_NORM_LABEL = r"regexp_replace(lower(pref_label), '[^\p{L}\p{N}_\s]', '', 'g')"


@Q.add(
    "b14_keyword_hits",
    f"WITH q AS (SELECT c, list_filter(list_distinct({_TOKENS.format('concept')}), lambda x: length(x) > 1) AS terms FROM fx_queries), w AS (SELECT c, len(terms) AS n, unnest(terms) AS word FROM q), t AS (SELECT uri, unnest(list_distinct(list_concat({_HIT_WORDS.format('pref_label')}, {_HIT_WORDS.format(_NORM_LABEL)}))) AS word FROM fx_docs) SELECT c, uri, count(*) AS hits, round(0.1 + 0.2 * least(1, count(*) / n), 6) AS score FROM t JOIN w USING (word) GROUP BY c, uri, n"
)
def b14(spark, d):
    return R.keyword_hits(
        doc_queries(spark, d), view(spark, d, "fx_docs").select("uri", F.col("pref_label").alias("text"))
    ).withColumn("score", F.round("score", 6))
