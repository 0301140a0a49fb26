"""Views over the star tables in the shapes that the operators take.

Each view is one SELECT that Spark SQL and DuckDB both accept, so the same text feeds a
query and the SQL that checks it.  A view may use the views before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings benchmark labels conversations".split()
SKOS = "http://www.w3.org/2004/02/skos/core#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
OWL = "http://www.w3.org/2002/07/owl#"


def _triple(s: str, p: str, o: str, kind: str, table: str, where: str = "") -> str:
    return f"SELECT {s} AS s, '{p}' AS p, {o} AS o, '{kind}' AS o_kind, '{table}' AS source_file FROM {table} {where}"


_PART = "'urn:fx:part:#' || CAST(p_partkey AS STRING)"
_TRIPLES = [
    _triple(_PART, SKOS + "prefLabel", "p_name", "literal", "part"),
    _triple(_PART, SKOS + "altLabel", "p_brand", "literal", "part"),
    _triple(
        _PART, SKOS + "definition", "p_type || ' of size ' || CAST(p_size AS STRING)", "literal", "part",
        "WHERE p_partkey % 3 = 0"
    ),
    _triple(_PART, RDF_TYPE, "'urn:fx:class:#' || p_type", "uri", "part"),
    _triple(_PART, SKOS + "broader", "'urn:fx:brand:#' || replace(p_brand, '#', '')", "uri", "part"),
    _triple(_PART, OWL + "deprecated", "'true'", "literal", "part", "WHERE p_size = 50"),
    _triple("'urn:fx:supplier:#' || CAST(s_suppkey AS STRING)", SKOS + "prefLabel", "s_name", "literal", "supplier"),
    _triple(
        "'urn:fx:supplier:#' || CAST(s_suppkey AS STRING)", SKOS + "broader",
        "'urn:fx:nation:#' || CAST(s_nationkey AS STRING)", "uri", "supplier"
    ),
    _triple("'urn:fx:customer:#' || CAST(c_custkey AS STRING)", RDFS + "label", "c_name", "literal", "customer"),
    _triple(
        "'urn:fx:customer:#' || CAST(c_custkey AS STRING)", SKOS + "broader",
        "'urn:fx:nation:#' || CAST(c_nationkey AS STRING)", "uri", "customer"
    ),
    _triple("'urn:fx:nation:#' || CAST(n_nationkey AS STRING)", SKOS + "prefLabel", "n_name", "literal", "nation"),
    _triple(
        "'urn:fx:nation:#' || CAST(n_nationkey AS STRING)", SKOS + "broader",
        "'urn:fx:region:#' || CAST(n_regionkey AS STRING)", "uri", "nation"
    ),
    _triple("'urn:fx:region:#' || CAST(r_regionkey AS STRING)", SKOS + "prefLabel", "r_name", "literal", "region"),
]
_NODES = [
    f"SELECT DISTINCT 'urn:fx:class:#' || p_type AS s, '{RDFS}label' AS p, p_type AS o, 'literal' AS o_kind, 'part' AS source_file FROM part",
    f"SELECT DISTINCT 'urn:fx:brand:#' || replace(p_brand, '#', '') AS s, '{SKOS}prefLabel' AS p, p_brand AS o, 'literal' AS o_kind, 'part' AS source_file FROM part",
]
_W = "[^ ]+"

VIEWS = {
    "fx_triples": " UNION ALL ".join([*_TRIPLES, *_NODES]),
    "fx_docs": f"SELECT 'urn:fx:' || source || ':#' || CAST(doc_id AS STRING) AS uri, doc_id, source, regexp_extract(text, '^({_W} {_W} {_W} {_W})', 1) AS pref_label, text AS definition FROM documents",
    "fx_queries": f"SELECT item_id AS c, regexp_extract(text, '^{_W} {_W} ({_W}( {_W}){{5}})', 1) AS concept FROM benchmark",
    "fx_names": "SELECT p_partkey AS id, CASE p_partkey % 8 WHEN 0 THEN p_name || '/' || p_brand WHEN 1 THEN replace(p_name, ' ', '-') WHEN 2 THEN replace(p_name, ' ', '_') || '''s' WHEN 3 THEN p_type || ': ' || p_name || '!' WHEN 4 THEN '(' || p_name || ')' WHEN 5 THEN 'fullService' || p_type || ' ~*+' WHEN 6 THEN '  ' || upper(p_name) || 's ' ELSE NULL END AS name FROM part",
    "fx_vec_q": "SELECT CAST(floor(vec_id / 100) AS BIGINT) AS c, embedding AS v FROM embeddings WHERE vec_id % 100 = 0",
    "fx_vec_t": "SELECT d.uri, e.vec_id, e.embedding AS v, e.label FROM embeddings e JOIN fx_docs d ON d.doc_id = e.vec_id WHERE e.vec_id % 100 <> 0",
    "fx_overrides": "SELECT item_id AS c, item_id = 3 AS skip_expansion, CASE WHEN item_id = 1 THEN 0.3 END AS effective_alpha, CASE WHEN item_id = 2 THEN 'the and' END AS manual_query, item_id = 0 AS boost_enabled, 0.8 AS boost_threshold, CASE WHEN item_id % 2 = 0 THEN 'rental' END AS property_type FROM benchmark WHERE item_id < 4",
    "fx_seeds": "SELECT DISTINCT b.item_id AS c, d.uri FROM benchmark b JOIN fx_docs d ON d.doc_id = 50 + b.item_id WHERE b.item_id < 3",
    "fx_filters": "SELECT DISTINCT b.item_id AS c, d.uri FROM benchmark b JOIN fx_docs d ON d.doc_id % 10 = b.item_id WHERE b.item_id < 3",
    "fx_themes": "SELECT DISTINCT vec_id AS theme_id, 'theme ' || CAST(vec_id AS STRING) AS theme, CAST(3 + vec_id % 8 AS DOUBLE) AS base_weight, CASE WHEN vec_id IN (2, 9) THEN 'Must have 1' WHEN vec_id = 5 THEN 'bad rule' ELSE 'Optional' END AS rule, CASE WHEN vec_id % 2 = 0 THEN 'sub ' || CAST(vec_id % 4 AS STRING) END AS subscore FROM embeddings WHERE vec_id < 15",
}


def with_views(sql: str) -> str:
    """`sql` with the views it needs before it."""
    need: list[str] = []

    def add(text: str) -> None:
        for name in VIEWS:
            if name in text and name not in need:
                add(VIEWS[name])
                if name not in need:
                    need.append(name)

    add(sql)
    head = ", ".join(f"{n} AS ({VIEWS[n]})" for n in need)
    if not head:
        return sql
    body = sql.lstrip()
    return f"WITH RECURSIVE {head}, {body[len('WITH RECURSIVE '):]}" if body.startswith("WITH RECURSIVE ") else f"WITH {head}, {body[5:]}" if body.startswith("WITH ") else f"WITH {head} {body}"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or a table of `sf_dir`."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = with_views(f"SELECT * FROM {name}")
    for t in TABLES:
        if t in sql:
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    return spark.sql(sql)


class Registry:
    """Queries and their SQL, by name."""

    def __init__(self):
        self.queries, self.sql = {}, {}

    def add(self, name: str, sql: str | None = None):
        def keep(f):
            self.queries[name] = f
            if sql:
                self.sql[name] = with_views(sql)
            return f

        return keep
