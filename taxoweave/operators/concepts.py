"""From triples to concepts, edges, catalogues, weighted texts and term statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import bm25_tokens, keywords_of, local_name, normalize_concept, primary_label

#: The well-known property names.
KNOWN = {
    "prefLabel": "pref_labels", "label": "rdfs_labels", "altLabel": "alt_labels", "definition": "definitions",
    "type": "types"
}
RELATIONS = [
    "broader", "narrower", "related", "broadMatch", "narrowMatch", "relatedMatch", "sameAs", "exactMatch", "closeMatch"
]


def short_name(p: Column) -> Column:
    """Property name after the last '/', then after the last '#'."""
    return F.substring_index(F.substring_index(p, "/", -1), "#", -1)


def namespace(uri: Column) -> Column:
    """The URI up to its local name."""
    return F.left(uri, F.length(uri) - F.length(local_name(uri)))


def triples_to_concepts(triples: DataFrame) -> DataFrame:
    """One row a URI that has a label, definition or type; values in sorted arrays.

    One aggregation over the triples; other properties are a map of sorted arrays.  Blank nodes
    are no concepts."""
    t = triples.filter(~F.startswith("s", F.lit("_:"))).select(F.col("s").alias("uri"), short_name(F.col("p")).alias("p"), "o")
    named = [F.array_sort(F.collect_list(F.when(F.col("p") == p, F.col("o")))).alias(c) for p, c in KNOWN.items()]
    other = F.collect_list(F.when(~F.col("p").isin(*KNOWN), F.struct("p", "o"))).alias("other")
    g = t.groupBy("uri").agg(*named, other).filter(F.greatest(*(F.size(c) for c in KNOWN.values())) > 0)
    keys = F.array_sort(F.array_distinct(F.transform("other", lambda x: x["p"])))
    props = F.map_from_entries(
        F.transform(
            keys,
            lambda k: F.struct(k, F.array_sort(F.transform(F.filter("other", lambda x: x["p"] == k), lambda x: x["o"])))
        )
    )
    return g.select("uri", namespace(F.col("uri")).alias("namespace"), *KNOWN.values(), props.alias("props"))


def concepts_strict(triples: DataFrame) -> DataFrame:
    """(uri, prop, values): subjects that have a known property, without deprecated ones; values
    distinct and sorted.  A subject's triples meet once, so nothing is joined."""
    t = triples.select("s", short_name(F.col("p")).alias("prop"), "o").filter("s IS NOT NULL")
    known, gone = F.col("prop").isin(*KNOWN, *RELATIONS), (F.col("prop") == "deprecated") & (F.lower("o") == "true")
    values = F.collect_set(F.when(known, F.struct("prop", "o")))
    g = t.filter(known | gone).groupBy("s").agg(values.alias("have"), F.bool_or(gone).alias("gone")).filter("NOT gone")
    one = g.select(F.col("s").alias("uri"), "have", F.explode(F.array_distinct(F.transform("have", lambda x: x["prop"]))).alias("prop"))
    of = F.filter(F.transform(F.filter("have", lambda x: x["prop"] == F.col("prop")), lambda x: x["o"]), lambda o: o.isNotNull())
    return one.select("uri", "prop", F.array_sort(of).alias("values"))


def concept_edges(triples: DataFrame) -> DataFrame:
    """(src, rel, dst) of the relations between concepts."""
    rel = short_name(F.col("p"))
    return triples.filter(rel.isin(*RELATIONS)).select(
        F.col("s").alias("src"), rel.alias("rel"), F.col("o").alias("dst")
    )


def taxonomy_catalog(triples: DataFrame) -> DataFrame:
    """(source_file, kind, item, n): namespaces with their distinct subjects, SKOS
    properties with their triples, and relationships between URIs."""
    p, skos = short_name(F.col("p")), F.contains("p", F.lit("skos"))
    spaces = triples.groupBy(
        "source_file", namespace(F.col("s")).alias("item")
    ).agg(F.count_distinct("s").alias("n")).withColumn("kind", F.lit("namespace"))
    props = triples.filter(skos).groupBy(
        "source_file", p.alias("item")
    ).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("skos"))
    links = triples.filter("o_kind = 'uri'").groupBy(
        "source_file", p.alias("item")
    ).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("relationship"))
    return spaces.unionByName(props).unionByName(links)


def taxonomy_load_report(triples: DataFrame) -> DataFrame:
    """Concepts of each file: distinct subjects and URI objects."""
    nodes = triples.select("source_file", F.col("s").alias("uri")).union(
        triples.filter("o_kind = 'uri'").select("source_file", "o")
    )
    return nodes.groupBy("source_file").agg(F.count_distinct("uri").alias("concepts"))


def triple_stats(triples: DataFrame) -> DataFrame:
    """One row: triples, distinct subjects, predicates, URI objects and literal objects, namespaces."""
    # one distinct count after the other: together they would copy every triple five times
    counted = {"subjects": F.col("s"), "predicates": F.col("p"), "namespaces": namespace(F.col("s"))}
    counted |= {f"{k}_objects": F.when(F.col("o_kind") == k, F.col("o")) for k in ("uri", "literal")}
    out = triples.agg(F.count(F.lit(1)).alias("triples"))
    for name in ("subjects", "predicates", "uri_objects", "literal_objects", "namespaces"):
        one = triples.select(counted[name].alias("x")).filter("x IS NOT NULL").distinct().agg(
            F.count(F.lit(1)).alias(name)
        )
        out = out.join(F.broadcast(one))  # one row each
    return out


SKETCHED = ["subjects", "predicates", "uri_objects", "literal_objects", "namespaces"]


def triple_sketches(triples: DataFrame, lg_k: int = 14) -> DataFrame:
    """(source_file, triples, and a distinct sketch for each of `SKETCHED`) of each file, in one pass
    over the triples.  A sketch has 2^lg_k small registers whatever the file's size, and an
    estimate from it is off by about 0.8 / 2^(lg_k / 2) (0.6 % for 14)."""
    of = {"subjects": F.col("s"), "predicates": F.col("p"), "namespaces": namespace(F.col("s"))}
    of |= {f"{k}_objects": F.when(F.col("o_kind") == k, F.col("o")) for k in ("uri", "literal")}
    return triples.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("triples"),
        # a sketch leaves out empty strings: no value is one
        *(F.hll_sketch_agg(F.concat(F.lit("."), of[c]), lg_k).alias(c) for c in SKETCHED)
    )


def sketched_stats(sketches: DataFrame) -> DataFrame:
    """One row, as `triple_stats` but estimated, of the sketches of some files: a new file is added
    without reading the others again."""
    return sketches.agg(
        F.coalesce(F.sum("triples"), F.lit(0)).alias("triples"),
        *(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(c) for c in SKETCHED)
    )


def labelled(concepts: DataFrame) -> DataFrame:
    """(uri, label): primary labels."""
    return concepts.select(
        "uri",
        primary_label(
            *(F.col(c) for c in ("uri", "pref_labels", "rdfs_labels", "alt_labels", "definitions"))
        ).alias("label")
    )


def type_labels(concepts: DataFrame) -> DataFrame:
    """(uri, type_labels): labels of the types that are concepts themselves, or whose name
    says Concept or Class; sorted and distinct."""
    uri = F.col("t")
    types = concepts.select("uri", F.explode("types").alias("t"))
    names = concepts.select(
        F.col("uri").alias("t"),
        primary_label(
            F.col("uri"), *(F.col(c) for c in ("pref_labels", "rdfs_labels", "alt_labels", "definitions")),
            fallback=F.col("uri")
        ).alias("name")
    )
    joined = types.join(names, "t", "left").withColumn("name", F.coalesce("name", uri))
    kept = joined.filter((F.col("name") != uri) | F.col("name").rlike("Concept|Class"))
    return kept.groupBy("uri").agg(F.array_sort(F.collect_set("name")).alias("type_labels"))


def enrichment(rows: DataFrame) -> DataFrame:
    """(uri, name, definition): nulls as '', the first row of a URI wins (`line` is file order)."""
    first = rows.withColumn("rn", F.row_number().over(W.partitionBy("uri").orderBy("line"))).filter("rn = 1")
    return first.select(
        "uri", F.coalesce("name", F.lit("")).alias("name"), F.coalesce("definition", F.lit("")).alias("definition")
    )


def enrich(concepts: DataFrame, enriched: DataFrame) -> DataFrame:
    """Concepts with their enrichment, where there is one."""
    return concepts.join(
        enriched.withColumnRenamed("name", "enriched_name").withColumnRenamed("definition", "enriched_definition"),
        "uri", "left"
    )


#: How often each text counts in a concept's document.
WEIGHTS = {"pref": 3, "alt": 1, "definition": 0, "name": 4, "enriched": 2}


def weighted_terms(
    concepts: DataFrame, enriched: DataFrame | None = None, weights: dict[str, int] = WEIGHTS,
    stop_words: list[str] | None = None
) -> DataFrame:
    """(term, uri, tf): term frequencies where each text counts `weights` times.  Nothing is
    repeated physically; concepts without terms have no rows."""
    tokens = lambda x: bm25_tokens(x, stop_words)
    first = F.get(F.filter("definitions", lambda d: F.trim(d) != ""), F.lit(0))
    parts = [
        (F.array_join("pref_labels", " "), weights["pref"]), (F.array_join("alt_labels", " "), weights["alt"]),
        (first, weights["definition"])
    ]
    df = concepts
    if enriched is not None:
        df = enrich(concepts, enriched)
        parts += [(F.col("enriched_name"), weights["name"]), (F.col("enriched_definition"), weights["enriched"])]
    terms = F.concat(*[_times(tokens(x), k) for x, k in parts if k])
    return df.select("uri", F.explode(terms).alias("t")).groupBy(F.col("t.term").alias("term"), "uri").agg(
        F.sum("t.k").cast("long").alias("tf")
    )


def _times(tokens: Column, k: int) -> Column:
    return F.transform(tokens, lambda t: F.struct(t.alias("term"), F.lit(k).alias("k")))


def term_stats(postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_stats [uri, dl], term_stats [term, df])."""
    return postings.groupBy("uri").agg(F.sum("tf").alias("dl")), postings.groupBy("term").agg(
        F.count(F.lit(1)).alias("df")
    )


def text_postings(docs: DataFrame, key: str, text: str, stop_words: list[str] | None = None) -> DataFrame:
    """(term, uri, tf) of a text column."""
    return docs.select(
        F.col(key).alias("uri"), F.explode(bm25_tokens(F.col(text), stop_words)).alias("term")
    ).groupBy("term", "uri").agg(F.count(F.lit(1)).alias("tf"))


def embedding_text(concepts: DataFrame) -> DataFrame:
    """(uri, text): preferred labels three times, RDFS labels twice, alternatives and
    definitions once; concepts without a label are left out."""
    parts = F.concat(_repeat("pref_labels", 3), _repeat("rdfs_labels", 2), F.col("alt_labels"), F.col("definitions"))
    return concepts.filter(
        F.size("pref_labels") + F.size("rdfs_labels") + F.size("alt_labels") > 0
    ).select("uri", F.array_join(parts, " ").alias("text"))


def _repeat(column: str, k: int) -> Column:
    return F.flatten(F.transform(column, lambda x: F.array_repeat(x, k)))


def keyword_index(concepts: DataFrame, column: str = "pref_labels", longer_than: int = 2) -> DataFrame:
    """(keyword, uri): distinct words of the normalised labels."""
    return concepts.select(
        "uri", F.explode(keywords_of(normalize_concept(F.array_join(column, " ")), longer_than)).alias("keyword")
    ).distinct().select("keyword", "uri")
