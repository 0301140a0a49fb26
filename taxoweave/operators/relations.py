"""Neighbours in the taxonomy: expansion, boosts, label matches and fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..stages import new_folder
from .retrieval import top_k


def expand_relations(
    anchors: DataFrame, edges: DataFrame, depth: int = 1, min_score: float = 0.60, decay: float = 0.35,
    relations: list[str] | None = None
) -> DataFrame:
    """(c, uri, score, depth): anchors (c, uri, score) and what is reached from those at
    `min_score` along the edges; a neighbour gets decay x source, its best counts; a URI keeps
    its first discovery.

    Each level joins only what the level before found.  Levels are written beside each other in one
    folder, which is what has been seen, so a plan is as long at depth 6 as at depth 1 and
    a lost executor repeats one level; the search ends where a level finds nothing."""
    spark = anchors.sparkSession
    e = edges if relations is None else edges.filter(F.col("rel").isin(*relations))
    e = e.select(F.col("src").alias("uri"), "dst")
    folder, first = new_folder(spark, "levels"), anchors.select("c", "uri", F.col("score").cast("double").alias("score"))
    first.write.parquet(f"{folder}/depth=0")
    schema = first.withColumn("depth", F.lit(0)).schema
    seen = lambda: spark.read.schema(schema).parquet(folder)
    for level in range(1, depth + 1):
        front = seen().filter(F.col("depth") == level - 1)
        if level == 1:
            front = front.filter(F.col("score") >= min_score)
        near = front.join(e, "uri").groupBy("c", F.col("dst").alias("uri")).agg(
            F.least(F.lit(1.0), F.max(F.col("score") * decay)).alias("score")
        )
        near.join(seen().select("c", "uri"), ["c", "uri"], "left_anti").write.parquet(f"{folder}/depth={level}")
        if level < depth and seen().filter(F.col("depth") == level).isEmpty():
            break
    return seen()


def relationship_boost(
    matches: DataFrame, edges: DataFrame, boost: float = 0.35, min_score: float = 0.60, cap: float = 1.01
) -> DataFrame:
    """Matches (c, uri, score, exact): one that is no exact match and is linked to a match at
    `min_score` gains `boost` once."""
    e = edges.filter(F.col("rel").isin("related", "broader", "narrower")).select("src", "dst")
    both = e.union(e.select("dst", "src")).distinct()
    strong = matches.filter(F.col("score") >= min_score).select("c", F.col("uri").alias("src"))
    hit = strong.join(both, "src").select("c", F.col("dst").alias("uri")).distinct().withColumn("linked", F.lit(True))
    gain = F.coalesce("linked", F.lit(False)) & ~F.col("exact")
    return matches.join(hit, ["c", "uri"], "left").select(
        "c", "uri", F.when(gain, F.least(F.lit(cap), F.col("score") + boost)).otherwise(F.col("score")).alias("score"),
        gain.alias("boosted")
    )


#: Members of a class that are kept in one row where classes are expanded into pairs: so many at
#: least, an eighth of a class of more, and 8 times as many at most.
MEMBERS = 4096


def classes(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(members [key, member], forms [key, other columns]) of rows that describe a key: keys with the
    same rows are one class, which stands for them in `forms` under the name of the key."""
    fields = F.struct(*(c for c in rows.columns if c != key))
    sets = rows.groupBy(F.col(key).alias("member")).agg(F.array_sort(F.collect_list(fields)).alias("forms"))
    sets = sets.select("member", "forms", F.to_json("forms").alias(key))
    forms = sets.groupBy(key).agg(F.first("forms").alias("forms")).select(key, F.explode("forms").alias("f"))
    return sets.select(key, "member"), forms.select(key, "f.*")


def _member_blocks(members: DataFrame, key: str, size: int) -> DataFrame:
    """(key, key_block, members): the members of each class in arrays of about `size`, up to 8 x `size` in
    classes of more than eight, so that a pair of classes is some 64 pairs of blocks, not ever more."""
    n = F.count(F.lit(1))
    parts = members.groupBy(key).agg(
        F.greatest(F.least(F.ceil(n / size), F.lit(8)), F.ceil(n / (8 * size))).alias("parts")
    )
    block = F.pmod(F.xxhash64("member"), F.col("parts")).alias(f"{key}_block")
    return members.join(parts, key).groupBy(key, block).agg(F.collect_list("member").alias(f"{key}_members"))


def expand_classes(
    pairs: DataFrame, left: DataFrame, right: DataFrame, keys: tuple[str, str] = ("c", "uri"), size: int = MEMBERS
) -> DataFrame:
    """Pairs of classes as pairs of their members (key, member); other columns stay.

    Blocks of members meet and are dealt out evenly, and only the task that gives the pairs makes
    them, so neither a frequent class nor the number of pairs goes through one task or a shuffle."""
    a, b = keys
    rest = F.struct(F.lit(1).alias("_one"), *(c for c in pairs.columns if c not in keys))
    met = pairs.groupBy(a, b).agg(F.collect_list(rest).alias("_rows"))
    met = met.join(_member_blocks(left, a, size), a).join(_member_blocks(right, b, size), b)
    return _dealt(met, a, b).select(*pairs.columns)


def expand_members(pairs: DataFrame, members: DataFrame, size: int = MEMBERS) -> DataFrame:
    """(c, uri): as `expand_classes`, of pairs (c, uri) in which only c is a class."""
    partners = _member_blocks(pairs.select("c", F.col("uri").alias("member")), "c", size)
    partners = partners.withColumnsRenamed({"c_block": "uri_block", "c_members": "uri_members"})
    met = partners.join(_member_blocks(members, "c", size), "c").withColumns(
        {"uri": F.lit(""), "_rows": F.array(F.struct(F.lit(1).alias("_one")))}
    )
    return _dealt(met, "c", "uri").select("c", "uri")


#: Members of `b` that are given for each member of `a` at once: written pairs then repeat within what a file compresses together.
CHUNK = 256


def _dealt(met: DataFrame, a: str, b: str) -> DataFrame:
    """Every member of `a` with every one of `b`, once for each of `_rows`: a merge join of chunks of one
    block with the members of the other (an `explode` of both blocks gives pairs a few times more slowly).
    What is sorted is members and the 128 bits that stand for their pair of blocks, not names of classes."""
    names, tasks = [a, b, f"{a}_block", f"{b}_block"], 8 * met.sparkSession.sparkContext.defaultParallelism
    met = met.withColumns({"_i": F.xxhash64(*names), "_j": F.xxhash64(*reversed(names))})
    left = met.select("_i", "_j", f"{a}_members").repartition(tasks, "_i", "_j")
    left = left.select("_i", "_j", F.explode(f"{a}_members").alias(a))
    right = met.select("_i", "_j", "_rows", f"{b}_members").repartition(tasks, "_i", "_j")
    first = F.sequence(F.lit(1), F.size(f"{b}_members"), F.lit(CHUNK))
    chunks = F.transform(first, lambda i: F.slice(f"{b}_members", i, F.lit(CHUNK)))
    right = right.select("_i", "_j", F.explode("_rows").alias("_r"), chunks.alias("_chunks"))
    right = right.select("_i", "_j", "_r", F.explode("_chunks").alias("_chunk"))
    met = right.hint("merge").join(left, ["_i", "_j"])
    return met.select(a, "_r.*", F.explode("_chunk").alias(b))


def direct_label_match(queries: DataFrame, labels: DataFrame) -> DataFrame:
    """(c, uri, attempt): labels (norm, uri) equal to the query (c, norm); queries without any
    are tried again in their spaced form (spaced).  Equal queries and equal labels are matched once."""
    (asked, queries), (named, labels) = classes(queries.select("c", "norm", "spaced"), "c"), classes(labels.select("uri", "norm"), "uri")
    first = queries.join(labels, "norm").select("c", "uri", F.lit(1).alias("attempt"))
    rest = queries.join(first.select("c").distinct(), "c", "left_anti")
    second = rest.select("c", F.col("spaced").alias("norm")).join(labels, "norm").select(
        "c", "uri", F.lit(2).alias("attempt")
    )
    return expand_classes(first.unionByName(second), asked, named)


def label_matches(queries: DataFrame, labels: DataFrame) -> DataFrame:
    """(c, uri, kind): exact and plural matches as equi-joins on three keys."""
    keys = [
        ("Exact", F.col("norm")),
        ("Plural input", F.when(F.col("norm").endswith("s"), F.expr("left(norm, length(norm) - 1)"))),
        ("Plural label", F.concat("norm", F.lit("s")))
    ]
    forms = F.explode(
        F.array(
            *(F.struct(F.lit(i).alias("i"), F.lit(k).alias("kind"), v.alias("key")) for i, (k, v) in enumerate(keys))
        )
    )
    q = queries.select("c", forms.alias("f")).select(
        "c", "f.i", "f.kind", F.col("f.key").alias("norm")
    ).filter("norm IS NOT NULL")
    return q.join(labels, "norm").groupBy("c", "uri").agg(F.min_by("kind", "i").alias("kind"))


def word_index(labels: DataFrame) -> DataFrame:
    """(word, uri, label, place): where each word stands in each label (uri, norm)."""
    words = F.posexplode(F.split("norm", " ")).alias("place", "word")
    return labels.select("uri", F.xxhash64("norm").alias("label"), words).distinct()


def phrase_matches(queries: DataFrame, index: DataFrame) -> DataFrame:
    """(c, uri): labels that hold the query's phrase (c, norm) at word boundaries.

    The phrase's rarest word finds the labels by an equi-join; that its other words stand beside
    it is shown by a join on label and place, so no text is carried along and a frequent word
    is a key only of phrases that have no other."""
    asked = queries.filter(F.col("norm") != "").select(
        "c", F.xxhash64("norm").alias("phrase"), F.size(F.split("norm", " ")).alias("n"),
        F.posexplode(F.split("norm", " ")).alias("at", "word")
    ).distinct()
    counts = index.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    # a phrase with a word that no label has matches nothing
    known = asked.join(counts, "word")
    rarest = known.groupBy("c", "phrase", "n").agg(
        F.min(F.struct("df", "at", "word")).alias("r"), F.count(F.lit(1)).alias("found")
    ).filter("found = n").select("c", "phrase", "n", "r.word", F.col("r.at").alias("at"))
    begins = rarest.join(index, "word").select(
        "c", "phrase", "n", "uri", "label", (F.col("place") - F.col("at")).alias("start"), "at"
    ).filter("start >= 0")
    one = begins.filter("n = 1").select("c", "uri")
    other = begins.filter("n > 1").join(asked.select("c", "phrase", F.col("at").alias("next"), "word"), ["c", "phrase"])
    rest = other.filter("next <> at").withColumn("place", F.col("start") + F.col("next"))
    held = rest.join(index, ["uri", "label", "place", "word"]).groupBy("c", "phrase", "uri", "label", "start", "n").agg(
        F.count(F.lit(1)).alias("beside")
    )
    return one.union(held.filter("beside = n - 1").select("c", "uri")).distinct()


def partial_label_match(queries: DataFrame, labels: DataFrame, edges: DataFrame) -> DataFrame:
    """(c, uri): labels that hold the phrase at word boundaries, and their neighbours.

    Equal queries and equal labels are matched once; a class of queries has a set of URIs."""
    (asked, queries), (named, labels) = classes(queries.select("c", "norm"), "c"), classes(labels.select("uri", "norm"), "uri")
    found = phrase_matches(queries, word_index(labels)).withColumnRenamed("uri", "class")
    direct = found.join(named.select(F.col("uri").alias("class"), F.col("member").alias("uri")), "class").select("c", "uri")
    near = direct.join(
        edges.filter(F.col("rel").isin("related", "broader", "narrower")).select(F.col("src").alias("uri"), "dst"),
        "uri"
    ).select("c", F.col("dst").alias("uri"))
    return expand_members(direct.union(near).distinct(), asked)


def manual_mapping(matches: DataFrame, manual: DataFrame, confidence: int = 95) -> DataFrame:
    """Matches (c, uri, confidence) where a manual row (c, uri) wins."""
    m = manual.select("c", F.col("uri").alias("m_uri"))
    return matches.join(m, "c", "full_outer").select(
        "c", F.coalesce("m_uri", "uri").alias("uri"),
        F.when(F.col("m_uri").isNotNull(), confidence).otherwise(F.col("confidence")).alias("confidence")
    )


def fallback_match(queries: DataFrame, fallbacks: DataFrame, labels: DataFrame) -> DataFrame:
    """(c, uri, place): the first label of the query's domain (domain, place, norm) that any
    concept has; the smallest URI of it."""
    hit = fallbacks.join(labels, "norm").groupBy("domain").agg(F.min(F.struct("place", "uri")).alias("b"))
    return queries.select("c", "domain").join(hit, "domain").select("c", "b.uri", "b.place")


def must_not_have_by_pattern(queries: DataFrame, patterns: DataFrame, labels: DataFrame) -> DataFrame:
    """(c, uri): concepts whose label has a word that contradicts (pattern -> word) one in the
    query, but not the query's own label.  Equal queries and equal labels are compared once."""
    (asked, queries), (named, labels) = classes(queries.select("c", "norm"), "c"), classes(labels.select("uri", "norm"), "uri")
    words = queries.select("c", "norm", F.explode(F.array_distinct(F.split("norm", " "))).alias("pattern"))
    against = words.join(patterns.select("pattern", "word"), "pattern")
    tokens = labels.select(
        "uri", F.col("norm").alias("label"), F.explode(F.array_distinct(F.split("norm", " "))).alias("word")
    )
    hit = against.join(tokens, "word").filter(F.col("label") != F.col("norm")).select("c", "uri").distinct()
    return expand_classes(hit, asked, named)


def association_boost(
    matches: DataFrame, associations: DataFrame, labels: DataFrame, boost: float = 0.40, cap: float = 1.0
) -> DataFrame:
    """Matches (c, uri, score) whose label is associated with the concept (c, norm) gain `boost`."""
    hit = associations.join(labels, "norm").select("c", "uri").distinct().withColumn("hit", F.lit(True))
    return matches.join(hit, ["c", "uri"], "left").select(
        "c", "uri",
        F.when(F.col("hit"), F.least(F.lit(cap), F.col("score") + boost)).otherwise(F.col("score")).alias("score")
    )


def forbidden_context(matches: DataFrame, labels: DataFrame, forbidden: DataFrame) -> DataFrame:
    """Matches (c, domain, uri) whose label has no word that the domain forbids."""
    tokens = labels.select("uri", F.explode(F.array_distinct(F.split("norm", " "))).alias("word"))
    bad = tokens.join(forbidden, "word").select("domain", "uri").distinct()
    return matches.join(bad, ["domain", "uri"], "left_anti")


def domain_of(text: Column, groups: list[tuple[str, list[str]]], default: str) -> Column:
    """The first group of keywords with any keyword in the text."""
    out = F.lit(default)
    for name, words in reversed(groups):
        any_of = F.lit(False)
        for w in words:
            any_of = any_of | F.contains(text, F.lit(w))
        out = F.when(any_of, name).otherwise(out)
    return out


def component_types(queries: DataFrame, patterns: list[tuple[str, str]], labels: DataFrame) -> DataFrame:
    """(c, types): a phrase that is a label is `taxonomy`; else the types of the patterns (regex,
    type) found, sorted; else `unknown`."""
    exact = queries.join(labels.select("norm").distinct(), "norm", "left_semi").select("c", F.lit(True).alias("exact"))
    found = F.array_sort(
        F.array_distinct(
            F.filter(F.array(*(F.when(F.col("norm").rlike(p), t) for p, t in patterns)), lambda x: x.isNotNull())
        )
    )
    return queries.join(exact, "c", "left").select(
        "c",
        F.when(F.col("exact"), "taxonomy").when(
            F.size(found) > 0, F.array_join(found, ",")
        ).otherwise("unknown").alias("types")
    )


def confidence(kind: Column, exact_label: Column, similarity: Column, overlap: Column, n_words: Column) -> Column:
    """0 to 100 by match kind (direct 90-95, partial 60-75, weak 1-39): the band's middle (its
    end for an exact label) plus half the band by overlap, times similarity; a concept of one
    word with overlap under 0.1 falls to the weak band.  Rounded half to even."""
    weak = (n_words <= 1) & (overlap < 0.1) & (kind != "direct")
    low = F.when(weak, 1).when(kind == "direct", 90).when(kind == "partial", 60).otherwise(1)
    high = F.when(weak, 39).when(kind == "direct", 95).when(kind == "partial", 75).otherwise(39)
    base = F.when(exact_label, high.cast("double")).otherwise((low + high) / 2)
    return F.greatest(
        F.lit(0.0), F.least(F.lit(100.0), F.bround((base + (high - low) / 2 * overlap) * similarity, 0))
    ).cast("int")


def mapping_weights(rows: DataFrame) -> DataFrame:
    """(theme, theme_weight, c, concept_weight, best_uri) of rows (theme, base, c, uri, confidence):
    theme base over all bases, confidence over the theme's, the best row of each concept."""
    best = top_k(rows, 1, [F.desc("confidence"), F.asc("uri")], by=["theme", "c"])
    by_theme = best.groupBy("theme").agg(F.max("base").alias("base"), F.sum("confidence").alias("total"))
    all_base = by_theme.agg(F.sum("base").alias("all_base"))
    t = by_theme.join(F.broadcast(all_base))
    return best.drop("base").join(F.broadcast(t), "theme").select(
        "theme", (F.col("base") / F.col("all_base")).alias("theme_weight"), "c",
        (F.col("confidence") / F.col("total")).alias("concept_weight"), F.col("uri").alias("best_uri")
    )


def theme_rollup(themes: DataFrame, attributes: DataFrame) -> DataFrame:
    """(theme, name, n_names, minimum_count, effect): the distinct attributes (theme, name) of each
    theme, one a row, and their number; mandatory themes stay when empty, with a null name."""
    names = attributes.select("theme", "name").distinct()
    counts = names.groupBy("theme").agg(F.count(F.lit(1)).alias("n_names"))
    must = F.col("rule") == "Must have 1"
    kept = themes.join(counts, "theme", "left").filter(F.col("n_names").isNotNull() | must)
    kept = kept.select(
        "theme", F.coalesce("n_names", F.lit(0)).alias("n_names"), F.lit(1).alias("minimum_count"),
        F.when(must, "pass").otherwise("boost").alias("effect")
    )
    return names.join(kept, "theme", "right").select("theme", "name", "n_names", "minimum_count", "effect")
