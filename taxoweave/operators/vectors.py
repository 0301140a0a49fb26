"""Similarity of concepts by vectors: search in blocks, and what is built on it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window as W

from ..stages import staged
from . import pivots
from .components import components
from .retrieval import top_k

#: Bytes of a side's vectors (doubles) up to which it is sent to every executor.
BROADCAST_BYTES = 64 << 20
#: Rows of a side that are multiplied at once, and vectors that meet in a task otherwise.
TILE, BLOCK = 1024, 4096
#: Products that a worker holds at once where its pairs leave it tile by tile.
CELLS = 1 << 20
#: Pairs of a task where all are made.
TASK_PAIRS = 1 << 23
#: Rows of a table that is counted up to which it is sent to every executor.
FEW_ROWS = 1 << 20


def vectors_checked(vectors: DataFrame, v: str = "v") -> tuple[DataFrame, DataFrame]:
    """(good, rejected): a vector with a NaN or an infinity is rejected."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter(~bad), vectors.filter(bad)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; 0 if the sizes differ or a norm is 0."""
    x, y = a.cast("array<double>"), b.cast("array<double>")
    add = lambda s, t: s + t
    dot = F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), add)
    norm = lambda z: F.sqrt(F.aggregate(F.transform(z, lambda p: p * p), F.lit(0.0), add))
    return F.when((F.size(x) == F.size(y)) & (norm(x) > 0) & (norm(y) > 0), dot / (norm(x) * norm(y))).otherwise(0.0)


def _matrix(values: list) -> np.ndarray:
    m = np.array([np.asarray(v, np.float64) for v in values], np.float64)
    norm = np.linalg.norm(m, axis=1, keepdims=True) if len(m) else np.zeros((0, 1))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _tiles(
    left: np.ndarray, right: np.ndarray, low: float | None, high: float | None, k: int | None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places and cosines of the pairs within the bounds; at most `k` of each left row, and those
    that tie with the last.  Each item is of one tile of left rows, of about `CELLS` products, so
    what a worker holds does not grow with either side."""
    rows = max(1, min(TILE, CELLS // max(1, len(right))))
    for at in range(0, len(left) if len(right) else 0, rows):
        s = left[at : at + rows] @ right.T
        ok = np.ones(s.shape, bool)
        if low is not None:
            ok &= s >= low
        if high is not None:
            ok &= s < high
        if k is not None and k < s.shape[1]:
            cut = np.partition(np.where(ok, s, -np.inf), -k, axis=1)[:, -k]
            ok &= s >= cut[:, None] - 1e-12
        i, j = np.nonzero(ok)
        yield at + i, j, s[i, j]


def _pairs(
    left: np.ndarray, right: np.ndarray, low: float | None, high: float | None, k: int | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The items of `_tiles` in one."""
    out = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0)), *_tiles(left, right, low, high, k)]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _sent(df: DataFrame, key: str, limit: int) -> tuple[np.ndarray, np.ndarray] | None:
    """(keys, matrix) of a side whose vectors have at most `limit` bytes; None of a larger one."""
    first = df.first()
    if first is None:
        return np.zeros(0, object), np.zeros((0, 0))
    if df.count() * 8 * max(1, len(first.v)) > limit:
        return None
    table = df.toArrow()
    return np.array(table.column(0).to_pylist()), _matrix(table.column(1).to_pylist())


def similarity_search(
    queries: DataFrame, vectors: DataFrame, min_score: float | None = 0.30, k: int | None = None,
    below: float | None = None, clip: bool = False, broadcast_bytes: int = BROADCAST_BYTES, c: str = "c",
    uri: str = "uri", index: bool = True, block: int = BLOCK
) -> DataFrame:
    """(c, uri, sim_score) of queries (c, v) against vectors (uri, v): cosine at least
    `min_score` and under `below`, the `k` best of each query.

    The queries, or else the vectors, go to every executor as one matrix if they have at most
    `broadcast_bytes`; where both sides have more, blocks of both meet in pairs: with a
    `min_score` above 0 only those that the `index` of pivots does not rule out, else all.  Bounds
    and a first top-k are applied in the worker, so low pairs never leave it."""
    kinds = {f.name: f.dataType.simpleString() for f in [*queries.schema, *vectors.schema]}
    schema = f"{c} {kinds[c]}, {uri} {kinds[uri]}, sim_score double"
    q, t = queries.select(c, "v").filter("v IS NOT NULL"), vectors.select(uri, "v").filter("v IS NOT NULL")
    context = queries.sparkSession.sparkContext
    if (few := _sent(q, c, broadcast_bytes)) is not None:
        sent = context.broadcast(few)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, m = sent.value
            for batch in batches:
                uris = batch[uri].to_numpy()
                for i, j, s in _tiles(m, _matrix(list(batch.v)), min_score, below, k):
                    yield pd.DataFrame({c: ids[i], uri: uris[j], "sim_score": s})

        found = t.mapInPandas(run, schema)
    elif (few := _sent(t, uri, broadcast_bytes)) is not None:
        sent = context.broadcast(few)

        def turned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, m = sent.value
            for batch in batches:
                own = batch[c].to_numpy()
                for i, j, s in _tiles(_matrix(list(batch.v)), m, min_score, below, k):
                    yield pd.DataFrame({c: own[i], uri: ids[j], "sim_score": s})

        found = q.mapInPandas(turned, schema)
    elif index and min_score is not None and min_score > 0:
        found = _by_pivots(q, t, schema, lambda a, b: _pairs(a, b, min_score, below, k), min_score, block, (c, uri))
    else:
        n_q, n_t = (max(1, -(-df.count() // block)) for df in (q, t))
        deal = lambda df, key, n, name, other, m: df.select(
            key, "v", F.pmod(F.xxhash64(key), F.lit(n)).alias(name),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))).alias(other)
        )

        def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            i, j, s = _pairs(_matrix(list(a.v)), _matrix(list(b.v)), min_score, below, k)
            return pd.DataFrame({c: a[c].to_numpy()[i], uri: b[uri].to_numpy()[j], "sim_score": s})

        found = deal(q, c, n_q, "q", "t", n_t).groupBy("q", "t").cogroup(
            deal(t, uri, n_t, "t", "q", n_q).groupBy("q", "t")
        ).applyInPandas(meet, schema)
    if clip:
        found = found.withColumn("sim_score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "sim_score")))
    return found if k is None else top_k(found, k, [F.desc("sim_score"), F.asc(uri)], by=c)


class _Sides:
    """Keys with some vectors each: one row of the matrix a vector, those of a key together."""

    def __init__(self, keys: list, vectors: list):
        self.keys = keys
        self.starts = np.cumsum([0, *map(len, vectors)])
        self.matrix = _matrix([v for some in vectors for v in some]) if keys else np.zeros((0, 0))

    def tiles(self, other: _Sides) -> Iterator[tuple[int, np.ndarray]]:
        """(place of the first key, highest cosine of each key of a tile with each key of `other`)."""
        n, at = len(self.keys) if other.keys else 0, 0
        rows = max(1, min(TILE, CELLS // max(1, len(other.matrix))))
        while at < n:
            end = max(at + 1, int(np.searchsorted(self.starts, self.starts[at] + rows, "right")) - 1)
            s = self.matrix[self.starts[at] : self.starts[end]] @ other.matrix.T
            if len(other.matrix) > len(other.keys):
                s = np.maximum.reduceat(s, other.starts[:-1], axis=1)
            if len(s) > end - at:
                s = np.maximum.reduceat(s, self.starts[at:end] - self.starts[at], axis=0)
            yield at, s
            at = end


def _grouped(few: tuple[np.ndarray, np.ndarray]) -> tuple[list, list]:
    """(keys, vectors of each) of a side that was sent."""
    out: dict = {}
    for key, v in zip(few[0].tolist(), few[1], strict=True):
        out.setdefault(key, []).append(v)
    return [*out], [*out.values()]


def best_similarity(
    queries: DataFrame, vectors: DataFrame, min_score: float, k: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """(c, uri, sim_score) of queries (c, v) against vectors (uri, v), a row a pair: the highest
    cosine of the vectors of both, at least `min_score`; the `k` best URIs of each query.

    A URI's vectors are put together first, so pairs are made once and not shuffled; with `k` a
    task gives only what its scores up to then let into the first `k`."""
    q, t = queries.select("c", "v").filter("v IS NOT NULL"), vectors.select("uri", "v").filter("v IS NOT NULL")
    few = _sent(q, "c", broadcast_bytes)
    if few is None:
        found = similarity_search(q, t, min_score=min_score, broadcast_bytes=broadcast_bytes).groupBy("c", "uri").agg(
            F.max("sim_score").alias("sim_score")
        )
        return found if k is None else top_k(found, k, [F.desc("sim_score"), F.asc("uri")])
    schema = f"c {q.schema['c'].dataType.simpleString()}, uri {t.schema['uri'].dataType.simpleString()}, sim_score double"
    sent = q.sparkSession.sparkContext.broadcast(_grouped(few))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = _Sides(*sent.value)
        ids = pa.array(left.keys)
        best = None if k is None else np.full((len(left.keys), k), -np.inf)
        for batch in batches:
            uris = batch.column("uri")
            for at, s in left.tiles(_Sides(uris.to_pylist(), batch.column("vs").to_pylist())):
                ok = s >= min_score
                if k is not None:
                    rows = slice(at, at + len(s))
                    best[rows] = np.partition(np.hstack([best[rows], np.where(ok, s, -np.inf)]), -k, axis=1)[:, -k:]
                    ok &= s >= best[rows, :1] - 1e-12
                i, j = np.nonzero(ok)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at + i)), uris.take(pa.array(j)), pa.array(s[i, j])], ["c", "uri", "sim_score"]
                )

    found = t.groupBy("uri").agg(F.collect_list("v").alias("vs")).mapInArrow(run, schema)
    return found if k is None else top_k(found, k, [F.desc("sim_score"), F.asc("uri")])


def every_cosine(queries: DataFrame, vectors: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(c, uri, sim_score) of all pairs of rows (c, v) and (uri, v), as `cosine` gives it.

    The queries go to every executor as one matrix if they fit, and products are made in tiles."""
    q, t = queries.select("c", "v"), vectors.select("uri", "v")
    whole = lambda v: F.when(~F.exists(v, lambda x: x.isNull()), F.col(v))
    wide = q.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    if wide[0] * 8 * max(1, wide[1]) > broadcast_bytes:
        return q.withColumnRenamed("v", "qv").crossJoin(t).select(
            "c", "uri", cosine(F.col("qv"), F.col("v")).alias("sim_score")
        )
    table = q.select("c", whole("v").alias("v")).toArrow()
    sent = q.sparkSession.sparkContext.broadcast((table.column(0).combine_chunks(), table.column(1).to_pylist()))
    schema = f"c {q.schema['c'].dataType.simpleString()}, uri {t.schema['uri'].dataType.simpleString()}, sim_score double"

    def padded(values: list, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, unit vectors filled up with zeros)."""
        sizes, m = np.array([len(v or ()) for v in values], int), np.zeros((len(values), width))
        for row, v in zip(m, values, strict=True):
            row[: len(v or ())] = v or ()
        norm = np.linalg.norm(m, axis=1, keepdims=True)
        return sizes, np.divide(m, norm, out=np.zeros_like(m), where=~(norm == 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, asked = sent.value
        for batch in batches:
            values, uris = batch.column("v").to_pylist(), batch.column("uri")
            width = max((len(v or ()) for v in [*asked, *values]), default=0)
            (n, a), (m, b) = padded(asked, width), padded(values, width)
            rows = max(1, min(TILE, CELLS // max(1, len(b))))
            for at in range(0, len(a) if len(b) else 0, rows):
                s = np.where(n[at : at + rows, None] == m, a[at : at + rows] @ b.T, 0.0)
                i, j = np.repeat(np.arange(len(s)), len(b)), np.tile(np.arange(len(b)), len(s))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at + i)), uris.take(pa.array(j)), pa.array(s.ravel())], ["c", "uri", "sim_score"]
                )

    tasks = max(1, -(-wide[0] * t.count() // TASK_PAIRS))
    return t.select("uri", whole("v").alias("v")).repartition(tasks, "uri").mapInArrow(run, schema)


def _by_pivots(
    q: DataFrame, t: DataFrame, schema: str, pairs: Callable, least: float, block: int, keys: tuple[str, str]
) -> DataFrame:
    """Pairs of vectors in blocks that may be near enough; no row leaves a block without partners."""
    index = pivots.plan(q, t, least, block, keys)
    if index is None:
        return q.sparkSession.createDataFrame([], schema)
    c, uri = keys
    meets = index.pairs
    left = index.left.rows.join(meets, "block").select(c, "v", "block", "other")
    right = index.right.rows.withColumnRenamed("block", "other").join(meets, "other").select(uri, "v", "block", "other")

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        i, j, s = pairs(_matrix(list(a.v)), _matrix(list(b.v)))
        return pd.DataFrame({c: a[c].to_numpy()[i], uri: b[uri].to_numpy()[j], "sim_score": s})

    return left.groupBy("block", "other").cogroup(right.groupBy("block", "other")).applyInPandas(meet, schema)


def pair_similarity(pairs: DataFrame, queries: DataFrame, vectors: DataFrame) -> DataFrame:
    """(c, uri, sim_score): cosine of given pairs (c, uri) only; pairs without both vectors go."""
    q, t = queries.select("c", F.col("v").alias("_q")), vectors.select("uri", F.col("v").alias("_t"))
    return pairs.select("c", "uri").distinct().join(q, "c").join(t, "uri").select(
        "c", "uri", cosine(F.col("_q"), F.col("_t")).alias("sim_score")
    )


def primary_vector(labels: DataFrame, order: list[str]) -> DataFrame:
    """(uri, v): the vector of the first property by `order` of rows (uri, prop, v)."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col("prop"))
    place = F.when(place == 0, len(order) + 1).otherwise(place)
    return labels.groupBy("uri").agg(F.min_by("v", F.struct(place, "prop")).alias("v"))


def dynamic_synonyms(similar: DataFrame, texts: DataFrame, threshold: float = 0.55, k: int = 20) -> DataFrame:
    """(c, text, score): the similar texts (uri -> text) at the threshold, best of each text."""
    j = similar.filter(F.col("sim_score") >= threshold).join(texts.select("uri", "text"), "uri")
    return top_k(j.groupBy("c", "text").agg(F.max("sim_score").alias("score")), k, [F.desc("score"), F.asc("text")])


def dynamic_exclusions(
    similar: DataFrame, texts: DataFrame, synonym: float = 0.55, exclusion: float = 0.85
) -> DataFrame:
    """(c, text, kind): label texts over `synonym` are synonyms; other texts over `exclusion` exclusions."""
    j = similar.join(texts.select("uri", "text", "is_label"), "uri")
    kind = F.when(F.col("is_label") & (F.col("sim_score") > synonym), "synonym").when(
        ~F.col("is_label") & (F.col("sim_score") > exclusion), "exclusion"
    )
    return j.select("c", "text", kind.alias("kind")).filter("kind IS NOT NULL").distinct()


def best_text_match(
    pairs: DataFrame, property_weights: dict[str, float], association: float = 0.40, synonym: float = 0.2,
    threshold: float = 0.30, k: int = 10
) -> DataFrame:
    """(c, uri, score): each concept's best text (c, uri, prop, kw, sim, associated, is_synonym,
    primary_sim): 0.5 kw + 0.5 sim by property weight, plus boosts, at least its primary similarity."""
    weight = F.coalesce(
        F.get(
            F.map_values(
                F.map_filter(
                    F.create_map(*(F.lit(x) for kv in property_weights.items() for x in kv)),
                    lambda p, _: p == F.col("prop")
                )
            ),
            F.lit(0)
        ),
        F.lit(1.0)
    )
    s = (
        0.5 * F.col("kw") + 0.5 * F.col("sim")
    ) * weight + F.when(
        F.col("associated"), association
    ).otherwise(0.0) + F.when(F.col("is_synonym"), synonym).otherwise(0.0)
    s = F.greatest(F.least(F.lit(1.0), F.greatest(F.lit(0.0), s)), F.col("primary_sim"))
    best = pairs.groupBy("c", "uri").agg(F.max(s).alias("score")).filter(F.col("score") >= threshold)
    return top_k(best, k, [F.desc("score"), F.asc("uri")], rank="rank")


def penalised_match(scored: DataFrame, exclusions: DataFrame, antonyms: DataFrame, exempt: DataFrame) -> DataFrame:
    """(c, uri, score): excluded URIs go; antonyms lose max(score - 0.5, 0.2 x score) unless they
    match exactly or the concept is exempt; exact matches get 1.01."""
    j = scored.join(exclusions.select("c", "uri").distinct(), ["c", "uri"], "left_anti").join(
        antonyms.select("c", "uri", F.lit(True).alias("anti")).distinct(), ["c", "uri"], "left"
    ).join(exempt.select("c", F.lit(True).alias("free")).distinct(), "c", "left")
    s = F.col("score")
    low = F.coalesce("anti", F.lit(False)) & ~F.coalesce("free", F.lit(False))
    return j.select(
        "c", "uri", F.when(F.col("exact"), 1.01).when(low, F.greatest(s - 0.5, 0.2 * s)).otherwise(s).alias("score")
    )


def opposite_candidates(
    queries: DataFrame, vectors: DataFrame, labels: DataFrame, negative_words: DataFrame, below: float = 0.4,
    min_keyword: float = 0.06, k: int = 15
) -> DataFrame:
    """(c, uri, ranking_score, distance, keyword_score, matched) of concepts (uri, v) that are
    less similar than `below` to the query (c, v): half distance, half share of the negative
    words (c, word) in the label.

    Queries with negative words ask for concepts that have some of them, by a join on words; the
    others ask for the `k` farthest, which are the nearest to the opposite vector.  So no pair is
    made that can't be in the result (`min_keyword` over 0)."""
    words = negative_words.groupBy("c").agg(F.count_distinct("word").alias("n"))
    asked = negative_words.select("c", F.lower("word").alias("word")).distinct()
    tokens = labels.select("uri", F.explode(F.array_distinct(F.split(F.lower("label"), " "))).alias("word"))
    hits = tokens.join(asked, "word").groupBy("c", "uri").agg(
        F.count(F.lit(1)).alias("h"), F.array_join(F.array_sort(F.collect_set("word")), ",").alias("matched")
    )
    near = pair_similarity(hits, queries, vectors).join(hits, ["c", "uri"]).join(words, "c").select(
        "c", "uri", "sim_score", (F.col("h") / F.col("n")).alias("kw"), "matched"
    )
    silent = queries.join(words, "c", "left_anti").select("c", F.transform("v", lambda x: -x).alias("v"))
    far = similarity_search(silent, vectors, min_score=None, k=2 * k).select(
        "c", "uri", (-F.col("sim_score")).alias("sim_score"), F.lit(None).cast("double").alias("kw"),
        F.lit("").alias("matched")
    )
    j = near.filter(F.col("kw") >= min_keyword).unionByName(far).filter(F.col("sim_score") < below).withColumn(
        "distance", 1 - F.col("sim_score")
    )
    rank = F.when(F.col("kw").isNull(), F.col("distance")).otherwise(0.5 * F.col("distance") + 0.5 * F.col("kw"))
    best = top_k(j.withColumn("ranking_score", rank), k, [F.desc(F.round("ranking_score", 9)), F.asc("uri")])
    return best.select(
        "c", "uri", F.round("ranking_score", 4).alias("ranking_score"), F.round("distance", 4).alias("distance"),
        F.round(F.coalesce("kw", F.lit(0.0)), 4).alias("keyword_score"), "matched"
    )


def kg_slice(similar: DataFrame, by_archetype: DataFrame, threshold: float = 0.35, k: int = 150) -> DataFrame:
    """(c, uri, score): the larger of the similarity to the concept and half of that to its archetypes."""
    half = by_archetype.select("c", "uri", (0.5 * F.col("sim_score")).alias("sim_score"))
    best = similar.select("c", "uri", "sim_score").unionByName(half).groupBy("c", "uri").agg(
        F.max("sim_score").alias("score")
    ).filter(F.col("score") >= threshold)
    return top_k(best, k, [F.desc("score"), F.asc("uri")], rank="rank")


def essentials_check(chosen: DataFrame, required: DataFrame, have: DataFrame) -> DataFrame:
    """(c, uri): what the chosen archetypes (c, archetype) require (archetype, uri) and the definition lacks."""
    return chosen.join(required, "archetype").select("c", "uri").distinct().join(
        have.select("c", "uri"), ["c", "uri"], "left_anti"
    )


def contradictions(
    evidence: DataFrame, exclusions: DataFrame, near_opposite: DataFrame, threshold: float = 0.50
) -> tuple[DataFrame, DataFrame]:
    """(kept, must_not_have [c, uri, reason, score]): specific exclusions first with score 1, else
    similarity (c, uri, opposite, sim_score) to an opposite at the threshold."""
    specific = exclusions.select("c", "uri").distinct().select(
        "c", "uri", F.lit("specific exclusion").alias("s_reason")
    )
    worst = near_opposite.filter(F.col("sim_score") >= threshold).groupBy("c", "uri").agg(
        F.max_by(F.struct("opposite", "sim_score"), F.struct("sim_score", "opposite")).alias("w")
    )
    j = evidence.join(specific, ["c", "uri"], "left").join(worst, ["c", "uri"], "left")
    bad = F.col("s_reason").isNotNull() | F.col("w").isNotNull()
    gone = j.filter(bad).select(
        "c", "uri", F.coalesce("s_reason", F.concat(F.lit("opposite of "), F.col("w.opposite"))).alias("reason"),
        F.when(F.col("s_reason").isNotNull(), 1.0).otherwise(F.col("w.sim_score")).alias("score")
    )
    return j.filter(~bad).select(*evidence.columns), gone


def slot_scores(
    themes: DataFrame, vectors: DataFrame, labels: DataFrame, hints: DataFrame, min_score: float,
    broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """(uri, theme, sim, hits): best similarity of a concept (uri, v) to a theme's vectors (c, v),
    and how many of the theme's hint words (theme, hint) its label has.

    Pairs are those at `min_score`, and those with a hint, whatever their similarity; a theme or
    concept without a vector has similarity 0.  A concept's vectors and hits meet before its pairs
    are made, so no pair is shuffled."""
    tokens = labels.select("uri", F.explode(F.array_distinct(F.split(F.lower("label"), r"\W+"))).alias("hint"))
    hits = tokens.join(
        hints.select("theme", F.lower("hint").alias("hint")).distinct(), "hint"
    ).groupBy("uri", "theme").agg(F.count(F.lit(1)).alias("hits"))
    few = _sent(themes.select("c", "v").filter("v IS NOT NULL"), "c", broadcast_bytes)
    if few is None:
        hinted = pair_similarity(hits.select(F.col("theme").alias("c"), "uri"), themes, vectors)
        near = similarity_search(themes, vectors, min_score, broadcast_bytes=broadcast_bytes).unionByName(hinted)
        best = near.groupBy("uri", F.col("c").alias("theme")).agg(F.max("sim_score").alias("sim"))
        return best.join(hits, ["uri", "theme"], "full_outer").select(
            "uri", "theme", F.coalesce("sim", F.lit(0.0)).alias("sim"), F.coalesce("hits", F.lit(0)).alias("hits")
        )
    kinds = [df.schema[x].dataType.simpleString() for df, x in ((vectors, "uri"), (themes, "c"))]
    own = vectors.filter("v IS NOT NULL").groupBy("uri").agg(F.collect_list("v").alias("vs"))
    said = hits.groupBy("uri").agg(F.collect_list(F.struct(F.col("theme").cast(kinds[1]).alias("theme"), "hits")).alias("said"))
    sent = vectors.sparkSession.sparkContext.broadcast(_grouped(few))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = _Sides(*sent.value)
        ids, place = pa.array(left.keys, themes_type), {x: i for i, x in enumerate(left.keys)}
        for batch in batches:
            uris, vs = batch.column("uri"), batch.column("vs").to_pylist()
            with_v = [j for j, v in enumerate(vs) if v]
            column = {j: n for n, j in enumerate(with_v)}
            known, alone = [], []
            for j, some in enumerate(batch.column("said").to_pylist()):
                for x in some or ():
                    if j in column and x["theme"] in place:
                        known.append((place[x["theme"]], column[j], x["hits"]))
                    else:
                        alone.append((j, x["theme"], x["hits"]))
            at_hint = np.array(sorted(known), np.int64).reshape(-1, 3)
            back = np.array(with_v, np.int64)
            for at, s in left.tiles(_Sides(with_v, [vs[j] for j in with_v])):
                n = np.zeros(s.shape, np.int64)
                x = at_hint[slice(*np.searchsorted(at_hint[:, 0], [at, at + len(s)]))]
                n[x[:, 0] - at, x[:, 1]] = x[:, 2]
                i, j = np.nonzero((s >= min_score) | (n > 0))
                yield pa.RecordBatch.from_arrays(
                    [uris.take(pa.array(back[j])), ids.take(pa.array(at + i)), pa.array(s[i, j]), pa.array(n[i, j])], names
                )
            yield pa.RecordBatch.from_arrays(
                [
                    uris.take(pa.array([j for j, _, _ in alone], pa.int64())), pa.array([x for _, x, _ in alone], themes_type),
                    pa.array(np.zeros(len(alone))), pa.array([n for _, _, n in alone], pa.int64())
                ], names
            )

    names, themes_type = ["uri", "theme", "sim", "hits"], to_arrow_type(themes.schema["c"].dataType)
    return own.join(said, "uri", "full_outer").mapInArrow(
        run, f"uri {kinds[0]}, theme {kinds[1]}, sim double, hits bigint"
    )


def slot_by_hints(
    scores: DataFrame, mode: str = "best", threshold: float | None = None, min_hits: int = 1, cap: int = 5,
    themes_with_hints: DataFrame | None = None
) -> DataFrame:
    """(uri, theme, confidence) of scores (uri, theme, sim, hits).

    best: 0.4 x (0.8 if any hint) + 0.6 x similarity, the best theme at 0.31.
    multi: any hint or similarity 0.50; 0.3 x hint + 0.7 x similarity, `cap` concepts a theme.
    strict: similarity 0.50 and `min_hits` hints (not asked of themes without hints)."""
    sim, hit = F.col("sim"), F.when(F.col("hits") > 0, 0.8).otherwise(0.0)
    if mode == "best":
        df = scores.withColumn("confidence", 0.4 * hit + 0.6 * sim).filter(
            F.col("confidence") >= (0.31 if threshold is None else threshold)
        )
        best = df.groupBy("uri").agg(
            F.max_by(F.struct("theme", "confidence"), F.struct(F.round("confidence", 9), -F.col("theme"))).alias("b")
        )
        return best.select("uri", "b.theme", "b.confidence")
    cut = 0.50 if threshold is None else threshold
    if mode == "multi":
        df = scores.filter(
            (F.col("hits") >= 1) | (sim >= cut)
        ).withColumn("confidence", 0.3 * hit + 0.7 * sim).select("uri", "theme", "confidence")
        return top_k(df, cap, [F.desc("confidence"), F.asc("uri")], by="theme")
    df = scores
    enough = F.col("hits") >= min_hits
    if themes_with_hints is not None:
        marked = staged(themes_with_hints.select("theme").distinct(), "hinted").withColumn("h", F.lit(True))
        df = df.join(F.broadcast(marked) if marked.count() <= FEW_ROWS else marked, "theme", "left")
        enough = enough | F.col("h").isNull()
    return df.filter((sim >= cut) & enough).select("uri", "theme", sim.alias("confidence"))


def centroids(vectors: DataFrame, group: str) -> DataFrame:
    """(group, v): mean vector, element by element."""
    e = vectors.select(group, F.posexplode("v").alias("i", "x"))
    m = e.groupBy(group, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return m.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("v")
    )


def _forest(i: np.ndarray, j: np.ndarray, n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs of n left and m right rows, some that connect the same rows."""
    if len(i) <= n + m:
        return i, j
    near = np.zeros((n, m), bool)
    near[i, j] = True
    out, open_left, open_right = [], near.any(axis=1), np.ones(m, bool)
    for start in range(n):
        if not open_left[start]:
            continue
        open_left[start], front = False, [start]
        while front:
            x = front.pop()
            for y in np.flatnonzero(near[x] & open_right).tolist():
                open_right[y] = False
                out.append((x, y))
                for z in np.flatnonzero(near[:, y] & open_left).tolist():
                    open_left[z] = False
                    out.append((z, y))
                    front.append(z)
    return np.array([p[0] for p in out], int), np.array([p[1] for p in out], int)


def similarity_clusters(
    vectors: DataFrame, eps: float, broadcast_bytes: int = BROADCAST_BYTES, block: int = BLOCK
) -> DataFrame:
    """(uri, cluster) by density with one point a cluster at least, which is the connected
    components of distance <= eps between unit vectors; the cluster is its smallest URI.

    Where vectors meet in a task, only pairs that connect the rows there leave it.  Vectors of more
    than `broadcast_bytes` meet in blocks that an index of pivots does not keep apart."""
    low = 1 - eps * eps / 2 - 1e-9
    kind = vectors.schema["uri"].dataType.simpleString()
    t = vectors.select("uri", "v").filter("v IS NOT NULL")

    def joined(left: pd.DataFrame, right: pd.DataFrame) -> Iterator[pd.DataFrame]:
        a, b = _matrix(list(left.v)), _matrix(list(right.v))
        for x in range(0, len(a), TILE):
            for y in range(0, len(b), TILE):
                i, j, _ = _pairs(a[x : x + TILE], b[y : y + TILE], low, None, None)
                i, j = _forest(i, j, len(a[x : x + TILE]), len(b[y : y + TILE]))
                yield pd.DataFrame({"a": left.uri.to_numpy()[x + i], "b": right.uri.to_numpy()[y + j]})

    schema = f"a {kind}, b {kind}"
    if (few := _sent(t, "uri", broadcast_bytes)) is not None:
        sent = vectors.sparkSession.sparkContext.broadcast(few)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, m = sent.value
            whole = pd.DataFrame({"uri": ids, "v": list(m)})
            for batch in batches:
                yield from joined(batch, whole)

        edges = t.mapInPandas(run, schema)
    else:
        index = pivots.plan(t, None, low, block, ("uri", "uri")) if low > 0 else None
        if index is not None:
            first = index.left.rows.join(index.pairs, "block").select("uri", "v", "block", "other")
            second = index.left.rows.withColumnRenamed("block", "other").join(index.pairs, "other").filter("block <> other")
            met = first.unionByName(second.select("uri", "v", "block", "other"))
            by = ["block", "other"]
        else:
            n = max(1, -(-t.count() // block))
            mine = F.pmod(F.xxhash64("uri"), F.lit(n))
            pair = lambda k: F.struct(F.least(mine, k).alias("i"), F.greatest(mine, k).alias("j"))
            numbers = F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
            met, by = t.select("uri", "v", F.explode(F.transform(numbers, pair)).alias("p")), ["p"]

        def meet(rows: pd.DataFrame) -> pd.DataFrame:
            return pd.concat([*joined(rows, rows)], ignore_index=True)

        edges = met.groupBy(*by).applyInPandas(meet, schema)
    found = components(edges).withColumnRenamed("node", "uri")
    return vectors.select("uri").join(found, "uri", "left").select(
        "uri", F.coalesce("component", "uri").alias("cluster")
    )
