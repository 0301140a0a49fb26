"""Benchmark decontamination by word windows (native: DataFrame functions only).

Words are runs of letters and digits (all non-ASCII characters count as letters),
with A-Z lowered.  A window is `n` consecutive words of a benchmark item; an item of
fewer words, but not none, is one window.  The windows go to every executor as hash
sets: as literals of the plan while they are at most `max_windows`, else as a broadcast
table of 64-bit hashes, with which the windows of the texts are met where they are made.
So only texts with a hit are shuffled.  A benchmark of more than `max_hashes` windows is
joined on the hashes.  Window texts are compared in full, so a hit is exact.

Defined cases: null and empty texts have no words and are never contaminated; very long
texts are scanned whole; null or wordless items have no windows; items with a null id mark
words but are not listed; items that repeat an id count once; items that tie on a window
are all listed; repeated rows are judged one by one; an empty table, or none of items, gives
no hits; columns named like the added one keep their names, and helpers get free names.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fresh, lower_ascii, quoted, step, written

NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Window hashes up to which their table is broadcast (12 bytes each).
MAX_HASHES = 8_000_000
#: Texts with hits up to which their hits are broadcast.
MAX_HIT_TEXTS = 100_000
HIT = "struct<n_words:bigint,starts:array<struct<i:int,k:int>>,items:array<string>>"


def item_words(text: Column) -> Column:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the lower-cased text."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD), lambda x: x != "")


def windows(items: DataFrame, n: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id string, k, win): the distinct windows of every item, k words each."""
    w = items.select(
        quoted(item_id).cast("string").alias("item_id"), item_words(quoted(text)).alias("w")
    ).filter(F.size("w") > 0)
    w = w.select("item_id", "w", F.least(F.lit(n), F.size("w")).alias("k"))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("k") + 1)
    return w.select(
        "item_id", "k",
        F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, F.col("k")), " "))).alias("win")
    ).distinct()


def find(
    docs: DataFrame, items: DataFrame, n: int = 10, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", max_windows: int = 50_000, into: str = "hit", max_hashes: int = MAX_HASHES
) -> DataFrame:
    """Adds the struct `into`: n_words, starts (first word and length of each window
    that occurs, in order) and items (ids, as sorted strings)."""
    (into,) = fresh(docs, into)
    table = windows(items, n, item_id, item_text)
    rows = table.limit(max_windows + 1).collect()
    if len(rows) > max_windows:
        return _find_by_hash(docs, table, text, into, max_hashes)
    w, starts = fresh(docs, into + "_words", into + "_starts")
    keep = [quoted(c) for c in docs.columns]
    if not rows:
        return docs.select(
            *keep,
            F.struct(
                F.size(item_words(quoted(text))).cast("long").alias("n_words"),
                F.array().cast("array<struct<i:int,k:int>>").alias("starts"),
                F.array().cast("array<string>").alias("items")
            ).cast(HIT).alias(into)
        )
    # 64-bit hash sets as literals: of the first two words, then of the whole window
    sets = table.groupBy("k").agg(
        F.collect_set(F.xxhash64(F.substring_index("win", " ", 2))).alias("pairs"),
        F.collect_set(F.xxhash64("win")).alias("wins")
    ).orderBy("k").collect()
    owners: dict[str | None, set[str]] = {}
    for r in rows:
        owners.setdefault(r.item_id, set()).add(r.win)
    q, at = f"`{w}`", []
    for k, pairs, wins in sets:
        test = f"xxhash64(array_join(slice({q}, i + 1, {k}), ' ')) IN ({', '.join(map(str, sorted(wins)))})"
        if k > 2:
            test = f"xxhash64(concat(x, ' ', get({q}, i + 1))) IN ({', '.join(map(str, sorted(pairs)))}) AND i + {k} <= size({q}) AND {test}"
        elif k == 2:
            test = f"i + 2 <= size({q}) AND {test}"
        at.append(
            F.expr(
                f"transform(array_remove(transform({q}, (x, i) -> CASE WHEN {test} THEN i ELSE -1 END), -1), i -> struct(i AS i, {k} AS k))"
            )
        )
    df = step(docs, docs.columns, w, item_words(quoted(text)))
    df = step(df, [*docs.columns, w], starts, F.sort_array(F.concat(*at)))
    # texts with hits: windows are compared word by word with those of the items
    said = lambda s: F.array_join(F.slice(quoted(w), s.i + 1, s.k), " ")
    literal = _literal(owners)
    found = F.array_distinct(F.transform(quoted(starts), said))
    owned = F.filter(
        F.transform(
            literal, lambda it: F.struct(it["id"].alias("id"), F.array_intersect(it["wins"], found).alias("wins"))
        ),
        lambda it: F.size(it["wins"]) > 0
    )
    own, = fresh(df, into + "_items")
    df = step(df, [*docs.columns, w, starts], own, F.when(F.size(quoted(starts)) > 0, owned))
    real = F.flatten(F.transform(quoted(own), lambda it: it["wins"]))
    named = F.sort_array(F.filter(F.transform(quoted(own), lambda it: it["id"]), lambda x: x.isNotNull()))
    none = F.array()
    made = F.struct(
        F.size(quoted(w)).cast("long").alias("n_words"),
        F.when(
            quoted(own).isNotNull(), F.filter(quoted(starts), lambda s: F.array_contains(real, said(s)))
        ).otherwise(none.cast("array<struct<i:int,k:int>>")).alias("starts"),
        F.coalesce(named, none.cast("array<string>")).alias("items"),
    )
    return step(df, docs.columns, into, made.cast(HIT))


def _literal(owners: dict[str | None, set[str]]) -> Column:
    text = json.dumps(
        [{"id": i, "wins": sorted(wins)} for i, wins in sorted(owners.items(), key=str)], ensure_ascii=False
    )
    return F.from_json(F.lit(text), "array<struct<id:string,wins:array<string>>>")


def _find_by_hash(docs: DataFrame, table: DataFrame, text: str, into: str, max_hashes: int) -> DataFrame:
    """The same for a benchmark of any size."""
    key, = fresh(docs, into + "_key")
    df = docs.withColumn(key, F.sha2(F.coalesce(quoted(text), F.lit("")), 256))
    table = written(table.withColumn("h", F.xxhash64("win")), "windows")
    hashes = table.select("k", "h").distinct()
    hashes = F.broadcast(hashes) if table.count() <= max_hashes else hashes
    sizes = sorted(r.k for r in table.select("k").distinct().collect())  # n values at most
    texts = df.select(quoted(key).alias("t"), item_words(quoted(text)).alias("w"))

    def windows_of(some: DataFrame) -> DataFrame:
        """(t, k, i, h): the windows whose hash an item has."""
        hashed = lambda k: F.transform(
            F.sequence(F.lit(1), F.size("w") - k + 1), lambda i: F.xxhash64(F.array_join(F.slice("w", i, k), " "))
        )
        parts = [
            some.filter(F.size("w") >= k).select(
                "t", F.lit(k).alias("k"), F.posexplode(hashed(k)).alias("i", "h")
            ) for k in sizes
        ]
        return reduce(DataFrame.unionByName, parts).join(hashes, ["k", "h"], "left_semi")

    # which texts have hits at all, then the hits of each once, with their words
    some = written(windows_of(texts).select("t").distinct(), "hit-texts")
    some = F.broadcast(some) if some.count() <= MAX_HIT_TEXTS else some
    there = written(texts.join(some, "t", "left_semi").dropDuplicates(["t"]), "hit-words")
    at = windows_of(there).join(there, "t").select(
        "t", "k", "i", "h", F.array_join(F.slice("w", F.col("i") + 1, F.col("k")), " ").alias("win")
    )
    hits = at.join(table, ["k", "h", "win"]).groupBy("t").agg(
        F.sort_array(F.collect_set(F.struct("i", "k"))).alias("starts"),
        F.sort_array(F.collect_set("item_id")).alias("items")
    )
    hits = written(hits.select(F.col("t").alias(key), F.struct("starts", "items").alias(into)), "hits")
    hits = F.broadcast(hits) if hits.count() <= MAX_HIT_TEXTS else hits
    out = df.join(hits, key, "left")
    none, found = F.array(), quoted(into)
    made = F.struct(
        F.size(item_words(quoted(text))).cast("long").alias("n_words"),
        F.coalesce(found["starts"], none.cast("array<struct<i:int,k:int>>")).alias("starts"),
        F.coalesce(found["items"], none.cast("array<string>")).alias("items")
    )
    return out.select(*(quoted(c) for c in docs.columns), made.cast(HIT).alias(into))


def hit_words(hit: Column) -> Column:
    """Number of words inside any window found."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    step = lambda a, s: F.struct(
        F.greatest(a["end"], s.i + s.k).alias("end"),
        (a["n"] + F.greatest(s.i + s.k - F.greatest(a["end"], s.i), F.lit(0))).alias("n")
    )
    return F.coalesce(F.aggregate(hit["starts"], start, step, lambda a: a["n"]), F.lit(0)).cast("long")


def clean(
    docs: DataFrame, items: DataFrame, n: int = 10, mode: str = "documents", text: str = "text",
    max_windows: int = 50_000
) -> DataFrame:
    """mode "documents" removes contaminated rows; "spans" cuts the hit words, with what
    separates them from the word before, out of the texts and keeps every row."""
    hit, = fresh(docs, "hit")
    found = find(docs, items, n, text, max_windows=max_windows, into=hit)
    dirty = F.coalesce(F.size(quoted(hit)["starts"]), F.lit(0)) > 0
    keep = [quoted(c) for c in docs.columns]
    if mode == "documents":
        return found.filter(~dirty).select(*keep)
    parts, flags = fresh(found, "parts", "cut")
    pattern = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
    both = F.struct(
        F.split(quoted(text), pattern, -1).alias("gaps"),
        F.regexp_extract_all(quoted(text), F.lit(pattern), F.lit(0)).alias("words")
    )
    df = step(found, found.columns, parts, F.when(dirty, both))
    marked = F.array_distinct(F.flatten(F.transform(quoted(hit)["starts"], lambda s: F.sequence(s.i, s.i + s.k - 1))))
    df = step(df, df.columns, flags, F.when(dirty, F.map_from_arrays(marked, marked)))
    gaps, body = quoted(parts)["gaps"], quoted(parts)["words"]
    rest = F.array_join(
        F.transform(
            body,
            lambda x, i: F.when(
                F.map_contains_key(quoted(flags), i), F.when(i == 0, F.get(gaps, i)).otherwise("")
            ).otherwise(F.concat(F.get(gaps, i), x))
        ),
        ""
    )
    cut = F.concat(rest, F.element_at(gaps, -1))
    return df.select(
        *[(F.when(dirty, cut).otherwise(quoted(text)).alias(c) if c == text else quoted(c)) for c in docs.columns]
    )
