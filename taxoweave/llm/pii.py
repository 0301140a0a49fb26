"""Personal data found by pattern and by disclosure (native: DataFrame functions only).

Base spans are e-mail addresses, IP addresses, card and phone numbers; secrets (opaque
strings of at least 24 letters and digits, both in it) are protected beside them.
Information-theoretic sanitisation adds terms (Sanchez and Batet, "C-sanitized", 2016).  A
protected entity e is, of every such span,

- its value,
- its group: the host of an address, the network (two parts) of an IP address, the issuer
  (six digits) of a card, the first four digits of a phone number,
- its kind, so that what is seen once or twice is judged with its like.

A term t is a word within `context` words of a span.  Over all documents,
PMI(t; e) = log(N n(t, e) / (n(t) n(e))) says how much t tells about e, and
IC(e) = log(N / n(e)) how much there is to tell.  A term with PMI >= disclosure * IC for
some entity, seen beside it in at least `support` different texts, discloses it wherever
it stands.  It is generalised to the class of what it tells (a mark for each kind), or
removed if it tells a value or group and never occurs without it (PMI = IC).

Defined cases: null texts count as empty and stay null when sanitised; failing matches are
dropped without retries; added spans that overlap base spans are left out; a term that
discloses several entities takes the class of the one it tells most of, the first kind on
ties; very long texts and texts of very many spans are treated whole; repeated rows count as
documents each, but once as texts; an empty table gives no rows; columns named like the
added ones keep their names, as every helper column gets a free name.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fresh, quoted, step, written

#: Kinds in the order of the listing.
KINDS = ["email", "ip", "card", "phone"]
#: The contract's patterns; runs are taken whole (possessive) and tried once, which finds
#: the same leftmost matches in linear time.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A run of letters, digits, _ and - of at least 24 characters with a letter and a digit.
SECRET = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{24,}+"
#: Kinds of spans by number: base, secret, terms that tell of each of these, removed terms.
PROTECTED = [*KINDS, "secret"]
TERM, REMOVED = len(PROTECTED), 2 * len(PROTECTED)
NAMES = [*PROTECTED, *["term"] * (len(PROTECTED) + 1)]
MARKS = [*(f"[{k.upper()}]" for k in PROTECTED), *(f"[{k.upper()} TERM]" for k in PROTECTED), ""]
SPAN = "array<struct<start:int,end:int,kind:int>>"
#: Terms up to which a set goes into the plan as literals; beyond, tables are joined.
LITERAL_TERMS = 10_000
#: Terms up to which a text is searched for them before it is cut into words.
FEW_TERMS = 16
LETTERS = "[^\\p{L}]+"
#: Spans that are summed up one after the other; more are summed in chunks.
CHUNK = 256


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(
            F.split(m, "\\."),
            lambda p: F.when(F.length(part(p)) > 3, False).otherwise(F.concat(F.lit("0"), part(p)).cast("int") <= 255)
        )
    if kind == "card":
        d = F.translate(m, " -", "")
        twice = lambda i: F.substr(d, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        total = F.aggregate(
            F.sequence(F.lit(1), F.length(d)), F.lit(0),
            lambda a, i: a + F.when(twice(i) > 9, twice(i) - 9).otherwise(twice(i))
        )
        return F.when(F.length(d).between(14, 19), total % 10 == 0).otherwise(False)
    if kind == "phone":
        return F.length(F.translate(m, "+ ().-", "")).between(10, 15)
    return F.lit(True)


def _positions(found: Column, gaps: Column, kind: Column) -> Column:
    """Spans of the matches: texts between matches and matches follow each other.  Places are
    summed up in chunks, then over chunks, so many matches cost little more than each alone."""
    zipped = F.arrays_zip(found.alias("found"), F.slice(gaps, F.lit(1), F.size(found)).alias("gaps"))

    def summed(parts: Column, first: Column, of: Column, size) -> Column:
        """struct(at, out): what `of` makes of each part and the place before it."""
        start = F.struct(F.lit(0).alias("at"), F.array().cast(of).alias("out"))
        return F.aggregate(
            parts, start,
            lambda a, z: F.struct(
                (a["at"] + size(z)).alias("at"), F.concat(a["out"], F.array(first(a["at"], z))).alias("out")
            )
        )

    span = lambda at, z: F.struct(
        (at + F.length(z["gaps"])).alias("start"), (at + F.length(z["gaps"]) + F.length(z["found"])).alias("end"),
        kind.alias("kind")
    )
    cuts = F.sequence(F.lit(0), F.greatest(F.size(found) - 1, F.lit(0)), F.lit(CHUNK))
    chunks = F.transform(
        cuts,
        lambda i: summed(
            F.slice(zipped, i + 1, F.lit(CHUNK)), span, SPAN, lambda z: F.length(z["gaps"]) + F.length(z["found"])
        )
    )
    moved = lambda at, c: F.transform(
        c["out"],
        lambda s: F.struct((s["start"] + at).alias("start"), (s["end"] + at).alias("end"), s["kind"].alias("kind"))
    )
    return F.flatten(summed(chunks, moved, f"array<{SPAN}>", lambda c: c["at"])["out"])


def base_spans(docs: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """Adds `into`: the valid base spans by start, then kind (code points, end exclusive)."""
    body = quoted(text)
    hint = {
        "email": F.contains(body, F.lit("@")), "ip": body.rlike("[0-9]\\.[0-9]"),
        "card": body.rlike("[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]"), "phone": F.contains(body, F.lit("+"))
    }
    none = F.array().cast("array<string>")
    found, parts = fresh(docs, into + "_found", into + "_parts")
    df = step(
        docs, docs.columns, found,
        F.struct(
            *(
                F.when(
                    hint[k], F.regexp_extract_all(body, F.lit(PATTERNS[k]), F.lit(0))
                ).otherwise(none).alias(k) for k in KINDS
            )
        )
    )
    df = step(
        df, df.columns, parts,
        F.struct(
            *(
                F.when(
                    F.size(quoted(found)[k]) > 0, F.split(body, PATTERNS[k], -1)
                ).otherwise(none).alias(k) for k in KINDS
            )
        )
    )
    spans = []
    for i, k in enumerate(KINDS):
        m = quoted(found)[k]
        at = F.arrays_zip(m.alias("m"), _positions(m, quoted(parts)[k], F.lit(i)).alias("s"))
        spans.append(F.transform(_kept(at, k), lambda z: z["s"]))
    some = F.size(F.concat(*(quoted(found)[k] for k in KINDS))) > 0
    order = F.sort_array(
        F.transform(
            F.concat(*spans),
            lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
        )
    )
    done = F.transform(
        order, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    )
    return step(df, docs.columns, into, F.when(some, done).otherwise(F.array().cast(SPAN)))


def _kept(at: Column, kind: str) -> Column:
    return F.filter(at, lambda z: _valid(kind, z["m"]))


def _texts(text: Column, s: Column) -> Column:
    return F.substr(text, s["start"] + 1, s["end"] - s["start"])


def _matches(text: Column, pattern: Column | str, some: Column) -> tuple[Column, Column]:
    """(matches, what stands before, between and after them) where `some`; none elsewhere."""
    none = F.array().cast("array<string>")
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    return F.when(
        some, F.regexp_extract_all(text, pattern, F.lit(0))
    ).otherwise(none), F.when(some, F.split(text, pattern, -1)).otherwise(none)


def _free(spans: Column, taken: Column) -> Column:
    """The spans that overlap none of `taken`."""
    return F.filter(spans, lambda s: ~F.exists(taken, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))


def _in_order(spans: Column) -> Column:
    """By start, then kind."""
    keyed = F.sort_array(
        F.transform(
            spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
        )
    )
    return F.transform(
        keyed, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    )


def secret_spans(docs: DataFrame, text: str, spans: str, into: str) -> DataFrame:
    """Adds `into`: secrets that overlap none of the spans of column `spans`."""
    found, = fresh(docs, into + "_found")
    body = quoted(text)
    m, gaps = _matches(
        body, SECRET,
        F.coalesce(body.rlike("[0-9][A-Za-z_-]|[A-Za-z_-][0-9]") & body.rlike("[A-Za-z0-9_-]{24}"), F.lit(False))
    )
    df = step(docs, docs.columns, found, F.struct(m.alias("m"), gaps.alias("gaps")))
    at = _positions(quoted(found)["m"], quoted(found)["gaps"], F.lit(len(KINDS)))
    return step(
        df, docs.columns, into,
        F.when(F.size(quoted(found)["m"]) > 0, _free(at, quoted(spans))).otherwise(F.array().cast(SPAN))
    )


def _beside(text: Column, s: Column, context: int) -> Column:
    """Lower-case words of letters, 3 or longer, among the `context` words before and after a
    span.  They are sought near it first, and in the whole text where it has too few there."""
    words = lambda x: F.filter(F.split(F.lower(x), LETTERS), lambda w: w != "")
    reach = 20 * context
    first = F.greatest(s["start"] - reach, F.lit(0))
    # of the words near by, one may be cut: one word more than `context` is enough
    near_before = words(F.substr(text, first + 1, s["start"] - first))
    before = F.when(
        (first > 0) & (F.size(near_before) <= context), words(F.substr(text, F.lit(1), s["start"]))
    ).otherwise(near_before)
    near_after = words(F.substr(text, s["end"] + 1, F.lit(reach)))
    after = F.when(
        (F.length(text) > s["end"] + reach) & (F.size(near_after) <= context),
        words(F.substr(text, s["end"] + 1, F.length(text)))
    ).otherwise(near_after)
    last = F.slice(before, F.greatest(F.size(before) - context + 1, F.lit(1)), F.lit(context))
    return F.filter(
        F.array_distinct(F.concat(last, F.slice(after, F.lit(1), F.lit(context)))), lambda w: F.length(w) >= 3
    )


TERMS = "array<struct<term:string,kind:int>>"


def _words_in(docs: DataFrame, text: str, terms: DataFrame, into: str) -> DataFrame:
    """Adds `into`: the distinct words of the text that `terms` (term, kind) has, sorted."""
    body = F.lower(F.coalesce(quoted(text), F.lit("")))
    words = F.array_distinct(F.split(body, LETTERS))
    taken = terms.select("term", "kind").limit(LITERAL_TERMS + 1).collect()
    if not taken:
        return docs.withColumn(into, F.array().cast(TERMS))
    if len(taken) <= LITERAL_TERMS:  # words are letters only, so they need no escapes
        (w,) = fresh(docs, into + "_words")
        if len(taken) <= FEW_TERMS:  # most texts have none of a few terms and need not be cut into words
            words = F.when(
                reduce(or_, (F.contains(body, F.lit(r.term)) for r in taken)), words
            ).otherwise(F.array().cast("array<string>"))
        df = step(docs, docs.columns, w, words)
        of = {k: ", ".join(repr(r.term) for r in sorted(taken) if r.kind == k) for k in sorted({r.kind for r in taken})}
        kind = " ".join(f"WHEN x IN ({v}) THEN {k}" for k, v in of.items())
        known = ", ".join(of.values())
        return step(
            df, docs.columns, into,
            F.expr(
                f"transform(array_sort(filter(`{w}`, x -> x IN ({known}))), x -> struct(x AS term, CASE {kind} END AS kind))"
            )
        )
    (key,) = fresh(docs, into + "_key")
    df = docs.withColumn(key, F.sha2(F.coalesce(quoted(text), F.lit("")), 256))
    # a text is spread over its words: nothing is grouped but the terms it has
    hits = df.select(
        quoted(key).alias("k"), F.explode(words).alias("term")
    ).join(terms.select("term", "kind"), "term").groupBy("k").agg(
        F.array_sort(F.collect_set(F.struct("term", "kind"))).alias(into)
    )
    return df.join(hits.withColumnRenamed("k", key), key, "left").select(
        *(quoted(c) for c in docs.columns), F.coalesce(quoted(into), F.array().cast(TERMS)).alias(into)
    )


def _entities(text: Column, s: Column) -> Column:
    """The entities of a span: level (0 value, 1 group, 2 kind), kind, and hash of all."""
    value = _texts(text, s)
    digits = F.regexp_replace(value, "[^0-9]", "")
    group = F.when(
        s["kind"] == 0, F.lower(F.substring_index(value, "@", -1))
    ).when(s["kind"] == 1, F.substring_index(value, ".", 2)).when(
        s["kind"] == 2, F.substr(digits, F.lit(1), F.lit(6))
    ).when(s["kind"] == 3, F.substr(digits, F.lit(1), F.lit(4)))
    of = lambda level, v: F.struct(
        F.lit(level).alias("level"), s["kind"].alias("kind"), F.xxhash64(F.lit(level), s["kind"], v).alias("e")
    )
    return F.filter(
        F.array(of(0, value), F.when(group.isNotNull(), of(1, group)), of(2, F.lit(""))), lambda x: x.isNotNull()
    )


def disclosing_terms(
    docs: DataFrame, spans: str, text: str = "text", context: int = 5, support: int = 3, disclosure: float = 0.9,
    corpus: DataFrame | None = None
) -> DataFrame:
    """(term, kind): terms that disclose an entity, and the kind of span they are.  `corpus`: the
    same documents as they were before the spans, so that counts need not find spans again."""
    corpus = docs.select(quoted(text)) if corpus is None else corpus.select(quoted(text))
    found = docs.select(quoted(text).alias("text"), quoted(spans).alias("s")).filter(F.size("s") > 0)
    told = F.transform(
        "s",
        lambda s: F.struct(_entities(F.col("text"), s).alias("of"), _beside(F.col("text"), s, context).alias("terms"))
    )
    beside = step(found, ["text"], "x", told)
    pairs = F.flatten(
        F.flatten(
            F.transform(
                "x",
                lambda x: F.transform(
                    x["of"], lambda e: F.transform(x["terms"], lambda t: F.struct(e.alias("of"), t.alias("term")))
                )
            )
        )
    )
    entities = F.array_distinct(F.flatten(F.transform("x", lambda x: x["of"])))
    rows = written(
        beside.select(
            F.xxhash64("text").alias("k"), entities.alias("entities"), F.array_distinct(pairs).alias("pairs")
        ),
        "entities"
    )
    n = corpus.count()
    # documents are counted, copies included; a document counts once for a pair
    docs_of = rows.select(F.explode("entities").alias("of")).groupBy("of").agg(F.count(F.lit(1)).alias("n_e"))
    by_text = rows.select(
        "k", F.explode("pairs").alias("p")
    ).groupBy("p.of", "p.term", "k").agg(F.count(F.lit(1)).alias("copies"))
    pairs = by_text.groupBy("of", "term").agg(
        F.sum("copies").alias("n_te"), F.count(F.lit(1)).alias("texts")
    ).filter(F.col("texts") >= support)
    # PMI >= disclosure * IC needs n(t) <= n(t, e) * (N / n(e)) ** (1 - disclosure); a term already beside
    # spans in more texts than that can't reach it and need not be counted
    least = by_text.filter("of.level = 2").select("term", "k").distinct().groupBy("term").agg(
        F.count(F.lit(1)).alias("n_beside")
    )
    most = F.col("n_te") * F.pow(F.lit(float(n)) / F.col("n_e"), F.lit(1 - disclosure)) * (1 + 1e-9)
    pairs = written(
        pairs.join(docs_of, "of").join(least, "term").filter(F.col("n_beside") <= most).drop("n_beside"), "pairs"
    )
    (hit,) = fresh(corpus, "hit")
    asked = pairs.select("term", F.lit(0).alias("kind")).distinct()
    counts = _words_in(corpus, text, asked, hit).select(
        F.explode(quoted(hit)["term"]).alias("term")
    ).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    n_te, n_t, n_e = F.least("n_te", "n_t", "n_e").cast("double"), F.col("n_t"), F.col("n_e")
    pmi, ic = F.log(n * n_te / (n_t * n_e)), F.log(F.lit(float(n)) / n_e)
    told = pairs.join(counts, "term").filter((ic > 0) & (pmi >= disclosure * ic - 1e-9))
    whole = (F.col("of.level") < 2) & (n_te >= n_t)
    best = F.max_by(F.col("of.kind"), F.struct(F.round(pmi / ic, 9), -F.col("of.kind")))
    return told.groupBy("term").agg(F.when(F.max(whole), F.lit(REMOVED)).otherwise(TERM + best).alias("kind"))


def find(
    docs: DataFrame, text: str = "text", into: str = "spans", context: int = 5, support: int = 3,
    disclosure: float = 0.9
) -> DataFrame:
    """Adds `into`: base spans, secrets and spans of disclosing terms by start; their kinds are
    places in `NAMES` and `MARKS`."""
    (into,) = fresh(docs, into)
    extra, have, found, out = fresh(docs, into + "_secrets", into + "_terms", into + "_found", into + "_all")
    based = secret_spans(base_spans(docs, text, into), text, into, extra)
    both = F.concat(quoted(into), quoted(extra))
    terms = written(
        disclosing_terms(based.select(quoted(text), both.alias(into)), into, text, context, support, disclosure, docs),
        "terms"
    )
    df = _words_in(based, text, terms, have)
    body = quoted(text)
    pattern = F.concat(
        F.lit("(?iu)(?<!\\p{L})(?:"), F.array_join(F.transform(quoted(have), lambda t: t["term"]), "|"),
        F.lit(")(?!\\p{L})")
    )
    m, gaps = _matches(body, pattern, F.size(quoted(have)) > 0)
    df = step(df, df.columns, found, F.struct(m.alias("m"), gaps.alias("gaps")))
    kind_of = lambda w: F.element_at(F.filter(quoted(have), lambda t: t["term"] == F.lower(w)), 1)["kind"]
    at = F.arrays_zip(
        quoted(found)["m"].alias("m"), _positions(quoted(found)["m"], quoted(found)["gaps"], F.lit(TERM)).alias("s")
    )
    named = F.transform(
        at,
        lambda z: F.struct(
            z["s"]["start"].alias("start"), z["s"]["end"].alias("end"),
            F.coalesce(kind_of(z["m"]), F.lit(TERM)).alias("kind")
        )
    )
    added = F.when(F.size(quoted(found)["m"]) > 0, _free(named, both)).otherwise(F.array().cast(SPAN))
    some = (F.size(quoted(found)["m"]) > 0) | (F.size(quoted(extra)) > 0)
    df = step(df, docs.columns + [into], out, F.when(some, _in_order(F.concat(both, added))).otherwise(quoted(into)))
    return df.select(*(quoted(c) for c in docs.columns), quoted(out).alias(into))


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*map(F.lit, NAMES))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
        ),
        ","
    )


def sanitise(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars", **options) -> DataFrame:
    """The documents with every span replaced by its mark; overlapping spans become one,
    with the mark of the first.  `n_chars`, if there is such a column, is set anew."""
    (spans,) = fresh(docs, "spans")
    df = find(docs, text, spans, **options)
    marks = F.array(*map(F.lit, MARKS))
    body = quoted(text)
    end_of = lambda some: F.coalesce(F.array_max(F.transform(some, lambda s: s["end"])), F.lit(0))

    def add(a: Column, s: Column) -> Column:
        piece = F.concat(
            F.substr(body, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0))), F.get(marks, s["kind"])
        )
        out = F.when(s["start"] >= a["at"], F.concat(a["out"], F.array(piece))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), out.alias("out"))

    def part(i: Column) -> Column:
        """What the spans of the chunk at i make of the text from the end of the spans before it."""
        start = F.struct(
            end_of(F.slice(quoted(spans), F.lit(1), i)).alias("at"), F.array().cast("array<string>").alias("out")
        )
        return F.aggregate(
            F.slice(quoted(spans), i + 1, F.lit(CHUNK)), start, add, lambda a: F.array_join(a["out"], "")
        )

    cuts = F.sequence(F.lit(0), F.greatest(F.size(quoted(spans)) - 1, F.lit(0)), F.lit(CHUNK))
    new = F.concat(F.array_join(F.transform(cuts, part), ""), F.substr(body, end_of(quoted(spans)) + 1, F.length(body)))
    (made,) = fresh(df, "made")
    df = step(df, docs.columns, made, F.when(F.size(quoted(spans)) > 0, new).otherwise(body))
    size = [c for c in docs.columns if c == n_chars]
    swap = {
        text: quoted(made).alias(text),
        **{
            c: F.when(
                quoted(made).isNull(), quoted(c)
            ).otherwise(F.length(quoted(made))).cast(docs.schema[c].dataType).alias(c) for c in size
        }
    }
    return df.select(*(swap.get(c, quoted(c)) for c in docs.columns))
