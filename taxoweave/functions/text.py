"""Column functions on labels, names, rule texts and replies.

All are built-in expressions: they stay in the JVM, and null gives null unless said."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What is neither letter, digit, underscore nor white space.
PUNCTUATION = r"[^\p{L}\p{N}_\s]"
TOKEN = r"[\p{L}\p{N}_]{2,}"
STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the",
    "this", "to", "was", "with"
]


def squeeze(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def split_camel(x: Column) -> Column:
    return F.regexp_replace(x, "(?<=[a-z0-9])([A-Z])", " $1")


def normalize_concept(x: Column) -> Column:
    """Camel case split, dashes and underscores as spaces, no punctuation, lower case,
    single spaces; null gives ''."""
    return F.coalesce(
        squeeze(F.lower(F.regexp_replace(F.translate(split_camel(x), "-_", "  "), PUNCTUATION, ""))), F.lit("")
    )


def normalize_label(x: Column) -> Column:
    """Lower case without punctuation; camel case and underscores stay."""
    return squeeze(F.regexp_replace(F.lower(x), PUNCTUATION, ""))


def normalize_squash(x: Column) -> Column:
    return F.replace(F.lower(x), F.lit(" "), F.lit(""))


def local_name(uri: Column) -> Column:
    """After the last '#', else after the last '/'."""
    return F.when(
        F.contains(uri, F.lit("#")), F.substring_index(uri, "#", -1)
    ).otherwise(F.substring_index(uri, "/", -1))


def uuid_of_uri(uri: Column) -> Column:
    """The last 36 characters if they look like a UUID."""
    found = F.regexp_extract(F.lower(uri), "([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})$", 1)
    return F.nullif(found, F.lit(""))


def capitalised_words(x: Column) -> Column:
    """Each word with a capital first letter and the rest lower."""
    words = F.filter(F.split(x, r"\s+"), lambda w: w != "")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))), " "
    )


def first_text(values: Column) -> Column:
    """The first entry that is not blank, trimmed."""
    return F.get(F.filter(F.transform(values, lambda v: F.trim(v)), lambda v: F.length(v) > 0), F.lit(0))


def primary_label(
    uri: Column, pref: Column, rdfs: Column, alt: Column, definitions: Column, fallback: Column | None = None
) -> Column:
    """First label by property order; without a fallback the definition, cut at 60; then
    the words of the URI's local name; then the fallback; then the URI."""
    options = [first_text(pref), first_text(rdfs), first_text(alt)]
    if fallback is None:
        d = first_text(definitions)
        options.append(F.concat(F.substring(d, 1, 60), F.when(F.length(d) > 60, "...").otherwise("")))
    name = local_name(uri)
    words = capitalised_words(F.translate(split_camel(name), "_-", "  "))
    options.append(F.when((name != uri) & (name != ""), F.nullif(words, F.lit(""))))
    return F.coalesce(*options, *([fallback] if fallback is not None else []), uri)


def safe_uri_name(x: Column) -> Column:
    """Spaces, '/', ':' and '#' as underscores, the rest percent-encoded but for '-', '_',
    '.' and '~'; empty and null give unknown_concept."""
    encoded = F.url_encode(F.translate(x, " /:#", "____"))
    plain = F.replace(
        F.replace(F.replace(encoded, F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")
    )
    return F.when(F.coalesce(F.length(x), F.lit(0)) == 0, "unknown_concept").otherwise(plain)


def safe_local_name(x: Column, context: str = "") -> Column:
    """Without brackets and signs, at most 80 characters, then `_context`."""
    s = F.regexp_replace(F.translate(F.trim(x), " /:#()", "____"), r"[^\p{L}\p{N}_-]", "")
    tail = f"_{context}" if context else ""
    return F.when(F.coalesce(F.length(x), F.lit(0)) == 0, "unknown" + tail).otherwise(
        F.concat(F.url_encode(F.substring(s, 1, 80)), F.lit(tail))
    )


def keywords_of(normalized: Column, longer_than: int = 2, stop_words: list[str] | None = None) -> Column:
    words = F.filter(F.split(normalized, " "), lambda w: F.length(w) > longer_than)
    return F.array_except(words, F.array(*map(F.lit, stop_words))) if stop_words else words


def bm25_tokens(text: Column, stop_words: list[str] | None = None) -> Column:
    """Lower-case runs of two or more word characters, without stop words; repeats stay."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))
    return F.filter(tokens, lambda t: ~t.isin(*stop_words)) if stop_words else tokens


def word_set(x: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(x), r"\s+"), lambda w: w != ""))


def jaccard_words(a: Column, b: Column) -> Column:
    """Common words over all words; 1 if both have none, 0 if one has none."""
    x, y = word_set(F.coalesce(a, F.lit(""))), word_set(F.coalesce(b, F.lit("")))
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(x, y)) / union)


def word_overlap(a: Column, b: Column) -> Column:
    x, y = word_set(a), word_set(b)
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, 0.0).otherwise(F.lit(0.7) * F.size(F.array_intersect(x, y)) / union)


def label_match_kind(norm: Column, label: Column) -> Column:
    return F.when(norm == label, "Exact").when(
        norm == F.concat(label, F.lit("s")), "Plural input"
    ).when(label == F.concat(norm, F.lit("s")), "Plural label")


def ns_priority(uri: Column, prefixes: list[str]) -> Column:
    """Place of the first prefix that fits, else their number + 10."""
    return F.coalesce(
        *(F.when(F.startswith(uri, F.lit(p)), i) for i, p in enumerate(prefixes)), F.lit(len(prefixes) + 10)
    )


def clamp01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


BAD_URI = r'[ <>"{}|\\^`]'


def uri_problems(uri: Column) -> Column:
    """array<struct<severity, message>>: unknown scheme, characters that a URI can't have."""
    scheme = F.when(
        ~uri.rlike("^(http|https|urn):"),
        F.struct(F.lit("WARNING").alias("severity"), F.lit("scheme is not http, https or urn").alias("message"))
    )
    bad = F.array_sort(F.array_distinct(F.regexp_extract_all(uri, F.lit(BAD_URI), F.lit(0))))
    chars = F.when(
        F.size(bad) > 0,
        F.struct(
            F.lit("ERROR").alias("severity"),
            F.concat(F.lit("invalid characters: "), F.array_join(bad, "")).alias("message")
        )
    )
    return F.filter(F.array(scheme, chars), lambda i: i.isNotNull())


def typed_literal(value: Column, kind: Column) -> Column:
    """struct(text, failed): the value in the form of its type; `failed` if it has none."""
    low = F.lower(F.trim(value))
    made = (
        F.when(
            kind == "boolean", F.when(low.isin("true", "1", "yes"), "true").when(low.isin("false", "0", "no"), "false")
        )
        .when(kind == "integer", value.try_cast("bigint").cast("string"))
        .when(kind == "decimal", F.when(value.try_cast("decimal(38,6)").isNotNull(), F.trim(value)))
        .when(kind == "double", F.when(value.try_cast("double").isNotNull(), F.trim(value)))
        .when(kind == "dateTime", F.when(F.try_to_timestamp(value).isNotNull(), value))
        .otherwise(value)
    )
    failed = value.isNotNull() & made.isNull()
    return F.struct(F.coalesce(made, F.when(kind == "dateTime", value)).alias("text"), failed.alias("failed"))


def json_from_reply(reply: Column) -> Column:
    """JSON object text of a reply: a fenced block, else what the outermost braces hold;
    null if that is no object."""
    fenced = F.regexp_extract(reply, r"(?is)```json\s*(\{.*?\})\s*```", 1)
    braces = F.regexp_extract(reply, r"(?s)(\{.*\})", 1)
    body = F.when(fenced != "", fenced).otherwise(braces)
    return F.when(F.get_json_object(body, "$").startswith("{"), body)


def required_count(rule: Column) -> Column:
    """The number in 'N of', else 1."""
    return F.coalesce(F.nullif(F.regexp_extract(rule, r"(?i)(\d+)\s+of\b", 1), F.lit("")).cast("int"), F.lit(1))


def required_stars(rule: Column) -> Column:
    return F.nullif(F.regexp_extract(rule, r"(?i)(\d+(?:\.\d+)?)\+?[- ]?stars?\b", 1), F.lit("")).cast("double")


def clean_section(x: Column) -> Column:
    """Without lines of '=', at most one blank line together, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(x, "(?m)^=+$", ""), "\n{3,}", "\n\n"))


def theme_name(x: Column) -> Column:
    """Theme names without the words that do not tell them apart."""
    return squeeze(
        F.regexp_replace(
            F.translate(F.lower(x), "-", " "), r"\b(property|properties|friendly|certified|stars?|theme)\b", ""
        )
    )
