"""Rule documents as tables of lines, tables and rules; rules evaluated over properties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import clean_section, required_count, required_stars
from ..stages import staged


def split_blocks(docs: DataFrame) -> DataFrame:
    """(doc_id, block, text): documents cut at lines of '='; blocks start with a '# ' heading."""
    parts = F.filter(
        F.transform(F.split("text", "(?m)^={3,}$"), lambda x: F.btrim(x, F.lit("\n "))),
        lambda x: F.startswith(x, F.lit("# "))
    )
    return docs.select("doc_id", F.posexplode(parts).alias("block", "text"))


def line_sections(blocks: DataFrame) -> DataFrame:
    """(doc_id, block, line_no, line, heading, section, subsection, audience): headings are
    carried down over the lines that follow."""
    lines = blocks.select("doc_id", "block", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    w = W.partitionBy("doc_id", "block").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    title = lambda mark: F.nullif(F.regexp_extract("line", f"^{mark} +(.*)$", 1), F.lit(""))
    d = lines.select("*", title("#").alias("h1"), title("##").alias("h2"), title("###").alias("h3"))
    d = d.select(
        "*", F.last("h1", True).over(w).alias("heading"), F.last("h2", True).over(w).alias("section"),
        F.sum(F.col("h2").isNotNull().cast("int")).over(w).alias("s")
    )
    # a subsection ends with its section
    d = d.withColumn(
        "subsection",
        F.last("h3", True).over(
            W.partitionBy("doc_id", "block", "s").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
        )
    )
    where = F.lower(F.coalesce("subsection", "section", F.lit("")))
    audience = F.when(
        F.contains(where, F.lit("conventional")), "conventional"
    ).when(F.contains(where, F.lit("vacation")), "vacation")
    return d.select(
        "doc_id", "block", "line_no", "line", "heading", "section", "subsection", audience.alias("audience")
    )


def _cells(line: Column) -> Column:
    return F.transform(F.split(F.btrim(F.trim(line), F.lit("|")), r"\|"), lambda x: F.trim(x))


def markdown_tables(lines: DataFrame) -> DataFrame:
    """(doc_id, block, section, subsection, table_no, row_no, header, cell): the cells of every
    table; the first row is the header, separator rows are skipped, short rows padded with ''."""
    is_row = F.trim("line").rlike(r"^\|.*\|$")
    by = W.partitionBy("doc_id", "block").orderBy("line_no")
    t = lines.withColumn(
        "table_no", F.sum((~is_row).cast("int")).over(by)
    ).filter(is_row & ~F.trim("line").rlike(r"^\|[\s:|-]+\|$"))
    inside = W.partitionBy("doc_id", "block", "table_no").orderBy("line_no")
    t = t.select("*", _cells(F.col("line")).alias("cells"), (F.row_number().over(inside) - 1).alias("row_no"))
    t = t.withColumn("headers", F.first("cells").over(inside)).filter("row_no > 0")
    pairs = F.transform(
        "headers", lambda h, i: F.struct(h.alias("header"), F.coalesce(F.get("cells", i), F.lit("")).alias("cell"))
    )
    return t.select(
        "doc_id", "block", "section", "subsection", "table_no", "row_no", F.explode(pairs).alias("p")
    ).select("doc_id", "block", "section", "subsection", "table_no", "row_no", "p.header", "p.cell")


def key_values(lines: DataFrame, keys: list[str]) -> DataFrame:
    """(doc_id, block, key, value) of '**Key**: value' lines, keys in snake case."""
    pattern = r"^\s*\*\*([^*]+?):?\*\*:?\s*(.*)$"
    k = F.lower(F.trim(F.regexp_extract("line", pattern, 1)))
    out = lines.select(
        "doc_id", "block", F.regexp_replace(k, r"\s+", "_").alias("key"),
        F.trim(F.regexp_extract("line", pattern, 2)).alias("value"), k.alias("k")
    )
    return out.filter(F.col("k").isin(*[x.lower() for x in keys])).drop("k")


# How rule sentences begin and end.
SPANS = [
    r"(?im)Properties must have[^\n]*",
    r"(?im)\*\*[^\n]*?\*\*(?:\s*(?:OR|AND)\s*\*\*[^\n]*?\*\*)*",
    r"(?im)Minimum requirement is[^\n]*",
    r"(?im)(?:Must have|Required:)[^\n]*",
    r"(?im)(?:Property has|Properties have)\s+[^\n]*?(?=\s*(?:AND|OR|<br>|\n)|$)",
]
SPAN_WORDS = r"must have|of the following|minimum requirement|property has|properties have"


def rule_spans(texts: DataFrame) -> DataFrame:
    """(doc_id, span): the distinct rule sentences of texts (doc_id, text) that say what is required."""
    found = F.array_distinct(F.concat(*(F.regexp_extract_all("text", F.lit(p), F.lit(0)) for p in SPANS)))
    return texts.select("doc_id", F.explode(found).alias("span")).filter(F.lower("span").rlike(SPAN_WORDS))


RULE_WORDS = r"(?i)must have|of the following|minimum requirement|property has"


def rule_groups(lines: DataFrame) -> DataFrame:
    """(doc_id, block, line_no, alt_id, conj_id, text, required_count, stars, grp): one row for
    each conjunct of each alternative of a rule sentence."""
    r = lines.filter(F.col("line").rlike(RULE_WORDS)).select(
        "doc_id", "block", "line_no", F.posexplode(F.split("line", r"\s+OR\s+")).alias("alt_id", "alt")
    )
    c = r.select(
        "doc_id", "block", "line_no", "alt_id", F.posexplode(F.split("alt", r"\s+AND\s+")).alias("conj_id", "text")
    )
    group = F.coalesce(
        F.nullif(F.lower(F.regexp_extract("text", r"(?i)of the following ([a-z]+) ", 1)), F.lit("")), F.lit("main")
    )
    return c.select(
        "*", required_count(F.col("text")).alias("required_count"), required_stars(F.col("text")).alias("stars"),
        group.alias("grp")
    )


def attribute_groups(tables: DataFrame, names: list[str]) -> DataFrame:
    """(doc_id, block, grp, row_no, attribute, aid, uuid): table rows under headings that hold a
    group name; the first name found counts, else main."""
    where = F.lower(F.coalesce("subsection", "section", F.lit("")))
    grp = F.coalesce(*(F.when(F.contains(where, F.lit(n)), n) for n in names), F.lit("main"))
    pick = lambda h: F.max(F.when(F.lower("header") == h, F.col("cell")))
    return tables.withColumn("grp", grp).groupBy("doc_id", "block", "grp", "table_no", "row_no").agg(
        pick("attribute").alias("attribute"), pick("aid").alias("aid"), pick("uuid").alias("uuid")
    ).drop("table_no").filter("attribute IS NOT NULL")


#: What marks exception lines.
EXCEPTIONS = {
    "disqualifying": "do not qualify", "adjacent": "adjacent to", "documents": "documentation|certificate",
    "country": "countr(y|ies)"
}


def exception_lines(lines: DataFrame) -> DataFrame:
    """(doc_id, block, line_no, kind, line) of lines that restrict a rule."""
    kinds = F.filter(
        F.array(*(F.when(F.lower("line").rlike(p), k) for k, p in EXCEPTIONS.items())), lambda x: x.isNotNull()
    )
    return lines.select("doc_id", "block", "line_no", F.explode(kinds).alias("kind"), "line")


def theme_summary(tables: DataFrame) -> DataFrame:
    """(doc_id, row_no, name, uuid, automated, properties) of a summary table."""
    pick = lambda h: F.max(F.when(F.lower("header") == h, F.col("cell")))
    t = tables.groupBy("doc_id", "block", "table_no", "row_no").agg(
        pick("theme").alias("name"), pick("uuid").alias("uuid"), pick("automated").alias("automated"),
        pick("properties").alias("properties")
    ).filter("name IS NOT NULL")
    return t.select(
        "doc_id", "row_no", "name", "uuid", F.lower("automated").isin("yes", "y", "true").alias("automated"),
        F.replace("properties", F.lit(","), F.lit("")).try_cast("bigint").alias("properties")
    )


def excluded_countries(lines: DataFrame, column: int = 0) -> DataFrame:
    """(code): three capital letters in the given column of lines cut at tabs or wide gaps."""
    cell = F.trim(F.get(F.split("line", r"\t| {2,}"), F.lit(column)))
    return lines.select(cell.alias("code")).filter(F.col("code").rlike("^[A-Z]{3}$")).distinct()


def attribute_bits(attributes: DataFrame) -> DataFrame:
    """(attr, word, mask): a bit of a 64-bit word for each attribute (grp, attr) of a rule, those of
    a group side by side.  Numbers come from the places in a written table, so that no task
    sees all attributes."""
    first = attributes.groupBy("attr").agg(F.min("grp").alias("grp"))
    placed = staged(
        first.repartitionByRange("grp", "attr").sortWithinPartitions("grp", "attr").select(
            "attr", F.monotonically_increasing_id().alias("i")
        ),
        "bits"
    )
    return placed.select(
        "attr", F.shiftright("i", 6).alias("word"), F.expr("shiftleft(1L, CAST(i & 63 AS INT))").alias("mask")
    )


def evaluate_rules(
    held: DataFrame, groups: DataFrame, attributes: DataFrame, disqualifying: DataFrame | None = None
) -> DataFrame:
    """(p, theme, alt_id): alternatives that a property (p, attr) satisfies: of each group (theme,
    alt_id, grp, required_count) it holds enough attributes (theme, grp, attr); properties with
    a disqualifying attribute (theme, attr) do not qualify.

    Attributes are bits: a property is some 64-bit words, a group of a rule is masks over them,
    and how many attributes of a group it holds is the number of bits in both.  So a property
    meets a group once a word, not once an attribute, and repeated rows of `held` add nothing."""
    bits = attribute_bits(attributes)
    masks = attributes.join(bits, "attr").groupBy("theme", "grp", "word").agg(F.bit_or("mask").alias("wanted"))
    words = held.select("p", "attr").join(bits, "attr").groupBy("p", "word").agg(F.bit_or("mask").alias("has"))
    both = F.bit_count(F.col("has").bitwiseAND(F.col("wanted")))
    hits = words.join(masks, "word").groupBy("p", "theme", "grp").agg(F.sum(both).alias("n")).filter("n > 0")
    ok = hits.join(groups, ["theme", "grp"]).filter(F.col("n") >= F.col("required_count")).groupBy(
        "p", "theme", "alt_id"
    ).agg(F.count(F.lit(1)).alias("ok"))
    need = groups.groupBy("theme", "alt_id").agg(F.count(F.lit(1)).alias("need"))
    out = ok.join(need, ["theme", "alt_id"]).filter("ok = need").select("p", "theme", "alt_id")
    if disqualifying is not None:
        bad = held.select("p", "attr").join(
            disqualifying.select("theme", "attr").distinct(), "attr"
        ).select("p", "theme").distinct()
        out = out.join(bad, ["p", "theme"], "left_anti")
    return out


def uuid_to_uri(rules: DataFrame, uris: DataFrame, uuid: Column) -> DataFrame:
    """Rules (..., uuid) with the URI that ends in the UUID; unmatched ones say so."""
    known = uris.select(
        "uri", uuid.alias("uuid")
    ).filter("uuid IS NOT NULL").groupBy("uuid").agg(F.min("uri").alias("uri"))
    return rules.join(known, "uuid", "left").select(
        *rules.columns, F.coalesce("uri", F.lit("URI not found")).alias("uri")
    )


def coverage(mapped: DataFrame) -> DataFrame:
    """One row: UUIDs found, not found, percent."""
    found = F.sum((F.col("uri") != "URI not found").cast("int"))
    n = F.count(F.lit(1))
    return mapped.select("uuid", "uri").distinct().agg(
        found.cast("long").alias("found"), (n - found).cast("long").alias("not_found"),
        F.round(100.0 * found / n, 2).alias("percent")
    )


def theme_rules_merge(summary: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merged, unmatched rule documents): the summary's themes with their rule text by UUID."""
    merged = summary.join(rules.select("uuid", "rule"), "uuid", "left").select(
        "uuid", "name", F.coalesce("rule", F.lit("No rule document")).alias("rule")
    )
    return merged, rules.join(summary.select("uuid"), "uuid", "left_anti")
