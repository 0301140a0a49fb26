"""Token counts of whole texts by a public tokenizer file.

Tasks get Arrow batches of bounded bytes (`small_batches`), encode groups of about equal
UTF-8 bytes and give back lengths only.  A text is cut where one space stands between two
characters that are not white space: the byte-level pre-tokenizer always starts a new piece
there, so the counts of the parts add up.  Other spaces stay inside their part.  Each
distinct part of at most `PART_CHARS` characters is encoded by the library once and its
length kept in a table of bounded bytes; longer parts are encoded wherever they stand.

Defined cases: null and empty texts have 0 bytes and 0 tokens; very long texts are cut at
the same boundaries and counted whole; special strings inside texts count as the library's
default has them; repeated rows are counted one by one; an empty table gives no rows; a
column named like the added one keeps its name, the added one gets an underscore.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fresh, quoted, small_batches

#: Distinct parts whose lengths a worker keeps, and the longest; the table starts anew when full.
KEPT_PARTS, PART_CHARS = 300_000, 64
#: Texts with white space beside a space (more is matched here than any library calls white
#: space) are cut at their other spaces only.
UNSAFE = re.compile(r" \s|\s ")
SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")

_loaded: dict = {}


def _tokenizer(path: str):
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_padding()
        t.no_truncation()
        _loaded[path] = (t, {})
    return _loaded[path]


def lengths(texts: list[str], path: str, max_bytes: int = 1 << 20) -> list[int]:
    """Tokens of each text."""
    tokenizer, known = _tokenizer(path)

    def encoded(parts: list[str]) -> list[int]:
        out: list[int] = []
        for group in byte_groups(parts, max_bytes):
            out += map(len, tokenizer.encode_batch_fast(group, add_special_tokens=False))
        return out

    cut: list[list[str]] = []
    new: dict[str, None] = {}
    for text in texts:
        if UNSAFE.search(text):
            parts = SAFE_CUT.split(text)
        else:
            first, *rest = text.split(" ")
            parts = [first, *(" " + x for x in rest)] if rest else [first]
        cut.append(parts)
        new.update(dict.fromkeys(x for x in parts if x not in known))
    rare = [x for x in new if len(x) > PART_CHARS]
    if len(known) + len(new) - len(rare) > KEPT_PARTS:
        new.update(dict.fromkeys(x for parts in cut for x in parts if len(x) <= PART_CHARS))
        known.clear()
    known.update(zip(new, encoded(list(new)), strict=True))
    counts = [sum(map(known.__getitem__, parts)) for parts in cut]
    for x in rare:
        del known[x]
    return counts


def byte_groups(texts: Iterable[str], max_bytes: int) -> Iterator[list[str]]:
    """The texts in order, in groups that end once they have `max_bytes` bytes of UTF-8."""
    group, size = [], 0
    for x in texts:
        group.append(x)
        size += len(x) if x.isascii() else len(x.encode())
        if size >= max_bytes:
            yield group
            group, size = [], 0
    if group:
        yield group


def count_tokens(
    docs: DataFrame, path: str, text: str = "text", into: str = "n_tokens", max_bytes: int = 4 << 20
) -> DataFrame:
    """Adds the long column `into`.  `path`: file of the tokenizer, on every worker."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([n for group in byte_groups(batch, max_bytes) for n in lengths(group, path)], dtype="int64")

    (name,) = fresh(docs, into)
    return docs.withColumn(name, count(F.coalesce(quoted(text), F.lit(""))))
