"""The corpus pipeline: quality rules, n-gram Jaccard join, benchmark decontamination,
PII and best-fit packing, each over all that its predecessor kept.

The stages are plain functions of (spark, docs, sf_dir).  Between stages the rows are
written as Parquet in the shared folder and read again, so a lost executor repeats one
stage at most.  What a stage wrote beside its result is deleted when the next stage starts:
by then the result must be written, as `run` does it.  All stages but the last return the
columns of documents.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxoweave.llm import decontaminate, jaccard, packing, pii, quality
from taxoweave.llm.shared import documents, recorded, remove, words, written

#: Near duplicates: shared five-word shingles, similarity in percent.
SHINGLE, PERCENT = 5, 80
#: Words of a window that contaminates.
WINDOW = 10
#: Words of a packed bin.
BIN_WORDS = 2048

#: Folders that the stage before wrote beside its result, of each thread that runs a pipeline.
_threads = threading.local()


@contextmanager
def _stage(spark: SparkSession) -> Iterator[None]:
    left = _threads.__dict__.setdefault("left", [])
    remove(spark, left)
    with recorded(left):
        yield


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base limits, or that the rules' posterior rejects, go.

    Null and empty texts have no words and fail; very long texts are measured whole; repeated
    rows are judged one by one; a posterior of 0.5 stays; an empty table stays empty; columns
    of any names are kept."""
    with _stage(spark):
        return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays: the one with the smallest id.

    Documents without words, null texts included, link with nothing and stay; texts that share
    an id are documents of their own; of equal rows one stays; ids that are null come last;
    very long texts are taken whole; an empty table stays empty."""
    with _stage(spark):
        return jaccard.keep_one(docs, SHINGLE, PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of ten words of a benchmark item go.

    Null and empty texts have no words and stay; items of fewer words are one window; very
    long texts are scanned whole; repeated rows are judged one by one; without documents or
    items nothing goes."""
    with _stage(spark):
        return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=WINDOW, mode="documents")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, secrets and disclosing terms are replaced by marks, and n_chars set anew.

    Every row stays; null texts stay null; overlapping spans become one mark; repeated rows
    are masked alike; very long texts are masked whole; an empty table stays empty."""
    with _stage(spark):
        return pii.sanitise(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' parts in bins: doc_id, part, bin, start, length in words.

    Null and empty texts take a place of length 0; texts longer than a bin are cut into full
    bins and a rest; two texts of a source, or two equal texts, share no bin; null sources and
    texts conflict with nothing; an empty table gives no rows."""
    with _stage(spark):
        return packing.pack(docs, F.size(words(F.col("text"))), BIN_WORDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has no form for the expectation-maximisation of the first stage, nor for packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bins of all documents that the stages keep.  A run that fails deletes what it has written."""
    docs, before = documents(spark, sf_dir), []
    try:
        for name, stage in STAGES[:-1]:
            out, now = stage(spark, docs, sf_dir), []
            with recorded(now):
                docs = written(out, name)
            remove(spark, before)
            before = now
        return STAGES[-1][1](spark, docs, sf_dir)
    except BaseException:
        remove(spark, before)
        remove(spark, _threads.__dict__.get("left", []))
        raise
