"""What the corpus operators share: fresh column names, word arrays, written tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate the words `[^\x20\x09-\x0D]+`.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores put before it until `df` has no such column."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name = "_" + name
        have.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def lower_ascii(text: Column) -> Column:
    """Only A-Z become lower case."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` in order; none for null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(F.length(bare) == 0, F.array().cast("array<string>")).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.  Only where it
    is unset on one machine (master local, as in tests) a local one is made."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes `df` to the shared folder and reads it back: cuts the lineage, and a lost
    executor costs no recomputation."""
    path = f"{shared_folder(df.sparkSession)}/taxoweave-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for held in _scratch.__dict__.get("lists", []):
        held.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Lists that `recorded` fills, of each thread.
_scratch = threading.local()


@contextmanager
def recorded(held: list[str]) -> Iterator[None]:
    """Adds to `held` the folders that `written` makes inside."""
    lists = _scratch.__dict__.setdefault("lists", [])
    lists.append(held)
    try:
        yield
    finally:
        lists.pop()


def remove(spark: SparkSession, held: list[str]) -> None:
    """Deletes the folders and empties the list; nothing may be read from them any more."""
    while held:
        where = spark._jvm.org.apache.hadoop.fs.Path(held.pop())
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def small_batches(spark: SparkSession, rows: int = 512, size: str = "16m") -> None:
    """Bounds the rows and bytes of an Arrow batch, as whole texts may be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")



def step(df: DataFrame, keep: list[str], name: str, value: Column) -> DataFrame:
    """The columns `keep`, and `name` = `value`, evaluated once a row: the one-row
    generator keeps the optimizer from copying `value` to where it is used, which inside
    a lambda would evaluate it anew for every array element."""
    return df.select(*(quoted(c) for c in keep), F.explode_outer(F.array(value)).alias(name))
