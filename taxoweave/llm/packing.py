"""Best-fit packing of texts into bins with conflicts.

Texts longer than a bin are cut into full bins and a rest.  Texts are dealt by a hash
to shards of about `shard_rows`, so that a source or a group of copies with a third of
all rows is spread evenly; each shard is packed by itself, longest first.  The open bins
of a shard are ordered by residual; the search starts at the smallest residual that is
large enough and goes on to its successors until a bin has neither the text's source nor
its duplicate cluster, which the bins carry as bitmaps.  So the tightest compatible bin
is found, exactly.  A task closes its bins after `block_rows` texts, which bounds memory
even if all rows fall into one shard.

Defined cases: a text of length 0 (null, empty) takes no room but a place in a bin; null
sources and clusters conflict with nothing; very long texts fill bins of their own but for
their rest; texts of equal length are packed by id, cluster and source; repeated rows are
packed one by one, and conflict as members of one cluster; an empty table gives no rows;
other columns are not read, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import quoted

#: Shards of a task, beyond so many tasks.
SHARDS, FEW_TASKS = 256, 512
SCHEMA = "doc_id bigint, part int, bin string, start bigint, length bigint"


class Bins:
    """Open bins of one shard."""

    def __init__(self, capacity: int):
        self.capacity, self.order, self.sources, self.clusters, self.used = capacity, [], [], [], []
        self.bit: dict = {}

    def _mask(self, key) -> int:
        return 0 if key is None else 1 << self.bit.setdefault(key, len(self.bit))

    def place(self, length: int, source, cluster) -> tuple[int, int]:
        """(bin, start) of a text of at most `capacity`."""
        s, c = self._mask(("s", source) if source is not None else None), self._mask(
            ("c", cluster) if cluster is not None else None
        )
        at = bisect_left(self.order, (length, -1))
        while at < len(self.order):
            residual, b = self.order[at]
            if not self.sources[b] & s and not self.clusters[b] & c:
                del self.order[at]
                break
            at += 1
        else:
            b, residual = len(self.used), self.capacity
            self.used.append(0)
            self.sources.append(0)
            self.clusters.append(0)
        start = self.used[b]
        self.used[b] += length
        self.sources[b] |= s
        self.clusters[b] |= c
        insort(self.order, (residual - length, b))
        return b, start


def pack(
    docs: DataFrame, length: Column, capacity: int, doc_id: str = "doc_id", source: str | None = "source",
    cluster: Column | None = None, shard_rows: int = 1024, block_rows: int = 8192
) -> DataFrame:
    """One row for each part of each document: doc_id, part (0 for the first), bin, start
    in the bin, length.  `cluster`: documents that must not meet; equal texts by default."""
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    key = F.when(quoted("text").isNotNull(), F.xxhash64(quoted("text"))) if cluster is None else cluster
    rows = docs.select(
        quoted(doc_id).cast("long").alias("doc_id"), F.coalesce(length, F.lit(0)).cast("long").alias("length"),
        (F.lit(None).cast("string") if source is None else quoted(source).cast("string")).alias("source"),
        key.alias("cluster")
    )
    n = max(1, -(-docs.count() // shard_rows))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "length"), F.lit(n)).cast("int"))
    # a task packs many shards one after the other, so tasks stay few however many rows there are
    tasks = min(n, max(FEW_TASKS, -(-n // SHARDS)))
    rows = rows.withColumn("rest", F.col("length") % capacity).repartition(tasks, "shard").sortWithinPartitions(
        "shard", F.desc("rest"), "doc_id", "cluster", "source", "length"
    )

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, block, count, bins = None, 0, 0, None
        for batch in batches:
            out = []
            for d, size, src, cl, sh, rest in zip(
                batch.doc_id.astype(object).where(batch.doc_id.notna(), None), batch.length, batch.source,
                batch.cluster, batch.shard, batch.rest, strict=True
            ):
                if sh != shard or count >= block_rows:
                    block = 0 if sh != shard else block + 1
                    shard, count, bins = sh, 0, Bins(capacity)
                    full = 0
                count += 1
                src = None if src is None or src != src else src
                cl = None if cl is None or cl != cl else cl
                parts = size // capacity
                for p in range(parts):
                    out.append((d, p, f"{sh}-{block}-f{full}", 0, capacity))
                    full += 1
                if rest or not parts:
                    b, start = bins.place(int(rest), src, cl)
                    out.append((d, parts, f"{sh}-{block}-{b}", start, int(rest)))
            frame = pd.DataFrame(out, columns=["doc_id", "part", "bin", "start", "length"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return rows.mapInPandas(packed, SCHEMA)
