"""Interpolated modified Kneser-Ney language model, counted in Spark.

Order 3, or 2: p(w | h) = max(c(h w) - D(c(h w)), 0) / c(h .) + g(h) * p(w | h'), where h'
is h without its first word.  The highest order counts occurrences; a lower one counts
distinct left neighbours, except that n-grams at a text's start, which have none, keep
their occurrences.  p(w) is interpolated with 1 / (V + 1); the discounts D1, D2, D3+ of
each order come from its counts of counts (Chen and Goodman 1999).

Tokens are words `[^\x20\x09-\x0D]+` with A-Z lowered, then one end.  The model is a
folder of sorted hash arrays: word hashes in files by hash range (a word's id is its place,
counted over all files), bigram keys id(v) * 2**32 + id(w) in shards by key range (a
bigram's place is counted likewise), and trigrams (place(u v), id(w)) in shards by range, as
keys told from the first place of the shard, with their upper halves once for each run.
Range bounds come from the counts, so a frequent context is spread over several shards; a
shard has `SHARD_TOKENS` tokens, more where there would be over `MAX_SHARDS` shards.  Tasks write the arrays to the shared
folder; scoring tasks map into memory the files that they look into, `MAPPED` at most at a
time (from a folder that is not mounted they fetch them first).  Many texts are looked up at
once, more of them the more files there are, so that a file is searched once for many words.  Neither words nor counts go
through the driver, which sees a few numbers a file.  One order is counted after the other,
and its shuffle dropped.

Defined cases: null and empty texts are the end token alone; very long texts are counted
and scored whole; unknown words get the share of 1 / (V + 1); repeated rows count once each;
without training texts every token has probability 1; an empty table to score gives no rows;
columns named like the added ones keep their names, the added ones get underscores; more
than 2**32 - 2 words raise an error.
"""

from __future__ import annotations

import io
import json
import shutil
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hashing import word_hashes
from .shared import fresh, quoted, shared_folder, small_batches, written

#: The hash of the end token; no word has it (words hash through `mix`, a collision is as rare as any).
END = np.uint64(0x0E0D0E0D0E0D0E0D)
#: Bigram tokens of a shard and words of a range, about.
SHARD_TOKENS, RANGE_WORDS = 2_000_000, 1 << 18
#: Shards up to which their size stays; with 10**13 tokens a shard has 40 million.
MAX_SHARDS = 1 << 18
#: Tokens that are looked up at once, about, as a file is searched once for all of them: so many,
#: or so many a file of n-grams if that is more, but no more than the last.
TOGETHER, A_FILE, MOST = 1 << 19, 300, 1 << 21
#: Bigrams that a task collects before it hands them on.
HELD = 1 << 22
#: Files that hold the words: with 2**32 words, the most there can be, 2**20 words a file.
WORD_FILES = 4096
#: Files that a worker maps at a time.
MAPPED = 512


class Folder:
    """A folder that driver and executors share, through any file system that Arrow knows."""

    def __init__(self, uri: str):
        self.uri = uri
        self.fs, self.path = FileSystem.from_uri(
            uri if "://" in uri or not uri.startswith("file:") else uri.replace("file:", "file://", 1)
        )
        self.mounted = uri.startswith(("file:", "/"))

    def write(self, name: str, data) -> None:
        """Whole or not at all; a task that runs again writes the same."""
        self.fs.create_dir(self.path, recursive=True)
        tmp = f"{self.path}/.{name}.{uuid.uuid4().hex}.tmp"
        with self.fs.open_output_stream(tmp) as f:
            f.write(data)
        self.fs.move(tmp, f"{self.path}/{name}")

    def read(self, name: str) -> bytes:
        with self.fs.open_input_stream(f"{self.path}/{name}") as f:
            return f.read()

    def save(self, name: str, array: np.ndarray) -> None:
        held = io.BytesIO()
        np.save(held, array)
        self.write(f"{name}.npy", held.getbuffer())

    def load(self, name: str) -> np.ndarray:
        """The array in a memory map.  What is not mounted is fetched to the worker's own disk,
        as a copy that lives no longer than the map."""
        if self.mounted:
            return np.load(f"{self.path}/{name}.npy", mmap_mode="r")
        with tempfile.NamedTemporaryFile(suffix=".npy") as f:
            with self.fs.open_input_stream(f"{self.path}/{name}.npy") as source:
                shutil.copyfileobj(source, f)
            f.flush()
            return np.load(f.name, mmap_mode="r")


@lru_cache(MAPPED)
def _mapped(uri: str, name: str) -> np.ndarray:
    return Folder(uri).load(name).view(np.ndarray)


class Shards:
    """The files name-0, name-1, ... of a model, mapped when they are looked into; `have`
    lists those that there are."""

    def __init__(self, uri: str, name: str, have):
        self.uri, self.name, self.have = uri, name, frozenset(have)

    def __contains__(self, s: int) -> bool:
        return s in self.have

    def __getitem__(self, s: int) -> np.ndarray:
        return _mapped(self.uri, f"{self.name}-{s}")

    def find(self, s: int, keys: np.ndarray) -> np.ndarray:
        """Places of sorted keys in file s, -1 where it has none."""
        return _find(self[s], keys)


class SplitShards(Shards):
    """Files of 64-bit keys in two parts: lower halves, and (upper half, begin) of each run, then an end."""

    def find(self, s: int, keys: np.ndarray) -> np.ndarray:
        lows, (highs, begins) = self[s], _mapped(self.uri, f"{self.name}heads-{s}")
        run = _find(highs, keys >> np.uint64(32))
        some = np.flatnonzero(run >= 0)
        out = np.full(len(keys), -1, np.int64)
        if not len(some):
            return out
        run, low = run[some], (keys[some] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        lo, end = begins[run].astype(np.int64), begins[run + 1].astype(np.int64)
        # a binary search of all keys at once, each inside its run
        at, hi = lo, end
        while (at < hi).any():
            mid = (at + hi) >> 1
            less = (lows[np.minimum(mid, len(lows) - 1)] < low) & (at < hi)
            at, hi = np.where(less, mid + 1, at), np.where(less, hi, mid)
        out[some] = np.where((at < end) & (lows[np.minimum(at, len(lows) - 1)] == low), at, -1)
        return out


def _save_split(store: Folder, name: str, s: int, keys: np.ndarray) -> None:
    high = keys >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], high[1:] != high[:-1])))
    store.save(f"{name}-{s}", (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32))
    # the end has an upper half that no key has
    heads = np.stack([np.append(high[first], np.uint64(2**64 - 1)), np.append(first, len(keys)).astype(np.uint64)])
    store.save(f"{name}heads-{s}", heads)


def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys in a sorted array, -1 where it has none."""
    if not len(table):
        return np.full(len(keys), -1, np.int64)
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return np.where(table[at] == keys, at, -1)


def _sequences(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(token hashes with ends, index of each text's end) of consecutive texts."""
    for lo, hi, hashes, off in word_hashes(texts):
        n = hi - lo
        sizes = np.diff(off) + 1
        ends = np.cumsum(sizes) - 1
        out = np.empty(len(hashes) + n, np.uint64)
        mask = np.ones(len(out), bool)
        mask[ends] = False
        out[mask], out[ends] = hashes, END
        yield out, ends


def _together(arrays: Iterator[pa.Array], least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """`_sequences` of all arrays in their order, joined until they have `least` tokens."""
    held, size = [], 0
    for texts in arrays:
        for tokens, ends in _sequences(texts):
            held.append((tokens, ends + size))
            size += len(tokens)
            if size >= least:
                joined = [np.concatenate(x) for x in zip(*held, strict=True)]
                held, size = [], 0
                yield tuple(joined)
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _many(model: dict) -> int:
    """Tokens that are looked up at once."""
    return min(max(TOGETHER, A_FILE * (len(model["starts"]) + len(model["ranges3"].first))), MOST)


def _counted(values: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and their counts."""
    if counts is None:
        values = np.sort(values)
        first = np.flatnonzero(
            np.concatenate(([True], values[1:] != values[:-1]))
        ) if len(values) else np.zeros(0, np.int64)
        return values[first], np.diff(np.append(first, len(values)))
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(
        np.concatenate(([True], values[1:] != values[:-1]))
    ) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


def _packed(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted values as differences, and counts, compressed."""
    steps = np.diff(values, prepend=values[:1])
    wide = np.flatnonzero(steps >> np.uint64(32))
    many = np.flatnonzero(counts != 1)
    head = np.array([len(values), len(wide), len(many), int(values[0]) if len(values) else 0], np.uint64)
    planes = np.ascontiguousarray(steps.astype(np.uint32).view(np.uint8).reshape(-1, 4).T)  # bytes of a place together
    body = [head, planes, wide.astype(np.uint32), steps[wide], many.astype(np.uint32), counts[many].astype(np.uint64)]
    return zlib.compress(b"".join(x.tobytes() for x in body), 1)


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(blob)
    n, n_wide, n_many, start = (int(x) for x in np.frombuffer(raw, np.uint64, 4))
    at = 32
    parts = []
    planes = np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n)
    parts.append(np.ascontiguousarray(planes.T).view(np.uint32).reshape(n))
    at += 4 * n
    for kind, size in ((np.uint32, n_wide), (np.uint64, n_wide), (np.uint32, n_many), (np.uint64, n_many)):
        parts.append(np.frombuffer(raw, kind, size, at))
        at += size * np.dtype(kind).itemsize
    steps = parts[0].astype(np.uint64)
    steps[parts[1]] = parts[2]
    values = np.cumsum(steps, dtype=np.uint64) + np.uint64(start)
    counts = np.ones(n, np.int64)
    counts[parts[3]] = parts[4].astype(np.int64)
    return values, counts


def _cut(values: np.ndarray, counts: np.ndarray, bounds: np.ndarray, column: str) -> pa.RecordBatch:
    """Rows (column, blob): the values of each range; `bounds` are the first values of ranges 1, 2, ..."""
    at = np.concatenate(([0], np.searchsorted(values, bounds), [len(values)]))
    some = [i for i in range(len(at) - 1) if at[i] < at[i + 1]]
    return pa.RecordBatch.from_pydict(
        {
            column: pa.array(some, pa.int32()),
            "blob": pa.array([_packed(values[at[i] : at[i + 1]], counts[at[i] : at[i + 1]]) for i in some], pa.binary())
        }
    )


def _merged(batches: Iterator[pd.DataFrame], column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The sum of the blobs of each range, from batches sorted by range."""
    key, held = None, []

    def done() -> tuple[int, np.ndarray, np.ndarray]:
        parts = [_unpacked(b) for b in held]
        return (key, *_counted(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])))

    for batch in batches:
        for k, blob in zip(batch[column], batch.blob, strict=True):
            if k != key and held:
                yield done()
                held = []
            key = k
            held.append(blob)
    if held:
        yield done()


def _deal(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.repartition(max(1, n), column).sortWithinPartitions(column)


def _uniform_bounds(n: int) -> np.ndarray:
    return (np.arange(1, n, dtype=np.float64) * (2.0**64 / n)).astype(np.uint64) if n > 1 else np.zeros(0, np.uint64)


@lru_cache(4)
def _opened(uri: str, stage: str = "whole") -> dict:
    """The model; `stage` says how far it is that is still in the making ("words", "bigrams"),
    so that a worker does not keep it for the finished one."""
    meta = json.loads(Folder(uri).read("model.json"))
    have_of = lambda have: _mapped(uri, have).tolist() if have in meta["saved"] else meta.get(have, ())
    of = lambda name, have, kind=Shards: kind(uri, name, have_of(have))
    saved = lambda name, kind: _mapped(uri, name) if name in meta["saved"] else np.zeros(0, kind)
    return meta | {
        "words": of("words", "files"), "counts": of("counts", "files"), "word_bounds": _uniform_bounds(meta["n_files"]), "word_starts": np.array(
            meta["word_starts"], np.int64
        ),
        "bounds": saved("bounds", np.uint64), "starts": saved("starts", np.int64), "keys": of("keys", "shards"), "values": of("values", "shards"),
        "id_starts": np.append(
            np.arange(0, meta["vocabulary"] + 1, RANGE_WORDS), meta["vocabulary"] + 1
        ), "left": of("left", "lefts"), "after": of("after", "afters"),
        "ranges3": TrigramRanges(saved("bounds3", np.int64).reshape(-1, 2), meta["vocabulary"]),
        "keys3": of("keys3", "shards3", SplitShards), "values3": of("values3", "shards3"),
        "distinct": of("distinct", "shards"), "rest2": of("rest2", "shards"),
    }


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and each value's rank in them."""
    some, rank = np.unique(values, return_inverse=True)
    return some, rank.astype(np.int32 if len(some) < 2**31 - 1 else np.int64)


def _ranked(tokens: np.ndarray, ends: np.ndarray, model: dict) -> tuple[np.ndarray, ...]:
    """(ids of the distinct words, rank of each token's word in them, rank of the word before it):
    ids are in order, -1 if unknown; the rank before a text's first token is the number of words,
    as V is the id there."""
    words, rank = _distinct(tokens)
    ids = _sorted_places(words, model["word_bounds"], model["words"], model["word_starts"])
    left = np.empty_like(rank)
    left[1:] = rank[:-1]
    left[0] = left[ends[:-1] + 1] = len(words)
    return ids, rank, left


def _bigrams(ids: np.ndarray, rank: np.ndarray, left: np.ndarray, model: dict) -> tuple[np.ndarray, ...]:
    """(places of the distinct bigrams, -1 if unknown, ranks of their words, rank of each token's
    bigram in them)."""
    bits = len(ids).bit_length()
    pairs, which = _distinct((left.astype(np.int64) << bits) | rank)
    before, word = pairs >> bits, pairs & ((1 << bits) - 1)
    u, w = np.append(ids, model["vocabulary"])[before], ids[word]
    known = np.flatnonzero((u >= 0) & (w >= 0))
    keys = (u[known].astype(np.uint64) << np.uint64(32)) | w[known].astype(np.uint64)
    places = np.full(len(pairs), -1, np.int64)
    places[known] = _sorted_places(keys, model["bounds"], model["keys"], model["starts"])
    return places, before, word, which


def _contexts(places: np.ndarray, which: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The place of the bigram before each token; -1 for a text's first token or if unknown."""
    before = np.empty(len(which), np.int64)
    before[1:] = places[which[:-1]]
    before[0] = before[ends[:-1] + 1] = -1
    return before


class TrigramRanges:
    """Ranges of trigrams (place of the bigram, word).  `bounds` are the first trigrams of the
    ranges, the first one (0, 0).  A key counts from the first place of its range, so it has 64
    bits however many bigrams there are: a range has fewer than 2**32 of them."""

    def __init__(self, bounds: np.ndarray, n_words: int):
        self.first, self.base = bounds[:, 0], np.uint64(n_words + 1)
        self.places, rank = np.unique(self.first, return_inverse=True)
        self.order = rank.astype(np.uint64) * self.base + bounds[:, 1].astype(np.uint64)

    def keys(self, places: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(range, key) of each trigram."""
        rank = np.searchsorted(self.places, places, "right") - 1
        words = words.astype(np.uint64)
        inside = np.where(self.places[rank] == places, words, self.base - np.uint64(1))
        s = np.searchsorted(self.order, rank.astype(np.uint64) * self.base + inside, "right") - 1
        return s, (places - self.first[s]).astype(np.uint64) * self.base + words

    def trigrams(self, s: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, words) of keys of range s."""
        return (keys // self.base).astype(np.int64) + self.first[s], keys % self.base

    def cut(self, places: np.ndarray, words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(range, places in the arrays, keys) for each range that has some."""
        s, keys = self.keys(places, words)
        order = np.argsort(s, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(s[order])) + 1):
            if len(part):
                yield int(s[part[0]]), part, keys[part]


def _discounts(n: list[int]) -> list[float]:
    """D1, D2, D3+ from the counts of counts n1 to n4; 0.5, 1, 1.5 where they are too few."""
    n1, n2, n3, n4 = (float(x) for x in n)
    if not n1 or not n2 or not n3:
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(x, 0.01), k - 0.01 if k < 3 else 2.99) for k, x in enumerate(d, 1)]


def _by_count(d: list[float], c: np.ndarray) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(c, 3).astype(np.int64)]


def train(docs: DataFrame, text: str = "text", folder: str | None = None, order: int = 3) -> str:
    """Counts all rows of `docs` and writes the model of order 2 or 3; gives back its folder."""
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    with _shuffles_dropped(docs.sparkSession):
        return _train(docs, text, folder, order)


def _train(docs: DataFrame, text: str, folder: str | None, order: int) -> str:
    spark = docs.sparkSession
    small_batches(spark)
    uri = folder or f"{shared_folder(spark)}/kneser-ney-{uuid.uuid4().hex}"
    store = Folder(uri)
    texts = docs.select(quoted(text).alias("text"))
    blob = "int, blob binary"

    # words: hash ranges of equal width, merged apart
    n_ranges = max(1, min(WORD_FILES, texts.rdd.getNumPartitions()))
    shard_tokens = SHARD_TOKENS

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for tokens, _ in _together((batch.column(0) for batch in batches), TOGETHER):
            held.append(_counted(tokens))
            size += len(held[-1][0])
            if size > HELD:
                held = [_counted(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield _cut(*held[0], _uniform_bounds(n_ranges), "r")
                    held, size = [], 0
        if held:
            yield _cut(
                *_counted(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])),
                _uniform_bounds(n_ranges), "r"
            )

    def save_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for r, hashes, counts in _merged(batches, "r"):
            store.save(f"words-{r}", hashes)
            store.save(f"counts-{r}", counts.astype(np.uint32 if counts.max() < 2**32 else np.uint64))
            yield pd.DataFrame(
                {
                    "r": [r], "v": [len(hashes)], "n": [int(counts.sum())],
                    "cuts": [json.dumps(_cuts(counts, 1 << 32, shard_tokens))]
                }
            )

    files = sorted(
        (x.r, x.v, x.n, x.cuts) for x in _deal(
            texts.mapInArrow(words_of, f"r {blob}"), "r", n_ranges
        ).mapInPandas(save_words, "r int, v long, n long, cuts string").collect()
    )
    n_words, n_tokens = sum(f[1] for f in files), sum(f[2] for f in files)
    if n_words >= 2**32 - 1:
        raise ValueError("a model holds at most 2**32 - 2 words")
    of_file = {f[0]: f[1] for f in files}
    word_starts = np.concatenate(([0], np.cumsum([of_file.get(r, 0) for r in range(n_ranges)]))).astype(int)
    # bigrams of about `shard_tokens` tokens, if words follow each other by chance; inside a
    # frequent left word the bound falls on a right word
    bounds = np.array(
        sorted(
            {
                (int(word_starts[r]) + i << 32) | (w * n_words >> 32) for r, _, _, cuts in files
                for i, w in json.loads(cuts)
            } - {0}
        ),
        np.uint64
    )
    wider = -(-(len(bounds) + 1) // MAX_SHARDS)
    bounds, shard_tokens = bounds[wider - 1 :: wider], shard_tokens * wider
    meta = {
        "tokens": n_tokens, "vocabulary": n_words, "files": sorted(of_file), "n_files": n_ranges,
        "word_starts": word_starts.tolist(), "uri": uri, "order": order, "saved": []
    }
    n_shards = len(bounds) + 1
    _save_meta(store, meta, bounds=bounds)
    if not n_words:
        _save_meta(
            store,
            meta | {
                "d3": [0.5, 1, 1.5], "d2": [0.5, 1, 1.5], "d1": [0.5, 1, 1.5], "types": 0, "rest": 1.0
            }
        )
        return uri
    word_ranges = -(-(n_words + 1) // RANGE_WORDS)

    def bigrams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _opened(uri, "words")
        held, size = [], 0
        for tokens, ends in _together((batch.column(0) for batch in batches), TOGETHER):
            ids, rank, left = _ranked(tokens, ends, model)
            ids = np.append(ids, n_words).astype(np.uint64)
            held.append((ids[left] << np.uint64(32)) | ids[rank])
            size += len(held[-1])
            if size + TOGETHER > HELD:
                yield _cut(*_counted(np.concatenate(held)), bounds, "s")
                held, size = [], 0
        if held:
            yield _cut(*_counted(np.concatenate(held)), bounds, "s")

    def by_word(s: int, kind: str, ids: np.ndarray, values: np.ndarray) -> Iterator[tuple]:
        at = np.searchsorted(ids, np.arange(word_ranges + 1) * RANGE_WORDS)
        for r in range(word_ranges):
            if at[r] < at[r + 1]:
                part = values[at[r] : at[r + 1]]
                yield s, kind, r, zlib.compress(
                    np.int64(at[r + 1] - at[r]).tobytes() + (
                        ids[at[r] : at[r + 1]] - r * RANGE_WORDS
                    ).astype(np.uint32).tobytes() + part.astype(np.int64).tobytes(),
                    1
                )

    def counted_bigrams(s: int, keys: np.ndarray, counts: np.ndarray) -> list[tuple]:
        """What bigram counts say of their left words, and their counts of counts."""
        v = (keys >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))
        sums = np.stack(
            [np.add.reduceat(x.astype(np.int64), first) for x in (counts, counts == 1, counts == 2, counts > 2)], axis=1
        )
        return [
            *by_word(s, "after", v[first], sums),
            (s, "counts", -1, json.dumps([int((counts == k).sum()) for k in (1, 2, 3, 4)]).encode())
        ]

    def save_bigrams(batches: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
        for s, keys, counts in _merged(batches, "s"):
            store.save(f"keys-{s}", keys)
            store.save(f"values-{s}", counts.astype(np.uint8) if counts.max() < 256 else counts.astype(np.uint32))
            rows = [*by_word(s, "left", *_counted((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)))]
            rows.append((s, "size", -1, json.dumps([len(keys), _cuts(counts, n_words, shard_tokens)]).encode()))
            if order == 2:
                rows += counted_bigrams(s, keys, counts)
            yield pd.DataFrame(rows, columns=["s", "kind", "r", "blob"])

    stats = written(
        _deal(
            texts.mapInArrow(bigrams_of, f"s {blob}"), "s", n_shards
        ).mapInPandas(save_bigrams, "s int, kind string, r int, blob binary"),
        "bigrams"
    )
    sizes = {
        x.s: json.loads(bytes(x.blob)) for x in stats.filter("kind = 'size'").select("s", "blob").toLocalIterator()
    }
    starts = np.concatenate(([0], np.cumsum([sizes.get(s, [0])[0] for s in range(len(bounds) + 1)])))
    _save_meta(store, meta, shards=np.array(sorted(sizes)), starts=starts)
    if order > 2:
        cuts = {(int(starts[s]) + i, w) for s in sizes for i, w in [(0, 0), *sizes[s][1]]}
        _save_meta(store, meta, bounds3=np.array(sorted(cuts | {(0, 0)}), np.int64))
        more = _count_trigrams(spark, texts, store, meta, n_shards, len(cuts | {(0, 0)}), sorted(sizes), counted_bigrams)
        stats = stats.unionByName(more.pop("stats"))
        _save_meta(store, meta, shards3=np.array(more.pop("shards3")))
        meta |= more

    def save_stats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, total = None, None
        out = []

        def done() -> None:
            store.save(f"{key[0]}-{key[1]}", total.astype(np.uint32) if total.max(initial=0) < 2**32 else total)
            small = [int((total == k).sum()) for k in (1, 2, 3, 4)] if key[0] == "left" else [0] * 4
            out.append(
                (
                    *key, *small, int(total.sum()) if key[0] == "left" else 0,
                    int((total > 2).sum()) if key[0] == "left" else 0
                )
            )

        for batch in batches:
            for kind, r, blob_ in zip(batch.kind, batch.r, batch.blob, strict=True):
                if (kind, r) != key:
                    if key is not None:
                        done()
                    key = (kind, r)
                    total = np.zeros(
                        (
                            min(RANGE_WORDS, n_words + 1 - r * RANGE_WORDS), 4
                        ) if kind == "after" else min(RANGE_WORDS, n_words - r * RANGE_WORDS),
                        np.int64
                    )
                raw = zlib.decompress(blob_)
                n = int(np.frombuffer(raw, np.int64, 1)[0])
                ids = np.frombuffer(raw, np.uint32, n, 8)
                total[ids] += np.frombuffer(raw, np.int64, -1, 8 + 4 * n).reshape(n, *total.shape[1:])
        if key is not None:
            done()
        yield pd.DataFrame(out, columns=["kind", "r", "n1", "n2", "n3", "n4", "total", "many"])

    made = stats.filter("kind IN ('after', 'left')").repartition(
        2 * word_ranges, "kind", "r"
    ).sortWithinPartitions("kind", "r").mapInPandas(
        save_stats, "kind string, r int, n1 long, n2 long, n3 long, n4 long, total long, many long"
    ).collect()
    lefts = [x for x in made if x.kind == "left"]
    meta |= {"lefts": sorted(x.r for x in lefts), "afters": sorted(x.r for x in made if x.kind == "after")}
    small = [json.loads(bytes(x.blob)) for x in stats.filter("kind = 'counts'").select("blob").toLocalIterator()]
    d1 = _discounts([sum(getattr(x, f"n{k}") for x in lefts) for k in (1, 2, 3, 4)])
    types = sum(x.total for x in lefts)
    rest = (
        d1[0] * sum(x.n1 for x in lefts) + d1[1] * sum(x.n2 for x in lefts) + d1[2] * sum(x.many for x in lefts)
    ) / types
    _save_meta(
        store,
        meta | {"d2": _discounts([sum(x[k] for x in small) for k in range(4)]), "d1": d1, "types": types, "rest": rest}
    )
    return uri


def _cuts(counts: np.ndarray, n_words: int, shard_tokens: int) -> list[tuple[int, int]]:
    """Where to cut the n-grams that follow a file's words or bigrams into shards of `shard_tokens`:
    (place in the file, first right word); ids are in order of hash, so they share alike."""
    total = np.cumsum(counts)
    want = np.arange(1, int(total[-1]) // shard_tokens + 1) * shard_tokens
    i = np.searchsorted(total, want, "right").clip(0, len(counts) - 1)
    share = (want - (total[i] - counts[i])) / counts[i]
    return [(int(x), int(y)) for x, y in zip(i, share * n_words, strict=True)]


@contextmanager
def _shuffles_dropped(spark) -> Iterator[None]:
    """Lets Spark delete the shuffle files of a job as soon as it ends; every frame inside runs once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _count_trigrams(
    spark, texts: DataFrame, store: Folder, meta: dict, n_shards: int, n_ranges: int, shards: list[int], counted_bigrams
) -> dict:
    """Counts trigrams over a model of words and bigrams, and the distinct left neighbours of
    bigrams; gives back what the model lacked."""
    uri, n_words = meta["uri"], meta["vocabulary"]

    def cut(held: list[tuple[np.ndarray, np.ndarray]], ranges: TrigramRanges) -> pa.RecordBatch:
        places, words = (np.concatenate(x) for x in zip(*held, strict=True))
        some = [(s, _packed(*_counted(keys))) for s, _, keys in ranges.cut(places, words)]
        return pa.RecordBatch.from_pydict(
            {"s": pa.array([s for s, _ in some], pa.int32()), "blob": pa.array([b for _, b in some], pa.binary())}
        )

    def trigrams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _opened(uri, "bigrams")
        held, size = [], 0
        many = _many(model)
        for tokens, ends in _together((batch.column(0) for batch in batches), many):
            ids, rank, left = _ranked(tokens, ends, model)
            places, _, _, which = _bigrams(ids, rank, left, model)
            contexts = _contexts(places, which, ends)
            held.append((contexts[contexts >= 0], ids[rank[contexts >= 0]]))
            size += len(held[-1][0])
            if size + many > HELD:
                yield cut(held, model["ranges3"])
                held, size = [], 0
        if held:
            yield cut(held, model["ranges3"])

    def save_trigrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _opened(uri, "bigrams")
        starts = model["starts"]
        for s, keys, counts in _merged(batches, "s"):
            _save_split(store, "keys3", s, keys)
            store.save(f"values3-{s}", counts.astype(np.uint8) if counts.max() < 256 else counts.astype(np.uint32))
            context, w = model["ranges3"].trigrams(s, keys)
            first = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
            seen = context[first]
            (raw,) = _at(seen, starts, model["values"])
            rows = [(s, "small", json.dumps([int((counts == k).sum()) for k in (1, 2, 3, 4)]).encode(), -1)]

            def parts(kind: str, places: np.ndarray, values: np.ndarray) -> None:
                at = np.searchsorted(places, starts)
                for k in np.flatnonzero(np.diff(at)).tolist():
                    rows.append(
                        (
                            s, kind,
                            _packed(
                                (places[at[k] : at[k + 1]] - starts[k]).astype(np.uint64), values[at[k] : at[k + 1]]
                            ),
                            k
                        )
                    )

            # a bigram seen once has one trigram of count 1, which need not be told
            for kind, is_kind in (("n1", counts == 1), ("n2", counts == 2), ("n3", counts > 2)):
                n = np.add.reduceat(is_kind.astype(np.int64), first)
                parts(kind, seen[(n > 0) & (raw > 1)], n[(n > 0) & (raw > 1)])
            (before,) = _at(seen, starts, model["keys"], kind=np.uint64)
            of = np.repeat(before & np.uint64(0xFFFFFFFF), np.diff(np.append(first, len(keys))))
            suffix, n = _counted((of << np.uint64(32)) | w)
            parts("distinct", _places(suffix, model["bounds"], model["keys"], starts), n)
            yield pd.DataFrame(rows, columns=["s", "kind", "blob", "to"])

    made = written(
        _deal(
            texts.mapInArrow(trigrams_of, "s int, blob binary"), "s", n_ranges
        ).mapInPandas(save_trigrams, "s int, kind string, blob binary, to int"),
        "trigrams"
    )
    small = {
        x.s: json.loads(bytes(x.blob)) for x in made.filter("kind = 'small'").select("s", "blob").toLocalIterator()
    }
    d3 = _discounts([sum(x[k] for x in small.values()) for k in range(4)])

    def save_bigrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _opened(uri, "bigrams")
        end = _places(np.array([END]), model["word_bounds"], model["words"], model["word_starts"])[0]
        key, sums = None, {}

        def done() -> pd.DataFrame:
            keys, raw = model["keys"][key], model["values"][key]
            begins, once = (keys >> np.uint64(32)) == n_words, (raw == 1) & (
                (keys & np.uint64(0xFFFFFFFF)) != np.uint64(end)
            )
            counts = np.where(begins, raw.astype(np.int64), sums["distinct"])
            store.save(f"distinct-{key}", counts.astype(np.uint8) if counts.max() < 256 else counts.astype(np.uint32))
            store.save(
                f"rest2-{key}",
                (d3[0] * (sums["n1"] + once) + d3[1] * sums["n2"] + d3[2] * sums["n3"]).astype(np.float32)
            )
            return pd.DataFrame(counted_bigrams(key, keys, counts), columns=["s", "kind", "r", "blob"])

        for batch in batches:
            for to, kind, blob in zip(batch.to, batch.kind, batch.blob, strict=True):
                if to != key:
                    if key is not None:
                        yield done()
                    key, sums = to, {
                        k: np.zeros(len(model["keys"][to]), np.int64) for k in ("n1", "n2", "n3", "distinct")
                    }
                if blob is not None:
                    places, values = _unpacked(blob)
                    sums[kind][places.astype(np.int64)] += values
        if key is not None:
            yield done()

    every = spark.createDataFrame([(s, "every", None) for s in shards], "to int, kind string, blob binary")
    rows = made.filter("kind <> 'small'").select("to", "kind", "blob").unionByName(every)
    stats = written(
        _deal(rows, "to", n_shards).mapInPandas(save_bigrams, "s int, kind string, r int, blob binary"), "bigrams"
    )
    return {"stats": stats, "d3": d3, "shards3": sorted(small)}


def _save_meta(store: Folder, meta: dict, **arrays: np.ndarray) -> None:
    """Writes model.json; `arrays`, which grow with the corpus, are files of their own."""
    for name, array in arrays.items():
        if len(array):
            store.save(name, array)
            meta["saved"] = [*meta["saved"], name]
    store.write("model.json", json.dumps(meta).encode())
    _opened.cache_clear()


def _scores(tokens: np.ndarray, ends: np.ndarray, model: dict) -> tuple[np.ndarray, ...]:
    """Of each text: tokens, known tokens, base score, model score.  What a distinct word or
    bigram has is looked up and computed once."""
    ids, rank, left = _ranked(tokens, ends, model)
    v_words, n = model["vocabulary"], model["tokens"]
    (c,) = _sorted_at(ids, model["word_starts"], model["counts"])
    base = np.log10((c + 1) / (n + v_words + 1))[rank]
    types = max(model["types"], 1)
    (lefts,) = _sorted_at(ids, model["id_starts"], model["left"])
    p = np.maximum(lefts - _by_count(model["d1"], lefts), 0) / types + model["rest"] / (v_words + 1)
    if v_words:
        (after,) = _sorted_at(np.append(ids, v_words), model["id_starts"], model["after"], width=4)
        places, before, word, which = _bigrams(ids, rank, left, model)
        if model["order"] == 2:
            (both,) = _sorted_at(places, model["starts"], model["values"])
        else:
            raw, both, rest2 = _sorted_at(places, model["starts"], model["values"], model["distinct"], model["rest2"])
        rest = after[:, 1:] @ np.array(model["d2"])
        p = _interpolated(both, after[before, 0], rest[before], model["d2"], p[word])[which]
        if model["order"] > 2:
            # trigrams as ranks of the bigram before and of the word, which are in the order of their keys
            some = np.flatnonzero(_contexts(places, which, ends) >= 0)
            bits = len(ids).bit_length()
            triples, back = _distinct((which[some - 1].astype(np.int64) << bits) | rank[some])
            context, w = triples >> bits, ids[triples & ((1 << bits) - 1)]
            found = np.zeros(len(triples), np.int64)
            told = np.flatnonzero(w >= 0)
            for s, at, keys in model["ranges3"].cut(places[context[told]], w[told]):
                if s in model["keys3"]:
                    i = model["keys3"].find(s, keys)
                    found[told[at]] = np.where(i >= 0, model["values3"][s][i], 0)
            lower = np.empty(len(triples))
            lower[back] = p[some]  # a trigram ends with one bigram
            p[some] = _interpolated(found, raw[context], rest2[context], model["d3"], lower)[back]
    else:
        p = p[rank]
    begin = np.concatenate(([0], ends[:-1] + 1))
    sums = lambda x: np.add.reduceat(x, begin)
    known = (ids >= 0)[rank]
    return np.diff(np.append(begin, len(rank))), sums(known.astype(np.int64)), sums(base), sums(np.log10(p))


def _scored(arrays: Iterator[pa.Array], model: dict) -> Iterator[tuple[np.ndarray, ...]]:
    """`_scores` of the texts of all arrays in their order, of many texts at once."""
    for tokens, ends in _together(arrays, _many(model)):
        yield _scores(tokens, ends, model)


def _interpolated(c: np.ndarray, total: np.ndarray, rest: np.ndarray, d: list[float], p: np.ndarray) -> np.ndarray:
    """Discounted shares of `total`, and the rest by the lower order's chances `p`; these alone for
    contexts that were never seen."""
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(total > 0, (np.maximum(c - _by_count(d, c), 0) + rest * p) / total, p)


def _places(
    keys: np.ndarray, bounds: np.ndarray, tables: Shards, starts: np.ndarray
) -> np.ndarray:
    """Places of keys over all shards, -1 if unknown.  Keys are looked up in order, so pages are read once."""
    some, back = np.unique(keys, return_inverse=True)
    return _sorted_places(some, bounds, tables, starts)[back]


def _sorted_places(some: np.ndarray, bounds: np.ndarray, tables: Shards, starts: np.ndarray) -> np.ndarray:
    """`_places` of distinct keys in order."""
    out = np.full(len(some), -1, np.int64)
    at = np.concatenate(([0], np.searchsorted(some, bounds), [len(some)]))
    for s in np.flatnonzero(np.diff(at)).tolist():
        if s in tables:
            i = tables.find(s, some[at[s] : at[s + 1]])
            out[at[s] : at[s + 1]] = np.where(i >= 0, starts[s] + i, -1)
    return out


def _at(places: np.ndarray, starts: np.ndarray, *arrays: Shards, kind=np.float64, width: int = 0) -> list[np.ndarray]:
    """What the shards of each of `arrays` have at the places; 0 where the place is -1."""
    some, back = np.unique(places, return_inverse=True)
    return [x[back] for x in _sorted_at(some, starts, *arrays, kind=kind, width=width)]


def _sorted_at(
    places: np.ndarray, starts: np.ndarray, *arrays: Shards, kind=np.float64, width: int = 0
) -> list[np.ndarray]:
    """`_at` of places in order, with -1 anywhere among them."""
    there = np.flatnonzero(places >= 0)
    some = places[there]
    at = np.searchsorted(some, starts)
    out = [np.zeros((len(places), width) if width else len(places), kind) for _ in arrays]
    for s in np.flatnonzero(np.diff(at)).tolist():
        i = some[at[s] : at[s + 1]] - starts[s]
        for x, shards in zip(out, arrays, strict=True):
            if s in shards:
                x[there[at[s] : at[s + 1]]] = shards[s][i]
    return out


def score(docs: DataFrame, uri: str, text: str = "text") -> DataFrame:
    """Adds n_tokens, n_known, base_score, score (log10 probability) and perplexity."""
    small_batches(docs.sparkSession)
    names = fresh(docs, "n_tokens", "n_known", "base_score", "score", "perplexity", "lm")
    kind = T.StructType(
        [
            T.StructField("n", T.LongType()), T.StructField("k", T.LongType()), T.StructField("b", T.DoubleType()),
            T.StructField("s", T.DoubleType())
        ]
    )

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = _opened(uri)
        for cols in _scored(batches, model):
            yield pa.StructArray.from_arrays(
                [
                    pa.array(cols[0].astype(np.int64)), pa.array(cols[1].astype(np.int64)), pa.array(cols[2]),
                    pa.array(cols[3])
                ],
                ["n", "k", "b", "s"]
            )

    tmp = quoted(names[5])
    out = docs.withColumn(names[5], run(F.coalesce(quoted(text), F.lit(""))))
    values = (tmp["n"], tmp["k"], tmp["b"], tmp["s"], F.pow(F.lit(10.0), -tmp["s"] / tmp["n"]))
    return out.select(*(quoted(c) for c in docs.columns), *(v.alias(x) for v, x in zip(values, names, strict=False)))


def info(uri: str) -> dict:
    """Tokens, vocabulary and discounts of a model."""
    return json.loads(Folder(uri).read("model.json"))
