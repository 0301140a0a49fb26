"""Language identification by error-correcting output codes.

Every language gets a codeword of bits.  For each bit a binary classifier over hashed
byte n-grams says on which side the text's language stands: naive Bayes weights
log p(gram | bit 1) - log p(gram | bit 0), averaged over the text's n-grams.  Decoding is
loss-weighted (Escalera, Pujol and Radeva 2010): a bit counts for a language by the share of
that language's training texts that its classifier puts on the right side.  A codeword's
loss is the so weighted mean over bits of log(1 + exp(-bit * margin)), times the number of
bits; the nearest codeword wins, the score is the share exp(-loss) of the winner, and texts
whose two best codewords are close are flagged as ambiguous.

N-gram counts by language are taken from all training texts in Spark, and so, in a second
pass, are the weights; what reaches the driver is one count vector of `buckets`, and one of
bits, a language.  Whole texts are scored.

Defined cases: null texts and texts without a letter are `und` with score 0; very long texts
are scored whole; rows whose language is null are not learned from; repeated rows train and
are scored one by one; with one language learned, it is the answer with score 1; with none
(an empty table), every text is `und`; ties go to the first language in order of name;
columns named like the added ones keep their names, the added ones get underscores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import CHUNK, LOWER, mix, string_buffers
from .shared import fresh, quoted, small_batches

BUCKETS = 4096


def gram_counts(texts: pa.Array, buckets: int = BUCKETS) -> np.ndarray:
    """Counts of hashed 1- to 3-byte grams: one row of `buckets` a text."""
    off, data = string_buffers(texts)
    n = len(off) - 1
    out = np.zeros((n, buckets), np.float32)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + CHUNK, "right")) - 1)
        for a in range(int(off[lo]), int(off[hi]), CHUNK):
            b = min(int(off[hi]), a + CHUNK)
            piece = LOWER[data[max(int(off[lo]), a - 2) : b]].astype(np.uint64)
            skip = a - max(int(off[lo]), a - 2)
            rows = np.repeat(np.arange(hi - lo), np.diff(np.clip(off[lo : hi + 1], a, b)))
            begin = np.arange(a, b) - off[lo:hi][rows]
            code = piece[skip:]
            for size in (1, 2, 3):
                if size > 1:
                    earlier = np.zeros(len(code), np.uint64)
                    k = size - 1
                    from_ = piece[: len(piece) - k][-len(code) :] if len(piece) - k >= len(code) else np.concatenate(
                        (np.zeros(len(code) - (len(piece) - k), np.uint64), piece[: len(piece) - k])
                    )
                    earlier[:] = from_
                    code = code + (earlier << np.uint64(8 * k))
                ok = begin >= size - 1
                slot = (mix(code + np.uint64(size << 40)) % np.uint64(buckets)).astype(np.int64)
                flat = rows * buckets + slot
                out[lo:hi] += np.bincount(
                    flat[ok], minlength=(hi - lo) * buckets
                ).reshape(hi - lo, buckets).astype(np.float32)
        lo = hi
    return out


def codewords(n: int, seed: int = 7, tries: int = 64) -> np.ndarray:
    """Codewords (+1/-1) of n languages: all non-trivial splits up to 6 languages; else about
    ten times the binary logarithm of n balanced columns, no two equal or complementary, of
    `tries` random draws the one whose nearest two codewords are farthest apart."""
    if n < 2:
        return np.ones((n, 0), np.float32)
    if n <= 6:
        splits = [[1 if i == 0 or (s >> (i - 1)) & 1 else -1 for i in range(n)] for s in range(2 ** (n - 1) - 1)]
        return np.array(splits, np.float32).T.reshape(n, -1)
    rng = np.random.default_rng(seed)
    half, wanted = np.where(np.arange(n) % 2, 1, -1), int(np.ceil(10 * np.log2(n)))
    best, apart = None, -1.0
    for _ in range(tries):
        columns: dict[tuple, np.ndarray] = {}
        while len(columns) < wanted:
            c = rng.permutation(half)
            columns[tuple(c * c[0])] = c  # a column and its complement are one
        code = np.array(list(columns.values()), np.float32).T
        distance = (len(columns) - code @ code.T + 2 * len(columns) * np.eye(n)).min() / 2
        if distance > apart:
            best, apart = code, distance
    return best


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray  # buckets x bits
    trust: np.ndarray  # languages x bits: how much a bit counts for a language, each row with mean 1
    scale: float = 50.0

    def margins(self, counts: np.ndarray) -> np.ndarray:
        """What each bit's classifier says of each row of counts."""
        return self.scale * (counts @ self.weights) / np.maximum(counts.sum(axis=1, keepdims=True), 1)

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the language, score, share of the second) of each row of counts."""
        margin = self.margins(counts)
        loss = np.stack(
            [np.logaddexp(0, -margin * code) @ w for code, w in zip(self.codes, self.trust, strict=True)], axis=1
        )
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        share /= share.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        second = np.sort(share, axis=1)[:, -2] if share.shape[1] > 1 else np.zeros(len(share))
        return best, share[np.arange(len(share)), best], second


def bit_trust(right: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Weights of each language's bits from how many of its `texts` every bit has `right`."""
    share = (right + 0.5) / (texts[:, None] + 1.0)
    return share / share.mean(axis=1, keepdims=True) if share.size else share


def fit(train: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS) -> LanguageModel:
    """Learns from all rows of `train` whose language and text are not null."""
    small_batches(train.sparkSession)
    rows = train.select(
        quoted(lang).cast("string").alias("lang"), quoted(text).alias("text")
    ).filter("lang IS NOT NULL AND text IS NOT NULL")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            counts, langs = gram_counts(batch.column(1), buckets), np.array(batch.column(0).to_pylist(), object)
            for name in set(langs):
                sums[name] = sums.get(name, 0) + counts[langs == name].sum(axis=0, dtype=np.float64)
        for name, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"lang": [name] * len(at), "slot": at.astype(np.int32), "n": total[at]})

    sums = rows.mapInArrow(
        counted, "lang string, slot int, n double"
    ).groupBy("lang", "slot").agg(F.sum("n").alias("n")).groupBy("lang").agg(
        F.collect_list(F.struct("slot", "n")).alias("v")
    ).collect()
    names = sorted(r.lang for r in sums)
    table = np.zeros((len(names), buckets))
    for r in sums:
        for slot, n in r.v:
            table[names.index(r.lang), slot] = n
    prob = (table + 0.1) / (table + 0.1).sum(axis=1, keepdims=True) if names else table
    codes = codewords(len(names))
    weights = np.stack(
        [np.log(prob[code > 0].mean(axis=0)) - np.log(prob[code < 0].mean(axis=0)) for code in codes.T], axis=1
    ) if codes.size else np.zeros((buckets, 0))
    model = LanguageModel(names, codes, weights.astype(np.float32), np.ones(codes.shape))
    if codes.shape[1] < 2:
        return model

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, texts, place = np.zeros(codes.shape, np.int64), np.zeros(len(names), np.int64), {
            x: i for i, x in enumerate(names)
        }
        for batch in batches:
            at = np.array([place[x] for x in batch.column(0).to_pylist()], int)
            np.add.at(right, at, model.margins(gram_counts(batch.column(1), buckets)) * codes[at] > 0)
            np.add.at(texts, at, 1)
        some = np.flatnonzero(texts)
        yield pa.RecordBatch.from_pydict({"i": some, "bit": np.full(len(some), -1), "n": texts[some]})
        for i in some:
            yield pa.RecordBatch.from_pydict(
                {"i": np.full(codes.shape[1], i), "bit": np.arange(codes.shape[1]), "n": right[i]}
            )

    right, texts = np.zeros(codes.shape), np.zeros(len(names))
    for r in rows.mapInArrow(
        judged, "i long, bit long, n long"
    ).groupBy("i", "bit").agg(F.sum("n").alias("n")).collect():
        if r.bit < 0:
            texts[r.i] = r.n
        else:
            right[r.i, r.bit] = r.n
    return replace(model, trust=bit_trust(right, texts))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", ambiguous: float = 0.5) -> DataFrame:
    """Adds lang_pred, lang_score and lang_ambiguous (the second share is at least
    `ambiguous` times the first)."""
    small_batches(docs.sparkSession)
    names = [*model.languages]
    kind = "struct<p:int,s:double,a:boolean>"

    @F.arrow_udf(kind)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            best, share, second = model.predict(gram_counts(texts, model.weights.shape[0]))
            yield pa.StructArray.from_arrays(
                [
                    pa.array(best.astype(np.int32)), pa.array(share.astype(np.float64)),
                    pa.array(second >= ambiguous * share)
                ],
                ["p", "s", "a"]
            )

    has_letter = F.coalesce(quoted(text).rlike("\\p{L}"), F.lit(False))
    pred, score, unsure = fresh(docs, "lang_pred", "lang_score", "lang_ambiguous")
    if not names:
        return docs.select("*", F.lit("und").alias(pred), F.lit(0.0).alias(score), F.lit(True).alias(unsure))
    (tmp,) = fresh(docs, "lang_found")
    df = docs.withColumn(tmp, predict(F.coalesce(quoted(text), F.lit(""))))
    pick: Column = F.get(F.array(*map(F.lit, names)), quoted(tmp)["p"])
    return df.select(
        *(quoted(c) for c in docs.columns), F.when(has_letter, pick).otherwise("und").alias(pred),
        F.when(has_letter, quoted(tmp)["s"]).otherwise(0.0).alias(score),
        F.when(has_letter, quoted(tmp)["a"]).otherwise(True).alias(unsure)
    )
