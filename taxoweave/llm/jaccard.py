"""Exact n-gram Jaccard join by rare-first prefix filtering.

Two texts link if 100 * |A & B| >= percent * |A | B| for their sets of word shingles.

1. Every text becomes a set of shingle hashes; texts of equal sets are one node.  A
   count-min sketch of fixed width estimates in how many texts a shingle occurs.
2. The shingles of a node are ordered rare first: estimates that chance alone can give come
   first in order of hash, then the frequent ones by the logarithm of their estimate.  Two linked sets
   share a shingle within the first n - ceil(percent * n) + 1 of each, so only these
   prefixes are joined.  A prefix shingle of a single node is dropped, and one of a few nodes
   that fail the length or the positional filter; one that the sketch
   counts in more than `LIST` texts is cut into parts by node, and each two parts meet in a
   task, so no task holds a whole hot list.
3. The nodes of a prefix shingle that pass the length, positional and suffix filters are
   candidates.  Candidates form groups (connected components, in Spark); a node that its
   group has already is not paired again, so a group of copies costs few pairs a node.
4. The ordered sets of a group of at most `BLOCK` nodes come together, once each, and the
   candidates inside that are not connected yet are verified, once a pair.  The nodes of a
   larger group are dealt to blocks, and a set goes only to those pairs of blocks in which
   it has a candidate: at most twice for each candidate pair, and at most once a block.

Defined cases: texts without words, null texts included, have no shingles and link with
nothing; with fewer words than a shingle, the whole sequence is the one shingle; very long
texts are taken whole; repeated rows are members of one node; rows without an id get no
component but their own null, unless linked; ties do not arise, as a component is named by
its smallest id; an empty table gives no rows; other columns are not read, whatever their
names.

Sets and shingles are compared by 64-bit hashes, so the result is exact but for equal hashes
of different sets or shingles (about k^2 / 2^65 for k of them).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .hashing import mix, shingle_sets, string_buffers, word_hashes
from .shared import fresh, quoted, small_batches, written

#: Cells of the sketch (16 MB on the driver and in a worker), and of one piece of it.
SKETCH, PIECE = 1 << 22, 1 << 16
#: Most nodes of a candidate group that are compared in one task.
BLOCK = 2048
#: Binary logarithm of the nodes of a prefix shingle's list that come together in one task.
LIST = 14
#: Candidate texts up to which their keys are broadcast (16 bytes each).
BROADCAST_ROWS = 500_000
#: Meetings that a task remembers, so as not to tell them again; the memory starts anew when full.
MEETINGS = 2_000_000
#: Parts of the hash space for the suffix filter.
SUFFIX_BINS = 256
#: Rows of lists that are worked on at once, and shingles that a task counts at once.
ROWS, COUNTED = 1 << 15, 1 << 21
#: Nodes of a short list, all pairs of which are filtered at once.
SHORT = 8


def _sets(texts: pa.Array, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(shingles, offsets, words) of some texts at a time, in order: the sorted set of shingle hashes of
    text i is shingles[offsets[i]:offsets[i + 1]]; it has words[i] words."""
    for _, _, hashes, off in word_hashes(texts):
        yield *shingle_sets(hashes, off, n), np.diff(off)


def _signatures(sets: np.ndarray, off: np.ndarray) -> np.ndarray:
    """64 bits of each set; 0 for empty ones."""
    sums, sizes = np.concatenate((np.zeros(1, np.uint64), np.cumsum(sets, dtype=np.uint64))), np.diff(off)
    return np.where(sizes > 0, mix(sums[off[1:]] - sums[off[:-1]] + mix(sizes.astype(np.uint64))).view(np.int64), 0)


def _unseen(nodes: np.ndarray, seen: set[int]) -> np.ndarray:
    """The places of nodes that are not in `seen`, which they are added to."""
    out = []
    for i, node in enumerate(nodes.tolist()):
        if node not in seen:
            seen.add(node)
            out.append(i)
    return np.array(out, np.int64)


def _places(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers first[i] up to first[i] + sizes[i], one range after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)


def _gathered(batches: Iterator[pa.RecordBatch], rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at least `rows` but for the last; none is empty."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= (ROWS if rows is None else rows):
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def _slots(s: np.ndarray) -> np.ndarray:
    return (s & np.uint64(SKETCH - 1)).astype(np.int64)


def _prefix(size, percent: int):
    """Length of the prefix of a set, or of sets, of that size."""
    return size - -(-percent * size // 100) + 1


def _narrow(counts: np.ndarray) -> bytes:
    """Counts as the smallest integers that hold them, compressed."""
    kind = next(k for k in (np.uint8, np.uint16, np.uint32) if counts.max() <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + zlib.compress(counts.astype(kind).tobytes(), 1)


def _wide(blob: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob[1:]), f"u{blob[0]}").astype(np.int64)


def _signed(texts: DataFrame, n: int, carried: list[str]) -> DataFrame:
    """Rows (doc_id, text_key, n_shingles, n_words, node, carried...), and pieces of the tasks' sketches."""
    names = ["doc_id", "text_key", "n_shingles", "n_words", "node", *carried, "piece", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.int64)
        seen: set[int] = set()
        slots, waiting, types = [], 0, []
        for batch in batches:
            types = [batch.column(c).type for c in carried]
            sizes, lengths, nodes = [], [], []
            for sets, off, n_words in _sets(batch.column("text"), n):
                sizes.append(np.diff(off))
                lengths.append(n_words)
                nodes.append(_signatures(sets, off))
                new = _unseen(nodes[-1], seen)  # copies within a task count once
                slots.append(_slots(sets[_places(off[new], sizes[-1][new])]).astype(np.int32))
                waiting += len(slots[-1])
            if waiting >= COUNTED:
                sketch += np.bincount(np.concatenate(slots), minlength=SKETCH)
                slots, waiting = [], 0
            k = batch.num_rows
            cols = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (sizes, lengths, nodes)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_key"), *(pa.array(c, pa.int64()) for c in cols),
                    *(batch.column(c) for c in carried), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())
                ],
                names
            )
        if slots:
            sketch += np.bincount(np.concatenate(slots), minlength=SKETCH)
        for p in range(SKETCH // PIECE):
            part = sketch[p * PIECE : (p + 1) * PIECE]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.nulls(1, t) for t in [pa.int64()] * 5 + types), pa.array([p], pa.int32()),
                        pa.array([_narrow(part)], pa.binary())
                    ],
                    names
                )

    fields = [f"{c} {texts.schema[c].dataType.simpleString()}" for c in carried]
    return texts.mapInArrow(
        run, ", ".join([*(f"{c} long" for c in names[:5]), *fields, "piece int", "counts binary"])
    )


def _sketch(signed: DataFrame) -> np.ndarray:
    """The sum of all tasks' sketches; pieces are summed apart, so no task holds them all."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for p, blob in zip(batch.piece, batch.counts, strict=True):
                sums[p] = sums.get(p, 0) + _wide(blob)
        yield pd.DataFrame({"piece": list(sums), "counts": [_narrow(np.minimum(v, 2**31 - 1)) for v in sums.values()]})

    pieces = signed.filter("piece IS NOT NULL").select("piece", "counts").repartition(
        SKETCH // PIECE, "piece"
    ).mapInPandas(add, "piece int, counts binary").collect()
    out = np.zeros(SKETCH, np.int32)
    for r in pieces:
        out[r.piece * PIECE : (r.piece + 1) * PIECE] = _wide(r.counts)
    return out


def _classes(sketch: np.ndarray) -> np.ndarray:
    """Frequency class of each cell: 0 up to what chance fills a cell with, else the binary
    logarithm of what it has beyond the mean.  So the order is by hash, whatever the corpus,
    except for shingles that are frequent beyond doubt."""
    mean = float(sketch.sum(dtype=np.int64)) / len(sketch)
    return np.where(
        sketch <= mean + 8 * np.sqrt(mean) + 8, 0, np.log2(np.maximum(sketch - mean, 1)).astype(int)
    ).astype(np.uint8)


def _rare_first(sets: np.ndarray, off: np.ndarray, classes: np.ndarray) -> None:
    """Puts each set in order, rare first."""
    of = classes[_slots(sets)]
    frequent = np.concatenate(([0], np.cumsum(of > 0)))
    for i in np.flatnonzero(frequent[off[1:]] > frequent[off[:-1]]).tolist():
        a, b = off[i], off[i + 1]
        sets[a:b] = sets[a:b][np.argsort(of[a:b], kind="stable")]


def _prefixes(texts: DataFrame, n: int, percent: int, sketch, list_bits: int) -> DataFrame:
    """(h, node, size, pos, cut): prefix shingles of each node, their places, and the binary
    logarithm of the number of parts into which the shingle's list is cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = {0}  # empty sets have no prefix
        for batch in batches:
            for sets, off, _ in _sets(batch.column(0), n):
                nodes = _signatures(sets, off)
                new = _unseen(nodes, seen)
                if not len(new):
                    continue
                _rare_first(sets, off, sketch.value)
                size = np.diff(off)[new]
                k = _prefix(size, percent)
                h = sets[_places(off[new], k)]
                cut = np.maximum(sketch.value[_slots(h)].astype(np.int32) - (list_bits - 1), 0)
                cols = [
                    h.view(np.int64), np.repeat(nodes[new], k), np.repeat(size.astype(np.int32), k),
                    _places(np.zeros(len(k), np.int64), k).astype(np.int32), cut
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], LIST_COLUMNS)

    return texts.mapInArrow(run, "h long, node long, size int, pos int, cut int")


LIST_COLUMNS = ["h", "node", "size", "pos", "cut"]
#: The part of a cut list that a node is in.
PART = "pmod(node, shiftleft(1L, cut))"


def _alike(x: np.ndarray, y: np.ndarray, size: np.ndarray, pos: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of rows x and y of a shingle's list, y being larger, pass the length and the positional filter."""
    need = -(-percent * (size[x] + size[y]) // (100 + percent))
    return (100 * size[x] >= percent * size[y]) & (
        1 + np.minimum(size[x] - pos[x] - 1, size[y] - pos[y] - 1) >= need
    )


def _shared(prefixes: DataFrame, percent: int) -> DataFrame:
    """The rows whose shingle another node has, with which they pass the length and the positional
    filter; of more than `SHORT` nodes, the length filter with the next smaller or larger one
    decides.  Rows of a cut list all stay."""

    def kept(h, node, size, pos, cut) -> pa.RecordBatch:
        first, runs = _runs(h)
        some = np.flatnonzero(np.repeat(runs > 1, runs) | (cut > 0))
        h, node, size, pos, cut = (c[some] for c in (h, node, size, pos, cut))
        order = np.lexsort((node, size, node % (np.int64(1) << cut.astype(np.int64)), h))
        order = order[np.concatenate(([True], (h[order[1:]] != h[order[:-1]]) | (node[order[1:]] != node[order[:-1]])))[
            : len(order)
        ]]  # a node that came twice stays once
        h, node, size, pos, cut = (c[order] for c in (h, node, size, pos, cut))
        wide, keep = size.astype(np.int64), cut > 0
        first, runs = _runs(h)
        short = np.repeat(runs <= SHORT, runs)
        for d in range(1, SHORT):
            x = np.flatnonzero((h[d:] == h[:-d]) & short[d:]) if d < len(h) else np.zeros(0, np.int64)
            x = x[_alike(x, x + d, wide, pos, percent)]
            keep[x] = keep[x + d] = True
        x = np.flatnonzero((h[1:] == h[:-1]) & ~short[1:] & (100 * wide[:-1] >= percent * wide[1:]))
        keep[x] = keep[x + 1] = True
        return pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (h, node, size, pos, cut)], LIST_COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in _gathered(batches):
            cols = [batch.column(c).to_numpy() for c in LIST_COLUMNS]
            if held is not None:
                cols = [np.concatenate((x, c)) for x, c in zip(held, cols, strict=True)]
            end = int(np.searchsorted(cols[0], cols[0][-1]))  # the last list may go on
            if end:
                yield kept(*(c[:end] for c in cols))
            held = [c[end:] for c in cols]
        if held is not None:
            yield kept(*held)

    return prefixes.repartition("h", F.expr(PART)).sortWithinPartitions("h").mapInArrow(run, prefixes.schema)


def passing(x: int, first: int, cols: tuple[np.ndarray, ...], percent: int, ask: np.ndarray) -> np.ndarray:
    """Of one shingle's nodes by size: the places y in [first, x) with `ask`[y - first] whose
    pair with x passes the positional and the suffix filter."""
    _, size, pos, bins = cols
    ys = first + np.flatnonzero(ask)
    need = -(-percent * (size[x] + size[ys]) // (100 + percent))
    ok = 1 + np.minimum(size[x] - pos[x] - 1, size[ys] - pos[ys] - 1) >= need
    ys, need = ys[ok], need[ok]
    return ys[_may_overlap(bins[x], bins[ys], need, size[x], size[ys])]


def candidate_links(
    node: np.ndarray, size: np.ndarray, pos: np.ndarray, bins: np.ndarray, percent: int, root,
    part: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Pairs of one shingle's nodes (by size) that pass the filters and that `root`, which
    gives a node's group so far, does not connect yet: groups that are connected are not
    compared again, so copies cost little.  `part`: only nodes of different parts pair."""
    _, label = np.unique([root(int(x)) for x in node], return_inverse=True)
    if not label.any():
        return []
    links, cols = [], (node, size, pos, bins)
    first = np.searchsorted(100 * size, percent * size)  # length filter
    for x in range(1, len(node)):
        ask = label[first[x] : x] != label[x]
        if part is not None:
            ask &= part[first[x] : x] != part[x]
        for y in passing(x, first[x], cols, percent, ask).tolist():
            if label[y] != label[x]:
                links.append((int(node[x]), int(node[y])))
                root(int(node[x]), int(node[y]))
                label[label == label[y]] = label[x]
    return links


def _met(lists: DataFrame) -> DataFrame:
    """The lists with columns i, j and part: each two parts of a cut list meet as (h, i, j)."""
    pair = lambda k: F.struct(F.least(F.expr(PART), k).alias("i"), F.greatest(F.expr(PART), k).alias("j"))
    rows = lists.select(
        "*",
        F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.expr("shiftleft(1L, cut) - 1")), pair)).alias("p")
    )
    rows = rows.select(*lists.columns, "p.i", "p.j", F.expr(PART).alias("part"))
    return rows.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j", "size", "node")


def _whole_lists(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[np.ndarray]]:
    """Arrays (key, names..., bins) of some whole lists at a time; key tells lists apart."""
    held: list[np.ndarray] | None = None
    seen = 0
    for batch in _gathered(batches):
        h, i, j = (batch.column(c).to_numpy() for c in ("h", "i", "j"))
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
        if held is not None and (h[0], i[0], j[0]) == at:
            new[0] = False
        key = seen + np.cumsum(new)
        seen, at = int(key[-1]), (h[-1], i[-1], j[-1])
        cols = [key, *(batch.column(c).to_numpy().astype(np.int64) for c in names)]
        off, data = string_buffers(batch.column("bins"))
        cols.append(data[off[0] : off[-1]].reshape(batch.num_rows, SUFFIX_BINS))
        if held is not None:
            cols = [np.concatenate((x, c)) for x, c in zip(held, cols, strict=True)]
        end = int(np.searchsorted(cols[0], cols[0][-1]))  # the last list may go on
        if end:
            yield [c[:end] for c in cols]
        held = [c[end:] for c in cols]
    if held is not None:
        yield held


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, int)
    return first, np.diff(np.append(first, len(key)))


def _candidates(lists: DataFrame, percent: int) -> DataFrame:
    """(a, b) of rows (h, node, size, pos, cut, bins): candidates that connect each task's lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int, join: int | None = None) -> int:
            while (p := parent.get(x, x)) != x:
                parent[x] = parent.get(p, p)
                x = p
            if join is not None:
                parent[x] = root(join)
            return x

        for key, node, size, pos, part, bins in _whole_lists(batches, ["node", "size", "pos", "part"]):
            out = []
            first, runs = _runs(key)
            short = np.repeat(runs <= SHORT, runs)
            for d in range(1, min(SHORT, len(key))):  # all pairs of short lists, most of all, at once
                x = np.flatnonzero((key[d:] == key[:-d]) & short[d:])
                x = x[_alike(x, x + d, size, pos, percent)]
                y = x + d
                need = -(-percent * (size[x] + size[y]) // (100 + percent))
                ok = _may_overlap(bins[x], bins[y], need, size[x], size[y])
                for a, b in zip(node[x[ok]].tolist(), node[y[ok]].tolist(), strict=True):
                    if root(a) != root(b):
                        root(a, b)
                        out.append((a, b))
            for i, m in zip(first[runs > SHORT].tolist(), runs[runs > SHORT].tolist(), strict=True):
                sides = part[i : i + m]
                out += candidate_links(
                    *(c[i : i + m] for c in (node, size, pos, bins)), percent, root,
                    sides if (sides != sides[0]).any() else None
                )
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return _met(lists).mapInArrow(run, "a long, b long")


def _meetings(lists: DataFrame, percent: int) -> DataFrame:
    """(grp, bi, bj, node) of rows (h, node, size, pos, cut, bins, grp, blocks): the pairs of blocks
    of its group in which a node has a pair that passes the filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[tuple[int, int, int]] = set()
        for key, node, size, pos, part, grp, blocks, bins in _whole_lists(
            batches, ["node", "size", "pos", "part", "grp", "blocks"]
        ):
            out = []
            mine = node % blocks
            for at, m in zip(*(v.tolist() for v in _runs(key)), strict=True):
                cols = tuple(c[at : at + m] for c in (node, size, pos, bins))
                g, block, side = grp[at : at + m], mine[at : at + m], part[at : at + m]
                first = np.searchsorted(100 * cols[1], percent * cols[1])
                cut = (side != side[0]).any()
                for x in range(1, m):
                    ask = g[first[x] : x] == g[x]
                    if cut:
                        ask &= side[first[x] : x] != side[x]
                    for y in passing(x, first[x], cols, percent, ask).tolist():
                        i, j = sorted((int(block[x]), int(block[y])))
                        for v in (int(cols[0][x]), int(cols[0][y])):
                            if (v, i, j) not in done:
                                done.add((v, i, j))
                                out.append((int(g[x]), i, j, v))
                if len(done) > MEETINGS:
                    done.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[k] for p in out], pa.int64()) for k in range(4)], ["grp", "bi", "bj", "node"]
            )

    return _met(lists).mapInArrow(run, "grp long, bi long, bj long, node long").distinct()


def _bins(s: np.ndarray, rows: np.ndarray | None = None, n: int = 1) -> np.ndarray:
    """Shingles of a set in each part of the hash space, one byte each; 255 stands for 255 or more.
    With `rows`, the number of the set that each shingle is of: one row for each of the n sets."""
    at = (s >> np.uint64(56)).astype(np.int64)
    if rows is not None:
        at += rows * SUFFIX_BINS
    out = np.minimum(np.bincount(at, minlength=n * SUFFIX_BINS), 255).astype(np.uint8)
    return out if rows is None else out.reshape(n, SUFFIX_BINS)


def _may_overlap(a: np.ndarray, b: np.ndarray, need: np.ndarray, size_a, size_b) -> np.ndarray:
    """Suffix filter: two sets share at most the smaller count of every part; of the parts where
    both counts are full, at most what the smaller of both sets has in its full parts."""
    most = np.minimum(a, b).sum(axis=-1, dtype=np.int64)
    if a.size and b.size and a.max() == 255 and b.max() == 255:
        both = ((a == 255) & (b == 255)).sum(axis=-1)
        full = lambda v, size: size - np.where(v == 255, 0, v).sum(axis=-1, dtype=np.int64)
        most = np.where(both > 0, most - 255 * both + np.minimum(full(a, size_a), full(b, size_b)), most)
    return most >= need


def join_block(nodes: list[int], sets: list[np.ndarray], sides: list[int], percent: int) -> list[tuple[int, int]]:
    """Links that connect the nodes of a block: a spanning forest of the exact link graph.

    `sets`: rare-first.  `sides`: with two sides, only nodes of different sides are compared.
    The order within sets is global, so a shared prefix shingle at places i and j bounds the
    overlap by 1 + min(rest of A, rest of B)."""
    order = sorted(range(len(nodes)), key=lambda i: (len(sets[i]), nodes[i]))
    size = np.array([len(s) for s in sets])
    plain = [np.sort(s) for s in sets]
    bins = np.array([_bins(s) for s in sets]) if sets else np.zeros((0, SUFFIX_BINS), np.uint8)
    comp = np.arange(len(nodes))
    members = {i: [i] for i in range(len(nodes))}
    index: dict[int, list[tuple[int, int]]] = {}
    links = []
    side = np.array(sides)
    two = len(set(sides)) > 1
    for x in order:
        pre = sets[x][: _prefix(len(sets[x]), percent)].tolist()
        found: dict[int, int] = {}  # candidate -> bound of the overlap from the first shared shingle
        for i, h in enumerate(pre):
            for y, j in index.get(h, ()):
                if y not in found:
                    found[y] = 1 + min(size[x] - i - 1, size[y] - j - 1)
            index.setdefault(h, []).append((x, i))
        if not found:
            continue
        ys = np.fromiter(found, np.int64, len(found))
        bound = np.fromiter(found.values(), np.int64, len(found))
        need = -(-percent * (size[x] + size[ys]) // (100 + percent))
        ok = (
            100 * np.minimum(size[x], size[ys]) >= percent * np.maximum(size[x], size[ys])
        ) & (bound >= need) & (comp[ys] != comp[x])
        if two:
            ok &= side[ys] != side[x]
        ys, need = ys[ok], need[ok]
        ok = _may_overlap(bins[x], bins[ys], need, size[x], size[ys])
        for y, least in zip(ys[ok].tolist(), need[ok].tolist(), strict=True):
            if comp[x] == comp[y]:
                continue
            at = np.searchsorted(plain[y], plain[x])
            at[at == len(plain[y])] = 0
            if int((plain[y][at] == plain[x]).sum()) >= least:
                links.append((nodes[x], nodes[y]))
                a, b = comp[x], comp[y]
                if len(members[a]) < len(members[b]):
                    a, b = b, a
                comp[members[b]] = a
                members[a] += members.pop(b)
    return links


def _links(cands: DataFrame, percent: int) -> DataFrame:
    """(a, b): links of candidate nodes (grp, bi, bj, node, blocks, shingles)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, nodes, sets, sides = None, [], [], []

        def done() -> pd.DataFrame:
            return pd.DataFrame(join_block(nodes, sets, sides, percent), columns=["a", "b"], dtype="int64")

        for batch in batches:
            for g, i, j, node, blocks, blob in zip(
                batch.grp, batch.bi, batch.bj, batch.node, batch.blocks, batch.shingles, strict=True
            ):
                if (g, i, j) != key:
                    if len(nodes) > 1:
                        yield done()
                    key, nodes, sets, sides = (g, i, j), [], [], []
                if not nodes or nodes[-1] != node:  # equal sets may come twice
                    nodes.append(node)
                    sets.append(np.frombuffer(blob, np.uint64))
                    sides.append(node % blocks)
        if len(nodes) > 1:
            yield done()

    return cands.repartition("grp", "bi", "bj").sortWithinPartitions(
        "grp", "bi", "bj", "node"
    ).mapInPandas(run, "a long, b long")


def _small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """`df` (written), to be broadcast if it has at most `rows` rows."""
    return F.broadcast(df) if df.count() <= (BROADCAST_ROWS if rows is None else rows) else df


def similar_components(
    docs: DataFrame, n: int = 4, percent: int = 85, text: str = "text", doc_id: str = "doc_id", block: int = BLOCK,
    list_bits: int = LIST, carried: tuple[str, ...] = ()
) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (the smallest doc_id reachable
    by links, itself included), node (equal for equal sets), n_words, and the columns `carried`."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(
        quoted(doc_id).cast("long").alias("doc_id"), F.xxhash64(quoted(text)).alias("text_key"),
        quoted(text).alias("text")
    )
    alone = texts if not carried else docs.select(
        quoted(doc_id).cast("long").alias("doc_id"), F.xxhash64(quoted(text)).alias("text_key"),
        quoted(text).alias("text"), *(quoted(c) for c in carried)
    )
    signed = written(_signed(alone, n, [*carried]), "signed")
    rows = signed.filter("piece IS NULL").drop("piece", "counts")
    sketch = spark.sparkContext.broadcast(_classes(_sketch(signed)))
    lists = written(
        _shared(_prefixes(docs.select(quoted(text).alias("text")), n, percent, sketch, list_bits), percent), "lists"
    )
    # of each node: its smallest id, its number of rows, and one row that has its text
    place = F.coalesce("doc_id", F.lit(0)).alias("place")
    of_node = rows.filter("n_shingles > 0").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"),
        F.min(F.struct(place, "text_key")).alias("at")
    )
    of_node = written(of_node, "nodes")

    def texts_of(nodes: DataFrame, *carried: str) -> DataFrame:
        """The texts of the nodes (node, ...); those that share text and id may come more than once."""
        keys = _small(written(of_node.join(nodes, "node").select("at.place", "at.text_key", *carried), "keys"))
        return texts.select("text_key", "text", place).join(keys, ["text_key", "place"]).select(*carried, "text")

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sets, off, _ in _sets(batch.column(0), n):
                rows = np.repeat(np.arange(len(off) - 1), np.diff(off))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_signatures(sets, off), pa.int64()),
                        pa.array([b.tobytes() for b in _bins(sets, rows, len(off) - 1)], pa.binary())
                    ],
                    ["node", "bins"]
                )

    bins = texts_of(lists.select("node").distinct()).mapInArrow(
        binned, "node long, bins binary"
    ).groupBy("node").agg(F.min("bins").alias("bins"))
    groups = written(
        connected_components(_candidates(lists.join(bins, "node"), percent)).withColumnRenamed("component", "grp"),
        "groups"
    )
    sizes = groups.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("blocks"))
    large = written(sizes.filter("blocks > 1"), "large")
    meet = groups
    some_large = not large.isEmpty()
    if some_large:
        spread = groups.join(_small(large), "grp")
        again = lists.join(spread, "node").join(bins, "node")
        across = written(_meetings(again, percent), "meetings").join(_small(large), "grp")
        meet = groups.join(_small(large), "grp", "left_anti")
    one = F.lit(0).cast("long")
    meet = meet.select("node", "grp", one.alias("bi"), one.alias("bj"), F.lit(1).cast("long").alias("blocks"))
    if some_large:
        meet = meet.unionByName(across.select("node", "grp", "bi", "bj", "blocks"))

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, blobs = [], []
            for sets, off, _ in _sets(batch.column(4), n):
                nodes += _signatures(sets, off).tolist()
                _rare_first(sets, off, sketch.value)
                blobs += [sets[a:b].tobytes() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(4)), pa.array(nodes, pa.int64()), pa.array(blobs, pa.binary())],
                ["grp", "bi", "bj", "blocks", "node", "shingles"]
            )

    cands = texts_of(meet, "grp", "bi", "bj", "blocks").mapInArrow(
        ordered, "grp long, bi long, bj long, blocks long, node long, shingles binary"
    )
    linked = written(
        connected_components(_links(cands, percent)).join(of_node.select("node", "least"), "node"), "linked"
    )
    names = _small(written(linked.groupBy("component").agg(F.min("least").alias("component_id")), "names"))
    # a node of one row that nothing links is its own component: only the others are looked up
    moved = linked.join(names, "component").select("node", "component_id", "component")
    alike = of_node.filter("copies > 1").select("node", "least").join(moved, "node", "full_outer").select(
        "node", F.coalesce("component_id", "least").alias("component_id"), "component"
    )
    out = rows.join(_small(written(alike, "moved")), "node", "left")
    named = F.when(
        F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")
    ).otherwise(F.col("doc_id")).alias("component_id")
    return out.select(
        "doc_id", "n_shingles", named, "node", "text_key", F.coalesce("component", "node").alias("component"), "n_words",
        *(quoted(c) for c in carried)
    )


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of `docs` without near copies: of the rows that links connect, the one with the
    smallest id stays (of several texts of that id, one; of equal rows, one; null ids come
    last).  Rows without words link with nothing and stay."""
    found = similar_components(docs, n, percent, text, doc_id).filter("n_shingles > 0")
    at = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_key")
    rows = written(found.select(at.alias("at"), "component"), "components")
    several = rows.groupBy("component").agg(
        F.min("at").alias("stays"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1").drop("n")
    several = written(rows.join(_small(written(several, "stays")), "component"), "several")
    names = none, id_, key = fresh(docs, "none", "id", "key")
    gone = _small(written(several.filter("at <> stays").select("at.*").distinct().toDF(*names), "gone"))
    named = docs.withColumns(
        {
            none: quoted(doc_id).isNull(), key: F.xxhash64(quoted(text)),
            id_: F.coalesce(quoted(doc_id).cast("long"), F.lit(0))
        }
    )
    left = named.join(gone, [*names], "left_anti")
    # equal rows that stay together: only these are sorted out
    twice = _small(
        written(
            several.filter("at = stays").groupBy("at").count().filter("count > 1").select("at.*").toDF(*names), "twice"
        )
    )
    if twice.isEmpty():
        return left.select(*(quoted(c) for c in docs.columns))
    alone, equal = left.join(twice, [*names], "left_anti"), left.join(twice, [*names], "left_semi")
    return alone.unionByName(equal.dropDuplicates([*names])).select(*(quoted(c) for c in docs.columns))
