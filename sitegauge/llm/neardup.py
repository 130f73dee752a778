"""Near-duplicate groups by a chosen-path set similarity join.

A document's set holds its distinct shingles of five words (A-Z lower-cased); a shorter document has
its whole sequence as one shingle. Documents with equal sets form a class, and only classes are
compared. A class has a sketch of ``COORDINATES`` minwise values to branch by and ``FINE`` more, of
four bits each, to estimate similarities. Independent trees branch classes:
a node selects one of the coordinates, every third node two (4/3 on average, the inverse of the
similarity), and a class goes to the child named by its value there. Two classes of similarity 0.75
therefore share 1 node or more at any depth on average. The chance that they share none in a tree
grows with the depth, so ``trees`` gives the number of trees that brings it to ``MISS`` at a depth:
10 at the first tested depth, 21 at depth 4, 39 at depth 6.

Nodes are handled level by level:

1. Every class of a node is compared with the node's first class, which joins large groups in a
   number of pairs linear in their size.
2. Nodes whose classes already belong to one component are done. Open nodes of at most ``SMALL_NODE``
   classes compare all classes of different components: their classes bring their full sets, and a
   node gives only links, fewer than it has classes. In larger ones with at most ``OTHERS``
   classes outside the largest component, each of these is compared with every class of the node,
   which is linear in the node's size. All other nodes branch again, and the classes of these nodes
   are branched in further trees from the root, as many as the new depth asks for.

A pair is tested when its fine sketches agree in ``MIN_AGREE`` values (four standard deviations
below what the threshold gives) and its set sizes allow the threshold; a tested pair becomes a link
only by its full sets, which are made anew from the texts of the documents concerned. Components
are found by alternating large-star and small-star steps.

Defined results: null, empty or wordless texts have an empty set and stay alone; rows with equal ids
are documents of their own that share the id; a null id is never the smallest unless all ids of a
component are null; an empty table gives an empty one; other columns are ignored. Shingles are
compared by 64-bit hashes, classes by 128 bits.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import cut_lineage, free_name, texts_of

WIDTH = 5
COORDINATES = 48
#: Largest chance that a pair at the threshold shares no node at a tested depth.
MISS = 1e-4
START_DEPTH = 2
#: Nodes that one task compares exhaustively, and those that it compares in one array.
SMALL_NODE, TINY_NODE = 4096, 32
#: A larger node compares exhaustively while so few of its classes lie outside its largest component.
OTHERS = 48
#: Four-bit values per class; at the threshold 0.766 of them agree, with a deviation of 0.019.
FINE = 512
MIN_AGREE = 353
#: Similarity as a fraction of integers.
NUMERATOR, DENOMINATOR = 75, 100
#: Bits of the filter that picks documents whose sets are needed; it never drops one that is.
FILTER_BITS = 1 << 20
#: Words whose hashes a task remembers.
CACHED_WORDS = 200_000

_ODD = np.random.RandomState(11).randint(0, 2 ** 63, WIDTH, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = np.random.RandomState(12).randint(0, 2 ** 63, COORDINATES, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = np.random.RandomState(13).randint(0, 2 ** 63, COORDINATES, np.int64).astype(np.uint64) * np.uint64(2)
_MUL32 = np.random.RandomState(14).randint(0, 2 ** 31, FINE, np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_XOR32 = np.random.RandomState(15).randint(0, 2 ** 32, FINE, np.int64).astype(np.uint32)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    if len(known) > CACHED_WORDS:
        known.clear()
    out = []
    for w in words:
        h = known.get(w)
        if h is None:
            h = known[w] = xxhash.xxh3_64_intdigest(w)
        out.append(h)
    return np.array(out, np.uint64)


def shingles(text: bytes, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; ``known`` remembers word hashes."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words, known)
    n = max(1, len(h) - WIDTH + 1)
    total = np.full(n, len(words) if len(words) < WIDTH else 0, np.uint64)
    for k in range(min(WIDTH, len(h))):
        total += h[k:n + k] * _ODD[k]
    return np.unique(mixed(total))


def sketch(hashes: np.ndarray) -> np.ndarray:
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 2048):
        part = (hashes[None, i:i + 2048] ^ _XOR[:, None]) * _MUL[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def fine_sketch(hashes: np.ndarray) -> np.ndarray:
    """Four bits of each of ``FINE`` minwise values, two to a byte."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    low = np.full(FINE, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(short), 4096):
        for k in range(0, FINE, 64):
            part = short[None, i:i + 4096] ^ _XOR32[k:k + 64, None]
            part *= _MUL32[k:k + 64, None]
            np.minimum(low[k:k + 64], part.min(axis=1), out=low[k:k + 64])
    bits = ((low >> np.uint32(8)) & np.uint32(15)).astype(np.uint8)
    return bits[0::2] | (bits[1::2] << 4)


def agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Agreeing values of the rows of two matrices of fine sketches."""
    differs = x ^ y
    return ((differs & 15) == 0).sum(axis=1) + ((differs & 240) == 0).sum(axis=1)


def fingerprint(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, int] = {}
    for batch in batches:
        prints, sizes, sketches, minis = [], [], [], []
        for text in texts_of(batch.column(1)):
            s = shingles(text, known)
            sizes.append(len(s))
            if len(s):
                k = sketch(s)
                prints.append(fingerprint(s))
                sketches.append(k.tobytes())
                minis.append(fine_sketch(s).tobytes())
            else:
                prints.append(None)
                sketches.append(None)
                minis.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(prints, pa.binary()), pa.array(sizes, pa.int64()),
             pa.array(sketches, pa.binary()), pa.array(minis, pa.binary())],
            ["doc_id", "print", "n_shingles", "sketch", "mini"])


def _matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    """Rows of equal-length binaries as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def twofold(keys: np.ndarray) -> np.ndarray:
    """Which nodes select two coordinates."""
    first = mixed(keys + np.uint64(1)) % np.uint64(COORDINATES)
    second = mixed(keys + np.uint64(2)) % np.uint64(COORDINATES)
    return (mixed(keys + np.uint64(3)) % np.uint64(3) == 0) & (first != second)


def branch(keys: np.ndarray, at: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Children of nodes: ``keys`` are nodes and ``at`` the rows of ``sketches`` that lie in them."""
    first = mixed(keys + np.uint64(1)) % np.uint64(COORDINATES)
    second = mixed(keys + np.uint64(2)) % np.uint64(COORDINATES)
    two = twofold(keys)

    def child(keys, at, chosen):
        value = sketches[at, chosen.astype(np.int64)].astype(np.uint64)
        return mixed(keys ^ mixed((chosen << np.uint64(32)) | value)), at

    a, b = child(keys, at, first), child(keys[two], at[two], second[two])
    return np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])


def _roots(tree: int, n: int) -> np.ndarray:
    return np.full(n, mixed(np.array([1000 + tree], np.uint64))[0], np.uint64)


def miss_chance(depth: int, n_trees: int) -> float:
    """Chance that a pair at the threshold shares no node at a depth of any tree.

    All trees select from the same coordinates, so it is a mean over how many of them agree.
    """
    chance = NUMERATOR / DENOMINATOR
    agree = np.arange(COORDINATES + 1)
    weight = np.array([math.comb(COORDINATES, m) for m in agree]) * chance ** agree * (
        1 - chance) ** (COORDINATES - agree)
    none = np.zeros(COORDINATES + 1)  # within one tree
    two = (1 - 1 / COORDINATES) / 3  # a node selects two different coordinates
    for _ in range(depth):
        lost = 1 - agree / COORDINATES * (1 - none)
        none = (1 - two) * lost + two * lost ** 2
    return float(weight @ none ** n_trees)


@cache
def trees(depth: int) -> int:
    """The smallest number of trees whose miss chance at a depth is at most ``MISS``."""
    high = 1
    while miss_chance(depth, high) > MISS:
        high *= 2
    return bisect_left(range(high), True, key=lambda n: miss_chance(depth, n) <= MISS)


def _rooted(batches: Iterator[pa.RecordBatch], numbers: range, depth: int) -> Iterator[pa.RecordBatch]:
    """(cid, sketch) to (node, cid) at a depth of the trees of these numbers."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sketches, ids = _matrix(batch.column(1), np.uint32, COORDINATES), batch.column(0).to_numpy()
        for tree in numbers:
            at = np.arange(len(ids))
            keys = _roots(tree, len(ids))
            for _ in range(depth):
                keys, at = branch(keys, at, sketches)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(ids[at])], ["node", "cid"])


def _branched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, cid, sketch) to (node, cid), two levels deeper."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sketches, ids = _matrix(batch.column(2), np.uint32, COORDINATES), batch.column(1).to_numpy()
        keys, at = batch.column(0).to_numpy().view(np.uint64), np.arange(len(ids))
        for _ in range(2):
            keys, at = branch(keys, at, sketches)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(ids[at])], ["node", "cid"])


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, mini of a, mini of b) to the pairs whose sketches agree enough."""
    for batch in batches:
        if batch.num_rows:
            same = agreement(_matrix(batch.column(2), np.uint8, FINE // 2),
                             _matrix(batch.column(3), np.uint8, FINE // 2))
            keep = pa.array(same >= MIN_AGREE)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep),
                                              batch.column(1).filter(keep)], ["a", "b"])


def _pairs_of(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))],
                                      ["a", "b"])


def _fitting(i: np.ndarray, k: np.ndarray, comp: np.ndarray, n: np.ndarray,
             mini: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The index pairs (i, k) that differ in component and may reach the similarity; agreements."""
    fits = np.flatnonzero((comp[i] != comp[k]) & (
        DENOMINATOR * np.minimum(n[i], n[k]) >= NUMERATOR * np.maximum(n[i], n[k])))
    # The first quarter of a sketch rules out most pairs; five deviations below the threshold.
    fits = fits[agreement(mini[i[fits], :FINE // 8], mini[k[fits], :FINE // 8]) >= FINE * 0.58 / 4]
    same = agreement(mini[i[fits]], mini[k[fits]])
    fits, same = fits[same >= MIN_AGREE], same[same >= MIN_AGREE]
    return i[fits], k[fits], same


def _index_pairs(node: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of the same node, in arrays of bounded size; ``node`` is sorted."""
    if not len(node):
        return
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    sizes = np.diff(np.r_[starts, len(node)])
    at = np.flatnonzero(np.repeat(sizes <= TINY_NODE, sizes))
    for d in range(1, TINY_NODE):
        i, k = at[:-d], at[d:]
        same = node[i] == node[k]
        if not same.any():
            break
        yield i[same], k[same]
    for start, size in zip(starts[sizes > TINY_NODE], sizes[sizes > TINY_NODE]):
        for row in range(0, size, 8):
            i, k = np.meshgrid(np.arange(row, min(size, row + 8)), np.arange(row, size))
            yield start + i[k > i], start + k[k > i]


def _cells(column: pa.Array) -> np.ndarray:
    """Lists or binaries of 8-byte numbers as arrays, one per row."""
    out = np.empty(len(column), object)
    if pa.types.is_list(column.type):
        ends, flat = np.cumsum(column.value_lengths().to_numpy()), column.flatten().to_numpy()
        out[:] = np.split(flat, ends[:-1])
    else:
        out[:] = [np.frombuffer(x, np.uint64) for x in column.to_pylist()]
    return out


def _whole_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Rows (node, cid, comp, n, mini, ...) sorted by node, as arrays that hold nodes whole.

    Nodes are small, so the rows of an unfinished one are kept for the next batch.
    """
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column(i).to_numpy() for i in range(4)]
        now.append(_matrix(batch.column(4), np.uint8, FINE // 2))
        now += [_cells(batch.column(i)) for i in range(5, batch.num_columns)]
        if held is not None:
            now = [np.concatenate([x, y]) for x, y in zip(held, now)]
        done = int(np.searchsorted(now[0], now[0][-1]))
        held = [x[done:] for x in now]
        if done:
            yield [x[:done] for x in now]
    if held is not None:
        yield held


def _best_partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each row of a node the pair with the row of another component that agrees most."""
    for node, cid, comp, n, mini in _whole_nodes(batches):
        most, partner = np.zeros(len(node), np.int64), np.full(len(node), -1)
        for i, k in _index_pairs(node):
            i, k, same = _fitting(i, k, comp, n, mini)
            row, other, same = np.r_[i, k], np.r_[k, i], np.r_[same, same]
            up = np.argsort(same, kind="stable")  # of equal rows the last assignment stays
            up = up[same[up] > most[row[up]]]
            most[row[up]], partner[row[up]] = same[up], other[up]
        found = np.flatnonzero(partner >= 0)
        yield _pairs_of(cid[found], cid[partner[found]])


def _with_partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (node, cid) that agree with some row of another component in their node."""
    for node, cid, comp, n, mini in _whole_nodes(batches):
        has = np.zeros(len(node), bool)
        for i, k in _index_pairs(node):
            i, k, _ = _fitting(i, k, comp, n, mini)
            has[i] = has[k] = True
        yield pa.RecordBatch.from_arrays([pa.array(node[has]), pa.array(cid[has])], ["node", "cid"])


def _links_in_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their sets and nodes to links by full sets, as few as join what a node joins.

    Every agreeing pair of different components is compared, unless links of the node have joined
    them before; a pair that shares several nodes is compared in the first of them alone.
    """
    for node, cid, comp, n, mini, hashes, nodes in _whole_nodes(batches):
        starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], len(node)]):
            sets, own, of = hashes[a:b], nodes[a:b], comp[a:b].tolist()
            parent = {c: c for c in of}

            def root(c):
                while parent[c] != c:
                    parent[c] = c = parent[parent[c]]
                return c

            found: list[tuple[int, int]] = []
            for i, k in _index_pairs(node[a:b]):
                i, k, same = _fitting(i, k, comp[a:b], n[a:b], mini[a:b])
                order = np.argsort(-same, kind="stable")
                for x, y in zip(i[order].tolist(), k[order].tolist()):
                    one, other = root(of[x]), root(of[y])
                    if (one != other and np.intersect1d(own[x], own[y], True)[0] == node[a]
                            and similar(sets[x], sets[y])):
                        parent[one] = other
                        found.append((x, y))
            at = np.array(found, np.int64).reshape(-1, 2)
            yield _pairs_of(cid[a:b][at[:, 0]], cid[a:b][at[:, 1]])


def _against_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cid, comp, n, mini, others) to agreeing pairs of different components.

    ``others`` are the classes of the row's node outside its largest component.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        cid, comp, n = (batch.column(i).to_numpy() for i in range(3))
        mini, lists = _matrix(batch.column(3), np.uint8, FINE // 2), batch.column(4)
        at = np.repeat(np.arange(len(cid)), lists.value_lengths().to_numpy())
        flat = lists.flatten()
        other, other_comp, m = (flat.field(i).to_numpy() for i in range(3))
        small, large = np.minimum(n[at], m), np.maximum(n[at], m)
        fits = np.flatnonzero((comp[at] != other_comp)
                              & (DENOMINATOR * small >= NUMERATOR * large))
        if len(fits):
            minis = _matrix(flat.field(3), np.uint8, FINE // 2)
            fits = np.concatenate([part[agreement(mini[at[part]], minis[part]) >= MIN_AGREE]
                                   for part in np.array_split(fits, 1 + len(fits) // 100_000)])
        yield _pairs_of(cid[at[fits]], other[fits])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cid, print, text) to (cid, sorted hashes), for texts that have the class's set."""
    known: dict[bytes, int] = {}
    for batch in batches:
        ids, out = [], []
        for cid, want, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                   texts_of(batch.column(2))):
            s = shingles(text, known)
            if len(s) and fingerprint(s) == want:
                ids.append(cid)
                out.append(s.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())],
                                         ["cid", "hashes"])


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets reach the similarity."""
    if DENOMINATOR * min(len(x), len(y)) < NUMERATOR * max(len(x), len(y)):
        return False
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return DENOMINATOR * both >= NUMERATOR * (len(x) + len(y) - both)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep),
                                          batch.column(1).filter(keep)], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(cid, comp) of every end of an edge (a, b): comp is the smallest id that can be reached.

    Large-star steps tie the larger neighbours of a node to its smallest one, small-star steps the
    smaller ones; sums are combined before each shuffle. It ends when a round changes nothing.
    """
    def state(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.hash("hi", "lo").cast("long"))).first()

    now = cut_lineage(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                      .filter("hi <> lo").distinct())
    before = state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        low = both.groupBy("hi").agg(F.least(F.min("lo"), F.col("hi")).alias("low"))
        large = (both.join(low, "hi").filter("lo > hi")
                 .select(F.col("lo").alias("hi"), F.col("low").alias("lo")).distinct())
        least = large.groupBy("hi").agg(F.min("lo").alias("low"))
        small = (large.join(least, "hi")
                 .select(F.when(F.col("lo") == F.col("low"), F.col("hi")).otherwise(F.col("lo"))
                         .alias("hi"), F.col("low").alias("lo")).distinct())
        now = cut_lineage(small)
        after = state(now)
        if after == before:
            break
        before = after
    return (now.select(F.col("hi").alias("cid"), F.col("lo").alias("comp"))
            .unionByName(now.select(F.col("lo").alias("cid"), F.col("lo").alias("comp")).distinct()))


class _Join:
    """State of one similarity join: classes, sets made so far, pairs tested, links found."""

    def __init__(self, docs: DataFrame):
        self.docs = docs.select("doc_id", "text")
        self.rows = cut_lineage(self.docs.mapInArrow(
            _sketched, "doc_id long, print binary, n_shingles long, sketch binary, mini binary"))
        best = (self.rows.filter("print is not null").groupBy("print")
                .agg(F.min("doc_id").alias("low"),
                     F.first(F.struct("n_shingles", "sketch", "mini")).alias("s")))
        self.classes = cut_lineage(best.select(
            F.monotonically_increasing_id().alias("cid"), "print", "low", "s.*"))
        self.sets: DataFrame | None = None
        self.tested: DataFrame | None = None
        self.links: DataFrame | None = None
        self.comps: DataFrame | None = None

    def add_sets(self, ids: DataFrame) -> None:
        """Make the sets of classes that have none yet."""
        if self.sets is not None:
            ids = ids.join(self.sets, "cid", "left_anti")
        need = cut_lineage(self.classes.select("cid", "print", "low").join(ids, "cid", "left_semi"))
        bit = F.pmod(F.xxhash64(F.col("id")), F.lit(FILTER_BITS))
        bits = need.select(F.col("low").alias("id")).select(bit.alias("bit")).distinct()
        picked = (self.docs.withColumnRenamed("doc_id", "id").withColumn("bit", bit)
                  .join(F.broadcast(bits), "bit", "left_semi"))  # at most FILTER_BITS rows
        made = cut_lineage(picked.join(need, picked["id"].eqNullSafe(need["low"]))
                           .select("cid", "print", "text")
                           .mapInArrow(_sets, "cid long, hashes binary"))
        self.sets = made if self.sets is None else self.sets.unionByName(made)

    def test(self, pairs: DataFrame) -> None:
        """Test distinct pairs (a, b) whose sketches agree, and merge the components they link."""
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = cut_lineage(pairs)
        if pairs.isEmpty():
            if self.comps is None:
                self.comps = components(pairs)
            return
        self.tested = pairs if self.tested is None else self.tested.unionByName(pairs)
        self.add_sets(pairs.select(F.col("a").alias("cid"))
                      .unionByName(pairs.select(F.col("b").alias("cid"))).distinct())
        x = self.sets.select(F.col("cid").alias("a"), F.col("hashes").alias("x"))
        y = self.sets.select(F.col("cid").alias("b"), F.col("hashes").alias("y"))
        found = cut_lineage(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
                            .mapInArrow(_linked, "a long, b long"))
        self.comps = self.merged(found)

    def merged(self, links: DataFrame) -> DataFrame:
        """(cid, comp) after adding links, which are first reduced to pairs of components."""
        if self.comps is None:
            return cut_lineage(components(links))
        of_a = self.comps.select(F.col("cid").alias("a"), F.col("comp").alias("comp_a"))
        of_b = self.comps.select(F.col("cid").alias("b"), F.col("comp").alias("comp_b"))
        joins = (links.join(of_a, "a", "left").join(of_b, "b", "left")
                 .select(F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b"))
                 .distinct())
        new = cut_lineage(components(joins))
        moved = (self.comps.join(new.select(F.col("cid").alias("comp"), F.col("comp").alias("to")),
                                 "comp", "left")
                 .select("cid", F.coalesce("to", "comp").alias("comp")))
        return cut_lineage(moved.unionByName(new.join(self.comps, "cid", "left_anti")))

    def shared(self, rows: DataFrame) -> DataFrame:
        """Of rows (node, cid), those in nodes of two or more, with the first class of the node."""
        nodes = (rows.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("cid").alias("first"))
                 .filter("size > 1"))
        return cut_lineage(rows.join(nodes, "node"))

    def planted(self, rows: DataFrame, numbers: range, depth: int) -> DataFrame:
        """(node, cid) of rows (cid, sketch) at a depth of the trees of these numbers."""
        return rows.mapInArrow(lambda it: _rooted(it, numbers, depth), "node long, cid long")

    def star_pairs(self, members: DataFrame) -> DataFrame:
        pairs = (members.filter("cid <> first")
                 .select(F.col("first").alias("a"), F.col("cid").alias("b")).distinct())
        x = self.classes.select(F.col("cid").alias("a"), F.col("mini").alias("x"), F.col("n_shingles").alias("m"))
        y = self.classes.select(F.col("cid").alias("b"), F.col("mini").alias("y"), F.col("n_shingles").alias("n"))
        fits = DENOMINATOR * F.least("m", "n") >= NUMERATOR * F.greatest("m", "n")
        return (pairs.join(y, "b").join(x, "a").filter(fits).select("a", "b", "x", "y")
                .mapInArrow(_agreeing, "a long, b long"))

    def open_members(self, members: DataFrame) -> DataFrame:
        """Members of nodes with several components: node, cid, comp, size, main, n_others."""
        placed = (members.select("node", "cid").join(self.comps, "cid", "left")
                  .withColumn("comp", F.coalesce("comp", "cid")))
        nodes = (placed.groupBy("node", "comp").agg(F.count(F.lit(1)).alias("k"))
                 .groupBy("node").agg(F.max(F.struct("k", "comp")).alias("most"),
                                      F.sum("k").alias("size"))
                 .select("node", "size", F.col("most.comp").alias("main"),
                         (F.col("size") - F.col("most.k")).alias("n_others"))
                 .filter("n_others > 0"))
        return cut_lineage(placed.join(nodes, "node"))

    def node_rows(self, small: DataFrame) -> DataFrame:
        return small.join(self.info, "cid").select("node", "cid", "comp", "n", "mini")

    def best_pairs(self, small: DataFrame) -> DataFrame:
        """The best partner of each class in nodes of at most SMALL_NODE classes."""
        return (self.node_rows(small).repartition("node").sortWithinPartitions("node")
                .mapInArrow(_best_partners, "a long, b long").distinct())

    def join_nodes(self, small: DataFrame) -> None:
        """Compare nodes of at most SMALL_NODE classes exhaustively and merge what they link.

        Only classes with a partner that agrees bring their sets; a node gives fewer links than it
        has classes, however many pairs it compares.
        """
        rows = cut_lineage(self.node_rows(small))
        near = cut_lineage(rows.repartition("node").sortWithinPartitions("node")
                           .mapInArrow(_with_partners, "node long, cid long"))
        if near.isEmpty():
            return
        self.add_sets(near.select("cid").distinct())
        shared = near.groupBy("cid").agg(F.collect_list("node").alias("nodes"))  # one per tree at most
        full = (near.join(rows, ["node", "cid"]).join(self.sets, "cid").join(shared, "cid")
                .select("node", "cid", "comp", "n", "mini", "hashes", "nodes")
                .repartition("node").sortWithinPartitions("node"))
        self.comps = self.merged(cut_lineage(full.mapInArrow(_links_in_nodes, "a long, b long").distinct()))

    def run(self) -> None:
        self.info = self.classes.select("cid", F.col("n_shingles").alias("n"), "mini")
        depth, sketches = START_DEPTH, self.classes.select("cid", "sketch")
        members = self.shared(self.planted(sketches, range(trees(depth)), depth))
        self.test(self.star_pairs(members))
        while True:
            small = F.col("size") <= SMALL_NODE
            # The best partners first: they merge most of what can merge, and spare other tests.
            self.test(self.best_pairs(self.open_members(members).filter(small)))
            still = self.open_members(members)
            self.join_nodes(still.filter(small))
            parts = []
            one_main = ~small & (F.col("n_others") <= OTHERS)
            near = still.filter(one_main)
            if not near.isEmpty():
                near = near.join(self.info, "cid").select("node", "cid", "comp", "main", "n", "mini")
                others = (near.filter("comp <> main").groupBy("node")  # at most OTHERS a node
                          .agg(F.collect_list(F.struct("cid", "comp", "n", "mini")).alias("others")))
                parts.append(near.join(others, "node").select("cid", "comp", "n", "mini", "others")
                             .mapInArrow(_against_others, "a long, b long"))
            large = still.filter(~small & ~one_main)
            deeper = not large.isEmpty()
            if deeper:
                further = range(trees(depth), trees(depth + 2))
                depth += 2
                members = self.shared(
                    large.select("node", "cid").join(sketches, "cid").select("node", "cid", "sketch")
                    .mapInArrow(_branched, "node long, cid long")
                    .unionByName(self.planted(sketches.join(large.select("cid").distinct(), "cid",
                                                            "left_semi"), further, depth)))
                parts.append(self.star_pairs(members))
            if parts:
                self.test(reduce(DataFrame.unionByName, parts).distinct())
            if not deeper:
                return


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per row of ``docs``."""
    join = _Join(docs)
    join.run()
    grouped = join.classes.select("cid", "print", "low").join(join.comps, "cid", "left")
    lows = (grouped.filter("comp is not null").groupBy("comp").agg(F.min("low").alias("least")))
    classes = (grouped.join(lows, "comp", "left")
               .select("print", F.when(F.col("comp").isNull(), F.col("low")).otherwise(F.col("least"))
                       .alias("of_class")))
    rows = join.rows.select("doc_id", "n_shingles", "print").join(classes, "print", "left")
    own: Column = F.when(F.col("print").isNull(), F.col("doc_id")).otherwise(F.col("of_class"))
    return rows.select("doc_id", "n_shingles", own.alias("component_id"),
                       F.col("doc_id").eqNullSafe(own).alias("kept"))


def op3(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)


def _printed(batches: Iterator[pa.RecordBatch], text: str, name: str) -> Iterator[pa.RecordBatch]:
    """Rows with the fingerprint of their set as a further column."""
    known: dict[bytes, int] = {}
    for batch in batches:
        sets = (shingles(t, known) for t in texts_of(batch.column(text)))
        prints = pa.array([fingerprint(s) if len(s) else None for s in sets], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns, prints], [*batch.schema.names, name])


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group, with the columns of ``docs``.

    A group keeps its smallest id, null only if it has no other; of its classes with that id it keeps
    the one of the smallest fingerprint, and of that id's rows in the class, one. Rows of other groups
    may share the id. Documents without words form no group and stay.
    """
    join = _Join(docs)
    join.run()
    found = (join.classes.select("cid", "print", "low").join(join.comps, "cid", "left")
             .groupBy(F.coalesce("comp", "cid"))
             .agg(F.min(F.struct(F.col("low").isNull(), "low", "print")).alias("s"))
             .select(F.col("s.low").alias("_kept_id"), F.col("s.print").alias("_kept_print")))
    words = F.regexp_like(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]"))
    own = free_name(docs, "_print")
    schema = StructType([*docs.schema.fields, StructField(own, BinaryType())])
    printed = docs.filter(words).mapInArrow(lambda it: _printed(it, "text", own), schema)
    kept = (printed.join(found, printed["doc_id"].eqNullSafe(found["_kept_id"])
                         & (printed[own] == found["_kept_print"]), "left_semi")
            .dropDuplicates(["doc_id", own]).drop(own))
    return kept.unionByName(docs.filter(~words))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS sh
  FROM (SELECT doc_id, w, unnest(range(1, greatest(length(w) - 3, 2))) AS i FROM d WHERE length(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * n_both >= 75 * (p.n + q.n - n_both)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d
  UNION SELECT r.doc_id, l.y FROM reach r JOIN both_ways l ON r.other = l.x),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id,
       d.doc_id = component_id AS kept
FROM d JOIN comp USING (doc_id) LEFT JOIN n USING (doc_id)
"""
