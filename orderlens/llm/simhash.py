"""SimHash near-duplicates through a Gray-order hierarchical index.

Distinct fingerprints are sorted by Gray rank, so that neighbours share most bits.  Every
``FAN`` neighbours form a node that keeps the bits on which all its members agree (a mask
and a pattern); nodes are grouped in turn, up to a root.  A search goes down two such
trees at once: the agreed bits in which two nodes differ are a lower bound for all pairs
below them, and a pair of groups whose differences exceed the radius is dropped whole.

Scale.  Exact copies collapse into one fingerprint before anything else.  Two
fingerprints at ``radius`` or fewer differing bits agree in one of ``radius + 1`` bands,
so each is sent to ``radius + 1`` groups (ranges of band values) and each group is
searched by its own index; no link is lost.  A group answers with a spanning forest (one
row per linked fingerprint), not with all its pairs, and pairs already joined are not
looked into.  Groups are joined by min-label propagation with pointer jumping, each
round written to the shared folder.

``drop_similar`` searches the same index at a wide radius: each group's tree answers with
nearest pairs that span all fingerprints within ``WIDE`` bits (``spanning``), and the exact
similarity of the shingles decides.  Similar texts may differ in more bits: at a Jaccard
similarity of 0.8 in 14 or more, which no banding of 64 bits holds.  So that none of them
is lost, texts meet by bands of MinHash values as well, the nearest ones first in large
bands; what these may miss there is searched in full (``missed``): texts that are not
yet in one group meet by their rarest shingles and become a pair if their parities are
near enough, two filters that lose no pair.

Defined results: a NULL or blank text has fingerprint zero and is linked like any other;
a NULL id never becomes a component's id unless all its ids are NULL; equal rows have
equal results; columns named like an output are replaced, all others are passed on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import adding, as_bytes, free_name, mix, slices, without, written

FAN = 8
PAIRS = 1 << 16  # pairs looked at together: bounds memory, not results
#: MinHash: a pair at similarity s shares one of BANDS values with probability 1 - (1 - s ** ROWS) ** BANDS, 0.99997 at 0.8.
BANDS, ROWS = 20, 4
_FACTORS = np.random.default_rng(42).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Differing bits of fingerprints that ``drop_similar`` finds by the index; rows of a group there.
WIDE, WIDE_ROWS = 7, 1000
#: In a band value of more than SMALL texts, each is first paired with its NEAREST by fingerprint among WINDOW in Gray
#: order; ``missed`` finds the other pairs there, so the three values steer the work and not the result.
SMALL, NEAREST, WINDOW = 16, 3, 1024
#: Edges for each file of a round's tables in ``drop_similar``.
FILE_ROWS = 50_000
#: 64-bit numbers in a set's parity: more of them tell longer texts apart, the result stays the same.
PARITY = 16


def shingles(line: bytes, words_per_shingle: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each shingle of a line of words with one space between them."""
    words = line.split(b" ")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(words_per_shingle, len(words))
    starts = np.r_[0, ends[:-1] + 1][: len(words) - k + 1].tolist()
    hash_ = xxhash.xxh64_intdigest
    return np.fromiter((hash_(line[a:b], seed) for a, b in zip(starts, ends[k - 1:].tolist())), np.uint64, len(starts))


def majority(h: np.ndarray) -> int:
    """Bit k is set if it is set in more than half of the values."""
    ones = np.zeros(64, np.int64)
    for part in np.array_split(h, -(-len(h) // 8192)):
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes, words_per_shingle: int = 3, seed: int = 42) -> int:
    """Bit k is set if it is set in more than half of the shingles' XXH64 values; A-Z are lower-cased."""
    words = text.lower().split()  # bytes.lower changes A-Z only
    return majority(shingles(b" ".join(words), words_per_shingle, seed)) if words else 0


def fingerprints(docs: DataFrame, text_col: str = "text", words_per_shingle: int = 3) -> DataFrame:
    """The frame with ``fp`` (the 64 bits as a signed number) in place of the text."""
    docs = without(docs, ["fp"])
    rest = docs.drop(text_col)

    def run(batches):
        for batch in batches:
            fp = np.array([fingerprint(t, words_per_shingle) for t in as_bytes(batch.column(text_col))], np.uint64)
            out = batch.drop_columns([text_col])
            yield out.append_column("fp", pa.array(fp.view(np.int64)))

    return docs.mapInArrow(run, adding(rest, "fp long"))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each value in the Gray sequence."""
    out = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(s)
    return out


class GrayIndex:
    """Levels of (pattern, mask) from the single fingerprints up to at most ``FAN`` nodes."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps[np.argsort(gray_rank(fps), kind="stable")]
        ones, zeros = self.fps, ~self.fps
        self.levels = [(self.fps, np.full(len(fps), ~np.uint64(0)))]
        while len(ones) > FAN:
            at = np.arange(0, len(ones), FAN)
            ones, zeros = np.bitwise_and.reduceat(ones, at), np.bitwise_and.reduceat(zeros, at)
            self.levels.append((ones, ones | zeros))

    def pairs(self, radius: int, joined=None):
        """Blocks (i, j), i < j, of positions at ``radius`` or fewer differences.

        ``joined(i, j)`` may tell that pairs of positions need no further look.
        """
        top = len(self.levels) - 1
        i, j = np.triu_indices(len(self.levels[top][0]))
        stack = [(top, i, j)]
        while stack:
            level, i, j = stack.pop()
            if len(i) > PAIRS:
                stack += [(level, a, b) for a, b in zip(np.array_split(i, -(-len(i) // PAIRS)), np.array_split(j, -(-len(j) // PAIRS)))]
                continue
            pattern, mask = self.levels[level]
            near = np.bitwise_count((pattern[i] ^ pattern[j]) & mask[i] & mask[j]) <= radius
            i, j = i[near], j[near]
            if level == 0:
                off = i < j
                if off.any():
                    yield i[off], j[off]
                continue
            if joined is not None and level == 1:
                rest = ~joined(i, j)
                i, j = i[rest], j[rest]
            below = len(self.levels[level - 1][0])
            a = (i[:, None] * FAN + np.repeat(np.arange(FAN), FAN)).ravel()
            b = (j[:, None] * FAN + np.tile(np.arange(FAN), FAN)).ravel()
            good = (a <= b) & (a < below) & (b < below)
            if len(i):
                stack.append((level - 1, a[good], b[good]))


class Forest:
    """Disjoint sets of positions; the root of each is its smallest position."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.groups = -(-n // FAN)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            off = a != b
            a, b = a[off], b[off]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up

    def joined(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """True where all members of lowest nodes i and j are in one set."""
        at = np.arange(0, len(self.root), FAN)
        low, high = np.minimum.reduceat(self.root, at), np.maximum.reduceat(self.root, at)
        return (low[i] == high[i]) & (low[j] == high[j]) & (low[i] == low[j])


def forest(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, root) for each fingerprint that is linked to one before it."""
    index, sets = GrayIndex(np.unique(fps)), Forest(len(np.unique(fps)))
    for i, j in index.pairs(radius, sets.joined):
        sets.join(i, j)
    off = np.flatnonzero(sets.root != np.arange(len(sets.root)))
    return index.fps[off], index.fps[sets.root[off]]


def spanning(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of fingerprints at ``radius`` or fewer bits that join all such pairs, in rounds of each one's nearest."""
    index = GrayIndex(np.unique(fps))
    sets, a, b = Forest(len(index.fps)), [], []
    for i, j in index.pairs(radius, sets.joined):
        order = np.argsort(np.bitwise_count(index.fps[i] ^ index.fps[j]), kind="stable")
        i, j = i[order], j[order]
        while True:
            off = sets.root[i] != sets.root[j]
            i, j = i[off], j[off]
            if not len(i):
                break
            near = np.union1d(np.unique(i, return_index=True)[1], np.unique(j, return_index=True)[1])
            a.append(i[near])
            b.append(j[near])
            sets.join(i[near], j[near])
    none = np.zeros(0, np.int64)
    return index.fps[np.concatenate([*a, none])], index.fps[np.concatenate([*b, none])]


def links(distinct: DataFrame, radius: int = 3, group_rows: int = 100_000, find=forest) -> DataFrame:
    """(a, b): spanning edges between the distinct fingerprints of column ``fp``, as ``find`` makes them of a group.

    A group of more than four times ``group_rows`` (many fingerprints with one band value)
    is split by the same rule: its links agree in one of ``radius + 1`` parts of the
    other bits too.
    """
    bands = radius + 1
    width, narrow = 64 // bands, (64 - 64 // bands) // bands
    spark = distinct.sparkSession
    n = distinct.count()
    per_band = max(int(spark.conf.get("spark.sql.shuffle.partitions")) // bands, -(-n // group_rows), 1)
    per_band = min(per_band, 1 << width)
    numbers = F.array([F.lit(k) for k in range(bands)])
    turned = F.expr(f"shiftrightunsigned(fp, band * {width}) | shiftleft(fp, 64 - band * {width})")
    value = F.expr(f"turned & {(1 << width) - 1}")
    part = F.expr(f"shiftrightunsigned(turned, {width} + part * {narrow}) & {(1 << narrow) - 1}")
    keyed = (
        distinct.select("fp", F.explode(numbers).alias("band")).withColumn("turned", turned)
        .withColumn("grp", F.col("band") * per_band + F.pmod(F.xxhash64(value), F.lit(per_band)))
    )
    large = written(keyed.groupBy("grp").count().filter(F.col("count") > 4 * group_rows).select(F.col("grp").alias("large")), "large_groups")
    dealt = (
        keyed.join(large, keyed.grp == large.large, "left")
        .withColumn("part", F.explode(F.when(F.col("large").isNull(), F.array(F.lit(-1))).otherwise(numbers)))
        .select("fp", "grp", F.when(F.col("part") >= 0, F.xxhash64("part", value, part)).alias("sub"))
    )

    def search(table: pa.Table) -> pa.Table:
        a, b = find(table.column("fp").to_numpy().view(np.uint64), radius)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return dealt.groupBy("grp", "sub").applyInArrow(search, "a long, b long").distinct()


def components(edges: DataFrame, name: str = "components", file_rows: int = 0) -> DataFrame:
    """(node, root) for the nodes of the edges: the smallest node reachable, by labels and pointer jumping.

    With ``file_rows`` the tables of a round go to one file for so many edges, and not one for each shuffle partition.
    """
    both = written(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a")), name)
    files = -(-both.count() // file_rows) if file_rows else 0
    put = lambda df: written(df.coalesce(max(files, 1)) if file_rows else df, name)
    label = put(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("root")))
    while True:
        near = (
            both.join(label, both.v == label.node).groupBy("u").agg(F.min("root").alias("m"))
            .join(label, F.col("u") == F.col("node")).select("node", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        )
        near = put(near)
        jump = near.select(F.col("node").alias("via"), F.col("root").alias("far"))
        label = put(
            near.join(jump, near.root == jump.via, "left")
            .select("node", F.least("root", F.coalesce("far", "root")).alias("root"), "old")
        )
        moved = label.filter("root <> old").limit(1).count()
        label = label.drop("old")
        if not moved:
            return label


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows, without their text, with ``fp``, ``component_root`` (a fingerprint) and ``component_id`` (smallest id reachable)."""
    docs = without(docs, ["fp", "component_root", "component_id"])
    prints = written(fingerprints(docs, text_col, words_per_shingle), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct_fingerprints")
    roots = components(links(distinct, radius))
    classes = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("component_root"), "least")
    smallest = classes.groupBy("component_root").agg(F.min("least").alias("component_id"))
    classes = classes.drop("least").join(smallest, "component_root")
    return prints.join(classes, "fp").select(*[prints[c] for c in prints.columns], "component_root", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row of each component stays: that with the smallest id, NULL ids last, then by text hash."""
    digest = free_name(docs, "text_digest")
    keyed = docs.withColumn(digest, F.xxhash64(F.col(text_col)))
    found = near_duplicates(keyed.select(id_col, text_col, digest), id_col, text_col, words_per_shingle, radius)
    keep = found.groupBy("component_root").agg(F.min(_first(id_col, digest)).alias("k")).select("k.*")
    return _first_rows(keyed, keep, id_col, digest)


def _first(id_col: str, digest: str) -> Column:
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("of"), F.col(digest).alias("digest_of"))


def _same(keep: DataFrame, id_col: str, digest: str) -> Column:
    same = F.coalesce(F.col(id_col), F.lit(0)) == F.coalesce(keep["of"], F.lit(0))
    return same & (F.col(id_col).isNull() == keep["none"]) & (F.col(digest) == keep["digest_of"])


def _first_rows(keyed: DataFrame, keep: DataFrame, id_col: str, digest: str) -> DataFrame:
    return keyed.join(keep, _same(keep, id_col, digest), "left_semi").dropDuplicates([id_col, digest]).drop(digest)


def minhash(h: np.ndarray) -> np.ndarray:
    """One value per band from the distinct shingle values."""
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for part in np.array_split(h, -(-len(h) // 4096)):
        least = np.minimum(least, (part[:, None] * _FACTORS).min(axis=0))
    least, out = least.reshape(BANDS, ROWS), np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        out = mix(out, least[:, k])
    return out


def sketches(docs: DataFrame, text_col: str, words_per_shingle: int) -> DataFrame:
    """The frame with ``node`` (a hash of the words), ``fp`` and ``bands`` in place of the text."""

    def run(batches):
        for batch in batches:
            node, fp, bands = [], [], []
            for t in as_bytes(batch.column(text_col)):
                line = b" ".join(t.lower().split())
                h = shingles(line, words_per_shingle)
                node.append(xxhash.xxh64_intdigest(line, 7))
                fp.append(majority(h))
                bands.append(minhash(np.unique(h)))
            out = batch.drop_columns([text_col])
            for name, x in (("node", node), ("fp", fp)):
                out = out.append_column(name, pa.array(np.array(x, np.uint64).view(np.int64)))
            flat = np.concatenate([*bands, np.zeros(0, np.uint64)]).view(np.int64)
            yield out.append_column("bands", pa.ListArray.from_arrays(pa.array(np.arange(len(bands) + 1) * BANDS, pa.int32()), pa.array(flat)))

    return docs.mapInArrow(run, adding(docs.drop(text_col), "node long, fp long, bands array<long>"))


def nearest(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places: each fingerprint with its nearest ones in its window of the Gray order, and with the next in that order."""
    order = np.argsort(gray_rank(fps), kind="stable")
    a, b = [order[:-1]], [order[1:]]
    for begin in range(0, len(order), WINDOW // 2):
        at = order[begin:begin + WINDOW]
        if len(at) > NEAREST:
            apart = np.bitwise_count(fps[at][:, None] ^ fps[at][None, :])
            np.fill_diagonal(apart, 65)
            a.append(np.repeat(at, NEAREST))
            b.append(at[np.argpartition(apart, NEAREST - 1, axis=1)[:, :NEAREST]].ravel())
    return np.concatenate(a), np.concatenate(b)


def candidates(nodes: DataFrame, group_rows: int = 100_000) -> DataFrame:
    """(a, b, value): pairs a < b of texts that share a band value, and the members of large values.

    Texts of a value that at most ``SMALL`` share are paired in full, ``value`` being NULL.
    Of a larger value those near to each other are paired, at most ``2 * NEAREST + 1`` times
    its texts, and each of its texts is listed as (a, NULL, value).
    """
    dealt = nodes.select("node", "fp", F.posexplode("bands").alias("band", "value"))
    n = nodes.count() * BANDS
    parts = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // group_rows))
    dealt = dealt.withColumn("grp", F.pmod(F.xxhash64("value"), F.lit(parts)))

    def pairs(table: pa.Table) -> pa.Table:
        value, node = (table.column(c).to_numpy() for c in ("value", "node"))
        order = np.lexsort((node, value))
        value, node, fp = value[order], node[order], table.column("fp").to_numpy()[order].view(np.uint64)
        band = table.column("band").to_numpy()[order]
        edges = np.r_[0, np.flatnonzero(value[1:] != value[:-1]) + 1, len(value)]
        a, b, large = [], [], []
        for lo in np.flatnonzero(np.diff(edges) > 1).tolist():
            x, y = int(edges[lo]), int(edges[lo + 1])
            if y - x <= SMALL:
                i, j = np.triu_indices(y - x, 1)
            else:  # each band turns the bits, so that its windows differ from the others'
                turn = np.uint64(3 * int(band[x]))
                i, j = nearest(fp[x:y] << turn | fp[x:y] >> (np.uint64(64) - turn) if turn else fp[x:y])
                large.append(np.arange(x, y))
            a.append(node[x:y][i])
            b.append(node[x:y][j])
        a, b = (np.concatenate([*z, np.zeros(0, np.int64)]) for z in (a, b))
        found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        large = np.concatenate([*large, np.zeros(0, np.int64)])
        none = lambda n: pa.nulls(n, pa.int64())
        column = lambda x, y: pa.chunked_array([x, y], pa.int64())
        return pa.table({
            "a": column(pa.array(found[:, 0]), pa.array(node[large])),
            "b": column(pa.array(found[:, 1]), none(len(large))),
            "value": column(none(len(found)), pa.array(value[large])),
        })

    return dealt.groupBy("grp").applyInArrow(pairs, "a long, b long, value long")


def indexed(nodes: DataFrame, radius: int = WIDE) -> DataFrame:
    """(a, b), a < b: pairs of texts (node, fp) by the Gray index; those of one fingerprint meet at the first of them."""
    first = written(nodes.groupBy("fp").agg(F.min("node").alias("first")), "first_of_fingerprint")
    near = links(first, radius, WIDE_ROWS, spanning)
    x, y = first.select(F.col("fp").alias("a"), F.col("first").alias("x")), first.select(F.col("fp").alias("b"), F.col("first").alias("y"))
    apart = near.join(x, "a").join(y, "b").select("x", "y")
    same = nodes.join(first, "fp").filter("node <> first").select(F.col("first").alias("x"), F.col("node").alias("y"))
    return apart.union(same).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def shingle_sets(texts: DataFrame, words_per_shingle: int) -> DataFrame:
    """(node, n, s) for (node, text): the number of distinct shingles and their values, packed."""

    def sets(batches):
        for batch in batches:
            found = [np.unique(shingles(b" ".join(t.lower().split()), words_per_shingle)) for t in as_bytes(batch.column("text"))]
            n, packed = pa.array(map(len, found), pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), n, packed], names=["node", "n", "s"])

    return written(texts.mapInArrow(sets, "node long, n long, s binary"), "shingle_sets")


def similar(sets: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """The pairs whose shingle sets have a Jaccard similarity of ``least`` or more."""

    def judge(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("s"), batch.column("t")):
                x, y = (np.frombuffer(z.as_py(), np.uint64) for z in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True)) if least * max(len(x), len(y)) <= min(len(x), len(y)) else 0
                good.append(both >= least * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    first, second = sets.select(F.col("node").alias("a"), "s"), sets.select(F.col("node").alias("b"), F.col("s").alias("t"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "s", "t").mapInArrow(judge, "a long, b long")


def apart(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, root): the texts of large band values that hold more than one group; ``root`` names a text's group so far."""
    labelled = members.join(roots, "node", "left").select("value", "node", F.coalesce("root", "node").alias("root"))
    mixed = labelled.groupBy("value").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("value")
    return labelled.join(mixed, "value", "left_semi").select("node", "root").distinct()


def parity(h: np.ndarray) -> np.ndarray:
    """A bit is set if an odd number of the values fall on it.

    Two sets' parities differ in no more bits than the sets have values that only one of them holds.
    """
    bits = np.bincount((mix(h, _FACTORS[0]) >> np.uint64(32)) % np.uint64(64 * PARITY), minlength=64 * PARITY) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def parities(sets: DataFrame) -> DataFrame:
    """(node, parity) of (node, s)."""

    def run(batches):
        for batch in batches:
            found = [parity(np.frombuffer(x.as_py(), np.uint64)) for x in batch.column("s")]
            flat = pa.array(np.concatenate([*found, np.zeros(0, np.int64)]))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * PARITY, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column("node"), lists], names=["node", "parity"])

    return sets.select("node", "s").mapInArrow(run, "node long, parity array<long>")


def missed(sets: DataFrame, labels: DataFrame, least: float) -> DataFrame:
    """(a, b), a < b: all pairs of ``labels`` from different groups that may reach ``least``.

    Shingles are put in one order, rarest first.  Sets x and y, x not the larger, that reach
    ``least`` have ``2 * least / (1 + least)`` of x in common, and ``least`` of y; so they share
    one of the first shingles of each, all but that many and one more.  Shingles of one
    text alone are only counted.  A shingle whose texts are one group joins nothing, which
    keeps groups of copies from being paired; a frequent shingle's rows are split by Spark's skew join.

    Variants of one text share most of their shingles, also those far below ``least``.  Sets
    that reach it have at most ``(1 - least) / (1 + least)`` of their sizes' sum in one of
    them alone, and so their parities differ in no more bits.  The join makes only such pairs,
    which follow the texts at about ``least`` and not the square of the variants; of texts of
    some thousand shingles, parities tell little and the rarest shingles decide.
    """

    def listed(batches):
        for batch in batches:
            for piece in slices(batch, "s"):
                n = piece.column("n").to_numpy()
                tokens = np.concatenate([np.frombuffer(x, np.int64) for x in piece.column("s").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(piece.column(c).to_numpy(), n)) for c in ("node", "root", "n")] + [pa.array(tokens)],
                    names=["node", "root", "n", "token"],
                )

    rows = sets.join(labels, "node").select("node", "root", "n", "s").mapInArrow(listed, "node long, root long, n long, token long")
    common = rows.groupBy("token").agg(F.count("*").alias("texts")).filter("texts > 1")
    of_text = Window.partitionBy("node")
    place = F.col("n") - F.count("*").over(of_text) + F.row_number().over(of_text.orderBy("texts", "token"))
    ranked = rows.join(common, "token").withColumn("place", place)
    shared = lambda part: F.ceil(F.lit(part) * F.col("n") - 1e-9)
    first = ranked.filter(F.col("place") <= F.col("n") - shared(least) + 1).select(
        "token", "node", "root", "n", (F.col("place") <= F.col("n") - shared(2 * least / (1 + least)) + 1).alias("short"))
    first = written(first, "rare_shingles")
    mixed = first.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("token")
    first = first.join(mixed, "token", "left_semi")
    first = written(first.join(parities(sets.join(first.select("node").distinct(), "node", "left_semi")), "node"), "rare_shingles")
    x = first.filter("short").select("token", *[F.col(c).alias(f"x_{c}") for c in ("node", "root", "n", "parity")])
    ordered = (F.col("x_n") < F.col("n")) | ((F.col("x_n") == F.col("n")) & (F.col("x_node") < F.col("node")))
    near = ordered & (F.col("x_root") != F.col("root")) & (F.lit(least) * F.col("n") <= F.col("x_n") + 1e-9)
    differing = sum((F.bit_count(F.col("x_parity")[k].bitwiseXOR(F.col("parity")[k])) for k in range(PARITY)), F.lit(0))
    near &= differing <= F.lit((1 - least) / (1 + least)) * (F.col("x_n") + F.col("n")) + 1e-9
    return x.join(first, "token").filter(near).select(F.least("x_node", "node").alias("a"), F.greatest("x_node", "node").alias("b")).distinct()


def joined(roots: DataFrame, more: DataFrame, file_rows: int) -> DataFrame:
    """(node, root) after the pairs (a, b) of ``more`` join the groups of ``roots`` and texts that have none yet."""
    old = roots.select("node", F.col("root").alias("old"))
    ends = more.join(old.toDF("a", "x"), "a", "left").join(old.toDF("b", "y"), "b", "left")
    ends = ends.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")).filter("a <> b").distinct()
    new = components(ends, "similar", file_rows)
    moved = old.join(new.toDF("old", "new"), "old", "left").select("node", F.coalesce("new", "old").alias("root"))
    return moved.union(new.join(old, "node", "left_anti").select("node", "root"))


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 5, least: float = 0.8) -> DataFrame:
    """One row of each group of texts that chains of Jaccard similarity ``least`` or more join: that with the smallest id.

    NULL ids come last, then the text hash decides; rows with the same words are one text.
    Texts whose fingerprints differ in ``WIDE`` or fewer bits meet in the Gray index.  Any
    two texts at ``least`` or more share one of the MinHash bands with a probability of 0.99997
    or more; every pair that does is found, however many texts share the band.
    """
    digest = free_name(docs, "text_digest")
    keyed = docs.withColumn(digest, F.xxhash64(F.col(text_col)))
    plain = keyed.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(digest).alias("digest"))
    rows = sketches(plain, "text", words_per_shingle)
    # From here on a text is one row, however many copies it has.
    nodes = rows.groupBy("node").agg(F.any_value("fp").alias("fp"), F.any_value("bands").alias("bands"), F.min(_first("id", "digest")).alias("k"))
    nodes = written(nodes, "distinct_texts")
    found = written(candidates(nodes), "similar_candidates")
    pairs = written(indexed(nodes).union(found.filter("value IS NULL").select("a", "b")).distinct(), "similar_candidates")
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    one = nodes.join(asked, "node", "left_semi").select("node", "k.*")
    texts = plain.join(one, _same(one, "id", "digest")).select("node", "text").dropDuplicates(["node"])
    sets = shingle_sets(texts, words_per_shingle)
    links = written(similar(sets, pairs, least), "similar")
    roots = components(links, "similar", FILE_ROWS)
    members = found.filter("value IS NOT NULL").select(F.col("a").alias("node"), "value")
    others = written(missed(sets, apart(members, roots), least), "similar_missed")
    more = written(similar(sets, others, least), "similar_missed")
    if not more.isEmpty():
        roots = joined(roots, more, FILE_ROWS)
    found = nodes.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("k").alias("k"))
    return _first_rows(keyed, found.select("k.*"), id_col, digest)
