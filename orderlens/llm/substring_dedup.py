"""Substring dedup by prefix-partitioned suffix trees.

Every word position of the corpus starts a suffix.  Suffixes are split into groups by
their leading words: a one-word prefix where few suffixes share it, a longer one (2, 4,
8, ... words) where a shorter prefix would make a group larger than a task's memory.
Each group is the subtree below its prefix.  The subtree is cut at depth ``length``: an
internal node at that depth with two or more suffixes is a repeat of at least ``length``
words, and all its suffixes but the first in (document, position) order are removed.
Neighbouring removals merge into maximal repeats, which are returned as spans.

What moves.  Documents are dealt into chunks once.  A chunk keeps, for each distinct
``length``-word path, the first suffix only (the others are repeats already), and sends
each group one row: the sorted path fingerprints and the document ids.  A passage that a
third of all documents share is therefore one suffix per chunk, not one per document.
The group answers with one bit per suffix, and the chunk, read again from the same
shuffle, applies them.  Paths are 64-bit fingerprints; two different paths can only be
taken for each other within one prefix group, so the number of groups, which grows with
the corpus, adds to those bits.

Defined results: a NULL text has no words; documents with fewer than ``length`` words
keep all of them; rows without an id come after all others, by text; of equal rows one
is first; columns named like an output are replaced, all others are passed on.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import (
    adding, as_bytes, chunked, codes, free_name, mix, pack, shifted, slices, sorted_rows, unpack, without,
)

BITS = 14
ADDED = "n_words long, n_removed long, kept_text string, spans array<struct<start:long,end:long>>"


def depths(length: int) -> list[int]:
    """The prefix lengths that are tried: powers of two below ``length``."""
    return [d for d in (1 << k for k in range(length.bit_length())) if d < length] or [length]


def paths(word_codes: np.ndarray, length: int) -> dict[int, np.ndarray]:
    """Fingerprints of the 1, 2, 4, ... and ``length`` words that start at each position."""
    out, full, done, d, cur = {}, None, 0, 1, word_codes
    while d <= length:
        out[d] = cur
        if length & d:
            full = cur if full is None else mix(full, shifted(cur, done))
            done += d
        if 2 * d <= length:
            cur = mix(cur, shifted(cur, d))
        d *= 2
    out[length] = full
    return out


def _starts(counts: np.ndarray, length: int) -> np.ndarray:
    """Positions at which a whole window of ``length`` words fits into its document."""
    ends = np.repeat(np.cumsum(counts), counts)
    return np.flatnonzero(ends - np.arange(len(ends)) >= length)


def _words(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    words = [t.split() for t in texts]  # bytes split at \x20 and \x09-\x0D, nothing else
    counts = np.fromiter(map(len, words), np.int64, len(words))
    return words, counts, codes(list(itertools.chain.from_iterable(words)))


def _bins(path: np.ndarray) -> np.ndarray:
    return (path >> np.uint64(64 - BITS)).astype(np.int64)


def prefix_counts(docs: DataFrame, text_col: str, length: int) -> DataFrame:
    """(depth, bin, n): suffixes by the hashed bin of their prefix, for each prefix length."""
    levels = depths(length)

    def count(batches):
        n = np.zeros((len(levels), 1 << BITS), np.int64)
        for batch in (part for b in batches for part in slices(b, "text")):
            _, counts, word_codes = _words(as_bytes(batch.column(0)))
            at = _starts(counts, length)
            by = paths(word_codes, length)
            for k, d in enumerate(levels):
                n[k] += np.bincount(_bins(by[d][at]), minlength=1 << BITS)
        k, b = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(b, pa.int32()), pa.array(n[k, b])], ["level", "bin", "n"])

    return (
        docs.select(F.col(text_col).alias("text")).mapInArrow(count, "level int, bin int, n long")
        .groupBy("level", "bin").agg(F.sum("n").alias("n"))
    )


class Prefixes:
    """Group of a suffix: the shortest prefix whose bin fits a group; beyond the last length, the path itself.

    The table has 2**14 bins for each of at most log2(length) lengths, whatever the corpus.
    """

    def __init__(self, counts: np.ndarray, length: int, most: int):
        self.length, self.levels, self.tables, used = length, depths(length), [], 0
        for row in counts:
            heavy = row > most
            group = used + (np.cumsum(np.where(heavy, 0, row)) // max(1, most))
            used = int(group.max()) + 1
            self.tables.append(np.where(heavy, -1, group))
            if not heavy.any():
                break
        self.used = used
        self.rest = max(1, -(-int(counts[0].sum()) // max(1, most)))

    def groups(self, by: dict[int, np.ndarray], at: np.ndarray) -> np.ndarray:
        out = np.full(len(at), -1, np.int64)
        for table, d in zip(self.tables, self.levels):
            open_ = np.flatnonzero(out < 0)
            if not len(open_):
                return out
            out[open_] = table[_bins(by[d][at[open_]])]
        open_ = np.flatnonzero(out < 0)
        out[open_] = self.used + (by[self.length][at[open_]] % np.uint64(self.rest)).astype(np.int64)
        return out


class _Chunk:
    """A chunk's suffixes: for each distinct path the first one, ordered by (group, path)."""

    def __init__(self, texts: list[bytes], prefixes: Prefixes):
        length = prefixes.length
        self.words, self.counts, word_codes = _words(texts)
        self.at = _starts(self.counts, length)
        by = paths(word_codes, length)
        path, first = np.unique(by[length][self.at], return_index=True)
        group = prefixes.groups(by, self.at[first])
        order = np.argsort(group, kind="stable")
        self.group, self.path, self.first = group[order], path[order], first[order]
        self.cuts = np.flatnonzero(np.r_[True, np.diff(self.group) != 0]) if len(order) else np.zeros(0, np.int64)

    def parts(self):
        """(group, where it begins, where it ends)"""
        for a, b in zip(self.cuts, np.r_[self.cuts[1:], len(self.group)]):
            yield int(self.group[a]), int(a), int(b)


def repeated(path: np.ndarray, doc: np.ndarray, chunk: np.ndarray) -> np.ndarray:
    """True for every suffix of a deep internal node but the first in (document, chunk) order."""
    order = np.argsort(path, kind="stable")
    same = path[order][1:] == path[order][:-1]
    inside = order[np.r_[same, False] | np.r_[False, same]]  # suffixes below a node with two or more
    inside = inside[np.lexsort((chunk[inside], doc[inside], path[inside]))]
    out = np.zeros(len(path), bool)
    if len(inside):
        out[inside[1:][path[inside][1:] == path[inside][:-1]]] = True
    return out


def dedup_substrings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 20,
    group_suffixes: int = 2_000_000, chunk_bytes: int = 4 << 20,
) -> DataFrame:
    """The documents with ``n_words``, ``n_removed``, ``kept_text`` and the removed ``spans`` (word positions).

    ``group_suffixes`` bounds a group (about 40 bytes each while it is sorted) and
    ``chunk_bytes`` the text of a chunk; results depend on neither.
    """
    docs = without(docs, ["n_words", "n_removed", "kept_text", "spans"])
    spark = docs.sparkSession
    counts = np.zeros((len(depths(length)), 1 << BITS), np.int64)
    for level, b, n in prefix_counts(docs, text_col, length).toLocalIterator():
        counts[level, b] = n
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    prefixes = Prefixes(counts, length, min(group_suffixes, max(1000, int(counts[0].sum()) // (2 * parts))))
    name = free_name(docs, "chunk_no")
    cut = chunked(docs, id_col, text_col, name, chunk_bytes)

    def ask(table: pa.Table) -> pa.Table:
        _, ids, texts = sorted_rows(table, id_col, text_col)
        c = _Chunk(texts, prefixes)
        doc = np.repeat(ids, c.counts)[c.at[c.first]] if len(c.at) else np.zeros(0, np.int64)
        rows = [(g, pack(c.path[a:b]), pack(doc[a:b])) for g, a, b in c.parts()]
        chunk = table.column(name)[0].as_py() if table.num_rows else 0
        return pa.table({
            "grp": pa.array([r[0] for r in rows], pa.int64()), "chunk": pa.array([chunk] * len(rows), pa.int64()),
            "path": pa.array([r[1] for r in rows], pa.binary()), "doc": pa.array([r[2] for r in rows], pa.binary()),
        })

    def subtree(table: pa.Table) -> pa.Table:
        path = [unpack(b) for b in table.column("path").to_pylist()]
        doc = np.concatenate([unpack(b, np.int64) for b in table.column("doc").to_pylist()])
        sizes = [len(p) for p in path]
        chunk = table.column("chunk").to_numpy()
        gone = repeated(np.concatenate(path), doc, np.repeat(chunk, sizes))
        bits = [np.packbits(x) if x.any() else None for x in np.split(gone, np.cumsum(sizes)[:-1])]
        hit = [i for i, x in enumerate(bits) if x is not None]
        return pa.table({
            "chunk": pa.array(chunk[hit], pa.int64()), "grp": table.column("grp").take(pa.array(hit, pa.int64())).combine_chunks(),
            "bits": pa.array([bits[i].tobytes() for i in hit], pa.binary()),
        })

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, _, texts = sorted_rows(left, id_col, text_col)
        c = _Chunk(texts, prefixes)
        bits = dict(zip(right.column("grp").to_pylist(), right.column("bits").to_pylist()))
        gone = np.ones(len(c.at), bool)  # a suffix whose path was in this chunk before
        for g, a, b in c.parts():
            n = b - a
            gone[c.first[a:b]] = np.unpackbits(np.frombuffer(bits[g], np.uint8), count=n).astype(bool) if g in bits else False
        total = int(c.counts.sum())
        edge = np.zeros(total + 1, np.int64)
        at = c.at[gone]
        edge[: total] += np.bincount(at, minlength=total)[:total]
        edge -= np.bincount(at + length, minlength=total + 1)
        covered = np.cumsum(edge)[:total] > 0
        removed, kept, spans, o = [], [], [], 0
        for words, n in zip(c.words, c.counts):
            off = covered[o: o + n]
            k = int(off.sum())
            removed.append(k)
            if k:
                kept.append(b" ".join(itertools.compress(words, (~off).tolist())))
                turn = np.flatnonzero(np.diff(np.r_[False, off, False].astype(np.int8)))
                spans.append([{"start": int(s), "end": int(e)} for s, e in turn.reshape(-1, 2)])
            else:
                kept.append(b" ".join(words))
                spans.append([])
            o += n
        out = rows.drop_columns([name])
        for column, values in (
            ("n_words", pa.array(c.counts, pa.int64())), ("n_removed", pa.array(removed, pa.int64())),
            ("kept_text", pa.array(kept, pa.binary()).cast(pa.string())),
            ("spans", pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))),
        ):
            out = out.append_column(column, values)
        return out

    asked = cut.groupBy(name).applyInArrow(ask, "grp long, chunk long, path binary, doc binary")
    told = asked.groupBy("grp").applyInArrow(subtree, "chunk long, grp long, bits binary")
    return cut.groupBy(name).cogroup(told.groupBy("chunk")).applyInArrow(answer, adding(docs, ADDED))
