"""Benchmark decontamination with training suffix arrays.

About 4 MB of documents are a shard.  Its suffix array holds the word suffixes that can
match at all, in the order of their words; every benchmark suffix is binary-searched in
it, word by word, which narrows a range until the longest verbatim match is reached.
Where the match covers a window (``window`` words, or a whole shorter item), each
suffix in the range is an occurrence, and its words are hit.

Nothing is shuffled and no document leaves its task.  The benchmark is read in blocks
of bounded size; each block is one pass over the documents that carries the hits found
so far, so memory per task does not depend on the benchmark's size.

Defined results: a NULL or blank text has no words and is clean; an item without words
matches nothing; repeated items are separate items; a NULL item id is skipped, since it
cannot be reported; equal documents have equal results; columns named like an output are
replaced, all others are passed on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import adding, as_bytes, codes, slices, without

#: Every byte that separates words: ASCII that is neither a digit nor a letter.
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
SPACES = bytes.maketrans(SEPARATORS, b" " * len(SEPARATORS))
ADDED = "n_words long, n_hit long, items array<string>, matches array<struct<start:long,length:long,item_id:string,item_start:long>>"


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case (A-Z only), split at SEPARATORS."""
    return text.lower().translate(SPACES).split()


class TestSuffixes:
    """A block of benchmark items as word codes; windows begin at ``starts``."""

    __test__ = False

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        split = [(i, codes(words_of(t))) for i, t in items]
        self.items = [(i, c) for i, c in split if len(c)]
        self.window = window
        #: (item, position, words that a match needs)
        self.starts = [
            (k, p, min(window, len(c))) for k, (_, c) in enumerate(self.items) for p in range(max(1, len(c) - window + 1))
        ]
        self.depth = min([n for _, _, n in self.starts], default=0)
        self.depth = min(self.depth, 4)
        self.heads = np.unique(np.array([head(c[p: p + self.depth]) for k, p, _ in self.starts for c in [self.items[k][1]]], np.uint64))
        self.seen = np.zeros(1 << 16, bool)
        self.seen[self.heads >> np.uint64(48)] = True

    def candidates(self, heads: np.ndarray) -> np.ndarray:
        """Positions whose leading words are those of some test suffix."""
        at = np.flatnonzero(self.seen[heads >> np.uint64(48)])
        return at[np.isin(heads[at], self.heads)]


def head(c: np.ndarray) -> int:
    """One number for a few leading word codes."""
    x = 0
    for v in c.tolist():
        x = (x * 0x9E3779B97F4A7C15 + v) & 0xFFFFFFFFFFFFFFFF
    return x


def _heads(all_codes: np.ndarray, depth: int) -> np.ndarray:
    x = np.zeros(max(0, len(all_codes) - depth + 1), np.uint64)
    for k in range(depth):
        x = x * np.uint64(0x9E3779B97F4A7C15) + all_codes[k: k + len(x)]
    return x


class SuffixArray:
    """A shard's suffixes that share their first words with some test suffix, in word order.

    ``text`` holds the codes of all documents with a separator of a code of its own
    behind each, so no match runs across documents.
    """

    def __init__(self, text: np.ndarray, at: np.ndarray, depth: int):
        self.text, self.depth = np.r_[text, np.zeros(depth, np.uint64)], depth
        keys = [self.text[at + k] for k in range(depth)]
        self.at = at[np.lexsort(keys[::-1])] if len(at) else at

    def longest(self, query: np.ndarray) -> tuple[int, np.ndarray]:
        """Length of the longest match of a prefix of ``query`` and its positions."""
        low, high = 0, len(self.at)
        for k, word in enumerate(query[: self.depth]):
            column = self.text[self.at[low:high] + k] if high - low <= 64 else _Column(self, low, high, k)
            a, b = _bounds(column, word, high - low)
            if a == b:
                return k, self.at[low:high] if k else self.at[:0]
            low, high = low + a, low + b
        return min(len(query), self.depth), self.at[low:high]


class _Column:
    """The k-th words of a range of suffixes, read only where the binary search looks."""

    def __init__(self, array: SuffixArray, low: int, high: int, k: int):
        self.array, self.low, self.k = array, low, k

    def __getitem__(self, i: int):
        return self.array.text[self.array.at[self.low + i] + self.k]


def _bounds(column, word, n: int) -> tuple[int, int]:
    """The range of ``word`` in a sorted column of n words."""
    if isinstance(column, np.ndarray):
        return int(np.searchsorted(column, word, "left")), int(np.searchsorted(column, word, "right"))
    ends = []
    for right in (False, True):
        a, b = 0, n
        while a < b:
            m = (a + b) // 2
            if column[m] < word or (right and column[m] == word):
                a = m + 1
            else:
                b = m
        ends.append(a)
    return ends[0], ends[1]


def shard_matches(texts: list[bytes], tests: TestSuffixes):
    """Words per document, the first position of each, and (position, length, item, item position) of each match."""
    words = [words_of(t) for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    first = np.r_[0, np.cumsum(counts + 1)[:-1]].astype(np.int64)
    flat = [w for ws in words for w in (*ws, b"\x00")]  # no word holds this byte
    text = codes(flat)
    found = []
    if tests.starts:
        at = tests.candidates(_heads(text, tests.depth))
        array = SuffixArray(text, at, tests.window)
        if len(at):
            for k, p, need in tests.starts:
                n, where = array.longest(tests.items[k][1][p: p + tests.window])
                if n >= need:
                    found += [(int(w), n, k, p) for w in where]
    return counts, first, found


def match_benchmark(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = 13, block_bytes: int = 8 << 20,
) -> DataFrame:
    """The documents with ``n_words``, ``n_hit`` (words inside an occurring window), ``items`` and ``matches``.

    ``matches`` are maximal: neighbouring windows of one item are one longer match.
    """
    docs = without(docs, ["n_words", "n_hit", "items", "matches"])
    items = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(item_text_col).alias("t")).filter("i IS NOT NULL AND t IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    schema = adding(docs, ADDED)

    def one_pass(df: DataFrame, tests: TestSuffixes, is_first: bool) -> DataFrame:
        def run(batches):
            for batch in (part for b in batches for part in slices(b, text_col)):
                if is_first:
                    old = [[] for _ in range(batch.num_rows)]
                else:
                    old = batch.column("matches").to_pylist()
                    batch = batch.drop_columns(["n_words", "n_hit", "items", "matches"])
                counts, first, found = shard_matches(as_bytes(batch.column(text_col)), tests)
                found.sort(key=lambda m: (m[2], m[0] - m[3], m[0]))
                rows = np.searchsorted(first, [m[0] for m in found], "right") - 1
                new, last = [list(x) for x in old], None
                for (w, n, k, p), d in zip(found, rows.tolist()):
                    s = w - int(first[d])
                    if last and last[:3] == (d, k, s - p) and s <= last[3]["start"] + last[3]["length"]:
                        last[3]["length"] = s + n - last[3]["start"]
                        continue
                    m = {"start": s, "length": n, "item_id": tests.items[k][0], "item_start": p}
                    new[d].append(m)
                    last = (d, k, s - p, m)
                hit, names = [], []
                for d, ms in enumerate(new):
                    off = np.zeros(int(counts[d]), bool)
                    for m in ms:
                        off[m["start"]: m["start"] + m["length"]] = True
                    hit.append(int(off.sum()))
                    names.append(sorted({m["item_id"] for m in ms}))
                for name, values in zip(schema.names[-4:], (counts.tolist(), hit, names, new)):
                    kind = {"n_words": pa.int64(), "n_hit": pa.int64(), "items": pa.list_(pa.string())}.get(name) or pa.list_(
                        pa.struct([("start", pa.int64()), ("length", pa.int64()), ("item_id", pa.string()), ("item_start", pa.int64())]))
                    batch = batch.append_column(name, pa.array(values, kind))
                yield batch

        return df.mapInArrow(run, schema)

    out = docs
    for b in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
        tests = TestSuffixes([(r["i"], r["t"].encode()) for r in part.toLocalIterator()], window)
        out = one_pass(out, tests, b == 0)
    return out


def contaminated():
    """The contract's rule: at least one word in twenty is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    found = match_benchmark(docs, benchmark, **options)
    return found.filter(~contaminated()).select(*without(docs, ["n_words", "n_hit", "items", "matches"]).columns)
