"""Byte-level BPE by prefix dynamic programming.

A sequence of tokens is what BPE makes of a piece exactly if each two neighbours are
what BPE makes of their joint bytes.  So every byte prefix of a piece has one valid last
token: the one that goes with the last token of the prefix before it.  The table of last
tokens is filled from left to right; reading it backwards gives the tokens of any
prefix.  It makes appending exact and cheap (the table of the old bytes stays), and after
an edit only the pieces around it are encoded again, until piece boundaries coincide.

In Spark this is a map over documents: nothing is shuffled, the rank table (about 50,000
entries) is broadcast, and each Python worker keeps a bounded memo of pieces.  The tokens
that end at a byte come from an Aho-Corasick automaton over the vocabulary.

Defined results: a NULL text is empty and has no tokens; equal rows have equal results;
columns named like an output are replaced, all others are passed on.  A piece that is a
rank itself is that token, whether or not merges lead to it.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from orderlens.llm.common import adding, slices, without

MEMO = 200_000  # pieces, and token pairs, of one generation that a worker remembers
PIECE = 256  # characters of the longest piece that is remembered


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class _Memo(dict):
    """Values made on first use, in two generations: what is used again outlives a full one.

    Longer keys than ``widest`` are not kept.
    """

    def __init__(self, make, most=MEMO, widest=None):
        super().__init__()
        self.make, self.most, self.widest, self.old = make, most, widest, {}

    def __missing__(self, key):
        if self.widest is not None and len(key) > self.widest:
            return self.make(key)
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class PrefixTable:
    """The valid last token of each byte prefix of one piece."""

    def __init__(self, coder: "Encoder", piece: bytes = b""):
        self.coder, self.piece = coder, b""
        self.last = [-1]
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Extends the table; what it holds stays valid."""
        begin = len(self.piece)
        self.piece += more
        last, valid, whole = self.last, self.coder.valid, self.coder.whole
        skip = max(0, begin + 1 - self.coder.longest)  # a token that ends behind ``begin`` starts here or later
        done = begin
        for at, (token, n) in self.coder.ending.iter(self.piece[skip:].decode("latin-1")):  # longest first at each end
            end = skip + at + 1
            if end > done:
                before = last[end - n]
                if valid[before, token] if before >= 0 else whole[token]:
                    last.append(token)
                    done = end

    def tokens(self, end: int | None = None) -> list[int]:
        """Tokens of the first ``end`` bytes."""
        end, out, length = len(self.piece) if end is None else end, [], self.coder.length
        while end:
            out.append(self.last[end])
            end -= length[out[-1]]
        return out[::-1]


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.length = {r: len(b) for b, r in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.ending = ahocorasick.Automaton()
        for data, rank in ranks.items():
            self.ending.add_word(data.decode("latin-1"), (rank, len(data)))
        self.ending.make_automaton()
        self.split = regex.compile(pattern).findall
        self.valid = _Memo(self._valid)
        self.whole = _Memo(lambda t: self.merged(self.bytes_of[t]) == [t])
        self.halves = _Memo(lambda t: tuple(self.merged(self.bytes_of[t], 2)))
        self.pieces = _Memo(self._piece, widest=PIECE)

    def merged(self, data: bytes, least: int = 1) -> list[int]:
        """Plain BPE: the neighbours with the lowest joint rank are merged until none, or ``least`` parts, are left."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > least:
            ranked = [(self.ranks.get(a + b), i) for i, (a, b) in enumerate(itertools.pairwise(parts))]
            best = min((r for r in ranked if r[0] is not None), default=None)
            if best is None:
                break
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _valid(self, pair: tuple[int, int]) -> bool:
        """Whether BPE of the joint bytes keeps both tokens: no merge across their border comes first.

        The merges beside the border are undone, latest first (of equal ranks the right one,
        as BPE works from the left).  What then meets at the border must not join before
        the merge just undone.
        """
        a, b = pair
        if not (self.whole[a] and self.whole[b]):
            return False
        data, length, x, y, before = self.bytes_of, self.length, a, b, float("inf")
        while True:
            if self.ranks.get(data[x] + data[y], before) < before:
                return False
            left = length[x] > 1 and (length[y] == 1 or x > y)
            if not left and length[y] == 1:
                return True
            undone = x if left else y
            halves = self.halves[undone]
            if any(length[h] > 1 and h > undone for h in halves):  # no trained order of merges: tried out
                return self.merged(data[a] + data[b]) == [a, b]
            if left:
                x, before = halves[1], undone
            else:
                y, before = halves[0], undone + 1

    def _piece(self, piece: str) -> bytes:
        data = piece.encode()
        token = self.ranks.get(data)
        return array("i", [token] if token is not None else PrefixTable(self, data).tokens()).tobytes()

    def packed(self, pieces: list[str]) -> np.ndarray:
        """Ids of pieces; longer ones than ``PIECE`` are encoded each time, so that the memo is bounded in bytes."""
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, pieces)), np.int32)

    def encode(self, text: str) -> list[int]:
        return self.packed(self.split(text)).tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class Encoded:
    """A text with its pieces, kept so that changes re-encode little."""

    MARGIN = 3  # characters behind a piece that its end may depend on

    def __init__(self, coder: Encoder, text: str = ""):
        self.coder, self.text, self.pieces, self.reencoded = coder, "", [], 0
        self.replace(0, 0, text)

    @property
    def ids(self) -> list[int]:
        return self.coder.packed(self.pieces).tolist()

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Text[start:end] becomes ``new``; pieces are split again from before the edit until boundaries meet."""
        ends = list(itertools.accumulate(map(len, self.pieces)))
        head = 0
        while head < len(ends) and ends[head] + self.MARGIN < start:
            head += 1
        at = ends[head - 1] if head else 0
        self.text = self.text[:start] + new + self.text[end:]
        grown = len(new) - (end - start)
        old = {e + grown: k for k, e in enumerate(ends) if e >= end}  # boundaries behind the edit, where they are now
        middle, rest = [], []
        for m in regex.finditer(self.coder.split.__self__, self.text, pos=at):
            middle.append(m.group())
            if m.end() in old:
                rest = self.pieces[old[m.end()] + 1:]
                break
        self.pieces = self.pieces[:head] + middle + rest
        self.reencoded = len(middle)


_CODERS: dict[str, Encoder] = {}


def _coder(table: Broadcast, pattern: str) -> Encoder:
    """This worker's encoder for a broadcast rank table."""
    ranks = table.value
    key = hashlib.sha256(repr((len(ranks), hash(frozenset(ranks.items())), pattern)).encode()).hexdigest()
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Encoder(ranks, pattern)
    return _CODERS[key]


def shared_ranks(spark: SparkSession, path: str) -> Broadcast:
    """The rank table, read on the driver; its size is that of the vocabulary file (under 1 MB)."""
    return spark.sparkContext.broadcast(load_ranks(path))


def encode(docs: DataFrame, ranks: Broadcast, pattern: str, text_col: str = "text") -> DataFrame:
    """The documents with ``n_tokens`` and ``ids``."""
    docs = without(docs, ["n_tokens", "ids"])

    def run(batches):
        coder = _coder(ranks, pattern)
        for batch in (part for b in batches for part in slices(b, text_col)):
            yield _with_ids(batch, [coder.packed(coder.split(t or "")) for t in batch.column(text_col).to_pylist()])

    return docs.mapInArrow(run, adding(docs, "n_tokens long, ids array<int>"))


def _with_ids(batch: pa.RecordBatch, ids: list[np.ndarray]) -> pa.RecordBatch:
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
    values = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
    return batch.append_column("n_tokens", pa.array(sizes)).append_column("ids", pa.ListArray.from_arrays(offsets, values))


def encode_checked(docs: DataFrame, ranks: Broadcast, pattern: str, text_col: str = "text") -> DataFrame:
    """The rows with ``n_tokens``, ``ids``, ``ids_sha256`` and ``round_trip`` in place of the text.

    ``round_trip`` tells whether the ids decode to the text's bytes.  Both ways are one map,
    in slices, so that a task has one worker with one encoder and holds one slice of texts.
    """
    docs = without(docs, ["n_tokens", "ids", "ids_sha256", "round_trip"])

    def run(batches):
        coder = _coder(ranks, pattern)
        for batch in (part for b in batches for part in slices(b, text_col)):
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            ids = [coder.packed(coder.split(t)) for t in texts]
            digest = [hashlib.sha256(",".join(map(str, x.tolist())).encode()).hexdigest() for x in ids]
            same = [coder.decode(x.tolist()) == t.encode() for x, t in zip(ids, texts)]
            batch = _with_ids(batch.drop_columns([text_col]), ids)
            yield batch.append_column("ids_sha256", pa.array(digest, pa.string())).append_column("round_trip", pa.array(same, pa.bool_()))

    return docs.mapInArrow(run, adding(docs.drop(text_col), "n_tokens long, ids array<int>, ids_sha256 string, round_trip boolean"))


def decode(encoded: DataFrame, ranks: Broadcast, pattern: str, ids_col: str = "ids") -> DataFrame:
    """The rows with ``decoded`` (bytes: a cut through a character is no error) and ``ids_sha256`` in place of the ids."""
    rest = without(encoded, [ids_col, "decoded", "ids_sha256"])
    encoded = encoded.select(*rest.columns, ids_col)

    def run(batches):
        coder = _coder(ranks, pattern)
        names = {i: str(i) for i in coder.bytes_of}
        for batch in batches:
            lists = batch.column(ids_col)
            flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            decoded, digest = [], []
            for a, b in itertools.pairwise(offsets.tolist()):
                ids = flat[a:b].tolist()
                decoded.append(coder.decode(ids))
                digest.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
            batch = batch.drop_columns([ids_col]).append_column("decoded", pa.array(decoded, pa.binary()))
            yield batch.append_column("ids_sha256", pa.array(digest, pa.string()))

    return encoded.mapInArrow(run, adding(rest, "decoded binary, ids_sha256 string"))
