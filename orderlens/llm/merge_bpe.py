"""BPE by a priority queue of merges over a doubly linked list of symbols.

A piece starts as one symbol per byte, linked to its neighbours.  Every pair of neighbours
that may merge waits in a heap under (rank, position).  The least entry is taken; it is
skipped if it is stale, that is if its left symbol is gone or its pair no longer makes the
same token.  Otherwise the right symbol is unlinked and the two pairs around the new symbol
are queued.  A piece of n bytes takes O(n log n) steps, so one long piece is no special case.
Decoding concatenates the vocabulary's strings.

The vocabulary is a ``tokenizers`` file of byte-level BPE (vocabulary, merges, added tokens);
one with a normalizer, a prefix space or added tokens with stripping flags is refused.  Added
tokens are found in the text first, leftmost and then longest, and are single ids.

In Spark this is a map over documents: nothing is shuffled, the vocabulary (about 50,000
entries) is broadcast and each Python worker keeps a bounded memo of short pieces.

Defined results: a NULL text is empty and has no tokens; equal rows have equal results; an
empty table gives an empty table; columns named like an output are replaced, all others are
passed on.  Decoded ids that the vocabulary lacks are left out; bytes that are no UTF-8
become U+FFFD.
"""

from __future__ import annotations

import heapq
import itertools
import json
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from orderlens.llm.byte_bpe import _Memo
from orderlens.llm.common import adding, slices, without

PIECE = 128  # characters of the longest piece that is remembered
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Letters and numbers of later Unicode versions than 16, whose tables the vocabulary's
# library has, as first and last code point; there they count as neither.
LATER = (
    (0x0558, 0x0558), (0x058B, 0x058C), (0x088F, 0x088F), (0x0C5C, 0x0C5C), (0x0CDC, 0x0CDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
_LATER = regex.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in LATER) + "]")


def byte_names() -> dict[str, int]:
    """The characters that stand for bytes in byte-level files: printable ones for themselves, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


@dataclass(frozen=True)
class Vocabulary:
    ids: dict[str, int]  #: token as written in the file → id
    merges: list[tuple[str, str]]  #: by rank
    added: dict[str, int]  #: added tokens, matched in the text


def load_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, pre = file["model"], file.get("pre_tokenizer") or {}
    plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    split = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    added = file.get("added_tokens") or []
    if model.get("type") != "BPE" or not plain or not split or file.get("normalizer"):
        raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
    if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"added tokens with conditions: {path}")
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return Vocabulary(model["vocab"], merges, {t["content"]: t["id"] for t in added})


class Coder:
    def __init__(self, vocabulary: Vocabulary):
        ids, names = vocabulary.ids, byte_names()
        self.base = [-1] * 256
        for char, byte in names.items():
            self.base[byte] = ids[char]
        self.width = 1 + max(ids.values(), default=0)
        self.made = [ids[a + b] for a, b in vocabulary.merges]  # rank → new token
        self.rank = {ids[a] * self.width + ids[b]: k for k, (a, b) in reversed(list(enumerate(vocabulary.merges)))}
        self.bytes_of = {
            i: bytes(map(names.__getitem__, t)) if all(c in names for c in t) else t.encode() for t, i in ids.items()
        } | {i: t.encode() for t, i in vocabulary.added.items()}
        self.added = vocabulary.added
        longest_first = sorted(vocabulary.added, key=lambda t: (-len(t), t))
        self.marks = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self.findall, self.finditer = regex.compile(SPLIT).findall, regex.compile(SPLIT).finditer
        self.memo = _Memo(self._piece, widest=PIECE)

    def merge(self, data: bytes) -> list[int]:
        """Tokens of one piece."""
        symbols = [self.base[b] for b in data]
        n, width, rank, made = len(symbols), self.width, self.rank, self.made
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        bits = n.bit_length()
        mask = (1 << bits) - 1
        waiting = [
            r << bits | i for i in range(n - 1) if (r := rank.get(symbols[i] * width + symbols[i + 1])) is not None
        ]
        heapq.heapify(waiting)
        while waiting:
            entry = heapq.heappop(waiting)
            at = entry & mask
            left, right = symbols[at], after[at]
            if left < 0 or right >= n:
                continue
            now = rank.get(left * width + symbols[right])
            if now is None or made[now] != (token := made[entry >> bits]):
                continue
            symbols[at], symbols[right] = token, -1
            after[at] = behind = after[right]
            if behind < n:
                before[behind] = at
                if (r := rank.get(token * width + symbols[behind])) is not None:
                    heapq.heappush(waiting, r << bits | at)
            ahead = before[at]
            if ahead >= 0 and (r := rank.get(symbols[ahead] * width + token)) is not None:
                heapq.heappush(waiting, r << bits | ahead)
        return [s for s in symbols if s >= 0]

    def _piece(self, piece: str) -> bytes:
        return array("i", self.merge(piece.encode())).tobytes()

    def pieces(self, text: str, later: bool = True) -> list[str]:
        """The text cut where no merge reaches over; ``later`` is false where it is known to have no character of ``LATER``."""
        if later and _LATER.search(text):
            # A private-use character stands for each: it is neither letter, number nor space.
            return [text[m.start():m.end()] for m in self.finditer(_LATER.sub("\ue000", text))]
        return self.findall(text)

    def packed(self, text: str, later: bool = True) -> bytes:
        """The ids as 32-bit numbers."""
        if self.marks is None or not self.marks.search(text):
            return b"".join(map(self.memo.__getitem__, self.pieces(text, later)))
        out = []
        for k, part in enumerate(self.marks.split(text)):
            out.append(array("i", [self.added[part]]).tobytes() if k % 2 else b"".join(map(self.memo.__getitem__, self.pieces(part, later))))
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def decode(self, ids) -> str:
        of = self.bytes_of
        return b"".join([of.get(i, b"") for i in ids]).decode("utf-8", "replace")


_LAST: list = []


def _coder(shared: Broadcast) -> Coder:
    """This worker's coder for a broadcast vocabulary, kept with its memo while tasks use the same one."""
    if not _LAST or _LAST[0] is not shared.value:
        _LAST[:] = [shared.value, Coder(shared.value)]
    return _LAST[1]


def share(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary, read on the driver; its size is that of the file (2 MB for 50,000 tokens)."""
    return spark.sparkContext.broadcast(load_vocabulary(path))


def _reaches_later(texts: pa.Array) -> bool:
    """Whether a UTF-8 column may hold a character of ``LATER``: only they have a byte of 0xD5 or more."""
    data = texts.buffers()[-1]
    return data is not None and len(data) > 0 and int(np.frombuffer(data, np.uint8).max()) >= 0xD5


def encode(docs: DataFrame, shared: Broadcast, text_col: str = "text") -> DataFrame:
    """The documents with ``n_tokens`` and ``ids``."""
    docs = without(docs, [c for c in ("n_tokens", "ids") if c != text_col])

    def run(batches):
        coder = _coder(shared)
        for batch in batches:
            later = _reaches_later(batch.column(text_col))
            for part in slices(batch, text_col):
                ids = [coder.packed(t or "", later) for t in part.column(text_col).to_pylist()]
                sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
                values = pa.array(np.frombuffer(b"".join(ids), np.int32))
                yield part.append_column("n_tokens", pa.array(sizes)).append_column("ids", pa.ListArray.from_arrays(offsets, values))

    return docs.mapInArrow(run, adding(docs, "n_tokens long, ids array<int>"))


def decode(encoded: DataFrame, shared: Broadcast, ids_col: str = "ids") -> DataFrame:
    """The rows with ``decoded`` in place of the ids; NULL ids decode to an empty text."""
    rest = without(encoded, [ids_col, "decoded"])
    encoded = encoded.select(*[f"`{c}`" for c in rest.columns], f"`{ids_col}`")

    def run(batches):
        coder = _coder(shared)
        for batch in batches:
            lists = batch.column(ids_col)
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_pylist()
            texts = [coder.decode(flat[a:b].tolist()) for a, b in itertools.pairwise(ends)]
            yield batch.drop_columns([ids_col]).append_column("decoded", pa.array(texts, pa.string()))

    return encoded.mapInArrow(run, adding(rest, "decoded string"))
