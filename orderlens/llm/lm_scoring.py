"""Language-model scores by a weighted backoff automaton.

The model is a word n-gram model with Jelinek-Mercer smoothing,

    p(w | context) = a(context) * c(context w) / c(context) + (1 - a(context)) * p(w | shorter context)

with a(context) = trust * c(context) / (c(context) + 1), down to the unigrams
p(w) = (c(w) + 1) / (N + V + 1).  As an automaton: each seen context is a state; each
seen n-gram is an arc with its log-probability; the failure arc of a state, taken where
no arc fits, leads to the shorter context with weight log10(1 - a).  A text is read from
left to right; the state is carried from word to word and the weights are summed.

The model grows with the corpus, so it is not broadcast.  Documents are dealt into
chunks; a chunk sends each distinct n-gram once, with its count over the chunk's learning
documents, to the group of its fingerprint; groups add the counts up and send them back
in the same order; the chunk then has all arcs that its texts can take.  A frequent word
is one row per chunk.  Words and n-grams are 64-bit fingerprints.

Defined results: a NULL or blank text is its end token alone; an unknown word has the
unigram weight of count zero; if nothing is learnt from, N and V are zero and each token
has weight 0; equal rows have equal results; columns named like an output are replaced.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import adding, as_bytes, chunked, codes, free_name, mix, pack, unpack, without, written

END, START = np.uint64(1), np.uint64(2)
ADDED = "n_tokens long, n_known long, train_tokens long, base_score double, score double"


class _Grams:
    """The n-grams of a chunk's texts: for each order its fingerprint at each token."""

    def __init__(self, texts: list[bytes], order: int):
        words = [t.lower().split() for t in texts]  # A-Z only; split at \x20 and \x09-\x0D
        self.sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        tokens = codes(list(itertools.chain.from_iterable((*w, b"\n") for w in words)))
        ends = np.cumsum(self.sizes) - 1
        tokens[ends] = END
        first = np.r_[0, ends[:-1] + 1] if len(ends) else ends
        #: by order: the n-gram that ends at each token; by order: its context
        self.by, self.context = {1: tokens}, {}
        before = np.full(len(tokens), START)
        before[1:] = tokens[:-1]
        before[first] = START
        history = before
        for n in range(2, order + 1):
            self.context[n] = history
            self.by[n] = mix(history, tokens)
            older = np.full(len(tokens), START)
            older[1:] = history[:-1]
            older[first] = START
            history = mix(older, before)


def automaton_scores(grams: _Grams, counts: dict[int, np.ndarray], contexts: dict[int, np.ndarray], tokens: int, types: int, trust: float):
    """Base and model log10 weights of each token.

    ``counts[n]`` has the count of the n-gram that ends at each token, ``contexts[n]`` that of
    its context, the state; going up the orders gives each state its arc or failure arc.
    """
    floor = tokens + types + 1.0
    base = np.log10((counts[1] + 1.0) / floor)
    weight = base
    for n in range(2, max(counts) + 1):
        c, state = counts[n].astype(float), contexts[n].astype(float)
        share = trust * state / (state + 1.0)
        failure = np.log10(1.0 - share) + weight
        seen = c > 0
        arc = np.log10(share[seen] * c[seen] / state[seen] + 10.0 ** failure[seen])
        weight = failure.copy()
        weight[seen] = arc
    return base, weight


def score_texts(
    docs: DataFrame, learn_col: str, id_col: str = "doc_id", text_col: str = "text", order: int = 2, trust: float = 0.2,
    chunk_bytes: int = 4 << 20,
) -> DataFrame:
    """The rows without their text, with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Learns from the rows where the boolean ``learn_col`` is true.
    """
    docs = without(docs, ["n_tokens", "n_known", "train_tokens", "base_score", "score"])
    name = free_name(docs, "chunk_no")
    cut = chunked(docs, id_col, text_col, name, chunk_bytes)
    parts = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def blocks(gram: np.ndarray):
        """Distinct n-grams by (group, value), and each token's place among them."""
        distinct, place = np.unique(gram, return_inverse=True)
        edges = np.searchsorted(distinct, np.array([(k << 64) // parts for k in range(1, parts)], dtype=np.uint64))
        return distinct, place, [(k, a, b) for k, (a, b) in enumerate(itertools.pairwise([0, *edges.tolist(), len(distinct)])) if b > a]

    def ask(table: pa.Table) -> pa.Table:
        grams = _Grams(as_bytes(table.column(text_col)), order)
        learn = np.repeat(np.array([bool(x) for x in table.column(learn_col).to_pylist()]), grams.sizes)
        out = {"grp": [], "chunk": [], "gram": [], "n": []}
        chunk = table.column(name)[0].as_py()
        for n, gram in grams.by.items():
            distinct, place, cuts = blocks(gram)
            count = np.bincount(place[learn], minlength=len(distinct)).astype(np.int64)
            for k, a, b in cuts:
                out["grp"].append((n - 1) * parts + k)
                out["chunk"].append(chunk)
                out["gram"].append(pack(distinct[a:b]))
                out["n"].append(pack(count[a:b]))
        return pa.table({"grp": pa.array(out["grp"], pa.int64()), "chunk": pa.array(out["chunk"], pa.int64()),
                         "gram": pa.array(out["gram"], pa.binary()), "n": pa.array(out["n"], pa.binary())})

    def total(table: pa.Table) -> pa.Table:
        gram = [unpack(b) for b in table.column("gram").to_pylist()]
        n = np.concatenate([unpack(b, np.int64) for b in table.column("n").to_pylist()])
        distinct, place = np.unique(np.concatenate(gram), return_inverse=True)
        sums = np.zeros(len(distinct), np.int64)
        np.add.at(sums, place, n)
        back = [pack(x) for x in np.split(sums[place], np.cumsum([len(g) for g in gram])[:-1])]
        group = table.column("grp")[0].as_py()
        one = group < parts
        stats = [int(sums.sum()) if one else 0, int((sums > 0).sum()) if one else 0]
        size = table.num_rows
        return pa.table({
            "chunk": table.column("chunk").combine_chunks(), "grp": pa.array([group] * size, pa.int64()), "n": pa.array(back, pa.binary()),
            "tokens": pa.array([stats[0]] + [0] * (size - 1), pa.int64()), "types": pa.array([stats[1]] + [0] * (size - 1), pa.int64()),
        })

    asked = cut.groupBy(name).applyInArrow(ask, "grp long, chunk long, gram binary, n binary")
    told = written(asked.groupBy("grp").applyInArrow(total, "chunk long, grp long, n binary, tokens long, types long"), "gram_counts")
    sums = told.agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).first()
    tokens, types = sums["tokens"] or 0, sums["types"] or 0
    rest = docs.drop(text_col)

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        grams = _Grams(as_bytes(left.column(text_col)), order)
        back = dict(zip(right.column("grp").to_pylist(), right.column("n").to_pylist()))
        counts, contexts = {}, {}
        for n, gram in grams.by.items():
            distinct, place, cuts = blocks(gram)
            count = np.concatenate([unpack(back[(n - 1) * parts + k], np.int64) for k, a, b in cuts])
            counts[n] = count[place]
            if n == 1:
                learnt = int(count[np.searchsorted(distinct, END)])  # documents learnt from
        ends = np.cumsum(grams.sizes)
        begin = ends - grams.sizes
        for n in range(2, order + 1):
            state = np.full(len(counts[1]), learnt, np.int64)
            state[1:] = counts[n - 1][:-1]
            state[begin] = learnt
            contexts[n] = state
        base, weight = automaton_scores(grams, counts, contexts, tokens, types, trust)
        out = left.drop_columns([name, text_col])
        for column, values in (
            ("n_tokens", grams.sizes), ("n_known", np.add.reduceat((counts[1] > 0).astype(np.int64), begin)),
            ("train_tokens", np.full(len(begin), tokens, np.int64)),
            ("base_score", np.add.reduceat(base, begin)), ("score", np.add.reduceat(weight, begin)),
        ):
            out = out.append_column(column, pa.array(values))
        return out

    return cut.groupBy(name).cogroup(told.select("chunk", "grp", "n").groupBy("chunk")).applyInArrow(answer, adding(rest, ADDED))
