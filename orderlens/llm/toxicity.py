"""Toxicity of deobfuscated text: a noisy-channel decoder, then a small classifier.

Decoding.  What looks disguised becomes a lattice: digits or signs among letters, letters
repeated three times or more, and three or more single characters set apart by spaces or
separators, of any length and in any mixture.  Each character may be itself, a letter it
resembles, or nothing (a separator or a repetition).  Viterbi picks the reading with the
best sum of channel costs and a character trigram model, in time linear in the length, and
the text is scored as if it had been written so.  Whether a token is disguised is asked once
for each token that a worker does not remember.

Scoring.  Features are words and word beginnings of four and five letters (toxic stems
take many endings).  Those that are significantly more frequent in toxic documents are
kept with their log-odds; a document's hits make three numbers, on which a logistic
model is fit.

Scale.  The character counts, the features' counts and the logistic model come from all
labelled documents.  Texts meet their labels in a join, once; counts are summed in Spark,
and each Newton step is one sum over the documents' numbers.  What comes to the driver,
and is shipped to the tasks, is the model: the distinct trigrams of letters, the features
that pass the test, and sums.  Every document is scored whole, in a map without a shuffle.

Defined results: a NULL text is empty; a text without features gets the model's base
rate; without labels of both classes the score is the share of toxic labels (0 if none);
NULL labels are ignored; equal texts have equal scores; columns named like an output are
replaced, all others are passed on.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.byte_bpe import _Memo
from orderlens.llm.common import adding, slices, without, written

#: Signs and the letters they stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c",
}
SEPARATORS = " .-_*"
#: Channel costs (log10).
SUBSTITUTE, KEEP_SIGN, DROP_REPEAT, DROP_SEPARATOR = -0.3, -3.0, -0.2, -0.1

WORD = re.compile(r"[^\W\d_]+")
LETTER = re.compile(r"[^\W\d_]")
_SIGN = re.escape("".join(LOOKS_LIKE))
_APART = re.escape(SEPARATORS.strip())
TRIPLE = re.compile(r"([^\W\d_])\1\1")
PIECES = re.compile(rf"[\w{_SIGN}]+")
#: Single characters between separators, three or more.
SET_APART = re.compile(rf"[^\s\w]*((?:[^\W_]|[{_SIGN}])(?:[{_APART}]+(?:[^\W_]|[{_SIGN}])){{2,}})[^\s\w]*")
TOKEN = 64  # characters of the longest token that is remembered
EDGES = ".,;:?'\""  # punctuation that is part of no disguise of a token of letters
KEYS = 300_000  # counted keys that a task holds before it hands them on


class CharModel:
    """Character trigrams with backoff; words stand between ``^`` and ``$``."""

    def __init__(self, counts: Counter):
        self.tri, self.bi, self.one, self.middle = Counter(), Counter(), Counter(), Counter()
        for gram, n in counts.items():
            self.tri[gram] += n
            self.bi[gram[:2]] += n
            self.one[gram[2]] += n
            self.middle[gram[1]] += n
        self.followers = Counter()
        for gram, n in self.tri.items():
            self.followers[gram[1:]] += n
        self.total = sum(self.one.values()) + 1000
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def log10(self, context: str, c: str) -> float:
        found = self.known.get(context + c)
        if found is None:
            if len(self.known) > 500_000:
                self.known.clear()
            found = self.known[context + c] = self._log10(context, c)
        return found

    def _log10(self, context: str, c: str) -> float:
        uni = (self.one[c] + 1) / self.total
        low = (self.followers[context[1] + c] + 5 * uni) / (self.middle[context[1]] + 5)
        return math.log10((self.tri[context + c] + 5 * low) / (self.bi[context] + 5))


def trigrams(word: str) -> list[str]:
    line = f"^^{word}$"
    return [line[i:i + 3] for i in range(len(line) - 2)]


def restore(token: str, model: CharModel) -> str:
    """The most likely word behind a disguised token."""
    best = {("^^", ""): (0.0, None)}  # (last two characters, observed character before) -> (score, letters, linked backwards)
    log10 = model.log10
    for c in token.lower():
        if c in SEPARATORS or c.isspace():
            options = [("", DROP_SEPARATOR)]
        else:
            options = [(x, SUBSTITUTE) for x in LOOKS_LIKE.get(c, "")]
            options.append((c, KEEP_SIGN if c in LOOKS_LIKE else 0.0))
        new = {}
        for (last, seen), (score, word) in best.items():
            for out, cost in [*options, ("", DROP_REPEAT)] if c == seen else options:
                s = score + cost
                if out:
                    s += log10(last, out)
                    key, letters = (last[1] + out, c), (out, word)
                else:
                    key, letters = (last, c if c not in SEPARATORS else seen), word
                if key not in new or s > new[key][0]:
                    new[key] = (s, letters)
        best = new
    ends = [(s + log10(last, "$"), last, seen, word) for (last, seen), (s, word) in best.items()]
    word, out = max(ends, key=lambda e: e[:3])[3], []
    while word:
        out.append(word[0])
        word = word[1]
    return "".join(reversed(out))


def disguised(token: str) -> list[str] | None:
    """The pieces of a token that the lattice reads; None where it is plain."""
    apart = SET_APART.fullmatch(token)
    if apart and LETTER.search(apart.group(1)):
        return [apart.group(1)]
    found, any_ = [], False
    for piece in PIECES.findall(token):
        core = piece.lstrip("(").rstrip("!|+(")  # at the ends these are punctuation
        mixed = len(core) >= 3 and LETTER.search(core) and any(c in LOOKS_LIKE for c in core)
        any_ |= bool(mixed or TRIPLE.search(core))
        found.append(core if mixed or TRIPLE.search(core) else piece)
    return found if any_ else None


def single(token: str) -> bool:
    """One character that may be a letter, with or without a separator behind it, or a separator alone."""
    if len(token) == 2 and token[1] not in SEPARATORS:
        return False
    return token[0].isalpha() or token[0] in LOOKS_LIKE or token in SEPARATORS


def features(word: str) -> tuple[str, ...]:
    if len(word) < 4:
        return (f"={word}",)
    return (f"={word}", f"^{word[:4]}", f"^{word[:5]}") if len(word) > 4 else (f"={word}", f"^{word}")


def _runs(places: list[int]) -> list[tuple[int, int]]:
    """Begin and end of each three or more numbers in a row."""
    out, begin = [], 0
    for i in range(1, len(places) + 1):
        if i == len(places) or places[i] != places[i - 1] + 1:
            if i - begin >= 3:
                out.append((places[begin], places[i - 1] + 1))
            begin = i
    return out


@dataclass
class Model:
    chars: CharModel | None = None
    weights: dict[str, float] = field(default_factory=dict)
    coef: list[float] = field(default_factory=list)
    rate: float = 0.0

    def __post_init__(self):
        self._words = _Memo(self._token_words, widest=TOKEN)
        self._whole = {f[1:] for f in self.weights if f[0] == "="}
        self._starts = {f[1:5] for f in self.weights if f[0] == "^"}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_words", "_whole", "_starts")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def _token_words(self, token: str) -> tuple[str, ...]:
        low = token.lower().strip(EDGES)
        if low.isalpha() and not TRIPLE.search(token):  # nothing for the lattice: most tokens
            return (low,)
        pieces = disguised(token) if self.chars else None
        if pieces is None:
            return tuple(WORD.findall(token.lower()))
        read = (restore(p, self.chars) if any(c in LOOKS_LIKE or c in SEPARATORS for c in p) or TRIPLE.search(p) else p.lower() for p in pieces)
        return tuple(w for r in read for w in WORD.findall(r))

    def words(self, text: str) -> list[str]:
        """Lower-case words of the restored text."""
        tokens = text.split()
        if self.chars:
            short = _runs([i for i, n in enumerate(map(len, tokens)) if n <= 2])
            for begin, end in reversed(_runs([i for a, b in short for i in range(a, b) if single(tokens[i])])):
                signs = [t for t in tokens[begin:end] if t not in SEPARATORS]
                if len(signs) >= 3 and any(t[0].isalpha() for t in signs):
                    tokens[begin:end] = [restore(" ".join(tokens[begin:end]), self.chars)]
        return list(itertools.chain.from_iterable(map(self._words.__getitem__, tokens)))

    def numbers(self, text: str) -> tuple[float, float, float]:
        """Distinct hits (log), the largest log-odds, and hits per root of the words."""
        words = self.words(text)
        near = [w for w in set(words) if w[:4] in self._starts or w in self._whole]
        hits = [w for w in (max(self.weights.get(f, 0.0) for f in features(n)) for n in near) if w > 0]
        return math.log1p(len(hits)), max(hits, default=0.0), len(hits) / math.sqrt(len(words) + 1)

    def score(self, text: str) -> float:
        if not self.coef:
            return self.rate
        x = self.coef[0] + sum(c * v for c, v in zip(self.coef[1:], self.numbers(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _logistic(rows: DataFrame, ridge: float = 0.1) -> list[float]:
    """Logistic regression of ``y`` on ``a``, ``b`` and ``c`` over all rows by Newton steps, each one sum in Spark."""
    x = [F.lit(1.0), F.col("a"), F.col("b"), F.col("c")]
    upper = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    coef = np.zeros(len(x))
    for _ in range(30):
        at = sum((F.lit(float(k)) * v for k, v in zip(coef, x)), F.lit(0.0))
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), at))))
        held = rows.select("y", "a", "b", "c", p.alias("p"))
        curve = [F.sum(x[i] * x[j] * F.col("p") * (1 - F.col("p"))) for i, j in upper]
        slope = [F.sum(v * (F.col("y") - F.col("p"))) for v in x]
        sums = np.array(held.agg(*[v.alias(f"s{k}") for k, v in enumerate(curve + slope)]).first(), float)
        h = np.zeros((len(x), len(x)))
        for (i, j), v in zip(upper, sums):
            h[i, j] = h[j, i] = v
        step = np.linalg.solve(h + ridge * np.eye(len(x)), sums[len(upper):] - ridge * coef)
        coef = coef + step
        if np.abs(step).max() < 1e-9:
            break
    return coef.tolist()


def _counted(column: Column, name: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).alias(name)


def char_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(g, n): how often each trigram stands in the words of all texts."""

    def run(batches):
        words = Counter()

        def spelled():
            n = Counter()
            for w, k in words.items():
                for g in trigrams(w):
                    n[g] += k
            words.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["g", "n"])

        for batch in batches:
            for t in batch.column(text_col).to_pylist():
                words.update(WORD.findall((t or "").lower()))
                if len(words) > KEYS:
                    yield spelled()
        yield spelled()

    return texts.select(text_col).mapInArrow(run, "g string, n long").groupBy("g").agg(F.sum("n").alias("n"))


def feature_counts(texts: DataFrame, model: Model) -> DataFrame:
    """(f, c, t): in how many clean and toxic texts of (y, text) each feature stands."""

    def run(batches):
        # Whole words, their first four and their first five letters, for either class.
        found = [[Counter() for _ in range(3)] for _ in range(2)]

        def handed():
            for y, kinds in enumerate(found):
                for sign, n in zip("=^^", kinds):
                    counts, none = pa.array(list(n.values()), pa.int64()), pa.array(np.zeros(len(n), np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array([sign + k for k in n], pa.string()), *([none, counts] if y else [counts, none])], ["f", "c", "t"])
                    n.clear()

        for batch in batches:
            for y, t in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist()):
                words, kinds = set(model.words(t or "")), found[y]
                kinds[0].update(words)
                kinds[1].update({w[:4] for w in words if len(w) > 3})
                kinds[2].update({w[:5] for w in words if len(w) > 4})
                if sum(map(len, itertools.chain(*found))) > KEYS:
                    yield from handed()
        yield from handed()

    return texts.select("y", "text").mapInArrow(run, "f string, c long, t long").groupBy("f").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", z: float = 6.0, least_odds: float = 2.0,
) -> Model:
    """The model from all labelled documents."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("id IS NOT NULL AND y IN (0, 1)")
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    model = Model(rate=sizes.get(1, 0) / total if total else 0.0)
    if len(sizes) < 2:
        return model
    # Labels grow with the documents, so they are never broadcast.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(known.hint("merge"), "id").select("y", "text")
    texts = written(texts, "toxicity_texts")
    model.chars = CharModel(Counter({r["g"]: r["n"] for r in char_counts(texts).collect()}))

    clean, bad = texts.agg(_counted(1 - F.col("y"), "clean"), _counted(F.col("y"), "bad")).first()
    if not clean or not bad:
        return model
    c, t, share = F.col("c"), F.col("t"), bad / (clean + bad)
    odds = F.log((t + 0.5) / (bad + 1)) - F.log((c + 0.5) / (clean + 1))
    telling = (t >= 5) & (odds >= least_odds) & (t - (t + c) * share >= z * F.sqrt((t + c) * share * (1 - share)))
    weights = feature_counts(texts, model).filter(telling).select("f", odds.alias("odds"))
    model = Model(model.chars, {r["f"]: r["odds"] for r in weights.collect()}, rate=model.rate)

    def numbers(batches):
        for batch in batches:
            rows = [(y, *model.numbers(t or "")) for y, t in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.float64()) for k in range(4)], ["y", "a", "b", "c"])

    model.coef = _logistic(written(texts.mapInArrow(numbers, "y double, a double, b double, c double"), "toxicity_numbers"))
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows without their text, with ``score``."""
    docs = without(docs, ["score"])

    def run(batches):
        for batch in (part for b in batches for part in slices(b, text_col)):
            s = pa.array([model.score(t or "") for t in batch.column(text_col).to_pylist()], pa.float64())
            yield batch.drop_columns([text_col]).append_column("score", s)

    return docs.mapInArrow(run, adding(docs.drop(text_col), "score double"))
