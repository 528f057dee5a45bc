"""The lattice decoder against an enumeration of readings; disguises of any length and mixture."""

import itertools
import math
import os
import pickle
import random
import zlib

import numpy as np
import pytest

from orderlens.llm import queries, toxicity

FOLDER = os.environ.get("SUITE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def model():
    words = ["idiot"] * 30 + ["stupid"] * 30 + ["die"] * 20 + ["worthless", "the", "weather", "seems", "fine", "today", "dog", "good"] * 15
    counts = toxicity.Counter(g for w in words for g in toxicity.trigrams(w))
    return toxicity.Model(chars=toxicity.CharModel(counts))


def readings(token):
    """(score of the channel, letters) of every reading of a token."""
    options, seen = [], None
    for c in token.lower():
        if c in toxicity.SEPARATORS:
            options.append([("", toxicity.DROP_SEPARATOR)])
            continue
        own = [(x, toxicity.SUBSTITUTE) for x in toxicity.LOOKS_LIKE.get(c, "")] + [(c, toxicity.KEEP_SIGN if c in toxicity.LOOKS_LIKE else 0.0)]
        options.append(own + ([("", toxicity.DROP_REPEAT)] if c == seen else []))
        seen = c
    for choice in itertools.product(*options):
        yield sum(s for _, s in choice), "".join(x for x, _ in choice)


def test_viterbi_finds_the_best_of_all_readings(model):
    def value(cost, word):
        line = f"^^{word}$"
        return cost + sum(model.chars.log10(line[i:i + 2], line[i + 2]) for i in range(len(line) - 2))

    r = random.Random(1)
    for _ in range(300):
        token = "".join(r.choice("idots1053 -ii00dd!") for _ in range(r.randint(1, 7)))
        best = max(value(cost, word) for cost, word in readings(token))
        found = toxicity.restore(token, model.chars)
        assert max(value(cost, word) for cost, word in readings(token) if word == found) == pytest.approx(best), token


@pytest.mark.parametrize("text,word", [
    ("i d 1 o t", "idiot"), ("1 d 1 0 t", "idiot"), ("d i e", "die"), ("s-t-u-p-1-d", "stupid"), ("id1" + "0" * 40 + "t", "idiot"), ("you i.d.i.o.t, you", "idiot"),
    ("s" * 30 + "tupid", "stupid"), ("w0rthle$$!", "worthless"), ("so (1diot) so", "idiot"), ("s _ t _ u p 1 d", "stupid"), ("d-i-e", "die"),
])
def test_disguises_of_any_length(model, text, word):
    assert word in model.words(text)


def test_plain_text_is_left_alone(model):
    text = "The weather seems fine today, on 2024-01-05 at 10:30! It costs 1 2 3 and a b; call 555-1234."
    assert model.words(text) == toxicity.WORD.findall(text.lower())
    assert model.words("") == [] and model.words(" \t\n") == []
    assert len(model.words("1 a " * 50_000)) == 1  # one run, in linear time
    assert pickle.loads(pickle.dumps(model)).words("st0p 1d10t") == model.words("st0p 1d10t")


def test_query_columns(spark):
    rows = queries.QUERIES["op6_toxicity"](spark, FOLDER).collect()
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect())
    assert sorted(r.doc_id for r in rows) == ids
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_ties_and_odd_rows(spark):
    rows = [(i, "you are a stupid idiot " + "abcdefgh"[i % 8] if i % 2 else "the weather is fine " + "abcdefgh"[i % 8]) for i in range(400)]
    df = spark.createDataFrame([(*r, 9.0, "m") for r in rows] + [(None, None, 1.0, "m"), (7, "", 1.0, "m"), (7, "", 1.0, "m"), (8, "you are a stup1d 1 d 1 0 t a", 1.0, "m"), (401, "1d10t " * 20_000, 1.0, "m")],
                               "doc_id long, text string, score double, words string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(None, 1), (5, None), (6, 7)], "doc_id long, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), labels)
    got = toxicity.score(df, model)
    assert got.columns == ["doc_id", "words", "score"]
    found = got.collect()
    assert len(found) == 405
    empty = {r.score for r in found if r.doc_id is None} | {min(r.score for r in found if r.doc_id == 7)}
    assert len(empty) == 1  # NULL and empty texts alike
    assert max(r.score for r in found if r.doc_id == 8) > 0.5 > max(r.score for r in found if r.doc_id == 2)
    assert toxicity.score(df.limit(0), model).collect() == []


def test_all_labelled_documents_are_learnt_from(spark):
    """Counts, features and coefficients of 9,000 documents of either class, against a plain fit on all of them."""
    tails = ["alpha", "beta", "gamma", "delta", "omega"]
    texts = [("wretched fool " if i % 2 and i % 7 else "pleasant weather ") + tails[i % 5] + " q" * (i % 3) for i in range(18_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(texts))], "doc_id long, toxic int")
    chars = toxicity.Counter(g for t in texts for w in toxicity.WORD.findall(t) for g in toxicity.trigrams(w))
    model = toxicity.fit(df, labels)
    assert model.chars.tri == chars

    seen = [toxicity.Counter(), toxicity.Counter()]
    for i, t in enumerate(texts):
        seen[i % 2].update({f for w in set(model.words(t)) for f in toxicity.features(w)})
    frame = df.join(labels, "doc_id").withColumnRenamed("toxic", "y")
    assert {(r.f, r.c, r.t) for r in toxicity.feature_counts(frame, model).collect()} == {(f, seen[0][f], seen[1][f]) for f in seen[0] | seen[1]}
    odds = {f: math.log((t + 0.5) / 9001) - math.log((seen[0][f] + 0.5) / 9001) for f, t in seen[1].items()}
    assert model.weights == pytest.approx({f: o for f, o in odds.items() if o >= 2 and seen[1][f] - seen[0][f] >= 6 * (seen[1][f] + seen[0][f]) ** 0.5})

    x = np.array([(1.0, *model.numbers(t)) for t in texts])
    p = 1 / (1 + np.exp(-x @ np.array(model.coef)))
    slope = x.T @ (np.arange(len(texts)) % 2 - p) - 0.1 * np.array(model.coef)
    assert np.abs(slope).max() < 1e-4  # the penalised likelihood of all documents has its top here
