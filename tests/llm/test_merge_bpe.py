"""Merging by priority queue against the public library and a plain merge loop."""

import hashlib
import json
import os
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlens.llm import merge_bpe, queries

FOLDER = os.environ.get("SUITE_SF_DIR", "/root/testdata/sf0.001")
PATH = public_tokenizers.path(queries.MERGES)
ODD = [
    None, "", " ", "\n\n  \t x", "<|endoftext|>", "a<|endoftext|>b  <|endoftext|><|endoftext|> c", "<|endoftext", "it's WE'LL they're 'x", "éé 漢字 😀\U0001f3fd",
    "՘࢏₏1\U00010940z \U0003d000", "\x00\x85\xa0　​", "1234567890 ١½", "  double  spaced   words ", "x" * 20_000, "ab " * 5_000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    return merge_bpe.Coder(merge_bpe.load_vocabulary(PATH))


def expected(library, rows):
    out = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        out.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return out


def test_query_equals_the_library(spark, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.QUERIES["op11_merge_bpe"](spark, FOLDER).collect())) == sorted(expected(library, rows))


def test_odd_rows_clashing_names_and_ties(spark, library):
    rows = [*enumerate(ODD), (3, ODD[3]), (3, ODD[3])]
    docs = spark.createDataFrame([(i, t, -1, "kept", "x") for i, t in rows], "doc_id long, text string, n_tokens int, ids string, decoded string").repartition(3)
    shared = merge_bpe.share(spark, PATH)
    ids = merge_bpe.encode(docs, shared)
    assert ids.columns == ["doc_id", "text", "decoded", "n_tokens", "ids"]
    back = merge_bpe.decode(ids.withColumn("given", F.coalesce("text", F.lit(""))).withColumn("listed", F.col("ids")), shared)
    assert back.columns == ["doc_id", "text", "n_tokens", "given", "listed", "decoded"]
    got = back.collect()
    assert all(r.decoded == r.given for r in got)
    want = sorted((i, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows)
    assert sorted((r.doc_id, r.listed) for r in got) == want
    assert merge_bpe.decode(merge_bpe.encode(docs.limit(0), shared), shared).collect() == []


def test_random_texts(library, coder):
    r = random.Random(3)
    parts = [*"abct're VELLS 12 \n\t\x0b\x1c\x85  é漢😀ß.,;", "<|endoftext|>", "'s", "'ll", "  ", "՘", "\U00010940", "�", "the", " and"]
    for _ in range(4_000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 40)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == ids, text
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)
        wild = [r.randrange(50_260) for _ in range(r.randint(0, 9))]
        assert coder.decode(wild) == library.decode(wild, skip_special_tokens=False)


def test_stale_entries_and_equal_ranks_against_a_plain_loop():
    names = {b: c for c, b in merge_bpe.byte_names().items()}
    ids = {names[b]: b for b in range(256)}
    merges = [("a", "a"), ("a", "b"), ("aa", "b"), ("a", "ab"), ("aa", "aa"), ("b", "a"), ("ab", "ab")]
    for a, b in merges:
        ids.setdefault(a + b, len(ids))
    coder = merge_bpe.Coder(merge_bpe.Vocabulary(ids, merges, {}))

    def plain(text):
        parts = list(text)
        while True:
            ranked = [(merges.index(p), i) for i, p in enumerate(zip(parts, parts[1:])) if p in merges]
            if not ranked:
                return [ids[p] for p in parts]
            i = min(ranked)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    r = random.Random(9)
    for _ in range(3_000):
        text = "".join(r.choice("aab") for _ in range(r.randint(0, 24)))
        assert coder.merge(text.encode()) == plain(text), text


def test_long_piece_is_no_special_case(coder):
    assert coder.decode(coder.encode("ab" * 200_000)) == "ab" * 200_000


def test_other_vocabularies_are_refused(tmp_path):
    file = json.load(open(PATH, encoding="utf-8"))
    file["model"] = {"type": "BPE", "vocab": {}, "merges": []}
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}):
        name = tmp_path / "v.json"
        name.write_text(json.dumps(file | change))
        with pytest.raises(ValueError):
            merge_bpe.load_vocabulary(str(name))
