"""Token counts against the library that owns the vocabulary, and against plain merging."""

import random

import cases
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from filmgrain.llm import queries, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "ab 'sStT\n\t  é日12!\x85\xa0 \x1c‍"


@pytest.fixture(scope="module")
def vocabulary():
    return token_counts.read_vocabulary(PATH)


@pytest.fixture(scope="module")
def own(vocabulary):
    return token_counts.Counter(vocabulary)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def odd_texts(n, seed):
    rng = random.Random(seed)
    one = lambda: rng.choice(ALPHABET) if rng.random() < 0.95 else "<|endoftext|>"
    return ["".join(one() for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_every_code_point(own, library):
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i <= 0xDFFF]
    texts = ["".join(f"a{c} {c}1" for c in points[i:i + 64]) for i in range(0, len(points), 64)]
    assert own.count(texts) == library(texts)


def test_random_texts_and_special_tokens(own, library, monkeypatch):
    texts = odd_texts(800, 1)
    assert own.count(texts) == library(texts)
    monkeypatch.setattr(token_counts, "STRETCH", 7)  # texts in many stretches
    monkeypatch.setattr(token_counts, "SYMBOLS", 16)
    monkeypatch.setattr(token_counts, "REMEMBERED", 5)
    fresh = token_counts.Counter(token_counts.read_vocabulary(PATH))
    assert fresh.count(texts) == library(texts)


def test_runs_and_long_pre_tokens(own, library):
    rng = random.Random(2)
    texts = ["a" * 5000, " " * 5001, "ab" * 3000, "\n" * 777 + "x", "=" * 4097, "",
             "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000)), cases.words(200_000, 3)]
    assert own.count(texts) == library(texts)


def plain_merges(word, vocabulary, rank):
    """One place at a time, lowest rank first, then leftmost."""
    have = [vocabulary.of_byte[b] for b in word]
    while True:
        hits = [(rank[pair][0], i) for i, pair in enumerate(zip(have, have[1:])) if pair in rank]
        if not hits:
            return len(have)
        _, i = min(hits)
        have[i:i + 2] = [rank[have[i], have[i + 1]][1]]


def test_merging_side_by_side_is_merging_one_by_one(own, vocabulary):
    rng = random.Random(5)
    rank = {(a, b): (r, to) for r, (a, b, to) in enumerate(vocabulary.merges)}
    words = [bytes(rng.choice(b"aaabtheing ") for _ in range(rng.randint(1, 40))) for _ in range(500)]
    assert own.merged(words).tolist() == [plain_merges(w, vocabulary, rank) for w in words]


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises(ValueError):
        token_counts.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_rows(spark, vocabulary, own):
    docs = cases.frame(spark)
    got = docs.select("text", token_counts.count(spark, vocabulary, docs["text"]).alias("n")).collect()
    assert len(got) == len(cases.rows())
    assert all(r.n == (own.count([r.text])[0] if r.text else 0) for r in got)
    none = cases.frame(spark, [])
    assert none.select(token_counts.count(spark, vocabulary, none["text"])).collect() == []


def test_query(spark, folder, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op12_rank_merged_tokens(spark, folder).collect()
    want = dict(zip(docs, library(list(docs.values()))))
    assert {r.doc_id: r.n_tokens for r in rows} == want
    assert all(r.n_bytes == len(docs[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 1024) for r in rows)
