"""Token counts of prefixes, against the tokenizer library on every prefix."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from premisa.llm import token_prefixes

FILE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [
    "a", "the ", " ", "  ", "\n", "\t", "'", "'ll", "'re", "l", "e", "1", "23", ".", "!!", "é", "ß", "中", "日本", "𝄞", "😀",
    "<|endoftext|>", "<|endo", "|>", "\x85", "　", "ing", "tion", "Hello", "՘", "١", "\r\n", "_", "----", "क्", "²", "ª",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def counter():
    with open(FILE, encoding="utf-8") as f:
        return token_prefixes.PrefixCounter(f.read())


def encoded(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_every_prefix_of_random_texts(library, counter):
    rng = random.Random(11)
    for _ in range(500):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14)))
        assert counter.counts([text])[0].tolist() == [encoded(library, text[:i]) for i in range(len(text) + 1)], text


def test_long_texts_are_cut_between_units(library, counter, monkeypatch):
    monkeypatch.setattr(token_prefixes, "WORK_CHARACTERS", 50)
    rng = random.Random(5)
    text = "".join(rng.choice(PIECES[:20]) for _ in range(400))
    assert counter.counts([text])[0].tolist() == [encoded(library, text[:i]) for i in range(len(text) + 1)]
    unbroken = "".join(rng.choice("abcdefg1-") for _ in range(20_000))
    assert counter.counts([unbroken])[0][-1] == encoded(library, unbroken)


def test_forgetting_changes_nothing(library, counter, monkeypatch):
    monkeypatch.setattr(token_prefixes, "REMEMBERED_UNITS", 3)
    monkeypatch.setattr(token_prefixes, "REMEMBERED_PAIRS", 3)
    for text in ("some words in a text", "other words", "some words in a text"):
        assert counter.counts([text])[0][-1] == encoded(library, text)


SCHEMA = "doc_id long, text string, counts int, row string"


@pytest.fixture(scope="module")
def odd(spark):
    texts = [None, "", " \n ", "plain words, twice", "plain words, twice", "don't  stop\n\nnow ", "a<|endoftext|>b", "ä€𝄞 " * 4000]
    rows = [(None if k == 2 else k // 2, t, 7, "x") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_counts_of_odd_rows(spark, odd, library):
    got = token_prefixes.token_counts(odd, FILE, limit=10)
    assert got.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    want = []
    for r in odd.collect():
        t = r["text"] or ""
        n = encoded(library, t)
        want.append((r["doc_id"], len(t.encode()), n, n > 10))
    key = lambda x: (x[0] is None, x)
    assert sorted(map(tuple, got.collect()), key=lambda x: key((x[0] or 0, *x[1:]))) == sorted(want, key=lambda x: key((x[0] or 0, *x[1:])))
    assert token_prefixes.token_counts(odd.limit(0), FILE).collect() == []


def test_budgets_from_stored_counts(spark, odd, library):
    stored = token_prefixes.prefix_counts(odd, FILE)
    assert [f.name for f in stored.schema["row"].dataType] == ["doc_id", "text", "counts", "row"]
    found = stored.select(
        F.col("row.text").alias("text"), token_prefixes.tokens_before(F.col("counts"), 5).alias("five"),
        token_prefixes.fitting(F.col("counts"), 4).alias("fits"),
    )
    for r in found.collect():
        t = r["text"] or ""
        assert r["five"] == encoded(library, t[:5])
        assert r["fits"] == max(i for i in range(min(len(t), 60) + 1) if encoded(library, t[:i]) <= 4)
    cut = token_prefixes.truncated(stored, 4)
    assert cut.columns == odd.columns
    assert all(encoded(library, r["text"] or "") <= 4 for r in cut.collect())
    assert cut.where("text is null").count() == 1


def test_other_vocabularies_are_refused(spark, odd):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        with pytest.raises(ValueError):
            token_prefixes.PrefixCounter(f.read())


def test_query_on_whole_table(spark, sf, library):
    from premisa.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = sorted((r["doc_id"], len((r["text"] or "").encode()), encoded(library, r["text"] or "")) for r in docs)
    got = QUERIES["op12_token_counts"](spark, sf).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)
