"""Encoding and decoding against the tokenizer itself."""

import pytest
from corpus import TEXTS

from tallyloom.llm import bpe
from tallyloom.llm.bpe import encode_texts
from tallyloom.llm.queries import tokenizer_path

MORE = ["it's <|endoftext|>x <|ENDOFTEXT|>", "e\u0301 \u00a0 ﬁ \u3000 Σας İ", "12 3,4 a\x00b", "\u200b", "na\u0308ive"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer_path())
    found.no_truncation()
    found.no_padding()
    return found


def check(tokenizer, out):
    for r in out:
        want = tokenizer.encode(r.row.text or "", add_special_tokens=False).ids
        assert r.ids == want
        assert r.decoded == tokenizer.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("table_words", [100_000, 2])
def test_edge_cases(edge_docs, tokenizer, table_words):
    out = encode_texts(edge_docs, tokenizer_path(), table_words=table_words).collect()
    assert len(out) == len(TEXTS)
    check(tokenizer, out)


def test_bounded_bytes_give_the_same(spark, tokenizer):
    docs = spark.createDataFrame(list(enumerate(MORE)), "doc_id bigint, text string")
    check(tokenizer, encode_texts(docs, tokenizer_path(), table_bytes=300).collect())


def test_empty(no_docs):
    assert encode_texts(no_docs, tokenizer_path()).collect() == []


def test_all_texts_of_the_table(spark, sf, tokenizer):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(tokenizer, encode_texts(docs, tokenizer_path(), table_words=500).collect())


ODD = ["a b", " ", "　x", "y\x1cz", " ", "<|endoftext|>q", "İstanbul", "Σας", "été", "́", "ﬁ%%%", "12,5", "plain", "\x85"]


def test_words_encoded_together_keep_their_own_ids(tokenizer, monkeypatch):
    """Groups in which white space beyond ASCII adds one word and takes another are cut right."""
    encoder = bpe.WordEncoder(bpe.tokenizer_json(tokenizer_path()))
    for size in (1, 2, 5, 256):
        monkeypatch.setattr(bpe, "GROUP_WORDS", size)
        words = ODD + ["Andonathaor%%%", "Ungßä."] * 3 + ODD[::-1]
        assert encoder.encode(words).to_pylist() == [tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    assert encoder.encode([]).to_pylist() == []


def test_one_call_encodes_many_words(monkeypatch):
    """A call per rare word took most of the time of a job."""
    encoder = bpe.WordEncoder(bpe.tokenizer_json(tokenizer_path()))
    real, texts = encoder.bpe, []

    class Counting:
        model, normalizer = real.model, real.normalizer

        def encode_batch_fast(self, batch, add_special_tokens):
            texts.extend(batch)
            return real.encode_batch_fast(batch, add_special_tokens=add_special_tokens)

    encoder.bpe = Counting()
    encoder.encode([f"rare{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}ön." for i in range(600)])
    assert len(texts) <= 3
