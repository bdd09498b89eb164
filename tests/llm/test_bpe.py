import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm.cases import SCHEMA, frame, odd_rows
from shopgrain.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Tables.read(PATH))


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def test_every_code_point(encoder, reference):
    points = [chr(c) for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c}{c} 1{c}\n{c}" for c in points]
    for a, b in zip(reference.encode_batch(texts, add_special_tokens=False),
                    encoder.encode(texts), strict=True):
        assert a.ids == b.tolist()


def test_long_words_and_special_tokens(encoder, reference):
    texts = ["a" * 5000, "ab" * 3000, "thethethe" * 500, " " * 999, "\n \n\n x", "<|endoftext|>",
             "x<|endoftext|><|endoftext|> y", "don't we'll 'S", "1234 ²³", ""]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert reference.encode(text, add_special_tokens=False).ids == ids.tolist()


def test_forgetting_changes_nothing(encoder, reference, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 1)
    for text in ("some words", "other words", "some words"):
        assert encoder.encode([text])[0].tolist() == reference.encode(text).ids


def test_odd_rows(spark, reference):
    got = bpe.decode(bpe.encode(frame(spark), PATH), PATH).collect()  # `ids` clashes and is replaced
    assert len(got) == len(odd_rows())
    for row in got:
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert ids == reference.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["decoded"] == (row["text"] or "")


def test_empty_table(spark):
    assert bpe.encode(frame(spark, []), PATH).count() == 0
    assert SCHEMA.startswith("doc_id")
