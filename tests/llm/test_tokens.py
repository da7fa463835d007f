import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from corpusflow.llm import tokens

from .helpers import ODD, documents

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def library(name, texts):
    t = Tokenizer.from_file(P.path(name))
    t.encode_special_tokens = True
    return [np.array(e.ids, dtype="<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", FILES)
def test_random_texts(name, monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a", "b", "E", "1", ".", ",", "'s", "é", "İ", "Σ", " ", " ", "\n", "\t", " ",
                                 "ó", "<|endoftext|>", "word", "the", "\x1c"]) for _ in range(rng.randint(0, 30)))
             for _ in range(4000)] + [t or "" for _, t in ODD]
    monkeypatch.setattr(tokens, "CHUNK_BYTES", 1000)
    monkeypatch.setattr(tokens, "CACHE_CHARS", 500)
    enc = tokens.UnitEncoder(P.path(name), tokens.unit_rule(P.path(name)))
    assert enc.encode(pa.array(texts)).to_pylist() == library(name, texts)


def test_rules():
    assert tokens.unit_rule(P.path(FILES[0])) == "gpt2" and tokens.unit_rule(P.path(FILES[1])) == "space"


@pytest.mark.parametrize("name", FILES)
def test_tables(spark, name):
    df = documents(spark, ODD, ("ids",))
    rows = tokens.tokenize(df, P.path(name)).collect()
    assert [bytes(r["ids"]) for r in rows] == library(name, [r["text"] or "" for r in rows])
    assert tokens.tokenize(documents(spark, []), P.path(name)).count() == 0
