import random

import public_tokenizers as P
import pytest

from corpusflow.llm import bpe

from .helpers import CLASHES, ODD, documents

RANKS, PATTERN = P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN


def test_safe_pieces_do_not_change_ids():
    rng = random.Random(5)
    whole = bpe.encoding(RANKS, PATTERN)
    for _ in range(300):
        text = "".join(rng.choice("abcE12.,'s é\n  \t日") for _ in range(rng.randint(0, 200)))
        assert "".join(bpe.safe_pieces(text, 7)) == text
        assert bpe.encode_text(text, RANKS, PATTERN, 7).tolist() == whole.encode_ordinary(text)


@pytest.mark.parametrize("piece_chars", [bpe.PIECE_CHARS, 50])
def test_round_trip(spark, piece_chars):
    df = documents(spark, ODD, CLASHES)
    ids = bpe.encode(df, RANKS, PATTERN, piece_chars=piece_chars)
    rows = bpe.decode(ids, RANKS, PATTERN).collect()
    assert len(rows) == len(ODD) and set(rows[0].asDict()) == {"doc_id", "text", *CLASHES}
    enc = bpe.encoding(RANKS, PATTERN)
    for r in rows:
        assert r["ids"] == enc.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
        assert r["tag"] == "own tag"


def test_empty_and_null_ids(spark):
    assert bpe.encode(documents(spark, []), RANKS, PATTERN).count() == 0
    df = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r["decoded"]) for r in bpe.decode(df, RANKS, PATTERN).collect()] == [b"", b""]
