import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpusflow.llm import ctw

from .helpers import ODD, documents, prose


def brute(rows):
    """Scores by the definitions, one bit at a time."""
    depth = ctw.DEPTH
    words, tokens, ends, counts = Counter(), 0, 0, defaultdict(lambda: [0, 0])

    def held(i):
        return i is not None and zlib.crc32(str(i).encode()) % 7 == 2

    def bits(w):
        text = b"\n" * depth + b" ".join(w) + b"\n"
        for j in range(depth, len(text)):
            for k in range(8):
                yield text[j - depth:j][::-1], 1 << k | text[j] >> (8 - k), text[j] >> (7 - k) & 1

    docs = [(i, (t or "").encode().lower().split()) for i, t in rows]
    for i, w in docs:
        if not held(i):
            words.update(w)
            tokens += len(w) + 1
            ends += 1
            for context, node, bit in bits(w):
                for d in range(depth + 1):
                    counts[context[:d], node][bit] += 1
    weighted, below = {}, defaultdict(float)
    for (context, node), (a, b) in sorted(counts.items(), key=lambda x: -len(x[0][0])):
        own = math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
        total = own if len(context) == depth else np.logaddexp(own, below[context, node]) - math.log(2)
        weighted[context, node] = own, total
        if context:
            below[context[:-1], node] += total

    def probability(context, node, bit):
        p = None
        for d in range(depth, -1, -1):
            a, b = counts.get((context[:d], node), (0, 0))
            own = ((b if bit else a) + .5) / (a + b + 1)
            if p is None:
                p = own
                continue
            e, t = weighted.get((context[:d], node), (0.0, 0.0))
            w = math.exp(e - math.log(2) - t)
            p = w * own + (1 - w) * p
        return p
    whole = tokens + len(words) + (ends > 0) + 1
    for i, w in docs:
        base = sum(math.log10((words.get(x, 0) + 1) / whole) for x in w) + math.log10((ends + 1) / whole)
        yield (i, held(i), len(w) + 1, sum(x in words for x in w) + (ends > 0), tokens, round(base, 6),
               round(sum(math.log10(probability(*b)) for b in bits(w)), 6))


ROWS = prose(1, 14, 25) + [r for r in ODD if r[0] not in (8, 9)] + [(20, "HELLO hello unseen")]


@pytest.mark.parametrize("frequent", [(ctw.FREQUENT, ctw.FREQUENT_WORDS), (40, 10), (0, 0)])
def test_scores_equal_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(ctw, "FREQUENT", frequent[0])
    monkeypatch.setattr(ctw, "FREQUENT_WORDS", frequent[1])
    monkeypatch.setattr(ctw, "CHUNK", 200)
    monkeypatch.setattr(ctw, "SCORE_CHUNK", 150)
    got = ctw.score(documents(spark, ROWS, ("key", "n", "held", "tag"))).collect()
    have = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                    round(r["base_score"], 6), round(r["score"], 6)) for r in got), key=repr)
    want = sorted(brute(ROWS), key=repr)
    assert len(have) == len(want)
    for a, b in zip(have, want, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=2e-6)


def test_bits_of_a_byte_sum_to_one(spark):
    """The probabilities of all 256 next bytes after a context sum to one."""
    texts = [ctw.as_bytes(w) for w in ([b"abracadabra"], [b"abba", b"cab"])]
    keys, n = np.unique(ctw.gram_keys(texts)[0], return_counts=True)
    context = (keys[5] >> 8) << 8
    every = np.union1d(keys, context + np.arange(256))
    counts = np.zeros(len(every))
    counts[np.searchsorted(every, keys)] = n
    t = ctw.Subtrees(every, counts)
    cols = [np.concatenate(c) for c in zip(*t.summary, strict=True)]
    p = ctw.Upper(*cols).log10(t)
    at = np.searchsorted(every, context + np.arange(256))
    assert (10 ** p[at]).sum() == pytest.approx(1.0)


def test_model_beats_the_base_on_held_out_prose(spark):
    rows = ctw.score(documents(spark, prose(2, 400, 120))).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > 1.3 * sum(r["base_score"] for r in rows)


def test_empty(spark):
    assert ctw.score(documents(spark, [])).count() == 0


def test_lookup():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(-2 ** 62, 2 ** 62, 5000))
    table = ctw.Lookup(keys, np.arange(len(keys)))
    ask = np.concatenate([keys, keys + 1])
    at = table.find(ask)
    assert (table.keys[at[:len(keys)]] == keys).all()
    assert ((at[len(keys):] < 0) == ~np.isin(keys + 1, keys)).all()
