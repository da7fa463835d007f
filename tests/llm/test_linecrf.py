import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from corpusflow.llm import linecrf as L

from .helpers import CLASHES, ODD, documents, full_documents, prose


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(1)
    for _ in range(200):
        x = rng.normal(size=(rng.integers(1, 7), len(L.FEATURES)))
        m = L.LineModel(rng.normal(size=len(L.FEATURES)), rng.normal(size=(2, 2)))

        def value(y):
            return sum(x[i] @ m.weights * y[i] for i in range(len(y))) + sum(
                m.change[a, b] for a, b in itertools.pairwise(y))
        best = max(itertools.product((0, 1), repeat=len(x)), key=value)
        assert value(tuple(m.decode(x).tolist())) == value(best)


def test_training_gradient_finds_separating_model():
    rng = np.random.default_rng(0)
    docs = []
    for i in range(60):
        y = i % 2
        f = rng.normal(scale=0.3, size=(rng.integers(1, 9), len(L.FEATURES)))
        f[:, 0], f[:, 1] = 1, f[:, 1] + (1 - 2 * y)
        docs.append((f, y))
    m = L.train(docs)
    assert all(m.share(x, np.ones(len(x), dtype=np.int64)) == y for x, y in docs)
    assert L.train(docs[:0]).weights.sum() == 0 and L.train(docs[::2]).weights.sum() == 0


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(5)
    docs = [(rng.normal(size=(n, len(L.FEATURES))), rng.integers(0, 2, size=n)) for n in (1, 2, 3, 5, 5, 9)]
    seen = L.Sequences(docs)
    theta = rng.normal(size=len(L.FEATURES) + 4)
    grad = seen.value_and_gradient(theta)[1]
    for i in range(len(theta)):
        step = np.zeros(len(theta))
        step[i] = 1e-5
        slope = (seen.value_and_gradient(theta + step)[0] - seen.value_and_gradient(theta - step)[0]) / 2e-5
        assert abs(slope - grad[i]) < 1e-7


def test_value_equals_enumeration():
    """The likelihood of the labels, from all label sequences."""
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(4, len(L.FEATURES))), np.array([1, 0, 0, 1])
    theta = rng.normal(size=len(L.FEATURES) + 4)
    change = theta[-4:].reshape(2, 2)

    def score(labels):
        return sum(x[i] @ theta[:-4] * labels[i] for i in range(4)) + sum(change[a, b] for a, b in itertools.pairwise(labels))
    z = np.logaddexp.reduce([score(s) for s in itertools.product((0, 1), repeat=4)])
    weight = L.KIND_WEIGHTS[1] / 4
    assert abs(L.Sequences([(x, y)]).value_and_gradient(theta)[0] - weight * (score(y) - z)) < 1e-9


def test_line_labels():
    notice, rest = [7], [[10 + i, 20 + i] for i in range(4)]
    docs = [(rest[0] + notice, 1), (rest[1] + notice, 1), (rest[2] + notice, 1), (rest[3], 1), ([7, 30], 0),
            ([1, 2], 1), ([1, 2], 1), ([1, 2], 1), ([None, None, None, None], 1), ([], 1)]
    got = [y.tolist() for y in L.line_labels(docs)]
    assert got == [[1, 1, 0]] * 3 + [[1, 1], [0, 0]] + [[1, 1]] * 3 + [[1, 1, 1, 1], []]


def test_labels_change_inside_documents(spark):
    """Notices at the end of prose are boilerplate, the prose is content."""
    good, bad = prose(8, 120), [(1000 + i, junk(i)) for i in range(40)]
    notices = ["Released under some terms here.", "All rights are reserved.", "Contact the editors for reuse."]
    marked = [(i, t.replace(",\n", ", ") + "\n" + notices[i % 3]) for i, t in good[:60]]
    docs = full_documents(spark, marked + good[60:] + bad)
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id long, quality int")
    model = L.fit(docs, labels)
    out = {r["doc_id"]: r["measures"] for r in L.measure(docs, model).collect()}
    inside = [i for i, _ in marked if 0 < out[i]["content_share"] < 1]
    assert len(inside) > 40
    assert all(out[i]["content_share"] >= 0.5 for i, t in good if len(t.split()) >= 20)
    assert all(out[i]["content_share"] < 0.5 for i, _ in bad)


def test_repeated_words_equals_counting():
    rng = random.Random(2)
    for _ in range(300):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 60))]
        windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
        assert L.repeated_words(words) == len(hit)


def test_measures(spark):
    m = L.LineModel(np.zeros(len(L.FEATURES)), np.zeros((2, 2)))
    rows = ODD + [(30, "a #b\nx\nx\n \nx <|>"), (31, "one\x0btwo\x0cthree\rfour")]
    got = {}
    for r in L.measure(documents(spark, rows, CLASHES), m, out="m").collect():
        got[(r["doc_id"], r["text"])] = r["m"]
        assert r["n_words"] == "own n_words"
    a = got[(30, rows[-2][1])]
    assert (a["n_words"], a["word_chars"], a["n_symbols"], a["n_dup_lines"]) == (6, 9, 4, 1)
    assert got[(31, rows[-1][1])]["n_words"] == 4
    assert got[(1, None)]["n_words"] == 0 and got[(1, None)]["content_share"] == 0
    assert got[(4, "one")]["content_share"] == 1
    assert L.measure(documents(spark, []), m).count() == 0


def junk(i):
    return "\n".join(" ".join(f"{w.upper()}!!" for w in ("buy", "this", "now", str(i), "cheap", "offer")) for _ in range(6))


def test_fit_keeps_prose_and_rejects_junk(spark):
    good = prose(3, 120)
    bad = [(1000 + i, junk(i)) for i in range(60)]
    docs = full_documents(spark, good + bad + [(None, "x"), (5, None)])
    labels = spark.createDataFrame(
        [(i, 1, 0) for i, _ in good[:60]] + [(i, 0, 0) for i, _ in bad[:30]] + [(None, 1, 0), (good[0][0], None, 0), (77, 1, 0)],
        "doc_id long, quality int, toxic int")
    model = L.fit(docs, labels)
    out = {r["doc_id"]: r for r in L.measure(docs, model).withColumn("kept", L.kept(F.col("measures"))).collect()}
    assert all(out[i]["measures"]["content_share"] == 1 for i, _ in good if out[i]["measures"]["n_words"] >= 20)
    assert not any(out[i]["kept"] for i, _ in bad)
    none = L.fit(docs, labels.limit(0))
    assert none.weights.sum() == 0
    assert L.fit(docs.limit(0), labels).weights.sum() == 0


def test_fit_takes_a_repeated_document_once(spark):
    good, bad = prose(3, 30), [(1000 + i, junk(i)) for i in range(30)]
    rows = good + bad
    label = [(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad]
    labels = spark.createDataFrame(label, "doc_id long, quality int")
    once = L.fit(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    hot = spark.createDataFrame([good[0]] * 400 + rows, "doc_id long, text string").coalesce(1)
    many = L.fit(hot, labels.union(labels), sample=60)
    assert np.array_equal(once.weights, many.weights) and np.array_equal(once.change, many.change)
