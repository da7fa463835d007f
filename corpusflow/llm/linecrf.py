"""Quality rules by line sequence labelling.

A linear-chain conditional random field labels each line of a document as
content or boilerplate; Viterbi decoding gives the best label sequence, and
the share of words in content lines decides retention, after two plain rules
(too few words, too many repeated word windows).

``fit`` trains the field on a bounded sample of labelled documents. The lines of
a document of quality 0 are boilerplate. In one of quality 1 a line of fewer than
``NOTICE_WORDS`` words that stands in ``RECURS`` or more documents of the sample
is boilerplate (a notice, a heading) and the others are content; if most of a document's lines recur, it is
a copy of another document and all its lines are content. So the sequences to
learn from change label inside a document, and the field learns changes as well
as labels. Documents of quality 0 and those with lines of both kinds weigh the
same, those of content alone twice as much. The bound (``SAMPLE_DOCS`` documents
of at most ``SAMPLE_LINES`` lines) is a parameter; the model is some dozen
numbers whatever the corpus size. ``measure`` computes the rule counts and the decoded share for every
whole text inside Arrow batches, without a shuffle.

Words are runs without space, tab, LF, VT, FF and CR; lines are split at LF
and count when they hold a word.

Cases: null or empty text has no words and fails the first rule; without
labelled documents of both kinds every line counts as content; rows of the
labels with null ids or qualities and repeated rows are ignored or weigh
again; documents without labels are measured like all others; extra columns
are passed through, one named like the output is replaced.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, ship_package

#: Bound of the training sample: documents, and lines of one of them.
SAMPLE_DOCS, SAMPLE_LINES = 1000, 400
#: A notice: lines of fewer words that so many documents of the sample share.
NOTICE_WORDS, RECURS = 16, 3
#: Rule limits.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
#: Least share of words in content lines.
MIN_SHARE = 0.5

#: Weights of all documents of boilerplate, of both kinds of lines, of content.
KIND_WEIGHTS = np.array([1 / 3, 1 / 3, 2 / 3])

#: Fixed character classes.
SYMBOLS = b"#*$%&|<>"
UPPER, LOWER, DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"
STOPS = (b".", b"!", b"?", b":", b";")
FEATURES = ("bias", "symbols", "upper", "digits", "shouts", "repeated line", "short", "length", "variety", "stop",
            "last of few words", "capitals")


def line_features(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Features of each line that has a word (lines x features), its words,
    and how many lines equal an earlier one."""
    rows, words, seen, dups = [], [], set(), 0
    for line in text.encode().split(b"\n"):
        w = line.split()
        if not w:
            continue
        n, size = len(w), len(line)
        again = line in seen
        dups += again
        seen.add(line)
        up, low = size - len(line.translate(None, UPPER)), size - len(line.translate(None, LOWER))
        rows.append((1.0, min(1.0, 5 * (size - len(line.translate(None, SYMBOLS))) / size), up / (up + low + 1),
                     (size - len(line.translate(None, DIGITS))) / size, min(1.0, line.count(b"!") / n),
                     float(again), float(n < 4), min(1.0, math.log1p(n) / 5), len(set(w)) / n,
                     float(w[-1].endswith(STOPS)), 0.0, sum(x[:1].isupper() for x in w) / n))
        words.append(n)
    if rows and words[-1] < NOTICE_WORDS:
        rows[-1] = (*rows[-1][:-2], 1.0, rows[-1][-1])
    return np.array(rows).reshape(-1, len(FEATURES)), np.array(words, dtype=np.int64), dups


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more in the text. Window
    identity is built by doubling: equal pairs of equal halves."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    if len(number) == len(words):
        return 0
    span = 1
    while span < window:
        step = min(span, window - span)
        pair = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        _, ids, counts = np.unique(pair, return_inverse=True, return_counts=True)
        if len(counts) == len(pair):
            return 0
        span += step
    at = np.nonzero(counts[ids] > 1)[0]
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + window, -1)
    return int((np.cumsum(covered) > 0).sum())


@dataclass
class LineModel:
    """Score of the content state per feature, and of label changes
    (``change[i, j]``: from i to j; 0 boilerplate, 1 content)."""
    weights: np.ndarray
    change: np.ndarray

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Viterbi: the best label of each line."""
        if not len(x):
            return np.empty(0, dtype=np.int64)
        own = (x @ self.weights).tolist()
        (bb, bc), (cb, cc) = self.change.tolist()
        b, c = 0.0, own[0]
        back = []
        for e in own[1:]:
            from_b = (b + bb, b + bc)
            from_c = (c + cb, c + cc)
            back.append((from_c[0] >= from_b[0], from_c[1] >= from_b[1]))
            b, c = max(from_b[0], from_c[0]), max(from_b[1], from_c[1]) + e
        out = [c >= b]            # ties are content
        for step in reversed(back):
            out.append(step[out[-1]])
        return np.array(out[::-1], dtype=np.int64)

    def share(self, x: np.ndarray, words: np.ndarray) -> float:
        """Share of words in content lines (0 without words)."""
        total = int(words.sum())
        return float(words[self.decode(x) == 1].sum() / total) if total else 0.0


class Sequences:
    """Training documents, (features, label of each line), laid side by side."""

    def __init__(self, docs: list[tuple[np.ndarray, np.ndarray]]):
        docs = sorted(docs, key=lambda d: len(d[0]))
        self.k, self.n, self.longest = len(FEATURES), len(docs), len(docs[-1][0])
        self.lengths = np.array([len(x) for x, _ in docs])
        self.x = np.zeros((self.longest, self.n, self.k))
        self.y = np.zeros((self.longest, self.n), dtype=np.int64)
        for i, (x, y) in enumerate(docs):
            self.x[:len(x), i], self.y[:len(x), i] = x, y
        kind = np.array([y.min() + y.max() for _, y in docs])            # 0, 1 (both labels) or 2
        self.share = KIND_WEIGHTS[kind] / np.bincount(kind, minlength=3)[kind] / self.lengths
        self.first = np.searchsorted(self.lengths, np.arange(self.longest), side="right")  # from here on: have a line t

    def value_and_gradient(self, theta: np.ndarray) -> tuple[float, np.ndarray]:
        """Weighted log-likelihood of the labels and its exact gradient."""
        k, n, longest, x, share, lengths, first = (self.k, self.n, self.longest, self.x, self.share, self.lengths, self.first)
        w, change = theta[:k], theta[k:].reshape(2, 2)
        own = np.zeros((longest, n, 2))
        own[..., 1] = x @ w
        fwd, bwd = np.zeros_like(own), np.zeros_like(own)
        fwd[0] = own[0]
        for t in range(1, longest):
            s = slice(first[t], n)
            fwd[t, s] = own[t, s] + np.logaddexp(fwd[t - 1, s, :1] + change[0], fwd[t - 1, s, 1:] + change[1])
        for t in range(longest - 2, -1, -1):
            s = slice(first[t + 1], n)
            nxt = own[t + 1, s] + bwd[t + 1, s]
            bwd[t, s] = np.logaddexp(nxt[:, :1] + change[:, 0], nxt[:, 1:] + change[:, 1])
        end = fwd[lengths - 1, np.arange(n)]
        z = np.logaddexp(end[:, 0], end[:, 1])
        value, grad = -(z * share).sum(), np.zeros(k + 4)
        for t in range(longest):
            s = slice(first[t], n)
            label, weight = self.y[t, s], share[s]
            p = np.exp(fwd[t, s, 1] + bwd[t, s, 1] - z[s])
            value += (label * own[t, s, 1] * weight).sum()
            grad[:k] += ((label - p) * weight) @ x[t, s]
            if t:
                before = self.y[t - 1, s]
                value += (change[before, label] * weight).sum()
                both = np.exp(fwd[t - 1, s][:, :, None] + change + (own[t, s] + bwd[t, s])[:, None, :]
                              - z[s][:, None, None])
                seen = np.zeros_like(both)
                seen[np.arange(len(both)), before, label] = 1
                grad[k:] += ((seen - both) * weight[:, None, None]).sum(axis=0).ravel()
        return float(value), grad


def train(docs: list[tuple[np.ndarray, np.ndarray | int]], steps: int = 200, rate: float = 0.3,
          l2: float = 1e-3) -> LineModel:
    """Maximum conditional likelihood by Adam over exact forward-backward
    gradients; ``docs`` are (features, labels of the lines or one for all)."""
    k = len(FEATURES)
    docs = [(x, np.zeros(len(x), dtype=np.int64) + y) for x, y in docs if len(x)]
    if len({int(label) for _, y in docs for label in np.unique(y)}) < 2:
        return LineModel(np.zeros(k), np.zeros((2, 2)))
    seen = Sequences(docs)
    theta, m, v = np.zeros(k + 4), np.zeros(k + 4), np.zeros(k + 4)
    for step in range(1, steps + 1):
        grad = seen.value_and_gradient(theta)[1] - l2 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta = theta + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return LineModel(theta[:k].copy(), theta[k:].reshape(2, 2).copy())


def line_hashes(text: str) -> list[int | None]:
    """A hash of each line that has a word; none for lines too long for a
    notice."""
    lines = [line.split() for line in text.encode().split(b"\n")]
    return [xxhash.xxh64_intdigest(b" ".join(w)) - (1 << 63) if len(w) < NOTICE_WORDS else None for w in lines if w]


def line_labels(docs: list[tuple[list[int | None], int]]) -> list[np.ndarray]:
    """Label of every line of the sample's documents (line hashes, quality)."""
    in_docs = Counter(h for lines, _ in docs for h in set(lines))
    out = []
    for lines, quality in docs:
        recurs = np.array([h is not None and in_docs[h] >= RECURS for h in lines], dtype=bool)
        if quality == 0:
            out.append(np.zeros(len(lines), dtype=np.int64))
        elif 2 * recurs.sum() > len(lines):
            out.append(np.ones(len(lines), dtype=np.int64))
        else:
            out.append((~recurs).astype(np.int64))
    return out


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        sample: int = SAMPLE_DOCS, max_lines: int = SAMPLE_LINES) -> LineModel:
    """Train on at most ``sample`` labelled documents, taken in the order of a
    hash of their id so that the same rows are taken every time."""
    ship_package(docs.sparkSession)
    chosen = (labels.filter("doc_id is not null and quality in (0, 1)").select("doc_id", "quality").distinct()
              .orderBy(F.xxhash64("doc_id"), "quality").limit(sample))

    @F.arrow_udf("struct<x: array<double>, lines: array<long>>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch]
            got = [line_features(t)[0] for t in texts]
            fits = [len(x) <= max_lines for x in got]
            yield pa.StructArray.from_arrays(
                [pa.array([x.ravel() if ok else None for x, ok in zip(got, fits, strict=True)], pa.list_(pa.float64())),
                 pa.array([line_hashes(t) if ok else None for t, ok in zip(texts, fits, strict=True)], pa.list_(pa.int64()))],
                ["x", "lines"])

    # one text, of least hash, for each chosen label: at most ``sample`` rows,
    # a bounded broadcast and a bounded collect
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(chosen), "doc_id")
    picked = picked.groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("least"))
    rows = (picked.select("doc_id", "quality", features(F.col("least")["text"]).alias("f"))
            .select("doc_id", "quality", "f.x", "f.lines").filter("x is not null").collect())
    rows.sort(key=lambda r: (r["doc_id"], r["quality"]))
    y = line_labels([(r["lines"], int(r["quality"])) for r in rows])
    return train([(np.array(r["x"]).reshape(-1, len(FEATURES)), of) for r, of in zip(rows, y, strict=True)])


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, content_share double"


def measure_text(text: str, model: LineModel) -> tuple[int, int, int, int, int, float]:
    words = text.encode().split()
    x, per_line, dups = line_features(text)
    gaps = sum(map(text.count, " \t\n\v\f\r"))
    return (len(words), len(text) - gaps, sum(map(text.count, SYMBOLS.decode())), dups,
            repeated_words(words), model.share(x, per_line))


def measure(docs: DataFrame, model: LineModel, text: str = "text", out: str = "measures") -> DataFrame:
    """``docs`` plus ``out``, a struct of MEASURES."""
    ship_package(docs.sparkSession)
    w, change = model.weights.tolist(), model.change.tolist()
    names = [c.split()[0] for c in MEASURES.split(", ")]

    @F.arrow_udf("struct<" + MEASURES.replace(" long", ": long").replace(" double", ": double") + ">")
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = LineModel(np.array(w), np.array(change))
        kinds = [pa.int64()] * 5 + [pa.float64()]
        for batch in batches:
            got = [measure_text(t.as_py() or "", own) for t in batch]
            cols = zip(*got, strict=True) if got else [[]] * 6
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)
            release()

    return docs.withColumn(out, measured(F.col(text)))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def kept(m: Column) -> Column:
    return ~base_failed(m) & (m["content_share"] >= MIN_SHARE)
