"""Language-model scoring by context-tree weighting over bytes.

The model sees a document as its lower-cased words joined by spaces and ended
by a line feed, byte by byte. A byte is eight binary decisions; each decision
(the bits of the byte so far) has its own context tree, whose contexts are the
0 to ``DEPTH`` bytes before, most recent first. Every node has a
Krichevsky-Trofimov estimate from its training counts, and the weighted
probability of a node is half its own estimate plus half the product of its
children's. A byte's probability mixes the estimates of all depths along its
context with the weights that training gives them; contexts never seen in
training predict 1/2 per bit, so every text has a probability.

Spark does the counting and the tree: tasks count (context, byte) grams of
their texts, one shuffle adds them up, and since contexts are ordered by the
most recent byte, all subtrees below a two-byte context meet in one task. The
upper two levels have at most 65,280 nodes and are finished on the driver.
The result is a table gram -> log10 probability. Scoring is one more pass: the
most frequent grams and words (a bounded number) are broadcast; the others of
each document are sent, counted, to a join with the whole tables.

The base model (add-one unigrams over words and the end token) is scored in the
same pass.

Cases: null text is the empty text (one end token); a null doc_id belongs to
the training part; repeated rows count and are scored each; without training
documents all counts are zero; extra columns are ignored; an empty table gives
no rows. Words are told apart by a 64-bit hash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, partitions, release, ship_package

DEPTH = 5
#: Rows of the frequent grams and of the frequent words that are broadcast.
FREQUENT = 1 << 20
FREQUENT_WORDS = 1 << 18
#: Bytes of text a task counts, and scores, at once.
CHUNK, SCORE_CHUNK = 1 << 21, 1 << 19
END = 10                    # byte that ends a document and pads its start
WORD, GRAM = 0, 1


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x > 0 (Stirling's series after a shift by eight)."""
    y = x + 8.0
    shift = np.log(x)
    for i in range(1, 8):
        shift += np.log(x + i)
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + (1 / 12 - z * (1 / 360 - z / 1260)) / y - shift


def kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def mix(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ln weighted probability of nodes and the weight of their own estimate."""
    total = np.logaddexp(own, below) - math.log(2)
    return total, np.exp(own - math.log(2) - total)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def gram_keys(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Gram of every byte of every text - the context, most recent byte first,
    then the byte - and the places where texts begin."""
    pad = bytes([END]) * depth
    data = np.frombuffer(b"".join(pad + t for t in texts), dtype=np.uint8).astype(np.int64)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    key = np.zeros(len(data), dtype=np.int64)
    for d in range(1, depth + 1):
        key <<= 8
        key[d:] |= data[:-d]
    key = key << 8 | data
    keep = np.ones(len(data), dtype=bool)
    starts = np.cumsum(sizes + depth) - (sizes + depth)
    for d in range(depth):
        keep[starts + d] = False
    return key[keep], np.cumsum(sizes) - sizes


class Subtrees:
    """Context trees below all contexts of ``top`` bytes in a sorted gram table."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, depth: int = DEPTH, top: int = 2):
        self.keys = keys
        byte = keys & 255
        self.mixed: list[np.ndarray] = []     # per bit: probability of each gram's bit from depth top down
        self.summary: list[tuple[np.ndarray, ...]] = []
        pairs = {}
        for d in range(top, depth + 1):
            pk, inv = np.unique((keys >> (8 * (depth - d) + 8)) << 8 | byte, return_inverse=True)
            pairs[d] = pk, inv, np.bincount(inv, counts, len(pk))
        for k in range(8):
            seen, below = None, None
            path = []
            for d in range(depth, top - 1, -1):
                pk, inv, n = pairs[d]
                prefix = pk >> (8 - k)
                new = np.ones(len(pk), dtype=bool)
                new[1:] = prefix[1:] != prefix[:-1]
                node = np.cumsum(new) - 1
                names = prefix[new]
                bit = pk >> (7 - k) & 1
                ones = np.bincount(node, n * bit, len(names))
                zeros = np.bincount(node, n * (1 - bit), len(names))
                own = kt(zeros, ones)
                if seen is None:
                    total, weight = own, np.ones(len(names))
                else:
                    parent = (seen >> (k + 8)) << k | (seen & ((1 << k) - 1))
                    total, weight = mix(own, np.bincount(np.searchsorted(names, parent), below, len(names)))
                hit = np.where(bit == 1, ones[node], zeros[node]) + 0.5
                path.append(((hit / (zeros + ones + 1)[node])[inv], weight[node][inv]))
                seen, below = names, total
            p = path[0][0]
            for estimate, weight in path[1:]:
                p = weight * estimate + (1 - weight) * p
            self.mixed.append(p)
            # of depth top: most recent byte, bits so far (with a leading 1), counts, ln probability
            self.summary.append((seen >> (k + 8 * (top - 1)), 1 << k | seen & ((1 << k) - 1), zeros, ones, below))


class Upper:
    """The two upper levels: weights and one-bit estimates."""

    def __init__(self, first: np.ndarray, node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        z, o, b = (np.zeros((256, 256)) for _ in range(3))
        for grid, v in ((z, zeros), (o, ones), (b, below)):
            np.add.at(grid, (first, node), v)
        used = np.zeros((256, 256), dtype=bool)
        used[first, node] = True
        total, self.weight1 = mix(kt(z, o), b)
        self.one1 = (o + 0.5) / (z + o + 1)
        z0, o0 = z.sum(axis=0), o.sum(axis=0)
        _, self.weight0 = mix(kt(z0, o0), np.where(used, total, 0).sum(axis=0))
        self.one0 = (o0 + 0.5) / (z0 + o0 + 1)

    def log10(self, t: Subtrees, depth: int = DEPTH) -> np.ndarray:
        """log10 probability of each gram's byte after its context."""
        byte, first = t.keys & 255, t.keys >> (8 * depth)
        out = np.zeros(len(t.keys))
        for k, p in enumerate(t.mixed):
            node, bit = 1 << k | byte >> (8 - k), byte >> (7 - k) & 1
            for weight, one in ((self.weight1[first, node], self.one1[first, node]),
                                (self.weight0[node], self.one0[node])):
                p = weight * np.where(bit == 1, one, 1 - one) + (1 - weight) * p
            out += np.log10(p)
        return out


class Lookup:
    """Static hash table of int64 keys in numpy."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys)).bit_length())
        slot = self.slot(keys)
        order = np.argsort(slot, kind="stable")
        self.keys, self.values = keys[order], values[order]
        self.start = np.searchsorted(slot[order], np.arange((1 << self.bits) + 1)).astype(np.int32)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 where it is not in the table."""
        slot = self.slot(keys)
        at, end = self.start[slot].astype(np.int64), self.start[slot + 1]
        out = np.full(len(keys), -1, dtype=np.int64)
        todo = np.nonzero(at < end)[0]
        while len(todo):
            here = at[todo]
            same = self.keys[here] == keys[todo]
            out[todo[same]] = here[same]
            todo, here = todo[~same], here[~same] + 1
            at[todo] = here
            todo = todo[here < end[todo]]
        return out


def text_chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list, list]]:
    """``(doc ids, held-out flags, word lists)`` of about ``size`` bytes of text."""
    ids, held, docs, n = [], [], [], 0
    for batch in batches:
        for i, h, t in zip(*(batch.column(k) for k in range(3)), strict=True):
            w = words_of(t.as_py())
            ids.append(i.as_py())
            held.append(bool(h.as_py()))
            docs.append(w)
            n += 8 + sum(map(len, w))
            if n > size:
                yield ids, held, docs
                ids, held, docs, n = [], [], [], 0
        release()
    if docs:
        yield ids, held, docs


def as_bytes(words: list[bytes]) -> bytes:
    return b" ".join(words) + bytes([END])


def hashes(words: list[bytes]) -> np.ndarray:
    import xxhash
    digest = xxhash.xxh64_intdigest
    return np.fromiter(map(digest, words), dtype=np.uint64, count=len(words)).view(np.int64)


def count(docs: DataFrame) -> DataFrame:
    """``(kind, key, n)``: training counts of all words and grams; grams that
    occur only outside the training part count 0. ``docs``: doc_id, held, text."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held, chunk in text_chunks(batches, CHUNK):
            out = []
            words: Counter = Counter()
            for w, h in zip(chunk, held, strict=True):
                if not h:
                    words.update(w)
            if words:
                out.append((WORD, hashes(list(words)), np.fromiter(words.values(), np.int64, len(words))))
            for part in (False, True):
                texts = [as_bytes(w) for w, h in zip(chunk, held, strict=True) if h is part]
                if texts:
                    keys, n = np.unique(gram_keys(texts)[0], return_counts=True)
                    out.append((GRAM, keys, n * (not part)))
            for kind, keys, n in out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), kind, dtype=np.int32)), pa.array(keys), pa.array(n.astype(np.int64))],
                    ["kind", "key", "n"])

    return (docs.mapInArrow(tally, "kind int, key long, n long")
            .groupBy("kind", "key").agg(F.sum("n").alias("n")))


def _table(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    return keys[order], n[order]


def model(counts: DataFrame) -> DataFrame:
    """``(key, value, n)``: log10 probability of every gram's byte."""
    spark = counts.sparkSession
    depth = DEPTH
    # contexts of one two-byte subtree meet in one task, whole subtrees at a time
    grams = (counts.filter(F.col("kind") == GRAM)
             .repartition(partitions(spark), F.shiftright("key", 8 * depth - 8)).select("key", "n"))

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = _table(batches)
        if len(keys):
            cols = [np.concatenate(c) for c in zip(*Subtrees(keys, n, depth).summary, strict=True)]
            grid = cols[0] * 256 + cols[1]
            at, inv = np.unique(grid, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at)] + [pa.array(np.bincount(inv, c, len(at)).astype(float)) for c in cols[2:]],
                ["node", "zeros", "ones", "below"])

    # at most 256 x 255 rows
    rows = (grams.mapInArrow(summarise, "node long, zeros double, ones double, below double")
            .groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")]).toArrow())
    node, zeros, ones, below = (rows.column(c).to_numpy() for c in ("node", "zeros", "ones", "below"))
    upper = spark.sparkContext.broadcast(Upper(node >> 8, node & 255, zeros, ones, below))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = _table(batches)
        if len(keys):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(upper.value.log10(Subtrees(keys, n, depth), depth)), pa.array(n)],
                ["key", "value", "n"])

    return grams.mapInArrow(finish, "key long, value double, n long")


def frequent(rows: DataFrame, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """``key, value`` of the rows of highest ``n``, at most ``bound`` of them:
    those with n of at least the least power of two that few enough reach."""
    level = F.floor(F.log2(F.greatest("n", F.lit(1)))).cast("int")
    sizes = dict(rows.groupBy(level.alias("level")).count().collect())
    total, least = 0, None
    for lv in sorted(sizes, reverse=True):
        total += sizes[lv]
        if total > bound:
            break
        least = lv
    if least is None:
        return np.empty(0, np.int64), np.empty(0)
    got = rows.filter(level >= least).select("key", F.col("value").cast("double").alias("value")).toArrow()
    return got.column("key").to_numpy(), got.column("value").to_numpy()


SCORED = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double, n_bytes long")


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns SCORED per document. The training part are the documents whose
    crc32(doc_id as text) mod 7 is not 2."""
    spark = docs.sparkSession
    ship_package(spark)
    held = F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held.alias("held"), F.col(text).alias("text"))
    counts = materialise(count(rows), "ctw-counts")
    ends = rows.filter(~F.col("held")).count()
    known, n_words = counts.filter(F.col("kind") == WORD).agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    train_tokens = (n_words or 0) + ends
    whole = train_tokens + (known + (1 if ends else 0) + 1)      # N + 1 * (V + 1)
    grams = materialise(model(counts), "ctw-model")
    words = counts.filter(F.col("kind") == WORD).select("key", F.col("n").alias("value"), "n")
    tables = spark.sparkContext.broadcast((Lookup(*frequent(words, FREQUENT_WORDS)), Lookup(*frequent(grams, FREQUENT))))

    def base(c):
        return np.log10((c + 1) / whole)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        tag = TaskContext.get().partitionId() << 33
        word_table, gram_table = tables.value
        for ids, held_out, chunk in text_chunks(batches, SCORE_CHUNK):
            n = len(chunk)
            tags = tag + np.arange(n)
            tag += n
            sizes = np.array([len(w) for w in chunk], dtype=np.int64)
            doc = np.repeat(np.arange(n), sizes)
            number: dict[bytes, int] = {}
            at = np.fromiter((number.setdefault(w, len(number)) for d in chunk for w in d), np.int64, int(sizes.sum()))
            hashed = hashes(list(number))
            place = word_table.find(hashed)
            c = np.append(word_table.values, np.nan)[place]      # nan: not frequent
            v = base(c)
            found = ~np.isnan(c[at]) if len(c) else np.zeros(0, dtype=bool)
            s_base = np.bincount(doc[found], v[at[found]], n) + base(float(ends))
            n_known = np.bincount(doc[found], c[at[found]] > 0, n).astype(np.int64) + (1 if ends else 0)
            # words that are not frequent, counted per document
            rest, times = np.unique(doc[~found] * max(len(number), 1) + at[~found], return_counts=True)
            tail = [(WORD, tags[rest // max(len(number), 1)], hashed[rest % max(len(number), 1)], times)] \
                if len(rest) else []
            texts = [as_bytes(w) for w in chunk]
            keys, begin = gram_keys(texts)
            length = np.array([len(t) for t in texts], dtype=np.int64)
            place = gram_table.find(keys)
            lost = place < 0
            value = np.where(lost, 0.0, np.append(gram_table.values, 0.0)[place])
            s_model = np.add.reduceat(value, begin)
            if lost.any():
                d = np.repeat(np.arange(n), length)[lost]
                order = np.lexsort((keys[lost], d))
                d, k = d[order], keys[lost][order]
                new = np.ones(len(d), dtype=bool)
                new[1:] = (d[1:] != d[:-1]) | (k[1:] != k[:-1])
                first = np.nonzero(new)[0]
                tail.append((GRAM, tags[d[first]], k[first], np.diff(np.append(first, len(d)))))
            none = pa.nulls
            yield pa.RecordBatch.from_arrays(
                [pa.array(tags), none(n, pa.int32()), none(n, pa.int64()), none(n, pa.int64()), pa.array(ids, pa.int64()),
                 pa.array(held_out), pa.array(sizes + 1), pa.array(n_known), pa.array(s_base), pa.array(s_model),
                 pa.array(length)], names)
            for kind, t, k, times in tail:
                m = len(t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t), pa.array(np.full(m, kind, dtype=np.int32)), pa.array(k), pa.array(times),
                     none(m, pa.int64()), none(m, pa.bool_()), none(m, pa.int64()), none(m, pa.int64()),
                     none(m, pa.float64()), none(m, pa.float64()), none(m, pa.int64())], names)

    schema = ("tag long, kind int, key long, times long, doc_id long, held_out boolean, n_tokens long, n_known long, "
              "base_score double, score double, n_bytes long")
    names = [c.split()[0] for c in schema.split(", ")]
    # one written result: a document's row and its tail rows share a tag
    out = materialise(rows.mapInArrow(scan, schema), "ctw-scan")
    tables.destroy()
    tail = out.filter("kind is not null").select("tag", "kind", "key", "times")
    values = words.select(F.lit(WORD).alias("kind"), "key", F.col("n").cast("double").alias("value")).unionByName(
        grams.select(F.lit(GRAM).alias("kind"), "key", "value"))
    joined = tail.join(values, ["kind", "key"], "left")
    c = F.coalesce("value", F.lit(0.0))
    more = joined.groupBy("tag").agg(
        F.sum(F.when(F.col("kind") == WORD, F.col("times") * F.log10((c + 1) / F.lit(float(whole))))).alias("base_more"),
        F.sum(F.when((F.col("kind") == WORD) & (c > 0), F.col("times"))).alias("known_more"),
        F.sum(F.when(F.col("kind") == GRAM, F.col("times") * F.col("value"))).alias("score_more"))

    def plus(a, b):
        return (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a)
    return (out.filter("kind is null").join(more, "tag", "left")
            .select("doc_id", "held_out", "n_tokens", plus("n_known", "known_more"),
                    F.lit(train_tokens).cast("long").alias("train_tokens"), plus("base_score", "base_more"),
                    plus("score", "score_more"), "n_bytes"))
