"""Phrase collocation mining by top-order marginalisation.

Texts (A-Z lower-cased) are split into pieces and those into words. Every word
opens exactly one window of ``ORDER`` lead columns, padded where its piece ends;
only these longest windows are counted, and one Spark ``ROLLUP`` over the lead
columns sums them to all shorter prefixes: the sum at prefix (w1, w2) is the
count of the phrase "w1 w2", the sum over everything the number of words. No
n-gram of a lower order is ever listed.

1. A chunk of text sums its equal windows and sends them, column by column and
   compressed, to the part of their first word. Common words are numbered by a
   dictionary of at most ``CODES`` words, the others are spelled out.
2. A part adds up its windows. Only phrases of ``least`` occurrences matter, and
   every window of a prefix is in the same part, so a window that occurs less
   often is padded from the end until its prefix occurs ``least`` times, and
   equal ones are added again. The sums of all wanted prefixes stay as they are,
   and few windows are left.
3. ``ROLLUP`` sums those.

A first word that a bounded sample of documents shows to be common is dealt out
by its second word as well, a common pair by its third; such windows are padded
down to the word or pair only, and the sums of the parts meet in the ROLLUP. The
dictionary comes from the same sample. Both decide how windows travel, not the
result.

Cuts join the table of counted phrases twice; containment in a longer phrase is
a maximum per contained phrase with partial sums; ranks are taken inside
``SALTS`` parts of a language first.

Cases: null text is empty, null language is ``missing``; an empty table or one
without frequent phrases gives no rows; repeated rows count each time; a piece
of any length is one unit, longer texts are worked on piece by piece; ties in
rank are broken by the phrase, which is unique; only the two named columns are
read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, partitions, release, ship_package, tmp

ORDER = 4
#: Documents of the sample that names common words, words of the dictionary.
SAMPLE_DOCS, CODES = 2000, 60_000
#: A word or pair is common if its share would fill this part of a task.
COMMON_PART = 0.125
#: Bytes of text a task works on at once.
CHUNK = 4 << 20
#: Parts of a language that are ranked on their own first.
SALTS = 64
#: Upper-case letters fall, ends of pieces become line feeds.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9)
_BREAK = b"\xff"              # a byte that UTF-8 does not use
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


def units(raw: bytes, size: int) -> Iterator[bytes]:
    """A folded text in parts of about ``size`` bytes, cut where pieces end."""
    at = 0
    while len(raw) - at > size:
        cut = raw.rfind(b"\n", at, at + size)
        if cut < 0:
            cut = raw.find(b"\n", at + size)
        if cut < 0:
            break
        yield raw[at:cut + 1]
        at = cut + 1
    yield raw[at:]


def chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, list[bytes]]]:
    """``(language, texts)`` of about ``size`` bytes from batches (lang, text)."""
    held, n = {}, 0
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
        for lang, text in zip(langs, texts, strict=True):
            for part in units((text.as_py() or b"").translate(_FOLD), size):
                held.setdefault(lang, []).append(part)
                n += len(part) + 1
                if n >= size:
                    yield from held.items()
                    held, n = {}, 0
    yield from held.items()


class Words:
    """Words of a chunk: ``ids`` in text order (-1 between pieces), the
    distinct ``words`` and their hashes, which depend on the language."""

    def __init__(self, lang: str, texts: list[bytes]):
        tokens = b"\n".join(texts).replace(b"\n", b" " + _BREAK + b" ").split()
        number = {w: i for i, w in enumerate(dict.fromkeys(tokens))}
        ids = np.fromiter(map(number.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        self.words = list(number)
        stop = number.get(_BREAK, -1)
        self.ids = np.where(ids == stop, -1, ids)
        seed = xxhash.xxh32_intdigest(lang.encode())
        self.hash = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.words), dtype=np.uint64,
                                count=len(self.words))

    def windows(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct windows, ``order`` columns of word numbers from 1 (0:
        padding), and how often each occurs."""
        starts = np.nonzero(self.ids >= 0)[0]
        ids = np.append(self.ids, np.full(order, -1)) + 1
        columns, alive = [], np.ones(len(starts), dtype=bool)
        for k in range(order):
            column = ids[starts + k]
            alive = alive & (column > 0)
            columns.append(np.where(alive, column, 0))
        return summed(np.stack(columns), np.ones(len(starts), dtype=np.int64))


def summed(columns: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns in order, with the sums of ``n``."""
    if not len(n):
        return columns, n
    base = int(columns.max()) + 1
    code, key = np.unique(columns[0], return_inverse=True)
    out = code[None, :]
    for column in columns[1:]:
        code, key = np.unique(key * base + column, return_inverse=True)
        out = np.concatenate([out[:, code // base], (code % base)[None, :]])
    return out, np.bincount(key, n, minlength=len(code)).astype(np.int64)


def mixed(*hashes: np.ndarray) -> np.ndarray:
    """One hash of several, by place."""
    x = hashes[0]
    for k, h in enumerate(hashes[1:]):
        x = (x ^ (x >> np.uint64(29))) * _K[0] + h * _K[1 + k % 2]
    x = (x ^ (x >> np.uint64(32))) * _K[2]
    return x ^ (x >> np.uint64(29))


@dataclass
class Routes:
    """What all tasks know: codes of common words and hashes of the first
    words and pairs that are dealt out further."""
    codes: dict[bytes, int] = field(default_factory=dict)
    size: int = 0                  # codes run from 1 to size
    words: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    pairs: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))

    def depth(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """How many words decide a window's part."""
        common = np.isin(h1, self.words)
        return 1 + common + (common & np.isin(mixed(h1, h2), self.pairs))

    def part(self, h: list[np.ndarray], parts: int) -> np.ndarray:
        depth = self.depth(h[0], h[1])
        at = np.where(depth == 1, mixed(h[0]), np.where(depth == 2, mixed(h[0], h[1]), mixed(*h[:3])))
        return (at % np.uint64(parts)).astype(np.int32)


def packed(columns: np.ndarray, n: np.ndarray, size: int, spelled: list[bytes], press: zstandard.ZstdCompressor) -> bytes:
    """Windows as one compressed block; numbers beyond the ``size`` codes are
    places in ``spelled``."""
    used = np.unique(columns[columns > size])
    columns = np.where(columns > size, size + 1 + np.searchsorted(used, columns), columns).astype("<u4")
    words = b" ".join(spelled[i - size - 1] for i in used.tolist())
    head = np.array([len(n), len(words)], dtype="<u8").tobytes()
    return press.compress(head + words + columns.tobytes() + n.astype("<u8").tobytes())


def unpacked(block: bytes, order: int, press: zstandard.ZstdDecompressor) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    raw = press.decompress(block)
    size, wide = np.frombuffer(raw, dtype="<u8", count=2).tolist()
    columns = np.frombuffer(raw, dtype="<u4", count=order * size, offset=16 + wide).reshape(order, size)
    n = np.frombuffer(raw, dtype="<u8", count=size, offset=16 + wide + columns.nbytes)
    return columns.astype(np.int64), n.astype(np.int64), raw[16:16 + wide].split()


def sent(routes, parts: int, order: int, chunk: int):
    """Arrow batch function over (lang, text): blocks of windows, one for each
    part that a chunk has windows for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, press = routes.value, zstandard.ZstdCompressor(level=3)
        for lang, texts in chunks(batches, chunk):
            w = Words(lang, texts)
            columns, n = w.windows(order)
            if not len(n):
                continue
            hashes = np.append(np.uint64(0), w.hash)
            part = known.part([hashes[c] for c in columns[:3]], parts)
            code = np.fromiter((known.codes.get(x, 0) for x in w.words), dtype=np.int64, count=len(w.words))
            spelled = np.flatnonzero(code == 0)
            code[spelled] = known.size + 1 + np.arange(len(spelled))
            columns = np.append(0, code)[columns]
            words = [w.words[i] for i in spelled.tolist()]
            by = np.argsort(part, kind="stable")
            columns, n, part = columns[:, by], n[by], part[by]
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(part[a])], pa.int32()), pa.array([lang], pa.string()),
                     pa.array([packed(columns[:, a:b], n[a:b], known.size, words, press)], pa.binary())],
                    ["part", "lang", "block"])
            release()
    return run


def shortened(columns: np.ndarray, n: np.ndarray, depth: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows in order, padded from the end while their prefix occurs
    less than ``least`` times, and equal ones added. A prefix is judged only if
    all its windows are here: if it has the ``depth`` words that decide the
    part."""
    if not len(n):
        return columns, n
    size = (columns > 0).sum(axis=0)
    new, group, groups = np.zeros(len(n), dtype=bool), [], 0
    new[0] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
        group.append(np.cumsum(new) - 1)
    for k in range(len(columns), 0, -1):
        rare = np.bincount(group[k - 1], n)[group[k - 1]] < least
        size = np.where((size >= k) & (k >= depth) & rare, k - 1, size)
    # windows cut to the same size inside one group of that size are equal
    key = np.zeros(len(n), dtype=np.int64)
    for k, at in enumerate(group, 1):
        key = np.where(size == k, k * len(n) + at, key)
    _, first, at = np.unique(key, return_index=True, return_inverse=True)
    out = np.where(np.arange(len(columns))[:, None] < size[first], columns[:, first], 0)
    return out, np.bincount(at, n).astype(np.int64)


def added(routes, order: int, least: int, fold: int = 1 << 21):
    """Arrow batch function over (part, lang, block): the windows of a part,
    summed and shortened, as ``(lang, w1 .., n)``. Blocks are added up whenever
    ``fold`` windows, and as many as there are, have come together."""
    def total(mine):
        return summed(np.concatenate([x[0] for x in mine], axis=1), np.concatenate([x[1] for x in mine]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, press = routes.value, zstandard.ZstdDecompressor()
        held, spelled = {}, {}
        for batch in batches:
            for lang, block in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                columns, n, words = unpacked(block.as_py(), order, press)
                number = spelled.setdefault(lang, {})
                own = np.fromiter((number.setdefault(x, len(number)) for x in words), dtype=np.int64, count=len(words))
                beyond = columns > known.size
                columns[beyond] = known.size + 1 + own[columns[beyond] - known.size - 1]
                mine = held.setdefault(lang, [])
                mine.append((columns, n))
                if sum(len(x[1]) for x in mine[1:]) > max(fold, len(mine[0][1])):
                    mine[:] = [total(mine)]
        for lang in list(held):
            columns, n = total(held.pop(lang))
            words = [b"", *known.codes, *spelled.pop(lang)]
            used = np.unique(columns[:2])
            seed = xxhash.xxh32_intdigest(lang.encode())
            hashes = np.zeros(len(words), dtype=np.uint64)
            hashes[used] = [xxhash.xxh64_intdigest(words[i], seed) if i else 0 for i in used.tolist()]
            columns, n = shortened(columns, n, known.depth(hashes[columns[0]], hashes[columns[1]]), least)
            left, columns = np.unique(columns, return_inverse=True)
            text = pa.array([words[i] for i in left.tolist()], pa.binary()).cast(pa.string())
            columns = columns.reshape(order, len(n))
            for at in range(0, len(n), 1 << 16):
                some = [text.take(pa.array(c[at:at + (1 << 16)])) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some[0]), pa.string()), *some, pa.array(n[at:at + (1 << 16)])],
                    ["lang", *[f"w{k + 1}" for k in range(order)], "n"])
        release()
    return run


def known_routes(rows: DataFrame, parts: int, chunk: int) -> Routes:
    """Dictionary and common words and pairs from a bounded sample: the texts
    of least hash, equal ones once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in chunks(batches, chunk):
            w = Words(lang, texts)
            columns, n = w.windows(2)
            if not len(n):
                continue
            hashes = np.append(np.uint64(0), w.hash)
            words = pa.array([b"", *(x if x != _BREAK else b"" for x in w.words)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [words.take(pa.array(columns[0])), pa.array(hashes[columns[0]].view(np.int64)),
                 pa.array(mixed(hashes[columns[0]], hashes[columns[1]]).view(np.int64)), pa.array(n)],
                ["word", "first", "pair", "n"])
    hashed = rows.withColumn("h", F.xxhash64("text"))
    least_hashes = hashed.select("h").distinct().orderBy("h").limit(SAMPLE_DOCS)
    few = hashed.join(F.broadcast(least_hashes), "h", "left_semi").dropDuplicates(["lang", "h"])
    pairs = materialise(few.select("lang", "text").mapInArrow(run, "word binary, first long, pair long, n long"), "phrase-sample")
    total = pairs.agg(F.sum("n")).first()[0]
    if not total:
        return Routes()
    least = max(2, int(total * COMMON_PART / parts))      # so at most 8 x parts of each are common
    codes = (pairs.filter(F.length("word") > 0).groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word")
             .limit(CODES).select("word").collect())

    def common(column: str) -> np.ndarray:
        got = pairs.groupBy(column).agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select(column).collect()
        return np.sort(np.array([r[0] for r in got], dtype=np.int64).view(np.uint64))
    return Routes({bytes(r[0]): i + 1 for i, r in enumerate(codes)}, len(codes), common("first"), common("pair"))


def phrase_counts(docs: DataFrame, text: str, lang: str, missing: str, least: int, order: int,
                  chunk: int = CHUNK) -> DataFrame:
    """``(lang, phrase, words, f)`` of every phrase of up to ``order`` words
    that occurs ``least`` times, and a row of no words with the number of all."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.coalesce(F.col(lang), F.lit(missing)).alias("lang"), F.col(text).alias("text"))
    leads = [f"w{k + 1}" for k in range(order)]
    parts = partitions(spark)
    routes = spark.sparkContext.broadcast(known_routes(rows, parts, chunk))
    blocks = rows.mapInArrow(sent(routes, parts, order, chunk), "part int, lang string, block binary")
    top = blocks.repartitionById(parts, "part").mapInArrow(
        added(routes, order, least), "lang string, " + ", ".join(f"{c} string" for c in leads) + ", n long")
    listed = ", ".join(leads)
    sums = spark.sql(f"SELECT lang, {listed}, sum(n) AS f FROM {{top}} GROUP BY lang, ROLLUP({listed})", top=top)
    last = F.coalesce(*reversed(leads))               # null: the sum over all windows
    wanted = sums.filter(last.isNull() | ((last != "") & (F.col("f") >= least)))
    return materialise(wanted.select("lang", F.concat_ws(" ", *leads).alias("phrase"),
                                     sum(F.col(c).isNotNull().cast("int") for c in leads).alias("words"), "f"), "phrases")


def _joined(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def scored(phrases: DataFrame) -> DataFrame:
    """``(lang, phrase, words, a, l, r, score)`` of the phrases of two words or
    more at their lowest-scoring cut."""
    words = F.split("phrase", " ")
    cuts = phrases.filter("words > 1").select(
        "lang", "phrase", "words", F.col("f").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    cuts = cuts.withColumn("left", _joined(words, F.lit(1), F.col("cut"))).withColumn(
        "right", _joined(words, F.col("cut") + 1, F.col("words") - F.col("cut")))
    part = phrases.filter("words > 0")
    for side, f in (("left", "l"), ("right", "r")):
        cuts = cuts.join(part.select("lang", F.col("phrase").alias(side), F.col("f").alias(f)), ["lang", side])
    wide = F.col("a").cast("decimal(20,0)") * F.lit(2_000_000)
    score = F.call_function("div", wide, (F.col("l").cast("decimal(20,0)") + F.col("r")))
    least = (cuts.withColumn("score", score).groupBy("lang", "phrase", "words", "a")
             .agg(F.min(F.struct("score", "cut", "l", "r")).alias("c")))
    return least.select("lang", "phrase", "words", "a", "c.l", "c.r", "c.score")


def contained(phrases: DataFrame, order: int, share: int) -> DataFrame:
    """``(lang, phrase)`` of phrases inside a longer one that occurs at least
    ``share`` in 100 as often."""
    words = F.split("phrase", " ")
    lengths = F.sequence(F.lit(2), F.col("words") - 1)
    inner = F.flatten(F.transform(lengths, lambda n: F.transform(
        F.sequence(F.lit(1), F.col("words") - n + 1), lambda at: _joined(words, at, n))))
    most = (phrases.filter("words > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "f")
            .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    both = most.join(phrases.select("lang", "phrase", "f"), ["lang", "phrase"])
    return both.filter(F.col("longer").cast("decimal(20,0)") * 100 >= F.col("f").cast("decimal(20,0)") * share).select(
        "lang", "phrase")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", missing: str = "und", least: int = 30,
                 top: int = 2000, order: int = ORDER, share: int = 80, chunk: int = CHUNK) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first
    ``top`` phrases of 2 to ``order`` (3 at least) words with ``least``
    occurrences."""
    phrases = phrase_counts(docs, text, lang, missing, least, order, chunk)
    left = scored(phrases).join(contained(phrases, order, share), ["lang", "phrase"], "left_anti")
    salt, part = tmp("salt"), tmp("part")
    by = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    left = left.withColumn(salt, F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    left = (left.withColumn(part, F.row_number().over(Window.partitionBy("lang", salt).orderBy(*by)))
            .filter(F.col(part) <= top).drop(salt, part))
    ranked = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by))).filter(
        F.col("rank") <= top)
    n = phrases.filter("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                         "score")
