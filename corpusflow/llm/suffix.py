"""Suffix dedup by bucket-pointer refinement: removes repeated byte strings.

Every byte covered by a string of ``LENGTH`` (100) bytes that also starts
earlier - in a smaller document, or before in the same one - is removed;
strings never cross documents and are judged on the input.

Bucket-pointer refinement sorts suffixes into buckets by their first q bytes
and refines a bucket by the bucket identifiers of its suffixes at later
offsets; refined identifiers are used again, so the sorted depth doubles. Here
a bucket identifier is a hash of the bytes it stands for, so every machine
knows the identifier at any offset without asking another: q = 25, the
identifier of 50 bytes comes from those at offsets 0 and 25, that of 100 bytes
from the 50-byte ones at offsets 0 and 50 (``refine``). Only equality at depth
100 matters, so refinement stops there, and it runs only where it can matter:

1. Sampled suffixes. Of the 76 q-grams of a 100-byte window the one with the
   least identifier is its anchor; equal windows have the same anchor at the
   same place. An anchor stands for a run of neighbouring windows; about one
   byte in 38 is an anchor. Anchors are sent to their initial bucket, the
   q-gram identifier, with an identifier of all bytes of their run.
2. Initial buckets. A bucket with one member is settled: its windows occur
   once. Members whose run equals an earlier member's are settled too: all
   their windows occurred earlier. Only first members of different runs in a
   shared bucket go on.
3. First refinement, by the identifiers at the offsets around the q-gram: the
   windows of a run that reach far to the right of their anchor all hold the 62
   bytes from the anchor on, the others the 62 bytes that end with it. Each
   half of a run goes to the bucket of those 62 bytes and is settled as in 2.
4. Second refinement. The windows of the halves that are left get their
   100-byte identifiers, refined as above, and are sent to those buckets; all
   but the first of a bucket are repeats.

Equal runs and windows inside one chunk of a task are settled before anything
is sent, so copies of one text do not pile up in a bucket. A q-gram that a
bounded sample of documents shows to be very common skips step 2: its windows
go to their fully refined buckets at once, which a common line in different
surroundings does not share.

Identifiers of windows and runs have 128 bits in all. Rows of equal doc_id are
told apart and ordered by a row tag; null doc_id sorts first. Null text is the
empty text; texts under 100 bytes keep everything; texts of any length are
processed in slices that overlap by 99 bytes; extra columns pass through and
one named like an output is replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import partitions, release, ship_package, tmp

LENGTH, Q = 100, 25
SPAN = LENGTH - Q + 1          # q-grams of a window
#: Bytes of text a task works on at once.
CHUNK = 1 << 21
#: Sample that finds very common q-grams: documents, and the share of them
#: that holds a common one.
SAMPLE_DOCS, COMMON_SHARE = 2000, 0.01
HALF = (SPAN - 1) // 2         # windows up to here before the anchor are the right half
#: A row's place is first window << 16 | anchor - first window << 8 | windows
#: after the first; the last byte 255 marks an interval instead of a run.
_INTERVAL = 255
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
ROWS = "g long, h long, doc long, tag long, at long"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _K[3]
    return x ^ (x >> np.uint64(29))


def bucket_ids(data: np.ndarray) -> np.ndarray:
    """Identifier of the q-gram at every position of a byte array."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    raw = data.tobytes()

    def word(offset: int) -> np.ndarray:
        return np.ndarray((n,), dtype="<u8", buffer=raw, offset=offset, strides=(1,))
    x = word(0) * _K[0]
    x ^= x >> np.uint64(31)
    for k, offset in ((1, 8), (2, 16), (0, Q - 8)):
        x += word(offset)
        x *= _K[k]
        x ^= x >> np.uint64(30)
    return _mix(x)


def refine(ids: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """100-byte identifiers of the windows at ``at`` by two refinements: the
    50-byte identifiers at offsets 0 and 50, each from q-gram identifiers at
    offsets 0 and 25. ``k`` picks one of two independent mixes."""
    def fifty(p):
        return _mix(ids[p] * _K[k] + ids[p + Q])
    return _mix(fifty(at) * _K[k] + fifty(at + 2 * Q))


class Chunk:
    """Texts laid side by side; positions are places in ``data``."""

    def __init__(self, docs: list[int], tags: list[int], starts: list[int], texts: list[bytes]):
        self.data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.first = np.cumsum(sizes) - sizes            # of each slice in data
        self.sizes = sizes
        self.doc, self.tag = np.array(docs, dtype=np.int64), np.array(tags, dtype=np.int64)
        self.shift = np.array(starts, dtype=np.int64) - self.first
        self.ids = bucket_ids(self.data)

    def slice_of(self, p: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, p, side="right") - 1

    def windows(self) -> np.ndarray:
        """Starts of all windows inside one slice."""
        n = len(self.data) - LENGTH + 1
        if n <= 0:
            return np.empty(0, dtype=np.int64)
        ok = np.ones(n, dtype=bool)
        for end in (self.first + self.sizes).tolist():
            ok[max(end - LENGTH + 1, 0):end] = False
        return np.nonzero(ok)[0]

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(anchor, first window, last window)`` of every run of neighbouring
        windows with one anchor."""
        w = self.windows()
        if not len(w):
            return w, w, w
        # leftmost least identifier of SPAN q-grams, by doubling; the place in
        # the low 24 bits makes the minimum carry it along
        low = (self.ids & ~np.uint64(0xFFFFFF)) | np.arange(len(self.ids), dtype=np.uint64)
        span = 1
        while 2 * span <= SPAN:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        low = np.minimum(low[:len(low) - (SPAN - span)], low[SPAN - span:])
        anchor = (low[w] & np.uint64(0xFFFFFF)).astype(np.int64)
        new = np.ones(len(w), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (w[1:] != w[:-1] + 1)
        at = np.nonzero(new)[0]
        last = np.append(at[1:], len(w)) - 1
        return anchor[at], w[at], w[last]

    def run_ids(self, anchor: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Identifier of all bytes of a run and the anchor's place in it."""
        x = _mix(((hi - lo) * 256 + (anchor - lo)).astype(np.uint64) + _K[1])
        end = hi + LENGTH - Q
        for k in range(0, SPAN + LENGTH, Q):
            x = _mix(x * _K[2] + self.ids[np.minimum(lo + k, end)])
        return x


def slices(rows: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple]:
    """``(doc, tag, start, bytes, extra)`` from batches (doc, tag, text[, extra]);
    long texts as slices that overlap by LENGTH - 1 bytes."""
    for batch in rows:
        cols = [batch.column(i) for i in range(batch.num_columns)]
        for i in range(batch.num_rows):
            text = cols[2][i].as_py()
            raw = (text or "").encode() if not isinstance(text, bytes) else text
            extra = cols[3][i].values.to_numpy() if len(cols) > 3 else None
            for start in range(0, max(len(raw) - LENGTH + 1, 1), size):
                yield cols[0][i].as_py(), cols[1][i].as_py(), start, raw[start:start + size + LENGTH - 1], extra
        release()


def chunks(rows: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[Chunk, list]]:
    """Chunks of about ``size`` bytes, slices in (doc, tag, start) order."""
    held, n = [], 0

    def take():
        held.sort(key=lambda s: s[:3])
        docs, tags, starts, texts, extra = zip(*held, strict=True)
        return Chunk(list(docs), list(tags), list(starts), list(texts)), list(extra)
    for s in slices(rows, size):
        if held and n + len(s[3]) > size:
            yield take()
            held, n = [], 0
        held.append(s)
        n += len(s[3])
    if held:
        yield take()


def first_places(*keys: np.ndarray) -> np.ndarray:
    """For each element the place of the first equal one (all keys equal)."""
    n = len(keys[0])
    both = keys[0] * _K[0] + keys[1]
    _, first, inverse = np.unique(both, return_index=True, return_inverse=True)
    at = first[inverse]
    same = (keys[0][at] == keys[0]) & (keys[1][at] == keys[1])
    return np.where(same, at, np.arange(n))


def _batch(g, h, doc, tag, at) -> pa.RecordBatch:
    def as_long(x):
        return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x)
    return pa.RecordBatch.from_arrays([as_long(x) for x in (g, h, doc, tag, at)], ["g", "h", "doc", "tag", "at"])


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals [lo, hi) as disjoint, sorted, maximal ones."""
    if not len(lo):
        return lo, hi
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), dtype=bool)
    new[1:] = lo[1:] > hi[:-1]
    at = np.nonzero(new)[0]
    return lo[at], hi[np.append(at[1:], len(lo)) - 1]


def interval_rows(c: Chunk, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
    """Settled repeats [lo, hi) of a chunk, merged per slice, as rows that are
    spread by their own key."""
    s = c.slice_of(lo)
    # slices lie apart by one extra place each, so intervals of two never merge
    lo, hi = merged(lo + s, hi + s)
    s = np.searchsorted(c.first + np.arange(len(c.first)), lo, side="right") - 1
    a, b = lo - s + c.shift[s], hi - s + c.shift[s]
    own = _mix((c.tag[s] * 31 + a).astype(np.uint64) + _K[0])
    return _batch(own, b, c.doc[s], c.tag[s], (a << 16) | _INTERVAL)


def run_rows(c: Chunk, g: np.ndarray, anchor: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Runs in their buckets ``g``; equal runs inside the chunk are settled."""
    if not len(lo):
        return
    h = c.run_ids(anchor, lo, hi)
    first = first_places(g, h)
    again = first != np.arange(len(g))
    if again.any():
        yield interval_rows(c, lo[again], hi[again] + LENGTH)
    g, h, anchor, lo, hi = (x[~again] for x in (g, h, anchor, lo, hi))
    s = c.slice_of(lo)
    yield _batch(g, h, c.doc[s], c.tag[s], (lo + c.shift[s]) << 16 | (anchor - lo) << 8 | (hi - lo))


def runs_of(c: Chunk, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(anchor, first, last window)`` in the chunk of the runs of its slices,
    in text order: of equal runs the earliest must come first. Runs were made
    of the same slices, so each lies in one."""
    out = []
    for s, at in enumerate(rows):
        at = np.sort(at)
        lo = (at >> 16) - c.shift[s]
        ok = (lo >= c.first[s]) & (lo + LENGTH <= c.first[s] + c.sizes[s])
        out.append(np.stack([lo + (at >> 8 & 255), lo, lo + (at & 255)], 1)[ok])
    return tuple(np.concatenate(out).T) if out else (np.empty(0, np.int64),) * 3


def window_rows(c: Chunk, at: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Windows in their refined buckets; repeats inside the chunk are settled."""
    at = np.unique(at)
    if not len(at):
        return
    g, h = refine(c.ids, at, 0), refine(c.ids, at, 1)
    first = first_places(g, h)
    again = first != np.arange(len(at))
    if again.any():
        yield interval_rows(c, at[again], at[again] + LENGTH)
    at, g, h = at[~again], g[~again], h[~again]
    s = c.slice_of(at)
    yield _batch(g, h, c.doc[s], c.tag[s], (at + c.shift[s]) << 16)


def settle(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets in (g, h, doc, tag, at) order -> ``(tag, at, end)``: intervals
    of repeats (``end`` > 0), and runs to refine (``end`` = 0): the first
    members of different runs that share a bucket."""
    last_g = last_h = None
    pending = None             # first member of the last bucket, while it is alone

    for batch in rows:
        if not batch.num_rows:
            continue
        g, h, tag, at = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2, 3))
        gap = (at & 255) == _INTERVAL
        out_tag, out_at, out_end = [tag[gap]], [at[gap] >> 16], [h[gap]]
        keep = ~gap
        g, h, tag, at = g[keep], h[keep], tag[keep], at[keep]
        if len(g):
            new_g = np.ones(len(g), dtype=bool)
            new_g[1:] = g[1:] != g[:-1]
            new_g[0] = g[0] != last_g
            new_h = new_g.copy()
            new_h[1:] |= h[1:] != h[:-1]
            new_h[0] |= h[0] != last_h
            old = ~new_h
            start = at[old] >> 16
            out_tag.append(tag[old])
            out_at.append(start)
            out_end.append(start + (at[old] & 255) + LENGTH)
            rep = np.nonzero(new_h)[0]
            if len(rep):
                fresh = new_g[rep]                          # first run of its bucket
                bucket = np.cumsum(fresh)                   # 0: goes on from the last batch
                size = np.bincount(bucket)
                shared = size[bucket] > 1
                shared[bucket == 0] = True
                if bucket[0] == 0 and pending is not None:
                    out_tag.append(np.array([pending[0]]))
                    out_at.append(np.array([pending[1]]))
                    out_end.append(np.zeros(1, dtype=np.int64))
                    pending = None
                tail = bucket == bucket[-1]
                if bucket[-1] > 0:
                    pending = (tag[rep[-1]], at[rep[-1]]) if tail.sum() == 1 else None
                out_tag.append(tag[rep[shared]])
                out_at.append(at[rep[shared]])
                out_end.append(np.zeros(int(shared.sum()), dtype=np.int64))
            last_g, last_h = g[-1], h[-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).astype(np.int64)) for x in (out_tag, out_at, out_end)], ["tag", "at", "end"])


def spread(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All places of the ranges lo..hi."""
    size = hi - lo + 1
    begin = np.cumsum(size) - size
    return np.repeat(lo - begin, size) + np.arange(int(size.sum()))


def common_grams(docs: DataFrame, tag: str, text: str) -> np.ndarray:
    """Anchor q-grams that at least COMMON_SHARE of a sample of documents hold.
    The sample is bounded by SAMPLE_DOCS; it decides only which way a q-gram's
    windows go, not the result."""
    few = docs.select(tag).orderBy(F.xxhash64(tag)).limit(SAMPLE_DOCS)
    rows = docs.select(F.lit(0).cast("long").alias("doc"), F.col(tag).alias("tag"), F.col(text).alias("text"), tag).join(
        F.broadcast(few), tag, "left_semi").select("doc", "tag", "text")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c, _ in chunks(batches, CHUNK):
            anchor, _, _ = c.anchors()
            pairs = np.unique(np.stack([c.ids[anchor].view(np.int64), c.tag[c.slice_of(anchor)]], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["g", "tag"])

    least = max(8, int(COMMON_SHARE * SAMPLE_DOCS))
    got = (rows.mapInArrow(grams, "g long, tag long").groupBy("g").agg(F.count_distinct("tag").alias("n"))
           .filter(F.col("n") >= least).select("g").collect())
    return np.sort(np.array([r[0] for r in got], dtype=np.int64).view(np.uint64))


def repeats(docs: DataFrame, tag: str, doc: str, text: str) -> DataFrame:
    """``(tag, spans)``: intervals [start, end) of repeated bytes of the rows
    that have any, as ``array<struct<at, end>>`` (they may overlap)."""
    spark = docs.sparkSession
    ship_package(spark)
    n = partitions(spark)
    common = spark.sparkContext.broadcast(common_grams(docs, tag, text))
    rows = docs.select(F.coalesce(F.col(doc), F.lit(-(1 << 63))).alias("doc"), F.col(tag).alias("tag"),
                       F.col(text).alias("text"))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c, _ in chunks(batches, CHUNK):
            anchor, lo, hi = c.anchors()
            if not len(anchor):
                continue
            often = np.isin(c.ids[anchor], common.value)
            if often.any():
                yield from window_rows(c, spread(lo[often], hi[often]))
            yield from run_rows(c, c.ids[anchor[~often]], anchor[~often], lo[~often], hi[~often])

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c, rows in chunks(batches, CHUNK):
            anchor, lo, hi = runs_of(c, rows)
            cut = anchor - HALF                       # first window of the right half
            for side, lo_, hi_ in ((0, np.maximum(lo, cut), hi), (1, lo, np.minimum(hi, cut - 1))):
                ok = lo_ <= hi_
                p = anchor[ok]
                at = p if side == 0 else p - HALF
                # the q-grams at 0, 19 and 37 cover the 62 bytes
                g = _mix(_mix(c.ids[at] * _K[side] + c.ids[at + HALF // 2 + 1]) * _K[2] + c.ids[at + HALF])
                yield from run_rows(c, g, p, lo_[ok], hi_[ok])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c, runs in chunks(batches, CHUNK):
            _, lo, hi = runs_of(c, runs)
            yield from window_rows(c, spread(lo, hi))

    def settled(sent: DataFrame) -> DataFrame:
        return (sent.repartition(n, "g").sortWithinPartitions("g", "h", "doc", "tag", "at")
                .select("g", "h", "tag", "at").mapInArrow(settle, "tag long, at long, end long"))

    def stored(df: DataFrame) -> DataFrame:
        folder = scratch_path(spark, "suffix-buckets")
        df.write.option("compression", "zstd").parquet(folder)
        return spark.read.schema("tag long, at long, end long").parquet(folder)

    def again(left: DataFrame, step) -> DataFrame:
        runs = left.filter("end = 0").groupBy("tag").agg(F.collect_list("at").alias("runs"))
        return settled(rows.join(runs, "tag").select("doc", "tag", "text", "runs").mapInArrow(step, ROWS))

    first = stored(settled(rows.mapInArrow(sample, ROWS)))
    second = stored(again(first, halves))
    third = again(second, windows)
    return (first.unionByName(second).unionByName(third).filter("end > 0").groupBy("tag")
            .agg(F.collect_list(F.struct("at", "end")).alias("spans")))


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", spans: str = "removed",
                 kept: str = "kept", kept_text: str = "kept_text") -> DataFrame:
    """``docs`` plus ``spans`` (array<struct<at: long, end: long>>, maximal
    removed runs of bytes), ``kept`` (binary, the remaining bytes) and
    ``kept_text`` (string, the characters that lose no byte).

    The documents are stored once, bucketed by a row tag, so that the joins
    with the much smaller rows of repeats do not move the texts again."""
    spark = docs.sparkSession
    ship_package(spark)
    tag, name = tmp("tag"), "suffix_docs_" + tmp("t").strip("_")
    docs = docs.drop(spans, kept, kept_text)
    n = partitions(spark)
    (docs.withColumn(tag, F.monotonically_increasing_id()).repartition(n, tag)
     .write.bucketBy(n, tag).option("path", scratch_path(spark, name)).option("compression", "zstd")
     .saveAsTable(name))
    stored = spark.table(name)
    hits = tmp("hits")
    found = repeats(stored, tag, doc_id, text).select(F.col("tag").alias(tag), F.col("spans").alias(hits))

    @F.arrow_udf("struct<spans: array<struct<at: long, end: long>>, kept: binary, text: string>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct([("spans", pa.list_(pa.struct([("at", pa.int64()), ("end", pa.int64())]))),
                          ("kept", pa.binary()), ("text", pa.string())])
        for texts, found_spans in batches:
            out = []
            for t, s in zip(texts, found_spans, strict=True):
                raw = (t.as_py() or "").encode()
                if not s.is_valid:
                    out.append({"spans": [], "kept": raw, "text": t.as_py() or ""})
                    continue
                v = s.values
                lo, hi = merged(v.field(0).to_numpy(), v.field(1).to_numpy())
                edges = [0, *np.stack([lo, hi], 1).ravel().tolist(), len(raw)]
                parts = [raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]
                out.append({"spans": [{"at": a, "end": b} for a, b in zip(lo.tolist(), hi.tolist(), strict=True)],
                            "kept": b"".join(parts), "text": "".join(p.decode(errors="ignore") for p in parts)})
            yield pa.array(out, kind)

    made = tmp("made")
    joined = stored.join(found, tag, "left").withColumn(made, cut(F.col(text), F.col(hits)))
    return joined.select(*docs.columns, F.col(made)["spans"].alias(spans), F.col(made)["kept"].alias(kept),
                         F.col(made)["text"].alias(kept_text))
