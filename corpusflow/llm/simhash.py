"""SimHash near-duplicates by a binary trie self-join.

``fingerprints``: 64-bit SimHash over word shingles (XXH64, seed 42), computed
in Arrow batches. ``links``: pairs of different fingerprints at most
``budget`` bits apart. The fingerprints, taken once each, are the leaves of a
binary trie that is joined with itself: node pairs are traversed together from
the root, each step adds the bits in which the two branches differ, and a pair
is dropped as soon as its differing bits exceed the error budget.

The traversal is distributed by its first ``TOP_BITS`` levels: Spark sends
each fingerprint to the node pairs below which it can have a partner, and each
task traverses the subtree pairs it got. Two tries are joined, of the
fingerprints and of their halves swapped: two fingerprints within the budget
have at most half of it in one of the two halves, so each trie allows
``budget // 2`` errors in its first 32 levels and ``budget`` in all, which
prunes most node pairs of the dense upper levels. A fingerprint can only have
as many partners as there are words of 64 bits within the budget, so copies
and near copies of one text never form all pairs.

``components``: the least label reachable over links, by passing least labels
over links and label pointers until nothing changes; each round is written to
the shared scratch folder.

Cases: null or wordless text has fingerprint zero and is linked like any
other; fewer words than a shingle: the whole sequence is the one shingle; null
doc_id rows keep a row each and count after every other id (a component of
nulls only has a null id); repeated rows share their component; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, partitions, release, ship_package, tmp

TOP_BITS = 12
SEED = 42
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)
#: Hashes whose bits are counted at once.
_CHUNK = 1 << 14


def fingerprint(text: str | None, words: int = 3) -> int:
    """64-bit SimHash of one text."""
    import xxhash
    w = (text or "").encode().lower().split()     # bytes.lower() touches A-Z only
    if not w:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(w) <= words:
        shingles = [b" ".join(w)]
    else:
        shingles = map(b" ".join, zip(*(w[i:] for i in range(words))))
    h = np.fromiter((digest(s, SEED) for s in shingles), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), _CHUNK):
        part = h[i:i + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(_BITS[2 * ones > len(h)].sum())


def fingerprints(df: DataFrame, text: str = "text", out: str = "fp", words: int = 3) -> DataFrame:
    """``df`` with ``out`` (long): the fingerprint's bits as a signed number."""
    ship_package(df.sparkSession)

    @F.arrow_udf("long")
    def fp(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            got = np.array([fingerprint(t.as_py(), words) for t in batch], dtype=np.uint64)
            yield pa.array(got.view(np.int64))
            release()

    return df.withColumn(out, fp(F.col(text)))


def masks(bits: int, errors: int) -> list[int]:
    """All words of ``bits`` bits with at most ``errors`` ones."""
    out, layer = [0], [(0, 0)]
    for _ in range(errors):
        layer = [(m | 1 << i, i + 1) for m, at in layer for i in range(at, bits)]
        out += [m for m, _ in layer]
    return out


def traverse(a: np.ndarray, b: np.ndarray | None, depth: int, budget: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaf pairs of two subtries (sorted uint64 arrays that share their first
    ``depth`` bits each; ``b`` None: the subtrie with itself) within the error
    budget: ``half`` errors in the first 32 levels, ``budget`` in all.

    A node is a range of the sorted leaves; all node pairs of a level are held
    as arrays and split by the level's bit together."""
    own = b is None
    b = a if own else b
    pairs = np.array([[0, len(a), 0, len(b)]], dtype=np.int64)
    errs = np.array([int(a[0] >> np.uint64(64 - depth) ^ b[0] >> np.uint64(64 - depth)).bit_count()])
    found = []

    def split(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, level: int) -> np.ndarray:
        """First leaf of each node [lo, hi) whose bit at ``level`` is set."""
        shift = np.uint64(63 - level)
        want = (x[lo] >> shift | np.uint64(1)) << shift
        at = np.searchsorted(x, want)
        return np.minimum(np.maximum(at, lo), hi)

    for level in range(depth, 64):
        small = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2]) <= 16
        if small.any():       # few leaves left: compare them
            found.append(pairs[small])
            pairs, errs = pairs[~small], errs[~small]
        if not len(pairs):
            break
        most = half if level < 32 else budget
        a0, a1, b0, b1 = pairs.T
        am, bm = split(a, a0, a1, level), split(b, b0, b1, level)
        kids = np.concatenate([np.stack([a0, am, b0, bm], 1), np.stack([am, a1, bm, b1], 1),
                               np.stack([a0, am, bm, b1], 1), np.stack([am, a1, b0, bm], 1)])
        more = np.concatenate([errs, errs, errs + 1, errs + 1])
        keep = (kids[:, 1] > kids[:, 0]) & (kids[:, 3] > kids[:, 2]) & (more <= most)
        if own:               # a node pair and its mirror image are one
            keep &= kids[:, 0] <= kids[:, 2]
        pairs, errs = kids[keep], more[keep]
    if len(pairs):
        found.append(pairs)
    if not found:
        return a[:0], a[:0]
    a0, a1, b0, b1 = np.concatenate(found).T
    left, right = [], []
    na, nb = a1 - a0, b1 - b0
    total = na * nb
    at = np.cumsum(total) - total
    owner = np.repeat(np.arange(len(total)), total)
    k = np.arange(int(total.sum())) - at[owner]
    i, j = a0[owner] + k // nb[owner], b0[owner] + k % nb[owner]
    if own:
        up = i < j
        i, j = i[up], j[up]
    left, right = a[i], b[j]
    x = left ^ right
    near = np.bitwise_count(x) <= budget
    near &= np.bitwise_count(x >> np.uint64(32)) <= half
    return left[near], right[near]


def links(fps: DataFrame, fp: str = "fp", budget: int = 2, top_bits: int = TOP_BITS) -> DataFrame:
    """Pairs ``(a, b)``, a < b as unsigned numbers, of different fingerprints
    at most ``budget`` bits apart; each pair once."""
    spark = fps.sparkSession
    ship_package(spark)
    half = budget // 2
    distinct = fps.select(F.col(fp).alias("fp")).distinct()
    tries = distinct.select(F.explode(F.array(
        F.struct(F.lit(0).alias("trie"), F.col("fp").alias("bits")),
        F.struct(F.lit(1).alias("trie"), F.shiftleft("fp", 32).bitwiseOR(F.shiftrightunsigned("fp", 32)).alias("bits"))
    )).alias("t")).select("t.trie", "t.bits")
    top = F.shiftrightunsigned("bits", 64 - top_bits).cast("int")
    reach = masks(top_bits, half)
    # node pairs (p, q), p <= q: each leaf goes to every pair its own node is in
    sent = tries.select("trie", "bits", top.alias("node"), F.explode(F.array(*[F.lit(m) for m in reach])).alias("m"))
    sent = sent.select("trie", "bits", F.least("node", F.col("node").bitwiseXOR(F.col("m"))).alias("p"),
                       F.greatest("node", F.col("node").bitwiseXOR(F.col("m"))).alias("q"))

    def join_tries(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = None, []

        def done():
            bits = np.sort(np.concatenate(parts).view(np.uint64))
            trie, p, q = held
            if p == q:
                x, y = traverse(bits, None, top_bits, budget, half) if len(bits) > 1 else (bits[:0], bits[:0])
            else:
                cut = np.searchsorted(bits, np.uint64(q) << np.uint64(64 - top_bits))
                x, y = traverse(bits[:cut], bits[cut:], top_bits, budget, half) \
                    if 0 < cut < len(bits) else (bits[:0], bits[:0])
            if trie:
                x, y = (v << np.uint64(32) | v >> np.uint64(32) for v in (x, y))
                # found in the first trie already if its first half is within half the budget
                new = np.bitwise_count((x ^ y) >> np.uint64(32)) > half
                x, y = x[new], y[new]
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y).view(np.int64)),
                                                  pa.array(np.maximum(x, y).view(np.int64))], ["a", "b"])

        for batch in rows:
            if not batch.num_rows:
                continue
            trie, p, q, bits = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            change = np.nonzero((np.diff(trie) != 0) | (np.diff(p) != 0) | (np.diff(q) != 0))[0] + 1
            for lo, hi in zip([0, *change], [*change, len(bits)], strict=True):
                key = (int(trie[lo]), int(p[lo]), int(q[lo]))
                if key != held:
                    if parts:
                        yield from done()
                    held, parts = key, []
                parts.append(bits[lo:hi].astype(np.int64))
        if parts:
            yield from done()
        release()

    grouped = (sent.repartition(partitions(spark), "trie", "p", "q").sortWithinPartitions("trie", "p", "q")
               .select("trie", "p", "q", "bits"))
    return grouped.mapInArrow(join_tries, "a long, b long")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Least label of every node's component. ``nodes``: (node, label), one
    row each, labels of any ordered type; ``edges``: (a, b). Returns (node,
    label) of the nodes that have an edge. Null labels count after all others.

    Each round a node takes the least of its neighbours' labels and its own,
    and then the label of the node its label came from (pointer jumping), so
    the rounds grow with the logarithm of the longest chain."""
    both = materialise(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "cc-edges")
    linked = both.select(F.col("a").alias("node")).distinct()
    # order of labels as a struct: (is null, label, node); the node is the root it points to
    state = materialise(nodes.join(linked, "node").select(
        "node", F.struct(F.col("label").isNull().alias("none"), "label", F.col("node").alias("root")).alias("best")),
        "cc-state")
    while True:
        near = (both.join(state.select(F.col("node").alias("b"), "best"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("best").alias("near")))
        stepped = state.join(near, "node").select("node", F.col("best").alias("old"),
                                                  F.least("best", "near").alias("best"))
        stepped = materialise(stepped, "cc-step")
        jump = stepped.select(F.col("node").alias("root"), F.col("best").alias("far"))
        new = materialise(stepped.withColumn("root", F.col("best.root")).join(jump, "root", "left")
                          .select("node", "old", F.least("best", F.coalesce("far", "best")).alias("best")), "cc-state")
        changed = new.filter(F.col("old") != F.col("best")).limit(1).count()
        state = new.select("node", "best")
        if not changed:
            return state.select("node", F.col("best.label").alias("label"))


def representatives(base: DataFrame) -> DataFrame:
    """``(fp, best)`` for every fingerprint of ``base`` (tag, doc_id, fp):
    ``best`` is the struct (none, doc_id, tag) of the row that stands for the
    component - least doc_id, nulls last, then least tag."""
    nodes = materialise(base.groupBy(F.col("fp").alias("node")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")).alias("label")), "simhash-nodes")
    comp = components(nodes, links(nodes.select(F.col("node").alias("fp"))))
    # written, so that a join with it shuffles both sides and a fingerprint of
    # very many rows can be split by the adaptive skew join
    return materialise(nodes.join(comp.withColumnRenamed("label", "best"), "node", "left").select(
        F.col("node").alias("fp"), F.coalesce("best", "label").alias("best")), "simhash-best")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id`` - the least doc_id
    reachable over fingerprints at most two bits apart, itself included."""
    base = materialise(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
                                    words=words)
                       .select("doc_id", "fp", F.monotonically_increasing_id().alias("tag")), "simhash")
    return base.join(representatives(base), "fp").select(
        "doc_id", "fp", F.col("best.doc_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """``docs`` with one row of each component (see ``representatives``)."""
    fp, tag = tmp("fp"), tmp("tag")
    wide = materialise(fingerprints(docs, text, fp, words).withColumn(tag, F.monotonically_increasing_id()),
                       "simhash-docs")
    best = representatives(wide.select(F.col(tag).alias("tag"), F.col(doc_id).alias("doc_id"), F.col(fp).alias("fp")))
    stay = best.select(F.col("best.tag").alias(tag)).distinct()
    return wide.join(stay, tag, "left_semi").select(*docs.columns)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
