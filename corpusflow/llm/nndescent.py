"""Approximate nearest neighbours by NN-descent and greedy graph search.

``build`` makes a graph in which every vector points to its ``K`` nearest
found. It starts from random projection orders (vectors that are neighbours in
a random order of hyperplane codes are compared in blocks of fixed size) and
improves by NN-descent: in every round each node is sent a few of its new and
old neighbours and of the nodes that point to it, with their vectors, compares
them with each other (neighbours of neighbours), and every pair that beats the
farthest entry of one end's list is sent there. Each step is a Spark join or
shuffle on node ids; a task holds one block or one node's few candidates.

``search`` walks the graph for all queries together: every query keeps a beam
of the best nodes seen, each round its best nodes not yet expanded are joined
with their adjacency (neighbour ids and vectors, stored once, bucketed by
node, in rows of at most ``PIECE`` bytes of vectors, so that neither a batch of
rows on its way to Python nor a read of the store is large), and the beam takes
the nearest; a neighbour that a full beam would not take is dropped where its
similarity is found. It ends when no beam has anything left to expand.

The effort follows the data: NN-descent goes on until a round renews at most
``DELTA`` of all list entries, and the beam is doubled until ``TRIED`` of the
queries find ``RECALL`` of their exact neighbours (one scan of all vectors for
those queries); all queries then walk with that beam.

Vectors travel as given (float32 or double), and everywhere - lists, beams,
final scores - they are normalised and compared in double precision, so near
copies keep their order. Vectors of exactly one direction (equal or scaled) are
one node, scored by the vector of its least id: a node keeps its ``top + 1``
least ids, which is all a result can need, so a vector that a third of all rows
share costs no more than another and ties resolve to the smaller id exactly.

Cases: null ids, null or empty vectors, zero vectors and vectors with a null or
non-finite component take no part, nor do vectors that have not the most
frequent length (the smallest of several); rows of equal id count once, with
the least vector; extra columns are ignored; with fewer candidates than
``top`` all are returned; an empty table gives no rows. The sizes below are
tuning, not caps on the data: every valid row is in the graph.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import materialise, partitions, ship_package, tmp

K = 32                # neighbours in a node's list
ORDERS, BLOCK = 16, 512
FROM_ORDER = 12       # best of a block that are sent to a node's list
DELTA = 0.01          # NN-descent ends when a round renews a smaller share of all entries
SAMPLE = 8            # new and old neighbours a node sends in a round, each
JOINED = 32           # candidates a node compares in a round
BEAM = 256            # first beam; doubled until RECALL is met
PIECE = 1 << 11       # bytes of vectors in a row of the adjacency (one vector at least)
STEP = 512            # rows of a batch that are worked on at a time
RECALL, TRIED = 0.95, 128     # wanted on so many queries, against the exact neighbours
ERROR = 1e-13         # more than a double cosine's rounding
SEED = 11


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x, dtype=np.int64))


def _packed(rows: list[np.ndarray]) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def unit(raw: bytes, kind: str, n: int) -> np.ndarray:
    """``n`` binary vectors of one length as unit rows of a double matrix."""
    x = np.frombuffer(raw, dtype=kind).reshape(n, -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _vectors(column: pa.Array, kind: str) -> np.ndarray:
    return unit(b"".join(column.to_pylist()), kind, len(column))


def best(ids: np.ndarray, sims: np.ndarray, k: int, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """The ``k`` most similar of distinct ids (ties to the smaller id; of equal
    ids the first row counts), in order."""
    _, first = np.unique(ids, return_index=True)
    order = first[np.lexsort((ids[first], -sims[first]))[:k]]
    return (ids[order], sims[order], *(m[order] for m in more))


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of equal first column, from batches sorted by it."""
    held: list[dict] = []
    for batch in batches:
        key = batch.schema.names[0]
        for row in batch.to_pylist():
            if held and held[0][key] != row[key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


@dataclass
class Index:
    rows: DataFrame       # id long, v array<double>: every valid row
    nodes: DataFrame      # node long, vec binary (kind), members array<long>, direction array<double>
    lists: DataFrame      # node long, ids binary (int64), sims binary (float64)
    kind: str             # "<f4" or "<f8": what holds the given vectors exactly


def nodes_of(df: DataFrame, vec_id: str, vector: str, top: int, kind: str) -> tuple[DataFrame, DataFrame]:
    """All valid rows, and one node per distinct direction."""
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    ok = (F.col("id").isNotNull() & (F.size("v") > 0)
          & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = rows.filter(ok).withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))
    rows = rows.filter((F.col("norm") > 0) & (F.col("norm") < float("inf")))
    rows = rows.groupBy("id").agg(F.min("v").alias("v"))
    # divided by the largest component, exactly proportional vectors are equal
    largest = F.array_max(F.transform("v", F.abs))
    rows = rows.withColumn("direction", F.transform("v", lambda x: x / largest + F.lit(0.0)))
    rows = materialise(rows, "nn-rows")
    size = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if size is None:
        size = (1,)
    rows = rows.filter(F.size("v") == size[0])
    # the least ids of each direction; a partial limit runs before the shuffle
    rank = F.row_number().over(Window.partitionBy("direction").orderBy("id"))
    few = rows.withColumn("rank", rank).filter(F.col("rank") <= top + 1)

    @F.arrow_udf("binary")
    def pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _packed([v.values.to_numpy().astype(kind) for v in batch])

    nodes = materialise(
        few.groupBy("direction").agg(F.sort_array(F.collect_list("id")).alias("members"), F.min_by("v", "id").alias("v"))
        .select(F.col("members")[0].alias("node"), pack(F.col("v")).alias("vec"), "members", "direction"), "nn-nodes")
    return rows, nodes


def first_lists(nodes: DataFrame, n: int, kind: str) -> DataFrame:
    """Lists from random projection orders."""
    bits = max(1, math.ceil(math.log2(max(2, n / BLOCK))))

    def orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _vectors(batch.column(1), kind)
            for order in range(ORDERS):
                p = x @ np.random.default_rng((SEED, order)).normal(size=(x.shape[1], bits + 1))
                code = (p[:, :bits] > 0) @ (1 << np.arange(bits))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), order, dtype=np.int32)), _long(code), pa.array(p[:, bits]),
                     batch.column(0), batch.column(1)], ["order", "code", "place", "node", "vec"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, ids, vecs = None, [], []

        def block():
            x = unit(b"".join(vecs), kind, len(ids))
            own = np.array(ids, dtype=np.int64)
            s = x @ x.T
            np.fill_diagonal(s, -9)
            k = min(FROM_ORDER, len(ids) - 1)
            if k:
                at = np.argpartition(-s, k - 1, axis=1)[:, :k]
                yield pa.RecordBatch.from_arrays(
                    [_long(own), _packed(list(own[at])), _packed(list(np.take_along_axis(s, at, 1)))],
                    ["node", "ids", "sims"])

        for batch in batches:
            for o, i, v in zip(*(batch.column(c).to_pylist() for c in (0, 1, 2)), strict=True):
                if ids and (o != order or len(ids) == BLOCK):
                    yield from block()
                    ids, vecs = [], []
                order = o
                ids.append(i)
                vecs.append(v)
        if ids:
            yield from block()

    width = partitions(nodes.sparkSession)
    placed = nodes.select("node", "vec").mapInArrow(
        orders, "order int, code long, place double, node long, vec binary")
    found = (placed.repartitionByRange(width, "order", "code", "place", "node")
             .sortWithinPartitions("order", "code", "place", "node").select("order", "node", "vec")
             .mapInArrow(compare, "node long, ids binary, sims binary"))
    return merge(None, found, width)


def merge(lists: DataFrame | None, found: DataFrame, width: int) -> DataFrame:
    """Lists with the found pairs (node, ids, sims) merged in; ``fresh`` marks
    entries that were not in the list before, ``worst`` is the similarity a
    new entry must beat, ``added`` the number of entries that are new."""
    def join_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []

        def flush():
            node, ids, sims, fresh, worst, added = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays(
                [_long(np.array(node)), _packed(list(ids)), _packed(list(sims)), _packed(list(fresh)),
                 pa.array(np.array(worst, dtype=np.float64)), pa.array(np.array(added, dtype=np.int32))],
                ["node", "ids", "sims", "fresh", "worst", "added"])

        for rows in groups(batches):
            # the old list first: of equal ids it keeps its flag
            rows.sort(key=lambda r: r["fresh"] is None)
            ids = np.frombuffer(b"".join(r["ids"] for r in rows), dtype="<i8")
            sims = np.frombuffer(b"".join(r["sims"] for r in rows), dtype="<f8")
            old = rows[0]["fresh"] or b""
            fresh = np.ones(len(ids), dtype=np.uint8)
            fresh[:len(old)] = np.frombuffer(old, dtype=np.uint8)
            ids, sims, fresh, new = best(ids, sims, K, fresh, np.arange(len(ids)) >= len(old))
            out.append((rows[0]["node"], ids, sims, fresh, sims[-1] if len(ids) == K else -9.0, int(new.sum())))
            if len(out) == 2000:
                yield flush()
                out.clear()
        if out:
            yield flush()

    rows = found.select("node", "ids", "sims", F.lit(None).cast("binary").alias("fresh"))
    if lists is not None:
        rows = rows.unionByName(lists.select("node", "ids", "sims", "fresh"))
    return (rows.repartition(width, "node").sortWithinPartitions("node")
            .mapInArrow(join_lists, "node long, ids binary, sims binary, fresh binary, worst double, added int"))


def descend(nodes: DataFrame, lists: DataFrame, turn: int, kind: str) -> DataFrame:
    """One round of NN-descent over the lists (node, ids, sims, fresh, worst)."""
    width = partitions(nodes.sparkSession)

    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Candidates a node compares: (node, member, fresh), both ways of a
        sampled edge, and the lists with the sent entries no longer fresh."""
        for batch in batches:
            at, member, flags = [], [], []
            for node, ids, fresh in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                ids, fresh = np.frombuffer(ids, "<i8"), np.frombuffer(fresh, np.uint8)
                for f in (0, 1):
                    for u in chosen(ids, fresh, f, node, turn):
                        at += (node, u)
                        member += (u, node)
                        flags += (f, f)
            yield pa.RecordBatch.from_arrays([_long(np.array(at)), _long(np.array(member)),
                                              pa.array(np.array(flags, dtype=np.int32))], ["node", "member", "fresh"])

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                ids, fresh = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["fresh"], np.uint8).copy()
                fresh[np.isin(ids, chosen(ids, fresh, 1, r["node"], turn))] = 0
                r["fresh"] = fresh.tobytes()
            yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches):
            seen: dict[int, dict] = {}
            for r in rows:
                old = seen.setdefault(r["member"], r)
                old["fresh"] = max(old["fresh"], r["fresh"])
            some = sorted(seen.values(), key=lambda r: (-r["fresh"], mixed(r["member"], turn)))[:JOINED]
            new = sum(r["fresh"] for r in some)
            if not new or len(some) < 2:
                continue
            ids = np.array([r["member"] for r in some], dtype=np.int64)
            worst = np.array([r["worst"] for r in some])
            x = unit(b"".join(r["vec"] for r in some), kind, len(some))
            s = x[:new] @ x.T
            a, b = np.nonzero(np.triu(np.ones_like(s, dtype=bool), 1))
            v = s[a, b]
            pairs = [(ids[a[k]], ids[b[k]], v[k]) for k in np.nonzero(v > worst[a])[0]]
            pairs += [(ids[b[k]], ids[a[k]], v[k]) for k in np.nonzero(v > worst[b])[0]]
            if pairs:
                p, q, v = zip(*pairs, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [_long(np.array(p)), _packed(list(np.array(q, dtype="<i8"))),
                     _packed(list(np.array(v, dtype="<f8")))], ["node", "ids", "sims"])

    vecs = nodes.select(F.col("node").alias("member"), "vec").join(
        lists.select(F.col("node").alias("member"), "worst"), "member")
    offers = lists.select("node", "ids", "fresh").mapInArrow(offer, "node long, member long, fresh int")
    found = (offers.join(vecs, "member").repartition(width, "node").sortWithinPartitions("node")
             .select("node", "member", "fresh", "vec", "worst")
             .mapInArrow(compare, "node long, ids binary, sims binary"))
    kept = lists.mapInArrow(sent, lists.schema)
    return merge(kept, found, width)


def mixed(x: int, turn: int) -> int:
    """A fixed pseudo-random number of a node in a round."""
    return ((x + 1) * 0x9E3779B97F4A7C15 + turn * 0xC2B2AE3D27D4EB4F >> 7) & 0xFFFFFFFF


def chosen(ids: np.ndarray, fresh: np.ndarray, flag: int, node: int, turn: int) -> list[int]:
    """The sampled entries of a list with this flag, the same on every call."""
    some = ids[fresh == flag].tolist()
    return sorted(some, key=lambda u: mixed(u ^ node, turn))[:SAMPLE]


def build(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", top: int = 5) -> Index:
    spark = df.sparkSession
    ship_package(spark)
    # vectors travel in the given precision and are compared in double
    exact = df.schema[vector].dataType.elementType.typeName() in ("float", "byte", "short")
    kind = "<f4" if exact else "<f8"
    rows, nodes = nodes_of(df, vec_id, vector, top, kind)
    n = nodes.count()
    lists = materialise(first_lists(nodes, n, kind), "nn-lists")
    # every round that renews an entry raises a list's similarities, so this ends
    for turn in itertools.count():
        lists = materialise(descend(nodes, lists, turn, kind), "nn-lists")
        added = lists.agg(F.sum("added")).first()[0] or 0
        if added <= DELTA * n * min(K, n - 1):
            return Index(rows, nodes, lists, kind)


def adjacency(index: Index) -> DataFrame:
    """``(node, ids, vecs)``: every list with the neighbours' vectors, stored
    bucketed by node; a list is several rows of at most ``PIECE`` bytes of
    vectors."""
    spark = index.nodes.sparkSession
    width = partitions(spark)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.frombuffer(x, "<i8") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [_long(np.repeat(batch.column(0).to_numpy(), [len(x) for x in lists])),
                 _long(np.concatenate(lists) if lists else np.empty(0))], ["node", "other"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches):
            step = max(1, PIECE // len(rows[0]["vec"]))
            pieces = [rows[at:at + step] for at in range(0, len(rows), step)]
            yield pa.RecordBatch.from_arrays(
                [_long(np.full(len(pieces), rows[0]["node"])),
                 _packed([np.array([r["other"] for r in piece], dtype="<i8") for piece in pieces]),
                 pa.array([b"".join(r["vec"] for r in piece) for piece in pieces], pa.binary())],
                ["node", "ids", "vecs"])

    pairs = index.lists.select("node", "ids").mapInArrow(edges, "node long, other long")
    joined = pairs.join(index.nodes.select(F.col("node").alias("other"), "vec"), "other")
    name = "nn_adjacency_" + tmp("t").strip("_")
    # dealt by node as the buckets are: a task writes one bucket
    (joined.select("node", "other", "vec").repartition(width, "node").sortWithinPartitions("node")
     .mapInArrow(gather, "node long, ids binary, vecs binary")
     .write.bucketBy(width, "node").option("path", scratch_path(spark, name)).saveAsTable(name))
    return spark.table(name)


STATE = "node long, vec binary, ids binary, sims binary, done binary"


def nearest(nodes: DataFrame, some: DataFrame, k: int, kind: str) -> dict[int, set[int]]:
    """The exact ``k`` nearest nodes of each of a few nodes (node, vec)."""
    asked = some.select("node", "vec").collect()
    if not asked:
        return {}
    own = np.array([r["node"] for r in asked], dtype=np.int64)
    q = unit(b"".join(r["vec"] for r in asked), kind, len(asked))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            s = _vectors(batch.column(1), kind) @ q.T
            s[ids[:, None] == own[None, :]] = -9
            at = np.argpartition(-s, min(k, len(ids)) - 1, axis=0)[:k]
            yield pa.RecordBatch.from_arrays(
                [_long(np.broadcast_to(own, at.shape).ravel()), _long(ids[at].ravel()),
                 pa.array(np.take_along_axis(s, at, 0).ravel())], ["node", "other", "sim"])

    order = Window.partitionBy("node").orderBy(F.desc("sim"), "other")
    got = (nodes.select("node", "vec").mapInArrow(scan, "node long, other long, sim double").filter("sim > -9")
           .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).collect())
    out: dict[int, set[int]] = {}
    for r in got:
        out.setdefault(r["node"], set()).add(r["other"])
    return out


def walk(index: Index, near: DataFrame, start: DataFrame, beam: int) -> DataFrame:
    """The final beams (STATE) of the nodes in ``start`` (node, vec)."""
    width = partitions(near.sparkSession)
    kind = index.kind
    expanded = max(1, beam // 4)      # of each beam in a round

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            ids = [np.frombuffer(r["ids"] or b"", "<i8") for r in rows]
            sims = [np.frombuffer(r["sims"] or b"", "<f8") for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _packed(ids), _packed(sims),
                 _packed([np.zeros(len(i), np.uint8) for i in ids])], ["node", "vec", "ids", "sims", "done"])

    def frontier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The open nodes of each beam, with the similarity a neighbour needs
        to enter it."""
        for batch in batches:
            for row in range(batch.num_rows):
                r = batch.slice(row, 1).to_pylist()[0]
                open_ = np.frombuffer(r["ids"], "<i8")[np.frombuffer(r["done"], np.uint8) == 0][:expanded]
                sims = np.frombuffer(r["sims"], "<f8")
                worst = sims[-1] if len(sims) >= beam else -9.0
                yield pa.RecordBatch.from_arrays(
                    [_long(open_), _long(np.full(len(open_), r["node"])),
                     pa.array([r["vec"]] * len(open_), pa.binary()), pa.array(np.full(len(open_), worst))],
                    ["node", "query", "qvec", "worst"])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                query, ids, vecs = (part.column(c).to_pylist() for c in range(3))
                sizes = np.array([len(i) // 8 for i in ids])
                q = np.repeat(_vectors(part.column(3), kind), sizes, axis=0)
                sims = np.einsum("ij,ij->i", unit(b"".join(vecs), kind, len(q)), q)
                near_enough = sims >= np.repeat(part.column(4).to_numpy() - ERROR, sizes)
                ends = np.cumsum(sizes)
                who, out_ids, out_sims = [], [], []
                for node, own, start, end in zip(query, ids, ends - sizes, ends, strict=True):
                    keep = near_enough[start:end]
                    if keep.any():
                        who.append(node)
                        out_ids.append(np.frombuffer(own, "<i8")[keep])
                        out_sims.append(sims[start:end][keep])
                yield pa.RecordBatch.from_arrays([_long(np.array(who)), _packed(out_ids), _packed(out_sims)],
                                                 ["node", "ids", "sims"])

    def absorb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches):
            state = next((r for r in rows if r["vec"] is not None), None)
            if state is None:
                continue
            rest = [r for r in rows if r["vec"] is None]
            own, done = np.frombuffer(state["ids"], "<i8"), np.frombuffer(state["done"], np.uint8).copy()
            done[np.nonzero(done == 0)[0][:expanded]] = 1          # the frontier just expanded
            ids = np.concatenate([own, *(np.frombuffer(r["ids"], "<i8") for r in rest)])
            sims = np.concatenate([np.frombuffer(state["sims"], "<f8"),
                                   *(np.frombuffer(r["sims"], "<f8") for r in rest)])
            flags = np.concatenate([done, np.zeros(len(ids) - len(own), np.uint8)])
            other = ids != state["node"]
            ids, sims, flags = best(ids[other], sims[other], beam, flags[other])
            yield pa.RecordBatch.from_arrays(
                [_long(np.array([state["node"]])), pa.array([state["vec"]], pa.binary()), _packed([ids]),
                 _packed([sims]), _packed([flags])], ["node", "vec", "ids", "sims", "done"])

    state = start.join(index.lists.select("node", "ids", "sims"), "node", "left").select("node", "vec", "ids", "sims")
    state = materialise(state.mapInArrow(begin, STATE), "nn-beams")
    # a node that has left a beam cannot come back, so this ends
    while not state.filter(F.contains("done", F.lit(b"\0"))).isEmpty():
        ahead = state.mapInArrow(frontier, "node long, query long, qvec binary, worst double")
        found = (ahead.join(near, "node").select(F.col("query").alias("node"), "ids", "vecs", "qvec", "worst")
                 .mapInArrow(expand, "node long, ids binary, sims binary"))
        none = F.lit(None).cast("binary")
        rows = state.unionByName(found.select("node", none.alias("vec"), "ids", "sims", none.alias("done")))
        state = materialise(rows.repartition(width, "node").sortWithinPartitions("node").mapInArrow(absorb, STATE),
                            "nn-beams")
    return state


def search(index: Index, queries: DataFrame, top: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the indexed ids in the one
    column of ``queries``: the ``top`` nearest found, the query left out."""
    spark = queries.sparkSession
    near = adjacency(index)
    asked = queries.select(F.col(queries.columns[0]).cast("long").alias("query_id")).distinct()
    # queries of one direction walk once; a node lists only its least ids, so a
    # query's node is found by its direction
    known = materialise(asked.join(index.rows.withColumnRenamed("id", "query_id"), "query_id")
                        .join(index.nodes.select("direction", "node"), "direction").select("query_id", "node"),
                        "nn-queries")
    start = materialise(known.select("node").distinct().join(index.nodes.select("node", "vec"), "node"), "nn-start")
    # the beam that a sample of the queries needs, by their exact neighbours
    tried = materialise(start.orderBy(F.xxhash64("node")).limit(TRIED), "nn-tried")
    want, n, beam = nearest(index.nodes, tried, top, index.kind), index.nodes.count(), BEAM
    while True:
        state = walk(index, near, tried, beam)
        hits = sum(len(want.get(r["node"], set()) & set(np.frombuffer(r["ids"], "<i8")[:4 * top].tolist()))
                   for r in state.select("node", "ids").collect())
        if hits >= RECALL * sum(map(len, want.values())) or beam >= n:
            break
        beam *= 2
    if start.count() > TRIED:
        state = walk(index, near, start, beam)

    def shortlist(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The beam down to the error of a cosine below the top-th, and the node itself."""
        for batch in batches:
            at, who = [], []
            for r in batch.to_pylist():
                ids, sims = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["sims"], "<f8")
                few = [r["node"], *ids[sims >= (sims[top - 1] if len(sims) >= top else -9) - ERROR].tolist()]
                at += few
                who += [r["node"]] * len(few)
            yield pa.RecordBatch.from_arrays([_long(np.array(at)), _long(np.array(who))], ["other", "node"])

    short = state.mapInArrow(shortlist, "other long, node long")
    full = (short.join(index.nodes.select(F.col("node").alias("other"), "members", F.col("vec").alias("other_vec")),
                       "other")
            .join(index.nodes.select("node", "vec"), "node").join(known, "node"))
    kind = index.kind

    @F.arrow_udf("double")
    def cosine(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in batches:
            out = []
            for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True):
                x, y = np.frombuffer(x, kind).astype(float), np.frombuffer(y, kind).astype(float)
                out.append(float(x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y))))
            yield pa.array(out, pa.float64())

    scored = full.select("query_id", F.explode("members").alias("vec_id"),
                         cosine(F.col("vec"), F.col("other_vec")).alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (scored.filter(F.col("vec_id") != F.col("query_id")).withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= top).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
