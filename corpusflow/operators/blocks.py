"""Exact nearest rows over an index of blocks with distance bounds.

The corpus is dealt into blocks of similar vectors: every row goes to its
nearest pivot (pivots are chosen far apart from a bounded sample), rows are
range-partitioned by (pivot, distance, id) and cut into blocks of at most
``BLOCK_ROWS``. A block is one row of a Parquet table. It is kept in one of two
forms:

``lists``   an inverted index of the block: for every dimension the places and
            weights of its non-zero entries, with the largest and the least
            weight as bounds. A block is skipped for a question if the box of
            the bounds is farther away than its k-th best distance; inside a
            block the lists are read in the order of what they can add, and
            questions and rows that can no longer meet are left out of the rest.
``pivots``  vectors in the order of their distance to the block's pivot, with
            the least and greatest distance of the block's rows to every pivot.
            By the triangle inequality a block, and the rows of a block outside
            a ring around the pivot, are skipped without a comparison.

A search takes questions in blocks of bounded size. First the bounds alone are
read and each question gets the blocks with the nearest centres; the k-th best
distance found there is where it starts. Then every block is looked at by the
questions that can still find something in it. All bounds carry a margin for
rounding, and what passes is measured exactly, so the result is that of
comparing everything; the work that was done is returned beside it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path, ship_package, shuffle_partitions
from .knowledge import MATRIX_BUDGET, MAX_BROADCAST_BYTES, _keep_best, question_batches

BLOCK_ROWS = 512
#: Pivots, and the rows they are chosen from (in the order of a hash of the id).
PIVOTS, PIVOT_SAMPLE = 32, 2000
#: Blocks a question measures first.
FIRST_BLOCKS = 2
#: Shares of the lists after which the bounds are looked at again.
STEPS = (0.125, 0.25, 0.5, 1.0)
MARGIN = 1e-6


@dataclass
class Index:
    """Stored blocks of a corpus of ``dim`` wide vectors."""
    path: str
    form: str
    pivots: np.ndarray
    id_type: T.DataType

    @property
    def dim(self) -> int:
        return self.pivots.shape[1]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def chosen_pivots(corpus: DataFrame, c_id: str, c_vec: str) -> np.ndarray:
    """Vectors far from each other: from a bounded sample, each the farthest
    from those before it; equal ones once."""
    rows = corpus.select(c_id, c_vec).orderBy(F.xxhash64(c_id), c_id).limit(PIVOT_SAMPLE).select(c_vec).collect()
    x = np.asarray([r[0] for r in rows], dtype=np.float64)
    if not len(x):
        return np.zeros((0, 0))
    out = [x[0]]
    near = np.linalg.norm(x - x[0], axis=1)
    while len(out) < PIVOTS and near.max() > 0:
        out.append(x[int(near.argmax())])
        near = np.minimum(near, np.linalg.norm(x - out[-1], axis=1))
    return np.asarray(out)


def _dense(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    sq = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2.0 * (x @ y.T)
    return np.sqrt(np.maximum(sq, 0.0))


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0, *map(len, values)], dtype=np.int32)
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def _arrow_kind(kind: T.DataType) -> pa.DataType:
    return {"string": pa.string(), "int": pa.int32()}.get(kind.simpleString(), pa.int64())


class Packer:
    """Rows ``(pivot, at, id, vector)`` in order -> block rows."""

    def __init__(self, form: str, pivots: np.ndarray, id_kind: pa.DataType):
        self.form, self.pivots, self.id_kind = form, pivots, id_kind

    def block(self, pivot: int, at: np.ndarray, ids: pa.Array, x: np.ndarray) -> dict:
        out = {"pivot": pa.array([pivot], pa.int32()), "norm": pa.array([float(np.sqrt((x * x).sum(axis=1).max()))]),
               "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
               "centre": _lists([x.mean(axis=0)], pa.float64())}
        if self.form == "lists":
            row, dim = np.nonzero(x)
            order = np.argsort(dim, kind="stable")
            starts = np.searchsorted(dim[order], np.arange(x.shape[1] + 1))
            return out | {"tops": _lists([x.max(axis=0)], pa.float64()), "lows": _lists([x.min(axis=0)], pa.float64()),
                          "starts": _lists([starts], pa.int32()), "places": _lists([row[order]], pa.int32()),
                          "weights": _lists([x[row, dim][order]], pa.float64())}
        to = _distances(x, self.pivots)
        return out | {"lows": _lists([to.min(axis=0)], pa.float64()), "tops": _lists([to.max(axis=0)], pa.float64()),
                      "at": _lists([at], pa.float64()), "vectors": _lists([x.ravel()], pa.float64())}

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for rb in batches:
            if not rb.num_rows:
                continue
            now = (rb.column(0).to_numpy(), rb.column(1).to_numpy(), rb.column(2).cast(self.id_kind),
                   _dense(rb.column(3), self.pivots.shape[1]))
            if held is not None:
                now = (np.append(held[0], now[0]), np.append(held[1], now[1]), pa.concat_arrays([held[2], now[2]]),
                       np.concatenate([held[3], now[3]]))
            cuts = [0]
            for end in [*(np.flatnonzero(np.diff(now[0])) + 1), len(now[0])]:
                while end - cuts[-1] > BLOCK_ROWS:
                    cuts.append(cuts[-1] + BLOCK_ROWS)
                cuts.append(int(end))
            for a, b in zip(cuts[:-2], cuts[1:-1], strict=True):
                yield self.row(*[c[a:b] for c in now])
            held = tuple(c[cuts[-2]:] for c in now)
        if held is not None:
            yield self.row(*held)

    def row(self, pivot, at, ids, x) -> pa.RecordBatch:
        columns = self.block(int(pivot[0]), at, ids, x)
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def build(corpus: DataFrame, form: str, c_id: str = "c_id", c_vec: str = "vector") -> Index:
    """Store the blocks of ``corpus`` under the shared scratch folder."""
    spark = corpus.sparkSession
    ship_package(spark)
    kind = corpus.schema[c_id].dataType
    pivots = chosen_pivots(corpus, c_id, c_vec)
    path = scratch_path(spark, f"blocks-{form}")
    id_sql = kind.simpleString()
    arrays = {"lists": "tops array<double>, lows array<double>, starts array<int>, places array<int>, weights array<double>",
              "pivots": "lows array<double>, tops array<double>, at array<double>, vectors array<double>"}[form]
    schema = f"pivot int, norm double, ids array<{id_sql}>, centre array<double>, {arrays}"

    @F.arrow_udf("struct<pivot: int, at: double>")
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x = _dense(batch, pivots.shape[1])
            to = [_distances(x[i:i + 4096], pivots) for i in range(0, len(x), 4096)]
            to = np.concatenate(to) if to else np.zeros((0, 1))
            best = to.argmin(axis=1)
            yield pa.StructArray.from_arrays([pa.array(best.astype(np.int32)), pa.array(to[np.arange(len(to)), best])],
                                             ["pivot", "at"])
    if len(pivots):
        rows = corpus.select(F.col(c_id).alias("id"), F.col(c_vec).alias("vector")).filter("vector is not null").withColumn("p", nearest("vector"))
        order = ["pivot", "at", "id"]
        packer = Packer(form, pivots, _arrow_kind(kind))
        blocks = (rows.select("p.pivot", "p.at", "id", "vector").repartitionByRange(shuffle_partitions(spark), *order)
                  .sortWithinPartitions(*order).mapInArrow(packer.run, schema))
        blocks.withColumn("block", F.monotonically_increasing_id()).write.parquet(path)
    else:
        spark.createDataFrame([], schema + ", block long").write.parquet(path)
    return Index(path, form, pivots, kind)


class Asked:
    """A block of questions with what the bounds need."""

    def __init__(self, index: Index, ids: list, vectors: np.ndarray, k: int):
        self.ids, self.q, self.k, self.form, self.id_kind = ids, vectors, k, index.form, _arrow_kind(index.id_type)
        self.norm = float(np.sqrt((vectors * vectors).sum(axis=1).max(initial=0.0)))
        self.to = _distances(vectors, index.pivots) if index.form == "pivots" and len(index.pivots) else None
        self.limit = np.full(len(ids), np.inf)

    def bound(self, lows: np.ndarray, tops: np.ndarray) -> np.ndarray:
        """Least possible distance of every question to a block's rows."""
        if self.form == "pivots":
            return np.maximum(np.maximum(self.to - tops, lows - self.to).max(axis=1), 0.0)
        out = np.empty(len(self.q))
        step = max(1, MATRIX_BUDGET // len(lows))
        for i in range(0, len(out), step):
            q = self.q[i:i + step]
            out[i:i + step] = np.sqrt((np.maximum(np.maximum(lows - q, q - tops), 0.0) ** 2).sum(axis=1))
        return out

    def margin(self, block: dict) -> float:
        """Rounding of the bounds, by the size of the numbers."""
        return MARGIN * (1.0 + self.norm + block["norm"])

    def measured(self, who: np.ndarray, rows: np.ndarray, x: np.ndarray):
        diff = x - self.q[who]
        return np.sqrt(np.einsum("ij,ij->i", diff, diff))


def _in_lists(asked: Asked, who: np.ndarray, block: dict, limit: np.ndarray):
    """Pairs (question, row, distance) of a block of lists within the limits
    of its questions ``who``, and the number of list entries read."""
    dim, n = len(block["tops"]), len(block["ids"])
    starts, places, weights = block["starts"], block["places"], block["weights"]
    sizes = np.diff(starts)
    q, rows = asked.q[who], np.arange(n)
    most = np.maximum(q * block["tops"], q * block["lows"])          # what a list can add to the product
    order = np.argsort(-np.abs(most).sum(axis=0), kind="stable")
    norms = np.bincount(places, weights * weights, minlength=n)
    # distance <= limit exactly if the product reaches this
    need = ((q * q).sum(axis=1)[:, None] + norms[None, :] - (limit[who] ** 2)[:, None]) / 2
    need -= asked.margin(block) * (1.0 + asked.norm)
    got, read, at = np.zeros((len(who), n)), 0, 0
    who = who.copy()
    for share in STEPS:
        upto = max(at + 1, int(dim * share)) if share < 1 else dim
        lists = order[at:upto]
        at = upto
        part = np.zeros((len(lists), n))
        for j, b in enumerate(lists.tolist()):
            part[j, places[starts[b]:starts[b + 1]]] = weights[starts[b]:starts[b + 1]]
        read += int(sizes[lists].sum() * len(who) * (len(rows) / n))
        got = got + q[:, lists] @ part[:, rows]
        left = most[:, order[at:]].sum(axis=1)
        alive = got + left[:, None] >= need
        a, r = alive.any(axis=1), alive.any(axis=0)
        if not a.any():
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0), read
        who, q, most, rows = who[a], q[a], most[a], rows[r]
        got, need, alive = got[a][:, r], need[a][:, r], alive[a][:, r]
    i, j = np.nonzero(alive)
    dense = np.zeros((n, dim))
    dense[places, np.repeat(np.arange(dim), sizes)] = weights
    return who[i], rows[j], asked.measured(who[i], rows[j], dense[rows[j]]), read


def _in_ring(asked: Asked, who: np.ndarray, block: dict, limit: np.ndarray):
    """The same for a block of vectors: only rows in the ring around the pivot
    are compared."""
    n = len(block["ids"])
    x = block["vectors"].reshape(n, -1)
    d, at, margin = asked.to[who, block["pivot"]], block["at"], asked.margin(block)
    first = np.searchsorted(at, d - limit[who] - margin, side="left")
    last = np.searchsorted(at, d + limit[who] + margin, side="right")
    read = int(np.maximum(last - first, 0).sum())
    some = last > first
    who, first, last = who[some], first[some], last[some]
    if not len(who):
        return who, first, np.zeros(0), read
    lo, hi = int(first.min()), int(last.max())
    near = _distances(asked.q[who], x[lo:hi])
    place = np.arange(lo, hi)
    ok = (place >= first[:, None]) & (place < last[:, None]) & (near <= limit[who][:, None] + margin)
    i, j = np.nonzero(ok)
    return who[i], place[j], asked.measured(who[i], place[j], x[place[j]]), read


FORMS = {"lists": (_in_lists, ("tops", "lows", "starts", "places", "weights")),
         "pivots": (_in_ring, ("lows", "tops", "at", "vectors"))}


def _blocks(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[dict]:
    for rb in batches:
        columns = {f.name: rb.column(i) for i, f in enumerate(rb.schema)}
        for i in range(rb.num_rows):
            out = {c: columns[c][i].values.to_numpy(zero_copy_only=False) for c in names}
            out["ids"] = columns["ids"][i].values.to_numpy(zero_copy_only=False)
            if out["ids"].dtype == object:
                out["ids"] = out["ids"].astype(str)
            out["pivot"], out["norm"] = columns["pivot"][i].as_py(), columns["norm"][i].as_py()
            out["who"] = columns["who"][i].values.to_numpy() if "who" in columns else None
            yield out


def _scan(asked: Asked, form: str, k: int):
    """Arrow batch function: best k of each question over the blocks of a
    partition, and a row of the work done (entries or rows read, all)."""
    function, names = FORMS[form]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit, best = asked.limit.copy(), (None, None, None)
        read = held = 0
        for block in _blocks(batches, names):
            n = len(block["ids"])
            size = len(block["weights"]) if form == "lists" else n
            who = block["who"]
            if who is None:
                held += size * len(asked.ids)
                who = np.flatnonzero(asked.bound(block["lows"], block["tops"]) <= limit + asked.margin(block))
            step = max(1, MATRIX_BUDGET // max(n, len(block["tops"])))
            for i in range(0, len(who), step):
                q, r, d, seen = function(asked, who[i:i + step], block, limit)
                read += seen
                if len(q):
                    best = _keep_best(*best, q, d, block["ids"][r], k)
            if best[0] is not None and len(best[0]):
                full, last = np.unique(best[0][::-1], return_index=True)        # the worst kept of each question
                enough = np.bincount(best[0], minlength=len(limit))[full] >= k
                limit[full[enough]] = np.minimum(limit[full[enough]], best[1][::-1][last[enough]])
        if best[0] is not None and len(best[0]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(best[0].astype(np.int32)), pa.array(best[2].tolist(), asked.id_kind), pa.array(best[1]),
                 pa.nulls(len(best[0]), pa.int64()), pa.nulls(len(best[0]), pa.int64())],
                ["q", "c_id", "distance", "read", "held"])
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1], pa.int32()), pa.nulls(1, asked.id_kind), pa.nulls(1, pa.float64()), pa.array([read]), pa.array([held])],
                ["q", "c_id", "distance", "read", "held"])
    return run


def _nearest_centres(asked: Asked):
    """Arrow batch function over (block, centre): the nearest blocks of every
    question in a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = (None, None, None)
        for rb in batches:
            if not rb.num_rows:
                continue
            blocks = rb.column(0).to_numpy()
            centres = _dense(rb.column(1), asked.q.shape[1])
            step = max(1, MATRIX_BUDGET // len(blocks))
            for i in range(0, len(asked.ids), step):
                to = _distances(asked.q[i:i + step], centres)
                kk = min(FIRST_BLOCKS, len(blocks))
                near = np.argpartition(to, kk - 1, axis=1)[:, :kk]
                q = np.repeat(np.arange(i, i + len(to)), kk)
                best = _keep_best(*best, q, to[q - i, near.ravel()], blocks[near.ravel()], FIRST_BLOCKS)
        if best[0] is not None:
            yield pa.RecordBatch.from_arrays([pa.array(best[0].astype(np.int32)), pa.array(best[2]), pa.array(best[1])],
                                             ["q", "block", "distance"])
    return run


def _first_limits(asked: Asked, index: Index, spark: SparkSession, share) -> np.ndarray:
    """k-th best distance of every question in its nearest blocks."""
    table = index.table(spark)
    near = table.select("block", "centre").mapInArrow(lambda b: _nearest_centres(share.value)(b),
                                                      "q int, block long, distance double")
    w = Window.partitionBy("q").orderBy("distance", "block")
    near = near.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= FIRST_BLOCKS)
    # at most FIRST_BLOCKS rows a question of the block, which is bounded
    who = near.groupBy("block").agg(F.array_sort(F.collect_list("q")).alias("who"))
    looked = table.drop("centre").join(F.broadcast(who), "block")
    found = looked.mapInArrow(lambda b: _scan(share.value, index.form, share.value.k)(b), _schema(index))
    w = Window.partitionBy("q").orderBy("distance", "c_id")
    kth = found.filter("q >= 0").withColumn("r", F.row_number().over(w)).filter(F.col("r") == asked.k)
    out = asked.limit.copy()
    for r in kth.select("q", "distance").collect():        # one row a question of the block
        out[r["q"]] = r["distance"]
    return out


def _schema(index: Index) -> str:
    return f"q int, c_id {index.id_type.simpleString()}, distance double, read long, held long"


def topk(questions: DataFrame, index: Index, k: int, q_id: str = "q_id", q_vec: str = "vector",
         max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """Exact k nearest rows (L2) of every question, ``(q_id, rank, c_id,
    distance)``, ties to the smaller id; and ``(read, held)``: how many list
    entries (or rows) the search read, of all it would compare without bounds.

    Question vectors are stored once and taken in blocks of at most
    ``max_broadcast_bytes``; a block's result is written before the next."""
    spark = questions.sparkSession
    ship_package(spark)
    asked_at, found, work = (scratch_path(spark, n) for n in ("questions", "top-k", "top-k-work"))
    questions.select(F.col(q_id).alias("q_id"), F.col(q_vec).alias("vector")).write.parquet(asked_at)
    stored = spark.read.parquet(asked_at)
    schema = T.StructType([T.StructField("q_id", questions.schema[q_id].dataType), T.StructField("rank", T.IntegerType()),
                           T.StructField("c_id", index.id_type), T.StructField("distance", T.DoubleType())])
    some = False
    for ids, vectors in question_batches(stored, "q_id", "vector", max_broadcast_bytes) if len(index.pivots) else ():
        asked = Asked(index, ids, vectors, k)
        first = spark.sparkContext.broadcast(asked)
        asked.limit = _first_limits(asked, index, spark, first)
        share = spark.sparkContext.broadcast(asked)
        scanned = scratch_path(spark, "top-k-parts")
        (index.table(spark).drop("centre").mapInArrow(lambda b, s=share: _scan(s.value, s.value.form, s.value.k)(b),
                                                      _schema(index)).write.parquet(scanned))
        parts = spark.read.parquet(scanned)
        names = spark.createDataFrame([(i, x) for i, x in enumerate(ids)],
                                      T.StructType([T.StructField("q", T.IntegerType()), schema["q_id"]]))
        w = Window.partitionBy("q").orderBy("distance", "c_id")
        best = parts.filter("q >= 0").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
        best.join(F.broadcast(names), "q").select("q_id", "rank", "c_id", "distance").write.mode("append").parquet(found)
        parts.filter("q < 0").select("read", "held").write.mode("append").parquet(work)
        first.destroy()
        share.destroy()
        some = True
    if not some:
        return spark.createDataFrame([], schema), spark.createDataFrame([], "read long, held long")
    return spark.read.schema(schema).parquet(found), spark.read.schema("read long, held long").parquet(work)
