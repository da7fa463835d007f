"""Vector best-fit packing of documents into training sequences.

Every item has a demand vector: its tokens, one document, and its attention
cost (tokens squared). A sequence has a capacity for each. Items are placed in
decreasing length; each goes to the open sequence that fits under every
constraint and is best by the residual norm (smallest weighted norm of what
would stay free) or the weighted dot-product of demand and residual; without a
fit a sequence is opened.

Items of equal length have equal vectors and open sequences of equal residual
are interchangeable, so the choice is made once per (length, residual) instead
of per item: Spark counts items per length, the driver plans over that
histogram (its size depends on the capacity, not on the data), and Spark gives
each item its place from its rank within its length. The plan equals placing
the items one by one. Ranks are counted per (length, salt) and offset by the
counts of earlier salts, so a length that a third of all items share is
spread over ``SALTS`` groups.

Cases: items with null or negative length count as length 0 (they take a
document slot only); an item that fits no empty sequence gets null places;
repeated rows are items of their own; all columns are passed through and one
named like an output is replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, ship_package, tmp

SALTS = 64


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds; the defaults for documents and attention never
    bind before the tokens do."""
    tokens: int = 1024
    documents: int = 1025
    attention: int = 1024 * 1024

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], dtype=np.int64)


def demand(length: int) -> np.ndarray:
    return np.array([length, 1, length * length], dtype=np.int64)


class Plan:
    """Placement rules ``(length, first rank, first sequence, items a sequence,
    first offset)``: the item of rank r in a rule goes to sequence ``first +
    (r - first rank) // items``."""

    def __init__(self, capacity: Capacity, weights: tuple[float, float, float], by: str):
        self.cap = capacity.vector()
        self.weights = np.array(weights, dtype=float)
        self.by = by
        self.residual = np.empty((0, 3), dtype=np.int64)
        self.count = np.empty(0, dtype=np.int64)
        self.ids: list[list[tuple[int, int]]] = []      # (first sequence, sequences)
        self.where: dict[tuple, int] = {}
        self.rules: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0

    def score(self, residual: np.ndarray, need: np.ndarray) -> np.ndarray:
        if self.by == "dot":
            return -((residual / self.cap) * (need / self.cap) * self.weights).sum(axis=1)
        return ((((residual - need) / self.cap) ** 2) * self.weights).sum(axis=1)

    def add(self, residual: np.ndarray, first: int, n: int) -> None:
        key = tuple(residual.tolist())
        at = self.where.get(key)
        if at is None:
            at = self.where[key] = len(self.ids)
            self.residual = np.vstack([self.residual, residual[None]])
            self.count = np.append(self.count, 0)
            self.ids.append([])
        self.count[at] += n
        self.ids[at].append((first, n))

    def take(self, at: int, n: int) -> list[tuple[int, int]]:
        self.count[at] -= n
        out = []
        while n:
            first, have = self.ids[at].pop()
            use = min(have, n)
            out.append((first, use))
            if have > use:
                self.ids[at].append((first + use, have - use))
            n -= use
        return out

    def compact(self) -> None:
        """Forget residuals that no open sequence has."""
        keep = np.nonzero(self.count)[0]
        self.residual, self.count = self.residual[keep], self.count[keep]
        self.ids = [self.ids[i] for i in keep]
        self.where = {tuple(r): i for i, r in enumerate(self.residual.tolist())}

    def place(self, length: int, items: int) -> None:
        need, rank = demand(length), 0

        def fill(residual: np.ndarray, runs: list[tuple[int, int]], each: int) -> None:
            nonlocal rank
            for first, n in runs:
                self.rules.append((length, rank, first, each, int(self.cap[0] - residual[0])))
                rank += n * each
                self.add(residual - each * need, first, n)

        self.compact()
        fits = np.nonzero((self.residual >= need).all(axis=1))[0]
        residuals = self.residual[fits].copy()
        if self.by == "dot":
            # an item makes its sequence less wanted: one item each, best residuals first
            while len(fits) and rank < items:
                i = fits[int(np.argmin(self.score(self.residual[fits], need)))]
                n = min(int(self.count[i]), items - rank)
                fill(self.residual[i].copy(), self.take(i, n), 1)
                fits = np.nonzero((self.residual >= need).all(axis=1) & (self.count > 0))[0]
            residuals = residuals[:0]
            fits = fits[:0]
        order = np.argsort(self.score(residuals, need), kind="stable")
        for i, residual in zip(fits[order], residuals[order], strict=True):
            if rank == items:
                return
            each = self.most(residual, need)
            full = min(int(self.count[i]), (items - rank) // each)
            have = int(self.count[i])
            if full:
                fill(residual, self.take(i, full), each)
            if have > full and rank < items:
                fill(residual, self.take(i, 1), items - rank)
        each = self.most(self.cap, need)
        if each == 0 or rank == items:
            return
        full, rest = divmod(items - rank, each)
        for n, m in ((full, each), (1 if rest else 0, rest)):
            if n:
                fill(self.cap, [(self.sequences, n)], m)
                self.sequences += n

    @staticmethod
    def most(residual: np.ndarray, need: np.ndarray) -> int:
        """Items of this demand that one residual holds."""
        return int(min(r // d for r, d in zip(residual.tolist(), need.tolist(), strict=True) if d))


def plan(histogram: dict[int, int], capacity: Capacity, weights: tuple[float, float, float] = (1.0, 0.01, 0.01),
         by: str = "norm") -> Plan:
    """Best-fit decreasing over counts by length."""
    p = Plan(capacity, weights, by)
    for length in sorted(histogram, reverse=True):
        p.place(length, histogram[length])
    return p


def pack(items: DataFrame, length: str = "length", capacity: Capacity = Capacity(),
         weights: tuple[float, float, float] = (1.0, 0.01, 0.01), by: str = "norm") -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset`` (first token's place)."""
    spark = items.sparkSession
    ship_package(spark)
    tag, size, salt = tmp("tag"), tmp("size"), tmp("salt")
    base, rank, at = tmp("base"), tmp("rank"), tmp("at")
    items = items.drop("sequence_id", "offset")
    tagged = materialise(items.withColumn(tag, F.monotonically_increasing_id()), "pack-items")
    tagged = (tagged.withColumn(size, F.greatest(F.coalesce(F.col(length), F.lit(0)), F.lit(0)).cast("long"))
              .withColumn(salt, F.pmod(F.xxhash64(tag), F.lit(SALTS))))
    # lengths over the capacity cannot be placed; the rest bounds the histogram
    # to (tokens + 1) x SALTS rows, however many items there are
    counts = (tagged.filter(F.col(size) <= capacity.tokens).groupBy(size, salt).count()
              .orderBy(size, salt).collect())
    histogram: dict[int, int] = {}
    bases = []
    for n_tokens, s, n in counts:
        bases.append((n_tokens, s, histogram.get(n_tokens, 0)))
        histogram[n_tokens] = histogram.get(n_tokens, 0) + n
    rules = sorted(plan(histogram, capacity, weights, by).rules)
    rules = spark.sparkContext.broadcast(np.array(rules, dtype=np.int64).reshape(-1, 5))
    starts = spark.createDataFrame(bases, f"{size} long, {salt} long, {base} long")
    ranked = tagged.withColumn(rank, F.row_number().over(Window.partitionBy(size, salt).orderBy(tag)) - 1)
    ranked = ranked.join(F.broadcast(starts), [size, salt], "left")

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def find(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        r = rules.value
        width = int(r[:, 1].max(initial=0)) + 1
        keys = r[:, 0] * width + r[:, 1]
        lengths = np.unique(r[:, 0])
        for n_tokens, place in batches:
            n = n_tokens.to_numpy(zero_copy_only=False).astype(np.int64)
            p = place.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            known = np.isin(n, lengths)
            if not known.any():
                yield pa.array([None] * len(n), pa.struct([("sequence_id", pa.int64()), ("offset", pa.int64())]))
                continue
            q = n * width + np.minimum(p, width - 1)
            row = r[np.maximum(np.searchsorted(keys, q, side="right") - 1, 0)]
            k = p - row[:, 1]
            seq, off = row[:, 2] + k // row[:, 3], row[:, 4] + (k % row[:, 3]) * n
            yield pa.StructArray.from_arrays([pa.array(seq, mask=~known), pa.array(off, mask=~known)],
                                             ["sequence_id", "offset"])

    placed = ranked.withColumn(at, find(F.col(size), F.col(base) + F.col(rank)))
    return placed.select(*items.columns, F.col(at)["sequence_id"].alias("sequence_id"),
                         F.col(at)["offset"].alias("offset"))


def cut(docs: DataFrame, ids: str = "ids", size: int = 1024) -> DataFrame:
    """Pieces of at most ``size`` ids of a binary id column (4 bytes an id):
    columns of ``docs`` without ``ids`` plus ``piece, start, length, ids``.
    Only the first piece of a longer document may be shorter than ``size``;
    a document without ids gives no piece."""
    n = F.length(ids) / 4
    n = n.cast("long")
    first = F.pmod(n - 1, F.lit(size)) + 1
    keep = [c for c in docs.columns if c not in (ids, "piece", "start", "length")]

    def piece(i):
        start = F.when(i == 0, F.lit(0).cast("long")).otherwise(first + (i - 1) * size)
        length = F.when(i == 0, first).otherwise(F.lit(size).cast("long"))
        return F.struct(i.cast("int").alias("piece"), start.alias("start"), length.alias("length"),
                        F.substring(F.col(ids), (start * 4 + 1).cast("int"), (length * 4).cast("int")).alias("ids"))
    # null (no piece) for a document without ids; a filter would run the encoder twice
    pieces = F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / size)), piece))
    return (docs.select(*keep, F.explode(pieces).alias("p"))
            .select(*keep, "p.piece", "p.start", "p.length", F.col("p.ids").alias(ids)))
