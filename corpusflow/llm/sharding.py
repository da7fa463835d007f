"""Histogram sort: rows into shards of near-equal bytes with one exchange.

Rows are ordered by a key of three 62-bit numbers: the hash of the group
column (equal texts are one group and stay neighbours), the hash of the row's
id, and a row tag. The driver keeps a list of disjoint key cells with their
exact bytes and rows. It starts with equal ranges of the first number; in each
round it picks the cells that matter - those that hold a wanted boundary whose
nearest cell edge is off by more than the tolerance, and those heavier than a
block may be - and cuts each by equally spaced candidate keys; Spark counts the
exact bytes and rows between candidates across all partitions (partial sums
per task; at most cells x candidates rows reach the driver). A cell that has
shrunk to one value of its number goes on with the next number, so a group of
equal texts stays whole unless it alone is larger than the tolerance; then it
is split by row. When every splitter meets the tolerance, rows are exchanged
once: neighbouring cells form blocks, a block is the unit of the exchange,
rows are numbered inside their block in key order, and a block's first slot is
known from the counts.

Only DataFrame functions run; what the driver holds depends on the numbers of
shards, blocks and candidates, never on the rows.

Cases: null size is 0 bytes, null group is a group; if no row has bytes, all
rows go to shard 0; rows of equal id and text are told apart by the tag; an
empty table gives no rows; columns named like an output are replaced, all
others are passed through.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, partitions, tmp

BITS = 62            # of each number of the key
FIRST_BITS = 12      # round 0 has 2**FIRST_BITS equal ranges of the first number
CANDIDATES = 32      # ranges a cell is cut into in a later round
MAX_BLOCKS = 1024
CELLS_AT_ONCE = 64   # cells refined by one counting job


@dataclass
class Cell:
    """Non-empty set of keys: the first numbers are ``prefix``, the next one
    lies in [lo, hi)."""
    prefix: tuple[int, ...]
    lo: int
    hi: int
    bytes: int
    rows: int

    @property
    def start(self) -> tuple[int, int, int]:
        return (*self.prefix, self.lo, 0, 0)[:3]

    @property
    def splittable(self) -> bool:
        return self.rows > 1 and not (len(self.prefix) == 2 and self.hi - self.lo == 1)


def _counts(keyed: DataFrame, at: Column) -> dict[int, tuple[int, int]]:
    got = (keyed.select(at.alias("at"), "size").filter("at is not null").groupBy("at")
           .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect())
    return {r["at"]: (r["bytes"], r["n"]) for r in got}


def first_cells(keyed: DataFrame) -> list[Cell]:
    width = 1 << (BITS - FIRST_BITS)
    got = _counts(keyed, F.shiftright("k0", BITS - FIRST_BITS))
    return [Cell((), i * width, (i + 1) * width, *got[i]) for i in sorted(got)]


def refine(keyed: DataFrame, cells: list[Cell]) -> list[list[Cell]]:
    """The non-empty parts of each cell between candidate keys, in order."""
    at, plan = None, []
    for i, c in enumerate(cells):
        if c.hi - c.lo == 1:                      # one value left: next number
            c = Cell((*c.prefix, c.lo), 0, 1 << BITS, c.bytes, c.rows)
        width = -(-(c.hi - c.lo) // CANDIDATES)
        plan.append((c, width))
        key = F.col(f"k{len(c.prefix)}")
        inside = (key >= F.lit(c.lo)) & (key < F.lit(c.hi))
        for j, v in enumerate(c.prefix):
            inside = (F.col(f"k{j}") == F.lit(v)) & inside
        part = F.lit(i * CANDIDATES).cast("long") + F.call_function("div", key - F.lit(c.lo), F.lit(width))
        at = F.when(inside, part) if at is None else at.when(inside, part)
    got = _counts(keyed, at)
    return [[Cell(c.prefix, c.lo + j * width, min(c.lo + (j + 1) * width, c.hi), *got[i * CANDIDATES + j])
             for j in range(CANDIDATES) if i * CANDIDATES + j in got] for i, (c, width) in enumerate(plan)]


def splitters(keyed: DataFrame, shards: int, tolerance: float, blocks: int) -> tuple[list[Cell], list[int]]:
    """Cells in key order and, per cell, its shard. Refines until each inner
    boundary lies within ``tolerance`` of a shard's bytes from a cell edge and
    no cell is heavier than a block, or cells are single rows."""
    cells = first_cells(keyed)
    total = sum(c.bytes for c in cells)
    targets = [i * total / shards for i in range(1, shards)]
    slack, heavy = tolerance * total / shards, total / blocks
    while True:
        ends = list(accumulate(c.bytes for c in cells))
        poor = {i for i, c in enumerate(cells) if c.bytes > heavy and c.splittable}
        for t in targets:
            i = bisect_left(ends, t)
            if i < len(cells) and cells[i].splittable and min(ends[i] - t, t - ends[i] + cells[i].bytes) > slack:
                poor.add(i)
        if not poor:
            break
        todo = sorted(poor)
        parts: dict[int, list[Cell]] = {}
        for k in range(0, len(todo), CELLS_AT_ONCE):
            some = todo[k:k + CELLS_AT_ONCE]
            parts |= dict(zip(some, refine(keyed, [cells[i] for i in some]), strict=True))
        cells = [p for i, c in enumerate(cells) for p in parts.get(i, [c])]
    # each boundary goes to the nearest cell edge
    edges = [0, *ends]
    first = []
    for t in targets:
        i = bisect_left(edges, t)
        first.append(i if i == 0 or edges[i] - t <= t - edges[i - 1] else i - 1)
    shard, out = 0, []
    for i in range(len(cells)):
        while total and shard < shards - 1 and first[shard] <= i:
            shard += 1
        out.append(shard)
    return cells, out


def _listed(values: list[int], kind: str) -> Column:
    """A constant array."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def shard(df: DataFrame, shards: int, size: Column, group: Column, row_id: Column,
          keep: list[str], tolerance: float = 0.005) -> DataFrame:
    """``keep`` columns of ``df`` plus ``shard`` (int, from 0) and ``slot``
    (long, gapless from 0 in each shard, in key order)."""
    spark = df.sparkSession
    names = {c: tmp("c") for c in keep if c not in ("shard", "slot")}
    blocks = min(MAX_BLOCKS, max(4 * partitions(spark), 2 * shards))

    def number(*cols):
        return F.shiftrightunsigned(F.xxhash64(*cols), 64 - BITS)
    keyed = materialise(
        df.select(*[F.col(c).alias(n) for c, n in names.items()], number(group).alias("k0"),
                  number(row_id).alias("k1"), F.monotonically_increasing_id().alias("k2"),
                  F.coalesce(size, F.lit(0)).cast("long").alias("size")), "shard-keys")
    cells, shard_of = splitters(keyed, shards, tolerance, blocks)
    if not cells:
        return keyed.select(*[F.col(n).alias(c) for c, n in names.items()], F.lit(0).alias("shard"),
                            F.lit(0).cast("long").alias("slot"))
    heavy = max(1, sum(c.bytes for c in cells) / blocks)
    starts, block_shard, base = [], [], []
    load = rows = 0
    for c, s in zip(cells, shard_of, strict=True):
        if not starts or s != block_shard[-1] or load + c.bytes > heavy:
            rows = 0 if starts and s != block_shard[-1] else rows
            starts.append(c.start)
            block_shard.append(s)
            base.append(rows)
            load = 0
        load += c.bytes
        rows += c.rows
    # blocks begun up to each range of round 0, and the begins inside ranges
    width = 1 << (BITS - FIRST_BITS)
    before, inner = [0] * (1 << FIRST_BITS), {}
    for b in starts:
        if b == (b[0] // width * width, 0, 0):
            before[b[0] // width] += 1
        else:
            inner.setdefault(b[0] // width, []).append(b)
            if b[0] // width + 1 < len(before):
                before[b[0] // width + 1] += 1
    before = list(accumulate(before))
    top = F.shiftright("k0", BITS - FIRST_BITS).cast("int")
    extra = F.lit(0)
    if inner:
        begun = None
        for c, keys in sorted(inner.items()):
            at = F.from_json(F.lit(str([list(k) for k in keys])), "array<array<long>>")
            n = F.size(F.filter(at, lambda k: (k[0] < F.col("k0")) | ((k[0] == F.col("k0")) & (
                (k[1] < F.col("k1")) | ((k[1] == F.col("k1")) & (k[2] <= F.col("k2")))))))
            begun = F.when(top == c, n) if begun is None else begun.when(top == c, n)
        extra = begun.otherwise(0)
    block = keyed.withColumn("block", F.get(_listed(before, "int"), top) + extra - 1)
    w = Window.partitionBy("block").orderBy("k0", "k1", "k2")
    return block.select(
        *[F.col(n).alias(c) for c, n in names.items()],
        F.get(_listed(block_shard, "int"), F.col("block")).alias("shard"),
        (F.get(_listed(base, "long"), F.col("block")) + F.row_number().over(w) - 1).alias("slot"))
