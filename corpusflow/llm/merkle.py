"""Merkle dataset manifest with nested-interval labels.

Every row is a leaf; the leaves of a group (one tree a group, one more tree
over the groups' subroots) are ranked, and every node carries the interval
[lo, hi) of the leaf ranks it covers. ``FAN`` consecutive nodes have one
parent, whose digest is the hash of theirs, so a node of level k lies in bucket
``lo div FAN^k`` and in exactly one interval of that level.

* Up: the nodes of a level are grouped by their parent's bucket (never more
  than FAN of them), the parent takes the hull of their intervals and keeps
  their labels. Levels are written one by one; each has an eighth of the rows of
  the one below. A node that covers its whole group is the subroot.
* Down: from the top, each parent hands its path to its children and adds their
  siblings: the intervals of the parent's children less the child's own. A
  child then meets its own row, which holds its children, by a containment join
  inside the bucket of its level. The last step attaches the paths to the
  blocks of FAN leaves; only there, inside one row, they are spread over the
  leaves, so paths of single leaves are never shuffled.

Ranks come from even ranges of (group, id, digest, row tag): rows are numbered
inside their range and a small table counts ranges and groups, so neither a
group nor repeated rows gather in one task. Texts take part in the first scan
only.

Cases: a null field hashes as ``-``, so null and empty text differ; null ids come
first; rows of equal id are ordered by their leaf, equal rows take neighbouring
places in any order (their results as a set are the same); the null group is a
group of its own and comes first; a lone leaf is its tree's root and its proof
the hash of nothing; an empty table gives no rows. Only the columns named by the
caller are read; extra ones do not matter, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, partitions

FAN = 8


def hashed(*parts: Column) -> Column:
    """Lower-case hex sha256 of the parts laid side by side."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its UTF-8 length before it; ``-`` for null."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Digest of a row."""
    return hashed(*[field(v) for v in values])


def group_key(group: Column) -> Column:
    """Group as a non-null string: bytewise order, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


@dataclass
class Tree:
    """``blocks(g, lo, hi, kids)``: leaves in blocks of FAN; ``levels``: node
    tables ``(g, lo, hi, digest, kids)`` from level 1 up; ``roots(g, root, n)``."""
    blocks: DataFrame
    levels: list[DataFrame]
    roots: DataFrame


def ranked(leaves: DataFrame) -> DataFrame:
    """``leaves(g, id, digest, load)`` plus ``rank`` (from 0 in each group, by
    id, digest) and ``n`` (leaves of the group)."""
    spark = leaves.sparkSession
    order = [F.col("g"), F.col("id").asc_nulls_first(), F.col("digest"), F.col("tag")]
    rows = materialise(
        leaves.withColumn("tag", F.monotonically_increasing_id())
        .repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).drop("tag")
        .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    runs = rows.groupBy("part", "g").agg(F.count(F.lit(1)).alias("size"), F.min("at").alias("first"))
    w = Window.partitionBy("g")
    before = F.sum("size").over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = materialise(runs.select("part", "g", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
                                   F.sum("size").over(w).alias("n")), "merkle-runs")
    return rows.join(runs, ["part", "g"]).withColumn("rank", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _parents(nodes: DataFrame, width: int, *kid: str) -> DataFrame:
    """Nodes of the next level, ``width`` ranks wide, with their children."""
    return (nodes.groupBy("g", F.expr(f"lo div {width}").alias("bucket"))
            .agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest", *kid))).alias("kids"),
                 F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("n").alias("n"))
            .withColumn("digest", hashed(F.array_join(F.col("kids")["digest"], ""))).drop("bucket"))


def build(leaves: DataFrame, name: str) -> Tree:
    """Tree of every group over ``leaves(g, id, digest, load)``."""
    first = ranked(leaves).select("g", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", "id",
                                  "load", "n")
    blocks = materialise(_parents(first, FAN, "id", "load"), f"{name}-blocks")
    # a lone leaf is its own root
    blocks = blocks.withColumn("digest", F.when(F.col("n") == 1, F.col("kids")[0]["digest"]).otherwise(F.col("digest")))
    most = blocks.agg(F.max("n")).first()[0] or 0
    nodes, levels, width = blocks.select("g", "lo", "hi", "digest", "n"), [], FAN
    roots = nodes.filter("hi - lo = n")
    while width < most:
        width *= FAN
        level = materialise(_parents(nodes.filter("hi - lo < n"), width), f"{name}-level")
        levels.append(level)
        nodes = level.select("g", "lo", "hi", "digest", "n")
        roots = roots.unionByName(nodes.filter("hi - lo = n"))
    return Tree(blocks, levels, roots.select("g", F.col("digest").alias("root"), "n"))


def handed_down(parents: DataFrame) -> DataFrame:
    """Children of ``parents(g, kids, path, ...)`` with their own path: one
    more step before the parent's, the hex digests of the siblings left and
    right of the child's interval."""
    def side(of: Column, test) -> Column:
        return F.array_join(F.transform(F.filter("kids", lambda k: test(k, of)), lambda k: k["digest"]), "")

    def step(kid: Column) -> Column:
        return F.struct(side(kid, lambda k, of: k["hi"] <= of["lo"]).alias("left"),
                        side(kid, lambda k, of: k["lo"] >= of["hi"]).alias("right"))
    lone = (F.col("n") == 1)            # no step above a lone leaf
    kids = F.transform("kids", lambda k: F.struct(
        k.alias("kid"), F.when(lone, F.col("path")).otherwise(F.concat(F.array(step(k)), "path")).alias("path")))
    return parents.select("g", F.explode(kids).alias("x")).select("g", "x.kid.*", "x.path")


PATH = "array<struct<left: string, right: string>>"


def paths(tree: Tree, above: DataFrame) -> DataFrame:
    """``(g, id, digest, load, path)`` of every leaf; ``above(g, path)`` holds
    the path that follows each group's root."""
    top = tree.roots.select("g", "n").join(above, "g")
    width = FAN ** (len(tree.levels) + 1)
    known = top.select("g", F.lit(0).cast("long").alias("lo"), F.col("n").alias("hi"), "path")   # roots by interval
    pending = None                                    # children handed down to the level at hand
    for level in [*reversed(tree.levels), tree.blocks]:
        # a root enters at its own level: the least width that covers the group
        here = known.filter((F.col("hi") <= width) & (F.lit(width == FAN) | (F.col("hi") > width // FAN)))
        pending = here if pending is None else pending.unionByName(here)
        node, kid = level.alias("node"), pending.alias("kid")
        held = node.join(kid, (F.col("node.g") == F.col("kid.g"))
                         & (F.expr(f"node.lo div {width}") == F.expr(f"kid.lo div {width}"))
                         & (F.col("kid.lo") <= F.col("node.lo")) & (F.col("node.hi") <= F.col("kid.hi")))
        down = handed_down(held.select("node.g", "node.kids", "node.n", "kid.path"))
        if width > FAN:
            pending = materialise(down.select("g", "lo", "hi", "path"), "merkle-paths")
        width //= FAN
    return down.select("g", "id", "digest", "load", "path")


def proof(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return hashed(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def folded(digest: Column, path: Column) -> Column:
    """Root that a leaf and its siblings lead to."""
    return F.aggregate(path, digest, lambda d, s: hashed(s["left"], d, s["right"]))


def manifest(rows: DataFrame, row_id: Column, group: Column, values: list[Column], load: Column) -> DataFrame:
    """``(id, group_key, leaf, load, subroot, root, path)`` of every row: its
    digest over ``values``, the root of its group's tree, the root over all
    groups and the path from the leaf to it. ``load`` travels along."""
    leaves = rows.select(group_key(group).alias("g"), row_id.alias("id"), leaf(*values).alias("digest"),
                         load.alias("load"))
    inner = build(leaves, "merkle")
    roots = inner.roots
    outer = build(roots.select(F.lit("").alias("g"), F.col("g").alias("id"), F.col("root").alias("digest"),
                               F.lit(None).cast("int").alias("load")), "merkle-top")
    none = F.from_json(F.lit("[]"), PATH)
    root = outer.roots.first()                    # the one root of all, or nothing
    above = materialise(paths(outer, outer.roots.select("g", none.alias("path"))).select(
        F.col("id").alias("g"), F.col("digest").alias("subroot"), F.lit(root["root"] if root else None).alias("root"),
        "path"), "merkle-roots")
    found = paths(inner, above.select("g", "path"))
    return found.join(above.select("g", "subroot", "root"), "g").select(
        "id", F.col("g").alias("group_key"), F.col("digest").alias("leaf"), "load", "subroot", "root", "path")
