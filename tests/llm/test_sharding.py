import random

import pytest
from pyspark.sql import functions as F

from corpusflow.llm import sharding

from .helpers import CLASHES, ODD, documents


def run(df, shards, **kw):
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 8
    return sharding.shard(df, shards, size, F.col("text"), F.col("doc_id"), ["doc_id", "text", *kw.pop("keep", [])],
                          **kw).collect()


def check(rows, n, shards, slack):
    assert len(rows) == n
    slots, load, total = {}, [0] * shards, 0
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        b = len((r["text"] or "").encode()) + 8
        load[r["shard"]] += b
        total += b
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    largest = max((len((r["text"] or "").encode()) + 8 for r in rows), default=0)
    for x in load:
        assert abs(x - total / shards) <= slack * total / shards + 2 * largest
    return slots


def test_near_equal_and_groups_together(spark):
    rng = random.Random(3)
    rows = [(i, f"text {rng.randint(0, 900)} " + "x" * rng.randint(0, 80)) for i in range(4000)]
    got = run(documents(spark, rows), 24, tolerance=0.03)
    check(got, 4000, 24, 0.06)
    where = {}
    for r in got:
        where.setdefault(r["text"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in where.values())


@pytest.mark.parametrize("same_id", [False, True])
def test_hot_group_and_repeated_rows_are_split(spark, same_id):
    rows = [(7 if same_id else i, "one text of a third of all rows") for i in range(1500)]
    rows += [(10_000 + i, f"other {i}") for i in range(1500)]
    check(run(documents(spark, rows), 24), 3000, 24, 0.02)


def test_odd_rows_clashes_and_empty(spark):
    got = run(documents(spark, ODD, CLASHES), 5, keep=list(CLASHES))
    check(got, len(ODD), 5, 1)
    assert got[0]["tag"] == "own tag" and isinstance(got[0]["shard"], int)
    assert run(documents(spark, []), 5) == []
    zero = sharding.shard(documents(spark, ODD), 5, F.lit(0), F.col("text"), F.col("doc_id"), ["doc_id"]).collect()
    assert {r["shard"] for r in zero} == {0} and sorted(r["slot"] for r in zero) == list(range(len(ODD)))


def test_native_and_one_exchange(spark):
    out = sharding.shard(documents(spark, ODD), 3, F.lit(9), F.col("text"), F.col("doc_id"), ["doc_id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.split("== Initial Plan ==")[-1].count("Exchange") == 1


def test_queries_move_texts_and_ids_through_the_operators(spark, monkeypatch):
    from conftest import SF_SMALL

    from corpusflow.llm import packing, queries, sharding
    shard, pack, moved = sharding.shard, packing.pack, []

    def shard_seen(*args, **kw):
        out = shard(*args, **kw)
        moved.append("text" in out.columns)
        return out

    def pack_seen(items, *args, **kw):
        moved.append("ids" in items.columns)
        return pack(items, *args, **kw)

    monkeypatch.setattr(sharding, "shard", shard_seen)
    monkeypatch.setattr(packing, "pack", pack_seen)
    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert queries.op4_histogram_shards(spark, SF_SMALL).filter("text_crc32 is not null and size >= 8").count() == n
    assert queries.op3_best_fit_pack(spark, SF_SMALL).filter("ids_crc32 is null or sequence_id is null").count() == 0
    assert moved == [True, True]
