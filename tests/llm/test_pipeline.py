import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusflow.llm import linecrf, packing, queries, simhash, suffix
from corpusflow.llm.common import table

from .helpers import CLASHES, ODD, full_documents, prose
from .test_linecrf import junk
from .test_simhash import groups, plain_fingerprint
from .test_suffix import brute

STAGES = dict(corpus_pipeline.STAGES)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Documents with every odd row, labels, near copies and shared passages."""
    d = str(tmp_path_factory.mktemp("small"))
    good = prose(5, 60, 120)
    passage = " ".join(f"passage{i}" for i in range(60))
    good += [(5000 + i, t[:len(t) // 2] + " " + passage + " " + t[len(t) // 2:]) for i, (_, t) in enumerate(prose(6, 12, 90))]
    good += [(6000 + i, t + " extra") for i, (_, t) in enumerate(good[:15])] + [(6500 + i, t) for i, (_, t) in enumerate(good[:9])]
    rows = good + [(8000 + i, junk(i)) for i in range(30)] + ODD
    full_documents(spark, rows, CLASHES).write.parquet(d + "/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in good[:40]] + [(8000 + i, 0, 0) for i in range(15)],
                          "doc_id long, quality int, toxic int").write.parquet(d + "/labels.parquet")
    return d, rows


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_dedup", "suffix_dedup", "best_fit_packing"]


def test_pipeline_against_brute_force(spark, small):
    d, rows = small
    docs = table(spark, d, "documents")
    # 1: the rules recomputed from the model alone
    model = linecrf.fit(docs, table(spark, d, "labels"))
    keep = []
    for i, t in rows:
        n, _, _, _, repeated, share = linecrf.measure_text(t or "", model)
        if n >= 20 and 100 * repeated <= 30 * n and share >= 0.5:
            keep.append((i, t))
    one = STAGES["quality_rules"](spark, docs, d)
    assert one.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in one.collect()) == sorted(keep)
    assert not any(t.startswith("BUY") for _, t in keep) and len(keep) > 60
    # 2: one document of each group, the least id
    part = groups([plain_fingerprint(t) for _, t in keep])
    least = {}
    for p, r in zip(part, keep, strict=True):
        least[p] = min(least.get(p, r), r)
    two = STAGES["simhash_dedup"](spark, spark.createDataFrame(one.collect(), one.schema), d)
    assert two.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in two.collect()) == sorted(least.values())
    # 3: no repeated 100-byte string is left
    two = spark.createDataFrame(two.collect(), two.schema)
    three = STAGES["suffix_dedup"](spark, two, d)
    assert three.columns == docs.columns
    want = {t: (k, n) for t, k, n in brute(list(least.values()))}
    three = spark.createDataFrame(three.collect(), three.schema)
    texts = dict(least.values())
    cut = 0
    for r in three.collect():
        kept, n = want[texts[r["doc_id"]]]
        assert r["text"] == kept.decode(errors="ignore") and r["n_chars"] == len(r["text"])
        cut += n
    assert cut >= 11
    # 4: every token of every text, in gapless sequences
    four = STAGES["best_fit_packing"](spark, three, d).collect()
    ids = {r["doc_id"]: bytes(r["ids"]) for r in queries.tokens.tokenize(
        three.select("doc_id", "text"), queries.public_tokenizers.path("byte_bpe_50k.json")).collect()}
    got = {}
    for r in sorted(four, key=lambda r: (r["doc_id"], r["piece"])):
        got[r["doc_id"]] = got.get(r["doc_id"], b"") + bytes(r["ids"])
    assert got == {i: x + queries.PACK_END for i, x in ids.items()}
    # run() gives the same rows
    whole = corpus_pipeline.run(spark, d).collect()
    assert sorted((r["doc_id"], r["piece"], bytes(r["ids"])) for r in whole) == sorted(
        (r["doc_id"], r["piece"], bytes(r["ids"])) for r in four)


def test_stages_with_odd_and_empty_tables(spark, small):
    d, _ = small
    docs = table(spark, d, "documents").filter(F.col("doc_id").isNull() | (F.col("doc_id") < 20))
    for some in (docs, docs.limit(0)):
        n = some.count()
        assert STAGES["quality_rules"](spark, some, d).columns == docs.columns
        assert STAGES["simhash_dedup"](spark, some, d).count() <= n
        cut = STAGES["suffix_dedup"](spark, some, d)
        assert cut.count() == n and cut.filter("text is null").count() == some.filter("text is null").count()
        assert STAGES["best_fit_packing"](spark, some, d).select("doc_id").distinct().count() == some.select(
            "doc_id").distinct().count()


def test_registered_queries(spark):
    """Every registered query runs on the smallest tables; those with SQL
    equal it."""
    con = duckdb.connect()
    for name in ("conversations", "documents"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    names = queries.queries()
    assert [n.split("_")[0] for n in sorted(names, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{i}" for i in range(1, 14)]
    for name, q in names.items():
        rows = q(spark, SF)
        sql = queries.oracle_sql().get(name)
        if sql is None:
            assert rows.count() > 0, name
            continue
        want = con.execute(f"SELECT {', '.join(rows.columns)} FROM ({sql})").fetchall()
        assert sorted(map(tuple, rows.collect()), key=str) == sorted(want, key=str), name
