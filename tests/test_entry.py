"""The driver's entry points."""

from conftest import SF_SMALL


def test_entry_counts_every_session_row(spark):
    import __spark_entry__ as E
    rows = {r["verdict"]: r for r in E.entry(spark).collect()}
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").count()
    assert sum(r["n"] for r in rows.values()) == 2 * pages        # every page is submitted twice
    assert 0 < rows["ok"]["n_document_keys"] <= rows["ok"]["n_stored"] <= rows["ok"]["n"]
    assert all(r["n_stored"] == 0 for v, r in rows.items() if v != "ok")


def test_every_oracle_has_a_query():
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())
