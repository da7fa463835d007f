"""Request payload -> ordered seed URL relation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import PY_LINE_BREAK, py_strip

PAYLOAD_SCHEMA = "struct<urls:array<string>, prompt:string>"
MISSING_URLS = "Missing 'urls' list in payload. Provide a JSON array of URLs to crawl."


def seed_urls(payloads: DataFrame, id_col: str = "payload_id", json_col: str = "payload") -> DataFrame:
    """``(payload_id, pos, url, error)``: the ``urls`` array wins when
    non-empty, else the legacy ``prompt`` split on commas and line breaks,
    stripped, kept if it starts with ``http``. A payload with no URL gives
    one row with a null URL and the error text."""
    p = F.from_json(F.col(json_col), PAYLOAD_SCHEMA)
    from_prompt = F.filter(
        F.transform(F.split(F.replace(F.coalesce(p["prompt"], F.lit("")), F.lit(","), F.lit("\n")),
                            PY_LINE_BREAK), py_strip),
        lambda u: u.startswith("http"))
    urls = F.when(F.size(F.coalesce(p["urls"], F.array())) > 0, p["urls"]).otherwise(from_prompt)
    return (payloads.select(id_col, urls.alias("_urls"))
            .select(id_col, F.posexplode_outer("_urls").alias("pos", "url"))
            .withColumn("error", F.when(F.col("url").isNull(), F.lit(MISSING_URLS)))
            .withColumn("pos", F.coalesce("pos", F.lit(0))))
