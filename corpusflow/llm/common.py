"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package  # noqa: F401

#: Word of every text operator: a run without space, tab, LF, VT, FF, CR.
#: ``bytes.split()`` of the UTF-8 text yields exactly these words.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared scratch space and read it
    back: the lineage ends there, a lost executor costs nothing upstream, and
    values of non-deterministic expressions (row tags) are fixed."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """Shuffle width the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tmp(name: str) -> str:
    """Internal column name that no input column has."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def release() -> None:
    """Give memory that is free inside this Python worker back to the system;
    workers live on between stages and share their executor's memory."""
    import ctypes

    import pyarrow
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lower_ascii(col):
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
