"""Session helpers: building a local session for tests and finding the
shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Starting configuration for a cluster run over ``input_bytes`` of
    pages / documents.

    * file splits of 64 MiB: extraction expands an HTML row a few times
      (stripped copy, regions, line arrays), so 64 MiB splits keep a task's
      working set well inside a 4-8 GiB executor core share;
    * about 256 MiB of input per shuffle partition, at least two per core;
      AQE coalesces small partitions and splits skewed ones at runtime.
    """
    parts = max(2 * total_cores, input_bytes // (256 << 20))
    return {**SCALE_CONF,
            "spark.sql.files.maxPartitionBytes": str(64 << 20),
            "spark.sql.shuffle.partitions": str(parts),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20)}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "corpusflow") -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "6g")
         .config("spark.ui.enabled", "false")
         .config("spark.corpusflow.partitions", str(2 * shuffle_partitions))
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder the cluster names in ``spark.checkpoint.dir``.

    The setting is only read. Where it is unset, a local master gets a scratch
    folder of its own (tests, bench); any other master raises, because a
    machine-local folder is not visible to the other machines.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all machines share")
        d = tempfile.mkdtemp(prefix="corpusflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder (a URI) under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def spread(df, partitions: int | None = None):
    """Deal CPU-heavy row work over ``partitions`` tasks: the argument, else
    the setting ``spark.corpusflow.partitions``. Without either the scan's own
    splits are kept, as on a cluster reading many files; the setting is for a
    few coarse files on many cores (tests, bench)."""
    n = partitions or df.sparkSession.conf.get("spark.corpusflow.partitions", None)
    return df.repartition(int(n)) if n and not df.isStreaming else df


def path_exists(spark: SparkSession, uri: str) -> bool:
    """Whether a path exists in the file system its URI names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def path_state(spark: SparkSession, uri: str) -> str:
    """Names, sizes and times of the files at a path, as one string."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return ";".join(sorted(f"{f.getPath()}|{f.getLen()}|{f.getModificationTime()}" for f in found))


def stored_once(spark: SparkSession, name: str, source: str, make):
    """What ``make`` stored for the files at ``source``, made at the first call
    of a session and again when the files have changed."""
    sc = spark.sparkContext
    kept = sc.__dict__.setdefault("_corpusflow_stored", {})
    state = path_state(spark, source)
    if kept.get((name, source), (None,))[0] != state:
        kept[name, source] = state, make()
    return kept[name, source][1]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship_package(spark: SparkSession) -> None:
    """Make ``corpusflow`` importable in Python workers (the Arrow batch
    functions are pickled by reference): zip the package once per
    SparkContext and add it with ``addPyFile``, which distributes it to
    every executor."""
    sc = spark.sparkContext
    if getattr(sc, "_corpusflow_shipped", False):
        return
    import shutil

    import corpusflow
    pkg_dir = os.path.dirname(os.path.abspath(corpusflow.__file__))
    out = tempfile.mkdtemp(prefix="corpusflow-pkg-")  # driver-side build artifact
    zip_path = shutil.make_archive(os.path.join(out, "corpusflow"), "zip",
                                   root_dir=os.path.dirname(pkg_dir), base_dir="corpusflow")
    sc.addPyFile(zip_path)
    sc._corpusflow_shipped = True
