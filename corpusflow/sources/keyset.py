"""A growing set of string keys on shared storage.

Keys lie in hash buckets (one folder a bucket, one more a batch inside it), and
every bucket has a blocked Bloom filter: a key belongs to one slot of its
bucket, a slot is a bitmap of 32768 bits in which the key sets ``PROBES`` bits.
Whether a batch holds known keys is asked of the filters first; only buckets
with a key that its filter may know are read. When buckets hold more than
``bucket_keys`` keys on average their number doubles, so what is read for a
batch depends on the batch, not on the set.

Adding is idempotent: a batch that is repeated replaces its own keys, filters
only gain the same bits again, and ``known`` looks at earlier batches only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists, scratch_path

SLOT_BITS = 15          # a bitmap of Spark's bitmap_construct_agg
SLOTS = 16              # slots of a bucket
PROBES = 4
DYNAMIC = ("partitionOverwriteMode", "dynamic")


def _hash(key: str, salt: int) -> Column:
    return F.xxhash64(F.col(key), F.lit(salt))


def key_bucket(key: str, buckets: int) -> Column:
    """Bucket of a key among a power of two of buckets."""
    return F.pmod(_hash(key, 0), F.lit(buckets)).cast("int")


def _bits(key: str) -> Column:
    return F.transform(F.array(*[_hash(key, 2 + i) for i in range(PROBES)]),
                       lambda h: F.pmod(h, F.lit(1 << SLOT_BITS)).cast("int"))


def _is_set(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, F.pmod(at, F.lit(8))).bitwiseAND(F.lit(1)) == 1


class KeySet:
    """Keys under ``root``; ``buckets`` (a power of two) is where it starts."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, bucket_keys: int = 1 << 16):
        self.spark, self.root, self.start, self.bucket_keys = spark, root.rstrip("/"), buckets, bucket_keys
        #: Buckets and keys that the last question read.
        self.buckets_read = self.keys_read = 0

    def _folder(self, kind: str, buckets: int) -> str:
        return f"{self.root}/{kind}-{buckets}"

    @property
    def buckets(self) -> int:
        """Buckets of the newest finished layout."""
        n = self.start
        while path_exists(self.spark, self._folder("ready", 2 * n) + "/_SUCCESS"):
            n *= 2
        return n

    def _read(self, kind: str, buckets: int, schema: str, some: list[int]) -> DataFrame:
        folder = self._folder(kind, buckets)
        if not some or not path_exists(self.spark, folder):
            return self.spark.createDataFrame([], schema + ", bucket int")
        return self.spark.read.schema(schema + ", bucket int").parquet(folder).filter(F.col("bucket").isin(some))

    def known(self, keys: DataFrame, key: str, before: int) -> DataFrame:
        """Distinct ``key`` values of ``keys`` that a batch before ``before``
        added."""
        n = self.buckets
        self.buckets_read = self.keys_read = 0
        if not path_exists(self.spark, self._folder("keys", n)):
            return keys.select(key).limit(0)
        asked = keys.select(F.col(key).alias("key")).distinct().withColumn("bucket", key_bucket("key", n))
        asked = asked.withColumn("slot", F.pmod(_hash("key", 1), F.lit(SLOTS)).cast("int")).withColumn("at", _bits("key"))
        path = scratch_path(self.spark, "asked-keys")
        asked.write.parquet(path)
        asked = self.spark.read.parquet(path)
        # at most one number a bucket reaches the driver
        touched = [r[0] for r in asked.select("bucket").distinct().collect()]
        filters = self._read("filters", n, "slot int, bits binary", touched)
        maybe = (asked.join(filters, ["bucket", "slot"])
                 .filter(F.forall("at", lambda a: _is_set(F.col("bits"), a))).select("key", "bucket"))
        path = scratch_path(self.spark, "maybe-known")
        maybe.write.parquet(path)
        maybe = self.spark.read.parquet(path)
        hit = [r[0] for r in maybe.select("bucket").distinct().collect()]
        held = self._read("keys", n, "key string, batch long", hit).filter(F.col("batch") < before)
        self.buckets_read, self.keys_read = len(hit), held.count() if hit else 0
        return maybe.join(held.select("key"), "key", "left_semi").select(F.col("key").alias(key))

    def add(self, keys: DataFrame, key: str, batch: int) -> None:
        """Add the keys of a batch (each once)."""
        n = self.buckets
        self._put(keys.select(F.col(key).alias("key"), F.lit(batch).cast("long").alias("batch")), n)
        if self.size() > n * self.bucket_keys:
            everything = self.spark.read.schema("key string, batch long, bucket int").parquet(self._folder("keys", n))
            total, old = self.size(), n
            while total > n * self.bucket_keys:
                n *= 2
            self._put(everything.select("key", "batch"), n)
            while n > old:            # the mark next to the old layout comes last
                self.spark.range(1).write.mode("overwrite").parquet(self._folder("ready", n))
                n //= 2

    def _put(self, keys: DataFrame, n: int) -> None:
        path = scratch_path(self.spark, "new-keys")
        keys.withColumn("bucket", key_bucket("key", n)).write.parquet(path)
        new = self.spark.read.parquet(path)
        (new.repartition("bucket", "batch").write.mode("overwrite").option(*DYNAMIC).partitionBy("bucket", "batch")
         .parquet(self._folder("keys", n)))
        touched = [r[0] for r in new.select("bucket").distinct().collect()]
        place = F.explode(_bits("key"))
        made = (new.select("bucket", F.pmod(_hash("key", 1), F.lit(SLOTS)).cast("int").alias("slot"), place.alias("at"))
                .groupBy("bucket", "slot").agg(F.bitmap_construct_agg(F.col("at").cast("long")).alias("bits")))
        old = self._read("filters", n, "slot int, bits binary", touched).select("bucket", "slot", "bits")
        both = made.unionByName(old).groupBy("bucket", "slot").agg(F.bitmap_or_agg("bits").alias("bits"))
        path = scratch_path(self.spark, "new-filters")
        both.write.parquet(path)          # read in full before its folders are replaced
        (self.spark.read.parquet(path).repartition("bucket").write.mode("overwrite").option(*DYNAMIC)
         .partitionBy("bucket").parquet(self._folder("filters", n)))

    def size(self) -> int:
        """Number of keys, from the files' footers."""
        folder = self._folder("keys", self.buckets)
        return self.spark.read.parquet(folder).count() if path_exists(self.spark, folder) else 0
