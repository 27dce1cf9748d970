"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.session import ensure_checkpoint_dir

_FOLDERS: list[str] = []
#: Bits of an IdFilter, whatever the number of ids.
FILTER_BITS = 1 << 23
#: The setting that bounds Arrow batches by bytes, and Spark's own value of it.
_BATCH, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def store(spark: SparkSession, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write an intermediate result to the shared checkpoint folder and read it again.

    It cuts lineage and survives lost executors. ``clean`` deletes what was written. ``compression`` names a Parquet codec
    other than the session's.
    """
    path = f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    _FOLDERS.append(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession, size: str = "12m") -> None:
    """Let the session send rows to Python workers in Arrow batches of at most ``size``; a value that the user has set stays.

    The rows of a batch, 10,000 by default, are 34 MB of whole texts or 90 MB of pairs of sets, which the JVM holds in
    vectors of the next power of two beside its heap, and each worker again. Results do not depend on it.
    """
    if spark.conf.get(_BATCH) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH, size)


def mark() -> int:
    """The number of folders written so far, for ``clean``."""
    return len(_FOLDERS)


def clean(spark: SparkSession, since: int = 0) -> None:
    """Delete the intermediate tables written since ``mark()`` returned ``since``.

    Call it when the results that read them have been written.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in _FOLDERS[since:]:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    del _FOLDERS[since:]


class IdFilter:
    """A Bloom filter over ids: a table of fixed size, so it may be sent to every task.

    Rows that it rejects hold none of the ids; it lets some others through, the more the more
    ids there are, so what it passes must still be joined. It saves shuffling the rest.
    """

    def __init__(self, spark: SparkSession, ids: DataFrame, column: str = "doc_id"):
        places = F.explode(F.array(*self._places(column)))
        words = (
            ids.select(places.alias("p"))
            .groupBy(F.shiftright("p", 5).cast("int").alias("w"))
            .agg(F.expr("bit_or(shiftleft(1L, int(p % 32)))").alias("bits"))
            .toPandas()
        )
        table = np.zeros(FILTER_BITS // 32, np.uint32)
        table[words["w"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
        self.bits = spark.sparkContext.broadcast(table)

    @staticmethod
    def _places(column: str) -> list[Column]:
        h = F.xxhash64(F.col(column).cast("long"))
        return [F.pmod(h, F.lit(FILTER_BITS)), F.pmod(F.shiftright(h, 32), F.lit(FILTER_BITS))]

    @staticmethod
    def key(column: str = "doc_id") -> Column:
        """The value that ``may_hold`` needs of each row."""
        return F.xxhash64(F.col(column).cast("long"))

    def may_hold(self, key: np.ndarray) -> np.ndarray:
        table, ok = self.bits.value, np.ones(len(key), bool)
        for p in (key % FILTER_BITS, (key >> 32) % FILTER_BITS):
            ok &= (table[p >> 5] >> (p & 31).astype(np.uint32)) & 1 == 1
        return ok
