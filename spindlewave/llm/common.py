"""Tables, working tables and text buffers shared by the operators."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindlewave.session import settings, work_dir


def small_batches(spark: SparkSession) -> None:
    """Let texts travel to Python in batches of 8 MB.

    Executors hold a batch several times, outside the heap and in the workers; Spark's
    64 MB are more than small executors can spare.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, *, compression: str = "zstd") -> DataFrame:
    """Write the rows to a fresh table in the shared folder and read it back.

    Used where rows are read more than once: lost executors cost no recomputation,
    and the lineage ends here.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    # The shuffle files of the job go with its end, not when its plan is collected as garbage.
    with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared(spark: SparkSession, value) -> Broadcast:
    """A broadcast of any object, with the code of its class, so that executors need not have it."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def opened(broadcast: Broadcast):
    """The object of a ``shared`` broadcast, in a task."""
    return pickle.loads(broadcast.value)


def dropped(*frames: DataFrame) -> None:
    """Remove working tables that nothing reads any more."""
    for df in frames:
        session = df.sparkSession
        hadoop = session._jsc.hadoopConfiguration()
        for file in df.inputFiles()[:1]:
            folder = session._jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(hadoop).delete(folder, True)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array and the n + 1 places where they start; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, places, data = column.buffers()
    starts = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def runs(starts: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Cut texts into runs [a, b) of about ``size`` bytes; a longer text is a run of its own."""
    found, a = [], 0
    while a < len(starts) - 1:
        b = int(np.searchsorted(starts, starts[a] + size, "right")) - 1
        b = max(b, a + 1)
        found.append((a, b))
        a = b
    return found


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed_sample(rows: DataFrame, columns: list[str], size: int) -> DataFrame:
    """At most ``size`` rows, those with the smallest hashes of ``columns``.

    Nearly all rows are left out where they are read, by a bound on the hash; so little is
    sorted, in one task. Equal rows share a hash: as long as a bound leaves too few rows it
    is raised, up to all of them, so the sample has ``size`` rows if there are as many.
    """
    number = rows.count()
    mark = F.pmod(F.xxhash64(*columns), F.lit(1 << 31))
    share = 1.5 * size / max(number, 1)
    while share < 0.75:
        some = rows.where(mark < int((1 << 31) * share) + 1)
        if some.limit(size).count() >= min(size, number):
            rows = some
            break
        share *= 8
    return rows.orderBy(mark, *columns).limit(size)


def unit(column) -> F.Column:
    """A number in [0, 1) that depends on the value alone, the same in every engine with md5."""
    return F.conv(F.substring(F.md5(column.cast("string")), 1, 8), 16, 10).cast("double") / 2.0**32
