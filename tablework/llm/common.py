"""Helpers that several text operators share."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablework.session import scratch_dir

BATCH_SETTING, BATCH_OCTETS = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
WORD_SPLIT = r"[\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application; they need not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="tablework-code-"), "tablework-code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def give_back() -> None:
    """Return freed memory to the system, where the C library can: a worker that waits for its next task keeps what its last one took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(run: Callable) -> Callable:
    """The same batches; when the last of them is out, the worker keeps no freed memory."""

    def freed(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return freed


def map_batches(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with a function of this package.

    Batches are cut by octets as well as by rows, unless the session says otherwise: ten thousand long texts are
    no batch for one worker. The setting changes no result. Workers outlive their tasks, so each task gives its memory back.
    """
    ship(df.sparkSession)
    if df.sparkSession.conf.get(BATCH_SETTING, None) is None:
        df.sparkSession.conf.set(BATCH_SETTING, BATCH_OCTETS)
    return df.mapInArrow(giving_back(run), schema)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have yet (names are compared without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that most operators need, under fixed names; whatever else the frame has stays behind."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back.

    The files outlive a lost executor, their size is known to the optimizer (so a side is broadcast
    only when it is measured to be small), and a join with the scan gets its own exchange, whose hot
    partitions adaptive execution can split.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.stored_at = path
    return found


def discard(*frames: DataFrame) -> None:
    """Delete tables that :func:`stored` wrote. Call it once whatever is built on them is stored itself."""
    for df in frames:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def groups_of(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of consecutive items whose sizes add up to about ``limit``; one item at least each."""
    a, total = 0, 0
    for i, n in enumerate(sizes):
        if i > a and total + n > limit:
            yield a, i
            a, total = i, 0
        total += n
    if a < len(sizes):
        yield a, len(sizes)


def splitmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))



def words_of(text: Column) -> Column:
    """Native: the words of a text (not null) as an array."""
    return F.filter(F.split(text, WORD_SPLIT, -1), lambda w: w != "")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``: inside lambdas nothing else keeps Spark from evaluating it again."""
    return F.transform(F.array(value), body)[0]
