"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder of all tables that operators write, within the shared one.
WORK = "fleethealth-work"

SPACE = b" \t\n\x0b\x0c\r"

#: Maps bytes A-Z to a-z and leaves all others, so it is safe on UTF-8.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it.

    Where it is unset, a local session, whose executors are threads of this
    machine, gets a temporary folder; a cluster's session is an error, as no
    folder of the driver's own machine would do.
    """
    set_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not set_dir:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        set_dir = tempfile.mkdtemp(prefix="fleethealth-")
        spark.sparkContext.setCheckpointDir(set_dir)
    return set_dir.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{WORK}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends there, and a lost executor costs no recomputation.

    A plan that reads the table may run after the function that wrote it has
    returned, so the table lives as long as the folder does, as checkpoints do.
    ``clean_work`` deletes all of a folder's tables once no result is read any more.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def clean_work(spark: SparkSession) -> None:
    """Deletes all tables and archives that this subpackage wrote to the shared folder. Results that aren't collected or written by then are lost."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{WORK}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def delete_work(spark: SparkSession, df: DataFrame) -> None:
    """Deletes the files of a table that ``written`` made."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if f"/{WORK}/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


#: Keys of over one row in this many are broadcast: there are at most as many of them, whatever the input.
HOT_SHARE = 1000


def join_sized(left: DataFrame, right: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """``left`` joined with ``right``, which has a row for each key; ``size`` is how many of left's ``total`` rows have the key.

    The rows of hot keys stay where they are and meet a broadcast of at most
    HOT_SHARE rows, so no task gets a key's rows as a whole; all others are shuffled.
    """
    limit = total // HOT_SHARE
    hot, cold = right.where(F.col(size) > limit), right.where(F.col(size) <= limit)
    near = left.join(F.broadcast(hot), keys)
    return near.unionByName(left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys))


def utf8(column: pa.Array) -> list[memoryview | bytes]:
    """Each text's UTF-8 bytes without a copy; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return []
    large = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1]
    data = memoryview(column.buffers()[2] or b"")
    return [data[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


@functools.cache
def _libc():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # another C library
        return None


def release() -> None:
    """Gives freed memory back to the system: Spark keeps Python workers, and what one task has freed counts against the executor while others run."""
    pa.default_memory_pool().release_unused()
    if trim := _libc():
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of about ``most`` bytes of text, one row at least, so that memory depends on neither Arrow's batch size nor long rows."""
    release()
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(text) if isinstance(batch, pa.RecordBatch) else batch[text]
        sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
    release()
