"""Helpers shared by the text operators: bounded slices of Arrow batches and
tables in the shared folder."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from types import ModuleType

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from trackwise.session import staging_path

#: bytes of text handled at once inside a task; a longer text is a slice alone
SLICE_BYTES = 4_000_000


#: rows of text in an Arrow batch; Spark's default of 10,000 long texts fills an
#: executor's memory on both sides of the pipe
BATCH_ROWS = 1_000
_SETTING, _DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def small_batches(spark: SparkSession) -> None:
    """Let this session hand texts to Python in batches of BATCH_ROWS, unless it
    was given a size of its own."""
    if spark.conf.get(_SETTING, _DEFAULT) == _DEFAULT:
        spark.conf.set(_SETTING, str(BATCH_ROWS))


def text_slices(batches, key: str, text: str, limit: int = SLICE_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """(keys, texts as UTF-8 bytes) in slices of at most ``limit`` bytes of text
    (one longer text makes a slice of its own); a null text is b''."""
    keys, texts, size = [], [], 0
    for batch in batches:
        ids = batch.column(key)
        col = batch.column(text).cast(pa.binary())
        for i in range(batch.num_rows):
            b = col[i].as_py() or b""
            if keys and size + len(b) > limit:
                yield keys, texts
                keys, texts, size = [], [], 0
            keys.append(ids[i].as_py())
            texts.append(b)
            size += len(b)
    if keys:
        yield keys, texts


def worker_state() -> dict:
    """A dict of this Python worker that lives on from task to task, for caches."""
    name = "trackwise_worker_state"
    return sys.modules.setdefault(name, ModuleType(name)).__dict__


def write_table(df: DataFrame, name: str) -> str:
    """Write ``df`` as Parquet under the shared folder and return the path."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def through_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage is cut
    and a lost executor costs a re-read, not a recomputation."""
    return df.sparkSession.read.schema(df.schema).parquet(write_table(df, name))


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a table that the loop of an operator no longer reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
