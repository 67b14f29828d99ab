"""Tables and files that stages of one job share.

Everything goes below the folder the cluster names in ``spark.checkpoint.dir``,
which the driver and all executors reach. Only a plain ``local[...]`` session
without that setting (a test) gets a temporary folder of its own.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from lakegraph.session import is_single_machine

KEY = "spark.checkpoint.dir"


def workspace(spark: SparkSession, name: str) -> str:
    """URI of a fresh folder for one job (not created yet)."""
    base = spark.conf.get(KEY, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not is_single_machine(spark.sparkContext.master):
            raise RuntimeError(f"set {KEY} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-work-")
        spark.conf.set(KEY, base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again, so
    later stages (and a lost executor) restart from the table."""
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores in front until no taken one equals it
    (names differ by more than case)."""
    used = {x.lower() for x in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """pyarrow file system and path of a URI or an absolute path."""
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def task_file(folder: str, suffix: str) -> str:
    """A file name that no other task and no other attempt of it uses; readers
    learn names only from the rows of attempts that succeeded. A task that
    writes several files tells them apart by suffix."""
    ctx = TaskContext.get()
    return f"{folder}/{ctx.stageId():05d}-{ctx.partitionId():06d}-{ctx.taskAttemptId():010d}{suffix}"


def open_output(uri: str) -> pa.NativeFile:
    files, path = filesystem(uri)
    files.create_dir(path.rpartition("/")[0], recursive=True)
    return files.open_output_stream(path, compression=None)


def open_input(uri: str) -> pa.NativeFile:
    """Random-access file; memory-mapped where the shared folder is mounted."""
    files, path = filesystem(uri)
    if isinstance(files, fs.LocalFileSystem):
        return pa.memory_map(path)
    return files.open_input_file(path)


@lru_cache(maxsize=1)
def _libc():
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:                                     # another C library
        return None


def release() -> None:
    """Give memory that a large group has freed back to the system, so that
    idle Python workers stay small beside the executor's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _libc() is not None:
        _libc().malloc_trim(0)
