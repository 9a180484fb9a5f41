"""Files in a store that all executors share, opened inside tasks, and folders for what jobs write."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote, urlparse

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

#: What Arrow calls the schemes that Hadoop has names of its own for.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


@contextmanager
def open_file(path: str, mode: str = "r") -> Iterator:
    """A binary file, as a stream to write or, with seek, to read."""
    kind = urlparse(path).scheme
    if kind in ("", "file"):
        fs, name = pafs.LocalFileSystem(), unquote(urlparse(path).path) if kind else path
    else:
        fs, name = pafs.FileSystem.from_uri(ARROW_SCHEMES.get(kind, kind) + path[len(kind) :])
    with fs.open_output_stream(name, compression=None) if mode == "w" else fs.open_input_file(name) as stream:
        yield stream


def make_folder(path: str) -> None:
    """The folder and those above it, where the store has folders."""
    kind = urlparse(path).scheme
    if kind in ("", "file"):
        fs, name = pafs.LocalFileSystem(), unquote(urlparse(path).path) if kind else path
    else:
        fs, name = pafs.FileSystem.from_uri(ARROW_SCHEMES.get(kind, kind) + path[len(kind) :])
    fs.create_dir(name, recursive=True)


def new_folder(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; where that is unset, a temporary one in local mode, else an error.
    Deleted when Python ends. Its name has a scheme."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="arkspark-")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}")
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # With its scheme, so that tasks that open files by themselves find the store that Spark means.
    where = store.makeQualified(path)
    store.mkdirs(where)

    @atexit.register
    def clear():
        with contextlib.suppress(Exception):
            store.delete(where, True)

    return where.toString()


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in a new folder, so that it is worked out once, however often it is read."""
    folder = new_folder(df.sparkSession, label)
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
