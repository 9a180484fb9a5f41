"""Shared helpers of the training-data operators: scratch tables, words and hashing."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``. Where that is unset: a temporary one in local mode, else an error,
    as executors on other machines wouldn't see it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="arkspark-")
        spark.sparkContext.setCheckpointDir(root)
    # With its scheme, so that tasks that open files by themselves find the store that Spark means.
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString().rstrip("/")


class Scratch:
    """Tables that one call writes into a folder of its own under the shared one: later jobs survive lost executors.

    The call deletes what its result doesn't read; the rest stays until ``clear``, the end of a ``collected`` block or, at the latest,
    that of Python. Calls don't touch each other's tables.
    """

    _folders: dict[str, SparkSession] = {}
    _made: list[list[Scratch]] = []

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{scratch_root(spark)}/arkspark-{uuid.uuid4().hex}"
        self.names: list[str] = []
        self._folders[self.folder] = spark
        for made in self._made:
            made.append(self)

    @classmethod
    @contextlib.contextmanager
    def collected(cls) -> Iterator[list[Scratch]]:
        """All that is made inside is cleared at the end, results too: write or count what you want of them inside."""
        made: list[Scratch] = []
        cls._made.append(made)
        try:
            yield made
        finally:
            cls._made.remove(made)
            for scratch in made:
                scratch.clear()

    def path(self, label: str) -> str:
        self.names.append(f"{len(self.names)}-{label}")
        return f"{self.folder}/{self.names[-1]}"

    def write(self, df: DataFrame, label: str) -> DataFrame:
        """``df`` as Parquet, read back."""
        path = self.path(label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _delete(self, path: str) -> None:
        _delete(self.spark, path)

    def _read_by(self, frames: tuple[DataFrame, ...]) -> set[str]:
        inside = self.folder.rpartition("/")[2] + "/"
        return {p.rpartition(inside)[2].partition("/")[0] for df in frames for p in df.inputFiles() if inside in p}

    def drop(self, *frames: DataFrame) -> None:
        """Delete the tables of this call that ``frames`` read."""
        for name in self._read_by(frames):
            self._delete(f"{self.folder}/{name}")

    def keep_only(self, *frames: DataFrame) -> None:
        """Delete all tables of this call but those that ``frames`` read."""
        for name in set(self.names) - self._read_by(frames):
            self._delete(f"{self.folder}/{name}")

    def clear(self) -> None:
        self._delete(self.folder)
        self._folders.pop(self.folder, None)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _clear_all() -> None:
    for folder, spark in Scratch._folders.items():
        with contextlib.suppress(Exception):
            _delete(spark, folder)


class WordIds(dict):
    """64-bit word hashes, remembered per task; cleared when it holds ``limit`` words."""

    limit = 1 << 19

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def multipliers(k: int) -> np.ndarray:
    return mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def windows(ids: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-word windows, in order; none if there are fewer words."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    c = multipliers(k)
    h = ids[:n] * c[0]
    for j in range(1, k):
        h += ids[j : n + j] * c[j]
    return mix(h)


def texts(batches: Iterator[pa.RecordBatch], column: str, rows: int = 512) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices of the batches with one column as UTF-8 bytes."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, part.column(column).cast(pa.binary()).to_pylist()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, **casts: str) -> DataFrame:
    """The named columns alone, cast; columns with other names can't clash with those an operator adds."""
    return df.select(*(F.col(f"`{name}`").cast(kind).alias(name) for name, kind in casts.items()))
