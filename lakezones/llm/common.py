"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir, scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; ``sf_dir`` may be any path that Spark's readers open."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SCOPES = threading.local()


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are deleted at the end, but for those stored with ``keep``.

    Kept ones belong to the scope around, if there is one.  What leaves a scope must read kept tables only.
    """
    stack = _SCOPES.__dict__.setdefault("stack", [])
    stack.append([])
    try:
        yield
    finally:
        for path, keep in stack.pop():
            if not keep:
                where = spark._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
            elif stack:
                stack[-1].append((path, False))


def scratch_path(spark: SparkSession, label: str, keep: bool = False) -> str:
    """A new place in the shared folder, deleted with the scope unless kept."""
    ensure_checkpoint_dir(spark)
    path = scratch_dir(spark, label)
    stack = _SCOPES.__dict__.get("stack")
    if stack:
        stack[-1].append((path, keep))
    return path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of every query inside when it ends, as nothing reads them again."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows go to Python in batches of a few MB, as the JVM and the worker both hold a whole one; Spark's default is 64 MB."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def stored(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage with a table that survives a lost executor and is seen by all.
    """
    path = scratch_path(df.sparkSession, label, keep)
    with shuffles_removed(df.sparkSession), small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_CACHES: dict[str, dict] = {}  # what a worker keeps between tasks, by the module that keeps it


def kept_by_worker(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, or until a ``frugal`` task that does not use it."""
    return _CACHES.setdefault(name, {})


def drop_caches(uses: str) -> None:
    for name, cache in _CACHES.items():
        if name != uses:
            cache.clear()


def give_back() -> None:
    """Return freed memory to the system: a worker serves the tasks of all stages in turn."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
           uses: str = "") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` as a good neighbour: caches other than the one it ``uses`` go before it begins, and what it freed is given back after."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches(uses)
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of whole rows of about ``max_bytes`` of text each."""
    col = batch.column(batch.schema.get_field_index(column))
    sizes = pc.binary_length(col).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes):
        n = 0 if n != n else int(n)  # NaN: null text
        if i > start and total + n > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if batch.num_rows > start:
        yield batch.slice(start)


def filter_rows(docs: DataFrame, keep: Callable[[pa.RecordBatch], list[bool]], max_bytes: int) -> DataFrame:
    """Whole rows that ``keep`` accepts, judged a few MB of ``text`` at a time; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", max_bytes):
                yield part.filter(pa.array(keep(part), pa.bool_()))

    return docs.mapInArrow(frugal(run), docs.schema)
