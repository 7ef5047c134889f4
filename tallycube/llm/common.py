"""Helpers shared by the text operators: reading, scratch tables, bytes of a text column."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Hashable, Iterable, Iterator, Sequence
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tallycube.session import scratch_path

# Rows and bytes handed to Python at once, so that a batch of long texts stays small.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": "8388608"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the batch limits of the operators that work on whole texts in Python, and let workers find this package.

    On a cluster the package is installed or shipped; the path serves where driver and workers share a disk.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))
    for key, value in BATCH.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: the lineage ends there, and lost executors cost nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns that have the name of an output column, in either case."""
    taken = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in taken])


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def shielded(documents: DataFrame, outputs: Sequence[str], named: Sequence[str], operator: Callable[..., DataFrame]) -> DataFrame:
    """What `operator` gives for the documents, whatever their other columns are called.

    The operator sees the columns as c0, c1, ..., and after the table the names of the columns `named`; so no column of
    the caller's can meet one of its own. It keeps those columns and adds `outputs`. Columns of the caller's with the name
    of an output, in either case, are left out, unless they are among those named.
    """
    columns = documents.columns
    plain = documents.select(*[quoted(c).alias(f"c{k}") for k, c in enumerate(columns)])

    def place(name: str) -> int:
        return columns.index(name) if name in columns else [c.lower() for c in columns].index(name.lower())

    at = [place(n) for n in named]
    taken = {o.lower() for o in outputs}
    kept = [(k, c) for k, c in enumerate(columns) if k in at and c not in outputs or c.lower() not in taken]
    return operator(plain, *[f"c{k}" for k in at]).select(*[F.col(f"c{k}").alias(c) for k, c in kept], *outputs)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def slices(column: pa.Array, limit: int = 1_000_000) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in runs of about `limit` bytes with the place of the first, so that arrays over bytes stay small."""
    texts = texts_of(column)
    first = size = 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > limit:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, texts[first:]


_held: dict[Hashable, object] = {}


def held(key: Hashable, make: Callable[[], object]) -> object:
    """What a worker process keeps until a task lets go of it, such as words with their ids: a tidy task when it ends, others
    when they begin and are of another kind."""
    if key not in _held:
        _held[key] = make()
    return _held[key]


def release(keep: Hashable = None) -> None:
    """Let go of what is held under other keys than `keep`, and give memory that was used and left back to the system."""
    for key in [k for k in _held if k != keep]:
        del _held[key]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def fresh(batches: Iterator, keep: Hashable = None) -> Iterator:
    """The batches of a task; before the first, what is held under other keys than `keep` and the memory that earlier
    tasks of the worker have used and left go back to the system, as workers live on from stage to stage beside an
    executor that has its own needs."""
    release(keep)
    yield from batches


def tidy(task: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A task's function that holds nothing and gives back its memory when it ends: Spark hands tasks to the workers in turn,
    so each of them, also those that a stage with several functions in a row has started, waits with what its last task left."""

    @wraps(task)
    def whole(*args, **named):
        try:
            yield from task(*args, **named)
        finally:
            release()

    return whole


def bit_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """A filter of fixed size for the 64-bit numbers of a one-column table: one bit for each value of their leading
    `bits` bits, set where a number has it. At most 2^bits bits come to the driver, whatever the size of the table."""
    name = hashes.columns[0]
    bucket = F.shiftrightunsigned(quoted(name), 64 - bits)
    one = F.lit(1).cast("long")
    words = (
        hashes.select(bucket.alias("bucket"))
        .groupBy(F.shiftright("bucket", 6).alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", one, F.pmod("bucket", F.lit(64)).cast("int"))).alias("set"))
    )
    packed = np.zeros(1 << (bits - 6), np.int64)
    for batch in words.toArrow().to_batches():
        packed[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return packed.view(np.uint64)


def passes(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of some unsigned 64-bit numbers may be in the table of a bit filter."""
    bits = int(len(filter_)).bit_length() - 1 + 6
    bucket = hashes >> np.uint64(64 - bits)
    return (filter_[(bucket >> np.uint64(6)).astype(np.int64)] >> (bucket & np.uint64(63))) & np.uint64(1) == 1


def grown(a: np.ndarray, n: int) -> np.ndarray:
    """An array with room for n entries, twice as long if it has to grow."""
    return a if len(a) >= n else np.concatenate([a, np.zeros((max(n, 2 * len(a)) - len(a), *a.shape[1:]), a.dtype)])


def ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one behind the other."""
    ends = np.cumsum(n)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - n), n)
