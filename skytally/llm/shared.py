"""Helpers shared by the text operators: byte buffers, hashes, written tables.

Texts reach the Python tasks as Arrow batches.  ``slices`` cuts a batch into
pieces of a few megabytes (a longer single text is one piece), so that the
numpy temporaries of a task stay bounded whatever the batch holds.

Hashes are 64-bit polynomial hashes of byte strings, taken for all words or
positions of a piece at once from prefix sums: with ``P[i] = sum(b_j * M**j)``
the string ``[s, e)`` hashes to ``(P[e] - P[s]) * M**-s``.
"""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

SLICE_BYTES = 1 << 20
MULT = 0x9E3779B97F4A7C55 | 1
MASK = (1 << 64) - 1
MULT_INV = pow(MULT, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}

#: Bytes that part words: space and \t \n \v \f \r.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def trim() -> None:
    """Give freed memory back to the system, so that a worker holds no more than its present task needs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per context.

    The archive is read by the driver alone; Spark hands it to the executors.
    """
    sc = spark.sparkContext
    if spark.conf.get(ROWS_PER_BATCH) == "10000":  # Spark's default; whole texts make batches of that many rows large
        spark.conf.set(ROWS_PER_BATCH, "1000")
    if getattr(sc, "_skytally_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="skytally-"), "skytally_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._skytally_shipped = True


#: Lets Spark remove the shuffle files of a finished query at once.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that end in this block are removed with them: nothing may read them again."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before) if before is not None else spark.conf.unset(FREE_SHUFFLES)


def written_by(df: DataFrame, label: str, column: str | None = None) -> tuple[DataFrame, str]:
    """Write to the shared checkpoint folder, parted by a column if one is given; the table read back, and its folder.

    The shuffle files behind it are removed with the end of the write: nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    with freed_shuffles(spark):
        df.write.partitionBy(*([column] if column else [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, label: str, free: bool = False) -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts the lineage.

    ``free`` removes the shuffle files behind it with the end of the write, where nothing reads them again.
    """
    if free:
        return written_by(df, label)[0]
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``written_by`` made and nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let the driver drop plans that are done, so that Spark removes their shuffle files now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket(col: str = "doc_id"):
    """crc32 of the id as text; null ids count as the text 'null'."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("null")).cast("binary"))


# -- byte buffers ---------------------------------------------------------------

def to_bytes(array) -> pa.Array:
    """A text or binary column as one large_binary array; null becomes empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if pa.types.is_null(array.type):
        return pa.array([b""] * len(array), pa.large_binary())
    return pc.fill_null(array.cast(pa.large_binary()), b"")


def buffer_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a large_binary array."""
    _, offs, data = array.buffers()
    o = np.frombuffer(offs, np.int64)[array.offset:array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    if data is None or o[-1] == o[0]:
        return np.zeros(0, np.uint8), o - o[0]
    return np.frombuffer(data, np.uint8)[o[0]:o[-1]], o - o[0]


def slices(batch: pa.RecordBatch, column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Consecutive pieces of a batch, each with its texts as large_binary."""
    texts = to_bytes(batch.column(column))
    n = len(texts)
    if not n:
        return
    o = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    at = 0
    while at < n:
        to = int(np.searchsorted(o, o[at] + limit, "right")) - 1
        to = min(n, max(at + 1, to))
        yield batch.slice(at, to - at), texts.slice(at, to - at)
        at = to


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """MULT**i and MULT**-i for i < n, modulo 2**64."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 4096)
        for name, m in (("up", MULT), ("down", MULT_INV)):
            p = np.full(size, np.uint64(m))
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    up, _ = powers(len(buf))
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up, out=out[1:])
    return out


def hash_spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte strings [start, end) of the buffer behind ``sums``."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def word_spans(buf: np.ndarray, offs: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word; ``in_word`` marks its bytes (256 flags)."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, z
    m = in_word[buf]
    edge = np.empty(len(m) + 1, bool)
    edge[0], edge[-1] = m[0], m[-1]
    np.not_equal(m[1:], m[:-1], out=edge[1:-1])
    inner = offs[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < len(m))])
    joined = inner[m[inner] & m[inner - 1]]  # a word may not go on in the next text
    at = np.flatnonzero(edge)
    if len(joined):
        at = np.sort(np.concatenate([at, joined, joined]))
    start, end = at[0::2], at[1::2]
    return start, end, np.searchsorted(offs, start, "right") - 1


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mix(a * np.uint64(0x9DDFEA08EB382D69) + b + np.uint64(0x165667B19E3779F9))


def local_path(name: str) -> str:
    """Where a file given to ``SparkContext.addFile`` lies on this machine."""
    return SparkFiles.get(name)
