"""Helpers shared by the corpus operators: shared storage, Arrow slicing, vectorised hashing."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import root

#: Bytes of text that one vectorised step handles; bounds a worker's memory.
SLICE_BYTES = 1 << 20


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that driver and executors share."""
    return f"{root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Deletes the files of a frame from ``stored`` that nothing reads any more."""
    jvm = df.sparkSession._jvm
    for path in {os.path.dirname(f) for f in df.inputFiles()}:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def free(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of frames that are no longer referenced."""
    gc.collect()
    spark._jvm.System.gc()


def small_batches(spark: SparkSession, records: int = 1000) -> None:
    """Rows of texts and packed sets are large: Arrow batches of at most ``records`` rows bound what a worker and its executor hold."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > records:
        spark.conf.set(key, str(records))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def as_text(column) -> F.Column:
    return F.col(column).cast("string")


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cuts a batch into runs of rows of about ``limit`` bytes of ``column`` (at least a row each).

    Yields the rows, the column's UTF-8 bytes as uint8 and the rows' offsets
    into them (one more than rows).  Nulls count as empty.
    """
    i = batch.schema.get_field_index(column)
    arr = batch.column(i)
    if not pa.types.is_binary(arr.type) and not pa.types.is_string(arr.type):
        arr = arr.cast(pa.string())
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) else b"")
    n = len(arr)
    offs = np.frombuffer(arr.buffers()[1], np.int32, n + 1, arr.offset * 4).astype(np.int64) if n else np.zeros(1, np.int64)
    data = np.frombuffer(arr.buffers()[2], np.uint8) if n and arr.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at), data[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


# --- 64-bit hashing of many byte ranges at once -----------------------------------------------

#: Polynomials modulo this prime, with two bases and two values for each byte: arithmetic modulo 2^64 has collisions that can be written down.
_PRIME = np.uint64((1 << 31) - 1)
_BASES = (1_181_783_497, 1_742_537_263)
_POW: list[tuple[np.ndarray, np.ndarray]] = []


def _reduced(x: np.ndarray) -> np.ndarray:
    """``x`` modulo the prime."""
    for _ in range(3):
        x = (x & _PRIME) + (x >> np.uint64(31))
    return np.minimum(x, x - _PRIME)  # below nought it wraps to a large number


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit avalanche hash (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _reduced(mix(np.arange(1, 513, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))).reshape(2, 256)


def _table(base: int, n: int) -> np.ndarray:
    """Powers of ``base``, each half from the one before it."""
    p = np.ones(n, np.uint64)
    k = 1
    while k < n:
        p[k : 2 * k] = _reduced(p[: min(k, n - k)] * np.uint64(pow(base, k, int(_PRIME))))
        k *= 2
    return p.astype(np.uint32)


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each base its powers and their inverses."""
    if not _POW or len(_POW[0][0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _POW[:] = [(_table(base, size), _table(pow(base, -1, int(_PRIME)), size)) for base in _BASES]
    return _POW


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Running sums from which ``range_hash`` gets the hash of any range of ``buf``."""
    out = np.zeros((2, len(buf) + 1), np.uint64)
    for lane, (up, _) in enumerate(_powers(len(buf) + 1)):
        x = _BYTE[lane][buf] * up[: len(buf)]
        np.cumsum((x & _PRIME) + (x >> np.uint64(31)), out=out[lane, 1:])  # each below 2^32, so sums of 2^31 fit
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range [start, end): a function of its bytes and length alone."""
    lanes = [_reduced(_reduced(prefix[lane][end] - prefix[lane][start]) * down[start]) for lane, (_, down) in enumerate(_powers(prefix.shape[1]))]
    return mix((lanes[0] << np.uint64(31) | lanes[1]) + (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def span_marks(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each range its first and last eight bytes as numbers, and a hash of them, its length and sixteen bytes within: a few reads a range.

    Ranges of up to 16 bytes are equal if first, last bytes and length are; of
    longer ones only bytes tell.
    """
    long = ends - starts
    wide = np.concatenate([np.zeros(8, np.uint8), buf, np.zeros(8, np.uint8)])
    word = np.ndarray(len(buf) + 9, "<u8", wide, strides=(1,))
    short = (8 * np.maximum(8 - long, 0)).astype(np.uint64)
    head, tail = word[starts + 8] << short, word[ends] >> short << short
    h = mix(head ^ long.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)) * np.uint64(0x9FB21C651E98DF25) + tail
    more = np.flatnonzero(long > 16)
    for k in (1, 2):
        h[more] = mix(h[more]) * np.uint64(0x9FB21C651E98DF25) + word[starts[more] + 8 + (long[more] - 8) * k // 3]
    return head, tail, mix(h)


#: A-Z to a-z; digits, a-z and every byte of a non-ASCII character stay; all else is a space.
WORD_TABLE = np.array([c if chr(c).isdigit() and c < 128 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)], np.uint8)


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words of each row: mapped bytes, words' starts and ends, first word of each row (one more than rows)."""
    low = WORD_TABLE[buf]
    inside = low != 32
    if not len(low):
        z = np.zeros(0, np.int64)
        return low, z, z, np.zeros(len(offs), np.int64)
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    edge = offs[1:-1]
    cut = edge[(edge > 0) & (edge < len(low))]
    begin[cut] |= inside[cut]
    stop[cut - 1] |= inside[cut - 1]
    starts = np.flatnonzero(begin)
    return low, starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, offs)


def combine(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every run of ``k`` consecutive values of ``h`` (order counts)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9FB21C651E98DF25) + h[j : j + n]
    return mix(out)
