"""Packing along a space-filling curve: neighbours in content share sequences.

Each document's hashed word vector is projected to a few dimensions by signs
drawn from the words' hashes; only its direction counts, so that a text's
length doesn't.  The Hilbert index of the direction is the sort key.  Documents
are dealt along the curve to partitions of equal bytes, and the stream of their
ids is cut every ``length`` ids, so that no sequence but those of the tail is
short, and the tail is cut into powers of two, which need no padding.

Null texts are empty: their end id alone.  A cell of the curve that holds more
than a partition's share, such as a group of copies, is dealt by a hash of
doc_id and text over several.  Null doc_ids and repeated rows are kept; a very
long text is one row of one partition.  Extra columns are ignored, whatever
their names; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, mix, shuffle_partitions, small_batches, span_marks, stored, text_slices, words
from .tokens import encoder

DIMS, BITS = 6, 8
#: The curve's cells whose bytes are counted to deal out partitions: so many leading bits, hence at most 65,536 numbers on the driver.
CELL_BITS = 16
#: Bytes that a document counts besides its text.
ROW_BYTES = 64


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of each row of ``cells`` (rows x dims, each below 2**bits)."""
    x = [c.astype(np.uint64) for c in cells.T]
    one, dims = np.uint64(1), len(x)
    for level in range(bits - 1, 0, -1):  # undo the rotations, highest bit first
        q = np.uint64(1 << level)
        low = q - one
        for i in range(dims):
            up = (x[i] & q) != 0
            swap = np.where(up, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0]) ^ swap
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, dims):
        x[i] = x[i] ^ x[i - 1]
    t = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        q = np.uint64(1 << level)
        t = np.where((x[-1] & q) != 0, t ^ (q - one), t)
    x = [c ^ t for c in x]
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for c in x:
            key = key << one | c >> np.uint64(level) & one
    return key.astype(np.int64)


def curve_keys(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Hilbert keys of the rows of a slice: the direction of the sum of the words' signs, cut into cells."""
    low, starts, ends, first = words(buf, offs)
    h = span_marks(low, starts, ends)[2]  # long words may share it: it only picks a direction
    total = np.empty((len(offs) - 1, DIMS))
    for d in range(DIMS):
        sums = np.concatenate([[0], np.cumsum((h >> np.uint64(d) & np.uint64(1)).astype(np.int64) * 2 - 1)])
        total[:, d] = sums[first[1:]] - sums[first[:-1]]
    size = np.maximum(np.sqrt((total**2).sum(axis=1, keepdims=True)), 1e-9)
    return hilbert_index(((total / size + 1) / 2 * ((1 << BITS) - 1)).astype(np.int64), BITS)


def tail_cuts(total: int, length: int) -> list[tuple[int, int]]:
    """(start, size) of the last, partial stretch, as falling powers of two."""
    at, out = total - total % length, []
    while at < total:
        size = 1 << (total - at).bit_length() - 1
        out.append((at, size))
        at += size
    return out


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 1, length: int = 2048) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded (the sequence's size with padding)."""
    spark = docs.sparkSession
    small_batches(spark)

    shift, n_parts = DIMS * BITS - CELL_BITS, shuffle_partitions(spark)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_text("text").alias("text"))

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            for _, buf, offs in text_slices(batch, "text"):
                np.add.at(total, curve_keys(buf, offs) >> shift, np.diff(offs) + ROW_BYTES)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "bytes"])

    # the curve's cells by bytes; each partition takes an equal stretch of them
    weight = np.zeros(1 << CELL_BITS, np.int64)
    for r in slim.mapInArrow(weighed, "cell long, bytes long").groupBy("cell").agg(F.sum("bytes").alias("bytes")).collect():
        weight[r["cell"]] = r["bytes"]
    before = np.cumsum(weight) - weight
    share = max(1.0, float(weight.sum()) / n_parts)
    salts = _salts(spark, n_parts)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, buf, offs in text_slices(batch, "text"):
                key = curve_keys(buf, offs)
                h = span_marks(buf, offs[:-1], offs[1:])[2] ^ mix(rows.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
                place = mix(h).astype(np.float64) * 2.0**-64
                part = np.minimum(((before[key >> shift] + place * weight[key >> shift]) / share).astype(np.int64), n_parts - 1)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(key), pa.array(part), pa.array(salts[part])], names=["doc_id", "text", "curve", "part", "salt"])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, last, at = encoder(tokenizer), None, 0
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                ids = [x.tobytes() + end for x in enc.encode(some.column(1).to_pylist())]
                n, start = [len(x) // enc.width for x in ids], []
                for part, size in zip(some.column(2).to_pylist(), n):
                    last, at = part, at if part == last else 0
                    start.append(at)
                    at += size
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(2), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "part", "before", "n", "ids"])

    dealt = slim.mapInArrow(keyed, "doc_id long, text string, curve long, part long, salt long").repartition(n_parts, "salt")
    sorted_ = dealt.sortWithinPartitions("part", "curve", "doc_id", F.xxhash64("text"), "text").select("doc_id", "text", "part")
    # the only other thing that comes to the driver is a number for each partition
    ids = stored(sorted_.mapInArrow(encoded, "doc_id long, part long, before long, n long, ids binary"), "packed")
    base, total = {}, 0
    for r in ids.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        base[r["part"]], total = total, total + r["n"]
    tail = tail_cuts(total, length)
    full = total // length

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = encoder_width(tokenizer)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                some = batch.slice(i, 512)
                out = []
                for d, part, before, n, data in zip(*(c.to_pylist() for c in some.columns)):
                    x, at = np.frombuffer(data, f"<u{width}").astype("<u4"), base[part] + before
                    done = 0
                    while done < n:
                        g = at + done
                        if g // length < full:
                            seq, first, size = g // length, g - g % length, length
                        else:
                            k = next(k for k, (s, z) in enumerate(tail) if g < s + z)
                            seq, (first, size) = full + k, tail[k]
                        take = min(n - done, first + size - g)
                        out.append((d, done, take, zlib.crc32(x[done : done + take].tobytes()), n, seq, g - first, size))
                        done += take
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded"])

    return ids.mapInArrow(pieces, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded long")


def _salts(spark, n: int) -> np.ndarray:
    """For each partition a number whose hash deals it there, so that no two stretches share one."""
    tries = spark.range(64 * n + 64).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("p")).groupBy("p").agg(F.min("id").alias("id"))
    out = np.arange(n, dtype=np.int64)
    for r in tries.collect():
        out[r["p"]] = r["id"]
    return out


def encoder_width(tokenizer: str) -> int:
    return encoder(tokenizer).width
