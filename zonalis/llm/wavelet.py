"""Token-ID output: one wavelet matrix per shard, in one compressed file.

A shard's file holds the ids of consecutive documents as bit-planes (a wavelet
matrix).  Each plane is compressed in blocks, and a directory holds where each
block begins and how many ones stand before it: ``access(i)``, ``rank(id, i)``
(how often an id stands before i), ``count(id)`` and ``select(id, k)`` (where
the k-th stands) decompress a block or two of each plane; ``decode()`` gives
all ids.

Nulls and empty texts are documents of the end id alone.  Null doc_ids come
first; rows that share a doc_id stand side by side in the order of their text,
each a document of its own.  A document is never cut, so a very long one makes
one shard of about two bytes an id: below the 2 GB of a cell, as its text is.
Extra columns are ignored, whatever their names.  An empty table writes no
shard and gives no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, shared_dir, shuffle_partitions, small_batches
from .tokens import encoder

_MAGIC = b"ZWM2"
#: Bytes of a plane's block, and its bits.
BLOCK = 4096
_BITS = BLOCK * 8


class WaveletMatrix:
    """Planes from the highest bit down; ``zeros[l]``: how many zeros plane l has, which the next plane has first.

    ``blocks[l]``: the plane's blocks, as bits or, from a file, compressed
    until they are asked for; ``ones[l]``: ones before each block, and in all.
    """

    def __init__(self, n: int, blocks: list[list], ones: list[np.ndarray], zeros: list[int], doc_ids: np.ndarray, sizes: np.ndarray, null_docs: np.ndarray):
        self.n, self.blocks, self.ones, self.zeros = n, blocks, ones, zeros
        self.doc_ids, self.sizes, self.null_docs = doc_ids, sizes, null_docs

    @classmethod
    def build(cls, ids: np.ndarray, doc_ids: list[int | None], sizes: list[int]) -> WaveletMatrix:
        x = ids.astype(np.uint32) if ids.dtype.itemsize > 2 else ids.astype(np.uint16)
        depth = max(1, int(x.max()).bit_length()) if len(x) else 1
        blocks, ones, zeros = [], [], []
        for level in range(depth - 1, -1, -1):
            bit = (x >> level & 1).astype(bool)
            plane = np.packbits(bit, bitorder="little")
            blocks.append([plane[i : i + BLOCK] for i in range(0, len(plane), BLOCK)])
            ones.append(np.concatenate([[0], np.cumsum([int(np.bitwise_count(b).sum()) for b in blocks[-1]])]).astype(np.int64))
            low = x[~bit]
            zeros.append(len(low))
            x = np.concatenate([low, x[bit]])
        null = np.array([d is None for d in doc_ids], bool)
        return cls(len(ids), blocks, ones, zeros, np.array([d or 0 for d in doc_ids], np.int64), np.array(sizes, np.int64), null)

    def to_bytes(self) -> bytes:
        """Head (id count, documents, planes, sizes of three lists, zeros), directory (ones and byte lengths of the blocks), lists, blocks."""
        press = zstandard.ZstdCompressor(level=3).compress
        lists = [press(p.tobytes()) for p in (self.doc_ids, self.sizes, self.null_docs)]
        packed = [[press(bytes(self._block(level, k))) for k in range(len(self.blocks[level]))] for level in range(len(self.blocks))]
        head = struct.pack(f"<4sQQI3Q{len(self.zeros)}Q", _MAGIC, self.n, len(self.doc_ids), len(self.blocks), *map(len, lists), *self.zeros)
        directory = b"".join(o.astype("<u4" if self.n < 1 << 32 else "<u8").tobytes() + np.array([len(x) for x in p], "<u4").tobytes() for o, p in zip(self.ones, packed))
        return b"".join([head, directory, *lists, *(x for p in packed for x in p)])

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        """Reads the head and the directory; blocks stay compressed."""
        magic, n, docs, depth, *lists = struct.unpack_from("<4sQQI3Q", data)
        if magic != _MAGIC:
            raise ValueError("not a wavelet-matrix file")
        at = struct.calcsize("<4sQQI3Q")
        zeros = list(struct.unpack_from(f"<{depth}Q", data, at))
        at += 8 * depth
        count, kind = -(-n // _BITS), np.dtype("<u4" if n < 1 << 32 else "<u8")
        ones, lengths = [], []
        for _ in range(depth):
            ones.append(np.frombuffer(data, kind, count + 1, at).astype(np.int64))
            at += kind.itemsize * (count + 1)
            lengths.append(np.frombuffer(data, "<u4", count, at))
            at += 4 * count
        view, parts, blocks = memoryview(data), [], []
        for size in lists:
            parts.append(zstandard.ZstdDecompressor().decompress(view[at : at + size]))
            at += size
        for sizes in lengths:
            stop = at + np.cumsum(sizes.astype(np.int64))
            blocks.append([view[b - s : b] for b, s in zip(stop.tolist(), sizes.tolist())])
            at = int(stop[-1]) if count else at
        return cls(n, blocks, ones, zeros, np.frombuffer(parts[0], np.int64), np.frombuffer(parts[1], np.int64), np.frombuffer(parts[2], bool))

    # rank and select of one plane

    def _block(self, level: int, k: int) -> np.ndarray:
        got = self.blocks[level][k]
        if isinstance(got, memoryview):
            got = self.blocks[level][k] = np.frombuffer(zstandard.ZstdDecompressor().decompress(got), np.uint8)
        return got

    def _bit(self, level: int, i: int) -> int:
        return int(self._block(level, i // _BITS)[i % _BITS >> 3]) >> (i & 7) & 1

    def _rank1(self, level: int, i: int) -> int:
        """Ones before i."""
        k, rest = divmod(i, _BITS)
        n = int(self.ones[level][k])
        if rest:
            part = self._block(level, k)
            n += int(np.bitwise_count(part[: rest >> 3]).sum())
            if rest & 7:
                n += (int(part[rest >> 3]) & (1 << (rest & 7)) - 1).bit_count()
        return n

    def _select(self, level: int, bit: int, k: int) -> int:
        """Where the k-th (from 0) such bit stands."""
        ones = self.ones[level]
        before = ones if bit else np.minimum(np.arange(len(ones)) * _BITS, self.n) - ones
        block = int(np.searchsorted(before, k, "right")) - 1
        bits = np.unpackbits(self._block(level, block), bitorder="little")
        return block * _BITS + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    # the sequence

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit, one = self._bit(level, i), self._rank1(level, i)
            value = value << 1 | bit
            i = zeros + one if bit else i - one
        return value

    def _span(self, token: int, i: int) -> tuple[int, int]:
        """Where ``token``'s stretch of the last plane begins, and where its copies before i end."""
        depth, lo = len(self.blocks), 0
        if token >> depth:
            return 0, 0
        for level, zeros in enumerate(self.zeros):
            one_lo, one_i = self._rank1(level, lo), self._rank1(level, i)
            lo, i = (zeros + one_lo, zeros + one_i) if token >> depth - 1 - level & 1 else (lo - one_lo, i - one_i)
        return lo, i

    def rank(self, token: int, i: int) -> int:
        lo, hi = self._span(token, i)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        lo, hi = self._span(token, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for level in range(len(self.blocks) - 1, -1, -1):
            bit = token >> len(self.blocks) - 1 - level & 1
            i = self._select(level, bit, i - self.zeros[level] if bit else i)
        return i

    def decode(self) -> np.ndarray:
        """All ids, from the last plane back to the first."""
        x = np.zeros(self.n, np.uint16 if len(self.blocks) <= 16 else np.uint32)
        for level in range(len(self.blocks) - 1, -1, -1):
            plane = np.concatenate([self._block(level, k) for k in range(len(self.blocks[level]))]) if self.n else np.zeros(0, np.uint8)
            bit = np.unpackbits(plane, count=self.n, bitorder="little").astype(bool)
            up = np.empty_like(x)
            up[~bit] = x[: self.zeros[level]]
            up[bit] = x[self.zeros[level] :] | x.dtype.type(1 << len(self.blocks) - 1 - level)
            x = up
        return x

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Each document's id, start within the shard, and ids."""
        ids, at = self.decode(), 0
        for d, size, null in zip(self.doc_ids.tolist(), self.sizes.tolist(), self.null_docs.tolist()):
            yield None if null else d, at, ids[at : at + size]
            at += size


def write_shards(docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 1, shard_tokens: int = 1 << 20) -> DataFrame:
    """Writes the ids of ``docs`` (doc_id, text) in ascending doc_id order to ``path``; returns the shards as read from it.

    A row is one shard's file: ``part`` and ``shard`` order the shards,
    ``start`` counts its part's ids before it.  A shard closes after the
    document that brings it to ``shard_tokens``.  The texts are dealt out by
    ranges of doc_id and text, before they are encoded: sampling the ranges
    costs no encoding, and a doc_id with many rows is split.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], enc.dtype)
        held: list[np.ndarray] = []
        ids: list[int | None] = []
        sizes: list[int] = []
        total = done = number = 0

        def flush():
            nonlocal held, ids, sizes, total, done, number
            data = WaveletMatrix.build(np.concatenate(held), ids, sizes).to_bytes()
            row = pa.RecordBatch.from_pydict({"part": [part], "shard": [number], "start": [done], "n_docs": [len(ids)], "n_tokens": [total], "file": [data]}, schema=schema)
            held, ids, sizes, done, total, number = [], [], [], done + total, 0, number + 1
            return row

        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                for d, x in zip(some.column(0).to_pylist(), enc.encode(some.column(1).to_pylist())):
                    held += [x, end]
                    ids.append(d)
                    sizes.append(len(x) + 1)
                    total += len(x) + 1
                    if total >= shard_tokens:
                        yield flush()
        if ids:
            yield flush()

    schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("start", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("file", pa.binary())])
    spark = docs.sparkSession
    small_batches(spark)
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_text("text").alias("text"))
    dealt = dealt.repartitionByRange(shuffle_partitions(spark), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    out = dealt.mapInArrow(shards, "part int, shard int, start long, n_docs long, n_tokens long, file binary")
    out.write.option("compression", "uncompressed").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def read_shards(shards: DataFrame) -> DataFrame:
    """One row per document from the shards' files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, part, shard.

    Only each part's number of ids comes to the driver: as many numbers as
    the write had partitions.
    """
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    base, at = {}, 0
    for r in totals:
        base[r["part"]], at = at, at + r["n"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, shard, start, _, _, data = (c[0].as_py() for c in batch.slice(i, 1).columns)
                got = [(d, base[part] + start + s, len(x), zlib.crc32(x.astype("<u4").tobytes())) for d, s, x in WaveletMatrix.from_bytes(data).documents()]
                cols = list(zip(*got))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols] + [pa.array([part] * len(got), pa.int32()), pa.array([shard] * len(got), pa.int32())], names=["doc_id", "start", "n_tokens", "ids_crc32", "part", "shard"])

    return shards.select("part", "shard", "start", "n_docs", "n_tokens", "file").mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long, part int, shard int")


def wavelet_tokens(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 1, shard_tokens: int = 1 << 20) -> DataFrame:
    """Writes the shards to the shared folder and reads every document back from them."""
    return read_shards(write_shards(docs, shared_dir(docs.sparkSession, "wavelet"), tokenizer, end_id, shard_tokens))
