"""Near duplicates by SimHash and multi-index hashing.

A fingerprint has 64 bits: bit i is set if it is set in over half of the XXH64
values (seed 42) of the text's shingles of three words, repeats included.
Words are runs without ASCII white space, A-Z lower-cased; a text of fewer
words is one shingle, a text without a word has fingerprint zero.

Two fingerprints within ``limit`` bits differ by at most ``limit // segments``
bits in one of their segments.  So each fingerprint stands in a table by the
exact value of every segment, and looks up every value of the Hamming ball of
that radius in each segment's table; what it meets is verified on all 64 bits
inside the join, so only links leave it.  Equal fingerprints are one row
throughout, so groups of copies cost nothing here.

A segment value that more than ``crowd`` fingerprints share is one mark in the
table instead of its rows.  Who meets a mark is searched exactly another way:
it names all points within ``limit // 2`` bits of itself (65 at a limit of 2), and
fingerprints that name the same point are within the limit.  Each point has at most as
many names as the ball has points, so neither way compares all pairs of a group, and no
fingerprint makes more than a fixed number of rows.

Result: one row per document.  Links join the documents' components; a component goes
by its smallest doc_id.  A null doc_id is a member like any other, a component
of nulls alone has a null id.  Null and empty texts have fingerprint zero and
are linked like any other, as are repeated rows.  A long text is counted in
pieces.  Extra columns are ignored, whatever their names; an empty table gives
no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bagminhash import components
from .common import as_text, free, shuffle_partitions, stored, text_slices

SHINGLE = 3
#: Shingles that are counted at once.
PIECE = 1 << 16


def fingerprint(text: bytes) -> int:
    """The 64 bits of one text."""
    at = text.lower().split()  # of bytes: ASCII white space and letters only
    n = len(at) - SHINGLE + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(b" ".join(at), 42) if at else 0
    line = b" ".join(at)
    edge = np.cumsum(np.fromiter(map(len, at), np.int64, len(at)) + 1)
    starts, ends = np.concatenate([[0], edge[: n - 1]]).tolist(), (edge[SHINGLE - 1 :] - 1).tolist()
    votes = np.zeros(64, np.int64)
    for k in range(0, n, PIECE):
        h = np.fromiter((xxhash.xxh64_intdigest(line[a:b], 42) for a, b in zip(starts[k : k + PIECE], ends[k : k + PIECE])), np.uint64)
        votes += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, buf, offs in text_slices(batch, "text"):
                whole = buf.tobytes()
                got = np.array([fingerprint(whole[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())], np.uint64)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(got.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_text("text").alias("text")).mapInArrow(run, "doc_id long, fp long")


def ball(bits: range, radius: int) -> list[int]:
    """Masks of at most ``radius`` of ``bits``, as signed 64-bit numbers; no bit first."""
    masks = [sum(1 << b for b in some) for k in range(radius + 1) for some in combinations(bits, k)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def segments_of(count: int) -> list[range]:
    edge = [64 * i // count for i in range(count + 1)]
    return [range(a, b) for a, b in zip(edge, edge[1:])]


def _signed(bits: range) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >> 63 else m


def links(distinct: DataFrame, limit: int = 2, segments: int = 2, crowd: int = 32) -> DataFrame:
    """a, b: pairs of ``distinct`` fingerprints (fp) that join all that differ by at most ``limit`` bits into the same components.

    Pairs met in the tables are all there; of the fingerprints round a point
    each is linked to the least.
    """
    parts, radius = segments_of(segments), limit // segments
    fp, key = F.col("fp"), lambda masks: F.array(*[F.struct(F.lit(i).alias("part"), (F.col("fp").bitwiseXOR(F.lit(m)).bitwiseAND(F.lit(_signed(p)))).alias("value")) for i, p in enumerate(parts) for m in masks(p)])
    rows = distinct.select("fp", F.explode(key(lambda p: [0])).alias("k")).select("fp", "k.part", "k.value")
    counts = rows.groupBy("part", "value").agg(F.count("*").alias("n"))
    table = rows.join(counts, ["part", "value"]).where(F.col("n") <= crowd).select("part", "value", F.col("fp").alias("b"))
    table = stored(table.union(counts.where(F.col("n") > crowd).select("part", "value", F.lit(None).cast("long"))), "segments")
    # a fingerprint makes many rows here, which its table's size does not tell: they are dealt out first and never broadcast
    near = distinct.repartition(shuffle_partitions(distinct.sparkSession), "fp").select(fp.alias("a"), F.explode(key(lambda p: ball(p, radius))).alias("k")).select("a", "k.part", "k.value")
    within = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= limit
    met = stored(near.join(table.hint("merge"), ["part", "value"]).where(F.col("b").isNull() | ((F.col("a") < F.col("b")) & within)).select("a", "b").distinct(), "met")
    free(distinct.sparkSession)
    masks = ball(range(64), limit // 2)
    crowded = met.where("b is null").select(F.col("a").alias("fp"))
    named = crowded.select("fp", F.explode(F.array(*[fp.bitwiseXOR(F.lit(m)) for m in masks])).alias("point"))
    if limit % 2:  # an odd limit has no middle point: one more bit is left open, and the pair of its two values is the point
        named = named.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("bit"), F.col("point").bitwiseAND(F.lit(~(1 << i) if i < 63 else (1 << 63) - 1)).alias("rest")) for i in range(64)])).alias("point"))
    round_ = named.groupBy("point").agg(F.collect_set("fp").alias("of")).where(F.size("of") > 1)
    stars = round_.select(F.array_min("of").alias("a"), F.explode("of").alias("b")).where("a <> b")
    return met.where("b is not null").union(stars)


def near_duplicates(docs: DataFrame, limit: int = 2, segments: int = 2, crowd: int = 32) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, component_size (documents)."""
    signed = stored(fingerprints(docs), "fingerprints")
    # a fingerprint's documents are counted before anything else moves
    distinct = stored(signed.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "distinct")
    label = components(stored(links(distinct.select("fp"), limit, segments, crowd), "links"))
    of = stored(distinct.join(label, F.col("fp") == F.col("node"), "left").select("fp", "low", "n", F.coalesce("label", "fp").alias("label")), "labelled")
    sums = of.groupBy("label").agg(F.min("low").alias("component_id"), F.sum("n").alias("component_size"))
    known = of.select("fp", "label").join(sums, "label").select("fp", "component_id", "component_size")
    return signed.join(known, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "component_size")
