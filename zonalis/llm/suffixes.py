"""Repeated-passage removal: every byte that a repeated string of ``size`` bytes covers.

The suffixes of all texts are ordered by their first ``size`` bytes alone, by
most-significant-digit passes; a class of two or more after the last digit is
exactly a repeated window.  To keep the passes small, suffixes are first dealt
by an anchor: the place of the least hash among the windows' strings of
``GRAM`` bytes.  Equal windows have equal anchors at equal distances, so
windows of different anchors are never compared.

1. Each text is cut into runs of window starts that share an anchor (about one
   run for 80 bytes).  A run's *segment* is all its windows' bytes.
2. Runs whose anchor stands nowhere else are dropped.  Segments of one anchor
   that agree in length and in 64 bits of hash besides the anchor's 64 are one
   suffix class before any pass: a run whose segment stands twice is repeated
   in full, and one run of each different segment goes on, so that copies cost
   no bytes of shuffle.
3. What goes on are edges of passages: their bytes go to their anchor's group,
   where the windows are ordered digit by digit, singletons leaving after each;
   what is left is compared byte by byte.  A group of more than ``hot_rows``
   segments would be one task's; its windows are dealt by 128 bits of their
   digits' hashes over all partitions instead, with the same result.

Rows get a lasting number first, so null and repeated doc_ids are told apart;
rows that share doc_id and text repeat each other and get equal results.
Nulls are empty; texts below ``size`` bytes keep everything; a very long text
is one row's bytes in memory, its hashes 8 bytes for each of its own.  Extra
columns are ignored, whatever their names; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, drop_stored, free, mix, prefix_hash, range_hash, shuffle_partitions, small_batches, stored, text_slices

GRAM = 40
_U = np.uint64


def runs(buf: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Runs of a slice: row, first start (in the row), starts, anchor's distance from the first start, anchor's hash, segment's hash."""
    n, wide = len(buf), size - GRAM + 1
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    if n < size:
        return none
    prefix = prefix_hash(buf)
    at = np.arange(n - GRAM + 1)
    grams = range_hash(prefix, at, at + GRAM)
    key = (grams >> _U(32) << _U(32)) | at.astype(np.uint64)
    key = np.concatenate([key, np.full(-len(key) % wide, ~_U(0))]).reshape(-1, wide)
    ahead = np.minimum.accumulate(key, axis=1).ravel()
    behind = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - size + 1
    anchor = (np.minimum(behind[:count], ahead[wide - 1 : wide - 1 + count]) & _U(0xFFFFFFFF)).astype(np.int64)
    edge = np.zeros(n + 1, np.int64)
    rows = np.flatnonzero(np.diff(offs) >= size)
    np.add.at(edge, offs[rows], 1)
    np.add.at(edge, offs[rows + 1] - size + 1, -1)
    valid = np.flatnonzero(np.cumsum(edge)[:count] > 0)
    if not len(valid):
        return none
    a = anchor[valid]
    new = np.ones(len(valid), bool)
    new[1:] = (a[1:] != a[:-1]) | (valid[1:] != valid[:-1] + 1)
    lead = np.flatnonzero(new)
    s, starts = valid[lead], np.diff(np.append(lead, len(valid)))
    row = np.searchsorted(offs, s, "right") - 1
    return row, s - offs[row], starts, a[lead] - s, grams[a[lead]], range_hash(prefix, s, s + starts - 1 + size)


def window_classes(group: np.ndarray, pos: np.ndarray, buf: np.ndarray, prefix: np.ndarray, size: int) -> np.ndarray:
    """Which windows (starts ``pos``) equal another of their group: passes over digits of GRAM bytes, the first digit first, by the digits' hashes; then by bytes."""
    alive, cls = np.arange(len(pos)), group
    for at in range(0, size, GRAM):
        start = pos[alive] + at
        digit = range_hash(prefix, start, start + min(GRAM, size - at))
        order = np.lexsort((digit, cls))
        c, d = cls[order], digit[order]
        new = np.ones(len(order), bool)
        new[1:] = (c[1:] != c[:-1]) | (d[1:] != d[:-1])
        number = np.cumsum(new) - 1
        many = np.bincount(number, minlength=1)[number] > 1 if len(number) else np.zeros(0, bool)
        keep = order[many]
        cls = number[many]
        alive = alive[keep]
    # each window against the first of its class, eight bytes at a time; the classes stand together
    out = np.zeros(len(pos), bool)
    if len(alive):
        lead = np.flatnonzero(np.append(True, cls[1:] != cls[:-1]))
        count = np.diff(np.append(lead, len(cls)))
        first = np.repeat(pos[alive[lead]], count)
        word = np.ndarray(len(buf) - 7, "<u8", buf, strides=(1,))
        same = np.ones(len(alive), bool)
        for at in [*range(0, size - 7, 8), size - 8]:
            same &= word[pos[alive] + at] == word[first + at]
        if not same.all():  # a collision: those windows by their bytes alone
            left = np.flatnonzero(~np.repeat(np.logical_and.reduceat(same, lead), count))
            seen: dict[tuple[int, bytes], list[int]] = {}
            for i in left.tolist():
                seen.setdefault((int(cls[i]), buf[pos[alive[i]] : pos[alive[i]] + size].tobytes()), []).append(i)
            same[left] = False
            same[[i for x in seen.values() if len(x) > 1 for i in x]] = True
        out[alive[same]] = True
    return out


def _windows(batch: pa.RecordBatch, size: int):
    """Of context rows: the row of each window, its start in the text, its distance to the anchor, its place in the bytes, the bytes, prefix sums."""
    ctx = batch.column(batch.schema.get_field_index("bytes"))
    n, s, off = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n", "s", "off"))
    base = np.cumsum(n + size - 1) - (n + size - 1)
    buf = np.frombuffer(b"".join(ctx.to_pylist()), np.uint8)
    row = np.repeat(np.arange(len(n)), n)
    j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return row, s[row] + j, off[row] - j, base[row] + j, buf, prefix_hash(buf)


def _rows(docs: DataFrame) -> DataFrame:
    """row (a lasting number), doc_id, text."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(as_text("text"), F.lit("")).alias("text"))
    return stored(slim.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "rows")


def repeated_spans(rows: DataFrame, size: int = 200, hot_rows: int = 20_000) -> DataFrame:
    """row, a, b: stretches [a, b) of bytes that repeated windows cover, not yet merged; ``rows``: row, text."""
    if size < GRAM:
        raise ValueError(f"windows of at least {GRAM} bytes are asked for")
    spark = rows.sparkSession
    small_batches(spark)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, buf, offs in text_slices(batch, "text"):
                row, s, n, off, anchor, segment = runs(buf, offs, size)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(segment.view(np.int64)), some.column(0).take(pa.array(row)), pa.array(s), pa.array(n, pa.int32()), pa.array(off, pa.int32())], names=["anchor", "segment", "row", "s", "n", "off"])

    every = stored(rows.select("row", "text").mapInArrow(cut, "anchor long, segment long, row long, s long, n int, off int"), "runs")
    groups = every.groupBy("anchor").agg(F.count("*").alias("total"), F.min("segment").alias("x"), F.max("segment").alias("y")).where("total > 1").select("anchor", (F.col("x") != F.col("y")).alias("mixed"))
    groups = stored(groups, "anchors")  # a join of two fresh shuffles, so that a hot anchor's rows can be split
    some = stored(every.join(groups, "anchor"), "shared-runs")
    drop_stored(every)
    del groups
    free(spark)
    key = ["anchor", "segment", "n"]
    counts = stored(some.groupBy(*key).agg(F.count("*").alias("c")).where("c > 1"), "counts")
    whole = some.join(counts, key).select("row", F.col("s").alias("a"), (F.col("s") + F.col("n") - 1 + size).alias("b"))
    # edges: different segments of anchors with a segment that stands once
    one = some.where("mixed").groupBy(*key).agg(F.count("*").alias("c"), F.min(F.struct("row", "s", "off")).alias("r"))
    one = stored(one, "segments")
    open_ = one.groupBy("anchor").agg(F.min("c").alias("least"), F.count("*").alias("rows")).where("least = 1").select("anchor", (F.col("rows") > hot_rows).alias("hot"))
    need = one.join(open_, "anchor").select("anchor", "hot", (F.col("c") == 1).alias("single"), "r.row", "r.s", "n", "r.off")
    by_row = need.groupBy("row").agg(F.collect_list(F.struct("anchor", "hot", "single", "s", "n", "off")).alias("runs"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row, text, wanted = (c[i].as_py() for c in batch.columns)
                data = text.encode("utf-8", "surrogatepass")
                out = [(w["anchor"], w["hot"], w["single"], row, w["s"], w["n"], w["off"], data[w["s"] : w["s"] + w["n"] - 1 + size]) for w in wanted]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=fields)

    fields = ["anchor", "hot", "single", "row", "s", "n", "off", "bytes"]
    types = [pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    met = rows.select("row", "text").join(by_row, "row").select("row", "text", "runs")
    edges = stored(met.mapInArrow(fetch, "anchor long, hot boolean, single boolean, row long, s long, n int, off int, bytes binary"), "edges")
    drop_stored(one)
    free(spark)

    def spans(batch: pa.RecordBatch, group: np.ndarray) -> pa.RecordBatch:
        row, start, far, pos, buf, prefix = _windows(batch, size)
        hit = window_classes(group[row] * (size + 1) + far, pos, buf, prefix, size)
        single = batch.column(2).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(hit & single[row])
        new = np.ones(len(at), bool)
        new[1:] = (row[at[1:]] != row[at[:-1]]) | (at[1:] != at[:-1] + 1)
        lead = np.flatnonzero(new)
        last = np.append(lead[1:], len(at))[: len(lead)] - 1
        return pa.RecordBatch.from_arrays([batch.column(3).take(pa.array(row[at[lead]])), pa.array(start[at[lead]]), pa.array(start[at[last]] + size)], names=["row", "a", "b"])

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        weight = 0

        def whole_groups(rest: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, weight
            table = pa.Table.from_batches(held).combine_chunks()
            anchor = table.column("anchor").to_numpy()
            end = len(anchor) if rest else int(np.flatnonzero(anchor != anchor[-1])[-1]) + 1 if (anchor != anchor[-1]).any() else 0
            held = table.slice(end).to_batches() if end < len(anchor) else []
            weight = sum(b.nbytes for b in held)
            if end:
                done = table.slice(0, end).combine_chunks().to_batches()[0]
                yield spans(done, np.cumsum(np.append(0, np.diff(anchor[:end]) != 0)))

        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                held.append(batch.slice(i, 4096))
                weight += min(4096, batch.num_rows - i) * (size + 120)
                if weight > 4 << 20:
                    yield from whole_groups(False)
        if held:
            yield from whole_groups(True)

    def single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                row, start, far, pos, _, prefix = _windows(part, size)
                anchor = part.column(0).to_numpy().view(np.uint64)[row]
                digits = np.stack([mix(anchor + far.astype(np.uint64)), *[range_hash(prefix, pos + at, pos + min(at + GRAM, size)) for at in range(0, size, GRAM)]])
                h = np.zeros((2, len(row)), np.uint64)
                for d in digits:
                    h[0] = mix(h[0] * _U(0x9FB21C651E98DF25) + d)
                    h[1] = mix(h[1] * _U(0xC2B2AE3D27D4EB4F) ^ d)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(h[0].view(np.int64)), pa.array(h[1].view(np.int64)), part.column(2).take(at), part.column(3).take(at), pa.array(start)], names=["x", "y", "single", "row", "a"])

    cool = edges.where("not hot").repartition(shuffle_partitions(spark), "anchor").sortWithinPartitions("anchor").mapInArrow(resolve, "row long, a long, b long")
    out = whole.unionByName(cool)
    if not edges.where("hot").isEmpty():
        hot = edges.where("hot").mapInArrow(single_windows, "x long, y long, single boolean, row long, a long")
        twice = hot.groupBy("x", "y").agg(F.count("*").alias("c")).where("c > 1").select("x", "y")
        out = out.unionByName(hot.where("single").join(twice, ["x", "y"]).select("row", "a", (F.col("a") + size).alias("b")))
    return stored(out.distinct(), "spans")


def remove_repeats(docs: DataFrame, size: int = 200, hot_rows: int = 20_000, text: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with ``text`` also the spans and the bytes kept."""
    rows = _rows(docs)
    found = repeated_spans(rows, size, hot_rows).groupBy("row").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    free(docs.sparkSession)
    met = rows.join(found, "row", "left").select("doc_id", "text", "spans")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                out = []
                for t, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    data = t.encode("utf-8", "surrogatepass")
                    merged: list[list[int]] = []
                    for x in sorted((x["a"], x["b"]) for x in spans or ()):
                        if merged and x[0] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], x[1])
                        else:
                            merged.append(list(x))
                    at, left = 0, []
                    for a, b in merged:
                        left.append(data[at:a])
                        at = b
                    kept = b"".join([*left, data[at:]])
                    out.append((len(data), len(data) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), *((merged, kept) if text else ())))
                cols = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], names=names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + (["spans", "kept"] if text else [])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.binary()]
    return met.mapInArrow(strip, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", spans array<array<long>>, kept binary" if text else ""))
