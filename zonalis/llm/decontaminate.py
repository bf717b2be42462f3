"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

Every window of ``window`` consecutive item words (an item of fewer words is
one window) is a record: the set of its shingles of three words.  A document
that holds the window holds every shingle, so one necessary shingle is enough
as prefix: the window's rarest, by counts over all documents.  A document's
shingles are joined with these prefixes; a match fixes where the window would
begin (positional bound) and end (length bound), and the words there are
compared with the window's.

The items' index is sent to the tasks in blocks of at most ``block_bytes`` of
item text, one pass over the documents a block: what is broadcast is bounded
whatever the benchmark's size.  Nothing else moves with one block; with more,
the blocks' hits meet by document row.

Nulls and texts without a word have n_words 0 and no hit; an item without a
word has no window; equal items are each reported.  Null doc_ids and repeated
rows are kept, each judged by itself.  An item without an id can't be named,
so it is no item.  A very long text is one row's words in memory.  Extra
columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, combine, prefix_hash, range_hash, stored, text_slices, words

SHINGLE = 3


class ItemIndex:
    """The windows of some items, and the prefix shingle of each once the shingles' counts are known."""

    def __init__(self, items: list[tuple[object, str]], window: int):
        self.window = window
        raw = [(x or "").encode("utf-8", "surrogatepass") for _, x in items]
        offs = np.cumsum([0, *map(len, raw)])
        low, starts, ends, first = words(np.frombuffer(b"".join(raw), np.uint8), offs)
        text, h = low.tobytes(), range_hash(prefix_hash(low), starts, ends)
        windows: dict[bytes, tuple[int, np.ndarray]] = {}
        holders: dict[bytes, set[int]] = {}
        for k in range(len(items)):
            a, b = int(first[k]), int(first[k + 1])
            size = min(window, b - a)
            for s in range(a, b - size + 1 if size else a):
                key = b" ".join(text[starts[i] : ends[i]] for i in range(s, s + size))
                windows.setdefault(key, (size, h[s : s + size]))
                holders.setdefault(key, set()).add(k)
        self.items = [str(i) for i, _ in items]
        self.keys = list(windows)
        self.size = np.array([windows[k][0] for k in self.keys], np.int64)
        self.holders = [sorted(holders[k]) for k in self.keys]
        self.shingles = [combine(windows[k][1], min(SHINGLE, windows[k][0])) for k in self.keys]
        #: every shingle, by the number of its words
        self.all = {n: np.unique(np.concatenate([s for s, z in zip(self.shingles, self.size) if min(SHINGLE, z) == n] or [np.zeros(0, np.uint64)])) for n in range(1, SHINGLE + 1)}

    def choose(self, counts: dict[int, int]) -> None:
        """Orders each window's shingles by rarity, then hash; keeps the first as prefix."""
        by_n: dict[int, list[tuple[int, int, int]]] = {}
        for w, (s, z) in enumerate(zip(self.shingles, self.size)):
            at = min(range(len(s)), key=lambda i: (counts.get(int(s[i].view(np.int64)), 0), int(s[i])))
            by_n.setdefault(min(SHINGLE, int(z)), []).append((int(s[at]), w, at))
        self.prefix = {}
        for n, rows in by_n.items():
            rows.sort()
            self.prefix[n] = (np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
        self.shingles = []

    def hits(self, text: bytes, starts: np.ndarray, ends: np.ndarray, h: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(row, first word, window) of each occurrence."""
        for n, (keys, window, at) in self.prefix.items():
            s = combine(h, n)
            lo, hi = np.searchsorted(keys, s, "left"), np.searchsorted(keys, s, "right")
            where = np.flatnonzero(hi > lo)
            if not len(where):
                continue
            rows = np.searchsorted(first, where, "right") - 1
            for p, row, a, b in zip(where.tolist(), rows.tolist(), lo[where].tolist(), hi[where].tolist()):
                for k in range(a, b):
                    w = int(window[k])
                    begin = p - int(at[k])
                    stop = begin + int(self.size[w])
                    if begin >= first[row] and stop <= first[row + 1]:
                        if b" ".join([text[starts[i] : ends[i]] for i in range(begin, stop)]) == self.keys[w]:
                            yield row, begin - int(first[row]), w


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks; a block's texts alone are held on the driver."""
    part, size = [], 0
    for r in benchmark.select("item_id", as_text("text").alias("text")).where("item_id is not null").orderBy("item_id", "text").toLocalIterator():
        part.append((r["item_id"], r["text"]))
        size += len(r["text"] or "") + 16
        if size >= block_bytes:
            yield part
            part, size = [], 0
    if part:
        yield part


def _shingle_counts(docs: DataFrame, index: ItemIndex) -> dict[int, int]:
    """How often each shingle of the items stands in the documents; at most as many rows as the block has shingles."""
    wanted = index.all

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {n: np.zeros(len(k) + 1, np.int64) for n, k in wanted.items() if len(k)}
        for batch in batches:
            for _, buf, offs in text_slices(batch, "text"):
                low, starts, ends, first = words(buf, offs)
                h = range_hash(prefix_hash(low), starts, ends)
                for n, t in total.items():
                    s = combine(h, n)
                    for e in range(1, n):  # shingles that cross into the next row
                        cross = first[1:-1] - e
                        s[cross[(cross >= 0) & (cross < len(s))]] = 0
                    at = np.minimum(np.searchsorted(wanted[n], s), len(wanted[n]) - 1)
                    t += np.bincount(at[wanted[n][at] == s], minlength=len(t))
        for n, t in total.items():
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array(wanted[n][at].view(np.int64)), pa.array(t[at])], names=["s", "c"])

    rows = docs.mapInArrow(count, "s long, c long").groupBy("s").agg(F.sum("c").alias("c")).collect()
    return {r["s"]: r["c"] for r in rows}


def _found(docs: DataFrame, index: ItemIndex, digest: bool) -> DataFrame:
    """Per row: its columns, n_words, and either the finished digest or the word positions hit and the items."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, buf, offs in text_slices(batch, "text"):
                low, starts, ends, first = words(buf, offs)
                text, h = low.tobytes(), range_hash(prefix_hash(low), starts, ends)
                hit: dict[int, set[int]] = {}
                items: dict[int, set[int]] = {}
                for row, at, w in index.hits(text, starts, ends, h, first):
                    hit.setdefault(row, set()).update(range(at, at + int(index.size[w])))
                    items.setdefault(row, set()).update(index.holders[w])
                n = rows.num_rows
                keep = [rows.column(i) for i, c in enumerate(rows.schema.names) if c != "text"]
                head = [*keep, pa.array(np.diff(first), pa.int64())]
                if digest:
                    found = [sorted({index.items[k] for k in items.get(i, ())}) for i in range(n)]
                    tail = [pa.array([len(hit.get(i, ())) for i in range(n)], pa.int64()), pa.array([len(x) for x in found], pa.int64()), pa.array([",".join(x) for x in found])]
                else:
                    tail = [pa.array([sorted(hit.get(i, ())) for i in range(n)], pa.list_(pa.int64())), pa.array([sorted({index.items[k] for k in items.get(i, ())}) for i in range(n)], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*head, *tail], names=names)

    tail = "n_hit long, n_items long, items string" if digest else "hit array<long>, items array<string>"
    keep = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    schema = f"{keep}, n_words long, {tail}"
    names = [c for c in docs.columns if c != "text"] + ["n_words"] + [c.split()[0] for c in tail.split(", ")]
    return docs.mapInArrow(match, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 4 << 20, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row of ``docs``: the ``keep`` columns, n_words, n_hit, n_items, items (comma-joined ids), items_sha256, contaminated."""
    slim = docs.select(*[F.col(c) for c in keep if c != "text"], as_text("text").alias("text"))
    found: list[DataFrame] = []
    blocks = _blocks(benchmark, block_bytes)
    ahead = list(itertools.islice(blocks, 2))
    many = len(ahead) > 1
    if many:  # the blocks' hits meet by row, so rows get a lasting number
        slim = stored(slim.withColumn("_row", F.monotonically_increasing_id()), "rows")
    for block in itertools.chain(ahead, blocks):
        index = ItemIndex(block, window)
        index.choose(_shingle_counts(slim, index))
        part = _found(slim, index, not many)
        found.append(stored(part, "hits") if many else part)
    if not found:
        found = [_found(slim, _none(window), True)]
    if many:
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        same = [F.first(c).alias(c) for c in (*[c for c in keep if c != "text"], "n_words")]
        items = F.array_sort(F.array_distinct(F.flatten(F.collect_list("items"))))
        out = out.groupBy("_row").agg(*same, F.size(F.array_distinct(F.flatten(F.collect_list("hit")))).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.array_join(items, ",").alias("items")).drop("_row")
    else:
        out = found[0]
    return out.withColumn("items_sha256", F.sha2(F.encode("items", "utf-8"), 256)).withColumn("contaminated", F.col("n_hit") > 0)


def _none(window: int) -> ItemIndex:
    index = ItemIndex([], window)
    index.choose({})
    return index


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 4 << 20) -> DataFrame:
    """The rows of ``docs`` without a hit, with their own columns, whatever their names."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row_"), F.col("text"))
    return decontaminate(row, benchmark, window, block_bytes, keep=("_row_",)).where("not contaminated").select("_row_.*")
