"""Near duplicates by BagMinHash: weighted-Jaccard signatures of shingle multisets, banded, verified, linked.

A document is the multiset of its shingles of five words (a text of fewer
words is one shingle; a text without a word is its own only shingle).  Each
weight level r of shingle s carries Poisson points in time, each on a random
register; the levels [2^k, 2^(k+1)) share one process of rate 2^k whose points
fall on a level by their hash, so a shingle of weight w takes about log2 w
processes, and a point counts if its level is below w.  A register's value is
its earliest point: equal in two documents with probability exactly their
weighted Jaccard similarity.

Documents of equal multisets are one *content*, and only contents are banded,
so large groups of copies cost one row.  Contents that agree in a band are
candidates.  First a bucket's candidates are compared with one pivot, its
member of most company, not all with all: what joins the pivot's class is
settled.  In buckets that then still hold several classes, the pairs of
different classes are estimated from their signatures, in bounded blocks, and
those within four standard errors of the threshold are compared too.  A link
is kept only if the exact multiset overlap reaches ``threshold``.

Result: one row per document with the smallest doc_id of its class.  Null and
empty texts have no shingle and stay alone.  Rows get a lasting number first,
so rows that share a doc_id, or have none, are told apart and are copies of
each other if their contents are.  A null doc_id is a member like any other; a
class of nulls alone has a null class_id.  Of each class one row stays: that of
least doc_id, nulls last, the earliest of equal ones.  Extra columns are
ignored, whatever their names; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_text, combine, drop_stored, free, mix, prefix_hash, range_hash, shuffle_partitions, small_batches, stored, text_slices, words

SHINGLE = 5
#: Registers of the longer signatures that estimates take.
MARKS = 400
_U = np.uint64


def shingles(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a slice's rows, one row after the other, and their offsets."""
    low, starts, ends, first = words(buf, offs)
    h = range_hash(prefix_hash(low), starts, ends)
    n = np.diff(first)
    full = combine(h, SHINGLE)
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, np.where(np.diff(offs) > 0, 1, 0))
    edge = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(first[:-1] - edge[:-1], count) + np.arange(edge[-1])
    out = full[np.minimum(at, max(len(full) - 1, 0))] if len(full) else np.zeros(edge[-1], np.uint64)
    for i in np.flatnonzero((n < SHINGLE) & (count > 0)):
        if n[i]:
            out[edge[i]] = combine(h[first[i] : first[i + 1]], int(n[i]))[0] ^ _U(int(n[i]))
        else:  # no word: the text itself
            part = buf[offs[i] : offs[i + 1]]
            out[edge[i]] = range_hash(prefix_hash(part), np.array([0]), np.array([len(part)]))[0] ^ _U(0x55)
    return out, edge


def multisets(buf: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each row's distinct shingles in rising order, and how often each stands."""
    h, edge = shingles(buf, offs)
    for i in range(len(edge) - 1):
        yield np.unique(h[edge[i] : edge[i + 1]], return_counts=True)


def content_key(u: np.ndarray, c: np.ndarray) -> bytes:
    """128 bits that equal multisets share."""
    if not len(u):
        return b""
    w = mix(u ^ (c.astype(np.uint64) * _U(0x9E3779B97F4A7C15)))
    return np.array([w.sum(), mix(w ^ _U(0xC2B2AE3D27D4EB4F)).sum()], np.uint64).tobytes()


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], m: int) -> np.ndarray:
    """BagMinHash signatures, a row of ``m`` values for each multiset; a row of an empty one is all ones."""
    sig = np.full((len(sets), m), ~_U(0))
    total = np.array([int(c.sum()) for _, c in sets], np.float64)
    todo, slack = np.flatnonzero(total > 0), 4.0
    while len(todo):
        seed, rate, owner, base, weight = [], [], [], [], []
        for i in todo:
            u, c = sets[i]
            for k in range(-1, int(c.max() - 1).bit_length()):  # level 0, then [2^k, 2^(k+1))
                some = u if k < 0 else u[c > 1 << k]
                seed.append(mix(some + _U(0x632BE59BD9B4E019 * (k + 2) & 0xFFFFFFFFFFFFFFFF)))
                rate.append(np.full(len(some), max(k, 0), np.int64))
                base.append(np.full(len(some), 0 if k < 0 else 1 << k, np.int64))
                weight.append(c if k < 0 else c[c > 1 << k])
                owner.append(np.full(len(some), i, np.int64))
        seed, rate, owner, base, weight = (np.concatenate(x) for x in (seed, rate, owner, base, weight))
        # time is counted in whole steps, so that sums are exact
        limit = ((np.log(m) + slack) * m / total[owner] * 2.0**32).astype(np.int64)
        t, step = np.zeros(len(seed), np.int64), 0
        while len(seed):
            h = mix(seed + _U(step * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF))
            t = t + np.maximum(1, (-np.log1p(-((h >> _U(11)).astype(np.float64) * 2.0**-53)) * 2.0**32).astype(np.int64) >> rate)
            on = t < limit
            seed, rate, owner, base, weight, limit, t = (x[on] for x in (seed, rate, owner, base, weight, limit, t))
            g = mix(h[on] ^ _U(0xA5A5A5A55A5A5A5A))
            level = base + ((g >> _U(32)).astype(np.int64) & np.maximum(base - 1, 0))
            hit = level < weight
            np.minimum.at(sig, (owner[hit], (g[hit] & _U(0xFFFFFFFF)).astype(np.int64) % m), t[hit].astype(np.uint64))
            step += 1
        todo = todo[(sig[todo] == ~_U(0)).any(axis=1)]
        sig[todo] = ~_U(0)
        slack += 4.0
    return sig


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard: overlap of the multisets over their union."""
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    same = b[0][at] == a[0]
    over = int(np.minimum(a[1][same], b[1][at[same]]).sum())
    return over / (int(a[1].sum()) + int(b[1].sum()) - over)


def _pack(u: np.ndarray, c: np.ndarray) -> bytes:
    """A multiset as bytes: the hashes, then the counts of those that stand more than once."""
    many = np.flatnonzero(c > 1).astype(np.uint32)
    return np.uint32(len(u)).tobytes() + u.tobytes() + many.tobytes() + c[many].astype(np.uint32).tobytes()


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(data, np.uint32, 1)[0])
    u = np.frombuffer(data[4 : 4 + 8 * n], np.uint64)
    rest = np.frombuffer(data, np.uint32, offset=4 + 8 * n)
    c = np.ones(n, np.int64)
    c[rest[: len(rest) // 2]] = rest[len(rest) // 2 :]
    return u, c


def band_hashes(sets: list[tuple[np.ndarray, np.ndarray]], bands: int, rows: int) -> np.ndarray:
    """A hash for each multiset and band of ``rows`` registers."""
    sig = signatures(sets, bands * rows).reshape(len(sets), bands, rows)
    tag, h = mix(np.arange(1, bands + 1, dtype=np.uint64)), np.zeros((len(sets), bands), np.uint64)
    for k in range(rows):
        h = mix(h * _U(0x9FB21C651E98DF25) + sig[:, :, k] + tag)
    return h.view(np.int64)


def _lists(h: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(h) + 1) * h.shape[1], pa.int32()), pa.array(h.ravel()))


def numbered(docs: DataFrame) -> DataFrame:
    """row (a lasting number), doc_id, text."""
    return stored(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), as_text("text").alias("text")), "rows")


def sign(rows_: DataFrame, bands: int, rows: int) -> DataFrame:
    """row, doc_id, content (128-bit key; empty without shingles), size (shingles), bands (a hash each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, buf, offs in text_slices(batch, "text"):
                sets = list(multisets(buf, offs))
                keys = [content_key(u, c) for u, c in sets]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(keys, pa.binary()), pa.array([int(c.sum()) for _, c in sets], pa.int64()), _lists(band_hashes(sets, bands, rows))], names=["row", "doc_id", "content", "size", "bands"])

    return rows_.select("row", "doc_id", "text").mapInArrow(run, "row long, doc_id long, content binary, size long, bands array<long>")


def _marks(sets: DataFrame, contents: DataFrame, bands: int, rows: int) -> DataFrame:
    """content, bands, sig (16 bits of each of ``MARKS`` registers) of some contents, made again from their multisets: no other content carries a long signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                got = [_unpack(x) for x in part.column(1).to_pylist()]
                sig = mix(signatures(got, MARKS)).astype(np.uint16)
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(band_hashes(got, bands, rows)), pa.array([x.tobytes() for x in sig], pa.binary())], names=["content", "bands", "sig"])

    return sets.join(contents, "content", "left_semi").select("content", "packed").mapInArrow(run, "content binary, bands array<long>, sig binary")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b: contents) with their similarity ``j``; ``sets``: content, packed.

    The joins sort and merge at every size, so that a hot pivot's pairs can be
    split and the cost grows with the input.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            a, b, pa_, pb = (batch.column(i) for i in range(4))
            out = []
            for i in range(batch.num_rows):
                key = b[i].as_py()
                if key != last:
                    last, held = key, _unpack(pb[i].as_py())
                out.append(similarity(_unpack(pa_[i].as_py()), held))
            yield pa.RecordBatch.from_arrays([a, b, pa.array(out, pa.float64())], names=["a", "b", "j"])

    left = pairs.join(sets.select(F.col("content").alias("a"), F.col("packed").alias("pa")).hint("merge"), "a")
    both = left.join(sets.select(F.col("content").alias("b"), F.col("packed").alias("pb")).hint("merge"), "b")
    return both.select("a", "b", "pa", "pb").mapInArrow(run, "a binary, b binary, j double")


def components(links: DataFrame) -> DataFrame:
    """node, label of every linked node: the smallest node of its connected component.

    Alternating large-star and small-star steps over ``links`` (a, b): every
    node hands its least neighbour to the others.  A step is a few shuffles of
    the links, a node with many links is reduced by partial aggregation, and
    no group is collected; steps are written to the shared folder.  Stars
    whose centre is least, as the pivots make them, are done after one.
    """
    spread = lambda d: d.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = spread(edges)
    while state["n"]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(low.select("u", F.col("m").alias("v")))
        edges = stored(small.distinct(), "edges")
        was, state = state, spread(edges)
        if state == was:
            break
    label = edges.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("node"), "label")
    return label.union(label.select(F.col("label").alias("node"), "label").distinct())


def near_duplicates(docs: DataFrame, threshold: float = 0.8, bands: int = 36, rows: int = 6, block: int = 2048) -> DataFrame:
    """One row per document: doc_id, class_id, class_size (documents), n_links (links of its content verified in the search), content (hex), kept (the one document of its class that stays)."""
    small_batches(docs.sparkSession)
    return _classes(numbered(docs), threshold, bands, rows, block).drop("row")


def _classes(numbered_: DataFrame, threshold: float, bands: int, rows: int, block: int) -> DataFrame:
    signed = stored(sign(numbered_, bands, rows), "signed")
    links, label = _links(numbered_, signed, threshold, bands, rows, block)
    degree = links.select("a").union(links.select(F.col("b").alias("a"))).groupBy("a").agg(F.count("*").alias("n_links"))
    labels = label.join(degree, F.col("node") == F.col("a")).select("node", "label", "n_links")
    # documents without shingles are their own class each; others go with their content
    order = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row")
    plain = signed.where("length(content) > 0").groupBy("content").agg(F.min(order).alias("low"), F.count("*").alias("n"))
    contents = plain.join(labels, plain["content"] == labels["node"], "left").select("content", "low", "n", F.coalesce("label", "content").alias("label"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    contents = stored(contents, "contents")
    classes = contents.groupBy("label").agg(F.min("low").alias("low"), F.sum("n").alias("class_size"))
    known = contents.drop("low").join(classes, "label").select("content", F.col("low.doc_id").alias("class_id"), F.col("low.row").alias("lead"), "class_size", "n_links")
    out = signed.select("row", "doc_id", "content").join(known, "content", "left")
    alone = F.length("content") == 0
    return out.select("row", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.when(alone, F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"), F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"), F.hex("content").alias("content"), (alone | (F.col("lead") == F.col("row"))).alias("kept"))


def _links(numbered_: DataFrame, signed: DataFrame, threshold: float, bands: int, rows: int, block: int) -> tuple[DataFrame, DataFrame]:
    """The verified links (a, b, j) between different contents, and their components (node, label)."""
    first = signed.where("length(content) > 0").groupBy("content").agg(F.first("size").alias("size"), F.first("bands").alias("bands"), F.min("row").alias("row"))
    banded = stored(first.select("content", "size", "row", F.posexplode("bands").alias("band", "h")), "banded")
    free(signed.sparkSession)
    shared = stored(banded.groupBy("band", "h").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    free(signed.sparkSession)
    members = stored(banded.join(shared.hint("merge"), ["band", "h"]), "members")
    drop_stored(banded)
    free(signed.sparkSession)
    needed = members.groupBy("content").agg(F.first("row").alias("row"), F.sum("n").alias("degree"))
    needed = stored(needed, "needed")
    sets = stored(_sets(numbered_, needed.select("content", "row")), "sets")
    # each bucket's pivot is its member of most company: the text that a group's copies were made from lies nearest to most of them
    known = members.select("band", "h", "content", "size").join(needed.select("content", "degree"), "content")
    known = stored(known, "known")
    top = known.groupBy("band", "h").agg(F.min(F.struct((-F.col("degree")).alias("o"), "content", "size")).alias("p")).select("band", "h", F.col("p.content").alias("b"), F.col("p.size").alias("size_b"))
    pairs = known.join(stored(top, "pivots"), ["band", "h"]).where((F.col("content") != F.col("b")) & (F.least("size", "size_b") >= F.greatest("size", "size_b") * F.lit(threshold)))
    tested = stored(_verified(pairs.select(F.col("content").alias("a"), "b").distinct(), sets), "verified")
    links = tested.where(F.col("j") >= threshold)
    label = stored(components(links), "labels")
    # buckets that still hold several classes
    now = known.join(label, F.col("content") == F.col("node"), "left").select("band", "h", "content", "size", F.coalesce("label", "content").alias("label"))
    now = stored(now, "labelled")
    open_ = now.groupBy("band", "h").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("n")).where("x <> y").select("band", "h", "n")
    now = stored(now.join(stored(open_, "open"), ["band", "h"]), "opened")
    now = now.join(stored(_marks(sets, now.select("content").distinct(), bands, rows), "marks"), "content")
    rest = _estimated(now, threshold, block)
    done = tested.select("a", "b").union(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
    more = stored(_verified(rest.join(done, ["a", "b"], "left_anti"), sets), "verified")
    found = more.where(F.col("j") >= threshold)
    if not found.isEmpty():
        links = links.unionByName(found)
        label = stored(components(links), "labels")
    return links, label


def _estimated(now: DataFrame, threshold: float, block: int) -> DataFrame:
    """Pairs (a, b) of different classes in a bucket whose signatures agree in enough registers, each pair once.

    A bucket's rows are compared in memory, ``block`` by ``block``: a larger
    one is cut into blocks, and every pair of blocks is a task's group.  The
    least agreement is four standard errors below the threshold.  A pair is
    given by the first band that it shares.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def pairs(table: pa.Table) -> pa.RecordBatch:
            t = table.combine_chunks()
            sig = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint16).reshape(t.num_rows, -1)
            bands = np.array(t["bands"].to_pylist(), np.int64)
            size, side = t["size"].to_numpy(), t["side"].to_numpy()
            band, own = t["band"][0].as_py(), t["i"][0].as_py() == t["j"][0].as_py()
            label = np.unique(np.array(t["label"].to_pylist(), object), return_inverse=True)[1]
            content, m = t["content"].to_pylist(), sig.shape[1]
            least = m * threshold - 4 * (m * threshold * (1 - threshold)) ** 0.5
            out_a, out_b = [], []
            for k in range(t.num_rows):
                other = np.arange(k + 1, t.num_rows)
                other = other[(label[other] != label[k]) & (np.minimum(size[other], size[k]) >= threshold * np.maximum(size[other], size[k]))]
                if not own:
                    other = other[side[other] != side[k]]
                other = other[(sig[other] == sig[k]).sum(axis=1) >= least]
                if len(other):
                    other = other[(bands[other] == bands[k]).argmax(axis=1) == band]
                    for o in other.tolist():
                        out_a.append(min(content[k], content[o]))
                        out_b.append(max(content[k], content[o]))
            return pa.RecordBatch.from_arrays([pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary())], names=["a", "b"])

        def groups(rest: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            table = pa.Table.from_batches(held)
            keys = np.stack([table[c].to_numpy() for c in ("band", "h", "i", "j")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            edges = [0, *cuts.tolist(), *([table.num_rows] if rest else [])]
            for a, b in zip(edges, edges[1:]):
                if b - a > 1:
                    yield pairs(table.slice(a, b - a))
            held = [] if rest else table.slice(edges[-1]).to_batches()

        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                held.append(batch.slice(i, 2048))
                if sum(b.num_rows for b in held) >= 4096:
                    yield from groups(False)
        if held:
            yield from groups(True)

    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("content"), blocks).cast("int")
    rows = now.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    rows = rows.select("band", "h", "i", "j", (F.col("own") == F.col("i")).alias("side"), "content", "size", "label", "bands", "sig")
    key = ["band", "h", "i", "j"]
    return rows.repartition(shuffle_partitions(now.sparkSession), *key).sortWithinPartitions(*key).mapInArrow(compare, "a binary, b binary")


def _sets(numbered_: DataFrame, needed: DataFrame) -> DataFrame:
    """content, packed: the multisets of the contents in ``needed`` (content, row), each from one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, buf, offs in text_slices(batch, "text"):
                got = [_pack(u, c) for u, c in multisets(buf, offs)]
                yield pa.RecordBatch.from_arrays([some.column(1), pa.array(got, pa.binary())], names=["content", "packed"])

    met = numbered_.select("row", "text").join(needed.hint("merge"), "row").select("text", "content")
    return met.mapInArrow(run, "content binary, packed binary")


def one_of_each(docs: DataFrame, threshold: float = 0.8, bands: int = 36, rows: int = 6, block: int = 2048) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns: of each class one row, as the module says; every row without shingles."""
    small_batches(docs.sparkSession)
    whole = stored(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r")), "rows")
    slim = whole.select("row", F.col("r.doc_id").cast("long").alias("doc_id"), F.col("r.text").cast("string").alias("text"))
    stay = _classes(slim, threshold, bands, rows, block).where("kept").select("row")
    return whole.join(stay, "row", "left_semi").select("r.*")
