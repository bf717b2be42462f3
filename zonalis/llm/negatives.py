"""Hard negatives by one-dimensional distance keys.

Vectors are searched for the largest inner products.  Each vector x gets one
more coordinate, sqrt(M - |x|^2) with M the largest squared length, and a
query q gets 0 there: then |q - x|^2 = |q|^2 + M - 2 q.x, and the largest
products are the nearest vectors.  Pivots split the space: a vector's key is
its nearest pivot and its distance from it.  Vectors are stored sorted by that
key in blocks of neighbouring keys, each with the interval of its distances.

A vector within distance R of q differs from q by at most R in its distance from
any pivot.  So a round with radius R scans, round every pivot, the blocks that
meet the annulus [d - R, d + R] (d: the query's own distance from it), less
the annulus of the round before.  A query is done when its last wanted score
lies nearer than R, when everything a window admits does, or when its annuli
hold all keys; else R grows, to what certifies the scores found so far if
that is less.  Results are exact whatever the pivots; the keys only decide
how much is scanned.

Queries go through the rounds in blocks as well.  A task takes a block of
queries, then the data blocks of a share of the keys one by one, and keeps only
the best rows of each query, so what leaves it does not grow with what it
scans.  Pivots come from a bounded sample (``SAMPLE`` rows by hash); every row is
indexed.

An anchor's positives are the rows of its label with the largest scores; the
negatives of a positive are the rows of other labels with the largest scores
within [low, high] per cent of the positive's score.  Ties go to the smaller
vec_id (nulls last), then to the earlier row.

Rows without a label, without a vector or with a null or non-finite component
take no part.  Rows of the same vec_id are rows of their own.  Shorter vectors count
as filled with zeros.  Components are floored to whole numbers after scaling;
a squared length of 2^62 or more is an error, as its scores are no longs.
Extra columns are ignored, whatever their names; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored

#: Rows from which the pivots are learnt.
SAMPLE = 2048
#: Rows of a data block and of a block of queries; data blocks that one task scans for a block of queries.
BLOCK, QUERIES, SHARE = 2048, 1024, 64
#: Room for rounding in distances, against themselves and the longest vector.
ROOM = 1e-6


@contextmanager
def _batches(spark: SparkSession, records: int) -> Iterator[None]:
    """Arrow batches of at most ``records`` rows while frames of whole blocks are written."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, str(min(int(was), records)))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def whole_numbers(vectors: DataFrame, scale: float, label: F.Column, anchor: F.Column) -> DataFrame:
    """row (a lasting number), id, label, v (array<long>), anchor: the rows that take part."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    fit = label.isNotNull() & F.col("embedding").isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    some = vectors.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x"), F.coalesce(anchor, F.lit(False)).alias("anchor"), F.coalesce(fit, F.lit(False)).alias("fit")).where("fit")
    return stored(some.select(F.monotonically_increasing_id().alias("row"), "id", "label", F.transform("x", lambda c: F.floor(c * F.lit(float(scale)))).alias("v"), "anchor"), "vectors")


class Space:
    """The index's few fixed numbers: largest squared length, dimensions, pivots (with the added coordinate), stored type."""

    def __init__(self, rows: DataFrame, pivots: int):
        length = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
        at = rows.agg(F.count("*"), F.max(length), F.max(F.size("v")), F.max(F.array_max(F.transform("v", lambda c: F.abs(c))))).first()
        self.n, self.most, self.width = at[0], float(at[1] or 0), int(at[2] or 0)
        if self.most >= 2.0**62:
            raise ValueError("scores of these vectors are no longs: scale them down")
        self.type = np.int16 if (at[3] or 0) < 2**15 else np.int64
        if not self.n:
            return
        few = rows.select("v", F.xxhash64("row").alias("h")).orderBy("h").limit(max(pivots, SAMPLE)).select("v").collect()
        x = self.lifted(self.matrix([r.v for r in few]).astype(np.float64))
        self.pivots = x[: min(pivots, len(x))]
        for _ in range(6):  # a few steps towards the means of their cells
            near = self.apart(x, self.pivots).argmin(axis=1)
            self.pivots = np.array([x[near == k].mean(axis=0) if (near == k).any() else self.pivots[k] for k in range(len(self.pivots))])

    def matrix(self, lists: list) -> np.ndarray:
        out = np.zeros((len(lists), self.width), np.int64)
        for i, v in enumerate(lists):
            out[i, : len(v)] = v
        return out

    def lifted(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([x, np.sqrt(np.maximum(self.most - (x * x).sum(axis=1, keepdims=True), 0))])

    @staticmethod
    def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Distances of the rows of ``x`` from those of ``y``."""
        return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * (x @ y.T), 0))

    def from_query(self, x: np.ndarray) -> np.ndarray:
        """Distances of queries (added coordinate 0) from the pivots."""
        return self.apart(np.hstack([x, np.zeros((len(x), 1))]), self.pivots)

    def products(self, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Exact inner products, as longs."""
        if self.most < 2.0**52:  # sums of doubles are exact
            return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
        return q.astype(np.int64) @ x.astype(np.int64).T


def keyed(rows: DataFrame, space: Space) -> DataFrame:
    """row, id, label, vec (bytes), anchor, pivot, key (distance from the pivot)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = space.matrix(b.column(3).to_pylist())
            d = space.apart(space.lifted(x.astype(np.float64)), space.pivots)
            near = d.argmin(axis=1)
            vec = [v.tobytes() for v in x.astype(space.type)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in (0, 1, 2)), pa.array(vec, pa.binary()), b.column(4), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(x)), near])], names=["row", "id", "label", "vec", "anchor", "pivot", "key"])

    return stored(rows.mapInArrow(run, "row long, id long, label long, vec binary, anchor boolean, pivot int, key double"), "keyed")


_IDS = "row binary, id binary, null binary, label binary, vec binary"


def _packed(t: pa.Table) -> dict[str, bytes]:
    """The columns of a block's rows as bytes."""
    id_ = t["id"].combine_chunks()
    return {
        "row": t["row"].to_numpy().astype(np.int64).tobytes(), "id": id_.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
        "null": id_.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(), "label": t["label"].to_numpy().astype(np.int64).tobytes(), "vec": b"".join(t["vec"].to_pylist()),
    }


def index(rows: DataFrame, space: Space, block: int) -> DataFrame:
    """Blocks of rows of neighbouring keys: block, pivot, lo, hi, n, and the rows' columns packed."""
    parts = max(1, -(-space.n // (16 * block)))
    names = ["block", "pivot", "lo", "hi", "n", "keys", "row", "id", "null", "label", "vec"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32

        def packed(t: pa.Table) -> pa.RecordBatch:
            nonlocal made
            made += 1
            keys, p = t["key"].to_numpy(), _packed(t)
            one = {"block": made, "pivot": t["pivot"][0].as_py(), "lo": float(keys[0]), "hi": float(keys[-1]), "n": len(keys), "keys": keys.tobytes()} | p
            return pa.RecordBatch.from_arrays([pa.array([one["block"]], pa.int64()), pa.array([one["pivot"]], pa.int32()), pa.array([one["lo"]]), pa.array([one["hi"]]), pa.array([one["n"]], pa.int64()), *(pa.array([one[c]], pa.binary()) for c in names[5:])], names=names)

        held: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            pivot = held["pivot"].to_numpy()
            at = 0
            while True:
                end = min(at + block, int(np.searchsorted(pivot, pivot[at], "right"))) if at < len(pivot) else at
                if end >= len(pivot):  # the run may go on
                    break
                yield packed(held.slice(at, end - at))
                at = end
            held = held.slice(at)
        while held is not None and held.num_rows:
            yield packed(held.slice(0, block))
            held = held.slice(block)

    # equal keys are told apart by a hash, so that a common vector fills as many partitions as it needs
    some = rows.select("pivot", "key", F.xxhash64("row").alias("h"), "row", "id", "label", "vec").repartitionByRange(parts, "pivot", "key", "h").sortWithinPartitions("pivot", "key", "h")
    return stored(some.mapInArrow(run, f"block long, pivot int, lo double, hi double, n long, keys binary, {_IDS}"), "blocks")


def _best(who, score, null, id_, row, keep: int):
    """Places of the first ``keep`` rows of every ``who``: higher scores, then ids (nulls last), then rows."""
    o = np.lexsort((row, id_, null, -score, who))
    w = who[o]
    first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]])) if len(w) else np.zeros(0, np.int64)
    rank = np.arange(len(w)) - np.repeat(first, np.diff(np.concatenate([first, [len(w)]])))
    return o[rank < keep]


def _round(queries: DataFrame, blocks: DataFrame, space: Space, spans: tuple, same: bool, keep: int, per: int, share: int) -> tuple[DataFrame, DataFrame]:
    """One round: the queries packed, and the best rows of their annuli.

    ``queries``: row, id, label, vec, pivot, key, r0 (radius scanned), r1 (radius
    now), near (no wanted row is nearer), slots (array of [least, most, floor]:
    bounds of the wanted scores and the least that still counts).  Gives the
    rows found (row, slot, score, null, id, found) and the queries whose annuli now hold
    all keys (row).
    """
    spark = queries.sparkSession
    low, high = spans

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        for b in batches:
            for i in range(0, b.num_rows, per):
                t = pa.Table.from_batches([b.slice(i, per)])
                made += 1
                x = np.frombuffer(b"".join(t["vec"].to_pylist()), space.type).reshape(t.num_rows, -1).astype(np.float64)
                d, r0, r1, near = space.from_query(x), t["r0"].to_numpy()[:, None], t["r1"].to_numpy()[:, None], t["near"].to_numpy()[:, None]
                all_ = ((d - r1 <= low) & (d + r1 >= high)).all(axis=1)
                # the annuli of all queries, the part that all of them have seen, and the nearest that any wants
                reach = [{"pivot": k, "a": float((d - r1)[:, k].min()), "b": float((d + r1)[:, k].max()), "seen_a": float((d - r0)[:, k].max()), "seen_b": float((d + r0)[:, k].min()), "near": float((near - d)[:, k].min())} for k in range(d.shape[1])]
                p = _packed(t)
                slots = np.array(t["slots"].to_pylist(), np.int64)
                out = [[made], [p["row"]], [p["id"]], [p["null"]], [p["label"]], [p["vec"]], [np.hstack([r0, r1]).tobytes()], [slots.tobytes()], [slots.shape[1]], [reach], [all_.astype(np.uint8).tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, packed_schema)], schema=packed_schema)

    reach_type = pa.list_(pa.struct([("pivot", pa.int32()), *((c, pa.float64()) for c in ("a", "b", "seen_a", "seen_b", "near"))]))
    packed_schema = pa.schema([("q", pa.int64()), *((c, pa.binary()) for c in ("row", "id", "null", "label", "vec", "radii", "slots")), ("n_slots", pa.int32()), ("reach", reach_type), ("all", pa.binary())])
    ddl = f"q long, {_IDS}, radii binary, slots binary, n_slots int, reach array<struct<pivot int, a double, b double, seen_a double, seen_b double, near double>>, all binary"
    ordered = queries.repartitionByRange(max(1, -(-queries.count() // per)), "pivot", "key", F.xxhash64("row")).sortWithinPartitions("pivot", "key")
    with _batches(spark, per):
        packs = stored(ordered.select("row", "id", "label", "vec", "r0", "r1", "near", "slots").mapInArrow(pack, ddl), "queries")
    reach = packs.select("q", F.explode("reach").alias("s")).select("q", "s.*")
    meets = (F.col("hi") >= F.col("a")) & (F.col("lo") <= F.col("b")) & ~((F.col("lo") >= F.col("seen_a")) & (F.col("hi") <= F.col("seen_b"))) & (F.col("hi") >= F.col("near"))
    n_shares = max(1, -(-blocks.count() // share))
    pairs = reach.join(blocks.select("block", "pivot", "lo", "hi"), "pivot").where(meets).select("q", "block", F.pmod(F.xxhash64("block"), F.lit(n_shares)).cast("int").alias("share"))
    pairs = stored(pairs, "pairs")
    data = pairs.join(blocks.hint("merge"), "block").select("q", "share", F.lit(1).alias("kind"), F.struct("pivot", "keys", "row", "id", "null", "label", "vec").alias("data"), F.lit(None).cast("struct<row binary, label binary, vec binary, radii binary, slots binary, n_slots int>").alias("query"))
    asks = pairs.select("q", "share").distinct().join(packs.hint("merge"), "q").select("q", "share", F.lit(0).alias("kind"), F.lit(None).cast("struct<pivot int, keys binary, row binary, id binary, null binary, label binary, vec binary>").alias("data"), F.struct("row", "label", "vec", "radii", "slots", "n_slots").alias("query"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_schema = pa.schema([("row", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("null", pa.bool_()), ("id", pa.int64()), ("found", pa.int64())])
        ints = lambda x: np.frombuffer(x, np.int64)
        ask = best = None

        def done() -> pa.RecordBatch:
            who, score, null, id_, row = best
            return pa.RecordBatch.from_arrays([pa.array(ints(ask["row"])[who // n_slots]), pa.array((who % n_slots).astype(np.int32)), pa.array(score), pa.array(null.astype(bool)), pa.array(id_), pa.array(row)], schema=out_schema)

        for b in batches:
            for i in range(b.num_rows):
                if b.column(2)[i].as_py() == 0:
                    if ask is not None:
                        yield done()
                    ask = b.column(4)[i].as_py()
                    n_slots, own, own_label = ask["n_slots"], ints(ask["row"]), ints(ask["label"])
                    q = np.frombuffer(ask["vec"], space.type).reshape(len(own), -1)
                    r0, r1 = np.frombuffer(ask["radii"], np.float64).reshape(-1, 2).T[:, :, None]
                    slots = np.frombuffer(ask["slots"], np.int64).reshape(len(own), n_slots, 3)
                    floor, d = slots[:, :, 2].copy(), space.from_query(q.astype(np.float64))
                    best = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint8, np.int64, np.int64))
                    continue
                x = b.column(3)[i].as_py()
                row, id_, null, label, keys = ints(x["row"]), ints(x["id"]), np.frombuffer(x["null"], np.uint8), ints(x["label"]), np.frombuffer(x["keys"], np.float64)
                vec, at, step = np.frombuffer(x["vec"], space.type).reshape(len(row), -1), 0, 64
                while at < len(row):  # few rows at first: they raise the floor for the next ones
                    part = slice(at, at + step)
                    score = space.products(q, vec[part])
                    off = np.abs(keys[part] - d[:, [x["pivot"]]])
                    admit = (off <= r1) & (off > r0) & ((own_label[:, None] == label[part]) == same)
                    if same:
                        admit &= own[:, None] != row[part]
                    found = [best]
                    for s in range(n_slots):
                        a, c = np.nonzero(admit & (score >= floor[:, s, None]) & (score <= slots[:, s, 1, None]))
                        found.append((a * n_slots + s, score[a, c], null[part][c], id_[part][c], row[part][c]))
                    who, *rest = (np.concatenate(y) for y in zip(*found))
                    at, step = at + step, min(step * 4, 512)
                    if len(who) == len(best[0]):
                        continue
                    o = _best(who, *rest, keep)
                    best = tuple(y[o] for y in (who, *rest))
                    count = np.bincount(best[0], minlength=len(own) * n_slots).reshape(len(own), n_slots)
                    last = np.full(len(own) * n_slots, np.iinfo(np.int64).max)
                    np.minimum.at(last, best[0], best[1])
                    floor = np.where(count == keep, np.maximum(floor, last.reshape(len(own), n_slots)), floor)
        if ask is not None:
            yield done()

    tasks = max(1, n_shares * packs.count())
    with _batches(spark, 32):
        work = asks.union(data).repartition(min(tasks, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))), "q", "share").sortWithinPartitions("q", "share", "kind")
        found = stored(work.mapInArrow(scan, "row long, slot int, score long, null boolean, id long, found long"), "found")
        whole = stored(packs.select("row", "all").mapInArrow(_flags, "row long, whole boolean"), "whole")
    return found, whole


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows, flags = (b"".join(b.column(i).to_pylist()) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(rows, np.int64)), pa.array(np.frombuffer(flags, np.uint8).astype(bool))], names=["row", "whole"])


def search(queries: DataFrame, blocks: DataFrame, space: Space, same: bool, keep: int, start: float | None = None, growth: float = 4.0, per: int = QUERIES, share: int = SHARE) -> DataFrame:
    """row, slot, rank (from 1), score, id: the ``keep`` best rows of every slot of every query, certified.

    ``queries``: row, id, label, vec, pivot, key, length (squared), slots (array
    of [least, most] scores wanted).  ``same``: rows of the query's label, or
    of the others.  The first radius is ``start``, or what the nearest wanted
    score needs.
    """
    spans_ = {r.pivot: (r.lo, r.hi) for r in blocks.groupBy("pivot").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()}  # a row a pivot
    spans = tuple(np.array([spans_.get(k, (np.inf, -np.inf))[i] for k in range(len(space.pivots))]) for i in (0, 1))
    away = lambda score: F.sqrt(F.greatest(F.col("length") + F.lit(space.most) - 2 * score.cast("double"), F.lit(0.0)))
    more = lambda x: x * F.lit(1 + ROOM) + F.lit(ROOM * (1 + space.most**0.5))  # noqa: E731  on the safe side
    top = F.array_max(F.transform("slots", lambda s: s[1]))
    near = away(top) * F.lit(1 - ROOM) - F.lit(ROOM * (1 + space.most**0.5))
    open_ = queries.select("*", F.lit(-1.0).alias("r0"), (F.lit(start) if start is not None else more(away(top))).alias("r1"), near.alias("near"))
    open_ = open_.withColumn("slots", F.transform("slots", lambda s: F.array(s[0], s[1], s[0])))
    open_, best = stored(open_, "open"), None
    first = Window.partitionBy("row", "slot").orderBy(F.col("score").desc(), "null", "id", "found")
    while not open_.isEmpty():
        found, whole = _round(open_, blocks, space, spans, same, keep, per, share)
        best = found if best is None else best.unionByName(found)
        best = stored(best.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= keep).drop("rank"), "best")
        # of each slot: the last wanted score, once there are enough
        last = best.groupBy("row", "slot").agg(F.min("score").alias("last"), F.count("*").alias("n")).where(F.col("n") == keep)
        last = last.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("slot", "last"))).alias("last"))  # at most a query's slots
        now = open_.join(whole, "row").join(last, "row", "left")
        slots = F.transform("slots", lambda s, i: F.array(s[0], s[1], F.greatest(s[0], F.coalesce(F.col("last")[i], s[0]))))
        now = now.withColumn("slots", slots).withColumn("need", more(away(F.array_min(F.transform("slots", lambda s: s[2])))))
        now = now.where(~F.col("whole") & (F.col("r1") < F.col("need"))).withColumn("r0", F.col("r1")).withColumn("r1", F.least(F.col("r1") * growth, F.col("need")))
        open_ = stored(now.select(open_.columns), "open")
    if best is None:
        return queries.sparkSession.createDataFrame([], "row long, slot int, rank int, score long, id long")
    return best.select("row", "slot", F.row_number().over(first).alias("rank"), "score", F.when(~F.col("null"), F.col("id")).alias("id"))


def mine(vectors: DataFrame, anchor: F.Column, label: F.Column | None = None, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0, pivots: int = 64, block: int = BLOCK, per: int = QUERIES, share: int = SHARE) -> DataFrame:
    """anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score, anchor_row.

    ``vectors``: vec_id, embedding, label; ``anchor``: which rows are anchors;
    ``label``: an expression in place of the column; ``low``, ``high``: per cent of the positive's score.
    """
    spark = vectors.sparkSession
    rows = whole_numbers(vectors, scale, F.col("label") if label is None else label, anchor)
    space = Space(rows, pivots)
    none = "anchor_id long, positive_id long, positive_rank int, rank int, negative_id long, positive_score long, negative_score long, anchor_row long"
    if not space.n:
        return spark.createDataFrame([], none)
    known = keyed(rows, space)
    blocks = index(known, space, block)
    anchors = known.where("anchor").join(rows.select("row", F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")).alias("length")), "row")
    anchors = stored(anchors.select("row", "id", "label", "vec", "pivot", "key", "length"), "anchors")
    least, most = -(1 << 62), 1 << 62
    spread = known.groupBy("pivot").agg(F.stddev_pop("key").alias("s"), F.count("*").alias("n")).agg(F.sum(F.col("s") * F.col("n")) / F.sum("n")).first()[0]
    wide = anchors.withColumn("slots", F.array(F.array(F.lit(least), F.lit(most))))
    got = stored(search(wide, blocks, space, True, positives, max(spread / 2, 1e-6), per=per, share=share), "positives").drop("slot")
    # the windows of an anchor's positives; a negative positive's window is empty
    score = F.col("score").cast("decimal(20,0)")
    up, down = F.floor(score * high / 100).cast("long"), F.ceil(score * low / 100).cast("long")
    window = got.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", down.alias("least"), up.alias("most")))).alias("w"))  # at most ``positives``
    bound = lambda k: F.get("w", k - 1)
    slot = lambda k: F.when(bound(k)["least"] <= bound(k)["most"], F.array(bound(k)["least"], bound(k)["most"])).otherwise(F.array(F.lit(most), F.lit(least)))
    asks = anchors.join(window, "row").withColumn("slots", F.transform(F.sequence(F.lit(1), F.lit(positives)), slot))
    asks = asks.where(F.exists("slots", lambda s: s[0] <= s[1])).drop("w")
    far = stored(search(asks, blocks, space, False, negatives, None, per=per, share=share), "negatives")
    pairs = far.select("row", (F.col("slot") + 1).alias("positive_rank"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    near = got.select("row", F.col("rank").alias("positive_rank"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = near.join(pairs, ["row", "positive_rank"]).join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
    return out.select("anchor_id", "positive_id", "positive_rank", "rank", "negative_id", "positive_score", "negative_score", F.col("row").alias("anchor_row"))
