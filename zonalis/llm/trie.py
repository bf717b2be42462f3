"""The prefix trie of conversations, from the Cartesian tree over their sorted order.

A turn is 128 bits of SHA-256 over its role and text, a conversation the
digests of its turns one after the other, so that sorting those bytes puts
conversations of a common prefix side by side.  Equal conversations are one
*content*.  L[i] is the number of leading turns that content i shares with
the one before it (-1 at both ends).

The trie's branching nodes are the Cartesian tree of L with equal values merged:
i belongs to the node of depth L[i] over the contents from the nearest smaller
value on its left up to the one on its right.  Nearest smaller values are found
in parallel: by a stack inside blocks of positions, and past a block's end by
the blocks' minima, which tell the block to look in, and that block's
staircase of values that nothing lower hides.  Positions of one node are merged
by counting.  Depths without a branch, between a node and its parent, are
filled in, and the chain of turns that only one content has hangs below.

Members, leaves and shared tokens of a node are differences of running sums
over the sorted order; its smallest member is a minimum over blocks.

``trie`` gives a row per distinct prefix: conv_id (its smallest member), depth,
parent_conv_id (the parent's conv_id; null at the root), n_convs, n_children,
n_leaves (childless nodes at or below it), saved_tokens (over its subtree, each
node's members but one, times the code points of its last text), ends
(conversations that end there), ends_sha256 (of their decimal ids, rising and
comma-joined), role and text_chars of its last turn.

Turns are ordered by ``turn`` (null first), then role, the first 64 characters of
the text and its digest; a null role or text is empty; rows without a conv_id belong to no conversation.  Repeated rows
are turns of their own.  The digests of one conversation are one row, 16 bytes a turn;
texts are not gathered.  The ids of a group of equal conversations are joined
in bounded pieces before one task digests them.  Extra columns are ignored,
whatever their names; an empty table has no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_text, shuffle_partitions, stored

#: Bytes of a turn's digest.
DIGEST = 16
#: Positions of a block at least, and blocks at most: the blocks' minima are all that reaches the driver.
BLOCK, BLOCKS = 1 << 16, 1 << 16
#: Ids that are joined to one piece.
PIECE = 4096


def gathered(conversations: DataFrame) -> DataFrame:
    """conv_id, turns (array of digest, chars, role) in order."""
    role, text = F.coalesce(as_text("role"), F.lit("")), F.coalesce(as_text("text"), F.lit(""))
    some = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    digest = F.substring(F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), F.concat("role", "text")), 256)), 1, DIGEST)
    # whole texts stay out of the groups: ties of a turn number go by role, the text's start and the digest
    turns = some.select("conv_id", F.struct(F.col("turn").isNotNull().alias("told"), "turn", "role", F.substring("text", 1, 64).alias("start"), digest.alias("digest"), F.length("text").cast("long").alias("chars")).alias("t"))
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t")).select("conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"), t["role"].alias("role"))).alias("turns"))


def rebuilt(conversations: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """conv_id, turns: each conversation c begins with the first h turns of c - c % ``every`` and goes on with its own after its first h; h = crc32(c) % ``most``."""
    own = stored(gathered(conversations), "gathered")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    some = own.select("conv_id", "turns", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    first = own.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("first"))
    joined = some.join(first, "base", "left")
    begin = F.coalesce(F.slice("first", F.lit(1), F.col("h")), F.array().cast("array<struct<digest: binary, chars: bigint, role: string>>"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return joined.select("conv_id", F.concat(begin, rest).alias("turns"))


# --- the sorted order ------------------------------------------------------------------------------


def shared(a: bytes, b: bytes) -> int:
    """Leading turns that two keys share."""
    n = min(len(a), len(b)) // DIGEST
    x, y = (np.frombuffer(k, np.uint8, n * DIGEST).reshape(n, DIGEST) for k in (a, b))
    return int(np.argmin(np.append((x == y).all(axis=1), False)))


def _lcps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted contents with their place in the partition and the turns shared with the last and the next one (-2: in another partition)."""
    part, place, before, waiting = TaskContext.get().partitionId(), 0, None, None

    def row(key, content, lcp, after):
        return (part, place, content, lcp, after, key)

    def made(rows):
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["part", "place", "content", "lcp", "after", "key"])

    out = []
    for b in batches:
        for key, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            lcp = -2 if waiting is None else shared(waiting[0], key)
            if waiting is not None:
                out.append(row(*waiting, lcp))
                place += 1
            waiting = (key, content, lcp)
            # only the keys at a partition's ends go on
            if len(out) >= 1000:
                yield made([r if r[3] == -2 else (*r[:5], None) for r in out])
                out = []
    if waiting is not None:
        out.append(row(*waiting, -2))
        yield made([r if -2 in (r[3], r[4]) else (*r[:5], None) for r in out])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [shared(x, y) for x, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.int64())], names=["part", "lcp"])


def contents_of(convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct contents (content: a lasting number, key, turns, n, low) and the members (conv_id, content)."""
    keyed = stored(convs.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")).alias("key"), "turns"), "keyed")
    groups = keyed.groupBy("key").agg(F.first("turns").alias("turns"), F.count("*").alias("n"), F.min("conv_id").alias("low"))
    contents = stored(groups.select(F.monotonically_increasing_id().alias("content"), "*"), "contents")
    return contents, stored(keyed.select("conv_id", "key").join(contents.select("key", "content"), "key").select("conv_id", "content"), "members")


def ordered(contents: DataFrame) -> tuple[DataFrame, int]:
    """content, pos, lcp (with the one before), after (with the next one), and how many there are."""
    spark = contents.sparkSession
    rows = contents.select("key", "content").repartitionByRange(shuffle_partitions(spark), "key").sortWithinPartitions("key")
    rows = stored(rows.mapInArrow(_lcps, "part int, place long, content long, lcp long, after long, key binary"), "sorted")
    counts = dict(sorted(tuple(r) for r in rows.groupBy("part").agg(F.count("*")).collect()))  # a number a partition
    if not counts:
        return rows.select("content", F.col("place").alias("pos"), "lcp", "after"), 0
    parts, begin, at = list(counts), {}, 0
    for p in parts:
        begin[p], at = at, at + counts[p]
    steps = spark.createDataFrame([(p, begin[p], q) for p, q in zip(parts, [*parts[1:], None])], "part int, begin long, next int")
    last = rows.where("after = -2").join(steps, "part").select(F.col("next").alias("part"), F.col("key").alias("x"))
    pairs = rows.where("lcp = -2").select("part", F.col("key").alias("y")).join(last, "part").select("part", "x", "y")
    ends = {r.part: r.lcp for r in pairs.mapInArrow(_ends, "part int, lcp long").collect()}  # a number a partition
    steps = spark.createDataFrame([(p, begin[p], ends.get(p, -1), ends.get(q, -1)) for p, q in zip(parts, [*parts[1:], None])], "part int, begin long, first long, last long")
    got = rows.drop("key").join(F.broadcast(steps), "part")  # a row a partition
    fixed = lambda c, end: F.when(F.col(c) == -2, F.col(end)).otherwise(F.col(c)).alias(c)
    return got.select("content", (F.col("begin") + F.col("place")).alias("pos"), fixed("lcp", "first"), fixed("after", "last")), at


# --- nearest smaller values ------------------------------------------------------------------------


def smaller(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest smaller value's place on the left (-1: none) and on the right (len: none)."""
    n = len(values)
    left, right, stack = np.full(n, -1, np.int64), np.full(n, n, np.int64), []
    for i, v in enumerate(values.tolist()):
        while stack and stack[-1][1] > v:
            right[stack.pop()[0]] = i
        equal = stack and stack[-1][1] == v
        left[i] = left[stack[-1][0]] if equal else stack[-1][0] if stack else -1
        stack.append((i, v))
    return left, right


class Minima:
    """Least values of ranges, by doubling tables."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 << (len(self.rows) - 1) <= len(values):
            x, k = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(x[:-k], x[k:]))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of each non-empty range [start, end)."""
        k = np.frexp((end - start).astype(np.float64))[1] - 1
        out = np.empty(len(start), self.rows[0].dtype)
        for j in np.unique(k):
            m = k == j
            out[m] = np.minimum(self.rows[j][start[m]], self.rows[j][end[m] - (1 << int(j))])
        return out


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one block after the other; they come sorted by block and position."""
    held: list[pa.Table] = []
    for b in batches:
        t = pa.Table.from_batches([b])
        block = t["block"].to_numpy()
        cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        for a, z in zip(cuts, cuts[1:]):
            if held and z > a and held[0]["block"][0].as_py() != block[a]:
                yield pa.concat_tables(held).combine_chunks()
                held = []
            if z > a:
                held.append(t.slice(a, z - a))
    if held:
        yield pa.concat_tables(held).combine_chunks()


_SUMS = ("n", "weight", "new", "leaf")


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block: its least value and member, its sums, and both staircases (values that nothing lower hides from an end, with their positions)."""
    stair = pa.list_(pa.struct([("v", pa.int64()), ("pos", pa.int64())]))
    for t in _by_block(batches):
        v, pos = t["lcp"].to_numpy(), t["pos"].to_numpy()
        sides = []
        for x, p in ((v, pos), (v[::-1], pos[::-1])):
            low = np.minimum.accumulate(x)
            at = np.flatnonzero(np.concatenate([[True], low[1:] < low[:-1]]))
            sides.append([{"v": int(x[i]), "pos": int(p[i])} for i in at])
        cols = [[t["block"][0].as_py()], [int(v.min())], [int(t["low"].to_numpy().min())], *([int(t[c].to_numpy().sum())] for c in _SUMS)]
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), pa.array([sides[0]], stair), pa.array([sides[1]], stair)], names=["block", "least", "low", *_SUMS, "from_left", "from_right"])


def _nearest(minima: np.ndarray, block: int, values: np.ndarray, left: bool) -> list:
    """The nearest block on one side with a value below each of ``values`` (None: there is none)."""
    side = minima[:block][::-1] if left else minima[block + 1 :]
    low = np.minimum.accumulate(side) if len(side) else side
    at = np.searchsorted(-low, -values, "right")
    return [None if i == len(side) else int(block - 1 - i if left else block + 1 + i) for i in at.tolist()]


def intervals(places: DataFrame, minima: np.ndarray) -> DataFrame:
    """pos, v, l, r, low: the nearest smaller values of every position but the first.

    Where one is in another block, l or r is null and to_left or to_right names the
    block; low (the least member of [l, r)) is told where both are in the block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _by_block(batches):
            block, v, pos = t["block"][0].as_py(), t["lcp"].to_numpy(), t["pos"].to_numpy()
            l_, r_ = smaller(v)
            n, out = len(v), v >= 0  # the first position of all has no one before it
            in_l, in_r = l_ >= 0, r_ < n
            low = np.zeros(n, np.int64)
            both = in_l & in_r
            if both.any():
                low[both] = Minima(t["low"].to_numpy()).of(l_[both], r_[both])
            sides = []
            for inside, left in ((in_l, True), (in_r, False)):
                to = np.full(n, None, object)
                need = np.flatnonzero(~inside & out)
                some, back = np.unique(v[need], return_inverse=True)
                to[need] = np.array(_nearest(minima, block, some, left), object)[back] if len(need) else None
                sides.append(to)
            col = lambda x, keep: pa.array(x, pa.int64(), mask=~keep)
            got = pa.RecordBatch.from_arrays([pa.array(pos, pa.int64()), pa.array(v, pa.int64()), col(pos[np.maximum(l_, 0)], in_l), col(pos[np.minimum(r_, n - 1)], in_r), col(low, both), pa.array(sides[0].tolist(), pa.int64()), pa.array(sides[1].tolist(), pa.int64())], names=["pos", "v", "l", "r", "low", "to_left", "to_right"])
            yield got.filter(pa.array(out))

    return places.mapInArrow(run, "pos long, v long, l long, r long, low long, to_left long, to_right long")


# --- the trie --------------------------------------------------------------------------------------


def _ids(members: DataFrame, piece: int) -> DataFrame:
    """content, ends_sha256: of the members' ids, joined in pieces of ``piece`` that are made apart and digested one after the other."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c, ids = b.column(0).to_numpy(), b.column(1).to_pylist()
            cuts = [0, *(np.flatnonzero(c[1:] != c[:-1]) + 1).tolist(), len(c)]
            some = [(int(c[i]), ids[i], ",".join(map(str, ids[i : min(i + piece, z)]))) for a, z in zip(cuts, cuts[1:]) for i in range(a, z, piece)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*some) if some else ([], [], []), (pa.int64(), pa.int64(), pa.string()))], names=["content", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sha = None, None
        for b in batches:
            out = []
            for content, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if content != last:
                    if last is not None:
                        out.append((last, sha.hexdigest()))
                    last, sha = content, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.string()))], names=["content", "ends_sha256"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([sha.hexdigest()])], names=["content", "ends_sha256"])

    n = shuffle_partitions(members.sparkSession)
    # ranges of content and id: a large group fills several partitions
    joined = stored(members.select("content", "conv_id").repartitionByRange(n, "content", "conv_id").sortWithinPartitions("content", "conv_id").mapInArrow(pieces, "content long, first long, ids string"), "pieces")
    return joined.repartition(n, "content").sortWithinPartitions("content", "first").mapInArrow(digests, "content long, ends_sha256 string")


def trie(convs: DataFrame, block: int = BLOCK, blocks: int = BLOCKS, piece: int = PIECE) -> DataFrame:
    """The nodes, as the module says; ``convs``: conv_id, turns (see ``gathered``)."""
    spark = convs.sparkSession
    contents, members = contents_of(convs)
    order, m = ordered(contents)
    chars = lambda to: F.aggregate(F.slice("turns", F.lit(1), to), F.lit(0).cast("long"), lambda s, t: s + t["chars"])
    length, size = F.size("turns").cast("long"), max(block, -(-m // blocks))
    # per position: length, members, the tokens of all of them, of the turns that are new to the order, and whether it ends at a leaf
    places = order.join(contents.drop("key"), "content").select(
        "pos", (F.col("pos") / size).cast("long").alias("block"), "content", "lcp", "after", length.alias("len"), "n", "low", (F.col("n") * chars(F.size("turns"))).alias("weight"),
        (chars(F.size("turns")) - chars(F.greatest(F.col("lcp"), F.lit(0)).cast("int"))).alias("new"), (F.greatest("lcp", "after") < length).cast("long").alias("leaf"), "turns",
    )
    places = stored(places, "places")
    slim = places.select("block", "pos", "lcp", "low", *_SUMS).repartition(shuffle_partitions(spark), "block").sortWithinPartitions("block", "pos")
    stairs = stored(slim.mapInArrow(_summary, "block long, least long, low long, " + "".join(f"{c} long, " for c in _SUMS) + "from_left array<struct<v: long, pos: long>>, from_right array<struct<v: long, pos: long>>"), "stairs")
    top = stairs.select("block", "least", "low", *_SUMS).orderBy("block").collect()  # ``blocks`` rows at most
    least, low = (np.array([r[i] for r in top], np.int64) for i in (1, 2))

    # running sums over all positions: a block's own and those of the blocks before it
    before = np.cumsum([[0] * len(_SUMS), *([r[c] for c in _SUMS] for r in top)], axis=0).tolist()
    begin = spark.createDataFrame([(b, *map(int, before[b])) for b in range(len(top))], "block long, " + ", ".join(f"{c}_0 long" for c in _SUMS))
    row = Window.partitionBy("block").orderBy("pos")
    back = Window.partitionBy("block").orderBy(F.col("pos").desc())
    sums = places.join(F.broadcast(begin), "block").select("pos", "block", "lcp", "after", "len", "new", "low", *((F.sum(c).over(row) + F.col(f"{c}_0")).alias(f"to_{c}") for c in _SUMS), *(F.col(c).alias(f"own_{c}") for c in _SUMS if c != "new"), F.min("low").over(row).alias("low_left"), F.min("low").over(back).alias("low_right"))
    sums = stored(sums, "sums")

    # every position's node, as the interval of its contents
    at = intervals(slim, least).alias("i")
    lows = stairs.select(F.col("block").alias("to_left"), "from_right").alias("a")
    highs = stairs.select(F.col("block").alias("to_right"), "from_left").alias("b")
    under = lambda side: F.filter(side, lambda s: s["v"] < F.col("v"))
    met = at.join(lows, "to_left", "left").join(highs, "to_right", "left").select(
        F.col("i.pos").alias("pos"), "v", F.coalesce("l", F.array_max(F.transform(under("from_right"), lambda s: s["pos"]))).alias("l"),
        F.coalesce("r", F.array_min(F.transform(under("from_left"), lambda s: s["pos"])), F.lit(m)).alias("r"), "low",
    )
    met = stored(met, "intervals")
    nodes = met.groupBy("l", "r", "v").agg(F.count("*").alias("equal"), F.min("low").alias("low"))

    @F.pandas_udf("long")
    def between(a, b):
        """The least member of the blocks [a, b)."""
        return _range_minima(low, a, b)

    ends = lambda side, alias: sums.select(F.col("pos").alias(side), *(F.col(c).alias(f"{alias}_{c}") for c in sums.columns if c != "pos"))
    inner = nodes.withColumn("z", F.col("r") - 1).join(ends("l", "l"), "l").join(ends("z", "z"), "z")
    whole = F.least("l_low_right", F.when(F.col("l_block") < F.col("z_block"), F.col("z_low_left")), between(F.col("l_block") + 1, F.col("z_block")))
    edge = inner.select(
        "l", "r", F.greatest("l_lcp", "z_after").alias("u"), "v", F.when(F.col("l_lcp") >= F.col("z_after"), F.col("l")).otherwise(F.col("r")).alias("up"), F.coalesce("low", whole).alias("conv_id"),
        *((F.col(f"z_to_{c}") - F.col(f"l_to_{c}") + F.col(f"l_{'new' if c == 'new' else 'own_' + c}")).alias(c) for c in _SUMS), F.col("l_new").alias("first_new"),
        (F.col("equal") + 1 - (F.col("l_len") == F.col("v")).cast("long")).alias("n_children"), (F.col("l_len") == F.col("v")).alias("ends_here"),
    )
    inner = stored(edge, "inner")
    chain = sums.where("own_leaf = 1").select(
        F.col("pos").alias("l"), (F.col("pos") + 1).alias("r"), F.greatest("lcp", "after").alias("u"), F.col("len").alias("v"), F.when(F.col("lcp") >= F.col("after"), F.col("pos")).otherwise(F.col("pos") + 1).alias("up"),
        F.col("low").alias("conv_id"), F.col("own_n").alias("n"), F.col("own_weight").alias("weight"), "new", F.col("own_leaf").alias("leaf"), F.col("new").alias("first_new"), F.lit(0).cast("long").alias("n_children"), F.lit(True).alias("ends_here"),
    )
    edges = inner.unionByName(chain)
    above = met.select(F.col("pos").alias("up"), "l", "r").join(inner.select("l", "r", F.col("conv_id").alias("above")), ["l", "r"]).select("up", "above")
    edges = edges.join(above, "up", "left")

    # one node for each depth of an edge; node (l, d) is the one that content l is the first to have
    nodes = edges.select("*", F.explode(F.sequence(F.col("u") + 1, F.col("v"))).alias("depth"))
    turns = places.select(F.col("pos").alias("l"), "content", F.col("lcp"), "turns")
    steps = F.transform(F.sequence(F.lit(0), F.size("turns")), lambda d: F.struct(d.cast("long").alias("depth"), F.when(d > 0, F.get("turns", d - 1)["chars"]).otherwise(F.lit(0)).alias("chars"), F.when(d > 0, F.get("turns", d - 1)["role"]).alias("role")))
    own = turns.select("l", "content", "lcp", F.explode(steps).alias("s")).select("l", "content", "lcp", "s.*")
    upto = Window.partitionBy("l").orderBy("depth")
    own = own.withColumn("total", F.sum("chars").over(upto)).where(F.col("depth") > F.col("lcp"))
    own = own.withColumn("shared", F.min(F.col("total") - F.col("chars")).over(Window.partitionBy("l")))  # of the turns above the first new one
    text = F.col("total") - F.col("chars")  # of the turns above the node
    full = nodes.join(own, ["l", "depth"])
    last = F.col("depth") == F.col("v")
    # what content l brings to the subtree are all its turns from the node on, not only the new ones
    since = F.col("first_new") - (text - F.col("shared"))
    saved = F.col("weight") - F.col("n") * text - (F.col("new") - F.col("first_new") + since)
    empty = hashlib.sha256(b"").hexdigest()
    out = full.select(
        "conv_id", "depth", F.when(F.col("depth") > F.col("u") + 1, F.col("conv_id")).otherwise(F.col("above")).alias("parent_conv_id"), F.col("n").alias("n_convs"), F.when(last, F.col("n_children")).otherwise(F.lit(1).cast("long")).alias("n_children"),
        F.col("leaf").alias("n_leaves"), saved.alias("saved_tokens"), F.when(last & F.col("ends_here"), F.col("content")).alias("content"), "role", F.col("chars").alias("text_chars"),
    )
    ids = stored(_ids(members, piece), "ids").join(contents.select("content", F.col("n").alias("ends")), "content")
    out = out.join(ids, "content", "left").drop("content")
    return out.withColumn("ends", F.coalesce("ends", F.lit(0).cast("long"))).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(empty)))


def _range_minima(values: np.ndarray, a, b):
    import pandas as pd

    x, y = a.to_numpy().astype(np.int64), b.to_numpy().astype(np.int64)
    out = np.full(len(x), np.iinfo(np.int64).max, np.int64)
    some = y > x
    if some.any():
        out[some] = Minima(values).of(x[some], y[some])
    return pd.Series(out)
