"""Cubes (period, variable, y, x) stored in chunks.

A chunk is a row: one period, one variable, a square of pixels, and three
layers packed as bytes: ``cleaned`` (32-bit floats, NaN for missing), ``observed``
and ``temporal`` (a byte each).  Chunks lie in folders by period and
variable, their places are columns, so that a filter on periods or variables prunes
folders and one on y or x prunes chunks before a pixel is unpacked.  A task
holds one chunk at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names under which a dimension may come (fixed values).
ALIASES = {"t": ("t", "time", "temporal"), "x": ("x", "longitude", "lon", "easting"), "y": ("y", "latitude", "lat", "northing")}
_LAYERS = (("cleaned", np.float32), ("observed", np.uint8), ("temporal", np.uint8))


def dimension(columns: list[str], role: str) -> str:
    """The column that stands for a dimension, whatever its case."""
    known = {c.lower(): c for c in columns}
    for name in ALIASES[role]:
        if name in known:
            return known[name]
    raise ValueError(f"no {role} dimension among {columns}; looked for {list(ALIASES[role])}")


def long_form(df: DataFrame, variables: list[str], labels: str | None = None, value: str = "value") -> DataFrame:
    """period, variable, y, x, value from columns named like ``variables`` or from a column of ``labels``; names in any case, given back as in ``variables``."""
    t, y, x = (dimension(df.columns, r) for r in ("t", "y", "x"))
    core = [F.col(t).cast("string").alias("period"), F.col(y).cast("long").alias("y"), F.col(x).cast("long").alias("x")]
    known = {c.upper(): c for c in df.columns}
    if all(v.upper() in known for v in variables):
        stack = F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(known[v.upper()]).cast("float").alias("value")) for v in variables]))
        return df.select(*core, stack.alias("s")).select("period", "s.variable", "y", "x", "s.value")
    if labels and labels in df.columns:
        name = F.create_map(*[z for v in variables for z in (F.lit(v.upper()), F.lit(v))])[F.upper(labels)]
        return df.select(*core[:1], name.alias("variable"), *core[1:], F.col(value).cast("float").alias("value")).where("variable is not null")
    raise ValueError(f"columns {df.columns} hold neither all of {variables} nor labels of them")


def write(df: DataFrame, path: str, size: int = 256) -> None:
    """Writes period, variable, y, x, cleaned (and observed, temporal: booleans) in chunks of ``size`` x ``size`` pixels.

    Pixels that ``df`` doesn't have are missing and unobserved; of repeated
    ones the last counts.  A chunk's pixels are a bounded group.
    """
    flag = lambda c, d: F.coalesce(F.col(c), F.lit(d)) if c in df.columns else F.lit(d)
    some = df.select("period", "variable", F.floor(F.col("y") / size).alias("cy"), F.floor(F.col("x") / size).alias("cx"), F.pmod(F.col("y"), F.lit(size)).cast("int").alias("i"), F.pmod(F.col("x"), F.lit(size)).cast("int").alias("j"), F.col("cleaned").cast("float").alias("cleaned"), flag("observed", False).cast("byte").alias("observed"), flag("temporal", False).cast("byte").alias("temporal"))

    def pack(table: pa.Table) -> pa.Table:
        at = table["i"].to_numpy().astype(np.int64) * size + table["j"].to_numpy()
        out = {c: [table[c][0].as_py()] for c in ("period", "variable", "cy", "cx")}
        for name, kind in _LAYERS:
            layer = np.full(size * size, np.nan if kind is np.float32 else 0, kind)
            layer[at] = table[name].to_numpy()
            out[name] = [layer.tobytes()]
        return pa.table({k: pa.array(v, pa.binary() if k in dict(_LAYERS) else pa.int64() if k in ("cy", "cx") else pa.string()) for k, v in out.items()})

    chunks = some.groupBy("period", "variable", "cy", "cx").applyInArrow(pack, "period string, variable string, cy long, cx long, cleaned binary, observed binary, temporal binary")
    chunks = chunks.withColumn("size", F.lit(size))
    chunks.repartition("period", "variable", "cy", "cx").sortWithinPartitions("period", "variable", "cy", "cx").write.partitionBy("period", "variable").parquet(path)


def chunks(spark: SparkSession, path: str, periods: list[str] | None = None, variables: list[str] | None = None, y: tuple[int, int] | None = None, x: tuple[int, int] | None = None) -> DataFrame:
    """The chunks that a window (half-open in y and x) meets."""
    df = spark.read.schema("size int, cy long, cx long, cleaned binary, observed binary, temporal binary, period string, variable string").parquet(path)
    for column, wanted in (("period", periods), ("variable", variables)):
        if wanted is not None:
            df = df.where(F.col(column).isin(*wanted))
    head = df.select("size").first() if y or x else None  # the same in every chunk
    for column, span in (("cy", y), ("cx", x)):
        if head and span is not None:
            df = df.where(F.col(column).between(span[0] // head.size, (span[1] - 1) // head.size))
    return df


def read(spark: SparkSession, path: str, periods: list[str] | None = None, variables: list[str] | None = None, y: tuple[int, int] | None = None, x: tuple[int, int] | None = None, missing: bool = False) -> DataFrame:
    """period, variable, y, x, cleaned (null for missing), observed, temporal of a window's pixels; pixels without a value only with ``missing``."""
    some = chunks(spark, path, periods, variables, y, x)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = {n: b.column(n)[i].as_py() for n in b.schema.names}
                size = r["size"]
                got = {n: np.frombuffer(r[n], k).reshape(size, size) for n, k in _LAYERS}
                top, left = r["cy"] * size, r["cx"] * size
                rows = slice(max((y or (top,))[0] - top, 0), min((y[1] if y else top + size) - top, size))
                cols = slice(max((x or (left,))[0] - left, 0), min((x[1] if x else left + size) - left, size))
                if rows.start >= rows.stop or cols.start >= cols.stop:
                    continue
                cut = {n: v[rows, cols].ravel() for n, v in got.items()}
                yy, xx = (v.ravel() for v in np.meshgrid(np.arange(rows.start, rows.stop) + top, np.arange(cols.start, cols.stop) + left, indexing="ij"))
                keep = np.full(len(yy), True) if missing else ~np.isnan(cut["cleaned"])
                n = int(keep.sum())
                value = cut["cleaned"][keep]
                yield pa.RecordBatch.from_arrays([pa.array([r["period"]] * n, pa.string()), pa.array([r["variable"]] * n, pa.string()), pa.array(yy[keep], pa.int64()), pa.array(xx[keep], pa.int64()), pa.array(value, pa.float32(), mask=np.isnan(value)), *(pa.array(cut[c][keep].astype(bool)) for c in ("observed", "temporal"))], names=["period", "variable", "y", "x", "cleaned", "observed", "temporal"])

    return some.mapInArrow(unpack, "period string, variable string, y long, x long, cleaned float, observed boolean, temporal boolean")
