"""Verified publishing: data in a folder of its own, then a manifest that names it.

A manifest is written last and renamed into place, and readers go by it alone, so a
run that dies leaves nothing readable behind, and a result is either whole or
absent.  It holds the input's signature, the row count and an order-free digest of
the keys: a repeated run with the same input finds its result and does nothing.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import signature

MANIFEST = "manifest.json"


class NotPublished(LookupError):
    """There is no whole result under a path."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _write(spark: SparkSession, path: str, text: str) -> None:
    """A small file under a name of its own, then renamed; the name it replaces goes first."""
    partial = f"{path}.{os.urandom(6).hex()}.partial"
    fs, at = _fs(spark, partial)
    out = fs.create(at, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    _, to = _fs(spark, path)
    fs.delete(to, False)
    if not fs.rename(at, to):
        raise OSError(f"could not publish {path}")


def manifest(spark: SparkSession, path: str) -> dict | None:
    """What is published under ``path``, or None."""
    fs, at = _fs(spark, f"{path}/{MANIFEST}")
    if not fs.exists(at):
        return None
    text = "".join(r.value for r in spark.read.text(str(at), wholetext=True).collect())  # one small file
    return json.loads(text)


def keys_digest(df: DataFrame, keys: list[str]) -> tuple[int, str]:
    """Rows, and the sum of the hashes of their keys."""
    r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*keys).cast("decimal(38,0)")).alias("s")).first()
    return r["n"], str(r["s"] or 0)


def exact_cover(got: DataFrame, wanted: DataFrame, keys: list[str], shown: int = 10) -> None:
    """An error unless ``got`` has each key of ``wanted`` once and no other; names a few."""
    both = got.groupBy(*keys).agg(F.count("*").alias("_g")).join(wanted.select(*keys).distinct().withColumn("_w", F.lit(1)), keys, "full_outer")
    kind = F.when(F.col("_g").isNull(), "lost").when(F.col("_w").isNull(), "unexpected").when(F.col("_g") > 1, "repeated")
    bad = both.withColumn("fault", kind).where("fault is not null").select("fault", *keys).orderBy("fault", *keys).limit(shown).collect()
    if bad:
        raise ValueError("keys don't match: " + "; ".join(f"{r['fault']} {[r[k] for k in keys]}" for r in bad))


def publish(spark: SparkSession, path: str, keys: list[str], make: Callable[[], DataFrame], inputs: list[DataFrame] | None = None, wanted: DataFrame | None = None, options: dict | None = None, report: Callable[[DataFrame], DataFrame] | None = None, overwrite: bool = False) -> DataFrame:
    """The result of ``make`` under ``path``: made, checked and published, or found there.

    ``inputs`` and ``options`` make the signature.  A result of another
    signature is an error, or replaced with ``overwrite``; its data go after
    the new manifest stands.  ``wanted``: the keys that the result must have
    exactly.  ``report``: a table about the result, stored before it.
    """
    sign = json.dumps([[signature(d) for d in inputs or []], options or {}], sort_keys=True, default=str)
    there = manifest(spark, path)
    if there and there["signature"] == sign:
        return published(spark, path)
    if there and not overwrite:
        raise FileExistsError(f"{path} holds another result")
    name = f"data-{os.urandom(6).hex()}"
    made = make()
    made.write.parquet(f"{path}/{name}")
    stored = spark.read.schema(made.schema).parquet(f"{path}/{name}")  # what is checked is what was written
    if wanted is not None:
        exact_cover(stored, wanted, keys)
    n, digest = keys_digest(stored, keys)
    if report is not None:
        report(stored).write.parquet(f"{path}/report-{name}")
    _write(spark, f"{path}/{MANIFEST}", json.dumps({"data": name, "report": f"report-{name}" if report else None, "signature": sign, "keys": keys, "rows": n, "digest": digest, "schema": json.loads(made.schema.json())}))
    for old in (there or {}).get("data"), (there or {}).get("report"):
        if old:
            fs, at = _fs(spark, f"{path}/{old}")
            fs.delete(at, True)
    return stored


def published(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """The published table; with ``check``, an error if its rows or keys are not those that were published."""
    from pyspark.sql.types import StructType

    m = manifest(spark, path)
    if m is None:
        raise NotPublished(path)
    df = spark.read.schema(StructType.fromJson(m["schema"])).parquet(f"{path}/{m['data']}")
    if check and list(keys_digest(df, m["keys"])) != [m["rows"], m["digest"]]:
        raise ValueError(f"{path} has other keys than were published")
    return df


def merged(spark: SparkSession, paths: dict[int, str], wanted: DataFrame, keys: list[str]) -> DataFrame:
    """All published parts with their number, which together must have each wanted key once."""
    out = None
    for number, path in sorted(paths.items()):
        part = published(spark, path).withColumn("partition_number", F.lit(number))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no parts")
    exact_cover(out, wanted, keys)
    return out
