"""Readers and writers by file kind, typed CSV headers, JSON features, partition folders, signatures."""

from __future__ import annotations

import re
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names of column types in typed headers and sidecars, and Spark's.
TYPES = {"int64": "bigint", "int32": "int", "int": "bigint", "integer": "bigint", "float64": "double", "float32": "float", "float": "double", "real": "double", "bool": "boolean", "boolean": "boolean", "object": "string", "str": "string", "string": "string", "category": "string", "datetime64[ns]": "timestamp_ntz", "date": "date"}
_TYPED = re.compile(r"^(.*\S)\s*\{([^{}]+)\}$")


def typed_header(names: list[str]) -> str | None:
    """Schema, as DDL, of headers ``name {type}``; None unless every header has braces; an unknown type is an error."""
    parts = [_TYPED.match(n.strip()) for n in names]
    if not names or not all(parts):
        return None
    for m in parts:
        if m[2].strip().lower() not in TYPES:
            raise ValueError(f"unknown column type {m[2]!r}")
    return _ddl([m[1] for m in parts], [m[2] for m in parts])


def _ddl(names: list[str], kinds: list[str]) -> str:
    return ", ".join(f"`{n}` {TYPES[k.strip().strip(chr(34)).lower()]}" for n, k in zip(names, kinds, strict=True))


def read_csv(spark: SparkSession, path: str, delimiter: str = ",", sidecar: list[str] | None = None) -> DataFrame:
    """Typed headers if every header has braces, else the ``sidecar``'s types, else inferred."""
    reader = spark.read.option("header", True).option("sep", delimiter)
    names = reader.csv(path).columns
    schema = typed_header(names)
    if schema is None and sidecar:
        schema = _ddl(names, sidecar)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, typed: bool = True) -> None:
    """Headers ``name {type}``, or plain; binary geometry columns are dropped."""
    names = {"bigint": "int64", "int": "int32", "double": "float64", "float": "float32", "boolean": "bool", "string": "str", "date": "date", "timestamp_ntz": "datetime64[ns]"}
    flat = df.select(*[c for c, k in df.dtypes if k != "binary"])
    if typed:
        flat = flat.toDF(*[f"{c} {{{names.get(k, 'str')}}}" for c, k in flat.dtypes])
    flat.write.mode("overwrite").option("header", True).csv(path)


def read(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """By extension; blanks in a path are an error."""
    if " " in path:
        raise ValueError("paths must not contain blanks")
    kind = PurePosixPath(path.rstrip("/")).suffix.lower()
    if kind == ".csv":
        return read_csv(spark, path, **options)
    if kind in (".parquet", ".geoparquet"):
        return spark.read.parquet(path)
    if kind == ".json":
        return spark.read.options(**options).json(path)
    if kind == ".orc":
        return spark.read.orc(path)
    if kind in (".pkl", ".xlsx", ".xls"):  # single small files, read on the driver
        import pandas as pd

        return spark.createDataFrame(pd.read_pickle(path) if kind == ".pkl" else pd.read_excel(path))
    raise ValueError(f"no reader for {kind or 'a path without extension'}")


def write(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    kind = PurePosixPath(path.rstrip("/")).suffix.lower()
    if kind == ".csv":
        write_csv(df, path)
    elif kind in (".parquet", ".geoparquet"):
        df.write.mode(mode).parquet(path)
    elif kind == ".json":
        df.write.mode(mode).json(path)
    elif kind == ".orc":
        df.write.mode(mode).orc(path)
    else:
        raise ValueError(f"no writer for {kind or 'a path without extension'}")


def read_partitions(spark: SparkSession, root: str) -> DataFrame:
    """All ``partition_<n>`` folders below ``root`` with their number as ``partition_number``."""
    df = spark.read.option("recursiveFileLookup", True).parquet(root)
    return df.withColumn("partition_number", F.regexp_extract(F.col("_metadata.file_path"), r"partition_(\d+)", 1).cast("int"))


def read_jdbc(spark: SparkSession, url: str, table: str, condition: str | None = None, **options: str) -> DataFrame:
    """A database table; the condition is evaluated there."""
    source = f"(SELECT * FROM {table} WHERE {condition}) q" if condition else table
    return spark.read.format("jdbc").options(url=url, dbtable=source, **options).load()


def features(df: DataFrame, column: str, paths: dict[str, str]) -> DataFrame:
    """Columns from a JSON text by path; lists as comma-joined text; a missing path is null."""
    got = {k: F.get_json_object(column, f"$.{p}") for k, p in paths.items()}
    joined = {k: F.when(v.startswith("["), F.array_join(F.from_json(v, "array<string>"), ", ")).otherwise(v) for k, v in got.items()}
    return df.select("*", *[v.alias(k) for k, v in joined.items()])


def signature(df: DataFrame) -> str:
    """Digest of the schema and the rows, whatever their order: rows are hashed and summed, nothing is collected."""
    import hashlib

    r = df.select(F.xxhash64(*df.columns).cast("decimal(38,0)").alias("h")).agg(F.count("*").alias("n"), F.sum("h").alias("s")).first()
    return hashlib.sha256(f"{df.schema.json()}|{r['n']}|{r['s']}".encode()).hexdigest()
