"""Language ID by compression: the dictionary that shortens a text most names its language.

``fit`` draws a bounded sample of labelled texts and makes one raw-content
zstandard dictionary a language; ``classify`` compresses the letters of each
whole text in blocks against every dictionary and sums the sizes.  The
smallest sum wins; a relative margin below ``min_margin`` is narrow and the
text is rejected (``accepted`` false), though the likeliest value is still
reported.

Letters are those of Unicode's category L.  Null texts and texts without a
letter are ``und`` with score 0, rejected; of equal sizes the first language by
name wins.  Rows are judged one by one: repeats, null ids and extra columns pass
through unchanged, but for columns of the results' names, which are replaced.
A very long text is one row in memory and is compressed block by block.
Without any labelled text every row is ``und``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_text, small_batches

LETTERS = re.compile(r"[^\W\d_]+")
#: Bytes of text that are compressed at once, each time with the dictionary afresh, so that a long text doesn't become its own dictionary.
BLOCK = 1024


def letters(text: str | None) -> str:
    """Lower-cased words of letters, joined by single blanks."""
    if not text:
        return ""
    runs = LETTERS.findall(text.lower())
    return " ".join(w for w in (r if r.isalpha() else "".join(filter(str.isalpha, r)) for r in runs) if w)


def compressors(model: dict[str, bytes], level: int) -> dict[str, zstandard.ZstdCompressor]:
    out = {}
    for lang, content in sorted(model.items()):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        out[lang] = zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
    return out


def sizes(data: bytes, by_lang: dict[str, zstandard.ZstdCompressor]) -> dict[str, int]:
    blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
    return {lang: sum(len(c.compress(b)) for b in blocks) for lang, c in by_lang.items()}


def fit(labelled: DataFrame, sample_docs: int = 400, dict_bytes: int = 112_640, level: int = 9) -> dict[str, bytes]:
    """Dictionaries from ``labelled`` (text, lang).

    The sample is bounded: about ``sample_docs`` different texts a language,
    those whose hashes are smallest.  Their letters, whole texts, are cut into
    pieces of ``BLOCK`` bytes, and of a language's pieces those of smallest
    hash fill a dictionary of ``dict_bytes``: no part of a text goes before
    another.  Pieces that another language's first dictionary shortens more
    (of mixed or mislabelled texts) are then left out and the dictionaries are
    made again from as many.
    """
    spark = labelled.sparkSession
    small_batches(spark)
    known = labelled.select(as_text("text").alias("text"), as_text("lang").alias("lang")).where("text is not null and lang is not null")
    known = known.withColumn("h", F.xxhash64("text"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not counts:
        return {}
    shares = F.create_map(*[x for lang, n in sorted(counts.items()) for x in (F.lit(lang), F.lit(min(1.0, float(sample_docs) / max(n, 1))))])
    drawn = known.where((F.col("h") / F.lit(2.0**64) + 0.5) <= shares[F.col("lang")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                data = letters(text).encode("utf-8", "surrogatepass")
                pieces = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(pieces), pa.string()), pa.array(pieces, pa.binary())], names=["lang", "piece"])

    pieces = drawn.select("lang", "text").mapInArrow(cut, "lang string, piece binary").distinct().withColumn("h", F.xxhash64("piece"))
    most = 2 * -(-dict_bytes // BLOCK)
    first = Window.partitionBy("lang").orderBy("h", "piece")
    rows = pieces.withColumn("k", F.row_number().over(first)).where(F.col("k") <= most).orderBy("lang", "k").collect()
    texts: dict[str, list[bytes]] = {}
    for r in rows:
        texts.setdefault(r["lang"], []).append(bytes(r["piece"]))

    def content(some: list[bytes]) -> bytes:
        out, size = [], 0
        for x in some:
            if size + len(x) + 1 > dict_bytes:
                break
            out.append(x)
            size += len(x) + 1
        return b" ".join(out or some[:1])

    by_lang = compressors({lang: content(x) for lang, x in texts.items()}, level)
    out = {}
    for lang, some in texts.items():
        got = [sizes(x, by_lang) for x in some]
        # a piece within the first dictionary is nearly free in its own language: it must be so in no other
        clean = [x for x, g in zip(some, got) if g[lang] == min(g.values())]
        out[lang] = content(clean or some)
    return out


def classify(docs: DataFrame, model: dict[str, bytes], min_margin: float = 0.002, level: int = 9, temperature: float = 4.0) -> DataFrame:
    """Adds lang_pred, score, margin and accepted to ``docs``.

    ``score`` is the winner's softmax share of the sizes in bytes divided by
    ``temperature`` and the square root of the number of blocks.
    """

    @F.pandas_udf("lang_pred string, score double, margin double, accepted boolean")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        by_lang = compressors(model, level)
        for part in parts:
            out = []
            for text in part:
                data = letters(text).encode("utf-8", "surrogatepass")
                if not data or not by_lang:
                    out.append(("und", 0.0, 0.0, False))
                    continue
                got = sizes(data, by_lang)
                order = sorted(got, key=lambda x: (got[x], x))
                best = got[order[0]]
                margin = (got[order[1]] - best) / best if len(order) > 1 else 1.0
                scale = temperature * max(1.0, len(data) / BLOCK) ** 0.5
                out.append((order[0], float(1 / np.exp([(best - v) / scale for v in got.values()]).sum()), float(margin), margin >= min_margin))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "margin", "accepted"])

    small_batches(docs.sparkSession)
    cols = [c for c in docs.columns if c not in ("lang_pred", "score", "margin", "accepted")]
    name = "_p"
    while name in cols:
        name += "_"
    got = docs.select(*[F.col(f"`{c}`") for c in cols], predict(as_text("text")).alias(name))
    return got.select(*[F.col(f"`{c}`") for c in cols], f"{name}.*")


def told(docs: DataFrame, model: dict[str, bytes]) -> DataFrame:
    """The rows of ``docs`` whose language is accepted, with their own columns, whatever their names."""
    name = "_told"
    while name in docs.columns:
        name += "_"
    return classify(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(name), F.col("text")), model).where("accepted").select(f"{name}.*")
