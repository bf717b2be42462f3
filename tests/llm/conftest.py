import pytest


def frame(spark, rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
    width = len(schema.split(","))
    return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)


#: Words of a small invented language, so that passages differ.
def prose(n, seed=1):
    out, x = [], seed
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append("".join("tolaresimuno"[2 * ((x >> k) % 6) : 2 * ((x >> k) % 6) + 2] for k in (3, 9, 15)[: 1 + (x >> 20) % 3]))
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    long = prose(20_000, 5)
    return [
        (1, prose(120), "en", "a", 5), (2, prose(120), "en", "a", 5), (2, prose(120), "en", "a", 5), (3, None, None, None, None), (4, "", "de", "b", 0), (None, prose(80, 9), "en", None, 3),
        (None, prose(80, 9), "en", None, 3), (5, long, "en", "a", 9), (6, "### %% 123", "de", "b", 2), (7, "kurz", "de", "b", 4), (2, prose(60, 77), "de", "b", 1), (8, "  \t\n ", "de", "b", 1), (9, "é" * 300, "fr", "b", 300),
    ]


@pytest.fixture()
def odd(spark, odd_rows):
    """The odd rows, with extra columns whose names clash with those of results."""
    from pyspark.sql import functions as F

    df = frame(spark, odd_rows)
    return df.withColumn("n_words", F.lit("x")).withColumn("kept", F.lit(7)).withColumn("content", F.lit(1.5)).withColumn("tag", F.lit("t")).withColumn("accepted", F.lit("?")).withColumn("_found", F.lit(1))


@pytest.fixture()
def empty(spark):
    return frame(spark, [])
