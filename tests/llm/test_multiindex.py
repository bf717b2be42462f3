"""SimHash fingerprints and multi-index links against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import frame, prose
from zonalis.llm import multiindex, queries
from zonalis.llm.bagminhash import components


def plain(text):
    w = [x for x in (text or "").encode().lower().replace(b"\n", b" ").replace(b"\t", b" ").replace(b"\r", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").split(b" ") if x]
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_classes(fps, limit):
    """The smallest index that each one reaches."""
    fp, low = np.array(fps, np.uint64), list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            near = np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= limit)
            least = min(low[j] for j in near)
            for j in near:
                if low[j] > least:
                    low[j], changed = least, True
    return low


def test_fingerprints(monkeypatch):
    texts = [None, "", " \t\n", "One", "one TWO", "a b c", "A b C d", prose(300, 3), prose(50, 8) + "\x0b\x0c" + prose(9, 2), "é É ß x", "x x x x x x"]
    assert [multiindex.fingerprint((t or "").encode()) for t in texts] == [plain(t) for t in texts]
    monkeypatch.setattr(multiindex, "PIECE", 7)
    assert [multiindex.fingerprint((t or "").encode()) for t in texts] == [plain(t) for t in texts]


def test_votes_are_sparks_hash(spark):
    """The hash of a shingle is the one that Spark gives for a string."""
    text = "some more words"
    want = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % 2**64
    assert multiindex.fingerprint(text.encode()) == want


@pytest.mark.parametrize("limit, segments, crowd", [(2, 2, 32), (2, 2, 0), (2, 2, 3), (2, 3, 2), (3, 2, 1), (3, 2, 50), (1, 1, 1), (1, 2, 0), (0, 1, 0), (4, 2, 1)])
def test_links_join_what_brute_force_joins(spark, limit, segments, crowd):
    rng = random.Random(limit * 10 + crowd)
    fps = [0, 2**64 - 1, 2**63]
    for _ in range(12):
        x = rng.getrandbits(64)
        fps.append(x)
        for _ in range(rng.choice([1, 3, 12])):  # copies of copies
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            fps.append(x)
    fps = sorted(set(fps))
    signed = [x - 2**64 if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = multiindex.links(df, limit, segments, crowd)
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2 * limit for r in found.collect())
    label = {r.node: r.label for r in components(found).collect()}
    classes = plain_classes(fps, limit)
    want = {tuple(sorted(signed[i] for i in range(len(fps)) if classes[i] == c)) for c in set(classes)}
    got = {}
    for x in signed:
        got.setdefault(label.get(x, x), []).append(x)
    assert {tuple(sorted(v)) for v in got.values()} == want


def test_documents_equal_brute_force(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted(rows, key=lambda r: r.doc_id)
    fps = [plain(r.text) for r in rows]
    low = plain_classes(fps, 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op12_simhash(spark, small).collect()}
    assert got == {r.doc_id: (f"{f:016x}", rows[c].doc_id) for r, f, c in zip(rows, fps, low)}


def test_odd_rows(spark, odd, odd_rows, empty):
    got = multiindex.near_duplicates(odd)
    assert got.columns == ["doc_id", "fingerprint", "component_id", "component_size"]
    fps = [plain(r[1]) for r in odd_rows]
    low = plain_classes(fps, 2)
    key = lambda x: (x is None, x or 0)
    want = sorted(((r[0], f"{f:016x}", min((odd_rows[j][0] for j in range(len(low)) if low[j] == c), key=key), low.count(c)) for r, f, c in zip(odd_rows, fps, low)), key=str)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert multiindex.near_duplicates(empty).count() == 0


def test_nulls_alone_have_no_id(spark):
    got = multiindex.near_duplicates(frame(spark, [(None, prose(40, 3)), (None, prose(40, 3)), (7, prose(50, 9))])).collect()
    assert sorted((r.component_id is None, r.component_size) for r in got) == [(False, 1), (True, 2), (True, 2)]
