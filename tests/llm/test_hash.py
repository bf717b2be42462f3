"""Texts that a polynomial modulo 2^64 takes for equal are told apart."""

import collections

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import frame, prose
from zonalis.llm import bagminhash, suffixes, tokens
from zonalis.llm.common import prefix_hash, range_hash


def thue_morse(n, a="a", b="b"):
    """Two words of 2^n blocks, each the other's complement."""
    bits = [i.bit_count() % 2 for i in range(1 << n)]
    return "".join(b if x else a for x in bits), "".join(a if x else b for x in bits)


def test_range_hash():
    for n in (5, 8, 11, 12):
        for a, b in (("a", "b"), ("ab", "cd"), ("abcdefgh", "hgfedcba")):
            x, y = (np.frombuffer(w.encode(), np.uint8) for w in thue_morse(n, a, b))
            both = np.concatenate([x, y, x])
            starts = np.array([0, len(x), 2 * len(x)])
            h = range_hash(prefix_hash(both), starts, starts + len(x))
            assert h[0] == h[2] != h[1]
            assert h[0] == range_hash(prefix_hash(x), np.array([0]), np.array([len(x)]))[0]
    rng = np.random.default_rng(3)
    buf = rng.integers(0, 3, 4000).astype(np.uint8)
    at = rng.integers(0, 3900, 3000)
    end = at + rng.integers(0, 9, 3000)
    h, seen = range_hash(prefix_hash(buf), at, end), {}
    for a, z, x in zip(at, end, h.tolist()):
        assert seen.setdefault(buf[a:z].tobytes(), x) == x
    assert len(set(seen.values())) == len(seen)


def test_unlike_passages_stay(spark):
    (x, y), anchor = thue_morse(5), "0123456789012345678901234567890123456789"
    one, two = (anchor.join([w * 5, w * 6]) for w in (x, y))
    got = {r.doc_id: r.n_removed for r in suffixes.remove_repeats(frame(spark, [(1, one), (2, two), (3, prose(300, 4)), (4, prose(300, 4))])).collect()}
    assert got[1] == repeats_in(one, two) and got[3] == got[4] > 0


def repeats_in(one, other):
    seen = collections.Counter(t[i : i + 200] for t in (one, other) for i in range(len(t) - 199))
    hit = {p for i in range(len(one) - 199) if seen[one[i : i + 200]] > 1 for p in range(i, i + 200)}
    return len(hit)


def test_unlike_words_are_no_copies(spark):
    x, y = thue_morse(11)
    got = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(frame(spark, [(1, x), (2, y), (3, x)])).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_unlike_words(name, monkeypatch):
    library = Tokenizer.from_file(tokens.tokenizer_path(name))
    x, y = thue_morse(10)
    texts = [f"see xxxxxxxx{w}yyyyyyyy here" for w in (x, y, x)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [i.tolist() for i in tokens.CachedEncoder(name, limit=64).encode(texts)] == want
    # even if all hashes are equal, bytes decide
    marks = tokens.span_marks
    monkeypatch.setattr(tokens, "span_marks", lambda buf, start, end: (*marks(buf, start, end)[:2], np.zeros(len(start), np.uint64)))
    enc = tokens.CachedEncoder(name, limit=64)
    for _ in range(2):
        assert [i.tolist() for i in enc.encode(texts)] == want
        assert [i.tolist() for i in enc.encode(texts[::-1])] == want[::-1]
