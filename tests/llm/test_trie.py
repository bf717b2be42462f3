"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from zonalis.llm import trie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth string, content int, pos double"


def plain_turns(rows):
    """conv_id -> turns (role, text)."""
    out = {}
    for c, turn, role, text in rows:
        if c is not None:
            out.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(v)] for c, v in out.items()}


def plain_rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def plain_trie(convs):
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        below = children.get(k, [])
        leaves[k] = sum(leaves[x] for x in below) or 1
        saved[k] = sum(saved[x] for x in below) + (len(members[k]) - 1) * (len(k[-1][1]) if k else 0)
    text = lambda k: ",".join(map(str, sorted(ends.get(k, []))))
    return sorted(
        ((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children.get(k, [])), leaves[k], saved[k], len(ends.get(k, [])), hashlib.sha256(text(k).encode()).hexdigest(), k[-1][0] if k else None, len(k[-1][1]) if k else 0) for k, m in members.items()), key=str
    )


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "ends_sha256", "role", "text_chars"]


def nodes(spark, rows, rebuild=False, **options):
    df = spark.createDataFrame([tuple(r) + ("x", 1, 2.0) for r in rows], SCHEMA)
    got = T.trie(T.rebuilt(df) if rebuild else T.gathered(df), **options)
    return sorted((tuple(r) for r in got.select(COLUMNS).collect()), key=str)


def some_rows(seed, n, most=6, letters="ab"):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]) if t > 2 else "user", rng.choice(letters) * rng.choice([1, 1, 2])) for c in rng.sample(range(3000), n) for t in range(rng.randint(1, most))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-1, 5), max_size=40))
def test_nearest_smaller_values(values):
    left, right = T.smaller(np.array(values, np.int64))
    for i, v in enumerate(values):
        assert left[i] == max((j for j in range(i) if values[j] < v), default=-1)
        assert right[i] == min((j for j in range(i + 1, len(values)) if values[j] < v), default=len(values))
    if values:
        m = T.Minima(np.array(values))
        a = np.array([i for i in range(len(values)) for _ in range(i + 1, len(values) + 1)])
        b = np.array([j for i in range(len(values)) for j in range(i + 1, len(values) + 1)])
        assert m.of(a, b).tolist() == [min(values[i:j]) for i, j in zip(a, b)]
        for i, v in enumerate(values):
            lefts = [j for j in range(i) if values[j] < v]
            assert T._nearest(np.array(values), i, np.array([v]), True) == [max(lefts, default=None)]
            rights = [j for j in range(i + 1, len(values)) if values[j] < v]
            assert T._nearest(np.array(values), i, np.array([v]), False) == [min(rights, default=None)]


@pytest.mark.parametrize("block", [1, 2, 5, 1000])
def test_equals_plain_trie(spark, block):
    rows = some_rows(block, 150)
    assert nodes(spark, rows, block=block, piece=2) == plain_trie(plain_turns(rows))


def test_blocks_are_bounded(spark):
    rows = some_rows(77, 120)
    assert nodes(spark, rows, block=1, blocks=7) == plain_trie(plain_turns(rows))


def test_rebuilt_conversations(spark):
    rows = some_rows(3, 300, 9)
    rows += [(c, t, "user", f"base {t}") for c in (100, 700, 1500) for t in range(4)]
    assert nodes(spark, rows, rebuild=True, block=16) == plain_trie(plain_rebuilt(plain_turns(rows)))


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", "a"), (1, 1, None, None), (1, None, "system", ""), (2, None, "system", ""), (2, 0, "user", "a"), (2, 0, "user", "a"), (3, 5, "", "x"), (None, 0, "user", "lost"), (4, None, None, None),
        (5, 1, "user", "é" * 20_000), (5, 0, "user", "a"), (6, 0, "us", "era"), (7, 0, "user", "a"), (-8, 2, "user", "a"), (-8, 1, "user", "b"),
    ]
    rows += [(1000 + i, 0, "user", "a") for i in range(300)]  # a common conversation
    rows += [(5000, t, "user", "abc"[t % 3]) for t in range(700)] + [(5001, t, "user", "abc"[t % 3]) for t in range(699)]  # long ones
    assert nodes(spark, rows, block=8, piece=16) == plain_trie(plain_turns(rows))


def test_few_conversations(spark):
    assert nodes(spark, []) == []
    assert nodes(spark, [(3, 0, "user", "a")]) == plain_trie({3: [("user", "a")]})
    two = [(3, 0, "user", "ab"), (4, 0, "user", "ab")]
    assert nodes(spark, two) == plain_trie(plain_turns(two))


def test_turnless_conversations(spark):
    """A conversation of fewer turns than it takes over from an absent one is at the root alone."""
    short = [c for c in range(101, 400) if zlib.crc32(str(c).encode()) % 6 > 2][:5]
    rows = [(c, t, "user", "x") for c in short for t in range(2)] + [(1, 0, "user", "y")]
    want = plain_trie(plain_rebuilt(plain_turns(rows)))
    assert any(r[1] == 0 and r[7] >= 5 for r in want)
    assert nodes(spark, rows, rebuild=True) == want
