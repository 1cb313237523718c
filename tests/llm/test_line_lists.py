"""Prefixes with second tokens and long lists, against all pairs."""

import random

import numpy as np
import pytest

from kindred.llm import linededup, words


def pairs_of(sets, monkeypatch, hot, long_, first=None):
    monkeypatch.setattr(linededup, "HOT", hot)
    monkeypatch.setattr(linededup, "LONG", long_)
    monkeypatch.setattr(linededup, "ROWS", 3)
    monkeypatch.setattr(linededup, "COLUMNS", 5)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    token = words.mix(np.array([w for s in sets for w in s], dtype=np.uint64) + np.uint64(77))
    count = np.bincount((token >> np.uint64(64 - linededup.SKETCH_BITS)).astype(np.int64), minlength=1 << linededup.SKETCH_BITS)
    rarity = np.minimum(63, 2 * np.log2(1 + count)).astype(np.uint8)
    bounds, number, m, marks = linededup.line_order(owner, token, len(sets), rarity)
    by, rare, at = linededup.prefixes(bounds, number, m, np.flatnonzero(m >= 4), 0.8)
    posts = {"token": rare, "a": marks[by, 0], "b": marks[by, 1], "doc": by // 2, "line": (by % 2).astype(np.uint32), "m": m[by].astype(np.uint32), "at": at.astype(np.uint32), "ask": np.ones(len(by), np.uint8)}
    back = linededup.unpack(linededup.pack(posts), len(by))
    assert all((back[k] == posts[k]).all() for k in posts)
    y, x, more = linededup.candidates(back, 0.8, first)
    assert (by[y] > by[x]).all()
    return set(zip(by[y].tolist(), by[x].tolist(), strict=True)), set(by[more].tolist())


@pytest.mark.parametrize(("hot", "long_"), [(63, 64), (63, 2), (0, 64), (4, 3), (0, 1)])
def test_no_similar_pair_is_lost(monkeypatch, hot, long_):
    rng = random.Random(hot + long_)
    pool = [sorted(rng.sample(range(60), rng.randint(4, 20))) for _ in range(12)]
    sets = []
    for _ in range(120):
        s = set(rng.choice(pool))
        for _ in range(rng.randint(0, 3)):
            s.add(rng.randrange(80)) if rng.random() < 0.5 else s.discard(rng.choice(sorted(s)))
        sets.append(sorted(s) or [1])
    want = {(i, j) for i in range(len(sets)) for j in range(i) if set(sets[i]) != set(sets[j]) and len(set(sets[i]) & set(sets[j])) >= 0.8 * len(set(sets[i]) | set(sets[j]))}
    got, _ = pairs_of(sets, monkeypatch, hot, long_)
    assert want and want <= got
    some, more = pairs_of(sets, monkeypatch, hot, long_, first=1)
    assert some <= got and {y for y, _ in want} <= {y for y, _ in some}
    assert {y for y, _ in got - some} <= more


def test_long_list_in_which_nothing_fits():
    n = 30_000  # sets of one size that meet late in their order can't be similar
    posts = {"token": np.full(n, 9, np.uint64), "a": np.arange(n, dtype=np.uint64), "b": np.arange(n, dtype=np.uint64), "doc": np.arange(n), "line": np.zeros(n, np.uint32), "m": np.full(n, 50, np.uint32), "at": np.full(n, 9, np.uint32), "ask": np.ones(n, np.uint8)}
    y, x, more = linededup.candidates(posts, 0.8, 2)
    assert not len(y) and not len(x) and not len(more)
