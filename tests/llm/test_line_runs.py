"""Token numbers of lines when a piece has very many of them."""

import numpy as np

from kindred.llm import linededup

RARITY = np.zeros(1 << linededup.SKETCH_BITS, dtype=np.uint8)


def test_many_blank_lines():
    token = np.random.default_rng(1).integers(0, 1 << 64, 4, dtype=np.uint64)
    lines = (1 << 22) + 10
    bounds, number, m, bits = linededup.line_order(np.array([5, 5, lines - 2, lines - 2]), token, lines, RARITY)
    want = linededup.line_order(np.array([0, 0, 1, 1]), token, 2, RARITY)
    assert (number == want[1]).all() and len(set(number.tolist())) == 4
    assert m.sum() == 4 and (m[[5, lines - 2]] == 2).all() and (bits[[5, lines - 2]] == want[3]).all()
    assert (bounds[[5, 6, lines - 2, lines - 1]] == [0, 2, 2, 4]).all() and len(bounds) == lines + 1


def test_runs_change_nothing(monkeypatch):
    rng = np.random.default_rng(2)
    owner, token = np.sort(rng.integers(0, 50, 300)), rng.integers(0, 1 << 64, 40, dtype=np.uint64)[rng.integers(0, 40, 300)]
    whole = linededup.line_order(owner, token, 52, RARITY)
    monkeypatch.setattr(linededup, "RUN", 7)
    assert all((a == b).all() for a, b in zip(whole, linededup.line_order(owner, token, 52, RARITY), strict=True))
    assert all(len(x) == n for x, n in zip(linededup.line_order(owner[:0], token[:0], 3, RARITY), (4, 0, 3, 3), strict=True))
