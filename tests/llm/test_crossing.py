"""Near copies that one leader leaves apart, null ids, and pairs across components against all pairs."""

import random

import numpy as np
import pytest

from kindred.llm import minhash, words


@pytest.mark.parametrize("long_", [64, 2])
def test_no_link_between_components_is_lost(monkeypatch, long_):
    monkeypatch.setattr(minhash, "LONG", long_)
    monkeypatch.setattr(minhash, "ROWS", 3)
    monkeypatch.setattr(minhash, "COLUMNS", 5)
    rng = random.Random(long_)
    base = [rng.sample(range(300), 30) for _ in range(6)]
    sets = []
    for _ in range(90):
        s = set(rng.choice(base))
        for _ in range(rng.randint(0, 8)):
            s.discard(rng.choice(sorted(s)))
            s.add(rng.randrange(1000, 9000))
        sets.append(s)
    component = [rng.randrange(4) for _ in sets]
    count = {}
    for s in sets:
        for x in s:
            count[x] = count.get(x, 0) + 1
    posts = []
    for i, s in enumerate(sets):
        order = sorted(s, key=lambda x: (count[x], x))
        posts += [(x, i, component[i], len(s), k) for k, x in enumerate(order[: len(s) - -(-75 * len(s) // 100) + 1])]
    got = {tuple(p) for p in minhash.crossing(*np.array(posts).T, 75).tolist()}
    want = {(i, j) for j in range(len(sets)) for i in range(j) if component[i] != component[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert want and want <= got and all(component[a] != component[b] for a, b in got)


def test_chain_and_null_ids(spark):
    rng = random.Random(8)
    words_ = [f"w{i}" for i in range(400)]
    text, rows = [rng.choice(words_) for _ in range(120)], []
    for i in range(60):  # every text is close to the one before it, far ones are not alike
        text = list(text)
        text[rng.randrange(len(text))] = f"n{i}"
        rows.append((i + 10, " ".join(text)))
    rows += [(None, rows[0][1] + " more"), (None, rows[0][1] + " other"), (None, "alone with a null id and no number"), (7, rows[-1][1] + " end"), (10, rows[3][1])]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(table.repartition(3)).collect()
    assert len(got) == len(rows)
    inside = [r for r in got if r["n_shingles"] > 30]
    assert {r["component_id"] for r in inside} == {7} and sum(r["kept"] for r in inside) == 1
    alone = [r for r in got if r["n_shingles"] <= 30]
    assert [(r["doc_id"], r["component_id"], r["kept"]) for r in alone] == [(None, None, True)]
    assert minhash.near_duplicates(table.limit(0)).count() == 0
