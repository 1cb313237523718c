"""Trigrams against probabilities worked out from dictionaries."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from kindred.llm import lm, words


def by_definition(texts):
    """P(w|u, v) of interpolated modified Kneser-Ney as a function; None stands for what is before the begin."""
    grams = Counter()
    for t in texts:
        s = [None, "<s>", *t.split(), "</s>"]
        grams.update(zip(s, s[1:], s[2:]))
    pairs, kinds, vocabulary = Counter(), Counter(), set()
    for (u, v, w), c in grams.items():
        pairs[v, w] += c if u is None else 1
        vocabulary.add(w)
    for _, w in pairs:
        kinds[w] += 1
    top = {g: c for g, c in grams.items() if g[0] is not None}
    d = [lm.discounts([sum(c == k for c in x.values()) for k in (1, 2, 3, 4)]) for x in (kinds, pairs, top)]

    def level(c, followers, d, lower):
        total = sum(followers)
        return (max(c - d[min(c, 3)], 0) + sum(d[min(x, 3)] for x in followers) * lower) / total if total else lower

    after, after2 = defaultdict(list), defaultdict(list)
    for (v, _), c in pairs.items():
        after[v].append(c)
    for (u, v, _), c in top.items():
        after2[u, v].append(c)

    def p(u, v, w):
        one = level(kinds[w], list(kinds.values()), d[0], 1 / (len(vocabulary) + 1))
        two = level(pairs[v, w], after[v], d[1], one)
        return two if u is None else level(top.get((u, v, w), 0), after2[u, v], d[2], two)

    return p


@pytest.mark.parametrize("shards", [1, 5])
def test_trigrams_are_their_definition(spark, shards):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("aa ab ba bb ca cb da".split()[: rng.randint(1, 7)]) for _ in range(rng.randint(0, 12))) for _ in range(150)]
    texts += ["aa ab"] * 300
    model = lm.fit(spark.createDataFrame([(t,) for t in texts], "text string"), shards=shards)
    assert model.order == 3
    p = by_definition(texts)
    asked = ["aa ab ba", "unseen aa bb", "", "ca unseen ab da", *texts[:20]]
    before, token, _ = lm.sequences(pa.array(asked))
    log, _ = model.score(before, token, lm.earlier(before))
    want = []
    for t in asked:
        s = [None, "<s>", *t.split(), "</s>"]
        want += [p(*g) for g in zip(s, s[1:], s[2:])]
    assert 10**log == pytest.approx(np.array(want))
    hashed, _ = words.tokens(pa.array(["aa ab"]))
    known = np.append(words.tokens(pa.array(["aa ab ba bb ca cb da unseen"]))[0], lm.END)
    log, _ = model.score(np.full(len(known), hashed[1]), known, np.full(len(known), hashed[0]))
    assert (10**log).sum() == pytest.approx(1.0)
