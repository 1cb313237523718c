"""The corpus operators against brute force, exact round trips and hard cases."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from kindred.llm import ann, bpe, components, langid, linededup, lm, minhash, mixing, quality, toxicity, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, node string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def docs(spark, texts):
    """Documents with extra columns that clash with the operators' own names."""
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}" if i % 5 else None, 0, 0.5, "x") for i, t in enumerate(texts)], SCHEMA)


HARD = [None, "", " \n\t ", "a", "a", "Hello, world! " * 3000, "日本語 のテキスト\x85é̀ 😀", "x" * 5000, None]


def test_words_are_those_of_bytes():
    texts = [*(t or "" for t in HARD), "A\x0bb  C\x1cd\xa0e"]
    hashes, bounds = words.tokens(pa.array(texts))
    known = {}
    for i, t in enumerate(texts):
        split = t.encode().lower().split()
        assert len(split) == bounds[i + 1] - bounds[i]
        for w, h in zip(split, hashes[bounds[i] : bounds[i + 1]], strict=True):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


def test_bpe_is_tiktokens(spark):
    ranks, pattern = bpe.vocabulary()
    theirs = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    texts = [t or "" for t in HARD] + ["".join(rng.choice("ab  \n\t\x1c\x85\xa0'.,s1éª²½_ß漢😀\r\x00") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    got = {r["doc_id"]: r for r in bpe.encode(docs(spark, texts), ranks, pattern).collect()}
    for i, t in enumerate(texts):
        assert got[i]["ids"] == theirs.encode_ordinary(t) and got[i]["decoded"] == t
    rows = {r["doc_id"]: r for r in bpe.digests(docs(spark, texts), ranks, pattern).collect()}
    for i, t in enumerate(texts):
        ids = theirs.encode_ordinary(t)
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(theirs.decode_bytes(ids)).hexdigest())
        assert (rows[i]["n_tokens"], rows[i]["ids_sha256"], rows[i]["decoded_sha256"]) == want
    machine = bpe.Transducer(ranks)
    assert list(machine.stream([b"the tion", b"and"])) == machine.encode(b"the tionand")
    for size in (300, 5000):  # long matches go through the window
        for letters in ("ab", "abcdefghij", "x", "\u00e9a", "ione"):
            piece = "".join(rng.choice(letters) for _ in range(size)).encode()
            assert list(machine.stream([piece[:100], piece[100:]])) == theirs._encode_single_piece(piece)


def test_decoder_is_the_machine_over_bytes():
    rng = random.Random(2)
    tokens = {i: bytes([i]) for i in range(256)} | {256 + i: bytes(rng.choice(b"ab\xe2\x82\xac\xf0\x9f\x98\x80\xff\xc3\xed\xa0") for _ in range(rng.randint(1, 5))) for i in range(300)}
    machine = bpe.Decoder(tokens)
    for _ in range(300):
        ids = [rng.choice((rng.randrange(556), rng.randrange(0x80, 0x100), 0xE2, 0x82, 0xF0, 0x9F)) for _ in range(rng.randint(0, 12))]
        stream = bpe.StreamDecoder(machine)
        got = "".join(stream.push([i]) for i in ids) + stream.close()
        assert got == b"".join(tokens[i] for i in ids).decode("utf-8", "replace")


def shingle_set(text):
    w = [x.decode("utf-8", "surrogateescape") for x in (text or "").encode().lower().split()]
    return set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_minhash_is_brute_force(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(80)) for _ in range(12)]
    texts = [*HARD, *base]
    for b in base:
        for _ in range(4):
            w = b.split()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w).upper())
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i in range(len(texts)):
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(sets[i]), top(i), top(i) == i)


def test_superminhash_estimates_jaccard():
    a, b = np.arange(300, dtype=np.uint64), np.arange(100, 400, dtype=np.uint64)
    s = minhash.signatures(words.mix(np.concatenate([a, b])), np.array([0, 300, 600]))
    assert abs((s[0] == s[1]).mean() - 0.5) < 0.15
    assert (s < (minhash.POSITIONS << 25)).all()


def test_components_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 60), (60, 50)], "a long, b long")
    got = dict(components.components(links).collect())
    assert all(got[i] == 0 for i in range(21)) and got[60] == got[50] == 50


def test_line_dedup_is_brute_force(spark):
    rng = random.Random(5)
    pool = [[rng.choice(WORDS) + str(rng.randint(0, 9)) for _ in range(rng.randint(1, 25))] for _ in range(30)]
    texts = list(HARD)
    for _ in range(40):
        lines = []
        for _ in range(rng.randint(1, 6)):
            line = list(rng.choice(pool))
            if rng.random() < 0.6:
                line[rng.randrange(len(line))] = rng.choice(WORDS)
            lines.append(" ".join(line))
        texts.append("\n".join(lines))
    seen, gone = [], set()
    for i, t in enumerate(texts):
        for k, line in enumerate((t or "").split("\n")):
            s = frozenset(line.encode().lower().split())
            if s:
                if any(len(s & o) >= 0.8 * len(s | o) - 1e-9 for o in seen):
                    gone.add((i, k))
                seen.append(s)
    got = {(r["doc_id"], k) for r in linededup.dedup(docs(spark, texts)).collect() for k in r["removed"]}
    assert got == gone
    assert linededup.without_lines(docs(spark, texts)).columns == docs(spark, []).columns


def test_mixing(spark):
    targets = mixing.targets([("b", 10), ("a", 1000), (None, 10)])
    assert targets["b"] == 30 and targets[None] == 30 and targets["a"] == pytest.approx(960)
    texts = [*HARD, *(" ".join(["w"] * (1 + i % 17)) for i in range(200))]
    rows = mixing.mix(docs(spark, texts)).collect()
    assert sorted(rows) == sorted(mixing.mix(docs(spark, texts)).collect()) and len(rows) == len(texts)
    for s in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.mix(docs(spark, [])).count() == 0


def test_language_id(spark):
    en, de = "the quick brown fox jumps over the lazy dog and runs away", "der schnelle braune fuchs springt über den faulen hund und läuft weg"
    train = spark.createDataFrame([(i, t, k) for i, (t, k) in enumerate([(en, "en"), (de, "de"), (None, "en"), ("x", None)] * 3)], "doc_id long, text string, lang string")
    found = langid.learn(train)
    assert set(found) == {"en", "de"}
    got = [(r["lang_pred"], r["score"]) for r in langid.identify(docs(spark, ["the dog runs over the fox", "der hund läuft über den fuchs", "12 !!", None, ""]), found).orderBy("doc_id").collect()]
    assert [g[0] for g in got] == ["en", "de", "und", "und", "und"] and all(0 <= g[1] <= 1 for g in got)
    assert langid.learn(train.limit(0)) == {}


def test_string_kernel_is_its_definition():
    from itertools import combinations

    def slow(s, t):
        total = 0.0
        for a in combinations(range(len(s)), 3):
            for b in combinations(range(len(t)), 3):
                if all(s[i] == t[j] for i, j in zip(a, b, strict=True)):
                    total += toxicity.DECAY ** (a[2] - a[0] + 1 + b[2] - b[0] + 1)
        return total

    items = ["idiot", "idxiot", "banana", "abc"]
    got = toxicity.kernel(toxicity.codes(items), toxicity.codes(items))
    assert np.allclose(got, [[slow(a, b) for b in items] for a in items], atol=1e-4)
    model = toxicity.Model(items)
    norm = np.sqrt(np.diag(got))
    assert np.allclose(model.raw(toxicity.codes(items)), got / norm[:, None] / norm, atol=1e-4)


def test_toxicity(spark):
    rng = random.Random(2)
    clean = [" ".join(rng.choice(WORDS) for _ in range(20)) for _ in range(80)]
    bad = [" ".join([*(rng.choice(WORDS) for _ in range(15)), "idiot", "scumbag"]) for _ in range(40)]
    model = toxicity.learn(clean + bad, np.array([0] * 80 + [1] * 40))
    got = [r["predicted"] for r in toxicity.score(docs(spark, ["alpha beta gamma delta", "alpha idiot beta scumbag", "alpha idi-ot scumbags beta", None, ""]), model).orderBy("doc_id").collect()]
    assert got == [0, 1, 1, 0, 0]
    assert toxicity.learn([], np.zeros(0, np.int64)) is None
    assert [r["score"] for r in toxicity.score(docs(spark, HARD), None).collect()] == [0.0] * len(HARD)


def test_quality_field():
    rng = random.Random(4)
    good = ["\n".join(" ".join(rng.choice(WORDS) for _ in range(12)).capitalize() + "." for _ in range(4)) for _ in range(60)]
    bad = ["\n".join(" ".join(rng.choice(WORDS).upper() + "!!" for _ in range(12)) for _ in range(4)) for _ in range(60)]
    field = quality.learn(good + bad, np.array([1] * 60 + [0] * 60))
    row, size, x = quality.features(pa.array([good[0], bad[0], None, "", good[1]]))
    p = field.probability(field.share(row, size, quality.framed(row, x), 5))
    assert p[0] > 0.5 and p[4] > 0.5 and p[1] < 0.5
    # marginals against all labellings of a short text
    row, size, x = quality.features(pa.array(["One two.\nTHREE!!\nfour | five"]))
    x = quality.framed(row, x)
    energy = ((x - field.center) / field.scale) @ field.weights
    weight = {y: math.exp(sum(e for e, k in zip(energy, y, strict=True) if k) + sum(field.moves[a, b] for a, b in zip(y, y[1:], strict=False))) for y in [(a, b, c) for a in (0, 1) for b in (0, 1) for c in (0, 1)]}
    slow = [sum(v for y, v in weight.items() if y[i]) / sum(weight.values()) for i in range(3)]
    assert np.allclose(field.marginals(row, x)[0], slow)


def test_ann_recall(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(600, 32))
    rows = [(i, v.astype(float).tolist()) for i, v in enumerate(vectors)] + [(600, None), (601, [0.0] * 32), (602, [float("nan")] * 32), (603, [None] * 32), (604, vectors[50].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(table, table.where("vec_id % 50 = 0")).collect()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = np.vstack([unit, unit[50]])
    ids = np.r_[np.arange(600), 604]
    hit = 0
    for q in range(0, 600, 50):
        cosine = unit @ unit[q]
        cosine[q] = -2
        hit += len({ids[i] for i in np.lexsort((ids, -cosine))[:5]} & {r["vec_id"] for r in got if r["query_id"] == q})
    assert hit >= 0.9 * 60 and len(got) == 60
    assert ann.nearest(table.limit(0), table.limit(0)).count() == 0


def test_language_model_sums_to_one(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(WORDS[:8]) for _ in range(30)) for _ in range(20)]
    model = lm.fit(docs(spark, [*texts, None, ""]))
    known = sorted({w for t in texts for w in t.split()})
    column = pa.array([*known, "unseen"])
    token, _ = words.tokens(column)
    token = np.append(token, lm.END)
    for context in (token[0], lm.BEGIN, token[-2]):
        log, _ = model.score(np.full(len(token), context), token)
        assert (10**log).sum() == pytest.approx(1.0)
    rows = lm.score(docs(spark, HARD), model).collect()
    assert len(rows) == len(HARD) and all(r["score"] < 0 and r["n_tokens"] >= 1 for r in rows)
