"""The whole pipeline against a brute-force version of its five stages."""

import random
from collections import Counter

import numpy as np
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from kindred.llm import bpe, langid, mixing

SYLLABLES = {"en": "the ing tion ow th sh ea ly ck ough er wh", "de": "sch ung ei ch ten der ge ver auf zu ß ü"}


def made(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang].split()) for _ in range(rng.randint(1, 3))) for _ in range(n))


def fixture():
    rng = random.Random(11)
    rows = []
    for i in range(60):
        lang = "de" if i % 3 == 0 else "en"
        rows.append([i, "\n".join(made(rng, lang, rng.randint(6, 30)) for _ in range(rng.randint(1, 6))), lang, f"s{i % 4}" if i % 7 else None])
    shared = made(rng, "en", 40)
    for i in (5, 17, 31):  # a line that several documents share, once with a word changed
        rows[i][1] += "\n" + (shared if i != 31 else shared.replace(shared.split()[3], "otherword", 1))
    for i in (8, 9):  # near copies that no single line gives away
        words_ = rows[i][1].split()
        words_[len(words_) // 2] = "changed"
        rows.append([100 + i, " ".join(words_) + " end", rows[i][2], "s9"])
    rows.append([200, rows[2][1], "en", "s1"])  # an exact copy
    rows += [[201, None, "en", "s1"], [202, "", None, "s2"], [203, "12 34 !!", "de", "s2"], [None, made(rng, "en", 50), "en", "s3"], [204, "word " * 5000, "en", "s3"]]
    rows.append(list(rows[4]))  # a repeated row
    return [tuple(r) for r in rows]


def languages(rows):
    def vector(text):
        letters = [0]
        for c in text.lower():
            code = ord(c) if c.isalpha() else 0
            if code or letters[-1]:
                letters.append(code)
        if letters[-1]:
            letters.append(0)
        total = np.zeros(langid.DIMENSIONS)
        for (a, b, c), n in Counter(zip(letters, letters[1:], letters[2:])).items():
            total += n * np.roll(langid.letter(a), 2) * np.roll(langid.letter(b), 1) * langid.letter(c)
        return total / max(np.linalg.norm(total), 1e-12)

    sums = {}
    for _, text, lang, _ in rows:
        if lang is not None and text is not None:
            sums[lang] = sums.get(lang, 0) + vector(text)
    prototypes = [v / np.linalg.norm(v) for _, v in sorted(sums.items())]
    return [r for r in rows if any(c.isalpha() for c in r[1] or "") and max(vector(r[1]) @ p for p in prototypes) >= corpus_pipeline.LEAST_COSINE]


def ascii_lower(text):
    return text.encode().lower().split()


def lines(rows):
    places = sorted(((-(2**63) if r[0] is None else r[0]), k, frozenset(ascii_lower(x))) for r in rows for k, x in enumerate(r[1].split("\n")) if x.split())
    gone = {(d, k) for d, k, s in places for e, j, o in places if (e, j) < (d, k) and len(s & o) >= 0.8 * len(s | o) - 1e-9}
    out = []
    for r in rows:
        d = -(2**63) if r[0] is None else r[0]
        left = [x for k, x in enumerate(r[1].split("\n")) if (d, k) not in gone]
        if len(left) == len(r[1].split("\n")) or "\n".join(left).strip():
            out.append((r[0], "\n".join(left), *r[2:]))
    return out


def near_copies(rows):
    sets = []
    for r in rows:
        w = ascii_lower(r[1])
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    root = list(range(len(rows)))

    def top(i):
        return i if root[i] == i else top(root[i])

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    ids = [2**63 if r[0] is None else r[0] for r in rows]
    first = {}
    for i in range(len(rows)):
        first[top(i)] = min(first.get(top(i), 2**64), ids[i])
    keep = {rows[i][0] for i in range(len(rows)) if first[top(i)] == ids[i]}
    return list({(r[0], r[1]): r for r in rows if r[0] in keep}.values())


def test_run_is_brute_force(spark, tmp_path):
    rows = fixture()
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for name in ("score", "lang_pred", "size", "epochs", "rest", "copy", "node", "row", "target"):  # names that the operators use themselves
        table = table.withColumn(name, F.lit("x"))
    table.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    names = table.columns
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    want = rows
    for (name, stage), slow in zip(corpus_pipeline.STAGES[:3], (languages, lines, near_copies), strict=False):
        docs = stage(spark, docs, str(tmp_path)).checkpoint()
        want = slow(want)
        assert docs.columns == names, name
        assert Counter(tuple(r)[:4] for r in docs.collect()) == Counter(want), name
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, str(tmp_path)).checkpoint()
    assert mixed.columns == names
    size = Counter()
    for r in want:
        size[r[3]] += len(ascii_lower(r[1]))
    target = mixing.targets(list(size.items()))
    taken, got = Counter(), [tuple(r)[:4] for r in mixed.collect()]
    whole = Counter(want)
    for r in got:
        taken[r[3]] += len(ascii_lower(r[1]))
    assert all(abs(taken[s] - target[s]) <= 1 for s in size)
    full = Counter(r for r in got if r in whole)
    cut = [r for r in got if r not in whole]
    assert all(n <= 3 for n in full.values())
    for s in size:  # whole epochs for all, one more for some, one document at most cut, as the budget says
        epochs = [full[r] for r in want if r[3] == s]
        assert max(epochs) - min(epochs) <= 1 and sum(r[3] == s for r in cut) <= 1
    for r in cut:
        assert any(o[0] == r[0] and o[1].split()[: len(r[1].split())] == r[1].split() for o in want)
    ranks, pattern = bpe.vocabulary()
    theirs = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert all(r["round_trip"] for r in final)
    assert Counter((r["doc_id"], r["source"], r["lang"], tuple(r["ids"])) for r in final) == Counter((r[0], r[3], r[2], tuple(theirs.encode_ordinary(r[1]))) for r in got)


def test_stages_of_an_empty_table(spark):
    rows = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, "").checkpoint()
        assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert corpus_pipeline.STAGES[-1][1](spark, rows, "").count() == 0
