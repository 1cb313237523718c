"""The ten queries on a small table with hard rows: columns, held-out rows, brute force where the result is fixed, and empty tables."""

import math
import random
import zlib
from collections import Counter

import pytest
import regex

from kindred.llm import catalog, mixing

WORD = regex.compile(rb"[^\x20\x09-\x0d]+")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score double, node string, label int, size long"
COLUMNS = {
    "op1_langid": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op2_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op3_linededup": {"doc_id": "bigint", "n_lines": "int", "n_removed": "int", "removed_lines": "string"},
    "op4_minhash": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op5_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op6_fingerprint": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op7_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op9_ann": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op10_lm": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
}
HELD = {"op1_langid": (4, 2), "op7_toxicity": (4, 2), "op8_quality": (3, 1), "op10_lm": (7, 2)}


def rows():
    rng = random.Random(9)
    pool = [f"{rng.choice('abcdefgh')}{i}" for i in range(60)]
    texts = ["\n".join(" ".join(rng.choice(pool) for _ in range(rng.randint(3, 20))) for _ in range(rng.randint(1, 5))) for _ in range(80)]
    texts[10:14] = [None, "", " \n\t", "ÀB c\x85d\xa0e \x1c É"]
    texts[20] = "long " * 4000
    texts[30] = texts[31] = texts[32]
    out = [(i, t, ("en", "de", None)[i % 3], (None, "b", "a", "B")[i % 4], 0, 0.5, "x", 1, 2) for i, t in enumerate(texts)]
    return out + [out[5], (None, "a null id a1", "en", "a", 0, 0.5, "x", 1, 2), (7, "another text of one id", "en", "b", 0, 0.5, "x", 1, 2)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("contract")
    spark.createDataFrame(rows(), DOCUMENTS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, i % 2, int(i % 5 == 0), "x", "y") for i in range(70)] + [(3, None, None, "x", "y"), (4, 1, 1, "x", "y"), (None, 1, 1, "x", "y"), (999, 1, 1, "x", "y")]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string, label string").write.parquet(f"{folder}/labels.parquet")
    rng = random.Random(2)
    spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(8)], "x") for i in range(101)], "vec_id long, embedding array<float>, score string").write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def words_of(text):
    return [w.lower() for w in WORD.findall((text or "").encode())]


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_rows_and_held_out(spark, tables, name):
    out = catalog.queries()[name](spark, tables)
    assert {c: k for c, k in out.dtypes if c in COLUMNS[name]} == COLUMNS[name]
    got = out.collect()
    if name == "op9_ann":
        assert len(got) == 15 and {r["query_id"] for r in got} == {0, 50, 100}
        return
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows())
    if name in HELD:
        of, is_ = HELD[name]
        for r in got:
            assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % of == is_)
            assert name == "op10_lm" or 0 <= r["score"] <= 1
    if name == "op1_langid":
        assert all((r["lang_pred"] == "und") == (r["doc_id"] in (10, 11, 12)) for r in got) and {r["lang_pred"] for r in got} <= {"en", "de", "und"}
    if name in ("op7_toxicity", "op8_quality"):
        least = 0.3 if name == "op7_toxicity" else 0.5
        assert all(r["predicted"] == int(r["score"] >= least) for r in got)


def test_mixing_is_brute_force(spark, tables):
    docs = rows()
    got = catalog.queries()["op5_mixing"](spark, tables).collect()
    size = Counter()
    for r in docs:
        size[r[3]] += len(words_of(r[1]))
    target = mixing.targets(list(size.items()))
    assert Counter((r["doc_id"], r["size"], r["source_size"], r["target"]) for r in got) == Counter((r[0], len(words_of(r[1])), size[r[3]], target[r[3]]) for r in docs)
    order = sorted(size, key=lambda s: (s is None, s or ""))
    assert order == ["B", "a", "b", None]
    # targets: shares by weight, 3 times a source's size at most, the excess shared anew
    left, open_, want = float(sum(size.values())), {s: 1 + k % 3 for k, s in enumerate(order)}, {}
    while over := [s for s in open_ if left * open_[s] / sum(open_.values()) > 3 * size[s]]:
        for s in over:
            want[s] = 3.0 * size[s]
            del open_[s]
        left = sum(size.values()) - sum(want.values())
    want |= {s: left * w / sum(open_.values()) for s, w in open_.items()}
    assert target == pytest.approx(want)
    source_of = {n: s for s, n in size.items()}
    assert len(source_of) == len(size)
    taken = Counter()
    for r in got:
        s = source_of[r["source_size"]]
        taken[s] += r["taken"]
        epochs = int(round(target[s])) // size[s]
        assert r["size"] * epochs <= r["taken"] <= r["size"] * min(3, epochs + 1)
    assert all(abs(taken[s] - target[s]) <= 1 for s in size)
    for s in size:  # one document at most is cut
        assert sum(r["taken"] % r["size"] > 0 for r in got if r["size"] and source_of[r["source_size"]] == s) <= 1
    assert sorted(map(str, got)) == sorted(map(str, catalog.queries()["op5_mixing"](spark, tables).collect()))


def test_base_model_is_brute_force(spark, tables):
    docs = rows()
    train = [r[1] for r in docs if r[0] is None or zlib.crc32(str(r[0]).encode()) % 7 != 2]
    count = Counter(w for t in train for w in [*words_of(t), b"end of text"])
    n, v = sum(count.values()), len(count)
    want = Counter()
    for r in docs:
        tokens = [*words_of(r[1]), b"end of text"]
        want[r[0], len(tokens), sum(count[w] > 0 for w in tokens), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens), 6)] += 1
    got = catalog.queries()["op10_lm"](spark, tables).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


@pytest.mark.parametrize("name", COLUMNS)
def test_empty_tables(spark, tmp_path, name):
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    out = catalog.queries()[name](spark, str(tmp_path))
    assert {c: k for c, k in out.dtypes if c in COLUMNS[name]} == COLUMNS[name] and out.count() == 0
