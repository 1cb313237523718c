"""op6 against a tree worked out in Python, the place of edits, and successors."""

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from kindred.llm import fingerprint


def tree(text):
    def paragraph(p):
        head, rest = p[:64], p[64:]
        blocks = [head[i : i + 8] for i in range(0, len(head), 8)] + [rest[i : i + 32] for i in range(0, len(rest), 32)]
        leaves = [f"{xxhash.xxh64_intdigest(b.encode(), seed=42):016X}" for b in blocks]
        return sha("".join(leaves))[:16], [x[-8:] for x in leaves]

    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    sections = []
    for s in text.split("\n\n"):
        ps = [paragraph(p) for p in s.split("\n")]
        sections.append((sha("".join(h for h, _ in ps))[:16], ps))
    return sha("".join(h for h, _ in sections)), sections


def printed(t):
    root, sections = t
    return root + ":" + "/".join(h + "=" + ".".join(p + "".join(ls) for p, ls in ps) for h, ps in sections)


def near(a, b):
    if a[0] == b[0]:
        return 1.0
    x, y = ({(h, tuple(ls)) for _, ps in t[1] for h, ls in ps} for t in (a, b))
    both = sum(len(ls) for _, ls in x & y)
    u, v = ({leaf for _, ls in z for leaf in ls} for z in (x - y, y - x))
    return min(0.999999, 2 * (both + len(u & v)) / max(1, 2 * both + len(u) + len(v)))


def texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé漢😀") for _ in range(rng.randint(1, 9)))
    out = [None, "", "\n", "\n\n", "a", "x" * 5000, "a\r\nb\x85c d\n \ne"]
    out += ["\n".join(" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 9))).replace("\n \n", "\n\n") for _ in range(60)]
    return out + out[3:12]


def test_query_is_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fingerprint, "RANGE_ROWS", 4)
    monkeypatch.setattr(fingerprint, "GROUP", 3)
    rows = [(3 * i - 20, t) for i, t in enumerate(texts())]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"fingerprint": F.lit("x"), "part": F.lit(1), "next_text": F.lit("y")})
    table.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in fingerprint.op6_fingerprint(spark, str(tmp_path)).collect()}
    assert set(got) == {i for i, _ in rows} and len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        own, other, following = tree(t), tree(edited), tree(after)
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (printed(own), printed(other))
        assert (r["near_edited"], r["near_next"]) == pytest.approx((near(own, other), near(own, following)))


def test_differences_locate_edits(spark):
    text = "one line here\nanother line of some length that goes beyond the first blocks of it\n\nsecond section\n\nthird section\nits end"
    cases = [(text, text, []), (text, text.replace("some", "same"), [(0, 1, 2)]), (text, text.replace("second", "SECOND"), [(1, 0, 0)]), (text, text + "\nmore", [(2, 2, None)]), (text, text + "\n\nmore", [(3, None, None)]), ("", "a", [(0, 0, 0)])]
    table = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, a string, b string")
    got = table.select("i", fingerprint.differences(fingerprint.fingerprint_of(F.col("a")), fingerprint.fingerprint_of(F.col("b"))).alias("d")).collect()
    for r in got:
        assert [tuple(x) for x in r["d"]] == cases[r["i"]][2], cases[r["i"]]


def test_successors_of_null_and_repeated_ids(spark):
    rows = [(None, "n"), (None, "m"), (5, "b"), (5, "a"), (9, None)]
    got = sorted((r["text"], r["next_text"]) for r in fingerprint.with_successor(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [("", "m"), ("a", "b"), ("b", ""), ("m", "n"), ("n", "a")]
    assert fingerprint.with_successor(spark.createDataFrame([], "doc_id long, text string")).count() == 0
