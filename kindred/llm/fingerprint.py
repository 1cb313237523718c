"""Document fingerprints: a Merkle tree over sections, paragraphs and blocks.

DataFrame functions only. A text is cut into sections at empty lines, a section
into paragraphs at line ends, and a paragraph into blocks: its first 64 code
points into blocks of 8, the rest into blocks of 32, so that a block's bounds
depend only on its distance from the paragraph's start and an edit touches the
blocks of its own paragraph. No character is left out, so the parts give the
text back. Leaves are 64-bit hashes of blocks, a paragraph's hash is taken over
its leaves, a section's over its paragraphs and the root over the sections: the
root is equal if, but for collisions, the text is.

The fingerprint is the root, a colon, and the tree: sections are parted by
``/``, each its hash, ``=`` and its paragraphs, parted by ``.``, each its hash
and its leaves, of which the last 8 hex digits are kept. ``likeness`` takes
equal paragraphs by their hashes and looks at leaves in the others alone;
``differences`` goes down the branches that differ and tells where they do.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

HEAD, SMALL, LARGE = 64, 8, 32
#: Documents of a range that are sorted together to find each one's successor, about; ranges at most, beyond which they grow; ranges of a group, which bounds the comparisons for a row.
RANGE_ROWS, RANGES, GROUP = 2048, 1 << 16, 256
#: Hex digits of the root, of a section's and a paragraph's hash, and of a leaf.
ROOT, INNER, LEAF = 64, 16, 8


def _hash(x: Column, digits: int = INNER) -> Column:
    return F.left(F.sha2(x, 256), F.lit(digits))


def paragraph_of(paragraph: Column) -> Column:
    """A paragraph's hash and leaves."""
    small = F.regexp_extract_all(F.left(paragraph, F.lit(HEAD)), F.lit(f"(?s).{{1,{SMALL}}}"), F.lit(0))
    large = F.regexp_extract_all(F.substring(paragraph, HEAD + 1, 2147483647), F.lit(f"(?s).{{1,{LARGE}}}"), F.lit(0))
    leaves = F.transform(F.concat(small, large), lambda b: F.lpad(F.hex(F.xxhash64(b)), 16, "0"))
    # the hash is over all 64 bits of the leaves
    return F.transform(F.array(leaves), lambda x: F.concat(_hash(F.array_join(x, "")), F.array_join(F.transform(x, lambda one: F.right(one, F.lit(LEAF))), "")))[0]


def section_of(section: Column) -> Column:
    """A section's hash, ``=`` and its paragraphs."""
    paragraphs = F.transform(F.split(section, "\n"), paragraph_of)
    return F.transform(F.array(paragraphs), lambda ps: F.concat(_hash(F.array_join(F.transform(ps, lambda p: F.left(p, F.lit(INNER))), "")), F.lit("="), F.array_join(ps, ".")))[0]


def fingerprint_of(text: Column) -> Column:
    """Root, colon and tree of a text; a null one counts as empty."""
    sections = F.transform(F.split(F.coalesce(text, F.lit("")), "\n\n"), section_of)
    return F.transform(F.array(sections), lambda ss: F.concat(_hash(F.array_join(F.transform(ss, lambda s: F.left(s, F.lit(INNER))), ""), ROOT), F.lit(":"), F.array_join(ss, "/")))[0]


def sections(fingerprint: Column) -> Column:
    return F.split(F.substring(fingerprint, ROOT + 2, 2147483647), "/")


def paragraphs(section: Column) -> Column:
    return F.split(F.substring(section, INNER + 2, 2147483647), "\\.")


def leaves(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.substring(paragraph, INNER + 1, 2147483647), F.lit(f".{{{LEAF}}}"), F.lit(0))


def distinct_paragraphs(fingerprint: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(sections(fingerprint), paragraphs)))


def likeness(a: Column, b: Column, paragraphs_a: Column, paragraphs_b: Column) -> Column:
    """1 for equal roots, else below 1: twice the common leaves over all leaves of both.

    Leaves are those of each side's distinct paragraphs; a paragraph that both
    have counts whole, and of the others the distinct leaves.
    """
    count = lambda ps: F.aggregate(ps, F.lit(0), lambda n, p: n + ((F.length(p) - INNER) / LEAF).cast("int"))
    left = lambda x, y: F.array_distinct(F.flatten(F.transform(F.array_except(x, y), leaves)))
    parts = F.array(F.struct(count(F.array_intersect(paragraphs_a, paragraphs_b)).alias("both"), left(paragraphs_a, paragraphs_b).alias("x"), left(paragraphs_b, paragraphs_a).alias("y")))
    share = F.transform(parts, lambda p: 2.0 * (p["both"] + F.size(F.array_intersect(p["x"], p["y"]))) / F.greatest(F.lit(1), 2 * p["both"] + F.size(p["x"]) + F.size(p["y"])))[0]
    return F.when(F.left(a, F.lit(ROOT)) == F.left(b, F.lit(ROOT)), F.lit(1.0)).otherwise(F.least(share, F.lit(0.999999)))


def differences(a: Column, b: Column) -> Column:
    """Where two fingerprints differ: array<struct<section, paragraph, leaf>>, counted from 0, empty for equal roots.

    Only branches with different hashes are gone into. A section or paragraph
    that one side alone has is given without the numbers below it.
    """

    def apart(x: Column, y: Column, key):
        """Places at which two lists of branches differ, or one has ended."""
        places = F.sequence(F.lit(0), F.greatest(F.size(x), F.size(y)) - 1)
        return F.filter(F.when(F.greatest(F.size(x), F.size(y)) > 0, places).otherwise(F.array().cast("array<int>")), lambda i: ~key(F.get(x, i)).eqNullSafe(key(F.get(y, i))))

    def path(i, j=None, k=None):
        null = F.lit(None).cast("int")
        return F.struct(i.alias("section"), (null if j is None else j).alias("paragraph"), (null if k is None else k).alias("leaf"))

    head = lambda x: F.left(x, F.lit(INNER))
    one = lambda x, y: x.isNull() | y.isNull()

    def in_paragraphs(i, j, p, q):
        return F.when(one(p, q), F.array(path(i, j))).otherwise(F.transform(apart(leaves(p), leaves(q), lambda x: x), lambda k: path(i, j, k)))

    def in_sections(i, s, t):
        x, y = paragraphs(s), paragraphs(t)
        return F.when(one(s, t), F.array(path(i))).otherwise(F.flatten(F.transform(apart(x, y, head), lambda j: in_paragraphs(i, j, F.get(x, j), F.get(y, j)))))

    x, y = sections(a), sections(b)
    return F.when(F.left(a, F.lit(ROOT)) == F.left(b, F.lit(ROOT)), F.array().cast("array<struct<section:int,paragraph:int,leaf:int>>")).otherwise(F.flatten(F.transform(apart(x, y, head), lambda i: in_sections(i, F.get(x, i), F.get(y, i)))))


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Adds a fingerprint to every row; null texts count as empty, equal ones have equal fingerprints. A column of the name ``out`` is replaced."""
    return docs.withColumn(out, fingerprint_of(F.col(text)))


def range_of(value: Column, cuts: list) -> Column:
    """How many of the ascending cuts are at or below a value: first among every ``GROUP``-th cut, then within the group."""
    if not cuts:
        return F.lit(0)
    groups = [cuts[i : i + GROUP] for i in range(0, len(cuts), GROUP)]
    array = lambda x, kind: F.from_json(F.lit(json.dumps(x)), kind)
    below = lambda bounds: F.size(F.filter(bounds, lambda b: b <= value))
    group = below(array([g[0] for g in groups], "array<long>"))
    return F.when(group > 0, (group - 1) * GROUP + below(F.get(array(groups, "array<array<long>>"), group - 1))).otherwise(0)


def with_successor(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, next_text): each document with the text of the next by ascending id; the last has the first's.

    Documents are dealt by ranges of ids, of a few thousand each until there
    are ``RANGES``, and each text moves once. The first document of each range
    goes to the range before it as well, as the successor of that range's last;
    those are as few as the ranges. Equal ids are taken in the order of their
    texts; null ids come first. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ids = rows.select(F.col("doc_id").cast("long").alias("doc_id"))
    ranges = min(RANGES, max(1, ids.count() // RANGE_ROWS))
    cuts: list = []
    if ranges > 1:
        steps = [i / ranges for i in range(1, ranges)]
        cuts = sorted({c for c in ids.agg(F.percentile_approx("doc_id", steps, min(10 * ranges, 200_000))).first()[0] or []})  # as many as ranges
    at = F.when(F.col("doc_id").isNull(), 0).otherwise(range_of(F.col("doc_id"), cuts))
    rows = rows.withColumn("part", at.cast("int"))
    firsts = rows.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("f")).select("part", "f.doc_id").orderBy("part").collect()  # a row for each range
    ghosts = [(firsts[i]["doc_id"], firsts[i - 1]["part"]) for i in range(len(firsts))]
    told = spark.createDataFrame(ghosts, "first_id long, to int")
    heads = rows.join(F.broadcast(told), F.col("doc_id").eqNullSafe(F.col("first_id")))  # a row for each range
    heads = heads.groupBy("first_id", "to").agg(F.min("text").alias("text"))
    every = rows.select("part", "doc_id", "text", F.lit(False).alias("ghost")).unionByName(
        heads.select(F.col("to").alias("part"), F.col("first_id").alias("doc_id"), "text", F.lit(True).alias("ghost"))
    )
    order = Window.partitionBy("part").orderBy("ghost", F.col("doc_id").asc_nulls_first(), "text")
    return every.withColumn("next_text", F.lead("text").over(order)).where(~F.col("ghost")).select("doc_id", "text", "next_text")


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_successor(common.table(spark, sf_dir, "documents"))
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half)))
    for name, column in (("fingerprint", "text"), ("edited_fingerprint", "edited"), ("next_fingerprint", "next_text")):
        rows = rows.withColumn(name, fingerprint_of(F.col(column)))
    for name in ("fingerprint", "edited_fingerprint", "next_fingerprint"):
        rows = rows.withColumn(f"{name}_parts", distinct_paragraphs(F.col(name)))
    near = lambda other: likeness(F.col("fingerprint"), F.col(other), F.col("fingerprint_parts"), F.col(f"{other}_parts"))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        near("edited_fingerprint").alias("near_edited"), near("next_fingerprint").alias("near_next"),
    )
