"""Mixing sources to target weights.

Every document gets a hash-random key. Within its source, documents are sorted
by that key and lined up end to end; a source's budget is laid along this line
again and again, so that all documents are taken as often as whole epochs fit
and the line is cut where the rest of the budget ends. The running sums are
distributed: the key's range is cut into coarse and fine ranges, their sums
are added up in two small windows, and only documents of one fine range, a few
thousand, are added up one by one. A source of any share is spread over all
its ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Documents that a fine range holds on average.
RANGE_ROWS = 2048
#: Ranges of a source are added up in so many coarse ones, each over its fine ones.
COARSE_BITS = 8
#: Words are runs of other characters than these; also the contract's pattern.
WORD = "[^\\x20\\x09-\\x0D]+"
#: A source is repeated so often at most.
MAX_EPOCHS = 3


def size_of(text: str):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sources: list[tuple[str | None, int]], max_epochs: int = MAX_EPOCHS) -> dict[str | None, float]:
    """Each source's target from (source, size): shares by weight, none above its cap.

    Sources are taken by code point with null last and weigh 1, 2, 3, 1, ...;
    the targets share the sum of all sizes. What a target has above
    ``max_epochs`` times its source's size is shared anew by weight among the
    sources below theirs, until none is above. Sources are few: they are names
    of origins, and this is the one thing that is worked out on the driver.
    """
    ordered = sorted(sources, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: 1.0 + i % 3 for i, (s, _) in enumerate(ordered)}
    cap = {s: float(max_epochs * size) for s, size in ordered}
    left, open_, out = float(sum(n for _, n in ordered)), dict(weight), {}
    while open_:
        total = sum(open_.values())
        over = [s for s, w in open_.items() if left * w / total > cap[s]]
        if not over:
            return out | {s: left * w / total for s, w in open_.items()}
        for s in over:
            out[s] = cap[s]
            open_.pop(s)
        left = float(sum(n for _, n in ordered)) - sum(out.values())
    return out


def _keyed(docs: DataFrame, doc_id: str, text: str, source: str, seed: int, *more) -> DataFrame:
    """(doc_id, source, size, key) and what else is asked for."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size_of(text).alias("size"), F.xxhash64(F.lit(seed), F.col(doc_id).cast("string"), F.col(text)).alias("key"), *more)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 17, rows: bool = False) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, epochs (whole copies), rest (words of a cut copy).

    With ``rows`` the document itself comes along, as a struct ``row`` of all
    its columns, whatever their names. Null texts have size 0 and are taken 0
    times; a null source is a source of its own. Null and repeated ids are
    told apart by their texts; rows that are equal in both, which have equal
    sizes, share what they get in any order. An empty table gives an empty
    result.
    """
    spark = docs.sparkSession
    sized = common.kept(_keyed(docs, doc_id, text, source, seed), "mixing-sizes")
    found = sized.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("docs")).collect()  # a row for each source
    target = targets([(r["source"], int(r["n"])) for r in found])
    known = spark.createDataFrame(
        [(r["source"], int(r["n"]), float(target[r["source"]]), min(int(round(target[r["source"]])), MAX_EPOCHS * int(r["n"]))) for r in found],
        "source string, source_size long, target double, budget long",
    )
    most = max((r["docs"] for r in found), default=1)
    bits = min(40, COARSE_BITS + max(0, (most // (RANGE_ROWS << COARSE_BITS)).bit_length()))
    fine = F.shiftrightunsigned("key", 64 - bits)
    sums = sized.groupBy("source", fine.alias("fine")).agg(F.sum("size").alias("n")).withColumn("coarse", F.shiftright("fine", bits - COARSE_BITS))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    coarse = sums.groupBy("source", "coarse").agg(F.sum("n").alias("n")).select("source", "coarse", before(Window.partitionBy("source").orderBy("coarse")).alias("coarse_before"))
    ranges = sums.select("source", "coarse", "fine", before(Window.partitionBy("source", "coarse").orderBy("fine")).alias("fine_before"))
    ranges = ranges.alias("r").join(coarse.alias("c"), F.expr("r.source <=> c.source AND r.coarse = c.coarse")).selectExpr("r.source", "fine", "fine_before + coarse_before AS start")
    ranges = ranges.alias("r").join(F.broadcast(known).alias("k"), F.expr("r.source <=> k.source")).selectExpr("r.source AS source", "fine", "start", "source_size", "target", "budget")  # a row for each source
    if rows:
        sized = _keyed(docs, doc_id, text, source, seed, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    inside = Window.partitionBy("source", "fine").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("fine", fine).withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    out = placed.alias("d").join(ranges.alias("r"), F.expr("d.source <=> r.source AND d.fine = r.fine")).selectExpr(
        "doc_id", "d.source AS source", "size", "source_size", "target", *["row"] * rows,
        "CASE WHEN source_size > 0 THEN budget DIV source_size ELSE 0 END AS epochs",
        "CASE WHEN source_size > 0 THEN greatest(0L, least(size, budget % source_size - (start + inside))) ELSE 0L END AS rest",
    )
    return out.selectExpr("doc_id", "source", "size", "source_size", "target", "epochs * size + rest AS taken", "epochs", "rest", *["row"] * rows)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
