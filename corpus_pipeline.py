"""A training corpus from documents: languages, lines, near copies, mix, tokens.

Every stage takes the documents that the one before it left and returns the
columns of documents; the last one returns token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import bpe, common, langid, linededup, minhash, mixing

#: A document whose best cosine is below this fits no language.
LEAST_COSINE = 0.05


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fit a language; those without letters, null texts too, and those that fit none go.

    Prototypes are learned from the documents with a language; where none has
    one, none can be told and all go. Repeated rows are judged alike.
    """
    columns, found = tuple(docs.columns), ("__kindred_lang", "__kindred_score")
    rows = langid.identify(docs, langid.learn(docs), keep=columns, names_out=found)
    return rows.where((F.col(found[0]) != langid.UND) & (F.col(found[1]) >= LEAST_COSINE)).select(*columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier line; a document that loses all its text goes."""
    return linededup.without_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near copies; equal rows count once.

    Rows that share an id, a null one too, stand and fall together: they stay
    if one of them is the first of its group. Documents without words stay.
    """
    kept = minhash.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("__kindred_kept")).distinct()
    stay = docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("__kindred_kept")), "left_semi")
    return stay.dropDuplicates(["doc_id", "text"])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, repeated rows each on its own; the one at which a source's budget ends is cut there."""
    taken = mixing.mix(docs, rows=True).where("taken > 0")
    copies = F.sequence(F.lit(1), F.col("epochs").cast("int") + (F.col("rest") > 0).cast("int"))
    out = taken.withColumn("copy", F.explode(copies))
    words = F.filter(F.split("row.text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    cut = F.array_join(F.slice(words, F.lit(1), F.col("rest").cast("int")), " ")
    last = (F.col("copy") > F.col("epochs")) & (F.col("rest") < F.col("size"))
    text = F.when(last, cut).otherwise(F.col("row.text"))
    return out.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, ids, n_tokens, and whether decoding gave the text back; a null text has no ids."""
    out = bpe.encode(docs, *bpe.vocabulary(), keep=("doc_id", "source", "lang", "text"))
    return out.select("doc_id", "source", "lang", "ids", "n_tokens", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [("language_id", languages), ("line_dedup", lines), ("near_dedup", near_copies), ("mixing", mix), ("bpe", tokens)]
#: SQL can't express the stages' models and merges; tests/llm/test_pipeline.py holds ``run`` against a brute-force version of all five.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {}
