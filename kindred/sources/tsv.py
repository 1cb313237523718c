"""Tab-separated sources and sinks; missing values are empty strings, never null."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTITY = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
DIALECT = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "multiLine": True, "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def filled(df: DataFrame) -> DataFrame:
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in df.columns])


def entities(spark: SparkSession, *paths: str, strip_country: bool = True, multi_line: bool = True) -> DataFrame:
    """Entity records by position; short rows end in empty fields, blank lines are skipped.

    Without ``multi_line``, for files whose fields hold no line ends, a file is
    read in as many parts as its size asks for; else in one.
    """
    out = filled(spark.read.schema(ENTITY).options(**DIALECT | {"multiLine": multi_line}).csv(list(paths)))
    return out.withColumn("country", F.trim("country")) if strip_country else out


def records_of(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Records of the ids in ``wanted`` (eid), columns found by their header names, the country as it stands."""
    rows = filled(spark.read.options(**DIALECT).csv(path)).select(*ENTITY.names)
    return rows.join(wanted.select(F.col("eid").alias("entity_id")), "entity_id", "left_semi")


def in_file_order(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """Entity records with ``place``, their number in the order of files and of lines in them; the first ``most`` of them, or all."""
    rows = spark.read.schema(ENTITY).options(**DIALECT).csv(path).select("*", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
    order = ("file_path", "file_block_start", "at")
    if most is not None:
        rows = rows.orderBy(*order).limit(most)
    per = rows.groupBy("file_path", "file_block_start").agg(F.count("*").alias("n"))  # a row for each part of a file
    before = per.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("file_path", "file_block_start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    inside = F.row_number().over(Window.partitionBy("file_path", "file_block_start").orderBy("at"))
    out = rows.withColumn("inside", inside).join(F.broadcast(before), ["file_path", "file_block_start"])
    return out.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ENTITY.names], (F.col("before") + F.col("inside")).alias("place"))


def _members(column: str):
    return F.when(F.trim(column) == "", F.array().cast("array<string>")).otherwise(F.split(column, ","))


def id_lists(spark: SparkSession, path: str, id_column: str = "source1_entity_id", list_column: str = "matched_entity_ids") -> DataFrame:
    """(id, members as listed, repeats kept); columns are found by their header names."""
    rows = filled(spark.read.options(**DIALECT).csv(path))
    missing = {id_column, list_column} - set(rows.columns)
    if missing:
        raise ValueError(f"{path} has no column {', '.join(sorted(missing))}")
    return rows.select(F.col(id_column).alias("id"), _members(list_column).alias("members"))


def id_sets(spark: SparkSession, path: str, id_column: str = "source1_entity_id", list_column: str = "matched_entity_ids") -> DataFrame:
    """As ``id_lists`` with distinct members; of rows with one id the last in the file counts."""
    rows = id_lists(spark, path, id_column, list_column).withColumn("at", F.monotonically_increasing_id())
    return rows.groupBy("id").agg(F.max_by("members", "at").alias("members")).withColumn("members", F.array_distinct("members"))


def id_sets_of(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """``id_sets`` of the ids in ``wanted`` (id) alone."""
    return id_sets(spark, path).join(wanted.select("id"), "id", "left_semi")


def candidates(spark: SparkSession, path: str, list_column: str = "candidate_entity_ids") -> tuple[DataFrame, DataFrame]:
    """(id, members) of a candidate file, and (eid) of all that are listed in it, each once."""
    lists = id_lists(spark, path, list_column=list_column)
    return lists, lists.select(F.explode("members").alias("eid")).distinct()


def ids(spark: SparkSession, path: str) -> DataFrame:
    """One id per line, trimmed, blanks dropped, sorted."""
    return spark.read.text(path).select(F.trim("value").alias("id")).where("id <> ''").orderBy("id")


def complete_lines(spark: SparkSession, path: str) -> DataFrame:
    """(id, rest) of the lines of a foreign file up to the first that has no line end."""
    whole = spark.read.text(path, wholetext=True)
    full = F.regexp_extract(F.col("value"), r"(?s)\A(.*\n)?", 0)
    rows = whole.select(F.posexplode(F.split(full, "\n")).alias("at", "line")).where("line <> ''")
    return rows.select("at", F.substring_index("line", "\t", 1).alias("id"), F.regexp_replace("line", r"^[^\t]*\t?", "").alias("rest"))


def as_list(members):
    return F.array_join(F.array_sort(F.array_distinct(members)), ",")


def write_id_lists(lists: DataFrame, path: str, list_column: str = "matched_entity_ids", ordered: bool = True) -> None:
    """(id, members) as two columns, members sorted and joined by commas; empty lists are empty fields."""
    out = lists.select(F.col("id").alias("source1_entity_id"), as_list("members").alias(list_column))
    out = out.orderBy("source1_entity_id") if ordered else out
    out.write.mode("overwrite").options(sep="\t", header=True, emptyValue="", quote="").csv(path)


def write_split(lists: DataFrame, path: str, of) -> None:
    """(id, members) into a folder for each split, which ``of`` gives."""
    out = lists.select(of.alias("split"), F.col("id").alias("source1_entity_id"), as_list("members").alias("matched_entity_ids"))
    out.write.mode("overwrite").partitionBy("split").options(sep="\t", header=True, emptyValue="", quote="").csv(path)


def write_in_order(rows: DataFrame, path: str, by: str, columns: dict[str, str]) -> None:
    """Rows in the order of a column, file after file; ``columns``: what is written, under which names."""
    out = rows.orderBy(by).select(*[F.col(c).alias(n) for c, n in columns.items()])
    out.write.mode("overwrite").options(sep="\t", header=True, emptyValue="", quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_ids(rows: DataFrame, path: str, column: str = "id") -> None:
    rows.select(F.col(column).cast("string").alias("value")).orderBy("value").write.mode("overwrite").text(path)


def write_entities(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.select(*ENTITY.names).write.mode(mode).options(sep="\t", header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_summary(row: DataFrame, path: str) -> None:
    """A table of one row, as JSON."""
    row.write.mode("overwrite").json(path)


def write_store(rows: DataFrame, path: str) -> DataFrame:
    """Entity records by id, the first of equal ids, as the table that details are looked up in."""
    first = rows.withColumn("at", F.monotonically_increasing_id()).groupBy("entity_id").agg(F.min_by(F.struct(*ENTITY.names[1:]), "at").alias("r"))
    first.select("entity_id", "r.*").write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.parquet(path)


def last_records(rows: DataFrame, order: str) -> DataFrame:
    """Of records with one id the last in the order of a column."""
    last = rows.groupBy("entity_id").agg(F.max_by(F.struct(*ENTITY.names[1:]), order).alias("r"))
    return last.select("entity_id", "r.*")


def lookup(store: DataFrame, wanted: DataFrame) -> DataFrame:
    """Details of the ids in ``wanted`` (eid)."""
    return store.join(wanted.select(F.col("eid").alias("entity_id")), "entity_id", "left_semi")
