"""Recall of candidates, profiles of inputs, splits, fallback and checks of results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _with(df: DataFrame, column: str) -> DataFrame:
    """A table with a number that is 1 unless it has it: for how many rows each stands."""
    return df if column in df.columns else df.withColumn(column, F.lit(1).cast("long"))


def recall(ids: DataFrame, truth: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per country, per source and over all ids (s1_id, country): true pairs, found ones, recall, ids and those with all found.

    Ids and true pairs may stand for several (copies), pairs for ``n`` found ones.
    """
    found = _with(truth, "copies").join(_with(pairs, "n").select("s1_id", "eid", F.col("n").alias("hit")), ["s1_id", "eid"], "left").fillna(0, ["hit"])
    found = found.withColumn("source", F.when(F.startswith("eid", F.lit("S2-")), "S2").otherwise("S3"))
    found = found.groupBy("s1_id", "source").agg(F.sum("copies").alias("n_true"), F.sum("hit").alias("n_found"))
    of = found.groupBy("s1_id").agg(F.sum("n_true").alias("n_true"), F.sum("n_found").alias("n_found"))
    ids = _with(ids, "copies").withColumnRenamed("copies", "times")
    every = ids.join(of, "s1_id", "left").fillna(0, ["n_true", "n_found"])
    times = lambda c: F.sum(F.col(c) * F.col("times")).alias(c)
    sums = lambda df: df.agg(times("n_true"), times("n_found"), F.sum("times").alias("ids"), F.coalesce(F.sum(F.when(F.col("n_true") == F.col("n_found"), F.col("times"))), F.lit(0)).alias("all_found"))
    total = sums(every).select(F.lit("all").alias("scope"), F.lit("").alias("value"), "n_true", "n_found", F.coalesce("ids", F.lit(0)).alias("ids"), "all_found")
    country = sums(every.groupBy("country")).select(F.lit("country"), "country", "n_true", "n_found", "ids", "all_found")
    source = found.join(ids.select("s1_id", "times"), "s1_id", "left").fillna(1, ["times"]).groupBy("source").agg(times("n_true"), times("n_found")).select(F.lit("source"), "source", "n_true", "n_found", F.lit(0).cast("long"), F.lit(0).cast("long"))
    out = total.union(country).union(source)
    return out.withColumn("recall", F.when(F.col("n_true") > 0, F.col("n_found") / F.col("n_true")).otherwise(F.lit(0.0)))


def missed(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    return truth.join(pairs, ["s1_id", "eid"], "left_anti").select("s1_id", "eid")


def diagnosis(lost: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """Names and shared tokens of missed pairs."""
    q = queries.select(F.col("eid").alias("s1_id"), F.col("norm_name").alias("s1_name"), F.col("toks").alias("s1_toks"))
    t = targets.select("eid", F.col("norm_name").alias("name"), "toks")
    return lost.join(q, "s1_id").join(t, "eid").select("s1_id", "eid", "s1_name", "name", F.array_join(F.array_sort(F.array_intersect("s1_toks", "toks")), ",").alias("shared"))


def sizes(ids: DataFrame, pairs: DataFrame, total_ids: int = 1_732_544) -> DataFrame:
    """Mean, positional median and 95th percentile, maximum and sum of candidates per id, and the size in MB of a full list. Ids and pairs may stand for several (copies)."""
    found = _with(pairs, "copies").groupBy("s1_id").agg(F.sum("copies").alias("n"))
    per = _with(ids, "copies").select("s1_id", "copies").join(found, "s1_id", "left").fillna(0, ["n"])
    out = _size_stats(per)
    return out.withColumn("file_mb", F.lit(total_ids) * (14 + F.col("mean") * 14) / (1024 * 1024))


def _size_stats(per: DataFrame) -> DataFrame:
    """One row about counts (n), each of ``copies`` ids: ids, mean, max, total, positional median and 95th percentile."""
    # counts are few different numbers: their histogram, added up, stands for the sorted list
    times = _with(per, "copies").groupBy("n").agg(F.sum("copies").alias("times"))
    steps = times.withColumn("upto", F.sum("times").over(Window.orderBy("n")))
    total = times.agg(F.coalesce(F.sum("times"), F.lit(0)).alias("ids"), (F.sum(F.col("n") * F.col("times")) / F.sum("times")).alias("mean"), F.max("n").alias("max"), F.sum(F.col("n") * F.col("times")).alias("total"))
    at = lambda place: F.min(F.when(F.col("upto") > place, F.col("n")))
    return steps.crossJoin(F.broadcast(total)).groupBy("ids", "mean", "max", "total").agg(at(F.floor(F.col("ids") / 2)).alias("median"), at(F.floor(F.col("ids") * 0.95)).alias("p95"))  # one row against a histogram


def posting_stats(sizes_: DataFrame) -> DataFrame:
    """Keys, entries, positional median and 95th percentile and the longest list of an index, from its lists' sizes."""
    return _size_stats(sizes_.select("n"))


def examples(lost: DataFrame, queries: DataFrame, targets: DataFrame, most: int = 10) -> DataFrame:
    """The first missed pairs by their ids, with names and shared tokens."""
    return diagnosis(lost.orderBy("s1_id", "eid").limit(most), queries, targets)


def match_histogram(lists: DataFrame) -> DataFrame:
    """How many ids have 0, 1, 2, 3 and 4 or more members (repeats counted); all five rows always."""
    n = F.size("members")
    counts = lists.groupBy(F.when(n >= 4, "4+").otherwise(n.cast("string")).alias("matches")).agg(F.count("*").alias("ids"))
    every = lists.sparkSession.createDataFrame([(x,) for x in ("0", "1", "2", "3", "4+")], "matches string")
    out = every.join(counts, "matches", "left").fillna(0, ["ids"])
    return out.crossJoin(F.broadcast(lists.agg(F.count("*").alias("all_ids")))).select("matches", "ids", F.when(F.col("all_ids") > 0, 100.0 * F.col("ids") / F.col("all_ids")).otherwise(0.0).alias("percent"))  # five rows


def match_stats(lists: DataFrame) -> DataFrame:
    n = F.size("members")
    return lists.agg(F.count("*").alias("ids"), F.sum(n).alias("links"), F.avg(n).alias("mean"), F.median(n).alias("median"), F.max(n).alias("max"), F.count_if(n == 0).alias("singletons"))


def countries(entities: DataFrame) -> DataFrame:
    """Entities by country, the most frequent first, equal ones by name."""
    country = F.trim(F.coalesce("country", F.lit("")))
    return entities.groupBy(F.when(country == "", "(empty)").otherwise(country).alias("country")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "country")


def missing_fields(entities: DataFrame) -> DataFrame:
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    return entities.agg(F.count("*").alias("n"), F.count_if(blank("business_name")).alias("no_name"), F.count_if(blank("business_address")).alias("no_address"), F.coalesce(100 * F.avg(blank("business_name").cast("double")), F.lit(0.0)).alias("no_name_percent"), F.coalesce(100 * F.avg(blank("business_address").cast("double")), F.lit(0.0)).alias("no_address_percent"))


def split_summary(lists: DataFrame, of) -> DataFrame:
    """Ids, links and singletons of each split; ``of`` gives an id's split."""
    n = F.size("members")
    return lists.groupBy(of.alias("split")).agg(F.count("*").alias("ids"), F.sum(n).alias("links"), F.count_if(n == 0).alias("singletons"))


def gathered(ids: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, members): a row for every id, members sorted, empty where there are none."""
    lists = pairs.groupBy("s1_id").agg(F.array_sort(F.collect_set("eid")).alias("members"))
    return ids.select("s1_id").join(lists, "s1_id", "left").select(F.col("s1_id").alias("id"), F.coalesce("members", F.array().cast("array<string>")).alias("members"))


def remaining(ids: DataFrame, done: DataFrame) -> DataFrame:
    """Ids (s1_id) that have no row in what is done (id)."""
    return ids.join(done.select(F.col("id").alias("s1_id")), "s1_id", "left_anti")


def fallback(ids: DataFrame, matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Every id (s1_id, at) in order: what both outputs have up to the first gap of either, empty lists after it."""
    rows = ids.join(matches.select(F.col("id").alias("s1_id"), F.col("members").alias("m")), "s1_id", "left").join(candidates.select(F.col("id").alias("s1_id"), F.col("members").alias("c")), "s1_id", "left")
    gap = rows.where("m IS NULL OR c IS NULL").agg(F.min("at").alias("gap"))
    empty = F.array().cast("array<string>")
    whole = F.col("gap").isNull() | (F.col("at") < F.col("gap"))
    return rows.crossJoin(F.broadcast(gap)).select("s1_id", "at", F.when(whole, F.col("m")).otherwise(empty).alias("members"), F.when(whole, F.col("c")).otherwise(empty).alias("candidates"))  # one row


def checks(ids: DataFrame, matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rows, empty and multiple matches, and whether all matches are candidates. Ids (s1_id) may stand for several (copies)."""
    ids = _with(ids, "copies")
    both = matches.join(candidates.select("id", F.col("members").alias("c")), "id", "left").join(ids.select(F.col("s1_id").alias("id"), "copies"), "id", "left").fillna(1, ["copies"])
    outside = F.size(F.array_except("members", F.coalesce("c", F.array().cast("array<string>")))) > 0
    n = lambda when: F.coalesce(F.sum(F.when(when, F.col("copies"))), F.lit(0))
    out = both.agg(n(F.lit(True)).alias("rows"), n(F.size("members") == 0).alias("n_empty"), n(F.size("members") > 1).alias("n_multiple"), n(outside).alias("n_outside"))
    return out.crossJoin(F.broadcast(ids.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("expected"))))  # one row
