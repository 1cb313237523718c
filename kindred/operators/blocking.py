"""Candidate generation: postings, seven equi-join strategies, ranking and the cap.

Every strategy gives hits (s1_id, eid, strategy, bit, score), one for each
posting that a query's key meets, so what finds a target twice scores twice.
Postings are never held as an index: they are the build sides of joins, each
with the number of entries that its key has on the target side (``sized``), by
which they are gated. Strategies that use one index share its plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.session import kept

from . import overlap

# Each strategy's bit in the mask and its score in the rank.
BITS = {"S1": 64, "S2": 32, "S4": 16, "S6": 8, "S3": 4, "S5": 2, "S7": 1}
SCORES = {"S1": 64, "S2": 32, "S4": 16, "S7": 12, "S6": 8, "S3": 4, "S5": 2}
MAX_POSTING, MAX_PER_STRATEGY, MAX_ADDRESS, MIN_OVERLAP, MAX_TOTAL = 50_000, 10_000, 200, 2, 200


def _variants(a: str, b: str):
    return F.explode(F.array_distinct(F.array(a, b)))


def keys(rep: DataFrame, index: str) -> DataFrame:
    """(key, country, eid) of one index: name, core, token, addr or addrnum. A key is an array of strings. ``copies`` go along where rows stand for several entities."""
    one = lambda *cols: F.array(*cols)
    own = ["eid", "country", *(["copies"] if "copies" in rep.columns else [])]
    if index == "name":
        out = rep.where("norm_name <> ''").select(*own, _variants("norm_name", "norm_name_af").alias("k")).withColumn("key", one("k"))
    elif index == "core":
        out = rep.where("core_name <> ''").select(*own, _variants("core_name", "core_name_af").alias("k")).withColumn("key", one("k"))
    elif index == "token":
        out = rep.select(*own, F.explode(F.array_distinct("toks")).alias("k")).withColumn("key", one("k"))
    elif index == "addr":
        out = rep.where("size(addr_nums) > 0 AND size(toks) > 0").withColumn("key", F.concat("addr_nums", one(F.get("toks", F.lit(0)))))
    else:
        out = rep.where("size(addr_nums) > 0").withColumn("key", F.col("addr_nums"))
    return out.select("key", "country", "eid", *own[2:])


def posting_sizes(postings: DataFrame) -> DataFrame:
    n = F.sum("copies") if "copies" in postings.columns else F.count("*")
    return postings.groupBy("key", "country").agg(n.alias("n"))


def sized(postings: DataFrame) -> DataFrame:
    """Postings with ``n``, how many entries their list has."""
    return postings.join(posting_sizes(postings), ["key", "country"])


def gated(postings: DataFrame, most: int) -> DataFrame:
    """Postings whose list has at most ``most`` entries, whole or not at all."""
    return (postings if "n" in postings.columns else sized(postings)).where(F.col("n") <= most).select("key", "country", "eid")


def dropped(postings: DataFrame, most: int) -> DataFrame:
    """Targets whose list is too long."""
    return sized(postings).where(F.col("n") > most).select("eid").distinct()


def indexes(targets: DataFrame) -> dict[str, DataFrame]:
    """The five indexes over targets, each planned once."""
    return {index: sized(keys(targets, index)) for index in ("name", "core", "token", "addr", "addrnum")}


def asked_tokens(queries: DataFrame, targets: DataFrame) -> DataFrame:
    """Of the token index, the lists that some query's squashed name asks for, whole: those of all tokens are far more than their texts."""
    longest = targets.agg(F.max(F.array_max(F.transform("toks", F.char_length))).alias("longest"))
    squash = queries.where("size(toks) >= 2").select(F.col("squash").alias("k"))
    asked = kept(squash.crossJoin(F.broadcast(longest)).where(F.char_length("k") <= F.col("longest")).select("k").distinct(), "asked")  # one row
    return sized(kept(keys(targets, "token").withColumn("k", F.get("key", F.lit(0))).join(asked, "k", "left_semi").drop("k"), "tokens"))


def _hits(pairs: DataFrame, strategy: str) -> DataFrame:
    return pairs.select("s1_id", "eid", F.lit(strategy).alias("strategy"), F.lit(BITS[strategy]).alias("bit"), F.lit(SCORES[strategy]).alias("score"))


def _asked(rep: DataFrame, index: str) -> DataFrame:
    return keys(rep, index).select("key", "country", F.col("eid").alias("s1_id"))


def strategy(name: str, queries: DataFrame, targets: DataFrame, most: int = MAX_PER_STRATEGY, most_tokens: int = MAX_POSTING, most_address: int = MAX_ADDRESS, index: dict[str, DataFrame] | None = None) -> DataFrame:
    """Hits of one strategy, S1 to S7, of represented queries among represented targets; ``index``: those of the targets."""
    index = index or indexes(targets)
    if name in ("S1", "S2", "S4"):
        own = {"S1": "name", "S2": "core", "S4": "addr"}[name]
        return _hits(_asked(queries, own).join(gated(index[own], most), ["key", "country"]), name)
    if name == "S3":
        return _hits(token_overlap(queries, targets, most, most_tokens), name)
    if name == "S5":
        asked = queries.where("norm_name <> ''").select(F.col("eid").alias("s1_id"), F.array("norm_name").alias("key"), F.col("country").alias("home"))
        return _hits(asked.join(gated(index["name"], most), "key").where("country <> home"), name)
    if name == "S6":
        asked = queries.where("size(toks) >= 2").select(F.col("eid").alias("s1_id"), F.array("squash").alias("key"))
        return _hits(asked.join(gated(index["token"], min(most, most_tokens)), "key"), name)
    asked = _asked(queries.where("size(addr_nums) >= 2"), "addrnum")
    return _hits(asked.join(gated(index["addrnum"], min(most, most_address)), ["key", "country"]), name)


def token_overlap(queries: DataFrame, targets: DataFrame, most: int = MAX_PER_STRATEGY, most_tokens: int = MAX_POSTING) -> DataFrame:
    """(s1_id, eid), each pair once: targets of the same country that share enough tokens.

    One token is enough for names of one token, else two; repeats count in
    that, not in what is shared. With more than ``most`` targets one more token
    is asked for, if the name has it, and beyond that nothing is found.
    """
    left, right = overlap.dealt(queries, targets, most, most_tokens)
    return overlap.written(right, overlap.marked(left, right, most)).select("s1_id", "eid")


def pairs(queries: DataFrame, targets: DataFrame, most: int = MAX_PER_STRATEGY, most_tokens: int = MAX_POSTING, most_address: int = MAX_ADDRESS) -> DataFrame:
    """As ``ranked`` of ``hits``, without a row for each hit; with ``copies``, how many entities the target stands for."""

    def others(q: DataFrame, t: DataFrame) -> list[DataFrame]:
        index = indexes(t) | {"token": asked_tokens(q, t)}
        return [strategy(s, q, t, most, most_tokens, most_address, index) for s in ("S1", "S2", "S4", "S5", "S6", "S7")]

    return overlap.pairs(queries, targets, others, most, most_tokens)


def hits(queries: DataFrame, targets: DataFrame, **gates: int) -> DataFrame:
    index = indexes(targets)
    return reduce(DataFrame.unionByName, [strategy(s, queries, targets, index=index, **gates) for s in ("S1", "S2", "S3", "S4", "S5", "S6", "S7")])


def ranked(found: DataFrame) -> DataFrame:
    """(s1_id, eid, mask, rank): the strategies that found a pair, and the sum of their scores."""
    return found.groupBy("s1_id", "eid").agg(F.bit_or("bit").alias("mask"), F.sum("score").alias("rank"))


def capped(pairs: DataFrame, most: int | None = MAX_TOTAL) -> DataFrame:
    """Each query's best pairs by rank, ties to the smaller id; all of them without a cap."""
    if not most:
        return pairs
    order = Window.partitionBy("s1_id").orderBy(F.desc("rank"), "eid")
    return pairs.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= most).drop("rn")


def strategy_counts(pairs: DataFrame, times=None) -> DataFrame:
    """How many pairs each strategy found, of those that are left; ``times``: for how many a row stands."""
    sums = pairs.agg(*[F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(b) != 0, F.lit(1).cast("long") if times is None else times)), F.lit(0)).alias(s) for s, b in BITS.items()])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(s).alias("strategy"), F.col(s).alias("n")) for s in BITS])))


def audit(pairs: DataFrame) -> DataFrame:
    """Per strategy: pairs returned, new to those before it, true pairs, true pairs that it alone found. pairs: (mask, true_pair, times), for ``times`` pairs each."""
    pairs = pairs.groupBy("mask", "true_pair").agg(F.sum("times").alias("times"))
    named = F.array(*[F.when(F.col("mask").bitwiseAND(BITS[s]) != 0, F.lit(s)) for s in sorted(BITS)])
    pairs = pairs.withColumn("by", F.array_compact(named)).select("by", "true_pair", "times", F.explode("by").alias("strategy"))
    n = lambda when: F.coalesce(F.sum(F.when(when, F.col("times"))), F.lit(0))
    return pairs.groupBy("strategy").agg(F.sum("times").alias("returned"), n(F.get("by", F.lit(0)) == F.col("strategy")).alias("new"), n(F.col("true_pair")).alias("true_touched"), n(F.col("true_pair") & (F.size("by") == 1)).alias("true_only"))
