"""Nearest neighbours by cosine: an inverted-file index scanned with adaptive dimensions.

Vectors are scaled to unit length and turned by one random rotation, so that
any block of their columns is a fair sample of a distance. Centroids are fitted
on a bounded sample; every vector is filed under its nearest centroid. Within
each probed list, a query adds up partial distances block of columns by block:
from the first d of D columns the whole distance is estimated as D/d times the
part, and a candidate is abandoned once a hypothesis test says that it can't be
below the k-th best distance so far. What survives all blocks is measured in
double precision on the original vectors.

A query looks into a share of the lists, the nearest first, and into more until
these hold a least number of vectors; a query that still finds fewer than k
looks into all. Lists are packed into shards of bounded size, and a list that
holds more than one shard is spread over several, so a list with a third of all
vectors is searched like any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Rows that centroids are fitted on, chosen by a hash of their ids, and their bytes, at most; rows of a shard; columns of a step; the test's width.
SAMPLE, SAMPLE_BYTES, SHARD, STEP, WIDTH = 20_000, 32 << 20, 4096, 16, 3.2
#: Share of the lists that a query looks into, vectors that they hold at least; lists at most.
PROBED, LEAST, LISTS = 0.4, 1024, 4096
K = 5


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v) without null ids and vectors that are null, zero, or have null or non-finite components."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings the largest component near 1: no cosine changes, and no square leaves the range."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rotation(size: int, seed: int = 9) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))[0]


def centroids(sample: np.ndarray, count: int, rounds: int = 8, seed: int = 9) -> np.ndarray:
    """Spherical k-means on unit vectors."""
    rng = np.random.default_rng(seed)
    out = sample[rng.permutation(len(sample))[:count]].copy()
    for _ in range(rounds):
        near = (sample @ out.T).argmax(axis=1)
        sums = np.zeros_like(out)
        np.add.at(sums, near, sample)
        norm = np.sqrt((sums * sums).sum(axis=1))
        out[norm > 1e-9] = sums[norm > 1e-9] / norm[norm > 1e-9, None]
    return out


def scan(query: np.ndarray, block: np.ndarray, k: int, step: int = STEP, width: float = WIDTH) -> np.ndarray:
    """Rows of a block that may be among the k nearest to a query, both rotated and of unit length.

    A partial distance over d of D columns, times D/d, is within
    ``1 + width / sqrt(d)`` of the whole one for nearly all pairs; the k-th
    best distance comes from the k candidates that look best, measured fully.
    """
    size = len(query)
    alive, part = np.arange(len(block)), np.zeros(len(block))
    bound = np.inf
    for at in range(0, size, step):
        to = min(size, at + step)
        diff = block[alive, at:to] - query[at:to]
        part = part + (diff * diff).sum(axis=1)
        if to == size:
            break
        if len(alive) > k:
            best = np.argpartition(part, k - 1)[:k]
            full = block[alive[best]] - query
            bound = min(bound, (full * full).sum(axis=1).max())
            stay = part * (size / to) <= bound * (1 + width / np.sqrt(to)) ** 2 + 1e-12
            alive, part = alive[stay], part[stay]
    if len(alive) <= k:
        return alive
    edge = np.partition(part, k - 1)[k - 1]
    return alive[part <= edge + 1e-9]


def _packed(sizes: np.ndarray) -> list[np.ndarray]:
    """Each list's shards: small lists share one of about ``SHARD`` rows, a large one has several."""
    out, shard, room = [], -1, 0
    for n in sizes:
        if n > SHARD:
            many = -(-int(n) // SHARD)
            out.append(np.arange(shard + 1, shard + 1 + many))
            shard, room = shard + many, 0
            continue
        if n > room:
            shard, room = shard + 1, SHARD
        room -= n
        out.append(np.array([max(shard, 0)]))
    return out


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding", lists: int | None = None, probed: float = PROBED, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest by cosine, ties to the smaller id; a query is no candidate of its own.

    ``probed`` is the share of lists that a query looks into. Rows of equal id
    and vector count once, as candidates and as queries; rows of equal id with
    other vectors are candidates and queries of their own, but none of a query
    of their id. Vectors of another length than the most common one are not
    comparable with it and take no part, nor do those that are null, zero or
    have null or non-finite components or a null id. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    base = usable(vectors, vec_id, embedding)
    sizes = base.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").collect()  # a row for each length
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size, total = sizes[0]["d"], sizes[0]["count"]
    base = base.where(F.size("v") == size)
    asked = usable(queries, vec_id, embedding).where(F.size("v") == size).dropDuplicates(["vec_id", "v"])
    sample = max(64, min(sample, SAMPLE_BYTES // (8 * size)))
    chance = F.pmod(F.xxhash64(F.lit(9), "vec_id"), F.lit(1 << 20)) / float(1 << 20)
    fitted = base.where(chance < min(1.0, sample / total)).select("v").limit(2 * sample).toArrow()  # about `sample` rows
    if not len(fitted):
        fitted = base.limit(64).select("v").toArrow()
    known = np.unique(_unit(_matrix(fitted["v"].combine_chunks())), axis=0)  # in an order of its own
    turn = rotation(size)
    centers = centroids(known, lists or int(max(1, min(LISTS, 4 * np.sqrt(total), len(known) // 4))))

    def file(batches):
        for batch in batches:
            if batch.num_rows:
                near = (_unit(_matrix(batch.column(1))) @ centers.T).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near.astype(np.int32))], ["vec_id", "v", "list"])

    filed = common.kept(common.arrow(base, file, "vec_id long, v array<double>, list int"), "ann-lists")
    held = np.zeros(len(centers), dtype=np.int64)
    for r in filed.groupBy("list").count().collect():  # a row for each list
        held[r["list"]] = r["count"]
    shards = _packed(held)
    spread = F.create_map(*[x for a, b in enumerate(shards) for x in (F.lit(a), F.array(*[F.lit(int(i)) for i in b]))])
    mine = spread[F.col("list")]
    candidates = filed.withColumn("shard", F.get(mine, F.pmod(F.hash("vec_id"), F.size(mine)))).select("shard", "list", "vec_id", "v")
    least = np.zeros(len(centers), dtype=bool)
    least[: max(1, int(np.ceil(len(centers) * probed)))] = True

    def ask(everywhere: bool):
        """A row for each query and shard, with the query's lists in it."""

        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                order = np.argsort(-(_unit(_matrix(batch.column(1))) @ centers.T), axis=1, kind="stable")
                before = np.cumsum(held[order], axis=1) - held[order]
                use = (least | (before < LEAST) | everywhere) & (held[order] > 0)
                row, shard, of = [], [], []
                for i in range(len(order)):
                    own = [(s, int(x)) for x in order[i][use[i]] for s in shards[x]]
                    for s in sorted({s for s, _ in own}):
                        row.append(i)
                        shard.append(s)
                        of.append([x for t, x in own if t == s])
                taken = batch.take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays([taken.column(0), taken.column(1), pa.array(shard, pa.int32()), pa.array(of, pa.list_(pa.int32()))], ["query_id", "q", "shard", "lists"])

        return run

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found_by, ids, score = [], [], []
        if left.num_rows and right.num_rows:
            vectors_, own, of = _matrix(right["v"].combine_chunks()), right["vec_id"].to_numpy(), right["list"].to_numpy()
            once = np.unique(np.column_stack([own.astype(np.int64).view(np.float64), vectors_]).view(f"V{8 * (size + 1)}").ravel(), return_index=True)[1]
            vectors_, own, of = _scaled(vectors_[once]), own[once], of[once]
            turned, length = _unit(vectors_) @ turn, np.sqrt((vectors_ * vectors_).sum(axis=1))
            asked_, ids_of = _scaled(_matrix(left["q"].combine_chunks())), left["query_id"].to_numpy()
            for i, (q, qt, wanted) in enumerate(zip(asked_, _unit(asked_) @ turn, left["lists"].to_pylist(), strict=True)):
                open_ = np.zeros(len(centers), dtype=bool)
                open_[wanted] = True
                rows = np.flatnonzero(open_[of] & (own != ids_of[i]))
                if not len(rows):
                    continue
                rows = rows[scan(qt, turned[rows], k)]
                cosine = (vectors_[rows] * q).sum(axis=1) / (length[rows] * np.sqrt((q * q).sum()))
                top = np.lexsort((own[rows], -cosine))[:k]
                ids.append(own[rows][top])
                score.append(cosine[top])
                found_by.append(np.full(len(top), i))
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        which = join(found_by, np.int64)
        return pa.table({"query_id": left["query_id"].take(which), "ask": left["ask"].take(which), "vec_id": join(ids, np.int64), "score": join(score, np.float64)})

    def best(some: DataFrame, everywhere: bool) -> DataFrame:
        probing = common.arrow(some, ask(everywhere), "query_id long, q array<double>, shard int, lists array<int>").withColumn("ask", F.xxhash64("q"))
        found = probing.groupBy("shard").cogroup(candidates.groupBy("shard")).applyInArrow(common.of_group(search), "query_id long, ask long, vec_id long, score double")
        order = Window.partitionBy("query_id", "ask").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    found = common.kept(best(asked, False), "ann-found")
    if total > LEAST:  # else every list was looked into
        named = asked.withColumn("ask", F.xxhash64("v"))
        full = found.where(F.col("rank") == k).selectExpr("query_id AS vec_id", "ask")
        short = common.kept(named.join(full, ["vec_id", "ask"], "left_anti").select("vec_id", "v"), "ann-short")
        if short.limit(1).count():
            again = best(short, True)
            found = found.join(short.select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("ask")), ["query_id", "ask"], "left_anti").unionByName(again)
    return found.select("query_id", "rank", "vec_id", "score")


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"))
