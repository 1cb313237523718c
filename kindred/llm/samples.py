"""Bounded samples of labelled rows, and logistic regression on a few numbers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common


#: Bytes of text that a sample has at most, about.
MOST_BYTES = 48 << 20


def labelled(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, per_class: dict[int, int], doc_id: str = "doc_id", text: str = "text", seed: int = 5, most_bytes: int = MOST_BYTES) -> tuple[list[str], np.ndarray]:
    """Texts and labels of about ``per_class`` rows of each class, and of about ``most_bytes`` in all, in the order of their ids.

    A hash of the id decides, with a share worked out from the class's count,
    and a smaller one where the texts would be too many bytes; null labels, ids
    and texts teach nothing. An id that has several labels has the largest, one
    that has several texts the first of them in order. The sampled ids, no more
    than the bound says, are broadcast; their texts come to the driver.
    """
    rows = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(F.col("label").isin(list(per_class)) & F.col("doc_id").isNotNull() & allowed)
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # a row for each class
    if not counts:
        return [], np.zeros(0, np.int64)
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, per_class[k] / n)))])
    chance = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    ids = rows.withColumn("place", chance / share[F.col("label")]).where("place < 1").collect()  # about per_class rows of each class
    if not ids:
        return [], np.zeros(0, np.int64)
    chosen = docs.sparkSession.createDataFrame(ids, "doc_id long, label int, place double")
    found = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    found = common.kept(found.groupBy("doc_id", "label", "place").agg(F.min("text").alias("text")), "labelled-sample")
    size = found.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > most_bytes:
        found = found.where(F.col("place") < most_bytes / size)
    found = found.select("doc_id", "label", "text").orderBy("doc_id").toArrow()
    return found["text"].to_pylist(), found["label"].to_numpy().astype(np.int64)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Weights with the constant last, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        pull = ridge * w
        pull[-1] = 0
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(np.r_[np.full(len(w) - 1, ridge), 1e-9])
        step = np.linalg.solve(hessian + 1e-9 * np.eye(len(w)), x.T @ (p - y) + pull)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w
