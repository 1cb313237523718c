"""Seconds and shares of the stages of a run, and memory."""

from __future__ import annotations

import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def memory_mb() -> float:
    """Memory of the driver's Python process, 0 where the system doesn't tell."""
    status = Path("/proc/self/status")
    lines = status.read_text().splitlines() if status.exists() else []
    return next((int(line.split()[1]) / 1024 for line in lines if line.startswith("VmRSS:")), 0.0)


def stages(spark: SparkSession, steps: list[tuple[str, Callable[[dict], DataFrame]]], rows: int, project: int) -> DataFrame:
    """(stage, seconds, share, per_1000, projected_hours, memory_mb), a row for each step and one for all.

    A step gets the tables of those before it by their names; its own is
    worked out whole and kept for those after it, so that its time is its own.
    """
    tables: dict[str, DataFrame] = {}
    found = []
    for name, step in steps:
        began = time.perf_counter()
        tables[name] = step(tables).persist()
        tables[name].write.format("noop").mode("overwrite").save()
        found.append((name, time.perf_counter() - began, memory_mb()))
    for table in tables.values():
        table.unpersist()
    total = sum(s for _, s, _ in found)
    found.append(("all", total, memory_mb()))
    out = [(n, s, s / total if total else 0.0, 1000 * s / max(1, rows), project * s / max(1, rows) / 3600, m) for n, s, m in found]
    return spark.createDataFrame(out, "stage string, seconds double, share double, per_1000 double, projected_hours double, memory_mb double")
