"""What the operators of this subpackage share: tables, shared folders, held-out rows."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.session import folder, ship

#: Bytes of text that a Python step works on at once; a longer single text is taken whole.
PIECE = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it again, which cuts its lineage."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(doc_id: str, of: int) -> Column:
    """crc32(doc_id as text) mod ``of``; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % of, F.lit(0))


def pieces(batches: Iterator[pa.RecordBatch], column: int, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that the texts of each hold about ``limit`` bytes."""
    from . import words

    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = words.text_buffer(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def list_pieces(batches: Iterator[pa.RecordBatch], column: int, limit: int = PIECE // 8) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that the lists of each hold about ``limit`` elements."""
    for batch in batches:
        offsets, at = batch.column(column).offsets.to_numpy().astype(np.int64), 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


#: What modules keep in a worker between tasks, by module.
CACHES: dict[str, dict | list] = {}
_OWNER: list[str] = []


def claim(owner: str) -> None:
    """Drops what other modules keep in this worker: workers go from one operator to the next."""
    if _OWNER != [owner]:
        _OWNER[:] = [owner]
        for name, kept_ in CACHES.items():
            if name != owner:
                kept_.clear()
        trim()


def trim() -> None:
    """Gives memory that is free back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """mapInArrow, on workers that have this package and keep nothing of other operators."""
    ship(df.sparkSession)
    owner = run.__module__

    def tidy(batches):
        claim(owner)
        yield from run(batches)
        trim()

    return df.mapInArrow(tidy, schema)


def of_group(run):
    """A function of one or two tables, as ``arrow`` runs those of batches."""
    owner = run.__module__

    def tidy(*tables):
        claim(owner)
        out = run(*tables)
        if sum(t.nbytes for t in tables) > PIECE:
            trim()
        return out

    # Spark counts a function's arguments by their names
    return (lambda left, right: tidy(left, right)) if run.__code__.co_argcount == 2 else lambda table: tidy(table)


#: Chunks of an array; groups in which the parts of very many tasks are added up first, and the number of tasks up to which that isn't needed.
CHUNKS, PARTS, FEW = 64, 32, 1024


def packed(array: np.ndarray) -> list[bytes]:
    """An array in ``CHUNKS`` compressed chunks."""
    return [pa.compress(c.tobytes(), codec="zstd", asbytes=True) for c in array.reshape(CHUNKS, -1)]


def combined(parts: DataFrame, kind: np.dtype, size: int, add=np.add) -> np.ndarray:
    """One array of ``size`` numbers from many of (chunk, blob), each an array ``packed``: those of very many tasks first in groups; only the whole comes to the driver."""
    kind, bytes_ = np.dtype(kind), size // CHUNKS * np.dtype(kind).itemsize

    def merge(table: pa.Table) -> pa.Table:
        total = np.zeros(size // CHUNKS, dtype=kind)
        for blob in table["blob"]:
            add(total, np.frombuffer(pa.decompress(blob.as_buffer(), bytes_, codec="zstd"), dtype=kind), out=total)
        return pa.table({"chunk": table["chunk"][:1], "part": table["part"][:1], "blob": pa.array([pa.compress(total.tobytes(), codec="zstd", asbytes=True)], pa.binary())})

    ship(parts.sparkSession)
    some = parts.select("chunk", F.lit(0).alias("part"), "blob")
    if parts.rdd.getNumPartitions() > FEW:
        some = some.withColumn("part", F.pmod(F.xxhash64("blob"), F.lit(PARTS)).cast("int"))
        some = some.groupBy("chunk", "part").applyInArrow(of_group(merge), "chunk int, part int, blob binary").withColumn("part", F.lit(0))
    some = some.groupBy("chunk", "part").applyInArrow(of_group(merge), "chunk int, part int, blob binary")
    out = np.zeros((CHUNKS, size // CHUNKS), dtype=kind)
    for r in some.collect():  # a row for each chunk
        out[r["chunk"]] = np.frombuffer(pa.decompress(r["blob"], bytes_, codec="zstd"), dtype=kind)
    return out.reshape(-1)


def marked(rows: DataFrame, columns: list[str], count: int) -> tuple[np.ndarray, int]:
    """A bitmap of the hashes of rows, 32 to 64 bits a row within 2**20 and 2**28 bits, and its logarithm: rows beyond that make more bits stand for rows that aren't there, and lose none."""
    bits = min(28, max(20, (32 * count).bit_length()))

    def run(batches):
        out = np.zeros(1 << bits, dtype=bool)
        for batch in batches:
            out[cells([c.to_numpy(zero_copy_only=False) for c in batch.columns], bits)] = True
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(CHUNKS), pa.int32()), pa.array(packed(np.packbits(out)), pa.binary())], ["chunk", "blob"])

    return combined(arrow(rows.select(*columns), run, "chunk int, blob binary"), np.uint8, (1 << bits) // 8, np.bitwise_or), bits


def cells(columns: list[np.ndarray], bits: int) -> np.ndarray:
    """Each row's place in a bitmap of ``marked``."""
    from . import words

    out = np.zeros(len(columns[0]), dtype=np.uint64)
    for c in columns:
        out = words.mix(out * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.int64).view(np.uint64) + np.uint64(1))
    return (out >> np.uint64(64 - bits)).astype(np.int64)


def is_marked(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bitmap[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1 > 0
