"""What a session needs so that its workers can run this package."""

from __future__ import annotations

import atexit
import contextlib
import gc
import hashlib
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: Bytes of a batch that goes to a Python step, so that long texts take no more memory than short ones.
BATCH = 4 << 20


def ship(spark: SparkSession) -> None:
    """Gives the workers this package, once for each session: they may run elsewhere, without its folder. Bounds their batches by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
    context = spark.sparkContext
    if getattr(context, "_kindred_shipped", False):
        return
    top = Path(__file__).resolve().parent
    with tempfile.TemporaryDirectory() as folder:
        # named by the code, so that a session never meets another version under the same name
        files = {p.relative_to(top.parent): p.read_bytes() for p in sorted(top.rglob("*.py"))}
        name = hashlib.sha1(b"".join(files.values())).hexdigest()[:12]
        path = Path(folder, f"kindred-{name}.zip")
        with zipfile.ZipFile(path, "w") as out:
            for inner, data in files.items():
                out.writestr(str(inner), data)
        kept_path = Path(tempfile.gettempdir(), path.name)
        if not kept_path.exists():
            shutil.copy(path, kept_path)
    context.addPyFile(str(kept_path))
    context._kindred_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. A session in one process that has none gets a temporary one."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not found and context.master.startswith("local") and not context.master.startswith("local-cluster"):
        if not hasattr(context, "_kindred_shared"):
            context._kindred_shared = tempfile.mkdtemp(prefix="kindred-shared-")
        found = context._kindred_shared
    if not found:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return found.rstrip("/")


def folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, for tables that results read; ``clean`` deletes it, and so does the end of the program."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    context = spark.sparkContext
    if not hasattr(context, "_kindred_folders"):
        context._kindred_folders = []
        atexit.register(_at_exit, spark)
    context._kindred_folders.append(path)
    return path


def kept(df: DataFrame, name: str = "kindred") -> DataFrame:
    """Writes a table to the shared folder and reads it again, so that it is worked out once and plans stay small."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    released(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(spark: SparkSession) -> None:
    """Lets go of what finished steps leave: Spark deletes their shuffle files only when the driver collects its garbage, which otherwise also fills its memory."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def clean(spark: SparkSession) -> int:
    """Deletes the folders that were made so far, and tells how many. Results that were not written elsewhere can't be read any more."""
    context = spark.sparkContext
    paths = getattr(context, "_kindred_folders", [])
    made = list(paths)
    paths.clear()
    for path in made:
        at = context._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
    return len(made)


def _at_exit(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # the session may have ended
        clean(spark)
