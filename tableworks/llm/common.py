"""What several operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space that separates words (space, tab, LF, VT, FF, CR).
# ``bytes.split()`` without arguments splits on exactly these.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD_PATTERN = rf"[^{SPACE_CLASS}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows of an Arrow batch that a worker turns into Python objects at a time.
SLICE_ROWS = 512

_PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed.

    A cluster gets it with ``--py-files`` or an installed wheel; for a session
    started from another folder the workers' search path is extended.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, _PACKAGE_ROOT])


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Where the session names none and runs in one process (tests), a temporary
    folder is set; on a cluster that is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-checkpoint-"))
    return sc.getCheckpointDir()


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once to the shared folder as Parquet and read back.

    Cuts the lineage: a lost executor reads the files again instead of
    computing everything upstream, several readers share one computation, and
    the planner knows the true size.
    """
    path = f"{shared_folder(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``written`` made and nothing reads any more.

    For rounds of a loop: the next round's table is complete, so a lost executor
    has no need of the one before it.
    """
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if not folder.removeprefix("file://").startswith(shared_folder(spark).removeprefix("file://").rstrip("/") + "/"):
                raise ValueError(f"{folder} is not in the shared folder")
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most ``rows`` rows, without copying; empty batches go.

    What a worker holds as Python objects and hands back at once so doesn't grow with Spark's batches.
    """
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(c, _UPPER, _LOWER)


def byte_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of a text as bytes; none for a null text."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()
