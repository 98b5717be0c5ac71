"""What the operators share: reading, cutting lineage, shipping the package to the workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
BLANK = r"[\x20\x09-\x0D]"  # fixed value: the white space of the contracts
WORD = r"[^\x20\x09-\x0D]+"  # fixed value: the words of the contracts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. It is made up only where the session runs in one process."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    set_dir = spark.sparkContext.getCheckpointDir()
    if set_dir:
        return set_dir.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="curbline-shared-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def cut(df: DataFrame) -> DataFrame:
    """The rows of df, stored in the shared folder so that a lost executor does not undo them."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def remainder(column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def held_out(column: str, parts: int, rest: int) -> Column:
    """Whether a row is kept from learning; rows without an id are."""
    return F.coalesce(remainder(column, parts) == rest, F.lit(True))


def portions(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about `most` characters of a text column, or of one longer text."""
    lengths = pc.utf8_length(batch.column(column)).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for at, length in enumerate(lengths.tolist()):
        if at > start and size + length > most:
            yield batch.slice(start, at - start)
            start, size = at, 0
        size += length
    if start < len(lengths):
        yield batch.slice(start)


_shipped: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session, once per application.

    The archive stands on the driver only; Spark hands it out to the executors by its own means.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if not os.path.isdir(package):  # already imported from a shipped archive
        return
    folder = tempfile.mkdtemp(prefix="curbline-ship-")
    target = os.path.join(folder, f"{os.path.basename(package)}_shipped.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for top, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(top, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(target)
    _shipped[sc.applicationId] = target
