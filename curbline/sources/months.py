"""Reading and replacing whole months."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..errors import DataQualityError
from ..operators.contract import (
    ANALYTICS_COLUMNS,
    CANONICAL,
    NEEDED,
    REQUIRED,
    SchemaReport,
    accept_curated,
    accept_trips,
)
from .layout import Layout

MONTH = "source_month"


def is_absent(error: AnalysisException) -> bool:
    """Whether a read failed only because nothing is there yet."""
    return any(word in str(error) for word in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"))


FOOTER_THREADS = 16


def month_files(spark: SparkSession, path: str) -> list[str]:
    """The files under a path, by one listing."""
    try:
        return sorted(spark.read.parquet(path).inputFiles())
    except AnalysisException as error:
        if is_absent(error):
            raise DataQualityError(f"nothing stored under {path}") from error
        raise


def footer_schemas(spark: SparkSession, files: Sequence[str]) -> dict[str, T.StructType]:
    """The schema of every file as its own footer states it.

    Spark merges footers but does not say which file differs, so each is asked for by itself,
    several at a time: one small read per file of the months at hand, and no rows.
    """
    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        return dict(zip(files, pool.map(lambda f: spark.read.parquet(f).schema, files)))


def check_month(
    spark: SparkSession, layout: Layout, month: date
) -> tuple[dict[str, T.StructType], SchemaReport]:
    """The schema of every file of a raw month, and how the month differs from the baseline. Files
    that break the contract are named with all that is wrong with them."""
    schemas = footer_schemas(spark, month_files(spark, layout.month("raw", month)))
    return schemas, accept_trips({path.rsplit("/", 1)[-1]: schema for path, schema in schemas.items()})


def _stored(spark: SparkSession, base: str, paths: list[str], schema: T.StructType) -> DataFrame:
    """Several month directories as one scan of just the columns in ``schema``."""
    rows = spark.read.option("basePath", base).schema(schema).parquet(*paths)
    return rows.withColumn(MONTH, F.make_date(F.col("year"), F.col("month"), F.lit(1)))


def read_trips(
    spark: SparkSession, layout: Layout, schemas: dict[date, dict[str, T.StructType]]
) -> DataFrame:
    """The six needed columns of the given months, with their source month.

    Files that agree on the needed types share one scan, so years of files are a few scans.
    """
    alike: dict[str, tuple[T.StructType, list[str]]] = {}
    for files in schemas.values():
        for path, schema in files.items():
            needed = T.StructType([T.StructField(c, schema[c].dataType, True) for c in NEEDED])
            _, paths = alike.setdefault(needed.simpleString(), (needed, []))
            paths.append(path)
    canonical = [F.col(c).cast(CANONICAL[kind]).alias(c) for c, kind in REQUIRED.items()]
    scans = [
        _stored(spark, layout.base("raw"), paths, needed).select(MONTH, *canonical)
        for needed, paths in alike.values()
    ]
    return reduce(DataFrame.unionByName, scans)


def replace_months(
    rows: DataFrame, base: str, untouched: Iterable[str] = (), order: Sequence[str] = ()
) -> None:
    """Replace the months present in ``rows`` and empty the month paths in ``untouched``.

    A dynamic overwrite leaves a month alone when the frame has no row for it, so months known
    to have none are overwritten on their own path. With ``order`` every file is sorted.
    """
    path = ["year", "month"]
    parts = {"year": F.date_format(MONTH, "yyyy"), "month": F.date_format(MONTH, "MM")}
    placed = rows.withColumns(parts).drop(MONTH)
    if order:
        placed = placed.repartitionByRange(*path, *order).sortWithinPartitions(*path, *order)
    (
        placed.write.partitionBy(*path)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .parquet(base)
    )
    columns = T.StructType([f for f in placed.schema if f.name not in path])
    for target in untouched:
        empty = rows.sparkSession.createDataFrame([], columns)
        empty.write.mode("overwrite").option("compression", "zstd").parquet(target)


def partitions(curated: DataFrame) -> DataFrame:
    """The months that are there, oldest first."""
    return curated.select("year", "month").distinct().orderBy("year", "month")


def _month_of(path: str) -> date | None:
    found = re.search(r"/year=(\d+)/month=(\d+)/", path)
    return date(int(found[1]), int(found[2]), 1) if found else None


def stored_months(spark: SparkSession, layout: Layout, area: str = "curated") -> list[date]:
    """The months that have a directory with files, also one without rows; oldest first."""
    try:
        files = spark.read.parquet(layout.base(area)).inputFiles()
    except AnalysisException as error:
        if is_absent(error):
            return []
        raise
    return sorted({m for m in map(_month_of, files) if m})


def read_curated(spark: SparkSession, layout: Layout) -> DataFrame:
    """All published months, after checking that every file has the current columns."""
    base = layout.base("curated")
    try:
        files = month_files(spark, base)
    except DataQualityError:
        raise DataQualityError(f"no published month under {base}") from None
    schemas = footer_schemas(spark, files)
    if not schemas:
        raise DataQualityError(f"no published month under {base}")
    common: dict[str, T.StructType] = {}  # the columns that all files of a month have
    for path, schema in schemas.items():
        month = f"{_month_of(path):%Y-%m}"
        common[month] = T.StructType([f for f in common.get(month, schema) if f.name in schema.names])
    accept_curated(common)
    needed = T.StructType([schema[c] for c in ANALYTICS_COLUMNS])
    return _stored(spark, base, [base], needed).select(MONTH, *ANALYTICS_COLUMNS)


def file_inventory(spark: SparkSession, layout: Layout, content_hash: bool = False) -> DataFrame:
    """Fingerprint per raw month from its files: (source_month, url, etag, last_modified, bytes,
    sha256).

    The fingerprint combines name, size and time of every file in any order. With ``content_hash``
    a month also has the digest of its files' contents. Spark hands a file's content to a task as
    one value, so that is for files below 2 GB; larger ones fail with Spark's own error. Without it
    ``sha256`` is null.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(layout.base("raw"))
    )
    part = r"/year=(\d{4})/month=(\d{2})/"
    year, month = (F.regexp_extract("path", part, i).cast("int") for i in (1, 2))
    name = F.element_at(F.split("path", "/"), -1)
    content = F.sha2("content", 256) if content_hash else F.lit(None).cast("string")
    utc = F.convert_timezone(None, F.lit("UTC"), F.col("modificationTime").cast("timestamp_ntz"))
    # A month's files are few; their names and digests are put in order before they are joined.
    marks = F.array_sort(F.collect_list(F.concat_ws(":", name, "digest")))
    return (
        files.withColumn(MONTH, F.make_date(year, month, F.lit(1)))
        .withColumn("mark", F.xxhash64(name, "length", "modificationTime"))
        .withColumn("digest", content)
        .groupBy(MONTH)
        .agg(
            F.min(F.regexp_replace("path", r"/[^/]*$", "")).alias("url"),
            F.concat_ws(
                "-", F.lower(F.hex(F.bit_xor("mark"))), F.count(F.lit(1)).cast("string")
            ).alias("etag"),
            F.max(utc).alias("last_modified"),
            F.sum("length").alias("bytes"),
            F.when(F.lit(content_hash), F.sha2(F.concat_ws(",", marks), 256)).alias("sha256"),
        )
    )
