"""Layer tables: tolerant reads, zstd Parquet sinks, staging and history."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

COMPRESSION = "zstd"
FEW_PIECES = 32
#: Whether a query's shuffle files go when it ends, and not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_MISSING = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}
_RUN: ContextVar[str] = ContextVar("run", default="")


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asks the file system of the path itself, so that any shared store works."""
    files, jvm_path = _path(spark, path)
    found = files.globStatus(jvm_path)
    return found is not None and len(found) > 0


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern with wildcards fits, in any store."""
    files, jvm_path = _path(spark, pattern)
    return sorted(status.getPath().toString() for status in files.globStatus(jvm_path) or ())


def read_layer(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet scan; with a schema, a missing path gives an empty table of that schema."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if schema is None or error.getCondition() not in _MISSING:
            raise
        return empty(spark, schema)


def write_layer(
    df: DataFrame, path: str, partition_by: Iterable[str] = (), sort_by: str | None = None
) -> None:
    """Replaces a layer. ``sort_by`` lays it out by ranges of a key, so that lookups and pages
    by that key read only the row groups whose statistics match."""
    if sort_by is not None:
        df = df.repartitionByRange(sort_by).sortWithinPartitions(sort_by)
    df.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(*partition_by).parquet(path)


def append_history(df: DataFrame, path: str) -> None:
    """Adds rows to a history table; earlier files are neither read nor rewritten."""
    df.write.mode("append").option("compression", COMPRESSION).parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """History written by runs whose columns differ: absent columns come back as null."""
    return spark.read.option("mergeSchema", True).parquet(path)


def work_folder(spark: SparkSession) -> str:
    """The shared folder for written intermediates: what the cluster names.

    Only a session without executors elsewhere may go without; it gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        folder = tempfile.mkdtemp(prefix="probity-")
        spark.sparkContext.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/probity/{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, name: str) -> str:
    """A new path for one written intermediate."""
    return "/".join(part for part in (work_folder(spark), _RUN.get(), f"{name}-{uuid4().hex}") if part)


def _path(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the path as it takes it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def delete(spark: SparkSession, path: str) -> None:
    files, jvm_path = _path(spark, path)
    files.delete(jvm_path, True)


def move_file(spark: SparkSession, pattern: str, path: str) -> None:
    """Gives the one file that matches a pattern another place in the same store."""
    files, wanted = _path(spark, pattern)
    (found,) = files.globStatus(wanted)
    if not files.rename(found.getPath(), _path(spark, path)[1]):
        raise OSError(f"{pattern} cannot be moved")


def drop_work(spark: SparkSession) -> None:
    """Deletes what this application staged; tables read back from it end with it."""
    delete(spark, work_folder(spark))


@contextmanager
def own_work(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Deletes at its end what was staged inside; results must have been written by then.

    What it gives stages a result outside, among the intermediates of whoever called.
    """
    outer = _RUN.get()
    run = _RUN.set("/".join(part for part in (outer, f"run-{uuid4().hex}") if part))

    def keep(df: DataFrame, name: str) -> DataFrame:
        here = _RUN.set(outer)
        try:
            return stage(df, name)
        finally:
            _RUN.reset(here)

    try:
        yield keep
    finally:
        delete(spark, f"{work_folder(spark)}/{_RUN.get()}")
        _RUN.reset(run)


def replace_layer(spark: SparkSession, version: str, path: str) -> None:
    """Puts a written version in the place of a layer; the old one goes when the new one is there."""
    old = f"{path.rstrip('/')}.old-{uuid4().hex}"
    files, here = _path(spark, path)
    new, aside = (_path(spark, p)[1] for p in (version, old))
    had = files.exists(here)
    if had and not files.rename(here, aside):
        raise OSError(f"{path} cannot be moved")
    if not files.rename(new, here):
        if had:
            files.rename(aside, here)
        raise OSError(f"{version} cannot be moved to {path}")
    files.delete(aside, True)


def spread(df: DataFrame) -> DataFrame:
    """Gives work that is heavy per row enough tasks when its input comes in few pieces.

    A small file is one task however long its texts take, and so is a row group, whatever the
    number of pieces its file is cut into. Tables of many pieces with rows are left as they are.
    """
    enough = min(df.sparkSession.sparkContext.defaultParallelism, FEW_PIECES)
    pieces = df.rdd.getNumPartitions()
    if pieces >= enough:  # counted without reading a column
        pieces = df.select(F.spark_partition_id().alias("_piece")).distinct().count()
    return df.repartition(enough) if pieces < enough else df


def stage(df: DataFrame, name: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Writes an intermediate once and reads it back.

    The written table cuts the lineage, outlives lost executors, and tells the planner
    its true size, so that later joins broadcast it only if it is small. The shuffles of the
    write serve nothing else, so their files are deleted with it.
    """
    path, conf = work_path(df.sparkSession, name), df.sparkSession.conf
    had = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", COMPRESSION).partitionBy(*partition_by).parquet(path)
    finally:
        conf.set(CLEANUP, had)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Reads the table at ``path``; builds and writes it first if it is not there in full.

    A write that did not end leaves no ``_SUCCESS`` file, and is done again.
    """
    if not path_exists(spark, f"{path}/_SUCCESS"):
        write_layer(build(), path)
    return spark.read.parquet(path)


def export_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").csv(path, header=True, sep=sep, escape='"')
