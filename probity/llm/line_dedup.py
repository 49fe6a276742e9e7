"""Lines that many documents share, by levelled sorted runs of line hashes.

A batch of documents gives a run: its line hashes, sorted and bucketed, with the number of
documents that hold each. A new batch is anti-joined by merging with what the runs have settled
already, and only the rest becomes its own run. Whenever ``fanout`` runs of one level are there
they are merged into one of the next, so a batch meets few runs however many came before.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from probity.sources.layers import delete, matches, stage, work_path

from .common import lookup, lower_ascii, whole

#: What is stripped from both ends of a line: blank, tab, line feed, line tabulation, form feed, return.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
#: Runs of a level that are merged into one of the next, and batches that a table is dealt into.
FANOUT, BATCHES = 4, 8
RUN = "key BINARY, n BIGINT"


def text_key(text: Column) -> list[Column]:
    """128 bits that name a text."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(11), text).alias("t2")]


def line_keys(text: Column, least: int = 1) -> Column:
    """Per line its 128-bit hash in hex, or the empty string if its key is shorter than ``least``."""

    def named(line: Column) -> Column:
        return F.when(F.length(line) >= least, F.md5(line)).otherwise("")

    lines = F.split(lower_ascii(text), "\n")
    return F.transform(lines, lambda line: named(F.trim(line, F.lit(BLANKS))))


@dataclass(frozen=True)
class Run:
    """The counts of batches ``first`` to ``last``, in so many buckets."""

    first: int
    last: int
    buckets: int

    @property
    def name(self) -> str:
        return f"run-{self.first:06d}-{self.last:06d}-{self.buckets}"


class LineRuns:
    """Runs below a folder; any later session can open it and add further batches.

    A run is there when its ``_SUCCESS`` file is, and one whose batches lie within those of
    another is superseded. So a job that breaks off between writing a merged run and deleting
    its parts counts nothing twice, and a batch that comes again is passed over.
    """

    def __init__(self, spark: SparkSession, path: str, min_docs: int, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.path, self.min_docs, self.fanout = spark, path.rstrip("/"), min_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._tables: dict[Run, str] = {}

    def runs(self) -> list[Run]:
        names = [re.search(r"run-(\d+)-(\d+)-(\d+)/_SUCCESS$", p) for p in matches(self.spark, f"{self.path}/run-*/_SUCCESS")]
        there = [Run(*map(int, n.groups())) for n in names if n]
        within = lambda a, b: a != b and b.first <= a.first and a.last <= b.last
        return sorted((r for r in there if not any(within(r, o) for o in there)), key=lambda r: r.first)

    def table(self, run: Run) -> DataFrame:
        """A run as a bucketed table, so that joins by key read it without a shuffle."""
        if run not in self._tables:
            self._tables[run] = name = f"line_run_{uuid4().hex}"
            self.spark.sql(
                f"CREATE TABLE {name} ({RUN}) USING parquet CLUSTERED BY (key) SORTED BY (key)"
                f" INTO {run.buckets} BUCKETS LOCATION '{self.path}/{run.name}'"
            )
        return self.spark.read.table(self._tables[run])

    def _write(self, counts: DataFrame, first: int, last: int) -> None:
        run = Run(first, last, self.buckets)
        delete(self.spark, f"{self.path}/{run.name}")  # what a broken job may have left
        self._tables[run] = name = f"line_run_{uuid4().hex}"
        writer = counts.select("key", F.col("n").cast("long").alias("n")).write.format("parquet")
        writer = writer.bucketBy(run.buckets, "key").sortBy("key").option("compression", "zstd")
        writer.option("path", f"{self.path}/{run.name}").saveAsTable(name)

    def _total(self, runs: list[Run]) -> DataFrame:
        # read as plain files: in this version of Spark a union of bucketed tables loses equal keys
        rows = self.spark.read.schema(RUN).parquet(*[f"{self.path}/{r.name}" for r in runs])
        return rows.groupBy("key").agg(F.sum("n").alias("n"))

    def add(self, keys: DataFrame, batch: int) -> None:
        """Adds a batch: rows of ``keys``, the different line keys of one document each.

        Batches are numbered from 0 on. One that was added before is passed over.
        """
        there = self.runs()
        following = there[-1].last + 1 if there else 0
        if batch < following:
            return
        if batch > following:
            raise ValueError(f"batch {following} comes before batch {batch}")
        counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        for run in there:
            settled = self.table(run).where(F.col("n") >= self.min_docs)
            counts = counts.join(settled.select("key"), "key", "left_anti")
        self._write(counts, batch, batch)
        self.compact()

    def compact(self) -> None:
        """Merges the last ``fanout`` runs for as long as they are of one level."""
        while True:
            part = self.runs()[-self.fanout :]
            if len(part) < self.fanout or len({r.last - r.first for r in part}) > 1:
                return
            self._write(self._total(part), part[0].first, part[-1].last)
            for run in part:
                self._forget(run)

    def _forget(self, run: Run) -> None:
        if run in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop(run)}")
        delete(self.spark, f"{self.path}/{run.name}")

    def frequent(self) -> DataFrame:
        """The keys that at least ``min_docs`` documents of all batches hold, as written once."""
        runs = self.runs()
        if not runs:
            return self.spark.createDataFrame([], "key binary")
        return stage(self._total(runs).where(F.col("n") >= self.min_docs).select("key"), "frequent-lines")

    def close(self) -> None:
        """Forgets the names under which this session reads the runs; the runs stay."""
        for name in self._tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._tables = {}


def hashed(docs: DataFrame, text_col: str = "text", batches: int = BATCHES, least: int = 1) -> DataFrame:
    """(t1, t2, keys, batch) per row, written once by batch: from here on only hashes move."""
    text = whole(F.col(text_col))
    rows = docs.select(*text_key(text), line_keys(text, least).alias("keys"))
    rows = rows.withColumn("batch", F.pmod(F.col("t2"), F.lit(batches)).cast("int"))
    return stage(rows, "line-hashes", partition_by=["batch"])


def different(rows: DataFrame) -> DataFrame:
    """The different keys of every row of :func:`hashed`."""
    return rows.select(F.explode(F.array_distinct("keys")).alias("key")).where("key <> ''").select(F.unhex("key").alias("key"))


def places(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """(t1, t2, gone): per text the numbers of its lines whose key is frequent; texts without one are left out."""
    lines = rows.select("t1", "t2", F.posexplode("keys").alias("pos", "hex")).where("hex <> ''")
    met = lines.withColumn("key", F.unhex("hex")).join(lookup(frequent, frequent.count(), 48), "key", "left_semi")
    return stage(met.groupBy("t1", "t2").agg(F.collect_set("pos").alias("gone")), "dropped-lines")


def deduplicated_lines(
    docs: DataFrame,
    min_docs: int = 10,
    least: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    batches: int = BATCHES,
    path: str | None = None,
) -> DataFrame:
    """Per row its id, ``n_lines``, ``n_dropped``, and ``kept``, the text without its frequent lines.

    A line is frequent if its key (blanks stripped at both ends, A-Z lower-cased) is held by at
    least ``min_docs`` rows; keys of fewer than ``least`` characters never are. Null is the empty
    text, which is one empty line. Rows that repeat, also whole, count as documents of their own;
    ids may be null. Of an empty table nothing comes back. Other columns are ignored. A text of any
    length is one row; its lines are looked up as rows of their own.
    """
    spark = docs.sparkSession
    rows = hashed(docs, text_col, batches, least)
    runs = LineRuns(spark, path or work_path(spark, "line-runs"), min_docs)
    try:
        for batch in range(batches):
            runs.add(different(rows.where(F.col("batch") == batch)), batch)
        frequent = runs.frequent()
    finally:
        runs.close()
    gone = places(rows, frequent)
    texts, dropped = gone.agg(F.count("*"), F.coalesce(F.sum(F.size("gone")), F.lit(0))).first()
    text = whole(F.col(text_col))
    named = docs.select(F.col(id_col), text.alias("_whole"), *text_key(text))
    met = named.join(lookup(gone, 64 * texts + 4 * dropped, 1), ["t1", "t2"], "left").select(
        id_col, "_whole", F.split("_whole", "\n").alias("_lines"), "gone"
    )
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("gone"))
    rest = F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n")
    return met.select(
        id_col,
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("_whole")).otherwise(rest).alias("kept"),
    )
