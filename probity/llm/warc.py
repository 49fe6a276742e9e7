"""WARC archives and their fixity: Merkle trees over records and ordered offset ranges.

An archive is a folder ``file=<name>`` per file, with gzipped WARC records inside. The tree
of a file has a leaf per record, a node per range of offsets over its leaves in order, and
nodes over fixed numbers of these up to one root. Replicas are compared at the roots, and
only below nodes that differ.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from probity._shipping import ship_by_value
from probity.sources.layers import stage

ship_by_value(__name__)

#: Bytes in the lowest range, nodes under a node, and levels: one root up to 256 KiB * 16^5.
RANGE, FAN, LEVELS = 1 << 18, 16, 6
#: Records per file at most, which also bounds what a task holds of a file.
RECORDS = 4000
NEXT_RECORD = re.compile(rb"\r\n\r\nWARC/1\.\d\r\n")
LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d+)[ \t]*(?=\r\n)", re.I)
ID = re.compile(rb"\r\nwarc-record-id:[ \t]*<([^>\r\n]*)>", re.I)


def record(name: Column, uri: Column, body: Column) -> Column:
    """A resource record, without the two line ends that close it."""
    body = F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <"),
        name,
        F.lit(">\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "),
        F.regexp_replace(F.coalesce(uri, F.lit("about:blank")), r"[\r\n]+", " "),
        F.lit("\r\nWARC-Block-Digest: sha256:"),
        F.sha2(body, 256),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
    )


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", body_col: str = "html"
) -> None:
    """Writes a record per row. Files are pieces of the input's partitions, so nothing is shuffled."""
    at = F.monotonically_increasing_id()
    name = F.concat(F.lit("urn:page:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    rows = pages.select(at.alias("at"), record(name, F.col(uri_col), F.col(body_col)).alias("value"))
    # the upper bits of ``at`` are the partition, the lower ones count its rows
    part, inside = F.expr("shiftright(at, 33)"), F.expr(f"at % {1 << 33} div {RECORDS}")
    rows = rows.withColumn("file", F.format_string("%06d-%06d", part, inside))
    write_records(rows, path, "at")


def write_records(rows: DataFrame, path: str, order: str) -> None:
    """Writes (file, order, value) as archive files; each file's rows must be in one partition."""
    (
        rows.sortWithinPartitions("file", order)
        .select("file", "value")
        .write.partitionBy("file")
        .option("lineSep", "\r\n\r\n")
        .option("compression", "gzip")
        .text(path)
    )


#: How a gzip member begins (a fixed value), and bytes that are unpacked in one go.
GZIP, PIECE = b"\x1f\x8b\x08", 1 << 14


def inflate(content: bytes) -> bytes:
    """What a gzip file holds, as far as it can be read.

    It is unpacked piece by piece: what came before damaged bytes is kept, up to the last byte that
    still gave something, and reading goes on at the next beginning of a gzip member.
    """
    out, at = [], 0
    while 0 <= at < len(content):
        stream, damaged = zlib.decompressobj(31), False
        while at < len(content) and not stream.eof and not damaged:
            piece = content[at : at + PIECE]
            before = stream.copy()
            try:
                out.append(stream.decompress(piece))
                at += len(piece) - len(stream.unused_data)
            except zlib.error:
                damaged = True
                for k in range(len(piece)):
                    try:
                        out.append(before.decompress(piece[k : k + 1]))
                    except zlib.error:
                        break
                at = content.find(GZIP, at + max(k, 1))
    return b"".join(out)


def parse(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of every record; bytes that are no record are one up to the next one."""
    at = 0
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        size = LENGTH.search(data, at, head + 2) if head >= 0 and data.startswith(b"WARC/1.", at) else None
        end = head + 4 + int(size[1]) if size else -1
        if not size or data[end : end + 4] != b"\r\n\r\n":
            found = NEXT_RECORD.search(data, at)
            end = found.start() if found else len(data)
        yield at, data[at:end]
        at = end + 4


RECORD = "file string, seq int, offset long, length long, name string, value binary"


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(file, seq, offset, length, name, value) of all records; ``name`` is the record's id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["file"], batch["content"]):
                rows = []
                for seq, (offset, value) in enumerate(parse(inflate(content))):
                    head = value[: value.find(b"\r\n\r\n") + 2]
                    name = ID.search(head)
                    rows.append((file, seq, offset, len(value), name[1].decode("utf-8", "replace") if name else None, value))
                    if len(rows) == 500:
                        yield pd.DataFrame(rows, columns=["file", "seq", "offset", "length", "name", "value"])
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=["file", "seq", "offset", "length", "name", "value"])

    files = spark.read.schema("path string, modificationTime timestamp, length long, content binary, file string")
    return files.format("binaryFile").load(path).select("file", "content").mapInPandas(run, RECORD)


def leaves(records: DataFrame) -> DataFrame:
    """A hash per record, written once: (file, seq, offset, length, name, hash)."""
    hashed = records.select(
        "file", "seq", "offset", "length", "name", F.sha2(F.concat(F.lit(b"\x00"), F.col("value")), 256).alias("hash")
    )
    return stage(hashed, "leaves")


def parent(level: int) -> Column:
    """The node one level up; the last level has one node."""
    return F.expr(f"node div {FAN}") if level < LEVELS - 2 else F.lit(0).cast("long")


def levels(leaf: DataFrame) -> list[DataFrame]:
    """The inner levels (file, node, hash) from the lowest ranges up to one root per file.

    A node hashes its children in the order of their offsets. It has at most as many as
    records fit in a range, or FAN.
    """
    out: list[DataFrame] = []
    below = leaf.select("file", F.expr(f"offset div {RANGE}").alias("node"), F.col("offset").alias("at"), "hash")
    for level in range(LEVELS):
        children = F.array_sort(F.collect_list(F.struct("at", "hash")))
        joined = F.array_join(F.transform(children, lambda c: c["hash"]), "")
        nodes = below.groupBy("file", "node").agg(F.sha2(F.concat(F.lit(chr(level + 1)), joined), 256).alias("hash"))
        out.append(stage(nodes, "nodes"))
        below = out[-1].select("file", parent(level).alias("node"), F.col("node").alias("at"), "hash")
    return out


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Where two replicas differ: (file, name, kind, offset, length, other_offset).

    Takes the records of :func:`read_archive`. From the roots down only children of nodes
    that differ are compared; in the lowest ranges that differ records are matched by file,
    id, and turn among equal ids. ``kind`` is ``changed``, ``missing`` (not in the second)
    or ``extra``; records that only moved are not named. Equal replicas and empty ones give
    no row. Files that one replica lacks are reported record by record.
    """
    one, two = leaves(first), leaves(second)
    bad: DataFrame | None = None
    trees = list(zip(levels(one), levels(two)))
    for level in reversed(range(LEVELS)):
        mine, theirs = trees[level]
        if bad is not None:
            up = bad.withColumnRenamed("node", "up")
            mine, theirs = (t.withColumn("up", parent(level)).join(up, ["file", "up"], "left_semi") for t in (mine, theirs))
        both = mine.select("file", "node", "hash").join(
            theirs.select("file", "node", F.col("hash").alias("other")), ["file", "node"], "full"
        )
        bad = stage(both.where(~F.col("hash").eqNullSafe(F.col("other"))).select("file", "node"), "differing")

    def suspects(leaf: DataFrame) -> DataFrame:
        inside = leaf.withColumn("node", F.expr(f"offset div {RANGE}")).join(bad, ["file", "node"], "left_semi")
        turn = F.row_number().over(Window.partitionBy("file", "name").orderBy("offset"))
        return inside.withColumn("turn", turn)

    a, b = suspects(one).alias("a"), suspects(two).alias("b")
    same = (F.col("a.file") == F.col("b.file")) & F.col("a.name").eqNullSafe(F.col("b.name"))
    kind = (
        F.when(F.col("b.hash").isNull(), "missing")
        .when(F.col("a.hash").isNull(), "extra")
        .when(F.col("a.hash") != F.col("b.hash"), "changed")
    )
    return (
        a.join(b, same & (F.col("a.turn") == F.col("b.turn")), "full")
        .select(
            F.coalesce("a.file", "b.file").alias("file"),
            F.coalesce("a.name", "b.name").alias("name"),
            kind.alias("kind"),
            F.col("a.offset").alias("offset"),
            F.coalesce("a.length", "b.length").alias("length"),
            F.col("b.offset").alias("other_offset"),
        )
        .where("kind IS NOT NULL")
    )
