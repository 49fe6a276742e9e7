"""Token ids in fixed-width bits, in blocks that are read on their own.

A block is a byte string: a header, the index of its texts, and the ids, each in the least
number of bits that holds the vocabulary, packed without gaps. The index gives random access
to any text; numpy unpacks a whole block at once. Blocks are rows of a Parquet table, so a
lost task leaves no half-written file and any store that Spark writes to will do.

Block layout (little endian): magic ``TIDB``, u8 version, u8 bits per id, u16 zero, u32
texts, u64 ids; then per text i64 id and u64 end, counted in ids from the block's start;
then the packed ids, most significant bit first, filled up to whole bytes.
"""

from __future__ import annotations

import itertools
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from probity._shipping import ship_by_value
from probity.sources.layers import work_path

from .common import lookup, slices

ship_by_value(__name__)

MAGIC, VERSION, HEADER = b"TIDB", 1, "<4sBBHIQ"
#: A block is closed at this many ids, or after the text that crosses it.
BLOCK_IDS = 1 << 20
#: Pieces of text remembered by a worker, and characters looked at in one go.
REMEMBERED, SLICE_CHARS = 500_000, 3_000_000
#: An id that cannot be null in a block; a null text id is kept as this value (fixed).
NO_ID = -(1 << 63)


def width_of(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as ``width`` bits each."""
    if width in (8, 16, 32):
        return ids.astype(f">u{width // 8}").tobytes()
    bits = np.unpackbits(ids.astype(">u4").view(np.uint8)).reshape(-1, 32)[:, 32 - width :]
    return np.packbits(bits).tobytes()


def unpack(packed: bytes, width: int, first: int, count: int) -> np.ndarray:
    """``count`` ids from the ``first`` on, without touching the bytes before them."""
    if width in (8, 16, 32):
        size = width // 8
        return np.frombuffer(packed, f">u{size}", count, first * size).astype(np.uint32)
    begin = first * width
    raw = np.frombuffer(packed, np.uint8, -(-(begin % 8 + count * width) // 8), begin // 8)
    bits = np.unpackbits(raw)[begin % 8 :][: count * width].reshape(-1, width)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, 32 - width :] = bits
    return np.packbits(wide, axis=1).view(">u4").ravel().astype(np.uint32)


def write_block(text_ids: list[int], sizes: list[int], ids: np.ndarray, width: int) -> bytes:
    index = np.empty((len(text_ids), 2), "<i8")
    index[:, 0], index[:, 1] = text_ids, np.cumsum(sizes)
    return struct.pack(HEADER, MAGIC, VERSION, width, 0, len(text_ids), len(ids)) + index.tobytes() + pack(ids, width)


def read_block(block: bytes) -> tuple[np.ndarray, np.ndarray, int, memoryview]:
    """Text ids, ends, bits per id, and the packed ids of a block."""
    magic, version, width, _, texts, _ = struct.unpack_from(HEADER, block)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token block")
    index = np.frombuffer(block, "<i8", 2 * texts, struct.calcsize(HEADER)).reshape(-1, 2)
    return index[:, 0], index[:, 1], width, memoryview(block)[struct.calcsize(HEADER) + index.nbytes :]


class Numbers(dict):
    """Numbers texts in the order in which they come."""

    def __missing__(self, text: str) -> int:
        self[text] = number = len(self)
        return number


class Encoder:
    """A byte-level BPE of the tokenizers library that encodes each different piece once.

    Its pre-tokenizer always cuts before a single blank between two other characters, so a
    text is cut there first; the pieces of many texts are joined, encoded in one call, and
    told apart by the ids whose token begins with a blank. Texts with other white space next
    to a blank are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.opens = np.zeros(self.size, bool)
        self.opens[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    @staticmethod
    def of(path: str) -> Encoder:
        """The worker's encoder: it outlives a task where Spark uses a worker again."""
        import tokenizers

        kept = vars(tokenizers).setdefault("_encoders_by_path", {})
        if path not in kept:
            kept[path] = Encoder(path)
        return kept[path]

    def forget(self) -> None:
        self.known, self.heads = Numbers(), {}
        self.clean = np.zeros(0, bool)
        self.ids = np.zeros(0, np.uint32)
        self.begin = np.zeros(1, np.int64)

    def whole(self, text: str) -> np.ndarray:
        # without offsets, which the library would otherwise keep for every token
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def learn(self, pieces: list[str]) -> None:
        """Encodes new pieces, each with a blank before it, in one call."""
        clean = np.array([bool(p) and not p[0].isspace() and not p[-1].isspace() for p in pieces], bool)
        joined = "".join(" " + p if c else " ." for p, c in zip(pieces, clean))
        ids = self.whole(joined)
        first = np.nonzero(self.opens[ids])[0]
        if len(first) != len(pieces):  # a token with an inner blank; none is known
            parts = [self.whole(" " + p if c else " .") for p, c in zip(pieces, clean)]
            ids, first = np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts])[:-1]
        self.clean = np.concatenate((self.clean, clean))
        self.begin = np.concatenate((self.begin[:-1], first + len(self.ids), [len(self.ids) + len(ids)]))
        self.ids = np.concatenate((self.ids, ids))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        if len(self.known) > REMEMBERED:
            self.forget()
        known, old, coded = self.known, len(self.known), []
        for text in texts:
            pieces = text.split(" ")
            coded.append(np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces)))
        fresh = list(itertools.islice(known, old, None))
        if fresh:
            self.learn(fresh)
        out = []
        for text, codes in zip(texts, coded):
            rest = codes[1:]
            if any(s in text for s in self.special) or not self.clean[rest].all() or not self.clean[codes[:1]].all():
                out.append(self.whole(text))
                continue
            head = text[: text.find(" ")] if len(rest) else text
            if head not in self.heads:
                self.heads[head] = self.whole(head)
            size = self.begin[rest + 1] - self.begin[rest]
            end = np.cumsum(size)
            at = np.arange(end[-1] if len(end) else 0) + np.repeat(self.begin[rest] - (end - size), size)
            out.append(np.concatenate((self.heads[head], self.ids[at])))
        return out


BLOCKS = "part int, block int, texts long, ids long, data binary"


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    vocabulary: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    partitions: int | None = None,
) -> None:
    """Writes the ids of all texts, each closed by ``end_id``, as blocks in ascending id order.

    Texts are dealt by ranges of the id, so ``part`` and ``block`` number the blocks in order.
    """
    width = width_of(max(vocabulary, end_id + 1))
    spark = docs.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = Encoder.of(tokenizer)
        names, sizes, ids, held, number = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            data = write_block(names, sizes, np.concatenate(ids), width)
            columns = [[part], [number], [len(names)], [held], [data]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "block", "texts", "ids", "data"]
            )

        for batch in batches:
            keys = iter(batch.column(0).to_pylist())
            for group in slices(batch.column(1).to_pylist(), SLICE_CHARS):
                for one in encoder.encode(group):
                    key = next(keys)
                    names.append(NO_ID if key is None else key)
                    ids += [one, np.array([end_id], np.uint32)]
                    sizes.append(len(one) + 1)
                    held += len(one) + 1
                    if held >= BLOCK_IDS:
                        yield close()
                        names, sizes, ids, held, number = [], [], [], 0, number + 1
        if names:
            yield close()

    (
        docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .repartitionByRange(parts, F.col("id").asc_nulls_first(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"))
        .mapInArrow(encode, BLOCKS)
        .write.option("compression", "uncompressed")
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a written table with ``start``, how many ids stand before each.

    Sums are taken per part first; the running sum over the parts is over one row per task.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)
    sizes = blocks.select("part", "block", "ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("ids").alias("n"))
    parts = parts.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sizes.withColumn("inner", F.coalesce(F.sum("ids").over(inside), F.lit(0)))
        .join(parts, F.col("part") == F.col("_part"))
        .select(F.col("part").alias("_part"), F.col("block").alias("_block"), (F.col("base") + F.col("inner")).alias("start"))
    )
    starts = lookup(starts, sizes.count(), 48)
    return blocks.join(starts, (F.col("part") == F.col("_part")) & (F.col("block") == F.col("_block"))).drop(
        "_part", "_block"
    )


def summary(blocks: DataFrame) -> DataFrame:
    """Per text, as read from the blocks: id, ``start``, ``n_tokens``, ``ids_crc32``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                names, ends, width, packed = read_block(data.as_py())
                begins = np.concatenate(([0], ends[:-1]))
                ids = unpack(packed, width, 0, int(ends[-1])).astype("<u4")
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([None if n == NO_ID else n for n in names.tolist()], pa.int64()),
                        pa.array(begins + start),
                        pa.array(ends - begins),
                        pa.array(sums, pa.int64()),
                    ],
                    ["id", "start", "n_tokens", "ids_crc32"],
                )

    return blocks.select("start", "data").mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long")


def text_ids(blocks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per text its id and the list of its token ids, read back from the blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["data"]:
                names, ends, width, packed = read_block(data)
                begins = np.concatenate(([0], ends[:-1]))
                lists = [unpack(packed, width, int(a), int(b - a)).astype(np.int32) for a, b in zip(begins, ends)]
                yield pd.DataFrame({id_col: pd.array([None if n == NO_ID else n for n in names], "Int64"), "ids": lists})

    return blocks.select("data").mapInPandas(run, f"{id_col} long, ids array<int>")


def encoded(
    docs: DataFrame,
    tokenizer: str,
    vocabulary: int,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
) -> DataFrame:
    """Writes the token blocks of all texts and returns their digest, read back from them.

    Null is the empty text, which has only its end id. Rows that repeat an id are all
    written, ordered by the text's hash; null ids come first. An empty table writes no block and gives
    an empty result; other columns are ignored.
    """
    path = path or work_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id, vocabulary, id_col, text_col)
    return summary(read_tokens(docs.sparkSession, path)).withColumnRenamed("id", id_col)
