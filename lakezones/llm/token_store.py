"""Token ids in directly addressable codes (DAC).

An id is cut into chunks of 8 bits, lowest first.  Level 1 holds the first
chunk of every id, level 2 the second chunk of the ids that have one, and so on.
Each level has a bitmap that tells which of its ids go on, and a directory of the ones before
every 512th bit.  The place of an id's next chunk is the rank of its
bit, so any id or run of ids is read without decoding anything before it.

Files are Parquet tables whose rows are shards: a run of documents in ascending order with
their ids in one DAC payload.  Spark's writer commits them, so a lost executor
leaves no half file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_dir
from .common import slices
from .tokens import CACHE_PARTS, encoder

END_ID = 2
SHARD_TOKENS = 1 << 20
SLICE_BYTES = 4 << 20
BLOCK = 512  # bits of the bitmap for each entry of the rank directory
MAGIC = b"DAC1"


def dac_encode(ids: np.ndarray) -> bytes:
    """Payload of a run of unsigned 32-bit ids."""
    levels, rest = [], ids.astype(np.uint32)
    while len(rest):
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-len(rest) // BLOCK) * BLOCK // 8, np.uint8)
        padded[:len(bits)] = bits
        ones = np.bitwise_count(padded.reshape(-1, BLOCK // 8)).sum(axis=1, dtype=np.uint32)
        ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4")
        levels.append((len(rest), (rest & 255).astype(np.uint8).tobytes(), padded.tobytes(), ranks.tobytes()))
        rest = rest[more] >> 8
    head = MAGIC + struct.pack("<I", len(levels)) + b"".join(struct.pack("<Q", n) for n, *_ in levels)
    return head + b"".join(c + b + r for _, c, b, r in levels)


class Dac:
    """Random access to a payload."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a DAC payload")
        (count,) = struct.unpack_from("<I", payload, 4)
        at, self.levels = 8 + 8 * count, []
        for n in struct.unpack_from(f"<{count}Q", payload, 8):
            blocks = -(-n // BLOCK)
            chunks = np.frombuffer(payload, np.uint8, n, at)
            bits = np.frombuffer(payload, np.uint8, blocks * BLOCK // 8, at + n)
            ranks = np.frombuffer(payload, "<u4", blocks, at + n + len(bits))
            self.levels.append((chunks, bits, ranks))
            at += n + len(bits) + 4 * blocks

    def __len__(self) -> int:
        return len(self.levels[0][0]) if self.levels else 0

    def rank(self, level: int, i: int) -> int:
        """Ones before bit ``i``: the directory's entry and at most one block."""
        _, bits, ranks = self.levels[level]
        block, inside = divmod(i, BLOCK)
        if block == len(ranks):
            block, inside = block - 1, BLOCK
        first = block * BLOCK // 8
        ones = int(np.bitwise_count(bits[first:first + inside // 8]).sum())
        if inside % 8:
            ones += (int(bits[first + inside // 8]) & ((1 << inside % 8) - 1)).bit_count()
        return int(ranks[block]) + ones

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = shift = level = 0
        while True:
            chunks, bits, _ = self.levels[level]
            value |= int(chunks[i]) << shift
            if not int(bits[i // 8]) >> i % 8 & 1:
                return value
            i, level, shift = self.rank(level, i), level + 1, shift + 8

    def slice(self, a: int, b: int) -> np.ndarray:
        """Ids at places a to b - 1; a run stays a run in every level."""
        out, where = np.zeros(max(b - a, 0), np.uint32), slice(None)
        for level, (chunks, bits, _) in enumerate(self.levels):
            if a >= b:
                break
            part = chunks[a:b].astype(np.uint32) << np.uint32(8 * level)
            out[where] |= part
            on = np.unpackbits(bits[a // 8:-(-b // 8)], bitorder="little")[a % 8:a % 8 + b - a].astype(bool)
            where = np.flatnonzero(on) if level == 0 else where[on]
            a = self.rank(level, a)
            b = a + int(on.sum())
        return out


SHARDS = "part int, shard int, first long, n_tokens long, doc_ids array<bigint>, doc_ends array<bigint>, payload binary"
_SHARDS = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64()),
                     ("doc_ids", pa.list_(pa.int64())), ("doc_ends", pa.list_(pa.int64())), ("payload", pa.binary())])


def write_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, keeps_space: bool = False,
                shard_tokens: int = SHARD_TOKENS, cache_parts: int = CACHE_PARTS) -> None:
    """Encode whole texts (null: empty), each followed by ``end_id``, in ascending doc_id order.

    Null doc_ids come first; rows of one doc_id follow each other by a hash of their text, then the text, and stay
    documents of their own.  A document never leaves its shard; a shard ends at the first document that reaches
    ``shard_tokens``.  An empty table gives an empty store.  Other columns are ignored.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer_path, keeps_space, cache_parts), TaskContext.get().partitionId()
        shard, first = 0, 0
        ids: list[bytes] = []
        docs_in: list = []
        ends: list[int] = []

        def flush() -> pa.RecordBatch:
            row = {"part": part, "shard": shard, "first": first, "n_tokens": ends[-1], "doc_ids": docs_in,
                   "doc_ends": ends, "payload": dac_encode(np.frombuffer(b"".join(ids), "<u4"))}
            return pa.RecordBatch.from_pylist([row], schema=_SHARDS)

        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                for doc, body in zip(some["doc_id"].to_pylist(), enc.encode(some["text"].to_pylist())):
                    ids.append(body + end)
                    docs_in.append(doc)
                    ends.append((ends[-1] if ends else 0) + len(ids[-1]) // 4)
                    if ends[-1] >= shard_tokens:
                        yield flush()
                        shard, first, ids, docs_in, ends = shard + 1, first + ends[-1], [], [], []
        if ends:
            yield flush()

    text = F.coalesce("text", F.lit("")).alias("text")
    order = ["doc_id", "_h"]
    rows = docs.select(F.col("doc_id").cast("long"), text).withColumn("_h", F.xxhash64("text"))
    (rows.repartitionByRange(*order).sortWithinPartitions(*order, "text").drop("_h").mapInArrow(run, SHARDS)
     .write.option("compression", "zstd").parquet(path))


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``base``, the ids before the shard in the whole store.

    Only one total for each writing task is ordered globally.
    """
    shards = spark.read.schema(SHARDS).parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    # one row a writing task: a few MB for a hundred thousand of them
    return shards.join(F.broadcast(bases), "part").withColumn("base", F.col("_before") + F.col("first")).drop("_before")


def read_documents(store: DataFrame, keep_ids: bool = True) -> DataFrame:
    """Every document read back by place: ``doc_id, start, n_tokens, ids_crc32`` (and ``ids``)."""
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("ids", pa.binary())] if keep_ids else []
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                dac, base = Dac(batch["payload"][row].as_py()), batch["base"][row].as_py()
                ends = np.array(batch["doc_ends"][row].as_py(), np.int64)
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                shard = memoryview(dac.slice(0, len(dac)).astype("<u4", copy=False).tobytes())  # documents lie in it without gaps
                ids = [shard[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [batch["doc_ids"][row].values, base + starts, ends - starts, [zlib.crc32(x) for x in ids]]
                columns += [[bytes(x) for x in ids]] if keep_ids else []
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], schema=schema)

    return store.select("base", "doc_ids", "doc_ends", "payload").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if keep_ids else ""))


def new_store_path(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return scratch_dir(spark, "token-store")
