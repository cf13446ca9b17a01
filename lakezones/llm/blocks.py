"""Blocks of texts, and names that blocks exchange.

A block is one row: a few MB of whole texts, compressed.  Blocks lie in a bucketed table, so answers
are joined to them without moving the texts again.  A round of exchange works like this:

* every block computes 64-bit names of something in its texts and sends each distinct name once, in
  sorted, delta-coded slices, one slice for each range of names;
* one task for each range sees the names of all blocks and gives every name of every
  block a one-byte answer, in the order sent;
* the answers come back as one row a block.

Names are spread by a mixing hash and distinct within a block, so neither a hot
string nor a hot group of copies makes a range uneven.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import frugal, give_back, scratch_path, shuffles_removed, small_batches, stored
from .words import Texts

BLOCK_BYTES = 4 << 20  # of text in a block; a longer text is a block of its own
PLACE_BITS = 22  # of a row's place in its block; a block has fewer rows than these number
RANGE_BYTES = 64 << 20  # of text for each range of names


class Block(Texts):
    """Texts of one block with their doc_ids (None: null)."""

    def __init__(self, payload: bytes):
        raw = zstandard.ZstdDecompressor().decompress(payload)
        (n,) = struct.unpack_from("<Q", raw)
        known = np.frombuffer(raw, np.uint8, n, 8)
        ids = np.frombuffer(raw, "<i8", n, 8 + n)
        self.ends = np.cumsum(np.frombuffer(raw, "<i8", n, 8 + 9 * n))
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        total = int(self.ends[-1]) if n else 0
        self.buf = np.frombuffer(raw, np.uint8, total, 8 + 17 * n)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known)]
        self.carried = raw[8 + 17 * n + total:]

    def rows(self, names: list[str], texts: list[str], places: list[int] | None = None) -> pa.RecordBatch:
        """Rows of the documents' own columns: all (or those at ``places``), with new texts; an empty text stays null if it was."""
        rest = pa.ipc.open_stream(self.carried).read_next_batch()
        if places is not None:
            rest = rest.take(pa.array(places, pa.int64()))
        null = rest.column(rest.num_columns - 1).to_pylist()
        text = pa.array([None if n and not t else t for n, t in zip(null, texts)], pa.string())
        others = iter(rest.columns)
        return pa.RecordBatch.from_arrays([text if c == "text" else next(others) for c in names], names=names)

    @staticmethod
    def pack(doc_ids: list, texts: list[bytes], carried: bytes) -> bytes:
        known = np.array([d is not None for d in doc_ids], np.uint8)
        ids = np.array([d or 0 for d in doc_ids], "<i8")
        sizes = np.array([len(t) for t in texts], "<i8")
        raw = struct.pack("<Q", len(texts)) + known.tobytes() + ids.tobytes() + sizes.tobytes() + b"".join(texts)
        raw += carried
        return zstandard.ZstdCompressor(level=3).compress(raw)


_BLOCKS = pa.schema([("block", pa.int64()), ("n_bytes", pa.int64()), ("payload", pa.binary())])


class BlockTable:
    """The blocks of a table of documents, written once."""

    def __init__(self, docs: DataFrame, label: str, ordered: bool, carry: bool = False, block_bytes: int = BLOCK_BYTES):
        """``ordered``: ascending blocks hold ascending documents, by (doc_id with nulls first, hash of text, text).

        ``carry``: the other columns travel with the texts as Arrow data, exact in every type, for ``Block.rows``.
        """
        spark = docs.sparkSession
        rest = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"] + [F.col("text").isNull().alias("no_text")]
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                           *([F.struct(*rest).alias("carried")] if carry else []))
        self.schema = docs.schema
        if ordered:
            rows = rows.withColumn("_h", F.xxhash64("text"))
            rows = rows.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text").drop("_h")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, number, size, ids, texts, carried = TaskContext.get().partitionId(), 0, 0, [], [], []
            if part >= 1 << 63 - 28 - PLACE_BITS:
                raise ValueError("too many scan partitions for block numbers")

            def flush() -> pa.RecordBatch:
                sink = pa.BufferOutputStream()
                if carried:
                    held = pa.RecordBatch.from_struct_array(pa.concat_arrays(carried))
                    with pa.ipc.new_stream(sink, held.schema) as out:
                        out.write_batch(held)
                return pa.RecordBatch.from_pydict({"block": [(part << 28) + number], "n_bytes": [size],
                                                   "payload": [Block.pack(ids, texts, sink.getvalue().to_pybytes())]}, schema=_BLOCKS)

            for batch in batches:
                first = 0
                for i, (doc, text) in enumerate(zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist())):
                    raw = text.encode()
                    if ids and (size + len(raw) > block_bytes or len(ids) + 1 >= 1 << PLACE_BITS):
                        if carry:
                            carried.append(batch["carried"].slice(first, i - first))
                        yield flush()
                        number, size, ids, texts, carried, first = number + 1, 0, [], [], [], i
                    ids.append(doc)
                    texts.append(raw)
                    size += len(raw)
                if carry:
                    carried.append(batch["carried"].slice(first))
            if ids:
                yield flush()

        self.spark, self.label = spark, label
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"lakezones_{label}_{uuid.uuid4().hex[:12]}".replace("-", "_")
        with shuffles_removed(spark), small_batches(spark):
            (rows.mapInArrow(frugal(run), "block long, n_bytes long, payload binary").write.option("compression", "none")
             .option("path", scratch_path(spark, label)).bucketBy(buckets, "block").saveAsTable(self.name))
        self.rows = spark.table(self.name)
        self.n_bytes = self.rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
        self.ranges = max(buckets, -(-self.n_bytes // RANGE_BYTES))  # more with the corpus, so that no task grows with it

    def exchange(self, send: Callable[[Block, dict], dict[int, np.ndarray]],
                 answer: Callable[[int, np.ndarray, np.ndarray, np.ndarray | None], np.ndarray], *earlier: DataFrame) -> DataFrame:
        """One round; returns stored answers for ``mapped`` or a later round.

        ``send(block, answers)`` gives sorted distinct names by kind, or names and a byte for each; ``answer(kind, names, blocks, sent)``
        gets all names of a range with the place of their block among the blocks (ascending with block order) and their bytes, if any, and
        returns a byte each.
        """
        ranges = self.ranges

        def out(block_id: int, block: Block, answers: dict) -> pa.RecordBatch:
            rows = []
            pack = zstandard.ZstdCompressor(level=1)
            for kind, names in send(block, answers).items():
                names, extra = names if isinstance(names, tuple) else (names, None)
                cuts = np.searchsorted(names, range_starts(ranges))
                for r, (a, b) in enumerate(zip(cuts, np.append(cuts[1:], len(names)))):
                    if b > a:
                        rows.append({"kind": kind, "range": r, "block": block_id, "blob": delta_coded(names[a:b]),
                                     "extra": None if extra is None else pack.compress(extra[a:b].tobytes())})
            return pa.RecordBatch.from_pylist(rows, schema=_SENT)

        def reduce(group: pa.Table) -> pa.Table:
            kind, r = group["kind"][0].as_py(), group["range"][0].as_py()
            ids = group["block"].to_numpy()
            parts = [delta_decoded(x.as_py()) for x in group["blob"]]
            sizes = np.array([len(p) for p in parts])
            place = np.searchsorted(np.sort(ids), ids).astype(np.int32)
            unpack = zstandard.ZstdDecompressor()
            extra = [np.frombuffer(unpack.decompress(x.as_py()), np.uint8) for x in group["extra"] if x.is_valid]
            names = np.concatenate(parts)
            del parts
            said = answer(kind, names, np.repeat(place, sizes), np.concatenate(extra) if extra else None).astype(np.uint8)
            pack = zstandard.ZstdCompressor(level=1)
            blobs = [pack.compress(s.tobytes()) for s in np.split(said, np.cumsum(sizes)[:-1])]
            del names, extra, said
            give_back()
            return pa.table({"kind": [kind] * len(ids), "range": [r] * len(ids), "block": ids, "blob": blobs}, schema=_BACK)

        sent = self.mapped(out, "kind int, range int, block long, blob binary, extra binary", *earlier)
        back = sent.groupBy("kind", "range").applyInArrow(reduce, "kind int, range int, block long, blob binary")
        return stored(back.groupBy("block").agg(F.collect_list(F.struct("kind", "range", "blob")).alias("answers")),
                      f"{self.label}-answers")

    def mapped(self, fn: Callable[[int, Block, dict[int, np.ndarray]], pa.RecordBatch], schema: str,
               *earlier: DataFrame) -> DataFrame:
        """``fn(block_id, block, answers)`` for every block, with the answers of earlier rounds by kind."""
        rows = self.rows
        for i, e in enumerate(earlier):
            rows = rows.join(e.withColumnRenamed("answers", f"_a{i}"), "block", "left")
        names = [f"_a{i}" for i in range(len(earlier))]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            unpack = zstandard.ZstdDecompressor()
            for batch in batches:
                for i in range(batch.num_rows):
                    said: dict[int, list] = {}
                    for name in names:
                        for a in sorted(batch[name][i].as_py() or [], key=lambda a: (a["kind"], a["range"])):
                            said.setdefault(a["kind"], []).append(np.frombuffer(unpack.decompress(a["blob"]), np.uint8))
                    answers = {k: np.concatenate(v) for k, v in said.items()}
                    yield fn(batch["block"][i].as_py(), Block(batch["payload"][i].as_py()), answers)

        return rows.select("block", "payload", *names).mapInArrow(frugal(run), schema)

    def drop(self) -> None:
        """Forget the table's name; its files go with the scope that made it."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


_BACK = pa.schema([("kind", pa.int32()), ("range", pa.int32()), ("block", pa.int64()), ("blob", pa.binary())])
_SENT = _BACK.append(pa.field("extra", pa.binary()))


def range_starts(n: int) -> np.ndarray:
    return np.array([-(-(i << 64) // n) for i in range(n)], np.uint64)


def delta_coded(names: np.ndarray) -> bytes:
    """Sorted names as their first and the differences, in as few whole bytes as the largest needs; zero bits that
    all differences end with are left out."""
    deltas = np.diff(names)
    ends = int(np.bitwise_or.reduce(deltas)) if len(deltas) else 0
    shift = (ends & -ends).bit_length() - 1 if ends else 0
    deltas >>= np.uint64(shift)
    width = max(1, (int(deltas.max()).bit_length() + 7) // 8) if len(deltas) else 1
    planes = deltas.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return struct.pack("<QBB", int(names[0]), width, shift) + planes.tobytes()


def delta_decoded(blob: bytes) -> np.ndarray:
    first, width, shift = struct.unpack_from("<QBB", blob)
    planes = np.frombuffer(blob, np.uint8, offset=10).reshape(-1, width)
    deltas = np.zeros((len(planes) + 1, 8), np.uint8)
    deltas[1:, :width] = planes
    out = deltas.view("<u8").ravel() << np.uint64(shift)
    out[0] = first
    return np.cumsum(out, dtype=np.uint64)
