"""Best-fit packing by minimum bin slack.

Each bin takes the longest piece left, then a bitset subset-sum program over the
lengths still available finds the combination that fills the rest best.
The program sees only how many pieces of each length there are, a
histogram of at most ``capacity`` numbers whatever the corpus; a combination is
repeated as long as its lengths last, which gives the same bins as solving again.
Each pattern leaves one of its lengths with fewer pieces than it takes, so there are at
most sum(1 + capacity / length) of them, about 8,000 at 1024.  Pieces find their
place by their rank among the pieces of their length, numbered by counts per task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import frugal, slices, stored
from .tokens import CACHE_PARTS, encoder

CAPACITY = 1024
END_ID = 2
SLICE_BYTES = 4 << 20

Pattern = tuple[int, list[tuple[int, int]]]  # repeats, [(length, copies)]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 keep_ids: bool = True, cache_parts: int = CACHE_PARTS) -> DataFrame:
    """Pieces ``doc_id, piece, start, length, ids_crc32`` (and ``ids``, little-endian 32-bit) of whole documents.

    A document's ids end with ``end_id``.  Only a document longer than ``capacity`` is cut: into pieces
    of ``capacity``, the first of which may be shorter.  A null text is empty; rows that share a doc_id and null
    doc_ids are documents of their own.  Other columns are ignored.
    """
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64())] + ([("ids", pa.binary())] if keep_ids else [])
    schema, end = pa.schema(fields), np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, True, cache_parts)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                out: dict[str, list] = {name: [] for name, _ in fields}
                for doc, ids in zip(part["doc_id"].to_pylist(), enc.encode(part["text"].to_pylist())):
                    ids += end
                    n, at, k = len(ids) // 4, 0, 0
                    size = (n - 1) % capacity + 1
                    while at < n:
                        piece = ids[4 * at:4 * (at + size)]
                        for name, v in (("doc_id", doc), ("piece", k), ("start", at), ("length", size),
                                        ("ids_crc32", zlib.crc32(piece)), ("ids", piece)):
                            if name in out:
                                out[name].append(v)
                        at, k, size = at + size, k + 1, capacity
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    text = F.coalesce("text", F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("long"), text).mapInArrow(
        frugal(run, "tokens"), "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else ""))


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """The combination of available lengths with the greatest sum of at most ``room``; long pieces first among equals."""
    reach, mask, steps = 1, (1 << room + 1) - 1, []
    for length in sorted((k for k, n in counts.items() if n and k <= room), reverse=True):
        for _ in range(min(counts[length], room // length)):
            more = reach | reach << length & mask
            if more == reach:
                break
            steps.append((length, reach))
            reach = more
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + 1
            total -= length
    return sorted(used.items(), reverse=True)


def packing_plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that use up all pieces."""
    counts, plan = {k: n for k, n in counts.items() if n}, []
    while counts:
        longest = max(counts)
        rest = {**counts, longest: counts[longest] - 1}
        use = dict(fullest(rest, capacity - longest))
        use[longest] = use.get(longest, 0) + 1
        repeats = min(counts[k] // c for k, c in use.items())
        plan.append((repeats, sorted(use.items(), reverse=True)))
        for k, c in use.items():
            counts[k] -= repeats * c
            if not counts[k]:
                del counts[k]
    return plan


def numbered(pieces: DataFrame) -> DataFrame:
    """Add ``_part`` (the task) and ``_rank`` (from 0 among the pieces of one length in the task); stored."""
    schema = pieces.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            ranks = []
            for n in batch["length"].to_pylist():
                ranks.append(seen.get(n, 0))
                seen[n] = ranks[-1] + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pa.array(ranks, pa.int64())],
                names=[*batch.schema.names, "_part", "_rank"])

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return stored(pieces.mapInArrow(run, f"{out}, _part int, _rank long"), "pieces")


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` from 1 to ``capacity``.

    Places in a sequence are gapless from 0.  No pieces: no rows.
    """
    spark = pieces.sparkSession
    rows = numbered(pieces)
    own = ["_part", "length"]
    per_task = rows.where(F.col("length") < capacity).groupBy(*own).agg(F.count("*").alias("_n"))
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan, first, used = [], 0, {}
    for repeats, use in packing_plan(histogram, capacity):  # a bounded number of patterns
        at = 0
        for length, copies in use:
            begin = used.get(length, 0)
            used[length] = begin + repeats * copies
            plan.append((length, begin, used[length], copies, first, at))
            at += length * copies
        first += repeats
    plan_rows = spark.createDataFrame(plan, "_length long, _from long, _to long, _copies long, _first long, _at long")
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    short = rows.where(F.col("length") < capacity).join(bases, own).withColumn("_rank", F.col("_rank") + F.col("_base"))
    # about 8,000 patterns of less than sqrt(2 * capacity) = 45 lengths each at most: under 20 MB at 1024
    short = short.join(F.broadcast(plan_rows), (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from"))
                       & (F.col("_rank") < F.col("_to")))
    nth = F.col("_rank") - F.col("_from")
    short = short.select(*pieces.columns, (F.col("_first") + F.expr("(_rank - _from) div _copies")).alias("sequence_id"),
                         (F.col("_at") + F.col("length") * (nth % F.col("_copies"))).alias("offset"))
    full_id = -1 - (F.col("_part").cast("long") * F.lit(1 << 36) + F.col("_rank"))  # a full piece is a sequence
    full = rows.where(F.col("length") >= capacity).select(*pieces.columns, full_id.alias("sequence_id"),
                                                           F.lit(0).cast("long").alias("offset"))
    return short.unionByName(full)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   keep_ids: bool = True, cache_parts: int = CACHE_PARTS) -> DataFrame:
    """Pieces of all documents with their places; see ``token_pieces`` and ``place``."""
    return place(token_pieces(docs, tokenizer_path, capacity, end_id, keep_ids, cache_parts), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences, ``sequence_id, ids``; a group holds at most ``capacity`` ids."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (packed.groupBy("sequence_id").agg(ordered.alias("_p"))
            .select("sequence_id", F.expr("aggregate(_p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids")))
