"""Repeated substrings across documents by a difference-cover suffix algorithm.

Suffixes are sorted by names, not by bytes, and only to a depth of ``length`` (50) bytes:

1. Sample.  Positions whose place in the document modulo 31 lies in a perfect difference set (6 of 31)
   are sampled.  For any two positions some shift below 31 takes both to sampled ones, so two equal
   50-byte strings hold equal 20-byte tuples at a sampled place of both.
2. Names.  The sampled tuples are named by hash and the names sorted across the corpus.
   A tuple that no second document has cannot lie in a repeated string; its suffixes are discarded.
3. Recursion.  Chunks between content-defined cuts, with the 49 bytes after them, get names
   of their own.  A chunk that an earlier document has settles all strings that begin in it,
   so long repeats need no name for each position.
4. Merge.  Each remaining position near a tuple that is left gets the name of its 50 bytes.
5. Equal neighbours among the sorted names share a prefix of 50 bytes; all but those of the first document are marked.

Blocks hold ascending documents, so "a smaller document" is "an earlier block, or an earlier
text of this block" and no doc_id travels with a name.  The cover is modulo 31 instead of 3: 19 % of the
positions are sorted, not 67 %.  Names of chunks and strings have 64 bits.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .blocks import BLOCK_BYTES, Block, BlockTable
from .common import scratch_tables, stored
from .words import distinct, mix

LENGTH = 50
PERIOD = 31
# A perfect difference set modulo 31 (every difference but 0 occurs once).
COVER = (1, 5, 11, 24, 25, 27)
CUT_BITS = 5  # content-defined cuts come every 2^5 bytes on average
CUT_GRAM = 8

ANCHORS, CHUNKS, STRINGS = 0, 1, 2

_TABLE = np.random.default_rng(50).integers(1, 2**63, 256, dtype=np.uint64)
_R = 0x9E3779B97F4A7C15
_R_INVERSE = pow(_R, -1, 1 << 64)
_IN_COVER = np.isin(np.arange(PERIOD), COVER)


def _power(base: int, n: int) -> np.ndarray:
    """Powers 0 to n - 1 of ``base`` modulo 2^64."""
    full = np.full(n, base, np.uint64)
    full[:1] = 1
    return np.cumprod(full, dtype=np.uint64, out=full)


_RUN = 1 << 16  # bytes in work at a time; they share the tables of powers
_POWERS, _INVERSES = _power(_R, _RUN), _power(_R_INVERSE, _RUN)


class Positions:
    """What one block's texts give: names of sampled tuples, chunks and strings."""

    def __init__(self, block: Block, length: int, anchor_bits: int):
        self.block, self.length = block, length
        n = len(block.buf)
        self.prefix = np.zeros(n + 1, np.uint64)
        self.back = np.array([pow(_R_INVERSE, a, 1 << 64) for a in range(0, n + 1, _RUN)], np.uint64)
        for a in range(0, n, _RUN):
            part = self.prefix[a + 1:a + 1 + _RUN]
            np.multiply(_TABLE[block.buf[a:a + _RUN]], _POWERS[:len(part)], out=part)
            part *= np.uint64(pow(_R, a, 1 << 64))
        np.cumsum(self.prefix, out=self.prefix)
        lengths = block.ends - block.starts
        long = lengths >= length
        self.starts, self.ends = block.starts[long], block.ends[long]
        sizes = self.ends - self.starts
        tuple_size = length - PERIOD + 1
        most = int(sizes.max()) if len(sizes) else 0
        cover = np.flatnonzero(_IN_COVER[np.arange(most) % PERIOD])
        per_text = np.searchsorted(cover, np.maximum(sizes - tuple_size + 1, 0))  # sampled places that fit
        skip = np.cumsum(per_text) - per_text
        self.anchor_at = cover[np.arange(int(per_text.sum())) - np.repeat(skip, per_text)] + np.repeat(self.starts, per_text)
        names = mix(self.range_hash(self.anchor_at, self.anchor_at + tuple_size))
        self.anchor = names >> np.uint64(64 - anchor_bits) << np.uint64(64 - anchor_bits)
        cut = covering(self.starts, self.ends - length + 1, n)  # strings begin here
        for run, a in enumerate(range(0, n, _RUN)):
            at = self.prefix[a:min(a + _RUN, n + 1 - CUT_GRAM)]
            gram = (self.prefix[a + CUT_GRAM:a + CUT_GRAM + _RUN] - at) * _INVERSES[:len(at)] * self.back[run]
            cut[a:a + len(at)] &= gram * np.uint64(_R) >> np.uint64(64 - CUT_BITS) == 0
        cut[self.starts] = True
        self.chunk_from = np.flatnonzero(cut)
        owner = np.searchsorted(self.ends, self.chunk_from, side="right")
        after = np.append(self.chunk_from[1:], np.iinfo(np.int64).max)
        self.chunk_to = np.minimum(after, self.ends[owner] - length + 1) if len(owner) else after[:0]
        self.chunk = mix(self.range_hash(self.chunk_from, self.chunk_to + length - 1)
                         + (self.chunk_to - self.chunk_from).astype(np.uint64))

    def range_hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.prefix[b] - self.prefix[a]) * _INVERSES[a % _RUN] * self.back[a // _RUN]

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.block.ends, places, side="right")

    def candidates(self, repeated: np.ndarray, covered: np.ndarray) -> np.ndarray:
        """Starts of strings that hold a repeated tuple at a sampled place and no chunk has settled."""
        n = len(self.block.buf)
        at = self.anchor_at[repeated]
        doc = self.doc_of(at)
        low = np.maximum(at - (PERIOD - 1), self.block.starts[doc])
        high = np.minimum(at, self.block.ends[doc] - self.length)
        some = low <= high
        return np.flatnonzero(covering(low[some], high[some] + 1, n) & ~covered)

    def covered(self, settled: np.ndarray) -> np.ndarray:
        return covering(self.chunk_from[settled], self.chunk_to[settled], len(self.block.buf))


def covering(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Places below ``n`` in any of the ranges [a, b), none of them empty; ``a`` ascends."""
    change = np.zeros(n + 1, np.int8)
    if len(a):
        reach = np.maximum.accumulate(b)
        new = np.append(True, a[1:] > reach[:-1])
        change[a[new]] = 1
        change[reach[np.append(new[1:], True)]] = -1
    return np.cumsum(change[:n], dtype=np.int8).view(bool)


def reached(starts: np.ndarray, length: int) -> np.ndarray:
    """Places that are less than ``length`` behind a marked one, or marked."""
    sums = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(starts, dtype=np.int32, out=sums[1:])
    out = sums[1:] > 0
    out[length - 1:] = sums[length:] > sums[:max(len(sums) - length, 0)]
    return out


def grouped(names: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct names, which of them each place has, and the first and last text of each."""
    order = np.argsort(names)
    s = names[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    begin = np.flatnonzero(new)
    which = np.empty(len(names), np.int64)
    which[order] = np.cumsum(new) - 1
    owner = docs[order]
    if not len(begin):
        return s, which, owner, owner
    return s[begin], which, np.minimum.reduceat(owner, begin), np.maximum.reduceat(owner, begin)


def answer(kind: int, names: np.ndarray, blocks: np.ndarray, _: np.ndarray | None = None) -> np.ndarray:
    """Tuples: do two blocks have it? Chunks and strings: does an earlier block have it?"""
    order = np.argsort(names)
    s = names[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    begin = np.flatnonzero(new)
    sizes = np.diff(np.append(begin, len(s)))
    out = np.empty(len(names), np.uint8)
    if kind == ANCHORS:
        out[order] = np.repeat(sizes > 1, sizes)
    else:
        owner = blocks[order]
        out[order] = owner > np.repeat(np.minimum.reduceat(owner, begin), sizes)
    return out


class Marks:
    """The last two steps on a block, each from the answers so far."""

    def __init__(self, block: Block, length: int, anchor_bits: int):
        self.p = Positions(block, length, anchor_bits)
        self.anchors = grouped(self.p.anchor, self.p.doc_of(self.p.anchor_at))
        self.chunks = grouped(self.p.chunk, self.p.doc_of(self.p.chunk_from))

    def strings(self, answers: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, tuple]:
        names, which, first, last = self.anchors
        repeated = ((first != last) | _said(answers, ANCHORS, len(names)))[which]
        names, which, first, _ = self.chunks
        settled = _said(answers, CHUNKS, len(names))[which] | (self.p.doc_of(self.p.chunk_from) > first[which])
        covered = self.p.covered(settled)
        at = self.p.candidates(repeated, covered)
        return covered, at, grouped(mix(self.p.range_hash(at, at + self.p.length)), self.p.doc_of(at))

    def removed(self, answers: dict[int, np.ndarray]) -> np.ndarray:
        """Bytes of the block that a string of a smaller document covers."""
        covered, at, (names, which, first, _) = self.strings(answers)
        found = _said(answers, STRINGS, len(names))[which] | (self.p.doc_of(at) > first[which])
        covered[at[found]] = True
        return reached(covered, self.p.length)


def _said(answers: dict[int, np.ndarray], kind: int, n: int) -> np.ndarray:
    said = answers.get(kind)
    return np.zeros(n, bool) if said is None else said.astype(bool)


def removal(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document.

    A byte goes if a ``length``-byte string that covers it also starts in a smaller document; strings are
    judged on the input, overlaps count, nothing crosses documents.  Null texts are empty, texts shorter than
    ``length`` keep all.  Null doc_ids are the smallest; of rows that share a doc_id the one with the
    smaller (hash of text, text) counts as the smaller document.  No documents: no rows.  Other columns are ignored.
    """
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    schema = pa.schema(list(zip(names, [pa.int64()] * 4 + [pa.string()])))

    def result(block: Block, gone: np.ndarray) -> pa.RecordBatch:
        rows = []
        for doc, a, b in zip(block.doc_ids, block.starts.tolist(), block.ends.tolist()):
            part = gone[a:b]
            spans = int((part[1:] & ~part[:-1]).sum() + part[0]) if b > a else 0
            kept = block.buf[a:b][~part].tobytes()
            rows.append((doc, b - a, int(part.sum()), spans, hashlib.sha256(kept).hexdigest()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), schema.types)], schema=schema)

    with scratch_tables(docs.sparkSession):
        done, table = _judged(docs, length, False, result,
                              "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
        table.drop()
    return done


def without_repeats(docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with what ``removal`` removes cut from their texts; all rows and columns stay.

    Bytes of a code point that was cut in two go as well; ``n_chars``, if there, is counted anew.
    ``block_bytes`` of text are in work in a task at a time.
    """
    names = docs.columns

    def result(block: Block, gone: np.ndarray) -> pa.RecordBatch:
        texts = [block.buf[a:b][~gone[a:b]].tobytes().decode(errors="ignore")
                 for a, b in zip(block.starts.tolist(), block.ends.tolist())]
        return block.rows(names, texts)

    with scratch_tables(docs.sparkSession):
        out, table = _judged(docs, length, True, result, docs.schema, block_bytes)
        table.drop()
    return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in out.columns else out


def _judged(docs: DataFrame, length: int, carry: bool, result: Callable[[Block, np.ndarray], pa.RecordBatch],
            schema: str | StructType, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, BlockTable]:
    if length <= PERIOD:
        raise ValueError(f"length must be over {PERIOD}")
    table = BlockTable(docs, "suffix", ordered=True, carry=carry, block_bytes=block_bytes)
    bits = min(64, max(32, math.ceil(math.log2(max(table.n_bytes, 2))) + 8))  # false repeats stay below 1 in 1,000

    def send_names(block: Block, _: dict) -> dict[int, np.ndarray]:
        p = Positions(block, length, bits)
        return {ANCHORS: distinct(p.anchor), CHUNKS: distinct(p.chunk)}

    def send_strings(block: Block, answers: dict) -> dict[int, np.ndarray]:
        return {STRINGS: Marks(block, length, bits).strings(answers)[2][0]}

    def judge(_: int, block: Block, answers: dict) -> pa.RecordBatch:
        return result(block, Marks(block, length, bits).removed(answers))

    names = table.exchange(send_names, answer)
    strings = table.exchange(send_strings, answer, names)
    return stored(table.mapped(judge, schema, names, strings), "suffix-kept", keep=True), table
