"""Suffix dedup against brute force on the smallest table and on odd rows."""

import hashlib
import random

import pytest

from conftest import SF_SMALL
from lakezones.llm import queries as q
from lakezones.llm.suffix_dedup import COVER, PERIOD, removal


def brute(docs, length=50):
    """``docs``: (doc_id, bytes) in order; the first document of each string counts."""
    first, out = {}, []
    for i, (_, b) in enumerate(docs):
        for j in range(len(b) - length + 1):
            first.setdefault(b[j:j + length], i)
    for i, (doc, b) in enumerate(docs):
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if first[b[j:j + length]] < i:
                gone[j:j + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rows_of(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def test_cover_is_a_perfect_difference_set():
    assert sorted((a - b) % PERIOD for a in COVER for b in COVER if a != b) == list(range(1, PERIOD))


def test_op5(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    ordered = [(r.doc_id, (r.text or "").encode()) for r in docs.orderBy("doc_id").collect()]
    got = q.op5_suffix_dedup(spark, SF_SMALL)
    assert rows_of(got) == sorted(brute(ordered), key=str)


@pytest.mark.parametrize("length", [40, 50, 64])
def test_random_overlaps(spark, length):
    rng = random.Random(length)
    passage = ["".join(rng.choice("abcdefgh é") for _ in range(n)) for n in (length - 1, length, length + 1, 300, 900)]
    docs = []
    for i in range(60):
        text = "".join(rng.choice(["", "x" * rng.randrange(80), rng.choice(passage), rng.choice(passage)[rng.randrange(20):],
                                   "".join(rng.choice("abcd") for _ in range(rng.randrange(90)))]) for _ in range(6))
        docs.append((i, text))
    got = removal(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), length)
    assert rows_of(got) == sorted(brute([(i, t.encode()) for i, t in docs], length), key=str)


def test_odd_rows(spark):
    long = "all work and no play makes a dull day, and then some more of it. " * 3
    rows = [(4, long, 1, 1, 1), (2, None, 1, 1, 1), (1, "", 1, 1, 1), (7, long, 1, 1, 1), (7, long, 1, 1, 1), (None, long + "!", 1, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block int, payload int, kept int")
    got = removal(docs).collect()
    by = {(r.doc_id, r.n_removed) for r in got}
    n = len(long)
    assert len(got) == 6 and (None, 0) in by and (4, n) in by and (7, n) in by and (2, 0) in by and (1, 0) in by
    assert removal(docs.where("false")).collect() == []


def test_work_arrays_of_a_block_stay_small():
    """Positions, powers and sums of all bytes once took 47 bytes for each byte of text, twice the block's share of a worker."""
    import tracemalloc

    from lakezones.llm.blocks import Block
    from lakezones.llm.suffix_dedup import Marks

    rng = random.Random(6)
    texts = [bytes(rng.choices(b"abcdefgh ", k=2000)) for _ in range(300)]
    block = Block(Block.pack(list(range(300)), texts, b""))
    tracemalloc.start()
    try:
        assert not Marks(block, 50, 40).removed({}).any()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 36 * len(block.buf)


def test_ranges_and_reach():
    import numpy as np

    from lakezones.llm.suffix_dedup import covering, reached

    rng = np.random.default_rng(7)
    for n in (1, 5, 60, 300):
        for k in (0, 1, 2, 40):
            a = np.sort(rng.integers(0, n, k))
            b = np.minimum(a + rng.integers(1, 20, k), n)
            got = covering(a, b, n)
            assert got.dtype == bool and got.tolist() == [bool(((a <= i) & (i < b)).any()) for i in range(n)]
            marked = np.isin(np.arange(n), a)
            assert reached(marked, 7).tolist() == [bool(marked[max(i - 6, 0):i + 1].any()) for i in range(n)]


def test_rows_go_to_python_in_batches_of_a_few_megabytes(spark):
    """A batch of 10,000 documents once was held whole by the JVM and by the worker."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    from lakezones.llm.common import BATCH_BYTES, stored

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    docs = spark.range(0, 9000, 1, 1).select("id", F.expr("repeat('x', 2000)").alias("text"))
    found = [r.n for r in stored(docs.mapInArrow(sizes, "n long"), "batch-sizes").collect()]
    assert len(found) > 2 and max(found) < 1.1 * BATCH_BYTES and spark.conf.get(name) == before
