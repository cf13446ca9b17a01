"""Whole-row comparison and numbering of a slice at a time: the same rows, and less disk, than the table at once."""

import os
import threading
import time
from urllib.parse import urlparse

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakezones.operators import changes, slices
from lakezones.operators.ledger import Ledger
from lakezones.operators.rownum import numbered_in_slices
from lakezones.plans import promote, runs
from lakezones.plans.extract import extract_table
from lakezones.session import CLEANUP_CONF, scratch_dir, shared_root, shuffles_removed
from lakezones.sources.files import FrameSource
from lakezones.sources.lake import LakeTable
from lakezones.specs import TableSpec

SCHEMA = "k int, line string, v double, at timestamp"
SPEC = TableSpec("t", required_columns=("v",), primary_key=("k", "line"))
DAYS = "2024-03-08", "2024-03-09", "2024-03-10"


@pytest.fixture()
def sliced(monkeypatch):
    """Small tables are cut as large ones are."""
    monkeypatch.setattr(slices, "SLICE_BYTES", 1)


def _rows(n, shift=0.0):
    """Repeated and null keys, copies of rows, zeros of both signs and numbers that are none."""
    out = []
    for i in range(n):
        v = (None, float("nan"), -0.0, 0.0)[i % 4] if i % 3 == 0 else i * 0.1 + (shift if i % 17 == 0 else 0.0)
        out.append((None if i % 5 == 0 else i % 29, ("a", "b", None)[i % 3], v, None))
    return out + out[::7] + [(1, "hot", 1.0, None)] * (n // 2)


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _texts(df, columns=("k", "line", "v", "at")):
    """Rows as text; zeros are equal, and so are numbers that are none."""
    return sorted(repr(tuple(0.0 if x == 0 else x for x in r)) for r in df.select(*columns).collect())


def test_every_row_is_in_one_slice(spark, sliced):
    df = _frame(spark, _rows(300))
    parts = [slices.value_slice(df, df.columns, 4, i) for i in range(4)]
    assert sorted(t for p in parts for t in _texts(p)) == _texts(df)
    zeros = _frame(spark, [(1, "z", 0.0, None), (1, "z", -0.0, None)])
    assert sorted(slices.value_slice(zeros, zeros.columns, 4, i).count() for i in range(4)) == [0, 0, 0, 2]
    ranges = list(slices.range_slices(df, ["k", "line", "v"], 4, df.count()))
    assert len(ranges) > 1 and sorted(t for p in ranges for t in _texts(p)) == _texts(df)


def test_numbers_in_slices_are_those_of_the_whole(spark, sliced):
    df = _frame(spark, _rows(300))
    got = []
    for part in numbered_in_slices(df, ["k", "line", "v"], ["k", "line", "v"], 4, df.count()):
        got += [tuple(r) for r in part.collect()]  # before the next slice
    order = [F.col(c).asc_nulls_first() for c in ("k", "line", "v")]
    want = df.select("k", "line", "v", F.row_number().over(Window.orderBy(*order))).collect()
    plain = lambda rows: sorted(repr(tuple(0.0 if x == 0 else x for x in r)) for r in rows)
    assert plain(got) == plain(want)


def test_slices_follow_the_size(spark, monkeypatch):
    df = spark.range(1000)
    assert slices.slice_count(df, rows=1000) == 1
    monkeypatch.setattr(slices, "SLICE_BYTES", 1000)
    assert slices.slice_count(df, rows=1000) == slices.MOST_SLICES and slices.slice_count(df, rows=1000, share=0.3) == 2
    assert slices.slice_count(spark.createDataFrame([(1,)], "a int"), None) >= 1


@pytest.mark.parametrize("collide", [False, True])
def test_extract_in_slices(spark, lake, sliced, monkeypatch, collide):
    """The same snapshot adds nothing, a changed one its changed rows, all copies, with their numbers among all rows."""
    if collide:
        real = F.xxhash64
        monkeypatch.setattr(changes.F, "xxhash64", lambda *c: real(*c) % 3)  # digests and row hashes are shared
    root, ledger = lake
    first, second = _rows(300), _rows(300, shift=5.0) + [(1, "hot", 2.0, None)] * 100
    kinds = []
    for rows, day in zip((first, first, second), DAYS):
        out = extract_table(spark, root, ledger, FrameSource("t", _frame(spark, rows)), SPEC, db_name="d", schema="s", run_date=day)
        kinds.append(out.kind)
    assert kinds == [runs.WRITTEN, runs.NO_CHANGES, runs.WRITTEN]
    raw = LakeTable(spark, ledger, root, "raw", "t", "d", "s")
    day1 = raw.read(job_date=DAYS[0])
    assert _texts(day1) == _texts(_frame(spark, first))
    assert sorted(r[0] for r in day1.select("ROW_NUMBER").collect()) == list(range(1, len(first) + 1))
    day3, old = raw.read(job_date=DAYS[2]), set(_texts(_frame(spark, first)))
    want = [t for t in _texts(_frame(spark, second)) if t not in old]
    assert len(want) > 100 and _texts(day3) == want
    numbers = [r[0] for r in day3.select("ROW_NUMBER").collect()]
    assert len(set(numbers)) == len(want) and max(numbers) <= len(second)
    key = [F.col(c).asc_nulls_first() for c in ("k", "line")]
    ranked = _frame(spark, second).select("k", "line", F.row_number().over(Window.orderBy(*key)).alias("n"))
    span = {(r.k, r.line): (r.lo, r.hi) for r in ranked.groupBy("k", "line").agg(F.min("n").alias("lo"), F.max("n").alias("hi")).collect()}
    for r in day3.select("k", "line", "ROW_NUMBER").collect():
        assert span[r.k, r.line][0] <= r.ROW_NUMBER <= span[r.k, r.line][1]
    assert not _left(spark, "changed") and not _left(spark, "numbering")


def _left(spark, label):
    top = urlparse(shared_root(spark)).path + "/lakezones"
    return [x for x in os.listdir(top) if x.startswith(label)]


@pytest.mark.parametrize("pending", [1, 3])
def test_promote_in_slices(spark, lake, sliced, pending):
    """Batches of a key that repeats: staging gets the rows it does not have, all copies, once."""
    root, ledger = lake
    snapshots = [_rows(200, shift=float(i)) for i in range(pending + 1)]

    def extract(rows):
        extract_table(spark, root, ledger, FrameSource("t", _frame(spark, rows)), SPEC, db_name="d", schema="s", run_date=DAYS[0])

    def promoted():
        return promote.promote_table(spark, root, ledger, db_name="d", schema="s", table_name="t", job_date=DAYS[0], primary_key=SPEC.primary_key)

    extract(snapshots[0])
    promoted()
    for rows in snapshots[1:]:
        extract(rows)
    assert [o.kind for o in promoted()] == [runs.WRITTEN] * pending
    staged = LakeTable(spark, ledger, root, "staging", "t", "d", "s").read()
    raw = LakeTable(spark, ledger, root, "raw", "t", "d", "s").read()
    assert raw.count() > len(snapshots[0]) and _texts(staged) == _texts(raw)
    assert _texts(staged, ("k", "line", "ROW_NUMBER")) == _texts(raw, ("k", "line", "ROW_NUMBER"))
    assert promoted() == []


@pytest.mark.parametrize("pending", [1, 3])
def test_promote_unique_batches_in_slices(spark, lake, sliced, pending):
    """Batches whose key is unique, over staging where it repeats and was narrower: the newest version of a key decides."""
    root, ledger = lake
    spec = TableSpec("t", required_columns=("v",), primary_key=("k",))
    first = [(i % 60, "a", float(i), None) for i in range(90)]

    def run(rows, kind):
        frame = spark.createDataFrame(rows, SCHEMA.replace("k int", f"k {kind}"))
        extract_table(spark, root, ledger, FrameSource("t", frame), spec, db_name="d", schema="s", run_date=DAYS[0])

    def promoted():
        return promote.promote_table(spark, root, ledger, db_name="d", schema="s", table_name="t", job_date=DAYS[0], primary_key=("k",))

    run(first, "int")
    promoted()
    for n in range(1, pending + 1):  # more keys each day, all of them new
        run(first + [(1000 * n + i, "new", 0.5, None) for i in range(40)] + [(i, "b", float(n), None) for i in range(0, 60, 7)], "long")
    assert [o.kind for o in promoted()] == [runs.WRITTEN] * pending
    staged = LakeTable(spark, ledger, root, "staging", "t", "d", "s").read()
    raw = LakeTable(spark, ledger, root, "raw", "t", "d", "s").read()
    assert raw.count() == 90 + pending * 49 and _texts(staged, ("k", "line", "v", "ROW_NUMBER")) == _texts(raw, ("k", "line", "v", "ROW_NUMBER"))


def test_a_new_column_without_a_type_is_no_change(spark, lake):
    root, ledger = lake
    df = _frame(spark, _rows(40))
    kinds = [extract_table(spark, root, ledger, FrameSource("t", x), SPEC, db_name="d", schema="s", run_date=day).kind
             for x, day in ((df, DAYS[0]), (df.withColumn("later", F.lit(None)), DAYS[1]))]
    assert kinds == [runs.WRITTEN, runs.NO_CHANGES]


def test_shuffles_are_removed_until_the_last_thread_leaves(spark):
    before = spark.conf.get(CLEANUP_CONF)
    inside, leave = threading.Event(), threading.Event()

    def other():
        with shuffles_removed(spark):
            inside.set()
            leave.wait(20)

    t = threading.Thread(target=other)
    with shuffles_removed(spark):
        t.start()
        inside.wait(20)
    assert spark.conf.get(CLEANUP_CONF) == "true"
    leave.set()
    t.join()
    assert spark.conf.get(CLEANUP_CONF) == before


def _most_kept(spark, run):
    """The most bytes of shuffle files and scratch tables while ``run`` works."""
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    tops = [str(d.getPath()) for d in env.blockManager().diskBlockManager().localDirs()] + [urlparse(shared_root(spark)).path]
    most, stop = [0], threading.Event()

    def size():
        return sum(os.lstat(f"{d}/{x}").st_size for top in tops for d, _, names in os.walk(top) for x in names if os.path.lexists(f"{d}/{x}"))

    floor = size()

    def watch():
        while not stop.is_set():
            try:
                most[0] = max(most[0], size() - floor)
            except OSError:  # a file went meanwhile
                pass
            time.sleep(0.05)

    t = threading.Thread(target=watch)
    t.start()
    try:
        run()
    finally:
        stop.set()
        t.join()
    return most[0]


def test_disk_of_a_promotion_follows_a_slice(spark, monkeypatch):
    """One changed row over a large staging table: its whole state was shuffled at once."""
    monkeypatch.setattr(slices, "SLICE_BYTES", 1 << 20)
    root = scratch_dir(spark, "promotion")
    ledger = Ledger(spark, f"{root}/_ledger")
    df = spark.range(0, 300_000, 1, 4).select((F.col("id") % 150_000).alias("k"), F.rand(1).alias("v"), F.rand(2).alias("w"))
    for zone in ("raw", "staging"):
        LakeTable(spark, ledger, root, zone, "t", "d", "s").append(df.withColumn("ROW_NUMBER", F.col("k") + 1), DAYS[0], details={"source_path": "x"})
    raw = LakeTable(spark, ledger, root, "raw", "t", "d", "s")
    raw.append(spark.createDataFrame([(1, 2.0, 3.0, 1)], "k long, v double, w double, ROW_NUMBER long"), DAYS[0], details={"max_row_number": 1})
    first, newest = raw.committed_paths()
    file = sum(os.lstat(f"{urlparse(first).path}/{x}").st_size for x in os.listdir(urlparse(first).path))
    real = promote.pending_batches
    monkeypatch.setattr(promote, "pending_batches", lambda *a, **k: [p for p in real(*a, **k) if p[0] == newest])

    def run():
        out = promote.promote_table(spark, root, ledger, db_name="d", schema="s", table_name="t", job_date=DAYS[0], primary_key=("k",))
        assert [(o.kind, o.rows_written) for o in out] == [(runs.WRITTEN, 1)]

    most = _most_kept(spark, run)
    assert most < 0.8 * file, f"{most / file:.2f} x the table"


def test_disk_follows_a_slice(spark, monkeypatch):
    """The same snapshot twice, then a changed one: shuffle files and checkpoints of the whole table stayed before."""
    monkeypatch.setattr(slices, "SLICE_BYTES", 1 << 20)
    top = scratch_dir(spark, "source")
    (spark.range(0, 400_000, 1, 4).select((F.col("id") % 150_000).alias("k"), (F.xxhash64("id") % 7).cast("string").alias("line"),
                                          F.rand(1).alias("v"), F.rand(2).alias("w"), F.rand(3).alias("x"))
     .write.parquet(top))
    df = spark.read.parquet(top)
    file = sum(os.lstat(f"{urlparse(top).path}/{x}").st_size for x in os.listdir(urlparse(top).path))
    root = scratch_dir(spark, "disk")
    ledger = Ledger(spark, f"{root}/_ledger")

    def run():
        for frame, day in zip((df, df, df.withColumn("v", F.when(F.col("k") == 7, 2.0).otherwise(F.col("v")))), DAYS):
            extract_table(spark, root, ledger, FrameSource("t", frame), SPEC, db_name="d", schema="s", run_date=day)

    most = _most_kept(spark, run)
    assert LakeTable(spark, ledger, root, "raw", "t", "d", "s").read().count() > 400_000
    assert most < 3.5 * file, f"{most / file:.2f} x the source"
