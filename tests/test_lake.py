import os

from conftest import SF_SMALL
from lakezones.plans.text_job import count_and_save_text
from lakezones.sources.files import read_csv
from lakezones.sources.lake import LakeTable, write_batch, write_text
from lakezones.session import scratch_dir


def test_append_read_and_orphans(spark, lake):
    root, ledger = lake
    t = LakeTable(spark, ledger, root, "raw", "orders", "db", "main")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    assert t.read() is None
    assert t.append(orders, "2024-03-08") == orders.count()
    # a batch written but never committed stays invisible
    orphan, _ = t.new_batch_path("2024-03-08")
    write_batch(orders.limit(3), orphan)
    assert t.read().count() == orders.count()
    t.append(orders.limit(10), "2024-03-09")
    assert t.read().count() == orders.count() + 10
    assert t.read(job_date="2024-03-09").count() == 10
    cols = t.read(with_batch_columns=True).columns
    assert "ingest_date" in cols and "batch_id" in cols
    assert "/raw/db/main/orders/ingest_date=2024-03-08/batch_id=" in t.committed_paths()[0]


def test_replace_reads_newest_only(spark, lake):
    root, ledger = lake
    t = LakeTable(spark, ledger, root, "warehouse", "wide")
    t.replace(spark.range(5), "2024-03-08")
    t.replace(spark.range(7), "2024-03-08")
    assert t.read(latest_only=True).count() == 7
    assert t.read().count() == 12


def test_empty_append_not_committed(spark, lake):
    root, ledger = lake
    t = LakeTable(spark, ledger, root, "raw", "e", "db", "s")
    assert t.append(spark.range(0), "2024-03-08") == 0
    assert t.read() is None


def test_text_sink_python_tuples(spark):
    path = scratch_dir(spark, "text") + "/out"
    rows = spark.createDataFrame([("oak", 17), ("birch", 4200), ("it's", 3), (None, 1)], "tree string, n int")
    n, written = count_and_save_text(rows, path)
    assert (n, written) == (4, True)
    lines = sorted(r.value for r in spark.read.text(path).collect())
    assert lines == sorted([repr(("oak", 17)), repr(("birch", 4200)), repr(("it's", 3)), repr((None, 1))])
    # existing path: logged and swallowed
    assert write_text(rows, path) is False


def test_csv_header_and_inference(spark):
    path = scratch_dir(spark, "csv") + "/t"
    spark.createDataFrame([(1, 5.1, "a"), (2, 4.9, "b")], "Id int, x double, s string") \
        .coalesce(1).write.option("header", True).csv(path)
    df = read_csv(spark, path)
    assert dict(df.dtypes) == {"Id": "int", "x": "double", "s": "string"}
    assert os.path.isdir(path.replace("file:", ""))
