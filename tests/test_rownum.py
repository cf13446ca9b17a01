from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakezones.operators.rownum import attach_row_numbers, dense_row_number, key_profile


def _expected(df, cols):
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in cols])
    return {tuple(r) for r in df.withColumn("ROW_NUMBER", F.row_number().over(w)).collect()}


def test_equals_global_window(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    want = _expected(orders, ["o_orderkey"])
    for unique in (False, True):
        assert {tuple(r) for r in dense_row_number(orders, ["o_orderkey"], unique=unique).collect()} == want


def test_independent_of_partitioning(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_totalprice")
    a = {tuple(r) for r in dense_row_number(orders, ["o_orderkey"]).collect()}
    b = {tuple(r) for r in dense_row_number(orders.repartition(13), ["o_orderkey"], unique=True).collect()}
    assert a == b
    nums = sorted(r[-1] for r in a)
    assert nums == list(range(1, len(nums) + 1))


def test_nulls_first_timestamps_and_text(spark):
    rows = [(None, "a"), (5, "b"), (-3, "c"), (10, "d"), (None, "e")]
    df = spark.createDataFrame(rows, "k int, v string")
    assert {tuple(r) for r in dense_row_number(df, ["k", "v"]).collect()} == _expected(df, ["k", "v"])
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "ts")
    assert {tuple(r) for r in dense_row_number(ev, ["ts"]).collect()} == _expected(ev, ["ts"])
    cust = spark.read.parquet(f"{SF_SMALL}/customer.parquet").select("c_name", "c_custkey")
    assert {tuple(r) for r in dense_row_number(cust, ["c_name"]).collect()} == _expected(cust, ["c_name"])


def test_empty_and_single_value(spark):
    df = spark.range(50).select(F.lit(1).alias("k"), F.col("id"))
    assert sorted(r["ROW_NUMBER"] for r in dense_row_number(df, ["k", "id"]).collect()) == list(range(1, 51))
    assert dense_row_number(df.where("false"), ["k"]).collect() == []


def _largest_share(numbered, n):
    """Share of the rows in the fullest partition of the checkpointed exchange."""
    most = numbered.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    return most / n


def test_no_task_holds_a_hot_value(spark):
    """A third of the rows share the leading value, a third are null, and a third are copies of one
    row: no partition of the numbered rows holds more than a small share."""
    n = 6000
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id"))
        df = spark.range(n).select(hot.alias("a"), F.col("id").alias("b"))
        got = dense_row_number(df, ["a", "b"])
        assert {tuple(r) for r in got.collect()} == _expected(df, ["a", "b"])
        assert _largest_share(got, n) < 0.15
        copies = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
        got = dense_row_number(copies, ["k"])
        assert sorted(r["ROW_NUMBER"] for r in got.collect()) == list(range(1, n + 1))
        assert sorted(r["ROW_NUMBER"] for r in got.where("k = -1").collect()) == list(range(1, n // 3 + 1))
        assert _largest_share(got, n) < 0.15
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_key_profile_and_attached_numbers(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, v string")
    assert key_profile(df, ["k"]) == (4, False)
    assert key_profile(df, ["k", "v"]) == (4, False)
    assert key_profile(df.where("v <> 'd'"), ["k", "v"]) == (3, True)
    assert key_profile(df.where("false"), ["k"]) == (0, True)
    numbered = attach_row_numbers(df.where("v = 'b'"), df.where("v <> 'd'"), ["k", "v"])
    assert [tuple(r) for r in numbered.collect()] == [(2, "b", 2)]
