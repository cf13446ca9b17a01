"""Property tests (hypothesis) and a skewed-key check."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakezones.operators.changes import changed_rows, current_state, snapshot_diff
from lakezones.operators.joins import Dim, wide_join
from lakezones.operators.rownum import dense_row_number, key_profile

values = st.one_of(st.none(), st.sampled_from([0.0, -0.0, 1.5, float("nan"), 1e-300, 2.0]))
rows = st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.sampled_from(["a", "b", ""])), values),
                max_size=25)
SCHEMA = "k int, s string, x double"


def _canon(r):
    k, s, x = r
    if x is not None:
        x = "nan" if math.isnan(x) else (0.0 if x == 0 else x)  # Spark: NaN = NaN, -0.0 = 0.0
    return (k, s, x)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(new=rows, old=rows, parts=st.integers(1, 5))
def test_diff_is_set_difference(spark, new, old, parts):
    n = spark.createDataFrame(new, SCHEMA).repartition(parts)
    o = spark.createDataFrame(old, SCHEMA).select("x", "k", "s")  # other column order on purpose
    got = {_canon(tuple(r)) for r in snapshot_diff(n, o).collect()}
    assert got == {_canon(r) for r in new} - {_canon(r) for r in old}
    # old ∪ changes ⊇ new
    assert snapshot_diff(n, o.select("k", "s", "x").unionByName(snapshot_diff(n, o))).count() == 0
    # changed rows keep multiplicity
    kept = changed_rows(n, o, ["k", "s", "x"]).count()
    assert kept == sum(1 for r in new if _canon(r) not in {_canon(q) for q in old})


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(keys=st.lists(st.integers(-50, 50), unique=True, max_size=40), parts=st.integers(1, 6))
def test_row_numbers_dense_in_key_order(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "k int").repartition(parts)
    got = sorted((r.k, r.ROW_NUMBER) for r in dense_row_number(df, ["k"]).collect())
    assert got == [(k, i + 1) for i, k in enumerate(sorted(keys))]


def test_skewed_keys(spark):
    """One customer holds a third of the orders; results stay whole."""
    n = 30000
    orders = spark.range(n).select(F.col("id").alias("o_orderkey"),
                                   F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
                                   .alias("o_custkey"), (F.col("id") % 97).cast("double").alias("o_totalprice"))
    customers = spark.range(1000).select(F.col("id").alias("c_custkey"), F.format_string("c%d", "id").alias("c_name"))
    wide = wide_join(orders, [Dim(customers, "o_custkey", "c_custkey", ["c_name"])])
    assert wide.count() == n
    assert wide.filter("c_name = 'c7'").count() == orders.filter("o_custkey = 7").count() > n // 3
    # a base where a third of the rows are the same value
    base = orders.select(F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_orderkey"))
                         .alias("o_orderkey"), "o_custkey", "o_totalprice")
    assert changed_rows(orders, base, ["o_orderkey", "o_custkey", "o_totalprice"]).count() == \
        orders.filter("o_orderkey % 3 = 0 AND o_orderkey <> 0").count()
    versions = orders.select(F.lit(1).alias("k"), F.format_string("b%06d", "o_orderkey").alias("batch_id"),
                             F.col("o_orderkey").alias("ROW_NUMBER"))
    assert current_state(versions, ["k"]).first()["ROW_NUMBER"] == n - 1


keyed_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)),
                                st.one_of(st.none(), st.sampled_from(["a", "b", ""])), values), max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(new=keyed_rows, old=keyed_rows, parts=st.integers(1, 4))
def test_keyed_changes_equal_whole_row_anti_join(spark, new, old, parts):
    """For a unique, non-null key and a base unique by key (its current state),
    the key join finds exactly the rows the whole-row anti join finds."""
    new = list({r[0]: r for r in new if r[0] is not None}.values())
    n = spark.createDataFrame(new, SCHEMA).repartition(parts)
    versions = spark.createDataFrame(old, SCHEMA).withColumn("batch_id", F.lit("b1")) \
        .withColumn("ROW_NUMBER", F.monotonically_increasing_id())
    base = current_state(versions, ["k"]).select("k", "s", "x")
    cols = ["k", "s", "x"]
    def bag(df):
        return sorted((_canon(tuple(r)) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))

    assert bag(changed_rows(n, base, cols, base_unique=True, key=["k"])) == bag(changed_rows(n, base, cols))


def test_hot_keys_on_the_new_side_are_split(spark):
    """Stored tables, a third of the new rows on one key and a third null: such a key is not
    unique, so whole rows are compared, and AQE's skew split takes the hot group apart."""
    from lakezones.session import scratch_dir

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n, root = 300_000, scratch_dir(spark, "hot-keys")
        key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id"))
        spark.range(n).select(key.alias("k"), F.when(F.col("id") % 3 < 2, F.lit(1)).otherwise(F.col("id") % 1000).alias("v"),
                              (F.col("id") * 7919 % 1000003).alias("ROW_NUMBER")).write.parquet(f"{root}/new")
        spark.range(0, n, 2).select(F.col("id").alias("k"), (F.col("id") % 1000).alias("v")).write.parquet(f"{root}/base")
        new, base = spark.read.parquet(f"{root}/new"), spark.read.parquet(f"{root}/base")
        assert not key_profile(new, ["k"])[1]
        df = changed_rows(new, base, ["k", "v"])
        qe = df._jdf.queryExecution()
        qe.toRdd().count()
        assert "skew=true" in qe.executedPlan().toString()
        # every hot row, (7, 1) or (null, 1), is new; the others are new exactly for odd ids
        assert df.count() == 2 * n // 3 + n // 6
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(xs=st.lists(st.one_of(st.none(), st.integers(-10**9, 10**9).map(lambda i: i / 64)), min_size=1, max_size=12),
       flag=st.booleans())
def test_text_sink_matches_python_repr_of_numbers(spark, xs, flag):
    from lakezones.sources.lake import python_tuple_text
    from pyspark.sql.types import BooleanType, DoubleType

    xs += [1e10, 1e16, 1e15, 123456.75, 1e-4, 9.9e-5, 1.5e-7, 2.5e100, -0.0, float("inf"), -float("inf"), float("nan")]
    df = spark.createDataFrame([(flag, x) for x in xs], "b boolean, x double")
    got = sorted(r[0] for r in df.select(python_tuple_text(("b", BooleanType()), ("x", DoubleType()))).collect())
    assert got == sorted(repr((flag, x)) for x in xs)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from(list("ab'\"\\\n\r\t\x07\x7f x")), max_size=8)),
                      min_size=1, max_size=12))
def test_text_sink_matches_python_repr(spark, texts):
    """K3: the text sink formats rows like Python's repr of a tuple, for
    quotes, backslashes and control characters too."""
    from lakezones.sources.lake import python_tuple_text
    from pyspark.sql.types import IntegerType, StringType

    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "s string, n int")
    got = sorted(r[0] for r in df.select(python_tuple_text(("s", StringType()), ("n", IntegerType()))).collect())
    assert got == sorted(repr((t, i)) for i, t in enumerate(texts))
