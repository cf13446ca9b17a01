"""Schemas that change, typed contracts, key buckets, promotion in one pass, many tables at once."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import CUSTOMERS, CUSTOMERS_SCHEMA, ORDERS, ORDERS_SCHEMA, SF_SMALL
from lakezones.change_queries import FAULTY_SPEC, faulty_orders
from lakezones.functions import ERROR_STATUS, SUCCESS_STATUS
from lakezones.operators.contracts import contract_profile, split_broken
from lakezones.operators.keyed_state import BucketedState, bucket_digests, bucket_of, changed_by_state, moved_buckets, write_bucketed
from lakezones.operators.ledger import Ledger
from lakezones.operators.schemas import SchemaChangeError, common_type, conform, merge_schemas
from lakezones.plans import promote, runs
from lakezones.plans.extract import extract_table, run_extract
from lakezones.plans.promote import promote_table
from lakezones.session import scratch_dir
from lakezones.sources.files import CsvSource, FrameSource
from lakezones.sources.lake import LakeTable
from lakezones.specs import QUARANTINE, ContractError, TableSpec, load_specs

D1, D2, D3 = "2024-03-08", "2024-03-09", "2024-03-10"
SPEC = TableSpec("t", required_columns=("id",), primary_key=("id",))


def ddl(text):
    return StructType.fromDDL(text)


def extract(spark, lake, rows, schema, day, spec=SPEC):
    source = FrameSource(spec.name, spark.createDataFrame(rows, schema))
    return extract_table(spark, *lake, source, spec, db_name="inv", schema="s", run_date=day)


def raw(spark, lake, spec=SPEC, zone="raw"):
    return LakeTable(spark, lake[1], lake[0], zone, spec.name, "inv", "s", renames=spec.renames, fill=spec.fill)


@pytest.mark.parametrize("a,b,common", [
    ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("int", "double", "double"), ("smallint", "float", "float"),
    ("float", "double", "double"), ("int", "decimal(4,2)", "decimal(12,2)"), ("decimal(5,1)", "decimal(4,3)", "decimal(7,3)"),
    ("date", "timestamp_ntz", "timestamp_ntz"), ("void", "string", "string"), ("array<int>", "array<int>", "array<int>"),
    ("bigint", "double", None), ("int", "float", None), ("string", "int", None), ("decimal(38,0)", "decimal(4,2)", None),
    ("date", "timestamp", None), ("array<int>", "array<bigint>", None), ("boolean", "int", None)])
def test_common_types(spark, a, b, common):
    x, y = ddl(f"c {a}")["c"].dataType, ddl(f"c {b}")["c"].dataType
    want = None if common is None else ddl(f"c {common}")["c"].dataType
    assert common_type(x, y) == want == common_type(y, x)


def test_merge_and_conform(spark):
    merged = merge_schemas([ddl("a int, b string"), ddl("b string, a bigint, c date")])
    assert merged.simpleString() == "struct<a:bigint,b:string,c:date>"
    with pytest.raises(SchemaChangeError, match="t.a"):
        merge_schemas([ddl("a int"), ddl("a string")], "t")
    rows = spark.createDataFrame([(1, "x", 2)], "a int, old string, gone int")
    out = conform(rows, merged, {"old": "b"}, {"c": dt.date(2024, 1, 2)})
    assert out.schema.simpleString() == merged.simpleString()
    assert [tuple(r) for r in out.collect()] == [(1, "x", dt.date(2024, 1, 2))]
    assert conform(out, out.schema) is out


def test_columns_come_grow_go_and_turn(spark, lake):
    assert extract(spark, lake, [(1, 5), (2, 6)], "id int, v int", D1).kind == runs.WRITTEN
    # a wider type and a new column that has no values: nothing changed
    assert extract(spark, lake, [(1, 5, None), (2, 6, None)], "id bigint, v bigint, w string", D2).kind == runs.NO_CHANGES
    assert extract(spark, lake, [(1, 5, None), (2, 6, "x")], "id bigint, v bigint, w string", D2).rows_written == 1
    # narrower again, and a column is gone: only its lost value is a change
    out = extract(spark, lake, [(1, 5), (2, 6)], "id int, v int", D3)
    assert (out.kind, out.rows_written) == (runs.WRITTEN, 1)
    out = extract(spark, lake, [(1, 5.5), (2, 6.0)], "id int, v string", "2024-03-11")
    assert out.kind == runs.ERROR and "v is" in out.error
    table = raw(spark, lake).read(with_batch_columns=True)
    assert dict(table.dtypes) | {"id": "bigint", "v": "bigint", "w": "string", "ingest_date": "date"} == dict(table.dtypes)
    assert sorted(tuple(r) for r in table.select("id", "v", "w", "ROW_NUMBER").na.fill("-").collect()) == [
        (1, 5, "-", 1), (2, 6, "-", 2), (2, 6, "-", 2), (2, 6, "x", 2)]
    assert lake[1].count_runs(status=ERROR_STATUS) == 1
    assert extract(spark, lake, [(1, 5), (2, 7)], "id int, v int", "2024-03-12").rows_written == 1


def test_batches_of_one_schema_are_one_scan(spark, lake):
    for day, v in ((D1, 1), (D2, 2), (D3, 3)):
        extract(spark, lake, [(1, v)], "id int, v int", day)
    plan = raw(spark, lake).read()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan


def test_batches_without_a_recorded_schema_are_read(spark, lake):
    root, ledger = lake
    t = raw(spark, lake)
    path, run_id = t.new_batch_path(D1)
    spark.createDataFrame([(1, 5, 1)], "id int, v int, ROW_NUMBER long").write.parquet(path)
    now = dt.datetime(2024, 3, 8)
    ledger.record(db_name="inv", table_name="t", action="extract", zone="raw", status=SUCCESS_STATUS, last_row_number=1,
                  details={"sink_path": path}, job_date=D1, job_start=now, job_end=now, run_id=run_id)
    assert extract(spark, lake, [(1, 5, "x"), (2, 6, "y")], "id bigint, v int, w string", D2).rows_written == 2
    assert sorted(tuple(r) for r in t.read().select("id", "w").na.fill("-").collect()) == [(1, "-"), (1, "x"), (2, "y")]


def test_rename_fill_and_promotion_of_two_schemas(spark, lake):
    spec = TableSpec("t", required_columns=("id", "v"), primary_key=("id",), renames={"old": "v"}, fill={"w": "none"})
    extract(spark, lake, [(1, 5), (2, 6)], "id int, old int", D1, spec)
    out = extract(spark, lake, [(1, 5, "none"), (2, 7, "none")], "id int, v bigint, w string", D1, spec)
    assert out.rows_written == 1
    outs = promote_table(spark, *lake, db_name="inv", schema="s", table_name="t", job_date=D1, primary_key=("id",),
                         renames=spec.renames, fill=spec.fill)
    assert [o.rows_written for o in outs] == [2, 1]
    staged = raw(spark, lake, spec, "staging").read()
    assert sorted(tuple(r) for r in staged.select("id", "v", "w").collect()) == [(1, 5, "none"), (2, 6, "none"), (2, 7, "none")]
    extract(spark, lake, [(1, 5, "x"), (2, 7, "none")], "id int, v bigint, w string", D1, spec)
    outs = promote_table(spark, *lake, db_name="inv", schema="s", table_name="t", job_date=D1, primary_key=("id",),
                         renames=spec.renames, fill=spec.fill)
    assert [o.rows_written for o in outs] == [1]


def test_contract_profile_counts_each_reason(spark):
    rows = [("1", "2.5", "a"), ("01", "x", "b"), (None, "1", None), ("7", None, "c"), ("8", " 3 ", "d"), ("z", "1", "e")]
    df = spark.createDataFrame(rows, "id string, v string, name string")
    spec = TableSpec("t", required_columns=("id",), primary_key=("id",), unique_key=True, on_broken=QUARANTINE,
                     columns={"id": {"type": "int"}, "v": {"type": "double", "nullable": False}, "name": {"nullable": False}})
    profile = contract_profile(df, spec)
    assert (profile.rows, profile.unique) == (6, False)
    assert profile.broken == {"type:id": 1, "type:v": 1, "null:v": 1, "null:name": 1, "key:null": 1, "key:repeated": 2}
    good, broken = split_broken(df, spec, profile)
    assert [tuple(r) for r in good.collect()] == [(8, 3.0, "d")]
    assert sorted(tuple(r.reasons) for r in broken.collect()) == [
        ("key:repeated",), ("null:name", "key:null"), ("null:v",), ("type:id",), ("type:v", "key:repeated")]


def test_numbers_must_keep_their_value(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 2.5), (3, 3e9), (4, float("nan")), (5, None)], "id long, v double")
    spec = TableSpec("t", required_columns=("id",), columns={"v": {"type": "int"}}, on_broken=QUARANTINE)
    profile = contract_profile(df, spec)
    assert profile.broken == {"type:v": 3}
    assert sorted((tuple(r) for r in split_broken(df, spec, profile)[0].collect())) == [(1, 2), (5, None)]


def test_sound_frames_cost_one_aggregate(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    profile = contract_profile(orders, FAULTY_SPEC)
    assert profile.broken == {} and profile.unique and profile.rows == orders.count()


def test_broken_rows_are_kept_once_and_the_others_load(spark, lake):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    for day in (D1, D2):
        out = extract_table(spark, *lake, FrameSource("orders", faulty_orders(orders)), FAULTY_SPEC, db_name="inv", schema="s", run_date=day)
    assert out.kind == runs.NO_CHANGES
    side = raw(spark, lake, FAULTY_SPEC, "rejected").read()
    total = faulty_orders(orders).count()
    assert side.count() > 0 and side.count() + raw(spark, lake, FAULTY_SPEC).read().count() == total
    details = [r.details for r in lake[1].runs(zone="raw").collect()]
    assert len(details) == 1 and '"key:repeated"' in details[0]


def test_contract_from_yaml_shape():
    spec = load_specs({"full_load": {"t": {"required_columns": ["id"], "primary_key": "id", "unique_key": True, "on_broken": "quarantine",
                                           "columns": {"id": {"type": "bigint"}}, "fill": {"a": 1}, "renames": {"x": "y"}, "buckets": 8}}})["t"]
    assert spec.checks_rows and spec.buckets == 8 and spec.config()["renames"] == {"x": "y"}
    with pytest.raises(ContractError):
        TableSpec("t", required_columns=("a",), on_broken="ignore")
    with pytest.raises(ContractError):
        TableSpec("t", required_columns=("a",), unique_key=True)


def test_malformed_lines(spark, lake):
    path = scratch_dir(spark, "csv") + "/t"
    lines = ["1,a,2.5", "2,b", "x,c,1", '3,"d,d",4', "4,e,5,extra", "1,f,6"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    spec = TableSpec("t", required_columns=("id",), primary_key=("id",), unique_key=True, on_broken=QUARANTINE)
    source = CsvSource("t", path, "id int, name string, v double", header=False)
    out = extract_table(spark, *lake, source, spec, db_name="inv", schema="s", run_date=D1)
    assert (out.kind, out.rows_written, out.last_row_number) == (runs.WRITTEN, 1, 6)
    assert [r.name for r in raw(spark, lake, spec).read().collect()] == ["d,d"]
    side = {r.row: r.reasons for r in raw(spark, lake, spec, "rejected").read().collect()}
    assert {k: v for k, v in side.items() if v == ["malformed"]}.keys() == {"2,b", "x,c,1", "4,e,5,extra"}
    assert sum(v == ["key:repeated"] for v in side.values()) == 2


@pytest.fixture()
def state(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    path = scratch_dir(spark, "state") + "/batch_id=b1"
    write_bucketed(orders, path, ["o_orderkey"], 16)
    return orders, BucketedState(spark, path, orders.schema, ["o_orderkey"], 16)


def test_a_bucketed_state_is_not_shuffled(spark, state):
    orders, stored = state
    off = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in off:
        spark.conf.set(k, "-1")
    try:
        with stored:
            changed = changed_by_state(orders.withColumn("o_totalprice", F.col("o_totalprice") + 1), stored.rows(), None, orders.columns, ["o_orderkey"])
            plan = changed._jdf.queryExecution().executedPlan().toString()
            assert changed.count() == orders.count()
    finally:
        for k, v in off.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan  # the new side only


def test_one_changed_key_reads_one_file_of_the_state(spark, state):
    orders, stored = state
    assert len(stored.files(range(16))) == 16
    newest = orders.agg(F.max("o_orderkey")).first()[0]
    before = bucket_digests(orders, orders.columns, ["o_orderkey"], 16)
    changed = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") == newest, -1.0).otherwise(F.col("o_totalprice")))
    moved = moved_buckets(bucket_digests(changed.repartition(5), orders.columns, ["o_orderkey"], 16), before)
    assert len(moved) == 1 and len(stored.rows_of(moved).inputFiles()) == 1
    assert stored.rows_of(moved).where(f"o_orderkey = {newest}").count() == 1
    with stored:
        assert stored.rows_of(moved).exceptAll(stored.rows().where(bucket_of(["o_orderkey"], 16).isin(moved))).isEmpty()


def test_digests_see_nulls_copies_and_signs(spark):
    def digest(rows):
        return bucket_digests(spark.createDataFrame(rows, "k int, a string, b string, v double"), ["k", "a", "b", "v"], ["k"], 2)

    base = [(1, "x", None, 0.0), (2, None, None, None), (3, "y", "z", 1.0)]
    assert moved_buckets(digest(base[::-1]), digest(base)) == []
    assert moved_buckets(digest([(1, "x", None, -0.0), *base[1:]]), digest(base)) == []
    for other in ([(1, None, "x", 0.0), *base[1:]], [*base, base[0]], [(1, "x", None, None), *base[1:]]):
        assert len(moved_buckets(digest(other), digest(base))) == 1


def test_unchanged_snapshots_read_nothing_and_stale_digests_are_not_used(spark, lake, monkeypatch):
    spec = TableSpec("t", required_columns=("id",), primary_key=("id",), buckets=4)
    plain = TableSpec("t", required_columns=("id",), primary_key=("id",))
    rows = [(i, i * 2) for i in range(50)]
    extract(spark, lake, rows, "id int, v int", D1, spec)
    monkeypatch.setattr(LakeTable, "read_paths", lambda *a, **k: pytest.fail("the lake was read"))
    assert extract(spark, lake, rows, "id int, v int", D2, spec).kind == runs.NO_CHANGES
    monkeypatch.undo()
    changed = [(0, 99), *rows[1:]]
    assert extract(spark, lake, changed, "id int, v int", D2, plain).rows_written == 1  # keeps no digests
    assert extract(spark, lake, rows, "id int, v int", D3, spec).rows_written == 1      # so the return is seen
    raw(spark, lake, spec).compact(D3, ("id",), 4)
    assert extract(spark, lake, changed, "id int, v int", D3, spec).rows_written == 1
    assert extract(spark, lake, rows + [(60, 1)], "id int, v int", D3, spec).rows_written == 2
    assert extract(spark, lake, rows + [(60, 1)], "id int, v int", D3, spec).kind == runs.NO_CHANGES
    # a wider key has other buckets: everything is compared
    assert extract(spark, lake, rows + [(60, 2)], "id bigint, v int", D3, spec).rows_written == 1


LINES = [(1, "a"), (1, "a"), (1, "b"), (None, "n"), (None, "n"), (2, "c")]


def test_pending_batches_with_repeated_keys_in_one_pass(spark, lake, monkeypatch):
    def promoted():
        return promote_table(spark, *lake, db_name="inv", schema="s", table_name="t", job_date=D1, primary_key=("id",))

    extract(spark, lake, LINES, "id int, v string", D1)
    assert [o.rows_written for o in promoted()] == [6]
    rows = list(LINES)
    for more in ([(1, "d"), (1, "d")], [(1, "e"), (None, "o")], [(3, "f")]):
        rows += more
        assert extract(spark, lake, rows, "id int, v string", D1).rows_written == len(more)
    reads, read = [], LakeTable.read

    def counted(self, *a, **k):
        reads.append(self.zone)
        return read(self, *a, **k)

    monkeypatch.setattr(LakeTable, "read", counted)
    assert [o.rows_written for o in promoted()] == [2, 2, 1]
    assert reads == ["staging"]
    assert promoted() == []


def test_a_ledger_that_fails_half_way_leaves_one_row_a_batch(spark, lake, monkeypatch):
    for v in (1, 2, 3):
        extract(spark, lake, [(1, v)], "id int, v int", D1)
    root, ledger = lake
    record, calls = Ledger.record, []

    def failing(self, **kw):
        if kw["zone"] == "staging" and kw["status"] == SUCCESS_STATUS:
            calls.append(1)
            if len(calls) == 2:
                raise OSError("ledger is away")
        return record(self, **kw)

    monkeypatch.setattr(Ledger, "record", failing)
    outs = promote_table(spark, root, ledger, db_name="inv", schema="s", table_name="t", job_date=D1, primary_key=("id",))
    assert [o.kind for o in outs] == [runs.WRITTEN, runs.ERROR, runs.ERROR]
    monkeypatch.undo()
    staged = ledger.runs(zone="staging").collect()
    assert sorted(r.status for r in staged) == sorted([SUCCESS_STATUS, ERROR_STATUS, ERROR_STATUS])
    outs = promote_table(spark, root, ledger, db_name="inv", schema="s", table_name="t", job_date=D1, primary_key=("id",))
    assert [o.rows_written for o in outs] == [1, 1]
    assert raw(spark, lake, zone="staging").read().count() == 3


def test_many_tables_at_once_leave_the_same_ledger(spark, lake):
    specs = {f"t{i}": TableSpec(f"t{i}", required_columns=("id",), primary_key=("id",)) for i in range(8)}
    sources = {n: FrameSource(n, spark.range(i + 1).select("id")) for i, n in enumerate(specs)}
    root, _ = lake
    seen = set()

    class Watched(FrameSource):
        def read(self, s):
            seen.add((threading.current_thread().name, s.sparkContext.getLocalProperty("spark.scheduler.pool")))
            return super().read(s)

    watched = {n: Watched(n, s.frame) for n, s in sources.items()}
    rows = []
    for label, used, parallel in (("a", sources, 1), ("b", watched, 4)):
        ledger = Ledger(spark, f"{root}-{label}/_ledger")
        outs = run_extract(spark, f"{root}-{label}", ledger, used, specs, db_name="inv", schema="s", run_date=D1, parallel=parallel)
        assert [o.table for o in outs] == list(specs)
        promote.run_promote(spark, f"{root}-{label}", ledger, db_name="inv", schema="s", job_date=D1, specs=specs, parallel=parallel)
        rows.append(sorted(map(tuple, ledger.frame().select("zone", "table_name", "status", "last_row_number").collect())))
    assert rows[0] == rows[1] and len(rows[0]) == 16
    assert {pool for _, pool in seen} == set(specs) and 1 < len({t for t, _ in seen}) <= 4
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_a_broken_contract_does_not_stop_tables_beside_it(spark, lake):
    specs = {"customers": TableSpec("customers", required_columns=("nope",)), "orders": TableSpec("orders", required_columns=("id",))}
    sources = {"customers": FrameSource("customers", spark.createDataFrame(CUSTOMERS, CUSTOMERS_SCHEMA)),
               "orders": FrameSource("orders", spark.createDataFrame(ORDERS, ORDERS_SCHEMA))}
    with pytest.raises(ContractError):
        run_extract(spark, *lake, sources, specs, db_name="inv", schema="s", run_date=D1, parallel=2)
    assert [r.table_name for r in lake[1].frame().collect()] == ["orders"]
