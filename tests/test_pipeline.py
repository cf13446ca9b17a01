"""Decision tables of extract (I1) and promote (I2), traps, and the golden
scenario: 4/4/9 rows -> one new order -> warehouse 4 then 5."""

import pytest
from pyspark.sql import functions as F

from conftest import CUSTOMERS, CUSTOMERS_SCHEMA, NEW_ORDER, ORDERS, ORDERS_SCHEMA, PRODUCTS, PRODUCTS_SCHEMA
from lakezones.functions import ERROR_STATUS, SUCCESS_STATUS
from lakezones.operators.ledger import Ledger
from lakezones.plans import runs
from lakezones.plans.extract import extract_table, run_extract
from lakezones.plans.promote import promote_table, run_promote
from lakezones.plans.transform_load import DimTable, TransformLoad, WideTable
from lakezones.sources.files import FrameSource
from lakezones.sources.lake import LakeTable
from lakezones.specs import ContractError, load_specs

CONTRACTS = {"full_load": {
    "customers": {"primary_key": "id", "required_columns": ["first_name", "last_name", "email"],
                  "make_created_at": True, "make_updated_at": True},
    "orders": {"primary_key": "id", "required_columns": ["order_date", "purchaser", "quantity", "product_id"],
               "make_created_at": True, "make_updated_at": True},
    "products": {"primary_key": "id", "required_columns": ["name", "description", "weight"],
                 "make_created_at": True, "make_updated_at": True},
}}
SPECS = load_specs(CONTRACTS)
D1, D2, D3 = "2024-03-08", "2024-03-09", "2024-03-10"


def _extract(spark, lake, rows, schema, table="orders", day=D1, **kw):
    root, ledger = lake
    src = FrameSource(table, spark.createDataFrame(rows, schema))
    return extract_table(spark, root, ledger, src, SPECS[table], db_name="inv", schema="s", run_date=day, **kw)


def _raw(spark, lake, table="orders", zone="raw"):
    root, ledger = lake
    return LakeTable(spark, ledger, root, zone, table, "inv", "s")


def test_empty_source_writes_nothing(spark, lake):
    out = _extract(spark, lake, [], ORDERS_SCHEMA)
    assert out.kind == runs.SKIPPED_EMPTY
    assert lake[1].frame().count() == 0


def test_contract_violation_raises(spark, lake):
    root, ledger = lake
    src = FrameSource("orders", spark.createDataFrame([(1, 2)], "id int, quantity int"))
    with pytest.raises(ContractError):
        extract_table(spark, root, ledger, src, SPECS["orders"], db_name="inv", schema="s", run_date=D1)


def test_first_load_then_increment(spark, lake):
    out = _extract(spark, lake, ORDERS, ORDERS_SCHEMA)
    assert (out.kind, out.rows_written, out.last_row_number) == (runs.WRITTEN, 4, 4)
    raw = _raw(spark, lake).read()
    assert raw.columns == ["id", "order_date", "purchaser", "quantity", "product_id", "ROW_NUMBER", "CREATED_AT",
                           "UPDATED_AT"]
    assert sorted(r["ROW_NUMBER"] for r in raw.collect()) == [1, 2, 3, 4]
    # unchanged data on a new day: nothing (the reference writes all rows again,
    # because its diff includes the run-date column)
    out = _extract(spark, lake, ORDERS, ORDERS_SCHEMA, day=D2)
    assert out.kind == runs.NO_CHANGES
    # one new order: only that row
    out = _extract(spark, lake, ORDERS + [NEW_ORDER], ORDERS_SCHEMA, day=D2)
    assert (out.kind, out.rows_written, out.last_row_number) == (runs.WRITTEN, 1, 5)
    new = _raw(spark, lake).read(job_date=D2).collect()
    assert [(r["id"], r["ROW_NUMBER"], r["UPDATED_AT"]) for r in new] == [(10005, 5, D2)]
    ledger = lake[1]
    assert ledger.watermark(zone="raw", db_name="inv", table_name="orders") == 5
    assert ledger.count_runs(zone="raw", table_name="orders", status=SUCCESS_STATUS) == 2


def test_legacy_compare_sees_every_row_changed(spark, lake):
    _extract(spark, lake, ORDERS, ORDERS_SCHEMA)
    out = _extract(spark, lake, ORDERS, ORDERS_SCHEMA, day=D2, legacy=True, base="committed")
    assert (out.kind, out.rows_written) == (runs.WRITTEN, 4)


def test_source_shrank_writes_nothing(spark, lake):
    _extract(spark, lake, ORDERS, ORDERS_SCHEMA)
    out = _extract(spark, lake, ORDERS[:2], ORDERS_SCHEMA, day=D2)
    assert out.kind == runs.SOURCE_SHRANK
    assert lake[1].frame().count() == 1


def test_reverted_row_found_only_against_current_state(spark, lake):
    changed = [ORDERS[0][:3] + (9,) + ORDERS[0][4:]] + ORDERS[1:]
    _extract(spark, lake, ORDERS, ORDERS_SCHEMA, day=D1)
    assert _extract(spark, lake, changed, ORDERS_SCHEMA, day=D2).rows_written == 1
    out = _extract(spark, lake, ORDERS, ORDERS_SCHEMA, day=D3)
    assert (out.kind, out.rows_written) == (runs.WRITTEN, 1)
    # the same history diffed against all committed batches misses it
    root2 = (lake[0] + "-b", lake[1].__class__(spark, lake[0] + "-b/_ledger"))
    _extract(spark, root2, ORDERS, ORDERS_SCHEMA, day=D1)
    _extract(spark, root2, changed, ORDERS_SCHEMA, day=D2, base="committed")
    assert _extract(spark, root2, ORDERS, ORDERS_SCHEMA, day=D3, base="committed").kind == runs.NO_CHANGES


def test_write_failure_logs_complete_error_row(spark, lake):
    root, ledger = lake

    class Broken(FrameSource):
        def read(self, spark):
            df = spark.createDataFrame(ORDERS, ORDERS_SCHEMA)
            # fails at run time, during the write
            return df.withColumn("quantity", F.expr("assert_true(quantity < 0)").cast("int"))

    out = extract_table(spark, root, ledger, Broken("orders", None), SPECS["orders"], db_name="inv", schema="s",
                        run_date=D1)
    assert out.kind == runs.ERROR
    row = ledger.frame().first()
    assert row["status"] == ERROR_STATUS and row["last_row_number"] == 4
    assert "error_message" in row["details"] and row["job_end"] is not None


def test_single_table_and_unknown(spark, lake):
    root, ledger = lake
    sources = {"orders": FrameSource("orders", spark.createDataFrame(ORDERS, ORDERS_SCHEMA))}
    outs = run_extract(spark, root, ledger, sources, SPECS, db_name="inv", schema="s", run_date=D1,
                       single_table="orders")
    assert [o.table for o in outs] == ["orders"]
    with pytest.raises(ContractError):
        run_extract(spark, root, ledger, sources, SPECS, db_name="inv", schema="s", run_date=D1, single_table="x")


def test_promote_first_incremental_and_rerun(spark, lake):
    root, ledger = lake
    _extract(spark, lake, ORDERS, ORDERS_SCHEMA)
    outs = promote_table(spark, root, ledger, db_name="inv", schema="s", table_name="orders", job_date=D1,
                         primary_key=("id",))
    assert [(o.kind, o.rows_written, o.last_row_number) for o in outs] == [(runs.WRITTEN, 4, 4)]
    # re-run: nothing pending
    assert promote_table(spark, root, ledger, db_name="inv", schema="s", table_name="orders", job_date=D1) == []
    _extract(spark, lake, ORDERS + [NEW_ORDER], ORDERS_SCHEMA)
    outs = run_promote(spark, root, ledger, db_name="inv", schema="s", job_date=D1, primary_keys={"orders": ["id"]})
    assert [(o.kind, o.rows_written, o.last_row_number) for o in outs] == [(runs.WRITTEN, 1, 5)]
    staged = _raw(spark, lake, zone="staging").read()
    assert staged.count() == 5
    row = ledger.runs(zone="staging", status=SUCCESS_STATUS).orderBy("job_end").collect()[-1]
    assert row["last_row_number"] == 5 and "source_path" in row["details"]


def _golden_extract(spark, lake, orders):
    root, ledger = lake
    data = {"customers": (CUSTOMERS, CUSTOMERS_SCHEMA), "orders": (orders, ORDERS_SCHEMA),
            "products": (PRODUCTS, PRODUCTS_SCHEMA)}
    sources = {t: FrameSource(t, spark.createDataFrame(rows, schema)) for t, (rows, schema) in data.items()}
    ext = run_extract(spark, root, ledger, sources, SPECS, db_name="inv", schema="s", run_date=D1)
    pro = run_promote(spark, root, ledger, db_name="inv", schema="s", job_date=D1,
                      primary_keys={t: ["id"] for t in data})
    return ext, pro


def _normalize_job(spark, lake):
    root, ledger = lake
    return WideTable(spark, root, ledger, db_name="inv", schema="s", output_table="orders_flat", fact="orders",
                     fact_columns=["id", "order_date", "quantity", "product_id"],
                     dims=[DimTable("customers", "purchaser", "id", ["first_name", "last_name", "email"]),
                           DimTable("products", "product_id", "id")])


def test_golden_scenario(spark, lake):
    ext, pro = _golden_extract(spark, lake, ORDERS)
    assert sorted((o.table, o.rows_written) for o in ext) == [("customers", 4), ("orders", 4), ("products", 9)]
    assert sorted((o.table, o.rows_written) for o in pro) == [("customers", 4), ("orders", 4), ("products", 9)]
    job = _normalize_job(spark, lake)
    out = job.load(D1)
    assert (out.kind, out.rows_written) == (runs.WRITTEN, 4)
    wide = job.read_output("orders_flat")
    assert wide.columns == ["id", "order_date", "quantity", "product_id", "first_name", "last_name", "email", "name",
                            "description", "weight"]
    assert job.load(D1).rows_written == 4
    ext, pro = _golden_extract(spark, lake, ORDERS + [NEW_ORDER])
    assert [(o.table, o.rows_written) for o in ext if o.kind == runs.WRITTEN] == [("orders", 1)]
    assert [(o.table, o.rows_written) for o in pro if o.kind == runs.WRITTEN] == [("orders", 1)]
    assert job.load(D1).rows_written == 5
    assert job.read_output("orders_flat").count() == 5
    row = lake[1].runs(zone="warehouse").orderBy("job_end").collect()[-1]
    assert (row["action"], row["zone"], row["last_row_number"]) == ("transform", "warehouse", 5)


def test_transform_error_row(spark, lake):
    root, ledger = lake

    class Failing(TransformLoad):
        def transform(self, **kwargs):
            raise ValueError("no input")

    out = Failing(spark, root, ledger, db_name="inv").load(D1)
    assert out.kind == runs.ERROR
    row = ledger.frame().first()
    assert (row["status"], row["table_name"], row["last_row_number"]) == (ERROR_STATUS, "", 0)


def test_compaction_bounds_the_diff_base(spark, lake):
    root, ledger = lake
    changed = [ORDERS[0][:3] + (9,) + ORDERS[0][4:]] + ORDERS[1:]
    _extract(spark, lake, ORDERS, ORDERS_SCHEMA, day=D1)
    _extract(spark, lake, changed, ORDERS_SCHEMA, day=D2)
    raw = _raw(spark, lake)
    assert raw.compact(D2, ["id"]) == 4
    snapshot, after = ledger.snapshot_and_after(zone="raw", db_name="inv", table_name="orders")
    assert snapshot is not None and after == []
    # plain reads still list appended versions only, never the snapshot
    assert raw.read().count() == 5
    assert ledger.watermark(zone="raw", db_name="inv", table_name="orders", action="extract") == 4
    # the reverted row is still found against snapshot + newer batches
    out = _extract(spark, lake, ORDERS, ORDERS_SCHEMA, day=D3)
    assert (out.kind, out.rows_written) == (runs.WRITTEN, 1)
    snapshot2, after2 = ledger.snapshot_and_after(zone="raw", db_name="inv", table_name="orders")
    assert snapshot2 == snapshot and len(after2) == 1
    # compaction batches are never promoted
    outs = promote_table(spark, root, ledger, db_name="inv", schema="s", table_name="orders", job_date=D2,
                         primary_key=("id",))
    assert [o.rows_written for o in outs] == [1]  # the changed row only; the snapshot is skipped


def test_wide_table_versions_or_current_state(spark, lake):
    """Appended versions stay (the reference's joins see both); current=True
    joins the newest version per key."""
    _golden_extract(spark, lake, ORDERS)
    changed = [ORDERS[0][:3] + (7,) + ORDERS[0][4:]] + ORDERS[1:]
    _golden_extract(spark, lake, changed)
    job = _normalize_job(spark, lake)
    assert job.load(D1).rows_written == 5
    root, ledger = lake
    current = WideTable(spark, root, ledger, db_name="inv", schema="s", output_table="normalize_current",
                        fact="orders", fact_key=["id"], current=True,
                        fact_columns=["id", "order_date", "quantity", "product_id"],
                        dims=[DimTable("customers", "purchaser", "id", ["first_name", "last_name", "email"], ["id"]),
                              DimTable("products", "product_id", "id", primary_key=["id"])])
    assert current.load(D1).rows_written == 4
    q = {r["id"]: r["quantity"] for r in current.read_output("normalize_current").collect()}
    assert q[10001] == 7
    # after compacting staging the current state comes from the snapshot: same table
    assert LakeTable(spark, ledger, root, "staging", "orders", "inv", "s").compact(D1, ["id"]) == 4
    assert current.load(D1).rows_written == 4
    q = {r["id"]: r["quantity"] for r in current.read_output("normalize_current").collect()}
    assert q[10001] == 7 and len(q) == 4


def test_row_number_max_observed_during_write(spark, lake):
    """The extract logs the batch's highest row number (observed while
    writing), and promotion uses it; a ledger row without it still promotes
    by scanning the batch."""
    import json

    root, ledger = lake
    _extract(spark, lake, ORDERS, ORDERS_SCHEMA)
    _extract(spark, lake, ORDERS + [NEW_ORDER], ORDERS_SCHEMA, day=D1)  # diff: only the new order, number 5
    tops = [json.loads(r["details"])["max_row_number"] for r in
            ledger.runs(zone="raw", table_name="orders").orderBy("job_end").collect()]
    assert tops == [4, 5]
    outs = promote_table(spark, root, ledger, db_name="inv", schema="s", table_name="orders", job_date=D1,
                         primary_key=("id",))
    assert [(o.kind, o.rows_written, o.last_row_number) for o in outs] == [(runs.WRITTEN, 4, 4),
                                                                            (runs.WRITTEN, 1, 5)]
    # a batch appended without the observed maximum: promotion scans it
    t = _raw(spark, lake)
    late = spark.createDataFrame([(10009, None, 1, 1, 1, 7)], ORDERS_SCHEMA + ", ROW_NUMBER long")
    t.append(late, D1)
    outs = promote_table(spark, root, ledger, db_name="inv", schema="s", table_name="orders", job_date=D1,
                         primary_key=("id",))
    assert [(o.kind, o.last_row_number) for o in outs] == [(runs.WRITTEN, 7)]


def test_extract_numbers_like_the_global_window(spark, lake):
    """A composite key whose first column is hot for a third of the rows: the
    numbers equal row_number() over the key."""
    from pyspark.sql import Window

    from lakezones.specs import TableSpec

    root, ledger = lake
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    src = orders.withColumn("region", F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_orderkey")))
    spec = TableSpec("orders", required_columns=("o_custkey",), primary_key=("region", "o_orderkey"))
    out = extract_table(spark, root, ledger, FrameSource("orders", src), spec, db_name="tpch", schema="s", run_date=D1)
    assert out.kind == runs.WRITTEN
    got = {(r["o_orderkey"], r["ROW_NUMBER"]) for r in
           LakeTable(spark, ledger, root, "raw", "orders", "tpch", "s").read().collect()}
    w = Window.orderBy("region", "o_orderkey")
    assert got == {(r[0], r[1]) for r in src.select("o_orderkey", F.row_number().over(w)).collect()}


@pytest.mark.parametrize("duplicate_key", [False, True])
def test_incremental_extract_numbers_only_the_key(spark, lake, monkeypatch, duplicate_key):
    """Increment of a keyed table: the diff runs on unnumbered rows and only
    the key is numbered (joined back), when the key is unique; with a
    duplicated key the rows are numbered whole.  Either way the batch holds
    the changed rows with their global row numbers, and the same snapshot
    once more adds nothing."""
    from pyspark.sql import Window

    from lakezones.plans import extract as extract_mod
    from lakezones.specs import TableSpec

    taken = []
    real = extract_mod.attach_row_numbers
    monkeypatch.setattr(extract_mod, "attach_row_numbers", lambda *a, **k: taken.append(1) or real(*a, **k))
    root, ledger = lake
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    old = orders.filter(F.col("o_orderkey") % 7 != 0).withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 11 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    new = orders
    if duplicate_key:
        new = orders.unionByName(orders.filter(F.col("o_orderkey") % 7 == 0).limit(1)
                                 .withColumn("o_orderstatus", F.lit("Z")))
    spec = TableSpec("orders", required_columns=("o_custkey",), primary_key=("o_orderkey",))
    for frame, day in ((old, D1), (new, D2)):
        out = extract_table(spark, root, ledger, FrameSource("orders", frame), spec, db_name="tpch", schema="s",
                            run_date=day)
        assert out.kind == runs.WRITTEN
    assert bool(taken) == (not duplicate_key)
    again = extract_table(spark, root, ledger, FrameSource("orders", new), spec, db_name="tpch", schema="s", run_date=D2)
    assert again.kind == runs.NO_CHANGES
    got = LakeTable(spark, ledger, root, "raw", "orders", "tpch", "s").read(job_date=D2)
    cols = orders.columns
    numbered = new.withColumn("ROW_NUMBER", F.row_number().over(Window.orderBy("o_orderkey", "o_orderstatus")))
    exp = numbered.join(old.select(*cols), cols, "left_anti")
    assert got.count() == exp.count()
    if not duplicate_key:
        assert {tuple(r) for r in got.select(*cols, "ROW_NUMBER").collect()} == \
            {tuple(r) for r in exp.select(*cols, "ROW_NUMBER").collect()}
    assert {r["UPDATED_AT"] for r in got.collect()} == {D2}


def test_failure_while_numbering_becomes_an_error_row(spark, lake):
    """A source that breaks while its key is read for numbering (past the
    contract check) ends as a complete error row, not an escaped exception."""
    root, ledger = lake
    df = spark.createDataFrame(ORDERS, ORDERS_SCHEMA)
    broken = df.withColumn("id", F.when(F.col("id") == 10003, F.raise_error(F.lit("bad key"))).otherwise(F.col("id")))
    out = extract_table(spark, root, ledger, FrameSource("orders", broken), SPECS["orders"], db_name="inv",
                        schema="s", run_date=D1)
    assert out.kind == runs.ERROR and "bad key" in out.error
    row = ledger.runs(zone="raw", table_name="orders").first()
    assert (row["status"], row["last_row_number"]) == (ERROR_STATUS, 0)  # failed while its keys were counted


def test_source_shrank_logged_only_when_asked(spark, lake):
    import json

    from lakezones.functions import SKIPPED_STATUS

    _extract(spark, lake, ORDERS, ORDERS_SCHEMA)
    out = _extract(spark, lake, ORDERS[:2], ORDERS_SCHEMA, day=D2, log_skipped=True)
    assert out.kind == runs.SOURCE_SHRANK
    ledger = lake[1]
    row = ledger.runs(zone="raw", table_name="orders", status=SKIPPED_STATUS).first()
    assert row["last_row_number"] == 2 and json.loads(row["details"]) == {"reason": "source_shrank", "watermark": 4}
    assert ledger.watermark(zone="raw", db_name="inv", table_name="orders") == 4
    assert _raw(spark, lake).read().count() == 4  # nothing written


def test_repeated_and_null_keys_are_not_appended_again(spark, lake):
    rows = [(1, None, 1001, 1, 102), (1, None, 1001, 2, 102), (2, None, 1001, 1, 102), (None, None, 1001, 9, 101),
            (None, None, 1001, 9, 101)]
    assert _extract(spark, lake, rows, ORDERS_SCHEMA).rows_written == 5
    assert _extract(spark, lake, rows, ORDERS_SCHEMA, day=D2).kind == runs.NO_CHANGES
    changed = [*rows[:1], (1, None, 1001, 3, 102), *rows[2:]]
    out = _extract(spark, lake, changed, ORDERS_SCHEMA, day=D2)
    assert (out.kind, out.rows_written) == (runs.WRITTEN, 1)
    assert _extract(spark, lake, changed, ORDERS_SCHEMA, day=D2).kind == runs.NO_CHANGES


def test_volatile_source_that_fails_on_read(spark, lake):
    root, ledger = lake
    df = spark.createDataFrame(ORDERS, ORDERS_SCHEMA)
    lost = df.withColumn("quantity", F.raise_error(F.lit("lost jdbc://me:pw@host?password=x; user=me")).cast("int"))
    out = extract_table(spark, root, ledger, FrameSource("orders", lost, stable=False), SPECS["orders"], db_name="inv",
                        schema="s", run_date=D1)
    text = ledger.runs(zone="raw").first()["details"]
    assert out.kind == runs.ERROR and "lost" in out.error and "\tat " not in text
    assert "me:pw" not in text and "password=x" not in text


def test_ledger_is_never_empty_by_error(spark, lake, monkeypatch):
    from pyspark.errors import AnalysisException

    _extract(spark, lake, ORDERS, ORDERS_SCHEMA)
    ledger, real, calls = lake[1], Ledger._read, []

    def vanishing(self, *a):
        calls.append(1)
        if len(calls) < 2:
            raise AnalysisException("path vanished")
        return real(self, *a)

    monkeypatch.setattr(Ledger, "_read", vanishing)
    assert ledger.frame().count() == 1 and len(calls) == 2
    monkeypatch.setattr(Ledger, "_read", lambda self, *a: (_ for _ in ()).throw(AnalysisException("gone")))
    with pytest.raises(AnalysisException):
        ledger.frame()
