import datetime as dt

from lakezones.operators.ledger import LEDGER_SCHEMA, watermarks_of

T0 = dt.datetime(2024, 3, 8, 10, 0, 0)


def _rec(ledger, table, status, n, path, end, zone="raw", day="2024-03-08"):
    return ledger.record(db_name="db", table_name=table, action="extract", zone=zone, status=status,
                         last_row_number=n, details={"sink_path": path}, job_date=day, job_start=T0, job_end=end)


def test_empty_ledger(spark, lake):
    _, ledger = lake
    assert ledger.frame().schema == LEDGER_SCHEMA
    assert ledger.frame().count() == 0
    assert ledger.watermark(zone="raw", db_name="db", table_name="t") == 0
    assert ledger.last_checkpoint(zone="raw", db_name="db", table_name="t") is None
    assert not ledger.exists(zone="raw", db_name="db", table_name="t", job_date="2024-03-08")
    assert ledger.committed_batches(zone="raw", db_name="db", table_name="t") == []


def test_watermark_checkpoint_and_day_lookup(spark, lake):
    _, ledger = lake
    _rec(ledger, "t", "succeed", 4, "p1", T0)
    _rec(ledger, "t", "succeed", 5, "p2", T0 + dt.timedelta(minutes=5))
    _rec(ledger, "t", "error", 99, "p3", T0 + dt.timedelta(minutes=9))
    _rec(ledger, "u", "succeed", 9, "q1", T0, day="2024-03-09")
    assert ledger.watermark(zone="raw", db_name="db", table_name="t") == 5
    assert ledger.watermark(zone="staging", db_name="db", table_name="t") == 0
    assert ledger.last_checkpoint(zone="raw", db_name="db", table_name="t") == "p2"
    assert ledger.row_number_on_date(zone="raw", db_name="db", table_name="t", job_date="2024-03-08") == 5
    assert ledger.row_number_on_date(zone="raw", db_name="db", table_name="t", job_date="2024-03-09") == 0
    assert ledger.exists(zone="raw", db_name="db", table_name="t", job_date=dt.date(2024, 3, 8))
    assert ledger.count_runs(zone="raw", table_name="t") == 3
    paths = ledger.zone_paths("raw", job_date="2024-03-08").collect()
    assert sorted(r["sink_path"] for r in paths) == ["p1", "p2"]  # error runs are not listed
    assert [p for p, _ in ledger.committed_batches(zone="raw", db_name="db", table_name="t")] == ["p1", "p2"]
    marks = {r["table_name"]: r["watermark"] for r in watermarks_of(ledger.frame()).collect()}
    assert marks == {"t": 5, "u": 9}


def test_compact_keeps_rows_and_drops_run_files(spark, lake):
    _, ledger = lake
    for i in range(3):
        _rec(ledger, "t", "succeed", i, f"p{i}", T0 + dt.timedelta(seconds=i))
    ledger.compact()
    assert ledger.frame().count() == 3
    assert ledger._glob(f"{ledger.path}/runs/*.json") == []
    _rec(ledger, "t", "succeed", 9, "p9", T0 + dt.timedelta(seconds=9))
    assert ledger.watermark(zone="raw", db_name="db", table_name="t") == 9
    ledger.compact()
    assert len(ledger._glob(f"{ledger.path}/compacted/*")) == 1
    assert ledger.frame().count() == 4
    # a crash after the snapshot but before the clean-up leaves duplicates: still counted once
    _rec(ledger, "t", "succeed", 10, "p10", T0 + dt.timedelta(seconds=10))
    snap = f"{ledger.path}/compacted/zz-copy"
    ledger.frame().coalesce(1).write.parquet(snap)
    assert ledger.count_runs(table_name="t") == 5


def test_concurrent_records(spark, lake):
    from concurrent.futures import ThreadPoolExecutor

    _, ledger = lake
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: _rec(ledger, f"t{i}", "succeed", i, f"p{i}", T0), range(8)))
    assert ledger.frame().count() == 8


def test_table_runs_answer_like_the_spark_lookups(spark, lake):
    """One history read answers what the per-question Spark aggregates answer."""
    _, ledger = lake
    _rec(ledger, "t", "succeed", 4, "p1", T0)
    _rec(ledger, "t", "error", 99, "p3", T0 + dt.timedelta(minutes=9))
    _rec(ledger, "t", "succeed", 5, "p2", T0 + dt.timedelta(minutes=5), day="2024-03-09")
    _rec(ledger, "t", "succeed", 3, "p4", T0 + dt.timedelta(minutes=7), day="2024-03-09")
    _rec(ledger, "t", "succeed", 8, "s1", T0, zone="staging")
    for zone in ("raw", "staging", "analytics"):
        runs = ledger.table_runs(zone=zone, db_name="db", table_name="t")
        kw = dict(zone=zone, db_name="db", table_name="t")
        assert runs.watermark() == ledger.watermark(**kw)
        assert runs.watermark("extract") == ledger.watermark(action="extract", **kw)
        assert runs.watermark("other") == ledger.watermark(action="other", **kw) == 0
        for day in ("2024-03-08", "2024-03-09", "2024-03-10"):
            assert runs.exists(day) == ledger.exists(job_date=day, **kw)
            assert runs.row_number_on_date(day) == ledger.row_number_on_date(job_date=day, **kw)
        assert runs.committed_batches() == ledger.committed_batches(**kw)
    assert ledger.table_runs(zone="raw", db_name="db", table_name="t").row_number_on_date("2024-03-09") == 3


def test_table_runs_add_matches_a_fresh_read(spark, lake):
    _, ledger = lake
    runs = ledger.table_runs(zone="raw", db_name="db", table_name="t")
    runs.add(_rec(ledger, "t", "succeed", 4, "p1", T0))
    runs.add(ledger.record(db_name="db", table_name="t", action="extract", zone="raw", status="succeed",
                           last_row_number=6, details={"sink_path": "p2", "source_path": "r1", "max_row_number": 6},
                           job_date="2024-03-08", job_start=T0, job_end=T0 + dt.timedelta(seconds=1)))
    fresh = ledger.table_runs(zone="raw", db_name="db", table_name="t")
    assert runs.rows == fresh.rows


def test_histories_of_several_tables_in_one_read(spark, lake):
    _, ledger = lake
    _rec(ledger, "t", "succeed", 4, "p1", T0)
    _rec(ledger, "t", "succeed", 8, "s1", T0, zone="staging")
    _rec(ledger, "u", "error", 1, "q1", T0)
    both = ledger.histories(db_name="db", tables=[("raw", "t"), ("staging", "t"), ("raw", "u"), ("raw", "none")])
    for (zone, table), runs in both.items():
        assert runs.rows == ledger.table_runs(zone=zone, db_name="db", table_name=table).rows
    assert [r["sink_path"] for r in both[("staging", "t")].rows] == ["s1"] and both[("raw", "none")].rows == []
