"""The command-line jobs, run in-process on the test session."""

import json

import pytest
import yaml

from lakezones.__main__ import main
from lakezones.session import scratch_dir

SF = "/root/testdata/sf0.001"


def _lines(capsys):
    return [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]


def test_extract_promote_compact_wide(spark, tmp_path, capsys):
    contracts = tmp_path / "c.yaml"
    contracts.write_text(yaml.safe_dump({"full_load": {
        "orders": {"primary_key": "o_orderkey", "required_columns": ["o_custkey", "o_totalprice"],
                   "make_created_at": True, "make_updated_at": True},
        "customer": {"primary_key": "c_custkey", "required_columns": ["c_name"],
                     "make_created_at": True, "make_updated_at": True}}}))
    root = scratch_dir(spark, "cli")
    common = ["--lake-root", root, "--db", "tpch", "--schema", "main"]
    main(["extract", *common, "--contracts", str(contracts), "--parquet-dir", SF, "--run-date", "2024-03-08"])
    outs = _lines(capsys)
    assert sorted((o["table"], o["kind"], o["rows_written"]) for o in outs) == \
        [("customer", "written", 150), ("orders", "written", 1500)]
    main(["promote", *common, "--contracts", str(contracts), "--job-date", "2024-03-08"])
    assert sorted(o["rows_written"] for o in _lines(capsys)) == [150, 1500]
    main(["compact", *common, "--contracts", str(contracts), "--run-date", "2024-03-08"])
    assert sorted(o["rows"] for o in _lines(capsys)) == [150, 1500]
    job = tmp_path / "wide.yaml"
    job.write_text(yaml.safe_dump({"output_table": "orders_wide", "fact": "orders",
                                   "fact_columns": ["o_orderkey", "o_totalprice"],
                                   "dims": [{"table": "customer", "fact_key": "o_custkey", "dim_key": "c_custkey",
                                             "columns": ["c_name"]}]}))
    main(["wide-table", *common, "--job", str(job), "--run-date", "2024-03-08"])
    out = _lines(capsys)[0]
    assert (out["kind"], out["rows_written"]) == ("written", 1500)
    main(["compact-ledger", "--lake-root", root])
    out = _lines(capsys)[0]
    assert out["runs"] == 2 + 2 + 2 + 1  # extracts, promotions, compactions, the wide table


def test_ml_commands(spark, tmp_path, capsys):
    """train, select-model and score on a CSV written from the customer table."""
    csv = scratch_dir(spark, "cli-ml") + "/customer.csv"
    spark.read.parquet(f"{SF}/customer.parquet").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment") \
        .coalesce(1).write.option("header", True).csv(csv)
    ml = ["--csv", csv, "--label", "c_mktsegment", "--features", "c_acctbal,c_nationkey", "--id", "c_custkey"]
    out_dir = scratch_dir(spark, "cli-ml") + "/predictions"
    main(["train", *ml, "--output", out_dir])
    out = _lines(capsys)[0]
    assert out["train_rows"] + out["test_rows"] == 150
    assert spark.read.parquet(out_dir).count() == out["test_rows"]
    model = scratch_dir(spark, "cli-ml") + "/model"
    main(["select-model", *ml, "--model-path", model, "--parallelism", "2"])
    sel = _lines(capsys)[0]
    assert len(sel["validation"]) == 4 and 0.0 <= sel["f1_after_reload"] <= 1.0
    score = ["score", "--csv", csv, "--id", "c_custkey", "--model-path", model]
    main([*score, "--limit", "3", "--fraction", "0.5"])
    assert _lines(capsys)[0]["scored"] == 3
    main(score)  # all rows unless a sample is asked for
    assert _lines(capsys)[0]["scored"] == 150


def test_failed_outcomes_exit_with_an_error(spark, tmp_path, capsys):
    job = tmp_path / "wide.yaml"
    job.write_text(yaml.safe_dump({"output_table": "w", "fact": "nothing", "fact_columns": ["a"], "dims": []}))
    with pytest.raises(SystemExit) as end:
        main(["wide-table", "--lake-root", scratch_dir(spark, "cli"), "--db", "d", "--schema", "s", "--job", str(job)])
    assert end.value.code == 1 and _lines(capsys)[0]["kind"] == "error"
