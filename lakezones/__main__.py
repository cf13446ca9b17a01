"""Command-line jobs, for ``spark-submit`` or ``python -m lakezones``.

    python -m lakezones extract   --contracts db.yaml --db inv --schema inventory --lake-root s3a://lake \\
                                  --run-date 2024-03-08 (--jdbc-url URL [--jdbc-driver CLS] | --parquet-dir DIR)
    python -m lakezones promote   --contracts db.yaml --db inv --schema inventory --lake-root ... --job-date ...
    python -m lakezones compact   --contracts db.yaml --db inv --schema inventory --lake-root ... --zone staging
    python -m lakezones compact-ledger --lake-root ...
    python -m lakezones wide-table --job wide.yaml --db inv --schema inventory --lake-root ... --run-date ...
    python -m lakezones train | select-model | score  --csv data.csv --label Species --features a,b,c,d ...

JDBC credentials come from ``LAKEZONES_JDBC_USER`` / ``LAKEZONES_JDBC_PASSWORD``
and are never printed.  The session is the one ``spark-submit`` provides.
Each command prints one JSON line per table outcome.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys
from dataclasses import asdict

from pyspark.sql import SparkSession

from .functions import RAW_ZONE, STAGING_ZONE
from .operators.ledger import Ledger
from .plans.runs import ERROR
from .session import ensure_checkpoint_dir
from .sources.files import JdbcSource, ParquetSource, read_csv
from .sources.jdbc import JdbcConnection
from .sources.lake import LakeTable
from .specs import load_specs


def _print(obj) -> None:
    print(json.dumps(obj, default=str))


def _report(outcomes) -> int:
    """One JSON line an outcome; 1 if any failed."""
    for o in outcomes:
        _print(asdict(o))
    return int(any(o.kind == ERROR for o in outcomes))


def _today() -> str:
    return dt.datetime.now(dt.timezone.utc).date().isoformat()


def _common(p: argparse.ArgumentParser, dates=("run_date",)) -> None:
    p.add_argument("--lake-root", required=True)
    p.add_argument("--db", required=True)
    p.add_argument("--schema", required=True)
    p.add_argument("--format", default="parquet", help="file format of the lake's batches")
    for d in dates:
        p.add_argument(f"--{d.replace('_', '-')}", default=_today())


def _sources(args, specs):
    if args.jdbc_url:
        conn = JdbcConnection(url=args.jdbc_url, driver=args.jdbc_driver,
                              user=os.environ.get("LAKEZONES_JDBC_USER"),
                              password=os.environ.get("LAKEZONES_JDBC_PASSWORD"))
        return {name: JdbcSource(name, conn, f"{args.schema}.{name}",
                                 partition_column=spec.primary_key[0] if spec.primary_key else None,
                                 num_partitions=args.partitions)
                for name, spec in specs.items()}
    if args.parquet_dir:
        return {name: ParquetSource(name, f"{args.parquet_dir.rstrip('/')}/{name}.parquet") for name in specs}
    raise SystemExit("extract needs --jdbc-url or --parquet-dir")


def cmd_extract(spark, args):
    from .plans.extract import run_extract

    specs = load_specs(args.contracts, mode=args.mode)
    ledger = Ledger(spark, f"{args.lake_root.rstrip('/')}/_ledger")
    outs = run_extract(spark, args.lake_root, ledger, _sources(args, specs), specs, db_name=args.db,
                       schema=args.schema, run_date=args.run_date, single_table=args.table, base=args.base,
                       legacy=args.legacy, log_skipped=args.log_skipped, fmt=args.format,
                       pre_check_last_checkpoint=args.last_checkpoint, parallel=args.parallel)
    return _report(outs)


def cmd_promote(spark, args):
    from .plans.promote import run_promote

    specs = load_specs(args.contracts, mode=args.mode)
    ledger = Ledger(spark, f"{args.lake_root.rstrip('/')}/_ledger")
    outs = run_promote(spark, args.lake_root, ledger, db_name=args.db, schema=args.schema, job_date=args.job_date,
                       specs=specs, single_table=args.table, from_zone=args.from_zone, to_zone=args.to_zone,
                       base=args.base, fmt=args.format, parallel=args.parallel)
    return _report(outs)


def cmd_compact(spark, args):
    specs = load_specs(args.contracts, mode=args.mode)
    ledger = Ledger(spark, f"{args.lake_root.rstrip('/')}/_ledger")
    for name, spec in specs.items():
        if args.table and name != args.table:
            continue
        rows = LakeTable(spark, ledger, args.lake_root, args.zone, name, args.db, args.schema,
                         fmt=args.format, renames=spec.renames, fill=spec.fill).compact(args.run_date, spec.primary_key, spec.buckets)
        _print({"table": name, "zone": args.zone, "rows": rows})


def cmd_compact_ledger(spark, args):
    ledger = Ledger(spark, f"{args.lake_root.rstrip('/')}/_ledger")
    snapshot = ledger.compact()
    _print({"ledger_snapshot": snapshot, "runs": ledger.frame().count()})


def cmd_wide_table(spark, args):
    import yaml

    from .plans.transform_load import DimTable, WideTable

    with open(args.job, encoding="utf-8") as fh:
        job = yaml.safe_load(fh)
    ledger = Ledger(spark, f"{args.lake_root.rstrip('/')}/_ledger")
    dims = [DimTable(d["table"], d["fact_key"], d["dim_key"], d.get("columns"), d.get("primary_key", ()))
            for d in job["dims"]]
    wide = WideTable(spark, args.lake_root, ledger, db_name=args.db, schema=args.schema,
                     output_table=job["output_table"], fact=job["fact"], fact_columns=job["fact_columns"],
                     fact_key=job.get("fact_key", ()), dims=dims, current=bool(job.get("current", False)), fmt=args.format)
    return _report([wide.load(args.run_date, job_date=args.job_date)])


def cmd_train(spark, args):
    from .plans.ml_jobs import save_predictions, train_and_score

    df = read_csv(spark, args.csv)
    s = train_and_score(df, label_source=args.label, feature_cols=args.features.split(","), id_col=args.id)
    if args.output:
        save_predictions(s.predictions, args.output)
    _print({"train_rows": s.train.count(), "test_rows": s.test.count(), "output": args.output})


def cmd_select_model(spark, args):
    from .plans.ml_jobs import select_model

    sel = select_model(read_csv(spark, args.csv), label_source=args.label, feature_cols=args.features.split(","),
                       path=args.model_path, overwrite=args.overwrite, parallelism=args.parallelism)
    _print({"validation": sel.metrics, "f1_after_reload": sel.f1})


def cmd_score(spark, args):
    from .plans.ml_jobs import batch_inference, save_predictions

    out = batch_inference(read_csv(spark, args.csv), model_path=args.model_path, key=[args.id],
                          fraction=args.fraction, n=args.limit)
    if args.output:
        save_predictions(out, args.output)
    _print({"scored": out.count(), "output": args.output})


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lakezones")
    sub = p.add_subparsers(dest="command", required=True)

    e = sub.add_parser("extract", help="incremental extract into the raw zone")
    _common(e)
    e.add_argument("--contracts", required=True)
    e.add_argument("--mode", default="full_load")
    e.add_argument("--table")
    e.add_argument("--jdbc-url")
    e.add_argument("--jdbc-driver")
    e.add_argument("--partitions", type=int, default=None)
    e.add_argument("--parquet-dir")
    e.add_argument("--base", default="current", choices=["current", "committed", "day_path"])
    e.add_argument("--legacy", action="store_true")
    e.add_argument("--last-checkpoint", action="store_true", help="day_path: fall back to the last committed batch")
    e.add_argument("--log-skipped", action="store_true", help="log a 'skipped' run when the source shrank")
    e.add_argument("--parallel", type=int, default=1, help="tables in work at a time")
    e.set_defaults(func=cmd_extract)

    pr = sub.add_parser("promote", help="promote raw batches of a day to staging")
    _common(pr, dates=("job_date",))
    pr.add_argument("--contracts", required=True)
    pr.add_argument("--mode", default="full_load")
    pr.add_argument("--table")
    pr.add_argument("--from-zone", default=RAW_ZONE)
    pr.add_argument("--to-zone", default=STAGING_ZONE)
    pr.add_argument("--base", default="current", choices=["current", "committed"])
    pr.add_argument("--parallel", type=int, default=1, help="tables in work at a time")
    pr.set_defaults(func=cmd_promote)

    c = sub.add_parser("compact", help="write each table's current state as a snapshot batch")
    _common(c)
    c.add_argument("--contracts", required=True)
    c.add_argument("--mode", default="full_load")
    c.add_argument("--table")
    c.add_argument("--zone", default=STAGING_ZONE)
    c.set_defaults(func=cmd_compact)

    cl = sub.add_parser("compact-ledger", help="fold the run records into one snapshot (no pipeline running)")
    cl.add_argument("--lake-root", required=True)
    cl.set_defaults(func=cmd_compact_ledger)

    w = sub.add_parser("wide-table", help="join staging tables into a warehouse table")
    _common(w)
    w.add_argument("--job-date", help="read the staging batches of this day only")
    w.add_argument("--job", required=True, help="YAML: output_table, fact, fact_columns, dims, current")
    w.set_defaults(func=cmd_wide_table)

    for name, func, help_ in (("train", cmd_train, "split, fit, score, decode"),
                              ("select-model", cmd_select_model, "grid + train/validation split, save, reload"),
                              ("score", cmd_score, "load best model, score all rows or a sample")):
        m = sub.add_parser(name, help=help_)
        m.add_argument("--csv", required=True)
        m.add_argument("--label", required=name != "score")
        m.add_argument("--features", required=name != "score", help="comma-separated columns")
        m.add_argument("--id", required=name != "select-model")
        m.add_argument("--model-path")
        m.add_argument("--output")
        m.add_argument("--overwrite", action="store_true")
        m.add_argument("--fraction", type=float, help="score a sample of the rows")
        m.add_argument("--limit", type=int, help="score so many rows of it")
        m.add_argument("--parallelism", type=int, default=1, help="grid points fitted side by side")
        m.set_defaults(func=func)
    return p


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"lakezones-{args.command}").getOrCreate()
    ensure_checkpoint_dir(spark)
    failed = args.func(spark, args)
    if failed:
        raise SystemExit(failed)


if __name__ == "__main__":
    main(sys.argv[1:])
