"""Driver queries: one per operator of the survey's inventory, each with its
DuckDB oracle.

Every query reads the given tables (or frames Spark derives from them) in
full.  Queries that exercise the lake (extract, promote, transform/load)
write into a fresh folder below the session's ``spark.checkpoint.dir`` and
return what a reader of the lake would see.

Derived inputs (same rule in Spark and in the oracle SQL):

* *old orders snapshot*: the table as of 2001-01-01.  Orders placed since
  then are not in it yet, and orders finished (``F``) since 2000-07-01 were
  still pending (``P``) in it.  ``orders`` is the new snapshot.  The
  *altered* snapshot is ``orders`` with only that status change (used for a
  row that goes A -> B -> A).
* *events ledger*: a run ledger with one run per event (``event_type`` as
  table, ``ts`` as end time, ``value`` as row number).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import SUCCESS_STATUS, json_details, json_field, unpadded_date_key_col
from .operators import ml
from .operators.changes import add_audit_columns, current_state, snapshot_diff
from .operators.joins import Dim, wide_join
from .operators.ledger import (LEDGER_SCHEMA, Ledger, checkpoints_of, row_numbers_on_date_of, run_counts_of,
                               watermarks_of, zone_paths_of)
from .operators.profile import describe_numeric, row_counts
from .operators.rownum import dense_row_number
from .operators.sampling import hash_split, random_split, sample_limit, split_part
from .plans.extract import extract_table
from .plans.ml_jobs import batch_inference, save_predictions, select_model, train_and_score
from .plans.promote import promote_table
from .plans.runs import ERROR
from .plans.text_job import count_and_save_text
from .plans.transform_load import DimTable, WideTable
from .session import scratch_dir
from .sources.files import FrameSource, from_rows, read_csv
from .sources.lake import LakeTable, write_text
from .specs import TableSpec, load_specs

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")

DB, SCHEMA = "tpch", "main"
DAY1, DAY2, DAY3 = "2024-03-08", "2024-03-09", "2024-03-10"

ORDERS_SPEC = TableSpec("orders", required_columns=("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"),
                        primary_key=("o_orderkey",))
CUSTOMER_SPEC = TableSpec("customer", required_columns=("c_name", "c_nationkey", "c_mktsegment"),
                          primary_key=("c_custkey",))
# not unique in the test data
LINEITEM_SPEC = TableSpec("lineitem", required_columns=("l_quantity",), primary_key=("l_orderkey", "l_linenumber"))
NATION_SPEC = TableSpec("nation", required_columns=("n_name", "n_regionkey"), primary_key=("n_nationkey",))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# Derived inputs
# ---------------------------------------------------------------------------

# Fixed values of the snapshot rule (same in Spark and in the oracle SQL).
SNAPSHOT_DAY = "2001-01-01"     # the old snapshot is the table as of this day
FINISHED_SINCE = "2000-07-01"   # orders finished since then were still pending in it


def _status_then(orders: DataFrame):
    day = F.lit(FINISHED_SINCE).cast(orders.schema["o_orderdate"].dataType)
    was_pending = (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= day)
    return F.when(was_pending, F.lit("P")).otherwise(F.col("o_orderstatus"))


def old_orders(orders: DataFrame) -> DataFrame:
    cutoff = F.lit(SNAPSHOT_DAY).cast(orders.schema["o_orderdate"].dataType)
    return orders.filter(F.col("o_orderdate") < cutoff).withColumn("o_orderstatus", _status_then(orders))


def altered_orders(orders: DataFrame) -> DataFrame:
    return orders.withColumn("o_orderstatus", _status_then(orders))


def events_ledger(events: DataFrame) -> DataFrame:
    run_id = F.lpad(F.col("event_id").cast("string"), 12, "0")
    zone = F.when(F.hour("ts") < 12, F.lit("raw")).otherwise(F.lit("staging"))
    db = F.concat(F.lit("db"), (F.col("user_id") % 3).cast("string"))
    day = F.to_date("ts")
    path = F.concat(F.lit("lake/"), zone, F.lit("/"), db, F.lit("/"), F.col("event_type"), F.lit("/ingest_date="),
                    F.date_format(day, "yyyy-MM-dd"), F.lit("/batch_id="), run_id)
    return events.select(
        run_id.alias("run_id"), db.alias("db_name"), F.col("event_type").alias("table_name"),
        F.lit("extract").alias("action"), zone.alias("zone"),
        F.when(F.col("value") < 5, F.lit("error")).otherwise(F.lit(SUCCESS_STATUS)).alias("status"),
        F.round(F.col("value") * 100).cast("long").alias("last_row_number"),
        F.concat(F.lit('{"sink_path":"'), path, F.lit('"}')).alias("details"),
        day.alias("job_date"), (F.col("ts") - F.expr("INTERVAL 5 MINUTES")).alias("job_start"),
        F.col("ts").alias("job_end"),
    ).select(*[F.col(f.name).cast(f.dataType) for f in LEDGER_SCHEMA.fields])


_STATUS_THEN_SQL = (f"CASE WHEN o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '{FINISHED_SINCE}' THEN 'P' "
                    "ELSE o_orderstatus END AS o_orderstatus")

OLD_ORDERS_SQL = (f"SELECT o_orderkey, o_custkey, {_STATUS_THEN_SQL}, o_totalprice, o_orderdate, o_orderpriority "
                  f"FROM orders WHERE o_orderdate < TIMESTAMP '{SNAPSHOT_DAY}'")

ALTERED_ORDERS_SQL = (f"SELECT o_orderkey, o_custkey, {_STATUS_THEN_SQL}, o_totalprice, o_orderdate, o_orderpriority "
                      "FROM orders")

EVENTS_LEDGER_SQL = """SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') AS run_id,
       'db' || CAST(user_id % 3 AS VARCHAR) AS db_name,
       event_type AS table_name,
       'extract' AS action,
       CASE WHEN hour(ts) < 12 THEN 'raw' ELSE 'staging' END AS zone,
       CASE WHEN value < 5 THEN 'error' ELSE 'succeed' END AS status,
       CAST(round(value * 100) AS BIGINT) AS last_row_number,
       '{"sink_path":"lake/' || CASE WHEN hour(ts) < 12 THEN 'raw' ELSE 'staging' END || '/db'
         || CAST(user_id % 3 AS VARCHAR) || '/' || event_type || '/ingest_date='
         || strftime(CAST(ts AS DATE), '%Y-%m-%d') || '/batch_id=' || lpad(CAST(event_id AS VARCHAR), 12, '0')
         || '"}' AS details,
       CAST(ts AS DATE) AS job_date,
       ts - INTERVAL 5 MINUTE AS job_start,
       ts AS job_end
FROM events"""


def _lake(spark: SparkSession, label: str) -> tuple[str, Ledger]:
    root = scratch_dir(spark, label)
    return root, Ledger(spark, f"{root}/_ledger")


def _extract(spark, root, ledger, frame: DataFrame, spec: TableSpec, day, **kw):
    out = extract_table(spark, root, ledger, FrameSource(spec.name, frame), spec, db_name=DB, schema=SCHEMA,
                        run_date=day, **kw)
    if out.kind == ERROR:
        raise RuntimeError(out.error)
    return out


def _promote(spark, root, ledger, spec: TableSpec, day):
    outs = promote_table(spark, root, ledger, db_name=DB, schema=SCHEMA, table_name=spec.name, job_date=day,
                         primary_key=spec.primary_key)
    for o in outs:
        if o.kind == ERROR:
            raise RuntimeError(o.error)
    return outs


def _zone(spark, root, ledger, zone: str, spec: TableSpec) -> LakeTable:
    return LakeTable(spark, ledger, root, zone, spec.name, DB, SCHEMA)


# ---------------------------------------------------------------------------
# 1. Wide tables
# ---------------------------------------------------------------------------

def q_wide_table(spark, sf):
    """lineitem ⋈ (orders ⋈ customer) ⋈ part.  orders ⋈ customer first, so
    the lineitem-sized stream is shuffled twice, not three times, when no
    side is small enough to broadcast."""
    oc = wide_join(table(spark, sf, "orders"),
                   [Dim(table(spark, sf, "customer"), "o_custkey", "c_custkey", ["c_name", "c_mktsegment"])],
                   fact_columns=["o_orderkey", "o_orderdate", "o_orderstatus", "o_custkey"])
    return wide_join(
        table(spark, sf, "lineitem"),
        [Dim(oc, "l_orderkey", "o_orderkey", ["o_orderdate", "o_orderstatus", "c_name", "c_mktsegment"]),
         Dim(table(spark, sf, "part"), "l_partkey", "p_partkey", ["p_name", "p_brand"])],
        fact_columns=["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"])


def q_wide_table_drop(spark, sf):
    """Dimension columns dropped by name."""
    return wide_join(table(spark, sf, "orders"),
                     [Dim(table(spark, sf, "customer"), "o_custkey", "c_custkey", drop=["c_nationkey", "c_acctbal"])])


def q_missing_columns(spark, sf):
    """Contracts of two load modes checked against several tables: one
    row a missing column."""
    contracts = {"full_load": {"orders": {"required_columns": ["o_custkey", "o_comment"], "primary_key": "o_orderkey"},
                               "customer": {"required_columns": ["c_name"]},
                               "nation": {"required_columns": ["n_name", "n_comment", "n_code"]}},
                 "partial": {"region": {"required_columns": ["r_code"]}}}
    rows = []
    for mode, only in (("full_load", None), ("partial", "region")):
        for name, spec in load_specs(contracts, mode, only).items():
            rows += [(mode, name, c) for c in spec.missing_columns(table(spark, sf, name).columns)]
    return spark.createDataFrame(rows, "load_mode string, table_name string, missing string")


def q_wide_table_orders_customers(spark, sf):
    return wide_join(table(spark, sf, "orders"),
                     [Dim(table(spark, sf, "customer"), "o_custkey", "c_custkey", ["c_name", "c_mktsegment"])],
                     fact_columns=["o_orderkey", "o_orderdate", "o_totalprice", "o_custkey"])


# ---------------------------------------------------------------------------
# 2. Change detection, row numbers, audit columns
# ---------------------------------------------------------------------------

def q_snapshot_changes(spark, sf):
    orders = table(spark, sf, "orders")
    return snapshot_diff(orders, old_orders(orders))


def q_unchanged_is_empty(spark, sf):
    orders = table(spark, sf, "orders")
    return snapshot_diff(orders, orders)


def q_dense_row_number(spark, sf):
    """Unique key: the key alone is numbered and joined back."""
    return dense_row_number(table(spark, sf, "orders"), ["o_orderkey"], unique=True).select("o_orderkey", "ROW_NUMBER")


def q_dense_row_number_ts(spark, sf):
    return dense_row_number(table(spark, sf, "events"), ["ts"]).select("event_id", "ts", "ROW_NUMBER")


def q_dense_row_number_text(spark, sf):
    return dense_row_number(table(spark, sf, "customer"), ["c_name"]).select("c_custkey", "c_name", "ROW_NUMBER")


def q_dense_row_number_composite(spark, sf):
    """Leading column with many repeated values; rows carried whole."""
    return dense_row_number(table(spark, sf, "events"), ["user_id", "event_id"]) \
        .select("event_id", "user_id", "ROW_NUMBER")


def q_dense_row_number_range(spark, sf):
    """Text leading column, key-only numbering of a composite key."""
    return dense_row_number(table(spark, sf, "events"), ["event_type", "event_id"], unique=True) \
        .select("event_id", "event_type", "ROW_NUMBER")


def q_audit_columns(spark, sf):
    return add_audit_columns(table(spark, sf, "customer"), DAY1)


def q_audit_columns_legacy(spark, sf):
    return add_audit_columns(table(spark, sf, "customer"), DAY1, legacy=True)


def q_append_union(spark, sf):
    orders = table(spark, sf, "orders")
    old = old_orders(orders)
    root, ledger = _lake(spark, "append_union")
    t = _zone(spark, root, ledger, "raw", ORDERS_SPEC)
    t.append(old, DAY1)
    t.append(snapshot_diff(orders, old), DAY2)
    return t.read()


def q_lake_append_read(spark, sf):
    root, ledger = _lake(spark, "lake_append")
    t = _zone(spark, root, ledger, "raw", ORDERS_SPEC)
    t.append(table(spark, sf, "orders"), DAY1)
    return t.read()


def q_lake_replace_read(spark, sf):
    orders = table(spark, sf, "orders")
    root, ledger = _lake(spark, "lake_replace")
    t = LakeTable(spark, ledger, root, "warehouse", "orders_wide")
    t.replace(old_orders(orders), DAY1)
    t.replace(orders, DAY2)
    return t.read(latest_only=True)


# ---------------------------------------------------------------------------
# 3. Ledger questions over a ledger derived from events
# ---------------------------------------------------------------------------

def q_watermarks(spark, sf):
    return watermarks_of(events_ledger(table(spark, sf, "events")))


def q_latest_checkpoint(spark, sf):
    return checkpoints_of(events_ledger(table(spark, sf, "events")))


def q_run_on_date(spark, sf):
    return row_numbers_on_date_of(events_ledger(table(spark, sf, "events")))


def q_run_counts(spark, sf):
    return run_counts_of(events_ledger(table(spark, sf, "events")))


def q_zone_paths(spark, sf):
    return zone_paths_of(events_ledger(table(spark, sf, "events")), zone="raw")


def q_promotion_candidates(spark, sf):
    """S9 + F3: raw batches of each day, flagged when staging already has a
    run of any status for that table and day."""
    ledger = events_ledger(table(spark, sf, "events"))
    raw = zone_paths_of(ledger, zone="raw")
    staged = (run_counts_of(ledger.filter(F.col("zone") == "staging"), keys=("db_name", "table_name"))
              .select("db_name", "table_name", "job_date", F.lit(True).alias("staged")))
    return (raw.join(staged, ["db_name", "table_name", "job_date"], "left")
            .select("db_name", "table_name", "job_date", "sink_path",
                    F.coalesce(F.col("staged"), F.lit(False)).alias("staged")))


# ---------------------------------------------------------------------------
# 4. Sources and sinks
# ---------------------------------------------------------------------------

def q_csv_roundtrip(spark, sf):
    part = table(spark, sf, "part")
    path = scratch_dir(spark, "csv") + "/part"
    part.write.mode("errorifexists").option("header", True).csv(path)
    back = read_csv(spark, path)  # header + inferred types, as the reference reads CSV
    return back.select(*[F.col(f.name).cast(f.dataType) for f in part.schema.fields])


def q_text_lines(spark, sf):
    path = scratch_dir(spark, "text") + "/customer"
    if not write_text(table(spark, sf, "customer"), path, ["c_name", "c_custkey"]):
        raise RuntimeError(f"text sink path exists: {path}")
    return spark.read.text(path)


def q_count_and_text(spark, sf):
    """Count and save as text, then once more onto the existing path."""
    path = scratch_dir(spark, "text") + "/part"
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    first, again = count_and_save_text(part, path), count_and_save_text(part, path)
    return (spark.read.text(path).withColumn("n", F.lit(first[0]).cast("long"))
            .withColumn("written_again", F.lit(again[1])))


def q_local_rows(spark, sf):
    """The regions as a local collection, made a frame and joined to the nations."""
    regions = from_rows(spark, [tuple(r) for r in table(spark, sf, "region").select("r_regionkey", "r_name").collect()],
                        "key int, region string")
    nations = table(spark, sf, "nation")
    return nations.join(regions, nations["n_regionkey"] == regions["key"]).select("n_name", "region")


def q_date_keys(spark, sf):
    """Days without padding, with their number of events."""
    return table(spark, sf, "events").groupBy(unpadded_date_key_col("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))


def q_run_details_json(spark, sf):
    """N5 + N6: run details as JSON text, read back field by field."""
    runs = table(spark, sf, "events").select(
        "event_id", json_details(sink_path=F.concat(F.lit("lake/"), "event_type"), rows=F.col("user_id")).alias("details"))
    return runs.select("event_id", "details", json_field("details", "sink_path").alias("sink_path"),
                       json_field("details", "rows").cast("long").alias("n_rows"))


# ---------------------------------------------------------------------------
# 5. Composite jobs (I1-I5) on the lake
# ---------------------------------------------------------------------------

def q_extract_first_load(spark, sf):
    root, ledger = _lake(spark, "extract_first")
    _extract(spark, root, ledger, table(spark, sf, "orders"), ORDERS_SPEC, DAY1)
    return _zone(spark, root, ledger, "raw", ORDERS_SPEC).read()


def q_extract_incremental(spark, sf):
    orders = table(spark, sf, "orders")
    root, ledger = _lake(spark, "extract_incr")
    _extract(spark, root, ledger, old_orders(orders), ORDERS_SPEC, DAY1)
    _extract(spark, root, ledger, orders, ORDERS_SPEC, DAY2)
    return _zone(spark, root, ledger, "raw", ORDERS_SPEC).read(job_date=DAY2)


def q_extract_incremental_at_scale(spark, sf):
    """``extract_incremental`` over three days: the third brings no change,
    so all that the later days wrote is the second day's batch."""
    orders = table(spark, sf, "orders")
    root, ledger = _lake(spark, "extract_scale")
    for frame, day in ((old_orders(orders), DAY1), (orders, DAY2), (orders, DAY3)):
        _extract(spark, root, ledger, frame, ORDERS_SPEC, day)
    raw = _zone(spark, root, ledger, "raw", ORDERS_SPEC)
    return _after_first_day(raw, raw.read().columns)


def _raised_top_price(lines: DataFrame) -> DataFrame:
    """Line items with the quantity of those of the highest price raised by one."""
    top = lines.agg(F.max("l_extendedprice")).scalar()
    return lines.withColumn("l_quantity", F.when(F.col("l_extendedprice") == top, F.col("l_quantity") + 1)
                            .otherwise(F.col("l_quantity")))


def _after_first_day(lake_table: LakeTable, columns: list[str]) -> DataFrame:
    written = lake_table.read(with_batch_columns=True)
    return written.where(F.col("ingest_date") > F.lit(DAY1).cast("date")).select(*columns)


def q_extract_duplicate_key(spark, sf):
    """A key that repeats: the same snapshot twice, then one with the top
    price's lines changed.  What the second and third day wrote: only the
    changed lines."""
    lines = table(spark, sf, "lineitem")
    root, ledger = _lake(spark, "extract_duplicates")
    for frame, day in ((lines, DAY1), (lines, DAY2), (_raised_top_price(lines), DAY3)):
        _extract(spark, root, ledger, frame, LINEITEM_SPEC, day)
    return _after_first_day(_zone(spark, root, ledger, "raw", LINEITEM_SPEC), lines.columns)


def _nullable_key(orders: DataFrame) -> DataFrame:
    """Orders whose key is known only while they are not finished."""
    return orders.withColumn("o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey")))


def q_extract_null_key(spark, sf):
    """A key that is null for finished orders: the same snapshot twice, then
    the status change of ``altered orders`` undone.  What the second and
    third day wrote."""
    orders = table(spark, sf, "orders")
    root, ledger = _lake(spark, "extract_nulls")
    before = _nullable_key(altered_orders(orders))
    for frame, day in ((before, DAY1), (before, DAY2), (_nullable_key(orders), DAY3)):
        _extract(spark, root, ledger, frame, ORDERS_SPEC, day)
    return _after_first_day(_zone(spark, root, ledger, "raw", ORDERS_SPEC), orders.columns)


def q_promote_duplicate_key(spark, sf):
    """Staging after two promotions of a table whose key repeats."""
    lines = table(spark, sf, "lineitem")
    root, ledger = _lake(spark, "promote_duplicates")
    for frame in (lines, _raised_top_price(lines)):
        _extract(spark, root, ledger, frame, LINEITEM_SPEC, DAY1)
        _promote(spark, root, ledger, LINEITEM_SPEC, DAY1)
    return _zone(spark, root, ledger, "staging", LINEITEM_SPEC).read().select(*lines.columns)


def q_keyless_extract_promote(spark, sf):
    """A table without a key: two extracts and promotions of one day; staging."""
    orders = table(spark, sf, "orders")
    spec = TableSpec("orders", required_columns=("o_totalprice",))
    root, ledger = _lake(spark, "keyless")
    for frame in (old_orders(orders), orders):
        _extract(spark, root, ledger, frame, spec, DAY1)
        _promote(spark, root, ledger, spec, DAY1)
    return _zone(spark, root, ledger, "staging", spec).read().select(*orders.columns)


def q_extract_no_change(spark, sf):
    """the same snapshot on two days and an empty source: the ledger has one run."""
    orders = table(spark, sf, "orders")
    root, ledger = _lake(spark, "no_change")
    for frame, day in ((orders, DAY1), (orders, DAY2), (orders.where("false"), DAY3)):
        _extract(spark, root, ledger, frame, ORDERS_SPEC, day)
    return ledger.runs(zone="raw").select("table_name", "status", "last_row_number", "job_date")


def q_lake_compacted(spark, sf):
    """Compaction of the lake and of the ledger: the state read from the
    snapshot is the newest version of each key."""
    orders = table(spark, sf, "orders")
    root, ledger = _lake(spark, "compacted")
    for frame, day in ((altered_orders(orders), DAY1), (orders, DAY2)):
        _extract(spark, root, ledger, frame, ORDERS_SPEC, day)
    raw = _zone(spark, root, ledger, "raw", ORDERS_SPEC)
    raw.compact(DAY3, ORDERS_SPEC.primary_key)
    ledger.compact()
    return current_state(raw.read_state_inputs(), ORDERS_SPEC.primary_key).select(*orders.columns)


def q_extract_reverted_row(spark, sf):
    orders = table(spark, sf, "orders")
    root, ledger = _lake(spark, "extract_revert")
    _extract(spark, root, ledger, orders, ORDERS_SPEC, DAY1)
    _extract(spark, root, ledger, altered_orders(orders), ORDERS_SPEC, DAY2)
    _extract(spark, root, ledger, orders, ORDERS_SPEC, DAY3)
    return _zone(spark, root, ledger, "raw", ORDERS_SPEC).read(job_date=DAY3)


def q_extract_deleted_source(spark, sf):
    orders = table(spark, sf, "orders")
    root, ledger = _lake(spark, "extract_deleted")
    _extract(spark, root, ledger, orders, ORDERS_SPEC, DAY1)
    _extract(spark, root, ledger, old_orders(orders), ORDERS_SPEC, DAY2)
    return ledger.runs(zone="raw", table_name="orders").select("table_name", "status", "last_row_number",
                                                                "job_date")


def q_failed_run_logged(spark, sf):
    """One run over three tables in which the customer batch breaks while
    it is written (a row with a negative balance raises inside the read, as
    a source failing mid-run would).  The failure becomes a complete error
    row (status, source row count, message) and the other tables still
    load.  A volatile supplier source whose read fails ends as an error row
    too, with 0 rows counted."""
    root, ledger = _lake(spark, "failed_run")
    customer = table(spark, sf, "customer")
    lost = table(spark, sf, "supplier").withColumn("s_name", F.raise_error(F.lit("connection lost")))
    extract_table(spark, root, ledger, FrameSource("supplier", lost, stable=False),
                  TableSpec("supplier", required_columns=("s_name",), primary_key=("s_suppkey",)), db_name=DB,
                  schema=SCHEMA, run_date=DAY1)
    breaking = customer.withColumn("c_acctbal", F.when(F.col("c_acctbal") < 0, F.raise_error(F.lit("negative balance")))
                                   .otherwise(F.col("c_acctbal")))
    for spec, frame in ((ORDERS_SPEC, table(spark, sf, "orders")), (CUSTOMER_SPEC, breaking),
                        (NATION_SPEC, table(spark, sf, "nation"))):
        extract_table(spark, root, ledger, FrameSource(spec.name, frame), spec, db_name=DB, schema=SCHEMA,
                      run_date=DAY1)
    return ledger.runs(zone="raw").select("table_name", "status", "last_row_number", "job_date",
                                          json_field("details", "error_message").isNotNull().alias("has_error"))


def q_current_state(spark, sf):
    orders = table(spark, sf, "orders")
    root, ledger = _lake(spark, "current_state")
    _extract(spark, root, ledger, old_orders(orders), ORDERS_SPEC, DAY1)
    _extract(spark, root, ledger, orders, ORDERS_SPEC, DAY2)
    versions = _zone(spark, root, ledger, "raw", ORDERS_SPEC).read(with_batch_columns=True)
    return current_state(versions, ["o_orderkey"]).select(*orders.columns)


def q_promote_first(spark, sf):
    root, ledger = _lake(spark, "promote_first")
    _extract(spark, root, ledger, table(spark, sf, "orders"), ORDERS_SPEC, DAY1)
    _promote(spark, root, ledger, ORDERS_SPEC, DAY1)
    return _zone(spark, root, ledger, "staging", ORDERS_SPEC).read()


def q_promote_incremental(spark, sf):
    orders = table(spark, sf, "orders")
    root, ledger = _lake(spark, "promote_incr")
    _extract(spark, root, ledger, old_orders(orders), ORDERS_SPEC, DAY1)
    _promote(spark, root, ledger, ORDERS_SPEC, DAY1)
    _extract(spark, root, ledger, orders, ORDERS_SPEC, DAY1)
    _promote(spark, root, ledger, ORDERS_SPEC, DAY1)
    return _zone(spark, root, ledger, "staging", ORDERS_SPEC).read()


def q_promote_reverted_row(spark, sf):
    """I2 with three raw batches on one day (all orders; the altered prices;
    the prices reverted): promoted one after the other in commit order, each
    diffed against staging's current state, so the A -> B -> A rows arrive
    as three versions."""
    orders = table(spark, sf, "orders")
    root, ledger = _lake(spark, "promote_revert")
    for frame in (orders, altered_orders(orders), orders):
        _extract(spark, root, ledger, frame, ORDERS_SPEC, DAY1)
    _promote(spark, root, ledger, ORDERS_SPEC, DAY1)
    return _zone(spark, root, ledger, "staging", ORDERS_SPEC).read()


def q_transform_load(spark, sf):
    root, ledger = _lake(spark, "transform_load")
    for spec in (ORDERS_SPEC, CUSTOMER_SPEC, NATION_SPEC):
        _extract(spark, root, ledger, table(spark, sf, spec.name), spec, DAY1)
        _promote(spark, root, ledger, spec, DAY1)
    job = WideTable(spark, root, ledger, db_name=DB, schema=SCHEMA, output_table="orders_wide", fact="orders",
                    fact_columns=["o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"],
                    dims=[DimTable("customer", "o_custkey", "c_custkey", ["c_name", "c_mktsegment", "c_nationkey"]),
                          DimTable("nation", "c_nationkey", "n_nationkey", ["n_name"])])
    out = job.load(DAY1)
    if out.kind == ERROR:
        raise RuntimeError(out.error)
    return job.read_output("orders_wide")


def _staged_orders(spark, root, ledger, sf):
    """Old orders staged on the first day, what changed since on the second; customers on both."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    for frame, day in ((old_orders(orders), DAY1), (orders, DAY2)):
        _extract(spark, root, ledger, frame, ORDERS_SPEC, day)
        _promote(spark, root, ledger, ORDERS_SPEC, day)
    for day in (DAY1, DAY2):
        _zone(spark, root, ledger, "staging", CUSTOMER_SPEC).append(customer, day)


def q_transform_load_one_day(spark, sf):
    """I4 over one staging day of two: only that day's batches are read."""
    root, ledger = _lake(spark, "transform_day")
    _staged_orders(spark, root, ledger, sf)
    job = WideTable(spark, root, ledger, db_name=DB, schema=SCHEMA, output_table="orders_wide", fact="orders",
                    fact_columns=["o_orderkey", "o_orderstatus"],
                    dims=[DimTable("customer", "o_custkey", "c_custkey", ["c_name"])])
    out = job.load(DAY2, job_date=DAY2)
    if out.kind == ERROR:
        raise RuntimeError(out.error)
    return job.read_output("orders_wide")


def q_transform_load_current(spark, sf):
    """I4 over the current state of every staged table."""
    root, ledger = _lake(spark, "transform_current")
    _staged_orders(spark, root, ledger, sf)
    job = WideTable(spark, root, ledger, db_name=DB, schema=SCHEMA, output_table="orders_wide", fact="orders",
                    current=True, fact_key=["o_orderkey"], fact_columns=["o_orderkey", "o_orderstatus"],
                    dims=[DimTable("customer", "o_custkey", "c_custkey", ["c_name"], ["c_custkey"])])
    out = job.load(DAY3)
    if out.kind == ERROR:
        raise RuntimeError(out.error)
    return job.output("orders_wide").read(latest_only=True)


class _BalanceCheckedWide(WideTable):
    """A wide-table transform that breaks on a negative customer balance
    while its output is written."""

    def transform(self, **kwargs):
        df, name = super().transform(**kwargs)
        bad = F.raise_error(F.lit("negative balance"))
        return df.withColumn("c_acctbal", F.when(F.col("c_acctbal") < 0, bad).otherwise(F.col("c_acctbal"))), name


def q_transform_failed_logged(spark, sf):
    """I3 + I5: extract and promote orders and customers, then a wide-table
    transform that fails mid-write.  The ledger keeps the successful runs
    with their row numbers and one complete error row for the transform
    (table name '' and 0 rows, as the reference logs it)."""
    root, ledger = _lake(spark, "transform_failed")
    for spec in (ORDERS_SPEC, CUSTOMER_SPEC):
        _extract(spark, root, ledger, table(spark, sf, spec.name), spec, DAY1)
        _promote(spark, root, ledger, spec, DAY1)
    job = _BalanceCheckedWide(spark, root, ledger, db_name=DB, schema=SCHEMA, output_table="orders_wide",
                              fact="orders", fact_columns=["o_orderkey", "o_totalprice"],
                              dims=[DimTable("customer", "o_custkey", "c_custkey", ["c_name", "c_acctbal"])])
    job.load(DAY1)
    return ledger.frame().select("zone", "table_name", "action", "status", "last_row_number",
                                 json_field("details", "error_message").isNotNull().alias("has_error"))


# ---------------------------------------------------------------------------
# 6. Profile
# ---------------------------------------------------------------------------

LINEITEM_NUMERIC = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def q_describe_numeric(spark, sf):
    return describe_numeric(table(spark, sf, "lineitem"), LINEITEM_NUMERIC, digits=4)


def q_row_counts(spark, sf):
    return row_counts({name: table(spark, sf, name) for name in TABLES})


# ---------------------------------------------------------------------------
# 7. ML (M1-M12, O2)
# ---------------------------------------------------------------------------

def q_hash_split(spark, sf):
    return table(spark, sf, "events").select("event_id", split_part(["event_id"], (0.7, 0.3), 42).alias("part"))


def q_hash_sample_limit(spark, sf):
    return sample_limit(table(spark, sf, "events"), ["event_id"], 0.1, 5, seed=0).select("event_id", "event_type",
                                                                                         "value")


def q_label_index(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return ml.label_indexer("source", "source_index").fit(docs).transform(docs)


def q_label_decode(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    model = Pipeline(stages=[ml.label_indexer("source", "source_index")]).fit(docs)
    return ml.decoder(model, "source_index", "decoded").transform(model.transform(docs))


def q_assembled_features(spark, sf):
    li = table(spark, sf, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    assembled = ml.feature_assembler(cols).transform(li.select("l_orderkey", "l_linenumber", "l_partkey", *cols))
    return ml.vector_elements(assembled.drop(*cols), "features", len(cols))


def _rule_predictions(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return (labels.join(docs, "doc_id")
            .select(F.col("quality").cast("double").alias("label"),
                    F.when(F.col("n_chars") >= 1000, 1.0).otherwise(0.0).alias("prediction")))


def q_confusion_matrix(spark, sf):
    return ml.confusion_matrix(_rule_predictions(spark, sf))


def q_weighted_f1(spark, sf):
    return ml.weighted_f1(_rule_predictions(spark, sf)).select(F.round("f1", 10).alias("f1"))


def _embeddings(spark, sf) -> DataFrame:
    return ml.with_vector(table(spark, sf, "embeddings"), "embedding", "emb_vec") \
        .withColumn("label_text", F.col("label").cast("string"))


def _sane(scored: DataFrame, decoded: str, labels: list[str]) -> DataFrame:
    """What holds for any right model: the prediction is the most probable
    class, probabilities sum to 1, the decoded label is that class's."""
    p = vector_to_array("probability")
    names, predicted = F.array(*map(F.lit, labels)), F.col("prediction").cast("int")
    return scored.select("vec_id", "label_text", (F.get(p, predicted) == F.array_max(p)).alias("is_argmax"),
                         (F.abs(F.aggregate(p, F.lit(0.0), lambda x, y: x + y) - 1) < 1e-9).alias("sums_to_one"),
                         (F.get(names, predicted) == F.col(decoded)).alias("label_decoded"))


def q_lr_scored(spark, sf):
    """Split, fit, score and decode."""
    scored = train_and_score(_embeddings(spark, sf), label_source="label_text", feature_cols=["emb_vec"],
                             id_col="vec_id", label_col="label_idx",
                             split=lambda df: hash_split(df, ["vec_id"], (0.7, 0.3), 42))
    return _sane(scored.predictions, "output", scored.model.stages[0].labels)


def q_grid_metrics(spark, sf):
    """Grid, validation split, save, reload: what holds for any right selection."""
    emb = _embeddings(spark, sf)
    path = scratch_dir(spark, "model") + "/model"
    # grid points are fitted side by side (same models and metrics as one by one)
    sel = select_model(emb, label_source="label_text", feature_cols=["emb_vec"], path=path, parallelism=4)
    scored = sel.reloaded.transform(emb).select(F.col("Label").alias("label"), "prediction")
    same = abs(ml.weighted_f1(scored).first()["f1"] - sel.f1) < 1e-9
    values = [float(m["metric"]) for m in sel.metrics]
    chosen, best = sel.reloaded.bestModel.stages[-1], sel.metrics[values.index(max(values))]
    is_best = (chosen.getMaxIter(), chosen.getRegParam()) == (int(best["maxIter"]), float(best["regParam"]))
    rows = [(int(m["maxIter"]), float(m["regParam"]), 0 <= v <= 1, same, is_best) for m, v in zip(sel.metrics, values)]
    return spark.createDataFrame(rows, "maxIter int, regParam double, metric_in_range boolean, "
                                       "f1_after_reload boolean, saved_is_best boolean")


def _saved_model(spark, emb: DataFrame) -> tuple[str, list[str]]:
    train, _ = hash_split(emb, ["vec_id"], (0.7, 0.3), 42)
    model = ml.classification_pipeline("label_text", ["emb_vec"], label_col="label_idx").fit(train)
    path = scratch_dir(spark, "model")
    model.write().save(f"{path}/bestModel")
    return path, model.stages[0].labels


def q_batch_inference(spark, sf):
    """I8: fit the pipeline on the train part, persist it as ``bestModel``,
    reload it, score all rows and decode."""
    emb = _embeddings(spark, sf)
    path, labels = _saved_model(spark, emb)
    return _sane(batch_inference(emb, model_path=path), "predict_label", labels)


def q_predictions_table(spark, sf):
    """K8: scored rows saved as a table, vectors as arrays, read again."""
    emb = _embeddings(spark, sf)
    path, _ = _saved_model(spark, emb)
    save_predictions(batch_inference(emb, model_path=path), f"{path}/predictions")
    total = F.aggregate("probability", F.lit(0.0), lambda x, y: x + y)
    return spark.read.parquet(f"{path}/predictions").select("vec_id", "label_text",
                                                            (F.abs(total - 1) < 1e-9).alias("sums_to_one"))


def q_random_split_sizes(spark, sf):
    """M1: both parts of Spark's random split together are the table."""
    train, test = random_split(table(spark, sf, "lineitem"), (0.7, 0.3), 42)
    return train.unionByName(test)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "wide_table": q_wide_table,
    "wide_table_orders_customers": q_wide_table_orders_customers,
    "snapshot_changes": q_snapshot_changes,
    "unchanged_is_empty": q_unchanged_is_empty,
    "dense_row_number": q_dense_row_number,
    "dense_row_number_ts": q_dense_row_number_ts,
    "dense_row_number_text": q_dense_row_number_text,
    "dense_row_number_composite": q_dense_row_number_composite,
    "dense_row_number_range": q_dense_row_number_range,
    "audit_columns": q_audit_columns,
    "audit_columns_legacy": q_audit_columns_legacy,
    "wide_table_drop": q_wide_table_drop,
    "missing_columns": q_missing_columns,
    "append_union": q_append_union,
    "lake_append_read": q_lake_append_read,
    "lake_replace_read": q_lake_replace_read,
    "watermarks": q_watermarks,
    "latest_checkpoint": q_latest_checkpoint,
    "run_on_date": q_run_on_date,
    "run_counts": q_run_counts,
    "zone_paths": q_zone_paths,
    "promotion_candidates": q_promotion_candidates,
    "csv_roundtrip": q_csv_roundtrip,
    "text_lines": q_text_lines,
    "count_and_text": q_count_and_text,
    "local_rows": q_local_rows,
    "date_keys": q_date_keys,
    "run_details_json": q_run_details_json,
    "extract_first_load": q_extract_first_load,
    "extract_incremental": q_extract_incremental,
    "extract_incremental_at_scale": q_extract_incremental_at_scale,
    "extract_reverted_row": q_extract_reverted_row,
    "extract_deleted_source": q_extract_deleted_source,
    "extract_duplicate_key": q_extract_duplicate_key,
    "extract_null_key": q_extract_null_key,
    "extract_no_change": q_extract_no_change,
    "keyless_extract_promote": q_keyless_extract_promote,
    "lake_compacted": q_lake_compacted,
    "failed_run_logged": q_failed_run_logged,
    "current_state": q_current_state,
    "promote_first": q_promote_first,
    "promote_incremental": q_promote_incremental,
    "promote_reverted_row": q_promote_reverted_row,
    "promote_duplicate_key": q_promote_duplicate_key,
    "transform_load": q_transform_load,
    "transform_load_one_day": q_transform_load_one_day,
    "transform_load_current": q_transform_load_current,
    "transform_failed_logged": q_transform_failed_logged,
    "describe_numeric": q_describe_numeric,
    "row_counts": q_row_counts,
    "hash_split": q_hash_split,
    "hash_sample_limit": q_hash_sample_limit,
    "label_index": q_label_index,
    "label_decode": q_label_decode,
    "assembled_features": q_assembled_features,
    "confusion_matrix": q_confusion_matrix,
    "weighted_f1": q_weighted_f1,
    "lr_scored": q_lr_scored,
    "grid_metrics": q_grid_metrics,
    "batch_inference": q_batch_inference,
    "predictions_table": q_predictions_table,
    "random_split_sizes": q_random_split_sizes,
}


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB)
# ---------------------------------------------------------------------------

def _numbered(sql_from: str, day: str, alias: str = "n") -> str:
    return (f"SELECT {alias}.*, '{day}' AS CREATED_AT, '{day}' AS UPDATED_AT FROM "
            f"(SELECT s.*, row_number() OVER (ORDER BY o_orderkey) AS ROW_NUMBER FROM ({sql_from}) s) {alias}")


_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def _changed_join(new_sql: str, old_sql: str, day: str) -> str:
    """Rows of the numbered new snapshot whose business columns are not in old."""
    return (f"SELECT x.* FROM ({_numbered(new_sql, day)}) x SEMI JOIN "
            f"(SELECT {_ORDER_COLS} FROM ({new_sql}) a EXCEPT SELECT {_ORDER_COLS} FROM ({old_sql}) b) d "
            f"USING ({_ORDER_COLS})")


_RAISED = ("SELECT * REPLACE (CASE WHEN l_extendedprice = (SELECT max(l_extendedprice) FROM lineitem) "
           "THEN l_quantity + 1 ELSE l_quantity END AS l_quantity) FROM lineitem")
_NULL_KEY = "SELECT * REPLACE (CASE WHEN o_orderstatus <> 'F' THEN o_orderkey END AS o_orderkey) FROM ({})"

_LEDGER = f"(WITH l AS ({EVENTS_LEDGER_SQL}) SELECT * FROM l)"
_KEYS = "zone, db_name, table_name, action"
_DESCRIBE = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT({c}) AS \"count\", round(avg(CAST({c} AS DOUBLE)), 4) AS mean, "
    f"round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS stddev, min(CAST({c} AS DOUBLE)) AS \"min\", "
    f"max(CAST({c} AS DOUBLE)) AS \"max\" FROM lineitem" for c in LINEITEM_NUMERIC)
_RULE = ("SELECT CAST(l.quality AS DOUBLE) AS label, "
         "CAST(CASE WHEN d.n_chars >= 1000 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS prediction "
         "FROM labels l JOIN documents d USING (doc_id)")
_LABEL_INDEX = ("SELECT source, CAST(row_number() OVER (ORDER BY n DESC, source) - 1 AS DOUBLE) AS source_index "
                "FROM (SELECT source, COUNT(*) AS n FROM documents GROUP BY source)")
_HASH = "substring(md5(concat_ws('|', '{seed}', CAST(event_id AS VARCHAR))), 1, 8)"

ORACLE_SQL: dict[str, str] = {
    "wide_table": """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, l.l_extendedprice,
       o.o_orderdate, o.o_orderstatus, c.c_name, c.c_mktsegment, p.p_name, p.p_brand
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey""",
    "wide_table_orders_customers": """SELECT o.o_orderkey, o.o_orderdate, o.o_totalprice, o.o_custkey, c.c_name,
       c.c_mktsegment FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "snapshot_changes": f"SELECT * FROM orders EXCEPT SELECT * FROM ({OLD_ORDERS_SQL})",
    "unchanged_is_empty": "SELECT * FROM orders EXCEPT SELECT * FROM orders",
    "dense_row_number": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS ROW_NUMBER FROM orders",
    "dense_row_number_ts": "SELECT event_id, ts, row_number() OVER (ORDER BY ts) AS ROW_NUMBER FROM events",
    "dense_row_number_text": ("SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_name) AS ROW_NUMBER "
                              "FROM customer"),
    "dense_row_number_composite": ("SELECT event_id, user_id, row_number() OVER (ORDER BY user_id, event_id) "
                                   "AS ROW_NUMBER FROM events"),
    "dense_row_number_range": ("SELECT event_id, event_type, row_number() OVER (ORDER BY event_type, event_id) "
                               "AS ROW_NUMBER FROM events"),
    "audit_columns": f"SELECT *, '{DAY1}' AS CREATED_AT, '{DAY1}' AS UPDATED_AT FROM customer",
    "audit_columns_legacy": f"SELECT *, '{DAY1}' AS UPDATED_AT FROM customer",
    "wide_table_drop": ("SELECT o.*, c.* EXCLUDE (c_custkey, c_nationkey, c_acctbal) FROM orders o "
                        "JOIN customer c ON o_custkey = c_custkey"),
    "missing_columns": """SELECT load_mode, t AS table_name, c AS missing FROM (VALUES
  ('full_load', 'orders', 'o_custkey'), ('full_load', 'orders', 'o_comment'), ('full_load', 'customer', 'c_name'),
  ('full_load', 'nation', 'n_name'), ('full_load', 'nation', 'n_comment'), ('full_load', 'nation', 'n_code'),
  ('partial', 'region', 'r_code')) AS v(load_mode, t, c)
WHERE NOT EXISTS (SELECT 1 FROM information_schema.columns i WHERE i.table_name = t AND i.column_name = c)""",
    "append_union": (f"SELECT * FROM ({OLD_ORDERS_SQL}) UNION ALL "
                     f"(SELECT * FROM orders EXCEPT SELECT * FROM ({OLD_ORDERS_SQL}))"),
    "lake_append_read": "SELECT * FROM orders",
    "lake_replace_read": "SELECT * FROM orders",
    "watermarks": (f"SELECT {_KEYS}, COALESCE(MAX(CASE WHEN status = 'succeed' THEN last_row_number END), 0) "
                   f"AS watermark FROM {_LEDGER} GROUP BY {_KEYS}"),
    "latest_checkpoint": (f"SELECT {_KEYS}, arg_max(json_extract_string(details, '$.sink_path'), (job_end, run_id)) "
                          f"AS sink_path, max(job_end) AS job_end FROM {_LEDGER} WHERE status = 'succeed' "
                          f"GROUP BY {_KEYS}"),
    "run_on_date": (f"SELECT {_KEYS}, job_date, arg_max(last_row_number, (job_end, run_id)) AS last_row_number "
                    f"FROM {_LEDGER} WHERE status = 'succeed' GROUP BY {_KEYS}, job_date"),
    "run_counts": ("SELECT zone, db_name, table_name, job_date, COUNT(*) AS n_runs, "
                   "COUNT(CASE WHEN status = 'succeed' THEN 1 END) AS n_succeeded "
                   f"FROM {_LEDGER} GROUP BY zone, db_name, table_name, job_date"),
    "zone_paths": ("SELECT db_name, table_name, job_date, json_extract_string(details, '$.sink_path') AS sink_path, "
                   f"max(job_end) AS job_end FROM {_LEDGER} WHERE zone = 'raw' AND status = 'succeed' "
                   "GROUP BY db_name, table_name, job_date, sink_path"),
    "promotion_candidates": (
        "SELECT r.db_name, r.table_name, r.job_date, r.sink_path, "
        "EXISTS (SELECT 1 FROM " + _LEDGER + " s WHERE s.zone = 'staging' AND s.db_name = r.db_name "
        "AND s.table_name = r.table_name AND s.job_date = r.job_date) AS staged "
        "FROM (SELECT DISTINCT db_name, table_name, job_date, json_extract_string(details, '$.sink_path') AS sink_path "
        f"FROM {_LEDGER} WHERE zone = 'raw' AND status = 'succeed') r"),
    "csv_roundtrip": "SELECT * FROM part",
    "text_lines": "SELECT '(''' || c_name || ''', ' || CAST(c_custkey AS VARCHAR) || ')' AS value FROM customer",
    "count_and_text": ("SELECT '(' || CAST(p_partkey AS VARCHAR) || ', ' || chr(39) || p_name || chr(39) || ', ' || "
                       "CAST(p_retailprice AS VARCHAR) || ')' AS value, (SELECT COUNT(*) FROM part) AS n, "
                       "false AS written_again FROM part"),
    "local_rows": "SELECT n_name, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey",
    "date_keys": "SELECT year(ts) || '-' || month(ts) || '-' || day(ts) AS day, COUNT(*) AS n FROM events GROUP BY 1",
    "run_details_json": ("""SELECT event_id, '{"sink_path":"lake/' || event_type || '","rows":' || user_id || '}' """
                         "AS details, 'lake/' || event_type AS sink_path, user_id::BIGINT AS n_rows FROM events"),
    "extract_duplicate_key": f"SELECT * FROM ({_RAISED}) EXCEPT ALL SELECT * FROM lineitem",
    "extract_null_key": (f"SELECT n.* FROM ({_NULL_KEY.format('SELECT * FROM orders')}) n WHERE NOT EXISTS "
                         f"(SELECT 1 FROM ({_NULL_KEY.format(ALTERED_ORDERS_SQL)}) o WHERE "
                         + " AND ".join(f"n.{c} IS NOT DISTINCT FROM o.{c}" for c in _ORDER_COLS.split(", ")) + ")"),
    "extract_no_change": (f"SELECT 'orders' AS table_name, 'succeed' AS status, COUNT(*) AS last_row_number, "
                          f"DATE '{DAY1}' AS job_date FROM orders"),
    "keyless_extract_promote": (f"SELECT * FROM ({OLD_ORDERS_SQL}) UNION ALL "
                                f"(SELECT * FROM orders EXCEPT SELECT * FROM ({OLD_ORDERS_SQL}))"),
    "lake_compacted": "SELECT * FROM orders",
    "promote_duplicate_key": (f"SELECT * FROM lineitem UNION ALL (SELECT * FROM ({_RAISED}) "
                              "EXCEPT ALL SELECT * FROM lineitem)"),
    "transform_load_one_day": (
        f"SELECT o_orderkey, o_orderstatus, c_name FROM (SELECT * FROM orders EXCEPT SELECT * FROM ({OLD_ORDERS_SQL})) "
        "JOIN customer ON o_custkey = c_custkey"),
    "transform_load_current": ("SELECT o_orderkey, o_orderstatus, c_name FROM orders "
                               "JOIN customer ON o_custkey = c_custkey"),
    "lr_scored": ("SELECT vec_id, CAST(label AS VARCHAR) AS label_text, true AS is_argmax, true AS sums_to_one, "
                  "true AS label_decoded FROM embeddings "
                  "WHERE substring(md5(concat_ws('|', '42', CAST(vec_id AS VARCHAR))), 1, 8) >= 'b3333333'"),
    "batch_inference": ("SELECT vec_id, CAST(label AS VARCHAR) AS label_text, true AS is_argmax, true AS sums_to_one, "
                        "true AS label_decoded FROM embeddings"),
    "predictions_table": "SELECT vec_id, CAST(label AS VARCHAR) AS label_text, true AS sums_to_one FROM embeddings",
    "grid_metrics": ("SELECT CAST(i AS INTEGER) AS maxIter, CAST(r AS DOUBLE) AS regParam, true AS metric_in_range, "
                     "true AS f1_after_reload, true AS saved_is_best "
                     "FROM (VALUES (20), (30)) AS a(i), (VALUES (0.1), (0.01)) AS b(r)"),
    "random_split_sizes": "SELECT * FROM lineitem",
    "extract_first_load": _numbered("SELECT * FROM orders", DAY1),
    "extract_incremental": _changed_join("SELECT * FROM orders", OLD_ORDERS_SQL, DAY2),
    "extract_incremental_at_scale": _changed_join("SELECT * FROM orders", OLD_ORDERS_SQL, DAY2),
    "extract_reverted_row": _changed_join("SELECT * FROM orders", ALTERED_ORDERS_SQL, DAY3),
    "extract_deleted_source": (f"SELECT 'orders' AS table_name, 'succeed' AS status, COUNT(*) AS last_row_number, "
                               f"DATE '{DAY1}' AS job_date FROM orders"),
    "failed_run_logged": (
        f"SELECT 'orders' AS table_name, 'succeed' AS status, COUNT(*) AS last_row_number, DATE '{DAY1}' AS job_date, "
        "false AS has_error FROM orders UNION ALL "
        "SELECT 'customer', CASE WHEN COUNT(*) FILTER (WHERE c_acctbal < 0) > 0 THEN 'error' ELSE 'succeed' END, "
        f"COUNT(*), DATE '{DAY1}', COUNT(*) FILTER (WHERE c_acctbal < 0) > 0 FROM customer UNION ALL "
        f"SELECT 'supplier', 'error', 0, DATE '{DAY1}', true UNION ALL "
        f"SELECT 'nation', 'succeed', COUNT(*), DATE '{DAY1}', false FROM nation"),
    "current_state": "SELECT * FROM orders",
    "promote_first": _numbered("SELECT * FROM orders", DAY1),
    "promote_incremental": (f"SELECT * FROM ({_numbered(OLD_ORDERS_SQL, DAY1)}) UNION ALL "
                            f"SELECT * FROM ({_changed_join('SELECT * FROM orders', OLD_ORDERS_SQL, DAY1)})"),
    "promote_reverted_row": (f"SELECT * FROM ({_numbered('SELECT * FROM orders', DAY1)}) UNION ALL "
                             f"SELECT * FROM ({_changed_join(ALTERED_ORDERS_SQL, 'SELECT * FROM orders', DAY1)}) "
                             f"UNION ALL SELECT * FROM ({_changed_join('SELECT * FROM orders', ALTERED_ORDERS_SQL, DAY1)})"),
    "transform_load": """SELECT o.o_orderkey, o.o_orderdate, o.o_totalprice, o.o_orderstatus, c.c_name,
       c.c_mktsegment, c.c_nationkey, n.n_name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "transform_failed_logged": (
        "SELECT 'raw' AS zone, 'orders' AS table_name, 'extract' AS action, 'succeed' AS status, "
        "COUNT(*) AS last_row_number, false AS has_error FROM orders UNION ALL "
        "SELECT 'raw', 'customer', 'extract', 'succeed', COUNT(*), false FROM customer UNION ALL "
        "SELECT 'staging', 'orders', 'extract', 'succeed', COUNT(*), false FROM orders UNION ALL "
        "SELECT 'staging', 'customer', 'extract', 'succeed', COUNT(*), false FROM customer UNION ALL "
        "SELECT 'warehouse', CASE WHEN bad THEN '' ELSE 'orders_wide' END, 'transform', "
        "CASE WHEN bad THEN 'error' ELSE 'succeed' END, CASE WHEN bad THEN 0 ELSE n END, bad "
        "FROM (SELECT COUNT(*) FILTER (WHERE c.c_acctbal < 0) > 0 AS bad, COUNT(*) AS n "
        "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"),
    "describe_numeric": _DESCRIBE,
    "row_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in TABLES),
    "hash_split": (f"SELECT event_id, CAST(CASE WHEN {_HASH.format(seed=42)} < 'b3333333' THEN 0 ELSE 1 END AS INTEGER) "
                   "AS part FROM events"),
    "hash_sample_limit": (f"SELECT event_id, event_type, value FROM events WHERE {_HASH.format(seed=0)} < '1999999a' "
                          "ORDER BY event_id LIMIT 5"),
    "label_index": f"SELECT d.doc_id, d.source, r.source_index FROM documents d JOIN ({_LABEL_INDEX}) r USING (source)",
    "label_decode": (f"SELECT d.doc_id, d.source, r.source_index, d.source AS decoded FROM documents d "
                     f"JOIN ({_LABEL_INDEX}) r USING (source)"),
    "assembled_features": ("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS f0, l_extendedprice AS f1, "
                           "l_discount AS f2, l_tax AS f3 FROM lineitem"),
    "confusion_matrix": f"SELECT label, prediction, COUNT(*) AS n FROM ({_RULE}) GROUP BY label, prediction",
    "weighted_f1": f"""WITH cm AS (SELECT label, prediction, COUNT(*) AS n FROM ({_RULE}) GROUP BY label, prediction),
a AS (SELECT label, SUM(n) AS actual, SUM(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp FROM cm GROUP BY label),
p AS (SELECT prediction AS label, SUM(n) AS predicted FROM cm GROUP BY prediction)
SELECT round(SUM(a.actual * CASE WHEN a.tp > 0 THEN 2.0 * a.tp / (a.actual + COALESCE(p.predicted, 0)) ELSE 0.0 END)
             / SUM(a.actual), 10) AS f1
FROM a LEFT JOIN p USING (label)""",
}
