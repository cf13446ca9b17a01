"""Driver queries of changing schemas, typed contracts, key buckets and jobs over many tables, with their oracles.

As in ``queries.py`` every query reads whole tables, and planted faults follow from the rows' own
values by the same rule in Spark and in the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import json_field
from .operators.profile import describe
from .operators.sampling import bernoulli_sample
from .plans.extract import extract_table, run_extract
from .plans.promote import run_promote
from .queries import (ALTERED_ORDERS_SQL, DAY1, DAY2, DAY3, DB, LINEITEM_SPEC, OLD_ORDERS_SQL, ORDERS_SPEC, SCHEMA, _after_first_day,
                      _changed_join, _extract, _lake, _promote, _raised_top_price, _zone, altered_orders, old_orders, table)
from .session import scratch_dir
from .sources.files import CsvSource, FrameSource, ParquetSource
from .sources.lake import LakeTable
from .specs import QUARANTINE, TableSpec

PRIORITY = "1-URGENT"  # fixed value: what the contract fills an added column with


def _raw(spark, root, ledger, spec: TableSpec) -> LakeTable:
    return LakeTable(spark, ledger, root, "raw", spec.name, DB, SCHEMA, renames=spec.renames, fill=spec.fill)


def _two_days(spark, label: str, spec: TableSpec, first: DataFrame, second: DataFrame, columns) -> DataFrame:
    root, ledger = _lake(spark, label)
    _extract(spark, root, ledger, first, spec, DAY1)
    _extract(spark, root, ledger, second, spec, DAY2)
    written = _raw(spark, root, ledger, spec).read(with_batch_columns=True)
    return written.select(*columns, (F.col("ingest_date") > F.lit(DAY1).cast("date")).alias("later"))


def q_lake_added_column(spark, sf):
    """S3: the source adds a column on the second day.  Old rows read as null there, so every order with a priority changed."""
    orders = table(spark, sf, "orders")
    return _two_days(spark, "added_column", ORDERS_SPEC, old_orders(orders).drop("o_orderpriority"), orders, orders.columns)


def q_lake_filled_column(spark, sf):
    """As ``lake_added_column`` with a fill in the contract: orders that have the filled priority did not change."""
    orders = table(spark, sf, "orders")
    spec = replace(ORDERS_SPEC, fill={"o_orderpriority": PRIORITY})
    return _two_days(spark, "filled_column", spec, old_orders(orders).drop("o_orderpriority"), orders, orders.columns)


def q_lake_widened_column(spark, sf):
    """S3: a number grows from int to long and a date to a timestamp, and a column goes; only real changes are written."""
    orders = table(spark, sf, "orders")
    first = (old_orders(orders).withColumn("o_custkey", F.col("o_custkey").cast("int"))
             .withColumn("o_orderdate", F.to_date("o_orderdate")).withColumn("o_channel", F.lit(None).cast("string")))
    return _two_days(spark, "widened_column", ORDERS_SPEC, first, orders, [*orders.columns, "o_channel"])


def q_lake_renamed_column(spark, sf):
    """S3: a column has another name on the second day; the contract's rename keeps its history."""
    orders = table(spark, sf, "orders")
    spec = replace(ORDERS_SPEC, renames={"o_price": "o_totalprice"})
    return _two_days(spark, "renamed_column", spec, old_orders(orders).withColumnRenamed("o_totalprice", "o_price"), orders,
                     orders.columns)


def q_extract_unfit_type(spark, sf):
    """A price turns to text for a day.  That day ends as an error row; the table stays readable and the next day loads."""
    orders = table(spark, sf, "orders")
    root, ledger = _lake(spark, "unfit_type")
    as_text = orders.withColumn("o_totalprice", F.col("o_totalprice").cast("string"))
    for frame, day in ((old_orders(orders), DAY1), (as_text, DAY2), (orders, DAY3)):
        extract_table(spark, root, ledger, FrameSource("orders", frame), ORDERS_SPEC, db_name=DB, schema=SCHEMA, run_date=day)
    rows = _raw(spark, root, ledger, ORDERS_SPEC).read().agg(F.count(F.lit(1)).alias("rows_read"))
    runs = ledger.runs(zone="raw").select("job_date", "status", "last_row_number",
                                          json_field("details", "error_message").contains("o_totalprice").alias("names_column"))
    return runs.crossJoin(F.broadcast(rows))  # one row


FAULTY_SPEC = replace(ORDERS_SPEC, unique_key=True, on_broken=QUARANTINE, columns={
    "o_custkey": {"type": "bigint", "nullable": False}, "o_totalprice": {"type": "double"}})


def faulty_orders(orders: DataFrame) -> DataFrame:
    """Orders with planted faults: no customer where pending and of low priority, a price that is no number where open and urgent,
    finished ones of high priority twice."""
    faulty = (orders.withColumn("o_custkey", F.when(~((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")), F.col("o_custkey")))
              .withColumn("o_totalprice", F.when((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT"), F.lit("n/a"))
                          .otherwise(F.col("o_totalprice").cast("string"))))
    again = faulty.where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "2-HIGH")).withColumn("o_orderpriority", F.lit("copy"))
    return faulty.unionByName(again)


_FAULTY_SQL = """(WITH f AS (SELECT o_orderkey, CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW') THEN o_custkey END AS o_custkey,
    o_orderstatus, o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' AS no_price, o_totalprice, o_orderpriority FROM orders)
  SELECT * FROM f UNION ALL
  SELECT * REPLACE ('copy' AS o_orderpriority) FROM f WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH')"""
_REASONS_SQL = f"""(SELECT *, concat_ws(';', CASE WHEN no_price THEN 'type:o_totalprice' END, CASE WHEN o_custkey IS NULL THEN 'null:o_custkey' END,
    CASE WHEN count(*) OVER (PARTITION BY o_orderkey) > 1 THEN 'key:repeated' END) AS reasons FROM {_FAULTY_SQL})"""


def q_extract_typed_contract(spark, sf):
    """Types, nulls and keys of a contract with planted faults, the same snapshot twice: sound rows once in raw, in their
    types, and the others once in the side table with their reasons."""
    orders = table(spark, sf, "orders")
    root, ledger = _lake(spark, "typed_contract")
    for day in (DAY1, DAY2):
        _extract(spark, root, ledger, faulty_orders(orders), FAULTY_SPEC, day)
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    good = _raw(spark, root, ledger, FAULTY_SPEC).read().select(*columns, F.lit("").alias("reasons"))
    side = _zone(spark, root, ledger, "rejected", FAULTY_SPEC).read()
    row = F.from_json("row", "o_orderkey long, o_custkey long, o_totalprice string, o_orderpriority string")
    broken = side.select(row.alias("r"), F.array_join("reasons", ";").alias("reasons"))
    return good.unionByName(broken.select("r.o_orderkey", "r.o_custkey", F.col("r.o_totalprice").try_cast("double").alias("o_totalprice"),
                                          "r.o_orderpriority", "reasons"))


def q_extract_contract_rejected(spark, sf):
    """The same faults under a contract that rejects the run: one error row with the rows of each reason."""
    root, ledger = _lake(spark, "contract_rejected")
    extract_table(spark, root, ledger, FrameSource("orders", faulty_orders(table(spark, sf, "orders"))),
                  replace(FAULTY_SPEC, on_broken="reject"), db_name=DB, schema=SCHEMA, run_date=DAY1)
    counts = F.from_json(json_field("details", "broken"), "map<string,long>")
    return ledger.runs(zone="raw").select("status", "last_row_number", F.explode(counts).alias("reason", "n_rows"))


def q_extract_malformed_csv(spark, sf):
    """Customers as CSV lines, those in debt without their last field: sound lines load, the others are kept as they came."""
    customer = table(spark, sf, "customer")
    path = scratch_dir(spark, "csv") + "/customer"
    last = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal")], last)
    customer.select(line.alias("value")).write.text(path)
    spec = TableSpec("customer", required_columns=("c_name",), primary_key=("c_custkey",), on_broken=QUARANTINE)
    root, ledger = _lake(spark, "malformed_csv")
    source = CsvSource("customer", path, "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string", header=False)
    extract_table(spark, root, ledger, source, spec, db_name=DB, schema=SCHEMA, run_date=DAY1)
    good = _raw(spark, root, ledger, spec).read().select("c_custkey", "c_name", "c_mktsegment", F.lit(None).cast("string").alias("line"))
    side = _zone(spark, root, ledger, "rejected", spec).read()
    none = F.lit(None)
    return good.unionByName(side.select(none.cast("long").alias("c_custkey"), none.cast("string").alias("c_name"),
                                        none.cast("string").alias("c_mktsegment"), F.col("row").alias("line")))


BUCKETED_ORDERS = replace(ORDERS_SPEC, buckets=16)


def _bucketed(spark, label: str, first: DataFrame, later: list[tuple[DataFrame, str]]) -> LakeTable:
    """A first load, its state written bucketed, and later days."""
    root, ledger = _lake(spark, label)
    _extract(spark, root, ledger, first, BUCKETED_ORDERS, DAY1)
    raw = _raw(spark, root, ledger, BUCKETED_ORDERS)
    raw.compact(DAY1, BUCKETED_ORDERS.primary_key, BUCKETED_ORDERS.buckets)
    for frame, day in later:
        _extract(spark, root, ledger, frame, BUCKETED_ORDERS, day)
    return raw


def q_extract_bucketed_state(spark, sf):
    """``extract_incremental`` against a bucketed state, then a day that reverts it: what the last day wrote."""
    orders = table(spark, sf, "orders")
    raw = _bucketed(spark, "bucketed_state", orders, [(altered_orders(orders), DAY2), (orders, DAY3)])
    return raw.read(job_date=DAY3)


def q_extract_changed_buckets(spark, sf):
    """One order changed, then none: what the later days wrote.  Only that order's bucket of the state is read."""
    orders = table(spark, sf, "orders")
    newest = orders.agg(F.max("o_orderkey")).scalar()
    before = orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") == newest, F.lit("?")).otherwise(F.col("o_orderstatus")))
    raw = _bucketed(spark, "changed_buckets", before, [(orders, DAY2), (orders, DAY3)])
    return _after_first_day(raw, orders.columns)


def q_promote_pending_duplicate_key(spark, sf):
    """A staged table whose key repeats, then three raw batches of that day promoted in one pass: staging."""
    lines = table(spark, sf, "lineitem")
    root, ledger = _lake(spark, "promote_pending")
    _extract(spark, root, ledger, lines, LINEITEM_SPEC, DAY1)
    _promote(spark, root, ledger, LINEITEM_SPEC, DAY1)
    frame = lines
    for _ in range(3):
        frame = _raised_top_price(frame)
        _extract(spark, root, ledger, frame, LINEITEM_SPEC, DAY1)
    _promote(spark, root, ledger, LINEITEM_SPEC, DAY1)
    return _zone(spark, root, ledger, "staging", LINEITEM_SPEC).read().select(*lines.columns)


MANY = {"region": ("r_regionkey", "r_name"), "nation": ("n_nationkey", "n_name"), "customer": ("c_custkey", "c_name"),
        "supplier": ("s_suppkey", "s_name"), "part": ("p_partkey", "p_name"), "orders": ("o_orderkey", "o_orderdate"),
        "events": ("event_id", "ts"), "documents": ("doc_id", "text")}


def q_extract_many_tables(spark, sf):
    """Eight tables extracted and promoted, four at a time: the ledger's rows."""
    specs = {t: TableSpec(t, required_columns=(c,), primary_key=(k,)) for t, (k, c) in MANY.items()}
    sources = {t: ParquetSource(t, f"{sf.rstrip('/')}/{t}.parquet") for t in MANY}
    root, ledger = _lake(spark, "many_tables")
    run_extract(spark, root, ledger, sources, specs, db_name=DB, schema=SCHEMA, run_date=DAY1, parallel=4)
    run_promote(spark, root, ledger, db_name=DB, schema=SCHEMA, job_date=DAY1, specs=specs, parallel=4)
    return ledger.frame().select("zone", "table_name", "status", "last_row_number", "job_date")


def q_describe_text(spark, sf):
    """A8 for text columns: Spark's summary, mean and deviation null."""
    return describe(table(spark, sf, "customer"), "c_name", "c_mktsegment")


def q_bernoulli_sample(spark, sf):
    """M2: Spark's sample of a tenth has rows of the table only, none twice, and about a tenth of them (six deviations)."""
    events = table(spark, sf, "events")
    some = bernoulli_sample(events, 0.1, 0)
    facts = some.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("d"))
    inside = some.join(events.select("event_id"), "event_id", "left_anti").agg(F.count(F.lit(1)).alias("strange"))
    total = events.agg(F.count(F.lit(1)).alias("t"))
    near = F.abs(F.col("n") - F.col("t") * 0.1) < 6 * F.sqrt(F.col("t") * 0.09)
    return (facts.crossJoin(inside).crossJoin(total)  # one row each
            .select("t", (F.col("n") == F.col("d")).alias("distinct_rows"), (F.col("strange") == 0).alias("of_the_table"), near.alias("about_a_tenth")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "lake_added_column": q_lake_added_column,
    "lake_filled_column": q_lake_filled_column,
    "lake_widened_column": q_lake_widened_column,
    "lake_renamed_column": q_lake_renamed_column,
    "extract_unfit_type": q_extract_unfit_type,
    "extract_typed_contract": q_extract_typed_contract,
    "extract_contract_rejected": q_extract_contract_rejected,
    "extract_malformed_csv": q_extract_malformed_csv,
    "extract_bucketed_state": q_extract_bucketed_state,
    "extract_changed_buckets": q_extract_changed_buckets,
    "promote_pending_duplicate_key": q_promote_pending_duplicate_key,
    "extract_many_tables": q_extract_many_tables,
    "describe_text": q_describe_text,
    "bernoulli_sample": q_bernoulli_sample,
}


def _later_sql(old: str, columns: str = "*") -> str:
    """Rows of the first day, then the orders that are not among them."""
    return (f"SELECT {columns}, false AS later FROM ({old}) UNION ALL SELECT {columns}, true FROM "
            f"(SELECT * FROM orders EXCEPT SELECT * FROM ({old}))")


_OLD_WITHOUT = f"SELECT * REPLACE (NULL::VARCHAR AS o_orderpriority) FROM ({OLD_ORDERS_SQL})"
_OLD_FILLED = f"SELECT * REPLACE ('{PRIORITY}' AS o_orderpriority) FROM ({OLD_ORDERS_SQL})"
_RAISED = ("SELECT * REPLACE (CASE WHEN l_extendedprice = (SELECT max(l_extendedprice) FROM lineitem) "
           "THEN l_quantity + {} ELSE l_quantity END AS l_quantity) FROM lineitem")

ORACLE_SQL: dict[str, str] = {
    "lake_added_column": _later_sql(_OLD_WITHOUT),
    "lake_filled_column": _later_sql(_OLD_FILLED),
    "lake_widened_column": _later_sql(f"SELECT * REPLACE (o_orderdate::DATE::TIMESTAMP AS o_orderdate) FROM ({OLD_ORDERS_SQL})",
                                      "*, NULL::VARCHAR AS o_channel"),
    "lake_renamed_column": _later_sql(OLD_ORDERS_SQL),
    "extract_unfit_type": f"""
WITH o AS ({OLD_ORDERS_SQL}), c AS (SELECT * FROM orders EXCEPT SELECT * FROM o),
t AS (SELECT (SELECT count(*) FROM o) + (SELECT count(*) FROM c) AS rows_read)
SELECT DATE '{DAY1}' AS job_date, 'succeed' AS status, (SELECT count(*) FROM o) AS last_row_number, NULL::BOOLEAN AS names_column, rows_read FROM t
UNION ALL SELECT DATE '{DAY2}', 'error', (SELECT count(*) FROM orders), true, rows_read FROM t
UNION ALL SELECT DATE '{DAY3}', 'succeed', (SELECT count(*) FROM orders), NULL, rows_read FROM t""",
    "extract_typed_contract": ("SELECT o_orderkey, o_custkey, CASE WHEN NOT no_price THEN o_totalprice END AS o_totalprice, "
                               f"o_orderpriority, reasons FROM {_REASONS_SQL}"),
    "extract_contract_rejected": (f"SELECT 'error' AS status, (SELECT count(*) FROM {_FAULTY_SQL}) AS last_row_number, reason, count(*) AS n_rows "
                                  f"FROM (SELECT unnest(string_split(reasons, ';')) AS reason FROM {_REASONS_SQL} WHERE reasons <> '') "
                                  "GROUP BY reason"),
    "extract_malformed_csv": (
        "SELECT c_custkey, c_name, c_mktsegment, NULL::VARCHAR AS line FROM customer WHERE c_acctbal >= 0 UNION ALL "
        "SELECT NULL, NULL, NULL, concat_ws(',', c_custkey, c_name, c_nationkey, c_acctbal) FROM customer WHERE NOT c_acctbal >= 0"),
    "extract_bucketed_state": _changed_join("SELECT * FROM orders", ALTERED_ORDERS_SQL, DAY3),
    "extract_changed_buckets": "SELECT * FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)",
    "promote_pending_duplicate_key": ("SELECT * FROM lineitem" + "".join(
        f" UNION ALL (SELECT * FROM ({_RAISED.format(i)}) EXCEPT ALL SELECT * FROM ({_RAISED.format(i - 1)}))" for i in (1, 2, 3))),
    "extract_many_tables": " UNION ALL ".join(
        f"SELECT '{z}' AS zone, '{t}' AS table_name, 'succeed' AS status, count(*) AS last_row_number, DATE '{DAY1}' AS job_date FROM {t}"
        for t in MANY for z in ("raw", "staging")),
    "describe_text": " UNION ALL ".join(
        f"SELECT '{name}' AS summary, " + ", ".join(f"{what} AS {c}".replace("{}", c) for c in ("c_name", "c_mktsegment")) + " FROM customer"
        for name, what in (("count", "count({})::VARCHAR"), ("mean", "max(NULL::VARCHAR)"), ("stddev", "max(NULL::VARCHAR)"),
                           ("min", "min({})"), ("max", "max({})"))),
    "bernoulli_sample": "SELECT count(*) AS t, true AS distinct_rows, true AS of_the_table, true AS about_a_tenth FROM events",
}
