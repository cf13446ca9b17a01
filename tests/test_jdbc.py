"""JDBC sources are built from options only; no database runs in the tests
(none may be started here), so these check the options Spark receives."""

import datetime as dt
from types import SimpleNamespace

import duckdb
import pytest

from lakezones.sources import jdbc
from lakezones.sources.files import JdbcSource
from lakezones.sources.jdbc import (JdbcConnection, boundary_sql, query_options, range_predicates, sql_literal,
                                    table_options)

CONN = JdbcConnection(url="jdbc:postgresql://db.example:5432/inventory", driver="org.postgresql.Driver",
                      user="reader", password="secret")


def test_table_options_partitioned():
    opts = table_options(CONN, "inventory.orders", partition_column="id", lower_bound=1, upper_bound=1000,
                         num_partitions=4, fetch_size=5000)
    assert opts["dbtable"] == "inventory.orders"
    assert (opts["partitionColumn"], opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == \
        ("id", "1", "1000", "4")
    assert opts["fetchsize"] == "5000" and opts["driver"] == "org.postgresql.Driver"


def test_partitioned_read_needs_bounds():
    with pytest.raises(ValueError):
        table_options(CONN, "t", partition_column="id", num_partitions=4)


def test_query_options_and_secret_hiding():
    opts = query_options(CONN, "SELECT COUNT(*) AS n FROM inventory.orders")
    assert opts["query"].startswith("SELECT COUNT(*)") and "dbtable" not in opts
    assert "secret" not in repr(CONN) and "reader" not in repr(CONN)


def test_jdbc_source_is_snapshotted():
    assert JdbcSource("orders", CONN, "inventory.orders").stable is False


@pytest.mark.parametrize("low,ranges", [(1, "8"), ("a", None), (None, None)])
def test_numeric_keys_are_read_in_ranges(monkeypatch, low, ranges):
    """Several partitions by default where the key is a number; bounds come from the database."""
    from types import SimpleNamespace

    from lakezones.sources import jdbc

    seen = {}
    reader = SimpleNamespace(options=lambda **o: seen.update(o) or SimpleNamespace(load=lambda: "frame"))
    spark = SimpleNamespace(read=SimpleNamespace(format=lambda kind: reader))
    monkeypatch.setattr(jdbc, "read_query", lambda *a: SimpleNamespace(first=lambda: {"lo": low, "hi": low and low * 9}))
    assert jdbc.read_table(spark, CONN, "t", partition_column="id") == "frame"
    assert seen.get("numPartitions") == ranges and ("partitionColumn" in seen) == (ranges is not None)


KEYS = {"text": ["it's", "", "a", "B", "b", "z", "\u00e9"] * 3 + [f"k{i:03d}" for i in range(200)] + [None] * 5,
        "number": [i * i for i in range(300)] + [7] * 100 + [None],
        "one key": ["same"] * 50, "few": [3, 1], "none": [None, None]}


@pytest.mark.parametrize("kind", KEYS)
def test_even_ranges_hold_every_row_once(kind):
    """The pushed-down statement and the predicates, evaluated in this process."""
    keys = KEYS[kind]
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t (k {'VARCHAR' if any(isinstance(k, str) for k in keys) else 'BIGINT'})")
    con.executemany("INSERT INTO t VALUES (?)", [(k,) for k in keys])
    starts = [k for _, k in sorted(con.sql(boundary_sql("t", "k", 8)).fetchall())]
    parts = range_predicates("k", starts)
    sizes = [con.sql(f"SELECT count(*) FROM t WHERE {p}").fetchall()[0][0] for p in parts]
    fits = " + ".join(f"(CASE WHEN {p} THEN 1 ELSE 0 END)" for p in parts)
    assert sum(sizes) == len(keys) and con.sql(f"SELECT count(*) FROM t WHERE ({fits}) <> 1").fetchall()[0][0] == 0
    if kind == "text":
        assert len(parts) == 8 and max(sizes) <= 2 * len(keys) / 8
    if kind in ("one key", "none"):
        assert parts == ["1 = 1"]


def test_even_ranges_reach_the_reader(monkeypatch):
    seen = {}
    spark = SimpleNamespace(read=SimpleNamespace(jdbc=lambda url, table, **o: seen.update(o, url=url, table=table) or "frame"))
    asked = []
    rows = [(3, "t"), (1, "a"), (2, "m")]  # in any order
    monkeypatch.setattr(jdbc, "read_query", lambda s, c, sql: asked.append(sql) or SimpleNamespace(collect=lambda: rows))
    assert JdbcSource("t", CONN, "s.t", partition_column="k", num_partitions=3, even=True).read(spark) == "frame"
    assert asked == [boundary_sql("s.t", "k", 3)] and seen["table"] == "s.t" and seen["url"] == CONN.url
    assert seen["predicates"] == ["k < 'm' OR k IS NULL", "k >= 'm' AND k < 't'", "k >= 't'"]
    assert seen["properties"]["user"] == "reader" and "dbtable" not in seen["properties"] and "url" not in seen["properties"]


def test_literals():
    assert sql_literal("a'b") == "'a''b'" and sql_literal(dt.date(2024, 2, 1)) == "DATE '2024-02-01'" and sql_literal(5) == "5"
    assert sql_literal(dt.datetime(2024, 2, 1, 3, 4, 5)) == "TIMESTAMP '2024-02-01 03:04:05'"
    with pytest.raises(TypeError):
        sql_literal(b"x")
