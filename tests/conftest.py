from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from lakezones.session import ensure_checkpoint_dir

    s = (SparkSession.builder.master("local[*]")
         .appName("lakezones-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def lake(spark):
    """A fresh lake root and ledger in a new folder."""
    from lakezones.operators.ledger import Ledger
    from lakezones.session import scratch_dir

    root = scratch_dir(spark, "test")
    return root, Ledger(spark, f"{root}/_ledger")


# Invented rows with the reference's table shapes (customers / orders / products).
CUSTOMERS = [(1001, "Ada", "Lovelace", "ada@example.org"), (1002, "Alan", "Turing", "alan@example.org"),
             (1003, "Grace", "Hopper", "grace@example.org"), (1004, "Edsger", "Dijkstra", "edsger@example.org")]
ORDERS = [(10001, dt.date(2016, 1, 16), 1001, 1, 102), (10002, dt.date(2016, 1, 17), 1002, 2, 105),
          (10003, dt.date(2016, 2, 19), 1002, 2, 106), (10004, dt.date(2016, 2, 21), 1003, 1, 107)]
NEW_ORDER = (10005, dt.date(2024, 2, 21), 1003, 4, 102)
PRODUCTS = [(100 + i, f"item-{i}", f"invented product number {i}", round(0.1 + 2.6 * (i - 1) + (i == 9) * 1.3, 2))
            for i in range(1, 10)]

CUSTOMERS_SCHEMA = "id int, first_name string, last_name string, email string"
ORDERS_SCHEMA = "id int, order_date date, purchaser int, quantity int, product_id int"
PRODUCTS_SCHEMA = "id int, name string, description string, weight double"
