"""Key buckets of a table: a bucketed current state, and digests that tell which buckets changed.

The current state of a table can be written bucketed and sorted by its key (``LakeTable.compact``).  A diff then
shuffles the new snapshot by key into as many parts, and the state not at all; batches committed after the state
was written are a small third side.

Each run may also keep one digest for every bucket of the snapshot it saw: row count and two sums of 64-bit row hashes, which do not
depend on the order of rows.  The next run computes them in one aggregate without a full-row shuffle.  A bucket
whose digest did not move holds the rows it held, so only the others are compared, and of a bucketed state only
the files of those buckets are read.  (A changed bucket goes unseen if both sums and the count agree by chance: about
2^-128.)
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, MapType, StructType

from .changes import row_key

BUCKET = "__bucket"
_NEWEST, _STORED = "__newest", "__stored"
_SALT = "second sum"
_BUCKET_FILE = re.compile(r"_(\d+)(?:\.[^/]*)?$")  # as Spark names the files of a bucket


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    """The bucket Spark's bucketed writer puts a key into."""
    return F.pmod(F.hash(*[F.col(c) for c in key]), F.lit(buckets))


def signature(schema: StructType, columns: Sequence[str], key: Sequence[str], buckets: int) -> dict:
    """What digests depend on; those of another signature cannot be compared."""
    return {"buckets": buckets, "key": list(key), "columns": [[c, schema[c].dataType.simpleString()] for c in sorted(columns)]}


def can_digest(schema: StructType, columns: Sequence[str]) -> bool:
    return not any("map<" in schema[c].dataType.simpleString() or isinstance(schema[c].dataType, MapType) for c in columns)


def bucket_digests(df: DataFrame, columns: Sequence[str], key: Sequence[str], buckets: int) -> DataFrame:
    """``bucket, n, a, b`` for every bucket that has rows; combined before the shuffle, at most ``buckets`` rows."""
    def plain(c: str) -> Column:  # -0.0 and 0.0 are equal, as in the diff
        kind = df.schema[c].dataType
        return F.col(f"`{c}`") + F.lit(0.0).cast(kind) if isinstance(kind, (DoubleType, FloatType)) else F.col(f"`{c}`")

    names = sorted(columns)
    # the hash passes over nulls, so which values are null is hashed as well
    values = [*(plain(c) for c in names), *(F.col(f"`{c}`").isNull() for c in names)]
    wide = "decimal(38,0)"
    rows = df.select(bucket_of(key, buckets).alias("bucket"), F.xxhash64(*values).alias("a"), F.xxhash64(F.lit(_SALT), *values).alias("b"))
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("a").cast("decimal(20,0)")).cast(wide).alias("a"),
                                      F.sum(F.col("b").cast("decimal(20,0)")).cast(wide).alias("b"))


def moved_buckets(now: DataFrame, before: DataFrame) -> list[int]:
    """Buckets whose digests differ (at most as many as there are buckets).  Buckets without rows now have no new rows."""
    met = now.alias("n").join(before.alias("o"), F.col("n.bucket") == F.col("o.bucket"), "left")
    same = (F.col("n.n") == F.col("o.n")) & (F.col("n.a") == F.col("o.a")) & (F.col("n.b") == F.col("o.b"))
    return sorted(r[0] for r in met.where(~F.coalesce(same, F.lit(False))).select("n.bucket").collect())


def write_bucketed(df: DataFrame, path: str, key: Sequence[str], buckets: int, fmt: str = "parquet") -> None:
    """Write ``df`` bucketed and sorted by ``key`` into a new folder, one file a bucket."""
    name = _table_name(path, "w")
    spark = df.sparkSession
    try:
        (df.repartition(buckets, *key).write.format(fmt).bucketBy(buckets, *key).sortBy(*key).option("path", path)
         .mode("errorifexists").saveAsTable(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay: the table is external


def _table_name(path: str, what: str) -> str:
    return f"lakezones_{what}_" + re.sub(r"[^0-9A-Za-z]+", "_", path.rstrip("/").rsplit("/", 1)[-1]).lower()


class BucketedState:
    """A bucketed state as a frame that joins by key without a shuffle.  Spark takes bucketing from a catalog, so an external table stands for the
    folder while the state is in use (``with``)."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: Sequence[str], buckets: int, fmt: str = "parquet"):
        self.spark, self.path, self.schema, self.key, self.buckets, self.fmt = spark, path, schema, list(key), buckets, fmt
        self.name = _table_name(path, "r")

    def __enter__(self) -> "BucketedState":
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        key = ", ".join(f"`{c}`" for c in self.key)
        where = self.path.replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING {self.fmt} CLUSTERED BY ({key}) SORTED BY ({key}) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{where}'")
        return self

    def __exit__(self, *_) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def files(self, buckets: Sequence[int]) -> list[str]:
        """Files of some buckets: one listing of the folder."""
        wanted, hpath = set(buckets), self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = []
        for status in fs.listStatus(hpath):
            m = _BUCKET_FILE.search(str(status.getPath().getName()))
            if m and not str(status.getPath().getName()).startswith(("_", ".")) and int(m[1]) in wanted:
                found.append(str(status.getPath().toString()))
        return found

    def rows_of(self, buckets: Sequence[int]) -> DataFrame:
        """Rows of some buckets; no other file is opened."""
        files = self.files(buckets)
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.format(self.fmt).schema(self.schema).load(files)


def changed_by_state(new: DataFrame, state: DataFrame | None, later: DataFrame | None, columns: Sequence[str],
                     key: Sequence[str]) -> DataFrame:
    """Rows of ``new`` (key unique and non-null) that differ from their key's newest row: that of ``later`` if it has one, else that
    of ``state`` (one row a key each; both have ``columns``).  A bucketed ``state`` is not shuffled."""
    out, own, sides = new, row_key(new, columns), []
    for side, name in ((state, _STORED), (later, _NEWEST)):
        if side is not None:
            out = out.join(side.select(*key, row_key(side, columns).alias(name)), list(key), "left")
            sides.insert(0, name)
    if not sides:
        return new
    known = F.coalesce(*[F.col(c) for c in sides])
    return out.where(known.isNull() | (own != known)).select(*new.columns)
