"""Source divergence audit: how the words of each source differ from its language and from its other sources.

Counts are made exactly: terms are counted in the tasks that read the texts and summed by Spark.  All that a
term's value depends on is its count in the group and in the language, so terms are grouped into cells of these
two, ``f`` is evaluated once a cell, and a cell stays only if fewer terms than asked for
lie in cells of greater value.  Cells of one value count as one.  The terms of the cells that stay are
ranked by value and their UTF-8 bytes; every task sends on its best ones only.

Values of two sources are sums over all terms.  Where one of them lacks a term only the other's count
matters, so those come from the sources' histograms of counts; the terms that both have are summed in parts of a
bounded number of rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch_tables, slices, stored

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
SLICE_BYTES = 4 << 20
HELD_TERMS = 300_000  # a task sends its counts on when it holds as many
PART_ROWS = 200_000  # rows of counts in a part of the pair sums

_OTHER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _words(text: str) -> Iterator[list[bytes]]:
    """Terms of a text, a few MB at a time."""
    raw, at = text.encode().translate(_OTHER), 0
    while len(raw) - at > SLICE_BYTES:
        cut = raw.rfind(b" ", at, at + SLICE_BYTES)
        if cut < 0:
            cut = raw.find(b" ", at + SLICE_BYTES)
        if cut < 0:
            break
        yield raw[at:cut].split()
        at = cut + 1
    yield (raw[at:] if at else raw).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of every term in every group; null text, lang and source count as ''."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs_with) in held.items():
                terms = pa.array(list(n), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()), terms,
                                                  pa.array(list(n.values()), pa.int64()), pa.array([docs_with[t] for t in n], pa.int64())],
                                                 schema=schema)
            held.clear()

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                for lang, source, text in zip(*(part[c].to_pylist() for c in ("lang", "source", "text"))):
                    n, docs_with = held.setdefault((lang, source), (Counter(), Counter()))
                    seen: set[bytes] = set()
                    for words in _words(text):
                        n.update(words)
                        seen.update(words)
                    docs_with.update(seen)
                if sum(len(n) for n, _ in held.values()) > HELD_TERMS:
                    yield from flush()
        yield from flush()

    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    parts = docs.select(*text).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: str, total: str) -> Column:
    """p of a count: exact, however large the counts."""
    return F.expr(f"1L + (cast({SCALE} as decimal(20,0)) * cast({count} + 2 as decimal(18,0))) div cast({total} + 2 * terms as decimal(38,0))")


def share(count: np.ndarray, total: int, terms: int) -> np.ndarray:
    """The same in numpy; large counts as Python integers."""
    if len(count) and int(count.max()) + 2 > (1 << 62) // SCALE:
        return np.array([1 + SCALE * (int(c) + 2) // (total + 2 * terms) for c in count], np.int64)
    return 1 + SCALE * (count + 2) // (total + 2 * terms)


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _pair_parts(group: pa.Table) -> pa.Table:
    """Sums over a part's terms that two sources share, beyond what the sources' histograms say: ``lang, a, b, value``."""
    lang, terms = group["lang"][0].as_py(), group["terms"][0].as_py()
    sources, source = np.unique(group["source"].to_numpy(zero_copy_only=False).astype(object), return_inverse=True)
    totals = np.zeros(len(sources), object)
    totals[source] = group["total"].to_pylist()
    count = group["n"].to_numpy()
    p = np.empty(len(count), np.int64)
    zero = np.empty(len(sources), np.int64)
    for s, total in enumerate(totals):
        p[source == s] = share(count[source == s], total, terms)
        zero[s] = share(np.zeros(1, np.int64), total, terms)[0]
    _, term = np.unique(group["term"].to_numpy(zero_copy_only=False).astype(object), return_inverse=True)
    order = np.lexsort((source, term))
    term, source, p = term[order], source[order], p[order]
    sums: dict[int, int] = {}
    alive = np.arange(len(term))
    for step in range(1, len(sources)):  # each row with the one ``step`` places on, if that is of the same term
        alive = alive[alive + step < len(term)]
        alive = alive[term[alive] == term[alive + step]]
        if not len(alive):
            break
        a, b = source[alive], source[alive + step]
        x, y = p[alive], p[alive + step]
        value = distance(x, y) - distance(x, zero[b]) - distance(zero[a], y) + distance(zero[a], zero[b])
        pair, which = np.unique(a * len(sources) + b, return_inverse=True)
        total = np.zeros(len(pair), np.int64)
        np.add.at(total, which, value)
        for k, v in zip(pair.tolist(), total.tolist()):
            sums[k] = sums.get(k, 0) + v
    pairs = list(sums)
    return pa.table({"lang": pa.array([lang] * len(pairs), pa.string()), "a": pa.array([sources[k // len(sources)] for k in pairs], pa.string()),
                     "b": pa.array([sources[k % len(sources)] for k in pairs], pa.string()), "value": pa.array(list(sums.values()), pa.int64())})


def _pair_bases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each source and each other one of its language: the sums where the other has no count, by the histogram."""
    schema = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])
    for batch in batches:
        for row in batch.to_pylist():
            out, terms = [], row["terms"]
            cells = row["cells"] or []
            if terms:
                p = share(np.array([c["n"] for c in cells], np.int64), row["total"], terms)
                times = np.array([c["m"] for c in cells], np.int64)
                zero = share(np.zeros(1, np.int64), row["total"], terms)
            for other in row["others"]:
                if other["source"] == row["source"]:
                    continue
                value = 0
                if terms:
                    q = share(np.zeros(1, np.int64), other["total"], terms)
                    both = int(distance(zero, q)[0])
                    value = int((times * (distance(p, q) - both)).sum())
                    if row["source"] < other["source"]:
                        value += terms * both  # once a pair
                a, b = sorted((row["source"], other["source"]))
                out.append({"lang": row["lang"], "a": a, "b": b, "value": value})
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every group of lang and source.

    Part ``pair`` has every other source of the language by its distance, part ``term`` the ``top`` terms that the group
    has more of than its language.  Null and empty texts have no terms but their group occurs; repeated rows and rows
    that share a doc_id count each; equal values rank by UTF-8 bytes.  An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    with scratch_tables(spark):
        empty = F.lit("")
        groups = stored(docs.select(F.coalesce(F.col("lang").cast("string"), empty).alias("lang"),
                                    F.coalesce(F.col("source").cast("string"), empty).alias("source")).distinct(), "audit-groups")
        counts = stored(term_counts(docs), "audit-counts")
        kept = stored(counts.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs"))
                      .where(F.col("docs") >= min_docs).select("lang", "term", "all_n"), "audit-kept")
        counts = stored(counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "audit-kept-counts")
        langs = kept.groupBy("lang").agg(F.sum("all_n").alias("all_total"), F.count("*").alias("terms"))
        sources = groups.join(langs, "lang", "left").join(
            counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("rows")), ["lang", "source"], "left")
        sources = stored(sources.na.fill(0, ["all_total", "terms", "total", "rows"]), "audit-sources")
        found = stored(_pairs(counts, sources).unionByName(_terms(counts, sources, top)), "audit", keep=True)
    return found


def _terms(counts: DataFrame, sources: DataFrame, top: int) -> DataFrame:
    group = ["lang", "source"]
    by_value = Window.partitionBy(*group).orderBy(F.desc("value"))
    cells = counts.groupBy(*group, "n", "all_n").agg(F.count("*").alias("m")).join(sources, group)
    cells = (cells.withColumn("p", _share("n", "total")).withColumn("q", _share("all_n", "all_total")).where("p > q")
             .withColumn("value", F.expr("(p - q) * (p - q) div (p + q)")))
    best = cells.select(*group, "n", "all_n", "m", "value").withColumn("r", F.rank().over(by_value)).where(F.col("r") <= top)
    values = best.groupBy(*group, "value").agg(F.sum("m").alias("m"))
    values = (values.withColumn("before", F.coalesce(F.sum("m").over(by_value.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .where(F.col("before") < top).select(*group, "value"))
    cells = best.select(*group, "n", "all_n", "value").join(values, [*group, "value"])
    terms = counts.join(cells, [*group, "n", "all_n"]).select(*group, F.col("term").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("value"), "item")).alias("rank")
    return (terms.select(*group, F.lit("term").alias("part"), "item", "value", rank).where(F.col("rank") <= top))


def _pairs(counts: DataFrame, sources: DataFrame) -> DataFrame:
    group = ["lang", "source"]
    histogram = counts.groupBy(*group, "n").agg(F.count("*").alias("m"))
    cells = histogram.groupBy(*group).agg(F.collect_list(F.struct("n", "m")).alias("cells"))  # distinct counts: few
    others = sources.groupBy("lang").agg(F.collect_list(F.struct("source", "total")).alias("others"))  # the result has their square
    bases = sources.join(cells, group, "left").join(others, "lang").select(*group, "total", "terms", "cells", "others")
    schema = "lang string, a string, b string, value long"
    slots = sources.groupBy("lang").agg(F.ceil(F.sum("rows") / PART_ROWS).alias("slots"))
    rows = counts.select(*group, "term", "n").join(sources.select(*group, "total", "terms"), group).join(slots, "lang")
    rows = rows.withColumn("slot", F.pmod(F.xxhash64("term"), F.greatest("slots", F.lit(1))))
    shared = rows.select(*group, "term", "n", "total", "terms", "slot").groupBy("lang", "slot").applyInArrow(_pair_parts, schema)
    sums = bases.mapInArrow(_pair_bases, schema).unionByName(shared).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                 F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    return both.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value").select("*", rank)


def divergence_sql(min_docs: int = MIN_DOCS, top: int = TOP) -> str:
    """The same rows in DuckDB SQL."""
    p = "1 + ({s}::HUGEINT * ({{n}} + 2)) // ({{total}} + 2 * terms)".format(s=SCALE)
    f = "((x - y) * (x - y)) // (x + y)"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS all_n FROM w GROUP BY ALL HAVING count(DISTINCT id) >= {min_docs}),
l AS (SELECT lang, sum(all_n) AS all_total, count(*) AS terms FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
s AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, {p.format(n="coalesce(c.n, 0)", total="coalesce(t.total, 0)")} AS x,
        {p.format(n="all_n", total="all_total")} AS y
      FROM g JOIN kept USING (lang) JOIN l USING (lang) LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pairs AS (SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
sums AS (SELECT a.lang, a.source, b.source AS item, sum({f.replace("x", "a.x").replace("y", "b.x")}) AS value
         FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT lang, source, 'pair' AS part, item, coalesce(value, 0)::BIGINT AS value FROM pairs LEFT JOIN sums USING (lang, source, item)
  UNION ALL SELECT lang, source, 'term', term, ({f})::BIGINT FROM s WHERE n > 0 AND x > y),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM every)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {top}"""
