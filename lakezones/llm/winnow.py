"""Document fingerprints by winnowing.

Every window of ``w`` consecutive k-gram hashes gives its smallest one, the rightmost among
equals; the chosen hashes with their positions are the fingerprint.  Two texts that share
``w + k - 1`` code points or more share a chosen hash; texts below ``k`` code points count as
one gram.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 8
WINDOW = 8

_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hashes (modulo 2^64, mixed to 32 bits) of all runs of ``k`` codes, by doubling the run."""
    power, width, cur = _MULTIPLIER, 1, (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    out, done = None, 0
    while True:
        if k >> (width.bit_length() - 1) & 1:
            if out is None:
                out = cur
            else:
                n = len(codes) - done - width + 1
                out = out[:n] * np.uint64(power) + cur[done:done + n]
            done += width
        if done == k:
            break
        cur = cur[:len(cur) - width] * np.uint64(power) + cur[width:]
        power, width = power * power & _MASK, width * 2
    out = out ^ out >> np.uint64(31)
    out = out * np.uint64(0xBF58476D1CE4E5B9)
    return out >> np.uint64(32)


def winnow(text: str, k: int = GRAM, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Chosen 32-bit hashes and their positions in code points, ascending."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    if not len(codes):
        return np.empty(0, np.uint32), np.empty(0, np.uint32)
    h = gram_hashes(codes, min(k, len(codes)))
    place = np.arange(len(h), dtype=np.uint64)
    # hash above, reversed position below: the least number is the rightmost least hash
    low = h << np.uint64(32) | np.uint64(0xFFFFFFFF) - place
    span, width = min(w, len(h)), 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if span > width:
        low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
    low = low[np.concatenate([[True], low[1:] != low[:-1]])]
    return (low >> np.uint64(32)).astype(np.uint32), (np.uint64(0xFFFFFFFF) - (low & np.uint64(0xFFFFFFFF))).astype(np.uint32)


def packed(hashes: np.ndarray, places: np.ndarray) -> str:
    """Fingerprint as text: base64 of (hash, position) pairs, little-endian unsigned 32-bit."""
    return base64.b64encode(np.stack([hashes, places], axis=1).astype("<u4").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard coefficient of the distinct chosen hashes; two empty fingerprints are alike."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    either = len(a) + len(b) - both
    return both / either if either else 1.0


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """``bucket, copy, doc_id, text`` dealt by bucket and sorted so that each row's next document follows it.

    Order: doc_id descending (nulls last), then a hash of the text and the text descending.  Buckets are
    ranges of doc_id between approximate quantiles.  The first document of a bucket is copied to the end of
    the bucket before it (of the first bucket: to the last), so a text moves once.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).withColumn("_h", F.xxhash64("text"))
    spark = docs.sparkSession
    cuts = [i / buckets for i in range(1, buckets)] or [0.5]
    found = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), cuts, 20 * buckets).alias("q")).first()["q"]
    bounds = np.unique(np.array(found or [], np.int64))

    @F.pandas_udf("int")
    def bucket(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        out = pd.Series(0, ids.index, dtype="int32")
        out[known] = 1 + np.searchsorted(bounds, ids[known].astype("int64"), side="right").astype("int32")
        return out

    heads = (docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_h"))
             .withColumn("bucket", bucket("doc_id")).groupBy("bucket").agg(F.max(F.struct("doc_id", "_h")).alias("m"))
             .orderBy(F.desc("bucket")).collect())  # one row a bucket
    targets = [(h["m"]["doc_id"], h["m"]["_h"], heads[i - 1]["bucket"]) for i, h in enumerate(heads)]
    extra = F.broadcast(spark.createDataFrame(targets, "_doc long, _hash long, _to int"))
    rows = rows.withColumn("bucket", bucket("doc_id")).join(
        extra, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_h") == F.col("_hash")), "left")
    places = F.array_compact(F.array(F.struct("bucket", F.lit(False).alias("copy")), F.when(
        F.col("_to").isNotNull(), F.struct(F.col("_to").alias("bucket"), F.lit(True).alias("copy")))))
    return (rows.select("doc_id", "text", "_h", F.explode(places).alias("p")).select("p.*", "doc_id", "text", "_h")
            .repartition(max(1, buckets // 4), "bucket")
            .sortWithinPartitions("bucket", "copy", F.desc_nulls_last("doc_id"), F.desc("_h"), F.desc("text"))
            .select("bucket", "copy", "doc_id", "text"))


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")
_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                  ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def edit_fingerprints(docs: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """Fingerprints of every whole text and of its edit: the second half gives way to the next document's beginning.

    Null texts are empty and have an empty fingerprint.  A single document is its own next one; rows
    that share a doc_id are documents of their own.  No documents: no rows.  Other columns are ignored.
    """
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # bucket, doc_id, text, fingerprint of the document whose next one comes
        for batch in batches:
            out = []
            for bucket, copy, doc, text in zip(*(batch[c].to_pylist() for c in ("bucket", "copy", "doc_id", "text"))):
                now = winnow(text, k, w)
                if held and held[0] == bucket:
                    _, hid, htext, hprint = held
                    half = len(htext) // 2
                    edited = htext[:len(htext) - half] + text[:half]
                    eprint = winnow(edited, k, w)
                    out.append({"doc_id": hid, "n_chars": len(htext), "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
                                "fingerprint": packed(*hprint), "edited_fingerprint": packed(*eprint),
                                "near_edited": likeness(hprint[0], eprint[0]), "near_next": likeness(hprint[0], now[0])})
                held = None if copy else (bucket, doc, text, now)
            yield pa.RecordBatch.from_pylist(out, schema=_OUT)

    return with_next(docs, buckets).mapInArrow(run, OUT)
