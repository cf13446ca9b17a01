"""Merkle manifest of a table: one tree for each language, and a tree of their roots.

Leaves are appended in order to aligned blocks.  A block keeps its open subtrees, and every leaf the witness it
has so far: the siblings of the subtrees that hold it.  When a subtree gets its sibling both are closed, and
the witnesses of both sides grow by the other's root.  Blocks are closed by the tasks that hold them; their
roots are appended in the same way as leaves of the next, 4,096 times smaller round, and their witnesses extend those
below.  No task sees more than a block at a time, and the driver sees only how many rounds there are.

Whether a node has a sibling, and on which side, follows from its place and the size of its tree.
"""

from __future__ import annotations

from binascii import hexlify
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch_tables, stored

BLOCK_BITS = 12  # a block has 4,096 leaves
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def node(*children: bytes) -> bytes:
    """Digest of the children's digests as hex text."""
    return sha256(b"".join(map(hexlify, children))).digest()


class OpenSubtrees:
    """A run of leaves: its complete subtrees that wait for a sibling, and the leaves' witnesses so far."""

    def __init__(self):
        self.open: list[tuple[int, bytes, int, int]] = []  # height, root, first leaf, end
        self.witness: list[list[bytes]] = []

    def append(self, digest: bytes) -> None:
        place = len(self.witness)
        self.witness.append([])
        self.open.append((0, digest, place, place + 1))
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._join()

    def _join(self) -> None:
        height, right, middle, end = self.open.pop()
        _, left, first, _ = self.open.pop()
        for w in self.witness[first:middle]:
            w.append(right)
        for w in self.witness[middle:end]:
            w.append(left)
        self.open.append((height + 1, node(left, right), first, end))

    def close(self, height: int = 0) -> bytes:
        """The root, at least ``height`` levels up; a node without a sibling goes up alone."""
        while len(self.open) > 1 or self.open[0][0] < height:
            if len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
                self._join()
            else:
                level, root, first, end = self.open.pop()
                self.open.append((level + 1, node(root), first, end))
        return self.open[0][1]


def fold(digest: bytes, place: int, size: int, witness: bytes) -> tuple[bytes, bytes]:
    """The root that a leaf and its siblings give, and the siblings left over for the tree above."""
    at = 0
    while size > 1:
        if place & 1:
            digest, at = node(witness[at:at + 32], digest), at + 32
        elif place + 1 < size:
            digest, at = node(digest, witness[at:at + 32]), at + 32
        else:
            digest = node(digest)
        place, size = place >> 1, size + 1 >> 1
    return digest, witness[at:]


def _told(value: Column) -> Column:
    """``-`` for null, else byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row; ``changed`` replaces columns."""
    parts = [_told(changed.get(c, F.col(f"`{c}`"))) for c in LEAF_COLUMNS]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``place`` (from 0 in the tree, by ``order``) and ``size`` of the tree; stored.

    Rows alike in all of ``order`` are spread by their position in the scan.
    """
    schema = rows.schema

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tree, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            nth = []
            for t in batch["tree"].to_pylist():
                if t != tree:
                    tree, seen = t, 0
                nth.append(seen)
                seen += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * batch.num_rows, pa.int32()),
                                              pa.array(nth, pa.int64())], names=[*batch.schema.names, "_part", "_nth"])

    keys = ["tree", *order, "_tie"]
    ordered = (rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys)
               .sortWithinPartitions(*keys).drop("_tie"))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    numbered = stored(ordered.mapInArrow(number, f"{columns}, _part int, _nth long"), "merkle-ordered")
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = numbered.groupBy("_part", "tree").agg(F.count("*").alias("_n"))  # a tree has a row a task here
    bases = counts.select("_part", "tree", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
                          F.sum("_n").over(Window.partitionBy("tree")).alias("size"))
    return numbered.join(bases, ["_part", "tree"]).withColumn("place", F.col("_base") + F.col("_nth")).drop("_part", "_nth", "_base")


def _appended(rows: DataFrame, bits: int) -> DataFrame:
    """Append rows ``tree, place, size, digest`` to aligned blocks; stored.

    Every row comes back with its ``witness`` inside the block; every block adds one row of the next round (``closed``):
    its place among the tree's blocks, their number, its root.
    """
    carried = [f for f in rows.schema.fields if f.name not in ("tree", "place", "size", "digest")]
    names = ["tree", "place", "size", "digest", *(f.name for f in carried), "witness", "closed"]
    schema = "tree string, place long, size long, digest binary, " + "".join(
        f"`{f.name}` {f.dataType.simpleString()}, " for f in carried) + "witness binary, closed boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, trees, held = None, OpenSubtrees(), []

        def closed(like: pa.Schema) -> pa.RecordBatch:
            tree, number = block
            size = held[0]["size"]
            root = trees.close(bits if size > 1 << bits else 0)
            out = [{**row, "witness": b"".join(w), "closed": False} for row, w in zip(held, trees.witness)]
            out.append({"tree": tree, "place": number, "size": -(-size >> bits), "digest": root, "closed": True})
            fields = [like.field(n) for n in names[:-2]] + [pa.field("witness", pa.binary()), pa.field("closed", pa.bool_())]
            return pa.RecordBatch.from_pylist(out, schema=pa.schema([f.with_nullable(True) for f in fields]))

        for batch in batches:
            for row in batch.to_pylist():
                here = (row["tree"], row["place"] >> bits)
                if here != block:
                    if held:
                        yield closed(batch.schema)
                    block, trees, held = here, OpenSubtrees(), []
                trees.append(row["digest"])
                held.append(row)
        if held:
            yield closed(batch.schema)

    ordered = (rows.select(*names[:-2]).repartition("tree", F.shiftright("place", bits)).sortWithinPartitions("tree", "place"))
    return stored(ordered.mapInArrow(run, schema), "merkle-appended")


def _grown(rows: DataFrame, bits: int) -> list[DataFrame]:
    """Rounds of appends, until every tree is one block."""
    rounds = []
    while True:
        rounds.append(_appended(rows, bits))
        rows = rounds[-1].where("closed").select("tree", "place", "size", "digest")
        if rows.where("size > 1").isEmpty():
            return rounds


def _extended(rounds: list[DataFrame], bits: int, above: DataFrame) -> DataFrame:
    """Rows of the first round with whole witnesses; ``above`` holds ``tree, witness`` of each root and columns to add."""
    more = [c for c in above.columns if c not in ("tree", "witness")]
    upper = above.withColumn("place", F.lit(0).cast("long"))
    for rows in reversed(rounds):
        own = rows.where("not closed").drop("closed").withColumn("_block", F.shiftright("place", bits))
        up = upper.select("tree", F.col("place").alias("_block"), F.col("witness").alias("_above"), *more)
        upper = (own.join(up, ["tree", "_block"]).withColumn("witness", F.concat("witness", "_above")).drop("_block", "_above"))
    return upper


def manifest(docs: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """Every row's leaf with its proof: ``doc_id, tree, leaf, place, size, witness, subroot, top_place, top_size, root, altered``.

    Digests are binary; ``witness`` holds the siblings from the leaf to the root, 32 bytes each.  ``altered`` is the leaf with
    one more in n_chars where 7 divides the crc32 of the doc_id, else null.  Leaves of a language ascend by doc_id (null
    first), then by digest, so repeated rows have a place each; the languages ascend, null first, bytewise.  An empty
    table gives no rows.  A row of a null in any column, an empty or a very long text is a leaf as any other; columns other than those of a leaf
    are ignored.  The result reads stored tables only.
    """
    more = F.col("n_chars").cast("decimal(38,0)") + F.lit(1)
    drawn = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    leaves = docs.select(F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"), F.col("doc_id").cast("long"),
                         leaf_digest().alias("digest"), F.when(drawn, leaf_digest(n_chars=more)).alias("altered"))
    leaves = stored(leaves, "merkle-leaves")
    rounds = _grown(_placed(leaves, ["doc_id", "digest"]), bits)
    subroots = rounds[-1].where("closed").select("tree", "digest")

    names = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    top = _grown(_placed(names, ["name"]), bits)
    root = top[-1].where("closed").select("tree", F.col("digest").alias("root"), F.lit(b"").alias("witness"))
    above = _extended(top, bits, root).select(F.col("name").alias("tree"), "witness", F.col("digest").alias("subroot"),
                                              F.col("place").alias("top_place"), F.col("size").alias("top_size"), "root")
    return _extended(rounds, bits, stored(above, "merkle-roots")).withColumnRenamed("digest", "leaf")


def verified(proofs: DataFrame) -> DataFrame:
    """Fold every proof: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` in hex.

    The altered leaf is folded where there is one, with the original siblings.
    """
    fields = [("doc_id", pa.int64())] + [(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    schema = pa.schema([*fields, ("verified", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                mid, rest = fold(r["altered"] or r["leaf"], r["place"], r["size"], r["witness"])
                found, _ = fold(mid, r["top_place"], r["top_size"], rest)
                out.append({"doc_id": r["doc_id"], "leaf": r["leaf"].hex(), "subroot": r["subroot"].hex(), "root": r["root"].hex(),
                            "proof_sha256": sha256(hexlify(r["witness"])).hexdigest(), "folded_root": found.hex(),
                            "verified": found == r["root"]})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return proofs.select("doc_id", "leaf", "subroot", "root", "altered", "place", "size", "top_place", "top_size", "witness").mapInArrow(
        run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def manifest_rows(docs: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """``manifest`` and ``verified`` in one, stored; intermediate tables are deleted."""
    with scratch_tables(docs.sparkSession):
        return stored(verified(manifest(docs, bits)), "merkle-proofs", keep=True)


def _sql_told(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def merkle_sql() -> str:
    """The same rows in DuckDB SQL: every level of both trees by recursion."""
    plain = " || ".join(_sql_told(c) for c in LEAF_COLUMNS)
    changed = " || ".join(_sql_told("(n_chars + 1)" if c == "n_chars" else c) for c in LEAF_COLUMNS)
    # DuckDB has no crc32: ``crc`` computes it bit by bit from the digits
    return f"""
WITH RECURSIVE
bytes AS (SELECT doc_id, d, generate_subscripts(d, 1) AS i, unnest(d) AS c FROM (
    SELECT DISTINCT doc_id, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)) AS d FROM documents
    WHERE doc_id IS NOT NULL)),
crc(doc_id, i, k, v) AS (
  SELECT DISTINCT doc_id, 0, 8, 4294967295::BIGINT FROM bytes
  UNION ALL
  SELECT crc.doc_id, CASE WHEN k = 8 THEN crc.i + 1 ELSE crc.i END, CASE WHEN k = 8 THEN 0 ELSE k + 1 END,
    CASE WHEN k = 8 THEN xor(v, b.c::BIGINT) ELSE xor(v >> 1, (v & 1) * 3988292384) END
  FROM crc LEFT JOIN bytes b ON b.doc_id = crc.doc_id AND b.i = crc.i + 1
  WHERE k < 8 OR b.c IS NOT NULL),
drawn AS (SELECT doc_id AS drawn_id, xor(max_by(v, i * 10 + k), 4294967295) % 7 = 0 AS hit FROM crc GROUP BY doc_id),
d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({plain}) AS leaf,
    CASE WHEN hit THEN sha256({changed}) END AS altered
  FROM documents LEFT JOIN drawn ON drawn_id = doc_id),
l AS (SELECT *, row_number() OVER () AS id,
        row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY tree) AS n FROM d),
lv(tree, n, h, pos, v) AS (
  SELECT tree, n, 0, pos, leaf FROM l
  UNION ALL
  SELECT tree, n, h + 1, pos // 2, sha256(string_agg(v, '' ORDER BY pos)) FROM lv
  WHERE h < CASE WHEN n > 1 THEN length(bin(n - 1)) ELSE 0 END GROUP BY tree, n, h, pos // 2),
s AS (SELECT tree, v AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
      FROM lv WHERE h = CASE WHEN n > 1 THEN length(bin(n - 1)) ELSE 0 END),
tv(n, h, pos, v) AS (
  SELECT n, 0, pos, subroot FROM s
  UNION ALL
  SELECT n, h + 1, pos // 2, sha256(string_agg(v, '' ORDER BY pos)) FROM tv
  WHERE h < CASE WHEN n > 1 THEN length(bin(n - 1)) ELSE 0 END GROUP BY n, h, pos // 2),
top AS (SELECT v AS root FROM tv WHERE h = CASE WHEN n > 1 THEN length(bin(n - 1)) ELSE 0 END),
steps AS (
  SELECT l.id, lv.h, (l.pos >> lv.h) & 1 AS odd, sib.v FROM l JOIN lv ON lv.tree = l.tree AND lv.pos = l.pos >> lv.h
  LEFT JOIN lv sib ON sib.tree = l.tree AND sib.h = lv.h AND sib.pos = xor(l.pos >> lv.h, 1)
  WHERE lv.h < CASE WHEN l.n > 1 THEN length(bin(l.n - 1)) ELSE 0 END
  UNION ALL
  SELECT l.id, 1000 + tv.h, (s.pos >> tv.h) & 1, sib.v FROM l JOIN s ON s.tree = l.tree JOIN tv ON tv.pos = s.pos >> tv.h
  LEFT JOIN tv sib ON sib.h = tv.h AND sib.pos = xor(s.pos >> tv.h, 1)
  WHERE tv.h < CASE WHEN s.n > 1 THEN length(bin(s.n - 1)) ELSE 0 END),
ordered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY h) AS k FROM steps),
f(id, k, v) AS (
  SELECT id, 0::BIGINT, coalesce(altered, leaf) FROM l
  UNION ALL
  SELECT f.id, o.k, sha256(CASE WHEN o.v IS NULL THEN f.v WHEN o.odd = 1 THEN o.v || f.v ELSE f.v || o.v END)
  FROM f JOIN ordered o ON o.id = f.id AND o.k = f.k + 1),
folded AS (SELECT id, max_by(v, k) AS v FROM f GROUP BY id),
proof AS (SELECT l.id, sha256(coalesce(string_agg(o.v, '' ORDER BY o.k), '')) AS v FROM l LEFT JOIN ordered o ON o.id = l.id GROUP BY l.id)
SELECT l.doc_id, leaf, subroot, root, proof.v AS proof_sha256, folded.v AS folded_root, folded.v = root AS verified
FROM l JOIN s ON s.tree = l.tree CROSS JOIN top JOIN proof ON proof.id = l.id JOIN folded ON folded.id = l.id"""
