"""Jaccard join of word shingles by an R-tree over count vectors.

A document's shingles are hashed into groups, the more the larger the set; the counts of the groups are a point.  Two
documents cannot share more shingles than the sum over groups of the smaller count, and two nodes of the
tree hold no link if the sum of the smaller maxima is too small.  Pairs of points that pass
are verified on the whole sets.  With more groups than shingles the bound is nearly the overlap itself, so what passes grows with the
pairs that are nearly alike, not with those that share a passage.

The space is cut so that no tree holds the corpus: in one order of all shingles (rare first) linked
documents share one among the first ``n - ceil(t n) + 1`` of each, so a tree is built for every
such shingle that several documents have.  Shingle frequencies come from all documents.  Three steps keep large groups of
copies linear: equal sets are one point; every point is first verified against the smallest
document of its shingles' cells; and cells whose points are then in one component are done.  Trees
skip pairs within a component.  Cells are split by size class, as linked sizes differ by ``t`` at most; a
pair comes from the first cell that both points are in only; and the points of a large cell are dealt to parts that are
joined two by two, so that no task holds a cell.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import BLOCK_BYTES, PLACE_BITS, Block, BlockTable
from .common import scratch_tables, stored
from .components import components
from .words import NOT_SPACE, Words, distinct_index, mix, shingles

GROUPS = (128, 4096)  # of the smallest and the largest sets
FANOUT = 16
PART_POINTS = 4096  # of a cell in one part
FREQUENCIES = 0


class Sets:
    """Distinct shingles of a block's texts, sorted by (text, hash)."""

    def __init__(self, block: Block, k: int, name_bits: int):
        words = Words(block, NOT_SPACE)
        h, text = shingles(words, words.counts(block), k)
        order = np.lexsort((h, text))
        h, text = h[order], text[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
        self.hash, self.text = h[new], text[new]
        self.sizes = np.bincount(self.text, minlength=len(block))
        short = self.hash >> np.uint64(64 - name_bits) << np.uint64(64 - name_bits)
        self.names, _, self.which = distinct_index(short)
        self.local = np.log2(np.bincount(self.which, minlength=len(self.names))).astype(np.uint8)  # documents, as a power of two


def frequency(_: int, names: np.ndarray, blocks: np.ndarray, local: np.ndarray) -> np.ndarray:
    """0 for a name of one document, else 1 + log2 of the number of documents (each block's number as a power of two)."""
    order = np.argsort(names)
    s = names[order]
    begin = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    count = np.diff(np.append(begin, len(s)))
    documents = np.add.reduceat(np.left_shift(np.int64(1), local[order].astype(np.int64)), begin)
    out = np.empty(len(names), np.uint8)
    out[order] = np.repeat(np.where(documents > 1, 1 + np.log2(documents), 0).astype(np.uint8), count)
    return out


ROW_BITS = PLACE_BITS  # a row id is the block's id and the place in the block


def groups_of(size: int) -> int:
    """Groups for sets of a size: a power of two, so that a point folds to fewer groups."""
    return min(max(1 << max(size - 1, 1).bit_length() + 1, GROUPS[0]), GROUPS[1])


def point_of(shingles: np.ndarray) -> bytes:
    """Counts of the groups, in one byte each, or in four where one has more than 255."""
    n = groups_of(len(shingles))
    counts = np.bincount((shingles >> np.uint64(7)) & np.uint64(n - 1), minlength=n)
    return counts.astype(np.uint8 if counts.max() < 256 else "<u4").tobytes()


def folded(points: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Points of several numbers of groups in the least of them; the type holds all counts."""
    groups = [groups_of(n) for n in sizes.tolist()]
    least = min(groups)
    out = np.empty((len(points), least), np.uint32)
    for i, (p, n) in enumerate(zip(points, groups)):
        out[i] = np.frombuffer(p, np.uint8 if len(p) == n else "<u4").reshape(-1, least).sum(axis=0, dtype=np.uint32)
    high = int(out.max(initial=0))
    return out.astype(np.uint8 if high < 256 else np.uint16 if high < 65536 else np.uint32)


def profiles(table: BlockTable, k: int, num: int, den: int) -> DataFrame:
    """``rid, doc_id, n`` of every document, and for those that may link also digest, set, prefix and point."""
    bits = min(64, max(24, math.ceil(math.log2(max(table.n_bytes, 2))) + 6))

    def send(block: Block, _: dict) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        s = Sets(block, k, bits)
        return {FREQUENCIES: (s.names, s.local)}

    def profile(block_id: int, block: Block, answers: dict) -> pa.RecordBatch:
        s = Sets(block, k, bits)
        rank = answers.get(FREQUENCIES, np.zeros(len(s.names), np.uint8)).astype(np.int64)[s.which]
        alone = np.bincount(s.text, rank == 0, len(block)).astype(np.int64)
        need = s.sizes - (num * s.sizes + den - 1) // den + 1  # length of the prefix
        n = len(block)
        digest, whole, prefix, point = [None] * n, [None] * n, [None] * n, [None] * n
        first = np.cumsum(s.sizes) - s.sizes
        for i in np.flatnonzero((s.sizes > 0) & (alone < need)):
            part = slice(first[i], first[i] + s.sizes[i])
            h, r = s.hash[part], rank[part]
            whole[i] = h.tobytes()
            digest[i] = hashlib.blake2b(whole[i], digest_size=16).digest()
            order = np.lexsort((h, r))[alone[i]:need[i]]
            prefix[i] = h[order].view(np.int64)
            point[i] = point_of(h)
        return pa.RecordBatch.from_pydict({"rid": (block_id << ROW_BITS) + np.arange(n), "doc_id": block.doc_ids, "n": s.sizes,
                                           "digest": digest, "shingles": whole, "prefix": prefix, "point": point}, schema=_PROFILE)

    seen = table.exchange(send, frequency)
    return stored(table.mapped(profile, "rid long, doc_id long, n long, digest binary, shingles binary, "
                               "prefix array<bigint>, point binary", seen), "jaccard-profiles")


_PROFILE = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()),
                      ("shingles", pa.binary()), ("prefix", pa.list_(pa.int64())), ("point", pa.binary())])


def verified(pairs: DataFrame, profile: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose whole sets link."""
    sets = profile.select("rid", "shingles")
    both = (pairs.join(sets.select(F.col("rid").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("rid").alias("b"), F.col("shingles").alias("sb")), "b").select("a", "b", "sa", "sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for sa, sb in zip(batch["sa"], batch["sb"]):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (sa, sb))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * common >= num * (len(x) + len(y) - common))
            rows = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(rows), batch["b"].filter(rows)], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


class RTree:
    """Packed tree over points: per node the maxima of the counts, the range of sizes, and the component if there is one."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, comps: np.ndarray):
        self.order = np.lexsort((sizes, comps))  # near copies lie together
        level = (points[self.order], sizes[self.order], sizes[self.order], comps[self.order])
        self.levels = [level]
        while len(level[0]) > FANOUT:
            cut = np.arange(0, len(level[0]), FANOUT)
            low, high = np.minimum.reduceat(level[3], cut), np.maximum.reduceat(level[3], cut)
            mixed = (low != high) | (low < 0)
            level = (np.maximum.reduceat(level[0], cut, axis=0), np.minimum.reduceat(level[1], cut),
                     np.maximum.reduceat(level[2], cut), np.where(mixed, -1, low))
            self.levels.append(level)

    def pairs(self, num: int, den: int) -> Iterator[np.ndarray]:
        """Pairs of points of different components whose bound permits a link."""
        top = len(self.levels) - 1
        a, b = np.triu_indices(len(self.levels[top][0]))
        work = [(top, a, b)]
        while work:
            depth, a, b = work.pop()
            if len(a) > 4096:
                half = len(a) // 2
                work += [(depth, a[:half], b[:half]), (depth, a[half:], b[half:])]
                continue
            top_counts, low, high, comp = self.levels[depth]
            keep = (comp[a] < 0) | (comp[a] != comp[b])
            keep &= (den * high[a] >= num * low[b]) & (den * high[b] >= num * low[a])
            if depth == 0:
                keep &= a != b
            a, b = a[keep], b[keep]
            bound = np.minimum(top_counts[a], top_counts[b]).sum(axis=1, dtype=np.int64)
            keep = (num + den) * bound >= num * (low[a] + low[b])
            a, b = a[keep], b[keep]
            if depth == 0:
                if len(a):
                    yield np.stack([self.order[a], self.order[b]], axis=1)
                continue
            n = len(self.levels[depth - 1][0])
            for i in range(0, len(a), 16):  # children of few nodes at a time
                x, y = a[i:i + 16, None] * FANOUT, b[i:i + 16, None] * FANOUT
                xs = np.repeat(x + np.arange(FANOUT), FANOUT, axis=1).ravel()
                ys = np.tile(y + np.arange(FANOUT), (1, FANOUT)).ravel()
                some = (xs < n) & (ys < n) & ((np.repeat(x != y, FANOUT * FANOUT)) | (xs <= ys))
                if some.any():
                    work.append((depth - 1, xs[some], ys[some]))


def _tree_join(num: int, den: int):
    def join(group: pa.Table) -> pa.Table:
        rid, home, part = (group[c].to_numpy(zero_copy_only=False) for c in ("rid", "home", "part"))
        sizes = group["n"].to_numpy()
        one_part = group["low"][0].as_py() == group["high"][0].as_py()
        cells = [np.frombuffer(c.as_py(), np.int64) for c in group["earlier"]]
        sets: dict[int, frozenset] = {}

        def earlier(i: int) -> frozenset:
            if i not in sets:
                sets[i] = frozenset(cells[i].tolist())
            return sets[i]

        _, comps = np.unique(group["comp"].to_numpy(), return_inverse=True)
        points = folded([p.as_py() for p in group["point"]], sizes)
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for found in RTree(points, sizes, comps).pairs(num, den):
            x, y = found[:, 0], found[:, 1]
            some = home[x] | home[y]  # two guests meet at home
            if not one_part:
                some &= part[x] != part[y]  # two of one part meet there
            x, y = x[some], y[some]
            first = np.array([earlier(i).isdisjoint(earlier(j)) for i, j in zip(x.tolist(), y.tolist())], bool)
            a.append(np.minimum(rid[x], rid[y])[first])
            b.append(np.maximum(rid[x], rid[y])[first])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return join


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row of a point for each of its cells and each part that its own part meets there, with the cells before it."""
    for batch in batches:
        for row in batch.to_pylist():
            tokens = np.unique(np.array([c["token"] for c in row["cells"]], np.int64))
            out: dict[str, list] = {name: [] for name in _DEALT.names}
            for c in row["cells"]:
                part = int(mix(np.array([row["rid"]], np.uint64))[0] % np.uint64(c["parts"]))
                for other in range(c["parts"]):
                    for name in ("token", "class", "home"):
                        out[name].append(c[name])
                    for name in ("rid", "n", "comp", "point"):
                        out[name].append(row[name])
                    out["part"].append(part)
                    out["low"].append(min(part, other))
                    out["high"].append(max(part, other))
                    out["earlier"].append(tokens[:np.searchsorted(tokens, c["token"])].tobytes())
            yield pa.RecordBatch.from_pydict(out, schema=_DEALT)


_DEALT = pa.schema([("token", pa.int64()), ("class", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("part", pa.int64()),
                    ("home", pa.bool_()), ("rid", pa.int64()), ("n", pa.int64()), ("comp", pa.int64()), ("point", pa.binary()),
                    ("earlier", pa.binary())])


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document.

    Words are runs of bytes other than ASCII white space, A-Z in lower case; a set holds the distinct ``k``-word
    shingles, or the whole sequence of fewer words; sets without words link to nothing.  Documents link
    when ``den * intersection >= num * union``; the component is the smallest doc_id reachable.  A null
    text is empty; null doc_ids count as no id (null if a component has no other); rows that share a doc_id are
    documents of their own.  No documents: no rows.  Other columns are ignored.
    """
    with scratch_tables(docs.sparkSession):
        table = BlockTable(docs, "jaccard", ordered=False)
        every = rooted(table, k, num, den)
        table.drop()
    smallest = stored(every.groupBy("root").agg(F.min("doc_id").alias("component_id")), "jaccard-smallest")
    return every.join(smallest, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def representatives(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row of each component with all its columns: that of the smallest doc_id (null last).

    Rows come back from their blocks, so the texts are not shuffled.  ``block_bytes`` of text are in work in a task at a time.
    """
    with scratch_tables(docs.sparkSession):
        table = BlockTable(docs, "jaccard", ordered=False, carry=True, block_bytes=block_bytes)
        every = rooted(table, k, num, den)
        first = F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "rid"))
        kept = every.groupBy("root").agg(first.alias("m")).select("m.rid")
        place = kept.select(F.shiftright("rid", ROW_BITS).alias("block"), (F.col("rid") % (1 << ROW_BITS)).alias("i"))
        answers = stored(place.groupBy("block").agg(F.collect_list("i").alias("answers")), "jaccard-kept")
        names = docs.columns

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for payload, places in zip(batch["payload"], batch["answers"]):
                    block, some = Block(payload.as_py()), sorted(places.as_py() or [])
                    texts = [block.buf[block.starts[i]:block.ends[i]].tobytes().decode() for i in some]
                    yield block.rows(names, texts, some)

        rows = table.rows.join(answers, "block").select("payload", "answers").mapInArrow(keep, docs.schema)
        out = stored(rows, "jaccard-documents", keep=True)
        table.drop()
    return out


def rooted(table: BlockTable, k: int, num: int, den: int) -> DataFrame:
    """``rid, doc_id, n, root`` of every document; those of a component share a root (kept table)."""
    profile = profiles(table, k, num, den)
    may = profile.where("digest is not null")
    reps = stored(may.groupBy("digest").agg(F.min("rid").alias("rep")), "jaccard-reps")
    members = stored(may.select("rid", "digest").join(reps, "digest").select("rid", "rep"), "jaccard-members")
    only = members.where("rid = rep").select("rid")
    postings = stored(may.select("rid", "n", "prefix").join(only, "rid").select("rid", "n", F.explode("prefix").alias("token")),
                      "jaccard-postings")

    # first links: each point and the smallest document of the cells it is most often in
    centres = stored(postings.groupBy("token").agg(F.min("rid").alias("centre"), F.max("rid").alias("last"))
                     .where("centre < last").select("token", "centre"), "jaccard-centres")
    met = postings.join(centres, "token").where("rid <> centre").groupBy("rid", "centre").agg(F.count("*").alias("c"))
    star = met.groupBy("rid").agg(F.max(F.struct("c", (-F.col("centre")).alias("m"))).alias("x"))
    star = stored(star.select((-F.col("x.m")).alias("a"), F.col("rid").alias("b")), "jaccard-star")
    links = stored(verified(star, may, num, den), "jaccard-links")
    roots = components(links, "jaccard-first")

    # remaining links: trees over cells that hold several components
    postings = postings.join(roots.withColumnRenamed("node", "rid"), "rid", "left").withColumn("comp", F.coalesce("root", "rid"))
    open_cells = stored(postings.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
                        .where("x < y").select("token"), "jaccard-cells")
    size_class = F.floor(F.log("n") / math.log(den / num) + 1e-9) if num < den else F.col("n")
    guests = F.explode(F.array(F.struct(size_class.alias("class"), F.lit(True).alias("home")),
                               F.struct((size_class + 1).alias("class"), F.lit(False).alias("home"))))
    left = stored(postings.join(open_cells, "token").select("token", "rid", "n", "comp", guests.alias("g"))
                  .select("token", "rid", "n", "comp", F.col("g.class").cast("long").alias("class"), "g.home"), "jaccard-left")
    # a cell without two components or without a home has no pairs
    cells = left.groupBy("token", "class").agg(F.count("*").alias("m"), F.min("comp").alias("x"), F.max("comp").alias("y"),
                                               F.max("home").alias("h")).where("x < y and h")
    cells = cells.select("token", "class", F.ceil(F.col("m") / PART_POINTS).alias("parts"))
    by_point = (left.join(cells, ["token", "class"]).groupBy("rid")  # the cells of one prefix
                .agg(F.first("n").alias("n"), F.first("comp").alias("comp"),
                     F.collect_list(F.struct("token", "class", "home", "parts")).alias("cells")).join(may.select("rid", "point"), "rid"))
    dealt = by_point.mapInArrow(_dealt, "token long, class long, low long, high long, part long, home boolean, rid long, n long, "
                                "comp long, point binary, earlier binary")
    pairs = stored(dealt.groupBy("token", "class", "low", "high").applyInArrow(_tree_join(num, den), "a long, b long"), "jaccard-pairs")
    more = stored(verified(pairs, may, num, den), "jaccard-more")
    roots = components(links.unionByName(more), "jaccard-all")

    of = (members.withColumnRenamed("rep", "node").join(roots, "node", "left")
          .select("rid", F.coalesce("root", "node").alias("root")))
    return stored(profile.select("rid", "doc_id", "n").join(of, "rid", "left")
                  .select("rid", "doc_id", "n", F.coalesce("root", "rid").alias("root")), "jaccard-docs", keep=True)
