"""Jaccard join against brute force over all pairs, the tree against a full scan, and odd rows."""

import random
import re

import numpy as np
import pytest

from conftest import SF_SMALL
from lakezones.llm import queries as q
from lakezones.llm.components import components
from lakezones.llm.jaccard import RTree, _tree_join, folded, groups_of, jaccard_components, point_of, representatives

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, k):
    w = _WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(docs, k, num, den):
    sets = [(d, shingle_set(t, k)) for d, t in docs]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            common = len(a & b)
            if common and den * common >= num * (len(a) + len(b) - common):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i))) for i, (d, s) in enumerate(sets)), key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_op8(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert rows_of(q.op8_jaccard_join(spark, SF_SMALL)) == brute(docs, 4, 85, 100)


@pytest.mark.parametrize("k,num,den", [(5, 80, 100), (2, 60, 100), (1, 50, 100), (3, 100, 100)])
@pytest.mark.parametrize("part_points", [3, 4096])
def test_chains_of_edits(spark, k, num, den, part_points, monkeypatch):
    monkeypatch.setattr("lakezones.llm.jaccard.PART_POINTS", part_points)
    rng = random.Random(k * num)
    vocabulary = [f"w{i}" for i in range(300)]
    docs = []
    for _ in range(6):  # families whose members drift, so that links form chains
        text = [rng.choice(vocabulary) for _ in range(rng.randrange(3, 60))]
        for _ in range(18):
            text = list(text)
            for _ in range(rng.randrange(3)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            docs.append((len(docs), "common start here " + " ".join(text) if rng.random() < .5 else " ".join(text)))
    got = jaccard_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), k, num, den)
    assert rows_of(got) == brute(docs, k, num, den)


def test_tree_finds_what_a_scan_finds():
    rng = np.random.default_rng(1)
    base = rng.poisson(4, (20, 16))
    points = np.concatenate([np.maximum(base + rng.integers(-1, 2, base.shape), 0) for _ in range(9)]).astype(np.uint32)
    sizes, comps = points.sum(axis=1).astype(np.int64), rng.integers(0, 12, len(points))
    got = {tuple(sorted(p)) for part in RTree(points, sizes, comps).pairs(85, 100) for p in part.tolist()}
    want = set()
    for i in range(len(points)):
        for j in range(i):
            fits = 100 * sizes[i] >= 85 * sizes[j] and 100 * sizes[j] >= 85 * sizes[i]
            if comps[i] != comps[j] and fits and 185 * np.minimum(points[i], points[j]).sum() >= 85 * (sizes[i] + sizes[j]):
                want.add((j, i))
    assert got == want and want


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    rows = components(edges, "path").collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(len, groups.values())) == [2, 201]


def test_odd_rows(spark):
    t = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(5, t, 1, 1, 1), (3, t.upper(), 1, 1, 1), (3, t + "\n", 1, 1, 1), (None, t, 1, 1, 1), (2, None, 1, 1, 1), (1, "", 1, 1, 1),
            (8, " \t ", 1, 1, 1), (9, "two words", 1, 1, 1), (10, "two  words", 1, 1, 1), (None, "only null", 1, 1, 1), (11, "x " * 30000, 1, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rid int, n int, root int")
    assert rows_of(jaccard_components(docs, 4, 85, 100)) == brute([r[:2] for r in rows], 4, 85, 100)
    assert jaccard_components(docs.where("false")).collect() == []
    assert rows_of(jaccard_components(docs.where("text is null"))) == [(2, 0, 2)]


def test_points_bound_the_overlap():
    rng = np.random.default_rng(3)
    sets = [rng.choice(2**62, n, replace=False).astype(np.uint64) for n in (1, 40, 70, 900, 1100, 5000)]
    sets += [np.concatenate([sets[3][:800], sets[4][:200]]), (np.arange(2000, dtype=np.uint64) << np.uint64(40))]
    assert len(point_of(sets[-1])) == 4 * groups_of(2000)  # one group has all
    sizes = np.array([len(s) for s in sets])
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            x, y = folded([point_of(a), point_of(b)], sizes[[i, j]])
            assert x.sum() == len(a) and y.sum() == len(b)
            assert np.minimum(x, y).sum(dtype=np.int64) >= len(np.intersect1d(a, b))


def test_a_pair_comes_from_one_cell_and_parts_meet_once():
    import pyarrow as pa

    shingles = np.arange(100, dtype=np.uint64) << np.uint64(7)
    cells = {1: [5, 7, 9], 2: [6, 7, 9], 3: [5, 9]}
    found = []
    for parts in (1, 2):
        for token in (5, 6, 7, 9):
            for low in range(parts):
                for high in range(low, parts):
                    rows = [r for r in cells if token in cells[r] and r % parts in (low, high)]
                    if not rows:
                        continue
                    group = pa.table({"rid": rows, "home": [True] * len(rows), "part": [r % parts for r in rows], "n": [100] * len(rows),
                                      "low": [low] * len(rows), "high": [high] * len(rows), "comp": rows,
                                      "point": [point_of(shingles)] * len(rows),
                                      "earlier": [np.array([t for t in cells[r] if t < token], np.int64).tobytes() for r in rows]})
                    out = _tree_join(85, 100)(group)
                    found += [(parts, token, a, b) for a, b in zip(out["a"].to_pylist(), out["b"].to_pylist())]
    assert sorted(found) == [(1, 5, 1, 3), (1, 7, 1, 2), (1, 9, 2, 3), (2, 5, 1, 3), (2, 7, 1, 2), (2, 9, 2, 3)]


def test_representatives_keep_every_column_as_it_is(spark):
    import datetime as dt
    from decimal import Decimal

    schema = ("doc_id long, text string, _no_text int, n_chars int, at timestamp, local timestamp_ntz, price decimal(20,4), raw binary, "
              "tags array<string>, by map<string,int>, c0 struct<x:date,y:double>")
    t = "one two three four five six seven eight nine ten eleven twelve"
    when = dt.datetime(2024, 3, 8, 1, 2, 3, 123456)
    rest = (1, 2, when, when, Decimal("1.2345"), bytearray(b"\x00\xff"), ["a", None], {"k": 1}, (dt.date(2024, 1, 1), 0.1))
    rows = [(3, t, *rest), (2, t, *rest), (None, None, *([None] * 9)), (7, "", *rest)]
    docs = spark.createDataFrame(rows, schema)
    got = representatives(docs)
    assert got.schema.simpleString() == docs.schema.simpleString()
    assert sorted(map(repr, got.collect())) == sorted(map(repr, docs.where("doc_id is null or doc_id <> 3").collect()))
    from lakezones.llm.suffix_dedup import without_repeats

    same = without_repeats(docs.where("doc_id is null or doc_id <> 3").drop("n_chars"))
    assert sorted(map(repr, same.collect())) == sorted(map(repr, docs.where("doc_id is null or doc_id <> 3").drop("n_chars").collect()))
