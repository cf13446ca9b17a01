"""Benchmark decontamination by latent semantic retrieval.

1. Statistics.  Document frequencies of all words over all documents.  Words of the benchmark
   have their own columns, all others share ``SHARED`` hashed ones.
2. Latent space.  A randomised SVD of the TF-IDF matrix of passages, run by Spark in one pass: the Gram matrix times a random
   range is a sum of per-task products, and the range and its image give the singular vectors (Nystroem); the driver
   sees matrices of the benchmark's words x rank only.  Its rows are all passages of all documents, which together weigh as
   ``CORPUS_PASSAGES`` at most, and the benchmark's passages, with weight ``BENCHMARK_WEIGHT``; its columns are the words that project.
3. Search.  Every window of every whole document is projected by its benchmark words and compared by cosine with
   the benchmark passages of its length class.  What the space does not hold of a window counts in its length, so a
   window that shares a few common words is far from every item.  The benchmark is the query set; it goes out in
   blocks of ``ITEM_BLOCK`` items.
   Beside it, every stretch of ``3 n`` words (at multiples of ``n``) that can hold enough of an item's ``n`` words is
   found by counting the item's least frequent words, whatever their weight: an item that many documents hold, a
   small corpus and an item of few words lose no leak.
4. Proof.  A candidate's longest common subsequence of words with the item, and with the item's answer (its
   last sentence), decides; so paraphrases that drop, add or swap words are found and chance cosines are not.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filter_rows, frugal, slices
from .words import ALNUM, Texts, Words, distinct

SHARED = 1 << 15
RANK = 112
OVERSAMPLE = 10
BENCHMARK_WEIGHT = 20.0
CORPUS_PASSAGES = 32_000  # weight of all documents' passages together, if there are more
PASSAGE = 32
STEP = 8  # words of a block; windows are 2, 4 or 8 blocks
CLASSES = ((16, 20), (32, 44), (64, 1 << 60))  # window, longest query passage
LONGEST = 64  # words of a query passage; longer items have several
COSINE = 0.5  # of window and item, estimated: the item's share outside the space is made up for
RARE = 1.5  # idf of the words by which windows are projected: those of at most about a quarter of the documents
BUCKET_BITS = 17  # of a hash, by which known words are looked up
SIGN_SHARE = 0.15  # of an item's words, that a stretch must hold among the item's least frequent ones
HITS = 1 << 21  # signature words of items counted at once
LCS_SHARE = 0.7  # of the item's words, in order
QUESTION_SHARE, ANSWER_SHARE = 0.6, 0.8  # or of question and answer each
ITEM_BLOCK = 4096
SLICE_BYTES = 1 << 20
_CHUNK = 64  # rows of a matrix in one shuffled piece; pieces of a chunk from all tasks are summed in one group


@dataclass
class Item:
    item_id: int
    words: np.ndarray  # hashes
    answer_from: int
    masks: dict[int, int] = field(default_factory=dict)
    least: int = 0  # words of it that any window with a leak holds

    def __post_init__(self):
        for i, h in enumerate(self.words.tolist()):
            self.masks[h] = self.masks.get(h, 0) | 1 << i
        self.least = least_words(self)

    def shares(self, window: list[int]) -> tuple[float, float, float]:
        """Longest common subsequence with the whole item, its question and its answer, as shares of their words."""
        n, a = len(self.words), self.answer_from
        bits = [m for m in map(self.masks.get, window) if m]
        low = (1 << a) - 1
        return (lcs(bits, n) / n, lcs([m & low for m in bits if m & low], a) / a if a else 1.0,
                lcs([m >> a for m in bits if m >> a], n - a) / (n - a) if n > a else 1.0)


def lcs(bits: list[int], n: int) -> int:
    """Length of the longest common subsequence; ``bits``: where each word stands in the other sequence of ``n``."""
    full = v = (1 << n) - 1
    for m in bits:
        u = v & m
        v = (v + u | v - u) & full
    return n - v.bit_count()


def leaks(item: Item, window: list[int]) -> tuple[bool, float, float]:
    if sum(map(item.masks.__contains__, window)) < item.least:
        return False, 0.0, 0.0
    whole, question, answer = item.shares(window)
    return whole >= LCS_SHARE or (question >= QUESTION_SHARE and answer >= ANSWER_SHARE), whole, answer


def least_words(item: Item) -> int:
    """Words of the item that any window with a leak holds."""
    def least(n: int, share: float) -> int:
        return next((k for k in range(n + 1) if k >= share * n - 1e-9), n)

    n, a = len(item.words), item.answer_from
    return min(least(n, LCS_SHARE), least(a, QUESTION_SHARE) + least(n - a, ANSWER_SHARE))


def read_items(rows: list) -> list[Item]:
    """Items of two words or more; the answer is the last sentence, if there are two."""
    out = []
    texts = Texts(pa.array([r["text"] for r in rows], pa.string()))
    words = Words(texts, ALNUM)
    stops = np.cumsum(np.isin(texts.buf, [0x0A, 0x21, 0x2E, 0x3F]))
    for i, r in enumerate(rows):
        some = slice(*np.searchsorted(words.text, [i, i + 1]))
        h = words.hash[some]
        if len(h) < 2:
            continue
        sentence = stops[words.starts[some]]
        first = int(np.searchsorted(sentence, sentence[-1]))
        out.append(Item(r["item_id"], h, first or len(h)))
    return out


@dataclass
class Vocabulary:
    known: np.ndarray  # sorted hashes of the benchmark's words
    weight: np.ndarray | None = None  # idf of each column

    def __post_init__(self):
        """First of the known words of each bucket (the hash's first bits), and the most words of one."""
        first = np.searchsorted(self.known, np.arange(1 << BUCKET_BITS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS))
        self.bucket = first.astype(np.int32)
        self.most = int(np.diff(first, append=len(self.known)).max())
        self.padded = np.append(self.known, np.repeat(self.known[-1:], self.most))

    @property
    def size(self) -> int:
        return len(self.known) + SHARED

    def columns(self, h: np.ndarray) -> np.ndarray:
        at = self.bucket[h >> np.uint64(64 - BUCKET_BITS)]
        out = len(self.known) + (h >> np.uint64(49)).astype(np.int64) % SHARED
        for k in range(self.most - 1, -1, -1):  # a place beyond the known words gives way to the true one
            own = np.flatnonzero(self.padded[at + k] == h)
            out[own] = at[own] + k
        return out

    def rare(self) -> np.ndarray:
        """Which of the benchmark's words project."""
        return self.weight[:len(self.known)] >= RARE


def document_frequencies(docs: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, int]:
    """Documents that hold each column's words, and the number of documents; over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = pa.schema([("col", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        df, n = np.zeros(v.size, np.int64), 0
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = Texts(part["text"])
                words = Words(texts, ALNUM)
                pairs = distinct(words.text * v.size + v.columns(words.hash))
                df += np.bincount(pairs % v.size, minlength=v.size)
                n += len(texts)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"col": np.append(some, -1), "n": np.append(df[some], n)}, schema=schema)

    rows = docs.select("text").mapInArrow(frugal(run), "col int, n long").groupBy("col").agg(F.sum("n").alias("n")).collect()
    df, total = np.zeros(vocabulary.size, np.int64), 0  # one row a column
    for r in rows:
        if r["col"] < 0:
            total = r["n"]
        else:
            df[r["col"]] = r["n"]
    return df, total


def passages(texts: Texts, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Projecting words of all ``PASSAGE``-word passages: columns, weights and where each passage's begin; and the number of passages.

    A passage's TF-IDF vector, of all its words, has length 1 (repeats taken as they come).
    """
    words = Words(texts, ALNUM)
    if not len(words.starts):
        return np.empty(0, np.int64), np.empty(0, np.float32), np.empty(0, np.int64), 0
    counts, cols = words.counts(texts), vocabulary.columns(words.hash)
    first = np.cumsum(counts) - counts
    new = (np.arange(len(cols)) - first[words.text]) % PASSAGE == 0
    begin, w = np.flatnonzero(new), vocabulary.weight[cols]
    norm = np.sqrt(np.add.reduceat(w * w, begin))
    own = np.flatnonzero(np.append(vocabulary.rare(), np.zeros(SHARED, bool))[cols])
    passage = (np.cumsum(new) - 1)[own]
    return (cols[own], (w[own] / np.maximum(norm, 1e-9)[passage]).astype(np.float32),
            np.flatnonzero(np.diff(passage, prepend=-1)), len(begin))


def _sums(rows: np.ndarray, at: np.ndarray, w: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Weighted sums of the ``rows`` at places ``at``, for each group; four places at a time, by bands."""
    sizes = np.diff(begin, append=len(at))
    fours = -(-sizes // 4)
    ends = np.cumsum(fours)
    to = np.arange(len(at)) + np.repeat(4 * (ends - fours) - begin, sizes)
    places, weights = np.zeros(4 * ends[-1], np.int64), np.zeros(4 * ends[-1], np.float32)
    places[to], weights[to] = at, w
    out = np.empty((ends[-1], rows.shape[1]), np.float32)
    for i in range(0, len(out), 512):
        a, b = 4 * i, 4 * min(i + 512, len(out))
        np.matmul(weights[a:b].reshape(-1, 1, 4), rows.take(places[a:b], axis=0).reshape(-1, 4, rows.shape[1]),
                  out=out[i:i + 512].reshape(-1, 1, rows.shape[1]))
    return np.add.reduceat(out, ends - fours, axis=0)


def _gram_product(cols: np.ndarray, w: np.ndarray, begin: np.ndarray, m: np.ndarray, out: np.ndarray) -> None:
    """Adds A' (A m) to ``out``."""
    if not len(cols):
        return
    z = _sums(m, cols, w, begin)
    passage = np.repeat(np.arange(len(begin)), np.diff(begin, append=len(cols)))
    order = np.argsort(cols, kind="stable")
    s = cols[order]
    new = np.flatnonzero(np.diff(s, prepend=-1))
    out[s[new]] += _sums(z, passage[order], w[order], new)


def _product(rows: DataFrame, vocabulary: Vocabulary, m: np.ndarray) -> tuple[np.ndarray, int]:
    """A' A m of the rows' passages, and their number; summed over Spark's tasks."""
    shared = rows.sparkSession.sparkContext.broadcast((vocabulary, m.astype(np.float32)))
    schema = pa.schema([("chunk", pa.int32()), ("n", pa.int64()), ("data", pa.binary())])
    types = "chunk int, n long, data binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, mat = shared.value
        total, n = np.zeros(mat.shape, np.float32), 0
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                cols, w, begin, more = passages(Texts(part["text"]), v)
                _gram_product(cols, w, begin, mat, total)
                n += more
        for i in range(0, len(total), _CHUNK):
            yield pa.RecordBatch.from_pydict({"chunk": [i], "n": [n], "data": [total[i:i + _CHUNK].tobytes()]}, schema=schema)

    def add(group: pa.Table) -> pa.Table:
        whole = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in group["data"])
        return pa.table({"chunk": group["chunk"][:1], "n": [sum(group["n"].to_pylist())], "data": [whole.astype("<f4").tobytes()]},
                        schema=schema)

    sums = rows.select("text").mapInArrow(frugal(run), types).groupBy("chunk").applyInArrow(add, types)
    out, n = np.zeros(m.shape), 0
    for r in sums.collect():  # the benchmark's words x rank
        part = np.frombuffer(r["data"], "<f4").reshape(-1, m.shape[1])
        out[r["chunk"]:r["chunk"] + len(part)], n = part, r["n"]
    return out, n


def latent_space(docs: DataFrame, bench: DataFrame, vocabulary: Vocabulary, rank: int = RANK, seed: int = 3) -> np.ndarray:
    """Right singular vectors ``[benchmark's words, rank]`` of all passages by a randomised SVD; words that do not project are 0."""
    m = np.random.default_rng(seed).standard_normal((len(vocabulary.known), rank + OVERSAMPLE)) * vocabulary.rare()[:, None]
    m, _ = np.linalg.qr(m)
    m = m.astype(np.float32).astype(np.float64)  # as the tasks have it
    corpus, n = _product(docs, vocabulary, m)
    image = corpus * min(1.0, CORPUS_PASSAGES / max(n, 1)) + BENCHMARK_WEIGHT ** 2 * _product(bench, vocabulary, m)[0]
    core = m.T @ image
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    some = values > 1e-6 * max(values[-1], 1e-30)
    left, _, _ = np.linalg.svd(image @ (vectors[:, some] / np.sqrt(values[some])), full_matrices=False)
    return left[:, :rank].astype(np.float32) if some.any() else np.zeros((len(m), 1), np.float32)


@dataclass
class Signatures:
    """Of each item the least frequent words (known words' columns) and how many of them each leak holds.

    A leak lacks at most ``n - least_words`` of the item's words, so of any ``n - least_words + r`` it holds ``r``.
    """

    cols: np.ndarray  # those of all items
    weight: np.ndarray  # how often the word stands in the signature
    begin: np.ndarray  # where each item's begin
    least: np.ndarray  # r
    sizes: np.ndarray  # words of each item

    @classmethod
    def of(cls, vocabulary: Vocabulary, items: list[Item], df: np.ndarray) -> "Signatures":
        cols, weight, least = [], [], []
        for item in items:
            own, need = vocabulary.columns(item.words), item.least
            r = min(need, max(1, int(np.ceil(SIGN_SHARE * len(own)))))
            rarest = own[np.lexsort((own, df[own]))][:len(own) - need + r]  # copies of a word side by side
            c, n = np.unique(rarest, return_counts=True)
            cols.append(c)
            weight.append(n)
            least.append(r)
        begin = np.cumsum([0, *map(len, cols)])
        return cls(np.concatenate(cols), np.concatenate(weight), begin, np.array(least), np.array([len(i.words) for i in items]))

    def stretches(self, words: Words, first: np.ndarray, cols: np.ndarray, n_known: int) -> Iterator[tuple[int, int]]:
        """(first word, item) of every stretch of three times the item's words that may hold a leak."""
        n_words = len(cols)
        at = np.flatnonzero(cols < n_known)
        at = at[np.argsort(cols[at], kind="stable")]  # places of each known word
        occurs = np.bincount(cols[at], minlength=n_known)
        start = np.cumsum(occurs) - occurs
        hits = occurs[self.cols]
        ends = np.cumsum(np.add.reduceat(hits, self.begin[:-1]))
        i = 0
        while i < len(ends):
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + HITS, side="right")))
            some = slice(self.begin[i], self.begin[j])
            n = hits[some]
            item = np.repeat(np.repeat(np.arange(i, j), np.diff(self.begin[i:j + 1])), n)
            place = at[np.repeat(start[self.cols[some]] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            size, text = self.sizes[item], first[words.text[place]]
            back = (place - text) % size
            key, total = _summed((item - i) * n_words + place - back, np.repeat(self.weight[some], n))
            # a block counts in the stretches that begin with it, one and two blocks before
            item, place = key // n_words + i, key % n_words
            size, text = self.sizes[item], first[words.text[place]]
            keys = [(key - k * size)[place - k * size >= text] for k in range(3)]
            key, total = _summed(np.concatenate(keys), np.concatenate([total[place - k * size >= text] for k in range(3)]))
            item = key // n_words + i
            for x in np.flatnonzero(total >= self.least[item]):
                yield int(key[x] % n_words), int(item[x])
            i = j


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys)
    s = keys[order]
    new = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    return s[new], np.add.reduceat(values[order], new)


@dataclass
class Index:
    vocabulary: Vocabulary
    terms: np.ndarray  # idf-weighted vectors of the benchmark's words
    rare: np.ndarray  # which columns project
    items: list[Item]
    queries: list[tuple[np.ndarray, np.ndarray]]  # for each class: scaled vectors, items
    signatures: Signatures

    @classmethod
    def of(cls, vocabulary: Vocabulary, space: np.ndarray, items: list[Item], df: np.ndarray) -> "Index":
        rare = np.append(vocabulary.rare(), np.zeros(SHARED, bool))
        terms = space * np.where(vocabulary.rare(), vocabulary.weight[:len(space)], 0)[:, None].astype(np.float32)
        found: list[tuple[list, list]] = [([], []) for _ in CLASSES]
        for i, item in enumerate(items):
            parts = max(1, -(-len(item.words) // (LONGEST * 5 // 4)))
            for part in np.array_split(item.words, parts):
                c = next(c for c, (_, most) in enumerate(CLASSES) if len(part) <= most)
                cols = vocabulary.columns(part)
                v, whole = terms[cols].sum(axis=0), np.sqrt((vocabulary.weight[cols] ** 2).sum())
                found[c][0].append(v * (whole / max(float(v @ v), 1e-9)))
                found[c][1].append(i)
        queries = [(np.array(v, np.float32).reshape(-1, space.shape[1]), np.array(i, np.int64)) for v, i in found]
        return cls(vocabulary, terms, rare, items, queries,
                   Signatures.of(vocabulary, items, df))

    def similarity(self, item: Item, window: np.ndarray) -> float:
        """Cosine of the TF-IDF vectors of an item and a window."""
        (a, n), (b, m) = (np.unique(h, return_counts=True) for h in (item.words, window))
        v, w = n * self.vocabulary.weight[self.vocabulary.columns(a)], m * self.vocabulary.weight[self.vocabulary.columns(b)]
        _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
        return min(1.0, float(v[i] @ w[j] / np.sqrt((v @ v) * (w @ w))))

    def candidates(self, texts: Texts, words: Words, cols: np.ndarray, cosine: float) -> list[tuple[int, int, int, float]]:
        """(first word, last word + 1 of the window, item, cosine) of every window and query at ``cosine`` or more."""
        n = len(words.starts)
        if not n:
            return []
        counts = words.counts(texts)
        first = np.cumsum(counts) - counts
        begin = np.flatnonzero((np.arange(n) - first[words.text]) % STEP == 0)
        owner = words.text[begin]
        own = np.flatnonzero(self.rare[cols])
        length = np.add.reduceat(self.vocabulary.weight[cols] ** 2, begin)
        bounds = np.searchsorted(own, begin)
        full = np.flatnonzero(np.diff(np.append(bounds, len(own))))  # blocks with a word of the benchmark
        cur = np.zeros((len(begin), self.terms.shape[1]), np.float32)
        for i in range(0, len(full), 4096):
            some = full[i:i + 4096]
            a, b = bounds[some[0]], bounds[full[i + 4096]] if i + 4096 < len(full) else len(own)
            cur[some] = _sums(self.terms, cols[own[a:b]], np.ones(b - a, np.float32), bounds[some] - a)
        out, blocks = [], 1
        for (size, _), (vectors, items) in zip(CLASSES, self.queries):
            while blocks * STEP < size:  # windows of twice the blocks, cut at the text's end
                same = np.flatnonzero(owner[blocks:] == owner[:max(len(owner) - blocks, 0)])
                more, longer = cur.copy(), length.copy()
                more[same] += cur[same + blocks]
                longer[same] += length[same + blocks]
                cur, length, blocks = more, longer, blocks * 2
            if not len(items):
                continue
            some = np.flatnonzero(((begin - first[owner]) // STEP % max(1, blocks // 2) == 0) & cur.any(axis=1))
            score = cur[some] @ vectors.T
            w, j = np.nonzero(score >= cosine * np.sqrt(length[some])[:, None])
            # repeated words count once in ``length``; the projection is never longer than the window
            norm = np.maximum(np.sqrt(length[some[w]]), np.linalg.norm(cur[some[w]], axis=1))
            value = score[w, j] / np.maximum(norm, 1e-9)
            for x in np.flatnonzero(value >= cosine):
                a = int(begin[some[w[x]]])
                t = owner[some[w[x]]]
                out.append((a, min(a + size, int(first[t] + counts[t])), int(items[j[x]]), min(1.0, float(value[x]))))
        return out

    def stretches(self, texts: Texts, words: Words, cols: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(first word, last word + 1, item) of every stretch that holds enough of an item's words."""
        if len(words.starts):
            ends = np.cumsum(words.counts(texts))
            first = ends - words.counts(texts)
            for a, i in self.signatures.stretches(words, first, cols, len(self.vocabulary.known)):
                yield a, min(a + 3 * len(self.items[i].words), int(ends[words.text[a]])), i


def build_index(docs: DataFrame, items: list[Item], df: np.ndarray, n_docs: int, vocabulary: Vocabulary,
                bench: DataFrame) -> Index:
    vocabulary = Vocabulary(vocabulary.known, np.log((1 + n_docs) / (1 + df)) + 0.1)
    return Index.of(vocabulary, latent_space(docs, bench, vocabulary), items, df)


FOUND = "doc_id long, item_id long, cosine double, lcs_share double, answer_share double"
_FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs_share", pa.float64()),
                    ("answer_share", pa.float64())])


def _leaks_in(ix: Index, column: pa.Array, cosine: float) -> dict[tuple[int, int], tuple[float, float, float]]:
    """(lcs share, answer share, cosine) by text and item: the best window of each leak."""
    texts = Texts(column)
    words = Words(texts, ALNUM)
    cols = ix.vocabulary.columns(words.hash)
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for a, b, i, score in ix.candidates(texts, words, cols, cosine):
        item, t = ix.items[i], int(words.text[a])
        x, y = max(a - len(item.words), 0), min(b + len(item.words), len(words.text))
        inside = words.text[x:y] == t
        leak, whole, answer = leaks(item, words.hash[x:y][inside].tolist())
        if leak:
            best[t, i] = max(best.get((t, i), (0.0, 0.0, 0.0)), (whole, answer, score))
    for a, b, i in ix.stretches(texts, words, cols):
        item, t, window = ix.items[i], int(words.text[a]), words.hash[a:b]
        leak, whole, answer = leaks(item, window.tolist())
        if leak and (whole, answer) > best.get((t, i), (0.0, 0.0))[:2]:
            best[t, i] = whole, answer, ix.similarity(item, window)
    return best


def search(docs: DataFrame, index: Index, cosine: float = COSINE) -> DataFrame:
    """Leaks among all windows of all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids = part["doc_id"].to_pylist()
                rows = [{"doc_id": ids[t], "item_id": ix.items[i].item_id, "cosine": v[2], "lcs_share": v[0], "answer_share": v[1]}
                        for (t, i), v in sorted(_leaks_in(ix, part["text"], cosine).items())]
                yield pa.RecordBatch.from_pylist(rows, schema=_FOUND)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(frugal(run), FOUND)


def indexes(docs: DataFrame, benchmark: DataFrame) -> Iterator[Index]:
    """An index for each block of the benchmark."""
    bench = benchmark.select(F.col("item_id").cast("long"), "text")
    ordered = bench.where("text is not null").withColumn("_h", F.xxhash64("item_id", "text"))
    blocks = max(1, -(-ordered.count() // ITEM_BLOCK))
    for b in range(blocks):
        part = ordered.where(F.pmod("_h", F.lit(blocks)) == b).select("item_id", "text")
        items = read_items(part.orderBy("item_id", "text").collect())  # about ITEM_BLOCK rows
        if not items:
            continue
        vocabulary = Vocabulary(np.unique(np.concatenate([i.words for i in items])))
        df, n = document_frequencies(docs, vocabulary)
        if n:
            yield build_index(docs, items, df, n, vocabulary, part)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, cosine, lcs_share, answer_share`` of every document that holds a benchmark item.

    One row a pair (the best window); of rows that share a doc_id each counts.  Null texts, and items of fewer than
    two words, match nothing; null doc_ids and item_ids are kept.  Empty tables give no rows.  Other columns
    are ignored.
    """
    out = None
    for index in indexes(docs, benchmark):
        found = search(docs, index)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], FOUND) if out is None else out


def without_leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE) -> DataFrame:
    """The documents, all columns, that hold no benchmark item."""
    out = docs
    for index in indexes(docs, benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def keep(part: pa.RecordBatch, shared=shared) -> list[bool]:
            leaky = {t for t, _ in _leaks_in(shared.value, part["text"], cosine)}
            return [i not in leaky for i in range(part.num_rows)]

        out = filter_rows(out, keep, SLICE_BYTES)
    return out
