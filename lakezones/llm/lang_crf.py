"""Language identification of code-switched text by a linear-chain conditional random field.

Every word gets a score for each language from its affixes, its byte n-grams and its
entry in the lexicon (all hashed into one weight table); transitions say how readily one
word's language follows another's.  Forward-backward over a sentence gives each word's posterior; the
document's language has the greatest share of its words' posteriors, and that share is the score.

The model is fitted on a bounded sample of labelled rows: ``SAMPLE_DOCS`` documents a language (those with
the least hash), ``SAMPLE_CHARS`` code points of each, for at most ``MAX_LABELS`` languages.
Sentences of the sample are spliced into code-switched sequences, so that
transitions are learned as well.  Prediction reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import filter_rows, frugal, slices
from .words import LETTER, LOWER, Texts, Words, distinct_index, mix

SAMPLE_DOCS = 400
SAMPLE_CHARS = 4000
MAX_LABELS = 64
TABLE_BITS = 18
SEQUENCE = 64  # words of a sequence: a sentence, or so many words of a longer one
SWITCH_EVERY = 12  # words between switches in the spliced training sequences, on average
ROUNDS = 60
SLICE_BYTES = 1 << 20
TRAIN_WORDS = 400_000
UNKNOWN = "und"
MIN_SCORE = 0.4  # a document of which no language has so great a share has no language

_STOPS = np.zeros(256, np.int64)
_STOPS[[0x0A, 0x21, 0x2E, 0x3F]] = 1  # newline ! . ?


class Features:
    """Feature buckets of distinct words: three affixes at either end, the whole word, byte trigrams and 4-grams."""

    def __init__(self, texts: Texts, starts: np.ndarray, ends: np.ndarray):
        lengths = ends - starts + 2
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        total = int(lengths.sum())
        inside = np.arange(total) - np.repeat(self.starts, lengths)
        source = np.repeat(starts - 1, lengths) + inside
        b = LOWER[texts.buf[np.clip(source, 0, max(len(texts.buf) - 1, 0))]] if total else np.empty(0, np.uint8)
        after = np.zeros(total, bool)
        after[1:] = b[:-1] == 0xC3
        b = np.where(after & (b >= 0x80) & (b <= 0x9E), b | 0x20, b)  # Latin-1 capitals
        b[self.starts], b[self.ends - 1] = 1, 2  # marks of a word's ends
        value = b.astype(np.uint64) + np.uint64(1)
        self.size = lengths
        room = np.repeat(self.ends, lengths) - np.arange(total)  # bytes to the end of the word
        runs = {1: value}
        for n in (2, 3, 4):
            h = np.zeros(total, np.uint64)
            h[:total - n + 1] = runs[n - 1][:total - n + 1] * np.uint64(257) + value[n - 1:]
            runs[n] = h
        self.grams = [self._bucket(np.where(room >= n, runs[n], 0), n) for n in (3, 4)]
        whole = np.add.reduceat(mix(value * np.uint64(0x9E3779B97F4A7C15) + inside.astype(np.uint64)), self.starts) if total \
            else np.empty(0, np.uint64)
        self.single = [self._bucket(whole | np.uint64(1), 5)]
        for n in (2, 3, 4):  # a mark and one to three bytes
            fits = lengths > n
            self.single.append(self._bucket(np.where(fits, runs[n][self.starts], 0), 10 + n))
            tail = np.where(fits, self.ends - n, self.starts)
            self.single.append(self._bucket(np.where(fits, runs[n][tail], 0), 20 + n))

    @staticmethod
    def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
        """Hash bucket; 0, whose weights stay 0, where there is no such feature."""
        slot = (mix(h + np.uint64(kind << 48)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        return np.where(h == 0, 0, np.maximum(slot, 1))

    def scores(self, weights: np.ndarray) -> np.ndarray:
        out = sum(weights[s] for s in self.single)
        for g in self.grams:
            out = out + np.add.reduceat(weights[g], self.starts, axis=0) / np.sqrt(self.size)[:, None].astype(np.float32)
        return out

    def gradient(self, by_word: np.ndarray) -> np.ndarray:
        """Sum of word gradients over the features."""
        size, out = 1 << TABLE_BITS, []
        scaled = by_word / np.sqrt(self.size)[:, None]
        spread = np.repeat(scaled, self.size, axis=0)
        for k in range(by_word.shape[1]):
            g = sum(np.bincount(s, by_word[:, k], size) for s in self.single)
            g = g + sum(np.bincount(s, spread[:, k], size) for s in self.grams)
            out.append(g)
        grad = np.stack(out, axis=1)
        grad[0] = 0
        return grad


def posteriors(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray, init: np.ndarray,
               pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Forward-backward of padded sequences ``[n, t, k]``; also expected transitions if ``pairs``."""
    n, t, k = scores.shape
    psi = np.exp(scores - scores.max(axis=2, keepdims=True))
    step, start = np.exp(trans).astype(psi.dtype), np.exp(init - init.max()).astype(psi.dtype)
    alpha = np.empty_like(psi)
    alpha[:, 0] = psi[:, 0] * start
    alpha[:, 0] /= alpha[:, 0].sum(axis=1, keepdims=True)
    for i in range(1, t):
        a = (alpha[:, i - 1] @ step) * psi[:, i]
        alpha[:, i] = a / a.sum(axis=1, keepdims=True)
    beta, gamma = np.ones((n, k), psi.dtype), np.empty_like(psi)
    expected = np.zeros((k, k)) if pairs else None
    for i in range(t - 1, -1, -1):
        g = alpha[:, i] * beta
        gamma[:, i] = g / g.sum(axis=1, keepdims=True)
        if i:
            ahead = psi[:, i] * beta
            if pairs:
                live = lengths > i
                joint = alpha[live, i - 1][:, :, None] * step[None] * ahead[live][:, None, :]
                expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b = ahead @ step.T
            beta = np.where((lengths > i)[:, None], b / b.sum(axis=1, keepdims=True), 1)
    return gamma, expected


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # [2^TABLE_BITS, k]
    trans: np.ndarray
    init: np.ndarray

    def word_posteriors(self, texts: Texts) -> tuple[Words, np.ndarray]:
        """Posterior of every word of all texts."""
        words = Words(texts, LETTER)
        n, k = len(words.starts), len(self.labels)
        out = np.zeros((n, k), np.float32)
        if not n:
            return words, out
        _, at, which = distinct_index(words.hash)
        score = Features(texts, words.starts[at], words.ends[at]).scores(self.weights)
        stops = np.cumsum(_STOPS[texts.buf])[words.starts]  # sentence marks before the word
        new = np.ones(n, bool)
        new[1:] = (stops[1:] != stops[:-1]) | (words.text[1:] != words.text[:-1])
        first = np.flatnonzero(new)
        inside = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
        begin = np.flatnonzero(inside % SEQUENCE == 0)
        length = np.diff(np.append(begin, n))
        low = 0
        for high in (4, 8, 16, 32, SEQUENCE):  # sequences of like length are padded together
            some = np.flatnonzero((length > low) & (length <= high))
            low = high
            for rows in np.array_split(some, max(1, len(some) * high // 400_000)):
                if not len(rows):
                    continue
                place = begin[rows][:, None] + np.arange(high)
                live = np.arange(high) < length[rows][:, None]
                got, _ = posteriors(score[which[np.where(live, place, begin[rows][:, None])]], length[rows], self.trans, self.init)
                out[place[live]] = got[live]
        return words, out


def training_sample(docs: DataFrame, sample_docs: int, sample_chars: int, max_labels: int) -> list[tuple[str, str]]:
    """Bounded ``(lang, text)`` rows: the documents of least hash of each of the most frequent languages."""
    rows = docs.where("lang is not null and text is not null").withColumn("_h", F.xxhash64("doc_id", "text"))
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_labels).collect()
    if not counts:
        return []
    share = F.lit(0.0)
    for r in counts:  # about four times the rows wanted pass; only they are ranked
        share = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, 4.0 * sample_docs / r["count"]))).otherwise(share)
    few = rows.where(F.pmod("_h", F.lit(1 << 20)) < share * (1 << 20))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_h", "doc_id"))
    few = few.select("lang", "_h", "doc_id", F.substring("text", 1, sample_chars).alias("text"))
    return [(r["lang"], r["text"]) for r in few.withColumn("_r", rank).where(F.col("_r") <= sample_docs)
            .orderBy("lang", "_r").select("lang", "text").collect()]


def fit(sample: list[tuple[str, str]], rounds: int = ROUNDS, seed: int = 7, train_words: int = TRAIN_WORDS) -> Model | None:
    """Maximum likelihood with L2, full batches, Adam; deterministic. At most ``train_words`` words of all languages a round."""
    labels = sorted({lang for lang, _ in sample})
    if not labels:
        return None
    k, rng = len(labels), np.random.default_rng(seed)
    texts = Texts(pa.array([t for _, t in sample], pa.string()))
    words = Words(texts, LETTER)
    if not len(words.starts):
        return None
    truth = np.array([labels.index(lang) for lang, _ in sample])[words.text]
    _, at, which = distinct_index(words.hash)
    feats = Features(texts, words.starts[at], words.ends[at])
    streams = [np.flatnonzero(truth == j) for j in range(k)]
    total = min(sum(map(len, streams)), train_words)
    seqs = max(1, total // SEQUENCE)
    used = np.zeros(k, np.int64)
    pick, label = np.empty((seqs, SEQUENCE), np.int64), np.empty((seqs, SEQUENCE), np.int64)
    for i in range(seqs):  # spliced: runs of one language, then another
        at_word = 0
        while at_word < SEQUENCE:
            j = int(rng.integers(k))
            if not len(streams[j]):
                continue
            run = min(int(rng.geometric(1 / SWITCH_EVERY)), SEQUENCE - at_word)
            pick[i, at_word:at_word + run] = streams[j][(used[j] + np.arange(run)) % len(streams[j])]
            label[i, at_word:at_word + run] = j
            used[j] += run
            at_word += run
    ids, hot = which[pick], np.eye(k)[label]
    seen = np.zeros((k, k))
    np.add.at(seen, (label[:, :-1].ravel(), label[:, 1:].ravel()), 1)
    full, n = np.full(seqs, SEQUENCE), seqs * SEQUENCE
    params = [np.zeros((1 << TABLE_BITS, k)), np.zeros((k, k)), np.zeros(k)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        score = feats.scores(params[0].astype(np.float32))[ids]
        gamma, expected = posteriors(score, full, params[1], params[2], pairs=True)
        error = (gamma - hot).reshape(-1, k)
        by_word = np.stack([np.bincount(ids.ravel(), error[:, j], len(at)) for j in range(k)], axis=1)
        grads = [feats.gradient(by_word) / n + 1e-6 * params[0], (expected - seen) / n, (gamma[:, 0] - hot[:, 0]).sum(axis=0) / n]
        for p, g, a, b in zip(params, grads, first, second):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= 0.1 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
        params[0][0] = 0
    return Model(labels, params[0].astype(np.float32), params[1].astype(np.float32), params[2].astype(np.float32))


def fit_documents(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS,
                  max_labels: int = MAX_LABELS, train_words: int = TRAIN_WORDS) -> Model | None:
    """Model of the labelled documents (columns doc_id, text, lang); None if nothing can be learned.  ``train_words`` bounds
    the words of all languages that a round learns from."""
    return fit(training_sample(docs, sample_docs, sample_chars, max_labels), train_words=train_words)


def predict(docs: DataFrame, model: Model | None, keep_words: bool = False) -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text; with ``keep_words`` also each word's start and end in bytes and language.

    ``und`` with score 0 if the text is null or has no letter, or nothing was learned.  Rows that share a doc_id
    and null doc_ids are predicted each; no documents: no rows.  Other columns are ignored, also lang and source.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^18 weights a language at most
    fields = [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())]
    if keep_words:
        fields.append(("words", pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64()), ("lang", pa.string())]))))
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                pred, score, marks = _judge(shared.value, part["text"], keep_words)
                out = {"doc_id": part["doc_id"], "lang_pred": pred, "score": score}
                if keep_words:
                    out["words"] = marks
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    kind = ", words array<struct<from: bigint, to: bigint, lang: string>>" if keep_words else ""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(frugal(run), f"doc_id long, lang_pred string, score double{kind}")


def _judge(crf: Model | None, column: pa.Array, keep_words: bool) -> tuple[list[str], np.ndarray, list[list]]:
    texts = Texts(column)
    n = len(texts)
    pred, score = [UNKNOWN] * n, np.zeros(n)
    marks: list[list] = [[] for _ in range(n)]
    if crf is None:
        return pred, score, marks
    words, post = crf.word_posteriors(texts)
    sums = np.stack([np.bincount(words.text, post[:, j], n) for j in range(len(crf.labels))], axis=1)
    found, best = sums.sum(axis=1), sums.argmax(axis=1)
    for i in np.flatnonzero(found > 0):
        if any(c.isalpha() for c in column[int(i)].as_py()):
            pred[i], score[i] = crf.labels[best[i]], min(1.0, sums[i, best[i]] / found[i])
    if keep_words:
        for i, a, b, j in zip(words.text, words.starts, words.ends, post.argmax(axis=1)):
            base = int(texts.starts[i])
            marks[i].append({"from": int(a) - base, "to": int(b) - base, "lang": crf.labels[j]})
    return pred, score, marks


def in_language(docs: DataFrame, model: Model | None, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents, all columns, whose language is known with ``min_score`` or more; all if nothing was learned."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(part: pa.RecordBatch) -> list[bool]:
        pred, score, _ = _judge(shared.value, part["text"], False)
        return [p != UNKNOWN and s >= min_score for p, s in zip(pred, score)]

    return filter_rows(docs, keep, SLICE_BYTES)
