"""Byte-level BPE in batched numpy merge rounds, and its decoding.

The symbols of many words lie in one flat array.  A round looks up every neighbouring pair by binary search over
the sorted pair keys, takes each word's lowest rank, and merges that pair wherever it stands in its
word; words without a known pair leave the array.  Merging all places of a pair at once is the library's order as long as no merge
makes a pair of lower rank than its own, which is checked when a vocabulary is read; one
that fails this merges one place of each word a round.  A word of more than ``LONG_WORD`` bytes goes by ranks instead: the places of
each rank wait in a bucket, so that a round touches only the places it merges.

Words come from the pattern of byte-level pre-tokenisation.  Code points that ``regex`` and the library put
in different classes (their Unicode versions differ) are found by trying each new one; texts that hold
some are cut by the library's pre-tokeniser.  Ids of words are kept in a bounded cache.
"""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_by_worker, slices

SLICE_BYTES = 2 << 20
CACHE_WORDS = 300_000  # about 60 MB a worker; then the cache starts anew
LONG_WORD = 1024
NO_RANK = np.iinfo(np.int32).max
# Fixed value: the pattern of byte-level pre-tokenisation.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = {b for b in range(256) if chr(b).isprintable() and b != 0x20}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Bpe:
    """A byte-level BPE vocabulary from a tokenizer's JSON file."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS, long_word: int = LONG_WORD):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, split = file["model"], file["pre_tokenizer"] or {}
        plain = (model["type"] == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                 and not split.get("add_prefix_space") and file["normalizer"] is None
                 and (file["decoder"] or {}).get("type") == "ByteLevel"
                 and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                                    "byte_fallback", "ignore_merges")))
        added = file["added_tokens"]
        if not plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        self.path, self.cache_words, self.long_word = path, cache_words, long_word
        self.added = {t["content"]: t["id"] for t in added}
        # the leftmost, and of those the longest, added token cuts the text
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, longest_first))) if self.added else None

        vocab, letters = model["vocab"], byte_letters()
        self.bytes = np.array([vocab[c] for c in letters], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.size = max([*vocab.values(), *self.added.values()], default=0) + 1
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made[order]
        rank_of = np.full(self.size, -1)
        np.maximum.at(rank_of, made, np.arange(len(made)))
        place = np.arange(len(made))
        self.in_order = bool((rank_of[left] < place).all() and (rank_of[right] < place).all())

        byte_of = {c: b for b, c in enumerate(letters)}
        texts = [b""] * self.size
        for token, i in [*vocab.items(), *self.added.items()]:
            known = all(c in byte_of for c in token)
            texts[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        lengths = np.array([len(t) for t in texts], np.int64)
        self.token_bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.token_starts = np.cumsum(lengths) - lengths
        self.token_lengths = lengths

        self.words: dict[str, bytes] = {t: np.array([i], "<u4").tobytes() for t, i in self.added.items()}
        self.tried: set[str] = set(map(chr, range(128)))
        self.odd: set[str] = set()
        self.splitter = None

    def _rank(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NO_RANK`` if there is none) and merged symbol of pairs."""
        if not len(self.keys):
            return np.full(len(a), NO_RANK, np.int32), a
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK), self.made[at]

    def merged(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word."""
        out: list = [np.empty(0, np.int64)] * len(words)
        for i, w in enumerate(words):
            if len(w) > self.long_word and self.in_order:
                out[i] = self._by_rank(self.bytes[np.frombuffer(w, np.uint8)])
        some = [i for i, w in enumerate(words) if w and not (len(w) > self.long_word and self.in_order)]
        if not some:
            return out
        symbols = self.bytes[np.frombuffer(b"".join(words[i] for i in some), np.uint8)]
        owner = np.repeat(np.array(some), [len(words[i]) for i in some])
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            rank, made = self._rank(symbols, np.append(symbols[1:], 0))
            rank[np.append(first[1:], len(symbols)) - 1] = NO_RANK  # a word's last symbol begins no pair
            lengths = np.diff(np.append(first, len(symbols)))
            lowest = np.minimum.reduceat(rank, first)
            done = lowest == NO_RANK
            if done.any():
                for a, n in zip(first[done], lengths[done]):
                    out[owner[a]] = symbols[a:a + n]
            hit = (rank == np.repeat(lowest, lengths)) & (rank != NO_RANK)
            if self.in_order:
                at = np.flatnonzero(hit)
                begins = np.concatenate([[True], np.diff(at) != 1]) if len(at) else np.empty(0, bool)
                nth = np.arange(len(at)) - np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
                at = at[nth % 2 == 0]  # a run of one symbol merges from the left
            else:
                where = np.flatnonzero(hit)
                at = where[np.concatenate([[True], owner[where][1:] != owner[where][:-1]])] if len(where) else where
            symbols[at] = made[at]
            keep = np.repeat(~done, lengths)
            keep[at + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return out

    def _by_rank(self, symbols: np.ndarray) -> np.ndarray:
        """One long word: places wait in buckets by the rank of their pair."""
        n = len(symbols)
        after, before, alive = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, bool)
        buckets: dict[int, list] = {}
        heap: list[int] = []

        def wait(at: np.ndarray) -> None:
            at = at[(at >= 0) & (at < n)]
            at = at[after[at] < n]
            rank, _ = self._rank(symbols[at], symbols[after[at]])
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            at, rank = at[rank != NO_RANK], rank[rank != NO_RANK]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for part, r in zip(np.split(at, cuts), rank[np.concatenate([[0], cuts])] if len(rank) else []):
                if int(r) not in buckets:
                    buckets[int(r)] = []
                    heapq.heappush(heap, int(r))
                buckets[int(r)].append(part)

        wait(np.arange(n))
        while heap:
            rank = heapq.heappop(heap)
            at = np.unique(np.concatenate(buckets.pop(rank)))
            at = at[alive[at]]
            at = at[after[at] < n]
            now, made = self._rank(symbols[at], symbols[after[at]])
            at, made = at[now == rank], made[now == rank]
            if not len(at):
                continue
            begins = np.concatenate([[True], at[1:] != after[at[:-1]]])
            nth = np.arange(len(at)) - np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
            at, made = at[nth % 2 == 0], made[nth % 2 == 0]
            gone = after[at]
            symbols[at], alive[gone] = made, False
            after[at] = after[gone]
            inside = after[at] < n
            before[after[at][inside]] = at[inside]
            wait(np.unique(np.concatenate([before[at], at])))
        return symbols[alive]

    def _cut(self, text: str) -> list[str]:
        """Words of a text without added tokens."""
        if not text.isascii():
            new = set(text) - self.tried
            if new:
                self._try(new)
            if self.odd and not self.odd.isdisjoint(text):
                return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]
        return WORD.findall(text)

    def _try(self, new: set[str]) -> None:
        """Learn which new code points the library puts in another class."""
        if self.splitter is None:
            from tokenizers import pre_tokenizers

            self.splitter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        for c in new:
            probe = f"a{c}1{c}!{c}"
            if [m.span() for m in WORD.finditer(probe)] != [span for _, span in self.splitter.pre_tokenize_str(probe)]:
                self.odd.add(c)
        self.tried |= new

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; strings of added tokens are their ids."""
        if len(self.words) > self.cache_words:
            self.words = {t: np.array([i], "<u4").tobytes() for t, i in self.added.items()}
        parts = []
        for text in texts:
            if self.cut is None or not self.cut.search(text):
                parts.append(self._cut(text))
                continue
            words, at = [], 0
            for m in self.cut.finditer(text):
                words += [*self._cut(text[at:m.start()]), m.group()]
                at = m.end()
            parts.append(words + self._cut(text[at:]))
        new = list(set().union(*parts).difference(self.words))
        for word, ids in zip(new, self.merged([w.encode() for w in new])):
            self.words[word] = ids.astype("<u4").tobytes()
        get = self.words.__getitem__
        return [b"".join(map(get, words)) for words in parts]

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters, ids without a token nothing."""
        i = np.frombuffer(ids, "<u4").astype(np.int64)
        i = i[i < self.size]
        lengths = self.token_lengths[i]
        ends = np.cumsum(lengths)
        within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
        return self.token_bytes[np.repeat(self.token_starts[i], lengths) + within].tobytes().decode("utf-8", "replace")


_MODELS: dict[str, Bpe] = kept_by_worker("bpe")


def bpe(path: str, cache_words: int = CACHE_WORDS) -> Bpe:
    """This worker's model of one file; another file takes its place."""
    if path not in _MODELS:
        _MODELS.clear()
        _MODELS[path] = Bpe(path)
    _MODELS[path].cache_words = cache_words
    return _MODELS[path]


def encoded(docs: DataFrame, tokenizer_path: str, cache_words: int = CACHE_WORDS) -> DataFrame:
    """``doc_id, ids`` of every whole text (null: empty), little-endian unsigned 32-bit.

    Rows that share a doc_id and null doc_ids stay rows of their own; an empty table gives no rows; other columns are
    ignored.  A few MB of text are in work at a time; a longer text is alone.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        model = bpe(tokenizer_path, cache_words)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids = model.encode(part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(ids, pa.binary())], schema=schema)

    text = F.coalesce("text", F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(run, "doc_id long, ids binary")


def decoded(rows: DataFrame, tokenizer_path: str) -> DataFrame:
    """``rows`` (columns doc_id, ids) with the ``text`` of their ids (null: empty)."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(tokenizer_path)
        for batch in batches:
            for part in slices(batch, "ids", SLICE_BYTES):
                texts = [model.decode(i or b"") for i in part["ids"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["ids"], pa.array(texts, pa.string())], schema=schema)

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def round_trip(docs: DataFrame, tokenizer_path: str, cache_words: int = CACHE_WORDS) -> DataFrame:
    """``encoded`` and ``decoded`` in one pass: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole text.

    Digests are of the decimal ids joined by commas and of the text that the ids give back.  One worker a task does
    both, so that a task holds one cache.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        model = bpe(tokenizer_path, cache_words)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                out = {name: [] for name in schema.names}
                for doc, ids in zip(part["doc_id"].to_pylist(), model.encode(part["text"].to_pylist())):
                    numbers = np.frombuffer(ids, "<u4").tolist()
                    out["doc_id"].append(doc)
                    out["n_tokens"].append(len(numbers))
                    out["ids_sha256"].append(sha256(",".join(map(str, numbers)).encode()).hexdigest())
                    out["decoded_sha256"].append(sha256(model.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    text = F.coalesce("text", F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
