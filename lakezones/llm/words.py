"""Words of many texts at once: spans and 64-bit hashes from one byte buffer."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
_BYTES = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_RUN = 1 << 16  # bytes that share a table of powers
_POWERS = np.cumprod(np.append(np.uint64(1), np.full(_RUN - 1, _BASE)), dtype=np.uint64)
_INVERSE = pow(int(_BASE), -1, 1 << 64)  # the base is odd
_INVERSES = np.cumprod(np.append(np.uint64(1), np.full(_RUN - 1, _INVERSE, np.uint64)), dtype=np.uint64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
LETTER = np.zeros(256, bool)  # ASCII letters and the bytes of all other code points
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
ALNUM = LETTER.copy()
ALNUM[0x30:0x3A] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_LOWER_BYTES = _BYTES[LOWER]


def mix(h: np.ndarray) -> np.ndarray:
    """Bit mixer (a bijection of 64-bit numbers)."""
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    s = np.sort(x)
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    return s[new]


def distinct_index(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, a place of each, and which of them every place has."""
    order = np.argsort(x)
    s = x[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    which = np.empty(len(x), np.int64)
    which[order] = np.cumsum(new) - 1
    return s[new], order[new], which


def _prefix_sums(buf: np.ndarray) -> np.ndarray:
    """Sums of the bytes before each place, each byte weighted by the base to the power of its place."""
    out = np.zeros(len(buf) + 1, np.uint64)
    for run, a in enumerate(range(0, len(buf), _RUN)):
        part = out[a + 1:a + 1 + _RUN]
        np.multiply(_LOWER_BYTES[buf[a:a + _RUN]], _POWERS[:len(part)], out=part)
        part *= np.uint64(pow(int(_BASE), run * _RUN, 1 << 64))
    return np.cumsum(out, out=out)


def _moved_to_one(sums: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``sums`` of runs as if each run began at power 1."""
    runs = int(starts[-1]) // _RUN + 1
    back = np.array([pow(_INVERSE, r * _RUN - 1, 1 << 64) for r in range(runs)], np.uint64)
    return sums * _INVERSES[starts % _RUN] * back[starts // _RUN]


class Texts:
    """Texts (null: empty) as one buffer of UTF-8 bytes; ``starts`` and ``ends`` of each."""

    def __init__(self, column):
        raw = [t.encode() if t else b"" for t in column.to_pylist()]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.buf = np.frombuffer(b"".join(raw), np.uint8)

    def __len__(self) -> int:
        return len(self.ends)

    def words(self, in_word: np.ndarray) -> "Words":
        return Words(self, in_word)


class Words:
    """Maximal runs of bytes of a class; no word crosses texts. ASCII letters count as lower case."""

    def __init__(self, texts: Texts, in_word: np.ndarray):
        mask = in_word[texts.buf]
        n = len(mask)
        first, last = mask.copy(), mask.copy()
        first[1:] &= ~mask[:-1]
        last[:-1] &= ~mask[1:]
        some = texts.starts < texts.ends
        s, e = texts.starts[some], texts.ends[some] - 1
        first[s] = mask[s]
        last[e] = mask[e]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        bounds = np.searchsorted(self.starts, texts.ends)  # words before each text's end
        self.text = np.repeat(np.arange(len(texts)), np.diff(bounds, prepend=0))
        self.hash = np.empty(0, np.uint64)
        if len(self.starts):
            sums = _prefix_sums(texts.buf)
            found = _moved_to_one(sums[self.ends] - sums[self.starts], self.starts)
            self.hash = mix(found + (self.ends - self.starts).astype(np.uint64))

    def counts(self, texts: Texts) -> np.ndarray:
        return np.bincount(self.text, minlength=len(texts))


def shingles(words: Words, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words and the text of each; a text of fewer words has its whole sequence as one."""
    h, text = words.hash, words.text
    n = len(h)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        nxt = np.zeros(n, np.uint64)
        nxt[:max(n - j, 0)] = h[j:]
        if j:  # beyond the text's last word
            same = np.zeros(n, bool)
            same[:max(n - j, 0)] = text[j:] == text[:max(n - j, 0)]
            nxt[~same] = 0
        out = mix(out * _BASE + nxt)
    first = np.cumsum(counts) - counts
    left = counts[text] - (np.arange(n) - first[text])  # words from here to the text's end
    keep = (left >= k) | ((counts[text] < k) & (left == counts[text]))
    return out[keep], text[keep]
