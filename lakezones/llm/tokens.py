"""Token ids of whole texts by the ``tokenizers`` library, with a bounded cache of words.

A text is cut before single spaces, between a word and the ASCII marks that close it, and around single
line ends.  Every distinct part is encoded once per worker.  Pre-tokenisation ends a token at each of
these cuts and never looks back, so the ids are those of the whole text.  Marks are cut off only after an ASCII or Latin
letter or digit that stays one when it is normalised (not after a dotted capital I, whose small form ends in a combining dot).  Texts with a
space inside longer white space, with a null character, or with a string of an added token in any case are encoded whole.  A part of
Latin letters is one pre-token and goes straight to the library's BPE model; all others take its whole pipeline.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterable

from .common import kept_by_worker

CACHE_PARTS = 400_000  # about 90 MB a worker; half of them are those met last, the others go when a new half begins

_ODD = ("\n\n", " \n", "\n ", "  ", "\t", "\r", "\v", "\f", "\0")
_CUT = "\0"  # begins a part that has no space before it
_UNSAFE = re.compile(r" (?<=\s )(?:\s|\Z)")  # a space with white space on both sides
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"  # letters in every version of Unicode, and small in one letter
_WORD = re.compile(f"[{_LATIN}]+")
_MARK = r"[!-/:-@\[-`{-~]"  # ASCII punctuation and symbols
_MARKS = re.compile(rf"({_MARK}(?<=[0-9{_LATIN}].){_MARK}*)(?![^ \n])")  # marks that close a word
_LINE = re.compile(r"\n(?<=\S\n)(?=\S)")
_ENCODERS: dict[tuple[str, bool, bool], "Encoder"] = kept_by_worker("tokens")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: printable Latin-1 for itself, the others from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()


class _Parts(dict):
    """Ids by part; a part that is not there is met."""

    def __init__(self, meet: Callable[[str], bytes]):
        super().__init__()
        self.meet = meet

    def __missing__(self, part: str) -> bytes:
        return self.meet(part)


class Encoder:
    def __init__(self, path: str, keeps_space: bool, cache_parts: int = CACHE_PARTS, special_as_text: bool = False):
        """``special_as_text``: strings of special tokens in a text are ordinary text; by default, as in the library, they
        are their ids."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task owns one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE) if added else None
        prefix = os.path.commonprefix(added)
        self.added_prefix = prefix if prefix.isascii() and prefix.lower() == prefix.upper() else ""  # the same in any case
        self.model = self.tokenizer.model
        self.keeps_space = keeps_space
        self.cache_parts = cache_parts
        self.parts = _Parts(self._meet)
        self.older: dict[str, bytes] = {}  # met before ``parts`` began; those met again move there

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pre_token(self, word: str, spaced: bool) -> str | None:
        """What pre-tokenisation makes of a word of letters; None if that is not simply one token."""
        if not self.keeps_space:  # composed and in lower case, letter by letter
            if not word.isascii():
                word = unicodedata.normalize("NFC", word)
            word = word.lower() if word.isascii() else "".join([c.lower() for c in word])
            if not word.isalpha():
                return None
        elif spaced:
            word = " " + word
        return word.encode().decode("latin-1").translate(_LETTERS)

    def _meet(self, part: str) -> bytes:
        """Ids of a part that ``parts`` lacks: an older one moves there, another is learnt."""
        ids = self.older.pop(part, None)
        if ids is None:
            self._learn((part,))
        else:
            self.parts[part] = ids
        return self.parts[part]

    def _learn(self, new: Iterable[str]) -> None:
        parts, tokenize = self.parts, self.model.tokenize
        for part in new:
            if part.isascii() and part.isalpha():  # most of them
                form = "\u0120" + part if self.keeps_space else part.lower()
                parts[part] = array("I", [t.id for t in tokenize(form)]).tobytes()
                continue
            spaced, word = part[:1] != _CUT, part.removeprefix(_CUT)
            form = self._pre_token(word, spaced) if _WORD.fullmatch(word) else None
            if form is None:
                (parts[part],) = self._ids([" " + word if spaced and self.keeps_space else word])
            else:
                parts[part] = array("I", [t.id for t in tokenize(form)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.parts) > self.cache_parts // 2:
            self.parts, self.older = _Parts(self._meet), self.parts
        get = self.parts.__getitem__
        out, whole = [], []
        for i, t in enumerate(texts):
            plain = t.isascii() and not any(map(t.__contains__, _ODD))  # white space is single spaces and line ends
            if (not plain and ("\0" in t or _UNSAFE.search(t))) or (self.added and self.added_prefix in t and self.added.search(t)):
                whole.append(i)
                out.append(b"")
                continue
            if plain and not self.keeps_space:
                t = t.lower()  # as the tokenizer does; fewer distinct parts
            cut = _MARKS.sub(" \0\\1", _CUT + t)  # the first part has no space before it
            if not plain or t[:1] == "\n" or t[-1:] in ("\n", " "):
                cut = _LINE.sub(" \0\n \0", cut)
            else:
                cut = cut.replace("\n", " \0\n \0")
            out.append(b"".join(map(get, cut.split(" "))))  # text by text, while its parts are near
        for i, ids in zip(whole, self._ids([texts[i] for i in whole])):
            out[i] = ids
        return out


def encoder(path: str, keeps_space: bool, cache_parts: int = CACHE_PARTS, special_as_text: bool = False) -> Encoder:
    """This worker's encoder; another one's cache goes. ``keeps_space``: tokens hold the space before a word (byte-level BPE)."""
    key = (path, keeps_space, special_as_text)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(path, keeps_space, cache_parts, special_as_text)
    _ENCODERS[key].cache_parts = cache_parts
    return _ENCODERS[key]
